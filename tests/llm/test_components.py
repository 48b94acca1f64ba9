import random

from plain import group

from eventmart.llm.components import components


def found(spark, links):
    table = spark.createDataFrame(links, "a long, b long")
    return {r["id"]: r["component"] for r in components(table).collect()}


def test_chain_star_and_random(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100 + i, 200) for i in range(50)]
    rng = random.Random(1)
    loose = [(rng.randrange(300, 500), rng.randrange(300, 500)) for _ in range(120)]
    links = [(a, b) for a, b in chain + star + loose if a != b]
    rng.shuffle(links)
    assert found(spark, links + links[:20]) == group(links)


def test_no_links(spark):
    assert found(spark, []) == {}
