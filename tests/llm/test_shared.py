import random
import time

from pyspark.sql import functions as F

from eventmart.llm import language
from eventmart.llm.shared import binary_texts, labelled_sample, with_columns, without_overlap


def by_hand(found, base):
    taken, out = [(s, e) for _, s, e in base], []
    for span in sorted(found, key=lambda s: (s[1], -s[2])):
        if all(e <= span[1] or span[2] <= s for s, e in taken):
            taken.append(span[1:])
            out.append(span)
    return out


def test_spans_without_overlap():
    rng = random.Random(1)
    for _ in range(3000):
        spans = [("k", s := rng.randrange(30), s + rng.randrange(1, 7)) for _ in range(rng.randrange(9))]
        base = [("b", s := rng.randrange(30), s + rng.randrange(1, 9)) for _ in range(rng.randrange(6))]
        assert without_overlap(spans, base) == by_hand(spans, base)


def test_many_spans_take_time_in_proportion():
    def seconds(n):
        spans = [("k", 10 * i, 10 * i + 5) for i in range(n)]
        base = [("b", 10 * i + 4, 10 * i + 8) for i in range(0, n, 2)]
        times = []
        for _ in range(3):
            start = time.perf_counter()
            assert len(without_overlap(spans, base)) == n // 2
            times.append(time.perf_counter() - start)
        return min(times)

    assert seconds(80_000) < 12 * seconds(20_000)  # 16 times if it were quadratic


def test_a_sample_has_one_row_of_each_id(spark, docs):
    """One id holds most rows, with several texts; nothing but what is derived leaves the tasks."""
    rows = [(1, f"text {i % 3}", "en") for i in range(500)] + [(i, f"other {i}", "en") for i in range(2, 40)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 40)], "doc_id long, quality int")

    def make(column):
        return {"size": [len(raw) for raw in binary_texts(column)]}

    def sampled(table, most):
        return labelled_sample(table, labels, "quality", most, make, "size long").collect()

    got = sampled(docs(rows), 100)
    assert sorted(r["doc_id"] for r in got) == list(range(1, 40))
    assert set(got[0].asDict()) == {"key", "doc_id", "label", "size"}
    assert sorted(map(tuple, got)) == sorted(map(tuple, sampled(docs(rows[::-1]), 100)))
    assert len(sampled(docs(rows), 5)) == 10


def test_a_language_of_few_ids_is_learnt(docs):
    """All rows of a language repeat a few ids; each id counts once."""
    rows = [(i % 8, f"das haus {i % 8}", "de") for i in range(4000)]
    rows += [(i, f"the house {i}", "en") for i in range(100, 130)]
    got = language.sample(docs(rows), 20).collect()
    ids = docs(rows).where(~language.held_out()).select("lang", "doc_id").distinct()
    want = {r["lang"]: min(20, r["n"]) for r in ids.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    assert set(want) == {"de", "en"}
    assert {c: sum(r["lang"] == c for r in got) for c in want} == want


def test_added_columns_replace_names_in_either_case(docs):
    rows = docs([(1, "abc")]).withColumn("SIZE", F.lit("own"))
    out = with_columns(rows, "text", lambda c: {"size": [len(t) for t in binary_texts(c)]}, "size long")
    assert out.select("size").first()["size"] == 3
    assert [c.lower() for c in out.columns].count("size") == 1
