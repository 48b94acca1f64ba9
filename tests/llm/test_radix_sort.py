import numpy as np
import pytest

from eventmart.llm import radix_sort as rs
from eventmart.llm.radix_sort import Key

SCHEMA = "score long, doc_id long, chunk string"
KEYS = [Key("score", descending=True), Key("doc_id")]


def in_order(rows):
    def key(r):
        return (r[0] is None, -(r[0] or 0), r[1] is None, r[1] or 0)

    return sorted(rows, key=key)


def check(spark, rows):
    out = sorted(rs.ranked(spark.createDataFrame(rows, SCHEMA), KEYS).collect(), key=lambda r: r["rank"])
    assert [r["rank"] for r in out] == list(range(1, len(rows) + 1))
    assert [(r[0], r[1]) for r in out] == [(r[0], r[1]) for r in in_order(rows)]


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(rs, "CHUNK_BITS", 5)


def test_many_chunks_and_passes(spark, small):
    rng = np.random.default_rng(1)
    rows = [(int(s), int(i), "own") for s, i in zip(rng.integers(-9000, 9000, 3000), rng.permutation(300_000)[:3000])]
    check(spark, rows)


def test_full_range_of_longs(spark, small):
    edge = [-(2**63), 2**63 - 1, -1, 0, 1, 2**53 + 1, 2**53]
    check(spark, [(a, b, "x") for a in edge for b in edge])


def test_a_key_with_most_rows_and_nulls(spark, small):
    rows = [(7, i, "a") for i in range(400)] + [(None, i, "b") for i in range(50)]
    rows += [(i, None, "c") for i in range(50)] + [(None, None, None)] * 3 + [(7, 5, "a")] * 40
    check(spark, rows)


def test_stable_passes(spark, small):
    """Rows that tie in the first key keep the order of the second through all later passes."""
    check(spark, [(i % 3, (i * 7919) % 4001, None) for i in range(4001)])


def test_equal_and_no_rows(spark):
    check(spark, [(1, 1, "a")] * 20)
    check(spark, [(None, None, "a")] * 3)
    check(spark, [])


def test_digits_keep_the_order_of_numbers():
    import pyarrow as pa

    values = [-(2**63), -5, 0, 3, 2**40, 2**63 - 1]
    for descending in (False, True):
        r = rs._Range(Key("k", descending), values[0], values[-1], False)
        digits = r.digits(pa.array(values, pa.int64()))
        whole = [sum(int(d[i]) << n * rs.DIGIT_BITS for n, d in enumerate(digits)) for i in range(6)]
        assert whole == sorted(whole, reverse=descending) and len(set(whole)) == 6
