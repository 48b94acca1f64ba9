import math
from collections import defaultdict

import numpy as np
import pytest

from eventmart.llm import block_search as bs

SCHEMA = "vec_id long, embedding array<double>"


def by_hand(rows, is_query, best=5):
    """Every query against every row, in Python's whole numbers."""
    bound = 2**63 - 1

    def whole(x):
        return max(-bound - 1, min(bound, math.floor(256.0 * x))) if abs(x) < 1e300 else (bound if x > 0 else -bound - 1)

    weights = defaultdict(set)
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            weights[i].add(tuple(whole(x) for x in v))
    out = {}
    for q in sorted(i for i in weights if is_query(i)):
        scores = []
        for c in weights:
            if c != q:
                s = max(sum(a * b for a, b in zip(v, w)) for v in weights[q] for w in weights[c])
                scores.append((-max(-bound - 1, min(bound, s)), c))
        out[q] = [(c, -s) for s, c in sorted(scores)[:best]]
    return out


def found(spark, rows, is_query="id % 10 = 0", schema=SCHEMA):
    out = defaultdict(list)
    for r in bs.search(spark.createDataFrame(rows, schema), is_query, "vec_id", "embedding").collect():
        out[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    for near in out.values():
        assert [n for n, *_ in sorted(near)] == list(range(1, len(near) + 1))
    return {q: [(i, s) for _, i, s in sorted(near)] for q, near in out.items()}


def agrees(spark, rows):
    want = {q: near for q, near in by_hand(rows, lambda i: i % 10 == 0).items() if near}
    assert found(spark, rows) == want
    return want


@pytest.fixture
def small(monkeypatch):
    for name, size in (("BLOCK", 4), ("RANGE", 16), ("TURN", 3), ("RANGES", 2), ("PIVOTS", 8)):
        monkeypatch.setattr(bs, name, size)


def clusters(n, rng, dim=8):
    centres = rng.normal(size=(9, dim)) * 4
    return [(i, (centres[i % 9] + rng.normal(size=dim) * 0.2).tolist()) for i in range(n)]


def test_small_blocks_and_groups_give_all(spark, small):
    assert len(agrees(spark, clusters(300, np.random.default_rng(1)))) == 30


def test_random_directions(spark):
    rng = np.random.default_rng(2)
    agrees(spark, [(i, rng.normal(size=12).tolist()) for i in range(400)])


def test_ties_and_a_common_vector(spark, small):
    """A third of all rows are one vector, and weights are few, so that scores tie."""
    rng = np.random.default_rng(3)
    rows = [(i, [1.0, 0.0, 0.5] if i % 3 == 0 else rng.integers(-1, 2, 3).tolist()) for i in range(200)]
    rows = [(i, [float(x) for x in v]) for i, v in rows]
    agrees(spark, rows + rows[:50])


def test_odd_vectors(spark, small):
    rows = [
        (None, [1.0]), (1, None), (2, []), (3, [1.0, None]), (4, [math.nan]), (5, [math.inf, 1.0]),
        (10, [0.0, 0.0]), (20, [1.0, 2.0, 3.0]), (30, [-1.0]), (40, []), (6, [2.0, 1.0]), (7, [0.001]),
        (8, [-5.0, 1.0, 1.0, 9.0]),
    ]
    assert agrees(spark, rows).keys() == {10, 20, 30, 40}
    assert found(spark, []) == {} == found(spark, rows[:6])


def test_numbers_beyond_doubles(spark, small):
    """Products that doubles or longs do not hold are taken exactly, then bounded."""
    big = [2.0**40 + 1, 2.0**40, 1e30, -1e30, 1e306, 3.0]
    rng = np.random.default_rng(4)
    agrees(spark, [(i, rng.choice(big, 3).tolist()) for i in range(60)])


def test_an_id_with_many_vectors(spark, small):
    rng = np.random.default_rng(5)
    agrees(spark, [(10 if i % 3 else i, rng.normal(size=4).tolist()) for i in range(120)])


def test_extra_columns(spark):
    rows = [(i, [float(i), 1.0], "own", 1, 2) for i in range(30)]
    assert len(found(spark, rows, schema=SCHEMA + ", digest string, id int, range int")) == 3


def test_bounds_hold_and_prune(monkeypatch):
    rng = np.random.default_rng(6)
    queries = rng.integers(-9, 10, (20, 5)).astype(float)
    vectors = rng.integers(-9, 10, (256, 5)).astype(float)
    bounds = bs.upper_bounds(queries, vectors.min(0)[None], vectors.max(0)[None])
    assert (bounds >= (queries @ vectors.T).max(1)[:, None]).all()
    scored = []
    monkeypatch.setattr(bs, "products", lambda q, v: scored.append(q.shape[0]) or q @ v.T)
    # blocks of one direction each: a query of a direction needs its own block alone
    blocks = np.repeat(np.eye(4), 64, 0) * 100 + rng.random((256, 4))
    out = list(bs.best_in_range(np.eye(4)[:1] * 10, blocks, np.arange(256), np.array([-np.inf]), 3))
    assert sum(scored) == 1 and len(out[0][1]) == 3
