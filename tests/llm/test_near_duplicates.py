import random
import re

import numpy as np
import pytest
from plain import group

from eventmart.llm import near_duplicates as nd


def shingle_set(text, size=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def by_hand(rows, size=4):
    """Components from all pairs."""
    sets = [(i, shingle_set(t, size)) for i, t in rows if i is not None]
    links = [(i, i) for i, _ in sets]
    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                links.append((i, j))
    return group(links)


def changed(rng, words, times):
    words = list(words)
    for _ in range(times):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def corpus():
    rng = random.Random(5)
    word = [f"w{i}" for i in range(500)]
    rows = []
    for base in range(12):
        words = [rng.choice(word) for _ in range(rng.choice((30, 120, 400)))]
        # many copies of one text that are like it, but often not like each other
        for _ in range(rng.choice((1, 5, 25))):
            rows.append(changed(rng, words, rng.choice((0, 1, 2, len(words) // 45))))
        rows.append(" ".join(words))
    long = [rng.choice(word) for _ in range(300)]
    for step in range(15):  # a chain in which neighbours alone are alike
        long = long[8:] + [rng.choice(word) for _ in range(8)]
        rows.append(" ".join(long))
    rows += ["a b", "A B", "a b c", "x", "X", "a b c d", "a b c d e", "A b c D e"]
    rng.shuffle(rows)
    return [(10 * i + 3, t) for i, t in enumerate(rows)]


def test_equals_all_pairs(docs):
    rows = corpus()
    want = by_hand(rows)
    out = nd.near_duplicates(docs([(i, t) for i, t in rows])).collect()
    assert {r["doc_id"]: r["component_id"] for r in out} == want
    assert {r["doc_id"]: r["n_shingles"] for r in out} == {i: len(shingle_set(t)) for i, t in rows}
    assert {r["doc_id"] for r in out if r["kept"]} == set(want.values())
    assert len(set(want.values())) < len(rows) - 50


@pytest.mark.parametrize("centres", [1, 3])
def test_stars_lose_no_link(docs, monkeypatch, centres):
    """With few centres at a time the rounds still try every pair across components."""
    monkeypatch.setattr(nd, "CENTRES", centres)
    rows = corpus()[:70]
    out = nd.near_duplicates(docs([(i, t) for i, t in rows])).collect()
    assert {r["doc_id"]: r["component_id"] for r in out} == by_hand(rows)


def several_texts():
    """Ids with several texts, that are copies of, like, or unlike those of other ids."""
    rng = random.Random(6)
    rows = corpus()
    for _ in range(40):
        (one, _), (_, text) = rng.choice(rows), rng.choice(rows)
        rows.append((one, rng.choice([text, text, "", changed(rng, text.split() or ["w"], 1)])))
    return rows


@pytest.mark.parametrize("centres", [2, 1024])
def test_rows_of_one_id_are_one_document(docs, monkeypatch, centres):
    monkeypatch.setattr(nd, "CENTRES", centres)
    rows = several_texts()
    want = by_hand(rows)
    out = nd.near_duplicates(docs(rows)).collect()
    assert len(out) == len(rows)
    assert {(r["doc_id"], r["component_id"]) for r in out} == set(want.items())
    assert all(r["kept"] == (r["doc_id"] == want[r["doc_id"]]) for r in out)


def test_no_group_vanishes(docs):
    rng = random.Random(3)
    x, y = ([f"{c}{rng.randrange(900)}" for _ in range(60)] for c in "xy")
    near = " ".join([*x[:-1], "other"])
    rows = [(7, " ".join(x)), (7, " ".join(y)), (3, " ".join(y)), (9, near)]
    out = nd.near_duplicates(docs(rows)).collect()
    assert {(r["doc_id"], r["component_id"]) for r in out} == {(7, 3), (3, 3), (9, 3)}
    assert [r["doc_id"] for r in nd.keep_first(docs(rows)).collect()] == [3]
    empty = [(3, " ".join(y)), (7, ""), (7, " ".join(y))]
    assert {r["component_id"] for r in nd.near_duplicates(docs(empty)).collect()} == {3}
    apart = [(7, "short one"), (7, " ".join(x)), (7, None), (9, near)]
    (left,) = nd.keep_first(docs(apart)).collect()
    assert (left["doc_id"], left["text"], left["n_chars"]) == (7, " ".join(x), len(" ".join(x)))


def test_odd_rows(odd, no_docs):
    out = nd.near_duplicates(odd).collect()
    assert len(out) == odd.count()
    by_id = {r["doc_id"]: r for r in out}
    assert by_id[1]["n_shingles"] == by_id[2]["n_shingles"] == by_id[3]["n_shingles"] == 0
    assert by_id[1]["component_id"] == 1 and by_id[2]["component_id"] == 2
    assert all(r["kept"] and r["component_id"] is None for r in out if r["doc_id"] is None)
    assert nd.near_duplicates(no_docs).collect() == []


def test_keep_first(docs, odd, no_docs):
    rows = corpus()
    kept = nd.keep_first(docs([(i, t) for i, t in rows])).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(set(by_hand(rows).values()))
    left = nd.keep_first(odd)
    assert left.columns == odd.columns
    ids = [r["doc_id"] for r in left.collect()]
    assert ids.count(4) == 1 and ids.count(None) == 2
    assert nd.keep_first(no_docs).collect() == []


def test_signature_agrees_with_similarity():
    rng = np.random.default_rng(2)
    for size in (3, 40, 900):
        same = rng.integers(0, 2**63, size, dtype=np.uint64)
        agree = []
        for _ in range(30):
            other = rng.integers(0, 2**63, max(1, size // 4), dtype=np.uint64)
            one, two = np.unique(same), np.unique(np.concatenate([same, other]))
            a, b = nd.signatures([one, two])
            agree.append((a == b).mean())
        assert abs(np.mean(agree) - len(one) / len(two)) < 0.08


def test_tiny_sets_fill_all_bins():
    one = nd.signatures([np.array([17], np.uint64)])
    assert (one == 17).all()


def template_family(n):
    """Documents of one template, many pairs of which are just below the least similarity."""
    rng = random.Random(9)
    template = [f"t{i}" for i in range(300)]
    rows = []
    for i in range(n):
        words = list(template)
        for at in rng.sample(range(0, 300, 10), rng.randrange(2, 4)):
            words[at : at + 4] = [f"v{rng.randrange(40)}" for _ in range(4)]
        rows.append((i, " ".join(words)))
    return rows


def test_pairs_of_a_family_follow_its_components(docs, monkeypatch):
    """Compared pairs grow with the documents, not with their square."""
    compared = []
    check = nd.confirmed

    def counting(pairs, sets, least=nd.LEAST):
        compared.append(pairs.count())
        return check(pairs, sets, least)

    monkeypatch.setattr(nd, "confirmed", counting)
    each = []
    for n in (100, 300):
        compared.clear()
        rows = template_family(n)
        out = nd.near_duplicates(docs(rows)).collect()
        if n == 100:
            assert {r["doc_id"]: r["component_id"] for r in out} == by_hand(rows)
        each.append(sum(compared) / n)
        assert len({r["component_id"] for r in out}) < n / 2
    assert each[1] < 1.5 * each[0]


def test_size_of_shingles(docs):
    rows = corpus()
    out = nd.near_duplicates(docs(rows), size=5).collect()
    assert {r["doc_id"]: r["component_id"] for r in out} == by_hand(rows, 5)
