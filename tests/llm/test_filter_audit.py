import math
from collections import Counter
from itertools import permutations

import pytest

from eventmart.llm import filter_audit as fa

LABELS = "doc_id long, quality int, toxic int"


def by_hand(rows, labels):
    """Every order applied to every document."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    bad = {i for i, _, t in labels if t == 1 and i is not None}
    docs = []
    for i, text, lang in rows:
        t = text or ""
        words = [w for w in t.translate({c: " " for c in range(9, 14)}).split(" ") if w]
        fails = set()
        fails |= {"A"} if len(words) < 200 else set()
        fails |= {"B"} if 100 * len(set(words)) < 50 * len(words) else set()
        fails |= {"C"} if 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t) else set()
        fails |= {"D"} if set(t) & set("#$%&*|") else set()
        smaller = any(j is not None and i is not None and j < i and (u or "") == t for j, u, _ in rows)
        docs.append((lang or "", fails | ({"E"} if smaller else set()), i in good, i in bad))
    out, shapley = {}, Counter()
    for part in {d[0] for d in docs}:
        for order in permutations("ABCDE"):
            left = [d for d in docs if d[0] == part]
            gone = []
            for step, f in enumerate(order, 1):
                removed = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                out[part, "".join(order), step] = [
                    len(left), len(removed), sum(f in d[1] for d in gone),
                    sum(d[1] == {f} for d in docs if d[0] == part),
                    sum(d[2] for d in removed), sum(d[3] for d in removed),
                ]
                shapley[part, f] += len(removed)
                gone += removed
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def audited(spark, docs, labels):
    marks = spark.createDataFrame(labels, LABELS)
    counts = fa.masks(docs, marks, "lang", fa.text_mask, 4)
    return fa.audit(counts, "ABCDE", ["good", "toxic"])


def as_dict(df):
    return {(r[0], r[1], r[2]): tuple(r[3:]) for r in df.collect()}


def test_all_orders(spark, docs, odd):
    prose = " ".join(f"w{i}" for i in range(210))
    texts = [
        prose, prose + " #", "A" + prose.upper(), "same " * 300, "same # " * 150, "few words", "FEW & ODD",
        "x\x0by\x0cz\x85 ü" * 90, prose, "few words", prose.upper() + "|",
    ]
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in odd.collect()]
    rows += [(20 + i, t, ("en", "de", None, "")[i % 4]) for i, t in enumerate(texts * 3)]
    labels = [(i, i % 2, (i + 1) % 3 == 0) for i in range(20, 50)]
    labels = [(i, q, int(t)) for i, q, t in labels] + [(21, 0, 1), (None, 1, 1), (22, None, None), (4, 1, 0)]
    got = as_dict(audited(spark, docs(rows), labels))
    want = by_hand(rows, labels)
    assert got == want and len(got) == 600 * len({r[2] or "" for r in rows})


def test_a_text_with_most_rows(spark, docs):
    rows = [(i, "copy # text", "en") for i in range(300)] + [(None, "copy # text", "en")] * 5
    rows += [(300 + i, f"text {i}", "de") for i in range(20)]
    assert as_dict(audited(spark, docs(rows), [(3, 1, 1)])) == by_hand(rows, [(3, 1, 1)])


def test_empty(spark, no_docs):
    assert audited(spark, no_docs, []).collect() == []


def test_paths_are_counted():
    names = "ABCDE"
    edges = fa.lattice(names)
    assert len(edges) == 80
    for e in edges:
        n = e.state.bit_count()
        assert e.reaching == math.factorial(n) and e.leaving == math.factorial(4 - n)
    assert sorted(o for o, _ in fa.orders(names, edges)) == ["".join(p) for p in permutations(names)]


def test_orders_with_fixed_neighbours():
    """C needs A and B, D needs C: paths are counted among the allowed orders only."""
    after = {"C": ["A", "B"], "D": ["C"]}
    edges = fa.lattice("ABCD", after)
    listed = [o for o, _ in fa.orders("ABCD", edges)]
    assert sorted(listed) == ["ABCD", "BACD"]
    for e in edges:
        name = "ABCD"[e.bit]
        state = {n for i, n in enumerate("ABCD") if e.state >> i & 1}
        uses = sum(set(o[: o.index(name)]) == state for o in listed)
        assert e.reaching * e.leaving == uses
    assert fa.lattice("AB", {"A": ["B"], "B": ["A"]}) == []
    with pytest.raises(ValueError):
        fa.lattice("AA")


def test_masks_of_texts():
    assert fa.text_mask(b"") == 1
    assert fa.text_mask(("ß" * 97 + "ABC").encode()) == 1
    assert fa.text_mask(("ß" * 96 + "ABCD").encode()) == 5
    assert fa.text_mask(b" ".join(b"%d" % i for i in range(200))) == 0
