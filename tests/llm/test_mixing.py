import hashlib
import re
from collections import defaultdict

from eventmart.llm import mixing


def by_hand(rows, weights=(5, 2, 1), share=1.5):
    """Targets and taken words with plain sorts."""
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    sources = defaultdict(int)
    for (_, _, s), n in zip(rows, size):
        sources[s] += n
    order = sorted(sources, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    capped = {s for s in order if sources[s] == 0}
    budget = share * sum(sources.values())
    while True:
        free = [s for s in order if s not in capped]
        level = (budget - sum(2 * sources[s] for s in capped)) / max(1, sum(weight[s] for s in free))
        more = {s for s in free if level * weight[s] >= 2 * sources[s]}
        if not more:
            break
        capped |= more
    target = {s: float(2 * sources[s]) if s in capped else level * weight[s] for s in order}
    taken = {}
    for s in order:
        if not sources[s]:
            continue
        words = int(target[s] + 0.5)
        epochs, rest = divmod(words, sources[s])
        mine = [i for i, r in enumerate(rows) if r[2] == s]
        key = {i: hashlib.md5(str("" if rows[i][0] is None else rows[i][0]).encode()).hexdigest() for i in mine}
        for i in sorted(mine, key=lambda i: (key[i], rows[i][0] if rows[i][0] is not None else -1)):
            part = min(size[i], rest)
            rest -= part
            taken[i] = epochs * size[i] + part
    return {s: t for s, t in target.items()}, {i: taken.get(i, 0) for i in range(len(rows))}


def some_rows():
    sources = ["b", "a", None, "ü", "c"]
    rows = [(i, "w " * (i * 7 % 40), sources[(i * i) % 5]) for i in range(120)]
    rows += [(200 + i, "word " * 30, "hot") for i in range(150)]
    return rows


def test_equals_plain_sorts(spark, docs):
    rows = some_rows()
    out = mixing.mix(docs([(i, t, None, s) for i, t, s in rows])).collect()
    target, taken = by_hand(rows)
    assert {r["source"]: r["target"] for r in out} == target
    assert {r["doc_id"]: r["taken"] for r in out} == {rows[i][0]: n for i, n in taken.items()}


def test_taken_words_reach_the_target(docs):
    out = mixing.mix(docs([(i, t, None, s) for i, t, s in some_rows()])).collect()
    sums = defaultdict(int)
    for r in out:
        assert 0 <= r["taken"] <= 2 * r["size"]
        sums[r["source"]] += r["taken"]
    for r in out:
        assert sums[r["source"]] == int(r["target"] + 0.5)


def test_documents_of_the_mix_hold_the_taken_words(docs):
    table = docs([(i, t, None, s) for i, t, s in some_rows()])
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix(table).collect()}
    words = defaultdict(int)
    for r in mixing.mixed_documents(table).collect():
        words[r["doc_id"]] += len(r["text"].split())
        assert r["n_chars"] == len(r["text"])
    assert dict(words) == {i: n for i, n in taken.items() if n}


def test_odd_rows(odd, no_docs):
    out = mixing.mix(odd).collect()
    assert len(out) == odd.count()
    twice = [r["taken"] for r in out if r["doc_id"] == 4]
    assert twice[0] == twice[1]  # repeated rows share
    assert mixing.mixed_documents(odd).columns == odd.columns
    assert {r["key"] for r in mixing.mixed_documents(odd).collect()} == {"own"}
    assert mixing.mix(no_docs).collect() == [] == mixing.mixed_documents(no_docs).collect()


def test_reruns_agree(docs):
    table = docs([(i, t, None, s) for i, t, s in some_rows()])
    one, other = mixing.mix(table).collect(), mixing.mix(table.repartition(5)).collect()
    assert sorted(map(str, one)) == sorted(map(str, other))
