import itertools
import random
import re
from collections import Counter

import numpy as np

from eventmart.llm import quality_rules as qr


def counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = set()
    for i in range(len(words) - 2):
        if grams[tuple(words[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": repeated,
        "n_repeat_words": len(covered),
        "base_failed": len(words) < 50 or 100 * len(covered) > 50 * len(words),
    }


def texts():
    rng = random.Random(3)
    letters = "a b c dd ee\n\n\t\x0b\x0c\r#*|<>é \x1c\x85😀 \n"
    out = ["", " ", "\n\n", "a a a a a a", "x y z\nx y z\nx y z"]
    for n in (5, 40, 300):
        out += ["".join(rng.choice(letters) for _ in range(n)) for _ in range(40)]
    return out


def test_counts_equal_plain_counts(docs):
    rows = [(i, t) for i, t in enumerate(texts())]
    for row in qr.judge(docs(rows).select("doc_id", "text"), None).collect():
        want = counts(rows[row["doc_id"]][1])
        assert {c: row[c] for c in want} == want


def test_best_sequence_is_the_best_of_all():
    rng = np.random.default_rng(4)
    for _ in range(20):
        chain = qr.Chain(rng.normal(size=(qr.FEATURES, 2)), rng.normal(size=(2, 2)), rng.normal(size=2))
        lines = [tuple(rng.choice(qr.FEATURES, 3, replace=False)) for _ in range(7)]

        def score(labels):
            total = chain.start[labels[0]] + sum(chain.moves[a, b] for a, b in zip(labels, labels[1:]))
            return total + sum(chain.weights[f, a] for a, line in zip(labels, lines) for f in line)

        best = max(itertools.product((0, 1), repeat=7), key=score)
        assert tuple(chain.decode(lines)) == best


def test_training_raises_the_likelihood():
    """Weights of a field that is better than chance on sequences of another draw."""
    rng = random.Random(6)

    def draw():
        labels, lines = [rng.random() < 0.5], []
        for _ in range(19):
            labels.append(labels[-1] if rng.random() < 0.9 else not labels[-1])
        for label in labels:
            lines.append((0 if (rng.random() < 0.8) == label else 1,))
        return lines, [int(x) for x in labels]

    seen = [draw() for _ in range(80)]
    chain = qr.train_chain([s for s, _ in seen], [y for _, y in seen])
    right = plain = total = 0
    for lines, labels in (draw() for _ in range(80)):
        right += sum(a == b for a, b in zip(chain.decode(lines), labels))
        plain += sum((line == (0,)) == b for line, b in zip(lines, labels))
        total += len(labels)
    assert right / total > plain / total + 0.03 > 0.8


def test_labels_decide(docs, spark):
    good = "A plain sentence about the weather in the town today. "
    bad = "BUY | NOW | ### $$$ !!! | CLICK *** | "
    rows = [(i, (good * 15 + "\n") * 3) for i in range(40)]
    rows += [(100 + i, (bad * 15 + "\n") * 3) for i in range(40)]
    rows += [(200, good * 15 + "\n" + bad), (201, good + "\n" + (bad * 15 + "\n") * 3)]
    table = docs([(i, " ".join(f"{w}{k}" for k, w in enumerate(t.split(" "))).replace("\n", "\n ")) for i, t in rows])
    labels = spark.createDataFrame([(i, int(i < 100)) for i in range(140)], "doc_id long, quality int")
    chain = qr.fit(table, labels, 30)
    kept = {r["doc_id"]: r["kept"] for r in qr.judge(table.select("doc_id", "text"), chain).collect()}
    assert all(kept[i] for i in range(40)) and not any(kept[100 + i] for i in range(40))
    assert kept[200] and not kept[201]


def test_odd_rows(odd, no_docs, spark):
    labels = spark.createDataFrame([(4, 1), (5, 0), (None, 1), (5, None)], "doc_id long, quality int")
    chain = qr.fit(odd, labels)
    out = qr.judge(odd.select("doc_id", "text"), chain).collect()
    assert len(out) == odd.count()
    assert not any(r["kept"] for r in out if not r["n_words"])
    assert qr.judge(no_docs.select("doc_id", "text"), None).collect() == []
    assert qr.fit(no_docs, labels) is None
