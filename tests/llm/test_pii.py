import hashlib
import random
import re

import pytest

from eventmart.llm import pii

# the patterns as they are given, without the shortcuts of the operator
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def is_card(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return 12 <= len(digits) <= 19 and sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def by_hand(text):
    found = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                "card": is_card(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append((kind, m.start(), m.end()))
    return sorted(found, key=lambda s: (s[1], list(PLAIN).index(s[0])))


def texts():
    rng = random.Random(8)
    bits = ["a", "b.c", "@", "@@", ".", "..", "-", " ", "+", "%", "1", "22", "255", "256", "4111", "1111",
            "(0)", "é", "😀", "\n", "x@y.z", "1.2.3.4", "+49 30 1234567", "4111 1111 1111 1111", "0000"]
    return ["".join(rng.choices(bits, k=rng.randrange(1, 40))) for _ in range(3000)]


def test_plain_spans_equal_the_patterns():
    for text in texts():
        base, spans = pii.find_personal(text.encode())
        assert base == by_hand(text), text
        assert set(base) <= set(spans)


DISGUISED = [
    ("mail john [dot] smith (at) example [dot] com now", "email", "john [dot] smith (at) example [dot] com"),
    ("or john dot smith at mail dot example dot org ok", "email", "john dot smith at mail dot example dot org"),
    ("jоhn＠exаmple.com x", "email", "jоhn＠exаmple.com"),
    ("call plus four nine three zero one two three four five six seven.", "phone",
     "plus four nine three zero one two three four five six seven"),
    ("ip one nine two dot one six eight dot one dot one x", "ip", "one nine two dot one six eight dot one dot one"),
    ("4​111 1111 1111 1111 z", "card", "4​111 1111 1111 1111"),
    ("😀 ٤١١١١١١١١١١١١١١١ z", "card", "٤١١١١١١١١١١١١١١١"),
    ("card 4l11 1111 11I1 1111 z", "card", "4l11 1111 11I1 1111"),
    ("call +49 3O 1234 56O7 now", "phone", "+49 3O 1234 56O7"),
    ("host 1O.2.3.1l x", "ip", "1O.2.3.1l"),
    ("an john {at} example {dot} com", "email", "john {at} example {dot} com"),
]


@pytest.mark.parametrize("text, kind, part", DISGUISED)
def test_disguises_map_back_to_the_source(text, kind, part):
    base, spans = pii.find_personal(text.encode())
    assert base == [] and [(k, text[s:e]) for k, s, e in spans] == [(kind, part)]


@pytest.mark.parametrize(
    "text",
    [
        "look at foo.bar and at example. It is one two three.",
        "the one at home ... dot",
        "we met at noon. The dot com boom",
        "(at) the start [dot] then",
        "nine of ten, two or three at most",
        "9777946427004851 lol, 5 B and 12S",
    ],
)
def test_plain_prose_is_left_alone(text):
    assert pii.find_personal(text.encode()) == ([], [])


def test_long_texts_take_linear_time():
    for text in ("a" * 400_000 + "@", "1" * 400_000, "1.2" * 100_000, "+1" + " " * 400_000, "a at " * 80_000,
                 "one two " * 50_000, "a@" * 100_000):
        pii.find_personal(text.encode())


def test_rows(docs, odd, no_docs):
    rows = [(i, t) for i, t in enumerate(texts()[:300])]
    for r in pii.scan(docs(rows).select("doc_id", "text")).collect():
        base = by_hand(rows[r["doc_id"]][1])
        assert [r[f"n_{k}"] for k in PLAIN] == [sum(s[0] == k for s in base) for k in PLAIN]
        line = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert r["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
    assert pii.scan(odd.select("doc_id", "text")).count() == odd.count()
    assert pii.scan(no_docs.select("doc_id", "text")).collect() == []
