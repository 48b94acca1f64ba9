"""Secret scans: fixed patterns, and the cost of guessing a value that follows a credential word.

The cost is the least sum over all ways to cut the value into dictionary words, dates, repeats,
keyboard walks and spans of brute force: log10 of the guesses that an attacker who knows these
habits needs. ``password: required`` is a cheap word, ``password is tR4!vq9#kk`` is not, so the
first is left alone and the second reported, though no fixed pattern matches either.

Defined cases: null is an empty text; an empty text has no spans; repeated rows give equal rows;
texts are read whole, in time linear in their length; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.llm.shared import (
    Span,
    binary_texts,
    in_order,
    table,
    with_columns,
    without_overlap,
    written,
)

# The kinds of spans in the order in which they are listed.
KINDS = ("assign", "access", "hex", "password")
# The patterns of the base spans. Letters of the credential word in either case.
ASSIGN = re.compile(
    r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")

# Where a word begins, also inside of camelCase and after capitals: dbPassword, DBPassword.
BEGIN = r"(?:(?<![a-z])|(?-i:(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])))"
# How a word is tied to a credential, and the credential.
TIE = r"[\"']?\s{0,8}(?:\bis\b|\bwas\b|:=|=>|->|[:=])\s{0,8}[\"'`]?"
VALUE = r"([^\s\"'`<>]{6,})"
# Schemes stand before the credential, after a blank. Without a word before it, a scheme may be
# prose (basic understanding), so the value must have a digit, a sign or a capital inside.
SCHEME = r"(?:bearer|basic)\s{1,8}[\"'`]?"
SIGNS = r"(?=[^\s\"'`<>]*(?-i:[0-9@#$%^&*+=_~|\\]|[a-z][A-Z]))"
# Words that announce a credential.
CONTEXT = re.compile(
    rf"{BEGIN}(?:(?:password|passwd|passphrase|passcode|pwd|secret(?:[ _-]?key)?|token|"
    r"api[ _-]?key|access[ _-]?key|private[ _-]?key|credentials?|bearer|auth(?:orization)?)"
    rf"{TIE}(?!{SCHEME}){VALUE}"
    rf"|auth(?:orization)?{TIE}{SCHEME}{VALUE}|{SCHEME}{SIGNS}{VALUE})",
    re.IGNORECASE | re.ASCII,
)
HINTS = (b"pass", b"pwd", b"secret", b"token", b"key", b"credential", b"bearer", b"basic", b"auth")
HEX_HINT = re.compile(rb"[0-9a-f]{32}")

# log10 of guesses from which a value counts as a secret.
LEAST_COST = 8.0
# What a further span costs: the attacker does not know where the cuts are.
CUT_COST = 0.5
# Guesses per character of brute force, as log10.
BRUTE = 1.0

# Common passwords and the words around them, most common first; a word's place is its cost.
WORDS = (
    "password 123456 qwerty admin welcome letmein monkey dragon master login abc123 iloveyou "
    "sunshine princess football baseball shadow superman batman trustno1 hello freedom whatever "
    "secret summer winter spring autumn test guest root user default changeme pass love money "
    "computer internet service server access system manager office company private public "
    "example sample dummy placeholder required optional invalid correct wrong empty null none "
    "true false string value field your here this that with from have been will must should "
    "about after before between because against during without reset change update delete "
    "create enter forgot expired missing hidden stored encrypted hashed number letter "
    "january february march april may june july august september october november december "
    "monday tuesday wednesday thursday friday saturday sunday the and for not are was has"
).split()
LONGEST_WORD = max(map(len, WORDS))
LEET = str.maketrans("013457@$!", "oleastasi")
# Rows of keys, each shifted by half a key against the one above, and the alphabet.
KEYS = ("1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
ALPHABET = "abcdefghijklmnopqrstuvwxyz"
DATE = re.compile(
    r"(?:(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])"
    r"|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:(?:19|20)\d\d|\d\d)"
    r"|(?:19|20)\d\d)"
)


def _neighbours() -> dict[str, set[str]]:
    """Keys next to each other, and letters that follow each other."""
    near: dict[str, set[str]] = {}
    at = {(r, c): key for r, row in enumerate(KEYS) for c, key in enumerate(row)}
    for (r, c), key in at.items():
        for place in ((r, c - 1), (r, c + 1), (r + 1, c), (r + 1, c - 1), (r - 1, c), (r - 1, c + 1)):
            if place in at:
                near.setdefault(key, set()).add(at[place])
    for a, b in zip(ALPHABET, ALPHABET[1:]):
        near[a].add(b)
        near[b].add(a)
    return near


NEAR = _neighbours()
RANK = {word: place for place, word in reversed(list(enumerate(WORDS, 1)))}


def _word_spans(value: str):
    """(start, end, cost) of dictionary words, also with capitals and digits for letters."""
    low = value.lower()
    plain = low.translate(LEET)
    for i in range(len(value)):
        for j in range(i + 3, min(i + LONGEST_WORD, len(value)) + 1):
            for form, more in ((low, 0.0), (plain, 0.6)):
                place = RANK.get(form[i:j])
                if place:
                    capitals = 0.0 if value[i:j] == low[i:j] else 0.3
                    yield i, j, math.log10(place + 1) + more + capitals
                    break


def _date_spans(value: str):
    for i in range(len(value)):
        if value[i].isdigit() and (m := DATE.match(value, i)):
            yield i, m.end(), math.log10(120 if m.end() - i == 4 else 120 * 365)


def _repeat_spans(value: str, longest: int = 8):
    """(start, end, unit) of a unit of up to ``longest`` characters that is repeated."""
    n = len(value)
    for period in range(1, min(longest, n // 2) + 1):
        run = 0  # characters from i on that equal the one a period later
        for i in range(n - period - 1, -1, -1):
            run = run + 1 if value[i] == value[i + period] else 0
            times = run // period + 1
            if times >= 3 or (times == 2 and period >= 2):
                yield i, i + times * period, value[i : i + period], times


def _walk_spans(value: str):
    """(start, end, cost) of walks over neighbouring keys, at least three long."""
    low, i = value.lower(), 0
    while i < len(low):
        j, turns, last = i + 1, 0, None
        while j < len(low) and low[j] in NEAR.get(low[j - 1], ()):
            step = ord(low[j]) - ord(low[j - 1])
            turns, last = turns + (last is not None and step != last), step
            j += 1
        if j - i >= 3:
            yield i, j, math.log10(47 * (j - i)) + 0.4 * turns
        i = max(j - 1, i + 1)


def guess_cost(value: str) -> float:
    """log10 of the guesses that the cheapest segmentation of ``value`` needs."""
    return _known_cost(value) if len(value) <= KNOWN_CHARS else _cost(value)


def _cost(value: str) -> float:
    n = len(value)
    ending: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
    for find in (_word_spans, _date_spans, _walk_spans):
        for start, end, cost in find(value):
            ending[end].append((start, cost))
    for start, end, unit, times in _repeat_spans(value):
        unit_cost = guess_cost(unit) if len(unit) < n else BRUTE * len(unit)
        ending[end].append((start, unit_cost + math.log10(times)))
    best, brute = [0.0] * (n + 1), [math.inf] * (n + 1)
    for j in range(1, n + 1):
        # a brute-force span goes on, or starts here
        brute[j] = BRUTE + min(brute[j - 1], best[j - 1] + (CUT_COST if j > 1 else 0.0))
        spans = (best[i] + cost + (CUT_COST if i else 0.0) for i, cost in ending[j])
        best[j] = min(brute[j], *spans) if ending[j] else brute[j]
    return best[n]


# Costs of short values are kept; a long one is not likely to come again.
KNOWN_CHARS = 64
_known_cost = lru_cache(maxsize=4096)(_cost)


def base_spans(text: str) -> list[Span]:
    """Matches of the fixed patterns, leftmost and without overlap per kind."""
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
    found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return in_order(found, KINDS)


def costly_values(text: str, least: float = LEAST_COST) -> list[Span]:
    """Values in the context of a credential word that cost at least ``least`` to guess."""
    found = []
    for m in CONTEXT.finditer(text):
        start = m.start(m.lastindex)
        value = m[m.lastindex].rstrip(".,;:!?)]}")
        if len(value) >= 6 and guess_cost(value) >= least:
            found.append(("password", start, start + len(value)))
    return found


def find_secrets(raw: bytes, least: float = LEAST_COST) -> tuple[list[Span], list[Span], float]:
    """Base spans, all spans, and the highest guess cost of an assigned value; in code points."""
    low = raw.lower()
    if not (HEX_HINT.search(raw) or b"AKIA" in raw or any(h in low for h in HINTS)):
        return [], [], 0.0
    text = raw.decode("utf-8", "replace")
    base = base_spans(text)
    added = without_overlap(costly_values(text, least), base)
    values = [ASSIGN.match(text, s)[1] for kind, s, _ in base if kind == "assign"]
    values += [text[s:e] for _, s, e in added]
    return base, in_order(base + added, KINDS), max(map(guess_cost, values), default=0.0)


def scan(docs: DataFrame, text: str = "text", least: float = LEAST_COST) -> DataFrame:
    """Put the secrets of a text in its place: counts, digest of the base spans, all spans."""

    def make(column):
        found = [find_secrets(raw, least) for raw in binary_texts(column)]
        counts = {f"n_{k}": [sum(s[0] == k for s in base) for base, _, _ in found] for k in KINDS[:3]}
        return counts | {
            "base_sha256": [hashlib.sha256(written(b).encode()).hexdigest() for b, _, _ in found],
            "spans": [written(spans) for _, spans, _ in found],
            "guess_cost": [cost for _, _, cost in found],
        }

    added = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, guess_cost double"
    return with_columns(docs, text, make, added)


def _masked(raw: bytes | None, mask: str) -> str | None:
    if raw is None:
        return None
    _, spans, _ = find_secrets(raw)
    text = raw.decode("utf-8", "replace")
    out, end = [], 0
    hidden = [(ASSIGN.match(text, s).start(1) if k == "assign" else s, e) for k, s, e in spans]
    for s, e in sorted(hidden):  # overlapping spans share one mask
        if s >= end:
            out += [text[end:s], mask]
        end = max(end, e)
    return "".join([*out, text[end:]])


def redact(docs: DataFrame, mask: str = "[secret]") -> DataFrame:
    """``docs`` with each secret of ``text`` replaced by ``mask``, and ``n_chars`` to match.

    Every document stays; a null text stays null and keeps its ``n_chars``.
    """

    def make(column):
        return {"text": [_masked(raw, mask) for raw in column.cast("binary").to_pylist()]}

    out = with_columns(docs, "text", make, "text string")
    if "n_chars" in docs.columns:
        count = F.coalesce(F.char_length("text"), F.col("n_chars"))
        out = out.withColumn("n_chars", count.cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def op9_scan_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """The secrets in every text of ``documents``."""
    return scan(table(spark, folder, "documents", "doc_id", "text"))
