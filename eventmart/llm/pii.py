"""Personal data in texts, also where it is disguised.

Plain identifiers come from fixed patterns. For disguised ones the text is rewritten: characters
that look like ASCII become ASCII, invisible ones go, spelled digits become digits, and ``(at)``
or ``dot`` become signs. Every rewrite is kept as an edit of the source, so a span found in the
rewritten text maps back to exact characters of the source.

Defined cases: null is an empty text; an empty text has no spans; repeated rows give equal rows;
texts are read whole; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_right

from pyspark.sql import DataFrame, SparkSession

from eventmart.llm.shared import (
    Span,
    binary_texts,
    in_order,
    table,
    with_columns,
    without_overlap,
    written,
)

# The kinds in the order in which they are listed.
KINDS = ("email", "ip", "card", "phone")

# The patterns of plain identifiers. An address is found from its @ on, and a
# number from its first digit on, which takes time linear in the text.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(rb"[0-9]")

# Letters of other scripts that look like these.
LOOKALIKES = {
    "a": "аα", "b": "Ь", "c": "сϲ", "d": "ԁ", "e": "е",
    "g": "ɡ", "h": "һ", "i": "іι", "j": "ј", "k": "κ", "l": "ӏ",
    "m": "м", "n": "ո", "o": "оο", "p": "рρ", "q": "ԛ",
    "s": "ѕ", "u": "ս", "v": "ν", "w": "ԝ", "x": "хχ",
    "y": "уγ", "A": "АΑ", "B": "ВΒ", "C": "С", "E": "ЕΕ",
    "H": "НΗ", "I": "ІΙ", "K": "КΚ", "M": "МΜ",
    "N": "Ν", "O": "ОΟ", "P": "РΡ", "S": "Ѕ", "T": "ТΤ",
    "X": "ХΧ", "Y": "УΥ", "Z": "Ζ", "@": "﹫",
    ".": "․。﹒｡۔", "+": "﹢", "-": "‐‑‒–−",
    " ": "\xa0\u2007\u2009\u202f\u3000",
}
INVISIBLE = "\u200b\u200c\u200d\u2060\ufeff\xad"


def _plain_characters() -> dict[int, str]:
    """What each disguised character stands for: lookalikes, wide forms, digits of any script."""
    table = {ord(c): plain for plain, others in LOOKALIKES.items() for c in others}
    table |= {0xFF01 + i: chr(0x21 + i) for i in range(94)}
    for code in range(0x80, 0x20000):
        value = unicodedata.decimal(chr(code), None)
        if value is not None:
            table[code] = str(value)
    return table


PLAIN = _plain_characters()
DISGUISED = frozenset([*map(chr, PLAIN), *INVISIBLE])
UNSEEN = re.compile(f"[{INVISIBLE}]")

# Words for signs and digits.
SIGN_DOT = r"(?:dot|punkt|punto|point)"
SIGN_AT = r"(?:at|arroba)"
IN_BRACKETS = r"\s{{0,3}}[\[({{<]\s{{0,3}}(?:{0}|{1})\s{{0,3}}[\])}}>]\s{{0,3}}"
HIDDEN_DOT = rf"(?:{IN_BRACKETS.format(SIGN_DOT, '[.]')}|\s{{1,3}}{SIGN_DOT}\s{{1,3}})"
DOT = rf"(?:{HIDDEN_DOT}|\.)"
LABEL = r"[A-Za-z0-9-]{1,63}"
DISGUISED_ADDRESS = re.compile(
    rf"(?P<at>{IN_BRACKETS.format(SIGN_AT, '@')}|(?P<bare>\s{{1,3}}{SIGN_AT}\s{{1,3}})|\s{{0,3}}@\s{{0,3}})"
    rf"(?P<domain>{LABEL}(?:{DOT}{LABEL})*{DOT}[A-Za-z]{{2,24}})\b",
    re.IGNORECASE,
)
HIDDEN = re.compile(HIDDEN_DOT, re.IGNORECASE)
LOCAL_BEFORE = re.compile(
    rf"[A-Za-z0-9._%+-]{{1,64}}(?:{DOT}[A-Za-z0-9_%+-]{{1,64}}){{0,5}}\Z", re.IGNORECASE
)
DIGITS = dict(zip("zero one two three four five six seven eight nine".split(), "0123456789"))
SPELLED = "|".join(DIGITS)
DIGIT_RUN = re.compile(
    rf"\b(?:plus[\s-]{{1,3}})?(?:{SPELLED})"
    rf"(?:(?:[\s,-]{{1,3}}(?:{SIGN_DOT}[\s-]{{1,3}})?|\s?\.\s?)(?:{SPELLED})\b){{2,}}",
    re.IGNORECASE,
)
RUN_PART = re.compile(rf"{SPELLED}|plus|{SIGN_DOT}|\.|[\s,-]+", re.IGNORECASE)
# A text in lower case without any of these hides nothing in words.
AT_HINTS = (b"dot", b"punkt", b"punto", b"point", b"arroba")
AT_HINT = re.compile(rb"@\s|\s@|[@at]\s{0,3}[\])}>]|[\[({<]\s{0,3}[.]")
DIGIT_HINTS = tuple(map(str.encode, DIGITS))
DIGIT_HINT = re.compile(
    rb"(?:zero|one|two|three|four|five|six|seven|eight|nine)[\s,.-]{1,3}(?:dot\s)?"
    rb"(?:zero|one|two|three|four|five|six|seven|eight|nine)[\s,.-]"
)

# Letters that are written for digits inside a number.
LOOSE_DIGITS = str.maketrans("OolI|SB", "0011158")
LOOSE_GROUP = r"[OolI|SB]*+[0-9][0-9OolI|SB]*+"
LOOSE_NUMBER = re.compile(
    rf"(?<![A-Za-z0-9])[0-9OolI|SB]*[0-9][0-9OolI|SB]*+(?:[\x20.()-]{{1,2}}{LOOSE_GROUP})*(?![A-Za-z])"
)
LOOSE_HINT = re.compile(rb"[0-9][OolI|SB]+[0-9. -]|[. -][OolI|SB]+[0-9]")

Edit = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(map(int, reversed(digits))):
        double = digit * 2 if place % 2 else digit
        total += double - 9 if double > 9 else double
    return total % 10 == 0


def _emails(text: str) -> list[Span]:
    found, done = [], 0
    for m in DOMAIN.finditer(text):
        start = m.start()
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < m.start():
            found.append(("email", start, m.end()))
            done = m.end()
    return found


def plain_spans(text: str) -> list[Span]:
    """Identifiers that the fixed patterns find, leftmost and without overlap per kind."""
    found = _emails(text) if "@" in text else []
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups()):
            found.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append(("phone", m.start(), m.end()))
    return in_order(found, KINDS)


def _address_edits(text: str) -> list[Edit]:
    edits = []
    for m in DISGUISED_ADDRESS.finditer(text):
        hidden = [(h.start(), h.end(), ".") for h in HIDDEN.finditer(text, *m.span("domain"))]
        if m["bare"] and not hidden:
            continue  # "at" between words is no disguise unless a hidden dot follows
        at = m.start("at")
        before = LOCAL_BEFORE.search(text, max(0, at - 400), at)
        if before is None:
            continue
        edits += [(h.start(), h.end(), ".") for h in HIDDEN.finditer(text, *before.span())]
        edits += [(*m.span("at"), "@"), *hidden]
    return edits


def _digit_edits(text: str) -> list[Edit]:
    edits = []
    for run in DIGIT_RUN.finditer(text):
        for part in RUN_PART.finditer(text, *run.span()):
            word = part[0].lower()
            if word in DIGITS:
                put = DIGITS[word]
            elif word == "plus":
                put = "+"
            else:
                put = "" if not word.strip(" \t\n\r\v\f,-") else "."
            edits.append((*part.span(), put))
    return edits


def _number_edits(text: str) -> list[Edit]:
    """Letters for digits, in numbers in which every group has a digit too."""
    edits = []
    for m in LOOSE_NUMBER.finditer(text):
        plain = m[0].translate(LOOSE_DIGITS)
        if plain != m[0] and sum(map(str.isdigit, m[0])) * 2 > sum(map(str.isdigit, plain)):
            changed = (i for i, (a, b) in enumerate(zip(m[0], plain), m.start()) if a != b)
            edits += [(i, i + 1, text[i].translate(LOOSE_DIGITS)) for i in changed]
    return edits


class Rewritten:
    """A text after edits, with the way back from its places to those of the source."""

    def __init__(self, text: str, edits: list[Edit]):
        parts, self._marks, done, size = [], [], 0, 0
        for start, end, put in sorted(edits):
            if start < done:
                continue  # an earlier edit has these characters
            self._marks.append((size, done, True))
            self._marks.append((size + start - done, start, False))
            parts += [text[done:start], put]
            size += start - done + len(put)
            done = end
        self._marks.append((size, done, True))
        self.text = "".join([*parts, text[done:]])
        self._ends = [m[1] for m in self._marks[2::2]]

    def source(self, start: int, end: int) -> tuple[int, int]:
        """The span of the source that a span of the rewritten text stands for."""
        return self._place(start, False), self._place(end - 1, True)

    def _place(self, at: int, after: bool) -> int:
        i = bisect_right(self._marks, at, key=lambda m: m[0]) - 1
        put_at, source, copied = self._marks[i]
        if copied:
            return source + at - put_at + after
        return self._ends[i // 2] if after else source


def is_disguised(raw: bytes, text: str) -> bool:
    """Whether a text has lookalikes, digits of other scripts or invisible characters."""
    if len(raw) == len(text):
        return False
    try:
        text.encode("latin-1")  # far faster than a set of the characters
        return "\xa0" in text or "\xad" in text
    except UnicodeEncodeError:
        return not DISGUISED.isdisjoint(text)


def hidden_spans(raw: bytes, text: str) -> list[Span]:
    """Identifiers that only the rewritten text shows, in places of the source."""
    disguised = is_disguised(raw, text)
    clear = text.translate(PLAIN) if disguised else text  # one character for each
    edits = [(m.start(), m.end(), "") for m in UNSEEN.finditer(clear)] if disguised else []
    low = clear.encode("utf-8", "replace").lower() if disguised else raw.lower()
    if any(h in low for h in AT_HINTS) or AT_HINT.search(low):
        edits += _address_edits(clear)
    if sum(map(low.count, DIGIT_HINTS)) >= 3 and DIGIT_HINT.search(low):
        edits += _digit_edits(clear)
    if LOOSE_HINT.search(raw):
        edits += _number_edits(clear)
    if not disguised and not edits:
        return []
    rewritten, found = Rewritten(clear, edits), []
    for kind, start, end in plain_spans(rewritten.text):
        place = rewritten.source(start, end)
        if text[slice(*place)] != rewritten.text[start:end]:
            found.append((kind, *place))
    return found


def find_personal(raw: bytes) -> tuple[list[Span], list[Span]]:
    """Plain spans and all spans of a text, in code points."""
    text = raw.decode("utf-8", "replace")
    base = plain_spans(text) if b"@" in raw or DIGIT.search(raw) else []
    hidden = without_overlap(hidden_spans(raw, text), base)
    return base, in_order(base + hidden, KINDS) if hidden else base


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """Put the personal data of a text in its place: counts and digest of plain spans, all spans."""

    def make(column):
        found = [find_personal(raw) for raw in binary_texts(column)]
        counts = {f"n_{k}": [sum(s[0] == k for s in base) for base, _ in found] for k in KINDS}
        return counts | {
            "base_sha256": [hashlib.sha256(written(b).encode()).hexdigest() for b, _ in found],
            "spans": [written(spans) for _, spans in found],
            "n_hidden": [len(spans) - len(base) for base, spans in found],
        }

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return with_columns(
        docs, text, make, f"{counts}, base_sha256 string, spans string, n_hidden long"
    )


def op6_find_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """The personal data in every text of ``documents``."""
    return scan(table(spark, folder, "documents", "doc_id", "text"))
