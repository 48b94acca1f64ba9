"""Quality rules: counts over a text, and lines labelled content or boilerplate.

A linear-chain conditional random field scores each line by its looks and each pair of
neighbours by their labels; Viterbi decoding picks the best sequence for the whole text. A
document is kept if enough of its words are in content lines.

The field is trained by gradient descent on a bounded sample of labelled documents: lines of
good documents are content, lines of bad ones boilerplate, and spliced texts show both and the
changes between them. Without labels of both classes every line is content.

Defined cases: a null or empty text has no words, fails the base rules and is not kept; repeated
rows give equal rows; texts are read whole; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass
from operator import eq

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from eventmart.llm.shared import binary_texts, labelled_sample, table, with_columns

SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED = 0.5
LEAST_CONTENT = 0.5
# Bounds of the training sample: documents of each class, and lines of each.
SAMPLE = 400
SAMPLE_LINES = 60

MARKS = ("http", "www.", "©", "licen", "cookie", "copyright", "subscribe", "log in")
LENGTHS = (1, 3, 6, 12, 25, 50)
FEATURES = len(LENGTHS) + 1 + 9


def line_features(line: str, words: list[str], repeated: bool) -> tuple[int, ...]:
    """The places of the features that a line has."""
    size, count = len(line), len(words)
    found = [sum(count >= n for n in LENGTHS)]
    place = len(LENGTHS) + 1
    symbols = sum(map(line.count, SYMBOLS))
    low = line.lower()
    for has in (
        symbols * 50 > size,
        symbols * 10 > size,
        line.isupper(),
        line.count("!") * 20 > count * 3 and "!" in line,
        not line.rstrip().endswith((".", "!", "?", ":", ";", '"')),
        repeated,
        sum(map(eq, words, words[1:])) * 4 > count,
        sum(map(str.isdigit, line)) * 4 > size if count < 12 else False,
        any(m in low for m in MARKS),
    ):
        if has:
            found.append(place)
        place += 1
    return tuple(found)


def lines_of(text: str) -> list[tuple[int, tuple[int, ...]]]:
    """(words, features) of each line that has a word."""
    seen, out = set(), []
    for line in text.split("\n"):
        words = line.split()
        if words:
            out.append((len(words), line_features(line, words, line in seen)))
            seen.add(line)
    return out


@dataclass
class Chain:
    """A linear-chain field over the labels 0 (boilerplate) and 1 (content)."""

    weights: np.ndarray  # of a feature for each label
    moves: np.ndarray  # from a label to the next
    start: np.ndarray

    def decode(self, lines: list[tuple[int, ...]]) -> list[int]:
        """The best sequence of labels (Viterbi); a tie goes to content."""
        if not lines:
            return []
        w = self.weights.tolist()
        (m00, m01), (m10, m11) = self.moves.tolist()
        cost0, cost1 = self.start.tolist()
        back = []
        for n, line in enumerate(lines):
            here0 = sum(w[f][0] for f in line)
            here1 = sum(w[f][1] for f in line)
            if n:
                from0, from1 = cost0, cost1
                cost0 = max(from0 + m00, from1 + m10)
                cost1 = max(from0 + m01, from1 + m11)
                back.append((int(from1 + m10 >= from0 + m00), int(from1 + m11 >= from0 + m01)))
            cost0, cost1 = cost0 + here0, cost1 + here1
        labels = [int(cost1 >= cost0)]
        for step in reversed(back):
            labels.append(step[labels[-1]])
        return labels[::-1]


def _log_sum(a: np.ndarray, axis: int) -> np.ndarray:
    most = a.max(axis=axis, keepdims=True)
    return np.squeeze(most, axis) + np.log(np.exp(a - most).sum(axis=axis))


def train_chain(
    sequences: list[list[tuple[int, ...]]], labels: list[list[int]], rounds: int = 150
) -> Chain:
    """Maximum likelihood by Adam; expectations come from the forward and backward sums."""
    n, longest = len(sequences), max(map(len, sequences))
    x = np.zeros((n, longest, FEATURES))
    y = np.zeros((n, longest, 2))
    mask = np.zeros((n, longest))
    for i, (lines, marks) in enumerate(zip(sequences, labels)):
        for t, (line, mark) in enumerate(zip(lines, marks)):
            x[i, t, list(line)] = 1
            y[i, t, mark] = 1
            mask[i, t] = 1
    pairs = mask[:, 1:]
    seen_moves = np.einsum("nta,ntb->ab", y[:, :-1] * pairs[..., None], y[:, 1:])
    total = mask.sum()
    theta = np.zeros(FEATURES * 2 + 4 + 2)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        weights = theta[: FEATURES * 2].reshape(FEATURES, 2)
        moves, start = theta[FEATURES * 2 : -2].reshape(2, 2), theta[-2:]
        here = x @ weights
        ahead, behind = np.zeros_like(here), np.zeros_like(here)
        ahead[:, 0] = start + here[:, 0]
        for t in range(1, longest):
            new = _log_sum(ahead[:, t - 1, :, None] + moves, 1) + here[:, t]
            ahead[:, t] = np.where(mask[:, t, None] > 0, new, ahead[:, t - 1])
        for t in range(longest - 2, -1, -1):
            new = _log_sum(moves + (here[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
            behind[:, t] = np.where(mask[:, t + 1, None] > 0, new, 0.0)
        whole = _log_sum(ahead[:, -1], 1)
        chance = np.exp(ahead + behind - whole[:, None, None]) * mask[..., None]
        joint = (
            ahead[:, :-1, :, None] + moves + (here + behind)[:, 1:, None, :] - whole[:, None, None, None]
        )
        joint = np.exp(np.minimum(joint, 0.0)) * pairs[..., None, None]
        up = np.concatenate(
            [
                np.einsum("ntf,nta->fa", x, y - chance).ravel(),
                (seen_moves - joint.sum((0, 1))).ravel(),
                (y[:, 0] - chance[:, 0]).sum(0),
            ]
        )
        grad = up / total - 1e-4 * theta
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad**2
        theta = theta + 0.1 * (first / (1 - 0.9**step)) / (
            np.sqrt(second / (1 - 0.99**step)) + 1e-8
        )
    return Chain(
        theta[: FEATURES * 2].reshape(FEATURES, 2), theta[FEATURES * 2 : -2].reshape(2, 2), theta[-2:]
    )


def window_of_lines(raw: bytes, most: int = SAMPLE_LINES) -> list[tuple[int, ...]]:
    """The features of up to ``most`` lines in a row; where they start is taken by hash."""
    lines = [f for _, f in lines_of(raw.decode("utf-8", "replace"))]
    start = zlib.crc32(raw) % max(1, len(lines) - most + 1)
    return lines[start : start + most]


def fit(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> Chain | None:
    """A field trained on up to ``most`` labelled documents of each class, None without both."""

    def make(column):
        return {"lines": [window_of_lines(raw) for raw in binary_texts(column)]}

    rows = labelled_sample(docs, labels, "quality", most, make, "lines array<array<int>>")
    by_class: dict[int, list] = {0: [], 1: []}
    for row in rows.orderBy("key", "doc_id").collect():
        if lines := [tuple(line) for line in row["lines"]]:
            by_class[row["label"]].append(lines)
    if not all(by_class.values()):
        return None
    sequences, marks = [], []
    for label, texts in by_class.items():
        sequences += texts
        marks += [[label] * len(lines) for lines in texts]
    for n, (bad, good) in enumerate(zip(by_class[0], by_class[1])):
        cut = len(good) // 2 if n % 2 else len(good)
        spliced = [good[:cut], bad[: SAMPLE_LINES // 2], good[cut:]]
        sequences.append([line for part in spliced for line in part])
        marks.append([m for part, m in zip(spliced, (1, 0, 1)) for _ in part])
    return train_chain(sequences, marks)


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words which occurs at least twice."""
    grams = list(zip(words, words[1:], words[2:]))
    if len(set(grams)) == len(grams):
        return 0
    times, last, covered = Counter(grams), -1, 0
    for i, gram in enumerate(grams):
        if times[gram] > 1:
            covered += i + 3 - max(i, last)
            last = i + 3
    return covered


def measure(raw: bytes, chain: Chain | None) -> dict:
    """The counts and the verdict of one text."""
    words = raw.split()  # by exactly the six characters that part words
    text = raw.decode("utf-8", "replace")
    full = [line for line in raw.split(b"\n") if line.strip()]
    repeats = repeated_words(words)
    lines = lines_of(text)
    labels = chain.decode([f for _, f in lines]) if chain else [1] * len(lines)
    held = sum(n for n, _ in lines)
    content = sum(n for (n, _), label in zip(lines, labels) if label)
    failed = len(words) < LEAST_WORDS or repeats > MOST_REPEATED * len(words)
    share = content / held if held else 0.0
    return {
        "n_words": len(words),
        "word_chars": len(text) - sum(map(text.count, " \t\n\v\f\r")),
        "n_symbols": sum(map(text.count, SYMBOLS)),
        "n_dup_lines": len(full) - len(set(full)),
        "n_repeat_words": repeats,
        "base_failed": failed,
        "n_lines": len(lines),
        "n_content_lines": sum(labels),
        "content_share": share,
        "kept": not failed and share >= LEAST_CONTENT,
    }


ADDED = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, n_lines long, n_content_lines long, content_share double, kept boolean"
)


def judge(docs: DataFrame, chain: Chain | None, text: str = "text") -> DataFrame:
    """Put counts and verdict of a text in its place."""

    def make(column):
        rows = [measure(raw, chain) for raw in binary_texts(column)]
        return {c: [r[c] for r in rows] for c in measure(b"", chain)}

    return with_columns(docs, text, make, ADDED)


def op2_rule_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and verdict of every document."""
    docs = table(spark, folder, "documents", "doc_id", "text")
    chain = fit(docs, table(spark, folder, "labels", "doc_id", "quality"))
    return judge(docs, chain)
