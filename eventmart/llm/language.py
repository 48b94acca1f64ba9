"""Language identification: a bidirectional gated recurrent network over bytes.

A text is read in windows of bytes, in both directions; every position gets a probability of each
language, and those of the positions that belong to letters are averaged over the whole text. The
network is trained here, by backpropagation through time in numpy, on a bounded sample of texts
with a known language.

Defined cases: a null text, and one without any letter, is ``und`` with score 0, and so is every
text if there is nothing to learn from; null ids are not held out; repeated rows give equal rows;
texts are read whole; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventmart.llm.shared import binary_texts, random_key, table, with_columns
from eventmart.session import settle

UNKNOWN = "und"
WINDOW = 64
HIDDEN = 8
# Bounds of the sample: texts of each language, and characters of each.
SAMPLE, SAMPLE_CHARS = 200, 3000
ROUNDS, BATCH, RATE, SEED = 450, 192, 0.015, 3
# Windows that are read together.
TOGETHER = 1024

LETTER = np.zeros(256, np.float32)
LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Reader:
    """Gated recurrent units in one direction; weights are stacked update, reset, candidate."""

    by_byte: np.ndarray  # (3 * hidden, 256)
    recurrent: np.ndarray  # (3 * hidden, hidden)

    def read(self, windows: np.ndarray, mask: np.ndarray, keep: bool = False):
        """States after each position, (positions, hidden, windows); with what learning needs."""
        positions, n = windows.shape
        size = self.recurrent.shape[1]
        state = np.zeros((size, n), np.float32)
        states = np.empty((positions, size, n), np.float32)
        steps = []
        for t in range(positions):
            here = np.take(self.by_byte, windows[t], axis=1)
            past = self.recurrent @ state
            gates = _sigmoid(here[: 2 * size] + past[: 2 * size])
            update, reset = gates[:size], gates[size:]
            new = np.tanh(here[2 * size :] + reset * past[2 * size :])
            after = (new + update * (state - new)) * mask[t]
            if keep:
                steps.append((state, update, reset, new, past[2 * size :]))
            states[t] = state = after
        return states, steps

    def learn(self, windows, mask, steps, slopes) -> tuple[np.ndarray, np.ndarray]:
        """Slopes of the weights from those of the states (backpropagation through time)."""
        positions, n = windows.shape
        size = self.recurrent.shape[1]
        inputs = np.empty((positions, 3 * size, n), np.float32)
        recurrent = np.zeros_like(self.recurrent)
        carried = np.zeros((size, n), np.float32)
        for t in reversed(range(positions)):
            state, update, reset, new, past = steps[t]
            up = (slopes[t] + carried) * mask[t]
            d_new = up * (1 - update) * (1 - new * new)
            d_update = up * (state - new) * update * (1 - update)
            d_reset = d_new * past * reset * (1 - reset)
            inputs[t] = np.concatenate([d_update, d_reset, d_new])
            through = np.concatenate([d_update, d_reset, d_new * reset])
            recurrent += through @ state.T
            carried = up * update + self.recurrent.T @ through
        flat = inputs.transpose(1, 0, 2).reshape(3 * size, -1)
        seen = np.zeros((positions * n, 256), np.float32)
        seen[np.arange(positions * n), windows.ravel()] = 1
        return flat @ seen, recurrent


@dataclass
class Network:
    """Two readers, and a linear layer from both states to the languages."""

    languages: list[str]
    ahead: Reader
    behind: Reader
    output: np.ndarray  # (languages, 2 * hidden)
    bias: np.ndarray  # (languages, 1)

    def states(self, windows, mask, keep=False):
        ahead, a_steps = self.ahead.read(windows, mask, keep)
        behind, b_steps = self.behind.read(windows[::-1], mask[::-1], keep)
        return np.concatenate([ahead, behind[::-1]], axis=1), a_steps, b_steps

    def probabilities(self, windows: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """(positions, languages, windows): what language each position is in."""
        states, _, _ = self.states(windows, mask)
        scores = np.matmul(self.output, states) + self.bias
        scores = np.exp(scores - scores.max(axis=1, keepdims=True))
        return scores / scores.sum(axis=1, keepdims=True)

    def labels(self, raw: bytes) -> list[str]:
        """The language of every byte of a text."""
        windows, mask, _ = cut([raw])
        best = self.probabilities(windows, mask).argmax(axis=1)
        return [self.languages[i] for i in best.T.ravel()[: len(raw)]]

    def pooled(self, texts: list[bytes]) -> np.ndarray:
        """(texts, languages): mean probability over the positions of letters.

        Texts are taken a bounded number of windows at a time, however long they are.
        """
        sums = np.zeros((len(texts), len(self.languages)))
        letters = np.zeros(len(texts))
        for parts, owners in _groups(texts):
            windows, mask, part = cut(parts)
            owner = np.array(owners, np.int64)[part]
            for start in range(0, windows.shape[1], TOGETHER):
                some = slice(start, start + TOGETHER)
                weight = LETTER[windows[:, some]] * mask[:, some]
                chance = self.probabilities(windows[:, some], mask[:, some])
                np.add.at(sums, owner[some], np.einsum("tln,tn->nl", chance, weight))
                np.add.at(letters, owner[some], weight.sum(0))
        return sums / np.maximum(letters, 1)[:, None]


def _groups(texts: list[bytes], most: int = 64 * TOGETHER * WINDOW):
    """Lists of at most about ``most`` bytes of texts or parts of them, with their places."""
    parts: list[bytes] = []
    owners: list[int] = []
    size = 0
    for i, text in enumerate(texts):
        for start in range(0, len(text), most):  # a whole number of windows
            part = text[start : start + most]
            if size + len(part) > most and parts:
                yield parts, owners
                parts, owners, size = [], [], 0
            parts.append(part)
            owners.append(i)
            size += len(part)
    if parts:
        yield parts, owners


def cut(texts: list[bytes], size: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of all texts (positions, windows), 1 where there is a byte, and each one's text."""
    counts = np.array([-(-len(t) // size) for t in texts], np.int64)
    owner = np.repeat(np.arange(len(texts)), counts)
    flat = np.frombuffer(b"".join(t.ljust(c * size, b"\0") for t, c in zip(texts, counts)), np.uint8)
    windows = np.ascontiguousarray(flat.reshape(-1, size).T)
    mask = np.ones(windows.shape, np.float32)
    last = np.cumsum(counts) - 1
    for text, count, at in zip(texts, counts, last):
        if count and len(text) % size:
            mask[len(text) % size :, at] = 0
    return windows, mask, owner


def train(texts: list[bytes], labels: list[str], rounds: int = ROUNDS) -> Network | None:
    """A network trained on texts with their languages, None if there are none."""
    languages = sorted(set(labels))
    if not languages:
        return None
    rng = np.random.default_rng(SEED)
    windows, mask, owner = cut(texts)
    truth = np.array([languages.index(x) for x in labels])[owner]
    weigh = LETTER[windows] * mask
    useful = np.flatnonzero(weigh.sum(0) >= 4)
    # every language is drawn equally often
    places = [useful[truth[useful] == i] for i in range(len(languages))]
    places = [p for p in places if len(p)]
    if not places:
        return None

    def start(*shape: int, scale: float) -> np.ndarray:
        return rng.normal(scale=scale, size=shape).astype(np.float32)

    def reader() -> Reader:
        return Reader(start(3 * HIDDEN, 256, scale=0.3), start(3 * HIDDEN, HIDDEN, scale=0.3))

    net = Network(
        languages, reader(), reader(), start(len(languages), 2 * HIDDEN, scale=0.3),
        np.zeros((len(languages), 1), np.float32),
    )
    held = [net.ahead.by_byte, net.ahead.recurrent, net.behind.by_byte, net.behind.recurrent, net.output, net.bias]
    first, second = [np.zeros_like(w) for w in held], [np.zeros_like(w) for w in held]
    for step in range(1, rounds + 1):
        some = np.concatenate([rng.choice(p, max(1, BATCH // len(places))) for p in places])
        x, m, weight = windows[:, some], mask[:, some], weigh[:, some]
        states, a_steps, b_steps = net.states(x, m, keep=True)
        scores = np.matmul(net.output, states) + net.bias
        chance = np.exp(scores - scores.max(axis=1, keepdims=True))
        chance /= chance.sum(axis=1, keepdims=True)
        chance[:, truth[some], np.arange(len(some))] -= 1
        error = chance * (weight / weight.sum())[:, None, :]
        slopes = np.matmul(net.output.T, error)
        ups = [
            *net.ahead.learn(x, m, a_steps, slopes[:, :HIDDEN]),
            *net.behind.learn(x[::-1], m[::-1], b_steps, slopes[::-1, HIDDEN:]),
            np.einsum("tln,thn->lh", error, states),
            error.sum((0, 2))[:, None],
        ]
        rate = RATE * (1 - step / (rounds + 1))
        for w, up, f, s in zip(held, ups, first, second):
            np.clip(up, -1, 1, out=up)
            f += 0.1 * (up - f)
            s += 0.01 * (up * up - s)
            w -= rate * (f / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    return net


def held_out():
    """Documents whose checksum leaves 2 when divided by 4 are never learnt from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, most: int = SAMPLE) -> DataFrame:
    """(text, lang) of up to ``most`` texts of each language, those of least key.

    Few more than needed are put in order: a first pass counts ids, a second takes the share of
    keys that holds about four times as many. Only the ids of those are sorted, and the picked
    ones, bounded by the number of languages, meet the texts. Of a text ``SAMPLE_CHARS``
    characters in a row are taken, from a place given by its hash; of an id with several texts,
    the one of least hash.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    rows = known.select("lang", "doc_id", random_key("doc_id").alias("key"))
    ids = F.approx_count_distinct("doc_id")
    counts = settle(known.groupBy("lang").agg(F.greatest(ids, F.lit(1)).alias("n")))
    place = F.conv(F.substring("key", 1, 8), 16, 10).cast("double") / float(1 << 32)
    near = rows.join(counts, "lang").where(place * F.col("n") < 4 * most)
    by_lang = Window.partitionBy("lang").orderBy("key", "doc_id")
    near = near.dropDuplicates(["lang", "doc_id"])
    picked = near.withColumn("place", F.row_number().over(by_lang)).where(F.col("place") <= most)
    picked = settle(picked.select("lang", "doc_id", "key"))
    spare = F.greatest(F.char_length("text") - SAMPLE_CHARS + 1, F.lit(1))
    which = F.xxhash64("text")
    window = F.substring("text", (F.pmod(which, spare) + 1).cast("int"), F.lit(SAMPLE_CHARS))
    texts = known.select("lang", "doc_id", F.struct(which.alias("which"), window.alias("text")).alias("row"))
    once = texts.join(picked, ["lang", "doc_id"]).groupBy("lang", "key", "doc_id")
    return once.agg(F.min("row").alias("row")).select("lang", "key", "row.text")


def fit(docs: DataFrame, most: int = SAMPLE) -> Network | None:
    """A network trained on the sample, in the same order on every run."""
    rows = sample(docs, most).orderBy("lang", "key", "text").collect()
    return train([r["text"].encode() for r in rows], [r["lang"] for r in rows])


def identify(docs: DataFrame, net: Network | None, text: str = "text") -> DataFrame:
    """Put (lang_pred, score) in the place of a text."""

    def make(column):
        raw = binary_texts(column)
        letters = [any(map(str.isalpha, t.decode("utf-8", "replace"))) for t in raw]
        if net is None or not raw:
            return {"lang_pred": [UNKNOWN] * len(raw), "score": [0.0] * len(raw)}
        pooled = net.pooled(raw)
        best = pooled.argmax(axis=1)
        return {
            "lang_pred": [net.languages[b] if has else UNKNOWN for b, has in zip(best, letters)],
            "score": [
                min(1.0, float(p[b])) if has else 0.0 for p, b, has in zip(pooled, best, letters)
            ],
        }

    return with_columns(docs, text, make, "lang_pred string, score double")


def op5_identify_language(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, learnt from those that are not held out."""
    docs = table(spark, folder, "documents", "doc_id", "text", "lang")
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return identify(rows, fit(docs))
