"""Importance resampling towards a target: array-scored weights, then a distributed radix sort.

Hashed runs of words are counted over the corpus and over the target texts. A bucket's gain is the
log ratio of its smoothed shares; the gains are one array of fixed length, which every task has, so
a document is scored by looking its runs up. Adding Gumbel noise, which only depends on the id,
turns the highest scores into a sample without replacement, drawn with probability by weight. The
ranks come from ``radix_sort``.

Texts are read twice, to count and to score; counts of a task are one array however many texts it
reads. Long texts are taken apart between words, so a task holds the words of a piece at a time.

Defined cases: a null text has no words and weight 0; a null id is the empty string in the noise
and the last of equal scores; repeated rows are scored and drawn each; without target texts all
targets count 0; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from eventmart.llm.radix_sort import Key, ranked
from eventmart.llm.shared import binary_texts, table
from eventmart.session import settle

BUCKETS = 10_000
LONGEST_RUN = 1
LEAST_WORDS, PERCENT = 20, 10
SEED = "2024"
# Bytes of a text whose words are held at once, and runs whose bucket a task keeps in mind.
PIECE = 1 << 20
KNOWN_RUNS, KNOWN_BYTES = 200_000, 64

# Letters and digits, and every byte of a character beyond ASCII.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_GAP = re.compile(rb"[^0-9a-z\x80-\xff]")


def word_pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, in lists of about ``PIECE`` bytes; only A-Z are lower-cased."""
    text, start = text.lower(), 0
    while start < len(text):
        gap = _GAP.search(text, start + PIECE) if start + PIECE < len(text) else None
        end = gap.start() if gap else len(text)
        yield _WORD.findall(text, start, end)
        start = end


def run_pieces(text: bytes, longest: int) -> Iterator[tuple[int, list[bytes]]]:
    """(words, runs) of each piece: all runs of 1 to ``longest`` words, joined by a space.

    A run belongs to the piece of its last word.
    """
    tail: list[bytes] = []
    for words in word_pieces(text):
        if longest == 1:
            yield len(words), words
            continue
        both, runs = tail + words, list(words)
        for size in range(2, longest + 1):
            first = max(0, len(tail) - size + 1)
            ends = range(first + size, len(both) + 1)
            runs += [b" ".join(both[end - size : end]) for end in ends]
        yield len(words), runs
        tail = both[max(0, len(both) - longest + 1) :]


class Buckets(dict):
    """The bucket of a run; a bounded number of short ones is kept."""

    def __init__(self, count: int):
        super().__init__()
        self.count = count

    def __missing__(self, run: bytes) -> int:
        bucket = zlib.crc32(run) % self.count
        if len(self) < KNOWN_RUNS and len(run) <= KNOWN_BYTES:
            self[run] = bucket
        return bucket


def bucket_counts(
    docs: DataFrame, text: str, buckets: int = BUCKETS, longest: int = LONGEST_RUN
) -> np.ndarray:
    """How many runs of all texts fall into each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = Buckets(buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for words in binary_texts(batch.column(0)):
                for _, runs in run_pieces(words, longest):
                    for found, n in Counter(runs).items():
                        total[known[found]] += n
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(total[used])], names=["bucket", "n"]
        )

    parts = docs.select(text).mapInArrow(run, "bucket int, n long")
    found = parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect()  # one row per bucket
    out = np.zeros(buckets, np.int64)
    for row in found:
        out[row["bucket"]] = row["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of each bucket's smoothed shares, rounded down."""
    size, all_corpus, all_target = len(corpus), int(corpus.sum()), int(target.sum())
    ratio = [
        (t + 1.0) * (all_corpus + size) / ((s + 1.0) * (all_target + size))
        for s, t in zip(corpus.tolist(), target.tolist())
    ]
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def noise(doc_id: object, seed: str = SEED) -> int:
    """Thousandths of a Gumbel number, rounded down, which only depends on id and seed."""
    name = f"{seed}:{'' if doc_id is None else doc_id}"
    h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(
    docs: DataFrame, gain: np.ndarray, longest: int = LONGEST_RUN, seed: str = SEED
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every row."""
    numbers = ["n_words", "n_features", "weight", "score"]
    schema = StructType(
        [docs.schema["doc_id"], *[StructField(n, LongType()) for n in numbers]]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Buckets(len(gain))
        for batch in batches:
            rows = []
            ids = batch.column(0).to_pylist()
            for doc_id, text in zip(ids, binary_texts(batch.column(1))):
                n_words = n = total = 0
                for words, runs in run_pieces(text, longest):
                    n_words, n = n_words + words, n + len(runs)
                    total += int(gain[[known[r] for r in runs]].sum()) if runs else 0
                weight = total // n if n else 0
                rows.append((n_words, n, weight, weight + noise(doc_id, seed)))
            made = [pa.array(c, pa.int64()) for c in zip(*rows)] if rows else []
            if made:
                yield pa.RecordBatch.from_arrays([batch.column(0), *made], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def resample(
    docs: DataFrame,
    target: DataFrame,
    longest: int = LONGEST_RUN,
    buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
    seed: str = SEED,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row; rows not drawn have no rank.

    Of the rows with ``least_words`` words or more, ``percent`` in a hundred are drawn: those of
    the highest scores, ties by id.
    """
    gain = gains(
        bucket_counts(docs, "text", buckets, longest),
        bucket_counts(target, "text", buckets, longest),
    )
    rows = settle(scored(docs, gain, longest, seed))
    long_enough = F.col("n_words") >= least_words
    order = ranked(rows.where(long_enough), [Key("score", descending=True), Key("doc_id")])
    drawn = order.count() * percent // 100
    order = order.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = rows.where(~long_enough).withColumn("rank", F.lit(None).cast("long"))
    return order.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")


def op13_resample_to_target(spark: SparkSession, folder: str) -> DataFrame:
    """A tenth of the documents, drawn towards the benchmark's words."""
    docs = table(spark, folder, "documents", "doc_id", "text")
    return resample(docs, table(spark, folder, "benchmark", "text"))


# A run's crc32 is folded over its bytes with the table of 256 remainders.
SQL = r"""
WITH RECURSIVE remainders(i, step, r) AS (
       SELECT i, 0, i::BIGINT FROM range(256) t(i)
       UNION ALL
       SELECT i, step + 1, xor(r >> 1, CASE WHEN r & 1 = 1 THEN 3988292384 ELSE 0 END)
       FROM remainders WHERE step < 8),
     crc AS (SELECT list(r ORDER BY i) AS tab FROM remainders WHERE step = 8),
     words AS (
       SELECT 'd' AS side, doc_id, n AS place, w FROM (
         SELECT doc_id, regexp_extract_all(
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
         FROM documents), unnest(ws) WITH ORDINALITY u(w, n)
       UNION ALL
       SELECT 'b', NULL, n, w FROM (
         SELECT regexp_extract_all(
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
         FROM benchmark), unnest(ws) WITH ORDINALITY u(w, n)),
     bytes AS (
       SELECT w, [('0x' || substr(hex(w), 2 * k + 1, 2))::BIGINT FOR k IN range(strlen(w))] AS b
       FROM (SELECT DISTINCT w FROM words)),
     hashed AS (
       SELECT w, xor(list_reduce(list_prepend(4294967295::BIGINT, b),
                lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1])), 4294967295::BIGINT) % 10000 AS bucket
       FROM bytes, crc),
     found AS (SELECT side, doc_id, bucket FROM words JOIN hashed USING (w)),
     per_bucket AS (
       SELECT k.bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t
       FROM range(10000) k(bucket) LEFT JOIN found USING (bucket) GROUP BY 1),
     gained AS (
       SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE
                / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain
       FROM per_bucket),
     summed AS (
       SELECT doc_id, count(*) AS n, sum(gain)::BIGINT AS total
       FROM found JOIN gained USING (bucket) WHERE side = 'd' GROUP BY doc_id),
     weighed AS (
       SELECT d.doc_id, coalesce(n, 0) AS n_features,
              CASE WHEN n IS NULL THEN 0 ELSE (total - ((total % n) + n) % n) // n END AS weight,
              ('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT AS h
       FROM documents d LEFT JOIN summed USING (doc_id)),
     scores AS (
       SELECT doc_id, n_features, weight,
              weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
       FROM weighed),
     placed AS (
       SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n
       FROM scores WHERE n_features >= 20)
SELECT s.doc_id, s.n_features, s.weight, s.score,
       CASE WHEN place <= 10 * n // 100 THEN place END AS rank
FROM scores s LEFT JOIN placed USING (doc_id)
"""
