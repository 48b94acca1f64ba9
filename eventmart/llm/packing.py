"""Packing documents into sequences of a fixed number of tokens.

Documents are tokenized and cut into whole sequences and a rest. How the rests share sequences is
decided on their histogram alone, shortest pack first: lengths are placed longest first, each into
the pack that has most room, and packs with the same lengths are one pattern with a count. The
patterns are then joined back to the pieces: a piece's rank among those of its length says which
copy of which pattern it belongs to, and where in it.

The histogram has one row per length, so the patterns stay small whatever the corpus. Ranks are
distributed prefix counts: per length and range of a hash-random key first, then inside a range.

Defined cases: a null text is empty and gives the end token alone; a document that would be cut
gives pieces that are packed on their own; repeated rows are packed as often as they occur; an
empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventmart.llm.shared import KEY_DIGITS, range_totals, same, table, texts
from eventmart.session import settle

LENGTH = 1024
END = 0
VOCABULARY = "byte_bpe_50k.json"
# What the vocabulary reserves; texts with it go through the slower library. So do texts with a
# longer run of blanks than this, for which the faster one runs out of stack.
RESERVED = "<|endoftext|>"
LONG_BLANKS = 10_000
_BLANKS = re.compile(r"\s+")


def vocabulary_path(name: str = VOCABULARY) -> str:
    """The place of a public vocabulary on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_signs() -> dict[str, int]:
    """The printable sign that byte-level vocabularies write for each byte, by their rule."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=2)
def _encoders(path: str):
    """The vocabulary in two libraries that give the same ids; the second is several times faster."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    slow, signs = Tokenizer.from_file(path), _byte_signs()
    ranks = {
        bytes(signs[c] for c in word): place
        for word, place in slow.get_vocab(with_added_tokens=False).items()
        if word != RESERVED
    }
    fast = tiktoken.Encoding(
        path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    return slow, fast


def _needs_slow(text: str) -> bool:
    if RESERVED in text:
        return True
    if len(text) <= LONG_BLANKS:
        return False
    return any(m.end() - m.start() > LONG_BLANKS for m in _BLANKS.finditer(text))


def token_ids(text: str, path: str) -> np.ndarray:
    """Ids of a text, and the end token."""
    slow, fast = _encoders(path)
    if _needs_slow(text):
        ids = slow.encode(text, add_special_tokens=False).ids
    else:
        ids = fast.encode_ordinary(text)
    return np.array([*ids, END], dtype="<u4")


def pieces(
    docs: DataFrame, length: int = LENGTH, path: str | None = None, with_ids: bool = True
) -> DataFrame:
    """(doc_id, doc_tokens, start, length, ids_crc32, ids) of every piece of every document.

    A piece is a whole sequence, or the rest of its document. ``with_ids=False`` leaves out ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = path or vocabulary_path()
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in enumerate(texts(batch.column(1))):
                ids = token_ids(text, place)
                for start in range(0, len(ids), length):
                    part = ids[start : start + length]
                    rows.append((doc, len(ids), start, len(part), zlib.crc32(part.tobytes()), part))
            columns = list(zip(*rows)) or [()] * 6
            long = [pa.array(c, pa.int64()) for c in columns[1:5]]
            arrays = [batch.column(0).take(pa.array(columns[0], pa.int64())), *long]
            if with_ids:
                arrays.append(pa.array([p.astype(np.int64) for p in columns[5]], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    names = ["doc_id", "doc_tokens", "start", "length", "ids_crc32", *["ids"] * with_ids]
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, doc_tokens long, start long, length long, ids_crc32 long"
    return docs.select("doc_id", "text").mapInArrow(run, schema + ", ids array<int>" * with_ids)


Pattern = tuple[tuple[int, ...], int]


def shortest_pack_first(histogram: dict[int, int], length: int = LENGTH) -> list[Pattern]:
    """Patterns (lengths, longest first) and how many sequences have each."""
    room: dict[int, list[Pattern]] = {}
    for size in sorted(histogram, reverse=True):
        left = histogram[size]
        while left:
            most = max(room, default=-1)
            if most < size:  # new packs, each filled before the next is opened
                fit = length // size
                for pattern, count in (((size,) * fit, left // fit), ((size,) * (left % fit), 1)):
                    if pattern and count:
                        room.setdefault(length - sum(pattern), []).append((pattern, count))
                break
            pattern, count = room[most].pop()
            used = min(count, left)
            if used < count:
                room[most].append((pattern, count - used))
            elif not room[most]:
                del room[most]
            room.setdefault(most - size, []).append(((*pattern, size), used))
            left -= used
    return [pattern for rest in sorted(room) for pattern in room[rest]]


def slots(patterns: list[Pattern]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, count, first sequence, offset) of each place in each pattern."""
    taken: dict[int, int] = {}
    out, sequence = [], 0
    for sizes, count in patterns:
        offset = 0
        for size in sizes:
            first = taken.get(size, 0)
            out.append((size, first, count, sequence, offset))
            taken[size] = first + count
            offset += size
        sequence += count
    return out


def placed(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces (doc_id, start, length, ids_crc32, ...).

    At most ``length`` rows of the histogram reach the driver, and the slots sent to the tasks
    are bounded by the same number of lengths, not by the number of pieces.
    """
    spark = rows.sparkSession
    histogram = dict(rows.groupBy("length").agg(F.count("*")).collect())
    schema = "at_length long, first long, many long, sequence long, offset long"
    found = slots(shortest_pack_first(histogram, length))
    at = F.broadcast(spark.createDataFrame(found, schema))
    key = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "start"))
    keyed = rows.withColumn("key", key).withColumn("span", F.substring("key", 1, KEY_DIGITS))
    before = range_totals(keyed, ["length"], "span", F.lit(1)).drop("total")
    inside = Window.partitionBy("length", "span").orderBy("key", "doc_id", "doc_tokens", "ids_crc32")
    ranked = keyed.withColumn("inside", F.row_number().over(inside))
    ranked = ranked.join(before, same(ranked, before, ["length", "span"]))
    ranked = ranked.drop(before["length"], before["span"])
    ranked = ranked.withColumn("rank", F.col("before") + F.col("inside") - 1)
    met = (F.col("length") == F.col("at_length")) & (F.col("rank") >= F.col("first")) & (
        F.col("rank") < F.col("first") + F.col("many")
    )
    out = ranked.join(at, met).withColumn(
        "sequence_id", F.col("sequence") + F.col("rank") - F.col("first")
    )
    return out.select(*rows.columns, "sequence_id", "offset")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, tokens) from pieces with ids and places: the token ids in order."""
    piece = F.struct("offset", "ids")
    parts = F.array_sort(F.collect_list(piece))  # at most one piece per token of a sequence
    return packed.groupBy("sequence_id").agg(F.flatten(parts["ids"]).alias("tokens"))


def pack(
    docs: DataFrame, length: int = LENGTH, path: str | None = None, with_ids: bool = True
) -> DataFrame:
    """Every piece of every document of ``docs`` (doc_id, text) with its place in a sequence.

    Places are found without the ids, which join their piece by its number at the end.
    """
    made = pieces(docs, length, path, with_ids)
    if not with_ids:
        return placed(settle(made), length)
    made = settle(made.withColumn("piece", F.monotonically_increasing_id()))
    ids = made.select(F.col("piece").alias("of_piece"), "ids")
    found = placed(made.drop("ids"), length)
    return found.join(ids, F.col("piece") == F.col("of_piece")).drop("piece", "of_piece")


def op10_pack_sequences(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of every document, each with a checksum of its ids and its place."""
    return pack(table(spark, folder, "documents", "doc_id", "text"), with_ids=False)
