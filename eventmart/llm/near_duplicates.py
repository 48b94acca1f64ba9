"""Near-duplicate documents: MinHash over word shingles, links confirmed on the full sets.

Each set of shingles is hashed once into bins (one-permutation hashing); an empty bin takes the
value of the first full bin in a random order of its own (optimal densification). Bins are
grouped into bands, and documents that share a band share a bucket. Equal sets count as one.

A bucket does not give all its pairs. It gives a star: each member is paired with the best centre
of its buckets, the document that shares most of them. Confirmed links join components, and a
bucket whose members are in one component is done.

For the others an exact rule finds what the stars missed. Of the documents in open buckets only
the rarest shingles are compared: two similar sets share one among their first few by rarity,
and not after too many that the other lacks. Documents that share one form a finer bucket. In
each round one member of it outside its largest component, then 4, 16 and so on, are centres
and meet the members of other components; components are taken anew before the next round, and
a bucket whose members are in one is closed. So pairs follow the components that are left, not
the members, and no link between members of a bucket is lost for the components.

Defined cases: a null text, or one without words, has an empty set and is linked with nothing;
shorter texts than a shingle are one shingle; a null id is linked with nothing and kept; rows of
one id are one document, linked through each of its texts; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from eventmart.llm.components import components
from eventmart.llm.shared import binary_texts, table, with_columns
from eventmart.session import settle

SHINGLE = 4
LEAST = 80  # percent
# 128 bins in bands of 4: a pair of similarity 0.8 shares no bucket once in twenty million.
BIN_BITS = 7
ROWS = 4
# Centres that a finer bucket tries in the first round, and by how much each round has more.
CENTRES = 1
GROWTH = 4
# Ids that are sent to every task, so that texts need not move; beyond, both sides are shuffled.
SENT_IDS = 4_000_000
# Bins that a set's hashes are counted in, to bound how much two sets can share.
COUNTS = 512

BINS = 1 << BIN_BITS
EDGES = np.arange(BINS, dtype=np.uint64) << np.uint64(64 - BIN_BITS)
# The order in which an empty bin asks the others: the same for all documents.
ASK = np.argsort(np.random.default_rng(7).random((BINS, BINS)), axis=1)
# Odd multipliers of the mixing steps.
MIX = tuple(
    map(np.uint64, (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93))
)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly."""
    x = (x ^ (x >> np.uint64(30))) * MIX[1]
    x = (x ^ (x >> np.uint64(27))) * MIX[2]
    return x ^ (x >> np.uint64(31))


def shingles(raw: bytes, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text; A-Z count as a-z."""
    words = raw.lower().split()  # both touch ASCII only
    if not words:
        return np.zeros(0, np.uint64)
    hashed = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(size, len(words))
    out = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        out = out * MIX[3] + hashed[i : len(words) - width + 1 + i]
    return np.unique(_mixed(out))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """A row of bins for each non-empty set."""
    values = np.zeros((len(sets), BINS), np.uint64)
    full = np.zeros((len(sets), BINS), bool)
    for i, s in enumerate(sets):
        at = np.searchsorted(s, EDGES)
        least = s[np.minimum(at, len(s) - 1)]
        full[i] = (at < len(s)) & (least >> np.uint64(64 - BIN_BITS) == np.arange(BINS, dtype=np.uint64))
        values[i] = least
    out = values.copy()
    doc, empty = np.nonzero(~full)
    for asked in range(BINS):
        if not len(doc):
            break
        giver = ASK[empty, asked]
        gives = full[doc, giver]
        out[doc[gives], empty[gives]] = values[doc[gives], giver[gives]]
        doc, empty = doc[~gives], empty[~gives]
    return out


def band_keys(rows: np.ndarray, width: int = ROWS) -> np.ndarray:
    """A key for each band of a signature; keys of different bands differ."""
    bands = rows.reshape(len(rows), BINS // width, width)
    keys = np.broadcast_to(np.arange(BINS // width, dtype=np.uint64), bands.shape[:2]).copy()
    for i in range(width):
        keys = _mixed(keys * MIX[0] + bands[:, :, i])
    return keys.view(np.int64)


def sketch(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, set_id, bands); ``set_id`` is null and ``bands`` empty without words."""

    def make(column):
        sets = [shingles(raw, size) for raw in binary_texts(column)]
        some = [i for i, s in enumerate(sets) if len(s)]
        keys = band_keys(signatures([sets[i] for i in some]))
        ids: list = [None] * len(sets)
        bands: list = [[]] * len(sets)
        for row, i in enumerate(some):
            ids[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest()
            bands[i] = keys[row]
        return {"n_shingles": [len(s) for s in sets], "set_id": ids, "bands": bands}

    added = "n_shingles long, set_id binary, bands array<long>"
    return with_columns(docs.select("doc_id", "text"), "text", make, added)


def counted(hashes: np.ndarray) -> bytes | None:
    """How many hashes fall into each of equal ranges, a byte each; None if one has too many."""
    bins = np.bincount((hashes >> np.uint64(64 - 9)).astype(np.int64), minlength=COUNTS)
    return bins.astype(np.uint8).tobytes() if bins.max() < 256 else None


def full_sets(docs: DataFrame, ids: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(id, n, counts, hashes) of the documents in ``ids``, a stored table."""
    if ids.count() <= SENT_IDS:
        ids = F.broadcast(ids)
    rows = docs.join(ids, docs["doc_id"] == ids["id"], "left_semi")

    def make(column):
        sets = [shingles(raw, size) for raw in binary_texts(column)]
        return {
            "n": [len(s) for s in sets],
            "counts": [counted(s) for s in sets],
            "hashes": [s.view(np.int64) for s in sets],
        }

    added = "n long, counts binary, hashes array<long>"
    rows = with_columns(rows.select("doc_id", "text"), "text", make, added)
    return rows.where("n > 0").withColumnRenamed("doc_id", "id")


def _sizes_allow(n: str, other: str, least: int) -> Column:
    """Sets whose sizes differ more cannot be similar enough."""
    return 100 * F.least(n, other) >= least * F.greatest(n, other)


def _sides(pairs: DataFrame, sets: DataFrame, column: str) -> DataFrame:
    """Pairs with (n, ``column``) of both sides as (one_n, one, other_n, other)."""
    first = sets.select(F.col("id").alias("a"), F.col("n").alias("one_n"), F.col(column).alias("one"))
    second = sets.select(F.col("id").alias("b"), F.col("n").alias("other_n"), F.col(column).alias("other"))
    return pairs.join(first, "a").join(second, "b")


def possible(pairs: DataFrame, sets: DataFrame, least: int = LEAST) -> DataFrame:
    """Those of ``pairs`` that their counts allow to be similar enough.

    Two sets share in each range at most the smaller of their counts, so nothing similar goes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, one_n, one, other_n, other = (batch.column(i) for i in range(6))
            sizes = one_n.to_numpy(), other_n.to_numpy()
            shared = np.minimum(*sizes)
            both = np.flatnonzero(pc.and_(one.is_valid(), other.is_valid()).to_numpy(False))
            if len(both):
                bins = [
                    np.frombuffer(b"".join(x.take(pa.array(both)).to_pylist()), np.uint8)
                    for x in (one, other)
                ]
                low = np.minimum(*bins).reshape(len(both), COUNTS).sum(1, dtype=np.int64)
                shared[both] = np.minimum(shared[both], low)
            fits = pa.array(100 * shared >= least * (sizes[0] + sizes[1] - shared))
            yield pa.RecordBatch.from_arrays([a.filter(fits), b.filter(fits)], names=["a", "b"])

    both = _sides(pairs, sets, "counts").select("a", "b", "one_n", "one", "other_n", "other")
    return both.mapInArrow(run, pairs.select("a", "b").schema)


def confirmed(pairs: DataFrame, sets: DataFrame, least: int = LEAST) -> DataFrame:
    """Those of ``pairs`` (a, b) whose full sets are similar enough."""
    both = _sides(possible(pairs, sets, least), sets, "hashes")
    inside = F.size(F.array_intersect("one", "other"))
    similar = 100 * inside >= least * (F.col("one_n") + F.col("other_n") - inside)
    return both.where(similar).select("a", "b")


def _shared_buckets(members: DataFrame) -> DataFrame:
    """(bucket, id, n, score) of buckets with several members; ``score`` is how many others an
    id meets over all its buckets."""
    sizes = members.groupBy("bucket").agg(
        F.count("*").alias("members"), F.min("id").alias("low"), F.max("id").alias("high")
    )
    sizes = settle(sizes.where("low <> high").select("bucket", "members"))
    own = F.sum(F.col("members") - 1).over(Window.partitionBy("id"))  # a row per band
    return settle(members.join(sizes, "bucket").withColumn("score", own).drop("members"))


def _first_pairs(shared: DataFrame, least: int) -> DataFrame:
    """Each member with the best centre of its buckets."""
    top = F.max(F.struct("score", "id", "n")).alias("top")
    centre = (
        shared.groupBy("bucket")
        .agg(top)
        .select(
            "bucket",
            F.col("top.score").alias("centre_score"),
            F.col("top.id").alias("centre"),
            F.col("top.n").alias("centre_n"),
        )
    )
    met = shared.join(centre, "bucket").where(F.col("id") != F.col("centre"))
    met = met.where(_sizes_allow("n", "centre_n", least))
    best = met.groupBy("id").agg(F.max(F.struct("centre_score", "centre")).alias("top"))
    return best.select("id", F.col("top.centre").alias("centre"))


def _ordered(pairs: DataFrame, one: str, other: str) -> DataFrame:
    return pairs.select(F.least(one, other).alias("a"), F.greatest(one, other).alias("b")).distinct()


def rare_shingles(sets: DataFrame, ids: DataFrame, least: int = LEAST) -> DataFrame:
    """(bucket, id, n, place): of the sets of ``ids``, the shingles that a similar set must share.

    Shingles are ordered by how many of these documents have them. If two sets are similar
    enough, one of the first n - least% * n + 1 of each is common. Shingles that one document
    has alone come first and need no row; ``place`` counts them.
    """
    rows = sets.join(ids, "id", "left_semi").withColumn("which", F.xxhash64("hashes"))
    rows = rows.select("id", "which", "n", F.explode("hashes").alias("bucket"))
    common = rows.groupBy("bucket").agg(F.count("*").alias("documents")).where("documents > 1")
    rows = rows.join(common, "bucket")
    own = Window.partitionBy("id", "which")
    by_rarity = own.orderBy("documents", "bucket")
    alone = F.col("n") - F.count("*").over(own)
    rows = rows.withColumn("place", alone + F.row_number().over(by_rarity) - 1)
    enough = F.ceil(F.col("n") * least / 100)
    return rows.where(F.col("place") <= F.col("n") - enough).select("bucket", "id", "n", "place")


def _with_component(shared: DataFrame, known: DataFrame) -> DataFrame:
    live = shared.join(known, "id", "left")
    return live.withColumn("component", F.coalesce("component", "id"))


def _unsettled(shared: DataFrame, known: DataFrame) -> DataFrame:
    """Ids in buckets with several components."""
    live = _with_component(shared, known)
    split = live.groupBy("bucket").agg(
        F.min("component").alias("low"), F.max("component").alias("high")
    )
    split = split.where("low <> high").select("bucket")
    return settle(shared.join(settle(split), "bucket").select("id").distinct())


def _open_buckets(finer: DataFrame, known: DataFrame) -> DataFrame:
    """Rows of buckets with several components, with their component, the bucket's largest one
    (``main``), and how many members are outside of it."""
    live = _with_component(finer, known)
    counts = live.groupBy("bucket", "component").agg(F.count("*").alias("members"))
    split = counts.groupBy("bucket").agg(
        F.max(F.struct("members", "component")).alias("main"), F.sum("members").alias("members")
    )
    split = split.select(
        "bucket",
        F.col("main.component").alias("main"),
        (F.col("members") - F.col("main.members")).alias("outside"),
    )
    return settle(live.join(settle(split.where("outside > 0")), "bucket"))


def _centres(live: DataFrame, most: int) -> DataFrame:
    """Members outside the largest component: all, or one of each of ``most`` parts.

    An id is a member with each of its sets.
    """
    few = F.col("outside") <= most
    part = F.when(few, F.col("id")).otherwise(F.pmod(F.xxhash64("id", "n", "place"), F.lit(most)))
    own = F.when(few, F.col("n")).alias("part_n"), F.when(few, F.col("place")).alias("part_place")
    outside = live.where("component <> main").groupBy("bucket", part.alias("part"), *own)
    chosen = outside.agg(F.max(F.struct("id", "n", "place", "component")).alias("top"))
    return settle(
        chosen.select(
            "bucket",
            F.col("top.id").alias("centre"),
            F.col("top.n").alias("centre_n"),
            F.col("top.place").alias("centre_place"),
            F.col("top.component").alias("centre_component"),
        )
    )


def _places_allow(least: int) -> Column:
    """If a shingle is the first that two sets share, they share at most what follows in either."""
    most = F.least(F.col("n") - F.col("place"), F.col("centre_n") - F.col("centre_place"))
    return (100 + least) * most >= least * (F.col("n") + F.col("centre_n"))


def _met(live: DataFrame, centres: DataFrame, least: int) -> DataFrame:
    """Pairs (a, b) of a centre and a member of another component that may be similar enough."""
    apart = F.col("component") != F.col("centre_component")
    met = live.join(centres, "bucket").where(apart & _places_allow(least))
    return _ordered(met, "id", "centre")


def _joined(known: DataFrame, links: DataFrame) -> DataFrame:
    """``known`` (id, component) after more links (a, b).

    Only the components that the links touch are worked on, as nodes of a graph of their own.
    """
    if links.isEmpty():
        return known
    for end in ("a", "b"):
        of_end = known.select(F.col("id").alias(end), "component")
        links = links.join(of_end, end, "left")
        links = links.withColumn(end, F.coalesce("component", end)).drop("component")
    roots = components(links.select("a", "b").distinct())
    to = roots.select(F.col("id").alias("component"), F.col("component").alias("new"))
    moved = known.join(to, "component", "left")
    moved = moved.select("id", F.coalesce("new", "component").alias("component"))
    return settle(moved.unionByName(roots.join(known, "id", "left_anti")))


def link(
    shared: DataFrame, sets: DataFrame, least: int = LEAST, links: DataFrame | None = None
) -> DataFrame:
    """(id, component) of the ids that have a link, from shared buckets and full sets, and from
    ``links`` (a, b) that are known before."""
    tried = settle(_ordered(_first_pairs(shared, least), "id", "centre"))
    stars = settle(confirmed(tried, sets, least))
    known = components(stars if links is None else stars.unionByName(links))
    finer = settle(rare_shingles(sets, _unsettled(shared, known), least))
    most = CENTRES
    while True:
        live = _open_buckets(finer, known)
        if live.isEmpty():
            return known
        centres = _centres(live, most)
        pairs = settle(_met(live, centres, least).join(tried, ["a", "b"], "left_anti"))
        known = _joined(known, settle(confirmed(pairs, sets, least)))
        tried = tried.unionAll(pairs)
        # a centre has met all that it may be linked with, so each round leaves fewer to meet
        over = centres.select(
            "bucket",
            F.col("centre").alias("id"),
            F.col("centre_n").alias("n"),
            F.col("centre_place").alias("place"),
        )
        finer = settle(live.select(*finer.columns).join(over, finer.columns, "left_anti"))
        most *= GROWTH


def _links_of_ids(sketches: DataFrame, copies: DataFrame) -> DataFrame | None:
    """Links (a, b) from each id with several texts to the first ids that have one of them."""
    which = F.xxhash64("set_id")
    ids = sketches.where("doc_id IS NOT NULL").groupBy("doc_id")
    ids = ids.agg(F.min(which).alias("low"), F.max(which).alias("high"))
    several = settle(ids.where("low <> high").select("doc_id"))
    if several.isEmpty():
        return None
    rows = sketches.select("doc_id", "set_id").join(several, "doc_id", "left_semi")
    found = rows.join(copies, "set_id").where("doc_id <> first")
    return settle(found.select(F.col("doc_id").alias("a"), F.col("first").alias("b")).distinct())


def near_duplicates(docs: DataFrame, least: int = LEAST, size: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document.

    ``docs`` needs doc_id and text; a shingle has ``size`` words. A component's id is its smallest doc_id, which is kept.
    """
    sketches = settle(sketch(docs, size))
    known = sketches.where("set_id IS NOT NULL AND doc_id IS NOT NULL")
    classes = known.groupBy("set_id").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    copies = settle(classes.where("n > 1").select("set_id", "first"))
    ones = known.join(copies, "set_id", "left").where("first IS NULL OR first = doc_id")
    members = ones.select(
        F.explode("bands").alias("bucket"), F.col("doc_id").alias("id"), F.col("n_shingles").alias("n")
    )
    shared = _shared_buckets(members)
    ids = settle(shared.select("id").distinct())
    linked = link(shared, settle(full_sets(docs, ids, size)), least, _links_of_ids(sketches, copies))
    linked = linked.where("id <> component")
    # of each document: the first with its set, then that one's component
    first = sketches.select("doc_id", "n_shingles", "set_id").join(copies, "set_id", "left")
    first = first.withColumn("first", F.when(F.col("doc_id").isNotNull(), F.coalesce("first", "doc_id")))
    out = first.join(linked, first["first"] == linked["id"], "left")
    component = F.coalesce("component", "first")
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def keep_first(docs: DataFrame, least: int = LEAST, size: int = SHINGLE) -> DataFrame:
    """``docs`` with one document of each component, and one row of each id: of the longest text."""
    found = settle(near_duplicates(docs, least, size))
    gone = settle(found.where("NOT kept").select("doc_id").distinct())
    left = docs.join(gone, docs["doc_id"].eqNullSafe(gone["doc_id"]), "left_anti")
    ids = found.where("kept AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n"))
    again = settle(ids.where("n > 1").select("doc_id"))
    if again.isEmpty():
        return left
    order = F.struct(F.char_length("text"), F.xxhash64(*docs.columns))
    once = left.join(again, "doc_id", "left_semi").groupBy("doc_id")
    once = once.agg(F.max_by(F.struct(*docs.columns), order).alias("row")).select("row.*")
    return left.join(again, "doc_id", "left_anti").unionByName(once)


def op4_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """The near-duplicate component of every document."""
    return near_duplicates(table(spark, folder, "documents", "doc_id", "text"))
