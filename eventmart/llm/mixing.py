"""Mixing sources to target weights.

Documents get hash-random keys. Within each source they are ordered by key, prefix sums of
their sizes are taken, and the order is cut at the source's budget; a budget above the source's
size repeats whole epochs first. Sums are distributed: per range of keys for all rows, then row
by row only inside the one range that holds the cut.

Defined cases: a null text has no words; null is a source of its own; documents without words
take nothing; repeated rows share a key, and if the cut falls on them they share what is left in
proportion to their sizes; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventmart.llm.shared import WORD, key_range, random_key, range_totals, same, table, unused
from eventmart.session import settle

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_EPOCHS = 2
CUT = ("epochs", "cut_key", "cut_id", "room", "cut_size")


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, key, span) of documents: all that mixing needs of them."""
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select("doc_id", "source", words.alias("size"), random_key("doc_id").alias("key"))
    return rows.withColumn("span", key_range("key"))


def numbered(sources: DataFrame) -> DataFrame:
    """Add ``place``: a source's place from 0 in the order of code points, null last.

    Sources are dealt out by range, numbered within each task, and shifted by the number of
    those in the tasks before.
    """
    ranged = settle(
        sources.repartitionByRange(F.col("source").asc_nulls_last()).withColumn(
            "task", F.spark_partition_id()
        )
    )
    ahead = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    shift = ranged.groupBy("task").agg(F.count("*").alias("n"))  # a row per task
    shift = shift.select("task", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("shift"))
    inside = Window.partitionBy("task").orderBy(F.col("source").asc_nulls_last())
    return (
        ranged.withColumn("inside", F.row_number().over(inside))
        .join(shift, "task")
        .withColumn("place", F.col("shift") + F.col("inside") - 1)
        .drop("task", "shift", "inside")
    )


def targets(
    sources: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST_EPOCHS,
) -> DataFrame:
    """Add ``target`` to (source, source_size): words that the mix should take of a source.

    Weights repeat over the sources in order. A target stops at ``most`` times the source's
    size; what is above is shared again by weight among the others, until none is above. Each
    round is one aggregation over the sources; only two sums reach the driver.
    """
    weight = F.element_at(
        F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int")
    )
    weighed = settle(
        numbered(sources)
        .withColumn("weight", weight)
        .withColumn("most", F.lit(most) * F.col("source_size"))
    )
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while True:
        capped = F.col("most") <= F.lit(level) * F.col("weight") if full >= 0 else F.lit(False)
        caps, free, count = weighed.agg(
            F.sum(F.when(capped, F.col("most")).otherwise(0)),
            F.sum(F.when(capped, 0).otherwise(F.col("weight"))),
            F.sum(F.when(capped, 1).otherwise(0)),
        ).first()
        if not free or count == full:
            break
        level, full = (share * total - caps) / free, count
    if not free:  # every source is at its limit
        target = F.col("most").cast("double")
    else:
        target = F.least(F.col("most").cast("double"), F.lit(level) * F.col("weight"))
    return weighed.select("source", "source_size", target.alias("target"))


def cuts(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted``, and where each source is cut: whole ``epochs``, then every document before (``cut_key``,
    ``cut_id``), then ``room`` words of the ``cut_size`` words of the documents that have these.

    Only the range of keys that holds the cut is ordered row by row.
    """
    budget = F.floor(F.col("target") + 0.5)
    filled = wanted.where("source_size > 0").select(
        "source",
        F.floor(budget / F.col("source_size")).alias("epochs"),
        (budget % F.col("source_size")).alias("rest"),
    )
    spans = range_totals(rows, ["source"], "span", F.col("size"))
    inside = "before <= rest AND rest < before + total"
    at = spans.join(filled, same(spans, filled, ["source"])).drop(filled["source"]).where(inside)
    at = settle(at.drop("total"))  # a row per source: joins below know its size
    near = rows.join(at, same(rows, at, ["source", "span"]), "inner").drop(at["source"], at["span"])
    near = near.groupBy("source", "key", "doc_id", "before", "rest", "epochs").agg(
        F.sum("size").alias("total")
    )
    ahead = (
        Window.partitionBy("source")
        .orderBy("key", "doc_id")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    near = near.withColumn(
        "before", F.col("before") + F.coalesce(F.sum("total").over(ahead), F.lit(0))
    )
    found = near.where(inside).select(
        "source",
        "epochs",
        F.col("key").alias("cut_key"),
        F.col("doc_id").alias("cut_id"),
        (F.col("rest") - F.col("before")).alias("room"),
        F.col("total").alias("cut_size"),
    )
    return settle(wanted.join(found, same(wanted, found, ["source"]), "left").drop(found["source"]))


def _extra(part) -> Column:
    """Words of a row beyond whole epochs; ``part`` gives its own facts and its source's cut."""
    key, cut = part("key"), part("cut_key")
    at_cut = (key == cut) & F.col("doc_id").eqNullSafe(part("cut_id"))
    # a null id comes first among equal keys
    earlier = (F.col("doc_id") < part("cut_id")) | (
        F.col("doc_id").isNull() & part("cut_id").isNotNull()
    )
    share = F.floor(part("room") * part("size") / part("cut_size"))
    whole = (key < cut) | ((key == cut) & earlier)
    return F.when(at_cut, share).when(whole, part("size")).otherwise(0).cast("long")


def mix(docs: DataFrame, **rule) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken): what a mix takes of each document.

    ``docs`` needs doc_id, text and source. ``rule`` is passed to ``targets``. Per source, the
    words taken add up to the target rounded to a whole word.
    """
    rows = settle(sized(docs))
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    at = cuts(rows, settle(targets(sources, **rule)))
    taken = F.coalesce(F.col("epochs") * F.col("size") + _extra(F.col), F.lit(0)).cast("long")
    out = rows.join(at, same(rows, at, ["source"])).drop(at["source"])
    return out.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"))


def mixed_documents(docs: DataFrame, **rule) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row per epoch of each document.

    The document at the cut gives its first words only. Documents of which nothing is taken go.
    Whole texts meet only one small row per source, so they move only if there are so many
    sources that those rows are too large to send to every task.
    """
    rows = settle(sized(docs))
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    at = cuts(rows, settle(targets(sources, **rule)))
    at = at.select(F.struct(*at.columns).alias(unused(docs, "cut")))
    cut, copies = at.columns[0], unused(docs, "copies")
    joined = docs.join(at, docs["source"].eqNullSafe(at[f"{cut}.source"]), "left")
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    facts = F.struct(
        words.alias("size"), random_key("doc_id").alias("key"), *(F.col(f"{cut}.{c}") for c in CUT)
    )
    rows = joined.withColumn(cut, facts)

    def part(name: str) -> Column:
        return F.col(f"{cut}.{name}")

    epochs = F.array_repeat(part("size"), F.coalesce(part("epochs"), F.lit(0)).cast("int"))
    lengths = F.filter(F.concat(epochs, F.array(_extra(part))), lambda n: n > 0)
    rows = rows.withColumn(copies, F.explode(lengths))
    pieces = F.regexp_extract_all("text", F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0))
    short = F.col(copies) < part("size")
    text = F.array_join(F.slice(pieces, F.lit(1), F.col(copies).cast("int")), "")
    rows = rows.withColumn("text", F.when(short, text).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        count = F.when(short, F.char_length("text")).otherwise(F.col("n_chars"))
        rows = rows.withColumn("n_chars", count.cast(docs.schema["n_chars"].dataType))
    return rows.select(*docs.columns)


def op3_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Every document and the words that the mix takes of it."""
    return mix(table(spark, folder, "documents", "doc_id", "text", "source"))


SQL = r"""
WITH sized AS (
    SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS key,
           CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
    FROM documents
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           [5, 2, 1][1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3] AS weight
    FROM sized GROUP BY source
), ordered AS (
    SELECT *, 2 * source_size AS cap, row_number() OVER (ORDER BY 2.0 * source_size / weight, source) AS i
    FROM sources
), levels AS (
    SELECT i, cap, weight,
           (1.5 * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY i ROWS BETWEEN
               UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
           / sum(weight) OVER (ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM ordered
), level AS (
    SELECT arg_min(level, i) AS level FROM levels WHERE level * weight < cap
), wanted AS (
    SELECT source, source_size,
           coalesce(least(CAST(cap AS DOUBLE), level * weight), CAST(cap AS DOUBLE)) AS target
    FROM ordered CROSS JOIN level
), placed AS (
    SELECT s.doc_id, s.source, s.size, w.source_size, w.target,
           CAST(floor(w.target + 0.5) AS BIGINT) AS budget,
           coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id ROWS BETWEEN
               UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM sized s JOIN wanted w ON s.source IS NOT DISTINCT FROM w.source
)
SELECT doc_id, source, source_size, target, size,
       CAST(CASE WHEN source_size = 0 THEN 0
            ELSE budget // source_size * size
                 + greatest(0, least(size, budget % source_size - before)) END AS BIGINT) AS taken
FROM placed
"""
