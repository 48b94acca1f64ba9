"""Feed files: which are accepted, what is in them, and what is set aside."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from checks.files import NEXT, ORDER_COLUMNS, ORDERS, RUN, orders_feed, spec_of
from checks.registry import query, table
from eventmart import fixed_values as fv
from eventmart.plans import landed, take_in
from eventmart.session import settle, work_dir
from eventmart.sources import read_optional, write_delimited, write_table
from eventmart.specs import FeedRules, load_specs, read_control
from eventmart.streaming import stream_feed


def _write_as(spark, df, path: str, **options) -> None:
    """Delimited files with headers, written in parallel, under numbered names of our own."""
    folder = f"{work_dir(spark)}/parts"
    options = {"header": True, "sep": "|"} | options
    # by a column, so that adaptive execution fits the files to the rows and leaves none empty
    df.repartition(df.columns[0]).write.options(**options).csv(folder)
    place = spark._jvm.org.apache.hadoop.fs.Path
    files = place(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    names = sorted(f.getPath().getName() for f in files.listStatus(place(folder)))
    files.mkdirs(place(path).getParent())
    stem, ending = path.rsplit(".", 1)
    for number, name in enumerate(n for n in names if n.startswith("part-")):
        files.rename(place(f"{folder}/{name}"), place(f"{stem} {number}.{ending}"))


def _set_of(name: str | Column) -> Column:
    """The name that numbered files of one set share."""
    return F.regexp_replace(name, r" [0-9]+(\.[a-z]+)", "$1")


def _mixed_files(spark, d) -> str:
    """Names with a space and a percent sign, a subfolder, a wrong name and a wrong header."""
    folder = f"{work_dir(spark)}/mixed"
    orders = orders_feed(spark, d)
    _write_as(spark, orders.where("status = 'F'"), f"{folder}/part-a b.csv")
    _write_as(spark, orders.where("status = 'O'"), f"{folder}/part-50%.csv")
    _write_as(spark, orders.where("status = 'P'"), f"{folder}/sub/part-a b.csv")
    _write_as(spark, orders, f"{folder}/part-c+d.txt")
    suppliers = table(spark, d, "supplier").select("s_suppkey", "s_name")
    _write_as(spark, suppliers, f"{folder}/part-s.csv")
    _write_as(spark, orders.where("status = 'none'"), f"{folder}/part-none.csv")
    return folder


@query(
    "intake_file_checks",
    """SELECT 'part-a b.csv' AS file_name, NULL AS reason, count(*) AS data_lines
       FROM orders WHERE o_orderstatus = 'F'
       UNION ALL SELECT 'part-50%.csv', NULL, count(*) FROM orders WHERE o_orderstatus = 'O'
       UNION ALL SELECT 'part-a b.csv', NULL, count(*) FROM orders WHERE o_orderstatus = 'P'
       UNION ALL SELECT 'part-c+d.txt',
         'File part-c+d.txt does not match expected pattern for event', 0
       UNION ALL SELECT 'part-s.csv',
         'Column mismatch. Expected: ["event_id", "event_date", "event_type", "status"], '
         || 'Found: ["s_suppkey", "s_name"]', count(*) FROM supplier
       UNION ALL SELECT 'part-none.csv', 'File is empty', 0""",
)
def intake_file_checks(spark, d):
    """Data lines and verdict of each set of files below one folder."""
    taken = take_in(spark, spec_of(_mixed_files(spark, d)), RUN, settle)
    found = taken.files.withColumns({
        "reason": _set_of(F.translate("reason", "'", '"')),
        "file_name": _set_of("file_name"),
        "folder": F.regexp_replace("path", "/[^/]*$", ""),
    })
    sets = found.groupBy("folder", "file_name", "reason")
    return sets.agg(F.sum("data_lines").alias("data_lines")).drop("folder")


@query("intake_subfolders", ORDERS)
def intake_subfolders(spark, d):
    """The rows of all accepted files, whatever their names and folders."""
    taken = take_in(spark, spec_of(_mixed_files(spark, d)), RUN, settle)
    return taken.rows.select(*ORDER_COLUMNS)


@query(
    "intake_stamp",
    "SELECT TIMESTAMP '2025-07-06 16:00:00' AS taken_in, count(*) AS n FROM orders",
)
def intake_stamp(spark, d):
    """The time that each row was taken in."""
    folder = f"{work_dir(spark)}/orders"
    write_delimited(orders_feed(spark, d), folder)
    rows = take_in(spark, spec_of(folder), RUN, settle).rows
    return rows.groupBy(F.col(fv.INTAKE_TIME).alias("taken_in")).agg(F.count("*").alias("n"))


@query(
    "intake_ragged_lines",
    """SELECT 'Malformed record' AS error_reason,
              o_orderkey || '|' || o_orderstatus AS malformed_line
       FROM orders WHERE o_orderstatus = 'F'
       UNION ALL SELECT 'Malformed record', o_orderkey || '|a|b|' || o_orderstatus || '|more'
       FROM orders WHERE o_orderstatus = 'P'""",
)
def intake_ragged_lines(spark, d):
    """Lines with too few or too many fields, with their reason."""
    folder, status = f"{work_dir(spark)}/ragged", F.col("o_orderstatus")
    orders, key = table(spark, d, "orders"), F.col("o_orderkey").cast("string")
    line = (
        F.when(status == "F", F.concat_ws("|", key, status))
        .when(status == "P", F.concat(key, F.lit("|a|b|"), status, F.lit("|more")))
        .otherwise(F.concat(key, F.lit("|a|b|"), status))
    )
    lines = orders.select(line.alias("|".join(ORDER_COLUMNS)), status.alias("_status"))
    for part in "FPO":
        of = lines.where(F.col("_status") == part).drop("_status")
        # one column, whose name is the header, and a separator that no line holds
        _write_as(spark, of, f"{folder}/part-{part}.csv", sep="\x01")
    taken = take_in(spark, spec_of(folder), RUN, settle)
    return taken.malformed.select("error_reason", "malformed_line")


@query(
    "handled_files",
    """SELECT 'first' AS run, count(DISTINCT o_orderstatus) AS files FROM orders
       UNION ALL SELECT 'again', 0 UNION ALL SELECT 'one more', 1""",
)
def handled_files(spark, d):
    """Sets of files that each run looks at: those of the ledger are left alone."""
    folder, orders = f"{work_dir(spark)}/inbound", orders_feed(spark, d)
    for status in [r[0] for r in orders.select("status").distinct().collect()]:
        _write_as(spark, orders.where(F.col("status") == status), f"{folder}/part-{status}.csv")
    first = take_in(spark, spec_of(folder), RUN, settle).files
    again = take_in(spark, spec_of(folder), NEXT, settle, ledger=first).files
    _write_as(spark, orders, f"{folder}/part-all.csv")
    more = take_in(spark, spec_of(folder), NEXT, settle, ledger=first).files
    runs = (("first", first), ("again", again), ("one more", more))
    counts = [f.agg(F.lit(n).alias("run"), F.count_distinct(_set_of("file_name")).alias("files")) for n, f in runs]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query(
    "control_table",
    """SELECT DISTINCT 'in/' || brand AS inbound, '|' AS sep, 'k,' || brand AS columns,
              'lm_' || brand AS feed_table
       FROM (SELECT replace(lower(p_brand), '#', '_') AS brand FROM part)""",
)
def control_table(spark, d):
    """A control table of the brands of all parts, written and read as one; a feed per row."""
    name = F.col("brand")
    brand = F.replace(F.lower("p_brand"), F.lit("#"), F.lit("_"))
    brands = table(spark, d, "part").select(brand.alias("brand")).distinct()
    control = brands.select(
        F.concat(F.lit("in/"), name).alias("inbound_location"),
        F.lit("pre").alias("preprocess_location"),
        F.lit("part-").alias("file_prefix"),
        F.lit("|").alias("delimiter"),
        F.concat(F.lit("k , "), name).alias("expected_column_list"),
        F.concat(F.lit("lm_"), name).alias("target_table_name"),
    )
    folder = f"{work_dir(spark)}/control"
    control.write.options(header=True, quoteAll=True).csv(folder)
    stored = read_control(spark, folder)
    names = [r[0] for r in brands.collect()]  # as many as the control table has rows
    specs = load_specs(stored, {n: FeedRules() for n in names})
    rows = [(s.inbound, s.sep, ",".join(s.columns), s.table) for s in specs.values()]
    schema = "inbound string, sep string, columns string, feed_table string"
    return spark.createDataFrame(rows, schema)


@query(
    "row_counts",
    """SELECT 'orders' AS name, count(*) AS n FROM orders
       UNION ALL SELECT 'lineitem', count(*) FROM lineitem
       UNION ALL SELECT 'exported', count(*) FROM customer""",
)
def row_counts(spark, d):
    """Rows as counted by the writes themselves."""
    folder = work_dir(spark)
    counts = [
        (n, write_table(table(spark, d, n), f"{folder}/{n}")) for n in ("orders", "lineitem")
    ]
    customers = table(spark, d, "customer").select("c_custkey", "c_name")
    counts.append(("exported", write_delimited(customers, f"{folder}/customers")))
    return spark.createDataFrame(counts, "name string, n long")


def _streamed(spark, d) -> str:
    """Two rounds of files through one query, the second with known and new orders and a file
    with a wrong name; then a second query over all files into the same table."""
    folder = work_dir(spark)
    spec = spec_of(f"{folder}/inbound")
    orders = orders_feed(spark, d)

    def go(checkpoint):
        stream_feed(
            spark, spec, f"{folder}/landing", f"{folder}/error", f"{folder}/{checkpoint}",
            clock=lambda: RUN,
        ).awaitTermination()

    orders.where("status = 'F'").write.options(header=True, sep="|").csv(spec.inbound)
    go("one")
    orders.write.mode("append").options(header=True, sep="|").csv(spec.inbound)
    other = orders.withColumn("event_id", F.concat(F.lit("x"), "event_id"))
    _write_as(spark, other, f"{spec.inbound}/part-other name.txt")
    go("one")
    go("two")
    return folder


@query("stream_intake", f"SELECT * FROM ({ORDERS}) WHERE event_type IS NOT NULL")
def stream_intake(spark, d):
    """No stored row is lost or repeated, whichever query brings it."""
    return landed(spark, f"{_streamed(spark, d)}/landing").select(*ORDER_COLUMNS)


@query(
    "stream_quarantine",
    f"""SELECT 'File part-other name.txt does not match expected pattern for event'
                 AS error_reason, 2 * count(*) AS n FROM orders
        UNION ALL SELECT 'Null value in key column', 2 * count(*)
        FROM ({ORDERS}) WHERE event_type IS NULL
        UNION ALL SELECT 'Duplicate key violation', 2 * count(*)
        FROM ({ORDERS}) WHERE event_type IS NULL AND status = 'F'""",
)
def stream_quarantine(spark, d):
    """What both queries set aside, by reason: the second sees closed orders twice at once."""
    errors = read_optional(spark, f"{_streamed(spark, d)}/error", merge=True)
    reason = _set_of(F.col("error_reason")).alias("error_reason")
    return errors.groupBy(reason).agg(F.count("*").alias("n"))
