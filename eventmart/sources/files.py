"""Delimited feed files: what is there, what is in them, and reading them."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import and_
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
FILE_NAME = "source_file_name"
# Where a line came from: its file, and its place there if it is in the file's first block.
FILE_PATH = "source_file_path"
PLACE = "source_place"


def _escaped(path: str) -> str:
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def _glob(prefix: str) -> str:
    return _escaped(prefix) + "*"


def _one_form(path: Column) -> Column:
    """Paths as listings write them: local ones begin with one slash. Every line of a file has its
    path, so this and what follows go without regular expressions."""
    rest = F.ltrim(F.substring(path, len("file:") + 1, 1 << 30), F.lit("/"))
    local = F.startswith(path, F.lit("file:/"))
    return F.when(local, F.concat(F.lit("file:/"), rest)).otherwise(path)


def _decoded_path() -> Column:
    """The path of a row's file; the metadata column has it percent-encoded, if need be."""
    found = F.col("_metadata.file_path")
    decoded = F.url_decode(F.replace(found, F.lit("+"), F.lit("%2B")))
    return _one_form(F.when(F.contains(found, F.lit("%")), decoded).otherwise(found))


def _base_name(path: str) -> Column:
    return F.substring_index(path, "/", -1)


def manifest(spark: SparkSession, location: str, prefix: str = "") -> DataFrame:
    """The files below a folder whose name starts with ``prefix``, without opening them.

    ``path`` is the whole decoded path and the key of a file; names may repeat in subfolders.
    A scan passes over files without a single byte; those are added from the file listing
    the scan made, with the start of time as their modification time.
    """
    scan = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", _glob(prefix))
        .option("recursiveFileLookup", "true")
        .load(location)
    )
    path, name = _one_form(F.col("path")).alias("path"), _base_name("path").alias("file_name")
    filled = scan.select(path, "length", F.col("modificationTime").alias("modified_at"))
    filled = filled.select("path", name, "length", "modified_at")
    listed = spark.createDataFrame([(unquote(f),) for f in scan.inputFiles()], "path string")
    empty = (
        listed.select(path)
        .select("path", name)
        .where(F.col("file_name").startswith(prefix))
        .join(filled.select("path"), "path", "left_anti")
        .select(
            "path",
            "file_name",
            F.lit(0).cast("long").alias("length"),
            F.timestamp_seconds(F.lit(0)).alias("modified_at"),
        )
    )
    return filled.unionByName(empty)


def text_schema(columns: Sequence[str]) -> T.StructType:
    """Every column as text, plus the line itself when it does not fit the columns."""
    return T.StructType([T.StructField(c, T.StringType()) for c in [*columns, CORRUPT]])


def _options(sep: str, header: bool = True) -> dict[str, object]:
    return {
        "header": header,
        "sep": sep,
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
        # With pruning on, a query of some columns would not notice a ragged line.
        "columnPruning": False,
    }


def read_delimited(
    spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str], sep: str
) -> DataFrame:
    """Rows of header-first delimited files as text, all files in one DataFrame.

    ``_corrupt_record`` is set for a line with too few or too many fields, and
    ``source_file_name`` tells where a row came from.
    """
    files = [paths] if isinstance(paths, str) else list(paths)
    rows = spark.read.schema(text_schema(columns)).options(**_options(sep)).csv(files)
    return rows.select("*", _decoded_path().alias(FILE_PATH)).select(
        *rows.columns, _base_name(FILE_PATH).alias(FILE_NAME)
    )


def _located(rows: DataFrame) -> DataFrame:
    return rows.select(
        "*",
        _decoded_path().alias(FILE_PATH),
        (F.col("_metadata.file_block_start") == 0).alias(PLACE),
    )


def placed(rows: DataFrame) -> DataFrame:
    """Number the lines of first blocks: numbers grow along a block, where the header is."""
    number = F.when(F.col(PLACE), F.monotonically_increasing_id())
    return rows.withColumns({PLACE: number, FILE_NAME: _base_name(FILE_PATH)})


def read_lines(
    spark: SparkSession, paths: Sequence[str], columns: Sequence[str], sep: str
) -> DataFrame:
    """All lines of delimited files as rows of text, headers among them.

    Like ``read_delimited``, with the path and place of a line, by which ``file_facts`` tells
    headers from data. So a file is read once, whatever its checks say.
    """
    reader = spark.read.schema(text_schema(columns)).options(**_options(sep, header=False))
    return placed(_located(reader.csv([_escaped(p) for p in paths])))


def stream_lines(
    spark: SparkSession,
    location: str,
    columns: Sequence[str],
    sep: str,
    prefix: str = "",
    max_files: int | None = None,
    archive: str | None = None,
) -> DataFrame:
    """The same lines as a stream, to be numbered per batch with ``placed``.

    The checkpoint of the query remembers which files are done. With ``archive``, files of
    completed batches move there.
    """
    reader = (
        spark.readStream.schema(text_schema(columns))
        .options(**_options(sep, header=False))
        .option("pathGlobFilter", _glob(prefix))
        .option("recursiveFileLookup", "true")
    )
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return _located(reader.csv(location))


def file_facts(lines: DataFrame, columns: Sequence[str], corrupt: str = CORRUPT) -> DataFrame:
    """Per file: the place of its first line, whether that is the expected header, data lines.

    From parsed lines with path and place. Only numbers are aggregated, partly in each task, so
    a task passes on one line per file it saw, however large the file.
    """
    named = [F.col(c).eqNullSafe(F.lit(c)) for c in columns]
    is_header = reduce(and_, named, F.col(corrupt).isNull())
    facts = lines.groupBy(FILE_PATH).agg(
        F.min(PLACE).alias("header_place"),
        F.min(F.when(is_header, F.col(PLACE))).alias("first_header"),
        F.count("*").alias("lines"),
    )
    return facts.select(
        F.col(FILE_PATH).alias("path"),
        "header_place",
        F.coalesce(F.col("header_place") == F.col("first_header"), F.lit(False)).alias("header_ok"),
        (F.col("lines") - 1).alias("data_lines"),
    )


def found_headers(
    lines: DataFrame, wrong: DataFrame, columns: Sequence[str], sep: str, corrupt: str = CORRUPT
) -> DataFrame:
    """The names in the first lines of the files in ``wrong`` (path, header_place)."""
    first = lines.where(F.col(PLACE).isNotNull()).join(
        wrong, (F.col(FILE_PATH) == F.col("path")) & (F.col(PLACE) == F.col("header_place"))
    )
    plain = F.replace(corrupt, F.lit('"'), F.lit(""))
    names = F.coalesce(F.split(plain, re.escape(sep)), F.array(*columns))
    return first.select("path", names.alias("found"))


def read_master(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Master data: comma-delimited with a header, all text unless a schema is given."""
    reader = spark.read.option("header", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)
