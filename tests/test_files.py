import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from eventmart import fixed_values as fv
from eventmart.plans import export_latest, intake, take_in
from eventmart.session import (
    PARTITIONS,
    Workspace,
    fit_shuffles,
    fitted_shuffles,
    open_files,
    scratch,
    settle,
    stored_bytes,
    work_dir,
)
from eventmart.sources import (
    file_facts,
    manifest,
    read_delimited,
    read_lines,
    read_master,
    read_optional,
    write_table,
)
from eventmart.specs import (
    DEFAULT_RULES,
    FeedSpec,
    load_specs,
    named_like,
    read_control,
)
from eventmart.streaming import stream_feed

RUN = dt.datetime(2025, 7, 6, 16)
DELETE_COLUMNS = ("event_id", "deletion_reason", "deletion_date")


def spec(folder, feed_type="event_del", prefix="LMHC_EVENT", sep=",", columns=DELETE_COLUMNS):
    return FeedSpec(
        feed_type, f"lm_{feed_type}", str(folder), f"{folder}-preprocess", prefix, sep, columns,
        DEFAULT_RULES[feed_type],
    )


@pytest.fixture
def inbound(tmp_path):
    folder = tmp_path / "in box"
    folder.mkdir()

    def add(name, text):
        (folder / name).write_text(text)

    head = "event_id,deletion_reason,deletion_date\n"
    add("LMHC_EVENT_DEL_20250706160000.csv", head + 'E1,"Low, RSVP",2025-07-03\n\nE2,,2025-07-04\n')
    add("lmhc_event_del_20250706170000.CSV", "wrong case of prefix\n")
    add("LMHC_EVENT_del_20250706180000.csv", '"event_id","deletion_reason","deletion_date"\nE3,x,2025-07-04\n')
    add("LMHC_EVENT_DEL_2025.csv", head + "E4,x,2025-07-04\n")
    add("LMHC_EVENT_DEL_20250706190000.csv", head + "\n  \n")
    add("LMHC_EVENT_DEL_20250706200000.csv", "")
    add("LMHC_EVENT_DEL_20250706210000.csv", "event_id,deletion_date,deletion_reason\nE5,2025-07-04,x\n")
    add("LMHC_EVENT_DEL_20250706220000.csv", head + "E6,x\nE7,x,2025-07-04,more\nE8,x,2025-07-04\n")
    add("LMHC_EVENT_20250706160000.csv", "belongs to another feed\n")
    return folder


def test_manifest_lists_by_prefix_without_reading(spark, inbound):
    files = manifest(spark, str(inbound), "LMHC_EVENT_DEL")
    assert files.count() == 6
    assert "content" not in files._jdf.queryExecution().executedPlan().toString()
    row = files.where(F.col("file_name") == "LMHC_EVENT_DEL_20250706200000.csv").first()
    assert row["length"] == 0


def test_file_checks_and_reading(spark, inbound, rows):
    taken = take_in(spark, spec(inbound), RUN, settle, [spec(inbound, "event")])
    reasons = {r.file_name: r.reason for r in taken.files.collect()}
    found = ["event_id", "deletion_date", "deletion_reason"]
    mismatch = f"Column mismatch. Expected: {list(DELETE_COLUMNS)}, Found: {found}"
    assert reasons == {
        "LMHC_EVENT_DEL_20250706160000.csv": None,
        "LMHC_EVENT_del_20250706180000.csv": None,
        "LMHC_EVENT_DEL_2025.csv": "File LMHC_EVENT_DEL_2025.csv does not match expected "
        "pattern for event_del",
        "LMHC_EVENT_DEL_20250706190000.csv": "File is empty",
        "LMHC_EVENT_DEL_20250706200000.csv": "File is empty",
        "LMHC_EVENT_DEL_20250706210000.csv": mismatch,
        "LMHC_EVENT_DEL_20250706220000.csv": None,
    }
    assert rows(taken.rows, *DELETE_COLUMNS) == [
        ("E1", "Low, RSVP", "2025-07-03"), ("E2", None, "2025-07-04"),
        ("E3", "x", "2025-07-04"), ("E8", "x", "2025-07-04"),
    ]
    assert rows(taken.malformed, "malformed_line") == [("E6,x",), ("E7,x,2025-07-04,more",)]
    assert {r[fv.INTAKE_TIME] for r in taken.rows.collect()} == {RUN}
    # Fewer columns must not hide a ragged line.
    assert taken.rows.select("event_id").count() == 4
    assert taken.rows.count() == 4


def test_handled_files_are_skipped_until_they_change(spark, inbound):
    first = take_in(spark, spec(inbound), RUN, settle)
    again = take_in(spark, spec(inbound), RUN, settle, ledger=first.files)
    assert again.files.count() == 0
    assert again.rows is None
    (inbound / "LMHC_EVENT_DEL_20250706200000.csv").write_text(
        "event_id,deletion_reason,deletion_date\nE9,x,2025-07-04\n"
    )
    third = take_in(spark, spec(inbound), RUN, settle, ledger=first.files)
    assert [r.event_id for r in third.rows.collect()] == ["E9"]


def test_feed_type_without_pattern_is_unknown(spark, inbound):
    taken = take_in(spark, spec(inbound, "expenses"), RUN, settle)
    assert {r.reason for r in taken.files.collect()} == {"Unknown file type: expenses"}


def test_file_facts_over_many_splits(spark, tmp_path):
    path = tmp_path / "long.csv"
    path.write_text("a|b\n" + "a|b\n" * 5 + "1|2\n" * 20000)
    limit = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        facts = file_facts(read_lines(spark, [str(path)], ["a", "b"], "|"), ["a", "b"]).first()
        wrong = file_facts(read_lines(spark, [str(path)], ["1", "2"], "|"), ["1", "2"]).first()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", limit)
    assert (facts.header_ok, facts.data_lines) == (True, 20005)
    assert wrong.header_ok is False


def test_control_table(spark, tmp_path):
    path = tmp_path / "control.csv"
    head = "inbound_location,preprocess_location,file_prefix,delimiter,expected_column_list,target_table_name\n"
    path.write_text(
        head + '/in,/pre,LMHC_EVENT_2,",","event_id, event_date ",lm_events\n'
        "/in,/pre,LMHC_EVENT_DEL,|,event_id,LM_EVENT_DEL\n"
    )
    control = read_control(spark, str(path))
    specs = load_specs(control)
    assert set(specs) == {"event", "event_del"}
    assert specs["event"].columns == ("event_id", "event_date")
    assert specs["event"].preprocess_path == "/pre/lm_events"
    assert specs["event_del"].sep == "|"
    assert named_like(control, "target_table_name", "EVENT").count() == 2
    assert named_like(control, "target_table_name", "m_event_").count() == 1
    with pytest.raises(ValueError, match="address is linked to feeds without control row"):
        load_specs(control.where("target_table_name = 'lm_events'").replace("lm_events", "lm_address"))
    with pytest.raises(ValueError, match="Unknown feed type: other"):
        load_specs(control.withColumn("feed_type", F.lit("other")))
    path.write_text("inbound_location,delimiter\n/in,|\n")
    with pytest.raises(ValueError, match="preprocess_location, file_prefix"):
        read_control(spark, str(path))


def test_master_data_names_ignore_case(spark, tmp_path):
    path = tmp_path / "product.csv"
    path.write_text("source_product_name,Brand_name,Brand_id\nA,Alpha,1\n")
    assert read_master(spark, str(path)).select("brand_id").first().brand_id == "1"


def test_tables(spark, tmp_path, rows):
    path = str(tmp_path / "table")
    assert read_optional(spark, path) is None
    assert write_table(spark.range(5), path) == 5
    assert write_table(spark.range(3), path) == 3
    assert read_optional(spark, path).count() == 3
    parts = str(tmp_path / "parts")
    both = spark.createDataFrame([(1, "x"), (2, "y")], "v int, p string")
    write_table(both, parts, ["p"])
    write_table(both.where("p = 'x'").withColumn("v", F.lit(9)), parts, ["p"])
    assert rows(spark.read.parquet(parts), "v", "p") == [(2, "y"), (9, "x")]
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        read_optional(spark, str(tmp_path / "broken")).count()


def test_export(spark, tmp_path, rows):
    df = spark.createDataFrame(
        [("a|b", 1), ("c", 2), (None, 2)], "name string, oasis_modified_date int"
    )
    path, count = export_latest(df, "lm_events", str(tmp_path), RUN.date())
    assert path.endswith("/OUT_LM_EVENTS_20250706.csv")
    assert count == 2
    back = read_delimited(spark, path, ["name", "oasis_modified_date"], "|")
    assert rows(back, "name", "oasis_modified_date") == [(None, "2"), ("c", "2")]
    export_latest(df.drop("oasis_modified_date"), "lm_events", str(tmp_path), RUN.date())
    assert rows(read_delimited(spark, path, ["name"], "|"), "name") == [("a|b",), ("c",)]


def test_stream(spark, inbound, tmp_path, rows):
    feed = spec(inbound)
    landing, errors = str(tmp_path / "landing"), str(tmp_path / "errors")

    def go(checkpoint="checkpoint"):
        stream_feed(
            spark, feed, landing, errors, str(tmp_path / checkpoint), clock=lambda: RUN
        ).awaitTermination()
        stored = spark.read.option("mergeSchema", True).parquet(landing)
        number = F.substring("load_batch", -9, 9).cast("int").alias("number")
        return rows(stored.select("event_id", number), "event_id", "number")

    first = [(k, 0) for k in ("E1", "E2", "E3", "E8")]
    assert go() == first
    (inbound / "LMHC_EVENT_DEL_20250707160000.csv").write_text(
        "event_id,deletion_reason,deletion_date\nE1,again,2025-07-09\nE9,x,2025-07-09\nE10,x,\n"
    )
    assert go() == sorted([*first, ("E9", 1)])
    assert go() == sorted([*first, ("E9", 1)])
    rejected = spark.read.option("mergeSchema", True).parquet(errors)
    reasons = [
        (f"Column mismatch. Expected: {list(DELETE_COLUMNS)}", 1),
        ("File LMHC_EVENT_DEL_2025.csv does not match expected pattern for event_del", 1),
        ("Malformed record", 2),
        ("Null value in key column", 1),
    ]
    assert rows(rejected.groupBy("error_reason").count()) == reasons
    # A query with a checkpoint of its own replaces nothing that is stored.
    (inbound / "LMHC_EVENT_DEL_20250708160000.csv").write_text(
        "event_id,deletion_reason,deletion_date\nE11,x,2025-07-09\n"
    )
    assert go("another") == sorted([*first, ("E9", 1), ("E11", 0)])
    rejected = spark.read.option("mergeSchema", True).parquet(errors)
    assert rows(rejected.groupBy("error_reason").count()) == [(r, 2 * n) for r, n in reasons]


def test_streams_need_a_pattern(spark, inbound):
    with pytest.raises(ValueError, match="no file pattern"):
        stream_feed(spark, spec(inbound, "expenses"), "a", "b", "c")


def test_stream_leaves_the_files_of_others(spark, inbound, tmp_path):
    (inbound / "LMHC_EVENT_20250706160000.csv").write_text("event_id\nX1\n")
    errors = str(tmp_path / "errors")
    stream_feed(
        spark, spec(inbound), str(tmp_path / "landing"), errors, str(tmp_path / "checkpoint"),
        clock=lambda: RUN, others=[spec(inbound, "event")],
    ).awaitTermination()
    rejected = spark.read.option("mergeSchema", True).parquet(errors)
    assert rejected.where("error_reason LIKE '%LMHC_EVENT_2025%'").count() == 0


def test_odd_names_and_subfolders(spark, tmp_path, rows):
    """The whole decoded path is the key of a file, by run and by stream."""
    folder = tmp_path / "in box"
    (folder / "sub %41").mkdir(parents=True)
    head = ",".join(DELETE_COLUMNS) + "\n"
    names = ["f a.csv", "f%20b.csv", "f+c.csv", "f[1].csv", "sub %41/f a.csv", "sub %41/f%.csv"]
    for i, name in enumerate(names):
        (folder / name).write_text(head + f"E{i},x,2025-07-04\n")
    (folder / "f d.csv").write_text("")
    rules = replace(DEFAULT_RULES["event_del"], file_pattern=r"f.*\.csv$")
    feed = replace(spec(folder, prefix="f"), rules=rules)
    taken = take_in(spark, feed, RUN, settle)
    want = [(f"E{i}", n.rsplit("/")[-1]) for i, n in enumerate(names)]
    assert rows(taken.rows, "event_id", "source_file_name") == want
    assert rows(taken.files, "file_name", "reason") == sorted(
        [(n, None) for _, n in want] + [("f d.csv", "File is empty")]
    )
    assert take_in(spark, feed, RUN, settle, ledger=taken.files).files.count() == 0
    landing = str(tmp_path / "landing")
    for _ in range(2):
        stream_feed(
            spark, feed, landing, str(tmp_path / "errors"), str(tmp_path / "checkpoint"),
            clock=lambda: RUN,
        ).awaitTermination()
    assert rows(spark.read.parquet(landing), "event_id", "source_file_name") == want


def test_files_are_read_once(spark, tmp_path):
    """Checks look at the parsed lines; no second scan of the files is planned."""
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "LMHC_EVENT_DEL_20250706160000.csv").write_text(
        ",".join(DELETE_COLUMNS) + "\nE1,x,2025-07-04\n"
    )
    taken = take_in(spark, spec(folder), RUN, settle)
    (folder / "LMHC_EVENT_DEL_20250706160000.csv").unlink()
    assert [r.event_id for r in taken.rows.collect()] == ["E1"]
    assert taken.malformed.count() == 0
    text = taken.rows._jdf.queryExecution().executedPlan().toString()
    assert "FileScan csv" not in text and "FileScan text" not in text


def test_stream_archives_handled_files(spark, inbound, tmp_path):
    archive = tmp_path / "archive"
    for name in ("LMHC_EVENT_DEL_20250801000000.csv", "LMHC_EVENT_DEL_20250802000000.csv"):
        stream_feed(
            spark, spec(inbound), str(tmp_path / "landing"), str(tmp_path / "errors"),
            str(tmp_path / "checkpoint"), archive=str(archive), clock=lambda: RUN,
        ).awaitTermination()
        (inbound / name).write_text("event_id,deletion_reason,deletion_date\nX,x,2025-07-09\n")
    stream_feed(
        spark, spec(inbound), str(tmp_path / "landing"), str(tmp_path / "errors"),
        str(tmp_path / "checkpoint"), archive=str(archive), clock=lambda: RUN,
    ).awaitTermination()
    archived = {p.name for p in archive.rglob("*.csv")}
    assert "LMHC_EVENT_DEL_20250706160000.csv" in archived


def test_stream_keeps_looking(spark, inbound, tmp_path):
    landing = str(tmp_path / "landing")
    query = stream_feed(
        spark, spec(inbound), landing, str(tmp_path / "errors"), str(tmp_path / "checkpoint"),
        every="1 second",
    )
    try:
        query.processAllAvailable()
        (inbound / "LMHC_EVENT_DEL_20250803000000.csv").write_text(
            "event_id,deletion_reason,deletion_date\nX,x,2025-07-09\n"
        )
        query.processAllAvailable()
    finally:
        query.stop()
    stored = {r.event_id for r in spark.read.parquet(landing).collect()}
    assert stored == {"E1", "E2", "E3", "E8", "X"}


def test_stream_of_files_without_rows(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "LMHC_EVENT_DEL_20250706160000.csv").write_text(",".join(DELETE_COLUMNS) + "\n")
    landing = str(tmp_path / "landing")
    stream_feed(
        spark, spec(folder), landing, str(tmp_path / "errors"), str(tmp_path / "checkpoint")
    ).awaitTermination()
    assert spark.read.parquet(landing).count() == 0


def test_linked_feeds_do_not_stream(spark, inbound):
    with pytest.raises(ValueError, match="batch run"):
        stream_feed(spark, spec(inbound, "address"), "a", "b", "c")


class FakeSession:
    """A session whose settings a test can choose."""

    def __init__(self, settings, master="spark://host", folder=None):
        self.conf = settings
        self.sparkContext = self
        self.master = master
        self.folder = folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_work_dir_is_the_shared_folder():
    named = FakeSession({"spark.checkpoint.dir": "/shared/place/"})
    assert work_dir(named).startswith("/shared/place/eventmart-")
    assert work_dir(FakeSession({}, folder="/other")).startswith("/other/eventmart-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_dir(FakeSession({}))
    local = FakeSession({}, "local[2]")
    assert work_dir(local).startswith(local.folder)


def test_workspace_removes_only_its_own_folder(spark):
    with Workspace(spark) as work:
        table = work.settle(spark.range(3))
        assert table.count() == 3
        kept = settle(table)
    assert kept.count() == 3
    assert read_optional(spark, f"{work.folder}/table_0") is None


def test_shuffle_partitions_follow_the_inputs(spark, tmp_path):
    before = spark.conf.get(PARTITIONS)
    spark.range(10000).write.parquet(str(tmp_path / "t"))
    size = stored_bytes(spark, str(tmp_path / "t"), str(tmp_path / "missing"))
    assert size > 10000
    try:
        assert fit_shuffles(spark, 0) == int(before)
        assert fit_shuffles(spark, size, 1000) == -(-size // 1000)
        # What was fitted before has no say.
        assert fit_shuffles(spark, 0) == int(before)
        # No number is too large.
        assert fit_shuffles(spark, 10**14) == -(-(10**14) // (512 * 1024 * 1024))
    finally:
        spark.conf.set(PARTITIONS, before)
    with fitted_shuffles(spark, 10**12) as partitions:
        assert int(spark.conf.get(PARTITIONS)) == partitions > int(before)
    assert spark.conf.get(PARTITIONS) == before


def test_scratch_ends_with_its_scope(spark):
    with scratch(spark) as work:
        table = settle(spark.range(3))
        assert table.count() == 3
    assert read_optional(spark, f"{work.folder}/table_0") is None


def test_paths_of_lines_need_no_regular_expressions(spark, tmp_path):
    """Every line has its path; plain, encoded and odd ones are told as the listing has them."""
    names = ["a.csv", "a b.csv", "c+d%.csv", "e%20f.csv"]
    for name in names:
        (tmp_path / name).write_text("k|v\n1|x\n")
    lines = read_lines(spark, [str(tmp_path / n) for n in names], ["k", "v"], "|")
    found = {tuple(r) for r in lines.select("source_file_path", "source_file_name").collect()}
    listed = manifest(spark, str(tmp_path)).select("path", "file_name")
    assert found == {tuple(r) for r in listed.collect()}
    assert {name for _, name in found} == set(names)
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp" not in plan and "split(" not in plan


def test_staged_lines_are_not_sorted_by_kind(spark, tmp_path, monkeypatch):
    key, seen = "spark.sql.maxConcurrentOutputFileWriters", []
    before = spark.conf.get(key)

    def write(*args, **options):
        seen.append(spark.conf.get(key))
        return write_table(*args, **options)

    (tmp_path / "a.csv").write_text("k|v\n1|x\n2\n3|y|z\n4|w\n")
    monkeypatch.setattr(intake, "write_table", write)
    lines = read_lines(spark, [str(tmp_path / "a.csv")], ["k", "v"], "|")
    staged = intake.stage(lines, str(tmp_path / "staged"))
    kinds = {r.k: r.line_kind for r in staged.collect()}
    assert kinds == {"k": "rows", "1": "rows", "2": "malformed", "3": "malformed", "4": "rows"}
    assert (seen, spark.conf.get(key)) == (["2"], before)
    with pytest.raises(ValueError), open_files(spark, 5):
        raise ValueError
    assert spark.conf.get(key) == before
