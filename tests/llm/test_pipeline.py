"""The registered queries against SQL, and the pipeline against its stages done by hand."""

import inspect
import os
from collections import defaultdict

import duckdb
import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from eventmart.llm import packing, secrets, site_quality
from eventmart.llm.queries import ORACLE, QUERIES
from test_mixing import by_hand as mixed_by_hand
from test_near_duplicates import by_hand as components_by_hand

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")


@pytest.mark.parametrize("name", ["op3_mix_sources", "op7_round_trip_archives"])
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "pages"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{FOLDER}/{table}.parquet')")
    want = duck.execute(ORACLE[name])
    names = [c[0] for c in want.description]
    got = QUERIES[name](spark, FOLDER)
    assert sorted(got.columns) == sorted(names)
    rows = sorted(map(str, want.fetchall()))
    assert rows and sorted(str(tuple(r)) for r in got.select(*names).collect()) == rows


def test_all_are_registered():
    queries = entry_points.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in queries) == 1
    assert "pipeline" in queries and corpus_pipeline.ORACLE_SQL is None
    assert [name for name, _ in corpus_pipeline.STAGES][-1] == "packing"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows after each stage, each from the table that the one before wrote."""
    folder = str(tmp_path_factory.mktemp("stages"))
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out, columns = {"documents": docs.collect()}, docs.columns
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, FOLDER)
        assert name == "packing" or made.columns == columns
        made.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        out[name] = docs.collect()
    return out


def test_quality_keeps_what_the_query_keeps(spark, stages):
    kept = {r["doc_id"] for r in QUERIES["op1_classify_quality"](spark, FOLDER).collect() if r["kept"]}
    assert {r["doc_id"] for r in stages["quality"]} == kept
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").collect()
    good = [r["doc_id"] in kept for r in labels if r["quality"] == 1]
    bad = [r["doc_id"] in kept for r in labels if r["quality"] == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.1 * len(bad)


def test_one_of_each_group_stays(stages):
    rows = [(r["doc_id"], r["text"]) for r in stages["quality"]]
    assert {r["doc_id"] for r in stages["near_duplicates"]} == set(components_by_hand(rows, 5).values())


def test_secrets_are_masked(stages):
    before = {r["doc_id"]: r for r in stages["near_duplicates"]}
    assert len(before) == len(stages["secrets"])
    changed = 0
    for r in stages["secrets"]:
        spans = secrets.find_secrets(before[r["doc_id"]]["text"].encode())[1]
        changed += bool(spans)
        assert (r["text"] != before[r["doc_id"]]["text"]) == bool(spans)
        assert r["n_chars"] == len(r["text"])
        assert not secrets.base_spans(r["text"])
    assert changed


def test_the_mix_takes_what_plain_sorts_take(stages):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in stages["secrets"]]
    _, taken = mixed_by_hand(rows)
    words = defaultdict(int)
    for r in stages["mixing"]:
        words[r["doc_id"]] += len(r["text"].split())
    assert dict(words) == {rows[i][0]: n for i, n in taken.items() if n}


def test_every_row_of_the_mix_is_packed(stages):
    path = packing.vocabulary_path()
    want = defaultdict(int)
    for r in stages["mixing"]:
        want[r["doc_id"]] += len(packing.token_ids(r["text"], path))
    got, sequences = defaultdict(int), defaultdict(int)
    ids = defaultdict(list)
    for r in stages["packing"]:
        assert len(r["ids"]) == r["length"]
        ids[r["sequence_id"]].append((r["offset"], r["ids"]))
        got[r["doc_id"]] += r["length"]
        sequences[r["sequence_id"]] += r["length"]
    assert got == want and max(sequences.values()) <= 1024
    for n, parts in ids.items():  # the stored ids fill their sequence without a gap
        ends = [offset + len(part) for offset, part in sorted(parts)]
        assert [0, *ends[:-1]] == [offset for offset, _ in sorted(parts)] and ends[-1] == sequences[n]


def test_run_gives_the_last_stage(spark, stages):
    key = lambda r: (r["doc_id"], r["start"], r["length"], r["ids_crc32"])
    got = sorted(map(key, corpus_pipeline.run(spark, FOLDER).collect()))
    assert got == sorted(map(key, stages["packing"]))


def test_stages_take_odd_and_empty_tables(spark, odd, no_docs):
    for docs in (odd, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, FOLDER)
            assert name == "packing" or out.columns == docs.columns
            rows = out.collect()
            assert bool(rows) == (docs is odd)


def test_import_errors_are_not_swallowed():
    assert "except" not in inspect.getsource(corpus_pipeline)
    assert site_quality.fit
