import json

import pytest

from eventmart.__main__ import main, parse
from eventmart.specs import DEFAULT_RULES, Link, read_rules


@pytest.fixture
def world(tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "master").mkdir()
    (tmp_path / "in" / "LMHC_EVENT_20250706160000.csv").write_text(
        "event_vendor_id;event_date;event_type;event_brand;indication_name\n"
        "E1;2025-08-15;Program;Alpha;Flu\nE2;2025-08-15;Program;Beta|Alpha;\n"
    )
    (tmp_path / "in" / "LMHC_PARTICIPANT_20250706160000.csv").write_text(
        "participant_id;event_id;hcp_id;participant_type;registered;attended\n"
        "P1;E1;1;Speaker;Y;Y\nP2;E1;2;Speaker;Y;N\n"
    )
    masters = {
        "product_master": "source_product_name,Brand_name,Brand_id\nAlpha,Alpha,B1\n",
        "indication_master": "source_indication_name,indication_name,indication_id\nFlu,Flu,I1\n",
        "master_xref": "source_id,mdm_id\nP1,M1\n",
        "master_mdm_merge": "loser_mdm_id,winner_mdm_id\nM1,M2\n",
    }
    for name, text in masters.items():
        (tmp_path / "master" / f"{name}.csv").write_text(text)
    (tmp_path / "control.csv").write_text(
        "inbound_location,preprocess_location,file_prefix,delimiter,expected_column_list,"
        "target_table_name\n"
        f'{tmp_path}/in,{tmp_path}/pre,LMHC_EVENT,;,"event_vendor_id,event_date,event_type,'
        'event_brand,indication_name",lm_events\n'
        f'{tmp_path}/in,{tmp_path}/pre,LMHC_PART,;,"participant_id,event_id,hcp_id,'
        'participant_type,registered,attended",lm_participants\n'
    )
    (tmp_path / "rules.json").write_text(
        json.dumps({"event": {"aliases": {"event_id": "event_vendor_id"}}})
    )
    return tmp_path


def test_steps_add_up_to_a_run(spark, world, rows):
    def call(step):
        return main(
            [step, "--base", f"{world}/lake", "--control", f"{world}/control.csv", "--rules",
             f"{world}/rules.json", "--masters", f"{world}/master", "--run-ts", "2025-07-06T01:00"]
        )

    counts = {}
    for step in ("intake", "landing", "normalize", "marts", "export"):
        counts |= call(step)
    assert counts["landing lm_events"] == counts["outbound lm_participants"] == 2
    mart = spark.read.parquet(f"{world}/lake/summarized/product_performance_kpi")
    assert rows(mart) == [
        ("412|B1", "UNKNOWN|Alpha", 1, 0, 0, 0.0, "2025-07-06"),
        ("B1", "Alpha", 1, 2, 1, 1.0, "2025-07-06"),
    ]
    assert call("run") == counts


def test_rules_file(spark, world):
    path = world / "more.json"
    path.write_text(json.dumps({
        "address": {"keys": ["a", "b"], "links": [
            {"feed_type": "hcp_master", "columns": ["a"], "other_columns": ["c"]}]},
        "venue": {"required": ["v"], "file_pattern": "VENUE.*", "types": {"n": "int"},
                  "conditional": [["a", "Yes", "b"]], "dates": ["d"]},
    }))
    rules = read_rules(spark, str(path))
    assert rules["address"].keys == ("a", "b")
    assert rules["address"].links == (Link("hcp_master", ("a",), ("c",)),)
    assert rules["address"].required == DEFAULT_RULES["address"].required
    assert rules["venue"].required == ("v",)
    assert rules["venue"].conditional == (("a", "Yes", "b"),)
    assert (rules["venue"].types, rules["venue"].dates) == ({"n": "int"}, ("d",))
    assert rules["event"] == DEFAULT_RULES["event"]


@pytest.mark.parametrize(
    "argv", [["run", "--base", "b"], ["marts", "--base", "b"], ["walk", "--base", "b"],
             ["normalize", "--base", "b", "--control", "c"]],
)
def test_missing_arguments(argv):
    with pytest.raises(SystemExit):
        parse(argv)
