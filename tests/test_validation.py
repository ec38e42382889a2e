from datetime import datetime

import pytest
from pyspark.sql import functions as F

from meterlake.operators import facts, validation as V
from meterlake.schemas import RAW_INTERACTION
from meterlake.sources.interactions import as_messages, decode_json, read_interactions

GOOD = ('{"interaction_id":"a","user_id":"u","model":"gpt-4","provider":"openai","prompt":"hi","response":"",'
        '"input_tokens":1,"output_tokens":2,"latency_ms":3.5,"cost_usd":0.1}')


def reasons(frame, key="interaction_id"):
    return {r[key]: list(r[V.REASONS]) for r in frame.collect()}


@pytest.mark.parametrize("change,reason", [
    ({"prompt": "  "}, "prompt_blank"), ({"provider": "other"}, "provider_unknown"),
    ({"input_tokens": -1}, "input_tokens_negative"), ({"output_tokens": -1}, "output_tokens_negative"),
    ({"latency_ms": -0.1}, "latency_ms_negative"), ({"cost_usd": -0.1}, "cost_usd_negative")])
def test_rules(make_calls, change, reason):
    valid, invalid = V.validate_interactions(make_calls([change, {"response": ""}]))
    assert reasons(invalid) == {"i0": [reason]}
    assert [r.interaction_id for r in valid.collect()] == ["i1"]


def test_dead_letters(spark):
    texts = [GOOD, "{not json", GOOD.replace('"hi"', '""'), GOOD.replace("1,", '"x",', 1), "", None, GOOD.replace('"user_id":"u",', "")]
    messages = spark.createDataFrame([(t, "p0", str(i)) for i, t in enumerate(texts)],
                                     "value string, source_partition string, source_offset string")
    valid, dead = V.split_messages(decode_json(messages))
    assert valid.count() == 1
    got = {r.source_offset: list(r[V.REASONS]) for r in dead.collect()}
    assert got["1"] == ["malformed_json"] and got["3"] == ["malformed_json"]
    assert got["2"] == ["prompt_blank"] and got["6"] == ["user_id_missing"]
    assert set(got) == {"1", "2", "3", "4", "5", "6"}


def test_old_record_without_optional_fields(spark, tmp_path):
    (tmp_path / "old.json").write_text(GOOD + "\n")
    row = V.apply_defaults(read_interactions(spark, str(tmp_path), "json").drop("date"), datetime(2024, 1, 1)).first()
    assert row.session_id is None and row.metadata == "{}" and row.timestamp == datetime(2024, 1, 1)
    assert row.total_tokens == 3


def test_embedding_request_text(spark):
    rows = spark.createDataFrame([("a", "", None), ("b", " ", "m"), ("c", None, None)], "request_id string, text string, model string")
    valid, invalid = V.validate_embedding_requests(rows)
    assert [r.request_id for r in valid.collect()] == ["b"]
    assert reasons(invalid, "request_id") == {"a": ["text_empty"], "c": ["text_missing"]}


def test_cost_summary_rate(spark):
    rows = spark.createDataFrame(
        [(1, 1.5), (2, 1.0), (3, None), (4, -0.1)], "id int, cache_hit_rate double").withColumns({
            **{c: F.lit(1) for c in ("total_cost_usd", "total_tokens", "total_interactions")},
            "period_start": F.lit("a"), "period_end": F.lit("b"), "cost_saved_by_cache": F.lit(None).cast("double")})
    valid, _ = V.validate_cost_summaries(rows)
    assert sorted(r.id for r in valid.collect()) == [2, 3]


def test_summary(make_calls):
    rows = make_calls([{}, {"prompt": ""}, {"prompt": "", "provider": "x"}])
    got = {(r.kind, r.name): r.rows for r in V.validation_summary(rows).collect()}
    assert got == {("outcome", "valid"): 1, ("outcome", "invalid"): 2,
                   ("reason", "prompt_blank"): 2, ("reason", "provider_unknown"): 1}


def test_first_insert_wins(make_calls):
    table = make_calls([{"interaction_id": "old", "cost_usd": 1.0}])
    batch = make_calls([{"interaction_id": "old", "cost_usd": 2.0}, {"interaction_id": "new", "cost_usd": 3.0},
                        {"interaction_id": "new", "cost_usd": 4.0}])
    new = facts.insert_interactions(batch, table).collect()
    assert [(r.interaction_id, r.cost_usd) for r in new] == [("new", 3.0)]
    refused = {r.interaction_id: r.rejected for r in facts.rejected_interactions(batch, table).collect()}
    assert refused == {"old": 1, "new": 1}


def test_feature_rows(spark):
    rows = spark.createDataFrame([("f", "e", [1.0, 2.5], datetime(2024, 1, 2, 3))],
                                 "feature_name string, entity_id string, value array<double>, timestamp timestamp_ntz")
    row = facts.insert_features(rows, complex_value=True).first()
    assert row.value == "[1.0,2.5]" and row.version == 1 and str(row.date) == "2024-01-02" and row.metadata == "{}"


def test_one_id_with_most_rows(make_calls):
    rows = make_calls([{"interaction_id": "hot", "cost_usd": float(i)} for i in range(400)] + [{} for _ in range(10)])
    once = facts.insert_interactions(rows)
    plan = once._jdf.queryExecution().executedPlan().toString()
    # Limited before the exchange and after it.
    assert plan.count("WindowGroupLimit") == 2
    got = {r.interaction_id: r.cost_usd for r in once.collect()}
    assert got["hot"] == 0.0 and len(got) == 11


def test_rows_without_an_id_are_refused(make_calls):
    rows = make_calls([{"interaction_id": "a"}, {"interaction_id": "a"}, {}, {}, {}])
    rows = rows.withColumn("interaction_id", F.when(F.col("interaction_id") == "a", "a"))
    assert [r.interaction_id for r in facts.insert_interactions(rows).collect()] == ["a"]
    assert [r.interaction_id for r in facts.insert_interactions(rows, make_calls([{}])).collect()] == ["a"]
    refused = {r.interaction_id: r.rejected for r in facts.rejected_interactions(rows).collect()}
    assert refused == {"a": 1, None: 3}


def test_insert_reads_each_side_once(spark, folder):
    rows = spark.read.parquet(f"{folder}/events.parquet").withColumn("timestamp", F.col("ts"))
    new = facts.new_rows(rows, ["event_id"], rows.where("event_type = 'view'"))
    assert new._jdf.queryExecution().executedPlan().toString().count("FileScan") == 2


def test_insert_against_brute_force(make_calls):
    rows = [{"interaction_id": f"x{i * i % 37}", "cost_usd": float(i)} for i in range(120)]
    table = make_calls([{"interaction_id": f"x{i}"} for i in range(0, 37, 4)])
    want = {}
    for r in rows:
        if int(r["interaction_id"][1:]) % 4 != 0:
            want.setdefault(r["interaction_id"], r["cost_usd"])
    got = facts.insert_interactions(make_calls(rows), table).collect()
    assert {r.interaction_id: r.cost_usd for r in got} == want and len(got) == len(want)


def test_written_apart_scans_and_parses_once(spark, make_calls, tmp_path):
    whole = as_messages(make_calls([{"interaction_id": f"i{i}", "input_tokens": -1 if i % 3 == 0 else 5} for i in range(30)]), RAW_INTERACTION.names)
    whole.select("value").union(spark.createDataFrame([("{broken",), ("",)], "value string")).write.text(str(tmp_path / "in"))
    messages = spark.read.text(str(tmp_path / "in")).withColumns({"source_partition": F.lit("p"), "source_offset": F.lit("0")})
    marked = V.mark_messages(decode_json(messages))
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("from_json") == 1
    valid, dead = V.written_apart(marked, str(tmp_path / "out"))
    for side in (valid, dead):
        plan = side._jdf.queryExecution().executedPlan().toString()
        assert "from_json" not in plan and plan.count("FileScan") == 1 and "outcome" in plan.split("PartitionFilters: ")[1].split("]")[0]
    one, two = V.split_messages(decode_json(messages))
    assert sorted(r.interaction_id for r in valid.collect()) == sorted(r.interaction_id for r in one.collect()) and valid.count() == 20
    assert sorted((r.value, tuple(r.reject_reasons)) for r in dead.collect()) == sorted((r.value, tuple(r.reject_reasons)) for r in two.collect())
    assert dead.count() == 11 + (1 if "" in {r.value for r in dead.collect()} else 0)
