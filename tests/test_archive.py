import glob
import os
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from meterlake.sources import online as N
from meterlake.schemas import INTERACTION
from meterlake.sources.archive import Archive, VersionedTable
from meterlake.sources.daily import ARCHIVE, archived_before, move_days, read_all_tiers, read_days, split_by_age, write_days


@pytest.fixture
def archive(spark, tmp_path):
    return Archive(spark, str(tmp_path / "archive"))


def ids(df):
    return sorted(r.interaction_id for r in df.select("interaction_id").collect())


def on(days, prefix="i"):
    return [{"interaction_id": f"{prefix}{d}", "timestamp": datetime(2024, 1, d)} for d in days]


def test_append_overwrite_travel(archive, make_calls):
    assert archive.write_interactions(make_calls(on([1, 2]))) == 0
    assert archive.write_interactions(make_calls(on([3]))) == 1
    assert archive.write_interactions(make_calls(on([4])), "overwrite") == 2
    assert archive.write_interactions(make_calls(on([5]))) == 3
    assert ids(archive.read()) == ["i4", "i5"]
    assert ids(archive.time_travel(1)) == ["i1", "i2", "i3"]
    assert ids(archive.time_travel(0)) == ["i1", "i2"]
    assert ids(archive.time_travel(2)) == ["i4"]
    assert [(r.version, r.mode, r.row_count) for r in archive.history().collect()] == [
        (0, "append", 2), (1, "append", 1), (2, "overwrite", 1), (3, "append", 1)]
    with pytest.raises(ValueError):
        archive.time_travel(9)


def test_empty_write_is_no_commit(archive, make_calls):
    assert archive.write_interactions(make_calls(on([1])).where("false")) is None
    assert archive.write_interactions(make_calls(on([1]))) == 0
    assert archive.write_interactions(make_calls(on([1])).where("false"), "overwrite") is None
    assert ids(archive.read()) == ["i1"]


def test_unpublished_data_is_invisible_and_replaced(archive, make_calls, spark):
    archive.write_interactions(make_calls(on([1])))
    # A job that died after writing files of version 1.
    make_calls(on([9])).write.partitionBy("date").parquet(f"{archive.root}/data/commit=1")
    assert ids(archive.read()) == ["i1"]
    assert archive.write_interactions(make_calls(on([2]))) == 1
    assert ids(archive.read()) == ["i1", "i2"]


def test_schema_merges_and_conflicts(archive, make_calls):
    archive.write_interactions(make_calls(on([1])))
    archive.write_interactions(make_calls(on([2])).withColumn("region", F.lit("eu")))
    got = {r.interaction_id: r.region for r in archive.read().collect()}
    assert got == {"i1": None, "i2": "eu"} and "metadata" not in archive.read().columns
    with pytest.raises(ValueError):
        archive.write_interactions(make_calls(on([3])).withColumn("region", F.lit(1)))


def test_filters_and_pruning(archive, make_calls):
    archive.write_interactions(make_calls(on(range(1, 11))))
    assert ids(archive.read_interactions("2024-01-03", "2024-01-05")) == ["i3", "i4", "i5"]
    assert archive.read_interactions(limit=0).count() == 10
    assert archive.read_interactions(limit=4).count() == 4
    assert archive.read_interactions(user_id="").count() == 10
    plan = archive.read_interactions("2024-01-03", "2024-01-05", "u1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "EqualTo(user_id,u1)" in plan


def test_compact_keeps_rows_and_splits_a_hot_day(archive, make_calls):
    hot = [{"interaction_id": f"h{i}", "timestamp": datetime(2024, 1, 1)} for i in range(600)]
    archive.write_interactions(make_calls(hot).repartition(8))
    archive.write_interactions(make_calls(on([2, 3])))
    before = ids(archive.read())
    version = archive.compact(rows_per_file=100)
    assert ids(archive.read()) == before and archive.row_count() == 602
    day = f"{archive.root}/data/commit={version}/date=2024-01-01"
    assert 3 <= len([f for f in os.listdir(day) if f.endswith(".parquet")]) <= 8


def test_expiry_drops_only_old_versions(archive, make_calls):
    archive.write_interactions(make_calls(on([1])))
    archive.write_interactions(make_calls(on([2])))
    archive.compact()
    archive.write_interactions(make_calls(on([3])))
    assert archive.expire(retention_hours=720) == 0
    later = datetime.now() + timedelta(days=60)
    assert archive.expire(now=later, retention_hours=720) == 2
    assert ids(archive.read()) == ["i1", "i2", "i3"]
    with pytest.raises(ValueError):
        archive.time_travel(1)
    assert ids(archive.time_travel(3)) == ["i1", "i2", "i3"]
    assert archive.write_interactions(make_calls(on([4]))) == 5
    assert ids(archive.read()) == ["i1", "i2", "i3", "i4"]


def test_days_are_plain_files(spark, make_calls, tmp_path):
    root = str(tmp_path / "days")
    write_days(make_calls(on([1, 2])).where("false"), root)
    assert read_days(spark, root).count() == 0 and read_days(spark, root).columns == [f.name for f in ARCHIVE]
    write_days(make_calls(on([1, 2, 3])), root)
    write_days(make_calls(on([3], "more")).withColumn("region", F.lit("eu")), root)
    assert ids(read_days(spark, root)) == ["i1", "i2", "i3", "more3"]
    # A reader asks for the columns it wants; older files lack some.
    wide = StructType([*ARCHIVE.fields, StructField("region", StringType())])
    assert {r.interaction_id: r.region for r in read_days(spark, root, schema=wide).collect()}["i1"] is None
    # Overwriting touches the dates that are written, and no other.
    write_days(make_calls(on([3], "new")), root, "overwrite")
    assert ids(read_days(spark, root)) == ["i1", "i2", "new3"]
    assert {f for f in os.listdir(root) if not f.startswith((".", "_"))} == {f"date=2024-01-0{d}" for d in (1, 2, 3)}
    assert ids(read_days(spark, root, "2024-01-02", "2024-01-03", "")) == ["i2", "new3"]
    assert read_days(spark, root, limit=2).count() == 2 and read_days(spark, root, limit=0).count() == 3
    with pytest.raises(ValueError):
        write_days(make_calls(on([1])), root, "replace")


def test_move_can_be_repeated(spark, make_calls, tmp_path):
    root, facts = str(tmp_path / "days"), make_calls(on(range(1, 11)))
    # A move that was left half done, and one that is repeated.
    write_days(facts.where("interaction_id = 'i2'"), root)
    for _ in range(2):
        keep = move_days(facts, root, "2024-01-12", 5)
        # Exactly five days old stays.
        assert ids(keep) == ["i10", "i7", "i8", "i9"]
        assert ids(read_days(spark, root)) == [f"i{d}" for d in range(1, 7)]


def test_a_move_reads_no_other_date(spark, make_calls, tmp_path):
    root, warm = str(tmp_path / "days"), str(tmp_path / "warm")
    write_days(make_calls(on(range(1, 21), "old")), root)
    make_calls(on([3, 9])).write.parquet(warm)
    old, _ = split_by_age(spark.read.schema(INTERACTION).parquet(warm), "2024-01-12", 5)
    done = archived_before(old, root)
    assert ids(done) == ["old3"]
    plan = done._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.splitlines() if "PartitionFilters" in line]
    assert any("dynamicpruning" in line for line in filters), plan


def test_tiers_count_a_row_once(make_calls):
    warm = make_calls(on([1, 2]))
    cold = make_calls(on([2, 3])).drop("metadata")
    both = read_all_tiers(warm, cold)
    assert ids(both) == ["i1", "i2", "i3"]
    assert {r.interaction_id: r.metadata for r in both.collect()}["i3"] is None


AT = datetime(2024, 1, 1)


def entry(spark, rows, ttl=60):
    df = spark.createDataFrame(rows, "entity_id string, feature_name string, value string, written_at timestamp_ntz")
    return N.with_expiry(df, ttl)


def test_entry_is_gone_at_its_expiry(spark):
    df = entry(spark, [("u", "f", "1", AT)])
    assert N.visible(df, AT + timedelta(seconds=59.999999)).count() == 1
    assert N.visible(df, AT + timedelta(seconds=60)).count() == 0


def test_newest_entry_counts(spark, tmp_path):
    root = str(tmp_path / "online")
    N.publish_online_features(entry(spark, [("u", "f", "1", AT), ("v", "f", "9", AT)]), root)
    N.publish_online_features(entry(spark, [("u", "f", "2", AT + timedelta(seconds=30))]), root)
    # A late update does not replace a newer entry, and a repeated one changes nothing.
    N.publish_online_features(entry(spark, [("u", "f", "old", AT - timedelta(seconds=1))]), root)
    N.publish_online_features(entry(spark, [("u", "f", "2", AT + timedelta(seconds=30))]), root)
    live = lambda seconds, *ids: {r.entity_id: r.value for r in N.read_online(spark, root, AT + timedelta(seconds=seconds), *ids).collect()}
    assert live(59) == {"u": "2", "v": "9"} and live(59, ["v", "nobody"]) == {"v": "9"}
    # The newer entry of u outlives the older one of v.
    assert live(61) == {"u": "2"}


def test_an_update_touches_its_buckets_only(spark, tmp_path):
    root = str(tmp_path / "online")
    N.publish_online_features(entry(spark, [(f"u{i}", "f", str(i), AT) for i in range(500)]), root)
    files = lambda: {f: os.path.getmtime(f) for f in glob.glob(f"{root}/bucket=*/*.parquet")}
    before = files()
    N.publish_online_features(entry(spark, [("u7", "f", "new", AT + timedelta(seconds=1))]), root)
    after = files()
    assert len({f.split("/")[-2] for f in before}) == N.BUCKETS
    assert {f.split("/")[-2] for f in set(before) ^ set(after)} == {f.split("/")[-2] for f in set(after) - set(before)} and len(set(after) - set(before)) == 1
    assert N.read_online(spark, root, AT).count() == 500
    plan = N.touched_entries(spark, root, spark.range(1).select(F.lit(3).alias("bucket")))._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*bucket[^]]* = 3", plan), plan
    plan = N.read_online(spark, root, AT)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
    # Entries that expired go when their bucket is written again.
    N.publish_online_features(entry(spark, [(f"u{i}", "f", "x", AT + timedelta(days=1)) for i in range(10)]), root, AT + timedelta(days=1))
    assert {r.entity_id for r in N.read_online(spark, root, AT + timedelta(days=1)).collect()} == {f"u{i}" for i in range(10)}


def test_delete(spark):
    df = entry(spark, [(f"user:{i}", "f", "1", AT) for i in range(3)] + [("other", "f", "1", AT)])
    df = df.withColumn("key", F.concat(F.lit("test:"), F.col("entity_id")))
    kept, deleted = N.delete_by_pattern(df, "test:user:*", "key")
    assert kept.count() == 1 and deleted.first().deleted == 3
    for bad in ("", "*", " * "):
        with pytest.raises(ValueError):
            N.key_matches(bad)
    kept, existed = N.delete_key(df, "test:other", "key")
    assert existed.first().existed and kept.count() == 3
    assert N.delete_key(df, "nothing", "key")[1].first().existed is False


def test_table_without_rows(spark, tmp_path):
    with pytest.raises(ValueError):
        VersionedTable(spark, str(tmp_path / "none")).read()
