"""Snapshots, CSV round trip and the exactly-once stream sink."""
import datetime as dt
import os
import uuid

from pyspark.sql import functions as F

from marketframe.session import checkpoint_dir


def _root(spark, name):
    return os.path.join(checkpoint_dir(spark), "tests", f"{name}-{uuid.uuid4().hex}")


def _folders(spark, root, table):
    from marketframe.sources.sinks import read_manifest
    return read_manifest(spark, root)["tables"][table]["parts"]


def test_publish_snapshot_versions(spark):
    from marketframe.sources.sinks import current_version, publish_snapshot, read_snapshot
    root = _root(spark, "snap")
    v1 = publish_snapshot(spark.range(3), root, "t")
    v2 = publish_snapshot(spark.range(5), root, "t")
    assert (v1, v2) == (1, 2) and current_version(spark, root, "t") == 2
    assert read_snapshot(spark, root, "t").count() == 5


def test_readers_see_the_last_publish_however_it_was_made(spark):
    from marketframe.sources.sinks import publish_snapshot, publish_tables, read_snapshot, read_table
    root = _root(spark, "mixed")
    publish_tables({"a": spark.range(2), "b": spark.range(3)}, root)
    publish_snapshot(spark.range(9), root, "a")
    assert read_table(spark, root, "a").count() == read_snapshot(spark, root, "a").count() == 9
    assert read_table(spark, root, "b").count() == 3


def test_a_commit_cut_short_never_happened(spark):
    from marketframe.sources.sinks import _create, publish_snapshot, read_manifest, read_table
    root = _root(spark, "crash")
    publish_snapshot(spark.range(2), root, "t")
    _create(spark, f"{root}/_commits/{2:012d}.json", '{"commit": 2, "tab')
    assert read_table(spark, root, "t").count() == 2
    publish_snapshot(spark.range(4), root, "t")
    assert read_table(spark, root, "t").count() == 4 and read_manifest(spark, root)["commit"] == 3


def test_two_writers_of_one_commit_cannot_both_win(spark):
    import pytest
    from marketframe.sources.sinks import _create
    root = _root(spark, "race")
    _create(spark, f"{root}/_commits/x.json", "1")
    with pytest.raises(Exception):
        _create(spark, f"{root}/_commits/x.json", "2")


def test_expire_keeps_what_the_last_commits_name(spark):
    from marketframe.sources.sinks import expire, publish_snapshot, read_table
    root = _root(spark, "expire")
    for n in range(1, 5):
        publish_snapshot(spark.range(n), root, "t")
    assert expire(spark, root, keep=2) == 2 and read_table(spark, root, "t").count() == 4


LANDED = "ticker string, date date, close double, adj_close double, stock_splits double"


def _ids(spark):
    from marketframe import schemas as S
    return spark.createDataFrame([("EQUA", "YAHOO", "A"), ("EQUB", "YAHOO", "B")], S.IDENTIFIERS)


def test_stream_ingest_across_files_and_replays(spark):
    from marketframe.sources.sinks import publish_snapshot, read_manifest, read_table
    from marketframe.streaming.ingest_stream import run_to_end, stream_ingest
    rows = [("A", dt.date(2024, 1, d), 10.0 + d, 10.0 + d, 0.0) for d in range(1, 7)] + \
           [("B", dt.date(2024, 1, d), 20.0 + d, 20.0 + d, 2.0 if d == 3 else 0.0) for d in range(1, 7)] + \
           [("Z", dt.date(2024, 1, d), 1.0, 1.0, 0.0) for d in range(1, 3)]
    landing, root, ckpt = _root(spark, "landing"), _root(spark, "root"), _root(spark, "ckpt")
    frame = spark.createDataFrame(rows, LANDED)
    # every ticker's window is split over two files, one a micro-batch; a published table is already there
    frame.where("day(date) <= 3").coalesce(1).write.parquet(landing)
    frame.where("day(date) > 3").coalesce(1).write.mode("append").parquet(landing)
    from decimal import Decimal

    from marketframe import schemas as S
    kept = spark.createDataFrame([("EQUX", "close", dt.date(2020, 1, 1), "YAHOO", Decimal(5))], S.OBSERVATIONS)
    publish_snapshot(kept, root, "observations", ["field", "year(date)"])
    before = _folders(spark, root, "observations")
    out = run_to_end(spark, landing, root, ckpt, _ids(spark), files_per_batch=1)
    got = {(r.instrument_id, r.field, r.date.day): float(r.value) for r in out.collect()}
    assert len(got) == 2 * 5 * 2 + 1                     # one first row less for each ticker, not one for each file
    assert got[("EQUB", "close", 2)] == 44.0 and got[("EQUB", "close", 3)] == 23.0 and got[("EQUX", "close", 1)] == 5.0
    assert ("EQUA", "totret", 4) in got and len([k for k in got if k[0] == "EQUA" and k[1] == "totret"]) == 5
    assert {k: f for k, f in _folders(spark, root, "observations").items() if k in before and "2020" in k} == before
    failures = read_table(spark, root, "observations_failures")
    assert failures.where("error_message = 'unknown identifier Z'").count() > 0
    times = {r.error_timestamp for r in failures.collect()}
    assert all(abs((dt.datetime.now() - t).total_seconds()) < 86_400 * 1.5 for t in times)
    # a restart finds nothing new; a batch whose end the checkpoint doesn't know is replayed and finds itself applied
    commit = read_manifest(spark, root)["commit"]
    stream_ingest(spark, landing, root, ckpt, _ids(spark)).awaitTermination()
    for f in ("commits/1", "commits/.1.crc"):
        os.remove(f"{ckpt}/{f}")
    stream_ingest(spark, landing, root, ckpt, _ids(spark)).awaitTermination()
    assert read_manifest(spark, root)["commit"] == commit
    # a new checkpoint reads all again, which changes nothing
    parts = _folders(spark, root, "observations")
    out = run_to_end(spark, landing, root, _root(spark, "ckpt2"), _ids(spark))
    assert {(r.instrument_id, r.field, r.date.day): float(r.value) for r in out.collect()} == got
    assert _folders(spark, root, "observations") == parts


def test_a_new_checkpoint_on_an_old_root_loses_nothing(spark):
    from marketframe.streaming.ingest_stream import run_to_end
    landing, root = _root(spark, "landing"), _root(spark, "root")
    frame = spark.createDataFrame([("A", dt.date(2024, 1, d), 10.0 + d, 10.0 + d, 0.0) for d in range(1, 9)], LANDED)
    frame.where("day(date) <= 4").coalesce(1).write.parquet(f"{landing}/pull=p1")
    run_to_end(spark, landing, root, _root(spark, "first"), _ids(spark), fields=["close"])
    frame.where("day(date) > 4").coalesce(1).write.mode("append").parquet(f"{landing}/pull=p1")
    out = run_to_end(spark, landing, root, _root(spark, "second"), _ids(spark), fields=["close"])
    assert {r.date.day: float(r.value) for r in out.collect()} == {d: 10.0 + d for d in range(1, 9)}


def test_landed_bytes_follow_the_batch(spark):
    from marketframe.sources.sinks import read_manifest
    from marketframe.streaming.ingest_stream import run_to_end
    landing, root, ckpt = _root(spark, "landing"), _root(spark, "root"), _root(spark, "ckpt")
    seen, files = {}, []
    for n in range(4):
        spark.createDataFrame([("A", dt.date(2024, 1, 3 * n + d), 10.0 + d, 10.0 + d, 0.0) for d in (1, 2, 3)], LANDED).coalesce(1).write.mode("append").parquet(landing)
        run_to_end(spark, landing, root, ckpt, _ids(spark), fields=["close"])
        parts = read_manifest(spark, root)["tables"]["observations_landed"]["parts"]
        new = [f for k, f in parts.items() if k not in seen]
        files.append(spark.read.parquet(*new).count())
        seen |= parts
    assert files == [3, 3, 3, 3]                          # nothing that landed before is written again


OBS = "instrument_id string, field string, date date, source string, value decimal(19,5)"
KEY = ["instrument_id", "field", "date", "source"]


def _obs(spark, *rows):
    from decimal import Decimal
    return spark.createDataFrame([(i, "close", d, "YAHOO", Decimal(v)) for i, d, v in rows], OBS)


def test_two_writers_of_one_part_lose_nothing(spark):
    import pytest
    from marketframe.sources.sinks import CommitConflict, commit, read_table, stage_snapshot, stage_upsert, upsert_table
    root, by, day = _root(spark, "two"), ["field", "year(date)"], dt.date(2024, 1, 1)
    upsert_table(_obs(spark, ("A", day, 1), ("A", dt.date(2020, 1, 1), 1)), root, "obs", KEY, by)
    one, two = (stage_upsert(_obs(spark, (i, day, 2)), root, "obs", KEY, by) for i in ("B", "C"))
    other = stage_upsert(_obs(spark, ("D", dt.date(2020, 1, 1), 3)), root, "obs", KEY, by)
    commit(spark, root, [one])
    with pytest.raises(CommitConflict):
        commit(spark, root, [two])
    commit(spark, root, [other])                         # another part: no conflict
    upsert_table(_obs(spark, ("C", day, 2)), root, "obs", KEY, by)
    assert sorted(r.instrument_id for r in read_table(spark, root, "obs").collect()) == ["A", "A", "B", "C", "D"]
    new_part = [stage_upsert(_obs(spark, (i, dt.date(2022, 1, 1), 2)), root, "obs", KEY, by) for i in ("E", "F")]
    commit(spark, root, new_part[:1])
    with pytest.raises(CommitConflict):                  # both found no such part
        commit(spark, root, new_part[1:])
    stale = stage_snapshot(_obs(spark, ("Z", day, 1)), root, "obs", by, version=1)
    with pytest.raises(CommitConflict):
        commit(spark, root, [stale])


def test_an_overtaken_upsert_is_made_anew(spark, monkeypatch):
    from marketframe.sources import sinks
    root, by, day = _root(spark, "redo"), ["field", "year(date)"], dt.date(2024, 1, 1)
    sinks.upsert_table(_obs(spark, ("A", day, 1)), root, "obs", KEY, by)
    stage, first = sinks.stage_upsert, []

    def overtaken(*a, **k):
        made = stage(*a, **k)
        if not first:
            first.append(1)
            sinks.commit(spark, root, [stage(_obs(spark, ("B", day, 2)), root, "obs", KEY, by)])
        return made
    monkeypatch.setattr(sinks, "stage_upsert", overtaken)
    sinks.upsert_table(_obs(spark, ("C", day, 3)), root, "obs", KEY, by)
    assert sorted(r.instrument_id for r in sinks.read_table(spark, root, "obs").collect()) == ["A", "B", "C"]


def test_equal_rows_write_nothing(spark):
    from marketframe.sources.sinks import current_version, upsert_table
    root, by = _root(spark, "same"), ["concat(field, ':/% ')", "year(date)"]        # values that folder names escape
    rows = [("A", dt.date(y, 1, 1), 1) for y in (2020, 2021)]
    upsert_table(_obs(spark, *rows), root, "obs", KEY, by)
    before = _folders(spark, root, "obs")
    assert upsert_table(_obs(spark, *rows), root, "obs", KEY, by) == 1 == current_version(spark, root, "obs")
    upsert_table(_obs(spark, rows[0], ("A", dt.date(2021, 1, 1), 2)), root, "obs", KEY, by)
    after = _folders(spark, root, "obs")
    assert [k for k in before if before[k] != after[k]] == [k for k in before if "2021" in k]


def test_one_large_partition_is_written_by_many_tasks(spark):
    from marketframe.sources.sinks import _names, publish_snapshot
    root = _root(spark, "hot")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        rows = spark.range(60_000).selectExpr("concat('I', id) as instrument_id", "'close' as field", "date'2024-01-01' as date", "'Y' as source", "cast(id as decimal(19,5)) as value")
        publish_snapshot(rows.repartition(8), root, "obs", ["field", "year(date)"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    (folder,) = _folders(spark, root, "obs").values()
    assert len([n for n in _names(spark, folder) if n.endswith(".parquet")]) > 4


def test_intermediate_tables_go_with_their_job(spark):
    import pytest
    from marketframe.sources.sinks import exists, intermediates, materialize
    with pytest.raises(KeyError), intermediates(spark):
        path = materialize(spark.range(3), "x").inputFiles()[0].rsplit("/", 1)[0]
        assert exists(spark, path)
        raise KeyError
    assert not exists(spark, path)


def test_stream_never_replaces_a_value_by_nothing(spark):
    from marketframe.streaming.ingest_stream import run_to_end
    landing, root, ckpt = _root(spark, "landing"), _root(spark, "root"), _root(spark, "ckpt")
    days = [dt.date(2024, 1, d) for d in (1, 2, 3)]
    spark.createDataFrame([("A", d, 10.0, 10.0, 0.0) for d in days], LANDED).write.parquet(f"{landing}/pull=p1")
    run_to_end(spark, landing, root, ckpt, _ids(spark), fields=["close"])
    spark.createDataFrame([("A", d, float("nan"), 10.0, 0.0) for d in days], LANDED).write.parquet(f"{landing}/pull=p2")
    out = run_to_end(spark, landing, root, ckpt, _ids(spark), fields=["close"])
    assert sorted(float(r.value) for r in out.collect()) == [10.0] * 3


def test_csv_round_trip(spark):
    from marketframe.sources.sinks import write_csv
    path = _root(spark, "csv")
    write_csv(spark.createDataFrame([("a", 1.5), ("b", None)], "k string, v double"), path)
    back = spark.read.schema("k string, v double").option("header", True).csv(path)
    assert sorted((r.k, r.v) for r in back.collect()) == [("a", 1.5), ("b", None)]


def test_upsert_writes_only_touched_partitions(spark):
    from decimal import Decimal

    from marketframe.sources.sinks import publish_snapshot, read_table, upsert_table
    root, by = _root(spark, "obs"), ["field", "year(date)"]
    key = ["instrument_id", "field", "date", "source"]
    schema = "instrument_id string, field string, date date, source string, value decimal(19,5)"
    rows = [(f"I{i}", "close", dt.date(y, 6, 1), "YAHOO", Decimal(i)) for i in range(3) for y in (2019, 2020, 2021)] + [("I9", None, dt.date(2021, 6, 1), "YAHOO", Decimal(1))]
    publish_snapshot(spark.createDataFrame(rows, schema), root, "obs", by)
    before = _folders(spark, root, "obs")
    batch = spark.createDataFrame([("I0", "close", dt.date(2021, 6, 1), "YAHOO", Decimal(9), 1), ("I0", "close", dt.date(2021, 6, 1), "YAHOO", Decimal(8), 2),
                                   ("I7", "close", dt.date(2021, 7, 1), "YAHOO", Decimal(7), 1), ("I8", None, dt.date(2021, 6, 1), "YAHOO", Decimal(2), 1)],
                                  schema + ", seq int")
    upsert_table(batch, root, "obs", key, by, "seq")
    after = _folders(spark, root, "obs")
    assert {k for k in before if before[k] != after[k]} == {k for k in before if "2021" in k} and set(after) == set(before)
    got = {(r.instrument_id, r.date.year): r.value for r in read_table(spark, root, "obs").collect()}
    assert len(got) == 12 and got[("I0", 2021)] == Decimal(8) and got[("I7", 2021)] == Decimal(7)
    assert got[("I9", 2021)] == Decimal(1) and got[("I8", 2021)] == Decimal(2)       # a null partition value keeps its rows


def test_publish_tables_switches_one_manifest(spark):
    from marketframe.sources.sinks import publish_tables, read_manifest, read_table
    root = _root(spark, "multi")
    v = publish_tables({"a": spark.range(2), "b": spark.range(3)}, root)
    assert v == {"a": 1, "b": 1}
    publish_tables({"a": spark.range(4)}, root)
    assert {k: t["version"] for k, t in read_manifest(spark, root)["tables"].items()} == {"a": 2, "b": 1}
    assert read_table(spark, root, "a").count() == 4 and read_table(spark, root, "b").count() == 3
