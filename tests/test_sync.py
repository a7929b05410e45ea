from datetime import UTC, datetime, timedelta

from pyspark.sql import functions as F

from tradewinds.sources.control import Instants
from tradewinds.sources.lake import Lake
from tradewinds.streaming import sync

T0 = datetime(2024, 1, 1, tzinfo=UTC)


def test_what_is_news():
    assert sync.changed(None, T0) and sync.changed("2024-01-02", T0) and sync.changed("2000-01-01", None)
    assert not sync.changed(T0, T0) and not sync.changed("2023-12-31", T0)
    updates = sync.by_last_update(lambda: T0, lambda: "whole", lambda: "recent")
    assert [updates(None), updates(T0 - timedelta(1)), updates(T0)] == ["whole", "recent", None]
    assert sync.last_release({"2020": "2021-01-01", "2021": "2022-01-01"}, ["2020", "1999"]) == datetime(2021, 1, 1, tzinfo=UTC)
    assert sync.last_release({}) is None
    calls = []
    once = sync.Once(lambda k: calls.append(k) or k)
    assert [once("a"), once("a")] == ["a", "a"] and calls == ["a"]


def test_run_writes_then_records(spark, tmp_path):
    rows = lambda v: spark.createDataFrame([("k", v)], "k string, v int")
    seen, lake = [], Lake(spark, str(tmp_path / "lake"))
    registry = Instants(tmp_path / "r.json")
    registry.mark("old", T0)

    def job(key, news):
        return sync.Job(key, f"t_{key}", ("k",), lambda since: seen.append((key, since)) or news())

    def fail():
        raise OSError("down")

    jobs = [job("old", lambda: rows(1)), job("bad", fail), job("none", lambda: None), job("new", lambda: rows(2))]
    report = sync.run(jobs, lake, registry, now=lambda: T0 + timedelta(1))
    assert [k for k, _ in seen] == ["bad", "new", "none", "old"] and seen[-1] == ("old", T0)
    assert report.written == {"new": 1, "old": 1} and report.empty == ["none"] and list(report.errors) == ["bad"] and sorted(report.created) == ["t_new", "t_old"]
    again = Instants(tmp_path / "r.json")
    assert again.get("bad") is None and again.get("none") == again.get("old") == T0 + timedelta(1)
    closed = []
    late = sync.run(jobs, lake, registry, most_seconds=0, close=lambda: closed.append(1))
    assert late.stopped_early and closed and not late.written


def test_recompute_and_stream(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    down = spark.createDataFrame([("a", T0), ("b", T0), ("c", T0)], "k string, last_download timestamp")
    done = spark.createDataFrame([("a", T0 - timedelta(1)), ("b", T0)], "k string, last_computed timestamp")
    args = (["k"], lambda stale: stale.withColumn("n", F.lit(1)), lake, "out", ["k"], "log")
    assert sync.recompute(down, done, *args, now=lambda: T0 + timedelta(1)) == 1
    assert sorted(r.k for r in lake.read("out").collect()) == ["a", "c"]
    assert sync.recompute(down, done.where("k = 'b'").unionByName(lake.read("log")), *args) is None

    inbox = str(tmp_path / "in")
    schema = "k string, at int, v string"
    for part in ([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], [("b", 5, "w")]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(inbox)
    for _ in range(2):  # the second run finds nothing new
        write = sync.upsert_batches(lake, "live", ["k"], [F.desc("at"), "v"])
        stream = spark.readStream.schema(schema).parquet(inbox).writeStream.foreachBatch(write).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        stream.awaitTermination(60)
    assert {tuple(r) for r in lake.read("live").collect()} == {("a", 2, "y"), ("b", 5, "w")} and len(lake.versions("live")) == 1
