import datetime as dt
import time

from pyspark.sql import functions as F

from pitlake.operators.events import greedy_windows
from pitlake.streaming import detect as ST


def _stream(spark, path, schema):
    return spark.readStream.schema(schema).parquet(path)


def test_first_seen_and_volumes(spark, tmp_path):
    rows = [("a", dt.datetime(2024, 1, 1)), ("a", dt.datetime(2024, 1, 1)), ("b", dt.datetime(2024, 1, 3))]
    df = spark.createDataFrame(rows, "key string, at timestamp")
    df.write.parquet(str(tmp_path / "in"))
    q = ST.first_seen(_stream(spark, str(tmp_path / "in"), df.schema), "key", "at").writeStream.format("memory").queryName("seen").option("checkpointLocation", str(tmp_path / "c1")).outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("seen").count() == 2
    q = ST.volumes(_stream(spark, str(tmp_path / "in"), df.schema), "at", "1 day").writeStream.format("memory").queryName("vol").option("checkpointLocation", str(tmp_path / "c2")).outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    days = spark.createDataFrame([(dt.datetime(2024, 1, d),) for d in (1, 2, 3)], "begins timestamp")
    out = {r["begins"].day: (r["n"], r["alarm"]) for r in ST.quiet_windows(spark.table("vol"), days).collect()}
    assert out == {1: (2, False), 2: (0, True), 3: (1, False)}


def test_cluster_stream_equals_batch(spark, tmp_path):
    days = [1, 2, 3, 5, 6, 10, 11, 30]
    rows = [(e, dt.datetime(2024, 1, d, 5), (d * (e + 1)) % 3) for e in (1, 2) for d in days] + [(9, dt.datetime(2024, 6, 1), 1)]
    df = spark.createDataFrame(rows, "e long, at timestamp, p long")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = ST.cluster_stream(_stream(spark, str(tmp_path / "in"), df.schema), "e", "at", "p", 3, 2)
    q = stream.writeStream.format("memory").queryName("clusters").option("checkpointLocation", str(tmp_path / "c")).outputMode("append").start()
    q.processAllAvailable()
    spark.createDataFrame([(9, dt.datetime(2024, 9, 1), 1)], "e long, at timestamp, p long").write.mode("append").parquet(str(tmp_path / "in"))
    q.processAllAvailable()
    q.stop()
    got = sorted((r["entity"], r["window_start"], r["window_end"]) for r in spark.table("clusters").collect())
    batch = greedy_windows(df.withColumn("d", F.to_date("at")), "e", "d", "p", 3, 2)
    assert got == sorted((r["e"], r["window_start"], r["window_end"]) for r in batch.collect())


def test_latest_wins_in_any_order(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "g int, doc int, k int, superseded boolean, supersedes_doc int"
    spark.createDataFrame([], schema).write.parquet(path)

    def write(df):
        rows = df.collect()
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(path)

    batch = ST.latest_wins(lambda: spark.read.schema(schema).parquet(path), write, ["g"], "doc", "k")
    for rows in ([(1, 11, 2)], [(1, 10, 1)], [(1, 11, 2)]):
        batch(spark.createDataFrame(rows, "g int, doc int, k int"), 0)
    assert sorted((r["doc"], r["superseded"], r["supersedes_doc"]) for r in spark.read.schema(schema).parquet(path).collect()) == [(10, True, None), (11, False, 10)]


def test_latest_wins_in_buckets(spark, tmp_path):
    t = ST.LatestWins(spark, str(tmp_path / "lw"), "g int, doc int, k int, superseded boolean, supersedes_doc int", ["g"], "doc", "k", 8)
    rows = lambda *r: spark.createDataFrame(list(r), "g int, doc int, k int")
    seen = lambda: sorted((r["g"], r["doc"], r["superseded"], r["supersedes_doc"]) for r in t.table().collect())
    assert seen() == []
    t.batch(rows((1, 11, 2), *((g, g, 1) for g in range(100, 140))), 0)
    t.batch(rows((1, 10, 1)), 1)
    t.batch(rows((1, 10, 1)), 1)
    assert seen()[:2] == [(1, 10, True, None), (1, 11, False, 10)] and len(seen()) == 42
    t.batch(rows((2, 11, 3)), 2)  # the document moves to another group, both change
    assert seen()[:2] == [(1, 10, False, None), (2, 11, False, None)] and len(seen()) == 42
    (tmp_path / "lw" / "batch=3" / "bucket=1").mkdir(parents=True)  # a batch that failed isn't seen
    before = seen()
    assert t.vacuum() > 0 and seen() == before


def test_heartbeat(spark, tmp_path):
    beats = []
    listener = ST.Heartbeat(beats.append)
    spark.streams.addListener(listener)
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1), "a")], "at timestamp, key string")
    df.write.parquet(str(tmp_path / "in"))
    q = _stream(spark, str(tmp_path / "in"), df.schema).writeStream.format("memory").queryName("beating").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    for _ in range(100):
        if {b["event"] for b in beats} >= {"started", "progress", "ended"}:
            break
        time.sleep(0.1)
    spark.streams.removeListener(listener)
    assert {b["event"] for b in beats} >= {"started", "progress", "ended"} and sum(b["rows"] for b in beats) == 1
    seen = spark.createDataFrame([("beating", dt.datetime(2024, 1, 1, 12))], "name string, at timestamp")
    expected = spark.createDataFrame([("beating",), ("gone",)], "name string")
    late = lambda hour: sorted(r["name"] for r in ST.silent(seen, expected, F.lit(dt.datetime(2024, 1, 1, hour)), 30).collect())
    assert late(12) == ["gone"] and late(13) == ["beating", "gone"]
