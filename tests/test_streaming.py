from pyspark.sql import functions as F

from lumenframe.streaming import windows


def run(spark, tmp_path, df, name, mode="append", rows=None):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / f"ck_{name}")).start()
    try:
        if rows is None:
            q.processAllAvailable()
        else:  # queries with processing-time timeouts never come to rest
            for _ in range(240):
                if spark.table(name).count() >= rows or q.awaitTermination(0.5):
                    break
    finally:
        q.stop()
    return spark.table(name)


def test_windows(spark, tmp_path):
    rows = [(f"2024-01-01 00:00:{s:06.3f}", "a", v) for s, v in [(0.1, 1.0), (0.2, 5.0), (0.5, 2.0), (30.0, 1.0)]]
    spark.createDataFrame(rows, "at string, k string, value double").write.json(str(tmp_path / "in"))
    source = spark.readStream.schema("at timestamp, k string, value double").json(str(tmp_path / "in"))
    got = run(spark, tmp_path, windows.tumbling_counts(source, "at", "k"), "tumbling", "complete").select(F.date_format("window.start", "ss.SSS").alias("s"), "n", "peak").orderBy("s").collect()
    assert [tuple(r) for r in got] == [("00.000", 2, 5.0), ("00.400", 1, 2.0), ("30.000", 1, 1.0)]
    got = run(spark, tmp_path, windows.sessions(source, "at", "k"), "sess", "complete").select("n").collect()
    assert sorted(r.n for r in got) == [1, 3]
    assert run(spark, tmp_path, windows.sliding_counts(source, "at", "k"), "sliding", "complete").agg(F.sum("n")).first()[0] >= 4


def test_merged_spans(spark, tmp_path):
    spark.createDataFrame([("a", 0, 10), ("a", 10, 12), ("a", 13, 20), ("a", 30, 31), ("b", 1, 1)], "target_id string, start_us long, end_us long").coalesce(1).write.json(str(tmp_path / "in"))
    source = spark.readStream.schema("target_id string, start_us long, end_us long").json(str(tmp_path / "in"))
    got = run(spark, tmp_path, windows.merged_spans(source, idle_ms=10**8), "merged", rows=2).orderBy("start_us").collect()
    assert [(r.start_us, r.end_us, r.parts) for r in got] == [(0, 12, 2), (13, 20, 1)]
