from pyspark.sql import functions as F

from kinetrace.streaming import live


def drain(spark, stream, name, mode="append"):
    q = stream.writeStream.outputMode(mode).format("memory").queryName(name).start()
    q.processAllAvailable()
    q.stop()
    return spark.table(name)


def test_rolling_steps_equal_the_batch_form(spark, tmp_path):
    rows = [(k, t, float(t * t % 7), float(t % 3)) for k in (1, 2) for t in range(12)]
    spark.createDataFrame(rows, "k long, t long, x double, y double").repartition(1).sortWithinPartitions("t").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k long, t long, x double, y double").parquet(str(tmp_path / "in"))
    got = {(r.k, r.t): (r.step, r.mean_step) for r in drain(spark, live.rolling_steps(stream, "k", "t", "x", "y", 3), "steps").collect()}
    from kinetrace.operators.track import Track

    t = Track(("k",), "t")
    batch = spark.read.parquet(str(tmp_path / "in")).withColumn("s", t.step("x", "y"))
    for r in batch.select("k", "t", "s", t.rolling("s", 3).alias("m")).collect():
        assert abs(got[r.k, r.t][0] - r.s) < 1e-9 and abs(got[r.k, r.t][1] - r.m) < 1e-9


def test_windows_and_sessions(spark, tmp_path):
    src = "/root/testdata/sf0.001/events.parquet"
    schema = spark.read.parquet(src).schema
    spark.read.parquet(src).repartition(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    days = drain(spark, live.tumbling(stream, ["event_type"], "ts", "value"), "days", "complete")
    assert days.select(F.sum("rows")).first()[0] == spark.read.parquet(src).count()
    runs = drain(spark, live.sessions(stream, ["user_id"], "ts"), "runs", "complete")
    assert runs.select(F.sum("rows")).first()[0] == spark.read.parquet(src).count()
