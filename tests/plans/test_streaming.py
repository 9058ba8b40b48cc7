import json

from pyspark.sql import functions as F

from furlong.streaming import meetings as M

SCHEMA = "meeting_id string, race_id string, horse string, position int"


def test_a_meeting_is_rated_once_complete_and_again_when_it_changes(spark, tmp_path):
    scheduled = spark.createDataFrame([("m1", "m1_1"), ("m1", "m1_2"), ("m2", "m2_1")], "meeting_id string, race_id string")
    (tmp_path / "in").mkdir()

    def arrive(name, rows):
        (tmp_path / "in" / name).write_text("\n".join(json.dumps(dict(zip(("meeting_id", "race_id", "horse", "position"), r, strict=True))) for r in rows))
        M.follow(spark, f"{tmp_path}/in", SCHEMA, f"{tmp_path}/store", f"{tmp_path}/out", f"{tmp_path}/ck", scheduled, lambda df: df.withColumn("figure", 100 - F.col("position"))).awaitTermination()

    out = lambda: sorted((r.meeting_id, r.race_id, r.horse, r.figure) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    arrive("1.json", [("m1", "m1_1", "a", 1), ("m1", "m1_1", "b", 2), ("m2", "m2_1", "c", 1)])
    assert out() == [("m2", "m2_1", "c", 99)]
    arrive("2.json", [("m1", "m1_2", "d", 1)])
    assert len(out()) == 4
    arrive("3.json", [("m1", "m1_1", "b", 3)])
    assert ("m1", "m1_1", "b", 97) in out() and len(out()) == 4


def test_windows_over_an_event_stream(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    events.write.parquet(f"{tmp_path}/e")
    stream = spark.readStream.schema(events.schema).parquet(f"{tmp_path}/e")
    q = M.rolling_counts(stream).writeStream.outputMode("complete").format("memory").queryName("rolled").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.sql("select sum(n) from rolled").first()[0] == events.count()
