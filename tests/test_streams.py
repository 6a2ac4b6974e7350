import datetime as dt
import os
import time

import pytest

from pyspark.sql import functions as F

from umpire.streaming import monitor as SM
from umpire.functions.events import classify_arrivals
from umpire.sources import testdata as TD
from umpire.streaming import rendezvous as RV
from umpire.streaming.runner import named_folder, run_available_now, run_to_end, table_stream, tick, ticking


def _write_events(spark, folder, rows):
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{folder}/events.parquet")


def test_late_truth_outside_bound_is_not_joined(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1, 0, 0)
    rows = [(i, t0 + dt.timedelta(minutes=10 * i), 1, "purchase", 1.0, '{"k": 1}') for i in range(6)]
    _write_events(spark, str(tmp_path), rows)
    ev = table_stream(spark, str(tmp_path), "events")
    caps = ev.select(F.col("event_id").cast("string").alias("inference_id"), "ts")
    truth = table_stream(spark, str(tmp_path), "events").select(
        F.col("event_id").cast("string").alias("eventId"),
        (F.col("ts") + F.when(F.col("event_id") % 2 == 0, F.expr("INTERVAL 1 HOUR"))
         .otherwise(F.expr("INTERVAL 5 HOURS"))).alias("truth_ts"))
    out = run_available_now(SM.late_truth_join(caps, truth, "3 hours", "6 hours")
                            .select("inference_id"), "test_late")
    assert sorted(int(r.inference_id) for r in out.collect()) == [0, 2, 4]


def test_hourly_windows_close_behind_the_watermark(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1, 0, 30)
    rows = [(i, t0 + dt.timedelta(hours=i), 1, "purchase", 100.0, "{}") for i in range(5)]
    _write_events(spark, str(tmp_path), rows)
    scored = table_stream(spark, str(tmp_path), "events").withColumn("score", F.col("value") / 500.0) \
        .withColumn("truth", F.lit(1))
    out = run_available_now(SM.windowed_monitor(scored, "1 hour", "1 hour"), "test_windows")
    # max ts 04:30 -> watermark 03:30: windows ending at or before 03:30 are final
    starts = sorted(r.window_start.hour for r in out.collect())
    assert starts == [0, 1, 2]


def test_folder_tables_stream_as_folders(spark, tmp_path):
    rows = [(i, dt.datetime(2024, 1, 1), 1, "view", 1.0, "{}") for i in range(3)]
    _write_events(spark, str(tmp_path), rows)
    out = run_available_now(table_stream(spark, str(tmp_path), "events").select("event_id"), "test_folder")
    assert out.count() == 3


def _add_events(spark, folder, rows):
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/events.parquet")


def test_a_stopped_stream_goes_on_and_repeats_nothing(spark, tmp_path):
    """Three starts of a named query, files added between; nothing is read or emitted twice."""
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, t0 + dt.timedelta(minutes=20 * i), 1, "purchase" if i % 3 else "view", float(i), "{}") for i in range(30)]
    src, folder = str(tmp_path / "in"), str(tmp_path / "query")

    def query():
        scored = ticking(TD.scored_from(table_stream(spark, src, "events", max_files=1)), folder)
        return SM.windowed_monitor(scored, "1 hour", "1 hour", threshold=0.01)

    seen = []
    for lo, hi in ((0, 10), (10, 20), (20, 30)):
        for part in (rows[lo:lo + 5], rows[lo + 5:hi]):  # two files, two bounded micro-batches
            _add_events(spark, src, part)
        seen.append([r.window_start for r in run_available_now(query(), "resumed", folder=folder).collect()])
    assert 0 < len(seen[0]) < len(seen[1]) < len(seen[2]) < 10
    run_available_now(query(), "resumed", folder=folder)  # nothing new
    tick(spark, folder, t0 + dt.timedelta(days=1))
    out = run_available_now(query(), "resumed", folder=folder).orderBy("window_start").collect()
    batch = SM.windowed_monitor(TD.scored_from(spark.read.parquet(f"{src}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))),
                                "1 hour", "1 hour", threshold=0.01).orderBy("window_start").collect()
    assert out == batch and len(out) == 10
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"


def _arrival(i, minute, user, part, key=None):
    return (i, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute), f"data/{user}/{part}.csv" if key is None else key, user)


def _arrivals(spark, folder):
    schema = "event_id long, ts timestamp, key string, batch_id string"
    return classify_arrivals(ticking(spark.readStream.schema(schema).parquet(f"{folder}/in"), f"{folder}/q"))


def _put(spark, folder, rows):
    spark.createDataFrame(rows, "event_id long, ts timestamp, key string, batch_id string").coalesce(1).write.mode("append").parquet(f"{folder}/in")


def test_arrivals_are_answered_in_event_time_across_restarts(spark, tmp_path):
    import random
    rnd = random.Random(9)
    rows = [_arrival(i, i // 2, rnd.choice("abc"), rnd.choice(["df", "y"])) for i in range(60)]
    base = str(tmp_path)
    late = rows[:]
    for lo in range(0, 60, 20):  # arrivals of half an hour come out of order
        part = late[lo:lo + 20]
        rnd.shuffle(part)
        _put(spark, base, part)
        run_available_now(RV.rendezvous_stream(_arrivals(spark, base), "30 minutes"), "arrivals", folder=f"{base}/q")
    tick(spark, f"{base}/q", dt.datetime(2024, 1, 2))
    out = run_available_now(RV.rendezvous_stream(_arrivals(spark, base), "30 minutes"), "arrivals", folder=f"{base}/q")
    batch = RV.rendezvous_batch(classify_arrivals(spark.createDataFrame(rows, "event_id long, ts timestamp, key string, batch_id string")))
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, batch.collect())) and batch.count() == 60


def test_late_arrivals_are_answered_and_old_parts_expire(spark, tmp_path):
    base = str(tmp_path)
    _put(spark, base, [_arrival(1, 0, "a", "df"), _arrival(2, 0, "b", "df"), _arrival(3, 500, "c", "df")])

    def run():
        query = RV.rendezvous_stream(_arrivals(spark, base), "10 minutes", expiry_ms=2 * 3_600_000)
        return {r.event_id: r.message.split(",")[0] for r in run_available_now(query, "late", folder=f"{base}/q").collect()}

    assert run() == {1: "df.csv uploaded", 2: "df.csv uploaded"}
    _put(spark, base, [_arrival(4, 5, "c", "y"), _arrival(5, 505, "a", "y")])  # the first is far behind the watermark
    tick(spark, f"{base}/q", dt.datetime(2024, 1, 2))
    got = run()
    assert got[5] == "y.csv uploaded"  # the part of minute 0 was forgotten
    assert sorted([got[3], got[4]]) == ["Both files uploaded", "y.csv uploaded"]


def test_captures_without_truth_come_out_of_the_outer_join(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1)
    _write_events(spark, str(tmp_path), [(i, t0 + dt.timedelta(minutes=10 * i), 1, "purchase", 1.0, "{}") for i in range(12)])

    def query(folder):
        ev = table_stream(spark, str(tmp_path), "events").withColumn("inference_id", F.col("event_id").cast("string"))
        truth = table_stream(spark, str(tmp_path), "events").where("event_id % 3 = 0").select(
            F.col("event_id").cast("string").alias("eventId"), (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("truth_ts"))
        return SM.late_truth_join(ticking(ev.select("inference_id", "ts"), folder, key="inference_id"),
                                  ticking(truth, folder, "truth_ts", key="eventId"), "3 hours", "3 hours", "left_outer").select("inference_id", "eventId")

    out = run_to_end(query, "outer", spark, t0 + dt.timedelta(days=1), folder=str(tmp_path / "q"))
    assert sorted((int(r[0]), r[1] is not None) for r in out.collect()) == [(i, i % 3 == 0) for i in range(12)]


def test_named_folders_are_stable(spark):
    assert named_folder(spark, "x") == named_folder(spark, "x") != named_folder(spark, "y")


def test_a_retried_epoch_replaces_its_rows_and_half_written_ones_are_not_seen(spark, tmp_path):
    from pyspark.sql import functions as F
    path = str(tmp_path / "capture")
    write = SM.scoring_writer(lambda batch: batch.withColumn("answer", F.col("id") * 2))
    write(spark.range(5), 0, path)
    write(spark.range(5, 8), 1, path)
    write(spark.range(5, 8), 1, path)  # retried
    spark.range(3).withColumn("answer", F.lit(0).cast("long")).write.parquet(f"{path}/rows/epoch=2")  # stopped before its commit
    got = SM.read_captures(spark, path)
    assert sorted((r["id"], r["answer"]) for r in got.collect()) == [(i, 2 * i) for i in range(8)]
    spark.range(1).withColumn("answer", F.lit(0).cast("long")).write.mode("append").parquet(f"{path}/rows/epoch=1")
    with pytest.raises(ValueError):
        SM.read_captures(spark, path)


def test_files_that_land_in_two_steps_trigger_and_are_read_together(spark, tmp_path):
    """The whole way of an arrival: files seen as they land, answered, and their folder read."""
    from umpire.plans.lifecycle import ingest_folder
    landing, folder = tmp_path / "landing", str(tmp_path / "q")
    for batch in ("b1", "b2"):
        (landing / "data" / batch).mkdir(parents=True)

    def run():
        query = RV.rendezvous_stream(classify_arrivals(ticking(SM.object_arrivals(spark, str(landing)), folder)), "1 second")
        out = run_available_now(query, "objects", folder=folder)
        return sorted((r.batch_id, r.folder, r.message.split(",")[0]) for r in out.collect())

    (landing / "data" / "b1" / "df.csv").write_text("a,b\n1,x\n2,3\n")
    (landing / "data" / "b2" / "notes.csv").write_text("n\n1\n")
    run()
    (landing / "data" / "b1" / "y.csv").write_text("result_match\nhome_win\nhome_not_win\n")
    (landing / "data" / "b1" / "zmore.csv").write_text("a,c\n7,8\n9,10\n11,12\n")
    os.utime(landing / "data" / "b1" / "y.csv", (time.time() + 5, time.time() + 5))
    tick(spark, folder, dt.datetime.now() + dt.timedelta(days=1))
    assert run() == [("b1", "data/b1/", "Both files uploaded"), ("b1", "data/b1/", "df.csv uploaded")]
    rows = ingest_folder(spark, str(landing / "data" / "b1")).orderBy("row_id").collect()
    assert [tuple(r) for r in rows] == [(0, 1.0, None, "home_win", 7.0, 8.0), (1, 2.0, 3.0, "home_not_win", 9.0, 10.0), (2, None, None, None, 11.0, 12.0)]
    assert rows[0].__fields__ == ["row_id", "a", "b", "result_match", "zmore_a", "c"]
    with pytest.raises(ValueError):
        ingest_folder(spark, str(landing / "data" / "b1" / "none"))
