from pyspark.sql import functions as F

from statloom.streaming import events as streams


def _write(spark, tmp_path, batches):
    for i, rows in enumerate(batches):
        df = spark.createDataFrame(rows, "event_id long, ts string, user_id long, value double")
        df.withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    return str(tmp_path / "in")


def test_numbers_continue_across_batches(spark, tmp_path):
    first = [(1, "2024-01-01 00:00:00", 1, 1.0), (2, "2024-01-01 00:01:00", 1, 2.0), (3, "2024-01-01 00:02:00", 2, 3.0)]
    folder = _write(spark, tmp_path, [first])
    stream = streams.read_events(spark, folder).select("event_id", "user_id", "ts")
    out = str(tmp_path / "out")
    assert streams.numbered_events(stream, "user_id", "ts", "event_id", folder=out).count() == 3
    _write(spark, tmp_path, [[(6, "2024-01-01 00:03:00", 1, 4.0), (5, "2024-01-01 00:03:00", 1, 4.0), (4, "2024-01-01 00:03:00", 1, 4.0)]])
    stream = streams.read_events(spark, folder).select("event_id", "user_id", "ts")
    rows = {r["event_id"]: r["sequence_num"] for r in streams.numbered_events(stream, "user_id", "ts", "event_id", folder=out).collect()}
    # restarted from the checkpoint, nothing twice; equal times are numbered by event
    assert rows == {1: 1, 2: 2, 3: 1, 4: 3, 5: 4, 6: 5}
    nothing = streams.read_events(spark, folder).select("event_id", "user_id", "ts").where("event_id < 0")
    assert streams.numbered_events(nothing, "user_id", folder=str(tmp_path / "none")).count() == 0


def test_late_events_are_cut_off(spark, tmp_path):
    folder = _write(spark, tmp_path, [[(1, "2024-01-03 00:00:00", 1, 1.0)]])
    out = str(tmp_path / "out")

    def rates():
        return streams.windowed_rates(streams.read_events(spark, folder), [], "value", "1 day", delay="1 hour")

    streams.run(rates(), folder=out)
    _write(spark, tmp_path, [[(2, "2024-01-01 12:00:00", 1, 1.0), (3, "2024-01-05 00:00:00", 1, 5.0)]])
    rows = streams.run(rates(), folder=out).collect()
    assert [(str(r["window_start"]), r["n"]) for r in rows] == [("2024-01-03 00:00:00", 1)]


def test_redelivered_events_are_dropped(spark, tmp_path):
    rows = [(1, "2024-01-01 00:00:00", 1, 1.0), (1, "2024-01-01 00:00:00", 1, 1.0), (2, "2024-01-01 00:01:00", 1, 1.0)]
    folder = _write(spark, tmp_path, [rows])
    assert streams.run(streams.unique_events(streams.read_events(spark, folder))).count() == 2


def test_log_is_partitioned(spark, tmp_path):
    folder = _write(spark, tmp_path, [[(1, "2024-01-01 00:00:00", 1, 1.0), (2, "2024-01-02 00:00:00", 1, 1.0)]])
    log = streams.append_log(streams.read_events(spark, folder), str(tmp_path / "log"), F.date_format("ts", "yyyy-MM-dd"))
    assert sorted(r["log_part"] for r in log.collect()) == ["2024-01-01", "2024-01-02"]


def test_numbers_over_several_micro_batches(spark, tmp_path):
    """One file a trigger, a hot key, NULL keys and equal times: numbers follow the batches, and are gapless."""
    batches = []
    for b in range(4):
        rows = [(100 * b + i, f"2024-01-01 00:0{b}:00", None if i % 5 == 0 else 1 if i % 2 else 2 + i % 7, 0.5) for i in range(40)]
        batches.append(rows)
    folder = _write(spark, tmp_path, batches)
    stream = streams.read_events(spark, folder, files_per_trigger=1).select("event_id", "user_id", "ts")
    got = streams.numbered_events(stream, "user_id", "ts", "event_id", folder=str(tmp_path / "out")).collect()
    by_user = {}
    for event, _, user, _ in sorted(r for rows in batches for r in rows):
        by_user.setdefault(user, []).append(event)
    assert len(got) == 160
    assert {(r.user_id, r.event_id): r.sequence_num for r in got} == {(u, e): k + 1 for u, events in by_user.items() for k, e in enumerate(events)}


def test_profiles_add_up(spark, tmp_path):
    rows = [(i, "2024-01-01 00:00:00", i % 3, float(i * i % 1009)) for i in range(3000)]
    folder = _write(spark, tmp_path, [rows[:1000], rows[1000:]])
    stored = streams.run(streams.incremental_profile(streams.read_events(spark, folder), ["user_id"], "value"), "complete")
    got = streams.merged_profiles(stored).first()
    values = sorted(r[3] for r in rows)
    mean = sum(values) / 3000
    assert got["count"] == 3000 and abs(got["mean"] - mean) < 1e-9 and (got["min"], got["max"]) == (values[0], values[-1])
    assert abs(got["std"] - (sum((v - mean) ** 2 for v in values) / 2999) ** 0.5) < 1e-9
    for q, p in zip(got["quartiles"], (0.25, 0.5, 0.75)):
        assert sum(v < q for v in values) / 3000 <= p + 0.01 and sum(v <= q for v in values) / 3000 >= p - 0.01
    assert abs(got["distinct_estimate"] / len(set(values)) - 1) < 0.03
    assert streams.merged_profiles(stored, ["user_id"]).count() == 3
