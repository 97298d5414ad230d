"""Structured Streaming behaviour: restart from checkpoint, late rows, complete vs append."""

import os
import time
from pathlib import Path

from pyspark.sql import functions as F

from courtload import schemas
from courtload.operators.alerts import apply_alerts, windowed_exertion
from courtload.session import scratch_path
from courtload.sources.telemetry import telemetry_decode
from courtload.streaming import telemetry as st


def _msg(player, t, hr, dist=100.0):
    return (f'{{"game_id": "g1", "player_id": "{player}", "team_id": "t1", "event_time": {t}, '
            f'"speed_mph": 5.0, "cumulative_distance": {dist}, "heart_rate_bpm": {hr}}}')


def _stage(spark, folder, name, lines, mtime):
    path = os.path.join(folder, name)
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("overwrite").text(path)
    for root, _, files in os.walk(path):
        for f in files:
            os.utime(os.path.join(root, f), (mtime, mtime))
    return path


def _thresholds(spark):
    return spark.createDataFrame([(1, 150.0, 250.0)], "player_id long, hr_alert_threshold double, "
                                                      "distance_alert_threshold double")


def test_restart_from_checkpoint_adds_no_duplicates(spark):
    src = scratch_path(spark, "src").replace("file:", "")
    os.makedirs(src)
    base = time.time() - 100
    _stage(spark, src, "b0", [_msg(1, 0.5, 160.0), _msg(1, 30.0, 100.0), _msg(2, 10.0, 100.0)], base)
    out, ckpt = scratch_path(spark, "log"), scratch_path(spark, "log-ckpt")

    def run():
        raw = spark.readStream.schema("value string").option("recursiveFileLookup", "true").text(src)
        alerts = apply_alerts(windowed_exertion(telemetry_decode(raw, schemas.TELEMETRY)), _thresholds(spark))
        q = st.start_alert_log(alerts, out, ckpt)
        q.awaitTermination()
        return q

    run()
    first = st.alert_log(spark, out).count()
    _stage(spark, src, "b1", [_msg(1, 200.0, 170.0)], base + 10)
    q = run()
    second = st.alert_log(spark, out)
    # the minute [0, 60) closed after b1 moved the watermark to 190 s; it is written once
    assert second.count() >= first
    assert second.groupBy("player_id", "window_start").count().filter("count > 1").count() == 0
    assert sum(p["numInputRows"] for p in q.recentProgress) == 1


def test_late_row_changes_complete_but_not_append(spark):
    src = scratch_path(spark, "late").replace("file:", "")
    os.makedirs(src)
    base = time.time() - 100
    _stage(spark, src, "b0", [_msg(1, 5.0, 100.0)], base)
    _stage(spark, src, "b1", [_msg(1, 300.0, 100.0)], base + 10)      # watermark -> 290 s
    _stage(spark, src, "b2", [_msg(1, 302.0, 100.0)], base + 20)      # window [0, 60) is emitted here
    # Late rows are judged against the previous batch's watermark (290 s from here on).
    _stage(spark, src, "b3", [_msg(1, 6.0, 200.0)], base + 30)        # late for window [0, 60)

    def stream():
        raw = (spark.readStream.schema("value string").option("recursiveFileLookup", "true")
                    .option("maxFilesPerTrigger", "1").text(src))
        return windowed_exertion(telemetry_decode(raw, schemas.TELEMETRY))

    live_path = scratch_path(spark, "late-live")
    q = st.start_live(stream(), "late_live", scratch_path(spark, "late-live-ckpt"), live_path)
    q.awaitTermination()
    complete = {r["window_start"].second + 60 * r["window_start"].minute: r
                for r in st.live_table(spark, "late_live", live_path).collect()}
    assert complete[0]["tracking_frames"] == 2                        # complete mode kept the late row

    log = scratch_path(spark, "late-log")
    thr = spark.createDataFrame([(1, 0.0, 0.0)], "player_id long, hr_alert_threshold double, "
                                                 "distance_alert_threshold double")
    q2 = st.start_alert_log(apply_alerts(stream(), thr), log, scratch_path(spark, "late-log-ckpt"))
    q2.awaitTermination()
    appended = st.alert_log(spark, log).filter(F.minute("window_start") == 0).collect()
    assert len(appended) == 1 and appended[0]["tracking_frames"] == 1  # append mode dropped it


def test_readouts_of_the_live_view(spark):
    from courtload.operators import alerts as al
    from tests.conftest import SF_SMALL
    from courtload.plans.graph import Graph
    df = st.alert_stream(st.telemetry_stream(spark, SF_SMALL), st.static_thresholds(Graph.of(spark, SF_SMALL).thresholds))
    path = scratch_path(spark, "live-view")
    st.drain(st.start_live(df, "player_exertion", scratch_path(spark, "live-view-ckpt"), path))
    live = st.live_table(spark, "player_exertion", path)
    assert set(st.READOUTS) == {"live_exertion_ranking", "heart_rate_alerts", "distance_alerts", "substitution_candidates",
                                "team_alert_summary"}
    for name in st.READOUTS:
        got, want = st.live_readout(spark, name), getattr(al, name)(live)
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def _copy_table(spark, folder, files):
    """sf0.001 with ``events`` as a folder of part files."""
    from pathlib import Path

    from tests.conftest import SF_SMALL
    folder = Path(folder)
    folder.mkdir()
    for p in Path(SF_SMALL).glob("*.parquet"):
        if p.stem != "events":
            (folder / p.name).symlink_to(p)
    spark.read.parquet(f"{SF_SMALL}/events.parquet").repartition(files).write.parquet(str(folder / "events.parquet"))
    return str(folder)


def test_streams_read_a_folder_of_files_like_one_file(spark, tmp_path):
    from courtload.plans.registry import QUERIES
    from tests.conftest import SF_SMALL
    folder = _copy_table(spark, tmp_path / "sf", 4)
    for name in ("telemetry_source", "stream_windowed_exertion_wide", "stream_live_exertion", "stream_live_exertion_update"):
        one, many = (sorted(map(tuple, QUERIES[name](spark, sf).collect()), key=repr) for sf in (SF_SMALL, folder))
        assert one and one == many, name
    # file by file, several micro-batches give the same table
    path = scratch_path(spark, "by-file")
    q = st.drain(st.start_live(windowed_exertion(st.telemetry_stream(spark, folder, 1), delay=None, size="7 days", keys=("player_id",)),
                               "by_file", f"{path}-ckpt", path, keys=("window_start", "window_end", "player_id")))
    assert sum(p["numInputRows"] > 0 for p in q.recentProgress) == 4
    got = st.live_table(spark, "by_file", path, ("window_start", "window_end", "player_id"))
    from courtload.functions.exprs import round_doubles
    want = QUERIES["windowed_exertion_wide"](spark, SF_SMALL)
    assert sorted(map(tuple, round_doubles(got).select(want.columns).collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_wide_windows_hold_several_rows(spark):
    from courtload.plans.registry import QUERIES
    from tests.conftest import SF_MID, SF_SMALL
    for sf in (SF_SMALL, SF_MID):
        assert QUERIES["windowed_exertion_wide"](spark, sf).agg(F.max("tracking_frames")).first()[0] > 1


def test_live_view_is_whole_while_batches_are_written(spark, tmp_path):
    folder = _copy_table(spark, tmp_path / "sf", 6)
    path, seen = scratch_path(spark, "live-read"), []
    keys = ("window_start", "window_end", "player_id")
    df = windowed_exertion(st.telemetry_stream(spark, folder, 1), size="7 days", keys=("player_id",))
    original = st.live_table

    def watched(session, name, where, by=keys):
        if seen:                                 # the view of the batch before, read after this batch's files are there
            assert session.table(name).agg(F.sum("tracking_frames")).first()[0] == seen[-1]
        out = original(session, name, where, by)
        seen.append(out.agg(F.sum("tracking_frames")).first()[0])
        return out
    st.live_table = watched
    try:
        q = st.drain(st.start_live(df, "live_read", f"{path}-ckpt", path, mode="update", keys=keys, compact_every=2))
    finally:
        st.live_table = original
    assert len(seen) >= 6 and seen == sorted(seen) and q.exception() is None
    found = st._folders(spark, path)
    assert sum(kind == "base" for kind, _ in found) == 2      # older bases and the changes under them are gone
    assert original(spark, "live_read", path, keys).agg(F.sum("tracking_frames")).first()[0] == seen[-1]


def test_telemetry_source_and_stop_all(spark):
    from courtload.sources.telemetry import telemetry_source
    src = scratch_path(spark, "src-any").replace("file:", "")
    os.makedirs(src)
    _stage(spark, src, "b0", [_msg(1, 0.5, 100.0)], time.time() - 50)
    raw = telemetry_source(spark, fmt="text", options={"recursiveFileLookup": "true"},
                           schema=None, path=src)
    q = (telemetry_decode(raw, schemas.TELEMETRY).writeStream.format("memory").queryName("tsrc")
         .option("checkpointLocation", scratch_path(spark, "tsrc-ckpt")).start())
    q.processAllAvailable()
    assert spark.table("tsrc").count() == 1
    assert "tsrc" in st.stop_all(spark)
    assert not q.isActive


def test_alert_job_and_memory_sink(spark):
    from courtload.plans.graph import Graph
    from tests.conftest import SF_SMALL
    g = Graph.of(spark, SF_SMALL)
    root = scratch_path(spark, "alert-job")
    qs = st.start_alert_job(st.telemetry_stream(spark, SF_SMALL), g.thresholds, root)
    for q in qs.values():
        q.awaitTermination()
    live = st.live_table(spark, "player_exertion", f"{root}/live")
    log = st.alert_log(spark, f"{root}/alerts")
    assert live.count() > 0 and 0 < log.count() <= live.filter("fatigue_alert").count()
    mem = st.start_live(windowed_exertion(st.telemetry_stream(spark, SF_SMALL)), "exertion_mem",
                        scratch_path(spark, "mem-ckpt"), sink="memory")
    mem.awaitTermination()
    assert spark.table("exertion_mem").count() == live.count()


def test_update_mode_live_table_keeps_latest_version_and_evicts_state(spark):
    src = scratch_path(spark, "upd").replace("file:", "")
    os.makedirs(src)
    base = time.time() - 100
    _stage(spark, src, "b0", [_msg(1, 5.0, 100.0)], base)
    _stage(spark, src, "b1", [_msg(1, 30.0, 200.0)], base + 10)      # same window, second version
    _stage(spark, src, "b2", [_msg(1, 300.0, 100.0)], base + 20)     # watermark -> 290 s
    _stage(spark, src, "b3", [_msg(1, 302.0, 100.0)], base + 30)     # window [0, 60) leaves the state
    _stage(spark, src, "b4", [_msg(1, 6.0, 300.0)], base + 40)       # late for [0, 60): dropped

    def stream():
        raw = (spark.readStream.schema("value string").option("recursiveFileLookup", "true")
                    .option("maxFilesPerTrigger", "1").text(src))
        return windowed_exertion(telemetry_decode(raw, schemas.TELEMETRY))

    runs = {}
    for mode in ("update", "complete"):
        path = scratch_path(spark, f"upd-{mode}")
        q = st.start_live(stream(), f"upd_{mode}", scratch_path(spark, f"upd-{mode}-ckpt"), path, mode=mode)
        q.awaitTermination()
        state_rows = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
        runs[mode] = (path, state_rows[-1])
    path, upd_state = runs["update"]
    versions = st.live_versions(spark, path)
    assert versions.filter(F.minute("window_start") == 0).count() == 2         # one row per changing batch
    live = {r["window_start"].minute: r for r in st.live_table(spark, "upd_view", path).collect()}
    assert sorted(live) == [0, 5]                                               # one row per window
    assert live[0]["tracking_frames"] == 2 and live[0]["avg_heart_rate"] == 150.0  # latest version, late row dropped
    assert upd_state < runs["complete"][1]                                      # closed window evicted from state


def test_alert_log_uses_as_many_tasks_as_the_batch_needs(spark):
    from courtload.plans.graph import Graph
    from tests.conftest import SF_SMALL
    g = Graph.of(spark, SF_SMALL)
    alerts = st.alert_stream(st.telemetry_stream(spark, SF_SMALL), st.static_thresholds(g.thresholds))
    counts = {}
    key, first = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.parallelismFirst"
    old = spark.conf.get(key)
    spark.conf.set(first, "false")               # sizes alone decide
    for size in ("64m", "2k"):
        path = scratch_path(spark, f"alog-{size}")
        spark.conf.set(key, size)
        try:
            st.drain(st.start_alert_log(alerts, path, f"{path}-ckpt"))
        finally:
            spark.conf.set(key, old)
        files = [f for _, _, names in os.walk(path.removeprefix("file:")) for f in names if f.endswith(".parquet")]
        counts[size] = (st.alert_log(spark, path).count(), len(files))
    spark.conf.unset(first)
    assert counts["64m"][0] == counts["2k"][0] > 0
    assert counts["64m"][1] <= 2 and counts["2k"][1] > 4


def test_alert_log_reads_entered_batches_alone(spark):
    from courtload.plans.graph import Graph
    from tests.conftest import SF_SMALL
    alerts = st.alert_stream(st.telemetry_stream(spark, SF_SMALL), st.static_thresholds(Graph.of(spark, SF_SMALL).thresholds))
    path = scratch_path(spark, "entered")
    st.drain(st.start_alert_log(alerts, path, f"{path}-ckpt"))
    n, commits = st.alert_log(spark, path).count(), st.alert_commits(spark, path).collect()
    assert sum(c["rows"] for c in commits) == n > 0 and all(c["files"] >= 1 and (c["bytes"] > 0) == (c["rows"] > 0) for c in commits)
    st.alert_log(spark, path).write.parquet(f"{path}/batch=99")     # written, but its entry was never made
    assert st.alert_log(spark, path).count() == n


def test_progress_table_loses_no_batch(spark):
    src, path = scratch_path(spark, "many").replace("file:", ""), scratch_path(spark, "progress")
    os.makedirs(src)
    for k in range(150):
        Path(src, f"{k:03}.txt").write_text(f"row {k}\n")
    listener = st.start_progress(spark, path, every=20)
    try:
        q = spark.readStream.option("maxFilesPerTrigger", "1").text(src).writeStream.queryName("many").format("noop").option(
            "checkpointLocation", scratch_path(spark, "many-ckpt")).trigger(availableNow=True).start()
        st.drain(q)
        deadline = time.time() + 60      # the listener bus runs behind the query
        while st.progress_history(spark, path).count() < 150 and time.time() < deadline:
            time.sleep(0.5)
    finally:
        st.stop_progress(listener)
    got = st.progress_history(spark, path)
    assert len(q.recentProgress) <= 100
    assert got.agg(F.count_distinct("batch_id"), F.sum("num_input_rows")).first()[:] == (150, 150) and got.count() == 150


def test_value_gate_is_observed_while_rows_are_written_or_streamed(spark):
    from pyspark.sql import Observation

    from courtload.operators import quality
    from tests.conftest import SF_SMALL
    rows = st.telemetry_decode(st.telemetry_encode(st.telemetry_events(spark.read.parquet(f"{SF_SMALL}/events.parquet"))))
    rules = {"heart_rate_bpm": (80.0, 180.0), "speed_mph": (4.0, 30.0)}      # decoded rows are within the stream's own ranges
    want = sorted(map(tuple, quality.gate_impossible_values(rows, rules).collect()))
    assert all(r[3] > 0 for r in want)
    seen = Observation("g2")
    quality.observe_values(rows, seen, rules).write.format("noop").mode("overwrite").save()
    assert sorted(map(tuple, quality.gate_observed_values(spark, [seen.get], rules).collect())) == want

    path = scratch_path(spark, "observed")
    listener = st.start_progress(spark, path)
    try:
        stream = quality.observe_values(st.telemetry_stream(spark, SF_SMALL), rules=rules)
        q = st.drain(stream.writeStream.format("noop").option("checkpointLocation", scratch_path(spark, "observed-ckpt")).trigger(availableNow=True).start())
        deadline = time.time() + 60
        while not st.progress_history(spark, path).where(F.col("run_id") == str(q.runId)).count() and time.time() < deadline:
            time.sleep(0.3)
    finally:
        st.stop_progress(listener)
    assert sorted(map(tuple, st.gate_stream_values(spark, path, str(q.runId), rules=rules).collect())) == want


def test_quiet_stream_leaves_an_empty_log(spark):
    schema = spark.createDataFrame([(1,)], "a int").schema
    assert st.alert_log(spark, scratch_path(spark, "no-log"), schema).count() == 0
