"""A20 from mergeable summaries: exact for any ids, any merging order, and kept by a live feed in update mode."""

import os
import time

import pytest
from pyspark.sql import functions as F

from courtload import schemas
from courtload.operators import team_windows as tw
from courtload.operators.alerts import apply_alerts, team_alert_summary, windowed_exertion
from courtload.session import scratch_path
from courtload.sources.telemetry import kafka_options, telemetry_decode, telemetry_source
from courtload.streaming import telemetry as st
from tests.test_streaming import _msg, _stage, _thresholds

IDS = [None, "", "0", "1", "1", "01", " 1", "-1", "32768", "32769", "65537", "9223372036854775807", "9223372036854775808", "x", "X", "x"]


def _alerts(spark):
    rows = [(t, p, w, 60.0 + 7.3 * (i % 5) if i % 6 else None, i % 2 == 0, i % 3 == 0 if i % 4 else None, i % 5 == 0)
            for t in ("a", "b", None) for w in (0, 1, 2) for i, p in enumerate(IDS[w:] + IDS[:1])]
    return spark.createDataFrame(rows, "team_id string, player_id string, window_start int, avg_heart_rate double, "
                                       "heart_rate_alert boolean, distance_alert boolean, fatigue_alert boolean")


def _set(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def test_rolled_up_summaries_equal_the_rows(spark):
    alerts = _alerts(spark)
    counts = tw.window_counts(alerts)
    want = _set(team_alert_summary(alerts))
    assert _set(tw.team_summary(counts)) == want
    pairs = tw.merge_counts(counts.withColumn("half", F.col("window_start") > 0), ["team_id", "half"])
    assert _set(tw.team_summary(pairs)) == want
    got = tw.distinct_members(counts, ["window_start"])
    assert _set(got) == _set(alerts.groupBy("window_start").agg(F.count_distinct("player_id").alias("players_monitored")))
    assert tw.team_summary(tw.window_counts(alerts.limit(0))).count() == 0


def test_integer_ids(spark):
    ids = [None, -(2 ** 63), -5, 0, 1, 32768, 32769, 2 ** 63 - 1, 1]
    rows = spark.createDataFrame([("t", i, 0) for i in ids], "team_id string, player_id long, window_start int")
    assert tw.distinct_members(tw.player_bits(rows, ["team_id"]), ["team_id"]).first()["players_monitored"] == len(set(ids) - {None})


def test_update_mode_keeps_the_summaries_of_changed_windows(spark):
    src = scratch_path(spark, "tw").replace("file:", "")
    os.makedirs(src)
    base = time.time() - 100
    _stage(spark, src, "b0", [_msg(1, 5.0, 160.0), _msg(2, 6.0, 100.0)], base)
    _stage(spark, src, "b1", [_msg(1, 30.0, 70.0)], base + 10)       # changes player 1's window: no alert any more
    _stage(spark, src, "b2", [_msg(3, 61.0, 200.0)], base + 20)
    raw = (spark.readStream.schema("value string").option("recursiveFileLookup", "true")
                .option("maxFilesPerTrigger", "1").text(src))
    alerts = apply_alerts(windowed_exertion(telemetry_decode(raw, schemas.TELEMETRY)), _thresholds(spark))
    for every in (2, 20):                                            # with and without a compaction in between
        path = scratch_path(spark, f"tw-{every}")
        st.drain(st.start_live(alerts, f"tw_{every}", f"{path}-ckpt", path, mode="update", compact_every=every, summaries=f"{path}-sums"))
        live = st.live_table(spark, f"tw_view_{every}", path)
        assert live.count() == 3
        assert _set(tw.team_summary(st.team_windows(spark, f"{path}-sums"))) == _set(team_alert_summary(live))
    with pytest.raises(ValueError):
        st.start_live(alerts, "tw_no", "c", "p", mode="complete", summaries="s")


def test_streamed_bitmaps_count_players(spark):
    src = scratch_path(spark, "bits").replace("file:", "")
    os.makedirs(src)
    for k, players in enumerate(([1, 2], [2, 3], [3, 9])):
        _stage(spark, src, f"b{k}", [_msg(p, 10.0 + k, 100.0) for p in players], time.time() - 100 + 10 * k)
    raw = (spark.readStream.schema("value string").option("recursiveFileLookup", "true")
                .option("maxFilesPerTrigger", "1").text(src))
    bits = tw.player_bits(telemetry_decode(raw, schemas.TELEMETRY), ["team_id", F.window("event_timestamp", "1 minute").alias("w")])
    out = scratch_path(spark, "bits-out")
    st.drain(bits.writeStream.outputMode("update").option("checkpointLocation", f"{out}-ckpt").trigger(availableNow=True)
             .foreachBatch(lambda b, i: b.write.mode("overwrite").parquet(f"{out}/{i}")).start())
    emitted = spark.read.parquet(f"{out}/*")
    assert emitted.count() == 3                                      # a version per batch, all merged
    assert tw.distinct_members(emitted, ["team_id"]).first()["players_monitored"] == 4


class _Reader:
    def __init__(self):
        self.asked = {}

    def format(self, name):
        self.asked["format"] = name
        return self

    def options(self, **given):
        self.asked["options"] = given
        return self

    def load(self, *path):
        self.asked["path"] = path
        return self


def test_kafka_reader_gets_its_options():
    class Session:
        readStream = _Reader()
    options = kafka_options(["kafka:9092", "k2:9092"], "realtime_player_telemetry", max_per_trigger=5000, kafka_security_protocol="SSL")
    asked = telemetry_source(Session, options=options).asked
    assert asked == {"format": "kafka", "path": (), "options": {
        "kafka.bootstrap.servers": "kafka:9092,k2:9092", "subscribe": "realtime_player_telemetry", "startingOffsets": "earliest",
        "failOnDataLoss": "true", "maxOffsetsPerTrigger": "5000", "kafka.security.protocol": "SSL"}}
