"""The streaming alert job.

Sources are ``readStream`` DataFrames; the windowing and alert logic is the
batch code of ``operators.alerts`` (it works on both).  Outputs:

* live exertion table -- ``sink="table"`` writes Parquet folders per
  micro-batch (foreachBatch) and registers a view over the latest version,
  so the live table lives in shared storage; ``sink="memory"`` is the
  in-driver memory table (small / interactive use only).
* alert log -- append mode Parquet, a folder per micro-batch: a window is
  written once, after the watermark passes its end.
"""

from __future__ import annotations

import json
import threading
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType

from courtload import config
from courtload.functions.exprs import literal_rows
from courtload.operators import alerts as _alerts
from courtload.operators import quality
from courtload.operators.alerts import apply_alerts, windowed_exertion
from courtload.operators.team_windows import window_counts
from courtload.session import files_in, finished_folders, is_folder, materialize, remove_path, replace_text
from courtload.sources.adapters import telemetry_events
from courtload.sources.files import read_optional
from courtload.sources.telemetry import telemetry_decode, telemetry_encode, telemetry_source


def table_stream(spark: SparkSession, sf_dir: str, table: str = "events",
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """A file stream over one parquet table of ``sf_dir``: a folder of part files, or a single file.

    A folder is opened itself, so every part file (also one added later) is read.  A single file is
    read as the one file of that name in its folder, as a file source opens folders only.
    """
    path = f"{sf_dir.rstrip('/')}/{table}.parquet"
    options = {"maxFilesPerTrigger": str(max_files_per_trigger)} if max_files_per_trigger else {}
    folder = is_folder(spark, path)
    if not folder:
        options["pathGlobFilter"] = f"{table}.parquet"
    return telemetry_source(spark, "parquet", options, spark.read.parquet(path).schema, path if folder else sf_dir)


def telemetry_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Events as telemetry messages (key, JSON value), decoded as the live job reads them."""
    events = table_stream(spark, sf_dir, max_files_per_trigger=max_files_per_trigger)
    return telemetry_decode(telemetry_encode(telemetry_events(events)))


def static_thresholds(thresholds: DataFrame) -> DataFrame:
    """Write the per-player thresholds once and read them back.

    The static side of a stream-static join is re-executed on every
    micro-batch; reading a written table keeps that to a small scan instead
    of the whole history aggregation.
    """
    return materialize(thresholds, "player_thresholds")


def alert_stream(telemetry: DataFrame, thresholds: DataFrame, size: str = config.WINDOW,
                 delay: str = config.WATERMARK) -> DataFrame:
    """Watermark, tumbling windows, stream-static threshold join, flags.

    ``thresholds`` should be a written table (``static_thresholds``).
    """
    return apply_alerts(windowed_exertion(telemetry, size=size, delay=delay), thresholds)


def _trigger(writer, trigger: str | None):
    if trigger in (None, "available_now"):
        return writer.trigger(availableNow=True)
    if trigger == "continuous_micro_batch":
        return writer
    return writer.trigger(processingTime=trigger)


LIVE_MODES = ("complete", "update")
VERSION_COL = "_batch"
WINDOW_KEYS = ("window_start", "window_end", "player_id", "team_id", "game_id")   # one live row per key
COMPACT_EVERY = 20   # micro-batches between two bases of an update-mode table


def start_live(df: DataFrame, name: str, checkpoint: str, path: str | None = None, sink: str = "table",
               trigger: str | None = "available_now", mode: str = "complete",
               keys: Sequence[str] = WINDOW_KEYS, compact_every: int = COMPACT_EVERY,
               summaries: str | None = None) -> StreamingQuery:
    """The live table named ``name``.

    Every micro-batch writes folders of its own (``base=<id>`` or ``changes=<id>``), replaced if the
    batch runs again, and then repoints the view; a folder counts once its _SUCCESS is there.  Folders that
    a reader may still hold stay until the next base but one, so the table is whole at any time.

    mode="complete" (the reference): every window stays in state and every batch writes a whole base;
    a late row still changes its window.
    mode="update": the watermark evicts closed windows from state, so state stays bounded however long the
    feed runs; a batch writes only the windows it changed, and every ``compact_every`` batches the latest
    version of each window becomes a new base.  Rows behind the watermark are dropped, as in the alert log.

    ``summaries`` (update mode, alert columns): a folder in which each batch also sums up, per team, the windows it changed
    (``team_windows``), so that team summaries over any windows read no players' rows.
    """
    if summaries and mode != "update":
        raise ValueError("summaries go with mode='update'")
    if mode not in LIVE_MODES:
        raise ValueError(f"mode must be one of {LIVE_MODES}")
    w = df.writeStream.outputMode(mode).queryName(name).option("checkpointLocation", checkpoint)
    if sink == "memory":
        return _trigger(w.format("memory"), trigger).start()
    if path is None:
        raise ValueError("sink='table' needs a path")

    def put(rows: DataFrame, kind: str, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/{kind}={batch_id}")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stamped = batch.withColumn(VERSION_COL, F.lit(batch_id).cast("long"))
        if mode == "complete":
            put(stamped, "base", batch_id)
        else:
            put(stamped, "changes", batch_id)
            if summaries:
                _sum_up(spark, path, summaries, batch, batch_id, keys, compact_every)
            if batch_id % compact_every == compact_every - 1:
                put(_latest(live_versions(spark, path), keys, VERSION_COL), "base", batch_id)
        live_table(spark, name, path, keys)
        bases = sorted(i for kind, i in _folders(spark, path) if kind == "base")
        for kind, i in _folders(spark, path) if len(bases) > 2 else []:
            if i < bases[-3] or (kind == "base" and i < bases[-2]):
                remove_path(spark, f"{path}/{kind}={i}")

    return _trigger(w.foreachBatch(write), trigger).start()


SUMMARY_KEYS = ("team_id", "window_start")


def _sum_up(spark: SparkSession, live: str, path: str, batch: DataFrame, batch_id: int, keys: Sequence[str], compact_every: int) -> None:
    """The summaries of the windows that a batch changed, from the live table's rows of these windows alone."""
    changed = batch.select(*SUMMARY_KEYS).distinct()
    now = _latest(live_versions(spark, live).join(changed, list(SUMMARY_KEYS), "left_semi"), keys)
    stamp = F.lit(batch_id).cast("long").alias(VERSION_COL)
    window_counts(now).select("*", stamp).write.mode("overwrite").parquet(f"{path}/changes={batch_id}")
    if batch_id % compact_every == compact_every - 1:
        team_windows(spark, path).select("*", stamp).write.mode("overwrite").parquet(f"{path}/base={batch_id}")


def team_windows(spark: SparkSession, path: str) -> DataFrame:
    """The newest summary of each (team, window) that ``start_live`` kept: rows of ``operators.team_windows``.

    A window's summary is whole in each batch that changed it, so the rows of its newest batch count.
    """
    rows = live_versions(spark, path)
    newest = rows.groupBy(*SUMMARY_KEYS).agg(F.max(VERSION_COL).alias(VERSION_COL))
    return rows.join(newest, [*SUMMARY_KEYS, VERSION_COL], "left_semi").drop(VERSION_COL)


def _folders(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """The finished batch folders of a live table."""
    return [(kind, int(i)) for name in finished_folders(spark, path) for kind, eq, i in [name.partition("=")] if eq]


def live_versions(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the newest base and of all changes after it, stamped with their batch."""
    found = _folders(spark, path)
    base = max((i for kind, i in found if kind == "base"), default=-1)
    parts = [f"{path}/{kind}={i}" for kind, i in found if i > base or (kind == "base" and i == base)]
    if not parts:
        raise FileNotFoundError(f"{path}: no batch of the live table is written yet")
    return spark.read.parquet(*parts)


def _latest(versions: DataFrame, keys: Sequence[str], *stamp: str) -> DataFrame:
    """The newest version of each window (grouped, partially aggregated; one version per batch at most)."""
    cols = [c for c in versions.columns if c != VERSION_COL]
    best = F.max_by(F.struct(*cols, *stamp), VERSION_COL).alias("_latest")
    return versions.groupBy(*keys).agg(best).select("_latest.*")


def drain(query: StreamingQuery, timeout_s: float = 3600.0) -> StreamingQuery:
    """Wait for an ``availableNow`` query to finish; stop it and raise if it does not, or if it failed."""
    if not query.awaitTermination(timeout_s):
        query.stop()
        raise TimeoutError(f"stream {query.name or query.id} did not drain within {timeout_s} s")
    if query.exception():
        raise RuntimeError(str(query.exception()))
    return query


def live_table(spark: SparkSession, name: str, path: str, keys: Sequence[str] = WINDOW_KEYS) -> DataFrame:
    """The live table's latest version as a batch DataFrame, also registered as temp view ``name``."""
    df = _latest(live_versions(spark, path), keys)
    df.createOrReplaceTempView(name)
    return df


COMMITS = "commits"
COMMIT = "batch long, rows long, bytes long, files long"


def _bytes(size: str) -> int:
    """A size setting in bytes: a number with b, k, m, g or t, or without."""
    unit = size.strip().lower().rstrip("b") or "0"
    power = "kmgt".find(unit[-1]) + 1
    return max(1, int(unit[:-1] if power else unit) << 10 * power)


def start_alert_log(alerts: DataFrame, path: str, checkpoint: str,
                    trigger: str | None = "available_now") -> StreamingQuery:
    """Fatigue alerts in Parquet once their window closes, a folder per micro-batch.

    The windowed state keeps one partition per shuffle partition, so the rows of a batch are counted and measured
    (kept meanwhile) and written in one file for each ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` of them: one
    file in a quiet batch, as many tasks as its volume needs in a catch-up of the whole backlog.  Then the
    batch is entered in the log's commits (batch, rows, bytes, files); ``alert_log`` reads entered batches
    alone.  A batch that runs again replaces its folder and its entry.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            size = batch.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.length(F.to_json(F.struct("*")))), F.lit(0)).alias("bytes")).first()
            advised = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
            files = max(1, -(-size["bytes"] // _bytes(advised)))
            few = files <= int(spark.conf.get("spark.sql.shuffle.partitions"))
            (batch.coalesce(files) if few else batch.repartition(files)).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        finally:
            batch.unpersist()
        entry = {"batch": batch_id, "rows": size["rows"], "bytes": size["bytes"], "files": files}
        replace_text(spark, f"{path}/{COMMITS}/{batch_id}.json", json.dumps(entry))

    w = alerts.filter(F.col("fatigue_alert")).writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    return _trigger(w.foreachBatch(write), trigger).start()


def alert_commits(spark: SparkSession, path: str) -> DataFrame:
    """(batch, rows, bytes, files) of the batches of an alert log."""
    entries = [f"{path}/{COMMITS}/{f}" for f in files_in(spark, f"{path}/{COMMITS}") if f.endswith(".json")]
    return spark.read.schema(COMMIT).json(entries) if entries else literal_rows(spark, [], COMMIT)


def alert_log(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The written alerts; no rows (of ``schema``) before the first batch is written."""
    parts = [f"{path}/batch={f.removesuffix('.json')}" for f in files_in(spark, f"{path}/{COMMITS}") if f.endswith(".json")]
    if not parts and schema is not None:
        return literal_rows(spark, [], schema)
    return spark.read.parquet(*parts)


def progress_frame(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """One row per recent micro-batch of ``query`` (Spark keeps the last
    ``spark.sql.streaming.numRecentProgressUpdates``)."""
    rows = [(str(p.get("id")), p.get("name"), int(p.get("batchId", -1)), int(p.get("numInputRows", 0)),
             float(p.get("inputRowsPerSecond") or 0.0), float(p.get("processedRowsPerSecond") or 0.0),
             (p.get("eventTime") or {}).get("watermark"))
            for p in query.recentProgress]
    schema = ("id string, name string, batch_id long, num_input_rows long, input_rows_per_second double, "
              "processed_rows_per_second double, watermark string")
    return literal_rows(spark, rows, schema)


PROGRESS = ("id string, run_id string, name string, batch_id long, at string, num_input_rows long, input_rows_per_second double, "
            "processed_rows_per_second double, watermark string, batch_ms long, observed string")


class ProgressTable(StreamingQueryListener):
    """Appends every micro-batch's progress of the session's queries to a table, as it is reported.

    Spark itself keeps the last ``spark.sql.streaming.numRecentProgressUpdates`` in the driver's memory.  ``every`` events go to one file;
    those that wait are written when a query ends and by ``flush``.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 1) -> None:
        super().__init__()
        self.session, self.path, self.every = spark, path, every
        self._held: list[tuple] = []
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        with self._lock:
            self._held.append((str(p.id), str(p.runId), p.name, p.batchId, p.timestamp, p.numInputRows,
                               float(p.inputRowsPerSecond), float(p.processedRowsPerSecond), (p.eventTime or {}).get("watermark"), p.batchDuration,
                               json.dumps({n: r.asDict() for n, r in p.observedMetrics.items()}) if p.observedMetrics else None))
            if len(self._held) >= self.every:
                self._write()

    def onQueryTerminated(self, event) -> None:
        self.flush()

    def flush(self) -> None:
        with self._lock:
            self._write()

    def _write(self) -> None:
        if self._held:
            literal_rows(self.session, self._held, PROGRESS).coalesce(1).write.mode("append").parquet(self.path)
            self._held = []


def start_progress(spark: SparkSession, path: str, every: int = 1) -> ProgressTable:
    """Start writing the progress of all queries of the session to the table ``path``; ends with ``stop_progress``."""
    listener = ProgressTable(spark, path, every)
    spark.streams.addListener(listener)
    return listener


def stop_progress(listener: ProgressTable) -> None:
    listener.session.streams.removeListener(listener)
    listener.flush()


def progress_history(spark: SparkSession, path: str) -> DataFrame:
    """The progress written so far, one row a micro-batch; a batch reported twice counts once."""
    return read_optional(spark, path, StructType.fromDDL(PROGRESS)).dropDuplicates(["run_id", "batch_id", "at"])


def gate_stream_values(spark: SparkSession, path: str, run_id: str, name: str = "impossible_values",
                       rules: Mapping[str, tuple[float, float]] | None = None) -> DataFrame:
    """G2 of a stream whose rows are observed (``quality.observe_values``), from the progress table: no pass over the rows."""
    counts = [json.loads(r["observed"]).get(name, {}) for r in
              progress_history(spark, path).where((F.col("run_id") == run_id) & F.col("observed").isNotNull()).select("observed").toLocalIterator()]
    return quality.gate_observed_values(spark, counts, rules)


def stop_all(spark: SparkSession) -> list[str]:
    """Stop every active query of the session; checkpoints stay for a restart."""
    names = []
    for q in spark.streams.active:
        names.append(q.name or str(q.id))
        q.stop()
    return names


#: Readouts of the live table (L1-L4, A20), by name.
READOUTS = {f.__name__: f for f in (_alerts.live_exertion_ranking, _alerts.heart_rate_alerts, _alerts.distance_alerts,
                                    _alerts.substitution_candidates, _alerts.team_alert_summary)}


def live_readout(spark: SparkSession, name: str, view: str = "player_exertion") -> DataFrame:
    """One of the readouts against the live table registered as ``view``."""
    return READOUTS[name](spark.table(view))


def start_alert_job(telemetry: DataFrame, thresholds: DataFrame, root: str, name: str = "player_exertion",
                    trigger: str | None = "available_now", live_sink: str = "table",
                    live_mode: str = "update") -> dict[str, StreamingQuery]:
    """The streaming stage: live exertion table (bounded state) and alert log (append) from one feed.

    ``thresholds`` is written once first (``static_thresholds``); outputs and
    checkpoints go under ``root`` (a shared folder): ``root/live``,
    ``root/alerts``, ``root/checkpoints/{live,alerts}``.  A restart with the
    same ``root`` resumes from the checkpoints.
    """
    thr = static_thresholds(thresholds)
    alerts = alert_stream(telemetry, thr)
    root = root.rstrip("/")
    live = start_live(alerts, name, f"{root}/checkpoints/live", f"{root}/live", sink=live_sink, trigger=trigger,
                      mode=live_mode)
    log = start_alert_log(alerts, f"{root}/alerts", f"{root}/checkpoints/alerts", trigger=trigger)
    return {"live": live, "alerts": log}
