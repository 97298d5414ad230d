"""Session construction and the shared scratch folder.

Intermediate tables and streaming checkpoints go under the folder the
cluster names in ``spark.checkpoint.dir``.  Only when that is unset (tests,
a laptop) do we make one.
"""

from __future__ import annotations

import contextvars
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_STORE_DEFAULTS = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(master: str = "local[*]", app: str = "courtload",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    # Streaming state (the complete-mode live table keeps every window) goes to RocksDB,
    # off the JVM heap, with changelog checkpoints instead of full snapshots per batch --
    # only where the cluster's configuration names no state store of its own.
    named = spark.sparkContext.getConf()
    for k, v in STATE_STORE_DEFAULTS.items():
        if not named.contains(k):
            spark.conf.set(k, v)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; set one only where the session has none."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share "
                               "(intermediate tables and stream checkpoints go there)")
        conf = tempfile.mkdtemp(prefix="courtload-ckpt-")   # local mode only (tests, a laptop)
    sc.setCheckpointDir(conf)
    return (sc.getCheckpointDir() or conf).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint root for one run."""
    return f"{checkpoint_root(spark)}/courtload/{name}-{uuid.uuid4().hex[:12]}"


_RUN_FOLDER: contextvars.ContextVar[str | None] = contextvars.ContextVar("courtload_run_folder", default=None)


def materialize(df, name: str, compression: str | None = None):
    """Write ``df`` once as Parquet under the shared checkpoint folder and read it back.

    Used where a plan reads the same non-deterministic intermediate twice
    (positions from a sampled range partitioning): both readers then see one
    evaluation, also after executor loss.  Inside ``run_intermediates`` the
    copy goes to that run's folder.  ``compression``: a Parquet codec; by default the session's.
    """
    run = _RUN_FOLDER.get()
    path = f"{run}/{name}-{uuid.uuid4().hex[:12]}" if run else scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)   # the schema just written: no footer job


@contextmanager
def run_intermediates(spark: SparkSession, name: str = "run") -> Iterator[str]:
    """Collect the intermediates ``materialize`` writes inside the block in one folder
    under the shared checkpoint root, and remove that folder when the block ends.

    The block must finish every action that reads them.  Threads started inside
    need the caller's context (``contextvars.copy_context().run``).
    """
    folder = scratch_path(spark, name)
    token = _RUN_FOLDER.set(folder)
    try:
        yield folder
    finally:
        _RUN_FOLDER.reset(token)
        remove_path(spark, folder)


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is a folder on the cluster's file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(store.exists(p) and store.getFileStatus(p).isDirectory())


def finished_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the subfolders of ``path`` that a Spark write has finished; none if there is no such path."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.exists(p):
        return []
    found = [s.getPath() for s in store.listStatus(p) if s.isDirectory()]
    return sorted(f.getName() for f in found if store.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f, "_SUCCESS")))


def _store(spark: SparkSession, path: str):
    """(file system, path) of the cluster's file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the subfolders of ``path``; none if there is no such path."""
    store, p = _store(spark, path)
    return sorted(s.getPath().getName() for s in store.listStatus(p) if s.isDirectory()) if store.exists(p) else []


def files_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly in ``path``; none if there is no such path."""
    store, p = _store(spark, path)
    return sorted(s.getPath().getName() for s in store.listStatus(p) if s.isFile()) if store.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file; None if there is none."""
    store, p = _store(spark, path)
    if not store.exists(p):
        return None
    stream = store.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file in one step: readers find the old content or the new one, whole."""
    jvm = spark.sparkContext._jvm
    store, p = _store(spark, path)
    staged = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex[:12]}")
    stream = store.create(staged, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    over = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
    over[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(store.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    files.rename(store.makeQualified(staged), store.makeQualified(p), over)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder on the cluster's file system (any Hadoop-supported scheme)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
