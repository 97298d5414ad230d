"""Raw-file route: gzip CSV / JSON lines with declared schemas, landing, batch job on raw files."""

import pytest
from pyspark.sql import functions as F

from courtload.functions.exprs import round_doubles
from courtload.plans import batch
from courtload.plans.graph import Graph
from courtload.session import scratch_path
from courtload.sources.adapters import RAW_FORMATS, load_domain, load_raw_domain
from courtload.sources.files import publish_version, published_versions, read_published
from tests.conftest import SF_SMALL


def _write_raw(spark, domain):
    root = scratch_path(spark, "raw")
    paths = {}
    for name, df in domain.as_dict().items():
        path = f"{root}/{name}.{RAW_FORMATS[name]}.gz"
        w = df.write.option("compression", "gzip")
        (w.option("header", "true").csv(path) if RAW_FORMATS[name] == "csv" else w.json(path))
        paths[name] = path
    return paths


def _bag(df):
    df = round_doubles(df, 6)                  # summation order differs between file layouts
    return sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=repr)


def test_raw_files_give_the_same_workload(spark):
    parquet = load_domain(spark, SF_SMALL)
    paths = _write_raw(spark, parquet)
    for land in (None, scratch_path(spark, "landed")):
        raw = load_raw_domain(spark, paths, land_to=land)
        assert _bag(Graph(raw).pgw) == _bag(Graph(parquet).pgw)
        assert raw.training.filter(F.col("date") == "not-a-date").count() > 0


def test_batch_job_on_raw_files(spark):
    paths = _write_raw(spark, load_domain(spark, SF_SMALL))
    out = batch.run_batch(spark, domain=load_raw_domain(spark, paths))
    gates = read_published(spark, out["injury_risk_features"].rsplit("/", 2)[0] + "/quality_gates.parquet")
    checks = {r["check"] for r in gates.collect()}
    assert {"inputs_present", "impossible_values", "tracking_completeness", "outputs_present"} <= checks
    assert spark.read.parquet(out["rolling_workload"]).count() == Graph.of(spark, SF_SMALL).pgw.count()


def _parquet_files(path):
    import os
    return [f for r, _, fs in os.walk(path.removeprefix("file:")) for f in fs if f.endswith(".parquet")]


def test_partitioned_publish_bounds_files_and_spreads_a_hot_key(spark):
    from courtload.sources.files import publish
    # key 0 holds a third of the rows, 24 other keys share the rest
    df = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 24 + 1).cast("int").alias("team_id"),
        F.col("id").alias("player_id"), (F.col("id") * 0.5).alias("v")).repartition(6)
    path = scratch_path(spark, "pub")
    # at this size AQE would rightly merge every range into one task; turn that off to see the
    # layout large inputs get, where each range holds about the advisory partition size
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        publish(df, path, partition_by=["team_id"], cluster_by=["player_id"])
    finally:
        spark.conf.set(key, "true")
    back = spark.read.parquet(path)
    assert sorted(tuple(r) for r in back.select("team_id", "player_id", "v").collect()) == \
        sorted(tuple(r) for r in df.collect())
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # each write task covers one contiguous key range: at most tasks + keys files, not tasks x keys
    assert len(_parquet_files(path)) <= tasks + 25
    # the hot key is split over several files (several tasks), not written by one
    assert len(_parquet_files(f"{path}/team_id=0")) >= 2


def test_literal_rows_keep_types_and_allow_empty(spark):
    from courtload.functions.exprs import literal_rows
    ddl = "check string, subject string, failures long, passed boolean"
    df = literal_rows(spark, [("a", "x", 3, True), ("b", None, None, False)], ddl)
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["string", "string", "bigint", "boolean"]
    assert sorted(tuple(r) for r in df.collect()) == [("a", "x", 3, True), ("b", None, None, False)]
    empty = literal_rows(spark, [], ddl)
    assert empty.columns == ["check", "subject", "failures", "passed"] and empty.count() == 0


def test_failed_input_gate_publishes_nothing(spark):
    import os

    import pytest
    from dataclasses import replace
    d = load_domain(spark, SF_SMALL)
    empty = replace(d, training=d.training.filter(F.lit(False)))
    root = scratch_path(spark, "gated")
    with pytest.raises(batch.GateFailed, match="inputs_present:training_sessions"):
        batch.run_batch(spark, domain=empty, root=root)
    assert not os.path.exists(root.removeprefix("file:"))


def test_batch_gates_from_summaries_equal_gates_on_raw_rows(spark):
    from courtload.operators import quality
    d = load_domain(spark, SF_SMALL)
    out = batch.run_batch(spark, SF_SMALL)
    report = read_published(spark, out["injury_risk_features"].rsplit("/", 2)[0] + "/quality_gates.parquet")
    got = sorted(tuple(r) for r in report.filter("check != 'outputs_present'").collect())
    raw = [quality.gate_inputs(d.as_dict()), quality.gate_impossible_values(d.tracking),
           quality.gate_completeness(d.stats, d.tracking)]
    want = sorted(tuple(r) for g in raw for r in g.select("check", "subject", "failures", "passed").collect())
    assert got == want and any(r[2] > 0 for r in want if r[0] == "impossible_values")
    # J3's bridge came from the written tracking summary: same rows as from the raw tracking rows
    written = spark.read.parquet(out["training_with_schedule"])
    assert _bag(written) == _bag(Graph(d).training_sched.select(written.columns))


def test_batch_removes_its_intermediates_and_keeps_outputs(spark):
    import os

    from courtload.session import checkpoint_root
    base = f"{checkpoint_root(spark)}/courtload".removeprefix("file:")

    def scratch():
        return {n for n in os.listdir(base)} if os.path.isdir(base) else set()

    before = scratch()
    out = batch.run_batch(spark, SF_SMALL)
    new = scratch() - before
    # only the published lake is left; summaries and sort positions went with the run folder
    assert len(new) == 1 and next(iter(new)).startswith("lake-")
    assert spark.read.parquet(out["workload_tiers"]).count() == 4
    assert spark.read.parquet(out["rolling_workload"]).count() == Graph.of(spark, SF_SMALL).pgw.count()


def test_a_write_that_dies_leaves_the_old_version_current(spark, monkeypatch):
    from courtload.sources import files
    path = scratch_path(spark, "versions")
    with pytest.raises(FileNotFoundError):
        read_published(spark, path)
    publish_version(spark.range(10), path)
    held = read_published(spark, path)

    boom = F.when(F.col("id") == 7, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id")
    with pytest.raises(Exception, match="lost"):
        publish_version(spark.range(20).select(boom.cast("long").alias("id")), path)      # dies within the write
    assert read_published(spark, path).count() == 10

    def killed(*args):
        raise KeyboardInterrupt
    with monkeypatch.context() as m:
        m.setattr(files, "replace_text", killed)                                           # dies between write and swap
        with pytest.raises(KeyboardInterrupt):
            publish_version(spark.range(30), path)
    assert read_published(spark, path).count() == held.count() == 10

    publish_version(spark.range(40).withColumn("k", F.col("id") % 3), path, partition_by=["k"], cluster_by=["id"])
    assert read_published(spark, path).count() == 40 and held.count() == 10                # a reader keeps what it holds
    publish_version(spark.range(50), path)
    assert read_published(spark, path).count() == 50 and len(published_versions(spark, path)) == 2
    assert len([f for f in files.subfolders(spark, path) if f.startswith(files.VERSION)]) == 2   # dead and old versions are gone
