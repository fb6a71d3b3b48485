"""Gates observed while a table is written, resumable publication, the audited stream, emptied runs."""

import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from meterproof.operators.expectations import ExpectationFailed, observed_write
from meterproof.operators.landing import landing_audit, landing_integrity
from meterproof.schemas import TABLES
from meterproof.session import shared_dir
from meterproof.sources.publish import part_states, publish_once, publish_parts, write_manifest, write_parts
from meterproof.sources.tables import _checked, append_new, ensure_table, sync_runs
from meterproof.streaming.landing import audited_landing_stream

SESSION = TABLES["input_session"]


@pytest.fixture
def root(spark):
    return f"{shared_dir(spark)}/writes-{uuid.uuid4().hex}"


def sessions(spark, *rows):
    return spark.createDataFrame(list(rows), SESSION)


def test_a_staged_write_scans_its_source_once(spark):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        calls.add(1)
        return text

    source = sessions(spark, *[("r", f"s{i}", "t") for i in range(50)]).withColumn("tariff_id", counted(F.col("tariff_id")).alias("tariff_id"))
    assert _checked(source, "input_session", ["r"]).count() == 50
    assert calls.value == 50


@pytest.mark.parametrize(
    "bad,why",
    [([("r", "s1", "t"), ("r", "s1", "u")], "repeated keys"), ([("q", "s9", "t")], "outside"), ([("r", "s9", None)], "required value")],
)
def test_a_failing_gate_leaves_the_table_alone(spark, root, bad, why):
    append_new(spark, root, "input_session", sessions(spark, ("r", "s0", "t")))
    loose = "run_id STRING, session_id STRING, tariff_id STRING"
    with pytest.raises(ExpectationFailed, match=why):
        sync_runs(spark, root, "input_session", spark.createDataFrame(bad, loose), ["r"])
    assert [tuple(x) for x in ensure_table(spark, root, "input_session").select("run_id", "session_id").collect()] == [("r", "s0")]


def test_observed_conditions(spark, root):
    df = spark.range(10).withColumn("extra", F.col("id") * 2)
    gates = {"few": F.count(F.lit(1)) < 5, "even": F.count_if(F.col("extra") % 2 == 1) == 0, "unknown": F.max(F.lit(None).cast("int")) > 0}
    found = observed_write(df, f"{root}/a", gates, drop=("extra",), strict=False)
    assert {r.name: r.ok for r in found.collect()} == {"few": False, "even": True, "unknown": False}
    assert spark.read.parquet(f"{root}/a").columns == ["id"]
    with pytest.raises(ExpectationFailed, match="few, unknown"):
        observed_write(df, f"{root}/b", gates)
    empty = observed_write(spark.createDataFrame([], "id LONG"), f"{root}/c", {"none": F.count(F.lit(1)) == 0})
    assert [r.ok for r in empty.collect()] == [True]


@pytest.mark.parametrize("run_id", ["plain", "a:b", "a%b", "a=b", "a/b", "ä b"])
def test_an_emptied_run_goes_whatever_its_name(spark, root, run_id):
    sync_runs(spark, root, "input_session", sessions(spark, (run_id, "s", "t"), ("other", "s", "t")), [run_id, "other"])
    sync_runs(spark, root, "input_session", sessions(spark), [run_id])
    assert [r.run_id for r in ensure_table(spark, root, "input_session").collect()] == ["other"]


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "line STRING")


def test_publication_resumes_after_one_part(spark, root):
    batch = lines(spark, *[f"line {i % 60}" for i in range(100)])
    write_manifest(batch, root, 8)
    write_parts(batch, root, [2], 8)
    states = {r.part: r.state for r in part_states(batch, root, 8).collect()}
    assert states.pop(2) == "complete" and set(states.values()) == {"missing"}
    for _ in range(2):
        assert sorted(r.value for r in publish_parts(batch, root, 8).collect()) == sorted(r.line for r in batch.collect())
    # A part that lost lines is completed, one with a strange line is refused.
    part = spark.read.text(f"{root}/lines/part=2").limit(1).collect()
    spark.createDataFrame(part, "value STRING").write.mode("overwrite").text(f"{root}/lines/part=2")
    assert {r.part: r.state for r in part_states(batch, root, 8).collect()}[2] == "partial"
    assert publish_parts(batch, root, 8).count() == 100
    lines(spark, "strange").write.mode("append").text(f"{root}/lines/part=3")
    with pytest.raises(ExpectationFailed, match=r"foreign lines in parts \[3\]"):
        publish_parts(batch, root, 8)


def test_another_batch_or_part_is_refused(spark, root):
    batch = lines(spark, "a", "b", "c")
    publish_parts(batch, root, 4)
    with pytest.raises(ExpectationFailed, match="different batch"):
        publish_parts(lines(spark, "a", "b", "d"), root, 4)
    lines(spark, "x").write.text(f"{root}/lines/part=77")
    with pytest.raises(ExpectationFailed, match=r"\[77\]"):
        publish_parts(batch, root, 4)
    lines(spark, "x").write.text(f"{root}-loose/lines/part=1")
    with pytest.raises(ExpectationFailed, match="without a manifest"):
        publish_parts(batch, f"{root}-loose", 4)


def test_the_stream_keeps_its_audit(spark, root):
    def land():
        at = F.lit(datetime(2026, 1, 1))
        audited_landing_stream(spark, f"{root}/in", f"{root}/state", f"{root}/out", f"{root}/audit", max_files=1, ingested_at=at)
        return [spark.read.parquet(f"{root}/{name}") for name in ("out", "audit/files", "audit/batches")]

    lines(spark, "a", "a", "b").coalesce(1).write.text(f"{root}/one")
    lines(spark, "{", "c").coalesce(1).write.text(f"{root}/two")
    copy = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()

    def deliver(name):
        path = copy.Path(f"{root}/{name}")
        fs = path.getFileSystem(conf)
        fs.mkdirs(copy.Path(f"{root}/in"))
        part = next(s.getPath() for s in fs.listStatus(path) if s.getPath().getName().startswith("part-"))
        copy.FileUtil.copy(fs, part, fs, copy.Path(f"{root}/in/{name}.jsonl"), False, conf)

    deliver("one")
    assert [df.count() for df in land()] == [3, 1, 1]
    deliver("two")
    for _ in range(2):
        out, files, batches = land()
        assert (out.count(), files.count(), batches.count()) == (5, 2, 2)
    whole = landing_audit(out)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, files.select(*whole.columns).collect()))
    sums = batches.agg(F.sum("invalid_record_hashes"), F.sum("missing_source_metadata"), F.sum("landed_rows")).first()
    assert tuple(sums) == (*landing_integrity(out).first(), 5) == (0, 0, 5)


def test_published_lines_are_compressed_and_never_shuffled_to_find_strange_ones(spark, root):
    batch = lines(spark, *[f"line {i}" for i in range(50)])
    publish_parts(batch, f"{root}/parts", 4)
    publish_once(batch, f"{root}/once")
    for folder in ("parts/lines", "once"):
        assert spark.read.text(f"{root}/{folder}").inputFiles() and all(f.endswith(".gz") for f in spark.read.text(f"{root}/{folder}").inputFiles())
    # Under a threshold that no table meets: lines must not be dealt out by part to meet the parts that differ.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = part_states(batch, f"{root}/parts", 4)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin [part" in plan and "LeftSemi" in plan.split("BroadcastHashJoin [part")[1][:80]
