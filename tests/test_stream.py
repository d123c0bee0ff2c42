from pyspark.sql import functions as F

from cdc_helpers import SF_SMALL
from rowtide.operators.envelope import current_state
from rowtide.plans.batch_job import JobConfig, read_current
from rowtide.plans.common import USERS, flat_events
from rowtide.session import scratch_path
from rowtide.sources.fixtures import event_payload, load
from rowtide.streaming import stream as S


def test_stream_apply_equals_batch_current_state(spark):
    src = scratch_path(spark, "src")
    ev = load(spark, SF_SMALL, "events")
    ev.select(F.to_date("ts").alias("day"), F.to_json(F.struct(event_payload().alias("payload"))).alias("value")) \
        .write.partitionBy("day").text(src)
    cfg = JobConfig(root=scratch_path(spark, "job"))
    ckpt = scratch_path(spark, "ckpt")
    S.run_to_tables(spark, src, cfg, ckpt, max_files_per_trigger=10).awaitTermination()
    got = sorted(tuple(r) for r in read_current(spark, cfg, "warehouse", USERS).collect())
    want = sorted(tuple(r) for r in current_state(flat_events(spark, SF_SMALL), USERS).drop("updated_ts_ms").collect())
    assert got == want
    # a second run on the same checkpoint reads nothing new
    q = S.run_to_tables(spark, src, cfg, ckpt)
    q.awaitTermination()
    assert sum(p["numInputRows"] for p in q.recentProgress) == 0
    assert sorted(tuple(r) for r in read_current(spark, cfg, "warehouse", USERS).collect()) == want
