from pyspark.sql import functions as F

from support import SF_CHECK, closed_form, rows
from ledgerflow.operators import scd2
from ledgerflow.plans.publish import VersionedDimension


def test_publish_protocol_commit_point_and_replay(spark, tmp_dir):
    base = (spark.read.parquet(f"{SF_CHECK}/events.parquet").where("event_type = 'purchase'")
            .select("user_id", "event_id", "ts", "value"))
    lo, hi = (F.lit(x).cast("timestamp_ntz") for x in ("2024-01-10", "2024-01-20"))
    batches = [base.where(F.col("ts") < lo), base.where((F.col("ts") >= lo) & (F.col("ts") < hi)),
               base.where(F.col("ts") >= hi)]
    schema = scd2.build(base, "user_id", "ts", tie="event_id").schema
    dim = VersionedDimension(f"{tmp_dir}/dim", schema, "user_id", "ts", tie="event_id")
    seen = []
    for i, b in enumerate(batches):
        dim.apply_batch(spark, b, src=f"feed:{i}", stop_before_commit=True)   # crash after data
        seen.append(dim.read(spark).count())                                  # readers do not move
        assert dim.apply_batch(spark, b, src=f"feed:{i}")                     # retry to the end
        seen.append(dim.read(spark).count())
    assert dim.apply_batch(spark, batches[2], src="feed:2") is False           # replay is skipped
    assert dim.last_batch(spark) == 3
    assert seen[0] == 0 and seen[1] == seen[2] and seen[3] == seen[4] and seen[5] > seen[3] > seen[1]
    published = dim.read(spark)
    tagged = base.withColumn("bt", F.when(F.col("ts") < lo, 0).when(F.col("ts") < hi, 1).otherwise(2))
    assert rows(published) == rows(closed_form(tagged, "user_id", "ts", "bt", "event_id", whole_first=True).select(*schema.names))
    assert published.where("is_current").groupBy("user_id").count().where("count > 1").count() == 0
