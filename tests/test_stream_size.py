"""How a stream's batches are planned."""

from pyspark.sql import functions as F

from rosterflow.streaming.landing import land_and_wait


def test_a_stream_batch_is_planned_adaptively(spark, tmp_path):
    """Without, a key's rows are written by one task, however many they are."""
    spark.range(100).select(F.lit("a").alias("k"), "id").write.parquet(f"{tmp_path}/in")
    seen = []

    def prepare(batch):
        seen.append(batch.sparkSession.conf.get("spark.sql.adaptive.enabled"))
        return batch

    land_and_wait(
        spark, f"{tmp_path}/in", f"{tmp_path}/out", "k", prepare, schema="k string, id long", checkpoint=f"{tmp_path}/checkpoint"
    )
    assert len(seen) > 1 and set(seen) == {"true"}
