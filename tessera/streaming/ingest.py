"""A stream of JSON Lines files: validated, deduplicated against what was kept, appended."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera.operators.dedup import content_hash
from tessera.sources.jsonl import checked, parsed


def ingest(spark: SparkSession, source: str, accepted: str, rejected: str, checkpoint: str) -> StreamingQuery:
    """Runs over the files that are there. A batch that is repeated after a failure replaces its own output."""

    def batch(df: DataFrame, number: int) -> None:
        rows = checked(df.select(F.col("value").alias("line"))).persist()
        rows.where(~F.col("valid")).select("line").write.mode("overwrite").parquet(f"{rejected}/batch={number}")
        good = parsed(rows.where("valid")).select("line", content_hash("record.messages").alias("hash"))
        good = good.groupBy("hash").agg(F.min("line").alias("line"))
        try:
            known = spark.read.parquet(accepted).where(F.col("batch") < number).select("hash")
            good = good.join(known, "hash", "left_anti")
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
        good.write.mode("overwrite").parquet(f"{accepted}/batch={number}")
        rows.unpersist()

    lines = spark.readStream.format("text").load(source)
    return lines.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
