"""File-arrival streams. Both jobs process what is there and stop (``availableNow``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tradewharf.functions import month_start
from tradewharf.operators.incremental import upsert_path
from tradewharf.operators.relational import dedup_latest
from tradewharf.schemas import Landed
from tradewharf.sources.files import flatten_variant, land_variant


def stream_land(
    spark: SparkSession,
    in_dir: str,
    schema: StructType,
    out_dir: str,
    checkpoint: str,
    loaded_at: Column | None = None,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Land every newly arrived Parquet file once as VARIANT rows with lineage.

    The checkpoint remembers the files, so a restart neither skips nor repeats one; an
    unreadable file stops the stream instead of being passed over.
    """
    arriving = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("ignoreCorruptFiles", "false")
        .parquet(in_dir)
    )
    landed = land_variant(arriving, loaded_at if loaded_at is not None else F.current_timestamp())
    return (
        landed.writeStream.format("parquet")
        .outputMode("append")
        .option("path", out_dir)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_upsert(
    spark: SparkSession,
    bronze_dir: str,
    spec: Landed,
    date_col: str,
    out_dir: str,
    checkpoint: str,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Landing to typed, deduplicated table: one keyed upsert per micro-batch.

    A replayed micro-batch gives the same table, because the newest ``_loaded_at`` per key
    wins however often a row is offered. The file name stays in the table: it settles equal
    load times across micro-batches as it does within one.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        typed = flatten_variant(batch, spec.payload)
        latest = dedup_latest(typed, spec.keys, ["_loaded_at"], ["_file_name"])
        monthly = latest.withColumn("month", month_start(F.col(date_col)))
        upsert_path(batch.sparkSession, out_dir, monthly, spec.keys, "month", newest_by="_loaded_at", ties=["_file_name"])

    bronze = spark.read.parquet(bronze_dir).schema
    return (
        spark.readStream.schema(bronze)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(bronze_dir)
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
