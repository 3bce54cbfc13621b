"""New vendor files into staging, then raw, as they arrive.

Batch ingestion keeps a high-water mark per symbol. Here the file source keeps the mark
(which files were read) in its checkpoint, and each micro-batch goes through the same staging
merge, which inserts only minutes that are not known yet. A repeated batch changes nothing.
"""

import hashlib
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tickloom.plans.jobs import Store, merge_job
from tickloom.sources.vendor import vendor_bars

# Headers of the vendor files, in order.
VENDOR_FILE = T.StructType([
    T.StructField(name, T.StringType())
    for name in ("Symbol", "Datetime", "Open", "High", "Low", "Close", "Volume")
])


def vendor_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    return (
        spark.readStream.schema(VENDOR_FILE).option("header", True)
        .option("maxFilesPerTrigger", files_per_batch).csv(path)
    )


def merge_stream(
    store: Store, vendor_path: str, checkpoint: str, source_zone: str | None = "UTC", files_per_batch: int = 1000
) -> StreamingQuery:
    """Start a query that merges all files present and then stops (trigger availableNow).

    Batches are named after the checkpoint, so streams that share a store do not take each other's
    batches for repeated ones.
    """
    source = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]

    def merge_batch(batch: DataFrame, batch_no: int) -> None:
        loaded = datetime.now(timezone.utc).replace(tzinfo=None)
        name = f"STREAM_{source}_{batch_no}"
        if not batch.isEmpty() and store.staging().where(F.col("BatchID") == name).isEmpty():
            store.stage(vendor_bars(batch, source_zone), loaded, name)
        if not store.pending_staging().isEmpty():
            merge_job(store)

    return (
        vendor_stream(store.spark, vendor_path, files_per_batch).writeStream
        .foreachBatch(merge_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
