"""Incremental staging loads with Structured Streaming.

The batch load (``plans.warehouse.run_elt``) re-reads the whole extract every
run. When extracts arrive as new files in a landing folder, the same
change-aware upsert can run per micro-batch instead: ``foreachBatch`` merges
each batch into the staging version of the latest earlier batch and writes a new
folder. A repeated batch starts from the same earlier version and writes another
folder, so it never reads what it replaces; the pointer of a batch names the last
folder written for it.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from ..operators.merge import upsert_changed
from ..operators.quality import QualityError, check_unique
from ..schemas import SOURCE_TABLES, STAGING_AUDIT
from ..plans.warehouse import staging_schema_ddl

POINTER_DDL = "batch_id bigint, path string"


def _pointer_root(warehouse_root: str, table: str) -> str:
    return f"{warehouse_root}/_stream_pointers/{table}"


def latest_staging(spark: SparkSession, warehouse_root: str, table: str,
                   before: int | None = None) -> DataFrame:
    """Staging version of the latest batch (before batch ``before``), or an empty
    table when no batch has a pointer. A pointer that cannot be read raises."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(_pointer_root(warehouse_root, table))
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    numbers = [int(f.getPath().getName().split("=")[1]) for f in fs.listStatus(folder)] if fs.exists(folder) else []
    numbers = [n for n in numbers if before is None or n < before]
    if not numbers:
        return spark.createDataFrame([], staging_schema_ddl(table))
    pointer = spark.read.schema(POINTER_DDL).option("mode", "FAILFAST").json(
        f"{_pointer_root(warehouse_root, table)}/batch={max(numbers):012d}").first()
    return spark.read.parquet(pointer["path"])


def merge_batch(batch: DataFrame, batch_id: int, table: str, warehouse_root: str,
                run_ts=None) -> str:
    """Upsert one micro-batch into a new staging version; returns its path."""
    spark = batch.sparkSession
    spec = SOURCE_TABLES[table]
    incoming = batch.select(*spec.columns)
    if not check_unique(incoming, spec.key).isEmpty():
        raise QualityError(f"batch {batch_id} of {table} repeats a key")
    ts = run_ts or datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    current = latest_staging(spark, warehouse_root, table, batch_id).select(*spec.columns, *STAGING_AUDIT)
    merged = upsert_changed(current, incoming, spec.key, spec.compare, ts)
    path = f"{warehouse_root}/stg/{table}/batch-{batch_id:012d}-{uuid.uuid4().hex[:12]}"
    merged.write.parquet(path)
    spark.createDataFrame([(batch_id, path)], POINTER_DDL).coalesce(1).write.mode("overwrite") \
        .json(f"{_pointer_root(warehouse_root, table)}/batch={batch_id:012d}")
    return path


def start_staging_stream(spark: SparkSession, landing_root: str, warehouse_root: str,
                         table: str, checkpoint_location: str, available_now: bool = True,
                         run_ts=None):
    """Stream new landing files of ``table`` into staging.

    ``available_now`` processes whatever has arrived and stops (a scheduled
    run); otherwise the query keeps running and merges each new batch.
    """
    spec = SOURCE_TABLES[table]
    stream = spark.readStream.schema(spec.schema).parquet(f"{landing_root}/{table}")
    writer = (stream.writeStream
              .foreachBatch(lambda df, bid: merge_batch(df, bid, table, warehouse_root, run_ts))
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()
