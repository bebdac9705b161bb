"""Lot profit and loss kept current over arriving ledger files: the batch job's own
logic on a stream.

The state is one row of five running sums per lot, held in Spark's state store
under the checkpoint location the caller names, so a restarted query resumes
where it stopped.  Every trigger writes its result to a folder of its own
(``epoch=<n>``, rewritten whole if the trigger is repeated); readers take the
newest complete one, so no reader sees a half-written mart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from strata.plans.ledger import LedgerCols, lot_pnl


def run_lot_pnl(spark: SparkSession, source_dir: str, schema: StructType, out_path: str, checkpoint_location: str,
                name: str = "lot_pnl", cols: LedgerCols = LedgerCols(), max_files_per_trigger: int | None = None,
                available_now: bool = True):
    """Run ``lot_pnl`` over parquet files as they land in ``source_dir``; returns the query."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))

    def publish(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path}/epoch={epoch_id}")

    w = (lot_pnl(reader.parquet(source_dir), cols).writeStream.outputMode("complete")
         .option("checkpointLocation", checkpoint_location).foreachBatch(publish))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.queryName(name).start()


def current_lot_pnl(spark: SparkSession, out_path: str) -> DataFrame:
    """The newest published result."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(out_path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    done = [s.getPath() for s in fs.listStatus(folder)
            if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))]
    newest = max(done, key=lambda p: int(p.getName().split("=")[1]))
    return spark.read.parquet(newest.toString())
