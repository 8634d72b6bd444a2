"""Run the pipeline for each daily file as it arrives."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from mastline.constants import FILE_SUFFIX
from mastline.functions.clock import date_in_path
from mastline.plans.engine import Engine
from mastline.sources.drops import dated_root


def follow(engine: Engine, checkpoint: str, run_prefix: str = "arrival", **trigger) -> StreamingQuery:
    """Process new source files until caught up (or on the ``trigger`` given).

    A source is a file, or a folder of part files, named for its date, as in the
    manifest.  The stream carries file names only; each micro-batch is one pipeline run
    over the dates it names.  A batch repeated after a failure replaces the
    same dates under the same run id, so it changes nothing twice.
    """
    files = (
        engine.spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*{FILE_SUFFIX}")
        .load(engine.source)
        .select(dated_root(F.col("path")).alias("root"))
        .where("root != ''")
        .select(date_in_path(F.col("root")).alias("execution_date"))
        .where(F.try_to_date("execution_date", "yyyy-MM-dd").isNotNull())
    )

    def run_batch(batch: DataFrame, number: int) -> None:
        # One row per newly arrived daily file.
        dates = [r.execution_date for r in batch.distinct().orderBy("execution_date").collect()]
        if dates:
            engine.run_dates(f"{run_prefix}-{number}", dates)

    return (
        files.writeStream.foreachBatch(run_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
