"""Run the layers whenever new monthly files have arrived.

The stream only notices new paths; what to load is decided by the ledger, so a file seen twice is loaded once. A file
rewritten under its old name starts no run by itself: the next run that covers its month, scheduled or started by another file,
finds it changed and reloads it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from farestrata.config import TRIP_FILE_PREFIX, TRIPS_FOLDER
from farestrata.functions import period_of_file
from farestrata.plans import pipeline
from farestrata.plans.pipeline import Lake

BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def follow(
    lake: Lake, source: str, checkpoint: str, job: Callable[[Lake, str, str, str], object] | None = None
) -> StreamingQuery:
    """Process everything that has arrived since the last call, then stop.

    ``job`` gets the lake, the folder and the first and last month that arrived; it is ``pipeline.run`` if none is given. A batch that is
    repeated after a failure finds in the ledger what it had loaded.
    """
    files = (
        lake.spark.readStream.format("binaryFile")
        .schema(BINARY_FILE)
        .option("pathGlobFilter", f"{TRIP_FILE_PREFIX}*.parquet")
        .load(f"{source}/{TRIPS_FOLDER}")
        .select(F.date_format(period_of_file("path"), "yyyy-MM").alias("period"))
    )

    def load(arrived: DataFrame, _batch: int) -> None:
        first, last = arrived.agg(F.min("period"), F.max("period")).first()
        if first is not None:
            (job or pipeline.run)(lake, source, first, last)

    return (
        files.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
