"""Raw facts as a stream: files of documents in, rows not yet stored appended to a versioned table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallystone.sources.filings import RAW_KEY, flatten
from tallystone.sources.store import VersionedTable, new_rows

FILE = "file_name string, payload string"


def stream_documents(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """JSON lines with file_name and payload, as they arrive."""
    return spark.readStream.schema(FILE).option("maxFilesPerTrigger", files_per_batch).json(folder)


def start(documents: DataFrame, raw: VersionedTable, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Each batch is flattened and anti-joined with what is stored, by key columns only; a batch that is run again after a
    failure finds its rows stored and appends none."""

    def write(batch: DataFrame, _: int) -> None:
        rows = flatten(batch)
        raw.append(new_rows(rows, raw.read(), RAW_KEY, null_safe=True) if raw.snapshots() else rows)

    w = documents.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w).start()


def latest_state(facts: DataFrame, grain: list[str], ts: str = "promoted_at", lateness: str = "1 day") -> DataFrame:
    """Count and greatest filing day of each grain and day of arrival on a stream of facts, with a watermark."""
    return facts.withWatermark(ts, lateness).groupBy(F.window(ts, "1 day"), *grain).agg(F.count(F.lit(1)).alias("n"), F.max("filed_date").alias("last_filed"))
