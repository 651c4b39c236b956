"""Journals as streams: latest outcomes, one call a request, running budgets. Batch and stream give equal results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyforge.operators.journals import latest


def stream(spark: SparkSession, path: str, schema, files: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def merged(records: DataFrame, state: str, checkpoint: str, key: str = "source_id", order: str = "ordinal") -> StreamingQuery:
    """Keep the latest record of each key: every batch is reduced, merged with the last version of the table at `state`, and
    written as the next version under the batch's number. A batch that is run again writes the same version again."""
    spark = records.sparkSession

    def each(batch: DataFrame, number: int) -> None:
        rows = latest(batch, key, order)
        if number > 0:
            rows = latest(rows.unionByName(spark.read.parquet(f"{state}/version={number - 1}")), key, order)
        rows.write.mode("overwrite").parquet(f"{state}/version={number}")

    return records.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def first_requests(requests: DataFrame, late: str = "1 hour", time: str = "ts") -> DataFrame:
    """Requests whose hash wasn't seen within the watermark: one call each."""
    return requests.withWatermark(time, late).dropDuplicatesWithinWatermark(["request_sha256"])


def translated(rows: DataFrame, model: Callable[[list[str]], list[str]], chunk: int, out: str, checkpoint: str) -> StreamingQuery:
    """Translate a stream of (source_id, query) in chunks; each batch's outputs are durable before the next one starts."""

    def run(parts):
        for part in parts:
            for low in range(0, len(part), chunk):
                some = part.iloc[low : low + chunk].copy()
                some["output"] = model(some["query"].tolist())
                yield some[["source_id", "query", "output"]]

    done = rows.select("source_id", "query").mapInPandas(run, "source_id string, query string, output string")
    return done.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """start, event_type, n, value: an extension for event tables, with late events dropped past the watermark."""
    out = events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("value"))
    return out.select(F.col("window.start").alias("start"), "event_type", "n", "value")
