"""Edit logs as streams: micro-batches of reviewers' edits become upserts and scoped rewrites, idempotently.

The log is at-least-once: an edit may come twice and late. Within a batch the last edit of a key stands; between batches
the row with the later stamp does, so replaying a batch changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cadastra.operators.edits import last_write


def edit_stream(spark: SparkSession, path: str, schema: str, late: str = "1 day") -> DataFrame:
    """Edits of a folder of JSON files; repeats of an edit_id within the watermark are dropped."""
    rows = spark.readStream.schema(schema).json(path)
    return rows.withWatermark("updated_at", late).dropDuplicatesWithinWatermark(["edit_id"])


def merge_batch(state: DataFrame, batch: DataFrame, key: str, stamp: str = "updated_at") -> DataFrame:
    """The state with a batch's edits: of each key the row of the later stamp; equal stamps keep the state's row."""
    newest = last_write(batch, key, [stamp])
    both = state.withColumn("__new", F.lit(0)).unionByName(newest.withColumn("__new", F.lit(1)), allowMissingColumns=True)
    pick = F.max_by(F.struct(*both.columns), F.struct(F.col(stamp), -F.col("__new")))
    return both.groupBy(key).agg(pick.alias("r")).select(*[f"r.{c}" for c in state.columns])


def _folder(spark: SparkSession, path: str):
    sc = spark.sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(sc._jsc.hadoopConfiguration())


def whole_versions(spark: SparkSession, state_path: str) -> list[int]:
    """Numbers of the state's versions that were written to their end, in order."""
    at, fs = _folder(spark, state_path)
    if not fs.exists(at):
        return []
    names = [x.getPath() for x in fs.listStatus(at)]
    done = [x for x in names if x.getName().startswith("v=") and fs.exists(_folder(spark, f"{x}/_SUCCESS")[0])]
    return sorted(int(x.getName()[2:]) for x in done)


def current_state(spark: SparkSession, state_path: str) -> DataFrame:
    """The table of edits as of the last batch that was written to its end."""
    return spark.read.parquet(f"{state_path}/v={whole_versions(spark, state_path)[-1]}")


def run_upserts(edits: DataFrame, state_path: str, checkpoint: str, key: str) -> StreamingQuery:
    """Keep a versioned table of edits up to date: each batch writes version n + 1 whole, and readers take the last one that
    was written to its end (``current_state``).

    A batch that fails leaves its version unread; its rerun reads the version before and writes the same one again. Versions
    before that are deleted. The table holds reviewers' edits, one row a key: it is small next to what they edit.
    """

    def apply(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = [v for v in whole_versions(spark, state_path) if v < number]
        state = spark.read.schema(batch.schema).parquet(f"{state_path}/v={before[-1]}") if before else batch.limit(0)
        merge_batch(state, batch, key).write.mode("overwrite").parquet(f"{state_path}/v={number}")
        for old in before[:-1]:
            at, fs = _folder(spark, f"{state_path}/v={old}")
            fs.delete(at, True)

    return edits.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def event_windows(events: DataFrame, size: str = "1 day", late: str = "2 hours") -> DataFrame:
    """Extension: tumbling counts by type with a watermark; a batch DataFrame gives the same rows without state."""
    stamped = events.withColumn("ts", F.col("ts").cast("timestamp"))
    return stamped.withWatermark("ts", late).groupBy(F.window("ts", size).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"))
