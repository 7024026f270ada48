"""Month slices and incremental processing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def month_slices(df: DataFrame, start: str, end: str) -> DataFrame:
    """Adds ``(first, last)``: closed month slices from ``start`` to ``end``, the first and last cut to the range."""
    a, b = F.col(start).cast("date"), F.col(end).cast("date")
    months = F.sequence(F.trunc(a, "MM"), F.trunc(b, "MM"), F.expr("interval 1 month"))
    out = df.withColumn("month", F.explode(F.when(a <= b, months)))
    return out.withColumn("first", F.greatest(F.col("month").cast("date"), a)).withColumn("last", F.least(F.last_day("month"), b)).drop("month")


def slice_of(c: Column) -> Column:
    return F.trunc(c.cast("date"), "MM")


def since(df: DataFrame, column: str, mark: str | None) -> DataFrame:
    """Rows after the mark (all, if there is none)."""
    return df if mark is None else df.where(F.col(column) > F.lit(mark).cast(df.schema[column].dataType))


def next_mark(df: DataFrame, column: str) -> str | None:
    v = df.agg(F.max(F.col(column).cast("string")).alias("m")).first().m
    return v


def _stream(spark: SparkSession, path: str) -> DataFrame:
    """A file stream over a folder or a single file (a pattern of one name stands for either)."""
    folder, _, name = path.rpartition("/")
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{folder}/[{name[0]}]{name[1:]}")


def monthly_events(spark: SparkSession, path: str, checkpoint: str, out: str, delay: str = "7 days") -> DataFrame:
    """Events of a file stream counted by month and type, in complete mode, until all that is there is read.

    Repeated event ids within the watermark's delay count once. The result table is rewritten for each batch.
    """
    events = _stream(spark, path).withColumn("at", F.col("ts").cast("timestamp"))
    once = events.withWatermark("at", delay).dropDuplicatesWithinWatermark(["event_id"])
    counts = once.groupBy(F.date_trunc("month", "at").cast("date").alias("month"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    query = (
        counts.writeStream.outputMode("complete").trigger(availableNow=True).option("checkpointLocation", checkpoint)
        .foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(out)).start()
    )
    query.awaitTermination()
    return spark.read.parquet(out)


def daily_windows(spark: SparkSession, path: str, checkpoint: str, out: str, delay: str = "1 day") -> DataFrame:
    """Events of a file stream in one-day windows, each written when the watermark has passed it: append mode, bounded state."""
    events = _stream(spark, path).withColumn("at", F.col("ts").cast("timestamp"))
    counts = events.withWatermark("at", delay).groupBy(F.window("at", "1 day").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    flat = counts.select(F.col("w.start").alias("start"), "event_type", "n")
    flat.writeStream.outputMode("append").trigger(availableNow=True).option("checkpointLocation", checkpoint).format("parquet").option("path", out).start().awaitTermination()
    return spark.read.schema(flat.schema).parquet(out)
