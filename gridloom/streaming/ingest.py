"""Incremental ingest of landed files with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from gridloom import schemas
from gridloom.operators import cleaning, combine, quality, rulestate, windows
from gridloom.operators.ordered import cname
from gridloom.session import checkpointed
from gridloom.sources import snapshots


def landed_stream(
    spark: SparkSession, path: str, schema: T.StructType, kind: str = "parquet", files_per_batch: int = 1000
) -> DataFrame:
    """Files that land in a folder, as a stream with a fixed schema."""
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .format(kind)
        .load(path)
    )


def partition_months(df: DataFrame, order: str = "datetime") -> DataFrame:
    """Add the storage partition of a row."""
    return df.withColumn("month", F.date_format(cname(order), "yyyy-MM"))


def overwrite_months(df: DataFrame, table: str) -> None:
    """Replace exactly the months that ``df`` holds."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("month")
        .parquet(table)
    )


def touched_months(batch: DataFrame) -> list[str | None]:
    """The storage partitions of a batch: one row, with one entry per calendar month it reaches."""
    found = batch.agg(F.collect_set("month").alias("months"), F.max(F.col("month").isNull()).alias("none")).first()
    return sorted(found.months) + ([None] if found.none else [])


def in_months(stored: DataFrame, months: Sequence[str | None]) -> DataFrame:
    """The rows of the named months: literals, so only their folders are listed and read."""
    named = F.col("month").isin([m for m in months if m is not None])
    return stored.filter(named | F.col("month").isNull() if None in months else named)


def merged_months(
    new: DataFrame, table: str, keys: Sequence[str], sequence: Sequence[str] = ()
) -> DataFrame:
    """A batch (with its ``month``) merged with the stored rows of the same months; see ``merge_batch``."""
    spark = new.sparkSession
    if not snapshots.exists(spark, table):
        rest = [cname(c) for c in sequence or new.columns if c not in keys]
        return combine.keep_first(new, keys, F.struct(*rest))
    stored = in_months(spark.read.parquet(table), touched_months(new)).select(*map(cname, new.columns))
    if sequence:
        return combine.keep_first(stored.unionByName(new), keys, F.struct(*map(cname, sequence)))
    return combine.merge_history(stored, new, keys)


def merge_batch(
    batch: DataFrame, table: str, keys: Sequence[str], order: str = "datetime",
    sequence: Sequence[str] = (),
) -> None:
    """Merge a batch into a month-partitioned table, reading and rewriting only the months it touches.

    The stored rows win over new ones with the same key. With ``sequence`` the row with the smallest
    values of these columns wins instead, however the rows were split over batches and in whatever order
    the batches came. The rewrite is idempotent: the same batch merged again changes nothing,
    so a batch replayed after a failure is harmless.
    """
    if batch.isEmpty():
        return
    # The result replaces folders it was read from, so it is cut off from them first.
    staged = checkpointed(merged_months(partition_months(batch, order), table, keys, sequence))
    overwrite_months(staged, table)


def rows_around(
    stored: DataFrame, batch: DataFrame, keys: Sequence[str], order: str, reach: int
) -> DataFrame:
    """Stored rows of each group inside the batch's time span, and ``reach`` rows on both sides.

    The rows before are looked up in the months next to the batch; as long as some group has too
    few there, twice as many months are taken, so history is read only as far back as it must be.
    """
    spans = checkpointed(batch.groupBy(*map(cname, keys)).agg(
        F.min(cname(order)).alias("_first"), F.max(cname(order)).alias("_last")
    ))
    ends = spans.agg(F.min("_first").alias("first"), F.max("_last").alias("last")).first()
    oldest = stored.agg(F.min("month")).first()[0]  # from the folders' names

    def months_back(n: int) -> str:
        months = ends.first.year * 12 + ends.first.month - 1 - n
        return f"{months // 12:04d}-{months % 12 + 1:02d}"

    def near(back: int) -> DataFrame:
        return stored.filter(F.col("month") >= months_back(back)).join(spans, list(keys))

    back = 1
    while True:
        recent = near(back)
        before = checkpointed(windows.last_rows(recent.filter(cname(order) < F.col("_first")), reach, keys, [order]))
        found = before.groupBy(*map(cname, keys)).agg(F.count(F.lit(1)).alias("_n"))
        lacking = spans.join(found, list(keys), "left").filter(F.coalesce("_n", F.lit(0)) < reach)
        if oldest is None or months_back(back) <= oldest or lacking.isEmpty():
            break
        back *= 2
    recent = near(1)
    inside = recent.filter(cname(order).between(F.col("_first"), F.col("_last")))
    after = windows.last_rows(
        recent.filter(cname(order) > F.col("_last")), reach, keys, [order], oldest=True
    )
    return before.unionByName(inside).unionByName(after).select(*map(cname, stored.columns))


def refresh_features(
    batch: DataFrame, table: str, features: str, keys: Sequence[str] = ("zone",),
    order: str = "datetime",
) -> None:
    """Bring the feature table up to date after ``batch`` was merged into ``table``.

    A new row changes its own features and those of the next rows its window reaches; these are
    computed from the rows around the batch and replace the stored ones, month by month.
    """
    spark = batch.sparkSession
    if batch.isEmpty():
        return
    reach = max(schemas.WINDOW_ROWS - 1, *schemas.LAGS)
    near = rows_around(spark.read.parquet(table), batch, keys, order, reach)
    fresh = checkpointed(windows.cyclic_month(windows.engineer_features(near, keys, order)))
    result = fresh
    if snapshots.exists(spark, features):
        stored = spark.read.parquet(features)
        touched = in_months(stored, touched_months(fresh))
        kept = touched.join(fresh.select(*map(cname, keys), cname(order)), [*keys, order], "left_anti")
        result = checkpointed(fresh.unionByName(kept))
    overwrite_months(result, features)


def ingest(
    stream: DataFrame,
    table: str,
    progress: str,
    rules: Sequence[quality.ColumnRule] | None = None,
    quarantine: str | None = None,
    keys: Sequence[str] = ("zone", "datetime"),
    shape: Callable[[DataFrame], DataFrame] = cleaning.clean,
    features: str | None = None,
    state: str | None = None,
    value_sets: Sequence[str] = (),
) -> StreamingQuery:
    """Process everything that has landed, then stop: clean, validate, merge by key.

    With ``features`` the window features of the touched rows are kept in a second table.
    ``progress`` is the stream's checkpoint folder. A batch that breaks the rules goes to
    ``quarantine`` whole and the stream goes on. With ``state`` the column statistics of all accepted
    batches are kept there (see ``rulestate``): each accepted batch is merged into them, and where no
    ``rules`` are given, they are the rules of the next batch. Neither reads the history.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        ready = shape(batch).persist()
        try:
            known = rules
            if known is None and state:
                before = rulestate.load_state(batch.sparkSession, state, batch_id)
                known = None if before is None else rulestate.rules_of(before)
            if known is not None and not quality.violation_free(ready, known):
                if quarantine:
                    aside = f"{quarantine.rstrip('/')}/batch={batch_id}"
                    ready.write.mode("overwrite").parquet(aside)
                return
            merge_batch(ready, table, keys)
            if features:
                refresh_features(ready, table, features)
            if state:
                rulestate.save_merged(ready, state, batch_id, value_sets)
        finally:
            ready.unpersist()

    return (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )


def late_border(spark: SparkSession, marks: str, batch_id: int, lateness: str):
    """The time before which rows of this batch are late; None for the first one.

    ``marks`` keeps the newest time of each batch under the batch's number, so a batch that runs again finds
    the border it had.
    """
    if not snapshots.exists(spark, marks):
        return None
    newest = spark.read.schema("newest timestamp_ntz, batch bigint").json(marks).filter(F.col("batch") < batch_id)
    return newest.agg((F.max("newest") - F.expr(f"INTERVAL {lateness}")).alias("border")).first().border


def merge_overlap(
    stream: DataFrame, table: str, late: str, marks: str, progress: str,
    keys: Sequence[str] = ("zone", "datetime"), order: str = "datetime", lateness: str = "7 days",
    sequence: Sequence[str] = (),
) -> StreamingQuery:
    """Keep one row per key of everything that lands, however late; then stop.

    Rows within ``lateness`` of the newest time seen in earlier batches meet the few months they touch. Rows
    behind that border are not forgotten: they are merged by key into their own months just the same, and each
    batch lists its late rows in ``late/batch=N`` (see ``late_counts``). So the table does not depend on how
    files are dealt to batches, and with ``sequence`` not on their order either. Every step of a
    batch writes under the batch's number or by key, so a replay is harmless. ``order`` is a
    timestamp without zone; rows without it are never late.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        ready = batch.persist()
        try:
            border = late_border(spark, marks, batch_id, lateness)
            if border is not None:
                behind = ready.filter(cname(order) < F.lit(border).cast("timestamp_ntz"))
                behind.write.mode("overwrite").parquet(f"{late.rstrip('/')}/batch={batch_id}")
            merge_batch(ready, table, keys, order, sequence)
            newest = ready.agg(F.max(cname(order)).cast("timestamp_ntz").alias("newest"))
            newest.write.mode("overwrite").json(f"{marks.rstrip('/')}/batch={batch_id}")
        finally:
            ready.unpersist()

    return (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )


def late_rows(spark: SparkSession, late: str, schema: T.StructType) -> DataFrame:
    """All rows that came behind the border, with the number of their ``batch``."""
    wide = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    if not snapshots.exists(spark, late):
        return spark.createDataFrame([], wide)
    return spark.read.schema(wide).parquet(late)


def late_counts(spark: SparkSession, late: str, schema: T.StructType) -> DataFrame:
    """How many rows of each batch came late."""
    return late_rows(spark, late, schema).groupBy("batch").agg(F.count(F.lit(1)).alias("late_rows"))


def dedupe_overlap(
    stream: DataFrame, keys: Sequence[str] = ("zone", "datetime"), order: str = "datetime",
    lateness: str = "7 days",
) -> DataFrame:
    """Drop repeats of a key that arrive within the overlap; older state is forgotten.

    This form stays a stream, with bounded state; rows older than the watermark are dropped. Where none may
    be lost, use ``merge_overlap``.
    """
    timed = stream.withColumn(order, cname(order).cast("timestamp"))
    return timed.withWatermark(order, lateness).dropDuplicatesWithinWatermark(list(keys))
