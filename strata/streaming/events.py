"""Structured Streaming path for the event domain.

The reference polls an API every 30 minutes in batch mode; here files of
event records dropped into a landing folder are a stream:

* X1 ``land_stream``: file source -> raw parquet, ``trigger(availableNow=True)``
* X2 ``clean_dedup_stream``: M7 cleaning + ``dropDuplicatesWithinWatermark``
  (keeps the FIRST arrival per event id inside the watermark)
* X3 ``upsert_batches``: ``foreachBatch`` applying the batch DWD model and
  the upsert, so the result equals the batch M7 (latest load wins)
* X2 ``latest_events``: keyed state that holds the newest row per event id and
  replaces it when a later one arrives, in whatever order (update mode)
* X4 ``exact_daily_distinct``: exact distinct counts as two states, one row per
  (day, type, value) and one count per (day, type)
* X4 ``daily_type_counts``: tumbling 1-day windows per type with a late-data
  bound; distinct actors are approximate (exact distinct is not supported on
  streams)

Checkpoint folders lie next to the stream's output unless given, so a restarted
query resumes where it stopped, also in a new application.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from strata.functions import exprs as X
from strata.plans import dwd, ods

# Raw event record as it lands (flattened API fields plus load metadata).
RAW_EVENT_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("actor_login", T.StringType()),
    T.StructField("actor_id", T.LongType()),
    T.StructField("repo_name", T.StringType()),
    T.StructField("repo_id", T.LongType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("is_public", T.BooleanType()),
    T.StructField("source_system", T.StringType()),
    T.StructField("_ingested_at", T.StringType()),
])


def _checkpoint(output: str, name: str, location: str | None) -> str:
    """The stream's own checkpoint folder: next to its output, so that a restarted
    application finds it again (``spark.checkpoint.dir`` holds a folder per application)."""
    return location or f"{output.rstrip('/')}_checkpoints/{name}"


def read_landing_stream(spark: SparkSession, path: str, schema: T.StructType = RAW_EVENT_SCHEMA,
                        max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.option("mode", "FAILFAST").json(path)


def typed_events(raw: DataFrame) -> DataFrame:
    """ODS view of the landed text fields (ISO times to UTC timestamps)."""
    typed = raw.withColumn("created_at", X.iso_to_ts("created_at")).withColumn(
        "_ingested_at", X.iso_to_ts("_ingested_at"))
    return ods.ods_github_events(typed)


def land_stream(spark: SparkSession, landing: str, raw_path: str, checkpoint: str | None = None) -> StreamingQuery:
    """Move every landed file into the raw parquet table, once (exactly-once file sink)."""
    stream = read_landing_stream(spark, landing)
    return (
        stream.writeStream.format("parquet")
        .option("path", raw_path)
        .option("checkpointLocation", _checkpoint(raw_path, "land_events", checkpoint))
        .trigger(availableNow=True)
        .start()
    )


def clean_dedup_stream(raw_stream: DataFrame, watermark: str = "1 day", event_time: str = "_ingested_at",
                       keep_event_ts: bool = False) -> DataFrame:
    """M7 cleaning with first-arrival dedup per event id inside the watermark.

    ``event_time`` names the column the watermark follows. With
    ``keep_event_ts`` the watermarked column ``_event_ts`` is kept, so a
    downstream window (X4) reuses the same watermark instead of defining one.
    """
    e = typed_events(raw_stream)
    cleaned = e.where(
        F.col("event_id").isNotNull() & F.col("event_type").isNotNull() & F.col("repo_name").like("%/%")
    ).select(
        "event_id",
        F.upper(F.trim("event_type")).alias("event_type"),
        F.trim("actor_login").alias("actor_login"),
        "actor_id",
        F.split_part(F.col("repo_name"), F.lit("/"), F.lit(1)).alias("repo_owner"),
        F.split_part(F.col("repo_name"), F.lit("/"), F.lit(2)).alias("repo_name_short"),
        "repo_id",
        "event_created_at",
        X.trunc_ts("event_created_at", "day").alias("event_date"),
        X.trunc_ts("event_created_at", "hour").alias("event_hour"),
        "is_public",
        "source_system",
        "_ingested_at",
    )
    # Watermarks need a TIMESTAMP (LTZ) column; the session zone is UTC, so the
    # NTZ value converts one to one.
    out = (
        cleaned.withColumn("_event_ts", F.col(event_time).cast("timestamp"))
        .withWatermark("_event_ts", watermark)
        .dropDuplicatesWithinWatermark(["event_id"])
    )
    return out if keep_event_ts else out.drop("_event_ts")


#: State on local disk with change-log checkpoints, so it may outgrow an executor's memory.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def keep_state_on_disk(spark: SparkSession) -> None:
    """Queries started from here on hold their state in RocksDB."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def latest_events(raw_stream: DataFrame) -> DataFrame:
    """The newest row per event id, as the batch M7 picks it; for update mode.

    The state is one row per event: the least of (no load time first, latest load,
    then the other columns ascending), which is the batch's order. A row that comes
    late, again or with an equal load time changes the state only if the batch would
    pick it, so the last row given out per event is the batch's row.
    """
    cleaned = dwd.dwd_github_events(typed_events(raw_stream), merge=dwd.CLEANED)
    rest = [c for c in cleaned.columns if c != "event_id"]
    place = [F.col("_ingested_at").isNotNull().alias("o1"), (-F.unix_micros(F.col("_ingested_at").cast("timestamp"))).alias("o2")]
    best = cleaned.groupBy("event_id").agg(F.min(F.struct(*place, *rest)).alias("r"))
    return best.select("event_id", *[F.col(f"r.{c}").alias(c) for c in rest])


def exact_daily_distinct(clean_stream: DataFrame, column: str, out: str = "unique_values") -> DataFrame:
    """Exact distinct values of ``column`` per (event_date, event_type); for update mode.

    The first state has a row for every (day, type, value) seen, the second counts those
    that are new. Events don't change their day, type or value; where they do, use
    ``upsert_batches(.., daily=True)``.
    """
    seen = clean_stream.where(F.col(column).isNotNull()).select("event_date", "event_type", column)
    return seen.dropDuplicates(["event_date", "event_type", column]).groupBy("event_date", "event_type").agg(F.count(F.lit(1)).alias(out))


def upsert_batches(spark: SparkSession, landing: str, out_base: str, as_of=None, checkpoint: str | None = None,
                   grain: str = "day", daily: bool = False, seed: DataFrame | None = None) -> StreamingQuery:
    """Each micro-batch is cleaned by the batch model and upserted into DWD.

    The micro-batch goes through the same partitioned upsert as the batch job
    (``strata.plans.jobs.Job``): only the event days it touches are rewritten,
    and the table layout is the one the batch pipeline reads. Of the rows of an
    event, stored or new, the one loaded last stays, so late and equal load
    times lose nothing and a replayed micro-batch changes nothing. With ``daily``
    the days that the micro-batch touched are summed up anew from the change log (M13), with
    exact distinct counts.
    """
    from strata.operators.incremental import max_value
    from strata.plans.jobs import Job
    from strata.sources.ingest import drop_batch, stage_batch

    stream = read_landing_stream(spark, landing)
    name = "dwd_github_events"

    def apply(batch: DataFrame, epoch_id: int) -> None:
        job = Job(batch.sparkSession, out_base, as_of=as_of, grain=grain, seed=seed)
        rows = stage_batch(dwd.dwd_github_events(typed_events(batch), as_of=job.as_of, merge=False))  # parsed once
        last = max_value(rows, "_ingested_at", default=None)
        if last is not None:
            since = job._mark(name, "_ingested_at", job.current("dwd", name))
            job._upsert(name, rows, last if since is None else max(since, last), newest="_ingested_at")
            if daily:
                job.refresh_dws("dws_github_daily_activity")
        drop_batch(rows)

    return (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", _checkpoint(out_base, "upsert_events", checkpoint))
        .trigger(availableNow=True)
        .start()
    )


def daily_type_counts(clean_stream: DataFrame, late: str = "1 day") -> DataFrame:
    """Per (day window, type) counts with a late-data bound, append mode.

    A window is emitted once the watermark passes its end; rows later than
    ``late`` are dropped by the engine. Actor counts use HyperLogLog. A stream
    from ``clean_dedup_stream(.., event_time="event_created_at",
    keep_event_ts=True)`` already carries the watermarked ``_event_ts``.
    """
    if "_event_ts" not in clean_stream.columns:
        clean_stream = clean_stream.withColumn("_event_ts", F.col("event_created_at").cast("timestamp")).withWatermark(
            "_event_ts", late)
    return (
        clean_stream
        .groupBy(F.window("_event_ts", "1 day").alias("w"), "event_type")
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.approx_count_distinct("actor_id").alias("approx_unique_actors"),
            F.count_if(F.col("is_public")).alias("public_events"),
            F.count_if(~F.col("is_public")).alias("private_events"),
        )
        .select(F.col("w.start").cast("timestamp_ntz").alias("event_date"), "event_type", "event_count",
                "approx_unique_actors", "public_events", "private_events")
    )
