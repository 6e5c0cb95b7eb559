"""Ingestion helpers and sinks.

Raw tables are append-only Parquet; ODS is a lazy typed view over raw; DWD
and DWS are keyed tables maintained by upsert; ADS tables are rewritten in
full. Writers never overwrite a path they are reading: a new version folder
is written and a small pointer file is switched afterwards.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.exprs import in_values, ts_literal
from strata.session import ensure_checkpoint_dir

# ---------------------------------------------------------------------------
# The event-type category seed of the reference warehouse.
# Columns: event_type, category, description.
# ---------------------------------------------------------------------------
EVENT_TYPE_CATEGORIES = [
    ("PushEvent", "code", "Code push to repository"),
    ("WatchEvent", "engagement", "User starred a repository"),
    ("PullRequestEvent", "collaboration", "Pull request opened/closed/merged"),
    ("IssuesEvent", "collaboration", "Issue opened/closed/reopened"),
    ("IssueCommentEvent", "collaboration", "Comment on an issue"),
    ("CreateEvent", "code", "Branch or tag created"),
    ("DeleteEvent", "code", "Branch or tag deleted"),
    ("ForkEvent", "code", "Repository forked"),
    ("CommitCommentEvent", "collaboration", "Comment on a commit"),
    ("PublicEvent", "engagement", "Repository made public"),
    ("GollumEvent", "documentation", "Wiki page updated"),
    ("MemberEvent", "team", "User added to repository"),
    ("ReleaseEvent", "release", "Release published"),
    ("SponsorshipEvent", "engagement", "Sponsorship activity"),
]

SEED_SCHEMA = T.StructType(
    [
        T.StructField("event_type", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("description", T.StringType()),
    ]
)


def with_ingest_meta(df: DataFrame, source: str, ingested_at: str | Column | _dt.datetime | None = None) -> DataFrame:
    """Add ``source_system`` and ``_ingested_at``.

    ``ingested_at`` may name an existing column (kept), be a fixed time, or be
    None for the load clock (``current_timestamp``).
    """
    if isinstance(ingested_at, str) and ingested_at in df.columns:
        load = F.col(ingested_at).cast("timestamp_ntz")
    else:
        load = ts_literal(ingested_at)
    cols = [c for c in df.columns if c not in ("source_system", "_ingested_at")]
    return df.select(*cols, F.lit(source).alias("source_system"), load.alias("_ingested_at"))


def with_layer(df: DataFrame, layer: str) -> DataFrame:
    """``_layer`` audit column holding the upper-case layer name."""
    return df.withColumn("_layer", F.lit(layer.upper()))


def load_seed(spark: SparkSession, path: str | None = None, rows=None, schema: T.StructType = SEED_SCHEMA) -> DataFrame:
    """A small dimension from CSV with a declared schema (no inference).

    The header must name the schema's columns; quotes within a value are doubled; a
    malformed row raises. Without a path the built-in category seed is returned.
    """
    if path:
        options = {"header": True, "enforceSchema": False, "escape": '"', "multiLine": True, "mode": "FAILFAST"}
        return spark.read.schema(schema).options(**options).csv(path)
    return values_frame(spark, rows if rows is not None else EVENT_TYPE_CATEGORIES, schema)


def values_frame(spark: SparkSession, rows, schema: T.StructType) -> DataFrame:
    """A small fixed table as SQL ``VALUES``: a local relation whose exact size the
    optimizer knows, so size-checked joins can broadcast it (rows given to
    ``createDataFrame`` carry no size statistics)."""
    def lit(v) -> str:
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
        return repr(v)

    names = [f.name for f in schema.fields]
    body = ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in rows)
    cols = ", ".join(f"CAST(c{i} AS {f.dataType.simpleString()}) AS `{f.name}`" for i, f in enumerate(schema.fields))
    aliases = ", ".join(f"c{i}" for i in range(len(names)))
    return spark.sql(f"SELECT {cols} FROM VALUES {body} AS t({aliases})")


# --- versioned full-refresh / upsert sink -----------------------------------
# Paths go through the Hadoop FileSystem API, so the same code works on a shared
# cluster store (hdfs://, s3a://, abfs://) and on a local folder.

def table_root(base: str, layer: str, name: str) -> str:
    """Tables are addressed as ``<base>/<layer>/<name>`` (no name prefix)."""
    return f"{base.rstrip('/')}/{layer}/{name}"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _fs(spark, path)
    return fs.exists(jpath)


def current_version(spark: SparkSession, root: str) -> str | None:
    """The newest committed version: Spark's committer writes ``_SUCCESS`` last, so a
    version without it is unfinished and invisible. Nothing has to be switched."""
    fs, jroot = _fs(spark, root)
    if not fs.exists(jroot):
        return None
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    names = sorted(st.getPath().getName() for st in fs.listStatus(jroot) if st.getPath().getName().startswith("v-"))
    for name in reversed(names):
        if fs.exists(path(f"{root}/{name}/_SUCCESS")):
            return f"{root}/{name}"
    return None


def read_current(spark: SparkSession, root: str) -> DataFrame | None:
    path = current_version(spark, root)
    return spark.read.parquet(path) if path else None


def measured_write(df: DataFrame, measures: Mapping[str, Column], write) -> dict[str, int]:
    """Run ``write`` on the frame and return the counts that its tasks collected on the way (``Dataset.observe``)."""
    seen = Observation()
    write(df.observe(seen, *[c.alias(k) for k, c in measures.items()]))
    return {k: int(v or 0) for k, v in seen.get.items()}


def write_table(df: DataFrame, base: str, layer: str, name: str, partition_by: Sequence[str] = (),
                keep_versions: int = 2, measures: Mapping[str, Column] | None = None,
                gate: Callable[[dict[str, int]], None] | None = None) -> str:
    """Write a new version of ``layer.name``; it becomes current with its ``_SUCCESS`` mark.

    ``measures`` are counted by the write itself and recorded with the version
    (``recorded_measures``); ``gate`` sees them first and may raise, which leaves the old version current.

    The new version may be computed from the current one (upsert), since older
    versions stay untouched while it is written. Readers see the old or the
    new version whole, whatever step a job dies in. Versions before the last
    ``keep_versions`` committed ones, and older unfinished ones, are removed.
    """
    spark = df.sparkSession
    root = table_root(base, layer, name)
    version = f"v-{_dt.datetime.now(_dt.timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    target = f"{root}/{version}"
    def write(frame: DataFrame) -> None:
        writer = frame.write.mode("errorifexists").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(target)

    found = measured_write(df, measures or {"rows": F.count(F.lit(1))}, write)
    if gate is not None:
        try:
            gate(found)
        except Exception:
            fs, folder = _fs(spark, target)
            fs.delete(folder, True)
            raise
    _write_text(spark, f"{target}/_MEASURES", json.dumps(found))
    _write_text(spark, f"{target}/_SUCCESS", "")
    _drop_old_versions(spark, root, keep_versions)
    return target


def _drop_old_versions(spark: SparkSession, root: str, keep: int) -> None:
    fs, jroot = _fs(spark, root)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    names = sorted(st.getPath().getName() for st in fs.listStatus(jroot) if st.getPath().getName().startswith("v-"))
    done = [n for n in names if fs.exists(path(f"{root}/{n}/_SUCCESS"))]
    if len(done) > keep:
        for n in names:
            if n < done[-keep]:
                fs.delete(path(f"{root}/{n}"), True)


def read_partitioned(spark: SparkSession, base: str, layer: str, name: str, partition_col: str) -> DataFrame | None:
    """Read a day-partitioned table; the day column comes back first, as TIMESTAMP_NTZ
    (or DATE for an internal ``_..._date`` partition column)."""
    path = f"{table_root(base, layer, name)}/data"
    fs, jpath = _fs(spark, path)
    if not fs.exists(jpath):
        return None
    recorded = _read_text(spark, f"{table_root(base, layer, name)}/_SCHEMA")
    if recorded:
        # the table schema as of the last write: columns added since read as nulls
        # in untouched partitions, and no footer is opened to infer it
        schema = T.StructType.fromJson(json.loads(recorded))
        return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())
    inferred = spark.read.parquet(path).schema
    part_type = T.DateType() if partition_col.endswith("_date") and partition_col.startswith("_") else T.TimestampNTZType()
    fields = [T.StructField(f.name, part_type if f.name == partition_col else f.dataType, True)
              for f in inferred.fields]
    df = spark.read.schema(T.StructType(fields)).parquet(path)
    return df.select(partition_col, *[c for c in df.columns if c != partition_col])


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small text file: write a temporary file, then rename it over the old one
    in one step, so a reader finds the old or the new text at any time."""
    fs, jpath = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    tmp = jvm.org.apache.hadoop.fs.Path(jpath.getParent(), f".{jpath.getName()}.{uuid.uuid4().hex[:8]}")
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    option = jvm.org.apache.hadoop.fs.Options.Rename
    overwrite = spark.sparkContext._gateway.new_array(option, 1)
    overwrite[0] = option.OVERWRITE
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf)
    context.rename(fs.makeQualified(tmp), fs.makeQualified(jpath), overwrite)


def _read_text(spark: SparkSession, path: str) -> str | None:
    fs, jpath = _fs(spark, path)
    if not fs.exists(jpath):
        return None
    stream = fs.open(jpath)
    try:
        jvm = spark.sparkContext._jvm
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        return (reader.readLine() or "").strip()
    finally:
        stream.close()


def read_watermark(spark: SparkSession, base: str, layer: str, name: str) -> _dt.datetime | None:
    """The high-watermark recorded after the table's last successful refresh."""
    text = _read_text(spark, f"{table_root(base, layer, name)}/_WATERMARK")
    return _dt.datetime.fromisoformat(text) if text else None


def write_watermark(spark: SparkSession, base: str, layer: str, name: str, value: _dt.datetime) -> None:
    _write_text(spark, f"{table_root(base, layer, name)}/_WATERMARK", value.isoformat())


def stage_batch(df: DataFrame) -> DataFrame:
    """Write a batch once to the cluster's checkpoint folder and read it back: it is used
    several times by an upsert, and must be the same each time."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/batch-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def drop_batch(staged: DataFrame) -> None:
    """Delete the files of a staged batch that nothing reads any more."""
    fs, path = _fs(staged.sparkSession, staged.staged_at)
    fs.delete(path, True)


def _in_partitions(column: str, values: Sequence) -> Column:
    """A filter with literals (null is a value), so only the named partitions are listed and read."""
    return in_values(column, values)


def touched_partitions(target: DataFrame | None, batch: DataFrame, keys: Sequence[str], partition_col: str,
                       stable: bool) -> list:
    """Values of the partitions that an upsert of ``batch`` rewrites (bounded by their number).

    With ``stable`` a row's partition follows from its key, so the batch alone
    names them. Otherwise a key may have moved, and the key column of the
    target is searched for the partitions that still hold one of the batch's keys.
    """
    found = {r[0] for r in batch.select(partition_col).distinct().collect()}
    if target is not None and not stable:
        old = target.join(batch.select(*keys).distinct(), list(keys), "left_semi").select(partition_col).distinct()
        found |= {r[0] for r in old.collect()}
    return sorted(found, key=lambda v: (v is None, v))


def upsert_partitions(
    target: DataFrame | None,
    batch: DataFrame,
    keys: Sequence[str],
    base: str,
    layer: str,
    name: str,
    partition_col: str,
    policy: str = "sync_all_columns",
    stable: bool = False,
    newest: str | None = None,
    track: Sequence[str] = (),
    gone: Column | None = None,
    gone_partitions: Sequence = (),
    measures: Mapping[str, Column] | None = None,
    gate: Callable[[dict[str, int]], None] | None = None,
) -> str:
    """I4 + I6 on disk, rewriting only the partitions the batch touches.

    The batch is written once; the touched partitions (``touched_partitions``)
    are collected and become literals of the partition filter on the target.
    Each is rebuilt as (target rows there, minus batch keys) + batch rows there
    and replaced by dynamic partition overwrite; a touched partition that ends
    up without rows is deleted, since the overwrite leaves it as it was. Other
    partitions are neither read nor written. With ``newest`` the row with the
    greatest value of that column wins over the batch (late rows of a stream).
    Re-running with the same batch gives the same content, also after a run
    that died between overwrite and delete. Column changes follow ``policy``
    (``strata.operators.incremental.align``); the schema is recorded next to
    the data.

    ``track`` names group columns whose values, of the batch and of the rows it
    replaces, go to the table's change log (``strata.sources.changes``) before the data
    is committed. Target rows for which ``gone`` holds (in ``gone_partitions``)
    go as well, whether the batch repeats their keys or not. ``measures`` are
    counted for each rewritten partition and recorded (``recorded_measures``); ``gate`` sees their sums
    before anything is replaced, and may raise.
    """
    from strata.operators.dedup import latest_by_key, rest_tiebreak
    from strata.operators.incremental import align
    from strata.sources import changes

    spark = batch.sparkSession
    root = table_root(base, layer, name)
    path = f"{root}/data"
    staged = batch = stage_batch(batch)
    emptied: list = []
    if target is None:
        new = batch
        if track:
            changes.record(batch.select(*track), base, layer, name)
    else:
        target, batch = align(target, batch, policy)
        touched = touched_partitions(target, batch, keys, partition_col, stable)
        touched = sorted({*touched, *gone_partitions}, key=lambda v: (v is None, v))
        there = target.where(_in_partitions(partition_col, touched))
        if track:
            replaced = there.join(batch.select(*keys).distinct(), list(keys), "left_semi")
            changes.record(replaced.select(*track).unionByName(batch.select(*track)), base, layer, name)
        if gone is not None:
            there = there.where(~F.coalesce(gone, F.lit(False)))
        if newest:
            both = there.unionByName(batch)
            order = [F.col(newest).desc_nulls_first(), *rest_tiebreak(both, [*keys, newest, "_dwd_processed_at", partition_col])]
            new = latest_by_key(both, keys, order, tiebreak=None)
        else:
            kept = there.join(batch.select(*keys).distinct(), list(keys), "left_anti")
            # joins on column names move the key first: restore the table's order
            new = kept.select(*target.columns).unionByName(batch.select(*target.columns))
    # one row per rewritten partition
    counts = {r[0]: {k: int(v or 0) for k, v in r.asDict().items() if k != partition_col} for r in new.groupBy(partition_col).agg(
        *[c.alias(k) for k, c in (measures or {"rows": F.count(F.lit(1))}).items()]).collect()}
    if gate is not None:
        gate(_summed(counts.values()))
    if target is not None:
        emptied = [v for v in touched if v not in counts]
    before = _read_text(spark, f"{root}/_MEASURES")
    # rebalance: AQE splits a hot partition over several writers and merges small ones
    (
        new.hint("rebalance", partition_col)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_col)
        .parquet(path)
    )
    for value in emptied:
        folder = f"{path}/{partition_col}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"
        fs, jpath = _fs(spark, folder)
        fs.delete(jpath, True)
    _write_text(spark, f"{root}/_SCHEMA", new.schema.json())
    if target is None or before:  # else rows of the other partitions were never counted
        known = json.loads(before) if target is not None else {}
        gone_now = {str(v) for v in emptied}
        known = {k: v for k, v in known.items() if k not in gone_now} | {str(k): v for k, v in counts.items()}
        _write_text(spark, f"{root}/_MEASURES", json.dumps(known))
    drop_batch(staged)
    return path


def _summed(parts) -> dict[str, int]:
    out: dict[str, int] = {}
    for part in parts:
        for k, v in part.items():
            out[k] = out.get(k, 0) + v
    return out


def recorded_measures(spark: SparkSession, base: str, layer: str, name: str) -> dict[str, int] | None:
    """The counts recorded when the table was written (``rows`` and those of its checks); None without a record.

    No table is read: a version carries its own counts, a partitioned table those of
    its partitions, of which an upsert replaces the ones that it rewrites.
    """
    root = table_root(base, layer, name)
    version = current_version(spark, root)
    text = _read_text(spark, f"{version}/_MEASURES" if version else f"{root}/_MEASURES")
    if not text:
        return None
    found = json.loads(text)
    return found if version else _summed(found.values())


def read_landing(spark: SparkSession, path: str, schema: T.StructType, multiline: bool = True) -> DataFrame:
    """Batch read of API documents dropped as JSON files into a folder; a malformed document raises."""
    return spark.read.schema(schema).option("multiLine", multiline).option("mode", "FAILFAST").json(path)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str | None = None,
    query: str | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """JDBC read with a pushed column list.

    With ``partition_column`` and bounds, Spark issues ``num_partitions``
    parallel range queries instead of one single-threaded scan.
    """
    reader = spark.read.format("jdbc").option("url", url)
    if query is not None:
        if partition_column:
            reader = reader.option("dbtable", f"({query}) q")
        else:
            reader = reader.option("query", query)
    else:
        reader = reader.option("dbtable", table)
    if partition_column:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(lower_bound))
            .option("upperBound", str(upper_bound))
            .option("numPartitions", str(num_partitions or 8))
        )
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    return reader.load()
