"""End-to-end jobs.

``run_all`` refreshes every domain layer by layer: raw is appended, ODS is a
view over it, DWD and the day-keyed DWS tables are upserted partition by
partition, the other DWS tables and ADS are written as new table versions,
then the check suite, the count snapshot and drift, and the summary run.
Each layer is written and read back by the next, so lineage is cut at every
layer and a lost executor only re-runs the layer being written.

Partitioned tables (DWD, day-keyed DWS) are stored under a hidden partition
column that follows from the row's key: the day (or month, ``grain="month"``,
for small volumes) of a time that never changes for a key, or a range of ids.
An incremental run reads and rewrites only the partitions its batch touches. Their watermark is a
marker written after the data commit, so a run that died during the commit
is redone whole by the next run.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import monitor, quality, report
from strata.operators.incremental import max_value
from strata.plans import ads, dwd, dws, ods
from strata.plans import suite as S
from strata.session import configure
from strata.functions.exprs import in_values
from strata.sources import adapters, api_payloads, changes
from strata.sources.ingest import (
    load_seed, read_current, read_partitioned, read_watermark, recorded_measures, table_root, upsert_partitions, with_ingest_meta,
    write_table, write_watermark,
)
from strata.sources.raw import append_loads, appended_measures, has_loads, read_loads

DOMAINS = list(adapters.RAW)
PIPELINE = "strata run-all"
PART, PART_ID = "_part_date", "_part_id"

# Partitioned tables: (upsert keys, column that places a row in a partition).
# The partition of a row must follow from its key, so that a batch alone names the
# partitions it touches: events keep their creation time, forecasts are keyed by time,
# and tables whose rows are loaded again at other times go by ranges of their id.
# Day-keyed DWS tables use the day as a coarse key: re-opened days are replaced whole.
PARTITIONED = {
    "dwd_github_events": (["event_id"], "event_date"),
    "dwd_weather_forecast": (["forecast_time"], "forecast_date"),
    "dwd_business_orders": (["order_id"], "order_id"),
    "dwd_business_order_items": (["item_id"], "item_id"),
    "dwd_business_customers": (["customer_id"], "customer_id"),
    "dwd_ecommerce_products": (["product_id"], "product_id"),
    "dws_github_daily_activity": (["event_date"], "event_date"),
    "dws_weather_daily_summary": (["forecast_date"], "forecast_date"),
    "dws_order_daily_summary": (["order_date_key"], "order_date_key"),
}
#: Groups that a DWD upsert writes to its change log, for the DWS tables aggregated by them.
TRACKED = {
    "dwd_github_events": ["event_date"],
    "dwd_weather_forecast": ["forecast_date"],
    "dwd_business_orders": ["order_date_key", "customer_id"],
    "dwd_business_customers": ["customer_id"],
    "dwd_ecommerce_products": ["category"],
}
#: Group column of each DWS table.
GROUPED_BY = {
    "dws_github_daily_activity": "event_date",
    "dws_weather_daily_summary": "forecast_date",
    "dws_order_daily_summary": "order_date_key",
    "dws_ecommerce_category_daily": "category",
    "dws_customer_order_summary": "customer_id",
}
#: Ids per partition of the tables that go by id (about one file of 128 MB at 130 bytes a row).
IDS_PER_PARTITION = 1_000_000

DWS_ORDER = ["dws_github_daily_activity", "dws_weather_daily_summary", "dws_ecommerce_category_daily",
             "dws_order_daily_summary", "dws_customer_order_summary"]
ADS_ORDER = ["ads_github_trending", "ads_weather_alert", "ads_ecommerce_kpi", "ads_business_kpi"]

# Which DWS / ADS models each domain feeds (L2 runs one domain downstream).
DOWNSTREAM = {
    "github_events": (["dws_github_daily_activity"], ["ads_github_trending"]),
    "weather_forecast": (["dws_weather_daily_summary"], ["ads_weather_alert"]),
    "ecommerce_products": (["dws_ecommerce_category_daily"], ["ads_ecommerce_kpi"]),
    "business_customers": (["dws_customer_order_summary"], ["ads_business_kpi"]),
    "business_orders": (["dws_order_daily_summary", "dws_customer_order_summary"], ["ads_business_kpi"]),
    "business_order_items": ([], []),
}
DWS_INPUTS = {
    "dws_github_daily_activity": ["github_events"],
    "dws_weather_daily_summary": ["weather_forecast"],
    "dws_ecommerce_category_daily": ["ecommerce_products"],
    "dws_order_daily_summary": ["business_orders"],
    "dws_customer_order_summary": ["business_orders", "business_customers"],
}
ADS_INPUTS = {
    "ads_github_trending": ["dws_github_daily_activity"],
    "ads_weather_alert": ["dwd_weather_forecast"],
    "ads_ecommerce_kpi": ["dws_ecommerce_category_daily"],
    "ads_business_kpi": ["dws_customer_order_summary", "dws_order_daily_summary"],
}


@dataclass
class RunResult:
    written: dict[str, str]
    checks: DataFrame
    summary: DataFrame
    drift: DataFrame | None
    messages: list[tuple[str, str]] = field(default_factory=list)   # (title, Markdown body), Q12


def _layer(name: str) -> str:
    return name.split("_", 1)[0]


class Job:
    def __init__(self, spark: SparkSession, out_base: str, as_of: _dt.datetime | None = None,
                 seed: DataFrame | None = None, now: _dt.datetime | None = None, today: _dt.date | None = None,
                 grain: str = "day", late_rows: bool = True, gate: bool = False):
        self.spark = configure(spark)
        self.base = out_base
        self.as_of = as_of or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        self.now = now or self.as_of
        self.today = today or self.as_of.date()
        self.grain = grain
        self.late_rows = late_rows  # False: day tables only re-open their last day, as the reference does (G3)
        self.gate = gate  # True: a layer whose rows fail a check of severity error doesn't become current (Q14)
        self._seed = seed
        self.written: dict[str, str] = {}

    # --- table access --------------------------------------------------------------
    def current(self, layer: str, name: str, internal: bool = False) -> DataFrame | None:
        if name in PARTITIONED:
            df = read_partitioned(self.spark, self.base, layer, name, self._part_name(name))
            return df if df is None or internal else df.drop(PART, PART_ID)
        return read_current(self.spark, table_root(self.base, layer, name))

    def save(self, df: DataFrame, layer: str, name: str) -> DataFrame:
        self.written[name] = write_table(df, self.base, layer, name, **self._checked(name))
        return self.current(layer, name)

    @staticmethod
    def _checks(name: str) -> list:
        return S.FULL_SUITE.get(name, [])

    def _checked(self, name: str) -> dict:
        """What a write counts of the table's checks, and the gate that sees the counts first."""
        checks = self._checks(name)
        return {"measures": quality.measures(checks), "gate": quality.stop_on_failures(name, checks) if self.gate else None}

    def measured(self, name: str) -> dict[str, int] | None:
        """Counts recorded by the writes of a table; an ODS view has the rows of its raw table that have a key."""
        layer, _, domain = name.partition("_")
        if layer in ("raw", "ods"):
            found = appended_measures(self.spark, table_root(self.base, "raw", domain))
            return {"rows": found["keyed"]} if found and layer == "ods" else found
        return recorded_measures(self.spark, self.base, layer, name)

    def seed(self) -> DataFrame:
        return self._seed if self._seed is not None else load_seed(self.spark)

    @staticmethod
    def _part_name(name: str) -> str:
        return PART_ID if PARTITIONED[name][1].endswith("_id") else PART

    def _part(self, column: str) -> Column:
        if column.endswith("_id"):
            return F.floor(F.col(column) / IDS_PER_PARTITION).cast("long")
        day = F.to_date(F.col(column))
        return F.trunc(day, "MM") if self.grain == "month" else day

    def _upsert(self, name: str, batch: DataFrame, mark, newest: str | None = None, gone: Column | None = None,
                gone_partitions: list | tuple = ()) -> DataFrame:
        """Rewrite the partitions ``batch`` touches; record the watermark after the commit."""
        keys, place = PARTITIONED[name]
        layer = _layer(name)
        target = self.current(layer, name, internal=True)
        # DWD tables follow the incoming columns, DWS tables only add new ones
        policy = "sync_all_columns" if layer == "dwd" else "append_new_columns"
        part = self._part_name(name)
        path = upsert_partitions(target, batch.withColumn(part, self._part(place)), keys, self.base, layer, name, part,
                                 policy=policy, stable=True, newest=newest, track=TRACKED.get(name, ()),
                                 gone=gone, gone_partitions=gone_partitions, **self._checked(name))
        self.written[name] = path
        if mark is not None:
            write_watermark(self.spark, self.base, layer, name, mark)
        return self.current(layer, name)

    def _mark(self, name: str, column: str, target: DataFrame | None):
        """Recorded watermark, else (first run of an existing table) the table's max."""
        mark = read_watermark(self.spark, self.base, _layer(name), name)
        if mark is None and target is not None:
            mark = max_value(target, column, default=None)
        return mark

    # --- layers ----------------------------------------------------------------------
    def land(self, domain: str, frame: DataFrame) -> None:
        """Append one load of a domain to its raw table, under its load period."""
        key = ods.SPECS[f"ods_{domain}"][1]
        counted = quality.measures(self._checks(f"raw_{domain}")) | {"keyed": F.count(key)}
        append_loads(frame, table_root(self.base, "raw", domain), self.grain, counted)

    def land_documents(self, domain: str, path: str, source: str, one_per_file: bool = False,
                       tz: str | None = None) -> None:
        """S11 + S1-S3 + S5: parse landed API documents and append them to raw,
        stamped with the source system and this run's load time."""
        docs = api_payloads.read_documents(self.spark, path, one_per_file)
        reader = api_payloads.READERS[domain]
        rows = reader(docs, tz=tz) if domain == "weather_forecast" else reader(docs)
        self.land(domain, with_ingest_meta(rows, source, self.as_of))

    def raw(self, domain: str, since: _dt.datetime | None = None) -> DataFrame:
        """The raw table, or its rows loaded after ``since`` from the load periods that can hold them."""
        return read_loads(self.spark, table_root(self.base, "raw", domain), since)

    def _landed(self, domain: str) -> bool:
        return has_loads(self.spark, table_root(self.base, "raw", domain))

    def ods(self, domain: str, since: _dt.datetime | None = None) -> DataFrame:
        return getattr(ods, f"ods_{domain}")(self.raw(domain, since))

    def refresh_dwd(self, domain: str) -> DataFrame | None:
        """I1 + W5 + I4: the rows loaded since the recorded watermark, upserted by key.

        Only the load periods since the mark are opened. The new mark is read first (max
        load time past the old mark: one column) and the batch is bounded by it,
        so rows landing during the run wait for the next run instead of being
        skipped; nothing new means nothing is written.
        """
        name = f"dwd_{domain}"
        since = self._mark(name, "_ingested_at", self.current("dwd", name))
        fresh = self.ods(domain, since)
        mark = max_value(fresh, "_ingested_at", default=None)
        if mark is None:
            return self.current("dwd", name)
        bounded = fresh.where(F.col("_ingested_at") <= F.lit(mark).cast("timestamp_ntz"))
        batch = getattr(dwd, name)(bounded, as_of=self.as_of, merge=False)
        return self._upsert(name, batch, mark)

    def _changed_groups(self, name: str) -> tuple[DataFrame | None, dict[str, int]]:
        """Groups of a DWS table that its sources changed since it read their logs last, and the marks to record.

        None means all of them: the table is new, or has not read the logs yet.
        """
        column = GROUPED_BY[name]
        marks = {d: changes.last_entry(self.spark, self.base, "dwd", f"dwd_{d}") for d in DWS_INPUTS[name]}
        seen = changes.read_marks(self.spark, self.base, "dws", name)
        if seen is None or self.current("dws", name) is None:
            return None, marks
        found = None
        for d in marks:
            part = changes.read_since(self.spark, self.base, "dwd", f"dwd_{d}", seen.get(d, 0), [column])
            if part is not None:
                found = part if found is None else found.unionByName(part).distinct()
        return (self.spark.range(0).select(F.lit(None).alias(column)) if found is None else found), marks

    def _mark_read(self, name: str, marks: dict[str, int]) -> None:
        """After the commit: record what was read, and drop the entries that every reader has read."""
        changes.write_marks(self.spark, self.base, "dws", name, marks)
        for d in marks:
            readers = [changes.read_marks(self.spark, self.base, "dws", t) for t, inputs in DWS_INPUTS.items() if d in inputs]
            read = [m.get(d, 0) for m in readers if m is not None]  # a table without marks is built in full
            changes.forget(self.spark, self.base, "dwd", f"dwd_{d}", min(read, default=0))

    def refresh_dws(self, name: str) -> DataFrame:
        """The groups that the sources' change logs name are built anew, late rows and all.

        Nothing is asked of the rest of the sources: days and categories become
        literals (and partition literals, where the source is stored by day), customers
        too while they are few.
        """
        if name in PARTITIONED and not self.late_rows:
            return self._reopen_last_day(name)
        touched, marks = self._changed_groups(name)
        d = lambda x: self.current("dwd", f"dwd_{x}")
        target = self.current("dws", name)
        if touched is not None and touched.isEmpty():
            return target
        if name in PARTITIONED:
            out = self._rebuild_days(name, touched)
        elif name == "dws_ecommerce_category_daily":
            out = self.save(dws.dws_ecommerce_category_daily(
                d("ecommerce_products"), as_of=self.as_of, target=None if touched is None else target, touched=touched), "dws", name)
        else:
            out = self.save(dws.dws_customer_order_summary_changed(
                d("business_orders"), d("business_customers"), None if touched is None else target, as_of=self.as_of, touched=touched),
                "dws", name)
        self._mark_read(name, marks)
        return out

    def _daily(self, name: str, src: DataFrame, target: DataFrame | None = None) -> DataFrame:
        if name == "dws_github_daily_activity":
            return dws.dws_github_daily_activity(src, self.seed(), as_of=self.as_of, target=target, merge=False)
        if name == "dws_weather_daily_summary":
            return dws.dws_weather_daily_summary(src, as_of=self.as_of, target=target, merge=False)
        return dws.dws_order_daily_summary(src, as_of=self.as_of, target=target, merge=False)

    def _rebuild_days(self, name: str, touched: DataFrame | None) -> DataFrame:
        """The touched days (all without ``touched``) from all their rows; a day that lost its rows goes."""
        day, source = PARTITIONED[name][1], f"dwd_{DWS_INPUTS[name][0]}"
        target = self.current("dws", name, internal=True)
        src = self.current("dwd", source, internal=True)
        if touched is None:
            periods = [] if target is None else [r[0] for r in target.select(PART).distinct().collect()]
            return self._upsert(name, self._daily(name, src.drop(PART, PART_ID)), None, gone=F.lit(True), gone_partitions=periods)
        days = [r[0] for r in touched.collect()]  # one row per touched day
        periods = [r[0] for r in touched.select(self._part(day)).distinct().collect()]
        inside = in_values(day, days)
        if PART in src.columns:  # stored by the same day: whole partitions are left out
            src = src.where(in_values(PART, periods))
        return self._upsert(name, self._daily(name, src.where(inside).drop(PART, PART_ID)), None, gone=inside, gone_partitions=periods)

    def _reopen_last_day(self, name: str) -> DataFrame:
        """I2 as the reference does it: from the last stored day on; rows that come late for older days stay out."""
        day = PARTITIONED[name][1]
        since = self._mark(name, day, self.current("dws", name))
        mark_frame = None if since is None else self.spark.range(1).select(F.lit(since).cast("timestamp_ntz").alias(day))
        src = self.current("dwd", f"dwd_{DWS_INPUTS[name][0]}")
        fresh = src if since is None else src.where(F.col(day) >= F.lit(since).cast("timestamp_ntz"))
        d_mark = max_value(fresh, day, default=None)   # one column of DWD, filter pushed
        if d_mark is None:
            return self.current("dws", name)
        return self._upsert(name, self._daily(name, src, target=mark_frame), d_mark)

    def refresh_ads(self, name: str) -> DataFrame:
        s = lambda x: self.current("dws", x)
        if name == "ads_github_trending":
            out = ads.ads_github_trending(s("dws_github_daily_activity"), today=self.today, as_of=self.as_of)
        elif name == "ads_weather_alert":
            out = ads.ads_weather_alert(self.current("dwd", "dwd_weather_forecast"), now=self.now, as_of=self.as_of)
        elif name == "ads_ecommerce_kpi":
            out = ads.ads_ecommerce_kpi(s("dws_ecommerce_category_daily"), as_of=self.as_of)
        else:
            out = ads.ads_business_kpi(s("dws_customer_order_summary"), s("dws_order_daily_summary"), as_of=self.as_of)
        return self.save(out, "ads", name)

    # --- checks and monitoring ---------------------------------------------------------
    def tables(self, models: list[str] | None = None) -> dict[str, DataFrame]:
        wanted = (lambda n: True) if models is None else (lambda n: n in models)
        out = {}
        for d in DOMAINS:
            if self._landed(d):
                out |= {n: f for n, f in ((f"raw_{d}", self.raw(d)), (f"ods_{d}", self.ods(d))) if wanted(n)}
        for name in S.FULL_SUITE:  # every table there is, whether this run wrote it or not
            if _layer(name) in ("dwd", "dws", "ads") and wanted(name):
                frame = self.current(_layer(name), name)
                if frame is not None:
                    out[name] = frame
        return out

    def check(self, models: list[str] | None = None) -> DataFrame:
        """The suite, row-level checks from the counts that the writes recorded."""
        out = None
        for model, df in self.tables(models).items():
            checks = self._checks(model)
            if not checks:
                continue
            found = self.measured(model)
            part = quality.run_checks(df, model, checks) if found is None else quality.results_from(df, model, checks, found)
            out = part if out is None else out.unionByName(part)
        return out

    def counts(self) -> DataFrame:
        """The row count of every model table, from the record of its writes; a table without one is counted."""
        known, rest = [], {}
        for name, df in self.tables().items():
            if _layer(name) == "raw":
                continue
            found = self.measured(name)
            if found is None:
                rest[(_layer(name), name)] = df
            else:
                known.append((_layer(name), name, found["rows"]))
        out = self.spark.createDataFrame(known, "schema_name string, table_name string, row_count long")
        return out.unionByName(monitor.table_counts(rest)) if rest else out

    def monitor(self) -> DataFrame | None:
        """Q10 + I8: counts of every model table, drift against yesterday, snapshot upsert."""
        counts = self.counts()
        snapshot = self.current("dws", "row_count_snapshot")
        drift = None
        if snapshot is not None:
            drift = self.save(monitor.row_count_drift(counts, snapshot, self.today, alerts_only=False),
                              "ads", "row_count_drift")
        self.save(monitor.snapshot_upsert(snapshot, counts, self.today), "dws", "row_count_snapshot")
        return drift


def run_all(spark: SparkSession, sf_dir: str, out_base: str, as_of=None, now=None, today=None,
            seed: DataFrame | None = None, land: bool = True, grain: str = "day", gate: bool = False) -> RunResult:
    """L1: full refresh of all four domains, then checks, drift and summary.

    With ``gate`` a layer whose rows fail a check of severity error doesn't become
    current, and any failed check of severity error raises at the latest after everything is
    written and reported (Q14).
    """
    job = Job(spark, out_base, as_of=as_of, seed=seed, now=now, today=today, grain=grain, gate=gate)
    if land:
        for domain in DOMAINS:
            job.land(domain, adapters.raw(spark, sf_dir, domain))
    for domain in DOMAINS:
        job.refresh_dwd(domain)
    for name in DWS_ORDER:
        job.refresh_dws(name)
    for name in ADS_ORDER:
        job.refresh_ads(name)
    checks = job.save(job.check(), "ads", "dq_results")
    drift = job.monitor()
    summary = report.summarize(checks)
    # Q12: message texts from bounded rows (one summary row, <= 20 failures, <= one row per table)
    messages = [report.markdown(summary, report.failure_report(checks), PIPELINE, when=job.as_of)]
    if drift is not None:
        alert = monitor.drift_markdown(drift, PIPELINE, when=job.as_of)
        if alert:
            messages.append(alert)
    if gate:
        quality.require_passed(checks)
    return RunResult(job.written, checks, summary, drift, messages)


def run_domain(spark: SparkSession, domain: str, sf_dir: str, out_base: str, as_of=None, now=None, today=None,
               seed: DataFrame | None = None, land: bool = True, grain: str = "day", gate: bool = False) -> RunResult:
    """L2: one domain from its ODS view downstream (where its other inputs exist), then its checks."""
    job = Job(spark, out_base, as_of=as_of, seed=seed, now=now, today=today, grain=grain, gate=gate)
    if land:
        job.land(domain, adapters.raw(spark, sf_dir, domain))
    job.refresh_dwd(domain)
    dws_names, ads_names = DOWNSTREAM[domain]
    for name in dws_names:
        if all(job.current("dwd", f"dwd_{d}") is not None for d in DWS_INPUTS[name]):
            job.refresh_dws(name)
    for name in ads_names:
        if all(job.current(_layer(t), t) is not None for t in ADS_INPUTS[name]):
            job.refresh_ads(name)
    models = [f"raw_{domain}", f"ods_{domain}", f"dwd_{domain}", *dws_names, *ads_names]
    checks = job.check(models)
    if gate:
        quality.require_passed(checks)
    return RunResult(job.written, checks, report.summarize(checks), None)
