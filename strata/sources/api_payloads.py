"""Landed API documents to raw rows.

The reference polls three HTTP APIs; here their responses are files dropped
into a landing folder (one JSON document per line, or one per file). Each
reader parses with the declared payload schema and flattens to the raw
table's columns; ``strata.sources.ingest.with_ingest_meta`` then stamps the
source and load time. Documents are small (one API page each), so the work
is spread over however many documents land.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.exprs import iso_to_ts
from strata.sources.json_records import read_json_columnar, read_json_records

# Payload schemas (fixed by the APIs).
EVENT_ELEMENT = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("actor", T.StructType([T.StructField("login", T.StringType()), T.StructField("id", T.LongType())])),
    T.StructField("repo", T.StructType([T.StructField("name", T.StringType()), T.StructField("id", T.LongType())])),
    T.StructField("created_at", T.StringType()),
    T.StructField("public", T.BooleanType()),
])
PRODUCT_ELEMENT = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("discountPercentage", T.DoubleType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("stock", T.IntegerType()),
    T.StructField("brand", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("thumbnail", T.StringType()),
])
WEATHER_ARRAYS = {
    "time": ("time", T.StringType()),
    "temperature_2m": ("temperature_2m", T.DoubleType()),
    "humidity": ("relative_humidity_2m", T.IntegerType()),
    "precipitation": ("precipitation", T.DoubleType()),
    "weather_code": ("weather_code", T.IntegerType()),
}


def read_documents(spark: SparkSession, path: str, one_per_file: bool = False) -> DataFrame:
    """Landed documents as a ``doc`` text column (JSON Lines, or whole files)."""
    reader = spark.read.option("wholetext", True) if one_per_file else spark.read
    return reader.text(path).withColumnRenamed("value", "doc")


def events_from_payload(docs: DataFrame, column: str = "doc") -> DataFrame:
    """``[{"id", "type", "actor": {"login", "id"}, "repo": {...}, ...}]`` to raw event rows."""
    return read_json_records(docs, column, EVENT_ELEMENT, {
        "id": "id", "type": "type", "actor_login": "actor.login", "actor_id": "actor.id",
        "repo_name": "repo.name", "repo_id": "repo.id", "created_at": "created_at", "is_public": "public",
    })


def products_from_payload(docs: DataFrame, column: str = "doc") -> DataFrame:
    """``{"products": [...]}`` to raw product rows (``discountPercentage`` renamed)."""
    return read_json_records(docs, column, PRODUCT_ELEMENT, {
        "id": "id", "title": "title", "description": "description", "price": "price",
        "discount_percentage": "discountPercentage", "rating": "rating", "stock": "stock", "brand": "brand",
        "category": "category", "thumbnail": "thumbnail",
    }, root="products")


def weather_from_payload(docs: DataFrame, column: str = "doc", tz: str | None = None) -> DataFrame:
    """S3: ``{"hourly": {"time": [...], "temperature_2m": [...], ...}}`` to one row per hour.

    ``tz`` names the zone the API wrote local times in; they become UTC
    (the reference drops the zone, SURVEY F17).
    """
    rows = read_json_columnar(docs, column, "hourly", WEATHER_ARRAYS)
    return rows.withColumn("time", iso_to_ts("time", tz=tz))


READERS = {
    "github_events": events_from_payload,
    "ecommerce_products": products_from_payload,
    "weather_forecast": weather_from_payload,
}
