"""API payloads to rows.

Three document shapes reach the warehouse:

* an array of objects (``$.[*].actor.login``)           -> ``read_json_records``
* an object holding an array (``$.products[*].title``)  -> ``read_json_records(root=...)``
* an object of parallel arrays (``$.hourly.time[*]``)   -> ``read_json_columnar``

All of them take a frame with one JSON document per row (a string column) or
an already-parsed struct column, so they work the same on a batch landing
folder and on a stream. Parsing uses a declared schema, never inference. A
malformed document raises; ``quarantine`` splits such documents off first, so
they can be counted and kept.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _parsed(df: DataFrame, column: str, schema: T.DataType) -> Column:
    field = df.schema[column].dataType
    if isinstance(field, T.StringType):
        return F.from_json(F.col(column), schema, {"mode": "FAILFAST"})
    return F.col(column)


def quarantine(df: DataFrame, column: str, shape: str = "object") -> tuple[DataFrame, DataFrame]:
    """(documents that are JSON of the given shape, the others); ``shape`` is "object" or "array".

    Nothing is lost: a document is in exactly one of the two frames. Null
    documents carry no rows and stay with the good ones.
    """
    text = F.col(column)
    start, end = ("[", "]") if shape == "array" else ("{", "}")
    # the parser stops after the first value, so what follows it has to be looked at as well
    bare = F.regexp_replace(text, r"^\s+|\s+$", "")
    framed = bare.startswith(start) & bare.endswith(end)
    good = text.isNull() | (F.try_parse_json(text).isNotNull() & framed)
    return df.where(good), df.where(~good)


def read_json_records(
    df: DataFrame,
    column: str,
    element_schema: T.StructType,
    path_map: Mapping[str, str],
    root: str | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Explode an array of objects and pick (nested) paths.

    ``path_map`` maps output names to dotted paths inside one element, e.g.
    ``{"actor_login": "actor.login"}``. With ``root`` the array sits under
    that key of a top-level object (``{"products": [...]}``).
    """
    array_type = T.ArrayType(element_schema)
    doc_type = T.StructType([T.StructField(root, array_type)]) if root else array_type
    parsed = _parsed(df, column, doc_type)
    items = parsed.getField(root) if root else parsed
    exploded = df.select(*[F.col(k) for k in keep], F.explode_outer(items).alias("_rec"))
    picks = [F.col("_rec." + path).alias(name) for name, path in path_map.items()]
    return exploded.where(F.col("_rec").isNotNull()).select(*[F.col(k) for k in keep], *picks)


def read_json_columnar(
    df: DataFrame,
    column: str,
    root: str,
    arrays: Mapping[str, tuple[str, T.DataType]],
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """S3: zip parallel arrays under ``root`` into rows.

    ``arrays`` maps output names to (array key, element type), e.g.
    ``{"time": ("time", StringType()), "humidity": ("relative_humidity_2m", IntegerType())}``.
    Arrays of unequal length are padded with nulls, as ``arrays_zip`` does.
    """
    inner = T.StructType([T.StructField(src, T.ArrayType(typ)) for src, typ in arrays.values()])
    doc_type = T.StructType([T.StructField(root, inner)])
    parsed = _parsed(df, column, doc_type).getField(root)
    zipped = F.arrays_zip(*[parsed.getField(src).alias(out) for out, (src, _t) in arrays.items()])
    return df.select(*[F.col(k) for k in keep], F.inline_outer(zipped))


def json_path(column: str | Column, path: str) -> Column:
    """one scalar from a JSON text column (``$.k``) without a schema."""
    c = F.col(column) if isinstance(column, str) else column
    return F.get_json_object(c, path)
