"""Small frames with the rows that break things: nulls, blanks, long texts, ties, repeats, odd columns."""

import re
import zlib

from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCS = StructType([
    StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
    StructField("source", StringType()), StructField("n_chars", LongType()),
])

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def docs_frame(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, lang)."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else None, "s", None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, DOCS)


def write_docs(spark, folder, rows, **tables):
    docs_frame(spark, rows).write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    for name, (data, schema) in tables.items():
        spark.createDataFrame(data, schema).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return folder


def prose(seed: int, words: int) -> str:
    """Plain made-up prose; different seeds share no long passage."""
    import random

    rng = random.Random(seed)
    parts = "ar be ci do el fu ga hi jo ka lu mo ne or pa qui re sa ti um va wo xe yo za".split()
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(words))


def crc(doc_id) -> int:
    return zlib.crc32(str(doc_id).encode())


EDGE = [
    (None, None), (None, "null id text"), (900, None), (901, ""), (902, " \n\t "), (903, "one"), (904, "one two"),
    (905, "é ß 語 \U0001f600 mixed"), (906, "x" * 30_000), (907, "same row twice here"), (907, "same row twice here"),
    (908, prose(5, 20_000)), (909, "\x00\x1c odd \x85 bytes"),
]
