"""JSON messages: encode, decode, split off what cannot be read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions import iso_seconds
from ..operators.ordering import write_order

ISO = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS]"  # up to nine decimals; Spark keeps six
BLANK = " \t\n\x0b\x0c\r"


def encode_json(df: DataFrame, time_cols: Sequence[str] = (), times: str = "seconds") -> Column:
    """Row as a JSON object; NULL fields are left out."""
    show = iso_seconds if times == "seconds" else lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    fields = [show(c).alias(c) if c in time_cols else F.col(c) for c in df.columns]
    return F.to_json(F.struct(*fields))


def decode_json(df: DataFrame, col: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """Lenient decode: ``(good, bad)``.

    A field of the wrong type or a missing field is NULL in ``good``. A line that is no JSON
    object goes to ``bad`` with its text unchanged; blank lines are skipped. Both halves work on
    batch and streaming frames.
    """
    lines = df.filter(F.length(F.btrim(F.col(col), F.lit(BLANK))) > 0)
    options = {
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": "_corrupt",
        "timestampFormat": ISO,
        "timestampNTZFormat": ISO,
    }
    marked = StructType([*schema.fields, StructField("_corrupt", StringType())])
    # Exploding a one-element array keeps the filter below from being pushed under the parse, which
    # would parse every line twice.
    parsed = lines.select("*", F.explode(F.array(F.from_json(col, marked, options))).alias("_v"))
    # Only lines that did not parse cleanly are parsed again, to tell a wrong field from a broken line.
    broken = F.col("_v._corrupt").isNotNull() & F.try_parse_json(col).isNull()
    readable = F.btrim(F.col(col), F.lit(BLANK)).startswith("{") & ~broken
    others = [c for c in df.columns if c != col]
    fields = [F.col(f"_v.{f.name}").alias(f.name) for f in schema.fields]
    return parsed.filter(readable).select(*others, *fields), parsed.filter(~readable).select(*df.columns)


def to_messages(
    df: DataFrame, key: str, time_cols: Sequence[str] = (), ordered_by: Sequence[str] = (), limit: int | None = None
) -> DataFrame:
    """Keyed messages ``(key, value)``; ``limit`` takes the first messages of the replay order."""
    if ordered_by:
        df = df.orderBy(*ordered_by).limit(limit) if limit else write_order(df, ordered_by)
    elif limit:
        df = df.limit(limit)
    return df.select(F.col(key).cast("string").alias("key"), encode_json(df, time_cols).alias("value"))


def messages_to_kafka(messages: DataFrame, servers: str, topic: str) -> None:
    """Publish keyed messages. Needs the Kafka connector on the class path (not run in tests)."""
    (
        messages.selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )
