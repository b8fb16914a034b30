"""Messages in a registry's frame: a zero byte, the schema's id in four bytes, and the Avro body."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the frame.
MAGIC, HEADER_BYTES = "00", 5


def unframed(messages: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Messages with schema_id and body, and those set aside because they are null, too short or don't begin with a zero byte."""
    head = F.hex(F.substring(F.col(value), 1, HEADER_BYTES))
    framed = F.coalesce((F.length(value) > HEADER_BYTES) & (F.substring(head, 1, 2) == MAGIC), F.lit(False))
    body = F.expr(f"substring({value}, {HEADER_BYTES + 1})")
    good = messages.filter(framed).withColumns({"schema_id": F.conv(F.substring(head, 3, 8), 16, 10).cast("long"), "body": body})
    return good, messages.filter(~framed)


def decoded(messages: DataFrame, schemas: dict[int, str], value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Rows decoded by their frame's schema (id -> Avro schema as JSON; all must have the same fields), and messages set aside, unknown schemas and undecodable bodies included.

    Needs Spark's Avro module on the class path; where it is absent, the call fails with its own message.
    """
    from pyspark.sql.avro.functions import from_avro

    good, bad = unframed(messages, value)
    record: Column = F.coalesce(*[F.when(F.col("schema_id") == number, from_avro("body", schema, {"mode": "PERMISSIVE"})) for number, schema in sorted(schemas.items())])
    rows = good.withColumn("__record", record)
    return rows.filter("__record IS NOT NULL").select("__record.*"), bad.unionByName(rows.filter("__record IS NULL").select(*messages.columns))
