"""Records as JSON text that carries its own schema next to the payload."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The type names of the JSON envelope, by Spark type.
ENVELOPE_TYPES = {"string": "string", "bigint": "int64"}


def wrap_json(payload: Column, spark_type: str = "string", optional: bool = False) -> Column:
    """``{"schema": {...}, "payload": ...}`` as text. A null payload, such as the key of a plain line, is optional by itself."""
    may_lack = F.lit(optional) | payload.isNull()
    schema = F.struct(F.lit(ENVELOPE_TYPES[spark_type]).alias("type"), may_lack.alias("optional"))
    return F.to_json(F.struct(schema.alias("schema"), payload.alias("payload")), {"ignoreNullFields": "false"})


def unwrap_json(text: Column, spark_type: str = "string") -> Column:
    """The payload of an envelope."""
    layout = f"schema struct<type: string, optional: boolean>, payload {spark_type}"
    return F.from_json(text, layout)["payload"]
