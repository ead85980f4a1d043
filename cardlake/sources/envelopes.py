"""JSON event envelopes: decode (schema-on-read) and build (publish shape)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cardlake import schemas
from cardlake.functions import columns as C


def decode_envelope(df: DataFrame, payload: StructType, payload_key: str = "data",
                    value_col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Parse a JSON envelope column into typed columns.

    Output: eventType, eventId, event_ts (timestamp; epoch millis or RFC-3339),
    source, version, <payload_key> (struct), ``_error`` (NULL when the message parsed
    and carries a payload; 'malformed' or 'missing_payload' otherwise), and any ``keep``
    columns of the input (e.g. topic offset). Bad messages are kept, not dropped.
    """
    schema = schemas.envelope(payload, payload_key)
    parsed = F.from_json(F.col(value_col), schema, {"mode": "PERMISSIVE"})
    is_obj = F.ltrim(F.col(value_col)).startswith("{")
    out = df.select(*keep, F.col(value_col), parsed.alias("_e"))
    return out.select(
        *keep,
        F.col("_e.eventType").alias("eventType"),
        F.col("_e.eventId").alias("eventId"),
        C.flexible_timestamp(F.col("_e.timestamp")).alias("event_ts"),
        F.col("_e.source").alias("source"),
        F.col("_e.version").alias("version"),
        F.col(f"_e.{payload_key}").alias(payload_key),
        F.when(F.col("_e").isNull() | ~is_obj | F.col("_e.eventType").isNull() & F.col(f"_e.{payload_key}").isNull(),
               "malformed")
        .when(F.col(f"_e.{payload_key}").isNull(), "missing_payload").alias("_error"),
    )


def build_envelope(df: DataFrame, event_type: str, source: str, version: str,
                   payload: list[Column | str], payload_key: str = "data",
                   event_id: Column | None = None, timestamp: Column | None = None,
                   key: Column | None = None, timestamp_as_millis: bool = False, headers: bool = False) -> DataFrame:
    """Wrap rows in the publish envelope -> (key, value JSON), with ``headers`` also the message headers
    eventType and source, in the shape that the Kafka sink takes (option includeHeaders).

    event_id defaults to ``uuid()`` and timestamp to ``current_timestamp()``; pass
    deterministic columns for reproducible output (tests, replays).
    """
    eid = event_id if event_id is not None else F.expr("uuid()")
    ts = timestamp if timestamp is not None else F.current_timestamp()
    if timestamp_as_millis:
        ts_val = C.to_epoch_ms(ts)
    else:
        ts_val = F.date_format(ts.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    body = F.struct(
        F.lit(event_type).alias("eventType"), eid.alias("eventId"), ts_val.alias("timestamp"),
        F.lit(source).alias("source"), F.lit(version).alias("version"),
        F.struct(*payload).alias(payload_key),
    )
    return df.select((key.cast("string") if key is not None else F.lit(None).cast("string")).alias("key"),
                     F.to_json(body).alias("value"), *([event_headers(event_type, source)] if headers else []))


def event_headers(event_type: str, source: str) -> Column:
    """headers: an array of (key, value as bytes)."""
    return F.array(*[F.struct(F.lit(k).alias("key"), F.lit(v).cast("binary").alias("value"))
                     for k, v in (("eventType", event_type), ("source", source))]).alias("headers")
