"""Explicit schemas of the stored tables, and the column check used by the readers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    BooleanType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _table(*columns) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in columns])


CHANNELS = _table(
    ("channel_id", LongType()),
    ("username", StringType()),
    ("title", StringType()),
    ("is_seed", IntegerType()),
    ("discovered_depth", IntegerType()),
    ("participants_count", LongType()),
    ("broadcast", IntegerType()),
    ("megagroup", IntegerType()),
    ("verified", IntegerType()),
    ("scam", IntegerType()),
    ("fake", IntegerType()),
    ("date_collected_utc", TimestampType()),
    ("resolution_status", StringType()),
)

RELATIONS = _table(
    ("channel_to_id", LongType()),
    ("channel_to_username", StringType()),
    ("channel_to_title", StringType()),
    ("channel_from_id", LongType()),
    ("channel_from_username", StringType()),
    ("channel_from_title", StringType()),
    ("from_name_fallback", StringType()),
    ("target_message_id", LongType()),
    ("target_message_date_utc", TimestampType()),
    ("sampling_depth", IntegerType()),
)

# The columns the graph job cannot do without.
RELATION_KEYS = [name for name in RELATIONS.names if name not in ("target_message_date_utc", "sampling_depth")]

MESSAGES = _table(
    ("message_id", LongType()),
    ("channel_username", StringType()),
    ("date", TimestampType()),
    ("text", StringType()),
    ("views", LongType()),
    ("forwards", LongType()),
    ("is_forwarded", BooleanType()),
    ("forward_from_chat", StringType()),
)

CHANNEL_TRACE = _table(("channel_username", StringType()), ("messages_written", LongType()))

_PEER = _table(("channel_id", LongType()), ("chat_id", LongType()), ("user_id", LongType()))

FORWARD_HEADER = _table(
    ("from_name", StringType()),
    ("from_id", _PEER),
    ("saved_from_peer", _PEER),
    ("saved_from_msg_id", LongType()),
)


def require_columns(df: DataFrame, columns) -> DataFrame:
    """``df`` itself, or an error that names every missing column."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError("missing columns: " + ", ".join(missing))
    return df
