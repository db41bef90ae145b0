"""Normalisation of references, cells, peers and dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space in any script, the prefix a channel link carries, the
# spellings of an empty cell, and the starts of a web address.
WHITE_SPACE = "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
NOT_SPACE = r"[^\s\x0b\x1c-\x1f\x85\p{Z}]"
LINK_PREFIX = "https://t.me/"
EMPTY_CELLS = ("", "none", "nan")
URL_PATTERN = rf"http{NOT_SPACE}+|www{NOT_SPACE}+|https{NOT_SPACE}+"


def strip(value: Column) -> Column:
    return F.btrim(value, F.lit(WHITE_SPACE))


def channel_ref(raw: Column) -> Column:
    """Bare reference: link prefix cut, then a single ``@``."""
    value = strip(raw)
    bare = F.when(value.startswith(LINK_PREFIX), F.substring(value, len(LINK_PREFIX) + 1, 1 << 30)).otherwise(value)
    return strip(F.regexp_replace(bare, "^@", ""))


def channel_name(raw: Column) -> Column:
    """Bare name: every leading ``@`` dropped first, then white space."""
    return strip(F.regexp_replace(raw, "^@+", ""))


def clean_cell(value: Column) -> Column:
    """Stripped text, with all spellings of an empty cell turned into NULL."""
    text = strip(value.cast("string"))
    longest = max(map(len, EMPTY_CELLS))
    return F.when((F.length(text) > longest) | ~F.lower(text).isin(*EMPTY_CELLS), text)


def id_label(channel_id: Column) -> Column:
    return F.concat(F.lit("channel_id:"), channel_id.cast("string"))


def source_label() -> Column:
    """Name of the origin of a relation row; NULL if it has none."""
    return F.coalesce(
        clean_cell(F.col("channel_from_username")),
        clean_cell(F.col("channel_from_title")),
        clean_cell(F.col("from_name_fallback")),
        id_label(F.col("channel_from_id")),
    )


def target_label() -> Column:
    """Name of the re-posting channel of a relation row; NULL if it has none."""
    return F.coalesce(
        clean_cell(F.col("channel_to_username")),
        clean_cell(F.col("channel_to_title")),
        id_label(F.col("channel_to_id")),
    )


def unresolved_source() -> Column:
    return F.col("channel_from_id").isNull()


def peer_label(peer: Column) -> Column:
    """``channel_id:n``, ``chat_id:n`` or ``user_id:n``, whichever is set first.

    A peer with none of them gives its plain text form, a missing peer NULL.
    """
    kinds = ("channel_id", "chat_id", "user_id")
    return F.coalesce(*[F.concat(F.lit(f"{kind}:"), peer[kind].cast("string")) for kind in kinds], peer.cast("string"))


def forward_source(header: Column) -> Column:
    """Origin of a forwarded message as text; NULL for a message of its own."""
    name = F.when(header["from_name"] != "", header["from_name"])
    peer = peer_label(F.coalesce(header["from_id"], header["saved_from_peer"]))
    saved = F.when(
        header["saved_from_msg_id"] != 0,
        F.concat(F.lit("saved_msg_id:"), header["saved_from_msg_id"].cast("string")),
    )
    return F.when(header.isNotNull(), F.coalesce(name, peer, saved, F.lit("unknown_forward_source")))


def iso_utc(moment: Column) -> Column:
    """ISO-8601 text with a ``+00:00`` offset; '' for NULL. Needs a UTC session."""
    micros = F.when(
        F.date_format(moment, "SSSSSS") != "000000", F.date_format(moment, ".SSSSSS")
    ).otherwise(F.lit(""))
    text = F.concat(F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss"), micros, F.date_format(moment, "xxx"))
    return F.coalesce(text, F.lit(""))


# A day in long or basic form, then a time of day with an offset, or nothing.
ISO_MOMENT = r"^\d{4}(-\d{2}-\d{2}|\d{4})([T ]\d.*)?$"


def date_bound(raw: Column, *, is_end: bool) -> Column:
    """Timestamp of an ISO date bound; a bare date, ``2024-01-31`` or ``20240131``, means its first or last second.

    Anything that names no whole day is NULL.
    """
    value = F.regexp_replace(strip(raw), r"^(\d{4})(\d{2})(\d{2})(?!\d)", "$1-$2-$3")
    moment = F.when(strip(raw).rlike(ISO_MOMENT), F.try_to_timestamp(value))
    if is_end:
        last_second = F.expr("INTERVAL 23 HOURS 59 MINUTES 59 SECONDS")
        return F.when(F.length(value) == 10, moment + last_second).otherwise(moment)
    return moment


def channel_key(channel_id: Column) -> Column:
    return F.concat(F.lit("channel:"), channel_id.cast("string"))


def safe_int(value: Column, default: int = 0, minimum: int | None = None) -> Column:
    """Integer form of ``value``, or ``default``; never below ``minimum``."""
    parsed = F.coalesce(strip(value).try_cast("bigint"), F.lit(default))
    return parsed if minimum is None else F.greatest(parsed, F.lit(minimum))


def flag(value: Column) -> Column:
    """0/1 form of a nullable truth value."""
    return F.coalesce(value.cast("boolean"), F.lit(False)).cast("int")


def without_urls(text: Column) -> Column:
    return F.regexp_replace(text, URL_PATTERN, "")
