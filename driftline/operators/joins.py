"""Joins of a large table, possibly with hot keys, to a lookup table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, StringType, StructType

BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 128 * 1024 * 1024


def _bytes(value: Column, kind: DataType) -> Column:
    """About how many bytes a value takes, with the texts inside arrays and structs."""
    if isinstance(kind, (StringType, BinaryType)):
        size = F.octet_length(value)
    elif isinstance(kind, ArrayType):
        if isinstance(kind.elementType, (StringType, BinaryType, ArrayType, StructType)):
            size = F.aggregate(value, F.lit(0).cast("long"), lambda total, entry: total + 8 + _bytes(entry, kind.elementType))
        else:
            size = F.size(value) * 8
    elif isinstance(kind, StructType):
        size = sum((_bytes(value[field.name], field.dataType) for field in kind.fields), F.lit(8))
    else:
        size = F.lit(8)
    return F.coalesce(size.cast("long"), F.lit(0).cast("long"))


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure ``df`` and say whether it may be sent whole to every executor.

    One combinable sum over the table. Pass tables that are stored or staged, as
    the join reads them again.
    """
    width = F.lit(0).cast("long")
    for field in df.schema.fields:
        width = width + _bytes(F.col(field.name), field.dataType)
    rows, total = df.agg(F.count(F.lit(1)), F.sum(width)).first()
    return rows <= max_rows and (total or 0) <= max_bytes


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: str | list[str],
    how: str = "left",
    *,
    salts: int = 8,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
    small: bool | None = None,
    parts: int | None = None,
) -> DataFrame:
    """Join ``facts`` to ``lookup``; a hot key in ``facts`` never lands in one task.

    A lookup table measured to be small is broadcast. Any other is repeated once
    per salt, and each fact row goes to the copy its place picks, so that a
    key with a third of all rows is spread over ``salts`` tasks. A caller that
    joins equally large tables again and again passes its own check in ``small``,
    and one that knows how many rows there are the number of tasks in ``parts``.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if small is None:
        small = fits_broadcast(lookup, max_rows, max_bytes)
    if small:
        return facts.join(F.broadcast(lookup), keys, how)
    # The place of a row in its partition: equal rows are spread as well.
    salted = facts.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
    copies = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    if parts:
        salted, copies = (side.repartition(parts, *keys, "_salt") for side in (salted, copies))
    return salted.join(copies, keys + ["_salt"], how).drop("_salt")
