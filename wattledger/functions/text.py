"""String tests and enum lookups."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from wattledger.schema import SYS_MODE_CODES


def is_blank(text: Column) -> Column:
    """True for empty or whitespace-only text; non-breaking spaces do not count as blank."""
    return text.rlike(r"\A\p{javaWhitespace}*\z")


def enum_code(name: Column, codes: dict[str, int]) -> Column:
    """Number of an enum name; NULL for NULL and for names outside the enum."""
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(codes.items())])
    return F.try_element_at(table, name)


def sys_mode_code(sys_mode: Column, default: Column | int | None = None) -> Column:
    fallback = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(enum_code(sys_mode, SYS_MODE_CODES), fallback.cast("int"))


def sensor_id_or(sensor_id: Column, default: str) -> Column:
    return F.coalesce(sensor_id, F.lit(default))
