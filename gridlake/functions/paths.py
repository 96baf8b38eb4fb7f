"""File names: dates in them, their pieces, and matching."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake import fixed


def base_name(path: Column | str) -> Column:
    return F.element_at(F.split(_col(path), "/"), -1)


def has_extension(path: Column | str, extension: str) -> Column:
    return _col(path).endswith("." + extension.lstrip("."))


def date_from_path(path: Column | str, pattern: str = fixed.DATE_BEFORE_NC) -> Column:
    """The date a file name carries as yyyyMMdd; NULL where there is none."""
    digits = F.regexp_extract(_col(path), pattern, 1)
    return F.to_date(F.try_to_timestamp(digits, F.lit("yyyyMMdd")))


def date_from_offset(path: Column | str, start: int, length: int = 8) -> Column:
    """The date at a fixed 0-based offset of the base name."""
    text = F.substring(base_name(path), start + 1, length)
    return F.to_date(F.try_to_timestamp(text, F.lit("yyyyMMdd")))


def match_names(manifest: DataFrame, patterns: list[str], column: str = "path") -> DataFrame:
    """Files whose base name contains any of the patterns; ``*`` stands for any text."""
    name = base_name(column)
    wanted = [name.like("%" + p.strip("*").replace("*", "%") + "%") for p in patterns]
    return manifest.where(reduce(lambda a, b: a | b, wanted))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
