"""Names, dates and durations as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quarter(date_path: Column) -> Column:
    """The quarter of a dated path by its month and day; what is not listed is the third."""
    return F.when(date_path.contains("07/01"), "Q3").when(date_path.contains("10/01"), "Q4").when(date_path.contains("04/01"), "Q2").when(date_path.contains("01/01"), "Q1").otherwise("Q3")


def year(date_path: Column) -> Column:
    return F.split_part(date_path, F.lit("/"), F.lit(1))


def folder(prefix: str, date_path: Column, unit: Column) -> Column:
    return F.concat_ws("_", F.lit(prefix), year(date_path), quarter(date_path), unit)


def folder_parts(name: Column) -> Column:
    """struct(code, unit) of a folder name: its fifth part, and parts five to seven; null where there are fewer."""
    parts = F.split(name, "_")
    return F.struct(
        F.when(F.size(parts) >= 5, F.element_at(parts, 5)).alias("code"),
        F.when(F.size(parts) >= 7, F.array_join(F.slice(parts, 5, 3), "_")).alias("unit"),
    )


def cache_name(name: Column) -> Column:
    """A folder name without its first four parts."""
    parts = F.split(name, "_")
    return F.array_join(F.slice(parts, 5, F.greatest(F.size(parts) - 4, F.lit(0))), "_")


def namespace(path: Column, default_stem: str = "output") -> Column:
    """The stem of a path, and eight digits of the path's digest."""
    base = F.regexp_extract(path, "([^/]*)$", 1)
    stem = F.regexp_replace(base, r"(?<=.)\.[^.]*$", "")
    return F.concat(F.when(stem == "", F.lit(default_stem)).otherwise(stem), F.lit("_"), F.substring(F.sha2(path, 256), 1, 8))


def eta(seconds: Column) -> Column:
    """``1h 02m 03s``, ``2m 03s`` or ``3s``; null is still being calculated."""
    s = F.floor(seconds).cast("long")
    h, m, r = F.floor(s / 3600).cast("long"), F.floor(s % 3600 / 60).cast("long"), s % 60
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    return (
        F.when(s.isNull(), "calculating")
        .when(h > 0, F.concat(h.cast("string"), F.lit("h "), two(m), F.lit("m "), two(r), F.lit("s")))
        .when(m > 0, F.concat(m.cast("string"), F.lit("m "), two(r), F.lit("s")))
        .otherwise(F.concat(r.cast("string"), F.lit("s")))
    )
