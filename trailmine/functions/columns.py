"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trailmine.params import TIME_FORMAT


def parse_time(text: Column) -> Column:
    """Timestamp of ``yyyy-MM-dd HH:mm:ss`` text in the session time zone; null if malformed."""
    return F.try_to_timestamp(text, F.lit(TIME_FORMAT))


def epoch_ms(ts: Column) -> Column:
    return F.unix_millis(ts)


def whole_seconds_between(start_ms: Column, end_ms: Column) -> Column:
    """Seconds from start to end with the fraction cut off."""
    return F.call_function("div", end_ms - start_ms, F.lit(1000))


def floor_div(value: Column, width: int) -> Column:
    """Number of the slot of ``width`` that holds ``value``; also right below zero."""
    return F.call_function("div", value - F.pmod(value, F.lit(width)), F.lit(width))


def tab_line(*columns: Column) -> Column:
    """One TAB separated output line; nulls are written as empty fields."""
    return F.concat_ws("\t", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])


def tab_fields(line: Column) -> Column:
    """Fields of a TAB separated line, without the empty ones at its end."""
    return F.split(F.rtrim(line, F.lit("\t")), "\t", -1)


def once(value: Column) -> Column:
    """``value`` as a generated column.

    Spark copies the expression of a plain column into every filter and projection
    above it; a generated one is computed once per row.
    """
    return F.explode(F.array(value))


def field(fields: Column, index: int) -> Column:
    """Field by 0-based index; null if the line is shorter."""
    return F.try_element_at(fields, F.lit(index + 1))
