"""Raw search logs: TAB separated ``user, query, time, rank, url`` lines."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trailmine.functions.columns import epoch_ms, field, once, parse_time, tab_fields
from trailmine.params import BOT_USERS, EMPTY_QUERY
from trailmine.storage import materialise

_URL_FIELD = 4
_FULL_LINE = 5
_INTEGER = r"^[+-]?[0-9]+$"


def _typed(lines: DataFrame) -> DataFrame:
    """All lines with their typed fields; a field that is missing or malformed is null."""
    f = F.col("fields")
    user = field(f, 0)
    clicked = F.when(F.size(f) == _FULL_LINE, field(f, _URL_FIELD)).otherwise(F.lit(""))
    typed = F.struct(
        F.when(user.rlike(_INTEGER), user.try_cast("bigint")).alias("user_id"),
        field(f, 1).alias("query"),
        parse_time(field(f, 2)).alias("ts"),
        clicked.alias("doc"),
    )
    return (
        lines.select("*", once(tab_fields(F.col("value"))).alias("fields"))
        .select(*lines.columns, once(typed).alias("typed"))
        .select(*lines.columns, "typed.*")
    )


class LogFiles(NamedTuple):
    """What text files hold: log rows, and the malformed lines (``value``)."""

    rows: DataFrame
    rejected: DataFrame


def _without_bots(rows: DataFrame, bot_users: Sequence[int] | DataFrame) -> DataFrame:
    """Rows of other users than bots, and all without a user or without a query.

    A table of bots may have any size: Spark picks the join by it.
    """
    has_query = F.col("query").isNotNull()
    if isinstance(bot_users, DataFrame):
        bots = bot_users.select(F.col("user_id").cast("bigint").alias("bot"))
        return rows.join(bots, (F.col("user_id") == F.col("bot")) & has_query, "left_anti")
    return rows.filter(~(has_query & _is_bot(bot_users)))


def _is_bot(bot_users: Sequence[int]) -> Column:
    return F.coalesce(F.col("user_id").isin(list(bot_users)), F.lit(False)) if bot_users else F.lit(False)


def _is_malformed() -> Column:
    """Of typed lines; bots with a malformed time are malformed here too."""
    incomplete = F.col("user_id").isNull() | F.col("ts").isNull()
    return F.col("query").isNull() | ((F.col("query") != EMPTY_QUERY) & incomplete)


def parse_log_lines(
    lines: DataFrame, bot_users: Sequence[int] | DataFrame = BOT_USERS, seq: str | None = None
) -> DataFrame:
    """Log rows from a ``value`` column of lines.

    Empty queries (``-``), bot users and malformed lines are left out. Bot users are a few
    numbers, or the column ``user_id`` of a table, here and in the readers of files. ``seq``
    names a column that orders the lines; without it their place in the frame is used.
    :func:`read_query_log` orders the lines of files.
    """
    position = F.col(seq).cast("bigint") if seq else F.monotonically_increasing_id()
    typed = (
        _typed(lines.withColumn("seq", position))
        .filter(F.col("query") != EMPTY_QUERY)
        .filter(F.col("user_id").isNotNull() & F.col("ts").isNotNull())
    )
    return _without_bots(typed, bot_users).select(
        "user_id", "ts", epoch_ms(F.col("ts")).alias("ts_ms"), "seq", "query", "doc"
    )


def rejected_lines(lines: DataFrame, bot_users: Sequence[int] | DataFrame = BOT_USERS) -> DataFrame:
    """The malformed lines: no query field, user not a number, or time missing or malformed.

    Lines that are left out on purpose (empty query, bot user) are not malformed.
    """
    return _without_bots(_typed(lines).filter(_is_malformed()), bot_users).select(*lines.columns)


def read_log_files(
    spark: SparkSession, path: str, bot_users: Sequence[int] | DataFrame = BOT_USERS
) -> LogFiles:
    """Log rows and malformed lines of text files; times are read in the session time zone.

    The text is read and parsed once for both, and what it holds is written to the shared
    folder. ``seq`` numbers all lines by the name of their file and their place in it,
    however the files are cut into splits.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
    )
    typed = _typed(lines)
    kept = (F.col("query") != EMPTY_QUERY) & F.col("user_id").isNotNull() & F.col("ts").isNotNull()
    # Lines that are left out keep their place, so they are written too, without content.
    row = F.when(kept, F.struct("user_id", "ts", epoch_ms(F.col("ts")).alias("ts_ms"), "query", "doc"))
    bad = F.when(_is_malformed(), F.struct("value", "user_id", "query"))
    rows = materialise(typed.select("file", "block", "place", row.alias("row"), bad.alias("bad")), "log-rows")
    of_split = rows.groupBy("file", "block").agg(F.min("place").alias("first"), F.count("*").alias("lines"))
    # One row per split of the files.
    before = F.sum("lines").over(Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1))
    offsets = materialise(of_split.withColumn("offset", F.coalesce(before, F.lit(0))), "log-splits")
    seq = F.col("offset") + F.col("place") - F.col("first")
    numbered = (
        rows.filter(F.col("row").isNotNull())
        .join(offsets, ["file", "block"])
        .select("row.user_id", "row.ts", "row.ts_ms", seq.alias("seq"), "row.query", "row.doc")
    )
    rejected = _without_bots(rows.filter(F.col("bad").isNotNull()).select("bad.*"), bot_users)
    return LogFiles(_without_bots(numbered, bot_users), rejected.select("value"))


def read_query_log(
    spark: SparkSession, path: str, bot_users: Sequence[int] | DataFrame = BOT_USERS
) -> DataFrame:
    """The log rows of :func:`read_log_files`."""
    return read_log_files(spark, path, bot_users).rows


def rejected_rows(
    spark: SparkSession, path: str, bot_users: Sequence[int] | DataFrame = BOT_USERS
) -> DataFrame:
    """The malformed lines of text files alone; nothing is written down for them."""
    return rejected_lines(spark.read.text(path), bot_users)


def split_log_fields(lines: DataFrame) -> DataFrame:
    """Untyped fields of all lines with a non-empty query; missing fields are null."""
    f = F.col("fields")
    names = ("user_id", "query", "time", "rank", "url")
    return (
        lines.select(once(tab_fields(F.col("value"))).alias("fields"))
        .filter(field(f, 1) != EMPTY_QUERY)
        .select(*[field(f, i).alias(name) for i, name in enumerate(names)])
    )


def read_log_fields(spark: SparkSession, path: str) -> DataFrame:
    """Untyped fields of text files, the input of the field count job."""
    return split_log_fields(spark.read.text(path))
