"""Other tables seen as a search log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmine.functions.columns import epoch_ms
from trailmine.params import BOT_USERS, EMPTY_QUERY, TIME_FORMAT

CLICK_EVENTS = ("click", "purchase")


def events_as_log(events: DataFrame, buckets: int = 10) -> DataFrame:
    """The ``events`` table as a log.

    The query is the event type with the ``k`` property modulo ``buckets``; click
    and purchase events visit the document ``d<k>``. The event id breaks time ties.
    """
    k = F.get_json_object("props", "$.k").cast("bigint")
    # The table holds wall-clock times; they are read as UTC in every session zone.
    ts = F.from_utc_timestamp(F.col("ts").cast("timestamp"), F.current_timezone())
    return events.select(
        "user_id",
        ts.alias("ts"),
        epoch_ms(ts).alias("ts_ms"),
        F.col("event_id").alias("seq"),
        F.concat_ws("_", "event_type", k % buckets).alias("query"),
        F.when(F.col("event_type").isin(*CLICK_EVENTS), F.concat(F.lit("d"), k.cast("string")))
        .otherwise(F.lit(""))
        .alias("doc"),
    )


def events_as_lines(events: DataFrame) -> DataFrame:
    """The ``events`` table as raw log lines (``value``) with their order (``seq``).

    The ``k`` property decides which lines are unusual: lines without a query,
    with text in place of user or time, with the empty query, of the bot user, or
    with additional TABs at the end.
    """
    k = F.get_json_object("props", "$.k").cast("bigint")
    clicked = F.col("event_type").isin(*CLICK_EVENTS)

    def odd(low: int, value: Column, otherwise: Column) -> Column:
        return F.when(k.between(low, low + 4), value).otherwise(otherwise)

    user = F.col("user_id").cast("string")
    user = odd(0, F.concat(F.lit("u"), user), odd(5, F.lit(str(BOT_USERS[0])), user))
    query = odd(10, F.lit(EMPTY_QUERY), F.concat_ws(" ", "event_type", (k % 10).cast("string")))
    time = odd(15, F.lit("yesterday"), F.date_format("ts", TIME_FORMAT))
    rank = F.when(clicked, k.cast("string")).otherwise(F.lit(""))
    url = F.when(clicked, F.concat(F.lit("http://site/"), k.cast("string"))).otherwise(F.lit(""))
    tail = odd(20, F.lit("\t\t"), F.lit(""))
    line = F.concat(F.concat_ws("\t", user, query, time, rank, url), tail)
    return events.select(odd(25, user, line).alias("value"), F.col("event_id").alias("seq"))
