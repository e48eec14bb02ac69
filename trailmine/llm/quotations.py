"""Conversations without quotations, in the order of replies, by DataFrame functions only.

A line that begins with ``>`` signs is a quotation of as many levels. Neighbouring lines
of one level are a passage. Passages are normalised (lower case, single blanks) and known
by a SHA-256 digest. The original of a passage is the earliest message of the conversation
that has it as unquoted text: as a whole passage, a paragraph between empty lines, a line or
its whole text. Where a longer quoted passage has no original as a whole, its paragraphs and
then its lines count, of which a single line needs ``MIN_LINE_WORDS`` words.

A message replies to the original of its quotations of the lowest level that has one; of
several the latest one counts, and only earlier messages do. Whole passages count before
paragraphs, and these before single lines.
Following replies back gives the root of a thread and the depth of a message. Ordered by
conversation, root and turn, every message comes after the one it replies to.

Originals are found with a combined minimum for each digest and one equi-join, so that a
passage that thousands of messages quote makes one row each. Roots are found by doubling
the steps back, with every round written to the shared folder.

Null text has no lines; null conversation ids and turns have no links. Messages of equal
conversation and turn stay separate rows; a link leads to their common turn. A message of
quotations alone keeps an empty text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmine.functions.columns import once
from trailmine.storage import materialise

MIN_LINE_WORDS = 3  # of a line cut out of a longer quoted passage
_LEADING = r"^[ \t>]*+"
# Two blanks end the signs. Only single classes are repeated: a repeated group would recurse for
# each sign of a line of thousands.
_BEHIND_SIGNS = r"(^|>)[ \t][ \t].*$"
_RESERVED = ("__passages", "__own", "__lines", "__starts", "__conv", "__turn")
_MARKED = r"(^|[\r\n])[ \t]?>"
_ATTRIBUTION = r"^[ \t]*(On|Am|Le|El)\b.*(wrote|schrieb|écrit|escribió)[ \t]*:[ \t]*$"


def _signs(line: Column) -> Column:
    """The signs of quotation at the beginning of a line, each with a blank before it or none."""
    leading = F.regexp_replace(F.regexp_extract(line, _LEADING, 0), _BEHIND_SIGNS, "$1")
    return F.rtrim(leading, F.lit(" \t"))


def _unmarked(line: Column) -> Column:
    """A line without its signs and one space behind them."""
    size = F.length(_signs(line))
    return F.when(size > 0, F.regexp_replace(F.substr(line, size + 1), "^ ", "")).otherwise(line)


def _level(line: Column) -> Column:
    return F.length(F.translate(_signs(line), " \t", ""))


def _normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[ \t\r\n\f]+", " "))


def _digest(text: Column) -> Column:
    return F.sha2(_normal(text), 256)


def parse_quotations(messages: DataFrame) -> DataFrame:
    """``messages`` with ``__passages``, an array of ``(level, text)``, and ``__own``, the text without quotations.

    A line of attribution ("On ... wrote:") directly before a quotation goes with it.
    """
    lines = F.split(F.regexp_replace("text", "\r\n?", "\n"), "\n", -1)
    parsed = messages.withColumn("__lines", once(F.transform(lines, lambda x: F.struct(
        _level(x).alias("level"), _unmarked(x).alias("text"), x.rlike(_ATTRIBUTION).alias("said")))))
    # Attribution lines take the level of the quotation they stand before.
    parsed = parsed.withColumn("__lines", F.expr("""
        transform(__lines, (x, i) -> named_struct(
            'level', x.level, 'text', x.text,
            'said', x.said and x.level = 0 and coalesce(get(__lines, i + 1).level, 0) > 0))"""))
    parsed = parsed.withColumn("__lines", once(F.expr("filter(__lines, x -> not x.said)")))
    parsed = parsed.withColumn("__starts", F.expr("""
        filter(transform(__lines, (x, i) -> if(i = 0 or x.level <> get(__lines, i - 1).level, i, -1)), i -> i >= 0)"""))
    parsed = parsed.withColumn("__passages", once(F.expr("""
        transform(__starts, (b, k) -> named_struct(
            'level', get(__lines, b).level,
            'text', array_join(transform(slice(__lines, b + 1, coalesce(get(__starts, k + 1), size(__lines)) - b), x -> x.text), '\n')))""")))
    own = F.expr("array_join(transform(filter(__passages, p -> p.level = 0), p -> p.text), '\n')")
    # Line ends at both ends, and more than one empty line, were left by quotations.
    tidy = F.regexp_replace(F.regexp_replace(own, "\n{3,}", "\n\n"), "^\n+|\n+$", "")
    own = F.when(F.expr("exists(__passages, p -> p.level > 0)"), tidy).otherwise(F.col("text"))
    return parsed.withColumn("__own", own).drop("__lines", "__starts")


def _units(passages: Column, least: int = 1) -> Column:
    """Passages (rank 1), their paragraphs (rank 2) and their lines (rank 3), single lines from ``least`` words."""
    whole = F.transform(passages, lambda p: F.struct(F.lit(1).alias("rank"), p["level"].alias("level"), p["text"].alias("text")))
    cut = lambda rank, border: F.flatten(F.transform(passages, lambda p: F.transform(
        F.split(p["text"], border, -1), lambda x: F.struct(F.lit(rank).alias("rank"), p["level"].alias("level"), x.alias("text")))))
    parts = F.concat(cut(2, "\n[ \t\f]*\n"), cut(3, "\n"))
    if least > 1:
        several = lambda u: F.trim(u["text"], F.lit(" \t\n\f")).contains("\n")
        parts = F.filter(parts, lambda u: several(u) | (F.size(F.split(_normal(u["text"]), " ", -1)) >= least))
    return F.filter(F.concat(whole, parts), lambda u: _normal(u["text"]) != "")


def link_quotations(messages: DataFrame) -> DataFrame:
    """``messages`` without quotations, with ``parent_turn``, ``root_turn``, ``depth`` and ``n_quotes``.

    Needs ``conv_id``, ``turn`` and ``text``. ``text`` becomes the unquoted text, and
    ``n_quotes`` counts quoted passages. Columns of the added names are replaced, and those
    of the names in ``_RESERVED`` are left out.
    """
    messages = messages.drop("parent_turn", "root_turn", "depth", "n_quotes", *_RESERVED)
    bare = messages.select("conv_id", "turn", "text")
    marked = F.coalesce(F.col("text").rlike(_MARKED), F.lit(False))
    quoting = parse_quotations(bare.filter(marked)).filter("conv_id is not null and turn is not null")
    quoted = quoting.select(
        "conv_id", "turn", F.explode(_units(F.expr("filter(__passages, p -> p.level > 0)"), MIN_LINE_WORDS)).alias("u"))
    quoted = quoted.select("conv_id", "turn", "u.level", "u.rank", _digest(F.col("u.text")).alias("digest")).distinct()
    said = F.concat(_units(F.expr("filter(__passages, p -> p.level = 0)")),
                    F.array(F.struct(F.lit(1).alias("rank"), F.lit(0).alias("level"), F.col("__own").alias("text"))))
    wanted = quoted.select("conv_id").distinct()
    original = parse_quotations(bare.filter("turn is not null and text is not null").join(wanted, "conv_id", "left_semi")).select(
        "conv_id", "turn", F.explode(said).alias("u"))
    original = original.groupBy("conv_id", _digest(F.col("u.text")).alias("digest")).agg(F.min("turn").alias("said_at"))
    links = quoted.join(original, ["conv_id", "digest"]).filter("said_at < turn")
    # Lower levels before deeper ones, larger units before smaller ones, then the latest original.
    links = links.groupBy("conv_id", "turn").agg(F.max(F.struct(-F.col("level"), -F.col("rank"), "said_at")).alias("best"))
    links = materialise(links.select("conv_id", "turn", F.col("best.said_at").alias("parent_turn")), "quote-links")
    back = _roots(links)
    tables = links.join(back, ["conv_id", "turn"]).select(
        F.col("conv_id").alias("__conv"), F.col("turn").alias("__turn"), "parent_turn", "root_turn", "depth")
    whole = parse_quotations(messages.filter(marked))
    joined = whole.join(tables, (whole["conv_id"] == tables["__conv"]) & (whole["turn"] == tables["__turn"]), "left")
    found = joined.select(
        *(F.col("__own").alias("text") if c == "text" else F.col(c) for c in messages.columns),
        "parent_turn", F.coalesce("root_turn", "turn").alias("root_turn"), F.coalesce("depth", F.lit(0)).alias("depth"),
        F.coalesce(F.expr("size(filter(__passages, p -> p.level > 0))"), F.lit(0)).alias("n_quotes"))
    # Messages without a quotation are left as they are.
    turn = F.col("turn")
    plain = messages.filter(~marked).select(
        "*", F.lit(None).cast(messages.schema["turn"].dataType).alias("parent_turn"), turn.alias("root_turn"),
        F.lit(0).alias("depth"), F.lit(0).alias("n_quotes"))
    return plain.unionByName(found)


def _roots(links: DataFrame) -> DataFrame:
    """``root_turn`` and ``depth`` of each linked message, by doubling the steps back."""
    now = links.select("conv_id", "turn", F.col("parent_turn").alias("root_turn"), F.lit(1).alias("depth"))
    while True:
        ahead = now.select("conv_id", F.col("turn").alias("root_turn"), F.col("root_turn").alias("further"), F.col("depth").alias("more"))
        step = now.join(ahead, ["conv_id", "root_turn"], "left").select(
            "conv_id", "turn", F.coalesce("further", "root_turn").alias("root_turn"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("further").isNotNull().alias("moved"))
        step = materialise(step, "quote-roots")
        if not step.filter("moved").limit(1).count():
            return step.drop("moved")
        now = step.drop("moved")


def reply_ordered(linked: DataFrame) -> DataFrame:
    """Messages sorted so that each follows the one it replies to."""
    return linked.orderBy("conv_id", "root_turn", "turn", "text")
