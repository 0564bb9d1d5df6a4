"""Quotation linking for chats and mail (DataFrame functions only).

Messages quote others by lines that begin with ``>``, once for each level.
Each message is parsed into runs of lines of one level; the runs of level 0
are its own text.  Quoted runs are normalised (white space collapsed, lower
case) and hashed, and joined on (conversation, hash) to the earliest message
whose own text has that passage: the whole text, a run or a line of it.  A
run that is not found whole is looked up by its lines.  A message's parent is
the original that most of its outermost linked quotes come from; parents give
each message its thread root and depth, and a conversation is put in reply
order: thread by thread, every message after its parent, without the quotes.

Per (conversation, hash) there is one original (combined map-side), so a line
that very many messages repeat joins one row; no window and no collected list
spans a conversation, whatever its length.

Defined cases: a null text is empty; blank quotes link nothing; a line that
announces a quote ("On ... wrote:") right above it belongs to the quote; a
quote of a message that does not come earlier is not linked; messages with a
null conversation or turn stand alone at depth 0; messages that repeat a
(conversation, turn) are all kept and share their parent; quotes of either
count for both; an empty table gives an empty result.  Extra columns are left
out of the result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import col, global_index, materialize

# The ways a mail program announces a quote, by language.
ANNOUNCES = r"(?i)^\s*(on|am|le|el)\b.{0,200}\b(wrote|schrieb|a écrit|escribió)\b.{0,80}:\s*$"
PREFIX = r"^(?: {0,3}>)+ ?"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, evaluated once (a lambda variable)."""
    return F.transform(F.array(value), body)[0]


def normalised(text: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(text, r"[ \t\n\x0B\f\r]+", " ")))


def runs(text: Column) -> Column:
    """Array of ``(level, passage)``: the text's runs of lines of one level."""

    def line(x: Column) -> Column:
        return let(
            F.regexp_extract(x, PREFIX, 0),
            lambda p: F.struct(
                F.length(F.regexp_replace(p, "[^>]", "")).alias("level"),
                F.substr(x, F.length(p) + 1).alias("body"),
            ),
        )

    def announced(lines: Column) -> Column:
        return F.transform(
            lines,
            lambda x, i: F.struct(
                F.when(
                    (x["level"] == 0)
                    & x["body"].rlike(ANNOUNCES)
                    & (F.coalesce(F.get(lines, i + 1)["level"], F.lit(0)) > 0),
                    F.lit(-1),
                )
                .otherwise(x["level"])
                .alias("level"),
                x["body"].alias("body"),
            ),
        )

    def cut(lines: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(lines) - 1)
        starts = F.filter(
            places,
            lambda i: (i == 0) | (F.get(lines, i)["level"] != F.coalesce(F.get(lines, i - 1)["level"], F.lit(-9))),
        )
        return let(
            starts,
            lambda s: F.transform(
                s,
                lambda a, k: F.struct(
                    F.get(lines, a)["level"].alias("level"),
                    F.array_join(
                        F.transform(
                            F.slice(lines, a + 1, F.coalesce(F.get(s, k + 1), F.size(lines)) - a),
                            lambda x: x["body"],
                        ),
                        "\n",
                    ).alias("passage"),
                ),
            ),
        )

    lines = F.transform(F.split(text, "\n"), line)
    return let(lines, lambda x: let(announced(x), cut))


def _digest(text: Column) -> Column:
    return F.sha2(text, 256)


def link_quotations(
    messages: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """``(conv_id, turn, role, parent_turn, root_turn, depth, position,
    n_quoted, n_linked, text)``: one row per message, with its own text."""
    parsed = messages.select(
        col(conv_col).alias("conv_id"), col(turn_col).alias("turn"), col(role_col).alias("role"),
        runs(F.coalesce(col(text_col), F.lit(""))).alias("runs"),
    )
    own = F.transform(F.filter("runs", lambda r: r["level"] == 0), lambda r: r["passage"])
    parsed = parsed.select(
        "conv_id", "turn", "role", own.alias("own"),
        F.array_join(own, "\n").alias("text"),
        F.filter("runs", lambda r: (r["level"] > 0) & (normalised(r["passage"]) != "")).alias("quoted"),
    )
    parsed = materialize(parsed, "messages")

    lines = lambda t: F.split(t, "\n")
    units = F.concat(F.array("text"), F.col("own"), lines(F.col("text")))
    hashes = F.array_distinct(
        F.transform(F.filter(F.transform(units, normalised), lambda x: x != ""), _digest)
    )
    originals = (
        parsed.select("conv_id", "turn", F.explode(hashes).alias("hash"))
        .groupBy("conv_id", "hash").agg(F.min("turn").alias("target"))
    )
    quotes = parsed.select("conv_id", "turn", F.posexplode("quoted").alias("run", "q"))
    pieces = F.filter(
        F.transform(F.concat(F.array("q.passage"), lines(F.col("q.passage"))), normalised),
        lambda x: x != "",
    )
    wanted = quotes.select(
        "conv_id", "turn", "run", F.col("q.level").alias("level"),
        F.explode(F.array_distinct(pieces)).alias("piece"),
    ).select("conv_id", "turn", "run", "level", _digest(F.col("piece")).alias("hash"), F.length("piece").alias("weight"))
    links = materialize(
        wanted.join(originals, ["conv_id", "hash"]).filter("target < turn")
        .groupBy("conv_id", "turn", "run", "level", "target")
        .agg(F.sum("weight").alias("weight")),
        "links",
    )
    # The outermost level that is linked decides; within it the most text, then the latest.
    best = (
        links.groupBy("conv_id", "turn", "level", "target").agg(F.sum("weight").alias("weight"))
        .groupBy("conv_id", "turn")
        .agg(F.max(F.struct((-F.col("level")).alias("l"), "weight", "target")).alias("b"))
        .select("conv_id", "turn", F.col("b.target").alias("parent_turn"))
    )
    n_linked = links.groupBy("conv_id", "turn").agg(F.countDistinct("run").alias("n_linked"))
    tree = thread_roots(parsed.select("conv_id", "turn"), best)
    rows = (
        parsed.select("conv_id", "turn", "role", "text", F.size("quoted").alias("n_quoted"))
        .join(tree, ["conv_id", "turn"], "left")
        .join(n_linked, ["conv_id", "turn"], "left")
        .withColumn("root_turn", F.coalesce("root_turn", "turn"))
        .withColumn("depth", F.coalesce("depth", F.lit(0)))
        .withColumn("n_linked", F.coalesce("n_linked", F.lit(0)))
    )
    order = [
        F.col("conv_id").asc_nulls_last(), F.col("root_turn").asc_nulls_last(),
        F.col("turn").asc_nulls_last(), F.col("role"), F.xxhash64("text"), F.col("text"),
    ]
    placed = global_index(rows, order, "__at")
    first = placed.groupBy("conv_id").agg(F.min("__at").alias("__first"))
    first = first.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("__c"),
        F.col("conv_id").isNull().alias("__none"), "__first",
    )
    placed = placed.withColumn("__c", F.coalesce(F.col("conv_id").cast("string"), F.lit(""))).withColumn(
        "__none", F.col("conv_id").isNull()
    )
    return placed.join(first, ["__c", "__none"]).select(
        "conv_id", "turn", "role", "parent_turn", "root_turn", "depth",
        (F.col("__at") - F.col("__first")).alias("position"), "n_quoted",
        F.col("n_linked").cast("int").alias("n_linked"), "text",
    )


def thread_roots(messages: DataFrame, parents: DataFrame) -> DataFrame:
    """``(conv_id, turn, parent_turn, root_turn, depth)`` by pointer jumping:
    every round doubles the distance covered, on rows without texts."""
    nodes = (
        messages.filter("conv_id IS NOT NULL AND turn IS NOT NULL").distinct()
        .join(parents, ["conv_id", "turn"], "left")
        .select(
            "conv_id", "turn", "parent_turn", F.coalesce("parent_turn", "turn").alias("root_turn"),
            F.col("parent_turn").isNotNull().cast("int").alias("depth"),
        )
    )
    nodes = materialize(nodes, "threads")
    while True:
        up = nodes.filter("depth > 0").select(
            "conv_id", F.col("turn").alias("root_turn"), F.col("root_turn").alias("__up"),
            F.col("depth").alias("__more"),
        )
        step = nodes.join(up, ["conv_id", "root_turn"], "left").select(
            "conv_id", "turn", "parent_turn", F.coalesce("__up", "root_turn").alias("root_turn"),
            (F.col("depth") + F.coalesce("__more", F.lit(0))).alias("depth"),
            F.col("__more").isNotNull().alias("__moved"),
        )
        step = materialize(step, "threads")  # the join runs once; both reads below are of files
        nodes = step.drop("__moved")
        if step.filter("__moved").isEmpty():
            return nodes


def with_quotes(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", text_col: str = "text") -> DataFrame:
    """``messages`` as a mail program would send them: each text below a
    quote of the previous turn, itself below a quote of the turn before."""
    rows = messages.withColumn(text_col, F.coalesce(col(text_col), F.lit("")))

    def earlier(back: int, marks: str) -> DataFrame:
        quote = F.regexp_replace(col(text_col), r"(?dm)^", marks)
        return rows.filter(F.trim(normalised(col(text_col))) != "").groupBy(
            col(conv_col).alias("__c"), (col(turn_col) + back).alias("__t")
        ).agg(F.min(quote).alias(f"__q{back}"))

    key = lambda df: [col(conv_col) == df["__c"], col(turn_col) == df["__t"]]
    q2, q1 = earlier(2, "> > "), earlier(1, "> ")
    out = rows.join(q2, key(q2), "left").drop("__c", "__t").join(q1, key(q1), "left").drop("__c", "__t")
    text = F.concat_ws("\n", "__q2", "__q1", col(text_col))
    return out.withColumn(text_col, text).select(*[col(c) for c in messages.columns])
