"""Mixing sources to target weights (DataFrame functions only).

Tokens (words) are summed per source, each source gets a target and a
repetition rate ``target / source size``, and each document is emitted
``floor(rate)`` times plus once more with probability ``rate - floor(rate)``,
decided by a seeded hash of its id, so that reruns agree.

Targets: the sources, sorted by code point with null last, weigh ``weights``
repeating, and share ``budget`` times the total size.  A source's target
stops at ``max_rate`` times its size; what it gives up is shared among the
others by weight until no target is above its stop.  That fixed point has a
closed form: with sources sorted by ``stop / weight``, the first ``k`` are
stopped and the others get ``level * weight``, ``level`` being what is left
over the weight that is left.  It needs one row per source.

Defined cases: a null text has size 0; a null source is a source of its own;
a source of size 0 has target 0 and rate 0; documents of size 0 take part
with their source's rate (and add no words); a null ``doc_id`` is hashed as
the text ``null``; rows with the same id get the same decision; an empty
table gives an empty result.  Extra columns pass through unchanged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.llm.common import col, free_name, materialize

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def unit_hash(key: Column, seed: str) -> Column:
    """A number in [0, 1) from the first 52 bits of md5(seed:key)."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def source_targets(
    sizes: DataFrame,
    weights: Sequence[float] = (5.0, 2.0, 1.0),
    budget: float = 1.5,
    max_rate: float = 2.0,
) -> DataFrame:
    """``(source, source_size, target, rate)`` from ``sizes(source, size)``.

    The windows have no partition: they run over one row per source."""
    if budget > max_rate:
        raise ValueError("the budget cannot exceed the largest repetition rate")
    per = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    w = F.array(*[F.lit(float(x)) for x in weights])
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = (
        per.withColumn("weight", F.element_at(w, (F.pmod(place - 1, len(weights)) + 1).cast("int")))
        .withColumn("stop", F.col("source_size") * F.lit(float(max_rate)))
        .withColumn("ratio", F.col("stop") / F.col("weight"))
    )
    before = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    left = F.sum("source_size").over(every) * F.lit(float(budget)) - F.coalesce(
        F.sum("stop").over(before), F.lit(0.0)
    )
    open_weight = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    per = per.withColumn("level_here", left / open_weight)
    # The level is that of the first source (by ratio) that is not stopped.
    level = F.min(
        F.when(F.col("level_here") <= F.col("ratio"), F.struct("ratio", "level_here"))
    ).over(every)
    per = per.withColumn("level", level["level_here"])
    target = F.when(
        F.col("level").isNull() | (F.col("ratio") <= F.col("level")), F.col("stop")
    ).otherwise(F.col("level") * F.col("weight"))
    per = per.withColumn("target", target)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return per.select("source", "source_size", "target", F.least(rate, F.lit(float(max_rate))).alias("rate"))


def plan_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = (5.0, 2.0, 1.0),
    budget: float = 1.5,
    max_rate: float = 2.0,
    seed: str = "mix-1",
    keep: Sequence[str] | None = None,
) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` (or its columns ``keep``) with each row's size, its source's
    size and target, and the number of copies the mix takes.

    Returns the frame and the names given to the four added columns (they
    differ from the defaults only where ``docs`` has such columns itself).
    Sizes are counted once and, when only few columns are kept, written to
    the shared folder, so that texts are read a single time.
    """
    names = {}
    out = docs
    for n in ("size", "source_size", "target", "copies"):
        names[n] = free_name(docs, n)
    src, rate, join = (free_name(docs, c) for c in ("__source", "__rate", "__none"))
    out = out.withColumn(names["size"], word_count(col(text_col)))
    if keep is not None:
        needed = list(dict.fromkeys([*keep, id_col, source_col]))
        out = materialize(out.select(*[col(c) for c in needed], names["size"]), "sizes")
    per = source_targets(
        out.select(col(source_col).alias("source"), col(names["size"]).alias("size")),
        weights, budget, max_rate,
    )
    # Equality that matches null with null: a null flag beside the value.
    per = per.select(
        F.coalesce("source", F.lit("")).alias(src),
        F.col("source").isNull().alias(join),
        F.col("source_size").alias(names["source_size"]),
        F.col("target").alias(names["target"]),
        F.col("rate").alias(rate),
    )
    out = out.withColumn(src, F.coalesce(col(source_col), F.lit(""))).withColumn(
        join, col(source_col).isNull()
    )
    out = out.join(per, [src, join], "inner")
    whole = F.floor(F.col(rate))
    extra = (unit_hash(col(id_col), seed) < F.col(rate) - whole).cast("long")
    out = out.withColumn(names["copies"], whole + extra).drop(src, join, rate)
    return out, names


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixture: each row of ``docs`` as often as the mix takes it."""
    planned, names = plan_copies(docs, **options)
    again = free_name(planned, "__copy")
    n = F.col(names["copies"])
    return (
        planned.filter(n > 0)
        .withColumn(again, F.explode(F.array_repeat(F.lit(1), n.cast("int"))))
        .select(*[col(c) for c in docs.columns])
    )
