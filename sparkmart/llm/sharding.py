"""Sharding by proportional stratified interleaving (law ``rows``).

Within each source the rows are put in a seeded random order (by
md5(seed:id)) and ranked; a row's place in the corpus is its fractional rank
``(rank + 1/2) / rows of the source``.  Sorting by that place interleaves the
sources in proportion, so cutting the order into equal runs gives shards that
all hold the same mixture of sources.  Shard sizes differ by one row at most.

Both rankings are range-partitioned sorts of slim rows with per-partition
offsets (:func:`sparkmart.llm.common.global_index`); no window over a source
and no single task, whatever share of the rows one source has.

Equal texts are not kept together: the law is about row counts.

Defined cases: a null source is a source of its own; a null text has size 8
and a null checksum of the empty text (0); null ids sort last; rows that
repeat an id are ranked one after the other; with fewer rows than shards the
first shards get one row each; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import col, global_index


def interleave_shards(
    rows: DataFrame,
    n_shards: int = 24,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: str = "shard-1",
    extra: Sequence[str] = (),
) -> DataFrame:
    """Assignment of every row to a shard: ``(doc_id, source, size,
    text_crc32, law, shard, slot, grown_shard)`` and the columns ``extra``.

    ``slot`` is the row's place in its shard, from 0 without gaps.
    """
    text = F.coalesce(col(text_col), F.lit(""))
    slim = rows.select(
        col(id_col).alias("doc_id"),
        col(source_col).alias("source"),
        (F.octet_length(text).cast("long") + F.lit(8)).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.md5(
            F.concat(F.lit(seed + ":"), F.coalesce(col(id_col).cast("string"), F.lit("null")))
        ).alias("__u"),
        *[col(c).alias(f"__x_{i}") for i, c in enumerate(extra)],
    )
    within = [
        F.col("source").asc_nulls_last(), F.col("__u"), F.col("doc_id").asc_nulls_last(),
        F.col("text_crc32"), F.col("size"),
    ]
    ranked = global_index(slim, within, "__g")
    per = ranked.groupBy("source").agg(F.count(F.lit(1)).alias("__n"), F.min("__g").alias("__g0"))
    per = per.select(
        F.coalesce("source", F.lit("")).alias("__s"), F.col("source").isNull().alias("__none"),
        "__n", "__g0",
    )
    placed = (
        ranked.withColumn("__s", F.coalesce("source", F.lit("")))
        .withColumn("__none", F.col("source").isNull())
        .join(per, ["__s", "__none"])
        .withColumn("__f", (F.col("__g") - F.col("__g0") + F.lit(0.5)) / F.col("__n"))
        .drop("__s", "__none", "__n", "__g0")
    )
    order = [F.col("__f"), F.col("source").asc_nulls_last(), F.col("__g")]
    cut = global_index(placed, order, "__i")
    rows_in = ranked.count()
    # Runs of base or base + 1 rows; the first `more` shards are the larger.
    base, more = divmod(rows_in, n_shards)
    edge, i = more * (base + 1), F.col("__i")
    after = i - edge  # rows past the larger shards; there are none if base is 0
    out = (
        cut.withColumn(
            "shard",
            F.when(i < edge, F.floor(i / (base + 1)))
            .otherwise(more + F.floor(after / max(base, 1)))
            .cast("int"),
        ).withColumn(
            "slot",
            F.when(i < edge, F.pmod(i, F.lit(base + 1)))
            .otherwise(F.pmod(after, F.lit(max(base, 1))))
            .cast("long"),
        )
    )
    return out.select(
        "doc_id", "source", "size", "text_crc32",
        F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        *[F.col(f"__x_{j}").alias(c) for j, c in enumerate(extra)],
    )
