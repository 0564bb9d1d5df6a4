"""Thin queries over the given tables, one ``opN_<name>`` per operator, and
their DuckDB SQL where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparkmart.adapter import table

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


@query("op4_interleave_shards")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkmart.llm.sharding import interleave_shards

    return interleave_shards(table(spark, sf_dir, "documents"), n_shards=24)


OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
              WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
         source_size * 2.0::DOUBLE AS stop FROM per),
r AS (SELECT *, stop / weight AS ratio FROM w),
lv AS (
  SELECT *, ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE
     - coalesce(sum(stop) OVER (ORDER BY ratio, source NULLS LAST
                                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY ratio, source NULLS LAST
                                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS here
  FROM r),
t AS (
  SELECT source, source_size, stop, ratio, weight,
         (SELECT arg_min(here, ratio) FROM lv WHERE here <= ratio) AS level FROM lv),
g AS (
  SELECT source, source_size,
         CASE WHEN level IS NULL OR ratio <= level THEN stop ELSE level * weight END AS target
  FROM t),
rt AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(target / source_size, 2.0::DOUBLE) ELSE 0 END AS rate
  FROM g)
SELECT d.doc_id, d.size, rt.source_size, rt.target,
       ((floor(rate)::BIGINT + CASE WHEN
          ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE
            / 4503599627370496.0::DOUBLE < rate - floor(rate) THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM d JOIN rt ON d.source IS NOT DISTINCT FROM rt.source
"""


@query("op6_mix_sources", OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkmart.llm.mixing import plan_copies

    docs = table(spark, sf_dir, "documents")
    planned, _ = plan_copies(docs, keep=["doc_id", "source"])
    return planned.selectExpr("doc_id", "size", "source_size", "target", "copies * size AS taken")


@query("op8_bpe_token_counts")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from sparkmart.llm.token_counts import count_tokens

    docs = table(spark, sf_dir, "documents").selectExpr(
        "doc_id", "text", "coalesce(octet_length(text), 0)::bigint AS n_bytes"
    )
    counted = count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return counted.selectExpr("doc_id", "n_bytes", "n_tokens", "n_tokens > 1024 AS over_limit")


@query("op9_pigeonhole_decontamination")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and benchmark item found in it (best match)."""
    from sparkmart.llm.decontaminate import find_leaks

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found, name = find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return found.selectExpr("doc_id", f"inline({name})")


@query("op10_nnpu_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from sparkmart.llm.toxicity import held_out, score, train

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


OP5_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (
  SELECT *, CASE WHEN payload_bytes >= 100
                 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first
  FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first IS NOT NULL AND first IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response'
       END AS record_type,
       CASE WHEN first IS DISTINCT FROM page_id THEN first END AS refers_to
FROM f
"""


@query("op5_warc_normaliser", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from sparkmart.llm.warc import archive_pages, page_of

    records = archive_pages(table(spark, sf_dir, "pages"), with_payload=False)
    return records.select(
        page_of(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page_of(F.col("refers_to")).alias("refers_to"),
    )


@query("op7_hyperminhash_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkmart.llm.near_dedup import near_duplicates

    docs = table(spark, sf_dir, "documents")
    found = near_duplicates(docs, k=4, threshold=80)
    return found.selectExpr("id AS doc_id", "n_shingles", "component AS component_id", "kept")


OP1_SQL = r"""
WITH RECURSIVE m AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text,
         lower(trim(regexp_replace(coalesce(text, ''), '[ \t\n\x0B\f\r]+', ' ', 'g'))) AS whole,
         list_transform(string_split(coalesce(text, ''), chr(10)), lambda x:
           lower(trim(regexp_replace(x, '[ \t\n\x0B\f\r]+', ' ', 'g')))) AS lines
  FROM conversations),
p AS (
  SELECT m.conv_id, m.turn, min(o.turn) AS parent_turn
  FROM m JOIN m AS q ON q.conv_id = m.conv_id AND q.turn = m.turn - 1 AND q.whole <> ''
         JOIN m AS o ON o.conv_id = m.conv_id AND o.turn < m.turn
                    AND (o.whole = q.whole OR list_contains(o.lines, q.whole))
  GROUP BY m.conv_id, m.turn),
n AS (
  SELECT m.*, p.parent_turn,
         (SELECT count(*) FROM m AS q WHERE q.conv_id = m.conv_id AND q.whole <> ''
            AND q.turn IN (m.turn - 1, m.turn - 2))::INTEGER AS n_quoted
  FROM m LEFT JOIN p ON p.conv_id = m.conv_id AND p.turn = m.turn),
t AS (
  SELECT conv_id, turn, turn AS root_turn, 0 AS depth FROM n WHERE parent_turn IS NULL
  UNION ALL
  SELECT n.conv_id, n.turn, t.root_turn, t.depth + 1
  FROM n JOIN t ON n.conv_id = t.conv_id AND n.parent_turn = t.turn)
SELECT n.conv_id, n.turn, n.role, n.parent_turn, t.root_turn, t.depth::INTEGER AS depth,
       row_number() OVER (PARTITION BY n.conv_id ORDER BY t.root_turn, n.turn) - 1 AS position,
       n.n_quoted, n.n_quoted AS n_linked, n.text
FROM n JOIN t ON n.conv_id = t.conv_id AND n.turn = t.turn
"""


@query("op1_quotation_linking", OP1_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations, sent as replies that quote the two turns before
    (the table itself holds no quotes), linked and put back in order."""
    from sparkmart.llm.quotations import link_quotations, with_quotes

    return link_quotations(with_quotes(table(spark, sf_dir, "conversations")))


@query("op2_collision_counting_knn")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkmart.llm.collision_ann import collision_knn

    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return collision_knn(rows, rows.filter("vec_id % 100 = 0"), k=10)


@query("op3_collinear_passages")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per pair of documents and passage that both hold."""
    from sparkmart.llm.chaining import repeated_passages

    found = repeated_passages(table(spark, sf_dir, "documents"), min_words=50, min_identity=0.8)
    return found.selectExpr(
        "doc AS doc_id", "other AS match_doc_id", "x0 AS start_word", "x1 AS end_word",
        "y0 AS match_start", "y1 AS match_end", "distance", "identity", "class_id",
    )


@query("op11_pfor_tokens")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from sparkmart.llm.pfor_tokens import read_tokens, write_tokens
    from sparkmart.session import scratch_path

    written = write_tokens(
        table(spark, sf_dir, "documents"), scratch_path(spark, "pfor"),
        public_tokenizers.path("byte_bpe_50k.json"), end_id=2,
    )
    return read_tokens(written).selectExpr(
        "doc_id", "start", "bigint(octet_length(ids) div 4) AS n_tokens", "crc32(ids) AS ids_crc32"
    )


OP12_SQL = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, o.vec_id AS other_id, a.label = o.label AS same,
         list_inner_product(a.v, o.v)::BIGINT AS score
  FROM r AS a JOIN r AS o ON o.vec_id <> a.vec_id AND len(o.v) = len(a.v)
  WHERE a.vec_id % 50 = 0),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score
  FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       (row_number() OVER (PARTITION BY p.anchor_id, p.positive_id
                           ORDER BY s.score DESC, s.other_id))::INTEGER AS rank,
       s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY rank <= 3
"""


@query("op12_rtree_hard_negatives", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkmart.llm.rtree_negatives import hard_negatives

    rows = table(spark, sf_dir, "embeddings").selectExpr(
        "vec_id", "CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label", "embedding"
    )
    return hard_negatives(rows, rows.filter("vec_id % 50 = 0"))


#: One tenth of the documents get a periodic end: word i >= a becomes word
#: a + (i - a) % p, where a and p follow from the id's checksum.
PLANT = """
CASE WHEN h % 10 = 0 AND size(w) > 0 THEN array_join(transform(sequence(0, size(w) - 1), i ->
       w[int(CASE WHEN i < a THEN i ELSE a + (i - a) % p END)]), ' ')
     ELSE text END
"""


@query("op13_periodic_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkmart.llm.periodic_runs import periodic_runs

    docs = table(spark, sf_dir, "documents").selectExpr(
        "doc_id", "text", "crc32(encode(string(doc_id), 'UTF-8')) AS h"
    )
    docs = (
        docs.selectExpr(
            "*", "h div 10 AS g",
            r"CASE WHEN h % 10 = 0 THEN regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0) END AS w",
        )
        .selectExpr("*", "CASE WHEN size(w) > 0 THEN g % size(w) END AS a")
        .selectExpr("*", "1 + (size(w) - a) div (3 + g % 8) AS p")
        .selectExpr("doc_id", f"{PLANT} AS text")
    )
    # Longer exponents first, by cross products; then start, then period.
    best = """array_sort(runs, (x, y) -> CASE
        WHEN x.length * y.period <> y.length * x.period
        THEN IF(x.length * y.period > y.length * x.period, -1, 1)
        WHEN x.start <> y.start THEN IF(x.start < y.start, -1, 1)
        ELSE int(sign(x.period - y.period)) END)"""
    lines = "transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n'))"
    return periodic_runs(docs).selectExpr("*", f"get({best}, 0) AS top").selectExpr(
        "doc_id",
        "bigint(size(runs)) AS n_runs",
        "top.start", "top.length", "top.period",
        "1000 * top.length div top.period AS exponent_milli",
        f"sha2(array_join({lines}, ''), 256) AS runs_sha256",
        "sha2(collapsed, 256) AS collapsed_sha256",
    )
