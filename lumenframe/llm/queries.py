"""The queries opN_<name>: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .block_knn import block_knn
from .html_extract import extract_main_text
from .jaccard_join import jaccard_components
from .passage_dedup import repeated_passages
from .piece_codec import PieceModel, encode_pieces
from .quality_gam import quality_scores
from .rule_forest import trained_verdicts
from .source_mix import mix_sources
from .suffix_dedup import suffix_dedup
from .toxicity import toxicity_scores

#: The public vocabulary used by the query; a parameter of the operator.
PIECES = "/opt/tokenizers/piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(_table(spark, sf_dir, "documents"), length=100, with_kept=False).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"
    )


#: Each byte's window of 100, put together by doubling; windows that start earlier; bytes that such a window covers.
OP1_SQL = """
WITH v AS (SELECT doc_id, regexp_extract_all(hex(encode(coalesce(text, ''))), '..') AS v FROM documents),
b AS (SELECT doc_id, unnest(v) AS c, generate_subscripts(v, 1) AS i FROM v),
s2 AS (SELECT doc_id, i, c, c || lead(c) OVER w AS s FROM b WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
s4 AS (SELECT doc_id, i, c, s || lead(s, 2) OVER w AS s FROM s2 WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
s8 AS (SELECT doc_id, i, c, s AS s4, s || lead(s, 4) OVER w AS s FROM s4 WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
s16 AS (SELECT doc_id, i, c, s4, s || lead(s, 8) OVER w AS s FROM s8 WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
s32 AS (SELECT doc_id, i, c, s4, s || lead(s, 16) OVER w AS s FROM s16 WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
s100 AS (SELECT doc_id, i, c, md5_number(s || lead(s, 32) OVER w || lead(s, 64) OVER w || lead(s4, 96) OVER w) AS h FROM s32 WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
f AS (SELECT doc_id, i, c, h IS NOT NULL AND row_number() OVER (PARTITION BY h ORDER BY doc_id, i) > 1 AS again FROM s100),
g AS (SELECT doc_id, i, c, coalesce(bool_or(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 99 PRECEDING AND CURRENT ROW), false) AS gone FROM f),
k AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS begins FROM g),
t AS (SELECT doc_id, count(*) AS n, count(*) FILTER (gone) AS r, count(*) FILTER (begins) AS s, coalesce(string_agg(c, '' ORDER BY i) FILTER (NOT gone), '') AS kept FROM k GROUP BY 1)
SELECT d.doc_id, coalesce(t.n, 0) AS n_bytes, coalesce(t.r, 0) AS n_removed, coalesce(t.s, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256 FROM documents d LEFT JOIN t USING (doc_id)
"""


def op2_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_rule_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trained_verdicts(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_block_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return block_knn(vectors, vectors.filter("vec_id % 20 = 0"), k=20)


OP5_SQL = """
WITH ok AS (
  SELECT DISTINCT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
  FROM ok q JOIN ok c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 20
"""


#: Words, shingles and pairs in full, and the least document that links lead to.
OP3_SQL = r"""
WITH RECURSIVE w AS MATERIALIZED (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS v FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, md5(array_to_string(v[i:i + 4], ' ')) AS h FROM (SELECT doc_id, v, unnest(range(1, len(v) - 3)) AS i FROM w WHERE len(v) >= 5)
  UNION ALL SELECT doc_id, md5('short ' || array_to_string(v, ' ')) FROM w WHERE len(v) BETWEEN 1 AND 4),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS MATERIALIZED (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM s a JOIN s b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY ALL),
e AS MATERIALIZED (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * o >= 75 * (a.n + b.n - o)),
g AS MATERIALIZED (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
r AS (SELECT DISTINCT x AS doc_id, x AS c FROM g UNION SELECT g.y, r.c FROM r JOIN g ON g.x = r.doc_id AND r.c < g.y),
m AS (SELECT doc_id, min(c) AS c FROM r GROUP BY 1)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(coalesce(m.c, w.doc_id), w.doc_id) AS component_id FROM w LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)
"""


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_table(spark, sf_dir, "documents"), k=5, num=3, den=4).select("doc_id", "n_shingles", "component_id")


def op6_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(_table(spark, sf_dir, "documents"), words=50, k=5, num=3, den=4)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_pieces(docs, PieceModel.load(PIECES)).select("doc_id", "n_tokens", "ids", "round_trip")


def op9_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(_table(spark, sf_dir, "pages"))


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


#: Targets, and each document's words among the first ones of its source's shuffled words, gone through twice.
OP10_SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size, CAST('0x' || substr(md5('7|' || doc_id || '|' || coalesce(text, '')), 1, 15) AS BIGINT) AS h FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS sr FROM d GROUP BY 1),
w AS (SELECT *, CAST(CASE sr % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS DOUBLE) AS w FROM s),
c AS (SELECT *, 2::DOUBLE * source_size AS cap, 2::DOUBLE * source_size / w AS ratio, 1.5::DOUBLE * sum(source_size) OVER () AS goal FROM w),
l AS (SELECT *, (goal - coalesce(sum(cap) OVER k, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER k, 0)) AS level FROM c WINDOW k AS (ORDER BY ratio, sr ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, bool_and(level >= ratio) OVER (ORDER BY ratio, sr ROWS UNBOUNDED PRECEDING) AS capped FROM l),
t AS (SELECT source, source_size, CASE WHEN capped THEN cap ELSE least(cap, w * (SELECT level FROM f WHERE NOT capped ORDER BY ratio, sr LIMIT 1)) END AS target FROM f),
o AS (SELECT d.*, t.source_size, target, CAST(floor(target + 0.5) AS BIGINT) AS words, h % (SELECT greatest(16, CAST(floor(sqrt(count(*))) AS BIGINT)) FROM documents) AS sub FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
p AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY sub, h, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a FROM o)
SELECT doc_id, size, source_size, target, CAST(greatest(0, least(size, words - a)) + greatest(0, least(size, words - source_size - a)) AS BIGINT) AS taken FROM p
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_suffix_dedup": op1_suffix_dedup,
        "op2_quality_gam": op2_quality_gam,
        "op3_jaccard_join": op3_jaccard_join,
        "op4_rule_forest": op4_rule_forest,
        "op5_block_knn": op5_block_knn,
        "op6_passage_dedup": op6_passage_dedup,
        "op7_toxicity": op7_toxicity,
        "op8_piece_codec": op8_piece_codec,
        "op9_html_extract": op9_html_extract,
        "op10_source_mix": op10_source_mix,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_suffix_dedup": OP1_SQL.strip(), "op3_jaccard_join": OP3_SQL.strip(), "op5_block_knn": OP5_SQL.strip(), "op10_source_mix": OP10_SQL.strip()}
