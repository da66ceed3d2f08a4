"""The registered queries of this subpackage and, where SQL can say it, their SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from hourgrid.llm import (
    bpe,
    decontaminate,
    exact_dedup,
    html_main,
    jaccard_join,
    language_id,
    license_scan,
    quality_pu,
    source_mix,
    toxicity_chain,
    url_filter,
    vector_codes,
    whitening,
)
from hourgrid.llm.frames import ship_code, table

Query = Callable[[SparkSession, str], DataFrame]


def _fold(column: str, parts: int) -> Column:
    """The remainder of the CRC-32 of a column as text."""
    return F.crc32(F.col(column).cast("string")) % parts


URL_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return license_scan.scan(docs, license_scan.train(docs))


def op2_html_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_main.extract_main_text(table(spark, sf_dir, "pages", "page_id", "url", "html"))
    return found.select("page_id", "url", "text", "n_chars", "host_path")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge_urls(table(spark, sf_dir, "pages", "page_id", "url", "html"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "score")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    held_out = F.coalesce(_fold("doc_id", 4) == 2, F.lit(False))
    model = language_id.train(docs.where(_fold("doc_id", 4) != 2))
    return language_id.identify(docs.select("doc_id", "text", held_out.alias("held_out")), model)


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = source_mix.mix_sources(table(spark, sf_dir, "documents", "doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_groups(table(spark, sf_dir, "documents", "doc_id", "text"))


def op7_quality_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels", "doc_id", "quality")
    held_out = F.coalesce(_fold("doc_id", 5) == 0, F.lit(False))
    learn = _fold("doc_id", 5) != 0
    model = quality_pu.train(docs.where(learn), labels.where(learn))
    return quality_pu.score_quality(docs.withColumn("held_out", held_out), model)


def op8_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic")
    held_out = F.coalesce(_fold("doc_id", 5) == 0, F.lit(False))
    learn = _fold("doc_id", 5) != 0
    chain = toxicity_chain.train(docs.where(learn), labels.where(learn))
    return toxicity_chain.score_toxicity(docs.withColumn("held_out", held_out), chain)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents", "doc_id", "text"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = vector_codes.compress(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))
    return coded.select("vec_id", "code", "error", "label_error", "codebooks_sha256", "label")


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    vocabulary = bpe.read_vocabulary(spark, public_tokenizers.path("word_bpe_49k.json"))
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    coded = bpe.decode(bpe.encode(docs, vocabulary).drop("text"), vocabulary)
    listed = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_components(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


OP9_SQL = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
), g AS (
  SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t
)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.t) AS text_sha256
FROM n JOIN g ON n.t = g.t
"""


def _op11_sql() -> str:
    """The rounds one after the other; a part's nearest entry is the least of distance * 16 + entry."""
    assigned = """
a{r} AS MATERIALIZED (
  SELECT rid, q.p, min(list_sum([(q.v[i] - c.v[i]) * (q.v[i] - c.v[i]) FOR i IN range(1, len(q.v) + 1)]) * 16 + c.k) AS m
  FROM parts q JOIN c{r} c ON q.p = c.p GROUP BY rid, q.p
)"""
    moved = """
s{r} AS (
  SELECT q.p, CAST(a.m % 16 AS BIGINT) AS k, i, CAST(sum(q.v[i]) AS BIGINT) AS s, count(*) AS n
  FROM a{r} a JOIN parts q ON a.rid = q.rid AND a.p = q.p, width, unnest(range(1, width.w + 1)) AS u(i) GROUP BY ALL
), c{next} AS MATERIALIZED (
  SELECT c.p, c.k, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN (
    SELECT p, k, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM s{r} GROUP BY p, k
  ) m ON c.p = m.p AND c.k = m.k
)"""
    steps = [part.format(r=r, next=r + 1) for r in range(6) for part in (assigned, moved)] + [assigned.format(r=6)]
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id, label,
    [CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), width AS MATERIALIZED (SELECT max(len(v)) // 8 AS w FROM kept
), parts AS MATERIALIZED (
  SELECT rid, p, v[p * w + 1 : p * w + w] AS v FROM kept, width, unnest(range(8)) AS u(p)
), c0 AS MATERIALIZED (SELECT p, rid - 1 AS k, v FROM parts WHERE rid <= 16
),{",".join(steps)}, books AS (
  SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, k, i)) AS h
  FROM (SELECT p, k, unnest(v) AS x, unnest(range(len(v))) AS i FROM c6)
), coded AS (
  SELECT rid, string_agg(printf('%02x', CAST(m % 16 AS BIGINT)), '' ORDER BY p) AS code, CAST(sum(m // 16) AS BIGINT) AS error
  FROM a6 GROUP BY rid
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  h AS codebooks_sha256, label
FROM kept JOIN coded USING (rid), books
"""


def _with_code(query: Query) -> Query:
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_code(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    named = (
        op1_license_scan,
        op2_html_main,
        op3_url_filter,
        op4_language_id,
        op5_source_mix,
        op6_jaccard_join,
        op7_quality_pu,
        op8_toxicity_chain,
        op9_exact_dedup,
        op10_decontaminate,
        op11_vector_codes,
        op12_bpe,
        op13_whitening,
    )
    return {q.__name__: _with_code(q) for q in named} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {"op9_exact_dedup": OP9_SQL, "op11_vector_codes": _op11_sql()} | (
        {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    )
