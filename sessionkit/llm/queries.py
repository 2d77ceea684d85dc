"""Registered queries of the operators: ``(spark, sf_dir) -> DataFrame``.

Each applies its operator with production parameters to the whole of its
table.  ``ORACLE`` holds DuckDB SQL where SQL can express the result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import language_id, personal_data, quality
from ..session import scratch_path
from .bpe import round_trip
from .centroids import cluster
from .common import read_table, share_package
from .exact_dedup import exact_duplicates
from .html_text import main_text
from .packing import pack
from .simhash import near_duplicates
from .spelling import spelling_variants
from .tokenfile import read_digests, write_token_files
from .topk import top_k
from .url_filter import filter_urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(key: str):
    def deco(fn):
        def query(spark: SparkSession, sf: str) -> DataFrame:
            share_package(spark)
            return fn(spark, sf)
        QUERIES[key] = query
        return query
    return deco


def vocabulary(name: str) -> str:
    """Where a public tokenizer's file lies."""
    import public_tokenizers
    return public_tokenizers.path(name)


def split_pattern() -> str:
    import public_tokenizers
    return public_tokenizers.PATTERN


@register("op1_simhash_near_dedup")
def q_simhash(spark, sf):
    return near_duplicates(read_table(spark, sf, "documents"), radius=3, width=3, seed=42) \
        .select("doc_id", "fingerprint", "component_id")


@register("op2_best_fit_packing")
def q_packing(spark, sf):
    return pack(read_table(spark, sf, "documents"), vocabulary("word_bpe_49k.json"),
                capacity=2048, end_id=0)


@register("op3_byte_bpe")
def q_byte_bpe(spark, sf):
    return round_trip(read_table(spark, sf, "documents"), vocabulary("byte_bpe_50k.tiktoken"),
                      split_pattern())


@register("op4_quality_classifier")
def q_quality(spark, sf):
    docs = read_table(spark, sf, "documents")
    return quality.score(docs, quality.fit(docs, read_table(spark, sf, "labels")))


@register("op5_token_files")
def q_token_files(spark, sf):
    path = scratch_path(spark, "token-files")
    write_token_files(read_table(spark, sf, "documents"), path, vocabulary("byte_bpe_50k.json"),
                      end_id=0)
    return read_digests(spark, path)


@register("op6_exact_dedup")
def q_exact_dedup(spark, sf):
    return exact_duplicates(read_table(spark, sf, "documents"))


ORACLE["op6_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""

# The rules of the query (verdict, host, path).
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


@register("op8_url_filter")
def q_url_filter(spark, sf):
    rules = spark.createDataFrame(URL_RULES, "verdict string, host string, path string")
    return filter_urls(read_table(spark, sf, "pages"), rules)


ORACLE["op8_url_filter"] = """
WITH rules(v, rh, rp) AS (VALUES %s),
rest AS (SELECT page_id, CASE WHEN contains(url, '://') THEN url[strpos(url, '://') + 3:] ELSE '' END AS r
         FROM pages),
parts AS (SELECT row_number() OVER () AS n, page_id,
                 translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
fit AS (SELECT n, max(struct_pack(size := length(rh || rp), rule := rh || rp, verdict := v)) AS best
        FROM parts JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
        GROUP BY n)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict
FROM parts LEFT JOIN fit USING (n)
""" % ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)


@register("op7_html_main_text")
def q_html(spark, sf):
    return main_text(read_table(spark, sf, "pages"))


@register("op9_language_id")
def q_language_id(spark, sf):
    docs = read_table(spark, sf, "documents")
    held = language_id.held_out("doc_id")
    model = language_id.fit(docs.filter(~held), vocabulary("piece_bpe_32k.model"))
    return language_id.identify(docs, model).select(
        "doc_id", held.alias("held_out"), "lang_pred", "score")


@register("op10_exact_top_k")
def q_top_k(spark, sf):
    return top_k(read_table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256.0)


ORACLE["op10_exact_top_k"] = """
WITH v AS (SELECT row_number() OVER () AS n, vec_id,
                  list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
           FROM embeddings
           WHERE embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (SELECT q.n AS qn, q.vec_id AS query_id, c.n, c.vec_id,
             CAST(coalesce(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
      FROM v q JOIN v c ON q.n <> c.n AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY qn ORDER BY score DESC, vec_id, n) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""


@register("op11_spelling_variants")
def q_spelling(spark, sf):
    return spelling_variants(read_table(spark, sf, "documents"), least_length=6, least_count=5,
                             ratio=5, drop_every=199)


@register("op12_personal_data")
def q_personal_data(spark, sf):
    docs = read_table(spark, sf, "documents")
    return personal_data.digests(personal_data.find_personal_data(docs, personal_data.fit(docs)))


@register("op13_centroid_clustering")
def q_centroids(spark, sf):
    return cluster(read_table(spark, sf, "embeddings"), k=40, dim=64, rounds=5, seed="2",
                   scale=256.0)


def _rounds(n: int) -> str:
    """Assignment and new centroids of each round, as common table expressions."""
    away = "list_sum(list_transform(list_zip(v.e, c.e), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    near = """a{r} AS MATERIALIZED (
  SELECT n, arg_min(c, (d, c)) AS c, min(d) AS d
  FROM (SELECT v.n, c.c, %s AS d FROM v CROSS JOIN c{r} c) GROUP BY n)""" % away
    mean = """c{next} AS MATERIALIZED (
  SELECT c.c, coalesce(m.e, c.e) AS e FROM c{r} c LEFT JOIN (
    SELECT c, list((s - ((s % k) + k) % k) // k ORDER BY i) AS e FROM (
      SELECT a.c, i, sum(v.e[i])::BIGINT AS s, count(*) AS k
      FROM a{r} a JOIN v USING (n), range(1, 65) t(i) GROUP BY a.c, i) GROUP BY c) m USING (c))"""
    out = []
    for r in range(n):
        out += [near.replace("{r}", str(r)), mean.replace("{r}", str(r)).replace("{next}", str(r + 1))]
    return ",\n".join([*out, near.replace("{r}", str(n))])


ORACLE["op13_centroid_clustering"] = f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS n, vec_id,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings WHERE len(embedding) = 64
   AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || CAST(vec_id AS VARCHAR)) NULLS LAST, e) - 1 AS c, e
  FROM v QUALIFY c < 40),
{_rounds(5)}
SELECT v.vec_id, CAST(a.c AS INTEGER) AS cluster, a.d::BIGINT AS distance,
       (sum(a.d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia,
       (sum(a.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(f.e, ',')) AS centroid_sha256
FROM a5 a JOIN v USING (n) JOIN c5 f ON f.c = a.c
"""
