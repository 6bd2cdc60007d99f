"""The registered queries of this subpackage: thin, over whole tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .clustering import cluster
from .common import ROW, table
from .exact_dedup import dedup_decisions
from .language import identify
from .line_dedup import line_dedup
from .mixing import taken
from .ngram_join import join
from .open_bins import pack_open
from .packing import pack
from .quality import judge
from .quotes import link_quotes
from .resampling import resample
from .token_files import token_files
from .toxicity import toxicity


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_decisions(table(spark, sf_dir, "documents")).drop(ROW)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0, with_ids=False)


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_removed_lines", F.length("text").cast("long").alias("n_chars_left"),
                          F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2, with_ids=False)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def with_quotes(conversations: DataFrame) -> DataFrame:
    """The conversations with quotations put in, of which the given ones have none: a third of the
    messages, by their keys, quote the message before them, every other one of those wrapped anew."""
    before = conversations.groupBy("conv_id", (F.col("turn") + 1).alias("turn")).agg(F.min("text").alias("_before_"))
    key = F.col("conv_id") + F.col("turn")
    quoted = F.regexp_replace(F.when(key % 2 == 0, F.col("_before_")).otherwise(F.regexp_replace("_before_", r"\s+", " ")), r"(?m)^", "> ")
    text = F.when((key % 3 == 0) & F.col("_before_").isNotNull(), F.concat(quoted, F.lit("\n"), F.coalesce("text", F.lit("")))).otherwise(F.col("text"))
    return conversations.join(before, ["conv_id", "turn"], "left").select("conv_id", "turn", "role", text.alias("text"))


def op10_quote_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = link_quotes(with_quotes(table(spark, sf_dir, "conversations")))
    return linked.select("conv_id", "turn", "role", "reply_to", "parent", "depth", "position", "n_quoted", "n_linked",
                         F.sha2("formatted", 256).alias("formatted_sha256"))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cluster(table(spark, sf_dir, "embeddings"), k=8, dims=64, rounds=10, scale=1024, seed="3")
    own = found.clusters.select("cluster", F.col("inertia").alias("cluster_inertia"), "centroid_sha256")
    return found.vectors.join(F.broadcast(own), "cluster").select(  # k rows
        "vec_id", "cluster", "distance", "cluster_inertia", F.lit(found.inertia).cast("long").alias("inertia"), "centroid_sha256")


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"),
                     n=1, buckets=10_000, seed="2024", least_words=20, percent=10)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_open(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2, length=1024, with_ids=False)


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_mixing": op2_mixing,
    "op3_quality": op3_quality,
    "op4_packing": op4_packing,
    "op5_ngram_join": op5_ngram_join,
    "op6_line_dedup": op6_line_dedup,
    "op7_token_files": op7_token_files,
    "op8_language_id": op8_language_id,
    "op9_toxicity": op9_toxicity,
    "op10_quote_links": op10_quote_links,
    "op11_centroid_clustering": op11_centroid_clustering,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_best_fit_packing": op13_best_fit_packing,
}


def _lloyd_sql(k: int = 8, dims: int = 64, rounds: int = 10, scale: int = 1024, seed: str = "3") -> str:
    """Every round as two tables: the assignment, and the centroids that follow from it."""
    def assignment(r: int) -> str:
        return f"""a{r} AS MATERIALIZED (
          SELECT vec_id, v, min(struct_pack(d := d, c := c)) AS near FROM (
            SELECT vec_id, v, c, list_sum(list_transform(generate_series(1, {dims}), lambda i: (v[i] - m[i]) * (v[i] - m[i])))::BIGINT AS d
            FROM kept CROSS JOIN c{r}) GROUP BY vec_id, v)"""

    def moved(r: int) -> str:
        return f"""c{r + 1} AS MATERIALIZED (
          SELECT c, coalesce(list(((x - ((x % n) + n) % n) // n)::BIGINT ORDER BY i) FILTER (n > 0), any_value(m)) AS m FROM (
            SELECT c{r}.c, any_value(c{r}.m) AS m, g.i, sum(a.v[g.i])::HUGEINT AS x, count(a.v)::HUGEINT AS n
            FROM c{r} CROSS JOIN generate_series(1, {dims}) AS g(i) LEFT JOIN a{r} AS a ON a.near.c = c{r}.c
            GROUP BY c{r}.c, g.i) GROUP BY c)"""

    steps = [s for r in range(rounds) for s in (assignment(r), moved(r))] + [assignment(rounds)]
    return f"""
        WITH kept AS MATERIALIZED (
          SELECT vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v FROM embeddings
          WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: isfinite(x::DOUBLE))) = {dims}),
        c0 AS MATERIALIZED (
          SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS c, v AS m FROM kept ORDER BY c LIMIT {k}),
        {", ".join(steps)}
        SELECT vec_id, near.c::INT AS cluster, near.d AS distance, (sum(near.d) OVER (PARTITION BY near.c))::BIGINT AS cluster_inertia,
               (sum(near.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
        FROM a{rounds} JOIN c{rounds} ON c = near.c"""


def _resampling_sql(buckets: int = 10_000, seed: str = "2024", least_words: int = 20, percent: int = 10) -> str:
    """CRC-32 bit by bit over the bytes of every distinct word."""
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    bit = "lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    byte = f"lambda c, b: list_reduce(list_concat([xor(c, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), {bit})"
    return f"""
        WITH d AS MATERIALIZED (SELECT doc_id, unnest(regexp_extract_all({lower}, '{word}')) AS w FROM documents),
        t AS MATERIALIZED (SELECT unnest(regexp_extract_all({lower}, '{word}')) AS w FROM benchmark),
        words AS MATERIALIZED (
          SELECT w, (xor(4294967295, list_reduce(list_concat([4294967295::BIGINT],
            list_transform(generate_series(1, octet_length(encode(w)), 1), lambda i: ('0x' || hex(encode(w))[2 * i - 1:2 * i])::BIGINT)),
            {byte})) % {buckets}) AS b FROM (SELECT w FROM d UNION SELECT w FROM t)),
        s AS (SELECT b, count(*) AS s FROM d JOIN words USING (w) GROUP BY b),
        g AS (SELECT b, count(*) AS t FROM t JOIN words USING (w) GROUP BY b),
        gain AS MATERIALIZED (
          SELECT b, floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM d) + {buckets})::DOUBLE)
                                  / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT count(*) FROM t) + {buckets})::DOUBLE)))::BIGINT AS gain
          FROM s FULL JOIN g USING (b)),
        own AS MATERIALIZED (SELECT doc_id, count(*) AS n, sum(gain)::BIGINT AS weight FROM d JOIN words USING (w) JOIN gain USING (b) GROUP BY doc_id),
        scored AS MATERIALIZED (
          SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
                 (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{seed}:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE))))::BIGINT AS score
          FROM documents LEFT JOIN own USING (doc_id)),
        ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r FROM scored WHERE n_features >= {least_words})
        SELECT doc_id, n_features, weight, score,
               CASE WHEN r <= {percent} * (SELECT count(*) FROM ranked) // 100 THEN r END AS rank
        FROM scored LEFT JOIN ranked USING (doc_id)"""

ORACLE_SQL = {
    "op1_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
    "op11_centroid_clustering": _lloyd_sql(),
    "op12_importance_resampling": _resampling_sql(),
}
