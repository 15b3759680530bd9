"""The registered queries of the operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from llm import class_lm, cover_dedup, language_tree, minhash, periodic_runs, posting_ann, prefix_doubling, raking, secret_links, sos_packing, spelling_trie, vector_join, warc_zstd
from llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return register


@query("op1_class_lm")
def op1_class_lm(spark, sf_dir):
    return class_lm.score_documents(table(spark, sf_dir, "documents"))


@query("op2_secret_links")
def op2_secret_links(spark, sf_dir):
    return secret_links.find_secrets(table(spark, sf_dir, "documents")).drop("secrets")


@query("op3_language_tree")
def op3_language_tree(spark, sf_dir):
    return language_tree.identify(table(spark, sf_dir, "documents"))


@query(
    "op4_warc_zstd",
    """WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
         f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1)
       SELECT page_id, payload_bytes, payload_digest,
              CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
              CASE WHEN first < page_id THEN first END AS refers_to
       FROM p LEFT JOIN f USING (payload_digest)""",
)
def op4_warc_zstd(spark, sf_dir):
    records = warc_zstd.round_trip(table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op5_sos_packing")
def op5_sos_packing(spark, sf_dir):
    return sos_packing.pack(table(spark, sf_dir, "documents"))


@query("op6_posting_ann")
def op6_posting_ann(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return posting_ann.nearest(vectors, vectors.where("vec_id % 100 = 0"))


@query(
    "op7_cover_dedup",
    """WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
         w AS (SELECT doc_id, s, md5(array_to_string(words[s:s + 49], ' ')) AS h FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS s FROM d)),
         f AS (SELECT h, min(doc_id) AS first FROM w GROUP BY h),
         g AS (SELECT doc_id, list(s ORDER BY s) AS starts FROM w JOIN f USING (h) WHERE first < doc_id GROUP BY doc_id),
         gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS p FROM (SELECT doc_id, unnest(starts) AS s FROM g)),
         kept AS (SELECT d.doc_id, x.p, d.words[x.p] AS word FROM d, LATERAL (SELECT unnest(range(1, len(d.words) + 1)) AS p) x
                  WHERE NOT EXISTS (SELECT 1 FROM gone WHERE gone.doc_id = d.doc_id AND gone.p = x.p)),
         k AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t FROM kept GROUP BY doc_id)
       SELECT d.doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
       FROM d LEFT JOIN k USING (doc_id)""",
)
def op7_cover_dedup(spark, sf_dir):
    return cover_dedup.remove_repeats(table(spark, sf_dir, "documents"), with_text=False)


@query(
    "op8_vector_join",
    """WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
         s AS (SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 4], ' ')) AS h
               FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
         n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
         c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY ALL),
         e AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 75 * (x.n + y.n - i)),
         r AS (SELECT doc_id, doc_id AS o FROM d UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.o = e.a)
       SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.o) AS component_id
       FROM d LEFT JOIN n USING (doc_id) JOIN r USING (doc_id) GROUP BY d.doc_id""",
)
def op8_vector_join(spark, sf_dir):
    return vector_join.join_components(table(spark, sf_dir, "documents"))


@query("op9_raking")
def op9_raking(spark, sf_dir):
    mixed = raking.mix(table(spark, sf_dir, "documents"))
    return mixed.select(
        "doc_id", "source", "lang", F.substring("mix.topic", 2, 100).alias("topic"), F.col("mix.tokens").alias("n_tokens"),
        F.col("mix.weight").alias("weight"), F.col("mix.probability").alias("probability"), F.col("mix.drawn").alias("drawn"),
    )


@query("op10_minhash")
def op10_minhash(spark, sf_dir):
    return minhash.compare_with_next(table(spark, sf_dir, "documents"))


@query("op11_prefix_doubling")
def op11_prefix_doubling(spark, sf_dir):
    return prefix_doubling.remove_repeats(table(spark, sf_dir, "documents"), with_text=False)


@query("op12_spelling_trie")
def op12_spelling_trie(spark, sf_dir):
    return spelling_trie.spelling_forms(spelling_trie.count_words(table(spark, sf_dir, "documents")))


@query("op13_periodic_runs")
def op13_periodic_runs(spark, sf_dir):
    return periodic_runs.summarize_runs(table(spark, sf_dir, "documents"))


query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
