"""The registered queries of the operators, over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ..session import configure, working_path
from . import (bagrank, bpeauto, chunkdedup, exactdup, idpack, langid, packing, rabitq, simhash, tokencount, walshkmeans, warc,
               weakrules)
from .common import stored, table

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
CENTROIDS, ROUNDS = 40, 5


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans, in bytes of the UTF-8 text, that a document of smaller id has too."""
    return chunkdedup.repeated_spans(table(spark, sf_dir, "documents")).select(
        "doc_id", "first_doc_id", "start", "end", "n_words")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(table(spark, sf_dir, "documents"), BYTE_BPE, limit=512)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, radius=3)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = working_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), out)
    return warc.captures(spark, out).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), WORD_BPE, capacity=2048, end_id=0)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weakrules.quality(table(spark, sf_dir, "documents"), stored)


def op8_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = working_path(spark, "ids")
    idpack.write_ids(table(spark, sf_dir, "documents"), out, WORD_BPE, end_id=1)
    return idpack.read_digests(spark, out)


def op9_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpeauto.digests(table(spark, sf_dir, "documents"), WORD_BPE)


def op10_one_bit_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rabitq.nearest(table(spark, sf_dir, "embeddings"), every=100, k=10)


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagrank.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return walshkmeans.clusters(table(spark, sf_dir, "embeddings"), k=CENTROIDS, rounds=ROUNDS)


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdup.duplicates(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One query an operator, by name."""
    made = (op1_substring_dedup, op2_language_id, op3_token_counts, op4_simhash, op5_warc, op6_best_fit_packing,
            op7_quality_rules, op8_token_id_output, op9_bpe_automaton, op10_one_bit_neighbours, op11_ranked_search,
            op12_centroid_clustering, op13_exact_dedup)

    def set_up(make):
        return lambda spark, sf_dir: make(configure(spark), sf_dir)

    return {f.__name__: set_up(f) for f in made}


WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest FROM p),
k AS (SELECT payload_digest, max(page_id) AS kept FROM d WHERE payload_bytes >= 1000 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id < kept THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < kept THEN kept END AS refers_to
FROM d LEFT JOIN k USING (payload_digest)"""

_TERMS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

SEARCH_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS terms FROM documents),
n AS (SELECT r, doc_id, CAST(len(terms) AS BIGINT) AS n FROM d WHERE len(terms) > 0),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM n),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM d) GROUP BY r, term),
q AS (SELECT item_id, term, count(*) AS times
      FROM (SELECT item_id, unnest({_TERMS}) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE item_id IS NOT NULL)) GROUP BY item_id, term),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * max(docs) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
      FROM tf, totals WHERE term IN (SELECT term FROM q) GROUP BY term),
m AS (SELECT r, doc_id, 100 - 75 + ((75 * n * docs) // totals.terms) AS m FROM n, totals),
s AS (SELECT item_id, doc_id, r, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
      FROM q JOIN w USING (term) JOIN tf USING (term) JOIN m USING (r) GROUP BY item_id, doc_id, r),
o AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM o WHERE rank <= 10"""

EXACT_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t
           FROM documents),
o AS (SELECT *, count(*) OVER (PARTITION BY t) AS size, row_number() OVER same AS place, first_value(doc_id) OVER same AS keep
      FROM d WINDOW same AS (PARTITION BY t ORDER BY n DESC, doc_id NULLS LAST, r))
SELECT doc_id, keep AS keep_id, CAST(size AS BIGINT) AS group_size, place = 1 AS kept, sha256(t) AS text_sha256 FROM o"""


def clustering_sql(k: int = CENTROIDS, rounds: int = ROUNDS) -> str:
    """The plain search, a step a round."""
    steps = ["""v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""", f"""c0 AS MATERIALIZED (
SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS c, e FROM v QUALIFY c < {k})"""]
    for n in range(rounds + 1):
        steps.append(f"""a{n} AS MATERIALIZED (SELECT r, arg_min(c, d * {k} + c) AS c, min(d) AS d FROM (
SELECT r, c, list_sum(list_transform(list_zip(v.e, c{n}.e), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM v, c{n}) GROUP BY r)""")
        if n < rounds:
            steps.append(f"""s{n} AS (SELECT c, i, sum(x) AS s, count(*) AS n FROM (
SELECT a{n}.c, unnest(e) AS x, generate_subscripts(e, 1) AS i FROM a{n} JOIN v USING (r)) GROUP BY c, i),
c{n + 1} AS MATERIALIZED (SELECT c, coalesce(m.e, c{n}.e) AS e FROM c{n} LEFT JOIN (
SELECT c, list(CAST((s - ((s % n + n) % n)) // n AS BIGINT) ORDER BY i) AS e FROM s{n} GROUP BY c) m USING (c))""")
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c{rounds}.e, ',')) AS centroid_sha256
FROM a{rounds} JOIN v USING (r) JOIN c{rounds} USING (c)"""


def oracle_sql() -> dict[str, str]:
    """SQL of the queries that it can express over whole tables."""
    return {"op5_warc": WARC_SQL, "op11_ranked_search": SEARCH_SQL, "op12_centroid_clustering": clustering_sql(),
            "op13_exact_dedup": EXACT_SQL}
