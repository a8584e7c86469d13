"""Registered queries of the operators in this folder, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import (bpe, decontaminate, embedding_dedup, minhash_forest, packing, periodic_runs, sharding, substring_dedup, token_counts,
                          toxicity, url_filters, warc, whitening)
from riskloom.llm.common import read_table, ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
BPE_FILE = "byte_bpe_50k.json"


def query(name: str, oracle: str | None = None):
    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle
        return fn
    return add


RULES = (url_filters.Rule("net/", "block"), url_filters.Rule("example.net/en/", "allow"),
         url_filters.Rule("example.com/de/", "block"), url_filters.Rule("org/fr/", "allow"))


@query("op1_url_filters")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = url_filters.labelled_pages(read_table(spark, sf_dir, "pages"), read_table(spark, sf_dir, "labels"))
    return url_filters.judge_urls(pages, RULES, bad_col="bad")


@query("op2_token_counts")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read_table(spark, sf_dir, "documents"), public_tokenizers.path(BPE_FILE))


WORD_SQL = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""


@query("op3_decontaminate", f"""
WITH d AS (
    SELECT doc_id, {WORD_SQL} AS w FROM documents
), b AS (
    SELECT CAST(item_id AS VARCHAR) AS item, {WORD_SQL} AS w FROM benchmark
), windows AS (
    SELECT DISTINCT item, array_to_string(w[s + 1 : s + least(10, len(w))], ' ') AS win, least(10, len(w)) AS n
    FROM (SELECT item, w, unnest(range(0, greatest(len(w) - 10, 0) + 1)) AS s FROM b WHERE len(w) > 0)
), lengths AS (
    SELECT DISTINCT n FROM windows
), starts AS (
    SELECT doc_id, w, n, unnest(range(0, len(w) - n + 1)) AS s FROM d, lengths WHERE len(w) >= n
), hits AS (
    SELECT doc_id, s, h.n, item FROM starts h JOIN windows v ON v.n = h.n AND v.win = array_to_string(w[s + 1 : s + h.n], ' ')
), marked AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN marked USING (doc_id) LEFT JOIN named USING (doc_id)
""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.drop("spans")


@query("op5_warc", """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS body FROM pages
), d AS (
    SELECT page_id, octet_length(encode(body)) AS n, sha256(body) AS digest FROM p
), f AS (
    SELECT digest, min(page_id) AS first FROM d WHERE n >= 100 GROUP BY digest
)
SELECT d.page_id, CAST(d.n AS BIGINT) AS payload_bytes, d.digest AS payload_digest,
    CASE WHEN f.first IS NULL OR f.first = d.page_id THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN f.first <> d.page_id THEN f.first END AS refers_to
FROM d LEFT JOIN f USING (digest)
""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = warc.archive_round_trip(read_table(spark, sf_dir, "pages"))
    # what a response holds is measured on the payload that was read; a revisit has its header's digest and length
    return back.select(
        "page_id", F.coalesce(F.octet_length("payload").cast("long"), F.col("payload_bytes")).alias("payload_bytes"),
        F.coalesce("record_digest", "payload_digest").alias("payload_digest"), "record_type", "refers_to")


@query("op6_lpt_shards")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read_table(spark, sf_dir, "documents"), 40)


@query("op7_bpe_round_trip")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = bpe.round_trip(read_table(spark, sf_dir, "documents"), public_tokenizers.path(BPE_FILE))
    return back.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op10_minhash_forest", r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[s + 1 : s + 5], ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(0, greatest(len(w) - 4, 1))) AS s FROM w WHERE len(w) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
    SELECT x.a, x.b FROM (
        SELECT l.doc_id AS a, r.doc_id AS b, count(*) AS common FROM shingles l JOIN shingles r ON l.g = r.g AND l.doc_id <> r.doc_id
        GROUP BY ALL) x
    JOIN sizes p ON p.doc_id = x.a JOIN sizes q ON q.doc_id = x.b
    WHERE 100 * common >= 85 * (p.n + q.n - common)
), reach AS (
    SELECT doc_id AS node, doc_id AS seen FROM w
    UNION
    SELECT reach.node, links.b FROM reach JOIN links ON links.a = reach.seen
), least AS (
    SELECT node, min(seen) AS component_id FROM reach GROUP BY node
)
SELECT w.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, w.doc_id = component_id AS kept
FROM w JOIN least ON least.node = w.doc_id LEFT JOIN sizes USING (doc_id)
""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_forest.near_duplicates(read_table(spark, sf_dir, "documents"))


@query("op9_substring_dedup", r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
    SELECT doc_id, s, sha256(array_to_string(w[s + 1 : s + 50], ' ')) AS h
    FROM (SELECT doc_id, w, unnest(range(0, len(w) - 49)) AS s FROM d WHERE len(w) >= 50)
), firsts AS (
    SELECT h, min(doc_id) AS first FROM windows GROUP BY h
), gone AS (
    SELECT DISTINCT doc_id, p FROM (
        SELECT doc_id, unnest(range(s, s + 50)) AS p FROM windows JOIN firsts USING (h) WHERE first < doc_id)
), words AS (
    SELECT doc_id, unnest(range(0, len(w))) AS p, unnest(w) AS word FROM d
), kept AS (
    SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS text FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
    sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op8_embedding_dedup", """
WITH RECURSIVE v AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), good AS (
    SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS (
    SELECT x.vec_id AS a, y.vec_id AS b FROM good x JOIN good y
        ON x.label = y.label AND x.vec_id <> y.vec_id AND list_cosine_similarity(x.e, y.e) >= 0.98
), reach AS (
    SELECT vec_id AS node, vec_id AS seen FROM v
    UNION
    SELECT reach.node, links.b FROM reach JOIN links ON links.a = reach.seen
), least AS (
    SELECT node, min(seen) AS component_id FROM reach GROUP BY node
), degree AS (
    SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN least ON node = vec_id LEFT JOIN degree ON a = vec_id
""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(read_table(spark, sf_dir, "embeddings"))


@query("op4_toxicity")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query("op11_periodic_runs", r"""
WITH RECURSIVE raw AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
        list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)) AS signs
    FROM documents
), hashed AS (
    SELECT doc_id, w, len(w) AS n, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), signs), lambda s, c:
        list_reduce(list_prepend(xor(s, c), [CAST(k AS BIGINT) FOR k IN range(8)]), lambda t, k:
            CASE WHEN t % 2 = 1 THEN xor(t >> 1, CAST(3988292384 AS BIGINT)) ELSE t >> 1 END))) AS h
    FROM raw
), placed AS (
    SELECT doc_id, w, n, h % 10 = 0 AND n > 0 AS planted, (h // 10) % greatest(n, 1) AS a, 3 + (h // 10) % 8 AS parts FROM hashed
), d AS (
    SELECT doc_id, n, CASE WHEN planted THEN
        [w[CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // parts) END + 1] FOR i IN range(n)] ELSE w END AS w
    FROM placed
), words AS (
    SELECT doc_id, n, unnest(range(0, n)) AS p, unnest(w) AS word FROM d
), same AS (
    SELECT x.doc_id, y.p - x.p AS q, x.p FROM words x JOIN words y
        ON x.doc_id = y.doc_id AND x.word = y.word AND y.p > x.p AND 4 * (y.p - x.p) <= x.n
), stretches AS (
    SELECT doc_id, q, min(p) AS start, count(*) + q AS length
    FROM (SELECT doc_id, q, p, p - row_number() OVER (PARTITION BY doc_id, q ORDER BY p) AS island FROM same)
    GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(6, 4 * q)
), runs AS (
    SELECT doc_id, start, length, min(q) AS period FROM stretches GROUP BY doc_id, start, length
), found AS (
    SELECT doc_id, count(*) AS n_runs, arg_max({'start': start, 'length': length, 'period': period}, (length, -start, -period)) AS longest,
        string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
    FROM runs GROUP BY doc_id
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS p FROM runs
), kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(longest.start AS BIGINT) AS start,
    CAST(longest.length AS BIGINT) AS length, CAST(longest.period AS BIGINT) AS period,
    CAST(1000 * longest.length // longest.period AS BIGINT) AS exponent_milli,
    sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM d LEFT JOIN found USING (doc_id) LEFT JOIN kept USING (doc_id)
""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(periodic_runs.with_planted_runs(read_table(spark, sf_dir, "documents")))
    # greatest length, then smallest start and period
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    longest = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.array_join(lines, "").alias("lines"), "collapsed")
    start, length, period = -F.col("best.s"), F.col("best.length"), -F.col("best.p")
    return longest.select("doc_id", "n_runs", start.alias("start"), length.alias("length"), period.alias("period"),
                          F.expr("1000 * best.length div -best.p").alias("exponent_milli"),
                          F.sha2("lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query("op12_pack_sequences")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path(BPE_FILE))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op13_whiten_embeddings")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))
