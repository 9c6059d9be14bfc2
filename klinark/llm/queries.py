"""Registration of the queries of this subpackage and of their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from klinark.llm import exact_topk, graph_ann, quality, toxicity
from klinark.llm.byte_bpe import encode, read_ranks, round_trip
from klinark.llm.importance import importance_resample
from klinark.llm.mixing import Target, mix
from klinark.llm.ngram_join import ngram_components
from klinark.llm.prefix_trie import trie_nodes
from klinark.llm.shared import table
from klinark.llm.sharding import shard_documents
from klinark.llm.simhash import simhash_components
from klinark.llm.token_scan import document_tokens
from klinark.llm.url_filter import derived_entries, judge_captures, page_captures
from klinark.llm.vocabulary import EOD, PATTERN, vocabulary_path
from klinark.session import stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function
    return register


@query("op1_ngram_jaccard_join", r"""
    WITH RECURSIVE w AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
    s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
        ELSE list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]) END) AS g
      FROM w),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
      GROUP BY ALL),
    e AS (SELECT x, y FROM o JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 90 * (p.n + q.n - c)),
    r(doc_id, other) AS (SELECT doc_id, doc_id FROM documents
      UNION SELECT r.doc_id, e.y FROM r JOIN e ON e.x = r.other),
    m AS (SELECT doc_id, min(other) AS component_id FROM r GROUP BY doc_id)
    SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
    FROM documents JOIN m USING (doc_id) LEFT JOIN n USING (doc_id)""")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    """Documents linked by at least 90 % of their three-word shingles."""
    return ngram_components(table(spark, folder, "documents"), size=3, percent=90)


def _judged(scored: DataFrame, parts: int, rest: int) -> DataFrame:
    return scored.select("doc_id", quality.held_out(parts, rest).alias("held_out"), "score",
                         F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))


@query("op2_quality_classifier")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document; labels of one quarter of the ids are never learnt from."""
    described = stage(quality.features(table(spark, folder, "documents")), "quality-features")
    labels = table(spark, folder, "labels").filter(~quality.held_out(4, 2))
    return _judged(quality.score_features(described, quality.train(described, labels)), 4, 2)


@query("op3_token_counts")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document, counted by the separators of flat token files."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    encoded = encode(docs, read_ranks(vocabulary_path()), PATTERN).select("doc_id", "ids")
    return document_tokens(encoded, EOD, 2)


@query("op4_jump_sharding", r"""
    WITH RECURSIVE bits(n, c, k) AS (
      SELECT i, i::UBIGINT, 0 FROM range(256) t(i) UNION ALL
      SELECT n, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::UBIGINT) ELSE c // 2 END, k + 1 FROM bits WHERE k < 8),
    crc AS (SELECT list(c ORDER BY n) AS t FROM bits WHERE k = 8),
    d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
        CASE WHEN coalesce(doc_id, 0) < 0 THEN doc_id::HUGEINT + 18446744073709551616 ELSE coalesce(doc_id, 0)::HUGEINT END AS key
      FROM documents),
    j(r, n, key, b, j) AS (
      SELECT r, n, key, (-1)::BIGINT, 0::BIGINT FROM d, (VALUES (16), (17)) v(n) UNION ALL
      SELECT r, n, k, j, floor((j + 1) * (2147483648.0::DOUBLE / ((k // 8589934592) + 1)::DOUBLE))::BIGINT
      FROM (SELECT r, n, j, (key * 2862933555777941757 + 1) % 18446744073709551616 AS k FROM j WHERE j < n)),
    s AS (SELECT r, max(b) FILTER (n = 16)::INT AS shard, max(b) FILTER (n = 17)::INT AS grown_shard FROM j GROUP BY r),
    x AS (SELECT r, hex(encode(text)) AS h FROM d),
    c AS (SELECT r, xor(list_reduce(list_transform(range(-1, len(h) // 2),
          lambda i: CASE WHEN i < 0 THEN 4294967295::UBIGINT ELSE ('0x' || substr(h, 2 * i + 1, 2))::UBIGINT END),
          lambda a, b: xor(a // 256, t[((xor(a, b) % 256) + 1)::BIGINT])), 4294967295::UBIGINT)::BIGINT AS text_crc32 FROM x, crc),
    o AS (SELECT d.doc_id, (octet_length(encode(text)) + 1)::BIGINT AS size, text_crc32, shard, grown_shard,
        ((key * 2862933555777941757 + 1) % 18446744073709551616) // 4503599627370496 AS bucket
      FROM d JOIN s USING (r) JOIN c USING (r))
    SELECT doc_id, size, text_crc32, 'key' AS law, shard,
      row_number() OVER (PARTITION BY shard ORDER BY bucket, doc_id, size, text_crc32) - 1 AS slot, grown_shard
    FROM o""")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    """Documents in 16 shards by jump consistent hashing of their ids."""
    return shard_documents(table(spark, folder, "documents"))


@query("op5_toxicity")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of every document; labels of one third of the ids are never learnt from."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, folder, "labels").filter(~quality.held_out(3, 1)))
    return _judged(toxicity.add_scores(docs, model, name="score"), 3, 1)


@query("op6_url_filters", r"""
    WITH c AS (SELECT page_id, url, (DATE '2024-01-01' + (coalesce(page_id, 0) % 366)::INT) AS fetched,
        nullif(rtrim(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1), '.'), '') AS host FROM pages),
    h AS (SELECT DISTINCT host FROM c WHERE host IS NOT NULL),
    g AS (SELECT host AS domain FROM h UNION SELECT array_to_string(string_split(host, '.')[-3:], '.') FROM h),
    k AS (SELECT list, domain, md5(list || '/' || domain) AS m FROM g, (VALUES ('adult'), ('malware'), ('spam')) v(list)),
    n AS (SELECT list, domain, ('0x' || substr(m, 1, 4))::INT AS n1, ('0x' || substr(m, 5, 4))::INT AS n2,
        ('0x' || substr(m, 9, 4))::INT AS n3, ('0x' || substr(m, 13, 4))::INT AS n4, ('0x' || substr(m, 17, 4))::INT AS n5 FROM k),
    e AS (SELECT list, domain, DATE '2024-01-01' + n2 % 300 AS a, DATE '2024-01-01' + n2 % 300 + 1 + n3 % 90 AS b,
        DATE '2024-01-01' + n2 % 300 + 1 + n3 % 90 + 1 + n4 % 60 AS c, n5 % 4 AS steps FROM n WHERE n1 % 3 = 0),
    v AS (SELECT list, domain, a AS since, CASE WHEN steps >= 1 THEN b END AS until FROM e
      UNION ALL SELECT list, domain, c, NULL FROM e WHERE steps >= 2),
    p AS (SELECT DISTINCT host, fetched FROM c WHERE host IS NOT NULL),
    q AS (SELECT host, fetched, array_to_string(string_split(host, '.')[i:], '.') AS domain
      FROM (SELECT host, fetched, unnest(range(1, greatest(len(string_split(host, '.')) - 1, 1) + 1)) AS i FROM p)),
    w AS (SELECT host, fetched, array_to_string(list_sort(list(DISTINCT list)), ',') AS lists FROM q JOIN v USING (domain)
      WHERE since <= fetched AND (until IS NULL OR fetched < until) GROUP BY host, fetched)
    SELECT page_id, url, fetched::DATE AS fetched, coalesce(lists, '') AS lists, lists IS NOT NULL AS blocked
    FROM c LEFT JOIN w USING (host, fetched)""")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    """Every page against the list entries in force on the day of its capture."""
    pages = table(spark, folder, "pages").select("page_id", "url")
    judged = judge_captures(page_captures(pages), derived_entries(pages))
    return judged.withColumn("lists", F.array_join("lists", ","))


@query("op7_byte_bpe")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    """Every document encoded to token ids and decoded again."""
    return round_trip(table(spark, folder, "documents"), read_ranks(vocabulary_path()), PATTERN)


@query("op8_temperature_mixing", r"""
    WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n_tokens
      FROM documents),
    s AS (SELECT source, sum(n_tokens)::BIGINT AS t FROM d GROUP BY source),
    a AS (SELECT CASE WHEN max(t) <= 2 * min(t) THEN 0 ELSE
        ceil((1 - ln(2) / ln(max(t)::DOUBLE / min(t))) * 1e6 - 1e-3) / 1e6 END AS a, max(t) AS most FROM s WHERE t > 0),
    q AS (SELECT source, t, CASE WHEN t > 0 THEN greatest(floor(round(pow(t, a) * pow(most, 1 - a), 6))::BIGINT, t) ELSE 0 END AS quota
      FROM s, a),
    f AS (SELECT source, CASE WHEN t > 0 THEN quota // t ELSE 1 END AS f, CASE WHEN t > 0 THEN quota % t ELSE 0 END AS rest FROM q),
    k AS (SELECT d.*, f, rest, md5('mix|' || f || '|' || coalesce(doc_id::VARCHAR, '')) AS key
      FROM d JOIN f ON d.source IS NOT DISTINCT FROM f.source),
    r AS (SELECT *, sum(n_tokens) OVER (PARTITION BY source ORDER BY key RANGE UNBOUNDED PRECEDING) AS run FROM k),
    b AS (SELECT doc_id, source, n_tokens, unnest(range(0, f + CASE WHEN rest > 0 AND run <= rest THEN 1 ELSE 0 END)) AS block FROM r)
    SELECT doc_id, source, n_tokens, block::BIGINT AS block, md5('mix|' || block || '|' || coalesce(doc_id::VARCHAR, '')) AS order_key
    FROM b""")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    """All documents, rare sources repeated up to twice as often as the largest one."""
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    return mix(docs, Target(repeats=2.0)).select(
        "doc_id", "source", F.col("_tokens").alias("n_tokens"), F.col("_block").alias("block"), F.col("_order").alias("order_key"))


@query("op9_exact_topk", r"""
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x FROM embeddings
      WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.x, v.x)::BIGINT AS score
      FROM v q, v WHERE q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    """Exact five best rows of each query by integer inner product."""
    return exact_topk.top_products(table(spark, folder, "embeddings"))


@query("op10_graph_ann")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    """About the five nearest rows of each query by cosine."""
    return graph_ann.nearest_cosine(table(spark, folder, "embeddings"))


@query("op11_simhash_dedup")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    """Documents linked by SimHash fingerprints of at most four differing bits."""
    return simhash_components(table(spark, folder, "documents"))


@query("op12_prefix_trie", r"""
    WITH RECURSIVE bits(n, c, k) AS (
      SELECT i, i::UBIGINT, 0 FROM range(256) t(i) UNION ALL
      SELECT n, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::UBIGINT) ELSE c // 2 END, k + 1 FROM bits WHERE k < 8),
    crc AS (SELECT list(c ORDER BY n) AS t FROM bits WHERE k = 8),
    u AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL),
    o AS (SELECT conv_id, list({r: r, x: x} ORDER BY turn NULLS FIRST, substr(sha256(length(r)::VARCHAR || ':' || r || x), 1, 32)) AS turns
      FROM u GROUP BY conv_id),
    z AS (SELECT conv_id, hex(encode(conv_id::VARCHAR)) AS z FROM o),
    h AS (SELECT conv_id, xor(list_reduce(list_transform(range(-1, len(z) // 2),
          lambda i: CASE WHEN i < 0 THEN 4294967295::UBIGINT ELSE ('0x' || substr(z, 2 * i + 1, 2))::UBIGINT END),
          lambda a, b: xor(a // 256, t[((xor(a, b) % 256) + 1)::BIGINT])), 4294967295::UBIGINT)::BIGINT % 4 AS h FROM z, crc),
    r AS (SELECT o.conv_id, list_concat(coalesce(b.turns[1:h], []), o.turns[h + 1:]) AS turns
      FROM o JOIN h USING (conv_id) LEFT JOIN o b ON b.conv_id = o.conv_id - o.conv_id % 20),
    p AS (SELECT conv_id, d, turns[1:d] AS path, len(turns) = d AS ends,
        CASE WHEN d > 0 THEN len(regexp_extract_all(turns[d].x, '[^\x20\x09-\x0D]+')) ELSE 0 END AS w
      FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM r)),
    n AS (SELECT d, path, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(w) AS saved,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
      FROM p GROUP BY d, path),
    m AS (SELECT p.conv_id AS member, d, n.conv_id AS node FROM p JOIN n USING (d, path)),
    c AS (SELECT m.node AS conv_id, m.d, count(*) AS n_children FROM n JOIN m ON m.member = n.conv_id AND m.d = n.d - 1 GROUP BY ALL),
    s AS (SELECT m.node AS conv_id, m.d, count(*) FILTER (WHERE n_children IS NULL) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
      FROM n LEFT JOIN c USING (conv_id, d) JOIN m ON m.member = n.conv_id AND m.d <= n.d GROUP BY ALL)
    SELECT n.conv_id, n.d::BIGINT AS depth, m.node AS parent_conv_id, n_convs, coalesce(n_children, 0)::BIGINT AS n_children,
      n_leaves::BIGINT AS n_leaves, saved_tokens, ends_sha256
    FROM n JOIN s USING (conv_id, d) LEFT JOIN c USING (conv_id, d)
    LEFT JOIN m ON m.member = n.conv_id AND m.d = n.d - 1""")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    """Nodes of the prefix trie of all rebuilt conversations."""
    return trie_nodes(table(spark, folder, "conversations"))


@query("op13_importance_resampling", r"""
    WITH RECURSIVE bits(n, c, k) AS (
      SELECT i, i::UBIGINT, 0 FROM range(256) t(i) UNION ALL
      SELECT n, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::UBIGINT) ELSE c // 2 END, k + 1 FROM bits WHERE k < 8),
    crc AS (SELECT list(c ORDER BY n) AS t FROM bits WHERE k = 8),
    d AS (SELECT 'd' AS side, row_number() OVER () AS r, doc_id, text FROM documents),
    w AS (SELECT side, r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
      FROM (SELECT side, r, text FROM d UNION ALL SELECT 'b', 0, text FROM benchmark)),
    g AS (SELECT side, r, unnest(list_concat(words, CASE WHEN len(words) < 2 THEN [] ELSE
        list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]) END)) AS g FROM w),
    x AS (SELECT g, hex(encode(g)) AS h FROM (SELECT DISTINCT g FROM g)),
    c AS (SELECT g, (xor(list_reduce(list_transform(range(-1, len(h) // 2),
          lambda i: CASE WHEN i < 0 THEN 4294967295::UBIGINT ELSE ('0x' || substr(h, 2 * i + 1, 2))::UBIGINT END),
          lambda a, b: xor(a // 256, t[((xor(a, b) % 256) + 1)::BIGINT])), 4294967295::UBIGINT) % 10000)::BIGINT AS bucket FROM x, crc),
    f AS (SELECT side, r, bucket, count(*) AS n FROM g JOIN c USING (g) GROUP BY ALL),
    k AS (SELECT bucket, coalesce(sum(n) FILTER (side = 'd'), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (side = 'b'), 0)::DOUBLE AS t
      FROM f GROUP BY bucket),
    y AS (SELECT bucket, floor(1000 * ln(((t + 1) * ((SELECT sum(s) FROM k) + 10000))
        / ((s + 1) * ((SELECT sum(t) FROM k) + 10000))))::BIGINT AS gain FROM k),
    v AS (SELECT r, sum(n)::BIGINT AS n, sum(n * gain)::BIGINT AS total FROM f JOIN y USING (bucket) WHERE side = 'd' GROUP BY r),
    z AS (SELECT doc_id, d.r, coalesce(n, 0)::BIGINT AS n_features,
        CASE WHEN n > 0 THEN (total - ((total % n) + n) % n) // n ELSE 0 END::BIGINT AS weight,
        (coalesce(n, 0) + 1) // 2 >= 20 AS fit,
        ('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h FROM d LEFT JOIN v USING (r)),
    q AS (SELECT doc_id, r, n_features, weight, fit,
        weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM z),
    o AS (SELECT *, row_number() OVER (PARTITION BY fit ORDER BY score DESC, doc_id NULLS LAST, r) AS place FROM q)
    SELECT doc_id, n_features, weight, score,
      CASE WHEN fit AND place <= (SELECT count(*) FROM q WHERE fit) * 25 // 100 THEN place END AS rank FROM o""")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    """A quarter of the documents, drawn towards the benchmark texts."""
    return importance_resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
