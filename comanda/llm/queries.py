"""The registered queries of this subpackage, thin over its operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from comanda.llm import (
    bpe,
    chunked_bpe,
    dialogue_repair,
    minhash,
    mixing,
    sharding,
    suffix_dedup,
    token_counts,
    topk,
    toxicity,
    url_filters,
    vector_links,
    whitening,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    """How many words of each document a mix to weights 5, 2, 1 takes."""
    mixed = mixing.mix(_table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op2_toxicity_grades(spark: SparkSession, folder: str) -> DataFrame:
    """Expected severity and grade of every document, by a model of the labels."""
    documents = _table(spark, folder, "documents")
    model = toxicity.fit(documents, _table(spark, folder, "labels"))
    found = toxicity.grade(documents.select("doc_id", "text"), model)
    return found.select("doc_id", "severity", "grade", "p_toxic", "rejected")


def op3_byte_shards(spark: SparkSession, folder: str) -> DataFrame:
    """40 contiguous shards of documents with near-equal bytes."""
    return sharding.shard_documents(_table(spark, folder, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _tokenizer(name: str) -> str:
    """Where a public tokenizer's file lies; the operators take any path."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document under a byte-level BPE."""
    return token_counts.count_tokens(_table(spark, folder, "documents"), _tokenizer("byte_bpe_50k.json"))


def op5_repeated_bytes(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without the 100-byte strings that start earlier as well."""
    return suffix_dedup.digests(suffix_dedup.remove_repeats(_table(spark, folder, "documents")))


def op6_vector_links(spark: SparkSession, folder: str) -> DataFrame:
    """Links and components of vectors of one label with a cosine from 0.93."""
    return vector_links.link_vectors(_table(spark, folder, "embeddings"))


def op7_url_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    """Rules first; else hosts with many tracking parameters are blocked."""
    pages = _table(spark, folder, "pages")
    return url_filters.judge(pages, url_filters.tracking_hosts(pages))


def op8_top_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 best of all vectors for every twentieth one."""
    return topk.top_k(_table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def op9_bpe_round(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of every document's token ids and of what they decode to."""
    found = bpe.encode_decode(_table(spark, folder, "documents"), _tokenizer("word_bpe_49k.json"))
    return bpe.digests(found)


def op10_minhash_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of documents whose four-word shingles agree by four fifths."""
    found = minhash.near_duplicates(_table(spark, folder, "documents"), words=4, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op11_whitened_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors on their eight leading components, with unit covariance."""
    return whitening.whiten(_table(spark, folder, "embeddings"))


def op12_chunk_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of every document's ids under ranks for many languages, and of their bytes."""
    path = _tokenizer("byte_bpe_multi_50k.tiktoken")
    encoded = chunked_bpe.encode(_table(spark, folder, "documents"), path)
    return chunked_bpe.digests(chunked_bpe.decode(encoded, path))


def op13_dialogue_repair(spark: SparkSession, folder: str) -> DataFrame:
    """What is wrong with damaged conversations, their least edits, and a digest after them."""
    conversations = _table(spark, folder, "conversations")
    repair = dialogue_repair.Repair(dialogue_repair.damage(conversations))
    found = conversations.select("conv_id").distinct()
    for part in (repair.report(), repair.digests()):
        part = part.withColumnRenamed("conv_id", "c")
        found = found.join(part, F.col("conv_id").eqNullSafe(F.col("c")), "left").drop("c")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return found.select(
        "conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


QUERIES: dict[str, Query] = {
    "op1_source_mix": op1_source_mix,
    "op2_toxicity_grades": op2_toxicity_grades,
    "op3_byte_shards": op3_byte_shards,
    "op4_token_counts": op4_token_counts,
    "op5_repeated_bytes": op5_repeated_bytes,
    "op6_vector_links": op6_vector_links,
    "op7_url_verdicts": op7_url_verdicts,
    "op8_top_vectors": op8_top_vectors,
    "op9_bpe_round": op9_bpe_round,
    "op10_minhash_groups": op10_minhash_groups,
    "op11_whitened_vectors": op11_whitened_vectors,
    "op12_chunk_bpe": op12_chunk_bpe,
    "op13_dialogue_repair": op13_dialogue_repair,
}

_WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

ORACLES: dict[str, str] = {
    "op1_source_mix": rf"""
        WITH sizes AS (
            SELECT doc_id, source, {_WORDS}::BIGINT AS size,
                   md5('mix-1:' || coalesce(doc_id::VARCHAR, '')) AS key
            FROM documents),
        ranked AS (
            SELECT source, sum(size)::BIGINT AS source_size,
                   [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
            FROM sizes GROUP BY source),
        ordered AS (
            SELECT *, sum(source_size) OVER () AS whole, sum(weight) OVER () AS weights,
                   coalesce(sum(3 * source_size) OVER tight, 0) AS capped,
                   coalesce(sum(weight) OVER tight, 0) AS gone
            FROM ranked
            WINDOW tight AS (ORDER BY 3 * source_size / weight, source NULLS LAST
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        level AS (
            SELECT (whole - capped)::BIGINT AS rest, (weights - gone)::BIGINT AS share
            FROM ordered
            WHERE (whole - capped) * weight <= 3 * source_size * (weights - gone)
            ORDER BY 3 * source_size / weight, source NULLS LAST LIMIT 1),
        targets AS (
            SELECT source, source_size,
                   CASE WHEN rest * weight > 3 * source_size * share THEN (3 * source_size)::DOUBLE
                        ELSE (rest * weight)::DOUBLE / share::DOUBLE END AS target
            FROM ranked, level),
        placed AS (
            SELECT s.doc_id, s.size, t.source_size, t.target, floor(t.target)::BIGINT AS budget,
                   coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id, s.size
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
            FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
        SELECT doc_id, size, source_size, target,
               CASE WHEN source_size = 0 THEN 0::BIGINT ELSE
                   (budget // source_size * size
                    + greatest(0, least(size, budget % source_size - before)))::BIGINT END AS taken
        FROM placed
    """,
    "op7_url_verdicts": r"""
        WITH parts AS (
            SELECT page_id, url,
                   CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
            FROM pages),
        split AS (
            SELECT page_id, url,
                   translate(regexp_extract(rest, '(?s)^([^/?#]*)', 1),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) AS path
            FROM parts),
        listed AS (
            SELECT host FROM split WHERE host <> '' GROUP BY host
            HAVING count(*) FILTER (WHERE contains(url, 'utm_')) >= 0.2 * count(*)),
        rules(what, name, start) AS (
            VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
                   ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
        fitting AS (
            SELECT page_id, arg_max(name || start, length(name || start)) AS rule,
                   arg_max(what, length(name || start)) AS what
            FROM split JOIN rules
              ON (host = name OR ends_with(host, '.' || name)) AND starts_with(path, start)
            GROUP BY page_id)
        SELECT s.page_id, s.host, s.path, f.rule,
               coalesce(f.what, CASE WHEN s.host IN (SELECT host FROM listed) THEN 'block' ELSE 'allow' END) AS verdict
        FROM split s LEFT JOIN fitting f USING (page_id)
    """,
    "op8_top_vectors": """
        WITH impacts AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scores AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
            FROM impacts q JOIN impacts c ON c.vec_id <> q.vec_id
            WHERE q.vec_id % 20 = 0)
        SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
               vec_id, score
        FROM scores
        QUALIFY rank <= 20
    """,
    "op5_repeated_bytes": """
        WITH docs AS (
            SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, '')))::BIGINT AS n
            FROM documents),
        windows AS (
            SELECT doc_id, i, substr(h, 2 * i + 1, 200) AS s
            FROM (SELECT doc_id, h, unnest(range(0, n - 99)) AS i FROM docs WHERE n >= 100)),
        repeated AS (
            SELECT doc_id, i
            FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS nth FROM windows)
            WHERE nth > 1),
        runs AS (
            SELECT doc_id, min(i) AS a, max(i) + 100 AS b
            FROM (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run
                  FROM (SELECT doc_id, i,
                               (i > coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), -1000) + 100)::INTEGER AS new
                        FROM repeated))
            GROUP BY doc_id, run),
        parts AS (
            SELECT r.doc_id, a, b, substr(h, 2 * before + 1, 2 * (a - before)) AS part
            FROM (SELECT *, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM runs) r
            JOIN docs USING (doc_id)),
        cut AS (
            SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans,
                   string_agg(part, '' ORDER BY a) AS front, max(b) AS last
            FROM parts GROUP BY doc_id)
        SELECT d.doc_id, d.n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
               sha256(unhex(CASE WHEN c.doc_id IS NULL THEN h ELSE front || substr(h, 2 * last + 1) END)) AS kept_sha256
        FROM docs d LEFT JOIN cut c USING (doc_id)
    """,
    "op6_vector_links": """
        WITH RECURSIVE usable AS (
            SELECT vec_id, label, embedding::DOUBLE[] AS v
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        edges AS (
            SELECT a.vec_id AS x, b.vec_id AS y
            FROM usable a JOIN usable b ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
            WHERE list_inner_product(a.v, b.v)
                  / (sqrt(list_inner_product(a.v, a.v)) * sqrt(list_inner_product(b.v, b.v))) >= 0.93),
        reached(vec_id, other) AS (
            SELECT vec_id, vec_id FROM embeddings
            UNION
            SELECT r.vec_id, e.y FROM reached r JOIN edges e ON r.other = e.x),
        lowest AS (SELECT vec_id, min(other) AS component_id FROM reached GROUP BY vec_id),
        degrees AS (SELECT x AS vec_id, count(*) AS n FROM edges GROUP BY x)
        SELECT l.vec_id, coalesce(n, 0) AS n_links, component_id, l.vec_id = component_id AS kept
        FROM lowest l LEFT JOIN degrees USING (vec_id)
    """,
    "op10_minhash_groups": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id,
                   regexp_extract_all(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        shingles AS (
            SELECT DISTINCT doc_id, s
            FROM (SELECT doc_id,
                         unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                                ELSE list_transform(range(1, len(w) - 2),
                                                    lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s
                  FROM words)),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        common AS (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k
            FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id
            GROUP BY a.doc_id, b.doc_id),
        links AS (
            SELECT x, y FROM common JOIN sizes sx ON sx.doc_id = x JOIN sizes sy ON sy.doc_id = y
            WHERE 100 * k >= 80 * (sx.n + sy.n - k)),
        edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
        reached(doc_id, other) AS (
            SELECT doc_id, doc_id FROM documents
            UNION
            SELECT r.doc_id, e.y FROM reached r JOIN edges e ON r.other = e.x),
        lowest AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
        SELECT l.doc_id, coalesce(n, 0) AS n_shingles, component_id, l.doc_id = component_id AS kept
        FROM lowest l LEFT JOIN sizes USING (doc_id)
    """,
}
