"""The queries of this subpackage, each over whole tables and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelworks.llm import align, ann, decontam, neardup, packing, pivotdedup, prefixtrie, quality, store, suffixdedup, tokencount, tokenfile, toxicity, warc

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary(name: str) -> str:
    """The content of a public tokenizer file; the driver reads it and sends it along."""
    with open(public_tokenizers.path(name), encoding="utf-8") as held:
        return held.read()


def model(name: str) -> bytes:
    """The content of a public model file."""
    with open(public_tokenizers.path(name), "rb") as held:
        return held.read()


def held_out(modulus: int, remainder: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus)) == remainder


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes covered by a 400-byte string that also starts elsewhere, removed from every document."""
    return suffixdedup.removal_report(store.read(spark, sf_dir, "documents"))


def op2_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut into pieces and placed in sequences of at most 1024 tokens."""
    return packing.packed(store.read(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of benchmark windows in every document."""
    return decontam.contamination(store.read(spark, sf_dir, "documents"), store.read(spark, sf_dir, "benchmark"))


def op4_random_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows found for every row whose id is divisible by 20, against all rows."""
    rows = store.read(spark, sf_dir, "embeddings")
    return ann.nearest(rows, rows.filter("vec_id % 20 = 0"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document."""
    return tokencount.token_counts(store.read(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; labels with crc32(doc_id) mod 3 = 1 are held out."""
    docs, labels = store.read(spark, sf_dir, "documents"), store.read(spark, sf_dir, "labels")
    network = quality.fit(docs, labels.filter(~held_out(3, 1)))
    return quality.score(docs, network).select("doc_id", held_out(3, 1).alias("held_out"), "score", "predicted")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as shards of token ids and read back from them."""
    docs = store.read(spark, sf_dir, "documents")
    folder = store.shared_path(spark, "token-ids")
    return tokenfile.read_shards(tokenfile.write_shards(docs, vocabulary("word_bpe_49k.json"), folder))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; labels with crc32(doc_id) mod 5 = 0 are held out."""
    docs, labels = store.read(spark, sf_dir, "documents"), store.read(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.filter(~held_out(5, 0)))
    return toxicity.score(docs, model).select("doc_id", held_out(5, 0).alias("held_out"), "score", "predicted")


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return neardup.near_duplicates(store.read(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC bundles and read back from them."""
    pages = store.read(spark, sf_dir, "pages")
    return warc.read_bundles(warc.write_bundles(pages, store.shared_path(spark, "warc")))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nodes of the prefix trie over all conversations, whose heads are shared by blocks of 100 ids."""
    turns = prefixtrie.numbered(store.read(spark, sf_dir, "conversations"))
    return prefixtrie.node_report(prefixtrie.trie(*prefixtrie.with_shared_heads(*turns)))


def op12_pivot_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all vectors, inside their labels."""
    return pivotdedup.near_vectors(store.read(spark, sf_dir, "embeddings"))


def op13_lockstep_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level and sentence-piece tokens of every document, aligned and counted."""
    return align.alignment(store.read(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), model("piece_bpe_32k.model"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_suffix_dedup,
        op2_pattern_packing,
        op3_decontamination,
        op4_random_projection_forest,
        op5_token_counts,
        op6_quality,
        op7_token_files,
        op8_toxicity,
        op9_minhash,
        op10_warc,
        op11_prefix_trie,
        op12_pivot_dedup,
        op13_lockstep_alignment,
    )
}

#: Held-out labels are known to SQL, and so is what it takes to tell responses from revisits.
ORACLE: dict[str, str] = {
    "op10_warc": """
        WITH p AS (
            SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
        ), d AS (
            SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest FROM p
        ), g AS (
            SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS largest FROM d
        )
        SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
            CASE WHEN payload_bytes >= 1000 AND page_id <> largest THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN payload_bytes >= 1000 AND page_id <> largest THEN largest END AS refers_to
        FROM g
    """,
    "op11_prefix_trie": """
        WITH t AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos
            FROM conversations WHERE conv_id IS NOT NULL
        ), c AS (
            SELECT conv_id, conv_id - conv_id % 100 AS base, count(*) AS n,
                xor(list_reduce(
                    list_concat([4294967295], flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
                        lambda x: [ascii(x), -1, -1, -1, -1, -1, -1, -1, -1]))),
                    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END
                ), 4294967295) % 6 AS h
            FROM t GROUP BY conv_id
        ), r AS (
            SELECT c.conv_id, b.pos, b.role, b.text FROM c JOIN t AS b ON b.conv_id = c.base AND b.pos < c.h
            UNION ALL
            SELECT c.conv_id, t.pos - c.h + least(c.h, coalesce(d.n, 0)), t.role, t.text
            FROM t JOIN c ON c.conv_id = t.conv_id LEFT JOIN c AS d ON d.conv_id = c.base WHERE t.pos >= c.h
        ), p AS (
            SELECT conv_id, pos + 1 AS depth, length(text) AS chars,
                md5(string_agg(md5(octet_length(encode(role)) || ':' || role || text), ',') OVER (PARTITION BY conv_id ORDER BY pos)) AS node
            FROM r
        ), a AS (
            SELECT conv_id, depth, chars, node, coalesce(lag(node) OVER (PARTITION BY conv_id ORDER BY depth), 'root') AS parent FROM p
            UNION ALL
            SELECT conv_id, 0, 0, 'root', NULL FROM c
        ), n AS (
            SELECT node, depth, any_value(parent) AS parent, any_value(chars) AS chars, min(conv_id) AS conv_id, count(*) AS n_convs
            FROM a GROUP BY node, depth
        ), k AS (
            SELECT parent AS node, count(*) AS n_children FROM n GROUP BY parent
        ), w AS (
            SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (node)
        ), s AS (
            SELECT top, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * chars) AS saved_tokens
            FROM (SELECT DISTINCT x.node AS top, y.node FROM a AS x JOIN a AS y ON x.conv_id = y.conv_id AND y.depth >= x.depth) AS u
            JOIN w USING (node) GROUP BY top
        ), e AS (
            SELECT node, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids
            FROM (SELECT conv_id, arg_max(node, depth) AS node FROM a GROUP BY conv_id) AS z GROUP BY node
        )
        SELECT w.conv_id, CAST(w.depth AS BIGINT) AS depth, o.conv_id AS parent_conv_id, w.n_convs, w.n_children,
            CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens,
            sha256(coalesce(e.ids, '')) AS ends_sha256
        FROM w JOIN s ON s.top = w.node LEFT JOIN w AS o ON o.node = w.parent LEFT JOIN e ON e.node = w.node
    """,
}
