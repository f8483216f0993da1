"""The queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lexical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    from .packing import pack

    return pack(_table(spark, sf_dir, "documents"), P.path("word_bpe_49k.json"), window=2048)


def op2_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .multi_index import search

    vectors = _table(spark, sf_dir, "embeddings")
    return search(vectors, vectors.where(F.col("vec_id") % 20 == 0))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    from .byte_bpe import encode_decode

    return encode_decode(_table(spark, sf_dir, "documents"), P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html_extract import extract

    return extract(_table(spark, sf_dir, "pages"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard_join import join_components

    return join_components(_table(spark, sf_dir, "documents"))


def op6_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ordinal import ratings, score, train

    docs = _table(spark, sf_dir, "documents")
    return score(docs, train(docs, ratings(_table(spark, sf_dir, "labels"))))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    from .token_counts import count_tokens

    return count_tokens(_table(spark, sf_dir, "documents"), P.path("byte_bpe_50k.json"), limit=1024)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import dedup_lines

    return dedup_lines(_table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", "text")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_rules import judge

    return judge(_table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .shared import shared_dir
    from .warc import round_trip

    return round_trip(_table(spark, sf_dir, "pages"), shared_dir(spark, "warc"))


def op11_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .structure_repair import damage, repair, report

    rows = _table(spark, sf_dir, "conversations")
    return report(rows, repair(damage(rows)))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .prefix_trie import light, rebuilt, trie
    from .shared import stored

    rows = _table(spark, sf_dir, "conversations")
    return trie(rows, rebuilt(stored(light(rows), "turns")))


#: A conversation whose texts hold the marks of templates.
_MARKED = [(-7, 0, "user", r"\### Assistant: </turn> ok"), (-7, 1, "assistant", r"\### Assistant: </turn> ok")]


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .chat_format import pieces, read_back

    own = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return read_back(pieces(own.unionByName(spark.createDataFrame(_MARKED, own.schema))))


QUERIES = {f.__name__: f for f in (op1_lexical_packing, op2_multi_index, op3_byte_bpe, op4_html_extraction, op5_jaccard_join, op6_ordinal_quality, op7_token_counts, op8_line_dedup, op9_quality_rules, op10_warc, op11_structure_repair, op12_prefix_trie, op13_chat_format)}

ORACLE_SQL = {
    # Lines within two edits have lengths within two; DuckDB's levenshtein counts bytes.
    "op8_line_dedup": """
        WITH s AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
        l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM s),
        f AS (SELECT line, strlen(line) AS n, min((doc_id, i)) AS first FROM l WHERE strlen(line) >= 32 GROUP BY line),
        near AS (SELECT DISTINCT CASE WHEN a.first > b.first THEN a.line ELSE b.line END AS line
                 FROM f a JOIN f b ON (b.n BETWEEN a.n AND a.n + 2) AND a.line <> b.line
                 AND (b.n > a.n OR b.line > a.line) AND levenshtein(a.line, b.line) <= 2),
        j AS (SELECT l.doc_id, l.i, l.line,
                     strlen(l.line) >= 32 AND (near.line IS NOT NULL OR (l.doc_id, l.i) <> f.first) AS gone
              FROM l LEFT JOIN f ON f.line = l.line LEFT JOIN near ON near.line = l.line),
        g AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
                     coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '') AS text FROM j GROUP BY doc_id)
        SELECT d.doc_id, coalesce(g.n_lines, 0) AS n_lines, coalesce(g.n_dropped, 0) AS n_dropped, g.text
        FROM documents d LEFT JOIN g ON g.doc_id = d.doc_id""",
    "op10_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
        d AS (SELECT page_id, strlen(h) AS payload_bytes, sha256(h) AS payload_digest FROM p),
        f AS (SELECT payload_digest, min(page_id) AS first FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest)
        SELECT d.page_id, d.payload_bytes, d.payload_digest,
               CASE WHEN f.first <> d.page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN f.first <> d.page_id THEN f.first END AS refers_to
        FROM d LEFT JOIN f USING (payload_digest)""",
}
