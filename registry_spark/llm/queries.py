"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry_spark.llm.bpe import round_trip
from registry_spark.llm.collocations import Collocations
from registry_spark.llm.language import identify, train
from registry_spark.llm.mixing import mix
from registry_spark.llm.near_duplicates import near_duplicates
from registry_spark.llm.neural import scored
from registry_spark.llm.packing import Packing
from registry_spark.llm.prefix_trie import PrefixTrie
from registry_spark.llm.quality import judged
from registry_spark.llm.quotations import reply_order
from registry_spark.llm.repeats import Repeats
from registry_spark.llm.tasks import id_remainder
from registry_spark.llm.token_files import read_token_files, write_token_files
from registry_spark.llm.top_k import top_k
from registry_spark.sources.shared import shared_folder, written

BYTE_BPE, WORD_BPE = "byte_bpe_50k.json", "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of every document under a unigram and a log-bilinear model of nine tenths of them."""
    documents = table(spark, sf_dir, "documents").withColumn("held_out", id_remainder(F.col("doc_id"), 10) == 0)
    return scored(documents, documents.filter("NOT held_out"), keep=["doc_id", "held_out"])


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    taken = mix(table(spark, sf_dir, "documents")).taken()
    return taken.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents written to seekable zstandard files in doc_id order and read back."""
    folder = shared_folder(spark)
    path = public_tokenizers.path(BYTE_BPE)
    manifest = written(write_token_files(table(spark, sf_dir, "documents"), f"{folder}/ids", path, end_id=2))
    return read_token_files(spark, [tuple(r) for r in manifest.collect()])


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again; digests of both."""
    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


def op5_quotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All messages without quotations, placed among the replies."""
    return reply_order(table(spark, sf_dir, "conversations"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the verdict on every document."""
    rows, _ = judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return rows.select(*base, "score")


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty nearest vectors of every twentieth one."""
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, F.col("vec_id") % 20 == 0, 20, transform=lambda x: F.floor(64 * x))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share four fifths of their two-word shingles."""
    return near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80)


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from three quarters of them."""
    documents = table(spark, sf_dir, "documents").withColumn("held_out", id_remainder(F.col("doc_id"), 4) == 2)
    model = train(documents.filter("NOT held_out"))
    return identify(documents, model, keep=["doc_id", "held_out"])


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What 200-byte strings met more than once leave of every document."""
    return Repeats(table(spark, sf_dir, "documents"), length=200).result()


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of conversations that begin with some turns of every twentieth one."""
    conv = F.col("conv_id")
    first = F.crc32(conv.cast("string").cast("binary")) % 4
    return PrefixTrie(table(spark, sf_dir, "conversations"), shared=(conv - conv % 20, first)).with_digests()


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2,048 ids."""
    return Packing(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE), end_id=0).rows.withColumnRenamed("id", "doc_id")


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 phrases of each language that hold together best."""
    return Collocations(table(spark, sf_dir, "documents"), longest=4, least=30).top(2_000, share=80)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_scoring": op1_scoring,
    "op2_mixing": op2_mixing,
    "op3_token_files": op3_token_files,
    "op4_bpe": op4_bpe,
    "op5_quotations": op5_quotations,
    "op6_quality": op6_quality,
    "op7_top_k": op7_top_k,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_language": op9_language,
    "op10_repeats": op10_repeats,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_packing": op12_packing,
    "op13_phrases": op13_phrases,
}

ORACLES: dict[str, str] = {
    "op11_prefix_trie": r"""
        WITH t AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
            FROM conversations WHERE conv_id IS NOT NULL
        ), c AS (
            SELECT DISTINCT conv_id, conv_id - conv_id % 20 AS base,
                   xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT),
                       lambda acc, b: list_reduce([xor(acc, b)] || [0::BIGINT, 0, 0, 0, 0, 0, 0, 0],
                           lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)), 4294967295) % 4 AS h
            FROM t
        ), r AS (
            SELECT c.conv_id, 0 AS own, pos, role, text FROM c JOIN t ON t.conv_id = c.base AND t.pos < c.h
            UNION ALL
            SELECT c.conv_id, 1, pos, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos >= c.h
        ), q AS (
            SELECT c.conv_id, coalesce(list(md5(len(role) || ':' || role || text) ORDER BY own, pos) FILTER (pos IS NOT NULL), []) AS turns,
                   coalesce(list(len(list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '')) ORDER BY own, pos) FILTER (pos IS NOT NULL), []) AS words
            FROM c LEFT JOIN r USING (conv_id) GROUP BY c.conv_id
        ), m AS (
            SELECT conv_id, len(turns) AS length, unnest(list_transform(range(len(turns) + 1), lambda d: {'depth': d, 'path': array_to_string(turns[1:d], ''), 'words': coalesce(words[d], 0)}), recursive := TRUE) FROM q
        ), n AS (
            SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
                   sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (length = depth), '')) AS ends_sha256
            FROM m GROUP BY path, depth
        ), k AS (
            SELECT path[1:32 * (depth - 1)] AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1
        ), u AS (
            SELECT unnest(list_transform(range(depth + 1), lambda d: path[1:32 * d])) AS path, (n_convs - 1) * words AS saved, CASE WHEN n_children IS NULL THEN 1 ELSE 0 END AS leaf
            FROM n LEFT JOIN k USING (path)
        ), s AS (
            SELECT path, sum(saved)::BIGINT AS saved_tokens, sum(leaf)::BIGINT AS n_leaves FROM u GROUP BY path
        )
        SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, n.ends_sha256
        FROM n JOIN s USING (path) LEFT JOIN k USING (path) LEFT JOIN n AS p ON n.depth > 0 AND p.path = n.path[1:32 * (n.depth - 1)]
    """,
    "op13_phrases": r"""
        WITH d AS (
            SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
        ), pieces AS (
            SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d
        ), w AS (
            SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
        ), g AS (
            SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) AS g FROM w, (VALUES (1), (2), (3), (4)) AS v(k) WHERE len(w) >= k
        ), f AS (
            SELECT lang, k, array_to_string(g, ' ') AS phrase, any_value(g) AS g, count(*) AS f FROM g GROUP BY 1, 2, 3
        ), n AS (
            SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang
        ), c AS (
            SELECT * FROM f WHERE k > 1 AND f >= 30
        ), cuts AS (
            SELECT lang, phrase, f AS a, array_to_string(g[1:cut], ' ') AS left_part, array_to_string(g[cut + 1:], ' ') AS right_part, cut
            FROM (SELECT *, unnest(range(1, k)) AS cut FROM c)
        ), scored AS (
            SELECT cuts.lang, cuts.phrase, a, x.f AS l, y.f AS r, ((2000000::HUGEINT * a) // (x.f + y.f))::BIGINT AS score, cut
            FROM cuts JOIN f AS x ON x.lang = cuts.lang AND x.phrase = left_part JOIN f AS y ON y.lang = cuts.lang AND y.phrase = right_part
        ), weakest AS (
            SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
        ), inner_parts AS (
            SELECT lang, f, unnest(flatten(list_transform(range(2, k), lambda n: list_transform(range(1, k - n + 2), lambda i: array_to_string(g[i:i + n - 1], ' '))))) AS phrase FROM c
        ), most AS (
            SELECT lang, phrase, max(f) AS most FROM inner_parts GROUP BY 1, 2
        ), kept AS (
            SELECT weakest.* FROM weakest LEFT JOIN most USING (lang, phrase) WHERE most IS NULL OR 100 * most < 80 * a
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
        )
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
    """,
    "op8_near_duplicates": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
            FROM documents
        ), s AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 2 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) ELSE w END) AS shingle FROM d
        ), n AS (
            SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
        ), pairs AS (
            SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS both_have FROM s AS x JOIN s AS y ON x.shingle = y.shingle AND x.doc_id < y.doc_id GROUP BY 1, 2
        ), links AS (
            SELECT a, b FROM pairs JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b WHERE 100 * both_have >= 80 * (x.n + y.n - both_have)
        ), walk AS (
            SELECT doc_id, doc_id AS reached FROM documents
            UNION
            SELECT doc_id, CASE WHEN a = reached THEN b ELSE a END FROM walk JOIN links ON a = reached OR b = reached
        )
        SELECT doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(reached) AS component_id, doc_id = min(reached) AS kept
        FROM walk LEFT JOIN n USING (doc_id) GROUP BY doc_id
    """,
    "op5_quotations": r"""
        WITH RECURSIVE m AS (
            SELECT *, md5(coalesce(text, '')) AS k, coalesce(regexp_matches(text, '(?m)^[ \t>]*>'), FALSE) AS quoting FROM conversations
        ), d AS (
            SELECT DISTINCT conv_id, turn, k, text FROM m
            WHERE turn IS NOT NULL AND text IS NOT NULL AND conv_id IN (SELECT conv_id FROM m WHERE quoting AND turn IS NOT NULL)
        ), lines AS (
            SELECT conv_id, turn, k, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM d
        ), parsed AS (
            SELECT conv_id, turn, k, pos, len(replace(regexp_extract(line, '^[ \t>]*>'), ' ', '')) - len(replace(replace(regexp_extract(line, '^[ \t>]*>'), ' ', ''), '>', '')) AS depth,
                   trim(regexp_replace(lower(regexp_replace(line, '^[ \t>]*>', '')), '[ \t\r]+', ' ', 'g')) AS words
            FROM lines
        ), turned AS (
            SELECT *, CASE WHEN depth = lag(depth) OVER (PARTITION BY conv_id, turn, k ORDER BY pos) THEN 0 ELSE 1 END AS changed FROM parsed
        ), runs AS (
            SELECT *, sum(changed) OVER (PARTITION BY conv_id, turn, k ORDER BY pos) AS run FROM turned
        ), units AS (
            SELECT conv_id, turn, k, run, depth, 0 AS kind, 0 AS pos, string_agg(words, ' ' ORDER BY pos) AS words
            FROM runs WHERE words <> '' GROUP BY conv_id, turn, k, run, depth
            UNION ALL
            SELECT conv_id, turn, k, run, depth, 1, pos, words FROM runs WHERE len(string_split(words, ' ')) >= 4
        ), origins AS (
            SELECT conv_id, words, min(turn) AS origin FROM units WHERE depth = 0 GROUP BY conv_id, words
        ), links AS (
            SELECT u.conv_id, u.turn, u.k, run, depth, arg_min(origin, kind * 1000000000 + pos) FILTER (origin < u.turn) AS origin
            FROM units AS u LEFT JOIN origins AS o ON u.conv_id = o.conv_id AND u.words = o.words
            WHERE depth > 0 GROUP BY u.conv_id, u.turn, u.k, run, depth
        ), message AS (
            SELECT conv_id, turn, k, count(*) AS n_quotes, count(origin) AS n_linked, max(depth) AS max_depth,
                   arg_min(origin, depth * 1000000000 + run) FILTER (origin IS NOT NULL) AS parent
            FROM links GROUP BY conv_id, turn, k
        ), parents AS (
            SELECT conv_id, turn, min(parent) AS parent FROM message GROUP BY conv_id, turn HAVING min(parent) IS NOT NULL
        ), chain AS (
            SELECT conv_id, turn, parent AS top, 1 AS steps FROM parents
            UNION ALL
            SELECT c.conv_id, c.turn, p.parent, steps + 1 FROM chain AS c JOIN parents AS p ON c.conv_id = p.conv_id AND c.top = p.turn
        ), tops AS (
            SELECT conv_id, turn, min(top) AS top, max(steps) AS steps FROM chain GROUP BY conv_id, turn
        )
        SELECT m.conv_id, m.turn, m.role, coalesce(n_quotes, 0) AS n_quotes, coalesce(n_linked, 0) AS n_linked,
               CAST(coalesce(max_depth, 0) AS BIGINT) AS max_depth, p.parent AS parent_turn, coalesce(t.top, m.turn) AS thread_turn,
               CAST(coalesce(t.steps, 0) AS BIGINT) AS reply_depth,
               CASE WHEN quoting THEN trim(regexp_replace(m.text, '(?m)^[ \t>]*>[^\n]*(?:\n|$)', '', 'g'), chr(10)) ELSE m.text END AS text
        FROM m LEFT JOIN message AS q ON m.conv_id = q.conv_id AND m.turn = q.turn AND m.k = q.k
        LEFT JOIN parents AS p ON m.conv_id = p.conv_id AND m.turn = p.turn
        LEFT JOIN tops AS t ON m.conv_id = t.conv_id AND m.turn = t.turn
    """,
    "op7_top_k": """
        WITH v AS (
            SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.e, v.e) AS BIGINT) AS score
            FROM v AS q JOIN v ON q.vec_id <> v.vec_id AND len(q.e) = len(v.e)
            WHERE q.vec_id % 20 = 0
        ), ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
    """,
}
