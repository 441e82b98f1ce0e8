"""The registered queries of this subpackage, each beside its SQL twin if SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import (
    chat,
    decontaminate,
    fingerprints,
    jaccard,
    language,
    neighbours,
    order,
    packing,
    privacy,
    suffixes,
    trie,
    units,
    whitening,
)

ORDER_KEY = 20_240_601
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def op3_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_duplicates(_table(spark, folder, "documents"))


def op1_private_data(spark: SparkSession, folder: str) -> DataFrame:
    return privacy.report(privacy.find_private(_table(spark, folder, "documents").select("doc_id", "text")))


def op4_repeated_units(spark: SparkSession, folder: str) -> DataFrame:
    found = units.drop_repeated_units(_table(spark, folder, "documents"))
    spans = F.transform("removed", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string")))
    chars = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_units",
        F.size("removed").cast("long").alias("n_removed"),
        chars.alias("removed_chars"),
        F.array_join(spans, ",").alias("removed"),
        F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"),
    )


def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find_leaks(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op6_nearest(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings")
    return neighbours.nearest(vectors, vectors.filter("vec_id % 100 = 0"))


def op8_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = suffixes.drop_repeated_strings(_table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["to"] - s["from"]).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    texts = docs.select("doc_id", "text")
    found = language.identify(texts, language.learn(docs))
    return found.select(
        "doc_id", language.held_out().alias("held_out"), "lang_pred", F.col("lang_score").alias("score")
    )


def op2_training_order(spark: SparkSession, folder: str) -> DataFrame:
    sequences = order.materialise(_table(spark, folder, "documents"), VOCABULARY, ORDER_KEY)
    return packing.checksums(sequences)


def op9_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    given = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], given.schema)
    return chat.digests(chat.format_chats(chat.canonical_turns(given.unionByName(more))))


_TURNS = r"""(SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')"""
_ESCAPED = "replace(replace(replace(text, '\\', '\\b'), '##', '#\\h'), '</turn>', '\\l/turn>')"
OP9_SQL = f"""SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(length({_ESCAPED}) + 14 + CASE role WHEN 'user' THEN 4 WHEN 'assistant' THEN 9 ELSE 6 END) AS BIGINT)
        AS formatted_chars
    FROM {_TURNS} GROUP BY conv_id"""


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.checksums(packing.pack(_table(spark, folder, "documents"), VOCABULARY))
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    turns = trie.placed(trie.coded_turns(_table(spark, folder, "conversations")))
    return trie.prefix_trie(*trie.grafted(turns))


# DuckDB has no CRC-32, so it is spelled out; prefixes are lists of turns, and subtrees are told by their beginning.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''),
    lambda x: ascii(x)::BIGINT)), lambda s, x: list_reduce(list_prepend(xor(s, x), range(8)),
    lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384::BIGINT) ELSE v // 2 END)), 4294967295::BIGINT)"""
OP11_SQL = f"""WITH turns AS (SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
        sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS code
        FROM conversations WHERE conv_id IS NOT NULL),
    placed AS (SELECT c, code, strlen(text) AS size,
        row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, code) AS place FROM turns),
    convs AS (SELECT c, c - c % 5 AS base, {_CRC} % 9 AS h FROM (SELECT DISTINCT c FROM placed)),
    made AS (SELECT v.c, p.place, 0 AS own, p.code, p.size FROM convs v JOIN placed p ON p.c = v.base AND p.place <= v.h
        UNION ALL SELECT v.c, p.place, 1, p.code, p.size FROM convs v JOIN placed p ON p.c = v.c AND p.place > v.h),
    paths AS (SELECT c, list(code ORDER BY own, place) AS path, list(size ORDER BY own, place) AS sizes FROM made GROUP BY c
        UNION ALL SELECT c, [], [] FROM convs WHERE c NOT IN (SELECT c FROM made)),
    members AS (SELECT c, d, path[1:d] AS node, len(path) = d AS ends, coalesce(sizes[d], 0) AS size
        FROM (SELECT c, path, sizes, unnest(range(len(path) + 1)) AS d FROM paths)),
    nodes AS (SELECT node, d, min(c) AS c, count(*) AS n, any_value(size) AS size, bool_and(ends) AS leaf,
        sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends FROM members GROUP BY node, d),
    below AS (SELECT m.node, count(*) FILTER (v.d = m.d + 1) AS children, count(*) FILTER (v.leaf) AS leaves,
        sum((v.n - 1) * v.size) AS saved FROM nodes v JOIN members m ON m.c = v.c AND m.d <= v.d GROUP BY m.node)
    SELECT n.c AS conv_id, n.d AS depth, up.c AS parent_conv_id, n.n AS n_convs, children AS n_children,
        leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, n.ends AS ends_sha256
    FROM nodes n JOIN below b ON b.node = n.node LEFT JOIN nodes up ON n.d > 0 AND up.node = n.node[1:n.d - 1]"""


def op12_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    found = fingerprints.compare_edited(_table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprints.rendered(F.col("fingerprint")).alias("fingerprint"),
        fingerprints.rendered(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.by_component(whitening.whiten(_table(spark, folder, "embeddings")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_private_data": op1_private_data,
    "op2_training_order": op2_training_order,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_repeated_units": op4_repeated_units,
    "op5_decontamination": op5_decontamination,
    "op6_nearest": op6_nearest,
    "op7_language_id": op7_language_id,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_chat_formatting": op9_chat_formatting,
    "op10_packing": op10_packing,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_fingerprints": op12_fingerprints,
    "op13_whitening": op13_whitening,
}

SQL: dict[str, str] = {"op9_chat_formatting": OP9_SQL, "op11_prefix_trie": OP11_SQL}
