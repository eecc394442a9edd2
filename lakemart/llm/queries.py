"""Registered queries of the text operators, over the whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, conversation_repair, cotraining, hmm_lm, minhash, packing, periodic_runs, pii, quality_rules, suffix_dedup, toxicity
from .common import documents, prepare, store
from .exact_dedup import exact_dedup


WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded, and decoded again."""
    coded = bpe.encode(documents(spark, sf_dir), BYTE_BPE, public_tokenizers.PATTERN)
    return bpe.decode(coded, BYTE_BPE).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text judged by the base and by learned rules."""
    docs = documents(spark, sf_dir)
    rules = quality_rules.learn_rules(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    judged = quality_rules.apply_rules(docs, rules)
    counts = [F.col(f"counts.{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return judged.select("doc_id", *counts, "base_failed", "kept")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every text; a quarter of the ids teaches nothing."""
    docs = documents(spark, sf_dir)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    scored = toxicity.learn_and_score(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), ~held_out)
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
        F.size("spans").cast("long").alias("n_spans"),
        F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",").alias("spans"),
    )


def packed_documents(docs: DataFrame) -> DataFrame:
    """All texts of ``docs`` as token pieces in sequences of 4096."""
    pieces = packing.tokenize_pieces(docs, WORD_BPE)
    return packing.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text as token pieces, packed into as few sequences as can be found."""
    return packed_documents(documents(spark, sf_dir))


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies of five-word shingles, similarity 0.85 or more."""
    return minhash.near_duplicates(documents(spark, sf_dir))


def op6_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document from its content and its metadata."""
    features = store(cotraining.features_of(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return cotraining.score_features(features, cotraining.learn_from(features))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of 200-byte strings that occur more than once are removed."""
    done = suffix_dedup.remove_repeats(documents(spark, sf_dir), per_text={"kept_sha256": F.sha2("kept", 256)})
    return done.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one that holds control strings, rendered and read back."""
    turns = prepare(spark).read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    tricky = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema)
    return chat.conversation_digests(chat.format_conversations(turns.unionByName(tricky)))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of a text: the row with the largest id stays."""
    docs = documents(spark, sf_dir)
    return exact_dedup(docs, per_text={"text_sha256": F.sha2(F.col("text"), 256)})


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every text."""
    found = pii.find_pii(documents(spark, sf_dir))
    counts = [pii.number_of("spans", k).alias(f"n_{k}") for k in pii.BASE]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(pii.joined("spans", pii.BASE), 256).alias("base_sha256"),
        pii.joined("spans", pii.KINDS).alias("spans"),
    )


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every text, after some are planted in a tenth of them."""
    return periodic_runs.digests(periodic_runs.periodic_runs(documents(spark, sf_dir), change=periodic_runs.planted))


def op12_hmm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability of every text under a language model of six sevenths of them."""
    return hmm_lm.model_scores(documents(spark, sf_dir), F.crc32(F.col("doc_id").cast("string")) % 7 == 2)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged conversations, mended at the least cost."""
    spoilt = conversation_repair.damage(prepare(spark).read.parquet(f"{sf_dir}/conversations.parquet"))
    return conversation_repair.audit(conversation_repair.repair_conversations(spoilt, present=~F.col("dropped")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_quality_rules": op2_quality_rules,
    "op3_toxicity": op3_toxicity,
    "op4_packing": op4_packing,
    "op5_minhash": op5_minhash,
    "op6_cotraining": op6_cotraining,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_chat_format": op8_chat_format,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_pii": op10_pii,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_hmm_scores": op12_hmm_scores,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLE_SQL: dict[str, str] = {
    "op8_chat_format": r"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
        ), sized AS (
            SELECT *,
                   length(replace(text, '\', '\\')) + len(regexp_extract_all(text, '<\||<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>'))
                   + length(replace(role, '\', '\\')) + len(regexp_extract_all(role, '<\||<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>'))
                   + length('<|turn|><|text|><|end|>') AS chars
            FROM turns
        )
        SELECT conv_id,
               count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(chars) AS BIGINT) AS formatted_chars
        FROM sized GROUP BY conv_id
    """,
    "op9_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER w AS keep_id,
               count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW w AS (PARTITION BY coalesce(text, ''))
    """,
    "op13_conversation_repair": r"""
        WITH RECURSIVE keyed AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
            FROM conversations
        ), kinds AS (
            SELECT *, xor(4294967295, list_reduce(
                       list_transform(string_split(key, ''), lambda c: CAST(ascii(c) AS BIGINT)),
                       lambda s, b: list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
                           lambda x, z: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END, xor(s, b)),
                       CAST(4294967295 AS BIGINT))) % 20 AS kind
            FROM keyed
        ), spoilt AS (
            SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                   CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                   unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
            FROM kinds WHERE kind <> 0
        ), numbered AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
                   row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
                   regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS last
            FROM spoilt
        ), judged AS (
            SELECT *, CASE WHEN last = '' THEN 1 WHEN nth > 1 THEN 2 WHEN last NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
                   left(role, 1) AS initial
            FROM numbered
        ), priced AS (
            SELECT *, CASE WHEN fault IN (1, 2) THEN 1000000000 WHEN fault = 3 THEN 3 ELSE 0 END AS stay,
                   CASE WHEN initial = 'u' THEN 0 ELSE 1000000000 END AS no_u,
                   CASE WHEN initial = 'a' THEN 0 ELSE 1000000000 END AS no_a,
                   CASE WHEN initial = 's' THEN 0 ELSE 1000000000 END AS no_s
            FROM judged
        ), ends AS (
            SELECT conv_id, max(i) AS n FROM priced GROUP BY conv_id
        ), togo AS (
            SELECT conv_id, n AS i, CAST(0 AS BIGINT) AS f0, CAST(6 AS BIGINT) AS f1, CAST(3 AS BIGINT) AS f2, CAST(0 AS BIGINT) AS f3,
                   CAST(0 AS BIGINT) AS g0, CAST(0 AS BIGINT) AS g1, CAST(0 AS BIGINT) AS g2, CAST(0 AS BIGINT) AS g3
            FROM ends
            UNION ALL
            SELECT conv_id, i, least(g0, 3 + least(g2, 3 + g3)), least(g1, 3 + least(g2, 3 + g3)), least(g2, 3 + g3), least(g3, 3 + g2), g0, g1, g2, g3
            FROM (
                SELECT t.conv_id, t.i - 1 AS i,
                       least(4 + f0, stay + least(no_s + f1, no_u + f2, 3 + f2)) AS g0,
                       least(4 + f1, stay + least(no_u + f2, 3 + f2)) AS g1,
                       least(4 + f2, stay + least(no_a + f3, 3 + f3)) AS g2,
                       least(4 + f3, stay + least(no_u + f2, 3 + f2)) AS g3
                FROM togo t JOIN priced p ON p.conv_id IS NOT DISTINCT FROM t.conv_id AND p.i = t.i
            )
        ), graph AS (  -- for each row, state and way to leave it: the cost and the cost-to-go after it
            SELECT conv_id, i, unnest([
                       {'q': 0, 'f': f0, 'insert': f2, 'then': 2}, {'q': 1, 'f': f1, 'insert': f2, 'then': 2},
                       {'q': 2, 'f': f2, 'insert': f3, 'then': 3}, {'q': 3, 'f': f3, 'insert': f2, 'then': 2}]) AS s
            FROM togo
        ), moves AS (
            SELECT g.conv_id, g.i, g.s.q AS q, g.s.then AS following,
                   CASE WHEN p.conv_id IS NULL AND p.i IS NULL THEN CASE WHEN g.s.q IN (0, 3) THEN '' ELSE 'I' END
                        WHEN g.s.f = 4 + h.s.f THEN 'D'
                        WHEN g.s.f = 3 + g.s.insert THEN 'I'
                        WHEN g.s.q = 0 AND g.s.f = stay + no_s + o.f1 THEN 'K'
                        WHEN g.s.f = stay + (CASE WHEN g.s.q = 2 THEN no_a + o.f3 ELSE no_u + o.f2 END) THEN 'K'
                        ELSE 'R' END AS edit,
                   p.turn, p.role, p.text, p.initial, p.fault
            FROM graph g
            LEFT JOIN priced p ON p.conv_id IS NOT DISTINCT FROM g.conv_id AND p.i = g.i + 1
            LEFT JOIN graph h ON h.conv_id IS NOT DISTINCT FROM g.conv_id AND h.i = g.i + 1 AND h.s.q = g.s.q
            LEFT JOIN togo o ON o.conv_id IS NOT DISTINCT FROM g.conv_id AND o.i = g.i + 1
        ), walk AS (
            SELECT conv_id, CAST(0 AS BIGINT) AS i, 0 AS q, CAST(0 AS BIGINT) AS step, '' AS edit, CAST(NULL AS VARCHAR) AS line, CAST(0 AS BIGINT) AS price
            FROM ends
            UNION ALL
            SELECT w.conv_id, CASE WHEN m.edit = 'I' THEN w.i ELSE w.i + 1 END,
                   CASE WHEN m.edit = 'D' THEN w.q WHEN m.edit = 'K' AND m.initial = 's' THEN 1 ELSE m.following END,
                   w.step + 1, m.edit,
                   CASE m.edit WHEN 'D' THEN NULL WHEN 'K' THEN m.role || ':' || m.text
                        ELSE CASE WHEN w.q = 2 THEN 'assistant:' ELSE 'user:' END || CASE WHEN m.edit = 'R' THEN m.text ELSE '' END END,
                   CASE m.edit WHEN 'D' THEN 4 WHEN 'I' THEN 3 WHEN 'R' THEN 3 ELSE 0 END + CASE WHEN m.edit IN ('K', 'R') AND m.fault = 3 THEN 3 ELSE 0 END
            FROM walk w JOIN moves m ON m.conv_id IS NOT DISTINCT FROM w.conv_id AND m.i = w.i AND m.q = w.q
            WHERE m.edit <> ''
        ), repaired AS (
            SELECT conv_id, CAST(sum(price) AS BIGINT) AS cost, string_agg(edit, '' ORDER BY step) AS audit,
                   sha256(coalesce(string_agg(line, chr(10) ORDER BY step), '')) AS repaired_sha256
            FROM walk GROUP BY conv_id
        ), counted AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                   count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
                   count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
            FROM (SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair FROM judged) GROUP BY conv_id
        )
        SELECT a.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
               coalesce(audit, '') AS audit, coalesce(repaired_sha256, sha256('')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) a
        LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM a.conv_id
        LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM a.conv_id
    """,
}
