"""The registered queries of this subpackage, each over its whole table, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm import (
    chat_format,
    decontaminate,
    exact_dedup,
    fim,
    language_id,
    lm_score,
    near_dedup,
    packing,
    repair,
    secret_scan,
    sharding,
    token_counts,
    toxicity,
)
from fleetlens.llm.common import Workspace, crc_fold

LANGUAGE_FOLDS, LANGUAGE_HELD_OUT = 4, 2
SCORE_FOLDS, SCORE_HELD_OUT = 5, 1
SHARDS = 16
TOXIC_FOLDS, TOXIC_HELD_OUT = 4, 2
TOXIC_FROM = 0.3


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_files() -> tuple[str, str, str]:
    """The public vocabulary on this machine: BPE file, the same as ranks, and the pattern that splits texts."""
    return (
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"))


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\\\### Assistant: </turn> ok"  # as an SQL literal: one backslash
    extra = spark.sql(
        f"SELECT -7L AS conv_id, 0L AS turn, 'user' AS role, '{said}' AS text "
        f"UNION ALL SELECT -7L, 1L, 'assistant', '{said}'"
    )
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat_format.digests(chat_format.windows(turns.unionByName(extra)))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), tokenizer_files())


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_documents(
        _table(spark, sf_dir, "documents"), crc_fold(F.col("doc_id"), SCORE_FOLDS) != SCORE_HELD_OUT
    )


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents are inserted; those labelled toxic are deleted; those of quality 1 still there are counted anew.

    The delete is committed twice, as a retried job would, and the first
    batches are compacted before the last one arrives.
    """
    work = Workspace(spark, "token-counts")
    docs = _table(spark, sf_dir, "documents")
    old_version, new_version = token_counts.TOKENIZERS
    texts = docs.select(
        "doc_id",
        "source",
        "lang",
        token_counts.count_tokens(F.col("text"), old_version).alias("old"),
        token_counts.count_tokens(F.col("text"), new_version).alias("new"),
    )
    labels = _table(spark, sf_dir, "labels").where("doc_id is not null").groupBy("doc_id").agg(
        F.max("toxic").alias("toxic"), F.max("quality").alias("quality")
    )
    rows = work.save(texts.join(labels, "doc_id", "left"), "rows")

    def counted(version: str, column: str, condition: str) -> DataFrame:
        return rows.where(condition).select("source", "lang", F.lit(version).alias("tokenizer"), F.col(column).alias("tokens"))

    toxic, kept = "coalesce(toxic, 0) = 1", "coalesce(toxic, 0) <> 1 and coalesce(quality, 0) = 1"
    rollup = token_counts.Rollup(spark, work.path("rollup"))
    rollup.commit("load", token_counts.inserts(counted(old_version, "old", "true")))
    for _ in range(2):
        rollup.commit("takedown", token_counts.deletes(counted(old_version, "old", toxic)))
    rollup.compact("1")
    rollup.commit("recount", token_counts.revisions(counted(old_version, "old", kept), counted(new_version, "new", kept)))
    return rollup.totals()


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_table(spark, sf_dir, "documents"), SHARDS)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = crc_fold(F.col("doc_id"), LANGUAGE_FOLDS) == LANGUAGE_HELD_OUT
    model = language_id.train(docs.where(~held_out))
    found = language_id.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per finding, the secret itself only as its hash."""
    found = secret_scan.scan(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.col("place").cast("long").alias("place"),
        F.col("part").cast("long").alias("part"),
        F.sha2(F.col("candidate").cast("binary"), 256).alias("candidate_sha256"),
        "label",
        "probability",
        "is_secret",
    )


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations")
    return repair.report(turns, repair.damage(turns))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = fim.restore(fim.transform(_table(spark, sf_dir, "documents")))
    digests = (F.sha2(F.col(c).cast("binary"), 256).alias(f"{name}_sha256") for c, name in (("output", "output"), ("restored", "restored")))
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc_fold(F.col("doc_id"), TOXIC_FOLDS) == TOXIC_HELD_OUT
    labels = _table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.train(docs.where(~held_out), labels.where(~held_out))
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_minhash_near_dedup,
        op2_benchmark_decontamination,
        op3_exact_dedup,
        op4_chat_formatting,
        op5_packing,
        op6_lm_scoring,
        op7_token_counts,
        op8_sharding,
        op9_language_id,
        op10_secret_scan,
        op11_conversation_repair,
        op12_fill_in_middle,
        op13_toxicity,
    )
}

ORACLES: dict[str, str] = {
    "op2_benchmark_decontamination": r"""
        WITH doc_words AS (
          SELECT doc_id, list_filter(regexp_split_to_array(
              translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
          FROM documents),
        item_words AS (
          SELECT CAST(item_id AS VARCHAR) AS item, list_filter(regexp_split_to_array(
              translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
          FROM benchmark),
        item_windows AS (
          SELECT DISTINCT item, least(10, len(words)) AS width,
                 array_to_string(words[i:i + least(10, len(words)) - 1], ' ') AS phrase
          FROM (SELECT *, unnest(range(1, greatest(1, len(words) - 9) + 1)) AS i FROM item_words WHERE len(words) > 0)),
        widths AS (SELECT DISTINCT width FROM item_windows),
        doc_windows AS (
          SELECT doc_id, i, width, array_to_string(words[i:i + width - 1], ' ') AS phrase
          FROM (SELECT doc_id, words, width, unnest(range(1, len(words) - width + 2)) AS i
                FROM doc_words, widths WHERE len(words) >= width)),
        hits AS (SELECT d.doc_id, d.i, d.width, w.item FROM doc_windows d JOIN item_windows w USING (width, phrase)),
        hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit
                      FROM (SELECT doc_id, unnest(range(i, i + width)) AS p FROM hits) GROUP BY doc_id),
        hit_items AS (SELECT doc_id, count(DISTINCT item) AS n_items,
                             sha256(string_agg(DISTINCT item, ',' ORDER BY item)) AS items_sha256
                      FROM hits GROUP BY doc_id)
        SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM doc_words LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
    """,
    "op3_exact_dedup": r"""
        WITH t AS (
          SELECT doc_id, length(coalesce(text, '')) AS points,
                 regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
          FROM documents)
        SELECT doc_id,
               first_value(doc_id) OVER (PARTITION BY norm ORDER BY points DESC, doc_id) AS keep_id,
               count(*) OVER (PARTITION BY norm) AS group_size,
               doc_id = first_value(doc_id) OVER (PARTITION BY norm ORDER BY points DESC, doc_id) AS kept,
               sha256(norm) AS text_sha256
        FROM t
    """,
    "op7_token_counts": r"""
        WITH flags AS (SELECT doc_id, max(toxic) AS toxic, max(quality) AS quality FROM labels GROUP BY doc_id),
        t AS (
          SELECT source, lang, coalesce(toxic, 0) = 1 AS gone,
                 coalesce(toxic, 0) <> 1 AND coalesce(quality, 0) = 1 AS anew,
                 len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+')) AS old,
                 len(regexp_extract_all(coalesce(text, ''), '[0-9A-Za-z\x{80}-\x{10FFFF}]+')) AS new
          FROM documents LEFT JOIN flags USING (doc_id))
        SELECT source, lang, CASE WHEN anew THEN 'letters-2' ELSE 'spaced-1' END AS tokenizer,
               count(*) AS documents, CAST(sum(CASE WHEN anew THEN new ELSE old END) AS BIGINT) AS tokens
        FROM t WHERE NOT gone GROUP BY ALL
    """,
    # crc32 bit by bit; then a dynamic programme over (row, last role) that keeps the least (cost, edits)
    "op11_conversation_repair": r"""
        WITH RECURSIVE c AS (
          SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                 coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name
          FROM conversations),
        k AS (
          SELECT *, xor(list_reduce(
              list_transform(string_split(name, ''), lambda ch: CAST(ascii(ch) AS BIGINT)),
              lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0],
                lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END),
              CAST(4294967295 AS BIGINT)), 4294967295) % 20 AS kind
          FROM c),
        damaged AS (
          SELECT conv_id, coalesce('=' || CAST(conv_id AS VARCHAR), '') AS key, turn,
                 CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                 CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
          FROM (SELECT *, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) FROM k WHERE kind <> 0)),
        numbered AS (
          SELECT *, row_number() OVER (PARTITION BY key ORDER BY turn NULLS FIRST, role, sha256(text)) AS i,
                 regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS bare
          FROM damaged),
        marked AS (
          SELECT *, CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE '-' END AS initial,
                 CASE WHEN bare = '' THEN 'blank'
                      WHEN row_number() OVER (PARTITION BY key, role, text ORDER BY i) > 1 THEN 'duplicate'
                      WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'sound' END AS fault
          FROM numbered),
        counts AS (
          SELECT key, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                 count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                 count(*) FILTER (fault = 'truncated') AS truncated,
                 count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
          FROM (SELECT *, lag(initial) OVER (PARTITION BY key ORDER BY i) AS before FROM marked) GROUP BY key),
        follows(state, next, forced) AS (
          VALUES ('-', 's', false), ('-', 'u', true), ('s', 'u', true), ('u', 'a', true), ('a', 'u', true)),
        inserts AS (  -- none, one or two empty rows, and the state after them
          SELECT state, state AS reached, 0 AS cost, '' AS edits, '' AS roles FROM (SELECT DISTINCT state FROM follows)
          UNION ALL SELECT state, next, 5, 'I', next FROM follows WHERE forced
          UNION ALL SELECT a.state, b.next, 10, 'II', a.next || b.next
                    FROM follows a JOIN follows b ON a.next = b.state WHERE a.forced AND b.forced),
        moves AS (
          SELECT state, initial, fault, 'D' AS edit, state AS reached, 2 AS cost, '-' AS given
          FROM (SELECT DISTINCT state FROM follows), (SELECT DISTINCT initial, fault FROM marked)
          UNION ALL
          SELECT state, initial, fault, 'K', next, CASE fault WHEN 'truncated' THEN 5 ELSE 0 END, '-'
          FROM follows JOIN (SELECT DISTINCT initial, fault FROM marked) ON next = initial WHERE fault IN ('sound', 'truncated')
          UNION ALL
          SELECT state, initial, fault, 'R', next, CASE fault WHEN 'truncated' THEN 6 ELSE 1 END, next
          FROM follows, (SELECT DISTINCT initial, fault FROM marked) WHERE forced AND fault IN ('sound', 'truncated')),
        options AS (
          SELECT n.state, m.initial, m.fault, m.reached, n.cost + m.cost AS cost, n.edits || m.edit AS edits, n.roles || m.given AS roles
          FROM inserts n JOIN moves m ON n.reached = m.state),
        paths AS (
          SELECT key, CAST(0 AS BIGINT) AS i, '-' AS state, {'cost': 0, 'edits': '', 'roles': ''} AS best FROM (SELECT DISTINCT key FROM marked)
          UNION ALL
          SELECT p.key, p.i + 1, o.reached,
                 min({'cost': p.best.cost + o.cost, 'edits': p.best.edits || o.edits, 'roles': p.best.roles || o.roles})
          FROM paths p JOIN marked m ON m.key = p.key AND m.i = p.i + 1
               JOIN options o ON o.state = p.state AND o.initial = m.initial AND o.fault = m.fault
          GROUP BY p.key, p.i, o.reached),
        ended AS (
          SELECT p.key, min({'cost': best.cost + n.cost, 'edits': best.edits || n.edits, 'roles': best.roles || n.roles}) AS best
          FROM paths p JOIN (SELECT key, count(*) AS rows FROM marked GROUP BY key) c ON c.key = p.key AND c.rows = p.i
               JOIN inserts n ON n.state = p.state WHERE n.reached IN ('-', 'a') GROUP BY p.key),
        steps AS (
          SELECT key, place, best.edits[place] AS edit, best.roles[place] AS given,
                 len(replace(left(best.edits, place), 'I', '')) AS i
          FROM (SELECT *, unnest(range(1, len(best.edits) + 1)) AS place FROM ended)),
        repaired AS (
          SELECT s.key, string_agg(CASE given WHEN 'u' THEN 'user' WHEN 'a' THEN 'assistant' ELSE m.role END || ':' ||
                   CASE edit WHEN 'I' THEN '' ELSE m.text END, chr(10) ORDER BY place) AS whole
          FROM steps s LEFT JOIN marked m ON m.key = s.key AND m.i = s.i WHERE edit <> 'D' GROUP BY s.key)
        SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
               CAST(coalesce(best.cost, 0) AS BIGINT) AS cost, coalesce(best.edits, '') AS audit,
               sha256(coalesce(whole, '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id, coalesce('=' || CAST(conv_id AS VARCHAR), '') AS key FROM conversations) o
             LEFT JOIN counts USING (key) LEFT JOIN ended USING (key) LEFT JOIN repaired USING (key)
    """,
    "op12_fill_in_middle": r"""
        WITH t AS (
          SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
                 regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units
          FROM documents),
        drawn AS (
          SELECT *, len(units) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(units) + 1) AS a, CAST('0x' || h[9:16] AS BIGINT) % (len(units) + 1) AS b,
                 CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                        OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 100 THEN 'plain'
                      WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
          FROM t),
        cut AS (
          SELECT *, array_to_string(units[1:least(a, b)], '') AS p, array_to_string(units[least(a, b) + 1:greatest(a, b)], '') AS m,
                 array_to_string(units[greatest(a, b) + 1:], '') AS s
          FROM drawn)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                      ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM cut
    """,
}
