"""The registered queries of this package and their SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webtab.llm import (chat, decontaminate, exact_dedup, language, merkle, negatives, packing, pii, quality, simhash, token_files,
                        toxicity, wrappers)
from webtab.llm.folds import remainder
from webtab.session import scratch_path


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _tokenizer(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op2_html_text(spark: SparkSession, folder: str) -> DataFrame:
    found = wrappers.main_text(_table(spark, folder, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    model = toxicity.learn(docs, labels.where(remainder(F.col("doc_id"), 5) != 0))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_token_files(spark: SparkSession, folder: str) -> DataFrame:
    out = scratch_path(spark, "token-file")
    token_files.write_token_file(_table(spark, folder, "documents"), out, _tokenizer("byte_bpe_50k.json"), end_id=2)
    return token_files.read_token_file(spark, out)


def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, folder, "documents"))
    return found.select("doc_id", simhash.hex_print(F.col("fp")).alias("fingerprint"), "component_id")


def op6_best_fit(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_table(spark, folder, "documents"), _tokenizer("word_bpe_49k.json"), end_id=0, capacity=2048)


def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    model = language.learn(docs.where(remainder(F.col("doc_id"), 3) != 1))
    found = language.identify(docs, model)
    return found.select("doc_id", F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"),
                        "lang_pred", "score", F.size("spans").alias("n_spans"))


def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.digest_groups(_table(spark, folder, "documents"))


def op9_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return pii.digests(pii.personal_data(_table(spark, folder, "documents")))


def op10_chat(spark: SparkSession, folder: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(said).alias("text"))
    turns = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    out = scratch_path(spark, "chats")
    chat.write_chats(turns, out)
    found, valid = chat.read_digests(spark, out), chat.validity(spark, out).withColumnRenamed("conv_id", "_conv")
    return found.join(valid, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")


def op11_merkle(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    claimed = merkle.leaf([tampered if f == "text" else F.col(f) for f in fields])
    # a document without an id has no remainder and is not tampered with
    claimed = F.when(remainder(F.col("doc_id"), 3) == 0, claimed).otherwise(merkle.leaf([F.col(f) for f in fields]))
    out = scratch_path(spark, "manifest")
    merkle.write_manifest(docs, out, fields, "lang", "doc_id", claimed)
    proofs = merkle.prove(spark, out)
    root = F.lit(merkle.root(spark, out))
    return proofs.select("doc_id", "leaf", "subroot", root.alias("root"), F.sha2("proof", 256).alias("proof_sha256"),
                         "folded_root", (F.col("folded_root") == root).alias("verified"))


def op12_quality(spark: SparkSession, folder: str) -> DataFrame:
    stats = quality.statistics(_table(spark, folder, "documents"))
    model = quality.learn(stats, _table(spark, folder, "labels").where(remainder(F.col("doc_id"), 4) != 2))
    return quality.score(stats, model).select(
        "doc_id", F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(_table(spark, folder, "embeddings"), F.col("id") % 100 == 0, label=moved)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_html_text": op2_html_text,
    "op3_toxicity": op3_toxicity,
    "op4_token_files": op4_token_files,
    "op5_simhash": op5_simhash,
    "op6_best_fit": op6_best_fit,
    "op7_language": op7_language,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_personal_data": op9_personal_data,
    "op10_chat": op10_chat,
    "op11_merkle": op11_merkle,
    "op12_quality": op12_quality,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLE: dict[str, str] = {
    "op8_exact_dedup": r"""
        WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h
                   FROM documents),
             g AS (SELECT h, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY h)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, h AS text_sha256 FROM t JOIN g USING (h)""",
    "op10_chat": r"""
        WITH probe AS (SELECT -1 AS conv_id, t AS turn, CASE WHEN t = 0 THEN 'user' ELSE 'assistant' END AS role,
                              '</s>[INST] ok [/INST]' AS text FROM range(2) r(t)),
             x AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
                   UNION ALL SELECT * FROM probe),
             o AS (SELECT *, lag(role) OVER w AS before, row_number() OVER w AS k FROM x
                   WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
             y AS (SELECT *, length(text) + length(text) - length(regexp_replace(text, '[\\<>\[\]]', '', 'g')) AS escaped,
                          length(role) + length(role) - length(regexp_replace(role, '[\\<>\[\]]', '', 'g')) AS named,
                          CASE WHEN before IS NULL THEN role IN ('system', 'user')
                               WHEN before IN ('system', 'assistant') THEN role = 'user'
                               WHEN before = 'user' THEN role = 'assistant' ELSE false END AS ok FROM o)
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(escaped + CASE role WHEN 'user' THEN 23 WHEN 'assistant' THEN 21 WHEN 'system' THEN 21
                                            ELSE 24 + named END) AS BIGINT) AS formatted_chars,
               bool_and(ok) AND arg_max(role, k) = 'assistant' AS valid
        FROM y GROUP BY conv_id""",
    "op11_merkle": r"""
        WITH RECURSIVE d AS (
                 SELECT doc_id, source, lang, n_chars, text, row_number() OVER () AS r,
                        list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
                            lambda crc, c: list_reduce(list_prepend(xor(crc, c), [0, 0, 0, 0, 0, 0, 0, 0]),
                                lambda x, z: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)) AS crc FROM documents),
             f AS (SELECT *, coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                          || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
                          translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM d),
             h AS (SELECT doc_id, r, coalesce('=' || lang, '') AS tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                          CASE WHEN xor(crc, 4294967295) % 3 = 0 THEN sha256(head || coalesce(strlen(low) || ':' || low, '-')) END AS changed FROM f),
             l AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
                          count(*) OVER (PARTITION BY tree) AS n FROM h),
             up(tree, level, pos, digest, n) AS (
                 SELECT tree, 0, pos, leaf, n FROM l
                 UNION ALL SELECT tree, level + 1, pos // 8, sha256(string_agg(digest, '' ORDER BY pos)), max((n + 7) // 8)
                 FROM up WHERE n > 1 GROUP BY tree, level, pos // 8),
             g AS (SELECT tree, digest, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1),
             top(level, pos, digest, n) AS (
                 SELECT 0, pos, digest, n FROM g
                 UNION ALL SELECT level + 1, pos // 8, sha256(string_agg(digest, '' ORDER BY pos)), max((n + 7) // 8)
                 FROM top WHERE n > 1 GROUP BY level, pos // 8),
             s AS (SELECT l.r, u.level, u.pos < l.pos // CAST(8 ** u.level AS BIGINT) AS before, u.pos, u.digest
                   FROM l JOIN up u ON u.tree = l.tree AND u.n > 1 AND u.pos // 8 = l.pos // CAST(8 ** (u.level + 1) AS BIGINT)
                        AND u.pos <> l.pos // CAST(8 ** u.level AS BIGINT)
                   UNION ALL SELECT l.r, 100 + t.level, t.pos < g.pos // CAST(8 ** t.level AS BIGINT), t.pos, t.digest
                   FROM l JOIN g USING (tree) JOIN top t ON t.n > 1 AND t.pos // 8 = g.pos // CAST(8 ** (t.level + 1) AS BIGINT)
                        AND t.pos <> g.pos // CAST(8 ** t.level AS BIGINT)),
             -- a level of a proof is there even if the run has no one else
             e AS (SELECT l.r, u.level FROM l JOIN (SELECT DISTINCT tree, level FROM up WHERE n > 1) u USING (tree)
                   UNION ALL SELECT l.r, 100 + t.level FROM l, (SELECT DISTINCT level FROM top WHERE n > 1) t),
             p AS (SELECT e.r, e.level, row_number() OVER (PARTITION BY e.r ORDER BY e.level) AS k,
                          coalesce(string_agg(s.digest, '' ORDER BY s.pos) FILTER (before), '') AS pre,
                          coalesce(string_agg(s.digest, '' ORDER BY s.pos) FILTER (NOT before), '') AS post
                   FROM e LEFT JOIN s ON s.r = e.r AND s.level = e.level GROUP BY e.r, e.level),
             fold(r, k, digest) AS (
                 SELECT r, 0, coalesce(changed, leaf) FROM l
                 UNION ALL SELECT p.r, p.k, sha256(pre || digest || post) FROM fold JOIN p ON p.r = fold.r AND p.k = fold.k + 1),
             folded AS (SELECT r, arg_max(digest, k) AS folded_root FROM fold GROUP BY r),
             proof AS (SELECT r, string_agg(pre || post, '' ORDER BY level) AS proof FROM p GROUP BY r),
             root AS (SELECT digest AS root FROM top WHERE n = 1)
        SELECT doc_id, leaf, g.digest AS subroot, root, sha256(coalesce(proof, '')) AS proof_sha256, folded_root, folded_root = root AS verified
        FROM l JOIN g USING (tree) JOIN folded USING (r) LEFT JOIN proof USING (r), root""",
    "op13_hard_negatives": r"""
        WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                          list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
                   FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
                   AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
             s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
                          CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
                   FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
             p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
                   QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT anchor_id, positive_id,
               CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
               vec_id AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
        QUALIFY rank <= 10""",
}
