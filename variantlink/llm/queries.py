"""Queries over the text tables, one for each operator, and their DuckDB SQL where SQL can tell."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, dialogue_repair, exact_dedup, fim, fingerprints, html_text, licenses, line_dedup, packing, pii, quality, simhash


#: Key of the surrogates; a real corpus takes its own secret.
SURROGATE_KEY = "corpus surrogates"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.perspectives(table(spark, sf_dir, "conversations"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path, pattern = tokenizer_file("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    coded = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path, pattern), path, pattern)
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(table(spark, sf_dir, "documents"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.surrogates(table(spark, sf_dir, "documents"), SURROGATE_KEY)
    return found.select("doc_id", "text", "n_entities", "entity_kinds")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.tiktoken"))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def hex16(c: str) -> Column:
    return F.lower(F.lpad(F.hex(c), 16, "0"))


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints.document_fingerprints(table(spark, sf_dir, "documents"))
    prints = [hex16("fp").alias("fingerprint"), hex16("edited_fp").alias("edited_fingerprint")]
    return found.select("doc_id", "n_chars", "edited_sha256", *prints, "near_edited", "near_next", "component_id")


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fim.transform(table(spark, sf_dir, "documents"))
    shas = [F.sha2("output", 256).alias("output_sha256"), F.sha2(fim.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256")]
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *shas)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogue_repair.damage_and_repair(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_quality": op2_quality,
    "op3_licenses": op3_licenses,
    "op4_chat": op4_chat,
    "op5_bpe": op5_bpe,
    "op6_line_dedup": op6_line_dedup,
    "op7_pii": op7_pii,
    "op8_packing": op8_packing,
    "op9_html_text": op9_html_text,
    "op10_simhash": op10_simhash,
    "op11_fingerprints": op11_fingerprints,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLES = {
    "op1_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""",
    "op4_chat": """
        WITH t AS (SELECT conv_id, coalesce(nullif(role, ''), 'unknown') AS role, coalesce(text, '') AS text, turn FROM conversations),
        r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS rank FROM t),
        p AS (SELECT DISTINCT conv_id, role AS participant FROM t WHERE role <> 'system'),
        x AS (SELECT r.conv_id, participant, rank, rank // 64 AS part, role = participant AS mine, regexp_replace(text, '<(\\\\*)\\|', '<\\\\\\1|', 'g') || '<|end|>\n' AS body,
                CASE WHEN role = participant THEN '<|assistant|>\n' WHEN role = 'system' THEN '<|system|>\n'
                     ELSE '<|user name=' || replace(replace(replace(replace(role, '\\', '\\\\'), chr(10), '\\n'), chr(13), '\\r'), '|', '\\|') || '|>\n' END AS head
              FROM r JOIN p ON r.conv_id IS NOT DISTINCT FROM p.conv_id),
        y AS (SELECT *, sum(length(head) + length(body)) OVER (PARTITION BY conv_id, participant, part ORDER BY rank) AS stop FROM x)
        SELECT conv_id, participant, part, count(*) AS n_turns, string_agg(head || body, '' ORDER BY rank) AS text,
               coalesce(string_agg(CASE WHEN mine THEN CAST(stop - length(body) AS BIGINT) || ':' || CAST(stop - 1 AS BIGINT) END, ',' ORDER BY rank), '') AS mask
        FROM y GROUP BY conv_id, participant, part""".replace("\n'", "' || chr(10)").replace("'<|end|>' || chr(10)", "('<|end|>' || chr(10))"),
}
