"""The operators of this subpackage as registered queries.

Each query applies its operator with production parameters to the whole table.
``public_tokenizers.path`` gives the places of the vocabulary files.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstar.llm import (
    conversation_repair,
    cross_tokenizer,
    decontamination,
    exact_dedup,
    pii,
    quality,
    quality_rules,
    sentencepiece_codec,
    simhash,
    substring_dedup,
    token_counts,
    token_files,
    toxicity,
)
from reelstar.llm.common import ship_package, table
from reelstar.session import scratch_path

WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"
TOKEN_LIMIT = 2048
END_ID = 1
#: Key of the registered query; a deployment passes a secret one of its own.
PII_KEY = "registered"


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    # these documents hold account numbers without a check digit
    return pii.pseudonymise(table(spark, sf_dir, "documents"), PII_KEY, accounts=True)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.deduplicate(table(spark, sf_dir, "documents"), window=50)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicates(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.fit_score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.5)


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_copies(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE),
                                     TOKEN_LIMIT)


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.encode(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_BPE))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")), threshold=0.3)


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.write_and_read(spark, table(spark, sf_dir, "documents"),
                                      public_tokenizers.path(WORD_BPE), scratch_path(spark, "tokens"), END_ID)


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults that crc32 of ``conv_id:turn`` deals out: of twenty
    rows one is dropped (``copies`` 0), one emptied, one loses its sentence ends,
    one is there twice, one gets the role user. Nulls are one space."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    text = (F.when(fault == 1, F.lit("")).when(fault == 2, F.regexp_replace(part("text"), "[.!?]", ""))
            .otherwise(part("text")))
    return conversations.select(
        "conv_id", "turn", F.when(fault == 4, F.lit("user")).otherwise(part("role")).alias("role"),
        text.alias("text"), F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("copies"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = damaged(table(spark, sf_dir, "conversations"))
    return conversation_repair.together(conversation_repair.repair(rows, copies_col="copies"))


def op12_cross_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = cross_tokenizer.align(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE),
                                    public_tokenizers.path(PIECE_BPE))
    hashed = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise(F.lit(""))
    linked = cross_tokenizer.written(aligned.withColumn("groups_sha256", hashed).drop("groups"))
    return cross_tokenizer.count_links(linked, ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256"])


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def _on_executors(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {name: _on_executors(query) for name, query in {
    "op1_pii": op1_pii,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_toxicity": op4_toxicity,
    "op5_simhash": op5_simhash,
    "op6_token_counts": op6_token_counts,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_decontamination": op8_decontamination,
    "op9_quality": op9_quality,
    "op10_token_files": op10_token_files,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_cross_tokenizer": op12_cross_tokenizer,
    "op13_quality_rules": op13_quality_rules,
}.items()}

ORACLE_SQL: dict[str, str] = {
    "op2_substring_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
                   FROM documents),
        windows AS (SELECT doc_id, i, sha256(array_to_string(words[i:i + 49], ' ')) AS key
                    FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 49)) AS i FROM d)),
        bad AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY key) AS first FROM windows)
                WHERE first < doc_id),
        removed AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 49)) AS p FROM bad),
        every AS (SELECT doc_id, unnest(words) AS word, unnest(generate_series(1, len(words))) AS p FROM d),
        kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n
                 FROM every ANTI JOIN removed USING (doc_id, p) GROUP BY doc_id)
        SELECT d.doc_id, len(d.words) AS n_words, len(d.words) - coalesce(k.n, 0) AS n_removed,
               sha256(coalesce(k.text, '')) AS kept_sha256
        FROM d LEFT JOIN kept k USING (doc_id)""",
    "op3_exact_dedup": r"""
        WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm
                   FROM documents)
        SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id,
               count(*) OVER (PARTITION BY norm) AS group_size,
               doc_id IS NOT DISTINCT FROM min(doc_id) OVER (PARTITION BY norm) AS kept,
               sha256(norm) AS text_sha256
        FROM t""",
}
