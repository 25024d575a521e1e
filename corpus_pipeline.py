"""From raw documents to encoded training text, in five stages.

Each stage applies one operator of ``reelstar.llm`` to all that its predecessor kept:

1. quality: documents below the classifier's threshold go;
2. exact copies: of equal texts the document of the smallest id stays;
3. near copies: one document of each SimHash group stays;
4. decontamination: documents that hold benchmark passages go;
5. SentencePiece: the rest is encoded to ids, decoded and checked; the ids are given out.

``STAGES`` lists them as (name, function); a function takes the session, the
documents and the folder of the other tables. All but the last return the
columns of ``documents``.

Defined results: every stage passes null ids, null texts, repeated rows and further
columns on as its operator defines; an empty table gives an empty result with the
same columns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from reelstar.llm import decontamination, exact_dedup, quality, sentencepiece_codec, simhash
from reelstar.llm.common import durable, ship_package, table
from reelstar.llm.queries import PIECE_BPE

QUALITY_THRESHOLD = 0.3
SHINGLE, MAX_BITS = 3, 3


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.keep(docs, model, QUALITY_THRESHOLD)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return simhash.keep_first(docs, SHINGLE, MAX_BITS)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return decontamination.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return sentencepiece_codec.encode(docs, public_tokenizers.path(PIECE_BPE), with_ids=True)


STAGES = [
    ("quality classifier", filter_quality),
    ("exact dedup", drop_exact_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_benchmark_passages),
    ("SentencePiece encoding and decoding", encode),
]

#: SQL can't express the classifier, the latent space or the codec.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir), name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)
