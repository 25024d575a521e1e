from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F

import __spark_entry__ as entry
from reelstar.llm import decontamination, exact_dedup, quality, sentencepiece_codec, simhash
from reelstar.llm.common import durable
from reelstar.llm.queries import PIECE_BPE

SF = "/root/testdata/sf0.001"


def test_names_and_registration():
    qs = entry.queries()
    assert {"pipeline", *(f"op{n}" for n in range(1, 14))} == {q.split("_")[0] for q in qs if q.startswith("op") or q == "pipeline"} - {"overwrite"}
    assert set(entry.oracle_sql()) <= set(qs)
    assert len(corpus_pipeline.STAGES) == 5


def test_each_stage_against_its_operator(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())

    def verdicts(df):
        """Rows that each stage should keep, from the operators' own reports."""
        yield quality.score(df[0], quality.fit(df[0], labels)).filter("predicted = 1")
        yield exact_dedup.duplicates(df[0]).filter("kept")
        yield simhash.near_copies(df[0]).filter("doc_id = component_id")
        bad = decontamination.contaminated(df[0], bench).select("doc_id")
        yield df[0].join(bad, "doc_id", "left_anti")

    at = [docs]
    for (name, stage), want in zip(corpus_pipeline.STAGES, verdicts(at)):
        expected = ids(want)
        out = durable(stage(spark, at[0], SF), "stage")
        assert out.columns == docs.columns and ids(out) == expected, name
        assert out.exceptAll(docs).count() == 0
        at[0] = out
    last = corpus_pipeline.STAGES[-1][1](spark, at[0], SF)
    assert ids(last) == ids(at[0])
    assert last.filter(~F.col("parity") | ~F.col("round_trip")).count() == 0


def test_repeated_rows_nulls_and_an_empty_table(documents, spark):
    rows = [(1, "a b c d"), (1, "a b c d"), (2, "a  b c d"), (None, "a b c d"), (None, None), (5, None), (6, "")]
    df = documents(rows).withColumn("_sha", F.lit(1)).withColumn("kept", F.lit(1))
    for keep in (exact_dedup.keep_first, simhash.keep_first):
        out = keep(df)
        assert out.columns == df.columns
    exact = sorted(((r.doc_id, r.text) for r in exact_dedup.keep_first(df).collect()), key=str)
    assert exact == [(1, "a b c d"), (5, None)]
    near = {(r.doc_id, r.text) for r in simhash.keep_first(df).collect()}
    assert near == {(1, "a b c d"), (5, None)}
    empty = documents([])
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF)
        assert empty.count() == 0


def test_the_last_stage_gives_out_ids_that_decode_to_the_texts(documents, spark):
    rows = [(1, "Some text, été \U0001f600."), (2, "  two  spaces"), (None, "no id"), (4, None), (5, "")]
    out = corpus_pipeline.STAGES[-1][1](spark, documents(rows), SF)
    assert all(r.n_pieces == len(r.ids) for r in out.collect())
    back = sentencepiece_codec.decode(out, public_tokenizers.path(PIECE_BPE)).collect()
    assert {(r.doc_id, r.text) for r in back} == {(i, t or "") for i, t in rows}
