"""Exact duplicates through two passes over a Bloom filter.

Pass one counts, for every text hash, its cells in a filter of fixed size and
keeps the cells that were hit more than once. Pass two looks each hash up: a
text is possibly repeated only if all its cells were. Only such rows are
shuffled and grouped by their full hash; the rest are unique beyond doubt and
pass straight through.

The filter has sixteen bits a row, but at most ``MAX_BITS``; its words are
broadcast, which bounds them to ``MAX_BITS / 64`` rows of two longs. Beyond
that size more rows are suspected and shuffled, and results stay the same.

All columns are worked out by built-in functions.

Defined results: a null text counts as empty. White space runs count as one
space. Of equal texts the row with the smallest id stays; rows that repeat its
id too are the same document and stay with it. Null ids come after all
others. Other columns are ignored here and kept by ``keep_first``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelstar.llm.common import durable, spread_join

#: Upper bound of the filter: a million words of 64 bits.
MAX_BITS = 1 << 26
BITS_PER_ROW = 16
CELLS = 2
#: Runs of white space other than one single space.
_RUNS = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), _RUNS, " ")


def filter_bits(rows: int) -> int:
    bits = 1 << 10
    while bits < min(rows * BITS_PER_ROW, MAX_BITS):
        bits *= 2
    return bits


def _cell(i: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(F.col("text_sha256"), F.lit(i)), F.lit(bits))


def repeated_cells(hashes: DataFrame, bits: int) -> DataFrame:
    """The filter's words that have a cell hit more than once."""
    cells = hashes.select(F.explode(F.array(*[_cell(i, bits) for i in range(CELLS)])).alias("cell"))
    twice = cells.groupBy("cell").count().filter("count > 1")
    bit = F.expr("shiftleft(1L, CAST(cell % 64 AS INT))")
    return (twice.select(F.expr("cell DIV 64").alias("word"), bit.alias("bit"))
            .groupBy("word").agg(F.bit_or("bit").alias("bits")))


def mark_suspects(hashes: DataFrame, words: DataFrame, bits: int) -> DataFrame:
    """``hashes`` with ``suspect``: all cells were hit more than once."""
    out = hashes
    for i in range(CELLS):
        side = F.broadcast(words.select(F.col("word").alias(f"_w{i}"), F.col("bits").alias(f"_b{i}")))
        cell = _cell(i, bits)
        out = (out.withColumn(f"_c{i}", cell)
               .join(side, F.expr(f"_c{i} DIV 64") == F.col(f"_w{i}"), "left"))
    hit = [F.expr(f"coalesce(getbit(_b{i}, CAST(_c{i} % 64 AS INT)), 0) = 1") for i in range(CELLS)]
    suspect = hit[0]
    for h in hit[1:]:
        suspect = suspect & h
    return out.select(*hashes.columns, suspect.alias("suspect"))


def duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, keep_id, group_size, kept, text_sha256)`` for each row of ``docs``."""
    hashes = durable(docs.select(F.col(id_col).alias("_id"),
                                 F.sha2(normalised(F.col(text_col)), 256).alias("text_sha256")), "hashes")
    rows = hashes.count()
    bits = filter_bits(rows)
    words = durable(repeated_cells(hashes, bits), "bloom")
    marked = mark_suspects(hashes, words, bits)
    single = marked.filter(~F.col("suspect")).select(
        F.col("_id"), F.col("_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "text_sha256")
    suspects = marked.filter("suspect").drop("suspect")
    groups = durable(suspects.groupBy("text_sha256").agg(
        F.min("_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "groups")
    # groups of a thousandth of all rows or more: a thousand at most, so their
    # rows meet them by broadcast and no key brings more rows to a task than that
    large = max(1000, rows // 1000)
    hot = groups.filter(F.col("group_size") >= large)
    cold = groups.filter(F.col("group_size") < large)
    cols = ["_id", "keep_id", "group_size", "text_sha256"]
    from_hot = suspects.join(F.broadcast(hot), "text_sha256").select(*cols)
    from_cold = (suspects.join(F.broadcast(hot.select("text_sha256")), "text_sha256", "left_anti")
                 .join(cold, "text_sha256").select(*cols))
    out = single.unionByName(from_hot).unionByName(from_cold)
    return out.select(F.col("_id").alias(id_col), "keep_id", "group_size",
                      F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that repeat a text of a smaller id. All columns unchanged.

    Rows that the filter clears are passed straight through; only suspects meet
    their group. Of rows that repeat both id and normalised text one stays: the
    least by its own text, then by the other columns as JSON.
    """
    keyed = docs.select(F.col(id_col).alias("_id"), F.sha2(normalised(F.col(text_col)), 256).alias("text_sha256"),
                        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"))
    hashes = durable(keyed.select("_id", "text_sha256"), "hashes")
    rows = hashes.count()
    bits = filter_bits(rows)
    words = durable(repeated_cells(hashes, bits), "bloom")
    marked = mark_suspects(keyed, words, bits)
    suspects = durable(marked.filter("suspect").drop("suspect"), "suspects")
    groups = durable(suspects.groupBy("text_sha256").agg(F.min("_id").alias("keep_id"),
                                                         F.count(F.lit(1)).alias("group_size")), "groups")
    large = F.col("group_size") >= max(1000, rows // 1000)
    first = (spread_join(suspects, groups, "text_sha256", groups.count(), large)
             .filter(F.col("_id").eqNullSafe(F.col("keep_id"))))
    # partial minima meet before the shuffle, so rows repeated many times don't gather in a task
    one = first.groupBy("text_sha256").agg(
        F.min_by("_doc", F.struct(F.col(f"_doc.`{text_col}`"), F.to_json("_doc"))).alias("_doc"))
    return marked.filter(~F.col("suspect")).select("_doc").unionByName(one.select("_doc")).select("_doc.*")
