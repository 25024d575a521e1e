"""Token ids as flat binary files with 64-bit offsets, read by memory mapping.

``write`` sorts documents by id across partitions and encodes them. Each task
writes three files of its own to the shared folder, under a name no other
attempt uses, so a task that is lost and run again leaves nothing half written
in the way; only the files that a successful attempt reports enter the index:

* ``.ids``  ids as little-endian unsigned integers (16 bits where the
  vocabulary allows it, else 32), document after document;
* ``.off``  64-bit offsets of the documents within the file, and its end;
* ``.doc``  64-bit document ids.

The index has a row for each partition. A partition's base, the number of ids
before it, is the prefix sum of the sizes of the partitions before it: only
these sizes, one number a partition, come to the driver.

``read`` maps the files and returns a row for each document.

Defined results: a null text counts as empty (it has only the end id); a null
document id sorts first and is kept as null (the smallest 64-bit integer in
the file); repeated rows are written once each; other columns are ignored.
"""

from __future__ import annotations

import contextlib
import json
import os
import tempfile
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from reelstar.llm.chunked import ChunkEncoder
from reelstar.llm.common import blocks, small_batches
from reelstar.llm.token_counts import chunks

#: Marks that end a word.
TAILS = ",.!?;:%&*#$|"
NULL_ID = -(1 << 63)
INDEX = "part int, name string, n_docs long, n_tokens long, base long, width int"


def _open_fs(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if ":" in uri else (fs.LocalFileSystem(), uri)


@lru_cache(maxsize=2)
def _encoder(path: str) -> ChunkEncoder:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    tokenizer = Tokenizer.from_file(path)
    # white space must only separate: nothing else may depend on it
    spec = json.loads(tokenizer.to_str())
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
        raise ValueError("special tokens that take white space can't be encoded by chunk")
    def ids(*parts: str) -> list[int]:
        return [i for p in parts for i in tokenizer.encode(p, add_special_tokens=False).ids]

    if ids("thorn, \n été! ") != ids("thorn,", "été!"):
        raise ValueError("this vocabulary encodes white space; chunks would differ from whole texts")
    # end marks go separately if the vocabulary never joins them to a word or a mark before
    apart = all(ids(f"{w}{m}{n}") == ids(w, f"{m}{n}") for w in ("thorn", "été", "x7", "don't") for m in TAILS
                for n in ("", ".", "!"))
    return ChunkEncoder(tokenizer, chunks, TAILS if apart else "")


def _width(tokenizer_path: str, end_id: int) -> int:
    return 2 if max(Tokenizer.from_file(tokenizer_path).get_vocab_size() - 1, end_id) < 1 << 16 else 4


def write(docs: DataFrame, tokenizer_path: str, folder: str, end_id: int = 1,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the files to ``folder`` (shared by all executors); the index."""
    spark = docs.sparkSession
    small_batches(spark)
    width = _width(tokenizer_path, end_id)
    run_id = uuid.uuid4().hex[:8]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_path)
        part = TaskContext.get().partitionId()
        name = f"{run_id}-{part:06d}-{uuid.uuid4().hex[:12]}"
        store, root = _open_fs(folder)
        offsets, ids_seen = [np.zeros(1, np.int64)], []
        total = 0
        sink = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            if sink is None:
                store.create_dir(root, recursive=True)
                sink = store.open_output_stream(f"{root}/{name}.ids")
            texts = batch.column(1).to_pylist()
            ids_seen.append(batch.column(0).fill_null(NULL_ID).to_numpy(zero_copy_only=False))
            for a, b in blocks(texts):
                flat, lens = encoder.encode(texts[a:b])
                ends = np.cumsum(lens + 1)
                out = np.empty(ends[-1], f"<u{width}")
                mask = np.ones(len(out), bool)
                mask[ends - 1] = False
                out[mask], out[ends - 1] = flat, end_id
                sink.write(out.tobytes())
                offsets.append(total + ends)
                total += int(ends[-1])
        if sink is None:
            return
        sink.close()
        for kind, arrays in (("off", offsets), ("doc", ids_seen)):
            with store.open_output_stream(f"{root}/{name}.{kind}") as out_file:
                out_file.write(np.concatenate(arrays).astype("<i8").tobytes())
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([part], pa.int32()), "name": pa.array([name]),
            "n_docs": pa.array([sum(map(len, ids_seen))], pa.int64()), "n_tokens": pa.array([total], pa.int64())})

    text = F.coalesce(F.col(text_col), F.lit(""))
    # rows of one id keep an order of their own, so that a task run again writes the same
    dealt = (docs.select(F.col(id_col).cast("long").alias("_id"), text.alias("_t"))
             .repartitionByRange("_id")
             .sortWithinPartitions("_id", F.xxhash64("_t")))
    sizes = dealt.mapInArrow(run, "part int, name string, n_docs long, n_tokens long").collect()
    rows, base = [], 0
    for r in sorted(sizes, key=lambda r: r.part):
        rows.append((r.part, r.name, r.n_docs, r.n_tokens, base, width))
        base += r.n_tokens
    return spark.createDataFrame(rows, INDEX)


@contextlib.contextmanager
def _mapped(folder: str, name: str, kind: str, dtype: str):
    """A file as a mapped array; from a store without local paths it is
    fetched to the task's own temporary folder for as long as it is read."""
    store, root = _open_fs(folder)
    path = f"{root}/{name}.{kind}"
    if isinstance(store, fs.LocalFileSystem):
        yield np.memmap(path, dtype, "r") if os.path.getsize(path) else np.zeros(0, dtype)
        return
    with tempfile.TemporaryDirectory() as tmp:
        local = os.path.join(tmp, kind)
        fs.copy_files(path, local, source_filesystem=store, destination_filesystem=fs.LocalFileSystem())
        yield np.memmap(local, dtype, "r") if os.path.getsize(local) else np.zeros(0, dtype)


def read(index: DataFrame, folder: str, id_col: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """``(id, start, n_tokens, ids_crc32)`` for each document in the files, and
    its ``ids`` on request; ``start`` counts the ids of all documents before."""
    extra = ", ids array<int>" if with_ids else ""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for part in pdf.itertuples():
                with _mapped(folder, part.name, "ids", f"<u{part.width}") as ids, \
                        _mapped(folder, part.name, "off", "<i8") as off, \
                        _mapped(folder, part.name, "doc", "<i8") as doc:
                    for a in range(0, len(doc), 5000):
                        o = off[a:a + 5001]
                        spans = [ids[s:e] for s, e in zip(o[:-1], o[1:], strict=True)]
                        d = pd.Series(np.array(doc[a:a + 5000]), dtype="Int64")
                        out = pd.DataFrame({
                            id_col: d.mask(d == NULL_ID), "start": part.base + o[:-1], "n_tokens": np.diff(o),
                            "ids_crc32": [zlib.crc32(x.astype("<u4").tobytes()) for x in spans]})
                        if with_ids:
                            out["ids"] = [x.astype(np.int32) for x in spans]
                        yield out

    # one file set a task: the files differ little in size
    parts = max(1, index.count())
    return (index.repartition(parts, "part")
            .mapInPandas(run, f"{id_col} long, start long, n_tokens long, ids_crc32 long{extra}"))


def write_and_read(spark: SparkSession, docs: DataFrame, tokenizer_path: str, folder: str,
                   end_id: int = 1) -> DataFrame:
    return read(write(docs, tokenizer_path, folder, end_id), folder)
