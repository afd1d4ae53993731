"""Token counts of documents in flat token files without an index, by separator scan.

A token file is a run of little-endian unsigned ids in which an end-of-document id closes every document. Files are cut into
blocks of fixed size. A first pass finds the separators of each block with one vectorised comparison and gives one row per
block: number of separators and place of the last one. A prefix scan over the blocks of a file stitches them: what the
blocks before hold together says how many documents ended there and where the open document began. A second pass turns the
separators of each block into documents.

Edge cases: a block without a separator passes its open document on; a file whose last document has no separator ends with a
document marked as not closed; empty files and empty tables give no rows; NULL texts are documents of the separator alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize
from .common import open_store, prepare, run_folder, ship, tasks_for
from .tokens import Encoder


def write_token_files(docs: DataFrame, doc_id: str, text: str, path: str, pattern: str, separator: int, folder: str,
                      file_tokens: int = 1 << 26) -> DataFrame:
    """Encode every text, close it with ``separator`` and append it to flat files under ``folder``; a task rolls its file at
    ``file_tokens``. Returns the stored manifest, one row per document: (file, ordinal, doc_id).

    An attempt writes under names of its own and only the manifest, which Spark commits, says which files count; files of
    lost attempts are never read.
    """
    store_width = 4 if separator >= 1 << 16 else 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, (store, base) = Encoder(path, pattern), open_store(folder)
        dtype = np.dtype("<u4") if store_width == 4 else np.dtype("<u2")
        end = np.array([separator], dtype).tobytes()
        context = TaskContext.get()
        store.create_dir(base, recursive=True)
        out, name, size, ordinal, number = None, "", 0, 0, 0
        try:
            for batch in batches:
                files, ordinals = [], []
                for value in batch.column(1).to_pylist():
                    if out is None or size >= file_tokens * dtype.itemsize:
                        if out is not None:
                            out.close()
                        name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}-{number:05d}.bin"
                        out, size, ordinal, number = store.open_output_stream(f"{base}/{name}", compression=None), 0, 0, number + 1
                    data = encoder.encode(value or "")
                    if dtype != encoder.dtype:
                        data = np.frombuffer(data, encoder.dtype).astype(dtype).tobytes()
                    out.write(data + end)
                    size += len(data) + len(end)
                    files.append(name)
                    ordinals.append(ordinal)
                    ordinal += 1
                yield pa.RecordBatch.from_arrays([pa.array(files, pa.string()), pa.array(ordinals, pa.int64()), batch.column(0)],
                                                 names=["file", "ordinal", "doc_id"])
        finally:
            if out is not None:
                out.close()

    kind = docs.schema[doc_id].dataType.simpleString()
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return materialize(narrow.mapInArrow(run, f"file string, ordinal long, doc_id {kind}"), "token-manifest")


def blocks_of(files: DataFrame, folder: str, width: int, block_tokens: int) -> DataFrame:
    """(file, block, first, n) for every block of the listed files; sizes are asked for on the executors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_store(folder)
        for batch in batches:
            names = batch.column(0).to_pylist()
            rows = []
            for name, info in zip(names, store.get_file_info([f"{base}/{n}" for n in names]), strict=True):
                total = info.size // width
                rows += [(name, b, first, min(block_tokens, total - first)) for b, first in enumerate(range(0, total, block_tokens))]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.string()] + [pa.int64()] * 3,
                                                                                 strict=True)], names=["file", "block", "first", "n"])

    return files.select("file").mapInArrow(run, "file string, block long, first long, n long")


def scan_separators(spark: SparkSession, files: DataFrame, folder: str, separator: int, width: int = 2,
                    block_tokens: int = 1 << 20) -> DataFrame:
    """Documents of the files in column ``file``: (file, ordinal, start, n_tokens, closed). n_tokens excludes the separator."""
    prepare(spark)

    def places(store, base, name, first, n) -> np.ndarray:
        with store.open_input_file(f"{base}/{name}") as source:
            source.seek(first * width)
            data = np.frombuffer(source.read(n * width), "<u2" if width == 2 else "<u4")
        return np.flatnonzero(data == separator) + first

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_store(folder)
        for batch in batches:
            counts, lasts = [], []
            for name, _, first, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at = places(store, base, name, first, n)
                counts.append(at.size)
                lasts.append(int(at[-1]) if at.size else None)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(counts, pa.int64()), pa.array(lasts, pa.int64())],
                                             names=["file", "block", "first", "n", "found", "last_end"])

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_store(folder)
        for batch in batches:
            for name, first, n, ordinal, start, final in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ends = places(store, base, name, first, n)
                closed = np.ones(ends.size, bool)
                starts = np.concatenate([[start], ends + 1])
                if final and starts[-1] < first + n:
                    ends, closed = np.append(ends, first + n), np.append(closed, False)
                starts = starts[:ends.size]
                if ends.size:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * ends.size, pa.string()), pa.array(ordinal + np.arange(ends.size)), pa.array(starts, pa.int64()),
                         pa.array(ends - starts, pa.int64()), pa.array(closed)], names=["file", "ordinal", "start", "n_tokens", "closed"])

    blocks = materialize(blocks_of(files.select("file").distinct(), folder, width, block_tokens), "token-block-list")
    total, count = blocks.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    tasks = tasks_for(spark, total * width, count)
    found = materialize(blocks.repartition(tasks, "file", "block").mapInArrow(
        summarise, "file string, block long, first long, n long, found long, last_end long"), "token-blocks")
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    carried = found.select(
        "file", "first", "n", F.coalesce(F.sum("found").over(before), F.lit(0)).alias("ordinal"),
        F.coalesce(F.max("last_end").over(before) + 1, F.lit(0)).alias("start"),
        F.lead("block").over(W.partitionBy("file").orderBy("block")).isNull().alias("final"))
    return carried.repartition(tasks, "file", "first").mapInArrow(documents, "file string, ordinal long, start long, n_tokens long, closed boolean")


def count_tokens(docs: DataFrame, doc_id: str, text: str, path: str, pattern: str, separator: int) -> DataFrame:
    """Write the texts as token files, then count their tokens from the files: (doc_id, file, ordinal, start, n_tokens)."""
    spark = docs.sparkSession
    folder = run_folder(spark, "token-files")
    manifest = write_token_files(docs, doc_id, text, path, pattern, separator, folder)
    width = 4 if separator >= 1 << 16 else 2
    counted = scan_separators(spark, manifest.select("file").distinct(), folder, separator, width)
    # both sides have a row per document, so neither may be broadcast, however well its files compress
    return manifest.hint("merge").join(counted, ["file", "ordinal"]).select("doc_id", "file", "ordinal", "start", "n_tokens")


ship(__name__)
