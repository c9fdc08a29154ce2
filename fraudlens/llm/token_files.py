"""Token ids of a corpus in wavelet-matrix files, and what can be asked of them."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fraudlens.llm import wavelet
from fraudlens.llm.tokens import word_encoder
from fraudlens.session import new_path, stage

_MANIFEST = "part int, shard int, path string, n_docs long, n_tokens long, n_bytes long"


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def write_token_files(
    docs: DataFrame,
    folder: str | None = None,
    tokenizer: str = "word_bpe_49k.json",
    end_id: int = 2,
    shard_tokens: int = 1 << 20,
) -> DataFrame:
    """Encode ``docs(doc_id, text)`` into files in ascending doc_id order; returns their manifest.

    Rows are range-partitioned by (doc_id, hash of the text) and sorted inside each task, which cuts a
    file whenever ``shard_tokens`` is reached. A file has a name of its own per attempt, and only
    attempts that succeed get into the manifest, a staged table, so a repeated task does no harm.
    ``first`` in the manifest is the number of ids in all files before it.

    Defined cases: a null or empty text is the end id alone; null doc_ids come first; equal doc_ids are
    ordered by the hash of their text; an empty table gives an empty manifest; other columns are ignored.
    """
    spark = docs.sparkSession
    folder = folder or new_path(spark, "tokens")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = word_encoder(tokenizer, end_id), TaskContext.get().partitionId()
        system, root = _open(folder)
        system.create_dir(root, recursive=True)
        doc_ids: list = []
        blobs: list[bytes] = []
        shard = held = 0

        def save() -> pa.RecordBatch:
            nonlocal shard, held
            ids = np.frombuffer(b"".join(blobs), "<u4")
            data = wavelet.to_bytes(wavelet.WaveletMatrix.build(ids), doc_ids, [len(b) // 4 for b in blobs])
            name = f"{part:06d}-{shard:06d}-{uuid.uuid4().hex}.wm"
            with system.open_output_stream(f"{root}/{name}") as out:
                out.write(data)
            row = {
                "part": part, "shard": shard, "path": f"{folder}/{name}",
                "n_docs": len(doc_ids), "n_tokens": len(ids), "n_bytes": len(data),
            }
            doc_ids.clear()
            blobs.clear()
            shard, held = shard + 1, 0
            schema = pa.schema([
                ("part", pa.int32()), ("shard", pa.int32()), ("path", pa.string()),
                ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("n_bytes", pa.int64()),
            ])
            return pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                blob = encoder.encode(text.as_py())
                doc_ids.append(doc_id)
                blobs.append(blob)
                held += len(blob) // 4
                if held >= shard_tokens:
                    yield save()
        if blobs:
            yield save()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return with_first(stage(rows.mapInArrow(run, _MANIFEST), "token-manifest"))


def with_first(manifest: DataFrame) -> DataFrame:
    """Number of ids before each file: one window per task, carried by one total per task."""
    totals = manifest.groupBy("part").agg(F.sum("n_tokens").alias("_all"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select("part", F.coalesce(F.sum("_all").over(before), F.lit(0)).alias("_carried"))
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    local = F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))
    return manifest.withColumn("_local", local).join(carried, "part").select(
        *manifest.columns, (F.col("_local") + F.col("_carried")).alias("first")
    )


def _spread(manifest: DataFrame, files: int = 4) -> DataFrame:
    """Files dealt over tasks, about ``files`` to each: the manifest itself is small and would be one task."""
    tasks = -(-manifest.count() // files)
    return manifest.select("path", "first").repartitionByRange(max(1, tasks), "first")


def read_documents(manifest: DataFrame, with_ids: bool = True) -> DataFrame:
    """Documents read back from the files: doc_id, start, n_tokens, ids_crc32 and, if asked for, their ids."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                system, name = _open(path)
                with system.open_input_file(name) as file:
                    matrix, doc_ids, lengths = wavelet.from_bytes(file.read())
                ids = matrix.tokens().astype("<u4", copy=False)
                ends = np.cumsum(np.array([0, *lengths], np.int64))
                view = memoryview(ids).cast("B")
                parts = [view[4 * a : 4 * b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
                arrays = [
                    pa.array(doc_ids, pa.int64()),
                    pa.array(start + ends[:-1]),
                    pa.array(lengths, pa.int64()),
                    pa.array([zlib.crc32(p) for p in parts], pa.int64()),
                ]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    arrays.append(pa.array([bytes(p) for p in parts], pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")
    return _spread(manifest).mapInArrow(run, schema)


def find_token(manifest: DataFrame, token: int) -> DataFrame:
    """Occurrences of one token by select: doc_id, place in the document and in the corpus."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                system, name = _open(path)
                with system.open_input_file(name) as file:
                    matrix, doc_ids, lengths = wavelet.from_bytes(file.read())
                at = matrix.locate(token)
                ends = np.cumsum(np.array([0, *lengths], np.int64))
                doc = np.searchsorted(ends, at, side="right") - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([doc_ids[i] for i in doc.tolist()], pa.int64()),
                        pa.array(at - ends[doc]),
                        pa.array(start + at),
                    ],
                    ["doc_id", "place", "position"],
                )

    return _spread(manifest).mapInArrow(run, "doc_id long, place long, position long")


def count_token(manifest: DataFrame, token: int) -> DataFrame:
    """How often a token occurs, by two ranks a plane in each file: path, n."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, counts = batch.column(0).to_pylist(), []
            for path in paths:
                system, name = _open(path)
                with system.open_input_file(name) as file:
                    counts.append(wavelet.from_bytes(file.read())[0].count(token))
            yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(counts, pa.int64())], ["path", "n"])

    return _spread(manifest).mapInArrow(run, "path string, n long")
