"""Token ids in Arrow files of equal-length sequences, with zero-copy random access."""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexmill.llm.common import keyed, map_rows, slices
from lexmill.llm.tokens import encoder
from lexmill.session import stage

ROWS = 128  # sequences in a record batch; the same in each batch but the last of a file
INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
MANIFEST = "shard int, path string, index_path string, n_docs long, n_tokens long"


def file_schema(length: int, id_type: pa.DataType) -> pa.Schema:
    return pa.schema([("ids", pa.list_(id_type, length)), ("mask", pa.list_(pa.bool_(), length))])


def _fs(path: str) -> tuple[pafs.FileSystem, str]:
    # The same store under the scheme that Arrow knows it by.
    path = path.replace("s3a://", "s3://", 1) if path.startswith("s3a://") else path
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else os.path.abspath(path))


class _Writer:
    """Ids as they come to sequences of one length, a record batch at a time."""

    def __init__(self, sink, length: int, id_type: pa.DataType):
        self.schema = file_schema(length, id_type)
        self.length, self.dtype = length, id_type.to_pandas_dtype()
        self.file = pa.ipc.new_file(sink, self.schema)
        self.parts, self.held, self.total = [], 0, 0

    def add(self, ids: np.ndarray) -> None:
        if len(ids) and ids.max() > np.iinfo(self.dtype).max:
            raise ValueError(f"id {ids.max()} does not fit {np.dtype(self.dtype)}: give the tokenizer's vocabulary")
        self.parts.append(ids.astype(self.dtype))
        self.held += len(ids)
        self.total += len(ids)
        if self.held >= self.length * ROWS:
            self._flush(self.held // (self.length * ROWS) * ROWS)

    def _flush(self, n: int) -> None:
        flat = np.concatenate(self.parts) if self.parts else np.zeros(0, self.dtype)
        size = n * self.length
        full, self.parts = flat[:size], [flat[size:]] if len(flat) > size else []
        self.held = sum(map(len, self.parts))
        real = len(full)
        if real < size:
            full = np.concatenate([full, np.zeros(size - real, self.dtype)])
        for at in range(0, n, ROWS):
            cut = slice(at * self.length, min(n, at + ROWS) * self.length)
            mask = np.arange(cut.start, cut.stop) < real
            self.file.write_batch(pa.RecordBatch.from_arrays(
                [pa.FixedSizeListArray.from_arrays(pa.array(full[cut]), type=self.schema.field(0).type),
                 pa.FixedSizeListArray.from_arrays(pa.array(mask), type=self.schema.field(1).type)],
                schema=self.schema))

    def close(self) -> None:
        if self.held:
            self._flush(-(-self.held // self.length))
        self.file.close()


class TokenFile:
    """One file: sequence ``i`` of equal length and its mask, or any run of ids. Local files are mapped, not read."""

    def __init__(self, path: str):
        files, inner = _fs(path)
        local = isinstance(files, pafs.LocalFileSystem)
        self.source = pa.memory_map(inner) if local else files.open_input_file(inner)
        self.reader = pa.ipc.open_file(self.source)
        self.length = self.reader.schema.field("ids").type.list_size
        self._at, self._batch = -1, None

    def batch(self, k: int) -> pa.RecordBatch:
        if k != self._at:
            self._at, self._batch = k, self.reader.get_batch(k)
        return self._batch

    def __len__(self) -> int:
        n = self.reader.num_record_batches
        return (n - 1) * ROWS + self.batch(n - 1).num_rows if n else 0

    def _flat(self, k: int) -> np.ndarray:
        return self.batch(k).column(0).flatten().to_numpy(zero_copy_only=True)

    def ids(self, i: int) -> np.ndarray:
        """A view of the file's own bytes."""
        at = i % ROWS * self.length
        return self._flat(i // ROWS)[at:at + self.length]

    def mask(self, i: int) -> pa.BooleanArray:
        return self.batch(i // ROWS).column(1)[i % ROWS].values

    def tokens(self, start: int, n: int) -> np.ndarray:
        size, parts, end = ROWS * self.length, [], start + n
        while start < end:
            stop = min(end, (start // size + 1) * size)
            parts.append(self._flat(start // size)[start % size:start % size + stop - start])
            start = stop
        return np.concatenate(parts) if parts else np.zeros(0, dtype="<u4")

    def close(self) -> None:
        self.source.close()


def write_token_files(docs: DataFrame, tokenizer_json: str, folder: str, length: int = 2048, end_id: int = 0,
                      id_col: str = "doc_id", text_col: str = "text", vocabulary: int = 1 << 16) -> DataFrame:
    """Encode every whole text, in ascending order of the id, into files below ``folder``; returns the manifest.

    Each range of ids is one shard: a file of ``ids`` and ``mask`` (false on padding,
    which only the last sequence of a shard has) and an index of its documents. Ids are
    16 bit where the vocabulary allows, and an id beyond that is an error. Files are named by the attempt of the task, and
    the manifest names those of the attempt that counts, so lost or doubled tasks do no
    harm. A null or empty text is the end id alone; null ids come first; equal ids are
    ordered by text. An empty table gives an empty manifest.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json)
    id_type = pa.uint16() if vocabulary <= 1 << 16 else pa.uint32()

    def write(batches):
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        encode = encoder(shared.value).packed
        task = TaskContext.get()
        name = f"{folder}/part-{task.partitionId():06d}-{task.taskAttemptId()}"
        files, inner = _fs(name)
        files.create_dir(os.path.dirname(inner), recursive=True)
        end = np.array([end_id], dtype="<u4").tobytes()
        n_docs = 0
        with files.open_output_stream(f"{inner}.arrow") as sink, \
                files.open_output_stream(f"{inner}.index.arrow") as index_sink, \
                pa.ipc.new_file(index_sink, INDEX) as index:
            out = _Writer(sink, length, id_type)

            def all_batches():
                yield first
                yield from batches

            for batch in slices(all_batches()):
                starts, sizes = [], []
                for ids in encode(batch.column(1).to_pylist()):
                    starts.append(out.total)
                    out.add(np.frombuffer(ids + end, dtype="<u4"))
                    sizes.append(out.total - starts[-1])
                index.write_batch(pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64())], schema=INDEX))
                n_docs += batch.num_rows
            out.close()
        yield pa.RecordBatch.from_pylist([{
            "shard": task.partitionId(), "path": f"{name}.arrow", "index_path": f"{name}.index.arrow",
            "n_docs": n_docs, "n_tokens": out.total}], schema=pa.schema([
                ("shard", pa.int32()), ("path", pa.string()), ("index_path", pa.string()),
                ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))

    rows = keyed(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    order = ["doc_id", F.xxhash64("text")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return stage(map_rows(ordered, write, MANIFEST), "manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from the files of a manifest; ``start`` counts all shards before.

    The running total goes over one row per file. Each task maps its files and holds one record batch at a time.
    """
    before = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    files = manifest.select("path", "index_path", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))
    n = max(1, manifest.count())

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                tokens = TokenFile(row["path"])
                source, inner = _fs(row["index_path"])
                with source.open_input_file(inner) as f:
                    index = pa.ipc.open_file(f)
                    for k in range(index.num_record_batches):
                        part = index.get_batch(k)
                        starts, sizes = part.column(1).to_numpy(), part.column(2).to_numpy()
                        sums = [zlib.crc32(tokens.tokens(s, m).astype("<u4").tobytes())
                                for s, m in zip(starts.tolist(), sizes.tolist())]
                        yield pa.RecordBatch.from_arrays(
                            [part.column(0), pa.array(starts + row["base"]), part.column(2),
                             pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])
                tokens.close()

    return map_rows(files.repartition(n), read, "doc_id long, start long, n_tokens long, ids_crc32 long")
