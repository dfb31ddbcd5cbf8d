"""Token ids in binary files: independent zstandard frames, a trailing seek table, checksums per frame.

A file holds the ids of consecutive documents as one stream of little-endian uint32, cut every
``FRAME_TOKENS`` tokens.  Layout of ``part-00000.ids.zst``:

    zstandard frame (content checksum on)      one per FRAME_TOKENS tokens
    ...
    skippable frame 0x184D2A50                 document index: zstandard of doc_id, start, n_tokens, known (int64 columns; known is
                                               0 for a document without a doc_id)
    skippable frame 0x184D2A5E                 seek table of the public seekable format: per frame compressed size,
                                               size and the low 32 bits of its xxh64; frame count; flags; 0x8F92EAB1

Plain zstandard tools read the stream; a reader that wants some documents reads the seek table and the
index from the end of the file and decompresses only the frames that hold them.

Files follow ascending doc_id: documents are range-partitioned and each task streams its range into one
file, through a temporary name that is renamed when complete, so a lost or repeated task leaves no half
file.  The driver sees one manifest row per file.

Defined results: a null or empty text holds the end id only; a null doc_id comes first; rows that repeat a
doc_id lie side by side; an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import io
import struct
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tokens import library_encoder

FRAME_TOKENS = 1 << 15
END_ID = 0
INDEX_MAGIC, SEEK_MAGIC, SEEK_END = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
LEVEL = 1

MANIFEST = "file int, path string, docs bigint, tokens bigint"
DOCUMENT = "doc_id bigint, start bigint, n_tokens bigint, ids binary"


class Writer:
    """Streams token ids of documents into one open file."""

    def __init__(self, out, frame_tokens: int = FRAME_TOKENS):
        import xxhash
        import zstandard
        self.out, self.frame_tokens = out, frame_tokens
        self.zstd = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, write_content_size=True)
        self.checksum = lambda b: xxhash.xxh64_intdigest(b) & 0xFFFFFFFF
        self.pending, self.held, self.tokens = [], 0, 0
        self.frames, self.index = [], []

    def add(self, doc_ids: np.ndarray, sizes: np.ndarray, ids: np.ndarray, known: np.ndarray | None = None) -> None:
        """Documents with their ids one after the other; ``known`` is false where a doc_id is missing."""
        known = np.ones(len(doc_ids), bool) if known is None else known
        self.index.append(np.stack([doc_ids, self.tokens + np.cumsum(sizes) - sizes, sizes, known.astype(np.int64)]))
        self.tokens += len(ids)
        self.pending.append(ids.astype("<u4"))
        self.held += len(ids)
        if self.held >= self.frame_tokens:
            data = np.concatenate(self.pending)
            whole = len(data) - len(data) % self.frame_tokens
            for k in range(0, whole, self.frame_tokens):
                self._frame(data[k:k + self.frame_tokens])
            self.pending, self.held = [data[whole:]], len(data) - whole

    def _frame(self, ids: np.ndarray) -> None:
        raw = ids.tobytes()
        packed = self.zstd.compress(raw)
        self.out.write(packed)
        self.frames.append((len(packed), len(raw), self.checksum(raw)))

    def close(self) -> int:
        """Write what is left, the index and the seek table; returns the number of documents."""
        if self.held:
            self._frame(np.concatenate(self.pending))
        index = np.concatenate(self.index, axis=1) if self.index else np.empty((4, 0), np.int64)
        packed = self.zstd.compress(index.astype("<i8").tobytes())
        self.out.write(struct.pack("<II", INDEX_MAGIC, len(packed)) + packed)
        self.frames.append((8 + len(packed), 0, 0))
        table = b"".join(struct.pack("<III", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), 0x80, SEEK_END)
        self.out.write(struct.pack("<II", SEEK_MAGIC, len(table)) + table)
        return index.shape[1]


class Reader:
    """Random access to one file through its seek table."""

    def __init__(self, file):
        import xxhash
        import zstandard
        self.file, self.zstd = file, zstandard.ZstdDecompressor()
        self.checksum = lambda b: xxhash.xxh64_intdigest(b) & 0xFFFFFFFF
        size = file.seek(0, io.SEEK_END)
        count, flags, magic = struct.unpack("<IBI", self._read(size - 9, 9))
        if magic != SEEK_END or not flags & 0x80:
            raise ValueError("no seek table with checksums at the end of the file")
        table = np.frombuffer(self._read(size - 9 - 12 * count, 12 * count), "<u4").reshape(count, 3).astype(np.int64)
        self.at = np.append(0, np.cumsum(table[:, 0]))
        self.sizes, self.sums = table[:, 1], table[:, 2]
        packed = self._read(int(self.at[-2]) + 8, int(self.at[-1] - self.at[-2]) - 8)
        index = np.frombuffer(self.zstd.decompress(packed), "<i8").reshape(4, -1)
        self.doc_id, self.start, self.n_tokens = index[:3]
        self.known = index[3] > 0
        self.frame_start = np.append(0, np.cumsum(self.sizes[:-1] // 4))
        self.frames_read = 0

    def _read(self, at: int, size: int) -> bytes:
        self.file.seek(at)
        return self.file.read(size)

    def frame(self, k: int) -> np.ndarray:
        raw = self.zstd.decompress(self._read(int(self.at[k]), int(self.at[k + 1] - self.at[k])), int(self.sizes[k]))
        if len(raw) != self.sizes[k] or self.checksum(raw) != self.sums[k]:
            raise ValueError(f"frame {k} does not match its checksum")
        self.frames_read += 1
        return np.frombuffer(raw, "<u4")

    def tokens(self, start: int, n: int) -> np.ndarray:
        """Tokens start .. start + n - 1 of the file; decompresses only the frames that hold them."""
        lo = int(np.searchsorted(self.frame_start, start, "right")) - 1
        hi = int(np.searchsorted(self.frame_start, start + max(n, 1) - 1, "right"))
        data = np.concatenate([self.frame(k) for k in range(lo, hi)])
        return data[start - self.frame_start[lo]:][:n]

    def documents(self, batch_tokens: int = 1 << 20):
        """Yield (first document, end document, their ids) in file order, one pass over the frames."""
        at, k, data, base = 0, 0, np.empty(0, np.uint32), 0
        while at < len(self.start):
            end = max(int(np.searchsorted(self.start, self.start[at] + batch_tokens)), at + 1)
            stop = int(self.start[end - 1] + self.n_tokens[end - 1])
            parts = [data[self.start[at] - base:]]
            base, have = int(self.start[at]), len(parts[0])
            while base + have < stop:
                parts.append(self.frame(k))
                have, k = have + len(parts[-1]), k + 1
            data = np.concatenate(parts)
            yield at, end, data[:stop - base]
            at = end


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, frame_tokens: int = FRAME_TOKENS) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into files below ``path``; returns the manifest (one row per file)."""
    spark = docs.sparkSession

    def store(batches):
        file = TaskContext.get().partitionId()
        fs, root = pafs.FileSystem.from_uri(path)
        attempt, final = f"{root}/_attempts/{file:05d}-{uuid.uuid4().hex}", f"{root}/part-{file:05d}.ids.zst"
        encoder, writer, out = library_encoder(tokenizer), None, None
        for batch in batches:
            if batch.num_rows and writer is None:
                fs.create_dir(f"{root}/_attempts", recursive=True)
                out = fs.open_output_stream(attempt)
                writer = Writer(out, frame_tokens)
            known = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            doc_ids = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            for i, j, ids, size in encoder.encode_column(batch.column(1)):
                writer.add(doc_ids[i:j], size + 1, np.insert(ids.astype(np.uint32), np.cumsum(size), end_id), known[i:j])
        if writer is not None:
            n = writer.close()
            out.close()
            fs.move(attempt, final)
            yield pa.RecordBatch.from_pydict({"file": pa.array([file], pa.int32()), "path": [final], "docs": [n], "tokens": [writer.tokens]})

    ordered = docs.select(F.col("doc_id").cast("bigint"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    rows = ordered.mapInArrow(store, MANIFEST).collect()  # one row per file
    manifest = spark.createDataFrame(rows, MANIFEST)
    manifest.coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest")
    return spark.read.parquet(f"{path}/manifest")


def read(spark: SparkSession, path: str) -> DataFrame:
    """All documents of the files below ``path``: doc_id, start (ids of all documents before), n_tokens, ids."""
    files = sorted(spark.read.parquet(f"{path}/manifest").collect(), key=lambda r: r.file)  # one row per file
    base, rows = 0, []
    for r in files:
        rows.append((r.path, base))
        base += r.tokens
    if not rows:
        return spark.createDataFrame([], DOCUMENT)

    def load(batches):
        fs, _ = pafs.FileSystem.from_uri(path)
        for batch in batches:
            for name, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with fs.open_input_file(name) as file:
                    reader = Reader(file)
                    for i, j, ids in reader.documents():
                        cut = np.append(reader.start[i:j], reader.start[j - 1] + reader.n_tokens[j - 1]) - reader.start[i]
                        raw = pa.Array.from_buffers(pa.binary(), j - i, [None, pa.py_buffer((4 * cut).astype(np.int32)), pa.py_buffer(ids.tobytes())])
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(reader.doc_id[i:j], mask=~reader.known[i:j]), pa.array(reader.start[i:j] + before), pa.array(reader.n_tokens[i:j]), raw],
                            ["doc_id", "start", "n_tokens", "ids"])

    listed = spark.createDataFrame(rows, "path string, before bigint").repartition(len(rows))
    return listed.mapInArrow(load, DOCUMENT)


def fetch(path: str, file_path: str, doc_ids: list[int]) -> dict[int, list[int]]:
    """Ids of some documents of one file, decompressing only the frames that hold them."""
    fs, _ = pafs.FileSystem.from_uri(path)
    with fs.open_input_file(file_path) as file:
        reader = Reader(file)
        rows = np.flatnonzero(np.isin(reader.doc_id, doc_ids) & reader.known)
        return {int(reader.doc_id[r]): reader.tokens(int(reader.start[r]), int(reader.n_tokens[r])).tolist() for r in rows}
