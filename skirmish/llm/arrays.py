"""Vectorised text helpers that run inside tasks: words, word hashes and ragged arrays over Arrow text.

A text column is handled in chunks of whole documents (``text_chunks``), so the working memory of a
task is a small multiple of the chunk size, or of the longest single document when that is larger.
Words are ``[^\\x20\\x09-\\x0D]+`` on the UTF-8 bytes (white space is ASCII, so bytes and code points
agree on the boundaries).  ``span_hashes`` are polynomial hashes modulo two primes, with a final mix: words chosen
against a modulus of 2 ** 64 (the Thue-Morse word and its complement, for any base) do not collide.  ``span_keys`` is the
cheaper form modulo 2 ** 64, for tables that compare contents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

CHUNK_BYTES = 1 << 18
CHUNK_ROWS = 4096

WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

LOWER_ASCII = np.arange(256, dtype=np.uint8)
LOWER_ASCII[65:91] += 32

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
#: Two primes below 2 ** 31 with a base each, for ``span_hashes``.
MODULI = ((2147483647, 0x2F8E3A15), (2147483629, 0x5B1C94D7))


def task_udf(fn, ddl: str):
    """Arrow UDF of ``fn``; marked non-deterministic so that no filter makes Spark evaluate it twice."""
    return F.arrow_udf(fn, ddl).asNondeterministic()


def bounded_batches(spark) -> None:
    """Hand texts to Python in Arrow batches of at most 16 MB (Spark's default is 64 MB), unless the session says otherwise.

    Texts may be long, and an executor holds a batch per core several times over (Arrow buffers, the pipe,
    the worker), so this bounds what a task needs beside its own chunk.
    """
    key, default = "spark.sql.execution.arrow.maxBytesPerBatch", str(64 << 20)
    if spark.conf.get(key).rstrip("bB") == default:
        spark.conf.set(key, str(16 << 20))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (bijective)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def powers(n: int, base: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def powers_modulo(n: int, base: int, prime: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo a prime below 2 ** 31."""
    out = np.ones(1, np.uint64)
    while len(out) < n:
        out = np.append(out, out * np.uint64(pow(base, len(out), prime)) % np.uint64(prime))
    return out[:n]


class Powers:
    """Powers of the hash bases and of their inverses, grown on demand."""

    def __init__(self):
        self.up = self.down = np.empty(0, dtype=np.uint64)
        self.primes: list[tuple[np.ndarray, np.ndarray]] = []

    def modulo(self, n: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(prime, powers of its base, powers of the base's inverse) for each modulus."""
        if not self.primes or len(self.primes[0][0]) < n:
            size = max(n, CHUNK_BYTES + 1)
            self.primes = [(powers_modulo(size, b, p), powers_modulo(size, pow(b, -1, p), p)) for p, b in MODULI]
        return [(p, up[:n], down[:n]) for (p, _), (up, down) in zip(MODULI, self.primes)]

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, CHUNK_BYTES + 1)
            self.up, self.down = powers(size, BASE), powers(size, INVERSE)
        return self.up[:n], self.down[:n]


def buffers_of(column) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes, int64 offsets) of an Arrow string column; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if column.null_count:
        column = pc.fill_null(column, "")
    n = len(column)
    if n == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=kind)[column.offset:column.offset + n + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)), at


def text_chunks(column, chunk_bytes: int = CHUNK_BYTES, chunk_rows: int = CHUNK_ROWS):
    """Yield (first row, end row, bytes, starts): ``starts`` has one more entry than rows."""
    data, at = buffers_of(column)
    n, i = len(at) - 1, 0
    while i < n:
        j = int(np.searchsorted(at, at[i] + chunk_bytes, "right")) - 1
        j = min(max(j, i + 1), i + chunk_rows, n)
        yield i, j, data[at[i]:at[j]], at[i:j + 1] - at[i]
        i = j
    pa.default_memory_pool().release_unused()  # what earlier batches needed goes back before the next one comes


def word_spans(data: np.ndarray, starts: np.ndarray, white: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end, first word of each document + total) of the words; no word crosses documents."""
    if len(data) == 0:
        none = np.empty(0, np.int64)
        return none, none, np.zeros(len(starts), np.int64)
    word = ~white[data]
    begin, end = word.copy(), word.copy()
    begin[1:] &= ~word[:-1]
    end[:-1] &= ~word[1:]
    edge = starts[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    begin[edge] = word[edge]
    end[edge - 1] = word[edge - 1]
    begin, end = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return begin, end, np.searchsorted(begin, starts)


def span_hashes(codes: np.ndarray, begin: np.ndarray, end: np.ndarray, power: Powers) -> np.ndarray:
    """64-bit hash of codes[begin:end] for each span from its residues modulo two primes; equal spans hash equally wherever they are."""
    values, both = codes.astype(np.uint64) + np.uint64(1), np.zeros(len(begin), np.uint64)
    # sums run modulo 2 ** 64; a span's own sum must stay below that, else every product is reduced first
    small = len(begin) == 0 or int((end - begin).max()) * int(values.max(initial=1)) < 1 << 32
    for prime, up, down in power.modulo(len(codes) + 1):
        p, total = np.uint64(prime), np.zeros(len(codes) + 1, np.uint64)
        products = values * up[:-1]
        np.cumsum(products if small else products % p, out=total[1:])
        both = (both << np.uint64(32)) | ((total[end] - total[begin]) % p * down[begin] % p)
    return mix(both + (end - begin).astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D))


def span_keys(codes: np.ndarray, begin: np.ndarray, end: np.ndarray, power: Powers) -> np.ndarray:
    """64-bit hash of each span modulo 2 ** 64, for tables that compare contents on a hit."""
    up, down = power.get(len(codes) + 1)
    total = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(0x51ED27)) * up[:-1], out=total[1:])
    return mix((total[end] - total[begin]) * down[begin] + (end - begin).astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D))


def ragged(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Indices begin[0] .. begin[0] + length[0] - 1, begin[1] .. and so on."""
    total = int(length.sum())
    if total == 0:
        return np.empty(0, np.int64)
    before = np.cumsum(length) - length
    return np.repeat(begin - before, length) + np.arange(total)


def window_hashes(words: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all ``width``-word windows inside documents.

    Returns (hash per window start, start word index, first window of each document + total).
    """
    n = np.diff(first)
    per_doc = np.maximum(n - width + 1, 0)
    at = ragged(first[:-1], per_doc)
    total = np.zeros(len(at), dtype=np.uint64)
    for k in range(width):
        total += words[at + k] * np.uint64((0xA24BAED4963EE407 * (2 * k + 1) ** 3 | 1) & 0xFFFFFFFFFFFFFFFF)
    bounds = np.zeros(len(first), np.int64)
    np.cumsum(per_doc, out=bounds[1:])
    return mix(total), at, bounds


def segment_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of values[bounds[i]:bounds[i + 1]] for each i; empty segments give 0."""
    total = np.zeros(len(values) + 1, dtype=values.dtype if values.dtype.kind in "uf" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]
