"""Best-fit packing of documents into fixed-length token sequences after Martello-Toth dominance reduction.

Bin packing only depends on how many pieces there are of each length, and lengths are bounded by the
sequence length.  So the plan is made on the driver from a histogram of at most ``capacity`` rows,
whatever the corpus size:

1. Reduction (Martello and Toth): a set of at most three lengths that provably dominates every other set
   holding a given piece is fixed for good, and the instance shrinks; repeated until nothing is fixed.
2. Best-fit decreasing packs the remainder, whole groups of equal sequences at a time.

The plan maps (length, rank among the pieces of that length) to (sequence, offset).  Ranks are counted in
hash blocks, so a length that a third of all pieces share is not gathered in one task.

Defined results: a null or empty text is one piece that holds the end id only; rows that repeat a doc_id
are packed one by one; a null doc_id is packed like any other; an empty table gives an empty table.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ranking import blocked_row_number
from ..session import materialize
from .arrays import task_udf
from .tokens import library_encoder

CAPACITY = 1024
END_ID = 2

PIECE = "array<struct<piece:int,start:bigint,length:bigint,ids_crc32:bigint>>"
PIECE_IDS = "array<struct<piece:int,start:bigint,length:bigint,ids_crc32:bigint,ids:binary>>"


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
           with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and, if asked for, ids (little-endian uint32).

    A document longer than ``capacity`` is cut from its end, so only its first piece may be shorter.
    """
    def cut(text: pa.Array) -> pa.Array:
        count, piece, start, length, crc, raw = [0], [], [], [], [], []
        for _, _, ids, size in library_encoder(tokenizer).encode_column(text):
            stop = np.cumsum(size)
            flat = np.insert(ids.astype("<u4"), stop, end_id)
            data = memoryview(flat.tobytes())
            at = 0
            for n in (size + 1).tolist():
                short = n % capacity or capacity
                k = -(-n // capacity)
                count.append(count[-1] + k)
                for p in range(k):
                    begin = 0 if p == 0 else short + (p - 1) * capacity
                    size_p = short if p == 0 else capacity
                    bytes_p = data[4 * (at + begin):4 * (at + begin + size_p)]
                    piece.append(p)
                    start.append(begin)
                    length.append(size_p)
                    crc.append(zlib.crc32(bytes_p))
                    if with_ids:
                        raw.append(bytes(bytes_p))
                at += n
        fields = [pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
        names = ["piece", "start", "length", "ids_crc32"]
        if with_ids:
            fields, names = [*fields, pa.array(raw, pa.binary())], [*names, "ids"]
        return pa.ListArray.from_arrays(pa.array(count, pa.int32()), pa.StructArray.from_arrays(fields, names))

    udf = task_udf(cut, PIECE_IDS if with_ids else PIECE)
    return docs.select("doc_id", F.explode(udf(F.col("text"))).alias("p")).select("doc_id", "p.*")


def reduce_instance(count: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Martello-Toth reduction on ``count[length]`` (changed in place).

    Returns (lengths of a sequence, number of such sequences).  Fixed for a piece j with room r beside it:
    j alone if nothing fits; j with the largest piece j* that fits if that fills the room, or if no two
    pieces fit together, or if j* is at least the best pair that fits while no three pieces do; and j with
    that best pair (a, b) if a = j* and no two pieces longer than b fit.
    """
    fixed = []

    def take(parts: tuple[int, ...]) -> None:
        n = min(int(count[p]) // parts.count(p) for p in parts)
        for p in parts:
            count[p] -= n
        fixed.append((parts, n))

    def smallest(k: int, above: int = 0, without: int = 0) -> list[int]:
        out = []
        for p in (np.flatnonzero(count[above + 1:]) + above + 1).tolist():
            out += [p] * min(k - len(out), int(count[p]) - (p == without))
            if len(out) >= k:
                break
        return out

    changed = True
    while changed:
        changed = False
        for j in range(capacity, 0, -1):
            while count[j]:
                room = capacity - j
                count[j] -= 1
                fit = np.flatnonzero(count[1:room + 1]) + 1
                few = smallest(3)
                count[j] += 1
                if not len(fit):
                    parts = (j,)
                else:
                    best = int(fit[-1])
                    if best == room or len(few) < 2 or few[0] + few[1] > room:
                        parts = (j, best)
                    elif len(few) < 3 or sum(few) > room:
                        count[j] -= 1
                        pair = max(((int(a) + b, int(a), b) for a in fit for b in [_partner(count, int(a), room - int(a))] if b), default=None)
                        longer = smallest(2, above=min(pair[1:]) if pair else capacity)
                        count[j] += 1
                        if pair is None or best >= pair[0]:
                            parts = (j, best)
                        elif best == max(pair[1:]) and (len(longer) < 2 or sum(longer) > room):
                            parts = (j, max(pair[1:]), min(pair[1:]))
                        else:
                            break
                    else:
                        break
                if any(int(count[p]) < parts.count(p) for p in parts):
                    break
                take(parts)
                changed = True
    return fixed


def _partner(count: np.ndarray, a: int, room: int) -> int:
    """Longest piece that fits into ``room`` beside one piece of length a; 0 if there is none."""
    fit = np.flatnonzero(count[1:max(room, 0) + 1]) + 1
    for b in fit[::-1].tolist():
        if b != a or count[a] > 1:
            return b
    return 0


def best_fit(count: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing of ``count[length]``: (lengths of a sequence, number of such sequences)."""
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    for size in range(capacity, 0, -1):
        left = int(count[size])
        while left:
            room = next((r for r in range(size, capacity) if open_.get(r)), capacity)
            parts, n = open_[room].pop() if room < capacity else ((), left)
            each = room // size  # best fit stays with a sequence while the piece still fits
            whole = min(n, left // each)
            rest = 0
            if whole < n and left - whole * each:  # one more sequence takes what is left
                rest = min(each, left - whole * each)
            for bins, k in ((whole, each), (1 if rest else 0, rest)):
                if bins:
                    open_.setdefault(room - k * size, []).append((parts + (size,) * k, bins))
                    left -= bins * k
            if room < capacity and n - whole - (1 if rest else 0):
                open_[room].append((parts, n - whole - (1 if rest else 0)))
    return [g for groups in open_.values() for g in groups]


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted keys (length << 44 | first rank) with the sequence of that rank and the offset."""
    count = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        count[length] = n
    groups = reduce_instance(count, capacity) + best_fit(count, capacity)
    key, sequence, offset, base = [], [], [], 0
    used = np.zeros(capacity + 1, np.int64)
    for parts, n in groups:
        at = 0
        for p in parts:
            key.append((p << 44) | int(used[p]))
            sequence.append(base)
            offset.append(at)
            used[p] += n
            at += p
        base += n
    order = np.argsort(np.array(key, np.int64), kind="stable")
    return np.array(key, np.int64)[order], np.array(sequence, np.int64)[order], np.array(offset, np.int64)[order]


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to pieces (doc_id, piece, start, length, ids_crc32, ...)."""
    lengths = {r.length: r.n for r in parts.groupBy("length").agg(F.count("*").alias("n")).collect()}  # <= capacity rows
    key, sequence, offset = plan(lengths, capacity)

    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        want = (length.to_numpy(zero_copy_only=False).astype(np.int64) << 44) | (rank.to_numpy(zero_copy_only=False) - 1)
        at = np.searchsorted(key, want, "right") - 1
        return pa.StructArray.from_arrays([pa.array(sequence[at] + want - key[at]), pa.array(offset[at])], ["sequence_id", "offset"])

    blocks = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranked = blocked_row_number(parts, ["length"], ["doc_id", "piece", "ids_crc32"],
                                F.pmod(F.xxhash64("doc_id", "piece"), F.lit(blocks)), out="__rank")
    placed = ranked.withColumn("__place", task_udf(place, "struct<sequence_id:bigint,offset:bigint>")("length", "__rank"))
    return placed.select(*parts.columns, "__place.*")


def packed(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their places; the pieces are written once to the shared folder."""
    return pack(materialize(pieces(docs, tokenizer, capacity, end_id, with_ids), "pieces"), capacity)


def sequences(placed: DataFrame) -> DataFrame:
    """Token ids of every sequence (needs pieces with ids): sequence_id, n_tokens, ids (little-endian uint32).

    A group is one sequence, so at most ``capacity`` tokens.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("p")).select(
        "sequence_id", "n_tokens", F.aggregate("p", F.lit(b""), lambda acc, x: F.concat(acc, x["ids"])).alias("ids"))
