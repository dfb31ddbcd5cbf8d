"""BPE encoding and decoding by prefix-sharing trie traversal.

The last token of a prefix decides how the prefix is encoded: its encoding is that of the prefix without
the token, and the token.  A token t may stand last only if it follows the last token s of what is before
it without a merge across the joint, i.e. if BPE leaves the bytes of s and t as exactly [s, t]; one
token fulfils this for every prefix.  So the distinct words of a batch are sorted, which is the order of a
depth-first walk through their trie; the walk keeps the last token of every prefix on the path from
the root, and a prefix that several words share is computed once.

Defined results: a null or empty text has no ids and decodes to the empty text; ids unknown to the
vocabulary decode to nothing; rows that repeat are encoded one by one.
"""

from __future__ import annotations

import hashlib
import json
import sys
import types

import numpy as np
import pyarrow as pa
from pyspark.sql import Column

from .arrays import ragged, task_udf
from .tokens import SPECIAL, Encoder


def byte_characters() -> dict[str, int]:
    """Character of the vocabulary file -> byte: printable Latin-1 stands for itself, the rest from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


class Merges:
    """Vocabulary and merge ranks of a byte-level BPE file, with the pair test of the trie walk."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        byte = byte_characters()
        spell = lambda s: bytes(byte[c] for c in s)
        vocab = {t: i for t, i in model["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        self.token = {spell(t): i for t, i in vocab.items() if t not in self.special}
        self.size = max([*vocab.values(), *self.special.values()]) + 1
        self.spelled = [b""] * self.size
        for t, i in self.token.items():
            self.spelled[i] = t
        for t, i in self.special.items():
            self.spelled[i] = t.encode()
        self.rank, self.parts = {}, {}
        for r, pair in enumerate(model["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            x, y = vocab[a], vocab[b]
            self.rank[x << 20 | y] = r
            self.parts.setdefault(vocab[a + b], (x, y, r))
        self.longest = max(map(len, self.token))
        self.pairs: dict[int, bool] = {}

    def spine(self, t: int, side: int) -> list[tuple[int, int]]:
        """Tokens at the left (0) or right (1) edge of t while it grows, with the rank of the merge that ends each."""
        out, end = [], 1 << 40
        while t in self.parts:
            out.append((t, end))
            end = self.parts[t][2]
            t = self.parts[t][side]
        out.append((t, end))
        return out[::-1]

    def stay_apart(self, s: int, t: int) -> bool:
        """Whether BPE encodes the bytes of s followed by those of t as [s, t]."""
        key = s << 20 | t
        known = self.pairs.get(key)
        if known is None:
            left, right = self.spine(s, 1), self.spine(t, 0)
            i = j = 0
            while True:
                (a, a_end), (b, b_end) = left[i], right[j]
                cross = self.rank.get(a << 20 | b, 1 << 40)
                if cross < a_end and cross <= b_end and cross < 1 << 40:
                    known = False
                    break
                if a_end == b_end == 1 << 40:
                    known = True
                    break
                if a_end <= b_end:
                    i += 1
                if b_end <= a_end:
                    j += 1
            if len(self.pairs) > 1 << 20:
                self.pairs.clear()
            self.pairs[key] = known
        return known

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words, in their order: (ids of all words, ids per word)."""
        spelled = [w.encode() for w in words]
        order = sorted(range(len(words)), key=spelled.__getitem__)
        found: list = [None] * len(words)
        token, longest, pairs, apart = self.token, self.longest, self.pairs, self.stay_apart
        last = [-1] * (max(map(len, spelled), default=0) + 1)  # last token of each prefix on the path
        before = b""
        for k in order:
            word = spelled[k]
            n, depth = len(word), 0
            limit = min(n, len(before))
            if word[:limit] == before[:limit]:
                depth = limit
            else:  # length of the prefix shared with the word before: those states are on the path already
                lo, hi = 0, limit
                while lo < hi:
                    mid = (lo + hi + 1) // 2
                    if word[:mid] == before[:mid]:
                        lo = mid
                    else:
                        hi = mid - 1
                depth = lo
            for end in range(depth + 1, n + 1):
                for begin in range(max(0, end - longest), end):
                    t = token.get(word[begin:end])
                    if t is None:
                        continue
                    if begin == 0:
                        break
                    s = last[begin]
                    known = pairs.get(s << 20 | t)
                    if known or known is None and apart(s, t):
                        break
                last[end] = t
            out, end = [], n
            while end:
                t = last[end]
                out.append(t)
                end -= len(self.spelled[t])
            found[k] = out[::-1]
            before = word
        size = np.array([len(f) for f in found], np.int64)
        return np.array([t for f in found for t in f], np.uint16), size

    def decoder(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        size = np.array([len(t) for t in self.spelled], np.int64)
        return np.frombuffer(b"".join(self.spelled), np.uint8), np.cumsum(size) - size, size


def merges_of(path: str) -> tuple[Merges, Encoder]:
    """Merges and encoder of a worker for a vocabulary file, kept between the worker's tasks."""
    cache = sys.modules.setdefault("skirmish_llm_worker_cache", types.ModuleType("skirmish_llm_worker_cache"))
    known = cache.__dict__.setdefault("merges", {})
    if path not in known:
        merges = Merges(path)
        if merges.size > 1 << 16 or set(merges.special) - {SPECIAL}:
            raise ValueError("expects ids below 65536 and no special token but " + SPECIAL)
        known[path] = merges, Encoder(merges.encode_words, merges.special.get(SPECIAL, 0))
    return known[path]


def encode(text: Column, vocabulary: str) -> Column:
    """array<int> of token ids of every whole text."""
    def run(column: pa.Array) -> pa.Array:
        ids, sizes = [np.empty(0, np.int32)], [np.zeros(1, np.int64)]
        for _, _, flat, size in merges_of(vocabulary)[1].encode_column(column):
            ids.append(flat.astype(np.int32))
            sizes.append(size)
        return pa.ListArray.from_arrays(pa.array(np.cumsum(np.concatenate(sizes)), pa.int32()), pa.array(np.concatenate(ids)))

    return task_udf(run, "array<int>")(text)


def spelled(ids: np.ndarray, sizes: np.ndarray, table: tuple[np.ndarray, np.ndarray, np.ndarray]) -> list[str]:
    """Text of each document's ids; bytes that are no UTF-8 become U+FFFD."""
    data, begin, size = table
    ids = ids[ids < len(size)] if len(ids) and int(ids.max()) >= len(size) else ids
    raw = data[ragged(begin[ids], size[ids])].tobytes()
    ends = np.append(0, np.cumsum(size[ids]))[np.append(0, np.cumsum(sizes))].tolist()
    return [raw[a:b].decode("utf-8", "replace") for a, b in zip(ends, ends[1:])]


def decode(ids: Column, vocabulary: str) -> Column:
    """Text of every array<int> of token ids."""
    def run(column: pa.Array) -> pa.Array:
        table, out = merges_of(vocabulary)[0].decoder(), []
        for row in column.to_pylist():
            known = np.array([i for i in row or [] if i is not None and 0 <= i < len(table[2])], np.int64)
            out += spelled(known, np.array([len(known)]), table)
        return pa.array(out, pa.string())

    return task_udf(run, "string")(ids)


def round_trip(text: Column, vocabulary: str) -> Column:
    """Struct of n_tokens, SHA-256 of the ids (little-endian uint32) and SHA-256 of the decoded text."""
    def run(column: pa.Array) -> pa.Array:
        merges, encoder = merges_of(vocabulary)
        table, count, ids_sha, text_sha = merges.decoder(), [], [], []
        for _, _, ids, size in encoder.encode_column(column):
            raw, ends = memoryview(ids.astype("<u4").tobytes()), np.append(0, 4 * np.cumsum(size)).tolist()
            ids_sha += [hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(ends, ends[1:])]
            text_sha += [hashlib.sha256(t.encode()).hexdigest() for t in spelled(ids, size, table)]
            count += size.tolist()
        return pa.StructArray.from_arrays([pa.array(count, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                                          ["n_tokens", "ids_sha256", "decoded_sha256"])

    return task_udf(run, "struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string>")(text)


