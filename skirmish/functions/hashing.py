"""Player ids from player names.

``name_id`` offers three id schemes:

* ``xxhash64`` - Spark's built-in 64-bit hash (JVM side, codegen); default
  when ids must come from names, as 32-bit ids collide at scale.
* ``murmur3`` - parity with the reference's ids: the 32-bit MurmurHash3
  string hash of the Scala standard library (UTF-16 code units mixed in pairs,
  finalised with the length), widened to BIGINT.  Spark's own ``hash()`` is a
  different function (UTF-8 bytes, seed 42), so this one is put together from
  built-in expressions: the name's UTF-16 code units are folded pair by pair
  with ``aggregate``, 32-bit products come from 16-bit halves and never
  overflow a BIGINT.  No Python runs.

``murmur3_string_hash`` is the same hash over a pandas series.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the Scala MurmurHash3 string hash (public standard library).
STRING_SEED = 0xF7CA7FD2
C1 = 0xCC9E2D51
C2 = 0x1B873593
MIX_ADD = 0xE6546B64
FMIX1 = 0x85EBCA6B
FMIX2 = 0xC2B2AE35
M32 = np.uint64(0xFFFFFFFF)


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return ((x << np.uint64(r)) | (x >> np.uint64(32 - r))) & M32


def _mix_last(h: np.ndarray, k: np.ndarray) -> np.ndarray:
    k = (k * np.uint64(C1)) & M32
    k = _rotl(k, 15)
    k = (k * np.uint64(C2)) & M32
    return h ^ k


def _mix(h: np.ndarray, k: np.ndarray) -> np.ndarray:
    h = _rotl(_mix_last(h, k), 13)
    return (h * np.uint64(5) + np.uint64(MIX_ADD)) & M32


def _finalize(h: np.ndarray, length: np.ndarray) -> np.ndarray:
    h = h ^ length
    h ^= h >> np.uint64(16)
    h = (h * np.uint64(FMIX1)) & M32
    h ^= h >> np.uint64(13)
    h = (h * np.uint64(FMIX2)) & M32
    h ^= h >> np.uint64(16)
    return h


def murmur3_string_hash(values: pd.Series) -> pd.Series:
    """Vectorised Scala ``MurmurHash3.stringHash``; null in, null out."""
    mask = values.isna().to_numpy()
    strs = values.fillna("").astype(str)
    n = len(strs)
    if n == 0:
        return pd.Series([], dtype="Int64")
    # One UTF-16 buffer for the whole batch; per-string lengths in code units
    # (astral characters take two).
    lens = (strs.str.len() + strs.str.count("[\U00010000-\U0010FFFF]")).to_numpy(np.int64)
    codes = np.frombuffer("".join(strs.tolist()).encode("utf-16-le"), dtype="<u2").astype(np.uint64)
    starts = np.concatenate(([0], np.cumsum(lens)[:-1])).astype(np.int64)
    h = np.full(n, STRING_SEED, dtype=np.uint64)
    pairs = lens // 2
    for j in range(int(pairs.max(initial=0))):
        act = pairs > j
        at = starts[act] + 2 * j
        h[act] = _mix(h[act], ((codes[at] << np.uint64(16)) + codes[at + 1]) & M32)
    odd = (lens % 2) == 1
    if odd.any():
        h[odd] = _mix_last(h[odd], codes[starts[odd] + lens[odd] - 1])
    h = _finalize(h, lens.astype(np.uint64))
    out = pd.Series(h.astype(np.uint32).view(np.int32).astype(np.int64), index=values.index, dtype="Int64")
    out[mask] = pd.NA
    return out


MASK = 0xFFFFFFFF


def _low(x: Column) -> Column:
    """Lowest 32 bits of a BIGINT."""
    return x.bitwiseAND(F.lit(MASK).cast("bigint"))


def _let(x: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.get(F.transform(F.array(x), body), F.lit(0))


def _times(x: Column, factor: int) -> Column:
    """x * factor modulo 2 ** 32, for 0 <= x < 2 ** 32."""
    by, half = F.lit(factor).cast("bigint"), F.lit(0xFFFF).cast("bigint")
    return _let(x, lambda v: _low(F.shiftleft((F.shiftright(v, 16) * by).bitwiseAND(half), 16) + v.bitwiseAND(half) * by))


def _turned(x: Column, bits: int) -> Column:
    return _let(x, lambda v: _low(F.shiftleft(v, bits)).bitwiseOR(F.shiftright(v, 32 - bits)))


def _folded(x: Column, bits: int) -> Column:
    return _let(x, lambda v: v.bitwiseXOR(F.shiftright(v, bits)))


def _mixed(h: Column, unit: Column) -> Column:
    return h.bitwiseXOR(_times(_turned(_times(unit, C1), 15), C2))


def murmur3_name_id(name: Column) -> Column:
    """The 32-bit string hash of a name as a BIGINT; null in, null out."""
    units = F.hex(F.encode(name, "UTF-16BE"))  # four digits per code unit
    number = lambda digits: F.conv(digits, 16, 10).cast("bigint")
    pairs = F.regexp_extract_all(units, F.lit("[0-9A-F]{8}"), F.lit(0))
    h = F.aggregate(pairs, F.lit(STRING_SEED).cast("bigint"),
                    lambda h, pair: _low(_times(_turned(_mixed(h, number(pair)), 13), 5) + F.lit(MIX_ADD).cast("bigint")))
    last = F.when(F.length(units) % 8 == 4, number(F.right(units, F.lit(4)))).otherwise(F.lit(0).cast("bigint"))
    h = _mixed(h, last)  # no odd unit: a zero leaves the hash as it is
    h = h.bitwiseXOR((F.length(units) / 4).cast("bigint"))
    h = _folded(_times(_folded(_times(_folded(h, 16), FMIX1), 13), FMIX2), 16)
    return _let(h, lambda v: F.when(v >= 1 << 31, v - F.lit(1 << 32)).otherwise(v))


def name_id(name: Column | str, mode: str = "xxhash64") -> Column:
    """BIGINT player id derived from a name."""
    col = F.col(name) if isinstance(name, str) else name
    if mode == "xxhash64":
        return F.xxhash64(col)
    if mode == "murmur3":
        return murmur3_name_id(col)
    raise ValueError(f"unknown id mode {mode!r}")
