"""Quality rules with adaptive thresholds from mergeable quantile sketches per language and source.

1. ``annotate`` adds one struct column with the text features of every whole document.
2. ``sketch`` counts documents per (language, source, feature, bin).  A bin is an integer range of a
   feature with a bounded relative width, so the counts of any two parts of the corpus add up to the
   counts of their union: a quantile sketch that merges exactly, whatever the partitioning.
3. ``thresholds`` reads the quartiles of each group off its sketch and sets an upper fence
   ``q50 + reach * max(q75 - q25, slack)`` per feature.  A group of fewer than ``min_docs`` documents takes
   the merged sketch of its language, and that of all documents if the language is small too.
4. ``judge`` joins documents to their group's fences; a document beyond any fence is rejected.

Defined results: a null or empty text has no words and fails the base rule; null language or source is
a group of its own; an empty table gives an empty table; repeated rows are judged one by one.  Columns
of the input are kept as they are; the added ones are named by the caller.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .arrays import (Powers, segment_sums, span_hashes, task_udf, text_chunks, window_hashes, word_spans, mix)

FEATURES = "struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint," \
           "n_repeat_words:bigint,n_upper:bigint,n_letters:bigint,n_marks:bigint,n_single:bigint>"

SYMBOLS = b"#*$%&|<>"
MARKS = b"!?"

# feature -> smallest spread that counts as spread (same unit as the feature: per mille, or 1/100 characters)
SLACK = {"symbol_rate": 20, "upper_rate": 60, "mark_rate": 25, "dup_line_rate": 40,
         "repeat_rate": 45, "word_length": 120, "single_rate": 50}
REACH = 4
MIN_DOCS = 50


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(chars)] = True
    return out


def _chunk_features(data: np.ndarray, starts: np.ndarray, power: Powers) -> dict[str, np.ndarray]:
    begin, end, first = word_spans(data, starts)
    in_word = np.zeros(len(data) + 1, np.int8)
    in_word[begin] += 1
    in_word[end] -= 1
    in_word = np.cumsum(in_word[:-1]).astype(bool)
    letters_upper = (data >= 65) & (data <= 90)
    letters = letters_upper | ((data >= 97) & (data <= 122))
    n_docs = len(starts) - 1
    out = {
        "n_words": np.diff(first),
        "word_chars": segment_sums((in_word & ((data & 0xC0) != 0x80)).astype(np.int64), starts),
        "n_symbols": segment_sums(_table(SYMBOLS)[data].astype(np.int64), starts),
        "n_upper": segment_sums(letters_upper.astype(np.int64), starts),
        "n_letters": segment_sums(letters.astype(np.int64), starts),
        "n_marks": segment_sums(_table(MARKS)[data].astype(np.int64), starts),
        "n_single": segment_sums((end - begin == 1).astype(np.int64), first),
    }
    # lines that hold a word and equal an earlier line of the same document
    cut = np.flatnonzero(data == 10)
    line_begin = np.union1d(starts[:-1], cut + 1)
    line_begin = line_begin[line_begin < len(data)]
    line_end = np.append(line_begin[1:], len(data))[:len(line_begin)]
    line_end = line_end - (data[line_end - 1] == 10) if len(line_end) else line_end
    has_word = np.searchsorted(begin, line_end) > np.searchsorted(begin, line_begin)
    line_begin, line_end = line_begin[has_word], line_end[has_word]
    line_doc = np.searchsorted(starts, line_begin, "right") - 1
    line_hash = span_hashes(data, line_begin, line_end, power)
    order = np.lexsort((line_hash, line_doc))
    same = (line_hash[order][1:] == line_hash[order][:-1]) & (line_doc[order][1:] == line_doc[order][:-1])
    out["n_dup_lines"] = np.bincount(line_doc[order][1:][same], minlength=n_docs)
    # words inside 5-word windows that occur twice or more in the document
    words = span_hashes(data, begin, end, power)
    window, at, bounds = window_hashes(words, first, 5)
    key = mix(window + np.repeat(mix(np.arange(n_docs, dtype=np.uint64) + np.uint64(1)), np.diff(bounds)))
    order = np.argsort(key)
    ranked = key[order]
    twin = np.zeros(len(key), dtype=bool)
    pair = ranked[1:] == ranked[:-1]
    twin[1:] |= pair
    twin[:-1] |= pair
    hit = at[order[twin]]
    edge = np.bincount(hit, minlength=len(words) + 6) - np.bincount(hit + 5, minlength=len(words) + 6)
    covered = np.cumsum(edge)[:len(words)] > 0
    out["n_repeat_words"] = segment_sums(covered.astype(np.int64), first)
    return out


def text_features(column) -> pa.StructArray:
    """Features of every text of an Arrow string column."""
    power, names = Powers(), [f.split(":")[0] for f in FEATURES[7:-1].split(",")]
    parts = {n: [np.empty(0, np.int64)] for n in names}
    for _, _, data, starts in text_chunks(column):
        got = _chunk_features(data, starts, power)
        for n in names:
            parts[n].append(got[n].astype(np.int64))
    return pa.StructArray.from_arrays([pa.array(np.concatenate(parts[n])) for n in names], names)


def _features(text: pa.Array) -> pa.Array:
    return text_features(text)


def annotate(docs: DataFrame, text: str = "text", out: str = "__quality") -> DataFrame:
    """Add the struct of text features; not re-evaluated by later filters."""
    return docs.withColumn(out, task_udf(_features, FEATURES)(F.col(text)))


def rates(q: str) -> dict[str, Column]:
    """Integer features the fences apply to: per mille, or hundredths of a character."""
    per = lambda a, b, k=1000: F.expr(f"coalesce(({k} * {q}.{a}) div nullif({q}.{b}, 0), 0)")
    return {"symbol_rate": per("n_symbols", "word_chars"), "upper_rate": per("n_upper", "n_letters"),
            "mark_rate": per("n_marks", "n_words"), "dup_line_rate": per("n_dup_lines", "n_words"),
            "repeat_rate": per("n_repeat_words", "n_words"), "word_length": per("word_chars", "n_words", 100),
            "single_rate": per("n_single", "n_words")}


def base_failed(q: str, min_words: int = 10, max_repeat: int = 20) -> Column:
    return (F.col(f"{q}.n_words") < min_words) | (100 * F.col(f"{q}.n_repeat_words") > max_repeat * F.col(f"{q}.n_words"))


def bin_floor(value: Column) -> Column:
    """Lower end of the value's bin: exact below 64, then 32 bins per power of two (3 % wide)."""
    width = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.greatest(F.length(F.bin(value)) - 6, F.lit(0)))
    return (value - F.pmod(value, width)).cast("bigint")


def sketch(annotated: DataFrame, lang: str = "lang", source: str = "source", q: str = "__quality") -> DataFrame:
    """Counts per (lang, source, feature, bin) of the documents that pass the base rule."""
    pairs = F.array(*[F.struct(F.lit(n).alias("feature"), bin_floor(c).alias("bin")) for n, c in rates(q).items()])
    return (annotated.filter(~base_failed(q))
            .select(F.col(lang).alias("lang"), F.col(source).alias("source"), F.explode(pairs).alias("p"))
            .groupBy("lang", "source", "p.feature", "p.bin").agg(F.count("*").alias("n")))


def _quartiles(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Quartiles (lower ends of bins) per group and feature from merged bin counts."""
    by = [*keys, "feature"]
    merged = counts.groupBy(*by, "bin").agg(F.sum("n").alias("n"))
    w = Window.partitionBy(*by)
    ranked = merged.withColumn("upto", F.sum("n").over(w.orderBy("bin"))).withColumn("total", F.sum("n").over(w))
    at = lambda k: F.min(F.when(F.col("upto") * 4 >= F.col("total") * k, F.col("bin")))
    return ranked.groupBy(*by).agg(at(1).alias("q25"), at(2).alias("q50"), at(3).alias("q75"),
                                   F.max("total").alias("docs"))


def thresholds(counts: DataFrame, reach: int = REACH, min_docs: int = MIN_DOCS, slack: dict | None = None) -> DataFrame:
    """One row per (lang, source) with a struct ``fence`` of upper limits, one field per feature.

    Small groups take the sketch of their language, then that of all documents; merging sketches is
    adding their counts.  Work and size follow the number of groups, not of documents.
    """
    own, lang, everything = (_quartiles(counts, k) for k in (["lang", "source"], ["lang"], []))
    pick = lambda n: F.coalesce(F.when(F.col("o.docs") >= min_docs, F.col(f"o.{n}")),
                                F.when(F.col("l.docs") >= min_docs, F.col(f"l.{n}")), F.col(f"e.{n}"))
    spread = F.create_map(*[F.lit(x) for kv in (slack or SLACK).items() for x in kv])
    rows = (own.alias("o").join(lang.alias("l"), F.col("o.lang").eqNullSafe(F.col("l.lang"))
                                & (F.col("o.feature") == F.col("l.feature")))
            .join(F.broadcast(everything).alias("e"), F.col("o.feature") == F.col("e.feature"))  # one row per feature
            .select("o.lang", "o.source", "o.feature", pick("q25").alias("q25"), pick("q50").alias("q50"),
                    pick("q75").alias("q75")))
    fence = F.col("q50") + reach * F.greatest(F.col("q75") - F.col("q25"), spread[F.col("feature")])
    return rows.groupBy("lang", "source").agg(F.struct(*[
        F.max(F.when(F.col("feature") == n, fence)).alias(n) for n in (slack or SLACK)]).alias("fence"))


def judge(annotated: DataFrame, limits: DataFrame, lang: str = "lang", source: str = "source",
          q: str = "__quality", failed: str = "base_failed", kept: str = "kept") -> DataFrame:
    """Add ``failed`` (base rule) and ``kept`` (base rule and all fences of the document's group)."""
    lim = limits.select(F.col("lang").alias("__lang"), F.col("source").alias("__source"), F.col("fence").alias("__fence"))
    joined = annotated.join(lim, F.col(lang).eqNullSafe(F.col("__lang")) & F.col(source).eqNullSafe(F.col("__source")), "left")
    inside = F.lit(True)
    for n, c in rates(q).items():
        inside = inside & F.coalesce(c <= F.col(f"__fence.{n}"), F.lit(True))
    return joined.withColumn(failed, base_failed(q)).withColumn(kept, ~F.col(failed) & inside).drop(
        "__lang", "__source", "__fence")
