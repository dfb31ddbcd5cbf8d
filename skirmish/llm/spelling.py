"""Spelling variant grouping with a variable-length gram index.

A word is a maximal run of letters (``[A-Za-z\\u00C0-\\u00FF]+``, A-Z lower-cased).  Two words are near if
one inserted, deleted or replaced code point turns one into the other.

1. ``word_counts`` counts words over all texts: inside a task per Arrow batch, then by a partial aggregation.
2. ``gram_dictionary`` counts, over the distinct words (``^word$``), the grams of ``QMIN`` to ``QMAX`` code points
   and keeps the frequent ones.  They are the inner nodes of a gram tree: a frequent gram is too common to be
   a useful list, so it is replaced by its one-character extensions; a gram that is not frequent is a leaf.  The
   threshold grows with the vocabulary so that at most ``DICTIONARY`` nodes are kept, which bounds what the tasks get.
3. ``decompose`` gives a word one gram per position: the path from that position to a leaf of the tree.
   ``affected`` is the most grams that one edit can touch: the largest number of grams over one position.  All
   other grams stand unchanged in the near word, at the same place from the start or from the end.
4. Lists are merged under that bound.  With its grams in one global order (rare first), the least gram that an edit leaves
   alone is among the first ``affected + 1`` of either word, so only these are entered in the index and only
   these lists are read: never the long lists of common grams.  List keys hold the place and the word's length, and a
   word looks up its own length and the next one, so each near pair is met from one side.
5. Candidates are verified by edit distance.  No list, partner or candidate is capped, and no word is left out: a word of
   six letters has seven grams, of which one edit touches at most ``QMAX`` = 6.

Forms point from a word to a much more frequent near word; ``root`` follows them by pointer doubling (counts grow
by ``RATIO`` at every step, so the number of rounds follows from the largest count).

Defined results: null and empty texts have no words; a null doc_id takes part as the empty text in the
hash of the contract's thinning; repeated rows count each; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .arrays import LOWER_ASCII, ragged, text_chunks

QMIN, QMAX = 2, 6
LEAST_LIST = 32        # grams of fewer words are never worth extending
DICTIONARY = 1 << 18   # inner nodes kept at most
LETTERS, OCCURRENCES = 6, 5
RATIO = 5
THINNING = 199
START, END = "\x02", "\x03"  # not letters, so they occur in no word

IS_LETTER = np.zeros(256, dtype=bool)
IS_LETTER[[*range(65, 91), *range(97, 123)]] = True
LEAD = 0xC3  # U+00C0 to U+00FF are C3 80 to C3 BF


def letter_runs(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end, document) of the maximal letter runs of UTF-8 ``data`` cut at ``starts``."""
    if len(data) == 0:
        none = np.empty(0, np.int64)
        return none, none, none
    inside = IS_LETTER[data] | (data == LEAD)
    inside[1:] |= data[:-1] == LEAD
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    edge = starts[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    begin[edge] = inside[edge]
    end[edge - 1] = inside[edge - 1]
    begin, end = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return begin, end, np.searchsorted(starts, begin, "right") - 1


def crc_table() -> np.ndarray:
    """CRC-32 of single bytes, the step table of the usual byte-wise form."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> np.uint32(1)) ^ np.uint32(0xEDB88320), t >> np.uint32(1))
    return t


def run_crcs(data: np.ndarray, begin: np.ndarray, end: np.ndarray, before: np.ndarray, long: int = 64) -> np.ndarray:
    """CRC-32 of every run continuing ``before`` (a CRC per run), a byte of all runs at a time."""
    table, size = crc_table(), end - begin
    state = before.astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    order = np.argsort(-np.minimum(size, long), kind="stable")
    ranked = np.minimum(size, long)[order]
    for k in range(int(ranked[0]) if len(ranked) else 0):
        live = order[:np.searchsorted(-ranked, -k, "left")]  # runs of more than k bytes
        state[live] = (state[live] >> np.uint32(8)) ^ table[(state[live] ^ data[begin[live] + k]) & np.uint32(0xFF)]
    state ^= np.uint32(0xFFFFFFFF)
    for k in np.flatnonzero(size > long).tolist():
        state[k] = zlib.crc32(data[begin[k] + long:end[k]].tobytes(), int(state[k]))
    return state


def spelled(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Array:
    """The byte spans as an Arrow string array."""
    size = end - begin
    offsets = np.append(0, np.cumsum(size)).astype(np.int64)
    flat = data[ragged(begin, size)]
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(offsets.tobytes()), pa.py_buffer(flat.tobytes()))


def chunk_words(data: np.ndarray, starts: np.ndarray, ids: list, letters: int, thinning: int) -> pa.Array:
    """The words of a chunk of documents, as often as they occur; thinned runs lose one code point."""
    data = LOWER_ASCII[data]
    begin, end, doc = letter_runs(data, starts)
    lead = np.append(0, np.cumsum((data & 0xC0) != 0x80))
    keep = lead[end] - lead[begin] >= letters  # a shorter run does not get longer
    begin, end, doc = begin[keep], end[keep], doc[keep]
    if not thinning:
        return spelled(data, begin, end)
    prefix = np.array([zlib.crc32((b"" if i is None else b"%d" % i) + b":") for i in ids], np.uint32)
    crc = run_crcs(data, begin, end, prefix[doc])
    thin = crc % np.uint32(thinning) == 0
    changed = []
    for b, e, h in zip(begin[thin].tolist(), end[thin].tolist(), crc[thin].tolist()):
        run = data[b:e].tobytes().decode()
        at = h % len(run)
        changed.append(run[:at] + run[at + 1:])
    changed = [w for w in changed if len(w) >= letters]
    return pa.concat_arrays([spelled(data, begin[~thin], end[~thin]), pa.array(changed, pa.large_string())])


def _counted(words: list[pa.Array], names: tuple[str, str]) -> pa.RecordBatch:
    found = pc.value_counts(pa.chunked_array(words, pa.large_string()))
    return pa.RecordBatch.from_arrays([found.field(0).cast(pa.string()), found.field(1)], names=names)


def word_counts(docs: DataFrame, letters: int = LETTERS, thinning: int = THINNING) -> DataFrame:
    """(word, n) over all texts of ``docs`` (columns doc_id and text), words of ``letters`` code points or more.

    ``thinning`` deletes the code point h % length of every run with h divisible by it, h being the CRC-32 of
    ``<doc_id>:<run>`` (0: none).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            words = [chunk_words(data, starts, ids[i:j], letters, thinning) for i, j, data, starts in text_chunks(batch.column(1))]
            yield _counted(words, ("word", "n"))

    seen = docs.select("doc_id", "text").mapInArrow(run, "word string, n bigint")
    return seen.groupBy("word").agg(F.sum("n").alias("n"))


def gram_dictionary(words: DataFrame, size: int = DICTIONARY, least: int = LEAST_LIST) -> dict[str, int]:
    """Frequent grams of the distinct words and the number of their occurrences; at most ``size`` of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            padded = [START + w + END for w in batch.column(0).to_pylist()]
            for q in range(QMIN, QMAX + 1):
                yield _counted([pa.array([s[p:p + q] for s in padded for p in range(len(s) - q + 1)], pa.large_string())], ("gram", "n"))

    letters = words.agg(F.sum(F.length("word") + 2)).first()[0] or 0
    # every length has at most ``letters`` gram occurrences, so fewer than letters / threshold grams reach it
    threshold = max(least, -(-letters * (QMAX - QMIN + 1) // size))
    grams = words.select("word").mapInArrow(run, "gram string, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
    return {r.gram: r.n for r in grams.filter(F.col("n") >= threshold).toLocalIterator()}


def decompose(word: str, tree: dict[str, int]) -> list[str]:
    """One gram per position of ``^word$``: the path from there to the first gram that is not in ``tree``."""
    s, out = START + word + END, []
    for p in range(len(s) - 1):
        q = p + QMIN
        while q < len(s) and q - p < QMAX and s[p:q] in tree:
            q += 1
        out.append(s[p:q])
    return out


def affected(grams: list[str]) -> int:
    """The most grams that one edit of the word can touch: the largest number of grams over one letter."""
    cover = [0] * (len(grams) + 2)
    for p, g in enumerate(grams):
        cover[p] += 1
        cover[p + len(g)] -= 1
    most = depth = 0
    for p in range(len(grams)):
        depth += cover[p]
        if p:  # the start mark is not edited
            most = max(most, depth)
    return most


def entries(word: str, tree: dict[str, int]) -> list[tuple[str, int]]:
    """(gram, position) of the first ``affected + 1`` grams, rare ones first: what the index holds of a word."""
    grams = decompose(word, tree)
    ranked = sorted((tree.get(g, 0), g, p) for p, g in enumerate(grams))
    return [(g, p) for _, g, p in ranked[:affected(grams) + 1]]


def near_pairs(words: DataFrame, tree: dict[str, int]) -> DataFrame:
    """(a, na, b, nb): all pairs of near words of the table (word, n), each once; ``b`` is not the shorter one."""
    shared = words.sparkSession.sparkContext.broadcast(tree)  # at most DICTIONARY grams

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = shared.value
            grams, places, rows = [], [], []
            for k, w in enumerate(batch.column(0).to_pylist()):
                for g, p in entries(w, known):
                    grams.append(g)
                    places.append(p)
                    rows.append(k)
            yield pa.RecordBatch.from_arrays([pa.array(grams, pa.string()), pa.array(places, pa.int32()),
                                              *[batch.column(c).take(pa.array(rows, pa.int64())) for c in (0, 1)]],
                                             names=["gram", "place", "word", "n"])

    index = materialize(words.select("word", "n").mapInArrow(run, "gram string, place int, word string, n bigint")
                        .withColumn("size", F.length("word")), "gram-index")
    b = index.select("gram", "place", "size", F.col("word").alias("b"), F.col("n").alias("nb"))
    # an edit leaves a gram at its place if the gram stands before it; behind an inserted letter it moves by one
    look = F.array(*[F.struct((F.col("size") + i).alias("size"), (F.col("place") + j).alias("place")) for i, j in ((0, 0), (1, 0), (1, 1))])
    a = (index.select("gram", F.explode(look).alias("at"), F.col("word").alias("a"), F.col("n").alias("na"), F.col("size").alias("own"))
         .select("gram", F.col("at.size").alias("size"), F.col("at.place").alias("place"), "a", "na", "own"))
    once = (F.col("own") < F.col("size")) | (F.col("a") < F.col("b"))
    met = a.join(b, ["gram", "size", "place"]).filter(once & (F.levenshtein("a", "b", 1) == 1))
    return met.select("a", "na", "b", "nb").distinct()


def roots(forms: DataFrame, largest: int, ratio: int = RATIO) -> DataFrame:
    """(word, root) for the rows (word, form): forms followed to the last, by pointer doubling."""
    at = forms.select("word", F.col("form").alias("root"))
    hops = max(1, math.ceil(math.log(max(largest, 2), ratio)))
    for _ in range(max(1, math.ceil(math.log2(hops)))):
        step = at.select(F.col("word").alias("__at"), F.col("root").alias("__next"))
        at = materialize(at.join(step, at.root == step["__at"], "left").select("word", F.coalesce("__next", "root").alias("root")), "spelling-roots")
    return at


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n for every row of a table (word, n) of distinct words.

    ``form`` is the near word of largest n (ties: the smallest) if that is at least ``ratio`` times the word's own.
    """
    pairs = near_pairs(words, gram_dictionary(words))
    either = F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("na").alias("n"), F.col("b").alias("o"), F.col("nb").alias("m")),
                               F.struct(F.col("b").alias("word"), F.col("nb").alias("n"), F.col("a").alias("o"), F.col("na").alias("m"))))
    none = words.select("word", "n", F.lit(None).cast("string").alias("o"), F.lit(None).cast("bigint").alias("m"))
    both = pairs.select(either.alias("e")).select("e.*").unionByName(none)
    best = F.min(F.when(F.col("o").isNotNull(), F.struct((-F.col("m")).alias("m"), "o")))
    known = both.groupBy("word", "n").agg(F.count("o").alias("n_near"), best.alias("best"))
    much = -F.col("best.m") >= ratio * F.col("n")
    known = materialize(known.select("word", "n", "n_near", F.when(much, F.col("best.o")).alias("form"),
                                     F.when(much, -F.col("best.m")).alias("form_n")), "spelling-forms")
    largest = known.agg(F.max("n")).first()[0] or 1
    last = roots(known.filter("form is not null"), largest, ratio)
    return known.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def grouped(docs: DataFrame, letters: int = LETTERS, occurrences: int = OCCURRENCES, thinning: int = THINNING) -> DataFrame:
    """Variants of the words of ``docs`` with at least ``letters`` code points and ``occurrences`` occurrences."""
    words = materialize(word_counts(docs, letters, thinning).filter(F.col("n") >= occurrences), "spelling-words")
    return variants(words)
