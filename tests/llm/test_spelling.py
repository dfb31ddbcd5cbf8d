"""Spelling variants: words, thinning, the bound of affected grams, near pairs, forms and roots against plain Python."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from skirmish.llm import spelling
from skirmish.llm.arrays import text_chunks
from tests.llm.util import awkward, empty

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(doc_id, text, thinning=199):
    for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
        run = run.translate(LOWER)
        h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
        if thinning and h % thinning == 0:
            run = run[:h % len(run)] + run[h % len(run) + 1:]
        if len(run) >= 6:
            yield run


def edits(word, letters):
    for i in range(len(word) + 1):
        for c in letters:
            yield word[:i] + c + word[i:]
            if i < len(word):
                yield word[:i] + c + word[i + 1:]
        if i < len(word):
            yield word[:i] + word[i + 1:]


def plain_variants(counts, ratio=5):
    letters = {c for w in counts for c in w}
    near = {w: {x for x in edits(w, letters) if x in counts and x != w} for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {(w, form[w], root(w), n, len(near[w]), counts[form[w]] if form[w] else None) for w, n in counts.items()}


def test_words_and_thinning_equal_plain_python():
    r = random.Random(4)
    parts = ["Straße", "ÀÉÎÕÜ", "word", "A", "×÷", "longer", "ÿéà", "x" * 90, "naïveté", "ŒUVRE", "字", "ab" * 40]
    texts = ["".join(r.choice(parts) + r.choice(["", " ", "-", "1", "\n", "字"]) for _ in range(r.randint(0, 50))) for _ in range(200)]
    texts += ["", "Ã", "a", "abcdef", "ÉÉÉÉÉÉ", "À" * 200]
    ids = [None if i % 11 == 0 else i * 7 - 300 for i in range(len(texts))]
    for thinning in (0, 2, 199):
        want = Counter(w for i, t in zip(ids, texts) for w in plain_words(i, t, thinning))
        got = Counter()
        for i, j, data, starts in text_chunks(pa.array(texts), chunk_bytes=300):
            got.update(spelling.chunk_words(data, starts, ids[i:j], 6, thinning).to_pylist())
        assert got == want


@settings(max_examples=150, deadline=None)
@given(st.text("abé", min_size=6, max_size=14), st.sets(st.text("abé\x02\x03", min_size=2, max_size=6), max_size=40))
def test_grams_that_an_edit_leaves_alone_are_found_in_both_indexes(word, frequent):
    tree = {g: 40 + len(g) for g in frequent}
    mine = spelling.entries(word, tree)
    assert len(spelling.decompose(word, tree)) > spelling.affected(spelling.decompose(word, tree))
    for other in set(edits(word, "abé")) - {word}:
        theirs = set(spelling.entries(other, tree))
        shift = len(other) - len(word)
        # the same gram at the same place, from the start or from the end
        assert any((g, p) in theirs or (g, p + shift) in theirs for g, p in mine)


def words_table(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n bigint")


@pytest.mark.parametrize("letters, size", [("ab", 400), ("abcdé", 900), ("azÿ", 300)])
def test_variants_equal_brute_force(spark, letters, size):
    r = random.Random(size)
    counts = {}
    while len(counts) < min(size, 380 if len(letters) == 2 else size):
        counts["".join(r.choice(letters) for _ in range(r.randint(6, 9)))] = r.choice([5, 6, 7, 30, 31, 160, 5 ** 6, 5 ** 9])
    got = {tuple(x) for x in spelling.variants(words_table(spark, counts)).collect()}
    assert got == plain_variants(counts)


def test_a_list_that_most_words_share(spark):
    """Every word has the same beginning and end, so the common grams are extended until they tell words apart."""
    r = random.Random(9)
    counts = {"inter" + "".join(r.choice("abcdefgh") for _ in range(4)) + "ations": r.randint(5, 400) for _ in range(1500)}
    words = words_table(spark, counts)
    tree = spelling.gram_dictionary(words)
    assert "inter" in tree and "ations" in tree
    assert {tuple(x) for x in spelling.variants(words).collect()} == plain_variants(counts)


def test_dictionary_is_bounded_and_any_dictionary_gives_the_same_pairs(spark):
    r = random.Random(3)
    counts = {"".join(r.choice("abcd") for _ in range(7)): 5 for _ in range(1500)}
    words = words_table(spark, counts)
    small = spelling.gram_dictionary(words, size=300, least=2)
    assert 0 < len(small) <= 300
    pairs = [{tuple(x) for x in spelling.near_pairs(words, t).collect()} for t in ({}, small, spelling.gram_dictionary(words, least=1))]
    assert pairs[0] == pairs[1] == pairs[2] and pairs[0]


def test_a_chain_of_forms_ends_in_its_root(spark):
    chain = ["aaaaaa", "aaaaab", "aaaabb", "aaabbb", "aabbbb", "abbbbb", "bbbbbb"]
    counts = {w: 5 ** (i + 1) for i, w in enumerate(chain)} | {"zzzzzz": 9}
    got = {r.word: (r.form, r.root) for r in spelling.variants(words_table(spark, counts)).collect()}
    assert got == {w: (chain[i + 1] if i < 6 else None, "bbbbbb") for i, w in enumerate(chain)} | {"zzzzzz": (None, "zzzzzz")}


def test_awkward_and_empty_documents(spark):
    docs = awkward(spark)
    want = Counter(w for r in docs.collect() for w in plain_words(r.doc_id, r.text))
    got = {tuple(r) for r in spelling.grouped(docs, occurrences=1).collect()}
    assert got == plain_variants(dict(want))
    assert spelling.grouped(empty(spark)).count() == 0
