"""Vectorised tokenisation, BPE by trie, token files and packing against the tokenizers library."""

from __future__ import annotations

import collections
import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from skirmish.llm import bpe, packing, queries, token_files, tokens
from skirmish.session import scratch_path
from tests.conftest import SF_SMALL
from tests.llm.util import awkward, empty

PATH = queries.vocabulary()
LIBRARY = Tokenizer.from_file(PATH)
PIECES = ["'s", "'", "s", "t", " ", "  ", "\n", "\t", "a", "re", "'re", "ll", "'ll", "''", "é", "1", "23", "!", "<|endoftext|>", "<|",
          " ", "　", "漢", "😀", "‍", "़", "'d", "ve", "\r\n", "|>", "½", "Ⅷ", "_", "\x1c", "\x85", "aaaa", "ing", "ation", "----"]


def le(ids) -> bytes:
    return np.array(ids, "<u4").tobytes()


def ids_of(text) -> list[int]:
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def fuzz(n=6000, seed=3) -> list:
    r = random.Random(seed)
    return ["".join(r.choice(PIECES) for _ in range(r.randint(0, 25))) for _ in range(n)] + [
        "", None, "don't", " " * 50, "\n\n \n x", "a" * 3000, "x" * 300_000, "ab " * 100_000]


@pytest.mark.parametrize("encoder", [lambda: tokens.library_encoder(PATH), lambda: bpe.merges_of(PATH)[1]])
def test_encoders_equal_the_library(encoder):
    texts, got = fuzz(), []
    for _, _, ids, size in encoder().encode_column(pa.array(texts)):
        got += [x.tolist() for x in np.split(ids, np.cumsum(size)[:-1])]
    assert got == [ids_of(t) for t in texts]


def test_a_full_word_table_starts_afresh():
    merges = bpe.Merges(PATH)
    encoder = tokens.Encoder(merges.encode_words, merges.special[tokens.SPECIAL], tokens.WordTable(bits=8, limit=40))
    texts = fuzz(500, 4)
    got = []
    for _, _, ids, size in encoder.encode_column(pa.array(texts)):
        got += [x.tolist() for x in np.split(ids, np.cumsum(size)[:-1])]
    assert got == [ids_of(t) for t in texts]


def test_trie_shares_prefixes_and_pairs_follow_merges():
    merges = bpe.Merges(PATH)
    words = sorted({w for t in fuzz(300, 9) if t for w in t.split(" ") if w})
    ids, size = merges.encode_words(words[::-1])
    got = [x.tolist() for x in np.split(ids, np.cumsum(size)[:-1])]
    alone = [merges.encode_words([w])[0].tolist() for w in words[::-1]]
    assert got == alone


def test_bpe_query_round_trip(spark):
    docs = awkward(spark)
    got = docs.select("doc_id", "text", bpe.round_trip(docs.text, PATH).alias("b"), bpe.encode(docs.text, PATH).alias("ids"))
    for r in got.withColumn("back", bpe.decode(got.ids, PATH)).collect():
        ids = ids_of(r.text)
        assert r.ids == ids and r.b.n_tokens == len(ids) and r.back == (r.text or "")
        assert r.b.ids_sha256 == hashlib.sha256(le(ids)).hexdigest()
        assert r.b.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    assert empty(spark).select(bpe.round_trip(F.col("text"), PATH)).count() == 0
    odd = spark.createDataFrame([([464, -1, 99999, None, 50256],), (None,), ([222, 101],)], "ids array<int>")
    want = [LIBRARY.decode([464, 50256], skip_special_tokens=False), "", LIBRARY.decode([222, 101], skip_special_tokens=False)]
    assert [r[0] for r in odd.select(bpe.decode(odd.ids, PATH)).collect()] == want


def test_token_files(spark):
    for docs in (awkward(spark), spark.read.parquet(f"{SF_SMALL}/documents.parquet")):
        path = scratch_path(spark, "t-files")
        manifest = token_files.write(docs, path, PATH, frame_tokens=1000)
        rows = sorted(docs.select("doc_id", "text").collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))
        got = sorted(token_files.read(spark, path).collect(), key=lambda r: r.start)
        start = 0
        for r, g in zip(rows, got, strict=True):
            ids = ids_of(r.text) + [0]
            assert (g.doc_id, g.start, g.n_tokens, bytes(g.ids)) == (r.doc_id, start, len(ids), le(ids))
            start += len(ids)
        assert manifest.groupBy().sum("docs").first()[0] == len(rows)
    # plain zstandard reads the stream; the reader opens only the frames it needs; damage is noticed
    import zstandard
    first = manifest.orderBy("file").first()
    raw = open(first.path, "rb").read()
    stream = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
    assert len(stream) == 4 * first.tokens
    wanted = [r for r in got if r.n_tokens < 500][3]
    assert token_files.fetch(path, first.path, [wanted.doc_id])[wanted.doc_id] == np.frombuffer(wanted.ids, "<u4").tolist()
    with open(first.path, "rb") as f:
        reader = token_files.Reader(f)
        reader.tokens(5, 10)
        assert reader.frames_read == 1 and len(reader.sizes) > 3
    broken = scratch_path(spark, "t-broken").removeprefix("file:") + ".zst"
    data = bytearray(raw)
    data[int(reader.at[1]) // 2] ^= 1
    open(broken, "wb").write(data)
    with open(broken, "rb") as f, pytest.raises((ValueError, zstandard.ZstdError)):
        token_files.Reader(f).frame(0)


def test_token_files_of_an_empty_table(spark):
    path = scratch_path(spark, "t-none")
    token_files.write(empty(spark), path, PATH)
    assert token_files.read(spark, path).count() == 0


def fewest(items, capacity):
    items, best = sorted(items, reverse=True), [len(items)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + items[i] <= capacity and bins[k] not in bins[:k]:
                bins[k] += items[i]
                go(i + 1, bins)
                bins[k] -= items[i]
        bins.append(items[i])
        go(i + 1, bins)
        bins.pop()

    go(0, [])
    return best[0]


def test_reduction_keeps_an_optimum():
    r, worse = random.Random(8), 0
    for _ in range(200):
        items = [r.randint(1, 20) for _ in range(9)]
        count = np.bincount(items, minlength=21)
        fixed = packing.reduce_instance(count, 20)
        assert all(sum(parts) <= 20 for parts, _ in fixed)
        rest = [p for p in range(1, 21) for _ in range(count[p])]
        best = fewest(items, 20)
        assert sum(n for _, n in fixed) + fewest(rest, 20) == best
        worse += sum(n for _, n in fixed) + sum(n for _, n in packing.best_fit(count, 20)) > best
    assert worse <= 5


def check_packing(docs, got, capacity=1024):
    by, per = collections.defaultdict(list), collections.defaultdict(list)
    for g in got:
        by[g.sequence_id].append(g)
        per[g.doc_id].append(g)
    for rows in by.values():
        at = 0
        for g in sorted(rows, key=lambda g: g.offset):
            assert g.offset == at
            at += g.length
        assert at <= capacity
    total = 0
    for doc_id, group in collections.Counter((r.doc_id, r.text) for r in docs).items():
        ids = ids_of(doc_id[1]) + [2]
        total += group * len(ids)
        mine = [g for g in per[doc_id[0]]]
        starts = sorted({g.start for g in mine})
        assert starts[0] == 0 and len(mine) == group * len(starts)
        for g in mine:
            assert g.piece == starts.index(g.start) and g.ids_crc32 == zlib.crc32(le(ids[g.start:g.start + g.length]))
            assert g.length == capacity or g.piece == 0
        assert sum(g.length for g in mine) == group * len(ids)
    return len(by), -(-total // capacity)


def test_packing(spark):
    docs = awkward(spark)
    check_packing(docs.collect(), packing.packed(docs, PATH).collect())
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    placed = packing.packed(docs, PATH, with_ids=True)
    n, least = check_packing(docs.collect(), placed.collect())
    assert n <= least + 2
    seqs = packing.sequences(placed).collect()
    assert len(seqs) == n and all(len(s.ids) == 4 * s.n_tokens <= 4096 for s in seqs)
    assert packing.packed(empty(spark), PATH).count() == 0


def test_packing_splits_a_hot_length(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "IF(id % 3 = 0, concat('w', id), 'same words here') AS text")
    placed = packing.packed(docs, PATH, capacity=64)
    check_packing(docs.collect(), placed.collect(), 64)
