"""Words made to collide under hashes modulo 2 ** 64 stay apart; wide ids; shared ids in SQL; vocabulary files."""

from __future__ import annotations

import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from skirmish.llm import arrays, bpe, near_dedup, oracle, quality, queries, sharding, token_files, tokens, toxicity, url_filter
from skirmish.session import scratch_path
from tests.util import normalise

PATH = queries.vocabulary()
LIBRARY = Tokenizer.from_file(PATH)


def twins(k):
    """The Thue-Morse word of 2 ** k letters and its complement."""
    bits = [bin(i).count("1") % 2 for i in range(1 << k)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


TWINS = [twins(k) for k in (10, 11, 12)]


def test_the_words_do_collide_modulo_a_power_of_two():
    for a, b in TWINS:
        data = np.frombuffer((a + b).encode(), np.uint8)
        begin, end = np.array([0, len(a)]), np.array([len(a), 2 * len(a)])
        assert len(set(arrays.span_keys(data, begin, end, arrays.Powers()).tolist())) == 1
        assert len(set(arrays.span_hashes(data, begin, end, arrays.Powers()).tolist())) == 2


def test_hashes_are_polynomials_modulo_the_primes():
    r = random.Random(1)
    for top, n in ((256, 500), (0x110000, 9000)):  # long spans of high code points need products reduced first
        codes = np.array([r.randrange(top) for _ in range(n)], np.uint32)
        begin = np.array([0, 1, 7, 0, n - 1, 5])
        end = np.array([n, 9, 7, 3, n, n - 2])
        got = arrays.span_hashes(codes, begin, end, arrays.Powers())
        want = []
        for b, e in zip(begin, end):
            x, y = (sum((int(c) + 1) * pow(base, i, p) for i, c in enumerate(codes[b:e])) % p for p, base in arrays.MODULI)
            want.append(((x << 32 | y) + int(e - b) * 0x2545F4914F6CDD1D) % (1 << 64))
        assert got.tolist() == arrays.mix(np.array(want, np.uint64)).tolist()


@pytest.mark.parametrize("encoder", [lambda: tokens.library_encoder(PATH), lambda: bpe.merges_of(PATH)[1]])
def test_encoders_keep_twins_apart(encoder):
    texts = [t for pair in TWINS for t in (*pair, f"{pair[0]} {pair[1]} {pair[0]}", pair[1])]
    for column in (pa.array(texts), *[pa.array([t]) for t in texts]):
        got = [x.tolist() for _, _, ids, size in encoder().encode_column(column) for x in np.split(ids, np.cumsum(size)[:-1])]
        assert got == [LIBRARY.encode(t.as_py(), add_special_tokens=False).ids for t in column]


@pytest.mark.parametrize("bits, limit", [(0, 1 << 19), (3, 1 << 19), (6, 60)])
def test_word_table_compares_contents(bits, limit):
    """With hashes cut to a few bits most words clash; the ids are still the library's."""
    r = random.Random(bits)
    pieces = ["a", "b", "ab", " ", " ", "\n", "é", "漢", "1", "!", "ing", "<|endoftext|>"]
    texts = ["".join(r.choice(pieces) for _ in range(r.randint(0, 30))) for _ in range(600)] + [t for p in TWINS for t in p]
    merges = bpe.Merges(PATH)
    cut = lambda *a: arrays.span_keys(*a) & np.uint64((1 << bits) - 1)
    encoder = tokens.Encoder(merges.encode_words, merges.special[tokens.SPECIAL], tokens.WordTable(bits=12, limit=limit), keys=cut)
    got = []
    for k in range(0, len(texts), 50):
        for _, _, ids, size in encoder.encode_column(pa.array(texts[k:k + 50])):
            got += [x.tolist() for x in np.split(ids, np.cumsum(size)[:-1])]
    assert got == [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]


def test_lines_windows_and_shingles_of_twins(spark):
    for a, b in TWINS:
        (f,) = quality.text_features(pa.array([f"{a}\n{b}\n{a} x y z w {b} x y z w"])).to_pylist()
        assert (f["n_dup_lines"], f["n_repeat_words"]) == (0, 0)
        got = near_dedup.components(spark.createDataFrame([(1, a), (2, b), (3, a.upper())], "doc_id bigint, text string")).collect()
        assert {r.doc_id: r.component_id for r in got} == {1: 1, 2: 2, 3: 1}


def test_near_dedup_sql_over_shared_and_missing_ids(spark):
    r = random.Random(4)
    x, y, z = (" ".join(f"w{r.randrange(5000)}" for _ in range(60)) for _ in range(3))
    rows = [(7, x), (7, x + " end"), (9, x), (7, y), (2, y), (3, z), (None, z), (5, ""), (5, None), (6, "a b"), (7, "a b"), (-1, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = near_dedup.components(docs).toPandas()
    assert set(got[got.doc_id == 7].groupby("component_id").kept.all().items()) == {(7, True), (2, False), (6, False)}
    con = duckdb.connect()
    con.register("frame", docs.toPandas())
    con.execute("CREATE VIEW documents AS SELECT doc_id::BIGINT AS doc_id, text FROM frame")
    assert normalise(got).equals(normalise(con.sql(oracle.near_dedup_sql()).df()))


def test_sharding_of_wide_ids(spark):
    ids = [-5, 0, 3, 9, 2 ** 62, 2 ** 63 - 1, -2 ** 63, -2 ** 62]
    docs = spark.createDataFrame([(i, "one text") for i in ids for _ in range(3)] + [(i, f"text {i}") for i in range(40)], "doc_id bigint, text string")
    back = sharding.write(docs, scratch_path(spark, "wide")).collect()
    assert len(back) == docs.count()
    order = sorted((r["__shard"], r.doc_id) for r in back if r.text == "one text")
    assert [i for _, i in order] == sorted(i for _, i in order)


def test_token_files_tell_the_least_id_from_a_missing_one(spark):
    docs = spark.createDataFrame([(-2 ** 63, "least"), (None, "none"), (0, "zero"), (-2 ** 63, None)], "doc_id bigint, text string")
    path = scratch_path(spark, "ids")
    token_files.write(docs, path, PATH)
    back = sorted(((r.doc_id, r.n_tokens) for r in token_files.read(spark, path).collect()), key=str)
    n = lambda t: len(LIBRARY.encode(t).ids) + 1
    assert back == sorted([(-2 ** 63, n("least")), (None, n("none")), (0, n("zero")), (-2 ** 63, 1)], key=str)


def test_toxicity_training_decides_ties(spark):
    texts = [f"text {k} of one id" for k in range(6)]
    docs = spark.createDataFrame([(2, t) for t in texts] + [(4, "another"), (4, "another")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(2, 0), (2, 1), (2, 0), (4, 0), (4, None)], "doc_id bigint, toxic int")
    kept = docs.filter(~toxicity.held_out(docs.doc_id))
    hashed = kept.selectExpr("doc_id", "text", "xxhash64(text) AS h").collect()
    least = {i: min((r.h, r.text) for r in hashed if r.doc_id == i)[1] for i in {r.doc_id for r in hashed}}
    got = {r.doc_id: (r.toxic, r.text) for r in toxicity.training_rows(docs, labels).collect()}
    assert got == {i: (int(i == 2), t) for i, t in least.items()}


def test_vocabulary_of_a_file(spark):
    path = scratch_path(spark, "terms")
    spark.createDataFrame([("Bad", "strict", None), ("odd", "soft", 1), ("ODD", "soft", 3), ("Strange", "soft", 1), ("bad", "soft", 1)],
                          "a string, b string, c int").write.csv(path)
    strict, soft = url_filter.read_vocabulary(spark, path)
    assert strict == ("bad",) and soft == {"odd": 3, "strange": 1}
    pages = spark.createDataFrame([("http://a/odd/odd",), ("http://a/odd/strange",), ("http://a/bad",), ("http://a/casino",)], "url string")
    got = [(r.verdict, r.n_strict, r.n_soft, r.soft_weight) for r in url_filter.judged(pages, strict=strict, soft=soft, limit=3).collect()]
    assert got == [("allow", 0, 1, 3), ("block", 0, 2, 4), ("block", 1, 0, 0), ("allow", 0, 0, 0)]
