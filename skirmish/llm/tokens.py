"""Byte-level BPE over whole Arrow columns: vectorised pre-tokenisation and a bounded table of known words.

The pre-tokeniser of the public 50k byte-level vocabulary is the pattern

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

``word_starts`` finds its cuts with array operations on the code points of many documents at once.  Words
are looked up by a 64-bit hash in ``WordTable``, which compares the bytes on every hit (the first 16 of them as two integers); only
words not seen yet are spelled out and encoded, by whatever encoder the caller brings (the tokenizers library, or the trie of ``bpe.py``).  The table is
a cache: when it is full it starts afresh, which costs time and never changes a result.  Words whose hash belongs to
another word are kept by their spelling.
"""

from __future__ import annotations

import sys
import types
import unicodedata

import numpy as np
import pyarrow as pa

from .arrays import Powers, mix, ragged, span_keys, text_chunks

SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3
#: White space by the Unicode property White_Space.
WHITE_SPACE = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: Texts that hold the string of a special token are cut around it.
SPECIAL = "<|endoftext|>"
TABLE_BITS = 20
TABLE_WORDS = 1 << 19
#: Mask of the first 0 to 8 bytes of a little-endian integer.
HEADS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def code_classes() -> np.ndarray:
    """Class of every code point: white space, letter, number or other."""
    cache = sys.modules.setdefault("skirmish_llm_worker_cache", types.ModuleType("skirmish_llm_worker_cache"))
    if not hasattr(cache, "classes"):
        kind = {"L": LETTER, "N": NUMBER}
        out = np.fromiter((kind.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
        out[WHITE_SPACE] = SPACE
        cache.classes = out
    return cache.classes


def word_starts(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sorted begin positions of the pre-tokens of documents ``codes[starts[i]:starts[i + 1]]``."""
    n = len(codes)
    if n == 0:
        return np.empty(0, np.int64)
    kind = code_classes()[codes]
    first = np.zeros(n + 1, dtype=bool)  # a document begins here
    first[starts] = True
    change = np.empty(n, dtype=bool)
    change[0] = True
    np.not_equal(kind[1:], kind[:-1], out=change[1:])
    change |= first[:n]
    cut = change.copy()
    # white space before a non-space run: its last character stands alone, or joins the run if it is a blank
    white = kind == SPACE
    last_white = np.flatnonzero(white[:-1] & ~white[1:] & ~first[1:n])
    cut[last_white] = True
    joined = last_white[codes[last_white] == 32]
    cut[joined + 1] = False
    # contractions: a lone apostrophe that no blank precedes, before s, t, m, d, re, ve or ll
    quote = np.flatnonzero((codes == 39) & cut)
    if len(quote):
        padded = np.append(codes, [0, 0, 0]).astype(np.int64)
        same_doc = np.append(first, [True, True])
        one = np.where(same_doc[quote + 1], 0, padded[quote + 1])
        two = np.where(same_doc[quote + 1] | same_doc[quote + 2], 0, padded[quote + 2])
        single = np.isin(one, [115, 116, 109, 100])
        double = ((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108)
        for hit, size in ((single, 2), (double & ~single, 3)):
            q = quote[hit]
            cut[q + 1] = False
            after = q + size
            inside = after < n
            cut[after[inside]] = True
            # a blank that ends a white-space run right after joins the next run as before (already cut)
    return np.flatnonzero(cut)


class Words:
    """Spans of UTF-8 bytes, each with its first 16 bytes in two integers (zero beyond its end)."""

    def __init__(self, data: np.ndarray, begin: np.ndarray, size: np.ndarray, head: np.ndarray | None = None, tail: np.ndarray | None = None):
        self.data, self.begin, self.size = data, begin, size
        if head is None:
            padded = np.append(data, np.zeros(24, np.uint8))
            eight = np.ndarray((len(data) + 16,), np.uint64, padded, strides=(1,))  # the eight bytes from every place on
            head, tail = eight[begin] & HEADS[np.minimum(size, 8)], eight[begin + 8 * (size > 8)] & HEADS[np.clip(size - 8, 0, 8)]
        self.head, self.tail = head, tail

    def pick(self, which: np.ndarray) -> "Words":
        return Words(self.data, self.begin[which], self.size[which], self.head[which], self.tail[which])

    def keys(self, power: Powers) -> np.ndarray:
        """64-bit hash of each word; contents are compared on a hit."""
        out = mix(mix(self.head + self.size.astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D)) + self.tail * np.uint64(0xD6E8FEB86659FD93))
        long = np.flatnonzero(self.size > 16)
        if len(long):
            size = self.size[long]
            upto = np.cumsum(size)
            out[long] ^= span_keys(self.data[ragged(self.begin[long], size)], upto - size, upto, power)
        return out

    def spelt(self) -> list[str]:
        raw = self.data.tobytes()
        return [raw[b:b + n].decode() for b, n in zip(self.begin.tolist(), self.size.tolist())]


class WordTable:
    """Open-addressing table from words (hash and bytes) to token ids, in numpy arrays of bounded size."""

    def __init__(self, bits: int = TABLE_BITS, limit: int = TABLE_WORDS):
        self.bits, self.limit = bits, limit
        self.clear()

    def clear(self) -> None:
        self.key = np.zeros(1 << self.bits, np.uint64)
        self.slot = np.full(1 << self.bits, -1, np.int32)
        self.pool, self.used = np.empty(1 << 16, np.uint16), 0
        self.begin, self.size, self.words = np.empty(1 << 16, np.int64), np.empty(1 << 16, np.int32), 0
        self.letters, self.lettered = np.empty(1 << 18, np.uint8), 0  # the bytes of words of more than 16
        self.spelt_at, self.spelt_size = np.empty(1 << 16, np.int64), np.empty(1 << 16, np.int64)
        self.head, self.tail = np.empty(1 << 16, np.uint64), np.empty(1 << 16, np.uint64)
        self.spelt: dict[str, int] = {}  # entries of words whose hash belongs to another word

    def find(self, hashes: np.ndarray, words: Words) -> np.ndarray:
        """Entry of each word, -1 where it is not there."""
        entry = self.slot_of(hashes)
        at = np.maximum(entry, 0)
        same = (self.spelt_size[at] == words.size) & (self.head[at] == words.head) & (self.tail[at] == words.tail)
        entry[~same] = -1
        long = np.flatnonzero((entry >= 0) & (words.size > 16))
        if len(long):
            size = words.size[long]
            differ = words.data[ragged(words.begin[long], size)] != self.letters[ragged(self.spelt_at[entry[long]], size)]
            if differ.any():
                entry[long[np.logical_or.reduceat(differ, np.cumsum(size) - size)]] = -1
        return entry

    def slot_of(self, hashes: np.ndarray) -> np.ndarray:
        """Entry of each hash, -1 where it is not there."""
        mask = np.uint64((1 << self.bits) - 1)
        at = (hashes & mask).astype(np.int64)
        out = self.slot[at]
        open_ = np.flatnonzero((out >= 0) & (self.key[at] != hashes))
        while len(open_):
            at[open_] = (at[open_] + 1) & int(mask)
            out[open_] = self.slot[at[open_]]
            open_ = open_[(out[open_] >= 0) & (self.key[at[open_]] != hashes[open_])]
        return out

    def store(self, ids: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Entries of new words: ``ids`` holds their tokens one after the other."""
        while self.used + len(ids) > len(self.pool):
            self.pool = np.append(self.pool, np.empty_like(self.pool))
        while self.words + len(size) > len(self.size):
            self.begin, self.size = np.append(self.begin, np.empty_like(self.begin)), np.append(self.size, np.empty_like(self.size))
            self.spelt_at, self.spelt_size, self.head, self.tail = (
                np.append(x, np.empty_like(x)) for x in (self.spelt_at, self.spelt_size, self.head, self.tail))
        self.pool[self.used:self.used + len(ids)] = ids
        entry = np.arange(self.words, self.words + len(size), dtype=np.int32)
        self.size[entry] = size
        self.begin[entry] = self.used + np.cumsum(size) - size
        self.used, self.words = self.used + len(ids), self.words + len(size)
        return entry

    def add(self, hashes: np.ndarray, ids: np.ndarray, size: np.ndarray, words: Words) -> None:
        """New words with their ids, each hash once."""
        entry, length = self.store(ids, size), np.where(words.size > 16, words.size, 0)
        spelling = words.data[ragged(words.begin, length)]
        while self.lettered + len(spelling) > len(self.letters):
            self.letters = np.append(self.letters, np.empty_like(self.letters))
        self.letters[self.lettered:self.lettered + len(spelling)] = spelling
        self.spelt_at[entry], self.spelt_size[entry] = self.lettered + np.cumsum(length) - length, words.size
        self.head[entry], self.tail[entry] = words.head, words.tail
        self.lettered += len(spelling)
        mask = (1 << self.bits) - 1
        at = (hashes & np.uint64(mask)).astype(np.int64)
        left = np.arange(len(hashes))
        while len(left):
            free = self.slot[at[left]] < 0
            claim = left[free]
            self.slot[at[claim]] = entry[claim]  # of several claims to one place the last stands
            won = claim[self.slot[at[claim]] == entry[claim]]
            self.key[at[won]] = hashes[won]
            left = left[self.slot[at[left]] != entry[left]]
            at[left] = (at[left] + 1) & mask


class Encoder:
    """Token ids of documents; ``encode_words(list of words)`` gives (ids, ids per word) of unseen words."""

    def __init__(self, encode_words, special_id: int, table: WordTable | None = None, keys=None):
        self.encode_words, self.special_id, self.keys = encode_words, special_id, keys
        self.table, self.power = table or WordTable(), Powers()

    def entries(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Table entries of the words data[begin:end]."""
        words = Words(data, begin, end - begin)
        hashes = self.keys(data, begin, end, self.power) if self.keys else words.keys(self.power)
        found = self.table.find(hashes, words)
        missing = np.flatnonzero(found < 0)
        if len(missing):
            new, where = np.unique(hashes[missing], return_index=True)
            if self.table.words + len(new) > self.table.limit:
                self.table.clear()
                new, where = np.unique(hashes, return_index=True)
                missing = np.arange(len(hashes))
            free = self.table.slot_of(new) < 0
            new, at = new[free], missing[where[free]]
            if self.table.words + len(new) > 3 * (len(self.table.key) // 4):  # one huge chunk: make room
                self.table = WordTable(max(self.table.bits, int(len(new) * 2).bit_length()), self.table.limit)
                missing = np.arange(len(hashes))
            if len(at):
                fresh = words.pick(at)
                self.table.add(new, *self.encode_words(fresh.spelt()), fresh)
            found[missing] = self.table.find(hashes[missing], words.pick(missing))
            clash = np.flatnonzero(found < 0)  # their hash belongs to another word
            if len(clash):
                spelt = words.pick(clash).spelt()
                unknown = sorted({w for w in spelt if w not in self.table.spelt})
                if unknown:
                    self.table.spelt.update(zip(unknown, self.table.store(*self.encode_words(unknown)).tolist()))
                found[clash] = [self.table.spelt[w] for w in spelt]
        return found

    def encode_chunk(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all documents, ids per document) of UTF-8 ``data`` cut at ``starts``."""
        text = data.tobytes().decode("utf-8")
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        lead = (data & 0xC0) != 0x80
        place = np.append(np.flatnonzero(lead), len(data))  # first byte of every code point
        at = np.searchsorted(place, starts)
        cuts, special = at, np.empty(0, np.int64)
        if SPECIAL in text:
            special = self._special(text, at)
            cuts = np.unique(np.concatenate([at, special, special + len(SPECIAL)]))
        begin = word_starts(codes, cuts)
        if len(special):
            inside = np.searchsorted(special, begin, "right") - 1
            drop = (inside >= 0) & (begin < special[inside] + len(SPECIAL)) & (begin > special[inside])
            begin = begin[~drop]
        end = np.append(begin[1:], len(codes))[:len(begin)]
        is_special = np.isin(begin, special)
        entry = np.full(len(begin), -1, np.int64)
        entry[~is_special] = self.entries(data, place[begin[~is_special]], place[end[~is_special]])
        size = np.where(is_special, 1, self.table.size[entry] if self.table.words else 1).astype(np.int64)
        where = np.where(is_special, 0, self.table.begin[entry] if self.table.words else 0)
        ids = self.table.pool[ragged(where, size)]
        if len(special):
            ids[(np.cumsum(size) - size)[is_special]] = self.special_id
        upto = np.append(0, np.cumsum(size))
        return ids, np.diff(upto[np.searchsorted(begin, at)])

    @staticmethod
    def _special(text: str, at: np.ndarray) -> np.ndarray:
        out, p = [], text.find(SPECIAL)
        while p >= 0:
            doc = np.searchsorted(at, p, "right")
            if doc >= len(at) or p + len(SPECIAL) <= at[doc]:  # not across two documents
                out.append(p)
                p = text.find(SPECIAL, p + len(SPECIAL))
            else:
                p = text.find(SPECIAL, p + 1)
        return np.array(out, np.int64)

    def encode_column(self, column):
        """Yield (first row, end row, ids, ids per row) of an Arrow string column, chunk by chunk."""
        for i, j, data, starts in text_chunks(column):
            yield i, j, *self.encode_chunk(data, starts)


def library_words(tokenizer):
    """``encode_words`` through the tokenizers library.

    Words go to the library as one text, separated by line feeds: the pre-tokeniser cuts a line feed off
    from what follows, so every word is encoded by itself, and token 198 (line feed) marks the ends.
    Words that hold a line feed or are white space are encoded one by one.
    """
    feed = tokenizer.encode("\n", add_special_tokens=False).ids[0]

    def encode(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        odd = [k for k, w in enumerate(words) if "\n" in w or w.isspace()]
        alone = set(odd)
        plain = [w for k, w in enumerate(words) if k not in alone] if odd else words
        joined = "\n".join([*plain, "."])  # the full stop keeps the last line feed apart
        ids = np.array(tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids[:-1], np.int64)
        ends = np.flatnonzero(ids == feed)
        size = np.diff(ends, prepend=-1) - 1
        ids = np.delete(ids, ends)
        if odd:  # put the words encoded by themselves back in their places
            own = [tokenizer.encode(words[k], add_special_tokens=False).ids for k in odd]
            all_ids = np.concatenate([ids, np.array([x for o in own for x in o], np.int64)])
            sizes = np.concatenate([size, np.array([len(o) for o in own], np.int64)])
            place = np.empty(len(words), np.int64)
            place[np.setdiff1d(np.arange(len(words)), odd)] = np.arange(len(size))
            place[odd] = len(size) + np.arange(len(odd))
            begin = np.cumsum(sizes) - sizes
            ids, size = all_ids[ragged(begin[place], sizes[place])], sizes[place]
        return ids.astype(np.uint16), size

    return encode


def library_encoder(path: str) -> Encoder:
    """The encoder of a worker for a tokenizer file, kept between the worker's tasks."""
    cache = sys.modules.setdefault("skirmish_llm_worker_cache", types.ModuleType("skirmish_llm_worker_cache"))
    known = cache.__dict__.setdefault("encoders", {})
    if path not in known:
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(path)
        if tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids must fit 16 bits")
        known[path] = Encoder(library_words(tokenizer), tokenizer.token_to_id(SPECIAL))
    return known[path]
