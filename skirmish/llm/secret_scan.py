"""Secret scans: a linear-chain conditional random field over tokens, beside fixed base patterns.

Base patterns (fixed values) find assignments, access keys and long hexadecimal strings.  The field tags
every token of every line as outside (O), begin (B) or inside (I) of a secret.  Its features are the
token's shape (length class and make-up), what stands between it and the token before, the
neighbouring words (hashed) and their shapes, and one feature of the whole file (how many of its tokens hold
digits).  Viterbi decodes; a tagged span that touches no base span is added with kind ``crf``.

Training is weakly supervised: the base patterns label every whole text, and a bounded sample is taken of the
distinct texts with a base span and of those without (``SAMPLE`` of each, so rare secrets are not missed).
Each labelled assignment is repeated with other key names and random values, and with harmless
keys and plain values as counter-examples, so that the field learns shapes and contexts the patterns do
not list.  Tasks cut the token windows around the spans, at most ``WINDOWS`` drawn per text, however long it is;
forward-backward and Adagrad run in numpy on the driver; the weights are a few constant tables.

Lines in which no token can gain from being tagged (its best score plus all it could gain from
transitions stays below O) are all O in the best path, so Viterbi is run on the other lines only.

Defined results: a null or empty text has no spans; repeated rows are scanned one by one; if no text of the
table holds a base span, nothing is added.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .arrays import LOWER_ASCII, Powers, span_hashes, task_udf, text_chunks

#: The base patterns with the least length of what they capture.
BASE_PATTERNS = {
    "assign": (re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 6),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 24),
}
KINDS = [*BASE_PATTERNS, "crf"]
KEY_HINTS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

SAMPLE = 4000
REPEATS = 12
WINDOWS = 128  # per sampled text; one assignment and its repeats give about 60
KEYS = ("password", "passwd", "pwd", "secret", "token", "api_key", "apikey", "auth", "credential", "passphrase",
        "access_key", "private_key", "client_secret", "auth_token", "bearer", "session_key")
PLAIN_KEYS = ("title", "name", "color", "author", "page", "date", "lang", "city", "id", "size")
WORD_BUCKETS = 1 << 12
TAGS = 3  # O, B, I

TOKEN = np.zeros(256, dtype=bool)
TOKEN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256), *b"+/_-"]] = True
LENGTHS = np.array([4, 8, 12, 16, 20, 24, 32])
SHAPES = 8 * 16
GAPS = 16
FILES = 4


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns, leftmost and non-overlapping per kind; short ones dropped."""
    out = []
    for kind, (pattern, group, least) in BASE_PATTERNS.items():
        out += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if len(m.group(group)) >= least]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def suspects(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Documents in which a base pattern may occur at all (exact filter, no pattern matches elsewhere)."""
    at = [np.empty(0, np.int64)]
    hexadecimal = ((data >= 48) & (data <= 57)) | ((data >= 97) & (data <= 102))
    run = np.append(0, np.cumsum(hexadecimal))
    if len(data) >= 24:
        at.append(np.flatnonzero(run[24:] - run[:-24] == 24))
    for raw, hints in ((data.tobytes(), (b"AKIA",)), (LOWER_ASCII[data].tobytes(), KEY_HINTS)):
        for hint in hints:
            p = raw.find(hint)
            while p >= 0:
                at.append(np.array([p]))
                p = raw.find(hint, p + 1)  # a hit across the border of two documents may overlap a true one
    return np.unique(np.searchsorted(starts, np.concatenate(at), "right") - 1)


class Tokens:
    """Tokens of a chunk with their feature indices; ``line`` numbers the sequences."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, power: Powers):
        n = len(data)
        inside = TOKEN[data]
        begin, end = inside.copy(), inside.copy()
        begin[1:] &= ~inside[:-1]
        end[:-1] &= ~inside[1:]
        edge = starts[1:-1]
        edge = edge[(edge > 0) & (edge < n)]
        begin[edge], end[edge - 1] = inside[edge], inside[edge - 1]
        self.begin, self.end = np.flatnonzero(begin), np.flatnonzero(end) + 1
        bounds = np.searchsorted(self.begin, starts)
        self.doc = np.repeat(np.arange(len(starts) - 1), np.diff(bounds))
        feeds = np.append(0, np.cumsum(data == 10))
        self.line = feeds[self.begin] + self.doc  # a document or a line feed begins a new sequence
        m = len(self.begin)

        def count(mask: np.ndarray) -> np.ndarray:
            total = np.zeros(n + 1, np.int32)
            np.cumsum(mask, out=total[1:])
            return total[self.end] - total[self.begin]

        lower, upper = count((data >= 97) & (data <= 122)), count((data >= 65) & (data <= 90))
        digit, size = count((data >= 48) & (data <= 57)), self.end - self.begin
        mark = size - lower - upper - digit  # +/_- and bytes beyond ASCII
        make = (lower > 0) + 2 * (upper > 0) + 4 * (digit > 0) + 8 * (mark > 0)
        # a capital first letter alone does not make a word mixed
        capital = (upper == 1) & (lower > 0) & (digit == 0) & (mark == 0)
        make = np.where(capital, 1, make)
        self.shape = np.searchsorted(LENGTHS, size, "right") * 16 + make
        self.word = (span_hashes(LOWER_ASCII[data], self.begin, self.end, power) % np.uint64(WORD_BUCKETS)).astype(np.int64)
        gap_begin = np.append(0, self.end[:-1]) if m else self.end
        same = np.append(False, self.line[1:] == self.line[:-1]) if m else np.empty(0, bool)
        gap = np.zeros(m, np.int64)
        for bit, chars in enumerate((b"=", b":", b"\"'", b" \t")):
            is_char = np.zeros(256, bool)
            is_char[list(chars)] = True
            total = np.append(0, np.cumsum(is_char[data]))
            gap += ((total[self.begin] - total[gap_begin]) > 0).astype(np.int64) << bit
        self.gap = np.where(same, gap, 0)
        last = np.append(same[1:], False) if m else same  # the next token is on the same line
        shift = lambda x, k, ok, none: np.where(ok, np.roll(x, k), none)
        share = np.append(0, np.cumsum(digit > 0))
        rate = (share[bounds[1:]] - share[bounds[:-1]]) / np.maximum(np.diff(bounds), 1)
        self.features = {
            "shape": self.shape, "gap": self.gap, "word": self.word,
            "before": shift(self.word, 1, same, WORD_BUCKETS), "after": shift(self.word, -1, last, WORD_BUCKETS),
            "shape_before": shift(self.shape, 1, same, SHAPES), "shape_after": shift(self.shape, -1, last, SHAPES),
            "file": np.searchsorted([0.01, 0.05, 0.2], rate, "right")[self.doc] if m else self.doc}


TABLES = {"shape": SHAPES, "gap": GAPS, "word": WORD_BUCKETS, "before": WORD_BUCKETS + 1, "after": WORD_BUCKETS + 1,
          "shape_before": SHAPES + 1, "shape_after": SHAPES + 1, "file": FILES}


class Field:
    """Weights of the field: one (values x tags) table per feature, and tag transitions (O to I forbidden)."""

    def __init__(self):
        self.table = {n: np.zeros((size, TAGS), np.float32) for n, size in TABLES.items()}
        self.step = np.zeros((TAGS, TAGS), np.float32)
        self.step[0, 2] = -50
        self.trained = False

    def unary(self, features: dict[str, np.ndarray]) -> np.ndarray:
        total = np.zeros((len(features["shape"]), TAGS), np.float32)
        for n, t in self.table.items():
            total += t[features[n]]
        return total

    def fit(self, windows: list[tuple[np.ndarray, np.ndarray]], epochs: int = 5, rate: float = 0.3,
            decay: float = 1e-4, batch: int = 256, seed: int = 5) -> "Field":
        """``windows``: (feature indices in the order of ``TABLES`` x tokens, tags) of short token sequences."""
        rng = np.random.default_rng(seed)
        square = {n: np.full_like(t, 1e-4) for n, t in self.table.items()} | {"": np.full_like(self.step, 1e-4)}
        rows = np.arange(len(windows))
        for _ in range(epochs):
            rng.shuffle(rows)
            for low in range(0, len(rows), batch):
                picked = [windows[i] for i in rows[low:low + batch]]
                size = np.array([len(t) for _, t in picked])
                width = int(size.max())
                place = np.arange(width)[None, :] < size[:, None]
                flat = dict(zip(TABLES, np.concatenate([f for f, _ in picked], axis=1)))
                gold = np.zeros(place.shape, np.int64)
                gold[place] = np.concatenate([t for _, t in picked])
                score = np.zeros((*place.shape, TAGS), np.float32)
                score[place] = self.unary(flat)
                ahead, back = np.zeros_like(score), np.zeros_like(score)
                ahead[:, 0] = score[:, 0] + self.step[0]
                for t in range(1, width):
                    z = ahead[:, t - 1, :, None] + self.step
                    top = z.max(axis=1)
                    ahead[:, t] = np.where(place[:, t, None], score[:, t] + top + np.log(np.exp(z - top[:, None]).sum(axis=1)), ahead[:, t - 1])
                for t in range(width - 2, -1, -1):
                    z = self.step + (score[:, t + 1] + back[:, t + 1])[:, None, :]
                    top = z.max(axis=2)
                    back[:, t] = np.where(place[:, t + 1, None], top + np.log(np.exp(z - top[..., None]).sum(axis=2)), 0)
                z = ahead[:, -1]
                norm = z.max(axis=1) + np.log(np.exp(z - z.max(axis=1, keepdims=True)).sum(axis=1))
                grad = np.exp(ahead + back - norm[:, None, None])
                np.put_along_axis(grad, gold[..., None], np.take_along_axis(grad, gold[..., None], 2) - 1, 2)
                pair = ahead[:, :-1, :, None] + self.step + (score[:, 1:] + back[:, 1:])[:, :, None, :] - norm[:, None, None, None]
                expect = (np.exp(pair) * place[:, 1:, None, None]).sum(axis=(0, 1)) + np.eye(TAGS)[0][:, None] * np.exp(
                    self.step[0] + score[:, 0] + back[:, 0] - norm[:, None]).sum(axis=0)
                seen = np.zeros((TAGS, TAGS))
                np.add.at(seen, (gold[:, :-1][place[:, 1:]], gold[:, 1:][place[:, 1:]]), 1)
                np.add.at(seen, (np.zeros(len(gold), np.int64), gold[:, 0]), 1)
                flat_grad = grad[place] / len(picked)
                for n, t in self.table.items():
                    g = np.zeros_like(t)
                    np.add.at(g, flat[n], flat_grad)
                    g += decay * t
                    square[n] += g * g
                    t -= rate * g / np.sqrt(square[n])
                g = (expect - seen) / len(picked)
                square[""] += (g * g).astype(np.float32)
                change = rate * g / np.sqrt(square[""])
                change[0, 2] = 0
                self.step -= change.astype(np.float32)
        self.trained = True
        return self

    def tags(self, tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """(token, tag) of all tokens that the best path tags B or I."""
        if not self.trained or not len(tokens.begin):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        score = self.unary(tokens.features)
        gain = max(0.0, float(self.step.max() - self.step[0, 0]))
        hopeful = score[:, 1:].max(axis=1) - score[:, 0] + 2 * gain >= 0
        lines = np.unique(tokens.line[hopeful])
        first = np.searchsorted(tokens.line, lines)
        stop = np.searchsorted(tokens.line, lines, "right")
        where, what = [], []
        step = self.step.tolist()
        for a, b in zip(first.tolist(), stop.tolist()):
            best, origin = step[0], []
            rows = score[a:b].tolist()
            best = [best[k] + rows[0][k] for k in range(TAGS)]
            for row in rows[1:]:
                came = [max(range(TAGS), key=lambda j, k=k: best[j] + step[j][k]) for k in range(TAGS)]
                best = [best[came[k]] + step[came[k]][k] + row[k] for k in range(TAGS)]
                origin.append(came)
            tag = max(range(TAGS), key=best.__getitem__)
            for k in range(b - 1, a - 1, -1):
                if tag:
                    where.append(k)
                    what.append(tag)
                if k > a:
                    tag = origin[k - a - 1][tag]
        return np.array(where[::-1], np.int64), np.array(what[::-1], np.int64)


def tagged_spans(tokens: Tokens, field: Field) -> list[tuple[int, int, int]]:
    """(document, begin byte, end byte) of the secrets the field finds."""
    out, previous = [], -2
    for k, tag in sorted(zip(*(x.tolist() for x in field.tags(tokens)))):
        d, b, e = int(tokens.doc[k]), int(tokens.begin[k]), int(tokens.end[k])
        if tag == 2 and previous == k - 1 and out and out[-1][0] == d:
            out[-1] = (d, out[-1][1], e)
        else:
            out.append((d, b, e))
        previous = k
    return out


def random_value(rng: np.random.Generator) -> str:
    kind, n = rng.integers(5), int(rng.integers(16, 48))
    letters = ["0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "abcdefghijklmnopqrstuvwxyz0123456789",
               "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFabcdefghijklmnop0123456789+/_-"][kind]
    return "".join(letters[i] for i in rng.integers(len(letters), size=n))


def labelled_windows(text: str, rng: np.random.Generator, power: Powers, repeats: int = REPEATS, width: int = 8,
                     most: int = WINDOWS) -> tuple[bool, list[tuple[np.ndarray, np.ndarray]]]:
    """Whether a whole text holds a base span, and its labelled token windows (a random draw of ``most`` if there are more)."""
    # merge what the kinds share; of an assignment only the value is the secret
    spans = [(m.start(g), m.end(g)) for p, g, least in BASE_PATTERNS.values() for m in p.finditer(text) if len(m.group(g)) >= least]
    labelled: list[tuple[str, list[tuple[int, int]]]] = [(text, spans)]
    assigned = [m for m in BASE_PATTERNS["assign"][0].finditer(text) if len(m.group(2)) >= 6]
    if len(assigned) > most:
        assigned = [assigned[i] for i in np.sort(rng.choice(len(assigned), most, replace=False))]
    for m in assigned:
        head, tail = text[max(0, m.start() - 60):m.start()], text[m.end():m.end() + 60]
        words = text[max(0, m.start() - 400):m.start()].split() or ["page"]
        for _ in range(repeats):
            join, quote = [" = ", "=", ": ", ":", " "][rng.integers(5)], ["\"", "'", ""][rng.integers(3)]
            secret = join != " " or bool(rng.integers(2))
            key = (KEYS if secret else PLAIN_KEYS)[rng.integers(len(KEYS if secret else PLAIN_KEYS))]
            value = random_value(rng)
            if join == " ":
                secret = False
            if rng.integers(3) == 0:
                key, value, secret = PLAIN_KEYS[rng.integers(len(PLAIN_KEYS))], words[rng.integers(len(words))], False
            elif not secret:
                value = words[rng.integers(len(words))]
            lead = f"{head}{key}{join}{quote}"
            labelled.append((f"{lead}{value}{quote}{tail}", [(len(lead), len(lead) + len(value))] if secret else []))
    windows = []
    for text, spans in labelled:
        data = np.frombuffer(text.encode(), np.uint8)
        if not len(data):
            continue
        tokens = Tokens(data, np.array([0, len(data)]), power)
        m = len(tokens.begin)
        tag = np.zeros(m, np.int64)
        at = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))  # first byte of every code point
        for a, b in spans:
            i, j = np.searchsorted(tokens.end, at[a], "right"), np.searchsorted(tokens.begin, at[b])
            tag[i:j] = 2
            tag[i:min(i + 1, j)] = 1
        centres = np.flatnonzero(tag == 1).tolist() + rng.integers(m, size=min(m, 4)).tolist() if m else []
        if len(centres) > most:
            centres = [centres[i] for i in np.sort(rng.choice(len(centres), most, replace=False))]
        for c in centres:
            lo, hi = max(0, c - width), min(m, c + width + 1)
            same = np.flatnonzero(tokens.line[lo:hi] == tokens.line[c]) + lo
            windows.append((np.stack([tokens.features[n][same] for n in TABLES]).astype(np.int16),
                            np.where((tag[same] == 2) & (same == same[0]), 1, tag[same]).astype(np.int8)))
    if len(windows) > most:
        windows = [windows[i] for i in np.sort(rng.choice(len(windows), most, replace=False))]
    return bool(labelled[0][1]), windows


def training_windows(texts: list[str], repeats: int = REPEATS, width: int = 8, seed: int = 9) -> list[tuple[np.ndarray, np.ndarray]]:
    """Labelled token windows of sampled texts; empty if no text holds a base span."""
    rng, power = np.random.default_rng(seed), Powers()
    seen = [labelled_windows(text, rng, power, repeats, width) for text in texts]
    return [w for _, windows in seen for w in windows] if any(found for found, _ in seen) else []


def _holds(column: pa.Array) -> pa.Array:
    """Whether a whole text holds a base span."""
    out = [np.empty(0, bool)]
    for _, _, data, starts in text_chunks(column):
        held = np.zeros(len(starts) - 1, bool)
        for d in suspects(data, starts).tolist():
            held[d] = bool(base_spans(data[starts[d]:starts[d + 1]].tobytes().decode()))
        out.append(held)
    return pa.array(np.concatenate(out))


def _windows(key: pa.Array, column: pa.Array) -> pa.Array:
    """Labelled windows of every whole text, packed: token counts, features and tags one after the other."""
    power, sizes, features, tags = Powers(), [], [], []
    for k, text in zip(key, column):
        _, windows = labelled_windows(text.as_py(), np.random.default_rng(k.as_py() & ((1 << 64) - 1)), power)
        sizes.append([len(t) for _, t in windows])
        features.append(b"".join(f.tobytes() for f, _ in windows))
        tags.append(b"".join(t.tobytes() for _, t in windows))
    return pa.StructArray.from_arrays(
        [pa.array(sizes, pa.list_(pa.int32())), pa.array(features, pa.binary()), pa.array(tags, pa.binary())], ["size", "features", "tags"])


def train(docs: DataFrame, sample: int = SAMPLE) -> Field:
    """Field learnt from at most ``sample`` distinct texts with a base span and as many without, in the order of their hash.

    One pass over all texts finds which of them hold a base span; the windows of the picked ones are cut in the tasks.
    """
    texts = docs.filter("text is not null").select(F.xxhash64("text").alias("key"), "text")
    flags = materialize(texts.select("key", task_udf(_holds, "boolean")("text").alias("held")).groupBy("key").agg(F.max("held").alias("held")),
                        "secret-flags")
    held, free = (flags.filter(F.col("held") == h).orderBy("key").limit(sample).select("key") for h in (True, False))
    if held.isEmpty():
        return Field()
    rows = texts.join(F.broadcast(held.union(free)), "key").dropDuplicates(["key"])
    rows = rows.select("key", task_udf(_windows, "struct<size:array<int>,features:binary,tags:binary>")("key", "text").alias("w"))
    table = rows.select("key", "w.*").toArrow()
    windows = []
    for i in np.argsort(table.column("key").to_numpy(), kind="stable").tolist():  # whatever order the tasks delivered
        at = 0
        features, tags = (np.frombuffer(table.column(c)[i].as_buffer(), kind) for c, kind in (("features", np.int16), ("tags", np.int8)))
        for n in table.column("size")[i].as_py():
            windows.append((features[len(TABLES) * at:len(TABLES) * (at + n)].reshape(len(TABLES), n), tags[at:at + n]))
            at += n
    field = Field().fit(windows)
    del table, windows, features, tags
    pa.default_memory_pool().release_unused()
    return field


def spans_of(column: pa.Array, field: Field, power: Powers):
    """Yield the spans (kind, start, end in code points) of every text, by start and then kind, and the text if it has any."""
    for _, _, data, starts in text_chunks(column):
        per_doc: dict[int, list[tuple[str, int, int]]] = {}
        for d in suspects(data, starts).tolist():
            if spans := base_spans(data[starts[d]:starts[d + 1]].tobytes().decode()):
                per_doc[d] = spans
        extra = tagged_spans(Tokens(data, starts, power), field)
        if extra:
            points = np.append(0, np.cumsum((data & 0xC0) != 0x80))
            for d, b, e in extra:
                b, e = int(points[b] - points[starts[d]]), int(points[e] - points[starts[d]])
                if all(e <= x or b >= y for k, x, y in per_doc.get(d, []) if k != "crf"):
                    per_doc.setdefault(d, []).append(("crf", b, e))
        for d in range(len(starts) - 1):
            spans = sorted(per_doc.get(d, []), key=lambda s: (s[1], KINDS.index(s[0])))
            yield spans, data[starts[d]:starts[d + 1]].tobytes().decode() if spans else None


def scan(text: Column, field: Field) -> Column:
    """array<struct<kind,start,end>> of every whole text, in code points, by start and then kind."""
    def run(column: pa.Array) -> pa.Array:
        size, kinds, begins, ends = [0], [], [], []
        for spans, _ in spans_of(column, field, Powers()):
            size.append(size[-1] + len(spans))
            for k, b, e in spans:
                kinds.append(k)
                begins.append(b)
                ends.append(e)
        struct = pa.StructArray.from_arrays([pa.array(kinds, pa.string()), pa.array(begins, pa.int64()), pa.array(ends, pa.int64())], ["kind", "start", "end"])
        return pa.ListArray.from_arrays(pa.array(size, pa.int32()), struct)

    return task_udf(run, "array<struct<kind:string,start:bigint,end:bigint>>")(text)


def joined(spans: Column) -> Column:
    """kind:start:end of the spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(spans: Column) -> list[Column]:
    """n_assign, n_access, n_hex, base_sha256 and spans of a span column."""
    base = F.filter(spans, lambda s: s["kind"] != "crf")

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return [*map(count, BASE_PATTERNS), F.sha2(joined(base), 256).alias("base_sha256"), joined(spans).alias("spans")]


def redacted(text: str, spans: list[tuple[str, int, int]], mark: str) -> str:
    parts, at = [], 0
    for _, b, e in sorted(spans, key=lambda s: s[1]):
        if b >= at:
            parts += [text[at:b], mark]
        at = max(at, e)
    return "".join([*parts, text[at:]])


def redact(text: Column, field: Field, mark: str = "[SECRET]") -> Column:
    """The text with every span replaced by ``mark`` (overlapping spans by one); null if it has none.

    Scans and replaces in one pass, so a task needs one Python worker and texts without a secret do not come back.
    """
    def run(column: pa.Array) -> pa.Array:
        return pa.array([redacted(t, spans, mark) if spans else None for spans, t in spans_of(column, field, Powers())], pa.string())

    return task_udf(run, "string")(text)
