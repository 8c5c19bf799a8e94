"""Personal information in free text: a linear-chain conditional random field over word shapes.

Texts are cut into segments (lines, sentences) and these into tokens: runs of letters of one script,
runs of digits, single ideographs and signs. Features are words, shapes, neighbours and the shape of
the number a token belongs to; digits count only by how many there are. The field is trained from
the labelled table of pii_table (its number of lines is the bound of the sample) by AdaGrad on the
exact likelihood, and decoded by Viterbi over batches of segments of like length in numpy.

An exact check follows the decoding: an address needs a number, a telephone number 7 to 20 digits (extensions and figures run on to it),
an e-mail address its sign, an identity number enough digits, a name no digit.

Defined results: null gives null and nothing found; empty and blank texts are returned as they are.
Overlapping finds do not occur. Texts and segments are read whole, however long.
"""

from __future__ import annotations

import re
from bisect import bisect
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm import pii_table
from ledgerloom.session import spread

KINDS = ("email", "phone", "id_number", "address", "name")
LABELS = ("O", *[f"{p}-{k}" for k in KINDS for p in "BI"])
K = len(LABELS)
TOKEN = re.compile(r"\d+|[A-Za-zÀ-ɏ]+|[가-힣]+|[ぁ-ゟ]+|[゠-ヿ]+|[㐀-鿿々ヶ]|\S")
SEGMENT = re.compile(r"(?<=[。！？])|\n|(?<=[a-zà-ÿ%0-9가-힣]{2}\.)[ \t]+")
WIDE = {c: c - 0xFEE0 for c in range(0xFF01, 0xFF5F)} | {0x3000: 0x20, 0x00A0: 0x20, 0x2010: 0x2D, 0x2011: 0x2D, 0x2013: 0x2D, 0x2212: 0x2D}
#: Tokens whose features are made at once: a bound of memory that changes no result.
TOGETHER = 20_000
#: A cache of what a worker has decoded, by segment with its digits made alike; it changes no result.
CACHED = 50_000


FOLD = np.arange(0x10000, dtype=np.uint32)
FOLD[list(WIDE)] = list(WIDE.values())
FOLD[(FOLD >= 0x31) & (FOLD <= 0x39)] = 0x30


def folded(text: str) -> str:
    """Full-width signs in plain form and all digits alike; every character keeps its place."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    plain = np.where(points < 0x10000, FOLD[np.minimum(points, 0xFFFF)], points)
    return plain.astype(np.uint32).tobytes().decode("utf-32-le", "surrogatepass")


def _shape(w: str) -> str:
    c = w[0]
    if c == "0":
        return f"d{len(w)}"
    if c.isascii():
        if not c.isalpha():
            return w
    elif "가" <= c <= "힣":
        return f"H{min(len(w), 7)}"
    elif "㐀" <= c <= "鿿":
        return "K"
    elif "぀" <= c <= "ヿ":
        return "J"
    elif not c.isalpha():
        return "S"
    return "U1" if len(w) == 1 and w.isupper() else "U" if w.isupper() else "T" if w[0].isupper() else "l"


NUMERIC = frozenset("-().+/~")
#: Features by template; each is one 64-bit key made of the codes of what it looks at.
N_TEMPLATES = 30
ODD = np.uint64(0x9E3779B97F4A7C15)


class Codes:
    """Numbers for words, shapes and parts of words. Fixed after training: what was never seen is 0 and makes no feature."""

    def __init__(self) -> None:
        self.of: dict[str, int] = {"^": 1, "$": 2}
        self.grow = True
        self.reset()

    def reset(self) -> None:
        """Forgets the words met, but for what stands beyond a segment's end and before its start."""
        self.words: dict[str, int] = {}
        self.rows: list[tuple] = [(2, 2, 0, 0, 0, 0, 0, "$"), (1, 1, 0, 0, 0, 0, 0, "^")]
        self.matrix = np.empty((0, 6), np.uint64)

    def code(self, x: str) -> int:
        k = self.of.get(x)
        if k is None:
            if not self.grow:
                return 0
            k = self.of[x] = len(self.of) + 1
        return k

    def word(self, w: str) -> int:
        """The row of a new token: (word, shape, four parts, kind, shape text); kind 1 is a number, 2 a sign that a number may begin with, 3 one within it."""
        lo, s = w.lower(), _shape(w)
        if s[0] == "H":
            parts = ("h1=" + lo[0], "h2=" + lo[:2], "e1=" + lo[-1], "e2=" + lo[-2:])
        elif s in ("T", "U", "l"):
            parts = ("t3=" + lo[-3:], "t2=" + lo[-2:], "n=" + str(min(len(lo), 12)))
        else:
            parts = ()
        kind = 1 if s[0] == "d" else 2 if w in "(+" else 3 if w in NUMERIC else 0
        self.words[w] = len(self.rows)
        self.rows.append((self.code(lo), self.code("s=" + s), *(self.code(x) for x in parts), *[0] * (4 - len(parts)), kind, s))
        return len(self.rows) - 1

    def runs(self, seg: str, toks: list[tuple[int, int]], info: list[tuple], base: int, put: tuple[list, ...]) -> None:
        """Numbers of a segment: runs of digits and signs, coded by their shape, with the words around them."""
        n, i = len(toks), 0
        kinds = [x[6] for x in info]
        while i < n:
            k = kinds[i]
            if k == 1 or (k == 2 and i + 1 < n and kinds[i + 1] == 1):
                j = i
                while j + 1 < n and (kinds[j + 1] == 1 or (kinds[j + 1] > 1 and j + 2 < n and (kinds[j + 2] == 1 or (kinds[j + 2] > 1 and j + 3 < n and kinds[j + 3] == 1)))):
                    j += 1
                if j > i or toks[i][1] - toks[i][0] >= 5:
                    text = "".join(("_" if m > i and toks[m - 1][1] < toks[m][0] else "") + (info[m][7] if kinds[m] == 1 else seg[toks[m][0]]) for m in range(i, j + 1))
                    row = (self.code("r=" + text), info[i - 1][0] if i else 1, info[j + 1][0] if j + 1 < n else 2, info[i - 2][0] if i > 1 else 1)
                    for m in range(i, j + 1):
                        put[0].append(base + m)
                        for o, v in zip(put[1:], row, strict=True):
                            o.append(v)
                i = j + 1
            else:
                i += 1

    def read(self, segs: list[tuple[str, list[tuple[int, int]]]]) -> tuple[np.ndarray, ...]:
        """What the features of (segment, tokens) are made of: codes of all tokens, their places, gaps before them, numbers and signs around them."""
        if len(self.words) >= CACHED:
            self.reset()
        edge = [0, 0, 0, 1, 1, 1]
        flat = [*edge]
        at, gap, near_at = [], [], []
        put: tuple[list, ...] = ([], [], [], [], [])
        words, rows = self.words, self.rows
        for seg, toks in segs:
            mine = [words.get(w) or self.word(w) for w in [seg[x:y] for x, y in toks]]
            base = len(flat)
            at.append((base, len(toks)))
            flat += mine
            flat += edge
            if toks:
                gap.append(False)
                gap += [a[1] < b[0] for a, b in pairwise(toks)]
            if "0" in seg:
                self.runs(seg, toks, [rows[i] for i in mine], base, put)
            if "@" in seg or "at" in seg or "AT" in seg:
                signs = [i for i, (x, y) in enumerate(toks) if seg[x] == "@" or (y - x == 2 and i and seg[x:y].lower() == "at" and seg[toks[i - 1][0]] in "([")]
                for i in {i for q in signs for i in range(max(0, q - 6), min(len(toks), q + 9))}:
                    near_at.append((base + i, min((i - q for q in signs[max(0, bisect(signs, i) - 1) : bisect(signs, i) + 1]), key=abs) + 8))
        if len(self.matrix) < len(rows):
            self.matrix = np.concatenate([self.matrix, np.array([x[:6] for x in rows[len(self.matrix) :]], np.uint64)])
        m = self.matrix[np.array(flat)]
        pos = np.concatenate([np.arange(b, b + n) for b, n in at]) if at else np.empty(0, np.int64)
        extra = np.zeros((len(m), 5), np.uint64)
        if put[0]:
            extra[put[0], :4] = np.array(put[1:], np.uint64).T
        if near_at:
            k, v = zip(*near_at, strict=True)
            extra[list(k), 4] = np.array(v, np.uint64) + np.uint64(1)
        return m, pos, np.array(gap, np.uint64), extra

    @staticmethod
    def keys(m: np.ndarray, pos: np.ndarray, g: np.ndarray, extra: np.ndarray) -> np.ndarray:
        """The feature keys of the tokens at some places of read(), 0 where a template has nothing to say."""
        lo, sh = m[:, 0], m[:, 1]
        w = {k: lo[pos + k] for k in range(-3, 4)}
        z = {k: sh[pos + k] for k in range(-2, 3)}
        r, rb, ra, rb2, sign = (extra[pos, i] for i in range(5))
        part = [m[pos, i] for i in range(2, 6)]
        known = lambda *xs: np.logical_and.reduce([x != 0 for x in xs])
        always, runs = np.ones(len(pos), bool), r != 0
        table = [
            ((), always), ((w[0],), known(w[0])), ((z[0],), always), ((w[-1],), known(w[-1])), ((w[-2],), known(w[-2])), ((w[1],), known(w[1])), ((w[2],), known(w[2])),
            ((w[-2], w[-1]), known(w[-2], w[-1])), ((w[1], w[2]), known(w[1], w[2])), ((w[-1], w[0]), known(w[-1], w[0])), ((w[0], w[1]), known(w[0], w[1])), ((w[-3],), known(w[-3])), ((w[3],), known(w[3])),
            ((z[-1], z[0]), always), ((z[0], z[1]), always), ((z[-1], z[0], z[1]), always), ((z[0], g, z[-1]), always), ((w[-3], w[-2], w[-1]), known(w[-3], w[-2], w[-1])), ((z[-2], z[-1], z[0], z[1], z[2]), always),
            *[((x,), x != 0) for x in part], ((r,), runs), ((rb,), rb != 0), ((r, rb), runs & (rb != 0)), ((rb, ra), known(rb, ra)), ((rb2, rb), known(rb2, rb)), ((r, ra), runs & (ra != 0)), ((sign,), sign != 0),
        ]
        out = np.zeros((len(pos), N_TEMPLATES), np.uint64)
        with np.errstate(over="ignore"):
            for i, (xs, on) in enumerate(table):
                key = np.full(len(pos), i + 1, np.uint64)
                for x in xs:
                    key = (key ^ (key >> np.uint64(29))) * ODD + x
                key = (key ^ (key >> np.uint64(32))) * ODD
                out[:, i] = np.where(on, key | np.uint64(1), 0)
        return out


class Index:
    """Feature keys to rows of weights, by open addressing; missing keys go to the last row, which weighs nothing."""

    def __init__(self, keys: np.ndarray) -> None:
        self.n = len(keys)
        bits = max(16, int(np.ceil(np.log2(max(2, len(keys)) * 8))))
        self.shift, size = np.uint64(64 - bits), 1 << bits
        self.keys, self.rows, self.probes = np.zeros(size + 256, np.uint64), np.full(size + 256, self.n, np.int32), 1
        for row, (k, at) in enumerate(zip(keys.tolist(), (keys >> self.shift).astype(np.int64).tolist(), strict=True)):
            step = 0
            while self.keys[at + step] != 0:
                step += 1
            self.keys[at + step], self.rows[at + step] = k, row
            self.probes = max(self.probes, step + 1)

    def find(self, keys: np.ndarray) -> np.ndarray:
        flat = keys.ravel()
        out = np.full(flat.shape, self.n, np.int32)
        todo = np.flatnonzero(flat)
        at = (flat[todo] >> self.shift).astype(np.int64)
        for _ in range(self.probes):
            seen = self.keys[at]
            hit = seen == flat[todo]
            out[todo[hit]] = self.rows[at[hit]]
            go = ~hit & (seen != 0)
            todo, at = todo[go], at[go] + 1
            if not len(todo):
                break
        return out.reshape(keys.shape)


def segments(text: str) -> Iterator[tuple[int, str]]:
    """(offset, segment) of a folded text."""
    at = 0
    for m in SEGMENT.finditer(text):
        if m.start() > at:
            yield at, text[at : m.start()]
        at = m.end()
    if at < len(text):
        yield at, text[at:]


class Field:
    """Weights by feature and label, and of neighbouring labels."""

    def __init__(self, codes: Codes, index: Index, weights: np.ndarray, moves: np.ndarray) -> None:
        self.codes, self.index, self.weights, self.moves = codes, index, weights, moves
        self.seen: dict[str, list[tuple[int, int, str]]] = {}

    def emissions(self, segs: list[tuple[str, list[tuple[int, int]]]]) -> list[np.ndarray]:
        """The weight of each label at each token, by segment. Features are made and summed for TOGETHER tokens at a time."""
        if not segs:
            return []
        m, pos, gap, extra = self.codes.read(segs)
        out = np.empty((len(pos), K), np.float32)
        for a in range(0, len(pos), TOGETHER):
            z = min(len(pos), a + TOGETHER)
            out[a:z] = self._summed(self.index.find(self.codes.keys(m, pos[a:z], gap[a:z], extra)))
        return np.split(out, np.cumsum([len(t) for _, t in segs])[:-1])

    def _summed(self, ids: np.ndarray) -> np.ndarray:
        summed = self.weights[ids[:, 0]].copy()
        for i in range(1, ids.shape[1]):
            summed += self.weights[ids[:, i]]
        return summed

    def decode(self, rows: list[np.ndarray]) -> list[np.ndarray]:
        """Best labels of each segment by its emissions, in batches of segments of like length; each segment whole, however long."""
        out: list[np.ndarray] = [np.empty(0, int)] * len(rows)
        order = [i for i in sorted(range(len(rows)), key=lambda i: len(rows[i])) if len(rows[i])]
        at = 0
        while at < len(order):
            size = max(1, min(512, 60_000 // max(1, len(rows[order[min(at + 511, len(order) - 1)]]))))
            part = order[at : at + size]
            at += size
            for i, b in zip(part, self._viterbi([rows[i] for i in part]), strict=True):
                out[i] = b
        return out

    @staticmethod
    def padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        length = np.array([len(r) for r in rows])
        em = np.zeros((len(rows), length.max(), K), np.float32)
        em[np.arange(length.max())[None, :] < length[:, None]] = np.concatenate(rows)
        return em, length

    def _viterbi(self, rows: list[np.ndarray]) -> list[np.ndarray]:
        em, length = self.padded(rows)
        n, m, k = em.shape
        back = np.empty((m, n, k), np.int8)
        score = em[:, 0] + START
        for t in range(1, m):
            step = score[:, :, None] + self.moves[None]
            best = step.argmax(1)
            alive = (t < length)[:, None]
            back[t] = np.where(alive, best, np.arange(k))  # beyond a row's end the label stays
            score = np.where(alive, np.take_along_axis(step, best[:, None], 1)[:, 0] + em[:, t], score)
            score -= score.max(1, keepdims=True)
        paths = np.empty((n, m), np.int8)
        at, each = score.argmax(1), np.arange(n)
        for t in range(m - 1, 0, -1):
            paths[:, t] = at
            at = back[t, each, at]
        paths[:, 0] = at
        return [paths[i, : length[i]].astype(int) for i in range(n)]


#: Moves that no labelling makes: an inside label follows its own kind.
BARRED = np.zeros((K, K), bool)
for _b in range(K):
    if LABELS[_b][0] == "I":
        for _a in range(K):
            BARRED[_a, _b] = LABELS[_a][2:] != LABELS[_b][2:]
START = np.where([x[0] == "I" for x in LABELS], -1e4, 0.0).astype(np.float32)


def _gold(toks: list[tuple[int, int]], spans: list[tuple[int, int, str]]) -> list[int]:
    out = []
    for a, b in toks:
        hit = next(((s, k) for s, e, k in spans if s <= a and b <= e), None)
        out.append(0 if hit is None else LABELS.index(("B-" if not out or a == hit[0] or not _inside(out[-1], hit[1]) else "I-") + hit[1]))
    return out


def _inside(label: int, kind: str) -> bool:
    return LABELS[label][2:] == kind


def examples(lines) -> list[tuple[str, list[tuple[int, int]], list[int]]]:
    out = []
    for text, spans in lines:
        for off, seg in segments(folded(text)):
            toks = [m.span() for m in TOKEN.finditer(seg)]
            if toks:
                out.append((seg, toks, _gold(toks, [(s - off, e - off, k) for s, e, k in spans])))
    return out


@lru_cache(maxsize=2)
def trained(lines: int = 10000, rounds: int = 6, seed: int = 7, rate: float = 0.25, ridge: float = 2e-6) -> Field:
    """The field trained from `lines` labelled lines. Deterministic."""
    data = examples(pii_table.labelled(lines, seed))
    codes = Codes()
    segs = [(seg, toks) for seg, toks, _ in data]
    keys = codes.keys(*codes.read(segs))
    codes.grow = False
    codes.reset()
    uniq, times = np.unique(keys, return_counts=True)
    index = Index(uniq[(times >= 2) & (uniq != 0)])
    field = Field(codes, index, np.zeros((index.n + 1, K), np.float32), np.where(BARRED, -1e4, 0.0).astype(np.float32))
    rows = np.split(index.find(keys), np.cumsum([len(t) for _, t in segs])[:-1])
    gold = [np.array(g) for _, _, g in data]
    gw, gm = np.full(field.weights.shape, 1e-3, np.float32), np.full((K, K), 1e-3, np.float32)
    order = np.array(sorted(range(len(rows)), key=lambda i: len(rows[i])))
    batches = [order[i : i + 64] for i in range(0, len(order), 64)]
    rng = np.random.default_rng(seed)
    for _ in range(rounds):
        for b in rng.permutation(len(batches)):
            part = batches[b]
            _step(field, [rows[i] for i in part], [gold[i] for i in part], gw, gm, rate, ridge)
    return field


def _step(field: Field, rows, gold, gw, gm, rate: float, ridge: float) -> None:
    """One AdaGrad step on the likelihood of a batch, by the forward-backward algorithm."""
    em, length = field.padded([field._summed(r) for r in rows])
    n, m, _ = em.shape
    alive = np.arange(m)[None, :] < length[:, None]
    move = np.exp(field.moves)
    fwd, bwd, scale = np.zeros((m, n, K)), np.zeros((m, n, K)), np.ones((m, n))
    e = np.exp(em - em.max(2, keepdims=True)).transpose(1, 0, 2)
    a = np.exp(START)[None] * e[0]
    for t in range(m):
        if t:
            a = np.where(alive[:, t, None], (fwd[t - 1] @ move) * e[t], fwd[t - 1])
        s = np.where(alive[:, t], a.sum(1), 1.0) + 1e-300
        fwd[t], scale[t] = a / s[:, None], s
    b = np.ones((n, K))
    for t in range(m - 1, -1, -1):
        bwd[t] = b
        if t:
            b = np.where(alive[:, t, None], ((b * e[t]) @ move.T) / scale[t][:, None], b)
    node = fwd * bwd
    node /= node.sum(2, keepdims=True) + 1e-300
    diff = -node.transpose(1, 0, 2)[alive]
    truth = np.concatenate(gold)
    diff[np.arange(len(truth)), truth] += 1.0
    ids = np.concatenate(rows)
    who = np.repeat(np.arange(len(ids)), ids.shape[1])
    ids = ids.ravel()
    who, ids = who[ids < field.index.n], ids[ids < field.index.n]
    uniq, place = np.unique(ids, return_inverse=True)
    grad = np.stack([np.bincount(place, diff[who, k], len(uniq)) for k in range(K)], 1).astype(np.float32)
    grad = grad / n - ridge * field.weights[uniq]
    gw[uniq] += grad**2
    field.weights[uniq] += rate * grad / np.sqrt(gw[uniq])
    gmove = np.zeros((K, K))
    for t in range(1, m):
        on = alive[:, t]
        if on.any():
            pair = fwd[t - 1][on][:, :, None] * move[None] * (e[t][on] * bwd[t][on])[:, None, :]
            gmove -= (pair / (pair.sum((1, 2), keepdims=True) + 1e-300)).sum(0)
    for g in gold:
        np.add.at(gmove, (g[:-1], g[1:]), 1.0)
    gmove = np.where(BARRED, 0.0, gmove / n).astype(np.float32)
    gm += gmove**2
    field.moves += np.where(BARRED, 0.0, rate * gmove / np.sqrt(gm)).astype(np.float32)


EMAIL_SIGN = re.compile(r"[@＠]|[(\[]\s*at\s*[)\]]|\sat\s", re.I)


def sound(kind: str, text: str) -> bool:
    """The exact check of a find."""
    digits = sum(c.isdigit() for c in text)
    if kind == "email":
        return bool(EMAIL_SIGN.search(text)) and "." in text + "." and len(text) >= 5
    if kind == "phone":
        return 7 <= digits <= 20
    if kind == "id_number":
        return digits >= 6
    if kind == "address":
        return digits >= 1 and len(text) >= 5
    return digits == 0 and len(text) >= 2


def _spans(toks: list[tuple[int, int]], labels: np.ndarray) -> list[tuple[int, int, str]]:
    out: list[list] = []
    for (a, b), k in zip(toks, labels, strict=True):
        tag = LABELS[k]
        if tag[0] == "B" or (tag[0] == "I" and (not out or out[-1][2] != tag[2:])):
            out.append([a, b, tag[2:]])
        elif tag[0] == "I":
            out[-1][1] = b
    return [tuple(x) for x in out]


def finds(field: Field, texts: list[str | None]) -> list[list[tuple[int, int, str]]]:
    """(start, end, kind) in each text."""
    where: list[list[tuple[int, str]]] = [list(segments(folded(t))) if t else [] for t in texts]
    every = list(dict.fromkeys(s for w in where for _, s in w))
    if len(field.seen) + len(every) > CACHED:
        field.seen.clear()
    new = [(s, [m.span() for m in TOKEN.finditer(s)]) for s in every if s not in field.seen]
    for (s, toks), best in zip(new, field.decode(field.emissions(new)), strict=True):
        field.seen[s] = _spans(toks, best)
    out = []
    for t, w in zip(texts, where, strict=True):
        out.append([(off + a, off + b, k) for off, s in w for a, b, k in field.seen[s] if sound(k, t[off + a : off + b])])
    return out


def _chunks(b: pd.DataFrame, size: int = 400) -> Iterator[pd.DataFrame]:
    for at in range(0, len(b), size):
        yield b.iloc[at : at + size]


def found(df: DataFrame, key: str = "doc_id", text: str = "text", field: Field | None = None) -> DataFrame:
    """key, pii_type: the types that each text holds. Only these rows are shuffled."""
    model = df.sparkSession.sparkContext.broadcast(_bare(field or trained()))  # size bound: the features of the labelled table

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        f = _worker(model)
        for whole in batches:
            for b in _chunks(whole):
                rows = [(i, k) for i, got in zip(b["key"], finds(f, b["text"].tolist()), strict=True) for k in dict.fromkeys(k for _, _, k in got)]
                yield pd.DataFrame(rows, columns=["key", "pii_type"])

    two = df.select(F.col(key).alias("key"), F.col(text).alias("text")).where(F.col("key").isNotNull() & F.col("text").isNotNull())
    kind = two.schema["key"].dataType.simpleString()
    return spread(two).mapInPandas(run, f"key {kind}, pii_type string").distinct().withColumnRenamed("key", key)


def _bare(field: Field) -> tuple:
    return field.codes, field.index, field.weights, field.moves


_LOADED: dict = {}


def _worker(model) -> Field:
    """The field of this worker, with what it has decoded so far; kept while the worker lives."""
    key = getattr(model, "_path", None) or id(model)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Field(*model.value)
    return _LOADED[key]


def replaced(text: str | None, got: list[tuple[int, int, str]]) -> str | None:
    if not text or not got:
        return text
    out, at = [], 0
    for a, b, k in got:
        out += [text[at:a], f"[{k.upper()}]"]
        at = b
    return "".join(out) + text[at:]


def masked(df: DataFrame, key: str = "doc_id", text: str = "text", field: Field | None = None) -> DataFrame:
    """key, masked text, number of finds: one row per row, without a shuffle."""
    model = df.sparkSession.sparkContext.broadcast(_bare(field or trained()))  # size bound: the features of the labelled table

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        f = _worker(model)
        for whole in batches:
            for b in _chunks(whole):
                texts = [t if isinstance(t, str) else None for t in b["text"]]
                got = finds(f, texts)
                yield pd.DataFrame({"key": b["key"], "masked": [replaced(t, g) for t, g in zip(texts, got, strict=True)], "n_found": [len(g) for g in got]}).astype({"n_found": "int32"})

    two = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = two.schema["key"].dataType.simpleString()
    return spread(two).mapInPandas(run, f"key {kind}, masked string, n_found int").withColumnRenamed("key", key)
