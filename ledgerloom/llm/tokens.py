"""Byte-pair encoding by a table over prefixes.

For every prefix of a piece of text exactly one token can stand last in the prefix's encoding. The
table keeps that token for each prefix: token t from i to j is the last one of prefix j when the
pair (last token of prefix i, t) is one that merging would have left apart. One pass fills the
table; following it back from the end gives the encoding. Appending bytes only adds to the table,
and an edit re-encodes the pieces it touches until the piece borders fall together again.

Vocabulary files are read where they lie; their path is a parameter. Words that look like special
tokens are ordinary text. Null and empty texts have no ids (an empty list).
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerloom.session import spread

#: Bounds of what a worker remembers: a cache, which changes no result.
CACHED_PIECES, CACHED_PIECE_BYTES, CACHED_PAIRS = 200_000, 96, 1_000_000


def default_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Vocabulary:
    """Ranks of a byte-level vocabulary and what the prefix table needs of them."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        import regex

        self.ranks = ranks
        self.pieces = regex.compile(pattern).findall
        self.pattern = regex.compile(pattern)
        self.bytes_of = {r: b for b, r in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        #: Every token, and every start of one that is none itself, as -1.
        self.starts: dict[bytes, int] = {}
        for b in ranks:
            for k in range(1, len(b)):
                self.starts.setdefault(b[:k], -1)
        self.starts.update(ranks)
        #: The two tokens whose merge gives a token; a single byte stands for itself.
        self.parts = {r: self._halves(b, r) for b, r in ranks.items()}
        self.apart: dict[int, bool] = {}
        self.seen: dict[str, array] = {}

    def _halves(self, b: bytes, rank: int) -> tuple[int, int]:
        got = self.merged(b, rank)
        return (got[0], got[1]) if len(got) == 2 else (rank, rank)

    def merged(self, b: bytes, below: int | None = None) -> list[int]:
        """The encoding by merging the lowest rank first; ranks from `below` on don't count."""
        part = [b[i : i + 1] for i in range(len(b))]
        while len(part) > 1:
            best, at = None, -1
            for i in range(len(part) - 1):
                r = self.ranks.get(part[i] + part[i + 1])
                if r is not None and (below is None or r < below) and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            part[at : at + 2] = [part[at] + part[at + 1]]
        return [self.ranks[x] for x in part]

    def stay_apart(self, left: int, right: int) -> bool:
        """Whether merging would leave two neighbouring tokens as they are. Undoes the youngest merge first."""
        key = left << 20 | right
        known = self.apart.get(key)
        if known is not None:
            return known
        ranks, name, parts = self.ranks, self.bytes_of, self.parts
        a, b, limit, ok = left, right, 1 << 30, None
        while ok is None:
            joined = ranks.get(name[a] + name[b])
            if joined is not None and joined < limit:
                ok = False
            elif a > b:
                limit, (_, inner) = a, parts[a]
                if inner == a:
                    limit, (inner_b, _) = b + 1, parts[b]
                    ok = True if inner_b == b else None
                    b = inner_b
                else:
                    a = inner
            else:
                limit, (inner, _) = b + 1, parts[b]
                if inner == b:
                    limit, (_, inner_a) = a, parts[a]
                    ok = True if inner_a == a else None
                    a = inner_a
                else:
                    b = inner
        if len(self.apart) >= CACHED_PAIRS:
            self.apart.clear()
        self.apart[key] = ok
        return ok

    def extend(self, data: bytes, last: list[int], start: int) -> None:
        """Fills last[i] of prefixes i beyond `start`, given those up to it. Rests on tokens that begin at any known prefix."""
        starts, apart, stay, n = self.starts, self.apart, self.stay_apart, len(data)
        for i in range(max(0, start - self.longest), n):
            before = last[i]
            if before == -2:
                continue
            j = i + 1
            while j <= n:
                t = starts.get(data[i:j])
                if t is None:
                    break
                if t >= 0 and j > start and last[j] == -2:
                    ok = True if before == -1 else apart.get(before << 20 | t)
                    if ok or (ok is None and stay(before, t)):
                        last[j] = t
                j += 1

    def of_table(self, data: bytes, last: list[int]) -> array:
        out, i = array("i"), len(data)
        if last[i] == -2:
            return array("i", self.merged(data))
        while i:
            t = last[i]
            out.append(t)
            i -= len(self.bytes_of[t])
        out.reverse()
        return out

    def encode_piece(self, piece: str) -> array:
        data = piece.encode("utf-8", "replace")
        whole = self.ranks.get(data)
        if whole is not None:
            return array("i", (whole,))
        last = [-2] * (len(data) + 1)
        last[0] = -1
        self.extend(data, last, 0)
        return self.of_table(data, last)

    def encode(self, text: str | None) -> array:
        out = array("i")
        if not text:
            return out
        seen = self.seen
        for piece in self.pieces(text):
            ids = seen.get(piece)
            if ids is None:
                ids = self.encode_piece(piece)
                if len(piece) <= CACHED_PIECE_BYTES:
                    if len(seen) >= CACHED_PIECES:
                        seen.clear()
                    seen[piece] = ids
            out.extend(ids)
        return out

    def decode(self, ids) -> str:
        return b"".join(self.bytes_of[int(i)] for i in ids).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def vocabulary(path: str, pattern: str | None = None) -> Vocabulary:
    if pattern is None:
        import public_tokenizers

        pattern = public_tokenizers.PATTERN
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return Vocabulary(ranks, pattern)


class PrefixTable:
    """The table of one piece, open at its end."""

    def __init__(self, vocab: Vocabulary, data: bytes = b"") -> None:
        self.vocab, self.data, self.last = vocab, b"", [-1]
        self.append(data)

    def append(self, data: bytes) -> None:
        start = len(self.data)
        self.data += data
        self.last += [-2] * len(data)
        self.vocab.extend(self.data, self.last, start)

    def ids(self, end: int | None = None) -> list[int]:
        """The encoding of the first `end` bytes: any prefix can be read off."""
        data = self.data if end is None else self.data[:end]
        return list(self.vocab.of_table(data, self.last[: len(data) + 1])) if data else []


class EncodedText:
    """A text with its pieces and their ids, which can be edited in place."""

    def __init__(self, vocab: Vocabulary, text: str) -> None:
        self.vocab, self.text = vocab, text
        self.spans = [m.span() for m in vocab.pattern.finditer(text)]
        self.ids_of = [vocab.encode_piece(text[a:b]) for a, b in self.spans]
        self.encoded = len(self.spans)

    def edit(self, start: int, end: int, new: str) -> None:
        """Puts `new` in place of text[start:end]; encodes only from the first piece that can change to where borders agree again."""
        text = self.text[:start] + new + self.text[end:]
        keep = next((k for k, (_, b) in enumerate(self.spans) if b >= start - 1), len(self.spans))  # a run of blanks looks one character past its end
        at = self.spans[keep][0] if keep < len(self.spans) else (self.spans[-1][1] if self.spans else 0)
        shift, after = len(new) - (end - start), start + len(new)
        old = {a + shift: k for k, (a, _) in enumerate(self.spans) if a >= end}
        spans, ids, rest = [], [], len(self.spans)
        for m in self.vocab.pattern.finditer(text, at):
            a, b = m.span()
            if a >= after and a in old:
                rest = old[a]
                break
            spans.append((a, b))
            ids.append(self.vocab.encode_piece(m.group()))
        self.encoded += len(spans)
        self.spans = self.spans[:keep] + spans + [(a + shift, b + shift) for a, b in self.spans[rest:]]
        self.ids_of = self.ids_of[:keep] + ids + self.ids_of[rest:]
        self.text = text

    def ids(self) -> list[int]:
        return [i for piece in self.ids_of for i in piece]


def _encoder(path: str, key_type: pa.DataType, counts: bool, chunk: int = 256):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            for at in range(0, batch.num_rows, chunk):
                part = batch.slice(at, chunk)
                ids = [vocab.encode(t) for t in part.column(1).to_pylist()]
                sizes = np.fromiter((len(x) for x in ids), np.int64, len(ids))
                if counts:
                    out = pa.array(sizes)
                else:
                    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                    flat = np.concatenate([np.frombuffer(x, np.int32) if x else np.empty(0, np.int32) for x in ids]) if ids else np.empty(0, np.int32)
                    out = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column(0), out], names=["key", "n_tokens" if counts else "ids"])

    return run


def _mapped(df: DataFrame, text: str, key: str, path: str | None, counts: bool) -> DataFrame:
    two = df.select(df[key].alias("key"), df[text].alias("text"))
    kind = two.schema["key"].dataType.simpleString()
    out = spread(two).mapInArrow(_encoder(path or default_path(), None, counts), f"key {kind}, " + ("n_tokens bigint" if counts else "ids array<int>"))
    return out.withColumnRenamed("key", key)


def token_ids(df: DataFrame, text: str = "text", key: str = "doc_id", path: str | None = None) -> DataFrame:
    """key, ids: one row per input row, without a shuffle. Other columns are ignored."""
    return _mapped(df, text, key, path, False)


def token_counts(df: DataFrame, text: str = "text", key: str = "doc_id", path: str | None = None) -> DataFrame:
    """key, n_tokens: one row per input row, without a shuffle."""
    return _mapped(df, text, key, path, True)
