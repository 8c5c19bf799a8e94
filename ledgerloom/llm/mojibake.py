"""Text decoded with the wrong encoding: expectation-maximization over latent encoding chains.

A body is cut into its segments (texts between tags and line ends, attribute values, comments; a run
of windows-1252 among other characters is one of its own). Each segment hides a chain: none,
or one of CHAINS (what the bytes were, what they were taken for), or `lost`, a chain that kept too
little to be named. The likelihood of a chain is that of the text it leads back to, under a
character model whose syllable frequencies come from the corpus itself. Short segments say little
on their own, so the chains' shares are estimated per source (class and encoding named in the first
line) and field (kind of element) over all records, and each segment is judged, and where a chain is
named repaired, by its posterior.

The expectation step runs over segments grouped by their evidence (in tenths, below the best chain's); only the table of shares
(sources x fields x chains, whose sizes are fixed) comes to the driver.

Defined results: null, empty and plain ASCII bodies are in order. Characters that a chain lost stay
U+FFFD in the repaired text; a segment judged `lost` stays as it is, with restored = false. Rows
that come twice count once; a receipt with several bodies is a finding if one of them is.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import cut, spread

SEGMENT = re.compile(r"<(/?)([A-Za-z][\w:.-]*)([^<>]*)>|<!--([^<>]*)-->|<[?!][^<>]*>|([^<>\n]+)")
VALUE = re.compile(r"\"([^\"]*)\"|'([^']*)'|=([^\s\"'<>]+)")
NAMED = re.compile(r"<\?xml[^>]*encoding\s*=\s*[\"']([\w-]+)", re.I)
FIELDS = {"TITLE": "title", "P": "text", "SPAN": "text", "TD": "cell", "TH": "cell", "TE": "cell", "TU": "cell"}

#: name, the steps back: encode the text as the first, decode the bytes as the second, and again.
CHAINS: tuple[tuple[str, tuple[tuple[str, str], ...]], ...] = (
    ("cp949 as latin", (("latin", "cp949"),)),
    ("utf-8 as latin", (("latin", "utf-8"),)),
    ("utf-8 as latin twice", (("latin", "utf-8"), ("latin", "utf-8"))),
    ("cp949 as gbk", (("gbk", "cp949"),)),
    ("utf-8 as cp949", (("cp949", "utf-8"),)),
    ("cp949 as shift_jis", (("cp932", "cp949"),)),
    ("cp949 as big5", (("big5", "cp949"),)),
    ("utf-8 as gbk", (("gbk", "utf-8"),)),
    ("utf-8 as shift_jis", (("cp932", "utf-8"),)),
)
NAMES = ("none", *[n for n, _ in CHAINS], "lost")
#: Windows-1252 characters back to their bytes; what it doesn't define passes as Latin-1.
LATIN = {ord(bytes([b]).decode("cp1252")): b for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)}
#: Characters that are no byte of windows-1252; runs of those that are; syllables that are no accented capitals within a Latin word.
_BYTES = r"\x00-\xff\ufffd" + "".join(map(chr, LATIN))
OTHER, RUN, SYLLABLES = re.compile(f"[^{_BYTES}]"), re.compile(f"[{_BYTES}]+"), re.compile("[가-힣]{2}|(?<![A-Za-z])[가-힣](?![A-Za-z])")
IMPOSSIBLE = -1e9
LOST_MARK = "�"


def _to_bytes(text: str, encoding: str) -> bytes:
    if encoding == "latin":
        return text.translate(LATIN).encode("latin-1")
    return text.encode(encoding)


def back(text: str, steps) -> tuple[str, int] | None:
    """The text a chain started from and its characters broken without a lost one beside them; None where it has a character that the chain can't lead to.

    Lost characters stay lost; each may break the ones beside it.
    """
    broken = 0
    for taken, was in steps:
        if taken == "latin" and OTHER.search(text):
            return None
        gone = text.count(LOST_MARK)
        try:
            raw = b"\xff".join(_to_bytes(p, taken) for p in text.split(LOST_MARK)) if gone else _to_bytes(text, taken)
        except UnicodeEncodeError:
            return None
        text = raw.decode(was, "replace")
        broken += max(0, text.count(LOST_MARK) - 3 * gone)
    return text, broken


#: Log-weights of characters by range, later ranges over earlier ones.
WEIGHTS = (
    (0x0000, 0x110000, -13.5), (0x0000, 0x0020, -14.0), (0x0009, 0x000B, -4.0), (0x000D, 0x000E, -4.0), (0x0020, 0x0080, -4.0), (0x0080, 0x00A0, -22.0), (0x00A0, 0x0100, -9.5), (0x1100, 0x1200, -22.0),
    (0x2010, 0x2028, -9.0), (0x20A9, 0x20AA, -9.0), (0x20AC, 0x20AD, -9.0), (0x203B, 0x203C, -9.0), (0x25B2, 0x25B4, -9.0), (0x3000, 0x3001, -9.0), (0x00B7, 0x00B8, -9.0), (0x3040, 0x3100, -10.0),
    (0x3130, 0x3190, -12.0), (0x4E00, 0xA000, -12.5), (0xE000, 0xF900, -22.0), (0xFF61, 0xFFA0, -11.5), (0xFFFD, 0xFFFE, -30.0), (0xF0000, 0x110000, -22.0),
)
#: The same of a text that kept too little: broken characters are at home, the rest comes from anywhere.
LOST_WEIGHTS = ((0x0000, 0x110000, -14.0), (0x0000, 0x0080, -4.5), (0x0080, 0x00A0, -8.0), (0xE000, 0xF900, -8.0), (0xF0000, 0x110000, -8.0), (0xFFFD, 0xFFFE, -2.0))
#: What a character costs that a chain broke beside a lost one, and one that it broke by itself.
GONE, BROKEN = -8.0, -30.0
#: Evidence is kept in tenths, and so far below the best chain's (e^-60 is no share of a posterior).
TENTHS, LEAST = 10, -600


def _weights(ranges) -> np.ndarray:
    out = np.empty(0x110000)
    for a, z, w in ranges:
        out[a:z] = w
    return out


class Model:
    """Log-probability of characters: classes with fixed weights, syllables by their frequency in the corpus."""

    def __init__(self, syllables: dict[str, int]) -> None:
        total = sum(syllables.values()) + 11172
        self.rare = math.log(0.5 / total)
        self.syllable = {c: math.log(0.5 * (n + 1.0) / total) for c, n in syllables.items()}
        self.tables: tuple[np.ndarray, np.ndarray] | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"tables": None}

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log-likelihood of each text, as text and as one that kept too little. All characters are weighed in one lookup."""
        if self.tables is None:
            known = _weights(WEIGHTS)
            known[0xAC00:0xD7A4] = self.rare
            known[[ord(c) for c in self.syllable]] = list(self.syllable.values())
            self.tables = known, _weights(LOST_WEIGHTS)
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        ends = np.cumsum(size)
        sums = [np.concatenate(([0.0], np.cumsum(t[codes]))) for t in self.tables]
        return tuple(x[ends] - x[ends - size] for x in sums)

    def evidence(self, texts: list[str]) -> np.ndarray:
        """Log-likelihood of each text by chain, in the order of NAMES, in tenths below that of the best."""
        once = list(dict.fromkeys(texts))
        none, lost = self.scores(once)
        ev = np.full((len(once), len(NAMES)), IMPOSSIBLE)
        ev[:, 0], ev[:, -1] = none, lost
        for k, (_, steps) in enumerate(CHAINS, 1):
            was = [(i, *b) for i, t in enumerate(once) if (b := back(t, steps)) is not None and b[0] != t]
            if was:
                at, found, broken = zip(*was, strict=True)
                broken = np.array(broken)
                gone = np.array([x.count(LOST_MARK) for x in found])
                kept, _ = self.scores([x.replace(LOST_MARK, "") for x in found])
                ev[list(at), k] = kept + GONE * (gone - broken) + BROKEN * broken
        ev = np.maximum(np.round((ev - ev.max(1, keepdims=True)) * TENTHS), LEAST).astype(np.int32)
        place = {t: i for i, t in enumerate(once)}
        return ev[[place[t] for t in texts]]


def _cut(text: str, start: int) -> Iterator[tuple[int, int]]:
    """(start, end) of the parts of a segment that hide one chain each.

    Other characters make the latin chains impossible for the whole segment, so a run of latin ones
    beside them is a part of its own where one of these chains leads back to syllables and loses none.
    """
    if not OTHER.search(text):
        yield start, start + len(text)
        return
    at = 0
    for m in RUN.finditer(text):
        if m.group().isascii():
            continue
        ways = (back(m.group(), steps) for _, steps in CHAINS if steps[0][0] == "latin")
        if any(w is not None and not w[1] and SYLLABLES.search(w[0]) for w in ways):
            if not text[at : m.start()].isascii():
                yield start + at, start + m.start()
            yield start + m.start(), start + m.end()
            at = m.end()
    if not text[at:].isascii():
        yield start + at, start + len(text)


def segments(body: str) -> Iterator[tuple[str, int, int]]:
    """(field, start, end) of each part of text, attribute values and comments that isn't plain ASCII."""
    field = "other"
    for m in SEGMENT.finditer(body):
        if m.group(2):
            field = "other" if m.group(1) else FIELDS.get(m.group(2).upper(), "other")
            where = [("other", v.start(g), v.end(g)) for v in VALUE.finditer(body, m.start(3), m.end(3)) for g in (1, 2, 3) if v.group(g)] if not m.group(3).isascii() else []
        elif m.group(4):
            where = [("other", m.start(4), m.end(4))]
        else:
            where = [(field, m.start(5), m.end(5))] if m.group(5) else []
        for f, a, z in where:
            if not body[a:z].isascii():
                yield from ((f, x, y) for x, y in _cut(body[a:z], a))


def source_of(body: str, cls: str | None) -> str:
    named = NAMED.match(body)
    kind = named.group(1).lower() if named else ""
    return f"{cls if cls in ('Y', 'K', 'N', 'E') else '-'}/{kind if kind in ('utf-8', 'euc-kr', 'cp949') else '-' if not kind else 'other'}"


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        codes = np.frombuffer("".join(b["body"]).encode("utf-32-le", "surrogatepass"), np.uint32)
        n = np.bincount(codes[(codes >= 0xAC00) & (codes <= 0xD7A3)] - 0xAC00, minlength=1)
        yield pd.DataFrame({"c": [chr(0xAC00 + i) for i in np.flatnonzero(n)], "n": n[n > 0].astype("int64")})


def syllable_counts(bodies: DataFrame) -> dict[str, int]:
    """How often each syllable stands in the corpus: at most 11,172 rows."""
    got = bodies.select("body").mapInPandas(_count, "c string, n bigint").groupBy("c").agg(F.sum("n").alias("n"))
    return {r["c"]: r["n"] for r in got.collect()}


def _parts(bodies: pd.Series, classes: pd.Series, model: Model, size: int = 500_000) -> Iterator[list[tuple[int, str, list, np.ndarray]]]:
    """(place, source, segments, evidence of each) of the bodies, weighed together up to so many characters; a longer body alone, and whole."""
    some: list[tuple[int, str, list]] = []
    texts: list[str] = []
    chars = 0

    def weighed() -> list:
        ev, at, out = model.evidence(texts) if texts else np.empty((0, len(NAMES)), np.int32), 0, []
        for i, source, segs in some:
            out.append((i, source, segs, ev[at : at + len(segs)]))
            at += len(segs)
        return out

    for i, (body, cls) in enumerate(zip(bodies, classes, strict=True)):
        if some and chars + len(body) > size:
            yield weighed()
            some, texts, chars = [], [], 0
        segs = list(segments(body))
        some.append((i, source_of(body, cls), segs))
        texts += [body[a:z] for _, a, z in segs]
        chars += len(body)
    if some:
        yield weighed()


def _weigher(model: Model):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            keys, digests = b["key"].tolist(), b["digest"].tolist()
            for part in _parts(b["body"], b["cls"], model):
                rows = [(keys[i], digests[i], source, [{"field": f, "ev": e.tolist()} for (f, _, _), e in zip(segs, ev, strict=True)]) for i, source, segs, ev in part]
                yield pd.DataFrame(rows, columns=["key", "digest", "source", "segments"])

    return run


def _posterior(prior: str = "prior", ev: str = "ev"):
    weight = F.zip_with(prior, ev, lambda p, e: p * F.exp(e / F.lit(float(TENTHS))))
    total = F.aggregate(weight, F.lit(0.0), lambda t, w: t + w)
    return F.transform(weight, lambda w: w / total)


def _priors_frame(spark: SparkSession, priors: dict[tuple[str, str], list[float]]) -> DataFrame:
    return spark.createDataFrame([(s, f, p) for (s, f), p in priors.items()] or [("", "", [1.0])], "source string, field string, prior array<double>")


def estimate(evidence: DataFrame, rounds: int = 6) -> dict[tuple[str, str], list[float]]:
    """Shares of the chains by source and field."""
    spark = evidence.sparkSession
    grouped = cut(evidence.groupBy("source", "field", "ev").agg(F.count("*").alias("n")))
    keys = [(r["source"], r["field"]) for r in grouped.select("source", "field").distinct().collect()]
    start = [0.9, *[0.1 / (len(NAMES) - 1)] * (len(NAMES) - 1)]
    priors = dict.fromkeys(keys, start)
    for _ in range(rounds):
        post = grouped.join(F.broadcast(_priors_frame(spark, priors)), ["source", "field"]).select("source", "field", "n", _posterior().alias("post"))
        sums = post.groupBy("source", "field").agg(*[F.sum(F.col("n") * F.col("post")[i]).alias(f"s{i}") for i in range(len(NAMES))]).collect()
        # All segments of the corpus together are the prior of each cell: few segments lean on the many.
        whole = [sum(r[f"s{i}"] for r in sums) for i in range(len(NAMES))]
        z = sum(whole) or 1.0
        priors = {
            (r["source"], r["field"]): _normal([r[f"s{i}"] + 20.0 * (whole[i] + 0.1) / (z + 0.1 * len(NAMES)) for i in range(len(NAMES))]) for r in sums
        }
    return priors


def _normal(x: list[float]) -> list[float]:
    z = sum(x)
    return [v / z for v in x]


def _bodies(df: DataFrame, key: str, body: str, cls: str) -> DataFrame:
    rows = df.select(F.col(key).alias("key"), F.col(cls).alias("cls"), F.col(body).alias("body"))
    return rows.where(F.col("key").isNotNull() & F.col("body").isNotNull() & F.col("body").rlike(r"[^\x00-\x7F]"))


def judged(df: DataFrame, key: str = "rcept_no", body: str = "body", cls: str = "corp_cls"):
    """(model, shares, judged segments): key, chain and posterior of each segment that isn't plain ASCII. No body is shuffled."""
    rows = spread(_bodies(df, key, body, cls))
    model = Model(syllable_counts(rows))
    weighed = rows.withColumn("digest", F.md5("body")).mapInPandas(_weigher(model), "key string, digest string, source string, segments array<struct<field:string,ev:array<int>>>")
    evidence = cut(weighed.dropDuplicates(["key", "digest"]).select("key", "source", F.inline("segments")))
    priors = estimate(evidence)
    post = evidence.join(F.broadcast(_priors_frame(df.sparkSession, priors)), ["source", "field"]).withColumn("post", _posterior())
    best = F.array_position("post", F.array_max("post")) - 1
    return model, priors, post.select("key", "field", F.element_at(F.array(*map(F.lit, NAMES)), (best + 1).cast("int")).alias("chain"), (1 - F.col("post")[0]).alias("garbled"))


def found(df: DataFrame, key: str = "rcept_no") -> DataFrame:
    """Keys of records with a segment more likely garbled than not."""
    return judged(df, key)[2].where("garbled > 0.5").select(F.col("key").alias(key)).distinct()


def _repairer(model: Model, priors: dict):
    logs = {k: np.log(np.maximum(v, 1e-12)) for k, v in priors.items()}
    flat = np.log([0.9, *[0.1 / (len(NAMES) - 1)] * (len(NAMES) - 1)])
    steps = dict(CHAINS)

    def repaired(body: str, source: str, segs: list, ev: np.ndarray) -> tuple[str, int, int, str]:
        out, at, bad, kept, chains = [], 0, 0, 0, Counter()
        for (field, a, z), e in zip(segs, ev, strict=True):
            best = int(np.argmax(logs.get((source, field), flat) + e / TENTHS))
            if best == 0:
                continue
            bad += 1
            chains[NAMES[best]] += 1
            if NAMES[best] != "lost":
                new, _ = back(body[a:z], steps[NAMES[best]])
                kept += LOST_MARK not in new
                out += [body[at:a], new]
                at = z
        return "".join(out) + body[at:], bad, kept, chains.most_common(1)[0][0] if chains else "none"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            keys, bodies = b["key"].tolist(), b["body"].tolist()
            for part in _parts(b["body"], b["cls"], model):
                rows = [(keys[i], *repaired(bodies[i], source, segs, ev)) for i, source, segs, ev in part]
                yield pd.DataFrame(rows, columns=["key", "body", "garbled_segments", "restored_segments", "chain"]).query("garbled_segments > 0")

    return run


def repair(df: DataFrame, key: str = "rcept_no", body: str = "body", cls: str = "corp_cls") -> DataFrame:
    """key, repaired body, number of garbled and of wholly restored segments, and the main chain, of affected records."""
    model, priors, _ = judged(df, key, body, cls)
    rows = spread(_bodies(df, key, body, cls))
    out = rows.mapInPandas(_repairer(model, priors), "key string, body string, garbled_segments int, restored_segments int, chain string").distinct()
    return out.withColumn("restored", F.col("restored_segments") == F.col("garbled_segments")).withColumnRenamed("key", key)
