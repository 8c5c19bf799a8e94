"""Share of repeated content inside one document, as one projection compiled from a threshold table.

Every figure is over the document's own text: no shuffle, no cap on its length. A document is cut
into units (paragraphs, lines, table rows, sentences); a unit of MIN_UNIT or more characters that
stood in the document before is repeated, and so is all but the first of a phrase that runs on back
to back, whatever line breaks and sentence ends stand in it.
Letter case, spacing and list marks in front are taken away before units are held against each
other; figures and words are not. A character that is repeated in both ways counts once.

Figures are built-in expressions but for the characters that stand in repeats, which are marked in
Arrow batches: no regular expression finds runs of every period from every character in less than
quadratic time. A short period is found by holding the text against itself shifted by it; a longer
one p from k-grams, k being the power of two from p on: inside a run the last place of the same
k-gram is exactly p characters back. Both are exact, in O(n log n) for each power of two.

Defined results: null text gives null figures and no violated rule; empty and blank text give 0
repeated characters, share 0. Rows that come twice give the same figures twice; callers drop them by id.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, pairwise

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MIN_UNIT = 12
BLANK = "[ \\t\\u000b\\f\\u00a0\\u1680\\u2000-\\u200b\\u202f\\u205f\\u2060\\u3000\\ufeff]"
#: A list mark, quote mark, heading mark or number in front of a line.
MARK = rf"(?m)^(?:{BLANK}|[-*+>•・◦▪‣–—]+(?={BLANK})|#+(?={BLANK})|[(（\[【]?[0-9０-９]{{1,3}}[)）\]】.、．](?![0-9０-９])|[(（]?[a-zA-Z][)）]|[①-⑳])+"
#: One pass over the characters takes blanks and carriage returns out and capitals down.
CAPITALS = "".join(c for c in map(chr, [*range(0x41, 0x5B), *range(0xC0, 0xDF), *range(0x391, 0x3AA), *range(0x410, 0x430), *range(0xFF21, 0xFF3B)]) if len(c.lower()) == 1 and c.lower() != c)
BLANKS = "\x01\r \t\u000b\f  " + "".join(map(chr, range(0x2000, 0x200C))) + "  ⁠　﻿"
#: Units end at line breaks and after sentences; a sentence's end within a line is written as CUT.
CUT = "\x01"
SENTENCE_END = r"(?<=[。！？｡])(?!\n)|(?<=[.!?])(?![0-9\n])"
#: From which length of a phrase on how many times back to back are many. A phrase of one character is one of two equal ones.
MANY = ((12, 3), (6, 5), (2, 7), (1, 14))
#: Periods that are found by shifting the text; longer ones take k-grams.
SHIFTS = 32
#: Texts are worked on together up to so many characters; a longer one is worked on alone, and whole.
TOGETHER = 1_000_000

#: Frequent function words of the languages met.
STOP_WORDS = (
    "the of and to in a for by was were is at on with from this that as an or it be "
    "le la les de des du et en un une à au aux pour par sur est dans que qui "
    "o os da do das dos e em um uma para por com no na que se ao "
    "der die das und in zu den von mit ist für auf ein eine"
).split()

#: metric, comparison, threshold, name of the rule. A document that violates `repeated` is a finding.
THRESHOLDS = (
    ("repeat_share", ">=", 0.20, "repeated"),
    ("line_share", ">=", 0.30, "repeated_lines"),
    ("run_share", ">=", 0.20, "running_phrase"),
    ("symbol_ratio", ">", 0.50, "symbols"),
    ("short_line_ratio", ">", 0.95, "fragments"),
    ("stop_word_ratio", ">", 0.70, "stop_words"),
    ("max_line_chars", ">", 100_000.0, "overlong_line"),
)


def _many(period: int) -> int:
    return next(n for least, n in MANY if period >= least)


def _stretches(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of True."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], at, [False])).view(np.int8)))
    return edges[::2], edges[1::2]


def _short_runs(codes: np.ndarray) -> Iterator[tuple[int, int, int]]:
    for p in range(1, min(SHIFTS, len(codes) - 1) + 1):
        least, width = (_many(p) - 1) * p, 1
        same = codes[p:] == codes[:-p]
        while 2 * width <= min(least, 16) and len(same) > width:
            same, width = same[:-width] & same[width:], 2 * width
        if same.any():
            for a, b in zip(*_stretches(same), strict=True):
                if b - a + width - 1 >= least:
                    yield int(a), int(b) + width - 1 + p, p


def _long_runs(codes: np.ndarray, owner: np.ndarray, longest: int) -> Iterator[tuple[int, int, int]]:
    def paired(h: np.ndarray, k: int) -> np.ndarray:
        h = h[:-k] * np.uint64(0x9E3779B97F4A7C15) + h[k:]
        return (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)

    h, k = codes.astype(np.uint64) * np.uint64(0x94D049BB133111EB), 1
    while k < SHIFTS and len(h) > k:
        h, k = paired(h, k), 2 * k
    if k < SHIFTS or longest < 3 * SHIFTS:
        return
    h = h ^ (owner[: len(h)].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    at = np.arange(len(h))
    while len(at):
        order = np.argsort(h[at], kind="stable")
        by, seen = at[order], h[at][order]
        twin = seen[1:] == seen[:-1]
        if k > SHIFTS:
            back = by[1:] - by[:-1]
            near = twin & (back <= k) & (back > k // 2)
            i, d = by[1:][near], back[near]
            order = np.argsort(i)
            i, d = i[order], d[order]
            new = np.flatnonzero((np.diff(i) != 1) | (np.diff(d) != 0)) + 1
            for first, last in pairwise([0, *new, len(i)] if len(i) else []):
                p = int(d[first])
                a, b = int(i[first]) - p, int(i[last - 1]) + k
                if b - a >= _many(p) * p and np.array_equal(codes[a + p : b], codes[a : b - p]):
                    yield a, b, p
        # A k-gram that stands once is part of no longer one that stands twice.
        at = np.sort(by[np.concatenate((twin, [False])) | np.concatenate(([False], twin))])
        if 3 * k > 2 * longest or len(h) <= k:
            return
        h, k = paired(h, k), 2 * k
        at = at[at < len(h)]


def _repeated_units(text: str) -> Iterator[tuple[int, int]]:
    """Start and end, breaks not counted, of the paragraphs, lines and sentences that stood before.

    A short sentence or line counts also together with the one before it.
    """
    seen: set = set()

    def stood(unit: str | tuple[str, str]) -> bool:
        if unit in seen:
            return True
        seen.add(unit)
        return False

    at = 0
    for paragraph in text.split("\n\n"):
        first, before, fresh = at, "", []
        for line in paragraph.split("\n"):
            start = at
            for u in line.split(CUT):
                if len(u) >= MIN_UNIT:
                    if stood(u):
                        yield at, at + len(u)
                elif u and len(u) + len(before) >= MIN_UNIT and stood((before, u)):
                    yield at, at + len(u)
                at, before = at + len(u), u
            whole = line.replace(CUT, "")
            if whole:
                fresh.append(whole)
            # One of a single sentence was asked already.
            if CUT in line.strip(CUT) and len(whole) >= MIN_UNIT and stood(whole):
                yield start, at
        if len(fresh) > 1 and at - first >= MIN_UNIT and stood("".join(fresh)):
            yield first, at


def _marks(texts: list[str]) -> list[tuple[int, int, int]]:
    """Of each text: characters in repeated units, in runs but for their first time, and in either."""
    flat = [t.replace(CUT, "").replace("\n", "") for t in texts]
    size = np.fromiter(map(len, flat), np.int64, len(flat))
    # Every text is followed by a code of its own, so that nothing runs on over its end.
    ends = np.cumsum(size + 1)
    codes = np.empty(int(ends[-1]) if len(ends) else 0, np.uint32)
    inside = np.ones(len(codes), bool)
    inside[ends - 1] = False
    codes[ends - 1] = 0x110000 + np.arange(len(ends))
    codes[inside] = np.frombuffer("".join(flat).encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = [0, *ends.tolist()]
    owner = np.repeat(np.arange(len(texts)), size + 1)
    in_unit, in_run = np.zeros(len(codes), bool), np.zeros(len(codes), bool)
    for off, t in zip(starts, texts, strict=False):
        for a, b in _repeated_units(t):
            in_unit[off + a : off + b] = True
    for a, b, p in chain(_short_runs(codes), _long_runs(codes, owner, int(np.max(size, initial=0)))):
        if any(chr(c).isalpha() for c in codes[a : a + p]):
            in_run[a + p : a + (b - a) // p * p] = True
    return [tuple(int(np.count_nonzero(m[a:b])) for m in (in_unit, in_run, in_unit | in_run)) for a, b in pairwise(starts)]


@F.pandas_udf(T.StructType([T.StructField(n, T.IntegerType()) for n in ("units", "runs", "any")]))
def _repeats(s: pd.Series) -> pd.DataFrame:
    """The characters of normalised texts that stand in repeats; null for null."""
    out: list[tuple] = [(None, None, None)] * len(s)
    some: list[int] = []
    chars = 0
    texts = s.tolist()

    def work() -> None:
        for i, got in zip(some, _marks([texts[i] for i in some]), strict=True):
            out[i] = got

    for i, t in enumerate(texts):
        if isinstance(t, str):
            if some and chars + len(t) > TOGETHER:
                work()
                some, chars = [], 0
            some.append(i)
            chars += len(t)
    if some:
        work()
    return pd.DataFrame(out, columns=["units", "runs", "any"]).astype("Int32")


def _tree(words) -> str:
    """A pattern of these words that reads each common beginning once."""
    tree: dict = {}
    for w in words:
        at = tree
        for c in w:
            at = at.setdefault(c, {})
        at[""] = {}

    def written(t: dict) -> str:
        parts = [c + written(k) for c, k in sorted(t.items()) if c]
        return f"(?:{'|'.join(parts)}){'?' if '' in t else ''}" if parts else ""

    return written(tree)


def _ratio(part: Column, whole: Column) -> Column:
    """0 where there is nothing to share in, null where there is no text."""
    return F.when(whole.isNotNull() & part.isNotNull(), F.coalesce(F.try_divide(part, whole), F.lit(0.0)))


def measured(df: DataFrame, text_col: str = "md", key: str = "doc_id") -> DataFrame:
    """The key and every metric of the threshold table, one output row per input row."""
    d = df.select(F.col(key), F.col(text_col).alias("_text"))
    d = d.withColumn("_norm", F.translate(F.regexp_replace("_text", MARK, ""), CAPITALS + BLANKS, CAPITALS.lower()))
    d = d.withColumn("_repeats", _repeats(F.regexp_replace("_norm", SENTENCE_END, CUT)))
    stop = f"(?=[{''.join(sorted({w[0] for w in STOP_WORDS}))}])(?<!\\p{{L}}){_tree(STOP_WORDS)}(?!\\p{{L}})"
    # Lists and counts that several figures need are columns of their own: an expression named twice would be worked out twice.
    d = d.withColumns(
        {
            "_lines": F.transform(F.split("_text", r"\r?\n"), F.char_length),
            "_keys": F.filter(F.split("_norm", "\n"), lambda x: F.char_length(x) >= MIN_UNIT),
            "_body": F.translate("_text", BLANKS[1:] + "\n", ""),
        }
    )
    out = d.select(
        key,
        F.char_length("_text").alias("n_chars"),
        F.char_length(F.translate("_norm", "\n", "")).alias("unit_chars"),
        (F.char_length(F.array_join("_keys", "")) - F.char_length(F.array_join(F.array_distinct("_keys"), ""))).alias("repeated_line_chars"),
        F.col("_repeats.units").alias("repeated_unit_chars"),
        F.col("_repeats.runs").alias("run_chars"),
        F.col("_repeats.any").alias("repeated_chars"),
        F.array_max("_lines").cast("double").alias("max_line_chars"),
        F.size("_lines").alias("_n_lines"),
        F.size(F.filter("_lines", lambda x: x < 20)).alias("_short_lines"),
        F.char_length("_body").alias("_n_body"),
        F.char_length(F.regexp_replace("_body", r"[\p{L}\p{N}\p{M}]+", "")).alias("_symbols"),
        F.regexp_count(F.lower("_text"), F.lit(stop)).alias("_stops"),
        F.regexp_count("_text", F.lit(r"\p{L}+")).alias("_words"),
    )
    out = out.withColumns(
        {
            "short_line_ratio": _ratio(F.col("_short_lines"), F.col("_n_lines")),
            "symbol_ratio": _ratio(F.col("_symbols"), F.col("_n_body")),
            "stop_word_ratio": _ratio(F.col("_stops"), F.col("_words")),
            "line_share": _ratio(F.col("repeated_line_chars"), F.col("unit_chars")),
            "run_share": _ratio(F.col("run_chars"), F.col("unit_chars")),
            "repeat_share": _ratio(F.col("repeated_chars"), F.col("unit_chars")),
        }
    )
    return out.drop("_n_lines", "_short_lines", "_n_body", "_symbols", "_stops", "_words")


def judged(df: DataFrame, text_col: str = "md", key: str = "doc_id", thresholds=THRESHOLDS) -> DataFrame:
    """measured(), once per key, with `violated`, the names of the rules of the threshold table that a document breaks.

    Only keys and figures are shuffled. The rules are asked after the aggregate: before it, every
    mention of a figure would drag a copy of the whole nested projection with it.
    """
    m = measured(df, text_col, key)
    once = m.groupBy(key).agg(*[F.max(c).alias(c) for c in m.columns if c != key])
    tests = {">=": lambda c, t: c >= t, ">": lambda c, t: c > t, "<": lambda c, t: c < t, "<=": lambda c, t: c <= t}
    rules = F.array(*[F.when(tests[op](F.col(m), F.lit(t)), F.lit(name)) for m, op, t, name in thresholds])
    return once.withColumn("violated", F.array_compact(rules))


def found(df: DataFrame, text_col: str = "md", key: str = "doc_id") -> DataFrame:
    """Keys of documents that the rule `repeated` catches, judged over the whole threshold table."""
    return judged(df, text_col, key).where(F.col(key).isNotNull() & F.array_contains("violated", "repeated")).select(key)
