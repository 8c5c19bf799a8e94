"""Splitting of oversized items at natural boundaries, by one bounded-quantifier regular expression.

The expression's alternatives stand in the order of boundary strength (section, blank line, line or
table row, sentence, word, character); each consumes as much as the limit allows and at least half
of it, so matches follow each other without a gap and no piece is a crumb. Limits in bytes run the
same way over the text's UTF-8 bytes seen as Latin-1, where no alternative may end inside a
character. A piece starts with the last `overlap` units of the text before it, looked up in the
piece before; for byte limits the overlap is shortened to whole characters.

Defined results: null text gives no piece; empty text one empty piece; a text of exactly the limit
one piece. Where no limit is known for an item, it stays whole. Pieces without their overlap, joined
in order, are the text, character by character. The overlap is cut to what the piece before holds
where it is more than half of the limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEADING = r"(?:#{1,6}[ \t]|={2,6} |【)"
HEADING_BYTES = r"(?:#{1,6}[ \t]|={2,6} |\xE3\x80\x90)"
WIDE_END = r"(?<=[。！？｡])"
WIDE_END_BYTES = r"(?<=\xE3\x80\x82|\xEF\xBC\x81|\xEF\xBC\x9F|\xEF\xBD\xA1)"
WIDE_COMMA = r"(?<=[、，；])"
WIDE_COMMA_BYTES = r"(?<=\xE3\x80\x81|\xEF\xBC\x8C|\xEF\xBC\x9B)"


def _pattern(limit: Column, least: Column, latin: bool) -> Column:
    """The expression for cores of at most `limit` units, at least `least` where a boundary is looked for."""
    heading, wide, comma = (HEADING_BYTES, WIDE_END_BYTES, WIDE_COMMA_BYTES) if latin else (HEADING, WIDE_END, WIDE_COMMA)
    whole = r"(?![\x80-\xBF])" if latin else r"(?!\p{M}|‍)"
    ends = [rf"(?<=\n)(?={heading})", r"(?<=\n\r?\n)(?!\r?\n)", r"(?<=\n)", wide, r"(?<=[.!?][ \t])", comma, r"(?<=[ \t,;|])", whole]
    span = F.concat(F.lit(".{"), least.cast("string"), F.lit(","), limit.cast("string"), F.lit("}"))
    tail = F.concat(F.lit(".{1,"), limit.cast("string"), F.lit("}"))
    alternatives = [F.concat(tail, F.lit(r"\z")), *[F.concat(span, F.lit(e)) for e in ends], F.concat(tail, F.lit(r"(?![\x80-\xBF])" if latin else ""))]
    return F.concat(F.lit("(?s)"), F.concat_ws("|", *alternatives))


def pieces(df: DataFrame, limits: DataFrame, text_col: str = "md", key: str = "doc_id", group: str = "market") -> DataFrame:
    """key, piece_no (from 1), n_pieces, piece, overlap (characters at its start that belong to the piece before), size.

    limits: (group, max_size, size_unit, overlap_size), one row per group.
    """
    lim = limits.select(F.col(group).alias("_g"), F.col("max_size").alias("_max"), F.col("size_unit").alias("_unit"), F.coalesce("overlap_size", F.lit(0)).alias("_ov")).where("_max > 0").dropDuplicates(["_g"])
    bytes_ = F.coalesce(F.col("_unit") == "bytes", F.lit(False))
    size_of = lambda c: F.when(bytes_, F.octet_length(c)).otherwise(F.char_length(c))
    d = df.select(F.col(key), F.col(group).alias("_g"), F.col(text_col).alias("_t")).where(F.col("_t").isNotNull()).join(lim, "_g", "left")
    # A byte limit is at least one character of any length.
    max_ = F.greatest(F.col("_max"), F.when(bytes_, 4).otherwise(1))
    ov = F.least(F.col("_ov"), F.greatest(max_ - F.when(bytes_, 4).otherwise(1), F.lit(0)))
    core = max_ - ov
    least = F.least(F.greatest(F.floor(core / 2), ov, F.lit(1)), core)
    d = d.withColumns({"_core": core, "_least": least, "_ov": ov})
    fits = F.col("_max").isNull() | (size_of(F.col("_t")) <= F.col("_max"))
    seen = F.when(bytes_, F.decode(F.encode("_t", "UTF-8"), "ISO-8859-1")).otherwise(F.col("_t"))
    pattern = F.when(bytes_, _pattern(F.col("_core"), F.col("_least"), True)).otherwise(_pattern(F.col("_core"), F.col("_least"), False))
    cores = F.when(fits, F.array(seen)).otherwise(F.regexp_extract_all(seen, pattern, F.lit(0)))
    d = d.withColumn("_cores", cores)
    back = lambda c: F.right(c, F.col("_ov"))
    lookback = lambda i: F.when(i == 0, F.lit("")).otherwise(
        F.when(bytes_, F.regexp_replace(back(F.get("_cores", i - 1)), r"^[\x80-\xBF]+", "")).otherwise(back(F.get("_cores", i - 1)))
    )
    real = lambda c: F.when(bytes_, F.decode(F.encode(c, "ISO-8859-1"), "UTF-8")).otherwise(c)
    made = F.transform("_cores", lambda c, i: F.struct(real(F.concat(lookback(i), c)).alias("piece"), F.char_length(real(lookback(i))).alias("overlap")))
    d = d.select(key, "_unit", F.size("_cores").alias("n_pieces"), F.posexplode(made).alias("_i", "_p"))
    return d.select(
        key, (F.col("_i") + 1).alias("piece_no"), "n_pieces", "_p.piece", "_p.overlap", size_of(F.col("_p.piece")).alias("size")
    )


def oversized(df: DataFrame, limits: DataFrame, text_col: str = "md", key: str = "doc_id", group: str = "market") -> DataFrame:
    """Keys of items that the splitter cuts. Only keys are shuffled."""
    return pieces(df, limits, text_col, key, group).where("n_pieces > 1").select(key).distinct()
