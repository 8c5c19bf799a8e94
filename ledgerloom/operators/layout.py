"""Page layout as relations of rules, words, blocks and table candidates.

Clusters that depend on an anchor (the first element of the cluster, not the one before) are folds
over a page's sorted array; all else is windows and joins within a page. A page bounds every group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.filings import is_caption, needs_space


def is_rule(kind: Column, x0: Column, y0: Column, x1: Column, y1: Column, width: Column) -> Column:
    """Which drawings count as table rules."""
    flat = F.abs(y1 - y0) < 1.5
    return F.when((kind == "h") | flat, flat & (F.abs(x1 - x0) > 50) & (width < 1.5)).otherwise((F.abs(x1 - x0) < 1.5) & (F.abs(y1 - y0) > 10))


def anchored(values: Column, tolerance: float) -> Column:
    """Cluster anchors of a sorted array: a value starts a cluster when it is `tolerance` or more beyond the last anchor."""
    grow = lambda acc, v: F.when((F.size(acc) == 0) | (v - F.element_at(acc, -1) >= tolerance), F.concat(acc, F.array(v))).otherwise(acc)
    return F.aggregate(F.array_sort(values), F.array().cast("array<double>"), lambda acc, v: F.when(F.size(acc) == 0, F.array(v)).otherwise(grow(acc, v)))


def row_clusters(rules: DataFrame, tolerance: float = 3.0) -> DataFrame:
    """doc_id, page_no, row_no, y: rows of horizontal rules."""
    per = rules.groupBy("doc_id", "page_no").agg(F.collect_list(F.col("y").cast("double")).alias("ys"))
    return per.select("doc_id", "page_no", F.posexplode(anchored(F.col("ys"), tolerance)).alias("row_no", "y"))


def table_blocks(rows: DataFrame, gap: float = 80.0) -> DataFrame:
    """Runs of rows less than `gap` apart; a block has two rows or more."""
    w = Window.partitionBy("doc_id", "page_no").orderBy("y")
    r = rows.withColumn("brk", F.coalesce((F.col("y") - F.lag("y").over(w) >= gap).cast("int"), F.lit(0)))
    r = r.withColumn("block_no", F.sum("brk").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return r.groupBy("doc_id", "page_no", "block_no").agg(F.count("*").alias("n_rows"), F.min("y").alias("top"), F.max("y").alias("bottom")).where("n_rows >= 2")


def column_bands(words: DataFrame, gap_ratio: float = 1.8) -> DataFrame:
    """doc_id, page_no, band_no, x0, x1: words' extents merged where the gap is at most gap_ratio times the median height."""
    page = Window.partitionBy("doc_id", "page_no")
    by_h = page.orderBy("h", "x0", "x1")
    w = words.withColumn("h", F.col("y1") - F.col("y0")).withColumns({"i": F.row_number().over(by_h) - 1, "n": F.count("*").over(page)})
    w = w.withColumn("mh", F.max(F.when(F.col("i") == F.floor(F.col("n") / 2), F.col("h"))).over(page))
    order = page.orderBy("x0", "x1")
    w = w.withColumn("reach", F.max("x1").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    w = w.withColumn("band_no", F.sum(F.coalesce((F.col("x0") - F.col("reach") > gap_ratio * F.col("mh")).cast("int"), F.lit(0))).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return w.groupBy("doc_id", "page_no", "band_no").agg(F.min("x0").alias("x0"), F.max("x1").alias("x1"), F.count("*").alias("words"))


def row_bands(words: DataFrame, ratio: float = 0.9) -> DataFrame:
    """Row borders between words: midpoints of gaps of their centres wider than `ratio` times the median height."""
    page = Window.partitionBy("doc_id", "page_no")
    w = words.select("doc_id", "page_no", "x0", (F.col("y1") - F.col("y0")).alias("h"), ((F.col("y0") + F.col("y1")) / 2).alias("c"))
    w = w.withColumns({"i": F.row_number().over(page.orderBy("h", "c", "x0")) - 1, "n": F.count("*").over(page)})
    w = w.withColumn("mh", F.max(F.when(F.col("i") == F.floor(F.col("n") / 2), F.col("h"))).over(page))
    c = w.groupBy("doc_id", "page_no", "c").agg(F.max("mh").alias("mh"))
    c = c.withColumn("nx", F.lead("c").over(page.orderBy("c"))).where(F.col("nx") - F.col("c") > ratio * F.col("mh"))
    return c.select("doc_id", "page_no", ((F.col("c") + F.col("nx")) / 2).alias("border"))


def words_to_cells(words: DataFrame, bands: DataFrame, rows: DataFrame) -> DataFrame:
    """Each word's row and column: the first band that holds its centre, else the nearest band's; words outside all rows are flagged, not dropped.

    Bands of a page are an array of their own, so the range join becomes a lookup.
    """
    cols = bands.groupBy("doc_id", "page_no").agg(F.array_sort(F.collect_list(F.struct("band_no", "x0", "x1"))).alias("cols"))
    ys = rows.groupBy("doc_id", "page_no").agg(F.array_sort(F.collect_list(F.col("y").cast("double"))).alias("ys"))
    w = words.join(cols, ["doc_id", "page_no"]).join(ys, ["doc_id", "page_no"])
    cx, cy = (F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2
    far = F.transform("cols", lambda b: F.greatest(b["x0"] - cx, cx - b["x1"], F.lit(0.0)))
    col = F.array_position(far, F.array_min(far)) - 1
    row = F.size(F.filter("ys", lambda y: y <= cy)) - 1
    inside = (row >= 0) & (row < F.size("ys") - 1)
    return w.select("doc_id", "page_no", "seq", "text", F.when(inside, row).alias("row_no"), col.cast("int").alias("col_no"), (F.element_at(far, (col + 1).cast("int")) > 0).alias("outside_x"), (~inside).alias("outside_y"))


def lined_tables(rules: DataFrame, words: DataFrame, least_rules: int = 4) -> DataFrame:
    """doc_id, page_no, block_no, top, bottom, x0, x1, grid: tables between horizontal rules, put together from rows, blocks, column bands and words.

    rules: doc_id, page_no, y; words: doc_id, page_no, seq, x0, y0, x1, y1, text. A page needs
    least_rules rules, a table two rows and two columns and some text.
    """
    enough = rules.groupBy("doc_id", "page_no").agg(F.count("*").alias("n")).where(F.col("n") >= least_rules).select("doc_id", "page_no")
    rows = row_clusters(rules.join(enough, ["doc_id", "page_no"], "left_semi"))
    blocks = table_blocks(rows)
    cy = (F.col("y0") + F.col("y1")) / 2
    inside = lambda d, y: d.join(blocks.select("doc_id", "page_no", "block_no", "top", "bottom"), ["doc_id", "page_no"]).where(y.between(F.col("top"), F.col("bottom")))
    one = F.struct("page_no", "block_no").alias("page_no")
    w = inside(words, cy).select("doc_id", one, "seq", "x0", "y0", "x1", "y1", "text")
    cells = words_to_cells(w, column_bands(w), inside(rows, F.col("y")).select("doc_id", one, "y")).where("row_no IS NOT NULL")
    per = cells.groupBy("doc_id", "page_no", "row_no", "col_no").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "text"))), lambda x: x["text"]), " ").alias("text"))
    lines_ = per.groupBy("doc_id", "page_no", "row_no").agg(F.array_sort(F.collect_list(F.struct("col_no", "text"))).alias("m"), F.max("col_no").alias("wide"))
    t = lines_.groupBy("doc_id", "page_no").agg(F.array_sort(F.collect_list(F.struct("row_no", "m"))).alias("rows"), (F.max("wide") + 1).alias("ncols"))
    grid = F.transform("rows", lambda r: F.transform(F.sequence(F.lit(0), F.col("ncols") - 1), lambda c: F.coalesce(F.get(F.filter(r["m"], lambda x: x["col_no"] == c), F.lit(0))["text"], F.lit(""))))
    t = t.where("size(rows) >= 2 AND ncols >= 2").select("doc_id", "page_no.page_no", "page_no.block_no", grid.alias("grid"))
    wide = w.groupBy("doc_id", F.col("page_no.page_no").alias("page_no"), F.col("page_no.block_no").alias("block_no")).agg(F.min("x0").alias("x0"), F.max("x1").alias("x1"))
    return t.join(blocks.select("doc_id", "page_no", "block_no", "top", "bottom"), ["doc_id", "page_no", "block_no"]).join(wide, ["doc_id", "page_no", "block_no"])


def detected_tables(*found: DataFrame) -> DataFrame:
    """doc_id, page_no, table_no, x0, y0, x1, y1, grid: the tables of several detectors, the first one's before the next one's.

    found: doc_id, page_no, x0, y0, x1, y1, grid of each. A table that a kept one covers for more than
    half is dropped, then one inside another of more columns. Tables are numbered from the top.
    """
    columns = ["doc_id", "page_no", "x0", "y0", "x1", "y1", "grid"]
    every = reduce(DataFrame.unionByName, [d.select(*columns, F.lit(i).alias("rank")) for i, d in enumerate(found)])
    page = Window.partitionBy("doc_id", "page_no")
    every = every.withColumn("seq", F.row_number().over(page.orderBy("rank", "y0", "x0"))).withColumn("ncols", F.array_max(F.transform("grid", F.size)))
    kept = kept_candidates(every.select("doc_id", "page_no", F.col("seq").cast("int").alias("seq"), "x0", "y0", "x1", "y1", F.col("ncols").cast("int").alias("ncols")))
    t = every.join(kept.select("doc_id", "page_no", "seq"), ["doc_id", "page_no", "seq"], "left_semi")
    return t.withColumn("table_no", F.row_number().over(page.orderBy("y0", "seq")) - 1).select("doc_id", "page_no", "table_no", "x0", "y0", "x1", "y1", "grid")


def _widest() -> dict[str, Column]:
    """Of a page with the gap after each left edge: its widest gap with the middle, its words, and how far their left edges reach."""
    middle = F.struct("gap", (F.col("x0") + F.col("gap") / 2).alias("mid"))
    return {"m": F.max_by(middle, F.struct("gap", "x0")), "n": F.count("*"), "first": F.min("x0"), "last": F.max("x0")}


def _splits(least: float) -> Column:
    span = F.col("last") - F.col("first")
    return (F.col("n") >= 4) & (span > 0) & (F.col("m.gap") >= least * span)


def column_split(words: DataFrame, least: float = 0.15) -> DataFrame:
    """doc_id, page_no, mid: the middle of the widest gap between left edges, if it is wide enough; ties to the right."""
    w = Window.partitionBy("doc_id", "page_no").orderBy("x0")
    g = words.withColumn("gap", F.lead("x0").over(w) - F.col("x0"))
    g = g.groupBy("doc_id", "page_no").agg(*[c.alias(k) for k, c in _widest().items()])
    return g.where(_splits(least)).select("doc_id", "page_no", "m.mid")


def reading_order(words: DataFrame, output: DataFrame, least: int = 50) -> DataFrame:
    """Share of neighbouring words of the output that follow each other in the page's geometry too.

    words: layout words; output: doc_id, pos, word. Words are matched by their n-th occurrence.
    Both sides lie under each other and are shuffled once, by document; all windows run within that.
    """
    none = F.lit(None)
    g = words.select("doc_id", F.lit(0).alias("side"), "page_no", F.col("seq").alias("at"), "x0", "y0", F.col("text").alias("word"))
    o = output.select("doc_id", F.lit(1).alias("side"), none.alias("page_no"), F.col("pos").alias("at"), none.alias("x0"), none.alias("y0"), "word")
    b = g.unionByName(o).where("doc_id IS NOT NULL").repartition("doc_id")
    page = Window.partitionBy("doc_id", "side", "page_no")
    b = b.withColumn("gap", F.lead("x0").over(page.orderBy("x0")) - F.col("x0"))
    b = b.withColumns({k: c.over(page) for k, c in _widest().items()})
    mid = F.when(F.col("page_no").isNotNull() & _splits(0.15), F.col("m.mid"))
    col = F.when(mid.isNull() | (F.col("x0") < mid), 0).otherwise(1)
    b = b.select("doc_id", "side", "word", "page_no", col.alias("col"), "y0", "x0", "at")
    b = b.withColumn("place", F.row_number().over(Window.partitionBy("doc_id", "side").orderBy("page_no", "col", "y0", "x0", "at")))
    b = b.select("doc_id", "side", "word", "place", F.row_number().over(Window.partitionBy("doc_id", "side", "word").orderBy("place")).alias("k"))
    m = b.where("word IS NOT NULL").groupBy("doc_id", "word", "k").agg(*[F.max(F.when(F.col("side") == i, F.col("place"))).alias(n) for i, n in ((0, "gpos"), (1, "pos"))])
    m = m.where("gpos IS NOT NULL AND pos IS NOT NULL")
    m = m.select("doc_id", (F.col("gpos") > F.lag("gpos").over(Window.partitionBy("doc_id").orderBy("pos"))).cast("int").alias("ok"))
    per = m.groupBy("doc_id").agg(F.count("*").alias("matched"), F.sum("ok").alias("right"))
    ok = F.col("matched") >= least
    return per.select("doc_id", F.when(ok, "ok").otherwise("skip").alias("status"), "matched", F.when(ok, F.round(F.col("right") / (F.col("matched") - 1), 6)).alias("accuracy"))


def merged_lines(blocks: DataFrame, same_row: float = 5.0, wrap: float = 22.0) -> DataFrame:
    """Blocks (seq, y0, kind, text) of a page merged to paragraphs: same row, or a wrapped line after text without an end mark.

    A space joins two pieces only where both sides of the seam are ASCII.
    A merge on one row keeps the paragraph's old height, so the page is folded with the last paragraph as state.
    """
    ends = r"[。！？；：!?;:]$"
    item = F.struct("seq", F.col("y0").cast("double").alias("y0"), "kind", "text")
    per = blocks.groupBy("doc_id", "page_no").agg(F.array_sort(F.collect_list(item)).alias("bs"))
    zero = F.array().cast("array<struct<y0:double,kind:string,text:string>>")

    def step(acc: Column, b: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        new = F.struct(b["y0"].alias("y0"), b["kind"].alias("kind"), b["text"].alias("text"))
        gap = b["y0"] - last["y0"]
        both = (last["kind"] == "p") & (b["kind"] == "p")
        row, wrapped = both & (F.abs(gap) < same_row), both & (F.abs(gap) >= same_row) & (gap < wrap) & ~last["text"].rlike(ends)
        seam = F.when(needs_space(last["text"], b["text"]), " ").otherwise("")
        joined = F.struct(F.when(row, last["y0"]).otherwise(b["y0"]).alias("y0"), last["kind"].alias("kind"), F.concat(last["text"], seam, b["text"]).alias("text"))
        return F.when((F.size(acc) > 0) & (row | wrapped), F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(joined))).otherwise(F.concat(acc, F.array(new)))

    out = per.select("doc_id", "page_no", F.posexplode(F.aggregate("bs", zero, step)).alias("par_no", "p"))
    return out.select("doc_id", "page_no", "par_no", "p.kind", "p.text")


def kept_candidates(cands: DataFrame, overlap: float = 0.5) -> DataFrame:
    """Table candidates of a page in order: one that is covered for more than half by a kept one is dropped, then those inside another with as many columns."""
    item = F.struct("seq", "x0", "y0", "x1", "y1", "ncols")
    per = cands.groupBy("doc_id", "page_no").agg(F.array_sort(F.collect_list(item)).alias("cs"))
    zero = F.array().cast("array<struct<seq:int,x0:double,y0:double,x1:double,y1:double,ncols:int>>")

    def shared(a: Column, b: Column) -> Column:
        wide = F.greatest(F.lit(0.0), F.least(a["x1"], b["x1"]) - F.greatest(a["x0"], b["x0"]))
        high = F.greatest(F.lit(0.0), F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"]))
        return wide * high

    area = lambda c: (c["x1"] - c["x0"]) * (c["y1"] - c["y0"])
    keep = F.aggregate("cs", zero, lambda acc, c: F.when(F.exists(acc, lambda k: shared(k, c) > overlap * area(c)), acc).otherwise(F.concat(acc, F.array(c))))
    k = per.select("doc_id", "page_no", keep.alias("ks"))
    holds = lambda o, c: (o["seq"] != c["seq"]) & (o["x0"] <= c["x0"]) & (o["y0"] <= c["y0"]) & (o["x1"] >= c["x1"]) & (o["y1"] >= c["y1"]) & (o["ncols"] > c["ncols"])
    k = k.select("doc_id", "page_no", F.filter("ks", lambda c: ~F.exists("ks", lambda o: holds(o, c))).alias("ks"))
    return k.select("doc_id", "page_no", F.explode("ks").alias("c")).select("doc_id", "page_no", "c.seq", "c.ncols")


def captions(tables: DataFrame, texts: DataFrame, reach: float = 30.0) -> DataFrame:
    """The nearest caption that starts at most `reach` above each table: a band join on height bins, then the least gap."""
    t = tables.select("doc_id", "page_no", "table_no", F.col("y0").alias("ty"), F.explode(F.array(F.floor(F.col("y0") / reach), F.floor(F.col("y0") / reach) - 1)).alias("b"))
    x = texts.where(is_caption(F.trim("text"))).select("doc_id", "page_no", F.col("y0").alias("xy"), F.trim("text").alias("text"), F.floor(F.col("y0") / reach).alias("b"))
    gap = F.col("ty") - F.col("xy")
    j = t.join(x, ["doc_id", "page_no", "b"]).where((gap > 0) & (gap <= reach))
    return j.groupBy("doc_id", "page_no", "table_no").agg(F.min_by("text", F.struct(gap.alias("gap"), "text")).alias("caption"))


def chained(tables: DataFrame, near: float = 25.0) -> DataFrame:
    """Tables with the number of their chain. Tables that run over pages get one: last of its page near the bottom, next page's first near the top, as many columns. Any number of pages."""
    page = Window.partitionBy("doc_id", "page_no")
    t = tables.withColumns({"first": F.row_number().over(page.orderBy("y0")) == 1, "last": F.row_number().over(page.orderBy(F.desc("y1"))) == 1})
    w = Window.partitionBy("doc_id").orderBy("page_no", "y0")
    prev = lambda c: F.lag(c).over(w)
    goes_on = (
        (prev("page_no") == F.col("page_no") - 1) & prev("last") & F.col("first") & (prev("ncols") == F.col("ncols"))
        & (prev("height") - prev("y1") <= near) & (F.col("y0") <= near)
    )
    t = t.withColumn("starts", (~F.coalesce(goes_on, F.lit(False))).cast("int"))
    return t.withColumn("chain", F.sum("starts").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))).drop("first", "last", "starts")


def stitched(tables: DataFrame, near: float = 25.0) -> DataFrame:
    return chained(tables, near).select("doc_id", "page_no", "y0", "nrows", "chain")


def stitched_grids(tables: DataFrame, near: float = 25.0) -> DataFrame:
    """One row per chain, where its first table stands, with all its rows; a header that a later page repeats is dropped."""
    t = chained(tables.withColumns({"ncols": F.size(F.get("grid", F.lit(0)))}), near)
    per = t.groupBy("doc_id", "chain").agg(F.array_sort(F.collect_list(F.struct("page_no", "y0", "table_no", "grid"))).alias("parts"))
    head = F.get(F.get("parts", F.lit(0))["grid"], F.lit(0))
    more = lambda p, i: F.when((i > 0) & (F.get(p["grid"], F.lit(0)) == head), F.slice(p["grid"], 2, 1_000_000_000)).otherwise(p["grid"])
    first = F.get("parts", F.lit(0))
    return per.select("doc_id", first["page_no"].alias("page_no"), first["table_no"].alias("table_no"), first["y0"].alias("y0"), F.flatten(F.transform("parts", more)).alias("grid"))


def grid_text(grid: Column) -> Column:
    """Rows of cells as a pipe table: blanks trimmed, pipes escaped, rows padded, empty rows and columns dropped; empty if nothing is left."""
    cell = lambda c: F.replace(F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"\r?\n", " ")), F.lit("|"), F.lit("\\|"))
    data = F.filter(F.transform(grid, lambda r: F.transform(r, cell)), lambda r: F.exists(r, lambda c: c != ""))
    at = lambda r, i: F.coalesce(F.get(r, i), F.lit(""))
    wide = F.coalesce(F.array_max(F.transform(data, F.size)), F.lit(0))
    cols = F.filter(F.sequence(F.lit(0), F.greatest(wide - 1, F.lit(0))), lambda i: F.exists(data, lambda r: at(r, i) != ""))
    line = F.transform(data, lambda r: F.concat(F.lit("| "), F.array_join(F.transform(cols, lambda i: at(r, i)), " | "), F.lit(" |")))
    rule = F.array(F.concat(F.lit("|"), F.repeat(F.lit(" --- |"), F.size(cols))))
    return F.when(F.size(data) > 0, F.array_join(F.concat(F.slice(line, 1, 1), rule, F.slice(line, 2, 1_000_000_000)), "\n")).otherwise("")


def accepted_text_tables(tables: DataFrame, rows: int = 2, cols: int = 2, filled: float = 0.5) -> DataFrame:
    """Tables found by aligned text that are tables: rows and columns enough, and at least half of the cells of rows that hold anything filled."""
    data = F.filter("grid", lambda r: F.exists(r, lambda c: F.trim(F.coalesce(c, F.lit(""))) != ""))
    per = lambda r: F.size(F.filter(r, lambda c: F.trim(F.coalesce(c, F.lit(""))) != ""))
    total = lambda a: F.aggregate(a, F.lit(0), lambda t, x: t + x)
    t = tables.withColumn("rows", data).withColumns({"n": F.transform("rows", per), "cells": F.transform("rows", F.size)})
    ok = (F.size("rows") >= rows) & (F.array_max("n") >= cols) & (total("n") / total("cells") >= filled)
    return t.where(ok).drop("grid", "n", "cells").withColumnRenamed("rows", "grid")


def largest_tables(cells: DataFrame, k: int = 3) -> DataFrame:
    """The k tables of each document with most cells (rows times columns), ties by number: a report."""
    area = cells.groupBy("doc_id", "table_no").agg(((F.max("row_no") + 1) * (F.max("col_no") + 1)).alias("area"))
    per = area.groupBy("doc_id").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("area")).alias("a"), "table_no"))), 1, k).alias("t"))
    return per.select("doc_id", F.posexplode("t").alias("place", "t")).select("doc_id", "place", "t.table_no", (-F.col("t.a")).alias("area"))


#: Labels of the totals of a frameless balance sheet, not within a longer word, and their codes and names where a label is torn.
TOTALS = {
    "assets": (r"(?<![一-龥])資?\s*產\s*(?:總|合)\s*(?:計|額)", "^1[xX]{3}$", "資產總計"),
    "liab": (r"(?<![一-龥])負\s*債\s*(?:總|合)\s*(?:計|額)", "^2[xX]{3}$", "負債總計"),
    "equity": (r"(?<![一-龥])(?:股\s*東\s*)?權\s*益\s*(?:(?:總|合)\s*(?:計|額)|淨\s*(?:額|值))", "^3[xX]{3}$", "權益總計"),
}
SHEET_WORDS = ("資產負債表", "現金及約當現金", "流動資產")


def balance_pages(pages: DataFrame) -> DataFrame:
    """Pages (doc_id, page_no, text) that hold a frameless balance sheet: its words, and a line that is an account's code."""
    flat = F.regexp_replace("text", r"[ \x{3000}]", "")
    words = [F.contains(flat, F.lit(w)) for w in SHEET_WORDS]
    return pages.where(words[0] & words[1] & words[2] & F.col("text").rlike(r"(?m)^\s*[0-9]{4}\s*$"))


def balance_totals(rows: DataFrame) -> DataFrame:
    """doc_id, kind, name, amount of the three totals: the first label with an amount in the 8 lines after it, up to the next code; else the first total code."""
    w = Window.partitionBy("doc_id").orderBy("line_no")
    r = rows.withColumn("s", F.trim("line"))
    digits = r"^\$?([0-9,]+)$"
    tokens = F.filter(F.split("s", r"\s+"), lambda t: t.rlike(digits) & F.char_length(F.regexp_replace(t, r"[$,]", "")).between(5, 12))
    r = r.withColumn("amt", F.regexp_replace(F.get(tokens, F.lit(0)), r"[$]", "")).withColumn("code", F.col("s").rlike("^[0-9]{4}$"))
    ahead = w.rowsBetween(1, 8)
    r = r.withColumn("next", F.collect_list(F.struct("code", F.coalesce("amt", F.lit("")).alias("amt"))).over(ahead))
    stop = F.array_position(F.transform("next", lambda x: x["code"]), F.lit(True))
    reach = F.when(stop > 0, F.slice("next", F.lit(1), (stop - 1).cast("int"))).otherwise(F.col("next"))
    r = r.withColumn("found", F.get(F.filter(reach, lambda x: x["amt"] != ""), F.lit(0))["amt"]).where("found IS NOT NULL")
    parts = []
    for kind, (label, code, plain) in TOTALS.items():
        named, coded = F.col("s").rlike(label), F.col("s").rlike(code)
        name = F.when(named, F.regexp_replace("s", " ", "")).otherwise(F.lit(plain))
        order = F.struct((~named).cast("int").alias("c"), "line_no").alias("o")  # labels before codes
        parts.append(r.where(named | coded).select("doc_id", F.lit(kind).alias("kind"), name.alias("name"), F.col("found").alias("amount"), order))
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return every.groupBy("doc_id", "kind").agg(F.min_by("name", "o").alias("name"), F.regexp_replace(F.min_by("amount", "o"), ",", "").try_cast("double").alias("amount"))


def balance_rows(rows: DataFrame) -> DataFrame:
    """Account rows of a frameless balance sheet: a four-digit code line, its name within 6 lines and its amount within 8, up to the next code."""
    w = Window.partitionBy("doc_id").orderBy("line_no")
    code = F.col("line").rlike(r"^[1-3][0-9]{3}$")
    r = rows.withColumn("code", F.when(code, F.col("line"))).withColumn("grp", F.sum(code.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))).where("grp > 0")
    r = r.withColumn("off", F.col("line_no") - F.min("line_no").over(Window.partitionBy("doc_id", "grp")))
    d = F.regexp_replace("line", r"[$,\s]", "")
    amount = F.when((F.col("off") > 0) & (F.col("off") <= 8) & d.rlike(r"^[0-9]{5,12}$"), d.try_cast("double"))
    name = F.when((F.col("off") > 0) & (F.col("off") <= 6) & F.col("line").rlike(r"\p{L}"), F.col("line"))
    out = r.groupBy("doc_id", "grp").agg(F.max("code").alias("code"), F.min_by(name, F.when(name.isNotNull(), F.col("off"))).alias("name"), F.min_by(amount, F.when(amount.isNotNull(), F.col("off"))).alias("amount"))
    return out.where("amount IS NOT NULL AND name IS NOT NULL").select("doc_id", "code", "name", "amount")
