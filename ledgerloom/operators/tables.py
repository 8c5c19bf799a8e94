"""Pipe tables of Markdown as a relation of cells, and the arithmetic that checks them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.numbers import amount_cf, num_lenient, num_strict_cell, strip
from ledgerloom.session import merged

CJK = r"[\x{4E00}-\x{9FFF}\x{3400}-\x{4DBF}\x{3040}-\x{30FF}\x{31F0}-\x{31FF}\x{AC00}-\x{D7AF}]"
#: Row labels of the accounting identity.
ASSET = "^(资产总计|资产合计|資產總計|資産合計|資産の部合計|総資産|总资产|資產合計)"
LIABILITY = "^(负债合计|负债总计|負債合計|負債總計|負債の部合計|总负债)"
EQUITY = r"^(所有者权益（或股东权益）合计|所有者权益\(或股东权益\)合计|所有者权益合计|股东权益合计|權益總計|權益合計|權益總額|純資産合計|純資産の部合計)"
NOT_EQUITY = "归属于母公司|归属于上市公司|母公司所有者权益|非控制性权益|少数股东|歸屬於母公司|歸屬母公司|非控制權益|少數股東"
#: Labels of amounts that two statements share, and of total rows.
NET_INCOME = "^(净利润|淨利|本期净利|本期淨利|純利益|当期純利益)"
CASH = "^(货币资金|現金及約當現金|現金及び現金同等物|現金及現金等價物|現金及び預金)"
NOT_SHARED = "归属于母公司|归属于上市公司|母公司所有者|少数股东|非控制性"
TOTAL = "合计|合計|总计|總計|小计|小計|[Tt]otal|합계"
#: The items of a cash-flow statement.
CASH_FLOW = {
    "opening": "(期初|年初)现金及现金等价物余额", "closing": "(期末|年末)现金及现金等价物余额", "op": r"经营活动[^|]*?现金流量净额",
    "inv": r"投资活动[^|]*?现金流量净额", "fin": r"筹资活动[^|]*?现金流量净额", "fx": "汇率变动对现金及现金等价",
}


#: What no text holds: it stands for the lines between tables.
BETWEEN = "\uffff"


def doc_tables(docs: DataFrame) -> DataFrame:
    """doc_id, table_no, rows: runs of pipe lines of two rows or more, rules between rows left out, each row stripped.

    Lines outside tables become one sign, by which the text is split: nothing is shuffled or sorted.
    """
    stripped = F.transform(F.split(F.translate("md", BETWEEN, ""), "\n"), strip)
    pipe = lambda x: x.rlike(r"(?s)^\|.*\|$") & (F.char_length(x) > 1)
    text = F.array_join(F.transform(stripped, lambda x: F.when(pipe(x), x).otherwise(BETWEEN)), "\n")
    rows = F.transform(F.split(text, BETWEEN), lambda t: F.filter(F.split(t, "\n"), lambda x: (x != "") & ~x.rlike(r"^\|[\s:|\-]+\|$")))
    return docs.where("md IS NOT NULL").select("doc_id", F.posexplode(F.filter(rows, lambda r: F.size(r) >= 2)).alias("table_no", "rows"))


def cells_of(row: Column) -> Column:
    """The cells of a pipe line. An escaped pipe stays in its cell."""
    return F.transform(F.split(F.substring(row, F.lit(2), F.char_length(row) - 2), r"(?<!\\)\|"), strip)


def table_rows(docs: DataFrame) -> DataFrame:
    """doc_id, table_no, row_no, cells of doc_tables()."""
    return doc_tables(docs).select("doc_id", "table_no", F.posexplode("rows").alias("row_no", "row")).select("doc_id", "table_no", "row_no", cells_of(F.col("row")).alias("cells"))


def label(cells: Column) -> Column:
    """The first of the first two cells that holds CJK, else the first."""
    return F.coalesce(F.get(F.filter(F.slice(cells, 1, 2), lambda c: c.rlike(CJK)), F.lit(0)), F.get(cells, F.lit(0)), F.lit(""))


def cell_values(rows: DataFrame) -> DataFrame:
    """doc_id, table_no, row_no, label, col_no, cell of all cells but the first of each row."""
    r = rows.select("doc_id", "table_no", "row_no", label(F.col("cells")).alias("label"), F.posexplode("cells").alias("col_no", "cell"))
    return r.where("col_no >= 1")


def alignment(docs: DataFrame) -> DataFrame:
    """Tables, those with a row of another width than the first, their share, and the worst width."""
    r = table_rows(docs).select("doc_id", "table_no", "row_no", F.size("cells").alias("w"))
    per = r.groupBy("doc_id", "table_no").agg(F.min_by("w", "row_no").alias("want"), F.collect_list("w").alias("ws"))
    bad = per.select("doc_id", "want", F.size(F.filter("ws", lambda x: x != F.col("want"))).alias("bad"))
    out = bad.groupBy("doc_id").agg(F.count("*").alias("tables"), F.count_if(F.col("bad") > 0).alias("misaligned"), F.max("bad").alias("worst_rows"))
    return out.withColumn("misaligned_ratio", F.round(F.col("misaligned") / F.col("tables"), 6))


def identity(docs: DataFrame) -> DataFrame:
    """Assets = liabilities + equity over all candidates of a document: pass, fail or skip, the least difference, and the number of candidates.

    Rows are told by their label before their cells become rows. Sums of distinct liabilities and
    equities are sorted together with the assets, so the nearest sum of an asset is its neighbour.
    """
    key = F.when(F.col("label").rlike(ASSET), "asset").when(F.col("label").rlike(LIABILITY), "liability").when(F.col("label").rlike(EQUITY) & ~F.col("label").rlike(NOT_EQUITY), "equity")
    c = table_rows(docs).select("doc_id", label(F.col("cells")).alias("label"), "cells").withColumn("key", key).where("key IS NOT NULL")
    c = c.select("doc_id", "key", F.explode(F.slice("cells", F.lit(2), F.size("cells"))).alias("cell")).withColumn("v", num_lenient(F.col("cell"))).where("v IS NOT NULL AND v <> 0")
    per = c.groupBy("doc_id").agg(*[F.collect_set(F.when(F.col("key") == k, F.col("v"))).alias(k) for k in ("asset", "liability", "equity")])
    sums = F.array_distinct(F.flatten(F.transform("liability", lambda li: F.transform("equity", lambda e: li + e))))
    both = F.concat(F.transform("asset", lambda v: F.struct(v.alias("v"), F.lit(1).alias("asset"))), F.transform(sums, lambda v: F.struct(v.alias("v"), F.lit(0).alias("asset"))))
    # One row more than the candidates, so that a document without assets keeps its counts.
    sizes = [F.size(k).alias(f"{k}_n") for k in ("asset", "liability", "equity")]
    every = per.select("doc_id", *sizes, F.inline_outer(both))
    w = Window.partitionBy("doc_id").orderBy("v", "asset")
    below = F.last(F.when(F.col("asset") == 0, F.col("v")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    above = F.first(F.when(F.col("asset") == 0, F.col("v")), ignorenulls=True).over(w.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    diff = F.least(F.abs(F.col("v") - below), F.abs(F.col("v") - above))
    near = every.withColumn("diff", F.when(F.col("asset") == 1, diff)).groupBy("doc_id").agg(F.min("diff").alias("diff"), *[F.max(f"{k}_n").alias(f"{k}_n") for k in ("asset", "liability", "equity")])
    out = docs.where("md IS NOT NULL").select("doc_id").join(merged(near), "doc_id", "left")
    status = F.when(F.col("diff").isNull(), "skip").when(F.col("diff") <= 1.0, "pass").otherwise("fail")
    return out.select("doc_id", status.alias("status"), F.round("diff", 2).alias("diff"), *[F.coalesce(f"{k}_n", F.lit(0)).alias(f"{k}_n") for k in ("asset", "liability", "equity")])


def footing(docs: DataFrame, tol_abs: float = 2.0, tol_rel: float = 0.005) -> DataFrame:
    """Totals against the sum of the rows since the total before, by column; without a total row the last row is tried.

    A column is folded within its table's row, so only figures by document are shuffled.
    """
    t = doc_tables(docs).where("size(rows) >= 3").select("doc_id", F.transform("rows", cells_of).alias("rows"))
    t = t.withColumn("ncol", F.array_max(F.transform("rows", F.size))).where("ncol >= 2")
    t = t.withColumn("rows", F.transform("rows", lambda r: F.struct(label(r).rlike(TOTAL).alias("total"), F.transform(r, num_strict_cell).alias("vs"))))
    c = t.select("doc_id", "rows", F.explode(F.sequence(F.lit(1), F.col("ncol") - 1)).alias("col"))
    entries = F.filter(F.transform("rows", lambda r: F.struct(F.get(r["vs"], F.col("col")).alias("v"), r["total"].alias("total"))), lambda e: e["v"].isNotNull())
    c = c.select("doc_id", entries.alias("es")).where("size(es) >= 3")
    c = c.withColumn("kind", F.when(F.exists("es", lambda e: e["total"]), "labeled").otherwise("inferred"))
    last = F.size("es") - 1
    es = F.transform("es", lambda e, i: F.struct(e["v"].alias("v"), F.when(F.col("kind") == "labeled", e["total"]).otherwise(i == last).alias("said")))
    state = "struct<s:double,k:int,out:array<struct<said:double,addends:double,k:int>>>"
    start = F.struct(F.lit(0.0).alias("s"), F.lit(0).alias("k"), F.array().alias("out")).cast(state)

    def step(a: Column, e: Column) -> Column:
        done = F.struct(F.lit(0.0).alias("s"), F.lit(0).alias("k"), F.concat(a["out"], F.array(F.struct(e["v"].alias("said"), a["s"].alias("addends"), a["k"].alias("k")))).alias("out")).cast(state)
        more = F.struct((a["s"] + e["v"]).alias("s"), (a["k"] + 1).alias("k"), a["out"].alias("out")).cast(state)
        return F.when(e["said"], done).otherwise(more)

    per = c.select("doc_id", "kind", F.explode(F.aggregate(es, start, step)["out"]).alias("o")).select("doc_id", "kind", "o.*").where("k >= 2")
    per = per.withColumn("residual", F.abs(F.col("said") - F.col("addends")))
    ok = F.col("residual") <= F.greatest(F.lit(tol_abs), F.abs("said") * tol_rel)
    return per.groupBy("doc_id").agg(
        *[F.count_if((F.col("kind") == k) & t).alias(f"{k}_{n}") for k in ("labeled", "inferred") for n, t in (("tested", F.lit(True)), ("passed", ok))],
        F.round(F.max(F.when(~ok, F.col("residual"))), 2).alias("worst_residual"),
    )


def articulation(docs: DataFrame, tol_abs: float = 2.0) -> DataFrame:
    """Whether net income and cash each stand in two tables with one value."""
    grp = F.when(F.col("label").rlike(NET_INCOME), "net_income").when(F.col("label").rlike(CASH), "cash")
    r = table_rows(docs).select("doc_id", "table_no", label(F.col("cells")).alias("label"), "cells").withColumn("grp", grp).where("grp IS NOT NULL").where(~F.col("label").rlike(NOT_SHARED))
    c = r.select("doc_id", "table_no", "grp", F.explode(F.slice("cells", F.lit(2), F.size("cells"))).alias("cell")).withColumn("v", num_lenient(F.col("cell"))).where("v IS NOT NULL")
    # In order of value a match of two tables, if any, is found between some row and the nearest row of another table.
    w = Window.partitionBy("doc_id", "grp").orderBy("v", "table_no")
    c = c.withColumns({"change": (F.lag("table_no").over(w) != F.col("table_no")).cast("int"), "pv": F.lag("v").over(w)})
    near = F.max(((F.col("change") == 1) & (F.col("v") - F.col("pv") <= tol_abs)).cast("int"))
    per = c.groupBy("doc_id", "grp").agg(F.coalesce(near, F.lit(0)).alias("hit"))
    return per.groupBy("doc_id").agg(F.count("*").alias("tested"), F.sum("hit").alias("matched")).withColumn("ratio", F.round(F.col("matched") / F.col("tested"), 6))


def cash_flow(docs: DataFrame) -> DataFrame:
    """The six cash-flow items of the consolidated statement and whether they add up within 0.2 %.

    The statement's range and the current period's column are carried by windows over the lines that
    can matter: titles of statements, header rows and rows of cash. The others leave within their row.
    """
    some = lambda x, *words: reduce(Column.__or__, [F.contains(x, F.lit(w)) for w in words])
    matters = lambda x: some(x, "合并现金流量表", "母公司现金流量表") | (x.startswith("|") & some(x, "项目", "现金"))  # noqa: E731  # every item has the last word
    kept = F.filter(F.transform(F.split("md", "\n"), lambda x: F.translate(x, " \t\r\u00a0\u3000", "")), matters)
    ls = docs.select("doc_id", F.substring("report_period", 1, 4).alias("year"), F.posexplode_outer(kept).alias("line_no", "s"))
    w = Window.partitionBy("doc_id").orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ls = ls.withColumn("begun", F.max(F.contains("s", F.lit("合并现金流量表"))).over(w))
    ls = ls.withColumn("inside", F.col("begun") & ~F.max(F.col("begun") & F.contains("s", F.lit("母公司现金流量表"))).over(w) & F.col("s").startswith("|"))
    ls = ls.withColumn("cells", F.when(F.col("inside"), F.split(F.trim(F.col("s"), F.lit("|")), r"\|")))
    head = F.array_contains("cells", "项目") & F.array_contains("cells", "附注")
    at = F.array_position(F.transform("cells", lambda c: F.contains(c, F.col("year"))), F.lit(True)) - 1
    ls = ls.withColumn("head", F.coalesce(head, F.lit(False)))
    ls = ls.withColumn("col", F.coalesce(F.last(F.when(F.col("head") & (at >= 0), at), ignorenulls=True).over(w), F.lit(2)).cast("int"))
    item: Column = F.lit(None).cast("string")
    for k, p in reversed(CASH_FLOW.items()):
        item = F.when(F.col("s").rlike(p), k).otherwise(item)
    ls = ls.withColumn("item", F.when(F.col("inside") & ~F.col("head") & (F.size("cells") > F.col("col")), item))
    amounts = F.filter(F.transform("cells", amount_cf), lambda v: v.isNotNull())
    ls = ls.withColumn("v", F.when(F.col("item").isNotNull(), F.coalesce(amount_cf(F.get("cells", F.col("col"))), F.get(amounts, F.lit(0)))))
    items = ls.groupBy("doc_id").agg(*[F.min_by("v", F.when((F.col("item") == k) & F.col("v").isNotNull(), F.col("line_no"))).alias(k) for k in CASH_FLOW])
    rhs = F.col("opening") + F.col("op") + F.col("inv") + F.col("fin") + F.coalesce("fx", F.lit(0.0))
    tol = F.greatest(F.abs("opening"), F.abs("closing"), F.lit(1.0)) * 0.002
    return items.select("doc_id", *CASH_FLOW, F.when(rhs.isNull() | F.col("closing").isNull(), "skip").when(F.abs(F.col("closing") - rhs) <= tol, "pass").otherwise("fail").alias("status"))


def labeled_rows(rows: DataFrame) -> DataFrame:
    """doc_id, table_no, row_no, label, facts: first filled cell is the label unless it is a number; the row's numbers are its facts."""
    first = F.get(F.filter("cells", lambda c: c != ""), F.lit(0))
    facts = F.filter(F.transform("cells", lambda c: F.struct(num_strict_cell(c).alias("value"), c.alias("text"))), lambda f: f["value"].isNotNull())
    r = rows.select("doc_id", "table_no", "row_no", first.alias("label"), facts.alias("facts"))
    return r.where((F.char_length("label") >= 2) & num_strict_cell(F.col("label")).isNull() & (F.size("facts") > 0))


def pipe_markdown(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Cells (keys, row_no, col_no, text) back to pipe tables: blanks kept, pipes escaped, rows padded, empty rows and columns dropped."""
    c = cells.withColumn("text", F.replace(F.coalesce("text", F.lit("")), F.lit("|"), F.lit("\\|")))
    full_col = c.where("text <> ''").select(*keys, "col_no").distinct()
    c = c.join(full_col, [*keys, "col_no"], "left_semi")
    cols = c.groupBy(*keys).agg(F.array_sort(F.collect_set("col_no")).alias("cols"))
    r = c.groupBy(*keys, "row_no").agg(F.map_from_entries(F.collect_list(F.struct("col_no", "text"))).alias("m"), F.max((F.col("text") != "").cast("int")).alias("filled")).where("filled = 1")
    line = F.concat(F.lit("| "), F.array_join(F.transform("cols", lambda k: F.coalesce(F.try_element_at("m", k), F.lit(""))), " | "), F.lit(" |"))
    r = r.join(cols, keys).withColumn("line", line).withColumn("rule", F.concat(F.lit("|"), F.repeat(F.lit(" --- |"), F.size("cols"))))
    t = r.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("row_no", "line"))).alias("ls"), F.first("rule").alias("rule")).where("size(ls) >= 2")
    body = F.transform("ls", lambda x: x["line"])
    return t.select(*keys, F.array_join(F.concat(F.slice(body, 1, 1), F.array("rule"), F.slice(body, F.lit(2), F.size(body) - 1)), "\n").alias("md"))
