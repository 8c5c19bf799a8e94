"""Relations derived from the star-schema tables inside a query: ledgers, statements and cash flows as Markdown.

Amounts are whole cents; faults are put in by the key, so what must fail is known.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import table


def filings(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "filing_md").dropDuplicates(["doc_id"])


def cents(c: str):
    return F.round(F.col(c) * 100).cast("bigint")


def ledgers(spark: SparkSession, d: str) -> DataFrame:
    """One pipe table per order with a total row; key % 5 = 1 wrong total, 2 a cell too many, 3 no total."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.round("l_quantity").cast("bigint").alias("q"), cents("l_extendedprice").alias("a"))
    per = li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "q", "a"))).alias("ls"), F.sum("q").alias("tq"), F.sum("a").alias("ta"))
    k = F.col("l_orderkey") % 5
    rows = F.array_join(F.transform("ls", lambda x: F.concat(F.lit("| item "), x["l_linenumber"], F.lit(" | "), x["q"], F.lit(" | "), x["a"], F.lit(" |"))), "\n")
    total = F.concat(F.lit("\n| total | "), F.col("tq"), F.lit(" | "), F.col("ta") + F.when(k == 1, F.col("ta") + 1000).otherwise(0), F.when(k == 2, F.lit(" | x |")).otherwise(F.lit(" |")))
    md = F.concat(F.lit("| item | qty | amount |\n| --- | --- | --- |\n"), rows, F.when(k == 3, F.lit("")).otherwise(total), F.lit("\n"))
    return per.select(F.col("l_orderkey").alias("doc_id"), md.alias("md"))


def statements(spark: SparkSession, d: str) -> DataFrame:
    """Balance sheet over two tables and a cash statement per customer; key % 7 = 3 assets off by 2, 5 no liabilities, key % 3 the wording."""
    c = table(spark, d, "customer").select("c_custkey", F.abs(cents("c_acctbal")).alias("a"))
    k = F.col("c_custkey")
    pick = lambda x, y, z: F.when(k % 3 == 0, x).when(k % 3 == 1, y).otherwise(z)
    liab, eq = F.col("a") + 1000, F.col("a") * 2 + 7
    asset = liab + eq + F.when(k % 7 == 3, 2).otherwise(0)
    row = lambda name, v: F.concat(F.lit("\n| "), name, F.lit(" | "), v.cast("string"), F.lit(" |"))
    head = "| 项目 | 金额 |\n| --- | --- |"
    md = F.concat(
        F.lit(head), row(F.lit("存货"), F.lit(5)), row(pick("资产总计", "資産の部合計", "資產總計"), asset), F.lit("\n\ntext\n\n" + head),
        F.when(k % 7 == 5, row(F.lit("其他"), F.lit(1))).otherwise(row(pick("负债合计", "負債の部合計", "負債總計"), liab)),
        row(F.lit("归属于母公司所有者权益合计"), F.lit(3)), row(pick("所有者权益合计", "純資産の部合計", "權益總計"), eq),
        row(pick("货币资金", "現金及び預金", "現金及約當現金"), F.col("a")), F.lit("\n\n" + head), row(pick("净利润", "当期純利益", "淨利"), F.col("a") + 11),
        row(pick("货币资金", "現金及び預金", "現金及約當現金"), F.col("a") + F.when(k % 5 == 2, 900).otherwise(0)), F.lit("\n"),
    )
    return c.select(F.col("c_custkey").alias("doc_id"), pick("cn", "jp", "tw").alias("market"), md.alias("md"))


def cash_flows(spark: SparkSession, d: str) -> DataFrame:
    """A consolidated and a parent cash-flow statement per order; key % 6 = 1 no exchange row, 2 an item missing, 4 off balance; odd keys have the year columns swapped."""
    o = table(spark, d, "orders").select("o_orderkey", cents("o_totalprice").alias("t"), F.year("o_orderdate").alias("y"))
    k = F.col("o_orderkey")
    op, inv, fin, fx, opening = F.col("t"), -F.floor(F.col("t") / 3), -F.floor(F.col("t") / 5), F.lit(17), F.col("t") * 2
    closing = opening + op + inv + fin + F.when(k % 6 == 1, 0).otherwise(fx) + F.when(k % 6 == 4, F.col("t")).otherwise(0)
    num = lambda v: F.when(v < 0, F.concat(F.lit("("), F.abs(v).cast("string"), F.lit(")"))).otherwise(v.cast("string"))

    def row(name: str, v):
        other = num(v + 1)
        return F.concat(F.lit(f"| {name} | 1 | "), F.when(k % 2 == 1, F.concat(other, F.lit(" | "), num(v))).otherwise(F.concat(num(v), F.lit(" | "), other)), F.lit(" |\n"))

    y = F.col("y")
    years = F.when(k % 2 == 1, F.concat(y - 1, F.lit("年度 | "), y, F.lit("年度"))).otherwise(F.concat(y, F.lit("年度 | "), y - 1, F.lit("年度")))
    md = F.concat(
        F.lit("合并 现金流量表\n| 项目 | 附注 | "), years, F.lit(" |\n| --- | --- | --- | --- |\n"), row("经营活动产生的现金流量净额", op),
        F.when(k % 6 == 2, F.lit("")).otherwise(row("投资活动产生的现金流量净额", inv)), row("筹资活动产生的现金流量净额", fin),
        F.when(k % 6 == 1, F.lit("")).otherwise(row("四、汇率变动对现金及现金等价物的影响", fx)), row("加:期初现金及现金等价物余额", opening), row("六、期末现金及现金等价物余额", closing),
        F.lit("母公司现金流量表\n"), row("经营活动产生的现金流量净额", F.lit(1)),
    )
    return o.select(F.col("o_orderkey").alias("doc_id"), F.concat(y, F.lit("-12-31")).alias("report_period"), md.alias("md"))
