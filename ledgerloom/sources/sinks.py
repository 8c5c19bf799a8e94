"""Sinks: Markdown with front matter, JSON lines, partitioned results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.filings import to_front_matter


def with_front_matter(docs: DataFrame, fields: list[str], body: str = "md") -> DataFrame:
    """doc_id, md: the text under the front matter of its fields, runs of blank lines squeezed."""
    md = F.concat(to_front_matter({f: F.col(f).cast("string") for f in fields}), F.regexp_replace(F.coalesce(body, F.lit("")), r"\n{3,}", "\n\n"))
    return docs.select("doc_id", md.alias("md"))


def append_json(df: DataFrame, path: str, variant: str) -> None:
    df.withColumn("variant", F.lit(variant)).write.mode("append").partitionBy("variant").json(path)


def append_good(df: DataFrame, path: str) -> None:
    """Only rows without an error are kept; failures are asked again next time."""
    df.where("error IS NULL").drop("error").write.mode("append").parquet(path)
