"""Page layout from stored relations: what an extractor of PDF pages writes is read here, with its types checked."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BOX = "x0 double, y0 double, x1 double, y1 double"
#: The relations of a layout folder and their columns.
RELATIONS = {
    "words": f"doc_id bigint, page_no int, seq int, {BOX}, text string",
    "blocks": f"doc_id bigint, page_no int, seq int, {BOX}, height double, size double, font string, text string",
    "rules": f"doc_id bigint, page_no int, seq int, kind string, {BOX}, width double",
    "tables": f"doc_id bigint, page_no int, table_no int, {BOX}, height double, grid array<array<string>>",
}


def layout_relation(spark: SparkSession, path: str, name: str, form: str = "parquet") -> DataFrame:
    """One relation of the layout folder `path`, stored as Parquet or JSON lines; missing columns are null, others are left out."""
    want = T._parse_datatype_string(RELATIONS[name])
    if form == "json":
        return spark.read.schema(want).json(f"{path}/{name}")
    got = spark.read.parquet(f"{path}/{name}")
    return got.select(*[(F.col(f.name) if f.name in got.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in want.fields])
