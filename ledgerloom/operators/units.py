"""Amounts in many units and scales, brought to the base unit of their dimension. SQL expressions only.

The number and the unit printed in the text come out by regexp_extract; spellings are reduced to a
key and matched to unit codes by a join with the alias table; the unit is the first of the unit
field, the unit in the text, and the source's default; then factor (and offset, where a dimension
has one) apply.

Defined results: a null value is read from the printed text (its first number), else the amount is null. An unknown or missing unit gives null unit, dimension and amount unless a default
is named. A scale that is null, blank or no integer counts as 0. Rows that come twice count once.
An empty table gives an empty result; other columns are ignored, whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import cut

#: Spellings of units met in filings, after spelling_key(), by unit code.
UNIT_ALIASES = {
    "jpy": "jpy yen 円 ¥ jpyen 日本円",
    "jpy_thousand": "kjpy jpythousand jpythousands thousandyen 千円 jpyinthousands ¥thousand 単位千円 jpyk jpythousandyen ¥inthousands thousandsofyen",
    "jpy_million": "jpymillion jpymillions jpymn millionyen 百万円 ¥million 単位百万円 jpyinmillions ¥mn mjpy ¥inmillions millionsofyen jpym",
    "jpy_hundred_million": "jpyoku 100millionyen 億円 単位億円 jpy100million jpyin100millions ¥100million hundredmillionyen",
    "usd": "usd us$ 米ドル ドル usdollars usdollar $",
    "usd_thousand": "usdthousand usdthousands us$thousand us$thousands thousandus$ 千米ドル 単位千米ドル 千ドル us$inthousands usdinthousands kusd thousandusd",
    "usd_million": "usdmillion usdmillions us$million us$millions us$mn usdmn 百万米ドル 単位百万米ドル 百万ドル us$inmillions usdinmillions musd millionus$ millionusd",
    "share": "share shares 株 単位株",
    "share_thousand": "sharethousand thousandshare thousandshares 千株 単位千株 sharesthousand sharesinthousands",
    "pure": "pure",
    "percent": "percent pct % パーセント percentage 単位%",
    "basis_point": "basispoint basispoints bps bp ベーシスポイント",
    "square_metre": "squaremetre squaremetres squaremeter squaremeters m2 m² ㎡ sqm 平方メートル 平米",
    "hectare": "ha hectare hectares ヘクタール",
    "tsubo": "tsubo 坪",
    "kilogram": "kg kilogram kilograms キログラム ㎏",
    "tonne": "t tonne tonnes トン ton tons metrictons",
    "kilotonne": "kt kilotonne kilotonnes 千トン thousandtonnes",
    "kilowatt_hour": "kwh kilowatthour kilowatthours キロワット時",
    "megawatt_hour": "mwh megawatthour megawatthours メガワット時",
    "gigajoule": "gj gigajoule gigajoules ギガジュール",
}
#: Full-width forms and their plain ones.
WIDE = "".join(chr(0xFF01 + i) for i in range(94)) + "　−"
PLAIN = "".join(chr(0x21 + i) for i in range(94)) + " -"
NUMBER = r"[0-9][0-9,]*(?:\.[0-9]+)?|\.[0-9]+"


def fold(c: Column) -> Column:
    """Full-width ASCII, wide spaces and minus signs in their plain form."""
    return F.translate(c, WIDE, PLAIN)


def spelling_key(c: Column) -> Column:
    """A unit's spelling without case, width, name space, spacing, brackets and sign marks."""
    s = F.lower(fold(c))
    s = F.regexp_replace(s, r"^\s*(?:iso4217|xbrli|utr)\s*:", "")
    s = F.regexp_replace(s, r"[\s _()\[\]:△▲+*/'\"-]", "")
    return F.nullif(F.regexp_replace(s, r"^[.,]+|[.,]+$", ""), F.lit(""))


def printed_number(text: Column) -> Column:
    """The first number of a text with its sign; null if it has none."""
    t = fold(text)
    digits = F.regexp_extract(t, f"({NUMBER})", 1)
    n = F.regexp_replace(digits, ",", "").try_cast("double")
    negative = t.rlike(rf"(?:[△▲-]\s*|\(\s*)(?:{NUMBER})") & ~t.rlike(r"\)\s*(?:[0-9]|\.[0-9])")
    return F.when(negative, -n).otherwise(n)


def printed_unit_key(text: Column) -> Column:
    """The key of what a text holds besides its first number."""
    return spelling_key(F.regexp_replace(fold(text), rf"^([^0-9]*?)(?:{NUMBER})", "$1"))


def alias_table(spark: SparkSession, units: DataFrame) -> DataFrame:
    """spelling -> unit row. The spellings are a fixed list, so the table is small whatever the data."""
    rows = [(k, code) for code, keys in UNIT_ALIASES.items() for k in dict.fromkeys([*keys.split(), code.replace("_", "")])]
    known = units.select("unit_code", "dimension", "base_unit", "factor").dropDuplicates(["unit_code"])
    return spark.createDataFrame(rows, "unit_key string, unit_code string").join(F.broadcast(known), "unit_code")


def based(facts: DataFrame, units: DataFrame, defaults: DataFrame | None = None, offsets: dict[str, float] | None = None) -> DataFrame:
    """One row per row of a numeric fact: its unit, dimension and amount in the base unit. No shuffle but for defaults.

    defaults: (concept, unit_code), the unit that a source leaves out. offsets: by unit code, added after the factor.
    """
    spark = facts.sparkSession
    alias = F.broadcast(alias_table(spark, units).select("unit_key", "unit_code"))  # size bound: the fixed list of spellings
    codes = F.broadcast(units.select("unit_code", "dimension", "base_unit", "factor").dropDuplicates(["unit_code"]))  # and its unit codes
    f = facts.where(F.col("kind") == "num").select(
        "fact_id", "doc_id", "concept", "context_ref", "value",
        F.coalesce(F.col("scale").try_cast("int"), F.lit(0)).alias("shift"),
        spelling_key(F.col("unit_ref")).alias("field_key"),
        printed_unit_key(F.col("text")).alias("text_key"),
        F.coalesce("value", printed_number(F.col("text"))).alias("number"),
    )
    f = f.join(alias.withColumnsRenamed({"unit_key": "field_key", "unit_code": "field_unit"}), "field_key", "left")
    f = f.join(alias.withColumnsRenamed({"unit_key": "text_key", "unit_code": "text_unit"}), "text_key", "left")
    if defaults is not None:
        d = defaults.select("concept", F.col("unit_code").alias("default_unit")).dropDuplicates(["concept"])
        f = f.join(d, "concept", "left")
    else:
        f = f.withColumn("default_unit", F.lit(None).cast("string"))
    f = f.withColumn("unit_code", F.coalesce("field_unit", "text_unit", "default_unit")).join(codes, "unit_code", "left")
    amount = F.col("number") * F.pow(F.lit(10.0), F.col("shift")) * F.col("factor")
    for code, by in (offsets or {}).items():
        amount = F.when(F.col("unit_code") == code, amount + F.lit(by)).otherwise(amount)
    return f.select("fact_id", "doc_id", "concept", "context_ref", "value", "unit_code", "dimension", "base_unit", amount.alias("amount"))


def in_base_units(facts: DataFrame, units: DataFrame, defaults: DataFrame | None = None, offsets: dict[str, float] | None = None) -> DataFrame:
    """based() with one row per fact."""
    return based(facts, units, defaults, offsets).dropDuplicates(["fact_id"])


def equal_amounts(amounts: DataFrame, stated: DataFrame | None = None, tolerance: float = 1e-5) -> DataFrame:
    """Pairs of facts of one filing, concept and context that state one amount by different values.

    Groups of one value make no pair. Which groups have several is asked of `stated` (the facts, or
    else the amounts) by an aggregate, before which the rows of a hot group fall together; only
    those go on to the band join. That is an equality join on logarithmic bins more than twice as
    wide as the tolerance: each left row looks into its own bin and the nearer one beside it.
    Groups are shuffled by the digest of their names.
    """
    named = (F.coalesce("context_ref", F.lit("")) != "") & F.col("doc_id").isNotNull() & F.col("concept").isNotNull() & F.col("value").isNotNull()
    group = F.unhex(F.md5(F.concat_ws("\x1f", "doc_id", "concept", "context_ref"))).alias("group")
    several = (
        (amounts if stated is None else stated).where(named).select(group, "value")
        .groupBy("group").agg(F.min("value").alias("least"), F.max("value").alias("most")).where("least < most").select("group")
    )
    place = F.log(F.abs("amount")) / F.lit(2.1 * tolerance)
    a = amounts.where(named & F.col("amount").isNotNull() & ~F.isnan("amount") & (F.col("amount") != 0)).select(
        group, "fact_id", "value", "amount", F.xxhash64("dimension").alias("dim"), F.floor(place).alias("bin"), (place - F.floor(place) < 0.5).alias("low"),
    )
    a = cut(a.join(several, "group", "left_semi"))  # two readers, one pass over the facts
    key = ["group", "dim", "bin"]
    bins = F.explode(F.array(F.col("bin"), F.col("bin") + F.when(F.col("low"), -1).otherwise(1))).alias("bin")
    left = a.select("group", "dim", F.col("fact_id").alias("l"), F.col("value").alias("lv"), F.col("amount").alias("la"), bins)
    right = a.select(*key, F.col("fact_id").alias("r"), F.col("value").alias("rv"), F.col("amount").alias("ra"))
    same = F.abs(F.col("la") - F.col("ra")) <= F.lit(tolerance) * F.greatest(F.abs("la"), F.abs("ra"))
    pairs = left.join(right, key).where((F.col("l") < F.col("r")) & (F.col("lv") != F.col("rv")) & same)
    return pairs.select(F.col("l").alias("left_id"), F.col("r").alias("right_id")).distinct()
