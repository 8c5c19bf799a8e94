"""Mixing of sources to target shares of the total size, by temperature and budgeted block permutations.

Weights stand on the path between the target shares and the sources' natural shares of tokens,
w(x) ~ target^(1-x) * natural^x: the temperature exponent x is 0 where the targets can be met and
is bisected up to the least value at which no record is needed more than its cap for the asked
total. Without an asked total the total is the largest one at which x = 0 holds, so the targets
are met exactly, up to the size of one record per source. (With equal targets the path is the
usual exponent over natural shares.)

Weights become records by block permutations: records fall into blocks by a seeded hash, blocks are
taken in the order of another hash, whole while the source's budget lasts, and only the one block
at the edge is ordered record by record. A source of any size thus needs one small aggregate over
(source, block) and windows no longer than a block.

Defined results: sources are compared without case and outer spaces; documents without a source, or
of a source without target, and documents of no token (null, empty) are not used. A target source
without documents has no share; the targets of the others keep their proportions. Documents are
one row per id; repeated rows count once.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm import tokens

TOKENS_A_BLOCK = 2_000_000


def source_key(c: Column) -> Column:
    return F.nullif(F.lower(F.regexp_replace(c, r"^[\s　 ]+|[\s　 ]+$", "")), F.lit(""))


def sized(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, source, n_tokens of usable documents."""
    rows = docs.select("doc_id", "source", "text").where(F.col("text").isNotNull() & (F.col("text") != "") & F.col("source").isNotNull())
    d = rows.withColumn("_key", F.struct("doc_id", source_key(F.col("source")).alias("source")))
    counts = tokens.token_counts(d, "text", "_key", path)
    return counts.select("_key.doc_id", "_key.source", "n_tokens").where("n_tokens > 0 AND source IS NOT NULL").dropDuplicates(["doc_id"])


def temper(targets: dict[str, float], sizes: dict[str, int], repeats: dict[str, int], total: float | None = None, steps: int = 60) -> tuple[dict[str, float], float, float]:
    """Budgets in tokens by source, the exponent and the total. Only figures per source come in."""
    live = {s: t for s, t in targets.items() if t > 0 and sizes.get(s, 0) > 0 and repeats.get(s, 1) > 0}
    if not live:
        return {}, 0.0, 0.0
    all_ = sum(sizes[s] for s in live)
    most = {s: sizes[s] * repeats.get(s, 1) for s in live}

    def weights(x: float) -> dict[str, float]:
        raw = {s: math.exp((1 - x) * math.log(live[s]) + x * math.log(sizes[s] / all_)) for s in live}
        z = sum(raw.values())
        return {s: v / z for s, v in raw.items()}

    w = weights(0.0)
    if total is None:
        total = min(most[s] / w[s] for s in live)
    total = min(total, float(sum(most.values())))
    fits = lambda x: all(weights(x)[s] * total <= most[s] * (1 + 1e-9) for s in live)
    lo, hi = 0.0, 1.0
    if fits(0.0):
        hi = 0.0
    elif fits(1.0):
        for _ in range(steps):
            mid = (lo + hi) / 2
            lo, hi = (lo, mid) if fits(mid) else (mid, hi)
    # Where even the natural shares ask too much of a source, it gives all it has and the others fill up.
    w, budget, left, open_ = weights(hi), {}, total, dict.fromkeys(live)
    while open_:
        z = sum(w[s] for s in open_)
        full = [s for s in open_ if w[s] / z * left > most[s] * (1 + 1e-9)]
        if not full:
            budget |= {s: w[s] / z * left for s in open_}
            break
        for s in full:
            budget[s] = float(most[s])
            left -= most[s]
            del open_[s]
    return budget, hi, total


def plan(sizes: DataFrame, targets: DataFrame, total: float | None = None) -> DataFrame:
    """One row per target source: tokens there are, budget, whole passes, tokens of the part pass, exponent."""
    spark = sizes.sparkSession
    t = targets.select(source_key(F.col("source")).alias("source"), "target_share", "max_repeats").groupBy("source").agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    have = t.join(sizes.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs")), "source", "left")
    rows = [r for r in have.collect() if r["source"] is not None]  # one row per source of the target table
    budget, x, _ = temper({r["source"]: float(r["target_share"] or 0) for r in rows}, {r["source"]: int(r["tokens"] or 0) for r in rows}, {r["source"]: int(r["max_repeats"] or 0) for r in rows}, total)
    out = []
    for r in rows:
        have_, want = int(r["tokens"] or 0), budget.get(r["source"], 0.0)
        passes = min(int(want / have_ + 1e-9), int(r["max_repeats"] or 0)) if have_ else 0
        out.append((r["source"], float(r["target_share"] or 0), int(r["max_repeats"] or 0), have_, float(want), passes, float(max(0.0, want - passes * have_)) if passes < int(r["max_repeats"] or 0) else 0.0, float(x)))
    return spark.createDataFrame(out, "source string, target_share double, max_repeats int, tokens bigint, budget double, passes int, part double, exponent double")


def mixed(sizes: DataFrame, targets: DataFrame, total: float | None = None, seed: int = 17, block_tokens: int = TOKENS_A_BLOCK) -> DataFrame:
    """doc_id, source, n_tokens, uses of the chosen records. `sizes` is read twice: hand in a checkpoint of it."""
    p = plan(sizes, targets, total)
    blocks = F.greatest(F.lit(1), F.ceil(F.col("tokens") / F.lit(block_tokens)))
    d = sizes.join(F.broadcast(p.select("source", "tokens", "passes", "part")), "source")
    d = d.withColumn("_block", F.pmod(F.xxhash64("doc_id", F.lit(seed)), blocks))
    per = d.groupBy("source", "_block").agg(F.sum("n_tokens").alias("_size"), F.first("part").alias("part"))
    order = Window.partitionBy("source").orderBy(F.xxhash64("_block", F.lit(seed + 1)), "_block").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("_before", F.coalesce(F.sum("_size").over(order), F.lit(0)))
    per = per.select("source", "_block", F.when(F.col("_before") + F.col("_size") <= F.col("part"), 2).when(F.col("_before") < F.col("part"), 1).otherwise(0).alias("_take"), (F.col("part") - F.col("_before")).alias("_left"))
    d = d.join(per, ["source", "_block"])
    edge = d.where("_take = 1")
    within = Window.partitionBy("source", "_block").orderBy(F.xxhash64("doc_id", F.lit(seed + 2)), "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # A record at the edge is in if more than half of it is within the budget.
    edge = edge.withColumn("_in", (F.sum("n_tokens").over(within) - F.col("n_tokens") / 2 <= F.col("_left")).cast("int")).select("doc_id", "source", "n_tokens", "passes", "_in")
    rest = d.where("_take <> 1").select("doc_id", "source", "n_tokens", "passes", (F.col("_take") / 2).cast("int").alias("_in"))
    return rest.unionByName(edge).select("doc_id", "source", "n_tokens", (F.col("passes") + F.col("_in")).alias("uses")).where("uses > 0")


def shares(chosen: DataFrame, targets: DataFrame) -> DataFrame:
    """One row per target source: target share, tokens used, actual share, records, most uses of one record."""
    t = targets.select(source_key(F.col("source")).alias("source"), "target_share", "max_repeats")
    got = chosen.groupBy("source").agg(
        F.sum(F.col("n_tokens") * F.col("uses")).alias("used_tokens"), F.count("*").alias("records"), F.max("uses").alias("most_uses")
    )
    all_ = got.agg(F.sum("used_tokens").alias("all_tokens"))
    j = t.join(got, "source", "left").join(F.broadcast(all_))  # one row
    return j.select(
        "source", "target_share", "max_repeats",
        F.coalesce("used_tokens", F.lit(0)).alias("used_tokens"), F.coalesce("records", F.lit(0)).alias("records"), F.coalesce("most_uses", F.lit(0)).alias("most_uses"),
        F.coalesce(F.try_divide("used_tokens", "all_tokens"), F.lit(0.0)).alias("actual_share"),
    )
