"""Temperature mixing of sources to target weights.

A source's share of all words is raised to an exponent between 0 (equal weights) and 1 (as found) and
normalised. The exponent is bisected until the weights reach a target entropy or the most repeated source
reaches a repetition limit. Each pass compares a grid of exponents in one aggregate over the sources, so
their number is not bounded by the driver. The weights are then realised: each source is dealt into blocks,
its blocks follow a keyed permutation, and whole epochs of the permutation run until the source's word
budget is used up; the last epoch stops inside a block.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, cut, spare

GRID, PASSES = 16, 6
#: Key of the permutations.
SEED = 17
#: Rows in a block, on average.
BLOCK = 4096


def n_words(text="text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text) if isinstance(text, str) else text, F.lit(WORD)), F.lit(0)).cast("long")


def source_totals(rows: DataFrame) -> DataFrame:
    """(source, n_rows, n_words) of each source; null is a source."""
    return rows.groupBy("source").agg(F.count("*").alias("n_rows"), F.sum("n_words").alias("n_words"))


def find_exponent(sources: DataFrame, target_entropy: float | None = None, repetition_limit: float | None = None) -> float:
    """The largest exponent in [0, 1] whose weights have the target entropy (bits) at least, or the least whose
    most repeated source is repeated repetition_limit times at most while none is cut short.

    Entropy falls and repetition falls as the exponent grows; sources without words take no part. A target beyond
    reach gives the nearest end: 0 for an entropy above log2 of the sources, 1 for a limit of 1.
    """
    if (target_entropy is None) == (repetition_limit is None):
        raise ValueError("give a target entropy or a repetition limit")
    live = sources.where("n_words > 0")
    top = live.agg(F.sum("n_words").alias("all"), F.max("n_words").alias("most"), F.min("n_words").alias("least")).first()
    if not top["all"]:
        return 1.0
    low, high = 0.0, 1.0
    share = F.col("n_words") / F.lit(float(top["all"]))
    for _ in range(PASSES):
        grid = [low + (high - low) * k / GRID for k in range(GRID + 1)]
        if repetition_limit is not None:
            # the largest source has the smallest weight for its share; at one epoch of it the smallest source has most
            good = [(top["most"] / top["least"]) ** (1 - a) <= repetition_limit for a in grid]
            first = next((k for k, x in enumerate(good) if x), GRID)
            low, high = grid[max(0, first - 1)], grid[first]
        else:
            powers = [F.pow(share, F.lit(a)) for a in grid]
            row = live.agg(*[F.sum(p).alias(f"z{k}") for k, p in enumerate(powers)], *[F.sum(p * F.log2(p)).alias(f"e{k}") for k, p in enumerate(powers)]).first()
            entropy = [math.log2(row[f"z{k}"]) - row[f"e{k}"] / row[f"z{k}"] for k in range(GRID + 1)]
            last = max((k for k, e in enumerate(entropy) if e >= target_entropy), default=0)
            low, high = grid[last], grid[min(GRID, last + 1)]
    return high if repetition_limit is not None else low


def weights(sources: DataFrame, exponent: float, budget: float | None = None) -> DataFrame:
    """Adds weight, budget_words and epochs (budget over words) to sources.

    budget is in words; by default the largest source is passed exactly once, so no source is cut short.
    Sources without words get weight 0 and one epoch: their rows stay as they are.
    """
    totals = sources.agg(F.sum("n_words").alias("t"), F.max("n_words").alias("m")).first()
    total, most = totals["t"] or 1, totals["m"] or 1
    norm = sources.where("n_words > 0").agg(F.sum(F.pow(F.col("n_words") / F.lit(float(total)), F.lit(exponent)))).first()[0] or 1.0
    if budget is None:
        budget = most / ((most / total) ** exponent / norm)
    weight = F.when(F.col("n_words") > 0, F.pow(F.col("n_words") / F.lit(float(total)), F.lit(exponent)) / F.lit(norm)).otherwise(0.0)
    rows = sources.withColumn("weight", weight).withColumn("budget_words", F.round(F.col("weight") * F.lit(float(budget))).cast("long"))
    return rows.withColumn("epochs", F.when(F.col("n_words") > 0, F.col("budget_words") / F.col("n_words")).otherwise(1.0))


ADDED = ["_epoch", "_block", "_place", "_weight", "_words"]


def schedule(docs: DataFrame, exponent: float | None = None, target_entropy: float | None = None, repetition_limit: float | None = 2.0, budget: float | None = None, seed: int = SEED, block: int = BLOCK) -> DataFrame:
    """docs with all its columns once for each pass over a row, and _epoch, _block, _place, _weight, _words.

    _epoch counts from 0; a source's rows in one epoch follow (_block, _place), a permutation keyed by seed. A
    row belongs to the last, partial epoch if the words before it in that epoch's order are below what is left
    of the source's budget. Rows without a word add nothing to budgets; they pass in whole epochs, and in the
    partial one by the same rule. Null texts have no words; a null source is a source; repeated rows are
    rows of their own. Where docs has a column of such a name, the added one has underscores appended. No window
    holds more than a block or one source's block totals.
    """
    names, hidden = docs.columns, [f"c{k}" for k in range(len(docs.columns))]
    doc_id, text, source = (hidden[names.index(c)] for c in ("doc_id", "text", "source"))
    rows = docs.toDF(*hidden).withColumn("_words", n_words(text)).withColumn("_key", keyed(seed, doc_id, text))
    small = cut(rows.select(F.col(source).alias("source"), F.col("_words").alias("n_words"), "_key"))
    sources = cut(source_totals(small))
    if exponent is None:
        exponent = find_exponent(sources, target_entropy, None if target_entropy is not None else repetition_limit)
    plan = weights(sources, exponent, budget).select(F.col("source").alias("_source"), F.col("weight").alias("_weight"), F.col("budget_words").alias("_budget"), F.col("n_words").alias("_total"), F.greatest(F.ceil(F.col("n_rows") / block), F.lit(1)).alias("_blocks"))
    plan = few(cut(plan))
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    dealt = small.join(plan, same("source", "_source")).withColumn("_block", block_of())
    sums = dealt.groupBy("_source", "_block").agg(F.sum("n_words").alias("_sum"), F.max("_total").alias("_total"), F.max("_budget").alias("_budget"))
    # blocks in permuted order; what each may still spend in the partial epoch
    order = W.partitionBy("_source").orderBy(F.md5(F.concat_ws("|", F.lit(seed), F.lit("block"), "_block")), "_block")
    rest = F.when(F.col("_total") > 0, F.pmod("_budget", "_total")).otherwise(0)
    before = few(cut(sums.select(F.col("_source").alias("_s"), F.col("_block").alias("_b"), F.row_number().over(order).alias("_turn"), (rest - F.sum("_sum").over(order) + F.col("_sum")).alias("_left"))))
    ranked = rows.join(plan, same(source, "_source")).withColumn("_block", block_of())
    ranked = ranked.join(before, same("_source", "_s") & (F.col("_block") == F.col("_b")))
    whole = F.when(F.col("_total") > 0, F.floor(F.col("_budget") / F.greatest("_total", F.lit(1)))).otherwise(1).cast("int")
    within = W.partitionBy("_source", "_block").orderBy("_key", doc_id)
    ranked = ranked.withColumn("_place", F.row_number().over(within)).withColumn("_spent", F.sum("_words").over(within.rowsBetween(W.unboundedPreceding, 0)) - F.col("_words"))
    passes = whole + F.when((F.col("_left") > 0) & (F.col("_spent") < F.col("_left")), 1).otherwise(0)
    out = ranked.withColumn("_passes", passes).where("_passes > 0").withColumn("_epoch", F.explode(F.sequence(F.lit(0), F.col("_passes") - 1)))
    return out.select(*hidden, "_epoch", F.col("_turn").alias("_block"), "_place", "_weight", "_words").toDF(*names, *spare(docs, *ADDED))


#: Rows of a per-source or per-block table that may be broadcast; a larger one joins by shuffle.
FEW = 100_000


def few(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= FEW else df


def keyed(seed: int, doc_id: str, text: str) -> Column:
    """60 bits that place a row in its source's permutation; rows of equal id and text tie, and are alike."""
    whole = F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit("|"), F.coalesce(F.col(text), F.lit("")))
    return F.conv(F.left(F.md5(F.encode(whole, "UTF-8")), F.lit(15)), 16, 10).cast("long")


def block_of() -> Column:
    return F.pmod("_key", F.col("_blocks")).cast("int")
