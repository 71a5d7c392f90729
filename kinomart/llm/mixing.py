"""Mixing sources to target weights by temperature.

The token shares of the sources are raised to an exponent and normalised. The exponent is found by
bisection, so that the weights have a wanted entropy or no source is repeated more often than
allowed. Each source then gets its part of the token budget: whole passes over its documents, and
for the rest a prefix of a permutation of them, found block by block.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinomart.llm.common import WORD, stored

STEPS = 30
#: Blocks aim at this many tokens, and there are never more than this many.
BLOCK_TOKENS, MAX_BLOCKS = 1_000_000, 100_000


def tokens(text: str = "text") -> Column:
    """Words of a text; none for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def label(source: str = "source") -> Column:
    return F.coalesce(F.col(source).cast("string"), F.lit(""))


def order(seed: int) -> Column:
    """The place of a document in its source's permutation: a hash in hex."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))


def _at(exponent: float) -> Column:
    return F.pow(F.col("share"), F.lit(float(exponent)))


def exponent(
    shares: DataFrame, budget_share: float, max_repetition: float | None, target_entropy: float | None
) -> float:
    """The exponent for sources with positive `share`s.

    With `target_entropy` (in nats), the exponent from 0 (all alike) to 8 whose weights have it;
    beyond reach, the nearer end. Else the smallest one from 0 to 1 at which no source is asked for
    more than `max_repetition` times its tokens; 1 if that can't be met. Each step of the bisection
    is a sum over the sources, however many these are.
    """
    low, high = 0.0, 8.0 if target_entropy is not None else 1.0
    for _ in range(STEPS):
        middle = (low + high) / 2
        weights = shares.agg(
            F.sum(_at(middle)).alias("z"),
            F.sum(_at(middle) * F.log(_at(middle))).alias("e"),
            F.max(_at(middle) / F.col("share")).alias("top"),
        ).first()
        if target_entropy is not None:
            flat = math.log(weights.z) - weights.e / weights.z > target_entropy
            low, high = (middle, high) if flat else (low, middle)
        else:
            over = budget_share * weights.top / weights.z > max_repetition
            low, high = (middle, high) if over else (low, middle)
    return high


def plan(
    docs: DataFrame,
    budget_share: float = 1.0,
    max_repetition: float | None = 2.0,
    target_entropy: float | None = None,
    seed: int = 17,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """source, n_blocks, weight, quota, passes, open, cut_order, cut_id: one row per source with tokens.

    `passes` whole passes, and one more over the blocks before `open` and the documents of that block
    up to (cut_order, cut_id) in the order of the permutation; nulls there mean none. The last pass stops before the document that would
    exceed the quota.
    """
    marks = stored(docs.select("doc_id", label().alias("source"), tokens().alias("n"), order(seed).alias("o")))
    sums = marks.groupBy("source").agg(F.sum("n").alias("t")).where("t > 0")
    sizes = stored(sums)
    whole = sizes.agg(F.sum("t").alias("t")).first().t or 0
    if not whole:
        return sizes.select(
            "source",
            *[
                F.lit(None).cast(kind).alias(name)
                for name, kind in (
                    ("n_blocks", "long"),
                    ("weight", "double"),
                    ("quota", "long"),
                    ("passes", "long"),
                    ("open", "long"),
                    ("cut_order", "string"),
                    ("cut_id", "long"),
                )
            ],
        )
    shares = stored(sizes.withColumn("share", F.col("t") / F.lit(float(whole))))
    a = exponent(shares, budget_share, max_repetition, target_entropy)
    z = shares.agg(F.sum(_at(a)).alias("z")).first().z
    block = max(block_tokens, -(-whole // MAX_BLOCKS))
    quotas = stored(
        shares.select(
            "source",
            "t",
            F.ceil(F.col("t") / block).cast("long").alias("n_blocks"),
            (_at(a) / F.lit(z)).alias("weight"),
        )
        .withColumn("quota", F.floor(F.col("weight") * F.lit(budget_share * whole)).cast("long"))
        .withColumn("passes", F.expr("quota div t"))
        .withColumn("rest", F.expr("quota % t"))
    )
    placed = marks.join(quotas.select("source", "n_blocks"), "source").withColumn("block", block_of())
    blocks = placed.groupBy("source", "block").agg(F.sum("n").alias("n"))
    # At most MAX_BLOCKS and one per source; the documents themselves are never in this window.
    ahead = F.sum("n").over(Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    open_block = (
        blocks.withColumn("ahead", F.coalesce(ahead, F.lit(0)))
        .join(quotas.select("source", "rest"), "source")
        .where("rest > 0 and ahead <= rest")
        .groupBy("source")
        .agg(F.max(F.struct("block", F.expr("rest - ahead").alias("room"))).alias("last"))
        .select("source", "last.block", "last.room")
    )
    inside = F.sum("n").over(
        Window.partitionBy("source", "block").orderBy("o", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    )
    cuts = (
        placed.join(stored(open_block), ["source", "block"])
        .withColumn("used", inside)
        .where("used <= room")
        .groupBy("source")
        .agg(F.max(F.struct("o", "doc_id")).alias("cut"))
        .select("source", F.col("cut.o").alias("cut_order"), F.col("cut.doc_id").alias("cut_id"))
    )
    # Where the open block takes none, the cut is the end of the block before it.
    before = open_block.select("source", F.col("block").alias("open"))
    return (
        quotas.join(cuts, "source", "left")
        .join(before, "source", "left")
        .select("source", "n_blocks", "weight", "quota", "passes", "open", "cut_order", "cut_id")
    )


def block_of() -> Column:
    """The block of a document: its order as a fraction, in as many parts as its source has blocks."""
    return F.floor(F.conv(F.substring("o", 1, 8), 16, 10).cast("long") / F.lit(2.0**32) * F.col("n_blocks")).cast("long")


def mix(docs: DataFrame, seed: int = 17, **settings) -> DataFrame:
    """The columns of `docs`, then _epoch (from 0) and _block: one row per use of a document.

    A row is used in each whole pass of its source, and in the last pass up to the source's cut.
    Null sources are one source without a name; documents without tokens cost nothing and follow
    their source; sources without tokens are left out. Rows of one source and doc_id share a place
    in the permutation; of those at the cut, which cost the same, all stay. No rows give no rows.
    """
    settings["seed"] = seed
    goal = stored(plan(docs, **settings))
    rows = docs.select(F.struct(*docs.columns).alias("row"), label().alias("source"), "doc_id", order(seed).alias("o"))
    planned = rows.join(goal, "source").withColumn("block", block_of())
    cut = F.coalesce(
        (F.col("block") < F.col("open"))
        | (
            (F.col("block") == F.col("open"))
            & ((F.col("o") < F.col("cut_order")) | ((F.col("o") == F.col("cut_order")) & F.col("doc_id").eqNullSafe(F.col("cut_id"))))
        ),
        F.lit(False),
    )
    uses = F.col("passes") + cut.cast("long")
    used = planned.withColumn("uses", uses).where("uses > 0")
    return used.select("row", "block", F.explode(F.expr("sequence(0L, uses - 1)")).alias("use")).select(
        *[F.col(f"row.{c}").alias(c) for c in docs.columns if c not in ("_epoch", "_block")],
        F.col("use").alias("_epoch"),
        F.col("block").alias("_block"),
    )


def with_places(mixed: DataFrame, seed: int = 17) -> DataFrame:
    """The columns of `mixed` (doc_id, source, _epoch, _block) and _place: where each use stands among its
    source's uses of that epoch, from 1.

    Every epoch has its own permutation of the blocks, and of the documents within each block. Uses are numbered
    within a part of their block; the parts ahead, few enough to be counted in one window, are added. Rows of one source
    and doc_id are neighbours in no fixed order. A column _place of `mixed` is replaced.
    """
    keys = ["source", "_epoch", "_block", "part"]

    def drawn(*parts: Column) -> Column:
        return F.md5(F.concat_ws(":", F.lit(seed), F.col("_epoch"), *parts).cast("binary"))

    mixed = mixed.drop("_place")
    # A block's documents are numbered in 16 parts, by the first digit of their draw.
    dealt = mixed.withColumn("draw", drawn(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).withColumn("part", F.substring("draw", 1, 1))
    inside = Window.partitionBy(*keys).orderBy("draw", "doc_id")
    # Blocks hold a bounded number of tokens, and there are at most MAX_BLOCKS and one per source.
    sizes = dealt.groupBy(*keys).agg(F.count("*").alias("uses"))
    turn = Window.partitionBy("source", "_epoch").orderBy(drawn(label(), F.col("_block")), "part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = stored(sizes.select(*[F.col(k).alias(f"of_{k}") for k in keys], F.coalesce(F.sum("uses").over(turn), F.lit(0)).alias("ahead")))
    same = [F.col(k).eqNullSafe(F.col(f"of_{k}")) for k in keys]
    return (
        dealt.withColumn("_place", F.row_number().over(inside))
        .join(ahead, same)
        .select(*mixed.columns, (F.col("ahead") + F.col("_place")).alias("_place"))
    )
