"""Items that appear together, with their ratio to chance.

Large-basket blocking: a basket of more than ``block`` items is split into
item chunks and its chunk-pair products are spread over tasks; ordinary
baskets list their pairs directly, identical ones once with a weight.

Two exact prunings keep the products small.  An item in fewer than
``min_support`` baskets, or in more than ``N / min_lift``, is in no result.
And a pair that never meets in an ordinary basket must meet ``min_support``
times in large ones, so only items in that many large baskets enter the
chunk products; for all other pairs the number of common large baskets is
the intersection of the two items' short lists of large baskets.

Defined cases: NULL or blank baskets and items do not count, repeated rows
count once, a basket of one item has no pair but counts in N, an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lorewright.session import materialize

#: How many large baskets of an item one list may hold, or about as many.
LONGEST = 20_000


def _explode_pairs(items: str) -> Column:
    """All pairs of a sorted array, smaller item first."""
    rest = lambda x, i: F.transform(F.slice(items, i + 2, F.size(items)), lambda y: F.struct(x.alias("a"), y.alias("b")))
    return F.explode(F.flatten(F.transform(items, rest)))


def _ordinary_pairs(members: DataFrame) -> DataFrame:
    """``a, b, o``: joint ordinary baskets of every pair; arrays here hold at most ``block`` items."""
    lists = members.groupBy("basket").agg(F.array_sort(F.collect_list("item")).alias("items"))
    weighted = lists.where(F.size("items") > 1).groupBy("items").agg(F.count("*").alias("weight"))
    return weighted.select(_explode_pairs("items").alias("p"), "weight").groupBy("p.a", "p.b").agg(F.sum("weight").alias("o"))


def _chunk_products(members: DataFrame, block: int) -> DataFrame:
    """``a, b, h``: joint large baskets, counted by products of chunk pairs."""
    sizes = members.groupBy("basket").agg(F.ceil(F.count("*") / block).cast("int").alias("chunks"))
    placed = members.join(sizes, "basket").withColumn("chunk", F.pmod(F.xxhash64("item"), F.col("chunks")).cast("int"))
    left = placed.select("basket", "item", F.col("chunk").alias("ci"), F.explode(F.sequence("chunk", F.col("chunks") - 1)).alias("cj"))
    right = placed.select("basket", F.col("item").alias("other"), F.col("chunk").alias("cj"), F.explode(F.sequence(F.lit(0), F.col("chunk"))).alias("ci"))
    met = left.join(right, ["basket", "ci", "cj"]).where((F.col("ci") < F.col("cj")) | (F.col("item") < F.col("other")))
    return met.groupBy(F.least("item", "other").alias("a"), F.greatest("item", "other").alias("b")).agg(F.count("*").alias("h"))


def _with_large(ordinary: DataFrame, big: DataFrame, hot: DataFrame | None) -> DataFrame:
    """``a, b, n_ab``: joint ordinary baskets plus the common ones of the two items' lists of large baskets.

    The list of an item in more than ``LONGEST`` large baskets (``hot``) is cut
    by a hash of the basket into a power of two of parts; only pairs with such
    an item are looked at part by part.
    """
    sized = big.withColumn("parts", F.lit(1)) if hot is None else big.join(hot, "item", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    lists = sized.groupBy("item", F.pmod(F.xxhash64("basket"), F.col("parts")).cast("int").alias("slot")).agg(F.collect_list("basket").alias("in_large"))
    la, lb = (lists.select(F.col("item").alias(s), F.col("slot").alias(f"s{s}"), F.col("in_large").alias(f"l{s}")) for s in "ab")
    if hot is None:
        slotted = ordinary.withColumns({"sa": F.lit(0), "sb": F.lit(0)})
    else:
        for s in "ab":
            ordinary = ordinary.join(hot.select(F.col("item").alias(s), F.col("parts").alias(f"p{s}")), s, "left").withColumn(f"p{s}", F.coalesce(f"p{s}", F.lit(1)))
        each = ordinary.withColumn("slot", F.explode(F.sequence(F.lit(0), F.greatest("pa", "pb") - 1)))
        slotted = each.withColumns({"sa": F.col("slot") % F.col("pa"), "sb": F.col("slot") % F.col("pb")}).drop("pa", "pb", "slot")
    shared = F.when(F.col("la").isNotNull() & F.col("lb").isNotNull(), F.size(F.array_intersect("la", "lb"))).otherwise(0)
    met = slotted.join(la, ["a", "sa"], "left").join(lb, ["b", "sb"], "left").select("a", "b", "o", shared.alias("h"))
    met = met if hot is None else met.groupBy("a", "b", "o").agg(F.sum("h").alias("h"))
    return met.select("a", "b", (F.col("o") + F.col("h")).alias("n_ab"))


def cooccurrence(rows: DataFrame, basket: str, item: str, min_support: int = 1, min_lift: float = 0.0, block: int = 256) -> DataFrame:
    """``item_a, item_b, n_ab, n_a, n_b, lift`` with item_a < item_b.

    ``lift`` is ``n_ab * N / (n_a * n_b)`` with N the distinct baskets.
    """
    pairs = rows.select(F.col(f"`{basket}`").alias("basket"), F.col(f"`{item}`").alias("item")).where("basket IS NOT NULL AND item IS NOT NULL").distinct()
    pairs = materialize(pairs, "memberships")
    total = pairs.agg(F.count_distinct("basket").alias("n"))
    counts = pairs.groupBy("item").agg(F.count("*").alias("n"))
    common = counts.where((F.col("n") >= min_support) & (F.col("n") * F.lit(float(min_lift)) <= total.scalar()))
    kept = materialize(pairs.join(common.select("item"), "item"), "kept")
    large = kept.groupBy("basket").agg(F.count("*").alias("size")).where(F.col("size") > block).select("basket")
    big = materialize(kept.join(large, "basket"), "large")
    ordinary = _ordinary_pairs(kept.join(large, "basket", "left_anti"))
    times = materialize(big.groupBy("item").agg(F.count("*").alias("times")), "times")
    hot = times.where(F.col("times") > LONGEST).select("item", F.pow(F.lit(2.0), F.ceil(F.log2(F.col("times") / LONGEST))).cast("int").alias("parts"))
    met = _with_large(ordinary, big, None if hot.isEmpty() else hot)
    dense = times.where(F.col("times") >= min_support).select("item")
    only_large = _chunk_products(big.join(dense, "item", "left_semi"), block).where(F.col("h") >= min_support)
    rest = only_large.join(ordinary.select("a", "b"), ["a", "b"], "left_anti").select("a", "b", F.col("h").alias("n_ab"))
    found = met.where(F.col("n_ab") >= min_support).unionByName(rest)
    ca, cb = common.select(F.col("item").alias("a"), F.col("n").alias("n_a")), common.select(F.col("item").alias("b"), F.col("n").alias("n_b"))
    scored = found.join(ca, "a").join(cb, "b")
    lift = F.col("n_ab") * total.scalar() / (F.col("n_a") * F.col("n_b"))
    return scored.select(F.col("a").alias("item_a"), F.col("b").alias("item_b"), "n_ab", "n_a", "n_b", lift.alias("lift")).where(F.col("lift") >= min_lift)
