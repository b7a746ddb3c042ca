"""Market baskets: frequent itemsets, association rules and their network."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.expressions import ratio
from tillroll.functions.sharing import cut_lineage, share

RULE_METRICS = ("support", "confidence", "lift", "leverage", "conviction")
SYMMETRIC = ("support", "lift", "leverage")  # the same for a rule and its reverse
COMBINED = 64  # items of an order that is always combined with itself: 2,016 pairs
BUCKETS = 16  # of the orders set apart
_SLACK = 1e-9  # for the rounding of bounds


def order_baskets(
    df: DataFrame, segment_col: str, segment_value: str, item_col: str = "product_name"
) -> DataFrame:
    """``order_id, item``: the distinct items of each order of a segment that has more
    than one. One row per pair, however large an order is."""
    pairs = (
        df.where(F.col(segment_col) == segment_value)
        .select("order_id", F.col(item_col).alias("item"))
        .where(F.col("order_id").isNotNull() & F.col("item").isNotNull())
        .distinct()
    )
    # Counted where the pairs already are, so the lines are read and joined once.
    several = F.count(F.lit(1)).over(Window.partitionBy("order_id")) > 1
    return pairs.withColumn("several", several).where("several").drop("several")


def basket_arrays(baskets: DataFrame) -> DataFrame:
    """``order_id, items[]`` sorted: for showing baskets. An order's array has to fit in a
    row, so no other operator uses it."""
    return baskets.groupBy("order_id").agg(F.array_sort(F.collect_list("item")).alias("items"))


def frequent_itemsets(
    baskets: DataFrame, min_support: float, max_len: int | None = None
) -> DataFrame:
    """``items[], n, support`` of the itemsets with ``n / baskets >= min_support``, of up
    to ``max_len`` items or any number.

    ``baskets`` is ``order_id, item``. Items below the support cannot be part of a
    frequent set, so they are dropped first. If a frequent set needs n orders, it is in
    one that is not among any n - 1 others. So up to n - 1 orders, the largest of those
    with more than ``COMBINED`` items, are set apart and never combined with themselves:
    the other orders name sets, level by level, and of these the ones that can still reach
    the support are looked up in bitmaps of the orders set apart.
    """
    if not 0 < min_support <= 1:
        raise ValueError("min_support must be above 0 and at most 1")
    baskets = share(baskets)
    # Orders by size: no more sizes than the root of twice the rows.
    sizes = dict(_sizes(baskets).groupBy("size").agg(F.count(F.lit(1))).collect())
    total = sum(sizes.values())
    needed = max(1, int(min_support * total) - 1)
    while total and needed / total < min_support:
        needed += 1
    singles = baskets.groupBy("item").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= needed)
    found = singles.select(F.array("item").alias("items"), "n")
    if max_len is None or max_len > 1:
        kept = share(baskets.join(singles.select("item"), "item", "left_semi"))
        apart = None
        smallest = _smallest_apart(sizes, needed - 1)
        if smallest is not None:
            apart = share(_sizes(baskets).where(F.col("size") >= smallest).select("order_id"))
        found = found.unionByName(_grow(kept, apart, needed, max_len))
    return found.withColumn("support", ratio(F.col("n"), F.lit(total)))


def _sizes(baskets: DataFrame) -> DataFrame:
    return baskets.groupBy("order_id").agg(F.count(F.lit(1)).alias("size"))


def _smallest_apart(sizes: dict[int, int], most: int) -> int | None:
    """The size from which on orders are set apart, so that they are ``most`` at most."""
    smallest, orders = None, 0
    for size in sorted(sizes, reverse=True):
        orders += sizes[size]
        if size <= COMBINED or orders > most:
            break
        smallest = size
    return smallest


def _grow(kept: DataFrame, apart: DataFrame | None, needed: int, max_len: int | None) -> DataFrame:
    """Itemsets of two and more items of ``order_id, item``.

    ``inside`` has a row for each frequent set in each order that is not set apart: its
    first items, its last, and ``reach``, how many orders set apart can hold it, as none
    holds it that lacks one of its items. Two sets of an order that differ in the last
    item alone make the next longer set. The join feeds a partial count, so the shuffle
    carries a count per distinct set and task.
    """
    none = F.lit(0).cast("bigint")
    bits = None
    if apart is None:
        inside = kept.withColumn("reach", none)
    else:
        bits = share(_bitmaps(kept.join(apart, "order_id", "left_semi")))
        reach = bits.groupBy("item").agg(F.sum(F.bit_count("bits")).alias("reach"))
        inside = (
            kept.join(apart, "order_id", "left_anti")
            .join(reach, "item", "left")
            .withColumn("reach", F.coalesce("reach", none))
        )
    inside = inside.select("order_id", F.slice(F.array("item"), 1, 0).alias("first"), F.col("item").alias("last"), "reach")
    found, length = None, 2
    while True:
        other = inside.select("order_id", "first", F.col("last").alias("next"), F.col("reach").alias("other_reach"))
        longer = (
            inside.join(other, ["order_id", "first"])
            .where(F.col("last") < F.col("next"))
            .select(
                "order_id",
                F.concat("first", F.array("last")).alias("first"),
                F.col("next").alias("last"),
                F.least("reach", "other_reach").alias("reach"),
            )
        )
        counts = longer.groupBy("first", "last").agg(F.count(F.lit(1)).alias("n"), F.max("reach").alias("reach"))
        items = F.concat("first", F.array("last")).alias("items")
        level = counts.where(F.col("n") + F.col("reach") >= needed).select(items, "n")
        if bits is not None:
            level = share(level)
            level = (
                level.unionByName(_count_in(bits, level))
                .groupBy("items")
                .agg(F.sum("n").alias("n"))
                .where(F.col("n") >= needed)
            )
        if length != max_len:
            level = share(level)
        found = level if found is None else found.unionByName(level)
        if length == max_len:
            return found
        # Cut the lineage: the next level reads these rows twice.
        inside = cut_lineage(
            longer.withColumn("items", F.concat("first", F.array("last")))
            .join(level.select("items"), "items", "left_semi")
            .drop("items")
        )
        if inside.isEmpty():
            return found
        length += 1


def _bitmaps(members: DataFrame) -> DataFrame:
    """``item, bucket, word, bits`` of ``order_id, item``: the orders that hold an item, 64 in
    a word. Orders are dealt to buckets by their hash and numbered in each, so no task
    numbers all of them."""
    bucket = F.pmod(F.xxhash64("order_id"), F.lit(BUCKETS)).alias("bucket")
    place = F.row_number().over(Window.partitionBy("bucket").orderBy("order_id")) - 1
    orders = members.select("order_id").distinct().select("order_id", bucket).withColumn("place", place)
    bit = F.expr("shiftleft(1L, cast(place % 64 as int))")
    return (
        members.join(orders, "order_id")
        .groupBy("item", "bucket", F.expr("place div 64").alias("word"))
        .agg(F.bit_or(bit).alias("bits"))
    )


def _count_in(bits: DataFrame, itemsets: DataFrame) -> DataFrame:
    """How many orders of the bitmaps hold each whole itemset: one row meets 64 orders."""
    return (
        itemsets.select("items", F.explode("items").alias("item"))
        .join(bits, "item")
        .groupBy("items", "bucket", "word")
        .agg(F.bit_and("bits").alias("bits"), F.count(F.lit(1)).alias("held"))
        .where(F.col("held") == F.size("items"))
        .groupBy("items")
        .agg(F.sum(F.bit_count("bits")).alias("n"))
        .where("n > 0")
    )


def association_rules(
    itemsets: DataFrame, metric: str = "confidence", min_threshold: float = 0.8
) -> DataFrame:
    """Every split of an itemset into antecedents and consequents whose ``metric`` is
    at least ``min_threshold``, by falling lift.

    ``itemsets`` must hold all frequent sets up to its longest, as
    ``frequent_itemsets`` returns them: a part of a frequent set is frequent. Of sets of
    any length only rules whose both sides are known are formed, one more item a round,
    and only from sets and splits that ``_can_reach`` the threshold.
    """
    if metric not in RULE_METRICS:
        raise ValueError(f"unknown metric {metric!r}; one of {', '.join(RULE_METRICS)}")
    itemsets = share(itemsets)
    longest = itemsets.agg(F.max(F.size("items"))).first()[0] or 0
    # Consequents grow item by item, in the items' order, through sets that are known. Where
    # a rule and its reverse measure the same, the first item stays an antecedent and each
    # split stands for both.
    fixed = 1 if metric in SYMMETRIC else 0

    def free(items: str) -> Column:
        return F.explode(F.slice(items, F.lit(1 + fixed), F.size(items) - fixed)).alias("next")

    level = (
        itemsets.where(F.size("items") > 1)
        .where(_can_reach(metric, F.col("support"), min_threshold))
        .select("items", "support", F.slice("items", 1, 0).alias("consequents"), free("items"))
    )
    rules = None
    for length in range(1, max(longest, 2)):
        grown = F.concat("consequents", F.array("next"))
        splits = level.select(
            "items", "support", F.array_except("items", grown).alias("antecedents"), grown.alias("consequents")
        )
        level = _known(splits, itemsets).where(_can_reach(metric, F.col("antecedent_support"), min_threshold))
        if length > 1:
            level = cut_lineage(level)
            if level.isEmpty():
                break
        elif longest > 2:
            level = share(level)
        rules = level if rules is None else rules.unionByName(level)
        level = (
            level.where(F.size("antecedents") > 1)
            .select("items", "support", "consequents", free("antecedents"))
            .where(F.col("next") > F.element_at("consequents", -1))
        )
    rules = rules.drop("items")
    return (
        _measured(_both_ways(rules) if fixed else rules)
        .where(F.col(metric) >= min_threshold)
        .orderBy(F.desc("lift"), "antecedents", "consequents")
    )


def _can_reach(metric: str, antecedent: Column, threshold: float) -> Column:
    """Whether a split of a set, or one that an item moved over to the consequents leads to,
    can reach the threshold.

    ``antecedent`` is at most the support of its antecedents: that of the split at hand, as
    fewer antecedents have no lower support, or that of the set. No consequents have a
    lower support than the set.
    """
    whole = F.col("support")
    sure = F.when(antecedent <= whole, F.lit(float("inf")))  # the confidence can be 1
    bound = {
        "support": whole,
        "confidence": whole / antecedent,
        "lift": 1 / antecedent,
        "leverage": whole - antecedent * whole,
        "conviction": sure.otherwise((1 - whole) / (1 - whole / antecedent)),
    }[metric]
    return bound + F.abs(bound) * _SLACK + _SLACK >= threshold


def _known(splits: DataFrame, itemsets: DataFrame) -> DataFrame:
    """Splits of itemsets into two known ones, with their supports."""
    antecedents = itemsets.select(
        F.col("items").alias("antecedents"), F.col("support").alias("antecedent_support")
    )
    consequents = itemsets.select(
        F.col("items").alias("consequents"), F.col("support").alias("consequent_support")
    )
    return splits.join(antecedents, "antecedents").join(consequents, "consequents")


def _both_ways(splits: DataFrame) -> DataFrame:
    names = ("antecedents", "consequents", "antecedent_support", "consequent_support")
    swapped = (names[1], names[0], names[3], names[2])
    sides = [F.struct(*[F.col(c).alias(n) for c, n in zip(some, names)]) for some in (names, swapped)]
    return splits.select("support", F.inline(F.array(*sides)))


def _measured(splits: DataFrame) -> DataFrame:
    """The measures of the rules that splits with their supports are."""
    confidence, s_both = F.col("confidence"), F.col("support")
    s_ante, s_cons = F.col("antecedent_support"), F.col("consequent_support")
    return splits.withColumn("confidence", s_both / s_ante).select(
        "antecedents",
        "consequents",
        "antecedent_support",
        "consequent_support",
        "support",
        "confidence",
        (confidence / s_cons).alias("lift"),
        (s_both - s_ante * s_cons).alias("leverage"),
        F.when(confidence >= 1, F.lit(float("inf")))
        .otherwise((1 - s_cons) / (1 - confidence))
        .alias("conviction"),
    )


def segment_rules(
    df: DataFrame,
    segment_col: str,
    segment_value: str,
    min_support: float,
    metric: str,
    min_threshold: float,
    max_len: int | None = None,
    item_col: str = "product_name",
) -> DataFrame:
    """Rules of one segment in one call: baskets, itemsets, rules."""
    baskets = order_baskets(df, segment_col, segment_value, item_col)
    return association_rules(
        frequent_itemsets(baskets, min_support, max_len), metric, min_threshold
    )


def _ends(rules: DataFrame) -> DataFrame:
    """Source and target of each rule, and its place: by falling lift, then by text."""
    return rules.select(
        F.element_at("antecedents", 1).alias("source"),
        F.element_at("consequents", 1).alias("target"),
        "lift",
        F.struct(
            (-F.col("lift")).alias("minus_lift"), F.col("antecedents"), F.col("consequents")
        ).alias("place"),
    )


def association_edges(rules: DataFrame, directed: bool = False) -> DataFrame:
    """``source, target, lift, title``: the two directions of a pair are one edge, the
    first in rule order. With ``directed=True`` every rule is an edge.
    """
    ends = _ends(rules)
    if not directed:
        ends = (
            ends.groupBy(
                F.least("source", "target").alias("one"), F.greatest("source", "target").alias("other")
            )
            .agg(F.min_by(F.struct("source", "target", "lift"), "place").alias("kept"))
            .select("kept.*")
        )
    return ends.select(
        "source", "target", "lift", F.concat(F.lit("Lift: "), F.format_number("lift", 2)).alias("title")
    )


def association_nodes(rules: DataFrame, directed: bool = False) -> DataFrame:
    """``item, color, degree``: blue if the item came first as a source in rule order,
    else red; the degree counts the edges that touch it."""
    ends = [("source", "target", 0), ("target", "source", 1)]
    seen = F.explode(
        F.array(*[F.struct(F.col(a).alias("item"), F.col(b).alias("partner"), F.lit(side).alias("side")) for a, b, side in ends])
    )
    # The earliest appearance is a minimum per item; rules are never put in one line. One edge
    # a pair, so an item has as many edges as partners; directed, as many as rules.
    pairs = (
        _ends(rules)
        .select("place", seen.alias("end"))
        .groupBy("end.item", "end.partner")
        .agg(F.min(F.struct("place", "end.side")).alias("first"), F.count(F.lit(1)).alias("n"))
    )
    return (
        pairs.groupBy("item")
        .agg(F.min("first").alias("first"), (F.sum("n") if directed else F.count(F.lit(1))).alias("degree"))
        .select("item", F.when(F.col("first.side") == 0, "blue").otherwise("red").alias("color"), "degree")
    )
