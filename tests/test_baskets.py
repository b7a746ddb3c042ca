import math
import random
from itertools import combinations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import by
from pyspark.sql import functions as F
from tillroll.operators import baskets as b


def basket_frame(spark, orders):
    rows = [(f"o{i}", item) for i, items in enumerate(orders) for item in items]
    return spark.createDataFrame(rows, "order_id string, item string")


def brute_force(orders, min_support, max_len=None):
    counts = {}
    for items in orders:
        for k in range(1, (max_len or len(items)) + 1):
            for subset in combinations(sorted(items), k):
                counts[subset] = counts.get(subset, 0) + 1
    return {s: n for s, n in counts.items() if n / len(orders) >= min_support}


def found(df):
    return {tuple(r["items"]): r["n"] for r in df.collect()}


ORDERS = ["abc", "ab", "ac", "bcd"]


def test_baskets(lines):
    df = lines(
        {"order_id": "1", "product_name": "a"},
        {"order_id": "1", "product_name": "a"},
        {"order_id": "2", "product_name": "b"},
        {"order_id": "2", "product_name": "a"},
        {"order_id": "2", "product_name": None},
        {"order_id": None, "product_name": "a"},
        {"order_id": None, "product_name": "b"},
        {"order_id": "3", "product_name": "a", "customer_segment": "Consumer"},
        {"order_id": "3", "product_name": "b", "customer_segment": "Consumer"},
    )
    kept = b.order_baskets(df, "customer_segment", "Corporate")
    assert sorted(tuple(r) for r in kept.collect()) == [("2", "a"), ("2", "b")]
    assert [r["items"] for r in b.basket_arrays(kept).collect()] == [["a", "b"]]


def test_no_baskets(lines):
    kept = b.order_baskets(lines({}), "customer_segment", "Nobody")
    for max_len in (2, 3, None):
        sets = b.frequent_itemsets(kept, 0.1, max_len)
        assert sets.columns == ["items", "n", "support"] and sets.count() == 0
        rules = b.association_rules(sets, "lift", 1.0)
        assert rules.columns[:2] == ["antecedents", "consequents"] and rules.count() == 0
        assert b.association_nodes(rules).count() == b.association_edges(rules).count() == 0


def test_itemsets_by_hand(spark):
    sets = b.frequent_itemsets(basket_frame(spark, ORDERS), 0.25)
    assert found(sets) == brute_force(ORDERS, 0.25) and sets.count() == 11


orders_strategy = st.lists(st.sets(st.sampled_from("abcdef"), min_size=2), min_size=1, max_size=9)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(orders_strategy, st.sampled_from([0.1, 1 / 3, 0.5]))
def test_itemsets_match_brute_force(spark, orders, min_support):
    frame = basket_frame(spark, orders)
    for max_len in (1, 2, 3, 5, None):
        assert found(b.frequent_itemsets(frame, min_support, max_len)) == brute_force(
            orders, min_support, max_len
        )


def test_orders_without_frequent_items_count_in_the_support(spark):
    orders = ["ab", "ab", "cd", "ef", "gh"]
    for max_len in (2, None):
        rows = b.frequent_itemsets(basket_frame(spark, orders), 0.4, max_len).collect()
        assert {(tuple(r["items"]), r["support"]) for r in rows} == {
            (("a",), 0.4), (("b",), 0.4), (("a", "b"), 0.4),
        }


def test_the_largest_orders_are_not_combined(spark):
    """Two orders of the same 3,000 items, which one more order each makes frequent, in pairs."""
    items = [f"i{k:04d}" for k in range(3_000)]
    orders = [items, items] + [items[k : k + 2] for k in range(0, len(items), 2)]
    frame = basket_frame(spark, orders)
    sets = found(b.frequent_itemsets(frame, 3 / len(orders), 2))
    assert sum(len(s) == 2 for s in sets) == 1_500 and set(sets.values()) == {3}


def test_many_copies_and_one_huge_order(spark):
    """A third of the baskets alike, and an order with a third of all lines."""
    orders = ["abcdefgh"] * 20 + ["ab", "cd", "ef", "gh"] * 10
    orders.append([f"item{i}" for i in range(400)] + ["a", "b"])
    frame = basket_frame(spark, orders)
    assert found(b.frequent_itemsets(frame, 0.1, 3)) == brute_force(
        [o for o in orders if len(o) < 100] + [["a", "b"]], 0.1, 3
    )


@pytest.mark.parametrize("combined, buckets", [(1, 1), (2, 3)])
def test_orders_set_apart_match_brute_force(spark, monkeypatch, combined, buckets):
    monkeypatch.setattr(b, "COMBINED", combined)
    monkeypatch.setattr(b, "BUCKETS", buckets)
    rng = random.Random(buckets)
    orders = [rng.sample("abcdefgh", rng.choice([2, 2, 3, 6])) for _ in range(200)]
    frame = basket_frame(spark, orders)
    for support, max_len in ((0.05, 2), (0.4, 3), (0.08, None)):
        assert found(b.frequent_itemsets(frame, support, max_len)) == brute_force(orders, support, max_len)


def test_rows_that_meet_the_bitmaps_grow_with_the_input(spark, monkeypatch):
    """Many large orders, every pair somewhere, none frequent: each pair meets an order only
    within a word of 64 orders, and only while it can reach the support."""
    monkeypatch.setattr(b, "COMBINED", 8)
    count, joined = b._count_in, []

    def counted(bits, itemsets):
        joined.append(itemsets.select("items", F.explode("items").alias("item")).join(bits, "item").count())
        return count(bits, itemsets)

    monkeypatch.setattr(b, "_count_in", counted)
    rng = random.Random(1)
    for n in (1_000, 2_000):
        orders = [rng.sample(range(100), max(2, min(40, int(rng.paretovariate(0.9))))) for _ in range(n)]
        frame = spark.createDataFrame([(o, f"i{i}") for o, items in enumerate(orders) for i in items], "order_id long, item string")
        sets = found(b.frequent_itemsets(frame, 0.05, 2))
        assert sets == {tuple(sorted(f"i{i}" for i in k)): v for k, v in brute_force(orders, 0.05, 2).items()}
        assert joined.pop() < 2 * sum(map(len, orders))


def test_min_support_is_checked(spark):
    with pytest.raises(ValueError, match="min_support"):
        b.frequent_itemsets(basket_frame(spark, ORDERS), 0)


def brute_rules(orders, min_support, max_len=None):
    sets = brute_force(orders, min_support, max_len)
    share = {s: n / len(orders) for s, n in sets.items()}
    for items in sets:
        for k in range(1, len(items)):
            for ante in combinations(items, k):
                cons = tuple(i for i in items if i not in ante)
                confidence = share[items] / share[ante]
                yield (
                    ante,
                    cons,
                    {
                        "support": share[items],
                        "confidence": confidence,
                        "lift": confidence / share[cons],
                        "leverage": share[items] - share[ante] * share[cons],
                        "conviction": math.inf if confidence >= 1 else (1 - share[cons]) / (1 - confidence),
                    },
                )


@pytest.mark.parametrize(
    "metric, least", [("support", 0.5), ("confidence", 0.6), ("lift", 1.0), ("leverage", 0.01), ("conviction", 1.1)]
)
def test_rules(spark, metric, least):
    sets = b.frequent_itemsets(basket_frame(spark, ORDERS), 0.25)
    rows = [r.asDict() for r in b.association_rules(sets, metric, least).collect()]
    want = {(a, c): m for a, c, m in brute_rules(ORDERS, 0.25) if m[metric] >= least}
    assert {(tuple(r["antecedents"]), tuple(r["consequents"])) for r in rows} == set(want)
    for r in rows:
        measures = want[tuple(r["antecedents"]), tuple(r["consequents"])]
        assert {k: r[k] for k in measures} == pytest.approx(measures)
    assert [r["lift"] for r in rows] == sorted((r["lift"] for r in rows), reverse=True)


@pytest.mark.parametrize("metric, least", [("confidence", 0.9), ("lift", 2.5), ("leverage", 0.1), ("conviction", 6.0), ("support", 0.2)])
def test_splits_that_cannot_reach_the_threshold_are_not_formed(spark, monkeypatch, metric, least):
    rng = random.Random(7)
    orders = ["".join(sorted(set("abcde") - set(rng.sample("abcde", rng.choice([0, 0, 1]))) | set(rng.sample("vwxyz", 2)))) for _ in range(30)]
    orders += ["".join(rng.sample("abcdefvwxyz", 2)) for _ in range(60)]
    sets = b.frequent_itemsets(basket_frame(spark, orders), 0.06)
    known, formed = b._known, []

    def counted(splits, itemsets):
        formed.append(splits.count())
        return known(splits, itemsets)

    monkeypatch.setattr(b, "_known", counted)
    rows = b.association_rules(sets, metric, least).collect()
    every = list(brute_rules(orders, 0.06))
    want = {(a, c) for a, c, m in every if m[metric] >= least}
    assert {(tuple(r["antecedents"]), tuple(r["consequents"])) for r in rows} == want and want
    assert sum(formed) < 0.75 * len(every)


def test_rules_both_ways_and_certain(spark):
    sets = b.frequent_itemsets(basket_frame(spark, ORDERS), 0.25, 2)
    rows = by_pair(b.association_rules(sets, "support", 0.0))
    assert rows["a", "b"]["lift"] == pytest.approx(rows["b", "a"]["lift"])
    assert rows["d", "b"]["confidence"] == 1.0 and math.isinf(rows["d", "b"]["conviction"])
    assert all(len(k) == 2 for k in rows)


def by_pair(rules):
    return {(r["antecedents"][0], r["consequents"][0]): r.asDict() for r in rules.collect()}


def test_rules_of_a_long_set(spark):
    """A set of 33 items, of whose parts only the longest and the single ones are known."""
    items = [f"i{k:02d}" for k in range(33)]
    known = [(items, 0.5)] + [([i], 0.6) for i in items]
    known += [([i for i in items if i != gone], 0.5 if gone < "i03" else 0.9) for gone in items]
    sets = spark.createDataFrame(known, "items array<string>, support double")
    rows = b.association_rules(sets, "confidence", 0.9).collect()
    assert sorted(r["consequents"] for r in rows) == [["i00"], ["i01"], ["i02"]]
    assert all(len(r["antecedents"]) == 32 and r["confidence"] == 1.0 for r in rows)


def test_unknown_metric(spark):
    with pytest.raises(ValueError, match="unknown metric"):
        b.association_rules(b.frequent_itemsets(basket_frame(spark, ORDERS), 0.25, 2), "luck", 1)


def test_network(spark):
    rules = spark.createDataFrame(
        [
            (["b"], ["c"], 1.5),
            (["a"], ["b"], 2.346),
            (["b"], ["a"], 2.346),
            (["c"], ["d"], 1.2),
        ],
        "antecedents array<string>, consequents array<string>, lift double",
    )
    edges = by(b.association_edges(rules, directed=True), "source", "target")
    assert len(edges) == 4 and edges["a", "b"]["title"] == "Lift: 2.35"
    assert set(by(b.association_edges(rules), "source", "target")) == {
        ("a", "b"), ("b", "c"), ("c", "d"),
    }
    nodes = by(b.association_nodes(rules, directed=True), "item")
    # In rule order a -> b comes first, so b enters as a target.
    assert {k: n["color"] for k, n in nodes.items()} == {"a": "blue", "b": "red", "c": "red", "d": "red"}
    assert {k: n["degree"] for k, n in nodes.items()} == {"a": 2, "b": 3, "c": 2, "d": 1}
    assert {k: n["degree"] for k, n in by(b.association_nodes(rules), "item").items()} == {
        "a": 1, "b": 2, "c": 2, "d": 1,
    }
