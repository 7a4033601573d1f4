import random
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomline.llm.packing import Plan, best_plan, fill_report, pack


def one_by_one(lengths, capacity):
    """Best fit decreasing, an item at a time, in containers of the capacity."""
    bins = []
    for n in sorted(lengths, reverse=True):
        fits = [b for b in bins if b[0] >= n]
        if fits:
            min(fits)[0] -= n
        else:
            bins.append([capacity - n])
    return sorted(capacity - b[0] for b in bins)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=60))
def test_histogram_packing_is_best_fit_item_by_item(lengths):
    plan = Plan(Counter(lengths), 30, sizes=(1.0,))
    assert sorted(used for _, n, used in plan.done for _ in range(n)) == one_by_one(lengths, 30)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=80))
def test_permitted_sizes_hold_all_items(lengths):
    plan = best_plan(Counter(lengths), 40)
    assert sum(n * used for _, n, used in plan.done) == sum(lengths)
    assert sum(n for _, n, _ in plan.done) == plan.bins
    assert all(used <= 40 for _, _, used in plan.done)


def packed(spark, lengths, profiles):
    df = spark.createDataFrame([(i, n, "x") for i, n in enumerate(lengths)], "ord bigint, n bigint, length string")
    return pack(df, "ord", F.col("n"), profiles)


def test_items_are_whole_and_bins_hold(spark):
    rng = random.Random(1)
    lengths = [rng.choice([0, None, 7, 7, 7, rng.randint(1, 60), rng.randint(100, 350)]) for _ in range(700)]
    profiles = [("a", 100), ("b", 64)]
    rows = packed(spark, lengths, profiles).collect()
    for name, capacity in profiles:
        items, used, size = defaultdict(list), Counter(), {}
        for r in rows:
            if r.profile == name:
                items[r.ord].append((r.piece, r.start, r.length))
                used[r.batch] += r.length
                size[r.batch] = r.batch_size
        assert set(items) == set(range(len(lengths)))
        for i, n in enumerate(lengths):
            n = n or 0
            parts = sorted(items[i])
            assert len(parts) == max(1, -(-n // capacity))
            assert [p for p, _, _ in parts] == list(range(len(parts)))
            assert all(s == p * capacity for p, s, _ in parts)
            assert sum(x for _, _, x in parts) == n
        assert all(used[b] <= size[b] <= capacity for b in size)
        least = -(-sum(n or 0 for n in lengths) // capacity)
        assert len([b for b in used if used[b]]) <= least * 1.02 + 1


def test_report_empty_table_and_bad_capacity(spark):
    profiles = spark.createDataFrame([("a", 10)], "profile string, capacity bigint")
    r = fill_report(packed(spark, [6, 4, 5, 5, 3], [("a", 10)]), profiles).first()
    assert (r.batches, r.least_batches, r.used) == (3, 3, 23)
    assert packed(spark, [], [("a", 10)]).count() == 0
    assert packed(spark, [None, 0], [("a", 10)]).count() == 2
    with pytest.raises(ValueError):
        packed(spark, [1], [("a", None)])
