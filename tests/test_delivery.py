import random

import pytest
from pyspark.sql import functions as F

from loomline.operators.delivery import PART, MessageStore, surplus_deliveries
from loomline.session import remove, work_dir

KIND = "seq bigint, batch_id int, key string, at bigint, __best string"


def store_of(spark):
    return MessageStore(spark, work_dir(spark, "t"), ["key", "at"], "seq", F.floor(F.col("batch_id") / 4))


def brute(rows):
    best, surplus = {}, []
    for r in sorted(rows):
        if r[2] is None or r[3] is None:
            continue
        if (r[2], r[3]) in best:
            surplus.append(r[0])
        best.setdefault((r[2], r[3]), r[0])
    return surplus


def sample(n, seed):
    rng = random.Random(seed)
    # One message holds about a third of all rows.
    pick = lambda: ("hot", 1) if rng.random() < 0.33 else (rng.choice([None, *"abcdefgh"]), rng.choice([None, 1, 2, 3, 4]))
    return [(i, i // 10, *pick(), rng.choice(["x", None])) for i in range(n)]


@pytest.mark.parametrize("deliveries", [1, 3])
def test_surplus_is_what_brute_force_finds(spark, deliveries):
    rows = sample(400, 1)
    log = spark.createDataFrame(rows, KIND).drop("__best").withColumn("extra", F.lit(None).cast("string"))
    got = sorted(r[0] for r in surplus_deliveries(log, ["key", "at"], "seq", "batch_id", deliveries=deliveries).collect())
    assert got == brute(rows)


def test_store_keeps_one_copy_and_touches_only_affected_partitions(spark):
    rows = [(i, i, "k", i, None) for i in range(24)]
    s = store_of(spark)
    s.merge(spark.createDataFrame(rows, KIND).drop("__best"))
    before = {r.f for r in s.messages().select(F.input_file_name().alias("f")).distinct().collect()}
    changed = s.merge(spark.createDataFrame([(100, 25, "k", 3, None), (101, 25, "new", 1, None)], KIND).drop("__best"))
    after = {r.f for r in s.messages().select(F.input_file_name().alias("f")).distinct().collect()}
    assert changed == [6]
    assert before <= after
    assert sorted(r.seq for r in s.messages().collect()) == [*range(24), 101]


def test_late_copy_with_lower_order_replaces_the_winner_in_its_partition(spark):
    s = store_of(spark)
    s.merge(spark.createDataFrame([(10, 1, "k", 1, None), (11, 9, "z", 1, None)], KIND).drop("__best"))
    assert s.merge(spark.createDataFrame([(5, 20, "k", 1, None)], KIND).drop("__best")) == [0]
    assert {(r.seq, r[PART]) for r in s.messages().collect()} == {(5, 0), (11, 2)}


def test_merging_again_changes_nothing(spark):
    s = store_of(spark)
    df = spark.createDataFrame(sample(120, 2), KIND).drop("__best")
    s.merge(df)
    once = sorted(r.seq for r in s.messages().collect())
    s.merge(df.filter("seq >= 60"))
    s.merge(df)
    assert sorted(r.seq for r in s.messages().collect()) == once


def test_empty_log_and_empty_delivery(spark):
    empty = spark.createDataFrame([], KIND).drop("__best")
    assert surplus_deliveries(empty, ["key", "at"], "seq", "batch_id").count() == 0
    s = store_of(spark)
    s.merge(spark.createDataFrame([(1, 1, "k", 1, None)], KIND).drop("__best"))
    assert s.merge(empty) == []
    assert s.messages().count() == 1


def test_rows_without_identity_all_stay(spark):
    s = store_of(spark)
    s.merge(spark.createDataFrame([(1, 1, None, 1, None), (2, 1, None, 1, None), (3, 1, "k", None, None), (4, 1, "k", None, None)], KIND).drop("__best"))
    assert s.messages().count() == 4


class Lost(Exception):
    pass


def test_a_merge_lost_after_any_step_is_made_good_by_the_next(spark):
    root = work_dir(spark, "t")
    rows = sample(90, 5)
    late = [(1000 + i, 40, *rows[i][2:4], None) for i in range(0, 20, 2)] + [(-i, 3, *rows[40 + i][2:4], None) for i in range(1, 5)]
    parts = [rows[:45], rows[45:], late]
    merged, broken = [], 0
    for part in parts:
        df = spark.createDataFrame(part, KIND).drop("__best")
        merged += part
        for after in range(8):
            left = [after]

            def step(name, left=left):
                left[0] -= 1
                if left[0] < 0:
                    raise Lost(name)

            s = MessageStore(spark, root, ["key", "at"], "seq", F.floor(F.col("batch_id") / 4), buckets=4)
            s.step = step
            try:
                s.merge(df)
            except Lost:
                broken += 1
                continue
            break
        s = MessageStore(spark, root, ["key", "at"], "seq", F.floor(F.col("batch_id") / 4), buckets=4)
        s.merge(df)
        assert sorted(r.seq for r in s.messages().collect()) == sorted({r[0] for r in merged} - set(brute(merged)))
        ids = s.index().groupBy("key", "at").count()
        assert ids.filter("count > 1").count() == 0
    assert broken >= 8


def test_another_delivery_may_come_before_the_retry(spark):
    root = work_dir(spark, "t")
    store = lambda: MessageStore(spark, root, ["key", "at"], "seq", F.floor(F.col("batch_id") / 4), buckets=4)
    first = spark.createDataFrame([(1, 1, "k", 1, None), (2, 1, "m", 1, None)], KIND).drop("__best")
    second = spark.createDataFrame([(7, 30, "k", 1, None), (8, 30, "z", 1, None)], KIND).drop("__best")
    s = store()

    def step(name):
        raise Lost(name)

    s.step = step
    with pytest.raises(Lost):
        s.merge(first)
    store().merge(second)
    store().merge(first)
    assert sorted((r.seq, r[PART]) for r in store().messages().collect()) == [(1, 0), (2, 0), (8, 7)]


def test_half_replaced_partitions_are_replaced_again(spark):
    root = work_dir(spark, "t")
    store = lambda: MessageStore(spark, root, ["key", "at"], "seq", F.floor(F.col("batch_id") / 4), buckets=4)
    store().merge(spark.createDataFrame([(i, i, "k", i, None) for i in range(10, 16)], KIND).drop("__best"))
    s = store()

    def step(name):
        if name == "journal":  # as when the overwrite dies after its deletions
            remove(spark, f"{s.messages_path}/{PART}=3")
            raise Lost

    s.step = step
    with pytest.raises(Lost):
        s.merge(spark.createDataFrame([(1, 30, "k", 14, None), (2, 12, "new", 1, None)], KIND).drop("__best"))
    store().merge(spark.createDataFrame([], KIND).drop("__best"))
    assert sorted(r.seq for r in store().messages().collect()) == [1, 2, 10, 11, 12, 13, 15]


def test_only_the_buckets_of_a_delivery_are_read(spark):
    s = MessageStore(spark, work_dir(spark, "t"), ["key", "at"], "seq", F.floor(F.col("batch_id") / 4), buckets=32)
    s.merge(spark.createDataFrame([(i, i, f"k{i}", i, None) for i in range(200)], KIND).drop("__best"))
    few = s.index([3, 4])
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [__bucket" in plan
    few._jdf.queryExecution().executedPlan()
    assert {r[0] for r in few.select(F.regexp_extract(F.input_file_name(), "__bucket=([0-9]+)", 1)).distinct().collect()} == {"3", "4"}
