import datetime as dt

import pytest
from pyspark.sql import functions as F

from loomline.operators.incremental import IncrementalTable, due_lines
from loomline.session import names, work_dir

T = [dt.datetime(2025, 1, d) for d in range(1, 20)]
JOB = "key string, sourceHash string, change string"
LOG = "seq bigint, key string, sourceHash string, updatedAt timestamp"
RUN = "finished_at timestamp, outcome string"


def due(spark, job, log, runs):
    j = spark.createDataFrame([(k, h, "x") for k, h in job], JOB)
    return sorted(map(tuple, due_lines(j, spark.createDataFrame(log, LOG), spark.createDataFrame(runs, RUN), parts=4).collect()))


def test_new_changed_and_untouched(spark):
    job = [("a", "1"), ("b", "2"), ("c", "3"), ("d", None), ("e", "5"), ("e", "5"), (None, "x")]
    log = [(1, "a", "1", T[1]), (2, "b", "old", T[1]), (3, "c", "x", T[1]), (4, "c", "3", T[1]), (5, "d", "", T[1]), (6, "e", "5", T[9]), (7, "zz", "5", T[1]), (8, "b", "2", None), (9, None, "2", T[1])]
    runs = [(T[5], "COMPLETE"), (T[3], "COMPLETE"), (T[12], "FAILED"), (None, "COMPLETE")]
    assert due(spark, job, log, runs) == [("b", "changed"), ("d", "changed"), ("e", "new")]


def test_without_complete_run_or_log_all_is_new(spark):
    assert due(spark, [("a", "1")], [(1, "a", "1", T[1])], [(T[3], "STOPPED")]) == [("a", "new")]
    assert due(spark, [("a", "1")], [], [(T[3], "COMPLETE")]) == [("a", "new")]
    assert due(spark, [], [(1, "a", "1", T[1])], [(T[3], "COMPLETE")]) == []


class Lost(Exception):
    pass


def failing(spark, root, after):
    """A table whose run is lost after the given number of steps."""
    t = IncrementalTable(spark, root, "key", "v", parts=4)
    left = [after]

    def step(name):
        left[0] -= 1
        if left[0] < 0:
            raise Lost(name)

    t.step = step
    return t


def test_a_run_lost_after_any_step_is_retried_without_skipping_or_repeating(spark):
    root = work_dir(spark, "t")
    df = lambda rows: spark.createDataFrame(rows, "key string, v string")
    keep = lambda changes: changes.withColumn("seen", F.concat("key", F.lit(":"), "change"))
    made = lambda: sorted(r.seen for r in IncrementalTable(spark, root, "key", "v").outputs().collect())
    first = [(f"k{i}", "1") for i in range(20)]
    second = [*first[1:], ("k0", "2"), ("n", None)]
    expected = []
    for rows, new in ((first, [f"{k}:new" for k, _ in first]), (second, ["k0:changed", "n:new"])):
        expected += new
        lost = 0
        for after in range(20):
            try:
                todo = failing(spark, root, after).run(df(rows), keep)
            except Lost as e:
                lost += 1
                if str(e) == "commit":  # lost after the commit, so the run counts
                    break
                continue
            break
        assert lost >= 5
        assert IncrementalTable(spark, root, "key", "v").run(df(rows), keep) == []
        assert made() == sorted(expected)
    assert IncrementalTable(spark, root, "key", "v", parts=99).parts == 4
    t = IncrementalTable(spark, root, "key", "v")
    t.run(df(second[:5]), keep)  # removed keys are no change, but leave the state
    assert made() == sorted(expected)
    assert t.state().count() == 5


def test_a_failing_process_leaves_nothing(spark):
    t = IncrementalTable(spark, work_dir(spark, "t"), "key", "v", parts=4)
    df = spark.createDataFrame([("a", "1"), ("b", None)], "key string, v string")

    def fail(changes):
        raise Lost

    with pytest.raises(Lost):
        t.run(df, fail)
    assert t.outputs() is None
    assert t.runs() == []
    t.run(df, lambda c: None)
    assert t.state().count() == 2
    assert t.outputs() is None


def test_only_changed_partitions_are_read_and_written(spark):
    root = work_dir(spark, "t")
    df = lambda rows: spark.createDataFrame(rows, "key string, v string")
    t = IncrementalTable(spark, root, "key", "v", parts=8)
    rows = [(f"k{i}", "1") for i in range(200)]
    t.run(df(rows), lambda c: None)
    r = t.begin(df([("k0", "2"), *rows[1:]]))
    assert len(r.todo) == 1
    files = {f.rpartition("/")[0].rpartition("=")[2] for f in t._state(1, r.todo).inputFiles()}
    assert files == {str(r.todo[0])}
    r.commit()
    assert len(names(spark, f"{root}/state/__run=2")) == 1 + ("_SUCCESS" in names(spark, f"{root}/state/__run=2"))
    assert {(x.key, x.v) for x in t.state().collect()} == {("k0", "2"), *rows[1:]}
