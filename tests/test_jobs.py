import json
import os
import random
import zipfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from loomline.operators import cascade
from loomline.operators.batching import greedy_batches, phase_seed, token_budget
from loomline.operators.qa import Glossary
from loomline.operators.replay import Resume, overlaid
from loomline.operators.report import final_report, reconciliation
from loomline.operators.running import running_sums
from loomline.operators.skew import hot_split_join, many_to_one
from loomline.session import work_dir
from loomline.sources import files, provider, schemas
from loomline.streaming.latest import LatestTable, latest_stream

LINE = "ord bigint, " + schemas.ITEM


def line(i, key, english="Go now", hash="h", ident="TXT_1", inherited=False, current=""):
    return (i, key, "f", i, ident, "", "x", english, "", current, inherited, hash)


def record(seq, key, text, status="LOCAL_OK", hash="h"):
    return (seq, 1, key, hash, text, status, None, 1, None, None)


def failure(*keys):
    return (*[None] * 12, list(keys) if keys else None, None, None)


def resume(spark, lines, records, failures):
    return Resume(spark.createDataFrame(lines, LINE), spark.createDataFrame(records, schemas.RECORD), spark.createDataFrame(failures, schemas.FAILURE), Glossary())


def test_replay_of_a_damaged_log(spark):
    lines = [line(1, "good"), line(2, "stale"), line(3, "hidden"), line(4, "failed"), line(5, "fresh"), line(6, "logged"), line(7, "meta", "Jane Doe", ident="TXT_CV_1"), line(8, "old", inherited=True, current="cũ"), line(9, "bad"), line(10, "trusted"), line(11, "good"), line(12, None)]
    log = [
        record(1, "good", "đi"), record(2, "stale", "đi"), record(3, "stale", "x", hash="other"), record(4, "hidden", "đi"), record(5, "hidden", "", "TECHNICAL_ERROR"),
        record(6, "failed", None, "TECHNICAL_ERROR"), record(7, "unknown", "đi"), record(8, "bad", "Go now"), record(9, "trusted", "Go now", "INHERITED_R3"), record(10, "fresh", ""), record(11, None, "x"),
    ]
    r = resume(spark, lines, log, [failure("logged", "good", "nobody"), failure()])
    assert {(x.key, x.route) for x in r.routes.collect()} == {("good", "valid"), ("stale", "valid"), ("hidden", "failed"), ("failed", "failed"), ("bad", "requeued"), ("trusted", "valid"), ("fresh", "none")}
    assert {x.key for x in r.backlog.collect()} == {"logged"}
    assert [tuple(x) for x in r.metadata().collect()] == [("meta", "added", "Jane Doe", None)]
    assert {(x.key, x.vietnamese) for x in r.inherited().collect()} == {("old", "cũ")}
    assert {x.key for x in r.recovery().collect()} == {"hidden", "failed", "bad", "logged"}
    assert {(x.ord, x.key) for x in r.fresh().collect()} == {(5, "fresh"), (12, None)}
    assert {x.key for x in r.active_backlog().collect()} == {"logged"}
    texts = {x.ord: (x.text, x.origin) for x in overlaid(r.job, r.records()).collect()}
    assert texts[1] == texts[11] == ("đi", "translated")
    assert texts[5] == ("Go now", "fallback")
    rep = final_report(r.lines, r.records()).first()
    assert (rep.total, rep.completed, rep.status) == (11 - 1, 5, "COMPLETE_WITH_ERRORS")
    rec = reconciliation(r.lines, r.records()).first()
    assert rec.source == rec.translated + rec.fallback + rec.blocked == 10


def test_replay_of_empty_logs(spark):
    r = resume(spark, [line(1, "a")], [], [])
    assert r.records().count() == 0
    assert r.fresh().count() == 1
    assert r.recovery().count() == 0


def brute_batches(weights, n, most):
    out, count, size, batch = [], 0, 0, -1
    for w in weights:
        if not count or count >= n or size + w > most:
            batch, count, size = batch + 1, 0, 0
        out.append(batch)
        count, size = count + 1, size + w
    return out


@pytest.mark.parametrize("chunk", [7, 25, 10_000])
def test_batches_do_not_depend_on_chunks(spark, chunk):
    rng = random.Random(chunk)
    weights = [rng.choice([1, 5, 9, 40, 120]) for _ in range(300)]
    df = spark.createDataFrame([(3 * i, w) for i, w in enumerate(weights)], "ord bigint, w bigint")
    got = [r.batch_id for r in greedy_batches(df, "ord", "w", 4, 100, chunk).orderBy("ord").collect()]
    assert got == brute_batches(weights, 4, 100)


def test_empty_queue_budget_and_seeds(spark):
    assert greedy_batches(spark.createDataFrame([], "ord bigint, w bigint"), "ord", "w").count() == 0
    b = spark.createDataFrame([(0, "x" * 1000), (0, None), (1, "y"), (2, "z" * 9000)], "batch_id int, english string")
    assert {r.batch_id: r.budget for r in token_budget(b, "english").collect()} == {0: 896, 1: 384, 2: 3072}
    row = spark.range(1).select(*[phase_seed(F.lit(p), F.lit(2), F.lit(1), F.lit(1)).alias(p) for p in ("PILOT", "PRIMARY_REPAIR", "RECOVERY_SMALL_BATCH", "RECOVERY_SINGLE")]).first()
    assert tuple(row) == (213, 300422, 100213, 200222)


@pytest.mark.parametrize("chunk", [3, 1000])
def test_running_sums(spark, chunk):
    df = spark.createDataFrame([(i, i % 5 if i % 3 else None) for i in range(40)], "i bigint, v bigint")
    total, want = 0, []
    for i in range(40):
        total += (i % 5) if i % 3 else 0
        want.append(total)
    assert [r.run_v for r in running_sums(df, "i", ["v"], chunk).orderBy("i").collect()] == want


def test_cascade_outcomes(spark):
    rows = []
    for key, good in (("first", 1), ("repaired", 3), ("group", 4), ("single", 5), ("never", 9), ("waiting", None)):
        for n in range(1, 3 if good is None else 7):
            rows.append((key, n, n == good, [] if n == good else [f"E{n}"], ["W"] if key == "group" and n == good else []))
    a = spark.createDataFrame(rows, "key string, attempt_no int, ok boolean, errors array<string>, warnings array<string>")
    got = {r.key: r for r in cascade.outcomes(a).collect()}
    r3 = "RECOVERED_AFTER_QA_REJECTION"
    assert [(got[k].status, got[k].phase, got[k].attempts, got[k].warnings) for k in ("first", "repaired", "group", "single")] == [
        ("LOCAL_OK", "PRIMARY", 1, []),
        ("REVIEW", "PRIMARY_REPAIR", 3, [r3]),
        ("REVIEW", "RECOVERY_SMALL_BATCH", 1, ["W"]),
        ("REVIEW", "RECOVERY_SINGLE", 1, [r3]),
    ]
    assert (got["never"].status, got["never"].attempts, got["never"].errors) == ("TECHNICAL_ERROR", 3, ["E5", "E6"])
    assert got["waiting"].status == "PENDING"


def counters(spark, rows):
    return cascade.running_counters(spark.createDataFrame([(i, *r, *[0] * (11 - len(r))) for i, r in enumerate(rows)], "batch_id bigint, " + ", ".join(f"{c} bigint" for c in cascade.COUNTERS)))


def test_gates_and_first_fire(spark):
    # items, accepted, direct, repaired, unresolved
    fine = (50, 50, 50, 0, 0)
    g = cascade.gates(counters(spark, [fine, (50, 47, 47, 0, 3), fine, fine]))
    assert [r.gate for r in g.orderBy("batch_id").collect()] == [None, "UNRESOLVED_RATE_TOO_HIGH", "UNRESOLVED_RATE_TOO_HIGH", None]
    assert cascade.until_first_gate(g).count() == 2
    g = cascade.gates(counters(spark, [(10, 7, 7, 0, 3), fine, fine]))
    assert g.orderBy("batch_id").first().gate == "EARLY_RECOVERY_GROWTH"
    g = cascade.gates(counters(spark, [fine, (4, 0, 0, 0, 4, 1, 1), fine]))
    assert [r.gate for r in g.orderBy("batch_id").collect()][1] == "UNRECOVERED_BATCH_WIDE_FAILURE"
    assert cascade.until_first_gate(cascade.gates(counters(spark, [fine, fine, fine]))).count() == 3
    # The last batch has no growth gate, but a poor pilot still stops the run.
    poor = cascade.gates(counters(spark, [(60, 60, 60, 0, 0), (60, 55, 55, 0, 5)]))
    assert [r.gate for r in poor.orderBy("batch_id").collect()] == [None, None]
    assert cascade.pilot_verdict(counters(spark, [(60, 60, 60, 0, 0), (60, 55, 55, 0, 5)])).first().verdict == "PILOT_ACCEPTANCE_TOO_LOW"


def test_repair_projection(spark):
    rows = [("a", "日", "x", ["UNEXPECTED_CJK"]), ("b", "日", "x", ["NUMBER_MISMATCH"]), ("c", None, None, [])]
    got = {r.key: tuple(r)[1:] for r in cascade.repair_projection(spark.createDataFrame(rows, "key string, japanese string, candidate string, errors array<string>")).collect()}
    assert got == {"a": (None, "", ["UNEXPECTED_CJK"], "ENGLISH_ONLY"), "b": ("日", "x", ["NUMBER_MISMATCH"], None), "c": ("", "", ["RETRANSLATE_REQUIRED"], None)}


def test_job_glossary_log_and_bundle_files(spark, tmp_path):
    item = {"key": "k1", "file": "f", "row": 1, "id": "i", "subid": "", "type": "t", "english": "Go", "japanese": "", "currentVietnamese": "", "inheritedR3": False, "sourceHash": "h"}
    job = tmp_path / "job.json"
    job.write_text(json.dumps({"jobId": "j", "items": [item, {**item, "key": "k2"}]}, indent=1))
    assert [(r.jobId, r.ord, r.key) for r in files.read_job(spark, str(job)).collect()] == [("j", 1, "k1"), ("j", 2, "k2")]
    glossary = tmp_path / "glossary.json"
    glossary.write_text(json.dumps({"keepExact": ["A"], "translateAs": {"b": "c"}}, indent=1))
    assert [tuple(r) for r in files.read_glossary(spark, str(glossary)).orderBy("ord").collect()] == [("A", None, 1), ("b", "c", 2)]
    text = "".join(json.dumps({"seq": i, "key": f"k{i}"}) + "\n" for i in range(5)) + "\n   \n"
    for cut in (len(text) - 8, len(text)):
        log = tmp_path / f"log{cut}.jsonl"
        log.write_text(text[:cut] + '{"seq": 9, "ke')
        assert sorted(r.seq for r in files.read_log(spark, str(log), "seq bigint, key string").collect()) == list(range(5 if cut == len(text) else 4))
    records = spark.createDataFrame([("b", "x"), ("A", "y"), ("a", "z")], "key string, vietnamese string")
    archive = files.write_bundle(records, spark.createDataFrame([(3,)], "total int"), str(tmp_path / "out"), "j", "hash")
    names = zipfile.ZipFile(archive).namelist()
    assert "manifest.json" in names
    assert [r.key for r in files.ordered(records).collect()] == ["a", "A", "b"]
    (tmp_path / "tree").mkdir()
    (tmp_path / "tree" / "config.json").write_text("{}")
    (tmp_path / "tree" / "ok.txt").write_text("")
    found = files.forbidden_files(spark, str(tmp_path / "tree"), [r"config\.json$"]).collect()
    assert [os.path.basename(r.path) for r in found] == ["config.json"]


def test_candidate_provider(spark):
    b = spark.createDataFrame([(0, 1, "a", "t", "Go", ""), (0, 2, "b", "t", "Stay", ""), (1, 3, "c", "t", "Wait", "")], "batch_id bigint, ord bigint, key string, type string, english string, japanese string")

    def answer(request):
        assert request["schema"]["required"] == [r["key"] for r in request["rows"]]
        return json.dumps({r["key"]: r["english"].upper() for r in request["rows"][:1]}) if request["batch_id"] == 0 else "oops"

    got = {r.key: r for r in provider.attempts(provider.requests_of(b), answer).collect()}
    assert (got["a"].candidate, got["a"].structured) == ("GO", True)
    assert got["b"].error == "MISSING_STRUCTURED_KEY"
    assert got["c"].error.startswith("INVALID_JSON:")
    models = spark.createDataFrame([("k1", "Nine B", "q4"), ("k2", "Two B", "q8")], "key string, display_name string, selected_variant string")
    assert [r.key for r in provider.preferred_models(models, ["nine", "Q4"]).collect()] == ["k1"]


def test_streamed_state_is_the_latest_record(spark, tmp_path):
    rng = random.Random(3)
    rows = [record(i, rng.choice(["a", "b", "c", None]), str(i), hash=rng.choice(["h", "old"])) for i in range(60)]
    lines = spark.createDataFrame([line(i, k) for i, k in enumerate("ab")], LINE)
    log = spark.createDataFrame(rows, schemas.RECORD)
    log.repartition(5).write.parquet(str(tmp_path / "feed"))
    held = LatestTable(spark, work_dir(spark, "s"), schemas.RECORD, parts=2)
    for _ in range(2):  # the second run finds nothing new
        latest_stream(spark, str(tmp_path / "feed"), schemas.RECORD, lines, held, str(tmp_path / "cp"), 2).awaitTermination()
    want = {k: max(r[0] for r in rows if r[2] == k and r[3] == "h") for k in "ab"}
    assert {r.key: r.seq for r in held.read().collect()} == want


def test_joins_with_hot_keys(spark):
    rows = spark.createDataFrame(pd.DataFrame({"k": ["hot"] * 3000 + [str(i) for i in range(500)] + [None] * 20, "i": range(3520)}))
    dim = spark.createDataFrame([("hot", 1), ("7", 2), ("x", 3)], "k string, v int")
    counted = dim.join(rows.groupBy("k").count(), "k")
    got = hot_split_join(rows, counted, ["k"], "count", 3500)
    assert got.groupBy("v").count().orderBy("v").collect() == [(1, 3000), (2, 1)]
    got = many_to_one(rows, dim, ["k"])
    assert got.groupBy("v").count().orderBy("v").collect() == [(1, 3000), (2, 1)]
    with pytest.raises(ValueError):
        hot_split_join(rows, counted.withColumn("i", F.lit(1)), ["k"], "count", 1)
