import json
import re

from oracle import DATA
from pyspark.sql import functions as F

from loomline.operators import worker
from loomline.operators.qa import Glossary
from loomline.plans.queries import QUERIES
from loomline.session import table

LINE = "ord bigint, key string, id string, type string, english string, japanese string, phase string"
GLOSSARY = Glossary(("Oakhart",), {})
ALIASES = {"Oakhart": [r"(?<!\w)Oak\s+Hart(?!\w)"]}


def provider():
    # Inside a function, so that workers get it by value.
    def answer(request):
        """Fails by key: the letter's place is the attempt at which it becomes good."""
        out = {}
        for row in request["rows"]:
            good = "abcdefgh".find(row["key"]) + 1
            if row["key"] in ("dots", "none"):
                out[row["key"]] = ""
            elif row["key"] == "alias":
                out[row["key"]] = "Oak  Hart đi nhé"
            elif request["attempt"] >= good:
                out[row["key"]] = "Đi nào " + row["key"]
            elif request["attempt"] > 1:
                assert request["phase"] != "RECOVERY_SINGLE" or row["problems"]
                out[row["key"]] = "日本"
        return json.dumps(out, ensure_ascii=False) if out else "broken"

    return answer


def lines(spark, keys):
    text = {"dots": " … ", "alias": "Oakhart, go"}
    return spark.createDataFrame([(i, k, "TXT", "t", text.get(k, "Go now"), "行け", "clash") for i, k in enumerate(keys)], LINE)


def test_the_cascade_repairs_copies_recovers_and_gives_up(spark):
    out = worker.run(lines(spark, ["a", "b", "c", "d", "e", "f", "g", "dots", "none", "alias"]), provider(), GLOSSARY, aliases=ALIASES)
    got = {r.key: r for r in out.records.collect()}
    r3 = "RECOVERED_AFTER_QA_REJECTION"
    assert [(got[k].status, got[k].phase, got[k].attempts, got[k].warnings) for k in "abcdef"] == [
        ("LOCAL_OK", "PRIMARY", 1, []),
        ("REVIEW", "PRIMARY_REPAIR", 2, [r3]),
        ("REVIEW", "PRIMARY_REPAIR", 3, [r3]),
        ("LOCAL_OK", "RECOVERY_SMALL_BATCH", 1, []),
        ("REVIEW", "RECOVERY_SINGLE", 1, [r3]),
        ("REVIEW", "RECOVERY_SINGLE", 1, [r3]),
    ]
    assert (got["g"].status, got["g"].attempts, got["g"].vietnamese, got["g"].errors) == ("TECHNICAL_ERROR", 3, "", ["UNEXPECTED_CJK"])
    assert (got["none"].status, got["none"].errors) == ("TECHNICAL_ERROR", ["EMPTY"])
    assert (got["dots"].status, got["dots"].vietnamese, got["dots"].warnings) == ("REVIEW", " … ", ["DETERMINISTIC_PUNCTUATION_COPY"])
    assert (got["alias"].status, got["alias"].vietnamese, got["alias"].warnings) == ("REVIEW", "Oakhart đi nhé", ["CANONICALIZED_PROTECTED_ALIAS:Oak  Hart->Oakhart"])
    log = [r.asDict() for r in out.requests.orderBy("attempt_no", "batch_id").collect()]
    assert [(r["phase"], r["itemCount"], r["accepted"]) for r in log if r["attempt_no"] == 1] == [("PRIMARY", 10, 3)]
    assert {r["itemCount"] for r in log if r["attempt_no"] == 4} <= {2, 3}
    assert all(r["itemCount"] == 1 for r in log if r["attempt_no"] in (2, 3, 5, 6))
    bad = out.failures.filter("attempt_no = 1").first()
    assert bad["keys"] == ["b", "c", "d", "e", "f", "g", "none"]
    assert bad.reasons["b"] == ["MISSING_STRUCTURED_KEY"] and bad.reasons["none"] == ["EMPTY"]
    assert bad.responsePreview.startswith("{")


def test_lines_of_an_earlier_run_join_the_small_batches(spark):
    out = worker.run(lines(spark, ["a", "e"]), provider(), GLOSSARY, recovery=lines(spark, ["x", "y", "d"]).withColumn("ord", F.col("ord") + 10).filter("key = 'd'"))
    got = {r.key: (r.status, r.phase) for r in out.records.collect()}
    assert got == {"a": ("LOCAL_OK", "PRIMARY"), "e": ("REVIEW", "RECOVERY_SINGLE"), "d": ("LOCAL_OK", "RECOVERY_SMALL_BATCH")}
    assert out.attempts.filter("key = 'd'").agg(F.min("attempt_no")).first()[0] == 4


def test_an_empty_queue_and_null_texts(spark):
    empty = worker.run(lines(spark, []).filter("false"), provider(), GLOSSARY)
    assert empty.records.count() == empty.requests.count() == 0
    nulls = spark.createDataFrame([(1, "a", None, None, None, None, "x")], LINE)
    assert [r.status for r in worker.run(nulls, provider(), GLOSSARY).records.collect()] == ["LOCAL_OK"]


def test_long_responses_are_cut_in_the_failure_log(spark):
    out = worker.run(lines(spark, ["g"]), lambda r: "x" * 20_000, GLOSSARY)
    assert {len(r.responsePreview) for r in out.failures.collect()} == {12_000}
    assert out.records.first().errors[0].startswith("INVALID_JSON:")


def test_aliases_of_all_kept_terms_by_brute_force(spark):
    keep = sorted({r.term for r in table(spark, DATA, "glossary_terms").filter("target is null").select("term").collect()})
    order = [r.term for r in table(spark, DATA, "glossary_terms").filter("target is null").orderBy("ord").select("term").collect()]
    got = {r.ord: r.repaired for r in QUERIES["q37_alias_repair"](spark, DATA).collect()}
    hit = 0
    for r in table(spark, DATA, "story_job").select("ord", "english").collect():
        text = english = r.english or ""
        for t in dict.fromkeys(order):
            text = text.replace(t, t.upper() + "S")
        for t in dict.fromkeys(order):
            whole = rf"(?<!\w){t}(?!\w)"
            need = len(re.findall(whole, english)) - len(re.findall(whole, text))
            if need > 0:
                text = re.sub(rf"(?<!\w){t}s?(?!\w)", t, text, count=need, flags=re.I)
                hit += 1
        assert got[r.ord] == text
    assert hit > 20 and len(keep) == 4
