import random
import re
import unicodedata
from collections import defaultdict

from pyspark.sql import functions as F

from loomline.llm.copies import distinct_records, surplus_copies

KIND = "ord bigint, type string, english string, japanese string, n int, l string"
LISTED = "type = 'equip_stats'"


def canon(t):
    return re.sub(r"[\W_]+", "", unicodedata.normalize("NFC", t or "").lower())


def brute(rows):
    keys = {}
    for o, kind, a, b, *_ in rows:
        p = tuple(sorted((canon(a), canon(b))))
        if p == ("", ""):
            continue
        q = tuple(sorted(tuple(sorted(filter(None, map(canon, re.split(r"[|/;｜／；\r\n]+", x or ""))))) for x in (a, b)))
        keys[o] = (kind == "equip_stats", p, q)
    lists = defaultdict(list)
    for is_list, p, q in keys.values():
        if is_list:
            lists[p].append(q)
    groups = defaultdict(list)
    for o, (is_list, p, q) in keys.items():
        groups[q if is_list else (min(lists[p]) if p in lists else p)].append(o)
    return {min(g): sorted(g) for g in groups.values()}


def check(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], KIND)
    want = brute(rows)
    got = sorted(map(tuple, surplus_copies(df, "ord", "english", "japanese", F.expr(LISTED)).collect()))
    assert got == sorted((f, o) for f, g in want.items() for o in g[1:])
    assert sorted(map(tuple, distinct_records(df, "ord", "english", "japanese", F.expr(LISTED)).collect())) == sorted((f, len(g)) for f, g in want.items())
    return want


def test_formatting_and_order_are_ignored(spark):
    rows = [
        (1, "scenario", "Go  home!", "帰れ。"), (2, "scenario", "go-home", "帰れ"), (3, None, "帰れ", "GO HOME"), (4, "scenario", "home go", "帰れ"),
        (5, "equip_stats", "Name: A / Rank: 3", "名称：ア ／ 等級：3"), (6, "equip_stats", "等級＝3；名称＝ア", "rank 3\nname a"), (7, "equip_stats", "Name: 3 / Rank: A", "名称：ア ／ 等級：3"),
        (8, "scenario", "Name: A / Rank: 3", "名称：ア ／ 等級：3"), (9, "scenario", "Rank: 3 / Name: A", "名称：ア ／ 等級：3"),
        (10, "quest", None, ""), (11, "quest", "...", "！"), (12, "quest", "only", None), (13, "quest", "", "only"), (14, "quest", "x" * 60_000, None), (15, "quest", "X" * 60_000 + " ", None),
        (16, "quest", "Café", None), (17, "quest", "Café", None),
    ]
    want = check(spark, rows)
    assert want[1] == [1, 2, 3]
    assert want[5] == [5, 6, 8]
    assert want[12] == [12, 13]
    assert want[14] == [14, 15]
    assert want[16] == [16, 17]


def test_random_rows_with_a_hot_value(spark):
    rng = random.Random(5)
    words = ["a b", "A-B", "b a", "c", "C!", "x / y", "y | x", None, "", "…"]
    rows = [(i, rng.choice(["equip_stats", "quest", None]), "same" if i % 3 == 0 else rng.choice(words), rng.choice(words)) for i in range(4000)]
    check(spark, rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], KIND)
    assert surplus_copies(df, "ord", "english", "japanese", F.expr(LISTED)).count() == 0
    assert distinct_records(df, "ord", "english", "japanese", F.expr(LISTED)).count() == 0
