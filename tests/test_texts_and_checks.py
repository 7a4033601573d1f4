import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomline.functions.structured import parse_error, response_parts, response_text, structured_value
from loomline.functions.text import collapsed, compose, joined_url, line_feeds, source_hash, strip, unfenced, utf16_length
from loomline.functions.tokens import canonical_number, loose_numbers, numbers, technical_tokens, term_count
from loomline.operators.masking import mask, masked, repaired_aliases, restored
from loomline.operators.qa import Glossary, checked

G = Glossary(("Alder Keep", "Mira"))


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)) if values else spark.range(1)
    return df.select(column.alias("x")).first().x


def test_text_functions(spark):
    assert one(spark, line_feeds(F.col("a")), a="x\r\ny\rz") == "x\ny\nz"
    assert one(spark, line_feeds(F.col("a")), a=None) == ""
    assert one(spark, strip(F.col("a")), a="　 ﻿x y \n") == "x y"
    assert one(spark, collapsed(F.col("a")), a=" a　\n b c ") == "a b c"
    assert one(spark, utf16_length(F.col("a")), a="a😀") == 3
    assert one(spark, unfenced(F.col("a")), a="```json\n{}\n```") == "{}"
    assert compose(spark.createDataFrame([("é",), ("abc",), (None,)], "a string"), "a").collect() == [("abc",), (None,), ("é",)]
    assert joined_url("http://h/v1//", "/chat") == "http://h/v1/chat"
    import hashlib

    got = one(spark, source_hash(F.col("f"), F.col("r"), F.col("e"), F.col("j")), f="a", r="3", e="x", j=None)
    assert got == hashlib.sha256(b"a\x1f3\x1fx\x1f").hexdigest()


def test_token_classes(spark):
    text = r"{0} <b>x</b> 50%d %1$s %5.2f 9% dr \n " + ""
    assert sorted(one(spark, technical_tokens(F.col("a")), a=text)) == sorted(["{0}", "<b>", "</b>", "%1$s", "%5.2f", r"\n", ""])
    assert one(spark, technical_tokens(F.col("a")), a="{0:100}% based on") == ["{0:100}"]


@pytest.mark.parametrize(
    ("token", "value"),
    [("5,000", "5000"), ("5.000", "5000"), ("0.500", "0500"), ("1.50", "1.5"), ("+5", "+5"), ("007", "7"), ("1.234.5", "1234.5"), ("-2,50%", "-2.5%"), ("3X", "3x"), ("0", "0")],
)
def test_canonical_numbers(spark, token, value):
    # A group of three keeps its inner zeros: 0.500 counts as five hundred.
    assert one(spark, canonical_number(F.col("a")), a=token) == re.sub("^0+(?=[0-9])", "", value)


@settings(max_examples=20, deadline=None)
@given(st.lists(st.from_regex(r"\A[-+]?[0-9]{1,6}([.,][0-9]{1,4}){0,2}[%x]?\Z"), min_size=1, max_size=20))
def test_canonical_form_is_stable(spark, tokens):
    # Where a decimal part of three digits remains, reading it again would group it.
    df = spark.createDataFrame([(t,) for t in tokens], "a string").select(canonical_number(F.col("a")).alias("x"))
    df = df.filter(~F.col("x").rlike(r"^[-+]?\d{1,3}\.\d{3}[%x]?$"))
    assert df.filter(canonical_number(F.col("x")) != F.col("x")).count() == 0


def test_numbers_and_terms(spark):
    assert one(spark, numbers(F.col("a")), a="a1 12, 3x 4x5 -7 v_8 9%") == sorted(["12", "3x", "-7", "9%"])
    assert one(spark, loose_numbers(F.col("a")), a="第12話3回") == ["12", "3"]
    assert one(spark, term_count(F.col("a"), "Mira", True), a="Mira, mira Miran Mira's") == 2
    assert one(spark, term_count(F.col("a"), "old map"), a="Old map; the OLD MAP, old maps") == 2


@pytest.mark.parametrize(
    ("english", "candidate", "ident", "codes"),
    [
        ("Mira waits.", "Mira đang đợi.", "TXT_1", []),
        ("Mira waits.", "Cô ấy đang đợi.", "TXT_1", ["PROTECTED_TERM_MISSING:Mira"]),
        ("Open the gate now", "open  THE gate now", "TXT_1", ["UNCHANGED_ENGLISH"]),
        ("Hello", "こんにちは", "TXT_1", ["UNEXPECTED_CJK"]),
        ("Up {0}% damage", "Tăng {0}% dựa trên", "TXT_1", []),
        ("Take %d", "Lấy %s", "TXT_1", ["TECHNICAL_TOKEN_MISMATCH"]),
        ("Take %d", "Lấy %d", "TXT_1", []),
        ("Jane Doe", "Jane Doe", "TXT_CV_1", []),
        ("Jane Doe", "Doe", "TXT_CV_1", ["KEEP_ENGLISH_SOURCE_MISMATCH"]),
        ("Alder Keep", "Alder Keep", "TXT_1", []),
        ("Grr ah hmm", "Grr ah hmm", "TXT_1", []),
        ("Go", None, "TXT_1", ["EMPTY"]),
        ("Go", "đi LOOMKEEP000001END", "TXT_1", ["UNRESTORED_MARKER"]),
        ("Go", "```đi", "TXT_1", ["MODEL_META_LEAK"]),
        ("Pay 5,000 gold", "Trả 5.000 vàng", "TXT_1", []),
        ("Pay 5 gold", "Trả 6 vàng", "TXT_1", ["NUMBER_MISMATCH"]),
        (None, "", "TXT_1", ["EMPTY"]),
    ],
)
def test_errors(spark, english, candidate, ident, codes):
    df = spark.createDataFrame([(english, "", candidate, ident)], "english string, japanese string, vietnamese string, id string")
    r = checked(df, G).first().check
    assert r.errors == codes
    assert r.ok == (not codes)


def test_warnings_and_numbers_from_japanese(spark):
    df = spark.createDataFrame([("Line\nbreak of the road that goes far", "3本", "the and 3", "TXT_1")], "english string, japanese string, vietnamese string, id string")
    r = checked(df, G).first().check
    assert r.errors == []
    assert r.warnings == ["POSSIBLE_ENGLISH_LEAK", "LINE_BREAKS_COLLAPSED"]


def test_structured_responses(spark):
    text = F.col("a")
    assert one(spark, parse_error(text), a="{") == "INVALID_JSON"
    assert one(spark, parse_error(text), a="[1]") == "JSON_ROOT_NOT_OBJECT"
    assert one(spark, parse_error(text), a="null") == "JSON_ROOT_NOT_OBJECT"
    assert one(spark, parse_error(text), a='```json\n{"k": "v"}\n```') is None
    assert one(spark, structured_value(text, "k"), a='{"k": "v"}') == "v"
    assert one(spark, structured_value(text, "k"), a='{"k": 1}') is None
    assert one(spark, structured_value(text, "k"), a='{"x": "v"}') is None
    assert one(spark, response_text(F.col("a"), F.col("b"), F.col("c")), a="", b=None, c="z") == "z"
    assert one(spark, response_parts(F.array(F.lit("a"), F.lit(None), F.lit("b")))) == "a\n\nb"


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab {}<>%d\\n1$ Mira_\n")), max_size=60))
def test_mask_then_restore_is_identity(text):
    m, r = mask(text, ["Mira"], 0)
    for marker, value in r:
        m = m.replace(marker, value)
    assert m == text


def test_masks_count_through_a_group(spark):
    df = spark.createDataFrame([(1, 1, "{0} Mira"), (1, 2, "<b>"), (2, 3, "{1}"), (2, 4, None)], "g int, ord int, t string")
    got = {r.ord: r for r in masked(df, "g", "ord", "t", ["Mira"]).withColumn("back", restored(F.col("masked"), F.col("replacements"))).collect()}
    assert got[1].masked == "LOOMKEEP000000END LOOMKEEP000001END"
    assert got[2].masked == "LOOMKEEP000002END"
    assert got[3].masked == "LOOMKEEP000000END"
    assert [got[i].back for i in (1, 2, 3, 4)] == ["{0} Mira", "<b>", "{1}", ""]


def test_aliases_are_repaired_up_to_the_deficit(spark):
    df = spark.createDataFrame([("Mira and Mira", "Mirra, mirra và Mirra"), ("x", "Mirra"), (None, None)], "e string, c string")
    got = [tuple(r) for r in repaired_aliases(df, "e", "c", "Mira", ["mirra"]).select("repaired", "repairs").collect()]
    assert ("Mira, Mira và Mirra", ["CANONICALIZED_PROTECTED_ALIAS:Mirra->Mira", "CANONICALIZED_PROTECTED_ALIAS:mirra->Mira"]) in got
    assert ("Mirra", []) in got
    assert ("", []) in got
