"""Queries of the training-data operators and, where SQL can say it, their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomline.llm.copies import distinct_records, surplus_copies
from loomline.llm.leakage import exact_leaks, leaks
from loomline.llm.mixing import Mix
from loomline.llm.packing import fill_report, pack
from loomline.llm.pairs import defects
from loomline.llm.subjects import composition, document_subjects
from loomline.session import table, written


def _job(spark, sf_dir):
    return table(spark, sf_dir, "story_job"), F.col("type") == "equip_stats"


def p1_found(spark, sf_dir):
    job, listed = _job(spark, sf_dir)
    return surplus_copies(job, "ord", "english", "japanese", listed)


def p1_distinct_pairs(spark, sf_dir):
    job, listed = _job(spark, sf_dir)
    return distinct_records(job, "ord", "english", "japanese", listed)


def p2_found(spark, sf_dir):
    log = table(spark, sf_dir, "story_translations").filter(F.coalesce(F.col("status") != "TECHNICAL_ERROR", F.lit(True)))
    lines = table(spark, sf_dir, "story_job").filter(~F.coalesce(F.startswith("id", F.lit("TXT_CV_")), F.lit(False)) & F.col("english").rlike("[\\p{L}\\p{N}]"))
    return defects(log, lines, "seq", "vietnamese", ["key", "sourceHash"], "english", "japanese")


def _packed(spark, sf_dir):
    # A fixed table of a few rows.
    profiles = [(r.profile, r.capacity) for r in table(spark, sf_dir, "batch_profiles").orderBy("profile").collect()]
    units = F.coalesce(F.length("english"), F.lit(0)) + F.coalesce(F.length("japanese"), F.lit(0))
    return pack(table(spark, sf_dir, "story_job"), "ord", units, profiles)


def p5_pack(spark, sf_dir):
    return _packed(spark, sf_dir)


def p5_fill(spark, sf_dir):
    return fill_report(_packed(spark, sf_dir), table(spark, sf_dir, "batch_profiles"))


def p5_invariants(spark, sf_dir):
    """What must hold of p5_pack in any good packing, so that SQL can say it: per
    profile the lines and units, and rows that break a rule (none)."""
    packed, profiles = written(_packed(spark, sf_dir), "packed"), table(spark, sf_dir, "batch_profiles")
    held = packed.groupBy("profile", "batch").agg(F.sum("length").alias("used"), F.max("batch_size").alias("size"))
    held = held.join(F.broadcast(profiles), "profile").groupBy("profile").agg(
        F.count_if((F.col("used") > F.col("capacity")) | (F.col("size") < F.col("used")) | (F.col("size") > F.col("capacity"))).alias("overfull"),
        (F.count(F.lit(1)) <= 1.02 * F.ceil(F.sum("used") / F.max("capacity")) + 1).alias("tight"),
    )
    # A line's pieces fill its length without gap; only lines over the capacity have several.
    line = packed.groupBy("profile", "ord").agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("units"), F.max(F.col("start") + F.col("length")).alias("end"), F.count_distinct("start").alias("starts"))
    line = line.join(F.broadcast(profiles), "profile").groupBy("profile").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum("units").alias("units"),
        F.count_if(((F.col("n") > 1) & (F.col("units") <= F.col("capacity"))) | (F.col("units") != F.col("end")) | (F.col("starts") != F.col("n"))).alias("cut_wrong"),
    )
    return held.join(line, "profile").select("profile", "lines", "units", "overfull", "cut_wrong", "tight")


def _leaks(spark, sf_dir):
    return leaks(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "eval_items"), "item_id", "text")


def p6_found(spark, sf_dir):
    return exact_leaks(_leaks(spark, sf_dir)).select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"))


def p6_leaks(spark, sf_dir):
    kind = F.when(F.col("run") >= 10, "exact").otherwise("paraphrase")
    found = _leaks(spark, sf_dir).filter("run >= 10 or lcs > 0")
    return found.select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"), kind.alias("kind"), "run", "lcs")


def _mix(spark, sf_dir, total=None):
    # A fixed table of a few rows.
    targets = [tuple(r) for r in table(spark, sf_dir, "mix_targets").select("source", "target_share", "max_repeats").collect()]
    return Mix(table(spark, sf_dir, "documents"), "doc_id", "text", "source", targets, total)


def p7_mix(spark, sf_dir):
    return _mix(spark, sf_dir).selection()


def p7_shares(spark, sf_dir):
    return _mix(spark, sf_dir).report()


def p7_corpus_shares(spark, sf_dir):
    """As p7_shares for a mix of the corpus's size, where scarce sources fall short."""
    return _mix(spark, sf_dir, "corpus").report()


def _subjects(spark, sf_dir):
    # A fixed table of a few rows.
    names = [r.subject for r in table(spark, sf_dir, "subject_areas").select("subject").orderBy("subject").collect()]
    return document_subjects(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "subject_labels"), "subject", names, "lang")


def p8_found(spark, sf_dir):
    return _subjects(spark, sf_dir)


def p8_composition(spark, sf_dir):
    return composition(_subjects(spark, sf_dir), table(spark, sf_dir, "documents"), "doc_id")


QUERIES = {
    "p1_found": p1_found,
    "p1_distinct_pairs": p1_distinct_pairs,
    "p2_found": p2_found,
    "p5_pack": p5_pack,
    "p5_fill": p5_fill,
    "p5_invariants": p5_invariants,
    "p6_found": p6_found,
    "p6_leaks": p6_leaks,
    "p7_mix": p7_mix,
    "p7_shares": p7_shares,
    "p7_corpus_shares": p7_corpus_shares,
    "p8_found": p8_found,
    "p8_composition": p8_composition,
}

_P1 = r"""
WITH c AS (SELECT ord, type = 'equip_stats' AS l,
    regexp_replace(lower(nfc_normalize(coalesce(english, ''))), '[^\p{L}\p{N}]+', '', 'g') AS a,
    regexp_replace(lower(nfc_normalize(coalesce(japanese, ''))), '[^\p{L}\p{N}]+', '', 'g') AS b,
    array_to_string(list_sort(list_filter(list_transform(string_split_regex(coalesce(english, ''), '[|/;｜／；\r\n]+'),
      lambda p: regexp_replace(lower(nfc_normalize(p)), '[^\p{L}\p{N}]+', '', 'g')), lambda p: p <> '')), chr(1)) AS la,
    array_to_string(list_sort(list_filter(list_transform(string_split_regex(coalesce(japanese, ''), '[|/;｜／；\r\n]+'),
      lambda p: regexp_replace(lower(nfc_normalize(p)), '[^\p{L}\p{N}]+', '', 'g')), lambda p: p <> '')), chr(1)) AS lb
  FROM story_job),
k AS (SELECT ord, coalesce(l, false) AS l, least(a, b) || chr(2) || greatest(a, b) AS p,
    CASE WHEN l THEN least(la, lb) || chr(2) || greatest(la, lb) ELSE least(a, b) || chr(2) || greatest(a, b) END AS q
  FROM c WHERE a <> '' OR b <> ''),
m AS (SELECT p, min(q) AS q FROM k WHERE l GROUP BY p),
g AS (SELECT k.ord AS ord, CASE WHEN k.l THEN k.q ELSE coalesce(m.q, k.q) END AS g FROM k LEFT JOIN m ON m.p = k.p)
"""

SQL = {
    "p5_invariants": """SELECT profile, count(*) AS lines, sum(length(coalesce(english, '')) + length(coalesce(japanese, '')))::BIGINT AS units,
  0::BIGINT AS overfull, 0::BIGINT AS cut_wrong, true AS tight FROM story_job, batch_profiles GROUP BY profile""",
    "p1_found": _P1 + "SELECT first_ord, ord FROM (SELECT min(ord) OVER (PARTITION BY g) AS first_ord, ord FROM g) WHERE first_ord < ord",
    "p1_distinct_pairs": _P1 + "SELECT min(ord) AS first_ord, count(*) AS copies FROM g GROUP BY g",
    "p6_found": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(nfc_normalize(text)), '[\p{L}\p{N}]+') AS w FROM documents),
e AS (SELECT item_id, regexp_extract_all(lower(nfc_normalize(text)), '[\p{L}\p{N}]+') AS w FROM eval_items),
dr AS (SELECT DISTINCT doc_id, array_to_string(w[i:i+9], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 8)) AS i FROM d WHERE len(w) >= 10)),
er AS (SELECT DISTINCT item_id, array_to_string(w[i:i+9], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - 8)) AS i FROM e WHERE len(w) >= 10))
SELECT DISTINCT doc_id, item_id FROM dr JOIN er USING (g)""",
}
