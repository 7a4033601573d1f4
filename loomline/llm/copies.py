"""Problem 1: duplicates hidden by formatting differences.

Dictionary encoding: every distinct text is canonicalised once, every distinct
canonical value gets an integer, and each record becomes the sorted tuple of its
fields' integers.  Only those tuples are grouped, never the texts.

1. dictionary: distinct (text, kind), found by a grouping with map-side combine;
   the text then leaves the plan and is known by a 128-bit hash;
2. integers: the distinct canonical hashes are written once to the shared folder
   with ``monotonically_increasing_id`` - unique without a global sort, and
   stable because they are read back, never recomputed;
3. records: both fields' integers, sorted, so exchanged fields meet;
4. groups: tuple -> lowest ord and number of copies, with map-side combine.

A text that holds a third of all rows is one dictionary entry; its rows get
their integer by a broadcast of the at most 500 hot entries (skew.py).

Defined cases: null, '' and texts without a letter or digit are the integer 0;
records with 0 in both fields are no case.  Texts are compared whole, whatever
their length.  ``type`` = ``equip_stats`` makes a text a set of pieces, any other
type (null too) a plain text; a plain record equal to the plain form of a list
record belongs to that list's group.  Repeated ord values (not in the contract)
count as rows of their own.  Empty tables give empty results.  Other columns of
the input are not read, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.functions.text import nfc_udf, not_composed
from loomline.operators.skew import hot_split_join
from loomline.session import written

#: Between the pieces of a list text, half and full width.
PIECE_BREAK = "[|/;｜／；\\r\\n]+"
#: A hash that stands for "no letter or digit".
NOTHING = 0


def canonical(text: Column) -> Column:
    """Letters and digits in lower case."""
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}]+", "")


def canonical_pieces(text: Column) -> Column:
    """The canonical pieces of a list in one order; a label stays with its value."""
    pieces = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), PIECE_BREAK), canonical), lambda p: p != "")
    return F.array_join(F.array_sort(pieces), "\u0001")


def _hash(c: Column) -> list[Column]:
    return [F.xxhash64(c), F.xxhash64(F.lit(0x9E3779B97F4A7C15 - (1 << 64)), c)]


def encode(rows: DataFrame, ident: str, first: str, second: str, listed: Column) -> DataFrame:
    """ident, plain tuple (pa, pb) and key tuple (ka, kb) of each row with a
    letter or digit in one of its fields."""
    base = rows.select(F.col(ident).alias("i"), F.coalesce(listed, F.lit(False)).alias("l"), F.col(first).alias("a"), F.col(second).alias("b"))
    values = base.select("l", F.explode(F.array("a", "b")).alias("v")).filter(F.col("v").rlike("[\\p{L}\\p{N}]")).groupBy("l", "v").agg(F.count(F.lit(1)).alias("n"))
    composed = values.filter(~not_composed(F.col("v"))).withColumn("c", F.col("v"))
    other = values.filter(not_composed(F.col("v"))).withColumn("c", nfc_udf(F.col("v")))
    canon = composed.unionByName(other)
    p, q = _hash(F.col("p")), _hash(F.col("q"))
    raw = (
        canon.select("l", "n", *[h.alias(f"r{k}") for k, h in enumerate(_hash(F.col("v")))], canonical(F.col("c")).alias("p"), F.when(F.col("l"), canonical_pieces(F.col("c"))).alias("q"))
        .withColumn("q", F.coalesce("q", "p"))
        .select("l", "n", "r0", "r1", p[0].alias("p0"), p[1].alias("p1"), q[0].alias("q0"), q[1].alias("q1"))
    )
    raw = written(raw, "dictionary")
    forms = raw.select("p0", "p1").union(raw.filter("l").select("q0", "q1")).distinct().withColumn("id", F.monotonically_increasing_id() + 1)
    ids = written(forms, "integers")
    entry = raw.join(ids.withColumnRenamed("id", "pid"), ["p0", "p1"]).select("l", "n", "r0", "r1", "q0", "q1", "pid")
    plain = entry.filter("not l").withColumn("qid", F.col("pid"))
    pieces = entry.filter("l").join(ids.select(F.col("p0").alias("q0"), F.col("p1").alias("q1"), F.col("id").alias("qid")), ["q0", "q1"])
    cols = ["l", "r0", "r1", "n", "pid", "qid"]
    dictionary = written(plain.select(cols).unionByName(pieces.select(cols)), "encoded")
    total = dictionary.agg(F.sum("n")).first()[0] or 0

    # The texts leave the rows at once: only their hashes are shuffled.
    keyed = base.select(
        "i", "l", *[F.struct(*[h.alias(f"h{k}") for k, h in enumerate(_hash(F.col(c)))]).alias(f"h{c}") for c in "ab"], *[F.coalesce(F.col(c).rlike("[\\p{L}\\p{N}]"), F.lit(False)).alias(f"has_{c}") for c in "ab"]
    ).filter("has_a or has_b")
    return _tuples(keyed, dictionary, total)


def _tuples(keyed: DataFrame, dictionary: DataFrame, total: int) -> DataFrame:
    for c in "ab":
        zero = F.lit(NOTHING).cast("long")
        none = keyed.filter(f"not has_{c}").drop(f"h{c}", f"has_{c}").withColumns({f"p{c}": zero, f"k{c}": zero})
        some = keyed.filter(f"has_{c}").withColumns({"r0": F.col(f"h{c}.h0"), "r1": F.col(f"h{c}.h1")}).drop(f"h{c}", f"has_{c}")
        got = hot_split_join(some, dictionary, ["l", "r0", "r1"], "n", total).withColumnsRenamed({"pid": f"p{c}", "qid": f"k{c}"})
        keyed = none.unionByName(got.select(none.columns))
    low, high = lambda x: F.least(f"{x}a", f"{x}b"), lambda x: F.greatest(f"{x}a", f"{x}b")
    return keyed.select("i", "l", low("p").alias("p0"), high("p").alias("p1"), low("k").alias("k0"), high("k").alias("k1"))


def copy_groups(encoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(tuple -> first, copies, n) and (group -> first, copies)."""
    parts = encoded.groupBy("l", "p0", "p1", "k0", "k1").agg(F.min("i").alias("low"), F.count(F.lit(1)).alias("n"))
    parts = written(parts, "tuples")
    # A plain record that equals a list record letter by letter takes the list's key.
    lists = parts.filter("l").groupBy("p0", "p1").agg(F.min(F.struct("k0", "k1")).alias("as_list"))
    plain = parts.filter("not l").join(lists, ["p0", "p1"], "left")
    plain = plain.withColumns({"g0": F.coalesce("as_list.k0", "k0"), "g1": F.coalesce("as_list.k1", "k1")}).drop("as_list")
    keyed = plain.unionByName(parts.filter("l").withColumns({"g0": F.col("k0"), "g1": F.col("k1")}).select(plain.columns))
    groups = keyed.groupBy("g0", "g1").agg(F.min("low").alias("first"), F.sum("n").alias("copies"))
    return keyed, groups


def distinct_records(rows: DataFrame, ident: str, first: str, second: str, listed: Column) -> DataFrame:
    """One row per distinct record: its lowest ident and its number of copies."""
    return copy_groups(encode(rows, ident, first, second, listed))[1].select(F.col("first").alias(f"first_{ident}"), "copies")


def surplus_copies(rows: DataFrame, ident: str, first: str, second: str, listed: Column) -> DataFrame:
    """One row per surplus copy: the lowest ident of its group and its own."""
    encoded = written(encode(rows, ident, first, second, listed), "records")
    keyed, groups = copy_groups(encoded)
    again = keyed.join(groups.filter("copies > 1"), ["g0", "g1"]).select("l", "p0", "p1", "k0", "k1", "n", "first")
    again = written(again, "repeated")
    total = again.agg(F.sum("n")).first()[0] or 0
    out = hot_split_join(encoded, again, ["l", "p0", "p1", "k0", "k1"], "n", total)
    return out.filter(F.col("i") > F.col("first")).select(F.col("first").alias(f"first_{ident}"), F.col("i").alias(ident))
