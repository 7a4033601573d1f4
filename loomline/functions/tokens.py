"""Technical tokens, numbers and terms in a text, as Columns.

Arguments are composed texts with LF line ends (see text.py).  All results are
arrays in byte order, so equal arrays are equal multisets.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The token classes of the data format.
BRACES = r"\{[^{}\r\n]*\}"
ANGLES = r"<[^<>\r\n]*>"
PRINTF = r"(?<!\d)%(?:\d+\$)?[-+#0']*(?:\d+|\*)?(?:\.(?:\d+|\*))?[hlLzjt]*[diuoxXfFeEgGaAcspn%]"
ESCAPES = r'\\[nrt"\\]'
PRIVATE = r"[\x{E000}-\x{F8FF}]"
TOKEN_CLASSES = {"brace": BRACES, "angle": ANGLES, "printf": PRINTF, "escape": ESCAPES, "private": PRIVATE}
WORD_CHAR = r"[\p{L}\p{N}_]"
NUMBER = r"[-+]?\d+(?:[.,]\d+)*"
WHOLE_NUMBER = rf"(?<!{WORD_CHAR}){NUMBER}(?:%|x)?(?!{WORD_CHAR})"


def _all(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def technical_tokens(text: Column) -> Column:
    """All token classes; each reads the whole text, so nested tokens count in both."""
    return F.array_sort(F.concat(*[_all(text, p) for p in TOKEN_CLASSES.values()]))


def canonical_number(token: Column) -> Column:
    """One spelling for each value: groups of three lose their separators, else the
    last separator is the decimal point; outer zeros go; sign and suffix stay."""
    core = F.regexp_extract(token, rf"^[-+]?(\d+(?:[.,]\d+)*)", 1)
    sign = F.regexp_extract(token, "^([-+]?)", 1)
    suffix = F.lower(F.regexp_extract(token, "([%xX]?)$", 1))
    grouped = core.rlike(r"^\d{1,3}(?:[.,]\d{3})+$")
    bare = lambda c: F.regexp_replace(c, "[.,]", "")
    whole = F.when(grouped, bare(core)).otherwise(bare(F.regexp_replace(core, r"[.,]\d+$", "")))
    part = F.when(grouped, "").otherwise(F.regexp_replace(F.regexp_extract(core, r"[.,](\d+)$", 1), "0+$", ""))
    whole = F.regexp_replace(whole, r"^0+(?=\d)", "")
    return F.concat(sign, whole, F.when(part == "", "").otherwise(F.concat(F.lit("."), part)), suffix)


def numbers(text: Column) -> Column:
    """Canonical numbers that touch no letter, digit or underscore."""
    return F.array_sort(F.transform(_all(text, WHOLE_NUMBER), canonical_number))


def loose_numbers(text: Column) -> Column:
    """Canonical numbers anywhere, for scripts without blanks."""
    return F.array_sort(F.transform(_all(text, NUMBER), canonical_number))


def term_pattern(term: str, case_sensitive: bool = False) -> str:
    """Whole-word pattern of a literal term."""
    return ("" if case_sensitive else "(?iu)") + rf"(?<!{WORD_CHAR}){re.escape(term)}(?!{WORD_CHAR})"


def term_count(text: Column, term: str, case_sensitive: bool = False) -> Column:
    """The cheap test first: most texts don't hold most terms."""
    held = F.contains(text, F.lit(term)) if case_sensitive else F.contains(F.lower(text), F.lit(term.lower()))
    return F.when(held, F.regexp_count(text, F.lit(term_pattern(term, case_sensitive)))).otherwise(F.lit(0))


def without_terms(text: Column, terms: list[str]) -> Column:
    """Longer terms go first."""
    return reduce(lambda c, t: F.regexp_replace(c, term_pattern(t, True), " "), sorted(terms, key=len, reverse=True), text)


def punctuation_only(text: Column) -> Column:
    return (F.length(text) > 0) & ~text.rlike(r"[\p{L}\p{N}]")


# Sounds that are no words.
SOUNDS = "a+h+|g+r+a+h+|g+r+o+a+r+|g+r+|r+a+h+|r+o+a+r+|u+g+h+|h+m+|m+|s+h+|h+m+p+h+"


def sounds_only(text: Column, keep: list[str]) -> Column:
    """Whether all Latin words outside the kept terms are mere sounds."""
    found = _all(without_terms(text, keep), "[A-Za-z]+")
    return (F.size(found) > 0) & F.forall(found, lambda w: w.rlike(f"(?i)^(?:{SOUNDS})$"))


def keeps_source(ident: Column) -> Column:
    """Metadata lines, whose text is never translated."""
    from loomline.functions.text import strip

    return F.coalesce(F.startswith(strip(ident), F.lit("TXT_CV_")), F.lit(False))
