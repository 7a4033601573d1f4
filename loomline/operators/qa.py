"""Deterministic checks of a candidate translation, as one struct column.

``checked(df, ...)`` adds the tokens of both texts as columns first, so every
pattern runs once for each text; the rules then compare arrays.
Null texts count as ''.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.functions.text import collapsed, line_feeds, strip, utf16_length
from loomline.functions.tokens import keeps_source, loose_numbers, numbers, sounds_only, technical_tokens, term_count

#: Placeholder that protects a token on its way through a model.
MARKER = r"LOOMKEEP\d+END"
# Words whose presence hints at text left in English.
ENGLISH_HINTS = "the and but with from this that have will would could should your their into before after".split()


@dataclass(frozen=True)
class Glossary:
    """keep: terms that stay as they are; translate: term -> target."""

    keep: tuple[str, ...] = ()
    translate: dict[str, str] = field(default_factory=dict)
    #: Longest glossary that is built into a plan as literals.
    LIMIT = 2000

    @staticmethod
    def of(terms: DataFrame) -> Glossary:
        """From a dimension table (term, target, ord); its size is checked."""
        rows = terms.orderBy("ord").limit(Glossary.LIMIT + 1).collect()
        if len(rows) > Glossary.LIMIT:
            raise ValueError(f"a glossary has {Glossary.LIMIT} terms at most")
        keep = tuple(dict.fromkeys(r.term for r in rows if r.target is None))
        return Glossary(keep, {r.term: r.target for r in rows if r.target is not None})


ADDED = ["__en", "__jp", "__raw", "__vi", "__en_tech", "__vi_tech", "__en_num", "__vi_num", "__jp_num", "__en_flat", "__vi_flat"]


def with_tokens(df: DataFrame, english: str, japanese: str, candidate: str) -> DataFrame:
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    df = df.withColumns({"__en": line_feeds(F.col(english)), "__jp": line_feeds(F.col(japanese)), "__raw": blank(english), "__vi": strip(line_feeds(F.col(candidate)))})
    return df.withColumns(
        {
            "__en_tech": technical_tokens(F.col("__en")),
            "__vi_tech": technical_tokens(F.col("__vi")),
            "__en_num": numbers(F.col("__en")),
            "__vi_num": numbers(F.col("__vi")),
            "__jp_num": loose_numbers(F.col("__jp")),
            "__en_flat": collapsed(F.col("__en")),
            "__vi_flat": collapsed(F.col("__vi")),
        }
    )


def qa(ident: Column, glossary: Glossary) -> Column:
    """struct(ok, errors, warnings) from the columns of ``with_tokens``."""
    c = F.col
    en, vi, raw = c("__en_flat"), c("__vi"), c("__raw")
    meta = keeps_source(ident)
    same = c("__vi_flat") == en
    by_japanese = (F.size("__en_num") == 0) & (F.size("__jp_num") > 0) & (c("__jp_num") == c("__vi_num"))
    words = F.size(F.regexp_extract_all(en, F.lit("[A-Za-z]+(?:['’-][A-Za-z]+)*"), F.lit(0)))
    kept_only = en.isin(*glossary.keep) if glossary.keep else F.lit(False)
    unchanged = ~meta & ~kept_only & (words >= 2) & (F.lower("__vi_flat") == F.lower(en)) & ~sounds_only(en, list(glossary.keep))
    missing = [F.when(term_count(raw, t, True) > term_count(vi, t, True), f"PROTECTED_TERM_MISSING:{t}") for t in glossary.keep]
    hints = F.regexp_count(vi, F.lit(r"(?iu)(?<![\p{L}\p{N}_])(?:" + "|".join(ENGLISH_HINTS) + r")(?![\p{L}\p{N}_])"))
    size, ratio = utf16_length(raw), utf16_length(vi) / utf16_length(raw)
    errors = [
        F.when(vi == "", "EMPTY"),
        F.when(vi.rlike(r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsHangul}]"), "UNEXPECTED_CJK"),
        F.when(vi.rlike(MARKER), "UNRESTORED_MARKER"),
        F.when(vi.rlike("(?i)```|</?think>|/no_think|SOURCE_BEGIN|VIETNAMESE_BEGIN"), "MODEL_META_LEAK"),
        F.when(c("__en_tech") != c("__vi_tech"), "TECHNICAL_TOKEN_MISMATCH"),
        F.when((c("__en_num") != c("__vi_num")) & ~by_japanese, "NUMBER_MISMATCH"),
        *missing,
        F.when(meta & ~same, "KEEP_ENGLISH_SOURCE_MISMATCH"),
        F.when(unchanged, "UNCHANGED_ENGLISH"),
    ]
    warnings = [
        F.when(meta & same, "DETERMINISTIC_KEEP_ENGLISH_ID:TXT_CV"),
        F.when(hints >= 2, "POSSIBLE_ENGLISH_LEAK"),
        F.when(F.contains(raw, F.lit("\n")) & ~F.contains(vi, F.lit("\n")), "LINE_BREAKS_COLLAPSED"),
        F.when((size >= 20) & ((ratio > 2.5) | (ratio < 0.22)), "SUSPICIOUS_LENGTH_RATIO"),
    ]
    found = F.array_compact(F.array(*errors))
    return F.struct((F.size(found) == 0).alias("ok"), found.alias("errors"), F.array_compact(F.array(*warnings)).alias("warnings"))


def checked(df: DataFrame, glossary: Glossary, english: str = "english", japanese: str = "japanese", candidate: str = "vietnamese", ident: str = "id", out: str = "check") -> DataFrame:
    return with_tokens(df, english, japanese, candidate).withColumn(out, qa(F.col(ident), glossary)).drop(*ADDED)


def accepted_status(warnings: Column) -> Column:
    return F.when(F.size(warnings) > 0, "REVIEW").otherwise("LOCAL_OK")
