"""Text normalisation, hashing and scalar text functions as Columns.

Strings are measured in code points.  Everything but composition is native, so
it stays in whole-stage code generation.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

#: White space as the reference's runtime defines it (wider than Java's \s).
SPACE = "[\\s\\x0B\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}\\x{FEFF}]"
#: Blocks in which canonical composition can change a text; all other text is
#: composed already.
_UNCOMPOSED = "[\\p{M}\\x{0374}\\x{037E}\\x{0387}\\x{1100}-\\x{11FF}\\x{1F71}-\\x{1FFD}\\x{2000}\\x{2001}\\x{2126}\\x{212A}\\x{212B}\\x{2329}\\x{232A}\\x{F900}-\\x{FAFF}\\x{FB1D}-\\x{FB4E}\\x{2F800}-\\x{2FA1D}]"


@pandas_udf(StringType())
def nfc_udf(text: pd.Series) -> pd.Series:
    return text.map(lambda x: unicodedata.normalize("NFC", x), na_action="ignore")


def not_composed(text: Column) -> Column:
    """False for null; true where composition may change the text."""
    return F.coalesce(text.rlike(_UNCOMPOSED), F.lit(False))


def compose(df: DataFrame, *names: str) -> DataFrame:
    """NFC for the named columns.  Only rows that need it visit Python."""
    needs = F.lit(False)
    for n in names:
        needs = needs | not_composed(F.col(n))
    done = df.filter(needs).withColumns({n: nfc_udf(F.col(n)) for n in names})
    return df.filter(~needs).unionByName(done)


def line_feeds(text: Column) -> Column:
    """Null becomes '', CRLF and CR become LF."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "\\r\\n?", "\n")


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+\\z", "")


def collapsed(text: Column) -> Column:
    """White space runs as one blank, none at the ends."""
    return F.trim(F.regexp_replace(text, f"{SPACE}+", " "))


def source_hash(file: Column, row: Column, english: Column, japanese: Column) -> Column:
    """SHA-256 of the four fields joined by U+001F, null as ''."""
    blank = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    return F.sha2(F.concat_ws("\u001f", blank(file), blank(row), line_feeds(english), line_feeds(japanese)), 256)


def unfenced(text: Column) -> Column:
    """A model response without the code fence around it."""
    return F.regexp_replace(F.regexp_replace(strip(text), f"(?i)^```(?:json)?{SPACE}*", ""), f"{SPACE}*```\\z", "")


def utf16_length(text: Column) -> Column:
    """UTF-16 code units: characters beyond the basic plane count twice."""
    return F.length(text) + F.length(F.regexp_replace(text, "[^\\x{10000}-\\x{10FFFF}]", ""))


def joined_url(base: str, suffix: str) -> str:
    """Joins two parts of a URL with a single slash."""
    return base.rstrip("/") + "/" + suffix.lstrip("/")
