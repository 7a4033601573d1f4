"""Protecting tokens and terms with markers, restoring them, repairing aliases."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.functions.tokens import TOKEN_CLASSES, term_pattern

# Code points are written in another way for Python.
_CLASSES = [regex.compile(regex.sub(r"\\x\{([0-9A-F]+)\}", lambda m: chr(int(m[1], 16)), p)) for p in TOKEN_CLASSES.values()]


def mask(text: str, keep: list[str], first: int) -> tuple[str, list[tuple[str, str]]]:
    """Masked text and (marker, value) in the order of replacement: tokens, the
    longest first, then kept terms, the longest first; markers count on from
    ``first``."""
    tokens = sorted({m for p in _CLASSES for m in p.findall(text)}, key=lambda t: (-len(t), t))
    out: list[tuple[str, str]] = []

    def put(m) -> str:
        out.append((f"LOOMKEEP{first + len(out):06d}END", m.group(0)))
        return out[-1][0]

    for t in tokens:
        text = regex.sub(regex.escape(t), put, text)
    for t in sorted((t for t in keep if t in text), key=lambda t: (-len(t), t)):
        text = regex.sub(rf"(?<![\p{{L}}\p{{N}}_]){regex.escape(t)}(?![\p{{L}}\p{{N}}_])", put, text)
    return text, out


def masked(rows: DataFrame, group: str, order: str, text: str, keep: list[str]) -> DataFrame:
    """(order, masked, replacements) with markers numbered through each group, a
    request batch of a few rows.  Null texts count as ''."""

    def run(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values(order)
        n, texts, reps = 0, [], []
        for t in f[text]:
            m, r = mask(t or "", keep, n)
            n += len(r)
            texts.append(m)
            reps.append([{"marker": a, "value": b} for a, b in r])
        return pd.DataFrame({order: f[order], "masked": texts, "replacements": reps})

    kind = rows.schema[order].dataType.simpleString()
    return rows.select(group, order, text).groupBy(group).applyInPandas(run, f"`{order}` {kind}, masked string, replacements array<struct<marker:string,value:string>>")


def restored(text: Column, replacements: Column) -> Column:
    """All markers back, in order; native, so it runs where the text is."""
    return F.aggregate(replacements, text, lambda acc, r: F.replace(acc, r.marker, r.value))


def repaired_aliases(rows: DataFrame, english: str, candidate: str, term: str, aliases: list[str]) -> DataFrame:
    """Adds ``repaired`` and ``repairs``: while the candidate holds the term less
    often than English, known misspellings (patterns, in order) are replaced from
    the left.  Rows without a deficit never leave the JVM's side of the plan."""
    need = F.regexp_count(F.coalesce(F.col(english), F.lit("")), F.lit(term_pattern(term, True))) - F.regexp_count(F.coalesce(F.col(candidate), F.lit("")), F.lit(term_pattern(term, True)))
    rows = rows.withColumn("__need", need)
    none = F.array().cast("array<string>")
    fine = rows.filter("__need <= 0").withColumns({"repaired": F.coalesce(F.col(candidate), F.lit("")), "repairs": none})
    kind = rows.withColumns({"repaired": F.lit(""), "repairs": none}).schema

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            texts, notes = [], []
            for t, n in zip(f[candidate], f["__need"], strict=True):
                t, said = t or "", []
                for p in aliases:
                    found: list[str] = []
                    left = n - len(said)
                    if left <= 0:
                        break
                    t = regex.sub(p, lambda m, found=found: found.append(m.group(0)) or term, t, count=int(left), flags=regex.I)
                    said += [f"CANONICALIZED_PROTECTED_ALIAS:{x}->{term}" for x in found]
                texts.append(t)
                notes.append(said)
            yield f.assign(repaired=texts, repairs=notes)

    short = rows.filter("__need > 0").mapInPandas(run, kind)
    return fine.unionByName(short).drop("__need")
