"""Words of a text as 64-bit integers, for operators that work on runs of words."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.session import ship, spread

_WORD = regex.compile(r"[\p{L}\p{N}]+")
#: Words kept in a worker's table before it is emptied.
_TABLE = 500_000
#: Arrays that one task of ``sum_blocks`` adds up.
FAN_IN = 64


class _Ids(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= _TABLE:
            self.clear()
        # Never 0 or -1: those separate texts in joined arrays.
        n = xxhash.xxh3_64_intdigest(word.encode()) >> 1
        self[word] = n = max(n, 1)
        return n


def words(text: str | None) -> list[str]:
    """Maximal runs of letters and digits of the composed text in lower case."""
    return _WORD.findall(unicodedata.normalize("NFC", text).lower()) if text else []


def word_ids(text: str | None, ids: dict[str, int]) -> np.ndarray:
    return np.array([ids[w] for w in words(text)], dtype=np.int64)


def new_ids() -> dict[str, int]:
    return _Ids()


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts one after another, and how many each text has; as
    ``words``, mostly in Arrow's compiled kernels.  Null counts as ''."""
    t = pa.array([unicodedata.normalize("NFC", t).lower() if t else "" for t in texts.to_pylist()], pa.large_string())
    t = pc.utf8_trim(pc.replace_substring_regex(t, pattern=r"[^\p{L}\p{N}]+", replacement=" "), characters=" ")
    parts = pc.split_pattern(t, pattern=" ")
    size = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.list_flatten(parts)
    none = pc.equal(t, "").to_numpy(zero_copy_only=False)
    if none.any():
        size[none] = 0
        flat = flat.filter(pc.not_equal(flat, ""))
    return flat, size


def flat_ids(texts: pa.Array, ids: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Integers of the words of all texts, and how many each text has."""
    flat, size = split_words(texts)
    coded = flat.combine_chunks() if isinstance(flat, pa.ChunkedArray) else flat
    coded = coded.dictionary_encode()
    known = np.array([ids[w] for w in coded.dictionary.to_pylist()], dtype=np.int64)
    return (known[coded.indices.to_numpy(zero_copy_only=False)] if len(known) else np.zeros(0, dtype=np.int64)), size


def tokenised(docs: DataFrame, ident: str, text: str, chunk: int = 8192, overlap: int = 0) -> DataFrame:
    """(ident, base, ids): a text's words in chunks of at most ``chunk`` words that
    share ``overlap`` words with the next, so a very long text is several rows.
    Texts without words, null and '' give no row."""
    ship(docs.sparkSession)
    kind = docs.schema[ident].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = new_ids()
        for b in batches:
            for part in arrow_slices(b, "text"):
                flat, size = flat_ids(part.column("text"), ids)
                # The first row of each text and the rows that follow it.
                more = np.where(size > chunk, -(-np.maximum(size - chunk, 0) // (chunk - overlap)), 0)
                rows = np.where(size > 0, 1 + more, 0)
                who = np.repeat(np.arange(len(size)), rows)
                nth = np.arange(rows.sum()) - np.repeat(np.cumsum(rows) - rows, rows)
                base = nth * (chunk - overlap)
                start = (np.cumsum(size) - size)[who] + base
                n = np.minimum(chunk, size[who] - base)
                if more.any():
                    flat = np.concatenate([flat[a : a + k] for a, k in zip(start, n, strict=True)])
                offsets = pa.array(np.r_[0, np.cumsum(n)].astype(np.int32))
                yield pa.RecordBatch.from_arrays([part.column("ident").take(pa.array(who)), pa.array(base), pa.ListArray.from_arrays(offsets, pa.array(flat))], names=["ident", "base", "ids"])

    held = docs.select(F.col(ident).alias("ident"), F.col(text).alias("text")).filter("ident is not null")
    return spread(held).mapInArrow(run, f"ident {kind}, base bigint, ids array<bigint>")


def arrow_slices(batch: pa.RecordBatch, column: str, units: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in parts of about ``units`` bytes or elements of a column."""
    c = batch.column(column)
    size = pc.fill_null(pc.binary_length(c) if pa.types.is_string(c.type) or pa.types.is_large_string(c.type) else pc.list_value_length(c), 0)
    part = np.cumsum(size.to_numpy(zero_copy_only=False).astype(np.int64)) // units
    cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]).tolist() if len(part) else []
    for a, b in zip(cuts, [*cuts[1:], len(part)], strict=True):
        yield batch.slice(a, b - a)


def list_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and lengths of a list column without nulls."""
    size = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False), size


def slices(frames: Iterator[pd.DataFrame], column: str, units: int = 100_000) -> Iterator[pd.DataFrame]:
    """The rows of Arrow batches in parts of about ``units`` array elements or
    characters, so a worker's memory doesn't depend on the batch size."""
    for f in frames:
        size = f[column].map(lambda x: 0 if x is None else len(x)).to_numpy(dtype=np.int64)
        part = np.cumsum(size) // units
        cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(f) else []
        for a, b in zip(cuts, [*cuts[1:], len(f)], strict=True):
            yield f.iloc[a:b]


def sum_blocks(df: DataFrame, make, width: int, blocks: int = 8, dtype: str = "float64") -> np.ndarray:
    """Sum over all partitions of an array of ``width`` rows.

    ``make(batches)`` gives a partition's array (width x k) of numbers of ``dtype``.  Partitions send it
    in row blocks, which are added up in levels of at most FAN_IN arrays a task,
    so neither a task nor the driver holds more, whatever the number of partitions.
    """
    step = -(-width // blocks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = make(batches)
        if a is not None and a.any():
            rows = [(b, np.ascontiguousarray(a[b * step : (b + 1) * step])) for b in range(blocks)]
            rows = [(b, p) for b, p in rows if p.size]
            at = TaskContext.get().partitionId()
            columns = [pa.array([b for b, _ in rows], pa.int32()), pa.array([at] * len(rows), pa.int32()), pa.array([list(p.shape) for _, p in rows], pa.list_(pa.int32())), pa.array([p.tobytes() for _, p in rows], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["b", "g", "shape", "v"])

    def add(f: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(v, dtype=dtype).astype(np.float64) for v in f["v"]).astype(dtype)
        return pd.DataFrame({"b": f["b"].iloc[:1], "g": f["g"].iloc[:1] // FAN_IN, "shape": f["shape"].iloc[:1], "v": [total.tobytes()]})

    kind = "b int, g int, shape array<int>, v binary"
    sums, parts = df.mapInArrow(run, kind), df.rdd.getNumPartitions()
    while True:
        sums = sums.groupBy("b", F.floor(F.col("g") / FAN_IN).alias("h")).applyInPandas(add, kind)
        parts = -(-parts // FAN_IN)
        if parts <= 1:
            break
    got = {r.b: np.frombuffer(bytes(r.v), dtype=dtype).reshape(r.shape) for r in sums.collect()}
    if not got:
        return np.zeros((width, 0))
    return np.concatenate([got[b] for b in sorted(got)])
