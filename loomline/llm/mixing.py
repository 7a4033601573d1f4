"""Problem 7: mixing sources to target weights, with soft membership.

1. Sizes: tokens of a public tokenizer, whole texts, in Arrow batches.
2. A linear classifier on hashed words is trained on a bounded sample of the
   labelled table (documents with a source of the target list) and predicts the
   domain posterior of every document.  Its membership is ``TRUST`` parts the
   label and the rest the posterior, as some texts stand under another source's
   name; a document without label has the posterior.
3. Nonnegative rates by distributed projected-gradient least squares: a document's
   rate is the product of its membership with one number a source, projected on
   [0, max_repeats], and these numbers are moved against the gradient of the squared
   distance between expected and wanted totals, scaled by the Gauss-Newton matrix
   and projected on their own bounds.  A round needs the sums of rate x tokens x
   membership over all documents and that matrix: k + k x k numbers a task for k
   sources.  Rates follow from k numbers, so they are never stored or sent.  Rounds
   end when all totals are met within TOLERANCE or the distance falls no further.
4. Whole copies: a document is taken floor(rate) or floor(rate) + 1 times, the
   expectation being its rate.  Within a batch the documents of a source are rounded
   systematically, in order of their size from a hashed offset, so the batch's sum is
   kept to one copy.  No source's total is corrected afterwards.

The total is the greatest at which every source that has documents can reach its
target, less HEADROOM; with ``total`` given (a number, or "corpus" for the tokens of
all documents with a source of the list), sources that cannot reach theirs stop at
their cap and the report says so.  The report has the expected shares of the fit
beside the real ones.

Defined cases: documents without tokens (null or empty text) are not selected;
documents of a source that has no target are not selected either; those with a
null source take part by their posterior and count for no source; a target
source without documents gets nothing and is reported as not reached, while the
others keep their proportions; target rows with a null source are ignored, a null
share counts 0, a null max_repeats 1; shares are scaled to the sum 1; repeated
texts are separate documents; empty tables give an empty mix.
"""

from __future__ import annotations

import ast
import base64
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.llm.words import slices, words
from loomline.session import ship, spread, written

TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Labelled documents that the classifier is trained on, at most.
SAMPLE, DIM, EPOCHS = 4000, 1 << 13, 6
TRUST, ROUNDS, TOLERANCE, HEADROOM = 0.97, 40, 5e-4, 0.02
_CHUNK, _CUT = 20_000, re.compile(r"[^\W_](?= [^\W_])")
_ENCODERS: dict = {}
_SENT: set = set()


def pattern_of(path: str) -> str:
    """The pattern that splits texts, which stands as a constant beside the vocabulary."""
    with open(os.path.join(os.path.dirname(path), "__init__.py"), encoding="utf-8") as f:
        for node in ast.parse(f.read()).body:
            if isinstance(node, ast.Assign) and getattr(node.targets[0], "id", "") == "PATTERN":
                return ast.literal_eval(node.value)
    raise ValueError(f"no pattern beside {path}")


def encoder(path: str, pattern: str | None = None):
    """One encoder a worker process."""
    if path not in _ENCODERS:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODERS[path] = tiktoken.Encoding("public", pat_str=pattern or pattern_of(path), mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[path]


def shipped(spark: SparkSession, path: str):
    """A function for the workers that gives the encoder; they get its file."""
    ship(spark)
    pattern, name, key = pattern_of(path), os.path.basename(path), (spark.sparkContext.applicationId, path)
    if key not in _SENT:
        _SENT.add(key)
        spark.sparkContext.addFile(path)
    return lambda: encoder(SparkFiles.get(name), pattern)


def count_tokens(text: str | None, e=None) -> int:
    """Tokens of a whole text.  A very long one is encoded in parts that end between a
    letter or digit and a single blank before another: there the pattern always ends
    a word, and a word's merges don't look beyond it, so the sum is exact."""
    if not text:
        return 0
    e, n = e or encoder(TOKENIZER), 0
    while len(text) > _CHUNK and (m := _CUT.search(text, _CHUNK)):
        n += len(e.encode_ordinary(text[: m.end()]))
        text = text[m.end() :]
    return n + len(e.encode_ordinary(text))


def _hashed(text: str | None) -> np.ndarray:
    return np.unique([xxhash.xxh32_intdigest(w.encode()) % DIM for w in words(text)] or [0])


def train(texts: list[str], labels: np.ndarray, k: int, seed: int = 1) -> np.ndarray:
    """Softmax regression on hashed words; (DIM + 1) x k, the last row the bias."""
    w = np.zeros((DIM + 1, k))
    if not len(texts):
        return w
    rows = [np.r_[_hashed(t), DIM] for t in texts]
    rng = np.random.default_rng(seed)
    speed = np.full_like(w, 1e-6)
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for a in range(0, len(order), 256):
            part = order[a : a + 256]
            flat, size = np.concatenate([rows[i] for i in part]), np.array([len(rows[i]) for i in part])
            s = np.add.reduceat(w[flat], np.r_[0, np.cumsum(size)[:-1]], axis=0) / np.sqrt(size)[:, None]
            p = np.exp(s - s.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(part)), labels[part]] -= 1
            g = np.zeros_like(w)
            np.add.at(g, flat, np.repeat(p / np.sqrt(size)[:, None] / len(part), size, axis=0))
            speed += g * g
            w -= 0.3 * g / np.sqrt(speed)
    return w


def posterior(texts, w: np.ndarray) -> np.ndarray:
    out = np.empty((len(texts), w.shape[1]))
    for i, t in enumerate(texts):
        h = np.r_[_hashed(t), DIM]
        s = w[h].sum(0) / np.sqrt(len(h))
        p = np.exp(s - s.max())
        out[i] = p / p.sum()
    return out


def rates(member: np.ndarray, cap: np.ndarray, level: np.ndarray) -> np.ndarray:
    """Rates at the sources' levels."""
    return np.clip(member @ level, 0, cap)


class Mix:
    """A fitted mix: ``selection`` (ident, source, tokens, copies) and ``report``."""

    def __init__(self, docs: DataFrame, ident: str, text: str, source: str, targets: list[tuple[str, float, int]], total: float | str | None = None, tokenizer: str = TOKENIZER, trust: float = TRUST):
        spark = docs.sparkSession
        self.ident, self.source = ident, source
        merged: dict[str, tuple[float, int]] = {}
        for s, share, most in targets:
            if s is not None:
                merged[s] = (share or 0.0, 1 if most is None else most)
        self.names = names = sorted(merged)
        k = len(names)
        share = np.array([merged[s][0] for s in names])
        self.share = share = share / share.sum() if share.sum() > 0 else share
        self.most = np.array([merged[s][1] for s in names], dtype=float)
        at = {s: i for i, s in enumerate(names)}
        kind = docs.schema[ident].dataType.simpleString()
        self.kind = f"ident {kind}, s int, tokens bigint"
        base = docs.select(F.col(ident).alias("ident"), F.col(text).alias("text"), F.col(source).alias("source")).filter(F.col("source").isNull() | F.col("source").isin(names))
        # The lowest hashes; the bound lets only about three times the sample be sorted.
        h = F.pmod(F.xxhash64("ident"), F.lit(1 << 40))
        bound = int((1 << 40) * min(1.0, 3 * SAMPLE / max(docs.count(), 1)))
        labelled = base.filter(F.col("source").isNotNull() & F.col("text").isNotNull() & (h < bound)).orderBy(h, "ident").limit(SAMPLE).select("text", "source").collect()
        weights = spark.sparkContext.broadcast(train([r.text for r in labelled], np.array([at[r.source] for r in labelled], dtype=int), max(k, 1)))
        coder = shipped(spark, tokenizer)

        def member(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for f in slices(frames, "text", 2_000_000):
                e = coder()
                tokens = np.array([count_tokens(t, e) for t in f["text"]], dtype=np.int64)
                s = np.array([at.get(x, -1) for x in f["source"]], dtype=np.int32)
                p = posterior(list(f["text"]), weights.value)
                has = s >= 0
                p[has] *= 1 - trust
                p[np.flatnonzero(has), s[has]] += trust
                out = pd.DataFrame({"ident": f["ident"], "s": s, "tokens": tokens, "p": list(p.astype(np.float32))})
                yield out[tokens > 0]

        self.members = written(spread(base).mapInPandas(member, self.kind + ", p array<float>"), "members")
        self.have = np.zeros(k)
        for r in self.members.filter("s >= 0").groupBy("s").agg(F.sum("tokens").alias("n")).collect():
            self.have[r.s] = r.n
        self.able = (self.have > 0) & (share > 0)
        # Levels at which every document of a source has its greatest rate.
        self.full = self.most / trust
        self.level, self.expected, self.converged, self.history = np.zeros(k), np.zeros(k), True, []
        if total == "corpus":
            total = float(self.have.sum())
        if total is None:
            room = self._sums(np.where(self.able, self.full, 0))[0]
            real = self.have * self.most
            total = float((np.minimum(room, real)[self.able] / share[self.able]).min()) * (1 - HEADROOM) if self.able.any() else 0.0
        self.goal = total * share
        self._fit()
        self._chosen: DataFrame | None = None

    def _fit(self) -> None:
        """Moves the levels until the expected totals are the wanted ones, or as near
        as the bounds allow; ``converged`` tells which of both it was not."""
        if not self.able.any() or self.goal.sum() <= 0:
            return
        able, goal = self.able, np.where(self.able, self.goal, 0)
        level = np.where(able, np.minimum(goal / np.where(able, self.have, 1), self.full), 0)
        step, best = 1.0, None
        self.converged = False
        for _ in range(ROUNDS):
            sums, matrix = self._sums(level)
            off = np.where(able, sums - goal, 0)
            self.history.append(float(np.abs(off).max() / goal.sum()))
            now = float((off * off).sum())
            if best is not None and now > best[0] * (1 + 1e-9):
                # Too far: half the way from the best levels.
                step /= 2
                level = best[1] + step * best[4]
                level = np.clip(level, 0, np.where(able, self.full, 0))
                if step < 1 / 64:
                    self.converged = True
                    break
                continue
            gain = np.inf if best is None else 1 - now / max(best[0], 1e-30)
            # At a bound and pushed against it: nothing to move.
            held = ~able | ((level >= self.full) & (off < 0)) | ((level <= 0) & (off > 0))
            move = np.zeros(len(level))
            free = np.flatnonzero(~held)
            if len(free):
                m = matrix[np.ix_(free, free)]
                move[free] = -np.linalg.solve(m + np.eye(len(free)) * 1e-6 * max(np.trace(m), 1e-9), off[free])
            best, step = (now, level, sums, off, move), 1.0
            if np.abs(off).max() <= TOLERANCE * goal.sum() or not len(free) or gain < 1e-6:
                self.converged = True
                break
            level = np.clip(level + move, 0, np.where(able, self.full, 0))
        self.level, self.expected = best[1], best[2]

    def _sums(self, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Expected tokens of every source at the given levels, and how they change
        with them; k + k x k numbers a task."""
        k, most = len(self.names), self.most

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros((k, k + 1))
            for f in frames:
                if len(f):
                    p, cap = _member(f, most)
                    raw, t = p @ level, f["tokens"].to_numpy(float)
                    total[:, 0] += (np.clip(raw, 0, cap) * t) @ p
                    free = (raw < cap) * t
                    total[:, 1:] += (p * free[:, None]).T @ p
            yield pd.DataFrame({"i": np.arange(k * (k + 1), dtype=np.int32), "v": total.ravel()})

        out = np.zeros(k * (k + 1))
        for r in self.members.select("s", "tokens", "p").mapInPandas(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():
            out[r.i] = r.v
        out = out.reshape(k, k + 1)
        return out[:, 0], out[:, 1:]

    def selection(self) -> DataFrame:
        """Written once, so the mix and its report are of the same copies."""
        if self._chosen is None:
            most, level, k = self.most, self.level, len(self.names)

            def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
                part = TaskContext.get().partitionId()
                for n, f in enumerate(frames):
                    if len(f):
                        p, cap = _member(f, most)
                        f = f.assign(copies=rounded(rates(p, cap, level), f["s"].to_numpy(), f["tokens"].to_numpy(), np.random.default_rng([part, n, 17])).astype(np.int32))
                        yield f.loc[f["copies"] > 0, ["ident", "s", "tokens", "copies"]]

            self._chosen = written(self.members.mapInPandas(run, self.kind + ", copies int") if k else self.members.select("ident", "s", "tokens", F.lit(0).alias("copies")).limit(0), "chosen")
        names = F.array(*[F.lit(s) for s in self.names]) if self.names else F.array(F.lit(None).cast("string"))
        return self._chosen.select(F.col("ident").alias(self.ident), F.when(F.col("s") >= 0, F.get(names, F.col("s"))).alias(self.source), "tokens", "copies")

    def report(self) -> DataFrame:
        """Per target source: what was wanted, what there is, what the fit expects by
        its memberships and what came out."""
        spark = self.members.sparkSession
        used = self.selection().groupBy(self.source).agg(F.count(F.lit(1)).alias("documents"), F.sum("copies").alias("uses"), F.sum(F.col("tokens") * F.col("copies")).alias("mixed_tokens"))
        used = written(used, "used")
        total = F.lit(used.agg(F.sum("mixed_tokens")).first()[0] or 0)
        whole = max(self.expected.sum(), 1e-9)
        rows = [(n, float(s), int(m), int(h), float(e / whole)) for n, s, m, h, e in zip(self.names, self.share, self.most, self.have, self.expected, strict=True)]
        wanted = F.broadcast(spark.createDataFrame(rows, f"`{self.source}` string, target_share double, max_repeats int, available_tokens bigint, expected_share double"))
        out = used.join(wanted, self.source, "right")
        zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
        actual = F.coalesce(F.try_divide("mixed_tokens", total), F.lit(0.0))
        return out.select(self.source, "target_share", actual.alias("actual_share"), "expected_share", "max_repeats", "available_tokens", zero("documents"), zero("uses"), zero("mixed_tokens"), (F.abs(actual - F.col("target_share")) <= 0.005).alias("reached"))


def _member(f: pd.DataFrame, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Memberships and greatest rates."""
    p, s = np.stack([np.asarray(x) for x in f["p"]]).astype(float), f["s"].to_numpy()
    return p, most[np.where(s >= 0, s, p.argmax(1))]


def rounded(rate: np.ndarray, group: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Whole copies with the given expectations; every group's sum is kept to one."""
    order = np.lexsort((size, group))
    g = group[order]
    out = np.zeros(len(rate))
    cut = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
    for a, b in zip(cut, [*cut[1:], len(g)], strict=True):
        run = np.floor(np.cumsum(rate[order[a:b]]) + rng.random() + 1e-9)
        out[order[a:b]] = np.diff(np.r_[0, run])
    return np.minimum(out, np.ceil(rate))
