"""Problem 6: evaluation texts inside a training corpus, by latent semantic retrieval.

1. Every text becomes word integers once (a table in the shared folder).
2. Document frequencies of hashed terms over all passages of the corpus and of
   the test items.
3. Distributed randomised SVD of the TF-IDF matrix of passages: each partition
   adds its part of A'(A X) for the test matrix X; two rounds give an orthonormal
   basis and the small Rayleigh-Ritz problem that the driver solves.  This index is
   fitted on all passages of the corpus and of the test items.  What reaches the
   driver is terms x rank, whatever the size of the corpus.
4. Cosine candidate search in that space between windows of ``SEED`` words: at
   every word of the items, at every ``STEP``-th of every document.  The items'
   windows form an inverted file: spherical k-means cells, of which a document's
   window visits those whose centre is near, so only a few item windows are
   compared with it.  A run of RUN >= SEED + STEP - 1 words covers a document
   window that equals one of the item; equal windows have equal vectors and so the
   cosine 1, and every cell is open to windows that equal a member, so runs of RUN
   words are never missed.  Windows with less than SHARED words that stand in any
   item are left out first, as they cannot pass the next step.
5. Candidates must share SHARED words.  From them the longest common run is
   extended word by word.  Around the best candidate of each part of an item, the
   passage of up to PASSAGE words is compared with the document by a longest
   common subsequence and an answer check: of the passage's numbers and rare words,
   ANSWER_PART must stand in the document's.

Items are a stated query set; they are searched in blocks of ``BLOCK`` words, one
scan of the word table a block, and neither the driver nor a task holds more than
one block's windows (``BLOCK`` x RANK x 4 bytes are broadcast).

Defined cases: null and empty texts, and texts or items shorter than RUN words, are
never leaks of either kind; a text or item shorter than PASSAGE is compared whole;
very long texts are searched whole, in overlapping chunks; repeated texts or items
are reported each on its own; an empty table gives no row; only the named columns
are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.llm.words import arrow_slices, list_parts, new_ids, sum_blocks, tokenised, word_ids, words
from loomline.session import written

RUN, SEED, STEP, PASSAGE = 10, 8, 3, 32
TERMS, RANK, SPARE = 1 << 14, 64, 8
#: Least cosine of two windows, and of a window and the centre of a cell to visit.
COS, CELL_COS = 0.78, 0.58
#: Words that two windows share at least; more than half, as LCS_PART asks.
SHARED = 5
#: Least part of the item's passage that a paraphrase keeps in order, and of its
#: numbers and rare words that it keeps at all.
LCS_PART, ANSWER_PART = 0.6, 0.5
BLOCK = 400_000
_CHUNK, _UNITS, _ROWS, _FILTER, _DENSE = 8192, 200_000, 8192, 1 << 20, 4096


def _terms(ids: np.ndarray) -> np.ndarray:
    return (ids & (TERMS - 1)).astype(np.int32)


def _passages(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Terms, counts and passage numbers of the PASSAGE-word cuts of a batch's texts."""
    flat, size = list_parts(batch.column("ids"))
    own = -(-size // PASSAGE)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    row = np.repeat(np.cumsum(own) - own, size) + at // PASSAGE
    pair = np.sort(row * TERMS + _terms(flat))
    cut = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]]) if len(pair) else np.zeros(0, dtype=np.int64)
    pair = pair[cut]
    return (pair & (TERMS - 1)).astype(np.int32), np.diff(np.r_[cut, len(flat)]).astype(np.float32), pair // TERMS


def idf(tokens: DataFrame) -> np.ndarray:
    """Weights of the terms."""

    def make(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        a = np.zeros((TERMS + 1, 1))
        for whole in batches:
            for b in arrow_slices(whole, "ids", _UNITS):
                t, _, row = _passages(b)
                a[:TERMS, 0] += np.bincount(t, minlength=TERMS)
                a[TERMS, 0] += row[-1] + 1 if len(row) else 0
        return a

    a = sum_blocks(tokens.select("ids"), make, TERMS + 1, 1)
    if not a.size:
        return np.ones(TERMS, dtype=np.float32)
    return (np.log((1 + a[TERMS, 0]) / (1 + a[:TERMS, 0])) + 1).astype(np.float32)


def _apply_gram(tokens: DataFrame, weight: np.ndarray, x: np.ndarray) -> np.ndarray:
    """A'(A X) for the TF-IDF rows A of all passages, each of length 1."""
    k, x = x.shape[1], x.astype(np.float32)

    def make(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        out = np.zeros((TERMS, k), dtype=np.float32)
        for whole in batches:
            for b in arrow_slices(whole, "ids", _UNITS):
                t, n, row = _passages(b)
                if not len(t):
                    continue
                v = n * weight[t]
                starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
                size = np.diff(np.r_[starts, len(row)])
                v /= np.repeat(np.sqrt(np.add.reduceat(v * v, starts)), size)
                at, end = np.repeat(np.arange(len(size)), size), starts + size
                # A few passages at a time are a small dense matrix over their own terms.
                part = np.cumsum(np.maximum(size, 16)) // _DENSE
                cuts = np.r_[0, np.flatnonzero(np.diff(part)) + 1, len(size)]
                for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                    lo, hi = int(starts[i]), int(end[j - 1])
                    own, column = np.unique(t[lo:hi], return_inverse=True)
                    a = np.zeros((j - i, len(own)), dtype=np.float32)
                    a[at[lo:hi] - i, column] = v[lo:hi]
                    out[own] += a.T @ (a @ x[own])
        return out

    got = sum_blocks(tokens.select("ids"), make, TERMS, dtype="float32")
    return got if got.size else np.zeros((TERMS, k))


def latent_basis(tokens: DataFrame, weight: np.ndarray, rank: int = RANK, seed: int = 7) -> np.ndarray:
    """TERMS x rank: idf weights times the right singular vectors."""
    x = np.random.default_rng(seed).standard_normal((TERMS, rank + SPARE))
    q, _ = np.linalg.qr(_apply_gram(tokens, weight, x))
    g = _apply_gram(tokens, weight, q)
    values, u = np.linalg.eigh((q.T @ g + g.T @ q) / 2)
    v = q @ u[:, np.argsort(values)[::-1][:rank]]
    return v * weight[:, None]


def rare_weight(item_tokens: DataFrame, weight: np.ndarray, part: float = 0.8) -> float:
    """The weight that this part of the words of all items lies below."""

    def make(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        return sum((np.bincount(_terms(list_parts(b.column("ids"))[0]), minlength=TERMS) for b in batches), np.zeros(TERMS))[:, None]

    n = sum_blocks(item_tokens.select("ids"), make, TERMS, 1)
    if not n.size:
        return 0.0
    order = np.argsort(weight, kind="stable")
    return float(weight[order][np.searchsorted(np.cumsum(n[order, 0]), part * n.sum())])


def _unit(ids: np.ndarray, starts: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Unit latent vectors of the windows at ascending places.  Words are always
    added in the same order, so equal windows have equal vectors."""
    low = int(starts[0])
    x = basis[_terms(ids[low : int(starts[-1]) + SEED])]
    for k in (1, 2):
        x = x[: len(x) - k] + x[k:]
    v = x[starts - low] + x[starts - low + 4]
    v /= np.maximum(np.sqrt(np.einsum("ij,ij->i", v, v)), np.float32(1e-20))[:, None]
    return v


def _join(arrays: list[np.ndarray], separator: int) -> tuple[np.ndarray, np.ndarray]:
    """One array with separators, and the number of the text at every place."""
    flat = np.concatenate([np.r_[a, separator] for a in arrays]) if arrays else np.zeros(0, dtype=np.int64)
    return flat.astype(np.int64), np.repeat(np.arange(len(arrays)), [len(a) + 1 for a in arrays])


def _texts(owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the texts of a joined array."""
    size = np.bincount(owner) if len(owner) else np.zeros(0, dtype=np.int64)
    return np.cumsum(size) - size, size - 1


def _laid(begin: np.ndarray, length: np.ndarray, size: int, step: int) -> np.ndarray:
    """Starts of the windows of each text that has ``size`` words: at every ``step``-th
    word from its own start, and one flush with its end."""
    begin, last = begin[length >= size], length[length >= size] - size
    k = last // step + 1
    at = np.repeat(begin, k) + step * (np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k))
    return np.union1d(at, begin + last) if step > 1 else at


def lcs_length(a: list[int], b: list[int]) -> int:
    """Longest common subsequence, bit-parallel."""
    at: dict[int, int] = {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << i
    row = full = (1 << len(a)) - 1
    for x in b:
        if hit := row & at.get(x, 0):
            row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def _cells(v: np.ndarray, rounds: int = 6) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means: centres, and the cell of each vector."""
    k = max(1, int(1.5 * np.sqrt(len(v))))
    centre = v[np.linspace(0, len(v) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        cell = np.concatenate([(v[a : a + 8192] @ centre.T).argmax(1) for a in range(0, len(v), 8192)])
        total = np.zeros_like(centre)
        np.add.at(total, cell, v)
        norm = np.sqrt((total * total).sum(1, keepdims=True))
        centre = np.where(norm > 0, total / np.maximum(norm, 1e-30), centre).astype(np.float32)
    return centre, np.concatenate([(v[a : a + 8192] @ centre.T).argmax(1) for a in range(0, len(v), 8192)])


class ItemBlock:
    """A block of test items as an inverted file of their windows."""

    def __init__(self, idents: list[int], texts: list[str | None], basis: np.ndarray, weight: np.ndarray, rare: float | None = None):
        ids = new_ids()
        self.idents = np.array(idents, dtype=np.int64)
        arrays = [word_ids(t, ids) for t in texts]
        self.ids, self.owner = _join(arrays, -1)
        self.begin, self.length = _texts(self.owner)
        self.basis = np.ascontiguousarray(basis, dtype=np.float32)
        self.held = np.zeros(_FILTER, dtype=bool)
        self.held[self.ids[self.ids > 0] & (_FILTER - 1)] = True
        starts = _laid(self.begin, self.length, SEED, 1)
        v = _unit(self.ids, starts, self.basis) if len(starts) else np.zeros((0, self.basis.shape[1]), dtype=np.float32)
        _, first, back = np.unique(self._keys(self.ids, starts), return_index=True, return_inverse=True)
        self.vec = v[first]
        if len(first):
            self.centre, cell = _cells(self.vec)
            order = np.argsort(cell, kind="stable")
            self.vec, cell = np.ascontiguousarray(self.vec[order]), cell[order]
            place = np.empty(len(order), dtype=np.int64)
            place[order] = np.arange(len(order))
            self.cut = np.searchsorted(cell, np.arange(len(self.centre) + 1))
            near = np.einsum("ij,ij->i", self.vec, self.centre[cell])
            least = np.full(len(self.centre), 2.0)
            np.minimum.at(least, cell, near)
            self.enter = np.minimum(CELL_COS, least - 1e-3).astype(np.float32)
            # Places of each distinct window in the items.
            by = np.argsort(place[back], kind="stable")
            self.starts, self.many = starts[by], np.bincount(place[back], minlength=len(first))
            self.from_ = np.cumsum(self.many) - self.many
        # Rare words carry the answer: numbers and the terms of the highest idf, of
        # ``rare`` or more (without it, a fifth of this block's words).
        number = {ids[w] for t in texts for w in words(t) if w.isdigit()}
        w = weight[_terms(self.ids)] if len(self.ids) else np.zeros(0)
        if rare is None:
            rare = np.quantile(w, 0.8) if len(w) else 0.0
        self.telling = (w >= rare) | np.isin(self.ids, np.array(sorted(number), dtype=np.int64))

    @staticmethod
    def _keys(ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Hash of the words of each window."""
        h = np.zeros(len(starts), dtype=np.uint64)
        with np.errstate(over="ignore"):
            for k in range(SEED):
                h = h * np.uint64(0x9E3779B97F4A7C15) + ids[starts + k].astype(np.uint64)
        return h

    def candidates(self, ids: np.ndarray, begin: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in the texts, place in the items, cosine) of windows that are near."""
        none = np.zeros(0, dtype=np.int64)
        s = _laid(begin, length, SEED, STEP)
        if not len(s) or not len(self.vec):
            return none, none, none.astype(np.float32)
        known = np.r_[0, np.cumsum(self.held[ids & (_FILTER - 1)], dtype=np.int32)]
        s = s[known[s + SEED] - known[s] >= SHARED]
        p, q, cos = [none], [none], [none.astype(np.float32)]
        for k in range(0, len(s), _ROWS):
            at = s[k : k + _ROWS]
            v = _unit(ids, at, self.basis)
            visit = v @ self.centre.T >= self.enter
            for c in np.flatnonzero(visit.any(0)):
                rows = np.flatnonzero(visit[:, c])
                near = v[rows] @ self.vec[self.cut[c] : self.cut[c + 1]].T
                a, b = np.nonzero(near >= COS)
                if len(a):
                    p.append(at[rows[a]])
                    q.append(b + self.cut[c])
                    cos.append(near[a, b])
        p, u, cos = np.concatenate(p), np.concatenate(q), np.concatenate(cos)
        n = self.many[u]
        q = self.starts[np.repeat(self.from_[u], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        p, cos = np.repeat(p, n), np.repeat(cos, n)
        keep, w = [], np.arange(SEED)
        for k in range(0, len(p), 1 << 16):
            a, b = ids[p[k : k + (1 << 16), None] + w], self.ids[q[k : k + (1 << 16), None] + w]
            hit = a == b[:, :1]
            for j in range(1, SEED):
                hit |= a == b[:, j : j + 1]
            keep.append(hit.sum(1) >= SHARED)
        keep = np.concatenate(keep) if keep else np.zeros(0, dtype=bool)
        return p[keep], q[keep], cos[keep]

    def _extended(self, ids: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Length of the common run around equal windows; separators never match."""
        length = np.full(len(p), SEED)
        for step in (1, -1):
            a, b = (p + SEED, q + SEED) if step == 1 else (p - 1, q - 1)
            live = np.arange(len(p))
            while len(live):
                x, y = a[live], b[live]
                ok = (x >= 0) & (y >= 0) & (x < len(ids)) & (y < len(self.ids))
                live, x, y = live[ok], x[ok], y[ok]
                live = live[ids[x] == self.ids[y]]
                length[live] += 1
                a[live] += step
                b[live] += step
        return length

    def search(self, ids: np.ndarray, owner: np.ndarray, paraphrases: bool = True) -> list[tuple[int, int, int, int]]:
        """(text, item, longest common run or 0, longest common subsequence of a
        passage that passes both checks or 0) of the joined texts."""
        begin, length = _texts(owner)
        p, q, cos = self.candidates(ids, begin, length)
        if not len(p):
            return []
        o, i = owner[p], self.owner[q]
        runs: dict[tuple[int, int], int] = {}
        same = np.ones(len(p), dtype=bool)
        for k in range(SEED):
            same &= ids[p + k] == self.ids[q + k]
        for x, y, n in zip(o[same].tolist(), i[same].tolist(), self._extended(ids, p[same], q[same]).tolist(), strict=True):
            if n > runs.get((x, y), 0):
                runs[x, y] = n
        kept: dict[tuple[int, int], int] = {}
        if paraphrases:
            # The best candidate of each half passage of an item in a text.
            half = (q - self.begin[i]) // (PASSAGE // 2)
            order = np.lexsort((-cos, half, i, o))
            o1, i1, h1 = o[order], i[order], half[order]
            first = np.r_[True, (o1[1:] != o1[:-1]) | (i1[1:] != i1[:-1]) | (h1[1:] != h1[:-1])]
            for k in order[first].tolist():
                n = self._passage(ids, int(begin[o[k]]), int(length[o[k]]), int(p[k]), int(q[k]), int(i[k]))
                if n > kept.get((int(o[k]), int(i[k])), 0):
                    kept[int(o[k]), int(i[k])] = n
        return [(x, y, runs.get((x, y), 0), kept.get((x, y), 0)) for x, y in {**runs, **kept}]

    def _passage(self, ids: np.ndarray, begin: int, length: int, p: int, q: int, item: int) -> int:
        """Common subsequence of the passages around two windows, 0 if a check fails."""
        size = min(PASSAGE, length, int(self.length[item]))
        if size < RUN:
            return 0
        low = int(self.begin[item])
        a = min(max(q + SEED // 2 - size // 2, low), low + int(self.length[item]) - size)
        slack = size // 4
        doc = ids[max(begin, p - (q - a) - slack) : min(begin + length, p + (a + size - q) + slack)].tolist()
        passage = self.ids[a : a + size].tolist()
        have = set(doc)
        told = [x for x, t in zip(passage, self.telling[a : a + size], strict=True) if t]
        if told and sum(x in have for x in told) < ANSWER_PART * len(told):
            return 0
        if sum(x in have for x in passage) < LCS_PART * size:
            return 0
        n = lcs_length(passage, doc)
        return n if n >= LCS_PART * size else 0


def leaks(docs: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, item_text: str, paraphrases: bool = True, basis: np.ndarray | None = None) -> DataFrame:
    """doc, item, run (longest common run of words, 0 if under SEED), lcs (of a
    paraphrased passage, else 0).  ``basis`` replaces the fitted one, for ablations."""
    spark = docs.sparkSession
    kind = "doc bigint, item bigint, run int, lcs int"
    tokens = written(tokenised(docs, doc_id, text, _CHUNK, 2 * PASSAGE), "tokens")
    held = items.select(item_id, item_text).filter(F.col(item_id).isNotNull()).orderBy(item_id)
    item_tokens = written(tokenised(items, item_id, item_text, _CHUNK), "items")
    passages = tokens.select("ids").unionByName(item_tokens.select("ids"))
    weight = idf(passages)
    if basis is None:
        basis = latent_basis(passages, weight)
    rare = rare_weight(item_tokens, weight)
    blocks: list[tuple[list, list]] = [([], [])]
    size = 0
    found = None
    for i, t in held.toLocalIterator():  # the query set, block by block
        k = len(words(t))
        if size and size + k > BLOCK:
            blocks.append(([], []))
            size = 0
        blocks[-1][0].append(i)
        blocks[-1][1].append(t)
        size += k
        if len(blocks) > 1:
            found = _searched(tokens, ItemBlock(*blocks.pop(0), basis, weight, rare), kind, paraphrases, found)
    found = _searched(tokens, ItemBlock(*blocks[0], basis, weight, rare), kind, paraphrases, found)
    return found.groupBy("doc", "item").agg(F.max("run").alias("run"), F.max("lcs").alias("lcs"))


def _searched(tokens: DataFrame, block: ItemBlock, kind: str, paraphrases: bool, before: DataFrame | None) -> DataFrame:
    """The hits of one block, with those of the blocks before."""
    shared = tokens.sparkSession.sparkContext.broadcast(block)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        for whole in batches:
            for b in arrow_slices(whole, "ids", _UNITS):
                flat, size = list_parts(b.column("ids"))
                end = np.cumsum(size)
                ids = np.zeros(len(flat) + len(size), dtype=np.int64)
                ids[np.arange(len(flat)) + np.repeat(np.arange(len(size)), size)] = flat
                hits = block.search(ids, np.repeat(np.arange(len(size)), size + 1), paraphrases) if len(end) else []
                o, i, run, lcs = (np.array(x, dtype=np.int64) for x in zip(*hits, strict=True)) if hits else (np.zeros(0, dtype=np.int64),) * 4
                who = b.column("ident").take(pa.array(o)).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([who, pa.array(block.idents[i]), pa.array(run, pa.int32()), pa.array(lcs, pa.int32())], names=["doc", "item", "run", "lcs"])

    found = tokens.select("ident", "ids").mapInArrow(search, kind)
    # Earlier blocks are written, so the plan holds one scan whatever their number.
    return found if before is None else written(before, "found").unionByName(found)


def exact_leaks(found: DataFrame) -> DataFrame:
    return found.filter(F.col("run") >= RUN)
