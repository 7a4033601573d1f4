"""Problem 8: subject areas of documents, by latent Dirichlet allocation.

1. Texts are cut into sentences and passages and written once as arrays of hashed
   terms: words, pairs of neighbouring words, and runs and pairs of ideographs or
   katakana.
2. The vocabulary follows from the document frequencies over all passages: terms
   of at least LEAST_SHARE of them (so at most a passage's terms / LEAST_SHARE), and
   of at most MOST_SHARE of the passages of the language that uses them most.  More
   frequent terms stay if most of their labelled passages have one subject, so a
   frequent subject keeps its core terms.
3. TOPICS topics are started without any labels, from clusters of all passages, and
   get START rounds over all of them.  The clusters are spherical k-means on random
   projections: places for centres are drawn from all passages in DRAWS rounds, by
   their distance from those drawn before, and weighed by the passages around them
   (k-means||); then rounds over all passages move the centres.
4. Topics are inspected: a topic gets the subject of most of the labelled passages
   that hold ``HITS`` of its TOP terms, or none.  Topics of one subject, in whatever
   language, become one; the others are grouped to BACKGROUND topics.
5. The merged model is fitted to all passages: partitions run the variational E-step
   and send expected counts, which are added up in levels.  ROUNDS rounds, no term
   is fixed to a topic.  Then topics are inspected again, by their new top terms.
6. A sentence is about a subject if the topics of that subject hold the most, and at
   least PART, of its topic proportions in this passage.  A document has a subject
   if ``SENTENCES`` of at most ``SPAN`` consecutive sentences are about it, which a
   passing mention does not reach.

Defined cases: null and empty texts have no subject; labels of any case count for
the subject of that name, null and unknown labels count as none of the list;
repeated labels count once; labels only name topics, so wrong ones don't decide a
document; without labels, or where a subject has no labelled passages of its own,
nothing is assigned; very long texts are read whole, passage by passage; repeated
texts are judged each; without a language column all texts count as one language;
only the named columns are read.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.llm.words import arrow_slices, list_parts, sum_blocks
from loomline.session import ship, spread, written

#: Topics at the start, groups of those without a subject, rounds with the topics of the
#: start and with the merged ones, inner steps, Dirichlet priors.
TOPICS, BACKGROUND, START, ROUNDS, INNER, ALPHA, ETA = 192, 48, 4, 2, 3, 0.1, 0.01
#: Rounds that draw places for centres, rounds of k-means, width of the projections.
DRAWS, MOVES, WIDTH = 3, 10, 64
#: Shares of passages between which terms are taken, and the part of its labelled
#: passages that a more frequent one needs in one subject.
LEAST_SHARE, MOST_SHARE, FAVOURED = 3e-4, 0.05, 0.8
#: Inspection: top terms of a topic, how many a passage must hold, the part of such
#: passages that must have the subject, and how far that part must lie above the
#: subject's part of all labelled passages, on the way to 1.
TOP, HITS, NAMED, LIFT = 25, 3, 0.5, 0.4
SENTENCES, SPAN, PART = 3, 8, 0.3

_TOKENS = re.compile(r"[^\W\d_]+|[.!?。！？…]|[\r\n]+")
_IDEO = re.compile(r"[㐀-䶿一-鿿々]+|[゠-ヿ]+")
_KANA = re.compile(r"[぀-ゟ]")
_STOP, _LINE, _WORD, _RUNS = 0, 1, 2, 3
_UNITS, _PART, _CHUNK, _JOINED = 200_000, 1 << 15, 4096, 16


def _hash(term: str) -> int:
    return xxhash.xxh32_intdigest(term.encode())


def _kinds(tokens: list[str]) -> tuple[np.ndarray, list[list[int]]]:
    """Kind of each distinct token, and its hashed terms."""
    kind, terms = np.full(len(tokens), _WORD), []
    for i, w in enumerate(tokens):
        if w[0] in ".!?。！？…":
            kind[i] = _STOP
            terms.append([])
        elif w[0] in "\r\n":
            kind[i] = _LINE
            terms.append([])
        elif (runs := _IDEO.findall(w)) or _KANA.search(w):
            kind[i] = _RUNS
            terms.append([_hash(x) for r in runs for x in [r, *(r[k : k + 2] for k in range(len(r) - 1) if len(r) > 2)]])
        else:
            terms.append([_hash(w)])
    return kind, terms


def coded_texts(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, passage and sentence (both numbered within the text) and hash of every
    term of all texts, in order.

    A passage ends at a line break once it has three sentences, so texts with a
    sentence a line have passages too.
    """
    found = [_TOKENS.findall(unicodedata.normalize("NFC", t).lower()) if t else [] for t in texts]
    size = np.array([len(x) for x in found], dtype=np.int64)
    coded = pa.array([w for x in found for w in x], pa.string()).dictionary_encode()
    at = coded.indices.to_numpy(zero_copy_only=False)
    if not len(at):
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none
    kind, terms = _kinds(coded.dictionary.to_pylist())
    many = np.array([len(x) for x in terms])
    pool, first = np.array([h for x in terms for h in x], dtype=np.int64), np.cumsum(many) - many
    owner, k = np.repeat(np.arange(len(texts)), size), kind[at]
    word = k >= _WORD
    # Sentences are the stretches between stops and line breaks that hold a word.
    cut = np.cumsum(~word) + owner
    place = np.flatnonzero(word)
    if not len(place):
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none
    new = np.r_[True, (cut[place][1:] != cut[place][:-1]) | (owner[place][1:] != owner[place][:-1])]
    sentence = np.cumsum(new) - 1
    heads = place[new]
    text = owner[heads]
    start = np.r_[True, text[1:] != text[:-1]]
    number = np.arange(len(heads)) - np.flatnonzero(start)[np.cumsum(start) - 1]
    # Line breaks before each sentence, counted over all texts.
    line = np.cumsum(k == _LINE)[heads]
    passage, last, now, held = np.zeros(len(heads), dtype=np.int64), -1, 0, 0
    for i, (s, t, n) in enumerate(zip(start.tolist(), text.tolist(), line.tolist(), strict=True)):
        if s:
            now = held = 0
        elif held >= 3 and n != last:
            now, held = now + 1, 0
        passage[i], last, held = now, n, held + 1
    w = at[place]
    n = many[w]
    out = [np.repeat(place, n), np.repeat(sentence, n), pool[np.repeat(first[w], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]]
    # Pairs of words that follow each other in a sentence.
    plain = kind[w] == _WORD
    both = np.flatnonzero(plain[1:] & plain[:-1] & (sentence[1:] == sentence[:-1]))
    if len(both):
        a, b = pool[first[w[both]]], pool[first[w[both + 1]]]
        pair = (a * 0x9E3779B1 + b * 0x85EBCA77 + 0x165667B1) & 0xFFFFFFFF
        out = [np.r_[out[0], place[both + 1]], np.r_[out[1], sentence[both]], np.r_[out[2], pair]]
        by = np.argsort(out[0], kind="stable")
        out = [x[by] for x in out]
    s = out[1]
    return text[s], passage[s], number[s], out[2]


def _lists(values: np.ndarray, cuts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.r_[cuts, len(values)].astype(np.int32)), pa.array(values, kind))


def coded(docs: DataFrame, ident: str, text: str, lang: str | None) -> DataFrame:
    """ident, lang, passage, at (sentence number in the text), term; one row a passage."""
    ship(docs.sparkSession)
    kind = docs.schema[ident].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in arrow_slices(whole, "text", 2_000_000):
                who, passage, at, term = coded_texts(b.column("text").to_pylist())
                new = np.flatnonzero(np.r_[True, (who[1:] != who[:-1]) | (passage[1:] != passage[:-1])]) if len(who) else np.zeros(0, dtype=np.int64)
                row = pa.array(who[new])
                columns = [b.column("ident").take(row), b.column("lang").take(row), pa.array(passage[new], pa.int32()), _lists(at, new, pa.int32()), _lists(term, new, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["ident", "lang", "passage", "at", "term"])

    language = F.coalesce(F.col(lang).cast("string"), F.lit("")) if lang else F.lit("")
    held = docs.filter(F.col(ident).isNotNull()).select(F.col(ident).alias("ident"), F.col(text).alias("text"), language.alias("lang"))
    return spread(held).mapInArrow(run, f"ident {kind}, lang string, passage int, at array<int>, term array<bigint>")


def _distinct(flat: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Row and value of the distinct values of each row, as row << 32 | value."""
    key = np.sort((np.repeat(np.arange(len(size)), size) << 32) | flat)
    return key[np.r_[True, key[1:] != key[:-1]]] if len(key) else key


def frequencies(words: DataFrame) -> DataFrame:
    """lang, term, n: passages of a language that hold a term; term -1 counts all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            lang = whole.column("lang").dictionary_encode()
            names, of = lang.dictionary, lang.indices.to_numpy(zero_copy_only=False)
            flat, size = list_parts(whole.column("term"))
            for k in range(len(names)):
                mine = of == k
                pairs = _distinct(flat[np.repeat(mine, size)], size[mine])
                term, n = np.unique(pairs & 0xFFFFFFFF, return_counts=True)
                yield pa.RecordBatch.from_arrays([names.take(pa.array(np.full(len(term) + 1, k))), pa.array(np.r_[-1, term]), pa.array(np.r_[mine.sum(), n])], names=["lang", "term", "n"])

    return words.select("lang", "term").mapInArrow(run, "lang string, term bigint, n bigint").groupBy("lang", "term").agg(F.sum("n").alias("n"))


def vocabulary(words: DataFrame, labelled: DataFrame, subjects: int) -> np.ndarray:
    """The hashes of the terms, ascending."""
    counts = written(frequencies(words), "frequencies")
    total = counts.filter("term = -1").agg(F.sum("n")).first()[0] or 0
    sizes = counts.filter("term = -1").select("lang", F.col("n").alias("all"))
    per = counts.filter("term != -1").join(F.broadcast(sizes) if sizes.count() <= 10_000 else sizes, "lang")
    per = per.groupBy("term").agg(F.sum("n").alias("n"), F.max_by(F.col("n") / F.col("all"), "n").alias("share"))
    # Two passages at least: one relates a term to nothing.
    rows = per.filter(F.col("n") >= max(LEAST_SHARE * total, 2)).select("term", (F.col("share") > MOST_SHARE).alias("often")).toPandas()
    seldom, often = np.sort(rows["term"][~rows["often"]].to_numpy(np.int64)), np.sort(rows["term"][rows["often"]].to_numpy(np.int64))
    if len(often):
        n = label_counts(labelled, often, subjects)
        often = often[n[:, 1:].max(1, initial=0) > FAVOURED * np.maximum(n[:, 0], 1)]
    return np.union1d(seldom, often)


def label_counts(labelled: DataFrame, terms: np.ndarray, subjects: int) -> np.ndarray:
    """terms x (1 + subjects): labelled passages with a term, all and by subject."""

    def make(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        out = np.zeros((len(terms), 1 + subjects))
        for whole in batches:
            flat, size = list_parts(whole.column("term"))
            mask = whole.column("mask").to_numpy()
            pairs = _distinct(flat, size)
            at = np.searchsorted(terms, pairs & 0xFFFFFFFF)
            ok = terms[np.minimum(at, len(terms) - 1)] == (pairs & 0xFFFFFFFF)
            at, m = at[ok], mask[pairs[ok] >> 32]
            out[:, 0] += np.bincount(at, minlength=len(terms))
            for s in range(subjects):
                out[:, 1 + s] += np.bincount(at[(m >> s) & 1 == 1], minlength=len(terms))
        return out

    got = sum_blocks(labelled.select("mask", "term"), make, len(terms), 1)
    return got if got.size else np.zeros((len(terms), 1 + subjects))


def labels_of(labels: DataFrame, ident: str, label: str, subjects: list[str]) -> DataFrame:
    """ident, mask: one row per labelled document, a bit for each of its subjects."""
    name = F.lower(F.trim(F.col(label)))
    bit = F.coalesce(*[F.when(name == s.lower(), F.lit(1 << k)) for k, s in enumerate(subjects)], F.lit(0)).cast("bigint")
    return labels.filter(F.col(ident).isNotNull()).groupBy(F.col(ident).alias("ident")).agg(F.bit_or(bit).alias("mask"))


def encoded(words: DataFrame, terms: np.ndarray, kind: str) -> DataFrame:
    """The passages' known terms as numbers."""
    shared = words.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = shared.value
        for b in batches:
            flat, size = list_parts(b.column("term"))
            at, _ = list_parts(b.column("at"))
            i = np.minimum(np.searchsorted(terms, flat), len(terms) - 1)
            ok = terms[i] == flat
            n = np.bincount(np.repeat(np.arange(len(size)), size)[ok], minlength=len(size))
            row = np.flatnonzero(n)
            cuts = (np.cumsum(n) - n)[row]
            who = pa.array(row)
            yield pa.RecordBatch.from_arrays([b.column("ident").take(who), b.column("mask").take(who), _lists(at[ok], cuts, pa.int32()), _lists(i[ok], cuts, pa.int32())], names=["ident", "mask", "at", "term"])

    return words.select("ident", "mask", "at", "term").mapInArrow(run, f"ident {kind}, mask bigint, at array<int>, term array<int>")


def responsibilities(term: np.ndarray, size: np.ndarray, phi: np.ndarray, inner: int = INNER) -> Iterator[tuple[slice, np.ndarray]]:
    """E-step of passages, in parts that fit a processor's cache: the slice of the
    tokens and their topics under the proportions of their passage."""
    end = np.cumsum(size)
    cuts = np.r_[0, np.flatnonzero(np.diff(end // _CHUNK)) + 1, len(size)] if len(size) else np.zeros(1, dtype=np.int64)
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if a == b:
            continue
        lo, hi = int(end[a] - size[a]), int(end[b - 1])
        like = phi[term[lo:hi]]
        start, row = end[a:b] - size[a:b] - lo, np.repeat(np.arange(b - a), size[a:b])
        theta = np.ones((b - a, phi.shape[1]), dtype=np.float32)
        for _ in range(inner - 1):
            z = np.einsum("ij,ij->i", like, theta[row])
            theta = np.float32(ALPHA) + theta * np.add.reduceat(like / np.maximum(z, np.float32(1e-30))[:, None], start, axis=0)
        p = like * theta[row]
        p /= np.maximum(p.sum(1, keepdims=True), np.float32(1e-30))
        yield slice(lo, hi), p


def _add(out: np.ndarray, term: np.ndarray, p: np.ndarray) -> None:
    by = np.argsort(term, kind="stable")
    t = term[by]
    cut = np.flatnonzero(np.r_[True, t[1:] != t[:-1]])
    out[t[cut]] += np.add.reduceat(p[by], cut, axis=0)


def distributions(counts: np.ndarray) -> np.ndarray:
    """Topics' distributions over terms."""
    phi = counts.astype(np.float32) + np.float32(ETA)
    return phi / phi.sum(0)


def _moved(total: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Centres in the direction of the sums of their members; those without stay."""
    norm = np.sqrt((total * total).sum(1, keepdims=True))
    return np.where(norm > 0, total / np.maximum(norm, 1e-9), centre)


def _clusters(v: np.ndarray, k: int, rng: np.random.Generator, rounds: int = MOVES, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means with spread-out starts; the cluster of each vector, and the
    centres."""
    v = v / np.maximum(np.sqrt((v * v).sum(1, keepdims=True)), 1e-9)
    weight = np.ones(len(v)) if weight is None else weight
    picked = [int(rng.integers(len(v)))]
    far = np.maximum(1 - v @ v[picked[0]], 0)
    while len(picked) < k and ((p := weight * far**2) > 1e-12).any():
        picked.append(int(rng.choice(len(v), p=p / p.sum())))
        far = np.minimum(far, np.maximum(1 - v @ v[picked[-1]], 0))
    centre = v[picked].copy()
    for _ in range(rounds):
        own = (v @ centre.T).argmax(1)
        total = np.zeros_like(centre)
        np.add.at(total, own, (v * weight[:, None]).astype(v.dtype))
        centre = _moved(total, centre)
    return (v @ centre.T).argmax(1), centre


def _total(tokens: DataFrame, make, width: int, k: int, terms: float = np.inf, units: int = _UNITS, dtype: str = "float32") -> np.ndarray:
    """Sum over all passages of the width x k arrays that ``make`` gives for some of
    them.  So that these arrays stay small beside what is read, a task reads up to
    _JOINED partitions if there are many, and an eighth as many ``terms`` (of all
    passages) as its array has numbers if there are few."""
    few = tokens.select("term")
    most = max(4 * tokens.sparkSession.sparkContext.defaultParallelism, few.rdd.getNumPartitions() // _JOINED)
    few = few.coalesce(int(max(1, min(most, 8 * terms / (width * k)))))

    def run(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        return make(list_parts(b.column("term")) for whole in batches for b in arrow_slices(whole, "term", units))

    return sum_blocks(few, run, width, max(8, width * k >> 18), dtype)


def projected(term: np.ndarray, size: np.ndarray, sketch: np.ndarray) -> np.ndarray:
    """Unit vectors of passages."""
    v = np.add.reduceat(sketch[term], np.cumsum(size) - size, axis=0)
    return v / np.maximum(np.sqrt((v * v).sum(1, keepdims=True)), np.float32(1e-9))


def _drawn(tokens: DataFrame, sketch: Broadcast, centre: np.ndarray, n: int, nth: int) -> np.ndarray:
    """The vectors of ``n`` of all passages, drawn by their distance from the centres."""
    u = (F.pmod(F.xxhash64("ident", "at", F.lit(nth)), F.lit(1 << 40)) + 0.5) / (1 << 40)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, vec = np.zeros(0), np.zeros((0, WIDTH), dtype=np.float32)
        for whole in batches:
            for b in arrow_slices(whole, "term", _PART):
                v = projected(*list_parts(b.column("term")), sketch.value)
                far = np.maximum(1 - (v @ centre.T).max(1), 0).astype(np.float64)
                ok = far > 1e-6
                # The least of these are a draw without return, weighed by far ** 2.
                key = np.r_[key, -np.log(b.column("u").to_numpy()[ok]) / far[ok] ** 2]
                vec = np.concatenate([vec, v[ok]])
                least = np.argsort(key, kind="stable")[:n]
                key, vec = key[least], vec[least]
        if len(key):
            yield pa.RecordBatch.from_arrays([pa.array(key), _lists(vec.ravel(), np.arange(len(key)) * WIDTH, pa.float32())], names=["key", "v"])

    rows = tokens.select("term", u.alias("u")).mapInArrow(run, "key double, v array<float>").orderBy("key").limit(n).collect()
    return np.array([r.v for r in rows], dtype=np.float32).reshape(-1, WIDTH)


def start(tokens: DataFrame, n_terms: int, topics: int, seed: int = 1) -> np.ndarray:
    """terms x topics: how often the terms stand in the clusters of all passages."""
    rng = np.random.default_rng(seed)

    def passages(parts) -> np.ndarray:
        out = np.zeros((n_terms + 1, 1))
        for term, size in parts:
            out[:n_terms, 0] += np.bincount(_distinct(term.astype(np.int64), size) & 0xFFFFFFFF, minlength=n_terms)
            out[n_terms, 0] += len(size)
        return out

    seen = _total(tokens, passages, n_terms + 1, 1, dtype="float64")[:, 0]
    rare = np.log((1 + seen[n_terms]) / (1 + seen[:n_terms])).astype(np.float32)
    sketch = tokens.sparkSession.sparkContext.broadcast(rng.standard_normal((n_terms, WIDTH)).astype(np.float32) * rare[:, None])

    def sums(centre: np.ndarray) -> np.ndarray:
        """Per centre the sum of the nearest passages, and their number."""

        def make(parts) -> np.ndarray:
            out = np.zeros((len(centre), WIDTH + 1))
            for term, size in parts:
                v = projected(term, size, sketch.value)
                own = (v @ centre.T).argmax(1)
                by = np.argsort(own, kind="stable")
                cut = np.flatnonzero(np.r_[True, own[by][1:] != own[by][:-1]])
                out[own[by][cut], :WIDTH] += np.add.reduceat(v[by], cut, axis=0)
                out[:, WIDTH] += np.bincount(own, minlength=len(centre))
            return out

        return _total(tokens, make, len(centre), WIDTH + 1, units=_PART, dtype="float64")

    # The first draw is by the distance from the mean.
    centre = sums(np.zeros((1, WIDTH), dtype=np.float32))[:, :WIDTH]
    centre = _moved(centre, centre).astype(np.float32)
    for nth in range(DRAWS):
        centre = np.concatenate([centre, _drawn(tokens, sketch, centre, 2 * topics, nth)])
    weight = sums(centre)[:, WIDTH]
    centre = _clusters(centre[weight > 0], topics, rng, weight=weight[weight > 0])[1].astype(np.float32)
    for _ in range(MOVES):
        centre = _moved(sums(centre)[:, :WIDTH], centre).astype(np.float32)
    k = len(centre)

    def make(parts) -> np.ndarray:
        out = np.zeros((n_terms, k), dtype=np.int32)
        for term, size in parts:
            own = (projected(term, size, sketch.value) @ centre.T).argmax(1)
            np.add.at(out.ravel(), term.astype(np.int64) * k + np.repeat(own, size), 1)
        return out.astype(np.float32)

    counts = _total(tokens, make, n_terms, k, seen[:n_terms].sum(), _PART)
    sketch.destroy()
    return counts[:, counts.sum(0) > 0]


def fit(tokens: DataFrame, counts: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Expected counts after rounds over all passages."""
    for _ in range(rounds):
        phi = tokens.sparkSession.sparkContext.broadcast(distributions(counts))

        def make(parts, phi=phi) -> np.ndarray:
            out = np.zeros(phi.value.shape, dtype=np.float32)
            for term, size in parts:
                for part, p in responsibilities(term, size, phi.value):
                    _add(out, term[part], p)
            return out

        got = _total(tokens, make, *counts.shape, counts.sum(dtype=float))
        phi.destroy()
        if not got.size:
            break
        counts = got
    return counts


def top_terms(counts: np.ndarray, n: int = TOP) -> np.ndarray:
    """topics x n: the terms by which a topic is inspected, those that it holds most
    and mostly itself."""
    spread = counts / np.maximum(counts.sum(1, keepdims=True), 1e-12)
    return np.argsort(-(counts * spread), axis=0, kind="stable")[:n].T


def inspect(labelled: DataFrame, counts: np.ndarray, subjects: int) -> np.ndarray:
    """Per topic the subject that its top terms have in labelled passages, or -1."""
    top, k = top_terms(counts), counts.shape[1]
    member = np.zeros(counts.shape, dtype=np.float32)
    member[top.ravel(), np.repeat(np.arange(k), top.shape[1])] = 1

    def make(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        out = np.zeros((k + 1, 1 + subjects))  # the last row: all labelled passages
        for whole in batches:
            for b in arrow_slices(whole, "term", _UNITS):
                flat, size = list_parts(b.column("term"))
                mask = b.column("mask").to_numpy()
                pairs = _distinct(flat, size)
                row, t = pairs >> 32, pairs & 0xFFFFFFFF
                cut = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else row
                has = np.add.reduceat(member[t], cut, axis=0) >= HITS if len(row) else np.zeros((0, k), dtype=bool)
                m = mask[row[cut]]
                bits = np.concatenate([np.ones((len(m), 1)), (m[:, None] >> np.arange(subjects)) & 1], axis=1)
                out[:k] += has.T.astype(np.float64) @ bits
                out[k] += bits.sum(0)
        return out

    got = sum_blocks(labelled.select("mask", "term"), make, k + 1, 1)
    if not got.size:
        return np.full(k, -1)
    n, by, base = got[:k, 0], got[:k, 1:], got[k, 1:] / got[k, 0]
    order = np.sort(by, axis=1)
    most, second = order[:, -1], order[:, -2] if subjects > 1 else np.zeros(k)
    # Half a passage more keeps a single label from naming a topic too easily.
    what = by.argmax(1)
    need = np.maximum(NAMED, base[what] + LIFT * (1 - base[what]))
    return np.where((most >= need * (n + 0.5)) & (most >= 2) & (most >= 1.5 * second), what, -1)


def merged(counts: np.ndarray, named: np.ndarray, subjects: int, seed: int = 2) -> np.ndarray:
    """One topic a subject, then the others in at most BACKGROUND groups."""
    rest = np.flatnonzero(named < 0)
    to = np.where(named >= 0, named, 0)
    if len(rest):
        rng = np.random.default_rng(seed)
        sketch = rng.standard_normal((64, len(counts))) @ (counts[:, rest] / np.maximum(counts[:, rest].sum(0), 1e-9))
        to[rest] = subjects + _clusters(sketch.T, BACKGROUND, rng)[0]
    # No empty topics: those would be spread evenly over all terms.
    _, to = np.unique(to, return_inverse=True)
    out = np.zeros((len(counts), int(to.max()) + 1), dtype=np.float32)
    np.add.at(out.T, to, counts.T)
    return out[:, out.sum(0) > 0]


def _model(docs, ident, text, labels, label, subjects, lang, first, rounds):
    kind = docs.schema[ident].dataType.simpleString()
    if not subjects:
        return None
    words = coded(docs, ident, text, lang)
    words = written(words, "words").join(labels_of(labels, ident, label, subjects), "ident", "left")
    labelled = written(words.filter("mask is not null").select("mask", "term"), "labelled")
    terms = vocabulary(words, labelled, len(subjects))
    if not len(terms):
        return None
    tokens = written(encoded(words, terms, kind), "tokens")
    labelled = tokens.filter("mask is not null")
    n = tokens.count()
    if not n:
        return None
    # A topic needs some passages to stand on, so a small corpus starts with fewer.
    counts = start(tokens, len(terms), max(len(subjects) + 1, min(TOPICS, n // 16)))
    counts = fit(tokens, counts, first)
    counts = merged(counts, inspect(labelled, counts, len(subjects)), len(subjects))
    counts = fit(tokens, counts, rounds)
    return tokens, counts, inspect(labelled, counts, len(subjects))


def document_subjects(docs: DataFrame, ident: str, text: str, labels: DataFrame, label: str, subjects: list[str], lang: str | None = None, first: int = START, rounds: int = ROUNDS) -> DataFrame:
    """(ident, subject) for every document and each subject of its passages.  ``first``
    and ``rounds`` are the model's rounds before and after topics are merged."""
    spark = docs.sparkSession
    name = docs.schema[ident].dataType.simpleString()
    model = _model(docs, ident, text, labels, label, subjects, lang, first, rounds)
    if model is None:
        return spark.createDataFrame([], f"`{ident}` {name}, subject string")
    tokens, counts, named = model
    own = np.zeros((counts.shape[1], len(subjects)), dtype=np.float32)
    own[np.flatnonzero(named >= 0), named[named >= 0]] = 1
    shared = spark.sparkContext.broadcast((distributions(counts), own))

    def speak(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phi, own = shared.value
        for whole in batches:
            for b in arrow_slices(whole, "term", _UNITS):
                term, size = list_parts(b.column("term"))
                at, _ = list_parts(b.column("at"))
                row = np.repeat(np.arange(len(size)), size)
                who, what, where = [], [], []
                for part, p in responsibilities(term, size, phi, INNER + 1):
                    r, a = row[part], at[part]
                    cut = np.flatnonzero(np.r_[True, (r[1:] != r[:-1]) | (a[1:] != a[:-1])])
                    share = np.add.reduceat(p @ own, cut, axis=0) / np.diff(np.r_[cut, len(r)])[:, None]
                    best = share.argmax(1)
                    says = share[np.arange(len(cut)), best] >= PART
                    who.append(r[cut][says])
                    what.append(best[says])
                    where.append(a[cut][says])
                cat = lambda x: np.concatenate(x) if x else np.zeros(0, dtype=np.int64)
                yield pa.RecordBatch.from_arrays([b.column("ident").take(pa.array(cat(who).astype(np.int64))), pa.array(cat(what), pa.int32()), pa.array(cat(where), pa.int32())], names=["ident", "s", "at"])

    said = tokens.select("ident", "at", "term").mapInArrow(speak, f"ident {name}, s int, at int")
    # Small: sentence numbers of one subject in one document.
    places = said.groupBy("ident", "s").agg(F.array_sort(F.collect_set("at")).alias("at")).filter(F.size("at") >= SENTENCES)
    close = F.exists(F.sequence(F.lit(SENTENCES - 1), F.size("at") - 1), lambda i: F.get("at", i) - F.get("at", i - (SENTENCES - 1)) < SPAN)
    names = F.array(*[F.lit(s) for s in subjects])
    return places.filter(close).select(F.col("ident").alias(ident), F.get(names, F.col("s")).alias("subject"))


def composition(found: DataFrame, docs: DataFrame, ident: str) -> DataFrame:
    """Documents per subject and their share of all documents; a document of two
    subjects counts for both."""
    total = max(docs.count(), 1)
    return found.groupBy("subject").agg(F.count(F.lit(1)).alias("documents")).withColumn("share", F.col("documents") / total)
