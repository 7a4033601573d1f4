import random
import re
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomline.llm.leakage import PASSAGE, RANK, RUN, TERMS, ItemBlock, _apply_gram, _join, exact_leaks, lcs_length, leaks
from loomline.llm.words import flat_ids, new_ids, tokenised, word_ids, words

DOC, ITEM = "doc_id bigint, text string, ids string, item int", "item_id bigint, text string"


def brute(docs, items):
    grams = lambda t: {tuple(w[i : i + RUN]) for w in [words(t)] for i in range(len(w) - RUN + 1)}
    sets = {i: grams(t) for i, t in items}
    return {(d, i) for d, t in docs for i, g in sets.items() if g & grams(t)}


def found(spark, docs, items):
    d = spark.createDataFrame([(*r, "x", 1) for r in docs], DOC)
    got = leaks(d, "doc_id", "text", spark.createDataFrame(items, ITEM), "item_id", "text").collect()
    return {(r.doc, r.item) for r in got if r.run >= RUN}, {(r.doc, r.item): r for r in got}


@pytest.mark.parametrize("length", [9, 10, 11, 14])
def test_runs_of_words_at_any_place(spark, length):
    rng = random.Random(length)
    vocabulary = [f"từ{i}" for i in range(300)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(text(60))) for i in range(6)]
    docs = []
    for d in range(40):
        w, i = text(80), rng.randrange(6)
        a, b = rng.randrange(60 - length), rng.randrange(60)
        w[b:b] = items[i][1].split()[a : a + length]
        docs.append((d, " ".join(w)))
    got, _ = found(spark, docs, items)
    assert got == brute(docs, items)
    assert len(got) == (0 if length < RUN else 40)


def test_formatting_composition_length_and_blanks(spark):
    item = "Bảy người thợ đi qua cây cầu gỗ cũ rồi dừng lại bên sông xanh"
    other = "one two three four five six seven eight nine ten eleven twelve"
    docs = [
        (1, unicodedata.normalize("NFD", item.upper())), (2, "  ".join(re.findall(r"\w+", item)).replace("  ", " -\r\n")), (3, None), (4, ""), (5, "!!"),
        (6, "x y z " * 20_000 + item + " q" * 3), (7, item), (8, item), (9, other.replace(" ", ", ")), (10, "two three four"), (11, other + " " + item),
    ]
    items = [(1, item), (2, other), (3, item), (4, None), (5, "short"), (6, "")]
    got, rows = found(spark, docs, items)
    assert got == brute(docs, items)
    assert (6, 1) in got
    assert rows[7, 1].run == len(words(item))


def test_paraphrases_are_told_apart(spark):
    rng = random.Random(9)
    item = " ".join(f"w{rng.randrange(200)}" for _ in range(40))
    w = item.split()
    for i in range(4, len(w), 6):  # every run is broken, the order stays
        w[i] = "and"
    noise = [(i, " ".join(f"w{rng.randrange(200)} and" for _ in range(60))) for i in range(2, 30)]
    got, rows = found(spark, [(1, " ".join(w)), *noise], [(1, item)])
    assert got == set()
    assert rows[1, 1].lcs > 0


@pytest.mark.parametrize("batch", [1, 7, 10_000])
def test_paraphrases_in_short_texts_and_any_batch(batch):
    # A wide random basis keeps the cosines of the words themselves.
    rng = random.Random(4)
    text = lambda n: [f"w{rng.randrange(20000)}" for _ in range(n)]
    broken = lambda w: [f"x{i}" if i % 9 == 8 else x for i, x in enumerate(w)]
    full, short = text(64), text(20)
    basis = np.random.default_rng(1).standard_normal((TERMS, 512)).astype(np.float32)
    block = ItemBlock([1, 2], [" ".join(full), " ".join(short)], basis, np.ones(TERMS))
    docs = [broken(full[:20]), broken(full[8:45]), text(41) + broken(full[32:64]), broken(short), text(37) + broken(short)]
    docs += [text(rng.randrange(1, 60)) for _ in range(50)]
    ids, found = new_ids(), set()
    for k in range(0, len(docs), batch):
        joined = _join([word_ids(" ".join(d), ids) for d in docs[k : k + batch]], 0)
        found |= {(o + k, int(block.idents[i])) for o, i, _, lcs in block.search(*joined) if lcs}
    assert found == {(0, 1), (1, 1), (2, 1), (3, 2), (4, 2)}


def edited(w, share, rng, other):
    """Words replaced or dropped, and one put in after every seven."""
    out = []
    for j, x in enumerate(w):
        if rng.random() >= share:
            out.append(x)
        elif rng.random() < 0.5:
            out.append(rng.choice(other))
        if j % 8 == 7:
            out.append(rng.choice(other))
    return out


def test_recall_and_precision_of_planted_paraphrases(spark):
    rng = random.Random(3)
    docs = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    items = pq.read_table("/root/testdata/sf0.01/eval_items.parquet", columns=["item_id", "text"]).to_pylist()
    before = [(d["doc_id"], d["text"]) for d in docs]
    other = [w for d in docs[:200] for w in words(d["text"])]
    planted = {}
    for share in (0.0, 0.1, 0.2):
        for k in range(60):
            w, host = words(items[4 * k]["text"])[:44], words(docs[rng.randrange(len(docs))]["text"])
            at = rng.randrange(len(host) + 1)
            planted[100_000 + len(planted)] = share, items[4 * k]["item_id"], " ".join(host[:at] + edited(w, share, rng, other) + host[at:])
    everything = spark.createDataFrame(before + [(d, t) for d, (_, _, t) in planted.items()], "doc_id bigint, text string")
    got = leaks(everything, "doc_id", "text", spark.createDataFrame([(i["item_id"], i["text"]) for i in items], ITEM), "item_id", "text").collect()
    said = {(r.doc, r.item) for r in got if r.run >= RUN or r.lcs}
    for share in (0.0, 0.1, 0.2):
        mine = [(d, i) for d, (s, i, _) in planted.items() if s == share]
        assert sum(p in said for p in mine) >= 0.9 * len(mine), share
    true = {(d, i) for d, (_, i, _) in planted.items()} | brute([(d, t) for d, t in before] + [(d, t) for d, (_, _, t) in planted.items()], [(i["item_id"], i["text"]) for i in items])
    assert len(said & true) >= 0.95 * len(said)
    # An index without meaning still may not lose a run.
    noise = np.random.default_rng(5).standard_normal((TERMS, RANK))
    blind = leaks(everything, "doc_id", "text", spark.createDataFrame([(i["item_id"], i["text"]) for i in items], ITEM), "item_id", "text", basis=noise).collect()
    assert {(r.doc, r.item) for r in blind if r.run >= RUN} == {(r.doc, r.item) for r in got if r.run >= RUN}


def test_the_latent_space_finds_rewordings_that_noise_does_not(spark):
    # A topic's words replace each other freely, so only co-occurrence relates them.
    rng = random.Random(8)
    word = lambda topic, c: f"t{topic}c{c}v{rng.randrange(4)}"
    passage = lambda topic, n: [word(topic, rng.randrange(12)) for _ in range(n)]
    docs = [(d, " ".join(passage(d % 40, 60))) for d in range(1200)]
    items, planted = [], []
    for i in range(80):
        w = passage(i % 40, 40)
        items.append((i, " ".join(w)))
        new = [x if k % 3 else x[: x.index("v")] + f"v{(int(x[-1]) + 1) % 4}" for k, x in enumerate(w)]
        planted.append((10_000 + i, " ".join(passage((i + 7) % 40, 30) + new + passage((i + 3) % 40, 30))))
    d = spark.createDataFrame(docs + planted, "doc_id bigint, text string")
    q = spark.createDataFrame(items, ITEM)
    recall = lambda rows: sum((10_000 + i, i) in {(r.doc, r.item) for r in rows if r.lcs} for i in range(80)) / 80
    fitted = recall(leaks(d, "doc_id", "text", q, "item_id", "text").collect())
    noise = recall(leaks(d, "doc_id", "text", q, "item_id", "text", basis=np.random.default_rng(1).standard_normal((TERMS, RANK))).collect())
    print("recall fitted", fitted, "noise", noise)
    assert fitted >= 0.9
    assert noise < fitted - 0.1


def test_the_index_is_fitted_on_all_passages(spark, monkeypatch):
    # Far more passages than a sample would hold, and a theme that only documents of
    # the highest hashes have.
    rng = np.random.default_rng(6)
    words_of = [" ".join(f"w{k}" for k in row) for row in rng.integers(0, 300, (24_000, 8))]
    high = spark.range(24_000).filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) > 0.98 * (1 << 30)).collect()
    assert len(high) > 300
    for r in high:
        words_of[r.id] = "alone " * 8
    used, init = [], ItemBlock.__init__

    def seen(self, idents, texts, basis, weight, *rest):
        used.append((basis, *rest))
        init(self, idents, texts, basis, weight, *rest)

    monkeypatch.setattr(ItemBlock, "__init__", seen)
    monkeypatch.setattr("loomline.llm.leakage.BLOCK", 30)
    items = [(0, "w0 " * 20), (1, "w1 " * 20), (2, "w2 w3 " * 10)]
    found(spark, list(enumerate(words_of)), items)
    term = word_ids("alone w1", new_ids()) & (TERMS - 1)
    size = np.linalg.norm(used[0][0][term], axis=1)
    assert size[0] > 0.5 * size[1] > 0
    # Rare words are told by one threshold, whatever the block.
    assert len(used) == 3
    assert len({rare for _, rare in used}) == 1


def test_the_gram_product_of_short_and_long_texts(spark):
    rng = np.random.default_rng(2)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 40, n)) for n in [1] * 3000 + [33, 200, 9000, 31, 32]]
    tokens = tokenised(spark.createDataFrame(list(enumerate(texts)), "d bigint, t string"), "d", "t", 8192)
    weight, x = rng.random(TERMS).astype(np.float32) + 1, rng.standard_normal((TERMS, 5)).astype(np.float32)
    rows = []
    for r in tokens.collect():
        for k in range(0, len(r.ids), PASSAGE):
            v = np.bincount(np.array(r.ids[k : k + PASSAGE]) & (TERMS - 1), minlength=TERMS) * weight
            rows.append(v / np.linalg.norm(v))
    a = np.array(rows, dtype=np.float32)
    assert np.allclose(_apply_gram(tokens, weight, x), a.T @ (a @ x), rtol=1e-3, atol=1e-2)


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    rng = random.Random(2)
    text = lambda n: " ".join(f"w{rng.randrange(900)}" for _ in range(n))
    items = [(i, text(50)) for i in range(8)]
    docs = [(d, text(30) + " " + " ".join(items[d % 8][1].split()[5:25]), "x", d) for d in range(20)]
    once, _ = found(spark, [r[:2] for r in docs], items)
    monkeypatch.setattr("loomline.llm.leakage.BLOCK", 120)
    assert found(spark, [r[:2] for r in docs], items)[0] == once == {(d, d % 8) for d in range(20)}


def test_words_in_arrow_are_the_same_and_long_texts_are_cut_with_overlap(spark):
    texts = ["Một HAI, ba!", None, "", "--", "a_b c", unicodedata.normalize("NFD", "Đường về"), "第12話 ok"]
    flat, size = flat_ids(pa.array(texts, pa.string()), new_ids())
    ids = new_ids()
    assert size.tolist() == [len(words(t)) for t in texts]
    assert flat.tolist() == [ids[w] for t in texts for w in words(t)]
    d = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(23))), (2, "x y"), (3, None)], "d bigint, t string")
    got = sorted((r.ident, r.base, len(r.ids)) for r in tokenised(d, "d", "t", 10, 3).collect())
    assert got == [(1, 0, 10), (1, 7, 10), (1, 14, 9), (2, 0, 2)]


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a " * 20)])[0] == set()
    assert found(spark, [(1, "a " * 20)], [])[0] == set()
    assert exact_leaks(spark.createDataFrame([(1, 1, 10, 0), (1, 2, 9, 30)], "doc int, item int, run int, lcs int")).count() == 1


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 5), max_size=20), st.lists(st.integers(1, 5), max_size=20))
def test_lcs(a, b):
    t = np.zeros((len(a) + 1, len(b) + 1), dtype=int)
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1, j + 1] = t[i, j] + 1 if x == y else max(t[i, j + 1], t[i + 1, j])
    assert lcs_length(a, b) == t[-1, -1]
