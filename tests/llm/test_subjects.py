import random

import duckdb
import numpy as np

from loomline.llm import subjects
from loomline.llm.subjects import _hash, coded, coded_texts, composition, document_subjects, labels_of, vocabulary
from loomline.session import written

DOC, LABEL = "doc_id bigint, text string, at string, term string", "doc_id bigint, subject string"
TERMS = {s: [s + a + b for a in "abcdef" for b in "mnop"] for s in ("sea", "food")}
FILL = ["Rain fell on the {} all day.", "Nobody went to the {} again.", "They waited near the {} for hours."]
PLACES = ["gate", "mill", "tower", "pier", "ridge", "camp"]


def corpus(n, seed=1):
    rng = random.Random(seed)
    docs, truth, labels = [], set(), []
    for i in range(n):
        parts = []
        for s in rng.sample([*[None] * 6, "sea", "food"], 4):
            if s is None:
                lines = [rng.choice(FILL).format(rng.choice(PLACES)) for _ in range(5)]
                if rng.random() < 0.3:
                    lines[2] = f"For a moment one thought of the {rng.choice(TERMS[rng.choice(list(TERMS))])}."
            else:
                lines = [f"Without the {rng.choice(TERMS[s])} even a {rng.choice(TERMS[s])} is worth little." for _ in range(5)]
                truth.add((i, s))
            parts.append(" ".join(lines))
        docs.append((i, rng.choice(["\n\n", "\r\n", "\n"]).join(parts), "x", "y"))
        if i % 2 == 0:
            mine = [s for d, s in truth if d == i]
            labels += [(i, s.upper() if rng.random() < 0.2 else s) for s in mine] or [(i, None)]
    return docs, truth, labels


def test_subjects_of_passages(spark):
    docs, truth, labels = corpus(1500)
    labels += [labels[0], (99999, "sea"), (None, "sea"), (4, "unknown")]
    d = spark.createDataFrame(docs, DOC)
    found = document_subjects(d, "doc_id", "text", spark.createDataFrame(labels, LABEL), "subject", ["sea", "food"])
    got = {tuple(r) for r in found.collect()}
    assert len(got & truth) / len(got) > 0.97
    assert len(got & truth) / len(truth) > 0.97
    share = {r.subject: r.documents for r in composition(found, d, "doc_id").collect()}
    assert share["sea"] == len([1 for _, s in got if s == "sea"])


def test_topics_start_from_all_passages(spark, monkeypatch):
    # Every term of every passage counts once, before topics are merged and after.
    rng = random.Random(5)
    lines = lambda s: " ".join(f"Without the {rng.choice(TERMS[s])} even a {rng.choice(TERMS[s])} is lost." for _ in range(3))
    docs = [(i, lines("sea" if i % 2 else "food"), "x", "y") for i in range(12_000)]
    labels = [(i, "sea" if i % 2 else "food") for i in range(0, 12_000, 7)]
    counted, real = [], subjects.inspect

    def seen(labelled, counts, n):
        counted.append(counts.sum(dtype=float))
        return real(labelled, counts, n)

    monkeypatch.setattr(subjects, "inspect", seen)
    found = document_subjects(spark.createDataFrame(docs, DOC), "doc_id", "text", spark.createDataFrame(labels, LABEL), "subject", ["sea", "food"])
    assert found.count() > 0.95 * len(docs)
    assert len(counted) == 2
    assert abs(counted[0] - counted[1]) < 0.01 * counted[1]


def test_core_terms_of_a_frequent_subject(spark):
    # A third of the documents are of one subject with six terms, which all stand
    # in far more than MOST_SHARE of the passages.
    rng = random.Random(3)
    docs, truth, labels = [], set(), []
    for i in range(300):
        # Other documents have the frame of the subjects' sentences, too.
        plain = [*FILL, "Without the {} even a %s is worth little." % rng.choice(PLACES)]
        lines = [rng.choice(plain).format(rng.choice(PLACES)) for _ in range(10)]
        s = "sea" if i % 3 == 0 else "food" if i % 5 == 1 else None
        if s:
            own = TERMS["sea"][:6] if s == "sea" else TERMS["food"][:12]
            lines[3:3] = [f"Without the {rng.choice(own)} even a {rng.choice(own)} is worth little." for _ in range(6)]
            truth.add((i, s))
        docs.append((i, " ".join(lines[:6]) + "\n" + " ".join(lines[6:]), "x", "y"))
        if i % 2 == 0:
            labels.append((i, s))
    d, given = spark.createDataFrame(docs, DOC), spark.createDataFrame(labels, LABEL)
    words = written(coded(d, "doc_id", "text", None), "words").join(labels_of(given, "doc_id", "subject", ["sea", "food"]), "ident", "left")
    kept = set(vocabulary(words, words.filter("mask is not null").select("mask", "term"), 2).tolist())
    assert {_hash(t) for t in TERMS["sea"][:6]} <= kept
    assert not {_hash(t) for t in ("the", "rain", "nobody")} & kept
    got = {tuple(r) for r in document_subjects(d, "doc_id", "text", given, "subject", ["sea", "food"]).collect()}
    assert len(got & truth) / max(len(got), 1) > 0.95
    assert len(got & truth) / len(truth) > 0.95


def test_without_texts_or_labels(spark):
    docs, _, labels = corpus(20)
    none = spark.createDataFrame([], LABEL)
    assert document_subjects(spark.createDataFrame(docs, DOC), "doc_id", "text", none, "subject", ["sea", "food"]).count() == 0
    assert document_subjects(spark.createDataFrame([], DOC), "doc_id", "text", spark.createDataFrame(labels, LABEL), "subject", ["sea"]).count() == 0
    blank = spark.createDataFrame([(1, None, "", ""), (2, "", "", ""), (None, "a", "", "")], DOC)
    assert document_subjects(blank, "doc_id", "text", spark.createDataFrame(labels, LABEL), "subject", ["sea"]).count() == 0


def test_held_out_labels_and_what_the_rounds_do(spark):
    data = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/subject_labels.parquet")
    c = duckdb.connect()
    names = [r[0] for r in c.execute(f"SELECT subject FROM '{data}/subject_areas.parquet' ORDER BY 1").fetchall()]
    given = labels.filter("doc_id % 2 = 0")
    rows = lambda **k: {tuple(r) for r in document_subjects(docs, "doc_id", "text", given, "subject", names, "lang", **k).collect()}
    true = {tuple(r) for r in c.execute(f"SELECT DISTINCT doc_id, lower(trim(subject)) FROM '{data}/subject_labels.parquet' WHERE doc_id % 2 = 1 AND subject IS NOT NULL").fetchall()}
    asked = {r[0] for r in c.execute(f"SELECT doc_id FROM '{data}/subject_labels.parquet' WHERE doc_id % 2 = 1").fetchall()}
    fitted = rows()
    got = {r for r in fitted if r[0] in asked}
    # Some labels are wrong, so 1 is out of reach.
    assert len(got & true) / len(got) > 0.93
    assert len(got & true) / len(true) > 0.92
    # Mere clusters of passages, without any round of the topic model.
    clusters = rows(first=0, rounds=0)
    f1 = lambda r: 2 * len({x for x in r if x[0] in asked} & true) / (len({x for x in r if x[0] in asked}) + len(true))
    print("f1 fitted", f1(fitted), "clusters", f1(clusters), "rows that differ", len(fitted ^ clusters))
    assert len(fitted ^ clusters) > 0.005 * len(fitted)
    assert f1(fitted) >= f1(clusters)
    assert rows(rounds=0) != fitted


def test_passages_and_terms():
    def parts(t):
        _, p, s, h = coded_texts([t])
        return [(len(set(s[p == k].tolist()))) for k in np.unique(p)], set(h.tolist())

    assert len(coded_texts([None, "", "..", "12"])[0]) == 0
    assert parts("One a. Two b. Three c.\n\nFour d. Five e. Six f.")[0] == [3, 3]
    assert parts("One a.\nTwo b.\nThree c.\nFour d.")[0] == [3, 1]
    text, passage, sentence, term = coded_texts(["a b. c", None, "d"])
    assert text.tolist() == [0, 0, 0, 0, 2]
    assert sentence.tolist() == [0, 0, 0, 1, 0]
    assert term[[0, 1, 3, 4]].tolist() == [_hash(x) for x in "abcd"]
    assert {_hash("焼"), _hash("根菜")} <= parts("焼いた根菜")[1]
    assert {_hash(x) for x in ("old", "anchor", "chain")} < parts("old 5 anchor chain")[1]
    assert len(parts("old anchor chain")[1]) == 5
    # Texts are coded the same whatever stands beside them.
    alone = [coded_texts([t])[3].tolist() for t in ("One a. Two", "根菜と b c", "x\ny")]
    assert coded_texts(["One a. Two", "根菜と b c", "x\ny"])[3].tolist() == sum(alone, [])
