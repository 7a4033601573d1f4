import random

import numpy as np
import pytest

from loomline.llm.mixing import TOKENIZER, Mix, count_tokens, encoder, rates, rounded

KIND = "doc_id bigint, text string, source string, tokens string, s int"


def docs_of(spark, sizes, seed=1):
    rng = random.Random(seed)
    rows, i = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            rows.append((i, " ".join(f"{source or 'none'}{rng.randrange(30)}" for _ in range(rng.randint(5, 40))), source, "x", 1))
            i += 1
    return spark.createDataFrame(rows, KIND)


def test_shares_are_met_and_repeats_bounded(spark):
    docs = docs_of(spark, {"big": 1800, "mid": 600, "small": 120})
    m = Mix(docs, "doc_id", "text", "source", [("big", 0.5, 1), ("mid", 0.3, 2), ("small", 0.2, 4)])
    report = {r.source: r for r in m.report().collect()}
    assert all(r.reached for r in report.values())
    assert abs(sum(r.actual_share for r in report.values()) - 1) < 1e-9
    most = {"big": 1, "mid": 2, "small": 4}
    chosen = m.selection().collect()
    assert len({r.doc_id for r in chosen}) == len(chosen)
    assert all(1 <= r.copies <= most[r.source] for r in chosen)
    text = {r.doc_id: r.text for r in docs.collect()}
    assert all(r.tokens == count_tokens(text[r.doc_id]) for r in chosen)
    # The scarcest source is used up.
    assert report["small"].uses >= 0.96 * 120 * 4 or report["big"].uses >= 0.96 * 1800 or report["mid"].uses >= 0.96 * 1200


def test_targets_that_cannot_be_reached(spark):
    docs = docs_of(spark, {"a": 100, "b": 20, "other": 10, None: 10})
    targets = [("a", 0.4, 1), ("b", 0.4, 1), ("gone", 0.2, 3), (None, 0.3, 1)]
    m = Mix(docs, "doc_id", "text", "source", targets)
    report = {r.source: r for r in m.report().collect()}
    assert set(report) == {"a", "b", "gone"}
    assert not report["gone"].reached and report["gone"].mixed_tokens == 0
    assert abs(report["a"].mixed_tokens - report["b"].mixed_tokens) <= 200
    assert all(r.source != "other" for r in m.selection().collect())
    # With a total beyond what b has, b stops at its cap.
    m = Mix(docs, "doc_id", "text", "source", targets[:2], total=float(sum(report[s].available_tokens for s in "ab")))
    report = {r.source: r for r in m.report().collect()}
    assert report["b"].uses == 20 and not report["b"].reached


def test_empty_and_null_texts(spark):
    docs = spark.createDataFrame([(1, None, "a", "", 1), (2, "", "a", "", 1), (3, "some words here", "a", "", 1)], KIND)
    got = Mix(docs, "doc_id", "text", "source", [("a", 1.0, None)]).selection().collect()
    assert [(r.doc_id, r.copies) for r in got] == [(3, 1)]
    empty = Mix(docs.limit(0), "doc_id", "text", "source", [("a", 1.0, 2)])
    assert empty.selection().count() == 0
    assert [r.mixed_tokens for r in empty.report().collect()] == [0]
    assert Mix(docs, "doc_id", "text", "source", []).selection().count() == 0


@pytest.mark.parametrize("unit", ["word ", "từ ngữ ", "長い文。 ", "a  b", "don't 5 5\n x", "… -- é", "x" * 7 + "\t1"])
def test_long_texts_are_counted_whole(unit):
    text = unit * 9000
    assert count_tokens(text) == len(encoder(TOKENIZER).encode_ordinary(text))


def test_rates_stay_in_their_bounds():
    member, cap = np.array([[1.0, 0], [0, 1], [0.5, 0.5]]), np.array([1.0, 3, 2])
    assert rates(member, cap, np.zeros(2)).tolist() == [0, 0, 0]
    assert rates(member, cap, np.array([2.0, 2.0])).tolist() == [1, 2, 2]
    assert rates(member, cap, np.array([-9.0, 1.0])).tolist() == [0, 1, 0]


def test_rounding_keeps_expectations_and_sums():
    rng = np.random.default_rng(1)
    rate, group, size = rng.uniform(0, 3, 50), np.repeat([0, 1], 25), rng.integers(1, 9, 50)
    many = np.array([rounded(rate, group, size, np.random.default_rng(i)) for i in range(4000)])
    assert np.abs(many.mean(0) - rate).max() < 0.05
    assert ((many == np.floor(rate)) | (many == np.floor(rate) + 1)).all()
    for g in (0, 1):
        assert np.abs(many[:, group == g].sum(1) - rate[group == g].sum()).max() <= 1


def test_the_fit_decides_the_shares(spark):
    data = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{data}/documents.parquet")
    targets = [tuple(r) for r in spark.read.parquet(f"{data}/mix_targets.parquet").select("source", "target_share", "max_repeats").collect()]
    m = Mix(docs, "doc_id", "text", "source", targets)
    assert m.converged and m.history[-1] <= 5e-4
    report = m.report().collect()
    assert all(abs(r.actual_share - r.target_share) <= 0.005 and abs(r.expected_share - r.target_share) <= 0.001 for r in report)
    # Rates of 1 instead of the fitted ones.
    m._chosen, m.level = None, np.full(len(m.names), 9.0)
    m.most = np.ones(len(m.names))
    assert max(abs(r.actual_share - r.target_share) for r in m.report().collect()) > 0.05
    # At the size of the corpus the scarce source stops at its cap, the others don't care.
    whole = {r.source: r for r in Mix(docs, "doc_id", "text", "source", targets, total="corpus").report().collect()}
    assert [s for s, r in whole.items() if not r.reached] and whole["lore_letters"].uses >= 6 * 81 - 3
