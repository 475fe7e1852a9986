"""Importance resampling against a plain version."""

import re

import pytest
from hypothesis import given, settings, strategies as st

import brute
from corpus_rows import ROWS
from ledgerlens.llm import resample

COLUMNS = ("doc_id", "n_features", "weight", "score", "rank")


def listed(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def ordered(rows):
    return sorted(rows, key=repr)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("aZk09 \t\n.-_\u00e9\u6f22\U0001f600'"), max_size=60), st.integers(1, 3))
def test_spans_are_runs_of_words(text, most):
    w = re.findall("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", brute.lowered(text))
    assert [s.decode() for s in resample.spans(text, most)] == [" ".join(w[i:i + n]) for n in range(1, most + 1) for i in range(len(w) - n + 1)]


@pytest.mark.parametrize("most, buckets, percent, least", [(1, 10_000, 10, 20), (2, 50, 30, 1), (3, 1000, 100, 5)])
def test_resample(spark, edge, small, most, buckets, percent, least):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    target = [r.text for r in items.select("text").collect()]
    options = dict(most=most, buckets=buckets, percent=percent, least_words=least)
    for docs, rows in ((edge, [(r[0], r[1]) for r in ROWS]), (small[1], small[0])):
        want = brute.resampled(rows, target, most, buckets, 2024, least, percent)
        assert listed(resample.resample(docs, items, **options)) == ordered(want)


def test_empty_tables(spark, edge, nothing):
    assert resample.resample(nothing, edge).count() == 0
    assert listed(resample.resample(edge, nothing)) == ordered(brute.resampled([(r[0], r[1]) for r in ROWS], []))


def test_drawn_documents_lean_to_the_target(spark):
    rows = [(i, " ".join(f"{'far' if i % 2 else 'near'}{(i * 7 + k) % 40}" for k in range(30))) for i in range(400)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, rank string")
    target = spark.createDataFrame([(" ".join(f"near{k}" for k in range(40)),)] * 20, "text string")
    kept = resample.drawn(docs, target)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == 40 and sum(1 for i in ids if i % 2 == 0) >= 38
