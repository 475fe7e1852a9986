"""The pipeline against a plain composition of its stages."""

import base64

import public_tokenizers
import pytest
import tiktoken

import brute
import corpus_pipeline
from ledgerlens.llm import quality
from ledgerlens.llm.frames import kept


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(kept(stage(spark, out[-1], "/root/testdata/sf0.001"), "test-pipeline"))
    return out


def rows(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_stages_keep_the_columns(stages):
    assert all(df.columns == stages[0].columns for df in stages[:-1])


def test_each_stage(stages):
    good = {r.doc_id for r in quality.quality(stages[0]).where("kept").collect()}
    assert {d for d, _ in rows(stages[1])} == good
    assert {d for d, _ in rows(stages[2])} == {d for d, _, c in brute.groups(rows(stages[1])) if d == c}
    cut = {d: (gone, text) for d, _, gone, text in brute.substrings(rows(stages[2]))}
    before = dict(rows(stages[2]))
    assert dict(rows(stages[3])) == {d: text if gone else before[d] for d, (gone, text) in cut.items()}
    total = sum(len(brute.words(t)) for _, t in rows(stages[3]))
    taken = sum(len(brute.words(t)) for _, t in rows(stages[4]))
    assert abs(taken - 1.5 * total) < 0.2 * total and set(rows(stages[4])) <= set(rows(stages[3]))


def test_tokens_round_trip(stages):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path(corpus_pipeline.VOCABULARY), "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = sorted(t for _, t in rows(stages[4]))
    last = stages[5].collect()
    assert sorted(r.decoded for r in last) == texts
    assert all(r.ids == library.encode_ordinary(r.decoded) for r in last)


def test_empty_table_goes_through(spark, stages):
    docs = stages[0].limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = kept(stage(spark, docs, ""), "test-pipeline")
    assert docs.count() == 0
