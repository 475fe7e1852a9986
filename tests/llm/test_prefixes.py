"""Candidates among rows with crowded columns: the rarest quarter of a row's columns decides."""

import random
from itertools import combinations

import brute
import pytest
from ledgerlens.llm import frames, ngrams


def with_passage(n=120):
    """Different texts that share one passage of 60 words."""
    rnd = random.Random(11)
    passage = [f"p{i}" for i in range(60)]
    return [(i, " ".join([f"w{rnd.randrange(100_000)}" for _ in range(120)] + passage)) for i in range(n)]


def test_a_common_passage_makes_no_family(spark, monkeypatch):
    """Texts that share a passage are not multiplied with one another: that would grow with the square of their number."""
    seen, plain = [], ngrams._crowded_edges

    def watched(rows, texts, k):
        seen.append(rows.groupBy("family").agg({"node": "count"}).count())
        return plain(rows, texts, k)

    monkeypatch.setattr(ngrams, "_crowded_edges", watched)
    rows = with_passage()
    got = ngrams.similar_groups(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == sorted(brute.groups(rows))
    assert seen == [0]


@pytest.mark.parametrize("edits", [0, 3, 9])
def test_similar_rows_share_a_column_of_their_prefixes(spark, edits):
    rnd = random.Random(edits)
    bases = [[f"b{rnd.randrange(400)}" for _ in range(rnd.choice([6, 30, 90]))] for _ in range(4)]
    rows = with_passage(10)
    for base in bases:
        for _ in range(12):
            copy = list(base)
            for _ in range(rnd.randint(0, edits)):
                copy[rnd.randrange(len(copy))] = f"n{rnd.randrange(10_000)}"
            rows.append((len(rows), " ".join(copy[:rnd.randint(len(copy) - 1, len(copy))])))
    docs = frames.numbered(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text")
    texts = frames.kept(frames.packed(docs, "_row"), "texts")
    found = ngrams.prefixes(docs.selectExpr("_row AS node"), texts)
    kept = {}
    for r in found.collect():
        kept.setdefault(r.node, {})[r["col"]] = r
    early = {frozenset((r.a, r.b)) for r in ngrams._met_early(found).collect()}
    sets = {}
    for r in docs.collect():
        words = r.text.split(" ")
        sets[r._row] = {tuple(words[i:i + 5]) for i in range(len(words) - 4)}
    similar = 0
    for a, b in combinations(sets, 2):
        one = len(sets[a] & sets[b])
        if 4 * one >= 3 * (len(sets[a]) + len(sets[b]) - one):
            similar += 1
            assert set(kept[a]) & set(kept[b]) and frozenset((a, b)) in early
    assert similar >= 12
    assert all(r.n == len(sets[node]) and r.pos <= r.n // 4 and r.held > 1 for node, columns in kept.items() for r in columns.values())
