"""Anchors that a sample shows to be hot are counted apart and give the same marks."""

import brute
from ledgerlens.llm import repeats, substrings, suffixes


def listed(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_hot_anchors_by_sample(monkeypatch, small):
    rows, docs = small
    monkeypatch.setattr(repeats, "SAMPLE", 1)
    monkeypatch.setattr(repeats, "HOT_ROWS", 2)  # every anchor that occurs again and is more than a thousandth of all rows
    compact = substrings.numbered_packed(docs, "doc_id")
    assert not repeats.hot_anchors(compact, repeats.Kind(by_words=True, window=20, k=6)).isEmpty()
    assert listed(substrings.without_repeats(docs), "doc_id", "n_words", "n_removed", "kept") == sorted(brute.substrings(rows), key=repr)
    assert listed(suffixes.without_repeats(docs), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(brute.repeats(rows), key=repr)


def test_texts_are_exchanged_once(small, monkeypatch):
    """In the executed plan both joins of the packed texts read one exchange."""
    _, docs = small
    out = substrings.without_repeats(docs)
    out.write.format("noop").mode("overwrite").save()
    executed = out._jdf.queryExecution()
    executed.executedPlan().execute().count()
    plan = executed.executedPlan().toString()
    assert plan.count("ReusedExchange") >= 1
