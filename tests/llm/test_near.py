"""SimHash near duplicates against plain versions."""

import random

import pytest

import brute
from corpus_rows import ROWS
from ledgerlens.llm import multiindex


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def listed(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def wanted(rows):
    prints = [brute.simhash(text) for _, text in rows]
    ids = brute.linked(rows, prints, lambda a, b: (a ^ b).bit_count() <= 3)
    return sorted(((doc, signed(p), low) for (doc, _), p, low in zip(rows, prints, ids)), key=repr)


def test_near_groups(spark, edge, nothing, small):
    for docs, rows in ((edge, [(r[0], r[1]) for r in ROWS]), (small[1], small[0])):
        assert listed(multiindex.near_groups(docs), "doc_id", "fingerprint", "component_id") == wanted(rows)
    assert multiindex.near_groups(nothing).count() == 0
    assert multiindex.near_groups(edge).columns == ["doc_id", "fingerprint", "component_id"]


def test_texts_in_blocks(monkeypatch, small):
    monkeypatch.setattr(multiindex, "BLOCK", 7)
    for _, text in small[0][:20]:
        assert multiindex.fingerprint(text) == brute.simhash(text)


def test_near_copies_are_found(spark, small):
    rnd, rows = random.Random(3), []
    for doc, text in small[0]:
        rows.append((doc, text))
        words = (text or "").split(" ")
        for copy in range(2):
            words[rnd.randrange(len(words))] = "changed"
            rows.append((doc + 100_000 * (copy + 1), " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert listed(multiindex.near_groups(docs), "doc_id", "fingerprint", "component_id") == wanted(rows)


@pytest.mark.parametrize("crowd", [256, 8, 2])
@pytest.mark.parametrize("radius", [3, 2, 1])
def test_pairs_with_crowded_keys(spark, crowd, radius):
    """Balls around few centres crowd the keys, so that with a low limit every level of the descent is taken."""
    rnd = random.Random(crowd + radius)
    centres = [rnd.getrandbits(64) for _ in range(3)] + [0, (1 << 64) - 1]
    prints = sorted({c ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 4))) for c in centres for _ in range(60)})
    frame = spark.createDataFrame([(signed(p),) for p in prints], "fingerprint long")
    got = {frozenset(r) for r in multiindex.near_pairs(frame, radius, crowd).collect()}
    assert got == {frozenset((signed(a), signed(b))) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= radius}
