"""Operators against plain versions, and the cases each docstring defines."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import brute
from corpus_rows import LONG, ROWS
from ledgerlens.llm import bpe, extract, frames, licenses, mixing, ngrams, quality, repeats, sharding, simhash, substrings, suffixes
from ledgerlens.llm.components import components

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PAIRS = [(r[0], r[1]) for r in ROWS]


def listed(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def ordered(rows):
    return sorted(rows, key=repr)


# Main text

PAGE = """<html><body><header><h1>Site</h1></header><nav><a href=x>menu</a></nav><div class="cookie-notice">We use cookies on this site</div>
<div class=content><h1>Real &amp; title</h1><p>First paragraph with quite a lot of text in it, <a href=y>really</a>, so that it is dense.<p>Second
 one is   also long enough.<ul><li>item one<li>item two</ul></div><div class="sidebar"><p>Side side side</p></div>
<div class="comments"><p>I am a reader and I comment with a long comment that is dense and more.</p></div><script>x()</script></body></html>"""


def test_main_text(spark, nothing):
    pages = spark.createDataFrame(
        [(1, "u", PAGE, "t"), (2, None, None, "t"), (3, "u", "", "t"), (4, "u", "plain &lt; text", "t"), (5, "u", "<p>a<p>b<div>c<b>d", "t"),
         (6, "u", "<div>" * 3000 + "deep", "t"), (None, "u", "<article><p>one</p><br><p>two &eacute;", "t")],
        "page_id long, url string, html string, text string")
    got = {r.page_id: r for r in extract.extract(pages).collect()}
    assert got[1].text.split("\n\n") == [
        "Real & title", "First paragraph with quite a lot of text in it, really, so that it is dense.",
        "Second one is also long enough.", "item one", "item two"]
    assert (got[2].text, got[3].text, got[4].text, got[5].text, got[6].text) == ("", "", "plain < text", "a\n\nb\n\ncd", "deep")
    assert got[None].text == "one\n\ntwo é" and got[None].n_chars == len("one\n\ntwo é")
    assert extract.extract(pages.limit(0)).count() == 0


BODY = "<p>" + "A paragraph of the article itself, with enough words to be dense. " * 5 + "</p>"


@pytest.mark.parametrize("name", ["post comments-open", "post category-social", "post tag-navigation", "has-sidebar", "comment"])
def test_articles_are_not_left_out_by_name(name):
    text = " ".join(BODY[3:-4].split())
    assert extract.main_text(f'<body><div class="sidebar">{BODY}</div><article class="{name}">{BODY}</article></body>') == text
    assert extract.main_text(f'<body><div class="layout has-sidebar"><div class="inner"><main id="{name}">{BODY}</main></div></div></body>') == text


def test_names_inside_an_article():
    page = (f'<body><article><header class="entry-header"><h1>Title</h1></header>{BODY}<h2 id="related-work">Related work</h2>{BODY}'
            f'<section id="discussion"><h2 id="discussion">Discussion</h2>{BODY}</section><div class="related-posts"><p>Read on</p></div>'
            '<section class="related"><ul><li><a href=a>One more</a><li><a href=b>Another</a></ul></section><div class="ad">Buy</div></article></body>')
    text = " ".join(BODY[3:-4].split())
    assert extract.main_text(page).split("\n\n") == ["Title", text, "Related work", text, "Discussion", text]


LINKS = "<ul>" + "".join(f"<li><a href=/{i}>Another story number {i} of today</a>" for i in range(8)) + "</ul>"
OTHER = "<p>" + "I read this and think quite differently about it, dear author. " * 3 + "</p>"


@pytest.mark.parametrize("page", [
    f"<main><article>{BODY}{BODY}</article><div><h3>More stories</h3>{LINKS}</div></main>",
    f"<main><article>{BODY}{BODY}</article><article class='comment'>{OTHER}</article></main>",
    f"<main><article>{BODY}{BODY}<article class='comment'>{OTHER}</article></article></main>",
    f"<main><div class='adbox'><p>Buy two of these now and save</p></div><article>{BODY}{BODY}</article></main>",
    f"<article>{BODY}<div><h3>More stories</h3>{LINKS}</div>{BODY}</article>",
    f"<main>{BODY}{BODY}<div><h3>More stories</h3>{LINKS}</div></main>",
    f"<div id=x>{BODY}{BODY}</div><div><h3>More stories</h3>{LINKS}</div>"])
def test_densities_decide_inside_articles(page):
    text = " ".join(BODY[3:-4].split())
    assert extract.main_text(f"<html><body>{page}</body></html>").split("\n\n") == [text, text]


def test_a_list_of_articles_stays_whole():
    page = "<body><main>" + f"<article>{BODY}</article>" * 4 + "</main></body>"
    assert len(extract.main_text(page).split("\n\n")) == 4
    linked = BODY.replace("itself", "<a href=x>itself</a>")
    assert extract.main_text(f"<body><article>{linked}{BODY}</article></body>").count("itself") == 10


# Mixing

def test_mix_reaches_targets(spark, small):
    _, docs = small
    got = mixing.mix(docs).collect()
    again = mixing.mix(docs.repartition(3)).select("doc_id", "taken")
    assert {(r.doc_id, r.taken) for r in got} == {(r.doc_id, r.taken) for r in again.collect()}
    by_source = {}
    for r in got:
        assert r.taken in (0, r.size, 2 * r.size)
        by_source.setdefault(r.source, []).append(r)
    total = sum(r.size for r in got)
    assert abs(sum(rs[0].target for rs in by_source.values()) - 1.5 * total) < 1e-6 * total
    for rs in by_source.values():
        assert rs[0].target <= 2 * rs[0].source_size
        assert abs(sum(r.taken for r in rs) - rs[0].target) <= max(r.size for r in rs) / 2 + 1


def test_targets_match_resharing(spark):
    rnd = random.Random(4)
    for _ in range(5):
        sizes = [(f"s{i:02}", rnd.choice([0, 1, 10, 1000, 10 ** rnd.randint(0, 6)])) for i in range(9)]
        got = {r.source: r.target for r in mixing.targets(spark.createDataFrame(sizes, "source string, source_size long")).collect()}
        weight = {s: (5, 2, 1)[i % 3] for i, (s, _) in enumerate(sizes)}
        fixed, rest = {}, 1.5 * sum(n for _, n in sizes)
        free = dict(sizes)
        while free:
            level = (rest - sum(fixed.values())) / sum(weight[s] for s in free)
            over = [s for s in free if level * weight[s] > 2 * free[s]]
            if not over:
                fixed.update({s: level * weight[s] for s in free})
                break
            for s in over:
                fixed[s] = 2 * free.pop(s)
        assert got == pytest.approx(fixed)


def test_mix_edges(edge, nothing):
    got = mixing.mix(edge).collect()
    assert len(got) == len(ROWS) and all(r.taken <= 2 * r.size for r in got)
    assert mixing.mix(nothing).count() == 0 and mixing.mixed(nothing).count() == 0
    assert mixing.mixed(edge).columns == edge.columns


# Tokens

@pytest.fixture(scope="module")
def codec():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return (bpe.ByteBPE(open(RANKS, "rb").read(), public_tokenizers.PATTERN),
            tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["a", "th", "ing", " ", "  ", "\n", "\t", "'s", "'re", "'", "1", "é", "漢", "!", "　", "\x85", "😀", "x" * 9]),
                max_size=120), st.sampled_from([8, 40, 1 << 14]))
def test_tokens_equal_the_library(codec, parts, leaf):
    own, library = codec
    text = "".join(parts)
    bpe.LEAF_CHARS, before = leaf, bpe.LEAF_CHARS
    try:
        ids = own.encode(text)
    finally:
        bpe.LEAF_CHARS = before
    assert ids == library.encode_ordinary(text) and own.decode(ids) == text.encode()


def test_token_edges(edge, nothing, codec):
    got = bpe.digests(edge, RANKS, public_tokenizers.PATTERN).collect()
    want = []
    for doc, text in PAIRS:
        ids = codec[1].encode_ordinary(text or "")
        want.append((doc, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert ordered(map(tuple, got)) == ordered(want)
    assert bpe.digests(nothing, RANKS, public_tokenizers.PATTERN).count() == 0


# Similar documents

def crowd():
    rnd = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    base, passage, short = ([rnd.choice(vocabulary) for _ in range(n)] for n in (300, 60, 14))
    rows = []
    for i in range(150):
        copy = list(base)
        for _ in range(rnd.randint(0, 14)):
            copy[rnd.randrange(300)] = rnd.choice(vocabulary)
        rows.append((i, " ".join(copy)))
    rows += [(i, " ".join([rnd.choice(vocabulary) for _ in range(rnd.randint(5, 120))] + passage)) for i in range(150, 220)]
    for i in range(220, 280):
        copy = list(short)
        copy[rnd.choice([0, 1, 12, 13])] = rnd.choice(vocabulary)
        rows.append((i, " ".join(copy[:rnd.randint(10, 14)])))
    return rows + [(i, rnd.choice(["", " ", "a b", "A b", "one", "ONE", "x y z"])) for i in range(280, 300)]


@pytest.mark.parametrize("light", [32, 4])
def test_groups_of_near_copies(spark, monkeypatch, light):
    monkeypatch.setattr(ngrams, "LIGHT", light)
    monkeypatch.setattr(ngrams, "CHUNK", 40)
    rows = crowd()
    got = ngrams.similar_groups(spark.createDataFrame(rows, "doc_id long, text string"))
    assert listed(got, "doc_id", "n_shingles", "component_id") == ordered(brute.groups(rows))


def test_group_edges(edge, nothing):
    got = listed(ngrams.similar_groups(edge), "doc_id", "n_shingles", "component_id")
    assert got == ordered(brute.groups(PAIRS))
    assert ngrams.similar_groups(nothing).count() == 0
    left = ngrams.one_of_each(edge)
    assert left.columns == edge.columns and left.count() == len(ROWS) - 2


def test_components(spark):
    rnd = random.Random(2)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(rnd.randint(200, 260), rnd.randint(200, 260)) for _ in range(40)]
    up = {}
    find = lambda x: x if up.get(x, x) == x else find(up[x])
    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}


# Licenses

def test_license_scan(spark, edge, nothing):
    apache, mit = licenses.TEMPLATES["Apache-2.0"], licenses.TEMPLATES["MIT"]
    rows = [(1, "lorem ipsum " * 400 + mit.replace("copy", "xx") + " dolor" * 900), (2, apache), (3, "Licensed under CC BY-NC 4.0."), (4, "permission " * 50),
            (5, "the license of a thing under no version"), (6, None)]
    got = {r.doc_id: r for r in licenses.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].license == "MIT" and 0.9 < got[1].coverage < 1 and got[1].first_word == 800
    assert got[2].license == "Apache-2.0" and got[2].coverage == 1.0 and "Apache-2.0 notice" in got[2].licenses
    assert got[3].license == "CC-BY-NC-4.0 notice"
    assert got[4].license is got[5].license is got[6].license is None
    assert licenses.license_scan(edge).where("license is not null").count() == 0 and licenses.license_scan(nothing).count() == 0


@pytest.mark.parametrize("name", sorted(licenses.TEMPLATES))
@pytest.mark.parametrize("times", [2, 3])
@pytest.mark.parametrize("between", ["", " code of the software and its license, version 1, under the terms " * 40])
def test_a_license_that_stands_several_times(name, times, between):
    text = licenses.TEMPLATES[name]
    scanner = licenses.Scanner(licenses.TEMPLATES, 0.8)
    size = len(scanner.templates[name])
    found = {f[0]: f[1:] for f in scanner.scan("start " + between.join([f" {text} "] * times))[1]}
    assert found[name][0] == 1.0 and found[name][3] - found[name][2] == size - 1
    # Every eighth word of each copy is another one.
    altered = [" ".join("other" if i % 8 == 3 else w for i, w in enumerate(scanner.templates[name])) for _ in range(times)]
    found = {f[0]: f[1:] for f in scanner.scan("start " + f" {between} ".join(altered))[1]}
    kept = sum(i % 8 != 3 for i in range(size))
    assert size < 20 or found[name][1] >= kept


@given(st.lists(st.integers(0, 30), max_size=9, unique=True))
def test_increasing_is_longest(places):
    line = [places[i] for i in licenses.increasing(places)]
    best = max((bin(m).count("1") for m in range(1 << len(places))
                if (s := [p for i, p in enumerate(places) if m >> i & 1]) == sorted(s)), default=0)
    assert line == sorted(line) and len(line) == best


@given(st.lists(st.sampled_from("abcdef"), max_size=12), st.lists(st.sampled_from("abcdefg"), max_size=12))
def test_alignment_is_consistent(template, text):
    pairs = licenses.align(template, text)
    assert all(template[i] == text[j] for i, j in pairs)
    assert all(a[0] < b[0] and a[1] < b[1] for a, b in zip(pairs, pairs[1:]))


# Repeats

@settings(max_examples=300)
@given(st.lists(st.integers(0, 3), max_size=40), st.integers(1, 4))
def test_suffix_array(symbols, times):
    text = symbols * times
    assert suffixes.suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


@pytest.mark.parametrize("limit", [20_000, 2])
def test_repeats(spark, small, limit):
    rows, docs = small
    got = suffixes.without_repeats(docs, limit=limit)
    assert listed(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == ordered(brute.repeats(rows))
    cut = substrings.without_repeats(docs, limit=limit)
    assert listed(cut, "doc_id", "n_words", "n_removed", "kept") == ordered(brute.substrings(rows))


def test_repeat_edges(edge, nothing):
    got = suffixes.without_repeats(edge)
    assert listed(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == ordered(brute.repeats(PAIRS))
    cut = substrings.without_repeats(edge)
    assert listed(cut, "doc_id", "n_words", "n_removed", "kept") == ordered(brute.substrings(PAIRS))
    assert suffixes.without_repeats(nothing).count() == 0 and substrings.without_repeats(nothing).count() == 0
    left = substrings.remove_substrings(edge)
    assert left.columns == edge.columns and left.where("doc_id = 9").first().text == ROWS[10][1]


def test_covered_windows():
    marks = __import__("pyarrow").array([[{"first": 1, "length": 2}]])[0]
    assert repeats.covered(marks, 8, 3).tolist() == [False, True, True, True, True, False, False, False]


# Row numbers

@pytest.fixture
def restless(spark, small, tmp_path, monkeypatch):
    """The smallest table in files whose splits differ between any two stages, as with cores that come and go."""
    path, name, before = str(tmp_path / "documents"), "spark.sql.files.maxPartitionBytes", {}
    small[1].repartition(3).write.option("parquet.block.size", 1024).option("parquet.page.size", 256).option(
        "parquet.block.size.row.check.min", 1).option("parquet.page.size.row.check.min", 1).parquet(path)
    before = {key: spark.conf.get(key) for key in (name, "spark.sql.files.openCostInBytes")}
    sizes = iter(("1k", "128m", "3k", "40k") * 100)
    stored = frames.stage_table

    def write(df, label, **settings):
        out = stored(df, label, **settings)
        spark.conf.set(name, next(sizes))
        return out

    monkeypatch.setattr(frames, "stage_table", write)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    spark.conf.set(name, "7k")
    yield spark.read.parquet(path)
    for key, value in before.items():
        spark.conf.set(key, value)


def test_rows_keep_their_numbers(restless, small):
    rows, _ = small
    got = ngrams.similar_groups(restless)
    assert listed(got, "doc_id", "n_shingles", "component_id") == ordered(brute.groups(rows))
    left = {(r.doc_id, r.text) for r in ngrams.one_of_each(restless).collect()}
    assert left == {(d, t) for (d, t) in rows if d in {d for d, _, c in brute.groups(rows) if d == c}}
    assert listed(suffixes.without_repeats(restless), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == ordered(brute.repeats(rows))
    assert listed(substrings.without_repeats(restless), "doc_id", "n_words", "n_removed", "kept") == ordered(brute.substrings(rows))
    taken = {r.doc_id: r.copies for r in mixing.mix(restless).collect()}
    assert listed(mixing.mixed(restless), "doc_id", "text") == ordered((d, t) for d, t in rows for _ in range(taken[d]))


# Fingerprints

def fingerprint(text):
    w = brute.words(text)
    terms = [w[i:i + 2] for i in range(len(w) - 1)] or ([[" ".join(w)]] if w else [])
    votes = [0] * 64
    for term in terms:
        h = 42
        for word in term:
            h = xxhash.xxh64_intdigest(word.encode(), seed=h)
        for b in range(64):
            votes[b] += 1 if h >> b & 1 else -1
    return sum(1 << b for b in range(64) if votes[b] > 0)


def test_fingerprints(small):
    rows, docs = small
    rows = sorted(rows, key=lambda r: -r[0])
    want = []
    for (doc, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        k = len(text) // 3
        altered = text[:len(text) - k] + after[:k]
        want.append((doc, len(text), hashlib.sha256(altered.encode()).hexdigest(), *(
            x - (1 << 64) if x >> 63 else x for x in map(fingerprint, (text, altered, after)))))
    assert listed(simhash.fingerprints(docs), "doc_id", "n_chars", "edited_sha256", "fp", "edited_fp", "next_fp") == ordered(want)


def test_fingerprint_edges(spark, edge, nothing):
    got = simhash.fingerprints(edge).collect()
    assert len(got) == len(ROWS) and all(r.fp == 0 for r in got if r.doc_id in (1, 2, 3))
    assert simhash.fingerprints(nothing).count() == 0
    one = simhash.fingerprints(spark.createDataFrame([(1, "only one text")], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0].next_fp == one[0].fp


def test_near_fingerprints(spark):
    rnd = random.Random(6)
    base = [rnd.getrandbits(64) for _ in range(30)]
    all_prints = {x ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 6))) for x in base for _ in range(8)}
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    frame = spark.createDataFrame([(signed(x),) for x in all_prints] * 2, "fingerprint long")
    got = {(r.query, r.fingerprint, r.distance) for r in simhash.near_pairs(frame, frame).collect()}
    assert got == {(signed(a), signed(b), (a ^ b).bit_count()) for a in all_prints for b in all_prints if (a ^ b).bit_count() <= 3}


# Shards

@pytest.mark.parametrize("dims, bits", [(2, 4), (3, 3), (4, 2)])
def test_hilbert_curve_is_continuous(dims, bits):
    cells = np.array(np.meshgrid(*[np.arange(1 << bits)] * dims)).reshape(dims, -1)
    index = sharding.hilbert_index(cells, bits)
    order = np.argsort(index)
    assert sorted(index) == list(range(1 << bits * dims))
    assert (np.abs(np.diff(cells[:, order], axis=1)).sum(axis=0) == 1).all()


def test_shards(edge, nothing, small):
    for docs in (edge, small[1]):
        got = sharding.shard_documents(docs).collect()
        by = {}
        for r in got:
            by.setdefault(r.shard, []).append(r.slot)
        assert len(got) == docs.count() and all(0 <= s < 24 for s in by)
        assert all(sorted(slots) == list(range(len(slots))) for slots in by.values())
        counts = [len(by.get(s, ())) for s in range(24)]
        assert max(counts) - min(counts) <= 1
    assert sharding.shard_documents(nothing).count() == 0


# Quality

def test_quality(edge, nothing, small):
    for docs, rows in ((edge, PAIRS), (small[1], small[0])):
        got = listed(quality.quality(docs), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
        assert got == ordered((doc, *brute.quality(text)) for doc, text in rows)
    assert quality.quality(nothing).count() == 0
    good = quality.keep_good(edge)
    assert good.columns == edge.columns and good.count() == 0
    assert LONG


def test_rules_reject_and_name(spark):
    clean = "the rain of spain falls in the plain and some of it " + " ".join(f"word{i}" for i in range(60))
    rows = [(1, clean), (2, clean.replace("word", "#### word")), (3, " ".join(f"word{i}" for i in range(80)))]
    got = {r.doc_id: r for r in quality.quality(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].kept and got[1].failed_rules == ""
    assert not got[2].kept and got[2].failed_rules == "symbols_per_word"
    assert not got[3].kept and got[3].failed_rules == "stop_words"
