"""Cross-tokenizer alignment against a plain version."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from corpus_rows import ROWS
from ledgerlens.llm import crosstokens

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
PATTERN = public_tokenizers.PATTERN
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
ODD = ["tab\tand\nlines  two", "\u2581 marked", "<|endoftext|> <s> <unk> <0x41>", "a\x00b", "\ufb01ne \u2460", "\u6f22\u5b57\u304b\u306a", "  ", " lead", "e\u0301",
       "\U0001f600\U0001f3fd x"]


@pytest.fixture(scope="module")
def tools():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    symbols = crosstokens.byte_of_symbol()
    bytes_a = lambda i: bytes(symbols[c] for c in a.id_to_token(i))
    bytes_b = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("\u2581", " ").encode()
    return a, b, bytes_a, bytes_b


def plain_groups(text, tools):
    """Groups of ids by byte offsets, or None where a side spells something else."""
    a, b, bytes_a, bytes_b = tools
    if not text:
        return None
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    want = (" " + text).encode()
    if b"".join(map(bytes_a, ids_a)) != want or b"".join(map(bytes_b, ids_b)) != want:
        return None
    groups, left, right, i, j = [], [], [], 0, 0
    at_a = at_b = 0
    while i < len(ids_a) or j < len(ids_b):
        if at_a <= at_b and i < len(ids_a):
            left.append(ids_a[i])
            at_a += len(bytes_a(ids_a[i]))
            i += 1
        else:
            right.append(ids_b[j])
            at_b += len(bytes_b(ids_b[j]))
            j += 1
        if at_a == at_b:
            groups.append((left, right))
            left, right = [], []
    return groups


def wanted(rows, tools):
    grouped = [plain_groups(text, tools) for _, text in rows]
    links = [Counter((x, y) for left, right in g or () for x in left for y in right) for g in grouped]
    docs = Counter(pair for found in links for pair in found)
    best = defaultdict(int)
    for (x, _), n in docs.items():
        best[x] = max(best[x], n)
    out = []
    for (doc, _), g, found in zip(rows, grouped, links):
        if g is None:
            out.append((doc, 0, 0, 0, 0, 0, 0, ""))
            continue
        said = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in g)
        out.append((doc, sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(found.values()),
                    sum(n for p, n in found.items() if docs[p] == best[p[0]]), sum(n * docs[p] for p, n in found.items()),
                    hashlib.sha256(said.encode()).hexdigest()))
    return sorted(out, key=repr)


def listed(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_cross_alignment(spark, edge, nothing, small, tools):
    odd = [(i, text) for i, text in enumerate(ODD * 2)]
    for docs, rows in ((edge, [(r[0], r[1]) for r in ROWS]), (small[1], small[0]),
                       (spark.createDataFrame(odd, "doc_id long, text string"), odd)):
        got = crosstokens.cross_alignment(docs, A, B, PATTERN)
        assert got.columns == list(COLUMNS) and listed(got) == wanted(rows, tools)
    assert crosstokens.cross_alignment(nothing, A, B, PATTERN).count() == 0


def test_usual_pairs_take_the_merge_join(spark, small, tools, monkeypatch):
    from ledgerlens.llm import spread
    for share in (1, 1 << 40):  # all pairs usual, all pairs hot
        monkeypatch.setattr(spread, "HOT_KEYS", share)
        assert listed(crosstokens.cross_alignment(small[1].limit(20), A, B, PATTERN)) == wanted(
            [tuple(r) for r in small[1].limit(20).select("doc_id", "text").collect()], tools)


@pytest.fixture(scope="module")
def both():
    return crosstokens.Alignment(crosstokens.byte_level_side(open(A, "rb").read(), PATTERN), crosstokens.piece_side(open(B, "rb").read()), memo=50)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab cdE\n\t.,'1\u00e9\u6f22\U0001f600"), max_size=80))
def test_windows_give_the_groups_of_whole_texts(both, tools, text):
    groups = plain_groups(text, tools)
    n_a, n_b, n_groups, n_links, digest, pairs, times = both.align(text)
    if groups is None:
        assert (n_a, digest, len(pairs), len(times)) == (0, "", 0, 0)
        return
    said = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
    assert (n_groups, digest) == (len(groups), hashlib.sha256(said.encode()).hexdigest())
    assert n_links == sum(times) == sum(len(x) * len(y) for x, y in groups)


def test_anchors_cut_into_words(both):
    a, b = ((side.ids("some words in a line of text")) for side in (both.a, both.b))
    assert len(list(both.windows(a, b))) == 7


def test_ranks_give_the_ids_of_the_file(both, tools):
    """Every code point, next to letters, digits, spaces and itself."""
    for start in range(0, 0x110000, 64):
        if not 0xD800 <= start < 0xE000:
            text = "".join(f"a{c}b {c}{c}1{c} ." for c in map(chr, range(start, start + 64)))
            assert both.a.ids(text).tolist() == tools[0].encode(" " + text, add_special_tokens=False).ids


def test_other_vocabulary_files_go_through_their_library(tools):
    import json
    content = json.loads(open(A, encoding="utf-8").read())
    assert crosstokens._ranks(content, crosstokens.byte_of_symbol()) is not None
    content["normalizer"] = {"type": "Lowercase"}
    side = crosstokens.byte_level_side(json.dumps(content).encode(), PATTERN)
    assert side.ids("A Text").tolist() == tools[0].encode(" a text", add_special_tokens=False).ids
    assert crosstokens.Alignment(side, side).align("A Text")[0] == 0  # other bytes than the text's


def listed_values(found):
    return [x.tolist() if hasattr(x, "tolist") else x for x in found]


def test_remembered_words_are_not_tokenised_again(tools):
    both = crosstokens.Alignment(crosstokens.byte_level_side(open(A, "rb").read(), PATTERN), crosstokens.piece_side(open(B, "rb").read()))
    given = []
    for side in (both.a, both.b):
        assert side.cuts
        side.ids = lambda text, ids=side.ids: given.append(text) or ids(text)
    first = both.align("some words in some lines")
    assert given == ["some words in lines"] * 2
    assert listed_values(both.align("some words in some lines")) == listed_values(first)
    both.align("lines in  some new words")
    assert given[2:] == ["in  some new"] * 2


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab cd\n\t.'1\u3000\x1c\u00a0\u2581\u00e9\u6f22\U0001f600 "), max_size=40), min_size=1, max_size=3))
def test_words_give_what_whole_texts_give(both, texts):
    whole = crosstokens.Alignment(both.a, both.b)
    whole.stretches = lambda text: [whole.stretch(text)]
    for text in texts:
        assert " ".join(crosstokens.spelled_words(text)) == text
        assert listed_values(both.align(text)) == listed_values(whole.align(text))


def test_pieces_over_word_ends_are_not_cut():
    model = open(B, "rb").read()
    assert crosstokens._merges_inside_words(model, ["\u2581\u2581", "\u2581a"]) and not crosstokens._merges_inside_words(model, ["a\u2581"])
