"""BPE encoding and cross-tokenizer alignment against the libraries and plain versions."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import alignment, bpe, queries, token_counts
from tests.llm.cases import awkward, frame, prose

ODD = [
    "", " ", "a<|endoftext|>b <|endoftext|>", "  x\n\n y\t", "naïve 日本語 🙂 a͸b", "a" * 3000, "ab" * 777 + "  ", "\x00\x01",
    "don't we'll I'M", "x　y z \x85", "ⅷ²½ ١٢", "a ▁ b", "<s> <0x41> </s>", "\r\n" * 40, " " * 1500 + "x", "é" * 1200]


@pytest.fixture(scope="module")
def library():
    return token_counts.load(None)


@pytest.fixture(scope="module")
def own():
    return bpe.Encoder()


def test_ids_are_the_librarys(library, own):
    texts = ODD + [prose(k, 30) for k in range(40)]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [own.encode(t) for t in texts] == want
    assert own.encode_all(texts * 3) == want * 3
    assert [own.decode(x) for x in want] == [library.decode(x, skip_special_tokens=False) for x in want] == texts


@settings(max_examples=150, deadline=None)
@given(st.text(st.characters(codec="utf-8"), max_size=60))
def test_any_text(library, own, text):
    ids = own.encode(text)
    assert ids == library.encode(text, add_special_tokens=False).ids
    assert own.decode(ids) == text


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 50256), max_size=20))
def test_any_ids(library, own, ids):
    """Ids that split characters decode to replacement characters, as the library has it."""
    assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


@given(st.lists(st.integers(0, 5), min_size=1, max_size=20), st.lists(st.tuples(st.integers(0, 19), st.integers(0, 5)), max_size=30))
def test_root_is_the_least(values, puts):
    tree = bpe.PairTree(list(values))
    for place, value in puts:
        if place < len(values):
            values[place] = value
            tree.put(place, value)
        assert tree.tree[1] == min(values)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.text("thear ingonéß", min_size=2, max_size=16), min_size=1, max_size=20))
def test_rows_of_trees_and_single_trees_agree(own, words):
    words = [w.encode()[:16] for w in words]
    assert [np.frombuffer(x, "<i4").tolist() for x in own.merge_rows(words, 16)] == list(map(own.merge, words))


def test_a_full_table_is_emptied(library):
    small = bpe.Encoder(cache_size=50)
    texts = [prose(k, 50) for k in range(20)]
    assert small.encode_all(texts) == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [small.encode(t) for t in texts] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def write_tables(spark, path, rows):
    frame(spark, rows).repartition(3).write.parquet(f"{path}/documents.parquet")
    return str(path)


ROWS = awkward() + [(100 + i, t, "en", "a", 1) for i, t in enumerate(ODD)] + [(200 + i, prose(i % 7, 50), "en", "b", 1) for i in range(20)]


def test_bpe_query(spark, library, tmp_path):
    found = queries.op12_bpe(spark, write_tables(spark, tmp_path, ROWS))
    again = bpe.decode(bpe.encode(frame(spark, ROWS)))
    assert sorted(map(tuple, again.select("doc_id", "text").collect()), key=repr) == sorted(((r[0], r[1] or "") for r in ROWS), key=repr)
    want = []
    for doc_id, text, *_ in ROWS:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((doc_id, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(want, key=repr)


def test_empty_tables(spark, tmp_path):
    path = write_tables(spark, tmp_path, [])
    assert queries.op12_bpe(spark, path).count() == 0
    assert queries.op13_alignment(spark, path).count() == 0
    assert bpe.decode(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")).first().text == ""


def aligned_by_hand(texts):
    """Per text: A's ids, B's ids, groups, links; every pair of tokens is compared within a text."""
    from sentencepiece import SentencePieceProcessor

    a_side = token_counts.load(None)
    a_side.encode_special_tokens = True
    b_side = SentencePieceProcessor(model_file=alignment.default_piece_path())
    byte_of = {c: b for b, c in enumerate(bpe.byte_characters())}
    out = []
    for text in texts:
        a = a_side.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_side.encode(text) if text else []
        bytes_a = [bytes(byte_of[c] for c in a_side.id_to_token(i)) for i in a]
        bytes_b = [bytes.fromhex(p[3:5]) if p.startswith("<0x") and len(p) == 6 else p.replace("▁", " ").encode() for p in map(b_side.id_to_piece, b)]
        if not text or not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            out.append(([], [], "", []))
            continue
        spans = []
        for side in (bytes_a, bytes_b):
            at, own = 0, []
            for x in side:
                own.append((at, at + len(x)))
                at += len(x)
            spans.append(own)
        ends = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups = ";".join(
            "|".join(",".join(str(i) for i, (s, e) in zip(ids, own) if low <= s and e <= high) for ids, own in zip((a, b), spans))
            for low, high in zip([0, *ends], ends))
        links = [(i, j) for i, (s, e) in zip(a, spans[0]) for j, (u, v) in zip(b, spans[1]) if max(s, u) < min(e, v)]
        out.append((a, b, groups, links))
    return out


@pytest.mark.parametrize("most_pairs", [alignment.PAIRS, 40, 0])
def test_alignment_by_hand(spark, most_pairs):
    """With all pairs in the broadcast table, with some, with none."""
    rows = [r for r in ROWS if len(r[1] or "") < 5000]
    hand = aligned_by_hand([t or "" for _, t, *_ in rows])
    count = Counter(link for *_, links in hand for link in links)
    most: dict = {}
    for (_, b), n in count.items():
        most[b] = max(n, most.get(b, 0))
    want = [
        (r[0], a, b, groups.count(";") + 1 if a else 0, len(links), sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links), sha(groups) if a else "")
        for r, (a, b, groups, links) in zip(rows, hand)]
    found = alignment.align(frame(spark, rows).repartition(3), most_pairs=most_pairs).select(
        "doc_id", "ids_a", "ids_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(want, key=repr)
    assert sum(not x[1] for x in want) >= 5 and max(count.values()) > 20


def test_long_texts_and_query_columns(spark, tmp_path):
    rows = [r for r in ROWS if len(r[1] or "") >= 5000]
    found = queries.op13_alignment(spark, write_tables(spark, tmp_path, rows)).collect()
    own = alignment.Aligner()
    a, b = own.tokenise([r[1] for r in rows])
    assert sorted((r.n_a, r.n_b) for r in found) == sorted(zip(np.diff(a.ends).tolist(), np.diff(b.ends).tolist()))
    assert all(r.n_links == r.n_a + r.n_b - r.n_groups and r.n_best <= r.n_links <= r.count_sum for r in found)


def test_windows_are_relearnt_when_full(monkeypatch):
    monkeypatch.setattr(alignment, "MEMO_IDS", 60)
    own = alignment.Aligner()
    for seed in range(4):
        a, b = own.tokenise([prose(seed, 40)])
        keys, first = own.windows(a.values, b.values)
        own.learn(set(keys))
        assert ";".join(own.memo[k] for k in keys) == aligned_by_hand([prose(seed, 40)])[0][2]
        assert first[0] == 0
