"""Decontamination, token counts, licences and pages against plain versions."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import decontaminate, html_text, licenses, token_counts
from tests.llm.cases import awkward, frame, prose, sorted_rows

ITEMS = "item_id long, text string, note string"


def brute(text, items):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    hit, found = set(), set()
    for item_id, body, *_ in items:
        if item_id is None:
            continue
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), body or ""))
        size = min(13, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            for j in range(len(words) - size + 1):
                if words[j : j + size] == w[i : i + size]:
                    hit.update(range(j, j + size))
                    found.add(str(item_id))
    return len(words), len(hit), sorted(found)


@pytest.fixture(scope="module")
def contaminated_rows():
    rng = random.Random(3)
    items = [(i, prose(100 + i, n), "x") for i, n in enumerate([30, 13, 12, 3, 1, 20])] + [
        (6, None, "x"), (7, "", "x"), (None, prose(100, 30), "x"), (1, prose(101, 13), "again"), (8, prose(100, 20), "x")]
    rows = awkward()
    for k in range(30):
        words = prose(k, rng.randint(0, 60)).split()
        for _ in range(rng.randint(0, 3)):
            item = (items[rng.randrange(6)][1]).split()
            a = rng.randrange(len(item))
            words[rng.randint(0, len(words)):0] = item[a : a + rng.randint(1, 20)]
        rows.append((50 + k, rng.choice(["{}", "{}."]).format(rng.choice([" ", ", ", "\n"]).join(words).title()), "en", "a", 1))
    return rows, items


@pytest.mark.parametrize("max_chars", [decontaminate.MAX_CHARS, 60])
def test_hits_by_brute_force(spark, contaminated_rows, max_chars):
    """In one automaton and in several parts."""
    rows, items = contaminated_rows
    docs, bench = frame(spark, rows), spark.createDataFrame(items, ITEMS)
    found = decontaminate.scan(docs, bench, max_chars=max_chars).collect()
    want = sorted(((d, *brute(t, items)) for d, t, *_ in rows), key=repr)
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in found), key=repr) == want
    assert any(w[2] for w in want)
    kept = decontaminate.clean(docs, bench, max_chars=max_chars)
    assert kept.columns == docs.columns
    assert kept.count() == sum(not (h > 0 and 20 * h >= n) for _, n, h, _ in want)


def test_spans_point_into_the_original(spark):
    text = "Über ALLES: one, Two -- THREE four. Five"
    found = decontaminate.find(text, decontaminate.automaton([("1", "two three"), ("2", "three FOUR"), ("3", "no")]))
    assert found[0] == 7 and found[1] == ["1", "2"]
    assert [text[s["begin"] : s["end"]] for s in found[3]] == ["Two -- THREE four"]


def test_empty_documents_and_benchmark(spark):
    docs, none = frame(spark, awkward()), spark.createDataFrame([], ITEMS)
    assert decontaminate.scan(docs, none).where("n_hit > 0").count() == 0
    assert decontaminate.scan(frame(spark, []), none).count() == 0
    assert decontaminate.clean(docs, none).count() == len(awkward())


def test_token_counts_are_the_library_s(spark):
    rows = awkward() + [(100 + i, prose(i, 200), "en", "a", 1) for i in range(20)]
    found = token_counts.count_tokens(frame(spark, rows), table_size=50, cache_size=20)
    tokenizer = token_counts.load(None)
    want = [(d, len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for d, t, *_ in rows]
    assert sorted_rows(found, "doc_id", "n_bytes", "n_tokens") == sorted(want, key=repr)
    assert token_counts.count_tokens(frame(spark, [])).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=60) | st.text(alphabet=" \n\t'sdIvre1é.漢½", max_size=60))
def test_any_text_counts_like_the_library(text):
    counting = token_counts.Counting(None, {})
    assert counting.count(text) == len(counting.tokenizer.encode(text, add_special_tokens=False).ids)


def test_licences_survive_layout_and_spelling(spark):
    name, body = licenses.LICENSES[2]
    changed = "Copyright (c) 2020 Somebody\n\n" + body.replace(" ", "\n   ").replace("sublicense", "sub-license").upper() + "\nAll rights reserved."
    rows = awkward() + [
        (100, body, "en", "a", 1), (101, changed, "en", "a", 1), (102, body + " and more", "en", "a", 1),
        (103, "Some prose.\n * Released under the MIT Licence! *\nLicensed under CC BY-NC 4.0.\nmore", "en", "a", 1),
        (104, "We released it under the MIT License.", "en", "a", 1), (105, "Copyright 2020 X", "en", "a", 1)]
    found = {r.doc_id: r for r in licenses.scan(frame(spark, rows)).collect() if r.doc_id and r.doc_id >= 100}
    assert found[100].license_id == found[101].license_id == name
    assert found[100].digest == found[101].digest
    assert found[102].license_id is None and found[104].license_id is None and found[104].notices == []
    assert found[103].notices == ["CC-BY-NC-4.0", "MIT"]
    assert found[105].digest == hashlib.sha256(b"").hexdigest()
    assert licenses.scan(frame(spark, rows)).count() == len(rows)
    assert licenses.scan(frame(spark, [])).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T {n}</title><style>p{{}}</style></head><body><nav><ul>{menu}</ul></nav>
<div class="cookie-notice">We use cookies</div><aside>side</aside>
<article><header><h1>Title {n} &amp; more</h1></header>{body}<div class="ad">Buy {n}</div>
<script>var a = "</p><p>no</p>";</script><form><p>mail</p></form><section id="comments"><p>nice {n}</p></section></article>
<footer>&copy; site</footer></body></html>"""


def page(n: int, paragraphs: int, extra: str = "") -> tuple[str, str]:
    items = "".join(f'<li><a href="/{k}">m{k}</a></li>' for k in range(n % 4 + 1))
    body = "".join(f"<p>Text {n}\n  <b>part</b>{k}<br>x &lt; y</p>" for k in range(paragraphs)) + extra
    text = "\n".join([f"Title {n} & more"] + [f"Text {n} part{k} x < y" for k in range(paragraphs)])
    return PAGE.format(n=n, menu=items, body=body), text


def test_article_text_of_a_host(spark):
    made = [page(n, n % 5 + 1) for n in range(30)]
    rows = [(n, f"https://a.example.com/{n}", h) for n, (h, _) in enumerate(made)]
    want = {n: t for n, (_, t) in enumerate(made)}
    cut, text = page(40, 3)
    rows += [(100, None, None), (101, "not a url", ""), (102, "http://b.example.com/", cut[: cut.index("x &lt; y")] + "end &am"),
             (103, "http://b.example.com/x", "plain < text & more"), (0, "https://a.example.com/0", made[0][0])]
    want |= {100: "", 101: "", 102: "Title 40 & more\nText 40 part0 end &am", 103: "plain < text & more"}
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as host", "2 as text", "3 as wrapper")
    found = html_text.extract_pages(pages).collect()
    assert len(found) == len(rows)
    assert {r.page_id: r.text for r in found} == want
    assert html_text.extract_pages(pages.limit(0)).count() == 0


def test_hosts_without_articles_lose_template_text_and_link_lists(spark):
    body = '<html><body><div>Our site since 1990</div><div>{links}</div><div><p>Story {n} here.</p><p>And {n}.</p></div></body></html>'
    rows = [(n, "http://c.example.com/", body.format(n=n, links=f'<a href="/{n}">go {n}</a>')) for n in range(6)]
    found = html_text.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert {r.page_id: r.text for r in found.collect()} == {n: f"Story {n} here.\nAnd {n}." for n in range(6)}


def test_wrapper_has_slots_options_and_repetitions():
    one = html_text.tokens("<div><h1>A</h1><p>x</p><p>y</p><p>z</p><b>same</b></div>")
    two = html_text.tokens("<div><h1>B</h1><i>new</i><p>w</p><b>same</b></div>")
    parts = {p.shape: p for p in html_text.infer([one, two])}
    assert parts["<p>#</p>"].repeated and not parts["<p>#</p>"].optional
    assert parts["<i>"].optional and not parts["<h1>"].optional
    texts = [p.text for p in html_text.infer([one, two]) if p.shape == "#"]
    assert texts == [None, "new", "same"]


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="<>/abp =\"'!-&;#x\n", max_size=80))
def test_any_markup_is_read(page):
    text = html_text.extract(page, [])
    assert text == "\n".join(x for x in text.split("\n") if x.strip())


def test_wrappers_learn_from_every_page_of_a_host(spark, monkeypatch):
    """A text is template only if no page at all has another one in its place, however many share it."""
    def page(k: int, note: str) -> str:
        return f"<html><body><div>{note}</div><p>text {k}</p></body></html>"

    pages = [(k, "http://a.org/x", page(k, "same" if k < 40 else "other")) for k in range(41)]
    pages += [(100 + k, "http://b.org/x", page(k, "same")) for k in range(41)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in html_text.extract_pages(frame.repartition(5)).collect()}
    assert all(found[k] == f"{'same' if k < 40 else 'other'}\ntext {k}" for k in range(41))
    assert all(found[100 + k] == f"text {k}" for k in range(41))
    one = {r.host: r.wrapper for r in html_text.wrappers(frame.repartition(5)).collect()}
    monkeypatch.setattr(html_text, "HELD", 1)
    assert {r.host: r.wrapper for r in html_text.wrappers(frame.coalesce(1)).collect()} == one
