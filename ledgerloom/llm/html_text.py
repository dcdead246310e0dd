"""Main text of pages through wrappers inferred per host.

A page is a stream of tags and texts. Runs of equal consecutive groups of tokens fold into
one repeated group. Same-host streams are aligned one after the other: equal tags meet, texts
that differ become slots, tokens that only one side has become an optional group, a group met
once on one side and repeatedly on the other becomes a repeated group. The result is a
union-free regular expression, the host's wrapper. Each of its parts says whether its text
belongs to the article; a page's stream is matched against the wrapper and its texts taken
or left accordingly. Parts of a page that the wrapper doesn't know are judged on their own.

What belongs to the article: text inside ``article`` or ``main`` elements, without menus,
headers outside of them, footers, sidebars, notices, adverts, forms, comments and code. On
hosts without such elements: body text that isn't part of those, is no template text (equal
on all pages that differ otherwise) and doesn't consist of links for the most part.

A wrapper is inferred from all pages of a host. Tasks fold their pages first: pages of the same
shape become one skeleton, with counts in its parts, so that few rows per host and task are
shuffled, also of a host with a third of all pages. Equal skeletons are summed and different ones
aligned in the order of their shapes, within ``BUCKETS`` groups per host and then over these: the
result depends on the set of pages alone. All pages are then joined to their wrappers (one row
per host) and extracted.

Defined results: null and empty pages have the text "". Cut-off pages give what is there.
A null url belongs to the host "". Rows with the same page_id are extracted one by one. An
empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import html
import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import saved

#: The longest repeated group (in tokens), and the share of linked text from which a loose block counts as navigation.
GROUP, LINKED = 24, 0.5
#: Groups of a host's skeletons that are aligned by themselves first, and skeletons that a task holds.
BUCKETS, HELD = 64, 10_000

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead "
    "title tr ul".split())
RAW = frozenset("script style textarea title noscript template iframe svg math object select button head".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
OUTSIDE = frozenset("nav footer aside form menu dialog".split())
MAIN = frozenset(("article", "main"))
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner promo promotion sponsor sponsored nav navbar navigation menu "
    "footer sidebar aside cookie cookies consent notice notices notification alert popup modal overlay subscribe subscription "
    "newsletter signup login search form comment comments reply replies discussion share sharing social breadcrumb breadcrumbs "
    "related recommended widget toolbar pagination pager copyright skip masthead complementary contentinfo".split())
_TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+|[^>]*+)(?:>|\Z)", re.S)
_MARKED = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I | re.S)
_WORD = re.compile(r"[a-z]+")


@dataclass(slots=True)
class Token:
    shape: str  # "<p>", "</p>", "#" for text
    text: str = ""
    state: str = "loose"  # of a text: "main", "loose" or "out"
    linked: bool = False


@dataclass
class Part:
    """Of a wrapper: a token or a group of them, by shape."""

    shape: str
    text: str | None = None  # template text of a single token; None: a slot, or a group
    state: str = "loose"
    optional: bool = False
    repeated: bool = False
    linked: int = 0
    plain: int = 0
    seen: int = 1


@dataclass
class Element:
    """Of a page: a token, or the tokens of a folded group."""

    shape: str
    tokens: list[Token] = field(default_factory=list)
    repeated: bool = False


def tokens(page: str) -> list[Token]:
    """Tags and texts outside code, with the region that each text lies in."""
    out: list[Token] = []
    open_tags: list[tuple[str, str | None]] = []  # name, and the region it begins
    links, at = 0, 0
    regions = ["loose"]

    def text(raw: str) -> None:
        if raw and not raw.isspace():
            out.append(Token("#", html.unescape(raw), regions[-1], links > 0))
        elif raw:
            out.append(Token("#", " ", regions[-1], links > 0))

    while (m := _next(page, at)) is not None:
        text(page[at : m.start()])
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            continue
        if m["end"]:
            if any(n == name for n, _ in open_tags):
                while True:
                    n, region = open_tags.pop()
                    links -= n == "a"
                    if region:
                        regions.pop()
                    if n == name:
                        break
            out.append(Token(f"</{name}>"))
            continue
        if name in RAW and not m["rest"].rstrip().endswith("/"):
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
            at = close.end() if close else len(page)
            continue
        marks = {w for k in _MARKED.finditer(m["rest"]) for w in _WORD.findall((k[2] or k[3] or k[4] or "").lower())} if "=" in m["rest"] else set()
        region = None
        if regions[-1] != "out":
            if name in OUTSIDE or marks & MARKS or regions[-1] == "loose" and (name == "header" or "header" in marks):
                region = "out"
            elif name in MAIN:
                region = "main"
        out.append(Token(f"<{name} {' '.join(sorted(marks))}>" if marks else f"<{name}>"))
        if name not in VOID and not m["rest"].endswith("/"):
            open_tags.append((name, region))
            links += name == "a"
            if region:
                regions.append(region)
    text(page[at:])
    return out


def _next(page: str, at: int) -> re.Match | None:
    """The next tag; a "<" that begins none is text."""
    while (i := page.find("<", at)) >= 0:
        if m := _TAG.match(page, i):
            return m
        at = i + 1
    return None


def fold(stream: list[Token], longest: int = GROUP) -> list[Element]:
    """Runs of equal groups become one element; white space between tags has no shape."""
    kept = [t for t in stream if t.shape != "#" or not t.text.isspace()]
    shapes = [t.shape for t in kept]
    out: list[Element] = []
    at, n = 0, len(kept)
    while at < n:
        best = 0
        if shapes[at][0] == "<" and shapes[at][1] != "/":  # groups begin with an opening tag
            for size in range(2, min(longest, (n - at) // 2) + 1):
                if shapes[at + size] == shapes[at] and shapes[at : at + size] == shapes[at + size : at + 2 * size]:
                    best = size
                    break
        if not best:
            out.append(Element(shapes[at], [kept[at]]))
            at += 1
            continue
        unit, end = shapes[at : at + best], at + 2 * best
        while shapes[end : end + best] == unit:
            end += best
        out.append(Element("".join(unit), kept[at:end], True))
        at = end
    return out


def _part(e: Element) -> Part:
    texts = [t for t in e.tokens if t.shape == "#"]
    linked = sum(len(t.text) for t in texts if t.linked)
    state = max((t.state for t in texts), key=("out", "loose", "main").index, default="loose")
    literal = e.tokens[0].text if e.shape == "#" else None
    return Part(e.shape, literal, state, False, e.repeated, linked, sum(len(t.text) for t in texts) - linked)


def infer(streams: list[list[Token]]) -> list[Part]:
    """The wrapper of some pages of a host."""
    wrapper: list[Part] = []
    for k, stream in enumerate(streams):
        new = [_part(e) for e in fold(stream)]
        wrapper = new if not k else _merge(wrapper, new)
    return wrapper


def _merge(old: list[Part], new: list[Part]) -> list[Part]:
    """Align two sequences by a longest common subsequence of shapes; a group also meets its single tokens."""
    new = _grouped(new, {p.shape for p in old if p.repeated})
    old = _grouped(old, {p.shape for p in new if p.repeated})
    a, b = [p.shape for p in old], [p.shape for p in new]
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        row, below = table[i], table[i + 1]
        for j in range(len(b) - 1, -1, -1):
            row[j] = below[j + 1] + 1 if a[i] == b[j] else max(below[j], row[j + 1])
    out: list[Part] = []
    i = j = 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and a[i] == b[j]:
            p, q = old[i], new[j]
            p.text = p.text if p.text == q.text else None
            p.state = p.state if p.state == q.state else max(p.state, q.state, key=("out", "loose", "main").index)
            p.repeated |= q.repeated
            p.optional |= q.optional
            p.linked, p.plain, p.seen = p.linked + q.linked, p.plain + q.plain, p.seen + q.seen
            out.append(p)
            i, j = i + 1, j + 1
        elif j == len(b) or i < len(a) and table[i + 1][j] >= table[i][j + 1]:
            old[i].optional = True
            out.append(old[i])
            i += 1
        else:
            new[j].optional = True
            out.append(new[j])
            j += 1
    return out


def _grouped(parts: list[Part], groups: set[str]) -> list[Part]:
    """Single tokens that spell a group of the other side, put together."""
    if not groups:
        return parts
    out, at = [], 0
    while at < len(parts):
        for size in range(2, GROUP + 1):
            run = parts[at : at + size]
            if len(run) == size and "".join(p.shape for p in run) in groups:
                state = max((p.state for p in run if "#" in p.shape), key=("out", "loose", "main").index, default="loose")
                out.append(Part("".join(p.shape for p in run), None, state, all(p.optional for p in run), False,
                                sum(p.linked for p in run), sum(p.plain for p in run), max(p.seen for p in run)))
                at += size
                break
        else:
            out.append(parts[at])
            at += 1
    return out


def skeleton(page: str) -> list[Part]:
    """The parts of a page; digests stand for their texts, which are only compared."""
    parts = [_part(e) for e in fold(tokens(page))]
    for p in parts:
        p.text = p.text and hashlib.md5(p.text.encode("utf-8", "surrogatepass")).hexdigest()
    return parts


def add(total: list[Part], more: list[Part]) -> None:
    """Sum two sequences of the same shapes."""
    for p, q in zip(total, more):
        p.text = p.text if p.text == q.text else None
        p.state = max(p.state, q.state, key=("out", "loose", "main").index)
        p.repeated |= q.repeated
        p.optional |= q.optional
        p.linked, p.plain, p.seen = p.linked + q.linked, p.plain + q.plain, p.seen + q.seen


def aligned(skeletons: list[list[Part]]) -> list[Part]:
    """One sequence for all: equal shapes summed, different ones aligned in the order of their shapes."""
    by: dict[tuple[str, ...], list[Part]] = {}
    for parts in skeletons:
        key = tuple(p.shape for p in parts)
        if key in by:
            add(by[key], parts)
        else:
            by[key] = parts
    return functools.reduce(_merge, [by[key] for key in sorted(by)])


def written(parts: list[Part]) -> str:
    return json.dumps([[getattr(p, name) for name in Part.__dataclass_fields__] for p in parts])


def loaded(text: str) -> list[Part]:
    return [Part(*values) for values in json.loads(text)]


def packed(wrapper: list[Part]) -> str:
    """As JSON: shape, optional, repeated, and whether its text is taken."""
    has_main = any(p.state == "main" for p in wrapper)
    slots = any(p.text is None and p.seen > 1 and "#" in p.shape for p in wrapper)

    def taken(p: Part) -> bool:
        if p.state != "loose" or has_main:  # loose text counts only on pages without an article
            return p.state != "out"
        template = p.text is not None and p.seen >= 3 and slots
        return not template and p.linked <= LINKED * (p.linked + p.plain)

    return json.dumps([[p.shape, p.optional, p.repeated, taken(p)] for p in wrapper])


def extract(page: str, wrapper: list[list]) -> str:
    """The article's blocks, one per line."""
    stream = tokens(page)
    elements = fold(stream)
    has_main = any(t.state == "main" for t in stream if t.shape == "#")
    where: dict[str, list[int]] = {}
    for k, (shape, *_) in enumerate(wrapper):
        where.setdefault(shape, []).append(k)
    taken: set[int] = set()
    at = 0
    for e in elements:
        known = next((k for k in where.get(e.shape, ()) if k >= at), None)
        if known is not None:
            at = known + 1
        for t in e.tokens:
            if t.shape != "#" or t.state == "out":
                continue
            # The wrapper decides on its parts; a page with an article keeps to that.
            if t.state == "main" or not has_main and (known is None or wrapper[known][3]):
                taken.add(id(t))
    blocks, words = [], []
    for t in stream:
        if t.shape == "#":
            if id(t) in taken or t.text == " " and words:
                words.append(t.text)
        elif (name := t.shape.strip("</>").split(" ")[0]) in BLOCKS:
            blocks.append("".join(words))
            words = []
        elif name == "br":
            words.append(" ")
    blocks.append("".join(words))
    return "\n".join(b for b in (" ".join(x.split()) for x in blocks) if b)


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^/]*//([^/?#]*)", 1))


def wrappers(pages: DataFrame) -> DataFrame:
    """host, wrapper: one row per host, from all of its pages."""

    def fold_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, tuple[str, ...]], list[Part]] = {}

        def send() -> pa.RecordBatch:
            buckets = [zlib.crc32("".join(shapes).encode("utf-8", "surrogatepass")) % BUCKETS for _, shapes in held]
            out = {"host": [h for h, _ in held], "bucket": buckets, "parts": [written(x) for x in held.values()]}
            held.clear()
            return pa.RecordBatch.from_pydict({"host": pa.array(out["host"], pa.string()), "bucket": pa.array(out["bucket"], pa.int32()), "parts": pa.array(out["parts"], pa.string())})

        for batch in batches:
            for name, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                parts = skeleton(page)
                key = name, tuple(p.shape for p in parts)
                if key in held:
                    add(held[key], parts)
                else:
                    held[key] = parts
                if len(held) >= HELD:
                    yield send()
        yield send()

    def align(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"host": rows["host"].iloc[:1], "bucket": rows["bucket"].iloc[:1], "parts": [written(aligned([loaded(x) for x in rows["parts"]]))]})

    def finish(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"host": rows["host"].iloc[:1], "wrapper": [packed(aligned([loaded(x) for x in rows["parts"]]))]})

    some = pages.where("html is not null").select(host(F.col("url")).alias("host"), "html")
    skeletons = some.mapInArrow(fold_pages, "host string, bucket int, parts string")
    partial = skeletons.groupBy("host", "bucket").applyInPandas(align, "host string, bucket int, parts string")
    return partial.select("host", "parts").groupBy("host").applyInPandas(finish, "host string, wrapper string")


def extract_pages(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text."""
    kind = pages.schema["page_id"].dataType.simpleString()
    # Written first: Spark then knows their size. Few wrappers are broadcast and no page is
    # shuffled; many are joined by host, where a host with many pages can be split.
    inferred = saved(wrappers(pages), "wrappers")
    joined = pages.select("page_id", "url", "html", host(F.col("url")).alias("host")).join(inferred, "host", "left")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str | None, list] = {None: []}
        for batch in batches:
            out = []
            for page, wrapper in zip(batch.column("html").to_pylist(), batch.column("wrapper").to_pylist()):
                if wrapper not in known:
                    if len(known) > 1000:
                        known = {None: []}
                    known[wrapper] = json.loads(wrapper)
                out.append(extract(page or "", known[wrapper]))
            yield pa.RecordBatch.from_pydict({"page_id": batch.column("page_id"), "url": batch.column("url"), "text": pa.array(out, pa.string())})

    return joined.select("page_id", "url", "html", "wrapper").mapInArrow(read, f"page_id {kind}, url string, text string")
