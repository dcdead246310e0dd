"""Token counts: a map-side two-tier lookup of pre-token lengths.

A text is cut into pre-tokens by the vocabulary's own pattern. The lengths (in tokens) of
frequent pre-tokens come from a table that is broadcast; it is taken from a bounded sample of
documents and only decides speed. Other pre-tokens are encoded by the library once and kept
in a bounded cache of the worker. No pre-token is ever shuffled.

The pattern here and the library's must cut alike. They classify a few code points
differently, so texts with characters outside ``SAFE`` are encoded whole by the library.
Texts with a special token's string go the same way, as that string is a token of its own.

Defined results: null and empty texts have 0 bytes and 0 tokens. Rows with the same doc_id
are counted one by one, null ids too. An empty table gives an empty result. Long texts are
never truncated. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import Sent, strings

#: The pre-token pattern of byte-level BPE vocabularies of this kind.
PRETOKEN = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Characters that both pattern engines put into the same classes.
SAFE = regex.compile(r"[\x00-\u0557\u0600-\u07FF\u0900-\u0BFF\u2000-\u208E\u20A0-\u2BFF\u3000-\u9FFF\uAC00-\uD7A3]*+")
#: Documents that the frequent table is taken from, its entries, and the entries a worker keeps.
SAMPLE_DOCS, TABLE_SIZE, CACHE_SIZE = 4096, 65_536, 500_000


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def load(path: str | None):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path or default_path())
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class Lengths(dict):
    """Tokens by pre-token: the frequent table, then what the library says, kept up to a bound."""

    def __init__(self, tokenizer, frequent: dict[str, int], size: int):
        super().__init__(frequent)
        self.tokenizer, self.frequent, self.most = tokenizer, frequent, len(frequent) + size

    def __missing__(self, pretoken: str) -> int:
        if len(self) >= self.most:
            self.clear()
            self.update(self.frequent)
        n = len(self.tokenizer.encode(pretoken, add_special_tokens=False).ids)
        if len(pretoken) <= 64:
            self[pretoken] = n
        return n


class Counting:
    """Counts the tokens of texts, each as the library would."""

    def __init__(self, path: str | None, frequent: dict[str, int], cache_size: int = CACHE_SIZE):
        self.tokenizer = load(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.lengths = Lengths(self.tokenizer, frequent, cache_size)

    def pretokens(self, text: str) -> list[str] | None:
        """None: the library has to encode the whole text."""
        if any(s in text for s in self.special) or not SAFE.fullmatch(text):
            return None
        return PRETOKEN.findall(text)

    def count(self, text: str) -> int:
        cut = self.pretokens(text)
        if cut is None:
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        return sum(map(self.lengths.__getitem__, cut))


def frequent_pretokens(docs: DataFrame, path: str | None, sample_docs: int, table_size: int) -> dict[str, int]:
    """Lengths of the commonest pre-tokens of a hashed sample of about ``sample_docs`` documents.

    Every task sends at most ``table_size`` pre-tokens of its share of the sample.
    """
    rows, steps = docs.count(), 1 << 30
    share = min(steps, steps * sample_docs // max(rows, 1))
    sample = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(steps)) < share).select("text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, seen = Counting(path, {}), Counter()
        for batch in batches:
            for text in strings(batch.column("text")):
                seen.update(counter.pretokens(text) or ())
        most = [(p, n) for p, n in seen.most_common(table_size) if len(p) <= 64]
        yield pa.RecordBatch.from_pydict({"pretoken": [p for p, _ in most], "n": pa.array([n for _, n in most], pa.int64())})

    total: Counter = Counter()
    for row in sample.mapInArrow(count, "pretoken string, n long").toLocalIterator():
        total[row.pretoken] += row.n
    counter = Counting(path, {})
    return {p: counter.count(p) for p, _ in total.most_common(table_size)}


def _counting(sent: tuple) -> Counting:
    return Counting(*sent)


def _counter(sent: Sent) -> Callable:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = sent.derive(_counting)
        for batch in batches:
            texts = strings(batch.column("text"))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"),
                "n_bytes": pa.array([len(t.encode("utf-8")) for t in texts], pa.int64()),
                "n_tokens": pa.array([counter.count(t) for t in texts], pa.int64()),
            })

    return count


def count_tokens(
    docs: DataFrame, path: str | None = None, sample_docs: int = SAMPLE_DOCS,
    table_size: int = TABLE_SIZE, cache_size: int = CACHE_SIZE,
) -> DataFrame:
    """Per document: doc_id, n_bytes, n_tokens. ``path``: a tokenizer file that workers can open."""
    docs = docs.select("doc_id", "text")
    frequent = frequent_pretokens(docs, path, sample_docs, table_size)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(_counter(Sent(docs.sparkSession, (path, frequent, cache_size))), f"doc_id {kind}, n_bytes long, n_tokens long")
