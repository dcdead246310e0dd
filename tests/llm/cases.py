"""Documents with the awkward cases that every operator has to stand."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Clashing names: columns that the operators make themselves.
EXTRA = "digest string, fp long, score double, n_words long, copies int, part int, token string, row long, host string"


def prose(seed: int, words: int) -> str:
    r = random.Random(seed)
    parts = ["ti", "the", "ra", "mo", "éc", "ß", "lan", "ox", "ur", "ed"]
    return " ".join("".join(r.choices(parts, k=r.randint(1, 3))) for _ in range(words))


def awkward() -> list[tuple]:
    """Nulls, empty, blank and very long texts, equal rows, equal ids, odd characters."""
    return [
        (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \n\t ", None, None, None),
        (4, prose(1, 40), "en", "a", 1), (5, prose(1, 40), "de", "b", 1), (5, prose(1, 40), "de", "b", 1),
        (None, prose(1, 40), "en", None, 1), (None, None, None, None, None),
        (6, prose(2, 30_000), "en", "a", 1), (7, "İstanbul \x85 ñandú  \x1c ½ 漢字 🙂 <|endoftext|> don't", "es", "b", 1),
        (8, "A", "en", "a", 1), (9, "\x00\x01", "en", "a", 2), (6, prose(3, 12), "en", "a", 1),
    ]


def frame(spark: SparkSession, rows: list[tuple], extra: bool = True) -> DataFrame:
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:
        for name, kind in (x.split() for x in EXTRA.split(", ")):
            df = df.selectExpr("*", f"cast(7 as {kind}) as {name}")
    return df


def sorted_rows(df: DataFrame, *columns: str) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
