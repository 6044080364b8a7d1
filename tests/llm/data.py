"""Small documents with the cases every operator must handle."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = ["ka", "lo", "mi", "ter", "an", "sou", "re", "vin", "del", "os"]


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 3))) for _ in range(n)]


def prose(rng: random.Random, n: int) -> str:
    out = words(rng, n)
    stops = ["the", "and", "of", "to"]
    return " ".join(rng.choice(stops) if k % 4 == 0 else w for k, w in enumerate(out))


def rows(seed: int = 5) -> list[tuple]:
    rng = random.Random(seed)
    base = [prose(rng, 120) for _ in range(6)]
    near = base[0].split(" ")
    near[60] = "changed"
    passage = prose(rng, 110)
    texts = [
        *base, base[0], base[0], " ".join(near), base[1].upper(), "", None, "   \t\n ", "one", "one two", "one two",
        passage + "\n" + prose(rng, 40), prose(rng, 30) + "\n" + passage, prose(rng, 9000),
        "Licensed under CC BY-NC 4.0.\nAll rights reserved.", "日本語 テキスト é ß", "a" * 5000, "-" * 900 + "\n" + "ab" * 700,
        "\n".join([prose(rng, 12)] * 4), "#$% &|< > * # $ %" * 20,
    ]
    langs = ["en", "fr", None, "de"]
    sources = ["s0", "s0", "s0", "s1", None, "é"]
    out = [(i, t, langs[i % 4], sources[i % 6], None if t is None else len(t)) for i, t in enumerate(texts)]
    return out


def documents(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA)


def clashing(df):
    """The documents with columns named like the operators' helpers."""
    names = ["_words", "size", "sig", "registers", "tid", "runs", "h1", "h2", "row", "_quality", "_lines", "no", "line", "copies",
             "whole", "rest", "block", "component", "kept", "bucket", "group", "s", "gone", "x", "letter", "fold", "at", "_kept"]
    for k, name in enumerate(names):
        df = df.selectExpr("*", f"'{k}' as `{name}`")
    return df
