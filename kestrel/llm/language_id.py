"""Hierarchical language identification (operator 2).

A text's features are hashed counts of its lower-cased byte 1-, 2- and
3-grams, square-rooted and scaled to length 1. Discrimination is
hierarchical: one-versus-one linear support vector machines over language
families decide the family, then one-versus-one machines among the languages
of that family decide the language.

Training rows are those with a language, an id and text whose
crc32(doc_id) mod 4 is not 2; the others are held out. The machines are
fitted on a bounded sample of them (``SAMPLE`` rows a language and about
``SAMPLE_ROWS`` in all, chosen by the hash of doc_id); everything else covers
all rows. The machines, one for each pair of families and for each pair of
languages in a family, go to every task: more than ``MACHINES`` (16 KB each)
raise. Prediction is a projection
without a shuffle and never sees lang, source or doc_id.

Defined results
    null text, no letter  ``und``, score 0
    very long text        read whole, in pieces of ``PIECE`` bytes
    null doc_id           predicted, not held out, not learned from
    ties                  the language first in order
    repeated rows         each row is predicted alone
    no training rows      every row is ``und`` with score 0
    one language          that language
    labels for more than ``MACHINES`` pairs   ``ValueError``
    empty table           empty result
    extra columns         ignored
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass, field
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.textcols import small_batches

SAMPLE = 400
SAMPLE_ROWS = 16384
MACHINES = 4096
WIDTH = 4096
PIECE = 1 << 20
FOLDS, HELD_OUT = 4, 2
HASH_RANGE = 1 << 30
RESULT = "doc_id long, held_out boolean, lang_pred string, score double, family string"

# Families of language codes. Other codes share the family "other".
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "yi"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "sr", "hr", "sl", "mk"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz"),
    "semitic": ("ar", "he", "mt"),
    "indo-aryan": ("hi", "bn", "ur", "mr", "gu", "pa"),
}


def family_of(lang: str, families: Mapping[str, tuple[str, ...]] = FAMILIES) -> str:
    return next((f for f, members in families.items() if lang in members), "other")


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def features(text: bytes) -> np.ndarray:
    """Unit vector of square-rooted hashed n-gram counts."""
    counts = np.zeros(WIDTH)
    for at in range(0, len(text), PIECE):
        b = np.frombuffer(text, np.uint8, min(PIECE + 2, len(text) - at), at).astype(np.uint32)
        for n in (1, 2, 3):
            # Starts in this piece only: the two bytes beyond belong to the next.
            starts = min(PIECE, len(b) - n + 1)
            if starts <= 0:
                continue
            gram = np.full(starts, n, np.uint32)
            for k in range(n):
                gram = (gram * np.uint32(0x01000193)) ^ b[k:k + starts]
            gram = (gram * np.uint32(0x9E3779B1)) >> np.uint32(32 - WIDTH.bit_length() + 1)
            counts += np.bincount(gram, minlength=WIDTH)
    root = np.sqrt(counts)
    return (root / (np.linalg.norm(root) or 1.0)).astype(np.float32)


def _lowered(column: pa.Array) -> Iterator[bytes]:
    for text in pc.utf8_lower(column):
        yield text.as_buffer().to_pybytes() if text.is_valid else b""


def train_svm(x: np.ndarray, y: np.ndarray, cost: float = 10.0, rounds: int = 30) -> np.ndarray:
    """Linear support vector machine by dual coordinate descent with squared
    hinge loss; the last weight is the bias."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    w, alpha = np.zeros(x.shape[1]), np.zeros(len(x))
    norm = (x * x).sum(axis=1) + 0.5 / cost
    order = np.random.default_rng(0)
    for _ in range(rounds):
        for i in order.permutation(len(x)):
            step = y[i] * (x[i] @ w) - 1 + alpha[i] * 0.5 / cost
            new = max(alpha[i] - step / norm[i], 0.0)
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                alpha[i] = new
    return w.astype(np.float32)


@dataclass
class OneVersusOne:
    """Linear machines for every pair of classes; votes decide, then margins."""
    classes: list[str]
    weights: np.ndarray = field(default=None)

    @classmethod
    def fit(cls, x: np.ndarray, labels: list[str]) -> OneVersusOne:
        classes = sorted(set(labels))
        at = np.asarray([classes.index(c) for c in labels])
        rows = []
        for a, b in combinations(range(len(classes)), 2):
            use = (at == a) | (at == b)
            rows.append(train_svm(x[use], np.where(at[use] == a, 1.0, -1.0)))
        return cls(classes, np.asarray(rows, np.float32).reshape(len(rows), x.shape[1] + 1))

    def predict(self, x: np.ndarray) -> tuple[str, float]:
        """The class and the logistic of its narrowest margin."""
        if len(self.classes) == 1:
            return self.classes[0], 1.0
        margins = self.weights[:, :-1] @ x + self.weights[:, -1]
        votes, sums, narrowest = (np.zeros(len(self.classes)) for _ in range(3))
        narrowest += np.inf
        for margin, (a, b) in zip(margins.tolist(), combinations(range(len(self.classes)), 2)):
            votes[a if margin >= 0 else b] += 1
            for c, m in ((a, margin), (b, -margin)):
                sums[c] += m
                narrowest[c] = min(narrowest[c], m)
        best = max(range(len(self.classes)), key=lambda c: (votes[c], sums[c], -c))
        return self.classes[best], float(1.0 / (1.0 + np.exp(-4.0 * narrowest[best])))


@dataclass
class Model:
    """Family machines and, for each family, its language machines."""
    families: OneVersusOne | None
    languages: dict[str, OneVersusOne]

    def predict(self, x: np.ndarray) -> tuple[str, float, str | None]:
        if self.families is None:
            return "und", 0.0, None
        family, sure = self.families.predict(x)
        lang, surely = self.languages[family].predict(x)
        return lang, sure * surely, family


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [features(t).tobytes() for t in _lowered(batch.column("text"))]
        yield pa.RecordBatch.from_pydict({"lang": batch.column("lang"), "at": batch.column("at"),
                                          "x": pa.array(rows, pa.binary())})


def machines_of(langs: Iterable[str]) -> int:
    """Pairs of families and pairs of languages within a family."""
    members = Counter(map(family_of, langs))
    return comb(len(members), 2) + sum(comb(k, 2) for k in members.values())


def train(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` rows a language, fewer where many languages
    would bring more than ``SAMPLE_ROWS`` together (16 at least). The sample's rates come from
    counts over all training rows; what reaches the driver is one row per
    language and ``WIDTH`` floats per sampled row."""
    labelled = docs.select(
        F.col("text").alias("text"), F.col("lang").alias("lang"), fold(F.col("doc_id")).alias("fold"),
        F.pmod(F.xxhash64("doc_id"), F.lit(HASH_RANGE)).alias("at")).filter(
        (F.col("fold") != HELD_OUT) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    # One label more than there may be machines is enough to raise.
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().limit(MACHINES + 2).collect()}
    if not counts:
        return Model(None, {})
    if machines_of(counts) > MACHINES:
        raise ValueError(f"{len(counts)} languages need {machines_of(counts)} machines, more than {MACHINES}")
    sample = min(sample, max(16, SAMPLE_ROWS // len(counts)))
    chosen = None
    for lang, n in sorted(counts.items()):
        test = (F.col("lang") == lang) & (F.col("at") < int(HASH_RANGE * min(1.0, 1.25 * sample / n)))
        chosen = test if chosen is None else chosen | test
    rows = labelled.filter(chosen).select("text", "lang", "at").mapInArrow(
        _featured, "lang string, at long, x binary").collect()
    rows.sort(key=lambda r: (r["lang"], r["at"], r["x"]))
    by_lang: dict[str, list[np.ndarray]] = {}
    for r in rows:
        own = by_lang.setdefault(r["lang"], [])
        if len(own) < sample:
            own.append(np.frombuffer(r["x"], np.float32))
    langs = [lang for lang, own in by_lang.items() for _ in own]
    x = np.asarray([v for own in by_lang.values() for v in own])
    families = [family_of(lang) for lang in langs]
    pick = lambda f: np.asarray([k for k, g in enumerate(families) if g == f])
    return Model(OneVersusOne.fit(x, families),
                 {f: OneVersusOne.fit(x[pick(f)], [langs[k] for k in pick(f)]) for f in sorted(set(families))})


def _predict(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [model.predict(features(t)) if letter else ("und", 0.0, None)
                   for t, letter in zip(_lowered(batch.column("text")), batch.column("letter").to_pylist())]
            lang, score, family = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"),
                "lang_pred": pa.array(lang, pa.string()), "score": pa.array(score, pa.float64()),
                "family": pa.array(family, pa.string())})
    return run


def predict(docs: DataFrame, model: Model) -> DataFrame:
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"),
        F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out"),
        F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letter"))
    return rows.mapInArrow(_predict(model), RESULT)


def identify(docs: DataFrame) -> DataFrame:
    """Train on the training folds and predict every document."""
    small_batches(docs.sparkSession)
    return predict(docs, train(docs))
