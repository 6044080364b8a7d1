"""Quality rules (operator 10): a threshold table compiled into one
projection of length, symbol, stop-word and line ratios.

Everything is a column expression of the document's own row: no shuffle, no
user function, no state outside the row, so skewed sources and copies cost
nothing extra and a lost task is simply run again.

Defined results
    null language         judged by every rule
    language without a stop-word list
                          not judged by the stop-word rule
    null or empty text    no words, every count 0, fails the length rule
    very long text        one row; windows are compared through a sorted array
                          of their 64-bit hashes, n log n in the row's words
    repeated rows, ties   each row is judged alone
    empty table           empty result
    extra columns         kept untouched by ``filter_documents``
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.textcols import WHITE_SPACE, let, text_or_empty, words

# The symbols counted.
SYMBOLS = "#*$%&|<>"
# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the", "and", "of", "to", "a", "in", "is", "that", "it", "for", "was", "on", "with", "as", "be", "are", "by",
    "this", "at", "from", "or", "an", "have", "not",
    "der", "die", "und", "den", "von", "das", "zu", "sich", "mit", "für", "auf", "des", "ist", "im", "eine", "dem",
    "nicht", "ein", "als",
    "de", "la", "le", "et", "les", "en", "un", "du", "une", "que", "pour", "est", "dans", "qui", "par", "au", "sur",
    "pas", "avec",
    "el", "y", "los", "las", "se", "del", "por", "con", "para", "una", "no", "su", "al", "es", "lo",
)
# The languages that the list covers.
STOP_WORD_LANGS = ("en", "de", "fr", "es")


def written_forms(stop_words: Sequence[str]) -> list[str]:
    """Lower-case, capitalised and in capitals."""
    return sorted({f for w in stop_words for f in (w, w[:1].upper() + w[1:], w.upper())})


@dataclass(frozen=True)
class Rule:
    """Keep a document while ``low <= metric <= high`` (None: no bound). With
    ``langs`` only documents of these languages, and those that state none, are
    judged; others pass."""
    metric: str
    low: float | None = None
    high: float | None = None
    langs: tuple[str, ...] | None = None


RULES: tuple[Rule, ...] = (
    Rule("n_words", low=50),
    Rule("mean_word_chars", low=2.0, high=15.0),
    Rule("symbol_ratio", high=0.1),
    Rule("stop_word_ratio", low=0.02, langs=STOP_WORD_LANGS),
    Rule("dup_line_ratio", high=0.6),
    Rule("repeat_word_ratio", high=0.5),
)


def _repeat_words(windows: Column) -> Column:
    """Word positions covered by a window that occurs twice or more.

    ``windows[i]`` is the hash of the window starting at word i; the last two
    entries are shorter windows, which equal no other entry."""
    def covered(pairs: Column) -> Column:
        same = lambda k, at: F.get(pairs, k)["h"] == at["h"]
        starts = F.filter(pairs, lambda p, k: F.coalesce(same(k - 1, p), F.lit(False))
                          | F.coalesce(same(k + 1, p), F.lit(False)))
        in_order = F.sort_array(F.transform(starts, lambda p: p["i"]))
        step = F.aggregate(
            in_order, F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
            lambda a, i: F.struct((a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"), i.alias("last")))
        return step["n"]

    indexed = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(
        let(F.sort_array(indexed), covered)).cast("long")


def with_metrics(df: DataFrame, text_col: str = "text", stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """Add a struct column ``_quality`` with every metric of the text."""
    listed = written_forms(stop_words)
    text = text_or_empty(F.col(text_col))
    removed = lambda chars: F.length(F.translate(text, chars, ""))
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(WHITE_SPACE)) != "")
    staged = df.withColumns({"_words": words(text), "_lines": lines})
    staged = staged.withColumn("_windows", F.transform(
        "_words", lambda w, i: F.xxhash64(w, F.get(F.col("_words"), i + 1), F.get(F.col("_words"), i + 2))))
    n = F.size("_words")
    counts = staged.withColumn("_counts", F.struct(
        n.cast("long").alias("n_words"),
        removed(WHITE_SPACE).cast("long").alias("word_chars"),
        (F.length(text) - removed(SYMBOLS)).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("_words", lambda w: w.isin(listed))).cast("long").alias("n_stop_words"),
        _repeat_words(F.col("_windows")).alias("n_repeat_words"),
    )).drop("_words", "_lines", "_windows")

    def ratio(a: str, b: str) -> Column:
        return F.coalesce(F.try_divide(F.col(f"_counts.{a}").cast("double"), F.col(f"_counts.{b}")), F.lit(0.0))

    return counts.withColumn("_quality", F.struct(
        F.col("_counts.*"),
        ratio("word_chars", "n_words").alias("mean_word_chars"),
        ratio("n_symbols", "n_words").alias("symbol_ratio"),
        ratio("n_stop_words", "n_words").alias("stop_word_ratio"),
        ratio("n_dup_lines", "n_lines").alias("dup_line_ratio"),
        ratio("n_repeat_words", "n_words").alias("repeat_word_ratio"),
    )).drop("_counts")


def passes(rules: Sequence[Rule], lang: Column | None = None, of: str = "_quality") -> Column:
    """The rule table as one boolean expression; ``lang`` is the document's."""
    tests = [F.lit(True)]
    for rule in rules:
        metric = F.col(f"{of}.{rule.metric}")
        bounds = [metric >= rule.low] if rule.low is not None else []
        bounds += [metric <= rule.high] if rule.high is not None else []
        if rule.langs is not None and lang is not None:
            other = F.coalesce(~lang.isin(*rule.langs), F.lit(False))
            bounds = [other | b for b in bounds]
        tests += bounds
    return reduce(lambda a, b: a & b, tests)


def first_failed(rules: Sequence[Rule], lang: Column | None = None) -> Column:
    """Name of the first rule of the table that rejects the document."""
    return F.coalesce(*[F.when(~passes([rule], lang), F.lit(rule.metric)) for rule in rules])


def base_failed(of: str = "_quality") -> Column:
    return (F.col(f"{of}.n_words") < 50) | (F.col(f"{of}.n_repeat_words") * 100 > F.col(f"{of}.n_words") * 50)


def quality_report(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row per document: the counts, the ratios, the verdict and the rule
    that rejected it."""
    q = lambda name: F.col(f"_quality.{name}").alias(name)
    return with_metrics(docs.select("doc_id", "text", "lang")).select(
        "doc_id", q("n_words"), q("word_chars"), q("n_symbols"), q("n_dup_lines"), q("n_repeat_words"),
        base_failed().alias("base_failed"), (~base_failed() & passes(rules, F.col("lang"))).alias("kept"),
        F.round("_quality.mean_word_chars", 6).alias("mean_word_chars"),
        F.round("_quality.symbol_ratio", 6).alias("symbol_ratio"),
        F.round("_quality.stop_word_ratio", 6).alias("stop_word_ratio"),
        F.round("_quality.dup_line_ratio", 6).alias("dup_line_ratio"),
        first_failed(rules, F.col("lang")).alias("failed_rule"))


def filter_documents(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The documents that pass, with all their columns.

    The verdict stands in a generator instead of a filter: Catalyst would push
    a filter below the metrics and compute each of them once per use."""
    inner = docs.toDF(*[f"in_{i}" for i in range(len(docs.columns))])
    text, lang = (next(f"in_{i}" for i, c in enumerate(docs.columns) if c.lower() == name) for name in ("text", "lang"))
    row = F.array(F.struct(*[F.col(f"in_{i}") for i in range(len(docs.columns))]))
    verdict = ~base_failed() & passes(rules, F.col(lang))
    kept = with_metrics(inner, text).select(F.explode(F.when(verdict, row)).alias("row"))
    return kept.select(*[F.col("row").getField(f"in_{i}").alias(c) for i, c in enumerate(docs.columns)])


def oracle_sql(rules: Sequence[Rule] = RULES, stop_words: Sequence[str] = STOP_WORDS) -> str:
    listed = ", ".join(f"'{w}'" for w in written_forms(stop_words))

    def bounds(rule: Rule) -> list[str]:
        tests = [f"{rule.metric} {op} {bound}" for op, bound in ((">=", rule.low), ("<=", rule.high)) if bound is not None]
        if rule.langs is None:
            return tests
        other = "coalesce(lang NOT IN (" + ", ".join(f"'{x}'" for x in rule.langs) + "), false)"
        return [f"({other} OR {test})" for test in tests]

    tests = [test for rule in rules for test in bounds(rule)]
    failed = "\n".join(f"WHEN NOT ({' AND '.join(bounds(rule))}) THEN '{rule.metric}'" for rule in rules)
    return f"""
WITH base AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t FROM documents),
tok AS (
  SELECT rid, doc_id, lang, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM base),
pos AS (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM tok WHERE len(w) >= 3),
win AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, w[i], w[i + 1], w[i + 2]) AS c FROM pos),
cov AS (SELECT rid, count(DISTINCT i + d) AS n_repeat_words
        FROM win, (SELECT unnest([0, 1, 2]) AS d) WHERE c > 1 GROUP BY rid),
counts AS (
  SELECT tok.doc_id, tok.lang, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(translate(t, '{SYMBOLS}', '')))::BIGINT AS n_symbols,
         len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         len(list_filter(w, lambda x: x IN ({listed})))::BIGINT AS n_stop_words,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM tok LEFT JOIN cov USING (rid)),
ratios AS (
  SELECT *, coalesce(word_chars / nullif(n_words, 0), 0) AS mean_word_chars,
         coalesce(n_symbols / nullif(n_words, 0), 0) AS symbol_ratio,
         coalesce(n_stop_words / nullif(n_words, 0), 0) AS stop_word_ratio,
         coalesce(n_dup_lines / nullif(n_lines, 0), 0) AS dup_line_ratio,
         coalesce(n_repeat_words / nullif(n_words, 0), 0) AS repeat_word_ratio,
         n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {' AND '.join(tests)} AS kept,
       round(mean_word_chars, 6) AS mean_word_chars, round(symbol_ratio, 6) AS symbol_ratio,
       round(stop_word_ratio, 6) AS stop_word_ratio, round(dup_line_ratio, 6) AS dup_line_ratio,
       CASE {failed} END AS failed_rule
FROM ratios"""
