"""Mixing sources to target weights by Pareto order sampling (operator 5).

Sources in code-point order (null last) carry repeating weights and share a
budget of words; a source's target stops at ``cap`` times its size and the
excess is reshared by weight. Every document of a source gets the whole part
of target / size as certain copies. The rest is a fixed-size sample of one
extra copy: documents are ranked by random odds divided by their inclusion
odds (Pareto order sampling; longer documents have higher odds) and taken in
that order up to the words that are missing. "Fixed size" is counted in
words, so a source lands within half a document of its target.

The cut is found without sorting a source: ranks are 40-bit numbers, and four
rounds of (source, next 10 bits) sums narrow the cut to one rank. Each round
is a map-side combined aggregation with at most 1,024 rows a source, so a
source holding a third of all rows is no hot task. Only a table with one row
per source is joined back to the documents, under Spark's own size check.

Defined results
    null text, no words   size 0, taken 0
    null source           a source of its own, last in order
    ties, repeated rows   rows with equal rank (same doc_id and size) are
                          taken or left together
    empty table           empty result
    extra columns         kept by ``mix_documents``; helper names never clash
The random numbers are hashes of doc_id, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.textcols import word_count
from kestrel.session import materialize

# The weights of the sources in order, their joint share of all sizes and the cap on a source.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2.0

RANK_BITS = 40
DIGIT_BITS = 10
LENGTH_TILT = (0.5, 2.0)  # bounds of the odds factor sqrt(size / mean size)


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
                   cap: float = CAP) -> DataFrame:
    """Targets per source from rows (source, source_size, n_docs).

    Water filling in closed form: capped sources are a prefix of the order by
    size / weight, so one running sum finds the common level. The two windows
    run over one row per source, not over documents."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1)
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]),
                          ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    known = sizes.withColumn("weight", weight).withColumns({
        "limit": F.lit(cap) * F.col("source_size"),
        "ratio": F.lit(cap) * F.col("source_size") / F.col("weight")})
    before = lambda c: F.coalesce(F.sum(c).over(by_ratio), F.lit(0))
    level = ((F.lit(share) * F.sum("source_size").over(everything) - F.lit(cap) * before("source_size"))
             / (F.sum("weight").over(everything) - before("weight")))
    tried = known.withColumn("try", level)
    # Capping raises the level up to the common one and lowers it beyond.
    common = F.max(F.when(F.col("try") <= F.col("ratio"), F.col("try"))).over(everything)
    return tried.withColumn("level", common).select(
        "source", "source_size", "n_docs",
        F.least("limit", F.coalesce(F.col("level") * F.col("weight"), F.col("limit"))).alias("target"))


def _plan(targets: DataFrame) -> DataFrame:
    """Add the certain copies and the words left for the extra copy."""
    size = F.col("source_size")
    whole = F.when(size > 0, F.floor(F.col("target") / size)).otherwise(F.lit(0)).cast("int")
    return targets.withColumn("whole", whole).withColumn("rest", F.col("target") - F.col("whole") * size)


def _rank(doc_id: Column, size: Column) -> Column:
    """Pareto rank as a 40-bit number: odds of a uniform number over the
    document's inclusion odds, mapped from (0, inf) to (0, 1)."""
    digits = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("null"))), 1, 13)
    u = (F.conv(digits, 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))
    share = F.col("rest") / F.col("source_size")
    mean = F.col("source_size") / F.col("n_docs")
    tilt = F.greatest(F.lit(LENGTH_TILT[0]), F.least(F.lit(LENGTH_TILT[1]), F.sqrt(size / mean)))
    odds = share / (F.lit(1.0) - share) * tilt
    q = u / (F.lit(1.0) - u) / odds
    rank = F.floor(q / (F.lit(1.0) + q) * F.lit(float(1 << RANK_BITS))).cast("long")
    return F.when((F.col("rest") > 0) & (size > 0), rank).otherwise(F.lit((1 << RANK_BITS) - 1))


def _narrow(state: DataFrame, ranked: DataFrame, shift: int) -> DataFrame:
    """Find, per source, the next digit of the rank at which the words run out."""
    here = F.shiftright("rank", shift)
    open_part = ranked.join(state.select(F.col("source").alias("s"), "prefix"), F.col("source").eqNullSafe(F.col("s")))
    sums = (open_part.filter(F.shiftright("rank", shift + DIGIT_BITS) == F.col("prefix"))
            .groupBy("source", here.alias("at")).agg(F.sum("size").alias("words")))
    lists = sums.groupBy(F.col("source").alias("s")).agg(
        F.sort_array(F.collect_list(F.struct("at", "words"))).alias("steps"))

    def step(a: Column, x: Column) -> Column:
        over = a["cut"].isNull() & (a["base"] + x["words"] > F.col("rest"))
        return F.struct(
            F.when(a["cut"].isNull() & ~over, a["base"] + x["words"]).otherwise(a["base"]).alias("base"),
            F.when(over, x["at"]).otherwise(a["cut"]).alias("cut"),
            F.when(over, x["words"]).otherwise(a["words"]).alias("words"))

    start = F.struct(F.col("base"), F.lit(None).cast("long").alias("cut"), F.lit(0).cast("long").alias("words"))
    folded = (state.join(lists, F.col("source").eqNullSafe(F.col("s")), "left")
              .withColumn("found", F.aggregate(F.coalesce("steps", F.array().cast("array<struct<at:bigint,words:bigint>>")),
                                               start, step)))
    # No cut: the source's words fit, and the prefix moves past every rank.
    return folded.select("source", "source_size", "n_docs", "target", "whole", "rest",
                         F.coalesce("found.cut", F.shiftleft(F.col("prefix") + 1, DIGIT_BITS)).alias("prefix"),
                         F.col("found.base").alias("base"), F.col("found.words").alias("cut_words"))


def source_plan(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
                cap: float = CAP) -> DataFrame:
    """One row per source: size, target, certain copies and the largest rank
    that gets the extra copy. ``docs`` has doc_id, source, size (long)."""
    sized = materialize(docs.select("doc_id", "source", "size"), "mix-sizes")
    targets = source_targets(
        sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs")),
        weights, share, cap)
    state = materialize(_plan(targets).withColumns({
        "prefix": F.lit(0).cast("long"), "base": F.lit(0).cast("long"), "cut_words": F.lit(0).cast("long")}), "mix-state")
    ranked = materialize(
        sized.join(state.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
        .select("source", "size", _rank(F.col("doc_id"), F.col("size")).alias("rank")), "mix-ranks")
    for shift in range(RANK_BITS - DIGIT_BITS, -1, -DIGIT_BITS):
        state = materialize(_narrow(state, ranked, shift), "mix-state")
    last = F.when(F.col("base") + F.col("cut_words") / F.lit(2.0) <= F.col("rest"), F.col("prefix"))
    return state.select("source", "source_size", "n_docs", "target", "whole", "rest",
                        last.otherwise(F.col("prefix") - 1).alias("last_rank"))


def _with_copies(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """Join the per-source plan to documents and add ``copies``."""
    extra = (F.col("whole") < 2) & (F.col("rest") > 0) & (_rank(F.col("doc_id"), F.col("size")) <= F.col("last_rank"))
    return (sized.join(plan.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
            .withColumn("copies", F.col("whole") + extra.cast("int")))


def mix_report(docs: DataFrame) -> DataFrame:
    """One row per document with the words the mix takes from it."""
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    out = _with_copies(sized, source_plan(sized))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"),
                      "source", F.col("copies").cast("long").alias("copies"))


def mix_documents(docs: DataFrame) -> DataFrame:
    """The mixed corpus: every document once per copy, with its own columns."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    sized = docs.select(F.col("doc_id").alias("doc_id"), F.col("source").alias("source"),
                        word_count(F.col("text")).alias("size"), row.alias("row"))
    copies = _with_copies(sized, source_plan(sized.drop("row")))
    # No copies: an empty array, no row.
    return copies.select(F.explode(F.array_repeat("row", F.col("copies"))).alias("row")).select("row.*")


def oracle_sql(weights: Sequence[int] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> str:
    listed = ", ".join(str(w) for w in weights)
    return f"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n_docs FROM sized GROUP BY source),
weighed AS (
  SELECT *, [{listed}][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(weights)} + 1] AS weight FROM per),
tried AS (
  SELECT *, {cap} * source_size AS lim, {cap} * source_size / weight AS ratio FROM weighed),
levels AS (
  SELECT *, ({share} * (sum(source_size) OVER ())::DOUBLE
             - {cap} * coalesce(sum(source_size) OVER w, 0)::DOUBLE)
            / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0))::DOUBLE AS tr
  FROM tried WINDOW w AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size, n_docs,
         least(lim, coalesce(max(CASE WHEN tr <= ratio THEN tr END) OVER () * weight, lim))::DOUBLE AS target FROM levels),
plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::INT AS whole FROM targets),
rests AS (SELECT *, target - whole * source_size AS rest FROM plan),
odds AS (
  SELECT sized.doc_id, sized.size, r.*,
         (('0x' || substr(md5(coalesce(sized.doc_id::VARCHAR, 'null')), 1, 13))::BIGINT + 0.5::DOUBLE) / {1 << 52}::DOUBLE AS u,
         greatest({LENGTH_TILT[0]}::DOUBLE, least({LENGTH_TILT[1]}::DOUBLE,
           sqrt(size::DOUBLE / nullif(source_size::DOUBLE / n_docs, 0)))) AS tilt
  FROM sized JOIN rests r ON sized.source IS NOT DISTINCT FROM r.source),
pareto AS (
  SELECT *, u / (1.0::DOUBLE - u) / nullif((rest / nullif(source_size, 0)) / (1.0::DOUBLE - rest / nullif(source_size, 0)) * tilt, 0) AS q
  FROM odds),
ranked AS (
  SELECT *, CASE WHEN rest > 0 AND size > 0 THEN floor(q / (1.0::DOUBLE + q) * {1 << RANK_BITS}::DOUBLE)::BIGINT
            ELSE {(1 << RANK_BITS) - 1} END AS rk FROM pareto),
cut AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY rk RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         sum(size) OVER (PARTITION BY source, rk) AS tied FROM ranked),
taken AS (
  SELECT *, whole + CASE WHEN whole < 2 AND rest > 0 AND before + tied / 2.0 <= rest THEN 1 ELSE 0 END AS copies FROM cut)
SELECT doc_id, size, source_size, target, (size * copies)::BIGINT AS taken, source, copies::BIGINT AS copies FROM taken"""
