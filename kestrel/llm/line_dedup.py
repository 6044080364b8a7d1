"""Line deduplication by deletion neighbourhoods (operator 6).

A trimmed line is dropped when the corpus holds an equal line at an earlier
place (lines of ``equal_chars`` characters or more), or one within edit
distance 1 (both lines of ``min_chars`` or more: one edit in a shorter line is
often another line); places are ordered by doc_id and line number. Lines below
both floors always stay.

1.  Equal lines are grouped by a 128-bit hash with their first place and count
    (map-side combined; text is not shuffled).
2.  Lines at distance 1 have lengths that differ by at most 1 and agree in
    their first half or their last half. Four half-line keys per distinct line
    find the lines that can have such a partner at all; only their text is
    fetched. Keys over ``SEGMENT``-character segments (equal before and after
    one segment) thin them out once more. Both filters are lossless.
3.  For what is left, all variants with one character deleted are emitted as
    hashed keys. Equal variants at the same position are a substitution;
    a variant equal to a whole line is an insertion or deletion. All members
    of a substitution key are within distance 1 of each other, and a whole
    line of all variants equal to it, so each key needs only its earliest
    members: minima instead of pairs, map-side combined, whatever the size of
    the group.
4.  The line and its earlier partner are verified with ``levenshtein``.
5.  Dropped line numbers are collected per document and cut from its text.

Only built-in functions are used. Joins with a possibly hot line have written
tables on the smaller side, so Spark may split the hot partition.

Defined results
    null text             stays null, 0 lines
    empty, very long text every line of the whole text is considered
    ties                  lines at the same place (a repeated doc_id) are not
                          earlier than each other: both stay, also in
                          repeated rows
    null doc_id           before all others
    empty table           empty result
    equal_chars 0         blank lines count as equal lines too
    equal_chars above min_chars   ``ValueError``
    extra columns         kept by ``drop_lines``
    a document that loses all lines stays, with an empty text
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.textcols import WHITE_SPACE
from kestrel.session import materialize

EQUAL_CHARS = 10
MIN_CHARS = 20
SEGMENT = 64
MAX_DISTANCE = 1


def _lines(docs: DataFrame, floor: int) -> DataFrame:
    """doc_id, the text's hash, line number, line and its 128-bit hash, for
    lines of at least ``floor`` characters."""
    exploded = docs.select(
        F.col("doc_id").alias("doc_id"), F.xxhash64("text").alias("text_hash"),
        F.posexplode(F.split(F.col("text"), "\n")).alias("no", "raw"))
    lined = exploded.select("doc_id", "text_hash", "no", F.btrim("raw", F.lit(WHITE_SPACE)).alias("line"))
    return lined.filter(F.length("line") >= floor).select(
        "doc_id", "text_hash", "no", "line", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("line"), F.col("line")).alias("h2"))


def _half_keys(line: Column) -> list[Column]:
    """Keys that two lines at distance 1 share at least one of: the length of
    the shorter one with its first or its last half."""
    out = []
    for shorter in (F.length(line), F.length(line) - 1):
        half = F.floor(shorter / 2).cast("int")
        out += [F.xxhash64(F.lit(side), shorter, part) for side, part in
                (("l", F.left(line, half)), ("r", F.right(line, half)))]
    return out


def _met(rows: DataFrame, name: str) -> DataFrame:
    """The rows whose key is met more than once."""
    met = materialize(rows.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("key").alias("k")), name)
    return rows.join(met, F.col("key") == F.col("k"), "left_semi")


def _segments(lines: DataFrame) -> DataFrame:
    """One row per segment: what stands before it, in it and after it (with
    and without the segment's last character's place)."""
    length = F.length("line")
    numbered = lines.withColumn("size", length).withColumn("seg", F.explode(F.sequence(F.lit(0), F.floor(length / SEGMENT).cast("int"))))
    at = F.col("seg") * SEGMENT
    part = lambda start, n: F.substr(F.col("line"), start, n)
    rest = lambda start: F.xxhash64(F.substr(F.col("line"), start))
    return numbered.select(
        "h1", "h2", "doc_id", "no", "size", "seg", F.xxhash64(F.left(F.col("line"), at)).alias("before"),
        part(at + 1, F.lit(SEGMENT)).alias("middle"), part(at + 1, F.lit(SEGMENT - 1)).alias("shorter"),
        rest(at + SEGMENT + 1).alias("after"), rest(at + SEGMENT).alias("after_shorter"))


def _segment_keys(segments: DataFrame) -> DataFrame:
    """Keys that a pair shares at the segment of its edit, one per kind of
    part that the line can play in it."""
    def key(kind: str, edit: str, size: Column, after: str) -> Column:
        return F.struct(F.lit(kind).alias("kind"),
                        F.xxhash64(F.lit(edit), F.col("seg"), size, F.col("before"), F.col(after)).alias("key"))

    return segments.select("h1", "h2", "seg", F.explode(F.array(
        key("sub", "s", F.col("size"), "after"), key("del", "d", F.col("size") - 1, "after"),
        key("whole", "d", F.col("size"), "after_shorter"))).alias("k")).select("h1", "h2", "seg", "k.*")


def _variants(segments: DataFrame) -> DataFrame:
    """Deletion neighbourhood of the segments with matched parts (column
    ``kinds``): (line, place, key, kind) with kind ``sub`` and ``del`` for each
    variant and ``whole`` for the line itself."""
    def variant(kind: str, edit: str, *of: Column):
        def at(i: Column) -> Column:
            left = F.concat(F.left(F.col("middle"), i), F.substr(F.col("middle"), i + 2))
            place = [i] if kind == "sub" else []
            return F.struct(F.xxhash64(F.lit(edit), F.col("seg"), *place, *of, F.col("before"), left, F.col("after")).alias("key"),
                            F.lit(kind).alias("kind"))
        return F.when(F.array_contains("kinds", kind), F.transform(places, at)).otherwise(none)

    none = F.array().cast("array<struct<key:bigint,kind:string>>")
    places = F.when(F.length("middle") > 0, F.sequence(F.lit(0), F.length("middle") - 1)).otherwise(F.array().cast("array<int>"))
    whole = F.struct(
        F.xxhash64(F.lit("d"), F.col("seg"), F.col("size"), F.col("before"), F.col("shorter"), F.col("after_shorter")).alias("key"),
        F.lit("whole").alias("kind"))
    every = F.concat(variant("sub", "s", F.col("size")), variant("del", "d", F.col("size") - 1),
                     F.when(F.array_contains("kinds", "whole"), F.array(whole)).otherwise(none))
    return segments.select("h1", "h2", "doc_id", "no", F.explode(every).alias("v")).select("h1", "h2", "doc_id", "no", "v.*")


def _near_lines(lines: DataFrame, distinct: DataFrame) -> DataFrame:
    """(h1, h2) of the lines with an earlier line at distance 1."""
    halves = distinct.select("h1", "h2", F.explode(F.array("k0", "k1", "k2", "k3")).alias("key"))
    possible = _met(halves, "line-half-keys").select("h1", "h2").distinct().join(
        distinct.select(F.col("h1").alias("a"), F.col("h2").alias("b"), F.col("first.doc_id").alias("d"), F.col("first.no").alias("n")),
        (F.col("h1") == F.col("a")) & (F.col("h2") == F.col("b"))).select("a", "b", "d", "n").distinct()
    possible = materialize(possible, "line-possible")
    # One occurrence of each line is enough; its first place has no copies.
    # Sorted on both sides at every size: the text of all lines moves once,
    # whether or not the possible ones would fit a broadcast.
    fetched = lines.join(possible.hint("merge"), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("no") == F.col("n"))
                         & (F.col("h1") == F.col("a")) & (F.col("h2") == F.col("b")), "left_semi")
    text = materialize(fetched.select("h1", "h2", "doc_id", "no", "line").dropDuplicates(["h1", "h2", "doc_id", "no"]), "line-text")
    # Only the segments that can hold the edit have their variants emitted.
    thin = _met(_segment_keys(_segments(text)), "line-segment-keys").groupBy("h1", "h2", "seg").agg(F.collect_set("kind").alias("kinds"))
    thin = materialize(thin, "line-thin")
    rows = _variants(_segments(text).join(thin, ["h1", "h2", "seg"])).withColumn("me", F.struct("doc_id", "no", "h1", "h2"))
    earliest = materialize(
        rows.groupBy("key").agg(F.count("*").alias("n"), F.min(F.when(F.col("kind") != "whole", F.col("me"))).alias("variant"),
                                F.min(F.when(F.col("kind") == "whole", F.col("me"))).alias("whole"))
        .filter("n > 1").select(F.col("key").alias("k"), "variant", "whole"), "line-earliest")
    partner = F.when(F.col("kind") == "del", F.col("whole")).otherwise(F.col("variant"))
    pairs = (rows.join(earliest, F.col("key") == F.col("k")).withColumn("partner", partner)
             .filter(F.struct("partner.doc_id", "partner.no") < F.struct("doc_id", "no"))
             .select("h1", "h2", F.col("partner.h1").alias("p1"), F.col("partner.h2").alias("p2")).distinct())
    other = text.select(F.col("h1").alias("p1"), F.col("h2").alias("p2"), F.col("line").alias("earlier"))
    verified = (pairs.join(text.select("h1", "h2", "line"), ["h1", "h2"]).join(other, ["p1", "p2"])
                .filter(F.levenshtein("line", "earlier", MAX_DISTANCE).between(0, MAX_DISTANCE)))
    return materialize(verified.select(F.col("h1").alias("n1"), F.col("h2").alias("n2")).distinct(), "line-near")


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS, equal_chars: int = EQUAL_CHARS) -> DataFrame:
    """Per document (doc_id and text hash) the numbers of its dropped lines,
    and how many of them have no equal earlier line."""
    if equal_chars > min_chars:
        raise ValueError(f"equal lines are matched from {equal_chars} characters on, near ones already from {min_chars}")
    lines = _lines(docs, equal_chars)
    long = F.length("line") >= min_chars
    keyed = lines.select("h1", "h2", "doc_id", "no", *[F.when(long, k).alias(f"k{i}") for i, k in enumerate(_half_keys(F.col("line")))])
    distinct = materialize(
        keyed.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "no")).alias("first"), F.count("*").alias("n"),
                                      *[F.min(f"k{i}").alias(f"k{i}") for i in range(4)]), "line-distinct")
    near = _near_lines(lines.filter(long), distinct.filter("k0 is not null"))
    affected = (distinct.select("h1", "h2", "first", "n")
                .join(near, (F.col("h1") == F.col("n1")) & (F.col("h2") == F.col("n2")), "left")
                .filter("n > 1 or n1 is not null")
                .select(F.col("h1").alias("a"), F.col("h2").alias("b"), "first", F.col("n1").isNotNull().alias("near")))
    affected = materialize(affected, "line-affected")
    place = F.struct("doc_id", "no")
    # By struct order, so that a null doc_id compares like any other.
    later = F.col("first") < place
    gone = (lines.select("doc_id", "text_hash", "no", "h1", "h2")
            .join(affected, (F.col("h1") == F.col("a")) & (F.col("h2") == F.col("b")))
            .filter(F.col("near") | later)
            .groupBy("doc_id", "text_hash").agg(F.collect_set("no").alias("nos"),
                                                F.collect_set(F.when(~later, F.col("no"))).alias("near_nos")))
    return materialize(gone.select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash"), "nos",
                                   F.size("near_nos").alias("n_near")), "line-gone")


def _marked(docs: DataFrame, min_chars: int, equal_chars: int) -> DataFrame:
    """The documents as (row, text) with their dropped line numbers."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    gone = dropped_lines(docs, min_chars, equal_chars)
    keyed = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text"), row.alias("row"), F.xxhash64("text").alias("text_hash"))
    return keyed.join(gone, F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.col("text_hash") == F.col("gone_hash")), "left")


def _kept_text() -> tuple[Column, Column]:
    lines = F.split(F.col("text"), "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("nos"))
    joined = F.array_join(F.transform(kept, lambda i: F.get(F.col("_lines"), i)), "\n")
    return lines, F.when(F.col("nos").isNull(), F.col("text")).otherwise(joined)


def line_report(docs: DataFrame, min_chars: int = MIN_CHARS, equal_chars: int = EQUAL_CHARS) -> DataFrame:
    """Per document: lines, dropped lines, those dropped as near only, and the
    length and hash of the text that is left."""
    lines, kept = _kept_text()
    marked = _marked(docs.select("doc_id", "text"), min_chars, equal_chars).withColumn("_lines", lines).withColumn("_kept", kept)
    return marked.select(
        "doc_id", F.greatest(F.coalesce(F.size("_lines"), F.lit(0)), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("nos"), F.lit(0)).cast("long").alias("n_dropped"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.length("_kept").cast("long").alias("kept_chars"), F.sha2(F.col("_kept"), 256).alias("kept_sha256"))


def drop_lines(docs: DataFrame, min_chars: int = MIN_CHARS, equal_chars: int = EQUAL_CHARS) -> DataFrame:
    """The documents without their dropped lines; n_chars follows the text."""
    lines, kept = _kept_text()
    marked = _marked(docs, min_chars, equal_chars).withColumn("_lines", lines).withColumn("_kept", kept)

    def column(c: str) -> Column:
        old = F.col("row").getField(c)
        if c.lower() == "text":
            return F.col("_kept").alias(c)
        if c.lower() == "n_chars":
            return F.when(F.col("nos").isNull(), old).otherwise(F.length("_kept")).cast(docs.schema[c].dataType).alias(c)
        return old.alias(c)

    return marked.select(*[column(c) for c in docs.columns])


def oracle_sql() -> str:
    blank = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
raw AS (SELECT rid, doc_id, unnest(range(0, len(ls))) AS no, unnest(ls) AS raw FROM docs WHERE text IS NOT NULL),
lines AS (SELECT rid, doc_id, no, trim(raw, {blank}) AS line FROM raw WHERE length(trim(raw, {blank})) >= {EQUAL_CHARS}),
firsts AS (SELECT line, length(line) AS n, min((doc_id, no)) AS first FROM lines GROUP BY line),
long AS (SELECT line, n FROM firsts WHERE n >= {MIN_CHARS}),
halves AS (
  SELECT a.line AS x, b.line AS y FROM long a JOIN long b ON a.n = b.n AND left(a.line, a.n // 2) = left(b.line, a.n // 2) AND a.line <> b.line
  UNION SELECT a.line, b.line FROM long a JOIN long b ON a.n = b.n AND right(a.line, a.n // 2) = right(b.line, a.n // 2) AND a.line <> b.line
  UNION SELECT a.line, b.line FROM long a JOIN long b ON a.n + 1 = b.n AND left(a.line, a.n // 2) = left(b.line, a.n // 2)
  UNION SELECT a.line, b.line FROM long a JOIN long b ON a.n + 1 = b.n AND right(a.line, a.n // 2) = right(b.line, a.n // 2)),
pairs AS (
  SELECT x, y FROM halves WHERE CASE WHEN length(x) = length(y)
    THEN len(list_filter(range(1, length(x) + 1), lambda i: substr(x, i, 1) <> substr(y, i, 1))) = 1
    ELSE len(list_filter(range(0, length(y)), lambda i: substr(y, 1, i) || substr(y, i + 2) = x)) > 0 END),
two AS (SELECT x AS me, y AS other FROM pairs UNION SELECT y, x FROM pairs),
near AS (
  SELECT DISTINCT me AS line FROM two JOIN firsts f ON f.line = me JOIN firsts g ON g.line = other WHERE g.first < f.first),
gone AS (
  SELECT l.rid, count(*) AS n_dropped, count(*) FILTER (WHERE NOT f.first < (l.doc_id, l.no)) AS n_near, list(l.no) AS nos
  FROM lines l JOIN firsts f USING (line) LEFT JOIN near ON near.line = l.line
  WHERE near.line IS NOT NULL OR f.first < (l.doc_id, l.no) GROUP BY l.rid),
kept AS (
  SELECT d.rid, string_agg(raw.raw, chr(10) ORDER BY raw.no) AS kept FROM docs d JOIN raw USING (rid) LEFT JOIN gone g ON g.rid = d.rid
  WHERE g.nos IS NULL OR NOT list_contains(g.nos, raw.no) GROUP BY d.rid)
SELECT d.doc_id, coalesce(len(d.ls), 0)::BIGINT AS n_lines, coalesce(n_dropped, 0)::BIGINT AS n_dropped, coalesce(n_near, 0)::BIGINT AS n_near,
       CASE WHEN d.text IS NOT NULL THEN length(coalesce(kept, '')) END::BIGINT AS kept_chars,
       CASE WHEN d.text IS NOT NULL THEN sha256(coalesce(kept, '')) END AS kept_sha256
FROM docs d LEFT JOIN gone g ON g.rid = d.rid LEFT JOIN kept k ON k.rid = d.rid"""
