"""License scans with a positional rare-token index (operator 8).

The index is a posting table of (word, entry, position). Entries are the
license templates and the base phrases; an entry's postings are the words of
highest inverse document frequency over the whole corpus, three of the template
and two of each of its mandatory key phrases. A file's words are looked up in
the table, every posting met proposes a relative position (place in the file
minus place in the entry), and proposals that two postings agree on are
intersected. They count once the entry's key phrases stand there word for word.
The two rarest words of a phrase stand wherever the phrase does, so no place of
a key phrase is missed, however frequent its words are.

Postings, key phrases and weights are data of the scan (one constant each), not
expressions per template, so hundreds of full licence texts make no larger a
plan; they are bounded by the templates handed in.

Two passes over the texts, both plain projections: document frequencies of
the template words (map-side combined, one row per template word), then the
scan. No shuffle depends on a document, so hot sources and copies cost
nothing extra. Work inside a row is its words plus a sort of the postings met.

Defined results
    null or empty text    0 words, 0 places, null places, no label, score 0
    very long text        scanned whole, every place counted
    repeated rows, ties   each row is scanned alone; word ties in the index
                          break by position
    empty table           empty result
    extra columns         ignored
    no templates, no base no label; every other column as ever
    key phrase not in its template, or empty   ``ValueError``
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.textcols import let, text_or_empty

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# The base phrases and their labels.
BASE_PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))


@dataclass(frozen=True)
class Template:
    """A license notice: its label, its words and the phrases it must hold."""
    label: str
    text: str
    keys: tuple[str, ...]


# Wording of licence notices and what each must hold.
TEMPLATES: tuple[Template, ...] = (
    Template("0bsd", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
             "zero clause bsd", ("zero clause bsd",)),
    Template("afl-3.0", "licensed under the academic free license version 3 0", ("academic free license",)),
    Template("agpl-3.0", "licensed under the gnu affero general public license version 3", ("affero general public license",)),
    Template("apache-1.1", "licensed under the apache software license version 1 1", ("apache software license",)),
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license",)),
    Template("apsl", "subject to the apple public source license version 2 0", ("apple public source license",)),
    Template("artistic-2.0", "distributed under the terms of the artistic license 2 0", ("artistic license",)),
    Template("beerware", "as long as you retain this notice you can do whatever you want with this stuff", ("whatever you want with this stuff",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
             ("redistribution and use in source and binary forms",)),
    Template("bsd-2-clause", "licensed under the bsd 2 clause license", ("bsd 2 clause",)),
    Template("bsd-3-clause", "licensed under the bsd 3 clause license", ("bsd 3 clause",)),
    Template("bsl-1.0", "distributed under the boost software license version 1 0", ("boost software license",)),
    Template("busl-1.1", "use of this software is governed by the business source license 1 1", ("business source license",)),
    Template("cc-by", "licensed under a creative commons attribution license", ("creative commons attribution",)),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc-by-nc-nd", "licensed under cc by nc nd 4 0", ("cc by nc nd",)),
    Template("cc-by-nc-sa", "licensed under cc by nc sa 4 0", ("cc by nc sa",)),
    Template("cc-by-nd", "licensed under cc by nd 4 0", ("cc by nd",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights",
             ("waived all copyright and related or neighboring rights",)),
    Template("cc0", "released under the cc0 1 0 universal public domain dedication", ("public domain dedication",)),
    Template("cddl", "subject to the terms of the common development and distribution license", ("common development and distribution license",)),
    Template("cecill", "this software is governed by the cecill license under french law", ("cecill license",)),
    Template("commons-clause", "the software is provided under the license subject to the commons clause license condition",
             ("commons clause",)),
    Template("confidential", "this document is proprietary and confidential and may not be copied", ("proprietary and confidential",)),
    Template("cpl-1.0", "made available under the common public license version 1 0", ("common public license",)),
    Template("ecl-2.0", "licensed under the educational community license version 2 0", ("educational community license",)),
    Template("elastic-2.0", "licensed under the elastic license 2 0", ("elastic license",)),
    Template("epl-2.0", "made available under the terms of the eclipse public license 2 0", ("eclipse public license",)),
    Template("eupl", "licensed under the european union public licence", ("european union public licence",)),
    Template("gfdl", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license",
             ("gnu free documentation license",)),
    Template("gpl-2.0", "licensed under the gnu general public license version 2", ("general public license version 2",)),
    Template("gpl-3.0", "licensed under the gnu general public license version 3", ("general public license version 3",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
             ("permission to use copy modify and or distribute this software for any purpose",)),
    Template("lgpl", "licensed under the gnu lesser general public license", ("lesser general public license",)),
    Template("lgpl", "licensed under the gnu library general public license", ("library general public license",)),
    Template("lppl", "distributed under the conditions of the latex project public license", ("latex project public license",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
             ("permission is hereby granted free of charge",)),
    Template("mit", "released under the mit license", ("mit license",)),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    Template("ms-pl", "licensed under the microsoft public license", ("microsoft public license",)),
    Template("ms-rl", "licensed under the microsoft reciprocal license", ("microsoft reciprocal license",)),
    Template("odbl", "made available under the open database license", ("open database license",)),
    Template("odc-by", "made available under the open data commons attribution license", ("open data commons attribution",)),
    Template("ofl-1.1", "this font software is licensed under the sil open font license version 1 1", ("open font license",)),
    Template("ogl-uk", "contains information licensed under the open government licence v 3 0", ("open government licence",)),
    Template("openssl", "this product includes software developed by the openssl project", ("software developed by the openssl project",)),
    Template("osl-3.0", "licensed under the open software license version 3 0", ("open software license",)),
    Template("pddl", "made available under the public domain dedication and license", ("public domain dedication and license",)),
    Template("php", "this source file is subject to the php license", ("php license",)),
    Template("postgresql", "released under the postgresql license", ("postgresql license",)),
    Template("psf-2.0", "licensed under the python software foundation license", ("python software foundation license",)),
    Template("public-domain", "this work is released into the public domain", ("released into the public domain",)),
    Template("reserved", "all rights reserved", ("all rights reserved",)),
    Template("sspl", "licensed under the server side public license", ("server side public license",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
    Template("upl-1.0", "licensed under the universal permissive license", ("universal permissive license",)),
    Template("w3c", "this work is distributed under the w3c software notice and license", ("w3c software notice and license",)),
    Template("wtfpl", "do what the fuck you want to public license", ("do what the fuck you want to",)),
    Template("zlib", "this software is provided as is without any express or implied warranty altered source versions must be plainly marked",
             ("altered source versions must be plainly marked",)),
    Template("zpl", "subject to the provisions of the zope public license", ("zope public license",)),
)
RARE_TOKENS = 3
PHRASE_TOKENS = 2
MIN_AGREEING = 2


def license_words(text: Column) -> Column:
    lowered = F.translate(text_or_empty(text), UPPER, UPPER.lower())
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def document_frequencies(docs: DataFrame, vocabulary: Sequence[str]) -> tuple[dict[str, int], int]:
    """Documents holding each vocabulary word, and all documents. One pass;
    the collected rows are bounded by the vocabulary."""
    listed = _constant(list(vocabulary), "array<string>")
    found = docs.select(F.explode(F.concat(F.array(F.lit("")), F.array_intersect(license_words(F.col("text")), listed))).alias("word"))
    counts = {r["word"]: r["count"] for r in found.groupBy("word").count().collect()}
    return {w: counts.get(w, 0) for w in vocabulary}, counts.get("", 0)


@dataclass(frozen=True)
class Entry:
    """What the index finds: a template, or a base phrase as its own key."""
    label: str
    base: bool
    words: tuple[str, ...]
    keys: tuple[tuple[int, tuple[str, ...]], ...]


def _entry(label: str, base: bool, text: str, keys: Sequence[str]) -> Entry:
    words, placed = tuple(text.split()), []
    for key in keys:
        phrase = tuple(key.split())
        shift = next((j for j in range(len(words)) if words[j:j + len(phrase)] == phrase), None)
        if not phrase or shift is None:
            raise ValueError(f"the key phrase {key!r} is not in the template {label!r}")
        placed.append((shift, phrase))
    if not placed:
        raise ValueError(f"the template {label!r} has no key phrase")
    return Entry(label, base, words, tuple(placed))


def entries_of(templates: Sequence[Template], base: Sequence[tuple[str, str]]) -> list[Entry]:
    return [_entry(t.label, False, t.text, t.keys) for t in templates] + [_entry(label, True, p, (p,)) for p, label in base]


def postings(entries: Sequence[Entry], frequency: dict[str, int]) -> list[tuple[str, int, int]]:
    """The posting table: (word, number of the entry, position in it)."""
    out = set()
    for k, e in enumerate(entries):
        def rarest(places, n):
            return sorted(places, key=lambda j: (frequency[e.words[j]], j))[:n]

        for j in [*rarest(range(len(e.words)), RARE_TOKENS),
                  *(j for shift, phrase in e.keys for j in rarest(range(shift, shift + len(phrase)), PHRASE_TOKENS))]:
            out.add((e.words[j], k, j))
    return sorted(out)


def _constant(value: object, schema: str) -> Column:
    """One constant of any size: folded once, not one expression a value."""
    return F.from_json(F.lit(json.dumps(value)), schema)


def _index_of(entries: Sequence[Entry], frequency: dict[str, int], n: int) -> tuple[list[str], Column, Column]:
    """The words of the posting table, the postings by word and the entries."""
    by_word: dict[str, list] = {}
    for word, k, j in postings(entries, frequency):
        need = min(MIN_AGREEING, *[len(phrase) for _, phrase in entries[k].keys])
        by_word.setdefault(word, []).append({"entry": k, "need": need, "at": j})
    weight = {w: math.log((n + 1) / (count + 1)) + 1.0 for w, count in frequency.items()}
    listed = [{"label": e.label, "base": e.base, "keys": [{"shift": shift, "words": phrase} for shift, phrase in e.keys],
               "words": e.words, "weights": [weight[w] for w in e.words], "total": math.fsum(weight[w] for w in e.words)}
              for e in entries]
    return (sorted(by_word), _constant(by_word, "map<string,array<struct<entry:int,need:int,at:int>>>"),
            _constant(listed, "array<struct<label:string,base:boolean,keys:array<struct<shift:int,words:array<string>>>,"
                              "words:array<string>,weights:array<double>,total:double>>"))


def _agreed() -> Column:
    """The proposals that enough postings agree on, each once: in sorted order
    the first of its run where one is enough, else the second."""
    def same(i: Column, back: int) -> Column:
        return F.when(i >= back, F.get(F.col("_proposed"), i) == F.get(F.col("_proposed"), i - back)).otherwise(False)

    return F.filter("_proposed", lambda p, i: F.when(p.need == 1, ~same(i, 1)).otherwise(same(i, 1) & ~same(i, 2)))


def _keys_hold(entry: Column, s: Column) -> Column:
    def holds(key: Column) -> Column:
        at = s + key.shift
        return F.when(at >= 0, F.slice("_words", at + 1, F.size(key.words)) == key.words).otherwise(False)

    return F.forall(entry["keys"], holds)


def _share(entry: Column, s: Column) -> Column:
    """Weighted share of the entry's words that stand in place."""
    first, n = F.greatest(-s, F.lit(0)) + 1, F.size(entry.words)
    there = F.slice("_words", F.greatest(s, F.lit(0)) + 1, n)
    wanted = F.arrays_zip(F.slice(entry.words, first, n).alias("word"), F.slice(entry.weights, first, n).alias("weight"))
    got = F.zip_with(there, wanted, lambda word, w: F.when(word == w["word"], w["weight"]).otherwise(0.0))
    return F.aggregate(got, F.lit(0.0), lambda total, x: total + x) / entry.total


def _proven(entries: Column) -> Column:
    """The agreed proposals whose key phrases stand there. The entries are
    named once: every naming of a constant is a copy in the plan."""
    def proof(p: Column) -> Column:
        return let(F.get(entries, p.entry), lambda e: F.when(_keys_hold(e, p.s), F.struct(
            e.label.alias("label"), e.base.alias("base"), p.s.alias("s"), _share(e, p.s).alias("score"))))

    return F.array_compact(F.transform(_agreed(), proof))


def scan(docs: DataFrame, templates: Sequence[Template] = TEMPLATES,
         base: Sequence[tuple[str, str]] = BASE_PHRASES) -> DataFrame:
    """One row per document: words, base places, labels and score."""
    known = entries_of(templates, base)
    frequency, n = document_frequencies(docs, sorted({w for e in known for w in e.words}))
    looked_up, index, entries = _index_of(known, frequency, n)
    proposal = "array<struct<entry:int,need:int,s:int>>"
    proof = "array<struct<label:string,base:boolean,s:int,score:double>>"
    words = docs.select("doc_id", license_words(F.col("text")).alias("_words"))
    places = F.filter(F.transform("_words", lambda w, i: F.when(w.isin(looked_up), i)), lambda i: i.isNotNull())
    # A file without any word of the index has no place and no alignment.
    met = F.arrays_overlap("_words", _constant(looked_up, "array<string>"))
    hits = words.withColumn("_hits", F.when(met, places).otherwise(F.array().cast("array<int>")))
    proposals = F.flatten(F.transform("_hits", lambda i: F.transform(
        F.element_at(index, F.get(F.col("_words"), i)), lambda p: F.struct(p.entry.alias("entry"), p.need.alias("need"), (i - p["at"]).alias("s")))))
    proposed = hits.withColumn("_proposed", F.when(F.size("_hits") > 0, F.array_sort(proposals)).otherwise(F.array().cast(proposal)))
    found = proposed.withColumn("_proven", F.when(F.size("_proposed") > 0, _proven(entries)).otherwise(F.array().cast(proof)))
    placed = found.withColumn("_base", F.filter("_proven", lambda p: p.base))
    labels = lambda c: F.array_join(F.array_sort(F.array_distinct(F.transform(c, lambda p: p.label))), ",")
    own = F.concat(F.transform("_proven", lambda p: p.score), F.array(F.lit(0.0)))
    return placed.select(
        "doc_id", F.size("_words").cast("long").alias("n_words"), F.size("_base").cast("long").alias("n_base"),
        F.array_min(F.transform("_base", lambda p: p.s)).cast("long").alias("first_word"),
        F.array_max(F.transform("_base", lambda p: p.s)).cast("long").alias("last_word"),
        labels("_base").alias("base_labels"), labels("_proven").alias("labels"),
        F.round(F.least(F.array_max(own), F.lit(1.0)), 6).alias("score"))


def oracle_sql(templates: Sequence[Template] = TEMPLATES,
               base: Sequence[tuple[str, str]] = BASE_PHRASES) -> str:
    """Every place where all words of the key phrases stand, without an index."""
    words, keys = [], []
    for tid, e in enumerate(entries_of(templates, ())):
        words += [f"({tid}, '{e.label}', {j}, '{w}')" for j, w in enumerate(e.words)]
        keyed = {j for shift, phrase in e.keys for j in range(shift, shift + len(phrase))}
        keys += [f"({tid}, {j}, '{e.words[j]}', {len(keyed)})" for j in sorted(keyed)]
    phrase = [f"({pid}, '{label}', {j}, '{w}', {len(p.split())})" for pid, (p, label) in enumerate(base)
              for j, w in enumerate(p.split())]
    return f"""
WITH base AS (SELECT row_number() OVER () AS rid, doc_id, translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}') AS t FROM documents),
doc AS (SELECT rid, doc_id, regexp_extract_all(t, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM base),
tok AS (SELECT rid, unnest(range(0, len(w))) AS pos, unnest(w) AS word FROM doc),
tmpl(tid, label, j, word) AS (VALUES {', '.join(words)}),
tkey(tid, j, word, n) AS (VALUES {', '.join(keys)}),
phr(pid, label, j, word, n) AS (VALUES {', '.join(phrase)}),
lic AS (SELECT * FROM tok WHERE word IN (SELECT word FROM tmpl UNION SELECT word FROM phr)),
df AS (SELECT word, count(DISTINCT rid) AS df FROM lic GROUP BY word),
wt AS (SELECT tmpl.*, coalesce(df, 0) AS df, ln(((SELECT count(*) FROM doc) + 1)::DOUBLE / (coalesce(df, 0) + 1)) + 1.0 AS weight
       FROM tmpl LEFT JOIN df USING (word)),
keyed AS (SELECT rid, tid, pos - j AS s FROM lic JOIN tkey USING (word) GROUP BY rid, tid, n, s HAVING count(*) = n),
matched AS (
  SELECT v.rid, v.tid, v.s, sum(wt.weight) AS got
  FROM keyed v JOIN wt ON wt.tid = v.tid JOIN lic ON lic.rid = v.rid AND lic.pos = v.s + wt.j AND lic.word = wt.word GROUP BY ALL),
total AS (SELECT tid, sum(weight) AS total FROM wt GROUP BY tid),
scored AS (SELECT rid, tid, max(got / total) AS score FROM matched JOIN total USING (tid) GROUP BY ALL),
places AS (SELECT rid, pid, label, pos - j AS s FROM lic JOIN phr USING (word) GROUP BY rid, pid, label, n, s HAVING count(*) = n),
pl AS (SELECT rid, count(*) AS n_base, min(s) AS first_word, max(s) AS last_word FROM places GROUP BY rid),
bl AS (SELECT rid, string_agg(label, ',' ORDER BY label) AS base_labels FROM (SELECT DISTINCT rid, label FROM places) GROUP BY rid),
al AS (SELECT rid, string_agg(label, ',' ORDER BY label) AS labels FROM (
         SELECT rid, label FROM places UNION SELECT rid, label FROM scored JOIN (SELECT DISTINCT tid, label FROM tmpl) USING (tid)) GROUP BY rid),
sc AS (SELECT rid, max(score) AS score FROM (SELECT rid, score FROM scored UNION ALL SELECT rid, 1.0 FROM places) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       round(coalesce(score, 0), 6)::DOUBLE AS score
FROM doc LEFT JOIN pl USING (rid) LEFT JOIN bl USING (rid) LEFT JOIN al USING (rid) LEFT JOIN sc USING (rid)"""
