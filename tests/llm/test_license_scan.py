"""The posting table of the license scan against plain Python."""

import random
import re

import pytest

from kestrel.llm import license_scan
from kestrel.llm.license_scan import Template
from tests.llm import data, reference

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def shifts_of(template):
    words = template.text.split()
    return [next(j for j in range(len(words)) if words[j:j + len(k.split())] == k.split()) for k in template.keys]


def labels_of(text, templates, base, shifts):
    """Labels and base places by looking at every word of the text."""
    words = WORD.findall((text or "").translate(reference.LOWER))

    def places(phrase):
        phrase = phrase.split()
        return [k for k in range(len(words) - len(phrase) + 1) if words[k:k + len(phrase)] == phrase]

    def aligned(t, shift):
        return set.intersection(*[{p - at for p in places(k)} for k, at in zip(t.keys, shift)])

    found = sorted(p for phrase, _ in base for p in places(phrase))
    base_labels = {label for phrase, label in base if places(phrase)}
    return (len(words), len(found), found[0] if found else None, found[-1] if found else None, ",".join(sorted(base_labels)),
            ",".join(sorted(base_labels | {t.label for t, shift in zip(templates, shifts) if aligned(t, shift)})))


def check(spark, texts, templates=license_scan.TEMPLATES, base=license_scan.BASE_PHRASES):
    docs = data.documents(spark, [(i, t, None, None, None) for i, t in enumerate(texts)])
    got = {r.doc_id: r for r in license_scan.scan(docs, templates, base).collect()}
    shifts = [shifts_of(t) for t in templates]
    assert {i: tuple(r)[1:7] for i, r in got.items()} == {i: labels_of(t, templates, base, shifts) for i, t in enumerate(texts)}
    assert all(0 <= r.score <= 1 and (r.score > 0) == bool(r.labels) for r in got.values())
    return got


def test_every_template_by_its_phrase_alone(spark):
    """Key phrases without the rest of their notice, in a corpus where all their
    words are frequent."""
    rng = random.Random(2)
    common = sorted({w for t in license_scan.TEMPLATES for w in t.text.split()})
    texts = [" ".join(rng.choices(common, k=60)) for _ in range(60)]
    for t in license_scan.TEMPLATES:
        texts += [t.keys[0], t.text, "Some file. " + t.keys[0].upper() + "!", t.text[:-1], " ".join(t.keys[0].split()[1:])]
    texts += [None, "", "# no words #", "apache apache license mit mit license license"] + [r[1] for r in data.rows()]
    got = check(spark, texts)
    assert len(license_scan.TEMPLATES) >= 50
    assert {x for r in got.values() for x in r.labels.split(",") if x} >= {t.label for t in license_scan.TEMPLATES}


def test_full_texts_and_several_keys(spark):
    """Hundreds of long templates: same plan, notices cut at either end."""
    rng = random.Random(6)
    templates, texts = [], []
    for k in range(300):
        words = data.words(rng, 400)
        keys = (" ".join(words[100:106]), " ".join(words[300:304]), words[350])
        templates.append(Template(f"own-{k:03}", " ".join(words), keys))
        if k % 30 == 0:
            texts += [" ".join(words), " ".join(words[90:]), "x " + " ".join(words[:360]), " ".join(words[:320]), " ".join([*words[:200], "x", *words[200:]])]
    base = [("ka", "one-word"), ("lo lo", "twice")]
    got = check(spark, texts, templates, base)
    assert "own-000" in got[0].labels and got[0].score == 1.0
    assert 0.5 < got[1].score and "own-000" in got[1].labels and "own-000" not in got[3].labels and "own-000" not in got[4].labels
    docs = data.documents(spark)
    size = lambda ts: license_scan.scan(docs, ts)._jdf.queryExecution().analyzed().expressions().size()
    assert size(templates) == size(templates[:1])


def test_no_templates_and_bad_ones(spark):
    docs = data.documents(spark)
    assert {(r.labels, r.score) for r in license_scan.scan(docs, (), ()).collect()} == {("", 0.0)}
    for bad in (Template("a", "one two", ("two one",)), Template("a", "one two", ()), Template("a", "one two", (" ",))):
        with pytest.raises(ValueError):
            license_scan.scan(docs, [bad])
