"""License scans against plain Python."""

import brute
import pytest
from pyspark.sql import functions as F

from cohortwatch.llm import license_scan
from cohortwatch.llm.license_scan import NOTICES, PHRASES, Template


def phrases(text, templates=PHRASES):
    """Number of words, and (start, label) of each place of a phrase."""
    w = brute.words(text, brute.ALNUM)
    found = []
    for t in templates:
        x = brute.words(t.text, brute.ALNUM)
        found += [(i, t.label) for i in range(len(w) - len(x) + 1) if w[i : i + len(x)] == x]
    return len(w), sorted(found)


def expected(text):
    n, found = phrases(text)
    return n, len(found), *((found[0][0], found[-1][0]) if found else (None, None)), ",".join(sorted({x for _, x in found}))


def scanned(df, *args, **more):
    rows = license_scan.scan(df, *args, **more).collect()
    assert all(set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1 and (r.score > 0) == (r.labels != "") for r in rows)
    return sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows), key=repr)


def test_phrases_of_all_documents(documents, texts):
    got = scanned(documents)
    assert got == sorted(((k, *expected(t)) for k, t in texts), key=repr) and sum(r[2] for r in got) > 0


@pytest.mark.parametrize("block", [1 << 16, 7])
def test_places_and_long_texts(spark, monkeypatch, block):
    monkeypatch.setattr(license_scan, "BLOCK", block)
    texts = ["CC-BY-NC", "cc by", "", None, " - ", "cc by nc " * 3000 + "under the MIT License", "Under the, under THE mit (license) apache License, Version 2.0 CC BY-NC cc", "under the mit", "xcc by nc", "cc by ncé", "w " * 70_000 + "cc by nc"]
    rows = [(i, t) for i, t in enumerate(texts)]
    assert scanned(spark.createDataFrame(rows, "doc_id long, text string")) == sorted(((k, *expected(t)) for k, t in rows), key=repr)


def test_messy_rows(messy):
    df = messy
    for name in ("part", "gram", "template", "label", "words", "copies", "span", "first", "n_base"):
        df = df.withColumn(name, F.lit("x"))
    df = df.unionAll(df)
    assert scanned(df) == sorted(((r.doc_id, *expected(r.text)) for r in df.select("doc_id", "text").collect()), key=repr)
    assert scanned(df.limit(0)) == []


def test_edited_notices_are_found(spark):
    found = {}
    for t in NOTICES:
        w = brute.words(t.text, brute.ALNUM)
        own = "before it " + " ".join(w) + " behind it"
        put_in = "x y " + " ".join(w[:4]) + " two more " + " ".join(w[4:]) + " z"
        part = "x y " + " ".join(w[: len(w) // 2]) + " z"
        apart = " ".join(f"{a} " + "far " * 30 for a in [" ".join(w[: len(w) // 2]), " ".join(w[len(w) // 2 :])])
        for kind, text in (("own", own), ("put in", put_in), ("part", part), ("apart", apart)):
            found[len(found)] = (t, kind, text, w)
    df = spark.createDataFrame([(k, v[2]) for k, v in found.items()], "doc_id long, text string")
    spans = {(r.doc_id, r.label): r for r in license_scan.matches(df).where("not exact").collect()}
    for k, (t, kind, _, w) in found.items():
        grams = len(w) - 2
        if kind == "own":
            r = spans[k, t.label]
            assert (r.first_word, r.last_word, r.score) == (2, 1 + len(w), 1.0)
        elif kind == "put in" and 100 * (grams - 2) >= 80 * grams:
            r = spans[k, t.label]
            assert (r.first_word, r.last_word) == (2, 3 + len(w)) and abs(r.score - (grams - 2) / grams) < 1e-9
        else:
            assert (k, t.label) not in spans


def test_long_template_and_short_one(spark):
    long = Template("long", " ".join(f"w{i}" for i in range(500)))
    df = spark.createDataFrame([(1, long.text), (2, " ".join(long.text.split()[60:480])), (3, " ".join(long.text.split()[:300]))], "doc_id long, text string")
    assert {(r.doc_id, r.labels, round(r.score, 3)) for r in license_scan.scan(df, [long]).collect()} == {(1, "long", 1.0), (2, "long", round(418 / 498, 3)), (3, "", 0.0)}
    with pytest.raises(ValueError, match="needs 3 words"):
        license_scan.scan(df, [Template("short", "two words")])
