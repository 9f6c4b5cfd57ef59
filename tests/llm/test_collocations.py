"""Phrase mining against plain Python."""

import re
from collections import Counter, defaultdict

import brute
import pytest
from pyspark.sql import functions as F

from cohortwatch.llm import collocations


def mined(docs, least, top, share=50):
    """Rows (lang, rank, phrase, a, l, r, n, score) of (text, lang)."""
    f = defaultdict(Counter)
    for text, lang in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(brute.LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            f[lang or "und"].update(tuple(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    out = []
    for lang, count in f.items():
        n = sum(v for g, v in count.items() if len(g) == 1)
        taken = {g: a for g, a in count.items() if len(g) > 1 and a >= least}
        longest = Counter()
        for g, a in taken.items():
            if len(g) == 3:
                for part in (g[:2], g[1:]):
                    longest[part] = max(longest[part], a)
        rows = []
        for g, a in taken.items():
            if len(g) == 2 and longest[g] and 100 * longest[g] >= share * a:
                continue
            score, _, left, right = min((10**6 * a * a // (count[g[:j]] * count[g[j:]]), j, count[g[:j]], count[g[j:]]) for j in range(1, len(g)))
            rows.append((-score, -a, " ".join(g).encode(), left, right))
        out += [(lang, k, p.decode(), -a, left, right, n, -s) for k, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


def found(df, least, top, share=50):
    rows = collocations.collocations(df, least=least, top=top, share=share)
    return sorted(tuple(r) for r in rows.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("least, top, share", [(10, 2000, 50), (2, 12, 50), (3, 40, 90)])
def test_growth_equals_full_counts(documents, least, top, share):
    got = found(documents, least, top, share)
    assert got == mined([(r.text, r.lang) for r in documents.select("text", "lang").collect()], least, top, share) and got


def test_a_wave_leaves_low_bounds_out(documents, monkeypatch):
    """With few phrases wanted a language is settled before all its triples are counted."""
    waves = []
    count = collocations._count_triples
    monkeypatch.setattr(collocations, "_count_triples", lambda tables, wave: waves.append(wave) or count(tables, wave))
    found(documents, 2, 12)
    assert max(waves) < collocations.WAVES - 1
    waves.clear()
    found(documents, 10, 100_000)
    assert max(waves) == 0  # nothing is beyond the list's end


def test_odd_texts(spark, messy):
    rows = [("a b, a b\ta  b\na b;A B", "x"), ("a b", None), (None, "x"), ("", "x"), (" .,; ", None), ("b" * 70_000 + " b " + "a b c " * 30_000, "y"), ("é ü é ü é ü", "x"), ("é ü b", "x")]
    df = spark.createDataFrame(rows * 2, "text string, lang string")
    for name in ("l", "h", "n", "score", "rank", "word"):
        df = df.withColumn(name, F.lit("x"))
    for least, top in ((2, 3), (1, 100)):
        assert found(df, least, top) == mined([(r.text, r.lang) for r in df.select("text", "lang").collect()], least, top)
    assert found(messy, 2, 50) == mined([(r.text, r.lang) for r in messy.select("text", "lang").collect()], 2, 50)
    assert found(df.limit(0), 2, 10) == [] and found(df.where("text is null"), 2, 10) == []


def test_scores_are_exact_beyond_64_bits(spark):
    a, left, right = 10**13 + 7, 10**13 + 9, 10**13 + 11
    row = spark.createDataFrame([(a, left, right)], "a long, l long, r long")
    assert row.select(collocations._ratio(F.col("a"), F.col("a"), F.col("l"), F.col("r"))).first()[0] == 10**6 * a * a // (left * right)
