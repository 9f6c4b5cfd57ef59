"""Quality rules, token counts, token files, language, decontamination."""

import hashlib
import time
import zlib

import brute
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortwatch.llm import _text, decontaminate, language_id, quality, token_count, token_output

public_tokenizers = pytest.importorskip("public_tokenizers")
PIECES, WORDS = str(public_tokenizers.path("piece_bpe_32k.model")), str(public_tokenizers.path("word_bpe_49k.json"))
ODD = st.text(st.sampled_from("aAb'sé漢 \n\t ̈　▁|<>endoftext0İΣς"), max_size=60)


def test_quality_measures(documents, texts):
    got = {r.doc_id: r for r in quality.judge(documents.select("doc_id", "text")).collect()}
    for k, t in texts:
        r = got[k]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute.quality(t)
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.kept and r.base_failed)


def test_order_changes_no_verdict(documents):
    plan = quality.plan(documents)
    assert {r.name for r, _, _ in plan} == {r.name for r in (*quality.BASE, *quality.RULES)} and all(0 <= share <= 1 for _, _, share in plan)
    slow = quality.Rule("slow", ("n_words",), lambda v: np.zeros(v.chunk.n_docs, bool))
    all_ = quality.Rule("all", ("n_words",), lambda v: np.ones(v.chunk.n_docs, bool))
    assert [r.name for r, _, _ in quality.plan(documents, (slow, all_))] == ["all", "slow"]
    assert len(quality.plan(documents.limit(0))) == len(plan)
    text = quality.judge(documents.select("doc_id", "text"))._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in text and "Limit" not in text
    verdicts = [sorted((r.doc_id, r.kept) for r in quality.judge(documents, rules, report=()).select("doc_id", "kept").collect()) for rules in (quality.RULES, quality.RULES[::-1])]
    assert verdicts[0] == verdicts[1]


def test_later_rules_see_only_what_is_left():
    chunk = next(_text.chunks(pa.array(["one two three four five six seven eight nine ten"] * 3 + ["| " * 20])))
    seen = []
    rule = quality.Rule("spy", ("n_words",), lambda v: seen.append(v.chunk.n_docs) or np.zeros(v.chunk.n_docs, bool))
    view = quality.View(chunk)
    rule.rejects(view.only(~quality.BASE[0].rejects(view) & ~quality.BASE[1].rejects(view)))
    assert seen == [3]


def test_letters_are_letters_only():
    chunk = next(_text.chunks(pa.array(["aé漢😀。1 b", ""])))
    assert quality.View(chunk).n_letters.tolist() == [4, 0]


def test_quality_of_messy_rows(messy):
    rows = quality.judge(messy)
    assert rows.count() == messy.count() and rows.where("text is null and not base_failed").count() == 0
    kept = quality.keep_good(messy)
    assert kept.columns == messy.columns and kept.where("text is null or trim(text) = ''").count() == 0
    assert quality.judge(messy.limit(0)).count() == 0 and quality.keep_good(messy.limit(0)).count() == 0


def test_token_counts(documents, texts, messy):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = {r.doc_id: r for r in token_count.count_tokens(documents.select("doc_id", "text"), PIECES, huge=2000, chunk=700, overlap=40).collect()}
    for k, t in texts:
        n = len(model.encode(t or ""))
        assert (got[k].n_tokens, got[k].n_bytes, got[k].over_limit) == (n, len((t or "").encode()), n > 4096)
    rows = token_count.count_tokens(messy, PIECES)
    assert rows.count() == messy.count() and {r.n_tokens for r in rows.where("text is null").collect()} == {0}
    assert token_count.count_tokens(messy.limit(0), PIECES).count() == 0


def test_long_texts_are_spliced(spark):
    counter = token_count.Counter(PIECES)
    long = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("octet_length(text) > 16384").collect()]
    assert counter.proven and len(long) >= 5 and counter.huge == 1 << 14
    assert counter.count(long) == [counter.spliced(t.encode()) for t in long] == [len(counter.model.encode(t)) for t in long]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["word", " ", "  ", "\n", "é", "▁", "x" * 90, "the cat ", "漢字"]), max_size=120).map("".join), st.integers(16, 80), st.integers(4, 20))
def test_spliced_counts_are_whole_counts(text, chunk, overlap):
    counter = _counters.setdefault("c", token_count.Counter(PIECES))
    counter.huge, counter.chunk, counter.overlap = 20, chunk, overlap
    assert counter.spliced(text.encode()) == len(counter.model.encode(text)) if text else True


_counters: dict = {}


@settings(max_examples=200, deadline=None)
@given(st.lists(ODD, max_size=5))
def test_word_by_word_ids_are_whole_text_ids(texts):
    encoder = token_output.encoder(WORDS)
    assert encoder.by_word
    got = [list(ids[a:b]) for ids, first in encoder.encode(pa.array(texts, pa.string())) for a, b in zip(first, first[1:])]
    assert got == [encoder.library.encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1).map(lambda x: x >> (x % 25)), max_size=70))
def test_packed_numbers_come_back(values):
    values = np.array(values, np.uint32)
    control, data = token_output.pack(values)
    assert len(control) == -(-len(values) // 4) and (token_output.unpack(control, data, len(values)) == values).all()


def test_forgetting_words_changes_nothing(monkeypatch):
    monkeypatch.setattr(token_output, "KNOWN_WORDS", 6)
    monkeypatch.setattr(token_output, "SLICE", 4)
    encoder = token_output.Encoder(WORDS)
    texts = [" ".join(f"w{i % 11}x" for i in range(k, k + 9)) for k in range(12)]
    got = [list(ids[a:b]) for ids, first in encoder.encode(pa.array(texts)) for a, b in zip(first, first[1:])]
    assert got == [encoder.library.encode(t, add_special_tokens=False).ids for t in texts]


def test_token_files(spark, documents, texts, messy, tmp_path, monkeypatch):
    monkeypatch.setattr(token_output, "BLOCK_IDS", 3000)
    token_output.write_ids(documents, f"file://{tmp_path}/a", WORDS, 2)
    got = sorted(token_output.read_ids(spark, f"file://{tmp_path}/a").collect())
    library, start = token_output.encoder(WORDS).library, 0
    for r, (k, t) in zip(got, texts, strict=True):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        assert (r.doc_id, r.start, r.n_tokens, r.ids) == (k, start, len(ids), ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    token_output.write_ids(messy, f"file://{tmp_path}/b", WORDS, 2)
    got = token_output.read_ids(spark, f"file://{tmp_path}/b", False).orderBy("start").collect()
    assert len(got) == messy.count() and [r.doc_id for r in got] == sorted((r.doc_id for r in got), key=lambda x: (x is not None, x))
    token_output.write_ids(messy.limit(0), f"file://{tmp_path}/c", WORDS, 2)
    assert token_output.read_ids(spark, f"file://{tmp_path}/c").count() == 0


def test_language(documents, messy):
    from pyspark.sql import functions as F

    docs = documents.withColumn("held_out", language_id.held_out(F.col("doc_id")))
    prototypes = language_id.learn(docs.where("not held_out"))
    found = language_id.identify(docs, prototypes).collect()
    held = [r for r in found if r.held_out and r.lang]
    assert sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held) > 40
    assert all(0 <= r.score <= 1 for r in found)
    rows = language_id.identify(messy, prototypes)
    assert rows.count() == messy.count() and {r.lang_pred for r in rows.where("text is null or trim(text) = ''").collect()} == {"und"}
    assert {r.lang_pred for r in language_id.identify(messy, language_id.learn(messy.limit(0))).collect()} == {"und"}


def test_language_scores_are_those_of_bundles():
    texts = pa.array(["Ein Haus am See", "the house", "12 34", "x"])
    chunk = next(_text.chunks(texts))
    codes, doc, has = language_id.trigrams(chunk)
    assert list(has) == [True, True, False, True]
    as_text = ["".join(chr(c >> s & 0x1FFFFF) for s in (42, 21, 0)) for c in codes[doc == 0]]
    assert as_text == [" ei", "ein", "in ", " ha", "hau", "aus", "us ", " am", "am ", " se", "see", "ee "]
    bundles = [language_id.bundle(*np.unique(codes[doc == d], return_counts=True)) for d in range(4)]
    prototypes = {"de": bundles[0], "en": bundles[1]}
    names, scores = language_id.Classifier(prototypes).predict(chunk)
    assert names[:3] == ["de", "en", "und"] and scores[2] == 0
    for d in (0, 1):
        cosine = bundles[d] @ bundles[d] / np.linalg.norm(bundles[d]) ** 2
        assert abs(scores[d] - cosine) < 1e-4


def check_contamination(rows, texts, items):
    for k, t in texts:
        n, hit, found = brute.contamination(t, items)
        r = rows[k]
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256) == (n, hit, len(found), hashlib.sha256(",".join(found).encode()).hexdigest())
        assert sum(s["last"] - s["first"] + 1 for s in r.spans) == hit


@pytest.mark.parametrize("bound", [decontaminate.BROADCAST_WORDS, 10])
def test_decontamination(spark, texts, bound):
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    items = [(r.item_id, r.text) for r in benchmark.collect()]
    w = brute.words(texts[0][1], brute.ALNUM)
    items += [(900, " ".join(w[3:8])), (901, " ".join(w[3:8]).upper()), (902, None), (903, ""), (904, " ".join(w[20:33])), (905, " ".join(w[5:11]))]
    extra = [(1000, " ".join(w[20:33])), (1001, " ".join(w[20:32])), (1002, " ".join(w[3:8])), (1003, None), (1004, "")]
    docs = spark.createDataFrame([*texts, *extra], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = {r.doc_id: r for r in decontaminate.decontaminate(docs, bench, broadcast_words=bound).collect()}
    assert len(rows) == len(texts) + len(extra)
    check_contamination(rows, [*texts, *extra], items)
    kept = {r.doc_id for r in decontaminate.remove_contaminated(docs, bench, broadcast_words=bound).collect()}
    assert kept == {k for k, r in rows.items() if not (r.n_hit and 20 * r.n_hit >= r.n_words)}


def test_decontamination_of_messy_rows(spark, messy):
    bench = messy.selectExpr("cast(null as long) as item_id", "text").union(messy.selectExpr("doc_id", "text").where("doc_id = 4"))
    assert decontaminate.decontaminate(messy, bench).where("n_hit > 0").count() == 0
    kept = decontaminate.remove_contaminated(messy, messy.selectExpr("doc_id as item_id", "text").where("doc_id = 1"))
    assert kept.columns == messy.columns and {r.doc_id for r in kept.collect()} == {3, None, 4, 5, 6, 7}
    assert decontaminate.decontaminate(messy.limit(0), bench).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=60), st.lists(st.integers(0, 5), max_size=60), st.lists(st.integers(0, 5), min_size=13, max_size=13))
def test_winnowing_finds_every_long_shared_span(before, behind, span):
    mixed = _text.mix(np.arange(1, 7, dtype=np.uint64))
    texts = [mixed[np.array([*before, *span], int)], mixed[np.array([*span, *behind], int)]]
    kept = []
    for t in texts:
        grams, at = _text.ngrams(t, np.array([0, len(t)]), 7)
        one = decontaminate.winnow(grams, 7)
        assert list(one) == list(decontaminate.winnow_many(grams, at, np.array([0, len(t)]), 7, 7))
        kept.append(set(grams[one]))
    assert kept[0] & kept[1]


@pytest.mark.parametrize("bound", [decontaminate.BROADCAST_WORDS, 10])
def test_decontamination_of_periodic_texts(spark, bound):
    """Repeated words and passages in documents and items, equal items, and an item inside others."""
    cycle = " ".join(f"c{k}" for k in range(9))
    items = [(1, "a " * 40), (2, "A " * 40), (3, f"{cycle} " * 6), (4, "a a a"), (5, "x " + "a " * 14), (6, "b " * 13), ("7,8", "a " * 40)]
    texts = ["a " * 60, "a " * 12, "a a", f"{cycle} " * 3, "y " + f"{cycle} " * 2 + "a a a y", "b " * 12 + "a " + "b " * 14, "x " + "a " * 13, None, "a b " * 30]
    docs, bench = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), spark.createDataFrame([(str(k), t) for k, t in items], "item_id string, text string")
    rows = {r.doc_id: r for r in decontaminate.decontaminate(docs, bench, broadcast_words=bound).collect()}
    check_contamination(rows, list(enumerate(texts)), items)


def test_decontamination_of_one_word_thirty_thousand_times(spark):
    docs, bench = spark.createDataFrame([(1, "w " * 30_000), (2, "v " * 30_000)], "doc_id long, text string"), spark.createDataFrame([(1, "w " * 30_000)], "item_id long, text string")
    for bound in (decontaminate.BROADCAST_WORDS, 10):
        began = time.perf_counter()
        rows = {r.doc_id: (r.n_words, r.n_hit, r.n_items) for r in decontaminate.decontaminate(docs, bench, broadcast_words=bound).collect()}
        assert rows == {1: (30_000, 30_000, 1), 2: (30_000, 0, 0)} and time.perf_counter() - began < 60


def plain_vector(gram, dimensions):
    """A trigram's vector from its letters' signs, in whole numbers of Python alone."""
    mask = (1 << 64) - 1

    def mixed(x):
        for shift, times in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
            x = (x ^ (x >> shift)) * times & mask
        return x

    def sign(letter, j):
        return 1 if mixed(mixed(ord(letter) + 1) ^ (j * 0x9E3779B97F4A7C15 & mask)) >> 63 else -1

    return [sign(gram[0], (j - 2) % dimensions) * sign(gram[1], (j - 1) % dimensions) * sign(gram[2], j) for j in range(dimensions)]


def test_languages_against_plain_vectors(spark, monkeypatch):
    """Predictions and scores, with all prototypes at once and in blocks, against sums of vectors made letter by letter."""
    dimensions, known = 128, {}
    learnt = [("de", "der Hund und die Katze"), ("de", "das Haus"), ("en", "the dog and the cat"), ("fr", "le chien et le chat"), ("es", "el perro y el gato"), ("xx", "zzz"), (None, "no label")]
    texts = ["die Katze", "the CAT, the dog", "chat", "gato 12", "Zz", "q", "", None, "12 -", "é漢"]

    def profile(text):
        total = np.zeros(dimensions)
        line = " " + " ".join("".join(c.lower() if c.isalpha() else " " for c in text).split()) + " "
        for k in range(len(line) - 2):
            if line[k + 1] != " ":
                total += known.setdefault(line[k : k + 3], np.array(plain_vector(line[k : k + 3], dimensions)))
        return total

    prototypes = {k: sum(profile(t) for lang, t in learnt if lang == k) for k in sorted({lang for lang, _ in learnt if lang})}
    want = []
    for t in texts:
        v = profile(t or "")
        near = {k: float(v @ p / np.linalg.norm(v) / np.linalg.norm(p)) for k, p in prototypes.items()} if v.any() else {}
        want.append((max(near, key=near.get), min(1.0, max(0.0, max(near.values())))) if near else ("und", 0.0))
    train, docs = spark.createDataFrame(learnt, "lang string, text string"), spark.createDataFrame(list(enumerate(texts)), "n long, text string").withColumn("score", F.lit("own"))
    for most in (language_id.MAX_LANGUAGES, 4):
        monkeypatch.setattr(language_id, "MAX_LANGUAGES", most)
        found = language_id.learn(train, dimensions=dimensions)
        assert isinstance(found, dict) == (most > 4)
        got = sorted(language_id.identify(docs, found, dimensions=dimensions).collect())
        assert [r.lang_pred for r in got] == [k for k, _ in want] and all(abs(r.score - s) < 1e-5 for r, (_, s) in zip(got, want))
