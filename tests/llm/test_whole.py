"""Cases in which one partner, one pass or one kind of key is not enough."""

import difflib
import random
from collections import defaultdict

import brute
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortwatch.llm import _spark, line_dedup, passage_dedup


def words(rng, n):
    return [f"{rng.choice('bcdfghklmnprst')}{rng.choice('aeiou')}{rng.randrange(10**6)}" for _ in range(n)]


def test_passages_whose_first_and_last_holders_are_short_quotes(spark):
    rng = random.Random(3)
    rows = []
    for case in range(5):
        run = words(rng, 60)
        quotes = lambda: [w for k in (0, 8, 16, 24) for w in (*words(rng, 30), *run[k : k + 36])]
        rows += [(100 * case + k, " ".join(words(rng, 40) + t + words(rng, 40))) for k, t in ((0, quotes()), (10, run), (50, run), (99, quotes()))]
    got = passage_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    for case in range(5):
        found = {(r.doc_id % 100, r.removed) for r in got if r.doc_id // 100 == case and r.n_words >= 60}
        assert found >= {(10, False), (50, True)}, case


def test_open_pairs_of_similar_paragraphs_are_compared(spark):
    rng = random.Random(4)
    run = words(rng, 200)
    # All copies change one word in 25: first and last holders share 50 words with few of the others.
    copies = [[w if rng.random() > 0.04 else words(rng, 1)[0] for w in run] for _ in range(60)]
    rows = [(k, " ".join(words(rng, 30) + t)) for k, t in enumerate(copies)]
    got = passage_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    covered = {(r.doc_id, i) for r in got for i in range(r.first_word, r.last_word + 1)}
    for a in range(60):
        for b in range(a):
            for i in range(151):
                if copies[a][i : i + 50] == copies[b][i : i + 50]:
                    held = {(d, 30 + i + k) for d in (a, b) for k in range(17, 33)}
                    assert held <= covered, (a, b, i)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 4), min_size=1, max_size=20), st.lists(st.integers(0, 4), min_size=1, max_size=20))
def test_longest_run(a, b):
    x, y, n = line_dedup.longest_run(a, b)
    assert a[x : x + n] == b[y : y + n]
    assert n == max(k for k in range(21) if any(a[p : p + k] == b[q : q + k] for p in range(len(a) - k + 1) for q in range(len(b) - k + 1)))


def test_patience_aligns_repeated_lines():
    for a, b in (([1, 7, 8, 9, 2, 7, 8, 9, 3], [4, 7, 8, 9, 5]), ([4, 7, 8, 9, 5], [1, 7, 8, 9, 2, 7, 8, 9, 3])):
        assert [n for _, _, n in line_dedup.patience(a, b)] == [3]


def table(spark, rows):
    return spark.createDataFrame([(k, t if isinstance(t, str) else "\n".join(t)) for k, t in rows], "doc_id long, text string")


def deleted(blocks):
    gone = defaultdict(set)
    for r in blocks.collect():
        gone[r.doc_id] |= set(range(r.first_line, r.last_line + 1))
    return gone


def test_lines_in_another_order_go_too(spark, monkeypatch):
    monkeypatch.setattr(_spark, "HOT_KEYS", 3)
    line = lambda *k: ["five words of line number " + str(x) for x in k]
    gone = deleted(line_dedup.aligned_blocks(table(spark, [(1, line(30, 20, 12, 11, 10, 9, 8, 7)), (2, line(40, *range(7, 13))), (3, line(50, *range(7, 13), 51, 7))])))
    assert gone == {2: set(range(1, 7)), 3: {*range(1, 7), 8}}


def test_equal_documents_whose_lines_stand_first_elsewhere(spark):
    one, two = "the first line of five words", "another line of these five words"
    same = [one, "a b", "c d", "e f g", two]
    gone = deleted(line_dedup.aligned_blocks(table(spark, [(1, ["own 1", one]), (2, [two, "own 2"]), (3, same), (4, same)])))
    assert gone == {3: {0, 4}, 4: {0, 1, 2, 3, 4}}


def test_rows_with_one_id_are_documents_of_their_own(spark):
    x, y, z = ("line of five words " + c for c in "xyz")
    docs = table(spark, [(1, [x, y]), (1, [z]), (2, [x]), (2, [z, "own"]), (2, [z, "own"])])
    cut = line_dedup.delete_blocks(docs, line_dedup.aligned_blocks(docs))
    assert sorted((r.doc_id, r.text) for r in cut.collect()) == sorted([(1, x + "\n" + y), (1, z), (2, ""), (2, "own"), (2, "own")])


def test_lines_against_an_independent_diff_of_all_pairs(documents, texts):
    gone = deleted(line_dedup.aligned_blocks(documents))
    lines = {k: (t or "").split("\n") for k, t in texts}
    size = {x: len(brute.SPACE.findall(x)) for own in lines.values() for x in own}
    found = 0
    for k, own in lines.items():
        for h in lines:
            if h < k and set(own) & set(lines[h]):
                for p, _, n in difflib.SequenceMatcher(None, own, lines[h], False).get_matching_blocks():
                    if sum(size[x] for x in own[p : p + n]) >= line_dedup.MIN_WORDS:
                        wordy = {i for i in range(p, p + n) if size[own[i]]}
                        found += len(wordy)
                        assert wordy <= gone[k], (k, h, p, n)
    assert found


def test_blocks_of_short_lines(spark):
    verse = [f"word{k} of a list" for k in range(30)]
    rows = [(1, ["first own", *verse, "first end"]), (2, ["second own", *verse[:12], "", *verse[12:], "second end"]), (3, ["a b", "c", "d e", "x"]), (4, ["u v", "a b", "c", "d e"]), (5, ["u v", "own 5"])]
    got = {tuple(r) for r in line_dedup.aligned_blocks(table(spark, rows)).drop("row_hash").collect()}
    assert got == {(2, 1, 1, 12, 1, 48), (2, 1, 14, 31, 13, 72), (4, 3, 1, 3, 0, 5)}


def test_common_runs_hold_equal_picks():
    rng = np.random.default_rng(6)
    for vocabulary in (3, 60, 2**62):
        for _ in range(300):
            n, w = int(rng.integers(1, 20)), int(rng.integers(1, 20))
            run = rng.integers(0, vocabulary, n + w - 1).astype(np.uint64)
            picks = []
            for _ in range(2):
                a, b = (rng.integers(0, vocabulary, rng.integers(0, 30)).astype(np.uint64) for _ in "ab")
                words = np.concatenate([a, run, b])
                grams = passage_dedup._grams(words, n)
                at = passage_dedup.winnow(grams, passage_dedup._inside(len(grams), np.array([0, len(words)]), n), w)
                picks.append({int(p) - len(a) for p in at if len(a) <= p <= len(a) + w - 1})
            assert picks[0] & picks[1]


def test_recall_of_edited_paragraphs(spark):
    """Edited lines and groups of short lines between other lines: all but a few with Jaccard 0.8 or more are linked."""
    rng = random.Random(9)
    rows, want = [], []
    for k in range(400):
        lines = [words(rng, rng.randrange(60, 160))] if k % 2 else [words(rng, rng.randrange(8, 30)) for _ in range(6)]
        other = [list(x) for x in lines]
        for _ in range(rng.randrange(1, 5)):
            x = rng.choice(other)
            x[rng.randrange(len(x))] = "changed" + str(rng.randrange(10**6))
        around = lambda: [words(rng, rng.randrange(50, 90)) for _ in range(2)]
        a, b = ("\n".join(" ".join(x) for x in group) for group in (lines, other))
        x, y = brute.shingles(a), brute.shingles(b)
        if len(x & y) >= 0.8 * len(x | y):
            want.append(k)
        before, behind = around()
        rows.append((2 * k, "\n".join([" ".join(before), a, " ".join(behind)])))
        before, behind = around()
        rows.append((2 * k + 1, "\n".join([" ".join(before), b, " ".join(behind)])))
    got = passage_dedup.repeated_passages(table(spark, rows)).where("removed").collect()
    found = {r.doc_id // 2 for r in got if r.kept_doc_id == r.doc_id - 1}
    assert all(r.doc_id // 2 == r.kept_doc_id // 2 for r in got)
    assert len(want) > 200 and len(set(want) & found) >= 0.95 * len(want), (len(want), len(set(want) & found))


def test_passages_on_whole_table(documents, texts):
    got = passage_dedup.repeated_passages(documents)
    rows, found = [x for x in texts if x[1]], {r.doc_id for r in got.collect()}
    assert brute.repeats(rows, 50) <= found
    assert not brute.repeats([(r.doc_id, r.text) for r in passage_dedup.delete_passages(documents, got).collect()], 50)


def test_passages_of_rows_with_one_id(spark, monkeypatch):
    monkeypatch.setattr(_spark, "HOT_KEYS", 3)
    rng = random.Random(10)
    a, b, c = (" ".join(words(rng, 70)) for _ in range(3))
    docs = table(spark, [(1, a), (1, b), (2, a + "\nown"), (3, b), (3, b), (4, c + " " + c), (None, c)])
    cut = passage_dedup.delete_passages(docs, passage_dedup.repeated_passages(docs))
    assert sorted((r.doc_id or 0, r.text) for r in cut.collect()) == sorted([(1, a), (1, b), (2, "own"), (3, ""), (3, ""), (4, c + " " + c), (0, c)])


def _sequence(lines):
    return np.array([x + 1 for x in lines], np.uint64) * np.uint64(0x9E3779B97F4A7C15), np.array([x % 4 for x in lines], np.int32)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 9), max_size=40), st.lists(st.integers(0, 9), max_size=40))
def test_alignments_reach_every_common_run(a, b):
    """Blocks are common and long enough, and every run that the kept document holds is covered by them."""
    (h, words), (kept, kept_words) = _sequence(a), _sequence(b)
    gone = set()
    for p, q, n, w in line_dedup.common_blocks(h, words, kept, kept_words):
        assert (h[p : p + n] == kept[q : q + n]).all() and w == words[p : p + n].sum() >= line_dedup.MIN_WORDS
        gone |= set(range(p, p + n))
    keys, start, end = line_dedup._runs(h, words, np.array([0, len(h)]), line_dedup.MIN_WORDS)
    known = set(line_dedup._runs(kept, kept_words, np.array([0, len(kept)]), line_dedup.MIN_WORDS)[0].tolist())
    for k, s, e in zip(keys.tolist(), start.tolist(), end.tolist()):
        assert k not in known or set(range(s, e)) <= gone


def test_the_alignment_decides_what_is_deleted(documents, monkeypatch):
    """Without it nothing is deleted; with one that only looks at equal heads, less is."""
    def gone():
        blocks = line_dedup.aligned_blocks(documents)
        return {(r.doc_id, k) for r in blocks.collect() for k in range(r.first_line, r.last_line + 1)}

    def heads(a, b):
        n = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        return [(0, 0, n)] if n else []

    whole, real = gone(), line_dedup.patience
    assert whole
    a, b = _sequence([3, 3, 1, 7, 7, 2, 3, 3]), _sequence([9, 7, 7, 2, 5, 3, 3])
    assert line_dedup.common_blocks(*a, *b)
    calls = []
    monkeypatch.setattr(line_dedup, "patience", lambda x, y: calls.append((len(x), len(y))) or real(x, y))
    assert line_dedup.common_blocks(*a, *b) and calls[0] == (8, 7)
    monkeypatch.setattr(line_dedup, "patience", lambda x, y: [])
    assert line_dedup.common_blocks(*a, *b) == []
    monkeypatch.setattr(line_dedup, "patience", heads)
    assert sum(n for _, _, n, _ in line_dedup.common_blocks(*a, *b)) >= 1


def test_recall_of_edited_long_paragraphs(spark):
    """Of one-line paragraphs of 60 to 2,000 words with words altered down to a Jaccard similarity of 0.8 to 0.9, at least nine words in ten are removed, at every length."""
    rng = random.Random(3)
    vocabulary, rows, size_of = [f"w{k}" for k in range(5000)], [], {}
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    grams = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    for size in (60, 200, 600, 2000):
        for _ in range(12):
            whole, goal = text(size), rng.uniform(0.8, 0.9)
            own, edited = grams(whole), list(whole)
            for p in rng.sample(range(size), size):
                tried = [*edited[:p], "x" + str(p), *edited[p + 1 :]]
                new = grams(tried)
                if len(own & new) < goal * len(own | new):
                    break
                edited = tried
            for words in (whole, edited):
                rows.append((len(rows), "\n".join(" ".join(x) for x in (text(30), words, text(30)))))
            size_of[len(rows) - 1] = size
    gone = defaultdict(set)
    for r in passage_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).where("removed").collect():
        gone[r.doc_id] |= set(range(max(30, r.first_word), min(30 + size_of[r.doc_id], r.last_word + 1)))
    for size in set(size_of.values()):
        ids = [k for k, n in size_of.items() if n == size]
        assert sum(len(gone[k]) for k in ids) >= 0.9 * size * len(ids)
