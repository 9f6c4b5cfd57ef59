"""The text kernels against plain Python."""

import brute
import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortwatch.llm import _text

TEXTS = st.lists(st.one_of(st.none(), st.text(st.sampled_from("aAbé \n\t\x0b0|漢-"), max_size=40)), max_size=8)


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.booleans(), st.integers(1, 4))
def test_words_lines_and_ngrams(texts, wide, n):
    array = pa.array(texts, pa.large_string() if wide else pa.string())
    seen = 0
    for chunk in _text.chunks(pa.chunked_array([array[:3], array[3:]])):
        for table, pattern in ((_text.NOT_SPACE, brute.SPACE), (_text.ALNUM, brute.ALNUM)):
            starts, ends, first = chunk.spans(table)
            h = chunk.hashes(starts, ends, _text.LOWER)
            grams, at = _text.ngrams(h, first, n)
            for d in range(chunk.n_docs):
                text = texts[chunk.first + d] or ""
                own = [bytes(chunk.data[a:b]).decode() for a, b in zip(starts[first[d] : first[d + 1]], ends[first[d] : first[d + 1]])]
                assert [w.translate(brute.LOWER) for w in own] == brute.words(text, pattern)
                lower = brute.words(text, pattern)
                same = {}
                for w, x in zip(lower, h[first[d] : first[d + 1]]):
                    assert same.setdefault(w, x) == x
                assert len(set(same.values())) == len(same)
                places = at[(at >= first[d]) & (at < first[d + 1])] - first[d]
                assert list(places) == list(range(max(0, len(lower) - n + 1)))
        starts, ends, first = chunk.lines()
        for d in range(chunk.n_docs):
            assert [bytes(chunk.data[a:b]).decode() for a, b in zip(starts[first[d] : first[d + 1]], ends[first[d] : first[d + 1]])] == (texts[chunk.first + d] or "").split("\n")
        seen += chunk.n_docs
    assert seen == len(texts)


def test_sequence_hash_is_that_of_the_window():
    words = np.arange(1, 8, dtype=np.uint64)
    grams, at = _text.ngrams(words, np.array([0, 7]), 3)
    assert [_text.sequence_hash(words[p : p + 3]) for p in at] == list(grams)


def test_long_documents_and_chunk_borders(monkeypatch):
    monkeypatch.setattr(_text, "CHUNK_BYTES", 10)
    texts = ["a b", "", "c" * 50, "d e f", "g"]
    got = []
    for chunk in _text.chunks(pa.array(texts)):
        starts, ends, first = chunk.spans(_text.NOT_SPACE)
        got += [[bytes(chunk.data[a:b]).decode() for a, b in zip(starts[first[d] : first[d + 1]], ends[first[d] : first[d + 1]])] for d in range(chunk.n_docs)]
    assert got == [t.split() for t in texts]
