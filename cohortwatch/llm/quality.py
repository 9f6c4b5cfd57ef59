"""Quality rules as a short-circuit cascade.

Each rule reads a few measures of a text. On a sample of about ``SAMPLE_ROWS`` texts, drawn from all of the table by chance, the
seconds of every measure are taken, and which rules reject which texts. Rules are then ordered: next
comes the one with the most rejections per cost among the texts that those before it leave, and a measure that one
of those has made costs nothing more. A text that a rule rejects is not shown to the rules behind it. The base
rules (too short, repeats) are rated like the others. The order changes the work, never the verdict: a text is kept if no
rule rejects it.

Null and empty texts have no words, so a base rule rejects them. Repeated rows are judged
alike. Columns of the input whose names clash with a result column give way in the result.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cohortwatch.llm import _spark, _text

#: Texts on which cost and selectivity are estimated, about.
SAMPLE_ROWS = 1000
WINDOW = 5

_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))

class View:
    """Some texts of a chunk with the measures that rules ask for, each computed once."""

    def __init__(self, chunk: _text.Chunk):
        self.chunk, self.known = chunk, {}

    def __getattr__(self, name: str):
        if name not in self.known:
            self.known[name] = MEASURES[name](self)
        return self.known[name]

    def only(self, keep: np.ndarray) -> View:
        """The view of the texts that ``keep`` selects; what is known of them stays known."""
        if keep.all():
            return self
        off = self.chunk.offsets
        data = self.chunk.data[np.repeat(keep, np.diff(off))]
        new = View(_text.Chunk(data, np.concatenate([[0], np.cumsum(np.diff(off)[keep])]), 0))
        new.known = {k: v[keep] for k, v in self.known.items() if isinstance(v, np.ndarray) and k in REPORTED}
        return new


def _per_doc(flags: np.ndarray, view: View) -> np.ndarray:
    return _text.sums(flags, view.chunk.offsets)


def _word_chars(v: View) -> np.ndarray:
    c = v.chunk
    return _per_doc(_text.NOT_SPACE[c.data] & ((c.data & 0xC0) != 0x80), v)


def _n_dup_lines(v: View) -> np.ndarray:
    c = v.chunk
    starts, ends, first = c.lines()
    worded = np.zeros(len(c.data) + 1, np.int64)
    np.cumsum(_text.NOT_SPACE[c.data], out=worded[1:])
    keep = worded[ends] > worded[starts]
    doc = np.repeat(np.arange(c.n_docs), np.diff(first))[keep]
    h = c.hashes(starts[keep], ends[keep], _text.AS_IS) ^ _text.mix(doc.astype(np.uint64) + np.uint64(1))
    _, at = np.unique(h, return_index=True)
    return np.bincount(doc, minlength=c.n_docs) - np.bincount(doc[at], minlength=c.n_docs)


def _n_letters(v: View) -> np.ndarray:
    points, begins = _text.code_points(v.chunk)
    return _text.sums(_text.letters()[0][points], begins)


def _n_repeat_words(v: View) -> np.ndarray:
    c = v.chunk
    starts, ends, first = v.spans
    words = c.hashes(starts, ends, _text.AS_IS)
    grams, at = _text.ngrams(words, first, WINDOW)
    if not len(grams):
        return np.zeros(c.n_docs, np.int64)
    doc = np.searchsorted(first, at, "right").astype(np.uint64)
    keyed = grams ^ _text.mix(doc)
    order = np.argsort(keyed)
    ranked = keyed[order]
    same = np.zeros(len(ranked) + 1, bool)
    same[1:-1] = ranked[1:] == ranked[:-1]
    again = at[order[same[1:] | same[:-1]]]
    change = np.zeros(len(words) + WINDOW + 1, np.int64)
    np.add.at(change, again, 1)
    np.add.at(change, again + WINDOW, -1)
    return _text.sums(np.cumsum(change)[: len(words)] > 0, first)


#: Measures by name; each takes the view.
MEASURES: dict[str, Callable] = {
    "spans": lambda v: v.chunk.spans(_text.NOT_SPACE),
    "n_words": lambda v: np.diff(v.spans[2]),
    "word_chars": _word_chars,
    "n_symbols": lambda v: _per_doc(_SYMBOL[v.chunk.data], v),
    "n_dup_lines": _n_dup_lines,
    "n_repeat_words": _n_repeat_words,
    "n_lines": lambda v: np.diff(v.chunk.lines()[2]),
    "n_letters": _n_letters,
}
REPORTED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters")


@dataclass(frozen=True)
class Rule:
    """``rejects`` says of each text of a view whether the rule rejects it; ``needs`` names its measures."""

    name: str
    needs: tuple[str, ...]
    rejects: Callable[[View], np.ndarray]


#: Too short, or more than a fifth of the words in repeated windows.
BASE = (
    Rule("too_short", ("n_words",), lambda v: v.n_words < 10),
    Rule("repeats", ("n_words", "n_repeat_words"), lambda v: 100 * v.n_repeat_words > 20 * v.n_words),
)
#: Public filtering heuristics: word length, symbols, repeated lines, letters.
RULES = (
    Rule("word_length", ("n_words", "word_chars"), lambda v: (v.word_chars < 3 * v.n_words) | (v.word_chars > 10 * v.n_words)),
    Rule("symbols", ("n_words", "n_symbols"), lambda v: 10 * v.n_symbols > v.n_words),
    Rule("repeated_lines", ("n_lines", "n_dup_lines"), lambda v: 10 * v.n_dup_lines > 3 * v.n_lines),
    Rule("letters", ("word_chars", "n_letters"), lambda v: 2 * v.n_letters < v.word_chars),
)


def _views(texts) -> list[View]:
    return [View(c) for c in _text.chunks(texts)]


def plan(docs: DataFrame, rules: tuple[Rule, ...] = (*BASE, *RULES), text_col: str = "text", sample_rows: int = SAMPLE_ROWS, made: tuple[str, ...] = ()) -> list[tuple[Rule, float, float]]:
    """The rules in their order, as ``(rule, seconds a text, share rejected of those that come so far)``.

    Measures in ``made`` are reported for every text anyhow and cost nothing. What comes to the driver are
    seconds by measure and counts by set of rejecting rules. An empty sample leaves the rules as they are.
    """
    needs = sorted({m for r in rules for m in r.needs})

    def measure(batches):
        seconds, rejected = dict.fromkeys(needs, 0.0), dict[int, int]()
        for batch in batches:
            for view in _views(batch.column(0)):
                view.spans  # noqa: B018  what all words need
                for m in needs:
                    began = time.perf_counter()
                    getattr(view, m)
                    seconds[m] += time.perf_counter() - began
                sets = sum((r.rejects(view).astype(np.int64) << k for k, r in enumerate(rules)), np.zeros(view.chunk.n_docs, np.int64))
                for x, n in zip(*(v.tolist() for v in np.unique(sets, return_counts=True))):
                    rejected[x] = rejected.get(x, 0) + n
        yield pa.RecordBatch.from_pydict({"name": [*seconds, *map(str, rejected)], "value": [*seconds.values(), *map(float, rejected.values())]})

    total = docs.count()
    sample = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"))
    if total > sample_rows:
        sample = sample.sample(sample_rows / total, seed=7)
    found = {r.name: r.value for r in sample.mapInArrow(measure, "name string, value double").groupBy("name").agg(F.sum("value").alias("value")).collect()}
    sets = {int(k): v for k, v in found.items() if k.isdigit()}
    texts, known, left, out = sum(sets.values()) or 1.0, set(made), list(enumerate(rules)), []
    while left:
        rated = []
        for k, r in left:
            coming = sum(sets.values())
            share = sum(v for x, v in sets.items() if x >> k & 1) / max(1.0, coming)
            cost = sum(found.get(m, 0.0) for m in r.needs if m not in known) / texts
            rated.append((-share / max(cost, 1e-9), cost, k, share))
        _, cost, k, share = min(rated)
        out.append((rules[k], cost, share))
        known |= set(rules[k].needs)
        left = [x for x in left if x[0] != k]
        sets = {x: v for x, v in sets.items() if not x >> k & 1}
    return out


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text", report: tuple[str, ...] = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"), sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` with its measures ``report``, ``base_failed`` and ``kept`` appended.

    The reported measures are computed for every text, whatever rejects it; measures that are not
    reported are computed for texts that reach a rule which needs them. A column of ``docs`` with
    the name of an appended one is left out of the result.
    """
    added = [*report, "base_failed", "kept"]
    own = [c for c in docs.columns if c.lower() not in {a.lower() for a in added}]
    return _cascade(docs, rules, text_col, own, added, sample_rows)


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` that every rule keeps, with its columns as they are, whatever their names."""
    return _cascade(docs, rules, text_col, docs.columns, [], sample_rows)


def _cascade(docs: DataFrame, rules: tuple[Rule, ...], text_col: str, own: list[str], added: list[str], sample_rows: int) -> DataFrame:
    """The columns ``own`` of all rows with ``added`` ones; of the kept rows only if nothing is added."""
    made = tuple(m for m in added if m in MEASURES)
    ordered = [r for r, _, _ in plan(docs, (*BASE, *rules), text_col, sample_rows, made)]
    text_at = len(own)

    def run(batches):
        for batch in batches:
            out: dict[str, list] = {a: [np.zeros(0, np.int64)] for a in added} | {"kept": [np.zeros(0, bool)]}
            for view in _views(batch.column(text_at)):
                for m in made:
                    out[m].append(getattr(view, m))
                if added:
                    out["base_failed"].append(np.any([r.rejects(view) for r in BASE], 0))
                kept = np.ones(view.chunk.n_docs, bool)
                for r in ordered:
                    bad = r.rejects(view)  # of the texts that are left
                    kept[np.flatnonzero(kept)[bad]] = False
                    if bad.all():
                        break
                    view = view.only(~bad)
                out["kept"].append(kept)
            if added:
                extra = [pa.array(np.concatenate(out[a]), pa.bool_() if a in ("base_failed", "kept") else pa.int64()) for a in added]
                yield pa.RecordBatch.from_arrays([*batch.columns[:text_at], *extra], names=[*own, *added])
            else:
                yield pa.RecordBatch.from_arrays(batch.columns[:text_at], names=own).filter(pa.array(np.concatenate(out["kept"])))

    rows = docs.select(*[F.col(f"`{c}`") for c in own], F.col(f"`{text_col}`").cast("string").alias(_spark.free_name(docs, "whole_text")))
    schema = StructType(rows.schema.fields[:text_at])
    for a in added:
        schema = schema.add(a, "boolean" if a in ("base_failed", "kept") else "long")
    return rows.mapInArrow(run, schema)
