"""Language identification by hyperdimensional profiles.

Every letter has a random vector of ``DIMENSIONS`` signs, made from its code point by a hash. A
letter trigram is bound as the product of its letters' vectors, permuted (rotated) by their places;
a text is the bundle (sum) of its trigrams' vectors, and so is a language of its texts. A document
gets the language whose prototype has the greatest cosine with it.

A chunk's documents are bundled together: their trigram counts as a matrix times the trigrams' vectors, of
which a worker keeps the last ``KEPT`` it met. The score is the cosine itself, cut off at 0.

Letters are Unicode's, lower-cased; runs of anything else count as one space, which begins and ends
every text. Null texts and texts without letters are ``und``. Nothing but text and label is learned
from, and nothing but text decides.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cohortwatch.llm import _spark, _text

DIMENSIONS = 2048
#: Languages whose prototypes are sent to the tasks together; more are taken in blocks, one pass over the texts for each.
MAX_LANGUAGES = 5000
#: Distinct trigrams that a task holds at once while it learns, and vectors that one keeps while it predicts.
HELD, KEPT = 200_000, 16_384

def trigrams(chunk: _text.Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trigram codes of all texts, each one's document, and whether each document has a letter."""
    is_letter, lower = _text.letters()
    points, begins = _text.code_points(chunk)
    letters = is_letter[points]
    codes = np.where(letters, lower[points], 0x20)
    doc = np.repeat(np.arange(chunk.n_docs), np.diff(begins))
    has = np.bincount(doc[letters], minlength=chunk.n_docs) > 0
    codes = np.insert(codes, begins[:-1], 0x20)
    doc = np.insert(doc, begins[:-1], np.arange(chunk.n_docs))
    first = np.ones(len(codes), bool)
    first[1:] = doc[1:] != doc[:-1]
    keep = first | (codes != 0x20)
    keep[1:] |= codes[:-1] != 0x20
    codes, doc, first = np.append(codes[keep], 0x20), np.append(doc[keep], chunk.n_docs), np.append(first[keep], True)
    whole = ~first[1:-1] & (codes[1:-1] != 0x20)
    return (codes[:-2] << 42 | codes[1:-1] << 21 | codes[2:])[whole], doc[1:-1][whole], has


def vectors(codes: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """The bound vectors of trigrams, as signs in int8."""
    at = np.arange(dimensions, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    points = [codes >> 42, codes >> 21 & 0x1FFFFF, codes & 0x1FFFFF]
    known, index = np.unique(np.concatenate(points), return_inverse=True)
    letter = np.where(_text.mix(_text.mix(known.astype(np.uint64) + np.uint64(1))[:, None] ^ at) >> np.uint64(63), 1, -1).astype(np.int8)
    a, b, c = np.split(index, 3)
    return np.roll(letter, 2, 1)[a] * np.roll(letter, 1, 1)[b] * letter[c]


def bundle(codes: np.ndarray, counts: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """The sum of the trigrams' vectors, ``counts`` times each."""
    total = np.zeros(dimensions)
    for k in range(0, len(codes), 1024):
        total += counts[k : k + 1024].astype(np.float64) @ vectors(codes[k : k + 1024], dimensions)
    return total


def _learn(dimensions: int):
    schema = ["lang", "vector"]

    def run(batches):
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        sums: dict[str, np.ndarray] = {}

        def flush() -> None:
            for lang, (codes, counts) in held.items():
                sums[lang] = sums.get(lang, 0) + bundle(codes, counts, dimensions)
            held.clear()

        for batch in batches:
            labels = np.array(batch.column("lang").to_pylist(), object)
            at = 0
            for chunk in _text.chunks(batch.column("text")):
                codes, doc, _ = trigrams(chunk)
                names, label = np.unique(labels[at : at + chunk.n_docs].astype(str), return_inverse=True)
                at += chunk.n_docs
                for k, lang in enumerate(names):
                    new, n = np.unique(codes[label[doc] == k], return_counts=True)
                    old, m = held.get(lang, (new[:0], n[:0]))
                    both, where = np.unique(np.concatenate([old, new]), return_inverse=True)
                    held[lang] = both, np.bincount(where, np.concatenate([m, n]), len(both)).astype(np.int64)
                if sum(len(x[0]) for x in held.values()) > HELD:
                    flush()
        flush()
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], schema)

    return run


def _add(batches):
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, vector in zip(batch.column("lang").to_pylist(), batch.column("vector").to_pylist()):
            sums[lang] = sums.get(lang, 0) + np.frombuffer(vector)
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], ["lang", "vector"])


def learn(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", dimensions: int = DIMENSIONS) -> dict[str, np.ndarray] | DataFrame:
    """Prototype by language, from all rows with a label; what tasks send are sums of vectors, a language each.

    More than ``MAX_LANGUAGES`` stay a table (``lang``, ``vector``), which :func:`identify` takes as well.
    """
    rows = docs.select(F.col(f"`{lang_col}`").cast("string").alias("lang"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text")).where("lang is not null")
    schema = "lang string, vector binary"
    partial = _spark.saved(rows.mapInArrow(_learn(dimensions), schema), "language-sums")
    summed = partial.mapInArrow(_add, schema).repartition("lang").mapInArrow(_add, schema)
    if partial.select("lang").distinct().count() > MAX_LANGUAGES:
        return _spark.saved(summed, "language-prototypes")
    return _collected(summed)


def _collected(prototypes: DataFrame) -> dict[str, np.ndarray]:
    return {r.lang: np.frombuffer(bytes(r.vector)) for r in sorted(prototypes.collect(), key=lambda r: r.lang)}


class Classifier:
    """Prototypes of unit length, and the vectors of trigrams as they are met."""

    def __init__(self, prototypes: dict[str, np.ndarray], dimensions: int = DIMENSIONS):
        self.dimensions = dimensions
        self.names = [k for k, v in prototypes.items() if v.any()]
        self.matrix = np.array([prototypes[k] / np.linalg.norm(prototypes[k]) for k in self.names], np.float32).reshape(len(self.names), dimensions)
        self.known, self.held = np.zeros(0, np.int64), np.zeros((0, dimensions), np.int8)

    def _vectors(self, codes: np.ndarray) -> np.ndarray:
        if len(codes) > KEPT // 2:
            return vectors(codes, self.dimensions)
        new = np.setdiff1d(codes, self.known, True)
        if len(new):
            if len(self.known) + len(new) > KEPT:
                self.known, self.held, new = self.known[:0], self.held[:0], codes
            known = np.concatenate([self.known, new])
            order = np.argsort(known)
            self.known, self.held = known[order], np.concatenate([self.held, vectors(new, self.dimensions)])[order]
        return self.held[np.searchsorted(self.known, codes)]

    def predict(self, chunk: _text.Chunk) -> tuple[list[str], np.ndarray]:
        """Language and score of each text of a chunk, the cosine from 0 on."""
        names, cosines = self.nearest(chunk)
        return ["und" if n is None else n for n in names], np.clip(np.nan_to_num(cosines), 0, 1)

    def nearest(self, chunk: _text.Chunk) -> tuple[list[str | None], np.ndarray]:
        """Language and cosine of each text; none and NaN for a text without letters, and if there is no prototype."""
        codes, doc, has = trigrams(chunk)
        if not self.names or not len(codes):
            return [None] * chunk.n_docs, np.full(chunk.n_docs, np.nan)
        distinct, code = np.unique(codes, return_inverse=True)
        bundles = np.zeros((chunk.n_docs, self.dimensions), np.float32)
        step = max(64, (1 << 22) // max(self.dimensions, chunk.n_docs))  # trigrams at a time: neither matrix is large
        for k in range(0, len(distinct), step):
            here = (code >= k) & (code < k + step)
            width = min(step, len(distinct) - k)
            counts = np.bincount(doc[here] * width + code[here] - k, minlength=chunk.n_docs * width).reshape(chunk.n_docs, width)
            bundles += counts.astype(np.float32) @ self._vectors(distinct[k : k + width]).astype(np.float32)
        near = bundles @ self.matrix.T
        best = near.argmax(1)
        score = near[np.arange(chunk.n_docs), best] / np.maximum(np.linalg.norm(bundles, axis=1), 1e-9)
        return [self.names[b] if h else None for b, h in zip(best, has)], np.where(has, score, np.nan).astype(float)


def identify(docs: DataFrame, prototypes: dict[str, np.ndarray] | DataFrame, text_col: str = "text", dimensions: int = DIMENSIONS) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (the cosine, from 0 to 1) appended.

    Without prototypes everything is ``und``. A column of ``docs`` with the name of an appended one
    gives way. A table of prototypes is taken in blocks: each pass keeps the nearer language so far, the
    first by name of equally near ones.
    """
    if isinstance(prototypes, DataFrame):
        return _in_blocks(docs, prototypes, text_col, dimensions)
    own = [c for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    at = len(own)
    shared = docs.sparkSession.sparkContext.broadcast(prototypes)

    def run(batches):
        classifier = Classifier(shared.value, dimensions)
        for batch in batches:
            names, scores = [], [np.zeros(0)]
            for chunk in _text.chunks(batch.column(at)):
                n, s = classifier.predict(chunk)
                names += n
                scores.append(s)
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], pa.array(names, pa.string()), pa.array(np.concatenate(scores))], names=[*own, "lang_pred", "score"])

    rows = docs.select(*[F.col(f"`{c}`") for c in own], F.col(f"`{text_col}`").cast("string").alias(_spark.free_name(docs, "whole_text")))
    return rows.mapInArrow(run, StructType(rows.schema.fields[:at]).add("lang_pred", "string").add("score", "double"))


def _in_blocks(docs: DataFrame, prototypes: DataFrame, text_col: str, dimensions: int) -> DataFrame:
    own = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    text, lang, near = (_spark.free_name(docs, n) for n in ("whole_text", "near_lang", "near_cosine"))
    blocks = -(-prototypes.count() // max(1, MAX_LANGUAGES // 2))
    rows = docs.select(*own, F.col(f"`{text_col}`").cast("string").alias(text), F.lit(None).cast("string").alias(lang), F.lit(None).cast("double").alias(near))
    schema, spark = rows.schema, docs.sparkSession

    def nearer(shared):
        def run(batches):
            classifier = Classifier(shared.value, dimensions)
            for batch in batches:
                names, cosines = batch.column(lang).to_pylist(), batch.column(near).to_pylist()
                at = 0
                for chunk in _text.chunks(batch.column(text)):
                    for n, c in zip(*classifier.nearest(chunk)):
                        if n is not None and (names[at] is None or (-c, n) < (-cosines[at], names[at])):
                            names[at], cosines[at] = n, float(c)
                        at += 1
                yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(names, pa.string()), pa.array(cosines, pa.float64())], names=batch.schema.names)

        return run

    for b in range(blocks):
        block = _collected(prototypes.where(F.pmod(F.xxhash64("lang"), F.lit(blocks)) == b))  # about half of MAX_LANGUAGES
        rows = _spark.saved(rows.mapInArrow(nearer(spark.sparkContext.broadcast(block)), schema), "language-near")
    score = F.least(F.greatest(F.coalesce(F.col(near), F.lit(0.0)), F.lit(0.0)), F.lit(1.0))
    return rows.select(*own, F.coalesce(F.col(lang), F.lit("und")).alias("lang_pred"), score.alias("score"))


def held_out(id_: Column) -> Column:
    """Whether a document is kept from learning: the checksum of its id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(F.encode(id_.cast("string"), "utf-8")) % 3 == 1, F.lit(False))
