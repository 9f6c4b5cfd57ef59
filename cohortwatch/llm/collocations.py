"""Phrase collocation mining by best-first branch-and-bound growth.

Phrases of two and three words grow from their prefixes. A phrase's score, the least over its cuts of
``scale * a * a / (l * r)``, is at most ``scale * a / l`` for each of its first parts, as ``a <= r``; and
since a phrase is no more frequent than its prefix, ``scale * f(prefix) / f(first word)`` bounds every
growth of a two-word prefix, and the same holds for the last two words from the right. One-word prefixes
have the bound ``scale``, so they come first: all pairs of frequent words are counted. The frontier is
then the two-word prefixes in the order of their bounds. It is expanded in waves: a language's wave
reaches down to a bound ``tau``, the score of a pair so and so far down its list, four times as far each
wave. A wave counts the triples whose two bounds reach ``tau``, and all triples around a pair that scores
``tau`` or more, as these may drop it. Every phrase that scores ``tau`` or more is then known with its
verdict; a language is settled, ties included, when ``top`` of them survive, or ``tau`` is 0.

Each wave is a pass over the texts of the languages that are still open. A task looks pairs up in a
byte table of fixed size with a bit for each wave; a pair that it holds by chance adds triples, which
are counted fully and do no harm. Words are told apart by 64-bit hashes of their bytes.

Counts are added up in the tasks first. Null and empty texts have no words, a null language is ``und``.
Repeated rows count as often as they stand there. Other columns are ignored, whatever their names.
An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortwatch.llm import _bloom, _spark, _text

SCALE = 1_000_000
#: Bytes between words, and those of them that end a piece too.
_GAPS, _ENDS = [0x20, 0x09], [*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]
_IN_WORD = ~np.isin(np.arange(256), _GAPS + _ENDS)
_CUTS = np.isin(np.arange(256), _ENDS)
_LOWERED = (_text.LOWER - np.uint64(1)).astype(np.uint8)
_STEP = np.uint64(0xD6E8FEB86659FD93)

#: Waves, and the list positions that a wave's bound is taken from: 5/4 of ``top``, then this many times as far.
WAVES, FARTHER = 8, 4
#: Cells of a pair table for each pair, and its sizes as powers of two; there are four tables of a byte a cell.
PAIR_CELLS, LEAST, MOST = 8, 16, 24
#: Occurrences that a task adds up before they go on.
HELD = 1 << 20
#: Lists are ranked in so many parts first.
PARTS = 256


class _Words:
    """The words of a chunk: hashes, languages' hashes, and which words have their next one in the same piece."""

    def __init__(self, chunk: _text.Chunk, langs: np.ndarray):
        self.begin, self.end, first = chunk.spans(_IN_WORD)
        self.data = chunk.data
        self.hash = chunk.hashes(self.begin, self.end, _text.LOWER)
        self.lang = np.repeat(langs, np.diff(first))
        ends = _CUTS[chunk.data]
        ends[chunk.offsets[:-1][chunk.offsets[:-1] < len(ends)]] = True
        piece = np.cumsum(ends)[self.begin]
        self.joined = piece[1:] == piece[:-1]

    def keys(self) -> np.ndarray:
        return _text.mix(self.hash ^ self.lang)

    def text(self, index: np.ndarray) -> pa.Array:
        """These words, A-Z lower-cased."""
        size = self.end[index] - self.begin[index]
        offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        at = np.arange(offsets[-1]) + np.repeat(self.begin[index] - offsets[:-1], size)
        return pa.Array.from_buffers(pa.large_string(), len(index), [None, pa.py_buffer(offsets), pa.py_buffer(_LOWERED[self.data[at]])])


def _pair_keys(lang: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    return _text.mix((one ^ lang) * _STEP + two)


def _chunks(batches) -> Iterator[_Words]:
    for batch in batches:
        langs = batch.column("l").to_numpy().view(np.uint64)
        for chunk in _text.chunks(batch.column("text")):
            yield _Words(chunk, langs[chunk.first : chunk.first + chunk.n_docs])


def _count_words(batches):
    """Rows (l, key, h, word, n) for the words of a chunk, and one with all its words' number for each language (no word)."""
    for words in _chunks(batches):
        _, at, n = np.unique(words.keys(), return_index=True, return_counts=True)
        langs, every = np.unique(words.lang, return_counts=True)
        none = np.zeros(len(langs), np.int64)
        columns = [np.concatenate([words.lang[at], langs]).view(np.int64), np.concatenate([words.keys()[at].view(np.int64), none]), np.concatenate([words.hash[at].view(np.int64), none]), np.concatenate([n, every])]
        text = pa.concat_arrays([words.text(at), pa.nulls(len(langs), pa.large_string())])
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns] + [text.cast(pa.string())], ["l", "key", "h", "n", "word"])


def _added_up(names: list[str], occurrences: Iterator[list[np.ndarray]]):
    """Batches of distinct rows with their number ``n``, of about ``HELD`` occurrences each."""
    held, many = [], 0

    def flush() -> pa.RecordBatch:
        columns = [np.concatenate(c) for c in zip(*held)]
        key = columns[0]
        for c in columns[1:]:
            key = _text.mix(key * _STEP + c)
        _, at, n = np.unique(key, return_index=True, return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(c[at].view(np.int64)) for c in columns] + [pa.array(n)], [*names, "n"])

    for found in occurrences:
        held.append(found)
        many += len(found[0])
        if many >= HELD:
            yield flush()
            held, many = [], 0
    if many:
        yield flush()


def _count_pairs(frequent):
    """Rows (l, h1, h2, n): neighbours that may both be frequent."""

    def run(batches):
        def found():
            for w in _chunks(batches):
                often = _bloom.may_hold(frequent.value, w.keys())
                at = np.flatnonzero(w.joined & often[:-1] & often[1:])
                yield [w.lang[at], w.hash[at], w.hash[at + 1]]

        return _added_up(["l", "h1", "h2"], found())

    return run


def _count_triples(pairs, wave: int):
    """Rows (l, h1, h2, h3, n): the triples that the frontier reaches in this wave and not before."""

    def run(batches):
        prefix, suffix, scoring, known = pairs.value

        def found():
            for w in _chunks(batches):
                at = np.flatnonzero(w.joined)
                a, b = _places(_pair_keys(w.lang[at], w.hash[at], w.hash[at + 1]), len(known))
                here = known[a] & known[b] != 0
                at, a, b = at[here], a[here], b[here]
                # Of two pairs that follow each other, the left and the right one.
                left = np.flatnonzero(at[1:] == at[:-1] + 1)
                both = [(t[a] & t[b])[k] for t in (prefix, suffix, scoring) for k in (left, left + 1)]
                reached = both[0] & both[3] | both[4] | both[5]
                new = reached >> wave & 1 if wave == 0 else (reached >> wave & 1) & ~(reached >> wave - 1) & 1
                start = at[left[new.astype(bool)]]
                yield [w.lang[start], w.hash[start], w.hash[start + 1], w.hash[start + 2]]

        return _added_up(["l", "h1", "h2", "h3"], found())

    return run


def _places(keys: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    return (keys >> np.uint64(65 - cells.bit_length())).astype(np.int64), (keys & np.uint64(cells - 1)).astype(np.int64)


def _pair_tables(pairs: DataFrame, size: int):
    """The four tables as a broadcast: since which wave a pair is a prefix, is a suffix, scores enough, and which pairs there are. Bit t is wave t."""
    cells = 1 << size

    def fill(batches):
        tables = np.zeros((4, cells), np.uint8)
        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in ("l", "h1", "h2")]
            for place in _places(_pair_keys(*(c.view(np.uint64) for c in columns)), cells):
                np.bitwise_or.at(tables[3], place, np.uint8(255))
                for t, value in enumerate(("prefix", "suffix", "score")):
                    bound = batch.column(value).to_numpy()
                    mask = sum((bound >= batch.column(f"tau{k}").to_numpy()).astype(np.uint8) << k for k in range(WAVES))
                    np.bitwise_or.at(tables[t], place, mask.astype(np.uint8))
        yield _bloom._cells(tables.reshape(-1))

    schema = "cell int, bits binary"
    merged = pairs.mapInArrow(fill, schema).repartition("cell").mapInArrow(_bloom._merge, schema)
    tables = np.zeros(4 * cells, np.uint8)
    for r in merged.collect():  # each cell once: 4 << MOST bytes at most
        tables[r.cell * _bloom.CELL : (r.cell + 1) * _bloom.CELL] = np.frombuffer(zlib.decompress(r.bits), np.uint8)
    return pairs.sparkSession.sparkContext.broadcast(tables.reshape(4, cells))


def _ratio(a: Column, b: Column, c: Column, d: Column) -> Column:
    """floor(SCALE * a * b / (c * d)), exact."""
    whole = lambda x: x.cast("decimal(19,0)")
    return F.call_function("div", F.lit(SCALE).cast("decimal(7,0)") * (whole(a) * whole(b)), whole(c) * whole(d)).cast("long")


def _down_to(rows: DataFrame, ranks: list[int], names: list[str]) -> DataFrame:
    """For each language (``l``): the score at each rank of its list, 0 where the list is shorter. Scores are SCALE + 1 values at most."""
    counted = rows.groupBy("l", "score").agg(F.count("*").alias("n"))
    run = counted.withColumn("upto", F.sum("n").over(Window.partitionBy("l").orderBy(F.desc("score"))))
    at = [F.coalesce(F.max(F.when(F.col("upto") >= r, F.col("score"))), F.lit(0)).alias(name) for r, name in zip(ranks, names)]
    return run.groupBy("l").agg(*at)


def _survivors(pairs: DataFrame, triples: DataFrame, share: int, least: Column) -> DataFrame:
    """Pairs and triples that score ``least`` or more, without pairs that one triple holds in ``share`` percent of their places: l, h1, h2, h3, a, left, right, score."""
    inside = triples.select("l", "h1", "h2", "a").unionAll(triples.select("l", F.col("h2").alias("h1"), F.col("h3").alias("h2"), "a"))
    longer = inside.groupBy("l", "h1", "h2").agg(F.max("a").alias("longer"))
    left = pairs.where(F.col("score") >= least).join(longer, ["l", "h1", "h2"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a")))
    two = left.select("l", "h1", "h2", F.lit(None).cast("long").alias("h3"), "a", F.col("f1").alias("left"), F.col("f2").alias("right"), "score", *[f"tau{k}" for k in range(WAVES)])
    return two.unionByName(triples.where(F.col("score") >= least))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 10, top: int = 2000, share: int = 50) -> DataFrame:
    """Each language's first ``top`` phrases of two or three words by score, then frequency, then the phrase's bytes.

    ``lang``, ``rank``, ``phrase``, ``a`` (its frequency, ``least`` or more), ``l`` and ``r`` (those of the two
    parts of its lowest-scoring cut, the first of equal ones), ``n`` (the language's words), ``score``. Pairs
    are left out that a triple with ``share`` percent of their frequency or more holds.
    """
    lang = F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und"))
    texts = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"), lang.alias("lang")).where("text is not null").withColumn("l", F.xxhash64("lang"))
    counted = texts.select("text", "l").mapInArrow(_count_words, "l long, key long, h long, n long, word string").groupBy("l", "key", "h", "word").agg(F.sum("n").alias("f"))
    counted = _spark.saved(counted.where((F.col("f") >= least) | F.col("word").isNull()), "words")
    words = counted.where("word is not null")
    names = texts.groupBy("l").agg(F.max("lang").alias("lang")).join(counted.where("word is null").select("l", F.col("f").alias("n")), "l")
    names = _spark.saved(names, "languages")

    frequency = _spark.small(words.select("l", "h", "f"))
    found = texts.select("text", "l").mapInArrow(_count_pairs(_bloom.build(words, "key")), "l long, h1 long, h2 long, n long")
    found = _spark.saved(found.groupBy("l", "h1", "h2").agg(F.sum("n").alias("a")).where(F.col("a") >= least), "pairs")
    found = found.join(frequency.withColumnsRenamed({"h": "h1", "f": "f1"}), ["l", "h1"]).join(frequency.withColumnsRenamed({"h": "h2", "f": "f2"}), ["l", "h2"])
    a, f1, f2 = F.col("a"), F.col("f1"), F.col("f2")
    one = F.lit(1)
    found = _spark.saved(found.select("l", "h1", "h2", "a", "f1", "f2", _ratio(a, a, f1, f2).alias("score"), _ratio(a, one, f1, one).alias("prefix"), _ratio(a, one, f2, one).alias("suffix")), "pairs")

    taus = [f"tau{k}" for k in range(WAVES)]
    ranks = [(top + -(-top // 4)) * FARTHER**k for k in range(WAVES - 1)]
    bounds = _spark.saved(_down_to(found, ranks, taus[:-1]).withColumn(taus[-1], F.lit(0).cast("long")), "bounds")
    pairs = _spark.saved(found.join(_spark.small(bounds), "l"), "pairs")
    tables = _pair_tables(pairs, min(MOST, max(LEAST, (pairs.count() * PAIR_CELLS).bit_length())))

    settled, triples, still = [], None, bounds.select("l")
    for wave in range(WAVES):
        more = texts.select("text", "l").join(_spark.small(still), "l", "left_semi").mapInArrow(_count_triples(tables, wave), "l long, h1 long, h2 long, h3 long, n long")
        more = _spark.saved(more.groupBy("l", "h1", "h2", "h3").agg(F.sum("n").alias("a")).where(F.col("a") >= least), "triples")
        more = _spark.saved(_scored(more, pairs), f"triples-{wave}")
        triples = more if triples is None else triples.unionByName(more)
        open_pairs = pairs.join(_spark.small(still), "l", "left_semi")
        living = _spark.saved(_survivors(open_pairs, triples.join(_spark.small(still), "l", "left_semi"), share, F.col(taus[wave])), "living")
        enough = living.groupBy("l").agg(F.count("*").alias("n")).where(F.col("n") >= top).select("l").unionAll(bounds.where(F.col(taus[wave]) == 0).select("l")).distinct()
        enough = _spark.saved(enough, "settled")
        settled.append(living.join(_spark.small(enough), "l", "left_semi").drop(*taus))
        still = _spark.saved(still.join(_spark.small(enough), "l", "left_anti"), "open")
        if still.isEmpty():
            break
    living = reduce(DataFrame.unionByName, settled)
    last = _down_to(living, [top], ["last"])
    living = living.join(_spark.small(_spark.saved(last, "last")), "l").where(F.col("score") >= F.col("last"))
    return _ranked(living, words, names, top)


def _scored(triples: DataFrame, pairs: DataFrame) -> DataFrame:
    """Triples with the parts and the score of their lowest cut, and their language's bounds."""
    left = pairs.select("l", "h1", "h2", "f1", F.col("a").alias("f12"), *[f"tau{k}" for k in range(WAVES)])
    right = pairs.select("l", F.col("h1").alias("h2"), F.col("h2").alias("h3"), F.col("f2").alias("f3"), F.col("a").alias("f23"))
    both = triples.join(left, ["l", "h1", "h2"]).join(right, ["l", "h2", "h3"])
    a = F.col("a")
    one, two = _ratio(a, a, F.col("f1"), F.col("f23")), _ratio(a, a, F.col("f12"), F.col("f3"))
    first = F.col("one") <= F.col("two")
    parts = [F.when(first, F.col(x)).otherwise(F.col(y)).alias(z) for x, y, z in (("f1", "f12", "left"), ("f23", "f3", "right"), ("one", "two", "score"))]
    return both.withColumns({"one": one, "two": two}).select("l", "h1", "h2", "h3", "a", *parts, *[f"tau{k}" for k in range(WAVES)])


def _ranked(living: DataFrame, words: DataFrame, names: DataFrame, top: int) -> DataFrame:
    """The first ``top`` of each language with their words: in parts first, so that no task ranks a whole language."""
    spelled = _spark.small(words.select("l", "h", "word"))
    rows = living
    for k in (1, 2, 3):
        rows = rows.join(spelled.withColumnsRenamed({"h": f"h{k}", "word": f"w{k}"}), ["l", f"h{k}"], "left")
    rows = rows.join(_spark.small(names), "l").select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", F.col("left").alias("l"), F.col("right").alias("r"), "n", "score")
    rows = rows.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    order = [F.desc("score"), F.desc("a"), "phrase"]
    for by in (["lang", "part"], ["lang"]):
        rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return rows.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
