"""Benchmark decontamination by winnowing.

Of the k-word grams in every window of ``w`` consecutive grams the one with the smallest hash is
kept (the rightmost on ties), ``k = 7`` and ``w = 7`` by default: two texts that share a run of
``k + w - 1 = 13`` words have a kept gram of that run in common, as the choice depends on
nothing outside the run. Kept grams of documents are joined with those of benchmark items; a hit is
extended to the windows of ``window`` words around it, and those that an item holds mark their
words in the document. A window is looked at once a document, however many hits it holds, so texts that repeat a word
or a passage cost no more than others. Items shorter than ``window`` words are one gram of their own length.

The benchmark's index goes to every task if its words are within a checked bound; beyond it
filters of a fixed size stand for the grams, and documents' windows are joined with the items' by their hashes.

Null and empty texts have no words; documents that are repeated rows give repeated results; other
columns of the inputs are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortwatch.llm import _bloom, _spark, _text

WINDOW, K = 13, 7
#: A word, of which A-Z are then lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Benchmark words that may be sent to every task (16 bytes each, with the index).
BROADCAST_WORDS = 4_000_000

RESULT = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, spans array<struct<first:int,last:int>>"


def winnow(grams: np.ndarray, w: int) -> np.ndarray:
    """Positions of the kept grams of one text: the rightmost least hash of each window of ``w``.

    A text with fewer than ``w`` grams is one window.
    """
    if len(grams) == 0:
        return np.zeros(0, np.int64)
    w = min(w, len(grams))
    best = np.arange(len(grams) - w + 1)
    least = grams[best]
    for j in range(1, w):
        other = grams[j : j + len(best)]
        better = other <= least
        best = np.where(better, np.arange(j, j + len(best)), best)
        least = np.where(better, other, least)
    return np.unique(best)


def winnow_many(grams: np.ndarray, at: np.ndarray, first: np.ndarray, k: int, w: int) -> np.ndarray:
    """As :func:`winnow` for the grams of many texts at once; indices into ``grams``."""
    index = np.searchsorted(at, first)
    n = np.diff(index)
    count = len(grams) - w + 1
    kept = []
    if count > 0:
        best = np.arange(count)
        least = grams[:count].copy()
        for j in range(1, w):
            other = grams[j : j + count]
            better = other <= least
            best[better] = np.flatnonzero(better) + j
            least[better] = other[better]
        inside = np.ones(count, bool)
        for j in range(1, w):
            late = index[1:] - j
            inside[late[(late >= 0) & (late < count)]] = False
        for d in np.flatnonzero((n < w) & (n > 0)):
            inside[index[d] : min(index[d + 1], count)] = False
        kept.append(best[inside])
    kept += [index[d] + winnow(grams[index[d] : index[d + 1]], w) for d in np.flatnonzero((n < w) & (n > 0))]
    return np.unique(np.concatenate(kept)) if kept else np.zeros(0, np.int64)


class Items:
    """Benchmark items as an index: the kept grams of long items, and every window (short items: themselves) with the items that hold it.

    Items of equal words are one entry. A window that an item repeats is one entry too, so that neither a
    periodic text nor a common item makes more of the index than it has words.
    """

    def __init__(self, ids: list, words: list[np.ndarray], window: int, k: int):
        self.window, self.k, self.w = window, k, window - k + 1
        by_text: dict[bytes, list] = defaultdict(list)
        for i, x in zip(ids, words):
            if len(x):
                by_text[x.tobytes()].append(str(i))
        self.names = list(by_text.values())
        kept, windows = [np.zeros(0, np.uint64)], defaultdict(list)
        for t, x in enumerate(np.frombuffer(b, np.uint64) for b in by_text):
            n = min(len(x), window)
            windows[n].append((np.unique(_text.ngrams(x, np.array([0, len(x)]), n)[0]), t))
            if len(x) >= window:
                grams, _ = _text.ngrams(x, np.array([0, len(x)]), k)
                kept.append(grams[winnow(grams, self.w)])
        self.kept = np.unique(np.concatenate(kept))
        #: By length: window hashes in order, and each one's item.
        self.windows: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n, found in windows.items():
            key, item = np.concatenate([g for g, _ in found]), np.repeat([t for _, t in found], [len(g) for g, _ in found])
            order = np.argsort(key, kind="stable")
            self.windows[n] = key[order], item[order]

    def match(self, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For the words of some texts: those inside a window of an item, and the pairs of text and item."""
        edge = np.zeros(len(words) + 1, np.int64)
        pairs = [np.zeros((2, 0), np.int64)]
        for n, (known, item) in self.windows.items():
            grams, at = _text.ngrams(words, first, n)
            if n == self.window:
                near = extended(words, first, self.kept, self.k, n, at)
                grams, at = grams[near], at[near]
            low = np.searchsorted(known, grams)
            there = known[np.minimum(low, len(known) - 1)] == grams
            at, low, grams = at[there], low[there], grams[there]
            np.add.at(edge, at, 1)
            np.add.at(edge, at + n, -1)
            if len(at):
                doc = np.searchsorted(first, at, "right") - 1
                _, one = np.unique(np.stack([doc, low]), axis=1, return_index=True)  # a window once a text
                doc, low = doc[one], low[one]
                many = np.searchsorted(known, grams[one], "right") - low
                index = np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())
                pairs.append(np.unique(np.stack([np.repeat(doc, many), item[index]]), axis=1))
        found = np.unique(np.concatenate(pairs, axis=1), axis=1)
        return np.cumsum(edge[:-1]) > 0, found[0], found[1]


def extended(words: np.ndarray, first: np.ndarray, known: np.ndarray, k: int, window: int, at: np.ndarray) -> np.ndarray:
    """Which of the windows that begin at the words ``at`` hold a hit: a kept gram of the texts that is one of ``known``.

    A hit reaches to the windows around it, each of which is taken once, however many hits it holds.
    """
    if not len(known) or not len(at):
        return np.zeros(0, np.int64)
    grams, place = _text.ngrams(words, first, k)
    kept = winnow_many(grams, place, first, k, window - k + 1)
    low = np.minimum(np.searchsorted(known, grams[kept]), len(known) - 1)
    hit = place[kept[known[low] == grams[kept]]]
    reach = np.zeros(len(words) + 1, np.int64)
    np.add.at(reach, np.maximum(hit - (window - k), 0), 1)
    np.add.at(reach, hit + 1, -1)
    return np.flatnonzero(np.cumsum(reach[:-1])[at] > 0)


def _words(chunk: _text.Chunk) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, first = chunk.spans(_text.ALNUM)
    return chunk.hashes(starts, ends, _text.LOWER), first


def _row(doc, words: np.ndarray, marked: np.ndarray | None, names: list[str]) -> tuple:
    spans = []
    if marked is not None:
        edge = np.flatnonzero(np.diff(np.concatenate([[False], marked, [False]])))
        spans = [{"first": int(a), "last": int(b) - 1} for a, b in zip(edge[::2], edge[1::2])]
    return doc, len(words), int(marked.sum()) if marked is not None else 0, len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), spans


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()), ("items_sha256", pa.string()), ("spans", pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())])))])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(_SCHEMA)
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, _SCHEMA)], schema=_SCHEMA)


def scan_chunk(chunk: _text.Chunk, docs: list, items: Items) -> list[tuple]:
    """One result row for each document of the chunk."""
    words, first = _words(chunk)
    marked, owner, found = items.match(words, first)
    begins = np.searchsorted(owner, np.arange(chunk.n_docs + 1))
    rows = []
    for d in range(chunk.n_docs):
        own = found[begins[d] : begins[d + 1]]
        names = [i for t in own.tolist() for i in items.names[t]]
        rows.append(_row(docs[d], words[first[d] : first[d + 1]], marked[first[d] : first[d + 1]] if len(own) else None, names))
    return rows


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, k: int = K, broadcast_words: int = BROADCAST_WORDS) -> DataFrame:
    """What each document shares with the benchmark's items: one row per document.

    ``n_words``; ``n_hit``, words inside an occurrence of any ``window`` consecutive words of an
    item; ``n_items`` and ``items_sha256``, the items that occur (ids as strings, sorted, joined by
    commas); ``spans``, the hit runs as word numbers. Words are lower-cased for A-Z, of letters,
    digits and non-ASCII characters. Null texts and null items have no words and hit nothing; an
    empty benchmark hits nothing; items of equal text all count.
    """
    left = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    right = _items(benchmark, item_col, item_text_col)
    shared = _shared(right, window, k, broadcast_words)
    if shared is None:
        return _joined(left, right, window, k)

    def scan(batches):
        items = shared.value
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for chunk in _text.chunks(batch.column("text")):
                yield _batch(scan_chunk(chunk, ids[chunk.first : chunk.first + chunk.n_docs], items))

    return left.mapInArrow(scan, RESULT)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, k: int = K, parts: int = 20, broadcast_words: int = BROADCAST_WORDS) -> DataFrame:
    """The rows of ``docs`` of which less than one word in ``parts`` is hit, with all their columns, whatever their names."""
    right = _items(benchmark, item_col, item_text_col)
    shared = _shared(right, window, k, broadcast_words)
    if shared is None:
        row = _spark.free_name(docs, "contaminated_row")
        kept = _spark.saved(docs.withColumn(row, F.monotonically_increasing_id()), "decontaminate-rows")
        found = _joined(kept.select(F.col(row).alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")), right, window, k)
        bad = found.where((F.col("n_hit") > 0) & (parts * F.col("n_hit") >= F.col("n_words"))).select(F.col("doc_id").alias(row))
        return kept.join(_spark.small(_spark.saved(bad, "decontaminate-bad")), row, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
    names = docs.columns

    def scan(batches):
        items = shared.value
        for batch in batches:
            keep = []
            for chunk in _text.chunks(batch.column(len(names))):
                keep += [not (r[2] > 0 and parts * r[2] >= r[1]) for r in scan_chunk(chunk, [None] * chunk.n_docs, items)]
            yield pa.RecordBatch.from_arrays(batch.columns[: len(names)], names=names).filter(pa.array(keep, pa.bool_()))

    rows = docs.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{text_col}`").cast("string").alias(_spark.free_name(docs, "whole_text")))
    return rows.mapInArrow(scan, docs.schema)


def _items(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    return benchmark.select(F.col(f"`{item_col}`").cast("string").alias("item"), F.col(f"`{text_col}`").cast("string").alias("text")).where("item is not null")


def _shared(items: DataFrame, window: int, k: int, broadcast_words: int):
    """The items' index as a broadcast, or None if they have more than ``broadcast_words`` words."""
    if not 0 < k <= window:
        raise ValueError("k must be between 1 and the window")
    words = items.agg(F.sum(F.regexp_count("text", F.lit(WORD))).alias("n")).first()[0] or 0
    if words > broadcast_words:
        return None
    rows = items.where("text is not null").collect()  # within the bound just counted
    own: list[np.ndarray] = []
    for chunk in _text.chunks(pa.array([r.text for r in rows], pa.string())):
        h, first = _words(chunk)
        own += [h[first[d] : first[d + 1]] for d in range(chunk.n_docs)]
    return items.sparkSession.sparkContext.broadcast(Items([r.item for r in rows], own, window, k))


def _windows(window: int, k: int, lengths: list[int], kept=None, known=None, all_of: bool = False):
    """Rows (row, key, at, n): the windows of texts; of items (``all_of``) those of ``window`` or, if they are shorter, of their own length.

    Of documents only windows that hold a hit on a gram of the filter ``kept`` (of ``window`` words) and that the filter ``known`` may hold.
    """

    def run(batches):
        for batch in batches:
            for chunk in _text.chunks(batch.column("text")):
                words, first = _words(chunk)
                row = batch.column("row").slice(chunk.first, chunk.n_docs)
                size = np.diff(first)
                for n in lengths:
                    grams, at = _text.ngrams(words, first, n)
                    doc = np.searchsorted(first, at, "right") - 1
                    key = _text.mix(grams + np.uint64(n))
                    if all_of:
                        keep = np.flatnonzero((size[doc] == n) | (n == window))
                    else:
                        near = _near(words, first, kept, k, n, at) if n == window else np.arange(len(at))
                        keep = near[_bloom.may_hold(known.value, key[near])]
                    yield pa.RecordBatch.from_arrays([row.take(pa.array(doc[keep])), pa.array(key[keep].view(np.int64)), pa.array(at[keep] - first[doc[keep]]), pa.array(np.full(len(keep), n))], ["row", "key", "at", "n"])

    return run


def _near(words: np.ndarray, first: np.ndarray, kept, k: int, window: int, at: np.ndarray) -> np.ndarray:
    """As :func:`extended`, with a filter that may hold the items' kept grams."""
    grams, place = _text.ngrams(words, first, k)
    own = grams[winnow_many(grams, place, first, k, window - k + 1)]
    return extended(words, first, np.unique(own[_bloom.may_hold(kept.value, own)]), k, window, at)


def _kept_grams(window: int, k: int):
    """Rows (key): the kept grams of texts of ``window`` words or more."""

    def run(batches):
        for batch in batches:
            for chunk in _text.chunks(batch.column("text")):
                words, first = _words(chunk)
                grams, at = _text.ngrams(words, first, k)
                yield pa.RecordBatch.from_arrays([pa.array(grams[winnow_many(grams, at, first, k, window - k + 1)].view(np.int64))], ["key"])

    return run


def _joined(left: DataFrame, right: DataFrame, window: int, k: int) -> DataFrame:
    """For a benchmark beyond the broadcast bound: filters of a fixed size for the items' grams and windows, then a join on the windows' hashes. No pair of texts is made."""
    left = _spark.saved(left.withColumn("row", F.monotonically_increasing_id()), "decontaminate-docs")
    right = _spark.saved(right.withColumn("row", F.monotonically_increasing_id()), "decontaminate-items")
    size = F.regexp_count("text", F.lit(WORD))
    lengths = [r.n for r in right.select(F.least(size, F.lit(window)).alias("n")).where("n > 0").distinct().collect()]  # window values at most
    schema = "row long, key long, at long, n long"
    held = right.select("row", "text").mapInArrow(_windows(window, k, lengths, all_of=True), schema).select("key", "row").distinct()
    held = _spark.saved(held.join(right.select("row", "item"), "row").select("key", "item").distinct(), "decontaminate-windows")
    counts = _spark.saved(held.groupBy("key").agg(F.count("*").alias("n_held")), "decontaminate-keys")
    grams = _spark.saved(right.where(size >= window).select("text").mapInArrow(_kept_grams(window, k), "key long").distinct(), "decontaminate-grams")
    find = _windows(window, k, lengths, _bloom.build(grams, "key"), _bloom.build(counts, "key"))
    places = left.select("row", "text").mapInArrow(find, schema)
    places = _spark.saved(places.join(_spark.small(counts.select("key")), "key", "left_semi"), "decontaminate-hits")

    once = places.groupBy("key").agg(F.count("*").alias("n"))
    named = _spark.looked_up(places.select("key", "row").distinct(), once.join(held, "key"), "key", places.count())
    # Windows of a document that touch or overlap are one run.
    order = Window.partitionBy("row").orderBy("first", "last")
    runs = places.select("row", F.col("at").cast("int").alias("first"), (F.col("at") + F.col("n") - 1).cast("int").alias("last")).distinct()
    reached = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.withColumn("new", F.when(F.col("first") <= reached + 1, 0).otherwise(1)).withColumn("run", F.sum("new").over(order))
    runs = runs.groupBy("row", "run").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    runs = runs.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("spans"))  # within one document
    items = named.groupBy("row").agg(F.sort_array(F.collect_set("item")).alias("items"))
    sized = left.select("row", "doc_id", F.coalesce(size, F.lit(0)).cast("long").alias("n_words"))
    out = sized.join(runs, "row", "left").join(items, "row", "left")
    none = F.expr("cast(array() as array<struct<first:int,last:int>>)")
    spans = F.coalesce("spans", none)
    return out.select("doc_id", "n_words", F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1).alias("n_hit"), F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"), F.sha2(F.concat_ws(",", F.coalesce("items", F.expr("cast(array() as array<string>)"))), 256).alias("items_sha256"), spans.alias("spans"))
