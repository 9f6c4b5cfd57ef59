"""N-gram Jaccard self-join by rare-first prefix filtering.

A document's set is its distinct word n-grams. All sets are put in one global order, rare n-grams
first: a hashed table of document frequencies over the whole corpus, of fixed size, gives each
n-gram a rank level, and (level, hash) is its place. Two sets of similarity ``t`` or more have a
common element within their first ``n - ceil(t n) + 1`` elements, so only those prefixes are
shuffled; prefix elements of a single set drop out (a Bloom filter of fixed size stops most of them
before the shuffle). Candidates pass a length filter and a positional filter in the join, then a filter on
histograms of the sets over hash ranges, whose least sums bound the overlap from above; only sets in
pairs that are left are gathered. Before the overlap is counted, once per pair, a suffix filter
splits the sorted sets in halves.

Equal sets are one vertex. In the list of a prefix element not all pairs are made: :mod:`_pivots` compares
each member with a pivot and leaves out pairs that are connected by then. Where many pairs of long lists stay
open, these lists are split by a second element: prefixes that are one longer have two elements in
common if the sets are linked. So the components are exact.

Element identity is a 58-bit hash, set identity a 64-bit hash.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortwatch.llm import _bloom, _pivots, _spark, _text

WORDS, PERCENT = 5, 80
#: Counters of the document-frequency table, kept and moved in cells.
COUNTER_BITS, CELL = 22, 1 << 12
COUNTERS = 1 << COUNTER_BITS


def _sets(texts, n: int):
    """For each chunk: its first row, the elements of all sets (sorted in each set), each set's first position."""
    for chunk in _text.chunks(texts):
        starts, ends, first = chunk.spans(_text.NOT_SPACE)
        words = chunk.hashes(starts, ends, _text.LOWER)
        grams, at = _text.ngrams(words, first, n)
        doc = np.searchsorted(first, at, "right") - 1
        count = np.diff(first)
        short = np.flatnonzero((count > 0) & (count < n))
        if len(short):
            grams = np.concatenate([grams, np.array([_text.sequence_hash(words[first[d] : first[d + 1]]) for d in short], np.uint64)])
            doc = np.concatenate([doc, short])
        grams >>= np.uint64(6)
        order = np.lexsort((grams, doc))
        grams, doc = grams[order], doc[order]
        new = np.ones(len(grams), bool)
        new[1:] = (grams[1:] != grams[:-1]) | (doc[1:] != doc[:-1])
        grams, doc = grams[new], doc[new]
        yield chunk.first, grams, np.searchsorted(doc, np.arange(chunk.n_docs + 1))


def _set_ids(grams: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 64-bit identity of each set: the mixed sum of its mixed elements and its size."""
    total = np.zeros(len(grams) + 1, np.uint64)
    np.cumsum(_text.mix(grams + np.uint64(1)), out=total[1:])
    return _text.mix(total[first[1:]] - total[first[:-1]] + np.diff(first).astype(np.uint64)).view(np.int64)


def _counter(grams: np.ndarray) -> np.ndarray:
    return (_text.mix(grams) >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)


def _histograms(grams: np.ndarray, first: np.ndarray) -> pa.Array:
    """For each set the number of its elements in equal hash ranges, about three a range, as bytes."""
    out = []
    for a, b in zip(first.tolist(), first[1:].tolist()):
        bits = max(0, ((b - a) // 3).bit_length() - 1)
        out.append(np.minimum(np.bincount((grams[a:b] >> np.uint64(58 - bits)).astype(np.int64), minlength=1 << bits), 255).astype(np.uint8).tobytes())
    return pa.array(out, pa.binary())


def overlap_bound(x: np.ndarray, y: np.ndarray) -> int:
    """No two sets with these histograms have more elements in common."""
    x, y = x.astype(np.int64), y.astype(np.int64)
    while len(x) > len(y):
        x = x[::2] + x[1::2]
    while len(y) > len(x):
        y = y[::2] + y[1::2]
    return int(np.minimum(x, y).sum())


_SUMMARY = ["doc_id", "row_hash", "n", "sid", "histogram", "cell", "counts"]


def _cells(counts: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(counts.reshape(-1, CELL).any(1))
    packed = [zlib.compress(counts[k * CELL : (k + 1) * CELL].astype(np.int64).tobytes(), 1) for k in at]
    none = [pa.nulls(len(at), t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())]
    return pa.RecordBatch.from_arrays([*none, pa.array(at, pa.int32()), pa.array(packed, pa.binary())], _SUMMARY)


def _summary(words: int):
    def run(batches):
        counts = np.zeros(COUNTERS, np.int32)  # of one task
        for batch in batches:
            for at, grams, first in _sets(batch.column("text"), words):
                np.add.at(counts, _counter(grams), 1)
                n = len(first) - 1
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, n), batch.column("row_hash").slice(at, n), pa.array(np.diff(first)), pa.array(_set_ids(grams, first)), _histograms(grams, first), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], _SUMMARY)
        yield _cells(counts)

    return run


def _add_cells(batches):
    counts: dict[int, np.ndarray] = {}
    for batch in batches:
        for cell, packed in zip(batch.column("cell").to_pylist(), batch.column("counts").to_pylist()):
            counts[cell] = counts.get(cell, 0) + np.frombuffer(zlib.decompress(packed), np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int32()), pa.array([zlib.compress(x.tobytes(), 1) for x in counts.values()], pa.binary())], ["cell", "counts"])


def _levels(cells: DataFrame) -> np.ndarray:
    """A rank level from 0 (rare) to 63 for each counter; what comes to the driver is the table, of fixed size."""
    schema = "cell int, counts binary"
    summed = cells.select("cell", "counts").mapInArrow(_add_cells, schema).repartition(16, "cell").mapInArrow(_add_cells, schema)
    counts = np.zeros(COUNTERS, np.int64)
    for r in summed.collect():
        counts[r.cell * CELL : (r.cell + 1) * CELL] = np.frombuffer(zlib.decompress(r.counts), np.int64)
    usual = max(1.0, float(np.median(counts)))
    return np.clip(np.floor(4 * np.log2(np.maximum(counts, 1) / usual)), 0, 63).astype(np.uint8)


def _ranked(grams: np.ndarray, first: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """The sets' elements as numbers in the global order, each set sorted."""
    keys = (levels[_counter(grams)].astype(np.uint64) << np.uint64(58)) | grams
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    return keys[np.lexsort((keys, doc))]


def _prefixes(words: int, percent: int, shared, bloom=None):
    """``(token, sid, npos)`` of the elements of each prefix and one more; ``npos`` holds the set's size and the place."""

    def run(batches):
        levels = shared.value
        for batch in batches:
            for _, grams, first in _sets(batch.column("text"), words):
                keys, ids, n = _ranked(grams, first, levels), _set_ids(grams, first), np.diff(first)
                length = np.where(n > 0, np.minimum(n, n - -(-percent * n // 100) + 2), 0)
                pos = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
                out = [keys[np.repeat(first[:-1], length) + pos].view(np.int64), np.repeat(ids, length), (np.repeat(n, length) << 32) | pos]
                if bloom is not None:
                    keep = _bloom.may_hold(bloom.value, out[0])
                    out = [x[keep] for x in out]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], ["token", "sid", "npos"])

    return run


def _whole_sets(words: int, shared, wanted):
    """``(sid, keys)`` of the rows whose hash is wanted, and of few others."""

    def run(batches):
        for batch in batches:
            batch = batch.filter(pa.array(_bloom.may_hold(wanted.value, batch.column("row_hash").to_numpy(zero_copy_only=False))))
            for _, grams, first in _sets(batch.column("text"), words):
                keys = _ranked(grams, first, shared.value)
                yield pa.RecordBatch.from_arrays([pa.array(_set_ids(grams, first)), pa.array([keys[a:b].tobytes() for a, b in zip(first, first[1:])], pa.binary())], ["sid", "keys"])

    return run


def _screen(percent: int):
    def run(batches):
        for batch in batches:
            a, b = batch.column("a_histogram"), batch.column("b_histogram")
            keep = np.zeros(batch.num_rows, bool)
            for k in range(batch.num_rows):
                x, y = np.frombuffer(a[k].as_buffer(), np.uint8), np.frombuffer(b[k].as_buffer(), np.uint8)
                keep[k] = (100 + percent) * overlap_bound(x, y) >= percent * (int(x.sum()) + int(y.sum()))
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return run


def suffix_allows(x: np.ndarray, y: np.ndarray, needed: int, depth: int = 2) -> bool:
    """Whether two sorted sets can have ``needed`` common elements, by splitting both at an element of one."""
    if min(len(x), len(y)) < needed:
        return False
    if depth == 0 or needed <= 0 or len(x) == 0 or len(y) == 0:
        return True
    pivot = y[len(y) // 2]
    i, j = int(np.searchsorted(x, pivot)), len(y) // 2
    low, high = min(i, j), min(len(x) - i, len(y) - j)
    if low + high < needed:
        return False
    return suffix_allows(x[:i], y[:j], needed - high, depth - 1) and suffix_allows(x[i:], y[j:], needed - low, depth - 1)


def _verify(percent: int):
    def run(batches):
        for batch in batches:
            a, b = batch.column("a_keys"), batch.column("b_keys")
            may = np.zeros(batch.num_rows, bool)
            for k in range(batch.num_rows):
                x, y = np.frombuffer(a[k].as_buffer(), np.uint64), np.frombuffer(b[k].as_buffer(), np.uint64)
                may[k] = suffix_allows(x, y, -(-percent * (len(x) + len(y)) // (100 + percent)))
            batch = batch.filter(pa.array(may))
            both, sizes = _text.common(batch.column("a_keys"), batch.column("b_keys"), np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(100 * both >= percent * (sizes - both))], ["a", "b", "linked"])

    return run


def _may_link(a: str, b: str, percent: int):
    """Length and positional filter for two entries of one list.

    If the list's element is the first that the sets share, nothing before it is common, so the
    overlap is at most what either set has from there on. A linked pair passes in the list of its first
    common element; its entries in other lists may fail.
    """
    n = [F.shiftright(c, 32) for c in (a, b)]
    pos = [F.col(c).bitwiseAND((1 << 32) - 1) for c in (a, b)]
    needed = F.ceil(percent * (n[0] + n[1]) / F.lit(100 + percent))
    return (100 * F.least(*n) >= percent * F.greatest(*n)) & (F.least(n[0] - pos[0], n[1] - pos[1]) >= needed)


def _compare(pairs: DataFrame, rows: DataFrame, reps: DataFrame, shared, words: int, percent: int) -> DataFrame:
    """``(a, b, linked)`` of the pairs that histograms and suffixes leave."""
    left, right = reps.select(F.col("sid").alias("a"), F.col("histogram").alias("a_histogram")), reps.select(F.col("sid").alias("b"), F.col("histogram").alias("b_histogram"))
    screened = _spark.saved(pairs.join(left, "a").join(right, "b").select("a", "b", "a_histogram", "b_histogram").mapInArrow(_screen(percent), "a long, b long"), "join-screened")
    if screened.isEmpty():
        return screened.withColumn("linked", F.lit(True))
    ids = screened.select(F.col("a").alias("sid")).unionAll(screened.select("b")).distinct()
    wanted = _bloom.build(_spark.saved(ids.join(reps, "sid").select("row_hash"), "join-wanted"), "row_hash")
    sets = _spark.saved(rows.select("row_hash", "text").mapInArrow(_whole_sets(words, shared, wanted), "sid long, keys binary"), "join-sets")
    left, right = sets.select(F.col("sid").alias("a"), F.col("keys").alias("a_keys")), sets.select(F.col("sid").alias("b"), F.col("keys").alias("b_keys"))
    checked = screened.join(left, "a").join(right, "b").select("a", "b", "a_keys", "b_keys").mapInArrow(_verify(percent), "a long, b long, linked boolean")
    checked = _spark.saved(checked.distinct(), "join-checked")
    _spark.drop_scratch(rows.sparkSession, sets)
    return checked


def _links(rows: DataFrame, info: DataFrame, levels, words: int, percent: int) -> DataFrame | None:
    """``(sid, component)`` of every set that is linked with a different one."""
    shared = rows.sparkSession.sparkContext.broadcast(levels)  # COUNTERS numbers
    schema = "token long, sid long, npos long"
    often = rows.select("text").mapInArrow(_prefixes(words, percent, shared), schema).groupBy("token").agg(F.min("sid").alias("low"), F.max("sid").alias("high")).where("low < high").select("token")
    often = _spark.saved(often, "join-tokens")
    bloom = _bloom.build(often, "token")
    longer = _spark.saved(rows.select("text").mapInArrow(_prefixes(words, percent, shared, bloom), schema).join(often, "token").select("token", F.col("sid").alias("id"), F.col("npos").alias("at")).distinct(), "join-lists")
    n, pos = F.shiftright("at", 32), F.col("at").bitwiseAND((1 << 32) - 1)
    lists = longer.where(pos <= n - F.ceil(percent * n / F.lit(100)))
    reps = _spark.saved(info.groupBy("sid").agg(F.min_by(F.struct("row_hash", "histogram"), "row_hash").alias("r")).select("sid", "r.*"), "join-sets-known")

    def split(entries: DataFrame) -> DataFrame:
        second = longer.select(F.col("token").alias("second"), "id", F.col("at").alias("second_at"))
        later = entries.join(second, "id").where(F.col("second_at") > F.col("at"))
        return later.select(F.xxhash64("token", "second").alias("token"), "id", "at", "label")

    # The pivot is the member with the fewest rarer elements for its size: the least altered of copies.
    found = _pivots.linked_components(lists, lambda x, y: _may_link(x, y, percent), lambda pairs: _compare(pairs, rows, reps, shared, words, percent), pos / n, split)
    return None if found is None else found.withColumnRenamed("id", "sid")


def _row_components(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int) -> DataFrame:
    """``doc_id``, ``row_hash`` and ``n`` of every row, and the first ``lead`` (id, hash) of its component where it has words."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    rows = rows.withColumn("row_hash", F.xxhash64("doc_id", "text"))
    summary = _spark.saved(rows.mapInArrow(_summary(words), "doc_id long, row_hash long, n long, sid long, histogram binary, cell int, counts binary"), "join-summary")
    info = summary.where("counts is null").select("doc_id", "row_hash", "n", "sid", "histogram")
    worded = info.where("n > 0")
    label = _links(rows, worded, _levels(summary.where("counts is not null")), words, percent)
    total = worded.count()
    lead = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_hash"))
    sets = worded.groupBy("sid").agg(lead.alias("lead"), F.count("*").alias("rows"))
    sets = sets.withColumn("component", F.col("sid")) if label is None else sets.join(label, "sid", "left").withColumn("component", F.coalesce("component", "sid"))
    sets = _spark.saved(sets, "join-sets-labelled")
    first = _spark.saved(sets.groupBy("component").agg(F.min("lead").alias("lead"), F.count("*").alias("n")), "join-first")
    sets = _spark.looked_up(sets.drop("lead"), first, "component", total).select("sid", F.col("rows").alias("n"), "lead")
    found = _spark.looked_up(worded.select("sid", "doc_id", "row_hash", F.col("n").alias("size")), _spark.saved(sets, "join-leads"), "sid", total)
    none = info.where("n = 0").select("doc_id", "row_hash", "n", F.lit(None).cast(found.schema["lead"].dataType).alias("lead"))
    return found.select("doc_id", "row_hash", F.col("size").alias("n"), "lead").unionByName(none)


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id``, one row per row of ``docs``.

    Words are lower-cased for A-Z and stand between ASCII white space. A set holds the distinct
    ``words``-word shingles; a text with fewer words is one shingle; a null, empty or blank text has
    none and is linked with nothing. Two rows link when ``100 * intersection >= percent * union``;
    ``component_id`` is the least id reachable by links, its own included. Rows with a repeated or null
    id are vertices of their own; a component of null ids only has a null id. Other columns of
    ``docs`` are ignored.
    """
    found = _row_components(docs, id_col, text_col, words, percent)
    return found.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("lead").isNull(), F.col("doc_id")).otherwise(F.col("lead.doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The first row of each component, by id (null last) and then a hash of id and text; all columns of ``docs``, whatever their names.

    Rows decide, not ids: rows that repeat an id with unrelated texts all stay. Of rows with equal id and
    text one stays, whatever their other columns. Rows without words are nobody's copy and stay.
    """
    found = _spark.saved(_row_components(docs, id_col, text_col, words, percent), "join-components")
    gone = found.where(F.col("lead").isNotNull() & (F.col("row_hash") != F.col("lead.row_hash"))).select("row_hash").distinct()
    again = found.where("lead is not null").groupBy("row_hash").agg(F.count("*").alias("n")).where("n > 1").select("row_hash")
    name, own = _spark.free_name(docs, "dropped_row"), _spark.free_name(docs, "own_row")
    row = F.xxhash64(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`").cast("string"))
    keyed = docs.withColumn(own, row)
    rows = keyed.join(_spark.small(gone.withColumnRenamed("row_hash", name)), F.col(own) == F.col(name), "left_anti")
    again = _spark.saved(again.withColumnRenamed("row_hash", name), "join-again")
    if again.isEmpty():
        return rows.drop(own)
    twice = _spark.small(again)
    once = rows.join(twice, F.col(own) == F.col(name), "left_semi").dropDuplicates([own])
    return rows.join(twice, F.col(own) == F.col(name), "left_anti").unionByName(once).drop(own)
