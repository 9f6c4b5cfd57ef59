"""Substring dedup by MinHash banding of paragraphs.

**Paragraphs.** Lines of ``min_words`` words or more are paragraphs, of whatever length. One of more than twice as many is
also cut inside, at words whose 5-gram has the least hash of ``min_words`` words on either side, for what only a part of it shares. Shorter lines are paragraphs together: a new one begins at
the line whose first 5-gram has the least hash of the beginnings as near as that. Pieces of fewer words are no passage.

**Banding.** A paragraph's MinHash values of word shingles make band keys; :func:`tune` finds the bands that
meet the wanted recall with the fewest chance collisions. Only keys that different paragraph
contents share are kept. Colliding contents, each once however many documents hold it, are joined:
members of a key first with one pivot, then what is still open; a 256-bit map of the shingles rules out
pairs inside the join, exact Jaccard decides. Connected contents are a cluster of which the first occurrence stays.

**Passages across paragraphs.** A passage repeated word for word may begin and end anywhere. Its paragraphs of the
second kind are runs of ``min_words - SLACK`` words, picked by winnowing (the least hash of ``SLACK + 1``
consecutive ones), so every common run of ``min_words`` words has one; equal ones (Jaccard 1, the
band of all shingles) are a cluster. Only runs that hold a shared fingerprint (winnowed again, a
short gram) are shuffled. The words beside a run are compared with those of the cluster's first as far as the next ``SLACK`` words go.

So every passage of ``min_words`` words that two documents share is found, and nothing of less than
``min_words - SLACK`` words is. No pair of documents and no text is shuffled, and no cluster is gathered.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortwatch.llm import _bloom, _pivots, _spark, _text

WORDS, PERCENT, MIN_WORDS, RECALL = 5, 80, 50, 0.99
#: Words by which an exact run may be shorter than a passage; they are compared on either side as 16-bit hashes.
SLACK = 4
#: MinHash values of a paragraph, at most.
VALUES = 40

_MOST = np.uint64(2**64 - 1)


def tune(similarity: float, recall: float = RECALL, background: float = 0.2, most: int = VALUES) -> tuple[int, int]:
    """Bands and rows a band: of the plans that find pairs of ``similarity`` with ``recall``, the one with the fewest chance collisions.

    A band of ``r`` rows agrees with probability ``s ** r``; chance collisions are those of similarity ``background``.
    """
    plans = []
    for r in range(1, most + 1):
        for b in range(1, most // r + 1):
            if 1 - (1 - similarity**r) ** b >= recall:
                plans.append((1 - (1 - background**r) ** b, b * r, b, r))
                break
    if not plans:
        raise ValueError(f"no plan of {most} values has that recall")
    return min(plans)[2:]


def _slide(x: np.ndarray, n: int, least: bool) -> np.ndarray:
    """The least (or greatest) of each ``n`` consecutive values."""
    f = np.minimum if least else np.maximum
    have = 1
    while have < n:
        step = min(have, n - have)
        x, have = f(x[: len(x) - step], x[step:]), have + step
    return x


def _grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words, whatever text they stand in."""
    power, inverse = _text._powers_to(len(words) + 1)
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * power[: len(words)], out=total[1:])
    count = max(0, len(words) - n + 1)
    return _text.mix((total[n : n + count] - total[:count]) * inverse[:count] + np.uint64(n))


def _inside(count: int, first: np.ndarray, n: int) -> np.ndarray:
    """Which of the runs of ``n`` words lie in one text."""
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    return doc[:count] == doc[n - 1 : n - 1 + count]


def winnow(grams: np.ndarray, inside: np.ndarray, n: int) -> np.ndarray:
    """Positions of the least hash of each ``n`` consecutive grams (all of equal ones)."""
    if not len(grams):
        return np.zeros(0, np.int64)
    x, n = np.where(inside, grams, _MOST), min(n, len(grams))
    edge = np.zeros(n - 1, np.uint64)
    return np.flatnonzero(inside & (_slide(np.concatenate([edge, _slide(x, n, True), edge]), n, False) == x))


def _local_least(x: np.ndarray, candidate: np.ndarray, reach: int) -> np.ndarray:
    """Which candidates have the least hash of the candidates at most ``reach`` away; the last of equal ones."""
    low = np.uint64((1 << 22) - 1)
    x = np.where(candidate, (x & ~low) | (low - np.arange(len(x), dtype=np.uint64) % low), _MOST)
    edge = np.full(reach, _MOST)
    return candidate & (_slide(np.concatenate([edge, x, edge]), 2 * reach + 1, True) == x)


class Paragraphs:
    """A chunk's words, and its paragraphs: first word, word behind the last, text, shingles and where each paragraph's begin."""

    def __init__(self, chunk: _text.Chunk, min_words: int, n: int):
        starts, ends, self.first = chunk.spans(_text.NOT_SPACE)
        self.words = chunk.hashes(starts, ends, _text.LOWER)
        count, first = len(self.words), self.first
        self.grams = _grams(self.words, n)
        rank = np.concatenate([self.grams, self.words[len(self.grams) :]]) if count else self.words
        line_first = np.unique(np.concatenate([np.searchsorted(starts, chunk.lines()[0]), first]))  # each line's first word, blank lines none
        line_words = np.diff(line_first)
        begin = np.zeros(count, bool)
        begin[line_first[:-1]] = True
        long = np.repeat(line_words > 2 * min_words, line_words)
        keep = np.append(_local_least(rank, begin, min_words) | (_local_least(rank, long, min_words) & long), True) if count else np.ones(1, bool)
        keep[first] = True
        whole = line_words >= min_words
        keep[line_first[:-1][whole]] = keep[line_first[1:][whole]] = True
        bound = np.flatnonzero(keep)
        ok = np.diff(bound) >= min_words
        cut = line_words > 2 * min_words  # these are whole paragraphs too
        self.start, self.stop = np.concatenate([bound[:-1][ok], line_first[:-1][cut]]), np.concatenate([bound[1:][ok], line_first[1:][cut]])
        if cut.any():  # in order, each once
            self.start, self.stop = np.unique(np.stack([self.start, self.stop]), axis=1)
        self.doc = np.searchsorted(first, self.start, "right") - 1
        shingles = np.maximum(self.stop - self.start - n + 1, 0)
        self.at = np.cumsum(shingles) - shingles
        self.shingles = self.grams[np.repeat(self.start - self.at, shingles) + np.arange(shingles.sum())]
        power, inverse = _text._powers_to(count + 1)
        total = np.zeros(count + 1, np.uint64)
        np.cumsum(self.words * power[:count], out=total[1:])
        self.content = _text.mix((total[self.stop] - total[self.start]) * inverse[self.start] + (self.stop - self.start).astype(np.uint64))

    def band_keys(self, bands: int, rows: int) -> np.ndarray:
        keys = np.zeros((len(self.start), bands), np.uint64)
        seeds = _text.mix(np.arange(1, 2 * bands * rows + 1, dtype=np.uint64)).reshape(-1, 2)
        for b in range(bands) if len(self.start) else ():
            for r in range(rows):
                flip, factor = seeds[b * rows + r]
                keys[:, b] = _text.mix(keys[:, b] + np.minimum.reduceat((self.shingles ^ flip) * (factor | np.uint64(1)), self.at) + np.uint64(b + 1))
        return keys


def _distinct(doc: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((keys, doc))
    keys, doc = keys[order], doc[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])
    return doc[new], keys[new]


class Plan:
    """The sizes that follow from an operator's parameters."""

    def __init__(self, min_words: int, words: int, percent: int, recall: float):
        self.min_words, self.words, self.percent = min_words, min(words, min_words), percent
        self.bands, self.rows = tune(percent / 100, recall)
        self.slack = min(SLACK, min_words - 1)
        self.run = min_words - self.slack
        self.print_ = (self.run + 1) // 2  # words of a fingerprint; each run holds one of any run + 1 - print_ consecutive ones
        self.window = self.run + 1 - self.print_

    def prints(self, p: Paragraphs) -> tuple[np.ndarray, np.ndarray]:
        """Position and key of each fingerprint."""
        grams = _grams(p.words, self.print_)
        at = winnow(grams, _inside(len(grams), p.first, self.print_), self.window)
        return at, _text.mix(grams[at] + np.uint64(0xF1))


def _keys(plan: Plan):
    """Rows ``(key, value)``: band keys with their paragraph's content, fingerprints with their document."""

    def run(batches):
        for batch in batches:
            row = batch.column("row").to_numpy(zero_copy_only=False)
            for chunk in _text.chunks(batch.column("text")):
                p = Paragraphs(chunk, plan.min_words, plan.words)
                at, prints = plan.prints(p)
                doc, prints = _distinct(np.searchsorted(p.first, at, "right") - 1, prints)
                keys = np.concatenate([p.band_keys(plan.bands, plan.rows).reshape(-1), prints])
                values = np.concatenate([np.repeat(p.content, plan.bands).view(np.int64), row[chunk.first + doc]])
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(values)], ["key", "value"])

    return run


_PLACE = "key long, doc_id long, row long, start int, stop int, before long, behind long, paragraph boolean"
_CONTENT = "content long, bands array<long>, shingles binary, n int, map_0 long, map_1 long, map_2 long, map_3 long"


def _beside(words: np.ndarray, first: np.ndarray, at: np.ndarray, doc: np.ndarray, step: int, slack: int) -> np.ndarray:
    """16 bits of each of the next ``slack`` words from ``at`` on (or back); 0 where the text ends."""
    out = np.zeros(len(at), np.uint64)
    for k in range(slack):
        p = at + step * k
        there = (p >= first[doc]) & (p < first[doc + 1])
        bits = (words[np.where(there, p, 0)] >> np.uint64(48)) | np.uint64(1)
        out |= np.where(there, bits, np.uint64(0)) << np.uint64(16 * k)
    return out.view(np.int64)


def _places(plan: Plan, bloom):
    """The runs that hold a shared fingerprint, and the paragraphs that have a shared band key (with that)."""

    def run(batches):
        for batch in batches:
            for chunk in _text.chunks(batch.column("text")):
                p = Paragraphs(chunk, plan.min_words, plan.words)
                at, prints = plan.prints(p)
                held = np.zeros(len(p.words) + 1, np.int64)
                held[at[_bloom.may_hold(bloom.value, prints)] + 1] = 1
                held = np.cumsum(held)  # shared fingerprints that begin before each word
                grams = _grams(p.words, plan.run)
                inside = _inside(len(grams), p.first, plan.run)
                start = winnow(grams, inside, plan.slack + 1)
                start = start[held[start + plan.run - plan.print_ + 1] > held[start]]
                doc = np.searchsorted(p.first, start, "right") - 1
                keys = p.band_keys(plan.bands, plan.rows)
                hit = _bloom.may_hold(bloom.value, keys.reshape(-1)).reshape(keys.shape)
                para = np.flatnonzero(hit.any(1))
                both = np.concatenate([doc, p.doc[para]])
                base = p.first[both]
                own = [batch.column(c).slice(chunk.first, chunk.n_docs).take(pa.array(both)) for c in ("doc_id", "row")]
                beside = [pa.array(_beside(p.words, p.first, start + o, doc, s, plan.slack)) for o, s in ((-1, -1), (plan.run, 1))]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([grams[start], p.content[para]]).view(np.int64)),
                        *own,
                        pa.array((np.concatenate([start, p.start[para]]) - base).astype(np.int32)),
                        pa.array((np.concatenate([start + plan.run, p.stop[para]]) - base).astype(np.int32)),
                        *(pa.concat_arrays([x, pa.nulls(len(para), pa.int64())]) for x in beside),
                        pa.array(np.arange(len(both)) >= len(start)),
                    ],
                    [x.split()[0] for x in _PLACE.split(", ")],
                )

    return run


def _contents(plan: Plan, bloom):
    """The contents of paragraphs that have a shared band key, each once a chunk: those keys, the shingles, and a map of them."""

    def run(batches):
        for batch in batches:
            for chunk in _text.chunks(batch.column("text")):
                p = Paragraphs(chunk, plan.min_words, plan.words)
                keys = p.band_keys(plan.bands, plan.rows)
                hit = _bloom.may_hold(bloom.value, keys.reshape(-1)).reshape(keys.shape)
                para = np.flatnonzero(hit.any(1))
                para = para[np.unique(p.content[para], return_index=True)[1]]
                maps = np.zeros((len(para), 4), np.uint64)
                sets, sizes = [], np.zeros(len(para), np.int32)
                end = np.append(p.at, len(p.shingles))
                for k, x in enumerate(para):
                    own = np.unique((p.shingles[end[x] : end[x + 1]] >> np.uint64(32)).astype(np.uint32))
                    sets.append(own.tobytes())
                    sizes[k] = len(own)
                    np.bitwise_or.at(maps[k], own >> 6 & 3, np.uint64(1) << (own & 63).astype(np.uint64))
                offsets = np.concatenate([[0], np.cumsum(hit[para].sum(1))]).astype(np.int32)
                bands = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[para][hit[para]].view(np.int64)))
                columns = [pa.array(p.content[para].view(np.int64)), bands, pa.array(sets, pa.binary()), pa.array(sizes), *(pa.array(np.ascontiguousarray(maps[:, k]).view(np.int64)) for k in range(4))]
                yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in _CONTENT.split(", ")])

    return run


def _verify(percent: int):
    def run(batches):
        for batch in batches:
            both, sizes = _text.common(batch.column("a_set"), batch.column("b_set"), np.uint32)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(100 * both >= percent * (sizes - both))], ["a", "b", "linked"])

    return run


def _may_link(x: str, y: str, percent: int) -> Column:
    """Length filter, and the bound that maps give: shingles in places that the other's map lacks are not common."""
    x, y = F.col(x), F.col(y)
    lacks = lambda a, b: sum((F.bit_count(a[f"map_{k}"].bitwiseAND(F.bitwise_not(b[f"map_{k}"]))) for k in range(4)), F.lit(0))
    bound = F.least(x["n"] - lacks(x, y), y["n"] - lacks(y, x))
    return (100 * F.least(x["n"], y["n"]) >= percent * F.greatest(x["n"], y["n"])) & ((100 + percent) * bound >= percent * (x["n"] + y["n"]))


def _matching(a: str, b: str, slack: int) -> Column:
    """How many of the words beside two equal runs agree, from the run outwards."""
    slot = lambda c, k: F.shiftrightunsigned(c, 16 * k).bitwiseAND(0xFFFF)
    out = F.lit(0)
    for k in reversed(range(slack)):
        out = F.when((slot(a, k) == slot(b, k)) & (slot(a, k) != 0), out + 1).otherwise(F.lit(0))
    return out


def similar_paragraphs(contents: DataFrame, percent: int = PERCENT) -> DataFrame | None:
    """``(content, label)`` of the paragraph contents that are linked with a different one; None if there is none."""
    at = F.struct("n", "map_0", "map_1", "map_2", "map_3", "bands")
    contents = contents.groupBy("content").agg(F.first(F.struct(at.alias("at"), "shingles")).alias("p"))  # map-side first
    contents = _spark.saved(contents.select("content", "p.*"), "passage-contents")
    lists = contents.select(F.explode("at.bands").alias("token"), F.col("content").alias("id"), "at")
    often = lists.groupBy("token").agg(F.count("*").alias("m")).where("m > 1").select("token")
    lists = _spark.saved(lists.join(often, "token"), "passage-lists")

    def compare(pairs: DataFrame) -> DataFrame:
        a, b = (contents.select(F.col("content").alias(x), F.col("shingles").alias(f"{x}_set")) for x in "ab")
        return pairs.join(a, "a").join(b, "b").select("a", "b", "a_set", "b_set").mapInArrow(_verify(percent), "a long, b long, linked boolean")

    def once(x: str, y: str) -> Column:
        """Whether this is the first band that the two share, for a pair needs to be made in one list only."""
        return F.get(F.array_intersect(F.col(x)["bands"], F.col(y)["bands"]), F.lit(0)) == F.col("token")

    label = _pivots.linked_components(lists, lambda x, y: _may_link(x, y, percent), compare, F.col("id"), once=once)
    return None if label is None else label.select(F.col("id").alias("content"), F.col("component").alias("label"))


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, words: int = WORDS, percent: int = PERCENT, recall: float = RECALL) -> DataFrame:
    """Passages that documents share, one row for each document, passage and place where its first occurrence is kept.

    ``doc_id``, ``row_hash`` (xxhash64 of id and text, which tells rows with one id apart), ``first_word`` and
    ``last_word`` (numbers from 0), ``n_words``, ``kept_doc_id`` and ``kept_first_word`` (the class: where its first
    occurrence stands) and ``removed`` (whether this one goes: all in other documents than that do). Words stand between ASCII white
    space and are lower-cased for A-Z. Rows with a null id or text take no part; rows with equal id
    and text are one document, other rows of one id are documents of their own; a passage that only one
    document holds, however often, is none of these. Documents without such a passage have no row; an empty
    table gives none. Other columns are ignored.
    """
    plan = Plan(min_words, words, percent, recall)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")).where("doc_id is not null and text is not null")
    rows = rows.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), "text")
    shared = rows.mapInArrow(_keys(plan), "key long, value long").groupBy("key").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    shared = _spark.saved(shared.where("low < high").select("key"), "passage-keys")
    held = _bloom.build(shared, "key")
    places = _spark.saved(rows.mapInArrow(_places(plan, held), _PLACE), "passage-places")  # narrow; the contents' sets are made in a pass of their own

    # Equal runs: the first holder is kept.
    at, text = F.struct("doc_id", "row", "start"), F.struct("doc_id", "row")
    elsewhere = lambda lead: text != F.struct(f"{lead}.doc_id", f"{lead}.row")
    runs = places.where("not paragraph")
    lead = runs.groupBy("key").agg(F.min(F.struct("doc_id", "row", "start", "before", "behind")).alias("lead"), F.max(text).alias("last"), F.count("*").alias("n"))
    lead = _spark.saved(lead.where(F.col("last") != F.struct("lead.doc_id", "lead.row")).select("key", "lead", "n"), "passage-leads")
    found = _spark.looked_up(runs.select("key", "doc_id", "row", "start", "stop", "before", "behind"), lead, "key", runs.count())
    back, ahead = _matching("before", "lead.before", plan.slack), _matching("behind", "lead.behind", plan.slack)
    spans = found.select("doc_id", "row", (F.col("start") - back).alias("start"), (F.col("stop") + ahead).alias("stop"), F.col("lead.doc_id").alias("kept_doc_id"), (F.col("lead.start") - back).alias("kept_start"), elsewhere("lead").alias("removed"))

    label = similar_paragraphs(rows.mapInArrow(_contents(plan, held), _CONTENT), percent)
    if label is not None:
        paragraphs = places.where("paragraph").select(F.col("key").alias("content"), "doc_id", "row", "start", "stop")
        known = paragraphs.groupBy("content").agg(F.min(at).alias("lead"), F.max(text).alias("last"), F.count("*").alias("rows")).join(label, "content")
        known = _spark.saved(known, "passage-labels")
        first = known.groupBy("label").agg(F.min("lead").alias("lead"), F.max("last").alias("last"), F.count("*").alias("n"))
        first = first.where(F.col("last") != F.struct("lead.doc_id", "lead.row")).drop("last")
        known = _spark.looked_up(known.drop("lead", "last"), first, "label", known.count()).select("content", "lead", F.col("rows").alias("n"))
        near = _spark.looked_up(paragraphs, _spark.saved(known, "passage-clusters"), "content", paragraphs.count())
        spans = spans.unionByName(near.select("doc_id", "row", "start", "stop", F.col("lead.doc_id").alias("kept_doc_id"), F.col("lead.start").alias("kept_start"), elsewhere("lead").alias("removed")))

    # Overlapping and adjoining spans of one fate are one passage.
    w = Window.partitionBy("doc_id", "row", "kept_doc_id", "removed").orderBy("start", "stop", "kept_start")
    upto = F.max("stop").over(w.rowsBetween(Window.unboundedPreceding, -1))
    joined = spans.withColumn("new", F.coalesce((F.col("start") > upto).cast("int"), F.lit(1))).withColumn("part", F.sum("new").over(w))
    out = joined.groupBy("doc_id", "row", "kept_doc_id", "removed", "part").agg(F.min("start").alias("first_word"), (F.max("stop") - 1).alias("last_word"), F.min("kept_start").alias("kept_first_word"))
    return out.select("doc_id", F.col("row").alias("row_hash"), "first_word", "last_word", (F.col("last_word") - F.col("first_word") + 1).alias("n_words"), "kept_doc_id", "kept_first_word", "removed")


def delete_passages(docs: DataFrame, passages: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the removed passages cut out of the text, its other columns and rows as they are.

    A passage's words go with the white space behind them.
    """
    gone = passages.where("removed").groupBy("row_hash").agg(F.sort_array(F.collect_set(F.struct("first_word", "last_word"))).alias("spans"))  # of one document
    name, at = _spark.free_name(docs, "cut_id"), _spark.free_name(docs, "cut_spans")
    own = F.xxhash64(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`").cast("string"))
    rows = docs.join(gone.select(F.col("row_hash").alias(name), F.col("spans").alias(at)), own == F.col(name), "left")
    text = F.col(f"`{text_col}`")
    pieces = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+[\x20\x09-\x0D]*)"), F.lit(1))
    kept = F.filter(F.transform(pieces, lambda x, k: F.struct(x.alias("x"), k.cast("long").alias("k"))), lambda s: ~F.exists(F.col(at), lambda g: (s["k"] >= g["first_word"]) & (s["k"] <= g["last_word"])))
    head = F.regexp_extract(text, r"^([\x20\x09-\x0D]*)", 1)
    new = F.when(F.col(at).isNull(), text).otherwise(F.concat(head, F.array_join(F.transform(kept, lambda s: s["x"]), "")))
    return rows.select(*[new.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])
