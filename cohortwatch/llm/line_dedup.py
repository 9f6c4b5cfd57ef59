"""Line dedup by pairwise alignment.

Documents that overlap are found through shared line hashes, rare ones first. A line of less than ``min_words``
words counts together with the lines behind it, and with those before it, as many as hold ``min_words``
words: every block that is deleted is made of such runs, and every common run is part of a block. A document's rarest shared
run nominates its first holder (least id) as a partner; each run that this partner lacks nominates its own
first holder. So every run that an earlier document holds is met in one pair at least, a run
of any frequency makes one pair a document at most, and no list of holders is gathered.

Each pair is aligned by patience diff: equal heads and tails are matched, then the lines that occur
once in both are matched along their longest increasing run, and the gaps between are treated in
the same way; a gap without such a line is split at the longest run of lines that both sides hold.
Blocks of consecutive aligned lines with ``min_words`` words or more are deleted from the later
document. An alignment keeps the order, so moved and repeated passages are left by it; the lines that
stay are therefore aligned with the kept document again, and last, stretch by stretch, with the places of it
that begin like them. Only aligned blocks are deleted. What is deleted holds all that the alignments of
all pairs would delete, and nothing that no earlier document holds.

Lines are compared as 64-bit hashes of their whole text; lines without a word are aligned but
nominate nothing.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortwatch.llm import _bloom, _spark, _text

#: Words of a block that is deleted, and of the lines that nominate a partner together, at least.
MIN_WORDS = 5
#: Pairs with one kept document in one task.
PAIRS = 1000


def longest_run(a: list[int], b: list[int]) -> tuple[int, int, int]:
    """``(start in a, start in b, lines)`` of the longest common run, the first in a and then in b."""
    number: dict = {}
    code = np.array([number.setdefault(x, len(number)) for x in (*a, *b)], np.int64)
    best, low, high = (0, 0, 0), 1, min(len(a), len(b))
    ranks = {1: code}  # of the runs of each length that is a power of two

    def ranked(n: int) -> np.ndarray:
        if n not in ranks:
            half = 1 << (n - 1).bit_length() - 1
            x = ranked(half)
            ranks[n] = np.unique(x[: len(code) - n + 1] * (len(code) + 2) + x[n - half : len(code) - half + 1], return_inverse=True)[1].astype(np.int64)
        return ranks[n] if n & (n - 1) == 0 else ranks.pop(n)

    while low <= high:
        n = (low + high) // 2
        x = ranked(n)
        x, y = x[: len(a) - n + 1], x[len(a) : len(a) + len(b) - n + 1]
        common = np.isin(x, y)
        if common.any():
            at = int(common.argmax())
            best, low = (at, int((y == x[at]).argmax()), n), n + 1
        else:
            high = n - 1
    return best


def patience(a: list[int], b: list[int]) -> list[tuple[int, int, int]]:
    """Blocks ``(start in a, start in b, lines)`` of the patience alignment of two line sequences."""
    matched: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, j, k, m = todo.pop()
        while i < j and k < m and a[i] == b[k]:
            matched.append((i, k))
            i, k = i + 1, k + 1
        while i < j and k < m and a[j - 1] == b[m - 1]:
            j, m = j - 1, m - 1
            matched.append((j, m))
        if i == j or k == m:
            continue
        count: dict[int, list[int]] = {}
        for side, (x, start, end) in enumerate(((a, i, j), (b, k, m))):
            for p in range(start, end):
                c = count.setdefault(x[p], [0, 0, 0, 0])
                c[2 * side] += 1
                c[2 * side + 1] = p
        anchors = sorted((c[1], c[3]) for c in count.values() if c[0] == c[2] == 1)
        if not anchors:
            if any(c[0] and c[2] for c in count.values()):
                x, y, n = longest_run(a[i:j], b[k:m])
                matched += [(i + x + r, k + y + r) for r in range(n)]
                todo += [(i, i + x, k, k + y), (i + x + n, j, k + y + n, m)]
            continue
        tails: list[int] = []
        last: list[int] = []
        back: list[int] = []
        for n, (_, q) in enumerate(anchors):
            at = bisect_left(tails, q)
            if at == len(tails):
                tails.append(q)
                last.append(n)
            else:
                tails[at], last[at] = q, n
            back.append(last[at - 1] if at else -1)
        run, n = [], last[-1]
        while n >= 0:
            run.append(anchors[n])
            n = back[n]
        p, q = i, k
        for x, y in [*reversed(run), (j, m)]:
            todo.append((p, x, q, y))
            if x < j:
                matched.append((x, y))
            p, q = x + 1, y + 1
    blocks: list[tuple[int, int, int]] = []
    for x, y in sorted(matched):
        if blocks and blocks[-1][0] + blocks[-1][2] == x and blocks[-1][1] + blocks[-1][2] == y:
            blocks[-1] = (*blocks[-1][:2], blocks[-1][2] + 1)
        else:
            blocks.append((x, y, 1))
    return blocks


def _lines(chunk: _text.Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and words of every line, and each document's first line."""
    starts, ends, first = chunk.lines()
    word_starts, _, _ = chunk.spans(_text.NOT_SPACE)
    return chunk.hashes(starts, ends, _text.AS_IS), np.searchsorted(word_starts, ends) - np.searchsorted(word_starts, starts), first


def _runs(h: np.ndarray, words: np.ndarray, first: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The nominating runs of lines: hash, first line and line behind the last.

    From each line with a word on, and up to it, the fewest lines that hold ``min_words`` words; a single line keeps its hash.
    """
    upto = np.concatenate([[0], np.cumsum(words, dtype=np.int64)])
    at = np.flatnonzero(words > 0)
    doc = np.searchsorted(first, at, "right") - 1
    behind = np.searchsorted(upto, upto[at] + min_words)
    ahead = np.searchsorted(upto, upto[at + 1] - min_words, "right") - 1
    start, end = np.concatenate([at, ahead]), np.concatenate([behind, at + 1])
    inside = (start >= np.tile(first[doc], 2)) & (end <= np.tile(first[doc + 1], 2)) & (upto[np.minimum(end, len(words))] - upto[np.maximum(start, 0)] >= min_words)
    start, end = start[inside], end[inside]
    power, inverse = _text._powers_to(len(h) + 1)
    total = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * power[: len(h)], out=total[1:])
    several = _text.mix((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64))
    return np.where(end - start == 1, h[start], several), start, end


def _nominating(min_words: int, bloom=None):
    """Rows ``(line, doc_id, row)``: each nominating run once a document."""

    def run(batches):
        for batch in batches:
            for chunk in _text.chunks(batch.column("text")):
                h, words, first = _lines(chunk)
                keys, start, _ = _runs(h, words, first, min_words)
                if bloom is not None:
                    keep = _bloom.may_hold(bloom.value, keys)
                    keys, start = keys[keep], start[keep]
                doc = np.searchsorted(first, start, "right") - 1
                order = np.lexsort((keys, doc))
                keys, doc = keys[order], doc[order]
                new = np.ones(len(keys), bool)
                new[1:] = (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])
                own = [batch.column(c).slice(chunk.first, chunk.n_docs).take(pa.array(doc[new])) for c in ("doc_id", "row")]
                yield pa.RecordBatch.from_arrays([pa.array(keys[new].view(np.int64)), *own], ["line", "doc_id", "row"])

    return run


def _sequences(wanted):
    """The lines of the rows that are wanted, and of few others."""

    def run(batches):
        for batch in batches:
            batch = batch.filter(pa.array(_bloom.may_hold(wanted.value, batch.column("row").to_numpy(zero_copy_only=False))))
            for chunk in _text.chunks(batch.column("text")):
                h, words, first = _lines(chunk)
                cut = list(zip(first.tolist(), first[1:].tolist()))
                yield pa.RecordBatch.from_arrays([batch.column("row").slice(chunk.first, chunk.n_docs), pa.array([h[a:b].tobytes() for a, b in cut], pa.binary()), pa.array([words[a:b].astype(np.int32).tobytes() for a, b in cut], pa.binary())], ["row", "lines", "words"])

    return run


def _stays(blocks: list[tuple[int, int, int, int]], n: int) -> np.ndarray:
    """Which of ``n`` lines no block covers."""
    edge = np.zeros(n + 1, np.int64)
    for p, _, lines, _ in blocks:
        edge[p] += 1
        edge[p + lines] -= 1
    return np.cumsum(edge[:-1]) == 0


def common_blocks(h: np.ndarray, words: np.ndarray, kept: np.ndarray, kept_words: np.ndarray, min_words: int = MIN_WORDS) -> list[tuple[int, int, int, int]]:
    """Blocks ``(start, start in the kept document, lines, words)`` of two line sequences, all of them from alignments.

    The first alignment is of the whole sequences. What it leaves is aligned again: the remaining lines with the
    whole kept document, then each stretch of them that goes on like a stretch of the kept document with that one.
    """
    own, other = h.tolist(), kept.tolist()
    out: list[tuple[int, int, int, int]] = []

    def align(start: int, end: int, low: int, high: int, free: np.ndarray | None = None) -> None:
        # Lines that are gone match nothing, each being of its own kind.
        left = own[start:end] if free is None else [x if f else -1 - p for p, (x, f) in enumerate(zip(own[start:end], free[start:end]))]
        out.extend((start + p, low + q, n, w) for p, q, n in patience(left, other[low:high]) if (w := int(words[start + p : start + p + n].sum())) >= min_words)

    align(0, len(own), 0, len(other))
    keys, start, end = _runs(h, words, np.array([0, len(h)]), min_words)
    known, known_start, _ = _runs(kept, kept_words, np.array([0, len(kept)]), min_words)
    found, index = np.unique(known, return_index=True)
    if not len(keys) or not len(found):
        return out
    where = np.minimum(np.searchsorted(found, keys), len(found) - 1)
    held = found[where] == keys
    start, end, source = start[held], end[held], known_start[index[where[held]]]

    def open_runs() -> np.ndarray:
        stays = np.concatenate([[0], np.cumsum(_stays(out, len(own)))])
        return np.flatnonzero(stays[end] > stays[start])  # runs with a line that no block covers

    if len(open_runs()):
        align(0, len(own), 0, len(other), _stays(out, len(own)))
    moved: list[list[int]] = []
    at = open_runs()
    for p, e, q in sorted(zip(start[at].tolist(), end[at].tolist(), source[at].tolist())):
        if moved and p <= moved[-1][1] and p - moved[-1][0] == q - moved[-1][2]:  # goes on in both
            moved[-1][1] = max(e, moved[-1][1])
        else:
            moved.append([p, e, q])
    for p, e, q in moved:
        align(p, e, q, q + e - p)
    return out


def _align(min_words: int):
    names = ["doc_id", "row", "kept_doc_id", "first_line", "last_line", "kept_first_line", "n_words"]

    def run(batches):
        for batch in batches:
            rows: list[tuple] = []
            for doc, row, keeps, *four in zip(*(batch.column(c) for c in ("doc_id", "row", "kept_doc_id", "lines", "words", "kept_lines", "kept_words"))):
                h, words, kept, kept_words = (np.frombuffer(x.as_buffer(), t) for x, t in zip(four, (np.uint64, np.int32) * 2))
                rows += [(doc.as_py(), row.as_py(), keeps.as_py(), p, p + n - 1, q, w) for p, q, n, w in common_blocks(h, words, kept, kept_words, min_words)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [()] * 7)], names)

    return run


_BLOCK = "doc_id long, row_hash long, kept_doc_id long, first_line long, last_line long, kept_first_line long, n_words long"


def partners(rows: DataFrame, min_words: int) -> DataFrame:
    """``(doc_id, row, lead)`` of the pairs to align, ``lead`` being the kept document's ``(doc_id, row)``."""
    schema = "line long, doc_id long, row long"
    own = F.struct("doc_id", "row")
    counted = rows.mapInArrow(_nominating(min_words), schema).groupBy("line").agg(F.min(own).alias("lead"), F.max(own).alias("last"), F.count("*").alias("n"))
    shared = _spark.saved(counted.where("lead <> last").select("line", "lead", "n"), "line-shared")
    held = _spark.saved(rows.mapInArrow(_nominating(min_words, _bloom.build(shared, "line")), schema).distinct(), "line-held")
    later = _spark.looked_up(held, shared, "line", held.count()).where(own != F.col("lead"))
    later = _spark.saved(later, "line-later")
    rarest = later.groupBy("doc_id", "row").agg(F.min(F.struct("n", "lead")).alias("r")).select("doc_id", "row", F.col("r.lead").alias("lead"))
    rarest = _spark.saved(rarest, "line-rarest")
    partner = later.join(rarest.select("row", F.col("doc_id").alias("of"), F.col("lead.row").alias("partner")), "row").where("doc_id = of")
    partner = _spark.saved(partner.select("doc_id", "row", "lead", "partner", "line"), "line-partners")
    has = held.select(F.col("row").alias("partner"), "line").distinct()
    lacks = partner.groupBy("partner", "line").agg(F.count("*").alias("n")).join(has, ["partner", "line"], "left_anti")
    rest = _spark.looked_up(partner, _spark.saved(lacks, "line-lacks"), ["partner", "line"], partner.count()).select("doc_id", "row", "lead")
    return _spark.saved(rarest.unionByName(rest).distinct(), "line-pairs")


def aligned_blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """The blocks to delete: ``doc_id``, ``row_hash`` (of id and text), ``kept_doc_id``, lines from 0, and the words of the block.

    One row for each block of each pair; blocks of different partners may overlap. Rows with a
    null id take no part; rows with equal id and text are one document, other rows of one id are documents of their
    own, in the order of ``row_hash``; null and empty texts, and an empty table, give no rows. Other columns are ignored.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")).where("doc_id is not null and text is not null")
    rows = rows.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), "text")
    pairs = partners(rows, min_words)
    ids = _spark.saved(pairs.select("row").unionAll(pairs.select(F.col("lead.row").alias("row"))).distinct(), "line-ids")
    sequences = rows.select("row", "text").mapInArrow(_sequences(_bloom.build(ids, "row")), "row long, lines binary, words binary")
    sequences = _spark.saved(sequences.groupBy("row").agg(F.first(F.struct("lines", "words")).alias("s")).select("row", "s.*"), "line-sequences")
    # A kept document with many partners is dealt to as many tasks as it takes.
    blocks = pairs.groupBy(F.col("lead.row").alias("kept")).agg(F.count("*").alias("n")).withColumn("blocks", F.ceil(F.col("n") / PAIRS).cast("int"))
    blocks = _spark.saved(blocks, "line-blocks")
    dealt = _spark.looked_up(pairs.select("doc_id", "row", F.col("lead.doc_id").alias("kept_doc_id"), F.col("lead.row").alias("kept")), blocks, "kept", pairs.count())
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int")).drop("n", "blocks")
    kept = sequences.withColumnRenamed("row", "kept").join(blocks, "kept").select("kept", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.col("lines").alias("kept_lines"), F.col("words").alias("kept_words"))
    both = dealt.join(sequences, "row").join(kept, ["kept", "block"]).select("doc_id", "row", "kept_doc_id", "lines", "words", "kept_lines", "kept_words")
    return _spark.saved(both.mapInArrow(_align(min_words), _BLOCK.replace("row_hash", "row")).withColumnRenamed("row", "row_hash"), "line-found")


def delete_blocks(docs: DataFrame, blocks: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the lines of ``blocks`` cut out of the text; other columns and rows as they are."""
    gone = blocks.select("row_hash", F.explode(F.sequence("first_line", "last_line")).alias("line")).groupBy("row_hash").agg(F.collect_set("line").alias("lines"))  # lines of one document
    name, at = _spark.free_name(docs, "cut_id"), _spark.free_name(docs, "cut_lines")
    cut = gone.select(F.col("row_hash").alias(name), F.col("lines").alias(at))
    text = F.col(f"`{text_col}`")
    own = F.xxhash64(F.col(f"`{id_col}`").cast("long"), text.cast("string"))
    kept = F.filter(F.transform(F.split(text, "\n"), lambda x, k: F.struct(x.alias("x"), k.cast("long").alias("k"))), lambda s: ~F.array_contains(F.col(at), s["k"]))
    new = F.when(F.col(at).isNull(), text).otherwise(F.array_join(F.transform(kept, lambda s: s["x"]), "\n"))
    return docs.join(cut, own == F.col(name), "left").select(*[new.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])
