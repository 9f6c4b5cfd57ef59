"""Sharding, Jaccard join, passage and line dedup, mixing, components, the pipeline."""

import hashlib
import random
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortwatch.llm import _bloom, _pivots, _spark, line_dedup, mixing, ngram_join, passage_dedup, queries, sharding

SF = "/root/testdata/sf0.001"


def prose(rng, n):
    return [f"{rng.choice('bcdfghklmnprst')}{rng.choice('aeiou')}{rng.randrange(300)}" for _ in range(n)]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=60), st.integers(100, 300))
def test_best_fit_decreasing(sizes, capacity):
    items = [(s, str(k)) for k, s in enumerate(sizes)]
    sharding.Bins.LEAF = 4  # so that leaves are split
    where, used = sharding.best_fit_decreasing(items, capacity)
    assert len(where) == len(items) and all(u <= capacity for u in used) and sum(used) == sum(sizes)
    # Plain best fit, by scanning all bins.
    bins: list[int] = []
    for s, _ in sorted(items, key=lambda x: (-x[0], x[1])):
        fits = [b for b, u in enumerate(bins) if u + s <= capacity]
        if fits:
            bins[max(fits, key=lambda b: bins[b])] += s
        else:
            bins.append(s)
    assert sorted(bins) == sorted(used)


def check_shards(rows, n):
    by_text, slots, sizes = defaultdict(set), defaultdict(list), Counter()
    for r in rows:
        by_text[r.text].add(r.shard)
        slots[r.shard].append(r.slot)
        sizes[r.shard] += len((r.text or "").encode()) + 1
    assert all(len(v) == 1 for v in by_text.values()) and all(0 <= s < n for s in slots)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    return sizes


def test_shards(documents, messy, monkeypatch):
    monkeypatch.setattr(sharding, "CELL_ROWS", 3)
    rows = sharding.assign_shards(documents, 16).collect()
    sizes = check_shards(rows, 16)
    assert len(rows) == documents.count() and max(sizes.values()) <= 1.02 * sum(sizes.values()) / 16
    again = sharding.assign_shards(documents.repartition(7), 16)
    assert {(r.doc_id, r.shard, r.slot) for r in rows} == {(r.doc_id, r.shard, r.slot) for r in again.collect()}
    odd = sharding.assign_shards(messy, 4).collect()
    assert len(odd) == messy.count()
    check_shards(odd, 4)
    assert sharding.assign_shards(messy.limit(0), 4).count() == 0
    capped = sharding.assign_shards(documents, text_col="text", capacity=50_000).collect()
    sizes = check_shards(capped, 10**6)
    assert max(sizes.values()) <= 50_000 and len(sizes) <= 1.3 * sum(sizes.values()) / 50_000 + 1
    assert set(sizes) == set(range(len(sizes)))


def test_no_shard_is_over_capacity(spark, monkeypatch):
    monkeypatch.setattr(sharding, "PACK_GROUPS", 4000)
    docs = spark.range(30_000).selectExpr("id as doc_id", "concat('t', id) as text", "if(id % 50 = 0, 1 + id % 900, 1 + id % 3) as weight")
    docs = docs.unionAll(spark.createDataFrame([(-1, "larger than any shard", 5000)], docs.schema))
    rows = sharding.assign_shards(docs, capacity=2000, size=F.col("weight")).groupBy("shard").agg(F.sum("weight").alias("size"), F.count("*").alias("n"), F.max("slot").alias("slot")).collect()
    total = sum(r.size for r in rows)
    assert sorted(r.size for r in rows)[-1] == 5000 and sum(r.size > 2000 for r in rows) == 1 and next(r.n for r in rows if r.size == 5000) == 1
    assert sorted(r.shard for r in rows) == list(range(len(rows))) and all(r.slot == r.n - 1 for r in rows)
    assert len(rows) <= (total - 5000) / 2000 + 2 + 8  # a part of a shard for each of eight tasks
    assert sharding.assign_shards(docs.limit(0), capacity=10).count() == 0


@pytest.mark.parametrize("seed", range(2))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(30)] + [(k, k + 1) for k in range(100, 130)] + [(200, k) for k in range(201, 240)] + [(300, 300)]
    got = {r.id: r.component for r in _spark.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == brute.components(edges, sorted({v for e in edges for v in e}))


def test_bloom_misses_nothing(spark):
    keys = spark.range(5000).select(F.xxhash64("id").alias("k"))
    bits = _bloom.build(keys, "k").value
    own = np.array([r.k for r in keys.collect()], np.int64)
    assert _bloom.may_hold(bits, own).all() and _bloom.may_hold(bits, own + 1).mean() < 0.01
    assert not _bloom.may_hold(_bloom.build(keys.limit(0), "k").value, own).any()


def planted(seed=1):
    """Copies, a chain of near copies, a large group with many variants and outliers, short texts."""
    rng = random.Random(seed)
    docs, base = [], prose(rng, 120)
    for k in range(40):
        w = list(base)
        for _ in range(rng.randrange(9)):
            w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
        docs.append(" ".join(w))
    step = prose(rng, 100)
    for k in range(8):
        step = step[3:] + prose(rng, 3)
        docs.append(" ".join(step))
    for _ in range(20):
        docs.append(" ".join(prose(rng, rng.randrange(1, 60))))
    docs += [docs[0]] * 3 + ["a b", "A  b", "a b c", "a", "a", "", "  ", None, None, docs[3].upper(), "x y z w v", "x y z w v u"]
    return [(k * 3 + 1, t) for k, t in enumerate(docs)]


def same_components(spark, docs):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == brute.jaccard_components(docs)


def test_jaccard_components(spark):
    same_components(spark, planted())


@pytest.mark.parametrize("rounds", [0, 2])
def test_jaccard_components_with_many_pivots(spark, monkeypatch, rounds):
    # All open lists are split by a second element, and dealt in blocks.
    monkeypatch.setattr(_spark, "HOT_KEYS", 5)
    for name, value in (("OPEN_PAIRS", 0), ("PIVOT_ROUNDS", rounds), ("ALL_PAIRS", 0), ("BLOCK", 3)):
        monkeypatch.setattr(_pivots, name, value)
    same_components(spark, planted(2))


def test_hot_keys_are_looked_up_apart(spark, monkeypatch):
    monkeypatch.setattr(_spark, "HOT_KEYS", 10)
    rows = spark.range(300).selectExpr("id", "if(id % 2 = 0, 0, id % 50) as k").cache()
    table = rows.groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("top"))
    got = {(r.id, r.top) for r in _spark.looked_up(rows, table, "k", 300).collect()}
    top = {r.k: r.top for r in table.collect()}
    assert got == {(k, top[0 if k % 2 == 0 else k % 50]) for k in range(300)}


def test_keep_one_decides_by_rows(spark):
    rng = random.Random(8)
    a, q, z = (" ".join(prose(rng, 60)) for _ in range(3))
    near = a.replace(a.split()[30], "changed", 1)
    kept = lambda rows: sorted((r.doc_id or 0, r.text or "") for r in ngram_join.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert kept([(1, a), (5, a), (5, z)]) == sorted([(1, a), (5, z)])
    assert kept([(7, q), (7, z)]) == sorted([(7, q), (7, z)])
    assert kept([(7, q), (7, q), (7, z), (None, a), (9, near), (3, None), (3, None), (4, " ")]) == sorted([(7, q), (7, z), (9, near), (3, ""), (3, ""), (4, " ")])


def test_jaccard_of_messy_rows(spark, messy):
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(messy).collect())
    want = {(1, 11, 1): 1, (2, 11, 1): 2, (None, 11, 1): 1, (3, 0, 3): 1, (None, 0, None): 1, (4, 0, 4): 1, (5, 0, 5): 1, (6, 1, 6): 1, (7, 29996, 7): 1}
    assert all(got[k] == n for k, n in want.items()) and sum(got.values()) == messy.count()
    kept = ngram_join.keep_one(messy)
    assert kept.columns == messy.columns and sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == [1, 3, 4, 5, 6, 7, 8]
    assert ngram_join.jaccard_components(messy.limit(0)).count() == 0


SETS = st.sets(st.integers(0, 400), max_size=60)


@settings(max_examples=200, deadline=None)
@given(SETS, SETS)
def test_filters_never_drop_a_link(a, b):
    x, y = (np.sort(np.array([v * 0x2545F4914F6CDD1D % 2**58 for v in s], np.uint64)) for s in (a, b))
    both = len(a & b)
    assert ngram_join.suffix_allows(x, y, both)
    h = ngram_join._histograms(np.concatenate([x, y]), np.array([0, len(x), len(x) + len(y)]))
    assert ngram_join.overlap_bound(*(np.frombuffer(v.as_buffer(), np.uint8) for v in h)) >= both


def test_tuned_bands():
    for similarity, recall in ((0.8, 0.99), (0.8, 0.999), (0.5, 0.95)):
        b, r = passage_dedup.tune(similarity, recall)
        assert 1 - (1 - similarity**r) ** b >= recall
    with pytest.raises(ValueError):
        passage_dedup.tune(0.1, 0.9999, most=4)


def test_passages(spark, messy):
    rng = random.Random(5)
    shared = [prose(rng, n) for n in (51, 60, 80, 20)]
    docs = [prose(rng, rng.randrange(30, 200)) for _ in range(40)]
    holders = defaultdict(list)
    free = rng.sample(range(30), 30)
    for k, s in enumerate(shared):
        for d in (free.pop() for _ in range(2 + 3 * (k == 1))):
            at = rng.randrange(len(docs[d]) + 1)
            docs[d] = docs[d][:at] + s + docs[d][at:]
            holders[k].append(d)
    rows = [(d, "\n".join(" ".join(w[i : i + 7]) for i in range(0, len(w), 7))) for d, w in enumerate(docs)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = passage_dedup.repeated_passages(table)
    got = found.collect()
    assert {r.doc_id for r in got} == brute.repeats(rows) | set(holders[0]) | set(holders[1]) | set(holders[2])
    assert {r.doc_id for r in got if not r.removed} | {r.doc_id for r in got if r.removed} == {r.doc_id for r in got}
    for k in (0, 1, 2):
        for d in sorted(holders[k])[1:]:
            assert any(r.doc_id == d and r.removed and r.n_words >= len(shared[k]) for r in got), (k, d)
    cleaned = [(r.doc_id, r.text) for r in passage_dedup.delete_passages(table, found).collect()]
    assert len(cleaned) == len(rows) and not brute.repeats(cleaned)
    odd = passage_dedup.repeated_passages(messy)
    assert odd.count() == 0 and passage_dedup.delete_passages(messy, odd).columns == messy.columns
    assert passage_dedup.repeated_passages(messy.limit(0)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 9), max_size=25), st.lists(st.integers(0, 9), max_size=25))
def test_patience_blocks_are_common_and_in_order(a, b):
    blocks = line_dedup.patience(a, b)
    assert all(n > 0 and a[p : p + n] == b[q : q + n] for p, q, n in blocks)
    assert all(x[0] + x[2] <= y[0] and x[1] + x[2] <= y[1] for x, y in zip(blocks, blocks[1:]))
    once = [v for v in set(a) if a.count(v) == 1 == b.count(v)]
    if len(once) == 1:  # a line that is unique in both is aligned unless head or tail took its place
        assert blocks
    assert line_dedup.patience(a, a) == ([(0, 0, len(a))] if a else [])


def test_lines(documents, texts, messy):
    blocks = line_dedup.aligned_blocks(documents)
    got = blocks.collect()
    lines = {k: (t or "").split("\n") for k, t in texts}
    size = {x: len(brute.SPACE.findall(x)) for own in lines.values() for x in own}
    gone = defaultdict(set)
    for r in got:
        p, q, n = r.first_line, r.kept_first_line, r.last_line - r.first_line + 1
        assert r.kept_doc_id < r.doc_id and lines[r.doc_id][p : p + n] == lines[r.kept_doc_id][q : q + n]
        assert r.n_words == sum(size[x] for x in lines[r.doc_id][p : p + n]) >= line_dedup.MIN_WORDS
        gone[r.doc_id] |= set(range(p, p + n))
    cut = line_dedup.delete_blocks(documents, blocks)
    assert {r.doc_id: r.text for r in cut.collect()} == {k: "\n".join(x for i, x in enumerate(own) if i not in gone[k]) for k, own in lines.items()}
    odd = line_dedup.aligned_blocks(messy)
    assert {(r.doc_id, r.kept_doc_id) for r in odd.collect()} == {(2, 1), (8, 1)}
    assert line_dedup.delete_blocks(messy, odd).columns == messy.columns and line_dedup.aligned_blocks(messy.limit(0)).count() == 0


def water_fill(sizes, share=1.5, cap=2.0):
    """Targets of {source: size}, None last."""
    order = sorted(sizes, key=lambda k: (k is None, k))
    weight = {k: mixing.WEIGHTS[i % 3] for i, k in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), set(order), {}
    while open_:
        unit = left / sum(weight[k] for k in open_)
        full = {k for k in open_ if unit * weight[k] > cap * sizes[k]}
        if not full:
            return out | {k: unit * weight[k] for k in open_}
        out |= {k: cap * sizes[k] for k in full}
        left -= sum(out[k] for k in full)
        open_ -= full
    return out


def test_mix(documents, messy, monkeypatch):
    monkeypatch.setattr(mixing, "CELL_ROWS", 10)
    docs = documents.withColumn("source", F.expr("case when doc_id % 9 = 0 then null when doc_id % 3 = 0 then 'big' when doc_id % 2 = 0 then 'a' else 'é' end"))
    rows = mixing.mix(docs).collect()
    sizes, taken = Counter(), Counter()
    for r in rows:
        assert r.size == len(brute.words(r.text)) and 0 <= r.copies <= 2
        sizes[r.source] += r.size
        taken[r.source] += r.size * r.copies
    target = water_fill(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
    for k, t in target.items():
        assert abs(taken[k] - t) <= max(0.03 * t, 40)
    again = mixing.mix(docs.repartition(5)).collect()
    assert {(r.doc_id, r.copies) for r in rows} == {(r.doc_id, r.copies) for r in again}
    mixed = Counter(r.doc_id for r in mixing.mixed_rows(docs).collect())
    assert mixed == Counter({r.doc_id: r.copies for r in rows if r.copies})
    odd = mixing.mix(messy)
    assert odd.count() == messy.count() and mixing.mixed_rows(messy).columns == messy.columns
    assert mixing.mix(messy.limit(0)).count() == 0


def pareto_walk(rows, goal, bits):
    """The passes of a mix on a plain list of (size, rank, id): ids taken."""
    left, most, since, took = goal, goal, -1.0, set()
    while True:
        open_ = sorted((rank, k, size) for size, rank, k in rows if size <= most and rank > since)
        sums = np.cumsum([size for *_, size in open_])
        n = int((sums <= left).sum())
        took |= {k for _, k, _ in open_[:n]}
        left -= int(sums[n - 1]) if n else 0
        if n == len(open_) or left <= mixing.NEAR * goal:
            break
        # Where no document of the cut's cell fits, the next pass starts at that cell.
        cell = int(open_[n][0] * (1 << bits))
        since = open_[n - 1][0] if n and int(open_[n - 1][0] * (1 << bits)) == cell else np.nextafter(cell / (1 << bits), -1)
        most = left / 2
    near = [(abs(size - left), rank, k) for size, rank, k in rows if k not in took and abs(size - left) < left]
    return took | ({min(near)[2]} if near else set())


@pytest.mark.parametrize("level_bits", [2, 12])
def test_mix_passes_over_long_documents(spark, monkeypatch, level_bits):
    monkeypatch.setattr(mixing, "CELL_ROWS", 10)
    monkeypatch.setattr(mixing, "LEVEL_BITS", level_bits)
    rng = random.Random(5)
    sizes = {k: 40_000 if k % 200 == 3 else rng.choice([1, 7, 90, 100, 110]) for k in range(600)}
    docs = spark.createDataFrame([(k, "s", "w " * n) for k, n in sizes.items()], "doc_id long, source string, text string")
    for seed in range(2):
        rows = mixing.mix(docs, share=0.4, seed=seed)
        goal = 0.4 * sum(sizes.values())
        got = {r.doc_id for r in rows.collect() if r.copies}
        assert abs(sum(sizes[k] for k in got) - goal) < 0.01 * goal
        u = (F.pmod(F.xxhash64("doc_id", "size", F.lit(seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
        ranks = [(r.size, (o := r.u / (1 - r.u) / (0.4 / 0.6)) / (1 + o), r.doc_id) for r in rows.select("doc_id", "size", u.alias("u")).collect()]
        assert got == pareto_walk(ranks, goal, (600 // 10).bit_length())


@pytest.mark.parametrize("kind", ["null ids", "one id", "equal rows", "equal rows and others"])
def test_mix_of_rows_without_ids_of_their_own(spark, kind):
    """Sources of rows that share their id, or all they have, come as near to their targets as others; reruns agree."""
    text = {"null ids": "concat('w', id, ' a b')", "one id": "concat('w', id, ' a b')", "equal rows": "'w a b'", "equal rows and others": "if(id % 3 = 0, concat('w ', repeat(' x', int(id % 40))), 'w a b')"}[kind]
    docs = spark.range(0, 900, 1, 5).selectExpr("if('%s' = 'null ids', cast(null as bigint), if('%s' = 'one id', 7, if(id %% 3 = 0, id, null))) as doc_id" % (kind, kind), f"{text} as text", "'s' as source", "'c' as copies", "'k' as row", "id as other")
    if kind == "equal rows":
        docs = docs.withColumn("doc_id", F.lit(None).cast("long"))
    rows = mixing.mix(docs, share=0.5).collect()
    target, taken = rows[0].target, sum(r.size * r.copies for r in rows)
    assert len(rows) == 900 and abs(taken - target) <= 3 and {r.copies for r in rows} <= {0, 1} and len({r.other for r in rows}) == 900
    again = mixing.mix(docs.repartition(3, "text"), share=0.5).collect()
    assert Counter((r.doc_id, r.text, r.copies) for r in rows) == Counter((r.doc_id, r.text, r.copies) for r in again)
    assert sum(len(r.text.split()) for r in mixing.mixed_rows(docs, share=0.5).collect()) == taken


def test_importance_raises_the_odds(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "'a b' as text", "if(id < 2000, 'x', 'y') as source", "if(id % 2 = 0, 3, 1) as worth")
    rows = mixing.mix(docs, weights=(1.0,), share=0.3, importance=F.col("worth")).groupBy("worth").agg(F.sum("copies").alias("n")).collect()
    n = {r.worth: r.n for r in rows}
    assert sum(n.values()) == 1200 and n[3] > 2 * n[1]


def test_pipeline(spark):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 120")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = _spark.saved(stage(spark, docs, SF), name)
        kept[name] = [r.doc_id for r in docs.collect()]
        assert docs.columns[: len(columns)] == columns and set(kept[name]) <= {r.doc_id for r in before.collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    good = kept["quality_rules"]
    assert not [k for k in good if (m := brute.quality(texts[k]))[0] < 10 or 100 * m[4] > 20 * m[0]]
    want = brute.jaccard_components([(k, texts[k]) for k in good])
    assert sorted(kept["near_duplicates"]) == sorted(k for k in good if want[k][1] == k)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = [k for k in kept["near_duplicates"] if not ((c := brute.contamination(texts[k], items))[1] and 20 * c[1] >= c[0])]
    assert sorted(kept["decontamination"]) == sorted(clean)
    assert max(Counter(kept["source_mix"]).values()) <= 2 and Counter(kept["shards"]) == Counter(kept["source_mix"])
    assert docs.columns == [*columns, "shard", "slot"]


def test_registered_queries(spark):
    assert sorted(int(k[2:].split("_")[0]) for k in queries.queries()) == list(range(1, 14)) and set(queries.oracle_sql()) <= set(queries.queries())


def run_stages(spark, tmp_path, docs):
    """All stages over a folder with these documents, each stage's rows read back."""
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    benchmark.unionByName(spark.createDataFrame([(None, None), (None, "")], benchmark.schema)).write.parquet(str(tmp_path / "benchmark.parquet"))
    rows, found = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in corpus_pipeline.STAGES:
        rows = _spark.saved(stage(spark, rows, str(tmp_path)), name)
        assert name == "shards" or rows.columns == docs.columns
        found[name] = rows.collect()
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(found["shards"])
    return found


def test_pipeline_over_messy_rows(spark, tmp_path, messy):
    """Nulls in every column, repeated rows, a very long text, clashing names: what is clean stays, once a group of copies."""
    prose = "a clean document about rivers and hills with plenty of different plain words that nothing else in this table repeats at all"
    more = spark.createDataFrame([(100, prose, "en", "s9"), (101, None, "en", None)], "doc_id long, text string, lang string, source string")
    docs = messy.unionByName(more, allowMissingColumns=True)
    found = run_stages(spark, tmp_path, docs)
    texts = lambda name: Counter(r.text for r in found[name])
    assert None not in texts("quality_rules") and prose in texts("quality_rules")
    assert max(texts("near_duplicates").values()) == 1 and set(texts("near_duplicates")) <= set(texts("quality_rules"))
    assert texts("decontamination") == texts("near_duplicates") and prose in texts("decontamination")
    assert max(texts("source_mix").values()) <= 2 and texts("shards") == texts("source_mix")


def test_pipeline_over_an_empty_table(spark, tmp_path, messy):
    assert all(rows == [] for rows in run_stages(spark, tmp_path, messy.limit(0)).values())


@pytest.mark.parametrize("shards", [3, 16])
def test_shards_are_those_of_a_plain_best_fit(documents, shards):
    """Groups that enter one by one, against best fit decreasing by looking at every bin."""
    size = {r.text: 0 for r in documents.select("text").collect()}
    for r in documents.select("text").collect():
        size[r.text] += len((r.text or "").encode()) + 1
    total = sum(size.values())
    while True:  # what is gathered into parcels is left out
        large = {t: n for t, n in size.items() if n > max(1, total // (shards * sharding.FINE))}
        if len(large) == len(size):
            break
        size, total = large, sum(large.values())
    room, where = [-(-total // shards)] * shards, {}
    key = {t: "null" if t is None else hashlib.md5(t.encode()).hexdigest() for t in size}
    for t, n in sorted(size.items(), key=lambda x: (-x[1], key[x[0]])):
        fits = [(r, b) for b, r in enumerate(room) if r >= n]
        b = min(fits)[1] if fits else max((r, b) for b, r in enumerate(room))[1]
        room[b] -= n
        where[t] = b
    wanted = documents.sparkSession.createDataFrame([(t,) for t in size], "text string")
    got = sharding.assign_shards(documents.join(wanted, "text", "left_semi"), shards).select("text", "shard").collect()
    assert len(size) > 100 and all(r.shard == where[r.text] for r in got) and {r.text for r in got} == set(size)
