"""Mixing sources to target weights by Pareto order sampling.

A source's target over its size is the number of copies that each of its words should get: the
whole part is certain, every document gets that many copies. The rest is an unequal-probability
sample of fixed size: with ``u`` a document's uniform number (a hash of its id and the seed) and
``p`` its inclusion probability, documents are taken in the order of ``(u / (1 - u)) / (p / (1 -
p))`` until the source's remaining words are used up. ``p`` is the source's remaining fraction, or
scaled by an importance column. Extra copies stop at the cap.

A document that doesn't fit in what is left is passed over and the order followed further with the
documents of up to half of what is left, so that each pass halves it, until it is a ``NEAR`` part of
the target or no such document remains. The document nearest to the rest ends the sample.

A pass is found without ordering a source in one task: words are added up in cells of the order, at
most 4,096 per source and level, and only the cell in which the cut falls is split up or ordered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortwatch.llm import _spark

WEIGHTS = (3, 1, 2)
CELL_ROWS = 2_000
#: The part of its target that a source's sample may leave open without another pass.
NEAR = 0.001
#: A level of cells splits each cell of the level above in 2 to the power of this.
LEVEL_BITS = 12


def word_count(text: Column) -> Column:
    """Words between ASCII white space, without splitting the text: non-space characters at a word's start."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """``sizes(src, source_size)`` with ``weight`` and ``target``.

    Sources in code point order, null last, weigh ``weights``, repeating. Targets share ``share`` times all
    sizes by weight; one above ``cap`` times its source's size stops there and the excess is reshared
    until none is above. Only sums over the sources come to the driver.
    """
    key = F.struct(F.col("src").isNull(), "src")
    spread = sizes.repartitionByRange(F.col("src").asc_nulls_last()).sortWithinPartitions(F.col("src").asc_nulls_last())
    spread = _spark.saved(spread.withColumn("at", F.monotonically_increasing_id()), "mix-order")
    parts = spread.groupBy(F.shiftright("at", 33).alias("part")).agg(F.count("*").alias("n"), F.min(key).alias("first")).orderBy("first").collect()  # a row a partition
    before, offset = [], 0
    for r in parts:
        before.append((r.part, offset))
        offset += r.n
    if not before:
        return spread.select("src", "source_size", F.lit(0.0).alias("weight"), F.lit(0.0).alias("target"))
    starts = sizes.sparkSession.createDataFrame(before, "part long, start long")
    n = F.col("start") + F.col("at").bitwiseAND((1 << 33) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(n, F.lit(len(weights))) + 1).cast("int"))
    weighed = spread.join(F.broadcast(starts), F.shiftright("at", 33) == F.col("part")).select("src", "source_size", weight.alias("weight"))
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    unit, full = 0.0, None
    while True:
        capped = F.col("weight") * unit > cap * F.col("source_size")
        r = weighed.agg(F.coalesce(F.sum(F.when(capped, F.col("source_size"))), F.lit(0)).alias("size"), F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0.0)).alias("weight"), F.count_if(capped).alias("n")).first()
        if r.n == full or not r.weight:
            break
        full, unit = r.n, (share * total - cap * r.size) / r.weight
    return weighed.withColumn("target", F.least(F.col("weight") * unit, cap * F.col("source_size")).cast("double"))


def _rank(u: Column, imp: Column, of) -> Column:
    """From 0 to 1, in the order of the odds ratio; ``of`` names the goals' columns."""
    part = F.least(F.greatest((of("ratio") - of("sure")) * imp / of("mean_imp"), F.lit(1e-9)), F.lit(1 - 1e-9))
    odds = (u / (1 - u)) / (part / (1 - part))
    return odds / (1 + odds)


def _place(rank: Column, key: Column, bits: int) -> Column:
    cell = F.least(F.floor(rank * (1 << bits)), F.lit((1 << bits) - 1)).cast("long")
    return F.struct(cell.alias("cell"), rank.alias("rank"), key.alias("key"))


def _taken(size: Column, place: Column, passes: Column) -> Column:
    """Whether one of a source's passes takes the document."""
    inside = lambda p: (size <= p["most"]) & (p["since"].isNull() | (place > p["since"])) & (p["upto"].isNull() | (place <= p["upto"]))
    return F.exists(passes, inside)


def _cuts(rows: DataFrame, bits: int, n_sources: int) -> DataFrame:
    """For ``rows(src, size, place, gap)`` the last ``upto`` before which a source's sizes add up to ``gap`` at most, and their sum ``got``.

    Sources all of whose rows fit have no row. ``upto`` is a row's place, or stands before all rows of its cell.
    Of rows at one place some may fit where all do not: ``part`` is that place, how many fit, and of how many.
    """
    at = None
    for shift in range((bits - 1) // LEVEL_BITS * LEVEL_BITS, -1, -LEVEL_BITS):
        inside = rows.withColumn("before", F.lit(0).cast("long")) if at is None else rows.join(_spark.small(at, n_sources), F.col("src").eqNullSafe(F.col("cs")) & (F.shiftright("place.cell", shift + LEVEL_BITS) == F.col("cut_cell")))
        sums = inside.groupBy("src", F.shiftright("place.cell", shift).alias("cell")).agg(F.sum("size").alias("words"), F.first("gap").alias("gap"), F.first("before").alias("before"))
        upto = sums.withColumn("upto", F.col("before") + F.sum("words").over(Window.partitionBy("src").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)))
        first = upto.where("upto > gap").groupBy("src").agg(F.min_by(F.struct(F.col("cell").alias("cut_cell"), (F.col("upto") - F.col("words")).alias("before")), "cell").alias("c"))
        at = _spark.saved(first.select(F.col("src").alias("cs"), "c.*"), "mix-cells")
    inside = rows.join(_spark.small(at, n_sources), F.col("src").eqNullSafe(F.col("cs")) & (F.col("place.cell") == F.col("cut_cell")))
    tied = inside.groupBy("src", "place").agg(F.sum("size").alias("words"), F.count("*").alias("n"), F.first("size").alias("size"), *[F.first(c).alias(c) for c in ("gap", "before", "cut_cell")])
    tied = tied.withColumn("upto", F.col("before") + F.sum("words").over(Window.partitionBy("src").orderBy("place")))
    fits = F.col("upto") <= F.col("gap")
    some = F.struct("place", F.floor((F.col("gap") - F.col("upto") + F.col("words")) / F.col("size")).cast("long").alias("k"), "n", "size")
    cut = tied.groupBy("src").agg(F.max(F.when(fits, F.col("place"))).alias("last"), F.max(F.when(fits, F.col("upto"))).alias("got"), F.min_by(some, F.when(~fits, F.col("place"))).alias("some"), F.first("before").alias("before"), F.first("cut_cell").alias("cut_cell"))
    start = F.struct(F.col("cut_cell").alias("cell"), F.lit(-1.0).alias("rank"), F.lit(None).cast("long").alias("key"))
    return cut.select(F.col("src").alias("cut_src"), F.coalesce("last", start).alias("upto"), (F.coalesce("got", "before") + F.coalesce(F.col("some.k") * F.col("some.size"), F.lit(0))).alias("got"), F.when(F.col("some.k") > 0, F.struct("some.place", "some.k", "some.n")).alias("part"))


def mix(docs: DataFrame, source_col: str = "source", id_col: str = "doc_id", size: Column | None = None, text_col: str = "text", weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, cap: float = 2.0, importance: Column | None = None, seed: int = 7) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``copies`` appended, one row per row of ``docs``.

    ``copies`` is how often the mix takes the document whole. A source's words come as near to its
    target as the last document allows, one very long document or not.
    ``importance`` (positive; null counts as 1) scales the inclusion odds within a source. Null
    texts have size 0; an empty table gives an empty result. Rows with the same id and size share a random
    number and are told apart by their texts, as are rows with null ids; of rows that are equal in all three
    as many are taken as the target asks for. A column of ``docs`` with the name of an appended one gives way.
    """
    added = ("size", "source_size", "target", "copies")
    own = [c for c in docs.columns if c.lower() not in added]
    if size is None:
        size = word_count(F.col(f"`{text_col}`").cast("string"))
    size = size.cast("long")
    src, key = F.col(f"`{source_col}`").cast("string"), F.col(f"`{id_col}`")
    weight = F.coalesce(importance.cast("double"), F.lit(1.0)) if importance is not None else F.lit(1.0)
    content = F.xxhash64(F.col(f"`{text_col}`").cast("string")) if text_col in docs.columns else F.lit(0).cast("long")
    drawn = F.when(key.isNull(), F.xxhash64(content, size, F.lit(seed))).otherwise(F.xxhash64(key, size, F.lit(seed)))
    number = (F.pmod(drawn, F.lit(1 << 52)) + 0.5) / float(1 << 52)
    own_key = F.xxhash64(key, size, content)
    narrow = _spark.saved(docs.select(own_key.alias("key"), number.alias("u"), src.alias("src"), size.alias("size"), weight.alias("imp")), "mix-rows")
    mean_imp = F.sum(F.col("size") * F.col("imp")) / F.sum("size") if importance is not None else F.lit(1.0)
    sums = narrow.groupBy("src").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"), mean_imp.alias("mean_imp"))
    sums = _spark.saved(sums, "mix-sources")
    n_sources, n_rows = sums.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    goals = source_targets(sums.select("src", "source_size"), weights, share, cap).select("src", "source_size", "target").withColumnRenamed("src", "s")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    goals = goals.join(sums.select("src", "mean_imp"), F.col("s").eqNullSafe(F.col("src"))).select("s", "source_size", "target", F.coalesce("mean_imp", F.lit(1.0)).alias("mean_imp"), ratio.alias("ratio"), F.floor(ratio).cast("long").alias("sure"))
    goals = goals.withColumn("gap", F.col("target") - F.col("source_size") * F.col("sure"))

    bits = max(4, (n_rows // CELL_ROWS).bit_length())
    place_type = "struct<cell:bigint,rank:double,key:bigint>"
    nowhere = F.lit(None).cast(place_type)
    # A pass takes the documents of at most ``most`` words behind ``since`` and up to ``upto`` (null: from the start, to the end).
    plan = goals.select("*", F.col("gap").alias("most"), nowhere.alias("since"), (F.col("gap") > 0).alias("open"), F.array().cast(f"array<struct<most:double,since:{place_type},upto:{place_type}>>").alias("passes"), F.array().cast(f"array<struct<place:{place_type},k:bigint,n:bigint>>").alias("parts"))
    plan = _spark.saved(plan, "mix-plan")

    def ranked(sources: DataFrame) -> DataFrame:
        rows = narrow.where("size > 0").join(_spark.small(sources, n_sources), F.col("src").eqNullSafe(F.col("s")))
        return rows.withColumn("place", _place(_rank(F.col("u"), F.col("imp"), F.col), F.col("key"), bits))

    while not plan.where("open").isEmpty():  # each pass but the first halves what is left: at most the bits of the largest target
        rows = ranked(plan.where("open").select("s", "gap", "most", "since", "ratio", "sure", "mean_imp"))
        rows = rows.where("size <= most and (since is null or place > since)").select("src", "size", "place", "gap")
        cuts = _cuts(rows, bits, n_sources)
        rest = rows.groupBy("src").agg(F.sum("size").alias("all_words")).select(F.col("src").alias("all_src"), "all_words")
        last = plan.where("open").join(rest, F.col("s").eqNullSafe(F.col("all_src")), "left").join(cuts, F.col("s").eqNullSafe(F.col("cut_src")), "left")
        gap = F.col("gap") - F.coalesce("got", "all_words", F.lit(0))
        made = F.struct("most", "since", "upto")
        last = last.withColumn("left", gap).select(*goals.drop("gap").columns, F.col("left").alias("gap"), (F.col("left") / 2).alias("most"), F.col("upto").alias("since"), (F.col("upto").isNotNull() & (F.col("left") > NEAR * F.col("target"))).alias("open"), F.concat("passes", F.array(made)).alias("passes"), F.when(F.col("part").isNull(), F.col("parts")).otherwise(F.concat("parts", F.array("part"))).alias("parts"))
        plan = _spark.saved(last.unionByName(plan.where("not open")), "mix-plan")
    near = F.abs(F.col("size") - F.col("gap"))
    behind = ranked(plan.where("gap > 0").select("s", "gap", "ratio", "sure", "mean_imp", "passes")).where(near < F.col("gap")).where(~_taken(F.col("size"), F.col("place"), F.col("passes")))
    pick = behind.groupBy("src").agg(F.min(F.struct(near.alias("off"), "place")).alias("m")).select(F.col("src").alias("pick_src"), F.col("m.place").alias("pick"))
    pick = _spark.saved(pick, "mix-pick")
    there = behind.join(_spark.small(pick, n_sources), F.col("src").eqNullSafe(F.col("pick_src")) & (F.col("place") == F.col("pick"))).groupBy("src").agg(F.first("place").alias("place"), F.count("*").alias("n"))
    one = there.select(F.col("src").alias("pick_src"), F.array(F.struct("place", F.lit(1).cast("long").alias("k"), "n")).alias("one"))
    plan = plan.join(one, F.col("s").eqNullSafe(F.col("pick_src")), "left")
    plan = _spark.saved(plan.select("s", "source_size", "target", "mean_imp", "ratio", "sure", "passes", F.when(F.col("one").isNull(), F.col("parts")).otherwise(F.concat("parts", "one")).alias("parts")), "mix-plan")

    spare = {n: _spark.free_name(docs, "mix_" + n) for n in ("s", "key", "size", "imp", "u")}
    rows = docs.select(*[F.col(f"`{c}`") for c in own], src.alias(spare["s"]), own_key.alias(spare["key"]), size.alias(spare["size"]), weight.alias(spare["imp"]), number.alias(spare["u"]))
    plan_row = plan.select(F.struct(*[c for c in plan.columns if c != "s"]).alias(p_name := _spark.free_name(docs, "mix_plan")), F.col("s").alias(s_name := _spark.free_name(docs, "mix_of")))
    p = lambda c: F.col(p_name)[c]
    words = F.col(spare["size"])
    here = _place(_rank(F.col(spare["u"]), F.col(spare["imp"]), p), F.col(spare["key"]), bits)
    mine = F.filter(p("parts"), lambda x: x["place"] == here)
    k, n = F.aggregate(mine, F.lit(0).cast("long"), lambda had, x: had + x["k"]), F.coalesce(F.array_max(F.transform(mine, lambda x: x["n"])), F.lit(0))
    taken = (words > 0) & (_taken(words, here, p("passes")) | ((k > 0) & (k >= n)))
    joined = rows.join(_spark.small(plan_row, n_sources), F.col(spare["s"]).eqNullSafe(F.col(s_name)))
    result = lambda more: [*[F.col(f"`{c}`") for c in own], words.alias("size"), p("source_size").alias("source_size"), p("target").alias("target"), (p("sure") + more.cast("long")).alias("copies")]
    some = plan.select("s", F.explode("parts").alias("x")).groupBy("s", "x.place").agg(F.sum("x.k").alias("k"), F.max("x.n").alias("n")).where("k < n")
    if some.isEmpty():
        return joined.select(*result(taken))
    split = (words > 0) & (k > 0) & (k < n)
    tied = joined.where(split).select(F.struct(*result(F.lit(False))).alias("row"), F.struct(s_name, here.alias("place")).alias("at"), k.alias("k"))
    return joined.where(~split).select(*result(taken)).unionAll(_some_of(tied))


def _some_of(tied: DataFrame) -> DataFrame:
    """Of ``tied(row, at, k)`` ``k`` rows of each place with a copy more: whole parts of the saved table in their order, and of one part the first ones."""
    tied = _spark.saved(tied.withColumn("part", F.spark_partition_id()), "mix-tied")
    counts = tied.groupBy("at", "part").agg(F.count("*").alias("c"), F.first("k").alias("wanted"))
    before = F.coalesce(F.sum("c").over(Window.partitionBy("at").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    quota = counts.select("at", "part", "c", F.greatest(F.least(F.col("wanted") - before, F.col("c")), F.lit(0)).alias("quota"))
    dealt = tied.join(_spark.small(_spark.saved(quota, "mix-quota")), ["at", "part"])
    cut = (F.col("quota") > 0) & (F.col("quota") < F.col("c"))
    nth = F.row_number().over(Window.partitionBy("at", "part").orderBy(F.lit(0)))  # rows of one part that are equal here
    chosen = dealt.where(~cut).withColumn("more", F.col("quota") > 0).unionByName(dealt.where(cut).withColumn("nth", nth).withColumn("more", F.col("nth") <= F.col("quota")).drop("nth"))
    fields = tied.schema["row"].dataType.names
    return chosen.select(*[(F.col("row.copies") + F.col("more").cast("long")).alias(c) if i == len(fields) - 1 else F.col("row")[c].alias(c) for i, c in enumerate(fields)])


def mixed_rows(docs: DataFrame, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as :func:`mix` takes it, with its columns, whatever their names."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    packed = docs.select(whole.alias("row"), F.col(f"`{source_col}`").alias("of"), F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("content"))
    taken = mix(packed, "of", "id", text_col="content", **options).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy")).select(*[F.col("row")[c].alias(c) for c in docs.columns])
