"""Links within lists of candidates, without all pairs of a list where most of its members are connected.

In each list every member is first compared with one pivot, and components are formed. Members of one
component need no further comparison. Lists that still span several components get further pivots
while their open pairs are many and pivots still bring links; then every open pair is compared, long lists in blocks of members over
many tasks. So components are exact: a pair of a list is left out only if its members are already
connected or ``may`` rules it out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortwatch.llm import _spark

#: Open pairs, in all or for each list entry, up to which all of them are compared; until then pivots go on.
ALL_PAIRS, OPEN_PAIRS, PIVOT_ROUNDS = 5_000_000, 20, 3
#: Members of a list that one block sets against the others.
BLOCK = 1000


def linked_components(lists: DataFrame, may: Callable[[str, str], Column], compare: Callable[[DataFrame], DataFrame], prefer: Column, split: Callable[[DataFrame], DataFrame] | None = None, once: Callable[[str, str], Column] | None = None) -> DataFrame | None:
    """``(id, component)`` of all ids with a link, or None if there is no list.

    ``lists`` is a saved table of distinct ``(token, id, at)``; ``may(x, y)`` says of two columns like ``at`` whether
    their ids may be linked, as far as this list tells; ``compare(pairs(a, b))`` gives ``(a, b, linked)``
    for at least those that are linked; ``prefer`` ranks pivots, smallest first. ``split`` turns the entries of long
    lists ``(token, id, at, label)`` into shorter lists that hold every pair that may be linked; ``once`` says whether a pair
    of several lists is to be made in this one (without ``split`` only).
    """
    entries = lists.count()
    if not entries:
        return None
    one_each = lambda found: found.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    pivot = lists.groupBy("token").agg(F.min(F.struct(prefer.alias("rank"), "id", "at")).alias("p"), F.count("*").alias("n")).where("n > 1")
    pivot = _spark.saved(pivot.select("token", F.col("p.id").alias("y"), F.col("p.at").alias("y_at"), "n"), "list-pivots")
    members = lists.select("token", F.col("id").alias("x"), F.col("at").alias("x_at"))
    found = _spark.looked_up(members, pivot, "token", entries).where((F.col("x") != F.col("y")) & may("x_at", "y_at"))
    pairs = _spark.saved(one_each(found), "list-pairs")
    checked = _spark.saved(compare(pairs), "list-checked")
    spark, labelled, mixed, label = lists.sparkSession, pivot, pairs, None
    links = checked.where("linked").select("a", "b")
    for turn in range(PIVOT_ROUNDS + 1):
        gained = label is None or not links.isEmpty()
        if gained:
            label = _spark.saved(_joined(label, links), "list-labels")
        _spark.drop_scratch(spark, labelled, mixed)
        labelled = _spark.saved(lists.join(label, "id", "left").select("token", "id", "at", F.coalesce("component", "id").alias("label")), "list-labelled")
        classes = labelled.groupBy("token", "label").agg(F.count("*").alias("size"), F.min(F.struct(F.xxhash64("id", F.lit(turn)).alias("h"), "id", "at")).alias("p"))
        mixed = classes.groupBy("token").agg(F.count("*").alias("k"), F.sum("size").alias("n"), F.max(F.struct("size", "label", "p")).alias("top")).where("k > 1")
        mixed = _spark.saved(mixed.select("token", "n", F.col("top.size").alias("top_n"), F.col("top.label").alias("top"), F.col("top.p.id").alias("y"), F.col("top.p.at").alias("y_at")), "list-mixed")
        still_open = mixed.agg(F.sum(F.expr("n * (n - top_n)"))).first()[0] or 0
        if not still_open:
            return label
        last = still_open <= max(ALL_PAIRS, OPEN_PAIRS * entries) or turn == PIVOT_ROUNDS or not gained
        if not last:
            minor = _spark.looked_up(labelled, mixed, "token", entries).where("label <> top").select(F.col("id").alias("x"), F.col("at").alias("x_at"), "y", "y_at")
            found = minor.where(may("x_at", "y_at"))
        else:
            whole = labelled
            if split is not None and still_open > max(ALL_PAIRS, OPEN_PAIRS * entries):
                whole = _spark.saved(split(_spark.looked_up(labelled, mixed.select("token", "n"), "token", entries).select("token", "id", "at", "label")), "list-split")
                classes = whole.groupBy("token", "label").agg(F.count("*").alias("size"))
                mixed = classes.groupBy("token").agg(F.count("*").alias("k"), F.sum("size").alias("n"), F.max(F.struct("size", "label")).alias("top")).where("k > 1").select("token", "n", F.col("top.label").alias("top"))
                mixed = _spark.saved(mixed, "list-mixed")
                entries = max(entries, whole.count())
            found = _open_pairs(_spark.looked_up(whole, mixed.select("token", "n", "top"), "token", entries), may if once is None else lambda x, y: may(x, y) & once(x, y))
        fresh = _spark.saved(one_each(found).join(checked.select("a", "b"), ["a", "b"], "left_anti"), "list-pairs")
        compared = _spark.saved(compare(fresh), "list-checked")
        checked, links = checked.unionByName(compared), compared.where("linked").select("a", "b")
        if last:
            _spark.drop_scratch(spark, labelled, mixed)
            return label if links.isEmpty() else _joined(label, links)
    raise AssertionError


def _joined(label: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components of the links and of what is connected already; its edges lead to the least id, so few rounds are left."""
    return _spark.components(links if label is None else links.unionAll(label.select("id", "component")))


def _open_pairs(labelled: DataFrame, may: Callable[[str, str], Column]) -> DataFrame:
    """Pairs ``(x, y)`` of different labels in one list that ``may`` allows; ``top`` is the list's largest label and ``n`` its length."""
    labelled = _spark.saved(labelled.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")), "list-open")
    minor = labelled.where("label <> top").select("token", "top", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"), F.col("id").alias("x"), F.col("at").alias("x_at"), "label")
    whole = labelled.select("token", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.col("id").alias("y"), F.col("at").alias("y_at"), F.col("label").alias("other"))
    differ = (F.col("label") != F.col("other")) & ((F.col("other") == F.col("top")) | (F.col("x") < F.col("y")))
    return minor.join(whole, ["token", "block"]).where(differ & may("x_at", "y_at")).select("x", "y")
