"""License scans by diagonal voting.

Every rolling ``k``-word gram of a document is joined by its hash with the places where templates hold
it. A hit of document place i and template place p votes for the diagonal i - p: a template that stands
in a document fills one diagonal, and a few neighbouring ones where words were put in or left out.
Votes are added up by document, template and diagonal, kept as bits of the template's places, so that
each place counts once. Diagonals of a template that are at most ``drift`` apart are merged, and the
span is verified: a phrase must fill its one diagonal, which makes its words stand there consecutively; a
notice must have ``share`` percent of its grams in a span of at most twice its words.

Words are of letters, digits and characters beyond ASCII, A-Z lower-cased, and grams are told apart by
64-bit hashes. Rows of a part of the input with equal ids and texts are scanned as one and given back as
many. Null and empty texts have no words and no labels; an empty table gives no rows; other columns are
ignored, whatever their names. A document of which no gram is a template's still gets its row, by a mark
that stands before its grams.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortwatch.llm import _spark, _text

K = 3
#: Words by which neighbouring diagonals may differ, and percent of a notice's grams that must be there.
DRIFT, SHARE = 4, 80
#: Grams of a row; longer texts have several.
BLOCK = 1 << 16
#: The mark before a document's grams, and the number of the template that it belongs to.
_MARK, _NO_TEMPLATE = np.uint64(0x9E3779B97F4A7C15), -1


class Template(NamedTuple):
    """A label, the text that stands for it, and whether all its words must be there."""

    label: str
    text: str
    exact: bool = False


#: Phrases that must stand word by word.
PHRASES = [
    Template("mit", "under the mit license", True),
    Template("apache-2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", True),
]

#: The notices by which authors declare common licenses.
NOTICES = [
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    Template("apache-2", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    Template("gpl", "redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    Template("gpl-3", "licensed under the GNU General Public License, version 3"),
    Template("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    Template("cc-by-nc", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    Template("cc-by-sa", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    Template("unlicense", "This is free and unencumbered software released into the public domain"),
]


def _grams(texts: pa.Array, k: int):
    """Chunk by chunk: the first text's number, grams, each text's first gram (and the end), and the texts' numbers of words."""
    for chunk in _text.chunks(texts):
        starts, ends, first = chunk.spans(_text.ALNUM)
        grams, at = _text.ngrams(chunk.hashes(starts, ends, _text.LOWER), first, k)
        yield chunk.first, np.where(grams == _MARK, grams ^ np.uint64(1), grams), np.searchsorted(at, first), np.diff(first)


def template_places(templates: list[Template], k: int) -> list[tuple]:
    """Rows (gram, template, place, grams, words, label, exact), and one for the mark."""
    rows = [(int(_MARK.view(np.int64)), _NO_TEMPLATE, 0, 1, 0, None, False)]
    for first, grams, index, words in _grams(pa.array([t.text for t in templates], pa.string()), k):
        for j in range(len(words)):
            t, own = templates[first + j], grams[index[j] : index[j + 1]].view(np.int64)
            if not len(own):
                raise ValueError(f"a template needs {k} words: {t.text!r}")
            rows += [(int(g), first + j, p, len(own), int(words[j]), t.label, t.exact) for p, g in enumerate(own)]
    return rows


def _rolled(k: int):
    """Rows (part, doc_id, d1, d2, n_words, base, grams): the grams of a text from place ``base`` on; the mark stands at place -1."""

    def run(batches):
        for batch in batches:
            for at, grams, index, words in _grams(batch.column("text"), k):
                grams = np.insert(grams, index[:-1], _MARK)
                index = index + np.arange(len(index))
                size = np.diff(index)
                pieces = -(-size // BLOCK)
                doc = np.repeat(np.arange(len(size)), pieces)
                base = (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * BLOCK
                offsets = np.append(index[doc] + base, index[-1]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(grams.view(np.int64)))
                keys = [batch.column(c).take(pa.array(at + doc)) for c in ("part", "doc_id", "d1", "d2")]
                yield pa.RecordBatch.from_arrays([*keys, pa.array(words[doc].astype(np.int64)), pa.array(base - 1), lists], ["part", "doc_id", "d1", "d2", "n_words", "base", "grams"])

    return run


_KEY = ["part", "doc_id", "d1", "d2", "n_words"]


def _spans(docs: DataFrame, templates: list[Template], id_col: str, text_col: str, k: int, drift: int) -> DataFrame:
    """Merged diagonals: ``_KEY``, ``template``, ``covered`` grams, ``first`` and ``last`` gram, ``copies``, and the template's ``grams``, ``words``, ``label``, ``exact``."""
    spark = docs.sparkSession
    rows = template_places(templates, k)
    table = spark.createDataFrame(rows, "gram long, template int, place int, grams int, words int, label string, exact boolean")
    places, about = table.select("gram", "template", "place"), table.select("template", "grams", "words", "label", "exact").distinct()
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    keyed = docs.select(F.spark_partition_id().alias("part"), F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"))
    keyed = keyed.select("part", "doc_id", F.xxhash64("text").alias("d1"), F.xxhash64(F.lit(1), "text").alias("d2"), "text")
    rolled = keyed.mapInArrow(_rolled(k), "part int, doc_id long, d1 long, d2 long, n_words long, base long, grams array<long>")
    hits = rolled.select(*_KEY, "base", F.posexplode("grams").alias("at", "gram")).join(_spark.small(places, len(rows)), "gram")
    at = F.col("base") + F.col("at")
    votes = hits.groupBy(*_KEY, "template", (at - F.col("place")).alias("diagonal"), F.floor(F.col("place") / 64).alias("segment"))
    votes = votes.agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("place") % 64)).alias("bits"), F.min(at).alias("first"), F.max(at).alias("last"), F.count("*").alias("n"))
    # One exchange by document; all that follows is within a document.
    order = Window.partitionBy(*_KEY).orderBy("template", "diagonal")
    within = F.when(F.col("exact"), 0).otherwise(drift)
    new = (F.lag("template").over(order) == F.col("template")) & (F.col("diagonal") - F.lag("diagonal").over(order) <= within)
    votes = votes.join(_spark.small(about, len(templates) + 1), "template").withColumn("new", F.when(new, 0).otherwise(1)).withColumn("span", F.sum("new").over(order))
    facts = ["template", "grams", "words", "label", "exact"]
    spans = votes.groupBy(*_KEY, "span", *facts, "segment").agg(F.bit_or("bits").alias("bits"), F.min("first").alias("first"), F.max("last").alias("last"), F.max("n").alias("copies"))
    return spans.groupBy(*_KEY, "span", *facts).agg(F.sum(F.bit_count("bits")).alias("covered"), F.min("first").alias("first"), F.max("last").alias("last"), F.max("copies").alias("copies"))


def _verified(k: int, share: int):
    whole = F.col("covered") == F.col("grams")
    near = (100 * F.col("covered") >= share * F.col("grams")) & (F.col("last") - F.col("first") + k <= 2 * F.col("words"))
    return (F.col("template") != _NO_TEMPLATE) & F.when(F.col("exact"), whole).otherwise(near)


def matches(docs: DataFrame, templates: list[Template] = [*PHRASES, *NOTICES], id_col: str = "doc_id", text_col: str = "text", k: int = K, share: int = SHARE, drift: int = DRIFT) -> DataFrame:  # noqa: B006
    """The verified spans, one a row: ``doc_id``, ``label``, ``exact``, ``first_word``, ``last_word`` (from 0), ``score``, the part of the template's grams that is there.

    Rows of one part with equal ids and texts give their spans once.
    """
    found = _spans(docs, templates, id_col, text_col, k, drift).where(_verified(k, share))
    return found.select("doc_id", "label", "exact", F.col("first").alias("first_word"), (F.col("last") + k - 1).alias("last_word"), (F.col("covered") / F.col("grams")).alias("score"))


def scan(docs: DataFrame, templates: list[Template] = [*PHRASES, *NOTICES], id_col: str = "doc_id", text_col: str = "text", k: int = K, share: int = SHARE, drift: int = DRIFT) -> DataFrame:  # noqa: B006
    """One row for each document: ``doc_id``, ``n_words``, ``n_base`` (places of phrases), ``first_word`` and ``last_word`` (their least and greatest start), ``base_labels`` (phrases), ``labels`` (notices too), ``score`` (the best span's, 0 without one)."""
    verified = _verified(k, share)
    base = verified & F.col("exact")
    names = lambda which: F.array_join(F.array_sort(F.collect_set(F.when(which, F.col("label")))), ",")
    found = _spans(docs, templates, id_col, text_col, k, drift).groupBy(*_KEY).agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("first"))).alias("first_word"),
        F.max(F.when(base, F.col("first"))).alias("last_word"),
        names(base).alias("base_labels"),
        names(verified).alias("labels"),
        F.coalesce(F.max(F.when(verified, F.col("covered") / F.col("grams"))), F.lit(0.0)).alias("score"),
        F.max(F.when(F.col("template") == _NO_TEMPLATE, F.col("copies"))).alias("copies"),
    )
    again = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return found.withColumn("copy", again).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
