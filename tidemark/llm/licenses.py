"""License scan: MinHash bands over overlapping text windows, then exact containment.

Texts become 5-word shingle hashes. A template is cut into windows at every offset, a
document into windows that overlap by half; windows with the same value in a band
are candidates, and a candidate is confirmed when the passage around its windows
holds at least ``contained`` of the template's shingles, compared exactly.

Window sizes follow the templates, so that a passage always holds a whole window:
``LEVELS`` are (window, stride). A band is the smallest or the largest shingle hash of the
window, under the hash order or a permuted one: four bands of one row. A window inside an unchanged
passage equals a template window and collides for certain; with a share J of common
shingles the probability is about 1 - (1 - J)^4 for each window, and a passage usually holds several.

Everything is built-in SQL functions; templates are small (their size is checked
before they are broadcast), documents are read once and never shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHINGLE = 5
#: (window, stride) in shingles; a template uses the largest window its length allows: 3 strides - 1 <= length.
LEVELS = ((1, 1), (8, 4), (32, 16))
#: XOR mask of the second order: it turns the second bit, and the lower ones at random.
PERMUTATION = 0x4C957F2D8A1B63E5
#: Templates of more bytes than this are joined by shuffle instead of broadcast.
BROADCAST_BYTES = 4_000_000

# Wordings of public licence notices.
NOTICES = {
    "mit-line": "Released under the MIT License.",
    "mit-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions:"
    ),
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at"
    ),
    "gpl-3-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0-line": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "bsd-redistribution": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:"
    ),
    "mpl-2.0-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at"
    ),
}


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often and deep inside lambdas it is used."""
    return F.transform(F.array(value), use)[0]


def words(text: Column) -> Column:
    """Lower-case words of letters and digits; NULL counts as empty."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def shingles(text: Column) -> Column:
    """Hashes of all runs of SHINGLE words, in order; none for fewer words."""
    none = F.array().cast("array<bigint>")

    def of(tokens: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(tokens) - SHINGLE)
        # The same hash as that of a slice, which would be copied for every run.
        return F.when(F.size(tokens) < SHINGLE, none).otherwise(
            F.transform(starts, lambda i: F.xxhash64(*[F.get(tokens, i + k) for k in range(SHINGLE)])),
        )

    return bound(words(text), of)


def permuted(hashes: Column) -> Column:
    """The hashes in another order: XOR turns their two leading bits, so other shingles are smallest and largest."""
    return F.transform(hashes, lambda h: h.bitwiseXOR(F.lit(PERMUTATION)))


def bands(first: Column, second: Column) -> Column:
    """Values of a window's bands from its hashes and its permuted hashes: the smallest and the largest of either."""
    return F.array(F.array_min(first), F.array_max(first), F.array_min(second), F.array_max(second))


def level_of(length: Column) -> Column:
    chosen = F.lit(0)
    for k, (_, stride) in enumerate(LEVELS):
        chosen = F.when(length >= max(1, 3 * stride - 1), F.lit(k)).otherwise(chosen)
    return chosen


def _hashed(rows: DataFrame) -> DataFrame:
    """``rows`` with the shingle hashes of ``body``, ``h.first``, and the same permuted, ``h.second``."""
    both = bound(shingles(F.col("body")), lambda h: F.struct(h.alias("first"), permuted(h).alias("second")))
    return rows.withColumn("h", both).drop("body")


def _banded(rows: DataFrame, starts: Callable[[Column, int], Column]) -> DataFrame:
    """One row for each band of each window: (level, start, size, band, value) and the columns of ``rows``.

    ``starts`` of a length and a level are where its windows start. Only they become rows; the windows are cut out of ``h``
    by plain expressions, which Spark compiles, as it does not compile lambdas.
    """
    n = F.size("h.first")
    cuts = F.when(n > 0, F.array(*[starts(n, k) for k in range(len(LEVELS))]))
    found = rows.select("*", F.posexplode(cuts).alias("level", "starts")).select("*", F.explode("starts").alias("start")).drop("starts")
    found = found.withColumn("size", F.get(F.array(*[F.lit(size) for size, _ in LEVELS]), F.col("level")))
    found = found.withColumns({c: F.slice(f"h.{c}", "start", "size") for c in ("first", "second")})
    # Windows of one shingle are the shingle itself.
    values = F.when(F.col("level") == 0, F.col("first")).otherwise(bands(F.col("first"), F.col("second")))
    return found.select("*", F.posexplode(values).alias("band", "value")).drop("first", "second")


def template_bands(templates: DataFrame) -> DataFrame:
    """(level, band, value, template, parts): every window of every template, at all offsets of its level."""

    def starts(n: Column, k: int) -> Column:
        every = F.sequence(F.lit(1), F.greatest(F.lit(1), n - (LEVELS[k][0] - 1)))
        return F.when(level_of(n) == k, every).otherwise(F.array().cast("array<int>"))

    found = _banded(_hashed(templates.select("template", "body")), starts)
    return found.select("level", "band", "value", "template", F.array_distinct("h.first").alias("parts")).distinct()


def document_bands(documents: DataFrame) -> DataFrame:
    """(key, level, band, value, around): the bands of all windows of every document, which overlap by half, and the hashes
    of three windows about each. A broadcast join evaluates ``around`` for its matches only."""
    found = _banded(_hashed(documents.select("key", "body")), lambda n, k: F.sequence(F.lit(1), n, F.lit(LEVELS[k][1])))
    size, start = F.col("size"), F.col("start")
    passage = F.slice("h.first", F.greatest(F.lit(1), start - size), 3 * size)
    return found.select("key", "level", "band", "value", F.when(F.col("level") == 0, F.array("value")).otherwise(passage).alias("around"))


def scan(
    documents: DataFrame, templates: DataFrame, contained: float = 0.8, id_col: str = "doc_id", text_col: str = "text",
    template_col: str = "template", template_text: str = "text",
) -> DataFrame:
    """(id, template, shared, containment) for every document and template it contains to at least ``contained``.

    ``shared`` is the number of the template's distinct shingles found. NULL and empty
    texts and templates of fewer than five words match nothing; rows that repeat an
    id count as one document and give one row; empty tables give none. Other columns
    are not read.
    """
    made = template_bands(templates.select(F.col(template_col).alias("template"), F.col(template_text).alias("body")))
    size = templates.agg(F.sum(F.octet_length(template_text))).first()[0] or 0
    lookup = F.broadcast(made) if size <= BROADCAST_BYTES else made
    texts = documents.select(F.col(id_col).alias("key"), F.col(text_col).alias("body"))
    hits = document_bands(texts).join(lookup, ["level", "band", "value"])
    # Exact: the template's shingles that stand around the windows, each counted once.
    exact = hits.select("key", "template", F.size("parts").alias("size"), F.explode(F.array_intersect("around", "parts")).alias("shingle")).distinct()
    counted = exact.groupBy("key", "template", "size").agg(F.count(F.lit(1)).alias("shared"))
    share = F.col("shared") / F.col("size")
    return counted.where(share >= contained).select(F.col("key").alias(id_col), "template", "shared", share.alias("containment"))


def notices(documents: DataFrame) -> DataFrame:
    """The built-in templates (template, text)."""
    return documents.sparkSession.createDataFrame(list(NOTICES.items()), "template string, text string")


def licensed(documents: DataFrame, found: DataFrame, carry: Sequence[str] = ("doc_id",), id_col: str = "doc_id") -> DataFrame:
    """Every row of ``documents`` with the sorted names of its templates (none: empty)."""
    per_doc = found.groupBy(id_col).agg(F.sort_array(F.collect_set("template")).alias("templates"))
    rows = documents.select(*dict.fromkeys([*carry, id_col])).alias("d")
    joined = rows.join(per_doc.alias("p"), F.col(f"d.{id_col}").eqNullSafe(F.col(f"p.{id_col}")), "left")
    empty = F.array().cast("array<string>")
    return joined.select(*[F.col(f"d.{c}") for c in carry], F.coalesce("p.templates", empty).alias("templates"))
