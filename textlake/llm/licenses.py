"""Licence notices in texts: MinHash bands over overlapping windows, then exact containment.

A text is cut into overlapping windows for every size class of templates: templates of
more than ``size / 2`` and up to ``size`` shingles meet windows of ``2 * size`` shingles, one beginning every
``size``, so a notice that stands in one piece lies whole in some window. Each band is the least
value of one hash function over a window's shingles. Window and template of the same class
that agree in a band are a candidate; the number of bands follows from the
smallest similarity a true pair can have (``bands_for``). Candidates are then verified
by the exact share of the template's shingles that the text holds.

A window can agree in a band only if it holds the very shingle that is least in the template, so
windows (and texts) without any such shingle are left out before the bands are worked out.
That changes no result. Everything is Spark columns; no Python runs on the rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlake.llm.storage import Scratch

SHINGLE = 5
THRESHOLD = 0.8
# Probability that a true pair agrees in no band.
MISS = 1e-6
# Templates that are sent to all tasks at a time.
BLOCK = 500

# Notices as their licences word them.
NOTICES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("mit", "Released under the MIT License."),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        'and associated documentation files (the "Software"), to deal in the Software without '
        "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so",
    ),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the "
        "GNU General Public License as published by the Free Software Foundation",
    ),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    (
        "cc-by-4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    (
        "cc-by-sa-4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met",
    ),
    (
        "mpl-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
]


def default_templates(spark: SparkSession) -> DataFrame:
    rows = [(i, name, text) for i, (name, text) in enumerate(NOTICES)]
    return spark.createDataFrame(rows, "template_id bigint, license string, text string")


def with_shingles(rows: DataFrame, text: str) -> DataFrame:
    """Rows with ``shingles``: hashes of the runs of five words, in order; none below five words.

    One expression: the word hashes are bound by a lambda, so that they are made once for a
    text wherever the optimizer moves it.
    """
    later = ", ".join(f"hashes[i + {j}]" for j in range(1, SHINGLE))
    words = (
        f"array_remove(split(lower(coalesce({text}, '')), '[^\\\\p{{L}}\\\\p{{N}}]+', -1), '')"
    )
    return rows.withColumn(
        "shingles",
        F.expr(
            f"transform(array(transform({words}, word -> xxhash64(word))), hashes -> "
            f"CASE WHEN size(hashes) >= {SHINGLE} "
            f"THEN transform(slice(hashes, 1, size(hashes) - {SHINGLE - 1}), (x, i) -> xxhash64(x, {later})) "
            "ELSE array() END)[0]"
        ),
    )


def bands_for(threshold: float = THRESHOLD, miss: float = MISS) -> int:
    """Bands after which a true pair has gone unseen with probability ``miss`` at most.

    The worst pair: a template just over half its class size, ``threshold`` of it in a window
    of four times as many shingles.
    """
    similarity = threshold / (4 + 1 - threshold)
    return math.ceil(math.log(miss) / math.log(1 - similarity))


def _least(shingles: str, band: str) -> str:
    return f"array_min(transform({shingles}, x -> xxhash64(x, {band})))"


def _template_bands(templates: DataFrame, bands: int) -> tuple[DataFrame, list[int], list[int]]:
    """Band values of one block of templates, their size classes and their least shingles."""
    made = with_shingles(templates, "text").withColumn("own", F.array_distinct("shingles"))
    made = made.where(F.size("own") > 0).select(
        "template_id",
        "license",
        "own",
        F.pow(F.lit(2), F.ceil(F.log2(F.size("own").cast("double")))).cast("int").alias("class"),
        F.explode(F.sequence(F.lit(0), F.lit(bands - 1))).alias("band"),
    )
    made = made.withColumn("value", F.expr(_least("own", "band"))).withColumn(
        "shingle", F.expr("filter(own, x -> xxhash64(x, band) = value)[0]")
    )
    rows = made.select("class", "shingle").distinct().collect()
    return made, sorted({r["class"] for r in rows}), sorted({r["shingle"] for r in rows})


def scan_licenses(documents: DataFrame, templates: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row for each document and template found in it.

    Columns: ``doc_id, template_id, license, n_template`` (distinct shingles of the template),
    ``n_shared`` (of them in the text) and ``containment``, which is at least ``threshold``.
    Null, empty and short texts (below five words) hold none, and such templates are
    nowhere found. Equal rows give equal rows back; further columns are not looked at.
    The templates are the stated queries: they are taken in blocks of ``BLOCK``.
    """
    spark = documents.sparkSession
    scratch = Scratch(spark, "licenses")
    ids = [r[0] for r in templates.select("template_id").distinct().orderBy("template_id").collect()]
    found = None
    for low in range(0, len(ids), BLOCK):
        block = templates.where(F.col("template_id").isin(ids[low : low + BLOCK]))
        part = _scan_block(documents, block, threshold, scratch)
        if part is not None:
            found = part if found is None else found.unionByName(part)
    if found is None:
        empty = (
            "doc_id bigint, template_id bigint, license string, n_template bigint, n_shared bigint, "
            "containment double"
        )
        found = spark.createDataFrame([], empty)
    return found


def _scan_block(
    documents: DataFrame, templates: DataFrame, threshold: float, scratch: Scratch
) -> DataFrame | None:
    bands = bands_for(threshold)
    made, classes, least = _template_bands(templates, bands)
    if not least:
        return None
    needed = F.expr(f"array({', '.join(f'{x}L' if x > -(1 << 63) else 'bigint(-9223372036854775808)' for x in least)})")
    texts = with_shingles(documents.select("doc_id", "text"), "text")
    texts = texts.where(F.arrays_overlap("shingles", needed)).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "shingles"
    )
    texts = scratch.keep(texts, "candidates")

    starts = F.array(
        *[
            F.expr(f"transform(sequence(0, size(shingles) - 1, {c}), at -> struct({c} AS class, at AS at))")
            for c in classes
        ]
    )
    windows = texts.select("row", "shingles", F.explode(F.flatten(starts)).alias("w")).select(
        "row",
        F.col("w.class").alias("class"),
        F.expr("slice(shingles, w.at + 1, 2 * w.class)").alias("window"),
    )
    windows = windows.where(F.arrays_overlap("window", needed))
    values = windows.select(
        "row",
        "class",
        F.posexplode(
            F.expr(f"transform(sequence(0, {bands - 1}), band -> {_least('window', 'band')})")
        ).alias("band", "value"),
    )
    met = values.join(
        F.broadcast(made.select("class", "band", "value", "template_id")), ["class", "band", "value"]
    )
    pairs = met.select("row", "template_id").distinct()
    notices = made.where("band = 0").select("template_id", "license", "own")
    checked = (
        pairs.join(F.broadcast(notices), "template_id")
        .join(texts, "row")
        .select(
            "doc_id",
            "template_id",
            "license",
            F.size("own").cast("bigint").alias("n_template"),
            F.size(F.array_intersect("own", "shingles")).cast("bigint").alias("n_shared"),
        )
    )
    checked = checked.withColumn("containment", F.col("n_shared") / F.col("n_template"))
    return checked.where(F.col("n_shared") >= threshold * F.col("n_template") - 1e-9)
