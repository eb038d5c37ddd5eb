"""Find licence notices in texts, with DataFrame functions only.

Texts are cut into overlapping windows of five-word shingles, one window size per class of
template length, so that a notice lies whole in some window and fills a good part of it. MinHash
bands of one value each bring a window together with the templates it may hold; with 32 bands a
window and a template that share a fifth of their shingles miss each other with probability
0.8^32, below 0.001. The shingles themselves are then compared: a match holds at least 0.8 of the
template's.

A band can only meet if the window's least shingle is one of a template's, so windows without
any template shingle are left out before they are hashed; no match is lost by that.
"""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from msgledger.llm.common import stage_table

SHINGLE = 5
CONTAINMENT = 0.8
BANDS = 32
MAX_SHINGLES = 200_000  # of all templates; they are a literal of the plan
# Usual short notices, by the name of their licence.
TEMPLATES: Mapping[str, str] = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "apache-2.0-notice": "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "bsd-redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted "
                          "provided that the following conditions are met",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "gpl-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                  "Public License as published by the Free Software Foundation",
    "mit": "Released under the MIT License",
    "mit-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                      "associated documentation files",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "unlicense": "This is free and unencumbered software released into the public domain",
}


def template_table(spark: SparkSession, templates: Mapping[str, str] = TEMPLATES) -> DataFrame:
    return spark.createDataFrame(sorted(templates.items()), "template string, text string")


def _words(text: Column) -> Column:
    """Runs of a-z and 0-9, lower case."""
    plain = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+", " "))
    return F.split(plain, " ")


def _held(value: Column, name: str) -> Column:
    """A value computed once per row: the optimizer does not copy it into later expressions."""
    return F.explode(F.array(value)).alias(name)


def _hashes(words: str) -> Column:
    """Hash of each shingle; none for fewer than five words."""
    parts = ", ".join(f"{words}[i + {k}]" for k in range(SHINGLE))
    return F.expr(f"transform(if(size({words}) < {SHINGLE}, array(), sequence(0, size({words}) - {SHINGLE})), i -> xxhash64({parts}))")


def _shingles(words: str, first: str, count: str) -> Column:
    """The distinct shingles from number ``first`` (0 is the first), as text."""
    return F.expr(
        f"array_distinct(transform(if({count} < 1, array(), sequence(1, {count})), "
        f"i -> array_join(slice({words}, {first} + i, {SHINGLE}), ' ')))")


def _minhashes(hashes: str) -> Column:
    return F.expr(f"transform(sequence(1, {BANDS}), j -> array_min(transform({hashes}, h -> xxhash64(h, j))))")


def prepared(templates: DataFrame) -> DataFrame:
    """template, span (a power of two, at least its number of shingles), shingles, hashes."""
    rows = templates.select("template", _held(_words(F.col("text")), "w")).where(F.size("w") >= SHINGLE)
    rows = rows.select("template", _held(_hashes("w"), "h"), _shingles("w", "0", f"size(w) - {SHINGLE - 1}").alias("shingles"))
    return rows.withColumn("span", F.expr("shiftleft(1, length(bin(greatest(size(h) - 1, 0))))")).withColumn(
        "span", F.when(F.size("h") == 1, 1).otherwise(F.col("span")))


def scan(docs: DataFrame, templates: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """doc_id, template, containment and first_word for every notice of ``templates`` (template,
    text) found in ``docs`` (doc_id, text).

    containment is the greatest share of the template's distinct shingles in one window;
    first_word is where the earliest such window begins, counted in words. Null, empty and short
    texts match nothing, and templates of fewer than five words or null are never found. Rows that
    share a doc_id are one document, a null doc_id too. Texts are whole; other columns are ignored;
    an empty table gives no rows.
    """
    known = stage_table(prepared(templates), "license-templates")
    shingles = [r[0] for r in known.select(F.explode("h")).distinct().limit(MAX_SHINGLES + 1).collect()]
    if len(shingles) > MAX_SHINGLES:
        raise ValueError(f"templates have more than {MAX_SHINGLES} shingles")
    spans = sorted(r[0] for r in known.select("span").distinct().collect())
    rows = docs.select("doc_id", _held(_words(F.col("text")), "w")).select("doc_id", "w", _held(_hashes("w"), "h"))
    at = F.filter(F.transform("h", lambda x, i: F.when(x.isin(shingles), i)), lambda i: i.isNotNull())
    rows = rows.where(F.exists("h", lambda x: x.isin(shingles))).select("doc_id", "w", "h", _held(at, "at"))
    rows = rows.select("doc_id", "w", "h", "at", F.explode(F.array(*[F.lit(s) for s in spans])).alias("span"))
    number = F.expr("array_distinct(flatten(transform(at, p -> array(int(p div span), int(greatest(p div span - 1, 0))))))")
    windows = rows.select("doc_id", "w", "h", "span", F.explode(number).alias("n"))
    windows = windows.select(
        "doc_id", "span", (F.col("n") * F.col("span")).alias("first"),
        _held(F.expr("slice(h, n * span + 1, 2 * span)"), "part"), F.expr(f"slice(w, n * span + 1, 2 * span + {SHINGLE - 1})").alias("w"))
    banded = windows.select("doc_id", "span", "first", "w", F.posexplode(_minhashes("part")).alias("band", "least"))
    # 32 rows per template, and the templates are bounded above.
    bands = F.broadcast(known.select("span", "template", "shingles", F.posexplode(_minhashes("h")).alias("band", "least")))
    met = banded.join(bands, ["span", "band", "least"])
    has = F.size(F.array_intersect(_shingles("w", "0", f"size(w) - {SHINGLE - 1}"), "shingles"))
    share = (has / F.size("shingles")).alias("share")
    checked = met.select("doc_id", "template", "first", share).where(F.col("share") >= containment)
    return checked.groupBy("doc_id", "template").agg(
        F.max("share").alias("containment"), F.min("first").cast("bigint").alias("first_word"))
