"""Licence scans: TF-IDF cosine of passages to licence templates, then inheritance from the nearest directory.

All on the JVM. A file's passages are its lines and the file as a whole. Only
passages that can reach the bound are compared: of each template's terms, the
lightest are set aside as long as they alone cannot carry the bound, and a passage
must hold one of the others. A passage's products with the templates are made within
its row, as an expression over the array of its terms. Its length needs the document
frequencies of all its words, so the words of compared passages, but no texts, are
joined to a table of words counted over all files.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailloom.llm.shared import ready, stored

# Short notices and headers as their licences are commonly stated.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This program is free software; you can redistribute it under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License, CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright: CC0 1.0 Universal."),
    ("ISC", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
_SPLIT = "[^a-z0-9]+"
_FILE_NAME = r"(?i)(^|/)(licen[sc]e|copying|unlicense)([.-][^/]*)?$"


def _terms(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), _SPLIT), lambda t: t != "")


def _template_terms(text: str) -> Counter:
    lowered = "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower())
    return Counter(lowered.split())


def document_counts(files: DataFrame) -> DataFrame:
    """(term, df) of every word of all texts: the number of files that hold it."""
    return files.select(F.explode(F.array_distinct(_terms(F.col("text")))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))


def _idf(files: int, df: Column) -> Column:
    return F.lit(1.0) + F.log(F.lit(1.0 + files) / (F.lit(1.0) + df))


class Weights:
    """Inverse document frequencies of the templates' terms, and each template's terms scaled to length one."""

    def __init__(self, files: int, counts: dict[str, int], templates: tuple[tuple[str, str], ...]):
        self.terms = {t: 1 + math.log((1 + files) / (1 + counts.get(t, 0))) for _, text in templates for t in _template_terms(text)}
        self.templates: list[tuple[str, dict[str, float]]] = []
        for license_id, text in templates:
            raw = {t: n * self.terms[t] for t, n in _template_terms(text).items()}
            length = math.sqrt(sum(w * w for w in raw.values()))
            self.templates.append((license_id, {t: w / length for t, w in raw.items()}))

    def needed(self, bound: float) -> list[str]:
        """Terms of which a passage must hold one to reach the bound with any template."""
        out = set()
        for _, weights in self.templates:
            spare = 0.0
            for term, weight in sorted(weights.items(), key=lambda x: (x[1], x[0])):
                spare += weight * weight
                if math.sqrt(spare) >= bound - 1e-9:
                    out.add(term)
        return sorted(out)


def products(terms: Column, weights: Weights) -> Column:
    """The products of a passage, not yet scaled to length one, with each template."""
    idf = F.create_map(*[F.lit(x) for t, w in weights.terms.items() for x in (t, w)])
    known = F.transform(F.filter(terms, lambda t: F.try_element_at(idf, t).isNotNull()), lambda t: F.struct(t.alias("term"), F.try_element_at(idf, t).alias("idf")))

    def dot(parts: Column, own: dict[str, float]) -> Column:
        shares = F.create_map(*[F.lit(x) for t, w in own.items() for x in (t, w)])
        return F.aggregate(parts, F.lit(0.0), lambda total, t: total + t["idf"] * F.coalesce(F.try_element_at(shares, t["term"]), F.lit(0.0)))

    # A one-element array gives the known terms a name, so that they are computed once.
    return F.get(F.transform(F.array(known), lambda parts: F.array(*[dot(parts, own) for _, own in weights.templates])), F.lit(0))


def lengths(passages: DataFrame, counted: DataFrame, files: int) -> DataFrame:
    """(row, place, length) of passages given as ``row``, ``place``, ``terms``, from the counts of all words.

    Words of more than a hundredth of the files are sent to all tasks: at most a
    hundred times the words of a mean file. No other word has many rows.
    """
    held = passages.select("row", "place", F.explode("terms").alias("term")).groupBy("row", "place", "term").agg(F.count("*").alias("n"))
    held = stored(held, "licenses-words")
    hot = (F.col("df") > 1000) & (F.col("df") * 100 > files)
    common = F.broadcast(counted.where(hot))
    weighed = held.join(common, "term").unionByName(held.join(common.select("term"), "term", "left_anti").join(counted.where(~hot), "term").select("term", "row", "place", "n", "df"))
    weight = F.col("n") * _idf(files, F.col("df"))
    return weighed.groupBy("row", "place").agg(F.sqrt(F.sum(weight * weight)).alias("length"))


def scan(files: DataFrame, bound: float = 0.7, file_bound: float = 0.6, templates: tuple[tuple[str, str], ...] = TEMPLATES) -> DataFrame:
    """(doc_id, path, own_license, own_score, is_license_file, inherited_license, inherited_from, license) of every file.

    ``own_license`` is that of the file's best passage, if its cosine reaches
    ``bound``. A file is its directory's licence file if its name says so or its
    whole text reaches ``file_bound``; the best one speaks for the directory (ties:
    smaller path, then id). Other files inherit from their own or the nearest directory above,
    at whatever distance; ``license`` is the own one, else the inherited one. NULL
    and empty texts have no own licence, a NULL path inherits nothing. Repeated
    files are rows each. Other columns are ignored.
    """
    ready(files.sparkSession)
    known = files.select(F.col("doc_id").cast("long").alias("doc_id"), "path", F.coalesce("text", F.lit("")).alias("text"))
    vocabulary = sorted({t for _, text in templates for t in _template_terms(text)})
    counted = stored(document_counts(known), "licenses-counts")
    n = known.count()
    weights = Weights(n, {r["term"]: r["df"] for r in counted.where(F.col("term").isin(vocabulary)).collect()}, templates)
    needed = F.array(*[F.lit(t) for t in weights.needed(min(bound, file_bound))])

    def holds(text: Column) -> Column:
        return F.arrays_overlap(F.split(F.lower(text), _SPLIT), needed)

    def judged(terms: Column) -> Column:
        return F.struct(terms.alias("terms"), products(terms, weights).alias("dots"))

    # The whole text is the last passage.
    texts = F.array_append(F.filter(F.split("text", "\n"), holds), F.col("text"))
    passages = F.when(holds(F.col("text")), F.transform(F.transform(texts, _terms), judged))
    rows = stored(known.select(F.monotonically_increasing_id().alias("row"), "doc_id", "path", passages.alias("passages")), "licenses-passages")
    each = rows.where("passages is not null").select("row", (F.size("passages") - 1).alias("last"), F.posexplode("passages").alias("place", "passage"))
    each = each.select("row", "place", (F.col("place") == F.col("last")).alias("is_whole"), "passage.terms", "passage.dots")
    ids = F.array(*[F.lit(license_id) for license_id, _ in weights.templates])
    scores = F.array_max(F.transform("dots", lambda dot, number: F.struct(
        F.round(dot / F.col("length"), 6).alias("score"), (-number).alias("order"), F.get(ids, number).alias("license"))))
    scored = each.drop("terms").join(lengths(each, counted, n), ["row", "place"]).select("row", "is_whole", scores.alias("found"))
    scored = scored.groupBy("row").agg(
        F.max(F.when(F.col("found.score") >= bound, F.col("found"))).alias("best"),
        F.max(F.when(F.col("is_whole") & (F.col("found.score") >= file_bound), F.col("found"))).alias("whole"))
    rows = rows.select("row", "doc_id", "path").join(scored, "row", "left")
    own = stored(rows.select(
        "doc_id", "path", F.coalesce("best.license", "whole.license").alias("own_license"), F.coalesce("best.score", "whole.score").alias("own_score"),
        (F.col("whole").isNotNull() | F.coalesce(F.col("path").rlike(_FILE_NAME), F.lit(False))).alias("is_license_file"),
        _directory(F.col("path")).alias("directory")), "licenses")
    speakers = own.where("is_license_file and own_license is not null and path is not null").select(
        F.col("directory").alias("above"), F.struct((-F.col("own_score")).alias("s"), "path", "doc_id", F.col("own_license").alias("license")).alias("speaker"))
    speakers = speakers.groupBy("above").agg(F.min("speaker").alias("speaker")).select("above", F.col("speaker.license").alias("given"), F.col("speaker.path").alias("giver"))
    directories = own.where("path is not null").select("directory").distinct()
    above = directories.select("directory", F.explode(_ancestors(F.col("directory"))).alias("above"))
    near = above.join(speakers, "above").groupBy("directory").agg(F.max(F.struct(F.length("above").alias("depth"), "given", "giver")).alias("near"))
    near = near.select("directory", F.col("near.given").alias("inherited_license"), F.col("near.giver").alias("inherited_from"))
    return own.join(near, "directory", "left").select(
        "doc_id", "path", "own_license", "own_score", "is_license_file",
        "inherited_license", "inherited_from", F.coalesce("own_license", "inherited_license").alias("license"))


def _directory(path: Column) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")


def _ancestors(directory: Column) -> Column:
    """A directory and all above it, down to the root, which is empty."""
    parts = F.split(directory, "/")
    return F.array_distinct(F.array_append(F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/")), F.lit("")))
