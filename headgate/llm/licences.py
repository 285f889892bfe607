"""Licence scan: TF-IDF cosine of texts and their parts to licence templates, inherited along directories.

Templates are one-sentence statements, standard headers and full licence texts. Compared with them
are a file's units, its lines and sentences, the windows of as many words as a template has that
begin with a unit, and the whole file. All are sparse vectors of term counts times inverse document
frequency in the scanned corpus. A unit can only come near a statement if it has one of the
statement's weightiest terms: without them the rest of it is too short for the threshold. Likewise
a file has windows for a template only if the template's terms that it has are long enough
together. So most units and files are told apart without their counts, and only the others are
joined, term by term, with the postings of the templates.

A file that as a whole or in nearly all its units is licence text, or is named as one, is a licence file and speaks for its directory. A file
without a licence of its own takes that of the nearest directory above it that has one: the
directories, each once, meet their ancestors in a join of paths.
"""

from __future__ import annotations

import math
import re
import string
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headgate.llm.tables import kept, words

#: Cosine from which a unit states the licence, and part of the units that makes a licence file.
THRESHOLD = 0.8
LICENCE_FILE = 0.9
#: Fixed value: names of licence files, whatever else they hold.
LICENCE_NAME = r"(?i)(?:^|/)(?:licen[cs]e|copying|unlicense)[^/]*$"
UNITS = r"[\r\n]+|(?<=[.!?])[ \t]+"
#: Parts of a template's length by which the windows of a file move on, where its units are shorter.
STEPS = 32
#: A character that stands between units once the text's own are taken out.
MARK = "\uE000"
#: Statements by which licences are given, several for one licence.
STATEMENTS = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("proprietary", "All rights reserved."),
)
#: Full texts and standard headers: files `<licence>.txt` and `<licence>.header.txt`, without copyright lines.
TEXTS = tuple((p.name.removesuffix(".txt").removesuffix(".header"), p.read_text()) for p in sorted((Path(__file__).parent / "licence_texts").glob("*.txt")))
TEMPLATES = STATEMENTS + TEXTS


def terms(text: str) -> list[str]:
    """The words of a template, as `words` cuts them."""
    return re.findall(r"[0-9a-z\x80-\U0010FFFF]+", text.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase)))


def is_text(template: str) -> bool:
    """Whether a template is a text of several units, not a statement."""
    return len(re.split(UNITS, template.strip())) > 2


class Vectors:
    """Inverse document frequencies of the template terms, and the unit vectors of the templates.

    `needed` are terms of which every unit near a statement has one, `rare` those of which every
    file with anything near a template has one.
    """

    def __init__(self, templates: tuple[tuple[str, str], ...], frequency: dict[str, int], documents: int, threshold: float):
        self.documents = documents
        self.idf = {t: math.log((2 + documents) / (1 + frequency.get(t, 0))) for _, text in templates for t in terms(text)}
        self.postings: list[tuple[str, int, float]] = []
        self.needed: set[str] = set()
        self.rare: set[str] = set()
        for k, (_, text) in enumerate(templates):
            bag = terms(text)
            weight = {t: bag.count(t) * self.idf[t] for t in set(bag)}
            norm = math.sqrt(sum(w * w for w in weight.values())) or 1.0
            self.postings += [(t, k, w / norm) for t, w in sorted(weight.items())]
            if not is_text(text):
                self.needed |= self._cover(sorted(weight.items(), key=lambda x: (-x[1], x[0])), norm, threshold)
            self.rare |= self._cover(sorted(weight.items(), key=lambda x: (-self.idf[x[0]], -x[1], x[0])), norm, threshold)

    @staticmethod
    def _cover(weight: list[tuple[str, float]], norm: float, threshold: float) -> set[str]:
        """The first terms, up to where what is left of the template cannot reach the threshold alone."""
        found, rest = set(), 1.0
        for t, w in weight:
            if rest < threshold * threshold:
                break
            found.add(t)
            rest -= (w / norm) ** 2
        return found


def frequencies(files: DataFrame) -> DataFrame:
    """`term, files`: in how many of all files each term is, counted in one reading of the texts."""
    every = files.select(F.explode(F.array_distinct(words(F.col("text")))).alias("term"))
    return kept(every.groupBy("term").agg(F.count(F.lit(1)).alias("files")), "op6-frequencies")


def weigh(counted: DataFrame, documents: int, templates: tuple[tuple[str, str], ...], threshold: float) -> Vectors:
    """The templates' vectors; only the frequencies of their own terms reach the driver."""
    known = sorted({t for _, text in templates for t in terms(text)})
    mine = counted.where(F.col("term").isin(known)).collect()
    return Vectors(templates, {r["term"]: r["files"] for r in mine}, documents, threshold)


def _windows(files: DataFrame, sizes: DataFrame, vectors: Vectors, postings: DataFrame, threshold: float) -> DataFrame:
    """`row, template, start, whole, value`: the words of windows and whole files that may come near a template.

    A window has the template's number of words and begins with a unit; where units are shorter than
    a part in `STEPS` of that, with the first of each part. `start` is -1 for the whole file.
    """
    some = F.array(*map(F.lit, sorted(vectors.rare)))
    known = F.array(*map(F.lit, sorted(vectors.idf)))
    maybe = files.where(F.arrays_overlap(words(F.col("text")), some))
    present = maybe.select("row", F.explode(F.array_intersect(words(F.col("text")), known)).alias("term")).join(F.broadcast(postings), "term")
    # Without the terms that the file has not, a template is so long: the most that any part of the file can reach.
    pairs = present.groupBy("row", "template").agg(F.sum(F.col("weight") * F.col("weight")).alias("most")).where(F.col("most") >= threshold * threshold * (1 - 1e-9))
    pairs = kept(pairs.select("row", "template").join(F.broadcast(sizes), "template"), "op6-pairs")
    marked = words(F.regexp_replace(F.translate("text", MARK, " "), UNITS, f" {MARK} "))
    cut = files.join(pairs, "row").select("row", "template", "size", marked.alias("m"))
    at = F.filter(F.transform("m", lambda x, i: F.when(x == MARK, i)), lambda i: i.isNotNull())
    begins = F.array_distinct(F.concat(F.array(F.lit(0)), F.transform(at, lambda i, p: i - p)))
    cut = cut.select("row", "template", "size", F.array_remove("m", MARK).alias("ws"), begins.alias("b"))
    part = F.greatest(F.lit(1), F.floor(F.col("size") / STEPS)).cast("int")
    fresh = F.filter("b", lambda x, i: (i == 0) | (F.floor(x / part) != F.floor(F.get("b", i - 1) / part)))
    cut = cut.select("row", "template", "size", "ws", F.explode(F.concat(F.array(F.lit(-1)), fresh)).alias("start"))
    value = F.when(F.col("start") < 0, F.col("ws")).otherwise(F.slice("ws", F.greatest(F.col("start"), F.lit(0)) + 1, F.col("size")))
    return cut.select("row", "template", "start", value.alias("value"))


def matches(files: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """`row, unit, start, template, cosine`: parts of `files` (`row`, `text`) and the nearest template from the threshold on.

    A unit has its number; a window has the number of words before it as `start`, a whole file -1.
    """
    spark, counted = files.sparkSession, frequencies(files)
    vectors = weigh(counted, files.count(), templates, threshold)
    idf = counted.select("term", F.log(F.lit(2.0 + vectors.documents) / (1 + F.col("files"))).alias("idf"))
    postings = spark.createDataFrame(vectors.postings, "term string, template int, weight double")
    sizes = spark.createDataFrame([(k, len(terms(text))) for k, (_, text) in enumerate(templates)], "template int, size int")
    some = "(?i)(?<![0-9a-z])(?:" + "|".join(sorted(vectors.needed)) + ")(?![0-9a-z])"
    units = files.select("row", F.posexplode(F.split("text", UNITS)).alias("unit", "value")).where(F.col("value").rlike(some))
    units = units.select("row", "unit", F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("of"), words(F.col("value")).alias("value"))
    windows = _windows(files, sizes, vectors, postings, threshold).select("row", F.lit(None).cast("int").alias("unit"), "start", F.col("template").alias("of"), "value")
    part = ["row", "unit", "start", "of"]
    bags = units.union(windows).select(*part, F.explode("value").alias("term")).groupBy(*part, "term").count()
    bags = kept(bags, "op6-bags")
    weighed = bags.join(idf, "term").select(*part, "term", (F.col("count") * F.col("idf")).alias("w"))
    weighed = kept(weighed, "op6-weighed")
    norms = weighed.groupBy(*part).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    # A window is compared with the template that it has the length of, a unit with all.
    met = weighed.join(F.broadcast(postings), "term").where("of IS NULL OR of = template")
    dots = met.groupBy(*part, "template").agg(F.sum(F.col("w") * F.col("weight")).alias("dot"))
    same = [F.col(f"d.{c}").eqNullSafe(F.col(f"n.{c}")) for c in part[1:]]
    near = dots.alias("d").join(norms.alias("n"), [F.col("d.row") == F.col("n.row"), *same])
    near = near.select("d.row", "d.unit", "d.start", "template", (F.col("dot") / F.col("norm")).alias("cosine")).where(F.col("cosine") >= threshold)
    best = near.groupBy("row", "unit", "start").agg(F.max(F.struct("cosine", (-F.col("template")).alias("t"))).alias("b"))
    return best.select("row", "unit", "start", (-F.col("b.t")).alias("template"), F.least("b.cosine", F.lit(1.0)).alias("cosine"))


def _ancestors(folder: Column) -> Column:
    """The folder itself and all above it, by depth: `a/b` gives "", "a", "a/b"."""
    parts = F.split(folder, "/")
    depth = F.when(folder == "", F.lit(0)).otherwise(F.size(parts))
    return F.transform(F.sequence(F.lit(0), depth), lambda d: F.struct(d.alias("depth"), F.array_join(F.slice(parts, F.lit(1), d), "/").alias("above")))


def scan(files: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """`path, licence, source, cosine, from_folder` for every row of `files` (`path`, `text`).

    `source` is `own` for a licence stated in the text, `inherited` for that of the nearest folder with a licence file, null
    where there is neither. A text near a full text or header has that licence, others that of a
    statement; of several the nearest holds, then the template listed first. Of several licence files of a folder the nearest to its template holds,
    then the alphabetically first licence. Null and empty texts state nothing; a null path inherits
    nothing. Repeated rows are scanned each for itself. Other columns are left unread.
    """
    folder = F.regexp_replace(F.regexp_replace("path", r"/?[^/]*$", ""), r"^/+", "")
    rows = files.select("path", "text", F.xxhash64("path", "text").alias("row"))
    found = kept(matches(rows.select("row", "text"), templates, threshold), "op6-units")
    names = F.array(*[F.lit(name) for name, _ in templates])
    texts = F.col("template").isin([k for k, (_, text) in enumerate(templates) if is_text(text)])
    own = found.groupBy("row").agg(F.max(F.struct(texts.alias("text"), "cosine", (-F.col("template")).alias("t"))).alias("b"), F.countDistinct("unit").alias("stated"), F.max(F.coalesce(F.col("start") == -1, F.lit(False))).alias("whole"))
    own = kept(own.select("row", F.get(names, -F.col("b.t")).alias("licence"), F.col("b.cosine").alias("cosine"), "stated", "whole"), "op6-own")
    filled = F.size(F.filter(F.split("text", UNITS), lambda u: F.trim(u) != ""))
    said = rows.join(own, "row").select("path", folder.alias("folder"), "licence", "cosine", (F.col("whole") | (F.col("stated") >= LICENCE_FILE * filled) | F.col("path").rlike(LICENCE_NAME)).alias("speaks"))
    named = said.where("speaks AND path IS NOT NULL").groupBy("folder").agg(F.max(F.struct("cosine", "licence")).alias("top"))
    top = said.where("speaks AND path IS NOT NULL").join(named, "folder").where(F.col("cosine") == F.col("top.cosine"))
    named = kept(top.groupBy("folder").agg(F.min("licence").alias("given"), F.max("cosine").alias("near")), "op6-folders")
    # Each folder once, however many files it holds, meets the folders above it.
    folders = files.select(folder.alias("folder")).where("folder IS NOT NULL").distinct()
    above = folders.select("folder", F.explode(_ancestors(F.col("folder"))).alias("a")).select("folder", "a.depth", "a.above")
    up = above.join(named.withColumnRenamed("folder", "above"), "above")
    nearest = up.groupBy("folder").agg(F.max(F.struct("depth", "above", "given", "near")).alias("n")).select("folder", "n.above", "n.given", "n.near")
    every = rows.select("row", "path", folder.alias("folder")).join(own.drop("stated", "whole"), "row", "left").join(nearest, "folder", "left")
    source = F.when(F.col("licence").isNotNull(), "own").when(F.col("given").isNotNull(), "inherited")
    return every.select("path", F.coalesce("licence", "given").alias("licence"), source.alias("source"), F.coalesce("cosine", "near").alias("cosine"), F.when(source == "inherited", F.col("above")).alias("from_folder"))
