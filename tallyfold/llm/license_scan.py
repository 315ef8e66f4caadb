"""Licence families of paragraphs by a trained classifier, DataFrame functions only.

Multinomial logistic regression over the word 1- and 2-grams present in a
paragraph, fitted on the driver from variations of the templates below and of
other prose, with an unknown class and a temperature set on held-out variations.
A prediction is confirmed by comparing the paragraph with that family's templates,
and its version and family words with the family's.
Scoring is built from array functions; only texts with a word that every half of
a template holds are tokenized.
"""

from __future__ import annotations

import random
import re
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Short notices of the licence families (fixed values).
TEMPLATES = {
    "apache-2.0": ["Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."],
    "mit": ["Released under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"],
    "gpl-3.0": ["This work is licensed under the GNU General Public License, version 3.", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "cc-by-nc-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "cc-by-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "bsd-3-clause": ["Released under the BSD 3-Clause License.", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "mpl-2.0": ["Licensed under the Mozilla Public License, Version 2.0.", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
}
#: Prose that shares words with the templates but is no licence.
OTHER = [
    "The driver lost a license after the second version of the story was released under pressure.", "Permission to enter the public library is free for any person with a card.", "The general said that this work is subject to the terms of the contract.", "He was licensed to practise law in the north.",
    "A copyright dispute over the software was settled without restriction.", "The warranty of the machine covers the following conditions.", "The license plate of the car was under the cover.", "Apache helicopters flew over the mountains in version two of the plan.", "The MIT students released a copy of the paper.",
    "Use of the source is permitted in winter.", "Redistribution of wealth and the public purse were debated.", "All rights reserved by the publisher.", "Creative people work in common rooms.", "The foundation published a free guide to modify old houses.",
]
UNKNOWN = "unknown"
CLASSES = (*TEMPLATES, UNKNOWN)
#: A line with one of these gives a row, confirmed or not.
CUES = ("licen", "permission", "redistribut", "public license")
THRESHOLD, SIMILARITY = 0.5, 0.5
#: Regular expressions over " words ": what a confirmed family must hold, must not hold, and its version.
NEEDED = {
    "apache-2.0": " apache ", "mit": " (mit|hereby|granted|obtaining|associated|restriction|charge) ", "gpl-3.0": " (gnu|gplv?3?|foundation|general) ", "cc-by-nc-4.0": " (noncommercial|non commercial|by nc) ", "cc-by-4.0": " (cc|creative|commons) ", "bsd-3-clause": " (bsd|redistributions?) ", "mpl-2.0": " (mozilla|mpl) ",
}
_SHARED = " (sharealike|share alike|noderivatives|noderivs|no derivatives|(by|nc) (sa|nd)) "
REFUSED = {"gpl-3.0": " (lesser|affero|library general|[al]gpl[v0-9.]*) ", "cc-by-nc-4.0": _SHARED, "cc-by-4.0": f"{_SHARED}| (noncommercial|non commercial|by nc) "}
_AT = " (((version|v|licen[sc]e|apache|gpl|mpl) v?|v|gplv|mplv)%s|%s (or|only)) "
_CC_AT = " ((version|v|by|nc|attribution|noncommercial|licen[sc]e) v?|v)%s "
_ANY = "[0-9]{1,2}([.][0-9]+)*"
#: (any version, the family's own version).
VERSIONS = {f: (at.replace("%s", _ANY), at.replace("%s", own)) for f, at, own in (("apache-2.0", _AT, "2([.]0)?"), ("gpl-3.0", _AT, "3([.]0)?"), ("mpl-2.0", _AT, "2([.]0)?"), ("cc-by-nc-4.0", _CC_AT, "4([.]0)?"), ("cc-by-4.0", _CC_AT, "4([.]0)?"))} | {"bsd-3-clause": (" [0-9] clause ", " 3 clause ")}


def words_of(text: str) -> list[str]:
    return [w for w in "".join(c if c in "abcdefghijklmnopqrstuvwxyz0123456789." else " " for c in text.lower()).replace(". ", " ").strip(" .").split() if w]


def grams_of(words: list[str]) -> set[str]:
    return {*words, *(f"{a} {b}" for a, b in zip(words, words[1:], strict=False))}


def examples(seed: int, each: int = 60) -> list[tuple[set[str], int]]:
    """(n-grams, class) of variations: words lost, joined by other words, cut short, in other prose."""
    rng = random.Random(seed)
    filler = ["the", "an", "er", "on", "of", "ti", "ing", "here", "copyright", "2024", "project", "see", "file", "all", "and", "is", "work"]
    out = []
    for k, family in enumerate(TEMPLATES):
        for template in TEMPLATES[family]:
            words = words_of(template)
            for _ in range(each):
                w = [x for x in words if rng.random() > 0.08]
                w = w[: max(4, int(len(w) * rng.uniform(0.6, 1)))] if rng.random() < 0.3 else w
                pad = [rng.choice(filler) for _ in range(rng.randint(0, 12))]
                cut = rng.randint(0, len(pad))
                out.append((grams_of(pad[:cut] + w + pad[cut:]), k))
    vocabulary = sorted({w for t in TEMPLATES.values() for x in t for w in words_of(x)})
    for text in OTHER:
        words = words_of(text)
        for _ in range(each // 2):
            w = [x for x in words if rng.random() > 0.1] + [rng.choice(filler) for _ in range(rng.randint(0, 8))]
            out.append((grams_of(w), len(CLASSES) - 1))
    for _ in range(each * 8):  # words of the templates in no order, and cue words alone
        w = [rng.choice(vocabulary if rng.random() < 0.4 else filler) for _ in range(rng.randint(3, 25))]
        out.append((grams_of(w), len(CLASSES) - 1))
    return out


@lru_cache(1)
def model() -> tuple[dict[str, list[float]], list[float]]:
    """({n-gram: a weight for each class}, biases), scaled by the temperature."""
    data = examples(1)
    count: dict[str, int] = {}
    for g, _ in data:
        for x in g:
            count[x] = count.get(x, 0) + 1
    allowed = {x for t in TEMPLATES.values() for s in t for x in grams_of(words_of(s))}
    names = sorted(x for x in allowed if count.get(x, 0) >= 5)
    at = {x: i for i, x in enumerate(names)}

    def matrix(rows):
        m = np.zeros((len(rows), len(names)))
        for i, (g, _) in enumerate(rows):
            m[i, [at[x] for x in g if x in at]] = 1
        return m, np.array([k for _, k in rows])

    def soft(z):
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)

    x, y = matrix(data)
    w, bias, one = np.zeros((len(names), len(CLASSES))), np.zeros(len(CLASSES)), np.eye(len(CLASSES))[y]
    speed_w, speed_b = np.zeros_like(w), np.zeros_like(bias)
    for _ in range(600):
        e = (soft(x @ w + bias) - one) / len(x)
        speed_w = 0.9 * speed_w + x.T @ e + 2e-4 * w
        speed_b = 0.9 * speed_b + e.sum(0)
        w -= 0.5 * speed_w
        bias -= 0.5 * speed_b
    held, truth = matrix(examples(2, 20))
    scales = np.linspace(0.4, 3, 27)
    loss = [-np.log(soft(s * (held @ w + bias))[np.arange(len(held)), truth] + 1e-12).mean() for s in scales]
    best = scales[int(np.argmin(loss))]
    return {n: [round(float(v), 6) for v in row * best] for n, row in zip(names, w, strict=True)}, [round(float(v), 6) for v in bias * best]


def classify(text: str) -> tuple[str, float, float]:
    """(family, probability, similarity) of one paragraph, the plain way: what the columns must give."""
    weights, bias = model()
    words = words_of(text)
    grams = grams_of(words)
    z = np.array(bias) + sum((np.array(weights[g]) for g in sorted(grams) if g in weights), np.zeros(len(CLASSES)))
    p = np.exp(z - z.max())
    p /= p.sum()
    k = int(p.argmax())
    near = max((len(grams & grams_of(words_of(t))) / len(grams_of(words_of(t))) for t in TEMPLATES.get(CLASSES[k], ())), default=0.0)
    return CLASSES[k], float(p[k]), near


def fits(family: str, words: list[str]) -> bool:
    """Whether version and family words of a paragraph allow this family, the plain way."""
    text = f" {' '.join(words)} "
    has = lambda x: re.search(x, text) is not None
    version, own = VERSIONS.get(family, ("^$", "^$"))
    return family in NEEDED and has(NEEDED[family]) and not (family in REFUSED and has(REFUSED[family])) and (not has(version) or has(own))


def part_cues() -> list[str]:
    """Words of which every part of a template that can be confirmed holds one: without them under SIMILARITY is left."""
    common = set("the a of to in and or by under is this any for with as at it are you may not use work file that".split())
    out = set()
    for template in (t for ts in TEMPLATES.values() for t in ts):
        grams, chosen = grams_of(words_of(template)), set()
        for word in sorted(set(words_of(template)), key=lambda w: (w in common, -len(w), w)):
            if sum(not chosen & set(g.split()) for g in grams) < SIMILARITY * len(grams):
                break
            chosen.add(word)
        out |= chosen
    return sorted(out)


#: A template's words, at most: a notice that begins in a line ends within so many words behind it, however it is wrapped.
LONGEST = max(len(words_of(t)) for ts in TEMPLATES.values() for t in ts)


def _grams(w: Column) -> Column:
    pairs = F.transform(F.sequence(F.lit(0), F.size(w) - 2), lambda i: F.concat(w[i], F.lit(" "), w[i + 1]))
    return F.array_distinct(F.concat(w, F.when(F.size(w) > 1, pairs).otherwise(F.array().cast("array<string>"))))


def _words(text: Column) -> Column:
    clean = F.regexp_replace(F.lower(text), "[^a-z0-9.]", " ")
    clean = F.regexp_replace(clean, "\\. ", " ")
    return F.filter(F.split(F.regexp_replace(clean, "^[ .]+|[ .]+$", ""), " +"), lambda w: w != "")


def license_paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, paragraph, text, family, probability, similarity, confirmed): one row per line with a cue word and per notice.

    Lines of a text are numbered from 0. A notice is a confirmed line or run of
    neighbouring lines (those without words left out, joined by line feeds,
    numbered by its first); of overlapping ones the most similar counts, then
    the shortest, then the first. Lines of a run have no rows of their own.
    family is the most probable class, unknown included; confirmed if it is a
    family, probable enough, the text holds SIMILARITY of the n-grams of one of
    its templates, and version and family words fit it. Null and empty texts
    have no rows; repeated rows and null ids are kept; other columns are
    ignored; an empty table gives no rows.
    """
    weights, bias = model()
    text = F.col(text_col).cast("string")
    cue = lambda c: F.lower(c).rlike("|".join(CUES))

    def some(low: Column) -> Column:
        out = F.lit(False)
        cues = {*CUES, *part_cues()}
        for w in sorted(w for w in cues if not any(len(c) > 4 and c in w for c in cues - {w})):  # what holds a longer cue is found by that
            here = F.contains(low, F.lit(w))  # quick; short words also need bounds
            out |= here if len(w) > 4 else here & low.rlike(f"(?<![a-z0-9]){re.escape(w)}(?![a-z0-9])")
        return out

    # a text is put into lower case once, whatever the number of words looked for
    texts = docs.where(F.exists(F.array(F.lower(text)), some)).select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("doc_id"), text.alias("text")).select("_row", "doc_id", F.posexplode(F.split("text", "\n", -1)).alias("p", "t"))
    # each line with those behind it that a notice beginning in it can reach: a row holds LONGEST lines at most, however long the text
    reach = Window.partitionBy("_row").orderBy("p").rowsBetween(0, LONGEST - 1)
    starts = texts.withColumn("w", _words(F.col("t"))).where(F.size("w") > 0).select("_row", "doc_id", F.collect_list(F.struct("p", "t", "w")).over(reach).alias("_s"))
    more = lambda a, x: F.when(a["n"] < LONGEST - 1, F.struct((a["n"] + F.size(x["w"])).alias("n"), (a["k"] + 1).alias("k"))).otherwise(a)
    most = F.aggregate(F.slice("_s", 2, LONGEST), F.struct(F.lit(0).alias("n"), F.lit(1).alias("k")), more)["k"]
    starts = starts.withColumn("_k", most).withColumn("_w", F.flatten(F.transform(F.slice("_s", F.lit(1), F.col("_k")), lambda x: x["w"])))
    templates = [(name, sorted(grams_of(words_of(t)))) for name, ts in TEMPLATES.items() for t in ts]
    share = lambda g: F.size(F.array_intersect("_g", F.array(*map(F.lit, g)))) / len(g)
    # a part holds no more of a template than the whole reach does
    starts = starts.withColumn("_g", F.array_intersect(_grams(F.col("_w")), F.array(*map(F.lit, sorted({x for _, g in templates for x in g})))))
    ends = F.when(F.greatest(*[share(g) for _, g in templates]) >= SIMILARITY, F.sequence(F.lit(1), F.col("_k"))).when(cue(F.col("_s")[0]["t"]), F.array(F.lit(1)))
    lines = starts.select("_row", "doc_id", "_s", F.explode(ends).alias("_k")).withColumn("_s", F.slice("_s", F.lit(1), F.col("_k")))
    lines = lines.select("_row", "doc_id", "_k", F.col("_s")[0]["p"].alias("paragraph"), F.element_at("_s", -1)["p"].alias("_end"), F.array_join(F.transform("_s", lambda x: x["t"]), "\n").alias("text"), F.flatten(F.transform("_s", lambda x: x["w"])).alias("_w"))
    lines = lines.withColumn("_g", _grams(F.col("_w")))
    vocabulary = sorted(weights)
    table = F.create_map(*[x for n in vocabulary for x in (F.lit(n), F.array(*map(F.lit, weights[n])))])
    lines = lines.withColumn("_f", F.transform(F.array_sort(F.array_intersect("_g", F.array(*map(F.lit, vocabulary)))), lambda g: F.element_at(table, g)))
    total = lambda k, b: F.aggregate("_f", F.lit(b), lambda a, v: a + v[k])
    z = F.array(*[total(k, b) for k, b in enumerate(bias)])
    lines = lines.withColumn("_z", z).withColumn("_e", F.transform("_z", lambda v: F.exp(v - F.array_max("_z"))))
    lines = lines.withColumn("probability", 1 / F.aggregate("_e", F.lit(0.0), lambda a, v: a + v)).withColumn("family", F.element_at(F.array(*map(F.lit, CLASSES)), F.array_position("_z", F.array_max("_z")).cast("int")))
    near, right, held = F.lit(0.0), F.lit(False), F.concat(F.lit(" "), F.array_join("_w", " "), F.lit(" "))
    for name in TEMPLATES:
        near = F.when(F.col("family") == name, F.greatest(F.lit(0.0), *[share(g) for n, g in templates if n == name])).otherwise(near)
        fit = held.rlike(NEEDED[name])
        if name in REFUSED:
            fit &= ~held.rlike(REFUSED[name])
        if name in VERSIONS:
            fit &= ~held.rlike(VERSIONS[name][0]) | held.rlike(VERSIONS[name][1])
        right = F.when(F.col("family") == name, fit).otherwise(right)
    lines = lines.withColumn("similarity", near)
    sure = (F.col("family") != UNKNOWN) & (F.col("probability") >= THRESHOLD) & (F.col("similarity") >= SIMILARITY) & right
    lines = lines.withColumn("confirmed", sure)
    one = F.struct((-F.col("similarity")).alias("far"), F.col("_k").alias("k"), "paragraph", F.col("_end").alias("end"), "text", "family", "probability", "similarity", "confirmed")
    kept = F.col("confirmed") | ((F.col("_k") == 1) & cue(F.col("text")))
    # what overlaps, directly or through others, is settled together; a filter behind the windows is not worked out again below them
    before = Window.partitionBy("_row").orderBy("paragraph", "_end")
    lines = lines.withColumn("_kept", kept).select("_row", "doc_id", "paragraph", "_end", "_kept", one.alias("_one"))
    lines = lines.withColumn("_reached", F.max(F.when(F.col("_kept"), F.col("_end"))).over(before.rowsBetween(Window.unboundedPreceding, -1)))
    lines = lines.withColumn("_island", F.count_if(F.col("_kept") & (F.col("_reached").isNull() | (F.col("paragraph") > F.col("_reached")))).over(before.rowsBetween(Window.unboundedPreceding, 0))).where("_kept")
    found = lines.groupBy("_row", "_island").agg(F.first("doc_id").alias("doc_id"), F.array_sort(F.collect_list("_one")).alias("_all"))
    meets = lambda x, y: (x["paragraph"] <= y["end"]) & (y["paragraph"] <= x["end"])
    place = lambda x: F.struct(x["paragraph"].alias("paragraph"), x["end"].alias("end"))
    taken = F.aggregate(F.filter("_all", lambda x: x["confirmed"]), F.array().cast("array<struct<paragraph:int,end:int>>"), lambda a, x: F.when(F.exists(a, lambda y: meets(x, y)), a).otherwise(F.array_append(a, place(x))))
    found = found.withColumn("_taken", taken)
    stays = lambda x: F.array_contains("_taken", place(x)) | ((x["k"] == 1) & ~F.exists("_taken", lambda y: meets(x, y)))
    out = found.select("doc_id", F.explode(F.filter("_all", stays)).alias("x"))
    return out.select("doc_id", *[f"x.{c}" for c in ("paragraph", "text", "family", "probability", "similarity", "confirmed")])
