"""License scans: a trained paragraph classifier, confirmed by templates; DataFrame functions only.

A paragraph is a line, or a window: two or more whole, consecutive, non-blank lines, begun at each line and ended with the
line of the WINDOW-th word, so that a notice that is wrapped is seen whole. Its features are hashed word 1- and 2-grams, and for up to NAME_WORDS words the whole of them. For
each license family, and for notices that name no license, a logistic regression on
these features is trained, on the driver, from the family's templates and variants of them (words dropped,
cut or surrounded by other words) against the other families, plain text and single words of licenses in other text; the training set is fixed
by parameters and doesn't grow with the table. The model is sparse: only n-grams of the templates have weights, so that its
size is bounded by theirs and it is broadcast. A paragraph's family is the one with the highest probability; below
``unknown`` (calibrated on held-out variants so that a stated share of plain text stays below) it is no license at all, or
"unknown" where it has a marker word. A prediction is confirmed where the paragraph holds at
least ``confirm`` of the n-grams of one of the family's templates. A window, which other text may surround, also has every family
of which it holds ``whole`` of a template, but for one whose template is mostly within one that it holds more of.

Of paragraphs that overlap, a window goes where one of its lines alone holds as much of its family's template (or, if it isn't
confirmed, of any); of overlapping windows of one family the best stays; a line goes where a window over it that stays holds more of a template.
A window is named by its first line.

Scoring: paragraphs without any word of Model.gate are passed over; without one, a probability of ``unknown`` or a
share of ``confirm`` is out of reach, which the model computes from its weights. N-grams are hashed once a line and only the
model's kept, of which windows are put together, with the pairs across the ends of lines. They meet the broadcast
weights, and sums by paragraph are shuffled.

Defined results: a null or empty text has no paragraphs; repeated rows of one doc_id and text are scored as one and give a
row each; a null doc_id is a key like any other; ties go to the family that comes first by name; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import functools
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, table

#: Short notices by which licenses are stated, by family.
TEMPLATES = {
    "AGPL": ("Licensed under the GNU Affero General Public License, version 3.", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    "Apache-1.1": ("Licensed under the Apache License, Version 1.1.", "Licensed under the Apache Software License, version 1.1."),
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    "BSD": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:", "Use of this source code is governed by a BSD-style license.", "Released under the BSD 3-Clause License."),
    "CC-BY": ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "Licensed under CC BY 4.0."),
    "CC-BY-NC": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC-BY-NC-ND": ("Licensed under CC BY-NC-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
    "CC-BY-NC-SA": ("Licensed under CC BY-NC-SA 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    "CC-BY-ND": ("Licensed under CC BY-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    "CC-BY-SA": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC0": ("This work is dedicated to the public domain under CC0 1.0 Universal.", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    "EPL-2.0": ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.", "Licensed under the Eclipse Public License, version 2.0."),
    "GPL": ("This work is licensed under the GNU General Public License, version 3.", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "Licensed under the GNU General Public License, version 2."),
    "ISC": ("Released under the ISC License.", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "LGPL": ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License.", "Licensed under the GNU Lesser General Public License, version 2.1."),
    "MIT": ("Released under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.", "Licensed under the MIT license."),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License, version 2.0."),
    "Unlicense": ("This is free and unencumbered software released into the public domain.", "Released under the Unlicense."),
}
#: Short names by which a line of its own or a short notice states a license.
NAMES = {
    "AGPL": ("AGPL", "AGPLv3", "AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later"),
    "Apache-1.1": ("Apache-1.1", "Apache 1.1", "Apache License 1.1"),
    "Apache-2.0": ("Apache-2.0", "Apache 2.0", "Apache License 2.0"),
    "BSD": ("BSD", "BSD-2-Clause", "BSD-3-Clause", "BSD License"),
    "CC-BY": ("CC BY 4.0", "CC BY"),
    "CC-BY-NC": ("CC BY-NC 4.0", "CC BY-NC"),
    "CC-BY-NC-ND": ("CC BY-NC-ND 4.0", "CC BY-NC-ND"),
    "CC-BY-NC-SA": ("CC BY-NC-SA 4.0", "CC BY-NC-SA"),
    "CC-BY-ND": ("CC BY-ND 4.0", "CC BY-ND"),
    "CC-BY-SA": ("CC BY-SA 4.0", "CC BY-SA"),
    "CC0": ("CC0", "CC0 1.0", "CC0 1.0 Universal"),
    "EPL-2.0": ("EPL-2.0", "EPL 2.0", "Eclipse Public License v 2.0"),
    "GPL": ("GPL", "GPLv3", "GPL-3.0", "GPL-2.0", "GPL-3.0-only", "GPL-3.0-or-later"),
    "ISC": ("ISC", "ISC License"),
    "LGPL": ("LGPL", "LGPL-2.1", "LGPL-3.0"),
    "MIT": ("MIT", "MIT License"),
    "MPL-2.0": ("MPL-2.0", "MPL 2.0"),
    "Unlicense": ("Unlicense", "The Unlicense"),
}
#: Words before a short name.
BEFORE = ("", "Distributed under", "Licensed under", "Released under", "License:", "SPDX-License-Identifier:")
#: Notices that name no license.
NOTICES = ("All rights reserved.", "Copyright (c) all rights reserved.", "See the license for details.", "No license is granted.", "Proprietary and confidential.", "Unauthorized copying of this file is strictly prohibited.", "The software is provided \"as is\", without warranty of any kind, express or implied.")
#: Words of plain text, for the negative examples.
PLAIN = "the of and to in is that for it as was with be by on not he his but at are this have from or had an they which one you were all her she there would their we him been has when who will no more if out so up said what its about than into them can only other time new some could these two may first then do any like my now over such our man me even most made after also did many off before must well back through years much where your way down should because long each just state those people too mr how little good world make very year still see own work men day get here".split()
MARKERS = ("licens", "licenc", "without warranty", "proprietary and confidential", "copyright", "gnu", "gpl", "cc by", "creative commons", "permission is hereby", "redistribut", "mozilla public", "free software", "source code form")  # parts of a line that make it one of a licence
ROUNDS, VARIANTS, UNKNOWN_SHARE, CONFIRM, NAME_WORDS = 300, 60, 0.02, 0.6, 8
WINDOW, WHOLE = 64, 0.8
_WORD = r"[^a-z0-9]+"


def _words(text: str) -> list[str]:
    out, word = [], ""
    for c in text.lower():
        if c.isascii() and c.isalnum():
            word += c
        elif word:
            out.append(word)
            word = ""
    return [*out, word] if word else out


def _grams(w: list[str]) -> set[str]:
    return {*w, *(f"{a} {b}" for a, b in zip(w, w[1:]))}


def _whole(w: list[str]) -> str:
    return "= " + " ".join(w)


class _Rows:
    """Sparse rows of n-grams that are there, each weighing 1 / sqrt of how many a row has."""

    def __init__(self, cells: list[list[int]]):
        size = np.array([len(c) for c in cells])
        self.n, self.some = len(cells), np.flatnonzero(size)
        self.col = np.array([g for c in cells for g in c], np.int64)
        self.row = np.repeat(np.arange(len(cells)), size)
        self.value = (1 / np.sqrt(np.maximum(size, 1)))[self.row, None]
        self.starts = np.searchsorted(self.row, self.some)
        self.order = np.argsort(self.col, kind="stable")
        self.cols, self.begins = np.unique(self.col[self.order], return_index=True)

    def times(self, weights: np.ndarray) -> np.ndarray:
        out = np.zeros((self.n, weights.shape[1]))
        out[self.some] = np.add.reduceat(weights[self.col] * self.value, self.starts)
        return out

    def back(self, off: np.ndarray, columns: int) -> np.ndarray:
        out = np.zeros((columns, off.shape[1]))
        out[self.cols] = np.add.reduceat((off[self.row] * self.value)[self.order], self.begins)
        return out


class Model:
    """Families, n-grams, weights (n-gram, family), biases, the probability below which a paragraph is no license, and the
    words (gate) of which a paragraph has one if it can reach that probability or be confirmed."""

    def __init__(self, seed: int = 3):
        self.families = [*sorted(TEMPLATES), "unknown"]
        texts = {**TEMPLATES, "unknown": NOTICES}
        names = {f: [w for n in NAMES.get(f, ()) for b in BEFORE if len(w := _words(f"{b} {n}")) <= NAME_WORDS] for f in self.families}
        self.templates = [(f, _grams(_words(t)), len(_grams(_words(t)))) for f in self.families for t in texts[f]]
        self.templates += [(f, {_whole(w) for w in names[f]}, 1) for f in self.families if names[f]]  # a paragraph is one name or none
        self.grams = sorted(set().union(*(g for _, g, _ in self.templates), *(_grams(w) for f in self.families for w in names[f])))
        place = {g: i for i, g in enumerate(self.grams)}
        rng = np.random.default_rng(seed)
        rows, y = [], []
        plain = lambda n: [str(x) for x in rng.choice(PLAIN, n)]
        for f in self.families:
            for t in texts[f]:
                w = _words(t)
                for v in range(VARIANTS):
                    kept = [x for x in w if rng.random() > (0.08 if v else 0.0)]
                    rows.append([*plain(rng.integers(0, 6)), *kept, *plain(rng.integers(0, 6))] if v else kept)
                    y.append(self.families.index(f))
            for w in names[f]:
                rows += [w] * (VARIANTS // 4)
                y += [self.families.index(f)] * (VARIANTS // 4)
        mixed = [x for f in self.families for t in texts[f] for x in _words(t)] + [x for f in self.families for w in names[f] for x in w]
        for v in range(VARIANTS * len(self.families) * 2):  # plain text, some with words of licenses in it
            w = plain(rng.integers(3, 40))
            for _ in range(rng.integers(0, 4) if v % 2 else 0):
                w.insert(int(rng.integers(len(w))), str(rng.choice(mixed)))
            rows.append(w)
            y.append(-1)
        for w in sorted(set(mixed)):  # words of licenses among words that no template has, as of other languages
            for v in range(VARIANTS // 2):
                rows.append(["-", w, "-", *(str(x) for x in rng.choice(mixed, v % 3 // 2)), "-"])
                y.append(-1)
        cells = [sorted({place[g] for g in (*_grams(w), _whole(w)) if g in place}) for w in rows]
        y = np.array(y)
        fitted = np.array([zlib.crc32(str(i).encode()) % 4 > 0 for i in range(len(y))])
        self.weights, self.bias = np.zeros((len(self.grams), len(self.families))), np.full(len(self.families), -2.0)
        own = Counter((tuple(c), k) for c, k, f in zip(cells, y.tolist(), fitted) if f)  # equal rows are one with a weight
        learn, weight = _Rows([list(c) for c, _ in own]), np.array([*own.values()], float)[:, None]
        target = (np.array([k for _, k in own])[:, None] == np.arange(len(self.families))).astype(float)
        step = np.zeros_like(self.weights), np.zeros_like(self.bias)
        for _ in range(ROUNDS):
            off = (self._sure(learn.times(self.weights)) - target) * weight / weight.sum()
            gw, gb = learn.back(off, len(self.grams)) + 1e-5 * self.weights, off.sum(0)
            step[0][:], step[1][:] = step[0] + gw**2, step[1] + gb**2
            self.weights -= 0.5 * gw / (np.sqrt(step[0]) + 1e-6)
            self.bias -= 0.5 * gb / (np.sqrt(step[1]) + 1e-6)
        self.weights[np.abs(self.weights) < 1e-3] = 0.0
        held = self._sure(_Rows([c for c, f in zip(cells, fitted) if not f]).times(self.weights))
        self.unknown = max(0.5, float(np.quantile(held[y[~fitted] < 0].max(1), 1 - UNKNOWN_SHARE)))
        self.accuracy = float((held[y[~fitted] >= 0].argmax(1) == y[~fitted][y[~fitted] >= 0]).mean())

        self.gate = self._gate()

    def _sure(self, sums: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(sums + self.bias, -40, 40)))

    def _p(self, x: np.ndarray) -> np.ndarray:
        return self._sure(x @ self.weights)

    def _gate(self) -> list[str]:
        """Words not of plain text, and more by weight until n-grams without any of them reach nothing together."""
        parts = [g.removeprefix("= ").split() for g in self.grams]
        gate = {w for p in parts for w in p} - set(PLAIN)
        while True:
            light = [i for i, p in enumerate(parts) if not gate & set(p)]
            if not light:
                return sorted(gate)
            most = np.sort(self.weights[light], 0)[::-1].cumsum(0) / np.sqrt(np.arange(1, len(light) + 1))[:, None]
            share = max(len({self.grams[i] for i in light} & g) / size for _, g, size in self.templates)
            if (1 / (1 + np.exp(-most.max(0) - self.bias))).max() < self.unknown and share < CONFIRM:
                return sorted(gate)
            gate |= set(parts[max(light, key=lambda i: self.weights[i].max())])


@functools.cache
def default_model() -> Model:
    """The model of the fixed templates, trained once a process."""
    return Model()


def gram_hashes(spark: SparkSession, model: Model) -> dict[str, int]:
    """The hash of every n-gram of the model (as many as its templates have), and of "", which stands for a paragraph."""
    gram = F.col("gram")
    at = F.when(gram.startswith("= ") | (gram == ""), F.xxhash64(gram)).otherwise(F.xxhash64(F.get(F.split(gram, " "), F.lit(0)), F.get(F.split(gram, " "), F.lit(1))))
    return {r["gram"]: r["at"] for r in spark.createDataFrame([(g,) for g in ["", *model.grams]], "gram string").select("gram", at.alias("at")).collect()}


def paragraphs(docs: DataFrame, model: Model, hashes: dict[str, int]) -> DataFrame:
    """(row, key, first, last, marked, grams) of the paragraphs with a marker or a word of the gate; first and last are lines,
    grams the hashes of n-grams, once each, those of the model among them."""
    text = F.col("text").cast("string")
    gate, known = [hashes[w] for w in model.gate], [hashes[g] for g in model.grams]  # sets that are made once, not for every line

    def line(s):
        blank = F.btrim(s, F.lit(" \t\r\f\v")) == ""
        return F.struct(F.array_remove(F.split(s, _WORD, -1), "").alias("words"), functools.reduce(lambda a, m: a | s.contains(m), MARKERS, F.lit(False)).alias("marked"), blank.alias("blank"))

    def pairs(a, b):  # the last has none after it: its hash is that of a word
        return F.zip_with(a, F.slice(a, F.lit(2), F.size(a)), b)

    def features(x):
        words = x["words"]
        grams = F.concat(F.transform(words, lambda w: F.xxhash64(w)), pairs(words, lambda v, w: F.xxhash64(v, w)))
        n = F.when(x["blank"], 0).otherwise(F.greatest(F.size(words), F.lit(1)))
        return F.struct(F.array_distinct(F.filter(grams, lambda g: g.isin(known))).alias("grams"), F.when(F.size(words) <= NAME_WORDS, words).alias("few"), F.get(words, F.lit(0)).alias("head"), F.get(words, F.size(words) - 1).alias("tail"), F.size(words).alias("size"), x["marked"].alias("marked"), n.alias("n"))

    def whole(words):  # null, if there are more
        return F.when(F.size(words) <= NAME_WORDS, F.array(F.xxhash64(F.concat(F.lit("= "), F.array_join(words, " ")))))

    def length(lines, i):  # lines of the window that begins at line i
        step = lambda a, x: F.when(a["stop"] | (x["n"] == 0), F.struct(a["k"].alias("k"), a["n"].alias("n"), F.lit(True).alias("stop"))).otherwise(F.struct((a["k"] + 1).alias("k"), (a["n"] + x["n"]).alias("n"), (a["n"] + x["n"] >= WINDOW).alias("stop")))
        return F.aggregate(F.slice(lines, i + 1, F.lit(WINDOW)), F.struct(F.lit(0).alias("k"), F.lit(0).alias("n"), F.lit(False).alias("stop")), step, lambda a: a["k"])

    key = F.struct("doc_id", F.xxhash64(text).alias("th")).alias("key")
    none = F.array().cast("array<bigint>")
    # Exploded so that the lines are computed once, not in each use.
    docs = docs.filter(text.isNotNull()).select(F.monotonically_increasing_id().alias("row"), key, F.explode_outer(F.array(F.transform(F.split(ascii_lower(text), "\n"), line))).alias("cut"))
    docs = docs.select("row", "key", F.explode_outer(F.array(F.transform("cut", features))).alias("lines"))
    docs = docs.select("row", "key", "lines", F.explode_outer(F.array(F.transform("lines", lambda x: F.exists(x["grams"], lambda g: g.isin(gate))))).alias("passes"))
    docs = docs.filter(F.exists("passes", lambda x: x) | F.exists("lines", lambda x: x["marked"]))  # no other text has a paragraph
    at = F.sequence(F.lit(0), F.size("lines") - 1)
    named = lambda x: F.concat(x["grams"], F.coalesce(whole(x["few"]), none))
    lines = F.transform(F.filter(at, lambda i: (F.get("passes", i) | F.get("lines", i)["marked"]) & (F.get("lines", i)["size"] > 0)), lambda i: F.struct(i.alias("first"), i.alias("last"), F.get("lines", i)["marked"].alias("marked"), named(F.get("lines", i)).alias("grams")))
    spans = F.transform(at, lambda i: F.struct(i.alias("first"), length(F.col("lines"), i).alias("k")))
    spans = F.filter(spans, lambda w: (w["k"] > 1) & F.exists(F.slice("passes", w["first"] + 1, w["k"]), lambda x: x))

    def joined(own):  # grams of lines together: theirs, those across their ends, and the whole of them
        across = pairs(F.filter(own, lambda x: x["size"] > 0), lambda a, b: F.xxhash64(a["tail"], b["head"]))
        few = F.when(F.forall(own, lambda x: x["size"] <= NAME_WORDS), F.flatten(F.transform(own, lambda x: x["few"])))
        return F.array_distinct(F.concat(F.flatten(F.transform(own, lambda x: x["grams"])), across, F.coalesce(whole(few), none)))

    windows = F.transform(spans, lambda w: F.struct(w["first"].alias("first"), (w["first"] + w["k"] - 1).alias("last"), F.lit(False).alias("marked"), joined(F.slice("lines", w["first"] + 1, w["k"])).alias("grams")))
    return docs.select("row", "key", F.explode(F.concat(lines, windows)).alias("p")).select("row", "key", "p.*")


def classified(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """(key, paragraph, family, probability, confirmed) of every paragraph of a family or with a marker word."""
    model = model or default_model()
    spark = docs.sparkSession
    hashes = gram_hashes(spark, model)
    grams = F.concat("grams", F.array(F.lit(hashes[""])))  # a row for the paragraph too
    known = paragraphs(docs, model, hashes).select("row", "key", "first", "last", "marked", F.explode(grams).alias("gram"))
    rows = [(hashes[g], [float(v) for v in model.weights[i]], [k for k, (_, t, _) in enumerate(model.templates) if g in t]) for i, g in enumerate(model.grams)]
    rows.append((hashes[""], [0.0] * len(model.families), []))
    weights = F.broadcast(spark.createDataFrame(rows, "gram long, weights array<double>, templates array<int>"))  # as many rows as the templates have n-grams
    n, m = len(model.families), len(model.templates)
    sums = [F.sum(F.col("weights")[i]).alias(f"w{i}") for i in range(n)] + [F.count_if(F.array_contains("templates", k)).alias(f"t{k}") for k in range(m)]
    scored = known.join(weights, "gram").groupBy("row", "key", "first", "last", "marked").agg(F.count_if(F.col("gram") != hashes[""]).alias("n"), *sums)
    p = [F.struct((1 / (1 + F.exp(-(F.col(f"w{i}") / F.sqrt(F.greatest("n", F.lit(1))) + float(model.bias[i]))))).alias("p"), F.lit(-i).alias("order"), F.lit(f).alias("family"), F.greatest(*(F.col(f"t{k}") / float(size) for k, (g, _, size) in enumerate(model.templates) if g == f), F.lit(0.0)).alias("share")) for i, f in enumerate(model.families)]
    scored = scored.select("key", "first", "last", "marked", F.explode_outer(F.array(F.array(*p))).alias("all"))
    inside = {(f, g) for f, a, size in model.templates for g, b, _ in model.templates if f != g and len(a & b) >= CONFIRM * size}
    rivals = F.create_map(*(x for f in model.families for x in (F.lit(f), F.array(*(F.lit(g) for g in model.families if (f, g) in inside)).cast("array<string>"))))
    held_more = lambda x: F.exists("all", lambda y: (y["share"] > x["share"]) & F.array_contains(rivals[x["family"]], y["family"]))
    scored = scored.withColumn("all", F.filter("all", lambda x: ~held_more(x)))  # no family of which a rival's template is held better
    best = F.array_max("all")
    held = F.filter("all", lambda x: (x["share"] >= WHOLE) | ((x["order"] == best["order"]) & (x["p"] >= model.unknown)))
    found = scored.select("key", "first", "last", "marked", F.explode(F.when(F.col("first") < F.col("last"), held).otherwise(F.array(best))).alias("x"))
    sure = (F.col("first") < F.col("last")) | (F.col("x.p") >= model.unknown)
    found = found.filter(sure | F.col("marked")).select("key", F.struct("first", "last", F.when(sure, F.col("x.family")).otherwise("unknown").alias("family"), F.col("x.p").alias("p"), F.when(sure, F.col("x.share")).otherwise(0.0).alias("share")).alias("x"))
    own = found.groupBy("key").agg(F.collect_set("x").alias("all"))
    own = own.withColumns({"lines": F.filter("all", lambda x: x["first"] == x["last"]), "windows": F.filter("all", lambda x: x["first"] < x["last"])})
    within = lambda x, w: (w["first"] <= x["first"]) & (x["last"] <= w["last"])
    own = own.withColumn("windows", F.filter("windows", lambda w: ~F.exists("lines", lambda x: within(x, w) & (x["share"] >= w["share"]) & ((x["family"] == w["family"]) | (w["share"] < CONFIRM)))))
    rank = lambda w: F.struct(w["share"], w["p"], w["first"])
    own = own.withColumn("windows", F.filter("windows", lambda w: ~F.exists("windows", lambda v: (v["family"] == w["family"]) & (v["first"] <= w["last"]) & (w["first"] <= v["last"]) & (rank(v) > rank(w)))))
    own = own.withColumn("lines", F.filter("lines", lambda x: ~F.exists("windows", lambda w: within(x, w) & (w["share"] > x["share"]))))
    out = own.select("key", F.explode(F.concat("lines", "windows")).alias("x"))
    return out.select("key", F.col("x.first").alias("paragraph"), "x.family", F.round("x.p", 6).alias("probability"), ((F.col("x.family") != "unknown") & (F.col("x.share") >= CONFIRM)).alias("confirmed"))


def scan(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, n_paragraphs of a family or with a marker, families found (sorted), the confirmed of them, and each paragraph's result."""
    found = classified(docs, model).groupBy("key").agg(F.array_sort(F.collect_list(F.struct("paragraph", "family", "probability", "confirmed"))).alias("found"))
    here = docs.select("doc_id", F.struct("doc_id", F.xxhash64(F.col("text").cast("string")).alias("th")).alias("own"))
    both = here.join(found, F.col("own").eqNullSafe(F.col("key")), "left")
    none = F.array().cast("array<struct<paragraph:int,family:string,probability:double,confirmed:boolean>>")
    both = both.select("doc_id", F.coalesce("found", none).alias("found"))
    names = lambda keep: F.array_join(F.array_sort(F.array_distinct(F.transform(F.filter("found", keep), lambda x: x["family"]))), ",")
    return both.select("doc_id", F.size("found").cast("long").alias("n_paragraphs"), names(lambda x: x["family"] != "unknown").alias("families"), names(lambda x: x["confirmed"]).alias("confirmed"), F.transform("found", lambda x: F.concat_ws(":", x["paragraph"], x["family"], F.format_number(x["probability"], 4))).alias("found"))


def op5_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
