import re
import textwrap

import numpy as np
import pytest

from docflow.llm.licenses import MARKERS, TEMPLATES, Model, _grams, _whole, _words, default_model, op5_license_scans, scan


def test_held_out_variants_and_plain_text():
    model = Model()
    assert model.accuracy > 0.95 and 0.5 <= model.unknown < 1


def test_families_unknown_and_none(spark):
    rows = [(i, f"Intro line.\n{t}\nend", f) for i, (f, ts) in enumerate(TEMPLATES.items()) for t in ts[:1]]
    rows += [(100, "", None), (101, None, None), (102, "nothing to see", None), (103, "The licence of poets is broad and the night was long", "?"), (None, "Released under the MIT License.", "MIT"), (0, "x", None)]
    got = scan(spark.createDataFrame([(a, b, "k") for a, b, _ in rows], "doc_id long, text string, key string")).collect()
    assert len(got) == len(rows)
    want = {(a, f) for a, _, f in rows if f and f != "?"}
    assert {(r.doc_id, r.confirmed) for r in got if r.confirmed} == want
    assert {r.doc_id for r in got if r.n_paragraphs and not r.families} == {103}
    assert scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_planted_lines_at_small_scale(spark):
    d = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in op5_license_scans(spark, d).collect()}
    lines = {"Licensed under the Apache License, Version 2.0.": "Apache-2.0", "Released under the MIT License.": "MIT", "Licensed under CC BY-NC 4.0.": "CC-BY-NC", "This work is licensed under the GNU General Public License, version 3.": "GPL"}
    for r in spark.read.parquet(f"{d}/documents.parquet").collect():
        want = sorted({f for line, f in lines.items() if line in (r.text or "")})
        assert [f for f in got[r.doc_id].confirmed.split(",") if f] == want


def test_lines_without_a_marker_are_scored(spark):
    lines = {"All rights reserved.": None, "Distributed under Apache 2.0.": "Apache-2.0", "CC-BY-SA 4.0": "CC-BY-SA", "MIT": "MIT", "BSD-3-Clause": "BSD", "SPDX-License-Identifier: MIT": "MIT", "Er kam mit dem Zug": "", "It was made of this and that": ""}
    rows = [(i, f"The first line of it\n{t}\nand so on") for i, t in enumerate(lines)]
    got = {r.doc_id: r for r in scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, f in enumerate(lines.values()):
        assert (got[i].n_paragraphs, got[i].families, got[i].confirmed) == (int(f != ""), f or "", f or "")


def test_nothing_is_out_of_the_gate():
    model, rng = Model(), np.random.default_rng(5)
    outside = [i for i, g in enumerate(model.grams) if not set(g.split()) & set(model.gate)]
    for _ in range(300):
        x = np.zeros((1, len(model.grams)))
        own = rng.choice(outside, rng.integers(1, len(outside) + 1), replace=False)
        x[0, own] = 1 / np.sqrt(len(own))
        assert model._p(x).max() < model.unknown


def test_reserved_rights_at_small_scale(spark):
    d = "/root/testdata/sf0.01"
    got = {r.doc_id: r.found for r in op5_license_scans(spark, d).collect()}
    places = [(r.doc_id, i) for r in spark.read.parquet(f"{d}/documents.parquet").collect() for i, s in enumerate((r.text or "").split("\n")) if s == "All rights reserved."]
    assert places
    for doc, i in places:
        assert any(x.startswith(f"{i}:unknown:") for x in got[doc])


@pytest.mark.parametrize("width", [20, 45, 72])
def test_wrapped_notices(spark, width):
    wrap = lambda t, sign="": "\n".join(sign + s for s in textwrap.wrap(t, width))
    long = {f: max(ts, key=len) for f, ts in TEMPLATES.items()}
    rows = [(i, wrap(t), {f}) for i, (f, t) in enumerate(long.items())]
    rows += [(20, "Some words\n\n" + wrap(long["GPL"], "# ") + "\nand it was made by her. " + "They have been there before. " * 40, {"GPL"})]
    rows += [(21, wrap(long["Apache-2.0"]) + "\nReleased under the MIT License.", {"Apache-2.0", "MIT"}), (22, wrap(long["BSD"]) + "\n" + wrap(long["MIT"]), {"BSD", "MIT"})]
    rows += [(23, "The night was long\nand it was made of this\nand that", set())]
    got = {r.doc_id: r for r in scan(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")).collect()}
    for i, _, want in rows:
        assert {f for f in got[i].confirmed.split(",") if f} == want, (i, got[i])
    assert got[23].n_paragraphs == 0


@pytest.mark.parametrize(
    "text, family",
    [
        ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License, version 3.", "AGPL"),
        ("This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.", "CC-BY-ND"),
        ("This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.", "CC-BY-NC-SA"),
        ("Eclipse Public License - v 2.0", "EPL-2.0"),
        ("It was made available under the terms of the Eclipse Public License 2.0", "EPL-2.0"),
        ("CC0 1.0 Universal", "CC0"),
        ("ISC", "ISC"),
        ("AGPL-3.0", "AGPL"),
        ("GNU General Public License version 2", "GPL"),
        ("Licensed under the Apache License, Version 1.1", "Apache-1.1"),
        ("This is free and unencumbered software released into the public domain.", "Unlicense"),
        ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED", "unknown"),
        ("Proprietary and confidential. Unauthorized copying of this file is prohibited", "unknown"),
    ],
)
def test_rivals_are_told_apart(spark, text, family):
    [row] = scan(spark.createDataFrame([(1, f"Intro.\n\n{text}\n\nend")], "doc_id long, text string")).collect()
    assert [x.split(":")[1] for x in row.found] == [family]
    assert row.confirmed in ("", family if family != "unknown" else "")


def plainly(model, line):
    """The scores of a line by the model's weights, one by one: (families held best, its probability, its share)."""
    w = _words(line)
    grams = {g for g in (*_grams(w), *([_whole(w)] if len(w) <= 8 else [])) if g in set(model.grams)}
    at = [model.grams.index(g) for g in sorted(grams)]
    p = 1 / (1 + np.exp(-(model.weights[at].sum(0) / np.sqrt(max(1, len(at))) + model.bias)))
    share = [max([len(grams & g) / size for f, g, size in model.templates if f == family], default=0.0) for family in model.families]
    rivals = {(f, g) for f, a, size in model.templates for g, b, _ in model.templates if f != g and len(a & b) >= 0.6 * size}
    left = [i for i, f in enumerate(model.families) if not any(share[j] > share[i] and (f, g) in rivals for j, g in enumerate(model.families))]
    best = max(left, key=lambda i: (p[i], -i))
    return model.families[best], float(p[best]), share[best]


def test_every_line_against_plain_scores(spark):
    """All lines of the small table, each a text of its own so that no window is over it, with the notices among them."""
    lines = sorted({s for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect() for s in (r.text or "").split("\n")})
    lines += [t for ts in TEMPLATES.values() for t in ts] + ["", " ", "MIT", "Distributed under Apache 2.0."]
    model = default_model()
    got = {r.doc_id: r.found for r in scan(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")).collect()}
    told = 0
    for i, line in enumerate(lines):
        if not _words(line):
            assert got[i] == []
            continue
        family, p, share = plainly(model, line)
        marked = re.search("|".join(MARKERS), line.lower()) is not None
        if abs(p - model.unknown) < 1e-6:
            continue
        want = family if p >= model.unknown else "unknown" if marked else None
        assert [x.split(":")[1] for x in got[i]] == ([want] if want else []), line[:80]
        if want:
            told += 1
            assert abs(float(got[i][0].split(":")[2]) - p) < 1e-3
    assert told > 30


def test_a_very_long_text_and_ties(spark):
    text = "\n".join(["It was made of this and that, and so on.", "and more of it here", ""] * 4000) + "\nReleased under the MIT License."
    got = {r.doc_id: r for r in scan(spark.createDataFrame([(1, text), (2, text), (2, text), (3, "word " * 50000 + "MIT License")], "doc_id long, text string")).collect()}
    assert got[1].confirmed == got[2].confirmed == "MIT" and got[1].found == got[2].found and 3 in got
