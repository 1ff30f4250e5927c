"""Licence scans by a trained paragraph classifier (DataFrame functions only on the data).

A paragraph is a run of lines up to a blank one; its lines are judged alone and joined. A logistic regression over words and word pairs, trained on variations of the templates
below and on a bounded sample of other paragraphs, gives a probability to each licence family and to ``none``. Held-out
paragraphs calibrate the probability from which a family is accepted; the best template of the family must also be
found in the paragraph to a large part. What is neither none nor confirmed is ``unknown``. The model is small and becomes
literals of one projection, so texts are scanned where they lie and nothing is shuffled.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coldhaul.llm.common import WORD, bound

NONE, UNKNOWN = "none", "unknown"
# Notices of licence families, as their licences ask to state them.
TEMPLATES = {
    "AGPL": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "Licensed under the GNU AGPL version 3.",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "BSD": [
        "Released under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
        "SPDX-License-Identifier: BSD-2-Clause",
        "SPDX-License-Identifier: BSD-3-Clause",
        "BSD 2-Clause License", "BSD 3-Clause License",
    ],
    "CC-BY": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
    ],
    "CC-BY-NC": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
    ],
    "CC-BY-SA": [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
    ],
    "CC0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "Released into the public domain under CC0 1.0 Universal.",
        "SPDX-License-Identifier: CC0-1.0",
    ],
    "EPL": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
        "Licensed under the Eclipse Public License, version 2.0.",
        "SPDX-License-Identifier: EPL-2.0",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "Licensed under the GNU GPL version 2.",
        "SPDX-License-Identifier: GPL-2.0-only",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "ISC": [
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
        "SPDX-License-Identifier: ISC",
    ],
    "LGPL": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "Licensed under the GNU LGPL version 3.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction",
        "Licensed under the MIT License.",
        "SPDX-License-Identifier: MIT",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Released under the Unlicense.",
        "SPDX-License-Identifier: Unlicense",
    ],
    "proprietary": [
        "All rights reserved.",
        "This document is confidential and proprietary; no part may be reproduced without prior written permission.",
    ],
}
# Sentences that speak of licences or rights and grant none.
OTHERS = [
    "You need a driving licence to rent a car.", "The pub lost its license last year.", "He asked for permission to leave the room.",
    "Human rights are not granted by the state.", "The library opens at nine.", "The software was released in version 3.",
    "Public schools are free of charge.", "The general public may visit the garden.", "Copyright law differs by country.",
    "The warranty ends after two years.", "Common people in creative work need rights.", "She reserved all the seats.",
    "Turn right at the next corner.", "A licensed engineer must sign the plan.", "The terms of the contract are secret.",
]
#: Lines with any of these are not learned from as lines without a notice, as they may be notices.
CUES = ("licen", "redistribut", "copyright", "public domain", "permission", "rights reserved")
SAMPLE_DOCS = 300
SAMPLE_LINES = 40
SEED = 11
ACCEPT = 0.6
#: Part of the template's word pairs that a confirmed paragraph holds.
CONFIRM = 0.6
TERM = "[^a-z0-9.-]+"


class Model(NamedTuple):
    classes: list[str]
    weights: dict[str, list[float]]
    intercept: list[float]
    accept: float


def _terms(text: str) -> list[str]:
    words = [w.strip(".-") for w in re.split(TERM, text.lower())]
    words = [w for w in words if w]
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def _variations(rng, template: str, filler: list[str]) -> list[str]:
    """The notice alone, among other words, and cut at either end."""
    words = template.split()
    out = [template, template.upper(), f"Copyright (c) 2021 {rng.choice(filler)}. {template}"]
    for _ in range(12):
        before = " ".join(rng.choice(filler, rng.integers(0, 12)))
        after = " ".join(rng.choice(filler, rng.integers(0, 12)))
        drop = int(rng.integers(0, 1 + len(words) // 5))
        part = words[drop:] if rng.random() < 0.5 else words[:len(words) - drop]
        out.append(f"{before} {' '.join(part)} {after}")
    return out


def _fit(x: np.ndarray, y: np.ndarray, n: int, steps: int = 400, rate: float = 1.0, penalty: float = 1e-4):
    weights, intercept = np.zeros((x.shape[1], n)), np.zeros(n)
    target = np.eye(n)[y]
    balance = (1 / np.bincount(y, minlength=n).clip(1))[y][:, None] / n
    for _ in range(steps):
        error = (_softmax(x @ weights + intercept) - target) * balance
        weights -= rate * (x.T @ error * 10 + penalty * weights)
        intercept -= rate * error.sum(axis=0) * 10
    return weights, intercept


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_lines: int = SAMPLE_LINES, seed: int = SEED) -> Model:
    """Train on variations of the templates against ``OTHERS`` and the lines of about ``sample_docs`` documents.

    At most ``sample_lines`` lines of a document are taken, those of the least hashes; lines with a cue are left
    out, as they may be notices. Terms are those of the templates that are rare among the other lines. Every fourth
    paragraph is held out; a family is accepted from the greatest probability that one of those without a notice gets.
    """
    n = docs.select("doc_id").count()
    near = F.pmod(F.xxhash64(F.lit("licences"), "doc_id"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, sample_docs / max(n, 1)))
    lines = F.transform(F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD)),
                        lambda x: F.struct(F.xxhash64(x).alias("h"), F.substring(x, 1, 400).alias("line")))
    picked = docs.filter(near).select(F.explode(F.slice(F.array_sort(lines), 1, sample_lines)).alias("x")).select("x.line")
    other = sorted({r["line"] for r in picked.collect()})
    rng = np.random.default_rng(seed)
    filler = sorted({w for line in [*other[:500], *OTHERS] for w in line.split()})
    other = [x for x in other if not any(c in x.lower() for c in CUES)] + OTHERS * 5
    classes = [NONE, *TEMPLATES]
    rows = [(x, 0) for x in other]
    for family, templates in TEMPLATES.items():
        rows += [(v, classes.index(family)) for t in templates for v in _variations(rng, t, filler)]
    often = np.ceil(len(other) / 200)
    seen: dict[str, int] = {}
    for text in other:
        for term in set(_terms(text)):
            seen[term] = seen.get(term, 0) + 1
    vocabulary = sorted({t for ts in TEMPLATES.values() for x in ts for t in _terms(x) if seen.get(t, 0) <= often})
    place = {t: i for i, t in enumerate(vocabulary)}
    x = np.zeros((len(rows), len(vocabulary)))
    for i, (text, _) in enumerate(rows):
        x[i, [place[t] for t in set(_terms(text)) if t in place]] = 1
    y = np.array([r[1] for r in rows])
    held = rng.random(len(rows)) < 0.25
    weights, intercept = _fit(x[~held], y[~held], len(classes))
    probabilities = _softmax(x[held] @ weights + intercept)
    wrong = probabilities[y[held] == 0, 1:].max(axis=1, initial=0)
    accept = float(min(0.9, max(ACCEPT, wrong.max(initial=0))))
    return Model(classes, {t: weights[i].round(6).tolist() for t, i in place.items()}, intercept.round(6).tolist(), accept)


def _columns(model: Model):
    """The classifier of a text as an expression: for each paragraph its notices, greatest score, and any unsure joined lines."""
    pairs = {f: [sorted(set(_terms(t)[(len(_terms(t)) + 1) // 2:])) for t in ts] for f, ts in TEMPLATES.items()}
    longest = max(len(t.split()) for of in TEMPLATES.values() for t in of) + 1
    zero = [0.0] * len(model.classes)
    weights = {p: zero for of in pairs.values() for ps in of for p in ps} | model.weights
    vocabulary = sorted(weights)
    listed = F.array(*[F.lit(t) for t in vocabulary])
    table = F.create_map(*[x for t in vocabulary for x in (F.lit(t), F.array(*[F.lit(float(w)) for w in weights[t]]))])
    names = F.array(*[F.lit(c) for c in model.classes])
    start = F.array(*[F.lit(float(b)) for b in model.intercept])
    compared = F.create_map(*[x for f, of in pairs.items() for x in (
        F.lit(f), F.array(*[F.array(*[F.lit(p) for p in sorted(ps)]) for ps in of]))])

    def words(line: Column) -> Column:
        return F.filter(F.transform(F.split(F.lower(line), TERM), lambda w: F.btrim(w, F.lit(".-"))), lambda w: w != "")

    def terms(w: Column) -> Column:
        return F.concat(w, F.filter(F.transform(w, lambda x, i: F.concat_ws(" ", x, F.get(w, i + 1))), lambda x: x.contains(" ")))

    def decide(found: Column) -> Column:
        scores = F.aggregate(found, start, lambda total, t: F.zip_with(total, F.element_at(table, t), lambda a, b: a + b))

        def best(z: Column) -> Column:
            top = F.array_max(z)
            total = F.aggregate(z, F.lit(0.0), lambda s, v: s + F.exp(v - top))
            at = F.array_position(z, top).cast("int")
            none = F.exp(F.element_at(z, 1) - top) / total
            return F.struct(F.element_at(names, at).alias("family"), (1 / total).alias("score"), none.alias("none"))

        def confirmed(b: Column) -> Column:
            # part of the word pairs of the nearest template
            part = F.array_max(F.transform(F.element_at(compared, b["family"]), lambda ps: F.size(
                F.array_intersect(found, ps)) / F.size(ps)))
            sure = (b["score"] >= model.accept) & (F.coalesce(part, F.lit(0.0)) >= CONFIRM)
            family = F.when(b["none"] >= 0.5, F.lit(NONE)).when(sure, b["family"]).otherwise(F.lit(UNKNOWN))
            return F.struct(family.alias("family"), (1 - b["none"]).alias("score"), F.when(
                ~family.isin(NONE, UNKNOWN), part).otherwise(F.lit(0.0)).alias("part"), F.lit(0).alias("more"))

        return bound(bound(scores, best), confirmed)

    def run(lines: Column, i: Column, j: Column) -> Column:
        return F.flatten(F.slice(lines, i + 1, j - i + 1))

    def reach(lines: Column, i: Column) -> Column:
        """The place of the line by which, after line ``i``, as many words have come as the longest template has."""
        return F.aggregate(F.slice(lines, i + 2, longest), F.struct(F.lit(longest).alias("left"), i.alias("at")), lambda s, w: F.struct(
            (s["left"] - F.size(w)).alias("left"), (s["at"] + (s["left"] > 0).cast("int")).alias("at")))["at"]

    def end(lines: Column, i: Column, family: Column, wrapped: Column, nearest: Column) -> Column:
        """The place of the last line of the templates that only the joined lines hold; that of the line if there are none."""
        def part(w: Column, ps: Column) -> Column:
            return F.size(F.array_intersect(bound(w, terms), ps)) / F.size(ps)

        def last(ps: Column) -> Column:
            def of(whole: Column) -> Column:
                alone = part(F.get(lines, i), ps)
                reached = F.filter(F.sequence(i, reach(lines, i)), lambda j: part(run(lines, i, j), ps) >= whole)
                return F.when((whole >= CONFIRM) & ((alone < CONFIRM) | wrapped & (whole >= nearest)), F.array_min(reached)).otherwise(i)

            return bound(part(run(lines, i, reach(lines, i)), ps), of)

        return F.coalesce(F.array_max(F.transform(F.element_at(compared, family), last)), i)

    def paragraph(lines: Column, h: Column, none: Column) -> Column:
        """Lines in order, each with its own verdict and that of the notice wrapped from it on, ``none`` if there is none."""
        def verdict(w: Column) -> Column:
            return bound(F.array_intersect(bound(w, terms), h), lambda found: F.when(
                F.size(found) > 0, bound(found, decide)).otherwise(none))

        def nearest(found: Column) -> Column:
            """Of the runs from a line on the one nearest to its template, of equals the shortest; the greatest score of any."""
            top = F.array_max(F.transform(found, lambda x, k: F.struct(x["part"].alias("part"), (-k).alias("k"), x["family"].alias("family"))))
            family = F.when(top["part"] > 0, top["family"]).when(F.exists(found, lambda x: x["family"] == UNKNOWN), F.lit(UNKNOWN))
            return F.struct(F.coalesce(family, F.lit(NONE)).alias("family"), F.array_max(F.transform(
                found, lambda x: x["score"])).alias("score"), top["part"].alias("part"), (1 - top["k"]).alias("more"))

        def both(w: Column, i: Column) -> Column:
            # a notice can't start in a line that has no term of the model, not even with the next word
            starts = F.arrays_overlap(bound(F.slice(F.flatten(F.slice(lines, i + 1, 2)), 1, F.size(w) + 1), terms), h)
            return F.struct(verdict(w).alias("line"), F.when((i + 1 < F.size(lines)) & starts, bound(F.transform(F.sequence(
                i + 1, reach(lines, i)), lambda j: verdict(run(lines, i, j))), nearest)).otherwise(none).alias("wrapped"))

        return F.transform(lines, both)

    def notices(lines: Column, of: Column, none: Column) -> Column:
        """The verdicts of a paragraph's notices and other lines in order.

        Of a line alone and the lines joined from it on, the one nearer to its template counts. A joined notice starts at the last
        line from which on it is as near, and takes in the fragments of it in the lines it covers.
        """
        def part(x: Column, family: Column) -> Column:
            return F.greatest(*[F.when(x[k]["family"] == family, x[k]["part"]).otherwise(F.lit(0.0)) for k in ("line", "wrapped")])

        def chosen(x: Column, i: Column) -> Column:
            better = x["wrapped"]["part"] > x["line"]["part"]
            later = F.exists(F.slice(of, i + 2, x["wrapped"]["more"]), lambda y: part(y, x["wrapped"]["family"]) >= x["wrapped"]["part"])
            wrapped = better & ~later
            it = F.when(wrapped, x["wrapped"]).otherwise(x["line"])
            return F.struct(it.alias("it"), i.alias("at"), F.when(
                it["family"].isin(NONE, UNKNOWN), i).otherwise(end(lines, i, it["family"], wrapped, it["part"])).alias("to"))

        def fold(state: Column, x: Column) -> Column:
            it = x["it"]
            inside = (x["at"] <= state["to"]) & ((it["family"] == UNKNOWN) | (it["family"] == state["family"]) & (
                it["part"] < state["part"]))
            notice = ~it["family"].isin(NONE, UNKNOWN)
            opens = notice & ~inside & (x["to"] > x["at"])
            return F.struct(
                F.when(inside, state["out"]).otherwise(F.concat(state["out"], F.array(it))).alias("out"),
                F.when(opens, x["to"]).otherwise(state["to"]).alias("to"),
                F.when(opens, it["family"]).otherwise(state["family"]).alias("family"),
                F.when(opens, it["part"]).otherwise(state["part"]).alias("part"))

        first = F.struct(F.filter(F.array(none), lambda x: F.lit(False)).alias("out"), F.lit(-1).alias("to"), F.lit(NONE).alias("family"), F.lit(0.0).alias("part"))
        said = F.filter(F.transform(of, chosen), lambda x: x["it"]["family"] != NONE)
        return F.aggregate(said, first, fold)["out"]

    def classify(paragraphs: Column) -> Column:
        # the terms of the model that the text has at all are looked up once; others have no weight anywhere
        held = F.array_intersect(F.flatten(F.transform(paragraphs, lambda ls: bound(F.flatten(ls), terms))), listed)
        plain = decide(F.array().cast("array<string>"))

        def of(none: Column, h: Column) -> Column:
            judged = F.transform(paragraphs, lambda ls: bound(paragraph(ls, h, none), lambda vs: F.struct(
                notices(ls, vs, none).alias("found"),
                F.array_max(F.transform(vs, lambda v: F.greatest(v["line"]["score"], v["wrapped"]["score"]))).alias("score"),
                F.exists(vs, lambda v: v["wrapped"]["family"] == UNKNOWN).alias("unsure"))))
            return F.when(F.size(h) > 0, judged).otherwise(F.transform(F.slice(paragraphs, 1, 1), lambda ls: F.struct(
                F.filter(F.array(none), lambda x: F.lit(False)).alias("found"), none["score"].alias("score"), F.lit(False).alias("unsure"))))

        return bound(plain, lambda none: bound(held, lambda h: of(none, h)))

    def split(text: Column) -> Column:
        worded = F.transform(F.split(text, "\\n[^\\S\\n]*\\n"), lambda p: F.filter(
            F.transform(F.split(p, "\n"), words), lambda w: F.size(w) > 0))
        return F.filter(worded, lambda ls: F.size(ls) > 0)

    return lambda text: bound(split(text), classify)


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, licence, families, n_notices, n_unknown, score.

    A paragraph is a run of lines up to a blank one. Every line with a word is scored, and so is each with the lines
    after it, as notices are wrapped. ``families`` are the families of its confirmed notices, sorted; ``licence`` is the
    family of the first notice, ``unknown`` if there are only such, else ``none``; ``n_unknown`` counts the unconfirmed
    lines outside of notices, or is 1 if only lines joined read as a notice; ``score`` is the greatest probability of a notice that
    any line, alone or joined, gets, 0 without words. A null or empty text has none. Repeated rows are
    scanned each. An empty table gives no rows; other columns are ignored.
    """
    judged = docs.select("doc_id", _columns(model)(F.coalesce(F.col("text"), F.lit(""))).alias("judged"))
    found = judged.select("doc_id", F.flatten(F.transform("judged", lambda x: x["found"])).alias("found"), F.exists(
        "judged", lambda x: x["unsure"]).alias("unsure"), F.coalesce(F.array_max(F.transform(
            "judged", lambda x: x["score"])), F.lit(0.0)).alias("score"))
    notices = F.filter("found", lambda x: x["family"] != UNKNOWN)
    return found.select("doc_id", notices.alias("notices"), F.when((F.size("found") == 0) & F.col("unsure"), F.lit(1)).otherwise(
        F.size("found") - F.size(notices)).cast("long").alias("n_unknown"), "score").select(
        "doc_id", F.when(F.size("notices") > 0, F.element_at("notices", 1)["family"]).when(
            F.col("n_unknown") > 0, F.lit(UNKNOWN)).otherwise(F.lit(NONE)).alias("licence"),
        F.sort_array(F.array_distinct(F.transform("notices", lambda x: x["family"]))).alias("families"),
        F.size("notices").cast("long").alias("n_notices"), "n_unknown", "score")
