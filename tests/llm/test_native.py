"""Mixing, sharding, quality rules and licence scans."""

import collections
import re
import textwrap
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from coldhaul.llm import licenses, mixing, quality, sharding
from tests.llm.conftest import prose, rows

ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "a b c a b c"), (4, "a b c a b c"), (None, "x y"), (5, "é" * 3000 + " ü " * 4000),
       (6, "line\nline\nline"), (7, "nbsp stays one word")]


def test_sharding_is_stable_and_gapless(spark, documents):
    docs = documents([*ODD, *[(i, f"t{i}") for i in range(100, 1100)]])
    found = sharding.shard_documents(docs, buckets=8).collect()
    assert len(found) == 1009
    by = collections.defaultdict(list)
    for r in found:
        by[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 16)
    assert set(by) == set(range(16)) and all(sorted(s) == list(range(len(s))) for s in by.values())
    assert any(r.grown_shard == 16 for r in found)
    assert {(r.size, r.text_crc32) for r in found if r.doc_id == 1} == {(1, 0)}
    assert {(r.size, r.text_crc32) for r in found if r.doc_id == 100} == {(5, zlib.crc32(b"t100"))}
    again = {r.doc_id: r.shard for r in sharding.shard_documents(docs.repartition(3), buckets=2).collect()}
    assert all(again[r.doc_id] == r.shard for r in found)
    assert sharding.shard_documents(documents([])).count() == 0


@pytest.mark.parametrize("shards,laid_out", [(1, None), (5, None), (12, None), (18, 16), (40, None)])
def test_one_more_shard_takes_rows_only_into_itself(spark, documents, shards, laid_out):
    docs = documents([(i, f"t{i}") for i in range(3000)])
    found = sharding.shard_documents(docs, shards, laid_out).collect()
    assert {r.shard for r in found} == set(range(shards))
    assert {r.grown_shard for r in found if r.grown_shard != r.shard} == {shards}
    share = sum(r.grown_shard == shards for r in found) / 3000
    assert abs(share - 1 / (shards + 1)) < 0.05
    grown = {r.doc_id: r.shard for r in sharding.shard_documents(docs, shards + 1, laid_out or shards).collect()}
    assert all(grown[r.doc_id] == r.grown_shard for r in found)


def test_a_heavier_subtree_takes_rows_only_into_itself(spark):
    ids = spark.range(4000)
    before = [sharding.Leaf("a", "a1", 0), sharding.Leaf("a", "a2", 1), sharding.Leaf("b", "b1", 2), sharding.Leaf("b", "b1", 3, 2.0)]
    after = [*before[:3], sharding.Leaf("b", "b1", 3, 4.0)]
    moved = ids.select(sharding.descend(F.col("id"), before).alias("x"), sharding.descend(F.col("id"), after).alias("y"))
    found = [tuple(r) for r in moved.collect()]
    share = collections.Counter(x for x, _ in found)
    assert abs(share[3] / 4000 - 0.4) < 0.04
    assert all(y in (2, 3) for x, y in found if x != y)


def _targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, total, open_ = {}, 1.5 * sum(sizes.values()), set(sizes)
    while True:
        level = {s: total * weights[s] / sum(weights[x] for x in open_) for s in open_}
        over = [s for s in open_ if level[s] > 2 * sizes[s]]
        if not over:
            return target | level
        for s in over:
            target[s] = 2.0 * sizes[s]
            total -= target[s]
            open_.remove(s)


@pytest.mark.parametrize("block", [7, 1024])
def test_mixing_meets_targets(spark, documents, block):
    rng = np.random.default_rng(3)
    given = [(i, prose(rng, int(rng.integers(0, 90))), "en", s) for i, s in enumerate(
        ["hot"] * 300 + ["b"] * 20 + ["c"] * 40 + [None] * 15 + ["tiny"])]
    given += [(900, None, "en", "b"), (901, "", "en", "none at all"), (None, "a b c", "en", "b"), (5, given[5][1], "en", "hot")]
    found = mixing.mix(documents(given), buckets=4, block=block).collect()
    assert len(found) == len(given)
    sizes = collections.Counter()
    for _, text, _, source in given:
        sizes[source] += len((text or "").split())
    want = _targets(sizes)
    source_of = {i: s for i, _, _, s in given}
    taken = collections.Counter()
    for r in found:
        s = source_of[r.doc_id]
        assert r.source_size == sizes[s] and r.taken <= 2 * r.size and abs(r.target - want[s]) < 1e-6
        taken[s] += r.taken
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)
    assert rows(mixing.mix(documents(given).repartition(5), buckets=4, block=block), "doc_id", "taken") == sorted(
        ((r.doc_id, r.taken) for r in found), key=repr)
    mixed = mixing.mixed_documents(documents(given), buckets=4, block=block)
    got = collections.Counter()
    for r in mixed.collect():
        got[r.source] += len(r.text.split())
    assert mixed.columns == documents([]).columns and got == {s: n for s, n in taken.items() if n}
    assert mixing.mix(documents([])).count() == 0


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _counts(text):
    text = text or ""
    words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    covered = {i + d for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for d in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_quality_counts(spark, documents):
    rng = np.random.default_rng(1)
    given = ODD + [(10, prose(rng, 200, 6)), (11, "the " * 300), (12, prose(rng, 5000, 2000)), (13, "a#b $ | <c>\n\na#b $ | <c>\n"),
                   (14, "Der Hund und die Katze. " * 3 + " ".join(f"Das Wort{i} und die Sache{i}" for i in range(40)))]
    found = quality.judge(documents(given)).collect()
    assert sorted(map(repr, ((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in found))) == \
        sorted(map(repr, ((i, *_counts(t)) for i, t in given)))
    for r in found:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and (r.base_failed or r.failed_rules))
    assert {r.doc_id: r.kept for r in found}[14]
    assert quality.judge(documents([])).count() == 0


def test_licences(spark, documents):
    rng = np.random.default_rng(2)
    plain = [(i, "\n".join(prose(rng, 30) for _ in range(5))) for i in range(60)]
    notices = [(100 + i, f"{prose(rng, 20)}\n{prose(rng, 3)} {t}\n{prose(rng, 20)}") for i, t in enumerate(
        t for ts in licenses.TEMPLATES.values() for t in ts)]
    families = [f for f, ts in licenses.TEMPLATES.items() for _ in ts]
    others = [(200 + i, x) for i, x in enumerate(licenses.OTHERS)] + [(300, "Licensed under the Foobar Charter, edition 9.")]
    docs = documents([*plain, *notices, *others, (400, None), (401, ""), (402, "All rights reserved.\nReleased under the MIT License.")])
    model = licenses.train(docs)
    found = {r.doc_id: r for r in licenses.scan(docs, model).collect()}
    right = sum(found[i].licence == f for (i, _), f in zip(notices, families))
    assert right >= 0.9 * len(notices)
    assert all(found[i].licence == "none" for i, _ in plain) and found[400].licence == found[401].licence == "none"
    assert all(not found[i].families for i, _ in others)
    assert found[402].families == ["MIT", "proprietary"] and found[402].licence == "proprietary"
    empty = documents([])
    assert licenses.scan(empty, licenses.train(empty)).count() == 0


def test_near_families_and_other_notices(spark, documents):
    """What stands beside the templates: relatives, headers by name, wordings and licences the model does not know."""
    rng = np.random.default_rng(6)
    plain = [(i, "\n".join(prose(rng, 30) for _ in range(5))) for i in range(60)]
    said = [("AGPL", "You can redistribute it under the terms of the GNU Affero General Public License as published by the Free Software "
             "Foundation, either version 3 of the License, or any later version."),
            ("GPL", "You can redistribute it under the terms of the GNU General Public License as published by the Free Software Foundation, "
             "either version 2 of the License, or any later version."),
            ("ISC", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, "
             "provided that the above copyright notice and this permission notice appear in all copies."),
            ("MIT", "// SPDX-License-Identifier: MIT"), ("Unlicense", "# This is free and unencumbered software released into the public domain."),
            ("EPL", "The materials are made available under the terms of the Eclipse Public License 2.0 which is available at"), ("BSD", "BSD 3-Clause License")]
    docs = documents([*plain, *[(100 + i, f"{prose(rng, 20)}\n{t}\n{prose(rng, 20)}") for i, (_, t) in enumerate(said)],
                      (200, "Licensed under the Foobar Public Charter, version 2.0."), (201, "SPDX-License-Identifier: Zlib"),
                      (202, "\n".join(f"licensed {i}" for i in range(500)) + "\nReleased under the MIT License."),
                      (203, "Released under the MIT License."), (203, "Released under the MIT License.")])
    found = [r for r in licenses.scan(docs, licenses.train(docs)).collect()]
    by = {r.doc_id: r for r in found}
    wrong = [(f, t, by[100 + i]) for i, (f, t) in enumerate(said) if by[100 + i].licence != f]
    assert not wrong
    # a licence without a template is confirmed as none that has one
    assert by[200].families == by[201].families == []
    # lines on end that hold a word of a notice hide none, and repeated rows are scanned each
    assert by[202].families == ["MIT"] and [r.licence for r in found if r.doc_id == 203] == ["MIT", "MIT"]
    assert all(by[i].licence == "none" for i, _ in plain)


def test_licences_without_usual_words(spark, documents):
    rng = np.random.default_rng(4)
    plain = [(i, "\n".join(prose(rng, 30) for _ in range(5))) for i in range(60)]
    docs = documents([*plain, (100, f"{prose(rng, 20)}\nDistributed under the GNU GPL version 2.\n{prose(rng, 20)}")])
    found = {r.doc_id: r for r in licenses.scan(docs, licenses.train(docs)).collect()}
    assert found[100].licence == "GPL" and found[100].n_notices == 1
    assert all(found[i].licence == "none" and 0 < found[i].score < 0.5 for i, _ in plain)


def test_wrapped_licences(spark, documents):
    rng = np.random.default_rng(5)
    plain = [(i, "\n".join(prose(rng, 30) for _ in range(5))) for i in range(60)]
    long = [(f, t) for f, ts in licenses.TEMPLATES.items() for t in ts if len(t) > 100]
    wrapped = [(100 + i, f"{prose(rng, 20)}\n\n# " + "\n# ".join(textwrap.wrap(t, w)) + f"\n{end}{prose(rng, 20)}")
               for i, (_, t, w, end) in enumerate((f, t, w, end) for f, t in long for w in (40, 60, 72) for end in ("", "\n"))]
    families = [f for f, _ in long for _ in range(6)]
    both = "Licensed under the\nMIT License.\nAll rights reserved.\n\nLicensed under the Apache License,\nVersion 2.0."
    docs = documents([*plain, *wrapped, (300, both), (301, both.replace("\n", "\r\n"))])
    # a line with a word of a notice, and one without, come before it
    docs = docs.unionByName(documents([(302, "w1 rights w2\nw3\nAll rights reserved.")]))
    found = {r.doc_id: r for r in licenses.scan(docs, licenses.train(docs)).collect()}
    wrong = [(f, t, found[i]) for (i, t), f in zip(wrapped, families) if (found[i].families, found[i].n_notices) != ([f], 1)]
    assert not wrong
    assert all(found[i].licence == "none" for i, _ in plain)
    for i in (300, 301):
        assert found[i].licence == "MIT" and found[i].n_notices == 3
        assert found[i].families == ["Apache-2.0", "MIT", "proprietary"]
    assert found[302].families == ["proprietary"] and found[302].n_notices == 1
