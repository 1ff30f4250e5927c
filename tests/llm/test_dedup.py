"""Suffix dedup and the Jaccard join against brute force."""

import collections
import hashlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from coldhaul.llm import graph, neardup, suffixes
from tests.llm.conftest import prose, rows


def removal(texts, length):
    count = collections.Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if count[t[i:i + length]] > 1:
                gone[i:i + length] = True
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.fixture(scope="module")
def repeating():
    rng = np.random.default_rng(8)
    passage, other = prose(rng, 90), prose(rng, 60)
    given = [(i, prose(rng, 30) + " " + passage[i % 50:] + " é" + prose(rng, 20)) for i in range(60)]
    given += [(100 + i, other[:250 + i] + prose(rng, 40) + other[-220:]) for i in range(10)]
    given += [(200, "ab" * 400), (201, "x" * 199), (202, "x" * 200), (203, "x" * 201), (204, None), (205, ""), (206, "\0" * 450),
              (207, "né" * 300), (208, passage + passage), (209, prose(rng, 3000))]
    given += [(210, given[5][1]), (5, given[5][1]), (5, given[5][1]), (None, prose(rng, 100)), (211, given[-1][1]), (212, "\0\0a" * 150)]
    return given


@pytest.mark.parametrize("hot", [suffixes.HOT, 5, 1])
def test_removal_equals_brute_force(spark, documents, repeating, hot):
    want = [(i, *r) for (i, _), r in zip(repeating, removal([(t or "").encode() for _, t in repeating], 200))]
    found = suffixes.removal_digests(documents(repeating).repartition(3), hot=hot)
    assert rows(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(want, key=repr)
    assert suffixes.removal_digests(documents([])).count() == 0


def test_near_copies_meet_in_cells_not_window_by_window(spark, documents, monkeypatch):
    """A group of near copies gives a few rows per passage, and the windows of those cells only that an edit touches in part."""
    rng = np.random.default_rng(23)
    base = prose(rng, 70, 9000)[:380]
    places = rng.integers(0, len(base), 240).tolist()
    given = [(i, base[:p] + "#" + base[p + 1:]) for i, p in enumerate(places)]
    want = [(i, *r) for (i, _), r in zip(given, removal([t.encode() for _, t in given], 200))]
    seen = {}

    def cells(rows):
        seen["windows"] = rows.agg(F.sum(F.size("hashes"))).first()[0]
        seen["cells"] = rows.count()
        distinct = rows.groupBy("key", "hashes").count()
        several = distinct.groupBy("key").count().filter("count > 1").select("key")
        seen["compared"] = distinct.join(several, "key").agg(F.sum(F.size("hashes"))).first()[0]
        return whole(rows)

    whole = suffixes._kept_windows
    monkeypatch.setattr(suffixes, "_kept_windows", cells)
    found = suffixes.removal_digests(documents(given).repartition(3), hot=5)
    assert rows(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(want, key=repr)
    assert seen["windows"] > 10_000
    assert seen["cells"] < seen["windows"] / 4 and seen["compared"] < seen["windows"] / 3


def test_equal_windows_lie_in_cells_of_one_key():
    rng = np.random.default_rng(29)
    texts = [t.encode() for t in (prose(rng, 200, 9000), "ab" * 400, "x" * 500, "né" * 300)]
    texts += [b"?" * 5 + texts[0][40:] + b"!", texts[0][3:300]]
    keys = collections.defaultdict(set)
    owner, anchor, first, last = suffixes._anchors_of(texts, 200)
    for o, a, f, e in zip(owner.tolist(), anchor.tolist(), first.tolist(), last.tolist()):
        passage = texts[o][f:e + 200]
        cells = suffixes._cells_of(passage, e - f + 1, a, 200)
        assert sum(len(h) for _, _, h in cells) == e - f + 1 and cells[0][1] == 0
        for key, at, hashes in cells:
            for i in range(len(hashes)):
                keys[passage[at + i:at + i + 200]].add(key)
    assert len(keys) > 300 and all(len(k) == 1 for k in keys.values())


def test_texts_without_repeats(spark, documents, repeating):
    docs = documents(repeating)
    out = suffixes.without_repeats(docs)
    assert out.columns == docs.columns
    found = out.collect()
    want = {i: r for (i, _), r in zip(repeating, removal([(t or "").encode() for _, t in repeating], 200))}
    assert len(found) == len(repeating)
    for r in found:
        n, gone, _, _ = want[r.doc_id]
        assert r.n_chars == (None if r.text is None else len(r.text))
        assert n - gone - 8 <= len((r.text or "").encode()) <= n - gone


def test_shards_merge_into_one_order():
    rng = np.random.default_rng(9)
    texts = [bytes(rng.integers(0, 3, 700, dtype=np.uint8)) + b"abc" * 200 for _ in range(5)]
    merged = suffixes.Suffixes.of(texts[0], 200)
    for t in texts[1:]:
        merged = merged.merged(suffixes.Suffixes.of(t, 200))
    prefixes = [bytes(merged.text[p:p + 200]) for p in merged.order]
    assert prefixes == sorted(prefixes) and len(prefixes) == sum(map(len, texts))
    assert merged.same.tolist() == [a == b for a, b in zip(prefixes, prefixes[1:])]


@pytest.mark.parametrize("shard", [300, 5000])
def test_repeated_starts_in_small_shards(monkeypatch, shard):
    monkeypatch.setattr(suffixes, "SHARD", shard)
    rng = np.random.default_rng(10)
    common = bytes(rng.integers(97, 100, 400, dtype=np.uint8))
    passages = [(p, len(p) - 199) for p in (common[a:a + 260] for a in range(0, 140, 20))]
    passages += [(bytes(rng.integers(97, 123, 300, dtype=np.uint8)), 101)]
    for weights in ([1] * len(passages), [1, 2] * (len(passages) // 2)):
        count = collections.Counter()
        for (p, s), n in zip(passages, weights):
            count.update({p[i:i + 200]: n for i in range(s)})
        want = [[count[p[i:i + 200]] > 1 for i in range(s)] for p, s in passages]
        assert [x.tolist() for x in suffixes.repeated_starts(passages, weights, 200)] == want


def test_a_boilerplate_in_a_third_of_all_texts_meets_once(spark, documents):
    """Its passages differ in the text around it; folded and trimmed, few of them reach the task of the anchor."""
    rng = np.random.default_rng(19)
    shared = prose(rng, 70, 9000)[:290]
    given = [(i, f"{prose(rng, 60, 9000)} {shared} {prose(rng, 60, 9000)}" if i % 3 == 0 else prose(rng, 120, 9000)) for i in range(600)]
    want = [(i, *r) for (i, _), r in zip(given, removal([t.encode() for _, t in given], 200))]
    docs = documents(given).repartition(6)
    assert rows(suffixes.removal_digests(docs, hot=50), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(want, key=repr)
    texts = suffixes.keyed(docs)
    anchors = texts.select("_id", "_hash", "bytes").mapInPandas(
        suffixes._find_anchors(200), "_id long, _hash long, anchor long, places long")
    hot = anchors.groupBy("anchor").count().filter("count > 50").select("anchor")
    runs = anchors.join(hot, "anchor").groupBy("_id", "_hash").agg(F.collect_set(F.struct("anchor", "places")).alias("runs"))
    whole = texts.join(runs, ["_id", "_hash"]).toPandas().assign(weight=1)
    passages = pd.concat(suffixes._cut_marked(200)(iter([whole])))
    assert passages["mark"].nunique() > 0.9 * len(passages) > 180
    # the windows that occur twice lie inside of the shared passage, or a few letters beyond that some texts have in common
    hashes = [suffixes._window_hashes(p, s, 200).tolist() for p, s in zip(passages["passage"], passages["starts"])]
    count = collections.Counter(h for of in hashes for h in of)
    kept = passages.assign(kept=[[i for i, h in enumerate(of) if count[h] > 1] for of in hashes])
    trimmed = pd.concat(suffixes._trim(200)(iter([kept[kept["kept"].map(len) > 0]])))
    assert len(trimmed) >= 200 and trimmed.groupby("anchor")["part"].nunique().max() < 0.5 * passages.groupby("anchor")["mark"].nunique().max()


def jaccard(given, words=5, threshold=0.8):
    sets = []
    for _, text in given:
        w = (text or "").encode().split()
        sets.append({tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1))} if w else set())
    links, root = collections.Counter(), list(range(len(given)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and len(a & sets[j]) >= threshold * len(a | sets[j]) - 1e-9:
                links[i] += 1
                links[j] += 1
                root[max(find(i), find(j))] = min(find(i), find(j))
    ids = collections.defaultdict(list)
    for i in range(len(given)):
        ids[find(i)].append(given[i][0])
    name = {r: min((x for x in of if x is not None), default=None) for r, of in ids.items()}
    return [(given[i][0], given[i][0] if not sets[i] else name[find(i)], links[i]) for i in range(len(given))]


@pytest.fixture(scope="module")
def near():
    rng = np.random.default_rng(12)
    base, given = [prose(rng, 120, 5000) for _ in range(8)], []
    for i in range(160):
        words = base[i % 8].split()
        for _ in range(int(rng.integers(0, 4))):
            words[int(rng.integers(0, 120))] = "new" + str(i)
        given.append((i, " ".join(words)))
    given += [(200 + i, prose(rng, 80, 5000)) for i in range(30)]
    given += [(300, "one two"), (301, "one  two"), (302, "one two three"), (303, ""), (304, None), (305, " \n"), (306, "one two"),
              (3, given[3][1]), (3, given[3][1]), (None, given[4][1]), (None, "all alone here with no other text"), (307, base[0] * 40)]
    return given


@pytest.mark.parametrize("weight", [400_000, 900])
def test_classes_and_links_equal_brute_force(spark, documents, near, monkeypatch, weight):
    monkeypatch.setattr(neardup, "BLOCK_WEIGHT", weight)
    found = neardup.near_duplicates(documents(near).repartition(3))
    assert rows(found, "doc_id", "class_id", "n_links") == sorted(jaccard(near), key=repr)
    if weight > 1000:
        assert neardup.near_duplicates(documents([])).count() == 0


def test_a_chain_of_candidates_makes_no_quadratic_work(spark, documents, monkeypatch):
    """Neighbours share bands but miss the threshold; a text goes to the blocks of its neighbours, not to all of its group's."""
    monkeypatch.setattr(neardup, "BLOCK_WEIGHT", 2000)
    rng = np.random.default_rng(23)
    words = [f"c{int(x)}" for x in rng.permutation(12 * 600 + 200)]
    given = [(i, " ".join(words[12 * i:12 * i + 104])) for i in range(600)]
    given += [(1000 + i, given[40 * i][1] + " end") for i in range(15)]
    want = jaccard(given)
    docs = documents(given).repartition(3)
    texts = neardup._keyed(neardup.signatures(docs)).groupBy("text_md5").agg(
        F.min("_id").alias("_id"), F.count("*").alias("copies"), F.first("n_grams").alias("n_grams"), F.first("bands").alias("bands"))
    groups = neardup.candidate_groups(texts.select("text_md5", "bands"))
    members = neardup.block_members(texts, groups).cache()
    blocks = members.groupBy("group").agg(F.max("blocks").alias("blocks"), F.count("*").alias("n")).collect()
    every = sum(r.n * r.blocks for r in blocks if r.blocks > 1)
    sent = neardup.meeting_blocks(members).agg(F.sum(F.size("others"))).first()[0]
    assert max(r.blocks for r in blocks) > 30
    assert sent < 8 * sum(r.n for r in blocks if r.blocks > 1) < every
    assert rows(neardup.near_duplicates(docs), "doc_id", "class_id", "n_links") == sorted(want, key=repr)
    assert sum(links > 0 for _, _, links in want) == 30


def test_pairs_at_exactly_the_threshold_are_linked(spark, documents):
    rng = np.random.default_rng(16)
    given = []
    for i, m in enumerate((3, 6, 11, 12, 100)):
        words = [f"m{m}w{int(x)}" for x in rng.permutation(5 * m + 4)]
        # 4m of 5m n-grams, and one less
        given += [(10 * i, " ".join(words)), (10 * i + 1, " ".join(words[:4 * m + 4])), (10 * i + 2, " ".join(words[m + 1:]))]
    want = jaccard(given)
    assert all(links for _, _, links in want[1::3])
    assert rows(neardup.near_duplicates(documents(given)), "doc_id", "class_id", "n_links") == sorted(want, key=repr)


def test_one_of_each_class_stays(spark, documents, near):
    kept = neardup.first_of_each(documents(near))
    want = {(i, c) for i, c, _ in jaccard(near)}
    blank = [i for i, t in near if not (t or "").split()]
    assert kept.columns == documents([]).columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted(
        [*{c for i, c in want if i not in blank}, *blank], key=repr)


def test_many_rare_grams_are_counted_alike():
    rng = np.random.default_rng(13)
    sets = [np.unique(np.concatenate((rng.integers(0, 60, 30, dtype=np.uint64), rng.integers(100, 4000, 40, dtype=np.uint64))))
            for _ in range(100)]
    want = [[len(set(a) & set(b)) for b in map(np.ndarray.tolist, sets)] for a in map(np.ndarray.tolist, sets)]
    got = neardup._common(sets)
    np.fill_diagonal(got, 0)
    np.fill_diagonal(want := np.array(want), 0)
    assert (got == want).all()


def test_bands_reach_the_recall():
    bands, rows_ = neardup.choose_bands()
    assert 1 - (1 - 0.8 ** rows_) ** bands >= neardup.RECALL and bands * rows_ <= neardup.MOST_HASHES


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(200, 200), (301, 300), (302, 301), (300, 302)]
    found = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 300: 300, 301: 300, 302: 300}
