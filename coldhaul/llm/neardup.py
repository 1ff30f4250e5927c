"""N-gram Jaccard join by MinHash banding.

Equal texts form a class, and one of each class goes on. Its signature is cut into bands; classes that share a band's
hash are linked to the least of them, and the links' components are the candidate groups. A group is split into
blocks of bounded weight. Two blocks of a group meet in a task, each with those texts only that share a band with one
of the other, and there the full n-gram sets decide: a chain of candidates costs rows in proportion to its links, not to
the square of its blocks. A task returns counts and the local components, never pairs, so a group of copies costs rows
in proportion to its members.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldhaul.llm import shingles
from coldhaul.llm.graph import components
from coldhaul.session import cut

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.9995
MOST_HASHES = 256
#: Weight of a block: its documents' n-grams, each document counting as ``LEAST_WEIGHT`` at least.
BLOCK_WEIGHT = 400_000
LEAST_WEIGHT = 200
#: An n-gram of at most so many documents of a task is counted pair by pair, others by a matrix product.
RARE = 16
COLUMNS = 4096
NO_ID = -(2**63)


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, most: int = MOST_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows, so the fewest false candidates, that find pairs at the threshold with the recall."""
    best = (most, 1)
    for rows in range(1, most + 1):
        hit = threshold ** rows
        if hit * most < 1:
            break
        bands = max(1, int(np.ceil(np.log(1 - recall) / np.log1p(-hit)))) if hit < 1 else 1
        if bands * rows <= most:
            best = (bands, rows)
    return best


def _signatures(sets: list[np.ndarray], factors: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    out = np.full((len(sets), len(factors)), 0xFFFFFFFF, dtype=np.uint32)
    for i, grams in enumerate(sets):
        high = (grams >> np.uint64(32)).astype(np.uint32)
        for at in range(0, len(high), 2048):
            part = high[at:at + 2048, None] * factors
            part += offsets
            np.minimum(out[i], part.min(axis=0), out=out[i])
    return out


def _band_hashes(words: int, bands: int, rows: int):
    rng = np.random.default_rng(7)
    factors = rng.integers(0, 2**32, bands * rows, dtype=np.uint32) | np.uint32(1)
    offsets = rng.integers(0, 2**32, bands * rows, dtype=np.uint32)
    steps = rng.integers(0, 2**64, rows, dtype=np.uint64) | np.uint64(1)
    which = rng.integers(0, 2**64, bands, dtype=np.uint64)

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [(t or "").encode("utf-8", "surrogatepass") for t in batch["text"]]
            sizes, found = [], []
            for begin, end in shingles.chunks(texts):
                sets = shingles.shingle_hashes(texts[begin:end], words)
                sizes += [len(s) for s in sets]
                signature = _signatures(sets, factors, offsets).reshape(len(sets), bands, rows).astype(np.uint64)
                hashes = shingles.mixed((signature * steps).sum(axis=2, dtype=np.uint64) + which)
                found += list(hashes.view(np.int64))
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "text_md5": batch["text_md5"],
                                "n_grams": np.array(sizes, dtype=np.int64), "bands": found})

    return of


def signatures(docs: DataFrame, words: int = WORDS, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """(doc_id, text_md5, n_grams, bands) of each document; bands are the hashes of the signature's bands."""
    bands, rows = choose_bands(threshold, recall)
    return docs.select("doc_id", "text", F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("text_md5")).mapInPandas(
        _band_hashes(words, bands, rows), "doc_id long, text_md5 binary, n_grams long, bands array<long>")


def candidate_groups(texts: DataFrame) -> DataFrame:
    """(text_md5, group) of the texts that share a band with another: components of links to each bucket's least text."""
    rows = texts.select("text_md5", F.explode("bands").alias("band"))
    leads = rows.groupBy("band").agg(F.min("text_md5").alias("lead"), F.count("*").alias("n")).filter("n > 1").drop("n")
    edges = rows.join(leads, "band").select(F.col("text_md5").alias("a"), F.col("lead").alias("b"))
    return components(edges).select(F.col("node").alias("text_md5"), F.col("root").alias("group"))


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """The sizes of all intersections of the sets."""
    n = len(sets)
    grams, rows = np.concatenate(sets), np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(grams, kind="stable")
    grams, rows = grams[order], rows[order]
    new = np.concatenate(([True], grams[1:] != grams[:-1]))
    column = np.cumsum(new) - 1
    counts = np.bincount(column)
    common = np.zeros((n, n), dtype=np.float32)
    rare = counts[column] <= RARE if n > 4 * RARE else np.zeros(len(rows), dtype=bool)
    r, c = rows[rare], column[rare]
    for step in range(1, RARE if rare.any() else 0):
        same = c[step:] == c[:-step]
        np.add.at(common, (r[:-step][same], r[step:][same]), 1)
    wide = ~rare & (counts[column] > 1)
    r, c = rows[wide], column[wide]
    c = np.cumsum(np.concatenate(([0], c[1:] != c[:-1]))) if len(c) else c
    common = common + common.T
    width = max(64, min(COLUMNS, 16_000_000 // n))
    for low in range(0, int(c[-1]) + 1 if len(c) else 0, width):
        begin, end = np.searchsorted(c, [low, low + width])
        block = np.zeros((n, width), dtype=np.float32)
        block[r[begin:end], c[begin:end] - low] = 1
        common += block @ block.T
    return common


def _verified(rows: list[tuple], words: int, threshold: float) -> list[tuple]:
    """(text_md5, links, root) of the texts of one task that reach the threshold with another of it.

    rows: (text_md5, text, copies, block, low block, high block). With two blocks only pairs across them count.
    """
    unique = {row[0]: row for row in rows}
    keys = sorted(unique)
    texts = [unique[k][1].encode("utf-8", "surrogatepass") for k in keys]
    sets = []
    for begin, end in shingles.chunks(texts):
        sets += [np.unique(s) for s in shingles.shingle_hashes(texts[begin:end], words)]
    sizes = np.array([len(s) for s in sets], dtype=np.float64)
    common = _common(sets)
    near = np.empty(common.shape, dtype=bool)
    # in float64: counts times the threshold are rounded too far in float32; a few rows at a time, as that is wide
    for at in range(0, len(sizes), 256):
        near[at:at + 256] = common[at:at + 256].astype(np.float64) * (1 + threshold) >= threshold * (
            sizes[at:at + 256, None] + sizes[None, :]) - 1e-6
    np.fill_diagonal(near, False)
    low, high = rows[0][4], rows[0][5]
    if low != high:
        block = np.array([unique[k][3] for k in keys])
        near &= block[:, None] != block[None, :]
    linked = np.flatnonzero(near.any(axis=1))
    if not len(linked):
        return []
    near = near[np.ix_(linked, linked)]
    copies = np.array([unique[keys[i]][2] for i in linked], dtype=np.int64)
    roots = np.arange(len(linked))
    while True:
        least = np.minimum(roots, np.where(near, roots[None, :], len(roots)).min(axis=1))
        least = least[least]
        if (least == roots).all():
            break
        roots = least
    links = near @ copies
    return [(keys[linked[i]], int(links[i]), keys[linked[roots[i]]]) for i in range(len(linked))]


def _verify(words: int, threshold: float):
    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by task; one task's rows, which have a bounded weight, are held at a time."""
        key, held, out = None, [], []
        for batch in batches:
            for group, low, high, md5, text, copies, block in zip(
                    batch["group"], batch["low"], batch["high"], batch["text_md5"], batch["text"], batch["copies"],
                    batch["block"]):
                if (group, low, high) != key:
                    if held:
                        out += _verified(held, words, threshold)
                    key, held = (group, low, high), []
                held.append((md5, text or "", copies, block, low, high))
            if out:
                yield pd.DataFrame(out, columns=["text_md5", "links", "root"])
                out = []
        if held:
            out = _verified(held, words, threshold)
            if out:
                yield pd.DataFrame(out, columns=["text_md5", "links", "root"])

    return of


def _keyed(df: DataFrame) -> DataFrame:
    return df.withColumn("_id", F.coalesce("doc_id", F.lit(NO_ID)))


def block_members(texts: DataFrame, groups: DataFrame) -> DataFrame:
    """(text_md5, group, _id, copies, blocks, block, bands) of the texts in groups; bands only where there are several blocks."""
    members = texts.join(groups, "text_md5").select("text_md5", "group", "_id", "copies", "bands", F.greatest(
        F.col("n_grams"), F.lit(LEAST_WEIGHT)).alias("weight"))
    blocks = members.groupBy("group").agg(F.ceil(F.sum("weight") / BLOCK_WEIGHT).cast("int").alias("blocks"))
    return members.join(blocks, "group").select(
        "text_md5", "group", "_id", "copies", "blocks", F.pmod(F.xxhash64("text_md5"), F.col("blocks")).cast("int").alias("block"),
        F.when(F.col("blocks") > 1, F.col("bands")).alias("bands"))


def meeting_blocks(members: DataFrame) -> DataFrame:
    """(text_md5, others): of the texts in groups of several blocks, the blocks with a text that shares a band with it.

    The blocks of a band are gathered, never its texts, so a band costs a row as long as its group has blocks.
    """
    rows = members.filter("blocks > 1").select("text_md5", "block", F.explode("bands").alias("band"))
    held = rows.groupBy("band").agg(F.sort_array(F.collect_set("block")).alias("held"), F.count("*").alias("n")).filter("n > 1").drop("n")
    return rows.join(held, "band").groupBy("text_md5").agg(
        F.array_distinct(F.flatten(F.collect_set("held"))).alias("others"))


def verified_links(docs: DataFrame, texts: DataFrame, groups: DataFrame, words: int = WORDS,
                   threshold: float = THRESHOLD) -> DataFrame:
    """(text_md5, links, root): per text and task, the documents of other texts that it reaches, and a local component."""
    members = cut(block_members(texts, groups), "members")
    placed = members.drop("bands").join(meeting_blocks(members), "text_md5", "left").withColumn(
        "others", F.when(F.col("blocks") > 1, F.coalesce("others", F.array().cast("array<int>"))).otherwise(F.array(F.lit(0))))
    read = _keyed(docs.select("doc_id", "text", F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("text_md5")))
    # one kind of join at every size: the members grow with the documents, so their texts come by shuffle in the end
    held = read.select("_id", "text_md5", "text").join(placed.hint("merge"), ["_id", "text_md5"])
    tasks = held.withColumn("other", F.explode("others")).select(
        "group", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        "text_md5", "text", "copies", "block")
    return (tasks.repartition("group", "low", "high").sortWithinPartitions("group", "low", "high")
            .mapInPandas(_verify(words, threshold), "text_md5 binary, links long, root binary"))


def near_duplicates(docs: DataFrame, words: int = WORDS, threshold: float = THRESHOLD,
                    recall: float = RECALL) -> DataFrame:
    """One row per document: doc_id, class_id, n_links, copies, n_grams, text_md5, root (the least text of the class).

    Two documents are linked if the Jaccard similarity of their sets of ``words``-word n-grams is at least ``threshold``;
    classes are the components of the links, named by their least doc_id. ``n_links`` counts the other documents that a
    document is linked to, ``copies`` the documents of its very text. A text of fewer words has one n-gram
    of all its words. A null, empty or blank text has none and is linked to nothing; it is a class of its own. Repeated
    rows and ids are documents of their own; a class in which all ids are null has a null name. An empty table
    gives no rows; other columns are ignored.

    A pair at the threshold becomes a candidate with the probability ``recall`` at least, more similar pairs
    with a higher one; each candidate is decided on the full sets, compared by 64-bit hashes.
    """
    signed = cut(signatures(docs, words, threshold, recall), "signatures")
    texts = cut(_keyed(signed).filter("n_grams > 0").groupBy("text_md5").agg(
        F.min("_id").alias("_id"), F.min("doc_id").alias("first_id"), F.count("*").alias("copies"), F.first("n_grams").alias("n_grams"),
        F.first("bands").alias("bands")), "texts")
    groups = cut(candidate_groups(texts.select("text_md5", "bands")), "groups")
    links = cut(verified_links(docs, texts, groups, words, threshold), "links")
    roots = components(links.select(F.col("text_md5").alias("a"), F.col("root").alias("b")))
    counts = links.groupBy("text_md5").agg(F.sum("links").alias("links"))
    linked = cut(texts.select("text_md5", "first_id", "copies")
                 .join(counts, "text_md5", "left")
                 .join(roots.select(F.col("node").alias("text_md5"), "root"), "text_md5", "left")
                 .select("text_md5", "first_id", "copies", F.coalesce("links", F.lit(0)).alias("links"),
                         F.coalesce("root", "text_md5").alias("root")), "linked")
    names = linked.groupBy("root").agg(F.min("first_id").alias("class_id"))
    classes = linked.join(names, "root").select(
        "text_md5", "copies", (F.col("copies") - 1 + F.col("links")).alias("n_links"), "class_id", "root")
    worded = signed.filter("n_grams > 0").select("doc_id", "n_grams", "text_md5").join(classes, "text_md5").select(
        "doc_id", "class_id", "n_links", "copies", "n_grams", "text_md5", "root")
    blank = signed.filter("n_grams = 0").select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"),
        F.lit(1).cast("long").alias("copies"), "n_grams", "text_md5", F.col("text_md5").alias("root"))
    return worded.unionByName(blank)


def first_of_each(docs: DataFrame, words: int = WORDS, threshold: float = THRESHOLD) -> DataFrame:
    """The documents with one of each class: the one whose id names it; of equal rows one. Blank texts all stay."""
    found = near_duplicates(docs, words, threshold)
    blank = ~F.coalesce("text", F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_md5")
    leads = found.filter("n_grams > 0").groupBy("root").agg(F.min(first).alias("lead")).select(
        F.coalesce("lead.doc_id", F.lit(NO_ID)).alias("_id"), F.col("lead.text_md5").alias("_md5"))
    rows = docs.filter(~blank).select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("_id"), F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("_md5"),
        *[F.col(c).alias(f"_of_{c}") for c in docs.columns])
    # equal rows meet by id and text, and one of them stays
    kept = rows.join(leads, ["_id", "_md5"]).dropDuplicates(["_id", "_md5"])
    return kept.select(*[F.col(f"_of_{c}").alias(c) for c in docs.columns]).unionByName(docs.filter(blank))
