"""Suffix-array dedup: byte strings of a fixed length that start more than once are cut out everywhere.

Every window of ``length`` bytes has an anchor: the least hashed ``GRAM``-byte string in it. Equal windows have equal
anchors, so only passages around anchors that occur more than once are looked at, and passages meet by anchor. A task holds each
distinct passage once, with how often it occurs, deals the passages into shards and orders the suffixes of each shard up to ``length``
bytes, which with the text is the shard's Burrows-Wheeler transform. The shards are merged: the interleave of two suffix orders is
refined from blocks of equal 8-byte prefixes to 16, 32 and so on by looking up the blocks of the suffixes that start
where the known prefix ends. Suffixes are never sorted again; blocks of the last round share prefixes of ``length``
bytes, and those that hold two or more starts, copies counted, are the repeated intervals.

The passages of an anchor that is very frequent differ in the text around it, and would all meet in one task. They are
folded before: equal ones to one, and the others are trimmed to the windows whose hash occurs twice, which mostly makes them equal.
Windows are counted in cells of a few neighbours, and one by one only where cells differ in part.
What is left meets by anchor and is decided by the same merge, and the verdicts go back to the owners by joins of numbers.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldhaul.llm.shingles import chunks, mixed
from coldhaul.session import cut, cut_at
from coldhaul.sources.files import remove

LENGTH = 200
GRAM = 32
#: Bytes of passages in a shard, and in the shards that are merged at once.
SHARD = 1 << 18
POOL = 1 << 20
#: Passages that a task gathers at once, copies counted, and those of one anchor beyond which they are folded first.
ROWS = 100_000
HOT = 4096
#: Windows around a frequent anchor that are compared as one first.
CELL = 8
NO_ID = -(2**63)
_FACTORS = np.random.default_rng(5).integers(0, 2**64, 4, dtype=np.uint64) | np.uint64(1)
_WINDOW_FACTORS = np.random.default_rng(6).integers(0, 2**64, 64, dtype=np.uint64) | np.uint64(1)


def _anchors_of(texts: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """(text number, anchor, first, last) of each run of window starts in a text that have the same anchor."""
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    data = np.frombuffer(b"".join(texts) + bytes(8), dtype=np.uint8)
    n = len(data) - 8
    width = length - GRAM + 1
    if n < length:
        return (np.zeros(0, np.int64),) * 4
    words = np.lib.stride_tricks.as_strided(data, (n + 1, 8), (1, 1)).copy().view("<u8").ravel()
    grams = n - GRAM + 1
    hashes = words[:grams] * _FACTORS[0]
    for k in range(1, GRAM // 8):
        hashes += words[8 * k:8 * k + grams] * _FACTORS[k]
    hashes = mixed(hashes)
    places = np.uint64((1 << max(20, n.bit_length())) - 1)
    least = (hashes & ~places) | np.arange(grams, dtype=np.uint64)
    covered = 1
    while covered * 2 <= width:
        least = np.minimum(least[:-covered], least[covered:])
        covered *= 2
    if covered < width:
        least = np.minimum(least[:covered - width], least[width - covered:])
    first = np.cumsum(sizes) - sizes
    long = sizes >= length
    counts = sizes[long] - length + 1
    if not counts.sum():
        return (np.zeros(0, np.int64),) * 4
    starts = np.repeat(first[long] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    owner = np.repeat(np.flatnonzero(long), counts)
    chosen = (least[starts] & places).astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], chosen[1:] != chosen[:-1])))
    end = np.concatenate((new[1:], [len(starts)])) - 1
    return owner[new], hashes[chosen[new]].view(np.int64), starts[new] - first[owner[new]], starts[end] - first[owner[new]]


def _find_anchors(length: int):
    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, ids, hashes = batch["bytes"].tolist(), batch["_id"].to_numpy(), batch["_hash"].to_numpy()
            for begin, end in chunks(texts):
                owner, anchor, first, last = _anchors_of(texts[begin:end], length)
                if len(owner):
                    yield pd.DataFrame({"_id": ids[begin + owner], "_hash": hashes[begin + owner], "anchor": anchor,
                                        "places": first << 32 | last})

    return of


def _places(run) -> tuple[int, int]:
    """The first and the last window of a run, which travel in one number."""
    return run["places"] >> 32, run["places"] & 0xFFFFFFFF


def _cut_passages(length: int):
    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, hashed, text, runs in zip(batch["_id"], batch["_hash"], batch["bytes"], batch["runs"]):
                out += [(r["anchor"], key, hashed, first, last - first + 1, text[first:last + length])
                        for r in runs for first, last in [_places(r)]]
            yield pd.DataFrame(out, columns=["anchor", "_id", "_hash", "first", "starts", "passage"])

    return of


def _mark(passage: bytes, starts: int) -> bytes:
    return hashlib.blake2b(passage, digest_size=16, salt=starts.to_bytes(8, "little")).digest()


def _cut_marked(length: int):
    """One row per distinct passage of a text and anchor: its places, a mark of its bytes, and its weight."""
    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: dict[tuple, list] = {}
            for key, hashed, text, runs, weight in zip(*[batch[c] for c in ("_id", "_hash", "bytes", "runs", "weight")]):
                for r in runs:
                    first, last = _places(r)
                    passage, starts = text[first:last + length], last - first + 1
                    row = out.setdefault((r["anchor"], _mark(passage, starts), key, hashed), [[], starts, passage, 0])
                    row[0].append(first)
                    row[3] += weight
            yield pd.DataFrame([(*k, *v) for k, v in out.items()], columns=[
                "anchor", "mark", "_id", "_hash", "firsts", "starts", "passage", "weight"])

    return of


def _window_hashes(passage: bytes, starts: int, length: int) -> np.ndarray:
    """A hash of each of the first ``starts`` windows of a passage: a random linear form of its 8-byte words, mixed."""
    words = np.lib.stride_tricks.as_strided(np.frombuffer(passage, dtype=np.uint8), (len(passage) - 7, 8), (1, 1)).copy().view(
        "<u8").ravel()
    hashes = np.zeros(starts, dtype=np.uint64)
    for k, at in enumerate([*range(0, length - 8, 8), length - 8]):
        hashes += mixed(words[at:at + starts] + np.uint64(k)) * _WINDOW_FACTORS[k % 64]
    return mixed(hashes).view(np.int64)


def _anchor_place(passage: bytes, starts: int, anchor: int) -> int:
    """Where the anchor of a passage stands: all its windows hold it, and the first of equal ones is theirs."""
    last = len(passage) - starts + 1 - GRAM
    words = np.lib.stride_tricks.as_strided(np.frombuffer(passage, dtype=np.uint8), (len(passage) - 7, 8), (1, 1)).copy().view(
        "<u8").ravel()
    grams = last - starts + 2
    hashes = words[starts - 1:starts - 1 + grams] * _FACTORS[0]
    for k in range(1, GRAM // 8):
        hashes += words[starts - 1 + 8 * k:starts - 1 + 8 * k + grams] * _FACTORS[k]
    return starts - 1 + int(np.flatnonzero(mixed(hashes).view(np.int64) == anchor)[0])


def _cells_of(passage: bytes, starts: int, anchor: int, length: int) -> list[tuple[int, int, np.ndarray]]:
    """(key, first window, window hashes) of each cell: the windows that begin as many ``CELL`` bytes before the anchor.

    The key is a hash of the bytes that all windows of a whole cell share, so equal windows lie in cells of one key.
    """
    place = _anchor_place(passage, starts, anchor)
    hashes = _window_hashes(passage, starts, length)
    shared = length - CELL + 1
    keys = _window_hashes(passage, len(passage) - shared + 1, shared)
    cells = (place - np.arange(starts)) // CELL
    edges = [0, *(np.flatnonzero(np.diff(cells)) + 1).tolist(), starts]
    return [(int(keys[place - int(cells[b]) * CELL]), b, hashes[b:e]) for b, e in zip(edges, edges[1:])]


def _hash_cells(length: int):
    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(number, weight, key, at, hashes)
                    for number, weight, anchor, passage, starts in zip(*[batch[c].tolist() for c in (
                        "number", "weight", "anchor", "passage", "starts")])
                    for key, at, hashes in _cells_of(passage, starts, anchor, length)]
            yield pd.DataFrame(rows, columns=["number", "weight", "key", "at", "hashes"])

    return of


def _trim(length: int):
    """Passages cut to the runs of the windows that are kept."""
    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for anchor, mark, passage, weight, kept in zip(*[batch[c] for c in ("anchor", "mark", "passage", "weight", "kept")]):
                kept = np.sort(np.asarray(kept))
                for run in np.split(kept, np.flatnonzero(np.diff(kept) > 1) + 1):
                    part, starts = passage[run[0]:run[-1] + length], len(run)
                    out.append((anchor, mark, int(run[0]), _mark(part, starts), starts, part, weight))
            yield pd.DataFrame(out, columns=["anchor", "mark", "shift", "part", "starts", "passage", "weight"])

    return of


def _levels(length: int) -> list[tuple[int, int]]:
    """(prefix known, step to the suffix looked up) from 8 bytes to ``length``."""
    out, known = [], 8
    while known < length:
        step = min(known, length - known)
        out.append((known, step))
        known += step
    return out


def _words(text: np.ndarray) -> np.ndarray:
    """The 8 bytes at every place, in an order like that of the bytes; the text ends in at least 8 bytes of padding."""
    n = len(text) - 8
    return np.lib.stride_tricks.as_strided(text, (n, 8), (1, 1)).copy().view(">u8").ravel().astype(np.uint64)


class Suffixes:
    """A shard: its text, and the places of its suffixes in the order of their first ``length`` bytes.

    ``same`` tells for each suffix in order but the first whether it shares ``length`` bytes with the one before: they are one
    block of the last round. Shards end in ``length`` bytes of padding, whose suffixes stand in no order and count as the least block.
    """

    def __init__(self, text: np.ndarray, order: np.ndarray, length: int, same: np.ndarray):
        self.text, self.order, self.length, self.same = text, order, length, same

    def _blocks(self, rank: np.ndarray, step: int) -> np.ndarray:
        """Keys of twice the prefix: a suffix's block, then the block of the suffix ``step`` bytes on."""
        n = len(self.text)
        block = np.zeros(n + step, dtype=np.int64)
        block[self.order] = rank
        return (block[:n] << np.int64(32)) | block[step:]

    @classmethod
    def of(cls, text: bytes, length: int) -> Suffixes:
        data = np.concatenate((np.frombuffer(text, dtype=np.uint8), np.zeros(length, np.uint8)))
        key = np.concatenate((_words(data), np.zeros(8, np.uint64)))
        shard = cls(data, np.argsort(key[:len(text)], kind="stable"), length, np.zeros(0, bool))
        for _, step in _levels(length):
            ordered = key[shard.order]
            new = np.concatenate(([True], ordered[1:] != ordered[:-1]))
            key = shard._blocks(np.cumsum(new), step)
            # only blocks of two or more suffixes are still to be ordered
            size = np.diff(np.concatenate((np.flatnonzero(new), [len(text)])))
            shared = np.repeat(size > 1, size)
            inside = shard.order[shared]
            shard.order[shared] = inside[np.argsort(key[inside], kind="stable")]
        ordered = key[shard.order]
        shard.same = ordered[1:] == ordered[:-1]
        return shard

    def merged(self, other: Suffixes) -> Suffixes:
        """Both shards in one order. The interleave starts from 8-byte blocks and is refined level by level."""
        keys = [np.concatenate((_words(s.text), np.zeros(8, np.uint64))) for s in (self, other)]
        for _, step in [*_levels(self.length), (self.length, 0)]:
            mine, theirs = keys[0][self.order], keys[1][other.order]
            at_mine = np.arange(len(mine)) + np.searchsorted(theirs, mine, side="left")
            at_theirs = np.arange(len(theirs)) + np.searchsorted(mine, theirs, side="right")
            interleaved = np.empty(len(mine) + len(theirs), dtype=mine.dtype)
            interleaved[at_mine], interleaved[at_theirs] = mine, theirs
            same = interleaved[1:] == interleaved[:-1]
            if step:
                rank = np.cumsum(np.concatenate(([True], ~same)))
                keys = [self._blocks(rank[at_mine], step), other._blocks(rank[at_theirs], step)]
        order = np.empty(len(self.order) + len(other.order), dtype=np.int64)
        order[at_mine], order[at_theirs] = self.order, other.order + len(self.text)
        return Suffixes(np.concatenate((self.text, other.text)), order, self.length, same)


def repeated_starts(passages: list[tuple[bytes, int]], weights: list[int], length: int) -> list[np.ndarray]:
    """For each (passage, starts): which of its first ``starts`` windows of ``length`` bytes start elsewhere too.

    ``weights``: how often each passage occurs, 2 for more.
    """
    shards, held, size, first, at = [], [], 0, [], 0
    for passage, _ in passages:
        if size and size + len(passage) > SHARD:
            shards.append(Suffixes.of(b"".join(held), length))
            held, size, at = [], 0, at + length
        first.append(at)
        held.append(passage)
        size += len(passage)
        at += len(passage)
    shards.append(Suffixes.of(b"".join(held), length))
    while len(shards) > 1:
        pairs = [shards[i:i + 2] for i in range(0, len(shards), 2)]
        shards = [p[0].merged(p[1]) if len(p) > 1 else p[0] for p in pairs]
    merged = shards[0]
    first, starts = np.array(first), np.array([s for _, s in passages])
    counts = np.zeros(len(merged.text) + 1, dtype=np.int64)
    np.add.at(counts, first, weights)
    np.add.at(counts, first + starts, -np.array(weights))
    times = np.cumsum(counts)[:-1]
    # suffixes that are no window starts only guide the order; the others keep it among themselves
    real = times[merged.order] > 0
    interval = np.cumsum(np.concatenate(([True], ~merged.same)))[real]
    often = np.bincount(interval, weights=times[merged.order[real]], minlength=1)[interval] > 1
    twice = np.zeros(len(merged.text), dtype=bool)
    twice[merged.order[real]] = often
    return [twice[f:f + s] for f, s in zip(first.tolist(), starts.tolist())]


def _intervals(anchors: list[int], passages: list[tuple[bytes, int]], weights: list[int], length: int) -> list[list[tuple[int, int]]]:
    """The [begin, end) ranges of repeated bytes in each distinct passage; passages of an anchor stand together.

    Windows are equal only if their anchors are. Where all passages of an anchor are copies of one, there is nothing to order: its
    windows occur as often as it does.
    """
    of = Counter(anchors)
    out: list = [[(0, s - 1 + length)] if of[a] == 1 and w > 1 else [] for a, (_, s), w in zip(anchors, passages, weights)]
    several = [i for i, a in enumerate(anchors) if of[a] > 1]
    if several:
        found = repeated_starts([passages[i] for i in several], [weights[i] for i in several], length)
        for i, twice in zip(several, found):
            edges = np.flatnonzero(np.diff(np.concatenate(([False], twice, [False])).astype(np.int8)))
            out[i] = [(b, e - 1 + length) for b, e in zip(edges[0::2].tolist(), edges[1::2].tolist())]
    return out


class _Pool:
    """Passages of whole anchors. A distinct passage is held once, with its owners."""

    def __init__(self, length: int):
        self.length, self.size, self.rows = length, 0, 0
        self.owners: dict[tuple[int, bytes, int], list[tuple]] = {}

    def add(self, anchor: int, key: int, hashed: int, first: int, starts: int, passage: bytes) -> None:
        owners = self.owners.setdefault((anchor, passage, starts), [])
        self.size += 0 if owners else len(passage)
        self.rows += 1
        owners.append((key, hashed, first))

    def close(self) -> list[tuple]:
        """(id, hash, begin, end) of what repeats."""
        found = _intervals([p[0] for p in self.owners], [p[1:] for p in self.owners],
                           [min(2, len(of)) for of in self.owners.values()], self.length)
        return [(key, hashed, first + b, first + e)
                for of, spans in zip(self.owners.values(), found) for b, e in spans for key, hashed, first in of]


def _find_weighted(length: int):
    """Rows come sorted by anchor: distinct passages, each with its weight."""
    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def closed() -> pd.DataFrame:
            found = _intervals([h[0] for h in held], [(h[2], h[3]) for h in held], [h[4] for h in held], length)
            return pd.DataFrame([(h[0], h[1], b, e) for h, spans in zip(held, found) for b, e in spans],
                                columns=["anchor", "part", "begin", "end"])

        held, size = [], 0
        for batch in batches:
            for row in zip(*[batch[c] for c in ("anchor", "part", "passage", "starts", "weight")]):
                if size >= POOL and row[0] != held[-1][0]:
                    yield closed()
                    held, size = [], 0
                held.append(row)
                size += len(row[2])
        if held:
            yield closed()

    return of


def _find_repeats(length: int):
    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by anchor. Passages of whole anchors are gathered up to ``POOL`` bytes or ``ROWS`` rows."""
        pool, last = _Pool(length), None
        for batch in batches:
            out = []
            for row in zip(*[batch[c] for c in ("anchor", "_id", "_hash", "first", "starts", "passage")]):
                if (pool.size >= POOL or pool.rows >= ROWS) and row[0] != last:
                    out += pool.close()
                    pool = _Pool(length)
                last = row[0]
                pool.add(*row)
            if out:
                yield pd.DataFrame(out, columns=["_id", "_hash", "begin", "end"])
        if out := pool.close():
            yield pd.DataFrame(out, columns=["_id", "_hash", "begin", "end"])

    return of


def keyed(docs: DataFrame, *columns: str) -> DataFrame:
    """Rows are told apart by id and text: ``_id`` is the id or a mark for null, ``_hash`` a hash of the text."""
    return docs.select(*[F.col(c).alias(f"_of_{c}") for c in columns], F.coalesce("doc_id", F.lit(NO_ID)).alias("_id"),
                       F.xxhash64(F.coalesce("text", F.lit(""))).alias("_hash"), F.col("text").cast("binary").alias("bytes"))


def with_spans(texts: DataFrame, length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """Add ``spans`` to ``keyed`` texts: the [begin, end) ranges of the repeated bytes, maybe overlapping, or null.

    Both joins with the texts read all their columns, so that the texts are shuffled once for both.
    """
    spark = texts.sparkSession
    anchors, at_anchors = cut_at(texts.filter(F.octet_length("bytes") >= length).select("_id", "_hash", "bytes").mapInPandas(
        _find_anchors(length), "_id long, _hash long, anchor long, places long"), "anchors")
    # written, so that the join below reads plain shuffles and the one of a hot anchor can be split
    twice, at_twice = cut_at(anchors.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select(
        "anchor", (F.col("n") > hot).alias("hot")), "twice")
    # equal rows have one set of runs, but each brings its passages, so they repeat each other
    runs = cut(anchors.join(twice, "anchor").groupBy("_id", "_hash", "hot")
               .agg(F.collect_set(F.struct("anchor", "places")).alias("runs")), "runs")
    for path in (at_anchors, at_twice):
        remove(spark, path)
    passages = texts.join(runs.filter("NOT hot").drop("hot"), ["_id", "_hash"]).mapInPandas(
        _cut_passages(length), "anchor long, _id long, _hash long, first int, starts int, passage binary")
    found = passages.repartition("anchor").sortWithinPartitions("anchor").mapInPandas(
        _find_repeats(length), "_id long, _hash long, begin int, end int")
    spans = found.groupBy("_id", "_hash").agg(F.collect_set(F.struct("begin", "end")).alias("spans"))
    if not runs.filter("hot").isEmpty():
        # written, as all later steps read these texts alone
        around = cut(texts.select("_id", "_hash", "bytes").join(
            runs.filter("hot").drop("hot").hint("merge"), ["_id", "_hash"]), "hot-texts")
        spans = spans.unionByName(_hot_spans(around, length)).groupBy("_id", "_hash").agg(
            F.flatten(F.collect_list("spans")).alias("spans"))
    return texts.join(spans, ["_id", "_hash"], "left")


def _hot_spans(texts: DataFrame, length: int) -> DataFrame:
    """(_id, _hash, spans) of what repeats around very frequent anchors; ``texts`` have the ``runs`` of those.

    Of equal texts one stands for all. Passages move once per distinct one and task, as equal ones combine before the shuffle,
    and a window with a hash of its own repeats nowhere. The trimmed passages of an anchor, distinct ones only, meet in a task.
    """
    weight = F.least(F.sum("weight"), F.lit(2)).cast("int").alias("weight")
    ids = cut(texts.select("_id", "_hash", F.sha2("bytes", 256).alias("text")), "hot-ids")
    leads = ids.groupBy("text").agg(F.min(F.struct("_id", "_hash")).alias("lead"), F.least(F.count("*"), F.lit(2)).alias("weight"))
    alone = texts.join(leads.select("lead._id", "lead._hash", "weight"), ["_id", "_hash"])
    cut_out = alone.mapInPandas(_cut_marked(length), "anchor long, mark binary, _id long, _hash long, firsts array<int>, starts int, "
                                "passage binary, weight int")
    distinct = cut(cut_out.groupBy("anchor", "mark").agg(
        F.first("passage").alias("passage"), F.first("starts").alias("starts"), weight).withColumn(
        "number", F.monotonically_increasing_id()), "hot-passages")
    cells = distinct.mapInPandas(_hash_cells(length), "number long, weight int, key long, at int, hashes array<long>")
    kept = cells.join(_kept_windows(cells.select("key", "hashes", "weight")), ["key", "hashes"]).select("number", F.expr(
        "transform(filter(sequence(0, size(hashes) - 1), i -> array_contains(kept, hashes[i])), i -> at + i)").alias("kept")).groupBy(
        "number").agg(F.flatten(F.collect_list("kept")).alias("kept"))
    trimmed = cut(distinct.join(kept, "number").mapInPandas(
        _trim(length), "anchor long, mark binary, shift int, part binary, starts int, passage binary, weight int"), "hot-trimmed")
    folded = trimmed.groupBy("anchor", "part").agg(
        F.first("passage").alias("passage"), F.first("starts").alias("starts"), weight)
    repeated = folded.repartition("anchor").sortWithinPartitions("anchor").mapInPandas(
        _find_weighted(length), "anchor long, part binary, begin int, end int")
    inside = trimmed.select("anchor", "mark", "shift", "part").join(repeated, ["anchor", "part"]).groupBy("anchor", "mark").agg(
        F.collect_list(F.struct((F.col("shift") + F.col("begin")).alias("begin"), (F.col("shift") + F.col("end")).alias("end"))).alias("in"))
    owners = cut_out.select("anchor", "mark", "_id", "_hash", "firsts")
    moved = F.flatten(F.transform("firsts", lambda f: F.transform("in", lambda x: F.struct(
        (f + x["begin"]).alias("begin"), (f + x["end"]).alias("end")))))
    found = owners.join(inside, ["anchor", "mark"]).groupBy("_id", "_hash").agg(F.flatten(F.collect_list(moved)).alias("spans"))
    members = ids.distinct().join(leads, "text").select("_id", "_hash", F.struct(F.col("lead._id"), F.col("lead._hash")).alias("lead"))
    return members.join(found.select(F.struct("_id", "_hash").alias("lead"), "spans"), "lead").select("_id", "_hash", "spans")


def _kept_windows(cells: DataFrame) -> DataFrame:
    """(key, hashes, kept): of each distinct cell the window hashes that occur twice; cells without any are left out.

    Equal cells combine before the shuffle, and all windows of one that occurs twice repeat. Only cells that differ from another
    of their key, as those that an edit of a near copy touches in part, are compared window by window.
    """
    weight = F.least(F.sum("weight"), F.lit(2)).cast("int").alias("weight")
    distinct = cells.groupBy("key", "hashes").agg(weight)
    alike = distinct.groupBy("key").agg(F.count("*").alias("contents"), F.sum("weight").alias("n")).filter("n > 1").drop("n")
    distinct = cut(distinct.join(alike, "key"), "hot-cells")
    windows = distinct.filter("contents > 1").select("key", "hashes", "weight", F.explode("hashes").alias("h"))
    often = windows.groupBy("key", "h").agg(F.sum("weight").alias("n")).filter("n > 1").drop("n")
    single = windows.filter("weight = 1").join(often, ["key", "h"]).groupBy("key", "hashes").agg(F.collect_set("h").alias("kept"))
    return distinct.filter("weight > 1").select("key", "hashes", F.col("hashes").alias("kept")).unionByName(single)


def _merged_spans(spans) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for begin, end in sorted((s["begin"], s["end"]) for s in (spans if spans is not None else ())):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def _kept(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    edges = [0, *[x for s in spans for x in s], len(text)]
    return b"".join(text[edges[i]:edges[i + 1]] for i in range(0, len(edges), 2))


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for text, spans in zip(batch["bytes"], batch["spans"]):
            text, merged = text or b"", _merged_spans(spans)
            out.append((len(text), sum(e - b for b, e in merged), len(merged),
                        hashlib.sha256(_kept(text, merged)).hexdigest()))
        frame = pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"])
        frame.insert(0, "doc_id", batch["_id"].astype("Int64").mask(batch["_id"] == NO_ID))
        yield frame


def removal_digests(docs: DataFrame, length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    A byte goes if a string of ``length`` bytes that covers it starts anywhere else, in this text or another; strings are
    judged on the input. A null text counts as empty; shorter texts keep all. Equal rows are documents of their
    own, so each repeats the other. A text of any length is read whole, in some 60 bytes of memory per byte, and so far one text is
    one task's. An empty table gives no rows; other columns are ignored.
    """
    return with_spans(keyed(docs), length, hot).mapInPandas(
        _digests, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def _cut_texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Texts without their spans. A character of which a byte goes, goes whole, so that texts stay well formed."""
    for batch in batches:
        texts = []
        for text, spans in zip(batch["bytes"], batch["spans"]):
            whole = []
            for begin, end in _merged_spans(spans):
                while begin > 0 and text[begin] & 0xC0 == 0x80:
                    begin -= 1
                while end < len(text) and text[end] & 0xC0 == 0x80:
                    end += 1
                whole.append((begin, end))
            merged = _merged_spans([{"begin": b, "end": e} for b, e in whole])
            texts.append(_kept(text, merged).decode("utf-8", "replace"))
        yield batch.drop(columns=["_id", "_hash", "bytes", "spans"]).assign(_kept=texts)


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The documents with repeated bytes cut out of their texts; ``n_chars`` follows. Other texts stay as they are."""
    rest = [c for c in docs.columns if c != "text"]
    marked = with_spans(keyed(docs, *rest), length)
    back = [F.col(f"_of_{c}").alias(c) for c in rest]
    same = marked.filter("spans IS NULL").select(*back, F.col("bytes").cast("string").alias("text"))
    schema = ", ".join(f"`_of_{c}` {docs.schema[c].dataType.simpleString()}" for c in rest) + ", _kept string"
    changed = marked.filter("spans IS NOT NULL").mapInPandas(_cut_texts, schema).select(*back, F.col("_kept").alias("text"))
    changed = changed.withColumn("n_chars", F.length("text").cast("long"))
    return same.select(*docs.columns).unionByName(changed.select(*docs.columns))
