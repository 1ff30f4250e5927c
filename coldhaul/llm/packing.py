"""Best-fit packing of token sequences with bound-certified repacking.

Documents are tokenized once; only those longer than a sequence are cut. Every partition packs its pieces by best-fit
decreasing, group by group, and dual-feasible functions give a lower bound of its sequences. A group whose count is that
bound, rounded up, is certified: its pieces can't be packed into fewer. It is final, unless the bound of all pieces together
promises fewer for its share of them, because the deal gave it too many large ones. A group with a gap
keeps its full sequences and gives up those with room; their pieces are dealt to new partitions, which pack again in larger
groups, until one group is left or an exchange has saved no sequence.
"""

from __future__ import annotations

import array
import base64
import functools
import math
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldhaul.session import cut

CAPACITY = 2048
END = 0
#: Pieces packed together in the first round, and at most, which bounds a task's memory.
GROUP = 20_000
MOST = 640_000
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Longer runs without blanks, or of blanks, go to the other library, whose time does not grow with their square.
LONG_RUN = 4000


@functools.cache
def _encoders(ranks_path: str, pattern: str, tokenizer_path: str):
    """The tokenizer twice, as ranks, which is several times faster, and as published; and the tokens that were added to it."""
    import json

    import tiktoken
    from tokenizers import Tokenizer
    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    with open(tokenizer_path, encoding="utf-8") as file:
        added = [token["content"] for token in json.load(file).get("added_tokens", [])]
    return (tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}),
            Tokenizer.from_file(tokenizer_path), added)


def _longest_run(text: str) -> int:
    words = text.split()
    longest = max(map(len, words), default=0)
    return max(longest, len(text) - sum(map(len, words)) - len(words))


def _pieces_of(ids: list[int], capacity: int) -> list[tuple[int, int, int]]:
    """(start, length, checksum) of the pieces: full ones, but the first, which takes the rest."""
    first = len(ids) % capacity or capacity
    cuts = [0, *range(first, len(ids) + 1, capacity)]
    data = array.array("I", ids)
    return [(a, b - a, zlib.crc32(data[a:b].tobytes())) for a, b in zip(cuts, cuts[1:])]


def _tokenize(paths: tuple[str, str, str], capacity: int):
    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ranked, whole, added = _encoders(*paths)
        for batch in batches:
            out = []
            for text in batch["text"]:
                text = text or ""
                # an added token is one id wherever it stands, which the ranks don't know
                if any(token in text for token in added) or len(text) > LONG_RUN and _longest_run(text) > LONG_RUN:
                    ids = whole.encode(text, add_special_tokens=False).ids
                else:
                    ids = ranked.encode_ordinary(text)
                out.append([{"start": s, "length": n, "ids_crc32": c} for s, n, c in _pieces_of([*ids, END], capacity)])
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "pieces": out})

    return of


def tokenized(docs: DataFrame, tokenizer: str | None = None, ranks: str | None = None, pattern: str | None = None,
              capacity: int = CAPACITY) -> DataFrame:
    """The pieces of each document: doc_id, piece, start, length, ids_crc32.

    ``tokenizer`` and ``ranks`` are paths of one vocabulary in the two libraries' formats, on every executor.
    A null text has the closing id only.
    """
    if tokenizer is None or ranks is None or pattern is None:
        import public_tokenizers
        tokenizer = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
        ranks = ranks or public_tokenizers.path("byte_bpe_50k.tiktoken")
        pattern = pattern or public_tokenizers.PATTERN
    pieces = docs.select("doc_id", "text").mapInPandas(
        _tokenize((str(ranks), pattern, str(tokenizer)), capacity),
        "doc_id long, pieces array<struct<start: long, length: long, ids_crc32: long>>")
    return pieces.select("doc_id", F.posexplode("pieces").alias("piece", "p")).select(
        "doc_id", "piece", "p.start", "p.length", "p.ids_crc32")


def least_fill(lengths: np.ndarray, capacity: int = CAPACITY) -> Fraction:
    """No packing of the lengths has fewer sequences. The greatest value of two families of dual-feasible functions.

    The first rounds lengths over C - k up to C and forgets those under k; the second rounds to multiples of 1/k.
    """
    return _least_fill(np.bincount(lengths, minlength=capacity + 1), capacity)


def _least_fill(histogram: np.ndarray, capacity: int) -> Fraction:
    """The same for how many pieces there are of each length."""
    counts = histogram.astype(object)
    sizes = np.arange(capacity + 1)
    weight = counts * sizes
    below, above = np.cumsum(counts), np.cumsum(weight)
    best = Fraction(int(above[-1]), capacity)
    for k in range(1, capacity // 2 + 1):
        large = int(below[-1] - below[capacity - k])
        middle = int(above[capacity - k] - above[k - 1])
        best = max(best, large + Fraction(middle, capacity))
    for k in range(1, 33):
        scaled = (k + 1) * sizes
        value = np.where(scaled % capacity == 0, k * sizes, scaled // capacity * capacity)
        best = max(best, Fraction(int((counts * value).sum()), k * capacity))
    return best


def lower_bound(lengths: np.ndarray, capacity: int = CAPACITY) -> int:
    return math.ceil(least_fill(lengths, capacity))


def best_fit_decreasing(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """The sequences as lists of positions in ``lengths``; each length goes where the least room is left."""
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms, bins = 0, []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        n = lengths[i]
        fitting = open_rooms >> n
        if fitting:
            room = n + (fitting & -fitting).bit_length() - 1
            at = by_room[room].pop()
            if not by_room[room]:
                open_rooms &= ~(1 << room)
            bins[at].append(i)
        else:
            at, room = len(bins), capacity
            bins.append([i])
        left = room - n
        by_room[left].append(at)
        if left:
            open_rooms |= 1 << left
    return bins


def _packed(rows: list[tuple], first_id: int, capacity: int, last_round: bool, share: Fraction) -> list[tuple]:
    """rows: pieces. Adds (sequence_id, offset, final). ``share``: sequences per token that all pieces need by the bound."""
    lengths = [r[3] for r in rows]
    bins = best_fit_decreasing(lengths, capacity)
    room = [capacity - sum(lengths[i] for i in b) for b in bins]
    final = last_round or len(bins) == lower_bound(np.array(lengths), capacity) <= math.ceil(share * sum(lengths))
    given_up = set() if final else {b for b in range(len(bins)) if room[b]}
    out = []
    for b, members in enumerate(bins):
        offset = 0
        for i in members:
            out.append((*rows[i], first_id + b, offset, b not in given_up))
            offset += lengths[i]
    return out


def _pack(round_number: int, capacity: int, group: int, last_round: bool, share: Fraction):
    names = [c.split()[0] for c in PIECE.split(", ")] + ["sequence_id", "offset", "final"]

    def frame(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # sequences are numbered by round, partition and place, so that no task needs to know another
        next_id = (round_number << 58) + (TaskContext.get().partitionId() << 36)
        held: list[tuple] = []
        for batch in batches:
            ids = [None if pd.isna(x) else int(x) for x in batch["doc_id"]]
            held += zip(ids, *[batch[c].tolist() for c in names[1:5]])
            while len(held) >= group:
                part, held = held[:group], held[group:]
                yield frame(_packed(part, next_id, capacity, last_round, share))
                next_id += len(part)
        if held:
            yield frame(_packed(held, next_id, capacity, last_round, share))

    return of


def pack(pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP, most: int = MOST) -> DataFrame:
    """Add sequence_id and offset to the pieces: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    ``pieces`` must be a written table. Full pieces are sequences of their own and take no part. A task packs
    at most ``group`` pieces at once, twice as many in every further round up to ``most``. Rounds go on while groups
    have gaps, until one group holds what is left, or until an exchange has saved nothing. Equal pieces are interchangeable.
    """
    schema = f"{PIECE}, sequence_id long, offset long, final boolean"
    full = pieces.filter(F.col("length") == capacity).select(
        "*", (F.monotonically_increasing_id() + F.lit(1 << 62)).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"))
    rest, done = pieces.filter(F.col("length") < capacity), [full]
    opened, last, number = None, False, 0
    while True:
        histogram = np.zeros(capacity + 1, dtype=np.int64)
        for row in rest.groupBy("length").count().collect():  # one row per length below the capacity
            histogram[row["length"]] = row["count"]
        n, tokens = int(histogram.sum()), int((histogram * np.arange(capacity + 1)).sum())
        if not n:
            break
        share = Fraction(math.ceil(_least_fill(histogram, capacity)), max(1, tokens))
        parts = -(-n // group)
        last = last or parts == 1
        result = cut(rest.repartition(parts).mapInPandas(_pack(number, capacity, group, last, share), schema), "packed")
        done.append(result.filter("final").drop("final"))
        if last:
            break
        left = result.filter("NOT final")
        sequences = F.count_if(F.col("offset") == 0)
        packed, still = result.agg(sequences).first()[0], left.agg(sequences).first()[0]
        # the next round is the last one if this one did not need fewer sequences than the one before left open
        last = opened is not None and packed >= opened
        rest, opened = left.select("doc_id", "piece", "start", "length", "ids_crc32"), still
        group, number = min(2 * group, most), number + 1
    whole = done[0]
    for part in done[1:]:
        whole = whole.unionByName(part)
    return whole


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids and a closing 0. A null or empty text is the closing id alone. Rows that repeat an id or a text
    are packed as documents of their own. A text of any length is tokenized whole, in some 60 bytes a character, and cut into pieces.
    An empty table gives no rows; other columns are ignored.
    """
    return pack(cut(tokenized(docs, tokenizer, capacity=capacity), "pieces"), capacity)
