"""Fill-in-middle transformation by memoized content-defined chunks.

A text is cut where a rolling hash of its last characters hits a mask, so that passages which many documents share fall into
the same chunks. What a cut needs to know of a chunk is small: how many units it holds, and whether a run of letters crosses its
edges. A task keeps these boundary summaries in a bounded cache; an entry is found by the chunk's hash and used only if the
stored content is equal. The counts of a text's chunks, less the runs that two chunks share, add up to its number of units, and a
binary search among them finds the one chunk in which a cut has to be looked for.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import OrderedDict
from collections.abc import Iterator
from itertools import accumulate, islice

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Units, sentinels and rates of the transformation.
UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]")
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
TRANSFORMED_PERCENT = 90
SPM_PERCENT = 20
SEED = 1

#: Characters the rolling hash covers, one cut in 2^BITS places, and the lengths of a chunk.
WINDOW = 16
BITS = 8
SHORTEST = 64
LONGEST = 4096
#: Characters of the chunks a task remembers at most.
CACHE_CHARS = 8_000_000
_SPREAD = np.uint32(2654435761)


def chunk_ends(text: str, bits: int = BITS, shortest: int = SHORTEST, longest: int = LONGEST) -> list[int]:
    """Where the chunks of a text end; the last end is its length. Cuts depend on the characters around them."""
    n = len(text)
    points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    spread = points * _SPREAD
    spread ^= spread >> np.uint32(15)
    # after the doublings a place sums its last WINDOW characters, each shifted by its distance
    rolling, width = spread, 1
    while width < min(WINDOW, n):
        shifted = rolling.copy()
        shifted[width:] += rolling[:-width] << np.uint32(width)
        rolling, width = shifted, 2 * width
    hits = np.flatnonzero(((rolling * _SPREAD) >> np.uint32(32 - bits)) == 0) + 1
    ends, at = [], 0
    for hit in [*hits.tolist(), n]:
        while hit - at > longest:
            at += longest
            ends.append(at)
        if hit - at >= shortest or hit == n and hit > at:
            ends.append(hit)
            at = hit
    return ends


class ChunkCache:
    """Boundary summaries by content, least recently used out first.

    A summary is (units, starts with a letter, ends with a letter). Chunks are found by their hash and verified by their
    content, both of which a dictionary keyed by the chunk does.
    """

    def __init__(self, most_chars: int = CACHE_CHARS):
        self.most_chars, self.held, self.chars, self.hits = most_chars, OrderedDict(), 0, 0

    def summary(self, chunk: str) -> tuple[int, bool, bool]:
        found = self.held.get(chunk)
        if found is not None:
            self.hits += 1
            self.held.move_to_end(chunk)
            return found
        first, last = chunk[0], chunk[-1]
        found = (len(UNIT.findall(chunk)), first.isascii() and first.isalpha(), last.isascii() and last.isalpha())
        self.held[chunk] = found
        self.chars += len(chunk)
        while self.chars > self.most_chars:
            self.chars -= len(self.held.popitem(last=False)[0])
        return found


class Units:
    """The units of a text, counted and found through the summaries of its chunks."""

    def __init__(self, text: str, cache: ChunkCache, ends: list[int] | None = None):
        self.text = text
        self.ends = chunk_ends(text) if ends is None else ends
        self.starts = [0, *self.ends[:-1]]
        self.shared, new, crossing = [], [], False
        for a, b in zip(self.starts, self.ends):
            units, opens, closes = cache.summary(text[a:b])
            # a run of letters that began in the chunk before is no new unit
            self.shared.append(crossing and opens)
            new.append(units - self.shared[-1])
            crossing = closes
        self.before = [0, *accumulate(new)]

    @property
    def count(self) -> int:
        return self.before[-1]

    def offset(self, unit: int) -> int:
        """The character at which a unit begins, counted from 0; the text's length for its count of units."""
        if unit >= self.count:
            return len(self.text)
        at = bisect_right(self.before, unit) - 1
        chunk = UNIT.finditer(self.text, self.starts[at], self.ends[at])
        return next(islice(chunk, unit - self.before[at] + self.shared[at], None)).start()


def _arrange(text: str, draws: tuple[int, int, int, int], cache: ChunkCache) -> tuple:
    """(n, form, prefix characters, middle characters, output)."""
    if not text:
        return 0, "plain", None, None, text
    units, (h1, h2, h3, h4) = Units(text, cache), draws
    if h3 % 100 >= TRANSFORMED_PERCENT or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)):
        return units.count, "plain", None, None, text
    a, b = sorted(units.offset(h % (units.count + 1)) for h in (h1, h2))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < SPM_PERCENT:
        return units.count, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return units.count, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def _transform(most_chars: int):
    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = ChunkCache(most_chars)
        for batch in batches:
            rows = [_arrange(text or "", tuple(draws), cache) for text, draws in zip(batch["text"], batch["draws"])]
            out = pd.DataFrame(rows, columns=["n", "form", "prefix_chars", "middle_chars", "output"])
            out.insert(0, "doc_id", batch["doc_id"])
            yield out.astype({c: "Int64" for c in ("doc_id", "n", "prefix_chars", "middle_chars")})

    return of


def transform(docs: DataFrame, cache_chars: int = CACHE_CHARS, seed: int = SEED) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every document, its whole text.

    A null text counts as empty and is plain with no units. A null id draws as the word ``null``. Rows that repeat an
    id or a text are transformed each on their own, with the same result. Texts of any length are cut in time that grows with
    their length, and need some 30 bytes a character. An empty table gives no rows; other columns are ignored.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))), 256)
    draws = F.array(*[F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), draws.alias("draws")).mapInPandas(
        _transform(cache_chars),
        "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The text of an output, by its form. A transformed text holds no sentinel, so the first of each kind is the right one."""
    def between(first: str, second: str, swapped: bool) -> Column:
        cut, end = F.locate(second, output), F.locate(MIDDLE, output)
        one = F.substring(output, F.lit(len(first) + 1), cut - len(first) - 1)
        two = F.substring(output, cut + len(second), end - cut - len(second))
        middle = F.substring(output, end + len(MIDDLE), F.length(output))
        return F.concat(two, middle, one) if swapped else F.concat(one, middle, two)

    return (F.when(form == "psm", between(PREFIX, SUFFIX, False)).when(form == "spm", between(SUFFIX, PREFIX, True))
            .otherwise(output))


def transform_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and the digests of the output and of the text rebuilt from it."""
    return transform(docs).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
