"""Language identification with word-first backoff.

A known word is scored by its log frequency in each language. An unseen word is scored by its character n-grams: the
longest ones first, falling back to shorter ones where a longer one is unseen, and to nothing in the end. The model holds
the most frequent words and n-grams of each language in a bounded sample of labelled texts, which gives every language its
part, so its size is bounded too. A word is a run of characters other than ASCII white space, in learning and in prediction.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from coldhaul.llm.common import WORD
from coldhaul.session import cut

#: Labelled rows that are learned from, about, and the most words and n-grams of each length kept.
SAMPLE_ROWS = 20_000
WORDS = 30_000
GRAMS = 30_000
LONGEST = 4
#: Numbers in a model at most, one per entry and language: 160 MB. With many languages fewer entries are kept.
MOST_NUMBERS = 20_000_000
#: Added to every count, so that no frequency is 0.
SMOOTHING = 0.1
#: Evidence of one word at most, in nats, and of one unseen word as part of that of a known word.
CLIP = 8.0
BACKOFF_WEIGHT = 0.5
#: Scores of unseen words that a worker keeps before it starts anew.
CACHE = 200_000
UNDETERMINED = "und"


def held_out(doc_id) -> object:
    """Documents whose crc32 of the id as text leaves the remainder 1 of 3 are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _words(df: DataFrame) -> DataFrame:
    """(lang, word): the words of the texts in lower case, without what is no letter at their ends."""
    bare = F.regexp_replace(F.lower(F.col("word")), r"^[\P{L}]+|[\P{L}]+$", "")
    return df.select("lang", F.explode(F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("word")).select(
        "lang", bare.alias("word")).filter("word <> ''")


def _bare(word: str) -> str:
    """The word in lower case, without what is no letter at its ends."""
    word = word.lower()
    if word.isalpha():
        return word
    begin, end = 0, len(word)
    while begin < end and not word[begin].isalpha():
        begin += 1
    while end > begin and not word[end - 1].isalpha():
        end -= 1
    return word[begin:end]


class Model:
    """Log frequencies per language: rows for words, and for n-grams of each length.

    Words of texts are remembered with their scores, up to ``CACHE`` of them.
    """

    def __init__(self, langs: list[str], words: dict[str, list[float]], grams: dict[str, list[float]]):
        self.langs = langs
        self.words = {w: i for i, w in enumerate(words)}
        self.grams = {g: i for i, g in enumerate(grams)}
        self.word_scores = np.array(list(words.values()), dtype=np.float64).reshape(len(words), len(langs))
        self.gram_scores = np.array(list(grams.values()), dtype=np.float64).reshape(len(grams), len(langs))
        self.seen: dict[bytes, int] = {}
        self.scores = np.zeros((0, len(langs)))

    def grams_of(self, word: str) -> list[int]:
        """For each place of an unseen word, the longest known n-gram that starts there, if any."""
        marked, known, found = f"<{word}>", self.grams.get, []
        for at in range(len(marked)):
            row = known(marked[at:at + LONGEST])
            if row is None:
                for size in range(LONGEST - 1, 0, -1):
                    row = known(marked[at:at + size])
                    if row is not None:
                        break
                else:
                    continue
            found.append(row)
        return found

    def remember(self, words: list[bytes]) -> None:
        """Score words that were not met before: as known words, or as the mean of their n-grams, or as nothing."""
        if len(self.seen) + len(words) > len(self.scores):
            room = max(2 * len(self.scores), len(self.seen) + len(words), 4096)
            self.scores = np.concatenate((self.scores, np.zeros((room - len(self.scores), len(self.langs)))))
        rows, grams, lengths = [], [], []
        for word in words:
            at = self.seen[word] = len(self.seen)
            bare = _bare(word.decode())
            known = self.words.get(bare)
            if known is not None:
                self.scores[at] = self.word_scores[known]
                continue
            found = self.grams_of(bare) if bare else []
            if found:
                rows.append(at)
                grams += found
                lengths.append(len(found))
            else:
                self.scores[at] = 0
        if rows:
            starts = np.cumsum(lengths) - lengths
            sums = np.add.reduceat(self.gram_scores[grams], starts, axis=0)
            self.scores[rows] = BACKOFF_WEIGHT * sums / np.array(lengths)[:, None]

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.langs or not any(map(str.isalpha, text)):
            return UNDETERMINED, 0.0
        counts = Counter(text.encode().split())  # bytes are split at ASCII white space alone
        new = [w for w in counts if w not in self.seen]
        if new:
            if len(self.seen) + len(new) > CACHE:
                self.seen, new = {}, list(counts)
            self.remember(new)
        rows = [self.seen[w] for w in counts]
        total = np.array(list(counts.values()), dtype=np.float64) @ self.scores[rows]
        likely = np.exp(total - total.max())
        best = int(total.argmax())
        return self.langs[best], float(likely[best] / likely.sum())


def _gram(size: int):
    return lambda i: F.substr(F.col("m"), i, F.lit(size))


def _table(counts: DataFrame, langs: list[str], most: int) -> dict[str, list[float]]:
    """For the most frequent keys of each language, the log of their share in each over the mean, within ``CLIP``.

    ``most`` keys in all at most, an equal part for each language.
    """
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    by_lang = W.partitionBy("lang").orderBy(F.col("n").desc(), "key")
    chosen = (counts.withColumn("place", F.row_number().over(by_lang)).filter(F.col("place") <= most // len(langs))
              .select("key").distinct())
    wide = counts.join(chosen, "key").groupBy("key").agg(F.map_from_entries(
        F.collect_list(F.struct("lang", "n"))).alias("by"))
    out = {}
    for row in wide.orderBy("key").collect():  # at most ``most`` rows
        share = np.array([math.log((row["by"].get(x, 0) + SMOOTHING) / (totals.get(x, 0) + 1)) for x in langs])
        out[row["key"]] = np.clip(share - share.mean(), -CLIP, CLIP).tolist()
    return out


def quotas(counts: dict[str, int], rows: int) -> dict[str, float]:
    """The part of each language's rows to learn from: as many of each, those of rare languages all."""
    out, left = {}, rows
    for i, (lang, n) in enumerate(sorted(counts.items(), key=lambda x: (x[1], x[0]))):
        out[lang] = min(1.0, left / (len(counts) - i) / n)
        left -= out[lang] * n
    return out


def train(docs: DataFrame, rows: int = SAMPLE_ROWS, words: int = WORDS, grams: int = GRAMS) -> Model:
    """Learn from the texts and languages of documents that are not held out and have both.

    About ``rows`` of them are learned from, as many of each language, chosen by a hash of id and text. Words and n-grams are
    counted on the cluster, and the most frequent of each language come to the driver, so the model has at most
    ``words + 4 * grams`` entries of one number per language, and ``MOST_NUMBERS`` numbers.
    """
    labelled = docs.select("doc_id", "text", "lang").filter("text IS NOT NULL AND lang IS NOT NULL").filter(
        ~held_out(F.col("doc_id")))
    # one row per language
    parts_of = quotas({r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}, rows)
    if min(parts_of.values(), default=1.0) < 1:
        below = docs.sparkSession.createDataFrame([(x, int((1 << 30) * part)) for x, part in parts_of.items()], "lang string, _below long")
        labelled = labelled.join(F.broadcast(below), "lang").filter(
            F.pmod(F.xxhash64(F.lit("train"), "doc_id", "text"), F.lit(1 << 30)) < F.col("_below")).drop("_below")
    counts = cut(_words(labelled).groupBy("lang", "word").agg(F.count("*").alias("n")), "words")
    langs = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    if not langs:
        return Model([], {}, {})
    words, grams = [min(most, MOST_NUMBERS // ((1 + LONGEST) * len(langs))) for most in (words, grams)]
    known = _table(counts.select("lang", F.col("word").alias("key"), "n"), langs, words)
    marked = counts.select("lang", "n", F.concat(F.lit("<"), "word", F.lit(">")).alias("m"))
    parts: dict[str, list[float]] = {}
    for size in range(1, LONGEST + 1):
        places = F.when(F.length("m") >= size, F.sequence(F.lit(1), F.length("m") - (size - 1))).otherwise(
            F.array().cast("array<int>"))
        keys = marked.select("lang", "n", F.explode(F.transform(places, _gram(size))).alias("key"))
        parts |= _table(keys.groupBy("lang", "key").agg(F.sum("n").alias("n")), langs, grams)
    return Model(langs, known, parts)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.

    The prediction reads the text alone, all of it. A text that is null or has no letter, or a model that learned nothing,
    gives ``und`` and the score 0; else the score is the share of the best language, and ties go to the first by
    name. Equal texts get equal results. A text of any length is read whole and takes memory by its distinct words. An empty table
    gives no rows; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        learned = shared.value
        for batch in batches:
            found = [learned.predict(t) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "held_out": batch["held_out"],
                                "lang_pred": [f[0] for f in found], "score": [f[1] for f in found]})

    return docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out")).mapInPandas(
        predict, "doc_id long, held_out boolean, lang_pred string, score double")
