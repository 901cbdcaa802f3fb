"""Language identification by ranked character trigrams (Cavnar and Trenkle, 1994) as Spark jobs."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PROFILE_SIZE = 300


def _padded(text: Column) -> Column:
    """The words of a text, each with ``_`` on both sides and a blank between two."""
    return F.concat(F.lit("_"), F.regexp_replace(F.lower(text), r"[^\p{L}]+", "_ _"), F.lit("_"))


def trigrams(text: Column) -> Column:
    """Trigrams of the words of a text, each word padded with ``_`` on both sides.

    A look-ahead finds the overlapping trigrams in one pass over the text.
    """
    return F.regexp_extract_all(_padded(text), F.lit("(?=([^ ]{3}))"), F.lit(1))


def trigram_profiles(df: DataFrame, text: str, lang: str, size: int = PROFILE_SIZE) -> DataFrame:
    """The most frequent trigrams of each labelled language with their place (lang, gram, place)."""
    counts = (
        df.select(F.col(lang).alias("lang"), F.explode(trigrams(F.col(text))).alias("gram"))
        .groupBy("lang", "gram")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc(), F.col("gram").asc()))
    return counts.withColumn("place", place).filter(F.col("place") <= size).select("lang", "gram", "place")


def language_scores(df: DataFrame, profiles: DataFrame, key: str, text: str = "text", size: int = PROFILE_SIZE) -> DataFrame:
    """(key, lang, score): each trigram of a text adds the weight of its place in the profile.

    Profiles hold at most ``size`` rows per language, which bounds the broadcast. All trigrams of a
    row are in one task, so map tasks sum them up before the shuffle.
    """
    weight = (F.lit(size + 1) - F.col("place")).cast("bigint")
    return (
        df.select(key, F.explode(trigrams(F.col(text))).alias("gram"))
        .join(F.broadcast(profiles), "gram")
        .groupBy(key, "lang")
        .agg(F.sum(weight).alias("score"))
    )


class ProfileTable:
    """Profiles as constant arrays: the sorted codes of all their trigrams and a weight per trigram and language.

    A trigram's code is its three code points side by side, so a text is scored by shifting its code
    points, looking the codes up in the sorted array and adding up rows of weights. Profiles hold at
    most ``size`` rows per language, so the arrays are small, and they are fetched once.
    """

    def __init__(self, profiles: DataFrame, size: int = PROFILE_SIZE):
        rows = [r for r in profiles.select("lang", "gram", "place").collect() if len(r["gram"]) == 3]
        self.languages = sorted({r["lang"] for r in rows})
        code = lambda gram: sum(ord(c) << (42 - 21 * k) for k, c in enumerate(gram))
        codes = np.array(sorted({code(r["gram"]) for r in rows}), np.uint64)
        weights = np.zeros((len(codes), len(self.languages)), np.int64)
        for r in rows:
            weights[np.searchsorted(codes, np.uint64(code(r["gram"]))), self.languages.index(r["lang"])] = size + 1 - r["place"]

        @F.pandas_udf("array<bigint>")
        def scored(words: pd.Series) -> pd.Series:
            return pd.Series([score_text(w, codes, weights) for w in words])

        self._scored = scored

    def scores(self, text: Column) -> Column:
        """One score per language, in the order of ``languages``; all 0 where no trigram is known."""
        return self._scored(_padded(text))

    def among_best(self, text: Column, target: str, k: int) -> Column:
        """Whether the target has a score and fewer than ``k`` languages have a better one, ties going by name."""
        if target not in self.languages:
            return F.lit(False)
        own = self.languages.index(target)

        def judged(scores: Column) -> Column:
            score = F.get(scores, own)
            better = F.filter(scores, lambda s, i: (s > score) | ((s == score) & (i < own)))
            return (score > 0) & (F.size(better) < k)

        # Scored once per row, as the only element of an array.
        return F.get(F.transform(F.array(self.scores(text)), judged), 0)


# Code points scored at a time: a text of any length takes a few megabytes of a worker.
_PIECE = 1 << 16


def score_text(words: str | None, codes: np.ndarray, weights: np.ndarray, piece: int = _PIECE) -> np.ndarray:
    """Sums of the weights of all trigrams of padded words, read in overlapping pieces."""
    words = words or ""
    total = np.zeros(weights.shape[1], np.int64)
    if not len(codes):
        return total
    for start in range(0, len(words) - 2, piece):
        points = np.frombuffer(words[start : start + piece + 2].encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        apart = points == 32
        whole = ~(apart[:-2] | apart[1:-1] | apart[2:])
        found = ((points[:-2] << np.uint64(42)) | (points[1:-1] << np.uint64(21)) | points[2:])[whole]
        at = np.minimum(np.searchsorted(codes, found), len(codes) - 1)
        total += np.bincount(at[codes[at] == found], minlength=len(codes)) @ weights
    return total


def lang_filter(
    df: DataFrame, profiles: DataFrame, target: str = "en", k: int = 5, key: str = "pos", text: str = "text"
) -> DataFrame:
    """Keep rows for which the target is among the k best languages.

    Each row is scored where it is, without a shuffle; the profiles are fetched while the plan is built.
    With ``k`` languages or fewer in the profiles that would be every row that has a known trigram, so
    it fails the job.
    """
    table = ProfileTable(profiles)
    if len(table.languages) <= k:
        return df.filter(F.raise_error(F.lit(f"the {k} best of no more than {k} languages keep everything")).cast("boolean"))
    return df.filter(table.among_best(F.col(text), target, k))


def keep_top_languages(df: DataFrame, scores: DataFrame, target: str, k: int, key: str) -> DataFrame:
    """The same from any score table (key, lang, score), such as another detector's output."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.col("score").desc(), F.col("lang").asc()))
    good = scores.withColumn("_r", rank).filter((F.col("_r") <= k) & (F.col("lang") == target)).select(key)
    return df.join(good, key, "left_semi")
