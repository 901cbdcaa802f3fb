"""Quality classifier by compression.

Two zstandard dictionaries are built from labelled texts, one from good and one from bad ones. A text
is compressed with either; the normalised difference of the two sizes says which it resembles more. A
logistic calibration on other labelled texts turns the difference into a score. Its only other input is
the length, without which equal differences mean different things for short and long texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framesift.llm.common import held_out

# Bounds of what is fetched to fit: texts per class for the dictionaries and for the calibration, and
# the code points of the longest text used. Scoring has no bounds.
DICTIONARY_TEXTS = 800
CALIBRATION_TEXTS = 1600
LONGEST = 16384
DICTIONARY_BYTES = 256 * 1024
CHUNK = 512
CHUNKS = 16
LEVEL = 3
THRESHOLD = 0.7


@dataclass
class CompressionModel:
    """Dictionaries and calibration; compressors are made where the model is used."""

    good: bytes
    bad: bytes
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    centre: np.ndarray = field(default_factory=lambda: np.zeros(0))
    scale: np.ndarray = field(default_factory=lambda: np.zeros(0))
    prior: float = 0.5

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def _compressors(self):
        made = self.__dict__.get("_made")
        if made is None:
            import zstandard

            made = []
            for data in (self.good, self.bad):
                options = {"level": LEVEL, "write_content_size": False, "write_dict_id": False}
                if data:
                    trained = data[:4] == b"\x37\xa4\x30\xec"
                    options["dict_data"] = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT)
                    options["dict_data"].precompute_compress(level=LEVEL)
                made.append(zstandard.ZstdCompressor(**options))
            self.__dict__["_made"] = made
        return made

    def features(self, text: str | None) -> list[float]:
        """The difference of the two sizes by the larger of them, the same by length, and by the text's size; the length."""
        data = (text or "").encode("utf-8", "surrogatepass")
        good, bad = (len(c.compress(data)) for c in self._compressors())
        length, difference = np.log(len(data) + 1.0), (bad - good) / max(good, bad)
        return [difference, difference * length, (bad - good) / (len(data) + 1.0), length, length * length]

    def scores(self, texts: Iterator[str | None]) -> np.ndarray:
        """Probability of label 1 for each text, the share of label 1 if there was nothing to fit."""
        rows = [self.features(t) for t in texts]
        if not len(self.weights):
            return np.full(len(rows), self.prior)
        x = (np.array(rows).reshape(len(rows), len(self.centre)) - self.centre) / self.scale
        return 1 / (1 + np.exp(-np.clip(self.weights[0] + x @ self.weights[1:], -40, 40)))


def _dictionary(texts: list[str]) -> bytes:
    """A trained dictionary, or the raw texts where there are too few to train on."""
    import zstandard

    chunks = []
    for text in texts:
        data = text.encode("utf-8", "surrogatepass")
        starts = range(0, len(data), max(CHUNK, -(-len(data) // CHUNKS)))
        chunks += [data[s : s + CHUNK] for s in starts]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, chunks, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(chunks)[-DICTIONARY_BYTES:]


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    x = np.column_stack([np.ones(len(x)), x])
    weights = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -40, 40)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9), x.T @ (y - p) - penalty * weights)
        weights = weights + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return weights


def fit_model(good: list[str], bad: list[str], dictionary_texts: int = DICTIONARY_TEXTS) -> CompressionModel:
    """Fit on labelled texts in the order given: the first ones (half at most) build the dictionaries,
    the others calibrate."""
    parts = [(t[: min(dictionary_texts, len(t) // 2)], t[min(dictionary_texts, len(t) // 2) :]) for t in (good, bad)]
    prior = len(good) / (len(good) + len(bad)) if good or bad else 0.5
    if not all(p for pair in parts for p in pair):
        return CompressionModel(b"", b"", prior=prior)
    model = CompressionModel(_dictionary(parts[0][0]), _dictionary(parts[1][0]), prior=prior)
    rest = parts[0][1] + parts[1][1]
    y = np.array([1.0] * len(parts[0][1]) + [0.0] * len(parts[1][1]))
    x = np.array([model.features(t) for t in rest])
    model.centre, model.scale = x.mean(axis=0), np.where(x.std(axis=0) > 1e-12, x.std(axis=0), 1.0)
    model.weights = _logistic((x - model.centre) / model.scale, y)
    return model


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> CompressionModel:
    """Fit on a bounded sample of labelled documents that are not held out.

    Per class the ``DICTIONARY_TEXTS + CALIBRATION_TEXTS`` labelled ids that come first by a hash are
    fetched, of which texts over ``LONGEST`` code points are left out. Ids with two different labels, a
    missing label or one other than 0 and 1 are not used. The fit reads labels and texts only.
    """
    known = labels.filter(F.col(key).isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col(key)))
    agreed = known.groupBy(F.col(key).alias("_key")).agg(F.min(label).cast("int").alias("_label"), F.max(label).cast("int").alias("_most")).filter("_label = _most")
    order = [F.xxhash64(F.lit(4), "_key"), F.col("_key")]
    chosen = [agreed.filter(F.col("_label") == k).orderBy(*order).limit(DICTIONARY_TEXTS + CALIBRATION_TEXTS).select("_key", "_label") for k in (0, 1)]
    rows = (
        docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
        .filter(F.char_length("_text") <= LONGEST)
        .join(F.broadcast(chosen[0].union(chosen[1])), "_key")  # at most 4,800 ids
        .groupBy("_key", "_label")
        .agg(F.min("_text").alias("_text"))
        .orderBy(*order)
        .collect()
    )
    return fit_model([r["_text"] for r in rows if r["_label"] == 1], [r["_text"] for r in rows if r["_label"] == 0])


def score_column(model: CompressionModel, text: Column) -> Column:
    @F.pandas_udf("double")
    def scored(values: pd.Series) -> pd.Series:
        return pd.Series(model.scores(values), dtype="float64")

    return scored(text)


def score(docs: DataFrame, model: CompressionModel, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Documents with ``score`` in [0, 1], higher for better, and ``predicted`` = 1 from ``threshold`` on.

    A missing text scores as an empty one; every row is scored by its whole text alone, so repeated
    rows score alike. Columns of the two names are replaced; an empty table gives an empty table.
    """
    base = docs.select(*[c for c in docs.columns if c.lower() not in ("score", "predicted")])
    scored = base.withColumn("score", score_column(model, F.col(text)))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
