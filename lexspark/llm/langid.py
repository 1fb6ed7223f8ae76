"""Language identification by error-correcting output codes over byte n-grams."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexspark.llm.common import fresh

#: Labelled rows of each language that are used to fit the classifiers, about; the only bounded sample.
SAMPLE = 400
#: Languages a model may have; labels beyond the most frequent ones are not learned.
MOST_LANGUAGES = 256
#: Hash buckets of the n-gram features.
BUCKETS = 1 << 14
#: Bits of a codeword for each doubling of the number of languages.
BITS_PER_DOUBLING = 8
#: Bytes of a text hashed at a time, so that a very long text takes no more memory than a short one.
STEP = 1 << 20
#: A text whose best language is less probable than this is ambiguous.
CLEAR = 0.5
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")


def features(text: str) -> np.ndarray:
    """Square roots of the shares of hashed 1- to 3-byte grams of a lower-cased text, to unit length."""
    counts = np.zeros(BUCKETS, np.int64)
    data = text.lower().encode("utf-8", "replace")
    for start in range(0, max(len(data), 1), STEP):
        part = np.frombuffer(b" " * (start == 0) + data[max(start - 2, 0):start + STEP] + b" " * (start + STEP >= len(data)), np.uint8).astype(np.uint32)
        for size in (1, 2, 3):
            grams = np.full(max(len(part) - size + 1, 0), size, np.uint32)
            for k in range(size):
                grams = grams * np.uint32(256) + part[k:len(part) - size + 1 + k]
            # The two bytes a later part begins with end no new gram of their own.
            fresh = grams[max(0, 3 - size):] if start else grams
            counts += np.bincount((fresh * np.uint32(2654435761)) >> np.uint32(32 - 14), minlength=BUCKETS)
    root = np.sqrt(counts)
    norm = np.sqrt((root * root).sum())
    return (root / norm if norm else root).astype(np.float32)


def codewords(languages: int, seed: int = 7) -> np.ndarray:
    """A row of +1 and -1 for each language: the best of some random codes, by the least distance between rows and no constant column."""
    bits = BITS_PER_DOUBLING * max(1, int(np.ceil(np.log2(max(languages, 2)))))
    draw = np.random.default_rng(seed)
    best, most = None, -1
    for _ in range(200):
        code = draw.choice(np.array([-1, 1], np.int8), (languages, bits))
        if languages > 1:
            same = np.flatnonzero(np.abs(code.sum(axis=0, dtype=int)) == languages)
            code[draw.integers(languages, size=len(same)), same] *= -1
        apart = min((int((code[i] != code[j]).sum()) for i in range(languages) for j in range(i)), default=bits) if languages <= 32 else 0
        if apart > most:
            best, most = code, apart
        if languages > 32:
            break
    return best.astype(np.float32)


@dataclass(frozen=True)
class Model:
    """``weights`` and ``bias`` of a binary classifier for each bit, and each bit's weight in decoding."""

    languages: tuple[str, ...]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray

    def losses(self, x: np.ndarray) -> np.ndarray:
        """The logistic loss of each language's codeword for each row, every bit by its trust."""
        margins = x @ self.weights + self.bias
        return np.logaddexp(0, -margins[:, None, :] * self.code[None, :, :]) @ self.trust

    def predict(self, texts: Sequence[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and whether it is ambiguous, for each text."""
        names = np.full(len(texts), UNKNOWN, object)
        scores, unclear = np.zeros(len(texts)), np.ones(len(texts), bool)
        known = [i for i, t in enumerate(texts) if t is not None and _LETTER.search(t)]
        if known and self.languages:
            losses = self.losses(np.stack([features(texts[i]) for i in known]))
            shares = np.exp(losses.min(axis=1, keepdims=True) - losses)
            shares /= shares.sum(axis=1, keepdims=True)
            best = losses.argmin(axis=1)
            names[known] = np.array(self.languages, object)[best]
            scores[known] = shares[np.arange(len(known)), best]
            unclear[known] = scores[known] < CLEAR
        return list(names), scores, unclear


def fit(texts: Sequence[str], labels: Sequence[str], rounds: int = 300, rate: float = 8.0, decay: float = 1e-5) -> Model:
    """Logistic regression for each bit, by gradient steps on all rows at once; languages weigh alike."""
    languages = tuple(sorted(set(labels)))
    code = codewords(len(languages))
    x = np.stack([features(t) for t in texts]) if texts else np.zeros((0, BUCKETS), np.float32)
    own = np.array([languages.index(v) for v in labels], int)
    y = code[own] if len(own) else np.zeros((0, code.shape[1]), np.float32)
    weight = (1 / np.bincount(own, minlength=max(len(languages), 1))[own]).astype(np.float32) if len(own) else np.zeros(0, np.float32)
    weight /= weight.sum() or 1
    weights, bias = np.zeros((BUCKETS, code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    for _ in range(rounds):
        slope = -y * weight[:, None] / (1 + np.exp(np.clip(y * (x @ weights + bias), -30, 30)))
        weights -= rate * (x.T @ slope + decay * weights)
        bias -= rate * slope.sum(axis=0)
    right = (weight[:, None] * ((x @ weights + bias) * y > 0)).sum(axis=0)
    trust = np.maximum(2 * right - 1, 0.05)
    return Model(languages, code, weights, bias, (trust / trust.sum() * code.shape[1]).astype(np.float32))


def sample(labelled: DataFrame, rows: int = SAMPLE) -> DataFrame:
    """About ``rows`` rows of each language (``id, text, lang``), chosen by a hash of the id; languages with fewer are whole."""
    counts = labelled.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(MOST_LANGUAGES).collect()
    share = F.lit(None).cast("double")
    for row in counts:
        share = F.when(F.col("lang") == row["lang"], F.lit(rows / row["n"])).otherwise(share)
    drawn = F.pmod(F.xxhash64(F.lit("sample"), F.col("id").cast("string")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return labelled.where(drawn < share).limit(4 * rows * max(len(counts), 1))


def train(labelled: DataFrame, rows: int = SAMPLE) -> Model:
    """A model from the bounded sample of ``id, text, lang``; rows without language, text or id are left out."""
    usable = labelled.select("id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where("id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL")
    # Sorted, so that the model doesn't depend on how the table is stored.
    drawn = sorted((r["text"], r["lang"]) for r in sample(usable, rows).collect())
    return fit([t for t, _ in drawn], [v for _, v in drawn])


def identify(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with ``lang_pred``, ``score`` (0 to 1) and ``ambiguous`` behind; an input column of such a name, whatever its case, is replaced.

    Only the text decides. A null text, or one without a letter, is ``und`` with score 0, as every
    text is for a model without languages. Whole texts are looked at; no rows give no rows.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, ambiguous boolean")
    def predict(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for part in parts:
            out = [own.predict(part.iloc[k:k + 64].tolist()) for k in range(0, len(part), 64)]
            yield pd.DataFrame({
                "lang_pred": pd.Series([x for names, _, _ in out for x in names], dtype=object), "score": np.concatenate([s for _, s, _ in out] or [np.zeros(0)]),
                "ambiguous": np.concatenate([u for _, _, u in out] or [np.zeros(0, bool)])})

    made, own = ["lang_pred", "score", "ambiguous"], fresh("made")
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in made]
    return docs.select(*kept, predict(F.col(text_column).cast("string")).alias(own)).select(*kept, *(F.col(f"{own}.{c}").alias(c) for c in made))
