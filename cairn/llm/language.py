"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are hashed runs of one to three characters of the lower-cased text (letters as they are, all else one space),
as ``log(1 + count) x idf`` scaled to unit length; document frequencies are counted over every text learned from.  The
weights are trained by follow-the-regularised-leader (per-coordinate steps, L1 and L2 penalties) on at most ``per_class``
distinct texts a language (a documented bound; the smallest hashes, and evenly fewer a language where all would pass
``max_rows``), and a temperature fitted on a held-back fifth of them calibrates the probabilities.  A prediction uses the
text alone.

Defined results: a text that is null or has no letter is ``und`` with score 0, and so is every text when no labelled row
exists; null labels are not learned from; more than ``max_languages`` labels raise an error; repeated rows are predicted
each; extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cairn.operators.prefix import durable
from cairn.session import ship_by_value

BITS = 14
#: Code points of a text taken at a time.
CHUNK = 500_000


def letters_below(limit: int = 0x3000) -> np.ndarray:
    """For the code points below ``limit``: the lower-case letter, or a space."""
    out = np.full(limit, 32, np.uint32)
    for c in range(limit):
        low = chr(c).lower()
        if len(low) == 1 and low.isalpha():
            out[c] = ord(low)
    return out


def ngram_counts(text: str, letters: np.ndarray) -> np.ndarray | None:
    """Counts of the hashed n-grams of a whole text; None without a letter."""
    total, found = np.zeros(1 << BITS, np.int64), False
    for at in range(0, len(text), CHUNK):
        part = text[max(at - 2, 0):at + CHUNK]  # two code points of the piece before, so that no run is lost
        c = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
        high = c >= len(letters)
        c = letters[np.where(high, 32, c)] if not high.any() else np.where(
            high, np.array([ord(x.lower()[0]) if x.isalpha() else 32 for x in part], np.uint32), letters[np.where(high, 32, c)])
        found = found or bool((c != 32).any())
        c = np.concatenate(([32], c, [32])).astype(np.uint32)
        # runs of white space count once
        c = c[np.concatenate(([True], (c[1:] != 32) | (c[:-1] != 32)))]
        one = c * np.uint32(2654435761)
        two = (one[:-1] ^ (c[1:] + np.uint32(0x9E37))) * np.uint32(2246822519)
        three = (two[:-1] ^ (c[2:] + np.uint32(0x79B9))) * np.uint32(3266489917)
        for h in (one, two, three):
            total += np.bincount(h >> np.uint32(32 - BITS), minlength=1 << BITS)
    return total if found else None


@dataclass
class LanguageModel:
    names: list[str]
    idf: np.ndarray
    weights: np.ndarray  # features x languages
    temperature: float

    def logits(self, counts: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(counts)
        value = np.log1p(counts[at]) * self.idf[at]
        return (value / max(float(np.sqrt(value @ value)), 1e-12)) @ self.weights[at]


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max())
    return e / e.sum()


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, *, alpha: float = 0.5, beta: float = 1.0,
          l1: float = 0.02, l2: float = 0.1, epochs: int = 4, seed: int = 1) -> np.ndarray:
    """Follow-the-regularised-leader (proximal, elastic net) over rows of (features, values, class)."""
    z, n = np.zeros((1 << BITS, classes)), np.zeros((1 << BITS, classes))
    w, rng = np.zeros((1 << BITS, classes)), np.random.default_rng(seed)
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            at, value, label = rows[k]
            p = softmax(value @ w[at])
            p[label] -= 1
            g = value[:, None] * p[None, :]
            square = n[at] + g * g
            z[at] += g - (np.sqrt(square) - np.sqrt(n[at])) / alpha * w[at]
            n[at] = square
            w[at] = np.where(np.abs(z[at]) <= l1, 0.0,
                             -(z[at] - np.sign(z[at]) * l1) / ((beta + np.sqrt(square)) / alpha + l2))
    return w


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits under which held-back labels are likeliest, by a refined grid."""
    def loss(t: float) -> float:
        z = logits / t
        z = z - z.max(axis=1, keepdims=True)
        return float((np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(labels)), labels]).mean())

    low, high = -4.0, 4.0
    for _ in range(6):
        grid = np.linspace(low, high, 17)
        best = int(np.argmin([loss(float(np.exp(t))) for t in grid]))
        low, high = grid[max(best - 1, 0)], grid[min(best + 1, 16)]
    return float(np.exp((low + high) / 2))


def learn(docs: DataFrame, *, text_col: str = "text", label_col: str = "lang", per_class: int = 800,
          max_rows: int = 20_000, max_languages: int = 1000, **options) -> LanguageModel | None:
    """Model of the labelled rows: document frequencies over all of them, weights from a bounded sample."""
    known = docs.where(F.col(label_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(text_col).alias("text"), F.col(label_col).cast("string").alias("label"))
    # labels, their sizes and the draw come from one pass, the document frequencies from another
    keys = durable(known.select("label", F.xxhash64("text", F.lit(11)).alias("h")).distinct())
    sizes = {r["label"]: r["count"] for r in keys.groupBy("label").count().limit(max_languages + 1).collect()}
    names = list(sizes)
    if not names:
        return None
    if len(names) > max_languages:
        raise ValueError(f"more than {max_languages} labels; give a larger max_languages or fewer labels")
    bound = max(1, min(per_class, max_rows // len(names)))
    names.sort()

    def frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        letters, held, n = letters_below(), np.zeros(1 << BITS, np.int64), 0
        for batch in batches:
            for text in batch["text"]:
                counts = ngram_counts(text, letters)
                if counts is not None:
                    held += counts > 0
                    n += 1
        at = np.flatnonzero(held)
        yield pd.DataFrame({"feature": np.append(at, -1), "documents": np.append(held[at], n)})  # bounded by the features

    idf_rows = (known.select("text").mapInPandas(frequencies, "feature int, documents long")
                .groupBy("feature").agg(F.sum("documents").alias("documents")).collect())
    count = {r["feature"]: r["documents"] for r in idf_rows}
    idf = np.log((1.0 + count.get(-1, 0)) / (1.0 + np.array([count.get(k, 0) for k in range(1 << BITS)]))) + 1.0

    # the smallest hashes of each label's distinct texts; a threshold well above them keeps the ranked rows few
    below = F.create_map(*(F.lit(v) for name in names for v in (
        name, min(2 ** 63 - 1, -2 ** 63 + 2 ** 64 * (2 * bound + 100) // max(sizes[name], 1)))))
    rank = F.row_number().over(Window.partitionBy("label").orderBy("h"))
    drawn = durable(keys.where(F.col("h") <= F.element_at(below, F.col("label"))).withColumn("rank", rank)
                    .where(F.col("rank") <= bound).select("label", "h"))
    of_label = Window.partitionBy("label", "h").orderBy("text")
    sample = (known.withColumn("h", F.xxhash64("text", F.lit(11))).join(F.broadcast(drawn), ["label", "h"])
              .withColumn("copy", F.row_number().over(of_label)).where("copy = 1").select("text", "label"))

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        letters = letters_below()
        for batch in batches:
            found = [(label, c) for label, t in zip(batch["label"], batch["text"]) if (c := ngram_counts(t, letters)) is not None]
            yield pd.DataFrame({"label": [f[0] for f in found], "at": [np.flatnonzero(f[1]).astype("i4") for f in found],
                                "n": [f[1][f[1] > 0].astype("i4") for f in found]})

    got = sample.mapInPandas(features, "label string, at array<int>, n array<int>").toPandas()
    place = {name: k for k, name in enumerate(names)}
    rows = []
    for label, at, n in zip(got["label"], got["at"], got["n"]):
        at = np.asarray(at, np.int64)
        value = np.log1p(np.asarray(n, np.float64)) * idf[at]
        rows.append((at, value / max(float(np.sqrt(value @ value)), 1e-12), place[label]))
    rows.sort(key=lambda r: (r[2], len(r[0]), float(r[1].sum()), float(r[0].sum())))  # reruns agree
    held = [r for k, r in enumerate(rows) if k % 5 == 4]
    used = [r for k, r in enumerate(rows) if k % 5 != 4]
    if not used:
        return None
    weights = train(used, len(names), **options)
    logits = np.array([v @ weights[at] for at, v, _ in held]).reshape(len(held), len(names))
    warmth = temperature(logits, np.array([r[2] for r in held])) if held else 1.0
    return LanguageModel(names, idf, weights, warmth)


def predicted(text: Column, model: LanguageModel | None) -> Column:
    """struct(lang_pred, score) of a text."""
    if model is None:
        return F.struct(F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))

    @F.pandas_udf("lang_pred string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        letters = letters_below()
        for batch in batches:
            names, scores = [], []
            for t in batch:
                counts = ngram_counts(t, letters) if isinstance(t, str) else None
                if counts is None:
                    names.append("und")
                    scores.append(0.0)
                else:
                    p = softmax(model.logits(counts) / model.temperature)
                    names.append(model.names[int(p.argmax())])
                    scores.append(float(p.max()))
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    return run(text)


def identify(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang",
             folds: int = 4, held_fold: int = 2, **options) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score; documents of the held-out fold are not learned from."""
    fold = F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(folds))
    model = learn(docs.where(fold != held_fold), text_col=text_col, label_col=label_col, **options)
    return (docs.select(F.col(id_col).alias("doc_id"), F.coalesce(fold == held_fold, F.lit(False)).alias("held_out"),
                        predicted(F.col(text_col), model).alias("p"))
            .select("doc_id", "held_out", "p.lang_pred", "p.score"))


ship_by_value(__name__)
