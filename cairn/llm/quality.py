"""Quality classifier: ordinal cumulative-link regression on graded ratings over hashed text.

``P(grade <= k) = sigmoid(threshold_k - w . x)``: one weight vector for all grades, ordered thresholds.  ``x`` marks the
hashed tokens that a text holds (runs of letters and their first four letters, runs of digits, single symbols; lower
case), and whether it stutters.  Weights get an L1 penalty, so words without evidence weigh nothing, however long a text is.  The expected grade
and the tail probability ``P(grade >= k)`` follow; selection is by the tail.

The fit uses at most ``per_grade`` rated documents of each grade (a documented bound; drawn by hash), scoring every whole
text.  Defined results: null texts and texts without a token have expected grade 0 and tail 0; documents with several
ratings count with the lowest; ratings with a null grade or id are ignored; without ratings of two grades nothing can be
learned, every tail is 1 and every document is kept; repeated rows are scored each; extra columns are ignored.
"""

from __future__ import annotations

import operator
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cairn.session import ship_by_value

TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]|_")
BITS = 18
#: Marks a text of which eight tokens and over a twentieth of all repeat the one before.
AGAIN = "\n again"
#: Code points of a text taken at a time, tokens kept in a worker's memory.
CHUNK, KEPT = 1_000_000, 400_000


def hashed_tokens(text: str, known: dict[str, tuple[int, ...]]) -> np.ndarray:
    """The hashed features that a whole text holds, each once."""
    seen: set[str] = set()
    at = again = total = 0
    while at < len(text):
        end = at + CHUNK
        if end < len(text):  # end a piece before a white space
            space = text.rfind(" ", at, end)
            end = space if space > at else end
        tokens = TOKEN.findall(text[at:end].lower())
        again += sum(map(operator.eq, tokens, tokens[1:]))
        total += len(tokens)
        seen.update(tokens)
        at = end
    if again >= 8 and 20 * again > total:
        seen.add(AGAIN)
    if len(known) > KEPT:
        known.clear()
    mask, held = (1 << BITS) - 1, set()
    for token in seen:
        k = known.get(token)
        if k is None:
            k = (zlib.crc32(token.encode()) & mask,)
            if len(token) > 4:
                k += (zlib.crc32(b"^" + token[:4].encode()) & mask,)
            known[token] = k
        held.update(k)
    return np.fromiter(held, np.int64, len(held))


@dataclass
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one less than grades

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ..."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -500, 500)))


def telling(rows: list[np.ndarray], grade: np.ndarray, times: np.ndarray, evidence: float, lift: float) -> np.ndarray:
    """Features that tell grades apart: likelihood-ratio statistic G2 of presence by grade above ``evidence``, and in one
    grade at least ``lift`` times as frequent as over all grades.  Words that merely follow a text's length fail the latter."""
    size = np.bincount(grade, times)
    flat, row = np.concatenate(rows), np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    used, column = np.unique(flat, return_inverse=True)
    held = np.stack([np.bincount(column, times[row] * (grade[row] == g), len(used)) for g in range(len(size))], axis=1)
    g2, mean = np.zeros(len(used)), held.sum(axis=1) / size.sum()
    for table, share in ((held, mean), (size - held, 1 - mean)):
        expected = np.maximum(share[:, None] * size, 1e-12)
        g2 += 2 * np.where(table > 0, table * np.log(np.maximum(table, 1e-12) / expected), 0).sum(axis=1)
    rate = held / np.maximum(size, 1)
    return used[(g2 > evidence) & (rate.max(axis=1) > lift * rate.mean(axis=1))]


def fit(rows: list[np.ndarray], grade: np.ndarray, prior: list[float], times: np.ndarray | None = None, *, evidence: float = 12.0, lift: float = 1.8, l1: float = 2e-4,
        steps: int = 600, rate: float = 0.2) -> OrdinalModel:
    """Proximal gradient steps with a step size per weight (Adagrad), over the features that tell grades apart.

    ``prior``: the share of each grade among all ratings; the sample may hold others.  ``times``: ratings of each row.
    """
    times = np.ones(len(grade)) if times is None else np.asarray(times, float)
    used, grades = telling(rows, grade, times, evidence, lift), int(grade.max()) + 1
    kept = [np.searchsorted(used, r[np.isin(r, used)]) for r in rows]
    column = np.concatenate(kept)
    row = np.repeat(np.arange(len(rows)), [len(r) for r in kept])
    share = np.bincount(grade, times, grades)
    weight = (np.asarray(prior) / np.maximum(share, 1))[grade] * times  # as common as among all ratings
    below = np.clip(np.cumsum(prior)[:-1], 1e-6, 1 - 1e-6)
    theta = np.log(below / (1 - below))  # what the grades' shares alone say
    sigmoid = lambda v: 1 / (1 + np.exp(-np.clip(v, -40, 40)))
    w, square, tsquare = np.zeros(len(used)), np.full(len(used), 1e-10), np.full(grades - 1, 1e-10)
    for _ in range(steps):
        s = np.bincount(row, w[column], len(rows))
        cut = np.concatenate(([-np.inf], theta, [np.inf]))
        up, down = sigmoid(cut[grade + 1] - s), sigmoid(cut[grade] - s)
        p = np.maximum(up - down, 1e-9)
        gu, gd = up * (1 - up), down * (1 - down)
        g = np.bincount(column, (weight * (gu - gd) / p)[row], len(used))  # of minus log p by the weights
        gt = np.array([(-weight * gu / p)[grade == k].sum() + (weight * gd / p)[grade == k + 1].sum()
                       for k in range(grades - 1)])
        square += g * g
        tsquare += gt * gt
        step = rate / np.sqrt(square)
        w = w - step * g
        w = np.sign(w) * np.maximum(np.abs(w) - step * l1, 0)
        theta = np.maximum.accumulate(theta - rate / np.sqrt(tsquare) * gt)
    full = np.zeros(1 << BITS)
    full[used] = w
    return OrdinalModel(full, theta)


def learn(docs: DataFrame, ratings: DataFrame, *, grade_col: str = "grade", id_col: str = "doc_id",
          text_col: str = "text", per_grade: int = 2000, **options) -> OrdinalModel | None:
    """Model of a bounded sample of rated documents; None without two grades."""
    rated = (ratings.select(F.col(id_col).alias("__id"), F.col(grade_col).cast("int").alias("__grade"))
             .where("__id is not null and __grade is not null").groupBy("__id").agg(F.min("__grade").alias("__grade")))
    number = {r[0]: r[1] for r in rated.groupBy("__grade").count().collect()}  # one row per grade
    if len(number) < 2:
        return None
    # smallest hashes of each grade, twice as many as are used: copies of a text take one place, and weigh as often as drawn
    drawn = F.row_number().over(Window.partitionBy("__grade").orderBy(F.xxhash64("__id", F.lit(7)), "__id"))
    sample = rated.withColumn("__r", drawn).where(F.col("__r") <= 2 * per_grade).drop("__r")
    texts = docs.join(F.broadcast(sample), F.col(id_col) == F.col("__id")).select(
        F.col(text_col).alias("text"), F.col("__grade").alias("grade"), F.xxhash64(text_col, F.lit(7)).alias("h"))
    place = F.row_number().over(Window.partitionBy("grade").orderBy("h"))
    texts = (texts.groupBy("grade", "h").agg(F.min("text").alias("text"), F.count(F.lit(1)).alias("times"))
             .withColumn("place", place).where(F.col("place") <= per_grade).select("grade", "text", "times"))

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, tuple[int, ...]] = {}
        for batch in batches:
            found = [np.sort(hashed_tokens(t, known)) if isinstance(t, str) else np.zeros(0) for t in batch["text"]]
            yield pd.DataFrame({"grade": batch["grade"], "times": batch["times"], "at": [f.astype("i4") for f in found]})

    got = texts.mapInPandas(features, "grade int, times long, at array<int>").toPandas()
    rank = {g: k for k, g in enumerate(sorted(number))}
    rows = sorted((rank[g], tuple(a), n) for g, a, n in zip(got["grade"], got["at"], got["times"]) if len(a))  # reruns agree
    grade = np.array([r[0] for r in rows])
    if len(set(grade.tolist())) < 2:
        return None
    total = sum(number.values())
    prior = [number[g] / total for g in sorted(number)]
    return fit([np.asarray(r[1], np.int64) for r in rows], grade, prior, np.array([r[2] for r in rows]), **options)


def scores(text: Column, model: OrdinalModel | None) -> Column:
    """struct(expected_grade, tails): tails[k - 1] = P(grade >= k)."""
    if model is None:
        return F.struct(F.lit(None).cast("double").alias("expected_grade"),
                        F.array(F.lit(1.0)).alias("tails"))

    @F.pandas_udf("expected_grade double, tails array<double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known: dict[str, tuple[int, ...]] = {}
        for batch in batches:
            s = np.full(len(batch), np.nan)
            for k, t in enumerate(batch):
                if isinstance(t, str):
                    at = hashed_tokens(t, known)
                    if len(at):
                        s[k] = float(model.weights[at].sum())
            tails = model.tails(np.nan_to_num(s))
            tails[np.isnan(s)] = 0.0
            yield pd.DataFrame({"expected_grade": tails.sum(axis=1), "tails": list(tails)})

    return run(text)


def grade_documents(docs: DataFrame, ratings: DataFrame, *, at_least: int | None = None, tail: float = 0.5,
                    text_col: str = "text", **options) -> DataFrame:
    """``docs`` with expected_grade, tail_probability (of the grade ``at_least``, by default the best) and kept.

    Columns of ``docs`` that have one of these three names are replaced; all others are passed on.
    """
    model = learn(docs, ratings, text_col=text_col, **options)
    out = docs.withColumn("__s", scores(F.col(text_col), model))
    place = F.lit(-1) if at_least is None or model is None else F.lit(at_least)
    return (out.withColumn("expected_grade", F.col("__s.expected_grade"))
            .withColumn("tail_probability", F.element_at("__s.tails", place))
            .withColumn("kept", F.col("tail_probability") >= tail).drop("__s"))


def graded_labels(labels: DataFrame) -> DataFrame:
    """The given two labels as three grades: 0 toxic, 1 poor, 2 good."""
    return labels.select("doc_id", F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(
        (F.col("quality") == 1) & (F.col("toxic") == 0), 2).alias("grade"))


ship_by_value(__name__)
