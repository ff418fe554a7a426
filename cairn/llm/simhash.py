"""SimHash near-duplicates by a byte-position inverted index with count filtering.

Two 64-bit fingerprints within ``max_bits`` (at most 3) differ in as many bytes at most, so they share at least
``8 - max_bits`` of their eight positional bytes.  A posting list per single byte would hold a 256th of all documents, and
its pairs would grow with their square.  The index therefore keys a fingerprint by the fourteen sets of four positions
whose numbers xor to zero (the Steiner system S(3,4,8)): whichever three positions differ, one of the sets avoids them,
so every pair within reach meets in a list, and lists are 32 bits narrow.  Within a list the shared positional bytes of
each pair are tallied byte position by byte position; pairs under the guaranteed minimum go, only the rest are verified by
their bit distance, and only a forest of the list's links leaves the task.  A list of more than ``list_limit`` fingerprints is dealt to four
narrower lists by further equal bits (at most three of four blocks can differ), and so on until at most 14 bits are
free: the last lists are bounded by their 16,384 possible fingerprints.

Defined results: null, empty and word-less texts have fingerprint zero and link like any other; null ids never name a
component while another id is there; repeated rows are copies; extra columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.llm.common import connected_components, dealt_join
from cairn.operators.prefix import durable, task_count
from cairn.session import ship_by_value

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}
#: Words of a text taken at a time.
CHUNK = 32_768


def fingerprint(text: str | None, shingle: int) -> int:
    """Majority vote of the XXH64 (seed 42) of all word shingles of a whole text, as an unsigned integer."""
    import xxhash

    if not text:
        return 0
    votes, total, tail = np.zeros(64, np.int64), 0, []
    found = (m.group() for m in WORDS.finditer(text.translate(LOWER)))
    while True:
        words = tail + list(itertools.islice(found, CHUNK))
        count = len(words) - shingle + 1
        if count <= 0:
            if total or not words:
                break
            parts = [" ".join(words)]  # fewer words than a shingle: the whole sequence
        else:
            parts = [" ".join(words[i:i + shingle]) for i in range(count)]
        h = np.fromiter((xxhash.xxh64_intdigest(p, 42) for p in parts), np.dtype(">u8"), len(parts))
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        total += len(parts)
        if count <= 0:
            break
        tail = words[count:]
    return int.from_bytes(np.packbits(2 * votes > total).tobytes(), "big") if total else 0


def fingerprint_column(text: Column, shingle: int = 3) -> Column:
    """Fingerprint as a signed 64-bit long."""

    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([fingerprint(t, shingle) for t in batch], dtype=np.uint64).astype(np.int64)

    return run(text)


def position_masks() -> list[int]:
    """The fourteen masks of four of the eight bytes, as signed longs."""
    sets = [s for s in itertools.combinations(range(8), 4) if s[0] ^ s[1] ^ s[2] ^ s[3] == 0]
    masks = [sum(255 << (8 * p) for p in s) for s in sets]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def narrower(mask: int) -> list[int]:
    """``mask`` with a quarter of its free bits added, four ways."""
    mask %= 1 << 64
    free = [b for b in range(64) if not (mask >> b) & 1]
    quarters = [free[len(free) * k // 4:len(free) * (k + 1) // 4] for k in range(4)]
    out = [mask | sum(1 << b for b in q) for q in quarters]
    return [m - (1 << 64) if m >> 63 else m for m in out]


def tally(values: np.ndarray, a: int, b: int) -> np.ndarray:
    """How many positional bytes each of the rows a..b shares with each value: a posting list per byte position."""
    shared = np.zeros((b - a, len(values)), np.uint8)
    for byte in values.view(np.uint8).reshape(-1, 8).T:
        shared += byte[a:b, None] == byte[None, :]
    return shared


def near_pairs(values: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(i, j, verified): index pairs i < j within ``max_bits``, and how many pairs the tally left to verify.

    Only pairs with the guaranteed minimum of shared bytes are compared bit by bit.
    """
    found, verified, step = [], 0, max(1, 4_000_000 // len(values))
    for a in range(0, len(values), step):
        i, j = np.nonzero(tally(values, a, min(a + step, len(values))) >= 8 - max_bits)
        i += a
        i, j = i[i < j], j[i < j]
        verified += len(i)
        near = np.bitwise_count(values[i] ^ values[j]) <= max_bits
        found.append((i[near], j[near]))
    return np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found]), verified


def forest(values: np.ndarray, max_bits: int) -> np.ndarray:
    """For distinct sorted fingerprints: index of the smallest one that links reach within the list."""
    i, j, _ = near_pairs(values, max_bits)
    label = np.arange(len(values))
    while len(i):
        before = label.copy()
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if (label == before).all():
            break
    return label


def _lists(batches: Iterator[pd.DataFrame], max_bits: int, list_limit: int) -> Iterator[pd.DataFrame]:
    """Links (a, b) of each run of equal (mask, key); runs that are too long leave again under narrower masks."""
    columns = ["a", "b", "mask"]

    def close(mask: int, run: list[np.ndarray], hot: bool) -> Iterator[pd.DataFrame]:
        if not run:
            return
        fp = np.concatenate(run)
        if hot:
            for m in narrower(mask):
                yield pd.DataFrame({"a": fp, "b": fp, "mask": m}, columns=columns)
        elif len(fp) > 1:
            label = forest(fp.view(np.uint64), max_bits)
            i = np.flatnonzero(label != np.arange(len(fp)))
            if len(i):
                yield pd.DataFrame({"a": fp[i], "b": fp[label[i]], "mask": 0}, columns=columns)

    at, run, size, hot = None, [], 0, False
    for batch in batches:
        mask, key, fp = (batch[c].to_numpy() for c in ("mask", "key", "fp"))
        edge = np.flatnonzero((mask[1:] != mask[:-1]) | (key[1:] != key[:-1])) + 1
        begins, ends = np.concatenate(([0], edge)), np.concatenate((edge, [len(fp)]))
        some = ends - begins > 1  # a run of one has no pair, unless it goes on in another batch
        some[[0, -1]] = True
        for a, b in zip(begins[some].tolist(), ends[some].tolist()):
            here = (int(mask[a]), int(key[a]))
            if here != at:
                if at is not None:
                    yield from close(at[0], run, hot)
                at, run, size, hot = here, [], 0, False
            run.append(fp[a:b])
            size += b - a
            if size > list_limit and 64 - (here[0] % (1 << 64)).bit_count() > 14:
                hot = True
            if hot:  # passed on as it comes
                yield from close(at[0], run, True)
                run, size = [], list_limit + 1
    if at is not None and run:
        yield from close(at[0], run, hot)


def links(fingerprints: DataFrame, *, max_bits: int = 3, list_limit: int = 2048) -> DataFrame:
    """Links a, b that connect the distinct fingerprints (column ``fp``) as all pairs within ``max_bits`` would."""
    if not 0 <= max_bits <= 3:
        raise ValueError("max_bits must lie in 0..3")
    entry = F.explode(F.array(*(F.struct(F.lit(m).cast("long").alias("mask"),
                                         F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for m in position_masks())))
    index = fingerprints.select("fp", entry.alias("x")).select("fp", "x.mask", "x.key")
    width, found = task_count(fingerprints.sparkSession), None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _lists(batches, max_bits, list_limit)

    while True:  # a second round only where a list was too long; five at most, by the free bits
        out = durable(index.repartition(width, "mask", "key").sortWithinPartitions("mask", "key", "fp")
                      .mapInPandas(run, "a long, b long, mask long"))
        part = out.where("mask = 0").select("a", "b")
        found = part if found is None else found.union(part)
        again = out.where("mask != 0")
        if again.isEmpty():
            return found.distinct()
        index = again.select(F.col("a").alias("fp"), "mask", F.col("a").bitwiseAND(F.col("mask")).alias("key")).distinct()


def near_duplicates(docs: DataFrame, *, shingle: int = 3, max_bits: int = 3, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, key (hash of its text), fp, root (fingerprint naming the component), component_id.

    Copies are one fingerprint before anything is compared; documents meet their component by joins that deal out
    the documents of a hot fingerprint and the fingerprints of a hot component.
    """
    rows = durable(docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("key"),
                               fingerprint_column(F.col(text_col), shingle).alias("fp")))
    distinct = durable(rows.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("n")))
    comp = connected_components(links(distinct.select("fp"), max_bits=max_bits))
    near = durable(distinct.join(comp.withColumnsRenamed({"node": "fp", "root": "r"}), "fp", "left").withColumn(
        "root", F.coalesce("r", "fp")).drop("r"))
    lowest = durable(near.groupBy("root").agg(F.min("low").alias("component_id"), F.count(F.lit(1)).alias("m")))
    named = durable(dealt_join(near.select("fp", "root", "n"), lowest, ["root"], "m"))
    return dealt_join(rows, named, ["fp"], "n")


def drop_near_duplicates(docs: DataFrame, *, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """``docs`` with one document of each group: the one of the smallest id (null ids last, ties by text hash)."""
    rows = near_duplicates(docs, shingle=shingle, max_bits=max_bits)
    kept = rows.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("k")).select(
        F.col("k.doc_id").alias("__id"), F.col("k.key").alias("__key"))
    keyed = docs.withColumn("__hash", F.xxhash64("text"))
    same = (F.col("__hash") == F.col("__key")) & F.col("doc_id").eqNullSafe(F.col("__id"))
    return keyed.join(kept, same, "left_semi").dropDuplicates(["__hash", "doc_id"]).drop("__hash")


ship_by_value(__name__)
