"""Collocations counted by quotient filters.

Texts are cut into words once, chunk by chunk (about ``chunk_bytes`` of text of one language, whole texts only), as numbers
of the chunk's own vocabulary; word counts are summed from these vocabularies, range by range of a checksum, and the words
with at least ``min_count`` occurrences get global ids.  Then, level by level, the m-word phrases are counted whose both
(m - 1)-word parts are frequent; no other phrase can be:

* a chunk packs the ids of each phrase and permutes them by an invertible Feistel network of their m digits.  The first
  permuted digit is the quotient, the other m - 1 are the full remainder, so a counter stands for one phrase exactly.
  The chunk's filter is its sorted quotients (as differences), remainders and counts;
* the quotients' space is cut into ranges.  Sorted filters of all chunks are merged range by range; the permutation makes
  ranges equal, and a very common phrase is one counter per chunk;
* each chunk learns which of its counters are frequent in all, and keeps the runs of words in which every m-word phrase is.

A chunk and a range hold a bounded number of words, so every task does.  Scores use exact decimals.

Defined results: null and empty texts have no words; null languages are ``und``; rows with null ids count; repeated rows
count again; a language without candidates has no rows; ties of the score go to more occurrences, then to the phrase in
byte order; extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cairn.operators.combine import broadcast_if_small
from cairn.operators.prefix import durable, task_count
from cairn.session import ship_by_value

#: Bytes between pieces, and between words of a piece (fixed by the task).
PIECE_ENDS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
ROUNDS = 3
#: Windows that are permuted at a time, and the most ranges (each chunk has a row in each).
SLICE, MOST_RANGES = 2 ** 18, 2 ** 14


def packed(a: np.ndarray) -> bytes:
    """Numbers as compressed byte planes: the high bytes, mostly zero, come together and vanish."""
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T if len(a) else np.zeros((0, 0), np.uint8)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpacked(b: bytes, dtype: str, n: int) -> np.ndarray:
    dtype = np.dtype(dtype)
    raw = pa.decompress(b, decompressed_size=n * dtype.itemsize, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(dtype.itemsize, n).T).view(dtype).reshape(n)


def packed_words(words: list[bytes]) -> bytes:
    lines = b"\n".join(words)
    return len(lines).to_bytes(8, "little") + pa.compress(lines, codec="zstd", asbytes=True)


def unpacked_words(b: bytes) -> list[bytes]:
    size = int.from_bytes(b[:8], "little")
    return pa.decompress(b[8:], decompressed_size=size, codec="zstd", asbytes=True).split(b"\n") if size else []


def joined(parts: list[bytes]) -> bytes:
    return b"".join(len(x).to_bytes(4, "little") + x for x in parts)


def parted(data: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(data):
        size = int.from_bytes(data[at:at + 4], "little")
        out.append(data[at + 4:at + 4 + size])
        at += 4 + size
    return out


def by_frequency(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids as their ranks (from 1; 0 stays) in falling frequency, which compress best, and the id of each rank."""
    counts = np.bincount(ids, minlength=1)
    counts[0] = 0
    used = np.flatnonzero(counts)
    used = used[np.argsort(-counts[used], kind="stable")]
    rank = np.zeros(len(counts), np.uint32)
    rank[used] = np.arange(1, len(used) + 1)
    return rank[ids], used


def packed_ids(ids: np.ndarray) -> bytes:
    ranks, used = by_frequency(ids)
    return joined([len(used).to_bytes(8, "little"), packed(used.astype("<u4")), packed(ranks)])


def unpacked_ids(data: bytes, n: int) -> np.ndarray:
    size, used, ranks = parted(data)
    used = unpacked(used, "<u4", int.from_bytes(size, "little"))
    return np.concatenate((np.zeros(1, np.uint32), used))[unpacked(ranks, "<u4", n)]


def split_words(text: bytes) -> tuple[list[bytes], np.ndarray]:
    """Words of a text, lower-cased in A-Z, and the number of the piece that each is in."""
    text = text.lower()  # of bytes: A-Z alone
    raw = np.frombuffer(text, np.uint8)
    kind = np.zeros(256, np.uint8)
    kind[list(BLANKS)] = 1
    kind[list(PIECE_ENDS)] = 2
    kind = kind[raw]
    starts = np.flatnonzero((kind == 0) & np.r_[True, kind[:-1] > 0]) if len(raw) else np.zeros(0, int)
    words = text.translate(bytes(32 if b in BLANKS + PIECE_ENDS else b for b in range(256))).split(b" ")
    return [w for w in words if w], np.cumsum(kind == 2, dtype=np.int64)[starts]


class Chunk:
    """Words of one language as numbers of an own vocabulary; 0 stands between pieces."""

    def __init__(self) -> None:
        self.words: dict[bytes, int] = {}
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, texts: list[bytes]) -> None:
        words, piece = split_words(b"\n".join(texts))
        known = self.words
        for w in dict.fromkeys(words):
            known.setdefault(w, len(known) + 1)
        ids = np.fromiter(map(known.__getitem__, words), np.int32, len(words))
        self.parts += [np.insert(ids, np.flatnonzero(np.diff(piece)) + 1, 0), np.zeros(1, np.int32)]
        self.size += sum(map(len, texts))


def chunks_of(texts: DataFrame, chunk_bytes: int) -> DataFrame:
    """chunk, lang, n (words), size, ids, vocabulary (words, a line each), counts: the whole corpus as chunks."""
    schema = "chunk long, lang string, n long, size long, ids binary, vocabulary binary, counts binary"
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        task, number, held = TaskContext.get().partitionId(), 0, {}

        def close(lang: str) -> pd.DataFrame:
            nonlocal number
            c = held.pop(lang)
            ids = np.concatenate(c.parts)
            ids, used = by_frequency(ids)
            words, counts = list(c.words), np.bincount(ids, minlength=len(used) + 1)[1:]
            number += 1
            row = (task * 2 ** 32 + number, lang, int(counts.sum()), len(ids), packed(ids),
                   packed_words([words[k - 1] for k in used]), packed(counts))
            return pd.DataFrame([row], columns=names)

        for batch in batches:
            for lang, group in batch.groupby("lang", sort=False):
                given, at = group["text"].tolist(), 0
                while at < len(given):  # about a megabyte at a time, one text at least
                    end, size = at, 0
                    while end < len(given) and (end == at or size + len(given[end]) < min(chunk_bytes, 1_000_000)):
                        size += len(given[end])
                        end += 1
                    chunk = held.setdefault(lang, Chunk())
                    chunk.add(given[at:end])
                    at = end
                    if chunk.size >= chunk_bytes:
                        yield close(lang)
            while sum(c.size for c in held.values()) > 2 * chunk_bytes:  # many languages in one task
                yield close(max(held, key=lambda x: held[x].size))
        for lang in list(held):
            yield close(lang)

    return texts.mapInPandas(run, schema)


def word_ranges(batches: Iterator[pd.DataFrame], ranges: int) -> Iterator[pd.DataFrame]:
    """Each chunk's vocabulary cut by a checksum of the word: range, chunk, lang, words, places, counts."""
    for batch in batches:
        for chunk, lang, vocabulary, counts in zip(*(batch[c] for c in ("chunk", "lang", "vocabulary", "counts"))):
            words = unpacked_words(vocabulary)
            counts = unpacked(counts, "<i8", len(words))
            to = np.fromiter((zlib.crc32(w) % ranges for w in words), np.int64, len(words))
            order = np.argsort(to, kind="stable")
            edges = np.searchsorted(to[order], np.arange(ranges + 1))
            rows = []
            for r in np.flatnonzero(np.diff(edges)):
                at = order[edges[r]:edges[r + 1]]
                rows.append((int(r), chunk, lang, len(at), packed_words([words[k] for k in at]), packed(at), packed(counts[at])))
            yield pd.DataFrame(rows, columns=["range", "chunk", "lang", "size", "words", "places", "counts"])


def merge_words(pdf: pd.DataFrame, min_count: int) -> pd.DataFrame:
    """The frequent words of a range, ranked, and for each chunk the ranks of those that it has (places, ranks)."""
    rows, back, rank = [], [], 0
    for lang, part in pdf.groupby("lang", sort=True):
        sizes = part["size"].to_numpy(np.int64)
        codes, words = pd.factorize(np.array([w for x in part["words"] for w in unpacked_words(x)], object))
        totals = np.zeros(len(words), np.int64)
        np.add.at(totals, codes, np.concatenate([unpacked(c, "<i8", int(n)) for c, n in zip(part["counts"], sizes)]))
        often = np.flatnonzero(totals >= min_count)
        often = often[np.argsort(words[often])]  # ranks do not depend on the order of arrival
        ranks = np.full(len(words), -1, np.int64)
        ranks[often] = rank + np.arange(len(often))
        rows += [(None, lang, int(ranks[k]), words[k], int(totals[k]), None, None, None) for k in often]
        rank += len(often)
        for chunk, n, places, own in zip(part["chunk"], sizes, part["places"], np.split(codes, np.cumsum(sizes)[:-1])):
            has = ranks[own] >= 0
            if has.any():
                back.append((int(chunk), lang, None, None, None, int(has.sum()), packed(unpacked(places, "<i8", int(n))[has]),
                             packed(ranks[own][has])))
    out = pd.DataFrame(rows + back, columns=["chunk", "lang", "rank", "word", "f", "size", "places", "ranks"])
    out["range"] = int(pdf["range"].iloc[0])
    return out.astype({c: "Int64" for c in ("chunk", "rank", "f", "size")})


def permute(digits: list[np.ndarray], bits: int, back: bool = False) -> list[np.ndarray]:
    """An invertible mix of m >= 2 digits of ``bits`` bits each: every step xors one digit with a hash of the others."""
    digits, m = [d.astype(np.uint64) for d in digits], len(digits)
    steps = [(r, i) for r in range(ROUNDS) for i in range(m)]
    for r, i in reversed(steps) if back else steps:
        h = np.full(len(digits[0]), 0x9E3779B97F4A7C15 * (r * m + i + 1) % 2 ** 64, np.uint64)
        for j in range(m):
            if j != i:
                h = (h ^ digits[j]) * np.uint64(0xD6E8FEB86659FD93)
                h ^= h >> np.uint64(32)
        digits[i] = digits[i] ^ (h & np.uint64(2 ** bits - 1))
    return digits


def limbs_of(digits: list[np.ndarray], bits: int) -> list[np.ndarray]:
    """The digits in as few 64-bit numbers as hold them, the first digit leading."""
    per, out = 64 // bits, []
    for a in range(0, len(digits), per):
        x = np.zeros(len(digits[0]), np.uint64)
        for d in digits[a:a + per]:
            x = (x << np.uint64(bits)) | d.astype(np.uint64)
        out.append(x)
    return out


def digits_of(limbs: list[np.ndarray], m: int, bits: int) -> list[np.ndarray]:
    per, out = 64 // bits, []
    for k, x in enumerate(limbs):
        held = min(per, m - k * per)
        out += [(x >> np.uint64(bits * (held - 1 - j))) & np.uint64(2 ** bits - 1) for j in range(held)]
    return out


def sorted_groups(limbs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order of the keys, and where a new key starts in it."""
    order = np.argsort(limbs[0], kind="stable") if len(limbs) == 1 else np.lexsort(limbs[::-1])
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([x[order[1:]] != x[order[:-1]] for x in limbs])
    return order, new


class QuotientFilter:
    """Sorted permuted keys with counts; kept as differences of quotients, full remainders and counts."""

    def __init__(self, limbs: list[np.ndarray], counts: np.ndarray, m: int, bits: int) -> None:
        self.limbs, self.counts, self.m, self.bits = limbs, counts, m, bits

    @classmethod
    def of(cls, limbs: list[np.ndarray], m: int, bits: int, weights: np.ndarray | None = None) -> QuotientFilter:
        order, new = sorted_groups(limbs)
        at = np.flatnonzero(new)
        counts = np.diff(np.r_[at, len(order)]) if weights is None else np.add.reduceat(weights[order], at) if len(at) else weights[:0]
        return cls([x[order[at]] for x in limbs], counts.astype(np.int64), m, bits)

    def quotients(self) -> np.ndarray:
        return digits_of(self.limbs[:1], min(self.m, 64 // self.bits), self.bits)[0]

    def low_bits(self) -> list[int]:
        """Bits of the remainder's part in each limb."""
        per = 64 // self.bits
        held = [min(per, self.m - k) for k in range(0, self.m, per)]
        return [(h - (k == 0)) * self.bits for k, h in enumerate(held)]

    def part(self, a: int, b: int) -> tuple[int, bytes]:
        """Number of keys and bytes of the keys a..b."""
        out = [packed(np.diff(self.quotients()[a:b], prepend=np.uint64(0)).astype("<u8"))]
        out += [packed((x[a:b] & np.uint64(2 ** low - 1)).astype("<u8")) for x, low in zip(self.limbs, self.low_bits())]
        out.append(packed(self.counts[a:b].astype("<u8")))
        return b - a, joined(out)

    @classmethod
    def read(cls, n: int, data: bytes, m: int, bits: int) -> QuotientFilter:
        blobs = parted(data)
        out = cls([], unpacked(blobs[-1], "<u8", n).astype(np.int64), m, bits)
        quotient = np.cumsum(unpacked(blobs[0], "<u8", n), dtype=np.uint64)
        rest = [unpacked(x, "<u8", n).astype(np.uint64) for x in blobs[1:-1]]
        out.limbs = [x | (quotient << np.uint64(low)) if k == 0 else x for k, (x, low) in enumerate(zip(rest, out.low_bits()))]
        return out


def windows(ids: np.ndarray, m: int, bits: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Places of all m-word windows without a 0, and their permuted keys (a slice at a time)."""
    n = max(len(ids) - m + 1, 0)
    fine = np.ones(n, bool)
    for j in range(m):
        fine &= ids[j:j + n] > 0
    at = np.flatnonzero(fine)
    slices = [at[a:a + SLICE] for a in range(0, len(at), SLICE)] or [at]
    parts = [limbs_of(permute([ids[x + j] for j in range(m)], bits), bits) for x in slices]
    return at, [np.concatenate(x) for x in zip(*parts)]


def runs_of(ids: np.ndarray, at: np.ndarray, m: int) -> np.ndarray:
    """The words of neighbouring windows of ``at`` as runs with a 0 after each; runs of one window are of no more use."""
    if not len(at):
        return ids[:0]
    first = np.r_[True, np.diff(at) > 1]
    begins = at[first]
    ends = at[np.r_[first[1:], True]] + m
    long = ends - begins > m
    begins, sizes = begins[long], (ends - begins)[long]
    if not len(begins):
        return ids[:0]
    out = np.zeros(int((sizes + 1).sum()), ids.dtype)
    place = np.cumsum(sizes + 1) - sizes - 1
    within = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[np.repeat(place, sizes) + within] = ids[np.repeat(begins, sizes) + within]
    return out


#: A chunk's words left ("words"), and its filter, by range ("filter").
STATE = "kind string, chunk long, lang string, range int, size long, data binary"


def chunk_rows(chunk: int, lang: str, ids: np.ndarray, m: int, bits: int, range_bits: int) -> Iterator[tuple]:
    """The chunk's words and its filter of m-word phrases."""
    _, limbs = windows(ids, m, bits)
    if not len(limbs[0]):
        return
    yield "words", chunk, lang, -1, len(ids), packed_ids(ids)
    f = QuotientFilter.of(limbs, m, bits)
    cut = f.quotients() >> np.uint64(bits - range_bits)
    edges = np.searchsorted(cut, np.arange(2 ** range_bits + 1, dtype=np.uint64))
    for r in np.flatnonzero(np.diff(edges)):
        yield "filter", chunk, lang, int(r), *f.part(int(edges[r]), int(edges[r + 1]))


def merge_range(pdf: pd.DataFrame, m: int, bits: int, min_count: int) -> tuple[QuotientFilter, np.ndarray, list[tuple]]:
    """The frequent phrases of a range, their languages, and for each chunk those of its keys that are frequent."""
    filters = [QuotientFilter.read(int(n), d, m, bits) for n, d in zip(pdf["size"], pdf["data"])]
    limbs = [np.concatenate(x) for x in zip(*(f.limbs for f in filters))]
    counts = np.concatenate([f.counts for f in filters])
    owner = np.repeat(np.arange(len(filters)), [len(f.counts) for f in filters])
    order, new = sorted_groups(limbs)
    at = np.flatnonzero(new)
    totals = np.add.reduceat(counts[order], at)
    often = totals >= min_count
    kept = order[often[np.cumsum(new) - 1]]
    back = []
    for k in np.unique(owner[kept]):
        own = np.sort(kept[owner[kept] == k])  # a filter's keys are sorted already
        f = QuotientFilter([x[own] for x in limbs], counts[own], m, bits)
        back.append((int(pdf["chunk"].iloc[k]), *f.part(0, len(own))))
    top = order[at[often]]
    return QuotientFilter([x[top] for x in limbs], totals[often], m, bits), pdf["lang"].to_numpy()[owner[top]], back


def survivors(ids: np.ndarray, m: int, bits: int, known: list[QuotientFilter]) -> np.ndarray:
    """The runs of ``ids`` in which every m-word phrase is one of ``known``."""
    at, limbs = windows(ids, m, bits)
    both = [np.concatenate([x, *(f.limbs[k] for f in known)]) for k, x in enumerate(limbs)]
    order, new = sorted_groups(both)
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    often = np.zeros(int(new.sum()), bool)
    often[group[len(at):]] = True
    return runs_of(ids, at[often[group[:len(at)]]], m)


def frequent_phrases(texts: DataFrame, *, max_words: int = 5, min_count: int = 100, chunk_bytes: int = 16_000_000,
                     range_words: int = 4_000_000) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(words: lang, id, word, f; totals: lang, n; phrases: lang, ids, f) for ``texts`` (lang, text as binary)."""
    spark = texts.sparkSession
    chunks = durable(chunks_of(texts, chunk_bytes))
    totals = durable(chunks.groupBy("lang").agg(F.sum("n").alias("n")))
    spoken = totals.agg(F.sum("n")).first()[0] or 0
    ranges = min(max(task_count(spark), -(-spoken // range_words)), MOST_RANGES)

    cut = chunks.select("chunk", "lang", "vocabulary", "counts").mapInPandas(
        lambda x: word_ranges(x, ranges), "range int, chunk long, lang string, size long, words binary, places binary, counts binary")
    merged = durable(cut.groupBy("range").applyInPandas(
        lambda x: merge_words(x, min_count),
        "chunk long, lang string, rank long, word binary, f long, size long, places binary, ranks binary, range int"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    base = durable(merged.where("chunk is null").groupBy("range").agg(F.count(F.lit(1)).alias("words"))
                   .withColumn("base", F.coalesce(F.sum("words").over(before), F.lit(0))))  # one row per range
    size = base.agg(F.sum("words")).first()[0] or 0
    bits = max(size.bit_length(), 1)
    range_bits = min(bits, (ranges - 1).bit_length())
    numbered = merged.join(F.broadcast(base.select("range", "base")), "range")
    words = durable(numbered.where("chunk is null").select(
        "lang", (F.col("base") + F.col("rank") + 1).cast("int").alias("id"), "word", "f"))
    known = numbered.where("chunk is not null").select("chunk", "size", "places", "ranks", "base")
    given = chunks.select("chunk", "lang", "size", "ids")
    state = given.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInPandas(_begin(bits, range_bits), STATE)
    found = words.select("lang", F.array("id").alias("ids"), "f")
    for m in range(2, max_words + 1):
        state = durable(state)
        merged = durable(state.where("kind = 'filter'").select("range", "chunk", "lang", "size", "data").groupBy("range").applyInPandas(
            _merged(m, bits, min_count), "kind string, chunk long, lang string, size long, data binary, ids array<int>, f long"))
        found = found.unionByName(merged.where("kind = 'phrase'").select("lang", "ids", "f"))
        if m < max_words:
            back = merged.where("kind = 'back'").select("chunk", "size", "data")
            left = state.where("kind = 'words'").select("chunk", "lang", "size", "data")
            state = left.groupBy("chunk").cogroup(back.groupBy("chunk")).applyInPandas(_advance(m, bits, range_bits), STATE)
    return words, totals, durable(found)


def _state(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[c.split()[0] for c in STATE.split(", ")])


def _begin(bits: int, range_bits: int):
    def run(chunk: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        if not len(chunk) or not len(known):
            return _state([])
        first = chunk.iloc[0]
        local = unpacked(first["ids"], "<u4", int(first["size"]))
        number = np.zeros(int(local.max()) + 1, np.uint32)
        for n, places, ranks, base in zip(known["size"], known["places"], known["ranks"], known["base"]):
            number[unpacked(places, "<i8", int(n)) + 1] = unpacked(ranks, "<i8", int(n)) + int(base) + 1
        ids = number[local]
        ids = runs_of(ids, np.flatnonzero(ids), 1)
        return _state(list(chunk_rows(int(first["chunk"]), first["lang"], ids, 2, bits, range_bits)))
    return run


def _merged(m: int, bits: int, min_count: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        top, langs, back = merge_range(pdf, m, bits, min_count)
        ids = np.stack(permute(digits_of(top.limbs, m, bits), bits, back=True), axis=1).astype(np.int32)
        rows = [("back", c, None, n, d, None, None) for c, n, d in back]
        rows += [("phrase", None, lang, None, None, x, int(f)) for x, lang, f in zip(ids, langs, top.counts)]
        out = pd.DataFrame(rows, columns=["kind", "chunk", "lang", "size", "data", "ids", "f"])
        return out.astype({"chunk": "Int64", "size": "Int64", "f": "Int64"})
    return run


def _advance(m: int, bits: int, range_bits: int):
    def run(words: pd.DataFrame, back: pd.DataFrame) -> pd.DataFrame:
        if not len(words) or not len(back):
            return _state([])
        first = words.iloc[0]
        ids = unpacked_ids(first["data"], int(first["size"]))
        known = [QuotientFilter.read(int(n), d, m, bits) for n, d in zip(back["size"], back["data"])]
        return _state(list(chunk_rows(int(first["chunk"]), first["lang"], survivors(ids, m, bits, known), m + 1, bits, range_bits)))
    return run


def association(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 a n / (left right)) in whole numbers of up to 38 digits."""
    wide = lambda c: c.cast("decimal(19,0)")
    product = (wide(a * 1000) * wide(n)).cast("decimal(38,0)")
    return F.call_function("div", product, (wide(left) * wide(right)).cast("decimal(38,0)")).cast("long")


def collocations(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", max_words: int = 5, min_count: int = 100,
                 contained_percent: int = 100, top: int = 2000, **options) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of each language by their weakest cut."""
    texts = docs.where(F.col(text_col).isNotNull()).select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("binary").alias("text"))
    words, totals, phrases = frequent_phrases(texts, max_words=max_words, min_count=min_count, **options)
    several = phrases.where(F.size("ids") > 1)
    # a longer phrase that says as much; the next longer ones are enough, as counts fall with length
    part = F.explode(F.array(F.slice("ids", F.lit(1), F.size("ids") - 1), F.slice("ids", F.lit(2), F.size("ids") - 1)))
    longer = several.where(F.size("ids") > 2).select("f", part.alias("ids")).groupBy("ids").agg(F.max("f").alias("within"))
    kept = (several.join(longer, "ids", "left")
            .where(F.col("within").isNull() | (100 * F.col("within") < contained_percent * F.col("f"))).drop("within"))
    counted = broadcast_if_small(phrases.select("ids", "f"))
    cuts = (kept.select("lang", "ids", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("k"))
            .withColumns({"left": F.slice("ids", F.lit(1), F.col("k")), "right": F.slice("ids", F.col("k") + 1, F.size("ids"))})
            .join(counted.select(F.col("ids").alias("left"), F.col("f").alias("l")), "left")
            .join(counted.select(F.col("ids").alias("right"), F.col("f").alias("r")), "right")
            .join(broadcast_if_small(totals), "lang")
            .withColumn("score", association(F.col("a"), F.col("n"), F.col("l"), F.col("r"))))
    scored = cuts.groupBy("lang", "ids").agg(F.min(F.struct("score", "k", "l", "r", "a", "n")).alias("x")).select("lang", "ids", "x.*")
    spelled = (scored.select("lang", "ids", F.posexplode("ids").alias("place", "id"))
               .join(broadcast_if_small(words.select("id", F.col("word").cast("string").alias("word"))), "id")
               .groupBy("lang", "ids").agg(F.array_sort(F.collect_list(F.struct("place", "word"))).alias("w"))
               .select("lang", "ids", F.array_join(F.transform("w", lambda x: x["word"]), " ").alias("phrase")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (scored.join(spelled, ["lang", "ids"]).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))


ship_by_value(__name__)
