"""Personal data by patterns and a skip-chain conditional random field.

Patterns find e-mail addresses, IP addresses, payment cards (Luhn) and telephone numbers.  The field then labels the
tokens of each document that hold a digit or an ``@`` (all others are outside by definition): a token's potential comes
from its form, neighbouring tokens share a chain potential, and distant tokens of the same normal form (letters in lower
case, or the same four or more digits however they are written) share a skip potential.  Tokens inside pattern spans
are observed.  Loopy belief propagation over all edges of a document, run until it settles, makes its labels agree, so a number that is
written out as a telephone number once is found again where only its local part stands.  A token whose marginal reaches
``belief`` is added as a span; pattern spans always stay.

The field learns without hand labels: pattern spans of a bounded sample (at most ``fit_documents`` distinct texts, drawn by
their hash over the whole table, with places kept for every kind; at most ``fit_tokens`` tokens of each, around its spans)
are its training labels, by pseudo-likelihood.

Defined results: null and empty texts have no spans; whole texts are read, whatever their length; repeated rows are read
each; null ids stay null; extra columns are ignored; an empty table gives an empty table, and without a sample only
patterns speak.
"""

from __future__ import annotations

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

#: In the order in which spans are listed.
KINDS = ("email", "ip", "card", "phone")
LABELS = len(KINDS) + 1
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
MARK, GAP = re.compile(r"[0-9@]"), re.compile(r"[\x20\x09-\x0D]")
SPACES = frozenset(" \t\n\x0b\x0c\r")
#: Stripped from the ends of a token.
EDGE = ".,;:!?\"'<>[]{}*#$%&|"
BITS = 14
Span = tuple[int, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def pattern_spans(text: str) -> list[Span]:
    """Spans by kind, then start; each pattern leftmost and non-overlapping, in time linear in the text."""
    out: list[Span] = []
    if "@" in text:
        last = 0
        for m in DOMAIN.finditer(text):
            start = m.start()
            while start > last and text[start - 1] in LOCAL:
                start -= 1
            if start < m.start():
                out.append((0, start, m.end()))
                last = m.end()
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            out.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
                out.append((3, m.start(), m.end()))
    return out


def tokens_of(text: str) -> list[tuple[int, int]]:
    """Places of the words that hold a digit or ``@``, without the marks at their ends."""
    out, end = [], 0
    for m in MARK.finditer(text):
        if m.start() < end:
            continue
        start = m.start()
        while start > end and text[start - 1] not in SPACES:
            start -= 1
        gap = GAP.search(text, m.start())
        end = gap.start() if gap else len(text)
        a, b = start, end
        while a < b and text[a] in EDGE:
            a += 1
        while b > a and text[b - 1] in EDGE:
            b -= 1
        if a < b:
            out.append((a, b))
    return out


def form_features(token: str) -> list[int]:
    """Hashed features of how a token is written."""
    shape = re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]", "0", token)).replace("0", "d")
    digits = shape.count("d")
    short = re.sub(r"d+", "d", shape)
    parts = (f"s{shape}", f"c{short}", f"n{digits}", f"l{min(len(token), 64) // 4}", f"@{'@' in token}{token.count('.')}",
             f"+{token[:1] in '+('}{token[-1:] == ')'}{'-' in token}")
    return [zlib.crc32(p.encode()) & ((1 << BITS) - 1) for p in parts]


def normal_forms(token: str) -> list[str]:
    """Two tokens are the same, or similar, if they share one of these."""
    digits = re.sub(r"[^0-9]", "", token)
    return [token.lower()] + ([digits] if len(digits) >= 4 and "@" not in token else [])


@dataclass
class Graph:
    """Tokens of one document or more: places, features, observed labels (-1: none), chain and skip edges."""

    place: list[tuple[int, int]]
    features: list[list[int]]
    observed: list[int]
    chain: list[tuple[int, int]]
    skip: list[tuple[int, int]]


def graph_of(text: str, spans: list[Span]) -> Graph:
    places = tokens_of(text)
    observed = [-1] * len(places)
    ordered, k = sorted((s, e, kind) for kind, s, e in spans), 0
    for i, (a, b) in enumerate(places):
        while k < len(ordered) and ordered[k][1] <= a:
            k += 1
        for s, e, kind in ordered[k:k + 4]:
            if s < b and a < e and observed[i] < 0:
                observed[i] = kind + 1
    chain = [(i, i + 1) for i in range(len(places) - 1) if places[i + 1][0] - places[i][1] <= 2]
    last: dict[str, int] = {}
    skip, near = set(), set(chain)
    for i, (a, b) in enumerate(places):
        for form in normal_forms(text[a:b]):
            j = last.get(form)
            if j is not None and j < i and (j, i) not in near:  # each occurrence to the one before: a chain, not all pairs
                skip.add((j, i))
            last[form] = i
    return Graph(places, [form_features(text[a:b]) for a, b in places], observed, chain, sorted(skip))


@dataclass
class Field:
    unary: np.ndarray  # features x labels
    chain: np.ndarray  # labels x labels
    skip: np.ndarray  # labels x labels, symmetric

    def marginals(self, g: Graph, rounds: int | None = None, damping: float = 0.3, tolerance: float = 1e-4) -> np.ndarray:
        """Loopy sum-product messages over all chain and skip edges, until none changes by more than ``tolerance``.

        A round sends only the messages whose source or own value still moves, so evidence that walks along a chain of
        n repeats costs n short rounds.  Where loops keep messages from settling, damping rises after 200 updates a
        message on average and the last beliefs stand after 400; ``rounds`` stops earlier.
        """
        n = len(g.place)
        at = np.asarray(g.features, np.int64)
        own = self.unary[at].sum(axis=1)
        seen = np.asarray(g.observed)
        own[seen >= 0] = np.where(np.arange(LABELS)[None, :] == seen[seen >= 0][:, None], 0.0, -50.0)
        edges = np.asarray(g.chain + g.skip, np.int64).reshape(-1, 2)
        if len(edges):
            kind = np.repeat([0, 1], [len(g.chain), len(g.skip)])
            source, target = np.concatenate((edges[:, 0], edges[:, 1])), np.concatenate((edges[:, 1], edges[:, 0]))
            potentials = np.stack([self.chain, self.skip, self.chain.T, self.skip.T])
            potential = np.concatenate((kind, kind + 2))
            back = np.concatenate((np.arange(len(edges)) + len(edges), np.arange(len(edges))))
            order = np.argsort(source, kind="stable")  # messages by source: those of a node are a run of this list
            first = np.searchsorted(source[order], np.arange(n + 1))
            message, belief = np.zeros((len(source), LABELS)), own.copy()
            everything = np.arange(len(source))
            live, whole, sent, done = everything, True, 0, 0
            while done != rounds and sent < 400 * len(source):
                keep = damping if sent < 200 * len(source) else 0.9
                inner = (belief[source[live]] - message[back[live]])[:, :, None] + potentials[potential[live]]
                top = inner.max(axis=1)
                new = top + np.log(np.exp(inner - top[:, None, :]).sum(axis=1))
                new -= new.max(axis=1, keepdims=True)
                change = (1 - keep) * (new - message[live])
                message[live] += change
                np.add.at(belief, target[live], change)
                sent, done = sent + len(live), done + 1
                moved = live[np.abs(change).max(axis=1) > tolerance]
                if len(moved):
                    nodes = np.unique(target[moved])
                    size = first[nodes + 1] - first[nodes]
                    run = np.repeat(first[nodes] - np.cumsum(size) + size, size) + np.arange(size.sum())
                    live, whole = np.unique(np.concatenate((moved, order[run]))), False
                elif whole:
                    break
                else:  # small changes may have added up: settled only if a round of all messages moves none
                    live, whole = everything, True
            own = own + 0.0
            np.add.at(own, target, message)
        own -= own.max(axis=1, keepdims=True)
        p = np.exp(own)
        return p / p.sum(axis=1, keepdims=True) if n else p


def fit(graphs: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]], *, steps: int = 200, rate: float = 0.3,
        ridge: float = 1e-4) -> Field:
    """Pseudo-likelihood: every token's label given its features and the labels of its neighbours.

    ``graphs``: (features, labels, chain edges, skip edges) of documents.
    """
    shift, features, labels, chain, skip = 0, [], [], [], []
    for f, y, c, s in graphs:
        features.append(f)
        labels.append(y)
        chain.append(c.reshape(-1, 2) + shift)
        skip.append(s.reshape(-1, 2) + shift)
        shift += len(y)
    f, y = np.concatenate(features), np.concatenate(labels)
    c, s = np.concatenate(chain), np.concatenate(skip)
    truth = np.eye(LABELS)[y]
    unary, a, b = np.zeros((1 << BITS, LABELS)), np.zeros((LABELS, LABELS)), np.zeros((LABELS, LABELS))
    squares = [np.full(x.shape, 1e-8) for x in (unary, a, b)]
    for _ in range(steps):
        z = unary[f].sum(axis=1)
        for e, m in ((c, a), (s, b)):
            np.add.at(z, e[:, 1], m[y[e[:, 0]]])
            np.add.at(z, e[:, 0], m.T[y[e[:, 1]]])
        z -= z.max(axis=1, keepdims=True)
        p = np.exp(z)
        r = (p / p.sum(axis=1, keepdims=True) - truth) / len(y)
        gu, ga, gb = np.zeros_like(unary), np.zeros_like(a), np.zeros_like(b)
        for k in range(f.shape[1]):
            np.add.at(gu, f[:, k], r)
        for e, g in ((c, ga), (s, gb)):
            np.add.at(g, y[e[:, 0]], r[e[:, 1]])
            np.add.at(g.T, y[e[:, 1]], r[e[:, 0]])
        gb = (gb + gb.T) / 2
        for x, g, q in zip((unary, a, b), (gu, ga, gb), squares):
            g = g + ridge * x / max(len(y), 1)
            q += g * g
            x -= rate * g / np.sqrt(q)
    return Field(unary, a, b)


def drawn(marked: DataFrame, fit_documents: int) -> list[int]:
    """Hashes of the texts to learn from: the smallest of all distinct texts, and of those with each kind.

    A tenth of the places is kept for each kind, as far as there are such texts; the others go by hash alone.  Ranks
    within a kind are limited before the shuffle, so a task sends no more than its smallest, and the driver gets no
    more than the places; neither order nor copies have a say.
    """
    bounds = [fit_documents] + [max(1, fit_documents // 10)] * len(KINDS)

    def kinds(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(k, h) for h, text in zip(batch["h"], batch["text"])
                    for k in {0} | {span[0] + 1 for span in pattern_spans(text)}]
            yield pd.DataFrame(rows, columns=["k", "h"])

    place = F.dense_rank().over(Window.partitionBy("k").orderBy("h"))
    limit = F.element_at(F.array(*map(F.lit, bounds)), F.col("k") + 1)
    got = (marked.mapInPandas(kinds, "k int, h long").withColumn("place", place).where(F.col("place") <= max(bounds))
           .where(F.col("place") <= limit).select("k", "h").distinct().toPandas())
    least = [np.unique(got["h"][got["k"] == k].to_numpy(np.int64)) for k in range(len(bounds))]
    kept = dict.fromkeys(int(h) for k in range(1, len(bounds)) for h in least[k])
    return list(dict.fromkeys([*kept, *map(int, least[0])]))[:fit_documents]


def window(observed: list[int], seed: int, most: int) -> list[int]:
    """At most ``most`` places of a document: runs around a drawn token of each kind in it, or one drawn run."""
    n = len(observed)
    if n <= most:
        return list(range(n))
    kinds = sorted({o for o in observed if o > 0})
    size = max(1, most // max(1, len(kinds)))
    where = [[i for i, o in enumerate(observed) if o == k] for k in kinds] or [range(n)]
    starts = [min(max(at[seed % len(at)] - size // 2, 0), n - size) for at in where]
    return sorted({i for start in starts for i in range(start, start + size)})[:most]


def learn(docs: DataFrame, *, text_col: str = "text", fit_documents: int = 2000, fit_tokens: int = 500,
          **options) -> Field | None:
    """The field of a bounded sample of distinct texts that hold a digit or ``@``; None without one."""
    marked = (docs.where(F.col(text_col).rlike("[0-9@]"))
              .select(F.xxhash64(F.col(text_col), F.lit(5)).alias("h"), F.col(text_col).alias("text")))
    chosen = drawn(marked, fit_documents)
    if not chosen:
        return None

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        met = set()
        for batch in batches:
            rows = []
            for h, text in zip(batch["h"], batch["text"]):
                if h in met:
                    continue
                met.add(h)
                g = graph_of(text, pattern_spans(text))
                at = {i: k for k, i in enumerate(window(g.observed, h, fit_tokens))}
                if at:
                    inside = lambda edges: [at[x] for e in edges if e[0] in at and e[1] in at for x in e]  # noqa: E731, B023
                    rows.append((h, [x for i in at for x in g.features[i]], [max(g.observed[i], 0) for i in at],
                                 inside(g.chain), inside(g.skip)))
            yield pd.DataFrame(rows, columns=["h", "f", "y", "c", "s"])

    got = (marked.where(F.col("h").isin(chosen))
           .mapInPandas(read, "h long, f array<int>, y array<int>, c array<int>, s array<int>").dropDuplicates(["h"]).toPandas())
    rows = sorted(zip(*(got[c].map(lambda v: tuple(int(x) for x in v)) for c in "fycs")))  # reruns agree
    if not rows:
        return None
    return fit([(np.array(f, np.int64).reshape(len(y), -1), np.array(y, np.int64), np.array(c, np.int64), np.array(s, np.int64))
                for f, y, c, s in rows], **options)


def all_spans(text: str, field: Field | None, belief: float) -> tuple[list[Span], list[Span]]:
    """Pattern spans, and all spans (with those that the field adds), each by kind and start."""
    base = pattern_spans(text)
    if field is None or not MARK.search(text):
        return base, base
    g = graph_of(text, base)
    if all(o >= 0 for o in g.observed):
        return base, base
    p = field.marginals(g)
    added: list[Span] = []
    previous = -2
    for i, (a, b) in enumerate(g.place):
        k = int(p[i, 1:].argmax())
        if g.observed[i] < 0 and p[i, k + 1] >= belief:
            if added and previous == i - 1 and added[-1][0] == k and a - added[-1][2] <= 1:
                added[-1] = (k, added[-1][1], b)
            else:
                added.append((k, a, b))
            previous = i
    return base, sorted(set(base) | set(added))


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each run of overlapping spans replaced by the kind of its first."""
    out, at = [], 0
    for start, end, kind in sorted((s, e, k) for k, s, e in spans):
        if start >= at:
            out += [text[at:start], f"<{KINDS[kind].upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


SPAN = "array<struct<kind:string,start:bigint,end:bigint>>"


def spans_column(text: Column, field: Field | None, belief: float = 0.9, with_text: bool = False) -> Column:
    """struct(base, spans[, text]): spans as (kind, start, end) in code points, and the redacted text."""
    schema = f"base {SPAN}, spans {SPAN}" + (", text string" if with_text else "")

    @F.pandas_udf(schema)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        named = lambda spans: [{"kind": KINDS[k], "start": s, "end": e} for k, s, e in spans]
        for batch in batches:
            found = [all_spans(t, field, belief) if isinstance(t, str) else ([], []) for t in batch]
            out = pd.DataFrame({"base": [named(f[0]) for f in found], "spans": [named(f[1]) for f in found]})
            if with_text:
                out["text"] = [redacted(t, f[1]) if isinstance(t, str) else None for t, f in zip(batch, found)]
            yield out

    return run(text)


def find(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", belief: float = 0.9, **options) -> DataFrame:
    """doc_id, base and spans of every document."""
    field = learn(docs, text_col=text_col, **options)
    return (docs.select(F.col(id_col).alias("doc_id"), spans_column(F.col(text_col), field, belief).alias("p"))
            .select("doc_id", "p.base", "p.spans"))


def redact(docs: DataFrame, *, belief: float = 0.9, **options) -> DataFrame:
    """``docs`` with personal data replaced by ``<KIND>`` in ``text``; ``n_chars`` follows where it is there."""
    field = learn(docs, **options)
    out = docs.withColumn("text", spans_column(F.col("text"), field, belief, with_text=True)["text"])
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast("long"))
    return out.select(*docs.columns)


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


ship_by_value(__name__)
