"""Token ids of whole texts by a public byte-level BPE vocabulary.

The vocabulary is the ``tokenizers`` JSON file at the given path; its ids are the merge ranks, and the faster encoder of
``tiktoken`` over the same ranks gives the same ids (tests hold the two equal).
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.session import ship_by_value

#: How byte-level BPE cuts a text before merging (fixed by the vocabulary's format).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in such a vocabulary: itself, or the next from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Encoder:
    """Ids as little-endian unsigned 32-bit numbers; the file's added tokens inside a text are their own ids."""

    def __init__(self, path: str) -> None:
        import tiktoken

        with open(path, encoding="utf-8") as f:
            given = json.load(f)
        self.special = {t["content"]: t["id"] for t in given.get("added_tokens", [])}
        symbol = byte_symbols()
        ranks = {bytes(symbol[c] for c in token): k for token, k in given["model"]["vocab"].items() if token not in self.special}
        self.coder = tiktoken.Encoding("given", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=self.special)

    def encode(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special):
            return np.asarray(self.coder.encode(text, allowed_special="all"), dtype="<u4")
        return np.asarray(self.coder.encode_ordinary(text), dtype="<u4")


def encoder_of(path: str) -> Encoder:
    """One encoder for each Python worker: building its tables takes longer than many a task, and workers are reused."""
    import tiktoken

    held = tiktoken.__dict__.setdefault("_encoders_by_path", {})
    if path not in held:
        held[path] = Encoder(path)
    return held[path]


def token_lengths(texts: DataFrame, text_col: str, tokenizer: str, out: str = "tokens") -> DataFrame:
    """``texts`` with the number of token ids of ``text_col`` (null: 0)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = encoder_of(tokenizer)
        for batch in batches:
            batch[out] = [len(encoder.encode(t)) if isinstance(t, str) and t else 0 for t in batch[text_col]]
            yield batch

    schema = texts.withColumn(out, F.lit(0).cast("long")).schema
    return texts.mapInPandas(run, schema)


def token_pieces(docs: DataFrame, *, tokenizer: str, capacity: int, end_id: int, id_col: str, text_col: str,
                 with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids): the end id is added, and longer documents are cut so that
    every piece but the first is full."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, end, none = encoder_of(tokenizer), np.array([end_id], "<u4"), np.zeros(0, "<u4")
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = np.concatenate((encoder.encode(text) if isinstance(text, str) and text else none, end))
                n = len(ids)
                first = n % capacity or capacity
                begins = [0, *range(first, n, capacity)]
                for k, a in enumerate(begins):
                    b = begins[k + 1] if k + 1 < len(begins) else n
                    row = (None if pd.isna(doc_id) else int(doc_id), k, a, b - a, zlib.crc32(ids[a:b].tobytes()))
                    rows.append((*row, ids[a:b].astype("i4")) if with_ids else row)
                if with_ids and len(rows) > 2_000:
                    yield pd.DataFrame(rows, columns=names)
                    rows = []
            out = pd.DataFrame(rows, columns=names)
            out["doc_id"] = pd.array(out["doc_id"], dtype="Int64")
            yield out

    names = [c.split()[0] for c in schema.split(", ")]
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return narrow.mapInPandas(run, schema)


ship_by_value(__name__)
