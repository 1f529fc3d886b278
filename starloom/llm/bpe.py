"""Byte-level BPE with a local rank file: whole texts to ids and ids back to raw bytes.

Long texts are first cut where no token can span: before a single space between two
characters that are not white space. The split pattern starts a new match there whatever
surrounds it, so the ids of the pieces are the ids of the whole.

Ids are a binary column of little-endian unsigned 32-bit integers, which needs no list
overhead and can be hashed or written as it is.

Defined results for odd input: a null or empty text has no ids and decodes to no bytes; strings
that look like special tokens are ordinary text; a text without a safe boundary is encoded whole;
repeated rows are encoded one by one; an empty table gives an empty result.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .memory import tidy_batches

PIECE_CHARS = 50_000


def load(rank_file: str, pattern: str):
    import tiktoken

    with open(rank_file, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, limit: int = PIECE_CHARS) -> list[str]:
    """The text cut at safe boundaries into pieces of at least ``limit`` characters, where it has any."""
    import re

    if len(text) <= limit:
        return [text]
    safe, out, start = re.compile(r"(?<=\S) (?=\S)"), [], 0
    while (m := safe.search(text, start + limit)) is not None:
        out.append(text[start:m.start()])
        start = m.start()
    out.append(text[start:])
    return out


def encode_text(encoding, text: str | None) -> bytes:
    if not text:
        return b""
    return b"".join(np.array(encoding.encode_ordinary(p), "<u4").tobytes() for p in pieces(text))


def _encoding(rank_file: str, pattern: str, id_col: str):
    """Batches of (id, text) to batches of (id, ids)."""

    def run(batches):
        encoding = load(rank_file, pattern)
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                ids = [encode_text(encoding, t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary())], names=[id_col, "ids"])

    return run


def _decoding(rank_file: str, id_col: str):
    """Batches of (id, ids) to batches of (id, ids, bytes), joined from the rank file's tokens."""

    def run(batches):
        with open(rank_file, "rb") as f:
            token = {int(rank): base64.b64decode(t) for t, rank in map(bytes.split, f)}
        size = np.zeros(max(token) + 1, np.int64)
        for k, t in token.items():
            size[k] = len(t)
        begin = np.concatenate([[0], np.cumsum(size)])
        store = np.frombuffer(b"".join(token.get(k, b"") for k in range(len(size))), np.uint8)
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                raw = []
                for row in part.column(1).to_pylist():
                    ids = np.frombuffer(row or b"", "<u4").astype(np.int64)
                    n = size[ids]
                    ends = np.cumsum(n)
                    at = np.arange(int(n.sum())) + np.repeat(begin[ids] - (ends - n), n)
                    raw.append(store[at].tobytes())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(raw, pa.binary())], names=[id_col, "ids", "bytes"])

    return run


def _kind(df: DataFrame, id_col: str) -> str:
    return f"`{id_col}` {df.schema[id_col].dataType.simpleString()}"


def encode(df: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, ids binary) of every row. No shuffle; the rank file must be on every node."""
    return df.select(F.col(id_col), F.col(text_col)).mapInArrow(tidy_batches(_encoding(rank_file, pattern, id_col)), f"{_kind(df, id_col)}, ids binary")


def decode(df: DataFrame, rank_file: str, id_col: str = "doc_id") -> DataFrame:
    """(``id_col``, ids, bytes binary): the raw bytes that each row's ids stand for."""
    return df.select(F.col(id_col), F.col("ids")).mapInArrow(tidy_batches(_decoding(rank_file, id_col)), f"{_kind(df, id_col)}, ids binary, bytes binary")


def both_ways(df: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``decode`` of ``encode`` in one Python worker."""
    there, back = _encoding(rank_file, pattern, id_col), _decoding(rank_file, id_col)
    return df.select(F.col(id_col), F.col(text_col)).mapInArrow(tidy_batches(lambda batches: back(there(batches))), f"{_kind(df, id_col)}, ids binary, bytes binary")


def round_trip(df: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, n_tokens, ids_sha256, decoded_sha256) of every row, from the encoded ids and the decoded bytes."""
    return both_ways(df, rank_file, pattern, id_col, text_col).select(
        id_col, (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))
