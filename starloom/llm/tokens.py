"""Token ids of documents in Parquet: lists of ids next to their metadata, for selective reads.

Documents are range-partitioned and sorted by id, encoded with a ``tokenizers`` file and closed with an
end id. Each file holds (doc_id, part, offset, n_tokens, ids): metadata columns are delta-encoded, ids
dictionary- or delta-encoded, row groups and pages have a set size, and page indexes let a
reader fetch the ids of a few documents, or the metadata alone. The place of a document in the
whole stream is its offset in its part plus the sizes of the parts before.

Encoding: the tokenizer merges bytes only inside the pieces that its split pattern makes, so
the ids of a text are the ids of its pieces. Pieces are found in numpy for a whole batch, and each
different one goes through the tokenizer once. A text with characters outside the tables below, or with the
string of an added token, goes through it whole, and so do all texts if the file has a normaliser, another pre-tokenizer than
the plain byte-level one, or other features that pieces by themselves do not show. Both ways give the same ids.

Defined results for odd input: a null or empty text is the end id alone; documents with one id
follow one another in the order of their texts' hashes; a null id comes first; the strings of added
tokens in a text become these tokens, as the library has it; an empty table gives files without rows; extra columns are not read.
"""

from __future__ import annotations

import json
import re
import sys
import types
import zlib
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .memory import tidy_batches
from .textnum import Roller, chunks, mix, text_column

TABLE = 0x250  # code points below this have a class here: Basic Latin to Latin Extended-B
CACHE = 1 << 20
FILE_BYTES = 64 << 20
LEAST_BYTES = 1 << 20
LETTER, NUMBER, OTHER, SPACE = 1, 2, 3, 0


@dataclass(frozen=True)
class Layout:
    """Parquet settings: bytes of a row group and of a page, rows of a page, and whether ids have a dictionary."""

    row_group: int = 16 << 20
    page: int = 256 << 10
    page_rows: int = 2000
    dictionary: bool = True
    compression: str = "zstd"

    def options(self) -> dict[str, str]:
        return {"compression": self.compression, "parquet.block.size": str(self.row_group), "parquet.page.size": str(self.page),
                "parquet.page.row.count.limit": str(self.page_rows), "parquet.writer.version": "v2", "parquet.enable.dictionary": "false",
                "parquet.enable.dictionary#ids.list.element": str(self.dictionary).lower()}


def classes() -> np.ndarray:
    """Class of each code point in the table, by the categories of the split pattern."""
    import unicodedata

    out = np.full(TABLE, OTHER, np.uint8)
    for c in range(TABLE):
        kind = unicodedata.category(chr(c))
        out[c] = LETTER if kind[0] == "L" else NUMBER if kind[0] == "N" else OTHER
    out[[9, 10, 11, 12, 13, 32, 0x85, 0xA0]] = SPACE
    return out


def piece_starts(points: np.ndarray, edges: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Flags of the code points that start a piece; ``edges`` are the texts' first code points.

    Pieces: a run of letters, numbers or other characters, with a plain space before it if there is
    one; a contraction; a run of white space less its last character; that last character by
    itself if it is not a plain space that goes with what follows.
    """
    n = len(points)
    k = kind[points]
    first = np.zeros(n, bool)
    first[edges] = True
    before, after = np.empty(n, np.uint8), np.empty(n, np.uint8)
    before[1:], after[:-1] = k[:-1], k[1:]
    before[0], after[-1] = 255, 255
    before[edges] = 255
    after[edges[1:] - 1] = 255
    plain = np.zeros(n, bool)
    plain[1:] = points[:-1] == 32
    plain[edges] = False
    solid = k != SPACE
    start = solid & (k != before) & ~plain
    start |= ~solid & ((before != SPACE) | ((after != SPACE) & (after != 255)))
    quote = np.flatnonzero((points == 39) & start)
    if len(quote):
        padded = np.concatenate([points, np.zeros(2, points.dtype)])
        ends = np.append(edges[1:], n)[np.searchsorted(edges, quote, "right") - 1]
        one, two = padded[quote + 1], padded[quote + 2]
        short = np.isin(one, np.frombuffer(b"stmd", np.uint8)) & (quote + 1 < ends)
        pair = one.astype(np.int64) << 8 | two
        long_ = np.isin(pair, [ord(a) << 8 | ord(b) for a, b in ("re", "ve", "ll")]) & (quote + 2 < ends) & (two < 256)
        size = np.where(short, 2, np.where(long_, 3, 0))
        quote, size, ends = quote[size > 0], size[size > 0], ends[size > 0]
        inner = quote + 1
        start[inner] = False
        follow = quote + size
        follow = follow[follow < ends]
        letters = follow[kind[points[follow]] == LETTER]
        start[letters] = True
    return start


def byte_letters() -> str:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones for themselves, the rest from U+0100 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return "".join(chr(b if b in own else next(others)) for b in range(256))


class Known:
    """Ids of the pieces seen so far, by the pieces' hashes, in an open-addressed table."""

    def __init__(self, entries: int = CACHE):
        slots = 1 << (2 * max(entries, CACHE) - 1).bit_length()
        self.mask = slots - 1
        self.table, self.begin, self.size = np.zeros(slots, np.uint64), np.zeros(slots, np.int64), np.zeros(slots, np.int32)
        self.store, self.used, self.entries = np.empty(1 << 16, np.uint32), 0, 0

    def find(self, key: np.ndarray) -> np.ndarray:
        """Slots of the keys, -1 where a key is not known."""
        slot = (key & np.uint64(self.mask)).astype(np.int64)
        there = self.table[slot]
        out = np.where(there == key, slot, -1)
        rest = np.flatnonzero((there != key) & (there != 0))
        while len(rest):
            slot[rest] = (slot[rest] + 1) & self.mask
            there = self.table[slot[rest]]
            hit = there == key[rest]
            out[rest[hit]] = slot[rest[hit]]
            rest = rest[~hit & (there != 0)]
        return out

    def add(self, key: np.ndarray, ids: list[list[int]]) -> None:
        """New and different keys with their ids."""
        size = np.fromiter(map(len, ids), np.int32, len(ids))
        total = int(size.sum())
        while self.used + total > len(self.store):
            self.store = np.concatenate([self.store, np.empty_like(self.store)])
        self.store[self.used:self.used + total] = np.fromiter(chain.from_iterable(ids), np.uint32, total)
        begin = self.used + np.cumsum(size) - size
        self.used += total
        self.entries += len(key)
        rest, slot = np.arange(len(key)), (key & np.uint64(self.mask)).astype(np.int64)
        while len(rest):
            at = slot[rest]
            free = rest[self.table[at] == 0]
            self.table[slot[free]] = key[free]  # of several keys for one free slot, the last stays
            won = free[self.table[slot[free]] == key[free]]
            self.begin[slot[won]], self.size[slot[won]] = begin[won], size[won]
            rest = rest[~np.isin(rest, won)]
            slot[rest] = (slot[rest] + 1) & self.mask


class Encoder:
    """Ids of many texts with a ``tokenizers`` file."""

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(tokenizer_file, encoding="utf-8") as f:
            config = json.load(f)
        self.plain = _plain(config)
        added = [re.escape(t["content"].encode()) for t in config["added_tokens"]]
        self.added = re.compile(b"|".join(added)) if added else None
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        self.kind = classes()
        self.values = mix(np.arange(1, TABLE + 1, dtype=np.uint64) * np.uint64(0x2545F4914F6CDD1D))
        self.known = Known()

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def merged(self, pieces: list[str]) -> list[list[int]]:
        """Ids of pieces by the tokenizer's own model, which merges a piece's bytes written as letters."""
        merge, letters = self.model.tokenize, self.letters
        return [[t.id for t in merge(p.encode().decode("latin-1").translate(letters))] for p in pieces]

    def pieces(self, joined: str, points: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, number of ids of each); ``edges`` are their first code points."""
        start = np.flatnonzero(piece_starts(points, edges, self.kind))
        end = np.append(start[1:], len(points))
        key = Roller(self.values[points]).hash(start, end)
        key[key == 0] = 1
        slot = self.known.find(key)
        new = np.flatnonzero(slot < 0)
        if len(new):
            fresh, at = np.unique(key[new], return_index=True)
            if self.known.entries + len(fresh) > CACHE:  # start anew with what this batch needs
                new = np.arange(len(key))
                fresh, at = np.unique(key, return_index=True)
                self.known = Known(len(fresh))
            at = new[at]
            self.known.add(fresh, self.merged([joined[a:b] for a, b in zip(start[at].tolist(), end[at].tolist())]))
            slot[new] = self.known.find(key[new])
        size, begin = self.known.size[slot], self.known.begin[slot]
        ends = np.cumsum(size, dtype=np.int64)
        flat = self.known.store[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(begin - (ends - size), size)]
        total = np.concatenate([[0], ends])
        return flat, np.diff(total[np.append(np.searchsorted(start, edges), len(start))])

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows one after the other, number of ids of each row) for UTF-8 rows."""
        rows = len(offsets) - 1
        strange = np.zeros(len(data) + 1, np.int64)
        np.cumsum(data >= 0xCA, out=strange[1:])  # lead bytes of code points from U+0280 on
        # U+0250..U+027F share a lead byte with letters of the table
        odd = (strange[offsets[1:]] - strange[offsets[:-1]]) > 0
        lead = np.flatnonzero(data == 0xC9)
        if len(lead):
            lead = lead[data[np.minimum(lead + 1, len(data) - 1)] >= 0x90]
            odd[np.searchsorted(offsets, lead, "right") - 1] = True
        if not self.plain:
            odd[:] = True
        elif self.added:
            found = np.array([m.start() for m in self.added.finditer(data.tobytes())], np.int64)
            odd[np.searchsorted(offsets, found, "right") - 1] = True
        odd &= offsets[1:] > offsets[:-1]
        plain = np.flatnonzero(~odd & (offsets[1:] > offsets[:-1]))
        counts = np.zeros(rows, np.int64)
        if not odd.any():
            text = data.tobytes().decode()
            points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
            if len(plain):
                at = np.zeros(len(data) + 1, np.int64)
                np.cumsum((data & 0xC0) != 0x80, out=at[1:])
                ids, counts[plain] = self.pieces(text, points, at[offsets[:-1][plain]])
                return ids, counts
            return np.empty(0, np.uint32), counts
        out = []
        for r in range(rows):
            one = data[offsets[r]:offsets[r + 1]]
            ids = self.whole([one.tobytes().decode()])[0] if odd[r] else self.encode(one, np.array([0, len(one)]))[0] if len(one) else np.empty(0, np.uint32)
            out.append(ids)
            counts[r] = len(ids)
        return np.concatenate(out), counts


def _plain(config: dict) -> bool:
    """Whether texts may be cut into the pieces of the plain byte-level pattern."""
    model, pre = config["model"], config["pre_tokenizer"] or {}
    features = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges")
    return (model["type"] == "BPE" and not any(model.get(k) for k in features) and not config["normalizer"] and not config["post_processor"]
            and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre["add_prefix_space"]
            and not any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in config["added_tokens"]))


def worker_encoder(tokenizer_file: str) -> Encoder:
    """This worker process's encoder: the tasks that it runs one after the other share its known pieces."""
    held = sys.modules.setdefault("_token_encoders", types.ModuleType("_token_encoders"))
    if not hasattr(held, "by_file"):
        held.by_file = {}
    if tokenizer_file not in held.by_file:
        held.by_file[tokenizer_file] = Encoder(tokenizer_file)
    return held.by_file[tokenizer_file]


def write(docs: DataFrame, path: str, tokenizer_file: str, end_id: int = 0, layout: Layout = Layout(), files: int | None = None,
          id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode ``docs`` and write them in ascending order of their ids; one shuffle, by range.

    ``files``: about ``FILE_BYTES`` of text each if not given, and less of a small table, so that all cores have some.
    """
    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, part int, offset long, n_tokens int, ids array<int>"
    if files is None:
        total = docs.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0
        files = max(1, -(-total // FILE_BYTES), min(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // LEAST_BYTES))

    def run(batches):
        from pyspark import TaskContext

        encoder, part, offset = worker_encoder(tokenizer_file), TaskContext.get().partitionId(), 0
        for batch in batches:
            data, offsets = text_column(batch.column(1))
            for a, b in chunks(offsets):
                ids, n = encoder.encode(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                flat = np.full(len(ids) + (b - a), end_id, np.int32)
                ends = np.cumsum(n)
                flat[np.arange(len(ids)) + np.repeat(np.arange(b - a), n)] = ids
                n = n + 1
                bounds = np.concatenate([[0], ends + np.arange(1, b - a + 1)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(np.full(b - a, part, np.int32)), pa.array(offset + bounds[:-1]), pa.array(n.astype(np.int32)),
                     pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat))], names=[id_col, "part", "offset", "n_tokens", "ids"])
                offset += len(flat)

    tie = F.xxhash64(F.col(text_col))
    ordered = docs.select(F.col(id_col), F.col(text_col), tie.alias("_tie")).repartitionByRange(files, id_col, "_tie").sortWithinPartitions(id_col, "_tie")
    ordered.select(id_col, text_col).mapInArrow(tidy_batches(run), schema).write.options(**layout.options()).parquet(path)


def read(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """(``id_col``, start, n_tokens, ids) from the files; columns that are not used are not read."""
    files = spark.read.parquet(path)
    sizes = files.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()  # one row a file
    bases, base = [], 0
    for part, n in sizes:
        bases.append((part, base))
        base += n
    start = spark.createDataFrame(bases or [(0, 0)], "part int, base long")
    return files.join(F.broadcast(start), "part").select(id_col, (F.col("base") + F.col("offset")).alias("start"), F.col("n_tokens").cast("long").alias("n_tokens"), "ids")


def checksums(tokens: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(``id_col``, start, n_tokens, ids_crc32): crc32 of each document's ids as little-endian unsigned 32-bit integers."""
    schema = f"`{id_col}` {tokens.schema[id_col].dataType.simpleString()}, start long, n_tokens long, ids_crc32 long"

    def run(batches):
        for batch in batches:
            ids = batch.column(3)
            flat = ids.values.to_numpy(zero_copy_only=False).astype("<u4")
            at = np.asarray(ids.offsets)
            crc = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(crc, pa.int64())], names=[id_col, "start", "n_tokens", "ids_crc32"])

    return tokens.select(id_col, "start", "n_tokens", "ids").mapInArrow(tidy_batches(run), schema)
