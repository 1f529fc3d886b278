"""Exact substring deduplication: bytes of a text that a document with a smaller id has too.

A byte goes when it lies in a window of ``LENGTH`` bytes that also starts in a document with a
smaller id. Windows never cross documents, and all are judged on the input.

Every window has an anchor: the first of its ``MER``-byte pieces with the smallest hash. It
depends on the window's bytes alone, so equal windows have equal anchors. Windows in a row
with one anchor are one string of up to ``LENGTH + SPAN - 1`` bytes.

1. Documents are dealt into blocks. Each block sends the hashes of its anchors, once each, and how many
   different strings it has of each, to the hashes' partitions. It learns which of them occur in several
   documents; all other strings are done with.
2. Each block sends its different strings with shared anchors, and the smallest id that has each,
   to the partitions. There the strings, and the windows of strings that share an anchor, are put in suffix
   order by deep-shallow sorting; equal windows come together and give their smallest id, which goes
   back to the blocks that sent them. Anchors with more than ``OFTEN`` different strings send the different
   windows of these strings, by the windows' own hashes, so that no partition gets all the strings at the edges
   of a common passage.
3. Each block marks the bytes under windows with a smaller id and cuts them out.

A block sends a string once however many of its documents hold it; a passage in a third of
all documents costs each partition one string a block, and its copies do not make its anchors frequent. Steps repeat
the cheap search for anchors and move texts, not suffixes: about one window in fourteen starts a string. Wide
arrays (windows, strings as bytes) are made for a bounded number of rows at a time.

A block writes one message for each partition that any of its strings goes to: at most one a string, and with few
blocks at most one a pair of block and partition.

Defined results for odd input: a null or empty text has no bytes; texts shorter than a window are kept;
documents with one id do not remove each other's text; a document without an id removes nothing
and is kept whole; texts of any length are read whole; an empty table gives an empty result; columns
of ``docs`` are carried whatever their names.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .memory import tidy_group
from .storage import stored
from .suffix_sort import deep_shallow
from .textnum import Roller, byte_values, text_column

LENGTH = 50
MER = 24
SPAN = LENGTH - MER + 1
ROW = 80  # a string's bytes, zeros, its anchor's place and its length
OFTEN = 1 << 15  # different strings of an anchor that one task takes
SEGMENT = 1 << 18  # windows at once
BLOCK_BYTES = 8 << 20
_NONE = np.iinfo(np.int64).max


@dataclass
class Runs:
    """Strings of a block: document row, first byte in it, number of windows, anchor's place and hash, and the string's own hash."""

    row: np.ndarray
    start: np.ndarray
    windows: np.ndarray
    place: np.ndarray
    anchor: np.ndarray
    own: np.ndarray


def _segments(offsets: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """(row, first window, last window) ranges of rows with windows, in lists of about SEGMENT windows."""
    out, now, held = [], [], 0
    for r, n in enumerate((np.diff(offsets) - LENGTH + 1).tolist()):
        for a in range(0, n, SEGMENT):
            b = min(n, a + SEGMENT)
            now.append((r, a, b))
            held += b - a
            if held >= SEGMENT:
                out.append(now)
                now, held = [], 0
    return out + [now] if now else out


def runs_of(data: np.ndarray, offsets: np.ndarray) -> Runs:
    parts = []
    values = byte_values()
    for segment in _segments(offsets):
        text = np.concatenate([data[offsets[r] + a:offsets[r] + b + LENGTH - 1] for r, a, b in segment])
        size = np.array([b - a for _, a, b in segment])
        base = np.concatenate([[0], np.cumsum(size + LENGTH - 1)])[:-1]
        mers = len(text) - MER + 1
        at = np.arange(mers)
        roller = Roller(values[text])
        hashes = roller.hash(at, at + MER)
        least = (hashes & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
        for step in (1, 2, 4, 8):
            least = np.minimum(least[:-step], least[step:])
        rest = SPAN - 16
        least = np.minimum(least[:-rest], least[rest:])
        anchor = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
        window = np.repeat(base, size) + np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        owner = np.repeat(np.arange(len(segment)), size)
        anchor = anchor[window]
        new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])]))
        k, first, count = owner[new], window[new], np.diff(np.append(new, len(anchor)))
        rows, firsts = np.array([s[0] for s in segment]), np.array([s[1] for s in segment])
        parts.append((rows[k], first - base[k] + firsts[k], count, anchor[new] - first, hashes[anchor[new]], roller.hash(first, first + count + LENGTH - 1)))
    if not parts:
        e = np.empty(0, np.int64)
        return Runs(e, e, e, e, e.astype(np.uint64), e.astype(np.uint64))
    return Runs(*[np.concatenate(x) for x in zip(*parts)])


def _partition(keys: np.ndarray, partitions: int) -> np.ndarray:
    return ((keys >> np.uint64(33)) % np.uint64(partitions)).astype(np.int64)


def _pack(*arrays: np.ndarray) -> bytes:
    return zlib.compress(b"".join(np.ascontiguousarray(a).tobytes() for a in arrays), 1)


@dataclass
class Block:
    """A block's documents that have an id, and its strings."""

    ids: np.ndarray
    data: np.ndarray
    offsets: np.ndarray
    runs: Runs

    @staticmethod
    def of(table) -> "Block":
        ids = table.column("id").combine_chunks()
        data, offsets = text_column(table.column("text"))
        lengths = np.where(np.asarray(ids.is_valid()), np.diff(offsets), 0)
        if ids.null_count:
            keep = np.repeat(np.asarray(ids.is_valid()), np.diff(offsets))
            data = data[keep]
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        return Block(ids.fill_null(_NONE).to_numpy(), data, offsets, runs_of(data, offsets))

    def anchors(self, partitions: int):
        """(partition of each, different hashes, where each run's is), by partition and hash."""
        keys, inverse = np.unique(self.runs.anchor, return_inverse=True)
        part = _partition(keys, partitions)
        order = np.argsort(part, kind="stable")
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return part[order], keys[order], back[inverse]

    def strings(self, flags: np.ndarray, partitions: int) -> "Strings":
        """What the block has of shared anchors; ``flags`` of each run: 0 not shared, 1 shared, 2 with very many strings."""
        r = self.runs
        runs = np.flatnonzero(flags)
        ids, own = self.ids[r.row[runs]], r.own[runs]
        order = np.lexsort((ids, own, r.anchor[runs]))
        new = _changes(r.anchor[runs][order], own[order])
        of = _numbered(order, new)
        head = runs[order[new]]
        least, often = ids[order[new]], flags[head] == 2
        # the different windows of the strings of frequent anchors
        owner, off = _windows(np.flatnonzero(often), r.windows[head[often]])
        w_row, w_start = r.row[head[owner]], r.start[head[owner]] + off
        key = self.hashes(w_row, w_start, np.full(len(owner), LENGTH))
        order = np.lexsort((least[owner], key))
        new = _changes(key[order])
        window, first = _numbered(order, new), order[new]
        one = head[~often]
        keys = np.concatenate([r.anchor[one], key[first]])
        parts = _partition(keys, partitions)
        by_part = np.argsort(parts, kind="stable")
        place = np.empty(len(by_part), np.int64)
        place[by_part] = np.arange(len(by_part))
        item = np.full(len(head), -1)
        item[~often] = place[:len(one)]

        def both(a, b):
            return np.concatenate([a, b])[by_part]

        return Strings(runs, of, item, owner, off, place[len(one):][window], parts[by_part], both(least[~often], least[owner[first]]),
                       both(r.row[one], w_row[first]), both(r.start[one], w_start[first]),
                       both(r.windows[one], np.ones(len(first), np.int64)), both(r.place[one], r.place[head[owner[first]]] - off[first]))

    def hashes(self, row: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        out = np.empty(len(row), np.uint64)
        values = byte_values()
        at = self.offsets[row] + start
        order = np.argsort(at, kind="stable")
        for s in range(0, len(order), 1 << 17):  # near places together, so that a stretch of text is enough
            k = order[s:s + (1 << 17)]
            low, high = int(at[k].min()), int((at[k] + size[k]).max())
            out[k] = Roller(values[self.data[low:high]]).hash(at[k] - low, at[k] - low + size[k])
        return out

    def bytes_of(self, row, start, windows, place) -> np.ndarray:
        """The strings as fixed rows."""
        out = np.zeros((len(row), ROW), np.uint8)
        at, size, span = self.offsets[row] + start, windows + LENGTH - 1, np.arange(ROW)
        last = max(len(self.data) - 1, 0)
        for s in range(0, len(row), 1 << 14):
            k = slice(s, s + (1 << 14))
            out[k] = self.data[np.minimum(at[k, None] + span, last)]
            out[k][span >= size[k, None]] = 0
        out[:, ROW - 2], out[:, ROW - 1] = place, size
        return out


@dataclass
class Strings:
    """A block's strings with shared anchors, and the items that it sends of them, by partition."""

    runs: np.ndarray  # the runs that have them
    of: np.ndarray  # the different string of each
    item: np.ndarray  # of each different string, -1 if its windows are sent instead:
    owner: np.ndarray  # the string of each such window, ascending
    off: np.ndarray  # its place there
    window: np.ndarray  # and its item
    parts: np.ndarray  # of each item, as what follows
    least: np.ndarray
    row: np.ndarray
    start: np.ndarray
    windows: np.ndarray
    place: np.ndarray


def _changes(*keys: np.ndarray) -> np.ndarray:
    """Where one of the sorted keys differs from the one before."""
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return new


def _numbered(order: np.ndarray, new: np.ndarray) -> np.ndarray:
    """The number of the group of each row, for rows in ``order`` whose groups begin at ``new``."""
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new) - 1
    return out


def _windows(owners: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, place) of all windows of owners with ``n`` each."""
    return np.repeat(owners, n), np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)


def _rows(block: int, parts: np.ndarray, payload) -> pa.Table:
    """One row (part, block, payload) for each partition in the sorted ``parts``."""
    which, first = np.unique(parts, return_index=True)
    ends = np.append(first[1:], len(parts))
    return pa.table({"part": pa.array(which, pa.int64()), "block": pa.array(np.full(len(which), block), pa.int64()),
                     "payload": pa.array([payload(a, b) for a, b in zip(first.tolist(), ends.tolist())], pa.binary())})


_SENT = "part long, block long, payload binary"


def _send_anchors(partitions: int):
    def run(table):
        block = Block.of(table)
        parts, keys, at = block.anchors(partitions)
        own = block.runs.own
        order = np.lexsort((own, at))
        count = np.bincount(at[order][_changes(at[order], own[order])], minlength=len(keys))
        ids = block.ids[block.runs.row]
        low, high = np.full(len(keys), _NONE), np.full(len(keys), -_NONE)
        np.minimum.at(low, at, ids)
        np.maximum.at(high, at, ids)
        # different strings, negative where all are in one document
        many = np.where(low == high, -count, count).astype(np.int32)
        return _rows(table.column("block")[0].as_py(), parts, lambda a, b: _pack(np.array([b - a], np.int64), keys[a:b], many[a:b]))

    return run


def _answer_anchors(table):
    blocks, sent = table.column("block").to_pylist(), [zlib.decompress(p) for p in table.column("payload").to_pylist()]
    sizes = [int(np.frombuffer(p, np.int64, 1)[0]) for p in sent]
    keys = np.concatenate([np.frombuffer(p, np.uint64, n, 8) for p, n in zip(sent, sizes)])
    many = np.concatenate([np.frombuffer(p, np.int32, n, 8 + 8 * n) for p, n in zip(sent, sizes)]).astype(np.int64)
    _, at = np.unique(keys, return_inverse=True)
    blocks_with, strings = np.bincount(at), np.bincount(at, np.abs(many))
    several = np.bincount(at, many > 0) > 0
    flag = np.where((blocks_with > 1) | several, np.where(strings > OFTEN, 2, 1), 0).astype(np.uint8)[at]
    ends = np.cumsum(sizes)
    part = table.column("part")[0].as_py()
    return pa.table({"part": pa.array([part] * len(blocks), pa.int64()), "block": pa.array(blocks, pa.int64()),
                     "payload": pa.array([_pack(flag[e - n:e]) for e, n in zip(ends, sizes)], pa.binary())})


def _flags(block: Block, answers, partitions: int) -> np.ndarray:
    """The flag of each run, from the partitions' answers on the block's anchors."""
    parts, keys, at = block.anchors(partitions)
    got = dict(zip(answers.column("part").to_pylist(), answers.column("payload").to_pylist()))
    flags = [np.frombuffer(zlib.decompress(got[p]), np.uint8) for p in np.unique(parts).tolist()]
    return np.concatenate(flags)[at] if len(keys) else np.empty(0, np.uint8)


def _send_strings(partitions: int):
    def run(texts, answers):
        if not texts.num_rows:
            return _rows(0, np.empty(0, np.int64), None)
        block = Block.of(texts)
        s = block.strings(_flags(block, answers, partitions), partitions)

        def payload(a: int, b: int) -> bytes:
            return _pack(np.array([b - a], np.int64), s.least[a:b], block.bytes_of(s.row[a:b], s.start[a:b], s.windows[a:b], s.place[a:b]))

        return _rows(texts.column("block")[0].as_py(), s.parts, payload)

    return run


def smallest(strings: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For fixed rows of strings and the smallest id of each: the smallest id of all equal strings,
    and (string, window, id) where a window is in another string with a smaller id still."""
    n = len(strings)
    flat = strings.reshape(-1)
    order, first = deep_shallow(flat, np.arange(n) * ROW, ROW)
    which = np.empty(n, np.int64)
    which[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, n)))
    base = np.minimum.reduceat(least[order], first)
    rows = strings[order[first]]  # the different strings
    # those with the same anchor as another
    place = rows[:, ROW - 2].astype(np.int64)
    mer = np.take_along_axis(rows, place[:, None] + np.arange(MER), 1)
    value = byte_values()[mer]
    key = Roller(value.reshape(-1)).hash(np.arange(len(rows)) * MER, np.arange(1, len(rows) + 1) * MER)
    _, at, count = np.unique(key, return_inverse=True, return_counts=True)
    some = np.flatnonzero(count[at] > 1)
    some = some[np.argsort(at[some], kind="stable")]
    found = [(some[:0], some[:0], some[:0])]
    for a, b in _anchor_ranges(at[some], rows[some, ROW - 1].astype(np.int64) - LENGTH + 1):
        k = some[a:b]
        owner, window = _windows(k, rows[k, ROW - 1].astype(np.int64) - LENGTH + 1)
        order, first = deep_shallow(rows.reshape(-1), owner * ROW + window, LENGTH)
        low = np.empty(len(order), np.int64)
        low[order] = np.repeat(np.minimum.reduceat(base[owner[order]], first), np.diff(np.append(first, len(order))))
        less = np.flatnonzero(low < base[owner])
        found.append((owner[less], window[less], low[less]))
    owner, window, low = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((window, owner))
    return base[which], *_spread(which, len(rows), owner[order], window[order], low[order])


def _anchor_ranges(anchor: np.ndarray, windows: np.ndarray):
    """Ranges of strings sorted by anchor with about SEGMENT windows; none divides an anchor."""
    heads = np.flatnonzero(_changes(anchor))
    total = np.concatenate([[0], np.cumsum(windows)])
    start = 0
    for end in [*heads[1:].tolist(), len(anchor)]:
        if end > start and (total[end] - total[start] >= SEGMENT or end == len(anchor)):
            yield start, end
            start = end


def _spread(which: np.ndarray, n: int, owner: np.ndarray, window: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The exceptions of the different strings (sorted by owner) for each of the strings that equal them."""
    begin, end = np.searchsorted(owner, np.arange(n), "left")[which], np.searchsorted(owner, np.arange(n), "right")[which]
    size = end - begin
    at = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    return np.repeat(np.arange(len(which)), size), window[at], low[at]


def _answer_strings(table):
    blocks, sent = table.column("block").to_pylist(), [zlib.decompress(p) for p in table.column("payload").to_pylist()]
    sizes = [int(np.frombuffer(p, np.int64, 1)[0]) for p in sent]
    least = np.concatenate([np.frombuffer(p, np.int64, n, 8) for p, n in zip(sent, sizes)])
    strings = np.concatenate([np.frombuffer(p, np.uint8, n * ROW, 8 + 8 * n).reshape(n, ROW) for p, n in zip(sent, sizes)])
    base, string, window, low = smallest(strings, least)
    out = []
    begin = 0
    for n in sizes:
        a, b = np.searchsorted(string, [begin, begin + n])
        out.append(_pack(np.array([n, b - a], np.int64), base[begin:begin + n], low[a:b], (string[a:b] - begin).astype(np.uint32), window[a:b].astype(np.uint8)))
        begin += n
    part = table.column("part")[0].as_py()
    return pa.table({"part": pa.array([part] * len(blocks), pa.int64()), "block": pa.array(blocks, pa.int64()), "payload": pa.array(out, pa.binary())})


def _covered(block: Block, flags: np.ndarray, found, partitions: int) -> np.ndarray:
    """Flags of the block's bytes that lie under a window with a smaller id."""
    sent = block.strings(flags, partitions)
    got = dict(zip(found.column("part").to_pylist(), found.column("payload").to_pylist()))
    none = np.empty(0, np.int64)
    bases, items, places, lows, begin = [none], [none], [none], [none], 0
    for p in np.unique(sent.parts).tolist():
        raw = zlib.decompress(got[p])
        n, k = np.frombuffer(raw, np.int64, 2)
        bases.append(np.frombuffer(raw, np.int64, n, 16))
        lows.append(np.frombuffer(raw, np.int64, k, 16 + 8 * n))
        items.append(np.frombuffer(raw, np.uint32, k, 16 + 8 * (n + k)).astype(np.int64) + begin)
        places.append(np.frombuffer(raw, np.uint8, k, 16 + 8 * (n + k) + 4 * k).astype(np.int64))
        begin += n
    base, item, place, low = (np.concatenate(x) for x in (bases, items, places, lows))
    # for each different string the smallest id of all, and windows with a smaller one still
    whole = np.where(sent.item >= 0, base[sent.item] if len(base) else _NONE, _NONE)
    string_of = np.full(begin + 1, -1)
    string_of[sent.item[sent.item >= 0]] = np.flatnonzero(sent.item >= 0)
    on = string_of[item] >= 0  # a single window has no smaller one
    string = np.concatenate([string_of[item[on]], sent.owner])
    place = np.concatenate([place[on], sent.off])
    low = np.concatenate([low[on], base[sent.window]])
    order = np.argsort(string, kind="stable")
    string, place, low = string[order], place[order], low[order]
    first, last = np.searchsorted(string, np.arange(len(whole)), "left"), np.searchsorted(string, np.arange(len(whole)), "right")

    r, step = block.runs, np.zeros(len(block.data) + 1, np.int64)
    for s in range(0, len(sent.runs), 1 << 16):
        runs, of = sent.runs[s:s + (1 << 16)], sent.of[s:s + (1 << 16)]
        ids, at = block.ids[r.row[runs]], block.offsets[r.row[runs]] + r.start[runs]
        gone = np.flatnonzero(whole[of] < ids)
        np.add.at(step, at[gone], 1)
        np.add.at(step, at[gone] + r.windows[runs[gone]] + LENGTH - 1, -1)
        owner, k = _windows(np.arange(len(of)), last[of] - first[of])
        k += first[of][owner]
        less = low[k] < ids[owner]
        start = at[owner[less]] + place[k[less]]
        np.add.at(step, start, 1)
        np.add.at(step, start + LENGTH, -1)
    return np.cumsum(step[:-1]) > 0


def _cut(partitions: int, as_text: bool):
    def run(texts, answers):
        schema = [("rest", texts.schema.field("rest").type)]
        if not texts.num_rows:
            empty = [pa.array([], t) for _, t in schema]
            return pa.table([*empty, *[pa.array([], pa.int64())] * 3, pa.array([], pa.string() if as_text else pa.binary())],
                            names=["rest", "n_bytes", "n_removed", "n_spans", "kept"])
        block = Block.of(texts)
        kind = answers.column("kind").to_numpy()
        flags = _flags(block, answers.filter(pa.array(kind == 1)), partitions)
        gone = _covered(block, flags, answers.filter(pa.array(kind == 2)), partitions)
        data, offsets = text_column(texts.column("text"))
        valid = np.asarray(texts.column("id").combine_chunks().is_valid())
        removed, spans, kept = [], [], []
        for r in range(texts.num_rows):
            text = data[offsets[r]:offsets[r + 1]]
            if valid[r]:
                off = gone[block.offsets[r]:block.offsets[r + 1]]
                removed.append(int(off.sum()))
                spans.append(int((off[1:] & ~off[:-1]).sum()) + int(len(off) > 0 and off[0]))
                text = text[~off] if removed[-1] else text
            else:
                removed.append(0)
                spans.append(0)
            kept.append(text.tobytes().decode("utf-8", "ignore") if as_text else text.tobytes())
        return pa.table([texts.column("rest"), pa.array(np.diff(offsets)), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
                         pa.array(kept, pa.string() if as_text else pa.binary())], names=["rest", "n_bytes", "n_removed", "n_spans", "kept"])

    return run


def _deduplicated(docs: DataFrame, id_col: str, text_col: str, as_text: bool, block_bytes: int) -> DataFrame:
    """(rest, n_bytes, n_removed, n_spans, kept): ``rest`` is a struct of the other columns of ``docs``."""
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0
    blocks = max(-(-total // block_bytes), min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // (1 << 20))), 1)
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    whole = docs.select(F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(blocks)).alias("block"),
                        F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.struct(*others).alias("rest"))
    texts = whole.select("block", "id", "text")
    sent = texts.groupBy("block").applyInArrow(tidy_group(_send_anchors(blocks)), _SENT)
    flags = stored(sent.groupBy("part").applyInArrow(tidy_group(_answer_anchors), _SENT), "anchors")
    sent = texts.groupBy("block").cogroup(flags.groupBy("block")).applyInArrow(tidy_group(_send_strings(blocks)), _SENT)
    found = stored(sent.groupBy("part").applyInArrow(tidy_group(_answer_strings), _SENT), "windows")
    answers = flags.withColumn("kind", F.lit(1)).unionByName(found.withColumn("kind", F.lit(2)))
    kind = whole.schema["rest"].dataType.simpleString()
    return (whole.groupBy("block").cogroup(answers.groupBy("block"))
            .applyInArrow(tidy_group(_cut(blocks, as_text)), f"rest {kind}, n_bytes long, n_removed long, n_spans long, kept {'string' if as_text else 'binary'}"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(``id_col``, n_bytes, n_removed, n_spans, kept): what is left of each whole text, as bytes.

    Blocks and partitions exchange a message a pair, so ``block_bytes`` should grow with the input as far as
    an executor's memory allows: a task needs about ten times that for its block.
    """
    out = _deduplicated(docs.select(id_col, text_col), id_col, text_col, False, block_bytes)
    return out.select(F.col(f"rest.`{id_col}`").alias(id_col), "n_bytes", "n_removed", "n_spans", "kept")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` with what is left of their texts; a character that lost some of its bytes goes whole."""
    out = _deduplicated(docs, id_col, text_col, True, block_bytes)
    return out.select(*[F.col("kept").alias(c) if c == text_col else F.col(f"rest.`{c}`").alias(c) for c in docs.columns])
