"""BPE of a tokenizer file by merge rounds in numpy, and its decoding.

All tokens lie between spaces: a file is accepted only if its split pattern takes no white space
into a word, and composition never reaches across a space. So a text is cut at spaces, and each
different stretch is normalised and split into words once, by the file's own normaliser and
pre-tokenizer. A text of Latin letters alone (below ``TABLE``, where composition changes nothing), without the
string of an added token, is lowered and split as a whole, by the same pattern with its classes written out, if the file's
normaliser and pattern are the ones named below. Both ways give the same words.

The symbols of many different words lie in one flat array. A round looks up the rank of
every pair of neighbours by binary search over the sorted keys of the merges, finds the lowest rank
of each word, and merges the pairs that have it, the first of overlapping ones first; words
without a pair left drop out. All equal pairs of a word may go in one round if no token takes part in
a merge that ranks before the one that makes it; for files where one does, a round merges only the first.

Ids are a binary column of little-endian unsigned 32-bit integers.

Defined results for odd input: a null or empty text has no ids and decodes to the empty text; the strings
of added tokens in a text become these tokens, as the library has it; texts of any length are read
whole, in pieces cut at spaces; repeated rows are encoded one by one; an empty table gives an empty result; only
the id and the text are read, so other columns may have any names. A file with other features than named here raises.
"""

from __future__ import annotations

import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .memory import tidy_batches

PIECE_CHARS = 1 << 20  # of a text at once
CACHE_CHARS = 1 << 24  # of different stretches that a task remembers
NO_RANK = np.iinfo(np.int64).max
TABLE = 0x180  # code points below have their class here; their lower case lies below too, or is no letter
# The normaliser and the split pattern that texts of Latin letters need no library for.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


def latin_pattern() -> re.Pattern:
    """``PATTERN`` for code points below TABLE and what their lower case may add."""
    kinds: dict[str, list[str]] = {"L": [], "N": []}
    for c in map(chr, range(TABLE)):
        kinds.setdefault(unicodedata.category(c)[0], []).append(re.escape(c))
    letter, number, space = "".join(kinds["L"]), "".join(kinds["N"]), "\\t\\n\\x0b\\x0c\\r \\x85\\xa0"
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letter}]+|[{number}]|[^{space}{letter}{number}]+")


def byte_letters() -> list[str]:
    """The characters that byte-level tokenizers write the bytes 0 … 255 as: printable ones as themselves, the rest from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    more = iter(range(256, 512))
    return [chr(b if b in shown else next(more)) for b in range(256)]


class Merges:
    """Vocabulary and ranked merges of a BPE model, as sorted pair keys."""

    def __init__(self, model: dict):
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left, right = (np.array([self.vocab[p[k]] for p in pairs], np.int64) for k in (0, 1))
        made = np.array([self.vocab[a + b] for a, b in pairs], np.int64)
        self.width = np.int64(max(self.vocab.values()) + 1)
        keys = left * self.width + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made[order]
        last = np.full(self.width, -1, np.int64)  # rank of the last merge that makes a token
        np.maximum.at(last, made, np.arange(len(made)))
        rank = np.arange(len(made))
        self.ordered = bool(((last[left] < rank) & (last[right] < rank)).all())

        # symbols of bytes, within a word and at its end, and the merges of all their pairs
        letters = byte_letters()
        self.inner, self.last = (np.array([self.vocab[c + end] for c in letters], np.int64) for end in ("", self.suffix))
        both = np.concatenate([self.inner, self.last])
        self.slot = np.zeros(self.width, np.int64)
        self.slot[both] = np.arange(len(both))
        self.pairs = self.ranked(np.repeat(both, len(both)), np.tile(both, len(both))).reshape(len(both), -1)

    def ranked(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Place in ``keys`` of each pair, -1 where it has no merge."""
        if not len(self.keys):
            return np.full(len(a), -1)
        key = a * self.width + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, at, -1)

    def merged(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word (none is empty), as 32-bit integers."""
        if not words:
            return []
        size = np.array([len(w) for w in words], np.int64)
        data, ends = np.frombuffer(b"".join(words), np.uint8), np.cumsum(size)
        symbols = self.inner[data]
        symbols[ends - 1] = self.last[data[ends - 1]]
        owner = np.repeat(np.arange(len(words)), size)
        place = np.full(len(symbols), -1)
        place[:-1] = self.pairs[self.slot[symbols[:-1]], self.slot[symbols[1:]]]
        place[ends - 1] = -1  # the last symbol of a word has no pair
        done = []
        while len(symbols):
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            count = np.diff(np.append(first, len(symbols)))
            rank = np.where(place >= 0, self.ranks[place], NO_RANK) if len(self.ranks) else np.full(len(place), NO_RANK)
            least = np.repeat(np.minimum.reduceat(rank, first), count)
            open_ = least < NO_RANK
            if not open_.all():
                done.append((owner[~open_], symbols[~open_]))
                symbols, owner, place, rank, least = (x[open_] for x in (symbols, owner, place, rank, least))
            hit = np.flatnonzero(rank == least)
            if not len(hit):
                break
            if self.ordered:  # of a run of overlapping pairs every other one
                run = np.concatenate([[True], hit[1:] != hit[:-1] + 1])
                begin = hit[run][np.cumsum(run) - 1]
                hit = hit[(hit - begin) % 2 == 0]
            else:
                hit = hit[np.concatenate([[True], owner[hit][1:] != owner[hit][:-1]])]
            symbols[hit] = self.made[place[hit]]
            keep = np.ones(len(symbols), bool)
            keep[hit + 1] = False
            at = np.cumsum(keep)[hit] - 1  # where the merged symbols lie next
            symbols, owner, place = symbols[keep], owner[keep], place[keep]
            changed = np.zeros(len(symbols), bool)  # pairs that a merged symbol is in
            changed[at] = True
            changed[at[at > 0] - 1] = True
            place[changed] = -1
            new = np.flatnonzero(changed[:-1])
            new = new[owner[new] == owner[new + 1]]
            place[new] = self.ranked(symbols[new], symbols[new + 1])
        owner, symbols = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(owner, kind="stable")
        flat = symbols[order].astype("<u4").tobytes()
        ends = (4 * np.cumsum(np.bincount(owner, minlength=len(words)))).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]


class Encoder:
    """A tokenizer file's encoding of whole texts."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            text = f.read()
        config = json.loads(text)
        self.tokenizer = Tokenizer.from_str(text)
        _check(config, self.tokenizer)
        self.merges = Merges(config["model"])
        self.added = {t["content"]: t["id"] for t in config["added_tokens"]}
        by_length = sorted(self.added, key=len, reverse=True)
        self.split = re.compile("(" + "|".join(map(re.escape, by_length)) + ")") if by_length else None
        steps = (config["normalizer"] or {}).get("normalizers", [])
        plain = steps == NORMALIZERS and config["pre_tokenizer"]["pretokenizers"][0]["pattern"] == {"Regex": PATTERN}
        self.latin = latin_pattern() if plain else None
        self.bytes_of = {ord(c): b for b, c in enumerate(byte_letters())}
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, bytes] = {}  # of stretches
        self.words: dict[str, bytes] = {}  # as the pre-tokenizer writes them
        self.plain: dict[str, bytes] = {}  # of Latin texts
        self.chars = 0

    def _normal(self, text: str) -> str:
        return self.tokenizer.normalizer.normalize_str(text) if self.tokenizer.normalizer else text

    def _cut(self, stretch: str) -> list[str | int]:
        """Words and ids of added tokens in order."""
        out: list[str | int] = []
        for part in self.split.split(stretch) if self.split else [stretch]:
            if part in self.added:
                out.append(self.added[part])
            elif part:
                out += [w for w, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(self._normal(part))]
        return out

    def _cut_plain(self, stretches: list[str]) -> list[list[str | int]]:
        """The same for many stretches without white space and added tokens, with one call for all."""
        out: list[list[str | int]] = [[] for _ in stretches]
        normal = self._normal(" ".join(stretches))
        sizes = np.array([len(s) + 1 for s in normal.split(" ")], np.int64)
        found = self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)
        at = np.searchsorted(np.cumsum(sizes), np.array([start for _, (start, _) in found], np.int64), "right")
        for k, (word, _) in zip(at.tolist(), found):
            out[k].append(word)
        return out

    def learn(self, stretches: list[str]) -> None:
        odd = self.split.search if self.split else lambda s: None
        plain = [s for s in stretches if s.split() == [s] and not odd(s)]
        rest = set(stretches).difference(plain)
        cut = dict(zip(plain, self._cut_plain(plain))) | {s: self._cut(s) for s in rest}
        new = list(dict.fromkeys(w for c in cut.values() for w in c if isinstance(w, str) and w not in self.words))
        self.words.update(zip(new, self.merges.merged([w.translate(self.bytes_of).encode("latin-1") for w in new])))
        for s, c in cut.items():
            self.known[s] = b"".join([self.words[w] if isinstance(w, str) else np.array(w, "<u4").tobytes() for w in c])
            self.chars += len(s) + 40

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each of some pieces of text that begin and end at a space or at their text's ends."""
        if self.chars > CACHE_CHARS:
            self.forget()
        if self.latin:
            easy = [t.isascii() or not _BEYOND.search(t) for t in texts]
            easy = [e and not (self.split and self.split.search(t)) for e, t in zip(easy, texts)]
            if any(easy):
                one = iter(self.encode_latin([t for e, t in zip(easy, texts) if e]))
                rest = iter(self.encode_any([t for e, t in zip(easy, texts) if not e]))
                return [next(one if e else rest) for e in easy]
        return self.encode_any(texts)

    def encode_latin(self, texts: list[str]) -> list[bytes]:
        cut, known = [self.latin.findall(t.lower()) for t in texts], self.plain
        new = list({w for c in cut for w in c}.difference(known))
        known.update(zip(new, self.merges.merged([w.encode() for w in new])))
        self.chars += sum(map(len, new)) + 40 * len(new)
        return [b"".join(map(known.__getitem__, c)) for c in cut]

    def encode_any(self, texts: list[str]) -> list[bytes]:
        cut = [t.split(" ") for t in texts]
        new = dict.fromkeys(s for c in cut for s in c if s not in self.known)
        if new:
            self.learn(list(new))
        return [b"".join([self.known[s] for s in c]) for c in cut]


_BEYOND = re.compile(f"[^\x00-{chr(TABLE - 1)}]")


def _check(config: dict, tokenizer) -> None:
    """Raises for what this encoding does not cover."""
    model, pre, norm = config["model"], config["pre_tokenizer"] or {}, config["normalizer"] or {}
    steps = pre.get("pretokenizers", [pre])
    plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges"))
    spaced = [s["type"] for s in steps] == ["Split", "ByteLevel"] and steps[0]["behavior"] == "Removed" and steps[0]["invert"] and not steps[1]["use_regex"] and not steps[1]["add_prefix_space"]
    local = all(n["type"] in ("NFC", "Replace", "Lowercase") for n in norm.get("normalizers", [norm] if norm else []))
    simple = not any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] or " " in t["content"] for t in config["added_tokens"])
    # the split pattern takes no space into a word, and spaces only separate
    apart = spaced and [w for w, _ in tokenizer.pre_tokenizer.pre_tokenize_str("a b ! 1 '")] == ["a", "b", "!", "1", "'"]
    suffix = model.get("end_of_word_suffix") or ""
    whole = all(c in model["vocab"] and c + suffix in model["vocab"] for c in byte_letters())
    if not (plain and apart and local and simple and whole) or config["post_processor"] or config["decoder"]:
        raise ValueError("the tokenizer file has features that merge rounds over words between spaces do not cover")


def pieces(text: str, limit: int = PIECE_CHARS):
    """The text cut at spaces into pieces of about ``limit`` characters; the spaces of the cuts fall away."""
    start = 0
    while len(text) - start > limit:
        end = text.find(" ", start + limit)
        if end < 0:
            break
        yield text[start:end]
        start = end + 1
    yield text[start:]


def _encoding(file: str, id_col: str):
    """Batches of (id, text) to batches of (id, ids)."""

    def run(batches):
        encoder = Encoder(file)
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                cut = [(r, p) for r, t in enumerate(part.column(1).to_pylist()) for p in pieces(t or "")]
                ids: list[list[bytes]] = [[] for _ in range(part.num_rows)]
                held, now = 0, []
                for k, (r, p) in enumerate(cut):
                    now.append((r, p))
                    held += len(p)
                    if held >= PIECE_CHARS or k + 1 == len(cut):
                        for (q, _), found in zip(now, encoder.encode([p for _, p in now])):
                            ids[q].append(found)
                        held, now = 0, []
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([b"".join(x) for x in ids], pa.binary())], names=[id_col, "ids"])

    return run


def _decoding(file: str, id_col: str):
    """Batches of (id, ids) to batches of (id, ids, decoded)."""

    def run(batches):
        with open(file, encoding="utf-8") as f:
            config = json.load(f)
        token = {k: t.encode() for t, k in config["model"]["vocab"].items()} | {t["id"]: t["content"].encode() for t in config["added_tokens"]}
        spaced = [b" " + token.get(k, b"") for k in range(max(token) + 1)]
        size = np.array([len(t) for t in spaced])
        begin = np.cumsum(size) - size
        store = np.frombuffer(b"".join(spaced), np.uint8)
        for batch in batches:
            for a in range(0, batch.num_rows, 64):
                part = batch.slice(a, 64)
                raw = []
                for row in part.column(1).to_pylist():
                    ids = np.frombuffer(row or b"", "<u4").astype(np.int64)
                    texts = []
                    for s in range(0, len(ids), PIECE_CHARS // 4):
                        k = ids[s:s + PIECE_CHARS // 4]
                        n = size[k]
                        ends = np.cumsum(n)
                        texts.append(store[np.arange(int(ends[-1])) + np.repeat(begin[k] - (ends - n), n)].tobytes())
                    raw.append(b"".join(texts)[1:])
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(raw, pa.binary())], names=[id_col, "ids", "decoded"])

    return run


def _kind(df: DataFrame, id_col: str) -> str:
    return f"`{id_col}` {df.schema[id_col].dataType.simpleString()}"


def encode(df: DataFrame, file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, ids binary) of every row. No shuffle; the tokenizer file must be on every node."""
    return df.select(F.col(id_col), F.col(text_col)).mapInArrow(tidy_batches(_encoding(file, id_col)), f"{_kind(df, id_col)}, ids binary")


def decode(df: DataFrame, file: str, id_col: str = "doc_id") -> DataFrame:
    """(``id_col``, ids, decoded binary): the UTF-8 of the decoded text, which is the tokens joined by spaces."""
    return df.select(F.col(id_col), F.col("ids")).mapInArrow(tidy_batches(_decoding(file, id_col)), f"{_kind(df, id_col)}, ids binary, decoded binary")


def both_ways(df: DataFrame, file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``decode`` of ``encode`` in one Python worker."""
    there, back = _encoding(file, id_col), _decoding(file, id_col)
    return df.select(F.col(id_col), F.col(text_col)).mapInArrow(tidy_batches(lambda batches: back(there(batches))), f"{_kind(df, id_col)}, ids binary, decoded binary")


def round_trip(df: DataFrame, file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, n_tokens, ids_sha256, decoded_sha256) of every row."""
    return both_ways(df, file, id_col, text_col).select(
        id_col, (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
