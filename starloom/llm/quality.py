"""Quality rules: repetition coverage of whole texts.

Rolling hashes over the words of a text find the n-grams of several lengths that occur twice
or more in it; the characters they cover (overlaps counted once) and the characters of lines
seen before are set against all characters in words. A text goes when the base rules fail it,
when any of these shares is above its limit, or when it has too many symbols for its words.

Defined results for odd input: a null or empty text has no words, so it fails the base rules;
a text with a single endless word is one word; repeated rows are judged one by one; a null id
is carried; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .memory import tidy_batches
from .textnum import Roller, byte_values, chunks, mix, per_row, repeated, text_column, word_bounds


@dataclass(frozen=True)
class Limits:
    """Largest share of the characters in words that repetition may cover.

    ``ngrams``: for each n-gram length in words, the characters inside n-grams found twice or
    more, all occurrences counted. ``lines``: the characters of lines equal to an earlier one.
    ``symbols``: characters of ``[#*$%&|<>]`` for each word.
    """

    min_words: int = 50
    repeat_words: float = 0.50
    ngrams: tuple[tuple[int, float], ...] = ((5, 0.30), (7, 0.30), (10, 0.20))
    lines: float = 0.30
    symbols: float = 0.10


SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "line_chars long, ngram_chars array<long>")


def measure(data: np.ndarray, offsets: np.ndarray, lengths: tuple[int, ...]) -> dict[str, np.ndarray]:
    """Counts of each row; ``ngram_chars`` has one column per length."""
    rows = len(offsets) - 1
    inside, start, end, doc = word_bounds(data, offsets)
    symbol = np.zeros(256, bool)
    symbol[np.frombuffer(b"#*$%&|<>", np.uint8)] = True
    letters = np.zeros(len(data) + 1, np.int64)
    np.cumsum(inside & ((data & 0xC0) != 0x80), out=letters[1:])
    out = {"n_words": np.bincount(doc, minlength=rows), "word_chars": letters[offsets[1:]] - letters[offsets[:-1]],
           "n_symbols": per_row(symbol[data], offsets)}
    text = Roller(byte_values()[data])
    words = Roller(text.hash(start, end))
    size = letters[end] - letters[start]

    def covered(n: int) -> tuple[np.ndarray, np.ndarray]:
        """Words and characters of each row inside windows of n words found twice or more in the row."""
        first = np.arange(max(0, len(start) - n + 1))
        first = first[doc[first] == doc[first + n - 1]] if len(first) else first
        key = mix(words.hash(first, first + n) + doc[first].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        hit = first[repeated(key)]
        step = np.zeros(len(start) + 1, np.int64)
        np.add.at(step, hit, 1)
        np.add.at(step, hit + n, -1)
        on = np.cumsum(step[:-1]) > 0
        return np.bincount(doc[on], minlength=rows), np.bincount(doc[on], size[on], minlength=rows).astype(np.int64)

    out["n_repeat_words"] = covered(3)[0]
    out["ngram_chars"] = np.stack([covered(n)[1] for n in lengths], 1) if lengths else np.zeros((rows, 0), np.int64)

    cut = np.flatnonzero(data == 0x0A)
    first = np.unique(np.concatenate([offsets[:-1][offsets[:-1] < offsets[1:]], cut + 1]))
    first = first[first < len(data)]
    last = np.append(first[1:], len(data))
    last = np.where(data[last - 1] == 0x0A, last - 1, last) if len(first) else last
    line_chars = letters[last] - letters[first]
    first, last, line_chars = first[line_chars > 0], last[line_chars > 0], line_chars[line_chars > 0]
    row = np.searchsorted(offsets, first, "right") - 1
    key = mix(text.hash(first, last) + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, earliest = np.unique(key, return_index=True)
    again = np.ones(len(key), bool)
    again[earliest] = False
    out["n_dup_lines"] = np.bincount(row[again], minlength=rows)
    out["line_chars"] = np.bincount(row[again], line_chars[again], minlength=rows).astype(np.int64)
    return out


def repetition(docs: DataFrame, lengths: tuple[int, ...], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of every whole text: one row per row of ``docs`` (see ``SCHEMA``). No shuffle."""

    def run(batches):
        for batch in batches:
            data, offsets = text_column(batch.column(1))
            for a, b in chunks(offsets):
                part = measure(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], lengths)
                grams = part.pop("ngram_chars")
                flat = pa.ListArray.from_arrays(pa.array(np.arange(b - a + 1) * len(lengths), pa.int32()), pa.array(grams.ravel(), pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a)] + [pa.array(part[c], pa.int64()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "line_chars")] + [flat],
                    names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "line_chars", "ngram_chars"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(tidy_batches(run), SCHEMA)


def judge(docs: DataFrame, limits: Limits = Limits(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of every text with ``base_failed``, ``failed`` (names of the shares over their limit) and ``kept``."""
    counts = repetition(docs, tuple(n for n, _ in limits.ngrams), id_col, text_col)
    over = [F.when(F.col("ngram_chars")[i] > F.lit(share) * F.col("word_chars"), F.lit(f"{n}-grams")) for i, (n, share) in enumerate(limits.ngrams)]
    over.append(F.when(F.col("line_chars") > F.lit(limits.lines) * F.col("word_chars"), F.lit("lines")))
    over.append(F.when(F.col("n_symbols") > F.lit(limits.symbols) * F.col("n_words"), F.lit("symbols")))
    base = (F.col("n_words") < limits.min_words) | (F.col("n_repeat_words") > F.lit(limits.repeat_words) * F.col("n_words"))
    return (counts.withColumn("base_failed", base)
            .withColumn("failed", F.array_compact(F.array(*over)))
            .withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0)))


def verdicts(batch_limits: Limits = Limits()):
    """Function on (bytes, offsets) that flags the rows to keep; the same rule as ``judge``."""
    lengths = tuple(n for n, _ in batch_limits.ngrams)

    def keep(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        m = measure(data, offsets, lengths)
        ok = (m["n_words"] >= batch_limits.min_words) & ~(m["n_repeat_words"] > batch_limits.repeat_words * m["n_words"])
        for i, (_, share) in enumerate(batch_limits.ngrams):
            ok &= ~(m["ngram_chars"][:, i] > share * m["word_chars"])
        ok &= ~(m["n_symbols"] > batch_limits.symbols * m["n_words"])
        return ok & ~(m["line_chars"] > batch_limits.lines * m["word_chars"])

    return keep


def keep_good(docs: DataFrame, limits: Limits = Limits(), text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns; one pass, no join and no shuffle."""
    keep = verdicts(limits)
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            data, offsets = text_column(batch.column(at))
            for a, b in chunks(offsets):
                ok = keep(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                yield batch.slice(a, b - a).filter(pa.array(ok))

    return docs.mapInArrow(tidy_batches(run), docs.schema)
