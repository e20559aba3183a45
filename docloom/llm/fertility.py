"""Quality by what public tokenizers make of a text.

Each text is split into the pieces of a public vocabulary with byte fallback. Characters per
token, the share of tokens that are bytes, and the entropy of the tokens are compared with what
is usual for texts of the same language and script: the median over all distinct texts, and a band around
it whose width follows the spread of the middle half and the number of tokens; copies count once. Fixed
rules on words, symbols and repetition come first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.texts import Chunk, chunks, rows_of, runs, span_hashes, windows, words
from docloom.workspace import broadcast_if_small, stage

#: The vocabulary: pieces of words, with byte fallback.
VOCABULARY = "piece_bpe_32k.model"
#: Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
WINDOW = 3
#: Scripts by the first code point of their blocks; a text has the one of most letters.
SCRIPTS = {
    "latin": 0x41, "greek": 0x370, "cyrillic": 0x400, "hebrew": 0x590, "arabic": 0x600, "indic": 0x900,
    "thai": 0xE00, "hangul": 0x1100, "kana": 0x3040, "han": 0x3400, "other": 0x10000,
}
#: Half width of a band in interquartile ranges, and in standard errors of the text's own measure.
WIDTH = 2.5
ERRORS = 2.0

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in SYMBOLS]] = True
_STARTS = np.array(list(SCRIPTS.values()))
_NAMES = list(SCRIPTS)


def _repeats(row: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Which entries share their row and value with an earlier one, and which with any."""
    order = np.lexsort((value, row))
    same = np.zeros(len(order), bool)
    same[1:] = (row[order][1:] == row[order][:-1]) & (value[order][1:] == value[order][:-1])
    later = np.zeros(len(order), bool)
    later[order] = same
    either = same.copy()
    either[:-1] |= same[1:]
    shared = np.zeros(len(order), bool)
    shared[order] = either
    return np.stack([later, shared])


def base_counts(chunk: Chunk) -> dict[str, np.ndarray]:
    """The fixed measures of each row of a chunk, exact up to 64-bit hashes of words and lines."""
    rows = chunk.last - chunk.first
    found = words(chunk)
    n_words = np.bincount(found.row, minlength=rows)
    inside = np.zeros(len(chunk.data) + 1, np.int64)
    np.cumsum((chunk.data & 0xC0) != 0x80, out=inside[1:])
    chars = inside[found.end] - inside[found.start]
    symbols = np.concatenate([[0], np.cumsum(_SYMBOL[chunk.data])])[chunk.bounds]
    first, value = windows(found, WINDOW)
    covered = np.zeros(len(found.row) + 1, np.int64)
    if len(first):
        _, shared = _repeats(found.row[first], value)
        np.add.at(covered, first[shared], 1)
        np.add.at(covered, first[shared] + WINDOW, -1)
    covered = np.cumsum(covered)[:-1] > 0
    start, end = runs(chunk.data != 0x0A, chunk.bounds)
    # a line counts if a word begins in it
    with_word = np.searchsorted(found.start, end) > np.searchsorted(found.start, start)
    start, end = start[with_word], end[with_word]
    line_row = rows_of(start, chunk.bounds)
    again = np.zeros(len(start), bool)
    if len(start):
        again, _ = _repeats(line_row, span_hashes(chunk.data, start, end))
    return {
        "n_words": n_words,
        "word_chars": np.bincount(found.row, chars, rows).astype(np.int64),
        "n_symbols": np.diff(symbols),
        "n_dup_lines": np.bincount(line_row[again], minlength=rows),
        "n_repeat_words": np.bincount(found.row[covered], minlength=rows),
    }


class Tokens:
    """Token measures of the rows of a chunk, from the tokens of its distinct words."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.model.get_piece_size()
        self.is_byte = np.array([self.model.is_byte(i) for i in range(size)])
        self.size = size

    def measures(self, chunk: Chunk) -> dict[str, np.ndarray]:
        rows = chunk.last - chunk.first
        found = words(chunk)
        zeros = np.zeros(rows)
        if not len(found.row):
            return {"n_tokens": zeros.astype(np.int64), "byte_share": zeros, "entropy": zeros}
        _, first, inverse = np.unique(found.hash, return_index=True, return_inverse=True)
        texts = [chunk.data[found.start[i] : found.end[i]].tobytes().decode() for i in first]
        pieces = self.model.encode(texts, num_threads=1)
        count = np.array([len(x) for x in pieces])
        flat = np.fromiter((t for x in pieces for t in x), np.int64, int(count.sum()))
        at = np.cumsum(count) - count
        n = count[inverse]
        before = np.cumsum(n) - n
        token = flat[np.repeat(at[inverse] - before, n) + np.arange(int(n.sum()))]
        row = np.repeat(found.row, n)
        total = np.bincount(row, minlength=rows)
        code, times = np.unique(row * self.size + token, return_counts=True)
        part = -np.bincount(code // self.size, times * np.log2(times), rows)
        some = np.maximum(total, 1)
        return {
            "n_tokens": total,
            "byte_share": np.bincount(row, self.is_byte[token], rows) / some,
            "entropy": np.where(total > 0, np.log2(some) + part / some, 0.0),
        }


def scripts(chunk: Chunk) -> list[str]:
    """The script of most letters of each row; ``other`` without letters."""
    text = np.frombuffer(chunk.data.tobytes().decode().encode("utf-32-le"), np.uint32)
    byte_at = np.flatnonzero((chunk.data & 0xC0) != 0x80)
    row = rows_of(byte_at, chunk.bounds)
    kind = np.searchsorted(_STARTS, text, "right") - 1
    letter = (kind > 0) | ((text | 0x20) - 0x61 < 26) | ((text >= 0xC0) & (text < 0x370))
    rows = chunk.last - chunk.first
    table = np.bincount(row[letter] * len(_NAMES) + kind[letter], minlength=rows * len(_NAMES))
    table = table.reshape(rows, len(_NAMES))
    return [_NAMES[k] if n else "other" for k, n in zip(table.argmax(axis=1), table.max(axis=1))]


_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens"]


def measured(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, lang, a hash of the text and all measures of every row; a text is read once."""
    held: dict[str, Tokens] = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = held.setdefault(path, Tokens(path))
        for batch in batches:
            for chunk in chunks(batch.column(3)):
                found = base_counts(chunk) | tokens.measures(chunk)
                n = chunk.last - chunk.first
                columns = [batch.column(k).slice(chunk.first, n) for k in range(3)]
                columns += [pa.array(scripts(chunk), pa.string())]
                columns += [pa.array(found[name].astype(np.int64)) for name in _COUNTS]
                columns += [pa.array(found[name].astype(float)) for name in ("byte_share", "entropy")]
                yield pa.RecordBatch.from_arrays(
                    columns, ["doc_id", "lang", "hash", "script", *_COUNTS, "byte_share", "entropy"]
                )

    lang = F.col("lang") if "lang" in docs.columns else F.lit(None)
    return docs.select(
        "doc_id", lang.cast("string").alias("lang"), F.xxhash64("text").alias("hash"), "text"
    ).mapInArrow(
        run,
        "doc_id long, lang string, hash long, script string, "
        + ", ".join(f"{name} long" for name in _COUNTS)
        + ", byte_share double, entropy double",
    )


def quality(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The measures, base_failed and kept for every row of ``docs``.

    Bands come from the distinct texts that pass the base rules, for each language, or for each
    script where the language is null; however often a text is copied, it counts once. Entropy is taken relative to the logarithm of the
    number of tokens, which makes texts of different lengths comparable. Texts that are
    null, empty or without words have zero counts and fail the base rules. Rows that repeat
    get equal results; other columns are ignored; an empty table gives an empty result.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    table = stage(
        measured(docs, path)
        .withColumn("base_failed", failed)
        .withColumn("chars_per_token", F.col("word_chars") / F.greatest("n_tokens", F.lit(1)))
        .withColumn("evenness", F.col("entropy") / F.log2(F.greatest("n_tokens", F.lit(2)))),
        "measures",
    )
    names = ["chars_per_token", "byte_share", "evenness"]
    group = F.coalesce(F.concat(F.lit("lang "), "lang"), F.concat(F.lit("script "), "script"))
    quarters = (
        table.filter("NOT base_failed")
        .groupBy(group.alias("of"), "hash")
        .agg(*(F.first(name).alias(name) for name in names))
        .groupBy("of")
        .agg(*(F.percentile_approx(name, [0.25, 0.5, 0.75], 1000).alias(f"{name}_at") for name in names))
    )
    # one row for each language or script
    joined = table.join(broadcast_if_small(stage(quarters, "quarters")), group == F.col("of"), "left")
    error = ERRORS / F.sqrt(F.greatest("n_tokens", F.lit(1)))

    def within(name: str, floor: float):
        at = F.col(f"{name}_at")
        width = WIDTH * F.greatest(at[2] - at[0], F.lit(floor)) + error * F.greatest(at[1], F.lit(floor)) / 4
        return F.col(name) - at[1], width

    off, width = within("chars_per_token", 0.05)
    bytes_off, bytes_width = within("byte_share", 0.005)
    even_off, even_width = within("evenness", 0.01)
    usual = (F.abs(off) <= width) & (bytes_off <= bytes_width) & (F.abs(even_off) <= even_width)
    return joined.select(
        "doc_id",
        *_COUNTS,
        "script",
        "chars_per_token",
        "byte_share",
        "entropy",
        "base_failed",
        (~F.col("base_failed") & F.coalesce(usual, F.lit(True))).alias("kept"),
    )
