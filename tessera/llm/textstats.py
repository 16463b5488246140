"""Statistics of whole documents that the quality operators share.

One Arrow pass over the texts gives one small row per document; everything later
works on those rows.
"""

from __future__ import annotations

import math
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.llm.common import SPACE_CHARS, WORD, materialize, small_batches, worker_state

SYMBOLS = "#*$%&|<>"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Names of the entries of `features`, in order.
FEATURES = (
    "log_words", "mean_word", "symbols_per_word", "dup_line_share", "repeat_share", "upper_share", "punct_share",
    "digit_share", "bangs_per_word", "letter_share", "short_word_share", "long_word_share", "bars_per_word",
    "distinct_share", "log_line_words", "commas_per_word", "accent_share",
)
STATS_SCHEMA = "doc_id long, has_text boolean, " + ", ".join(f"{c} long" for c in BASE) + ", features array<double>"
WINDOW = 8


def _char_classes() -> np.ndarray:
    """Class of every code point of the first plane: 0 other, 1 upper, 2 lower and other letters, 3 digit, 4 punctuation, 5 symbol, 6 space."""
    kinds = {"Lu": 1, "Lt": 1, "Ll": 2, "Lo": 2, "Lm": 2, "Nd": 3, "Zs": 6}
    by_initial = {"P": 4, "S": 5}
    found = np.zeros(0x10000, np.uint8)
    for c in range(0x10000):
        kind = unicodedata.category(chr(c))
        found[c] = kinds.get(kind, by_initial.get(kind[0], 0))
    found[list(map(ord, SPACE_CHARS))] = 6
    return found


def repeated_words(words: list[str]) -> int:
    """Words inside windows of eight words that occur twice or more in the text."""
    n = len(words)
    if n <= WINDOW:
        return 0
    h = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    for step, k in ((1, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F), (4, 0x165667B19E3779F9)):
        h = (h[:-step] * np.uint64(k)) ^ ((h[step:] >> np.uint64(29)) + h[step:])
    ordered = np.sort(h)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    if not again.size:
        return 0
    # Hashes only propose: equal windows are confirmed on the words themselves.
    places: dict[tuple, list[int]] = {}
    for i in np.flatnonzero(np.isin(h, again)).tolist():
        places.setdefault(tuple(words[i : i + WINDOW]), []).append(i)
    covered = np.zeros(n + 1, np.int64)
    for at in places.values():
        if len(at) > 1:
            starts = np.array(at)
            covered[starts] += 1
            np.subtract.at(covered, np.minimum(starts + WINDOW, n), 1)
    return int((np.cumsum(covered[:n]) > 0).sum())


def document_stats(text: str | None, classes: np.ndarray) -> tuple[tuple[int, ...], list[float]]:
    """The five base counts and the features of one text; null counts as empty."""
    text = text or ""
    words = WORD.findall(text)
    n = len(words)
    if not n:
        return (0, 0, 0, 0, 0), [0.0] * len(FEATURES)
    lines = [x for x in text.split("\n") if x.strip(SPACE_CHARS)]
    duplicate_lines = len(lines) - len(set(lines))
    chars = len(text) - sum(map(text.count, SPACE_CHARS))
    symbols = sum(map(text.count, SYMBOLS))
    repeats = repeated_words(words)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    counts = np.bincount(classes[np.minimum(codes, 0xFFFF)], minlength=7)
    letters = int(counts[1] + counts[2])
    lengths = np.fromiter(map(len, words), np.int64, n)
    accents = int((codes > 127).sum())
    features = [
        math.log1p(n),
        chars / n,
        symbols / n,
        duplicate_lines / len(lines),
        repeats / n,
        int(counts[1]) / max(letters, 1),
        int(counts[4]) / chars,
        int(counts[3]) / chars,
        text.count("!") / n,
        letters / chars,
        int((lengths <= 3).sum()) / n,
        int((lengths >= 12).sum()) / n,
        text.count("|") / n,
        len(set(words)) / n,
        math.log1p(n / len(lines)),
        text.count(",") / n,
        accents / max(letters, 1),
    ]
    return (n, chars, symbols, duplicate_lines, repeats), features


def _stats(batches):
    classes = worker_state("char_classes", _char_classes)
    for batch in batches:
        texts = batch.column("text").to_pylist()
        rows = [document_stats(t, classes) for t in texts]
        columns = [batch.column("doc_id").cast(pa.int64()), pa.array([t is not None for t in texts], pa.bool_())]
        columns += [pa.array([r[0][k] for r in rows], pa.int64()) for k in range(len(BASE))]
        columns.append(pa.array([r[1] for r in rows], pa.list_(pa.float64())))
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "has_text", *BASE, "features"])


def stats_table(docs: DataFrame) -> DataFrame:
    """doc_id, has_text, the base counts and features of every document, as a written table."""
    small_batches(docs.sparkSession)
    return materialize(docs.select("doc_id", "text").mapInArrow(_stats, STATS_SCHEMA), "stats")
