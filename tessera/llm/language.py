"""Language identification with interpolated Kneser-Ney character models.

Training counts the character 4-grams of all training words, per language; lower orders
follow from continuation counts.  Counts, discounts and log probabilities are Spark
aggregates and joins; the models go from Spark to files in the shared folder, never through
the driver, and every Python worker reads them once into sorted hash arrays: per order the
hashes of seen n-grams with their interpolated log probability, and the hashes of contexts
with their back-off weight.  A text's language is the one with the lowest cross-entropy per
character; texts that fit their best language worse than nearly all of its training texts
are marked as rejected.
"""

from __future__ import annotations

import itertools
import re
import sys
import unicodedata
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import fold_of, materialize, scratch, small_batches, worker_state
from tessera.llm.shards import store_of

ORDER = 4
FOLDS, HELD_OUT, CALIBRATION = 5, 0, 1
#: Words whose scores a worker keeps before it starts anew, and the longest of them.
KNOWN_WORDS, LONG_WORD = 120_000, 48
#: Characters of text taken apart at a time.
PIECE_CHARS = 400_000
#: Bins of entropy per unit, for the bound of rejection.
ENTROPY_BINS = 10_000
MIX = np.uint64(0x9E3779B97F4A7C15)


def _class_of(initials: str, end: int = sys.maxunicode + 1) -> str:
    """A regular expression's ranges of the characters before `end` whose category starts with one of the initials."""
    of = [unicodedata.category(chr(c))[0] in initials for c in range(end)]
    edges = [c for c in range(len(of)) if of[c] != (c > 0 and of[c - 1])] + [len(of)]
    return "".join(f"\\U{a:08x}-\\U{b - 1:08x}" for a, b in zip(edges[::2], edges[1::2], strict=False))


def _letters(end: int = sys.maxunicode + 1) -> re.Pattern[str]:
    return re.compile(f"[{_class_of('L', end)}][{_class_of('LM', end)}]*")


#: A letter and the letters and combining marks behind it.
LETTERS = _letters()
OTHERS = re.compile(f"[^{_class_of('LM')}]")
#: The same for texts of the first blocks and of the first plane alone: classes of fewer ranges are much faster.
LATIN, BEYOND_LATIN = _letters(0x250), re.compile("[^\0-\u024f]")
FIRST_PLANE, BEYOND_PLANE = _letters(0x10000), re.compile("[\U00010000-\U0010ffff]")


def words_of(text: str) -> list[str]:
    """The runs of letters of a text."""
    if not BEYOND_LATIN.search(text):
        return LATIN.findall(text)
    return (LETTERS if BEYOND_PLANE.search(text) else FIRST_PLANE).findall(text)


class Model(NamedTuple):
    """Languages in order, size of the alphabet that all share, and the folder of the tables."""

    langs: tuple[str, ...]
    alphabet: int
    folder: str


def grams_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(4-grams of all words as packed 16-bit units, number of grams per word).

    A word is read as three blanks, its letters and a blank; letters beyond the first
    plane share the private-use area.
    """
    text = "".join(f"   {w} " for w in words)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    codes = np.where(codes > 0xFFFF, np.uint64(0xE000) + codes % np.uint64(0x1900), codes)
    if len(codes) < ORDER:
        return np.zeros(0, np.uint64), np.zeros(len(words), np.int64)
    packed = codes[: len(codes) - 3] << np.uint64(48) | codes[1:-2] << np.uint64(32) | codes[2:-1] << np.uint64(16) | codes[3:]
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    blocks = lengths + 4
    ends = np.cumsum(blocks)
    inside = np.ones(ends[-1], bool)
    for back in (1, 2, 3):  # windows that start in a block's last three places reach into the next word
        inside[ends - back] = False
    return packed[inside[: len(packed)]], lengths + 1


def hashed(keys: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of packed n-grams."""
    keys = keys * MIX
    return keys ^ (keys >> np.uint64(32))


def _table(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h = hashed(keys)
    order = np.argsort(h)
    return h[order], values[order].astype(np.float32)


def _find(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether each key is there, its value or 0)."""
    if not len(table[0]):
        return np.zeros(len(keys), bool), np.zeros(len(keys), np.float32)
    h = hashed(keys)
    at = np.minimum(np.searchsorted(table[0], h), len(table[0]) - 1)
    hit = table[0][at] == h
    return hit, np.where(hit, table[1][at], np.float32(0))


def gram_scores(tables: list[tuple], grams: np.ndarray, alphabet: int) -> np.ndarray:
    """Log probability of the last character of each gram after the three before it."""
    found = np.zeros(len(grams))
    open_ = np.arange(len(grams))
    for order in range(ORDER, 0, -1):
        keys = grams[open_] & np.uint64((1 << 16 * order) - 1) if order < ORDER else grams[open_]
        seen, backs = tables[order - 1]
        hit, value = _find(seen, keys)
        found[open_] += np.where(hit, value, _find(backs, keys >> np.uint64(16))[1])
        open_ = open_[~hit]
        if not open_.size:
            return found
    found[open_] -= np.log(alphabet)
    return found


def read_models(model: Model) -> list[list[tuple]]:
    """Per language the tables of orders 1 to 4: (n-grams -> log p, contexts -> log back-off weight)."""
    store, root = store_of(model.folder)
    files = sorted(f.path for f in store.get_file_info(fs.FileSelector(root)) if f.path.endswith(".parquet"))
    tables = pa.concat_tables([pq.read_table(path, filesystem=store, partitioning=None, read_dictionary=["lang"]) for path in files]).unify_dictionaries()
    lang, slot = tables["lang"].combine_chunks(), tables["slot"].to_numpy()
    keys, values = tables["key"].to_numpy().view(np.uint64), tables["value"].to_numpy()
    names = lang.dictionary.to_pylist()
    part = lang.indices.to_numpy() * 2 * ORDER + slot
    order = np.argsort(part, kind="stable")
    bounds = np.searchsorted(part[order], np.arange(len(names) * 2 * ORDER + 1))
    found = []
    for at in (names.index(x) * 2 * ORDER for x in model.langs):
        some = [order[bounds[at + k] : bounds[at + k + 1]] for k in range(2 * ORDER)]
        found.append([(_table(keys[some[k]], values[some[k]]), _table(keys[some[k + 1]], values[some[k + 1]])) for k in range(0, 2 * ORDER, 2)])
    return found


class Scorer:
    """Log probabilities of words under every language's model, kept for words seen before."""

    def __init__(self, model: Model):
        self.models, self.alphabet = read_models(model) if model.langs else [], model.alphabet
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.used = 0
        self.rows = np.zeros((1024, len(self.models) + 1))

    def learn(self, words: list[str]) -> None:
        """Keep the summed log probability of words under every model, and their length with the end, as the last column."""
        grams, n = grams_of(words)
        distinct, back = np.unique(grams, return_inverse=True)
        each = np.stack([gram_scores(m, distinct, self.alphabet) for m in self.models], axis=1)[back]
        while self.used + len(words) > len(self.rows):
            self.rows = np.vstack([self.rows, np.zeros_like(self.rows)])
        new = self.rows[self.used : self.used + len(words)]
        new[:, :-1] = np.add.reduceat(each, np.concatenate([[0], np.cumsum(n)[:-1]]), axis=0)
        new[:, -1] = n
        self.place.update(zip(words, range(self.used, self.used + len(words)), strict=True))
        self.used += len(words)

    def add(self, totals: np.ndarray, waiting: list[tuple[int, list[str]]]) -> None:
        """Add the words of some pieces, (number of the text, words), to the texts' totals."""
        if self.used > KNOWN_WORDS:
            self.clear()
        flat = list(itertools.chain.from_iterable(words for _, words in waiting))
        if new := list(set(flat).difference(self.place)):
            self.learn(new)
        sums = self.rows[np.fromiter(map(self.place.__getitem__, flat), np.int64, len(flat))]
        starts = np.cumsum([0, *(len(words) for _, words in waiting)])[:-1]
        np.add.at(totals, [k for k, _ in waiting], np.add.reduceat(sums, starts, axis=0))
        for word in new:  # long runs of letters, as of scripts without blanks, are not kept
            if len(word) > LONG_WORD:
                del self.place[word]

    def texts(self, texts: list[str | None], names: np.ndarray) -> list[tuple]:
        """(language, score, entropy, letters) of every text."""
        if not self.models:
            return [("und", 0.0, None, 0)] * len(texts)
        totals = np.zeros((len(texts), len(self.models) + 1))
        waiting: list[tuple[int, list[str]]] = []
        chars = 0
        for k, piece in pieces_of(texts):
            if words := words_of(piece):
                waiting.append((k, words))
                chars += len(piece)
            if chars >= PIECE_CHARS:
                self.add(totals, waiting)
                waiting, chars = [], 0
        if waiting:
            self.add(totals, waiting)
        return [self.verdict(t, names) for t in totals]

    @staticmethod
    def verdict(total: np.ndarray, names: np.ndarray) -> tuple:
        n = int(total[-1])
        if not n:
            return "und", 0.0, None, 0
        entropy = -total[:-1] / n
        best = int(entropy.argmin())
        share = np.exp((entropy[best] - entropy) * min(n, 200))
        return names[best], float(share[best] / share.sum()), float(entropy[best]), n


def pieces_of(texts: list[str | None]):
    """(number of the text, piece in lower case): long texts are cut where no word stands."""
    for k, text in enumerate(texts):
        text, at = text or "", 0
        while at < len(text):
            cut = OTHERS.search(text, at + PIECE_CHARS)
            end = cut.start() if cut else len(text)
            yield k, text[at:end].lower()
            at = end


def gram_counts(train: DataFrame, flush_words: int = 80_000) -> DataFrame:
    """lang, gram, n over the text of all rows of train (lang, text)."""
    small_batches(train.sparkSession)

    def rows(counts: dict[str, Counter]):
        for lang, words in sorted(counts.items()):
            names = list(words)
            grams, per_word = grams_of(names)
            weights = np.repeat(np.fromiter(words.values(), np.int64, len(names)), per_word)
            distinct, at = np.unique(grams, return_inverse=True)
            n = np.bincount(at, weights).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(distinct)), pa.array(distinct.view(np.int64)), pa.array(n)], ["lang", "gram", "n"])

    def count(batches):
        counts: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts.setdefault(lang, Counter()).update(words_of(text.lower()))
            if sum(map(len, counts.values())) > flush_words:
                yield from rows(counts)
                counts = {}
        yield from rows(counts)

    found = train.select("lang", "text").mapInArrow(count, "lang string, gram long, n long")
    return found.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def model_tables(grams: DataFrame, alphabet: int) -> tuple[tuple[str, ...], DataFrame]:
    """(languages, rows lang, slot, key, value) of all orders from counts (lang, gram, n).

    slot 2k - 2 holds the n-grams of order k with their log probability, slot 2k - 1 the contexts
    of order k with the log of their back-off weight.
    """
    mask = lambda order: F.lit((1 << 16 * order) - 1)
    levels = {ORDER: grams}
    for order in range(ORDER - 1, 0, -1):  # continuation counts: distinct left neighbours of each n-gram
        shorter = levels[order + 1].groupBy("lang", F.col("gram").bitwiseAND(mask(order)).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
        levels[order] = materialize(shorter, "grams")
    rare = [levels[k].groupBy("lang", F.lit(k).alias("level")).agg(F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") == 2).alias("twice")) for k in levels]
    discounts: dict[int, dict[str, float]] = {}
    for r in rare[0].unionByName(rare[1]).unionByName(rare[2]).unionByName(rare[3]).collect():  # one row per language and order
        discounts.setdefault(r["level"], {})[r["lang"]] = min(max(r["once"] / (r["once"] + 2 * r["twice"]), 0.1), 0.9) if r["once"] else 0.5
    parts: list[DataFrame] = []
    lower: DataFrame | None = None
    for order in range(1, ORDER + 1):
        of = F.create_map(*(F.lit(x) for kv in sorted(discounts[order].items()) for x in kv)) if discounts.get(order) else F.lit(None).cast("map<string,double>")
        level = levels[order].withColumn("context", F.shiftrightunsigned("gram", 16)).withColumn("discount", F.try_element_at(of, F.col("lang")))
        contexts = level.groupBy("lang", "context").agg(F.sum("n").alias("total"), (F.first("discount") * F.count(F.lit(1)) / F.sum("n")).alias("back"))
        contexts = materialize(contexts, "contexts")
        joined = level.join(contexts, ["lang", "context"])
        if lower is None:
            joined = joined.withColumn("below", F.lit(1.0 / alphabet))
        else:
            joined = joined.withColumn("shorter", F.col("gram").bitwiseAND(mask(order - 1))).join(lower.select("lang", F.col("gram").alias("shorter"), F.col("p").alias("below")), ["lang", "shorter"])
        lower = materialize(joined.select("lang", "gram", (F.greatest(F.col("n") - F.col("discount"), F.lit(0.0)) / F.col("total") + F.col("back") * F.col("below")).alias("p")), "chances")
        parts.append(lower.select("lang", F.lit(2 * order - 2).alias("slot"), F.col("gram").alias("key"), F.log("p").cast("float").alias("value")))
        parts.append(contexts.select("lang", F.lit(2 * order - 1).alias("slot"), F.col("context").alias("key"), F.log("back").cast("float").alias("value")))
    tables = parts[0]
    for part in parts[1:]:
        tables = tables.unionByName(part)
    return tuple(sorted(discounts.get(ORDER, {}))), tables


def fit(train: DataFrame) -> Model:
    """The models of all n-grams of all rows of train (lang, text), however rare; what reaches the driver is one row per language and order."""
    grams = materialize(gram_counts(train), "grams")
    alphabet = grams.select(F.col("gram").bitwiseAND(F.lit(0xFFFF)).alias("c")).distinct().count() + 1
    langs, tables = model_tables(grams, alphabet)
    folder = scratch(train.sparkSession, "models")
    tables.write.parquet(folder)
    return Model(langs, alphabet, folder)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs (doc_id, text and further columns but text) with lang_pred, score, entropy and n_chars."""
    small_batches(docs.sparkSession)
    carried = [c for c in docs.columns if c != "text"]
    names = np.array(model.langs, dtype=object)

    def score(batches):
        kept: dict[str, Scorer] = worker_state("language_models", dict)
        if model.folder not in kept:
            kept.clear()  # one model a worker
            kept[model.folder] = Scorer(model)
        for batch in batches:
            rows = kept[model.folder].texts(batch.column("text").to_pylist(), names)
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
            kinds = [pa.string(), pa.float64(), pa.float64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in carried), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], [*carried, "lang_pred", "score", "entropy", "n_chars"])

    schema = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes if c != "text") + ", lang_pred string, score double, entropy double, n_chars long"
    return docs.mapInArrow(score, schema)


def entropy_bounds(scored: DataFrame, accept: float) -> dict[str, float]:
    """Per language the entropy that at least the share `accept` of the rows doesn't exceed: exact to a bin, the same in every run."""
    counts = scored.groupBy("lang_pred", F.floor(F.col("entropy") * ENTROPY_BINS).alias("bin")).count()
    found: dict[str, list[tuple[int, int]]] = {}
    for r in counts.collect():  # at most one row per language and bin
        found.setdefault(r["lang_pred"], []).append((r["bin"], r["count"]))
    bounds = {}
    for lang, bins in found.items():
        upto, total = 0, sum(n for _, n in bins)
        for b, n in sorted(bins):
            upto += n
            if upto >= accept * total:
                bounds[lang] = (b + 1) / ENTROPY_BINS
                break
    return bounds


def identify(docs: DataFrame, accept: float = 0.995) -> DataFrame:
    """doc_id, held_out, lang_pred, score, entropy and rejected of every document.

    Learns from text and lang of all rows outside the held-out fold whose text and lang
    are there.  Null texts and texts without a letter are `und` with score 0; a language
    whose training texts have no letter is not learned.  rejected holds where the entropy
    exceeds the `accept` quantile of the predicted language.  The quantiles are those of one fold of
    the training rows under models of the other folds, so they hold for texts that no model has seen;
    predictions are those of models of all training rows.  A language without rightly predicted rows
    in that fold has no bound.  Without
    training rows every text is `und`.  Rows are judged one by one, whatever their id;
    repeated rows count as often as they stand there.
    """
    fold = fold_of(F.col("doc_id"), FOLDS)
    train = docs.filter((fold != HELD_OUT) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    apart = fold_of(F.col("doc_id"), FOLDS) == CALIBRATION
    unseen = train.filter(apart).select(F.col("lang").alias("truth"), "text")
    bounds = entropy_bounds(predict(unseen, fit(train.filter(~apart))).filter(F.col("truth") == F.col("lang_pred")), accept)
    model = fit(train)
    rows = docs.select("doc_id", (fold == HELD_OUT).alias("held_out"), "text")
    scored = materialize(predict(rows, model), "languages")
    above = F.lit(False)
    for lang, most in sorted(bounds.items()):
        above = above | ((F.col("lang_pred") == F.lit(lang)) & (F.col("entropy") > F.lit(most)))
    return scored.select("doc_id", "held_out", "lang_pred", "score", "entropy", F.coalesce(above, F.lit(False)).alias("rejected"))
