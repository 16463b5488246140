"""Benchmark decontamination with SimHash over item-sized windows.

The benchmark is the stated query set; Spark cuts it into blocks of bounded size in the
shared folder, and one pass over the documents, without a shuffle, searches every text for
the items of all blocks, one block after the other:

* a window of an item's size is laid wherever one of the item's anchors, five-word shingles,
  occurs in the document, at the anchor's own offset.  Anchors are the item's shingles but the
  common ones; as a window that is similar enough holds four fifths of an item's shingles,
  an item with more anchors than a fifth always has one there;
* a window in which too few positions carry benchmark shingles to reach the similarity is
  passed over, which loses nothing;
* the window's SimHash is looked up in a multi-index of the items' fingerprints: 64 bits
  in four blocks of 16, each searched up to a distance of a quarter of the radius, so every
  item within the radius is found (by the pigeonhole principle);
* the exact similarity of the two weighted shingle sets (weight: number of occurrences)
  decides.
"""

from __future__ import annotations

from collections import Counter, OrderedDict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.llm.common import scratch, small_batches, worker_state
from tessera.llm.shards import store_of
from tessera.llm.shingles import WIDTH, batch_words, join_hashes

RADIUS, INDEX_BLOCKS, BLOCK_BITS = 23, 4, 16
SIMILARITY = 0.8
ITEMS_PER_BLOCK = 20_000
#: Places of a block's items that a shingle may have and still be an anchor of all of them.
COMMON_PLACES = 64
#: Texts searched for one block before the next, in bytes, and blocks that a worker keeps ready.
GROUP_BYTES, READY_BLOCKS = 32 << 20, 2
FILTER_BITS = 22
MATCHES = "array<struct<item_id:long,start:long,n_words:long,similarity:double>>"


def simhash(shingles: np.ndarray) -> np.uint64:
    """64 bits: which bits more than half of the shingles (with repeats) have set."""
    bits = np.unpackbits(shingles.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(2 * bits.sum(axis=0, dtype=np.int64) > len(shingles), bitorder="little").view(np.uint64)[0]


def near_values(distance: int) -> np.ndarray:
    """All 16-bit masks with at most `distance` bits set."""
    return np.array([sum(1 << b for b in some) for k in range(distance + 1) for some in combinations(range(BLOCK_BITS), k)], np.int64)


def weighted_similarity(a: Counter, b: Counter) -> float:
    """Sum of the smaller over sum of the larger occurrence numbers."""
    common = sum(min(n, b[x]) for x, n in a.items() if x in b)
    return common / (sum(a.values()) + sum(b.values()) - common)


class ItemIndex:
    """The items of one block: anchors (where each shingle stands in which item size) and the Hamming multi-index."""

    def __init__(self, item_ids: list[int], words: list[np.ndarray]):
        kept = [(i, w) for i, w in zip(item_ids, words, strict=True) if len(w) >= WIDTH]
        self.item_ids = [i for i, _ in kept]
        shingles = [join_hashes(w, WIDTH) for _, w in kept]
        self.weights = [Counter(s.tolist()) for s in shingles]
        self.prints = np.array([simhash(s) for s in shingles], np.uint64)
        places = Counter(h for s in shingles for h in s.tolist())
        self.anchors: dict[int, set[tuple[int, int]]] = {}
        for s in shingles:
            ranked = sorted((places[h], k, h) for k, h in enumerate(s.tolist()))
            needed = int((1 - SIMILARITY) * len(ranked)) + 1
            for n, (common, place, h) in enumerate(ranked):
                if n < needed or common <= COMMON_PLACES:
                    self.anchors.setdefault(h, set()).add((place, len(s) + WIDTH - 1))
        self.hashes = np.array(sorted(places), np.uint64)
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self.hashes >> np.uint64(64 - FILTER_BITS)] = True
        self.masks = near_values(RADIUS // INDEX_BLOCKS)
        self.tables = []
        for k in range(INDEX_BLOCKS):
            values = self._block(self.prints, k)
            order = np.argsort(values, kind="stable")
            self.tables.append((order, np.searchsorted(values[order], np.arange((1 << BLOCK_BITS) + 1))))
        self.found: dict[int, list[int]] = {}

    @staticmethod
    def _block(prints: np.ndarray, k: int) -> np.ndarray:
        return ((prints >> np.uint64(BLOCK_BITS * k)) & np.uint64((1 << BLOCK_BITS) - 1)).astype(np.int64)

    def within_radius(self, fingerprint: np.uint64) -> list[int]:
        """Places of all items whose fingerprint differs in at most RADIUS bits."""
        key = int(fingerprint)
        if key not in self.found:
            one = np.array([fingerprint], np.uint64)
            some = []
            for k, (order, starts) in enumerate(self.tables):
                values = self._block(one, k)[0] ^ self.masks
                for v in values[starts[values + 1] > starts[values]].tolist():
                    some.append(order[starts[v] : starts[v + 1]])
            near = np.unique(np.concatenate(some)) if some else np.zeros(0, np.int64)
            differ = np.bitwise_count(self.prints[near] ^ fingerprint)
            if len(self.found) > 100_000:
                self.found.clear()
            self.found[key] = near[differ <= RADIUS].tolist()
        return self.found[key]

    def is_anchor(self, shingles: np.ndarray) -> np.ndarray:
        """Which shingles stand in some item."""
        hit = self.filter[shingles >> np.uint64(64 - FILTER_BITS)]
        some = np.flatnonzero(hit)
        if some.size:
            at = np.minimum(np.searchsorted(self.hashes, shingles[some]), len(self.hashes) - 1)
            hit[some] = self.hashes[at] == shingles[some]
        return hit

    def matches(self, shingles: np.ndarray, hit: np.ndarray) -> list[dict]:
        """Items found in one text, each with its most similar window, in order of item_id."""
        upto = np.concatenate([[0], np.cumsum(hit)])
        n_words = len(shingles) + WIDTH - 1
        windows = {(max(p - place, 0), size) for p in np.flatnonzero(hit).tolist() for place, size in self.anchors.get(int(shingles[p]), ())}
        best: dict[int, tuple[float, int, int]] = {}
        for start, size in sorted(windows):
            end = min(start + size, n_words)
            last = end - WIDTH + 1
            if upto[last] - upto[start] < SIMILARITY * (size - WIDTH + 1) - 1e-9:
                continue
            inside = shingles[start:last]
            weights = None
            for k in self.within_radius(simhash(inside)):
                weights = weights or Counter(inside.tolist())
                similarity = weighted_similarity(self.weights[k], weights)
                if similarity >= SIMILARITY and (k not in best or similarity > best[k][0]):
                    best[k] = (similarity, start, end - start)
        return sorted(({"item_id": self.item_ids[k], "start": s, "n_words": n, "similarity": x} for k, (x, s, n) in best.items()), key=lambda m: m["item_id"])


def build_index(rows: list[tuple[int, str | None]]) -> ItemIndex:
    words, bounds = batch_words(pa.array([t for _, t in rows], pa.string()))
    return ItemIndex([i for i, _ in rows], [words[bounds[k] : bounds[k + 1]] for k in range(len(rows))])


def stored_blocks(benchmark: DataFrame, items_per_block: int = ITEMS_PER_BLOCK) -> tuple[str, int]:
    """(folder, number of blocks): the items (item_id, text), dealt by a hash into blocks of about items_per_block.

    Null ids and texts are no items.  Items go from Spark to the folder, never through the driver.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter(F.col("text").isNotNull() & F.col("item_id").isNotNull())
    blocks = max(1, -(-items.count() // items_per_block))
    folder = scratch(benchmark.sparkSession, "items")
    items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))).repartition("block").write.partitionBy("block").parquet(folder)
    return folder, blocks


def read_block(folder: str, block: int) -> ItemIndex:
    store, root = store_of(f"{folder}/block={block}")
    files = [f.path for f in store.get_file_info(fs.FileSelector(root, allow_not_found=True)) if f.path.endswith(".parquet")]
    rows = [(r["item_id"], r["text"]) for path in files for r in pq.read_table(path, filesystem=store, partitioning=None).to_pylist()]
    return build_index(sorted(rows))


def block_index(folder: str, block: int) -> ItemIndex:
    """The index of a block, made once per worker while it is among the last READY_BLOCKS asked for."""
    ready: OrderedDict[tuple[str, int], ItemIndex] = worker_state("item_blocks", OrderedDict)
    if (folder, block) not in ready:
        while len(ready) >= READY_BLOCKS:
            ready.popitem(last=False)
        ready[folder, block] = read_block(folder, block)
    ready.move_to_end((folder, block))
    return ready[folder, block]


def search_column(index: ItemIndex, texts: pa.Array) -> list[list[dict]]:
    """The items of one block in every text of a column."""
    words, bounds = batch_words(texts)
    if len(words) < WIDTH or not len(index.hashes):
        return [[] for _ in range(len(texts))]
    shingles = join_hashes(words, WIDTH)
    hit = index.is_anchor(shingles)
    found = []
    for k in range(len(texts)):
        a, b = int(bounds[k]), max(int(bounds[k]), int(bounds[k + 1]) - WIDTH + 1)
        found.append(index.matches(shingles[a:b], hit[a:b]) if hit[a:b].any() else [])
    return found


def search(rows: DataFrame, benchmark: DataFrame, items_per_block: int = ITEMS_PER_BLOCK) -> DataFrame:
    """rows (one struct column `row` with a field text) and matches: all items found in row.text, in order of item_id."""
    small_batches(rows.sparkSession)
    folder, blocks = stored_blocks(benchmark, items_per_block)
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int64()), ("n_words", pa.int64()), ("similarity", pa.float64())]))

    def groups(batches):
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            waiting.append(batch)
            if sum(b.nbytes for b in waiting) >= GROUP_BYTES:
                yield waiting
                waiting = []
        if waiting:
            yield waiting

    def find(batches):
        for group in groups(batches):
            found: list[list[list[dict]]] = [[[] for _ in range(batch.num_rows)] for batch in group]
            for block in range(blocks):
                index = block_index(folder, block)
                for batch, of_rows in zip(group, found, strict=True):
                    for all_, some in zip(of_rows, search_column(index, batch.column(0).field("text")), strict=True):
                        all_ += some
            for batch, of_rows in zip(group, found, strict=True):
                ordered = [sorted(x, key=lambda m: (m["item_id"], m["start"], m["n_words"], m["similarity"])) for x in of_rows]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ordered, kind)], ["row", "matches"])

    return rows.mapInArrow(find, StructType([rows.schema["row"], *StructType.fromDDL(f"matches {MATCHES}").fields]))


def find_benchmark(docs: DataFrame, benchmark: DataFrame, items_per_block: int = ITEMS_PER_BLOCK) -> DataFrame:
    """doc_id and matches (item_id, start, n_words, similarity) of every row of docs (doc_id, text).

    benchmark: item_id, text.  Items of fewer than five words have no shingle and match
    nothing; neither do null and empty texts.  A repeated item matches once per row.  Rows are
    searched one by one, so null ids and repeated rows change nothing.  Of an item's windows in
    a text the most similar one is given, the first of equals.  start and n_words count words
    from 0.
    """
    rows = docs.select(F.struct("doc_id", "text").alias("row"))
    return search(rows, benchmark, items_per_block).select("row.doc_id", "matches")


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, contaminated, n_items, items, and the most similar item with its similarity, of every row of docs.

    Rows, items and ties are treated as in find_benchmark; of equally similar items the smallest
    item_id is given.  Where nothing is found, item_id and similarity are null and items is empty.
    """
    found = find_benchmark(docs, benchmark)
    best = F.array_max(F.transform("matches", lambda m: F.struct(m["similarity"].alias("s"), (-m["item_id"]).alias("i"))))
    return found.select(
        "doc_id",
        (F.size("matches") > 0).alias("contaminated"),
        F.size("matches").cast("long").alias("n_items"),
        F.array_join(F.transform("matches", lambda m: m["item_id"].cast("string")), ",").alias("items"),
        (-best["i"]).alias("item_id"),
        best["s"].alias("similarity"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs in which no benchmark item is found, with docs' own columns, whatever their names.

    Rows are judged one by one as in find_benchmark: null and empty texts stay, and repeated
    rows stay or go together.
    """
    whole = docs.select(F.struct(*docs.columns).alias("row"))
    return search(whole, benchmark).filter(F.size("matches") == 0).select("row.*")


#: The matches by exact similarity of all windows that any shingle of an item places, without fingerprints; item_ids are unique.
ORACLE = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
iw AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM benchmark
  WHERE text IS NOT NULL AND item_id IS NOT NULL),
ds AS (SELECT doc_id, len(w) AS nw, unnest(range(0, len(w) - 4)) AS p, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) AS x FROM dw WHERE len(w) >= 5),
its AS (SELECT item_id, len(w) AS size, unnest(range(0, len(w) - 4)) AS k, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) AS x FROM iw WHERE len(w) >= 5),
counts AS (SELECT item_id, x, count(*) AS n FROM its GROUP BY item_id, x),
cand AS (SELECT DISTINCT doc_id, nw, item_id, size, greatest(p - k, 0) AS start FROM ds JOIN its ON ds.x = its.x),
placed AS (SELECT doc_id, item_id, start, size - 4 AS m, least(start + size, nw) - 4 AS upto FROM cand),
win AS (
  SELECT c.doc_id, c.item_id, c.start, c.m, c.upto - c.start AS n_window, ds.x, count(*) AS n FROM placed c JOIN ds ON ds.doc_id = c.doc_id AND ds.p >= c.start AND ds.p < c.upto
  GROUP BY c.doc_id, c.item_id, c.start, c.m, c.upto, ds.x),
common AS (
  SELECT win.doc_id, win.item_id, start, m, n_window, sum(least(win.n, counts.n)) AS common FROM win JOIN counts ON counts.item_id = win.item_id AND counts.x = win.x
  GROUP BY win.doc_id, win.item_id, start, m, n_window),
matches AS (SELECT doc_id, item_id, max(common / (m + n_window - common)::DOUBLE) AS s FROM common GROUP BY doc_id, item_id HAVING max(common / (m + n_window - common)::DOUBLE) >= 0.8),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) AS items, max(s) AS similarity, arg_min(item_id, (-s, item_id)) AS item_id FROM matches GROUP BY doc_id)
SELECT d.doc_id, n_items IS NOT NULL AS contaminated, coalesce(n_items, 0) AS n_items, coalesce(items, '') AS items, found.item_id, similarity
FROM documents d LEFT JOIN found ON found.doc_id = d.doc_id
"""
