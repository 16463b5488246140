"""Near-duplicate detection with SetSketch registers.

A document's set of word shingles is sketched by exponentially spaced, truncated minima:
register k holds floor(1 - log_b h) of the smallest exponential value h that hash k gives
an element.  Sketches of parts merge by maximum, and equal registers are as likely as the
sets are similar, so

1. documents with equal sets form a class, and one of each class goes on;
2. bands of registers put similar documents into common buckets;
3. in each bucket everyone is paired with the most central member, and pairs whose joint
   likelihood rules out the threshold are dropped;
4. in buckets that would still hold several components if all these pairs were links, all
   further plausible pairs of different components are looked for, on registers;
5. the full sets of all documents of plausible pairs are made in one pass over the texts;
6. the pairs of step 3 are confirmed on full sets, and plausible pairs between different
   components of the confirmed links are compared on full sets, bucket by bucket;
7. components of the confirmed links give the result.

Step 3 is linear in the bucket sizes and connects nearly everything.  In steps 4 and 6 the
largest component of a bucket is never compared with itself: its members meet the others
alone, block by block.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialize, small_batches
from tessera.llm.components import components
from tessera.llm.shingles import batch_words, mix, text_shingles

REGISTERS, BANDS, BAND_WIDTH = 256, 24, 4
BASE, RATE, TOP = 1.001, 20.0, (1 << 16) - 1
#: Deviations of the similarity estimate that a pair may lie below the threshold.
MARGIN = 5.0
#: Open members of a bucket that one task compares with as many others.
BLOCK = 1000
SKETCH = "doc_id long, n_shingles long, set_a long, set_b long, registers binary, buckets array<long>"
GRID = np.linspace(0.0, 1.0, 201)


def multipliers(count: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(1, 2**63, count, np.uint64) << np.uint64(1) | np.uint64(1), rng.integers(0, 2**63, count, np.uint64)


def registers_of(elements: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """SetSketch registers of a set of 64-bit hashes."""
    least = np.full(len(a), np.iinfo(np.uint64).max)
    for at in range(0, len(elements), 512):
        values = elements[at : at + 512, None] * a + b
        least = np.minimum(least, values.min(axis=0))
    # The smallest of uniform values gives the smallest exponential value.
    exponential = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64 * (1 - 1e-16)) / RATE
    return np.clip(np.floor(1.0 - np.log(exponential) / math.log(BASE)), 0, TOP).astype(np.uint16)


def bucket_keys(registers: np.ndarray) -> np.ndarray:
    """One 64-bit bucket key per band, of one sketch or of rows of sketches."""
    bands = registers[..., : BANDS * BAND_WIDTH].astype(np.uint64).reshape(*registers.shape[:-1], BANDS, BAND_WIDTH)
    packed = (bands << np.array([0, 16, 32, 48], np.uint64)).sum(axis=-1, dtype=np.uint64)
    return mix(packed ^ mix(np.arange(1, BANDS + 1, dtype=np.uint64)))


def estimate(more: np.ndarray, less: np.ndarray, n_u: np.ndarray, n_v: np.ndarray) -> np.ndarray:
    """Most likely Jaccard similarity of pairs from the numbers of registers that are larger and smaller in the first.

    The likelihood is that of two sketches of sets of known sizes: a register of the first is
    larger with probability p(u - vJ), smaller with p(v - uJ), u and v being the sizes' shares.
    """
    u = (n_u / (n_u + n_v))[:, None]
    v = 1.0 - u
    j = GRID[None, :] * np.minimum(u / v, v / u)

    def p(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0.0, 1.0) * (BASE - 1.0) / BASE) / math.log(BASE)

    up, down = p(u - v * j), p(v - u * j)
    tiny = 1e-12
    same = (REGISTERS - more - less)[:, None]
    value = more[:, None] * np.log(up + tiny) + less[:, None] * np.log(down + tiny) + same * np.log(np.maximum(1.0 - up - down, tiny))
    return j[np.arange(len(j)), value.argmax(axis=1)]


def plausible(first: np.ndarray, second: np.ndarray, n_first: np.ndarray, n_second: np.ndarray, percent: int) -> np.ndarray:
    """Whether rows of registers can belong to sets as similar as the threshold: exact size bound, then likelihood."""
    found = 100 * np.minimum(n_first, n_second) >= percent * np.maximum(n_first, n_second)
    at = np.flatnonzero(found)
    if at.size:
        a, b = first[at], second[at]
        j = estimate((a > b).sum(axis=1), (a < b).sum(axis=1), n_first[at].astype(float), n_second[at].astype(float))
        t = percent / 100
        found[at] = j >= t - MARGIN * math.sqrt(t * (1 - t) / REGISTERS)
    return found


def sketches(docs: DataFrame) -> DataFrame:
    """The sketch of every row's shingle set, as a written table; no words: no buckets."""
    small_batches(docs.sparkSession)

    def sketch(batches):
        a, b = multipliers(REGISTERS)
        for batch in batches:
            words, bounds = batch_words(batch.column(1))
            rows = []
            for k in range(batch.num_rows):
                elements = np.unique(text_shingles(words[bounds[k] : bounds[k + 1]]))
                if not len(elements):
                    rows.append((0, 0, 0, None, []))
                    continue
                digest = np.array([elements.sum(dtype=np.uint64), mix(elements).sum(dtype=np.uint64)]).view(np.int64)
                registers = registers_of(elements, a, b)
                rows.append((len(elements), int(digest[0]), int(digest[1]), registers.tobytes(), bucket_keys(registers).view(np.int64)))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], ["doc_id", "n_shingles", "set_a", "set_b", "registers", "buckets"])

    return materialize(docs.select("doc_id", "text").mapInArrow(sketch, SKETCH), "sketches")


def full_sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """id, elements (sorted hashes as bytes) of every text of the documents in ids (one column, id), as a written table.

    The texts are dealt by id whatever the number of ids, so the cost is in proportion.
    """
    rows = docs.filter(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("id"), "text")
    wanted = rows.join(ids.hint("shuffle_hash"), "id", "left_semi")

    def sets(batches):
        for batch in batches:
            words, bounds = batch_words(batch.column(1))
            found = [np.unique(text_shingles(words[bounds[k] : bounds[k + 1]])).tobytes() for k in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["id", "elements"])

    found = wanted.mapInArrow(sets, "id long, elements binary").filter(F.length("elements") > 0)
    return materialize(found.withColumn("digest", F.xxhash64("elements")).dropDuplicates(["id", "digest"]).drop("digest"), "sets")


def similar(x, y, percent: int) -> bool:
    """Whether two sets, sorted 64-bit hashes as bytes, are as similar as the threshold."""
    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    common = int((y[at] == x).sum())
    return 100 * common >= percent * (len(x) + len(y) - common)


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are as similar as the threshold, as a written table."""
    # b, the side that is spread out, is joined first; Spark splits the hot partitions of a.
    both = pairs.join(sets.select(F.col("id").alias("b"), F.col("elements").alias("of_b")), "b").join(sets.select(F.col("id").alias("a"), F.col("elements").alias("of_a")), "a")

    def check(batches):
        for batch in batches:
            keep = [similar(x.as_buffer(), y.as_buffer(), percent) for x, y in zip(batch.column(2), batch.column(3), strict=True)]
            kept = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(kept), batch.column(1).filter(kept)], ["a", "b"])

    return materialize(both.select("a", "b", "of_a", "of_b").mapInArrow(check, "a long, b long").distinct(), "links")


def _rows(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def star_pairs(places: DataFrame, sketch: DataFrame, percent: int) -> DataFrame:
    """Plausible pairs (a, b) of a bucket's most central member a and each other member b.

    places: bucket, id.  A document is the more central the fuller the buckets it is in: the
    text that copies were made from shares more buckets with the copies than they do.
    """
    sizes = places.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    shared = materialize(places.join(sizes, "bucket"), "shared")
    weight = shared.groupBy("id").agg(F.sum("n").alias("weight"))
    hubs = shared.join(weight, "id").groupBy("bucket").agg(F.max(F.struct("weight", (-F.col("id")).alias("minus"))).alias("hub"))
    pairs = shared.join(hubs.select("bucket", (-F.col("hub.minus")).alias("a")), "bucket").filter(F.col("id") != F.col("a")).select("a", F.col("id").alias("b")).distinct()
    both = pairs.join(sketch.select(F.col("id").alias("b"), F.col("registers").alias("of_b"), F.col("n").alias("n_b")), "b").join(
        sketch.select(F.col("id").alias("a"), F.col("registers").alias("of_a"), F.col("n").alias("n_a")), "a"
    )

    def filter_pairs(batches):
        for batch in batches:
            keep = plausible(_rows(batch.column(2)), _rows(batch.column(3)), batch.column(4).to_numpy(), batch.column(5).to_numpy(), percent) if batch.num_rows else []
            kept = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(kept), batch.column(1).filter(kept)], ["a", "b"])

    return materialize(both.select("a", "b", "of_a", "of_b", "n_a", "n_b").mapInArrow(filter_pairs, "a long, b long").distinct(), "pairs")


def cells_of(batches):
    """The cells of a partition sorted by (bucket, i, j), one table each."""
    waiting: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        keys = [batch.column(k).to_numpy() for k in range(3)]
        new = np.zeros(batch.num_rows, bool)
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
        bounds = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
        for start, end in zip(bounds, bounds[1:], strict=False):
            if start == end:
                continue
            now = tuple(k[start] for k in keys)
            if now != last and waiting:
                yield pa.Table.from_batches(waiting)
                waiting = []
            last = now
            waiting.append(batch.slice(start, end - start))
    if waiting:
        yield pa.Table.from_batches(waiting)


def cell_pairs(cell: pa.Table, percent: int):
    """Places (x, others) of plausible pairs of different components of one cell whose first common bucket is the cell's."""
    number = {k: cell.column(k).to_numpy() for k in ("bucket", "i", "j", "own", "id", "root", "n")}
    i, j, bucket = number["i"][0], number["j"][0], number["bucket"][:1].view(np.uint64)[0]
    registers = _rows(cell.column("registers"))
    own, root, ids, n = number["own"], number["root"], number["id"], number["n"]
    keys = bucket_keys(registers)
    for x in np.flatnonzero(own == i).tolist():
        others = np.flatnonzero((own == j) & (root != root[x]) & ((ids > ids[x]) if i == j else True))
        if others.size:
            others = others[keys[x][(keys[others] == keys[x]).argmax(axis=1)] == bucket]
        if others.size:
            same = np.broadcast_to(registers[x], (len(others), REGISTERS))
            yield x, others[plausible(same, registers[others], np.full(len(others), n[x]), n[others], percent)]


def dealt_cells(places: DataFrame, roots: DataFrame, block: int = BLOCK) -> DataFrame:
    """bucket, i, j, own, id, root: the members of buckets of several components, dealt to cells where every two that may be linked meet.

    places: bucket, id; roots: node, root.  A bucket's largest component is cut into blocks -1,
    -2, ...; all other members into blocks 0, 1, ...  Cell (i, j) holds blocks i and j: every two
    blocks of the others meet, and each of them meets those of the largest component, which
    never meet each other.  So m members of whom k stand outside the largest component give
    about m * ceil(k / block) + k * m / block rows, and a cell has about 2 * block.
    """
    known = places.join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    known = materialize(known, "placed")
    parts = known.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"))
    wide = parts.groupBy("bucket").agg(F.max(F.struct("n", "root")).alias("top"), F.sum("n").alias("all")).filter(F.col("all") > F.col("top.n"))
    blocks = wide.select(
        "bucket", F.col("top.root").alias("top"), F.ceil((F.col("all") - F.col("top.n")) / block).cast("int").alias("small"), F.ceil(F.col("top.n") / block).cast("int").alias("large")
    )
    members = known.join(blocks, "bucket").withColumn("in_top", F.col("root") == F.col("top"))
    place = F.pmod(F.xxhash64("id"), F.when(F.col("in_top"), F.col("large")).otherwise(F.col("small"))).cast("int")
    members = members.withColumn("own", F.when(F.col("in_top"), -1 - place).otherwise(place))
    every = F.sequence(F.lit(0), F.col("small") - 1)
    with_small = F.transform(every, lambda k: F.struct(F.least(k, F.col("own")).alias("i"), F.greatest(k, F.col("own")).alias("j")))
    with_large = F.transform(F.sequence(F.lit(1), F.col("large")), lambda k: F.struct(F.col("own").alias("i"), (-k).alias("j")))
    cells = F.when(F.col("in_top"), F.transform(every, lambda k: F.struct(k.alias("i"), F.col("own").alias("j")))).otherwise(F.concat(with_small, with_large))
    return members.select("bucket", "id", "root", "own", F.explode(cells).alias("cell")).select("bucket", "cell.i", "cell.j", "own", "id", "root")


def by_cell(rows: DataFrame) -> DataFrame:
    return rows.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")


def plausible_members(places: DataFrame, sketch: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """The rows of dealt_cells that have a plausible partner of another component there, as a written table."""

    def involved(batches):
        for cell in cells_of(batches):
            some: set[int] = set()
            for x, others in cell_pairs(cell, percent):
                some.update([x, *others.tolist()] if others.size else [])
            if some:
                yield from cell.select(["bucket", "i", "j", "own", "id", "root"]).take(pa.array(sorted(some))).combine_chunks().to_batches()

    ordered = by_cell(dealt_cells(places, roots).join(sketch, "id").select("bucket", "i", "j", "own", "id", "root", "registers", "n"))
    return materialize(ordered.mapInArrow(involved, "bucket long, i int, j int, own int, id long, root long").distinct(), "open")


def open_links(members: DataFrame, sketch: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Confirmed links (a, b) between different components, enough to join whatever true links join.

    members: rows of plausible_members.  Full sets are compared where they are, until the
    components of a cell are joined; no pair is written out but a confirmed one.
    """

    def link(batches):
        for cell in cells_of(batches):
            roots, ids, elements = cell.column("root").to_pylist(), cell.column("id").to_pylist(), cell.column("elements")
            joined = {r: r for r in roots}

            def find(r: int) -> int:
                while joined[r] != r:
                    joined[r] = joined[joined[r]]
                    r = joined[r]
                return r

            found = []
            for x, others in cell_pairs(cell, percent):
                for o in others.tolist():
                    one, other = find(roots[x]), find(roots[o])
                    if one != other and similar(elements[x].as_buffer(), elements[o].as_buffer(), percent):
                        joined[max(one, other)] = min(one, other)
                        found.append(sorted((ids[x], ids[o])))
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    whole = by_cell(members.join(sketch, "id").join(sets, "id").select("bucket", "i", "j", "own", "id", "root", "registers", "n", "elements"))
    return materialize(whole.mapInArrow(link, "a long, b long").distinct(), "links")


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id, kept and n_links of every row of docs (doc_id, text).

    Two documents are linked if 100 * |intersection| >= percent * |union| of their shingle
    sets; component_id is the smallest doc_id reachable by links.  n_links counts the
    confirmed links of the class that the document stands for: links that components needed,
    not all that there are (copies of one set are not expanded, nor are links inside a
    component that other links have joined).  Null, empty and blank texts have an empty set:
    such a row is linked with nothing and keeps its own id.  Repeated rows share an id and a
    component.  Different texts of one doc_id are one document, linked with whatever one of
    them is linked with.  A null doc_id can't be linked to: its component is null and it is
    kept.
    """
    sketch = sketches(docs)
    sized = sketch.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    same: list[str | Column] = ["set_a", "set_b", "n_shingles"]
    classes = materialize(sized.groupBy(*same).agg(F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("members")), "classes")
    heads = classes.select(*same, F.col("id").alias("doc_id"))
    chosen = sized.join(heads, [*same, "doc_id"], "left_semi").dropDuplicates(["doc_id", "set_a", "set_b"])
    chosen = materialize(chosen.select(F.col("doc_id").alias("id"), "registers", F.col("n_shingles").alias("n"), "buckets"), "chosen")
    places = chosen.select("id", F.explode("buckets").alias("bucket")).distinct()
    registers = chosen.select("id", "registers", "n")

    pairs = star_pairs(places, registers, percent)
    maybe = plausible_members(places, registers, materialize(components(pairs), "roots"), percent)
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).unionByName(maybe.select("id")).distinct()
    ids = materialize(ids, "ids")
    sets = full_sets(docs, ids)
    links = confirm(pairs, sets, percent)
    # Documents of several texts join the classes that the texts are in.
    several = sized.groupBy("doc_id").agg(*(f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in ("set_a", "set_b")))
    several = several.filter((F.col("min_set_a") != F.col("max_set_a")) | (F.col("min_set_b") != F.col("max_set_b"))).select("doc_id")
    own = materialize(sized.join(several, "doc_id").select("doc_id", *same).join(classes, same).select("doc_id", "id").distinct(), "several")
    hubs = own.groupBy("doc_id").agg(F.min("id").alias("a"))
    links = links.unionByName(own.join(hubs, "doc_id").filter(F.col("id") != F.col("a")).select("a", F.col("id").alias("b")))
    roots = materialize(components(links), "roots")

    left = plausible_members(places.join(ids, "id", "left_semi"), registers, roots, percent)
    more = open_links(left, registers, sets, percent)
    if more.limit(1).count():
        links = links.unionByName(more)
        roots = materialize(components(links), "roots")
    degree = links.select(F.col("a").alias("id")).unionByName(links.select(F.col("b").alias("id"))).groupBy("id").agg(F.count(F.lit(1)).alias("n_links"))
    named = classes.join(roots.withColumnRenamed("node", "id"), "id", "left").join(degree, "id", "left")
    named = named.select(*same, F.coalesce("root", "id").alias("root"), F.coalesce("n_links", F.lit(0)).alias("n_links"), "members")
    # Classes of one document that no link touches are their own component: only the others are joined back.
    named = materialize(named.filter((F.col("members") > 1) | (F.col("n_links") > 0)).drop("members"), "named")
    rows = sketch.select("doc_id", *same)
    found = rows.join(named, same, "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("root", "doc_id")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return found.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


#: The links and components of op8 by an exact join on shingles, for tables that a single machine can compare.
ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(words) >= 5 THEN list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i+4], ' ')))
    WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END AS shingles FROM w),
e AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS x FROM s),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS node, doc_id AS root FROM s UNION SELECT r.node, edges.b FROM reach r JOIN edges ON edges.a = r.root),
roots AS (SELECT node, min(root) AS root FROM reach GROUP BY node)
SELECT s.doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, root AS component_id, s.doc_id = root AS kept FROM s JOIN roots ON node = s.doc_id
"""
