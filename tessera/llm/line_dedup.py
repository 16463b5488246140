"""Line deduplication by aligning overlapping documents.

1. Lines with a word get a 128-bit digest; a line that only one document holds can't be part
   of a common block and is left behind here.
2. What remains of a document falls into stretches of lines that follow each other.  A stretch
   is covered by runs: the shortest ones from each line on, and up to each line, that have enough
   words, and the whole stretch.
3. Documents meet through runs, and the rarest line of a run says how: where that line stands at
   most RARE times, a document is paired with every earlier holder of the run; a run of frequent
   lines alone gives a pair with its first holder, so n documents that share a passage never
   give n squared pairs.
4. Each pair is aligned as patience diff does it: the lines that its runs match, in the later
   document's order, and of these the longest sequence whose places in the earlier one ascend.
   What an alignment holds is deleted from the later document.  Matched lines that no alignment
   holds stand in another order there: they are counted apart and stay.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import SPACE_CHARS, WORD, materialize, small_batches

MIN_BLOCK_WORDS = 20
LINES = "doc_id long, text_id long, key long, check long, place int, n_words int"
#: A line that stands at most this often pairs all documents that hold a run with it.
RARE = 8
RUNS = "doc_id long, text_id long, rare long, n_rare long, run long, run_check long, first int, last int"


def text_lines(text: str | None) -> list[tuple[bytes, int]]:
    """(digest of 16 bytes, words) of the lines with a word, in order; blanks around a line don't count."""
    bare = (line.strip(SPACE_CHARS) for line in (text or "").split("\n"))
    return [(xxhash.xxh3_128_digest(x.encode("utf-8", "surrogatepass")), len(WORD.findall(x))) for x in bare if x]


def run_bounds(stretch: np.ndarray, words: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, last) of the shortest runs of at least min_words words from each line on and up to each line, inside one stretch, and of whole stretches with as many words."""
    n = len(words)
    upto = np.concatenate([[0], np.cumsum(words, dtype=np.int64)])
    every = np.arange(n)
    last = np.searchsorted(upto, upto[:-1] + min_words) - 1
    first = np.searchsorted(upto, upto[1:] - min_words, "right") - 1
    ahead = (last < n) & (stretch[np.minimum(last, n - 1)] == stretch)
    back = (first >= 0) & (stretch[np.maximum(first, 0)] == stretch)
    start, end = np.searchsorted(stretch, stretch, "left"), np.searchsorted(stretch, stretch, "right") - 1
    long = (start == every) & (upto[end + 1] - upto[start] >= min_words)
    both = np.unique(np.concatenate([every[ahead] * n + last[ahead], first[back] * n + every[back], every[long] * n + end[long]]))
    return both // n, both % n


def longest_ordered(places: list[int]) -> list[int]:
    """Positions of a longest strictly increasing subsequence (patience piles)."""
    tops: list[int] = []
    ends: list[int] = []
    before: list[int] = []
    for k, x in enumerate(places):
        at = bisect_left(tops, x)
        before.append(ends[at - 1] if at else -1)
        if at == len(tops):
            tops.append(x)
            ends.append(k)
        else:
            tops[at], ends[at] = x, k
    chain, k = [], ends[-1] if ends else -1
    while k >= 0:
        chain.append(k)
        k = before[k]
    return chain[::-1]


def aligned_places(matches: list[tuple[tuple[int, int], int, int, int]]) -> tuple[set[int], set[int]]:
    """(places that an alignment holds, all matched places) of a later text.

    matches: (earlier text, first, last, first place there) of the runs that a pair has in common.
    """
    pairs: dict[tuple[int, int], set[tuple[int, int]]] = {}
    for owner, first, last, there in matches:
        pairs.setdefault(owner, set()).update((place, place - first + there) for place in range(first, last + 1))
    aligned: set[int] = set()
    matched: set[int] = set()
    for lines in pairs.values():
        # Of the places that one line meets at most one can be in an ascending sequence, as they come in descending order.
        ordered = sorted(lines, key=lambda x: (x[0], -x[1]))
        aligned.update(ordered[k][0] for k in longest_ordered([there for _, there in ordered]))
        matched.update(place for place, _ in lines)
    return aligned, matched


def document_lines(docs: DataFrame) -> DataFrame:
    """The lines with a word of every text, as a written table.  text_id tells texts of one doc_id apart."""
    small_batches(docs.sparkSession)

    def cut(batches):
        for batch in batches:
            found = [text_lines(t) for t in batch.column(2).to_pylist()]
            counts = np.array([len(x) for x in found], np.int64)
            owner = np.repeat(np.arange(batch.num_rows), counts)
            digests = np.frombuffer(b"".join(d for x in found for d, _ in x), np.int64).reshape(-1, 2)
            places = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
            words = np.array([n for x in found for _, n in x], np.int32)
            columns = [batch.column(0).take(pa.array(owner)), batch.column(1).take(pa.array(owner)), pa.array(digests[:, 0]), pa.array(digests[:, 1])]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(places.astype(np.int32)), pa.array(words)], ["doc_id", "text_id", "key", "check", "place", "n_words"])

    rows = docs.filter(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_id"), "text")
    return materialize(rows.mapInArrow(cut, LINES), "lines")


def shared_runs(lines: DataFrame, min_words: int) -> DataFrame:
    """The runs of every text from lines that two documents or more hold, as a written table."""
    of_line = lines.groupBy("key", "check").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count(F.lit(1)).alias("holders"))
    shared = materialize(of_line.filter(F.col("low") < F.col("high")).select("key", "check", "holders"), "shared")
    # Spark splits the partitions of lines that very many documents hold; the next exchange deals by text.
    held = lines.join(shared, ["key", "check"]).groupBy("doc_id", "text_id").agg(F.collect_set(F.struct("place", "n_words", "key", "check", "holders")).alias("lines"))

    def runs(batches):
        for batch in batches:
            lists = batch.column(2)
            of = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
            fields = lists.flatten()
            place, words, key, check, holders = (fields.field(k).to_numpy() for k in range(5))
            order = np.lexsort((place, of))
            of, place, words, key, check, holders = (x[order] for x in (of, place, words, key, check, holders))
            new = np.ones(len(of), bool)
            new[1:] = (of[1:] != of[:-1]) | (place[1:] != place[:-1] + 1)
            first, last = run_bounds(np.cumsum(new), words, min_words) if len(of) else (of, of)
            content = np.stack([key, check], axis=1).tobytes()
            digests = b"".join(xxhash.xxh3_128_digest(content[16 * a : 16 * b + 16]) for a, b in zip(first.tolist(), last.tolist(), strict=True))
            rare = [min(zip(holders[a : b + 1].tolist(), key[a : b + 1].tolist(), strict=True)) for a, b in zip(first.tolist(), last.tolist(), strict=True)]
            pairs = np.frombuffer(digests, np.int64).reshape(-1, 2)
            texts = pa.array(of[first])
            columns = [batch.column(0).take(texts), batch.column(1).take(texts), pa.array([k for _, k in rare], pa.int64()), pa.array([n for n, _ in rare], pa.int64()), pa.array(pairs[:, 0]), pa.array(pairs[:, 1])]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(place[first].astype(np.int32)), pa.array(place[last].astype(np.int32))], ["doc_id", "text_id", "rare", "n_rare", "run", "run_check", "first", "last"]
            )

    return materialize(held.mapInArrow(runs, RUNS), "runs")


def common_blocks(docs: DataFrame, min_words: int = MIN_BLOCK_WORDS, moved: bool = False) -> DataFrame:
    """doc_id, text_id, doomed (places of lines to delete) and n_moved (matched lines that no alignment holds), as a written table."""
    runs = shared_runs(document_lines(docs), min_words)
    meeting = ["rare", "run", "run_check"]
    # Each holder's first place of a run; a run of frequent lines keeps its first holder only.
    holder = F.struct("doc_id", "text_id", "first")
    common = runs.filter(F.col("n_rare") > RARE).groupBy(*meeting).agg(F.min(holder).alias("holder"), F.max("doc_id").alias("latest"))
    common = common.filter(F.col("latest") > F.col("holder.doc_id")).select(*meeting, "holder")
    rare = runs.filter(F.col("n_rare") <= RARE).groupBy(*meeting, "doc_id", "text_id").agg(F.min(holder).alias("holder")).select(*meeting, "holder")
    holders = materialize(common.unionByName(rare), "holders")
    # As above, Spark splits the partitions of runs that very many documents hold; what follows is dealt by text.
    matched = runs.join(holders, meeting).filter(F.col("doc_id") > F.col("holder.doc_id"))
    match = F.struct(F.col("holder.doc_id").alias("owner"), F.col("holder.text_id").alias("owner_text"), "first", "last", F.col("holder.first").alias("there"))
    texts = matched.groupBy("doc_id", "text_id").agg(F.collect_set(match).alias("matches"))

    def align(batches):
        for batch in batches:
            rows = []
            for matches in batch.column(2).to_pylist():
                aligned, every = aligned_places([((m["owner"], m["owner_text"]), m["first"], m["last"], m["there"]) for m in matches])
                rows.append((sorted(every if moved else aligned), len(every) - len(aligned)))
            columns = [batch.column(0), batch.column(1), pa.array([x for x, _ in rows], pa.list_(pa.int32())), pa.array([n for _, n in rows], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_id", "doomed", "n_moved"])

    return materialize(texts.mapInArrow(align, "doc_id long, text_id long, doomed array<int>, n_moved long"), "doomed")


def without_lines(text: str, doomed: list[int]) -> tuple[str, int]:
    """(text without those lines with a word, words deleted)."""
    gone, kept, place, words = set(doomed), [], 0, 0
    for line in text.split("\n"):
        bare = line.strip(SPACE_CHARS)
        if bare:
            place += 1
            if place - 1 in gone:
                words += len(WORD.findall(bare))
                continue
        kept.append(line)
    return "\n".join(kept), words


def deduplicate_lines(docs: DataFrame, min_words: int = MIN_BLOCK_WORDS, moved: bool = False) -> DataFrame:
    """doc_id, text without the deleted blocks, n_lines, n_removed, n_moved and removed_words of every row of docs (doc_id, text).

    A line goes if the alignment with some earlier document holds it: one with a smaller doc_id
    that shares with this one a run of lines with at least min_words words, and is among the holders
    of that run that meet this document (all of them if the run has a line that stands at most RARE
    times, else the first).  n_lines counts lines with a word before, n_moved the lines of common
    runs that no alignment holds, because they stand in another order; with moved=True they go
    too.  A copy of an earlier document loses all its lines if it has min_words words; blank lines
    stay.  Null and empty texts have no line and stay as they are.  Rows of one doc_id are never
    compared with each other: equal ones lose the same lines, different texts of one doc_id are
    judged each.  A row whose doc_id is null has no place in the order and stays whole.  Lines are
    compared by digests of 128 bits.
    """
    doomed = common_blocks(docs, min_words, moved).select(F.col("doc_id").alias("other_id"), F.col("text_id").alias("other_text"), "doomed", "n_moved")
    small_batches(docs.sparkSession)

    def cut(batches):
        for batch in batches:
            rows = []
            for text, places, n in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)), strict=True):
                lines = sum(1 for x in (text or "").split("\n") if x.strip(SPACE_CHARS))
                left, words = without_lines(text, places) if text and places else (text, 0)
                rows.append((left, lines, len(places or []), n or 0, words))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            kinds = [pa.string(), *[pa.int64()] * 4]
            arrays = [batch.column(0).cast(pa.int64()), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "text", "n_lines", "n_removed", "n_moved", "removed_words"])

    # The deleted places grow with the corpus: the join is by sorting whatever their size, so its cost is in proportion.
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_id"))
    both = rows.join(doomed.hint("merge"), (F.col("doc_id") == F.col("other_id")) & (F.col("text_id") == F.col("other_text")), "left")
    return both.select("doc_id", "text", "doomed", "n_moved").mapInArrow(cut, "doc_id long, text string, n_lines long, n_removed long, n_moved long, removed_words long")


#: The rule in DuckDB, for tables of one row per doc_id: runs by their text, alignments by piles of places, element by element.
ORACLE = rf"""
WITH RECURSIVE raw AS (
  SELECT doc_id, unnest(range(0, len(parts))) AS pos, unnest(parts) AS raw FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)),
bare AS (SELECT *, regexp_replace(regexp_replace(raw, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', '') AS line FROM raw),
l AS (
  SELECT doc_id, pos, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS w, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS place
  FROM bare WHERE line <> ''),
held AS (SELECT line, count(*) AS holders FROM l GROUP BY line HAVING min(doc_id) < max(doc_id)),
s AS (SELECT l.*, holders, place - row_number() OVER (PARTITION BY doc_id ORDER BY place) AS stretch FROM l JOIN held USING (line)),
c AS (SELECT *, sum(w) OVER (PARTITION BY doc_id, stretch ORDER BY place) AS upto, sum(w) OVER (PARTITION BY doc_id, stretch ORDER BY place) - w AS ahead FROM s),
wide AS (
  SELECT a.doc_id, a.stretch, a.place AS first, b.place AS last FROM c a JOIN c b ON a.doc_id = b.doc_id AND a.stretch = b.stretch AND a.place <= b.place AND b.upto - a.ahead >= {MIN_BLOCK_WORDS}),
runs AS (
  SELECT doc_id, first, min(last) AS last FROM wide GROUP BY doc_id, first UNION SELECT doc_id, max(first), last FROM wide GROUP BY doc_id, last
  UNION SELECT doc_id, min(first), max(last) FROM wide GROUP BY doc_id, stretch),
texts AS (
  SELECT r.doc_id, r.first, r.last, string_agg(line, chr(10) ORDER BY place) AS t, min(holders) AS n_rare FROM runs r JOIN c ON c.doc_id = r.doc_id AND place BETWEEN r.first AND r.last
  GROUP BY r.doc_id, r.first, r.last),
spread AS (SELECT t, min(doc_id) AS least FROM texts GROUP BY t HAVING min(doc_id) < max(doc_id)),
holders AS (SELECT t, doc_id AS owner, min(first) AS there FROM texts JOIN spread USING (t) WHERE n_rare <= {RARE} OR doc_id = least GROUP BY t, doc_id),
lines AS (
  SELECT DISTINCT doc_id, owner, first + k AS place, there + k AS there
  FROM (SELECT x.doc_id, h.owner, x.first, h.there, unnest(range(0, x.last - x.first + 1)) AS k FROM texts x JOIN holders h ON h.t = x.t AND x.doc_id > h.owner)),
ordered AS (SELECT *, row_number() OVER (PARTITION BY doc_id, owner ORDER BY place, there DESC) AS k FROM lines),
piles AS (
  SELECT doc_id, owner, k, place, [there] AS tops, 1 AS pile FROM ordered WHERE k = 1
  UNION ALL
  SELECT o.doc_id, o.owner, o.k, o.place, list_concat(list_slice(tops, 1, n), [o.there], list_slice(tops, n + 2, len(tops))), n + 1
  FROM (SELECT p.*, o.there AS at, len(list_filter(p.tops, lambda x: x < o.there)) AS n FROM piles p JOIN ordered o ON o.doc_id = p.doc_id AND o.owner = p.owner AND o.k = p.k + 1) q
  JOIN ordered o ON o.doc_id = q.doc_id AND o.owner = q.owner AND o.k = q.k + 1),
heights AS (SELECT doc_id, owner, max(pile) AS pile FROM piles GROUP BY doc_id, owner),
chain AS (
  SELECT p.doc_id, p.owner, p.pile, max(p.k) AS k FROM piles p JOIN heights h ON h.doc_id = p.doc_id AND h.owner = p.owner AND h.pile = p.pile GROUP BY p.doc_id, p.owner, p.pile
  UNION ALL
  SELECT p.doc_id, p.owner, p.pile, max(p.k) FROM chain c JOIN piles p ON p.doc_id = c.doc_id AND p.owner = c.owner AND p.pile = c.pile - 1 AND p.k < c.k GROUP BY p.doc_id, p.owner, p.pile),
gone AS (
  SELECT DISTINCT x.doc_id, x.place, l.w FROM chain h JOIN ordered x ON x.doc_id = h.doc_id AND x.owner = h.owner AND x.k = h.k JOIN l ON l.doc_id = x.doc_id AND l.place = x.place),
kept AS (
  SELECT b.doc_id, string_agg(raw, chr(10) ORDER BY b.pos) AS text FROM bare b LEFT JOIN l ON l.doc_id = b.doc_id AND l.pos = b.pos
  LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.place = l.place WHERE g.place IS NULL GROUP BY b.doc_id),
counts AS (SELECT doc_id, count(*) AS n_lines FROM l GROUP BY doc_id),
matched AS (SELECT doc_id, count(DISTINCT place) AS n FROM lines GROUP BY doc_id),
removed AS (SELECT doc_id, count(*) AS n_removed, CAST(sum(w) AS BIGINT) AS removed_words FROM gone GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(m.n, 0) - coalesce(n_removed, 0) AS n_moved, coalesce(removed_words, 0) AS removed_words,
  length(coalesce(kept.text, '')) AS n_chars, sha256(coalesce(kept.text, '')) AS text_sha256
FROM documents d LEFT JOIN counts ON counts.doc_id = d.doc_id LEFT JOIN removed ON removed.doc_id = d.doc_id LEFT JOIN matched m ON m.doc_id = d.doc_id LEFT JOIN kept ON kept.doc_id = d.doc_id
"""
