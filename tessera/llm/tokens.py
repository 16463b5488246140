"""Token ids as seekable binary shards.

A shard is a run of independent zstandard frames of little-endian 32-bit ids, then a
skippable frame with the document index, then the trailing seek table of the public
"zstd seekable format": per frame its compressed size, its size and the low 32 bits of
the XXH64 of its content.  A reader finds the frames of a document from the two tables
and decompresses only those.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os
import re
import string
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialize, scratch, small_batches, worker_state
from tessera.llm.shards import Committed, new_folder, one_task_each, range_sorted, store_of
from tessera.llm.shingles import BLANK, LOWER, bytes_of, cut_words

END_ID = 1
FRAME_IDS, MOST_FRAME_IDS = 1 << 15, 1 << 20
#: Shards whose places are summed up in one group.
BLOCK_SHARDS = 4096
#: Words remembered before a worker starts anew.
CACHED_WORDS = 600_000
JOINED_WORDS = 256
#: Bytes of text cut into words at a time.
SLICE_BYTES = 8 << 20
#: How the tokens that a tokenizer finds before it normalizes start.
ADDED_START = "<|"
#: A-Z in lower case, all blanks as the space.
FOLD = np.where(BLANK, np.uint8(0x20), LOWER)
LETTER, PUNCTUATION = np.zeros(256, bool), np.zeros(256, bool)
LETTER[97:123] = True
PUNCTUATION[[ord(c) for c in string.punctuation]] = True
#: Words that the normalizer changes by lower case alone, and that are one pre-token.
LATIN = re.compile("[a-zß-öø-ÿÀ-ÖØ-Þ]+")
#: Marks at a word's end that are taken off at most; a longer run stays with its word.
MOST_MARKS = 16
# Fixed values of the public seekable format.
SKIPPABLE_INDEX, SKIPPABLE_SEEK, SEEK_MAGIC, CHECKSUM_FLAG = 0x184D2A5D, 0x184D2A5E, 0x8F92EAB1, 0x80

MANIFEST = "part int, path string, n_docs long, n_ids long, n_frames long, n_bytes long"


def reads_word_by_word(definition: dict) -> bool:
    """Whether the ids of a text are those of its words in order, whatever the words' ASCII case.

    So it is where the pre-tokenizer keeps only what its pattern matches and no match holds
    white space (a model with an end-of-word suffix), where the normalizer lower-cases, and
    where added tokens can be told by their start.
    """
    steps = (definition.get("pre_tokenizer") or {}).get("pretokenizers", [])
    folds = [x["type"] for x in (definition.get("normalizer") or {}).get("normalizers", [])]
    splits = bool(steps) and steps[0]["type"] == "Split" and steps[0]["behavior"] == "Removed" and steps[0]["invert"]
    added = definition.get("added_tokens") or []
    return splits and "Lowercase" in folds and bool(definition["model"].get("end_of_word_suffix")) and bool(added) and all(t["content"].startswith(ADDED_START) for t in added)


class WordEncoder:
    """Encodes columns of whole texts with a tokenizer; each distinct word once while it is remembered.

    Word by word only for tokenizers that reads_word_by_word() knows, others get whole texts.
    Words are cut on the column's bytes with A-Z in lower case, and marks behind a letter at a
    word's end are a word of their own (the tokenizer never joins the two), which leaves fewer
    distinct words; Arrow's dictionary encoding finds them.  A word that can spell an added
    token stays as it is.

    New words are encoded many at a time: those of letters alone are one pre-token each, and
    the token that ends it carries the end-of-word suffix; others stand between added tokens.
    Words of Latin letters go to the model without the steps that would change nothing in them.
    """

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, models, pre_tokenizers

        self.tokenizer, spec = Tokenizer.from_str(definition), json.loads(definition)
        self.word_wise = reads_word_by_word(spec)
        if self.word_wise:
            model, vocabulary = spec["model"], self.tokenizer.get_vocab(with_added_tokens=True)
            merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
            # Every word comes here once, so the model need not remember any.
            self.bare = Tokenizer(models.BPE(vocab=model["vocab"], merges=merges, end_of_word_suffix=model["end_of_word_suffix"], cache_capacity=0))
            self.bare.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
            self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends_word[[i for t, i in vocabulary.items() if t.endswith(model["end_of_word_suffix"])]] = True
            self.mark_id, self.mark = min((i, t.content) for i, t in self.tokenizer.get_added_tokens_decoder().items())
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.starts, self.lengths = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.pool, self.used = np.zeros(1 << 18, np.uint32), 0

    def remember(self, words: list[str], ids: np.ndarray, ends: np.ndarray) -> None:
        """Keep the ids of words: those of word k end before ends[k]."""
        n, more = len(self.known), len(words)
        while n + more > len(self.starts):
            self.starts, self.lengths = np.append(self.starts, np.zeros_like(self.starts)), np.append(self.lengths, np.zeros_like(self.lengths))
        while self.used + len(ids) > len(self.pool):
            self.pool = np.append(self.pool, np.zeros_like(self.pool))
        self.pool[self.used : self.used + len(ids)] = ids
        self.starts[n] = self.used
        self.starts[n + 1 : n + more] = self.used + ends[:-1]
        self.lengths[n : n + more] = np.diff(ends, prepend=0)
        self.known.update(zip(words, range(n, n + more), strict=True))
        self.used += len(ids)

    def learn(self, words: list[str]) -> None:
        """Encode words that are not known yet, each given once."""

        def ids_of(tokenizer, texts: list[str]) -> list[np.ndarray]:
            return [np.array(x.ids, np.uint32) for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

        def chunks(some: list[str]) -> list[list[str]]:
            return [some[k : k + JOINED_WORDS] for k in range(0, len(some), JOINED_WORDS)]

        latin, rest = [], []
        for w in words:
            (latin if LATIN.fullmatch(w) else rest).append(w)
        plain = chunks([w for w in rest if w.isalpha()])
        odd = [w for w in rest if not w.isalpha() and ADDED_START not in w]
        alone = [w for w in rest if ADDED_START in w]
        latin = chunks(latin)
        found = zip(latin + plain, ids_of(self.bare, [" ".join(c).lower() for c in latin]) + ids_of(self.tokenizer, [" ".join(c) for c in plain]), strict=True)
        for chunk, ids in found:
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) == len(chunk):
                self.remember(chunk, ids, ends)
            else:  # a letter that lower case or normalisation makes more than letters
                odd += chunk
        between = chunks(odd)
        for chunk, ids in zip(between, ids_of(self.tokenizer, [f" {self.mark} ".join([*c, ""]) for c in between]), strict=True):
            marks = np.flatnonzero(ids == self.mark_id)
            self.remember(chunk, np.delete(ids, marks), marks - np.arange(len(marks)))
        for word, ids in zip(alone, ids_of(self.tokenizer, alone), strict=True):
            self.remember([word], ids, np.array([len(ids)]))

    def places_of(self, words: list[str]) -> np.ndarray:
        found = np.array([self.known.get(w, -1) for w in words], np.int64)
        new = np.flatnonzero(found < 0).tolist()
        if new:
            self.learn(list(dict.fromkeys(words[k] for k in new)))
            found[new] = [self.known[words[k]] for k in new]
        return found

    def _words(self, content: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, ids per text) of a stretch of a column's bytes."""
        folded = FOLD[content]
        starts, ends, number = cut_words(content, offsets)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        # Words that end in marks are cut behind their last letter.
        marked = np.flatnonzero(PUNCTUATION[folded[ends - 1]])
        cut = ends[marked]
        for _ in range(MOST_MARKS):
            cut -= PUNCTUATION[folded[cut - 1]] & (cut > starts[marked] + 1)
        before = folded[cut - 1]
        wide = np.where((cut - starts[marked] > 1), folded[np.maximum(cut - 2, 0)], 0) == 0xC3
        letter = LETTER[before] | (wide & (before >= 0x80) & (before < 0xC0) & (before != 0x97) & (before != 0xB7))
        good = letter & (cut < ends[marked])
        for at in np.flatnonzero((content[:-1] == ord("<")) & (content[1:] == ord("|"))).tolist():
            k = int(np.searchsorted(starts, at, "right")) - 1
            folded[starts[k] : ends[k]] = content[starts[k] : ends[k]]
            good[marked == k] = False
        parts = np.ones(len(starts), np.int64)
        parts[marked[good]] = 2
        begins = np.repeat(starts, parts)
        begins[np.cumsum(parts)[marked[good]] - 1] = cut[good]
        # A piece reaches up to the next one: the blanks behind it, all alike by now, are cut off the few distinct pieces.
        reach = pa.py_buffer(np.append(begins, len(folded)))
        pieces = pa.LargeStringArray.from_buffers(len(begins), reach, pa.py_buffer(folded)).dictionary_encode()
        places = self.places_of(pc.ascii_rtrim(pieces.dictionary, " ").to_pylist())[pieces.indices.to_numpy()]
        lengths = self.lengths[places]
        ahead = np.cumsum(lengths) - lengths
        ids = self.pool[np.repeat(self.starts[places] - ahead, lengths) + np.arange(int(lengths.sum()))]
        return ids, np.bincount(np.repeat(number, parts), lengths, len(offsets) - 1).astype(np.int64)

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, bounds: text k has ids bounds[k]:bounds[k + 1]); null counts as empty."""
        if not self.word_wise:
            found = [np.array(x.ids, np.uint32) for x in self.tokenizer.encode_batch_fast([t or "" for t in texts.to_pylist()], add_special_tokens=False)]
            return np.concatenate([np.zeros(0, np.uint32), *found]), np.concatenate([[0], np.cumsum([len(x) for x in found], dtype=np.int64)])
        content, offsets = bytes_of(texts)
        parts, counts, at = [np.zeros(0, np.uint32)], np.zeros(len(texts), np.int64), 0
        while at < len(content):  # stretches that end in a blank, whatever the length of a text
            end = min(at + SLICE_BYTES, len(content))
            while end < len(content) and not (some := BLANK[content[end - 1 : end + 4095]]).any():
                end = min(end + 4096, len(content))
            end = end + int(some.argmax()) if end < len(content) else end
            if len(self.known) > CACHED_WORDS:
                self.forget()
            ids, n = self._words(content[at:end], np.clip(offsets - at, 0, end - at))
            parts.append(ids)
            counts += n
            at = end
        return np.concatenate(parts), np.concatenate([[0], np.cumsum(counts)])

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        return self.encode_column(pa.array([text], pa.large_string()))[0].astype("<u4").tobytes()


class ShardWriter:
    """Writes the ids of documents, in the order given, as one shard."""

    def __init__(self, file: Committed):
        self.file, self.compressor = file, zstandard.ZstdCompressor(level=3, write_checksum=True)
        self.waiting: list[bytes] = []
        self.waiting_bytes = 0
        self.frames: list[tuple[int, int, int]] = []
        self.doc_ids, self.valid, self.ends = array("q"), bytearray(), array("Q")
        self.n_ids = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.doc_ids.append(doc_id or 0)
        self.valid.append(doc_id is not None)
        self.n_ids += len(ids) // 4
        self.ends.append(self.n_ids)
        self.waiting.append(ids)
        self.waiting_bytes += len(ids)
        if self.waiting_bytes >= 4 * FRAME_IDS:
            self.flush()

    def flush(self) -> None:
        content = b"".join(self.waiting)
        for at in range(0, len(content), 4 * MOST_FRAME_IDS):
            piece = content[at : at + 4 * MOST_FRAME_IDS]
            frame = self.compressor.compress(piece)
            self.file.write(frame)
            self.frames.append((len(frame), len(piece), xxhash.xxh64_intdigest(piece) & 0xFFFFFFFF))
        self.waiting, self.waiting_bytes = [], 0

    def close(self) -> None:
        self.flush()
        index = self.compressor.compress(self.doc_ids.tobytes() + self.ends.tobytes() + bytes(self.valid))
        body = struct.pack("<Q", len(self.doc_ids)) + index
        self.file.write(struct.pack("<II", SKIPPABLE_INDEX, len(body)) + body)
        table = b"".join(struct.pack("<III", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), CHECKSUM_FLAG, SEEK_MAGIC)
        self.file.write(struct.pack("<II", SKIPPABLE_SEEK, len(table)) + table)
        self.file.commit()


class ShardReader:
    """Reads a shard's tables, then only the frames that are asked for."""

    def __init__(self, path: str):
        store, inner = store_of(path)
        self.file = store.open_input_file(inner)
        size = self.file.size()
        n, flag, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEK_MAGIC or flag != CHECKSUM_FLAG:
            raise ValueError(f"{path} has no seek table")
        table = np.frombuffer(self._at(size - 9 - 12 * n, 12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self.sizes, self.checks = table[:, 0], table[:, 2]
        self.starts = np.concatenate([[0], np.cumsum(table[:, 0])])
        self.id_starts = np.concatenate([[0], np.cumsum(table[:, 1] // 4)])
        magic, length = struct.unpack("<II", self._at(int(self.starts[-1]), 8))
        if magic != SKIPPABLE_INDEX:
            raise ValueError(f"{path} has no document index")
        body = self._at(int(self.starts[-1]) + 8, length)
        count = struct.unpack("<Q", body[:8])[0]
        plain = zstandard.ZstdDecompressor().decompress(body[8:])
        self.doc_ids = np.frombuffer(plain, "<i8", count)
        self.ends = np.frombuffer(plain, "<u8", count, 8 * count).astype(np.int64)
        self.valid = np.frombuffer(plain, np.uint8, count, 16 * count).astype(bool)
        self.decompressor = zstandard.ZstdDecompressor()

    def _at(self, offset: int, length: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(length)

    def frame(self, k: int) -> bytes:
        content = self.decompressor.decompress(self._at(int(self.starts[k]), int(self.sizes[k])))
        if xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != self.checks[k]:
            raise ValueError(f"frame {k} is damaged")
        return content

    def ids(self, k: int) -> np.ndarray:
        """Ids of the k-th document; only its frames are read."""
        start, end = int(self.ends[k - 1]) if k else 0, int(self.ends[k])
        first, last = np.searchsorted(self.id_starts, start, "right") - 1, np.searchsorted(self.id_starts, end, "left")
        content = b"".join(self.frame(f) for f in range(first, last))
        at = start - int(self.id_starts[first])
        return np.frombuffer(content, "<u4")[at : at + end - start]

    def documents(self) -> Iterator[tuple[int | None, int, bytes]]:
        """(doc_id, first id's place, ids) of every document, one frame in memory at a time and what a document needs."""
        pending, base, frame = b"", 0, 0
        for k, end in enumerate(self.ends.tolist()):
            start = int(self.ends[k - 1]) if k else 0
            parts, have = [pending], base + len(pending) // 4
            while have < end:
                parts.append(self.frame(frame))
                have += len(parts[-1]) // 4
                frame += 1
            content = b"".join(parts) if len(parts) > 1 else pending
            yield int(self.doc_ids[k]) if self.valid[k] else None, start, content[4 * (start - base) : 4 * (end - base)]
            pending, base = content[4 * (end - base) :], end


def write_tokens(docs: DataFrame, definition: str, folder: str, end_id: int = END_ID) -> DataFrame:
    """Encode the text of every row and write shards in ascending doc_id order; the manifest, as a written table.

    Null texts count as empty and give only the end id; null ids come first; repeated
    rows are written each; an empty table gives no shard.  The folder must be new.  A file
    that the manifest doesn't name is none of the output.
    """
    spark = docs.sparkSession
    small_batches(spark, 4000)
    new_folder(folder)
    shared = spark.sparkContext.broadcast(definition)
    name = f"encoder_{hashlib.sha256(definition.encode()).hexdigest()}"
    end = struct.pack("<I", end_id)

    def write(batches):
        part, writer = TaskContext.get().partitionId(), None
        encoder = worker_state(name, lambda: WordEncoder(shared.value))
        try:
            for batch in batches:
                ids, bounds = encoder.encode_column(batch.column(1))
                ids, bounds = ids.astype("<u4", copy=False), bounds.tolist()
                for k, doc_id in enumerate(batch.column(0).to_pylist()):
                    writer = writer or ShardWriter(Committed(folder, f"tokens-{part:07d}.zst"))
                    writer.add(doc_id, ids[bounds[k] : bounds[k + 1]].tobytes() + end)
            if writer:
                writer.close()
        except BaseException:
            if writer:
                writer.file.abort()
            raise
        if writer:
            row = [part, f"{folder}/tokens-{part:07d}.zst", len(writer.doc_ids), writer.n_ids, len(writer.frames), writer.file.size]
            kinds = [pa.int32(), pa.string(), *[pa.int64()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], ["part", "path", "n_docs", "n_ids", "n_frames", "n_bytes"])

    rows = docs.select("doc_id", "text")
    return materialize(range_sorted(rows, "doc_id", "text").mapInArrow(write, MANIFEST), "manifest")


def read_tokens(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read from the shards; frames are checked on the way."""
    # Prefix sums in two steps: over groups of shards, then inside each group.
    blocked = manifest.withColumn("block", F.floor(F.col("part") / BLOCK_SHARDS))
    earlier = lambda window: F.coalesce(F.sum("n_ids").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = blocked.groupBy("block").agg(F.sum("n_ids").alias("n_ids")).select("block", earlier(Window.orderBy("block")).alias("ahead"))
    placed = blocked.join(blocks, "block").select("path", (F.col("ahead") + earlier(Window.partitionBy("block").orderBy("part"))).alias("base"))

    def read(batches):
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                documents = ShardReader(path).documents()
                while rows := list(itertools.islice(((d, base + s, len(b) // 4, zlib.crc32(b)) for d, s, b in documents), 4096)):
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return one_task_each(placed).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def tokenize(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Write the ids of every document as shards in the shared folder and read them back."""
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = f.read()
    return read_tokens(write_tokens(docs, definition, scratch(docs.sparkSession, "tokens")))
