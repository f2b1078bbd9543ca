"""Lexical retrieval packing: each window is filled with the seed document's BM25 neighbours.

1. A bounded sample of documents (``ANCHORS``, by hash of the text) gives anchors: their BM25 weights,
   with the sample's own document frequencies, projected to ``SKETCH`` numbers.
2. Every document is tokenised once; its sketch is compared with the anchors, and ids (16 bits each,
   the vocabulary is below 65,536) go to a written table with the nearest and the second nearest
   anchor, and with them, per task, in how many documents each id occurs.  These counts, summed over all
   documents, give BM25's inverse document frequencies; they are bounded by the vocabulary, so the driver
   may hold and broadcast them.
3. A shuffle brings lexical neighbours of all documents together: the table is range-partitioned by both
   anchors (in an order that puts similar anchors side by side) and then by row, so that a common key is
   spread over partitions, of which there is one for each ``PARTITION_BYTES`` of ids.
4. Its tasks cut that order into shards of ``SHARD_DOCS`` documents or ``SHARD_TOKENS`` ids.  Each shard has its own inverted
   index.  The first unused document seeds a window; the unused neighbours that the index returns,
   best first, fill it greedily.  A document that does not fit is cut, and its rest opens and seeds
   the next window, so windows are full.  What is left at the end of a shard is cut into powers
   of two, which need no padding.

A retrieval asks for the seed's terms by falling weight, ``QUERY_TERMS`` at a time: when no unused
neighbour is left among those that share the heaviest terms, the next ones are asked for, until
the seed has no terms left.  Then the next unused document of the shard follows, so every id lands in
exactly one piece.

Defined cases: a null text counts as empty, an empty text is the end id alone; repeated rows and
repeated or null ids are packed as documents of their own; ties in BM25 go by the order in the shard; a
document longer than a shard is cut like any other; empty tables give no rows.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.llm.common import scratch_table
from ladle.llm.texts import DistinctWords, WordCache, slices, small_batches

WINDOW = 2048
END_ID = 1
SHARD_DOCS, SHARD_TOKENS = 2048, 8 << 20
QUERY_TERMS = 48
#: anchors a shard's worth of documents, most anchors in all, numbers in a sketch
SHARD_ANCHORS, ANCHORS, SKETCH = 8, 4096, 128
#: numbers of a sketch that one id adds to
SPARSE = 4
#: ids a range partition holds, about
PARTITION_BYTES = 64 << 20
K1, B = 1.2, 0.75
TOKENIZER = "word_bpe_49k.json"
#: one count per possible 16-bit id, then rows, then tokens
COUNTS = (1 << 16) + 2


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path(TOKENIZER)


#: a word of Latin letters and then ASCII punctuation: the tokenizer cuts it there, and lower-cases it
_LATIN_WORD = r"^(?P<head>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<tail>[!-/:-@\[-`{-~]*)$"
#: cached parts of words (about 200 bytes each, with their ids)
CACHE_PARTS = 300_000


class Encoder:
    """Token ids of whole texts, with each distinct word or part of one encoded once per worker.

    The tokenizer never joins text across ASCII white space, nor letters with the ASCII
    punctuation after them, so a text's ids are the ids of these pieces in order.  A piece that the
    tokenizer's normaliser and pattern leave whole goes straight to its model.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        as_bytes = ByteLevel(add_prefix_space=False, use_regex=False)
        self.shown = {c: as_bytes.pre_tokenize_str(chr(c))[0][0] for c in range(0x21, 0x100)}
        self.parts, self.words = WordCache(self._part, limit=CACHE_PARTS), WordCache(self._word)

    def _part(self, part: str) -> bytes:
        """Ids of lower-case Latin letters or of ASCII punctuation."""
        shown = part if part.isascii() else part.translate(self.shown)
        return array("H", [t.id for t in self.model.tokenize(shown)]).tobytes() if part else b""

    def _word(self, word: str) -> bytes:
        return array("H", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def encode(self, texts: pa.StringArray) -> list[np.ndarray]:
        """Ids of each text (no nulls), each with the end id."""
        read = DistinctWords(texts)
        code, words = read.code, read.words
        parts = pc.extract_regex(words, pattern=_LATIN_WORD)
        latin = pc.is_valid(parts).to_numpy(zero_copy_only=False)
        head, tail = (pc.dictionary_encode(x) for x in (pc.utf8_lower(pc.struct_field(parts, "head")), pc.struct_field(parts, "tail")))
        whole = words.filter(pa.array(~latin)).to_pylist()
        pieces = [b"", *map(self.parts.__getitem__, head.dictionary.to_pylist())]
        tails = len(pieces)
        pieces += map(self.parts.__getitem__, tail.dictionary.to_pylist())
        rest = len(pieces)
        pieces += map(self.words.__getitem__, whole)
        # two pieces a word: head and tail, or the whole word and nothing
        pair = np.zeros((len(words), 2), np.int32)
        pair[latin, 0] = head.indices.filter(pa.array(latin)).to_numpy() + 1
        pair[latin, 1] = tail.indices.filter(pa.array(latin)).to_numpy() + tails
        pair[~latin, 0] = np.arange(len(whole)) + rest
        flat = np.frombuffer(b"".join(pieces), np.uint16)
        size = np.fromiter(map(len, pieces), np.int32, len(pieces)) // 2
        start = np.cumsum(size, dtype=np.int64) - size
        stream = pair[code].reshape(-1)
        n = size[stream]
        before = np.cumsum(n, dtype=np.int64) - n
        ids = flat[np.arange(n.sum()) + np.repeat(start[stream] - before, n)]
        # ends of the texts in the stream of ids
        ends = np.append(before, n.sum())[2 * read.ends]
        return [np.append(ids[x:y], np.uint16(END_ID)) for x, y in zip(ends[:-1], ends[1:])]


_encoders: dict[str, Encoder] = {}


def encoder_of(path: str) -> Encoder:
    """The worker's encoder: its tokenizer is read, and its parts are encoded, once for all its tasks."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _document(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("string")
    return docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), text.alias("text"))


def tokenize(d: DataFrame, tokenizer: str, grouping=None) -> DataFrame:
    """(doc_id, ids as bytes, first, second, row, null) for each document of (doc_id, text); per task one row with
    only ``counts``: documents by id, then rows and tokens.  ``grouping`` is a broadcast (idf, mean length, anchors); without
    it no anchors are looked for."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("first", pa.int32()), ("second", pa.int32()), ("row", pa.int64()),
                        ("counts", pa.binary())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer)
        counts, row = np.zeros(COUNTS, np.int64), TaskContext.get().partitionId() << 33
        for batch in batches:
            for at, n in slices(batch.column(1)):
                part = batch.slice(at, n)
                ids = encoder.encode(part.column(1))
                found = [distinct(x) for x in ids]
                for x, (terms, _) in zip(ids, found):
                    counts[terms] += 1
                    counts[-1] += len(x)
                counts[-2] += n
                nearest = [pa.nulls(n, pa.int32())] * 2 if grouping is None else [pa.array(a, pa.int32()) for a in near_anchors(ids, found, *grouping.value)]
                stored = pa.array([x.astype("<u2").tobytes() for x in ids], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), stored, *nearest, pa.array(np.arange(row, row + n)), pa.nulls(n, pa.binary())], schema=schema)
                row += n
        if counts[-2]:
            empty = [pa.nulls(1, f.type) for f in list(schema)[:-1]]
            yield pa.RecordBatch.from_arrays([*empty, pa.array([counts.tobytes()], pa.binary())], schema=schema)
    return d.mapInArrow(task, "doc_id bigint, ids binary, first int, second int, row bigint, counts binary")


def document_counts(tokens: DataFrame) -> np.ndarray:
    """Documents by id, then rows and tokens, over all tasks (bounded by the vocabulary)."""
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTS, np.int64)
        for batch in batches:
            for x in batch.column(0).to_pylist():
                total += np.frombuffer(x, np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["id", "n"])
    found = tokens.select("counts").where(F.col("counts").isNotNull()).mapInArrow(unpack, "id bigint, n bigint")
    out = np.zeros(COUNTS, np.int64)
    for r in found.groupBy("id").agg(F.sum("n").alias("n")).collect():
        out[r["id"]] = r["n"]
    return out


def distinct(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ids of a document, ascending, and how often each stands there."""
    if len(ids) > 4096:  # a count for each possible id is faster than a sort
        n = np.bincount(ids, minlength=1 << 16)
        terms = np.flatnonzero(n)
        return terms, n[terms]
    order = np.sort(ids)
    starts = np.flatnonzero(np.append(True, order[1:] != order[:-1]))
    return order[starts].astype(np.int64), np.diff(np.append(starts, len(order)))


def bm25(ids: np.ndarray, idf: np.ndarray, mean_length: float, found: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ids of a document and their BM25 weights."""
    terms, tf = found or distinct(ids)
    return terms, idf[terms] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(ids) / mean_length))


_directions: list[tuple[np.ndarray, np.ndarray]] = []


def directions() -> tuple[np.ndarray, np.ndarray]:
    """Of a sparse random projection: the SPARSE places in a sketch that each id adds to, and their signs."""
    if not _directions:  # once per worker
        rng = np.random.default_rng(31)
        _directions.append((rng.integers(0, SKETCH, (1 << 16, SPARSE), dtype=np.int32), rng.choice(np.array([-1.0, 1.0], np.float32), (1 << 16, SPARSE))))
    return _directions[0]


def sketches(docs: list[np.ndarray], idf: np.ndarray, mean_length: float, found: list | None = None) -> np.ndarray:
    """A random projection of each document's BM25 weights, of length 1 (0 without weights)."""
    places, signs = directions()
    weighted = [bm25(ids, idf, mean_length, found and found[k]) for k, ids in enumerate(docs)]
    terms, w = (np.concatenate(x) if x else np.zeros(0) for x in (list(y) for y in zip(*weighted))) if weighted else (np.zeros(0, np.int64), np.zeros(0))
    row = np.repeat(np.arange(len(docs)), [len(t) for t, _ in weighted])
    at = places[terms] + (row * SKETCH)[:, None]
    out = np.bincount(at.ravel(), (signs[terms] * w[:, None]).ravel(), len(docs) * SKETCH).reshape(-1, SKETCH).astype(np.float32)
    size = np.sqrt((out * out).sum(axis=1, keepdims=True))
    return out / np.where(size > 0, size, 1)


def side_by_side(x: np.ndarray) -> np.ndarray:
    """An order of the rows that keeps similar ones close: halves along the main direction, again and again."""
    if len(x) <= 2:
        return np.arange(len(x))
    centred = x - x.mean(axis=0)
    along = np.linalg.eigh(centred.T @ centred)[1][:, -1]
    order = np.argsort(centred @ along, kind="stable")
    left, right = np.split(order, [len(order) // 2])
    return np.concatenate([left[side_by_side(x[left])], right[side_by_side(x[right])]])


def near_anchors(ids: list[np.ndarray], found: list, idf: np.ndarray, mean_length: float, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest and the second nearest anchor of each document."""
    x = sketches(ids, idf, mean_length, found) @ anchors.T
    first = x.argmax(axis=1)
    x[np.arange(len(x)), first] = -np.inf
    return first, x.argmax(axis=1)


def inverse_frequencies(counts: np.ndarray) -> tuple[np.ndarray, float]:
    """One number for each id, and the mean length."""
    n, df = int(counts[-2]), counts[:1 << 16]
    return np.log1p((n - df + 0.5) / (df + 0.5)).astype(np.float32), max(1.0, float(counts[-1]) / max(1, n))


def sample_grouping(d: DataFrame, tokenizer: str, shard_docs: int) -> tuple[np.ndarray, float, np.ndarray]:
    """(idf, mean length, anchors) of a sample of about ANCHORS distinct texts at most.  Anchors are sketches of
    SHARD_ANCHORS of them a shard's worth of documents, similar ones side by side."""
    n = d.count()
    share = min(1.0, ANCHORS / max(1, n))
    wanted = min(ANCHORS, max(1, SHARD_ANCHORS * n // shard_docs))
    # each distinct text once, and in an order that does not depend on partitions
    drawn = d.where(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < 1e6 * share).groupBy("text").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "text")
    tokens = scratch_table(tokenize(drawn, tokenizer), "pack-sample")
    idf, mean_length = inverse_frequencies(document_counts(tokens))
    weights = d.sparkSession.sparkContext.broadcast((idf, mean_length))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = sketches([np.frombuffer(i, "<u2") for i in batch.column(1).to_pylist()], *weights.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in x], pa.binary())], names=["draw", "sketch"])
    draw = F.xxhash64("ids").alias("draw")
    drawn = tokens.where(F.col("ids").isNotNull()).select(draw, "ids").where(F.pmod("draw", F.lit(1_000_000)) < 1e6 * wanted / max(1.0, n * share))
    found = drawn.mapInArrow(task, "draw bigint, sketch binary")
    rows = [r["sketch"] for r in found.groupBy("draw").agg(F.first("sketch").alias("sketch")).orderBy("draw").collect()]  # at most about ANCHORS
    x = np.frombuffer(b"".join(rows), np.float32).reshape(-1, SKETCH)
    return idf, mean_length, x[side_by_side(x)] if len(x) else np.zeros((1, SKETCH), np.float32)


def neighbours_together(tokens: DataFrame, counts: np.ndarray) -> DataFrame:
    """(doc_id, ids) of all documents in partitions and an order that hold lexical neighbours together."""
    parts = max(int(tokens.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), 1 + 2 * int(counts[-1]) // PARTITION_BYTES)
    key = ["first", "second", "row"]
    held = tokens.where(F.col("ids").isNotNull()).select("doc_id", "ids", *key)
    return held.repartitionByRange(parts, *key).sortWithinPartitions(*key).select("doc_id", "ids")


class Heaviest(dict):
    """document -> its terms by falling weight, worked out for the documents that come to be seeds."""

    def __init__(self, terms: list[np.ndarray], weights: list[np.ndarray]):
        super().__init__()
        self.terms, self.weights = terms, weights

    def __missing__(self, d: int) -> np.ndarray:
        self[d] = self.terms[d][np.argsort(-self.weights[d], kind="stable")]
        return self[d]


class Index:
    """BM25 inverted index of one shard: postings by id, with the shard-independent weights of all documents."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean_length: float):
        self.terms, weights, owner = [], [], []
        for d, ids in enumerate(docs):
            terms, w = bm25(ids, idf, mean_length)
            self.terms.append(terms)
            weights.append(w.astype(np.float32))
            owner.append(np.full(len(terms), d, np.int32))
        self.query = Heaviest(self.terms, weights)
        terms = np.concatenate(self.terms)
        order = np.argsort(terms, kind="stable")
        self.owner, self.weight = np.concatenate(owner)[order], np.concatenate(weights)[order]
        self.start = np.searchsorted(terms[order], np.arange((1 << 16) + 1))
        self.n = len(docs)

    def neighbours(self, seed: int, at: int = 0) -> np.ndarray:
        """Documents that share one of QUERY_TERMS terms of the seed, from its ``at``-th by weight on, best first."""
        spans = [slice(self.start[t], self.start[t + 1]) for t in self.query[seed][at:at + QUERY_TERMS]]
        owners = np.concatenate([self.owner[s] for s in spans]) if spans else np.zeros(0, np.int32)
        scores = np.bincount(owners, np.concatenate([self.weight[s] for s in spans]), self.n) if len(owners) else np.zeros(self.n)
        found = np.flatnonzero(scores > 0)
        return found[np.argsort(-scores[found], kind="stable")]

    def unused_neighbours(self, seed: int, used: np.ndarray) -> Iterator[int]:
        """Every unused document that shares a term with the seed: by its heaviest terms first, then by the next ones.
        Documents that get used meanwhile may still come."""
        for at in range(0, len(self.query[seed]), QUERY_TERMS):
            if used.all():
                return
            found = self.neighbours(seed, at)
            yield from found[~used[found]].tolist()


def pack_shard(docs: list[np.ndarray], idf: np.ndarray, mean_length: float, window: int = WINDOW) -> list[list[tuple[int, int, int]]]:
    """Windows as lists of (document, start, length); all are full but the last, which is cut into powers of two."""
    index = Index(docs, idf, mean_length)
    used = np.zeros(len(docs), bool)
    windows: list[list[tuple[int, int, int]]] = []
    current: list[tuple[int, int, int]] = []
    unused = iter(range(len(docs)))

    def lay(d: int) -> bool:
        """Lay document d into the open window and, if it does not fit, into those after it; true if a window got full."""
        nonlocal current
        used[d] = True
        room, start, size = window - sum(n for _, _, n in current), 0, len(docs[d])
        before = len(windows)
        while start < size:
            n = min(room, size - start)
            current.append((d, start, n))
            start, room = start + n, room - n
            if room == 0:
                windows.append(current)
                current, room = [], window
        return len(windows) > before

    for first in unused:
        if used[first]:
            continue
        lay(first)
        # as long as a window is open, its first document is the seed that asks for neighbours
        while current:
            if any(lay(d) for d in index.unused_neighbours(current[0][0], used) if not used[d]):
                continue
            rest = next((d for d in unused if not used[d]), None)
            while rest is not None and not lay(rest):
                rest = next((d for d in unused if not used[d]), None)
            if rest is None:
                return windows + _powers_of_two(current)
    return windows


def _powers_of_two(pieces: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    out, left = [], sum(n for _, _, n in pieces)
    pieces = list(pieces)
    while left:
        size = 1 << (left.bit_length() - 1)
        left -= size
        now = []
        while size:
            d, start, n = pieces.pop(0)
            take = min(n, size)
            now.append((d, start, take))
            size -= take
            if take < n:
                pieces.insert(0, (d, start + take, n - take))
        out.append(now)
    return out


def pack_documents(docs: DataFrame, window: int = WINDOW, shard_docs: int = SHARD_DOCS, tokenizer: str | None = None,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset."""
    spark = docs.sparkSession
    small_batches(spark)
    tokenizer = tokenizer or default_tokenizer()
    d = _document(docs, id_col, text_col)
    grouping = spark.sparkContext.broadcast(sample_grouping(d, tokenizer, shard_docs))  # at most about ANCHORS sketches
    tokens = scratch_table(tokenize(d, tokenizer, grouping), "pack-tokens")
    counts = document_counts(tokens)
    weights, mean_length = inverse_frequencies(counts)
    idf = spark.sparkContext.broadcast(weights)  # one number per id
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 33
        held_ids: list[np.ndarray] = []
        held_docs: list[int | None] = []
        tokens_held = 0

        def flush() -> pa.RecordBatch:
            nonlocal sequence
            rows = []
            for pieces in pack_shard(held_ids, idf.value, mean_length, window):
                offset = 0
                for d, start, length in pieces:
                    crc = zlib.crc32(held_ids[d][start:start + length].astype("<u4").tobytes())
                    rows.append((held_docs[d], start, length, crc, len(held_ids[d]), sequence, offset))
                    offset += length
                sequence += 1
            held_ids.clear()
            held_docs.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)
        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held_ids.append(np.frombuffer(ids, "<u2"))
                held_docs.append(doc_id)
                tokens_held += len(held_ids[-1])
                if len(held_ids) >= shard_docs or tokens_held >= SHARD_TOKENS:
                    yield flush()
                    tokens_held = 0
        if held_ids:
            yield flush()
    return neighbours_together(tokens, counts).mapInArrow(task, ", ".join(f"`{c}` bigint" for c in names))
