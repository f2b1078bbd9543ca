"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

A word's embedding is the sum of hashed vectors of the word and of its beginnings (PREFIXES
letters).  Filters of widths 1, 2 and 3 run over the whole text, their maxima over all
positions go through a logistic unit.  Training uses every labelled row that is not held out, whole
texts; scoring reads every whole text in fixed-size chunks.

The labelled rows are dealt by a hash of their id into shards of about ``SHARD_ROWS`` rows, encoded and
written once.  One shard is trained in the driver; of several, each is a task's in every round, which
starts from the common model, and the round ends with the mean of their models (an embedding's over the
shards that have its words, by rows).  So memory is bounded by a shard, and results do not depend on partitioning.

Thresholds are calibrated by language: on rows kept out of the gradient steps, each language
(told from the text by function words, never from a column) gets the threshold with the best
F1.  If ``per_class`` bounds the rows, one counts there as many times as they are thinner than its class, so
that the class mix is that of all usable rows.  The raw output is then mapped so that this threshold lands on ``CUT`` for every language.

Defined cases: null and empty texts have no words and get the score of an empty text, which is
below the cut; repeated rows get equal scores; without labelled rows of both classes every
score is 0; null ids are kept; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh32_intdigest

from ladle.llm.common import fold, scratch_table
from ladle.llm.texts import WordCache, hash32, labelled_sample, map_texts, sigmoid, small_batches, word_ids

#: labelled rows that a task trains on, and about as many bytes of text: bounds memory, all shards are used
SHARD_ROWS, SHARD_BYTES = 8192, 32 << 20
CUT = 0.3
FOLD = (4, 2)
ROWS, DIM = 1 << 18, 12
PREFIXES = (3, 4, 5, 6, 7)
WIDTHS, FILTERS = (1, 2, 3), 8
CHUNK = 1 << 15
#: parts of the embeddings that are averaged apart
BLOCKS = 16
#: words that a scoring task keeps (about 300 bytes each): bounds memory, not results
CACHE_SCORED = 250_000
#: texts seen in training of a small table: 4 to 12 rounds over all labelled rows
VISITS, ROUNDS, BATCH, RATE = 36_000, (4, 12), 32, 0.05
# Function words that tell the languages apart for the thresholds.
FUNCTION_WORDS = {
    "en": "the of and to that is was for with this",
    "fr": "le la les des et est que dans pour une",
    "de": "der die und das nicht von mit ein sich den",
    "es": "el los las que del por una con para se",
}
LANGUAGES = [*FUNCTION_WORDS, "other"]
_EDGE = re.compile(r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


_MARKS: dict[str, int] = {}
for _k, _lang in enumerate(FUNCTION_WORDS):
    for _w in FUNCTION_WORDS[_lang].split():
        _MARKS[_w] = _MARKS.get(_w, 0) | (1 << _k)


def words_of(text: bytes | None) -> list[str]:
    return (text or b"").decode("utf-8", "replace").lower().split()


def features(word: str) -> tuple[list[int], int]:
    """Embedding rows of a word (punctuation aside) and its function-word marks."""
    core = _EDGE.sub("", word)
    if core.isascii():  # as many bytes as letters
        whole = core.encode()
        rows = [xxh32_intdigest(whole) % ROWS] + [xxh32_intdigest(whole[:n], n) % ROWS for n in PREFIXES]
    else:
        rows = [xxh32_intdigest(core.encode()) % ROWS] + [xxh32_intdigest(core[:n].encode(), n) % ROWS for n in PREFIXES]
    return rows, _MARKS.get(core, 0)


def language_of(marks: np.ndarray) -> int:
    """Index of the language whose function words are most frequent; the last one if they are rare."""
    seen = marks[marks > 0]
    votes = [int(((seen >> k) & 1).sum()) for k in range(len(FUNCTION_WORDS))]
    return int(np.argmax(votes)) if len(seen) and max(votes) * 50 >= len(marks) else len(FUNCTION_WORDS)


class Vocabulary:
    """Word -> position in growing arrays of feature rows and marks."""

    def __init__(self):
        self.rows, self.marks = np.zeros((1024, 1 + len(PREFIXES)), np.int32), np.zeros(1024, np.int8)
        self.size = 0
        self.index = WordCache(self._add)

    def _add(self, word: str) -> int:
        if self.size == len(self.rows):
            self.rows, self.marks = np.concatenate([self.rows, np.zeros_like(self.rows)]), np.concatenate([self.marks, np.zeros_like(self.marks)])
        self.rows[self.size], self.marks[self.size] = features(word)
        self.size += 1
        return self.size - 1

    def encode(self, text: bytes | None) -> np.ndarray:
        return word_ids(self.index, words_of(text), np.int32)


def rounds_of(train: int) -> int:
    return int(np.clip(VISITS // max(1, train), *ROUNDS))


class Shard(NamedTuple):
    """Encoded labelled texts, in an order of their ids' hashes, and their vocabulary."""

    rows: np.ndarray          # embedding rows of each word
    marks: np.ndarray
    texts: list[np.ndarray]   # places of a text's words in ``rows``
    y: np.ndarray

    def dealt(self, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
        """Places kept out of the gradient steps, and the others."""
        calibration = rng.random(len(self.texts)) < 0.2
        return np.flatnonzero(calibration), np.flatnonzero(~calibration)


class TextCNN:
    """Embeddings, filters and the logistic unit; all state is numpy arrays."""

    def __init__(self, seed: int = 13):
        rng = np.random.default_rng(seed)
        self.table = (rng.standard_normal((ROWS, DIM)) * 0.02).astype(np.float32)
        self.filters = {w: (rng.standard_normal((w, DIM, FILTERS)) * 0.5).astype(np.float32) for w in WIDTHS}
        self.offsets = {w: np.zeros(FILTERS, np.float32) for w in WIDTHS}
        self.out = (rng.standard_normal(len(WIDTHS) * FILTERS) * 0.5).astype(np.float32)
        self.bias = np.float32(0.0)
        self.knots = {k: (0.5, 0.5) for k in range(len(LANGUAGES))}

    def embed(self, rows: np.ndarray) -> np.ndarray:
        """Embeddings of words given as feature rows."""
        x = self.table.take(rows[:, 0], axis=0)
        for k in range(1, rows.shape[1]):
            x += self.table.take(rows[:, k], axis=0)
        return x

    def maxima(self, words: np.ndarray, embedded) -> tuple[np.ndarray, np.ndarray]:
        """Filter maxima over all positions, and where they stand (-1: the text is too short).

        ``embedded`` gives the embeddings of a slice of the text's words.
        """
        best = np.full(len(WIDTHS) * FILTERS, -np.inf, np.float32)
        where = np.full(len(WIDTHS) * FILTERS, -1, np.int64)
        for start in range(0, len(words), CHUNK):
            x = embedded(words[start:start + CHUNK + max(WIDTHS) - 1])
            for i, w in enumerate(WIDTHS):
                n = min(len(x) - w + 1, CHUNK)
                if n <= 0:
                    continue
                y = x[:n] @ self.filters[w][0]
                for j in range(1, w):
                    y += x[j:j + n] @ self.filters[w][j]
                at = np.ascontiguousarray(y.T).argmax(axis=1)
                top = y[at, np.arange(FILTERS)] + self.offsets[w]
                part = slice(i * FILTERS, (i + 1) * FILTERS)
                better = top > best[part]
                best[part][better] = top[better]
                where[part][better] = at[better] + start
        best[where < 0] = 0.0
        return np.maximum(best, 0.0), where

    def activations(self, words: np.ndarray, embedded) -> np.ndarray:
        """The maxima alone, as ``maxima`` gives them."""
        best = np.full(len(WIDTHS) * FILTERS, -np.inf, np.float32)
        for start in range(0, len(words), CHUNK):
            x = embedded(words[start:start + CHUNK + max(WIDTHS) - 1])
            for i, w in enumerate(WIDTHS):
                n = min(len(x) - w + 1, CHUNK)
                if n <= 0:
                    continue
                y = x[:n] @ self.filters[w][0]
                for j in range(1, w):
                    y += x[j:j + n] @ self.filters[w][j]
                part = slice(i * FILTERS, (i + 1) * FILTERS)
                best[part] = np.maximum(best[part], np.ascontiguousarray(y.T).max(axis=1) + self.offsets[w])
        best[np.isneginf(best)] = 0.0
        return np.maximum(best, 0.0)

    def raw(self, words: np.ndarray, embedded) -> float:
        return float(sigmoid(self.activations(words, embedded) @ self.out + self.bias))

    def score(self, words: np.ndarray, embedded, language: int) -> float:
        """Raw output bent so that the language's threshold becomes CUT; no words: 0."""
        if not len(words):
            return 0.0
        p, (t, _) = self.raw(words, embedded), self.knots[language]
        return float(CUT * p / t if p < t else CUT + (1.0 - CUT) * (p - t) / (1.0 - t))

    def dense(self) -> dict[str, np.ndarray]:
        """All parameters but the embeddings."""
        return {"out": self.out, "bias": np.array([self.bias]), **{f"f{w}": self.filters[w] for w in WIDTHS}, **{f"o{w}": self.offsets[w] for w in WIDTHS}}

    def set_dense(self, found: dict[str, np.ndarray]) -> None:
        self.out, self.bias = found["out"], found["bias"][0]
        self.filters, self.offsets = {w: found[f"f{w}"] for w in WIDTHS}, {w: found[f"o{w}"] for w in WIDTHS}

    def fit(self, shard: Shard, seed: int = 13, weight: np.ndarray | None = None) -> TextCNN:
        """Training on one shard.  ``weight`` (usable rows for each sampled one) counts in the thresholds only."""
        rng = np.random.default_rng(seed)
        calibration, train = shard.dealt(rng)
        squares = Squares(self)
        for _ in range(rounds_of(len(train))):
            rng.shuffle(train)
            squares.round(shard, train)
        self._calibrate(*self.judged(shard, calibration), None if weight is None else weight[calibration])
        return self

    def judged(self, shard: Shard, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Raw output, language and label of the texts at these places of a shard."""
        def embedded(ids: np.ndarray) -> np.ndarray:
            return self.embed(shard.rows[ids])
        p = np.array([self.raw(shard.texts[i], embedded) if len(shard.texts[i]) else 0.0 for i in at])
        return p, np.array([language_of(shard.marks[shard.texts[i]]) for i in at], np.int64), shard.y[at]

    def _calibrate(self, p: np.ndarray, language: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> None:
        """Best-F1 threshold of each language; few rows of a class fall back to the one of all rows."""
        if not len(p):
            return
        weight = np.ones(len(p)) if weight is None else weight

        def threshold(at: np.ndarray) -> float:
            order = np.argsort(-p[at], kind="stable")
            q, w = p[at][order], weight[at][order]
            hit = w * y[at][order]
            f1 = 2 * np.cumsum(hit) / (np.cumsum(w) + hit.sum())
            k = int(np.argmax(f1))
            below = q[k + 1] if k + 1 < len(q) else 0.0
            return float(np.clip((q[k] + below) / 2, 0.02, 0.98))
        every = threshold(np.arange(len(p))) if 0 < y.sum() < len(y) else 0.5
        for k in self.knots:
            at = np.flatnonzero(language == k)
            enough = len(at) and min(y[at].sum(), len(at) - y[at].sum()) >= 10
            self.knots[k] = (threshold(at) if enough else every, every)


class Squares:
    """AdaGrad steps of a model; the gradient of a maximum only touches the words it came from."""

    def __init__(self, model: TextCNN):
        self.model = model
        self.table = np.full(ROWS, 1e-3, np.float32)
        self.dense = {name: np.full_like(x, 1e-3) for name, x in model.dense().items()}

    def _move(self, name: str, value: np.ndarray, grad: np.ndarray) -> None:
        self.dense[name] += grad * grad
        value -= RATE * grad / np.sqrt(self.dense[name])

    def round(self, shard: Shard, order: np.ndarray) -> np.ndarray:
        """Steps over the shard's texts in this order.  Returns the embedding rows that were moved."""
        m, rows = self.model, shard.rows
        moved = np.zeros(ROWS, bool)

        def embedded(ids: np.ndarray) -> np.ndarray:
            return m.embed(rows[ids])
        for start in range(0, len(order), BATCH):
            batch = order[start:start + BATCH]
            g_out, g_bias = np.zeros_like(m.out), 0.0
            g_f = {w: np.zeros_like(m.filters[w]) for w in WIDTHS}
            g_o = {w: np.zeros(FILTERS, np.float32) for w in WIDTHS}
            touched, g_words = [], []
            for d in batch:
                words = shard.texts[d]
                h, where = m.maxima(words, embedded)
                err = float(sigmoid(h @ m.out + m.bias) - shard.y[d]) / len(batch)
                g_out += err * h
                g_bias += err
                g_h = np.where((h > 0) & (where >= 0), err * m.out, 0.0).astype(np.float32)
                for i, w in enumerate(WIDTHS):
                    g = g_h[i * FILTERS:(i + 1) * FILTERS]
                    k = np.flatnonzero(g)
                    if len(k):
                        span = words[where[i * FILTERS + k][:, None] + np.arange(w)]
                        x = embedded(span.ravel()).reshape(len(k), w, DIM)
                        g_f[w][:, :, k] += (g[k][:, None, None] * x).transpose(1, 2, 0)
                        g_o[w][k] += g[k]
                        touched.append(span.ravel())
                        g_words.append((g[k][:, None, None] * m.filters[w][:, :, k].transpose(2, 0, 1)).reshape(-1, DIM))
            self._move("out", m.out, g_out)
            bias = np.array([m.bias])
            self._move("bias", bias, np.array([g_bias], np.float32))
            m.bias = bias[0]
            for w in WIDTHS:
                self._move(f"f{w}", m.filters[w], g_f[w])
                self._move(f"o{w}", m.offsets[w], g_o[w])
            if g_words:
                at, back = np.unique(rows[np.concatenate(touched)], return_inverse=True)
                total = np.zeros((len(at), DIM), np.float32)
                np.add.at(total, back.reshape(-1), np.repeat(np.concatenate(g_words), rows.shape[1], axis=0))
                self.table[at] += (total * total).mean(axis=1)
                m.table[at] -= RATE * total / np.sqrt(self.table[at])[:, None]
                moved[at] = True
        return np.flatnonzero(moved)


class Embedded:
    """Word -> position in growing arrays of embeddings and marks; a text's new words are embedded in one step."""

    def __init__(self, model: TextCNN, limit: int = CACHE_SCORED):
        self.model, self.limit = model, limit
        self.vectors, self.marks = np.zeros((1024, DIM), np.float32), np.zeros(1024, np.int8)
        self.index = WordCache(self._add, limit)
        self.new: list[str] = []
        self.size = 0

    def _add(self, word: str) -> int:
        self.new.append(word)
        return self.size + len(self.new) - 1

    def encode(self, text: bytes | None) -> np.ndarray:
        if self.size > len(self.index) + (1 << 16):  # words that the cache did not keep
            self.index.clear()
            self.size = 0
        ids = word_ids(self.index, words_of(text), np.int32)
        if self.new:
            size = self.size + len(self.new)
            if size > len(self.vectors):
                room = max(size, 2 * len(self.vectors))
                self.vectors, self.marks = (np.concatenate([x[:self.size], np.zeros((room - self.size, *x.shape[1:]), x.dtype)])
                                            for x in (self.vectors, self.marks))
            rows, marks = zip(*map(features, self.new))
            self.vectors[self.size:size] = self.model.embed(np.array(rows))
            self.marks[self.size:size] = marks
            self.new, self.size = [], size
        return ids


_SHARDS = "shard bigint, n bigint, positive bigint, vocabulary binary, marks binary, sizes binary, words binary, labels binary"

_CELLS = ["vocabulary", "marks", "sizes", "words", "labels"]


def _encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (shard, doc_id, label, text), shards one after another, to one row a shard; a shard of many bytes becomes several."""
    held: list[tuple] = []
    size, shard, part, vocabulary = 0, None, 0, Vocabulary()

    def row() -> pa.RecordBatch:
        held.sort(key=lambda r: r[:2])
        words = np.concatenate([r[3] for r in held]) if held else np.zeros(0, np.int32)
        cells = [vocabulary.rows[:vocabulary.size], vocabulary.marks[:vocabulary.size], np.array([len(r[3]) for r in held], np.int64), words,
                 np.array([r[2] for r in held], np.float64)]
        counts = [pa.array([x], pa.int64()) for x in (shard << 20 | part, len(held), sum(r[2] for r in held))]
        return pa.RecordBatch.from_arrays([*counts, *[pa.array([c.tobytes()], pa.binary()) for c in cells]],
                                          names=["shard", "n", "positive", "vocabulary", "marks", "sizes", "words", "labels"])
    for batch in batches:
        for s, doc_id, label, text in zip(*(batch.column(i) for i in range(4))):
            s, doc_id, data = s.as_py(), doc_id.as_py(), text.as_buffer().to_pybytes()
            if held and (s != shard or size >= SHARD_BYTES):
                yield row()
                part = part + 1 if s == shard else 0
                held, size, vocabulary = [], 0, Vocabulary()
            shard = s
            held.append((hash32(str(doc_id).encode()), doc_id, label.as_py(), vocabulary.encode(data)))
            size += len(data)
    if held:
        yield row()


def _shard(vocabulary: bytes, marks: bytes, sizes: bytes, words: bytes, labels: bytes) -> Shard:
    ends = np.cumsum(np.frombuffer(sizes, np.int64))
    return Shard(np.frombuffer(vocabulary, np.int32).reshape(-1, 1 + len(PREFIXES)), np.frombuffer(marks, np.int8),
                 np.split(np.frombuffer(words, np.int32), ends[:-1]), np.frombuffer(labels, np.float64))


def _shards_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Shard]]:
    for batch in batches:
        for i in range(batch.num_rows):
            number, *cells = [c[i].as_py() for c in batch.columns]
            yield number, _shard(*cells)


def _mean(parts: pa.Table) -> pa.Table:
    """The shards' values of one block, by rows: of the embeddings where a shard has moved them."""
    parts = parts.sort_by("shard")
    block, width = parts["block"][0].as_py(), parts["width"][0].as_py()
    found = [(np.frombuffer(at.as_py(), np.int32), np.frombuffer(v.as_py(), np.float32).reshape(-1, width), n.as_py())
             for at, v, n in zip(parts["at"], parts["value"], parts["n"])]
    every = np.unique(np.concatenate([at for at, _, _ in found]))
    total, weight = np.zeros((len(every), width)), np.zeros((len(every), 1))
    for at, value, n in found:
        k = np.searchsorted(every, at)
        total[k] += n * value.astype(np.float64)
        weight[k] += n
    value = (total / weight).astype(np.float32)
    return pa.table({"block": pa.array([block], pa.int32()), "at": pa.array([every.tobytes()], pa.binary()), "value": pa.array([value.tobytes()], pa.binary())})


def _fit_shards(shards: DataFrame, labelled: int, seed: int = 13) -> tuple[TextCNN, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """Rounds over several shards, and what the model says of the rows kept out of the steps."""
    sc = shards.sparkSession.sparkContext
    model = TextCNN(seed)
    squares = Squares(model)
    block_rows = ROWS // BLOCKS
    for number in range(rounds_of(round(labelled * 0.8))):
        common = sc.broadcast(squares)

        def one_round(batches: Iterator[pa.RecordBatch], number=number, common=common) -> Iterator[pa.RecordBatch]:
            import copy
            for name, shard in _shards_of(batches):
                own = copy.deepcopy(common.value)
                _, train = shard.dealt(np.random.default_rng((seed, name)))
                np.random.default_rng((seed, name, number)).shuffle(train)
                moved = own.round(shard, train)
                table = np.hstack([own.model.table[moved], own.table[moved][:, None]])
                dense = np.concatenate([x.ravel() for d in (own.model.dense(), own.dense) for x in d.values()])
                parts = [(-1, 1, np.arange(len(dense)), dense)]
                for b in range(BLOCKS):
                    part = slice(*np.searchsorted(moved, (b * block_rows, (b + 1) * block_rows)))
                    parts.append((b, DIM + 1, moved[part], table[part]))
                for b, width, at, value in parts:
                    if len(at) and len(train):
                        cells = [pa.array([b], pa.int32()), pa.array([name], pa.int64()), pa.array([len(train)], pa.int64()), pa.array([width], pa.int32()),
                                 pa.array([at.astype(np.int32).tobytes()], pa.binary()), pa.array([value.astype(np.float32).tobytes()], pa.binary())]
                        yield pa.RecordBatch.from_arrays(cells, names=["block", "shard", "n", "width", "at", "value"])
        parts = shards.mapInArrow(one_round, "block int, shard bigint, n bigint, width int, at binary, value binary")
        means = parts.groupBy("block").applyInArrow(_mean, "block int, at binary, value binary").collect()
        for r in means:
            at = np.frombuffer(r["at"], np.int32)
            if r["block"] >= 0:
                value = np.frombuffer(r["value"], np.float32).reshape(-1, DIM + 1)
                model.table[at], squares.table[at] = value[:, :DIM], value[:, DIM]
                continue
            flat, start, halves = np.frombuffer(r["value"], np.float32).copy(), 0, []
            for d in (model.dense(), squares.dense):
                halves.append({})
                for name, x in d.items():
                    halves[-1][name] = flat[start:start + x.size].reshape(x.shape)
                    start += x.size
            model.set_dense(halves[0])
            squares.dense = halves[1]
        common.destroy()
    shared = sc.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, shard in _shards_of(batches):
            calibration, _ = shard.dealt(np.random.default_rng((seed, name)))
            p, language, y = shared.value.judged(shard, calibration)
            cells = [pa.array([x.tobytes()], pa.binary()) for x in (p.astype(np.float64), language, y)]
            yield pa.RecordBatch.from_arrays([pa.array([name], pa.int64()), *cells], names=["shard", "p", "language", "y"])
    # three numbers a row kept out
    found = shards.mapInArrow(judge, "shard bigint, p binary, language binary, y binary").collect()
    shared.destroy()
    return model, [(np.frombuffer(r["p"]), np.frombuffer(r["language"], np.int64), np.frombuffer(r["y"])) for r in sorted(found, key=lambda r: r["shard"])]


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int | None = None, fold_of=FOLD,
          id_col: str = "doc_id", text_col: str = "text") -> TextCNN | None:
    """A model from all rows that are not held out (at most about ``per_class`` of each class, if given); None without both classes."""
    small_batches(docs.sparkSession)
    sample, n = labelled_sample(docs, labels, label, *fold_of, per_class, id_col, text_col, shard_rows=SHARD_ROWS)
    ordered = sample.select("shard", "doc_id", "label", F.col("text").cast("binary").alias("text")).sortWithinPartitions("shard", F.xxhash64("doc_id"), "doc_id")
    shards = scratch_table(ordered.mapInArrow(_encoded, _SHARDS), "toxicity-shards")
    seen = shards.agg(F.count(F.lit(1)).alias("shards"), F.sum("n").alias("n"), F.sum("positive").alias("positive")).first()
    if not seen["shards"] or seen["positive"] in (0, seen["n"]):
        return None

    def weight(y: np.ndarray) -> np.ndarray | None:
        """One over the class's share of rows drawn."""
        return None if per_class is None else np.array([max(1.0, n[int(c)] / per_class) for c in y])
    if seen["shards"] == 1:
        shard = _shard(*shards.select(*_CELLS).first())
        return TextCNN().fit(shard, weight=weight(shard.y))
    model, held = _fit_shards(shards.select("shard", *_CELLS), seen["n"])
    p, language, y = (np.concatenate(x) for x in zip(*held))
    model._calibrate(p, language, y, weight(y))
    return model


def score(docs: DataFrame, model: TextCNN | None, keep: list[str], text_col: str = "text", score_col: str = "score") -> DataFrame:
    """The kept columns and the score of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 12 MB, fixed by the model's shape

    def scorer():
        cnn = shared.value
        if cnn is None:
            return lambda texts: [pa.array([0.0] * len(texts), pa.float64())]
        words = Embedded(cnn)

        def one(text: bytes | None) -> float:
            ids = words.encode(text)
            return cnn.score(ids, words.vectors.__getitem__, language_of(words.marks[ids]))

        def run(texts):
            return [pa.array([one(t) for t in texts], pa.float64())]
        return run
    return map_texts(docs, text_col, keep, scorer, f"{score_col} double")


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    model = train(docs, labels, id_col=id_col, text_col=text_col)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    rows = rows.withColumn("held_out", fold("doc_id", FOLD[0]) == FOLD[1])
    return score(rows, model, ["doc_id", "held_out"]).withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents scored below the cut, with their columns."""
    model = train(docs, labels, id_col=id_col, text_col=text_col)
    mark = "__toxicity"
    scored = score(docs, model, list(docs.columns), text_col, mark)
    return scored.where(F.col(mark) < CUT).drop(mark)
