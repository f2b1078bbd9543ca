"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(b + sum_i w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2]).  The
bracket is the sum-of-squares identity: all pairwise interactions in time linear in the features.

Features: hashed words with the square root of their share of the text; statistics of the text's
structure (symbols, capitals, digits, repeated lines and words, word length, length) cut into bins,
one feature a bin; and the metadata column ``n_chars`` cut the same way.  Trained with AdaGrad in
numpy on a bounded sample of labelled rows (``TRAIN_PER_CLASS`` of each class, none held out); the
bias is then set for the class shares of all usable rows.

Defined cases: null and empty texts have no word features and are scored by their statistics; a null
``n_chars`` (or none in the table) has a bin of its own; without labelled rows of both classes
every score is 0.5; repeated rows get equal scores; null ids are kept; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.llm.common import fold
from ladle.llm.texts import WordCache, hash32, labelled_sample, map_texts, sigmoid, word_ids

TRAIN_PER_CLASS = 4000
FOLD = (3, 1)
WORD_ROWS = 1 << 16
BINS = 16
STATS = ("symbols", "capitals", "digits", "repeated_lines", "distinct_words", "top_word", "word_length", "words", "lines",
         "marks", "n_chars")
DIMS = WORD_ROWS + BINS * len(STATS)
RANK = 8
EPOCHS, BATCH, RATE, DECAY = 5, 64, 0.1, 1e-4
_SYMBOLS = b"#*$%&|<>"
_CAPITALS = bytes(range(65, 91))
_DIGITS = b"0123456789"
_MARKS = b"!?"


def _share_bin(share: float) -> int:
    """Finer bins near 0: share 0, then powers of two up to 1."""
    return 0 if share <= 0 else max(1, min(BINS - 1, BINS - 1 + math.ceil(math.log2(min(1.0, share)))))


def _size_bin(size: float) -> int:
    return min(BINS - 2, int(math.log2(size + 1)))


def _share_out(data: bytes, of: bytes) -> int:
    return len(data) - len(data.translate(None, of))


def features(cache: WordCache, text: bytes | None, n_chars: int | None) -> tuple[np.ndarray, np.ndarray]:
    """(rows, values) of one whole text."""
    data = text or b""
    words = data.lower().split()
    n = max(1, len(words))
    ids, counts = np.unique(word_ids(cache, words), return_counts=True)
    lines = [x for x in data.split(b"\n") if x.strip()]
    size = max(1, sum(map(len, words)))
    bins = (
        _share_bin(_share_out(data, _SYMBOLS) / size), _share_bin(_share_out(data, _CAPITALS) / size),
        _share_bin(_share_out(data, _DIGITS) / size), _share_bin((len(lines) - len(set(lines))) / max(1, len(lines))),
        int((BINS - 1) * len(ids) / n), _share_bin(counts.max() / n if len(counts) else 0.0), min(BINS - 1, size // n),
        _size_bin(len(words)), _size_bin(len(lines)), _share_bin(_share_out(data, _MARKS) / size),
        BINS - 1 if n_chars is None else _size_bin(max(0, n_chars)))
    stats = np.arange(len(STATS)) * BINS + np.array(bins) + WORD_ROWS
    return np.concatenate([ids, stats]), np.concatenate([np.sqrt(counts / n), np.full(len(STATS), 0.5)])


class FactorisationMachine:
    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.b, self.w = 0.0, np.zeros(DIMS)
        self.v = rng.standard_normal((DIMS, RANK)) * 0.05

    def logits(self, rows: np.ndarray, x: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Outputs of texts whose features stand one after another (no text has none), and the inner sums."""
        vx = self.v[rows] * x[:, None]
        sums = np.add.reduceat(vx, starts, axis=0)
        squares = np.add.reduceat(vx * vx, starts, axis=0)
        return self.b + np.add.reduceat(self.w[rows] * x, starts) + 0.5 * (sums * sums - squares).sum(axis=1), sums

    def fit(self, docs: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, seed: int = 11) -> FactorisationMachine:
        rng = np.random.default_rng(seed)
        gw, gv, gb = np.full(DIMS, 1e-4), np.full((DIMS, RANK), 1e-4), 1e-4
        order = np.arange(len(docs))
        for _ in range(EPOCHS):
            rng.shuffle(order)
            for at in range(0, len(order), BATCH):
                batch = order[at:at + BATCH]
                rows, x, starts = joined([docs[d] for d in batch])
                z, sums = self.logits(rows, x, starts)
                err = (sigmoid(z) - y[batch]) / len(batch)
                sizes = np.diff(np.append(starts, len(rows)))
                e = np.repeat(err, sizes) * x
                u, back = np.unique(rows, return_inverse=True)
                d_w = np.bincount(back, e, len(u)) + DECAY * self.w[u]
                inner = np.repeat(sums, sizes, axis=0) - self.v[rows] * x[:, None]
                d_v = np.stack([np.bincount(back, e * inner[:, f], len(u)) for f in range(RANK)], axis=1) + DECAY * self.v[u]
                gw[u] += d_w * d_w
                gv[u] += d_v * d_v
                gb += err.sum() ** 2
                self.w[u] -= RATE * d_w / np.sqrt(gw[u])
                self.v[u] -= RATE * d_v / np.sqrt(gv[u])
                self.b -= RATE * err.sum() / math.sqrt(gb)
        return self


def joined(docs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    starts = np.cumsum([0] + [len(r) for r, _ in docs[:-1]])
    return np.concatenate([r for r, _ in docs]), np.concatenate([x for _, x in docs]), starts


def _word_row(word: bytes) -> int:
    return hash32(word) % WORD_ROWS


def _with_chars(df: DataFrame) -> DataFrame:
    """The metadata travels in front of the text, so that one column reaches the workers."""
    chars = F.coalesce(F.col("n_chars").cast("string"), F.lit(""))
    return df.withColumn("packed", F.concat(chars, F.lit("\n"), F.coalesce(F.col("text"), F.lit(""))))


def _unpack(packed: bytes) -> tuple[bytes, int | None]:
    head, _, text = packed.partition(b"\n")
    return text, int(head) if head else None


def _columns(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    chars = F.col("n_chars").cast("bigint") if "n_chars" in docs.columns else F.lit(None).cast("bigint")
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), chars.alias("n_chars"))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = TRAIN_PER_CLASS, fold_of=FOLD,
          id_col: str = "doc_id", text_col: str = "text") -> FactorisationMachine | None:
    sample, n = labelled_sample(_columns(docs, id_col, text_col), labels, label, *fold_of, per_class, more=("n_chars",))

    def coder():
        cache = WordCache(_word_row)

        def run(texts):
            coded = [features(cache, *_unpack(t)) for t in texts]
            return [pa.array([r.astype(np.int32).tobytes() for r, _ in coded], pa.binary()),
                    pa.array([x.astype(np.float32).tobytes() for _, x in coded], pa.binary())]
        return run
    found = map_texts(_with_chars(sample), "packed", ["doc_id", "label"], coder, "at binary, x binary").collect()
    found = sorted(found, key=lambda r: (hash32(str(r["doc_id"]).encode()), r["doc_id"]))
    y = np.array([r["label"] for r in found], dtype=float)
    if not len(y) or y.min() == y.max():
        return None
    coded = [(np.frombuffer(r["at"], np.int32).astype(np.int64), np.frombuffer(r["x"], np.float32).astype(float)) for r in found]
    model = FactorisationMachine().fit(coded, y)
    model.b += math.log(n[1] / n[0]) - math.log(y.sum() / (len(y) - y.sum()))
    return model


def score(docs: DataFrame, model: FactorisationMachine | None, keep: list[str]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)  # DIMS rows, fixed by the model's shape

    def scorer():
        fm, cache = shared.value, WordCache(_word_row)

        def run(texts):
            if fm is None:
                return [pa.array([0.5] * len(texts), pa.float64())]
            out = []
            for at in range(0, len(texts), BATCH):
                z, _ = fm.logits(*joined([features(cache, *_unpack(t)) for t in texts[at:at + BATCH]]))
                out += sigmoid(z).tolist()
            return [pa.array(out, pa.float64())]
        return run
    return map_texts(_with_chars(docs), "packed", keep, scorer, "score double")


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    model = train(docs, labels, id_col=id_col, text_col=text_col)
    rows = _columns(docs, id_col, text_col).withColumn("held_out", fold("doc_id", FOLD[0]) == FOLD[1])
    return score(rows, model, ["doc_id", "held_out"]).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
