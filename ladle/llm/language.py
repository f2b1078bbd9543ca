"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

Words are runs of letters with an edge mark on both sides; their 1- to 3-grams are hashed to
``DIMS`` rows.  A feature is the n-gram's share of the text's n-grams times its inverse document
frequency.  Weights are trained with follow-the-regularised-leader (per-coordinate steps, L1 and
L2 penalties, which leave most weights at zero), and a temperature fitted on rows kept out of
training makes the softmax a calibrated score.

The fit (frequencies included) uses a bounded sample of rows that are not held out, at most about
``TRAIN_PER_LANGUAGE`` of each language.  Scoring reads every whole text: the contributions of a batch's
distinct words are computed once and summed over each text, which gives exactly the linear score.

Defined cases: a null text or one without a letter is ``und`` with score 0; null languages are not
learned from; with no row to learn from every text is ``und``; repeated rows get equal results;
ties between languages go to the smaller name; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.llm.common import fold
from ladle.llm.texts import DistinctWords, hash32, map_texts, slices

UNKNOWN = "und"
TRAIN_PER_LANGUAGE = 1000
FOLD = (5, 0)
DIMS = 1 << 16
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.02, 0.01
EPOCHS = 3
MIN_SCORE = 0.5
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
_ALPHA = np.zeros(0, bool)


def _is_letter(points: np.ndarray) -> np.ndarray:
    """Whether code points are letters, by a table made once per process."""
    global _ALPHA
    if not len(_ALPHA):
        _ALPHA = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _ALPHA[points]


def _rows(n: int, *points: np.ndarray) -> np.ndarray:
    h = np.uint64(n)
    for p, factor in zip(points, _FACTORS):
        h = (h ^ p) * factor
        h = h ^ (h >> np.uint64(29))
    return (h >> np.uint64(20)).astype(np.int64) % DIMS


def gram_rows(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed rows of all n-grams of the words' letter runs, and the word each one comes from.

    Code points that are no letters count as 0, which marks both edges of a run: a letter, a pair with
    a letter in it, and a triple with a letter in its middle are the 1- to 3-grams of a marked run.
    """
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    text = "\0".join(words) + "\0"
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    owner = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)) + 1)
    letter = _is_letter(points)
    c = np.concatenate([[0], np.where(letter, points, 0), [0]]).astype(np.uint64)
    before, here, after = c[:-2], c[1:-1], c[2:]
    pair = letter | (before > 0)
    return (np.concatenate([_rows(1, here[letter]), _rows(2, before[pair], here[pair]), _rows(3, before[letter], here[letter], after[letter])]),
            np.concatenate([owner[letter], owner[pair], owner[letter]]))


class LanguageModel:
    """Languages, per-row score contributions (weights times inverse document frequency) and temperature."""

    def __init__(self, languages: list[str]):
        self.languages = languages
        self.idf = np.ones(DIMS)
        self.z = np.zeros((DIMS, len(languages)))
        self.n = np.zeros((DIMS, len(languages)))
        self.bias = np.zeros(len(languages))
        self.temperature = 1.0

    def weights(self, rows=slice(None)) -> np.ndarray:
        """FTRL closed form: zero where the L1 ball holds the accumulated gradient."""
        z, n = self.z[rows], self.n[rows]
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def fit(self, docs: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, seed: int = 5) -> LanguageModel:
        rng = np.random.default_rng(seed)
        kept_out = rng.random(len(docs)) < 0.2
        train = np.flatnonzero(~kept_out) if not kept_out.all() else np.arange(len(docs))
        df = np.zeros(DIMS)
        for d in train:
            df[docs[d][0]] += 1
        self.idf = np.log((1.0 + len(train)) / (1.0 + df)) + 1.0

        def x_of(d):
            rows, counts = docs[d]
            return rows, counts / counts.sum() * self.idf[rows]
        for _ in range(EPOCHS):
            rng.shuffle(train)
            for d in train:
                rows, x = x_of(d)
                w = self.weights(rows)
                logits = SCALE * (x @ w) + self.bias
                p = np.exp(logits - logits.max())
                p /= p.sum()
                p[y[d]] -= 1.0
                g = SCALE * x[:, None] * p[None, :]
                sigma = (np.sqrt(self.n[rows] + g * g) - np.sqrt(self.n[rows])) / ALPHA
                self.z[rows] += g - sigma * w
                self.n[rows] += g * g
                self.bias -= 0.01 * p
        held = np.flatnonzero(kept_out)
        if len(held):
            w = self.weights()
            logits = np.array([SCALE * (x @ w[rows]) + self.bias for rows, x in map(x_of, held)])
            grid = np.exp(np.linspace(np.log(0.2), np.log(5.0), 65))
            self.temperature = float(min(grid, key=lambda t: self._loss(logits / t, y[held])))
        return self

    @staticmethod
    def _loss(logits: np.ndarray, y: np.ndarray) -> float:
        top = logits.max(axis=1, keepdims=True)
        return float((np.log(np.exp(logits - top).sum(axis=1)) + top[:, 0] - logits[np.arange(len(y)), y]).mean())

    def frozen(self) -> FrozenModel:
        return FrozenModel(self.languages, SCALE * self.weights() * self.idf[:, None], self.bias, self.temperature)


#: the n-gram shares of a text are small numbers; this brings their sums to the scale of logits
SCALE = 30.0


class FrozenModel:
    """What scoring needs: one row of contributions per n-gram row."""

    def __init__(self, languages: list[str], table: np.ndarray, bias: np.ndarray, temperature: float):
        self.languages, self.table, self.bias, self.temperature = languages, table, bias, temperature

    def contributions(self, words: list[str]) -> np.ndarray:
        """Per word its summed contributions, and its number of n-grams as last column."""
        rows, owner = gram_rows(words)
        out = [np.bincount(owner, self.table[rows, k], len(words)) for k in range(len(self.languages))]
        return np.stack([*out, np.bincount(owner, minlength=len(words)).astype(float)], axis=1)

    def predict(self, rows: np.ndarray) -> tuple[str, float]:
        """From the summed contributions of a text's words."""
        if not self.languages or rows[-1] == 0:
            return UNKNOWN, 0.0
        logits = (rows[:-1] / rows[-1] + self.bias) / self.temperature
        p = np.exp(logits - logits.max())
        k = int(np.argmax(p))
        return self.languages[k], float(p[k] / p.sum())


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_language: int = TRAIN_PER_LANGUAGE) -> FrozenModel:
    d = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang"))
    usable = d.where(F.col("lang").isNotNull() & (fold("doc_id", FOLD[0]) != FOLD[1]))
    counts = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a language
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, F.lit(1e6 * min(1.0, per_language / n))).otherwise(share)
    chosen = usable.where(F.pmod(F.xxhash64("doc_id", "text", F.lit(23)), F.lit(1_000_000)) < share)

    def features():
        def run(texts):
            rows, counts = [], []
            for read in (DistinctWords(pc.utf8_lower(texts.slice(i, 1))) for i in range(len(texts))):
                grams, owner = gram_rows(read.words.to_pylist())
                r, back = np.unique(grams, return_inverse=True)
                times = np.bincount(read.code, minlength=len(read.words))
                rows.append(r.astype(np.int32).tobytes())
                counts.append(np.bincount(back, times[owner], len(r)).astype(np.int32).tobytes())
            return [pa.array(rows, pa.binary()), pa.array(counts, pa.binary())]
        return run
    found = map_texts(chosen, "text", ["doc_id", "lang"], features, "grams binary, counts binary", as_arrow=True).collect()
    found = sorted((r for r in found if len(r["grams"])), key=lambda r: (hash32(bytes(r["grams"])), str(r["doc_id"])))
    languages = sorted({r["lang"] for r in found})
    if not languages:
        return FrozenModel([], np.zeros((0, 0)), np.zeros(0), 1.0)
    coded = [(np.frombuffer(r["grams"], np.int32).astype(np.int64), np.frombuffer(r["counts"], np.int32).astype(float)) for r in found]
    y = np.array([languages.index(r["lang"]) for r in found])
    return LanguageModel(languages).fit(coded, y).frozen()


def predict(docs: DataFrame, model: FrozenModel, keep: list[str], text_col: str = "text",
            lang_out: str = "lang_pred", score_out: str = "score") -> DataFrame:
    """The kept columns, the predicted language and its probability, of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # DIMS rows by languages

    def scorer():
        m = shared.value

        def part(texts):
            if not m.languages:
                return [(UNKNOWN, 0.0)] * len(texts)
            read = DistinctWords(pc.utf8_lower(texts))
            each = m.contributions(read.words.to_pylist())
            total = np.concatenate([np.zeros((1, each.shape[1])), np.cumsum(each[read.code], axis=0)])
            return [m.predict(x) for x in total[read.ends[1:]] - total[read.ends[:-1]]]

        def run(texts):
            out = [x for at, n in slices(texts) for x in part(texts.slice(at, n))]
            return [pa.array([x for x, _ in out], pa.string()), pa.array([x for _, x in out], pa.float64())]
        return run
    return map_texts(docs, text_col, keep, scorer, f"{lang_out} string, {score_out} double", as_arrow=True)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    model = train(docs, id_col, text_col, lang_col)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    rows = rows.withColumn("held_out", fold("doc_id", FOLD[0]) == FOLD[1])
    return predict(rows, model, ["doc_id", "held_out"])


def keep_identified(docs: DataFrame, min_score: float = MIN_SCORE, id_col: str = "doc_id", text_col: str = "text",
                    lang_col: str = "lang") -> DataFrame:
    """The documents with a predicted language of at least ``min_score``, with their columns."""
    model = train(docs, id_col, text_col, lang_col)
    scored = predict(docs, model, list(docs.columns), text_col, "__lang", "__sure")
    return scored.where((F.col("__lang") != UNKNOWN) & (F.col("__sure") >= min_score)).drop("__lang", "__sure")
