"""MinHash near-duplicates with sequential Bayesian verification.

A document's set is its distinct 5-word shingles.  Two documents are linked if their sets'
intersection is at least ``percent`` (85 in op3, 80 in ``drop_near_duplicates``) of their union; groups are the connected components of the links.

1. One pass over the texts: shingles as 64-bit hashes, a 128-bit key of the whole set, a MinHash
   signature of ``bands_for(percent)`` x ROWS values and one hash per band.  Written once, without texts.
2. Documents with the same set form a class.  Only classes go on, so copies cost nothing more.
3. Classes that share a band hash are candidates.  A bucket only yields edges from its members to
   its smallest one; the components of those edges are families, which hold all candidate pairs.
4. A family is dealt to tasks in blocks of bounded rows and bytes (each pair of blocks is one group).
   In a group, pairs that share a band and fit in size are compared signature batch by batch: a
   pair is dropped as soon as the posterior probability (uniform prior) that its similarity reaches
   the threshold falls below MISS.  Survivors are verified on their full shingle sets, read anew
   from the texts of the classes in families.  Pairs that earlier links of the group already connect
   need no test, and only links leave the group: at most one fewer than it has members.
5. Components of the links.

Chosen miss probabilities: banding misses a pair at exactly the threshold t with (1 - t^ROWS)^bands;
there are as many bands as bring that below BAND_MISS (24 at 85 %, 35 at 80 %; far less is missed
above the threshold), and pruning adds at most MISS per batch.

Defined cases: null, empty and blank texts have empty sets, are linked with nothing and stay; texts
of fewer than five words are one shingle; a document's component id is the smallest doc_id it
reaches, null only if no reached document has one; repeated rows are members of one component
(``drop_near_duplicates`` keeps one of them); an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.llm.common import bounded_broadcast, scratch_table
from ladle.llm.components import components
from ladle.llm.texts import WordCache, map_texts, word_ids

SHINGLE = 5
PERCENT, KEEP_PERCENT = 85, 80
BANDS, ROWS = 24, 5
BAND_MISS = 1e-6
HASHES = BANDS * ROWS
BATCH_HASHES = 24
MISS = 1e-8
#: shingles hashed at once
CHUNK = 2048
#: most members and bytes of shingles in a block (a single larger set is a block of its own)
BLOCK_MEMBERS, BLOCK_BYTES = 1024, 8 << 20
#: (doc_id, text hash) pairs that may be broadcast to pick texts: 16 bytes each
MAX_BROADCAST_TEXTS = 1_000_000

_rng = np.random.default_rng(2024)
_POSITION = _rng.integers(1, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHORT = _rng.integers(1, 1 << 63, SHINGLE, dtype=np.uint64)
_FACTORS = (_rng.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1))[:, None]
_BAND = _rng.integers(1, 1 << 63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND_SEED = _rng.integers(1, 1 << 63, BANDS, dtype=np.uint64)
_MIX = np.uint64(0xFF51AFD7ED558CCD)
_SHIFT = np.uint64(32)


def bands_for(percent: int) -> int:
    """Fewest bands that miss a pair at exactly the threshold with a probability below BAND_MISS."""
    return math.ceil(math.log(BAND_MISS) / math.log1p(-(percent / 100) ** ROWS))


@cache
def _hashing(bands: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Factors of the permutations, and factors and seeds of the bands; those beyond BANDS have a generator of their own."""
    extra = max(0, bands - BANDS)
    rng = np.random.default_rng(2025)
    factors = rng.integers(1, 1 << 63, (extra * ROWS, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    band = rng.integers(1, 1 << 63, (extra, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    seed = rng.integers(1, 1 << 63, extra, dtype=np.uint64)
    return (np.concatenate([_FACTORS, factors])[:bands * ROWS], np.concatenate([_BAND, band])[:bands], np.concatenate([_BAND_SEED, seed])[:bands])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _SHIFT)) * _MIX
    return x ^ (x >> _SHIFT)


def shingle_set(words: np.ndarray) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the 5-word windows of hashed words."""
    n = len(words)
    if n == 0:
        return words
    if n < SHINGLE:
        return _mixed((words * _POSITION[:n]).sum(keepdims=True) + _SHORT[n:n + 1])
    total = words[:n - SHINGLE + 1] * _POSITION[0]
    for k in range(1, SHINGLE):
        total = total + words[k:n - SHINGLE + 1 + k] * _POSITION[k]
    return np.unique(_mixed(total))


def signature(shingles: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """The smallest value of each of bands x ROWS permutations, upper 32 bits."""
    factors = _hashing(bands)[0]
    least = np.full(bands * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), CHUNK):
        np.minimum(least, (factors * shingles[at:at + CHUNK]).min(axis=1), out=least)
    return least >> _SHIFT


def _hashed_words(cache: WordCache, text: bytes | None) -> np.ndarray:
    return word_ids(cache, (text or b"").lower().split(), np.uint64)  # bytes: only A-Z change, only ASCII spaces split


def _sign(docs: DataFrame, keep: list[str], text_col: str, n_bands: int = BANDS) -> DataFrame:
    def signer():
        _, factors, seeds = _hashing(n_bands)
        cache = WordCache(xxhash.xxh64_intdigest)

        def run(texts):
            sizes, keys, least = [], [], []
            for t in texts:
                s = shingle_set(_hashed_words(cache, t))
                sizes.append(len(s))
                keys.append(xxhash.xxh3_128_digest(s.tobytes()))
                least.append(signature(s, n_bands))
            sig = np.array(least, np.uint64).reshape(len(texts), n_bands * ROWS)
            bands = _mixed((sig.reshape(-1, n_bands, ROWS) * factors).sum(axis=2, dtype=np.uint64) + seeds).astype(np.int64)
            short = sig.astype(np.uint8)
            return [pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(list(bands), pa.list_(pa.int64())),
                    pa.array([x.tobytes() for x in short], pa.binary())]
        return run
    return map_texts(docs, text_col, keep, signer, "n_shingles bigint, key binary, bands array<bigint>, sig binary")


def least_matches(hashes: int, threshold: float, miss: float = MISS) -> int:
    """Fewest matches of so many signature values with P(similarity >= threshold | matches) >= miss.

    The posterior under a uniform prior is a beta distribution, whose tail is a binomial sum.
    """
    total = 0.0
    for m in range(hashes + 1):
        total += math.comb(hashes + 1, m) * threshold ** m * (1 - threshold) ** (hashes + 1 - m)
        if total >= miss:
            return m
    return hashes


@cache
def _least(percent: int) -> dict[int, int]:
    """Fewest matches that keep a pair alive, after each batch of signature values.

    Values are bytes of a signature: two may share their low byte by chance, which the threshold allows for.
    """
    threshold, hashes = percent / 100 + (1 - percent / 100) / 256, bands_for(percent) * ROWS
    return {n: least_matches(n, threshold) for n in [*range(BATCH_HASHES, hashes, BATCH_HASHES), hashes]}


def survivors(sig: np.ndarray, others: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Positions in ``others`` whose signatures survive the batch-wise comparison with ``sig``."""
    alive, matches, start = np.arange(len(others)), np.zeros(len(others), int), 0
    for stop, least in _least(percent).items():
        batch, start = slice(start, stop), stop
        matches = matches + (others[alive, batch] == sig[batch]).sum(axis=1)
        left = matches >= least
        alive, matches = alive[left], matches[left]
    return alive


class _Group:
    """Members of one or two blocks of a family, and the tests between them."""

    def __init__(self, rows: list[tuple[int, int, int, bytes, np.ndarray, bytes]], percent: int = PERCENT):
        self.percent = percent
        self.block = np.array([r[0] for r in rows])
        self.cid = np.array([r[1] for r in rows])
        self.size = np.array([r[2] for r in rows])
        self.sig = np.frombuffer(b"".join(r[3] for r in rows), np.uint8).reshape(len(rows), -1)
        self.bands = np.stack([r[4] for r in rows])
        shingles = np.frombuffer(b"".join(r[5] for r in rows), np.uint64)
        owner = np.repeat(np.arange(len(rows)), self.size)
        _, self.ids = np.unique(shingles, return_inverse=True)
        order = np.argsort(self.ids, kind="stable")
        self.postings = owner[order]
        self.start = np.concatenate([[0], np.cumsum(np.bincount(self.ids))])
        self.ends = np.concatenate([[0], np.cumsum(self.size)])

    def common(self, a: int) -> np.ndarray:
        """Sizes of the exact intersections of member a's set with every member's."""
        ids = self.ids[self.ends[a]:self.ends[a + 1]]
        n = self.start[ids + 1] - self.start[ids]
        at = np.arange(n.sum()) + np.repeat(self.start[ids] - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
        return np.bincount(self.postings[at], minlength=len(self.cid))

    def links(self, within: bool) -> list[tuple[int, int]]:
        """Links that connect members, between the two blocks or within the one."""
        part, out = np.arange(len(self.cid)), []
        for a in range(len(self.cid)):
            later = np.arange(a + 1, len(self.cid)) if within else np.flatnonzero(self.block > self.block[a])
            later = later[part[later] != part[a]]
            n = self.size[later]
            later = later[100 * np.minimum(n, self.size[a]) >= self.percent * np.maximum(n, self.size[a])]
            later = later[(self.bands[later] == self.bands[a]).any(axis=1)]
            later = later[survivors(self.sig[a], self.sig[later], self.percent)]
            if not len(later):
                continue
            common = self.common(a)[later]
            for b in later[100 * common >= self.percent * (self.size[later] + self.size[a] - common)]:
                if part[a] != part[b]:
                    part[part == part[b]] = part[a]
                    out.append((int(self.cid[a]), int(self.cid[b])))
        return out


def _sets(members: DataFrame, docs: DataFrame) -> DataFrame:
    """(cid, shingles) of the members, from the texts that stand for their classes."""
    picked = bounded_broadcast(members.select("cid", F.col("doc_id").alias("p_id"), F.col("th").alias("p_th")), MAX_BROADCAST_TEXTS)
    texts = docs.join(picked, (F.col("th") == F.col("p_th")) & F.col("doc_id").eqNullSafe(F.col("p_id")))

    def shingler():
        cache = WordCache(xxhash.xxh64_intdigest)
        return lambda texts: [pa.array([shingle_set(_hashed_words(cache, t)).tobytes() for t in texts], pa.binary())]
    sets = map_texts(texts.select("cid", "text"), "text", ["cid"], shingler, "shingles binary")
    return sets.groupBy("cid").agg(F.first("shingles").alias("shingles"))  # rows that repeat an id and its text


def _families(classes: DataFrame) -> DataFrame:
    """(cid, family) of the classes that share a band hash with another one, over any number of steps."""
    spread = classes.select("cid", F.explode("bands").alias("bucket"))
    held = spread.groupBy(F.col("bucket").alias("k")).agg(F.min("cid").alias("center"), F.max("cid").alias("last")).where("center <> last")
    edges = spread.join(held.select("k", "center"), F.col("bucket") == F.col("k")).where("cid <> center")
    return components(edges.select(F.col("cid").alias("a"), F.col("center").alias("b")), "dedup-families").select(
        F.col("node").alias("cid"), F.col("label").alias("family"))


def _links(classes: DataFrame, docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Verified links that connect every pair of linked classes of a family."""
    members = scratch_table(classes.join(_families(classes), "cid"), "dedup-members")
    blocks = members.groupBy(F.col("family").alias("f")).agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / BLOCK_MEMBERS), F.ceil(F.sum(8 * F.col("n_shingles")) / BLOCK_BYTES)).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")
    dealt = (members.join(blocks, F.col("family") == F.col("f")).withColumn("block", own)
                    .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                    .join(_sets(members, docs), "cid")
                    .select("family", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                            "block", "cid", "n_shingles", "sig", "bands", "shingles"))
    dealt = dealt.repartition("family", "i", "j").sortWithinPartitions("family", "i", "j", "block", "cid")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []

        def tested() -> pa.RecordBatch:
            found = _Group(rows, percent).links(within=key[1] == key[2]) if len(rows) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([x for _, x in found], pa.int64())], names=["a", "b"])
        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(7)] + [batch.column(8).to_pylist()]
            bands = batch.column(7).values.to_numpy().reshape(-1, bands_for(percent))
            for k, (family, i, j, block, cid, size, sig, shingles) in enumerate(zip(*columns)):
                if (family, i, j) != key:
                    if rows:
                        yield tested()
                    key, rows = (family, i, j), []
                rows.append((block, cid, size, sig, bands[k], shingles))
        if rows:
            yield tested()
    return dealt.mapInArrow(task, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(documents with th, n_shingles, key; classes with component_id and the one document that stays).

    Both are written tables: the first has a row per document, the second one per distinct set.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    source = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"))
    signed = scratch_table(_sign(source, ["doc_id", "th"], "text", bands_for(percent)), "dedup-signed")
    # any row of a set will do, as all of them have its bands and signature; the smallest id stands for it
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th"))
    sets = (signed.where("n_shingles > 0").groupBy("key", "n_shingles")
                  .agg(first.alias("rep"), F.first("bands").alias("bands"), F.first("sig").alias("sig")))
    classes = scratch_table(sets.select(F.monotonically_increasing_id().alias("cid"), "key", "n_shingles", F.col("rep.doc_id").alias("doc_id"),
                                        F.col("rep.th").alias("th"), "bands", "sig"), "dedup-classes")
    labels = scratch_table(components(scratch_table(_links(classes, source, percent), "dedup-links")), "dedup-labels")
    named = classes.select("cid", "key", "doc_id", "th").join(labels, F.col("cid") == F.col("node"), "left").withColumn("label", F.coalesce("label", "cid"))
    # the smallest id of a component, and the document that carries it
    heads = named.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("head"))
    named = named.select("key", "label").join(heads, "label").select("key", F.col("head.doc_id").alias("component_id"), F.col("head.th").alias("head_th"))
    return signed.select("doc_id", "th", "n_shingles", "key"), scratch_table(named, "dedup-named")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document."""
    rows, classes = near_duplicates(docs, id_col, text_col)
    out = rows.join(classes, "key", "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = KEEP_PERCENT) -> DataFrame:
    """One document of each group, and every document without shingles, with their columns."""
    rows, classes = near_duplicates(docs, id_col, text_col, percent)
    stays = classes.select(F.col("component_id").alias("__id"), F.col("head_th").alias("__th")).distinct()
    empty = rows.where("n_shingles = 0").select(F.col("doc_id").alias("__id"), F.col("th").alias("__th")).distinct()
    stays = scratch_table(stays.union(empty), "dedup-stays")
    th = F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    kept = docs.join(bounded_broadcast(stays, MAX_BROADCAST_TEXTS), (th == F.col("__th")) & F.col(f"`{id_col}`").eqNullSafe(F.col("__id")), "left_semi")
    repeated = rows.where("n_shingles > 0").groupBy("doc_id", "th").count().where("count > 1").limit(1).count()
    return kept if not repeated else _one_of_each(kept, id_col, text_col)


def _one_of_each(kept: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows that repeat an id and its text: one stays (blank texts are linked with nothing, so all of theirs stay)."""
    blank = ~F.coalesce(F.col(f"`{text_col}`"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    return kept.where(blank).union(kept.where(~blank).dropDuplicates([id_col, text_col]))
