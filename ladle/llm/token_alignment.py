"""Operator 13: alignment of two tokenizers over whole texts, as an Arrow pipeline.

Both tokenizers read ``space + text``: a byte-level BPE (A) and a SentencePiece BPE (B, which adds the
space itself).  Byte offsets where an A token and a B token both end cut a document into groups;
an A token and a B token are linked where their byte ranges overlap.

* A text is cut into units before a space that follows a character other than white space.  Neither
  tokenizer joins bytes across such a place, so each distinct unit of a slice is encoded once and a
  document's tokens are those of its units in order.
* List flatten and parent indices give the token streams, a cumulative sum less the bytes before the
  document gives each token's end, and a full outer Acero hash join on (document, end) brings both
  streams together: a row for every end, a group end where both sides are present, and, after
  filling backwards, the pair of tokens that overlap there.
* ``Table.group_by`` counts the links of each document and each slice; Spark sums the slices' counts,
  finds the highest of each B id, and sends a slice the counts of its own distinct pairs only.

Null and empty texts, and texts whose joined token bytes of A or B differ from ``space + text`` (the
byte check is made on every distinct unit), have no tokens: zeros and an empty digest.  Repeated rows
count as often as they stand; null ids are kept; extra columns are ignored; an empty table gives an
empty result.  A slice holds at most SLICE_BYTES of text or one longer document.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ladle.llm.common import scratch_table
from ladle.llm.texts import slices, small_batches

SLICE_BYTES = 4 << 20
#: units handed to a tokenizer at once
ENCODE_AT_ONCE = 4096
# The pattern that byte-level pre-tokenising stands for, and its settings in a tokenizers file.
BYTE_LEVEL_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}


def default_tokenizers() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def after_printing(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character before each place (all above 0) is surely no white space: bytes up to 0x20 are
    not, nor any of the two- and three-byte characters among which Unicode's other white space lies."""
    last, second = raw[at - 1], raw[np.maximum(at - 2, 0)]
    return (last > 0x20) & ~((last >= 0x80) & np.isin(second, (0xC2, 0x80, 0x81, 0x9A)))


class Vocabulary:
    """Token ids of units, and the bytes and decimal form of each id.

    ``encode`` gives the ids of a text that starts with a space.
    """

    def __init__(self, token_bytes: list[bytes], encode: Callable[[str], list[int]]):
        self.encode = encode
        self.bytes = pa.array(token_bytes, pa.binary())
        self.size = pc.cast(pc.binary_length(self.bytes), pa.int64())
        self.shown = pc.cast(pa.array(range(len(token_bytes)), pa.int32()), pa.string())

    def ids(self, units: pa.StringArray) -> pa.ListArray:
        """One list of ids for each unit.

        Units that end in a printing character are encoded joined, as tokens end where they end; the
        few others (last units of texts), and runs whose tokens do not end so, one by one.
        """
        _, offsets, data = units.buffers()
        stops = np.frombuffer(offsets, np.int32)[units.offset + 1:units.offset + len(units) + 1]
        ends = after_printing(np.frombuffer(data, np.uint8), stops) if len(units) else np.zeros(0, bool)
        parts, sizes = [np.zeros(0, np.uint16)], np.zeros(len(units), np.int64)
        order = np.append(np.flatnonzero(ends), np.flatnonzero(~ends))
        for k in range(0, int(ends.sum()), ENCODE_AT_ONCE):
            at = order[k:min(k + ENCODE_AT_ONCE, int(ends.sum()))]
            run = units.take(pa.array(at))
            wanted = np.cumsum(pc.binary_length(run).to_numpy(zero_copy_only=False), dtype=np.int64)
            found = np.array(self.encode(run.buffers()[2][:wanted[-1]].to_pybytes().decode()), np.uint16)
            reached = np.cumsum(self.size.take(pa.array(found)).to_numpy())
            last = np.searchsorted(reached, wanted)
            if last[-1] < len(reached) and (reached[last] == wanted).all():
                parts.append(found)
                sizes[at] = np.diff(last, prepend=-1)
            else:
                self._one_by_one(units, at, parts, sizes)
        self._one_by_one(units, order[int(ends.sum()):], parts, sizes)
        stored = np.append(0, np.cumsum(sizes[order])).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(stored), pa.array(np.concatenate(parts)))
        return lists.take(pa.array(np.argsort(order)))

    def _one_by_one(self, units: pa.StringArray, at: np.ndarray, parts: list[np.ndarray], sizes: np.ndarray) -> None:
        for k, unit in zip(at.tolist(), units.take(pa.array(at)).to_pylist()):
            parts.append(np.array(self.encode(unit), np.uint16))
            sizes[k] = len(parts[-1])


def byte_level(path: str) -> Vocabulary:
    """A: a byte-level BPE in a tokenizers file.

    Where its merges stand in the order of their ids, tiktoken gives the same ids from the same entries
    in a third of the time.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True  # their strings in a text are ordinary text
    # byte-level alphabet: printable Latin-1 characters stand for their byte, the others follow from U+0100 on in order
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    alphabet = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
    entries = [bytes(alphabet[c] for c in tok.id_to_token(i)) for i in range(tok.get_vocab_size())]
    saved = json.loads(tok.to_str())
    special = {t["id"] for t in saved["added_tokens"]}
    merges = [m.split(" ") if isinstance(m, str) else m for m in saved["model"]["merges"]]
    numbers = tok.get_vocab()
    in_order = [numbers[x + y] for x, y in merges] == [i for i in range(256, len(entries)) if i not in special]
    if in_order and saved["normalizer"] is None and saved["pre_tokenizer"] == _BYTE_LEVEL:
        import tiktoken
        fast = tiktoken.Encoding("byte-level", pat_str=BYTE_LEVEL_PATTERN, special_tokens={},
                                 mergeable_ranks={e: i for i, e in enumerate(entries) if i not in special})
        return Vocabulary(entries, fast.encode_ordinary)
    return Vocabulary(entries, lambda text: tok.encode(text, add_special_tokens=False).ids)


def sentence_pieces(path: str) -> Vocabulary:
    """B: a SentencePiece model that puts a space before the text, with byte fallback."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    space = [model.piece_to_id("▁")]
    token_bytes = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
    # the model adds the space itself, but not to an empty text
    return Vocabulary(token_bytes, lambda text: model.encode(text[1:], num_threads=1) or space)


def cut_units(texts: pa.StringArray) -> tuple[pa.StringArray, np.ndarray]:
    """Units of ``space + text`` (empty texts have none) and the number of units before each text."""
    spaced = pc.if_else(pc.equal(pc.binary_length(texts), 0), "", pc.binary_join_element_wise(" ", texts, ""))
    _, ends, data = spaced.buffers()
    ends = np.frombuffer(ends, np.int32)[spaced.offset:spaced.offset + len(spaced) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = np.flatnonzero(raw[:ends[-1]] == 0x20)
    at = at[at > 0]
    cut = np.zeros(ends[-1] + 1, bool)
    cut[at[after_printing(raw, at)]] = True
    cut[ends[:-1]] = True
    cut[ends[-1]:] = False
    starts = np.flatnonzero(cut).astype(np.int32)
    offsets = np.append(starts, ends[-1]).astype(np.int32)
    units = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), data if data is not None else pa.py_buffer(b""))
    return units, np.searchsorted(starts, ends)


class Aligned(NamedTuple):
    """A slice's documents: token ids by document, links in order, and the tokens of each group."""

    n: int                 # documents
    a: pa.ListArray        # ids of A by group, groups in order
    b: pa.ListArray
    group_doc: np.ndarray  # document of each group
    link_doc: np.ndarray   # document of each link, ascending
    link_pair: np.ndarray  # A id * 65536 + B id


def stream(vocabulary: Vocabulary, ids: pa.ListArray, units: pa.Array, unit_doc: pa.Array, before: pa.Array, name: str) -> pa.Table:
    """One row for each token of the units: its id, and its document and end there as one key."""
    lists = ids.take(units)
    tokens = lists.flatten()
    doc = unit_doc.take(pc.list_parent_indices(lists))
    ends = pc.subtract(pc.cumulative_sum(vocabulary.size.take(tokens)), before.take(doc))
    return pa.table({"key": pc.add(pc.shift_left(doc, 32), ends), name: tokens})


class Aligner:
    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = byte_level(path_a), sentence_pieces(path_b)

    def align(self, texts: pa.StringArray) -> Aligned:
        n = len(texts)
        units, unit_ends = cut_units(pc.fill_null(texts, ""))
        found = pc.dictionary_encode(units)
        code, words = found.indices.to_numpy(zero_copy_only=False), found.dictionary
        a, b = self.a.ids(words), self.b.ids(words)
        # documents all of whose units give their own bytes back, by both tokenizers
        target = words.cast(pa.binary())
        same = [pc.equal(pc.binary_join(pa.ListArray.from_arrays(x.offsets, v.bytes.take(x.values)), b""), target).to_numpy(zero_copy_only=False)
                for v, x in ((self.a, a), (self.b, b))]
        doc = np.repeat(np.arange(n), np.diff(unit_ends))
        wrong = np.bincount(doc[~(same[0] & same[1])[code]], minlength=n) > 0
        kept = ~wrong[doc]
        size = pc.binary_length(words).to_numpy(zero_copy_only=False)[code[kept]]
        by_doc = np.bincount(doc[kept], size, minlength=n).astype(np.int64)
        before = pa.array(np.cumsum(by_doc) - by_doc)
        unit, unit_doc = pa.array(code[kept]), pa.array(doc[kept].astype(np.int64))
        left = stream(self.a, a, unit, unit_doc, before, "a")
        right = stream(self.b, b, unit, unit_doc, before, "b")
        met = left.join(right, "key", join_type="full outer", use_threads=False).combine_chunks().sort_by("key")
        ends_a, ends_b = (pc.is_valid(met[c]).to_numpy() for c in "ab")
        link_a, link_b = (pc.fill_null_backward(met[c]).to_numpy().astype(np.int64) for c in "ab")
        link_doc = met["key"].to_numpy() >> 32
        group_end = ends_a & ends_b
        group = np.cumsum(group_end) - group_end
        lists = []
        for side, at in ((left["a"], ends_a), (right["b"], ends_b)):
            ends = np.zeros(group_end.sum() + 1, np.int32)
            np.cumsum(np.bincount(group[at], minlength=len(ends) - 1), out=ends[1:])
            lists.append(pa.ListArray.from_arrays(pa.array(ends), side.combine_chunks() if isinstance(side, pa.ChunkedArray) else side))
        return Aligned(n, *lists, link_doc[group_end], link_doc, link_a << 16 | link_b)

    def digests(self, x: Aligned) -> list[str]:
        """SHA-256 of each document's groups as text (see the module's query); '' without tokens."""
        sides = [pc.binary_join(pa.ListArray.from_arrays(s.offsets, v.shown.take(s.values)), ",") for v, s in ((self.a, x.a), (self.b, x.b))]
        groups = np.bincount(x.group_doc, minlength=x.n)
        ends = np.append(0, np.cumsum(groups)).astype(np.int32)
        whole = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), pc.binary_join_element_wise(*sides, "|")), ";")
        return [hashlib.sha256(t.encode()).hexdigest() if n else "" for t, n in zip(whole.to_pylist(), groups.tolist())]


def token_counts(lists: pa.ListArray, group_doc: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(group_doc, np.diff(lists.offsets.to_numpy()), minlength=n).astype(np.int64)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def groups(docs: DataFrame, tokenizers: tuple[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, groups): each document's groups in order as structs of the A ids and the B ids."""
    paths = tokenizers or default_tokenizers()
    kind = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(*paths)
        for batch in batches:
            for at, n in slices(batch.column(1), size=SLICE_BYTES):
                part = batch.slice(at, n)
                x = aligner.align(part.column(1))
                both = pa.StructArray.from_arrays([s.cast(pa.list_(pa.int32())) for s in (x.a, x.b)], names=["a", "b"])
                ends = np.append(0, np.cumsum(np.bincount(x.group_doc, minlength=n))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(ends), both).cast(kind)], names=["doc_id", "groups"])
    return _texts(docs, id_col, text_col).mapInArrow(task, "doc_id bigint, groups array<struct<a: array<int>, b: array<int>>>")


#: one row for each slice: its documents, their distinct pairs (as places in ``pairs``) and how often each is linked
_SLICES = ("slice bigint, doc_id array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, n_links array<bigint>, "
           "groups_sha256 array<string>, pairs array<bigint>, pair_n array<bigint>, doc array<int>, at array<int>, times array<int>")


def slice_row(aligner: Aligner, ids: pa.Array, texts: pa.StringArray, number: int) -> pa.RecordBatch:
    x = aligner.align(texts)
    links = pa.table({"doc": x.link_doc, "pair": x.link_pair})
    by_doc = links.group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")])
    by_pair = by_doc.group_by("pair", use_threads=False).aggregate([("count_all", "sum")])
    at = pc.index_in(by_doc["pair"], by_pair["pair"])

    def one(values, kind: pa.DataType) -> pa.ListArray:
        values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else pa.array(values)
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values.cast(kind))
    big, small = pa.int64(), pa.int32()
    row = {"slice": pa.array([number], big), "doc_id": one(ids, big),
           "n_a": one(token_counts(x.a, x.group_doc, x.n), big), "n_b": one(token_counts(x.b, x.group_doc, x.n), big),
           "n_groups": one(np.bincount(x.group_doc, minlength=x.n), big), "n_links": one(np.bincount(x.link_doc, minlength=x.n), big),
           "groups_sha256": one(aligner.digests(x), pa.string()), "pairs": one(by_pair["pair"], big), "pair_n": one(by_pair["count_all_sum"], big),
           "doc": one(by_doc["doc"], small), "at": one(at, small), "times": one(by_doc["count_all"], small)}
    return pa.RecordBatch.from_arrays(list(row.values()), names=list(row))


def pair_counts(parts: DataFrame) -> DataFrame:
    """(pair, n, best): links of each id pair over all slices, and whether no pair of its B id has more."""
    total = parts.select(F.inline(F.arrays_zip("pairs", "pair_n"))).groupBy(F.col("pairs").alias("pair")).agg(F.sum("pair_n").alias("n"))
    highest = F.max("n").over(Window.partitionBy(F.col("pair").bitwiseAND(0xFFFF)))  # at most a row for each A id
    return total.select("pair", "n", (F.col("n") == highest).alias("best"))


def _scored(docs: pa.Table, counts: pa.Table) -> pa.Table:
    """The documents of one slice with the corpus-wide counts of its pairs."""
    def values(c: str) -> np.ndarray:
        return docs[c].combine_chunks().flatten().to_numpy()
    place = counts["place"].to_numpy()
    n, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
    n[place], best[place] = counts["n"].to_numpy(), counts["best"].to_numpy().astype(np.int64)
    doc, at, times = values("doc"), values("at"), values("times").astype(np.int64)
    keep = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
    out = {c: docs[c].combine_chunks().flatten() for c in keep}
    for name, of in (("n_best", best), ("count_sum", n)):
        total = np.zeros(len(out["doc_id"]), np.int64)
        np.add.at(total, doc, times * of[at])
        out[name] = pa.array(total)
    return pa.table(out | {"groups_sha256": docs["groups_sha256"].combine_chunks().flatten()})


def align(docs: DataFrame, tokenizers: tuple[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256."""
    paths = tokenizers or default_tokenizers()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(*paths)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at, n in slices(batch.column(1), size=SLICE_BYTES):
                yield slice_row(aligner, batch.column(0).slice(at, n), batch.column(1).slice(at, n), number)
                number += 1
    parts = scratch_table(_texts(docs, id_col, text_col).mapInArrow(task, _SLICES), "token-slices", large_rows=True)
    wanted = parts.select("slice", F.posexplode("pairs").alias("place", "pair"))
    found = wanted.join(pair_counts(parts), "pair").select("slice", "place", "n", "best")
    held = parts.drop("pairs", "pair_n").withColumnRenamed("slice", "home")
    return held.groupBy("home").cogroup(found.groupBy("slice")).applyInArrow(
        _scored, "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string")
