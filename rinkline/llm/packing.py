"""Packing of tokenised documents into sequences by best-fit decreasing.

Documents longer than a sequence are first cut into full windows; the rests go,
longest first, each into the open sequence with the least room that still
holds it.  A segment tree over the remaining capacities finds that sequence.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rinkline.llm._bytes import slices
from rinkline.llm._shared import stored

#: The id that ends every document.
END_ID = 1
#: Distinct pieces of text whose ids a task remembers.
MEMORY = 700_000
#: Rests that are packed together, on average.
BUCKET_PIECES = 20_000


#: First bytes of the white space outside ASCII.
MAYBE_SPACE = np.zeros(256, dtype=bool)
MAYBE_SPACE[[0xC2, 0xE1, 0xE2, 0xE3]] = True


#: How the byte-level BPE splits a text before it merges (a fixed value).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[[*b",.;:!?|()"]] = True


class Encoder:
    """Token ids of many texts at once.

    A byte-level BPE treats a text piece by piece, and a blank that ends a run
    of white space always begins a piece.  So texts are cut at such blanks,
    every distinct piece is encoded once, and its ids are copied to where it
    occurs.  plain: the strings of special tokens count as any other text.
    """

    def __init__(self, path: str, plain: bool = False) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = [] if plain else added
        self.quick = self._ranked(added)
        self.known: dict[bytes, bytes] = {}

    def _ranked(self, added: list[bytes]):
        """The same vocabulary in a quicker library, if its ids are the ranks of its merges; else None.

        All merges are compared with the ids: the later of two merges must give the greater id, and every token of
        more than one byte must come from a merge.  The file's steps before the merges must be those that SPLIT stands
        for, and nothing else.  The probe below and the tests hold single pieces against the tokenizer.
        """
        import tiktoken

        known = json.loads(self.tokenizer.to_str())
        model, before = known["model"], known["pre_tokenizer"] or {}
        usual = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space", True) and known["normalizer"] is None
        odd = [k for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges") if model.get(k)]
        if model.get("type") != "BPE" or not usual or odd:
            return None
        merges = [x if isinstance(x, list) else x.split(" ") for x in model.get("merges", [])]

        signs = [*range(33, 127), *range(161, 173), *range(174, 256)]  # byte-level BPE writes these as they are
        others = [b for b in range(256) if b not in signs]
        byte_of = {chr(b): b for b in signs} | {chr(256 + i): b for i, b in enumerate(others)}
        vocabulary = {t: i for t, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if t.encode() not in added}
        if not all(c in byte_of for t in vocabulary for c in t):
            return None
        made = [vocabulary.get("".join(pair), -1) for pair in merges]
        if any(a >= b for a, b in zip(made, made[1:])) or set(made) != {i for t, i in vocabulary.items() if len(t) > 1}:
            return None
        ranks = {bytes(byte_of[c] for c in t): i for t, i in vocabulary.items()}
        quick = tiktoken.Encoding("pieces", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        probe = "It's 12 o'clock,  naïve façade -- Übergrößenträger\n\t x=3.14; ñandú"
        same = quick.encode_ordinary(probe) == self.tokenizer.encode(probe, add_special_tokens=False).ids
        return quick.encode_ordinary if same else None

    def encode(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece, as little-endian unsigned 32-bit numbers."""
        if self.quick is None:
            texts = [x.decode("utf-8", "replace") for x in pieces]
            return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        out = []
        for x in pieces:
            if any(t in x for t in self.special):
                ids = self.tokenizer.encode(x.decode("utf-8", "replace"), add_special_tokens=False).ids
            else:
                ids = self.quick(x.decode("utf-8", "replace"))
            out.append(array("I", ids).tobytes())
        return out

    def pieces(self, data: np.ndarray, offsets: np.ndarray) -> tuple[pa.DictionaryArray, np.ndarray]:
        solid = data > 32
        cut = np.zeros(len(data), dtype=bool)
        if len(data) > 2:
            cut[1:-1] = ((data[1:-1] == 32) | (data[1:-1] == 10)) & solid[:-2] & solid[2:] & ~MAYBE_SPACE[data[2:]]
        filled = np.diff(offsets) > 0
        cut[offsets[1:][filled] - 1] = False
        if not any(t in data.tobytes() for t in self.special):
            cut[1:] |= _MARK[data[1:]] & _ALNUM[data[:-1]]
        cut[offsets[:-1][filled]] = True
        starts = np.flatnonzero(cut)
        bounds = np.append(starts, len(data)).astype(np.int64)
        column = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data)])
        return column.dictionary_encode(), np.searchsorted(starts, offsets)

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows one after the other, and where each row begins (one more entry than rows)."""
        pieces, first = self.pieces(data, offsets)
        distinct = pieces.dictionary.to_pylist()
        new = [x for x in distinct if x not in self.known]
        if len(self.known) + len(new) > MEMORY:
            self.known.clear()
            new = distinct
        self.known.update(zip(new, self.encode(new)))
        ids = [self.known[x] for x in distinct]
        size = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) >> 2
        flat = np.frombuffer(b"".join(ids), dtype="<u4")
        which = pieces.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        sizes = size[which]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        begins = np.concatenate([[0], ends])
        source = np.repeat((np.cumsum(size) - size)[which] - (ends - sizes), sizes) + np.arange(total)
        return flat[source], begins[first]


def token_pieces(batches: Iterator[pa.RecordBatch], path: str, width: int) -> Iterator[pa.RecordBatch]:
    """(id, text) batches to pieces of at most width ids: doc, start, length, ids_crc32, doc_tokens, ids."""
    encoder = Encoder(path)
    for batch in batches:
        for first, end, data, offsets in slices(batch.column(1), 1 << 20):
            ids, at = encoder(data, offsets)
            rows: list[tuple[int, int, int, int, int]] = []
            blobs = []
            for i in range(end - first):
                whole = np.append(ids[at[i] : at[i + 1]], np.uint32(END_ID)).astype("<u4").tobytes()
                n = len(whole) // 4
                for start in range(0, n, width):
                    blob = whole[4 * start : 4 * (start + width)]
                    rows.append((first + i, start, len(blob) // 4, zlib.crc32(blob), n))
                    blobs.append(blob)
            index, start, length, crc, total = (np.array(x, dtype=np.int64) for x in zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(index)), pa.array(start), pa.array(length), pa.array(crc), pa.array(total), pa.array(blobs, pa.binary())],
                ["doc", "start", "length", "ids_crc32", "doc_tokens", "ids"],
            )


def _without_ids(batches: Iterator[pa.RecordBatch], path: str, width: int) -> Iterator[pa.RecordBatch]:
    for batch in token_pieces(batches, path, width):
        yield batch.drop_columns(["ids"])


class Rooms:
    """The open sequences by remaining capacity, with a segment tree over the capacities: for each the number of open sequences below a node."""

    def __init__(self, width: int) -> None:
        self.leaves = 1 << width.bit_length()
        self.tree = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(width + 1)]

    def _add(self, room: int, by: int) -> None:
        node = room + self.leaves
        while node:
            self.tree[node] += by
            node >>= 1

    def put(self, sequence: int, room: int) -> None:
        self.open[room].append(sequence)
        self._add(room, 1)

    def tightest(self, need: int) -> tuple[int, int] | None:
        """Takes out the open sequence with the least room of at least need: (sequence, room)."""
        node = need + self.leaves
        if not self.tree[node]:
            while node > 1 and (node & 1 or not self.tree[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.tree[2 * node] else 2 * node + 1
        room = node - self.leaves
        self._add(room, -1)
        return self.open[room].pop(), room


def best_fit_decreasing(lengths: list[int], width: int) -> tuple[list[int], list[int]]:
    """For lengths in falling order, none above width: the sequence and the offset of each."""
    rooms, sequences, offsets, used = Rooms(width), [], [], 0
    for n in lengths:
        found = rooms.tightest(n)
        sequence, room = found or (used, width)
        used += found is None
        sequences.append(sequence)
        offsets.append(width - room)
        if room > n:
            rooms.put(sequence, room - n)
    return sequences, offsets


def _pack(pieces: pa.Table, width: int, buckets: int) -> pa.Table:
    pieces = pieces.sort_by([("length", "descending"), ("doc", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")])
    sequences, offsets = best_fit_decreasing(pieces["length"].to_pylist(), width)
    ids = np.array(sequences, dtype=np.int64) * buckets + pieces["bucket"].to_numpy()
    return pieces.drop_columns(["bucket"]).append_column("sequence_id", pa.array(ids)).append_column("offset", pa.array(offsets, pa.int64()))


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 2048,
    bucket_pieces: int = BUCKET_PIECES,
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and with_ids its `ids` (little-endian unsigned 32-bit).

    A document is the ids of its text, special tokens of the text included,
    and END_ID.  Every id lies in exactly one piece, every piece in one
    sequence of at most width ids; offsets leave no gap.

    * Null texts count as empty and give a piece of one id.
    * Null or repeated ids are packed like others.
    * An empty table gives an empty result; further columns are ignored.

    Spark: texts are tokenised where they are read; pieces, without text, are
    written once with a number each, and scattered without their ids by a hash
    into buckets of about bucket_pieces, which are packed alone; pieces of
    repeated rows have other numbers, so no key gathers more than a bucket.  A
    bucket leaves few sequences unfilled.  The ids meet their places again by
    the number, in a join that streams them, so no task holds those of a bucket.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    schema = "doc long, start long, length long, ids_crc32 long, doc_tokens long"
    if with_ids:
        pieces = rows.mapInArrow(partial(token_pieces, path=tokenizer, width=width), schema + ", ids binary")
    else:
        pieces = rows.mapInArrow(partial(_without_ids, path=tokenizer, width=width), schema)
    pieces = stored(pieces.withColumn("nth", F.monotonically_increasing_id()), "pieces")
    buckets = max(1, -(-pieces.count() // bucket_pieces))
    bucket = F.pmod(F.xxhash64("doc", "start", "ids_crc32", "nth"), F.lit(buckets))

    def filled(table):
        return _pack(table, width, buckets)

    packed = (
        pieces.drop("ids")
        .withColumn("bucket", bucket)
        .groupBy("bucket")
        .applyInArrow(filled, schema + ", nth long, sequence_id long, offset long")
    )
    if with_ids:
        packed = pieces.select("nth", "ids").join(packed.hint("shuffle_hash"), "nth")
    columns = ["start", "length", "ids_crc32", "doc_tokens", *(["ids"] if with_ids else []), "sequence_id", "offset"]
    return packed.select(F.col("doc").alias(id_col), *columns)
