"""Alignment of two tokenizers' tokens over a corpus, with inverted bitmaps for pairs of ids.

Both tokenizers cut the same bytes.  Two tokens link where their bytes overlap;
offsets at which tokens of both end cut a text into groups.  For every pair of
ids a posting holds the documents of a container in which the pair is linked,
as a compressed bitmap, with bit planes for how often.  Bitmaps of the same
container are merged, popcounts are summed to the documents of a pair, planes
to its links, and the postings then carry a pair's figures back to their documents.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rinkline.llm._bitmaps import pack_planes, pack_sets, ranges, unpack_planes, unpack_sets
from rinkline.llm._bytes import slices
from rinkline.llm._shared import discard, if_small, stored
from rinkline.llm.packing import MAYBE_SPACE, Encoder

#: Documents of a container, and bytes of text at which it ends earlier.
SPAN, CONTAINER_BYTES = 1024, 4 << 20
#: Containers whose sums a task holds at once.
OPEN_CONTAINERS = 64
#: Distinct stretches of text whose links a task remembers.
MEMORY = 150_000
#: Bits of an id in a pair.
ID_BITS = 24
_MASK = (1 << ID_BITS) - 1

_DOC = "row long, doc long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
_POSTING = "pair long, container long, n long, planes long, links long, docs binary, times binary"
_FIELDS = [(x.split()[0], {"long": pa.int64(), "string": pa.string(), "binary": pa.large_binary()}[x.split()[1]]) for x in f"{_DOC}, {_POSTING}".split(", ")]


def byte_level_tokens(path: str) -> list[bytes]:
    """The bytes of every id of a byte-level BPE (a JSON file of `tokenizers`)."""
    signs = [*range(33, 127), *range(161, 173), *range(174, 256)]  # written as they are
    others = [b for b in range(256) if b not in signs]
    byte_of = {chr(b): b for b in signs} | {chr(256 + i): b for i, b in enumerate(others)}
    with open(path, encoding="utf-8") as f:
        known = json.load(f)
    special = {t["content"] for t in known.get("added_tokens", [])}
    out = [b""] * (1 + max([*known["model"]["vocab"].values(), *(t["id"] for t in known.get("added_tokens", []))]))
    for token, i in known["model"]["vocab"].items():
        out[i] = token.encode() if token in special else bytes(byte_of[c] for c in token)
    return out


def piece_tokens(model) -> list[bytes]:
    """The bytes of every id of a sentencepiece model: U+2581 is a space, <0xHH> the byte HH."""
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    return [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]


def _parts_at_blanks(path: str) -> bool:
    """Whether a sentencepiece model treats what follows a blank (after a character that is none) apart from what precedes it.

    So it is if no piece holds a blank after another character, for then no merge crosses such a place, and if texts
    are taken as they are but for the blank in front.
    """
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    n = model.normalizer_spec
    plain = not n.precompiled_charsmap and not n.normalization_rule_tsv and n.add_dummy_prefix and not n.remove_extra_whitespaces and n.escape_whitespaces
    kinds = {p.type for p in model.pieces}
    crossing = any("▁" in p.piece.lstrip("▁") for p in model.pieces)
    return plain and model.trainer_spec.model_type == proto.TrainerSpec.BPE and proto.ModelProto.SentencePiece.USER_DEFINED not in kinds and not crossing


class Aligner:
    """Encodes texts with both tokenizers and links their tokens, many at a time."""

    def __init__(self, a_path: str, b_path: str) -> None:
        import sentencepiece

        self.first = Encoder(a_path, plain=True)
        self.second = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a, self.b = byte_level_tokens(a_path), piece_tokens(self.second)
        self.a_size, self.b_size = (np.fromiter(map(len, t), dtype=np.int64, count=len(t)) for t in (self.a, self.b))
        texts = [[f"{i}{end}" for i in range(len(t)) for end in ends] for t, ends in ((self.a, ",|"), (self.b, ",;"))]
        self.written = texts[0] + texts[1]

    def _same(self, data: np.ndarray, offsets: np.ndarray, ids: np.ndarray, at: np.ndarray, tokens: list[bytes], size: np.ndarray) -> np.ndarray:
        """Which texts' tokens join to the texts' bytes."""
        ends = np.concatenate([[0], np.cumsum(size[ids])])
        joined = b"".join([tokens[i] for i in ids.tolist()])
        if joined == data.tobytes() and (ends[at] == offsets).all():
            return np.ones(len(offsets) - 1, dtype=bool)
        whole = data.tobytes()
        return np.array([joined[ends[s] : ends[e]] == whole[f:t] for s, e, f, t in zip(at[:-1], at[1:], offsets[:-1], offsets[1:])], dtype=bool)

    def __call__(self, data: np.ndarray, offsets: np.ndarray):
        """data, offsets: texts that begin with a blank, or are empty.

        Returns for each text whether its tokens join to it, the numbers of A's tokens, B's tokens, groups and links,
        and the groups as text, each with a semicolon after it; and the pairs of all links, text by text. A text whose
        tokens do not join to it has none.
        """
        count = len(offsets) - 1
        whole, bounds = data.tobytes(), offsets.tolist()
        a, a_at = self.first(data, offsets)
        a = a.astype(np.int64)
        listed = self.second.encode([whole[s + 1 : e].decode() for s, e in zip(bounds, bounds[1:])], num_threads=1)
        b_at = np.concatenate([[0], np.cumsum(np.fromiter(map(len, listed), dtype=np.int64, count=count))])
        b = np.fromiter(chain.from_iterable(listed), dtype=np.int64, count=int(b_at[-1]))
        good = self._same(data, offsets, a, a_at, self.a, self.a_size) & self._same(data, offsets, b, b_at, self.b, self.b_size)
        n_a, n_b = np.where(good, np.diff(a_at), 0), np.where(good, np.diff(b_at), 0)
        if not good.all():
            a, b = a[np.repeat(good, np.diff(a_at))], b[np.repeat(good, np.diff(b_at))]
        # each stretch between neighbouring ends lies in one token of A and one of B: a link
        mark = np.zeros(int(self.a_size[a].sum()) + 1, dtype=np.uint8)
        mark[np.cumsum(self.a_size[a])] = 1
        mark[np.cumsum(self.b_size[b])] += 2
        end = np.flatnonzero(mark)
        ends_a, ends_b = mark[end] & 1, mark[end] >> 1
        both = ends_a & ends_b
        at_a, at_b, group = (np.cumsum(x, dtype=np.int64) - x for x in (ends_a, ends_b, both))
        last = np.cumsum(np.where(good, np.diff(offsets), 0))
        until = np.searchsorted(end, last, side="right")
        n_links = np.diff(until, prepend=0)
        n_groups = np.diff(np.concatenate([[0], np.cumsum(both, dtype=np.int64)])[until], prepend=0)
        # A's tokens of a group, then B's
        through_a, through_b = (at_a + ends_a)[both == 1], (at_b + ends_b)[both == 1]
        code = np.empty(len(a) + len(b), dtype=np.int64)
        code[np.arange(len(a)) + np.concatenate([[0], through_b])[group[ends_a == 1]]] = 2 * a + both[ends_a == 1]
        if len(b):
            code[np.arange(len(b)) + through_a[group[ends_b == 1]]] = 2 * (len(self.a) + b) + both[ends_b == 1]
        stops = np.cumsum(n_a + n_b).tolist()
        written = [self.written[c] for c in code.tolist()]
        groups = ["".join(written[s:e]) for s, e in zip([0, *stops[:-1]], stops)]
        return good, n_a, n_b, n_groups, n_links, groups, (a[at_a] << ID_BITS) | b[at_b]


class CachedAligner:
    """An Aligner for rows of text: where both tokenizers part a text at blanks, what lies between is linked once for all its occurrences."""

    def __init__(self, a_path: str, b_path: str) -> None:
        self.align = Aligner(a_path, b_path)
        self.apart = self.align.first.quick is not None and _parts_at_blanks(b_path)
        self._clear()

    def _clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.numbers = np.zeros((5, 0), dtype=np.int64)  # good, n_a, n_b, n_groups, n_links
        self.begin, self.pairs = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.groups: list[str] = []

    def _learn(self, pieces: list[bytes]) -> None:
        bounds = np.concatenate([[0], np.cumsum(np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces)))])
        good, *numbers, groups, pairs = self.align(np.frombuffer(b"".join(pieces), dtype=np.uint8), bounds)
        n_links = numbers[-1]
        self.known.update(zip(pieces, range(len(self.groups), len(self.groups) + len(pieces))))
        self.begin = np.concatenate([self.begin, len(self.pairs) + np.cumsum(n_links) - n_links])
        self.numbers = np.concatenate([self.numbers, np.array([good.astype(np.int64), *numbers])], axis=1)
        self.pairs = np.concatenate([self.pairs, pairs])
        self.groups += groups

    def __call__(self, data: np.ndarray, offsets: np.ndarray):
        """data, offsets: each row's blank and text, nothing for a null or empty text.

        Returns for each row the numbers of A's tokens, B's tokens, groups and links and the groups as text, and for
        all links the row and the pair.
        """
        rows = len(offsets) - 1
        cut = np.zeros(len(data), dtype=bool)
        if self.apart and len(data) > 2:
            solid = data > 32
            cut[1:-1] = (data[1:-1] == 32) & solid[:-2] & solid[2:] & ~MAYBE_SPACE[data[2:]]
        cut[offsets[:-1][np.diff(offsets) > 0]] = True
        starts = np.flatnonzero(cut)
        bounds = np.append(starts, len(data)).astype(np.int64)
        column = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
        distinct = column.dictionary.to_pylist()
        new = [x for x in distinct if x not in self.known]
        if len(self.known) + len(new) > MEMORY:
            self._clear()
            new = distinct
        if new:
            self._learn(new)
        number = np.fromiter((self.known[x] for x in distinct), dtype=np.int64, count=len(distinct))
        piece = number[column.indices.to_numpy(zero_copy_only=False).astype(np.int64)]
        first = np.searchsorted(starts, offsets)
        row_of = np.repeat(np.arange(rows), np.diff(first))
        sums = np.zeros((5, rows), dtype=np.int64)
        for out, values in zip(sums, self.numbers):
            before = np.concatenate([[0], np.cumsum(values[piece])])
            out[:] = before[first[1:]] - before[first[:-1]]
        good = sums[0] == np.diff(first)
        sums[1:, ~good] = 0
        if not good.all():
            stays = good[row_of]
            piece, row_of = piece[stays], row_of[stays]
        listed, stops = [self.groups[i] for i in piece.tolist()], np.cumsum(np.where(good, np.diff(first), 0)).tolist()
        groups = ["".join(listed[s:e])[:-1] for s, e in zip([0, *stops[:-1]], stops)]
        n = self.numbers[4][piece]
        return *sums[1:], groups, np.repeat(row_of, n), self.pairs[ranges(self.begin[piece], n)]


@lru_cache(maxsize=1)
def _aligner(a_path: str, b_path: str) -> CachedAligner:
    """One for each worker: tasks that follow each other share what is known."""
    return CachedAligner(a_path, b_path)


def _batch(columns: dict, rows: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns[name] if name in columns else pa.nulls(rows, kind) for name, kind in _FIELDS], [name for name, _ in _FIELDS])


def _postings(parts: list[tuple[np.ndarray, np.ndarray]], container: int) -> pa.RecordBatch | None:
    """The merged postings of a container: from (pair, document) keys and how often each occurs."""
    key, times = (np.concatenate(x) for x in zip(*parts))
    if not len(key):
        return None
    order = np.argsort(key, kind="stable")
    key, times = key[order], times[order]
    pair = key >> 10
    first = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
    sizes = np.diff(np.append(first, len(key)))
    planes, count = pack_planes(times - 1, sizes)
    return _batch({
        "pair": pa.array(pair[first]), "container": pa.array(np.full(len(first), container, dtype=np.int64)), "n": pa.array(sizes), "planes": pa.array(count),
        "links": pa.array(np.add.reduceat(times, first)), "docs": pack_sets(key & (SPAN - 1), sizes, SPAN), "times": planes,
    }, len(first))


def _index(batches: Iterator[pa.RecordBatch], a_path: str, b_path: str) -> Iterator[pa.RecordBatch]:
    """(id, text) batches to a row for each document and one for each pair of a container."""
    align = _aligner(a_path, b_path)
    row = TaskContext.get().partitionId() << 33
    container, parts, size = row, [], 0
    for batch in batches:
        text = batch.column(1).cast(pa.large_string()).fill_null("")
        spaced = pc.if_else(pc.equal(text, ""), text, pc.binary_join_element_wise(pa.scalar("", pa.large_string()), text, pa.scalar(" ", pa.large_string())))
        for first, end, data, offsets in slices(spaced):
            begin = first
            while begin < end:
                if row - container >= SPAN or size >= CONTAINER_BYTES:
                    if parts and (found := _postings(parts, container)) is not None:
                        yield found
                    container, parts, size = row, [], 0
                stop = min(end, begin + SPAN - (row - container))
                at = offsets[begin - first : stop - first + 1]
                n_a, n_b, n_groups, n_links, groups, whose, pair = align(data[at[0] : at[-1]], at - at[0])
                yield _batch({
                    "row": pa.array(np.arange(row, row + stop - begin)), "doc": batch.column(0).slice(begin, stop - begin),
                    "n_a": pa.array(n_a), "n_b": pa.array(n_b), "n_groups": pa.array(n_groups), "n_links": pa.array(n_links),
                    "groups_sha256": pa.array([hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]),
                }, stop - begin)
                parts.append(np.unique((pair << 10) | (whose + row - container), return_counts=True))
                size += int(at[-1] - at[0])
                row += stop - begin
                begin = stop
    if parts and (found := _postings(parts, container)) is not None:
        yield found


def _returned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Postings with their pair's count and whether it is the best to the sums of their documents: row, count_sum, n_best."""
    open_: dict[int, np.ndarray] = {}

    def emitted() -> Iterator[pa.RecordBatch]:
        for container, sums in open_.items():
            held = np.flatnonzero(sums[2])
            yield pa.RecordBatch.from_arrays([pa.array(container + held), pa.array(sums[0][held]), pa.array(sums[1][held])], ["row", "count_sum", "n_best"])
        open_.clear()

    for batch in batches:
        container = batch.column("container").to_numpy()
        planes = batch.column("planes").to_numpy()
        docs, sizes = unpack_sets(batch.column("docs"), SPAN)
        times = unpack_planes(batch.column("times"), sizes, planes) + 1
        count = np.repeat(batch.column("count").to_numpy(), sizes) * times
        best = np.where(np.repeat(batch.column("best").to_numpy(zero_copy_only=False), sizes), times, 0)
        whose = np.repeat(container, sizes)
        for c in np.unique(container).tolist():
            here = whose == c
            if c not in open_:
                if len(open_) >= OPEN_CONTAINERS:
                    yield from emitted()
                open_[c] = np.zeros((3, SPAN), dtype=np.int64)
            for sums, value in zip(open_[c], (count[here], best[here], times[here])):
                np.add.at(sums, docs[here], value)
    yield from emitted()


def pair_counts(postings: DataFrame) -> DataFrame:
    """(pair, docs, count, best): for each pair of ids the documents and links that hold it, and whether no other pair of its B id has more links."""
    pairs = stored(postings.groupBy("pair").agg(F.sum("n").alias("docs"), F.sum("links").alias("count")), "pairs")
    b = F.col("pair").bitwiseAND(F.lit(_MASK))
    most = stored(pairs.groupBy(b.alias("b")).agg(F.max("count").alias("most")), "most")
    return pairs.join(if_small(most), b == F.col("b")).select("pair", "docs", "count", (F.col("count") == F.col("most")).alias("best"))


class Alignment:
    """What two tokenizers make of a corpus.

    documents: one row per row of docs (row, id, n_a, n_b, n_groups, n_links,
    groups_sha256).  pairs: (a, b, docs, count, best).  scores(): documents with
    n_best and count_sum.

    * Texts that are null or empty, and those whose tokens of either side do not
      join to a blank and the text, have no tokens: zeros and an empty groups_sha256.
    * Rows without an id and rows that share one are told apart by a number of
      their own; each counts.  An empty table gives empty results; further
      columns are ignored.
    * A text is worked on whole; a task holds some tens of bytes for each byte of its longest text.

    Spark: one pass encodes and writes documents and postings.  A pair of ids
    occurs at most once a container of SPAN documents, so the commonest pair has
    a thousandth as many postings as documents.  Counts combine before the
    shuffle.  Pairs meet their postings by a broadcast up to BROADCAST_ROWS pairs,
    beyond by a join on the pair; postings stay compressed until a task adds them up.
    """

    def __init__(self, docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> None:
        self.id_col = id_col
        rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
        table = stored(rows.mapInArrow(partial(_index, a_path=a_path, b_path=b_path), f"{_DOC}, {_POSTING}"), "alignment")
        self._documents = table.where("row is not null").select(*(x.split()[0] for x in _DOC.split(", ")))
        self.postings = table.where("pair is not null").select(*(x.split()[0] for x in _POSTING.split(", ")))
        self._pairs = stored(pair_counts(self.postings), "pair_counts")

    @property
    def documents(self) -> DataFrame:
        return self._documents.withColumnRenamed("doc", self.id_col)

    @property
    def pairs(self) -> DataFrame:
        pair = F.col("pair")
        return self._pairs.select(F.shiftright(pair, ID_BITS).alias("a"), pair.bitwiseAND(F.lit(_MASK)).alias("b"), "docs", "count", "best")

    def scores(self) -> DataFrame:
        """documents with n_best, the links whose pair is the best of its B id, and count_sum, the sum of the pairs' counts over the links."""
        known = self._pairs.select("pair", "count", "best")
        rows = self.postings.select("pair", "container", "planes", "docs", "times").join(if_small(known), "pair")
        rows = rows.select("container", "planes", "docs", "times", "count", "best")
        if known.count() > OPEN_CONTAINERS * SPAN:
            rows = rows.repartition("container").sortWithinPartitions("container")
        sums = rows.mapInArrow(_returned, "row long, count_sum long, n_best long").groupBy("row").agg(F.sum("count_sum").alias("count_sum"), F.sum("n_best").alias("n_best"))
        none = F.lit(0).cast("long")
        return self.documents.join(sums, "row", "left").withColumns({c: F.coalesce(c, none) for c in ("count_sum", "n_best")})
