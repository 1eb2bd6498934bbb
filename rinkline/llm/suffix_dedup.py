"""Substring deduplication over bytes with a logarithmic family of suffix arrays.

Documents come in batches of rising ids.  A batch gets a suffix array: its
sampled suffixes in the order of their first bytes, each with the document and
the place it lies at and a hash of all windows around it (its context).  The
array is merged with those of the levels that exist, which hold the suffixes of
smaller ids: a suffix that meets an equal context there lies in a long match,
and its windows are repeated; where only the first bytes match, the windows are
compared one by one.  The new array then becomes a level, and levels of equal
size merge, so after n batches there are about log2(n) of them.

Arrays are cut into buckets by the suffixes' first bytes, and a row of a level
is one bucket: Spark moves whole sorted arrays, and numpy merges them in tasks.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rinkline.llm import _repeats
from rinkline.llm._bytes import IS_BLANK, byte_symbols, covered, mix, prefix_hash, slices, span_hash
from rinkline.llm._shared import delete, discard, exists, if_small, new_path, shuffle_cleanup, stored

#: Bytes of a suffix that the arrays are sorted by.
SUFFIX_BYTES = 16
#: Text whose suffixes a task sorts at once; text for each bucket of the arrays.  Clusters with more memory a task may raise both.
CHUNK_BYTES, BUCKET_BYTES = 4 << 20, 8 << 20
#: Repeated groups that a task deals out by document at once.
DEALT_GROUPS = 1 << 19
#: A prefix that occurs in this share of the documents of the sample, and in LEAST of them, enters the arrays window by window.
HOT_SHARE, LEAST, SAMPLE_ONE_IN = 1 / 500, 40, 64
#: Contexts of one prefix up to which a task compares their windows; beyond, windows are rows that Spark groups.
MANY_CONTEXTS = 512

_TOP = np.uint64(1 << 63)
#: Where there are no blanks, suffixes start behind one of eight byte pairs.
_PAIRS = np.random.default_rng(11).random(65536) < 1 / 8
#: Kinds of rows: a batch's array, repeated groups, groups to be compared, and levels as level-<number>-<batches in it>-<highest id>.
_NEW, _LATE, _OPEN, _LEVEL = "new", "late", "open", "level-"
#: Buckets that share a file of a level, and files of a level at most.
FILE_BUCKETS, MOST_FILES = 4, 10_000
_ROWS = "bucket int, n int, prefix binary, context binary, sides binary, doc binary, start binary, count binary, kind string"

_slices = partial(slices, limit=1 << 19)


class Suffixes(NamedTuple):
    """Sampled suffixes: the first sixteen bytes as two numbers that sort like them, the hash of the windows around,
    hashes of the bytes before and behind, and which windows these are: document, first start, number."""

    a: np.ndarray
    b: np.ndarray
    context: np.ndarray
    sides: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    count: np.ndarray

    def take(self, at: np.ndarray) -> Suffixes:
        return Suffixes(*(x[at] for x in self))


_TYPES = [np.uint64, np.uint64, np.uint64, np.uint32, np.int64, np.uint32, np.uint16]


def _joined(parts: list[Suffixes]) -> Suffixes:
    return Suffixes(*(np.concatenate(x) for x in zip(*parts))) if parts else Suffixes(*(np.zeros(0, t) for t in _TYPES))


def _pack(x: np.ndarray) -> bytes:
    """Compressed, equal bytes of the numbers side by side."""
    return pa.compress(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T), codec="zstd", asbytes=True)


def _unpack(blob: bytes, n: int, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    raw = np.frombuffer(pa.decompress(blob, n * size, codec="zstd"), dtype=np.uint8)
    return np.ascontiguousarray(raw.reshape(size, n).T).view(kind).reshape(n)


def _row(kind: str, bucket: int, found: Suffixes) -> tuple:
    if kind == _LATE:  # only the places are needed
        none = np.zeros(len(found.a), dtype=np.uint64)
        found = found._replace(a=none, b=none, context=none, sides=none.astype(np.uint32))
    ab = np.stack([found.a.byteswap(), found.b.byteswap()], axis=1) if len(found.a) else np.zeros((0, 2), np.uint64)
    prefix = pa.compress(np.ascontiguousarray(ab), codec="zstd", asbytes=True)
    return bucket, len(found.a), prefix, *(_pack(x) for x in found[2:]), kind


def _suffixes(batch: pa.RecordBatch, row: int) -> Suffixes:
    n = batch.column(1)[row].as_py()
    ab = np.frombuffer(pa.decompress(batch.column(2)[row].as_py(), n * 16, codec="zstd"), dtype=">u8").astype(np.uint64).reshape(n, 2)
    rest = (_unpack(batch.column(3 + i)[row].as_py(), n, kind) for i, kind in enumerate(_TYPES[2:]))
    return Suffixes(ab[:, 0], ab[:, 1], *rest)


_SCHEMA = pa.schema([(name, {"int": pa.int32(), "binary": pa.binary(), "string": pa.string()}[kind]) for name, kind in map(str.split, _ROWS.split(", "))])


def _record(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)


def sampled_suffixes(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Where sampled suffixes start, and which of these are word starts.

    A suffix is sampled because of the byte before it and its first one: at
    word starts, and, where these lie too far apart for a window, behind
    certain byte pairs.
    """
    if len(data) < 2:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool)
    blank = IS_BLANK[data]
    word = np.zeros(len(data), dtype=bool)
    word[1:] = blank[:-1] & ~blank[1:]
    word[offsets[:-1][offsets[:-1] < len(data)]] = False
    at = np.flatnonzero(word)
    edges = np.unique(np.concatenate([at, offsets]))
    wide = np.flatnonzero(np.diff(edges) > width - SUFFIX_BYTES - 2)
    if len(wide):
        gap = covered(edges[wide], edges[wide + 1], len(data))
        pair = np.zeros(len(data), dtype=bool)
        pair[1:] = _PAIRS[data[:-1].astype(np.int32) << 8 | data[1:]]
        pair[offsets[:-1][offsets[:-1] < len(data)]] = False
        at = np.flatnonzero(word | (pair & gap))
    doc_end = offsets[np.searchsorted(offsets, at, side="right")]
    at = at[at + SUFFIX_BYTES <= doc_end]
    return at, word[at]


def _rule(data: np.ndarray, offsets: np.ndarray, width: int):
    at, word = sampled_suffixes(data, offsets, width)
    eight = np.lib.stride_tricks.sliding_window_view(data, 8) if len(data) >= 8 else np.zeros((0, 8), np.uint8)
    a, b = (np.ascontiguousarray(eight[at + k]).view(">u8").astype(np.uint64).reshape(-1) for k in (0, 8))
    rank = mix(a ^ mix(b)) >> np.uint64(1) | np.where(word, np.uint64(0), _TOP)
    return offsets, prefix_hash(byte_symbols(data)), at - 1, at + SUFFIX_BYTES, rank, at, [a, b, at.astype(np.uint64)]


def suffixes_of(data: np.ndarray, offsets: np.ndarray, ids: np.ndarray, width: int) -> tuple[Suffixes, np.ndarray, np.ndarray, np.ndarray]:
    """The sampled suffixes of a slice whose rows have these ids, one for each group of windows.

    Any repeated window reaches `half` bytes before its suffix or behind the
    suffix's prefix: `sides` are hashes of these, so that matches of the prefix
    alone are told apart.  Further: the prefix hashes and bounds of the slice, and the row of each suffix.
    """
    row, start, count, (a, b, at), context, prefix, bounds = _repeats.groups_of(data, offsets, partial(_rule, width=width), width)
    half = (width - SUFFIX_BYTES) // 2
    at = at.astype(np.int64)
    none = (a == b) & (a == at.astype(np.uint64))  # no suffix in the window, which then stands for itself
    left, right = np.maximum(bounds[row], at - half), np.minimum(bounds[row + 1], at + SUFFIX_BYTES + half)
    left, right = np.where(none, bounds[row], left), np.where(none, bounds[row], right)
    middle = np.where(none, bounds[row], at)
    behind = np.where(none, bounds[row], at + SUFFIX_BYTES)
    before = span_hash(prefix, left, middle) >> np.uint64(48)
    after = span_hash(prefix, behind, np.maximum(behind, right)) >> np.uint64(48)
    sides = (before << np.uint64(16) | after).astype(np.uint32)
    return Suffixes(a, b, context, sides, ids[row].astype(np.int64), start.astype(np.uint32), count.astype(np.uint16)), prefix, bounds, row


def _single_windows(found: Suffixes, hot: np.ndarray, prefix: np.ndarray, bounds: np.ndarray, row: np.ndarray, width: int) -> Suffixes:
    """The suffixes with those of hot prefixes replaced by an entry for each of their windows, told apart by its hash."""
    is_hot = np.isin(found.a ^ mix(found.b), hot)
    if not is_hot.any():
        return found
    cold, at = found.take(np.flatnonzero(~is_hot)), np.flatnonzero(is_hot)
    size = found.count[at].astype(np.int64)
    each = np.repeat(at, size)
    start = found.start[each].astype(np.int64) + np.arange(len(each)) - np.repeat(np.cumsum(size) - size, size)
    begin = start + bounds[row[each]]
    own = span_hash(prefix, begin, begin + width)
    single = Suffixes(found.a[each], own, mix(own ^ found.b[each]), np.zeros(len(each), np.uint32), found.doc[each], start.astype(np.uint32), np.ones(len(each), np.uint16))
    return _joined([cold, single])


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where runs of equal rows begin."""
    new = np.ones(len(columns[0]), dtype=bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(new)


def _spread(first: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    return np.repeat(values, np.diff(np.append(first, n)))


def _arrays(batches: Iterator[pa.RecordBatch], width: int, buckets: int, hot, chunk: int) -> Iterator[pa.RecordBatch]:
    """(id, text) to rows: the chunk's array in buckets, and the groups that a smaller document of the chunk holds too."""

    def cut(parts: list[Suffixes]) -> Iterator[pa.RecordBatch]:
        found = _joined(parts)
        if not len(found.a):
            return
        bucket = mix(found.a ^ mix(found.b))
        key = bucket & ~np.uint64(0xFFFFFFFF) | mix(found.context) >> np.uint64(32)
        found = found.take(np.argsort(key, kind="stable"))
        first = _runs(found.a, found.b, found.context)
        late = found.doc > _spread(first, np.minimum.reduceat(found.doc, first), len(found.doc))
        rows = [_row(_LATE, int(found.start[0]) % buckets, found.take(np.flatnonzero(late)))] if late.any() else []
        found = found.take(np.flatnonzero(~late))
        # the highest bits of the hash give the bucket
        bucket = ((mix(found.a ^ mix(found.b)) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        first = _runs(bucket)
        for low, high in zip(first, np.append(first[1:], len(bucket))):
            part = found.take(np.arange(low, high))
            rows.append(_row(_NEW, int(bucket[low]), part.take(np.argsort(part.a, kind="stable"))))
        yield _record(rows)

    parts, size = [], 0
    known = hot.value if hot is not None else np.zeros(0, np.uint64)
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for first, end, data, offsets in _slices(batch.column(1)):
            found, prefix, bounds, row = suffixes_of(data, offsets, ids[first:end], width)
            parts.append(_single_windows(found, known, prefix, bounds, row, width) if len(known) else found)
            size += len(data)
            if size >= chunk:
                yield from cut(parts)
                parts, size = [], 0
    yield from cut(parts)


def _in_order(found: Suffixes) -> np.ndarray:
    """The order by prefix, then context.  Sorted parts are merged by their first eight bytes; ties are sorted."""
    order = np.argsort(found.a, kind="stable")
    a = found.a[order]
    tied = np.zeros(len(a), dtype=bool)
    tied[1:] = a[1:] == a[:-1]
    tied[:-1] |= tied[1:]
    at = np.flatnonzero(tied)
    mine = order[at]
    order[at] = mine[np.lexsort((found.context[mine], found.b[mine], a[at]))]
    return order


def _merge(new: pa.Table, old: pa.Table, merged: frozenset[str], level: str, piece: int = 1 << 14) -> pa.Table:
    """The arrays of one bucket, of a batch and of all levels, to: the new level, repeated groups, and groups to be compared.

    level: the name of the new level, which takes in those of merged.  Rows have at most `piece` suffixes, in order.
    """
    out, parts, of, bucket = [], [], [], 0
    for batch in [*new.to_batches(), *old.to_batches()]:
        for i in range(len(batch)):
            row = tuple(c[i].as_py() for c in batch.columns)
            bucket, kind = row[0], row[-1]
            if kind == _LATE:
                out.append(row)
                continue
            parts.append(_suffixes(batch, i))
            of.append(np.full(len(parts[-1].a), 0 if kind == _NEW else 1 if kind in merged else 2, dtype=np.int8))
    found, of = _joined(parts), np.concatenate(of) if of else np.zeros(0, np.int8)  # of: 0 for the batch, 1 for levels that merge, 2 for others
    if not len(of):
        return pa.Table.from_batches([_record(out)] if out else [], _SCHEMA)
    order = _in_order(found)
    found, of = found.take(order), of[order]
    n = len(of)
    first = _runs(found.a, found.b, found.context)
    owner = np.minimum.reduceat(found.doc, first)
    late = (of == 0) & (found.doc > _spread(first, owner, n))
    # a prefix with several contexts, of which some are new: those go on that share the bytes before or behind with another document
    key = _runs(found.a, found.b)
    of_key = np.searchsorted(key, np.arange(n), side="right") - 1
    fresh = np.zeros(len(key), dtype=bool)
    fresh[of_key[(of == 0) & ~late]] = True
    contexts = np.bincount(of_key[first], minlength=len(key))
    at = np.flatnonzero((fresh & (contexts > 1))[of_key] & ~late)
    compare = np.zeros(n, dtype=bool)
    for side in (found.sides >> np.uint32(16), found.sides & np.uint32(0xFFFF)):
        by = at[np.lexsort((side[at], of_key[at]))]
        if len(by):
            run = _runs(of_key[by], side[by])
            doc = found.doc[by]
            several = np.minimum.reduceat(doc, run) < np.maximum.reduceat(doc, run)
            compare[by[_spread(run, several, len(by))]] = True
    parts = [(_LATE, np.flatnonzero(late)), (_OPEN, np.flatnonzero(compare))]
    # of equal contexts the one of the smallest document stays
    stays = np.flatnonzero(found.doc == _spread(first, owner, n))
    stays = stays[_runs(np.searchsorted(first, stays, side="right"))]
    stays = stays[of[stays] < 2]
    parts.append((level, stays))
    out += [_row(kind, bucket, found.take(at[i : i + piece])) for kind, at in parts for i in range(0, len(at), piece)]
    return pa.Table.from_batches([_record(out)] if out else [], _SCHEMA)


def _open_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of arrays to rows of their groups: prefix (hashed), doc, start, count."""
    for batch in batches:
        for i in range(len(batch)):
            found = _suffixes(batch, i)
            key = mix(found.a ^ mix(found.b)).view(np.int64)
            for at in range(0, len(key), 65536):
                part = slice(at, at + 65536)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[part]), pa.array(found.doc[part]), pa.array(found.start[part].astype(np.int32)), pa.array(found.count[part].astype(np.int32))],
                    ["prefix", "doc", "start", "count"],
                )


def _by_document(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """Rows of arrays to rows of the same kind, whose buckets are by document.

    Groups of many rows are dealt out together: a row of its own for each row and
    part would make as many as buckets by parts, the square of the text.
    """

    def dealt(found: Suffixes) -> Iterator[pa.RecordBatch]:
        part = (mix(found.doc.view(np.uint64)) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        first = _runs(part[order])
        rows = list(zip(first, np.append(first[1:], len(order))))
        for at in range(0, len(rows), 256):
            yield _record([_row(_LATE, int(part[order[a]]), found.take(order[a:b])) for a, b in rows[at : at + 256]])

    held, size = [], 0
    for batch in batches:
        for i in range(len(batch)):
            found = _suffixes(batch, i)
            none = np.zeros(len(found.a), dtype=np.uint8)  # all but the places is empty in these rows
            held.append(found._replace(a=none, b=none, context=none, sides=none))
            size += len(none)
            if size >= DEALT_GROUPS:
                yield from dealt(_joined(held))
                held, size = [], 0
    if size:
        yield from dealt(_joined(held))


def _late_ranges(rows: pa.Table, width: int) -> pa.Table:
    """Repeated groups of some documents to (doc, a, b), neighbouring ones as one range."""
    found = _joined([_suffixes(batch, i) for batch in rows.to_batches() for i in range(len(batch))])
    found = found.take(np.lexsort((found.start, found.doc)))
    start = found.start.astype(np.int64)
    end = start + found.count
    new = np.ones(len(start), dtype=bool)
    new[1:] = (found.doc[1:] != found.doc[:-1]) | (start[1:] > end[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    return pa.table({"doc": found.doc[first], "a": start[first].astype(np.int32), "b": (end[last] - 1 + width).astype(np.int32)})


def _windows(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """(id, text, groups) to a row for each group: prefix, many, doc, start, hashes of its windows."""
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for first, end, data, offsets in _slices(batch.column(1)):
            part = batch.column(2).slice(first, end - first)
            size = np.asarray(part.value_lengths().fill_null(0), dtype=np.int64)
            flat = part.flatten()
            if not len(flat):
                continue
            row = np.repeat(np.arange(end - first), size)
            start, count = (flat.field(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in ("start", "count"))
            prefix = prefix_hash(byte_symbols(data))
            for low in range(0, len(row), 16384):  # groups at once
                s, c, r = start[low : low + 16384], count[low : low + 16384], row[low : low + 16384]
                ends = np.cumsum(c)
                begin = np.repeat(s + offsets[r] - (ends - c), c) + np.arange(int(ends[-1]))
                hashes = span_hash(prefix, begin, begin + width).view(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(hashes))
                yield pa.RecordBatch.from_arrays(
                    [flat.field("prefix").slice(low, len(s)), flat.field("many").slice(low, len(s)), pa.array(ids[first:end][r].astype(np.int64)), pa.array(s.astype(np.int32)), lists],
                    ["prefix", "many", "doc", "start", "hashes"],
                )


def _hot_prefixes(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """(id, text) to the hashed prefix of each group, for the count of the sample."""
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for first, end, data, offsets in _slices(batch.column(1)):
            found, *_ = suffixes_of(data, offsets, ids[first:end], width)
            key = found.a ^ mix(found.b)
            pairs = np.unique(np.stack([key.view(np.int64), found.doc], axis=1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(np.ones(len(pairs), dtype=np.int64))], ["prefix", "n"])


#: Batches of a corpus where no size is given: enough for levels that merge twice.  Each is merged with all levels, so more of
#: them read the levels more often; the last of four merges all, which takes room for two indexes.  What a task holds is
#: bounded by chunks and buckets, whatever the size of a batch.
BATCHES = 4


class SuffixIndex:
    """The levels of a logarithmic family, kept as a table in a folder; batches of rising ids may be added at any time.

    The table is partitioned by the kind of rows and bucketed by the buckets
    of the arrays, so that a batch is merged with the levels where these lie
    and only the batch is shuffled.  An index that was made before is opened
    by its folder and the numbers it was made with.
    """

    def __init__(self, spark: SparkSession, path: str, width: int, buckets: int, hot: tuple[int, ...] = ()) -> None:
        self.spark, self.path, self.width, self.buckets = spark, path, width, buckets
        self.hot = spark.sparkContext.broadcast(np.array(sorted(hot), dtype=np.int64).view(np.uint64)) if len(hot) else None
        self.table = f"rinkline_index_{uuid.uuid4().hex}"
        known = exists(spark, path)
        spark.sql(
            f"CREATE TABLE {self.table} ({_ROWS}) USING parquet OPTIONS (compression 'uncompressed') PARTITIONED BY (kind) "
            f"CLUSTERED BY (bucket) INTO {min(-(-buckets // FILE_BUCKETS), MOST_FILES)} BUCKETS LOCATION '{path}'"
        )
        if known:
            spark.sql(f"ALTER TABLE {self.table} RECOVER PARTITIONS")
            self.forget(self._stale())

    def levels(self) -> list[tuple[str, int, int, int]]:
        """(name, number, batches in it, highest id), newest first."""
        stale = self._stale()
        return [x for x in self._written() if x[0] not in stale]

    def _stale(self) -> list[str]:
        """Levels that a newer and larger one took in, left by a run that was lost before it deleted them."""
        largest, found = 0, []
        for name, _, batches, _ in self._written():
            if batches < largest:
                found.append(name)
            largest = max(largest, batches)
        return found

    def _written(self) -> list[tuple[str, int, int, int]]:
        names = [r[0].removeprefix("kind=") for r in self.spark.sql(f"SHOW PARTITIONS {self.table}").collect()]
        found = [(x, *(int(k) for k in x.removeprefix(_LEVEL).split("-", 2))) for x in names if x.startswith(_LEVEL)]
        return sorted(found, key=lambda x: -x[1])

    def add(self, docs: DataFrame) -> None:
        """Adds docs (doc long, text string), whose ids must lie above those of all batches before.

        A batch's level and groups appear as one, when its files are committed; the
        levels that it took in go after that.  If the run is lost in between, they
        don't count and go later; the batch, recognised by its highest id, can be added again without effect.
        """
        low, high = docs.agg(F.min("doc"), F.max("doc")).first()
        if high is None:
            return
        self.forget(self._stale())
        known = self.levels()
        if known and high == known[0][3]:
            return
        if known and low <= known[0][3]:
            raise ValueError(f"ids must rise from batch to batch: {low} comes after {known[0][3]}")
        size, merged = 1, []
        for name, _, batches, _ in known:
            if batches == size:
                merged.append(name)
                size *= 2
        level, taken = f"{_LEVEL}{known[0][1] + 1 if known else 1}-{size}-{high}", frozenset(merged)

        def merge(new: pa.Table, old: pa.Table) -> pa.Table:
            return _merge(new, old, taken, level)

        arrays = docs.mapInArrow(partial(_arrays, width=self.width, buckets=self.buckets, hot=self.hot, chunk=CHUNK_BYTES), _ROWS)
        old = self.spark.table(self.table).where(F.col("kind").isin([name for name, *_ in known]))
        found = arrays.groupBy("bucket").cogroup(old.groupBy("bucket")).applyInArrow(merge, _ROWS)
        with shuffle_cleanup(self.spark):
            found.write.insertInto(self.table)
        self.forget(merged)

    def forget(self, names: list[str]) -> None:
        """Deletes levels: those that were merged, or all if no batch will follow."""
        for name in names:
            self.spark.sql(f"ALTER TABLE {self.table} DROP PARTITION (kind='{name}')")
            delete(self.spark, f"{self.path}/kind={name}")

    def rows(self, kind: str) -> DataFrame:
        """The rows of this kind of all batches."""
        return self.spark.table(self.table).where(F.col("kind") == kind)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE {self.table}")
        delete(self.spark, self.path)


def repeated_ranges(docs: DataFrame, index: SuffixIndex, width: int) -> DataFrame:
    """(doc, ranges): the [from, to) bytes of docs (doc, text) that windows of smaller documents cover, by the index of all of them."""
    open_groups = stored(index.rows(_OPEN).mapInArrow(_open_groups, "prefix long, doc long, start int, count int"), "open")
    many = open_groups.groupBy("prefix").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > MANY_CONTEXTS)
    many = stored(many.select("prefix", F.lit(True).alias("many")), "many")
    told = open_groups.join(if_small(many), "prefix", "left").select("doc", F.struct("start", "count", "prefix", F.coalesce("many", F.lit(False)).alias("many")).alias("group"))
    named = told.groupBy("doc").agg(F.collect_set("group").alias("groups"))
    rows = docs.join(named, "doc").select("doc", "text", "groups")
    rows = stored(rows.mapInArrow(partial(_windows, width=width), "prefix long, many boolean, doc long, start int, hashes array<long>"), "windows")
    together = rows.where("not many").drop("many").repartition("prefix").sortWithinPartitions("prefix")
    spans = together.mapInArrow(partial(_repeats.late_windows, keys=["prefix"], width=width), "doc long, a int, b int")
    each = rows.where("many").select("prefix", "doc", "start", F.posexplode("hashes").alias("at", "window"))
    least = each.groupBy("prefix", "window").agg(F.min("doc").alias("owner"))
    late = each.join(least, ["prefix", "window"]).where("doc > owner").withColumn("a", F.col("start") + F.col("at"))
    spans = spans.unionByName(late.select("doc", "a", (F.col("a") + width).alias("b")))

    def late_ranges(rows: pa.Table) -> pa.Table:
        return _late_ranges(rows, width)

    settled = index.rows(_LATE).mapInArrow(partial(_by_document, parts=index.buckets), _ROWS).groupBy("bucket").applyInArrow(late_ranges, "doc long, a int, b int")
    ranges = spans.unionByName(settled).groupBy("doc").agg(F.collect_list(F.struct("a", "b")).alias("ranges"))
    ranges = stored(ranges, "ranges")
    discard(open_groups, many, rows)
    return ranges


def _texts(batches):
    """(id, text, ranges) to id, n_bytes, n_removed, n_spans, kept bytes, their SHA-256."""
    for batch in batches:
        for first, end, data, offsets in _slices(batch.column(1)):
            sizes = np.diff(offsets)
            gone = _repeats.removed_units(batch.column(2).slice(first, end - first), sizes)
            rise = gone.copy()
            rise[1:] &= ~gone[:-1]
            inner = offsets[:-1][sizes > 0]
            rise[inner] = gone[inner]
            lost, runs = np.concatenate([[0], np.cumsum(gone)]), np.concatenate([[0], np.cumsum(rise)])
            kept = [data[s:e][~gone[s:e]].tobytes() for s, e in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(first, end - first), pa.array(sizes), pa.array(lost[offsets[1:]] - lost[offsets[:-1]]),
                    pa.array(runs[offsets[1:]] - runs[offsets[:-1]]), pa.array(kept, pa.binary()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()),
                ],
                ["doc", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"],
            )


def _drop_kept(batches):
    for batch in _texts(batches):
        yield batch.select(["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def hot_prefixes(docs: DataFrame, width: int) -> list[int]:
    """Prefixes (hashed) that a sample of one document in SAMPLE_ONE_IN shows to be frequent; how they are treated changes no result.

    At most 1 / HOT_SHARE times the suffixes of an average document come back.
    """
    sample = docs.where(F.pmod(F.xxhash64("doc"), F.lit(SAMPLE_ONE_IN)) == 0)
    seen = sample.mapInArrow(partial(_hot_prefixes, width=width), "prefix long, n long").groupBy("prefix").agg(F.sum("n").alias("n"))
    least = max(LEAST, int(sample.count() * HOT_SHARE))
    return [r.prefix for r in seen.where(F.col("n") >= least).select("prefix").collect()]


def batches_of(docs: DataFrame, batches: int) -> list[DataFrame]:
    """docs cut into batches of rising ids of about equal size."""
    cuts = docs.approxQuantile("doc", [i / batches for i in range(1, batches)], 0.01) if batches > 1 else []
    edges = [None, *sorted(set(cuts)), None]
    out = []
    for low, high in zip(edges[:-1], edges[1:]):
        part = docs if low is None else docs.where(F.col("doc") > int(low))
        out.append(part if high is None else part.where(F.col("doc") <= int(high)))
    return out


def suffix_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 50, batch_bytes: int | None = None, with_bytes: bool = True
) -> DataFrame:
    """One row per row of docs: id, n_bytes, n_removed, n_spans, kept_sha256, and with_bytes the kept bytes as `kept`.

    Every byte of the UTF-8 text is removed that is covered by `width` bytes
    which also start in a document with a smaller id, judged on the input.
    n_spans counts the maximal removed runs.  width is 20 to 1,000.

    Batches take batch_bytes of text each.  Without it there are BATCHES, since a
    batch is merged with all levels.

    * Null texts have no bytes; null ids are kept whole and remove nothing.
    * Ids are integers.  Repeated rows give a row each and remove nothing from
      one another; rows that share an id must share their text.
    * An empty table gives an empty result; further columns are ignored.
    * Windows and contexts are told apart by 64-bit hashes beside the suffix.

    Spark: a chunk of text becomes a sorted array, cut into buckets; equal
    contexts of a chunk are one entry, so a passage that a third of all
    documents hold meets in no task more often than there are chunks in a
    batch.  Prefixes that go on in many ways enter window by window, which
    spreads them over the buckets.  A text is read once for its suffixes, once
    where windows must be compared, and once for the result.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    known = texts.where("doc is not null")
    size = known.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    batches = -(-size // batch_bytes) if batch_bytes else BATCHES
    index = SuffixIndex(spark, new_path(spark, "index"), width, max(1, -(-size // BUCKET_BYTES)), tuple(hot_prefixes(known, width)))
    for batch in batches_of(known, max(1, batches)):
        index.add(batch)
    index.forget([name for name, *_ in index.levels()])
    ranges = repeated_ranges(known, index, width)
    index.drop()
    judged = texts.join(ranges, "doc", "left").select("doc", "text", "ranges")
    if with_bytes:
        out = judged.mapInArrow(_texts, "doc long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")
    else:
        out = judged.mapInArrow(_drop_kept, "doc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return out.withColumnRenamed("doc", id_col)
