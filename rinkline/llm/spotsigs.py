"""Document fingerprints by SpotSigs: chains of content words that follow common words.

A spot is a common word (an anchor) and the next content words after it; the
set of a text's spots, as hashes, is its fingerprint.  Fingerprints compare by
Jaccard similarity: pairs are parted by set length, and a pair is given up as
soon as the hashes not yet compared can't reach the least similarity asked for.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rinkline.llm._bytes import SLICE_BYTES, byte_symbols, mix, prefix_hash, slices, span_hash
from rinkline.operators.ordering import row_numbers

#: Common words of English, German, French and Spanish.
ANCHORS = (
    "the of and to a in is that it for was on with as be this by are at from an or not have has had were which their but they he she his her its we you will would can "
    "der die das und den von zu mit sich im des für auf ist nicht dem ein als eine auch es werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über "
    "de la le et les du que une est pour qui dans par au sur pas avec ce il ne se plus son sont ou mais aux "
    "el los del las por con no su para al lo como más pero sus ya este"
).split()
#: Content words of a chain.
CHAIN = 3
#: Words after an anchor at which, without another, the next word counts as one; so texts in any language have spots.
GAP = 4
#: Bytes of a word; a longer one counts as several.
WORD_BYTES = 24
#: Bytes of text of a range of documents, on average, and the most ranges (their first keys are broadcast).
RANGE_BYTES, MOST_RANGES = 4 << 20, 1 << 16

_U = np.uint64
_SOLID = np.ones(256, dtype=bool)
_SOLID[:128] = [chr(b).isalnum() for b in range(128)]
_START, _WHOLE = _U(0x5BD1E995), _U(0x2545F4914F6CDD1D)


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words: runs of letters and digits and of anything beyond ASCII, the long ones in parts."""
    solid = _SOLID[data]
    start = solid.copy()
    start[1:] &= ~solid[:-1]
    inner = offsets[:-1][offsets[:-1] < len(data)]
    start[inner] = solid[inner]
    end = solid.copy()
    end[:-1] &= start[1:] | ~solid[1:]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    parts = -(-(ends - starts) // WORD_BYTES)
    if (parts > 1).any():
        nth = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
        ends = np.minimum(np.repeat(starts, parts) + (nth + 1) * WORD_BYTES, np.repeat(ends, parts))
        starts = np.repeat(starts, parts) + nth * WORD_BYTES
    return starts, ends


def _hashed(words: list[str]) -> np.ndarray:
    data = [w.encode() for w in words]
    ends = np.cumsum([len(w) for w in data])
    return np.sort(span_hash(prefix_hash(byte_symbols(np.frombuffer(b"".join(data), dtype=np.uint8))), ends - [len(w) for w in data], ends))


_ANCHOR = _hashed(ANCHORS)


def spots(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The spots of all texts (32-bit hashes, rising within each text) and where each text's begin (one more entry than texts).

    A text without content words has one spot, its own hash; an empty text has none.
    """
    out, sizes = [], []
    for first, end, data, offsets in slices(pc.utf8_lower(texts.cast(pa.large_string())), SLICE_BYTES):
        rows = end - first
        starts, ends = _words(data, offsets)
        prefix = prefix_hash(byte_symbols(data))
        word = span_hash(prefix, starts, ends)
        bounds = np.searchsorted(starts, offsets)
        row = np.repeat(np.arange(rows), np.diff(bounds))
        anchor = _ANCHOR[np.minimum(np.searchsorted(_ANCHOR, word), len(_ANCHOR) - 1)] == word
        content = np.flatnonzero(~anchor)
        at = np.arange(len(word))
        since = at - np.maximum.accumulate(np.maximum(np.where(anchor, at, -1), bounds[:-1][row] - 1)) if len(word) else at
        spot = np.flatnonzero(anchor | (since > 0) & (since % GAP == 0))
        # the beginning of a text counts as an anchor too
        kind = np.concatenate([word[spot], np.full(rows, _START)])
        whose = np.concatenate([row[spot], np.arange(rows)])
        after = np.searchsorted(content, np.concatenate([spot + 1, bounds[:-1]]))
        until = np.searchsorted(content, bounds[1:])[whose]
        value = mix(kind)
        for k in range(CHAIN):
            there = after + k < until
            step = np.zeros(len(value), dtype=np.uint64)
            step[there] = word[content[(after + k)[there]]]
            value = mix(value * _U(3) + step)
        full = after < until
        bare = (np.bincount(whose[full], minlength=rows) == 0) & (np.diff(offsets) > 0)
        key = np.concatenate([
            (whose[full].astype(np.uint64) << _U(32)) | (value[full] >> _U(32)),
            (np.flatnonzero(bare).astype(np.uint64) << _U(32)) | (mix(span_hash(prefix, offsets[:-1][bare], offsets[1:][bare]) ^ _WHOLE) >> _U(32)),
        ])
        key = np.unique(key)
        out.append(key & _U(0xFFFFFFFF))
        sizes.append(np.bincount((key >> _U(32)).astype(np.int64), minlength=rows))
    every = np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)
    return every, np.concatenate([[0], np.cumsum(np.concatenate(sizes))]) if sizes else np.zeros(1, dtype=np.int64)


def jaccard(a: np.ndarray, a_at: np.ndarray, b: np.ndarray, b_at: np.ndarray, left: np.ndarray, right: np.ndarray, least: float = 0.0) -> np.ndarray:
    """The similarity of set left[i] of a and set right[i] of b for each i; 0 where it is below least. Two empty sets are alike.

    Pairs are worked on by the length of their larger set.  Sets are compared
    over quarters of the range of hashes, and pairs that can't reach least with
    all that is left are not looked at again.
    """
    n_a, n_b = np.diff(a_at)[left], np.diff(b_at)[right]
    out = np.where(np.maximum(n_a, n_b) == 0, 1.0, 0.0)
    floor = max(least, 1e-12)
    length = np.where(np.minimum(n_a, n_b) < floor * np.maximum(n_a, n_b), -1, np.frexp(np.maximum(n_a, n_b).astype(float))[1])
    quarters = [(np.searchsorted(_keyed(x, at), (np.arange(len(at) - 1)[:, None].astype(np.uint64) << _U(32)) + (np.arange(5, dtype=np.uint64) << _U(30))[None, :])) for x, at in ((a, a_at), (b, b_at))]
    for size in np.unique(length[(length > 0) & (n_a > 0) & (n_b > 0)]):
        pairs = np.flatnonzero(length == size)
        same = np.zeros(len(pairs), dtype=np.int64)
        for q in range(4):
            (s_a, e_a), (s_b, e_b) = ((cut[which[pairs], q], cut[which[pairs], q + 1]) for cut, which in zip(quarters, (left, right)))
            n, m = e_a - s_a, e_b - s_b
            x = (np.repeat(np.arange(len(pairs), dtype=np.uint64), n) << _U(32)) | a[_spread(s_a, n)]
            y = (np.repeat(np.arange(len(pairs), dtype=np.uint64), m) << _U(32)) | b[_spread(s_b, m)]
            if len(y):
                hit = y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x
                same += np.bincount((x[hit] >> _U(32)).astype(np.int64), minlength=len(pairs))
            most = same + np.minimum(a_at[left[pairs] + 1] - e_a, b_at[right[pairs] + 1] - e_b)
            total = n_a[pairs] + n_b[pairs]
            stays = most >= floor * (total - most)
            pairs, same = pairs[stays], same[stays]
        alike = same / (n_a[pairs] + n_b[pairs] - same)
        out[pairs] = np.where(alike >= least, alike, 0.0)
    return out


def _keyed(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (np.repeat(np.arange(len(at) - 1, dtype=np.uint64), np.diff(at)) << _U(32)) | x


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes - starts, sizes)


def written(values: np.ndarray, at: np.ndarray) -> list[str]:
    """Fingerprints as text: eight hex digits for each spot."""
    text, ends = values.astype(">u4").tobytes().hex(), (8 * at).tolist()
    return [text[s:e] for s, e in zip(ends, ends[1:])]


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values, at = spots(batch.column(1).cast(pa.large_string()).fill_null(""))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(at)), pa.array(written(values, at))], ["id", "spots", "fingerprint"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, the number of spots, fingerprint. Null texts are empty; no shuffle."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_fingerprints, f"id {kind}, spots long, fingerprint string").withColumnRenamed("id", id_col)


def _dealt(batches: Iterator[pa.RecordBatch], firsts) -> Iterator[pa.RecordBatch]:
    """(doc, hash, text) batches to rows of ranges, texts compressed. The first row of each range goes to the range before as well, as what follows that one (follows = 1)."""
    none, doc, key = firsts.value
    packed = zstandard.ZstdCompressor(level=1)
    order = np.rec.fromarrays([none, doc, key], names="none,doc,key")
    for batch in batches:
        known = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
        rows = np.rec.fromarrays([known.astype(np.int8), batch.column(0).fill_null(0).to_numpy(), batch.column(1).to_numpy()], names="none,doc,key")
        range_ = np.searchsorted(order, rows, side="right") - 1
        first = order[np.maximum(range_, 0)] == rows
        blobs = pa.array([packed.compress((t or "").encode()) for t in batch.column(2).to_pylist()], pa.binary())
        twice = np.concatenate([np.arange(len(rows)), np.flatnonzero(first)])
        ranges = np.concatenate([range_, (range_[first] - 1) % len(order)])
        follows = np.concatenate([np.zeros(len(rows), dtype=np.int32), np.ones(int(first.sum()), dtype=np.int32)])
        at = pa.array(twice)
        yield pa.RecordBatch.from_arrays([pa.array(ranges.astype(np.int64)), pa.array(follows), batch.column(0).take(at), batch.column(1).take(at), blobs.take(at)], ["range", "follows", "doc", "hash", "packed"])


def _edited(own: str, after: str) -> str:
    """own with the last half of its code points replaced by the first as many of what comes after."""
    half = len(own) // 2
    return own[: len(own) - half] + after[:half]


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ranges in order, each range's followed by what comes after it, to results of all rows but these."""
    unpacked = zstandard.ZstdDecompressor()
    docs, texts, size, now = [], [], 0, None

    def results() -> pa.RecordBatch:
        edited = [_edited(a, b) for a, b in zip(texts, texts[1:])]
        own, own_at = spots(pa.array(texts, pa.large_string()))
        other, other_at = spots(pa.array(edited, pa.large_string()))
        every = np.arange(len(edited))
        return pa.RecordBatch.from_arrays([
            pa.array(docs[:-1], pa.int64()), pa.array([len(t) for t in texts[:-1]], pa.int64()), pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
            pa.array(written(own, own_at[:-1])), pa.array(written(other, other_at)),
            pa.array(jaccard(own, own_at, other, other_at, every, every)), pa.array(jaccard(own, own_at, own, own_at, every, every + 1)),
        ], ["doc", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    ended = False
    for batch in batches:
        for range_, follows, doc, blob in zip(*(batch.column(c).to_pylist() for c in ("range", "follows", "doc", "packed"))):
            if range_ != now:
                docs, texts, size, now, ended = [], [], 0, range_, False
            if ended:
                continue  # equal rows begin the next range
            texts.append(unpacked.decompress(blob).decode())
            docs.append(doc)
            size += len(blob)
            ended = follows == 1
            if (ended or size >= SLICE_BYTES) and len(texts) > 1:
                yield results()
                docs, texts, size = docs[-1:], texts[-1:], 0


def edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has the last half of its code points (rounded down) replaced
    by the first as many, or all, of the next document's.  Documents follow each
    other by id, null ids first, those that share an id by a hash of their
    texts; the first comes after the last.  near_edited and near_next are the
    Jaccard similarities of the fingerprint with the edited text's and with the
    next document's.

    * Null texts are empty; an empty text has an empty fingerprint, and two empty ones are alike (1).
    * A table of one row follows itself; an empty table gives an empty result; further columns are ignored.
    * A task holds two texts and SLICE_BYTES more; a text is worked on whole.

    Spark: ids and hashes are ordered first, without texts, to find the first
    row of each range of about RANGE_BYTES of text.  Texts are then shuffled
    once, compressed, to their ranges; a range also gets the row that follows it.
    Rows of one id and text, however many, lie in one range and pass through a task one by one.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    keys = rows.select("doc", F.xxhash64("text").alias("hash"), F.octet_length("text").alias("size"))
    order = [F.col("doc").asc_nulls_first(), F.col("hash").asc()]
    numbered = row_numbers(keys, order)
    whole = numbered.agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes")).first()
    every = max(1, int(whole.rows * RANGE_BYTES / max(whole.bytes or 0, 1)), -(-whole.rows // MOST_RANGES)) if whole.rows else 1
    firsts = numbered.where((F.col("row_number") - 1) % every == 0).select("doc", "hash").distinct().orderBy(*order).collect()
    bounds = (np.array([r.doc is not None for r in firsts], dtype=np.int8), np.array([r.doc or 0 for r in firsts], dtype=np.int64), np.array([r.hash for r in firsts], dtype=np.int64))
    shared = docs.sparkSession.sparkContext.broadcast(bounds)
    dealt = rows.select("doc", F.xxhash64("text").alias("hash"), "text").mapInArrow(partial(_dealt, firsts=shared), "range long, follows int, doc long, hash long, packed binary")
    placed = dealt.repartition("range").sortWithinPartitions("range", "follows", *order)
    out = "doc long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return placed.select("range", "follows", "doc", "packed").mapInArrow(_compared, out).withColumnRenamed("doc", id_col)
