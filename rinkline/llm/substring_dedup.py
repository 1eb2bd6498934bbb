"""Substring deduplication by recompression.

Two rounds of recompression turn the words of every document into symbols: a
round joins runs of one symbol, and pairs of a "left" and a "right" symbol,
where a coin that all tasks toss alike decides the side of a symbol.  A new
symbol is named by a hash of the words it spans.  Whether two symbols join
depends on these two only, so equal substrings get equal symbols inside, except
near their ends.  The symbols that occur in several documents reveal the
repeats; these are then compared window by window, by 64-bit hashes
(rinkline.llm._repeats).

Why no exchange names the symbols: a dictionary that numbers all pairs of a
round would serve to tell pairs apart and to toss their coins.  The hash of the
words spanned does both and is global: equal runs of words have equal names in
every task, unequal ones differ but for collisions of 64 bits, which the
comparison of windows removes.  Why two rounds: a symbol stands for a window
only if all words that fix it lie inside, and after two rounds these are some
three to five words beside as many at each end; a third round would leave many
windows of thirteen words without any symbol.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rinkline.llm import _repeats
from rinkline.llm._bytes import joined_words, mix, prefix_hash, slices, span_hash, word_bounds, word_hashes
from rinkline.llm._shared import discard, stored

ROUNDS = 2
_COIN = np.uint64(0xA24BAED4963EE407)


def recompress(words: np.ndarray, bounds: np.ndarray, prefix: np.ndarray, rounds: int = ROUNDS):
    """Symbols over the words of some documents: start, end, lo, hi, name.

    bounds: first word of each document and the end.  A symbol is what it is because of the words in [lo, hi)
    alone; at the ends of a document lo or hi lies outside it.
    """
    n = len(words)
    start, end, name = np.arange(n), np.arange(n) + 1, words
    lo, hi = start, end
    inner = bounds[1:-1]
    fresh = np.zeros(n + 1, dtype=bool)  # by word: begins a document
    fresh[bounds[bounds <= n]] = True
    doc_start = np.repeat(bounds[:-1], np.diff(bounds)) if n else inner
    doc_end = np.repeat(bounds[1:], np.diff(bounds)) if n else inner
    for level in range(rounds):
        if not len(start):
            break
        coin = mix(name ^ (_COIN + np.uint64(level))) >> np.uint64(63)
        first_of_doc = fresh[start]
        join = np.zeros(len(start), dtype=bool)
        join[1:] = ((name[1:] == name[:-1]) | ((coin[:-1] == 0) & (coin[1:] == 1))) & ~first_of_doc[1:]
        at = np.flatnonzero(~join)
        last = np.append(at[1:], len(start))  # one past the last symbol of each new one
        new_start, new_end = start[at], end[last - 1]
        edge_left, edge_right = first_of_doc[at], np.append(first_of_doc, True)[last]
        lo = np.where(edge_left, doc_start[new_start] - 1, lo[np.maximum(at - 1, 0)])
        hi = np.where(edge_right, doc_end[new_start] + 1, np.append(hi, 0)[last])
        start, end, name = new_start, new_end, span_hash(prefix, new_start, new_end)
    return start, end, lo, hi, name


def _rule(data: np.ndarray, offsets: np.ndarray):
    starts, ends, bounds = word_bounds(data, offsets)
    words = word_hashes(data, starts, ends)
    prefix = prefix_hash(words)
    start, end, lo, hi, name = recompress(words, bounds, prefix)
    long_first = (np.uint64(15) - np.minimum(end - start, 15).astype(np.uint64)) << np.uint64(60)
    whole = span_hash(prefix, np.clip(lo, 0, len(words)), np.clip(hi, 0, len(words)))  # all that makes it what it is
    return bounds, prefix, lo, hi, long_first | (mix(name) >> np.uint64(4)), start, [whole]


def _groups(batches, width: int):
    return _repeats.group_rows(batches, slices, _rule, width, ["key"])


def _windows(batches, width: int):
    return _repeats.window_rows(batches, slices, _rule, width, ["key"])


def _texts(batches):
    """(id, text, ranges) to id, n_words, n_removed, kept text, its SHA-256."""
    for batch in batches:
        for first, end, data, offsets in slices(batch.column(1)):
            starts, ends, bounds = word_bounds(data, offsets)
            gone = _repeats.removed_units(batch.column(2).slice(first, end - first), np.diff(bounds))
            kept = []
            for i in range(end - first):
                here = np.flatnonzero(~gone[bounds[i] : bounds[i + 1]]) + bounds[i]
                kept.append(joined_words(data, starts[here], ends[here]))
            lost = np.concatenate([[0], np.cumsum(gone)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(first, end - first), pa.array(np.diff(bounds)), pa.array(lost[bounds[1:]] - lost[bounds[:-1]]),
                    pa.array(kept, pa.binary()), pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()),
                ],
                ["doc", "n_words", "n_removed", "kept", "kept_sha256"],
            )


def _drop_kept(batches):
    for batch in _texts(batches):
        yield batch.select(["doc", "n_words", "n_removed", "kept_sha256"])


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 13, with_text: bool = True) -> DataFrame:
    """One row per row of docs: id, n_words, n_removed, kept_sha256, and with_text the kept words as `text`.

    Words are runs of characters other than space and U+0009 to U+000D.  Every
    word is removed that is covered by `width` consecutive words which also
    start in a document with a smaller id, judged on the input.

    * Null texts have no words; null ids are kept whole and remove nothing.
    * Ids are integers.  Repeated rows give a row each and remove nothing from
      one another; rows that share an id must share their text.
    * A document in which every word is removed stays, with an empty text.
    * An empty table gives an empty result; further columns are ignored.

    Spark: about one row for five words is aggregated and joined by symbol;
    what is carried further are symbols that occur in several documents.
    Aggregations combine before they shuffle and joins are split where a key is
    frequent.  Texts are shuffled by id, never by content.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    known = texts.where("doc is not null")
    groups = stored(known.mapInArrow(partial(_groups, width=width), "key long, context long, doc long, start int, count int"), "groups")
    shared = stored(_repeats.shared_groups(groups, ["key"]), "shared")
    discard(groups)
    ranges = _repeats.repeated_ranges(known, shared, ["key"], width, partial(_windows, width=width))
    ranges = stored(ranges, "ranges")
    discard(shared)
    judged = texts.join(ranges, "doc", "left").select("doc", "text", "ranges")
    if with_text:
        out = judged.mapInArrow(_texts, "doc long, n_words long, n_removed long, kept binary, kept_sha256 string")
        out = out.withColumn("kept", F.col("kept").cast("string")).withColumnRenamed("kept", text_col)
    else:
        out = judged.mapInArrow(_drop_kept, "doc long, n_words long, n_removed long, kept_sha256 string")
    return out.withColumnRenamed("doc", id_col)
