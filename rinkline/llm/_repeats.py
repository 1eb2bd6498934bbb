"""Windows that repeat across documents, found from anchors.

An anchor rule looks at the content of a window alone and picks one place in
it, so equal windows pick equal anchors.  Neighbouring windows with one anchor
form a group; a group is told apart by its key (the anchor's content) and its
context (the content of all its windows).  Only groups whose key occurs in two
documents go on, groups with equal contexts settle as one, and only where one
key has several contexts are windows compared one by one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rinkline.llm._bytes import covered, mix, span_hash
from rinkline.llm._shared import discard, stored

#: Bits for the place among the anchors of a slice; more than any text of an Arrow string has bytes.
_PLACE_BITS = 32
#: Contexts of one key up to which a task compares their windows; beyond, windows are rows that Spark groups.
HOT_CONTEXTS = 512


def pick_anchors(lo: np.ndarray, hi: np.ndarray, rank: np.ndarray, windows: np.ndarray, width: int, units: int) -> np.ndarray:
    """For each window start the anchor of lowest rank with lo >= start and hi <= start + width, the leftmost of equals; -1 if there is none.

    lo and hi must not fall; rank is a 64-bit word of which the last 32 bits are ignored.
    """
    if not len(lo):
        return np.full(len(windows), -1, dtype=np.int64)
    low = np.cumsum(np.bincount(np.clip(lo + 1, 0, units + 1), minlength=units + 2))
    high = np.cumsum(np.bincount(np.clip(hi, 0, units + 1), minlength=units + 2))
    first = low[windows]  # anchors with lo < start come before
    count = high[windows + width] - first
    place_mask = np.uint64((1 << _PLACE_BITS) - 1)
    packed = (rank & ~place_mask) | np.arange(len(rank), dtype=np.uint64)
    best = np.full(len(windows), -1, dtype=np.int64)
    step, table = 1, packed
    most = int(count.max(initial=0))
    while step <= most:
        here = (count >= step) & (count < 2 * step)
        a = first[here]
        got = np.minimum(table[a], table[a + count[here] - step])
        best[here] = (got & place_mask).astype(np.int64)
        wider = table.copy()
        wider[: max(0, len(table) - step)] = np.minimum(table[: max(0, len(table) - step)], table[step:])
        table, step = wider, 2 * step
    return best


def group_windows(
    windows: np.ndarray, anchor: np.ndarray, anchor_at: np.ndarray, prefix: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Groups of neighbouring windows with one anchor: first window start, number of windows, anchor (-1: none), context hash."""
    if not len(windows):
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none.astype(np.uint64)
    new = np.ones(len(windows), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (anchor[1:] < 0) | (windows[1:] != windows[:-1] + 1)
    at = np.flatnonzero(new)
    start, count, which = windows[at], np.diff(np.append(at, len(windows))), anchor[at]
    place = np.where(which >= 0, anchor_at[which] if len(anchor_at) else 0, start) - start
    context = span_hash(prefix, start, start + count - 1 + width)
    return start, count, which, mix(context ^ (place.astype(np.uint64) << np.uint64(32)) ^ count.astype(np.uint64))


def window_starts(bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows of the rows whose units lie between bounds, and the row of each."""
    sizes = np.maximum(0, np.diff(bounds) - width + 1)
    row = np.repeat(np.arange(len(sizes)), sizes)
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes) + bounds[:-1][row], row


#: What an anchor rule yields for a slice: unit bounds of the rows, hash prefix over the units, and lo, hi, rank, place and key columns of the anchors.
Rule = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]]


def groups_of(data: np.ndarray, offsets: np.ndarray, rule: Rule, width: int):
    """Groups of a slice: row, start within the row, count, keys, context, and what the windows need: prefix, bounds."""
    bounds, prefix, lo, hi, rank, place, keys = rule(data, offsets)
    windows, row = window_starts(bounds, width)
    anchor = pick_anchors(lo, hi, rank, windows, width, int(bounds[-1]))
    start, count, which, context = group_windows(windows, anchor, place, prefix, width)
    rows = np.searchsorted(bounds, start, side="right") - 1
    alone = span_hash(prefix, start, start + width)
    out = []
    for k in keys:
        key = k[which] if len(k) else np.zeros(len(which), dtype=np.uint64)
        out.append(np.where(which >= 0, key, alone))
    return rows, start - bounds[rows], count, out, context, prefix, bounds


def _as_long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64))


def group_rows(batches: Iterator[pa.RecordBatch], slices_of, rule: Rule, width: int, keys: list[str]) -> Iterator[pa.RecordBatch]:
    """(id, text) batches to group rows: keys, context, doc, start, count."""
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for first, end, data, offsets in slices_of(batch.column(1)):
            row, start, count, key, context, _, _ = groups_of(data, offsets, rule, width)
            if len(row):
                yield pa.RecordBatch.from_arrays(
                    [*(_as_long(k) for k in key), _as_long(context), pa.array(ids[first:end][row].astype(np.int64)), pa.array(start.astype(np.int32)), pa.array(count.astype(np.int32))],
                    [*keys, "context", "doc", "start", "count"],
                )


def window_rows(batches: Iterator[pa.RecordBatch], slices_of, rule: Rule, width: int, keys: list[str]) -> Iterator[pa.RecordBatch]:
    """(id, text, named groups) batches to a row for each named group: keys, hot, doc, start, hashes of its windows."""
    span = np.int64(1) << np.int64(40)
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        named = batch.column(2)
        for first, end, data, offsets in slices_of(batch.column(1)):
            row, start, count, key, _, prefix, bounds = groups_of(data, offsets, rule, width)
            part = named.slice(first, end - first)
            size = np.asarray(part.value_lengths().fill_null(0), dtype=np.int64)
            flat = part.flatten()
            if not len(flat):
                continue
            wanted = np.repeat(np.arange(end - first), size) * span + flat.field("start").to_numpy(zero_copy_only=False)
            order = np.argsort(wanted, kind="stable")
            wanted, hot = wanted[order], np.asarray(flat.field("hot"))[order]
            mine = row.astype(np.int64) * span + start
            at = np.minimum(np.searchsorted(wanted, mine), len(wanted) - 1)
            here = np.flatnonzero(wanted[at] == mine)
            row, start, count, hot = row[here], start[here], count[here], hot[at[here]]
            total = int(count.sum())
            ends = np.cumsum(count)
            begin = np.repeat(start + bounds[row] - (ends - count), count) + np.arange(total)
            hashes = span_hash(prefix, begin, begin + width)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), _as_long(hashes))
            yield pa.RecordBatch.from_arrays(
                [*(_as_long(k[here]) for k in key), pa.array(hot), pa.array(ids[first:end][row].astype(np.int64)), pa.array(start.astype(np.int32)), lists],
                [*keys, "hot", "doc", "start", "hashes"],
            )


def late_windows(batches: Iterator[pa.RecordBatch], keys: list[str], width: int) -> Iterator[pa.RecordBatch]:
    """Rows of window_rows, sorted by keys, to (doc, a, b): runs of windows that occur in a smaller document under the same key."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        columns = [table[k].to_numpy() for k in keys]
        same = np.logical_and.reduce([c == c[-1] for c in columns])
        done = len(table) - int(np.argmin(same[::-1])) if not same.all() else 0
        if done:
            yield from _late(table.slice(0, done), keys, width)
        rest = table.slice(done)
    if rest is not None and len(rest):
        yield from _late(rest, keys, width)


def _late(table: pa.Table, keys: list[str], width: int) -> Iterator[pa.RecordBatch]:
    lists = table["hashes"].combine_chunks()
    size = np.asarray(lists.value_lengths(), dtype=np.int64)
    own = np.zeros(len(table), dtype=np.uint64)
    for k in keys:
        own = mix(own ^ table[k].to_numpy().view(np.uint64))
    row = np.repeat(np.arange(len(table)), size)
    window = mix(lists.flatten().to_numpy().view(np.uint64) ^ own[row])
    doc = table["doc"].to_numpy()
    each = doc[row]
    order = np.lexsort((each, window))
    new = np.ones(len(order), dtype=bool)
    new[1:] = window[order][1:] != window[order][:-1]
    owner = np.empty(len(order), dtype=np.int64)
    owner[order] = each[order][np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    late = np.flatnonzero(each > owner)
    if not len(late):
        return
    begins = np.ones(len(late), dtype=bool)
    begins[1:] = (late[1:] != late[:-1] + 1) | (row[late[1:]] != row[late[:-1]])
    first = late[begins]
    last = late[np.append(np.flatnonzero(begins)[1:] - 1, len(late) - 1)]
    place = table["start"].to_numpy()[row] + np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    yield pa.RecordBatch.from_arrays(
        [pa.array(doc[row[first]]), pa.array(place[first].astype(np.int32)), pa.array((place[last] + width).astype(np.int32))], ["doc", "a", "b"]
    )


def shared_groups(groups: DataFrame, keys: list[str]) -> DataFrame:
    """The groups whose key occurs in more than one document, by one aggregation and one join that Spark can split where a key is frequent."""
    seen = groups.groupBy(*keys).agg(F.min("doc").alias("a"), F.max("doc").alias("b")).where("a < b").select(*keys)
    return groups.join(stored(seen, "keys"), keys, "left_semi")


def repeated_ranges(docs: DataFrame, shared: DataFrame, keys: list[str], width: int, windows: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """(doc, ranges): the [from, to) units of each document that windows of smaller documents cover.

    docs: columns doc and text.  shared: stored group rows whose key occurs in several documents.
    """
    contexts = shared.groupBy(*keys, "context").agg(F.min("doc").alias("owner"))
    contexts = stored(contexts, "contexts")
    many = contexts.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    hot = many.select(*keys, (F.col("n") > HOT_CONTEXTS).alias("hot"))
    owners = stored(contexts.join(hot, keys, "left").select(*keys, "context", "owner", "hot"), "owners")
    judged = shared.join(owners, [*keys, "context"]).where((F.col("doc") > F.col("owner")) | F.col("hot").isNotNull())
    judged = judged.select("doc", "start", "count", (F.col("doc") > F.col("owner")).alias("settled"), "hot")
    judged = stored(judged, "judged")
    discard(contexts, owners)
    names = judged.where("not settled").groupBy("doc").agg(F.collect_list(F.struct("start", "hot")).alias("named"))
    kinds = ", ".join(f"{k} long" for k in keys)
    rows = docs.join(names, "doc").select("doc", "text", "named").mapInArrow(windows, f"{kinds}, hot boolean, doc long, start int, hashes array<long>")
    rows = stored(rows, "windows")
    together = rows.where("not hot").drop("hot").repartition(*keys).sortWithinPartitions(*keys)
    spans = together.mapInArrow(partial(late_windows, keys=keys, width=width), "doc long, a int, b int")
    each = rows.where("hot").select(*keys, "doc", "start", F.posexplode("hashes").alias("at", "window"))
    least = each.groupBy(*keys, "window").agg(F.min("doc").alias("owner"))
    late = each.join(least, [*keys, "window"]).where("doc > owner")
    spans = spans.unionByName(late.select("doc", (F.col("start") + F.col("at")).alias("a"), (F.col("start") + F.col("at") + width).alias("b")))
    spans = spans.unionByName(judged.where("settled").select("doc", F.col("start").alias("a"), (F.col("start") + F.col("count") - 1 + width).alias("b")))
    spans = spans.select("doc", F.struct("a", "b").alias("r"))
    return spans.groupBy("doc").agg(F.collect_list("r").alias("ranges"))


def removed_units(ranges: pa.Array, sizes: np.ndarray) -> np.ndarray:
    """A mask over all units of the rows of a slice, whose unit counts are sizes: True where a range covers the unit."""
    n = np.asarray(ranges.value_lengths().fill_null(0), dtype=np.int64)
    base = np.cumsum(sizes) - sizes
    shift = np.repeat(base, n)
    flat = ranges.flatten()
    if not len(flat):
        return np.zeros(int(sizes.sum()), dtype=bool)
    a = flat.field("a").to_numpy(zero_copy_only=False).astype(np.int64) + shift
    b = flat.field("b").to_numpy(zero_copy_only=False).astype(np.int64) + shift
    return covered(a, b, int(sizes.sum()))
