"""Similarity join of documents by the Jaccard similarity of their word n-grams, with prefix trees.

All n-grams have one global order: frequent ones last, by how often they occur,
the others by hash.  Two sets that are similar enough share an n-gram among the
first few of each (prefix filter), and the histograms of their hashes are close.  Both conditions
lose no pair; what they leave is gathered into clusters.  Each cluster, or each
pair of blocks of a large one, is joined in a task: the sets lie in a trie, and
a set walks down the tree once, sharing the overlap so far and leaving subtrees
in which too few n-grams remain.  Where many sets are nearly alike but not
similar enough, the tree spares little, and overlaps are counted instead.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rinkline.llm._bytes import mix, prefix_hash, slices, span_hash, word_bounds, word_hashes
from rinkline.llm._components import components, spanning
from rinkline.llm._shared import discard, if_small, stored, with_groups

#: Least number of buckets of the histogram that goes with a set, and n-grams for each bucket of a larger one.
SKETCH, BUCKET_GRAMS = 64, 20
#: N-grams that a task counts at once, and how often one occurs there to be noted; noted ones are frequent if they occur often enough in all.
WINDOW_GRAMS, NOTED, FREQUENT = 2_000_000, 3, 16
#: Frequent n-grams at most, which are broadcast: the most frequent ones.
HOT_GRAMS = 500_000
#: Sets that share an n-gram up to which their histograms are compared; beyond, they form a cluster at once.
CLOSE_GROUP = 2048
#: Sets that share an n-gram up to which all pairs are compared at once; beyond, a set that is linked already is compared with no other linked one.
ALL_PAIRS = 24
#: N-grams of a block of a cluster; a task joins two blocks.
BLOCK_GRAMS = 1_000_000
#: Sets of a block up to which it is joined by a trie; beyond, overlaps are counted.
TRIE_SETS = 32

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def shingle_sets(column: pa.Array, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct hashes of its word n-grams); A-Z count as a-z, a shorter text is one n-gram, none without words."""
    for first, end, data, offsets in slices(column):
        data = _LOWER[data]
        starts, ends, bounds = word_bounds(data, offsets)
        prefix = prefix_hash(word_hashes(data, starts, ends))
        size = np.diff(bounds)
        at = np.arange(len(starts))
        grams = span_hash(prefix, at[: max(0, len(starts) - n + 1)], at[: max(0, len(starts) - n + 1)] + n)
        for i in range(end - first):
            if size[i] >= n:
                yield first + i, np.unique(grams[bounds[i] : bounds[i + 1] - n + 1])
            elif size[i]:
                yield first + i, span_hash(prefix, bounds[i : i + 1], bounds[i + 1 : i + 2])
            else:
                yield first + i, grams[:0]


def needed(size: int | np.ndarray, percent: int):
    """The least overlap of a set of this size with any similar one."""
    return -(-size * percent // 100)


def histogram(spread: np.ndarray) -> bytes:
    """How many hashes fall into each of a power of two of buckets, 255 at most. Two neighbouring buckets are one of a histogram of half the size."""
    bits = max(SKETCH.bit_length() - 1, min(16, int(len(spread) // BUCKET_GRAMS).bit_length()))
    return np.minimum(np.bincount((spread >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits), 255).astype(np.uint8).tobytes()


def differences(sketches: list[bytes], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each pair of rows the sum of the differences of their histograms: the sets differ in no fewer places."""
    if not len(left):
        return np.zeros(0, dtype=np.int64)
    size = np.array([len(x) for x in sketches])
    out = np.zeros(len(left), dtype=np.int64)
    for a in np.unique(size[left]):
        for b in np.unique(size[right]):
            here = np.flatnonzero((size[left] == a) & (size[right] == b))
            step = max(1, (1 << 22) // max(a, b))
            for s in range(0, len(here), step):
                part, less = here[s : s + step], min(a, b)
                x, y = (
                    np.frombuffer(b"".join(sketches[i] for i in rows), dtype=np.uint8).reshape(len(part), less, -1).sum(axis=2, dtype=np.int32)
                    for rows in (left[part].tolist(), right[part].tolist())
                )
                out[part] = np.abs(x - y).sum(axis=1)
    return out


def coarse(sketches: list[bytes]) -> np.ndarray:
    """The histograms in SKETCH buckets, a row each: no two differ more than the histograms themselves."""
    size = np.array([len(x) for x in sketches])
    out = np.zeros((len(sketches), SKETCH), dtype=np.int32)
    for k in np.unique(size):
        rows = np.flatnonzero(size == k)
        step = max(1, (1 << 22) // int(k))
        for s in range(0, len(rows), step):
            part = rows[s : s + step]
            out[part] = np.frombuffer(b"".join(sketches[i] for i in part.tolist()), dtype=np.uint8).reshape(len(part), SKETCH, -1).sum(axis=2, dtype=np.int32)
    return out


_PROFILE = ["doc", "n", "a", "b", "sketch", "gram", "count"]


def _noted(sets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Rows for the n-grams that at least NOTED of the sets hold."""
    every = np.sort(np.concatenate(sets)) if sets else np.zeros(0, dtype=np.uint64)
    at = np.flatnonzero(np.append(True, every[1:] != every[:-1])) if len(every) else np.zeros(0, dtype=np.int64)
    count = np.diff(np.append(at, len(every)))
    often = count >= NOTED
    if often.any():
        gram, count = every[at[often]], count[often]
        gone = pa.nulls(len(gram), pa.int64())
        yield pa.RecordBatch.from_arrays([gone, gone, gone, gone, pa.nulls(len(gram), pa.binary()), pa.array(gram.view(np.int64)), pa.array(count)], _PROFILE)


def _profiles(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """(id, text) batches to one row for each document (doc, n, two fingerprints of the set, histogram), and for each n-gram that a window of WINDOW_GRAMS holds often (gram, count)."""
    window, held = [], 0
    for batch in batches:
        size, a, b, sketch = [], [], [], []
        for _, grams in shingle_sets(batch.column(1), n):
            size.append(len(grams))
            spread = mix(grams)
            a.append(int(np.bitwise_xor.reduce(spread)) if len(grams) else 0)
            b.append(int(np.add.reduce(mix(spread ^ np.uint64(0x5851F42D4C957F2D)))) if len(grams) else 0)
            sketch.append(histogram(spread))
            window.append(grams)
            held += len(grams)
            if held >= WINDOW_GRAMS:
                yield from _noted(window)
                window, held = [], 0
        k = len(size)
        none = pa.nulls(k, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(size, pa.int64()), pa.array(np.array(a, dtype=np.uint64).view(np.int64)), pa.array(np.array(b, dtype=np.uint64).view(np.int64)), pa.array(sketch, pa.binary()), none, none],
            _PROFILE,
        )
    yield from _noted(window)


def frequent_grams(profiles: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Frequent n-grams in order, and the power of two of how often each was noted: at most HOT_GRAMS, whatever the number of documents.

    Counts are of windows in which an n-gram is noted, so a lower bound; any order
    of the n-grams loses no pair, a better one leaves smaller groups.
    """
    counts = profiles.where("gram is not null").groupBy("gram").agg(F.sum("count").alias("count")).where(F.col("count") >= FREQUENT)
    counts = stored(counts.select("gram", F.floor(F.log2("count")).cast("int").alias("level")), "frequent")
    least, total = 64, 0
    for r in sorted(counts.groupBy("level").agg(F.count(F.lit(1)).alias("k")).collect(), key=lambda r: -r.level):
        total += r.k
        if total > HOT_GRAMS:
            break
        least = r.level
    found = counts.where(F.col("level") >= least).toArrow()
    discard(counts)
    gram = found["gram"].to_numpy().view(np.uint64)
    order = np.argsort(gram)
    return gram[order], found["level"].to_numpy()[order].astype(np.int8)


def _prefixes(batches: Iterator[pa.RecordBatch], n: int, percent: int, frequent) -> Iterator[pa.RecordBatch]:
    """(id, text, class) batches to the first n-grams of each set in the global order: gram, class."""
    hot, level = frequent.value
    for batch in batches:
        owner = batch.column(2).to_numpy(zero_copy_only=False)
        grams, whose = [], []
        for row, own in shingle_sets(batch.column(1), n):
            if not len(own):
                continue
            keep = len(own) - int(needed(len(own), percent)) + 1
            if len(hot):
                at = np.minimum(np.searchsorted(hot, own), len(hot) - 1)
                late = hot[at] == own
                own = np.concatenate([own[~late], own[late][np.argsort(level[at[late]], kind="stable")]])
            grams.append(own[:keep])
            whose.append(np.full(keep, owner[row], dtype=np.int64))
        if grams:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(grams).view(np.int64)), pa.array(np.concatenate(whose))], ["gram", "class"])


def most_differences(total: np.ndarray, percent: int) -> np.ndarray:
    """Two sets with so many n-grams together that are similar differ in no more places."""
    return total - 2 * -(-percent * total // (100 + percent))


def _links_of_group(size: np.ndarray, sketch: list[bytes], rough: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows that keep all rows connected which may be similar.

    From a row on, all that can be reached are taken out one after the other, each
    compared with those of a fitting size that were not reached yet: copies of one
    text are compared once each, not all with all.
    """
    left, reached = np.argsort(size, kind="stable"), []
    while len(left):
        if reached:
            row = reached.pop()
        else:
            row, left = int(left[0]), left[1:]
        low, high = np.searchsorted(size[left], (needed(size[row], percent), 100 * size[row] // percent + 1))
        near = left[low:high]
        most = most_differences(size[near] + size[row], percent)
        here = np.flatnonzero(np.abs(rough[near] - rough[row]).sum(axis=1) <= most)
        here = here[differences(sketch, np.full(len(here), row), near[here]) <= most[here]]
        if len(here):
            yield np.full(len(here), row), near[here]
            reached.extend(near[here].tolist())
            left = np.delete(left, low + here)


def _close_pairs(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows (gram, class, n, sketch) sorted by gram to edges that keep every pair of classes connected which may be similar."""
    rest: pa.Table | None = None

    def edges(t: pa.Table):
        gram, owner, size = t["gram"].to_numpy(), t["class"].to_numpy(), t["n"].to_numpy()
        sketch = t["sketch"].to_pylist()
        rough = coarse(sketch)
        at = np.flatnonzero(np.append(True, gram[1:] != gram[:-1]))
        k = np.diff(np.append(at, len(gram)))
        found = [(owner[:0], owner[:0])]
        for first, end in zip(at[k > ALL_PAIRS], (at + k)[k > ALL_PAIRS]):
            mine = owner[first:end]
            found += [(mine[a], mine[b]) for a, b in _links_of_group(size[first:end], sketch[first:end], rough[first:end], percent)]
        few, shift = np.flatnonzero(np.repeat(k <= ALL_PAIRS, k)), 1
        while shift < len(few):
            here = np.flatnonzero(gram[few[shift:]] == gram[few[:-shift]])
            if not len(here):
                break
            for part in np.array_split(here, -(-len(here) // 20_000)):
                left, right = few[part], few[part + shift]
                most = most_differences(size[left] + size[right], percent)
                near = np.flatnonzero(np.abs(size[left] - size[right]) <= most)
                near = near[np.abs(rough[left[near]] - rough[right[near]]).sum(axis=1) <= most[near]]
                near = near[differences(sketch, left[near], right[near]) <= most[near]]
                found.append((owner[left[near]], owner[right[near]]))
            shift += 1
        a, b = spanning(*map(np.concatenate, zip(*found)))
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        gram = table["gram"].to_numpy()
        done = int(np.searchsorted(gram, gram[-1])) if len(gram) else 0
        if done:
            yield from edges(table.slice(0, done))
        rest = table.slice(done)
    if rest is not None and len(rest):
        yield from edges(rest)


class _Node:
    __slots__ = ("grams", "children", "docs", "least", "most", "label")

    def __init__(self, grams: np.ndarray) -> None:
        self.grams, self.children, self.docs = grams, {}, []
        self.least, self.most, self.label = 1 << 60, 0, -1


class TrieJoin:
    """Sets in a trie, each joined with those before it.

    A node's label is a document such that all documents below are in its
    component, or None if there are several components below; a subtree whose
    documents are all linked with the set already needs no visit.
    """

    def __init__(self, percent: int) -> None:
        self.percent, self.root = percent, _Node(np.zeros(0, dtype=np.int64))
        self.parent: list[int] = []
        self.links: list[tuple[int, int]] = []

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = x = self.parent[self.parent[x]]
        return x

    def _settled(self, node: _Node, me: int) -> bool:
        return node.label is not None and node.label >= 0 and self.find(node.label) == self.find(me)

    def add(self, grams: np.ndarray) -> None:
        """grams: a set in the block's order, to join with the sets before and to keep."""
        me, size = len(self.parent), len(grams)
        self.parent.append(me)
        listed = grams.tolist()
        self._search(set(listed), listed, me)
        self._insert(grams, size, me)

    def _search(self, own: set, grams: list, me: int) -> None:
        size, stack = len(grams), []
        self._visit(self.root, 0, 0, own, size, me, stack)
        while stack:
            node, children, shared, depth = stack[-1]
            child = None if self._settled(node, me) else next(children, None)
            if child is None:
                stack.pop()
            elif not self._settled(child, me):
                self._visit(child, shared, depth, own, size, me, stack)

    def _visit(self, node: _Node, shared: int, depth: int, own: set, size: int, me: int, stack: list) -> None:
        p = self.percent
        # no similar set below misses more of its n-grams than this
        largest = min(node.most, 100 * size // p)
        misses = largest - -(-p * (size + largest) // (100 + p))
        for s in range(0, len(node.grams), 256):
            part = node.grams[s : s + 256].tolist()
            depth += len(part)
            shared += len(own.intersection(part))
            if depth - shared > misses:
                return
        for size_of, other in node.docs:
            if 100 * shared >= p * (size + size_of - shared) and self.find(other) != self.find(me):
                self.links.append((other, me))
                self.parent[self.find(other)] = self.find(me)
        # below, at most the remaining n-grams of either set can still be shared
        room = min(largest - depth, size - shared)
        lowest = max(node.least, int(needed(size, p)))
        if largest > depth and lowest <= largest and (100 + p) * (shared + room) >= p * (size + lowest):
            children = node.children
            if len(children) < 64:
                children = {k: children[k] for k in sorted(children, key=lambda k: k not in own)}  # the likely ones first
            stack.append((node, iter(children.values()), shared, depth))

    def _insert(self, grams: np.ndarray, size: int, me: int) -> None:
        node, at = self.root, 0
        self._touch(node, size, me)
        while True:
            if at == size:
                node.docs.append((size, me))
                return
            child = node.children.get(int(grams[at]))
            if child is None:
                child = _Node(grams[at:])
                node.children[int(grams[at])] = child
                self._touch(child, size, me)
                child.docs.append((size, me))
                return
            n = min(len(child.grams), size - at)
            differ = np.flatnonzero(child.grams[:n] != grams[at : at + n])
            same = int(differ[0]) if len(differ) else n
            if same < len(child.grams):
                lower = _Node(child.grams[same:])
                lower.children, lower.docs, lower.least, lower.most, lower.label = child.children, child.docs, child.least, child.most, child.label
                child.grams, child.children, child.docs = child.grams[:same], {int(lower.grams[0]): lower}, []
            self._touch(child, size, me)
            node, at = child, at + same

    def _touch(self, node: _Node, size: int, me: int) -> None:
        node.least, node.most = min(node.least, size), max(node.most, size)
        if node.label == -1:
            node.label = me
        elif node.label is not None and self.find(node.label) != self.find(me):
            node.label = None


class _Holders:
    """Which of some sets hold an n-gram; of n-grams that most of them hold, which do not."""

    def __init__(self, sets: list[np.ndarray], rows: np.ndarray, grams: int) -> None:
        self.rows, self.size = rows, np.array([len(sets[r]) for r in rows])
        flat, whose = np.concatenate([sets[r] for r in rows]), np.repeat(np.arange(len(rows)), self.size)
        order = np.argsort(flat, kind="stable")
        self.whose = whose[order]
        count = np.bincount(flat, minlength=grams)
        self.end = np.cumsum(count)
        self.begin = self.end - count
        self.most = 2 * count > len(rows)
        self.lack = {int(g): np.setdiff1d(np.arange(len(rows)), self.whose[self.begin[g] : self.end[g]], assume_unique=True) for g in np.flatnonzero(self.most)}

    def shared(self, grams: np.ndarray) -> np.ndarray:
        """The number of these n-grams that each set holds."""
        most = self.most[grams]
        few = grams[~most]
        out = np.full(len(self.rows), np.count_nonzero(most))
        parts = [self.whose[b:e] for b, e in zip(self.begin[few].tolist(), self.end[few].tolist()) if b < e]
        if parts:
            out += np.bincount(np.concatenate(parts), minlength=len(out))
        parts = [self.lack[g] for g in grams[most].tolist()]
        if parts:
            out -= np.bincount(np.concatenate(parts), minlength=len(out))
        return out


def counted_links(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links between similar sets, enough to keep every component.  Sets hold numbers from 0.

    From a set on, all that can be reached are taken out one after the other; each
    counts its overlap with all sets that were not reached yet at once.
    """
    links, reached = [], []
    grams = 1 + max((int(x.max()) for x in sets if len(x)), default=0)
    index = _Holders(sets, np.arange(len(sets)), grams)
    is_open = np.ones(len(sets), dtype=bool)
    left, start = len(sets), 0
    while left:
        if reached:
            row = reached.pop()
        else:
            while not is_open[start]:
                start += 1
            row, left = start, left - 1
            is_open[row] = False
        if 2 * left < len(index.rows):
            if not left:
                break
            index = _Holders(sets, np.flatnonzero(is_open), grams)
        shared = index.shared(sets[row])
        near = index.rows[(100 * shared >= percent * (len(sets[row]) + index.size - shared)) & is_open[index.rows]]
        is_open[near] = False
        left -= len(near)
        reached.extend(near.tolist())
        links.extend((row, other) for other in near.tolist())
    return links


def _join_block(table: pa.Table, n: int, percent: int) -> list[tuple[int, int]]:
    """Links between the documents of a block (all with all), or between those of side 0 and side 1, enough to keep every component."""
    sets: dict[int, np.ndarray] = {}
    for row, grams in shingle_sets(table["text"].combine_chunks() if isinstance(table["text"], pa.ChunkedArray) else table["text"], n):
        sets[row] = grams
    docs, side = table["class"].to_pylist(), table["side"].to_pylist()
    rows = sorted(sets, key=lambda r: (side[r], docs[r]))
    every, count = np.unique(np.concatenate([sets[r] for r in rows]), return_counts=True)
    rank = np.empty(len(every), dtype=np.int64)
    rank[np.lexsort((every, -count))] = np.arange(len(every))  # frequent first: similar sets share long paths
    ranked, order = [np.sort(rank[np.searchsorted(every, sets[r])]) for r in rows], [docs[r] for r in rows]
    if len(rows) > TRIE_SETS:
        return [(order[x], order[y]) for x, y in counted_links(ranked, percent)]
    join = TrieJoin(percent)
    for grams in ranked:
        join.add(grams)
    return [(order[x], order[y]) for x, y in join.links]


def _join_blocks(batches: Iterator[pa.RecordBatch], n: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Rows (job, side, class, text) sorted by job to links between similar sets of a job."""
    rest: pa.Table | None = None

    def jobs(t: pa.Table):
        job = t["job"].to_numpy()
        at = np.flatnonzero(np.append(True, job[1:] != job[:-1]))
        for s, e in zip(at, np.append(at[1:], len(job))):
            if e - s > 1 and (found := _join_block(t.slice(s, e - s), n, percent)):
                a, b = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        job = table["job"].to_numpy()
        same = job == job[-1] if len(job) else job
        done = len(table) - int(np.argmin(same[::-1])) if len(job) and not same.all() else 0
        if done:
            yield from jobs(table.slice(0, done))
        rest = table.slice(done)
    if rest is not None and len(rest):
        yield from jobs(rest)


def _linked(texts: DataFrame, jobs: DataFrame, n: int, percent: int) -> DataFrame:
    """Links found in jobs (class, job, side); texts has class and text. Repeated texts link with themselves, which says nothing."""
    rows = texts.join(if_small(stored(jobs, "jobs")), "class").select("job", "side", "class", "text").repartition("job").sortWithinPartitions("job")
    return stored(rows.mapInArrow(partial(_join_blocks, n=n, percent=percent), "a long, b long"), "links")


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: id, n_shingles, component_id.

    Two documents link if the Jaccard similarity of their sets of word n-grams
    is at least percent / 100; component_id is the smallest id that links
    reach.  A-Z count as a-z; words are runs of characters other than space and
    U+0009 to U+000D; a text with fewer than n words is one n-gram.

    * Null texts and texts without words have no n-grams and link with nothing.
    * Ids are integers; rows without an id get a null component and link with
      nothing; repeated rows give a row each; rows that share an id must share
      their text.
    * An empty table gives an empty result; further columns are ignored.

    Spark: equal sets count once.  About 15 % of a set's n-grams (at 85 %) are
    aggregated and joined; frequent n-grams, HOT_GRAMS at most, are broadcast
    with how often they occur, so that the most frequent stand last.  A
    cluster of more than BLOCK_GRAMS n-grams is split into blocks: all blocks meet
    the first, and only where that leaves several components do the others
    meet, so no task holds more than two blocks and no link is lost.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    profiles = stored(texts.mapInArrow(partial(_profiles, n=n), "doc long, n long, a long, b long, sketch binary, gram long, count long"), "profiles")
    frequent = spark.sparkContext.broadcast(frequent_grams(profiles))
    filled = profiles.where("n > 0 and doc is not null")
    classes = stored(filled.groupBy("n", "a", "b").agg(F.min("doc").alias("class"), F.count(F.lit(1)).alias("copies")), "classes")
    member = stored(with_groups(filled, classes, ["n", "a", "b"], "copies").select("doc", "class", "n", "sketch"), "members")
    heads = member.where("doc = class").select("class", "n", "sketch").distinct()

    own = texts.where("doc is not null").select("doc", "text", F.col("doc").alias("class"))
    grams = stored(own.mapInArrow(partial(_prefixes, n=n, percent=percent, frequent=frequent), "gram long, class long"), "prefixes")
    seen = stored(grams.groupBy("gram").agg(F.min("class").alias("x"), F.max("class").alias("y")).where("x < y").select("gram"), "grams")
    wanted = grams.join(seen, "gram", "left_semi").join(heads.select("class"), "class").select("gram", "class").distinct()
    wanted = stored(wanted, "shared")
    discard(grams, seen)
    size = wanted.groupBy("gram").agg(F.count(F.lit(1)).alias("k"), F.min("class").alias("center")).where("k > 1")
    sized = stored(wanted.join(size, "gram"), "sized")
    far = sized.where(F.col("k") > CLOSE_GROUP).select(F.col("class").alias("a"), F.col("center").alias("b")).distinct()
    close = sized.where(F.col("k") <= CLOSE_GROUP).join(heads, "class").select("gram", "class", "n", "sketch").repartition("gram").sortWithinPartitions("gram")
    near = close.mapInArrow(partial(_close_pairs, percent=percent), "a long, b long")
    clusters = stored(components(near.unionByName(far)).select(F.col("id").alias("class"), F.col("root").alias("cluster")), "clusters")

    blocks = clusters.join(heads, "class").groupBy("cluster").agg(F.ceil(F.sum("n") / BLOCK_GRAMS).cast("int").alias("blocks"))
    spread = stored(clusters.join(blocks, "cluster").withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")), "blocks")
    first = spread.select(
        "class",
        F.explode(F.when(F.col("blocks") == 1, F.array(F.lit(0))).when(F.col("block") == 0, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("block"))).alias("with"),
        "cluster", "block",
    )
    first = first.select("class", F.xxhash64("cluster", F.lit(0), "with").alias("job"), F.col("block").alias("side"))
    heads_text = texts.select(F.col("doc").alias("class"), "text")
    links = _linked(heads_text, first, n, percent)
    large = spread.where("blocks > 1")
    if not large.isEmpty():
        joined = large.join(components(links).select(F.col("id").alias("class"), "root"), "class", "left").withColumn("root", F.coalesce("root", "class"))
        torn = joined.groupBy("cluster").agg((F.min("root") < F.max("root")).alias("torn")).where("torn").select("cluster")
        again = joined.join(torn, "cluster").select(
            "class", "cluster", "block", F.explode(F.sequence(F.lit(1), F.col("blocks") - 1)).alias("other")
        )
        again = again.where("block > 0").select(
            "class", F.col("block").alias("side"),
            F.xxhash64("cluster", F.least("block", "other"), F.greatest("block", "other")).alias("job"),
        )
        links = links.unionByName(_linked(heads_text, again, n, percent))
    roots = stored(components(links).select(F.col("id").alias("class"), "root"), "roots")
    found = member.join(if_small(roots), "class", "left").select("doc", F.coalesce("root", "class").alias("component"))
    found = stored(found.distinct(), "components")
    discard(classes, member, wanted, sized, clusters, spread, roots)
    rows = profiles.where("n is not null").select("doc", "n")
    out = rows.join(found, "doc", "left")
    return out.select(F.col("doc").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "doc").alias("component_id"))
