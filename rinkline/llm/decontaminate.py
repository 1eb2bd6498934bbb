"""Benchmark decontamination with CGK embeddings and bit-sampling LSH.

The CGK random walk turns a text into a longer one such that texts within few
edits get few differing places.  Segments of the benchmark items, of one short
size, are embedded, and so is the window at every byte of a document where an
item can lie; places of the embeddings are sampled as hash keys, repeatedly, and
where a window shares a key with a segment the item is verified by its exact
edit distance.  Walks are added until a target recall is reached.  Stretches
that hold too few q-grams of any item to lie within the allowed edits are left
out before, which loses nothing.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rinkline.llm._bytes import IS_BLANK, slices
from rinkline.llm._shared import ROW, numbered, stored, without

#: Allowed edits as a share of an item's length; length of the q-grams of the first filter.
EDITS, GRAM = 0.05, 12
#: Bytes of a segment, most segments of a short item, hash keys of a walk, and sampled places of a key.
SEGMENT, SEGMENTS, TABLES, PLACES = 24, 8, 8, 12
#: Walks are added until this share of items with all allowed edits is found, in TRIALS copies for each doubling of the length; more than the most are an error.
RECALL, TRIALS, MOST_WALKS = 0.99, 200, 64
#: A verification takes so many bytes more at both sides, so that neighbouring windows need none of their own.
MARGIN = 64
#: Items that are broadcast at once; with more, the documents are scanned once for each block.
BLOCK_ITEMS = 5000
#: Items are found by segments from this many bytes on, shorter ones by their parts.
SHORT = 40
_BITS = 22
#: Bytes of text that are worked on at once.
_slices = partial(slices, limit=1 << 18)
#: Stretches of this many bytes are looked at first, TILE_STEP apart.
TILE, TILE_STEP = 92, 32
MATCH = "doc long, item_id long, edits int, start long, length int"


def plain(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes with A-Z as a-z and each run of blanks as one space, their offsets, and where each byte was."""
    blank = IS_BLANK[data]
    keep = np.ones(len(data), dtype=bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    keep[offsets[:-1][offsets[:-1] < len(data)]] = True
    at = np.flatnonzero(keep)
    out = data[at].copy()
    out[blank[at]] = 32
    upper = (out >= 65) & (out <= 90)
    out[upper] += 32
    return out, np.searchsorted(at, offsets), at


def gram_places(data: np.ndarray, piece: int = 1 << 16) -> np.ndarray:
    """For each q-gram of the bytes its place in the bitmap."""
    out = np.empty(max(0, len(data) - GRAM + 1), dtype=np.int32)
    for low in range(0, len(out), piece):
        part = data[low : low + piece + GRAM - 1]
        eight = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(part, 8)).view(np.uint64).reshape(-1)
        grams = eight[: len(part) - GRAM + 1] * np.uint64(0x9E3779B97F4A7C15)
        grams ^= eight[GRAM - 8 :] * np.uint64(0xC2B2AE3D27D4EB4F)
        out[low : low + piece] = (grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _BITS)
    return out


class Items:
    """A block of benchmark items, ready to be matched."""

    def __init__(self, rows: list[tuple[int, str]], seed: int = 5) -> None:
        self.rows = []
        for item, text in rows:
            raw = np.frombuffer((text or "").encode("utf-8"), dtype=np.uint8)
            norm = plain(raw, np.array([0, len(raw)]))[0].tobytes().strip()
            if norm:
                self.rows.append((item, norm))
        self.bitmap = np.zeros(1 << _BITS, dtype=bool)
        rng = np.random.default_rng(seed)
        self.steps = [rng.integers(0, 2, (2 * SEGMENT, 256), dtype=np.int8) for _ in range(MOST_WALKS)]
        for step in self.steps:
            step[:, 0] = 0
        # most walks leave the window after about two sizes; later places would tell nothing
        self.places = np.sort((rng.random((MOST_WALKS, TABLES, PLACES)) * 1.7 * SEGMENT).astype(int))
        self.classes: list[tuple[int, int, int]] = []  # shortest, longest, q-grams that any match holds
        order = sorted(range(len(self.rows)), key=lambda i: len(self.rows[i][1]))
        long = [i for i in order if len(self.rows[i][1]) >= SHORT]
        self.short = [i for i in order if len(self.rows[i][1]) < SHORT]
        self.grams = {i: np.unique(gram_places(np.frombuffer(self.rows[i][1], dtype=np.uint8))) for i in long}
        self.walks = self.walks_for(long, rng)
        keys, owners, offsets = [np.zeros(0, dtype=np.uint64)], [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        for i in long:
            data = np.frombuffer(self.rows[i][1], dtype=np.uint8)
            at = self.segments(len(data))
            got = self.embed(data, at, self.walks)
            keys.append(got.reshape(-1))
            owners.append(np.full(got.size, i))
            offsets.append(np.repeat(at, got.shape[1]))
        known = np.concatenate(keys)
        by = np.argsort(known, kind="stable")
        self.known, self.owners, self.offsets = known[by], np.concatenate(owners)[by].astype(np.int32), np.concatenate(offsets)[by].astype(np.int32)
        self.shift = np.uint64(64 - min(26, max(10, (8 * len(known)).bit_length())))
        self.maybe = np.zeros(1 << (64 - int(self.shift)), dtype=bool)
        self.maybe[(self.known >> self.shift).astype(np.int64)] = True
        marks = [(np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.uint64))]
        while long:
            least = len(self.rows[long[0]][1])
            here = [i for i in long if len(self.rows[i][1]) <= least * 1.06]
            long = long[len(here) :]
            most = len(self.rows[here[-1]][1])
            self.classes.append((least, most, max(1, min(self.least_grams(len(self.rows[i][1])) for i in here))))
            for i in here:
                marks.append((self.grams[i], np.full(len(self.grams[i]), 1 << (len(self.classes) - 1) % 64, dtype=np.uint64)))
        # places of the q-grams, and a bit for each class of lengths
        places, bits = (np.concatenate(x) for x in zip(*marks))
        self.gram_at, which = np.unique(places, return_inverse=True)
        self.gram_bits = np.zeros(len(self.gram_at), dtype=np.uint64)
        np.bitwise_or.at(self.gram_bits, which, bits)
        self.bitmap[self.gram_at] = True
        # a stretch as long as a match of a class consists of so many tiles; the fullest holds at least this
        self.tile_grams = min((-(-g // -(-self.span(most) // TILE)) for _, most, g in self.classes), default=1)

    @staticmethod
    def segments(length: int) -> np.ndarray:
        """Where the segments of an item of this length begin: they cover it, those of short items more than once."""
        n = max(-(-length // SEGMENT), min(SEGMENTS, 1 + (length - SEGMENT) // 4))
        return np.unique(np.linspace(0, length - SEGMENT, n).astype(np.int64))

    def walks_for(self, long: list[int], rng: np.random.Generator) -> int:
        """The fewest walks by which RECALL of copies with all allowed edits, inserts, deletes and substitutions alike, share a key with their item."""
        need, groups = 1, defaultdict(list)
        for i in long:
            groups[min(4, (len(self.rows[i][1]) // SHORT).bit_length())].append(i)
        for group in groups.values():
            first = np.full(TRIALS, MOST_WALKS + 1)
            for t in range(TRIALS):
                text = np.frombuffer(self.rows[group[t % len(group)]][1], dtype=np.uint8)[: 16 * SHORT]
                copy = edited(text, int(EDITS * len(text)), rng)
                at, own = self.segments(len(text)), np.arange(max(1, len(copy) - SEGMENT + 1))
                for walk in range(MOST_WALKS):
                    if np.isin(self.embed(copy, own, walk + 1, walk), self.embed(text, at, walk + 1, walk)).any():
                        first[t] = walk + 1
                        break
            need = max(need, int(np.sort(first)[int(np.ceil(RECALL * TRIALS)) - 1]))
        if need > MOST_WALKS:
            raise ValueError(f"{MOST_WALKS} walks do not find {RECALL:.0%} of edited copies")
        return need

    @staticmethod
    def span(longest: int) -> int:
        return int(longest * (1 + EDITS)) + 1

    @staticmethod
    def least_grams(length: int) -> int:
        return length - GRAM + 1 - int(EDITS * length) * GRAM

    def embed(self, data: np.ndarray, starts: np.ndarray, walks: int, first: int = 0) -> np.ndarray:
        """The hash keys of the windows of SEGMENT bytes at starts, by the walks from the first on: one row each."""
        out = []
        # a walk that has left its window stays on the zero behind it
        padded = np.concatenate([data, np.zeros(SEGMENT + 1, dtype=np.uint8)])
        windows = padded[starts[:, None] + np.arange(SEGMENT + 1)]
        windows[:, SEGMENT] = 0
        windows = windows.reshape(-1)
        for walk in range(first, walks):
            places = self.places[walk]
            seen = np.empty((int(places.max()) + 1, len(starts)), dtype=np.uint8)
            at = np.arange(len(starts), dtype=np.int32) * np.int32(SEGMENT + 1)
            step = self.steps[walk]
            for j in range(len(seen)):
                windows.take(at, out=seen[j])
                at += step[j].take(seen[j])
            for t, row in enumerate(places):
                key = np.full(len(starts), walk * TABLES + t + 1, dtype=np.uint64)
                for p in row:
                    key = (key ^ seen[p]) * np.uint64(0x100000001B3)
                    key ^= key >> np.uint64(29)
                out.append(key * np.uint64(0x9E3779B97F4A7C15))
        return np.stack(out, axis=1)

    def candidates(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Rows (start, item, offset of the segment in the item), each once, for windows that share a key with a segment."""
        keys = self.embed(data, starts, self.walks)
        window, table = np.nonzero(self.maybe[(keys >> self.shift).astype(np.int64)])
        keys = keys[window, table]
        low, high = np.searchsorted(self.known, keys), np.searchsorted(self.known, keys, side="right")
        sizes = high - low
        at = np.repeat(low - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
        return np.unique(np.stack([np.repeat(starts[window], sizes), self.owners[at], self.offsets[at]], axis=1), axis=0)


def edited(text: np.ndarray, edits: int, rng: np.random.Generator) -> np.ndarray:
    """A copy with so many inserts, deletes and substitutions, by bytes of the text itself, spread evenly, which is hardest to find."""
    out, phase = text.tolist(), rng.random()
    for k in reversed(range(edits)):
        at, kind, byte = int((k + phase) * len(text) / edits), int(rng.integers(3)), int(text[rng.integers(len(text))])
        out[at : at + (kind != 0)] = [byte] if kind < 2 else []
    return np.array(out, dtype=np.uint8)


def best_match(pattern: bytes, text: bytes, most: int) -> tuple[int, int] | None:
    """(edits, end) of the best occurrence of pattern in text with at most `most` edits, the first of equals (bit-parallel dynamic programming)."""
    m = len(pattern)
    peq: dict[int, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        peq[c] |= 1 << i
    mask, high = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best = mask, 0, m, None
    for j, c in enumerate(text):
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph, mh = mv | (~(xh | pv) & mask), pv & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
        ph, mh = (ph << 1) & mask, (mh << 1) & mask  # a match may begin anywhere
        pv, mv = mh | (~(xv | ph) & mask), ph & xv
        if score <= most and (best is None or score < best[0]):
            best = (score, j + 1)
    return best


def short_match(item: bytes, edits: int, text: bytes) -> tuple[int, int] | None:
    """(edits, end) of the best occurrence of a short item in text, both with blanks around them, with at most so many edits.

    Of edits + 1 parts of the item one occurs unchanged, so matches lie around the occurrences of the parts.
    """
    best, size = None, -(-len(item) // (edits + 1))
    for low in range(0, len(item), size):
        part, at = item[low : low + size], -1
        while (at := text.find(part, at + 1)) >= 0:
            begin = max(0, at - low - edits)
            got = best_match(item, text[begin : at - low + len(item) + edits], edits)
            if got and (best is None or (got[0], begin + got[1]) < best):
                best = (got[0], begin + got[1])
    return best


def _dense_rows(block: Items, data: np.ndarray, offsets: np.ndarray):
    """The rows of a slice that hold q-grams of items densely enough anywhere (all rows if some items are short), and their bytes and offsets."""
    flags = np.zeros(len(data), dtype=bool)
    places = gram_places(data)
    flags[: len(places)] = block.bitmap[places]
    every = np.arange(len(offsets) - 1)
    if block.short:
        return every, data, offsets
    hits = np.concatenate([[0], np.cumsum(flags, dtype=np.int32)])
    tiles = np.arange(0, len(data), TILE_STEP)
    full = tiles[hits[np.minimum(tiles + TILE + TILE_STEP, len(data))] - hits[tiles] >= block.tile_grams]
    # a tile may reach into the rows behind the one it begins in
    low = np.searchsorted(offsets, full, side="right") - 1
    high = np.searchsorted(offsets, np.minimum(full + TILE + TILE_STEP, len(data)) - 1, side="right") - 1
    depth = np.bincount(low, minlength=len(every) + 1) - np.bincount(high + 1, minlength=len(every) + 1)
    touched = np.cumsum(depth)[:-1] > 0
    rows = every[touched]
    sizes = np.diff(offsets)[rows]
    at = np.repeat(offsets[:-1][rows] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
    return rows, data[at], np.concatenate([[0], np.cumsum(sizes)])


def _matches(batches: Iterator[pa.RecordBatch], items) -> Iterator[pa.RecordBatch]:
    """(id, text) batches to rows of MATCH: for each document and item the best occurrence."""
    block: Items = items.value
    for batch in batches:
        ids = batch.column(0).to_pylist()
        out = []
        for first, end, raw, raw_offsets in _slices(batch.column(1)):
            data, offsets, _ = plain(raw, raw_offsets)
            rows, data, offsets = _dense_rows(block, data, offsets)
            found: dict[tuple[int, int], tuple[int, int, int]] = {}
            tried: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
            places = gram_places(data)
            near = np.zeros(len(data) + 1, dtype=np.int32)  # where dense stretches begin and end
            marked = np.flatnonzero(block.bitmap[places])
            bits = block.gram_bits[np.searchsorted(block.gram_at, places[marked])] if len(marked) else np.zeros(0, np.uint64)
            for c, (_, most, grams) in enumerate(block.classes if len(data) else []):
                hits = np.zeros(len(data) + 1, dtype=np.int32)
                hits[marked[(bits >> np.uint64(c % 64) & np.uint64(1)) > 0] + 1] = 1
                hits = np.cumsum(hits, dtype=np.int32)
                span = min(block.span(most), len(data))
                # stretches that reach into the next row hold at least the q-grams of their own row
                dense = np.flatnonzero(np.concatenate([hits[span:], np.full(span - 1, hits[-1], dtype=np.int32)])[: len(data)] - hits[:-1] >= grams)
                if len(dense):
                    ends = np.minimum(dense + span, offsets[np.searchsorted(offsets, dense, side="right")])
                    dense, ends = dense[hits[ends] - hits[dense] >= grams], ends[hits[ends] - hits[dense] >= grams]
                    near += (np.bincount(dense, minlength=len(near)) - np.bincount(ends, minlength=len(near))).astype(np.int32)
            starts = np.flatnonzero(np.cumsum(near[:-1]) > 0)
            for part in np.array_split(starts, -(-len(starts) // 4096)) if len(starts) else []:
                for at, i, offset in block.candidates(data, part).tolist():
                    doc = int(np.searchsorted(offsets, at, side="right")) - 1
                    text = block.rows[i][1]
                    edits = int(EDITS * len(text))
                    begin, stop = int(offsets[doc]), int(offsets[doc + 1])
                    low = max(begin, at - offset - edits - GRAM)
                    high = min(stop, at - offset + len(text) + 2 * edits + GRAM)
                    known = found.get((doc, i))
                    if known and known[0] == 0 or any(a <= low and high <= b for a, b in tried[doc, i]):
                        continue
                    low, high = max(begin, low - MARGIN), min(stop, high + MARGIN)
                    tried[doc, i].append((low, high))
                    # each edit spoils at most GRAM q-grams of the item
                    if np.isin(block.grams[i], places[low : max(low, high - GRAM + 1)]).sum() < len(block.grams[i]) - edits * GRAM:
                        continue
                    got = best_match(text, data[low:high].tobytes(), edits)
                    if got and (not known or got[0] < known[0]):
                        found[doc, i] = (got[0], max(0, low + got[1] - len(text) - begin), len(text))
            if block.short:
                for doc in range(len(rows)):
                    text = b" " + data[offsets[doc] : offsets[doc + 1]].tobytes() + b" "
                    for i in block.short:
                        size = len(block.rows[i][1])
                        got = short_match(b" " + block.rows[i][1] + b" ", int(EDITS * size), text)
                        if got:
                            found[doc, i] = (got[0], max(0, got[1] - size - 2), size)
            out += [(ids[first + int(rows[doc])], block.rows[i][0], *what) for (doc, i), what in found.items()]
        if out:
            doc, item, edits, start, length = zip(*out)
            yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(item, pa.int64()), pa.array(edits, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int32())], ["doc", "item_id", "edits", "start", "length"])


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document and benchmark item that occurs in it: id, item_id, edits, start, length.

    An item (item_id, text) occurs if some stretch of the document is within
    EDITS of the item's length from it in edit distance over UTF-8 bytes, A-Z
    taken as a-z and runs of blanks as one space, at RECALL (all of them where a
    segment is without edits); items shorter than SHORT
    bytes are compared with a blank at both ends, and all occurrences are
    found.  edits, start and length
    (after that normalisation) tell of the best occurrence.

    * Null and blank texts and items match nothing; null ids are reported.
    * Repeated documents, and repeated items, are each reported; equal ids with
      equal items once.
    * Empty tables give an empty result; further columns are ignored.

    Spark: items go to the tasks in blocks of BLOCK_ITEMS, one scan of the
    documents each; nothing else is moved, and no document meets another.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    out: DataFrame | None = None
    block: list[tuple[int, str]] = []

    def scan(block, out):
        got = rows.mapInArrow(partial(_matches, items=spark.sparkContext.broadcast(Items(block))), MATCH)
        return got if out is None else out.unionByName(got)

    for r in items.toLocalIterator():
        block.append((r.item_id, r.text))
        if len(block) == BLOCK_ITEMS:
            out, block = scan(block, out), []
    if block or out is None:
        out = scan(block, out)
    return out.distinct().withColumnRenamed("doc", id_col)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of docs in which no benchmark item occurs, whatever their ids."""
    rows = numbered(docs)
    return without(rows, stored(contaminated(rows, benchmark, ROW, text_col), "matches"), ROW).select(*docs.columns)
