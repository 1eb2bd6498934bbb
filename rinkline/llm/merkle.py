"""Merkle manifest of a dataset: a tree of digests for each group of rows, and one over the groups.

A leaf's place in its group is its id's rank.  Ids of a group are held as
compressed bitmaps, one for each range of ids; merged over all tasks and with
the counts before them (the directory) they answer rank queries, so no task
sorts a group's leaves.  Nodes that share a parent then meet by key, each with
its slot, level by level.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rinkline.llm._bitmaps import pack_planes, pack_sets, unpack_planes, unpack_sets
from rinkline.llm._shared import LARGE_GROUP, discard, if_small, stored
from rinkline.operators.ordering import row_numbers, running

#: Nodes below a parent.
FANOUT = 16
#: Ids of a bitmap.
SPAN = 1024
#: Rows with paths, of some kilobytes each, up to which they are broadcast.
FEW_PATHS = 4096
#: The range of rows without an id: before all others.
_NO_RANGE = -(1 << 60)

_CONTAINER = "group string, range long, n long, docs binary, times binary, planes long"
_RANKED = "group string, id long, row long, leaf binary, other binary, place long, ties long, total long"
_KINDS = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.large_binary()}


def _schema(text: str) -> pa.Schema:
    return pa.schema([(c.split()[0], _KINDS[c.split()[1]]) for c in text.split(", ")])


def field(value: Column) -> Column:
    """What a value adds to a leaf: its bytes in UTF-8, counted, or `-` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: list[Column]) -> Column:
    """Digest of a row's values, as hex text."""
    return F.sha2(F.concat(*map(field, values)), 256)


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _joined(slots: Column) -> Column:
    return F.array_join(F.transform(slots, lambda s: _hex(s["digest"])), "")


def _containers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(group, id) batches to the bitmaps of each batch."""
    for batch in batches:
        if not len(batch):
            continue
        names = batch.column(0).dictionary_encode()
        group = names.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        none = batch.column(1).is_null().to_numpy(zero_copy_only=False)
        ids = batch.column(1).fill_null(0).to_numpy()
        where, low = np.where(none, _NO_RANGE, ids >> (SPAN.bit_length() - 1)), np.where(none, 0, ids & (SPAN - 1))
        order = np.lexsort((low, where, group))
        group, where, low = group[order], where[order], low[order]
        new = np.append(True, (np.diff(group) != 0) | (np.diff(where) != 0))
        member = np.flatnonzero(new | np.append(True, np.diff(low) != 0))
        times = np.diff(np.append(member, len(low)))
        first = np.flatnonzero(new)
        sizes = np.diff(np.append(np.searchsorted(member, first), len(member)))
        planes, count = pack_planes(times - 1, sizes)
        yield pa.RecordBatch.from_arrays(
            [names.dictionary.take(pa.array(group[first])).cast(pa.string()), pa.array(where[first]), pa.array(np.diff(np.append(first, len(low)))), pack_sets(low[member], sizes, SPAN), planes, pa.array(count)],
            schema=_schema(_CONTAINER),
        )


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bitmaps sorted by group and range to one for each: bits are joined, counts added."""
    key, counts = None, np.zeros(SPAN, dtype=np.int64)

    def emitted() -> pa.RecordBatch:
        low = np.flatnonzero(counts)
        planes, count = pack_planes(counts[low] - 1, np.array([len(low)]))
        return pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([key[1]]), pa.array([int(counts.sum())]), pack_sets(low, np.array([len(low)]), SPAN), planes, pa.array(count)], schema=_schema(_CONTAINER))

    for batch in batches:
        low, sizes = unpack_sets(batch.column("docs"), SPAN)
        times = unpack_planes(batch.column("times"), sizes, batch.column("planes").to_numpy()) + 1
        ends = np.cumsum(sizes)
        done = []
        for now, start, end in zip(zip(batch.column("group").to_pylist(), batch.column("range").to_pylist()), (ends - sizes).tolist(), ends.tolist()):
            if now != key:
                if key is not None:
                    done.append(emitted())
                key = now
                counts[:] = 0
            counts[low[start:end]] += times[start:end]
        if done:
            yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
    if key is not None:
        yield emitted()


def _ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A range's bitmap, then its leaves, range after range, to the leaves with their places."""
    before = times = None
    base = total = 0
    for batch in batches:
        docs = batch.column("docs")
        heads = np.flatnonzero(docs.is_valid().to_numpy(zero_copy_only=False))
        members, sizes = unpack_sets(docs.take(pa.array(heads)), SPAN)
        counted = unpack_planes(batch.column("times").take(pa.array(heads)), sizes, batch.column("planes").take(pa.array(heads)).to_numpy()) + 1
        ends = np.cumsum(sizes)
        low = (batch.column("id").fill_null(0).to_numpy() & (SPAN - 1)).astype(np.int64)
        place, ties, whole = (np.zeros(len(batch), dtype=np.int64) for _ in range(3))
        for k, (start, end) in enumerate(zip([-1, *heads.tolist()], [*heads.tolist(), len(batch)])):
            if start >= 0:
                times = np.zeros(SPAN, dtype=np.int64)
                times[members[ends[k - 1] - sizes[k - 1] : ends[k - 1]]] = counted[ends[k - 1] - sizes[k - 1] : ends[k - 1]]
                before = np.cumsum(times) - times
                base, total = batch.column("base")[start].as_py(), batch.column("total")[start].as_py()
            if end > start + 1:
                own = low[start + 1 : end]
                place[start + 1 : end], ties[start + 1 : end], whole[start + 1 : end] = base + before[own], times[own], total
        leaves = batch.append_column("place", pa.array(place)).append_column("ties", pa.array(ties))
        leaves = leaves.set_column(leaves.schema.get_field_index("total"), "total", pa.array(whole)).filter(pc.is_null(docs))
        yield leaves.select([c.split()[0] for c in _RANKED.split(", ")])


def placed(leaves: DataFrame) -> DataFrame:
    """leaves (group, id, row, leaf, other; stored) with their place in their group and the group's total.

    Null ids come first; rows that share an id stand in the order of their leaves.
    """
    sorted_ = leaves.select("group", "id").mapInArrow(_containers, _CONTAINER).repartition("group", "range").sortWithinPartitions("group", "range")
    containers = stored(sorted_.mapInArrow(_merged, _CONTAINER), "bitmaps")
    directory = running(containers, ["group"], [F.col("range")], {"until": ("sum", F.col("n"))})
    totals = stored(containers.groupBy("group").agg(F.sum("n").alias("total")), "totals")
    directory = stored(directory.join(if_small(totals), "group").withColumn("base", F.col("until") - F.col("n")), "directory")

    range_ = F.coalesce(F.shiftright("id", SPAN.bit_length() - 1), F.lit(_NO_RANGE))
    rows = leaves.select("*", range_.alias("range")).withColumn("salt", F.lit(0))
    heads = directory.select("group", "range", "n", "docs", "times", "planes", "base", "total").withColumn("salt", F.lit(0))
    large = directory.where(F.col("n") > LARGE_GROUP).select("group", "range", F.ceil(F.col("n") / LARGE_GROUP).cast("int").alias("salts"))
    if not large.isEmpty():  # ids that very many rows share
        large = if_small(stored(large, "large"))
        rows = rows.join(large, ["group", "range"], "left").withColumn("salt", F.coalesce(F.pmod(F.xxhash64("row"), "salts").cast("int"), F.lit(0))).drop("salts")
        heads = heads.join(large, ["group", "range"], "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))).drop("salts")
    both = heads.unionByName(rows, allowMissingColumns=True).repartition("group", "range", "salt")
    both = both.sortWithinPartitions("group", "range", "salt", F.col("docs").isNull())
    found = both.select("group", "id", "row", "leaf", "other", "docs", "times", "planes", "base", "total").mapInArrow(_ranked, _RANKED)
    if directory.where(F.octet_length("times") > 0).isEmpty():
        return found
    found = stored(found, "ranked")
    tied = running(found.where("ties > 1"), ["group", "id"], [F.col("leaf"), F.col("row")], {"nth": ("sum", F.lit(1).cast("long"))})
    return found.where("ties = 1").unionByName(tied.withColumn("place", F.col("place") + F.col("nth") - 1).drop("nth"))


def _grouped(nodes: DataFrame, carried: list[str]) -> DataFrame:
    """Nodes (group, place, total, digest and what is carried) as runs: group, run, total, slots in order."""
    slot = F.struct((F.col("place") % FANOUT).alias("slot"), "digest", *carried)
    run = F.floor(F.col("place") / FANOUT).alias("run")
    return nodes.groupBy("group", run).agg(F.first("total").alias("total"), F.array_sort(F.collect_list(slot)).alias("slots"))


def levels(nodes: DataFrame, carried: list[str], name: str) -> list[DataFrame]:
    """The runs of every level, stored, up to the one node that stands for each group."""
    out = [stored(_grouped(nodes, carried), f"{name}_0")]
    most = out[0].agg(F.max("total")).first()[0] or 0
    while most > 1:
        most = -(-most // FANOUT)
        parents = out[-1].where("total > 1").select(
            "group", F.col("run").alias("place"), F.ceil(F.col("total") / FANOUT).alias("total"), F.unhex(F.sha2(_joined(F.col("slots")), 256)).alias("digest")
        )
        out.append(stored(_grouped(parents, []), f"{name}_{len(out)}"))
    return out


def _tops(tree: list[DataFrame]) -> DataFrame:
    """(group, digest) of the node that each group ends in."""
    out = None
    for level in tree:
        top = level.where("total = 1").select("group", F.col("slots")[0]["digest"].alias("digest"))
        out = top if out is None else out.unionByName(top)
    return out


def _few(paths: DataFrame) -> DataFrame:
    """Stored rows with paths, to be broadcast if they are few."""
    return F.broadcast(paths) if paths.count() <= FEW_PATHS else paths


def _downwards(tree: list[DataFrame], tops: DataFrame, carried: list[str]) -> DataFrame:
    """The nodes of the lowest level with the path to their top and on: what tops (group, path, ...) has of the group, then carried.

    A path holds, level by level, the digests left and right of the node.
    """
    more = [c for c in tops.columns if c not in ("group", "path")]
    tops, above = _few(stored(tops, "tops")), None
    for depth, level in reversed(list(enumerate(tree))):
        kept = carried if depth == 0 else []
        here = level.where("total = 1").select("group", F.lit(0).cast("long").alias("place"), *(F.col("slots")[0][c].alias(c) for c in ["digest", *kept])).join(tops, "group")
        if above is not None:
            runs = level.where("total > 1").join(above.drop("digest").withColumnRenamed("place", "run"), ["group", "run"])
            each = runs.select("group", "run", "slots", "path", *more, F.posexplode("slots").alias("at", "own"))
            side = lambda start, length: F.array_join(F.transform(F.slice("slots", start, length), lambda s: _hex(s["digest"])), "")
            step = F.struct(side(F.lit(1), F.col("at")).alias("left"), side(F.col("at") + 2, F.lit(FANOUT)).alias("right"))
            here = here.unionByName(each.select(
                "group", (F.col("run") * FANOUT + F.col("own")["slot"]).alias("place"), *(F.col("own")[c].alias(c) for c in ["digest", *kept]),
                F.concat(F.array(step), "path").alias("path"), *more,
            ))
        above = here if depth == 0 else _few(stored(here, "paths"))
    return above


def fold(digest: Column, path: Column) -> Column:
    """The root that a digest (hex text) and the digests beside its path give."""
    return F.aggregate(path, digest, lambda own, at: F.sha2(F.concat(at["left"], own, at["right"]), 256))


class Manifest:
    """Digests of a dataset: root (hex text, null for an empty table), subroots (group, digest), proofs().

    docs: the rows; fields: what a leaf covers, in order; group_col parts them,
    id_col (an integer) orders them.  other: columns by whose values those of
    fields are replaced for a second leaf, to be told from the first.

    * Null groups and null ids come first; rows that share an id are ordered by
      their leaves, equal rows in any way.  Null fields count as `-`.
    * An empty table has no root and gives no proofs; further columns are ignored.

    Spark: one pass takes the leaves and writes them without the texts; a range's
    bitmap and leaves meet once, ranges with more than LARGE_GROUP rows in parts;
    then at most 16 nodes meet by key, with a sixteenth as many at each further level.
    """

    def __init__(self, docs: DataFrame, fields: list[str], group_col: str = "source", id_col: str = "doc_id", other: dict[str, Column] | None = None) -> None:
        self.id_col, self.group_col = id_col, group_col
        plain, changed = leaf([F.col(c) for c in fields]), leaf([(other or {}).get(c, F.col(c)) for c in fields])
        rows = docs.select(
            F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit("")).alias("group"), F.col(id_col).cast("long").alias("id"),
            F.unhex(plain).alias("leaf"), F.unhex(changed).alias("other") if other else F.lit(None).cast("binary").alias("other"),
        )
        leaves = stored(rows.withColumn("row", F.monotonically_increasing_id()), "leaves")
        nodes = placed(leaves).withColumnRenamed("leaf", "digest")
        self._carried = ["id", "other"]
        self._tree = levels(nodes, self._carried, "runs")
        tops = stored(_tops(self._tree), "subroots")
        total = F.lit(tops.count()).cast("long")
        ordered = row_numbers(tops, [F.col("group")]).select(F.lit("").alias("group"), (F.col("row_number") - 1).alias("place"), total.alias("total"), "digest", F.col("group").alias("of"))
        self._top = levels(ordered, ["of"], "tops")
        top = _tops(self._top).first()
        self.root = bytes(top.digest).hex() if top else None
        self._tops = tops
        discard(leaves)

    @property
    def subroots(self) -> DataFrame:
        return self._tops.select(F.when(F.col("group") != "", F.expr("substring(group, 2)")).alias(self.group_col), _hex(F.col("digest")).alias("subroot"))

    def proofs(self) -> DataFrame:
        """One row per row of docs: id, leaf, other (hex texts), subroot, root, path (an array of left and right)."""
        tops = self._top[0].sparkSession.createDataFrame([("", [])], "group string, path array<struct<left string, right string>>")
        groups = _downwards(self._top, tops, ["of"]).select(F.col("of").alias("group"), "path", _hex(F.col("digest")).alias("subroot"))
        rows = _downwards(self._tree, groups, self._carried)
        return rows.select(F.col("id").alias(self.id_col), _hex(F.col("digest")).alias("leaf"), _hex(F.col("other")).alias("other"), "subroot", F.lit(self.root).alias("root"), "path")


def siblings_digest(path: Column) -> Column:
    """Digest of all digests beside a path, in order."""
    return F.sha2(F.array_join(F.transform(path, lambda at: F.concat(at["left"], at["right"])), ""), 256)


def tampering(docs: DataFrame, fields: list[str], id_col: str = "doc_id", text_col: str = "text", every: int = 5) -> DataFrame:
    """One row per row of docs: id, leaf, subroot, root, proof_sha256, folded_root, verified.

    folded_root is recomputed from the digests beside the leaf and from the leaf
    of the row, or that of the row with A-Z lower-cased in its text where `every`
    divides the CRC-32 of the id; rows without an id are left as they are.
    """
    lowered = F.translate(F.col(text_col), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    hit = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % every == 0, F.lit(False))
    manifest = Manifest(docs, fields, id_col=id_col, other={text_col: F.when(hit, lowered).otherwise(F.col(text_col))})
    rows = manifest.proofs().withColumn("folded_root", fold(F.col("other"), F.col("path")))
    return rows.select(id_col, "leaf", "subroot", "root", siblings_digest(F.col("path")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
