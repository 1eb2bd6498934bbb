"""The manifest against a plain tree in Python: ties, nulls, groups of one row, many equal ids."""

import hashlib
import zlib

import numpy as np
import pyarrow as pa

from rinkline.llm import merkle

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, group string, id long, leaf int, total int"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(values):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climbed(digests):
    """The top of a list of digests, and for each the (left, right) beside its path."""
    paths, owners, level = [[] for _ in digests], [[i] for i in range(len(digests))], list(digests)
    while len(level) > 1:
        up, above = [], []
        for s in range(0, len(level), 16):
            run = level[s : s + 16]
            for k in range(len(run)):
                for i in owners[s + k]:
                    paths[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            up.append(h("".join(run)))
            above.append([i for k in range(len(run)) for i in owners[s + k]])
        level, owners = up, above
    return level[0], paths


def brute(rows):
    of = {}
    for r in rows:
        values = (r[0], r[3], r[2], r[4], r[1])
        changed = values
        if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[1] is not None:
            changed = (*values[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1]))
        of.setdefault(r[3], []).append((r[0], leaf(values), leaf(changed)))
    names = sorted(of, key=lambda s: (s is not None, (s or "").encode()))
    tops, inner = [], {}
    for name in names:
        of[name].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        top, inner[name] = climbed([x[1] for x in of[name]])
        tops.append(top)
    root, outer = climbed(tops)
    out = []
    for name, top, beyond in zip(names, tops, outer):
        for (doc, own, changed), path in zip(of[name], inner[name]):
            folded = changed
            for left, right in path + beyond:
                folded = h(left + folded + right)
            out.append((doc, own, top, root, h("".join(a + b for a, b in path + beyond)), folded, folded == root))
    return sorted(out, key=repr)


def found(spark, rows):
    frame = spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in merkle.tampering(frame, FIELDS).collect()), key=repr)


def test_manifest_is_a_plain_tree(spark):
    rng = np.random.default_rng(3)
    ids = [int(i) for i in rng.choice(5000, 700, replace=False)] + [-(2**62), -5, 2**62, 10**12]
    rows = [(i, f"Text {i} ÄÖ", ["en", None][i % 2], ["a", "é", "", None, f"own{i}"][i % 4 if i % 50 else 4], i % 1000) for i in ids]
    rows += [(None, "no id", "en", "a", 1), (None, None, None, None, None), (7, "", "en", "a", None)]
    rows += [(8, f"Tie {k}", "en", "a", 1) for k in range(40)] + [(9, "Same", "en", "a", 1)] * 40
    assert found(spark, rows) == brute(rows)


def test_one_row_one_source_and_none(spark):
    for rows in ([(5, "Alone", "en", "a", 5)], [(i, f"T{i}", "en", "a", 1) for i in range(17)], [(i, f"T{i}", "en", f"s{i}", 1) for i in range(18)]):
        assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []
    assert merkle.Manifest(spark.createDataFrame([], SCHEMA), FIELDS).root is None


def test_ids_that_many_rows_share(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LARGE_GROUP", 100)
    rows = [(3, f"Row {i % 300}", "en", "a", 1) for i in range(1000)] + [(i, "B", "en", "a", 1) for i in range(50)]
    assert found(spark, rows) == brute(rows)


def test_bitmaps_of_tasks_merge():
    batch = lambda ids: pa.record_batch([pa.array(["g"] * len(ids)), pa.array(ids, pa.int64())], ["group", "id"])
    parts = pa.Table.from_batches([b for ids in ([5, 5, 900], [5, 7, None], [2000]) for b in merkle._containers(iter([batch(ids)]))]).sort_by([("group", "ascending"), ("range", "ascending")])
    rows = pa.Table.from_batches(list(merkle._merged(iter(parts.combine_chunks().to_batches())))).to_pylist()
    assert [(r["range"], r["n"]) for r in rows] == [(merkle._NO_RANGE, 1), (0, 5), (1, 1)]
