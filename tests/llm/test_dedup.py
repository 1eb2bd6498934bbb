"""Exact, substring and near duplicates against brute force, with nulls, empty texts, repeats and clashing columns."""

import hashlib
import random
import re

import pytest

from rinkline.llm.exact_dedup import exact_dedup
from rinkline.llm.ngram_join import TrieJoin, ngram_join
from rinkline.llm.substring_dedup import substring_dedup
from rinkline.llm import _shared
from rinkline.llm._components import components
from rinkline.llm import suffix_dedup as suffix_module
from rinkline.llm.suffix_dedup import suffix_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _corpus():
    rnd = random.Random(5)
    words = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 6))) for _ in range(60)]
    text = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    shared, line = text(40), "the same line again and again for everyone who reads this far today ok"
    out = []
    for i in range(90):
        t = text(rnd.randint(0, 60))
        if i % 3 == 0:
            t += " " + shared[rnd.randint(0, 60) :]
        if i % 4 == 0:
            t = line + "\n" + t
        if i % 7 == 0 and out:
            t = rnd.choice(out)[1] or ""
        if i % 11 == 0 and t:
            cut = t.split(" ")
            cut[len(cut) // 2] = "edited"
            t = " ".join(cut)
        out.append((i, t))
    out += [(200, None), (201, ""), (202, " \t\n"), (203, "a " * 400), (204, "a " * 380), (205, "x" * 700), (206, "y" + "x" * 650), (207, "日本語" * 60), (208, "本語日" * 60), (90, out[5][1] + "  "), (5, out[5][1])]
    return out


@pytest.fixture(scope="module")
def corpus():
    return _corpus()


def _frame(spark, rows):
    """With columns whose names clash with those that operators use inside."""
    return spark.createDataFrame([(i, t, "x", 7) for i, t in rows], "doc_id long, text string, key string, doc int")


def test_exact(spark, corpus):
    norm = {i: re.sub(r"[\x20\x09-\x0D]", "", t or "") for i, t in corpus}
    rows = {}
    for digest_all in (True, False):
        got = exact_dedup(_frame(spark, corpus), digest_all=digest_all).collect()
        assert len(got) == len(corpus)
        for r in got:
            same = [(i, t) for i, t in corpus if norm[i] == norm[r.doc_id]]
            keep = min(same, key=lambda x: (-len(x[1] or ""), x[0]))[0]
            assert (r.keep_id, r.group_size, r.kept) == (keep, len(same), keep == r.doc_id)
            if digest_all or len(same) > 1:
                assert r.text_sha256 == hashlib.sha256(norm[r.doc_id].encode()).hexdigest()
            rows[r.doc_id] = r
    assert exact_dedup(_frame(spark, [])).count() == 0
    odd = {(r.doc_id, r.keep_id, r.group_size) for r in exact_dedup(_frame(spark, [(None, "a"), (2, "a"), (None, None)])).collect()}
    assert odd == {(None, 2, 2), (2, 2, 2), (None, None, 1)}


def _removed(sequences, width):
    """Brute force: for each row the covered units."""
    first = {}
    for i, s in sequences:
        for k in range(len(s) - width + 1):
            first[tuple(s[k : k + width])] = min(i, first.get(tuple(s[k : k + width]), 1 << 60))
    out = []
    for i, s in sequences:
        gone = [False] * len(s)
        for k in range(len(s) - width + 1):
            if first[tuple(s[k : k + width])] < i:
                gone[k : k + width] = [True] * width
        out.append((i, s, gone))
    return out


def test_substrings(spark, corpus):
    want = sorted((i, len(s), sum(g), hashlib.sha256(" ".join(w for w, x in zip(s, g) if not x).encode()).hexdigest()) for i, s, g in _removed([(i, WORD.findall(t or "")) for i, t in corpus], 13))
    got = substring_dedup(_frame(spark, corpus))
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got.collect()) == want
    assert any(w[2] for w in want)
    assert all(hashlib.sha256(r.text.encode()).hexdigest() == r.kept_sha256 for r in got.collect())
    assert substring_dedup(_frame(spark, [])).count() == 0
    assert [r.n_removed for r in substring_dedup(_frame(spark, [(None, "a " * 20), (1, "a " * 20)])).collect()] == [0, 0]


def test_suffixes(spark, corpus):
    want = []
    for i, s, g in _removed([(i, (t or "").encode()) for i, t in corpus], 50):
        want.append((i, len(s), sum(g), sum(b and not a for a, b in zip([False, *g], g)), hashlib.sha256(bytes(c for c, x in zip(s, g) if not x)).hexdigest()))
    got = suffix_dedup(_frame(spark, corpus), with_bytes=False)
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got.collect()) == sorted(want)
    assert suffix_dedup(_frame(spark, [])).count() == 0


@pytest.mark.parametrize("digest_all", [True, False])
def test_exact_without_broadcasts(spark, corpus, digest_all, monkeypatch):
    """Beyond BROADCAST_ROWS and LARGE_GROUP the result is the same."""
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    want = sorted(map(tuple, exact_dedup(_frame(spark, corpus), digest_all=digest_all).select(*columns).collect()), key=repr)
    monkeypatch.setattr(_shared, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(_shared, "LARGE_GROUP", 3)
    got = exact_dedup(_frame(spark, corpus), digest_all=digest_all).select(*columns).collect()
    assert sorted(map(tuple, got), key=repr) == want


def test_numbered_rows(spark, tmp_path):
    """Rows of files keep their numbers; rows of a join, which repeat and lack rows of their files, get others; all are unique."""
    spark.range(50).selectExpr("id AS doc_id", "cast(id % 3 AS string) AS text").repartition(3).write.parquet(f"{tmp_path}/t")
    docs = spark.read.parquet(f"{tmp_path}/t")
    once, again = ({r.doc_id: r[_shared.ROW] for r in _shared.numbered(docs).collect()} for _ in range(2))
    assert once == again and len(set(once.values())) == 50
    joined = docs.join(spark.range(2).selectExpr("id AS k"), docs.doc_id % 2 == 0).drop("k")
    rows = _shared.numbered(joined)
    assert rows.count() == 50 == rows.select(_shared.ROW).distinct().count()
    assert _shared.numbered(docs.where("doc_id > 10")).select(_shared.ROW).distinct().count() == 39


@pytest.mark.parametrize("batches", [1, 2, 5, 9])
def test_suffixes_in_batches(spark, corpus, batches, monkeypatch):
    """Levels merge as batches come; frequent prefixes enter window by window; small chunks and buckets; against brute force."""
    monkeypatch.setattr(suffix_module, "CHUNK_BYTES", 2000)
    monkeypatch.setattr(suffix_module, "BUCKET_BYTES", 3000)
    monkeypatch.setattr(suffix_module, "MANY_CONTEXTS", 2)
    if batches > 1:
        monkeypatch.setattr(suffix_module, "SAMPLE_ONE_IN", 1)
        monkeypatch.setattr(suffix_module, "LEAST", 5)
    size = sum(len((t or "").encode()) for _, t in corpus)
    want = [(i, sum(g)) for i, _, g in _removed([(i, (t or "").encode()) for i, t in corpus], 50)]
    got = suffix_dedup(_frame(spark, corpus), with_bytes=False, batch_bytes=-(-size // batches))
    assert sorted((r.doc_id, r.n_removed) for r in got.collect()) == sorted(want)


def test_suffix_index_grows(spark, corpus, tmp_path):
    """An index is a binary counter of batches, can be opened again, and takes only rising ids."""
    path = f"file://{tmp_path}/index"
    index = suffix_module.SuffixIndex(spark, path, 50, 3)
    corpus = [x for x in corpus if x[0] < 90]
    docs = _frame(spark, corpus).selectExpr("doc_id AS doc", "text")
    sizes = []
    for low in range(0, 90, 15):
        index.add(docs.where(f"doc >= {low} AND doc < {low + 15}"))
        sizes.append([n for _, _, n, _ in index.levels()])
        if low == 30:
            index = suffix_module.SuffixIndex(spark, path, 50, 3)
    assert sizes == [[1], [2], [1, 2], [4], [1, 4], [2, 4]]
    with pytest.raises(ValueError):
        index.add(docs.where("doc < 5"))
    ranges = suffix_module.repeated_ranges(docs, index, 50)
    want = {i for i, _, g in _removed([(i, (t or "").encode()) for i, t in corpus], 50) if any(g)}
    assert {r.doc for r in ranges.collect()} == want
    index.drop()


def test_suffix_index_after_a_lost_batch(spark, corpus, tmp_path, monkeypatch):
    """A run lost after its level was written and before those it took in were deleted: the index opens whole, and the batch may come again."""
    path = f"file://{tmp_path}/lost"
    corpus = [x for x in corpus if x[0] < 90]
    docs = _frame(spark, corpus).selectExpr("doc_id AS doc", "text")
    part = lambda low: docs.where(f"doc >= {low} AND doc < {low + 30}")
    index = suffix_module.SuffixIndex(spark, path, 50, 3)
    index.add(part(0))

    def lost(self, names):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(suffix_module.SuffixIndex, "_stale", lambda self: [])
        m.setattr(suffix_module.SuffixIndex, "forget", lambda self, names: lost(self, names) if names else None)
        with pytest.raises(RuntimeError):
            index.add(part(30))
        assert len(index.levels()) == 2
    assert [n for _, _, n, _ in index.levels()] == [2]
    again = suffix_module.SuffixIndex(spark, path, 50, 3)
    assert len(again._written()) == 1
    again.add(part(30))
    again.add(part(60))
    assert [n for _, _, n, _ in again.levels()] == [1, 2]
    want = {i for i, _, g in _removed([(i, (t or "").encode()) for i, t in corpus], 50) if any(g)}
    assert {r.doc for r in suffix_module.repeated_ranges(docs, again, 50).collect()} == want
    again.drop()


def _sets(corpus, n):
    out = {}
    for i, t in corpus:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out[i] = {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()
    return out


@pytest.mark.parametrize("n,percent", [(4, 85), (5, 80), (2, 50)])
def test_ngram_join(spark, corpus, n, percent):
    sets = _sets(corpus, n)
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]) and sets[b]:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    got = ngram_join(_frame(spark, corpus), n=n, percent=percent).collect()
    assert len(got) == len(corpus)
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == {(i, len(sets[i]), find(i)) for i in sets}


def test_ngram_join_odd(spark, monkeypatch):
    from rinkline.llm import ngram_join as module

    assert ngram_join(_frame(spark, [])).count() == 0
    assert [r.component_id for r in ngram_join(_frame(spark, [(None, "a b c"), (3, "a b c")])).orderBy("doc_id").collect()] == [None, 3]
    # blocks of a large cluster must find what one block finds
    rnd = random.Random(1)
    base = [f"w{i}" for i in range(40)]
    rows = []
    for i in range(60):
        w = list(base)
        for _ in range(rnd.randint(0, 6)):
            w[rnd.randrange(40)] = f"z{rnd.randrange(500)}"
        rows.append((i, " ".join(w)))
    one = {(r.doc_id, r.component_id) for r in ngram_join(_frame(spark, rows), n=2, percent=70).collect()}
    monkeypatch.setattr(module, "BLOCK_GRAMS", 400)
    monkeypatch.setattr(module, "CLOSE_GROUP", 4)
    assert {(r.doc_id, r.component_id) for r in ngram_join(_frame(spark, rows), n=2, percent=70).collect()} == one


def test_trie_finds_every_component():
    import numpy as np

    rnd = random.Random(2)
    sets = [sorted(rnd.sample(range(12), rnd.randint(1, 10))) for _ in range(120)]
    join = TrieJoin(60)
    for s in sets:
        join.add(np.array(s))
    parent = list(range(len(sets)))
    find = lambda x: x if parent[x] == x else find(parent[x])
    for a in range(len(sets)):
        for b in range(a):
            x, y = set(sets[a]), set(sets[b])
            if 100 * len(x & y) >= 60 * len(x | y):
                parent[find(a)] = find(b)
    assert len({frozenset(i for i in range(len(sets)) if find(i) == r) for r in map(find, range(len(sets)))}) == len({join.find(i) for i in range(len(sets))})
    assert all((join.find(a) == join.find(b)) == (find(a) == find(b)) for a in range(len(sets)) for b in range(a))


@pytest.mark.parametrize("least", [5, 200_000])
def test_components(spark, monkeypatch, least):
    """By rounds of contraction and by one task for the rest, against union-find; a star, a path and random edges."""
    monkeypatch.setattr(_shared, "BROADCAST_ROWS", least)
    rnd = random.Random(4)
    edges = [(0, i) for i in range(1, 30)] + [(100 + i, 101 + i) for i in range(40)] + [(rnd.randrange(200, 400), rnd.randrange(200, 400)) for _ in range(90)] + [(7, 7)]
    root = {v: v for e in edges for v in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    got = {r.id: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {v: find(v) for e in edges for v in e if e[0] != e[1]}
    assert components(spark.createDataFrame([], "a long, b long")).isEmpty()
