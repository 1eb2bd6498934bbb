"""Work that must grow with the tables and not with the square of a group, counted; and results that stay the same."""

import random

import numpy as np
import pyarrow as pa
import pytest

from rinkline.llm import ngram_join as nj
from rinkline.llm import suffix_dedup as sd
from rinkline.llm._bytes import mix
from rinkline.llm._components import spanning


def _components(links):
    a, b = (np.array(x, dtype=np.int64) for x in zip(*links)) if links else (np.zeros(0, np.int64),) * 2
    return set(zip(*(x.tolist() for x in spanning(a, b))))


def _near_copies(copies, edits, seed=3):
    """Sets of 200 numbers that differ from one in some places."""
    rnd, out = random.Random(seed), []
    for _ in range(copies):
        s = set(range(200))
        for _ in range(rnd.choice(edits)):
            s.discard(rnd.randrange(200))
            s.add(rnd.randrange(200, 10**6))
        out.append(np.array(sorted(s), dtype=np.uint64))
    return out


def test_copies_that_share_an_ngram_are_not_compared_all_with_all(monkeypatch):
    sets, compared = _near_copies(400, (0, 1, 2)), []
    kept = nj.differences
    monkeypatch.setattr(nj, "differences", lambda sketches, left, right: compared.append(len(left)) or kept(sketches, left, right))
    rows = pa.record_batch({"gram": np.zeros(400, np.int64), "class": np.arange(400), "n": np.array([len(s) for s in sets]), "sketch": pa.array([nj.histogram(mix(s)) for s in sets], pa.binary())})
    found = [pair for batch in nj._close_pairs(iter([rows]), 80) for pair in zip(*(c.to_pylist() for c in batch.columns))]
    assert len(_components(found)) == 399
    assert sum(compared) < 4 * 400


@pytest.mark.parametrize("copies", [20, 300])
def test_pairs_of_a_group_keep_similar_sets_connected(copies):
    sets = _near_copies(copies, (0, 5, 25, 90)) + _near_copies(copies, (30, 60), seed=8)
    sketch = [nj.histogram(mix(s)) for s in sets]
    rows = pa.record_batch({"gram": np.repeat([1, 2], copies), "class": np.arange(2 * copies), "n": np.array([len(s) for s in sets]), "sketch": pa.array(sketch, pa.binary())})
    found = _components([pair for batch in nj._close_pairs(iter([rows]), 80) for pair in zip(*(c.to_pylist() for c in batch.columns))])
    of = dict(found)
    for group in (range(copies), range(copies, 2 * copies)):
        for a in group:
            for b in range(group[0], a):
                if 100 * len(np.intersect1d(sets[a], sets[b])) >= 80 * len(np.union1d(sets[a], sets[b])):
                    assert of.get(a, a) == of.get(b, b)


def test_counted_links_are_those_of_the_trie():
    rnd = random.Random(2)
    for percent in (50, 80):
        sets = [np.array(sorted(rnd.sample(range(14), rnd.randint(1, 10)))) for _ in range(150)] + [np.unique(s.astype(np.int64) % 1000) for s in _near_copies(150, (0, 20, 40, 60))]
        trie = nj.TrieJoin(percent)
        for s in sets:
            trie.add(s)
        assert _components(nj.counted_links(sets, percent)) == _components(trie.links)


def test_frequent_ngrams_stand_last_by_how_often_they_occur(spark):
    """A line that 30 of 3,000 documents hold fills no group of prefixes: each holds rarer n-grams."""
    rnd = random.Random(6)
    text = lambda n: " ".join(f"w{rnd.randrange(10**6)}" for _ in range(n))
    line = " ".join(f"line{i}" for i in range(12))
    rows = [(i, f"{line} {text(40)}" if i % 100 == 0 else text(50)) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc long, text string").coalesce(1)
    profiles = docs.mapInArrow(lambda batches: nj._profiles(batches, 5), "doc long, n long, a long, b long, sketch binary, gram long, count long")
    hot = nj.frequent_grams(profiles)
    held = next(nj.shingle_sets(pa.array([line]), 5))[1]
    assert np.isin(held, hot[0]).all()
    assert set(hot[1][np.isin(hot[0], held)]) == {4}
    frequent = spark.sparkContext.broadcast(hot)
    batch = pa.record_batch({"doc": [r[0] for r in rows], "text": [r[1] for r in rows], "class": [r[0] for r in rows]})
    grams = np.concatenate([x["gram"].to_numpy().view(np.uint64) for x in nj._prefixes(iter([batch]), 5, 80, frequent)])
    assert not np.isin(held, grams).any()


def test_repeated_groups_are_dealt_out_together():
    """100 rows of groups of 500 documents and 100 parts made 10,000 rows."""
    rng = np.random.default_rng(4)
    none = np.zeros(500, dtype=np.uint64)
    found = [sd.Suffixes(none, none, none, none.astype(np.uint32), rng.permutation(500), rng.integers(0, 9999, 500).astype(np.uint32), np.ones(500, np.uint16)) for _ in range(100)]
    out = list(sd._by_document(iter([sd._record([sd._row(sd._LATE, i, f) for i, f in enumerate(found)])]), 100))
    rows = [(batch["bucket"][i].as_py(), sd._suffixes(batch, i)) for batch in out for i in range(len(batch))]
    assert len(rows) <= 100
    assert all((sd.mix(f.doc.view(np.uint64)) % np.uint64(100) == bucket).all() for bucket, f in rows)
    places = lambda some: sorted((d, s) for f in some for d, s in zip(f.doc.tolist(), f.start.tolist()))
    assert places(f for _, f in rows) == places(found)


def test_batches_do_not_grow_with_the_text(spark, monkeypatch):
    """Each batch reads all levels again, so more batches for more text cost more for each byte of it."""
    added, kept = [], sd.SuffixIndex.add
    monkeypatch.setattr(sd, "UNIT_BYTES", 64, raising=False)  # the code before took more batches for more of these
    monkeypatch.setattr(sd.SuffixIndex, "add", lambda self, docs: added.append(1) or kept(self, docs))
    text = "some words that are of a length which lets windows of fifty bytes begin at several places here"
    docs = spark.createDataFrame([(i, f"{i} {text} {i % 7}") for i in range(40)], "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in sd.suffix_dedup(docs).collect()}
    assert len(added) == sd.BATCHES
    assert got[0] == 0 and all(got[i] >= len(text) for i in range(1, 40))
