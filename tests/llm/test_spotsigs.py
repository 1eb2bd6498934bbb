"""SpotSigs fingerprints against plain sets of chains, edited texts and their likeness."""

import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest

from rinkline.llm import spotsigs

SCHEMA = "doc_id long, text string, fingerprint string, range long, hash long"
LONG = "The long text of words and more " * 40 + "x" * 500 + " 日本語のテキスト" * 50


def words(text):
    out = []
    for word in re.findall(rb"[0-9a-z\x80-\xff]+", text.lower().encode()):
        out += [word[i : i + spotsigs.WORD_BYTES] for i in range(0, len(word), spotsigs.WORD_BYTES)]
    return out


def chains(text):
    """The spots of a text as tuples."""
    anchors = {a.encode() for a in spotsigs.ANCHORS}
    found, last, every = set(), -1, words(text)
    content = [i for i, w in enumerate(every) if w not in anchors]
    spots = [(b"<start>", -1)]
    for i, word in enumerate(every):
        if word in anchors:
            last = i
            spots.append((word, i))
        elif (i - last) % spotsigs.GAP == 0:
            spots.append((word, i))
    for word, i in spots:
        chain = tuple(every[c] for c in content if c > i)[: spotsigs.CHAIN]
        if chain:
            found.add((word, *chain))
    return found or ({text.lower()} if text else set())


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_spots_are_chains():
    texts = ["", "   ", "!!", "the of and", "The quick brown fox and the lazy dog, under a blue sky.", LONG, "one two three four five six seven eight nine ten " * 3, "é ü", "Word"]
    values, at = spotsigs.spots(pa.array(texts))
    assert np.diff(at).tolist() == [len(chains(t)) for t in texts]
    every = np.arange(len(texts))
    for i in range(len(texts)):
        got = spotsigs.jaccard(values, at, values, at, np.full(len(texts), i), every)
        assert got == pytest.approx([likeness(chains(texts[i]), chains(t)) for t in texts])


def test_pruned_jaccard_loses_nothing():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 1 << 32, rng.integers(0, 200), dtype=np.uint64)) for _ in range(30)]
    sets += [np.unique(np.append(s[: int(len(s) * f)], rng.integers(0, 1 << 32, 5, dtype=np.uint64))) for s in sets for f in (1.0, 0.9, 0.5)]
    values, at = np.concatenate(sets), np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    left, right = (x.ravel() for x in np.meshgrid(np.arange(len(sets)), np.arange(len(sets))))
    want = np.array([likeness(set(sets[a].tolist()), set(sets[b].tolist())) for a, b in zip(left, right)])
    for least in (0.0, 0.3, 0.8):
        assert spotsigs.jaccard(values, at, values, at, left, right, least) == pytest.approx(np.where(want >= least, want, 0))


def brute(rows, hashed):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, hashed[r[1]]))
    out = []
    for k, (i, own) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        half = len(own) // 2
        edited = own[: len(own) - half] + after[:half]
        out.append((i, len(own), hashlib.sha256(edited.encode()).hexdigest(), likeness(chains(own), chains(edited)), likeness(chains(own), chains(after))))
    return out


def checked(spark, rows):
    hashed = {r.text: r.h for r in spark.createDataFrame([(t or "",) for _, t in rows], "text string").selectExpr("text", "xxhash64(text) h").collect()}
    frame = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], SCHEMA).repartition(3)
    got = spotsigs.edits(frame).collect()
    plain = {r.doc_id: r.fingerprint for r in spotsigs.fingerprints(frame).collect()}
    keyed = lambda r: (repr(r[0]), *r[1:])
    got_, want = sorted((keyed((r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next)) for r in got)), sorted(map(keyed, brute(rows, hashed)))
    assert [g[:3] for g in got_] == [w[:3] for w in want]
    assert [g[3:] for g in got_] == [pytest.approx(w[3:]) for w in want]
    return got, plain


def test_edits_are_brute_force(spark, monkeypatch):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    rows = list(enumerate(t[:3000] for t in texts)) + [(500, None), (501, ""), (502, LONG), (503, LONG), (504, " "), (None, "no id here"), (None, None), (700, "tie a"), (700, "tie b"), (700, "tie b"), (-3, "é" * 999)]
    for size in (4 << 20, 20_000, 1):  # one range, several, one for each row
        monkeypatch.setattr(spotsigs, "RANGE_BYTES", size)
        got, plain = checked(spark, rows)
        assert {r.fingerprint for r in got if r.n_chars == len(LONG)} == {plain[502]} == {plain[503]}
        assert next(r for r in got if r.doc_id == 502).near_next == 1.0


def test_one_row_equal_rows_and_none(spark):
    checked(spark, [(1, "alone with the words of one")])
    checked(spark, [(4, "The same text and the same id")] * 200 + [(5, "Another of the texts")])
    assert spotsigs.edits(spark.createDataFrame([], SCHEMA)).count() == 0


def test_half_replaced_is_nearer_than_the_next(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [r for r in spotsigs.edits(docs).collect() if r.n_chars > 400]
    assert np.mean([0.2 < r.near_edited < 1 for r in rows]) > 0.97
    assert np.mean([r.near_edited > r.near_next for r in rows]) > 0.97
    assert np.median([r.near_next for r in rows]) < 0.02
