"""Shards, archives, packing, decontamination, classifiers and the pipeline against brute force or round trips."""

import base64
import hashlib
import random
import zlib

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

import numpy as np  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from rinkline.llm import decontaminate, language_id, packing, sharding, toxicity, warc  # noqa: E402

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")
ROWS = [(1, "a b c"), (2, None), (3, ""), (4, "é" * 5000), (4, "é" * 5000), (None, "x"), (6, " ".join(f"word{i % 97}" for i in range(5000)))]


def _docs(spark, rows=ROWS):
    return spark.createDataFrame([(i, t, "c", 1) for i, t in rows], "doc_id long, text string, id string, shard int")


def test_shards(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id") % 50).alias("text"))
    got = sharding.assign_shards(docs, bucket_bytes=64).collect()
    assert sorted(r.doc_id for r in got) == list(range(500))
    for s in range(24):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert all(r.grown_shard in (r.shard, 24) and r.text_crc32 == zlib.crc32(f"t{r.doc_id % 50}".encode()) and r.size == len(f"t{r.doc_id % 50}") + 8 for r in got)
    again = {(r.doc_id, r.grown_shard) for r in sharding.assign_shards(docs.where("doc_id < 100"), shards=25).select("doc_id", F.col("shard").alias("grown_shard")).collect()}
    assert again == {(r.doc_id, r.grown_shard) for r in got if r.doc_id < 100}
    assert [r.doc_id for r in sorted(got, key=lambda r: (r.shard, r.slot))] != sorted(range(500))
    odd = sharding.assign_shards(_docs(spark)).collect()
    assert len(odd) == len(ROWS) and {r.size for r in odd if r.doc_id in (2, 3)} == {8}
    assert sharding.assign_shards(_docs(spark, [])).count() == 0


def test_write_shards(spark, tmp_path):
    docs = spark.range(200).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    sharding.write_shards(docs, str(tmp_path / "s"), shards=4)
    assert spark.read.parquet(str(tmp_path / "s")).count() == 200


def test_write_shards_keeps_every_row(spark, tmp_path):
    """Null ids, repeated ids and repeated rows: each row once, slots without gaps, the returned rows those of the files."""
    rows = ROWS + [(None, "x"), (None, None), (None, "y"), (6, "other"), (6, "other"), (6, "other")] + [(i % 40, f"t{i % 60}") for i in range(400)]
    for name, size in (("a", 64), ("b", 8 << 20)):
        path = str(tmp_path / name)
        got = sharding.write_shards(_docs(spark, rows), path, shards=5, bucket_bytes=size).collect()
        files = spark.read.parquet(path).collect()
        order = lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or "")
        assert sorted(((r.doc_id, r.text) for r in files), key=order) == sorted(rows, key=order) and {r.id for r in files} == {"c"}
        assert sorted((r.shard, r.slot, r.doc_id or 0) for r in got) == sorted((r.shard, r.slot, r.doc_id or 0) for r in files)
        for s in range(5):
            assert sorted(r.slot for r in files if r.shard == s) == list(range(sum(r.shard == s for r in files)))
        law = {(r.doc_id, r.size, r.text_crc32, r.law, r.shard, r.grown_shard) for r in sharding.assign_shards(_docs(spark, rows), shards=5).collect()}
        assert {(r.doc_id, r.size, r.text_crc32, r.law, r.shard, r.grown_shard) for r in got} == law
    assert sharding.write_shards(_docs(spark, []), str(tmp_path / "none")).count() == 0


def test_archives(spark):
    pages = spark.createDataFrame([(1, "u", "a"), (2, "v w\n", "a"), (3, None, None), (4, "", ""), (7, "k", "a"), (7, "k", "a"), (9, "o", "é" * 9999), (None, "n", "q")], "page_id long, url string, html string")
    got = {(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.round_trip(pages).collect()}
    name = lambda t: base64.b32encode(hashlib.sha1(t.encode()).digest()).decode()
    want = {(1, 1, name("a"), "revisit", 7), (2, 1, name("a"), "revisit", 7), (3, 0, name(""), "revisit", 4), (4, 0, name(""), "response", None), (7, 1, name("a"), "response", None), (9, 19998, name("é" * 9999), "response", None), (None, 1, name("q"), "response", None)}
    assert got == want
    assert {r.record_type for r in warc.round_trip(pages, revisit_from=2).collect()} == {"response"}
    assert warc.round_trip(pages.limit(0)).count() == 0
    with pytest.raises(ValueError):
        warc.parse(warc.record(1, "u", b"body", None, False).replace(b"body", b"bodx"))


def test_archives_of_pages_that_repeat_with_other_payloads(spark):
    rows = [(1, "A"), (2, "A"), (1, "B"), (1, "C"), (3, "C"), (2, "D"), (1, "A")]
    pages = spark.createDataFrame([(i, "u", t) for i, t in rows], "page_id long, url string, html string")
    name = lambda t: base64.b32encode(hashlib.sha1(t.encode()).digest()).decode()
    got = sorted((r.page_id, r.payload_digest, r.record_type, r.refers_to) for r in warc.round_trip(pages).collect())
    assert got == sorted((i, name(t), *(("revisit", {"A": 2, "C": 3}[t]) if i == 1 and t in "AC" else ("response", None))) for i, t in rows)


def test_archive_stands_alone(spark, tmp_path):
    import pyarrow.fs

    pages = spark.range(40).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.concat(F.lit("<html><body>the same words on every page "), F.col("id")).alias("html"))
    folder = f"file://{tmp_path}/w"
    index = warc.write_archives(pages, folder).collect()
    rows = [r for f in {r.archive for r in index} for r in warc.archive_records(pyarrow.fs.LocalFileSystem(), f"{tmp_path}/w/{f}")]
    assert sorted(r["page_id"] for r in rows) == list(range(40)) and all(r["payload"].startswith(b"<html>") for r in rows)


def test_packing(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    got = packing.pack(_docs(spark), PATH).collect()
    want = sorted((i is None, i or 0, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]) for i, t in ROWS)
    pieces = {}
    for r in got:
        ids = np.frombuffer(bytes(r.ids), dtype="<u4").tolist()
        assert len(ids) == r.length <= 2048 and zlib.crc32(bytes(r.ids)) == r.ids_crc32
        pieces.setdefault((r.doc_id is None, r.doc_id or 0, r.doc_tokens), []).append((r.start, ids))
    for none, i, ids in want:
        own = sorted(pieces[none, i, len(ids)])
        copies = sum(w[:2] == (none, i) for w in want)
        assert sum((p for _, p in own), []) == [x for s in range(0, len(ids), 2048) for x in ids[s : s + 2048] * copies]
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack(_docs(spark, []), PATH).count() == 0


def test_packing_takes_no_ids_into_a_bucket(spark):
    """A bucket is packed by lengths alone, and every piece gets its own ids back."""
    whole, narrow = packing.pack(_docs(spark), PATH, bucket_pieces=3), packing.pack(_docs(spark), PATH, bucket_pieces=3, with_ids=False)
    grouped = [x for x in whole._jdf.queryExecution().optimizedPlan().toString().splitlines() if "FlatMapGroupsInArrow" in x]
    assert len(grouped) == 1 and "length#" in grouped[0] and " ids#" not in grouped[0]
    assert whole.columns == [*narrow.columns[:5], "ids", *narrow.columns[5:]]
    key = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert sorted(map(repr, whole.select(key).collect())) == sorted(map(repr, narrow.select(key).collect()))
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in whole.collect())


def test_encoder_is_the_tokenizer():
    import pyarrow as pa
    from rinkline.llm._bytes import slices

    encoder, rnd = packing.Encoder(PATH), random.Random(1)
    assert encoder.quick is not None
    texts = ["", None, " a  b\n\n c <|endoftext|> x<|endoftext|>y it's", *("".join(rnd.choice("ab1,.'| \n\té　 <") for _ in range(rnd.randint(0, 40))) for _ in range(500))]
    for first, end, data, offsets in slices(pa.array(texts)):
        ids, at = encoder(data, offsets)
        for i in range(end - first):
            assert ids[at[i] : at[i + 1]].tolist() == encoder.tokenizer.encode(texts[first + i] or "", add_special_tokens=False).ids


def test_best_fit():
    lengths = sorted((random.Random(3).randint(1, 64) for _ in range(400)), reverse=True)
    sequences, offsets = packing.best_fit_decreasing(lengths, 64)
    rooms, want = [], []
    for n in lengths:  # brute force: the tightest sequence
        fits = [(room, s) for s, room in enumerate(rooms) if room >= n]
        if fits:
            room, s = min(fits)
        else:
            rooms.append(64)
            room, s = 64, len(rooms) - 1
        rooms[s] = room - n
        want.append(room)
    assert [64 - o for o in offsets] == want and max(sequences) + 1 == len(rooms)


def _edits(a, b):
    """Least edits of a against any stretch of b."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return min(row)


def test_decontamination(spark):
    rnd = random.Random(4)
    text = lambda n: " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 8))) for _ in range(n))
    items = [(i, text(25)) for i in range(12)] + [(90, "tiny item"), (91, None), (92, "  ")]
    docs, want = [], set()
    for i in range(80):
        body = text(60)
        if i % 4 == 0:
            item, phrase = items[i % 12]
            phrase = list(phrase.upper() if i % 8 == 0 else phrase)
            for _ in range(i % 5):
                phrase[rnd.randrange(len(phrase))] = "z"
            body = text(10) + "\n " + "".join(phrase) + " " + body
        docs.append((i, body))
    docs += [(200, None), (201, ""), (202, "a Tiny  item here"), (203, "tinyitem")]
    for i, t in docs:
        for k, p in items:
            p, t2 = (p or "").strip(), " ".join((t or "").lower().split())
            if p and (_edits(p, t2) <= int(decontaminate.EDITS * len(p)) if len(p) >= decontaminate.SHORT else f" {p} " in f" {t2} "):
                want.add((i, k))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(_docs(spark, docs), bench).collect()}
    assert got <= want and len(got) >= 0.95 * len(want)
    assert decontaminate.decontaminate(_docs(spark, docs), bench).count() == len(docs) - len({i for i, _ in got})
    assert decontaminate.contaminated(_docs(spark, []), bench).count() == 0
    assert decontaminate.contaminated(_docs(spark, docs), bench.limit(0)).count() == 0


def test_decontamination_without_blanks(spark):
    rnd = random.Random(12)
    han = lambda n: "".join(chr(rnd.randrange(0x4E00, 0x5E00)) for _ in range(n))
    code = lambda n: "".join(rnd.choice("abcdefghijklmnop+/=123456") for _ in range(n))
    items = [(i, (han(66) if i % 2 else code(200))) for i in range(20)]
    docs = [(i, f(300) + t + f(40)) for i, t in items for f in [han if i % 2 else code]] + [(50, han(400)), (51, code(900))]
    got = decontaminate.contaminated(_docs(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id, r.edits) for r in got} == {(i, i, 0) for i, _ in items}


@pytest.mark.parametrize("size", [45, 60, 100, 400, 1600, 3200])
def test_decontamination_reaches_its_recall(spark, size):
    """All allowed edits, mixed, at random places and evenly spread, held against brute force; no short item."""
    rnd = random.Random(size)
    word = lambda: "".join(rnd.choice("etaoinshrdlu") for _ in range(rnd.randint(2, 8)))
    text = lambda n: " ".join(word() for _ in range(n))[:n].rstrip() + "x"
    items, docs = [(i, text(size)) for i in range(40 if size < 1000 else 20)], []
    for i, t in items:
        out, n = list(t), int(decontaminate.EDITS * len(t))
        for k in reversed(range(n)):
            at, kind = (int((k + 0.5) * len(t) / n) if i % 2 else rnd.randrange(len(out))), rnd.randrange(3)
            out[at : at + (kind != 0)] = rnd.choice("etaoin") if kind < 2 else ""
        docs.append((i, text(100) + " " + "".join(out) + " " + text(100)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.edits for r in decontaminate.contaminated(_docs(spark, docs), bench).collect()}
    plain = lambda t: " ".join(t.split()).encode()
    want = {(i, k): best[0] for i, d in docs for k, t in items if (i == k or size < 1000) and (best := decontaminate.best_match(plain(t), plain(d), int(decontaminate.EDITS * len(plain(t)))))}
    assert set(got) <= set(want) and len(got) >= 0.97 * len(want) and len(want) >= 0.9 * len(items)
    assert sum(got[x] != want[x] for x in got) == 0


def test_decontamination_of_short_items(spark, monkeypatch):
    """Items of 20 to 39 bytes with one edit anywhere, in more blocks than one, against the edit distance of every stretch between blanks."""
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 2)
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(3, 7)))
    items = [(i, " ".join(word() for _ in range(10))[: 20 + 4 * i].strip()) for i in range(5)] + [(9, "a tiny one")]
    rows, want = [], set()
    for i, item in items:
        for kind in range(3 if len(item) >= 20 else 1):
            at = rnd.randrange(2, len(item) - 2)
            changed = [item, item[:at] + "z" + item[at + 1 :], item[:at] + item[at + 1 :]][kind]
            rows.append((10 * i + kind, f"{word()} {changed} {word()}"))
            want.add((10 * i + kind, i))
        rows.append((10 * i + 5, f"{word()} {item[:-3]}zzz {word()}"))
    rows.append((99, "not a tiny ones"))
    got = decontaminate.contaminated(_docs(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want


def test_best_match_is_the_edit_distance():
    rnd = random.Random(6)
    for _ in range(200):
        a = bytes(rnd.choice(b"abc") for _ in range(rnd.randint(1, 12)))
        b = bytes(rnd.choice(b"abc") for _ in range(rnd.randint(1, 30)))
        got = decontaminate.best_match(a, b, 12)
        assert got[0] == min(_edits(a, b), len(a))


def test_language(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.fit_documents(docs)
    got = language_id.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(language_id.held_out(F.col("doc_id"), 4, 2))
    assert got.where("lang = lang_pred").count() >= 0.95 * got.count()
    assert got.where("rejected").count() <= 0.02 * got.count()
    odd = {r.doc_id: r for r in language_id.identify(_docs(spark, [(1, None), (2, ""), (3, "12 34 --"), (4, "x"), (5, "日")]), model).collect()}
    assert [odd[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and odd[1].score == 0 and odd[4].lang_pred != "und" != odd[5].lang_pred
    assert language_id.identify(_docs(spark, []), model).count() == 0
    assert language_id.fit_documents(docs.limit(0)).languages == ["und"]


def test_toxicity(spark):
    rnd = random.Random(8)
    clean, bad = [f"w{i}x" for i in range(80)], ["vile", "nasty"]
    texts, labels = [], []
    for i in range(300):
        w = [rnd.choice(clean) for _ in range(rnd.randint(5, 90))]
        if i % 3 == 0:
            w[rnd.randrange(len(w))] = rnd.choice(bad)
        texts.append(" ".join(w))
        labels.append(int(i % 3 == 0))
    model = toxicity.train(texts[:200], labels[:200])
    got = toxicity.score(_docs(spark, [*enumerate(texts[200:]), (500, None), (501, "")]), model)
    rows = {r.doc_id: r for r in got.collect()}
    assert sum(rows[i].predicted == y for i, y in enumerate(labels[200:])) >= 95
    assert 0 <= rows[500].score == rows[501].score < 0.5
    assert toxicity.score(_docs(spark, []), model).count() == 0
    assert toxicity.train([], []).text_scores(np.zeros(0, dtype=np.uint8), np.array([0, 0])).shape == (1,)


def test_every_language_is_learned(spark):
    rows = [(100 * k + i, " ".join([chr(0x4E00 + 7 * k + j) for j in range(7)] * 5), f"l{k:03d}") for k in range(205) for i in range(3)]
    model = language_id.fit(spark.createDataFrame(rows, "id long, text string, lang string"))
    assert len(model.languages) == 205
    long = [(i, "the quick brown fox " * 2000, "en") for i in range(10)] + [(i + 10, "der schnelle braune fuchs " * 2000, "de") for i in range(10)]
    model = language_id.fit(spark.createDataFrame(long, "id long, text string, lang string"))
    got = language_id.identify(spark.createDataFrame([(1, "the brown fox"), (2, "der braune fuchs")], "doc_id long, text string"), model)
    assert {r.doc_id: r.lang_pred for r in got.collect()} == {1: "en", 2: "de"}


def test_toxicity_on_labels(spark):
    """Held-out rows of labels: most toxic rows score above most others."""
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    apart = language_id.held_out(F.col("doc_id"), 5, 0)
    model = toxicity.fit(docs.where(~apart).select(F.col("doc_id").alias("id"), "text"), labels.where(~apart).select(F.col("doc_id").alias("id"), F.col("toxic").alias("label")))
    rows = toxicity.score(docs.where(apart).join(labels.select("doc_id"), "doc_id", "left_semi"), model).join(labels.select("doc_id", "toxic"), "doc_id").select("toxic", "score").collect()
    bad, good = (np.array([r.score for r in rows if r.toxic == k]) for k in (1, 0))
    assert (bad[:, None] > good[None]).mean() > 0.9 and (good >= 0.5).mean() < 0.05


def test_gradients():
    model = toxicity.train(["a b", "c d"], [0, 0])
    rng = np.random.default_rng(0)
    for k, v in model.p.items():
        model.p[k] = rng.normal(0, 0.3, v.shape).astype(np.float64)
    x = rng.normal(size=(5, toxicity.WORD + toxicity.CHAR))
    ids, real = rng.integers(0, 5, (2, toxicity.WINDOW)), np.ones((2, toxicity.WINDOW), dtype=bool)
    real[1, 9:] = False
    error = np.array([1.0, -0.5])
    grads, dx = model.step(x, ids, real, error, model.run(x, ids, real, keep=True))
    loss = lambda: float(model.run(x, ids, real) @ error)
    for array, grad in [(model.p[k], grads[k]) for k in grads] + [(x, dx)]:
        at = tuple(int(rng.integers(n)) for n in array.shape)
        old = array[at]
        array[at] = old + 1e-3
        up = loss()
        array[at] = old - 1e-3
        down = loss()
        array[at] = old
        assert abs((up - down) / 2e-3 - np.asarray(grad)[at]) < 2e-3


def test_pipeline(spark):
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, [docs.count()]
    for _, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == columns
        seen.append(docs.count())
    assert seen[0] - seen[1] <= 2 and seen[1] > seen[2] >= seen[3] > seen[4] > 0.5 * seen[0]
    assert pipeline.pack(spark, docs, SF).select("doc_id").distinct().count() == seen[4]
    empty = pipeline.STAGES[2][1](spark, docs.limit(0), SF)
    assert empty.count() == 0


def test_pipeline_writes_token_ids(spark):
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(5)
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in pipeline.pack(spark, docs, SF).collect())


def test_pipeline_decides_by_row(spark):
    """Null ids, repeated rows and shared ids, each stage against brute force."""
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet").where("text is not null and doc_id is not null")
    rnd = random.Random(2)
    text = lambda n: " ".join("".join(rnd.choice("etaoinshrdlu") for _ in range(rnd.randint(2, 8))) for _ in range(n))
    make = lambda rows: spark.createDataFrame([(i, t, "x", "y", len(t)) for i, t in rows], docs.schema)
    rows = lambda df: sorted(((r.doc_id is None, r.doc_id or 0, r.text) for r in df.collect()))
    key = lambda found: sorted((i is None, i or 0, t) for i, t in found)

    good = docs.first()
    odd = make([(None, "12 34 --"), (None, "12 34 --"), (None, good.text), (good.doc_id, "56 78"), (good.doc_id, "56 78")])
    mixed = docs.unionByName(odd)
    model = language_id.fit_documents(mixed)
    refused = {r.text for r in language_id.identify(mixed.select(F.col("text").alias("doc_id"), "text"), model).withColumnRenamed("doc_id", "text").where("rejected").collect()}
    assert {"12 34 --", "56 78"} <= refused and good.text not in refused
    assert rows(pipeline.identify_languages(spark, mixed, SF)) == [x for x in rows(mixed) if x[2] not in refused]

    a, b, c, d = (text(30) for _ in range(4))
    given = [(7, a), (7, a), (None, a), (None, b), (None, b), (3, c + " "), (3, c), (5, c), (3, d)]
    assert rows(pipeline.drop_exact_copies(spark, make(given), SF)) == key([(7, a), (None, b), (3, c + " "), (3, d)])
    near = [(9, a + " one"), (4, a + " two"), (None, a), (None, b), (None, b), (None, b + " end"), (4, c), (4, c), (8, d)]
    left = rows(pipeline.drop_near_copies(spark, make(near), SF))
    assert [x for x in left if x[2][:200] != b[:200] and not x[2].startswith(b)] == key([(4, a + " two"), (4, c), (8, d)]) and sum(x[2].startswith(b) for x in left) == 1
    item = spark.read.parquet(f"{SF}/benchmark.parquet").where("length(text) > 60").first().text
    leaks = [(None, a + " " + item), (None, a), (6, item), (6, b), (6, b)]
    assert rows(pipeline.decontaminate(spark, make(leaks), SF)) == key([(None, a), (6, b), (6, b)])


@pytest.mark.parametrize("texts, labels", [
    (["the same text"] * 10, ["de", "en"] * 5), (["x " * 200] * 4, ["a", "b", "a", "b"]), (["aaaa"] * 50 + ["bbbb"] * 3, ["q"] * 50 + ["r"] * 3), ([""] * 4, ["a", "b"] * 2), (["word"], ["a"]),
    ([" ".join(random.Random(k).choices(["a", "bb", "ccc"], k=1 + k % 40)) for k in range(90)], [random.Random(-k).choice("abc") for k in range(90)]),
])
def test_language_training_stays_finite(texts, labels):
    """Contradicting labels, repetitive and few texts."""
    model = language_id.train(texts, labels)
    data = np.frombuffer(b"the same x x word aaaa", dtype=np.uint8)
    p = model.probabilities(data, np.array([0, 8, len(data)]))
    assert np.isfinite(model.scores).all() and np.isfinite(p).all() and p.sum(axis=1) == pytest.approx([1, 1])


def test_scores_that_are_no_numbers_are_rejected(spark):
    model = language_id.train(["ein Text", "a text"] * 20, ["de", "en"] * 20)
    model.bias = model.bias * np.nan
    assert [r.rejected for r in language_id.identify(spark.createDataFrame([(1, "a text")], "doc_id long, text string"), model).collect()] == [True]


def test_pages_without_ids_revisit(spark):
    rows = [(None, "u", "same"), (None, "v", "same"), (3, "w", "same"), (9, "x", "same"), (None, "y", "only"), (None, "z", "only"), (0, "o", "zero"), (None, "p", "zero")]
    got = warc.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string"), revisit_from=0).collect()
    assert sorted((repr(r.page_id), r.record_type, r.refers_to) for r in got if r.payload_bytes == 4 and r.refers_to == 9) == [("3", "revisit", 9), ("None", "revisit", 9), ("None", "revisit", 9)]
    assert sorted((repr(r.page_id), r.record_type, r.refers_to) for r in got if r.refers_to != 9) == sorted([("9", "response", None), ("None", "response", None), ("None", "response", None), ("0", "response", None), ("None", "revisit", 0)], key=repr)


def test_equal_rows_are_spread(spark, tmp_path):
    """Thousands of rows with one id and one text fill no bucket of packing and no bucket of sharding alone."""
    docs = spark.createDataFrame([(7, "the same words", "x", 1)] * 3000, "doc_id long, text string, id string, shard int")
    packed = packing.pack(docs, PATH, bucket_pieces=100).collect()
    buckets = -(-3000 // 100)
    assert len(packed) == 3000 and max(sum(r.sequence_id % buckets == b for r in packed) for b in range(buckets)) < 200
    got = sharding.write_shards(docs, f"file://{tmp_path}/shards", bucket_bytes=64).collect()
    assert len({r.shard for r in got}) == 1 and sorted(r.slot for r in got) == list(range(3000))


def test_other_pre_tokenizers_take_no_shortcut(tmp_path):
    """The quick encoder stands only for the split rule and normaliser it knows."""
    import json

    known = json.loads(open(PATH).read())
    for change in ({"normalizer": {"type": "Lowercase"}}, {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": True, "use_regex": True}}, {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}}):
        path = tmp_path / "other.json"
        path.write_text(json.dumps(known | change))
        assert packing.Encoder(str(path)).quick is None
    assert packing.Encoder(PATH).quick is not None


def test_walks_short_of_the_recall_are_an_error(monkeypatch):
    item = "an item of the benchmark that is long enough for the segments of a walk to be drawn from it"
    monkeypatch.setattr(decontaminate, "MOST_WALKS", 0)
    with pytest.raises(ValueError):
        decontaminate.Items([(1, item)])
