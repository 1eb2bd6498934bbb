"""Cross-tokenizer alignment against brute force, its bitmaps against plain lists."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from rinkline.llm import _bitmaps, alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, lang string, pair long, row long"


def brute(texts):
    """One tuple for each text, and (documents, links) of every pair; all token pairs of a text are looked at."""
    import sentencepiece
    from tokenizers import Tokenizer

    first, second = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    first.encode_special_tokens = True
    a_bytes, b_bytes = alignment.byte_level_tokens(A), alignment.piece_tokens(second)
    rows, holders, count = [], defaultdict(set), Counter()
    for at, text in enumerate(texts):
        a, b = (first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)) if text else ([], [])
        whole = b" " + (text or "").encode()
        if b"".join(a_bytes[i] for i in a) != whole or b"".join(b_bytes[i] for i in b) != whole:
            a, b = [], []
        spans = []
        for ids, size in ((a, a_bytes), (b, b_bytes)):
            ends = np.cumsum([len(size[i]) for i in ids]).tolist()
            spans.append(list(zip([0, *ends[:-1]], ends, ids)))
        links = [(x[2], y[2]) for x in spans[0] for y in spans[1] if x[0] < y[1] and y[0] < x[1]]
        cuts = sorted({x[1] for x in spans[0]} & {y[1] for y in spans[1]})
        groups = ["|".join(",".join(str(i) for s, e, i in side if begin <= s and e <= end) for side in spans) for begin, end in zip([0, *cuts[:-1]], cuts)]
        for pair in links:
            holders[pair].add(at)
            count[pair] += 1
        rows.append((len(a), len(b), len(cuts), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    most = defaultdict(int)
    for (_, y), k in count.items():
        most[y] = max(most[y], k)
    found = [(a, b, g, len(links), sum(count[p] == most[p[1]] for p in links), sum(count[p] for p in links), sha) for a, b, g, links, sha in rows]
    return found, {p: (len(holders[p]), k, k == most[p[1]]) for p, k in count.items()}


ODD = [None, "", " ", "  ", "▁ ▁", "<|endoftext|> <s> </s>", "a  b\n\n\tc  ", "\x00z", "日本語 テスト 🎉", "ﬁ ① naïve façade", "x" * 3000, "the the the the", "it's we'll 'd '  's", "tab\tand no-break 　 wide"]


@pytest.fixture(scope="module")
def rows(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    texts = [t[:400] for t in texts if t] + ODD
    texts = texts * (2 * alignment.SPAN // len(texts) + 1)  # more than one container
    return [(None if i % 97 == 0 else i // 2, t, "en", 1, 2) for i, t in enumerate(texts)]


def test_alignment_is_brute_force(spark, rows):
    found = alignment.Alignment(spark.createDataFrame(rows, SCHEMA).coalesce(1), A, B)
    want, pairs = brute([r[1] for r in rows])
    got = [tuple(r) for r in found.scores().select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()]
    assert sorted(map(repr, got)) == sorted(repr((r[0], *w)) for r, w in zip(rows, want))
    assert {(r.a, r.b): (r.docs, r["count"], r.best) for r in found.pairs.collect()} == pairs


def test_pairs_beyond_a_broadcast(spark, rows, monkeypatch):
    monkeypatch.setattr("rinkline.llm._shared.BROADCAST_ROWS", 10)
    monkeypatch.setattr(alignment, "OPEN_CONTAINERS", 0)
    found = alignment.Alignment(spark.createDataFrame(rows, SCHEMA).repartition(3), A, B)
    want, _ = brute([r[1] for r in rows])
    got = [tuple(r) for r in found.scores().select("doc_id", "n_best", "count_sum").collect()]
    assert sorted(map(repr, got)) == sorted(repr((r[0], *w[4:6])) for r, w in zip(rows, want))


def test_empty_table(spark):
    found = alignment.Alignment(spark.createDataFrame([], SCHEMA), A, B)
    assert found.scores().count() == 0 and found.pairs.count() == 0


def test_other_byte_level_file_without_shortcuts():
    """Where the tokenizers don't part texts at blanks, whole texts are linked, with the same result."""
    cached, plain = alignment.CachedAligner(A, B), alignment.CachedAligner(A, B)
    plain.apart = False
    text = [b" The same words, the same  links.", b"", b" again the same words"]
    data, at = np.frombuffer(b"".join(text), dtype=np.uint8), np.cumsum([0, *map(len, text)])
    for x, y in zip(cached(data, at), plain(data, at)):
        assert sorted(list(x)) == sorted(list(y))


def test_bitmaps_come_back():
    rng = np.random.default_rng(5)
    sizes = np.append(rng.integers(1, 300, 60), [1, 64, 63, 1024])
    members = np.concatenate([np.sort(rng.choice(1024, s, replace=False)) for s in sizes])
    back, n = _bitmaps.unpack_sets(_bitmaps.pack_sets(members, sizes, 1024), 1024)
    assert (back == members).all() and (n == sizes).all()
    values = np.where(rng.random(len(members)) < 0.8, 0, rng.integers(0, 1000, len(members)))
    column, planes = _bitmaps.pack_planes(values, sizes)
    assert (_bitmaps.unpack_planes(column.slice(1), sizes[1:], planes[1:]) == values[sizes[0] :]).all()
