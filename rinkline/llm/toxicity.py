"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

Every word enters as the embedding of the word (if it was seen in training) and
the mean of embeddings of its hashed character trigrams.  Two gated recurrent
layers read a window of words, one from each side; attention pools their states
into one score.  All overlapping windows of a text are scored, and the text's
score is that of its worst window, calibrated.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rinkline.llm._bytes import prefix_hash, slices, span_hash, byte_symbols
from rinkline.llm._shared import stored
from rinkline.llm.language_id import _SEEN

#: Words of a window and words from one window's start to the next: every word lies in two windows.
WINDOW, STRIDE = 24, 12
#: Labelled rows of each kind that are learned from at most, and the longest of them in bytes.
ROWS_PER_LABEL, LONGEST_ROW = 1500, 12_000
#: Documents of the sample that a word must occur in to have an embedding of its own.
LEAST_DOCUMENTS = 3
#: Share of the sample that is held back from training for the calibration.
HELD = 0.1
CHARS, WORD, CHAR, HIDDEN = 1 << 12, 8, 4, 8


def letter_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, starts and ends of their runs of letters, and for each row the number of runs before it."""
    low = _SEEN[data]
    solid = low != 32
    start = solid.copy()
    start[1:] &= ~solid[:-1]
    inner = offsets[:-1][offsets[:-1] < len(data)]
    start[inner] = solid[inner]
    end = solid.copy()
    end[:-1] &= start[1:] | ~solid[1:]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return low, starts, ends, np.searchsorted(starts, offsets)


def trigram_means(low: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Mean of table over the hashed trigrams (with an edge on both sides) of each word."""
    size = ends - starts
    begin = np.cumsum(size + 2) - (size + 2)
    edged = np.full(int((size + 2).sum()), 94, dtype=np.uint32)  # edges
    to = np.repeat(begin + 1, size) + np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    edged[to] = low[np.repeat(starts, size) + np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)]
    if not len(size):
        return np.zeros((0, table.shape[1]), dtype=np.float32)
    code = edged.copy()
    code[:-2] = (code[:-2] * np.uint32(0x01000193) + edged[1:-1]) * np.uint32(0x01000193) + edged[2:]
    bucket = ((code * np.uint32(0x9E3779B1)) >> np.uint32(20)).astype(np.int64) % len(table)
    valid = np.ones(len(edged), dtype=bool)
    valid[begin + size] = valid[begin + size + 1] = False
    sums = np.add.reduceat(table[bucket[valid]], np.cumsum(size) - size, axis=0)
    return sums / size[:, None].astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


@dataclasses.dataclass
class ToxicityModel:
    known: np.ndarray  # sorted hashes of the words with embeddings
    p: dict[str, np.ndarray]
    scale: float = 1.0
    shift: float = 0.0

    def inputs(self, low: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Network inputs of some words, and their rows in the word table (0: unknown)."""
        at = np.minimum(np.searchsorted(self.known, hashes), max(0, len(self.known) - 1))
        row = np.where(self.known[at] == hashes, at + 1, 0) if len(self.known) else np.zeros(len(hashes), dtype=np.int64)
        return np.concatenate([self.p["word"][row], trigram_means(low, starts, ends, self.p["char"])], axis=1).astype(np.float32), row

    def run(self, x: np.ndarray, ids: np.ndarray, real: np.ndarray, keep: bool = False):
        """Scores of windows: ids (windows, WINDOW) are rows of x, real tells which places hold words. keep: all states, for training."""
        p, n = self.p, len(ids)
        states, trace = [], {}
        for side in ("f", "b"):
            gates = x @ p[side + "x"] + p[side + "c"]
            h = np.zeros((n, HIDDEN), dtype=np.float32)
            out = np.empty((WINDOW, n, HIDDEN), dtype=np.float32)
            u = p[side + "h"]
            for t in range(WINDOW) if side == "f" else range(WINDOW - 1, -1, -1):
                g = gates[ids[:, t]]
                a = h @ u
                zr = _sigmoid(g[:, : 2 * HIDDEN] + a[:, : 2 * HIDDEN])
                z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
                c = np.tanh(g[:, 2 * HIDDEN :] + r * a[:, 2 * HIDDEN :])
                new = c + z * (h - c)
                new = np.where(real[:, t, None], new, h)
                if keep:
                    trace[side, t] = (h, z, r, c, a[:, 2 * HIDDEN :])
                h = new
                out[t] = h
            states.append(out)
        both = np.concatenate(states, axis=2)
        e = both @ p["att"]
        e = np.where(real.T, e, -1e9)
        e -= e.max(axis=0)
        w = np.exp(e)
        w /= w.sum(axis=0)
        pooled = np.einsum("tn,tnh->nh", w, both)
        score = pooled @ p["out"] + p["bias"][0]
        return (score, both, w, pooled, trace) if keep else score

    def step(self, x: np.ndarray, ids: np.ndarray, real: np.ndarray, error: np.ndarray, kept) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients of the parameters and of x for d loss / d score = error."""
        p, (_, both, w, pooled, trace) = self.p, kept
        g = {k: np.zeros_like(v) for k, v in p.items() if k not in ("word", "char")}
        g["out"], g["bias"] = pooled.T @ error, np.array([error.sum()], dtype=np.float32)
        dpool = error[:, None] * p["out"]
        dboth = w[:, :, None] * dpool[None]
        dw = np.einsum("tnh,nh->tn", both, dpool)
        de = w * (dw - (w * dw).sum(axis=0))
        g["att"] = np.einsum("tnh,tn->h", both, de)
        dboth = dboth + de[:, :, None] * p["att"]
        dx = np.zeros_like(x)
        for s, side in enumerate(("f", "b")):
            dh, u = np.zeros((len(ids), HIDDEN), dtype=np.float32), p[side + "h"]
            for t in range(WINDOW - 1, -1, -1) if side == "f" else range(WINDOW):
                h, z, r, c, an = trace[side, t]
                dh = dh + dboth[t, :, s * HIDDEN : (s + 1) * HIDDEN]
                live = dh * real[:, t, None]
                dz, dc = live * (h - c) * z * (1 - z), live * (1 - z) * (1 - c * c)
                dr = dc * an * r * (1 - r)
                dg = np.concatenate([dz, dr, dc], axis=1)
                da = np.concatenate([dz, dr, dc * r], axis=1)
                g[side + "h"] += h.T @ da
                g[side + "c"] += dg.sum(axis=0)
                g[side + "x"] += x[ids[:, t]].T @ dg
                np.add.at(dx, ids[:, t], dg @ p[side + "x"].T)
                dh = dh * ~real[:, t, None] + live * z + da @ u.T
        return g, dx

    def text_scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Calibrated scores of the rows of a slice."""
        low, starts, ends, bounds = letter_words(data, offsets)
        hashes = span_hash(prefix_hash(byte_symbols(low)), starts, ends)
        every, first, of = np.unique(hashes, return_index=True, return_inverse=True)
        x, _ = self.inputs(low, starts[first], ends[first], every)
        x = np.concatenate([x, np.zeros((1, x.shape[1]), dtype=np.float32)])
        row, ids, real = windows(of, bounds, len(x) - 1)
        score = np.concatenate([self.run(x, ids[s : s + 8192], real[s : s + 8192]) for s in range(0, len(ids), 8192)]) if len(ids) else np.zeros(0)
        worst = np.maximum.reduceat(score, np.flatnonzero(np.append(True, row[1:] != row[:-1])))
        return _sigmoid(self.scale * worst.astype(np.float64) + self.shift)


def windows(of: np.ndarray, bounds: np.ndarray, blank: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of some rows (one of blanks for a row without words): row, word ids, which are real."""
    size = np.diff(bounds)
    count = np.maximum(1, -(-(size - WINDOW) // STRIDE) + 1)
    row = np.repeat(np.arange(len(size)), count)
    start = (np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)) * STRIDE
    place = start[:, None] + np.arange(WINDOW)
    real = place < size[row][:, None]
    at = np.minimum(bounds[:-1][row][:, None] + place, max(0, len(of) - 1))
    return row, np.where(real, of[at] if len(of) else blank, blank), real


def train(texts: list[str], labels: list[int], epochs: int = 5, rate: float = 0.02, batch: int = 64, seed: int = 9) -> ToxicityModel:
    """A model from texts with labels 0 and 1. A text's label is that of its worst window, as the network sees it so far."""
    rng = np.random.default_rng(seed)
    y = np.array(labels, dtype=np.float32)
    data = [t.encode("utf-8") for t in texts]
    raw = np.frombuffer(b"".join(data), dtype=np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in data])]).astype(np.int64)
    low, starts, ends, bounds = letter_words(raw, offsets)
    hashes = span_hash(prefix_hash(byte_symbols(low)), starts, ends)
    every, first, of = np.unique(hashes, return_index=True, return_inverse=True)
    held = rng.random(len(texts)) < HELD  # for the calibration
    if len(texts) and (y[~held].min(initial=1) == y[~held].max(initial=0) or y[held].min(initial=1) == y[held].max(initial=0)):
        held[:] = False
    doc = np.repeat(np.arange(len(texts)), np.diff(bounds))
    learned = ~held[doc]
    pair = np.unique(of[learned] * np.int64(len(texts) + 1) + doc[learned])
    bad = np.bincount(pair // (len(texts) + 1), weights=y[pair % (len(texts) + 1)], minlength=len(every))
    seen = np.bincount(pair // (len(texts) + 1), minlength=len(every))
    often = seen >= LEAST_DOCUMENTS
    known = every[often]
    base = float(y[~held].mean()) if len(y) else 0.5
    odds = np.log((bad + 2 * base + 1e-6) / (seen - bad + 2 * (1 - base)) * (1 - base + 1e-6) / (base + 1e-6))[often]
    normal = lambda *shape, s=0.3: rng.normal(0, s, shape).astype(np.float32)
    word = normal(len(known) + 1, WORD, s=0.05)
    word[1:, 0] += odds / 2  # a word begins with what its documents say of it
    word[0] = 0
    width = WORD + CHAR
    p = {"word": word, "char": normal(CHARS, CHAR, s=0.05), "att": normal(2 * HIDDEN), "out": normal(2 * HIDDEN), "bias": np.array([-1], dtype=np.float32)}
    for side in ("f", "b"):
        p[side + "x"], p[side + "h"], p[side + "c"] = normal(width, 3 * HIDDEN), normal(HIDDEN, 3 * HIDDEN), np.zeros(3 * HIDDEN, dtype=np.float32)
    model = ToxicityModel(known, p)
    if not len(texts) or y.min() == y.max():
        p["out"][:], p["bias"][0] = 0, 4 if len(texts) and y[0] else -4
        return model
    row, ids, real = windows(of, bounds, len(every))
    begin = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
    count = np.diff(np.append(begin, len(row)))
    m = {k: np.zeros_like(v) for k, v in p.items()}
    v = {k: np.zeros_like(v) for k, v in p.items()}
    done = 0

    def adam(k: str, grad: np.ndarray) -> None:
        m[k] += 0.1 * (grad - m[k])
        v[k] += 0.01 * (grad * grad - v[k])
        p[k] -= rate * (m[k] / (1 - 0.9**done)) / (np.sqrt(v[k] / (1 - 0.99**done)) + 1e-6)

    def local(docs: np.ndarray):
        at = np.repeat(begin[docs], count[docs]) + np.arange(int(count[docs].sum())) - np.repeat(np.cumsum(count[docs]) - count[docs], count[docs])
        own, back = np.unique(ids[at], return_inverse=True)
        words = own[own < len(every)]
        x, rows = model.inputs(low, starts[first[words]], ends[first[words]], every[words])
        x = np.concatenate([x, np.zeros((1, width), dtype=np.float32)])
        return words, rows, x, np.minimum(back.reshape(-1, WINDOW), len(x) - 1), real[at], np.cumsum(count[docs]) - count[docs]

    for _ in range(epochs):
        order = rng.permutation(np.flatnonzero(~held))
        for s in range(0, len(order), batch):
            docs = order[s : s + batch]
            words, rows, x, here, live, at = local(docs)
            score = model.run(x, here, live)
            worst = np.array([a + int(np.argmax(score[a : a + n])) for a, n in zip(at, count[docs])])
            kept = model.run(x, here[worst], live[worst], keep=True)
            error = ((_sigmoid(kept[0]) - y[docs]) / len(docs)).astype(np.float32)
            grads, dx = model.step(x, here[worst], live[worst], error, kept)
            done += 1
            for k, grad in grads.items():
                adam(k, grad)
            dword = np.zeros_like(p["word"])
            np.add.at(dword, rows, dx[:-1, :WORD])
            dword[0] = 0
            adam("word", dword)
            p["word"][0] = 0
    final = np.concatenate([np.maximum.reduceat(model.run(x, here, live), at) for _, _, x, here, live, at in (local(np.arange(s, min(s + 256, len(texts)))) for s in range(0, len(texts), 256))])
    # calibration: a logistic fit of the labels on the worst scores of the rows held back, or of all where these show one label only
    if held.any():
        final, y = final[held], y[held]
    a, b = 1.0, 0.0
    for _ in range(400):
        d = _sigmoid(a * final + b) - y
        a, b = a - 0.5 * float((d * final).mean()) / (1 + float((final**2).mean()) / 4), b - 0.5 * float(d.mean())
    model.scale, model.shift = max(a, 1e-3), b
    return model


def fit(docs: DataFrame, labels: DataFrame, rows_per_label: int = ROWS_PER_LABEL) -> ToxicityModel:
    """A model from docs (id, text) and labels (id, label): at most about rows_per_label rows of each label, chosen by a hash of the id.

    Null ids, texts and labels are left out, and so are texts of more than LONGEST_ROW bytes; of labels that differ the greatest counts.
    Where rows repeat ids so often that there would be more, no more than four times rows_per_label go to the driver.
    """
    labels = labels.where("id is not null and label is not null").groupBy("id").agg(F.max("label").alias("label"))
    counts = {r["label"]: r["count"] for r in labels.groupBy("label").count().collect() if r["label"] in (0, 1)}
    draw = F.pmod(F.xxhash64("id", F.lit(23)), F.lit(1 << 30)) / float(1 << 30)
    chosen = F.lit(False)
    for label, n in counts.items():
        chosen = chosen | ((F.col("label") == label) & (draw < min(1.0, rows_per_label / n)))
    picked = stored(labels.where(chosen), "labels")
    sample = docs.where(F.octet_length("text") <= LONGEST_ROW).join(F.broadcast(picked), "id").select("text", F.col("label").cast("int").alias("label")).limit(4 * rows_per_label).collect()
    sample.sort()
    return train([r.text for r in sample], [r.label for r in sample])


def _score(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    m: ToxicityModel = model.value
    for batch in batches:
        for first, end, data, offsets in slices(batch.column(1), 1 << 20):
            score = m.text_scores(data, offsets)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), pa.array(score, pa.float64()), pa.array((score >= 0.5).astype(np.int32))], ["id", "score", "predicted"])


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, score (0 to 1), predicted (1 from 0.5 on).

    * Null and empty texts are scored as one window without words.
    * Texts of any length are scored in all their windows.
    * Null and repeated ids give a row each; an empty table gives an empty result.

    Spark: a scan with a broadcast model of bounded size; nothing is shuffled.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(partial(_score, model=docs.sparkSession.sparkContext.broadcast(model)), f"id {kind}, score double, predicted int")
    return out.withColumnRenamed("id", id_col)
