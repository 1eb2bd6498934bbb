"""Language identification with averaged hashed subword embeddings and a linear softmax.

A text is the mean of the embeddings of its hashed byte n-grams; a linear
softmax over that mean gives the language.  Both are trained together by
stochastic gradient descent in numpy on a bounded sample.  A temperature fitted
on held-back rows calibrates the probabilities, and a text is rejected below a
probability that all but a set share of rightly labelled texts reach.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rinkline.llm._bytes import slices
from rinkline.llm._shared import discard, if_small, stored

#: Labelled rows that are learned from at most for each language and for all, and the pieces of a longer text that are learned from, with their characters.
ROWS_PER_LANGUAGE, ROWS, PIECES, PIECE = 800, 40_000, 4, 1_000
BUCKETS, WIDTH, ORDERS = 1 << 15, 16, (2, 3, 4)
#: Share of rightly labelled texts that calibrated rejection may lose.
LOST_SHARE = 0.0005
UNKNOWN = "und"
#: Length of a training step up to which it is taken whole.
MOST_STEP = 3.0

#: Bytes as the n-grams see them: A-Z as a-z, letters and bytes beyond ASCII as they are, all else a space.
_SEEN = np.full(256, 32, dtype=np.uint8)
_SEEN[97:123] = np.arange(97, 123)
_SEEN[65:91] = np.arange(97, 123)
_SEEN[128:] = np.arange(128, 256)


def subwords(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """For each order the bucket of the n-gram that begins at each byte; 0 where it would leave its text or is a space."""
    seen = _SEEN[data].astype(np.uint32)
    ends = offsets[1:][np.diff(offsets) > 0]
    begins = offsets[:-1][np.diff(offsets) > 0]
    out, code = [], seen.copy()
    for n in range(2, max(ORDERS) + 1):
        code[: len(code) - n + 1] = code[: len(code) - n + 1] * np.uint32(0x01000193) + seen[n - 1 :] if len(code) >= n else 0
        if n in ORDERS:
            bucket = ((code * np.uint32(0x9E3779B1)) >> np.uint32(17)).astype(np.int32) % BUCKETS
            bucket[seen == 32] = 0
            for k in range(1, n):
                at = ends - k
                bucket[at[at >= begins]] = 0
            out.append(bucket)
    return out


@dataclasses.dataclass
class LanguageModel:
    """scores: for each bucket what its n-gram adds to each language (the first bucket adds nothing)."""

    languages: list[str]
    scores: np.ndarray
    bias: np.ndarray
    temperature: float
    least: float

    def probabilities(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        rows, k = len(offsets) - 1, len(self.languages)
        total, count = np.zeros((rows, k)), np.zeros(rows)
        filled = np.flatnonzero(np.diff(offsets))
        if len(filled):
            for bucket in subwords(data, offsets):
                total[filled] += np.add.reduceat(self.scores[bucket], offsets[:-1][filled], axis=0, dtype=np.float64)
                count[filled] += np.add.reduceat((bucket != 0).astype(np.int64), offsets[:-1][filled])
        logits = (total / np.maximum(count, 1)[:, None] + self.bias) / self.temperature
        logits -= logits.max(axis=1, keepdims=True)
        out = np.exp(logits)
        return out / out.sum(axis=1, keepdims=True)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _clipped(step: np.ndarray, axis: int | None) -> np.ndarray:
    """A step, shortened to MOST_STEP (each row of it with axis 1): where few n-grams fill a text, or labels contradict each other, whole steps would grow without end."""
    return step / np.maximum(1, np.sqrt((step * step).sum(axis=axis, keepdims=True)) / MOST_STEP)


def train(texts: list[str], labels: list[str], epochs: int = 4, least_steps: int = 400, rate: float = 1.0, batch: int = 64, seed: int = 3) -> LanguageModel:
    """A model from labelled texts; pieces of 80 to 800 bytes are drawn from all over each text."""
    rng = np.random.default_rng(seed)
    languages = sorted(set(labels))
    if not languages:
        return LanguageModel([UNKNOWN], np.zeros((BUCKETS, 1), dtype=np.float32), np.zeros(1), 1.0, 0.0)
    number = {x: i for i, x in enumerate(languages)}
    examples: list[tuple[np.ndarray, int, bool]] = []
    for text, label in zip(texts, labels):
        raw = np.frombuffer(text.encode("utf-8"), dtype=np.uint8)
        held = rng.random() < 0.2
        for _ in range(1 if held else 3):
            size = int(rng.integers(80, 800))
            at = int(rng.integers(0, max(1, len(raw) - size)))
            piece = raw[at : at + size]
            if not len(piece):
                continue
            grams = np.concatenate(subwords(piece, np.array([0, len(piece)])))
            if (grams := grams[grams > 0]).size:
                examples.append((grams, number[label], held))
    k = len(languages)
    table = rng.normal(0, 0.3, (BUCKETS, WIDTH)).astype(np.float32)
    linear, bias = np.zeros((WIDTH, k), dtype=np.float32), np.zeros(k, dtype=np.float32)
    learn = [i for i, e in enumerate(examples) if not e[2]]
    epochs = max(epochs, -(-least_steps * batch // max(1, len(learn))))
    steps, done = max(1, epochs * len(learn)), 0
    for _ in range(epochs):
        rng.shuffle(learn)
        for s in range(0, len(learn), batch):
            part = [examples[i] for i in learn[s : s + batch]]
            every, at = np.unique(np.concatenate([g for g, _, _ in part]), return_inverse=True)
            row = np.repeat(np.arange(len(part)), [len(g) for g, _, _ in part])
            share = np.bincount(row * len(every) + at, minlength=len(part) * len(every)).reshape(len(part), -1).astype(np.float32)
            share /= share.sum(axis=1, keepdims=True)
            mean = share @ table[every]
            error = _softmax(mean @ linear + bias)
            error[np.arange(len(part)), [y for _, y, _ in part]] -= 1
            error *= rate * (1 - done / steps) / len(part)
            back = error @ linear.T
            linear -= _clipped(10 * mean.T @ error, None)
            bias -= error.sum(axis=0)
            table[every] -= _clipped(300 * share.T @ back, 1)  # an n-gram has a small share of a mean
            done += len(part)
    scores = table @ linear
    scores[0] = 0
    if not (np.isfinite(scores).all() and np.isfinite(bias).all()):
        raise FloatingPointError("training diverged")
    tests = [e for e in examples if e[2]] or examples
    logits = np.array([scores[g].mean(axis=0) + bias for g, _, _ in tests]) if tests else np.zeros((0, k))
    truth = np.array([y for _, y, _ in tests], dtype=int)
    temperature, least = 1.0, 0.0
    if len(tests):
        grid = np.geomspace(0.1, 5, 40)
        loss = [-np.log(_softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean() for t in grid]
        temperature = float(grid[int(np.argmin(loss))])
        p = _softmax(logits / temperature)
        right = p.argmax(axis=1) == truth
        if right.any():
            least = float(min(0.5, 0.9 * np.quantile(p.max(axis=1)[right], LOST_SHARE)))
    return LanguageModel(languages, scores.astype(np.float32), bias.astype(np.float64), temperature, least)


def held_out(record_id: Column, parts: int, part: int) -> Column:
    """Whether the CRC-32 of the id as text leaves this remainder; rows without an id are held out."""
    return F.coalesce(F.crc32(record_id.cast("string").cast("binary")) % parts == part, F.lit(True))


def fit(rows: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE) -> LanguageModel:
    """A model from rows (id, text, lang) of every language: about rows_per_language rows of each, fewer where that makes more than ROWS in all.

    Rows are chosen by a hash of id and text.  Those without text or language
    are left out.  Of a text longer than PIECES times PIECE characters so many
    pieces, at places that the hash draws, stand for it, so at most 1.5 times
    ROWS such texts go to the driver, and all languages are learned.
    """
    rows = rows.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    counts = stored(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "languages")
    each = max(1.0, min(rows_per_language, ROWS / max(1, counts.count())))
    draw = F.pmod(F.xxhash64("id", "text", F.lit(17)), F.lit(1 << 30)) / float(1 << 30)
    chosen = rows.join(if_small(counts), "lang").where(draw < F.lit(each) / F.col("n"))
    place = lambda k: 1 + F.pmod(F.xxhash64("text", F.lit(k)), F.length("text") - PIECE + 1)
    pieces = F.concat_ws(" ", *(F.substring("text", place(k), F.lit(PIECE)) for k in range(PIECES)))
    learned = F.when(F.length("text") <= PIECES * PIECE, F.col("text")).otherwise(pieces)
    sample = chosen.select(learned.alias("text"), "lang").limit(int(1.5 * ROWS)).collect()
    discard(counts)
    sample.sort()
    return train([r.text for r in sample], [r.lang for r in sample])


def _predict(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    m: LanguageModel = model.value
    names = np.array(m.languages, dtype=object)
    for batch in batches:
        for first, end, data, offsets in slices(batch.column(1)):
            p = m.probabilities(data, offsets)
            best, score = names[p.argmax(axis=1)], p.max(axis=1)
            letters = np.concatenate([[0], np.cumsum((_SEEN[data] != 32) & (data < 128))])
            for i in np.flatnonzero(letters[offsets[1:]] == letters[offsets[:-1]]):
                # no ASCII letter: look at the characters
                if not any(c.isalpha() for c in data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace")):
                    best[i], score[i] = UNKNOWN, 0.0
            refused = ~(score >= m.least) | (best == UNKNOWN)
            yield pa.RecordBatch.from_arrays(
                [*(c.slice(first, end - first) for c in [batch.column(0), *batch.columns[2:]]), pa.array(best, pa.string()), pa.array(score, pa.float64()), pa.array(refused)],
                ["id", *batch.schema.names[2:], "lang_pred", "score", "rejected"],
            )


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, lang_pred, score, rejected.

    lang_pred is a language of the model, `und` (score 0) for null texts and
    texts without a letter.  score is the calibrated probability; rejected
    texts are those below the model's least one, and the unknown.

    * Empty texts are unknown; any length is read whole, as UTF-8.
    * Null and repeated ids give a row each; an empty table gives an empty result.

    Spark: a scan with a broadcast model of fixed size; nothing is shuffled.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(partial(_predict, model=docs.sparkSession.sparkContext.broadcast(model)), f"id {kind}, lang_pred string, score double, rejected boolean")
    return out.withColumnRenamed("id", id_col)


def fit_documents(docs: DataFrame) -> LanguageModel:
    """A model from the rows of documents that are not held out."""
    rows = docs.where(~held_out(F.col("doc_id"), 4, 2))
    return fit(rows.select(F.col("doc_id").alias("id"), "text", "lang"))
