"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages (``PASSAGE`` words each, all of them). Every passage is encoded as a
vector (:func:`encode_chunk`); gated attention (Ilse, Tomczak and Welling 2018) weighs the passages, and
the weighted sum is scored. Only documents have labels; the weights of passages are learned from them.

Encoding and scoring stream over Arrow batches. Training takes a bounded sample of labelled
documents with all their passages, encoded on the executors, and runs on the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.llm.tokens import bound_batches, chunks, words

PASSAGE = 48

# Bounds of the training sample: labelled documents (those with the smallest hash of their id) and bytes of
# their texts together. A document takes part with all its passages or not at all. Scoring has no such bounds.
TRAIN_DOCS = 3000
TRAIN_BYTES = 8 << 20

HIDDEN, GATE = 24, 12
EPOCHS, RATE, DECAY = 220, 0.01, 1e-4
KEEP_SCORE = 0.3

# Byte classes: lower, upper, digit, space, line end, full stop or comma, other mark, pipe,
# symbol, first byte of another letter, its further bytes.
_CLASSES = 11
_CLASS = np.full(256, 6, np.int64)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[[32, 9, 11, 12, 13]], _CLASS[10] = 0, 1, 2, 3, 4
_CLASS[[44, 46]], _CLASS[124], _CLASS[[ord(c) for c in "#*$%&<>@"]] = 5, 7, 8
_CLASS[0xC0:], _CLASS[0x80:0xC0] = 9, 10
_PAIRS = _CLASSES * _CLASSES
FEATURES = _PAIRS + 5


def encode_chunk(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Passage vectors, and the offsets of each text's passages (one at least).

    Shares of byte-class pairs, then distinct words, immediate repetitions, mean word
    length, its spread, and the share of short words.
    """
    found = words(data, offsets, lower=True)
    counts = np.diff(found.first)
    passages = np.maximum(-(-counts // PASSAGE), 1)
    at = np.concatenate([[0], np.cumsum(passages)])
    step = np.arange(at[-1]) - np.repeat(at[:-1], passages)
    first_word = np.repeat(found.first[:-1], passages) + step * PASSAGE
    last_word = np.minimum(first_word + PASSAGE, np.repeat(found.first[1:], passages))

    starts = np.append(found.start, len(data))
    begin = np.where(step == 0, np.repeat(offsets[:-1], passages), starts[np.minimum(first_word, len(found.start))])
    sizes = np.diff(np.append(begin, len(data)))
    owner = np.repeat(np.arange(at[-1]), sizes)
    kinds = _CLASS[data]
    code = owner[:-1] * _PAIRS + kinds[:-1] * _CLASSES + kinds[1:]
    within = owner[:-1] == owner[1:]
    pairs = np.bincount(code[within], minlength=at[-1] * _PAIRS).reshape(at[-1], _PAIRS)
    out = np.zeros((at[-1], FEATURES), np.float32)
    out[:, :_PAIRS] = pairs / np.maximum(sizes - 1, 1)[:, None]

    n = (last_word - first_word).astype(np.float64)
    full = n > 0
    if full.any():
        owner = np.repeat(np.arange(at[-1]), last_word - first_word)
        n = np.maximum(n, 1)
        order = np.lexsort((found.hash, owner))
        key, own = found.hash[order], owner[order]
        fresh = np.append(True, (key[1:] != key[:-1]) | (own[1:] != own[:-1]))
        again = np.append(False, (found.hash[1:] == found.hash[:-1]) & (owner[1:] == owner[:-1]))
        length = np.minimum(found.end - found.start, 64).astype(np.float64)
        total = lambda values, of=owner: np.bincount(of, weights=values, minlength=at[-1])
        mean = total(length) / n
        out[:, _PAIRS] = total(fresh, own) / n
        out[:, _PAIRS + 1] = total(again) / n
        out[:, _PAIRS + 2] = mean / 8
        out[:, _PAIRS + 3] = np.sqrt(np.maximum(total(length * length) / n - mean * mean, 0)) / 8
        out[:, _PAIRS + 4] = total(length <= 3) / n
    return out, at


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class AttentionModel:
    """Standardisation, encoder ``E, e``, gates ``V, U, w`` and scorer ``c, b``."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def forward(self, x: np.ndarray, at: np.ndarray) -> dict[str, np.ndarray]:
        """Scores of bags; ``x`` holds all their passages, bag ``i`` those of ``at[i]:at[i+1]``."""
        return self.weigh(self.standard(x), at)

    def weigh(self, z: np.ndarray, at: np.ndarray) -> dict[str, np.ndarray]:
        """The same of standardised passages."""
        p = self.weights
        h = np.tanh(z @ p["E"] + p["e"])
        t, g = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        energy = (t * g) @ p["w"]
        counts = np.diff(at)
        energy = np.exp(energy - np.repeat(np.maximum.reduceat(energy, at[:-1]), counts))
        attention = energy / np.repeat(np.add.reduceat(energy, at[:-1]), counts)
        bag = np.add.reduceat(attention[:, None] * h, at[:-1], axis=0)
        return {"z": z, "h": h, "t": t, "g": g, "attention": attention, "bag": bag,
                "score": _sigmoid(bag @ p["c"] + p["b"])}

    def gradient(self, z: np.ndarray, at: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Gradient of the mean log loss over standardised passages."""
        p, s, counts = self.weights, self.weigh(z, at), np.diff(at)
        d = (s["score"] - y) / len(y)
        d_bag = np.repeat(d[:, None] * p["c"], counts, axis=0)
        a = s["attention"]
        d_a = (d_bag * s["h"]).sum(axis=1)
        d_energy = a * (d_a - np.repeat(np.add.reduceat(a * d_a, at[:-1]), counts))
        d_gate = d_energy[:, None] * p["w"]
        d_t = d_gate * s["g"] * (1 - s["t"] ** 2)
        d_g = d_gate * s["t"] * s["g"] * (1 - s["g"])
        d_h = a[:, None] * d_bag + d_t @ p["V"].T + d_g @ p["U"].T
        d_h *= 1 - s["h"] ** 2
        return {"E": s["z"].T @ d_h, "e": d_h.sum(axis=0), "V": s["h"].T @ d_t, "U": s["h"].T @ d_g,
                "w": (s["t"] * s["g"]).T @ d_energy, "c": s["bag"].T @ d, "b": np.array(d.sum())}


def fit(bags: list[np.ndarray], labels: np.ndarray) -> AttentionModel:
    """Train by Adam over all bags at once; the same bags in the same order give the same model.

    Without bags, or with one label only, the score is that label's (smoothed) share everywhere.
    """
    y = np.asarray(labels, np.float64)
    rng = np.random.default_rng(3)
    shape = {"E": (FEATURES, HIDDEN), "e": (HIDDEN,), "V": (HIDDEN, GATE), "U": (HIDDEN, GATE), "w": (GATE,), "c": (HIDDEN,)}
    weights = {k: rng.normal(0, (s[0]) ** -0.5, s) for k, s in shape.items()}
    prior = (y.sum() + 1) / (len(y) + 2)
    weights |= {"e": np.zeros(HIDDEN), "b": np.array(np.log(prior / (1 - prior)))}
    if len(set(y.tolist())) < 2:
        weights["c"] = np.zeros(HIDDEN)
        return AttentionModel(np.zeros(FEATURES), np.ones(FEATURES), weights)
    x = np.concatenate(bags).astype(np.float64)
    at = np.concatenate([[0], np.cumsum([len(b) for b in bags])])
    model = AttentionModel(x.mean(axis=0), x.std(axis=0) + 1e-3, weights)
    z = model.standard(x)
    first, second = ({k: np.zeros_like(v) for k, v in weights.items()} for _ in range(2))
    for step in range(1, EPOCHS + 1):
        for k, d in model.gradient(z, at, y).items():
            d = d + DECAY * weights[k] * (k not in ("b", "e"))
            first[k] = 0.9 * first[k] + 0.1 * d
            second[k] = 0.999 * second[k] + 0.001 * d * d
            rate = RATE * (1 - 0.999**step) ** 0.5 / (1 - 0.9**step)
            weights[k] = weights[k] - rate * first[k] / (np.sqrt(second[k]) + 1e-8)
    return model


def held_out(doc_id: Column) -> Column:
    """A fifth of the documents, by checksum of the id; they are never trained on."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _encode_sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, data, offsets in chunks(batch["text"]):
            vectors, at = encode_chunk(data, offsets)
            rows = [vectors[at[i]:at[i + 1]].tobytes() for i in range(len(offsets) - 1)]
            yield pa.record_batch(
                [batch["doc_id"].slice(row, len(rows)), batch["label"].slice(row, len(rows)), pa.array(rows, pa.binary())],
                names=["doc_id", "label", "vectors"])


def train(docs: DataFrame, labels: DataFrame, max_docs: int = TRAIN_DOCS, max_bytes: int = TRAIN_BYTES) -> AttentionModel:
    """Fit on at most ``max_docs`` rows of ``labels (doc_id, quality)`` that are not held out.

    The sample is the labelled ids with the smallest hashes, in that order, without documents that no longer
    fit into ``max_bytes`` of text. Rows without id or label are left out; of contradicting labels of one document
    the larger one counts, of different texts under one id the one with the smaller hash.
    """
    bound_batches(docs.sparkSession)
    sample = (
        labels.where("doc_id is not null and quality is not null").where(~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs)
    )
    hashed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("text_hash", F.xxhash64("text"))
    sizes = (
        hashed.join(F.broadcast(sample), "doc_id")  # max_docs short rows
        .groupBy("doc_id", "label").agg(F.min(F.struct("text_hash", F.coalesce(F.octet_length("text"), F.lit(0)).alias("bytes"))).alias("t"))
        .select("doc_id", "label", "t.*").orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    )
    taken, total = [], 0
    for r in sizes:
        if total + r["bytes"] <= max_bytes:
            taken.append((r["doc_id"], r["text_hash"], r["label"]))
            total += r["bytes"]
    chosen = docs.sparkSession.createDataFrame(taken, "doc_id long, text_hash long, label int")
    rows = (
        hashed.join(F.broadcast(chosen), ["doc_id", "text_hash"]).dropDuplicates(["doc_id"]).select("doc_id", "text", "label")
        .mapInArrow(_encode_sample, "doc_id long, label int, vectors binary").toArrow().sort_by("doc_id")
    )
    bags = [np.frombuffer(v, np.float32).reshape(-1, FEATURES) for v in rows["vectors"].to_pylist()]
    return fit(bags, rows["label"].to_numpy())


def _score(model: AttentionModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in chunks(batch["text"]):
                vectors, at = encode_chunk(data, offsets)
                out = model.forward(vectors, at)
                yield pa.record_batch([
                    batch["doc_id"].slice(row, len(offsets) - 1), pa.array(out["score"]),
                    pa.array(np.diff(at)), pa.array(np.maximum.reduceat(out["attention"], at[:-1])),
                ], names=["doc_id", "score", "n_passages", "top_attention"])

    return run


def score(docs: DataFrame, model: AttentionModel, threshold: float = KEEP_SCORE) -> DataFrame:
    """``doc_id, held_out, score, predicted, n_passages, top_attention`` of every row of ``docs (doc_id, text)``.

    A null or empty text is one empty passage. Only the text enters the score. Repeated rows score
    alike, other columns are ignored.
    """
    bound_batches(docs.sparkSession)
    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _score(model), "doc_id long, score double, n_passages long, top_attention double")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"), "n_passages", "top_attention",
    )


def _keep(model: AttentionModel, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = np.ones(batch.num_rows, bool)
            for row, data, offsets in chunks(batch["text"]):
                good[row:row + len(offsets) - 1] = model.forward(*encode_chunk(data, offsets))["score"] >= threshold
            yield batch.filter(pa.array(good))

    return run


def good_documents(docs: DataFrame, model: AttentionModel, threshold: float = KEEP_SCORE) -> DataFrame:
    """Rows of ``docs`` whose score reaches the threshold, all columns unchanged."""
    bound_batches(docs.sparkSession)
    return docs.mapInArrow(_keep(model, threshold), docs.schema)
