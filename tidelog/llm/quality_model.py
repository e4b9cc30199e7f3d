"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of `size` words. Every passage is encoded by a small network over surface rates and
hashed word frequencies; gated attention, learned from document labels alone, weighs the passages; the weighted
representation is scored by a logistic layer. Passages are counted and scored in the tasks; the driver trains on a
sample of labelled documents whose number of documents and passages is bounded by parameters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import U64, map_batches, token_hashes, with_free_names

SIZE, HASHED, HIDDEN, ATTENTION = 64, 32, 24, 12
#: Byte classes whose share of a passage's bytes is a feature.
CLASSES = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&|<>", b".,;:", b"!?", b"\n", b"'\"()[]{}=+/_-@", bytes(range(128, 256))]
CLASS_OF = np.full(256, len(CLASSES), np.uint8)
for _i, _c in enumerate(CLASSES):
    CLASS_OF[list(_c)] = _i
N_FEATURES = len(CLASSES) + 6 + HASHED


def passage_features(text: str | None, size: int = SIZE) -> np.ndarray:
    """A row per passage of the whole text; a text without words is one passage of zeros."""
    data = (text or "").encode()
    hashes, starts, ends = token_hashes(data, lower=True)
    n = len(hashes)
    if not n:
        return np.zeros((1, N_FEATURES), np.float32)
    first = np.arange(0, n, size)
    m, words = len(first), np.minimum(size, n - first).astype(np.float64)
    of = np.arange(n) // size
    edges = np.append(starts[first], len(data))
    kind = CLASS_OF[np.frombuffer(data, np.uint8)[edges[0] :]]
    passage_of_byte = np.repeat(np.arange(m), np.diff(edges))
    shares = np.bincount(passage_of_byte * (len(CLASSES) + 1) + kind, minlength=m * (len(CLASSES) + 1)).reshape(m, -1)[:, :-1] / np.diff(edges)[:, None]
    length = np.add.reduceat((ends - starts).astype(float), first) / words
    again = np.append(False, hashes[1:] == hashes[:-1])
    before = np.append(np.zeros(2, bool), hashes[2:] == hashes[:-2])[:n]
    key = (of.astype(U64) << U64(44)) | (hashes >> U64(20))
    distinct = np.bincount((np.unique(key) >> U64(44)).astype(np.int64), minlength=m) / words
    everywhere = len(np.unique(hashes)) / n
    single = np.add.reduceat((ends - starts == 1).astype(float), first) / words
    rates = np.column_stack([length / 10, np.add.reduceat(again.astype(float), first) / words, np.add.reduceat(before.astype(float), first) / words, distinct, single, np.full(m, everywhere)])
    bags = np.bincount(of * HASHED + (hashes >> U64(59)).astype(np.int64), minlength=m * HASHED).reshape(m, HASHED) / words[:, None]
    return np.hstack([shares, rates, bags]).astype(np.float32)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    w: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, begins: np.ndarray) -> dict[str, np.ndarray]:
        """x: passages of all bags, bag after bag; begins: each bag's first passage."""
        w, z = self.w, np.clip((x - self.mean) / self.scale, -6, 6)
        h = np.tanh(z @ w["encode"] + w["bias"])
        v, u = np.tanh(h @ w["value"]), 1 / (1 + np.exp(-(h @ w["gate"])))
        e = (v * u) @ w["attend"]
        sizes = np.diff(np.append(begins, len(x)))
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, begins), sizes))
        a = e / np.repeat(np.add.reduceat(e, begins), sizes)
        bag = np.add.reduceat(h * a[:, None], begins)
        p = 1 / (1 + np.exp(-np.clip(bag @ w["score"] + w["offset"], -30, 30)))
        return {"z": z, "h": h, "v": v, "u": u, "a": a, "bag": bag, "p": p, "sizes": sizes}

    def score(self, bags: list[np.ndarray]) -> np.ndarray:
        sizes = np.fromiter(map(len, bags), np.int64, len(bags))
        return self.forward(np.concatenate(bags), np.cumsum(sizes) - sizes)["p"]


    def gradient(self, x: np.ndarray, begins: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Of the documents' mean cross-entropy, by weight."""
        w, f = self.w, self.forward(x, begins)
        d = (f["p"] - labels) / len(labels)
        wide = np.repeat(d[:, None] * w["score"], f["sizes"], axis=0)
        d_a = (wide * f["h"]).sum(1)
        d_e = f["a"] * (d_a - np.repeat(np.add.reduceat(f["a"] * d_a, begins), f["sizes"]))
        d_vu = d_e[:, None] * w["attend"]
        d_v, d_u = d_vu * f["u"] * (1 - f["v"] ** 2), d_vu * f["v"] * f["u"] * (1 - f["u"])
        d_h = (wide * f["a"][:, None] + d_v @ w["value"].T + d_u @ w["gate"].T) * (1 - f["h"] ** 2)
        return {"encode": f["z"].T @ d_h, "bias": d_h.sum(0), "value": f["h"].T @ d_v, "gate": f["h"].T @ d_u, "attend": (f["v"] * f["u"]).T @ d_e, "score": f["bag"].T @ d, "offset": d.sum()}


def train(bags: list[np.ndarray], labels: np.ndarray, seed: int = 7, rounds: int = 250, rate: float = 0.02, decay: float = 1e-4) -> Model:
    """Full-batch Adam on the documents' cross-entropy."""
    x = np.concatenate(bags).astype(np.float64)
    sizes = np.fromiter(map(len, bags), np.int64, len(bags))
    begins, r = np.cumsum(sizes) - sizes, np.random.default_rng(seed)
    draw = lambda *shape: r.normal(0, 1 / np.sqrt(shape[0]), shape)
    share = np.clip(labels.mean(), 0.01, 0.99)
    w = {"encode": draw(x.shape[1], HIDDEN), "bias": np.zeros(HIDDEN), "value": draw(HIDDEN, ATTENTION), "gate": draw(HIDDEN, ATTENTION), "attend": draw(ATTENTION), "score": draw(HIDDEN), "offset": np.array(np.log(share / (1 - share)))}
    model = Model(x.mean(0), x.std(0) + 1e-3, w)
    m1, m2 = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    for t in range(1, rounds + 1):
        g = model.gradient(x, begins, labels)
        for k in w:
            step = g[k] + decay * w[k] * (k != "offset")
            m1[k] = 0.9 * m1[k] + 0.1 * step
            m2[k] = 0.999 * m2[k] + 0.001 * step**2
            w[k] = w[k] - rate * (m1[k] / (1 - 0.9**t)) / (np.sqrt(m2[k] / (1 - 0.999**t)) + 1e-8)
    return model


def featurise(docs: DataFrame, keep: list[str], size: int = SIZE) -> DataFrame:
    """keep and features: the passages' rows of a text, packed float32."""

    def run(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.array([passage_features(t, size).tobytes() for t in b.column("text").to_pylist()], pa.binary())], names=[*keep, "features"])

    df = with_free_names(docs, [*keep, "text"])
    return map_batches(df, run, ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep) + ", features binary")


def fit(docs: DataFrame, labels: DataFrame, most_docs: int = 3000, most_passages: int = 400, most_in_all: int = 200_000, size: int = SIZE) -> Model | None:
    """A model from at most most_docs labelled documents of at most most_passages passages, most_in_all together; None without two classes' labels.

    The sample takes the least hashes of doc_id and label, so it does not hang on the order of rows; longer documents
    are left out of training only. docs: doc_id, text; labels: doc_id, quality; a doc_id labelled twice has its least label.
    """
    marked = with_free_names(labels, ["doc_id", "quality"]).filter("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    drawn = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_docs)
    rows = featurise(with_free_names(docs, ["doc_id", "text"]).join(F.broadcast(drawn), "doc_id"), ["doc_id", "quality"], size).filter(F.octet_length("features") <= 4 * N_FEATURES * most_passages)
    so_far = F.sum(F.octet_length("features")).over(Window.orderBy(F.xxhash64("doc_id"), "doc_id"))  # of at most most_docs rows
    got = rows.withColumn("so_far", so_far).filter(F.col("so_far") <= 4 * N_FEATURES * most_in_all).drop("so_far").toPandas().sort_values("doc_id", kind="stable")
    if got["quality"].nunique() < 2:
        return None
    return train([np.frombuffer(f, np.float32).reshape(-1, N_FEATURES) for f in got["features"]], got["quality"].to_numpy(np.float64))


def score_quality(docs: DataFrame, labels: DataFrame, learn_from: Column | None = None, threshold: float = 0.3, size: int = SIZE) -> DataFrame:
    """doc_id, score (chance of label 1), predicted (1 from threshold on), passages; a row per row of docs.

    learn_from: condition over labels' doc_id. A null or empty text counts as one passage of zeros. Without labels of
    two classes every score is 0.5. Other columns are ignored.
    """
    model = fit(docs, labels if learn_from is None else labels.filter(learn_from), size=size)

    def run(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        scores, counts, texts = [], [], b.column("text").to_pylist()
        for i in range(0, len(texts), 500):
            bags = [passage_features(t, size) for t in texts[i : i + 500]]
            scores.append(model.score(bags) if model else np.full(len(bags), 0.5))
            counts += map(len, bags)
        p = np.concatenate(scores)
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(p, pa.float64()), pa.array((p >= threshold).astype(np.int32)), pa.array(counts, pa.int64())], names=["doc_id", "score", "predicted", "passages"])

    df = with_free_names(docs, ["doc_id", "text"])
    return map_batches(df, run, f"doc_id {df.schema['doc_id'].dataType.simpleString()}, score double, predicted int, passages bigint")
