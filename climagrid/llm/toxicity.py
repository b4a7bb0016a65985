"""Toxicity by a factorization machine over hashed terms.

score = sigmoid(w0 + sum of w_i + sum over pairs of <v_i, v_j> / sqrt(n)) over the n hashed terms of a text: its words and the
beginnings of its words. The pairwise part learns combinations (an insult with a group mention) that additive weights miss; the
root keeps the many pairs of ordinary terms in a long text from drowning it.

Learning uses a bounded sample: the ``sample_rows`` labelled training rows that come first in hash order of the id. Their terms
are hashed where the texts are read; one task then fits the model to at most ``sample_rows`` lists of term numbers. Linear
weights follow the FTRL-proximal rule, whose L1 penalty leaves ordinary terms at exactly 0, so that long texts do not
gather noise; factors follow AdaGrad. Terms of at least ``LEAST`` sampled texts have factors, whatever their linear weight; others are
left out. The model (``2**bits`` * (1 + factors) floats) has a fixed size and is broadcast to the tasks that score.

Defined results: NULL and empty texts have no terms and get the intercept's score; ids with several labels count as toxic
if one label says so; NULL labels and labels without a document are left out; without both classes in the sample every score
is the (smoothed) share of toxic rows; equal texts get equal scores; no other column is read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from climagrid.llm import tokens
from climagrid.llm.common import bound_batches, free, id_hash_mod, stored

SAMPLE_ROWS = 24_000
BITS = 18
FACTORS = 4
EPOCHS = 2
PREFIXES = (3, 4, 5, 6)
LEAST = 10


def terms_of(texts: Sequence[object], bits: int = BITS, only: np.ndarray | None = None) -> Iterator[np.ndarray]:
    """Distinct term numbers of each text, in order; with ``only``, those it marks."""
    shift = np.uint64(64 - bits)
    for part in tokens.chunks(texts):
        words, first, prefixes = tokens.hashes(part, tokens.BY_LETTER, PREFIXES)
        owner = np.concatenate([np.repeat(np.arange(len(part)), np.diff(first)), *(o for o, _ in prefixes)])
        number = np.concatenate([words, *(h for _, h in prefixes)]) >> shift
        if only is not None:
            marked = only[number]
            owner, number = owner[marked], number[marked]
        both = np.unique((owner.astype(np.uint64) << np.uint64(bits)) | number)
        ends = np.searchsorted(both, np.arange(1, len(part), dtype=np.uint64) << np.uint64(bits))
        yield from np.split((both & np.uint64((1 << bits) - 1)).astype(np.int64), ends)


def fit(rows: list[np.ndarray], labels: np.ndarray, bits: int = BITS, factors: int = FACTORS, epochs: int = EPOCHS,
        l1: float = 1.5, l2: float = 0.5, rate: float = 0.1, v_rate: float = 0.05, v_l2: float = 0.002,
        least: int = LEAST, seed: int = 7) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights (2**bits), factors (2**bits, k) and intercept."""
    size = 1 << bits
    share = (labels.sum() + 0.5) / (len(labels) + 1.0) if len(labels) else 0.5
    bias = float(np.log(share / (1 - share)))
    w, v = np.zeros(size), np.zeros((size, factors))
    if len(labels) == 0 or labels.min() == labels.max():
        return w.astype(np.float32), v.astype(np.float32), bias
    seen = np.zeros(size, np.int64)
    for row in rows:
        seen[row] += 1
    often = seen >= least
    rows = [row[often[row]] for row in rows]
    rng = np.random.default_rng(seed)
    z, n = np.zeros(size), np.zeros(size)
    v = rng.normal(0, 0.02, (size, factors))
    v[~often] = 0.0
    v_sum = np.ones((size, factors))
    weight = np.where(labels == 1, min(6.0, 0.8 / share), 1.0)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            x = rows[i]
            if not len(x):
                continue
            wx, vx = w[x], v[x]
            total = vx.sum(0)
            scale = 1 / np.sqrt(len(x))
            margin = bias + wx.sum() + 0.5 * scale * ((total**2).sum() - (vx**2).sum())
            p = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
            g = (p - labels[i]) * weight[i]
            # FTRL-proximal for linear weights.
            old = n[x]
            new = old + g * g
            z[x] += g - (np.sqrt(new) - np.sqrt(old)) / rate * wx
            n[x] = new
            zx = z[x]
            w[x] = np.where(np.abs(zx) <= l1, 0.0, -(zx - np.sign(zx) * l1) / ((1.0 + np.sqrt(new)) / rate + l2))
            step = g * scale * (total - vx) + v_l2 * vx
            v_sum[x] += step**2
            v[x] -= v_rate * step / np.sqrt(v_sum[x])
    return w.astype(np.float32), v.astype(np.float32), bias


def in_model(w: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Which terms count."""
    return (w != 0) | v.any(1)


def in_order(rows: list[np.ndarray], labels: np.ndarray, head: int = 32) -> list[int]:
    """Row numbers by label and terms, the same whatever the files; only equal beginnings are compared in full."""

    def key(i: int, size: int | None = None) -> tuple[int, bytes]:
        return int(labels[i]), rows[i][:size].astype(np.int64).tobytes()

    by_head = sorted((key(i, head), i) for i in range(len(rows)))
    return [i for _, run in groupby(by_head, lambda x: x[0]) for i in sorted((i for _, i in run), key=key)]


def score_terms(x: np.ndarray, w: np.ndarray, v: np.ndarray, bias: float) -> float:
    """The score of a text from its terms that are in the model."""
    vx = v[x].astype(np.float64)
    pairs = 0.5 * float((vx.sum(0) ** 2).sum() - (vx**2).sum()) / max(1.0, np.sqrt(len(x)))
    margin = bias + w[x].sum(dtype=np.float64) + pairs
    return float(1 / (1 + np.exp(-np.clip(margin, -30, 30))))


def sample(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, bits: int = BITS) -> DataFrame:
    """(toxic, terms) of the bounded training sample."""
    chosen = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (id_hash_mod(3) != 1))
        .groupBy(F.col("doc_id").alias("label_id"))
        .agg(F.max("toxic").alias("label_toxic"))
        .orderBy(F.xxhash64("label_id"), "label_id")
        .limit(sample_rows)
    )
    texts = docs.join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id")).select("text", "label_toxic")

    def convert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"toxic": batch["label_toxic"], "terms": list(terms_of(batch["text"], bits))})

    return texts.mapInPandas(convert, "toxic int, terms array<int>")


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, bits: int = BITS, factors: int = FACTORS) -> tuple:
    """The model as arrays of fixed size; what reaches the driver are the terms that count."""
    bound_batches(docs.sparkSession)
    rows = stored(sample(docs, labels, sample_rows, bits), "toxicity-sample")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows are views of the 32-bit numbers as they came: the task holds the sample once.
        lists, marks = [], []
        for batch in batches:
            marks.append(batch.column(0).to_numpy(zero_copy_only=False))
            sizes = pc.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False)
            lists += np.split(batch.column(1).flatten().to_numpy(), np.cumsum(sizes)[:-1])[: len(sizes)]
        y = np.concatenate(marks).astype(np.int64) if marks else np.empty(0, np.int64)
        order = in_order(lists, y)
        w, v, bias = fit([lists[i] for i in order], y[order], bits, factors)
        used = np.flatnonzero(in_model(w, v))
        weights = np.concatenate([[bias], w[used].astype(np.float64)])
        pairs = np.concatenate([np.zeros((1, factors), np.float32), v[used]])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([[-1], used]), pa.int64()),
                pa.array(weights, pa.float64()),
                pa.ListArray.from_arrays(np.arange(len(pairs) + 1, dtype=np.int32) * factors, pa.array(pairs.ravel())),
            ],
            ["term", "weight", "factors"],
        )

    table = rows.repartition(1).mapInArrow(learn, "term long, weight double, factors array<float>")
    w, v, bias = np.zeros(1 << bits, np.float32), np.zeros((1 << bits, factors), np.float32), 0.0
    for row in table.toLocalIterator():
        if row["term"] < 0:
            bias = row["weight"]
        else:
            w[row["term"]], v[row["term"]] = row["weight"], row["factors"]
    return w, v, bias


def with_score(docs: DataFrame, model: tuple, bits: int = BITS, column: str = "score") -> DataFrame:
    """``docs`` with the model's score, computed batch by batch next to the scan."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        w, v, bias = shared.value
        used = in_model(w, v)
        for batch in batches:
            yield pd.Series([score_terms(x, w, v, bias) for x in terms_of(batch, bits, used)], dtype="float64")

    return docs.withColumn(column, score("text"))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    model = train(docs.select("doc_id", "text"), labels.select("doc_id", "toxic"), sample_rows)
    return with_score(docs.select("doc_id", "text"), model).select(
        "doc_id", (id_hash_mod(3) == 1).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents that the model does not reject, with all their columns."""
    model = train(docs.select("doc_id", "text"), labels.select("doc_id", "toxic"), sample_rows)
    own = free("toxicity_score", docs)
    return with_score(docs, model, column=own).where(F.col(own) < threshold).drop(own)
