"""Quality classifier: a factorisation machine.

Inputs are the hashed words of the whole text, its length, and binned statistics of its structure. All pairs of inputs
interact through low-rank factors; the identity sum_{i<j} <v_i, v_j> x_i x_j = (|sum_i v_i x_i|^2 - sum_i |v_i x_i|^2) / 2
scores a text in time linear in its distinct words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from winnow.llm.textkernel import LOWER, flat, per_text, slices, word_hashes, words

BITS = 14
FACTORS = 8
SAMPLE_ROWS = 6000
BINS = 16
EPOCHS = 12
LEAST_STEPS = 150
WORD_WEIGHT, STATISTIC_WEIGHT = 0.6, 2.0
DECAY_LINEAR, DECAY_FACTORS = 2e-5, 2e-5
THRESHOLD = 0.7

_UPPER = np.zeros(256, dtype=bool)
_UPPER[ord("A") : ord("Z") + 1] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[ord("0") : ord("9") + 1] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[[ord(c) for c in ".,;:?'\"()-"]] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[[b for b in range(33, 127) if not chr(b).isalnum()]] = True
_MARK &= ~_STOP
STATISTICS = ("words", "bytes a word", "upper case", "digits", "punctuation", "symbols", "lines", "distinct words", "most frequent word", "repeats of the word before")


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per distinct word of each text: text number, hashed word, weight; per text: the statistics."""
    data, offsets = flat(texts)
    n = len(offsets) - 1
    size = np.maximum(offsets[1:] - offsets[:-1], 1)
    start, end, owner = words(data, offsets)
    hashes = word_hashes(LOWER[data], start, end) >> np.uint64(64 - BITS)
    count = np.bincount(owner, minlength=n)
    key, times = np.unique(owner.astype(np.int64) << BITS | hashes.astype(np.int64), return_counts=True)
    of, word = key >> BITS, key & ((1 << BITS) - 1)
    weight = np.log1p(times)
    norm = np.sqrt(np.bincount(of, weight * weight, minlength=n))
    weight *= WORD_WEIGHT / norm[of]
    most = np.zeros(n)
    np.maximum.at(most, of, times)
    some = np.maximum(count, 1)
    statistics = np.stack(
        [
            np.log1p(count),
            np.bincount(owner, end - start, minlength=n) / some,
            *(per_text(kind[data], offsets) / size for kind in (_UPPER, _DIGIT, _STOP, _MARK)),
            per_text(data == 10, offsets) / some,
            np.bincount(of, minlength=n) / some,
            most / some,
            np.bincount(owner[1:], (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1]), minlength=n) / some,
        ],
        axis=1,
    )
    return of, word, weight, statistics


def add(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Rows of ``values`` summed by ``owner`` (which is sorted); each text is summed by itself."""
    out = np.zeros((n, *values.shape[1:]))
    if len(owner):
        first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        out[owner[first]] = np.add.reduceat(values, first, axis=0)
    return out


@dataclass
class Machine:
    """Inputs: 1 << BITS words, then BINS bins of each statistic."""

    edges: np.ndarray  # statistic x (BINS - 1)
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def inputs(self, of: np.ndarray, word: np.ndarray, weight: np.ndarray, statistics: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sparse rows (text, input, value), sorted by text."""
        n, k = statistics.shape
        bins = np.stack([np.searchsorted(self.edges[j], statistics[:, j], side="right") for j in range(k)], axis=1)
        bins += (1 << BITS) + BINS * np.arange(k)
        owner = np.concatenate([of, np.repeat(np.arange(n), k)])
        order = np.argsort(owner, kind="stable")
        value = np.concatenate([weight, np.full(n * k, STATISTIC_WEIGHT / np.sqrt(k))])
        return owner[order], np.concatenate([word, bins.ravel()])[order], value[order]

    def margins(self, owner: np.ndarray, at: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Margin per text, and sum_i v_i x_i."""
        spread = self.factors[at] * value[:, None]
        total = add(spread, owner, n)
        crossed = 0.5 * ((total**2).sum(axis=1) - add((spread**2).sum(axis=1), owner, n))
        return self.bias + add(self.linear[at] * value, owner, n) + crossed, total

    def score(self, texts: pa.Array) -> np.ndarray:
        n = len(texts)
        margin, _ = self.margins(*self.inputs(*features(texts)), n)
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def train(of: np.ndarray, word: np.ndarray, weight: np.ndarray, statistics: np.ndarray, label: np.ndarray, seed: int = 11) -> Machine:
    """Logistic loss, Adam on small batches; the order of the rows follows the seed."""
    rng = np.random.default_rng(seed)
    n, k = statistics.shape
    edges = np.quantile(statistics, np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T
    size = (1 << BITS) + BINS * k
    rate = np.clip(label.mean(), 1e-3, 1 - 1e-3)
    machine = Machine(edges, float(np.log(rate / (1 - rate))), np.zeros(size), rng.normal(0, 0.02, (size, FACTORS)))
    owner, at, value = machine.inputs(of, word, weight, statistics)
    bounds = np.searchsorted(owner, np.arange(n + 1))
    state = [np.zeros_like(x) for x in (machine.linear, machine.linear, machine.factors, machine.factors)]
    step = 0
    epochs = max(EPOCHS, -(-LEAST_STEPS // -(-n // 256)))
    for epoch in range(epochs):
        order = rng.permutation(n)
        speed = 0.03 * (1 - epoch / epochs) + 0.002
        for begin in range(0, n, 256):
            rows = order[begin : begin + 256]
            picked = np.concatenate([np.arange(bounds[r], bounds[r + 1]) for r in rows])
            inner = np.repeat(np.arange(len(rows)), bounds[rows + 1] - bounds[rows])
            cells, x = at[picked], value[picked]
            margin, total = machine.margins(inner, cells, x, len(rows))
            error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - label[rows]) / len(rows)
            touched, place = np.unique(cells, return_inverse=True)
            pull = error[inner] * x
            grad_linear = np.bincount(place, pull) + DECAY_LINEAR * machine.linear[touched]
            per = pull[:, None] * (total[inner] - machine.factors[cells] * x[:, None])
            grad_factors = np.stack([np.bincount(place, per[:, f]) for f in range(FACTORS)], axis=1) + DECAY_FACTORS * machine.factors[touched]
            step += 1
            for target, grad, mean, square in ((machine.linear, grad_linear, state[0], state[1]), (machine.factors, grad_factors, state[2], state[3])):
                mean[touched] = 0.9 * mean[touched] + 0.1 * grad
                square[touched] = 0.999 * square[touched] + 0.001 * grad**2
                target[touched] -= speed * (mean[touched] / (1 - 0.9**step)) / (np.sqrt(square[touched] / (1 - 0.999**step)) + 1e-6)
            machine.bias -= speed * float(error.sum())
    return machine


def fit(docs: DataFrame, labels: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Machine | None:
    """Learn from about ``sample_rows`` of the labelled ``usable`` rows, chosen by a hash of their id.

    Labels other than 0 and 1 are left out, as are ids without a label; an id with several labels counts once with the
    larger. None if no label is left.
    """
    marked = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col)).cast("int").alias("label"))
    marked = marked.where(usable(F.col("id")))
    share = min(1.0, sample_rows / max(1, marked.count()))
    marked = marked.where(F.pmod(F.xxhash64("id", F.lit(6)), F.lit(1_000_000)) < F.lit(round(share * 1_000_000)))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(marked, "id").select("label", "text")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            of, word, weight, statistics = features(part.column(1))
            cuts = np.searchsorted(of, np.arange(len(statistics) + 1))
            cells = [(word[a:b].astype(np.int32), weight[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([c[0] for c in cells], pa.list_(pa.int32())), pa.array([c[1] for c in cells], pa.list_(pa.float64())), pa.array(list(statistics), pa.list_(pa.float64()))],
                names=["label", "word", "weight", "statistics"],
            )

    found = rows.mapInArrow(counted, "label int, word array<int>, weight array<double>, statistics array<double>").toArrow().combine_chunks()
    if not len(found):
        return None
    order = np.lexsort((found["weight"].combine_chunks().value_lengths().to_numpy(), found["label"].to_numpy()))
    found = found.take(pa.array(order))  # the order of arrival does not matter
    lengths = found["word"].combine_chunks().value_lengths().to_numpy()
    word, weight = (found[c].combine_chunks().flatten().to_numpy() for c in ("word", "weight"))
    statistics = np.array(found["statistics"].to_pylist())
    return train(np.repeat(np.arange(len(found)), lengths), word.astype(np.int64), weight, statistics, found["label"].to_numpy().astype(float))


def score(docs: DataFrame, machine: Machine | None, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """id, score (0 to 1), predicted (1 if score >= threshold) per row, from the whole text.

    Null counts as empty, and empty texts get a score too; without a machine every score is 0.5. Repeated rows give
    repeated rows; ids may be null; other columns are left out.
    """
    kind = docs.select(id_col).schema[0].dataType
    schema = pa.schema([("id", to_arrow_type(kind)), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            values = machine.score(part.column(1)) if machine is not None else np.full(part.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(values)], schema=schema)

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = rows.mapInArrow(run, f"id {kind.simpleString()}, score double").withColumnRenamed("id", id_col)
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
