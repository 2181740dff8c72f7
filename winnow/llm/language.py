"""Language ID by hierarchical discrimination.

Linear support vector machines, one versus one, first decide the language family of a text and then the language
within that family. Inputs are the frequencies of hashed letter trigrams of the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from winnow.llm.textkernel import flat, slices

# Language families by ISO 639-1 code; a code that is not listed is a family of its own.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "is", "nb", "nl", "no", "sv"),
    "romance": ("ca", "es", "fr", "gl", "it", "pt", "ro"),
    "slavic": ("be", "bg", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}
UNKNOWN = "und"
BITS = 13
SAMPLE_ROWS = 2000
SLICE = 500_000  # bytes of texts whose trigrams are held at once, with some forty bytes each

_BLANK = np.arange(256, dtype=np.uint8)
_BLANK[[b for b in range(128) if not chr(b).isalpha()]] = 0x20


def trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigram at every byte (1 << BITS where there is none) and the number of trigrams per text."""
    letters = _BLANK[data].astype(np.uint32)
    n = len(data)
    out = np.full(n, 1 << BITS, dtype=np.int64)
    if n > 2:
        code = letters[:-2] << np.uint32(16) | letters[1:-1] << np.uint32(8) | letters[2:]
        out[:-2] = (code * np.uint32(2654435761)) >> np.uint32(32 - BITS)
        out[:-2][code == 0x202020] = 1 << BITS
    for back in (1, 2):  # trigrams do not cross into the next text
        at = offsets[1:] - back
        out[at[at >= 0]] = 1 << BITS
    held = np.zeros(n + 1, dtype=np.int64)
    np.cumsum(out < 1 << BITS, out=held[1:])
    return out, held[offsets[1:]] - held[offsets[:-1]]


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values`` over each text, 0 for an empty one; every text is summed by itself."""
    out = np.zeros(len(offsets) - 1)
    full = offsets[1:] > offsets[:-1]
    if full.any():
        out[full] = np.add.reduceat(values, offsets[:-1][full])
    return out


def fit_svm(x: np.ndarray, sign: np.ndarray, penalty: float = 1e-3, steps: int = 150) -> np.ndarray:
    """Weights, bias last, of a linear SVM with squared hinge loss, by accelerated gradient steps."""
    weight = np.where(sign > 0, 0.5 / max(1, (sign > 0).sum()), 0.5 / max(1, (sign < 0).sum())).astype(np.float32)

    def margins(w: np.ndarray) -> np.ndarray:
        return x @ w[:-1] + w[-1]

    def back(v: np.ndarray) -> np.ndarray:
        return np.append(x.T @ v, v.sum()).astype(np.float32)

    # largest eigenvalue of the weighted Gram matrix, for the step size
    v = np.ones(x.shape[1] + 1, dtype=np.float32)
    for _ in range(12):
        v = back(weight * margins(v))
        v /= max(float(np.linalg.norm(v)), 1e-12)
    step = 1 / (2 * float(v @ back(weight * margins(v))) * 1.1 + penalty)
    w = ahead = np.zeros(x.shape[1] + 1, dtype=np.float32)
    for i in range(steps):
        slack = np.maximum(0, 1 - sign * margins(ahead))
        grad = -2 * back(weight * sign * slack) + penalty * ahead
        new = ahead - step * grad
        ahead = new + i / (i + 3) * (new - w)
        w = new
    return w


@dataclass
class Duels:
    """One-versus-one machines between classes: columns of ``first``/``second`` indices into ``classes``."""

    classes: list[str]
    first: np.ndarray
    second: np.ndarray
    weights: np.ndarray  # trigram x duel, the last row (no trigram) is 0
    bias: np.ndarray

    @staticmethod
    def fit(x: np.ndarray, label: np.ndarray) -> Duels:
        classes = sorted(set(label.tolist()))
        pairs = list(combinations(range(len(classes)), 2))
        columns, bias = [np.zeros(((1 << BITS) + 1, 0))], []
        for a, b in pairs:
            rows = np.flatnonzero((label == classes[a]) | (label == classes[b]))
            own = x[rows]
            scale = 1 / (own.std(axis=0) + 1e-3 / own.shape[1] + own.std() * 0.1)
            own *= scale
            size = np.sqrt((own**2).sum(axis=1).mean())
            own /= size
            scale /= size
            w = fit_svm(own, np.where(label[rows] == classes[a], 1, -1).astype(np.float32))
            columns.append(np.append(w[:-1] * scale, 0)[:, None])
            bias.append(w[-1])
        index = np.array(pairs, dtype=np.int64).reshape(-1, 2)
        return Duels(classes, index[:, 0], index[:, 1], np.hstack(columns), np.array(bias, dtype=float))

    def decide(self, grams: np.ndarray, offsets: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Winner and its confidence (logistic of its closest duel) per text."""
        n, k = len(total), len(self.classes)
        if k == 1:
            return np.zeros(n, dtype=np.int64), np.ones(n)
        wins, margins, closest = np.zeros((n, k)), np.zeros((n, k)), np.full((n, k), np.inf)
        for duel, (a, b) in enumerate(zip(self.first, self.second, strict=True)):
            margin = sums(self.weights[grams, duel], offsets) / np.maximum(total, 1) + self.bias[duel]
            for own, value in ((a, margin), (b, -margin)):
                wins[:, own] += value > 0
                margins[:, own] += value
                closest[:, own] = np.minimum(closest[:, own], value)
        winner = np.argmax(wins * 1e6 + margins, axis=1)
        return winner, 1 / (1 + np.exp(-2 * closest[np.arange(n), winner]))


@dataclass
class Model:
    families: Duels
    within: dict[str, Duels]

    def predict(self, grams: np.ndarray, offsets: np.ndarray, total: np.ndarray) -> tuple[list[str], np.ndarray]:
        family, sure = self.families.decide(grams, offsets, total)
        label = np.empty(len(total), dtype=object)
        for i, name in enumerate(self.families.classes):
            rows = family == i
            if rows.any():
                winner, inner = self.within[name].decide(grams, offsets, total)
                label[rows] = np.array(self.within[name].classes, dtype=object)[winner[rows]]
                sure[rows] *= inner[rows]
        return label.tolist(), sure


def family_of(lang: str) -> str:
    return FAMILY_OF.get(lang, lang)


def quota_of(counts: list[int], total: int) -> float:
    """The most rows of each language, so that all together are at most ``total``."""
    left = total
    for taken, n in enumerate(sorted(counts)):
        if n * (len(counts) - taken) > left:
            return left / (len(counts) - taken)
        left -= n
    return float(total)


def fit(docs: DataFrame, usable: Column, text_col: str = "text", lang_col: str = "lang", sample_rows: int = SAMPLE_ROWS, order_col: str = "doc_id") -> Model | None:
    """Learn from about ``sample_rows`` of the ``usable`` rows with text and language, chosen by a hash of their id.

    Languages are counted first and share the rows equally; what a rare one cannot use goes to the others, so none is
    left out. Of more than ``sample_rows`` languages the most frequent ones are taken.
    Tasks turn the texts of the sample into trigram counts; only these reach the driver. None if there is nothing to
    learn from.
    """
    rows = docs.where(usable & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    name = F.col(lang_col).cast("string")
    counts = rows.groupBy(name.alias("lang")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(sample_rows).collect()
    if not counts:
        return None
    quota = quota_of([r.n for r in counts], sample_rows)
    # a language's share in 2^31 parts; at least one row in expectation
    parts = [F.lit(x) for r in counts for x in (r.lang, int(np.ceil(min(1.0, quota / r.n) * (1 << 31))))]
    rows = rows.where(F.pmod(F.xxhash64(order_col, F.lit(5)), F.lit(1 << 31)) < F.element_at(F.create_map(*parts), name))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, most=SLICE):
            data, offsets = flat(pc.utf8_lower(part.column(1)))
            grams, _ = trigrams(data, offsets)
            index, count = [], []
            for a, b in zip(offsets[:-1], offsets[1:], strict=True):
                own = np.bincount(grams[a:b], minlength=(1 << BITS) + 1)[:-1]
                at = np.flatnonzero(own)
                index.append(at.astype(np.int32))
                count.append(own[at].astype(np.int32))
            lists = [pa.array(x, pa.list_(pa.int32())) for x in (index, count)]
            yield pa.RecordBatch.from_arrays([part.column(0), *lists], names=["lang", "gram", "n"])

    found = rows.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).mapInArrow(counted, "lang string, gram array<int>, n array<int>").toArrow()
    gram, n = (found[c].combine_chunks() for c in ("gram", "n"))
    sizes = gram.value_lengths().to_numpy()
    held = np.flatnonzero(sizes > 0)
    if not len(held):
        return None
    label = np.array(found["lang"].to_pylist(), dtype=object)[held]
    row = np.repeat(np.cumsum(sizes > 0) - 1, sizes)
    x = np.zeros((len(held), 1 << BITS), dtype=np.float32)
    x[row, gram.flatten().to_numpy()] = n.flatten().to_numpy()
    x /= x.sum(axis=1, keepdims=True)
    family = np.array([family_of(lang) for lang in label], dtype=object)
    return Model(Duels.fit(x, family), {name: Duels.fit(x[family == name], label[family == name]) for name in sorted(set(family.tolist()))})


def judged(texts: pa.Array, model: Model | None) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Whether each text has a letter, its language and the score."""
    lettered = np.array([any(map(str.isalpha, text.as_py() or "")) for text in texts], dtype=bool)
    if model is None:
        return lettered, [UNKNOWN] * len(lettered), np.zeros(len(lettered))
    data, offsets = flat(pc.utf8_lower(texts))
    grams, total = trigrams(data, offsets)
    label, score = model.predict(grams, offsets, total)
    label = [x if held else UNKNOWN for x, held in zip(label, lettered.tolist(), strict=True)]
    return lettered, label, np.where(lettered, score, 0.0)


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, lang_pred, score (0 to 1) per row, from the whole text.

    A text that is null, empty or without a letter is ``und`` with score 0, as is every text when nothing could be
    learned. Repeated rows give repeated rows; ids may be null; other columns are left out.
    """
    kind = docs.select(id_col).schema[0].dataType
    schema = pa.schema([("id", to_arrow_type(kind)), ("lang_pred", pa.string()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, most=SLICE):
            _, label, score = judged(part.column(1), model)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(label, pa.string()), pa.array(score)], schema=schema)

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {kind.simpleString()}, lang_pred string, score double").withColumnRenamed("id", id_col)


def accepted(docs: DataFrame, model: Model | None, least_score: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all columns, whose text has a language with a score of at least ``least_score``.

    ``und`` texts (null, empty, without a letter) go; if nothing could be learned, all other rows stay.
    """
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, at, SLICE):
            lettered, _, score = judged(part.column(at), model)
            yield part.filter(pa.array(lettered & ((score >= least_score) | (model is None))))

    return docs.mapInArrow(run, docs.schema)


def held_out(id_col: Column | str = "doc_id") -> Column:
    """Rows whose CRC-32 of the id's text has remainder 2 by 4; nothing is learned from them."""
    return F.coalesce(F.crc32((F.col(id_col) if isinstance(id_col, str) else id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))
