"""Quality classifier: random Fourier features, ridge scores, isotonic calibration.

Each text is described by ``len(NAMES)`` statistics of its bytes, words and lines. Standardised,
they pass through ``WIDTH`` random cosine features, whose inner products approximate a Gaussian
kernel. Tasks add up their rows' share of the normal equations and two more rounds add up the
tasks', so the driver gets a few matrices whatever the input, and solves the ridge system.
Isotonic regression over ``BINS`` bins of the ridge score, from labelled rows that the fit left
out, turns it into a probability.

Rows whose crc32(doc_id) mod 5 is 0 are held out of all fitting; remainder 1 calibrates; the rest
fits. Labels, language, source and id are never inputs.

Nulls and ties: a null text is empty; an empty text has a score as any other. Rows with a null
doc_id are scored but have no label. Several labels of a document count as their mean. Repeated
rows get equal scores. Texts are read whole, one at a time, whatever their length. Without labels of both classes every score is the share of label 1, or 0.5.
An empty table gives an empty result. Other columns of the documents are never read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewinds.llm._shared import written

FOLDS, HELD_OUT, CALIBRATES = 5, 0, 1
CUT = 0.3
WIDTH = 256
#: The Gaussian kernel's width, in standard deviations of one statistic times the root of their number.
SCALE = 1.0
RIDGE = 1e-3
BINS = 400
#: Tasks of each round of a sum: none adds up what all tasks of a large table have.
SUM_PARTS = (64, 8)

NAMES = (
    "log_bytes", "log_words", "word_bytes", "space", "upper", "digit", "dot", "comma", "pipe", "symbol", "other_punct", "wide",
    "line_words", "lines_per_word", "line_dup", "word_dup", "top_word", "short_words", "long_words", "symbol_words", "stop_words", "last_dot",
)
#: Frequent words of the four languages; their share tells prose from lists.
STOP = frozenset("the of and to in is that it was for on are as with his they at be this have from or one had by that die der und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se el los y que del las por con para una su al lo como".split())
_CLASSES = ("space", "upper", "digit", "dot", "comma", "pipe", "symbol", "other_punct", "wide")


def _byte_classes() -> np.ndarray:
    """The class of each byte, by its place in ``_CLASSES``; others have the number after them."""
    out = np.full(256, len(_CLASSES), np.int64)
    for b in range(256):
        c = chr(b)
        for k, here in enumerate((c in " \t\n\v\f\r", "A" <= c <= "Z", "0" <= c <= "9", c in ".!?", c in ",;:", c == "|", c in "#%&*$@^~=+<>{}[]\\_/", b < 128 and c.isprintable() and not c.isalnum(), b >= 128)):
            if here:
                out[b] = k
                break
    return out


_CLASS_OF = _byte_classes()


def statistics(text: str) -> list[float]:
    """The statistics of one text, in the order of ``NAMES``."""
    raw = text.encode()
    n = max(1, len(raw))
    counts = np.bincount(_CLASS_OF[np.frombuffer(raw, np.uint8)], minlength=len(_CLASSES) + 1)[: len(_CLASSES)] / n
    words, lines = text.split(), text.split("\n")
    m = max(1, len(words))
    often: dict[str, int] = {}
    for w in words:
        often[w] = often.get(w, 0) + 1
    full = [x for x in lines if x.strip()]
    short = long = odd = stop = 0
    for w, k in often.items():
        size = len(w)
        short += k * (size <= 2)
        long += k * (size >= 12)
        odd += k * (not w[-1].isalnum() and w[-1] not in ".,;:!?")
        stop += k * (w.lower() in STOP)
    return [
        np.log1p(len(raw)), np.log1p(len(words)), len(raw) / m, *counts.tolist(),
        np.log1p(len(words) / max(1, len(full))), len(full) / m, 1 - len(set(full)) / max(1, len(full)), 1 - len(often) / m, max(often.values(), default=0) / m,
        short / m, long / m, odd / m, stop / m, float(text.rstrip().endswith((".", "!", "?"))),
    ]


def _text_hash(text: Column) -> Column:
    return F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256)


def described(docs: DataFrame, hashed: bool = False) -> DataFrame:
    """``doc_id, x``: the statistics of each text; with its ``hash`` if asked for."""
    names = ["doc_id", *["hash"] * hashed]

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [statistics(t or "") for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(x, pa.list_(pa.float64()))], [*names, "x"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *[_text_hash(F.col("text")).alias("hash")] * hashed, F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(task, "doc_id long, " + "hash string, " * hashed + "x array<double>")


def fold(doc_id: Column) -> Column:
    """The remainder of crc32 of an id; null for a null id."""
    return F.crc32(doc_id.cast("string")) % FOLDS


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    turn: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    edges: np.ndarray
    levels: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.concatenate([np.cos(z @ self.turn + self.phase) * np.sqrt(2 / len(self.phase)), np.ones((len(x), 1))], 1)

    def ridge(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.round(np.interp(self.ridge(x), self.edges, self.levels), 9), 0, 1)


def _summed(rows: DataFrame, n: int, share) -> np.ndarray:
    """The sum over all rows of a vector of ``n`` numbers that ``share`` makes of a batch."""

    def first(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return total(share(b) for b in batches if b.num_rows)

    def again(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return total(np.frombuffer(s) for b in batches for s in b.column(0).to_pylist())

    def total(shares: Iterable[np.ndarray]) -> Iterator[pa.RecordBatch]:
        out = None
        for s in shares:
            out = s.copy() if out is None else np.add(out, s, out=out)
        if out is not None:
            yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], ["s"])

    parts = rows.mapInArrow(first, "s binary")
    for n_parts in SUM_PARTS:
        parts = parts.repartition(n_parts).mapInArrow(again, "s binary")
    return sum((np.frombuffer(r["s"]) for r in parts.collect()), np.zeros(n))


def _arrays(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return b.column("x").flatten().to_numpy().reshape(b.num_rows, -1), b.column("y").to_numpy()


def isotonic(value: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The rising sequence nearest to ``value``: pools of adjacent violators."""
    pools: list[list[float]] = []
    for v, w in zip(value, weight, strict=True):
        pools.append([v, w, 1])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            b, a = pools.pop(), pools.pop()
            pools.append([(a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1]), a[1] + b[1], a[2] + b[2]])
    return np.repeat([p[0] for p in pools], [int(p[2]) for p in pools])


def fit(known: DataFrame, width: int = WIDTH, ridge: float = RIDGE, seed: int = 5) -> Model:
    """A model from ``x, y, fold`` rows, none of them held out."""
    d = len(NAMES)
    known = known.where(F.col("fold") != HELD_OUT)
    fits, tunes = known.where(F.col("fold") != CALIBRATES), known.where(F.col("fold") == CALIBRATES)

    def moments(b: pa.RecordBatch) -> np.ndarray:
        x, y = _arrays(b)
        return np.concatenate([[len(x), y.sum()], x.sum(0), (x * x).sum(0)])

    s = _summed(fits, 2 + 2 * d, moments)
    n, share = max(s[0], 1), (s[1] / s[0] if s[0] else 0.5)
    mean = s[2 : 2 + d] / n
    scale = np.sqrt(np.maximum(s[2 + d :] / n - mean**2, 0))
    scale = np.where(scale > 1e-6, scale, 1.0)
    rng = np.random.default_rng(seed)
    turn = rng.standard_normal((d, width)) / (SCALE * np.sqrt(d))
    model = Model(mean, scale, turn, rng.uniform(0, 2 * np.pi, width), np.zeros(width + 1), np.array([0.0, 1.0]), np.array([share, share]))
    if not s[0] or share in (0.0, 1.0):
        return model
    m = width + 1

    def normal(b: pa.RecordBatch) -> np.ndarray:
        x, y = _arrays(b)
        z = model.features(x)
        return np.concatenate([(z.T @ z).ravel(), z.T @ y])

    s = _summed(fits, m * m + m, normal)
    model.weights = np.linalg.solve(s[: m * m].reshape(m, m) + ridge * n * np.diag([*[1.0 / width] * width, 1e-9]), s[m * m :])
    low, high = -0.5, 1.5

    def histogram(b: pa.RecordBatch) -> np.ndarray:
        x, y = _arrays(b)
        at = np.clip(((model.ridge(x) - low) / (high - low) * BINS).astype(int), 0, BINS - 1)
        return np.concatenate([np.bincount(at, minlength=BINS), np.bincount(at, y, BINS)])

    s = _summed(tunes, 2 * BINS, histogram)
    count, right = s[:BINS], s[BINS:]
    some = count > 0
    if some.any():
        model.edges = (low + (np.arange(BINS) + 0.5) * (high - low) / BINS)[some]
        model.levels = isotonic(right[some] / count[some], count[some])
    else:
        model.edges, model.levels = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    return model


def _scored(docs: DataFrame, labels: DataFrame, column: str = "quality", width: int = WIDTH, hashed: bool = False) -> DataFrame:
    """``doc_id, score`` for each row of ``docs``; with the text's ``hash`` if asked for."""
    rows = written(described(docs, hashed), "quality-statistics")
    marks = labels.where(F.col(column).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("_doc")).agg(F.avg(F.col(column).cast("double")).alias("y"))
    known = rows.join(marks, F.col("doc_id") == F.col("_doc")).select("x", "y", fold(F.col("doc_id")).alias("fold"))
    model = fit(written(known, "quality-known"), width)
    names = ["doc_id", *["hash"] * hashed]

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = b.column("x").flatten().to_numpy().reshape(b.num_rows, -1)
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(model.score(x))], [*names, "score"])

    return rows.mapInArrow(task, "doc_id long, " + "hash string, " * hashed + "score double")


def _predicted() -> Column:
    return F.when(F.col("score") >= CUT, 1).otherwise(0)


def score_documents(docs: DataFrame, labels: DataFrame, column: str = "quality", width: int = WIDTH) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``docs``."""
    held = F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False))
    return _scored(docs, labels, column, width).select("doc_id", held.alias("held_out"), "score", _predicted().alias("predicted"))


def accepted_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that aren't rejected, with all their columns.

    Rejected are texts of a doc_id, as a null or repeated one may stand for different texts.
    """
    rejected = _scored(docs, labels, hashed=True).where(_predicted() == 0).select(F.col("doc_id").alias("_no"), F.col("hash").alias("_hash")).distinct()
    rejected = written(rejected, "quality-rejected")
    # documents may have columns of any name, so they go on as one
    rows = docs.select(F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"), F.col("doc_id").alias("id"), _text_hash(F.col("text")).alias("hash"))
    return rows.join(rejected.hint("merge"), rows["id"].eqNullSafe(rejected["_no"]) & (rows["hash"] == rejected["_hash"]), "left_anti").select("row.*")
