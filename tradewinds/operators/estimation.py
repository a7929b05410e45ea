"""Estimators: sufficient statistics by Spark, small solves on the driver."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REGRESSORS = ("ln_d", "ln_d2", "contig", "landlocked_o", "landlocked_d", "ln_uv")


def gram(rows: DataFrame, x: list[Column], y: Column, w: Column) -> tuple[np.ndarray, np.ndarray, int]:
    """``X'WX``, ``X'Wy`` and the number of rows by one aggregation."""
    p = len(x)
    pairs = [(i, j) for i in range(p) for j in range(i, p)]
    sums = [F.sum(w * x[i] * x[j]) for i, j in pairs] + [F.sum(w * c * y) for c in x]
    got = rows.agg(F.count("*"), *sums).first()
    a = np.zeros((p, p))
    for (i, j), v in zip(pairs, got[1 : 1 + len(pairs)], strict=True):
        a[i, j] = a[j, i] = v or 0.0
    return a, np.array([v or 0.0 for v in got[1 + len(pairs) :]]), got[0]


def dot(x: list[Column], beta: Iterable[float]) -> Column:
    out = F.lit(0.0)
    for c, b in zip(x, beta, strict=True):
        out = out + c * F.lit(float(b))
    return out


@dataclass
class FreightModel:
    """Weighted least squares of log unit-value ratios, refitted without influential rows."""

    centre: float
    years: list[int]
    beta: np.ndarray
    rows: int
    dropped: int

    def columns(self) -> list[Column]:
        d = F.col("ln_d") - F.lit(self.centre)  # centred before squaring: both powers are nearly collinear otherwise
        years = [F.when(F.col("year") == y, 1.0).otherwise(0.0) for y in self.years[1:]]
        return [F.lit(1.0), d, d * d, *(F.col(c) for c in REGRESSORS[2:]), *years]

    def predict(self, flows: DataFrame) -> DataFrame:
        """``tau``, the freight rate of each flow; null where a regressor is missing."""
        return flows.withColumn("tau", F.expm1(dot(self.columns(), self.beta)))


def fit_freight(sample: DataFrame) -> FreightModel:
    """The model of ``freight_sample`` rows; rows with Cook's distance of 4/n or more don't count."""
    n, centre = sample.agg(F.count("*"), F.avg("ln_d")).first()
    if not n:
        raise ValueError("no row can be used to fit the freight model")
    years = sorted(r[0] for r in sample.select("year").distinct().collect())
    model = FreightModel(float(centre), years, np.zeros(0), n, 0)
    x, y, w = model.columns(), F.col("y"), F.col("w")
    a, b, _ = gram(sample, x, y, w)
    inverse = np.linalg.pinv(a)
    model.beta = inverse @ b
    rank = int(np.linalg.matrix_rank(a))
    error = y - dot(x, model.beta)
    lever = F.lit(0.0)
    for i in range(len(x)):
        lever = lever + x[i] * dot(x, inverse[i])
    scored = sample.withColumn("_e2", error * error * w).withColumn("_h", lever * w)
    s2 = scored.agg(F.sum("_e2")).first()[0] / max(n - rank, 1)
    if s2 > 0:
        kept = scored.where(F.col("_e2") / (rank * s2) * F.col("_h") / ((1 - F.col("_h")) * (1 - F.col("_h"))) < 4.0 / n)
        a, b, m = gram(kept, x, y, w)
        if len(x) < m < n:
            model.beta, model.dropped = np.linalg.pinv(a) @ b, n - m
    return model


@dataclass
class Levels:
    """Exporters, importers and years as the columns of a design: one number for each."""

    of: tuple[list, list, list]

    @classmethod
    def found(cls, rows: DataFrame) -> Levels:
        return cls(tuple(sorted(r[0] for r in rows.select(c).distinct().collect()) for c in FACTORS))

    def first(self, k: int) -> int:
        return sum(map(len, self.of[:k]))

    def __len__(self) -> int:
        return self.first(3)

    def numbers(self) -> list[dict]:
        return [{v: self.first(k) + i for i, v in enumerate(held)} for k, held in enumerate(self.of)]

    def free(self) -> np.ndarray:
        """The columns that are left without the first level of each factor."""
        return np.array([i for k, held in enumerate(self.of) for i in range(self.first(k) + 1, self.first(k) + len(held))], int)


FACTORS = ("exporter", "importer", "year")
#: Products that a task turns into one dense matrix at a time.
PRODUCTS = 256


def crossed(rows: DataFrame, value: Column, levels: Levels) -> np.ndarray:
    """The sums of ``value`` over every two levels, by one aggregation: as many rows as pairs of levels."""
    two = [(0, 1), (0, 2), (1, 2)]
    sums = rows.select(*FACTORS, value.alias("_v")).groupingSets([[FACTORS[i], FACTORS[j]] for i, j in two], *FACTORS).agg(F.sum("_v").alias("v"))
    out, number = np.zeros((len(levels), len(levels))), levels.numbers()
    for r in sums.collect():
        i, j = (number[k][r[c]] for k, c in enumerate(FACTORS) if r[c] is not None)
        out[i, j] = out[j, i] = r["v"]
    for k in range(3):  # a level with itself: its sum over the levels of another factor
        here = slice(levels.first(k), levels.first(k + 1))
        beside = 1 if k == 0 else 0
        out[here, here] = np.diag(out[here, levels.first(beside) : levels.first(beside + 1)].sum(1))
    return out


def by_product(rows: DataFrame, values: dict[str, Column], levels: Levels, share: Callable[[dict[str, np.ndarray]], np.ndarray], size: int) -> np.ndarray:
    """The sum over products of ``share``, which gets each value's sums by product and level.

    Sums are made by Spark, combined before they are shuffled: a product that most rows have is one row for
    each of its levels. Tasks read them product by product and add up what ``share`` makes of some products.
    """
    sums = rows.select("product", *FACTORS, *(c.alias(n) for n, c in values.items())).groupingSets([["product", f] for f in FACTORS], "product", *FACTORS).agg(*(F.sum(n).alias(n) for n in values))
    number, width, names = levels.numbers(), len(levels), list(values)

    def task(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, rest, any_ = np.zeros(size), None, False

        def add(frame: pd.DataFrame) -> None:
            at = np.zeros(len(frame), int)
            for k, c in enumerate(FACTORS):
                some = frame[c].notna().to_numpy()
                at[some] = frame.loc[some, c].map(number[k]).to_numpy(int)
            of, products = pd.factorize(frame["product"])
            for low in range(0, len(products), PRODUCTS):
                here = (of >= low) & (of < low + PRODUCTS)
                held = {n: np.zeros((min(PRODUCTS, len(products) - low), width)) for n in names}
                for n in names:
                    held[n][of[here] - low, at[here]] = frame[n].to_numpy(float)[here]
                total[:] += share(held)

        for frame in frames:
            frame = frame if rest is None else pd.concat([rest, frame])
            last = frame["product"] == frame["product"].iloc[-1] if len(frame) else None
            rest = frame if last is None else frame[last]  # its other levels may follow
            if last is not None and not last.all():
                add(frame[~last])
                any_ = True
        if rest is not None and len(rest):
            add(rest)
            any_ = True
        if any_:
            yield pd.DataFrame({"s": [total.tobytes()]})

    def again(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [np.frombuffer(s) for f in frames for s in f["s"]]
        if held:
            yield pd.DataFrame({"s": [sum(held).tobytes()]})

    parts = sums.repartition("product").sortWithinPartitions("product").mapInPandas(task, "s binary").repartition(4).mapInPandas(again, "s binary")
    return sum((np.frombuffer(r[0]) for r in parts.collect()), np.zeros(size))


def fit_quality(rows: DataFrame, robust: bool = True) -> pd.DataFrame:
    """``country, sigma_export, sigma_import`` from reporting distances.

    Distances are regressed on exporters, importers and years, with products absorbed by weighted
    means. All that is needed of the rows are sums by two levels and by product and level; their number is
    that of the levels, not of the rows.
    """
    levels = Levels.found(rows)
    n, free = len(levels), levels.free()
    w, y = F.col("weight"), F.col("distance")
    exporters = slice(0, levels.first(1))  # each row has one exporter: their sums give a product's total

    def absorbed(held: dict[str, np.ndarray]) -> np.ndarray:
        m, s = held["w"], held["wy"]
        each, both = m[:, exporters].sum(1), s[:, exporters].sum(1)
        return np.concatenate([(m.T @ (m / each[:, None])).ravel(), s.sum(0) - m.T @ (both / each), [held["one"][:, exporters].sum(), len(m), (held["wyy"][:, exporters].sum(1) - both**2 / each).sum()]])

    s = by_product(rows, {"w": w, "wy": w * y, "wyy": w * y * y, "one": F.lit(1.0)}, levels, absorbed, n * n + n + 3)
    a = (crossed(rows, w, levels) - s[: n * n].reshape(n, n))[np.ix_(free, free)]
    b, (count, products, squares) = s[n * n : n * n + n][free], s[-3:]
    inverse = np.linalg.pinv(a)
    beta = inverse @ b
    if robust:
        effect = np.zeros(n)
        effect[free] = beta
        own = F.lit(0.0)
        for k, c in enumerate(FACTORS):
            names = F.create_map(*(x for v, i in levels.numbers()[k].items() for x in (F.lit(v), F.lit(float(effect[i])))))
            own = own + F.element_at(names, F.col(c))
        left = rows.withColumn("_left", y - own)
        means = left.groupBy("product").agg((F.sum(w * F.col("_left")) / F.sum(w)).alias("_mean"))
        v = F.pow(w * (F.col("_left") - F.col("_mean")), 2)
        left = left.join(means, "product").withColumn("_v", v)

        def spread(held: dict[str, np.ndarray]) -> np.ndarray:
            m, u = held["w"], held["v"]
            mean = m / m[:, exporters].sum(1)[:, None]
            cross = u.T @ mean
            return (mean.T @ (mean * u[:, exporters].sum(1)[:, None]) - cross - cross.T).ravel()

        meat = crossed(left, F.col("_v"), levels) + by_product(left, {"w": w, "v": F.col("_v")}, levels, spread, n * n).reshape(n, n)
        cov = inverse @ meat[np.ix_(free, free)] @ inverse
    else:
        cov = inverse * (squares - beta @ b) / max(count - len(free) - products, 1)
    out, ex, im = {}, levels.of[0], levels.of[1]
    for name, held, low in (("sigma_export", ex, 0), ("sigma_import", im, len(ex) - 1)):
        m = len(held)
        pick = np.zeros((m, len(free)))
        for i in range(1, m):
            pick[i, low + i - 1] = 1.0
        contrast = pick - pick.mean(0)
        mean = contrast @ beta
        error = np.sqrt(np.maximum(np.einsum("ij,jk,ik->i", contrast, cov, contrast), 0))
        out[name] = pd.Series(np.maximum(math.pi / 2 * (mean - (mean.min() + 2 * error)), 0), index=held)
    return pd.DataFrame(out).rename_axis("country").reset_index()
