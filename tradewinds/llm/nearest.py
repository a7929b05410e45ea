"""Nearest neighbours by randomly rotated one-bit codes.

A coarse partition of at most ``CELLS`` centres is fitted on ``SAMPLE`` vectors, a fixed bound; every
vector joins the cell of its nearest centre. What is left after taking the centre off is rotated by a
random orthogonal matrix of a fixed seed. The index holds of each vector the packed signs of its rotated
direction, its length and a correction scalar, the inner product of the direction with its code. For a
query, whose rotated direction is cut to ``LEVELS`` bits a component, counts of common bits estimate the
inner product of the two directions without bias, with an error of about ``ERROR / sqrt(d - 1)`` times
``sqrt(1 - c * c) / c``, to which the cut's own bound is added.

A query first meets the codes of one piece of each of its ``PROBES`` nearest cells, which give an upper
bound of its k-th distance. It then goes to those cells that the triangle inequality can't leave out; there
its codes leave the vectors whose lower bounds are small enough, and these are reranked by their exact
distance in double precision. Vectors move once, to their cell; cells are dealt in pieces of about
``VECTOR_BLOCK`` vectors, so a cell that holds a third of all is many tasks. No vectors are broadcast. Data
whose cells overlap leaves a query with all cells: its work is then that of all codes.

Nulls and ties: vectors that are null, all zero, or hold null or non-finite components take no
part, neither do rows with a null id; ties go to the smaller id. Vectors of a length other than the
most common take no part. Repeated ids are separate vectors and separate queries, but a query's own id is
never its neighbour. An empty table gives an empty result. Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewinds.llm._shared import by_key, parts_for, written

K = 10
#: Errors of an estimate that its bounds allow for, in its own unit.
ERROR = 4.0
#: Bits of a query's component.
LEVELS = 8
#: Vectors that the centres are fitted on, most cells, and vectors to a cell that they aim at.
SAMPLE, CELLS, CELL_VECTORS = 8192, 1024, 2048
PROBES = 2
#: Vectors that a task holds, and queries that it answers at once.
VECTOR_BLOCK, QUERIES = 16384, 64


def usable(rows: DataFrame, is_query) -> DataFrame:
    """``rid, id, asked, v``: vectors of doubles that can take part, each with a number of its own."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    ok = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists("v", lambda x: x != 0)
    some = rows.select(F.col("vec_id").cast("long").alias("id"), F.coalesce(is_query, F.lit(False)).alias("asked"), v.alias("v"))
    return some.where(F.col("id").isNotNull() & F.col("v").isNotNull() & ok).withColumn("rid", F.monotonically_increasing_id())


def rotation(d: int, seed: int = 11) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    words = -(-bits.shape[1] // 64)
    return np.packbits(np.pad(bits, ((0, 0), (0, words * 64 - bits.shape[1]))), axis=1).view(np.uint64)


def encode(x: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs, lengths and correction scalars of vectors that their centre was taken off."""
    turned = x @ turn
    length = np.sqrt((turned * turned).sum(1))
    unit = turned / np.where(length > 0, length, 1)[:, None]
    scalar = np.abs(unit).sum(1) / np.sqrt(x.shape[1])
    return packed(unit >= 0), length, np.where(length > 0, scalar, 1)


def nearest_centre(v: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres * centres).sum(1) - 2 * v @ centres.T).argmin(1)


def fitted(sample: np.ndarray, cells: int, rounds: int = 6) -> np.ndarray:
    """Centres of a sample: its first vectors, moved to the means of what is nearest to them."""
    centres = sample[:cells].copy()
    for _ in range(rounds):
        of = nearest_centre(sample, centres)
        n = np.bincount(of, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, of, sample)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, d)


@dataclass
class Index:
    """``rows`` has ``rid, id, asked, v, cell, code, length, scalar``; radius and pieces are by cell."""

    rows: DataFrame
    centres: np.ndarray
    radius: np.ndarray
    pieces: np.ndarray


def index(vectors: DataFrame, block: int = VECTOR_BLOCK, cell_vectors: int = CELL_VECTORS) -> Index | None:
    """The written index of all ``rid, id, asked, v`` rows; None if there are none."""
    sizes = vectors.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    if not sizes:
        return None
    d, n = sizes[0]
    vectors = vectors.where(F.size("v") == d)
    drawn = vectors.select("v").orderBy(F.xxhash64("id", "v"), "id").limit(SAMPLE).collect()
    centres = fitted(np.array([r["v"] for r in drawn]), int(min(CELLS, len(drawn), max(1, n // cell_vectors))))
    turn = rotation(d)

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                v = _matrix(b.column("v"), d)
                cell = nearest_centre(v, centres)
                code, length, scalar = encode(v - centres[cell], turn)
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("rid", "id", "asked")), b.column("v").cast(pa.list_(pa.float64())), pa.array(cell, pa.int32()), pa.array([c.tobytes() for c in code], pa.binary()), pa.array(length), pa.array(scalar)], ["rid", "id", "asked", "v", "cell", "code", "length", "scalar"])

    rows = written(vectors.select("rid", "id", "asked", "v").mapInArrow(task, "rid long, id long, asked boolean, v array<double>, cell int, code binary, length double, scalar double"), "nearest-index")
    held = rows.groupBy("cell").agg(F.count("*").alias("n"), F.max("length").alias("radius")).collect()  # CELLS rows at most
    radius, pieces = np.full(len(centres), -1.0), np.zeros(len(centres), np.int64)
    for r in held:
        radius[r["cell"]], pieces[r["cell"]] = r["radius"], -(-r["n"] // block)
    return Index(rows, centres, radius, pieces)


def exact(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Euclidean distances of one query, component by component."""
    total = np.zeros(len(v))
    for j in range(len(q)):
        step = v[:, j] - q[j]
        total += step * step
    return np.sqrt(total)


def bounds(q: np.ndarray, centre: np.ndarray, turn: np.ndarray, code: np.ndarray, length: np.ndarray, scalar: np.ndarray, error: float) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the squared distances of queries to a cell's vectors, from common bits alone."""
    d = q.shape[1]
    turned = (q - centre) @ turn
    q_length = np.sqrt((turned * turned).sum(1))
    unit = turned / np.where(q_length > 0, q_length, 1)[:, None]
    low = unit.min(1)
    step = np.maximum((unit.max(1) - low) / (2**LEVELS - 1), 1e-12)
    level = np.rint((unit - low[:, None]) / step[:, None]).astype(np.int64)
    common = np.zeros((len(q), len(code)))
    for j in range(LEVELS):
        plane = packed(((level >> j) & 1).astype(bool))
        count = np.zeros((len(q), len(code)), np.uint16)
        for w in range(code.shape[1]):
            count += np.bitwise_count(code[None, :, w] & plane[:, None, w])
        common += count * float(1 << j)
    ones = np.bitwise_count(code).sum(1)
    total = (low * d + step * level.sum(1))[:, None]  # of the cut components
    inner = 2 * (low[:, None] * ones + step[:, None] * common) - total
    cosine = inner / np.sqrt(d) / scalar
    spread = (error * np.sqrt(np.maximum(1 - scalar**2, 0)) / np.sqrt(max(d - 1, 1)) + (step * np.sqrt(d) / 2)[:, None]) / scalar
    near = length**2 + (q_length**2)[:, None]
    reach = 2 * length * q_length[:, None]
    slack = 1e-6 * (near + 1)
    return near - reach * np.minimum(cosine + spread, 1) - slack, near - reach * np.maximum(cosine - spread, -1) + slack


_ROW = "cell int, piece int, side int, rid long, id long, v array<double>, code binary, length double, scalar double, tau double"


def _vectors(found: Index, codes_only: bool) -> DataFrame:
    """The vectors' rows of a search, dealt to the pieces of their cells."""
    cells = found.rows.sparkSession.createDataFrame([(k, int(p)) for k, p in enumerate(found.pieces)], "cell int, pieces int")  # CELLS rows at most
    v = F.lit(None).cast("array<double>") if codes_only else F.col("v")
    rows = found.rows.join(F.broadcast(cells), "cell")
    return rows.select("cell", F.pmod(F.xxhash64("rid"), "pieces").cast("int").alias("piece"), F.lit(0).alias("side"), "rid", "id", v.alias("v"), "code", "length", "scalar", F.lit(None).cast("double").alias("tau"))


def _routed(queries: DataFrame, found: Index, probes: int | None) -> DataFrame:
    """Queries ``rid, id, v, tau`` at one piece of their nearest cells, or at all pieces that they must see."""
    centres, radius, pieces = found.centres, found.radius, found.pieces

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for low in range(0, b.num_rows, QUERIES):
                part = b.slice(low, QUERIES)
                v = _matrix(part.column("v"), centres.shape[1])
                far = np.sqrt(np.maximum(((v[:, None, :] - centres) ** 2).sum(2), 0))
                far[:, pieces == 0] = np.inf
                if probes is None:
                    tau = part.column("tau").to_numpy(zero_copy_only=False)
                    row, cell = np.nonzero(far - radius <= (tau * (1 + 1e-9) + 1e-9)[:, None])
                    times = pieces[cell]
                    row, cell = np.repeat(row, times), np.repeat(cell, times)
                    piece = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
                else:
                    k = min(probes, int((pieces > 0).sum()))
                    cell = np.argsort(far, axis=1, kind="stable")[:, :k].ravel()
                    row = np.repeat(np.arange(len(v)), k)
                    piece = part.column("rid").to_numpy()[row] % pieces[cell]
                some = part.take(pa.array(row))
                n = len(row)
                yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), pa.array(piece, pa.int32()), pa.array(np.ones(n), pa.int32()), some.column("rid"), some.column("id"), some.column("v").cast(pa.list_(pa.float64())), pa.nulls(n, pa.binary()), pa.nulls(n, pa.float64()), pa.nulls(n, pa.float64()), some.column("tau")], ["cell", "piece", "side", "rid", "id", "v", "code", "length", "scalar", "tau"])

    return queries.mapInArrow(task, _ROW)


def _searched(found: Index, queries: DataFrame, parts: int, k: int, error: float, codes_only: bool) -> DataFrame:
    """``rid, query_id, vec_id, score`` of the best that each piece has for its queries.

    With ``codes_only`` the scores are upper bounds, from codes alone.
    """
    centres, turn = found.centres, rotation(found.centres.shape[1])
    d = centres.shape[1]
    schema = pa.schema([("rid", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def answer(b: pa.RecordBatch, cell: int, vid, v, code, length, scalar) -> Iterator[pa.RecordBatch]:
        q, qid, rid = _matrix(b.column("v"), d), b.column("id").to_numpy(), b.column("rid").to_numpy()
        tau = b.column("tau").to_numpy(zero_copy_only=False)
        low, high = bounds(q, centres[cell], turn, code, length, scalar, error)
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        for i in range(len(q)):
            open_ = np.flatnonzero(vid != qid[i])
            if codes_only:
                best = open_[np.argpartition(high[i, open_], k - 1)[:k]] if len(open_) > k else open_
                far = np.sqrt(np.maximum(high[i, best], 0))
            else:
                bar = tau[i] ** 2 * (1 + 1e-9) + 1e-9
                if len(open_) > k:
                    bar = min(bar, np.partition(high[i, open_], k - 1)[k - 1])
                open_ = open_[low[i, open_] <= bar]
                far = exact(q[i], v[open_])
                first = np.lexsort((vid[open_], far))[:k]
                best, far = open_[first], far[first]
            out.append((np.full(len(best), i), vid[best], far))
        at, ids, far = (np.concatenate(x) for x in zip(*out, strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(rid[at]), pa.array(qid[at]), pa.array(ids), pa.array(far)], schema=schema)

    def work(key: tuple, pieces: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, block = [], None
        for b in pieces:
            cut = int(np.searchsorted(b.column("side").to_numpy(), 1))  # vectors come first
            if cut:
                held.append(b.slice(0, cut))
            if cut < b.num_rows and held:
                if block is None:
                    every = pa.Table.from_batches(held).combine_chunks()
                    code = np.frombuffer(b"".join(every.column("code").to_pylist()), np.uint64).reshape(every.num_rows, -1)
                    block = (every.column("id").to_numpy(), None if codes_only else _matrix(every.column("v").combine_chunks(), d), code, every.column("length").to_numpy(), every.column("scalar").to_numpy())
                for low in range(cut, b.num_rows, QUERIES):
                    yield from answer(b.slice(low, QUERIES), key[0], *block)

    rows = _vectors(found, codes_only).unionByName(_routed(queries, found, PROBES if codes_only else None))
    return by_key(rows, parts, ["cell", "piece"], ["side"], work, "rid long, query_id long, vec_id long, score double")


def nearest(rows: DataFrame, is_query, k: int = K, error: float = ERROR, vector_block: int = VECTOR_BLOCK, cell_vectors: int = CELL_VECTORS) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows of ``vec_id, embedding`` that ``is_query`` marks."""
    found = index(written(usable(rows, is_query), "nearest-vectors"), vector_block, cell_vectors)
    if found is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    parts = parts_for(int(found.pieces.sum()), 1)
    asked = found.rows.where("asked").select("rid", "id", "v")
    near = _searched(found, asked.withColumn("tau", F.lit(None).cast("double")), parts, k, error, True)
    by_query = Window.partitionBy("rid").orderBy("score", "vec_id")
    bars = near.withColumn("nth", F.row_number().over(by_query)).where(F.col("nth") == k).select(F.col("rid").alias("_rid"), F.col("score").alias("tau"))
    asked = asked.join(bars, F.col("rid") == F.col("_rid"), "left").select("rid", "id", "v", F.coalesce("tau", F.lit(float("inf"))).alias("tau"))
    best = _searched(found, written(asked, "nearest-queries"), parts, k, error, False)
    return best.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
