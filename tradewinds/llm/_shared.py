"""What the operators share: white space, sizes of partitions and keyed streams of Arrow rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewinds.scratch import delete, tables, written

__all__ = ["NOT_SPACES", "SPACES", "by_key", "delete", "keyed_stream", "parts_for", "tables", "text_bytes", "written"]

#: White space of the contracts: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = r"[\x20\x09-\x0D]+"
NOT_SPACES = r"[^\x20\x09-\x0D]+"


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """UTF-8 bytes of a column over all rows."""
    return docs.agg(F.sum(F.octet_length(column))).first()[0] or 0


def parts_for(n_bytes: int, each: int, least: int = 12) -> int:
    """How many partitions hold ``n_bytes`` with about ``each`` bytes in one."""
    return int(max(least, -(-n_bytes // each)))


def keyed_stream(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, Iterator[pa.RecordBatch]]]:
    """Runs of equal keys in batches sorted by ``keys``: (key, its pieces), each run read lazily."""
    source = iter(batches)
    state: dict = {"rest": None}

    def more() -> bool:
        while state["rest"] is None or state["rest"].num_rows == 0:
            state["rest"] = next(source, None)
            if state["rest"] is None:
                return False
        return True

    def key_at(batch: pa.RecordBatch, i: int) -> tuple:
        return tuple(batch.column(k)[i].as_py() for k in keys)

    def run(key: tuple) -> Iterator[pa.RecordBatch]:
        while more():
            batch = state["rest"]
            if key_at(batch, 0) != key:
                return
            low, high = 1, batch.num_rows
            while low < high:  # the first row with another key
                mid = (low + high) // 2
                low, high = (mid + 1, high) if key_at(batch, mid) == key else (low, mid)
            state["rest"] = batch.slice(low)
            yield batch.slice(0, low)

    while more():
        key = key_at(state["rest"], 0)
        pieces = run(key)
        yield key, pieces
        for _ in pieces:
            pass


def by_key(df: DataFrame, parts: int, keys: list[str], order: list[str], work: Callable, schema: str, place: Column | None = None) -> DataFrame:
    """Rows dealt by ``keys``, sorted by them and ``order``; ``work(key, pieces)`` yields record batches.

    ``place`` is a number that goes with the keys: it deals them in turn, where a hash of few keys would
    leave some partitions with several and others with none.
    """

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, pieces in keyed_stream(batches, keys):
            yield from work(key, pieces)

    dealt = df.repartition(parts, *keys) if place is None else df.repartitionById(parts, F.pmod(place, F.lit(parts)).cast("int"))
    return dealt.sortWithinPartitions(*keys, *order).mapInArrow(task, schema)
