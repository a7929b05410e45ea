"""Exact de-duplication by an extendible-hash index on shared files.

Texts are equal when identical after each run of white space became one space. Every class of
equal texts has one entry in an index: rows ``(bucket, depth, key, chain, keep_id, group_size,
text_sha256)`` sorted by key range in the shared folder. A directory doubles its depth until no
bucket holds more than ``capacity`` keys; a bucket that fits at a smaller depth keeps it and is
reached from several directory cells. Keys that several rows have are owned by tasks that compare
their texts byte by byte; texts that differ form a chain. A row is looked up by the cell of its key,
which leads to a bucket, and there by key and, along the chain, by the digest of its text.

What is shuffled are keys, digests and ids. Texts go out only for keys that several rows have, and
combined on the map side, so that a class with a third of all rows reaches its owner as one row for
each map task. A filter of at most ``FILTER_BITS`` bits tells these keys: beyond a sixteenth as many
of them it lets more and more other texts pass, which changes the traffic and not the result. Rows
find their class by joins whose skewed partitions adaptive execution can split.

Nulls and ties: a null text counts as empty; rows with a null doc_id take part and are kept only
if no row of their class has one; a doc_id may stand for different texts; of rows that repeat the
smallest doc_id one is kept. Texts of any length are single values, never cut; a class moves its text
once a map task. An empty table gives an empty result. Other columns are never read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewinds.llm._shared import SPACES, written

#: Keys that a bucket holds before it is split.
CAPACITY = 4096
#: Doublings that one pass over the cells can make.
STEP = 4
#: Most bits of the filter of repeated keys; a row of it has 64.
FILTER_BITS = 1 << 24


def normalised(text: Column) -> Column:
    """Each run of white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def _cell(key: Column, depth: int) -> Column:
    """The first ``depth`` bits of a 64-bit key."""
    return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("long")


def directory(keys: DataFrame, capacity: int = CAPACITY) -> tuple[DataFrame, int]:
    """Cells ``(cell, bucket, depth)`` of the directory over distinct ``key`` rows, and its depth.

    ``bucket`` is the first key of the bucket's range, as an unsigned number in a long. A bucket
    stays overfull only if its keys share all 64 bits.
    """
    n = keys.count()
    low = max(0, math.ceil(math.log2(max(1, n / capacity))))
    top = min(64, low + STEP)
    while True:
        cells = written(keys.groupBy(_cell(F.col("key"), top).alias("cell")).agg(F.count("*").alias("n")), "dedup-cells")
        out = cells.withColumn("depth", F.lit(None).cast("int"))
        for depth in range(low, top + 1):
            of = F.shiftrightunsigned("cell", top - depth).alias("of")
            fits = cells.groupBy(of).agg(F.sum("n").alias("held")).where((F.col("held") <= capacity) | F.lit(depth == 64))
            out = out.withColumn("of", of).join(fits, "of", "left")
            out = out.withColumn("depth", F.coalesce("depth", F.when(F.col("held").isNotNull(), F.lit(depth)))).drop("of", "held")
        if out.where(F.col("depth").isNull()).isEmpty():
            break
        low, top = top, min(64, top + STEP)  # the directory doubles where one cell is still overfull
    bucket = F.expr(f"shiftleft(shiftrightunsigned(cell, {top} - depth), 64 - depth)") if top else F.lit(0).cast("long")
    out = out.select("cell", F.when(F.col("depth") == 0, F.lit(0).cast("long")).otherwise(bucket).alias("bucket"), "depth")
    return written(out, "dedup-directory"), top


def key_of(text: Column, key_bits: int = 64) -> Column:
    """The index key of a normalised text."""
    key = F.xxhash64(text)
    return key if key_bits == 64 else F.shiftleft(key, 64 - key_bits)


def entries_of(docs: DataFrame, key_bits: int = 64) -> DataFrame:
    """The written ``doc_id, key, text_sha256`` of each row."""
    text = normalised(F.col("text"))
    return written(docs.select("doc_id", key_of(text, key_bits).alias("key"), F.sha2(text, 256).alias("text_sha256")), "dedup-entries")


def _with_key_of(docs: DataFrame, keys: DataFrame, key_bits: int) -> DataFrame:
    """``doc_id, key, t`` of the rows whose key may be one of ``keys``; all that have one are there."""
    bits = max(64, min(FILTER_BITS, 1 << (16 * keys.count()).bit_length()))
    place = lambda key: F.pmod(F.xxhash64(key), F.lit(bits))
    held = keys.select(place("key").alias("place")).groupBy(F.expr("place DIV 64").alias("word"))
    known = F.broadcast(held.agg(F.bit_or(F.expr("shiftleft(1L, CAST(place % 64 AS INT))")).alias("bits")))  # FILTER_BITS / 64 rows at most
    rows = docs.select("doc_id", normalised(F.col("text")).alias("t")).withColumn("key", key_of(F.col("t"), key_bits)).withColumn("place", place("key"))
    return rows.join(known, F.expr("place DIV 64") == F.col("word")).where(F.getbit("bits", F.expr("CAST(place % 64 AS INT)")) == 1).select("doc_id", "key", "t")


def build_index(docs: DataFrame, entries: DataFrame, capacity: int = CAPACITY, key_bits: int = 64) -> tuple[DataFrame, DataFrame, int]:
    """The written index, a row for each class of equal texts; its directory and the directory's depth.

    ``key_bits`` narrows the hash, which makes chains common; 64 outside tests.
    """
    keys = written(entries.groupBy("key").agg(F.count("*").alias("n"), F.min("doc_id").alias("keep_id"), F.min("text_sha256").alias("text_sha256")), "dedup-keys")
    cells, depth = directory(keys.select("key"), capacity)
    several = keys.where("n > 1").select("key")
    classes = _with_key_of(docs, several, key_bits).groupBy("key", "t").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))  # compares bytes
    classes = classes.select("key", "keep_id", "group_size", F.sha2("t", 256).alias("text_sha256")).join(several, "key", "left_semi")
    chained = classes.withColumn("chain", F.row_number().over(Window.partitionBy("key").orderBy("text_sha256")))  # a 64-bit key: a link or two
    alone = keys.where("n = 1").select("key", "keep_id", F.lit(1).cast("long").alias("group_size"), "text_sha256", F.lit(1).alias("chain"))
    owned = alone.unionByName(chained).withColumn("cell", _cell(F.col("key"), depth)).join(cells, "cell")
    rows = owned.select("bucket", "depth", "key", "chain", "keep_id", "group_size", "text_sha256")
    return written(rows.repartitionByRange("bucket", "key").sortWithinPartitions("bucket", "key", "chain"), "dedup-index"), cells, depth


def lookup(entries: DataFrame, index: DataFrame, cells: DataFrame, depth: int) -> DataFrame:
    """``entries`` with the ``keep_id, group_size`` that the directory's bucket holds for their key and digest."""
    reached = entries.withColumn("cell", _cell(F.col("key"), depth)).join(cells.select("cell", "bucket"), "cell").drop("cell")
    return reached.join(index.select("bucket", "key", "text_sha256", "keep_id", "group_size"), ["bucket", "key", "text_sha256"])


def exact_dedup(docs: DataFrame, capacity: int = CAPACITY, key_bits: int = 64) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256``: one row for each row of ``docs``."""
    entries = entries_of(docs, key_bits)
    index, cells, depth = build_index(docs, entries, capacity, key_bits)
    rows = entries.groupBy("doc_id", "key", "text_sha256").agg(F.count("*").alias("times"))
    found = lookup(rows, index, cells, depth)
    found = found.select("*", F.posexplode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("again", "_nth"))
    return found.select("doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("again") == 0)).alias("kept"), "text_sha256")


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one for each class that has one to keep."""
    marks = exact_dedup(docs.select("doc_id", "text")).groupBy("doc_id", "text_sha256").agg(F.max("kept").alias("any"), F.count("*").alias("n"))
    marks = written(marks.where("NOT any OR n > 1").withColumnRenamed("doc_id", "_of"), "dedup-marks")
    # documents may have columns of any name, so they go on as one
    rows = docs.select(F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"), F.col("doc_id").alias("id"), F.sha2(normalised(F.col("text")), 256).alias("sha"))
    same = lambda m: rows["id"].eqNullSafe(m["_of"]) & (rows["sha"] == m["text_sha256"])
    alone = rows.join(marks.hint("merge"), same(marks), "left_anti").select("row.*")
    repeated = marks.where("any")
    if repeated.isEmpty():
        return alone
    return alone.unionByName(rows.join(repeated, same(repeated), "left_semi").dropDuplicates(["id", "sha"]).select("row.*"))
