"""Mixing sources to target weights by a low-discrepancy schedule over equal-token blocks.

Each source's documents, shuffled by a hash, form one stream of words, cut into blocks of
``block_words``. Slot ``i`` of the schedule stands at the golden-ratio point ``frac(i * phi)``; the
point falls into one interval of the sources' cumulative weights and so picks the source. The
slots of a source are ranked, and the slot of rank ``k`` takes block ``k mod blocks`` of its
source, in epoch ``k div blocks``. Slots beyond a source's quota are left out, and those that the
sequence is short of (its discrepancy, a logarithm of the slots) follow at the end, so every
source gives exactly its target, rounded to words.

Scale: nothing is ordered globally. Offsets in a stream and ranks in the schedule are sums in two
levels, over equal pieces first, so a source with a third of all rows spreads over all tasks. Only
the table of sources, one row each, is ordered in one place.

The mix is read in the order of slots: each document has the slots that take it, and a stretch of the
schedule holds every source near its share.

Nulls and ties: a null text has no words; a null source is a source of its own, the last. Rows
without words are returned with nothing taken. Repeated rows are separate documents. Only the size of
a text moves, so texts may be of any length; a long one lies on several blocks. An empty table gives an
empty result. Other columns are never read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewinds.llm._shared import NOT_SPACES, written

BLOCK_WORDS = 512
#: Most times that a document can be taken.
EPOCHS = 3
#: Documents of one piece of a source's stream, on average; slots of one piece of the schedule.
PIECE_ROWS, PIECE_SLOTS = 2000, 4096
#: 2**64 divided by the golden ratio, to the nearest odd number.
GOLDEN = 11400714819323198485
GRID = 2**40


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size``: words of each document."""
    return docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(NOT_SPACES)), F.lit(0)).cast("long").alias("size"))


def targets(sized: DataFrame) -> DataFrame:
    """``source, rows, source_size, weight, target``: words that the mix takes of each source.

    Weights 1, 2, 3 repeat over the sources by code point. The shares of all words are filled like
    vessels of ``EPOCHS`` times the source's size: sorted by size for the weight, the first that
    its share doesn't overfill ends the full ones.
    """
    per = sized.groupBy("source").agg(F.count("*").alias("rows"), F.sum("size").alias("source_size"))
    named = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("weight", ((F.row_number().over(named) - 1) % 3 + 1).cast("long")).withColumn("cap", F.col("source_size") * EPOCHS)
    filled = Window.orderBy((F.col("cap") * 6 / F.col("weight")), F.col("source").asc_nulls_last())
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    after = filled.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    per = per.withColumn("full_before", F.coalesce(F.sum("cap").over(before), F.lit(0))).withColumn("weight_after", F.sum("weight").over(after)).withColumn("total", F.sum("source_size").over(whole))
    per = per.withColumn("over", (F.col("total") - F.col("full_before")) * F.col("weight") > F.col("cap") * F.col("weight_after"))
    per = per.withColumn("full", F.sum(F.when(F.col("over"), F.col("cap")).otherwise(0)).over(whole)).withColumn("open", F.sum(F.when(~F.col("over"), F.col("weight")).otherwise(0)).over(whole))
    shared = (F.col("total") - F.col("full")).cast("double") * F.col("weight") / F.when(F.col("open") > 0, F.col("open"))
    return per.select("source", "rows", "source_size", "weight", F.when(F.col("over"), F.col("cap").cast("double")).otherwise(shared).alias("target"))


def _planned(sized: DataFrame, block_words: int) -> DataFrame:
    """The table of sources with words, blocks, granted words and slots, and their cumulative slots."""
    per = targets(sized)
    per = per.withColumn("granted", F.floor(F.coalesce("target", F.lit(0.0)) + 0.5).cast("long"))
    per = per.withColumn("blocks", F.ceil(F.col("source_size") / block_words).cast("long"))
    whole = F.expr("CASE WHEN source_size > 0 THEN granted DIV source_size ELSE 0 END")
    rest = F.expr("CASE WHEN source_size > 0 THEN granted % source_size ELSE 0 END")
    per = per.withColumn("slots", whole * F.col("blocks") + F.ceil(rest / block_words))
    by_name = Window.orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("first", F.coalesce(F.sum("slots").over(by_name), F.lit(0)).cast("long"))
    return per.withColumn("source_id", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).cast("long"))


def schedule(sources: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``slot, source_id, rank, block, epoch, words``: which block each slot takes, and how much of it.

    ``sources`` is the written table of sources. Slots are numbered in the order of the mix; those
    that the sequence is short of have the numbers after it.
    """
    spark = sources.sparkSession
    n, n_sources = sources.agg(F.sum("slots"), F.count("*")).first()
    n = int(n or 0)
    grid = 1 << max(4, (4 * (n_sources or 1)).bit_length())
    live = sources.where("slots > 0").withColumn("lo", F.col("first")).withColumn("hi", F.col("first") + F.col("slots"))
    # cells of a grid over [0, n) that each interval touches; a point looks only into its cell
    cells = live.select("*", F.explode(F.sequence(F.expr(f"CAST(CAST(lo AS DECIMAL(38,0)) * {grid} / {max(n, 1)} AS LONG)"), F.least(F.lit(grid - 1).cast("long"), F.expr(f"CAST(CAST(hi AS DECIMAL(38,0)) * {grid} / {max(n, 1)} AS LONG)")))).alias("cell"))
    point = F.expr(f"CAST(CAST((CAST(slot AS DECIMAL(18,0)) * CAST({GOLDEN} AS DECIMAL(20,0))) % CAST(18446744073709551616 AS DECIMAL(20,0)) AS DOUBLE) / 18446744073709551616D * {n} AS DOUBLE)")
    points = spark.range(n).select(F.col("id").alias("slot"), point.alias("at")).withColumn("cell", F.least(F.lit(grid - 1).cast("long"), F.floor(F.col("at") * grid / max(n, 1))))
    drawn = points.join(cells.select("cell", "lo", "hi", "source_id"), "cell").where((F.col("at") >= F.col("lo")) & (F.col("at") < F.col("hi"))).select("slot", "source_id")
    drawn = drawn.withColumn("piece", F.expr(f"slot DIV {PIECE_SLOTS}"))
    counts = written(drawn.groupBy("source_id", "piece").agg(F.count("*").alias("n")), "mix-counts")
    before = Window.partitionBy("source_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("source_id", "piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    in_piece = Window.partitionBy("source_id", "piece").orderBy("slot")
    ranked = drawn.withColumn("nth", F.row_number().over(in_piece) - 1).join(base, ["source_id", "piece"])
    ranked = ranked.select("slot", "source_id", (F.col("base") + F.col("nth")).alias("rank"))
    got = counts.groupBy("source_id").agg(F.sum("n").alias("got"))
    short = live.join(got, "source_id", "left").withColumn("got", F.coalesce("got", F.lit(0))).where("got < slots")
    short = short.select("source_id", F.explode(F.sequence(F.col("got"), F.col("slots") - 1)).alias("rank"))
    tail = short.select((F.lit(n) + F.col("rank") * F.lit(n_sources or 1) + F.col("source_id")).alias("slot"), "source_id", "rank")
    slots = ranked.unionByName(tail).join(live.select("source_id", "slots", "blocks", "source_size", "granted"), "source_id").where("rank < slots")
    slots = slots.withColumn("epoch", F.expr("rank DIV blocks")).withColumn("block", F.expr("rank % blocks"))
    held = F.least(F.lit(block_words).cast("long"), F.col("source_size") - F.col("block") * block_words)
    left = F.col("granted") - F.col("epoch") * F.col("source_size") - F.col("block") * block_words
    return slots.select("slot", "source_id", "rank", "block", "epoch", F.greatest(F.lit(0).cast("long"), F.least(held, left)).alias("words"))


def streams(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """``sized`` rows that have words, with ``source_id`` and ``start``, their offset in the shuffled stream."""
    rows = sized.where("size > 0").join(sources.select(F.col("source").alias("_source"), "source_id", "rows"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    rows = rows.withColumn("dice", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    draw = F.conv(F.substring("dice", 1, 10), 16, 10).cast("long")
    pieces = F.ceil(F.col("rows") / PIECE_ROWS).cast("long")
    rows = rows.withColumn("piece", F.expr("CAST(0 AS LONG)") + F.floor(draw / F.lit(GRID) * pieces)).drop("rows")
    sums = rows.groupBy("source_id", "piece").agg(F.sum("size").alias("held"))
    before = Window.partitionBy("source_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("source_id", "piece", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("source_id", "piece").orderBy("dice", F.col("doc_id").asc_nulls_first(), "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("in_piece", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(base, ["source_id", "piece"])
    return rows.select("doc_id", "source", "size", "source_id", (F.col("base") + F.col("in_piece")).alias("start"))


def taken_pieces(sized: DataFrame, block_words: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame]:
    """Pieces of documents on blocks joined with the slots that take them; and the table of sources.

    Columns of the pieces: the document's, ``piece_at`` (offset in the document), ``slot``,
    ``epoch`` and ``taken`` (words of the piece that the slot takes; null without a slot).
    """
    sources = written(_planned(sized, block_words), "mix-sources")
    placed = streams(sized, sources)
    first, last = f"start DIV {block_words}", f"(start + size - 1) DIV {block_words}"
    pieces = placed.select("*", F.explode(F.sequence(F.expr(first), F.expr(last))).alias("block"))
    low = F.greatest(F.lit(0).cast("long"), F.col("start") - F.col("block") * block_words)
    high = F.least(F.lit(block_words).cast("long"), F.col("start") + F.col("size") - F.col("block") * block_words)
    slots = schedule(sources, block_words).select("source_id", "block", "slot", "epoch", "words")
    joined = pieces.withColumn("low", low).withColumn("high", high).join(slots, ["source_id", "block"], "left")
    taken = F.greatest(F.lit(0).cast("long"), F.least(F.col("high"), F.col("words")) - F.col("low"))
    piece_at = F.col("block") * block_words + F.col("low") - F.col("start")
    return joined.select("doc_id", "source", "size", "start", piece_at.alias("piece_at"), "slot", "epoch", F.when(F.col("words").isNotNull(), taken).alias("taken")), sources


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken, slots, first_slot`` for each row of ``docs``.

    ``slots`` are the slots of the schedule that take the document's first word, ``EPOCHS`` at most, in
    order; ``first_slot`` is the first of all slots that take words of it, null if none does.
    """
    sized = written(measured(docs), "mix-sizes")
    pieces, sources = taken_pieces(sized, block_words)
    slots = F.array_sort(F.collect_list(F.when((F.col("piece_at") == 0) & (F.col("taken") > 0), F.col("slot"))))  # EPOCHS at most
    first = F.min(F.when(F.col("taken") > 0, F.col("slot")))
    rows = pieces.groupBy("doc_id", "source", "size", "start").agg(F.coalesce(F.sum("taken"), F.lit(0)).cast("long").alias("taken"), slots.alias("slots"), first.alias("first_slot")).drop("start")
    nothing = sized.where("size = 0").select("doc_id", "source", "size", F.lit(0).cast("long").alias("taken"), F.array().cast("array<long>").alias("slots"), F.lit(None).cast("long").alias("first_slot"))
    rows = rows.unionByName(nothing)
    of = sources.select(F.col("source").alias("_source"), "source_size", F.coalesce("target", F.lit(0.0)).alias("target"))
    return rows.join(of, F.col("source").eqNullSafe(F.col("_source"))).select("doc_id", "source", "size", "source_size", "target", "taken", "slots", "first_slot")


def mixed_documents(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes its start, in the order of the schedule.

    So any stretch of the result, file by file, is near the target shares. Rows that share a doc_id are
    all placed as the one of them that is taken most often.
    """
    most = F.max(F.struct(F.size("slots").alias("n"), F.col("slots")))["slots"]
    places = mix(docs.select("doc_id", "source", "text"), block_words).groupBy("doc_id").agg(most.alias("_slots")).where("size(_slots) > 0")
    places = written(places.withColumnRenamed("doc_id", "_of"), "mix-slots")
    # documents may have columns of any name, so they go on as one
    rows = docs.select(F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"), F.col("doc_id").alias("id"))
    joined = rows.join(places.hint("merge"), rows["id"].eqNullSafe(places["_of"])).select("row", "id", F.explode("_slots").alias("slot"))
    return joined.repartitionByRange("slot", "id").sortWithinPartitions("slot", "id").select("row.*")
