"""Relational helpers with fixed tie-breaks and null rules."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewinds.functions.exprs import full_match, not_in


def individual(partner: Column, aggregates: Sequence[str], reject_underscore: bool = True) -> Column:
    """Whether a partner code is one country: no aggregate code and, as an option, none with ``_``."""
    ok = partner.isNotNull() & not_in(partner, aggregates)
    return ok & ~partner.contains("_") if reject_underscore else ok


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """The first row of each key in a total order."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def last_n(df: DataFrame, series: Sequence[str], period: str, n: int) -> DataFrame:
    """The last ``n`` observations of each series."""
    rank = F.row_number().over(Window.partitionBy(*series).orderBy(F.desc(period)))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that more than one row has, with how many."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def check_duplicates(df: DataFrame, keys: Sequence[str], policy: str = "raise") -> DataFrame:
    """``df``, if no key repeats or the policy is ``ignore`` or ``warn``; else ValueError with ten examples."""
    if policy not in ("ignore", "warn", "raise"):
        raise ValueError(f"unknown duplicate policy {policy!r}")
    if policy != "ignore":
        some = duplicates(df, keys).orderBy(*keys).limit(10).collect()
        if some and policy == "raise":
            raise ValueError(f"rows repeat the key {list(keys)}: {some}")
        if some:
            warnings.warn(f"rows repeat the key {list(keys)}: {some}", stacklevel=2)
    return df


def sum_duplicates(df: DataFrame, dimensions: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """One row for each combination of dimensions, null ones too; only the measures are summed."""
    return df.groupBy(*dimensions).agg(*(F.sum(m).alias(m) for m in measures))


def filter_codes(codes: DataFrame, column: str, include=None, exclude=None, include_regex=None, exclude_regex=None) -> DataFrame:
    """Distinct codes: in the allow-list or whole matches, then not in the deny-list and no whole match, sorted.

    Codes of the allow-list that aren't there are warned of.
    """
    code = F.col(column)
    out = codes.select(column).where(code.isNotNull()).distinct()
    if include is not None:
        held = {r[0] for r in out.where(code.isin(list(include))).collect()}  # at most the allow-list
        if absent := sorted(set(include) - held):
            warnings.warn(f"{column} has no {absent}", stacklevel=2)
        out = out.where(code.isin(list(include)))
    if include_regex is not None:
        out = out.where(full_match(code, include_regex))
    if exclude:
        out = out.where(~code.isin(list(exclude)))
    if exclude_regex is not None:
        out = out.where(~full_match(code, exclude_regex))
    return out.orderBy(column)


def post_filter(df: DataFrame, wanted: dict[str, Sequence]) -> DataFrame:
    """Rows whose value is in the list of each named column; a column that isn't there is warned of."""
    for name, values in wanted.items():
        if name in df.columns:
            df = df.where(F.col(name).isin(list(values)))
        else:
            warnings.warn(f"no column {name} to filter by; there are {df.columns}", stacklevel=2)
    return df


def batches(codes: DataFrame, column: str, size: int) -> DataFrame:
    """Sorted codes in batches of ``size``: ``batch, codes``."""
    nth = F.row_number().over(Window.orderBy(column)) - 1
    return codes.select(column, F.floor(nth / size).cast("long").alias("batch")).groupBy("batch").agg(F.array_join(F.array_sort(F.collect_list(column)), ",").alias("codes"))


def stale_pairs(downloaded: DataFrame, computed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys never computed, or computed before their last download."""
    joined = downloaded.join(computed, list(keys), "left")
    return joined.where(F.col("last_computed").isNull() | (F.col("last_computed") < F.col("last_download"))).select(*keys)
