"""Trade tables derived from the order tables: declarations, gravity and Comext-shaped observations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewinds.operators.reconcile import ReconcileConfig
from tradewinds.scratch import written

CONFIG = ReconcileConfig(non_cif=("N3",), fas=("N7",), excluded_pairs=(("N1", "N2"),))
EUROPE = 3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as flows between two countries."""
    t = lambda n: table(spark, sf_dir, n)
    lines = t("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag")
    out = lines.join(t("orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("year")), F.col("l_orderkey") == F.col("o_orderkey"))
    out = out.join(t("customer").select("c_custkey", F.col("c_nationkey").alias("ck")), F.col("o_custkey") == F.col("c_custkey"))
    out = out.join(t("supplier").select("s_suppkey", F.col("s_nationkey").alias("sk")), F.col("l_suppkey") == F.col("s_suppkey"))
    out = out.join(t("part").select("p_partkey", F.col("p_brand").alias("product"), F.col("p_size").alias("size")), F.col("l_partkey") == F.col("p_partkey"))
    value = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return out.where("sk <> ck").select("sk", "ck", F.concat(F.lit("N"), F.col("sk").cast("string")).alias("exporter"), F.concat(F.lit("N"), F.col("ck").cast("string")).alias("importer"), "product", "year", value.alias("v"), F.col("l_quantity").cast("double").alias("quantity"), F.col("l_tax").alias("tax"), F.col("l_returnflag").alias("flag"), F.col("l_linenumber").alias("line"), "size")


def declarations(f: DataFrame) -> DataFrame:
    """Tariff-line declarations of exports, imports and totals with the world, of ``flows``."""
    kg = F.col("quantity") * 1000
    nes, skip = F.col("line") == 7, (F.col("line") == 6) & (F.col("size") % 10 == 0)
    code = F.when(nes, 899).when(skip, 490).otherwise(F.col("ck") + 1).cast("int")
    period = F.col("year").cast("string").alias("period")
    none = F.lit(None).cast("double")
    x = f.where("flag <> 'R'").select(F.lit("X").alias("flowCode"), F.col("exporter").alias("reporterISO"), F.when(nes, "_X").otherwise(F.col("importer")).alias("partnerISO"), code.alias("partnerCode"), F.col("product").alias("cmdCode"), period, F.col("v").alias("primaryValue"), kg.alias("qty"), F.lit(8).alias("qtyUnitCode"), F.when(F.col("size") % 5 != 0, kg).alias("netWgt"))
    other = F.col("size") % 3 == 0
    m = f.where("flag <> 'A'").select(F.lit("M").alias("flowCode"), F.col("importer").alias("reporterISO"), F.col("exporter").alias("partnerISO"), (F.col("sk") + 1).cast("int").alias("partnerCode"), F.col("product").alias("cmdCode"), period, (F.col("v") * (1 + F.col("tax"))).alias("primaryValue"), F.when(other, F.col("quantity") * 2).otherwise(kg).alias("qty"), F.when(other, 5).otherwise(8).alias("qtyUnitCode"), F.when(~other & (F.col("size") % 5 != 0), kg).alias("netWgt"))
    w = f.where("flag <> 'R'").groupBy("exporter", "product", "year").agg(F.sum("v").alias("v")).select(F.lit("X").alias("flowCode"), F.col("exporter").alias("reporterISO"), F.lit("W00").alias("partnerISO"), F.lit(0).alias("partnerCode"), F.col("product").alias("cmdCode"), period, F.col("v").alias("primaryValue"), none.alias("qty"), F.lit(None).cast("int").alias("qtyUnitCode"), none.alias("netWgt"))
    return x.unionByName(m).unionByName(w)


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("iso"))


def gravity_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Distances of all pairs of nations, a table of fixed size, and geography with a second city each."""
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_regionkey").alias("r"))
    name = lambda c: F.concat(F.lit("N"), F.col(c).cast("string"))
    pairs = n.join(n.select(F.col("k").alias("k2"), F.col("r").alias("r2")), F.col("k") != F.col("k2"))
    dist = pairs.select(name("k").alias("iso_o"), name("k2").alias("iso_d"), F.when(F.col("k") + F.col("k2") == 47, ".").otherwise((500 + 137 * F.abs(F.col("k") - F.col("k2"))).cast("string")).alias("distw"), F.when(F.col("r") == F.col("r2"), "1").otherwise("0").alias("contig"))
    land = F.when(F.col("k") % 4 == 0, "1").otherwise("0")
    geo = n.select(name("k").alias("iso3"), land.alias("landlocked"))
    return dist, geo.unionByName(geo.where("landlocked = '1'"))


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comext-shaped observations with partners, WORLD and EXT_EU.

    Trade between two countries is one small table, written once: the totals are sums of it.
    """
    f = flows(spark, sf_dir)
    both = F.explode(F.array(F.struct(F.lit(1).alias("flow"), F.col("importer").alias("reporter"), F.col("exporter").alias("partner"), F.col("sk").alias("pk")), F.struct(F.lit(2).alias("flow"), F.col("exporter").alias("reporter"), F.col("importer").alias("partner"), F.col("ck").alias("pk"))))
    rows = f.select("product", "year", "v", both.alias("b")).select("product", F.col("year").cast("string").alias("TIME_PERIOD"), "v", "b.*")
    by = ["reporter", "product", "flow", "TIME_PERIOD"]
    one = written(rows.groupBy(*by, "partner", "pk").agg(F.sum("v").alias("v")), "observations")
    region = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("pk"), F.col("n_regionkey").alias("region"))
    extra = one.join(region, "pk").where(F.col("region") != EUROPE)
    total = lambda d, code: d.groupBy(*by).agg(F.sum("v").alias("v")).withColumn("partner", F.lit(code))
    out = one.drop("pk").unionByName(total(one, "WORLD")).unionByName(total(extra, "EXT_EU"))
    return out.select(F.lit("A").alias("freq"), "reporter", "product", "flow", F.lit("VALUE_IN_EUROS").alias("indicators"), "TIME_PERIOD", "partner", F.col("v").alias("OBS_VALUE"))
