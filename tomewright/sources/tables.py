"""Loading of the driver's tables and their binding to the entities of a rule-catalogue corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class-list rows (id, class_id, level, school, source, url): a list row for each order line of a supplier's nation."""
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus")
    suppliers = load(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return lines.join(suppliers, lines.l_suppkey == suppliers.s_suppkey).select(
        F.col("l_orderkey").alias("id"),
        F.col("s_nationkey").alias("class_id"),
        (F.floor("l_quantity").cast("int") % 10).alias("level"),
        F.nullif("l_returnflag", F.lit("N")).alias("school"),
        F.col("l_linestatus").alias("source"),
        F.concat(F.col("l_orderkey").cast("string"), F.lit("/"), (F.col("l_linenumber") % 2).cast("string")).alias("url"),
    )


ENTRIES_SQL = """entries AS (
  SELECT l_orderkey AS id, s_nationkey AS class_id, (floor(l_quantity)::INT % 10) AS level, nullif(l_returnflag, 'N') AS school,
    l_linestatus AS source, l_orderkey::VARCHAR || '/' || (l_linenumber % 2)::VARCHAR AS url
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
)"""


def roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes (class_id, name), with one that no entry names."""
    nation = load(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("class_id"), F.col("n_name").alias("name"))
    return nation.unionByName(spark.range(1).select(F.lit(99).alias("class_id"), F.lit("NONE").alias("name")))


ROSTER_SQL = "roster AS (SELECT n_nationkey AS class_id, n_name AS name FROM nation UNION ALL SELECT 99, 'NONE')"


def spells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue rows from parts: id, name, school, level, tags, components, cost."""
    return load(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.when(F.col("p_size") % 7 != 0, F.col("p_brand")).alias("school"),
        F.when(F.col("p_size") % 5 != 0, F.col("p_size") % 10).alias("level"),
        F.array_distinct(F.concat(F.split("p_type", " "), F.slice(F.split("p_name", " "), 1, 1))).alias("tags"),
        F.split("p_type", " ").alias("components"),
        F.col("p_retailprice").alias("cost"),
    )


SPELLS_SQL = """spells AS (
  SELECT p_partkey AS id, p_name AS name, CASE WHEN p_size % 7 <> 0 THEN p_brand END AS school, CASE WHEN p_size % 5 <> 0 THEN p_size % 10 END AS level,
    list_distinct(list_concat(string_split(p_type, ' '), [string_split(p_name, ' ')[1]])) AS tags, string_split(p_type, ' ') AS components, p_retailprice AS cost
  FROM part
)"""
