"""Sources: JSON documents, JSON lines, CSV, TSV, HTML and raw files, with the checks that a scan must make."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path of any file system that Spark reads is there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def optional(spark: SparkSession, path: str, read) -> DataFrame | None:
    """The table, or None where the source is absent: checks on it are then skipped."""
    return read(path) if exists(spark, path) else None


def json_lines(spark: SparkSession, path: str, schema: T.StructType | str, file_column: str | None = "_file") -> DataFrame:
    """Strict JSON lines with the name of the file; a bad line fails the job."""
    rows = spark.read.schema(schema).json(path, mode="FAILFAST")
    return rows.withColumn(file_column, F.col("_metadata.file_name")) if file_column else rows


def json_lines_checked(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Good rows, and bad lines with their file; blank lines are skipped."""
    raw = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    lines = spark.read.text(path).where("trim(value) <> ''").select(F.from_json("value", raw, {"columnNameOfCorruptRecord": "_bad"}).alias("r"), F.col("_metadata.file_name").alias("_file"))
    rows = lines.select("r.*", "_file")
    return rows.where("_bad IS NULL").drop("_bad"), rows.where("_bad IS NOT NULL").select("_file", "_bad")


def json_documents(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """One document for each file."""
    return spark.read.schema(schema).json(path, multiLine=True, mode="FAILFAST")


def csv_table(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True, multiLine=True, escape='"', encoding="UTF-8")


def alias_lines(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Rows (file, alias, id) of tab-separated lines, and lines without exactly two filled fields. Blank lines and
    comments are skipped."""
    lines = spark.read.text(path).select(F.col("_metadata.file_name").alias("file"), F.col("value")).where("trim(value) <> '' AND NOT startswith(ltrim(value), '#')")
    parts = lines.withColumn("p", F.transform(F.split("value", "\t"), lambda x: F.trim(x)))
    good = (F.size("p") == 2) & F.forall("p", lambda x: x != "")
    return parts.where(good).select("file", F.col("p")[0].alias("alias"), F.col("p")[1].alias("id")), parts.where(~good).select("file", "value")


def raw_files(spark: SparkSession, path: str) -> DataFrame:
    """path, size, sha1, text (null unless strict UTF-8), problem (encoding, bom, replacement or null)."""
    files = spark.read.format("binaryFile").load(path)
    text = F.when(F.is_valid_utf8(F.col("content").cast("string")), F.col("content").cast("string"))
    problem = F.when(text.isNull(), "encoding").when(F.startswith(text, F.lit("﻿")), "bom").when(F.contains(text, F.lit("�")), "replacement")
    return files.select("path", F.col("length").alias("size"), F.sha1("content").alias("sha1"), text.alias("text"), problem.alias("problem"))


def first_by_key(rows: DataFrame, key: str, position: list[str]) -> tuple[DataFrame, DataFrame]:
    """The first row of each key, and those that it drops."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(*position))
    marked = rows.withColumn("_place", place)
    return marked.where("_place = 1").drop("_place"), marked.where("_place > 1").drop("_place")


def last_by_key(rows: DataFrame, key: str, position: str) -> DataFrame:
    """The last row of each key, without a window: one partial aggregation."""
    others = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*others), position).alias("r")).select(key, *[F.col(f"r.{c}").alias(c) for c in others])


def vocabulary(spark: SparkSession, values: list[str]) -> DataFrame:
    """value, code of a closed list in its own order; a repeated value is an error."""
    if len(set(values)) != len(values):
        raise ValueError("a vocabulary names a value twice")
    return spark.createDataFrame([(v, i) for i, v in enumerate(values)], "value string, code int")


def id_set(rows: DataFrame, key: str, only: list | None = None) -> DataFrame:
    """Distinct ids in order; an empty set, or an id asked for that isn't there, is an error."""
    ids = rows.where(F.col(key).isNotNull()).select(key).distinct()
    if ids.isEmpty():
        raise ValueError(f"no {key} at all")
    if only is not None:
        asked = rows.sparkSession.createDataFrame([(v,) for v in only], ids.schema)
        unknown = asked.join(ids, key, "left_anti").limit(5).collect()
        if unknown:
            raise ValueError(f"unknown {key}: {[r[0] for r in unknown]}")
        ids = ids.join(asked, key, "left_semi")
    return ids.orderBy(key)


def enveloped(raw, data: str):
    """struct (meta, data) of a rule table's text, its data by a schema; null where it can't be read or has no data."""
    meta, body = F.get_json_object(raw, "$.meta"), F.get_json_object(raw, "$.data")
    read = F.from_json(body, data)
    return F.when(F.json_object_keys(raw).isNotNull() & read.isNotNull(), F.struct(meta.alias("meta"), read.alias("data")))


def all_or_nothing(values, valid):
    """The array if all its elements are valid, else null."""
    return F.when(F.forall(values, lambda v: F.coalesce(valid(v), F.lit(False))), values)


def range_or_values(rows):
    """Of structs (low, high, value, modifier): those with a range and those with a value, told apart; null where one is
    neither."""
    ranged = lambda r: r["low"].isNotNull() & r["high"].isNotNull() & r["value"].isNull()
    single = lambda r: r["value"].isNotNull() & r["low"].isNull()
    fine = F.forall(rows, lambda r: r["modifier"].isNotNull() & (ranged(r) | single(r)))
    return F.when(fine, F.struct(F.filter(rows, ranged).alias("ranges"), F.filter(rows, single).alias("values")))


def preflight(files: DataFrame, required: list[str], least: int, most: int) -> DataFrame:
    """problem, path of raw files (see ``raw_files``): required names that are missing, files that can't be decoded or hold a
    replacement character, and a count out of its band."""
    asked = files.sparkSession.createDataFrame([(n,) for n in required], "name string")
    name = F.substring_index("path", "/", -1)
    missing = asked.join(files.select(name.alias("name")), "name", "left_anti").select(F.lit("missing").alias("problem"), F.col("name").alias("path"))
    broken = files.where("problem IS NOT NULL").select("problem", name.alias("path"))
    count = files.agg(F.count("*").alias("n")).where(~F.col("n").between(least, most)).select(F.lit("count").alias("problem"), F.col("n").cast("string").alias("path"))
    return missing.unionByName(broken).unionByName(count)


def taxonomy_label(versions: list[str]) -> str:
    """The latest version of all vocabularies; a draft (v0) is refused."""
    if not versions or "v0" in versions:
        raise ValueError("a vocabulary isn't frozen")
    return max(versions, key=lambda v: [int(x) for x in v.lstrip("v").split(".")])

