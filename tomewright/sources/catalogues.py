"""Typed scans of a rule catalogue's JSON files: objects keyed by name, enveloped lists, manifests and journals.

Every scan has its schema written out. A file that isn't strict UTF-8 JSON of the expected form fails the job, and an absent
optional one gives an empty table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tomewright.functions.text import feat_name
from tomewright.sources.records import exists, last_by_key

_TRAIT = "struct<name:string,description:string>"
_MODIFIER = "struct<ability:string,modifier:int>"
RACE = f"struct<traits:array<{_TRAIT}>,ability_modifiers:array<{_MODIFIER}>,size:string,speed:int,has_bonus_feat:boolean,bonus_skill_rank:boolean,class_skill_grants:array<string>,note:string>"
CLASS_SKILLS = "struct<class_skills:array<struct<skill:string,ability:string>>,skill_points_formula:struct<base:int,ability:string>,skill_points_formula_raw:string>"
CLASS = "struct<slug:string,nom:string,liste_sorts:string,lanceur:boolean,a_curer:boolean,raison_curation:string>"
BONUS_FEATS = "struct<levels:array<int>,category:string,note:string>"
MANIFEST = "id string, nom string, url string, statut string, cache_fichier string"
JOURNAL = "url string, fetched_at string, status int"


def _documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """file, doc: each file as one document of the schema; one that can't be read so fails the job."""
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.col("value"))
    problem = F.when(~F.is_valid_utf8("value"), "not UTF-8").when(F.contains("value", F.lit("�")), "a replacement character").when(F.try_parse_json("value").isNull(), "not JSON")
    checked = F.when(problem.isNotNull(), F.raise_error(F.concat("file", F.lit(": "), problem)).cast("string")).otherwise(F.col("value"))
    return raw.select("file", F.from_json(checked, schema, {"mode": "FAILFAST"}).alias("doc"))


def keyed(spark: SparkSession, path: str, schema: str, key: str = "key") -> DataFrame:
    """A row for each entry of an object whose names are keys and whose values have the schema (a struct)."""
    rows = _documents(spark, path, f"map<string,{schema}>").select(F.explode("doc").alias(key, "__v"))
    return rows.select(key, "__v.*")


def listed(spark: SparkSession, path: str, field: str, schema: str) -> DataFrame:
    """A row for each element of the list in a field, with its place."""
    rows = _documents(spark, path, f"struct<{field}:array<{schema}>>").select(F.posexplode(f"doc.{field}").alias("place", "__v"))
    return rows.select("place", "__v.*") if schema.startswith("struct") else rows.select("place", F.col("__v").alias("value"))


def races(spark: SparkSession, path: str) -> DataFrame:
    """key and what a race gives; lists are empty and flags false where they aren't given."""
    empty = lambda c, kind: F.coalesce(c, F.array().cast(f"array<{kind}>")).alias(c)
    flag = lambda c: F.coalesce(c, F.lit(False)).alias(c)
    return keyed(spark, path, RACE).select("key", empty("traits", _TRAIT), empty("ability_modifiers", _MODIFIER), "size", "speed", flag("has_bonus_feat"), flag("bonus_skill_rank"), empty("class_skill_grants", "string"), "note")


def class_skills(spark: SparkSession, path: str) -> DataFrame:
    rows = keyed(spark, path, CLASS_SKILLS)
    return rows.withColumn("class_skills", F.coalesce("class_skills", F.array().cast(rows.schema["class_skills"].dataType)))


def classes(spark: SparkSession, path: str) -> DataFrame:
    """The unified registry; of a repeated slug the last entry counts."""
    return last_by_key(listed(spark, path, "classes", CLASS), "slug", "place").drop("place")


def bonus_feats(spark: SparkSession, path: str) -> DataFrame:
    return keyed(spark, path, BONUS_FEATS)


def benefits(spark: SparkSession, path: str) -> DataFrame:
    """name, benefit of scraped pages, keyed by the name without its star; blank ones are left out. Absent: no rows."""
    if not exists(spark, path):
        return spark.createDataFrame([], "name string, benefit string")
    rows = keyed(spark, path, "struct<avantages_detail:string>", "name").select(feat_name(F.col("name")).alias("name"), F.trim("avantages_detail").alias("benefit")).where("benefit <> ''")
    return rows.groupBy("name").agg(F.max("benefit").alias("benefit"))


def supplements(spark: SparkSession, path: str) -> DataFrame:
    """name, added: curated prerequisites; entries that add nothing are left out, of a repeated name the last counts. Absent: no rows."""
    if not exists(spark, path):
        return spark.createDataFrame([], "name string, added array<string>")
    rows = listed(spark, path, "entries", "struct<don:string,ajouts:array<string>>").where(F.size("ajouts") > 0)
    return last_by_key(rows.select(feat_name(F.col("don")).alias("name"), "place", F.col("ajouts").alias("added")), "name", "place").drop("place")


def web_index(spark: SparkSession, path: str) -> DataFrame:
    """id, name of the published entries in their order (place)."""
    return listed(spark, path, "sorts", "struct<id:string,n:string>").select("place", "id", F.col("n").alias("name"))


def free_labels(spark: SparkSession, folder: str) -> DataFrame:
    """id, place, label of every file of a folder, labels in the order in which they were given; a folder without files is an error."""
    docs = _documents(spark, folder, "struct<id:string,etiquettes:array<string>>")
    return docs.select("doc.id", F.posexplode("doc.etiquettes").alias("place", "label"))


def concept_groups(spark: SparkSession, path: str) -> DataFrame:
    """name, pattern of the concept groups in order (place); none at all is an error."""
    rows = _documents(spark, path, "struct<groupes:map<string,string>>").select(F.posexplode("doc.groupes").alias("place", "name", "pattern"))
    if rows.isEmpty():
        raise ValueError(f"no groups in {path}")
    return rows


def level_lists(spark: SparkSession, folder: str) -> DataFrame:
    """id, levels: a map of class (the file's stem) to the lowest level of a spell in its list; rows without a level are left out."""
    rows = spark.read.schema("id string, niveau int").json(folder, mode="FAILFAST").select("id", F.regexp_replace(F.col("_metadata.file_name"), r"\.jsonl?$", "").alias("class"), F.col("niveau").alias("level")).where("level IS NOT NULL")
    least = rows.groupBy("id", "class").agg(F.min("level").alias("level"))
    return least.groupBy("id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("class", "level")))).alias("levels"))


def manifest(spark: SparkSession, path: str, status: str | None = "ok") -> DataFrame:
    """Lines of a fetch manifest, of one status or all."""
    rows = spark.read.schema(MANIFEST).json(path, mode="FAILFAST")
    return rows.where(F.col("statut") == status) if status else rows


def fetch_dates(spark: SparkSession, path: str) -> DataFrame:
    """url, fetched_at: of each address the date of its last line that has one. Lines count in the order of the file, whose blocks
    Spark reads in order of their offset."""
    if not exists(spark, path):
        return spark.createDataFrame([], "url string, fetched_at string")
    rows = spark.read.schema(JOURNAL).json(path, mode="FAILFAST").withColumn("__at", F.struct(F.col("_metadata.file_name"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()))
    return rows.where("fetched_at IS NOT NULL AND fetched_at <> ''").groupBy("url").agg(F.max_by("fetched_at", "__at").alias("fetched_at"))
