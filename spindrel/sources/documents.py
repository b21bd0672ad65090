"""Readers of the catalogue's files: alias rules, link states, cookies, report CSVs."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STATUS = "checked_with string, links map<string, struct<status: string, reason: string, http: int, final_url: string, checked_at: string>>"
MANUAL = "links map<string, struct<status: string, note: string, by: string, at: string>>"


def optional(spark: SparkSession, schema: str, read) -> DataFrame:
    """read(), or an empty relation where the path does not exist."""
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _links(spark: SparkSession, path: str, schema: str) -> DataFrame:
    docs = optional(spark, schema, lambda: spark.read.option("multiLine", True).schema(schema).json(path))
    return docs.select(F.explode("links").alias("url", "v")).select("url", "v.*")


def link_status(spark: SparkSession, measured: str, manual: str) -> DataFrame:
    """(url, status, reason, http, final_url, checked_at, verified): manual verdicts win."""
    m = _links(spark, measured, STATUS).withColumn("verified", F.lit(None).cast("string"))
    by_hand = _links(spark, manual, MANUAL).select(
        "url", F.coalesce("status", F.lit("maybe")).alias("status"), F.coalesce("note", F.lit("checked by hand")).alias("reason"), F.lit(None).cast("int").alias("http"),
        F.lit(None).cast("string").alias("final_url"), F.col("at").alias("checked_at"), F.lit("manual").alias("verified"),
    )
    return m.join(by_hand, "url", "left_anti").unionByName(by_hand)


def alias_spec(spark: SparkSession, path: str) -> dict:
    """The alias file as a dictionary; empty where it is missing. It is one small document."""
    rows = optional(spark, "value string", lambda: spark.read.text(path, wholetext=True)).collect()
    return json.loads(rows[0]["value"]) if rows else {}


def reviewed_pairs(spark: SparkSession, spec: dict) -> DataFrame:
    """(a, b) of all pairs inside each keep-separate group, by name key."""
    from ..functions.text import name_key

    groups = spark.createDataFrame([(i, n) for i, g in enumerate(spec.get("keep_separate", {}).get("groups", [])) for n in g], "g int, n string")
    keys = groups.select("g", name_key(F.col("n")).alias("k")).where("k is not null").distinct()
    return keys.alias("x").join(keys.alias("y"), F.expr("x.g = y.g and x.k < y.k")).select(F.col("x.k").alias("a"), F.col("y.k").alias("b")).distinct()


def cookies(spark: SparkSession, path: str) -> DataFrame:
    """(domain, header) of a tab-separated cookie file, in file order; a file that holds a
    header instead is for all hosts (the empty domain). It is one small document."""
    whole = F.trim(F.regexp_replace("value", r"^\s+|\s+$", ""))
    bare = spark.read.text(path, wholetext=True).select(whole.alias("header")).where("header <> '' and not startswith(header, '#') and not contains(header, '\t')")
    part = F.split("value", "\t")
    rows = spark.read.text(path).withColumn("n", F.monotonically_increasing_id()).where(~F.col("value").startswith("#") & (F.size(part) >= 7))
    pair = F.struct("n", F.concat(part[5], F.lit("="), part[6]).alias("kv"))
    jar = rows.select(F.regexp_replace(part[0], r"^\.+", "").alias("domain"), pair.alias("p")).groupBy("domain").agg(F.array_join(F.transform(F.array_sort(F.collect_list("p")), lambda x: x.kv), "; ").alias("header"))
    return bare.select(F.lit("").alias("domain"), "header").unionByName(jar)


def report_csv(spark: SparkSession, path: str) -> DataFrame:
    """A report CSV: header, byte-order mark, doubled quotes, line breaks inside cells."""
    return spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    """The same dialect; the mark stands before the first column's name."""
    first, *rest = df.columns
    df.select(F.col(f"`{first}`").alias("﻿" + first), *(f"`{c}`" for c in rest)).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_buckets(df: DataFrame, bucket: str, path: str) -> None:
    """All rows under all, and one folder per bucket; folders of buckets that are empty now
    disappear."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{path}/all")
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(bucket).option("header", True).option("escape", '"').csv(f"{path}/by_{bucket}")


def write_json(df: DataFrame, path: str) -> None:
    """A document per row, nested as the row is."""
    df.write.mode("overwrite").json(path)


def write_raw(rows: DataFrame, layout: DataFrame, path: str) -> None:
    """Raw rows, and the layout they were read with: per sheet its slots in order."""
    slot = F.struct("start", "end", F.col("slot").alias("name"), "kind")
    write_json(rows, f"{path}/rows")
    write_json(layout.groupBy("sheet").agg(F.array_sort(F.collect_list(slot)).alias("slots")), f"{path}/layouts")


def write_master(items: DataFrame, projects: DataFrame, vendors: DataFrame, roles: list[str], path: str) -> None:
    """The nested master: an item per document, and the lists that all of them share."""
    write_json(items, f"{path}/items")
    write_json(projects, f"{path}/projects")
    write_json(vendors, f"{path}/vendors")
    write_json(items.sparkSession.createDataFrame([(i, r) for i, r in enumerate(roles)], "place int, role string"), f"{path}/roles")


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """A page of text as one file."""
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def write_fills(fills: DataFrame, path: str) -> None:
    """Colours by category as one document {category: colour}."""
    pairs = fills.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("category", "fill")))).alias("m"))
    pairs.select(F.to_json("m").alias("value")).coalesce(1).write.mode("overwrite").text(path)
