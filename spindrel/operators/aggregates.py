"""Aggregations whose results depend on the order of first sight."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _votes(df: DataFrame, keys: list[str], value: str, seq: str) -> DataFrame:
    return df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"), F.min(seq).alias("_first"))


def majority_vote(df: DataFrame, keys: list[str], value: str, seq: str) -> DataFrame:
    """(keys, value, votes): the most common value per key; the one seen first among equals."""
    best = F.max_by(F.struct(F.col(value).alias("v"), F.col("_n").alias("n")), F.struct("_n", -F.col("_first")))
    return _votes(df, keys, value, seq).groupBy(*keys).agg(best.alias("_b")).select(*keys, F.col("_b.v").alias(value), F.col("_b.n").alias("votes"))


def by_frequency(df: DataFrame, keys: list[str], value: str, seq: str) -> DataFrame:
    """(keys, value as array): distinct values, most common first, then first seen."""
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("_n")).alias("n"), F.col("_first").alias("s"), F.col(value).alias("v"))))
    return _votes(df, keys, value, seq).groupBy(*keys).agg(F.transform(ranked, lambda x: x.v).alias(value))


def ordered_distinct(df: DataFrame, keys: list[str], value: str, seq: str) -> DataFrame:
    """(keys, value as array): distinct values in order of first sight. Distinct values are
    reduced before they are gathered, so that repeated values cost nothing."""
    first = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.min(seq).alias("_s"))
    return first.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("_s", value))), lambda x: x[value]).alias(value))


def gathered(df: DataFrame, keys: list[str], values: dict[str, Column], seq: str, *, many: dict[str, Column] | None = None, common_first: bool = False) -> DataFrame:
    """(keys, an array for each name): distinct values of several columns in one pass, in order
    of first sight, or most common first. Columns of `many` are arrays of values."""
    def named(kind):
        return lambda x: F.struct(F.lit(kind).alias("kind"), x.cast("string").alias("v"))

    pairs = F.array(*(named(k)(c) for k, c in values.items()))
    for k, c in (many or {}).items():
        pairs = F.concat(pairs, F.transform(F.coalesce(c, F.expr("cast(array() as array<string>)")), named(k)))
    each = df.select(*keys, F.col(seq).alias("_s"), F.explode(pairs).alias("_p")).where("_p.v is not null")
    each = each.groupBy(*keys, F.col("_p.kind").alias("_kind"), F.col("_p.v").alias("_v")).agg(F.count("*").alias("_n"), F.min("_s").alias("_f"))
    place = F.struct((-F.col("_n") if common_first else F.lit(0)).alias("n"), F.col("_f").alias("f"), F.col("_v").alias("v"))
    lists = [F.transform(F.array_sort(F.collect_list(F.when(F.col("_kind") == k, place))), lambda x: x.v).alias(k) for k in (*values, *(many or {}))]
    return each.groupBy(*keys).agg(*lists)


def bucket(n_links: Column, n_live: Column, n_dead: Column, n_open: Column) -> Column:
    """Coverage of a thing by its links."""
    return F.when(n_links == 0, "no_links").when(n_open > 0, "unknown").when(n_dead == 0, "all_live").when(n_live == 0, "none_live").otherwise("partial")


def coverage(df: DataFrame, keys: list[str], status: str) -> DataFrame:
    """(keys, n_links, n_live, n_dead, n_unresolved, coverage) of links with a status; a
    null status is a key without link."""
    s = F.col(status)
    out = df.groupBy(*keys).agg(
        F.count(s).alias("n_links"), F.count_if(s == "yes").alias("n_live"), F.count_if(s == "no").alias("n_dead"), F.count_if(s.isNotNull() & ~s.isin("yes", "no")).alias("n_unresolved")
    )
    return out.withColumn("coverage", bucket(*(F.col(c) for c in ("n_links", "n_live", "n_dead", "n_unresolved"))))


def signatures(df: DataFrame, keys: list[str], member: str) -> DataFrame:
    """(keys, signature): the set of members in canonical order."""
    return df.groupBy(*keys).agg(F.array_sort(F.collect_set(member)).alias("signature"))


def variants(df: DataFrame, component: str, project: str, name: str, link: str, seq: str) -> DataFrame:
    """Per component: projects, and distinct (name, link set), link sets and names over them;
    a project's name is the first seen there."""
    per = df.groupBy(component, project).agg(F.array_sort(F.collect_set(link)).alias("sig"), F.min_by(name, seq).alias("name"))
    return per.groupBy(component).agg(
        F.count("*").alias("tabs"), F.count_distinct(F.struct("name", "sig")).alias("variants_full"), F.count_distinct("sig").alias("variants_links"), F.count_distinct("name").alias("variants_name")
    )


def conflicts(df: DataFrame, item: str, role: str, project: str, link: str) -> DataFrame:
    """(item, role, rank, n_projects, signature) where projects of an item and role differ in
    their link sets; variants held by most projects first."""
    sets = signatures(df, [item, role, project], link)
    held = sets.groupBy(item, role, "signature").agg(F.count("*").alias("n_projects"), F.min(project).alias("first_project"))
    per = Window.partitionBy(item, role)
    held = held.withColumn("n_variants", F.count("*").over(per)).where("n_variants > 1")
    return held.withColumn("rank", F.row_number().over(per.orderBy(F.desc("n_projects"), "first_project"))).drop("first_project")


def pivot_quantities(df: DataFrame, item: str, project: str, projects: list, text: Column, seq: str) -> DataFrame:
    """One row per item, one column qty:<project> with the distinct quantities seen there."""
    lists = ordered_distinct(df.withColumn("_q", text), [item, project], "_q", seq)
    wide = lists.groupBy(item).pivot(project, projects).agg(F.first(F.array_join("_q", "; ")))
    return wide.select(item, *(F.coalesce(F.col(f"`{p}`"), F.lit("")).alias(f"qty:{p}") for p in projects))


def pick_by_precedence(df: DataFrame, key: str, place: str, value: str, rank: str, seq: str) -> DataFrame:
    """(key, value, n_clashes): the modal value of a key in the first place by rank, and how
    many other places have another one."""
    modal = majority_vote(df.select(key, place, value, rank, seq), [key, place, rank], value, seq)
    winner = modal.groupBy(key).agg(F.min_by(value, F.struct(rank, place)).alias("_w"))
    return modal.join(winner, key).groupBy(key).agg(F.max("_w").alias(value), F.count_if(F.col(value) != F.col("_w")).alias("n_clashes"))
