"""The master fold: raw catalogue rows to items, uses, sources, notes and unlinked sources.

Raw rows have seq (global order), sheet, row, category, component, standard, qty, size
(strings), notes (array of strings) and entries (array of struct col, slot, kind, text,
url). Order of first sight decides ties, so every step carries seq.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import dims, text, urls
from . import aggregates, joins, linkstate, windows
from .staging import stage

RAW = (
    "seq long, sheet string, row int, category string, component string, standard string, qty string, size string, notes array<string>, "
    "entries array<struct<col: string, slot: string, kind: string, text: string, url: string>>"
)


@dataclass
class Rules:
    """Alias rules as small tables: merge (key, canonical), names (key, name), drop (key),
    split_names (key), split_categories (category), family_names (key)."""

    merge: DataFrame
    names: DataFrame
    drop: DataFrame
    split_names: DataFrame
    split_categories: DataFrame
    family_names: DataFrame


@dataclass
class Master:
    items: DataFrame
    uses: DataFrame
    sources: DataFrame
    unlinked: DataFrame
    notes: DataFrame


def rules(spark: SparkSession, spec: dict) -> Rules:
    """Rules out of the parsed alias file; absent parts are empty."""

    def keys(names, column="key"):
        return spark.createDataFrame([(n,) for n in names], f"{column} string").select(text.name_key(F.col(column)).alias(column)).where(f"{column} is not null").distinct()

    merge = spark.createDataFrame(list(spec.get("merge", {}).items()), "key string, canonical string")
    merge = merge.select(text.name_key(F.col("key")).alias("key"), text.name_key(F.col("canonical")).alias("canonical")).where("key is not null and canonical is not null")
    names = spark.createDataFrame(list(spec.get("names", {}).items()), "key string, name string").select(text.name_key(F.col("key")).alias("key"), text.clean_text(F.col("name")).alias("name"))
    by_project, by_family = spec.get("split_by_project", {}), spec.get("split_by_family", {})
    categories = spark.createDataFrame([(c.strip().lower(),) for c in by_project.get("categories", [])], "category string")
    return Rules(merge.dropDuplicates(["key"]), names.dropDuplicates(["key"]), keys(spec.get("drop", [])), keys(by_project.get("names", [])), categories.distinct(), keys(by_family.get("names", [])))


def projects(spark: SparkSession) -> DataFrame:
    rows = [(*p, dims.FAMILIES.get(p[1], p[1])) for p in dims.PROJECTS]
    return spark.createDataFrame(rows, "sheet string, project string, project_name string, kind string, project_status string, family string")


def _flag(df: DataFrame, table: DataFrame, column: str, on: Column, name: str) -> DataFrame:
    marked = table.select(F.col(column).alias("_m"), F.lit(True).alias(name))
    return df.join(marked, on == F.col("_m"), "left").drop("_m").withColumn(name, F.coalesce(name, F.lit(False)))


def keyed_rows(raw: DataFrame, r: Rules) -> DataFrame:
    """Rows of known projects that name a component, with base_key, scope and item key.
    Choice groups are found before rows are dropped, as separators make them."""
    spark = raw.sparkSession
    # a separator row belongs to the sheet's order even if its project is unknown
    tidy = {"_c": text.clean_text(F.col("component")), "_cat": text.clean_text(F.col("category")), "_std": text.clean_text(F.col("standard"))}
    rows = windows.or_groups(raw.withColumns(tidy), "sheet", ["row"], F.coalesce(F.upper("_c") == "OR", F.lit(False)), "row")
    rows = rows.join(projects(spark), "sheet").where(~text.is_drop_row(F.col("_c"), cleaned=True))
    rows = rows.withColumn("_k", text.name_key(F.col("_c"), cleaned=True)).where("_k is not null")
    rows = rows.join(r.drop.withColumnRenamed("key", "_k"), "_k", "left_anti")
    rows = rows.join(r.merge.select(F.col("key").alias("_k"), "canonical"), "_k", "left").withColumn("_p", text.part_number(F.col("_c")))
    rows = rows.withColumn("base_key", F.coalesce(text.name_key(F.col("_p.full"), cleaned=True), "canonical", "_k")).withColumn("cat", text.category(F.col("_cat"), cleaned=True))
    rows = _flag(rows, r.family_names, "key", F.col("base_key"), "_family")
    rows = _flag(rows, r.split_names, "key", F.col("base_key"), "_by_name")
    rows = _flag(rows, r.split_categories, "category", F.lower("cat"), "_by_cat")
    split = F.col("_by_name") | F.col("_by_cat")
    scope = F.when(F.col("_family"), F.col("family")).when(split, F.col("project"))
    rows = rows.withColumn("scope", scope).withColumn("key", joins.scope_key(F.col("base_key"), F.col("_family"), split, F.col("family"), F.col("project")))
    group = F.when(F.col("choice_group").isNotNull(), F.concat("project", F.lit("#or"), F.col("choice_group").cast("string")))
    return rows.select("seq", "sheet", "row", "project", "project_status", "key", "base_key", split.alias("split"), "scope", F.col("_c").alias("name"), "cat", F.col("_p.base").alias("base_product"),
                       F.col("_p.machining").alias("machining"), F.col("_std").alias("standard"), "qty", "size", "notes", "entries", group.alias("choice_group"))


def folded_cells(rows: DataFrame) -> DataFrame:
    """Vendor cells by source within their row: affiliate tags joined to the link they mark."""
    cells = rows.where(F.size("entries") > 0).select("seq", "sheet", "row", "project", "key", F.explode("entries").alias("e")).select("seq", "sheet", "row", "project", "key", "e.*")
    cells = cells.withColumn("label", text.clean_text(F.col("text"))).withColumn("width", F.length("col"))
    cells = windows.fold_tags(cells, ["seq"], ["width", "col"], "slot", text.is_affiliate_label(F.col("label")), "url")
    order = F.struct("width", "col")
    return cells.groupBy("seq", "sheet", "row", "project", "key", "slot", "head").agg(
        F.min_by("label", order).alias("label"),
        F.min_by("url", order).alias("url"),
        F.transform(F.array_sort(F.collect_list(F.struct("width", "col", "url"))), lambda x: x.col).alias("cols"),
        F.expr("transform(filter(array_sort(collect_list(struct(width, col, url))), (x, i) -> i > 0 and x.url is not null and x.url <> ''), x -> x.url)").alias("affiliate_urls"),
    )


def _list(df: DataFrame, keys: list[str], value: str, seq: str) -> DataFrame:
    return aggregates.ordered_distinct(df, keys, value, seq)


def fold(raw: DataFrame, r: Rules, status: DataFrame | None = None) -> Master:
    """The master tables. `status` (url, status, reason) is the merged link state; without it
    every link is unchecked. An empty catalogue gives empty tables. Rows have no order of
    their own: seq is the order of first sight, in_order() that of the published tables."""
    rows = stage(keyed_rows(raw, r))  # read by every table below
    items = rows.groupBy("key").agg(F.min("seq").alias("seq"), F.min_by("base_key", "seq").alias("base_key"), F.min_by("scope", "seq").alias("scope"), F.min_by("base_product", "seq").alias("base_product"), F.min_by("machining", "seq").alias("machining"))
    seen = aggregates.gathered(rows, ["key"], {"aliases": F.col("name"), "categories": F.col("cat"), "standards": F.col("standard")}, "seq", common_first=True)
    items = items.join(seen, "key").withColumn("_name", F.get("aliases", 0)).withColumn("category", F.get("categories", 0)).withColumn("best_standard", F.get("standards", 0))
    items = items.join(r.names.select(F.col("key").alias("base_key"), F.col("name").alias("_wish")), "base_key", "left").withColumn("name", F.coalesce("_wish", "_name"))
    scope = F.when(F.col("scope").isNotNull(), F.concat(F.lit("."), "scope")).otherwise("")
    items = items.withColumn("_base", F.concat(text.slug(F.coalesce("category", F.lit("misc"))), F.lit("."), text.slug(F.col("name")), scope))
    items = windows.numbered_ids(items, "_base", ["seq"]).drop("_base", "_name", "_wish")
    items = items.withColumn("aliases", F.array_except("aliases", F.array("name")))

    size = F.coalesce(text.clean_size(F.col("size")), F.lit("All"))
    counted = rows.withColumn("q", F.struct(size.alias("size"), text.qty_text(F.col("qty")).alias("qty"), text.qty_number(F.col("qty")).alias("qty_num")))
    uses = rows.groupBy("key", "project", "sheet", "project_status").agg(
        F.array_sort(F.collect_list("row")).alias("rows"), F.max_by("choice_group", F.when(F.col("choice_group").isNotNull(), F.col("seq"))).alias("choice_group"), F.min("seq").alias("seq")
    )
    uses = uses.join(_list(counted.where("q.qty is not null"), ["key", "project"], "q", "seq").withColumnRenamed("q", "qty"), ["key", "project"], "left")

    cells = folded_cells(rows).withColumn("order", F.col("seq") * 100000 + F.col("head")).withColumn("role", text.role(F.col("slot")))
    cells = stage(cells)
    linked = stage(urls.identified(cells.where("url is not null and url <> ''"), "url", key="url_key", canonical="canonical", affiliate="marked", label="label"))
    seen = F.struct("order", "project", "sheet", "row", "cols", "slot")
    by = ["key", "url_key"]
    sources = linked.groupBy(*by).agg(
        F.min_by("canonical", "order").alias("url"), F.min_by("marked", "order").alias("affiliate"), F.array_sort(F.collect_list(seen)).alias("seen"), F.min("order").alias("seq")
    )
    lists = {"labels": F.col("label"), "roles": F.col("role"), "projects": F.col("project"), "raw_urls": F.col("url")}
    sources = sources.join(aggregates.gathered(linked, by, lists, "order", many={"affiliate_urls": F.col("affiliate_urls")}), by)
    vendors = raw.sparkSession.createDataFrame(dims.VENDORS, "suffix string, vendor_id string, vendor_name string")
    sources = joins.longest_suffix(sources.withColumn("host", urls.host_of(F.col("url"))), "host", vendors)
    if status is None:
        sources = sources.withColumn("link_ok", F.lit("unchecked")).withColumn("reason", F.lit(None).cast("string"))
        codes = F.transform(F.coalesce("affiliate_urls", F.expr("cast(array() as array<string>)")), lambda x: F.lit("unchecked"))
    else:
        state = status.select("url", F.col("status").alias("link_ok"), "reason")
        each = sources.select(*by, F.posexplode("affiliate_urls").alias("n", "code")).join(state.select(F.col("url").alias("code"), F.col("link_ok").alias("ok")), "code", "left")
        ordered = F.array_sort(F.collect_list(F.struct("n", F.coalesce("ok", F.lit("unchecked")).alias("ok"))))
        each = each.groupBy(*by).agg(F.transform(ordered, lambda x: x.ok).alias("_codes"))
        sources = sources.join(state, "url", "left").withColumn("link_ok", F.coalesce("link_ok", F.lit("unchecked"))).join(each, by, "left")
        codes = F.coalesce("_codes", F.expr("cast(array() as array<string>)"))
    sources = sources.withColumn("affiliate_link_ok", codes)  # as affiliate_urls, place by place
    dead = F.array_contains("affiliate_link_ok", "no")
    short = F.col("url").contains("s.click.aliexpress") | F.col("url").contains("a.aliexpress")
    sources = sources.withColumn("link_note", linkstate.link_note(F.col("reason"), F.col("link_ok"), short, dead)).drop("_codes")
    ranks = F.create_map(*(F.lit(x) for i, name in enumerate(dims.ROLE_ORDER) for x in (name, i)))
    sources = sources.withColumn("role_rank", F.array_min(F.transform("roles", lambda x: F.element_at(ranks, x))))

    plain = cells.where("(url is null or url = '') and label is not null")
    unlinked = plain.groupBy("key", "label").agg(F.min("order").alias("seq"))
    unlinked = unlinked.join(aggregates.gathered(plain, ["key", "label"], {"roles": F.col("role"), "projects": F.col("project")}, "order"), ["key", "label"])
    noted = rows.select("key", "project", "seq", F.explode("notes").alias("note")).withColumn("note", text.clean_text(F.col("note"))).where("note is not null")
    notes = noted.groupBy("key", "note").agg(F.min("seq").alias("seq")).join(_list(noted, ["key", "note"], "project", "seq").withColumnRenamed("project", "projects"), ["key", "note"])
    return Master(*map(stage, (items, uses, sources)), unlinked, notes)


def coverage_report(m: Master) -> DataFrame:
    """Every item with the state of its links, in report order."""
    links = m.items.select("key").join(m.sources.select("key", F.col("link_ok").alias("status")), "key", "left")
    rank = F.array_position(F.array(*map(F.lit, dims.BUCKETS)), F.col("coverage"))
    out = aggregates.coverage(links, ["key"], "status").join(m.items.select("key", "id", "name", "category"), "key")
    return out.orderBy(rank, F.coalesce("category", F.lit("zz")), F.lower("name"))


def unlinked_report(m: Master) -> DataFrame:
    """Item and project pairs without any link."""
    have = m.sources.select("key", F.explode("projects").alias("project")).distinct()
    return m.uses.select("key", "project", "project_status").join(have, ["key", "project"], "left_anti")


def in_order(items: DataFrame) -> DataFrame:
    """Items in the order of the published tables."""
    return items.orderBy(F.coalesce("category", F.lit("zz")), F.lower("name"), "seq")


def failures(raw: DataFrame, r: Rules, m: Master, manual: DataFrame | None = None) -> DataFrame:
    """(check, what): what the master lost or got wrong. Links by url key, spellings by
    project, notes, verdicts by hand (url) that no link has, repeated ids, uses on unknown
    projects, and urls that are none. Every check reads the raw rows again, not the fold."""
    spark = raw.sparkSession
    rows = raw.join(projects(spark).select("sheet", "project"), "sheet").withColumn("k", text.name_key(F.col("component")))
    rows = rows.join(r.drop.withColumnRenamed("key", "k"), "k", "left_anti")
    links = rows.select(F.explode("entries").alias("e")).where("e.url is not null and e.url <> ''").select(F.col("e.url").alias("u")).distinct()
    links = urls.identified(links, "u", key="what").select("what").distinct()
    none = F.expr("cast(array() as array<string>)")
    kept = m.sources.select("url_key", F.explode(F.concat(F.array("url"), F.coalesce("affiliate_urls", none), F.coalesce("raw_urls", none))).alias("u"))
    kept = urls.identified(kept.distinct(), "u", key="k").select(F.explode(F.array("url_key", "k")).alias("what")).distinct()
    named = rows.where("k is not null and k <> 'or' and not startswith(k, 'as an amazon') and not startswith(k, 'as an aliexpress')")
    spelled = m.items.select("key", F.explode(F.concat(F.array("name"), F.coalesce("aliases", none))).alias("n")).join(m.uses.select("key", "project"), "key").select(text.name_key(F.col("n")).alias("k"), "project")
    pairs = named.select("k", "project").distinct().join(spelled, ["k", "project"], "left_anti").select(F.concat_ws(" on ", "k", "project").alias("what"))
    notes = named.select(F.explode("notes").alias("n")).select(text.clean_text(F.col("n")).alias("what")).where("what is not null").distinct().join(m.notes.select(F.col("note").alias("what")), "what", "left_anti")
    found = {
        "urls": links.join(kept, "what", "left_anti"), "names": pairs, "notes": notes,
        "ids": m.items.groupBy("id").count().where("count > 1").select(F.col("id").alias("what")),
        "projects": m.uses.join(projects(spark).select("project"), "project", "left_anti").select(F.concat_ws(" on ", "project", "key").alias("what")),
        "bad urls": m.sources.where("not startswith(url, 'http')").select(F.concat_ws(" on ", "url", "key").alias("what")),
    }
    if manual is not None:
        real = m.sources.select(F.explode(F.concat(F.array("url"), F.coalesce("affiliate_urls", none))).alias("url"))
        found["verdicts"] = manual.select("url").distinct().join(real, "url", "left_anti").select(F.col("url").alias("what"))
    out = None
    for name, df in found.items():
        one = df.select(F.lit(name).alias("check"), "what")
        out = one if out is None else out.unionByName(one)
    return out


#: The checks of failures(), with the most lines of each that are shown to people.
CHECKS = {"urls": 10, "names": 10, "notes": 5, "verdicts": 40, "ids": 40, "projects": 40, "bad urls": 40}


def validate(raw: DataFrame, r: Rules, m: Master, manual: DataFrame | None = None) -> DataFrame:
    """(check, missing, shown): number of failures(), all zero for a lossless fold, and the
    first of them as an array."""
    every = raw.sparkSession.createDataFrame([(c, n) for c, n in CHECKS.items() if manual is not None or c != "verdicts"], "check string, most int")
    n = F.row_number().over(Window.partitionBy("check").orderBy("what"))
    found = failures(raw, r, m, manual).withColumn("n", n).join(F.broadcast(every), "check")  # seven rows
    found = found.groupBy("check").agg(F.count("*").alias("missing"), F.array_sort(F.collect_list(F.when(F.col("n") <= F.col("most"), F.col("what")))).alias("shown"))
    return every.join(found, "check", "left").select("check", F.coalesce("missing", F.lit(0)).alias("missing"), F.coalesce("shown", F.expr("cast(array() as array<string>)")).alias("shown"))
