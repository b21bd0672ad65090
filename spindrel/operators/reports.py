"""Reports over the master tables: coverage, conflicts, shared links, affiliates, workload, canonical rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dims, text, urls
from ..functions.similarity import ratio
from . import aggregates, joins, linkstate, resolve
from .resolve import Master, Rules


def is_short(url: Column) -> Column:
    """Shortened codes, which say nothing about the product behind them."""
    return url.contains("s.click.aliexpress") | url.contains("a.aliexpress")


def _gather(df: DataFrame, keys: list[str], value: Column, order: list, name: str) -> DataFrame:
    """(keys, name as array): values in order."""
    pairs = F.array_sort(F.collect_list(F.struct(*(o.alias(f"o{i}") for i, o in enumerate(order)), value.alias("v"))))
    return df.groupBy(*keys).agg(F.transform(pairs, lambda x: x.v).alias(name))


def _ranked() -> list[Column]:
    """Best source first: role, then tabs that name it, vendor and first sight."""
    return [F.col("role_rank"), -F.size("projects"), F.coalesce("vendor_name", F.lit("")), F.col("seq")]


def link_label(labels: Column, vendor: Column, url: Column) -> Column:
    """The first wording that is no affiliate tag, else the vendor, else the url."""
    named = F.filter(labels, lambda x: (x != "") & ~text.is_affiliate_label(x))
    return F.coalesce(F.get(named, 0), vendor, url)


def live_links(m: Master) -> DataFrame:
    """(key, links): live sources as structs (label, url, vendor, url_key), best first."""
    live = m.sources.where("link_ok = 'yes'")
    link = F.struct(link_label(F.col("labels"), F.col("vendor_name"), F.col("url")).alias("label"), "url", F.coalesce("vendor_name", F.lit("?")).alias("vendor"), "url_key")
    return _gather(live, ["key"], link, _ranked(), "links")


def _texts(m: Master) -> DataFrame:
    return _gather(m.unlinked, ["key"], F.col("label"), [F.col("seq")], "texts")


def _tabs(m: Master) -> DataFrame:
    """(key, tabs, current, statuses) in order of first sight."""
    tab = _gather(m.uses, ["key"], F.struct("project", "project_status"), [F.col("seq")], "t")
    current = F.filter("t", lambda x: x.project_status == "current")
    return tab.select("key", F.transform("t", lambda x: x.project).alias("tabs"), F.transform(current, lambda x: x.project).alias("current"), F.array_sort(F.array_distinct(F.transform("t", lambda x: x.project_status))).alias("statuses"))


def _or_empty(name: str, kind: str = "array<string>") -> Column:
    return F.coalesce(F.col(name), F.expr(f"cast(array() as {kind})"))


def coverage(m: Master) -> DataFrame:
    """Per item its bucket, counts, vendors, tabs and links by state, in report order."""
    states = m.sources.withColumn("_ok", F.col("link_ok"))
    out = resolve.coverage_report(m).join(m.items.select("key", F.coalesce("best_standard", F.lit("")).alias("standard")), "key")
    for state, prefix in (("yes", "live"), ("no", "dead")):
        some = states.where(F.col("_ok") == state)
        out = out.join(_gather(some, ["key"], F.col("url"), _ranked(), f"{prefix}_links"), "key", "left")
        out = out.join(some.groupBy("key").agg(F.array_sort(F.collect_set(F.coalesce("vendor_name", F.lit("?")))).alias(f"{prefix}_vendors")), "key", "left")
    out = out.join(_tabs(m), "key", "left").join(_texts(m), "key", "left")
    bar = lambda c: F.array_join(_or_empty(c), " | ").alias(c)
    rank = F.array_position(F.array(*map(F.lit, dims.BUCKETS)), F.col("coverage"))
    return out.orderBy(rank, F.coalesce("category", F.lit("zz")), F.lower("name")).select(
        "coverage", "id", "name", "category", "standard", "n_links", "n_live", "n_dead", "n_unresolved", bar("live_vendors"), bar("dead_vendors"), F.array_join("tabs", " ").alias("projects"),
        F.array_join("statuses", " ").alias("project_status"), F.size("tabs").alias("tabs"), F.array_join(_or_empty("texts"), " | ").alias("text_only_sources"), bar("dead_links"), bar("live_links"),
    )


def coverage_summary(m: Master) -> DataFrame:
    """(coverage, n_items, n_current): bucket sizes and how many are on a current tab."""
    c = resolve.coverage_report(m).join(_tabs(m), "key", "left")
    return c.groupBy("coverage").agg(F.count("*").alias("n_items"), F.count_if(F.size(_or_empty("current")) > 0).alias("n_current"))


def conflicts(m: Master) -> DataFrame:
    """Tabs that point to different products for the same item and role: one row per set of
    links. A source counts for every role and every tab that names it."""
    shared = m.uses.groupBy("key").count().where("count > 1").select("key")
    s = m.sources.join(shared, "key", "left_semi").select("key", "url", F.coalesce("vendor_name", F.lit("?")).alias("vendor"), F.explode("roles").alias("role"), "projects")
    s = s.where("role in ('recommended', 'alternative')").withColumn("project", F.explode("projects"))
    sets = s.groupBy("key", "role", "project").agg(F.array_sort(F.collect_set("url")).alias("urls"), F.collect_set("vendor").alias("v"))
    sets = sets.join(projects_status(m), "project", "left")
    held = sets.groupBy("key", "role", "urls").agg(F.array_sort(F.collect_set("project")).alias("projects"), F.array_sort(F.collect_set(F.coalesce("project_status", F.lit("?")))).alias("statuses"), F.array_sort(F.first("v")).alias("vendors"))
    per = Window.partitionBy("key", "role")
    held = held.withColumn("n_variants", F.count("*").over(per)).where("n_variants > 1")
    held = held.withColumn("variant", F.row_number().over(per.orderBy(F.desc(F.size("projects")), "projects")))
    return held.join(m.items.select("key", F.col("id").alias("item_id"), F.col("name").alias("item_name"), "category"), "key").select(
        "item_id", "item_name", "category", "role", "n_variants", "variant", F.array_join("projects", " ").alias("projects"), F.array_join("statuses", " ").alias("project_statuses"),
        F.array_join("vendors", " | ").alias("vendors"), F.array_join("urls", " | ").alias("urls"),
    )


def projects_status(m: Master) -> DataFrame:
    return m.uses.select("project", "project_status").distinct()


def _sides(m: Master) -> dict[str, DataFrame]:
    """Both sides of a pair of items: id, name, projects in order of first sight, category."""
    both = m.items.select("id", "name", "category", "key").join(_tabs(m).select("key", F.array_join("tabs", " ").alias("projects")), "key", "left")
    return {s: both.select(F.col("id").alias(f"id_{s}"), F.col("name").alias(f"name_{s}"), F.col("projects").alias(f"projects_{s}"), F.col("category").alias(f"_cat_{s}")) for s in "ab"}


def near_names(m: Master, reviewed: DataFrame | None = None) -> DataFrame:
    """(score, id_a, name_a, projects_a, id_b, name_b, projects_b, same_category) of items
    with similar names, most similar first."""
    items = m.items.select("seq", "id", F.concat_ws(" ", text.name_key(F.col("name")), F.regexp_replace(F.coalesce("scope", F.lit("")), r"[^a-z0-9.]+", " ")).alias("key"), "base_key")
    items = items.withColumn("key", F.trim("key"))
    side = _sides(m)
    out = joins.near_names(items, reviewed).join(side["a"], "id_a").join(side["b"], "id_b").orderBy(F.desc("score"), "id_a", "id_b")
    return out.select("score", "id_a", "name_a", "projects_a", "id_b", "name_b", "projects_b", F.when(F.col("_cat_a").eqNullSafe(F.col("_cat_b")), "yes").otherwise("").alias("same_category"))


def shared_links(m: Master, reviewed: DataFrame | None = None) -> DataFrame:
    """(name_similarity, shared_links, id_a, name_a, projects_a, id_b, name_b, projects_b,
    urls) of different components that share a link held by two to four items; more on one
    link mean a search page. Of items with one base key those that share the first link, in
    the order of the published tables, stand for it. Most similar names first."""
    at = F.struct(F.coalesce("category", F.lit("zz")).alias("c"), F.lower("name").alias("n"), F.col("seq").alias("s"))
    items = m.items.select("key", "id", "base_key", at.alias("at"))
    place = F.struct(*(x.alias(f"r{i}") for i, x in enumerate(_ranked())))
    links = m.sources.groupBy("key", "url").agg(F.min(place).alias("place")).join(items, "key")
    fan = links.groupBy("url").agg(F.count("*").alias("n"), F.min(F.struct("at", "place")).alias("first")).where("n between 2 and 4").select("url", "first")
    links = links.join(fan, "url").select("url", "first", "key", "id", "base_key", "at")
    a, b = (links.select("url", *(["first"] if s == "a" else []), *(F.col(c).alias(f"{c}_{s}") for c in ("key", "id", "base_key", "at"))) for s in "ab")
    pairs = a.join(b, "url").where("at_a < at_b and base_key_a <> base_key_b")
    if reviewed is not None:
        pairs = joins.exclude_reviewed(pairs, "base_key_a", "base_key_b", reviewed)
    pairs = pairs.withColumn("x", F.least("base_key_a", "base_key_b")).withColumn("y", F.greatest("base_key_a", "base_key_b"))
    pairs = pairs.groupBy("x", "y").agg(F.min_by(F.struct("key_a", "id_a", "key_b", "id_b"), F.struct("first", "at_a", "at_b")).alias("p"), F.array_sort(F.collect_set("url")).alias("urls"))
    side = _sides(m)
    out = pairs.select("p.*", "urls").withColumn("name_similarity", ratio(F.col("key_a"), F.col("key_b"))).withColumn("shared_links", F.size("urls"))
    out = out.join(side["a"], "id_a").join(side["b"], "id_b").orderBy(F.desc("name_similarity"), F.desc("shared_links"), "id_a", "id_b")
    return out.select("name_similarity", "shared_links", "id_a", "name_a", "projects_a", "id_b", "name_b", "projects_b", F.array_join("urls", " | ").alias("urls"))


def unlinked(m: Master) -> DataFrame:
    """Item and tab without any link, with the guidance in words that the tab gives."""
    words = m.unlinked.select("key", "label", "seq", F.explode("projects").alias("project"))
    said = _gather(words, ["key", "project"], F.col("label"), [F.col("seq")], "texts")
    out = resolve.unlinked_report(m).join(m.items.select("key", "id", "name", "category"), "key").join(said, ["key", "project"], "left")
    return out.select(F.col("id").alias("item_id"), F.col("name").alias("item_name"), "category", "project", "project_status", F.array_join(_or_empty("texts"), " | ").alias("text_only_sources"))


def affiliates(m: Master, status: DataFrame) -> DataFrame:
    """Sources whose affiliate code is dead, with what is left of the product link. `status`
    is the link state (url, status)."""
    codes = m.sources.select("key", "url_key", F.posexplode("affiliate_urls").alias("n", "code")).where(is_short(F.col("code")))
    codes = codes.join(status.select(F.col("url").alias("code"), F.col("status").alias("ok")), "code", "left")
    by = ["key", "url_key"]
    s = m.sources
    for ok, name in (("no", "dead"), ("yes", "live")):
        s = s.join(_gather(codes.where(F.col("ok") == ok), by, F.col("code"), [F.col("n")], name), by, "left").withColumn(name, _or_empty(name))
    verdict = linkstate.affiliate_verdict(F.col("link_ok"), is_short(F.col("url")), F.size("live"), F.size("dead"))
    only = verdict == "only link is a dead affiliate code"
    order = ["affiliate dead, product link fine", "affiliate dead, product link unresolved", "only link is a dead affiliate code", "both dead"]
    out = s.withColumn("verdict", verdict).where("verdict is not null").join(m.items.select("key", "id", "name"), "key")
    out = out.orderBy(F.array_position(F.array(*map(F.lit, order)), F.col("verdict")), F.lower("name"), "seq")
    return out.select(
        "verdict", F.col("id").alias("item_id"), F.col("name").alias("item_name"), F.col("url").alias("product_link"), F.col("link_ok").alias("product_link_status"),
        F.when(only, F.col("url")).otherwise(F.array_join("dead", " | ")).alias("dead_affiliate_links"), F.when(only, "").otherwise(F.array_join("live", " | ")).alias("live_affiliate_links"),
        F.array_join("projects", " ").alias("projects"),
    )


def workload(raw: DataFrame, r: Rules) -> DataFrame:
    """Per component: tabs, and the distinct (name, links), link sets and names over them. A
    component is split by project only; elements of a set are (link or wording, role)."""
    rows = resolve.keyed_rows(raw, r)
    rows = rows.withColumn("key", F.when(F.col("split"), F.concat("base_key", F.lit(" @"), "project")).otherwise(F.col("base_key")))
    cells = urls.identified(resolve.folded_cells(rows), "url", key="url_key")
    element = F.when(F.coalesce(F.col("url") != "", F.lit(False)), F.col("url_key")).otherwise(F.concat(F.lit("text:"), F.lower("label")))
    cells = cells.select("seq", F.concat_ws("\t", element, text.role(F.col("slot"))).alias("link"), element.alias("e")).where("e is not null")
    uses = rows.select("key", "project", "name", "seq").join(cells.select("seq", "link"), "seq", "left")
    per = uses.groupBy("key", "project").agg(F.min_by("name", "seq").alias("name"))
    names = per.groupBy("key").agg(F.min_by("name", F.struct(F.length("name"), "name")).alias("name"), F.array_join(F.array_sort(F.collect_set("name")), " | ").alias("names"), F.array_join(F.array_sort(F.collect_list("project")), " ").alias("projects"))
    return names.join(aggregates.variants(uses, "key", "project", "name", "link", "seq"), "key").orderBy(F.desc("variants_full"), F.desc("tabs"), "name")


def workload_totals(work: DataFrame) -> DataFrame:
    """One row of totals over workload(): uses, variants, what is left to do by hand."""
    multi = F.col("tabs") > 1
    return work.agg(
        F.count("*").alias("components"), F.sum("tabs").alias("uses"), F.sum("variants_full").alias("variants_full"), F.sum("variants_links").alias("variants_links"), F.sum("variants_name").alias("variants_name"),
        (F.sum("tabs") - F.sum("variants_full")).alias("identical_repeats"), F.count_if(F.col("variants_full") == 1).alias("without_variants"), F.count_if(F.col("variants_links") > 1).alias("links_differ"),
        F.count_if((F.col("variants_name") > 1) & (F.col("variants_links") == 1)).alias("names_differ_only"), F.count_if(multi).alias("shared"), F.coalesce(F.sum(F.when(multi, F.col("variants_full"))), F.lit(0)).alias("shared_variants"),
        F.round(F.try_divide(F.sum("tabs"), F.count("*")), 4).alias("uses_per_component"), F.round(F.try_divide(F.sum("variants_full"), F.count("*")), 4).alias("variants_per_component"),
    )


def link_totals(raw: DataFrame, m: Master) -> DataFrame:
    """(metric, value): link cells, distinct urls behind them, distinct products."""
    cells = raw.join(resolve.projects(raw.sparkSession).select("sheet"), "sheet", "left_semi").select(F.explode("entries").alias("e")).where("e.url <> ''").select(F.col("e.url").alias("u"))
    cells = urls.identified(cells, "u", key="u")
    own = cells.agg(F.count("*").alias("cells"), F.count_distinct("u").alias("urls"))
    rows = own.select(F.explode(F.create_map(F.lit("link cells"), F.col("cells"), F.lit("distinct urls"), F.col("urls"))).alias("metric", "value"))
    return rows.unionByName(m.sources.agg(F.count_distinct("url").alias("value")).select(F.lit("distinct products").alias("metric"), "value"))


def headline(raw: DataFrame, m: Master, reviewed: DataFrame | None = None) -> DataFrame:
    """(metric, value) in report order."""
    c = conflicts(m)
    current = m.uses.where("project_status = 'current'").select("project").distinct()
    live = c.select("item_id", "role", "urls", F.explode(F.split("projects", " ")).alias("project")).join(current, "project", "left_semi")
    disagree = live.groupBy("item_id", "role").agg(F.count_distinct("urls").alias("n")).where("n > 1").select("item_id").distinct()
    s, vendor = m.sources, F.col("vendor_id").isin("aliexpress", "amazon")
    short = vendor & (F.col("url").contains("s.click.") | F.col("url").contains("amzn.to") | F.col("url").contains("a.aliexpress.com"))
    numbers = [
        ("tabs", raw.agg(F.count_distinct("sheet"))), ("rows", raw.agg(F.count("*"))), ("components", m.items.agg(F.count("*"))),
        ("components on several tabs", m.uses.groupBy("key").count().agg(F.count_if(F.col("count") > 1))), ("distinct product links", s.agg(F.count_distinct("url"))), ("component links", s.agg(F.count("*"))),
        ("affiliate links", s.agg(F.count_if("affiliate"))), ("components whose tabs disagree", c.agg(F.count_distinct("item_id"))), ("… on current tabs", disagree.agg(F.count("*"))),
        ("shortened links", s.agg(F.count_if(short))), ("similar names to review", near_names(m, reviewed).agg(F.count("*"))),
    ]
    out = None
    for i, (name, df) in enumerate(numbers):
        one = df.toDF("value").select(F.lit(i).alias("n"), F.lit(name).alias("metric"), "value")
        out = one if out is None else out.unionByName(one)
    return out.orderBy("n").drop("n")


def components_per_tab(m: Master) -> DataFrame:
    names = resolve.projects(m.uses.sparkSession).select("project", "project_name", F.col("project_status").alias("status"))
    return names.join(m.uses.groupBy("project").count(), "project", "left").select("project_name", "status", F.coalesce("count", F.lit(0)).alias("components"))


def links_per_vendor(m: Master, top: int = 25) -> DataFrame:
    """The `top` vendors by links; the one seen first among equals."""
    return m.sources.groupBy("vendor_name").agg(F.count("*").alias("links"), F.min("seq").alias("_s")).orderBy(F.desc("links"), "_s").limit(top).drop("_s")


def _qty(m: Master) -> DataFrame:
    """(key, project, qty): quantities of a use, with the size unless it is for all."""
    shown = F.transform("qty", lambda q: F.when(F.coalesce(q["size"], F.lit("All")) != "All", F.concat(q["qty"], F.lit("@"), q["size"])).otherwise(q["qty"]))
    return m.uses.select("key", "project", F.array_join(F.array_distinct(F.coalesce(shown, F.expr("cast(array() as array<string>)"))), "; ").alias("qty"))


def canonical(m: Master, tabs: list[str]) -> DataFrame:
    """One row per item: identity, coverage, a quantity per tab, and its live links in as many
    columns as the widest item needs (one number is read to know how many)."""
    out = m.items.join(resolve.coverage_report(m).select("key", "coverage"), "key").join(_tabs(m), "key", "left").join(live_links(m), "key", "left").join(_texts(m), "key", "left")
    out = out.join(_gather(m.notes, ["key"], F.col("note"), [F.col("seq")], "_notes"), "key", "left")
    wide = _qty(m).groupBy("key").pivot("project", tabs).agg(F.first("qty"))
    out = out.join(wide.select("key", *(F.coalesce(F.col(f"`{t}`"), F.lit("")).alias(f"qty:{t}") for t in tabs)), "key", "left")
    links = F.coalesce("links", F.expr("cast(array() as array<struct<label: string, url: string, vendor: string, url_key: string>>)"))
    out = out.withColumn("links", links)
    widest = live_links(m).agg(F.max(F.size("links"))).first()[0] or 0
    at = lambda i, f: F.coalesce(F.get("links", i)[f], F.lit(""))
    blank = lambda c, name=None: F.coalesce(F.col(c), F.lit("")).alias(name or c)
    return out.orderBy(F.lower(F.coalesce("category", F.lit("zz"))), F.lower("name")).select(
        "id", "name", "category", blank("best_standard", "standard"), "coverage", blank("scope"), blank("base_product"), blank("machining"), F.size("tabs").alias("n_tabs"), F.array_join("tabs", " ").alias("tabs"),
        F.array_join("current", " ").alias("current_tabs"), F.size("links").alias("n_live_links"), F.array_join(F.array_distinct(F.transform("links", lambda x: x.vendor)), " | ").alias("vendors"),
        F.array_join(F.array_sort(_or_empty("texts")), " | ").alias("text_only_sources"), F.array_join(_or_empty("aliases"), " | ").alias("aliases"), F.array_join(_or_empty("_notes"), " / ").alias("notes"),
        *(f"`qty:{t}`" for t in tabs), *(at(i, "label").alias(f"link_{i + 1}") for i in range(widest)), *(at(i, "url").alias(f"link_{i + 1}_url") for i in range(widest)),
    )


def master_links(m: Master) -> DataFrame:
    """One row per item and source."""
    lists = ("labels", "roles", "projects", "affiliate_urls")
    out = m.sources.join(m.items.select("key", F.col("id").alias("item_id"), F.col("name").alias("item_name")), "key").orderBy("item_id", *_ranked())
    return out.select("item_id", "item_name", "url", "vendor_id", "vendor_name", "affiliate", "link_ok", "link_note", *(F.array_join(_or_empty(c), " | ").alias(c) for c in lists))


def master_items(m: Master, tabs: list[str]) -> DataFrame:
    """One row per item, in order: identity, counts, and a quantity per tab."""
    links = m.sources.groupBy("key").agg(F.count("*").alias("n_links"))
    wide = _qty(m).groupBy("key").pivot("project", tabs).agg(F.first("qty"))
    out = resolve.in_order(m.items.join(_tabs(m), "key", "left").join(links, "key", "left").join(wide, "key", "left"))
    return out.select(
        "id", "category", "name", F.coalesce("scope", F.lit("")).alias("scope"), F.col("best_standard").alias("standard"), F.array_join(_or_empty("aliases"), " | ").alias("aliases"), F.size("tabs").alias("n_projects"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"), F.array_join("tabs", " ").alias("projects"), *(F.coalesce(F.col(f"`{t}`"), F.lit("")).alias(f"qty:{t}") for t in tabs),
    )


def nested(m: Master) -> DataFrame:
    """The master as one row per item, in order, with its uses, sources, guidance in words and
    notes as arrays of structs, each in order of first sight (sources: best first)."""
    def rows(df, columns, order, name):
        return _gather(df, ["key"], F.struct(*columns), order, name)

    seq = [F.col("seq")]
    parts = [
        rows(m.uses, ["project", "sheet", "rows", "qty", "choice_group"], seq, "used_by"),
        rows(m.sources, ["url", "url_key", F.col("vendor_id").alias("vendor"), "vendor_name", "labels", "roles", "projects", "affiliate_urls", "raw_urls", "affiliate", "seen", "link_ok", "reason", "affiliate_link_ok", "link_note"], _ranked(), "sources"),
        rows(m.unlinked, [F.col("label").alias("text"), "roles", "projects"], seq, "unlinked_sources"),
        rows(m.notes, [F.col("note").alias("text"), "projects"], seq, "notes"),
    ]
    out = m.items
    for part in parts:
        name = part.columns[-1]
        out = out.join(part, "key", "left").withColumn(name, _or_empty(name, part.schema[name].dataType.simpleString()))
    return resolve.in_order(out).select("id", "name", F.col("key").alias("name_key"), "base_key", "scope", "base_product", "machining", "aliases", "category", "categories", F.col("best_standard").alias("standard"), "standards", "used_by", "sources", "unlinked_sources", "notes")


def vendors(m: Master) -> DataFrame:
    """(id, name, links) of all vendors, most links first, then first seen."""
    v = m.sources.where("vendor_id is not null").groupBy(F.col("vendor_id").alias("id")).agg(F.min_by("vendor_name", "seq").alias("name"), F.count("*").alias("links"), F.min("seq").alias("_s"))
    return v.orderBy(F.desc("links"), "_s").drop("_s")


def tally(df: DataFrame, column: str) -> DataFrame:
    """(column, n): how often each value stands, as verdicts, outcomes or kinds of a table."""
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)


def report_text(raw: DataFrame, m: Master, reviewed: DataFrame | None = None) -> str:
    """The headline numbers, components per tab and links per vendor as a page of text. Its
    tables have a fixed number of rows, or one for each tab."""
    lines = ["# Unified sourcing data - extraction report", "", "| metric | value |", "| --- | ---: |"]
    lines += [f"| {r['metric']} | {r['value']} |" for r in headline(raw, m, reviewed).collect()]
    lines += ["", "## Components per tab", "", "| tab | status | components |", "| --- | --- | ---: |"]
    lines += [f"| {r[0]} | {r[1]} | {r[2]} |" for r in components_per_tab(m).collect()]
    lines += ["", "## Links per vendor", "", "| vendor | links |", "| --- | ---: |"]
    lines += [f"| {r[0]} | {r[1]} |" for r in links_per_vendor(m).collect()]
    return "\n".join(lines) + "\n"


def workload_top(work: DataFrame, top: int = 15) -> DataFrame:
    """The components with most variants, which a report shows."""
    return work.orderBy(F.desc("variants_full"), F.desc("tabs"), "name").limit(top)
