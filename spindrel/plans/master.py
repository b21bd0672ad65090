"""Reports over master tables made from the whole star schema: parts as items, order priorities
as tabs, suppliers as links (lines that were returned name none)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dims
from ..operators import reports
from ..operators.resolve import Master
from .links import table

_CURRENT = ("1-URGENT", "2-HIGH")


def master(spark, sf_dir) -> Master:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag")
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderpriority").alias("project"))
    p, s = table(spark, sf_dir, "part"), table(spark, sf_dir, "supplier")
    null = F.lit(None).cast("string")
    key = F.col("p_partkey").cast("string").alias("key")
    items = p.select(key, F.col("p_partkey").alias("seq"), F.col("p_name").alias("base_key"), null.alias("scope"), null.alias("base_product"), null.alias("machining"), F.col("p_type").alias("category"),
                     F.col("p_brand").alias("best_standard"), F.array(F.col("p_brand")).alias("aliases"), F.concat(F.lit("Part "), F.col("p_partkey").cast("string")).alias("name"), F.concat(F.lit("part-"), F.col("p_partkey").cast("string")).alias("id"))
    lines = li.join(o, "l_orderkey").withColumn("key", F.col("l_partkey").cast("string"))
    uses = lines.groupBy("key", "project").agg(F.min("l_orderkey").alias("seq"), F.count("*").alias("n"))
    status = F.when(F.col("project").isin(*_CURRENT), "current").otherwise("legacy")
    qty = F.array(F.struct(F.lit("All").alias("size"), F.col("n").cast("string").alias("qty")), F.struct(F.lit("XL").alias("size"), (F.col("n") + 1).cast("string").alias("qty")))
    uses = uses.select("key", "project", F.col("project").alias("sheet"), status.alias("project_status"), "seq", qty.alias("qty"))
    role = F.when(F.col("l_returnflag") == "N", "recommended").when(F.col("l_returnflag") == "A", "alternative").otherwise("budget")
    sources = lines.where("l_returnflag <> 'R'").withColumn("role", role).groupBy("key", "l_partkey", "l_suppkey").agg(F.min("l_orderkey").alias("seq"), F.array_sort(F.collect_set("role")).alias("roles"), F.array_sort(F.collect_set("project")).alias("projects"))
    ranks = F.create_map(*(F.lit(x) for i, name in enumerate(dims.ROLE_ORDER) for x in (name, i)))
    state = F.expr("case when (l_partkey + l_suppkey) % 40 = 0 then 'maybe' when l_partkey % 11 = 0 then 'no' when l_partkey % 13 = 0 then 'yes' when l_suppkey % 3 = 0 then 'no' else 'yes' end")
    codes = F.when(F.pmod("l_suppkey", F.lit(4)) == 0, F.array(F.concat(F.lit("https://s.click.aliexpress.com/"), F.col("l_suppkey").cast("string")))).otherwise(F.expr("cast(array() as array<string>)"))
    sources = sources.join(s.select(F.col("s_suppkey").alias("l_suppkey"), "s_name"), "l_suppkey").select(
        "key", F.col("l_suppkey").cast("string").alias("url_key"), F.concat(F.lit("https://shop/"), F.col("l_suppkey").cast("string")).alias("url"), (F.pmod("l_suppkey", F.lit(5)) == 0).alias("affiliate"), "seq", "roles", "projects",
        F.array("s_name").alias("labels"), codes.alias("affiliate_urls"), F.lit("shop").alias("vendor_id"), F.col("s_name").alias("vendor_name"), state.alias("link_ok"),
        F.array_min(F.transform("roles", lambda x: F.element_at(ranks, x))).alias("role_rank"),
    )
    tenth = p.where("p_size % 10 = 0")
    unlinked = tenth.select(key, F.col("p_type").alias("label"), F.array(F.lit("unknown")).alias("roles"), F.array(F.lit("1-URGENT")).alias("projects"), F.col("p_partkey").alias("seq"))
    notes = tenth.select(key, F.col("p_brand").alias("note"), F.array(F.lit("2-HIGH")).alias("projects"), F.col("p_partkey").alias("seq"))
    return Master(items, uses, sources, unlinked, notes)


def _codes(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    return s.select(F.concat(F.lit("https://s.click.aliexpress.com/"), F.col("s_suppkey").cast("string")).alias("url"), F.when(F.pmod("s_suppkey", F.lit(8)) == 0, "no").otherwise("yes").alias("status"))


def report_coverage(spark, sf_dir):
    return reports.coverage(master(spark, sf_dir))


def report_coverage_summary(spark, sf_dir):
    return reports.coverage_summary(master(spark, sf_dir))


def report_conflicts(spark, sf_dir):
    return reports.conflicts(master(spark, sf_dir))


def report_shared_links(spark, sf_dir):
    """Links held by two to four items, where every order is a link of all its parts. All but
    the similarity of names, which SQL has no function for."""
    m = master(spark, sf_dir)
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey").distinct()
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.array("o_orderpriority").alias("projects"))
    m.sources = li.join(o, "l_orderkey").select(
        F.col("l_partkey").cast("string").alias("key"), F.concat(F.lit("https://shop/order/"), F.col("l_orderkey").cast("string")).alias("url"), F.lit(0).alias("role_rank"), "projects", F.lit("shop").alias("vendor_name"), F.col("l_orderkey").alias("seq")
    )
    return reports.shared_links(m).drop("name_similarity")


def report_unlinked(spark, sf_dir):
    """Item and tab pairs without a link that is named on that tab."""
    return reports.unlinked(master(spark, sf_dir))


def report_affiliates(spark, sf_dir):
    return reports.affiliates(master(spark, sf_dir), _codes(spark, sf_dir))


TABS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def report_canonical(spark, sf_dir):
    """Canonical rows, with all live links in one column, as their number is data."""
    df = reports.canonical(master(spark, sf_dir), TABS)
    n = sum(c.startswith("link_") for c in df.columns) // 2
    links = F.array_join(F.filter(F.array(F.lit(""), *(F.concat_ws(" > ", F.nullif(f"link_{i}", F.lit("")), F.nullif(f"link_{i}_url", F.lit(""))) for i in range(1, n + 1))), lambda x: x != ""), " | ")
    kept = [c for c in df.columns if not c.startswith(("link_", "qty:"))]
    return df.select(*kept, *(F.col(f"`qty:{t}`").alias(f"qty_{i}") for i, t in enumerate(TABS, 1)), links.alias("links"))


def report_links_per_vendor(spark, sf_dir):
    return reports.links_per_vendor(master(spark, sf_dir))


def report_master_links(spark, sf_dir):
    m = master(spark, sf_dir)
    m.sources = m.sources.withColumn("link_note", F.lit(None).cast("string"))
    return reports.master_links(m)


QUERIES = {f.__name__: f for f in (report_coverage, report_coverage_summary, report_conflicts, report_shared_links, report_unlinked, report_affiliates, report_canonical, report_links_per_vendor, report_master_links)}

_M = """l as (select l_partkey as k, l_suppkey as s, l_orderkey as o, o_orderpriority as t, case l_returnflag when 'N' then 'recommended' when 'A' then 'alternative' else 'budget' end as r from lineitem join orders on o_orderkey = l_orderkey),
uses as (select k, t, min(o) as seq, count(*) as n from l group by 1, 2),
src as (select k, s, s_name as v, 'https://shop/' || s as url, min(o) as seq, case when (k + s) % 40 = 0 then 'maybe' when k % 11 = 0 then 'no' when k % 13 = 0 then 'yes' when s % 3 = 0 then 'no' else 'yes' end as ok, list_sort(list(distinct r)) as roles, list_sort(list(distinct t)) as tabs,
  min(case r when 'recommended' then 0 when 'alternative' then 1 else 2 end) as rank from l join supplier on s_suppkey = s where r <> 'budget' group by k, s, s_name),
n as (select k, count(*) as n_links, count(*) filter (ok = 'yes') as n_live, count(*) filter (ok = 'no') as n_dead, count(*) filter (ok = 'maybe') as n_unresolved from src group by 1),
cov as (select p_partkey as k, coalesce(n_links, 0) as n_links, coalesce(n_live, 0) as n_live, coalesce(n_dead, 0) as n_dead, coalesce(n_unresolved, 0) as n_unresolved,
  case when n_links is null then 'no_links' when n_unresolved > 0 then 'unknown' when n_dead = 0 then 'all_live' when n_live = 0 then 'none_live' else 'partial' end as coverage from part left join n on k = p_partkey),
tab as (select k, string_agg(t, ' ' order by seq, t) as projects, count(*)::int as tabs, string_agg(distinct case when t < '3' then 'current' else 'legacy' end, ' ' order by case when t < '3' then 'current' else 'legacy' end) as project_status,
  count(*) filter (t < '3') as n_current from uses group by 1)"""
_ORDER = "order by rank, len(tabs) desc, v, seq"

SQL = {
    "report_coverage": f"""with {_M}, a as (select k, string_agg(v, ' | ' order by v) filter (ok = 'yes') as live_vendors, string_agg(v, ' | ' order by v) filter (ok = 'no') as dead_vendors,
string_agg(url, ' | ' {_ORDER}) filter (ok = 'yes') as live_links, string_agg(url, ' | ' {_ORDER}) filter (ok = 'no') as dead_links from src group by 1)
select coverage, 'part-' || p_partkey as id, 'Part ' || p_partkey as name, p_type as category, p_brand as standard, n_links, n_live, n_dead, n_unresolved, coalesce(live_vendors, '') as live_vendors, coalesce(dead_vendors, '') as dead_vendors,
projects, project_status, tabs, case when p_size % 10 = 0 then p_type else '' end as text_only_sources, coalesce(dead_links, '') as dead_links, coalesce(live_links, '') as live_links
from part join cov on cov.k = p_partkey left join a on a.k = p_partkey left join tab on tab.k = p_partkey""",
    "report_coverage_summary": f"with {_M} select coverage, count(*) as n_items, count(*) filter (n_current > 0) as n_current from cov left join tab using (k) group by 1",
    "report_conflicts": f"""with {_M}, e as (select k, url, v, r, unnest(tabs) as t from (select k, url, v, tabs, unnest(roles) as r from src where k in (select k from tab where tabs > 1)) where r <> 'budget'),
sets as (select k, r, t, string_agg(url, ' | ' order by url) as urls, string_agg(v, ' | ' order by v) as vendors from e group by 1, 2, 3),
held as (select k, r, urls, vendors, list_sort(list(t)) as ts, string_agg(distinct case when t < '3' then 'current' else 'legacy' end, ' ' order by case when t < '3' then 'current' else 'legacy' end) as project_statuses from sets group by 1, 2, 3, 4),
w as (select *, count(*) over (partition by k, r) as n_variants, cast(row_number() over (partition by k, r order by len(ts) desc, ts) as int) as variant from held)
select 'part-' || k as item_id, 'Part ' || k as item_name, p_type as category, r as role, n_variants, variant, array_to_string(ts, ' ') as projects, project_statuses, vendors, urls from w join part on p_partkey = k where n_variants > 1""",
    "report_shared_links": f"""with {_M}, it as (select p_partkey as k, p_name as base, row_number() over (order by p_type, lower('Part ' || p_partkey), p_partkey) as rk from part),
ln as (select distinct l.k, o, base, rk from l join it using (k)), fan as (select o, min((rk, o)) as first from ln group by o having count(*) between 2 and 4), lk as (select ln.*, first from ln join fan using (o)),
pr as (select least(a.base, b.base) as x, greatest(a.base, b.base) as y, a.o, a.k as ka, b.k as kb, row_number() over (partition by least(a.base, b.base), greatest(a.base, b.base) order by a.first, a.rk, b.rk) as p
  from lk a join lk b on a.o = b.o and a.rk < b.rk and a.base <> b.base),
ur as (select x, y, string_agg(distinct 'https://shop/order/' || o, ' | ' order by 'https://shop/order/' || o) as urls, count(distinct o)::int as shared_links from pr group by 1, 2)
select shared_links, 'part-' || ka as id_a, 'Part ' || ka as name_a, ta.projects as projects_a, 'part-' || kb as id_b, 'Part ' || kb as name_b, tb.projects as projects_b, urls from pr join ur using (x, y) join tab ta on ta.k = ka join tab tb on tb.k = kb where p = 1""",
    "report_unlinked": f"""with {_M}, h as (select distinct k, unnest(tabs) as t from src)
select 'part-' || k as item_id, 'Part ' || k as item_name, p_type as category, t as project, case when t < '3' then 'current' else 'legacy' end as project_status,
case when p_size % 10 = 0 and t = '1-URGENT' then p_type else '' end as text_only_sources from uses join part on p_partkey = k where not exists (select 1 from h where h.k = uses.k and h.t = uses.t)""",
    "report_affiliates": f"""with {_M} select case ok when 'yes' then 'affiliate dead, product link fine' when 'no' then 'both dead' else 'affiliate dead, product link unresolved' end as verdict, 'part-' || k as item_id, 'Part ' || k as item_name,
url as product_link, ok as product_link_status, 'https://s.click.aliexpress.com/' || s as dead_affiliate_links, '' as live_affiliate_links, array_to_string(tabs, ' ') as projects from src where s % 8 = 0""",
    "report_canonical": f"""with {_M}, live as (select *, row_number() over (partition by k order by rank, len(tabs) desc, v, seq) as i from src where ok = 'yes'),
q as (select k, {", ".join(f"max(n || '; ' || (n + 1) || '@XL') filter (t = '{t}') as q{i}" for i, t in enumerate(TABS, 1))} from uses group by 1),
c as (select k, string_agg(t, ' ' order by seq, t) as current_tabs from uses where t < '3' group by 1),
x as (select k, count(*)::int as c, string_agg(v, ' | ' order by i) as vendors, string_agg(v || ' > ' || url, ' | ' order by i) as links from live group by 1)
select 'part-' || p_partkey as id, 'Part ' || p_partkey as name, p_type as category, p_brand as standard, coverage, '' as scope, '' as base_product, '' as machining, tabs as n_tabs, projects as tabs, coalesce(current_tabs, '') as current_tabs, coalesce(c, 0)::int as n_live_links,
coalesce(vendors, '') as vendors, case when p_size % 10 = 0 then p_type else '' end as text_only_sources, p_brand as aliases, case when p_size % 10 = 0 then p_brand else '' end as notes, {", ".join(f"coalesce(q{i}, '') as qty_{i}" for i in range(1, 6))}, coalesce(links, '') as links
from part join cov on cov.k = p_partkey left join tab on tab.k = p_partkey left join q on q.k = p_partkey left join c on c.k = p_partkey left join x on x.k = p_partkey""",
    "report_links_per_vendor": f"with {_M} select v as vendor_name, count(*) as links from src group by 1 order by links desc, min(seq) limit 25",
    "report_master_links": f"""with {_M} select 'part-' || k as item_id, 'Part ' || k as item_name, url, 'shop' as vendor_id, v as vendor_name, s % 5 = 0 as affiliate, ok as link_ok, cast(null as varchar) as link_note, v as labels,
array_to_string(roles, ' | ') as roles, array_to_string(tabs, ' | ') as projects, case when s % 4 = 0 then 'https://s.click.aliexpress.com/' || s else '' end as affiliate_urls from src""",
}
