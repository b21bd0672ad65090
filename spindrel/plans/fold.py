"""The master fold over a catalogue made from the parts table: every part is a row of one of
the known tabs, with spellings, separators, quantities, tags, wrapped and wordless links that
exercise the rules; a shop has a link per brand, another one for nine parts each. Links have
states by number."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dims
from ..operators import reports, resolve
from ..operators.staging import stage
from .links import table

SHOP, SHOP_ID, SHOP_NAME = dims.VENDORS[13]
CODE = "https://s.click.aliexpress.com/e/"
ITEM = "https://www.aliexpress.com/item/"
SPEC = {
    "drop": ["red plate 7", "Old ring, 30"], "merge": {"small widget 3": "small widget 4", "hot plate 10": "hot plate 11"},
    "names": {"hot ring 12": "Hot Ring Twelve", "blue ring 5": "Shared Name", "blue ring 6": "Shared Name", "blue ring 9": "Shared Name"},
    "split_by_project": {"categories": ["promo"], "names": ["large rod 9", "cold bolt 20"]}, "split_by_family": {"names": ["old rod 8", "new gear 31", "hot rod 15"]},
}


def _tabs(spark):
    return spark.createDataFrame([(i, p[0]) for i, p in enumerate(dims.PROJECTS)], "t long, sheet string")


def raw(spark, sf_dir):
    """Raw rows: sizes 48 to 50 are empty, a footer and a separator."""
    # a small file is one split, while cleaning its names takes time: dealt over all cores
    p = table(spark, sf_dir, "part").repartition(spark.sparkContext.defaultParallelism, "p_partkey")
    p = p.withColumn("b", F.expr("cast(substring(p_brand, 7) as int)")).withColumn("t", F.expr(f"p_partkey % {len(dims.PROJECTS)}"))
    p = p.withColumn("shop", F.expr("if(p_size >= 48, concat('x', b), cast(b as string))"))
    component = """case when p_size = 48 then null when p_size = 49 then 'As an Amazon associate we earn' when p_size = 50 then ' or ' when p_partkey % 13 = 0 then concat(p_name, ' hfsb5-2020-', p_size, '-ah45')
      when p_partkey % 3 = 0 then concat(p_name, chr(160), p_size) when p_partkey % 3 = 1 then concat(upper(p_name), '  ', p_size, ' pcs') else concat(p_name, ', ', p_size, '.0 –') end"""
    qty = "case p_partkey % 6 when 0 then cast(p_size as string) when 1 then concat(p_size, '.0') when 2 then 'as  needed' when 3 then '2022-02-04 00:00:00' when 5 then '2.5' end"
    size = "case p_partkey % 5 when 1 then 'True' when 2 then '250³' when 3 then ' 300' when 4 then 'False' end"
    one = f"struct('F' as col, 'Recommended' as slot, 'vendor' as kind, concat('Shop ', b) as text, if(p_partkey % 2 = 0, concat('https://www.{SHOP}/p/', shop, '?utm_source=x'), concat('http://{SHOP}/p/', shop, '/')) as url)"
    two = f"struct('G' as col, 'Recommended' as slot, 'vendor' as kind, '[Affiliate Link]' as text, concat('{CODE}', b) as url)"
    plain = f"concat('{ITEM}', 1000000 + floor(p_partkey / 9), '.html?spm=a', if(p_partkey % 15 = 0, '&aff_platform=x', ''))"
    three = f"struct('H' as col, 'Alternative Source' as slot, 'vendor' as kind, concat('Part ', floor(p_partkey / 9), ' page') as text, if(p_partkey % 9 = 0, concat('https://www.google.com/url?q=', url_encode({plain})), {plain}) as url)"
    four = "struct('AA' as col, 'Budget Source' as slot, 'vendor' as kind, concat('ask  ', p_brand) as text, cast(null as string) as url)"
    none = "cast(array() as array<struct<col: string, slot: string, kind: string, text: string, url: string>>)"
    cells = ", ".join(f"if({c}, array({x}), {none})" for c, x in (("p_size <> 47", one), ("p_size <> 47 and p_partkey % 5 = 0", two), ("p_partkey % 3 = 0", three), ("p_partkey % 4 = 1", four)))
    rows = p.join(F.broadcast(_tabs(spark)), "t").selectExpr(  # seventeen tabs
        "p_partkey as seq", "sheet", f"cast(floor(p_partkey / {len(dims.PROJECTS)}) + 2 as int) as row", "if(p_partkey % 10 = 0, 'hot end', p_type) as category", f"{component} as component",
        "if(p_partkey % 4 <> 0, p_brand, null) as standard", f"{qty} as qty", f"{size} as size",
        "case p_partkey % 6 when 0 then array(concat('see ', p_brand)) when 1 then array(concat('see  ', p_brand), '–') else cast(array() as array<string>) end as notes", f"concat({cells}) as entries", "false as continuation",
    )
    return rows


def status(spark, sf_dir):
    """(url, status, reason) by brand; some links and codes were never checked."""
    b = table(spark, sf_dir, "part").select(F.expr("cast(substring(p_brand, 7) as int)").alias("b")).distinct()
    shop = b.where("b % 4 < 3").select(F.explode(F.expr(f"array(concat('https://www.{SHOP}/p/', b), concat('https://{SHOP}/p/', b))")).alias("url"), F.expr("element_at(array('yes', 'no', 'maybe'), b % 4 + 1)").alias("status"),
                                       F.expr("case b % 4 when 0 then if(b % 3 = 0, 'product page - currently unavailable', 'http 200') when 1 then 'http 404' else 'part status is obsolete' end").alias("reason"))
    n = table(spark, sf_dir, "part").select(F.expr("floor(p_partkey / 9)").alias("n")).distinct()
    item = n.where("n % 3 < 2").select(F.expr(f"concat('{ITEM}', 1000000 + n, '.html')").alias("url"), F.expr("if(n % 3 = 0, 'yes', 'no')").alias("status"), F.lit("http").alias("reason"))
    code = b.where("b % 5 <> 0").select(F.expr(f"concat('{CODE}', b)").alias("url"), F.expr("if(b % 2 = 0, 'no', 'yes')").alias("status"), F.lit("http").alias("reason"))
    return shop.unionByName(item).unionByName(code)


def by_hand(spark, sf_dir):
    """Urls with a verdict by hand; every fifth brand's is of no link."""
    b = table(spark, sf_dir, "part").select(F.expr("cast(substring(p_brand, 7) as int)").alias("b")).distinct()
    return b.select(F.expr(f"if(b % 5 = 0, concat('https://nowhere.example/', b), concat('{ITEM}', 1000000 + b, '.html'))").alias("url"))


def _rules(spark):
    return resolve.rules(spark, SPEC)


_made: dict[tuple[str, str], resolve.Master] = {}


def master(spark, sf_dir) -> resolve.Master:
    """The master tables, folded once for an application and a folder; they lie in the shared
    folder until the application ends."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _made:
        m = resolve.fold(raw(spark, sf_dir), _rules(spark), status(spark, sf_dir))
        _made[key] = replace(m, unlinked=stage(m.unlinked), notes=stage(m.notes))
    return replace(_made[key])


def _joined(df, *lists, sep=" | "):
    """Lists as text, so that any engine can compare them; an absent list is empty."""
    for c in lists:
        df = df.withColumn(c, F.coalesce(F.array_join(F.col(c).cast("array<string>"), sep), F.lit("")))
    return df


def fold_items(spark, sf_dir):
    out = _joined(master(spark, sf_dir).items, "aliases", "categories", "standards")
    return out.select("key", "id", "name", "aliases", "category", "categories", "best_standard", "standards", "base_key", "scope", "base_product", "machining", "seq")


def fold_uses(spark, sf_dir):
    uses = master(spark, sf_dir).uses.withColumn("qty", F.expr("transform(qty, q -> concat_ws(':', q.size, q.qty, coalesce(cast(q.qty_num as string), '-')))"))
    return _joined(uses, "rows", "qty").select("key", "project", "sheet", "project_status", "rows", "qty", "choice_group", "seq")


def fold_sources(spark, sf_dir):
    s = master(spark, sf_dir).sources.withColumn("seen", F.expr("transform(seen, x -> concat(x.project, '!', array_join(x.cols, '+'), x.row))"))
    s = _joined(s, "labels", "roles", "projects", "affiliate_urls", "raw_urls", "seen", "affiliate_link_ok")
    return s.select("key", "url_key", "url", "affiliate", "labels", "roles", "projects", "affiliate_urls", "raw_urls", "seen", "vendor_id", "vendor_name", "link_ok", "reason", "affiliate_link_ok", "link_note", "role_rank")


def fold_unlinked(spark, sf_dir):
    return _joined(master(spark, sf_dir).unlinked, "roles", "projects").select("key", "label", "roles", "projects")


def fold_notes(spark, sf_dir):
    return _joined(master(spark, sf_dir).notes, "projects").select("key", "note", "projects")


def fold_validate(spark, sf_dir):
    """Links of rows that are no component are lost, and so are some verdicts by hand."""
    return _joined(resolve.validate(raw(spark, sf_dir), _rules(spark), master(spark, sf_dir), by_hand(spark, sf_dir)), "shown")


def fold_coverage(spark, sf_dir):
    return resolve.coverage_report(master(spark, sf_dir)).select("key", "n_links", "n_live", "n_dead", "n_unresolved", "coverage")


def fold_master_items(spark, sf_dir):
    tabs = [p[1] for p in dims.PROJECTS]
    out = reports.master_items(master(spark, sf_dir), tabs)
    return out.select("id", "category", "name", "scope", "standard", "aliases", "n_projects", "n_links", "projects", *(F.col(f"`qty:{t}`").alias(f"qty_{i}") for i, t in enumerate(tabs)))


def fold_shared_links(spark, sf_dir):
    """All but the similarity of names, which SQL has no function for (a test checks it)."""
    return reports.shared_links(master(spark, sf_dir)).drop("name_similarity")


def fold_headline(spark, sf_dir):
    """All but the number of similar names, for the same reason."""
    return reports.headline(raw(spark, sf_dir), master(spark, sf_dir)).where("metric <> 'similar names to review'")


def fold_tabs(spark, sf_dir):
    return reports.components_per_tab(master(spark, sf_dir))


def fold_link_totals(spark, sf_dir):
    return reports.link_totals(raw(spark, sf_dir), master(spark, sf_dir))


def fold_vendors(spark, sf_dir):
    return reports.vendors(master(spark, sf_dir))


def fold_link_states(spark, sf_dir):
    """How many links have each state."""
    return reports.tally(master(spark, sf_dir).sources, "link_ok")


def workload(spark, sf_dir):
    return reports.workload(raw(spark, sf_dir), _rules(spark))


_work: dict[tuple[str, str], DataFrame] = {}


def _workload(spark, sf_dir):
    """workload(), written once for an application and a folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _work:
        _work[key] = stage(workload(spark, sf_dir))
    return _work[key]


def workload_totals(spark, sf_dir):
    return reports.workload_totals(_workload(spark, sf_dir))


def workload_top(spark, sf_dir):
    return reports.workload_top(_workload(spark, sf_dir))


QUERIES = {f.__name__: f for f in (
    fold_items, fold_uses, fold_sources, fold_unlinked, fold_notes, fold_validate, fold_coverage, fold_master_items, fold_shared_links, fold_headline, fold_tabs, fold_link_totals, fold_vendors,
    fold_link_states, workload, workload_totals, workload_top,
)}


# ---- the same in DuckDB SQL


def _values(rows) -> str:
    def one(v):
        return "null" if v is None else str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"

    return ", ".join("(" + ", ".join(map(one, r)) + ")" for r in rows)


def _in(names) -> str:
    return "(" + ", ".join(f"'{n}'" for n in names) + ")"


def _first(name: str, source: str, keys: str, value: str, order: str, sep: str = " | ") -> str:
    """A table of distinct values per key, joined in order of first sight."""
    return f"{name} as (select {keys}, string_agg(v, '{sep}' order by f) as v from (select {keys}, {value} as v, min({order}) as f from {source} where {value} is not null group by {keys}, {value}) group by {keys})"


def _often(name: str, value: str) -> str:
    """(key, v, n, f, place): values of an item, most common first, then first seen."""
    return f"{name} as (select key, {value} as v, row_number() over (partition by key order by count(*) desc, min(seq)) as place from r where {value} is not null group by key, {value})"


_FAMILY = [(i, p[0], p[1], p[2], p[4], dims.FAMILIES.get(p[1], p[1])) for i, p in enumerate(dims.PROJECTS)]
_ROWS = f"""tabs(t, sheet, project, project_name, project_status, family) as (values {_values(_FAMILY)}),
r0 as (select p_partkey as seq, sheet, project, project_status, family, p_partkey // {len(dims.PROJECTS)} + 2 as row, p_name, p_size, p_brand, cast(substring(p_brand, 7) as int) as b, case when p_partkey % 10 = 0 then 'Hotend' else p_type end as cat,
  case when p_partkey % 4 <> 0 then p_brand end as standard, case when p_size >= 48 then 'x' else '' end || cast(substring(p_brand, 7) as int) as shop,
  case when p_size = 48 then null when p_size = 49 then 'as an amazon associate we earn' when p_size = 50 then 'or' when p_partkey % 13 = 0 then p_name || ' hfsb5 2020 ' || p_size || ' ah45' else p_name || ' ' || p_size end as nk,
  case when p_partkey % 13 = 0 then p_name || ' hfsb5-2020-' || p_size || '-ah45' when p_partkey % 3 = 0 then p_name || ' ' || p_size when p_partkey % 3 = 1 then upper(p_name) || ' ' || p_size || ' pcs' else p_name || ', ' || p_size || '.0' end as name
  from part join tabs on t = p_partkey % {len(dims.PROJECTS)}),
o1 as (select *, row_number() over (partition by sheet order by row) as pos, coalesce(lag(p_size = 50) over (partition by sheet order by row), false) as after_or from r0),
o2 as (select *, sum(case when after_or and pos > 2 then 0 else 1 end) over (partition by sheet, pos % 2 order by pos) as island from o1),
o3 as (select *, case when count(*) over (partition by sheet, pos % 2, island) > 1 then min(row) over (partition by sheet, pos % 2, island) end as chain from o2),
k0 as (select *, case when seq % 13 = 0 then 'hfsb5 2020 ' || p_size || ' ah45' when nk = 'small widget 3' then 'small widget 4' when nk = 'hot plate 10' then 'hot plate 11' else nk end as base from o3
  where p_size < 48 and nk not in ('red plate 7', 'old ring 30')),
k1 as (select *, base in ('old rod 8', 'new gear 31', 'hot rod 15') as fam, base in ('large rod 9', 'cold bolt 20') or lower(cat) = 'promo' as split from k0),
r as (select *, case when fam then family when split then project end as scope, case when fam then base || ' @' || coalesce(family, project) when split then base || ' @' || project else base end as key,
  case when chain is not null then project || '#or' || chain end as choice from k1)"""
_SLUG = "lower(trim(regexp_replace({}, '[^A-Za-z0-9]+', '-', 'g'), '-'))"
_ITEMS = f"""{_often("vn", "name")}, {_often("vc", "cat")}, {_often("vs", "standard")},
i0 as (select key, min(seq) as seq, min(base) as base_key, min(scope) as scope, case when min(base) like 'hfsb5%' then upper(replace(replace(min(base), ' ah45', ''), ' ', '-')) end as base_product, case when min(base) like 'hfsb5%' then 'AH45' end as machining from r group by key),
i1 as (select i0.*, case base_key when 'hot ring 12' then 'Hot Ring Twelve' when 'blue ring 5' then 'Shared Name' when 'blue ring 6' then 'Shared Name' when 'blue ring 9' then 'Shared Name' else (select v from vn where vn.key = i0.key and place = 1) end as name,
  (select v from vc where vc.key = i0.key and place = 1) as category, (select v from vs where vs.key = i0.key and place = 1) as best_standard from i0),
i2 as (select *, {_SLUG.format("category")} || '.' || {_SLUG.format("name")} || coalesce('.' || scope, '') as base_id from i1),
i3 as (select *, row_number() over (partition by base_id order by seq) as nth from i2),
al as (select vn.key, string_agg(v, ' | ' order by place) as v from vn join i3 using (key) where v <> name group by vn.key),
items as (select i3.*, case when nth = 1 then base_id else base_id || '-' || nth end as id, coalesce(al.v, '') as aliases from i3 left join al using (key))"""
_NUM = "case when seq % 6 in (0, 1) then p_size::double when seq % 6 = 5 then 2.5::double end"
_USES = f"""q as (select key, project, seq, case seq % 5 when 2 then '250' when 3 then '300' else 'All' end as size, case seq % 6 when 0 then p_size::varchar when 1 then p_size::varchar when 2 then 'as needed' when 3 then '2-4' when 5 then '2.5' end as qty, {_NUM} as num from r),
{_first("uq", "(select *, size || ':' || qty || ':' || coalesce(num::varchar, '-') as x from q)", "key, project", "x", "seq")},
uses as (select key, project, sheet, project_status, string_agg(row::varchar, ' | ' order by row) as rows, arg_max(choice, seq) filter (choice is not null) as choice_group, min(seq) as seq, coalesce(any_value(uq.v), '') as qty
  from r left join uq using (key, project) group by key, project, sheet, project_status)"""
_PLAIN = f"'{ITEM}' || (1000000 + n) || '.html'"
_CELLS = f"""st0 as (select distinct cast(substring(p_brand, 7) as int) as b from part),
st as (select unnest(['https://www.{SHOP}/p/' || b, 'https://{SHOP}/p/' || b]) as u, ['yes', 'no', 'maybe'][b % 4 + 1] as ok, case b % 4 when 0 then (case when b % 3 = 0 then 'product page - currently unavailable' else 'http 200' end) when 1 then 'http 404' else 'part status is obsolete' end as why from st0 where b % 4 < 3
  union all select {_PLAIN}, case when n % 3 = 0 then 'yes' else 'no' end, 'http' from (select distinct p_partkey // 9 as n from part) where n % 3 < 2 union all select '{CODE}' || b, case when b % 2 = 0 then 'no' else 'yes' end, 'http' from st0 where b % 5 <> 0),
every as (select seq, sheet, project, row, nk, b, seq * 10 + 1 as o, 'Shop ' || b as label, 'recommended' as role, 'https://' || (case when seq % 2 = 0 then 'www.' else '' end) || '{SHOP}/p/' || shop as url, 'https://{SHOP}/p/' || shop as url_key,
    case when seq % 2 = 0 then 'https://www.{SHOP}/p/' || shop || '?utm_source=x' else 'http://{SHOP}/p/' || shop || '/' end as raw, false as aff, case when seq % 5 = 0 then '{CODE}' || b end as code, case when seq % 5 = 0 then 'F+G' else 'F' end as cols from r0 where p_size <> 47
  union all select seq, sheet, project, row, nk, b, seq * 10 + 3, 'Part ' || n || ' page', 'alternative', {_PLAIN}, {_PLAIN},
    case when seq % 9 = 0 then 'https://www.google.com/url?q=' || url_encode({_PLAIN} || '?spm=a' || case when seq % 15 = 0 then '&aff_platform=x' else '' end) else {_PLAIN} || '?spm=a' || case when seq % 15 = 0 then '&aff_platform=x' else '' end end, seq % 15 = 0, null, 'H' from (select *, seq // 9 as n from r0) where seq % 3 = 0),
l as (select every.*, r.key from every join r using (seq)),
said as (select r.key, r.seq, r.project, 'ask ' || p_brand as label from r where seq % 4 = 1)"""
_K = "key, url_key"
_SRC = f"""{_first("sl", "l", _K, "label", "o")}, {_first("sr", "l", _K, "role", "o")}, {_first("sp", "l", _K, "project", "o")}, {_first("sa", "l", _K, "code", "o")}, {_first("sw", "l", _K, "raw", "o")},
sc as (select key, url_key, string_agg(coalesce(st.ok, 'unchecked'), ' | ' order by f) as v, bool_or(coalesce(st.ok = 'no', false)) as dead from (select key, url_key, code, min(o) as f from l where code is not null group by 1, 2, 3) left join st on u = code group by 1, 2),
s0 as (select key, url_key, arg_min(url, o) as url, arg_min(aff, o) as affiliate, string_agg(project || '!' || cols || row, ' | ' order by o) as seen, min(o) as seq, min(case role when 'recommended' then 0 else 1 end) as role_rank, count(distinct project) as n_tabs from l group by 1, 2),
src as (select s0.*, sl.v as labels, sr.v as roles, sp.v as projects, coalesce(sa.v, '') as affiliate_urls, sw.v as raw_urls, case when contains(s0.url_key, '{SHOP}') then '{SHOP_ID}' else 'aliexpress' end as vendor_id, case when contains(s0.url_key, '{SHOP}') then '{SHOP_NAME}' else 'AliExpress' end as vendor_name,
  coalesce(st.ok, 'unchecked') as link_ok, st.why as reason, coalesce(sc.v, '') as affiliate_link_ok,
  case when contains(st.why, 'obsolete') then 'distributor still lists the page but the part is obsolete or discontinued' when contains(st.why, 'currently unavailable') then 'listing is still up but has no buy button - currently unavailable'
    when coalesce(sc.dead, false) and st.ok = 'yes' then 'affiliate code is dead but the product link still works - drop or regenerate the code' when coalesce(sc.dead, false) and st.ok = 'no' then 'affiliate code and product link are both dead' end as link_note
  from s0 join sl using (key, url_key) join sr using (key, url_key) join sp using (key, url_key) join sw using (key, url_key) left join sa using (key, url_key) left join sc using (key, url_key) left join st on st.u = s0.url)"""
_ALL = f"with {_ROWS}, {_ITEMS}, {_USES}, {_CELLS}, {_SRC}"
_COV = """n as (select key, count(*) as n_links, count(*) filter (link_ok = 'yes') as n_live, count(*) filter (link_ok = 'no') as n_dead, count(*) filter (link_ok not in ('yes', 'no')) as n_unresolved from src group by 1),
cov as (select items.key, coalesce(n_links, 0) as n_links, coalesce(n_live, 0) as n_live, coalesce(n_dead, 0) as n_dead, coalesce(n_unresolved, 0) as n_unresolved,
  case when n_links is null then 'no_links' when n_unresolved > 0 then 'unknown' when n_dead = 0 then 'all_live' when n_live = 0 then 'none_live' else 'partial' end as coverage from items left join n using (key))"""
_TAB = "tab as (select key, string_agg(project, ' ' order by seq) as projects, count(*)::int as n_projects from uses group by key)"
_WORK = """w as (select *, case when split then base || ' @' || project else base end as wk from r),
e as (select seq, url_key || chr(9) || role as x from every union all select seq, 'text:' || lower(label) || chr(9) || 'budget' from said),
ws as (select wk, project, string_agg(distinct x, '|' order by x) as sig from w left join e using (seq) group by 1, 2), wn as (select wk, project, arg_min(name, seq) as name from w group by 1, 2),
wx as (select wk, project, coalesce(sig, '') as sig, name from ws join wn using (wk, project)),
work as (select wk as key, arg_min(name, (len(name), name)) as name, string_agg(distinct name, ' | ' order by name) as names, string_agg(project, ' ' order by project) as projects, count(*) as tabs, count(distinct (name, sig)) as variants_full,
  count(distinct sig) as variants_links, count(distinct name) as variants_name from wx group by 1)"""
_CONFLICTS = """cs as (select key, role, project, string_agg(url, '|' order by url) as sig from (select distinct l.key, role, l.project, src.url from l join src using (key, url_key)) group by 1, 2, 3),
cv as (select key, role, count(distinct sig) as n, count(distinct case when project_status = 'current' then sig end) as n_current from cs join (select distinct project, project_status from uses) using (project)
  where key in (select key from uses group by key having count(*) > 1) group by 1, 2)"""
_QTY = ", ".join(
    f"coalesce(max(case when project = '{p[1]}' then shown end), '') as qty_{i}" for i, p in enumerate(dims.PROJECTS)
)

SQL = {
    "fold_items": f"""{_ALL}, lc as (select key, string_agg(v, ' | ' order by place) as v from vc group by 1), ls as (select key, string_agg(v, ' | ' order by place) as v from vs group by 1)
select key, id, name, aliases, category, lc.v as categories, best_standard, coalesce(ls.v, '') as standards, base_key, scope, base_product, machining, seq from items left join lc using (key) left join ls using (key)""",
    "fold_uses": f"{_ALL} select key, project, sheet, project_status, rows, qty, choice_group, seq from uses",
    "fold_sources": f"{_ALL} select key, url_key, url, affiliate, labels, roles, projects, affiliate_urls, raw_urls, seen, vendor_id, vendor_name, link_ok, reason, affiliate_link_ok, link_note, role_rank from src",
    "fold_unlinked": f"{_ALL}, {_first('up', 'said', 'key, label', 'project', 'seq')} select key, label, 'budget' as roles, v as projects from up",
    "fold_notes": f"{_ALL}, {_first('np', '''(select *, 'see ' || p_brand as note from r where seq % 6 < 2)''', 'key, note', 'project', 'seq')} select key, note, v as projects from np",
    "fold_validate": f"""{_ALL}, wanted as (select url_key as u from every where nk is null or nk not in ('red plate 7', 'old ring 30') union select code from every where code is not null and (nk is null or nk not in ('red plate 7', 'old ring 30'))),
lost as (select u from wanted where u not in (select url_key from src) and u not in (select code from l where code is not null)),
hand as (select case when b % 5 = 0 then 'https://nowhere.example/' || b else {_PLAIN} end as u from (select b, b as n from st0)), orphan as (select u from hand where u not in (select url from src) and u not in (select code from l where code is not null)),
c as (select 'urls' as "check", (select count(*) from lost) as missing, (select string_agg(u, ' | ' order by u) from (select u from lost order by u limit 10)) as shown
  union all select 'verdicts', (select count(*) from orphan), (select string_agg(u, ' | ' order by u) from (select u from orphan order by u limit 40)) union all select unnest(['names', 'notes', 'ids', 'projects', 'bad urls']), 0, null)
select "check", missing, coalesce(shown, '') as shown from c""",
    "fold_coverage": f"{_ALL}, {_COV} select * from cov",
    "fold_master_items": f"""{_ALL}, {_TAB}, {_COV}, qs as (select key, project, string_agg(x, '; ' order by f) as shown from (select key, project, case when size = 'All' then qty else qty || '@' || size end as x, min(seq) as f from q where qty is not null group by 1, 2, 3) group by 1, 2),
qw as (select key, {_QTY} from items left join qs using (key) group by key)
select id, category, name, coalesce(scope, '') as scope, best_standard as standard, aliases, n_projects, n_links, projects, {", ".join(f"qty_{i}" for i in range(len(dims.PROJECTS)))} from items join tab using (key) join cov using (key) join qw using (key)""",
    "fold_shared_links": f"""{_ALL}, {_TAB}, it as (select key, id, base_key, name, row_number() over (order by coalesce(category, 'zz'), lower(name), seq) as rk from items),
ln as (select src.url, it.*, row_number() over (partition by key order by role_rank, n_tabs desc, vendor_name, src.seq) as sp from src join it using (key)),
fan as (select url, min((rk, sp)) as first from (select url, key, rk, min(sp) as sp from ln group by 1, 2, 3) group by url having count(*) between 2 and 4),
lk as (select distinct url, first, key, id, name, base_key, rk from ln join fan using (url)),
pr as (select least(a.base_key, b.base_key) as x, greatest(a.base_key, b.base_key) as y, a.url, a.id as ia, a.name as na, a.key as ka, b.id as ib, b.name as nb, b.key as kb, row_number() over (partition by least(a.base_key, b.base_key), greatest(a.base_key, b.base_key) order by a.first, a.rk, b.rk) as p
  from lk a join lk b on a.url = b.url and a.rk < b.rk and a.base_key <> b.base_key),
ur as (select x, y, string_agg(distinct url, ' | ' order by url) as urls, count(distinct url)::int as shared_links from pr group by 1, 2)
select shared_links, ia as id_a, na as name_a, ta.projects as projects_a, ib as id_b, nb as name_b, tb.projects as projects_b, urls from pr join ur using (x, y) join tab ta on ta.key = ka join tab tb on tb.key = kb where p = 1""",
    "fold_headline": f"""{_ALL}, {_CONFLICTS} select unnest(['tabs', 'rows', 'components', 'components on several tabs', 'distinct product links', 'component links', 'affiliate links', 'components whose tabs disagree', '… on current tabs', 'shortened links']) as metric,
unnest([(select count(distinct sheet) from r0), (select count(*) from r0), (select count(*) from items), (select count(*) from (select key from uses group by key having count(*) > 1)), (select count(distinct url) from src), (select count(*) from src), (select count(*) from src where affiliate),
(select count(distinct key) from cv where n > 1), (select count(distinct key) from cv where n > 1 and n_current > 1), 0]) as value""",
    "fold_tabs": f"{_ALL} select project_name, project_status as status, (select count(*) from uses where uses.project = tabs.project) as components from tabs",
    "fold_link_totals": f"{_ALL}, c as (select url_key as u from every union all select code from every where code is not null) select unnest(['link cells', 'distinct urls', 'distinct products']) as metric, unnest([(select count(*) from c), (select count(distinct u) from c), (select count(distinct url) from src)]) as value",
    "fold_vendors": f"{_ALL} select vendor_id as id, vendor_name as name, count(*) as links from src group by 1, 2",
    "fold_link_states": f"{_ALL} select link_ok, count(*) as n from src group by 1",
    "workload": f"{_ALL}, {_WORK} select * from work",
    "workload_totals": f"""{_ALL}, {_WORK} select count(*) as components, sum(tabs)::bigint as uses, sum(variants_full)::bigint as variants_full, sum(variants_links)::bigint as variants_links, sum(variants_name)::bigint as variants_name, (sum(tabs) - sum(variants_full))::bigint as identical_repeats,
count(*) filter (variants_full = 1) as without_variants, count(*) filter (variants_links > 1) as links_differ, count(*) filter (variants_name > 1 and variants_links = 1) as names_differ_only, count(*) filter (tabs > 1) as shared,
coalesce(sum(variants_full) filter (tabs > 1), 0)::bigint as shared_variants, round(sum(tabs) / count(*), 4) as uses_per_component, round(sum(variants_full) / count(*), 4) as variants_per_component from work""",
    "workload_top": f"{_ALL}, {_WORK} select * from work order by variants_full desc, tabs desc, name limit 15",
}
