"""Workbooks and tab views: the cells of a workbook made from the parts table, read back as
catalogue rows; a rendered file that is scanned; views, redlines and summaries of the fold."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import dims, text
from ..operators import reports, views, windows
from ..operators.staging import delete, shared_folder, stage
from ..sources import workbook
from . import fold, links, master
from .links import table

N = len(dims.PROJECTS)
_HEAD = [("B", 2, "Component"), ("C", 3, "Standard"), ("D", 4, "Qty"), ("E", 5, "Size"), ("F", 6, "Recommended"), ("H", 8, " notes ")]


def parts(spark, sf_dir):
    """A row per part on one of the known tabs: categories stand in merged ranges of three
    rows, every seventh size continues the row above, size 48 is a footer line."""
    p = table(spark, sf_dir, "part").join(F.broadcast(fold._tabs(spark)), F.expr(f"p_partkey % {N} = t")).withColumn("row", F.expr(f"cast(floor(p_partkey / {N}) + 2 as int)"))
    name = "case when p_size % 7 = 0 then null when p_size = 48 then 'As an Amazon associate we earn' else concat('  ', p_name, chr(160), p_size) end"
    link = '''concat('HYPERLINK("https://shop.example/" & "p/', p_partkey, '","Shop ""', p_brand, '""")')'''
    cells = [
        (1, "(row - 2) % 3 = 0", "null", "p_type"), (2, "true", "null", name), (3, "p_partkey % 2 = 0", "null", "p_brand"), (4, "true", "null", "cast(p_size as string)"), (5, "p_partkey % 5 = 0", "null", "'All'"),
        (6, "p_partkey % 3 = 0", link, "'x'"), (7, "p_partkey % 3 = 1", "null", "' code '"), (8, "p_partkey % 4 = 0", "null", "concat('note ', p_brand)"),
    ]
    each = ", ".join(f"if({c}, struct({col} as col, cast({f} as string) as formula, {v} as value), null)" for col, c, f, v in cells)
    cell = p.select("t", "sheet", "row", F.explode(F.expr(f"filter(array({each}), x -> x is not null)")).alias("c"))
    cell = cell.selectExpr("cast(t as int) as sheet_index", "sheet", "'cell' as kind", "row", "c.col", "c.formula", "c.value")
    heads = fold._tabs(spark).crossJoin(F.broadcast(spark.createDataFrame([(c, v) for _, c, v in _HEAD], "col int, value string")))  # tabs by six headers
    heads = heads.selectExpr("cast(t as int) as sheet_index", "sheet", "'cell' as kind", "1 as row", "col", "value")
    ends = p.groupBy("sheet").agg(F.max("row").alias("end"))
    merged = p.where("(row - 2) % 3 = 0").join(ends, "sheet").selectExpr("cast(t as int) as sheet_index", "sheet", "'merge' as kind", "row", "1 as col", "least(row + 2, end) as row1", "1 as col1")
    links = p.where("p_partkey % 3 = 1").selectExpr("cast(t as int) as sheet_index", "sheet", "'link' as kind", "row", "7 as col", "row as row1", "7 as col1", "concat('https://code.example/', p_partkey) as link")
    empty = spark.createDataFrame([], workbook.PARTS)
    out = empty
    for df in (cell, heads, merged, links):
        out = out.unionByName(df, allowMissingColumns=True)
    return out.select(*empty.columns)


def _entries(df):
    shown = F.expr("array_join(transform(entries, e -> concat_ws('/', e.col, e.slot, coalesce(e.text, '-'), coalesce(e.url, '-'))), ' | ')")
    return df.withColumn("entries", shown).withColumn("notes", F.array_join("notes", " | "))


def workbook_rows(spark, sf_dir):
    rows = _entries(workbook.raw_rows(parts(spark, sf_dir)))
    return rows.select("sheet", "row", "category", "component", "standard", "qty", "size", "notes", "entries", "continuation")


def workbook_layout(spark, sf_dir):
    return workbook.slots(parts(spark, sf_dir)).select("sheet", "start", "end", "slot", "kind")


def _read_back(spark, grid, kept, *widths, last=None):
    """The parts of a workbook that was rendered into the shared folder, those that `kept` names;
    of cells those up to column `last`."""
    path = f"{shared_folder(spark)}/book-{uuid.uuid4().hex}.xlsx"
    workbook.render(grid, path, *widths)
    parts = stage(workbook.scan(spark, path, last).where(kept))
    delete(spark, path)
    return parts


def workbook_file(spark, sf_dir):
    """Cells of a rendered workbook as its scan finds them."""
    cells = parts(spark, sf_dir).where("kind = 'cell' and formula is null")
    url = F.when((F.col("col") == 4) & (F.col("row") > 1), F.concat(F.lit("https://q.example/?a="), F.col("value"), F.lit('&b="')))
    fill = F.when((F.col("col") == 1) & (F.col("row") > 1), F.concat(F.lit("FF0000"), F.substring(F.md5("value"), 1, 2)))
    grid = cells.select("sheet_index", "sheet", "row", "col", "value", url.alias("url"), F.upper(fill).alias("fill"), (F.col("row") == 1).alias("bold"))
    scanned = _read_back(spark, grid, "kind = 'cell'")
    link = workbook.cell_link(F.col("formula"), F.col("value"), F.col("link"))
    return scanned.select("sheet", "row", "col", link["text"].alias("text"), link["url"].alias("url"), "fill")


def category_fills(spark, sf_dir):
    """Colours by category, of the first tab that has the category; brands are colours."""
    p = table(spark, sf_dir, "part").join(F.broadcast(fold._tabs(spark)), F.expr(f"p_partkey % {N} = t"))
    row = F.expr(f"cast(floor(p_partkey / {N}) + 2 as int)")
    cells = p.select(F.lit("cell").alias("kind"), "sheet", row.alias("row"), F.lit(1).alias("col"), F.col("p_type").alias("value"), F.expr("concat('FF', substring(md5(p_brand), 1, 6))").alias("fill"))
    return workbook.category_fills(cells, [x[0] for x in dims.PROJECTS[3:]]).select("category", "fill", "n_clashes")


def fold_tab_view(spark, sf_dir):
    raw, m = fold.raw(spark, sf_dir), fold.master(spark, sf_dir)
    fills = spark.createDataFrame([("SMALL", "FF111111"), ("LARGE", "FF222222"), ("Hotend", "FF333333")], "category string, fill string")
    view = views.tab_view(raw, fold._rules(spark), m, fold.status(spark, sf_dir), fills)
    linked = F.expr("array_join(transform(links, x -> concat_ws(' > ', x.label, x.url, coalesce(x.affiliate, '-'))), ' | ')")
    return view.select("sheet", "position", "kind", "category", "name", "standard", "qty", "size", linked.alias("links"), F.array_join("texts", " | ").alias("texts"), F.array_join("notes", " | ").alias("notes"), "warning", "fill")


def fold_view_summary(spark, sf_dir):
    """Rows of each kind on each tab of the views."""
    raw, m = fold.raw(spark, sf_dir), fold.master(spark, sf_dir)
    return views.summary(views.tab_view(raw, fold._rules(spark), m), "kind")


def fold_redline(spark, sf_dir):
    """Outcome of every raw row; runs of changed words as the texts before and after."""
    red = views.redline(fold.raw(spark, sf_dir), fold._rules(spark), fold.master(spark, sf_dir))
    side = lambda c, op: F.expr(f"array_join(transform(filter({c}, x -> x.op <> '{op}'), x -> x.text), '')")
    return red.select("sheet", "row", "outcome", side("name", "add").alias("name_before"), side("name", "del").alias("name_after"), side("standard", "add").alias("standard_before"),
                      side("standard", "del").alias("standard_after"), side("size", "add").alias("size_before"), side("size", "del").alias("size_after"))


def fold_redline_summary(spark, sf_dir):
    red = views.redline(fold.raw(spark, sf_dir), fold._rules(spark), fold.master(spark, sf_dir))
    return views.summary(red, "outcome")


def redline_file(spark, sf_dir):
    """A rendered redline as its scan finds it: the texts before and after of component,
    standard, quantity and size, put together from the runs of their cells, and the widths of
    columns (row 0: width, and the last column that has it)."""
    red = stage(views.redline(fold.raw(spark, sf_dir), fold._rules(spark), fold.master(spark, sf_dir)))
    parts = _read_back(spark, views.redline_grid(red), "kind = 'column' or (kind in ('cell', 'run') and row > 1 and col between 3 and 6)", views.WIDTHS, views.WIDTH, last=6)
    side = lambda mark: F.expr(f"array_join(transform(array_sort(collect_list(if(coalesce(formula, '') <> '{mark}', struct(row1, value), null))), x -> x.value), '')")
    runs = parts.where("kind = 'run'").groupBy("sheet", "row", "col").agg(side("bold").alias("before"), side("strike").alias("after"))
    cells = parts.where("kind = 'cell' and row > 1 and col between 3 and 6").select("sheet", "row", "col", "value").join(runs, ["sheet", "row", "col"], "left")
    cells = cells.select("sheet", "row", "col", F.coalesce("before", "value").alias("before"), F.coalesce("after", "value").alias("after"))
    widths = parts.where("kind = 'column'").select("sheet", F.lit(0).alias("row"), "col", F.col("value").alias("before"), F.col("col1").cast("string").alias("after"))
    return cells.unionByName(widths)


def about_file(spark, sf_dir):
    """The first sheet of the rendered tab views as its scan finds it, and how many cells the other sheets have."""
    view = stage(views.tab_view(fold.raw(spark, sf_dir), fold._rules(spark), fold.master(spark, sf_dir), fold.status(spark, sf_dir)))
    parts = _read_back(spark, views.grid(view).unionByName(views.about(view)), f"sheet = '{views.ABOUT}' or (kind = 'cell' and col = 2 and row > 1)", views.WIDTHS, views.WIDTH, {views.ABOUT: views.ABOUT_WIDTHS}, last=len(views.ABOUT_WIDTHS))
    first = parts.where(F.col("sheet") == views.ABOUT).where("kind in ('cell', 'column')").select("sheet", "kind", "row", "col", "value")
    names = parts.where(F.col("sheet") != views.ABOUT).where("kind = 'cell' and col = 2 and row > 1").groupBy("sheet").agg(F.count("*").cast("string").alias("value"))
    return first.unionByName(names.select("sheet", F.lit("names").alias("kind"), F.lit(None).cast("int").alias("row"), F.lit(2).alias("col"), "value"))


def verdict_counts(spark, sf_dir):
    """How many pages have each verdict."""
    return reports.tally(links.page_verdicts(spark, sf_dir), "verdict")


def affiliate_tally(spark, sf_dir):
    return reports.tally(master.report_affiliates(spark, sf_dir), "verdict")


def number_formats(spark, sf_dir):
    """Numbers as the reports print them: two and three places, percent, factors."""
    p = table(spark, sf_dir, "part").withColumn("x", F.expr("p_retailprice / 7 + p_size / 3"))
    return p.select("p_partkey", text.fixed(F.col("x"), 3).alias("three"), text.fixed(F.col("x"), 2).alias("two"), F.concat(text.fixed(F.col("x"), 0), F.lit("%")).alias("percent"), F.concat(text.fixed(F.col("x"), 1), F.lit("x")).alias("factor"))


def slug_collisions(spark, sf_dir):
    """Ids where bases end in numbers, so that a numbered one may be another's own."""
    p = table(spark, sf_dir, "part").select("p_partkey", F.expr("concat(p_brand, if(p_size % 3 = 0, '', concat('-', p_size % 3 + 1)))").alias("base"))
    return windows.numbered_ids(p, "base", ["p_partkey"]).select("p_partkey", "id")


QUERIES = {f.__name__: f for f in (
    workbook_rows, workbook_layout, workbook_file, category_fills, fold_tab_view, fold_view_summary, fold_redline, fold_redline_summary, redline_file, about_file, verdict_counts, affiliate_tally, number_formats, slug_collisions,
)}

_SHEETS = f"tabs(t, sheet) as (values {fold._values([(i, p[0]) for i, p in enumerate(dims.PROJECTS)])})"
_BOOK = f"""with {_SHEETS},
b as (select *, p_partkey // {N} + 2 as row, case when p_size % 7 = 0 then null when p_size = 48 then 'As an Amazon associate we earn' else p_name || ' ' || p_size end as comp, case when p_partkey % 2 = 0 then p_brand end as std from part join tabs on t = p_partkey % {N}),
c as (select *, first_value(p_type) over (partition by sheet, (row - 2) // 3 order by row) as cat from b),
d as (select *, last_value(case when comp is not null then row end ignore nulls) over (partition by sheet order by row rows between unbounded preceding and 1 preceding) as up from c),
e as (select d.*, case when u.p_size <> 48 then u.comp end as up_comp, case when u.p_size <> 48 then u.std end as up_std from d left join b u on u.sheet = d.sheet and u.row = d.up)"""
_KEPT = """r2 as (select o3.*, case when p_size >= 48 then null else nk end as part_key, p_size >= 48 or nk in ('red plate 7', 'old ring 30') as off from o3),
spell as (select nk, arg_min(key, seq) as item from (select distinct r.nk, r.key, items.seq from r join items using (key) union select lower(items.name), key, seq from items where base_key in ('hot ring 12', 'blue ring 5', 'blue ring 6', 'blue ring 9')) group by nk)"""
_VIEW = f"""{fold._ALL}, {_KEPT},
qn as (select key, project, size, qty, row_number() over (partition by key, project order by min(seq)) - 1 as n from q where qty is not null group by key, project, size, qty, num),
code as (select key, url_key, arg_min(code, f) as code from (select key, url_key, code, min(o) as f from l where code is not null group by 1, 2, 3) join st on u = code and ok = 'yes' group by 1, 2),
lk as (select key, string_agg(coalesce(nullif(case when contains(url, '{fold.SHOP}') then split_part(labels, ' | ', 1) else split_part(labels, ' | ', 1) end, ''), vendor_name) || ' > ' || url || ' > ' || coalesce(code.code, '-'), ' | ' order by role_rank, n_tabs desc, vendor_name, src.seq) as links
  from src left join code using (key, url_key) where link_ok = 'yes' group by key),
tx2 as (select key, project, string_agg(label, ' | ' order by f) as texts from (select distinct key, label, project, min(seq) over (partition by key, label) as f from said) group by key, project),
nt as (select key, project, string_agg(note, ' | ' order by f) as notes from (select distinct key, 'see ' || p_brand as note, project, min(seq) over (partition by key, p_brand) as f from r where seq % 6 < 2) group by key, project),
ws as (select key, project, case when bool_and(link_ok <> 'yes') then 'all links were dead' when bool_or(link_ok <> 'yes') then 'some links were dead' end as warning from (select distinct l.key, l.project, url_key, link_ok from l join src using (key, url_key)) group by 1, 2),
pl as (select uses.sheet, (select min(r.row) from r where r.key = uses.key and r.project = uses.project) as place, coalesce(qn.n, 0) as n, 'part' as kind, items.category, items.name, items.best_standard as standard, qn.qty, qn.size, coalesce(lk.links, '') as links, coalesce(tx2.texts, '') as texts, coalesce(nt.notes, '') as notes, ws.warning
  from uses join items using (key) left join qn using (key, project) left join lk using (key) left join tx2 using (key, project) left join nt using (key, project) left join ws using (key, project)),
own as (select r2.sheet, r2.row, r2.p_size, r2.off, r2.cat, r2.nk, r2.name, spell.item, p_size = 50 as is_or from r2 left join spell using (nk) where p_size <> 48),
sd as (select *, last_value(case when not is_or then struct_pack(i := item) end ignore nulls) over (partition by sheet order by row rows between unbounded preceding and 1 preceding) as le,
  first_value(case when not is_or then struct_pack(i := item) end ignore nulls) over (partition by sheet order by row rows between 1 following and unbounded following) as ri from own),
mk as (select sheet, row as place, 0 as n, case when is_or then 'or' when p_size = 49 then 'footer' else 'heading' end as kind, case when cat = 'Hotend' then 'hot end' else cat end as category, case when is_or then 'or' when p_size = 49 then 'As an Amazon associate we earn' else name end as name,
  null as standard, null as qty, null as size, '' as links, '' as texts, '' as notes, null as warning from sd where off and (not is_or or coalesce(le.i <> ri.i, false)) and sheet in (select sheet from uses)),
vw as (select * from pl union all select * from mk),
v2 as (select *, kind = 'or' and coalesce(lag(kind) over (partition by sheet order by place, n, kind <> 'part', name) = 'or', false) as twice from vw),
v3 as (select *, case category when 'SMALL' then 'FF111111' when 'LARGE' then 'FF222222' when 'Hotend' then 'FF333333' end as own_fill from v2 where not twice),
view as (select *, row_number() over (partition by sheet order by place, n, kind <> 'part', name) as position, case when kind = 'or' then coalesce(own_fill, last_value(case when kind = 'part' then own_fill end ignore nulls) over (partition by sheet order by place, n, kind <> 'part', name rows between unbounded preceding and 1 preceding)) else own_fill end as fill from v3)"""
_RED = f"""{fold._ALL}, {_KEPT},
x as (select r2.sheet, r2.project, r2.row, r2.seq, p_size, case seq % 6 when 0 then p_size::varchar when 1 then p_size::varchar when 2 then 'as needed' when 3 then '2-4' when 5 then '2.5' end as old_qty, off, r2.name, r2.standard, case when not off then spell.item end as item, case seq % 5 when 2 then '250' when 3 then '300' when 4 then null when 0 then null else 'All' end as size from r2 left join spell using (nk)),
y as (select *, case when item is not null then min(row) over (partition by sheet, item, coalesce(size, '')) end as top from x),
red as (select y.sheet, y.row, y.project, y.item, y.old_qty, y.name, y.standard, y.size, y.p_size, items.name as new_name, items.best_standard as new_standard, case when p_size = 50 then 'separator' when off then 'marker' when item is null then 'removed'
  when uses.key is not null and top <> row then 'merged' else 'edited' end as outcome from y left join items on items.key = y.item left join uses on uses.key = y.item and uses.project = y.project)"""

SQL = {
    "workbook_rows": f"""{_BOOK} select sheet, row::int as row, cat as category, coalesce(comp, up_comp) as component, case when comp is null then coalesce(std, up_std) else std end as standard, p_size::varchar as qty, case when p_partkey % 5 = 0 then 'All' end as size,
case when p_partkey % 4 = 0 then 'note ' || p_brand else '' end as notes, case when p_partkey % 3 = 0 then 'F/Recommended/Shop "' || p_brand || '"/https://shop.example/p/' || p_partkey when p_partkey % 3 = 1 then 'G/Recommended/code/https://code.example/' || p_partkey else '' end as entries,
comp is null as continuation from e where coalesce(comp, up_comp) is not null""",
    "workbook_layout": f"""with {_SHEETS} select sheet, unnest([1, 2, 3, 4, 5, 6, 8]) as start, unnest([1, 2, 3, 4, 5, 7, 8]) as "end", unnest(['Category', 'Component', 'Standard', 'Qty', 'Size', 'Recommended', 'notes']) as slot,
unnest(['category', 'component', 'standard', 'qty', 'size', 'vendor', 'notes']) as kind from tabs""",
    "workbook_file": f"""{_BOOK}, z as (select sheet, row, p_type, p_name, p_size, p_brand, p_partkey, unnest([1, 2, 3, 4, 5, 7, 8]) as col from b),
k as (select sheet, row, col, case col when 1 then p_type when 2 then (case when p_size % 7 = 0 then null when p_size = 48 then 'As an Amazon associate we earn' else p_name || ' ' || p_size end) when 3 then p_brand when 4 then p_size::varchar when 5 then 'All' when 7 then 'code' else 'note ' || p_brand end as text,
  case when col = 4 then 'https://q.example/?a=' || p_size || '&b="' end as url, case when col = 1 then upper('FF0000' || substring(md5(p_type), 1, 2)) end as fill,
  case col when 1 then (row - 2) % 3 = 0 when 3 then p_partkey % 2 = 0 when 5 then p_partkey % 5 = 0 when 7 then p_partkey % 3 = 1 when 8 then p_partkey % 4 = 0 else true end as there from z)
select sheet, row::int as row, col::int as col, text, url, fill from k where there
union all select sheet, 1, unnest([2, 3, 4, 5, 6, 8]), unnest(['Component', 'Standard', 'Qty', 'Size', 'Recommended', 'notes']), null, null from tabs""",
    "category_fills": f"""with {_SHEETS}, v as (select p_type, t, 'FF' || substring(md5(p_brand), 1, 6) as fill, count(*) as n, min(p_partkey // {N}) as f from part join tabs on t = p_partkey % {N} where t >= 3 group by 1, 2, 3),
m as (select p_type, t, fill from v qualify row_number() over (partition by p_type, t order by n desc, f) = 1), w as (select p_type, arg_min(fill, t) as fill from m group by 1)
select p_type as category, w.fill, count(*) filter (m.fill <> w.fill) as n_clashes from m join w using (p_type) group by 1, 2""",
    "fold_tab_view": f"{_VIEW} select sheet, position::int as position, kind, category, name, standard, qty, size, links, texts, notes, warning, fill from view",
    "fold_view_summary": f"{_VIEW} select sheet, kind, count(*) as n from view group by 1, 2",
    "fold_redline": f"""{_RED} select sheet, row::int as row, outcome, case p_size when 48 then '' when 49 then 'As an Amazon associate we earn' when 50 then 'or' else coalesce(name, '') end as name_before,
case when outcome = 'edited' then new_name when outcome = 'marker' then (case p_size when 48 then '' when 49 then 'As an Amazon associate we earn' else name end) else '' end as name_after,
case when outcome in ('edited', 'merged') then coalesce(standard, '') else '' end as standard_before, case when outcome = 'edited' then coalesce(new_standard, '') else '' end as standard_after,
case when outcome in ('edited', 'merged') then coalesce(size, '') else '' end as size_before, case when outcome = 'edited' then coalesce(size, '') else '' end as size_after from red""",
    "redline_file": f"""{_RED}, qf as (select key, project, size, arg_min(qty, seq) as qty from q where qty is not null group by all),
e as (select red.*, case when outcome in ('edited', 'merged') then old_qty end as qty_before, case when outcome = 'edited' then coalesce(qf.qty, old_qty) end as qty_after from red
  left join qf on qf.key = red.item and qf.project = red.project and qf.size = coalesce(red.size, 'All')),
t as (select sheet, row::int as row, unnest([3, 4, 5, 6]) as col,
  unnest([case p_size when 48 then '' when 49 then 'As an Amazon associate we earn' when 50 then 'or' else coalesce(name, '') end, case when outcome in ('edited', 'merged') then standard end, qty_before, case when outcome in ('edited', 'merged') then size end]) as before,
  unnest([case when outcome = 'edited' then new_name when outcome = 'marker' then (case p_size when 48 then '' when 49 then 'As an Amazon associate we earn' else name end) end, case when outcome = 'edited' then new_standard end, qty_after, case when outcome = 'edited' then size end]) as after from e)
select sheet, row, col, coalesce(before, '') as before, coalesce(after, '') as after from t where coalesce(before, '') <> '' or coalesce(after, '') <> ''
union all select sheet, 0, unnest([1, 2, 3, 4, 5, 6]), unnest(['18', '44', '14', '10', '10', '30']), unnest(['1', '2', '3', '4', '5', '16384']) from tabs where sheet in (select sheet from red)""",
    "about_file": f"""{_VIEW}, n as (select *, case when links = '' then 0 else len(string_split(links, ' | ')) end as nl, case when texts = '' then 0 else len(string_split(texts, ' | ')) end as nt from view),
s as (select sheet, count(*) filter (kind = 'part') as rows, max(nl + nt) as slots, count(*) filter (kind = 'part' and nl = 0) as without, count(*) filter (kind = 'part' and warning is not null) as loss from n group by 1),
a as (select 8 + t as row, [project_name, project_status, rows::varchar, slots::varchar, without::varchar, loss::varchar] as v from s join tabs using (sheet)
  union all select 7, ['Tab', 'Status', 'Rows', 'Vendor slots', 'Rows without live link', 'Rows that lost links']
  union all select unnest([1, 3, 4, 5]), unnest([['Sourcing guide, rebuilt'], ['Names are the shared ones, so a part reads the same on every tab.'], ['Every live link of a component is listed on all its tabs; dead ones are left out.'],
    ['The last column says what a row lost. A row without vendor had dead links only.']]))
select 'About' as sheet, 'cell' as kind, row::int as row, i::int as col, v[i] as value from (select row, v, unnest(range(1, len(v) + 1)) as i from a)
union all select 'About', 'column', null, unnest([1, 2, 3, 4, 5, 6]), unnest(['26', '21', '21', '21', '21', '21'])
union all select sheet, 'names', null, 2, count(name)::varchar from view group by sheet""",
    "fold_redline_summary": f"{_RED} select sheet, outcome, count(*) as n from red group by 1, 2",
    "verdict_counts": f"select verdict, count(*) as n from ({links.SQL['page_verdicts']}) group by 1",
    "affiliate_tally": f"select verdict, count(*) as n from ({master.SQL['report_affiliates']}) group by 1",
    "number_formats": "select p_partkey, printf('%.3f', x) as three, printf('%.2f', x) as two, printf('%.0f', x) || '%' as percent, printf('%.1f', x) || 'x' as factor from (select p_partkey, p_retailprice / 7 + p_size / 3 as x from part)",
    "slug_collisions": """with recursive b as (select p_partkey, p_brand || case when p_size % 3 = 0 then '' else '-' || (p_size % 3 + 1) end as base, p_brand, row_number() over (partition by p_brand order by p_partkey) as pos from part),
f as (select p_brand, 0::bigint as pos, cast(null as bigint) as p_partkey, cast(null as varchar) as id, cast([] as varchar[]) as used from (select distinct p_brand from part)
  union all select p_brand, pos, p_partkey, id, list_append(used, id) from (select f.p_brand, b.pos, b.p_partkey, f.used, case when not list_contains(f.used, b.base) then b.base
    else b.base || '-' || list_min(list_filter(range(2, len(f.used) + 3), lambda k: not list_contains(f.used, b.base || '-' || k))) end as id from f join b on b.p_brand = f.p_brand and b.pos = f.pos + 1))
select p_partkey, id from f where pos > 0""",
}
