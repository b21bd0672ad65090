"""Views of a tab after the fold: its rows in their old order, and what changed in each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dims, text, urls
from ..functions.similarity import token_diff, token_diffs
from . import reports, resolve, windows
from .resolve import Master, Rules

_LINKS = "array<struct<label: string, url: string, affiliate: string>>"
_STRINGS = "array<string>"


def _empty(kind: str) -> Column:
    return F.expr(f"cast(array() as {kind})")


def spellings(m: Master) -> DataFrame:
    """(name_key, key): the first item that has a spelling as its name or an alias owns it."""
    names = m.items.select("key", "seq", F.explode(F.concat(F.array("name"), F.coalesce("aliases", _empty(_STRINGS)))).alias("n"))
    return names.select(text.name_key(F.col("n")).alias("name_key"), "key", "seq").where("name_key is not null").groupBy("name_key").agg(F.min_by("key", "seq").alias("key"))


def _sheet_rows(raw: DataFrame, r: Rules) -> DataFrame:
    """Raw rows of known tabs with comp (cleaned), name_key, is_or and part (names a component)."""
    # tables made on the driver, a few rows each, are broadcast: their size is not known to a plan, which would else deal out all rows
    rows = raw.join(F.broadcast(resolve.projects(raw.sparkSession).select("sheet", "project")), "sheet").withColumn("comp", text.clean_text(F.col("component")))
    rows = rows.withColumn("name_key", text.name_key(F.col("comp"), cleaned=True)).withColumn("is_or", F.coalesce(F.upper("comp") == "OR", F.lit(False)))
    gone = r.drop.select(F.col("key").alias("name_key"), F.lit(True).alias("_gone"))
    rows = rows.join(F.broadcast(gone), "name_key", "left")
    return rows.withColumn("part", ~(text.is_drop_row(F.col("comp"), cleaned=True) | F.col("_gone").isNotNull())).drop("_gone")


def _affiliates(m: Master, status: DataFrame | None) -> DataFrame:
    """(key, url_key, affiliate): the first live affiliate code of a source."""
    codes = m.sources.select("key", "url_key", F.posexplode("affiliate_urls").alias("n", "code"))
    if status is None:
        codes = codes.where("false")
    else:
        codes = codes.join(status.where("status = 'yes'").select(F.col("url").alias("code")), "code", "left_semi")
    return codes.groupBy("key", "url_key").agg(F.min_by("code", "n").alias("affiliate"))


def _sources(m: Master, status: DataFrame | None) -> DataFrame:
    """(key, links): live links with their live affiliate code, best first."""
    live = m.sources.where("link_ok = 'yes'").drop("affiliate").join(_affiliates(m, status), ["key", "url_key"], "left")
    link = F.struct(reports.link_label(F.col("labels"), F.col("vendor_name"), F.col("url")).alias("label"), "url", "affiliate")
    return reports._gather(live, ["key"], link, reports._ranked(), "links")


def _by_project(df: DataFrame, value: str, name: str) -> DataFrame:
    each = df.select("key", value, "seq", F.explode("projects").alias("project"))
    return reports._gather(each, ["key", "project"], F.col(value), [F.col("seq")], name)


def losses(m: Master) -> DataFrame:
    """(key, project, warning): what a tab lost of the links it used to have."""
    had = m.sources.select("key", F.col("link_ok") == "yes", F.explode(F.array_distinct(F.transform("seen", lambda x: x.project))).alias("project")).toDF("key", "ok", "project")
    n = had.groupBy("key", "project").agg(F.count("*").alias("n"), F.count_if(~F.col("ok")).alias("dead")).where("dead > 0")
    return n.select("key", "project", F.when(F.col("dead") == F.col("n"), "all links were dead").otherwise("some links were dead").alias("warning"))


def tab_view(raw: DataFrame, r: Rules, m: Master, status: DataFrame | None = None, fills: DataFrame | None = None) -> DataFrame:
    """(sheet, position, kind, category, name, standard, qty, size, links, texts, notes,
    warning, fill): parts and structural rows of each tab in its own order. Kind is part, or,
    heading or footer. A separator is left out if its sides are one component or not both are
    known, or if another one stands before it. `fills` (category, fill) colours rows; a
    separator takes the colour above it."""
    rows = _sheet_rows(raw, r)
    tab = resolve.projects(raw.sparkSession).select("sheet")
    q = F.posexplode_outer(F.when(F.size("qty") > 0, F.col("qty")).otherwise(F.expr("array(cast(null as struct<size: string, qty: string, qty_num: double>))")))
    uses = m.uses.select("key", "project", "sheet", F.coalesce(F.array_min("rows"), F.lit(10**6)).alias("place"), q.alias("n", "q"))
    parts = uses.join(m.items.select("key", "category", "name", F.col("best_standard").alias("standard")), "key")
    parts = parts.select("sheet", "place", "n", F.lit("part").alias("kind"), "category", "name", "standard", F.col("q.qty").alias("qty"), F.col("q.size").alias("size"), "key", "project")

    own = rows.where("not coalesce(continuation, false) and comp is not null")
    known = own.join(spellings(m).withColumnRenamed("key", "item"), "name_key", "left").withColumn("side", F.struct("item"))
    sides = windows.neighbours(known, "sheet", ["row"], "side", F.col("is_or"))
    useful = F.coalesce(F.col("left.item") != F.col("right.item"), F.lit(False))
    marks = sides.where(~F.col("part") & (~F.col("is_or") | useful))
    kind = F.when(F.col("is_or"), "or").when(F.col("name_key").startswith("as an "), "footer").otherwise("heading")
    marks = marks.select("sheet", F.col("row").alias("place"), F.lit(0).alias("n"), kind.alias("kind"), text.clean_text(F.col("category")).alias("category"), F.col("comp").alias("name"))
    tabs = m.uses.select("sheet").distinct()  # a tab without any component has no view
    out = parts.unionByName(marks.join(tabs, "sheet", "left_semi"), allowMissingColumns=True).join(F.broadcast(tab), "sheet", "left_semi")
    w = Window.partitionBy("sheet").orderBy("place", "n", F.when(F.col("kind") == "part", 0).otherwise(1), "name")
    out = out.withColumn("_double", (F.col("kind") == "or") & F.coalesce(F.lag("kind").over(w) == "or", F.lit(False))).where("not _double").drop("_double")
    if fills is None:
        out = out.withColumn("fill", F.lit(None).cast("string"))
    else:
        out = out.join(fills.select("category", "fill"), "category", "left")
        above = F.last(F.when(F.col("kind") == "part", F.col("fill")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
        out = out.withColumn("fill", F.when(F.col("kind") == "or", F.coalesce("fill", above)).otherwise(F.col("fill")))
    out = out.withColumn("position", F.row_number().over(w))
    # a tab is put in order by one task, so what an item has comes after; its links last, as every row of it has all of them
    for df, on in ((_by_project(m.unlinked, "label", "texts"), ["key", "project"]), (_by_project(m.notes, "note", "notes"), ["key", "project"]), (losses(m), ["key", "project"]), (_sources(m, status), ["key"])):
        out = out.join(df, on, "left")
    for c, kind_ in (("links", _LINKS), ("texts", _STRINGS), ("notes", _STRINGS)):
        out = out.withColumn(c, F.coalesce(c, _empty(kind_)))
    return out.select("sheet", "position", "kind", "category", "name", "standard", "qty", "size", "links", "texts", "notes", "warning", "fill")


def grid(view: DataFrame) -> DataFrame:
    """Cells (sheet_index, sheet, row, col, value, url, fill, bold) of tab views, for the
    workbook writer. A slot where any row has a live affiliate code gets a second column."""
    spark = view.sparkSession
    order = spark.createDataFrame([(p[0], i) for i, p in enumerate(dims.PROJECTS)], "sheet string, sheet_index int")
    view = view.join(F.broadcast(order), "sheet").withColumn("row", F.col("position") + 1)
    cell = F.expr("transform(links, x -> struct(x.label as value, x.url as url, x.affiliate as affiliate))")
    words = F.expr("transform(texts, x -> struct(x as value, cast(null as string) as url, cast(null as string) as affiliate))")
    cells = view.select("sheet_index", "sheet", "row", "fill", F.posexplode(F.concat(cell, words)).alias("n", "c"))
    slot = cells.groupBy("sheet_index", "sheet", "n").agg(F.max(F.col("c.affiliate").isNotNull().cast("int")).alias("two"))
    before = Window.partitionBy("sheet").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    slot = slot.withColumn("at", F.lit(6) + F.col("n") + F.coalesce(F.sum("two").over(before), F.lit(0)).cast("int"))
    title = F.when(F.col("n") == 0, "Recommended").when(F.col("n") == 1, "Alternative Source").otherwise(F.concat(F.lit("Alternative Source "), F.col("n").cast("string")))
    width = view.select("sheet_index", "sheet").distinct().join(slot.groupBy("sheet").agg(F.max(F.col("at") + F.col("two")).alias("last")), "sheet", "left").withColumn("last", F.coalesce("last", F.lit(5)))
    null = F.lit(None).cast("string")

    def out(df, row, col, value, url=null, fill=null, bold=F.lit(False)):
        return df.select("sheet_index", "sheet", row.cast("int").alias("row"), col.cast("int").alias("col"), value.alias("value"), url.alias("url"), fill.alias("fill"), bold.alias("bold"))

    one = F.lit(1)
    result = out(slot, one, F.col("at"), title, bold=F.lit(True))
    heads = width.select("sheet_index", "sheet", "last", F.posexplode(F.array(*map(F.lit, ("Category", "Component", "Standard", "Qty", "Size")))).alias("n", "v"))
    result = result.unionByName(out(heads, one, F.col("n") + 1, F.col("v"), bold=F.lit(True)))
    for k, v in ((1, "Notes"), (2, "Link check")):
        result = result.unionByName(out(width, one, F.col("last") + k, F.lit(v), bold=F.lit(True)))
    base = view.withColumn("strong", F.col("kind").isin("or", "heading"))
    for i, c in enumerate(("category", "name", "standard", "qty", "size"), 1):
        result = result.unionByName(out(base.where(F.col(c).isNotNull()), F.col("row"), F.lit(i), F.col(c), fill=F.col("fill"), bold=F.col("strong")))
    placed = cells.join(F.broadcast(slot.select("sheet", "n", "at")), ["sheet", "n"])  # no more than the columns that the format has
    result = result.unionByName(out(placed, F.col("row"), F.col("at"), F.col("c.value"), F.col("c.url"), F.col("fill")))
    result = result.unionByName(out(placed.where("c.affiliate is not null"), F.col("row"), F.col("at") + 1, F.lit("[Affiliate Link]"), F.col("c.affiliate"), F.col("fill")))
    tail = view.join(F.broadcast(width.select("sheet", "last")), "sheet")  # a row per tab
    result = result.unionByName(out(tail.where(F.size("notes") > 0), F.col("row"), F.col("last") + 1, F.array_join("notes", " / "), fill=F.col("fill")))
    return result.unionByName(out(tail.where("warning is not null"), F.col("row"), F.col("last") + 2, F.col("warning"), fill=F.col("fill")))


def _link_key(label: Column, url: Column, key: Column) -> Column:
    return F.when(F.coalesce(url != "", F.lit(False)), F.coalesce(key, url)).otherwise(F.concat(F.lit("text:"), F.lower(F.trim(F.coalesce(label, F.lit(""))))))


def _old_links(rows: DataFrame) -> DataFrame:
    """(sheet, row, old): links of raw rows with their keys, in order; rows without any are left out."""
    each = rows.select("sheet", "row", F.posexplode("entries").alias("n", "e")).where("coalesce(e.text, '') <> '' or coalesce(e.url, '') <> ''")
    each = urls.identified(each.select("sheet", "row", "n", F.col("e.text").alias("label"), F.col("e.url").alias("url")), "url", key="url_key")
    link = F.struct(_link_key(F.col("label"), F.col("url"), F.col("url_key")).alias("k"), F.coalesce("label", F.lit("")).alias("label"), F.coalesce("url", F.lit("")).alias("url"))
    return reports._gather(each, ["sheet", "row"], link, [F.col("n")], "old")


def redline(raw: DataFrame, r: Rules, m: Master) -> DataFrame:
    """One row per raw row of each tab: (sheet, row, outcome, cells, links, note). Outcome is
    edited, merged, removed, marker (kept structure) or separator (dropped). cells are edit
    runs (op keep, del, add) of category, name, standard, qty, size; links are paired by url
    key, old ones in their order, then new ones, each with the runs of its label."""
    rows = _sheet_rows(raw, r).withColumn("_size", text.clean_size(F.col("size")))
    rows = rows.join(spellings(m).withColumnRenamed("key", "item"), "name_key", "left").withColumn("item", F.when(F.col("part"), F.col("item")))
    named = rows.where("item is not null")
    first = windows.primary_rows(named.withColumn("_z", F.coalesce("_size", F.lit(""))).select("sheet", "item", "_z", "row"), ["sheet", "item", "_z"], "row")
    rows = rows.join(first.select("sheet", "row", "merged_into"), ["sheet", "row"], "left")
    items = m.items.select(F.col("key").alias("item"), F.col("name").alias("new_name"), F.col("category").alias("new_category"), F.col("best_standard").alias("new_standard"))
    # a use without any quantity is one all the same
    uses = m.uses.select(F.col("key").alias("item"), "project", F.coalesce("qty", _empty("array<struct<size: string, qty: string, qty_num: double>>")).alias("uses"))
    rows = rows.join(items, "item", "left").join(uses, ["item", "project"], "left")
    outcome = (
        F.when(F.col("is_or"), "separator").when(~F.col("part"), "marker").when(F.col("item").isNull(), "removed").when(F.col("uses").isNotNull() & F.col("merged_into").isNotNull(), "merged").otherwise("edited")
    )
    rows = rows.withColumn("outcome", outcome)
    edited = F.col("outcome") == "edited"
    old_qty = text.qty_text(F.col("qty"))
    match = F.expr("get(filter(uses, u -> u.size <=> coalesce(_size, 'All')), 0)")
    new_qty = F.coalesce(match["qty"], old_qty)
    kept = F.col("outcome").isin("edited", "marker")
    full = F.col("outcome").isin("edited", "merged")
    pairs = [
        ("category", text.clean_text(F.col("category")), F.when(edited, F.col("new_category")).when(kept, text.clean_text(F.col("category")))),
        ("name", F.col("comp"), F.when(edited, F.col("new_name")).when(kept, F.col("comp"))),
        ("standard", F.when(full, text.clean_text(F.col("standard"))), F.when(edited, F.col("new_standard"))),
        ("qty", F.when(full, old_qty), F.when(edited, new_qty)),
        ("size", F.when(full, F.col("_size")), F.when(edited, F.col("_size"))),
    ]

    # links of both sides by key; of equal new keys the last one's content stands at the first one's place
    link = lambda l, u, k: F.struct(_link_key(l, u, k).alias("k"), F.coalesce(l, F.lit("")).alias("label"), F.coalesce(u, F.lit("")).alias("url"))
    none = F.lit(None).cast("string")
    # only edited rows show new links: the others' keys match nothing, and lie evenly
    rows = rows.withColumn("_shown", F.when(edited, F.col("item")).otherwise(F.concat_ws("\x00", F.lit(""), "sheet", F.col("row").cast("string"))))
    live = reports.live_links(m).select(F.col("key").alias("_shown"), "links")
    said = _by_project(m.unlinked, "label", "texts").withColumnRenamed("key", "_shown")
    rows = rows.join(live, "_shown", "left").join(said, ["_shown", "project"], "left").join(_old_links(raw), ["sheet", "row"], "left")
    rows = rows.withColumn("old", F.coalesce("old", F.expr("cast(array() as array<struct<k: string, label: string, url: string>>)")))
    new = F.concat(
        F.coalesce(F.transform("links", lambda x: link(x.label, x.url, x.url_key)), F.expr("cast(array() as array<struct<k: string, label: string, url: string>>)")),
        F.coalesce(F.transform("texts", lambda t: link(t, none, none)), F.expr("cast(array() as array<struct<k: string, label: string, url: string>>)")),
    )
    rows = rows.withColumn("new", F.when(edited, new).when(F.col("outcome") == "marker", F.expr("cast(array() as array<struct<k: string, label: string, url: string>>)")))
    rows = rows.withColumn("new", F.coalesce("new", F.expr("cast(array() as array<struct<k: string, label: string, url: string>>)")))
    rows = rows.withColumn("ok", F.expr("transform(old, x -> x.k)")).withColumn("nk", F.expr("array_distinct(transform(new, x -> x.k))"))
    # links of the old side with what they became, then those that came; where no new key stands twice no link is looked for again
    rows = rows.withColumn("pairs", F.expr("transform(old, o -> struct(o as old, element_at(filter(new, n -> n.k = o.k), if(array_contains(nk, o.k), -1, null)) as new))"))
    rows = rows.withColumn("came", F.expr(
        "case when size(nk) = size(new) then filter(new, n -> not array_contains(ok, n.k)) "
        "else transform(filter(nk, k -> not array_contains(ok, k)), k -> element_at(filter(new, n -> n.k = k), -1)) end"
    ))
    counts = rows.select("*", F.expr("size(filter(old, o -> not array_contains(nk, o.k) and not startswith(o.k, 'text:')))").alias("lost"), F.expr("size(filter(new, n -> not array_contains(ok, n.k) and not startswith(n.k, 'text:')))").alias("gained"),
                         F.expr("size(filter(pairs, p -> p.new is not null and (p.old.label <> p.new.label or p.old.url <> p.new.url)))").alias("tidied"))
    several = lambda n, one, many: F.concat(n.cast("string"), F.when(n == 1, one).otherwise(many))
    lost, gained, tidied = F.col("lost"), F.col("gained"), F.col("tidied")
    change = F.concat_ws(
        ", ", F.when((lost > 0) & (F.size("new") == 0), "all links were dead").when(lost > 0, several(lost, " dead link removed", " dead links removed")),
        F.when(gained > 0, several(gained, " link added from other tabs", " links added from other tabs")), F.when(tidied > 0, several(tidied, " link address cleaned", " link addresses cleaned")),
        F.when(~F.col("name_key").eqNullSafe(text.name_key(F.col("new_name"))), "renamed to the shared spelling"),
    )
    note = (
        F.when(edited, change).when(F.col("outcome") == "merged", F.concat(F.lit("merged into row "), F.col("merged_into").cast("string"), F.lit(', "'), F.col("new_name"), F.lit('"')))
        .when(F.col("outcome") == "removed", "row removed").when(F.col("outcome") == "marker", "kept as a section marker").otherwise("separator dropped: its alternatives are one component now")
    )
    base = counts.select("sheet", "row", "outcome", F.struct(*(F.struct(a.alias("old"), b.alias("new")).alias(n) for n, a, b in pairs)).alias("c"), "pairs", "came", note.alias("note"))
    runs = {n: token_diff(F.col(f"c.{n}.old"), F.col(f"c.{n}.new")) for n, *_ in pairs}
    labels = token_diffs(F.expr("transform(pairs, p -> p.old.label)"), F.expr("transform(pairs, p -> p.new.label)"))
    whole = base.select("sheet", "row", "outcome", "note", *(v.alias(n) for n, v in runs.items()), "pairs", "came", labels.alias("_runs"))
    # words as token_diff takes them: white space before the first is none of them
    links = F.expr(r"""concat(
        transform(arrays_zip(pairs, _runs), x -> struct(x._runs as runs, coalesce(x.pairs.new.url, x.pairs.old.url) as url, if(x.pairs.new is null, 'removed', 'kept') as change)),
        transform(transform(came, n -> struct(regexp_replace(n.label, r'(?U)^[\s\x1c-\x1f]+', '') as label, n.url as url)),
            n -> struct(if(n.label = '', array(), array(struct('add' as op, n.label as text))) as runs, n.url as url, 'added' as change)))""")
    return whole.withColumn("links", links.cast("array<struct<runs: array<struct<op: string, text: string>>, url: string, change: string>>")).drop("pairs", "came", "_runs")


def summary(df: DataFrame, column: str) -> DataFrame:
    """(sheet, column, n): rows of a view or redline by kind or outcome, for each tab."""
    return df.groupBy("sheet", column).agg(F.count("*").alias("n"))


#: Widths of the columns of rendered tabs, the first ones and all others, and of the about sheet.
WIDTHS, WIDTH, ABOUT_WIDTHS = [18, 44, 14, 10, 10], 30, [26, 21, 21, 21, 21, 21]
ABOUT = "About"


def tab_summary(view: DataFrame) -> DataFrame:
    """(sheet, name, status, rows, slots, without_link, with_loss) of tab views: component
    rows, most vendor cells of a row, rows without a live link and rows that lost one."""
    part = F.col("kind") == "part"
    out = view.groupBy("sheet").agg(
        F.count_if(part).alias("rows"), F.max(F.size("links") + F.size("texts")).alias("slots"), F.count_if(part & (F.size("links") == 0)).alias("without_link"), F.count_if(part & F.col("warning").isNotNull()).alias("with_loss")
    )
    names = resolve.projects(view.sparkSession).select("sheet", F.col("project_name").alias("name"), F.col("project_status").alias("status"))
    return out.join(F.broadcast(names), "sheet").select("sheet", "name", "status", "rows", "slots", "without_link", "with_loss")


def about(view: DataFrame) -> DataFrame:
    """Cells of a first sheet that says what the workbook is, with a line for each tab."""
    spark = view.sparkSession
    text_ = [
        "Sourcing guide, rebuilt", None, "Names are the shared ones, so a part reads the same on every tab.", "Every live link of a component is listed on all its tabs; dead ones are left out.",
        "The last column says what a row lost. A row without vendor had dead links only.", None,
    ]
    lines = spark.createDataFrame([(i, 1, t, i == 1) for i, t in enumerate(text_, 1) if t], "row int, col int, value string, bold boolean")
    head = ("Tab", "Status", "Rows", "Vendor slots", "Rows without live link", "Rows that lost links")
    first = len(text_) + 1
    lines = lines.unionByName(spark.createDataFrame([(first, i, t, True) for i, t in enumerate(head, 1)], "row int, col int, value string, bold boolean"))
    order = spark.createDataFrame([(p[0], i) for i, p in enumerate(dims.PROJECTS)], "sheet string, place int")
    each = tab_summary(view).join(order, "sheet").select("place", F.posexplode(F.array(*(F.col(c).cast("string") for c in ("name", "status", "rows", "slots", "without_link", "with_loss")))).alias("i", "value"))
    lines = lines.unionByName(each.select((F.lit(first + 1) + F.col("place")).cast("int").alias("row"), (F.col("i") + 1).cast("int").alias("col"), "value", F.lit(False).alias("bold")))
    null = F.lit(None).cast("string")
    return lines.select(F.lit(-1).alias("sheet_index"), F.lit(ABOUT).alias("sheet"), "row", "col", "value", null.alias("url"), null.alias("fill"), "bold")


def redline_grid(red: DataFrame) -> DataFrame:
    """Cells of redline tabs, with the edit runs of each (column runs): kept, struck and new
    words. Links that went or came are coloured, the last column says what happened."""
    spark = red.sparkSession
    order = spark.createDataFrame([(p[0], i) for i, p in enumerate(dims.PROJECTS)], "sheet string, sheet_index int")
    red = red.join(order, "sheet").withColumn("at", F.col("row"))
    widest = red.groupBy("sheet_index").agg(F.max(F.size("links")).alias("n"))
    runs_type = "array<struct<op: string, text: string>>"
    null = F.lit(None).cast("string")

    def out(df, row, col, runs, url=null, fill=null, bold=F.lit(False)):
        value = F.array_join(F.transform(runs, lambda x: x.text), "")
        return df.select("sheet_index", "sheet", row.cast("int").alias("row"), col.cast("int").alias("col"), value.alias("value"), url.alias("url"), fill.alias("fill"), bold.alias("bold"), runs.cast(runs_type).alias("runs"))

    kept = lambda c: F.array(F.struct(F.lit("keep").alias("op"), c.alias("text")))
    tabs = red.select("sheet_index", "sheet").distinct().join(widest, "sheet_index")
    heads = tabs.select("*", F.posexplode(F.array(*map(F.lit, ("Row", "Category", "Component", "Standard", "Qty", "Size")))).alias("i", "v"))
    result = out(heads, F.lit(1), F.col("i") + 1, kept(F.col("v")), bold=F.lit(True))
    result = result.unionByName(out(tabs, F.lit(1), F.col("n") + 7, kept(F.lit("What happened")), bold=F.lit(True)))
    result = result.unionByName(out(red, F.col("at"), F.lit(1), kept(F.col("row").cast("string"))))
    for i, c in enumerate(("category", "name", "standard", "qty", "size"), 2):
        result = result.unionByName(out(red.where(F.size(c) > 0), F.col("at"), F.lit(i), F.col(c)))
    links = red.select("sheet_index", "sheet", "at", F.posexplode("links").alias("i", "l"))
    target = F.when(F.coalesce(F.col("l.url"), F.lit("")) != "", F.array(F.struct(F.lit("keep").alias("op"), F.concat(F.lit("  <"), F.col("l.url"), F.lit(">")).alias("text")))).otherwise(_empty(runs_type))
    colour = F.when(F.col("l.change") == "removed", "FFF8D7DA").when(F.col("l.change") == "added", "FFD4EDDA")
    result = result.unionByName(out(links, F.col("at"), F.col("i") + 7, F.concat("l.runs", target), fill=colour))
    noted = red.where(F.coalesce("note", F.lit("")) != "").join(widest, "sheet_index")
    return result.unionByName(out(noted, F.col("at"), F.col("n") + 7, kept(F.col("note"))))
