"""Spreadsheet workbooks: scan of cells and merges, raw catalogue rows, rendering. The file
itself is a data source (xlsx.py); headers, merges, links and carry-forward are DataFrame work.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text
from ..operators import windows
from ..operators.staging import stage
from .xlsx import PARTS, RUN, WorkbookSource, column_letters, column_number

__all__ = ["PARTS", "category_fills", "cell_link", "column_letters", "column_number", "raw_rows", "render", "scan", "slots"]

#: More than the rows of any sheet (1,048,576 by the format).
SHEET_ROWS = 1 << 21
#: Cell styles that the format allows.
MOST_STYLES = 64_000
#: Cells that a task puts in order, about; with fewer tasks than that takes they would spill.
TASK_CELLS = 1 << 19


def scan(spark: SparkSession, path: str, last: int | None = None) -> DataFrame:
    """The parts of one workbook (PARTS), a partition per sheet: cells with formula and stored
    value side by side, merged ranges, link targets, column widths and runs of rich text. A
    sheet without any gives no row. Of cells and runs those of columns 1 to `last`, if given."""
    spark.dataSource.register(WorkbookSource)
    read = spark.read.format("workbook")
    return (read if last is None else read.option("last_column", last)).load(path)


def _letters(col: Column) -> Column:
    """The letters of a column, up to four."""
    out, first, power = [], 1, 1
    for _ in range(4):
        at = F.pmod(F.floor((col - first) / power), F.lit(26))
        out.append(F.when(col >= first, F.chr(65 + at)).otherwise(""))
        power *= 26
        first += power
    return F.concat(*reversed(out))


def _escaped(c: Column) -> Column:
    for mark, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(mark), F.lit(name))
    return c


def _xml(style: Column, rich: bool) -> Column:
    """A cell as it stands in a sheet: a link formula, rich text, a text or nothing."""
    head = F.concat(F.lit('<c r="'), _letters(F.col("col")), F.col("row").cast("string"), F.lit('" s="'), style.cast("string"), F.lit('"'))
    value, url = (F.coalesce(F.col(c), F.lit("")) for c in ("value", "url"))
    shown = F.when(value != "", value).otherwise(url)
    quoted = lambda c: F.replace(c, F.lit('"'), F.lit('""'))
    formula = F.concat(F.lit('HYPERLINK("'), quoted(url), F.lit('","'), quoted(shown), F.lit('")'))
    out = F.when(url != "", F.concat(head, F.lit(' t="str"><f>'), _escaped(formula), F.lit("</f><v>"), _escaped(shown), F.lit("</v></c>")))
    if rich:
        font = F.create_map(*(F.lit(x) for pair in RUN.items() for x in pair))
        text_ = F.transform("runs", lambda x: F.concat(F.lit("<r>"), font[x.op], F.lit('<t xml:space="preserve">'), _escaped(x.text), F.lit("</t></r>")))
        out = out.when(F.exists("runs", lambda x: x.op != "keep"), F.concat(head, F.lit(' t="inlineStr"><is>'), F.array_join(text_, ""), F.lit("</is></c>")))
    plain = F.concat(head, F.lit(' t="inlineStr"><is><t xml:space="preserve">'), _escaped(value), F.lit("</t></is></c>"))
    return out.when(value != "", plain).otherwise(F.concat(head, F.lit("></c>")))


def render(grid: DataFrame, path: str, widths: list[float] = (), rest: float | None = None, by_sheet: dict[str, list[float]] | None = None) -> None:
    """Write a cell grid (sheet_index, sheet, row, col, value, url, fill, bold; all but the
    places may be null, and there may be runs: edit runs (op, text) of a cell) as a workbook.
    `widths` are of the first columns, `rest` of all others, unless `by_sheet` has a sheet's
    own. A url makes a link formula. Tasks write ranges of rows; sheets and styles only, which
    the format bounds, reach the driver."""
    spark = grid.sparkSession
    spark.dataSource.register(WorkbookSource)
    rich = "runs" in grid.columns
    rows = stage(grid.select("sheet_index", "sheet", "row", "col", "value", "url", "fill", F.coalesce("bold", F.lit(False)).alias("bold"), *(["runs"] if rich else [])))
    sizes = rows.groupBy("sheet_index").agg(F.min("sheet").alias("sheet"), F.count("*").alias("n")).orderBy("sheet_index").collect()
    sheets = [[r["sheet_index"], r["sheet"]] for r in sizes]
    found = [(r["fill"], r["bold"]) for r in rows.select("fill", "bold").distinct().limit(MOST_STYLES + 1).collect()]
    if len(found) > MOST_STYLES:
        raise ValueError("more cell styles than the format allows")
    styles = [(None, False), *sorted((s for s in found if s != (None, False)), key=str)]
    numbers = spark.createDataFrame([(*s, i) for i, s in enumerate(styles)], "_fill string, _bold boolean, style int")
    rows = rows.join(F.broadcast(numbers), F.col("fill").eqNullSafe(F.col("_fill")) & (F.col("bold") == F.col("_bold"))).drop("sheet", "fill", "bold", "_fill", "_bold")
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), sum(r["n"] for r in sizes) // TASK_CELLS + 1)
    placed = rows.repartitionByRange(n, "sheet_index", "row").sortWithinPartitions("sheet_index", "row", "col")
    placed = placed.select("sheet_index", "row", _xml(F.col("style"), rich).alias("xml"))  # a cell's text is longer than the cell: made last
    options = {"styles": styles, "sheets": sheets, "widths": list(widths), "rest": rest, "by_sheet": by_sheet or {}}
    placed.write.format("workbook").mode("append").options(**{k: json.dumps(v) for k, v in options.items()}).save(path)


# ---- fixed values: header -> kind of column; everything else is a vendor column
HEADERS = {"": "category", "category": "category", "component": "component", "standard": "standard", "qty": "qty", "size": "size", "all sizes": "size", "notes": "notes"}
META = ["category", "component", "standard", "qty", "size"]
_QUOTED = '"((?:[^"]|"")*)"'
_ARG = '"(?:[^"]|"")*"(?:\\s*&\\s*"(?:[^"]|"")*")*'
_LINK = rf"(?i)^\s*HYPERLINK\(\s*({_ARG})\s*(?:,\s*({_ARG})\s*)?\)\s*$"


def tidy(c: Column) -> Column:
    """Spaces of all kinds unified and trimmed, line breaks kept; null where nothing is left."""
    s = F.regexp_replace(F.translate(c, "\u00a0", " "), r"^(?U)\s+|\s+$", "")
    return F.nullif(F.regexp_replace(s, "[ \\t]+", " "), F.lit(""))


def header_kind(label: Column) -> Column:
    key = F.lower(F.trim(F.coalesce(label, F.lit(""))))
    return F.when(key.rlike(r"^\d{2,4}\s*[³°]?$"), "size").otherwise(text.mapped(key, HEADERS, F.lit("vendor")))


def _joined(arg: Column) -> Column:
    """Quoted strings joined by & as plain text."""
    return F.array_join(F.transform(F.regexp_extract_all(arg, F.lit(_QUOTED), F.lit(1)), lambda x: F.replace(x, F.lit('""'), F.lit('"'))), "")


def cell_link(formula: Column, value: Column, target: Column) -> Column:
    """struct(text, url): a link formula first, else the stored value with the cell's own link."""
    is_link = F.coalesce(formula.rlike(_LINK), F.lit(False))
    url, label = F.regexp_extract(formula, _LINK, 1), F.regexp_extract(formula, _LINK, 2)
    shown = F.when(is_link, _joined(F.when(label != "", label).otherwise(url))).otherwise(F.coalesce(tidy(value), F.concat(F.lit("="), formula)))
    return F.struct(tidy(shown).alias("text"), F.when(is_link, _joined(url)).otherwise(target).alias("url"))


def slots(parts: DataFrame) -> DataFrame:
    """(sheet, start, end, slot, kind): every header reaches to the one before the next."""
    cells = parts.where("kind = 'cell'")
    width = parts.where("kind in ('cell', 'merge', 'link')").groupBy("sheet").agg(F.max(F.coalesce("col1", "col")).alias("_last"))
    heads = cells.where("row = 1").select("sheet", F.col("col").alias("start"), tidy(F.col("value")).alias("_label"))
    corner = cells.select("sheet", F.lit(1).alias("start"), F.lit(None).cast("string").alias("_label")).distinct()  # column A is one, labelled or not
    heads = heads.unionByName(corner).groupBy("sheet", "start").agg(F.max("_label").alias("_label")).where("_label is not null or start = 1")
    heads = windows.slot_intervals(heads.join(width, "sheet"), "sheet", "start", F.col("_last"))
    return heads.select("sheet", "start", "end", F.coalesce("_label", F.lit("Category")).alias("slot"), header_kind(F.col("_label")).alias("kind"))


def owners(layout: DataFrame) -> DataFrame:
    """(sheet, lo, hi, slot, kind): the slot that columns lo..hi belong to. A metadata header
    owns its own column only; what follows belongs to the next header, or to itself if last."""
    w = Window.partitionBy("sheet").orderBy("start")
    own = F.struct("slot", "kind")
    heirs = layout.withColumn("_own", own).withColumn("_next", F.coalesce(F.lead(own).over(w), own))
    meta = F.col("kind").isin(META)
    wide = F.array(F.struct(F.col("start").alias("lo"), F.when(meta, F.col("start")).otherwise(F.col("end")).alias("hi"), F.col("_own").alias("o")),
                   F.struct((F.col("start") + 1).alias("lo"), F.when(meta, F.col("end")).otherwise(F.col("start")).alias("hi"), F.col("_next").alias("o")))
    return heirs.select("sheet", F.explode(wide).alias("x")).where("x.lo <= x.hi").select("sheet", "x.lo", "x.hi", "x.o.slot", "x.o.kind")


def _merged_rows(parts: DataFrame) -> DataFrame:
    """(sheet, row, r0, c0, c1): merged ranges by the rows they cover."""
    m = parts.where("kind = 'merge'")
    return m.select("sheet", F.explode(F.sequence("row", "row1")).alias("row"), F.col("row").alias("r0"), F.col("col").alias("c0"), F.col("col1").alias("c1"))


def raw_rows(parts: DataFrame) -> DataFrame:
    """Catalogue rows (resolve.RAW and continuation) of a scanned workbook. A row without
    component continues the one above, unless a footer line lies between; rows that have
    nothing to continue are dropped, as are rows without component, category and cells."""
    # tables of a row per cell or merged row meet by sorting: their files are a few MB that swell
    # to many times that, and what is broadcast passes through the driver
    layout = slots(parts)
    merged = _merged_rows(parts)
    targets = parts.where("kind = 'link'").select("sheet", F.explode(F.sequence("row", "row1")).alias("row"), F.col("col").alias("l0"), F.col("col1").alias("l1"), F.col("link").alias("_target"))
    cells = parts.where("kind = 'cell'").select("sheet_index", "sheet", "row", "col", "formula", "value")
    sheets = parts.select("sheet", "sheet_index").distinct()

    # metadata: of each kind the first column with that header counts
    meta = layout.where(F.col("kind").isin(META)).groupBy("sheet", "kind").agg(F.min("start").alias("col"))
    columns = meta.groupBy("sheet").agg(F.collect_set("col").alias("_meta"))
    spread = merged.join(meta, "sheet").where(F.col("col").between(F.col("c0"), F.col("c1"))).join(columns, "sheet")
    # a range that starts in another metadata column says nothing about this one
    spread = spread.select("sheet", "row", "kind", F.when((F.col("c0") != F.col("col")) & F.array_contains("_meta", F.col("c0")), None).otherwise(F.col("c0")).alias("at"), F.col("r0").alias("from"))
    stored = cells.select("sheet", F.col("row").alias("from"), F.col("col").alias("at"), tidy(F.col("value")).alias("v"))
    inherited = spread.join(stored.hint("merge"), ["sheet", "from", "at"], "left").select("sheet", "row", "kind", "v", F.lit(1).alias("by_merge"))
    own = cells.join(meta, ["sheet", "col"]).select("sheet", "row", "kind", tidy(F.col("value")).alias("v"), F.lit(0).alias("by_merge"))
    values = own.unionByName(inherited).where("row > 1").groupBy("sheet", "row", "kind").agg(F.max_by(F.struct("v"), "by_merge").alias("v"))
    values = values.groupBy("sheet", "row").agg(*(F.max(F.when(F.col("kind") == k, F.col("v.v"))).alias(k) for k in META))

    # vendor and note cells: a merged block is read at its first column, for the first vendor slot it reaches
    held = owners(layout)
    block = merged.withColumnRenamed("row", "row_").withColumnRenamed("sheet", "sheet_")
    body = cells.where("row > 1").join(columns.withColumnRenamed("sheet", "s_"), F.col("sheet") == F.col("s_"), "left").where(~F.array_contains(F.coalesce("_meta", F.array().cast("array<int>")), F.col("col")))
    body = body.join(block.hint("merge"), (F.col("sheet") == F.col("sheet_")) & (F.col("row") == F.col("row_")) & F.col("col").between(F.col("c0"), F.col("c1")), "left").where("c0 is null or c0 = col")
    body = body.select("sheet", "row", "col", "formula", "value", F.coalesce("c1", "col").alias("reach"))
    body = body.join(targets.withColumnsRenamed({"sheet": "s_", "row": "r_"}).hint("merge"), (F.col("sheet") == F.col("s_")) & (F.col("row") == F.col("r_")) & F.col("col").between(F.col("l0"), F.col("l1")), "left")
    body = body.withColumn("x", cell_link(F.col("formula"), F.col("value"), F.col("_target"))).where("x.text is not null or x.url is not null").select("sheet", "row", "col", "reach", "x.text", "x.url")
    over = held.withColumnRenamed("sheet", "s_")
    body = body.join(over, (F.col("sheet") == F.col("s_")) & (F.col("lo") <= F.col("reach")) & (F.col("hi") >= F.col("col")))
    own_slot = F.col("lo") <= F.col("col")
    # without a vendor slot under a block its own slot stands
    rank = F.struct(F.when((F.col("kind") == "vendor") & (F.col("reach") > F.col("col")), 0).when(own_slot, 1).otherwise(2), F.col("lo"))
    body = body.groupBy("sheet", "row", "col", "text", "url").agg(F.min_by(F.struct("slot", "kind"), rank).alias("o"))
    entry = F.struct("col", F.struct(_letters(F.col("col")).alias("col"), F.col("o.slot").alias("slot"), F.col("o.kind").alias("kind"), "text", "url").alias("e"))
    lists = body.groupBy("sheet", "row").agg(F.transform(F.array_sort(F.collect_list(entry)), lambda x: x.e).alias("_all"))

    rows = values.join(lists.hint("merge"), ["sheet", "row"], "full_outer").join(sheets, "sheet").withColumn("_all", F.coalesce("_all", F.expr("cast(array() as array<struct<col: string, slot: string, kind: string, text: string, url: string>>)")))
    rows = rows.where("component is not null or category is not null or size(_all) > 0")
    footer = F.coalesce(F.col("component").rlike(r"(?i)^\W*as an (amazon|aliexpress)"), F.lit(False))
    rows = rows.withColumn("continuation", F.col("component").isNull()).withColumn("_foot", footer)
    carried = F.struct("component", "category", "standard")
    nothing = F.struct(*(F.lit(None).cast("string").alias(c) for c in ("component", "category", "standard")))
    above = Window.partitionBy("sheet").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    state = F.last(F.when(F.col("_foot"), nothing).when(F.col("component").isNotNull(), carried), ignorenulls=True).over(above)
    rows = rows.withColumn("_s", state)
    fill = lambda c: F.when(F.col("continuation"), F.coalesce(F.col(c), F.col(f"_s.{c}"))).otherwise(F.col(c)).alias(c)
    notes = F.transform(F.filter("_all", lambda e: (e.kind == "notes") & e.text.isNotNull()), lambda e: e.text)
    rows = rows.select((F.col("sheet_index").cast("long") * SHEET_ROWS + F.col("row")).alias("seq"), "sheet", "row", fill("category"), fill("component"), fill("standard"), "qty", "size",
                       notes.alias("notes"), F.filter("_all", lambda e: e.kind == "vendor").alias("entries"), "continuation")
    return rows.where("component is not null")


def category_fills(parts: DataFrame, precedence: list[str]) -> DataFrame:
    """(category, fill, n_clashes): the usual colour of a category in column A of the first
    sheet of `precedence` that has it, and how many later sheets colour it otherwise."""
    from ..operators.aggregates import pick_by_precedence

    order = F.create_map(*(F.lit(x) for i, s in enumerate(precedence) for x in (s, i)))
    a = parts.where("kind = 'cell' and row > 1 and col = 1 and fill is not null and trim(value) <> ''").withColumn("rank", F.try_element_at(order, F.col("sheet"))).where("rank is not null")
    a = a.select(text.category(F.col("value")).alias("category"), "sheet", "fill", "rank", "row").where("category is not null")
    return pick_by_precedence(a, "category", "sheet", "fill", "rank", "row")
