import zipfile

from spindrel.functions import dims
from spindrel.sources import workbook, xlsx

SHEET = dims.PROJECTS[0][0]
GRID = "sheet_index int, sheet string, row int, col int, value string, url string, fill string, bold boolean"


def put(r, c, value, url=None, fill=None, sheet=0, name=SHEET):
    return sheet, name, r, c, value, url, fill, None


HEAD = [put(1, c, v) for c, v in ((2, "Component"), (3, "Standard"), (4, "Qty"), (5, "250³"), (6, "Recommended"), (8, "Notes"))]


def test_round_trip(spark, tmp_path):
    grid = [put(1, 1, 'a "b" & <c>', None, "FFAABB00"), put(1, 27, None, 'https://x.com/?q="1"&r=2'), put(3, 2, "label", "https://y.com/"), put(1, 703, "far", sheet=1, name="Other [x]"), put(2, 1, " two\nlines ", sheet=1, name="Other [x]")]
    path = str(tmp_path / "book.xlsx")
    workbook.render(spark.createDataFrame(grid, GRID), path)
    cells = {(c["sheet"], c["row"], c["col"]): c for c in workbook.scan(spark, path).collect()}
    assert set(cells) == {(SHEET, 1, 1), (SHEET, 1, 27), (SHEET, 3, 2), ("Other  x ", 1, 703), ("Other  x ", 2, 1)}
    assert cells[(SHEET, 1, 1)]["value"] == 'a "b" & <c>' and cells[(SHEET, 1, 1)]["fill"] == "FFAABB00" and cells[(SHEET, 3, 2)]["fill"] is None
    assert cells[(SHEET, 3, 2)]["formula"] == 'HYPERLINK("https://y.com/","label")' and cells[("Other  x ", 2, 1)]["value"] == " two\nlines "
    got = {(r["row"], r["col"]): r["x"] for r in workbook.scan(spark, path).where("sheet_index = 0").select("row", "col", workbook.cell_link(*(workbook.F.col(c) for c in ("formula", "value", "link"))).alias("x")).collect()}
    assert got[(1, 27)]["url"] == 'https://x.com/?q="1"&r=2' and got[(3, 2)]["text"] == "label"


def test_empty_workbook(spark, tmp_path):
    path = str(tmp_path / "none.xlsx")
    workbook.render(spark.createDataFrame([], GRID), path)
    parts = workbook.scan(spark, path)
    assert parts.count() == 0 and workbook.raw_rows(parts).count() == 0


def raw(spark, cells, merges=(), links=()):
    rows = [(0, SHEET, "cell", r, c, None, None, f, v, None, None) for r, c, f, v in cells]
    rows += [(0, SHEET, "merge", *m, None, None, None, None) for m in merges] + [(0, SHEET, "link", r, c, r, c, None, None, u, None) for r, c, u in links]
    return {x["row"]: x for x in workbook.raw_rows(spark.createDataFrame(rows, workbook.PARTS)).collect()}


def test_rows_of_a_sheet(spark):
    head = [(r, c, None, v) for _, _, r, c, v, *_ in HEAD]
    cells = [
        (2, 1, None, "Frame"), (2, 2, None, " Rail  long "), (2, 3, None, "DIN"), (2, 4, None, "3"), (2, 5, None, "All"), (2, 6, 'HYPERLINK("https://a.com/"&"x?q=""1""","Shop")', "Shop"), (2, 7, None, "[Affiliate Link]"), (2, 8, None, "by hand"),
        (3, 4, None, "4"), (3, 6, "1+1", "2"),
        (4, 2, None, "As an Amazon associate we earn"),
        (5, 4, None, "lost"), (5, 6, None, "nobody's"),
        (6, 2, None, "Bed"), (6, 6, None, "x"),
        (7, 1, None, "Panels"), (7, 6, None, "y"),
        (8, 7, None, ""),
    ]
    got = raw(spark, head + cells, links=[(2, 7, "https://s.click.aliexpress.com/e/1")])
    assert set(got) == {2, 3, 4, 6, 7}
    a = got[2]
    assert (a["component"], a["category"], a["standard"], a["qty"], a["size"], a["notes"], a["continuation"]) == ("Rail long", "Frame", "DIN", "3", "All", ["by hand"], False)
    assert [tuple(e) for e in a["entries"]] == [("F", "Recommended", "vendor", "Shop", 'https://a.com/x?q="1"'), ("G", "Recommended", "vendor", "[Affiliate Link]", "https://s.click.aliexpress.com/e/1")]
    b = got[3]
    assert b["continuation"] and (b["component"], b["category"], b["standard"], b["qty"]) == ("Rail long", "Frame", "DIN", "4") and b["entries"][0]["text"] == "2"
    assert got[7]["component"] == "Bed" and got[7]["category"] == "Panels" and got[7]["seq"] == 7


def test_merges_and_spilled_columns(spark):
    head = [(1, 1, None, "Category"), (1, 2, None, "Component"), (1, 5, None, "Budget Source")]
    cells = [(2, 1, None, "Frame"), (2, 2, None, "Foot"), (2, 3, None, "spill"), (3, 2, None, "Nut"), (3, 3, None, "wide"), (4, 1, None, "Both"), (4, 6, None, "z")]
    got = raw(spark, head + cells, merges=[(2, 1, 3, 1), (3, 3, 3, 5), (4, 1, 4, 2), (2, 6, 3, 6)])
    assert [e["slot"] for e in got[2]["entries"]] == ["Budget Source"]  # an unlabelled column belongs to the next header
    assert got[3]["category"] == "Frame" and [(e["col"], e["slot"]) for e in got[3]["entries"]] == [("C", "Budget Source")]
    assert got[4]["component"] == "Nut" and got[4]["continuation"] and got[4]["category"] == "Both"  # no leak from A into B


def test_column_letters_agree():
    assert [workbook.column_letters(n) for n in (1, 26, 27, 702, 703, 16384)] == ["A", "Z", "AA", "ZZ", "AAA", "XFD"]
    assert all(workbook.column_number(workbook.column_letters(n)) == n for n in range(1, 2000, 7))


def test_letters_of_far_columns(spark):
    head = [(1, 2, None, "Component"), (1, 3, None, "Recommended")]
    got = raw(spark, head + [(2, 2, None, "N")] + [(2, c, None, "v") for c in (26, 27, 702, 703, 1379)])
    assert [e["col"] for e in got[2]["entries"]] == ["Z", "AA", "ZZ", "AAA", "BAA"]


def test_shared_strings_and_fills(spark, tmp_path):
    grid = [put(1, 2, "Component"), put(2, 1, "Misc.", None, "FF111111"), put(3, 1, "misc", None, "FF222222"), put(4, 1, "Misc", None, "FF111111"), put(2, 1, "Misc", None, "FF333333", 1, dims.PROJECTS[1][0])]
    path = str(tmp_path / "fills.xlsx")
    workbook.render(spark.createDataFrame(grid, GRID), path)
    fills = workbook.category_fills(workbook.scan(spark, path), [SHEET, dims.PROJECTS[1][0]])
    assert [tuple(r) for r in fills.collect()] == [("Misc", "FF111111", 1)]
    again = str(tmp_path / "shared.xlsx")
    with zipfile.ZipFile(path) as src, zipfile.ZipFile(again, "w") as dst:
        for n in src.namelist():
            data = src.read(n)
            if n.endswith("sheet1.xml"):
                data = data.replace(b't="inlineStr"><is><t xml:space="preserve">Component</t></is>', b't="s"><v>0</v>')
            dst.writestr(n, data)
        dst.writestr("xl/sharedStrings.xml", f'<sst xmlns="{xlsx._MAIN[1:-1]}"><si><r><t>Comp</t></r><r><t>onent</t></r><rPh sb="0" eb="1"><t>no</t></rPh></si></sst>')
    assert workbook.scan(spark, again).where("sheet_index = 0 and row = 1").first()["value"] == "Component"


def test_checksums_add_up():
    import random
    import zlib

    r = random.Random(2)
    for n, m in ((0, 0), (0, 5), (5, 0), (1, 1), (1000, 70_000), (3, 1 << 17)):
        a, b = r.randbytes(n), r.randbytes(m)
        assert xlsx.joined_crc(zlib.crc32(a), zlib.crc32(b), m) == zlib.crc32(a + b)


def test_sheets_are_partitions_and_tasks_write_pieces(spark, tmp_path):
    grid = [put(r, c, f"{r}:{c} <&>" if r % 7 else None, f"https://x.com/{r}" if r % 5 == 0 else None, "FF00FF00" if c == 2 else None, s, f"Tab {s}") for s in range(5) for r in range(1, 200) for c in (1, 2, 27)]
    path = f"file://{tmp_path}/many.xlsx"
    df = spark.createDataFrame(grid, GRID).repartition(6)
    workbook.render(df, path, [9, 12], 7, {"Tab 3": [33]})
    assert [p.name for p in tmp_path.iterdir()] == ["many.xlsx"]  # the pieces are gone
    parts = workbook.scan(spark, path)
    assert parts.rdd.getNumPartitions() == 5
    cells = {(c["sheet"], c["row"], c["col"]): c for c in parts.where("kind = 'cell'").collect()}
    assert len(cells) == len(grid)
    for s, name, row, col, value, url, fill, _ in grid:
        c = cells[(name, row, col)]
        assert c["sheet_index"] == s and c["fill"] == fill and c["value"] == (value if value or not url else url) and (c["formula"] is None) == (url is None)
    widths = sorted((r["sheet"], r["col"], r["col1"], r["value"]) for r in parts.where("kind = 'column'").collect())
    assert [w for w in widths if w[0] in ("Tab 0", "Tab 3")] == [("Tab 0", 1, 1, "9"), ("Tab 0", 2, 2, "12"), ("Tab 0", 3, 16384, "7"), ("Tab 3", 1, 1, "33")]
    with zipfile.ZipFile(tmp_path / "many.xlsx") as z:
        assert z.testzip() is None and b"</row></row>" not in z.read("xl/worksheets/sheet1.xml")
    workbook.render(df.where("sheet_index = 1"), path)  # written over
    assert workbook.scan(spark, path).where("kind = 'cell'").count() == len(grid) // 5


def test_runs_of_rich_text(spark, tmp_path):
    runs = [("keep", "M3 "), ("del", "old "), ("add", "new")]
    grid = [(0, SHEET, 2, 1, "M3 old new", None, None, None, runs), (0, SHEET, 2, 2, "same", None, None, None, [("keep", "same")])]
    path = str(tmp_path / "rich.xlsx")
    workbook.render(spark.createDataFrame(grid, GRID + ", runs array<struct<op: string, text: string>>"), path)
    parts = workbook.scan(spark, path)
    assert [(r["col"], r["row1"], r["formula"], r["value"]) for r in parts.where("kind = 'run'").orderBy("row1").collect()] == [(1, 0, None, "M3 "), (1, 1, "strike", "old "), (1, 2, "bold", "new")]
    assert {r["col"]: r["value"] for r in parts.where("kind = 'cell'").collect()} == {1: "M3 old new", 2: "same"}


def test_rows_of_cells_are_not_broadcast(spark):
    """Their files are small, but not they themselves, and what is broadcast passes through the driver."""
    parts = spark.createDataFrame([], workbook.PARTS)
    plan = workbook.raw_rows(parts)._jdf.queryExecution().analyzed().toString()
    assert plan.count("strategy=merge") >= 4


def test_cells_are_made_by_spark_and_read_up_to_a_column(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(workbook, "TASK_CELLS", 2)  # many tasks, and more than one for a row's sheet
    odd = [(1, "a & <b>", None), (2, None, None), (26, '"q"', 'https://x.example/?a="1"&b=<2>'), (27, None, "https://y.example/"), (702, "", ""), (703, " s ", None), (16384, "é", None), (18279, "z", None)]
    grid = [(i, f"S{i}", r, c, v, u, None, None) for i in (0, 1) for r in (1, 2, 3) for c, v, u in odd]
    path = str(tmp_path / "odd.xlsx")
    workbook.render(spark.createDataFrame(grid, GRID), path)
    link = {26: ('HYPERLINK("https://x.example/?a=""1""&b=<2>","""q""")', '"q"'), 27: ('HYPERLINK("https://y.example/","https://y.example/")', "https://y.example/")}
    want = {(s, r, c): link.get(c, (None, v or None)) for _, s, r, c, v, *_ in grid}
    assert {(x["sheet"], x["row"], x["col"]): (x["formula"], x["value"]) for x in workbook.scan(spark, path).collect()} == want
    few = workbook.scan(spark, path, 27).collect()
    assert {(x["sheet"], x["row"], x["col"]) for x in few} == {k for k in want if k[2] <= 27} and len(few) == 24
    with zipfile.ZipFile(path) as z:
        assert z.read("xl/worksheets/sheet1.xml").decode().count('r="AAAA2"') == 1 and z.testzip() is None
