"""Reports and views over one small catalogue, whose master tables are written once."""

import difflib
import zipfile

import pytest
from pyspark.sql import functions as F

from spindrel.functions import dims
from spindrel.operators import reports, resolve, views, windows
from spindrel.sources import workbook

A, B, OLD = dims.PROJECTS[0][0], dims.PROJECTS[1][0], dims.PROJECTS[14][0]
PA, PB, POLD = (next(p[1] for p in dims.PROJECTS if p[0] == s) for s in (A, B, OLD))


def cell(col, slot, text, url=None):
    return (col, slot, "vendor", text, url)


ROWS = [
    (1, A, 2, "Hardware", "M3x8 SHCS", None, "10", None, ["tight fit"], [cell("F", "Recommended", "Shop", "https://shop.com/a?utm_source=q"), cell("G", "Recommended", "[Affiliate Link]", "https://s.click.aliexpress.com/e/x")], False),
    (2, A, 3, None, "OR", None, None, None, [], [], False),
    (3, A, 4, "Hardware", "M3x8 shcs", None, "12", "250³", [], [cell("F", "Recommended", "Other", "https://gone.com/p")], False),
    (4, A, 5, "Hardware", "m3x8 SHCS", None, "9", None, [], [], False),
    (5, A, 6, None, "OR", None, None, None, [], [], False),
    (6, A, 7, "Frame", "Rail", "DIN", "2", None, [], [cell("F", "Recommended", "Rails", "https://rail.com/r")], False),
    (7, A, 8, None, "Kits listed below", None, None, None, [], [], False),
    (8, A, 9, None, "As an Amazon associate", None, None, None, [], [], False),
    (9, B, 2, "Frame", "Rail", None, "3", None, ["cut it"], [cell("F", "Recommended", "Elsewhere", "https://other.com/r"), cell("G", "Budget Source", "by phone")], False),
    (10, B, 3, "Panels", "Sheet", None, "1", None, [], [cell("F", "Recommended", "Short", "https://s.click.aliexpress.com/e/y"), cell("H", "Alternative Source", "Rails", "https://rail.com/r")], False),
    (11, OLD, 2, "Panels", "Foil", None, None, None, [], [cell("F", "Recommended", "ask")], False),
]
STATUS = [
    ("https://shop.com/a", "yes", "http 200"), ("https://s.click.aliexpress.com/e/x", "no", "http 404"), ("https://gone.com/p", "no", "http 404"), ("https://rail.com/r", "yes", "http 200"),
    ("https://other.com/r", "yes", "http 200"), ("https://s.click.aliexpress.com/e/y", "no", "http 404"),
]


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    raw = spark.createDataFrame(ROWS, resolve.RAW + ", continuation boolean")
    r = resolve.rules(spark, {"drop": ["Kits listed below"], "split_by_project": {"categories": ["panels"]}})
    status = spark.createDataFrame(STATUS, "url string, status string, reason string")
    m = resolve.fold(raw, r, status)
    path = str(tmp_path_factory.mktemp("master"))
    tables = {}
    for name in ("items", "uses", "sources", "unlinked", "notes"):
        getattr(m, name).write.parquet(f"{path}/{name}")
        tables[name] = spark.read.parquet(f"{path}/{name}")
    return raw, r, resolve.Master(**tables), status


def test_coverage(made):
    _, _, m, _ = made
    got = {x["name"]: x for x in reports.coverage(m).collect()}
    assert {n: x["coverage"] for n, x in got.items()} == {"M3x8 SHCS": "partial", "Rail": "all_live", "Sheet": "partial", "Foil": "no_links"}
    rail = got["Rail"]
    assert rail["live_vendors"] == "other.com | rail.com" and rail["projects"] == f"{PA} {PB}" and rail["live_links"] == "https://other.com/r | https://rail.com/r" and rail["text_only_sources"] == "by phone"
    assert {x["coverage"]: (x["n_items"], x["n_current"]) for x in reports.coverage_summary(m).collect()} == {"partial": (2, 2), "all_live": (1, 1), "no_links": (1, 0)}
    assert [(x["item_name"], x["project"], x["text_only_sources"]) for x in reports.unlinked(m).collect()] == [("Foil", POLD, "ask")]


def test_conflicts_and_shared_links(made):
    _, _, m, _ = made
    got = [(x["item_name"], x["role"], x["variant"], x["projects"], x["urls"]) for x in reports.conflicts(m).orderBy("variant").collect()]
    assert got == [("Rail", "recommended", 1, PA, "https://rail.com/r"), ("Rail", "recommended", 2, PB, "https://other.com/r")]
    ratio = difflib.SequenceMatcher(None, "rail", f"sheet @{PB}").ratio()
    assert [tuple(x) for x in reports.shared_links(m).collect()] == [(ratio, 1, "frame.rail", "Rail", f"{PA} {PB}", f"panels.sheet.{PB}", "Sheet", PB, "https://rail.com/r")]


def test_affiliates(made):
    _, _, m, status = made
    got = [tuple(x[c] for c in ("verdict", "item_name", "product_link_status", "dead_affiliate_links", "live_affiliate_links")) for x in reports.affiliates(m, status).collect()]
    assert got == [("affiliate dead, product link fine", "M3x8 SHCS", "yes", "https://s.click.aliexpress.com/e/x", ""), ("only link is a dead affiliate code", "Sheet", "no", "https://s.click.aliexpress.com/e/y", "")]


def test_workload(made):
    raw, r, m, _ = made
    got = {x["key"]: (x["name"], x["tabs"], x["variants_full"], x["variants_links"], x["variants_name"]) for x in reports.workload(raw, r).collect()}
    assert got == {"m3x8 shcs": ("M3x8 SHCS", 1, 1, 1, 1), "rail": ("Rail", 2, 2, 2, 1), f"sheet @{PB}": ("Sheet", 1, 1, 1, 1), f"foil @{POLD}": ("Foil", 1, 1, 1, 1)}
    total = reports.workload_totals(reports.workload(raw, r)).first()
    assert (total["components"], total["uses"], total["variants_full"], total["shared"], total["shared_variants"], total["links_differ"]) == (4, 5, 5, 1, 2, 1)
    assert {x["metric"]: x["value"] for x in reports.link_totals(raw, m).collect()} == {"link cells": 7, "distinct urls": 6, "distinct products": 5}


def test_headline(made):
    raw, _, m, _ = made
    got = [(x["metric"], x["value"]) for x in reports.headline(raw, m).collect()]
    assert [v for _, v in got] == [3, 11, 4, 1, 5, 6, 1, 1, 1, 1, 0]
    assert {x["project_name"]: x["components"] for x in reports.components_per_tab(m).where("components > 0").collect()} == {dims.PROJECTS[0][2]: 2, dims.PROJECTS[1][2]: 2, OLD: 1}
    assert [(x["vendor_name"], x["links"]) for x in reports.links_per_vendor(m, 1).collect()] == [("rail.com", 2)]


def test_canonical(made):
    _, _, m, _ = made
    df = reports.canonical(m, [PA, PB])
    got = {x["name"]: x for x in df.collect()}
    screw = got["M3x8 SHCS"]
    assert screw[f"qty:{PA}"] == "10; 12@250; 9" and screw[f"qty:{PB}"] == "" and screw["link_1"] == "Shop" and screw["notes"] == "tight fit" and screw["link_2"] == ""
    assert got["Rail"]["link_2_url"] == "https://rail.com/r" and got["Rail"]["n_live_links"] == 2 and df.columns[-1] == "link_2_url"
    assert reports.master_links(m).count() == 6


def test_tab_view(spark, made, tmp_path):
    raw, r, m, status = made
    fills = spark.createDataFrame([("Hardware", "FF00FF00")], "category string, fill string")
    view = views.tab_view(raw, r, m, status, fills)
    rows = view.where(view.sheet == A).orderBy("position").collect()
    assert [(x["kind"], x["name"], x["qty"], x["size"]) for x in rows] == [
        ("part", "M3x8 SHCS", "10", "All"), ("part", "M3x8 SHCS", "12", "250"), ("part", "M3x8 SHCS", "9", "All"), ("or", "OR", None, None), ("part", "Rail", "2", "All"),
        ("heading", "Kits listed below", None, None), ("footer", "As an Amazon associate", None, None),
    ]
    assert rows[0]["warning"] == "some links were dead" and rows[3]["fill"] == "FF00FF00" and rows[4]["fill"] is None
    path = str(tmp_path / "view.xlsx")
    workbook.render(views.grid(view), path)
    cells = {(c["sheet"], c["row"], c["col"]): c for c in workbook.scan(spark, path).where("kind = 'cell'").collect()}
    assert cells[(A, 2, 2)]["value"] == "M3x8 SHCS" and cells[(A, 2, 2)]["fill"] == "FF00FF00" and cells[(A, 2, 6)]["formula"] == 'HYPERLINK("https://shop.com/a","Shop")'
    summary = {x["sheet"]: (x["rows"], x["slots"], x["without_link"], x["with_loss"]) for x in views.tab_summary(view).collect()}
    assert summary[A] == (4, 2, 0, 3) and summary[OLD] == (1, 1, 1, 0)
    book = str(tmp_path / "book.xlsx")
    workbook.render(views.grid(view).unionByName(views.about(view)), book, views.WIDTHS, views.WIDTH, {views.ABOUT: views.ABOUT_WIDTHS})
    about = {(c["row"], c["col"]): c["value"] for c in workbook.scan(spark, book).where("kind = 'cell' and sheet = 'About'").collect()}
    assert about[(7, 1)] == "Tab" and about[(8, 1)] == dims.PROJECTS[0][2] and about[(8, 3)] == "4"
    with zipfile.ZipFile(book) as z:
        sheets = [z.read(f"xl/worksheets/sheet{i}.xml").decode() for i in (1, 2)]
    assert '<col min="1" max="1" width="26" customWidth="1"/>' in sheets[0] and '<col min="6" max="16384" width="30" customWidth="1"/>' in sheets[1]
    # rebuilt tabs name the same parts
    again = workbook.raw_rows(workbook.scan(spark, path))
    assert [x["component"] for x in again.where(again.sheet == A).orderBy("row").collect()] == [x["name"] for x in rows]


def test_redline(spark, made, tmp_path):
    raw, r, m, _ = made
    df = views.redline(raw, r, m)
    path = str(tmp_path / "red.xlsx")
    workbook.render(views.redline_grid(df), path)
    with zipfile.ZipFile(path) as z:
        first = z.read("xl/worksheets/sheet1.xml").decode()
    assert "<strike/>" in first and '<t xml:space="preserve">SHCS</t>' in first
    cells = {(c["sheet"], c["row"], c["col"]): c for c in workbook.scan(spark, path).where("kind = 'cell'").collect()}
    assert cells[(A, 4, 3)]["value"] == "M3x8 shcsSHCS" and cells[(A, 4, 7)]["fill"] == "FFF8D7DA" and cells[(A, 1, 3)]["value"] == "Component"
    assert {x["outcome"]: x["n"] for x in views.summary(df.where(df.sheet == A), "outcome").collect()} == {"edited": 3, "separator": 2, "merged": 1, "marker": 2}
    got = {x["row"]: x for x in df.where(df.sheet == A).collect()}
    assert {n: x["outcome"] for n, x in got.items()} == {2: "edited", 3: "separator", 4: "edited", 5: "merged", 6: "separator", 7: "edited", 8: "marker", 9: "marker"}
    assert got[5]["note"] == 'merged into row 2, "M3x8 SHCS"' and got[2]["note"] == "1 dead link removed, 1 link address cleaned"  # the affiliate code is a link too
    assert [(x["change"], x["url"]) for x in got[4]["links"]] == [("removed", "https://gone.com/p"), ("added", "https://shop.com/a")]
    assert got[4]["note"] == "1 dead link removed, 1 link added from other tabs"
    assert [tuple(x) for x in got[4]["name"]] == [("keep", "M3x8 "), ("del", "shcs"), ("add", "SHCS")]
    other = {x["row"]: x for x in df.where(df.sheet == B).collect()}
    assert other[3]["note"] == "1 dead link removed" and [x["change"] for x in other[3]["links"]] == ["removed", "kept"]
    assert [x["change"] for x in other[2]["links"]] == ["kept", "kept", "added"]  # a guidance in words is matched by its wording


def test_redline_merges_rows_without_quantity(spark):
    rows = [(1, A, 2, "Frame", "Foot", "X", None, None, [], [], False), (2, A, 3, "Frame", "foot", "Y", None, None, [], [], False), (3, A, 4, "Frame", "foot", None, None, "250", [], [], False)]
    raw, r = spark.createDataFrame(rows, resolve.RAW + ", continuation boolean"), resolve.rules(spark, {})
    got = {x["row"]: (x["outcome"], x["note"]) for x in views.redline(raw, r, resolve.fold(raw, r)).collect()}
    assert got[2][0] == "edited" and got[3] == ("merged", 'merged into row 2, "foot"') and got[4][0] == "edited"


def test_neighbours_follow_in_one_pass(spark):
    rows = [("s", i, v, v == "or") for i, v in enumerate(["or", "a", None, "or", "or", "b", "c", "or"])] + [("t", 0, "d", False)]
    df = windows.neighbours(spark.createDataFrame(rows, "sheet string, row int, v string, is_or boolean"), "sheet", ["row"], "v", F.col("is_or"))
    got = [(x["left"], x["right"], x["back_to_back"]) for x in df.orderBy("sheet", "row").collect()]
    assert got == [(None, "a", False), (None, "b", False), ("a", "b", False), ("a", "b", False), ("a", "b", True), ("a", "c", False), ("b", None, False), ("c", None, False), (None, None, False)]
    assert "unboundedfollowing" not in df._jdf.queryExecution().optimizedPlan().toString().lower()  # such a frame is the square of a sheet's rows


def test_redline_links_stay_in_their_rows(made):
    raw, r, m, _ = made
    plan = views.redline(raw, r, m)._jdf.queryExecution().optimizedPlan().toString()
    assert "explode(pairs" not in plan  # neither a row per link, nor links of an item for rows that show none
    assert "_shown" in plan


def test_tabs_are_put_in_order_without_links(made):
    raw, r, m, status = made
    plan = views.tab_view(raw, r, m, status)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    deep = [len(x) - len(x.lstrip(" :+-")) for x in plan]
    top = min(d for x, d in zip(plan, deep, strict=True) if x.lstrip(" :+-").startswith("Window "))
    first = next(i for i, x in enumerate(plan) if deep[i] == top and x.lstrip(" :+-").startswith("Window "))
    below = [plan[i] for i in range(first + 1, len(plan)) if min(deep[first + 1 : i + 1]) > top]  # one task sorts a tab: what it holds
    assert any("rows" in x for x in below) and not any("link_ok" in x or "url_key" in x for x in below)
