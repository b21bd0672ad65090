import json

from spindrel.sources import documents


def test_link_status(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps({"checked_with": "x", "links": {"u": {"status": "no", "reason": "http 404", "http": 404}, "v": {"status": "yes"}}}))
    (tmp_path / "h.json").write_text(json.dumps({"links": {"u": {"status": "yes", "by": "me"}}}))
    got = {r["url"]: r for r in documents.link_status(spark, str(tmp_path / "m.json"), str(tmp_path / "h.json")).collect()}
    assert got["u"]["status"] == "yes" and got["u"]["verified"] == "manual" and got["u"]["reason"] == "checked by hand" and got["v"]["status"] == "yes"
    assert documents.link_status(spark, str(tmp_path / "none.json"), str(tmp_path / "h.json")).count() == 1


def test_alias_rules(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"merge": {"a": "b"}, "keep_separate": {"groups": [["M3 x 8", "m3x10", "!!"], ["x"]]}}))
    spec = documents.alias_spec(spark, str(tmp_path / "a.json"))
    assert [tuple(r) for r in documents.reviewed_pairs(spark, spec).collect()] == [("m3x10", "m3x8")]
    assert documents.alias_spec(spark, str(tmp_path / "absent.json")) == {}


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", 'x "quoted", and\nbroken'), ("b", "")], "id string, note string")
    documents.write_csv(df, str(tmp_path / "out"))
    back = documents.report_csv(spark, str(tmp_path / "out"))
    assert {r[0]: r["note"] for r in back.collect()}["a"] == 'x "quoted", and\nbroken'


def test_cookies(spark, tmp_path):
    (tmp_path / "c.txt").write_text("# c\n.a.com\tT\t/\tF\t0\tk\tv\na.com\tT\t/\tF\t0\tm\tw\nbad\tline\n")
    assert [tuple(r) for r in documents.cookies(spark, str(tmp_path / "c.txt")).collect()] == [("a.com", "k=v; m=w")]


def test_cookies(spark, tmp_path):
    (tmp_path / "jar.txt").write_text("# comment\n.a.com\tTRUE\t/\tFALSE\t0\tk\t1\na.com\tTRUE\t/\tFALSE\t0\tl\t2\nshort\tline\n")
    assert [tuple(r) for r in documents.cookies(spark, str(tmp_path / "jar.txt")).collect()] == [("a.com", "k=1; l=2")]
    (tmp_path / "header.txt").write_text("\n  session=1; theme=dark \n")
    assert [tuple(r) for r in documents.cookies(spark, str(tmp_path / "header.txt")).collect()] == [("", "session=1; theme=dark")]
    (tmp_path / "none.txt").write_text("")
    assert documents.cookies(spark, str(tmp_path / "none.txt")).count() == 0


def test_buckets_and_fills(spark, tmp_path):
    df = spark.createDataFrame([("a", "x"), ("b", "y")], "bucket string, name string")
    documents.write_buckets(df, "bucket", str(tmp_path / "out"))
    documents.write_buckets(df.where("bucket = 'b'"), "bucket", str(tmp_path / "out"))
    assert [p.name for p in (tmp_path / "out" / "by_bucket").iterdir() if p.is_dir()] == ["bucket=b"]
    assert documents.report_csv(spark, str(tmp_path / "out" / "all")).count() == 1
    documents.write_fills(spark.createDataFrame([("B", "FF1"), ("A", "FF2")], "category string, fill string"), str(tmp_path / "fills"))
    assert json.loads(spark.read.text(str(tmp_path / "fills")).first()[0]) == {"A": "FF2", "B": "FF1"}


def test_master_documents(spark, tmp_path):
    from spindrel.functions import dims
    from spindrel.operators import reports, resolve

    sheet = dims.PROJECTS[0][0]
    raw = spark.createDataFrame([(1, sheet, 2, "Frame", "Rail", "DIN", "2", None, ["note"], [("F", "Recommended", "vendor", "Shop", "https://shop.com/a"), ("G", "Budget", "vendor", "by phone", None)])], resolve.RAW)
    m = resolve.fold(raw, resolve.rules(spark, {}))
    path = str(tmp_path / "master")
    documents.write_master(reports.nested(m), resolve.projects(spark), reports.vendors(m), dims.ROLE_ORDER, path)
    item = json.loads(spark.read.text(f"{path}/items").first()[0])
    assert item["id"] == "frame.rail" and item["used_by"][0]["qty"][0]["qty_num"] == 2.0 and item["sources"][0]["raw_urls"] == ["https://shop.com/a"]
    assert item["unlinked_sources"][0]["text"] == "by phone" and item["notes"][0]["text"] == "note" and item["sources"][0]["link_ok"] == "unchecked"
    assert spark.read.json(f"{path}/projects").count() == len(dims.PROJECTS) and spark.read.json(f"{path}/roles").count() == len(dims.ROLE_ORDER)
    page = reports.report_text(raw, m)
    assert "| components | 1 |" in page and "| shop.com | 1 |" in page
    documents.write_raw(raw, spark.createDataFrame([(sheet, 1, 2, "Category", "category")], "sheet string, start int, end int, slot string, kind string"), str(tmp_path / "raw"))
    assert json.loads(spark.read.text(str(tmp_path / "raw" / "layouts")).first()[0])["slots"][0]["name"] == "Category"
