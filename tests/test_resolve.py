import random

from pyspark.sql import functions as F

from spindrel.functions import dims
from spindrel.operators import resolve, windows

# tabs of one family, of another, and of none
T24, TRI, T02, T01 = (dims.PROJECTS[i][0] for i in (0, 1, 2, 13))
I24, I01 = dims.PROJECTS[0][1], dims.PROJECTS[13][1]


def cell(col, slot, text, url=None):
    return (col, slot, "vendor", text, url)


ROWS = [
    (1, T24, 3, "Hardware", "M3 x 8 SHCS", None, "10", None, ["tight fit"], [cell("F", "Recommended", "Shop", "https://www.shop.com/a?utm_source=q"), cell("G", "Recommended", "[Affiliate Link]", "https://s.click.aliexpress.com/e/x")]),
    (2, T24, 4, None, "OR", None, None, None, [], []),
    (3, T24, 5, "Hardware", "M3x8 SHCS", None, "12", "250³", ["tight fit"], [cell("F", "Recommended", "Other", "http://shop.com/a")]),
    (4, TRI, 9, "Misc.", "m3x8 shcs ", "DIN", "3.0", "True", [], [cell("AA", "Budget Source", "by phone")]),
    (5, TRI, 10, "Frame", "HFSB5-2020-370-AH45 rail", None, "2", None, [], [cell("F", "?", "x", "https://www.misumi-ec.com/p")]),
    (6, T01, 2, "Panels", "Bed", None, "1", None, [], []),
    (7, T02, 2, "Panels", "Bed", None, "1", None, [], []),
    (8, T24, 20, "Panels", "Bed", None, "1", None, [], []),
    (9, "Unknown", 2, None, "Thing", None, None, None, [], []),
    (10, T24, 30, None, "As an Amazon associate", None, None, None, [], []),
    (11, T24, 31, None, "dropped thing", None, None, None, [], []),
]
SPEC = {"drop": ["Dropped Thing"], "split_by_family": {"names": ["bed"]}, "names": {"m3x8 shcs": "M3x8 screw"}}


def test_master(spark):
    raw, r = spark.createDataFrame(ROWS, resolve.RAW), resolve.rules(spark, SPEC)
    status = spark.createDataFrame([("https://www.shop.com/a", "yes", "http 200"), ("https://s.click.aliexpress.com/e/x", "no", "http 404")], "url string, status string, reason string")
    m = resolve.fold(raw, r, status)
    items = {x["key"]: x for x in m.items.collect()}
    assert set(items) == {"m3x8 shcs", "hfsb5 2020 370 ah45", "bed @v0", "bed @v2"}
    screw = items["m3x8 shcs"]
    assert screw["name"] == "M3x8 screw" and screw["category"] == "Hardware" and screw["id"] == "hardware.m3x8-screw" and screw["best_standard"] == "DIN"
    assert items["bed @v0"]["id"] == "panels.bed.v0" and items["hfsb5 2020 370 ah45"]["machining"] == "AH45"
    uses = {(u["key"], u["project"]): u for u in m.uses.collect()}
    use = uses[("m3x8 shcs", I24)]
    assert use["rows"] == [3, 5] and use["choice_group"] == f"{I24}#or3" and [(q["size"], q["qty"]) for q in use["qty"]] == [("All", "10"), ("250", "12")]
    sources = {(s["key"], s["url_key"]): s for s in m.sources.collect()}
    shop = sources[("m3x8 shcs", "https://shop.com/a")]
    assert shop["url"] == "https://www.shop.com/a" and shop["labels"] == ["Shop", "Other"] and shop["affiliate_urls"] == ["https://s.click.aliexpress.com/e/x"]
    assert shop["link_ok"] == "yes" and shop["link_note"].startswith("affiliate code is dead but") and len(shop["seen"]) == 2 and shop["vendor_id"] == "shop.com"
    assert sources[("hfsb5 2020 370 ah45", "https://misumi-ec.com/p")]["vendor_id"] == "misumi"
    assert [(x["label"], x["roles"]) for x in m.unlinked.collect()] == [("by phone", ["budget"])]
    assert [(x["note"], x["projects"]) for x in m.notes.collect()] == [("tight fit", [I24])]
    assert {x["check"]: x["missing"] for x in resolve.validate(raw, r, m).collect()} == dict.fromkeys(("urls", "names", "notes", "ids", "projects", "bad urls"), 0)
    assert {x["key"]: x["coverage"] for x in resolve.coverage_report(m).collect()}["m3x8 shcs"] == "all_live"
    assert ("bed @v0", I01) in {(x["key"], x["project"]) for x in resolve.unlinked_report(m).collect()}


def test_master_of_nothing(spark):
    m = resolve.fold(spark.createDataFrame([], resolve.RAW), resolve.rules(spark, {}))
    assert m.items.count() == m.sources.count() == m.uses.count() == 0


def lost(raw, r, m, manual=None):
    return {x["check"]: x["missing"] for x in resolve.validate(raw, r, m, manual).collect() if x["missing"]}


def test_each_check_can_fail(spark):
    raw, r = spark.createDataFrame(ROWS, resolve.RAW), resolve.rules(spark, SPEC)
    m = resolve.fold(raw, r)
    none = m.items.limit(0)
    assert lost(raw, r, resolve.Master(m.items, m.uses, m.sources.where("vendor_id <> 'misumi'"), m.unlinked, m.notes)) == {"urls": 1}
    assert lost(raw, r, resolve.Master(m.items.where("key <> 'm3x8 shcs'"), m.uses, m.sources, m.unlinked, m.notes)) == {"names": 2}
    assert lost(raw, r, resolve.Master(m.items, m.uses, m.sources, m.unlinked, m.notes.limit(0))) == {"notes": 1}
    assert lost(raw, r, resolve.Master(m.items.unionByName(m.items.where("key = 'bed @v0'")), m.uses, m.sources, m.unlinked, m.notes)) == {"ids": 1}
    assert lost(raw, r, resolve.Master(m.items, m.uses.unionByName(m.uses.limit(1).withColumn("project", F.lit("nowhere"))), m.sources, m.unlinked, m.notes)) == {"projects": 1}
    assert lost(raw, r, resolve.Master(m.items, m.uses, m.sources.unionByName(m.sources.limit(1).withColumn("url", F.lit("ftp://x"))), m.unlinked, m.notes)) == {"bad urls": 1}
    by_hand = spark.createDataFrame([("https://gone.com/1",), ("https://www.shop.com/a",), ("https://s.click.aliexpress.com/e/x",)], "url string")
    assert lost(raw, r, m, by_hand) == {"verdicts": 1} and none.count() == 0
    extra = spark.createDataFrame([(99, T24, 40, None, "OR", None, None, None, [], [cell("F", "?", "x", "https://lost.com/1")])], resolve.RAW)
    assert lost(raw.unionByName(extra), r, m) == {"urls": 1}


def numbered(bases):
    """One after the other, as a plain loop."""
    used, out = set(), []
    for b in bases:
        x, n = b, 2
        while x in used:
            x, n = f"{b}-{n}", n + 1
        used.add(x)
        out.append(x)
    return out


def test_ids_are_unique(spark):
    r = random.Random(3)
    for bases in (["a", "a-2", "a"], ["a", "a", "a-2"], ["x"] * 5, [r.choice(["a", "a-2", "a-2-2", "b", "b-3", "b-3-2", "c-1"]) for _ in range(60)]):
        df = spark.createDataFrame(list(enumerate(bases)), "seq long, base string")
        got = [x["id"] for x in windows.numbered_ids(df, "base", ["seq"]).orderBy("seq").collect()]
        assert got == numbered(bases) and len(set(got)) == len(got)
