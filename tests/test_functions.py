import pytest
from pyspark.sql import functions as F

from spindrel.functions import pages, similarity, text, urls
from spindrel.operators import joins, linkstate, windows


def values(spark, column, cells):
    rows = [(i, c) for i, c in enumerate(cells)]
    return [r[0] for r in spark.createDataFrame(rows, "i int, c string").orderBy("i").select(column(F.col("c"))).collect()]


@pytest.mark.parametrize(
    ("f", "cells", "want"),
    [
        (text.clean_text, [None, " a b ", "“x” – y×2", ",;: ", "a\n\tb,", "ﬁ³"], [None, "a b", "\"x\" - yx2", None, "a b", "fi3"]),
        (text.name_key, ["M3 x 8", "3 x 7 x 0.5", "10.0", "10.05", "A&B", "pack of 5 pcs", "!!", None], ["m3x8", "3x7x0.5", "10", "10.05", "a and b", "of 5", None, None]),
        (text.clean_size, ["250³", "True", "False", "All sizes", None], ["250", "All", None, "All", None]),
        (text.qty_text, ["3", "3.0", "2.5", "2022-02-04 00:00:00", "as needed", None], ["3", "3", "2.5", "2-4", "as needed", None]),
        (text.qty_number, ["3", "3.0", "2.5", "as needed", None], [3.0, 3.0, 2.5, None, None]),
        (text.is_affiliate_label, ["[Affiliate Link]", "[Afilliate Link]", "link", None], [True, True, False, False]),
        (text.slug, ["Crème Brûlée 3!", "***", None], ["creme-brulee-3", "item", "item"]),
        (text.is_drop_row, ["OR", "As an Amazon associate", "bolt", None], [True, True, False, True]),
        (urls.host_of, ["https://www.A.com:80/x", "http://a_b.c/?q|", "nothing"], ["a.com", "a_b.c", ""]),
    ],
)
def test_text(spark, f, cells, want):
    assert values(spark, f, cells) == want


@pytest.mark.parametrize(
    ("url", "want"),
    [
        ("https://www.google.com/url?q=https%3A%2F%2Fa.com%2Fx%3Fb%3D1&sa=D", "https://a.com/x?b=1"),
        ("http://www.aliexpress.com/item/Some-Name/4000123456.html?spm=1", "https://www.aliexpress.com/item/4000123456.html"),
        ("https://amazon.de/gp/product/b00abcd123?tag=x", "https://www.amazon.de/dp/B00ABCD123"),
        ("https://www.mcmaster.com/91290a115", "https://www.mcmaster.com/91290A115/"),
        ("HTTP://Shop.com:8080/a/?utm_source=x&b=2&a=1&e=#top", "https://shop.com/a?a=1&b=2"),
        ("shop.com", "https://shop.com/"),
        ("https://s.com/p?x=~a*b&y=%zz", "https://s.com/p?x=~a%2Ab&y=%25zz"),
        ("", None),
    ],
)
def test_canonical_url(spark, url, want):
    assert values(spark, urls.canonical_url, [url]) == [want]


def test_url_key_is_idempotent(spark):
    cells = ["http://www.a.com/X?b=2&a=1", "https://a.com/x?a=1&b=2#f"]
    keys = values(spark, urls.url_key, cells)
    assert keys[0] == keys[1] and values(spark, urls.url_key, keys) == keys


LONG = "word " * 200
CASES = [
    ("https://x.com/", 404, "", ("no", "http 404")), ("https://x.com/", 503, LONG, ("maybe", "http 503")), ("https://x.com/", 200, "this domain is for sale " + LONG, ("no", "domain is parked or for sale")),
    ("https://x.com/punish", 200, LONG, ("maybe", "bot check or login wall")), ("https://x.com/", 200, LONG + "captcha", ("maybe", "bot check or login wall")),
    ("https://aliexpress.com/", 200, LONG, ("no", "redirected off the product page")), ("https://aliexpress.com/item/1", 200, '<meta property="og:title" content="Bolt">', ("yes", "listing has a title")),
    ("https://aliexpress.com/item/1", 200, '<meta property="og:title" content="">', ("no", "listing has no title (removed)")), ("https://aliexpress.com/item/1", 200, LONG, ("maybe", "no og:title tag - page format may have changed")),
    ("https://amazon.com/x", 200, "dogs of amazon", ("no", "amazon 404 page")), ("https://amazon.com/x", 200, "add to cart", ("yes", "product page")),
    ("https://amazon.com/x", 200, "add to cart currently unavailable", ("yes", "product page - currently unavailable")), ("https://amazon.com/x", 200, "hm", ("maybe", "not recognisably a product page")),
    ("https://digikey.com/x", 200, "no longer available", ("no", "distributor says the part is no longer available")), ("https://mouser.com/x", 200, "part status: obsolete", ("yes", "product page - part status is obsolete/discontinued")),
    ("https://x.com/", 200, LONG + "please sign in", ("maybe", "bot check or login wall")), ("https://x.com/", 200, LONG + "this item was removed", ("no", "page says the listing is gone")),
    ("https://x.com/", 200, "<title>Page not found</title>" + LONG, ("no", "page says the listing is gone")), ("https://x.com/", 301, LONG, ("maybe", "http 301")), ("https://x.com/", 200, "short", ("maybe", "response too short to judge")),
    ("https://x.com/", 200, LONG, ("yes", "http 200")), ("https://x.com/", None, LONG, ("maybe", "no http code")),
]


def test_verdicts(spark):
    df = spark.createDataFrame([(i, u, c, b) for i, (u, c, b, _) in enumerate(CASES)], "i int, url string, code int, body string")
    got = df.orderBy("i").select(pages.judge(F.col("url"), F.col("url"), F.col("code"), F.col("body")).alias("j")).collect()
    assert [tuple(r["j"]) for r in got] == [c[3] for c in CASES]


def test_part_number(spark):
    got = values(spark, text.part_number, ["Misumi hfsb5-2020-370-ah45-BH325", "HFSB5-2020-370", "none"])
    assert [g and tuple(g) for g in got] == [("HFSB5-2020-370-AH45-BH325", "HFSB5-2020-370", "AH45-BH325"), ("HFSB5-2020-370", "HFSB5-2020-370", None), None]


def test_or_chains(spark):
    names = ["A", "OR", "B", "OR", "C", "D", "OR", "OR", "E"]
    df = spark.createDataFrame([("s", i + 1, n) for i, n in enumerate(names)], "sheet string, row int, component string")
    got = windows.or_groups(df, "sheet", ["row"], F.col("component") == "OR", "row").orderBy("row").collect()
    assert [r["choice_group"] for r in got][:6] == [1, None, 1, None, 1, 6]


def test_fold_tags(spark):
    rows = [(1, 1, "a", False, "u"), (1, 2, "a", True, "t"), (1, 3, "b", True, "v"), (1, 4, "b", True, "w"), (1, 5, "c", False, ""), (1, 6, "c", True, "x"), (1, 7, "c", True, "y")]
    df = spark.createDataFrame(rows, "r int, col int, slot string, tag boolean, url string")
    got = windows.fold_tags(df, ["r"], ["col"], "slot", F.col("tag"), "url").orderBy("col").collect()
    assert [r["head"] for r in got] == [1, 1, 3, 3, 5, 6, 6]


def test_state_merge_is_idempotent_and_order_free(spark):
    rows = [("u", "yes", 1), ("u", "maybe", 2), ("v", "no", 1), ("v", "yes", 2), ("w", "maybe", 1), ("w", "maybe", 2)]
    df = spark.createDataFrame(rows, "url string, status string, at int")
    once = linkstate.merge(df, "url", "at", [])
    again = linkstate.merge(once.unionByName(df).unionByName(once), "url", "at", [])
    want = [("u", "yes", 1), ("v", "yes", 2), ("w", "maybe", 2)]
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, again.collect())) == want


def test_state_stream(spark, tmp_path):
    from spindrel.streaming.linkstream import keep_state, read_state

    source, state = tmp_path / "in", str(tmp_path / "state")
    schema = "url string, status string, at int"
    assert read_state(spark, state) is None

    def run(rows, checkpoint):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(source))
        keep_state(spark.readStream.schema(schema).parquet(str(source)), "url", "at", [], state, str(tmp_path / checkpoint)).awaitTermination(60)
        return sorted(map(tuple, read_state(spark, state).collect()))

    assert run([("u", "yes", 1), ("v", "maybe", 1)], "ck") == [("u", "yes", 1), ("v", "maybe", 1)]
    assert run([("u", "maybe", 2), ("v", "no", 2)], "ck") == [("u", "yes", 1), ("v", "no", 2)]
    # a new checkpoint reads everything once more and goes on from the state that is there
    assert run([("v", "yes", 3), ("w", "no", 3)], "other") == [("u", "yes", 1), ("v", "yes", 3), ("w", "no", 3)]
    versions = [p.name.split("-")[0] for p in (tmp_path / "state").iterdir()]
    assert max(versions.count(v) for v in versions) <= 2


def test_worklist(spark):
    due = spark.createDataFrame([("https://b.com/1",), ("https://a.com/2",), ("https://a.com/1",), ("https://shop.a.com/1",)], "url string")
    urls_ = lambda **k: [r["url"] for r in linkstate.worklist(due, "url", **k).collect()]
    assert urls_() == ["https://a.com/1", "https://a.com/2", "https://b.com/1", "https://shop.a.com/1"]
    assert urls_(only="A.com", exclude="shop", limit=1) == ["https://a.com/1"]


def test_fixed_numbers(spark):
    got = spark.createDataFrame([(0.125, 2), (2.5, 0), (1234.5678, 3)], "x double, n int").select("x", *(text.fixed(F.col("x"), n).alias(f"f{n}") for n in (0, 2, 3))).collect()
    assert (got[0]["f2"], got[1]["f0"], got[2]["f3"]) == ("0.12", "2", "1234.568")


def test_near_names(spark):
    items = spark.createDataFrame([(1, 1, "m3x8 shcs bolt", "a"), (2, 2, "m3x8 bolts shcs", "b"), (3, 3, "m3x8 bhcs bolt", "c"), (4, 4, "m3x10 shcs bolt", "d")], "seq int, id int, key string, base_key string")
    assert [(r["id_a"], r["id_b"]) for r in joins.near_names(items, threshold=0.6).collect()] == [(1, 2)]
    done = spark.createDataFrame([("b", "a")], "a string, b string")
    assert joins.near_names(items, done, threshold=0.6).count() == 0


def test_token_diff(spark):
    got = spark.createDataFrame([("a b c", "a x c")], "o string, n string").select(similarity.token_diff("o", "n").alias("d")).first()["d"]
    assert [(r["op"], r["text"]) for r in got] == [("keep", "a "), ("del", "b "), ("add", "x "), ("keep", "c")]


def test_link_queries_unwrap_nested_redirects(spark, tmp_path):
    from spindrel.plans import links

    wrapped = ["https://shop.example.com/a", "https://www.google.com/url?q=https%3A%2F%2Fwww.google.com%2Furl%3Fq%3Dhttps%253A%252F%252Fshop.example.com%252Fa"]
    rows = [(2 * i, u, "<p>x</p>") for i, u in enumerate(wrapped)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    assert [(r["url_key"], r["n_sightings"]) for r in links.url_key_dedup(spark, str(tmp_path)).collect()] == [("https://shop.example.com/a", 4)]
    assert [tuple(r) for r in links.url_targets(spark, str(tmp_path)).select("url_key", "items").collect()] == [("https://shop.example.com/a", "0,2")]
    assert sum(r["n_links"] for r in links.link_coverage_by_host(spark, str(tmp_path)).collect()) == 1
