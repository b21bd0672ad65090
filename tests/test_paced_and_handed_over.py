"""Pacing by an injected clock, bot checks handed to a stand-in session, link state by key, ids and url keys against plain versions."""

import random
import threading
import time

import pytest
from pyspark.sql import functions as F

from spindrel.functions import urls
from spindrel.operators import windows
from spindrel.sources import browser, fetch, handover
from spindrel.streaming import linkstream

LONG = "<html><title>Fine</title><p>" + "a product page with plenty to read " * 40


class Clock:
    def __init__(self):
        self.now, self.idle = 0.0, 0.0

    def __call__(self):
        return self.now

    def sleep(self, seconds):
        self.now, self.idle = self.now + seconds, self.idle + seconds


def walk(links, cost=0.2, code=200, **options):
    clock, asked = Clock(), []

    def ask(url, cookie):
        asked.append((clock.now, url.split("/")[0]))
        clock.now += cost
        return url, code, "body", None

    delay = {"slow.com": 3.0}
    out = list(fetch.paced(iter(links), ask, lambda host: delay.get(host, 1.5), workers=1, clock=clock, sleep=clock.sleep, **options))
    return clock, asked, out


def test_hosts_keep_their_delays_and_do_not_wait_for_each_other():
    links = [(f"{h}/{i}", h, None) for i in range(10) for h in ("slow.com", "a.com", "b.com", "c.com")]
    clock, asked, out = walk(links)
    assert sorted(x[0] for x in out) == sorted(x[0] for x in links)
    for host, delay in (("slow.com", 3.0), ("a.com", 1.5), ("b.com", 1.5)):
        times = [t for t, h in asked if h == host]
        assert all(b - a >= delay + 0.2 - 1e-9 for a, b in zip(times, times[1:]))
    # alone, the slow host takes nine waits of three seconds and ten requests; the others fit into its waits
    assert clock.now <= 9 * 3.0 + 10 * 0.2 + 3 * 0.2 * 10 and clock.idle < 27.0
    one, _, _ = walk([(f"a.com/{i}", "a.com", None) for i in range(10)])
    assert one.idle == pytest.approx(9 * 1.5)


def test_a_host_behind_the_window_is_met_in_time():
    links = [(f"a.com/{i}", "a.com", None) for i in range(5)] + [("b.com/0", "b.com", None)]
    _, asked, out = walk(links, window=2)
    assert len(out) == 6 and {h for _, h in asked} == {"a.com", "b.com"}
    assert walk([])[2] == []


def test_refusing_hosts_are_left_alone_at_once():
    clock, asked, out = walk([(f"a.com/{i}", "a.com", None) for i in range(9)], code=429, patience=3)
    assert len(asked) == 3 and [x[4] for x in out] == [None] * 3 + [fetch.REFUSES] * 6 and clock.idle == pytest.approx(3.0)


def test_requests_to_several_hosts_are_under_way_at_once():
    lock, now, most, by_host = threading.Lock(), [0], [0], {}

    def ask(url, cookie):
        host = url.split("/")[0]
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
            by_host[host] = by_host.get(host, 0) + 1
            assert by_host[host] == 1  # one at a time to each
        time.sleep(0.02)
        with lock:
            now[0] -= 1
            by_host[host] -= 1
        return url, 200, "b", None

    links = [(f"h{i % 5}.com/{i}", f"h{i % 5}.com", None) for i in range(40)]
    assert len(list(fetch.paced(iter(links), ask, lambda host: 0.0, workers=4))) == 40 and 1 < most[0] <= 4


class Session:
    """A person's browser: the check of shut.com goes away at the third look, that of hard.com never."""

    def __init__(self):
        self.opened, self.looks = [], 0

    def open(self, url):
        self.opened.append(url)
        self.url, self.looks = url, 0

    def page(self):
        self.looks += 1
        shut = "hard.com" in self.url or self.looks < 3
        return self.url, "<html>please solve this captcha</html>" if shut else LONG

    def cookies(self):
        return [{"name": "ok", "value": "1", "domain": ".shut.com"}, {"name": "other", "value": "2", "domain": "else.com"}]


def test_pause_solve_resume(spark, tmp_path):
    def get(url, cookie):
        return url, 200, ("<html>please solve this captcha</html>" if ("shut" in url or "hard" in url) and cookie != "ok=1" else LONG).encode(), None

    links = spark.createDataFrame([(f"https://{h}/{i}",) for h in ("shut.com", "hard.com", "fine.com") for i in range(5)], "url string")
    clock, session, said = Clock(), Session(), []
    solving = {"clock": clock, "sleep": clock.sleep, "say": said.append, "timeout": 20}
    options = {"every": 2, "patience": 3, "delay": 0.0, "jitter": 0}
    path = str(tmp_path / "out")
    got = {r["url"]: (r["status"], r["reason"]) for r in handover.check_with_person(links, path, session, get, solving=solving, **options).collect()}
    assert len(got) == 15 and all(got[f"https://{h}/{i}"][0] == "yes" for h in ("shut.com", "fine.com") for i in range(5))
    assert all(got[f"https://hard.com/{i}"][0] == "maybe" for i in range(5))
    assert len(said) == 1 + handover.ATTEMPTS and clock.now >= 3 * 20  # every page of hard.com had its time
    # taken up again nobody is asked, not even for the host that stayed shut
    again = Session()
    assert {r["url"]: (r["status"], r["reason"]) for r in handover.check_with_person(links, path, again, get, solving=solving, **options).collect()} == got and not again.opened


def test_queue_order_and_cookies(spark):
    rows = [(f"https://a.com/{i}", "maybe", fetch.WALL) for i in range(2)] + [("https://b.com/1", "maybe", fetch.WALL)] + [(f"https://b.com/x{i}", "maybe", fetch.REFUSES) for i in range(4)] + [("https://c.com/1", "maybe", fetch.REFUSES), ("https://d.com/", "yes", "http 200")]
    got = [tuple(r) for r in handover.queue(spark.createDataFrame(rows, "url string, status string, reason string")).collect()]
    assert got == [("b.com", 5, ["https://b.com/1"]), ("a.com", 2, ["https://a.com/0", "https://a.com/1"])]
    jar = [{"name": "a", "value": "1", "domain": ".shop.com"}, {"name": "b", "value": "2", "domain": "x.shop.com"}, {"name": "c", "value": "3", "domain": "hop.com"}]
    assert handover._header(jar, "shop.com") == "a=1" and handover._header(jar, "x.shop.com") == "a=1; b=2"


def test_chrome_session():
    class Driver:
        current_url, page_source = "u", "s"

        def get(self, url):
            self.asked = url

        def get_cookies(self):
            return [{"name": "a", "value": "b"}]

    session = browser.ChromeSession(Driver)
    session.open("https://a.com/")
    assert session.page() == ("u", "s") and session.cookies() == [{"name": "a", "value": "b"}] and session.driver.asked == "https://a.com/"


# ---- link state by key


def feed(spark, source, rows):
    spark.createDataFrame(rows, "url string, status string, at timestamp, n int").coalesce(1).write.mode("append").parquet(source)


def test_replayed_batches_and_stale_links(spark, tmp_path):
    from datetime import datetime

    source, path = str(tmp_path / "in"), str(tmp_path / "state")
    old, new = datetime(2020, 1, 1), datetime(2020, 1, 2)

    def run(checkpoint, **options):
        seen = str(tmp_path / "changes")
        stream = spark.readStream.schema("url string, status string, at timestamp, n int").parquet(source)
        sink = lambda w: w.foreachBatch(lambda df, epoch: df.write.mode("append").parquet(seen))
        linkstream.keep_state(stream, "url", "at", ["n"], path, str(tmp_path / checkpoint), sink=sink, **options).awaitTermination(120)
        return sorted(tuple(r) for r in linkstream.read_state(spark, path).select("url", "status", "n").collect())

    feed(spark, source, [("u", "yes", old, 1), ("u", "maybe", new, None), ("v", None, None, 3), ("v", "maybe", old, None)])
    first = run("ck", stale=1000)
    assert first == [("u", "yes", 1), ("v", "maybe", None)]
    feed(spark, source, [("u", "yes", old, 1), ("w", "no", old, 2), ("w", "no", old, 2)])  # what is there already changes nothing
    assert run("ck", stale=1000) == [*first, ("w", "no", 2)]
    feed(spark, source, [("v", "maybe", old, None)])
    assert run("ck", stale=1000) == [*first, ("w", "no", 2)]
    said = sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "changes")).select("url", "status").collect())
    assert said.count(("u", "yes")) == 1 and said.count(("w", "no")) == 1 and said.count(("u", "stale")) == 1 and ("v", "stale") not in said
    assert run("other") == [*first, ("w", "no", 2)]
    with pytest.raises(ValueError, match="moved on"):
        run("ck")


# ---- ids and urls


def plain_ids(bases):
    used, out = set(), []
    for b in bases:
        i, n = b, 2
        while i in used:
            i, n = f"{b}-{n}", n + 1
        used.add(i)
        out.append(i)
    return out


def test_numbered_ids_by_plain_fold(spark):
    r = random.Random(11)
    rows, wanted = [], []
    for case in range(60):
        stems = [f"c{case}x", f"c{case}x-2", f"c{case}x-3", f"c{case}x-2-2", f"c{case}x-2-3", f"c{case}x-12", f"c{case}x-02", f"c{case}y"]
        bases = [r.choice(stems[: r.randrange(1, 9)]) for _ in range(r.randrange(1, 30))]
        rows += [(case * 100 + i, b) for i, b in enumerate(bases)]
        wanted += plain_ids(bases)
    df = spark.createDataFrame(rows, "seq int, base string").repartition(4)
    got = [x["id"] for x in windows.numbered_ids(df, "base", ["seq"]).orderBy("seq").collect()]
    assert got == wanted
    assert windows.numbered_ids(df.limit(0), "base", ["seq"]).collect() == []


def test_numbered_ids_of_many_rows(spark):
    bases = [f"a{'' if i % 3 == 0 else f'-{i % 3 + 1}'}" for i in range(6000)]
    got = [x["id"] for x in windows.numbered_ids(spark.createDataFrame(list(enumerate(bases)), "seq int, base string"), "base", ["seq"]).orderBy("seq").collect()]
    assert got == plain_ids(bases)


def test_flat_url_keys_are_those_of_the_expressions(spark):
    wrap = lambda u: "https://www.google.com/url?q=" + u.replace(":", "%3A").replace("/", "%2F").replace("?", "%3F").replace("&", "%26").replace("%2520", "%252520")
    deep = "https://shop.example.com/A/?b=2&a=1&utm_source=x#f"
    given = [None, "", "  ", deep, wrap(deep), wrap(wrap(deep)), wrap(wrap(wrap(wrap(wrap(deep))))), "shop.com/x", "HTTP://WWW.Shop.com:80/p//?q=a+b&z=%7E*", "https://www.amazon.de/x/dp/B00TEST123/ref=1", "https://amzn.to/3abc",
             "https://www.aliexpress.com/item/Name-of-it/1005001234567.html?spm=1", "https://s.click.aliexpress.com/e/_abc", "https://www.mcmaster.com/91290a115/", "https://a.com/?tag=me-20", "http://[bad", "https://google.com/url?url=&q=", " https://a.com/ "]
    df = spark.createDataFrame([(i, u, "Affiliate link" if i % 5 == 0 else None) for i, u in enumerate(given)], "i int, url string, label string")
    flat = urls.identified(df, "url", key="k", canonical="c", affiliate="a", label="label")
    own = df.select("i", urls.url_key(F.col("url")).alias("k"), urls.canonical_url(F.col("url")).alias("c"), urls.is_affiliate(F.trim("url"), F.col("label")).alias("a"))
    assert sorted(map(tuple, flat.select("i", "k", "c", "a").collect())) == sorted(map(tuple, own.collect()))
    # a condition on the result is not written out through the steps
    plan = flat.where("k is not null and c <> ''")._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 60_000 and flat.where("k is not null").join(df.select(F.col("url").alias("k")), "k").count() >= 0
    assert urls.identified(df, "url", key="url").columns == ["i", "label", "url"]
