import json
import pickle
import shutil
import time

import pytest

from spindrel.functions import dims
from spindrel.sources import browser, fetch

LONG = "<html><title>Fine</title><p>" + "a product page with plenty to read " * 40


def getter(log):
    """A web of its own; every request leaves a line in `log`."""

    def get(url, cookie):
        with open(log) as f:
            before = f.read()
        with open(log, "a") as f:
            f.write(f"{time.time()}\t{url}\t{cookie}\n")
        path = url.rsplit("/", 1)[1]
        if path == "gone" or (path == "flaky" and "\t" + url + "\t" not in before):
            return url, 404, b"", None
        if path == "down":
            raise ConnectionRefusedError
        if path == "slow":
            raise TimeoutError
        if path == "odd":
            raise ValueError
        if path.startswith("no"):
            return url, 429, b"", None
        return url + ("/" if path == "moved" else ""), 200, LONG.encode("latin-1"), "no-such-charset"

    return get


def test_check(spark, tmp_path):
    log = tmp_path / "log"
    log.touch()
    names = ("fine", "gone", "flaky", "down", "slow", "odd", "moved", "fine")
    links = [(f"https://a.com/{n}",) for n in names] + [(f"https://wall.com/no{i}",) for i in range(7)] + [(f"https://{dims.SKIP_HOSTS[0]}/x",), (f"https://{dims.BLOCKED_HOSTS[0]}/x",), (None,), ("",)]
    jar = spark.createDataFrame([("a.com", "k=1"), ("", "any=1")], "domain string, header string")
    got = {r["url"]: r for r in fetch.check(spark.createDataFrame(links, "url string"), str(tmp_path / "out"), getter(str(log)), cookies=jar, delay=0.05, jitter=0, patience=5).collect()}
    assert len(got) == 16
    said = {u.rsplit("/", 1)[1]: (r["status"], r["reason"], r["http"]) for u, r in got.items() if "a.com" in u}
    assert said["fine"] == ("yes", "http 200", 200) and said["gone"] == ("no", "http 404", 404) and said["flaky"] == ("yes", "http 200 (first attempt looked dead)", 200)
    assert said["down"][:2] == ("maybe", "connection failed") and said["slow"][:2] == ("maybe", "timeout") and said["odd"][:2] == ("maybe", "error: ValueError")
    assert got["https://a.com/moved"]["final_url"] == "https://a.com/moved/" and got["https://a.com/fine"]["final_url"] is None
    assert sorted(r["reason"] for u, r in got.items() if "wall" in u) == ["host refuses automated requests"] * 2 + ["http 429"] * 5
    assert all(got[f"https://{h[0]}/x"]["status"] == "maybe" for h in (dims.SKIP_HOSTS, dims.BLOCKED_HOSTS))
    lines = [x.split("\t") for x in log.read_text().splitlines()]
    assert {c for _, u, c in lines if "a.com" in u} == {"k=1"} and {c for _, u, c in lines if "wall" in u} == {"any=1"}
    times = sorted(float(t) for t, u, _ in lines if "wall" in u)
    assert all(b - a >= 0.045 for a, b in zip(times, times[1:]))
    assert not any(h in u for _, u, _ in lines for h in (dims.SKIP_HOSTS[0], dims.BLOCKED_HOSTS[0]))


def test_rounds_are_saved_and_taken_up_again(spark, tmp_path):
    log, path = tmp_path / "log", str(tmp_path / "out")
    log.touch()
    links = spark.createDataFrame([(f"https://a.com/fine{i}",) for i in range(7)] + [(f"https://no.com/no{i}",) for i in range(7)], "url string")
    options = {"every": 3, "delay": 0.0, "jitter": 0, "patience": 2}
    first = {r["url"]: r["reason"] for r in fetch.check(links, path, getter(str(log)), **options).collect()}
    assert len(first) == 14 and sum(r == "http 429" for r in first.values()) == 2 and sum(r == fetch.REFUSES for r in first.values()) == 5
    asked = log.read_text().splitlines()
    assert len(asked) == 9
    # the second round is lost: only its links are asked again
    shutil.rmtree(f"{path}/first/round=1")
    assert {r["url"]: r["reason"] for r in fetch.check(links, path, getter(str(log)), **options).collect()} == first
    again = [x.split("\t")[1] for x in log.read_text().splitlines()[len(asked):]]
    assert sorted(again) == [f"https://a.com/fine{i}" for i in (3, 4, 5)]


def test_hosts_that_show_bot_checks_are_left_alone(spark, tmp_path):
    def get(url, cookie):
        return url, 200, b"<html>please solve this captcha</html>", None

    links = spark.createDataFrame([(f"https://wall.com/{i}",) for i in range(6)], "url string")
    got = [r["reason"] for r in fetch.check(links, str(tmp_path / "out"), get, every=2, patience=3, delay=0.0, jitter=0).collect()]
    assert sorted(got) == [fetch.WALL] * 4 + [fetch.REFUSES] * 2


def test_nothing_to_check(spark, tmp_path):
    assert fetch.check(spark.createDataFrame([], "url string"), str(tmp_path / "out"), getter("/nowhere")).count() == 0


def test_report_order(spark):
    rows = [("https://b.com/1", "yes"), ("https://a.com/1", "no"), ("https://a.com/2", "maybe"), ("https://0.com/1", "no")]
    got = fetch.status_report(spark.createDataFrame(rows, "url string, status string")).collect()
    assert [r["url"] for r in got] == ["https://0.com/1", "https://a.com/1", "https://a.com/2", "https://b.com/1"]


class Chrome:
    """A browser whose title appears late."""

    def __init__(self):
        self.looks = 0

    def get(self, url):
        self.current_url, self.page_source = url + "#done", "<html>" + LONG

    @property
    def title(self):
        self.looks += 1
        return "Thing" if self.looks > 2 else ""

    def get_log(self, kind):
        reply = lambda t, c: {"message": json.dumps({"message": {"method": "Network.responseReceived", "params": {"type": t, "response": {"status": c}}}})}
        return [reply("Document", 301), reply("Document", 200), reply("Image", 404), {"message": json.dumps({"message": {"method": "Other", "params": {}}})}]


def test_browser_getter(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(browser, "LOOK", 0.01)
    get = browser.BrowserGetter(Chrome, settle=1)
    assert get("https://a.com/", None)[:2] == ("https://a.com/#done", 200) and pickle.loads(pickle.dumps(browser.BrowserGetter(settle=2))).settle == 2
    got = fetch.check(spark.createDataFrame([("https://a.com/x",)], "url string"), str(tmp_path / "out"), browser.BrowserGetter(Chrome, settle=1), delay=0.0).first()
    assert (got["status"], got["http"], got["final_url"]) == ("yes", 200, "https://a.com/x#done")
    with pytest.raises(RuntimeError, match="selenium"):
        browser.BrowserGetter()("https://a.com/", None)
