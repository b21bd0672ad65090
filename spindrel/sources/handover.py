"""Bot checks handed over to a person: a queue of walled hosts, a session in which they are
solved one after the other, and the links behind them asked again with its cookies.

A session has open(url), page() -> (url, body) and cookies() -> [{"name", "value", "domain"}];
browser.ChromeSession is one. What was solved is written down, so a stopped run asks nobody twice.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import pages, urls
from .fetch import REFUSES, WALL, Getter, check, exists, http_get

# ---- fixed values: seconds that a person has for a check, between looks at the page, and pages of a host that are tried
SOLVE, LOOK, ATTEMPTS = 120, 2.5, 3
JAR = "domain string, header string"


def queue(state: DataFrame) -> DataFrame:
    """(host, n, urls) of hosts that showed a bot check: how many links wait behind it, and the
    first ATTEMPTS that showed one. Hosts with most links come first, as a person's time is short."""
    waiting = state.where(F.col("reason").isin(WALL, REFUSES) & (F.col("status") == "maybe")).withColumn("host", F.coalesce(urls.host_of(F.col("url")), F.lit("")))
    shown = F.when(F.col("reason") == WALL, F.col("url"))
    out = waiting.groupBy("host").agg(F.count("*").alias("n"), F.array_sort(F.collect_set(shown)).alias("urls")).where(F.size("urls") > 0)
    return out.select("host", "n", F.slice("urls", 1, ATTEMPTS).alias("urls")).orderBy(F.desc("n"), "host")


def _walled(spark: SparkSession, page: tuple[str, str]) -> bool:
    return bool(spark.createDataFrame([page], "url string, body string").select(pages.is_wall(F.col("url"), F.col("body")).alias("w")).first()["w"])


def _header(cookies: list[dict], host: str) -> str:
    """The cookies that a browser sends to a host."""
    return "; ".join(f"{c['name']}={c['value']}" for c in cookies if f".{host}".endswith("." + c.get("domain", "").lstrip(".").removeprefix("www.")))


def solve(todo: DataFrame, session, path: str, *, timeout: float = SOLVE, look: float = LOOK, clock=time.monotonic, sleep=time.sleep, say=print) -> DataFrame:
    """(domain, header) of the hosts of queue() whose check went away while the session's page
    was watched. Each answer is kept under `path`; hosts that have one are not opened again. A
    host without answer after `timeout` seconds has a null header and stays as it was."""
    spark = todo.sparkSession
    done = spark.read.schema(JAR).parquet(path) if exists(spark, path) else spark.createDataFrame([], JAR)
    for r in todo.join(done.select(F.col("domain").alias("host")), "host", "left_anti").orderBy(F.desc("n"), "host").toLocalIterator():
        header = None
        for url in r["urls"]:
            session.open(url)
            if _walled(spark, session.page()):
                say(f"{r['host']} shows a bot check in the browser; {r['n']} links wait for it")
            until = clock() + timeout
            while (shut := _walled(spark, session.page())) and clock() < until:
                sleep(look)
            if not shut:
                header = _header(session.cookies(), r["host"])
                break
        spark.createDataFrame([(r["host"], header)], JAR).coalesce(1).write.mode("append").parquet(path)
    return spark.read.schema(JAR).parquet(path) if exists(spark, path) else done


def check_with_person(links: DataFrame, path: str, session, get: Getter = http_get, *, solving: dict | None = None, cookies: DataFrame | None = None, **options) -> DataFrame:
    """fetch.check() of `links`; then the hosts that showed a bot check go to `session`, and
    their open links are asked again with the cookies of those that were solved. Everything is
    kept under `path`, and a run that was stopped goes on from there."""
    spark = links.sparkSession
    state = check(links, path, get, cookies=cookies, **options)
    solved = solve(queue(state), session, f"{path}/solved", **(solving or {})).where("header is not null")
    open_ = state.where(F.col("reason").isin(WALL, REFUSES) & (F.col("status") == "maybe")).withColumn("domain", F.coalesce(urls.host_of(F.col("url")), F.lit("")))
    open_ = open_.join(solved, "domain", "left_semi").select("url")
    if open_.isEmpty():
        return state
    jar = solved if cookies is None else cookies.join(solved, "domain", "left_anti").unionByName(solved)
    again = check(open_, f"{path}/resumed", get, cookies=jar.where("header <> ''"), **options)
    return state.join(again.select("url"), "url", "left_anti").unionByName(again)
