"""Pages over HTTP: one request at a time per host, spaced in time, then judged and confirmed.

The getter is a parameter: `get(url, cookie)` returns (final_url, code, body bytes, charset or
None), or raises. All urls of a host are in one task, as the host sets the pace, and in turns
with those of the task's other hosts: a heap of hosts by the time they may next be asked
decides whose turn it is, several requests to different hosts are under way at once, and the task
is idle only while every host it knows of has to wait. Replies leave it a few at a time.
"""

from __future__ import annotations

import heapq
import random
import time
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from urllib.error import HTTPError
from urllib.request import Request, urlopen

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import dims, pages, urls
from ..operators import linkstate

# ---- fixed values: seconds between requests to a host, at most added to a wait, of a request, and bytes of a body
DELAY, SLOW_DELAY, JITTER, TIMEOUT, BODY = 1.5, 3.0, 0.4, 25, 400_000
#: Links of a host that are asked and saved before the next ones.
EVERY = 20
#: Replies that leave a task together (bodies may be BODY bytes each).
BATCH = 16
#: Requests of a task under way at once, and its links that wait in turn.
WORKERS, WINDOW = 6, 1024
#: Refusals in a row after which a host is left alone.
PATIENCE = 5
REFUSES, WALL = "host refuses automated requests", "bot check or login wall"
REPLY = "url string, final_url string, code int, body string, error string, checked_at timestamp"
Getter = Callable[[str, str | None], tuple[str, int, bytes, str | None]]


def http_get(url: str, cookie: str | None) -> tuple[str, int, bytes, str | None]:
    request = Request(url, headers={"User-Agent": "Mozilla/5.0"} | ({"Cookie": cookie} if cookie else {}))
    try:
        reply = urlopen(request, timeout=TIMEOUT)
    except HTTPError as e:  # a code is an answer
        reply = e
    with reply:
        return reply.geturl(), reply.status, reply.read(BODY), reply.headers.get_content_charset()


def _error(e: Exception) -> str:
    name = type(getattr(e, "reason", None) if isinstance(getattr(e, "reason", None), Exception) else e).__name__
    if "SSL" in name:
        return f"ssl error: {name}"
    if "Timeout" in name or name == "timeout":
        return "timeout"
    return "connection failed" if isinstance(e, OSError) else f"error: {name}"


def _decoded(body: bytes, charset: str | None) -> str:
    try:
        return body[:BODY].decode(charset or "utf-8", "replace")
    except LookupError:
        return body[:BODY].decode("utf-8", "replace")


def asked(get: Getter, url: str, cookie: str | None) -> tuple:
    """(final_url, code, body, error) of a url."""
    try:
        final, code, raw, charset = get(url, cookie)
        return final, code, _decoded(raw, charset), None
    except Exception as e:  # noqa: BLE001 - any failure is a result of its url
        return None, None, None, _error(e)


def paced(links: Iterator[tuple], ask: Callable, delay: Callable[[str], float], *, patience: int = PATIENCE, workers: int = WORKERS, window: int = WINDOW, clock=time.monotonic, sleep=time.sleep) -> Iterator[tuple]:
    """(url, *ask(url, cookie)) of (url, host, cookie) links, as answers come. Between the end of
    a request to a host and the next one to it lie delay(host) seconds; other hosts are asked
    meanwhile, `workers` at most at once. After `patience` refusals in a row a host is left alone."""
    ready: list[tuple[float, int, str]] = []  # a heap of (time allowed, order of arrival, host)
    todo: dict[str, deque] = {}  # links of hosts that are waiting or under way
    state: dict[str, tuple[float, int]] = {}  # time allowed and refusals in a row
    under_way: dict = {}
    waiting = arrived = 0
    more = True

    def done(host: str, url: str, answer: tuple):
        nonlocal arrived
        refused = state.get(host, (0.0, 0))[1] + 1 if answer[1] in (403, 429) else 0
        state[host] = (clock() + delay(host), refused)
        if todo[host]:
            arrived += 1
            heapq.heappush(ready, (state[host][0], arrived, host))
        else:
            del todo[host]
        return (url, *answer)

    with ThreadPoolExecutor(workers) as pool:
        while True:
            while more and waiting < window:
                link = next(links, None)
                if link is None:
                    more = False
                    break
                url, host, cookie = link
                waiting += 1
                if host in todo:
                    todo[host].append((url, cookie))
                else:
                    todo[host] = deque([(url, cookie)])
                    arrived += 1
                    heapq.heappush(ready, (state.get(host, (float("-inf"), 0))[0], arrived, host))
            if ready and len(under_way) < workers and (ready[0][0] <= clock() or state.get(ready[0][2], (0.0, 0))[1] >= patience):
                host = heapq.heappop(ready)[2]
                url, cookie = todo[host].popleft()
                waiting -= 1
                if state.get(host, (0.0, 0))[1] >= patience:
                    yield url, None, None, None, REFUSES
                    if todo[host]:
                        arrived += 1
                        heapq.heappush(ready, (float("-inf"), arrived, host))
                    else:
                        del todo[host]
                elif workers == 1:
                    yield done(host, url, ask(url, cookie))
                else:
                    under_way[pool.submit(ask, url, cookie)] = host, url
            elif under_way:
                pause = max(0.0, ready[0][0] - clock()) if ready and len(under_way) < workers else None
                for f in wait(under_way, pause, FIRST_COMPLETED).done:
                    yield done(*under_way.pop(f), f.result())
            elif ready:
                sleep(ready[0][0] - clock())
            else:
                return


def _requests(get: Getter, delay: float, slow: dict[str, float], jitter: float, patience: int, workers: int):
    columns = [c.split()[0] for c in REPLY.split(", ")]

    def run(frames):
        links = (row for frame in frames for row in zip(frame["url"], frame["host"], frame["cookie"], strict=True))
        held = []
        wait_of = lambda host: slow.get(host, delay) + random.uniform(0, jitter)
        for answer in paced(links, lambda url, cookie: asked(get, url, cookie), wait_of, patience=patience, workers=workers):
            held.append((*answer, pd.Timestamp.now("UTC")))
            if len(held) == BATCH:
                yield pd.DataFrame(held, columns=columns).astype({"code": "Int32"})
                held = []
        if held:
            yield pd.DataFrame(held, columns=columns).astype({"code": "Int32"})

    return run


def cookie_of(links: DataFrame, cookies: DataFrame | None) -> DataFrame:
    """Adds cookie: the header (domain, header) of the longest domain that ends the host; the
    empty domain serves all others."""
    if cookies is None:
        return links.withColumn("cookie", F.lit(None).cast("string"))
    parts = F.split("host", r"\.")
    each = F.explode(F.concat(F.array(F.lit("")), F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))))
    jar = cookies.groupBy("domain").agg(F.max("header").alias("header"))
    found = links.select("host").distinct().withColumn("domain", each).join(jar, "domain").groupBy("host").agg(F.max_by("header", F.length("domain")).alias("cookie"))
    return links.join(found, "host", "left")


def fetch(links: DataFrame, get: Getter = http_get, *, cookies: DataFrame | None = None, delay: float = DELAY, slow: dict[str, float] | None = None, jitter: float = JITTER, patience: int = PATIENCE, workers: int | None = None) -> DataFrame:
    """REPLY of every distinct url of `links`. `slow` has the delay of hosts that need another
    one (by default SLOW_DELAY for the known ones). A getter may say how many requests it can
    have under way (`workers`). A failed request has its error and no
    code. Each evaluation asks again: write the result before it is used twice."""
    hosts = cookie_of(links.select("url").where("url <> ''").distinct().withColumn("host", F.coalesce(urls.host_of(F.col("url")), F.lit(""))), cookies)
    n = int(links.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    turn = F.row_number().over(Window.partitionBy("host").orderBy("url"))  # a task meets the first link of every host first
    placed = hosts.repartition(n, "host").withColumn("_turn", turn).sortWithinPartitions("_turn", "host").select("url", "host", "cookie")
    slow = dict.fromkeys(dims.SLOW_HOSTS, SLOW_DELAY) if slow is None else slow
    return placed.mapInPandas(_requests(get, delay, slow, jitter, patience, workers or getattr(get, "workers", WORKERS)), REPLY)


def _verdicts(replies: DataFrame) -> DataFrame:
    j = pages.judge(F.col("url"), F.col("final_url"), F.col("code"), F.col("body"))
    judged = replies.withColumn("j", F.when(F.col("error").isNull(), j))
    moved = F.when(F.col("final_url") != F.col("url"), F.col("final_url"))
    return judged.select("url", F.coalesce("j.verdict", F.lit("maybe")).alias("status"), F.coalesce("j.reason", "error").alias("reason"), F.col("code").alias("http"), moved.alias("final_url"), "checked_at")


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def check(links: DataFrame, path: str, get: Getter = http_get, *, every: int = EVERY, patience: int = PATIENCE, **options) -> DataFrame:
    """(url, status, reason, http, final_url, checked_at) of `links` (url). Hosts that are not
    to be asked are `maybe` at once. A `no` needs a second one; otherwise the second answer
    stands with a remark.

    Links are asked in rounds of `every` for each host, and the answers of a round are written
    under `path` before the next one: a check that was stopped goes on from there if it is
    called with the same path. A host that showed `patience` bot checks, or refused that many
    requests in a row, is not asked in the rounds that follow."""
    spark = links.sparkSession
    if not exists(spark, f"{path}/todo/_SUCCESS"):
        todo = links.select("url").where("url <> ''").distinct().withColumn("reason", pages.unfetched(F.col("url"))).withColumn("host", F.coalesce(urls.host_of(F.col("url")), F.lit("")))
        n = F.row_number().over(Window.partitionBy("host", F.col("reason").isNull()).orderBy("url"))
        todo.withColumn("round", F.floor((n - 1) / every).cast("int")).write.mode("overwrite").parquet(f"{path}/todo")
    todo = spark.read.parquet(f"{path}/todo")
    open_ = todo.where("reason is null")
    rounds = (open_.agg(F.max("round")).first()[0] or 0) + 1
    null = lambda c, t: F.lit(None).cast(t).alias(c)
    for i in range(rounds):
        first, second = (f"{path}/{name}/round={i}" for name in ("first", "second"))
        if not exists(spark, f"{first}/_SUCCESS"):
            now = open_.where(F.col("round") == i)
            if i:
                seen = spark.read.option("basePath", f"{path}/first").parquet(*(f"{path}/first/round={k}" for k in range(i)))
                seen = seen.withColumn("host", F.coalesce(urls.host_of(F.col("url")), F.lit("")))
                shut = seen.groupBy("host").agg(F.count_if(F.col("reason") == REFUSES).alias("r"), F.count_if(F.col("reason") == WALL).alias("w")).where((F.col("r") > 0) | (F.col("w") >= patience)).select("host")
                given_up = now.join(shut, "host", "left_semi").select("url", F.lit("maybe").alias("status"), F.lit(REFUSES).alias("reason"), null("http", "int"), null("final_url", "string"), F.current_timestamp().alias("checked_at"))
                now = now.join(shut, "host", "left_anti")
            answers = _verdicts(fetch(now, get, patience=patience, **options))
            (answers.unionByName(given_up) if i else answers).write.mode("overwrite").parquet(first)
        if not exists(spark, f"{second}/_SUCCESS"):
            doubt = spark.read.parquet(first).where("status = 'no'")
            _verdicts(fetch(doubt, get, patience=patience, **options)).write.mode("overwrite").parquet(second)
    first, second = (spark.read.parquet(f"{path}/{name}").drop("round").withColumn("attempt", F.lit(k)) for k, name in enumerate(("first", "second"), 1))
    both = first.unionByName(second)
    judged = linkstate.confirmed(both, "url", ["attempt"], "reason")
    latest = both.withColumn("_n", F.row_number().over(Window.partitionBy("url").orderBy(F.desc("attempt")))).where("_n = 1")
    out = judged.join(latest.select("url", "http", "final_url", "checked_at"), "url").select("url", "status", "reason", "http", "final_url", "checked_at")
    skipped = todo.where("reason is not null").select("url", F.lit("maybe").alias("status"), "reason", null("http", "int"), null("final_url", "string"), F.current_timestamp().alias("checked_at"))
    return out.unionByName(skipped)


def status_report(state: DataFrame) -> DataFrame:
    """The state ordered for people: dead links, then open ones, then live ones, by host."""
    rank = F.array_position(F.array(*map(F.lit, ("no", "maybe", "yes"))), F.col("status"))
    return state.withColumn("host", urls.host_of(F.col("url"))).orderBy(rank, "host", "url")
