"""Link checking and files as queries: every outcome of the page rules, redirects, marks and
remarks, a paced check with a getter of its own, streamed state, and sinks read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import dims, pages, text, urls
from ..operators import joins, linkstate, reports
from ..operators.staging import shared_folder, stage
from ..sources import documents, fetch, workbook
from ..streaming.linkstream import keep_state, read_state
from . import book, fold
from .links import table

LONG = "a product page with plenty to read " * 20
SKIP, BLOCKED, PARKED = dims.SKIP_HOSTS[0], dims.BLOCKED_HOSTS[0], dims.PARKED_HOSTS[0]
#: One case per outcome of the rules: url, where it ended, code, body, title; verdict, reason.
CASES = [
    ("https://shop.com/1", None, 404, LONG, None, "no", "http 404"),
    ("https://shop.com/1", None, 403, LONG, None, "maybe", "http 403"),
    ("https://shop.com/1", None, 502, LONG, None, "maybe", "http 502"),
    ("https://shop.com/1", f"https://www.{PARKED}/x", 200, LONG, None, "no", "domain is parked or for sale"),
    ("https://shop.com/1", None, 200, LONG + "<p>This domain is for sale</p>", None, "no", "domain is parked or for sale"),
    ("https://shop.com/1", "https://shop.com/punish?x=1", 200, LONG, None, "maybe", "bot check or login wall"),
    ("https://shop.com/1", None, 200, LONG + "<div id='captcha'>", None, "maybe", "bot check or login wall"),
    ("https://www.aliexpress.com/item/1.html", "https://www.aliexpress.com/", 200, LONG, None, "no", "redirected off the product page"),
    ("https://www.aliexpress.com/item/1.html", None, 200, LONG + "<meta property='og:title' content='Thing'>", None, "yes", "listing has a title"),
    ("https://www.aliexpress.com/item/1.html", None, 200, LONG, "Thing - shop", "yes", "rendered page has a product title"),
    ("https://www.aliexpress.com/item/1.html", None, 200, LONG + "<meta property='og:title' content=''>", None, "no", "listing has no title (removed)"),
    ("https://www.aliexpress.com/item/1.html", None, 200, LONG, "AliExpress.com", "no", "listing has no title (removed)"),
    ("https://www.aliexpress.com/item/1.html", None, 200, LONG, None, "maybe", "no og:title tag - page format may have changed"),
    ("https://www.amazon.com/dp/B000000001", None, 200, LONG + "Enter the characters you see below", None, "maybe", "bot check or login wall"),
    ("https://www.amazon.com/dp/B000000001", None, 200, LONG + "Meet the dogs of Amazon", None, "no", "amazon 404 page"),
    ("https://www.amazon.com/dp/B000000001", None, 200, LONG + "<b id='productTitle'>x</b> Currently <i>unavailable</i>", None, "yes", "product page - currently unavailable"),
    ("https://www.amazon.com/dp/B000000001", None, 200, LONG + "Add to Cart", None, "yes", "product page"),
    ("https://amzn.to/x", None, 200, LONG, None, "maybe", "not recognisably a product page"),
    ("https://www.digikey.com/p/1", None, 200, LONG + "No longer available", None, "no", "distributor says the part is no longer available"),
    ("https://www.mouser.com/p/1", None, 200, LONG + "Part Status: <b>Obsolete</b>", None, "yes", "product page - part status is obsolete/discontinued"),
    ("https://shop.com/1", None, 200, LONG + "Please <b>log in</b>", None, "maybe", "bot check or login wall"),
    ("https://shop.com/1", None, 200, "<title>404 - not found</title>" + LONG, None, "no", "page says the listing is gone"),
    ("https://shop.com/1", None, 200, LONG + "This item has been removed", None, "no", "page says the listing is gone"),
    ("https://shop.com/1", None, None, LONG, None, "maybe", "no http code"),
    ("https://shop.com/1", None, 302, LONG, None, "maybe", "http 302"),
    ("https://shop.com/1", None, 200, "short", None, "maybe", "response too short to judge"),
    ("https://shop.com/1", None, 200, LONG, None, "yes", "http 200"),
]
WALLS = [("https://shop.com/x5secdata?y", LONG, True), ("https://shop.com/", "a captcha", True), ("https://shop.com/", LONG + "verify you are a human", True), (f"https://{PARKED}/", "captcha", False), ("https://shop.com/", LONG, False)]


def verdict_rules(spark, sf_dir):
    """Every page number with one case of the page rules."""
    cases = spark.createDataFrame([(i, *c[:5]) for i, c in enumerate(CASES)], "n long, url string, final_url string, code int, body string, title string")
    p = table(spark, sf_dir, "pages").select("page_id", F.pmod("page_id", F.lit(len(CASES))).alias("n")).join(F.broadcast(cases), "n")  # a case per outcome
    j = pages.judge(F.col("url"), F.col("final_url"), F.col("code"), F.col("body"), F.col("title"))
    return p.withColumn("j", j).select("page_id", "j.verdict", "j.reason")


def wall_rules(spark, sf_dir):
    cases = spark.createDataFrame([(i, *c[:2]) for i, c in enumerate(WALLS)], "n long, url string, body string")
    p = table(spark, sf_dir, "pages").select("page_id", F.pmod("page_id", F.lit(len(WALLS))).alias("n")).join(F.broadcast(cases), "n")  # five cases
    return p.select("page_id", pages.is_wall(F.col("url"), F.col("body")).alias("wall"))


def unfetched_hosts(spark, sf_dir):
    """Pages on hosts that are not asked, and how the others read."""
    p = table(spark, sf_dir, "pages").withColumn("host", F.expr(f"element_at(array('{SKIP}', 'www.{SKIP}', '{BLOCKED}', 'www.{BLOCKED}', 'x.{BLOCKED}', 'fine.com'), cast(page_id % 6 + 1 as int))"))
    url = F.concat(F.lit("https://"), F.col("host"), F.lit("/"), F.col("page_id").cast("string"))
    return p.select("page_id", F.coalesce(pages.unfetched(url), F.lit("asked")).alias("skip_reason"))


def redirect_targets(spark, sf_dir):
    """Links wrapped up to five deep, of which four are unwrapped, and their canonical form."""
    url = F.concat(F.lit("https://www.Shop.example/p/"), F.col("page_id").cast("string"), F.lit("/?size=2"))
    out = url
    for k in range(1, 6):
        out = F.when(F.pmod("page_id", F.lit(6)) >= k, F.concat(F.lit("https://www.google.com/url?"), F.when(F.pmod("page_id", F.lit(4)) < 2, "q=").otherwise("url="), F.url_encode(out))).otherwise(out)
    p = stage(table(spark, sf_dir, "pages").select("page_id", out.alias("url")))
    return p.select("page_id", urls.host_of(urls.unwrap(F.col("url"))).alias("host"), F.when(F.pmod("page_id", F.lit(6)) < 5, urls.url_key(F.col("url"))).alias("url_key"))


def link_notes(spark, sf_dir):
    """Remarks on links: every branch, by part."""
    p = table(spark, sf_dir, "part")
    reason = F.expr("element_at(array('http 200', 'part status is obsolete', 'product page - currently unavailable', null), cast(p_size % 4 + 1 as int))")
    product = F.expr("element_at(array('yes', 'no', 'maybe'), cast(p_partkey % 3 + 1 as int))")
    short, dead = F.expr("p_partkey % 5 = 0"), F.expr("p_partkey % 2 = 0")
    return p.select("p_partkey", linkstate.link_note(reason, product, short, dead).alias("note"), linkstate.affiliate_verdict(product, short, F.lit(1), dead.cast("int")).alias("verdict"))


def compatibility_forms(spark, sf_dir):
    """Full-width letters, ligatures and fancy dashes read as plain ones."""
    plain, wide = "abcdefghijklmnopqrstuvwxyz", "".join(chr(ord(c) + 0xFEE0) for c in "abcdefghijklmnopqrstuvwxyz")
    p = table(spark, sf_dir, "part")
    name = F.when(F.col("p_partkey") % 2 == 0, F.translate("p_name", plain, wide)).otherwise(F.concat(F.lit("– ﬁne "), F.col("p_name"), F.lit(" ½ ;")))
    return p.select("p_partkey", text.clean_text(name).alias("clean"), text.name_key(name).alias("key"), text.slug(name).alias("slug"))


def customers_without_urgent_orders(spark, sf_dir):
    urgent = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf_dir, "customer").select("c_custkey", "c_name").join(urgent, "c_custkey", "left_anti")


def cookies_by_host(spark, sf_dir):
    jar = spark.createDataFrame([("example.com", "a=1"), ("blog.thernt.example.com", "b=2"), ("", "c=3")], "domain string, header string")
    p = table(spark, sf_dir, "pages").select("page_id", urls.host_of(F.col("url")).alias("host"))
    return fetch.cookie_of(p, jar).select("page_id", "cookie")


def worklist_order(spark, sf_dir):
    """The first 50 links to check by host, of hosts with a word in their name."""
    p = table(spark, sf_dir, "pages").select("url").where("url is not null")
    return linkstate.worklist(p, "url", only="example", exclude="casino", limit=50)


def _answer(url, cookie):
    """A web of its own: what ends in 1 is gone, in 2 shut, in 3 unreachable."""
    end = url.split("?")[0].split("#")[0].rstrip("/").removesuffix(".html")[-1:]
    if end == "3":
        raise ConnectionRefusedError
    return url + ("moved" if end == "4" else ""), {"1": 404, "2": 503}.get(end, 200), LONG.encode(), None


def checked_links(spark, sf_dir):
    """All page links asked without delay, dead ones twice."""
    p = table(spark, sf_dir, "pages").select("url")
    out = fetch.check(stage(p), _folder(spark), _answer, every=1 << 20, delay=0.0, slow={}, jitter=0.0)
    return out.select("url", "status", "reason", "http", F.coalesce("final_url", F.lit("")).alias("final_url"))


def _folder(spark):
    """A new folder that all executors share."""
    return f"{spark.conf.get('spark.checkpoint.dir')}/check-{uuid.uuid4().hex}"


def link_state_table(spark, sf_dir):
    """States in the order people read them, with the host."""
    p = table(spark, sf_dir, "pages").select("url", F.expr("element_at(array('yes', 'no', 'maybe'), cast(page_id % 3 + 1 as int))").alias("status"))
    return fetch.status_report(p).select("url", "status", "host")


def state_stream(spark, sf_dir):
    """The link state kept by a stream over the events."""
    e = table(spark, sf_dir, "events")
    files = spark.readStream.schema(e.schema).parquet(f"{sf_dir}/events*.parquet")
    status = F.when(F.col("event_type") == "error", "no").when(F.col("event_type") == "view", "maybe").otherwise("yes")
    shared_folder(spark)
    path = _folder(spark)
    keep_state(files.select(F.col("user_id").alias("url"), status.alias("status"), "ts", "event_id"), "url", "ts", ["event_id"], f"{path}/state", f"{path}/checkpoint").awaitTermination()
    return read_state(spark, f"{path}/state").select("url", "status", "event_id")


def _written(spark, write, read):
    """Rows of a sink read back."""
    shared_folder(spark)
    path = _folder(spark)
    write(path)
    return read(path)


def master_documents(spark, sf_dir):
    """The nested master as documents, read back."""
    m = fold.master(spark, sf_dir)
    out = _written(spark, lambda path: documents.write_json(reports.nested(m), path), lambda path: spark.read.json(path))
    return out.selectExpr("id", "name", "name_key", "size(aliases) as n_aliases", "size(used_by) as n_uses", "size(sources) as n_sources", "size(unlinked_sources) as n_unlinked", "size(notes) as n_notes", "used_by[0].project as first_project", "get(sources, 0).url as best_url")


def raw_documents(spark, sf_dir):
    """Raw rows and layouts as documents, read back: rows and slots by sheet."""
    parts = stage(book.parts(spark, sf_dir))

    def read(path):
        rows = spark.read.json(f"{path}/rows").groupBy("sheet").agg(F.count("*").alias("n_rows"), F.sum(F.size("entries")).alias("n_entries"))
        return rows.join(spark.read.json(f"{path}/layouts").select("sheet", F.size("slots").alias("n_slots"), F.expr("slots[5].name").alias("sixth")), "sheet")

    return _written(spark, lambda path: documents.write_raw(workbook.raw_rows(parts), workbook.slots(parts), path), read)


def coverage_files(spark, sf_dir):
    """Rows of the combined coverage file and of each bucket's."""
    rows = stage(fold.fold_coverage(spark, sf_dir))

    def read(path):
        each = spark.read.option("header", True).csv(f"{path}/by_coverage").select("coverage", F.lit("bucket").alias("file"))
        whole = documents.report_csv(spark, f"{path}/all")
        return each.unionByName(whole.select("coverage", F.lit("all").alias("file"))).groupBy("file", "coverage").agg(F.count("*").alias("n"))

    return _written(spark, lambda path: documents.write_buckets(rows, "coverage", path), read)


def fills_document(spark, sf_dir):
    """Colours by category as one document, read back."""
    fills = book.category_fills(spark, sf_dir)
    read = lambda path: spark.read.text(path).select(F.explode(F.from_json("value", "map<string, string>")).alias("category", "fill"))
    return _written(spark, lambda path: documents.write_fills(fills, path), read)


def manual_states(spark, sf_dir):
    """Measured states and verdicts by hand out of their files; the latter win."""
    p = table(spark, sf_dir, "pages").select("page_id", "url").where("url is not null").groupBy("url").agg(F.min("page_id").alias("page_id"))
    entry = F.struct(F.expr("element_at(array('yes', 'no'), cast(page_id % 2 + 1 as int))").alias("status"), F.lit("http 200").alias("reason"), F.lit(200).alias("http"))
    hand = F.struct(F.lit("maybe").alias("status"), F.concat(F.lit("note "), F.col("page_id").cast("string")).alias("note"), F.lit("me").alias("by"), F.lit("2024-01-01").alias("at"))

    def write(path):
        for name, rows, value in (("measured", p, entry), ("manual", p.where("page_id % 5 = 0"), hand)):
            rows.groupBy(F.lit(1)).agg(F.map_from_entries(F.collect_list(F.struct("url", value.alias("v")))).alias("links")).select("links").coalesce(1).write.json(f"{path}/{name}")

    out = _written(spark, write, lambda path: documents.link_status(spark, f"{path}/measured", f"{path}/manual"))
    return out.select("url", "status", "reason", "http", "checked_at", "verified")


def vendors_by_precedence(spark, sf_dir):
    """Host suffixes of the known vendors, longest first."""
    hosts = [v[0] for v in dims.VENDORS]
    p = table(spark, sf_dir, "part").withColumn("host", F.concat(F.expr("if(p_partkey % 2 = 0, 'm.', '')"), F.element_at(F.array(*map(F.lit, hosts)), (F.pmod("p_partkey", F.lit(len(hosts))) + 1).cast("int"))))
    return joins.longest_suffix(p.select("p_partkey", "host"), "host", spark.createDataFrame(dims.VENDORS, "suffix string, vendor_id string, vendor_name string")).select("p_partkey", "vendor_id", "vendor_name")


QUERIES = {f.__name__: f for f in (
    verdict_rules, wall_rules, unfetched_hosts, redirect_targets, link_notes, compatibility_forms, customers_without_urgent_orders, cookies_by_host, worklist_order, checked_links, link_state_table, state_stream,
    master_documents, raw_documents, coverage_files, fills_document, manual_states, vendors_by_precedence,
)}

_H = r"regexp_replace(regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)), '^www\.', ''), ':.*$', '')"
_END = r"right(regexp_replace(rtrim(split_part(split_part(url, '?', 1), '#', 1), '/'), '\.html$', ''), 1)"
_EVENT = "case when event_type = 'error' then 'no' when event_type = 'view' then 'maybe' else 'yes' end"
SQL = {
    "verdict_rules": f"with c(n, verdict, reason) as (values {fold._values([(i, *c[5:]) for i, c in enumerate(CASES)])}) select page_id, verdict, reason from pages join c on n = page_id % {len(CASES)}",
    "wall_rules": f"select page_id, page_id % {len(WALLS)} in {tuple(i for i, w in enumerate(WALLS) if w[2])} as wall from pages",
    "unfetched_hosts": "select page_id, case when page_id % 6 < 2 then 'skipped - bot check cannot be cleared' when page_id % 6 in (2, 3) then 'host refuses automated requests' else 'asked' end as skip_reason from pages",
    "redirect_targets": "select page_id, case when page_id % 6 = 5 then 'google.com' else 'shop.example' end as host, case when page_id % 6 < 5 then 'https://shop.example/p/' || page_id || '?size=2' end as url_key from pages",
    "link_notes": """with p as (select p_partkey, p_size % 4 as r, ['yes', 'no', 'maybe'][p_partkey % 3 + 1] as product, p_partkey % 5 = 0 as short, p_partkey % 2 = 0 as dead from part)
select p_partkey, case when r = 1 then 'distributor still lists the page but the part is obsolete or discontinued' when r = 2 then 'listing is still up but has no buy button - currently unavailable'
when dead and not short and product = 'yes' then 'affiliate code is dead but the product link still works - drop or regenerate the code' when dead and not short and product = 'no' then 'affiliate code and product link are both dead'
when short and product = 'no' then 'the only link is a dead affiliate code, so the product it pointed at cannot be recovered' end as note,
case when dead and not short then (case product when 'yes' then 'affiliate dead, product link fine' when 'no' then 'both dead' else 'affiliate dead, product link unresolved' end) when short and product = 'no' then 'only link is a dead affiliate code' end as verdict from p""",
    "compatibility_forms": """select p_partkey, case when p_partkey % 2 = 0 then p_name else 'fine ' || p_name || ' 1' || chr(8260) || '2' end as clean, case when p_partkey % 2 = 0 then p_name else 'fine ' || p_name || ' 1 2' end as key,
case when p_partkey % 2 = 0 then replace(p_name, ' ', '-') else 'fine-' || replace(p_name, ' ', '-') || '-12' end as slug from part""",
    "customers_without_urgent_orders": "select c_custkey, c_name from customer where c_custkey not in (select o_custkey from orders where o_orderpriority = '1-URGENT')",
    "cookies_by_host": f"select page_id, case when h = 'blog.thernt.example.com' or ends_with(h, '.blog.thernt.example.com') then 'b=2' when h = 'example.com' or ends_with(h, '.example.com') then 'a=1' else 'c=3' end as cookie from (select page_id, {_H} as h from pages)",
    "worklist_order": f"select url, host from (select url, {_H} as host from pages) where contains(host, 'example') and not contains(host, 'casino') order by host, url limit 50",
    "checked_links": f"""with u as (select distinct url, {_END} as e from pages where url <> '') select url, case e when '1' then 'no' when '2' then 'maybe' when '3' then 'maybe' else 'yes' end as status,
case e when '1' then 'http 404' when '2' then 'http 503' when '3' then 'connection failed' else 'http 200' end as reason, case e when '1' then 404 when '2' then 503 when '3' then null else 200 end as http, case when e = '4' then url || 'moved' else '' end as final_url from u""",
    "link_state_table": f"select url, ['yes', 'no', 'maybe'][page_id % 3 + 1] as status, {_H} as host from pages",
    "state_stream": f"select url, status, event_id from (select user_id as url, {_EVENT} as status, event_id, row_number() over (partition by user_id order by ({_EVENT} <> 'maybe')::int desc, ts desc, event_id desc) as n from events) where n = 1",
    "master_documents": f"""{fold._ALL}, un as (select key, count(distinct label) as n from said group by 1), no as (select key, count(distinct p_brand) as n from r where seq % 6 < 2 group by 1),
bs as (select key, url from src qualify row_number() over (partition by key order by role_rank, n_tabs desc, vendor_name, seq) = 1), us as (select key, count(*) as n, arg_min(project, seq) as p from uses group by 1), sn as (select key, count(*) as n from src group by 1)
select id, name, items.key as name_key, case when aliases = '' then 0 else len(string_split(aliases, ' | ')) end::int as n_aliases, us.n::int as n_uses, coalesce(sn.n, 0)::int as n_sources, coalesce(un.n, 0)::int as n_unlinked, coalesce(no.n, 0)::int as n_notes, us.p as first_project, bs.url as best_url
from items join us using (key) left join sn using (key) left join un using (key) left join no using (key) left join bs using (key)""",
    "raw_documents": f"select sheet, count(*) as n_rows, sum(case when entries = '' then 0 else 1 end)::bigint as n_entries, 7 as n_slots, 'Recommended' as sixth from ({book.SQL['workbook_rows']}) group by sheet",
    "coverage_files": f"with c as ({fold.SQL['fold_coverage']}) select unnest(['all', 'bucket']) as file, coverage, n from (select coverage, count(*) as n from c group by 1)",
    "fills_document": f"select category, fill from ({book.SQL['category_fills']})",
    "manual_states": """with p as (select url, min(page_id) as page_id from pages where url is not null group by url) select url, case when page_id % 5 = 0 then 'maybe' else ['yes', 'no'][page_id % 2 + 1] end as status,
case when page_id % 5 = 0 then 'note ' || page_id else 'http 200' end as reason, case when page_id % 5 = 0 then null else 200 end as http, case when page_id % 5 = 0 then '2024-01-01' end as checked_at, case when page_id % 5 = 0 then 'manual' end as verified from p""",
    "vendors_by_precedence": f"with v(i, id, name) as (values {fold._values([(i, v[1], v[2]) for i, v in enumerate(dims.VENDORS)])}) select p_partkey, id as vendor_id, name as vendor_name from part join v on i = p_partkey % {len(dims.VENDORS)}",
}
