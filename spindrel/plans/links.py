"""Queries over pages: observations, identities, vendors, verdicts, coverage by host."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dims, pages, text, urls
from ..operators import aggregates, joins, linkstate


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def observations(spark, sf_dir):
    """Two sightings of each page, with codes and wording that exercise the verdict rules."""
    p = table(spark, sf_dir, "pages")
    k, k32 = F.pmod("page_id", F.lit(16)), F.pmod("page_id", F.lit(32))
    flipped = F.when(p.url.startswith("https://"), F.regexp_replace("url", "^https://", "http://")).otherwise(F.regexp_replace("url", "^http://", "https://"))
    toggled = F.when(flipped.rlike(r"^https?://www\."), F.regexp_replace(flipped, r"^(https?://)www\.", "$1")).otherwise(F.regexp_replace(flipped, "^(https?://)", "$1www."))
    base, mark = F.regexp_replace(toggled, "#.*$", ""), F.regexp_extract(toggled, "(#.*)$", 1)
    variant = F.concat(base, F.when(base.contains("?"), "&utm_source=x").otherwise("?utm_source=x"), mark)
    body = F.concat(
        F.when(k == 1, "this domain is for sale ").otherwise(""), F.col("html"), F.when(k == 7, " this product has been removed ").otherwise(""), F.when(k32 == 11, " access denied ").otherwise("")
    )
    code = F.when(k == 4, 404).when(k == 9, 410).when(k32 == 27, 503).otherwise(200)
    return p.select("page_id", F.posexplode(F.array("url", variant)).alias("sighting", "url"), code.alias("code"), body.alias("body"))


OBS = r"""
p as (select page_id, url, html, case when url like 'https://%' then regexp_replace(url, '^https://', 'http://') else regexp_replace(url, '^http://', 'https://') end as f from pages),
q as (select *, case when regexp_matches(f, '^https?://www\.') then regexp_replace(f, '^(https?://)www\.', '\1') else regexp_replace(f, '^(https?://)', '\1www.') end as t from p),
r as (select *, regexp_replace(t, '#.*$', '') as b, regexp_extract(t, '(#.*)$', 1) as m from q),
body as (select page_id, case when page_id % 16 = 4 then 404 when page_id % 16 = 9 then 410 when page_id % 32 = 27 then 503 else 200 end as code,
  (case when page_id % 16 = 1 then 'this domain is for sale ' else '' end) || html || (case when page_id % 16 = 7 then ' this product has been removed ' else '' end)
  || (case when page_id % 32 = 11 then ' access denied ' else '' end) as body from pages),
obs as (select page_id, 0 as sighting, url from pages union all
  select page_id, 1, b || (case when contains(b, '?') then '&utm_source=x' else '?utm_source=x' end) || m from r),
parts as (select *, regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)), ':.*$', '') as host, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) as path,
  regexp_extract(url, '^[^?#]*\?([^#]*)', 1) as query from obs),
canon as (select *, regexp_replace(path, '/+$', '') as sp, array_to_string(list_sort(list_filter(string_split(query, '&'),
  lambda x: contains(x, '=') and split_part(x, '=', 2) <> '' and lower(split_part(x, '=', 1)) not in ('ref', 'utm_source'))), '&') as kept from parts),
keyed as (select page_id, sighting, url, host, regexp_replace(host, '^www\.', '') as bare,
  'https://' || host || (case when sp = '' then '/' else sp end) || (case when kept = '' then '' else '?' || kept end) as canonical,
  lower('https://' || regexp_replace(host, '^www\.', '') || (case when sp = '' then '/' else sp end) || (case when kept = '' then '' else '?' || kept end)) as url_key from canon)
"""


def url_canonical(spark, sf_dir):
    o = observations(spark, sf_dir).select("page_id", "sighting", "url")
    return urls.identified(o.withColumn("host", urls.host_of(F.col("url"))), "url", key="url_key", canonical="canonical").select("page_id", "sighting", "host", "canonical", "url_key")


def url_key_dedup(spark, sf_dir):
    o = urls.identified(observations(spark, sf_dir).select("page_id", "sighting", "url"), "url", key="url_key")
    seq = F.col("page_id") * 2 + F.col("sighting")
    return o.groupBy("url_key").agg(F.min_by("url", seq).alias("url"), F.count("*").alias("n_sightings"), F.count_distinct("url").alias("n_spellings"))


SUFFIXES = [
    ("example.com", "com", "Example"), ("example.net", "net", "Example Net"), ("example.org", "org", "Example Org"),
    ("blog.theres.example.com", "theres", "Theres"), ("casino-win.example.com", "casino", "Casino"), ("free-bets.example.com", "bets", "Bets"),
]


def vendor_longest_suffix(spark, sf_dir):
    suffixes = spark.createDataFrame(SUFFIXES, "suffix string, vendor_id string, vendor_name string")
    p = table(spark, sf_dir, "pages").select("page_id", urls.host_of(F.col("url")).alias("host"))
    return joins.longest_suffix(p, "host", suffixes)


def visible_text_stats(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    vis = pages.visible_text(F.col("html"))
    return p.select("page_id", pages.page_title(F.col("html")).alias("title"), F.length(vis).alias("n_visible"), F.md5(vis).alias("visible_md5"))


def _judged(spark, sf_dir):
    o = observations(spark, sf_dir)
    return o.withColumn("j", pages.judge(F.col("url"), F.col("url"), F.col("code"), F.col("body"))).select("page_id", "sighting", "url", "j.*")


def page_verdicts(spark, sf_dir):
    return _judged(spark, sf_dir).select("page_id", "sighting", "verdict", "reason")


def link_coverage_by_host(spark, sf_dir):
    """Observations, deduplicated by url key, judged, rolled up to hosts and bucketed."""
    j = urls.identified(_judged(spark, sf_dir), "url", key="url_key")
    first = j.groupBy("url_key").agg(F.min_by(F.struct("url", "verdict"), F.col("page_id") * 2 + F.col("sighting")).alias("x"))
    return aggregates.coverage(first.select(urls.host_of(F.col("x.url")).alias("host"), F.col("x.verdict").alias("status")), ["host"], "status")


def worklist_hosts(spark, sf_dir):
    """Link targets by host with the reason not to fetch them; hosts filtered by substring."""
    p = table(spark, sf_dir, "pages").select("page_id", "url", urls.host_of(F.col("url")).alias("host"))
    return p.where(p.host.contains("example.") & ~p.host.contains("casino")).select("page_id", "host", F.coalesce(pages.unfetched(F.col("url")), F.lit("")).alias("skip_reason"))


def url_targets(spark, sf_dir):
    """Url to the set of item ids that name it."""
    o = urls.identified(observations(spark, sf_dir).select("page_id", "url"), "url", key="url_key")
    return o.groupBy("url_key").agg(F.array_join(F.transform(F.array_sort(F.collect_set("page_id")), lambda x: x.cast("string")), ",").alias("items"))


def affiliate_marks(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", F.regexp_replace("url", "#.*$", "").alias("url"))
    marked = F.concat("url", F.when(p.url.contains("?"), "&").otherwise("?"), F.when(F.pmod("page_id", F.lit(3)) == 0, "tag=a").otherwise("q=a"))
    return p.select("page_id", urls.is_affiliate(marked).alias("affiliate"))


def clean_text_docs(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.md5(F.coalesce(text.clean_text(F.col("text")), F.lit(""))).alias("clean_md5"))


def name_key_docs(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.md5(F.coalesce(text.name_key(F.col("text")), F.lit(""))).alias("key_md5"))


def name_key_parts(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    name = F.concat("p_name", F.lit(" & 3 x 7 x 0.5 pcs M"), F.col("p_size").cast("string"), F.lit(".0"))
    return p.select("p_partkey", text.name_key(name).alias("name_key"))


def slug_ids(spark, sf_dir):
    from ..operators.windows import numbered_ids

    p = table(spark, sf_dir, "part").select("p_partkey", text.slug(F.col("p_name")).alias("base"))
    return numbered_ids(p, "base", ["p_partkey"]).select("p_partkey", "id")


def token_spec(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    key = text.name_key(F.concat_ws(" ", "p_name", "p_brand", F.col("p_size").cast("string")))
    return p.select("p_partkey", F.array_join(text.spec_tokens(key), " ").alias("spec"), F.size(text.words_with_space(F.col("p_name"))).alias("n_words"))


def qty_parse(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    q = F.when(F.pmod("l_orderkey", F.lit(5)) == 0, F.concat(F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit(" 00:00:00"))).when(F.pmod("l_orderkey", F.lit(5)) == 1, "as needed").otherwise(
        F.col("l_quantity").cast("decimal(12,1)").cast("string")
    )
    return li.select("l_orderkey", "l_linenumber", text.qty_text(q).alias("qty"), text.qty_number(q).alias("qty_num"))


def part_numbers(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    made = F.concat(F.lit("rail hfsb5-2020-"), F.col("p_size").cast("string"), F.when(F.pmod("p_partkey", F.lit(2)) == 0, "-ah45-BH325 x").otherwise(" x"))
    n = text.part_number(made)
    return p.select("p_partkey", n.full.alias("full"), n.base.alias("base"), n.machining.alias("machining"))


def affiliate_verdict(spark, sf_dir):
    """Per user: view = product link fine, error = dead; clicks and purchases stand for codes."""
    e = table(spark, sf_dir, "events")
    types = e.groupBy("user_id").agg(
        F.count_if(F.col("event_type") == "view").alias("v"), F.count_if(F.col("event_type") == "error").alias("x"),
        F.count_if((F.col("event_type") == "click") & (F.col("value") > 50)).alias("live"), F.count_if((F.col("event_type") == "click") & (F.col("value") <= 50)).alias("dead"),
    )
    product = F.when(F.col("v") > F.col("x") + 2, "yes").when(F.col("x") > F.col("v") + 2, "no").otherwise("maybe")
    short = F.pmod("user_id", F.lit(4)) == 0
    return types.select("user_id", linkstate.affiliate_verdict(product, short, F.col("live"), F.col("dead")).alias("verdict"), linkstate.link_note(F.lit(""), product, short, F.col("dead") > 0).alias("note"))


QUERIES = {f.__name__: f for f in (
    link_coverage_by_host, url_canonical, url_key_dedup, vendor_longest_suffix, visible_text_stats, page_verdicts, worklist_hosts, url_targets, affiliate_marks,
    clean_text_docs, name_key_docs, name_key_parts, slug_ids, token_spec, qty_parse, part_numbers, affiliate_verdict,
)}

_any = pages.any_of
_HOST = r"regexp_replace(regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)), '^www\.', ''), ':.*$', '')"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_JUDGED = f"""{OBS}, seen as (select *, lower(substring(body, 1, 400000)) as low,
  lower(regexp_replace(regexp_replace(regexp_replace(substring(body, 1, 400000), '(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>', ' ', 'g'), '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')) as vis from body),
judged as (select page_id, case when code in (404, 410) then ['no', 'http ' || code] when code in (401, 402, 403, 407, 429) or code >= 500 then ['maybe', 'http ' || code]
  when regexp_matches(substring(vis, 1, 4000), {_q(_any(dims.PARKED_TEXT))}) then ['no', 'domain is parked or for sale']
  when length(low) < 15000 and regexp_matches(low, 'captcha|slider') then ['maybe', 'bot check or login wall']
  when regexp_matches(vis, {_q(_any(dims.WALL_TEXT))}) then ['maybe', 'bot check or login wall']
  when regexp_matches(low, {_q(dims.DEAD_TITLE)}) or regexp_matches(vis, {_q(_any(dims.DEAD_TEXT))}) then ['no', 'page says the listing is gone']
  when length(low) < 500 then ['maybe', 'response too short to judge'] else ['yes', 'http 200'] end as j from seen)"""

_NAME = r"regexp_replace(regexp_replace(lower({0}), '&', ' and ', 'g'), '\b(pcs|pieces|pack|packs|qty)\b', ' ', 'g')"
_KEY = (
    r"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(" + _NAME + r", '[^a-z0-9.]+', ' ', 'g'), '(\d)\s+x\s+(\d)', '\1x\2', 'g'), "
    r"'(\d)\s+x\s+(\d)', '\1x\2', 'g'), '\b(\d+)\.0\b', '\1', 'g'), '\s+', ' ', 'g'))"
)
_CLEAN = f"trim(trim(regexp_replace(translate(nfc_normalize(text), {_q(text._FANCY)}, {_q(text._PLAIN)}), '\\s+', ' ', 'g')), ' ,;:-–')"

SQL = {
    "link_coverage_by_host": f"""with {_JUDGED},
one as (select url_key, arg_min(struct_pack(b := bare, v := j[1]), page_id * 2 + sighting) as x from keyed join judged using (page_id) group by url_key),
c as (select x.b as host, count(*) as n_links, count(*) filter (x.v = 'yes') as n_live, count(*) filter (x.v = 'no') as n_dead, count(*) filter (x.v not in ('yes', 'no')) as n_unresolved from one group by 1)
select *, case when n_unresolved > 0 then 'unknown' when n_dead = 0 then 'all_live' when n_live = 0 then 'none_live' else 'partial' end as coverage from c""",
    "url_canonical": f"with {OBS} select page_id, sighting, bare as host, canonical, url_key from keyed",
    "url_key_dedup": f"with {OBS} select url_key, arg_min(url, page_id * 2 + sighting) as url, count(*) as n_sightings, count(distinct url) as n_spellings from keyed group by url_key",
    "vendor_longest_suffix": f"""with s(suffix, vendor_id, vendor_name) as (values {", ".join(str(x) for x in SUFFIXES)}),
h as (select page_id, {_HOST} as host from pages),
m as (select h.*, s.*, row_number() over (partition by page_id order by length(suffix) desc) as n from h left join s on host = suffix or ends_with(host, '.' || suffix))
select page_id, host, coalesce(vendor_id, host) as vendor_id, coalesce(vendor_name, host) as vendor_name from m where n = 1""",
    "visible_text_stats": r"""with v as (select page_id, regexp_extract(html, '(?is)<title>([^<]*)</title>', 1) as title,
lower(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>', ' ', 'g'), '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')) as vis from pages)
select page_id, title, length(vis) as n_visible, md5(vis) as visible_md5 from v""",
    "page_verdicts": f"with {_JUDGED} select page_id, sighting, j[1] as verdict, j[2] as reason from obs join judged using (page_id)",
    "worklist_hosts": f"with h as (select page_id, {_HOST} as host from pages) select page_id, host, '' as skip_reason from h where contains(host, 'example.') and not contains(host, 'casino')",
    "url_targets": f"with {OBS}, u as (select distinct url_key, page_id from keyed) select url_key, string_agg(cast(page_id as varchar), ',' order by page_id) as items from u group by url_key",
    "affiliate_marks": "select page_id, page_id % 3 = 0 as affiliate from pages",
    "clean_text_docs": f"select doc_id, md5(coalesce({_CLEAN}, '')) as clean_md5 from documents",
    "name_key_docs": f"select doc_id, md5(coalesce({_KEY.format(_CLEAN)}, '')) as key_md5 from documents",
    "name_key_parts": "select p_partkey, " + _KEY.format("(p_name || ' & 3 x 7 x 0.5 pcs M' || p_size || '.0')") + " as name_key from part",
    "slug_ids": r"""with s as (select p_partkey, lower(trim(regexp_replace(p_name, '[^A-Za-z0-9]+', '-', 'g'), '-')) as b from part),
n as (select *, row_number() over (partition by b order by p_partkey) as n from s) select p_partkey, case when n = 1 then b else b || '-' || n end as id from n""",
    "token_spec": "with k as (select p_partkey, p_name, " + _KEY.format("(p_name || ' ' || p_brand || ' ' || p_size)") + r""" as key from part)
select p_partkey, array_to_string(list_sort(list_distinct(list_filter(string_split(key, ' '), lambda x: regexp_matches(x, '[0-9]')))), ' ') as spec,
cast(len(regexp_extract_all(p_name, '\S+\s*')) as int) as n_words from k""",
    "qty_parse": r"""select l_orderkey, l_linenumber, case when l_orderkey % 5 = 0 then month(l_shipdate) || '-' || day(l_shipdate) when l_orderkey % 5 = 1 then 'as needed'
else cast(cast(l_quantity as bigint) as varchar) end as qty, case when l_orderkey % 5 in (0, 1) then null else l_quantity end as qty_num from lineitem""",
    "part_numbers": """select p_partkey, 'HFSB5-2020-' || p_size || (case when p_partkey % 2 = 0 then '-AH45-BH325' else '' end) as "full", 'HFSB5-2020-' || p_size as base,
case when p_partkey % 2 = 0 then 'AH45-BH325' end as machining from part""",
    "affiliate_verdict": """with t as (select user_id, count(*) filter (event_type = 'view') as v, count(*) filter (event_type = 'error') as x,
count(*) filter (event_type = 'click' and value > 50) as live, count(*) filter (event_type = 'click' and value <= 50) as dead from events group by user_id),
p as (select *, case when v > x + 2 then 'yes' when x > v + 2 then 'no' else 'maybe' end as product, user_id % 4 = 0 as short from t)
select user_id, case when dead > 0 and not short and product = 'yes' then 'affiliate dead, product link fine' when dead > 0 and not short and product = 'no' then 'both dead'
when dead > 0 and not short then 'affiliate dead, product link unresolved' when short and product = 'no' then 'only link is a dead affiliate code' end as verdict,
case when dead > 0 and not short and product = 'yes' then 'affiliate code is dead but the product link still works - drop or regenerate the code'
when dead > 0 and not short and product = 'no' then 'affiliate code and product link are both dead'
when short and product = 'no' then 'the only link is a dead affiliate code, so the product it pointed at cannot be recovered' end as note from p""",
}
