"""Aggregation, join and window idioms over the star-schema tables and events."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text
from ..functions.similarity import ratio, token_diff
from ..operators import aggregates, joins, linkstate, windows
from .links import table


def majority_vote(spark, sf_dir):
    return aggregates.majority_vote(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderpriority", "o_orderkey")


def frequency_lists(spark, sf_dir):
    out = aggregates.by_frequency(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderpriority", "o_orderkey")
    return out.select("o_custkey", F.array_join("o_orderpriority", " | ").alias("priorities"))


def ordered_distinct(spark, sf_dir):
    out = aggregates.ordered_distinct(table(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_returnflag", "l_linenumber")
    return out.select("l_orderkey", F.array_join("l_returnflag", "; ").alias("flags"))


def _line_status(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", F.when(F.col("l_returnflag") == "R", "no").when(F.col("l_linestatus") == "F", "yes").when(F.col("l_returnflag") == "N", "yes").otherwise("maybe").alias("status"))
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey")).join(li, "l_orderkey", "left")


def coverage_buckets(spark, sf_dir):
    return aggregates.coverage(_line_status(spark, sf_dir), ["l_orderkey"], "status")


def coverage_rollup(spark, sf_dir):
    """Buckets counted, and how many of their orders are open (the current ones)."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus")
    c = coverage_buckets(spark, sf_dir).join(o, "l_orderkey")
    return c.groupBy("coverage").agg(F.count("*").alias("n_items"), F.count_if(F.col("o_orderstatus") == "O").alias("n_current"))


def rollup_metrics(spark, sf_dir):
    li, o, c = (table(spark, sf_dir, t) for t in ("lineitem", "orders", "customer"))
    lines = li.agg(F.count("*").alias("n_entries"), F.count_distinct("l_partkey").alias("n_parts"), F.count_distinct("l_partkey", "l_suppkey").alias("n_links"))
    shared = li.select("l_partkey", "l_orderkey").distinct().groupBy("l_partkey").count().agg(F.count_if(F.col("count") > 1).alias("n_shared"))
    orders = o.agg(F.count("*").alias("n_orders"), F.count_distinct("o_custkey").alias("n_buyers"))
    parts = [lines, shared, orders, c.agg(F.count("*").alias("n_customers"))]  # one row each
    names = [n for p in parts for n in p.columns]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p, allowMissingColumns=True)
    return rows.agg(*(F.max(n).alias(n) for n in names))


def qty_pivot(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return aggregates.pivot_quantities(li, "l_orderkey", "l_returnflag", ["A", "N", "R"], F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit("@"), F.col("l_linestatus")), "l_linenumber")


def top_vendors(spark, sf_dir):
    n = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.count("*").alias("links"))
    return n.join(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), "s_suppkey").orderBy(F.desc("links"), "s_suppkey").limit(25)


def _uses(spark, sf_dir):
    """Customers as components, orders by priority as tabs, part brands as links."""
    o, li, p = (table(spark, sf_dir, t) for t in ("orders", "lineitem", "part"))
    return o.join(li, o.o_orderkey == li.l_orderkey).join(p, li.l_partkey == p.p_partkey).select("o_custkey", "o_orderpriority", "o_orderstatus", "o_orderkey", "p_brand")


def variants(spark, sf_dir):
    return aggregates.variants(_uses(spark, sf_dir), "o_custkey", "o_orderpriority", "o_orderstatus", "p_brand", "o_orderkey")


def variants_histogram(spark, sf_dir):
    return variants(spark, sf_dir).groupBy("variants_full").agg(F.count("*").alias("n_components"), F.sum("tabs").alias("n_uses"))


def conflicts(spark, sf_dir):
    c = aggregates.conflicts(_uses(spark, sf_dir), "o_custkey", "o_orderstatus", "o_orderpriority", "p_brand")
    return c.select("o_custkey", "o_orderstatus", F.col("rank").cast("long").alias("rank"), "n_projects", F.array_join("signature", " ").alias("links"))


def left_anti_unlinked(spark, sf_dir):
    c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    return c.join(o.select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti").select("c_custkey", "c_name")


def loss_check_except(spark, sf_dir):
    li, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    lost = li.select(F.col("l_orderkey").alias("key")).distinct().exceptAll(o.select(F.col("o_orderkey").alias("key")).distinct())
    extra = o.select(F.col("o_orderkey").alias("key")).subtract(li.select(F.col("l_orderkey").alias("key")))
    return lost.select("key", F.lit("lost").alias("side")).unionByName(extra.select("key", F.lit("extra").alias("side")))


def set_algebra(spark, sf_dir):
    e = table(spark, sf_dir, "events").groupBy("user_id").agg(F.collect_set(F.when(F.col("value") > 50, F.col("event_type"))).alias("a"), F.collect_set(F.when(F.col("value") <= 50, F.col("event_type"))).alias("b"))
    text_of = lambda c: F.array_join(F.array_sort(c), " ")
    return e.select("user_id", text_of(F.array_intersect("a", "b")).alias("both"), text_of(F.array_union("a", "b")).alias("any"), text_of(F.array_except("a", "b")).alias("only_a"), F.arrays_overlap("a", "b").alias("meet"))


def _names(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    seen = p.groupBy("p_name", "p_size").agg(F.min("p_partkey").alias("seq"))
    return seen.select("seq", F.col("seq").alias("id"), F.concat_ws(" ", F.lower("p_name"), F.concat(F.lit("m"), F.col("p_size"))).alias("key"), F.col("p_name").alias("base_key"))


def near_dup_pairs(spark, sf_dir):
    return joins.near_names(_names(spark, sf_dir), threshold=0.3, sequence=False).withColumn("score", F.round("score", 6))


def near_name_clusters(spark, sf_dir):
    return joins.near_names(_names(spark, sf_dir))


def _part_suppliers(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_suppkey", F.concat_ws("-", F.col("l_partkey").cast("string"), F.col("l_linenumber").cast("string")).alias("url"))


def shared_link_pairs(spark, sf_dir):
    return joins.shared_links(_part_suppliers(spark, sf_dir), "l_suppkey", "url")


def reviewed_pair_exclusion(spark, sf_dir):
    n = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("a"), (F.pmod(F.col("s_suppkey") * 7, F.lit(100)) + 1).alias("b"))
    return joins.shared_links(_part_suppliers(spark, sf_dir), "l_suppkey", "url", n)


def full_outer_precedence(spark, sf_dir):
    measured = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("n_chars") > 3000, "yes").when(F.col("n_chars") < 500, "no").otherwise("maybe").alias("status"))
    manual = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, "yes").otherwise("no").alias("status"))
    return joins.precedence(measured, manual, "doc_id", "status")


def align_old_new(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("lang", F.md5(F.coalesce("text", F.lit(""))).alias("key"), F.col("doc_id").alias("seq"), F.pmod(F.regexp_extract("source", "([0-9]+)", 1).try_cast("int"), F.lit(2)).alias("side"))
    return joins.align(d.where("side = 0"), d.where("side = 1"), ["lang"], "key", "seq")


def _ordered(spark, sf_dir):
    return table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")


def carry_forward_reset(spark, sf_dir):
    e = _ordered(spark, sf_dir).withColumn("carried", F.when(F.col("event_type") == "view", F.col("value")))
    return windows.carry_forward(e, "user_id", ["ts", "event_id"], "carried", F.col("event_type") == "error").select("event_id", "carried")


def or_groups(spark, sf_dir):
    return windows.or_groups(_ordered(spark, sf_dir), "user_id", ["ts", "event_id"], F.col("event_type") == "error", "event_id").select("event_id", "choice_group")


def or_neighbours(spark, sf_dir):
    out = windows.neighbours(_ordered(spark, sf_dir), "user_id", ["ts", "event_id"], "event_id", F.col("event_type") == "error")
    return out.where("event_type = 'error'").select("event_id", "left", "right", "back_to_back")


def cell_fold(spark, sf_dir):
    e = _ordered(spark, sf_dir).withColumn("slot", F.dayofmonth("ts")).withColumn("url", F.when(F.col("value") > 30, "u").otherwise(""))
    return windows.fold_tags(e, ["user_id"], ["ts", "event_id"], "slot", F.col("event_type") == "click", "url").select("event_id", F.col("head").cast("long").alias("head"))


def slot_intervals(spark, sf_dir):
    e = _ordered(spark, sf_dir).withColumn("col", F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")))
    heads = windows.slot_intervals(e.where("event_type = 'purchase'").select("user_id", F.col("col").alias("start"), F.col("event_id").alias("slot")), "user_id", "start", F.lit(1 << 30))
    return joins.interval_lookup(e, heads, "user_id", "col").select("event_id", "slot")


def primary_rows(spark, sf_dir):
    return windows.primary_rows(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_linenumber"), ["l_orderkey", "l_returnflag"], "l_linenumber")


def _status():
    return F.when(F.col("event_type") == "error", "no").when(F.col("event_type") == "view", "maybe").otherwise("yes")


def _state(spark, sf_dir):
    return linkstate.merge(table(spark, sf_dir, "events").select(F.col("user_id").alias("url"), _status().alias("status"), "ts", "event_id"), "url", "ts", ["event_id"])


def status_merge(spark, sf_dir):
    return _state(spark, sf_dir).select("url", "status", "event_id")


def worklist_stale(spark, sf_dir):
    manual = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("url")).where("url % 10 = 3")
    urls = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("url"))
    return linkstate.stale(_state(spark, sf_dir), manual, urls, "url", "ts", F.expr("timestamp'2024-02-01 00:00:00'"), max_age=3)


def confirmed_dead(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", _status().alias("status"), F.col("event_type").alias("reason"))
    return linkstate.confirmed(e, "user_id", ["ts", "event_id"], "reason")


def precedence_pick(spark, sf_dir):
    p = table(spark, sf_dir, "part").withColumn("rank", F.pmod("p_size", F.lit(7))).withColumn("place", F.pmod("p_size", F.lit(7)))
    return aggregates.pick_by_precedence(p, "p_brand", "place", "p_type", "rank", "p_partkey")


def json_props(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select("event_id", F.from_json("props", "k bigint").k.alias("k"))


def family_scope_key(spark, sf_dir):
    c, n, r = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    d = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey).join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
    key = joins.scope_key(F.col("c_mktsegment"), F.col("c_mktsegment") == "BUILDING", F.col("c_mktsegment") == "MACHINERY", F.col("r_name"), F.col("n_name"))
    return d.groupBy(key.alias("item_key")).agg(F.count("*").alias("n_rows"), F.count_distinct("n_name").alias("n_projects"))


def structural_checks(spark, sf_dir):
    o, n, c, li = (table(spark, sf_dir, t) for t in ("orders", "nation", "customer", "lineitem"))
    ids = o.agg((F.count("*") - F.count_distinct("o_orderkey")).alias("n")).select(F.lit("duplicate ids").alias("check"), "n")
    unknown = c.join(n, c.c_nationkey == n.n_nationkey, "left_anti").agg(F.count("*").alias("n")).select(F.lit("unknown projects").alias("check"), "n")
    orphans = li.join(o, li.l_orderkey == o.o_orderkey, "left_anti").agg(F.count("*").alias("n")).select(F.lit("orphan links").alias("check"), "n")
    return ids.unionByName(unknown).unionByName(orphans)


def first_owner_lookup(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return joins.first_owner(p.select(F.lower("p_name").alias("spelling"), "p_brand", "p_partkey"), "spelling", "p_brand", "p_partkey")


def source_ranking(spark, sf_dir):
    """Suppliers of a part ordered by best role, then number of orders, then name."""
    li, s = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    role = F.when(F.col("l_returnflag") == "N", 0).when(F.col("l_returnflag") == "A", 1).otherwise(2)
    g = li.groupBy("l_partkey", "l_suppkey").agg(F.min(role).alias("r"), F.count_distinct("l_orderkey").alias("n")).join(s, F.col("l_suppkey") == F.col("s_suppkey"))
    rank = F.row_number().over(Window.partitionBy("l_partkey").orderBy("r", F.desc("n"), "s_name"))
    return g.select("l_partkey", "l_suppkey", rank.cast("long").alias("rank"))


def similarity_ratio(spark, sf_dir):
    b = table(spark, sf_dir, "benchmark")
    x, y = b.select(F.col("item_id").alias("id_a"), F.col("text").alias("a")), b.select((F.col("item_id") - 1).alias("id_a"), F.col("text").alias("b"))
    return x.join(y, "id_a").select("id_a", ratio(F.col("a"), F.col("b")).alias("score"))


def redline_tokens(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    after = c.select("conv_id", (F.col("turn") - 2).alias("turn"), F.col("text").alias("next"))
    return c.join(after, ["conv_id", "turn"]).select("conv_id", "turn", token_diff(F.col("text"), F.col("next")).alias("runs"))


def jaccard_words(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    c = c.select("conv_id", "turn", text.tokens(F.col("text")).alias("w"))
    after = c.select("conv_id", (F.col("turn") - 2).alias("turn"), F.col("w").alias("v"))
    return c.join(after, ["conv_id", "turn"]).select("conv_id", "turn", F.round(text.jaccard(F.col("w"), F.col("v")), 9).alias("jaccard"))


QUERIES = {f.__name__: f for f in (
    majority_vote, frequency_lists, ordered_distinct, coverage_buckets, coverage_rollup, rollup_metrics, qty_pivot, top_vendors, variants, variants_histogram, conflicts,
    left_anti_unlinked, loss_check_except, set_algebra, near_dup_pairs, near_name_clusters, shared_link_pairs, reviewed_pair_exclusion, full_outer_precedence, align_old_new,
    carry_forward_reset, or_groups, or_neighbours, cell_fold, slot_intervals, primary_rows, status_merge, worklist_stale, confirmed_dead, precedence_pick, json_props,
    family_scope_key, structural_checks, first_owner_lookup, source_ranking, similarity_ratio, redline_tokens, jaccard_words,
)}

_COVER = """st as (select o_orderkey as l_orderkey, case when l_returnflag = 'R' then 'no' when l_linestatus = 'F' then 'yes' when l_returnflag = 'N' then 'yes' when l_orderkey is not null then 'maybe' end as s
  from orders left join lineitem on l_orderkey = o_orderkey),
c as (select l_orderkey, count(s) as n_links, count(*) filter (s = 'yes') as n_live, count(*) filter (s = 'no') as n_dead, count(*) filter (s = 'maybe') as n_unresolved from st group by 1),
cov as (select *, case when n_links = 0 then 'no_links' when n_unresolved > 0 then 'unknown' when n_dead = 0 then 'all_live' when n_live = 0 then 'none_live' else 'partial' end as coverage from c)"""
_USES = "u as (select o_custkey, o_orderpriority, o_orderstatus, o_orderkey, p_brand from orders join lineitem on l_orderkey = o_orderkey join part on p_partkey = l_partkey)"
_VARIANTS = f"""{_USES}, per as (select o_custkey, o_orderpriority, string_agg(distinct p_brand, ' ' order by p_brand) as sig, arg_min(o_orderstatus, o_orderkey) as name from u group by 1, 2),
v as (select o_custkey, count(*) as tabs, count(distinct name || '/' || sig) as variants_full, count(distinct sig) as variants_links, count(distinct name) as variants_name from per group by 1)"""
_STATUS = "case when event_type = 'error' then 'no' when event_type = 'view' then 'maybe' else 'yes' end"
_STATE = f"""s as (select user_id as url, {_STATUS} as status, ts, event_id from events),
state as (select * from (select *, row_number() over (partition by url order by (status <> 'maybe')::int desc, ts desc, event_id desc) as n from s) where n = 1)"""
_SHARED = """l as (select distinct l_suppkey as i, l_partkey || '-' || l_linenumber as u from lineitem),
f as (select u from l group by u having count(*) between 2 and 4),
pairs as (select x.i as a, y.i as b, count(*) as n_urls from l x join f using (u) join l y on x.u = y.u and x.i < y.i group by 1, 2)"""
_E = "e as (select *, row_number() over (partition by user_id order by ts, event_id) as pos from events)"

SQL = {
    "majority_vote": """with v as (select o_custkey, o_orderpriority, count(*) as votes, min(o_orderkey) as f from orders group by 1, 2)
select o_custkey, o_orderpriority, votes from (select *, row_number() over (partition by o_custkey order by votes desc, f) as n from v) where n = 1""",
    "frequency_lists": """with v as (select o_custkey, o_orderpriority, count(*) as n, min(o_orderkey) as f from orders group by 1, 2)
select o_custkey, string_agg(o_orderpriority, ' | ' order by n desc, f) as priorities from v group by 1""",
    "ordered_distinct": """with v as (select l_orderkey, l_returnflag, min(l_linenumber) as f from lineitem group by 1, 2)
select l_orderkey, string_agg(l_returnflag, '; ' order by f, l_returnflag) as flags from v group by 1""",
    "coverage_buckets": f"with {_COVER} select * from cov",
    "coverage_rollup": f"with {_COVER} select coverage, count(*) as n_items, count(*) filter (o_orderstatus = 'O') as n_current from cov join orders on o_orderkey = l_orderkey group by 1",
    "rollup_metrics": """select (select count(*) from lineitem) as n_entries, (select count(distinct l_partkey) from lineitem) as n_parts, (select count(*) from (select distinct l_partkey, l_suppkey from lineitem)) as n_links,
(select count(*) from (select l_partkey from lineitem group by 1 having count(distinct l_orderkey) > 1)) as n_shared, (select count(*) from orders) as n_orders,
(select count(distinct o_custkey) from orders) as n_buyers, (select count(*) from customer) as n_customers""",
    "qty_pivot": """with q as (select l_orderkey, l_returnflag, cast(l_quantity as int) || '@' || l_linestatus as q, min(l_linenumber) as f from lineitem group by 1, 2, 3)
select l_orderkey, coalesce(string_agg(q, '; ' order by f, q) filter (l_returnflag = 'A'), '') as "qty:A", coalesce(string_agg(q, '; ' order by f, q) filter (l_returnflag = 'N'), '') as "qty:N",
coalesce(string_agg(q, '; ' order by f, q) filter (l_returnflag = 'R'), '') as "qty:R" from q group by 1""",
    "top_vendors": "select s_suppkey, count(*) as links, s_name from lineitem join supplier on s_suppkey = l_suppkey group by s_suppkey, s_name order by links desc, s_suppkey limit 25",
    "variants": f"with {_VARIANTS} select * from v",
    "variants_histogram": f"with {_VARIANTS} select variants_full, count(*) as n_components, cast(sum(tabs) as bigint) as n_uses from v group by 1",
    "conflicts": f"""with {_USES}, sets as (select o_custkey, o_orderstatus, o_orderpriority, string_agg(distinct p_brand, ' ' order by p_brand) as links from u group by 1, 2, 3),
held as (select o_custkey, o_orderstatus, links, count(*) as n_projects, min(o_orderpriority) as f from sets group by 1, 2, 3),
r as (select *, count(*) over (partition by o_custkey, o_orderstatus) as k, row_number() over (partition by o_custkey, o_orderstatus order by n_projects desc, f) as rank from held)
select o_custkey, o_orderstatus, rank, n_projects, links from r where k > 1""",
    "left_anti_unlinked": "select c_custkey, c_name from customer where not exists (select 1 from orders where o_custkey = c_custkey)",
    "loss_check_except": """select key, 'lost' as side from (select l_orderkey as key from lineitem except select o_orderkey from orders)
union all select key, 'extra' from (select o_orderkey as key from orders except select l_orderkey from lineitem)""",
    "set_algebra": """with t as (select user_id, event_type, bool_or(value > 50) as a, bool_or(value <= 50) as b from events group by 1, 2)
select user_id, coalesce(string_agg(event_type, ' ' order by event_type) filter (a and b), '') as both, coalesce(string_agg(event_type, ' ' order by event_type) filter (a or b), '') as any,
coalesce(string_agg(event_type, ' ' order by event_type) filter (a and not b), '') as only_a, coalesce(bool_or(a and b), false) as meet from t group by 1""",
    "near_dup_pairs": """with n as (select p_name as base, p_size, min(p_partkey) as id from part group by 1, 2),
i as (select id, base, string_split(lower(base), ' ') as w, 'm' || p_size as block from n),
b as (select block from i group by 1 having count(*) between 2 and 200),
p as (select x.id as id_a, y.id as id_b, len(list_distinct(list_intersect(x.w, y.w))) * 1.0::double / len(list_distinct(list_concat(x.w, y.w))) as score,
  list_filter(list_concat(x.w, y.w), lambda t: not (list_contains(x.w, t) and list_contains(y.w, t))) as diff
  from i x join b using (block) join i y on x.block = y.block and x.id < y.id and x.base <> y.base)
select id_a, id_b, round(score, 6) as score from p where score >= 0.3 and not list_has_any(diff, [""" + ", ".join(f"'{d}'" for d in joins.DISTINGUISHERS) + "])",
    "shared_link_pairs": f"with {_SHARED} select * from pairs",
    "reviewed_pair_exclusion": f"""with {_SHARED}, done as (select least(s_suppkey, s_suppkey * 7 % 100 + 1) as x, greatest(s_suppkey, s_suppkey * 7 % 100 + 1) as y from supplier)
select * from pairs where not exists (select 1 from done where x = a and y = b)""",
    "full_outer_precedence": """select coalesce(d.doc_id, l.doc_id) as doc_id, case when l.doc_id is not null then (case when quality = 1 then 'yes' else 'no' end)
else (case when n_chars > 3000 then 'yes' when n_chars < 500 then 'no' else 'maybe' end) end as status, case when l.doc_id is not null then 'manual' else 'measured' end as origin
from documents d full outer join labels l on d.doc_id = l.doc_id""",
    "align_old_new": """with d as (select lang, md5(coalesce(text, '')) as key, doc_id as seq, cast(regexp_extract(source, '([0-9]+)', 1) as int) % 2 as side from documents),
o as (select * from d where side = 0), n as (select lang, key, min(seq) as new_seq from d where side = 1 group by 1, 2)
select coalesce(o.lang, n.lang) as lang, coalesce(o.key, n.key) as key, o.seq as old_seq, new_seq, case when new_seq is null then 'removed' when o.seq is null then 'added' else 'kept' end as change
from o full outer join n on o.lang = n.lang and o.key = n.key""",
    "carry_forward_reset": f"""with {_E}, g as (select *, sum((event_type in ('view', 'error'))::int) over (partition by user_id order by pos) as k from e)
select event_id, max(case when event_type = 'view' then value end) over (partition by user_id, k) as carried from g""",
    "or_groups": f"""with {_E}, l as (select *, coalesce(lag(event_type) over (partition by user_id order by pos) = 'error', false) and pos > 2 as joined from e),
i as (select *, sum((not joined)::int) over (partition by user_id, pos % 2 order by pos) as island from l)
select event_id, case when count(*) over (partition by user_id, pos % 2, island) > 1 then min(event_id) over (partition by user_id, pos % 2, island) end as choice_group from i""",
    "or_neighbours": f"""with {_E}, n as (select *, last_value(case when event_type <> 'error' then event_id end ignore nulls) over (partition by user_id order by pos rows between unbounded preceding and 1 preceding) as l,
first_value(case when event_type <> 'error' then event_id end ignore nulls) over (partition by user_id order by pos rows between 1 following and unbounded following) as r,
coalesce(lag(event_type) over (partition by user_id order by pos) = 'error', false) as bb from e)
select event_id, l as "left", r as "right", bb as back_to_back from n where event_type = 'error'""",
    "cell_fold": f"""with recursive {_E}, c as (select user_id, event_id, pos, day(ts) as slot, event_type = 'click' as tag, value > 30 as url from e),
w as (select user_id, event_id, pos, slot, url, pos as head, slot as hs, url as hu from c where pos = 1 union all
select c.user_id, c.event_id, c.pos, c.slot, c.url, case when c.tag and w.hs = c.slot and w.hu then w.head else c.pos end,
case when c.tag and w.hs = c.slot and w.hu then w.hs else c.slot end, case when c.tag and w.hs = c.slot and w.hu then w.hu else c.url end from w join c on c.user_id = w.user_id and c.pos = w.pos + 1)
select event_id, head from w""",
    "slot_intervals": f"""with {_E} select event_id, (select h.event_id from e h where h.user_id = e.user_id and h.event_type = 'purchase' and h.pos <= e.pos order by h.pos desc limit 1) as slot from e""",
    "primary_rows": "select l_orderkey, l_returnflag, l_linenumber, case when l_linenumber <> min(l_linenumber) over w then min(l_linenumber) over w end as merged_into from lineitem window w as (partition by l_orderkey, l_returnflag)",
    "status_merge": f"with {_STATE} select url, status, event_id from state",
    "worklist_stale": f"""with {_STATE} select c_custkey as url from customer left join state on url = c_custkey
where c_custkey not in (select s_suppkey from supplier where s_suppkey % 10 = 3) and (status is null or status = 'maybe' or ts <= timestamp '2024-01-29 00:00:00')""",
    "confirmed_dead": f"""with e as (select user_id, {_STATUS} as status, event_type as reason, row_number() over w as n, lead({_STATUS}) over w as s2, lead(event_type) over w as r2 from events window w as (partition by user_id order by ts, event_id))
select user_id, case when status = 'no' and s2 is not null then s2 else status end as status,
case when status = 'no' and s2 = 'no' then r2 when status = 'no' and s2 is not null then r2 || ' (first attempt looked dead)' else reason end as reason from e where n = 1""",
    "precedence_pick": """with v as (select p_brand, p_size % 7 as place, p_type, count(*) as n, min(p_partkey) as f from part group by 1, 2, 3),
m as (select * from (select *, row_number() over (partition by p_brand, place order by n desc, f) as k from v) where k = 1),
w as (select p_brand, arg_min(p_type, place) as p_type from m group by 1)
select w.p_brand, w.p_type, count(*) filter (m.p_type <> w.p_type) as n_clashes from m join w on m.p_brand = w.p_brand group by 1, 2""",
    "json_props": "select event_id, cast(json_extract(props, '$.k') as bigint) as k from events",
    "family_scope_key": """select case when c_mktsegment = 'BUILDING' then c_mktsegment || ' @' || r_name when c_mktsegment = 'MACHINERY' then c_mktsegment || ' @' || n_name else c_mktsegment end as item_key,
count(*) as n_rows, count(distinct n_name) as n_projects from customer join nation on n_nationkey = c_nationkey join region on r_regionkey = n_regionkey group by 1""",
    "structural_checks": """select 'duplicate ids' as "check", count(*) - count(distinct o_orderkey) as n from orders union all
select 'unknown projects', count(*) from customer where c_nationkey not in (select n_nationkey from nation) union all
select 'orphan links', count(*) from lineitem where l_orderkey not in (select o_orderkey from orders)""",
    "first_owner_lookup": "select lower(p_name) as spelling, arg_min(p_brand, p_partkey) as p_brand from part group by 1",
    "source_ranking": """with g as (select l_partkey, l_suppkey, min(case l_returnflag when 'N' then 0 when 'A' then 1 else 2 end) as r, count(distinct l_orderkey) as n from lineitem group by 1, 2)
select l_partkey, l_suppkey, row_number() over (partition by l_partkey order by r, n desc, s_name) as rank from g join supplier on s_suppkey = l_suppkey""",
    "jaccard_words": """with c as (select conv_id, turn, list_distinct(list_filter(string_split(text, ' '), lambda x: x <> '')) as w from conversations)
select a.conv_id, a.turn, round(case when len(list_concat(a.w, b.w)) = 0 then 1.0 else len(list_intersect(a.w, b.w)) * 1.0::double / len(list_distinct(list_concat(a.w, b.w))) end, 9) as jaccard
from c a join c b on a.conv_id = b.conv_id and b.turn = a.turn + 2""",
}
