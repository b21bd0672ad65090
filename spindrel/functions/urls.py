"""URLs as column expressions: host, canonical form, identity, affiliate marks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import dims
from .text import let

_SCHEME = r"^[a-zA-Z][a-zA-Z0-9+.-]*:"


def authority(url: Column) -> Column:
    return F.regexp_extract(F.lower(url), r"^(?:[a-z][a-z0-9+.-]*:)?//([^/?#]*)", 1)


def host_of(url: Column) -> Column:
    """Lower-case host without www. and port; '' where there is none."""
    return F.regexp_replace(F.regexp_replace(F.coalesce(authority(url), F.lit("")), r"^www\.", ""), ":.*$", "")


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def query_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)


def decoded(s: Column) -> Column:
    return F.coalesce(F.try_url_decode(F.regexp_replace(s, "%(?![0-9A-Fa-f]{2})", "%25")), s)


def encoded(s: Column) -> Column:
    return F.replace(F.replace(F.url_encode(s), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def params(url: Column) -> Column:
    """array<struct<k, v>> of the decoded query parameters that have a value."""
    parts = F.filter(F.split(query_of(url), "&"), lambda p: p.contains("="))
    pairs = F.transform(parts, lambda p: F.struct(decoded(F.regexp_extract(p, "^([^=]*)=", 1)).alias("k"), decoded(F.regexp_extract(p, "^[^=]*=(.*)$", 1)).alias("v")))
    return F.filter(pairs, lambda p: p.v != "")


def _hop(url: Column) -> Column:
    def step(x):
        at = lambda k: F.try_element_at(F.filter(x.p, lambda y: y.k == k), F.lit(-1)).v
        goal = F.coalesce(at("q"), at("url"))
        # a parameter is decoded once more here, where a plus sign stays one
        return F.when(x.wraps & goal.isNotNull(), decoded(F.replace(goal, F.lit("+"), F.lit("%2B")))).otherwise(x.url)

    parts = lambda u: F.struct(u.alias("url"), params(u).alias("p"), (authority(u).endswith("google.com") & path_of(u).startswith("/url")).alias("wraps"))
    return let(url, lambda u: let(parts(u), step))


def unwrap(url: Column, hops: int = 4) -> Column:
    """The target of search redirect links, up to `hops` deep."""
    for _ in range(hops):
        url = _hop(url)
    return url


def _canonical(x: Column, keep_www: bool) -> Column:
    item = F.coalesce(*(F.nullif(F.regexp_extract(x.path, p, 1), F.lit("")) for p in (r"(?i)/item/(?:[^/]*?/)?(?:.*?-)?(\d{6,})\.html", r"(?i)/store/product/.*?/\d+_(\d{6,})\.html")))
    asin = F.nullif(F.upper(F.regexp_extract(x.path, r"(?i)/(?:dp|gp/product|gp/aw/d)/([A-Z0-9]{10})(?:[/?]|$)", 1)), F.lit(""))
    part = F.nullif(F.upper(F.regexp_extract(x.path, "^/([0-9A-Za-z]+)/?$", 1)), F.lit(""))
    stripped = F.regexp_replace(x.path, "/+$", "")
    plain = F.concat(
        F.lit("https://"), x.host if keep_www else x.bare, F.when(stripped == "", "/").otherwise(stripped), F.when(x.kept == "", "").otherwise(F.concat(F.lit("?"), x.kept))
    )
    return (
        F.when(x.bare.contains("aliexpress") & (x.bare != "s.click.aliexpress.com") & item.isNotNull(), F.concat(F.lit("https://www.aliexpress.com/item/"), item, F.lit(".html")))
        .when(
            (x.bare.isin("amazon.com", "amzn.to") | x.bare.startswith("amazon.")) & asin.isNotNull(),
            F.concat(F.lit("https://www."), F.when(x.bare == "amzn.to", "amazon.com").otherwise(x.bare), F.lit("/dp/"), asin),
        )
        .when((x.bare == "mcmaster.com") & part.isNotNull(), F.concat(F.lit("https://www.mcmaster.com/"), part, F.lit("/")))
        .otherwise(plain)
    )


def canonical_url(url: Column, keep_www: bool = True, hops: int = 4) -> Column:
    """Clickable form without tracking; well-known shops reduced to their product id."""

    def parts(u):
        kept = F.array_sort(F.filter(params(u), lambda p: ~F.lower(p.k).isin(dims.TRACKING_KEYS)))
        host = F.regexp_replace(authority(u), ":.*$", "")
        return F.struct(
            host.alias("host"), F.regexp_replace(host, r"^www\.", "").alias("bare"), path_of(u).alias("path"),
            F.array_join(F.transform(kept, lambda p: F.concat(encoded(p.k), F.lit("="), encoded(p.v))), "&").alias("kept"),
        )

    whole = let(unwrap(F.trim(url), hops), lambda u: F.when(u.rlike(_SCHEME), u).otherwise(F.concat(F.lit("https://"), u)))
    out = let(whole, lambda u: let(parts(u), lambda x: _canonical(x, keep_www)))
    return F.when(F.coalesce(url, F.lit("")) != "", out)


def url_key(url: Column, hops: int = 4) -> Column:
    return F.lower(canonical_url(url, keep_www=False, hops=hops))


def is_affiliate(url: Column, label: Column | None = None) -> Column:
    marks = F.array(*map(F.lit, dims.AFFILIATE_KEYS))
    by_url = let(unwrap(url), lambda u: F.coalesce(host_of(u).isin(dims.AFFILIATE_HOSTS) | F.arrays_overlap(F.transform(params(u), lambda p: F.lower(p.k)), marks), F.lit(False)))
    return by_url if label is None else F.coalesce(label.rlike("(?i)affi?li?ate"), F.lit(False)) | by_url


def identified(df: DataFrame, url: str, *, key: str | None = None, canonical: str | None = None, affiliate: str | None = None, label: str | None = None, hops: int = 4) -> DataFrame:
    """Adds, under the names given, url_key(), canonical_url() and is_affiliate() of a column. One
    plain projection follows the other and nothing is nested, so the plan stays small, what
    they share is computed once, and it runs as generated code."""
    u, p, goal = F.col("_u"), F.col("_p"), F.col("_goal")
    out = df.withColumn("_u", F.trim(F.col(url)))
    for _ in range(hops):
        out = out.withColumn("_p", F.when(authority(u).endswith("google.com") & path_of(u).startswith("/url"), params(u)))
        at = lambda k: F.try_element_at(F.filter(p, lambda y: y.k == k), F.lit(-1)).v
        out = out.withColumn("_goal", F.when(p.isNotNull(), F.coalesce(at("q"), at("url"))))
        out = out.withColumn("_u", F.when(goal.isNotNull(), decoded(F.replace(goal, F.lit("+"), F.lit("%2B")))).otherwise(u))
    out = out.withColumn("_p", params(u)).withColumn("_host", F.regexp_replace(authority(u), ":.*$", ""))
    made = []
    if affiliate:
        marks = F.array(*map(F.lit, dims.AFFILIATE_KEYS))
        by_url = F.coalesce(F.regexp_replace("_host", r"^www\.", "").isin(dims.AFFILIATE_HOSTS) | F.arrays_overlap(F.transform(p, lambda x: F.lower(x.k)), marks), F.lit(False))
        by_url = by_url if label is None else F.coalesce(F.col(label).rlike("(?i)affi?li?ate"), F.lit(False)) | by_url
        out, made = out.withColumn("_affiliate", by_url), [F.col("_affiliate").alias(affiliate)]
    if key or canonical:
        out = out.withColumn("_u", F.when(u.rlike(_SCHEME), u).otherwise(F.concat(F.lit("https://"), u)))
        kept = F.array_sort(F.filter(p, lambda x: ~F.lower(x.k).isin(dims.TRACKING_KEYS)))
        out = out.withColumns({"_host": F.regexp_replace(authority(u), ":.*$", ""), "_path": path_of(u), "_kept": F.array_join(F.transform(kept, lambda x: F.concat(encoded(x.k), F.lit("="), encoded(x.v))), "&")})
        out = out.withColumn("_x", F.struct(F.col("_host").alias("host"), F.regexp_replace("_host", r"^www\.", "").alias("bare"), F.col("_path").alias("path"), F.col("_kept").alias("kept")))
        there = F.coalesce(F.col(url), F.lit("")) != ""
        made += [F.when(there, _canonical(F.col("_x"), True)).alias(canonical)] if canonical else []
        made += [F.lower(F.when(there, _canonical(F.col("_x"), False))).alias(key)] if key else []
    # by way of a generator, as a condition on the result would else be pushed through all steps,
    # and written out in full at each
    old = [c for c in df.columns if c not in (key, canonical, affiliate)]
    return out.select(*old, F.inline_outer(F.array(F.struct(*made))))


def is_short(url: Column) -> Column:
    return host_of(url).isin(dims.AFFILIATE_HOSTS)
