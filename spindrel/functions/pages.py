"""Verdicts on fetched pages: visible text, titles and the judging chain."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import dims
from .text import let
from .urls import host_of

BODY = 400_000


def any_of(patterns) -> str:
    return "|".join(f"(?:{p})" for p in patterns)


def visible_text(html: Column) -> Column:
    s = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>", " ")
    return F.lower(F.regexp_replace(F.regexp_replace(s, "<[^>]+>", " "), r"\s+", " "))


def page_title(html: Column) -> Column:
    return F.regexp_extract(html, r"(?is)<title>([^<]*)</title>", 1)


def og_title(html: Column) -> Column:
    """Null where there is no such tag."""
    p = r"""(?is)<meta[^>]+property=["']og:title["'][^>]*content=["']([^"']*)"""
    return F.when(html.rlike(p), F.regexp_extract(html, p, 1))


def host_in(host: Column, suffixes) -> Column:
    out = F.lit(False)
    for s in suffixes:
        out = out | (host == s) | host.endswith("." + s)
    return out


def looks_parked(final_url: Column, visible: Column) -> Column:
    return host_in(host_of(final_url), dims.PARKED_HOSTS) | F.substring(visible, 1, 4000).rlike(any_of(dims.PARKED_TEXT))


def is_wall(final_url: Column, html: Column) -> Column:
    """A browser page that only exists to stop its visitor."""
    vis = visible_text(html)
    wall = final_url.rlike("(?i)" + dims.CHALLENGE_URL) | F.substring(vis, 1, 6000).rlike(any_of(dims.WALL_TEXT)) | ((F.length(html) < 15000) & F.lower(html).contains("captcha"))
    return ~looks_parked(final_url, vis) & wall


def judge(url: Column, final_url: Column, code: Column, body: Column, title: Column | None = None) -> Column:
    """struct(verdict, reason); the first rule that applies decides."""
    cut = F.substring(F.coalesce(body, F.lit("")), 1, BODY)
    seen = F.struct(
        F.coalesce(F.nullif(final_url, F.lit("")), url).alias("at"), F.lower(cut).alias("low"), visible_text(cut).alias("vis"), og_title(F.coalesce(body, F.lit(""))).alias("og"),
        code.cast("int").alias("code"), (F.lit(None).cast("string") if title is None else title).alias("title"),
    )
    return let(seen, _verdict)


def _verdict(x: Column) -> Column:
    at, low, vis, og, code, title = x.at, x.low, x.vis, x.og, x.code, x.title
    host, rendered = host_of(at), F.trim(F.coalesce(title, F.lit("")))
    http = F.concat(F.lit("http "), code.cast("string"))
    ali, amazon = host.contains("aliexpress"), host.contains("amazon") | (host == "amzn.to")
    distributor = host.contains("digikey") | host.contains("mouser") | host.contains("arrow.com")

    def say(verdict, reason):
        return F.struct(F.lit(verdict).alias("verdict"), (reason if isinstance(reason, Column) else F.lit(reason)).alias("reason"))

    rules = [
        (code.isin(404, 410), say("no", http)),
        (code.isin(401, 402, 403, 407, 429) | (code >= 500), say("maybe", http)),
        (looks_parked(at, vis), say("no", "domain is parked or for sale")),
        (at.rlike("(?i)" + dims.CHALLENGE_URL) | ((F.length(low) < 15000) & low.rlike("captcha|slider")), say("maybe", "bot check or login wall")),
        (ali & ~at.contains("/item/"), say("no", "redirected off the product page")),
        (ali & (F.trim(og) != ""), say("yes", "listing has a title")),
        (ali & (rendered != "") & ~F.lower(rendered).isin("aliexpress", "aliexpress.com"), say("yes", "rendered page has a product title")),
        (ali & (og.isNotNull() | title.isNotNull()), say("no", "listing has no title (removed)")),
        (ali, say("maybe", "no og:title tag - page format may have changed")),
        (amazon & vis.rlike(any_of(dims.WALL_TEXT[:2])), say("maybe", "bot check or login wall")),
        (amazon & vis.rlike(any_of(dims.AMAZON_DEAD)), say("no", "amazon 404 page")),
        (amazon & low.rlike("producttitle|add to cart") & vis.contains("currently unavailable"), say("yes", "product page - currently unavailable")),
        (amazon & low.rlike("producttitle|add to cart"), say("yes", "product page")),
        (amazon, say("maybe", "not recognisably a product page")),
        (distributor & vis.contains("no longer available"), say("no", "distributor says the part is no longer available")),
        (
            distributor & vis.rlike("part status[^a-z]{0,40}(obsolete|discontinued|last time buy|not for new designs)"),
            say("yes", "product page - part status is obsolete/discontinued"),
        ),
        (vis.rlike(any_of(dims.WALL_TEXT)), say("maybe", "bot check or login wall")),
        (low.rlike(dims.DEAD_TITLE) | vis.rlike(any_of(dims.DEAD_TEXT)), say("no", "page says the listing is gone")),
        (code.isNull(), say("maybe", "no http code")),
        (code != 200, say("maybe", http)),
        (F.length(low) < 500, say("maybe", "response too short to judge")),
    ]
    out = F.when(*rules[0])
    for condition, value in rules[1:]:
        out = out.when(condition, value)
    return out.otherwise(say("yes", "http 200"))


def unfetched(url: Column) -> Column:
    """Reason not to fetch a link at all, or null."""
    host = host_of(url)
    return F.when(host_in(host, dims.SKIP_HOSTS), "skipped - bot check cannot be cleared").when(host.isin(dims.BLOCKED_HOSTS), "host refuses automated requests")
