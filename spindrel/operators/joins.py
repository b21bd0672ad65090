"""Join idioms: suffix look-ups, precedence, alignment, blocked and shared-link pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from ..functions.similarity import ratio, ratio_bound

# ---- fixed values: words that mark otherwise equal names as different parts
DISTINGUISHERS = [
    "shcs", "bhcs", "fhcs", "sbhcs", "cap", "grub", "set", "male", "female", "plug", "receptacle", "receptical", "housing", "pin", "brass", "steel", "hardened", "plated",
    "black", "silver", "x", "y", "z", "a", "b", "left", "right", "top", "bottom", "upper", "lower", "tpw", "ltp", "rcp", "av", "ah", "bh", "primary", "secondary",
    "short", "long", "tall", "open", "closed", "loop", "idler", "pulley", "nozzle", "12v", "24v",
]


def longest_suffix(df: DataFrame, host: str, suffixes: DataFrame) -> DataFrame:
    """`df` with vendor_id and vendor_name of the longest suffix (suffix, vendor_id,
    vendor_name) of its host; the host itself where none fits. Hosts are looked up once
    each, by equality with their own suffixes, whatever the size of either side."""
    hosts = df.select(host).where(F.col(host).isNotNull()).distinct()
    parts = F.split(F.col(host), r"\.")
    each = F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), ".")))
    table = suffixes.groupBy("suffix").agg(F.min_by(F.struct("vendor_id", "vendor_name"), "vendor_id").alias("_v"))
    found = hosts.select(host, each.alias("suffix")).join(table, "suffix").groupBy(host).agg(F.max_by("_v", F.length("suffix")).alias("_v"))
    own = F.nullif(F.col(host), F.lit(""))
    return df.join(found, host, "left").select(*df.columns, F.coalesce("_v.vendor_id", own).alias("vendor_id"), F.coalesce("_v.vendor_name", own).alias("vendor_name"))


def precedence(measured: DataFrame, manual: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value, origin) of both sides; the manual one wins."""
    m = manual.select(key, F.col(value).alias("_m"), F.lit(True).alias("_by_hand"))
    out = measured.select(key, value).join(m, key, "full_outer")
    return out.select(key, F.when(F.col("_by_hand"), F.col("_m")).otherwise(F.col(value)).alias(value), F.when(F.col("_by_hand"), "manual").otherwise("measured").alias("origin"))


def exclude_reviewed(pairs: DataFrame, a: str, b: str, reviewed: DataFrame) -> DataFrame:
    """`pairs` without those in `reviewed` (a, b), in either order."""
    done = reviewed.select(F.least("a", "b").alias("_x"), F.greatest("a", "b").alias("_y")).distinct()
    return pairs.join(done, (F.least(a, b) == F.col("_x")) & (F.greatest(a, b) == F.col("_y")), "left_anti")


def align(old: DataFrame, new: DataFrame, part: list[str], key: str, seq: str) -> DataFrame:
    """(part, key, old_seq, new_seq, change): old rows in order, then what only the new side
    has. Of equal new keys the last row's content counts, at the first one's place."""
    right = new.groupBy(*part, key).agg(F.min(seq).alias("new_seq"))
    left = old.select(*part, key, F.col(seq).alias("old_seq"))
    out = left.join(right, [*part, key], "full_outer")
    return out.withColumn("change", F.when(F.col("new_seq").isNull(), "removed").when(F.col("old_seq").isNull(), "added").otherwise("kept"))


def near_names(items: DataFrame, reviewed: DataFrame | None = None, *, threshold: float = 0.72, largest: int = 200, sequence: bool = True) -> DataFrame:
    """(id_a, id_b, score) of items (seq, id, key, base_key) with the same tokens that carry
    digits and otherwise similar names. Blocks of more than `largest` items are left out:
    that limit is part of the rule. Native tests come before the sequence ratio."""
    spec, words = text.spec_tokens(F.col("key")), text.tokens(F.col("key"))
    items = items.select("seq", "id", "key", "base_key", F.array_join(spec, " ").alias("block"), F.array_except(words, spec).alias("words"))
    small = items.groupBy("block").count().where(F.col("count").between(2, largest)).select("block")
    items = items.join(small, "block", "left_semi")
    a, b = (items.select("block", *(F.col(c).alias(f"{c}_{s}") for c in ("seq", "id", "key", "base_key", "words"))) for s in "ab")
    pairs = a.join(b, "block").where("seq_a < seq_b and not (base_key_a <=> base_key_b)")
    veto = F.array(*map(F.lit, DISTINGUISHERS))
    x, y = F.col("words_a"), F.col("words_b")
    pairs = pairs.where(~F.arrays_overlap(F.array_union(F.array_except(x, y), F.array_except(y, x)), veto))
    if reviewed is not None:
        pairs = exclude_reviewed(pairs, "base_key_a", "base_key_b", reviewed)
    pairs = pairs.withColumn("score", text.jaccard(x, y))
    if sequence:
        hopeful = (F.col("score") >= threshold) | (ratio_bound(F.col("key_a"), F.col("key_b")) >= threshold)
        pairs = pairs.where(hopeful).withColumn("score", F.greatest("score", ratio(F.col("key_a"), F.col("key_b"))))
    return pairs.where(F.col("score") >= threshold).select("id_a", "id_b", "score")


def shared_links(links: DataFrame, item: str, url: str, reviewed: DataFrame | None = None, *, least: int = 2, most: int = 4) -> DataFrame:
    """(a, b, n_urls) of items that share a url held by `least` to `most` items."""
    links = links.select(F.col(item).alias("_i"), F.col(url).alias("_u")).where("_i is not null and _u is not null").distinct()
    fan = links.groupBy("_u").count().where(F.col("count").between(least, most)).select("_u")
    links = links.join(fan, "_u", "left_semi")
    pairs = links.select("_u", F.col("_i").alias("a")).join(links.select("_u", F.col("_i").alias("b")), "_u").where("a < b")
    pairs = pairs.groupBy("a", "b").agg(F.count("*").alias("n_urls"))
    return pairs if reviewed is None else exclude_reviewed(pairs, "a", "b", reviewed)


def first_owner(names: DataFrame, key: str, owner: str, seq: str) -> DataFrame:
    """(key, owner): the first item that uses a spelling owns it."""
    return names.groupBy(key).agg(F.min_by(owner, seq).alias(owner))


def interval_lookup(cells: DataFrame, slots: DataFrame, part: str, at: str) -> DataFrame:
    """cells with the slot (part, start, end, slot) that covers column `at`."""
    slots = slots.select(F.col(part).alias("_p"), "start", "end", "slot")
    return cells.join(slots, (F.col(part) == F.col("_p")) & F.col(at).between(F.col("start"), F.col("end")), "left").drop("_p")


def scope_key(base_key: Column, by_family: Column, by_project: Column, family: Column, project: Column) -> Column:
    """Item key: split by family first, else by project, else shared."""
    return F.when(by_family, F.concat(base_key, F.lit(" @"), F.coalesce(family, project))).when(by_project, F.concat(base_key, F.lit(" @"), project)).otherwise(base_key)


def latest(df: DataFrame, keys: list[str], order: Column) -> DataFrame:
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    return df.withColumn("_n", n).where("_n = 1").drop("_n")
