"""Secret scan with corpus-wide ownership frequency.

Candidates are the values of the fixed patterns and any other long token that mixes
letters and digits at random. Their hashes are aggregated over the corpus by distinct
repositories and owners: a value that many of them hold is a copied example, one that
stays with few owners looks live. Live-looking tokens outside the fixed patterns are
added as spans of kind `live`.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, stage
from .pii import named
from .spans import SECRET_KINDS, credentials, digest
from .tokens import chunks, words

_FOUND = (
    "doc_id long, owner string, repo string, counts array<bigint>, base_sha256 string, "
    "found array<struct<s: bigint, k: int, e: bigint>>, candidates array<struct<h: bigint, s: bigint, k: int, e: bigint>>"
)
_TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
_KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_DIGITS = np.zeros(256, dtype=np.int64)
_DIGITS[48:58] = 1
_NONE = digest([], SECRET_KINDS)


def entropy(value: str) -> float:
    """Bits per character."""
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def random_tokens(text: str, least_bits: float) -> list[tuple[int, int, int, str]]:
    out = []
    for m in _TOKEN.finditer(text):
        v = m[0]
        digits = sum("0" <= c <= "9" for c in v)
        if 3 <= digits < len(v) - 3 and entropy(v) >= least_bits:
            out.append((m.start(), 3, m.end(), v))
    return out


def _suspects(buf: np.ndarray, offs: np.ndarray) -> set[int]:
    """Documents of a chunk that can hold a candidate."""
    doc, s, e, _ = words(buf, offs, hashes=False)
    digits = np.concatenate([[0], np.cumsum(_DIGITS[buf])])
    size = e - s
    return set(doc[(size >= 32) | ((size >= 16) & (digits[e] > digits[s]))].tolist())


def _apart(tokens, spans) -> list:
    """Those of `tokens` that overlap none of `spans`; both start with start, kind and end."""
    spans = sorted(spans)
    starts, ends = [b[0] for b in spans], list(accumulate((b[2] for b in spans), max))
    last = [bisect_left(starts, t[2]) - 1 for t in tokens]  # the last span that starts before the token's end
    return [t for t, i in zip(tokens, last, strict=True) if i < 0 or ends[i] <= t[0]]


def _find(least_bits: float):
    def run(batches):
        for batch in batches:
            rows = batch.num_rows
            counts, shas, found, cands = [[0, 0, 0]] * rows, [_NONE] * rows, [[]] * rows, [[]] * rows
            texts = batch["text"]
            for lo, hi, buf, offs in chunks(texts):
                likely = _suspects(buf, offs)
                raw = buf.tobytes()
                low = raw.lower()
                if b"AKIA" in raw or any(w in low for w in _KEYWORDS):
                    for i in range(hi - lo):
                        if i not in likely:
                            part = low[offs[i] : offs[i + 1]]
                            if any(w in part for w in _KEYWORDS) or b"akia" in part:
                                likely.add(i)
                for i in likely:
                    text = texts[lo + i].as_py()
                    base = credentials(text)
                    more = _apart(random_tokens(text, least_bits), base)
                    if base:
                        counts[lo + i] = [sum(b[1] == k for b in base) for k in range(3)]
                        shas[lo + i] = digest(base, SECRET_KINDS)
                        found[lo + i] = [{"s": s, "k": k, "e": e} for s, k, e, _ in base]
                    cands[lo + i] = [
                        {"h": int.from_bytes(hashlib.sha256(v.encode()).digest()[:8], "little", signed=True), "s": s, "k": k, "e": e} for s, k, e, v in [*base, *more]
                    ]
            span = [("s", pa.int64()), ("k", pa.int32()), ("e", pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in ("doc_id", "owner", "repo")), pa.array(counts, pa.list_(pa.int64())), pa.array(shas), pa.array(found, pa.list_(pa.struct(span))), pa.array(cands, pa.list_(pa.struct([("h", pa.int64()), *span])))],
                ["doc_id", "owner", "repo", "counts", "base_sha256", "found", "candidates"],
            )

    return run


def scan(docs: DataFrame, *, owner: str | None = "source", repo: str | None = None, max_owners: int = 2, max_repos: int = 4, least_bits: float = 3.3) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_example) per row of
    `docs` (doc_id, text, and the columns named by owner and repo; without repo the owner
    is the repository). A candidate is live if at most max_owners owners and max_repos
    repositories hold it, otherwise an example.

    Null and empty texts have no span; a null owner counts as an owner of its own. Repeated
    rows give equal rows and count once per owner. A null doc_id stays null. Other columns
    are ignored; an empty table gives an empty result."""
    spark = docs.sparkSession
    prepare(spark)
    by = F.coalesce(F.col(owner).cast("string"), F.lit("")) if owner in docs.columns else F.lit("")
    at = F.coalesce(F.col(repo).cast("string"), F.lit("")) if repo in docs.columns else by
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), by.alias("owner"), at.alias("repo"))
    found = stage(docs.mapInArrow(_find(least_bits), _FOUND).withColumn("key", F.monotonically_increasing_id()))  # a number for each row
    held = found.where("size(candidates) > 0").select("key", "owner", "repo", F.explode("candidates").alias("c")).select("key", "owner", "repo", "c.*")
    owners = held.select("h", "owner", "repo").distinct().groupBy("h").agg(F.count_distinct("owner").alias("owners"), F.count_distinct("repo").alias("repos"))
    live = (F.col("owners") <= max_owners) & (F.col("repos") <= max_repos)
    judged = held.select("key", "h", "s", "k", "e").join(owners, "h").withColumn("live", live)
    per_doc = judged.groupBy("key").agg(
        F.count_if("live").alias("n_live"),
        F.count_if(~F.col("live")).alias("n_example"),
        F.collect_list(F.when(F.col("live") & (F.col("k") == SECRET_KINDS.index("live")), F.struct("s", "k", "e"))).alias("extra"),
    )
    out = found.drop("candidates").join(per_doc, "key", "left")
    out = out.withColumn("cuts", F.when(F.size("extra") > 0, F.array_sort(F.concat("found", "extra"))).otherwise(F.col("found")))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return named(out, SECRET_KINDS).select("doc_id", *(F.col("counts")[i].alias(f"n_{k}") for i, k in enumerate(SECRET_KINDS[:3])), "base_sha256", "spans", zero("n_live"), zero("n_example"))
