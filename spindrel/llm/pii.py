"""Information-theoretic sanitisation of personal data.

Protected entities are the values of the fixed patterns (email, ip, card, phone). For
each, the words of all documents that mention it are counted over the corpus: joint
documents of (entity, term) against all documents of the term. A term whose share
p(entity | term) reaches `disclosure`, in at least `support` different contexts and with
positive pointwise information about the entity, gives the entity away even when its
value is masked, and is masked wherever it stands in those documents, as kind `term`.
The context of an entity in a document is the words next to its first mention there, so
that copies of one passage are one context.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bitmap, fresh, in_bitmap, prepare, stage
from .spans import PII_KINDS, digest, personal
from .tokens import chunks, text_buffers, words

_SPANS = "array<struct<s: bigint, k: int, e: bigint>>"
_FOUND = f"key long, doc_id long, counts array<bigint>, base_sha256 string, found {_SPANS}, seen array<struct<entity: bigint, context: bigint>>"
_MARK = np.zeros(256, dtype=bool)
_MARK[[43, 64, *range(48, 58)]] = True
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_NONE = digest([], PII_KINDS)


def _hash(s: str) -> int:
    return int.from_bytes(hashlib.blake2b(s.encode(), digest_size=8).digest(), "little", signed=True)


def _around(text: str, spans, reach: int, least: int) -> dict[int, int]:
    """The context of each entity: the words near its first mention, or else the text."""
    out = {}
    starts, ends = [s for s, _, _ in spans], list(accumulate((e for _, _, e in spans), max))

    def free(a, b):
        last = bisect_left(starts, b) - 1  # the last span that starts before b, and the furthest end up to it
        return last < 0 or ends[last] <= a

    for s, k, e in spans:
        entity = _hash(f"{PII_KINDS[k]}:{text[s:e].lower()}")
        if entity in out:
            continue
        near = []
        lo = max(0, s - 64 * reach)
        for side, at, part in ((0, lo, text[lo:s]), (1, e, text[e : e + 64 * reach])):
            own = []
            for m in _WORD.finditer(part):
                a, b = at + m.start(), at + m.end()
                if b - a >= least and free(a, b):
                    own.append((a, b))
            if not side and own and own[0][0] == lo and lo:
                own = own[1:]  # may be the end of a longer word
            if side and own and own[-1][1] == e + 64 * reach:
                own = own[:-1]
            near += own[-reach:] if not side else own[:reach]
        out[entity] = _hash(" ".join(text[a:b].lower() for a, b in near) if near else text)
    return out


def _terms(text: str, spans, least: int):
    """(term, start, end) of every word of the text that is long enough and outside spans."""
    raw, offs = text_buffers(pa.array([text], pa.string()))
    _, s, e, h = words(raw, offs, lower=True)
    points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    s, e = points[s], points[e]
    starts, ends = np.array([x for x, _, _ in spans]), np.maximum.accumulate([y for _, _, y in spans])
    before = np.searchsorted(starts, e) - 1  # the last span that starts before the word's end
    ok = (e - s >= least) & ((before < 0) | (ends[before] <= s))
    return h.view(np.int64)[ok], s[ok], e[ok]


def _mentioning(bits, texts):
    """(row, text, spans) of the texts that may mention an entity of the bitmap."""
    for lo, _, buf, offs in chunks(texts):
        hit = np.flatnonzero(_MARK[buf])
        for i in np.unique(np.searchsorted(offs, hit, "right") - 1).tolist():
            text = texts[lo + i].as_py()
            spans = personal(text)
            held = {_hash(f"{PII_KINDS[k]}:{text[s:e].lower()}") for s, k, e in spans}
            if held and in_bitmap(bits, np.array([*held])).any():
                yield lo + i, text, spans


def _columns(parts, names):
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts, strict=True)], names)


def _pairs(bits, reach: int, least: int):
    """(entity, term, context) of every entity of the bitmap and distinct term of a text."""
    names = ["entity", "term", "context"]

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for _, text, spans in _mentioning(bits.value, batch.column(0)):
                terms = np.unique(_terms(text, spans, least)[0])
                for entity, context in _around(text, spans, reach, least).items():
                    if len(terms) and in_bitmap(bits.value, np.array([entity])).all():
                        held.append((np.full(len(terms), entity), terms, np.full(len(terms), context)))
                        size += len(terms)
                    if size > 1 << 18:
                        yield _columns(held, names)
                        held, size = [], 0
        if held:
            yield _columns(held, names)

    return run


def _spots(entities, bits, least: int):
    """(key, id, entity, term, s, e) of every occurrence of a pair that may be a risky one."""

    def run(batches):
        held, size = [], 0
        for batch in batches:
            keys, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for i, text, spans in _mentioning(entities.value, batch.column(2)):
                terms, s, e = _terms(text, spans, least)
                held_here = np.array([*{_hash(f"{PII_KINDS[k]}:{text[x:y].lower()}") for x, k, y in spans}])
                for entity in held_here[in_bitmap(entities.value, held_here)].tolist():
                    at = np.flatnonzero(in_bitmap(bits.value, terms ^ np.int64(entity)))
                    if len(at):
                        held.append((np.full(len(at), keys[i]), np.full(len(at), ids[i]), np.full(len(at), entity), terms[at], s[at], e[at]))
                        size += len(at)
                    if size > 1 << 18:
                        yield _columns(held, ["key", "id", "entity", "term", "s", "e"])
                        held, size = [], 0
        if held:
            yield _columns(held, ["key", "id", "entity", "term", "s", "e"])

    return run


def _find(reach: int, least: int):
    def run(batches):
        for batch in batches:
            keys, ids, texts = batch.columns
            rows = batch.num_rows
            counts, shas, found, seen = [[0, 0, 0, 0]] * rows, [_NONE] * rows, [[]] * rows, [[]] * rows
            for lo, hi, buf, offs in chunks(texts):
                hit = np.flatnonzero(_MARK[buf])
                for i in np.unique(np.searchsorted(offs, hit, "right") - 1).tolist():
                    text = texts[lo + i].as_py()
                    spans = personal(text)
                    if spans:
                        counts[lo + i] = [sum(s[1] == k for s in spans) for k in range(4)]
                        shas[lo + i] = digest(spans, PII_KINDS)
                        found[lo + i] = [{"s": s, "k": k, "e": e} for s, k, e in spans]
                        seen[lo + i] = [{"entity": x, "context": c} for x, c in _around(text, spans, reach, least).items()]
            span = pa.list_(pa.struct([("s", pa.int64()), ("k", pa.int32()), ("e", pa.int64())]))
            near = pa.list_(pa.struct([(c, pa.int64()) for c in ("entity", "context")]))
            yield pa.RecordBatch.from_arrays(
                [keys, ids, pa.array(counts, pa.list_(pa.int64())), pa.array(shas), pa.array(found, span), pa.array(seen, near)],
                ["key", "doc_id", "counts", "base_sha256", "found", "seen"],
            )

    return run


def _documents_of_terms(least: int):
    """(term, n): in how many texts of a task each word of at least so many bytes stands."""

    def rows(held):
        u, at = np.unique(np.concatenate([h for h, _ in held]), return_inverse=True)
        n = np.bincount(at, np.concatenate([n for _, n in held]), minlength=len(u)).astype(np.int64)
        return u, n

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for _, _, buf, offs in chunks(batch.column(0)):
                doc, s, e, h = words(buf, offs, lower=True)
                ok = e - s >= least
                doc, h = doc[ok], h[ok]
                if len(h):
                    order = np.lexsort((h, doc))
                    doc, h = doc[order], h[order]
                    new = np.ones(len(h), dtype=bool)
                    new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
                    held.append(np.unique(h[new], return_counts=True))
                    size += len(held[-1][0])
            if size > 1 << 21:
                held = [rows(held)]
                size = len(held[0][0])
                if size > 1 << 20:  # more terms than a task should hold: hand them on
                    yield pa.RecordBatch.from_arrays([pa.array(held[0][0].view(np.int64)), pa.array(held[0][1])], ["term", "n"])
                    held, size = [], 0
        if held:
            u, n = rows(held)
            yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(n)], ["term", "n"])

    return run


def find_spans(docs: DataFrame, *, reach: int = 8, least: int = 4, support: int = 2, disclosure: float = 0.5) -> DataFrame:
    """(key, doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, cuts) per row of
    `docs` (doc_id, text). `spans` has all spans as kind:start:end by start and kind, `cuts`
    the same as structs; `key` identifies (doc_id, text). Offsets count code points.

    Null and empty texts have no span. Repeated rows give equal rows, and count as one
    context but as documents each. A null doc_id stays null. Other columns are ignored; an empty table gives an
    empty result."""
    spark = docs.sparkSession
    prepare(spark)
    docs = keyed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")))
    found = stage(docs.select("key", "doc_id", "text").mapInArrow(_find(reach, least), _FOUND))
    of_entity = stage(
        found.select(F.explode("seen").alias("x")).groupBy("x.entity").agg(F.count("*").alias("mentions"), F.count_distinct("x.context").alias("contexts"))
        .where(F.col("contexts") >= support).select("entity", "mentions")
    )
    entities = spark.sparkContext.broadcast(bitmap(of_entity, "entity"))
    pairs = stage(
        docs.select("text").mapInArrow(_pairs(entities, reach, least), "entity long, term long, context long")
        .groupBy("entity", "term", "context").agg(F.count("*").alias("docs"))
        .groupBy("entity", "term").agg(F.count("*").alias("contexts"), F.sum("docs").alias("both"))
        .where(F.col("contexts") >= support)
    )
    df = docs.select("text").mapInArrow(_documents_of_terms(least), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    total = found.count()
    share = F.col("both") / F.greatest("n", "both")
    risky = stage(
        pairs.join(df, "term").join(of_entity, "entity")
        .where((share >= disclosure) & (F.log2(share * F.lit(float(total)) / F.col("mentions")) > 0))
        .select("entity", "term")
    )
    near = spark.sparkContext.broadcast(bitmap(risky.select(F.col("entity").bitwiseXOR(F.col("term")).alias("pair")), "pair"))
    extra = (
        docs.select("key", _id("doc_id"), "text").mapInArrow(_spots(entities, near, least), "key long, id long, entity long, term long, s long, e long")
        .join(risky, ["entity", "term"]).groupBy("key", "id")
        .agg(F.collect_set(F.struct("s", F.lit(PII_KINDS.index("term")).alias("k"), "e")).alias("extra"))
    )
    cuts = F.when(F.col("extra").isNull(), F.col("found")).otherwise(F.array_sort(F.concat("found", "extra")))
    return named(found.drop("seen").withColumn("id", _id("doc_id")).join(extra, ["key", "id"], "left").withColumn("cuts", cuts), PII_KINDS).select(
        "key", "doc_id", *(F.col("counts")[i].alias(f"n_{k}") for i, k in enumerate(PII_KINDS[:4])), "base_sha256", "spans", "cuts"
    )


def _id(doc_id: str):
    """doc_id as a column to join on, without nulls (keys of null and 0 differ anyway)."""
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(0).cast("long")).alias("id")


def keyed(docs: DataFrame, name: str = "key") -> DataFrame:
    """All columns, and a hash of (doc_id, text). Rows are joined on it and doc_id together,
    so only different texts under one doc_id could ever be taken for each other."""
    return docs.select(*(c for c in docs.columns if c != name), F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")).alias(name))


def named(df: DataFrame, kinds) -> DataFrame:
    """Adds `spans`, the text form of the sorted structs `cuts`."""
    names = ", ".join(f"'{k}'" for k in kinds)
    return df.withColumn("spans", F.expr(f"array_join(transform(cuts, x -> concat(element_at(array({names}), x.k + 1), ':', x.s, ':', x.e)), ',')"))


def mask(text: str, cuts) -> str:
    """The text with each span, or run of overlapping spans, replaced by its kind in brackets."""
    out, at = [], 0
    for s, k, e in cuts:
        if s >= at:
            out += [text[at:s], f"[{PII_KINDS[k].upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def _masked(cuts: str):
    def run(batches):
        for batch in batches:
            texts = [mask(t, [(c["s"], c["k"], c["e"]) for c in own]) if t else t for t, own in zip(batch["text"].to_pylist(), batch[cuts].to_pylist(), strict=True)]
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, "text", pa.array(texts, pa.string())).drop_columns([cuts])

    return run


def _split(bits, want: bool, key: str):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(in_bitmap(bits.value, batch[key].to_numpy()) == want))

    return run


def sanitise(docs: DataFrame, **options) -> DataFrame:
    """`docs` with the spans of find_spans() masked in `text`, a run of overlapping spans by
    the kind of its first in brackets; every other column and row stays as it is, whatever
    its name. Only texts that may have a span are moved.

    Null and empty texts stay; repeated rows are masked alike; a null doc_id stays null. An
    empty table gives an empty result."""
    spark = docs.sparkSession
    names = docs.columns
    key, number, cuts = (fresh(names, c) for c in ("pii_key", "pii_id", "pii_cuts"))
    found = find_spans(docs, **options).where("size(cuts) > 0")
    held = stage(found.select(F.col("key").alias(key), _id("doc_id").alias(number), F.col("cuts").alias(cuts)).dropDuplicates([key, number]))
    bits = spark.sparkContext.broadcast(bitmap(held, key))
    docs = keyed(docs, key)
    clean = docs.mapInArrow(_split(bits, False, key), docs.schema).select(*names)
    marked = docs.mapInArrow(_split(bits, True, key), docs.schema).withColumn(number, _id("doc_id")).join(held, [key, number], "left")
    marked = marked.withColumn(cuts, F.coalesce(cuts, F.expr(f"cast(array() as {_SPANS})")))
    return clean.unionAll(marked.mapInArrow(_masked(cuts), marked.drop(cuts).schema).select(*names))
