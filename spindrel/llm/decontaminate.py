"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

A first pass counts over all documents in how many each n-gram of the test items stands.
An item's seeds are its n-grams that few documents hold, and in any case those held by at
most twice as many as its median one, so that an item that leaked everywhere keeps seeds.
An item of fewer than n words is its own seed, if it is rare. A second pass joins seeds to
passages and aligns each item with the words around its seeds; the score is the local
alignment's share of a perfect one. Both passes are map-side: only the items travel, in
blocks of at most BLOCK_SEEDS n-grams, one pair of passes for each block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, to_driver
from .tokens import chunks, text_buffers, windows, words

BLOCK_SEEDS = 1 << 20
#: An n-gram that no more documents hold is rare, however small the corpus.
ALWAYS_RARE = 20
MATCH, MISMATCH, GAP = 2, -1, -1


class Items:
    """Test items of one block: word hashes, and their n-grams sorted by hash."""

    def __init__(self, ids: list, texts: list[str], n: int):
        raw, offs = text_buffers(pa.array(texts, pa.string()))
        doc, _, _, h = words(raw, offs, lower=True)
        self.ids, self.n = ids, n
        self.words = [h[a:b] for a, b in zip(*(np.searchsorted(doc, np.arange(len(ids)) + k) for k in (0, 1)), strict=True)]
        size = np.array([len(w) for w in self.words], dtype=np.int64)
        found = [(k, *windows(doc, h, k)) for k in range(1, n + 1)]
        found = [(at[use], wh[use]) for k, at, wh in found for use in ((size[doc[at]] == k) if k < n else np.ones(len(at), bool),)]
        at, wh = (np.concatenate(x) for x in zip(*found, strict=True))
        begin = np.searchsorted(doc, np.arange(len(ids)))
        order = np.lexsort((at, doc[at], wh)) if len(at) else at
        self.hash, self.item, self.place = wh[order], doc[at][order], (at - begin[doc[at]])[order]
        self.grams = np.unique(self.hash)
        self.short = size < n
        self._index()

    def _index(self):
        size = np.array([len(w) for w in self.words], dtype=np.int64)[self.item]
        self.sizes = np.unique(np.minimum(size, self.n)).tolist()
        self.maybe = np.zeros(1 << 16, dtype=bool)
        self.maybe[(self.grams >> np.uint64(48)).astype(np.int64)] = True

    def rare(self, df: np.ndarray, total: int, per_mille: float) -> None:
        """Keeps seeds only; df: documents of each of `grams`."""
        n = df[np.searchsorted(self.grams, self.hash)]
        order = np.lexsort((n, self.item))
        own, first, count = np.unique(self.item[order], return_index=True, return_counts=True)
        half = np.zeros(len(self.ids), dtype=np.int64)
        half[own] = n[order][first + (count - 1) // 2]
        half[self.short] = 0
        keep = (1000 * n <= per_mille * total) | (n <= ALWAYS_RARE) | (n <= 2 * half[self.item])
        self.hash, self.item, self.place = self.hash[keep], self.item[keep], self.place[keep]
        self.grams = np.unique(self.hash)
        self._index()

    def hits(self, doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first word, number in grams) of each n-gram of the text that is one of ours."""
        firsts, numbers = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for k in self.sizes:
            at, wh = windows(doc, h, k)
            ok = self.maybe[(wh >> np.uint64(48)).astype(np.int64)]
            at, wh = at[ok], wh[ok]
            g = np.minimum(np.searchsorted(self.grams, wh), len(self.grams) - 1)
            ok = self.grams[g] == wh
            firsts.append(at[ok])
            numbers.append(g[ok])
        return np.concatenate(firsts), np.concatenate(numbers)


def smith_waterman(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """(best local alignment score with linear gaps, end of the alignment in text)."""
    index = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, dtype=np.int64)
    best, end = 0, 0
    for w in item:
        new = np.maximum(row + GAP, 0)
        new[1:] = np.maximum(new[1:], row[:-1] + np.where(text == w, MATCH, MISMATCH))
        row = np.maximum.accumulate(new - GAP * index) + GAP * index
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
    return best, end


def _aligned(items: Items, doc: np.ndarray, h: np.ndarray, least: float, enough: int):
    """(document, item, score, end word, seeds) of every item found in every document."""
    at, g = items.hits(doc, h)
    if not len(at):
        return
    lo = np.searchsorted(items.hash, items.grams[g], "left")
    many = np.searchsorted(items.hash, items.grams[g], "right") - lo
    row = np.arange(int(many.sum())) - np.repeat(np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.repeat(lo, many)
    at = np.repeat(at, many)
    item, start, d = items.item[row], at - items.place[row], doc[at]
    order = np.lexsort((start, item, d))
    at, item, start, d = at[order], item[order], start[order], d[order]
    new = np.concatenate([[True], (d[1:] != d[:-1]) | (item[1:] != item[:-1])])
    first = np.flatnonzero(new)
    for a, b in zip(first.tolist(), np.append(first[1:], len(at)).tolist(), strict=True):
        i, x = int(item[a]), int(d[a])
        begin, end = (int(v) for v in np.searchsorted(doc, [x, x + 1]))
        size = len(items.words[i])
        pad = size // 3 + 3
        best, where, to = 0, 0, begin
        at_lo = None
        regions = []
        for s in start[a:b].tolist():
            lo_, hi_ = max(begin, s - pad), min(end, s + size + pad)
            if at_lo is not None and lo_ <= regions[-1][1]:
                regions[-1][1] = max(regions[-1][1], hi_)
            else:
                regions.append([lo_, hi_])
                at_lo = lo_
        for lo_, hi_ in regions:
            score, to = smith_waterman(items.words[i], h[lo_:hi_])
            if score > best:
                best, where = score, lo_ + to - begin
        if best >= MATCH * min(least * size, enough):
            yield x, i, best / (MATCH * size), where, b - a


def _counted(shared):
    def run(batches):
        items = shared.value
        n = np.zeros(len(items.grams), dtype=np.int64)
        for batch in batches:
            for _, _, buf, offs in chunks(batch["text"]):
                doc, _, _, h = words(buf, offs, lower=True)
                at, g = items.hits(doc, h)
                if len(at):
                    n += np.bincount(np.unique(doc[at].astype(np.int64) * len(n) + g) % len(n), minlength=len(n))
        own = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(n[own], pa.int64())], ["gram", "n"])

    return run


def _matches(shared, least: float, enough: int):
    def run(batches):
        items = shared.value
        for batch in batches:
            for lo, _, buf, offs in chunks(batch["text"]):
                doc, _, _, h = words(buf, offs, lower=True)
                found = list(_aligned(items, doc, h, least, enough))
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch["doc_id"].take(pa.array([lo + f[0] for f in found])),
                            pa.array([items.ids[f[1]] for f in found], pa.int64()),
                            *(pa.array([f[k] for f in found]) for k in (2, 3, 4)),
                        ],
                        ["doc_id", "item_id", "score", "end_word", "n_seeds"],
                    )

    return run


def _clean(shared, least: float, enough: int):
    def run(batches):
        items = shared.value
        for batch in batches:
            keep = np.ones(batch.num_rows, dtype=bool)
            for lo, _, buf, offs in chunks(batch["text"]):
                doc, _, _, h = words(buf, offs, lower=True)
                for f in _aligned(items, doc, h, least, enough):
                    keep[lo + f[0]] = False
            yield batch.filter(pa.array(keep))

    return run


def _blocks(docs: DataFrame, benchmark: DataFrame, n: int, per_mille: float):
    """Broadcast Items with their seeds chosen, a block of the benchmark at a time."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null").distinct()
    size = items.agg(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_SEEDS))
    total = docs.count()
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).orderBy("item_id", "text").collect()
        block = Items([r[0] for r in rows], [r[1] for r in rows], n)
        if not len(block.grams):
            continue
        counts = docs.select("text").mapInArrow(_counted(spark.sparkContext.broadcast(block)), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
        df = np.zeros(len(block.grams), dtype=np.int64)
        grams, n = to_driver(counts)  # a row for each of the block's n-grams at most
        df[grams] = n
        block.rare(df, total, per_mille)
        yield spark.sparkContext.broadcast(block)


def find_leaks(docs: DataFrame, benchmark: DataFrame, *, n: int = 3, per_mille: float = 1.0, least: float = 0.5, enough: int = 50) -> DataFrame:
    """(doc_id, item_id, score, end_word, n_seeds): each item of `benchmark` (item_id, text)
    that stands in a row of `docs` (doc_id, text), whole or edited: its alignment has at
    least `least` of a perfect score, or of the score of `enough` words in a row where the
    item is so long that this is less. Words are lower-cased (A-Z) runs outside ASCII white
    space.

    Null and empty texts match nothing. An item of fewer than n words is found only if at
    most `per_mille` of the documents (or ALWAYS_RARE) hold it. Repeated rows give repeated
    results; items with equal text give a row each. Null ids stay null. Other columns are
    ignored; an empty table on either side gives an empty result."""
    prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, item_id long, score double, end_word long, n_seeds long"
    out = docs.sparkSession.createDataFrame([], schema)
    for shared in _blocks(docs, benchmark, n, per_mille):
        out = out.unionAll(docs.mapInArrow(_matches(shared, least, enough), schema))
    return out


def drop_leaked(docs: DataFrame, benchmark: DataFrame, *, n: int = 3, per_mille: float = 1.0, least: float = 0.5, enough: int = 50) -> DataFrame:
    """`docs` without the rows in which find_leaks() finds an item; all columns stay as they
    are, whatever their names. Null and empty texts stay; repeated rows stay or go together;
    with an empty table on either side nothing goes."""
    prepare(docs.sparkSession)
    for shared in _blocks(docs, benchmark, n, per_mille):
        docs = docs.mapInArrow(_clean(shared, least, enough), docs.schema)
    return docs
