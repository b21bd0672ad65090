"""Removal of word passages that repeat anywhere in the corpus.

Each window of `window` words gets a Rabin-Karp hash of 64 bits, and 32 bits of a second
one. A map task gathers windows of about CHUNK_WINDOWS into a chunk and sends every
distinct hash of the chunk once, to one of many buckets by hash range; what a chunk
repeats by itself it knows already, so a passage that a third of the corpus shares is one
row per chunk. There is a bucket for each BUCKET_BYTES of text, so that one holds a million
windows or two whatever the size of the corpus, and each is a partition of its own. A
bucket counts its hashes and answers each chunk with the positions of its repeated
windows; these merge into maximal intervals per document. Texts are only moved for
documents that lose words.

Windows are equal if all 96 bits are: 1e10 windows (60 GB of text) have 6e-10 false pairs
expected, 1e13 (60 TB) 6e-4.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bitmap, bounds, complete_groups, in_bitmap, partitions, prepare, stage
from .tokens import chunks, more_bits, windows, words

#: Windows that a map task holds at once.
CHUNK_WINDOWS = 1 << 20
#: Text bytes whose windows share a bucket.
BUCKET_BYTES = 8 << 20
#: Bits of the first hash (tests take few, so that it collides).
HASH_BITS = 64
_U = np.uint64
_KNOWN = 0xFFFFFF  # in three bytes: the chunk knows that this window repeats
_PIECES = "bucket int, chunk long, hashes binary, more binary, places binary, docs binary"


def _packed(h: np.ndarray) -> bytes:
    """Sorted 64-bit hashes as steps of six bytes where they fit."""
    step = np.diff(h)
    if len(step) and int(step.max()) >> 48:
        return b"\0" + h.tobytes()
    six = step.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
    return b"\1" + h[:1].tobytes() + six.tobytes()


def _unpacked(b: bytes) -> np.ndarray:
    if not b[0]:
        return np.frombuffer(b, dtype=np.uint64, offset=1)
    six = np.frombuffer(b, dtype=np.uint8, offset=9).reshape(-1, 6)
    step = np.zeros((len(six), 8), dtype=np.uint8)
    step[:, :6] = six
    return np.cumsum(np.concatenate([np.frombuffer(b, dtype=np.uint64, count=1, offset=1), step.view("<u8").ravel()]), dtype=np.uint64)


def _three(places: np.ndarray) -> bytes:
    return places.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3].tobytes()


def _places(parts: list[bytes]) -> np.ndarray:
    three = np.frombuffer(b"".join(parts), dtype=np.uint8).reshape(-1, 3)
    four = np.zeros((len(three), 4), dtype=np.uint8)
    four[:, :3] = three
    return four.view("<u4").ravel()


def _runs(h: np.ndarray, more: np.ndarray):
    """(order, start of each run in it) of equal windows; places in a run ascend."""
    order = np.argsort(h, kind="stable")
    s, m = h[order], more[order]
    if ((s[1:] == s[:-1]) & (m[1:] != m[:-1])).any():  # two windows under one hash
        order = np.lexsort((more, h))
        s, m = h[order], more[order]
    new = np.ones(len(s), dtype=bool)
    new[1:] = (s[1:] != s[:-1]) | (m[1:] != m[:-1])
    return order, np.flatnonzero(new)


def _pieces(window: int, buckets: int):
    """Windows of (key, id, text) rows as pieces for the buckets, and one row per chunk that
    holds its documents and the places it knows to repeat."""
    edges = np.array([(i << 64) // buckets for i in range(1, buckets)], dtype=np.uint64)
    names = [c.split()[0] for c in _PIECES.split(", ")]

    def flush(chunk, layout, held):
        h, more = (np.concatenate(x) for x in zip(*held, strict=True))
        order, at = _runs(h, more)
        n = np.diff(np.append(at, len(h)))
        known = np.sort(order[np.repeat(n > 1, n)])
        first = order[at]
        u, m, place = h[first], more[first], np.where(n > 1, _KNOWN, first)
        cut = np.concatenate([[0], np.searchsorted(u, edges), [len(u)]])
        own = np.flatnonzero(cut[1:] > cut[:-1]).tolist()
        parts = [(cut[i], cut[i + 1]) for i in own]
        none = [None] * len(own)
        docs = np.array(layout, dtype=np.int64).tobytes()
        rows = [
            pa.array([*own, chunk % buckets], pa.int32()),
            pa.array([chunk] * (len(own) + 1), pa.int64()),
            pa.array([*(_packed(u[a:b]) for a, b in parts), None], pa.binary()),
            pa.array([*(m[a:b].tobytes() for a, b in parts), None], pa.binary()),
            pa.array([*(_three(place[a:b]) for a, b in parts), _three(known)], pa.binary()),
            pa.array([*none, docs], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(rows, names)

    def run(batches):
        chunk = TaskContext.get().partitionId() << 24
        layout, held, size = [], [], 0
        for batch in batches:
            keys, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for lo, _, buf, offs in chunks(batch.column(2)):
                doc, _, _, h = words(buf, offs)
                at, wh = windows(doc, h, window)
                if not len(at):
                    continue
                wh, more = wh & _U((1 << HASH_BITS) - 1), more_bits(h, at, window)
                count = np.bincount(doc[at], minlength=len(offs) - 1)
                begin = np.concatenate([[0], np.cumsum(count)])
                for i in np.flatnonzero(count).tolist():
                    base = 0
                    while base < count[i]:
                        take = int(min(count[i] - base, CHUNK_WINDOWS - size))
                        x = begin[i] + base
                        layout.append((int(keys[lo + i]), int(ids[lo + i]), base, take))
                        held.append((wh[x : x + take], more[x : x + take]))
                        base, size = base + take, size + take
                        if size >= CHUNK_WINDOWS:
                            yield flush(chunk, layout, held)
                            chunk, layout, held, size = chunk + 1, [], [], 0
        if size:
            yield flush(chunk, layout, held)

    return run


def _answers(batches):
    """Of the pieces of a bucket (they are a partition) the repeated places, by chunk."""
    pieces = [t for b in batches for t in zip(*(b[c].to_pylist() for c in ("chunk", "hashes", "more", "places", "docs")), strict=True)]
    out: list[tuple[int, bytes | None, bytes]] = [(c, docs, places) for c, _, _, places, docs in pieces if docs is not None]
    pieces = [p for p in pieces if p[4] is None]
    if pieces:
        each = [_unpacked(p[1]) for p in pieces]
        owner = np.repeat(np.arange(len(each)), [len(x) for x in each])
        h, more = np.concatenate(each), np.frombuffer(b"".join(p[2] for p in pieces), dtype=np.uint32)
        del each
        place = _places([p[3] for p in pieces])
        chunk = [p[0] for p in pieces]
        del pieces
        order, at = _runs(h, more)
        n = np.diff(np.append(at, len(h)))
        hit = np.sort(order[np.repeat(n > 1, n)])
        hit = hit[place[hit] != _KNOWN]
        for x, y in zip(*(z.tolist() for z in bounds(owner[hit])), strict=True):
            out.append((chunk[owner[hit[x]]], None, _three(place[hit[x:y]])))
    kinds = (pa.int64(), pa.binary(), pa.binary())
    yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], k) for i, k in enumerate(kinds)], ["chunk", "docs", "places"])


def _intervals(window: int):
    """Per document (key, id) of a chunk its removal intervals, as pairs of int64 word numbers."""

    def run(batches):
        for t in complete_groups(batches, "chunk"):
            chunk, docs, places = t["chunk"].to_numpy(), t["docs"].to_pylist(), t["places"].to_pylist()
            keys, ids, spans = [], [], []
            for b, e in zip(*(x.tolist() for x in bounds(chunk)), strict=True):
                layout = np.frombuffer(next(d for d in docs[b:e] if d is not None), dtype=np.int64).reshape(-1, 4)
                at = np.sort(_places(places[b:e]).astype(np.int64))
                if not len(at):
                    continue
                begin = np.concatenate([[0], np.cumsum(layout[:, 3])])
                doc = np.searchsorted(begin, at, "right") - 1
                word = at - begin[doc] + layout[doc, 2]
                new = np.ones(len(at), dtype=bool)
                new[1:] = (doc[1:] != doc[:-1]) | (word[1:] > word[:-1] + window)
                first = np.flatnonzero(new)
                last = np.concatenate([first[1:], [len(at)]]) - 1
                pairs = np.stack([word[first], word[last] + window], 1)
                for x, y in zip(*(z.tolist() for z in bounds(doc[first])), strict=True):
                    keys.append(int(layout[doc[first[x]], 0]))
                    ids.append(int(layout[doc[first[x]], 1]))
                    spans.append(pairs[x:y].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(ids, pa.int64()), pa.array(spans, pa.binary())], ["key", "id", "spans"])

    return run


def merged(spans: list[bytes]) -> list[tuple[int, int]]:
    """Intervals, in order and without overlap, of what lists of intervals cover."""
    out: list[tuple[int, int]] = []
    for s, e in sorted({tuple(p) for x in spans for p in np.frombuffer(x, dtype=np.int64).reshape(-1, 2).tolist()}):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


_RESULT = "doc_id long, n_words long, n_removed long, kept_text string"


def _row(text: str | None, spans: list[bytes]):
    w = (text or "").encode().split()
    kept, at = [], 0
    for s, e in merged(spans):
        kept += w[at:s]
        at = e
    kept += w[at:]
    return len(w), len(w) - len(kept), b" ".join(kept)


def _finished(digest: bool, texts: int, spans: int | None, bits=None):
    """Result rows; with bits, only of documents that have no interval for certain."""

    def run(batches):
        for batch in batches:
            keys = batch.column(0).to_numpy()
            rows = range(batch.num_rows)
            if bits is not None and len(keys):
                rows = np.flatnonzero(~in_bitmap(bits.value, keys)).tolist()
            col, ids = batch.column(texts), batch.column(1)
            got = [_row(col[i].as_py(), (batch.column(spans)[i].as_py() or []) if spans is not None else []) for i in rows]
            last = [hashlib.sha256(g[2]).hexdigest() if digest else g[2].decode() for g in got]
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(list(rows), pa.int64())), pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.int64()), pa.array(last, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_text"],
            )

    return run


def _held_back(bits):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(in_bitmap(bits.value, batch.column(0).to_numpy())))

    return run


def remove_repeated(docs: DataFrame, *, window: int = 35, digest: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text) of every row of `docs` (doc_id, text): each
    word covered by a window of `window` words that also starts elsewhere, in the same
    document or another, is removed; kept words are joined by one space. With `digest`,
    kept_text is the lowercase hex SHA-256 of that text.

    Windows are judged on the input. Null, empty and shorter texts lose nothing. Repeated
    rows repeat each other's windows. A null doc_id stays null. Other columns are ignored;
    an empty table gives an empty result."""
    spark = docs.sparkSession
    prepare(spark)
    number, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    docs = docs.select(F.xxhash64(number, text).alias("key"), number.alias("doc_id"), text.alias("text"))
    number = F.coalesce("doc_id", F.lit(0).cast("long")).alias("id")  # rows are joined on key and id
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = min(1 << 30, max(partitions(spark), -(-size // BUCKET_BYTES)))
    pieces = docs.select("key", number, "text").mapInArrow(_pieces(window, buckets), _PIECES)
    answers = pieces.repartitionById(buckets, F.col("bucket")).mapInArrow(_answers, "chunk long, docs binary, places binary")
    answers = answers.repartition(partitions(spark), "chunk").sortWithinPartitions("chunk")
    spans = stage(answers.mapInArrow(_intervals(window), "key long, id long, spans binary"))
    bits = spark.sparkContext.broadcast(bitmap(spans, "key"))
    whole = docs.mapInArrow(_finished(digest, 2, None, bits), _RESULT)
    spans = spans.groupBy("key", "id").agg(F.collect_set("spans").alias("spans"))
    cut = docs.mapInArrow(_held_back(bits), docs.schema).withColumn("id", number).join(spans, ["key", "id"], "left")
    cut = cut.select("key", "doc_id", "text", "spans").mapInArrow(_finished(digest, 2, 3), _RESULT)
    return whole.unionAll(cut)
