"""Collocations: phrases of a language that occur more often than their parts suggest.

Two passes over the texts. The first adds every word and phrase of up to `longest` words to a
count-min sketch per task; the sketches are merged by Spark, slice by slice, into one bit a
cell: whether its count reaches `least`. A cell counts too much or just enough, never too
little, so a phrase with a cell below `least` is rare for certain. The second pass drops
those, and phrases that hold one of them; what survives is counted exactly, first in numpy by
word numbers (no hash decides what is equal), then by groupBy on the phrases. Nothing
frequent is lost, and nothing rare stays.

A sketch has two rows of a cell for each CELL_BYTES of text, so that what rare phrases add to a
cell stays far below `least`, up to MOST_CELLS (two bytes each in a task; 4 GB of text). Beyond
that it prunes less and less and the second pass moves more: the result is the same. There are as many
tasks as the cluster runs at once, or one for each TASK_BYTES of text if that is more, and each
has one sketch and one table of counts for all it reads, so that what moves does not grow with
the number of files.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, prepare, stage
from .tokens import mix, powers, text_buffers

#: Text bytes for each cell of a row of the sketch; least and most cells of a row.
CELL_BYTES, LEAST_CELLS, MOST_CELLS = 32, 1 << 16, 1 << 27
#: Cells that are merged, and kept as bits, together.
SLICE = 1 << 16
#: Text bytes whose phrases are counted at once.
CHUNK = 4 << 20
#: Text bytes that a task reads at most, and rows of counts that it holds.
TASK_BYTES, HELD = 4 << 30, 1 << 20
#: Updates of a sketch after which its counts are cut to HALF; 16 bits can't overflow.
HALF = (1 << 15) - 1
ROWS = 2
_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)

_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _parts(batches, size: int) -> Iterator[tuple[list[np.ndarray], list[str]]]:
    """Runs of about `size` bytes of (lang, text) rows: buffers and the language of each. A
    longer text is cut after a character that ends pieces, as no phrase goes across one."""
    bufs, langs, held = [], [], 0
    for batch in batches:
        raw, offs = text_buffers(batch.column(1))
        for i, lang in enumerate(batch.column(0).to_pylist()):
            buf = raw[offs[i] : offs[i + 1]]
            while len(buf):
                end = len(buf)
                if end > size:
                    after = np.flatnonzero(_KIND[buf[size:]] == 2)
                    end = size + int(after[0]) + 1 if len(after) else end
                bufs.append(buf[:end])
                langs.append(lang)
                held, buf = held + end, buf[end:]
                if held >= size:
                    yield bufs, langs
                    bufs, langs, held = [], [], 0
    if bufs:
        yield bufs, langs


class _Words:
    """The words of some texts: `lang`, `piece` and `word` (numbers) and `hash` of each."""

    def __init__(self, bufs: list[np.ndarray], langs: list[str]):
        buf = np.concatenate(bufs)
        ends = np.cumsum([len(b) for b in bufs])
        self.langs, code = np.unique(np.array(langs, dtype=object), return_inverse=True)
        kind = _KIND[buf]
        word = kind == 0
        first, last = word.copy(), word.copy()
        first[1:] &= ~word[:-1]
        last[:-1] &= ~word[1:]
        cut = ends[:-1]
        first[cut] |= word[cut]
        last[cut - 1] |= word[cut - 1]
        start = np.flatnonzero(first)
        lengths = np.flatnonzero(last) + 1 - start
        doc = np.searchsorted(ends, start, "right")
        self.lang = code[doc].astype(np.int64)
        self.piece = np.searchsorted(np.flatnonzero(kind == 2), start) + doc
        body = _LOWER[buf[word]]
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        texts = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(body)])
        coded = texts.dictionary_encode()
        self.word, self.texts = coded.indices.to_numpy().astype(np.int64), coded.dictionary.cast(pa.large_string())
        self.hash = mix(self._hashes(coded.dictionary)[self.word] + self._hashes(pa.array([x.encode() for x in self.langs], pa.large_binary()))[self.lang] * _STEP)

    @staticmethod
    def _hashes(texts: pa.Array) -> np.ndarray:
        offs = np.frombuffer(texts.buffers()[1], dtype=np.int64, count=len(texts) + 1)
        body = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
        sums = np.zeros(len(body) + 1, dtype=np.uint64)
        np.cumsum(mix(body.astype(np.uint64) + _U(1)) * powers(len(body)), out=sums[1:])
        return mix((sums[offs[1:]] - sums[offs[:-1]]) * powers(len(body) + 1, True)[offs[:-1]] + (offs[1:] - offs[:-1]).astype(np.uint64))

    def levels(self, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(k, places, hashes) of all runs of k words within a piece, for k up to `longest`."""
        h, at = self.hash, np.arange(len(self.hash))
        yield 1, at, h
        for k in range(2, longest + 1):
            keep = at + k - 1 < len(self.hash)
            at, h = at[keep], h[keep]
            keep = self.piece[at] == self.piece[at + k - 1]
            at, h = at[keep], h[keep]
            h = mix(h * _STEP + self.hash[at + k - 1])
            yield k, at, h


def _cells(h: np.ndarray, row: int, cells: int) -> np.ndarray:
    return ((((h >> _U(32 * row)) & _U(0xFFFFFFFF)) * _U(cells)) >> _U(32)).astype(np.int64)


def _sketched(longest: int, least: int, cells: int):
    """One sketch of all rows of a task, as slices: (slice, counts), slices without any left out."""

    def run(batches):
        rows = [np.zeros(cells, dtype=np.uint16) for _ in range(ROWS)]
        for part in _parts(batches, CHUNK):
            for _, _, h in _Words(*part).levels(longest):
                for row, counts in enumerate(rows):
                    at = _cells(h, row, cells)
                    for i in range(0, len(at), HALF):
                        some = at[i : i + HALF]
                        np.add.at(counts, some, np.uint16(1))
                        counts[some] = np.minimum(counts[some], HALF)
        for row, counts in enumerate(rows):
            for i in range(0, cells, SLICE):
                some = np.minimum(counts[i : i + SLICE], least)
                if some.any():
                    some = some.astype(np.uint8 if least < 256 else np.uint16)
                    yield pa.RecordBatch.from_arrays([pa.array([row * (cells // SLICE) + i // SLICE], pa.int32()), pa.array([zlib.compress(some.tobytes(), 1)], pa.binary())], ["slice", "counts"])

    return run


def _merged(least: int):
    """From slices sorted by number one bit a cell: whether the sum of its counts reaches `least`."""

    def run(batches):
        now, total = None, None

        def done():
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([np.packbits(total >= least, bitorder="little").tobytes()], pa.binary())], ["slice", "bits"])

        for batch in batches:
            for n, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                some = np.frombuffer(zlib.decompress(counts), dtype=np.uint8 if least < 256 else np.uint16)
                if n != now:
                    if now is not None:
                        yield done()
                    now, total = n, np.zeros(SLICE, dtype=np.uint32)
                total = np.minimum(total + some, least)
        if now is not None:
            yield done()

    return run


_COUNTS = "lang string, size int, phrase string, n long"


def _table(langs, size, phrases, n) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([langs.cast(pa.string()), pa.array(np.full(len(n), size, np.int32)), phrases.cast(pa.string()), pa.array(n, pa.int64())], ["lang", "size", "phrase", "n"])


def _summed(batches: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
    """Tables of counts as one, with a row for each phrase."""
    out = pa.Table.from_batches(batches).group_by(["lang", "size", "phrase"], use_threads=False).aggregate([("n", "sum")])
    return out.rename_columns({"n_sum": "n"}).select(["lang", "size", "phrase", "n"]).to_batches(max_chunksize=1 << 17)


def _survivors(longest: int, cells: int, bits):
    """Counts of the words and phrases that may be frequent, and as size 0 of all words."""

    def likely(h):
        table = np.frombuffer(bits.value, dtype=np.uint8)
        keep = np.ones(len(h), dtype=bool)
        for row in range(ROWS):
            at = _cells(h[keep], row, cells) + row * cells
            keep[keep] = (table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        return keep

    def run(batches):
        held, rows = [], 0
        for batch in counted(batches):
            held.append(batch)
            rows += batch.num_rows
            if rows > HELD:
                held = _summed(held)
                rows = sum(b.num_rows for b in held)
                if rows > HELD // 2:
                    yield from held
                    held, rows = [], 0
        if held:
            yield from _summed(held)

    def counted(batches):
        for part in _parts(batches, CHUNK):
            w = _Words(*part)
            langs = pa.array(w.langs, pa.string())
            total = np.bincount(w.lang, minlength=len(langs))
            yield _table(langs, 0, pa.nulls(len(langs), pa.string()), total)
            alive = np.zeros(len(w.word) + 1, dtype=bool)  # of the level before, by place
            number = np.zeros(len(w.word), dtype=np.int64)
            for k, at, h in w.levels(longest):
                if k > 1:
                    may = alive[at] & alive[at + 1]
                    at, h = at[may], h[may]
                at = at[likely(h)]
                alive[:] = False
                alive[at] = True
                if k == 1:
                    key = w.lang[at] * len(w.texts) + w.word[at]
                else:
                    key = number[at] * len(w.texts) + w.word[at + k - 1]
                _, first, own, n = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
                number[at] = own
                place = at[first]
                for i in range(0, len(place), 1 << 17):
                    some = place[i : i + (1 << 17)]
                    words = [w.texts.take(pa.array(w.word[some + j])) for j in range(k)]
                    yield _table(langs.take(pa.array(w.lang[some])), k, pc.binary_join_element_wise(*words, pa.scalar(" ", pa.large_string())) if k > 1 else words[0], n[i : i + (1 << 17)])

    return run


def frequent_phrases(docs: DataFrame, *, least: int = 100, longest: int = 5) -> DataFrame:
    """(lang, size, phrase, n): all words and phrases of up to `longest` words that occur at
    least `least` times in a language, with their exact counts; a row of size 0 and phrase null
    has the number of all words of a language that has any. See collocations()."""
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text")).where("octet_length(text) > 0")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    cells = SLICE * -(-min(MOST_CELLS, max(LEAST_CELLS, size // CELL_BYTES)) // SLICE)
    enough = min(least, HALF)  # a phrase with `least` has that, too
    docs = docs.coalesce(max(spark.sparkContext.defaultParallelism, size // TASK_BYTES))
    slices = docs.mapInArrow(_sketched(longest, enough, cells), "slice int, counts binary")
    merged = slices.repartition(partitions(spark), "slice").sortWithinPartitions("slice").mapInArrow(_merged(enough), "slice int, bits binary")
    bits = bytearray(ROWS * cells // 8)  # at most 32 MB
    for r in merged.toLocalIterator():
        bits[r["slice"] * SLICE // 8 : (r["slice"] + 1) * SLICE // 8] = bytes(r["bits"])
    counts = docs.mapInArrow(_survivors(longest, cells, spark.sparkContext.broadcast(bytes(bits))), _COUNTS)
    return counts.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n")).where((F.col("size") == 0) | (F.col("n") >= least))


def _some(first, n):
    return F.array_join(F.slice("words", first, n), " ")


def collocations(docs: DataFrame, *, least: int = 100, longest: int = 5, percent: int = 100, top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): of each language the first `top` phrases of 2 to
    `longest` words with a >= `least` occurrences, by score, then a, then phrase. A phrase has
    floor(1000 * a * n / (l * r)) of its lowest-scoring cut into a first part (l occurrences) and
    the rest (r); n counts the words of the language. A phrase that stands inside a longer one
    with at least `percent` % of its occurrences is left out.

    A-Z are lower-cased; pieces end at `.,;:!?` and line ends, words at spaces and tabs. A null
    lang is `und`; null and empty texts have no words; repeated rows count as often as they
    occur; other columns are ignored; an empty table gives an empty result."""
    counts = stage(frequent_phrases(docs, least=least, longest=longest))
    n = stage(counts.where("size = 0").select("lang", F.col("n").alias("total")))  # a row a language
    part = counts.where("size > 0").select("lang", "phrase", "n")
    found = counts.where("size > 1").select("lang", "phrase", "size", F.col("n").alias("a"), F.split("phrase", " ").alias("words"))
    cuts = found.select("lang", "phrase", "a", F.explode(F.expr("sequence(1, size - 1)")).alias("k"), "words", "size")
    cuts = cuts.select("lang", "phrase", "a", "k", _some(F.lit(1), F.col("k")).alias("first"), _some(F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"))
    cuts = cuts.join(part.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l")), ["lang", "first"])
    cuts = cuts.join(part.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"]).join(n, "lang")
    exact = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "total", "l", "r")}
    score = F.call_function("div", F.lit(1000).cast("decimal(4,0)") * exact["a"] * exact["total"], exact["l"] * exact["r"])
    scored = cuts.withColumn("best", F.struct(score.alias("score"), "k", "l", "r")).groupBy("lang", "phrase").agg(F.min("best").alias("best"), F.first("a").alias("a"), F.first("total").alias("n"))
    inside = F.expr("flatten(transform(sequence(2, size - 1), m -> transform(sequence(1, size - m + 1), s -> array_join(slice(words, s, m), ' '))))")
    longer = found.where("size > 2").select("lang", F.explode(F.array_distinct(inside)).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = scored.join(longer, ["lang", "phrase"], "left").where((F.lit(100) * F.coalesce("longer", F.lit(0)) < F.lit(percent) * F.col("a")))
    kept = kept.select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score", F.pmod(F.xxhash64("phrase"), F.lit(64)).alias("_part"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    kept = kept.withColumn("_n", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))).where(F.col("_n") <= top)  # a large language in parts first
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    return kept.withColumn("rank", rank).where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


#: collocations() with its defaults over documents.
COLLOCATIONS_SQL = r"""with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece from documents),
split as (select lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') as w from pieces),
total as (select lang, sum(len(w))::bigint as n from split group by lang),
phrases as (select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase from (select lang, w, unnest(range(1, len(w) + 1)) as i from split), (select unnest([1, 2, 3, 4, 5]) as k) where i + k - 1 <= len(w)),
f as (select lang, k, phrase, count(*) as a from phrases group by all having count(*) >= 100),
found as (select lang, k, phrase, a, string_split(phrase, ' ') as w from f where k > 1),
cuts as (select c.lang, c.phrase, c.k, c.a, c.w, x.c, l.a as l, r.a as r, n, ((1000::hugeint * c.a * n) // (l.a::hugeint * r.a))::bigint as score
  from found c, (select unnest([1, 2, 3, 4]) as c) x join f l on l.lang = c.lang and l.phrase = array_to_string(c.w[1:x.c], ' ') join f r on r.lang = c.lang and r.phrase = array_to_string(c.w[x.c + 1:], ' ') join total on total.lang = c.lang
  where x.c < c.k),
best as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, c) = 1),
inside as (select lang, array_to_string(w[i:i + m - 1], ' ') as phrase, max(a) as longer from (select *, unnest(range(1, k + 1)) as i from found), (select unnest([2, 3, 4]) as m) where m < k and i + m - 1 <= k group by all),
kept as (select best.* from best left join inside using (lang, phrase) where longer is null or longer < a)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score from kept qualify rank <= 2000"""
