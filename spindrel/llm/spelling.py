"""Spelling variants: frequent words that differ in one letter, and the form each stands for.

Words are counted where the texts are read and summed by Spark. Every word of the vocabulary
then generates its full neighbourhood: all distinct strings that one deletion, replacement or
insertion makes of it, over the letters that the vocabulary uses. Those that are words
themselves are its near words: nothing has to be compared letter by letter. A word of eight
letters has some 850 neighbours, so a task makes their hashes from prefix and suffix sums and
asks two bitmaps of the vocabulary (64 MB each at most); only neighbours that both know are
written out, and joined to the vocabulary by their text, which decides.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bitmap, in_bitmap, prepare, stage
from .tokens import mix, powers

#: Distinct words after which a task hands on its counts.
HELD = 1 << 19
#: Text characters that are split into words at once.
SLICE = 1 << 20
#: Places of a word whose neighbours are made at once.
PLACES = 1 << 12
_U = np.uint64
_RUN = re.compile("[A-Za-zÀ-ÿ]+")


def _lower(text: str) -> str:
    return text.lower() if text.isascii() else text.encode().lower().decode()  # of bytes, only A-Z have a lower case


def _runs(text: str):
    at = 0
    while at < len(text):
        end = at + SLICE
        while end < len(text) and _RUN.match(text, end):  # not inside a run
            end = _RUN.match(text, end).end()
        yield _RUN.findall(_lower(text[at:end]))
        at = end


def _counted(rate: int, shortest: int):
    """(word, n) of (doc_id, text) rows; a run whose hash `rate` divides loses a letter."""

    def run(batches):
        held: Counter[str] = Counter()

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seed = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                own: Counter[str] = Counter()
                for found in _runs(text or ""):
                    own.update(found)
                for w, n in own.items():
                    if len(w) < shortest:
                        continue
                    h = zlib.crc32(w.encode(), seed)
                    if not h % rate:
                        at = h % len(w)
                        w = w[:at] + w[at + 1 :]
                        if len(w) < shortest:
                            continue
                    held[w] += n
                if len(held) > HELD:
                    yield flush()
                    held.clear()
        if held:
            yield flush()

    return run


def _code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").astype(np.int64), np.array([len(w) for w in words])


def _letters(c: np.ndarray) -> np.ndarray:
    return mix(c.astype(np.uint64) * _U(0x9E3779B97F4A7C15) + _U(1))


def _second(h: np.ndarray) -> np.ndarray:
    return mix(h ^ _U(0xC2B2AE3D27D4EB4F)).view(np.int64)


def _hashed(batches):
    """Adds to (word, n) rows the two keys of a word: the sum of its letters' values times powers by place."""
    for batch in batches:
        words = batch.column(0).to_pylist()
        if words:
            points, sizes = _code_points(words)
            ends = np.cumsum(sizes)
            place = np.arange(len(points)) - np.repeat(ends - sizes, sizes)
            h = np.add.reduceat(_letters(points) * powers(int(sizes.max()))[place], ends - sizes)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(h.view(np.int64)), pa.array(_second(h))], ["word", "n", "a", "b"])


def neighbours(word: str, letters: str, known=None) -> list[str]:
    """All distinct strings that one deletion, replacement or insertion makes of `word`, which
    has no duplicates: of equal letters in a row the first is deleted, and none is inserted
    after itself. `known` (hashes to booleans) leaves out those whose hash it doesn't know."""
    n = len(word)
    if known is None:
        known = lambda h: np.ones(h.shape, dtype=bool)
    points, alphabet = _code_points([word])[0], _code_points([letters])[0]
    power, values, new = powers(n + 1), _letters(points), _letters(alphabet)
    before = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * power[:n], dtype=np.uint64)])
    after = before[n] - before  # from a place on
    less = before[:n] + after[1:] * _U(pow(int(power[1]), -1, 1 << 64))
    cut = known(less) & np.concatenate([[True], points[1:] != points[:-1]])
    out = [word[:i] + word[i + 1 :] for i in np.flatnonzero(cut).tolist()]
    for lo in range(0, n + 1, PLACES):
        at = slice(lo, min(n, lo + PLACES))
        other = alphabet[None, :] != points[at, None]
        hit = other & known(before[n] + (new[None, :] - values[at, None]) * power[at, None])
        out += [word[: lo + i] + letters[j] + word[lo + i + 1 :] for i, j in zip(*(x.tolist() for x in np.nonzero(hit)), strict=True)]
        at = slice(lo, min(n + 1, lo + PLACES))
        hit = known(before[at, None] + new[None, :] * power[at, None] + (after[at] * power[1])[:, None])
        own = max(lo, 1)  # a letter is not inserted after itself
        hit[own - lo :] &= alphabet[None, :] != points[own - 1 : at.stop - 1, None]
        out += [word[: lo + i] + letters[j] + word[lo + i :] for i, j in zip(*(x.tolist() for x in np.nonzero(hit)), strict=True)]
    return out


def _neighbourhoods(letters: str, first, second):
    def known(h):
        flat = h.reshape(-1)
        hit = in_bitmap(first.value, flat)
        hit[hit] = in_bitmap(second.value, _second(flat[hit]))
        return hit.reshape(h.shape)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            words, n = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            found = [neighbours(w, letters, known) for w in words]
            sizes = [len(x) for x in found]
            rows = [pa.array([w for w, x in zip(words, found, strict=True) for _ in x], pa.string()), pa.array(np.repeat(n, sizes), pa.int64()), pa.array([y for x in found for y in x], pa.string())]
            yield pa.RecordBatch.from_arrays(rows, ["word", "n", "near"])

    return run


def _rooted(linked: DataFrame) -> DataFrame:
    """(word, root) of (word, form) rows: forms followed to the last, twice as far each round. A
    form has several times its word's count, so there is no way back and there are few rounds."""
    links = linked.select("word", F.col("form").alias("root"))
    while True:
        on = links.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        links = stage(links.join(on, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")))
        if links.where("moved").isEmpty():
            return links.select("word", "root")
        links = links.select("word", "root")


def variants(docs: DataFrame, *, shortest: int = 6, least: int = 5, times: int = 5, rate: int = 199) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each word of `docs` (doc_id, text): n_near words
    are one insertion, deletion or replacement of a letter away; the most frequent of them
    (of several, the first by code points) is its form if it has at least `times` its
    occurrences n, else form and form_n are null. root is the last form of the chain of
    forms, the word itself if it has none.

    Words are runs of A-Z, a-z and U+00C0 to U+00FF with A-Z lower-cased, of at least `shortest`
    letters and `least` occurrences. Runs lose a letter where `rate` divides the CRC-32 of
    `<doc_id>:<run>` (at that hash modulo the length), which plants misspellings to be found.
    Null and empty texts have no words; a null doc_id counts as ''; repeated rows count as often as
    they occur; other columns are ignored; an empty table gives an empty result."""
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counts = docs.mapInArrow(_counted(rate, shortest), "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    words = stage(counts.mapInArrow(_hashed, "word string, n long, a long, b long"))
    letters = "".join(sorted(r[0] for r in words.select(F.explode(F.split("word", "")).alias("c")).distinct().collect()))  # 90 at most
    first, second = (spark.sparkContext.broadcast(bitmap(words, c)) for c in ("a", "b"))
    pairs = words.select("word", "n").mapInArrow(_neighbourhoods(letters, first, second), "word string, n long, near string")
    vocabulary = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = F.struct((-F.col("near_n")).alias("less"), "near")
    near = pairs.join(vocabulary, "near").groupBy("word", "n").agg(F.count("*").alias("n_near"), F.min(best).alias("best"))
    chosen = -F.col("best.less") >= F.lit(times) * F.col("n")
    near = stage(near.select("word", "n_near", F.when(chosen, F.col("best.near")).alias("form"), F.when(chosen, -F.col("best.less")).alias("form_n")))
    out = words.select("word", "n").join(near, "word", "left").join(_rooted(near.where("form is not null")), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")
