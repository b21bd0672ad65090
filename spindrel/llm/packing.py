"""Packing of tokenised documents into sequences of a fixed length.

Tokens are counted where the text is read, in tasks; what moves is the ids, two bytes each
where the vocabulary allows it, in pieces of at most a sequence. Every piece goes to a
random group (by a hash of its document, so that a lost task deals as before), and groups
are packed apart from each other: first-fit decreasing, where a tournament tree over the
free room of the sequences finds the first that a piece fits into in log(sequences) steps.

First-fit decreasing cuts no document that fits into a sequence. What it leaves open is
closed afterwards: the emptiest sequences are dissolved and poured into the holes of the
others, which cuts at most one piece a hole; holes below LEAST tokens stay, as padding. The
last open sequence of a group is cut into powers of two, which need no padding.

A group has about GROUP_BYTES of text whatever the size of the corpus; the shuffle has the
session's number of partitions, each with many groups one after the other.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounds, complete_groups, partitions, prepare
from .tokens import mix

#: Text bytes whose pieces share a group.
GROUP_BYTES = 8 << 20
#: Holes of fewer tokens are not filled.
LEAST = 16
#: Bytes of words and their ids that a Python worker remembers.
REMEMBERED = 256 << 20
#: Text bytes that are split into words at once.
SLICE = 1 << 20
#: Bytes of pieces that leave a task at once.
BATCH = 4 << 20
#: A normaliser and splitter under which a text's ids are those of its words, one after the other.
_BY_WORD = ({"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"})
_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
#: Words of these characters fall into runs of letters, runs of signs and single digits.
_PLAIN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ0-9!-&(-/:-@\[-`{-~]+")
_RUNS = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+|[0-9]|[!-&(-/:-@\[-`{-~]+")
_U = np.uint64


def _by_word(spec: dict) -> bool:
    """Whether words can be encoded apart: white space only separates, nothing looks across it."""
    split = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    return (
        (spec.get("normalizer") or {}).get("normalizers") == list(_BY_WORD)
        and (split[0].get("pattern"), split[0].get("behavior"), split[0].get("invert")) == ({"Regex": _SPLIT}, "Removed", True)
        and all(p.get("type") == "ByteLevel" and not p["use_regex"] and not p["add_prefix_space"] for p in split[1:])
        and not any(re.search(r"\s", t["content"]) or t["lstrip"] or t["rstrip"] or t["normalized"] for t in spec["added_tokens"])
    )


class Encoder:
    """Ids of texts. Where the tokenizer allows it words are remembered, and so are the runs
    of letters and signs they consist of, which are fewer."""

    def __init__(self, spec: str):
        import tokenizers

        self.model = tokenizers.Tokenizer.from_str(spec)
        self.kind = np.dtype("<u2") if self.model.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.apart = _by_word(json.loads(spec))
        self.marks = [t["content"] for t in json.loads(spec)["added_tokens"]]
        # what the splitter makes of a lower-case letter or sign; runs of these go straight to the model
        alone = [c for c in map(chr, range(33, 256)) if _PLAIN.fullmatch(c) and c == c.lower()]
        self.written = {ord(c): self.model.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in alone} if self.apart else {}
        self.words: dict[bytes, bytes] = {}
        self.runs: dict[str, bytes] = {}
        self.held = 0

    def _encoded(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype=self.kind).tobytes() for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def _run(self, run: str) -> bytes:
        ids = self.runs.get(run)
        if ids is None:
            ids = array("H" if self.kind.itemsize == 2 else "I", [t.id for t in self.model.model.tokenize(run.translate(self.written))]).tobytes()
            self.runs[run] = ids
            self.held += len(run) + len(ids) + 160
        return ids

    def _learn(self, words: list[bytes]) -> None:
        for w in words:
            s = w.decode()
            if _PLAIN.fullmatch(s) and not any(m in s for m in self.marks):
                ids = b"".join([self._run(x) for x in _RUNS.findall(s.lower())])
            else:
                ids = self._encoded([s])[0]
            self.words[w] = ids
            self.held += len(w) + len(ids) + 160

    def _slices(self, raw: bytes) -> Iterator[bytes]:
        at = 0
        while at < len(raw):
            end = at + SLICE
            if end < len(raw):
                gap = re.compile(rb"[\x20\x09-\x0D]").search(raw, end)
                end = gap.end() if gap else len(raw)
            yield raw[at:end]
            at = end

    def ids(self, text: str) -> np.ndarray:
        if not self.apart:
            return np.frombuffer(self._encoded([text])[0], dtype=self.kind)
        out = []
        for part in self._slices(text.encode()):
            words = part.split()
            if self.held > REMEMBERED:
                self.words, self.runs, self.held = {}, {}, 0
            try:
                out.append(b"".join(map(self.words.__getitem__, words)))
            except KeyError:
                self._learn(list(set(words).difference(self.words)))
                out.append(b"".join(map(self.words.__getitem__, words)))
        return np.frombuffer(b"".join(out), dtype=self.kind)


_encoders: dict[int, Encoder] = {}


def _encoder(spec) -> Encoder:
    """One for each tokenizer that this Python worker has met; tasks that reuse the worker share it."""
    return _encoders.get(spec.id) or _encoders.setdefault(spec.id, Encoder(spec.value))


class _Spec:
    """A broadcast tokenizer file; `id` tells it from others of the same application."""

    def __init__(self, spark, path: str):
        with open(path, encoding="utf-8") as f:
            text = f.read()
        self.id, self._text = hash(text), spark.sparkContext.broadcast(text)

    @property
    def value(self) -> str:
        return self._text.value


_PIECES = "grp long, size int, key long, doc_id long, start long, doc_tokens long, ids binary"


def _tokenised(spec: _Spec, end: int, length: int, groups: int):
    """Pieces of (key, doc_id, text) rows. A piece's group is random, but the same for the same
    row of the same partition; repeated rows of other partitions go elsewhere."""
    names = [c.split()[0] for c in _PIECES.split(", ")]
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())

    def run(batches):
        code = _encoder(spec)
        here = _U(TaskContext.get().partitionId() + 1)
        rows: list[tuple] = []
        size = 0

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        for batch in batches:
            keys, docs, texts = batch.column(0).to_numpy(), batch.column(1).to_pylist(), batch.column(2)
            for i in range(batch.num_rows):
                ids = np.append(code.ids(texts[i].as_py() or ""), code.kind.type(end)).astype(code.kind)
                starts = np.arange(0, len(ids), length)
                with np.errstate(over="ignore"):
                    deal = mix(mix(keys[i : i + 1].view(np.uint64) + here) + starts.astype(np.uint64)) % _U(groups)
                for g, at in zip(deal.tolist(), starts.tolist(), strict=True):
                    part = ids[at : at + length]
                    rows.append((g, len(part), int(keys[i]), docs[i], at, len(ids), part.tobytes()))
                size += ids.nbytes + 60 * len(starts)
                if size > BATCH:
                    yield flush()
                    rows, size = [], 0
        if rows:
            yield flush()

    return run


def first_fit(sizes: list[int], length: int) -> list[int]:
    """The bin of each item, by first fit in the order given: a tournament tree holds the most
    room of any bin below each of its nodes, so the first bin with enough is found from the root."""
    leaves = 1
    while leaves < 2 * (sum(sizes) // length) + 2:  # at most one bin is half empty
        leaves *= 2
    room = [length] * (2 * leaves)
    out = []
    for size in sizes:
        i = 1
        while i < leaves:
            i *= 2
            if room[i] < size:
                i += 1
        out.append(i - leaves)
        room[i] -= size
        while i > 1:
            i //= 2
            most = max(room[2 * i], room[2 * i + 1])
            if room[i] == most:
                break
            room[i] = most
    return out


def packed(sizes: list[int], length: int, least: int = LEAST) -> list[list[tuple[int, int, int]]]:
    """Sequences as lists of (item, from, to); `sizes` descend and are at most `length`."""
    bins: list[list[tuple[int, int, int]]] = []
    for item, b in enumerate(first_fit(sizes, length)):
        while len(bins) <= b:
            bins.append([])
        bins[b].append((item, 0, sizes[item]))
    free = [length - sum(e - s for _, s, e in b) for b in bins]
    order = sorted((i for i in range(len(bins)) if free[i] >= least), key=lambda i: (-free[i], i))
    givers, room, poured = 0, sum(free[i] for i in order), 0
    for i in order:  # the emptiest give, up to the first whose tokens are not all needed
        givers, room, poured = givers + 1, room - free[i], poured + length - free[i]
        if poured > room:
            break
    loose = [p for i in order[:givers] for p in bins[i]][::-1]

    def taken(n: int) -> list[tuple[int, int, int]]:
        own = []
        while n and loose:
            item, s, e = loose.pop()
            cut = min(e, s + n)
            own.append((item, s, cut))
            n -= cut - s
            if cut < e:
                loose.append((item, cut, e))
        return own

    for i in order[givers:]:
        bins[i] += taken(free[i])
    gone = set(order[:givers])
    out = [b for i, b in enumerate(bins) if i not in gone]
    left = sum(e - s for _, s, e in loose)  # less than a sequence
    return out + [taken(1 << k) for k in range(left.bit_length() - 1, -1, -1) if left >> k & 1]


_RESULT = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def _packed_groups(length: int, kind: str):
    names = [c.split()[0] for c in _RESULT.split(", ")]
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())

    def run(batches):
        groups = (t.slice(b, e - b) for t in complete_groups(batches, "grp") for b, e in zip(*bounds(t["grp"].to_numpy()), strict=True))
        for t in groups:
            grp = t["grp"][0].as_py()
            sizes, docs, starts, whole, ids = (t[c].to_pylist() for c in ("size", "doc_id", "start", "doc_tokens", "ids"))
            rows, size = [], 0
            for n, sequence in enumerate(packed(sizes, length)):
                at = 0
                for item, s, e in sequence:
                    part = np.frombuffer(ids[item], dtype=kind)[s:e].astype("<u4").tobytes()
                    rows.append((docs[item], starts[item] + s, e - s, part, whole[item], grp << 32 | n, at))
                    at += e - s
                size += 4 * at
                if size > BATCH:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return run


def pack(docs: DataFrame, tokenizer: str, *, length: int = 2048, end: int = 1) -> DataFrame:
    """Rows (doc_id, start, length, ids, doc_tokens, sequence_id, offset), one per piece of a row
    of `docs` (doc_id, text): ids `start` to `start + length` of its doc_tokens stand in the
    sequence from `offset`; `ids` has them as little-endian unsigned 32-bit numbers. A row's ids
    are those of its text by the `tokenizer` file (read on the driver), without special ones, and then `end`.

    Sequences have at most `length` (a power of two) tokens. Null and empty texts are the id
    `end` alone; repeated rows are packed once each; a null doc_id stays null. Rows of equal
    length are taken by hash, id and start. Other columns are ignored; an empty table gives an empty result."""
    if length & length - 1 or length < 1:
        raise ValueError("length must be a power of two")
    spark = docs.sparkSession
    prepare(spark)
    number, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    docs = docs.select(F.xxhash64(number, text).alias("key"), number.alias("doc_id"), text.alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    spec = _Spec(spark, tokenizer)
    groups = max(1, -(-size // GROUP_BYTES))
    pieces = docs.mapInArrow(_tokenised(spec, end, length, groups), _PIECES)
    pieces = pieces.repartition(partitions(spark), "grp").sortWithinPartitions("grp", F.desc("size"), "key", "doc_id", "start")
    return pieces.mapInArrow(_packed_groups(length, Encoder(spec.value).kind.str), _RESULT)
