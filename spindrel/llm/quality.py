"""Quality rules: a linear-chain conditional random field over the lines of a text.

Every line with a word is labelled content or boilerplate by Viterbi decoding; the share
of words in content lines decides, after the plain limits on length and repetition. The
field is fitted in numpy on a bounded sample of labelled documents (the `sample` with the
least hashes of doc_id; their whole texts in stretches of `stretch` lines, of which the
`stretches` with the least hashes serve): a logistic fit with document labels first, whose
line labels the field then learns with its transitions by maximum likelihood.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare
from .tokens import chunks, windows, words

FEATURES = ("bias", "log_words", "word_size", "symbols", "capitals", "digits", "repeated", "earlier", "sentence_end", "lone", "short")
#: Log-odds of content without any labels: repetition, symbols and capitals speak against it.
PRIOR = np.array([2.5, 0.2, 0.0, -8.0, -3.0, -3.0, -5.0, -3.0, 0.5, -6.0, 0.0])
_SYMBOL, _UPPER, _DIGIT, _END = (np.zeros(256, dtype=np.int64) for _ in range(4))
_SYMBOL[list(b"#*$%&|<>")] = 1
_UPPER[65:91] = 1
_DIGIT[48:58] = 1
_END[list(b".!?:;")] = 1


def _sums(mask: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])


class Measured:
    """Counts of the documents of one buffer and features of their lines."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray):
        n = len(offs) - 1
        doc, s, e, h = words(buf, offs)
        self.n_words = np.bincount(doc, minlength=n)
        size = e - s
        first = _sums((buf & 0xC0) != 0x80)
        self.word_chars = np.bincount(doc, first[e] - first[s], minlength=n).astype(np.int64)
        symbols = _sums(_SYMBOL[buf])
        self.n_symbols = symbols[offs[1:]] - symbols[offs[:-1]]

        at, wh = windows(doc, h, 3)
        repeated = np.zeros(len(s), dtype=bool)
        begin = np.searchsorted(doc[at], np.arange(n + 1))
        for b, x in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True):
            if x - b > 1:
                _, inverse, count = np.unique(wh[b:x], return_inverse=True, return_counts=True)
                hit = at[b:x][count[inverse] > 1]
                for k in range(3):
                    repeated[hit + k] = True
        self.n_repeat_words = np.bincount(doc, repeated, minlength=n).astype(np.int64)

        breaks = np.flatnonzero(buf == 10)
        row = np.searchsorted(breaks, s)
        new = np.ones(len(s), dtype=bool)
        new[1:] = (doc[1:] != doc[:-1]) | (row[1:] != row[:-1])
        line = np.flatnonzero(new)  # first word of each line that has one
        self.line_doc = doc[line]
        self.line_words = np.diff(np.concatenate([line, [len(s)]]))
        after = np.concatenate([[0], breaks + 1])[row[line]]
        lo = np.maximum(after, offs[self.line_doc])
        hi = np.minimum(np.concatenate([breaks, [len(buf)]])[row[line]], offs[self.line_doc + 1])
        raw = buf.tobytes()
        earlier = np.zeros(len(line), dtype=bool)
        seen: set[bytes] = set()
        last = -1
        for i, (d, a, b) in enumerate(zip(self.line_doc.tolist(), lo.tolist(), hi.tolist(), strict=True)):
            if d != last:
                seen, last = set(), d
            text = raw[a:b]
            if text in seen:
                earlier[i] = True
            seen.add(text)
        self.n_dup_lines = np.bincount(self.line_doc, earlier, minlength=n).astype(np.int64)

        def per_line(x):
            return np.add.reduceat(x.astype(np.float64), line) if len(line) else np.zeros(0)

        def chars(table):
            c = _sums(table[buf])
            return per_line(c[e] - c[s])

        count, letters = self.line_words.astype(float), per_line(size)
        self.features = np.stack(
            [
                np.ones(len(line)),
                np.log1p(count),
                letters / np.maximum(count, 1) / 10,
                chars(_SYMBOL) / np.maximum(letters, 1),
                chars(_UPPER) / np.maximum(letters, 1),
                chars(_DIGIT) / np.maximum(letters, 1),
                per_line(repeated) / np.maximum(count, 1),
                earlier.astype(float),
                per_line(_END[buf[e - 1]] if len(e) else e) / np.maximum(count, 1),
                per_line(size == 1) / np.maximum(count, 1),
                (count < 5).astype(float),
            ],
            axis=1,
        )


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, start: np.ndarray, steps: int = 400) -> np.ndarray:
    w, penalty = start.copy(), 1e-3
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w -= 2.0 * (x.T @ (weight * (p - y)) / weight.sum() + penalty * (w - start))
    return w


def fit(sequences: list[tuple[np.ndarray, int]], steps: int = 150) -> tuple[np.ndarray, np.ndarray]:
    """(weights of content against boilerplate, 2 x 2 transition scores) from line features
    and document labels (1: good)."""
    sequences = [(x, y) for x, y in sequences if len(x)]
    if len({y for _, y in sequences}) < 2:
        return PRIOR, np.array([[0.5, -0.5], [-0.5, 0.5]])
    x = np.concatenate([s for s, _ in sequences])
    y = np.concatenate([np.full(len(s), float(q)) for s, q in sequences])
    good = y.mean()
    w = _logistic(x, y, np.where(y == 1, 0.5 / good, 0.5 / (1 - good)), PRIOR)
    # lines as the logistic fit sees them, but none of content in a bad document without doubt
    label = np.concatenate([s @ w > (0 if q else 1) for s, q in sequences])
    # by place and, in it, longest sequence first: the rows of a place are the first of the place before
    size = np.array([len(s) for s, _ in sequences])
    rank = np.empty(len(size), dtype=np.int64)
    rank[np.argsort(-size, kind="stable")] = np.arange(len(size))
    place = np.concatenate([np.arange(n) for n in size])
    order = np.lexsort((np.repeat(rank, size), place))
    x, label, row = x[order], label[order].astype(np.int64), np.repeat(rank, size)[order]
    begin = np.searchsorted(place[order], np.arange(size.max() + 1))
    later = np.arange(begin[1], len(x))
    earlier = begin[place[order][later] - 1] + row[later]
    n, seen = len(x), np.zeros((2, 2))
    np.add.at(seen, (label[earlier], label[later]), 1)
    trans = np.zeros((2, 2))
    for _ in range(steps):
        unary = x @ w
        alpha, beta = np.zeros((n, 2)), np.zeros((n, 2))
        alpha[: begin[1], 1] = unary[: begin[1]]
        for t in range(1, len(begin) - 1):
            b, e = begin[t], begin[t + 1]
            last = alpha[begin[t - 1] : begin[t - 1] + e - b]
            alpha[b:e] = np.logaddexp(last[:, :1] + trans[0], last[:, 1:] + trans[1])
            alpha[b:e, 1] += unary[b:e]
        for t in range(len(begin) - 2, 0, -1):
            b, e = begin[t], begin[t + 1]
            after = beta[b:e].copy()
            after[:, 1] += unary[b:e]
            beta[begin[t - 1] : begin[t - 1] + e - b] = np.logaddexp(after[:, :1] + trans[:, 0], after[:, 1:] + trans[:, 1])
        z = np.logaddexp(beta[: begin[1], 0], unary[: begin[1]] + beta[: begin[1], 1])
        p = np.exp(alpha[:, 1] + beta[:, 1] - z[row])
        after = beta[later] + np.stack([np.zeros(len(later)), unary[later]], 1)
        both = np.exp(alpha[earlier][:, :, None] + trans + after[:, None, :] - z[row[later]][:, None, None])
        w = w + 0.5 * ((label - p) @ x / n - 1e-3 * (w - PRIOR))
        trans = trans + 0.5 * ((seen - both.sum(0)) / n - 1e-3 * trans)
    return w, trans


def viterbi(scores: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Best labels (0 boilerplate, 1 content) of a line sequence with content scores."""
    n = len(scores)
    t00, t01, t10, t11 = trans.ravel().tolist()
    back = bytearray(2 * n)
    zero, one = 0.0, float(scores[0])
    for i, x in enumerate(scores[1:].tolist(), 1):
        from0, from1 = zero + t00 >= one + t10, zero + t01 > one + t11
        back[2 * i], back[2 * i + 1] = not from0, not from1
        zero, one = (zero + t00 if from0 else one + t10), (zero + t01 if from1 else one + t11) + x
    out = np.zeros(n, dtype=bool)
    state = int(one >= zero)
    for i in range(n - 1, -1, -1):
        out[i] = state
        state = back[2 * i + state]
    return out


def _line_features(stretch: int):
    def run(batches):
        for batch in batches:
            for lo, _, buf, offs in chunks(batch["text"]):
                m = Measured(buf, offs)
                begin = np.searchsorted(m.line_doc, np.arange(len(offs))).tolist()
                at = [(i, k, m.features[k : min(b, k + stretch)]) for i, (a, b) in enumerate(zip(begin[:-1], begin[1:], strict=True)) for k in range(a, b, stretch)]
                rows = pa.array([lo + i for i, _, _ in at], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].take(rows), pa.array([k - begin[i] for i, k, _ in at], pa.int64()), batch["quality"].take(rows), pa.array([x.tobytes() for _, _, x in at], pa.binary())],
                    ["doc_id", "line", "quality", "features"],
                )

    return run


def train(docs: DataFrame, labels: DataFrame | None, *, sample: int = 2000, stretch: int = 200, stretches: int = 4000) -> tuple[np.ndarray, np.ndarray]:
    """The field fitted on the whole texts of at most `sample` labelled documents, cut into
    stretches of `stretch` lines; at most `stretches` of them, drawn by hash from all."""
    if labels is None:
        return fit([])
    some = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    some = some.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.join(F.broadcast(some), "doc_id").select("doc_id", F.col("quality").cast("int").alias("quality"), F.col("text").cast("string").alias("text"))
    rows = texts.mapInArrow(_line_features(stretch), "doc_id long, line long, quality int, features binary")
    rows = rows.orderBy(F.xxhash64("doc_id", "line"), "features", "quality").limit(stretches).collect()
    data = sorted(((bytes(r["features"]), int(r["quality"])) for r in rows), key=lambda r: (r[1], r[0]))
    return fit([(np.frombuffer(f).reshape(-1, len(FEATURES)), q) for f, q in data])


_RESULT = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, content_share double"


def _judged(w: np.ndarray, trans: np.ndarray, least_words: int, most_repeated: int, share: float):
    def run(batches):
        for batch in batches:
            done: list[list] = []
            for _, _, buf, offs in chunks(batch["text"]):
                m = Measured(buf, offs)
                score = m.features @ w
                begin = np.searchsorted(m.line_doc, np.arange(len(offs)))
                content = np.zeros(len(offs) - 1, dtype=np.int64)
                for i, (a, b) in enumerate(zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True)):
                    if b > a:
                        content[i] = m.line_words[a:b][viterbi(score[a:b], trans)].sum()
                failed = (m.n_words < least_words) | (100 * m.n_repeat_words > most_repeated * m.n_words)
                part = content / np.maximum(m.n_words, 1)
                done.append([m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words, failed, ~failed & (part >= share), part])
            if done:
                cols = [pa.array(np.concatenate(c)) for c in zip(*done, strict=True)]
                for c, f in zip(cols, pa_schema(), strict=True):
                    batch = batch.append_column(f, c)
                yield batch

    return run


def pa_schema() -> list[pa.Field]:
    kinds = {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}
    return [pa.field(c.split()[0], kinds[c.split()[1]]) for c in _RESULT.split(", ")]


def judge(docs: DataFrame, labels: DataFrame | None = None, *, least_words: int = 50, most_repeated: int = 50, share: float = 0.5, **sample) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, text, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, kept, content_share. With `labels` (doc_id,
    quality 0/1) the field is fitted on them, without (or with one class) a fixed one serves.

    Null and empty texts have no words and fail. Repeated rows give equal rows; a null
    doc_id stays null; a repeated label counts as its largest. Other columns are ignored;
    an empty table gives an empty result."""
    prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    w, trans = train(docs, labels, **sample)
    return docs.mapInArrow(_judged(w, trans, least_words, most_repeated, share), f"doc_id long, text string, {_RESULT}")


def _good_rows(w: np.ndarray, trans: np.ndarray, least_words: int, most_repeated: int, share: float):
    judged = _judged(w, trans, least_words, most_repeated, share)

    def run(batches):
        for batch in batches:
            for out in judged([batch.select(["text"])]):
                yield batch.filter(out["kept"])

    return run


def keep_good(docs: DataFrame, labels: DataFrame | None = None, *, least_words: int = 50, most_repeated: int = 50, share: float = 0.5, **sample) -> DataFrame:
    """The rows of `docs` that judge() keeps, with all their columns, whatever their names.

    Null and empty texts go; repeated rows stay or go together; a null doc_id stays null. An
    empty table gives an empty result."""
    prepare(docs.sparkSession)
    w, trans = train(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), labels, **sample)
    return docs.mapInArrow(_good_rows(w, trans, least_words, most_repeated, share), docs.schema)
