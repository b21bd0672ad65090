"""A log-bilinear language model, trained in numpy with noise-contrastive estimation.

Word counts are taken over all training documents. Every word that stands there LEAST
times has a slot of its own, up to MAX_OWN for the sake of memory and time; all other
words of a class (by ending) share its RARE slots by a hash, and inside one follow smoothed
counts. The neural model gives the next slot from the two before, in two steps: first one
of the WORDS most frequent words or a class, then a slot of that class. Embeddings of the
context through a matrix per position, times the output vector of either step, plus a
bias. Scores are normalised in full, over the symbols of the first step for each distinct
context of a block of text and over the slots of the target's class.

Training documents are dealt into shards of some SHARD_TOKENS by a hash of id and text,
and stand in a shard in the order of that hash. The model starts from one pass over the
START_TOKENS with the least hashes; from there every shard trains on all its tokens, and
each row of parameters is averaged over the shards, weighted by how often a shard used it.
So a rare word's vector comes from the shards that hold it, however many there are, and
the result does not depend on how the table is split (but for the rounding of sums).

Counts of frequent words (at most MAX_COMMON, 16 bytes each) are sent to the executors;
the rarer occurrences are joined with the counts.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions, prepare, stage, to_driver
from .tokens import chunks, mix, words

#: Words that are symbols of the first step (the end is one of them), classes, embedding size.
WORDS, CLASSES, SIZE = 64, 256, 8
#: Occurrences that give a word its own slot, the most such words, and shared slots of a class.
LEAST, MAX_OWN, RARE = 8, 1 << 15, 8
MAX_COMMON = 1 << 19
#: Noise samples and contexts in a training batch, tokens gathered before training on them.
NOISE, INNER_NOISE, BATCH, GATHER = 32, 4, 2048, 1 << 20
#: Tokens of the start, of a shard, and the most shards (beyond, shards grow).
START_TOKENS, SHARD_TOKENS, MOST_SHARDS = 1 << 20, 1 << 21, 1 << 14
#: Rows of parameters that travel together, and shards that are summed at once.
ROWS, TOGETHER = 1024, 64
RATE = 0.15
_END = mix(np.array([0x656E64], dtype=np.uint64))[0]
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32


def tokens(buf: np.ndarray, offs: np.ndarray):
    """(document, hash, shared slot, were it rare) of each token; every document ends with
    the end token. The class is the slot's number without remainder by RARE."""
    n = len(offs) - 1
    doc, s, e, h = words(buf, offs, lower=True)
    if len(s):
        last = _LOWER[buf[e - 1]]
        before = np.where(e - s > 1, _LOWER[buf[np.maximum(e - 2, 0)]], 0).astype(np.uint64)
        third = np.where(e - s > 2, _LOWER[buf[np.maximum(e - 3, 0)]], 0).astype(np.uint64)
        group = (mix(last + (before << np.uint64(8)) + (third << np.uint64(16))) % np.uint64(CLASSES)).astype(np.int32)
        group = group * RARE + ((h >> np.uint64(40)) % np.uint64(RARE)).astype(np.int32)
    else:
        group = np.zeros(0, np.int32)
    at = np.arange(len(doc)) + doc
    count = np.bincount(doc, minlength=n) + 1
    end = np.cumsum(count) - 1
    th, tg = np.full(len(doc) + n, _END), np.zeros(len(doc) + n, np.int32)
    th[at], tg[at] = h, group
    return np.repeat(np.arange(n), count), th, tg, end


def _totals(held):
    h = np.concatenate([x[0] for x in held])
    u, first, at = np.unique(h, return_index=True, return_inverse=True)
    return u, np.concatenate([x[1] for x in held])[first], np.bincount(at, np.concatenate([x[2] for x in held]), minlength=len(u)).astype(np.int64)


def _counts(batches):
    def rows(t):
        return pa.RecordBatch.from_arrays([pa.array(t[0].view(np.int64)), pa.array(t[1]), pa.array(t[2])], ["h", "g", "n"])

    held, size = [], 0
    for batch in batches:
        for _, _, buf, offs in chunks(batch["text"]):
            _, h, g, _ = tokens(buf, offs)
            u, first, n = np.unique(h, return_index=True, return_counts=True)
            held.append((u, g[first], n))
            size += len(u)
            if size > 1 << 21:
                held = [_totals(held)]
                size = len(held[0][0])
                if size > 1 << 20:
                    yield rows(held[0])
                    held, size = [], 0
    if held:
        yield rows(_totals(held))


class Slots:
    """Slots of words: 0 to len(own) - 1 for own words, then those that rare words share."""

    def __init__(self, own: np.ndarray, group: np.ndarray, first: np.ndarray):
        order = np.argsort(own)
        self.own, group, first = own[order], group[order], first[order]
        self.size = len(own) + CLASSES * RARE
        self.end = int(np.searchsorted(self.own, _END))
        # symbols of the first step by slot, and places inside classes (-1: none)
        self.group = np.concatenate([group, np.arange(CLASSES * RARE)]) // RARE
        first = np.concatenate([first, np.zeros(CLASSES * RARE, bool)])
        self.outer = np.where(first, np.cumsum(first) - 1, first.sum() + self.group)
        rest = np.flatnonzero(~first)
        self.by_class = rest[np.argsort(self.group[rest], kind="stable")]
        self.inner = np.full(self.size, -1)
        self.inner[self.by_class] = np.arange(len(self.by_class))
        self.bounds = np.searchsorted(self.group[self.by_class], np.arange(CLASSES + 1))

    def of(self, h: np.ndarray, g: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.own, h), len(self.own) - 1)
        return np.where(self.own[at] == h, at, len(self.own) + g)

    def context(self, slot: np.ndarray, end: np.ndarray):
        """(two before, one before) of each token; before a text stand ends."""
        one = np.concatenate([[self.end], slot[:-1]])
        two = np.concatenate([[self.end, self.end], slot[:-2]])[: len(slot)]
        first = np.concatenate([[0], end[:-1] + 1])
        one[first] = self.end
        two[first] = self.end
        return two, one


class Bilinear:
    NAMES = ("r", "q", "c1", "c2", "b")

    def __init__(self, noise: np.ndarray, seed: int = 7):
        rng = np.random.default_rng(seed)
        n = len(noise)
        self.log_noise = np.log(noise).astype(np.float32)
        self.noise = noise
        self.r = rng.normal(0, 0.3, (n, SIZE)).astype(np.float32)
        self.q = rng.normal(0, 0.05, (n, SIZE)).astype(np.float32)
        self.c1, self.c2 = np.eye(SIZE, dtype=np.float32), 0.5 * np.eye(SIZE, dtype=np.float32)
        self.b = self.log_noise.copy()

    def get(self) -> np.ndarray:
        return np.concatenate([getattr(self, k).ravel() for k in self.NAMES])

    def put(self, flat: np.ndarray) -> None:
        at = 0
        for k in self.NAMES:
            old = getattr(self, k)
            setattr(self, k, flat[at : at + old.size].reshape(old.shape).astype(np.float32))
            at += old.size

    def _step(self, name, g, state, index=None) -> None:
        """An AdaGrad step, on the rows of `index` only where it is given."""
        value = getattr(self, name)
        if name not in state:
            state[name] = np.full(value.shape, 1e-6, dtype=np.float32)
        s = state[name]
        u = slice(None)
        if index is not None:
            order = np.argsort(index)
            index = index[order]
            first = np.flatnonzero(np.concatenate([[True], index[1:] != index[:-1]]))
            u, g = index[first], np.add.reduceat(g[order], first, axis=0)
        now = s[u] + g * g
        s[u] = now
        value[u] += RATE * g / np.sqrt(now)

    def _inside(self, p, target, weight, rng, state):
        """The gradient of the contexts by the second step; there is none here."""
        return 0

    def _symbols(self, slot):
        return slot

    def train(self, two, one, target, weight, rng, state) -> None:
        """One pass over weighted (context, target) types in batches."""
        order = rng.permutation(len(target))
        for i in range(0, len(order), BATCH):
            k = order[i : i + BATCH]
            t2, t1, slot, a = two[k], one[k], target[k], weight[k].astype(np.float32)
            t = self._symbols(slot)
            a /= a.sum()
            noise = np.searchsorted(self.cumulative, rng.random(NOISE))
            r1, r2, qt, qn = self.r[t1], self.r[t2], self.q[t], self.q[noise]
            p = r1 @ self.c1 + r2 @ self.c2
            pos = (p * qt).sum(1) + self.b[t] - self.log_noise[t] - np.float32(np.log(NOISE))
            neg = p @ qn.T + (self.b - self.log_noise)[noise] - np.float32(np.log(NOISE))
            up = a / (1 + np.exp(np.clip(pos, -30, 30)))
            down = -a[:, None] / (1 + np.exp(-np.clip(neg, -30, 30)))
            dp = up[:, None] * qt + down @ qn + self._inside(p, slot, a, rng, state)
            d1, d2, dc1, dc2 = dp @ self.c1.T, dp @ self.c2.T, r1.T @ dp, r2.T @ dp
            self._step("q", np.concatenate([up[:, None] * p, down.T @ p]), state, np.concatenate([t, noise]))
            self._step("b", np.concatenate([up, down.sum(0)]), state, np.concatenate([t, noise]))
            self._step("r", np.concatenate([d1, d2]), state, np.concatenate([t1, t2]))
            self._step("c1", dc1, state)
            self._step("c2", dc2, state)

    @property
    def cumulative(self):
        c = np.cumsum(self.noise)
        return c / c[-1]

    def tables(self):
        """Base-10 scores so that log10 p(w | two, one) = s1[one, w] + s2[two, w] - z[two, one]."""
        s1 = (self.r @ self.c1 @ self.q.T + self.b).astype(np.float32)
        s2 = (self.r @ self.c2 @ self.q.T).astype(np.float32)
        z = np.empty((len(s2), len(s1)), dtype=np.float32)
        e1 = np.exp(s1 - s1.max())
        for i, row in enumerate(s2):
            z[i] = np.log(e1 @ np.exp(row)) + s1.max()
        log10 = np.float32(np.log(10))
        return s1 / log10, s2 / log10, z / log10


class Factored(Bilinear):
    """The model of both steps; `mass` has the occurrences by slot."""

    NAMES = (*Bilinear.NAMES, "q2", "b2")

    def __init__(self, slots: Slots, mass: np.ndarray, seed: int = 7):
        outer = np.bincount(slots.outer, mass)
        super().__init__(outer / outer.sum(), seed)
        rng = np.random.default_rng(seed + 1)
        self.slots = slots
        self.r = rng.normal(0, 0.3, (slots.size, SIZE)).astype(np.float32)
        inner = mass[slots.by_class]
        self.sums = np.concatenate([[0.0], np.cumsum(inner)])
        lo, hi = slots.bounds[:-1], slots.bounds[1:]
        self.log_share = np.log(inner / np.repeat(self.sums[hi] - self.sums[lo], hi - lo)).astype(np.float32)
        self.q2 = rng.normal(0, 0.05, (len(inner), SIZE)).astype(np.float32)
        self.b2 = self.log_share.copy()

    def _symbols(self, slot):
        return self.slots.outer[slot]

    def _inside(self, p, target, weight, rng, state):
        out = np.zeros_like(p)
        rows = np.flatnonzero(self.slots.inner[target] >= 0)
        if not len(rows):
            return out
        rows = rows[np.argsort(self.slots.group[target[rows]], kind="stable")]  # class by class
        t, g, p, a = self.slots.inner[target[rows]], self.slots.group[target[rows]], p[rows], weight[rows]
        first = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
        own = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(g))))
        # the tokens of a class in a batch share its noise
        lo, hi = self.slots.bounds[g[first]][:, None], self.slots.bounds[g[first] + 1][:, None]
        draw = self.sums[lo] + rng.random((len(first), INNER_NOISE)) * (self.sums[hi] - self.sums[lo])
        noise = np.clip(np.searchsorted(self.sums, draw, "right") - 1, lo, hi - 1)
        shift = np.float32(np.log(INNER_NOISE))
        qt, qn = self.q2[t], self.q2[noise][own]
        pos = (p * qt).sum(1) + self.b2[t] - self.log_share[t] - shift
        neg = np.einsum("ij,ikj->ik", p, qn) + (self.b2[noise] - self.log_share[noise])[own] - shift
        up = a / (1 + np.exp(np.clip(pos, -30, 30)))
        down = -a[:, None] / (1 + np.exp(-np.clip(neg, -30, 30)))
        out[rows] = up[:, None] * qt + np.einsum("ik,ikj->ij", down, qn)
        each = np.add.reduceat(down[:, :, None] * p[:, None, :], first, axis=0).reshape(-1, SIZE)
        at = np.concatenate([t, noise.ravel()])
        self._step("q2", np.concatenate([up[:, None] * p, each]), state, at)
        self._step("b2", np.concatenate([up, np.add.reduceat(down, first, axis=0).ravel()]), state, at)
        return out

    def log10(self, two, one, target, block: int = 1 << 12):
        """log10 p(target | two, one) of slots."""
        slots = self.slots
        u, at = np.unique(two.astype(np.int64) * slots.size + one, return_inverse=True)
        p = np.ones((len(u), SIZE + 1), dtype=np.float32)  # the last column takes the bias
        p[:, :-1] = self.r[u % slots.size] @ self.c1 + self.r[u // slots.size] @ self.c2
        q, q2 = (np.concatenate([x, b[:, None]], axis=1).T for x, b in ((self.q, self.b), (self.q2, self.b2)))

        def norm(p, q):
            """Log of the sum of exponentials of each row of p @ q."""
            x = p @ q
            np.exp(x, out=x)
            total = x @ np.ones(x.shape[1], dtype=np.float32)
            if np.isfinite(total).all() and total.min(initial=1) > 0:
                return np.log(total)
            x = p.astype(np.float64) @ q
            top = x.max(1)
            return top + np.log(np.exp(x - top[:, None]).sum(1))

        with np.errstate(over="ignore"):
            z = np.concatenate([np.zeros(0), *(norm(p[i : i + block], q) for i in range(0, len(p), block))])
            t = slots.outer[target]
            out = ((p[at, :-1] * self.q[t]).sum(1) + self.b[t] - z[at]).astype(np.float64)
            inner = slots.inner[target]
            rows = np.flatnonzero(inner >= 0)
            group = slots.group[target[rows]].astype(np.uint16)
            order = np.argsort(group, kind="stable")
            rows, cuts = rows[order], np.searchsorted(group[order], np.arange(CLASSES + 1))
            mine = p[at[rows]]
            out[rows] += (mine * q2.T[inner[rows]]).sum(1) * (np.diff(slots.bounds) > 1)[group[order]]
            for g in np.flatnonzero((np.diff(cuts) > 0) & (np.diff(slots.bounds) > 1)).tolist():
                lo, hi = slots.bounds[g], slots.bounds[g + 1]
                for i in range(cuts[g], cuts[g + 1], block):
                    k = slice(i, min(i + block, cuts[g + 1]))
                    out[rows[k]] -= norm(mine[k], q2[:, lo:hi])
        return out / np.log(10)

    def rows(self) -> np.ndarray:
        """All parameters as rows of one matrix: contexts, both steps with bias, positions."""
        parts = [(self.r, 0), (self.q, self.b[:, None]), (self.q2, self.b2[:, None]), (self.c1, 0), (self.c2, 0)]
        return np.concatenate([np.concatenate([m, np.broadcast_to(np.float32(b), (len(m), 1))], axis=1) for m, b in parts])

    def set_rows(self, rows: np.ndarray) -> None:
        cuts = np.cumsum([len(x) for x in (self.r, self.q, self.q2, self.c1)])
        r, q, q2, c1, c2 = (x.astype(np.float32) for x in np.split(rows, cuts))
        self.r, self.c1, self.c2 = (np.ascontiguousarray(x[:, :-1]) for x in (r, c1, c2))
        (self.q, self.b), (self.q2, self.b2) = ((np.ascontiguousarray(x[:, :-1]), x[:, -1].copy()) for x in (q, q2))

    def uses(self, two, one, target) -> np.ndarray:
        """How often each of rows() is used by these tokens (the noise apart)."""
        n, own = self.slots.size, self.slots.inner[target]
        context = np.bincount(one, minlength=n) + np.bincount(two, minlength=n)
        inner = np.bincount(own[own >= 0], minlength=len(self.b2))
        rest = np.full(len(self.q), len(target)), np.full(2 * SIZE, len(target))
        return np.concatenate([context, rest[0], inner, rest[1]]).astype(np.float32)


def _slotted(shared, shards: int):
    """(shard, order, slots) of training texts."""

    def run(batches):
        slots = shared.value
        for batch in batches:
            order = batch.column(0).to_numpy()
            for lo, hi, buf, offs in chunks(batch.column(1)):
                _, h, g, end = tokens(buf, offs)
                slot = slots.of(h, g).astype(np.int32)
                cut = np.concatenate([[0], end + 1]).tolist()
                own = order[lo:hi]
                rows = [slot[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array((own.view(np.uint64) % np.uint64(shards)).astype(np.int32)), pa.array(own), pa.array(rows, pa.binary())], ["shard", "order", "slots"])

    return run


def _gathered(batches, slots: Slots, most: int | None = None):
    """(two, one, target) of the tokens of sorted rows, GATHER at a time, at most `most`."""
    n, held, size, done = slots.size, [], 0, 0
    for batch in batches:
        for text in batch.column(2):
            slot = np.frombuffer(text.as_buffer(), dtype=np.int32).astype(np.int64)
            two, one = slots.context(slot, np.array([len(slot) - 1]))
            held.append((two * n + one) * n + slot)
            size += len(slot)
            while size >= GATHER or (most is not None and done + size >= most):
                all_ = np.concatenate(held)
                take = GATHER if most is None else min(GATHER, most - done)
                yield all_[:take]
                held, size, done = [all_[take:]], len(all_) - take, done + take
                if done == most:
                    return
    if size:
        yield np.concatenate(held)


def _learn(model: Factored, packed: np.ndarray, rng, state) -> np.ndarray:
    """Trains on packed tokens; returns the uses of the rows."""
    n = model.slots.size
    u, count = np.unique(packed, return_counts=True)
    model.train(u // (n * n), u // n % n, u % n, count, rng, state)
    return model.uses(packed // (n * n), packed // n % n, packed % n)


def _started(shared):
    """Parameters and the state of their steps after the start."""

    def run(batches):
        slots, mass = shared.value
        model, state, rng = Factored(slots, mass), {}, np.random.default_rng(1)
        for packed in _gathered(batches, slots, START_TOKENS):
            _learn(model, packed, rng, state)
        steps = {k: v.tobytes() for k, v in state.items()}
        names = sorted(steps)
        yield pa.RecordBatch.from_arrays([pa.array(["", *names]), pa.array([model.rows().tobytes(), *(steps[k] for k in names)], pa.binary())], ["name", "params"])

    return run


_PARTS = "block int, together int, shard int, uses binary, total binary"


def _emitted(block: int, together: int, shard: int, uses: np.ndarray, total: np.ndarray):
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
    row = (block, together, shard, uses.astype(np.float32).tobytes(), total.astype(np.float32).tobytes())
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], [c.split()[0] for c in _PARTS.split(", ")])


def _trained(shared):
    """Of the one shard of a partition, the parameter rows it used, times their uses."""

    def run(batches):
        slots, mass, start, steps = shared.value
        first = next(batches, None)
        if first is None:
            return
        shard = first.column(0)[0].as_py()
        model, rng = Factored(slots, mass), np.random.default_rng([2, shard])
        model.set_rows(start)
        state, uses = {k: v.copy() for k, v in steps.items()}, None
        for packed in _gathered(itertools.chain([first], batches), slots):
            now = _learn(model, packed, rng, state)
            uses = now if uses is None else uses + now
        if uses is not None:
            total = model.rows() * uses[:, None]
            for block, at in enumerate(range(0, len(uses), ROWS)):
                if uses[at : at + ROWS].any():
                    yield _emitted(block, shard // TOGETHER, shard, uses[at : at + ROWS], total[at : at + ROWS])

    return run


def _summed(batches):
    """Sums of the rows of one (block, together), which are sorted."""
    key, uses, total = None, 0.0, 0.0
    for batch in batches:
        for block, together, _, u, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key != (block, together):
                if key is not None:
                    yield _emitted(key[0], 0, key[1], uses, total)
                key, uses, total = (block, together), 0.0, 0.0
            uses = uses + np.frombuffer(u, dtype=np.float32).astype(np.float64)
            total = total + np.frombuffer(t, dtype=np.float32).astype(np.float64)
    if key is not None:
        yield _emitted(key[0], 0, key[1], uses, total)


def trained(training: DataFrame, slots: Slots, mass: np.ndarray, tokens_: int) -> Factored:
    """The model of the rows (order, text); see the module's text."""
    spark, model = training.sparkSession, Factored(slots, mass)
    shards = max(1, min(MOST_SHARDS, -(-tokens_ // SHARD_TOKENS)))
    slotted = training.mapInArrow(_slotted(spark.sparkContext.broadcast(slots), shards), "shard int, order long, slots binary")
    # a sample by hash with some more tokens than the start takes
    part = F.col("order").bitwiseAND(F.lit((1 << 32) - 1)) <= F.lit(int(min(1.0, 1.1 * START_TOKENS / max(tokens_, 1)) * ((1 << 32) - 1)))
    first = training.where(part).mapInArrow(_slotted(spark.sparkContext.broadcast(slots), shards), "shard int, order long, slots binary")
    first = first.repartitionById(1, F.lit(0)).sortWithinPartitions("order", "slots")
    got = {r["name"]: np.frombuffer(bytes(r["params"]), dtype=np.float32) for r in stage(first.mapInArrow(_started(spark.sparkContext.broadcast((slots, mass))), "name string, params binary")).collect()}
    shapes = {k: getattr(model, k).shape for k in model.NAMES}
    start = got[""].reshape(-1, SIZE + 1) if "" in got else model.rows()
    steps = {k: v.reshape(shapes[k]) for k, v in got.items() if k}
    rows = slotted.repartitionById(shards, F.col("shard")).sortWithinPartitions("order", "slots")
    rows = rows.mapInArrow(_trained(spark.sparkContext.broadcast((slots, mass, start, steps))), _PARTS)
    for by in (("block", "together"), ("block",)):
        rows = rows.repartition(partitions(spark), *by).sortWithinPartitions("block", "together", "shard").mapInArrow(_summed, _PARTS)
    out = start.copy()
    for r in stage(rows).toLocalIterator():
        uses = np.frombuffer(bytes(r["uses"]), dtype=np.float32)
        total = np.frombuffer(bytes(r["total"]), dtype=np.float32).reshape(len(uses), -1)
        at = r["block"] * ROWS + np.flatnonzero(uses)
        out[at] = total[uses > 0] / uses[uses > 0, None]
    model.set_rows(out)
    return model


_SCORED = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, rare array<struct<h: bigint, n: bigint>>"


def _scored(shared):
    def run(batches):
        model, common_h, common_c, class_norm, base_norm = shared.value
        slots = model.slots
        log_c = np.log10(common_c + 0.5)
        row0 = TaskContext.get().partitionId() << 33
        done = 0
        for batch in batches:
            for lo, hi, buf, offs in chunks(batch["text"]):
                n = hi - lo
                doc, h, g, end = tokens(buf, offs)
                slot = slots.of(h, g)
                two, one = slots.context(slot, end)
                score = model.log10(two, one, slot)
                u, at = np.unique(h, return_inverse=True)
                k = np.minimum(np.searchsorted(common_h, u), max(len(common_h) - 1, 0))
                known = (common_h[k] == u) if len(common_h) else np.zeros(len(u), bool)
                value = np.where(known, log_c[k], 0.0) if len(common_h) else np.zeros(len(u))
                own = slot < len(slots.own)
                score += np.where(own, 0.0, value[at] - class_norm[np.where(own, 0, slot - len(slots.own))])
                base = value[at] - base_norm
                miss = np.flatnonzero(~known[at])
                order = miss[np.lexsort((h[miss], doc[miss]))]
                d, x = doc[order], h[order]
                first = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (x[1:] != x[:-1])])) if len(d) else np.zeros(0, np.int64)
                times = np.diff(np.concatenate([first, [len(d)]])) if len(d) else first
                pairs = pa.StructArray.from_arrays([pa.array(x[first].view(np.int64)), pa.array(times.astype(np.int64))], ["h", "n"])
                rare = pa.ListArray.from_arrays(pa.array(np.searchsorted(d[first], np.arange(n + 1)).astype(np.int32)), pairs)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row0 + done + np.arange(n)),
                        batch["doc_id"].slice(lo, n),
                        batch["held_out"].slice(lo, n),
                        pa.array(np.bincount(doc, minlength=n)),
                        pa.array(np.bincount(doc, known[at], minlength=n).astype(np.int64)),
                        pa.array(np.bincount(doc, base, minlength=n)),
                        pa.array(np.bincount(doc, score, minlength=n)),
                        rare,
                    ],
                    ["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", "rare"],
                )
                done += n

    return run


def score(docs: DataFrame, *, folds: int = 5, held_fold: int = 1) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row of
    `docs` (doc_id, text); documents with crc32(doc_id) mod `folds` = held_fold are held out
    of counts and training. Scores are base-10 log-probabilities of the whole text.

    Null and empty texts are one end token. Repeated rows count as often as they stand; a
    null doc_id counts as '' and trains. How the table is split does not matter. Without any training document every word is
    unknown and all slots are equally likely. Other columns are ignored; an empty table
    gives an empty result."""
    spark = docs.sparkSession
    prepare(spark)
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % folds == held_fold
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), held.alias("held_out"))
    training = docs.where(~F.col("held_out")).select(F.xxhash64("doc_id", "text").alias("order"), "text")
    counts = stage(training.select("text").mapInArrow(_counts, "h long, g int, n long").groupBy("h").agg(F.max("g").alias("g"), F.sum("n").alias("c")))

    groups = {r["g"]: (r["n"], r["v"]) for r in counts.groupBy("g").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()}
    total, distinct = sum(n for n, _ in groups.values()), sum(v for _, v in groups.values())
    end = int(_END.astype(np.int64))
    top = counts.where(F.col("h") != end).orderBy(F.desc("c"), "h").limit(MAX_OWN).select("h", F.col("g").cast("long").alias("g"), "c")
    top = sorted(zip(*(x.tolist() for x in to_driver(top)), strict=True), key=lambda r: (-r[2], r[0]))
    top = [r for i, r in enumerate(top) if i < WORDS - 1 or r[2] >= LEAST]
    own = {h: (g, c) for h, g, c in top} | {r["h"]: (r["g"], r["c"]) for r in counts.where(F.col("h") == end).collect()}
    left_n, left_v = np.zeros(CLASSES * RARE), np.zeros(CLASSES * RARE)
    for g, (n, v) in groups.items():
        left_n[g], left_v[g] = n, v
    for g, c in own.values():
        left_n[g] -= c
        left_v[g] -= 1
    own.setdefault(end, (0, 0))
    first = {end, *(h for h, _, _ in top[: WORDS - 1])}
    slots = Slots(np.array([*own], dtype=np.int64).view(np.uint64), np.array([g for g, _ in own.values()]), np.array([h in first for h in own]))
    mass = np.array([own[h][1] for h in slots.own.view(np.int64).tolist()] + left_n.tolist()) + 0.5

    model = trained(training, slots, mass, total)

    size = F.floor(F.log2("c") * 8).cast("int")
    least, many = None, 0
    for r in counts.groupBy(size.alias("b")).count().orderBy(F.desc("b")).collect():
        many += r["count"]
        if many > MAX_COMMON:
            break
        least = r["b"]
    some = counts.where(size >= least) if least is not None else counts.where("false")
    common_h, common_c = to_driver(some.select("h", "c"))
    common_h = common_h.view(np.uint64)
    order = np.argsort(common_h)
    common_h, common_c = common_h[order], common_c[order]
    shared = spark.sparkContext.broadcast(
        (model, common_h, common_c, np.log10(left_n + 0.5 * (left_v + 1)), float(np.log10(total + 0.5 * (distinct + 1))))
    )
    scored = stage(docs.mapInArrow(_scored(shared), _SCORED))
    rare = scored.where("size(rare) > 0").select("row", F.explode("rare").alias("x")).select("row", "x.h", "x.n")
    rare = rare.join(counts.where(size < least).select("h", "c") if least is not None else counts.select("h", "c"), "h", "left")
    more = rare.groupBy("row").agg(
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + F.lit(0.5))).alias("more"), F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("k")
    )
    out = scored.drop("rare").join(more, "row", "left")
    extra = F.coalesce("more", F.lit(0.0))
    return out.select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("k", F.lit(0))).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("base") + extra).alias("base_score"),
        (F.col("score") + extra).alias("score"),
    )
