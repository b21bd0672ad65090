"""MinHash near-duplicate detection by a signature-coordinate inverted join.

Every distinct shingle set gets COORDS minhash coordinates. Two sets at the wanted
similarity agree on at least `need` of them, up to a chance of about 1e-6. A set is
posted under its COORDS - need + 1 rarest coordinate-value pairs only: ordered by
frequency, two sets that agree `need` times share a pair inside these prefixes. Under
each pair collisions are counted on whole signatures and a couple of sets is taken up
only under the first pair that they share, the other postings are skipped. What passes
the match threshold is confirmed on the full sets.

Sets that are equal are one node from the start, and inside a posting list a couple
that is already linked through others is not compared again, so a group of copies
gives links in proportion to its size. Of a value shared by more than BLOCK sets, by exact
count, the sets are first compared with PIVOTS of them. Most of a family of near copies is
one component by then and needs no further comparison among itself: only the others are
compared, with blocks of it and with each other. Where these are many, too, all blocks of
the list are met two at a time. The order by frequency only
needs to be one and the same everywhere: it tells the most frequent values apart, whose
counts are sent to the executors, and takes all others as equally rare.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bitmap, bounds, complete_groups, in_bitmap, partitions, prepare, stage, to_driver
from .components import components
from .tokens import chunks, mix, powers, shingle_sets

COORDS = 96
#: Sets of one posting list that are compared in one task.
BLOCK = 2048
#: Sets of a longer list that all others of it are compared with first.
PIVOTS = 4
#: Posting lists up to this length are turned into couples.
SHORT = 8
#: Counts up to this one are all taken as rare.
RARE = 32
#: Most frequent coordinate-value pairs whose counts are sent to the executors (16 bytes each).
MAX_FREQUENT = 1 << 20
_U = np.uint64


def match_threshold(percent: int, coords: int = COORDS) -> int:
    """Coordinates on which sets of that similarity agree, less five standard deviations."""
    p = percent / 100
    return max(1, math.floor(coords * p - 5 * math.sqrt(coords * p * (1 - p))))


def _multipliers(coords: int) -> np.ndarray:
    return mix(np.arange(1, coords + 1, dtype=np.uint64) * _U(0xD1342543DE82EF95)) | _U(1)


def set_id(shingles: np.ndarray) -> int:
    """64-bit identity of a sorted set of hashes."""
    v = (shingles * powers(len(shingles))).sum(dtype=np.uint64) ^ _U(len(shingles))
    return int(mix(np.array([v], dtype=np.uint64))[0].astype(np.int64))


def _signatures(k: int, coords: int):
    mult = _multipliers(coords)

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for lo, hi, buf, offs in chunks(batch.column(1)):
                sets = shingle_sets(buf, offs, k)
                sizes = np.array([len(s) for s in sets], dtype=np.int64)
                some = np.flatnonzero(sizes)
                sig = np.zeros((hi - lo, coords), dtype=np.uint32)
                if len(some):
                    flat = np.concatenate([sets[i] for i in some])
                    at = np.concatenate([[0], np.cumsum(sizes[some])[:-1]])
                    for c in range(coords):
                        v = ((flat * mult[c]) >> _U(32)).astype(np.uint32)
                        sig[some, c] = np.minimum.reduceat(v, at)
                nodes = [set_id(s) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), pa.array(sizes), pa.array(nodes, pa.int64()), pa.array([r.tobytes() for r in sig], pa.binary())],
                    ["doc_id", "n_shingles", "node", "sig"],
                )

    return run


def _matrix(col) -> np.ndarray:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    n = len(col)
    return np.frombuffer(b"".join(col.to_pylist()), dtype=np.uint32).reshape(n, -1) if n else np.zeros((0, 1), np.uint32)


def _keys(sig: np.ndarray) -> np.ndarray:
    """64-bit hash of every coordinate-value pair."""
    return mix(sig.astype(np.uint64) | (np.arange(1, sig.shape[1] + 1, dtype=np.uint64) << _U(32))[None, :])


def _all_keys(batches):
    for batch in batches:
        u, n = np.unique(_keys(_matrix(batch.column(0))), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(n.astype(np.int64))], ["key", "n"])


def _ranks(keys: np.ndarray, frequent: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank of each key, rare first, and the counts of the frequent ones (0: not frequent)."""
    n = np.zeros(keys.shape, dtype=np.int64)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, keys), len(frequent) - 1)
        n = np.where(frequent[at] == keys, counts[at], 0)
    return (np.minimum(n, (1 << 24) - 1).astype(np.uint64) << _U(40)) | (keys >> _U(24)), n


def _postings(shared, need: int):
    def run(batches):
        frequent, counts = (np.frombuffer(b, dtype=t) for b, t in zip(shared.value, (np.uint64, np.int64), strict=True))
        for batch in batches:
            nodes = batch.column(0).to_numpy()
            sig = _matrix(batch.column(1))
            if not len(nodes):
                continue
            keys = _keys(sig)
            rank, _ = _ranks(keys, frequent, counts)
            keep = min(sig.shape[1], sig.shape[1] - need + 1)
            first = np.argpartition(rank, keep - 1, axis=1)[:, :keep] if keep < sig.shape[1] else np.arange(keep)[None, :].repeat(len(sig), 0)
            key, rank = (np.take_along_axis(x, first, 1).ravel() for x in (keys, rank))
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(rank.view(np.int64)), pa.array(nodes.repeat(keep))], ["key", "rank", "node"])

    return run


def lists(posted: DataFrame, wide: DataFrame) -> DataFrame:
    """(grp, rank, node, side) of the postings (key, rank, node): a list of `wide` (key, n) is
    dealt into blocks, and each couple of blocks is a group, where side tells which of the
    two a row is from (0: both are the same)."""
    wide = wide.select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    split = posted.join(wide, "key", "left").withColumn("own", F.expr("cast(pmod(xxhash64(node), blocks) as int)"))
    split = split.withColumn("other", F.explode(F.expr("if(blocks is null, array(0), sequence(0, blocks - 1))")))
    return split.selectExpr(
        "if(blocks is null, key, xxhash64(key, least(own, other), greatest(own, other))) as grp", "rank", "node",
        "case when blocks is null or own = other then 0 when own < other then 1 else 2 end as side",
    )


def stars(rows: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Groups (grp, rank, node, side) for the long lists `rows` (key, rank, node, n), given the
    components `labels` (node, root) found so far, and the keys that they settle. The most
    common component of a list is compared with all other sets in blocks, not with itself."""
    rows = rows.join(labels, "node", "left")
    common = rows.where("root is not null").groupBy("key", "root").agg(F.count("*").alias("c")).groupBy("key").agg(F.max_by("root", F.struct("c", "root")).alias("common"))
    rows = rows.join(common, "key", "left").withColumn("other", ~F.coalesce(F.col("root") == F.col("common"), F.lit(False)))
    few = rows.groupBy("key").agg(F.count_if("other").alias("others")).where(F.col("others") <= BLOCK)
    rows = stage(rows.join(few, "key").where("others > 0").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")).select("key", "rank", "node", "other", "blocks"))
    same, other = rows.where("not other"), rows.where("other")
    groups = same.selectExpr("xxhash64(key, -1, cast(pmod(xxhash64(node), blocks) as int)) as grp", "rank", "node", "1 as side")
    every = other.withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)")))
    groups = groups.unionAll(every.selectExpr("xxhash64(key, -1, block) as grp", "rank", "node", "2 as side"))
    return groups.unionAll(other.selectExpr("xxhash64(key, -2) as grp", "rank", "node", "0 as side")), few.select("key")


def _collisions(shared, need: int):
    """Of each group the nodes that agree `need` times with another, and whose first
    shared pair is the group's own."""

    def run(batches):
        frequent, counts = (np.frombuffer(b, dtype=t) for b, t in zip(shared.value, (np.uint64, np.int64), strict=True))
        for t in complete_groups(batches, "grp"):
            grp, node = t["grp"].to_numpy(), t["node"].to_numpy()
            rank, side = t["rank"].to_numpy().view(np.uint64), t["side"].to_numpy()
            sig = _matrix(t["sig"])
            begin, end = bounds(grp)
            size = end - begin
            keep = np.zeros(len(grp), dtype=bool)

            def test(x, y):
                """x, y: equally long arrays of row numbers."""
                ok = node[x] != node[y]
                ok &= (side[x] == 0) | (side[x] != side[y])
                x, y = x[ok], y[ok]
                same = sig[x] == sig[y]
                ok = same.sum(1) >= need
                x, y, same = x[ok], y[ok], same[ok]
                if len(x):
                    r, _ = _ranks(_keys(sig[x]), frequent, counts)
                    ok = np.where(same, r, np.uint64(2**64 - 1)).min(1) >= rank[x]
                    keep[x[ok]] = True
                    keep[y[ok]] = True

            two = begin[size == 2]
            for i in range(0, len(two), 4096):
                test(two[i : i + 4096], two[i : i + 4096] + 1)
            for b, e in zip(begin[size > 2].tolist(), end[size > 2].tolist(), strict=True):
                if e - b <= 64:
                    x, y = np.triu_indices(e - b, 1)
                    test(x + b, y + b)
                    continue
                for i in range(b, e - 1):
                    # couples of two nodes that are kept already say nothing new
                    y = np.flatnonzero(~keep[i + 1 : e]) + i + 1 if keep[i] else np.arange(i + 1, e)
                    test(np.full(len(y), i), y)
            if keep.any():
                yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in (grp, node, side, rank.view(np.int64))], ["grp", "node", "side", "rank"])

    return run


def _agreeing(need: int):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                ok = (_matrix(batch.column(2)) == _matrix(batch.column(3))).sum(1) >= need
                yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(ok)) for i in (0, 1)], ["a", "b"])

    return run


def _sets(k: int, bits):
    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for lo, hi, buf, offs in chunks(batch.column(1)):
                sets = [(i, s) for i, s in enumerate(shingle_sets(buf, offs, k)) if len(s)]
                nodes = np.array([set_id(s) for _, s in sets], dtype=np.int64)
                own = np.array([ids[lo + i].as_py() or 0 for i, _ in sets], dtype=np.int64)
                hit = np.flatnonzero(in_bitmap(bits.value, nodes ^ (own << 17))) if len(sets) else []
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes[hit], pa.int64()) if len(sets) else pa.array([], pa.int64()), pa.array([sets[i][1].tobytes() for i in hit], pa.binary())],
                    ["node", "shingles"],
                )

    return run


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, on sorted distinct arrays."""
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < percent * len(b):
        return False
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = int((b[at] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _confirmed(shared, need: int, percent: int):
    """Of each group a forest of the links that hold on the full sets. In a long list a
    couple is compared only if the list is its own (see _collisions) and nothing links it yet."""

    def run(batches):
        frequent, counts = (np.frombuffer(b, dtype=t) for b, t in zip(shared.value, (np.uint64, np.int64), strict=True))
        for t in complete_groups(batches, "grp"):
            grp, nodes, sides, ranks = (t[c].to_numpy() for c in ("grp", "node", "side", "rank"))
            sets, sigs = t["shingles"].cast(pa.large_binary()).combine_chunks(), t["sig"].combine_chunks()
            us, vs = [], []
            for b, e in zip(*(x.tolist() for x in bounds(grp)), strict=True):
                node, first = np.unique(nodes[b:e], return_index=True)
                rows = (first + b).tolist()
                side, rank = sides[rows], ranks[rows].view(np.uint64)
                sig = _matrix(sigs.take(pa.array(rows)))
                full = [np.frombuffer(sets[i].as_buffer(), dtype=np.uint64) for i in rows]
                root = np.arange(len(rows))
                for i in range(len(rows) - 1):
                    y = np.flatnonzero(root[i + 1 :] != root[i]) + i + 1
                    y = y[(side[y] == 0) | (side[y] != side[i])]
                    if len(y) and len(rows) > 2:
                        same = sig[y] == sig[i]
                        ok = same.sum(1) >= need
                        y, same = y[ok], same[ok]
                        r, _ = _ranks(_keys(sig[i : i + 1]), frequent, counts)
                        y = y[np.where(same, r, np.uint64(2**64 - 1)).min(1) >= rank[i]]
                    for j in y.tolist():
                        if root[i] != root[j] and linked(full[i], full[j], percent):
                            root[root == root[j]] = root[i]
                            us.append(int(node[i]))
                            vs.append(int(node[j]))
            if us:
                yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], ["u", "v"])

    return run


def near_duplicates(docs: DataFrame, *, words: int = 5, percent: int = 80, coords: int = COORDS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of `docs` (doc_id, text).

    Words are runs outside ASCII white space, A-Z lowered; a text's set holds its distinct
    `words`-word shingles, or its whole sequence if that is shorter. Sets with
    100 * intersection >= percent * union are linked; component_id is the least doc_id
    reachable, and the document that has it is kept.

    Null or empty texts and texts of white space have no set, are linked with nothing and
    kept. Repeated rows are copies of each other: all have the least doc_id as component
    (rows that repeat the least doc_id itself are all kept). A null doc_id is never least
    unless its whole component has none; such rows are not kept where the component has a
    doc_id. Other columns are ignored; an empty table gives an empty result."""
    spark = docs.sparkSession
    prepare(spark)
    need = match_threshold(percent, coords)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = stage(docs.mapInArrow(_signatures(words, coords), "doc_id long, n_shingles long, node long, sig binary"))
    nodes = stage(signed.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("first"), F.min("sig").alias("sig")))

    counts = nodes.select("sig").mapInArrow(_all_keys, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    heavy = stage(counts.where(F.col("n") > RARE))
    least = max(RARE, nodes.count() * coords // MAX_FREQUENT)  # at most MAX_FREQUENT keys are more frequent
    frequent, times = to_driver(heavy.where(F.col("n") > least))
    order = np.argsort(frequent.view(np.uint64))
    shared = spark.sparkContext.broadcast((frequent[order].tobytes(), times[order].tobytes()))

    sig = nodes.select("node", "sig")

    def agreeing(couples):
        """Groups of the couples (a, b) whose signatures agree."""
        couples = couples.join(sig.toDF("a", "sig_a"), "a").join(sig.toDF("b", "sig_b"), "b").select("a", "b", "sig_a", "sig_b")
        couples = couples.mapInArrow(_agreeing(need), "a long, b long").withColumn("grp", F.xxhash64("a", "b"))
        return couples.select("grp", F.explode(F.array("a", "b")).alias("node"), F.lit(0).alias("side"), F.lit(0).cast("long").alias("rank"))

    def confirmed(active):
        """Links (u, v) of the groups on full sets."""
        active = stage(active)
        marks = active.join(nodes.select("node", "first"), "node").select(F.expr("node ^ shiftleft(coalesce(first, 0L), 17)").alias("k"))
        bits = spark.sparkContext.broadcast(bitmap(marks, "k"))
        sets = docs.mapInArrow(_sets(words, bits), "node long, shingles binary")
        sets = sets.join(active.select("node").distinct(), "node", "left_semi").groupBy("node").agg(F.any_value("shingles").alias("shingles"))
        full = active.distinct().join(sets, "node").join(sig, "node").repartition(partitions(spark), "grp").sortWithinPartitions("grp")
        return full.mapInArrow(_confirmed(shared, need, percent), "u long, v long")

    posted = nodes.select("node", "sig").mapInArrow(_postings(shared, need), "key long, rank long, node long")
    wide, found = stage(heavy.where(F.col("n") > BLOCK)), None
    if wide.isEmpty():
        posted = lists(posted, wide)
    else:
        rows = stage(posted.join(wide, "key"))
        pivot = [F.min(F.struct(F.xxhash64("node", F.lit(i)).alias("h"), "node")).alias(f"p{i}") for i in range(PIVOTS)]
        pivots = rows.groupBy("key").agg(*pivot).select("key", F.explode(F.array_distinct(F.array(*(f"p{i}.node" for i in range(PIVOTS))))).alias("pivot"))
        couples = rows.join(pivots, "key").where("node <> pivot").select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()
        found = stage(confirmed(agreeing(couples)))
        groups, settled = stars(rows, components(found))
        settled = stage(settled)
        posted = lists(posted.join(settled, "key", "left_anti"), wide.join(settled, "key", "left_anti")).unionAll(groups)
    several = stage(posted.withColumn("n", F.count("*").over(Window.partitionBy("grp"))).where("n > 1"))
    # short lists: their couples, each once however many lists it shares; long lists: in one task per list
    couples = (
        several.where(F.col("n") <= SHORT)
        .groupBy("grp")
        .agg(F.array_sort(F.collect_set("node")).alias("nodes"))
        .select(F.explode(F.expr("flatten(transform(nodes, (x, i) -> transform(slice(nodes, i + 2, size(nodes)), y -> struct(x as a, y as b))))")).alias("c"))
        .select("c.a", "c.b")
        .distinct()
    )
    short = agreeing(couples)
    long = several.where(F.col("n") > SHORT).join(sig, "node").select("grp", "rank", "node", "side", "sig")
    long = long.repartition(partitions(spark), "grp").sortWithinPartitions("grp")
    edges = confirmed(short.unionByName(long.mapInArrow(_collisions(shared, need), "grp long, node long, side int, rank long")))
    if found is not None:
        edges = edges.unionAll(found)

    roots = components(edges)
    named = nodes.select("node", "first").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least_id = named.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = named.join(least_id, "root").select("node", "component_id")
    return (
        signed.drop("sig")
        .join(classes, "node", "left")
        .select("doc_id", "n_shingles", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )
