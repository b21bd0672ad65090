"""Each operator against a brute-force version, and on the awkward cases: nulls, empty and
long texts, ties, repeated rows, empty tables, extra columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from pyspark.sql import functions

from spindrel.llm import chat, common, components, decontaminate, html, language, minhash, mixing, pii, quality, secrets, spans, substrings, tokens

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node long, grp string, key string, h long"


def prose(seed, n, vocabulary=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


def documents():
    base = prose(1, 120)
    words = base.split()
    rows = [
        (1, base), (2, base), (3, base.upper()), (4, " ".join(["new", *words[1:]])), (5, " ".join(words[:60] + ["x", "y"] + words[60:])),
        (6, prose(2, 200)), (7, prose(2, 200) + " tail end"), (8, None), (9, ""), (10, " \t\n "), (11, "one"), (12, "One"), (13, "two words"),
        (14, "é" * 5 + "   non breaking spaces"), (15, prose(3, 30000, 5000)), (16, prose(4, 80)), (16, prose(4, 80)), (None, prose(5, 60)), (None, base),
        (20, "loop " * 300), (21, "a b c d " * 40 + "\na b\na b\n\nc"),
    ]
    return [(i, t, "en" if (i or 0) % 3 else None, f"src{(i or 0) % 4}", 0, 1, "g", "k", 2) for i, t in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(documents(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words_of(text):
    return [w.decode() for w in (text or "").encode().lower().split()]


# ---- tokens


def test_words_and_windows():
    import pyarrow as pa

    texts = ["a b", None, "", "c", " d  e\x0bf ", "A", "a" * 5000, " x y"]
    for _, _, buf, offs in tokens.chunks(pa.array(texts)):
        doc, s, e, h = tokens.words(buf, offs, lower=True)
        assert [bytes(buf[a:b]).decode() for a, b in zip(s, e, strict=True)] == [w for t in texts for w in WORD.findall(t or "")]
        assert h[0] == h[6] and len(set(h.tolist())) == len(h) - 1
        assert doc.tolist() == [i for i, t in enumerate(texts) for _ in WORD.findall(t or "")]


# ---- 1 near-duplicates


def brute_components(rows, k, percent):
    sets = {}
    for n, (i, t) in enumerate(rows):
        w = words_of(t)
        sets[n] = frozenset(tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))) if w else frozenset()
    top = list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                top[find(a)] = find(b)
    groups = {}
    for n, (i, _) in enumerate(rows):
        groups.setdefault(find(n), []).append(i)
    out = []
    for n, (i, _) in enumerate(rows):
        ids = [x for x in groups[find(n)] if x is not None]
        least = i if not sets[n] else min(ids) if ids else None
        out.append((i, len(sets[n]), least, i == least))
    return sorted(out, key=str)


@pytest.mark.parametrize(("k", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates(docs, k, percent):
    got = minhash.near_duplicates(docs, words=k, percent=percent).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_components([(r[0], r[1]) for r in documents()], k, percent)


def test_near_duplicates_of_a_large_family(spark, monkeypatch):
    """Lists longer than a block, with members on both sides of the limit."""
    monkeypatch.setattr(minhash, "BLOCK", 8)
    monkeypatch.setattr(minhash, "MAX_FREQUENT", 1 << 30)
    base = prose(9, 150).split()
    rows = []
    for i in range(120):
        r, w = random.Random(i), list(base)
        for _ in range(i % 12):
            w[r.randrange(len(w))] = f"z{r.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=3, percent=85).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_components(rows, 3, 85)


def test_near_duplicates_empty(empty):
    assert minhash.near_duplicates(empty).count() == 0


def test_match_threshold_keeps_almost_all():
    for percent in (80, 85, 95):
        need, p = minhash.match_threshold(percent), percent / 100
        lost = sum(math.comb(96, k) * p**k * (1 - p) ** (96 - k) for k in range(need))
        assert lost < 1e-5


def test_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 200), (200, 100), (7, 7), (300, 300)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**dict.fromkeys(range(51), 0), 100: 100, 200: 100}


# ---- 2 quality


def brute_counts(text):
    t = text or ""
    w = WORD.findall(t)
    runs = Counter(tuple(w[j : j + 3]) for j in range(len(w) - 2))
    hit = {j + d for j in range(len(w) - 2) if runs[tuple(w[j : j + 3])] > 1 for d in range(3)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(hit), len(w) < 50 or 100 * len(hit) > 50 * len(w)


def test_quality_counts(docs, spark):
    labels = spark.createDataFrame([(1, 1), (6, 1), (20, 0), (21, 0), (None, 1), (8, 0)], "doc_id long, quality int")
    got = quality.judge(docs, labels).collect()
    assert sorted((r["doc_id"], *tuple(r)[2:8]) for r in got if r["doc_id"] is not None) == sorted((i, *brute_counts(t)) for i, t, *_ in documents() if i is not None)
    assert all(not r["kept"] for r in got if r["base_failed"])
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r["kept"] for r in got)


def test_quality_learns_noise(spark):
    good = [(i, ("The quick words run here. " * 3 + prose(i, 80, 3000)).strip()) for i in range(40)]
    bad = [(100 + i, prose(i, 80, 3000).replace(" ", "### ")) for i in range(40)]
    labels = [(i, 1) for i, _ in good[:20]] + [(i, 0) for i, _ in bad[:20]]
    got = quality.judge(spark.createDataFrame(good + bad, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    assert all(r["kept"] == (r["doc_id"] < 100) for r in got)


def test_quality_on_held_out_labels(spark):
    d, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    held = "crc32(cast(doc_id as string)) % 5 = 1"
    judged = quality.judge(d, labels.where(f"not ({held})")).join(labels.where(held).select("doc_id", "quality"), "doc_id").where("not base_failed").collect()
    bad, good = ([r["kept"] for r in judged if r["quality"] == q] for q in (0, 1))
    assert len(bad) > 5 and len(good) > 40 and sum(bad) <= 0.05 * len(bad) and sum(good) >= 0.98 * len(good)


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(1)
    for _ in range(30):
        scores, trans = rng.normal(size=6), rng.normal(size=(2, 2))

        def total(path):
            return sum(s for s, y in zip(scores, path, strict=True) if y) + sum(trans[a, b] for a, b in zip(path, path[1:]))  # noqa: B905, B023

        best = max((tuple((n >> k) & 1 for k in range(6)) for n in range(64)), key=total)
        assert tuple(quality.viterbi(scores, trans).astype(int)) == best


def test_field_is_fitted_on_whole_texts(spark):
    """Bad documents differ from good ones beyond line 200 only."""
    same = "\n".join("The quick words run here and there." for _ in range(250))
    rows = [(i, same + "\n" + "\n".join(("### " if i % 2 else "a sentence with words. ") + prose(i * 100 + k, 9) for k in range(300))) for i in range(20)]
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(i, 1 - i % 2) for i in range(20)], "doc_id long, quality int")
    w, trans = quality.train(docs, labels)
    assert w[quality.FEATURES.index("symbols")] < quality.PRIOR[quality.FEATURES.index("symbols")] - 0.05
    again = quality.train(docs.repartition(5), labels)
    assert np.allclose(w, again[0]) and np.allclose(trans, again[1])


def test_marginals_of_the_field_by_enumeration(monkeypatch):
    """One step of the fit against sums over all labellings."""
    import itertools

    rng = np.random.default_rng(4)
    data = [(np.abs(rng.normal(size=(n, len(quality.FEATURES)))), q) for n, q in ((3, 1), (1, 0), (5, 0), (2, 1))]
    w0 = rng.normal(size=len(quality.FEATURES))
    monkeypatch.setattr(quality, "_logistic", lambda *a, **k: w0)
    w, trans = quality.fit(data, steps=1)
    grad, pairs, n = np.zeros_like(w0), np.zeros((2, 2)), 0
    for x, q in data:
        y = x @ w0 > (0 if q else 1)
        paths = list(itertools.product((0, 1), repeat=len(x)))
        weight = np.exp([sum(s for s, k in zip(x @ w0, path, strict=True) if k) for path in paths])
        weight /= weight.sum()
        grad += (y - np.array(paths).T @ weight) @ x
        for path, p in zip(paths, weight, strict=True):
            for a, b in itertools.pairwise(path):
                pairs[a, b] -= p
        for a, b in itertools.pairwise(y.astype(int)):
            pairs[a, b] += 1
        n += len(x)
    assert np.allclose(w, w0 + 0.5 * (grad / n - 1e-3 * (w0 - quality.PRIOR))) and np.allclose(trans, 0.5 * pairs / n)


def test_quality_empty(empty):
    assert quality.judge(empty, None).count() == 0


# ---- 3 substrings


def brute_removed(rows, k):
    all_words = [(i, [w.decode() for w in (t or "").encode().split()]) for i, t in rows]
    count = Counter(tuple(w[j : j + k]) for _, w in all_words for j in range(len(w) - k + 1))
    out = []
    for i, w in all_words:
        gone = {j + d for j in range(len(w) - k + 1) if count[tuple(w[j : j + k])] > 1 for d in range(k)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("size", [1 << 20, 97])
def test_remove_repeated(docs, monkeypatch, size):
    monkeypatch.setattr(substrings, "CHUNK_WINDOWS", size)
    got = substrings.remove_repeated(docs, window=35, digest=True).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_removed([(r[0], r[1]) for r in documents()], 35)


def test_packed_hashes_round_trip():
    rng = np.random.default_rng(3)
    for n in (1, 2, 1000):
        h = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        assert (substrings._unpacked(substrings._packed(h)) == h).all()
    near = np.arange(5, dtype=np.uint64) + np.uint64(7)
    assert (substrings._unpacked(substrings._packed(near)) == near).all()


def test_remove_repeated_empty(empty):
    assert substrings.remove_repeated(empty).count() == 0


# ---- 4 decontamination


def test_leaks(spark, docs):
    item = prose(77, 40, 10**6)
    edited = item.split()
    for k in range(3, 40, 6):
        edited[k] = "changed"
    rows = [(1, prose(5, 300) + " " + item + " " + prose(6, 100)), (2, prose(7, 200) + " " + " ".join(edited)), (3, prose(8, 400)), (4, None), (5, ""), (1, prose(5, 300) + " " + item)]
    bench = spark.createDataFrame([(7, item, "x"), (8, prose(99, 30, 10**6), "x"), (9, None, ""), (None, "short", "")], "item_id long, text string, lang string")
    got = decontaminate.find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == [(1, 7), (1, 7), (2, 7)]
    kept = decontaminate.drop_leaked(spark.createDataFrame(rows, "doc_id long, text string"), bench)
    assert sorted(r[0] for r in kept.collect()) == [3, 4, 5]
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_leaks(docs, none).count() == 0
    assert decontaminate.drop_leaked(docs, none).count() == docs.count()


def plain_alignment(a, b):
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            h[i + 1][j + 1] = max(0, h[i][j] + (2 if x == y else -1), h[i][j + 1] - 1, h[i + 1][j] - 1)
    return max(map(max, h))


def test_leaks_against_alignment_of_everything(spark):
    """Every document against every item by the whole recurrence, without seeds."""
    r = random.Random(11)
    items = {i: prose(200 + i, r.choice([2, 5, 12, 25, 130]), 10**5).split() for i in range(25)}
    rows = []
    for d in range(80):
        words = prose(300 + d, r.randrange(0, 120), 10**5).split()
        for _ in range(r.randrange(3)):
            x = list(items[r.randrange(25)])
            cut = x[: r.choice([len(x), len(x), 60, len(x) // 3 + 1])]
            for _ in range(r.randrange(1 + len(cut) // 4)):
                k = r.randrange(len(cut))
                cut[k : k + r.randrange(2)] = r.choice([[], ["new"], ["two", "more"]])
            at = r.randrange(len(words) + 1)
            words[at:at] = cut
        rows.append((d, " ".join(words)))
    want = set()
    for d, t in rows:
        w = t.split()
        for i, x in items.items():
            grams = {tuple(x[k : k + 3]) for k in range(max(1, len(x) - 2))}
            seeded = any(tuple(w[k : k + len(g)]) == g for g in grams for k in range(len(w)))
            if seeded and plain_alignment(x, w) >= 2 * min(0.5 * len(x), 50):
                want.add((d, i))
    bench = spark.createDataFrame([(i, " ".join(x)) for i, x in items.items()], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    assert got == want and len(want) > 40 and any(len(items[i]) == 2 for _, i in want) and any(len(items[i]) == 130 for _, i in want)


def test_common_words_are_no_leak(spark):
    rows = [(i, "yes we can " + prose(i, 30)) for i in range(100)]
    bench = spark.createDataFrame([(1, "yes"), (2, "we can")], "item_id long, text string")
    assert decontaminate.find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), bench).count() == 0


def test_smith_waterman_against_plain_recurrence():
    rng = np.random.default_rng(5)
    for _ in range(20):
        a, b = rng.integers(0, 4, 7), rng.integers(0, 4, 12)
        h = np.zeros((8, 13), dtype=int)
        for i in range(7):
            for j in range(12):
                h[i + 1, j + 1] = max(0, h[i, j] + (2 if a[i] == b[j] else -1), h[i, j + 1] - 1, h[i + 1, j] - 1)
        assert decontaminate.smith_waterman(a, b)[0] == h.max()


# ---- 5 chat


def test_preferences(spark):
    rows = [
        (1, True, 0, "user", "hi"), (1, True, 1, "assistant", "good"), (1, False, 0, "user", "hi"), (1, False, 1, "assistant", "bad"), (1, False, 2, "user", "why"),
        (2, True, 0, "user", None), (3, False, 0, None, "only"), (4, True, 0, "user", "x"), (4, False, 0, "user", "x"), (None, True, 0, "user", "x"), (5, None, 0, "user", "x"),
    ]
    got = {r["pair_id"]: r for r in chat.preference_pairs(spark.createDataFrame(rows, "pair_id long, is_chosen boolean, turn long, role string, text string")).collect()}
    assert set(got) == {1, 2, 3, 4}
    one = got[1]
    assert one["n_common"] == 1 and one["prompt"] == "<|im_start|>user\nhi<|im_end|>\n"
    s, e = map(int, one["chosen_mask"].split(":"))
    assert one["chosen"][s:e] == "good<|im_end|>"
    s, e = map(int, one["rejected_mask"].split(":"))
    assert one["rejected"][s:e] == "bad<|im_end|>"
    assert got[3]["chosen"] == "" and got[3]["n_common"] == 0
    assert got[4]["n_common"] == 1 and got[4]["chosen"] == got[4]["rejected"] == ""


def test_preferences_empty(spark):
    assert chat.preference_pairs(chat.neighbours(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).count() == 0


# ---- 6 language model


def test_language_model(docs):
    rows = [(i, t) for i, t, *_ in documents()]
    count = Counter()
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1
    for i, t in rows:
        if not held(i):
            count.update([*words_of(t), None])
    total, distinct = sum(count.values()), len(count)
    want = sorted(
        (str(i), held(i), len(w) + 1, sum(count[x] > 0 for x in [*w, None]), total, round(sum(math.log10((count[x] + 0.5) / (total + 0.5 * (distinct + 1))) for x in [*w, None]), 3))
        for i, t in rows
        for w in [words_of(t)]
    )
    got = language.score(docs).collect()
    assert sorted((str(r[0]), *tuple(r)[1:5], round(r[5], 3)) for r in got) == want


def test_language_model_is_normalised():
    noise = np.arange(1, 41, dtype=float) / 820
    model = language.Bilinear(noise)
    rng = np.random.default_rng(2)
    two, one, target = (rng.integers(0, 40, 5000) for _ in range(3))
    model.train(two, one, (one * 7) % 40, np.ones(5000), rng, {})
    s1, s2, z = model.tables()
    p = 10.0 ** (s1[None, :, :] + s2[:, None, :] - z[:, :, None])
    assert np.allclose(p.sum(2), 1, atol=1e-3)


def test_language_model_beats_counts(spark):
    rows = [(i, " ".join(["red", "green", "blue"] * 200)) for i in range(60)]
    got = language.score(spark.createDataFrame(rows, "doc_id long, text string")).where("held_out").collect()
    assert got and all(r["score"] > r["base_score"] for r in got)


def test_language_model_tells_words_of_a_class_apart(spark):
    """Words beyond the 512 first: red comes before x0001, blue before y0001, of equal class."""
    r = random.Random(6)
    rows = [(i, " ".join(f"red x{r.randrange(600):04d} blue y{r.randrange(600):04d}" for _ in range(1000))) for i in range(300)]
    got = language.score(spark.createDataFrame(rows, "doc_id long, text string").repartition(2)).where("held_out").collect()
    assert sum(x["score"] - x["base_score"] for x in got) / sum(x["n_tokens"] for x in got) > 0.31


def test_factored_model_is_normalised():
    rng = np.random.default_rng(3)
    slots = language.Slots(np.append(rng.integers(1, 2**63, 99, dtype=np.uint64), language._END), np.arange(100) % 5, np.arange(100) >= 90)
    model = language.Factored(slots, rng.random(slots.size) + 0.1)
    two, one, target = (rng.integers(0, slots.size, 5000) for _ in range(3))
    model.train(two, one, target, np.ones(5000), rng, {})
    every = np.arange(slots.size)
    for a, b in ((0, 1), (3, 200), (slots.size - 1, slots.end)):
        assert abs((10 ** model.log10(np.full(slots.size, a), np.full(slots.size, b), every)).sum() - 1) < 1e-3


def test_language_model_empty(empty):
    assert language.score(empty).count() == 0


# ---- 7 personal data


def plain_personal(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        g = re.sub("[^0-9]", "", m[0])
        if 12 <= len(g) <= 19 and sum(int(x) if k % 2 == 0 else sum(divmod(2 * int(x), 10)) for k, x in enumerate(reversed(g))) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


def test_personal_patterns():
    r = random.Random(4)
    pieces = ["a", "b.c", "@", "x@y.z", "1", "23", ".", "192.168.0.1", "-", " ", "+", "+1 (555) 010-9999", "4111 1111 1111 1111", "é", "\n", "000.1.2.3", "%", "999"]
    for _ in range(3000):
        t = "".join(r.choice(pieces) for _ in range(r.randrange(12)))
        assert spans.personal(t) == plain_personal(t), t
    assert spans.personal("a" * 200_000 + "@" + "1" * 200_000) == []  # in linear time


def test_pii(spark, docs):
    near = [f"{prose(i, 30)} Zelmira Quandt zelmira@example.org called {prose(i + 50, 30)}" for i in range(4)]
    rows = [*((i, t) for i, t in enumerate(near)), (10, "Quandt " + prose(3, 50)), (11, None), (12, ""), (13, "1.2.3.4 " + prose(8, 20)), (None, "mail x@y.zz")]
    df = spark.createDataFrame([(i, t, "c") for i, t in rows], "doc_id long, text string, cuts string")
    got = {r["doc_id"]: r for r in pii.find_spans(df).collect()}
    assert got[0]["n_email"] == 1 and "term:" in got[0]["spans"]
    assert got[10]["spans"] == "" and got[13]["spans"] == "ip:0:7" and got[11]["spans"] == ""
    clean = {r["doc_id"]: r for r in pii.sanitise(df.drop("cuts").withColumn("key", df.doc_id)).collect()}
    assert "zelmira@" not in clean[0]["text"] and "[EMAIL]" in clean[0]["text"] and "Quandt" not in clean[0]["text"]
    assert clean[10]["text"] == rows[4][1] and clean[11]["text"] is None and clean[10]["key"] == 10
    assert pii.find_spans(docs).count() == len(documents())


def test_pii_terms_far_from_the_mention(spark):
    far = [f"Quandt {prose(i, 60, 10**9)} zelmira@example.org {prose(i + 50, 60, 10**9)} é Quandt" for i in range(4)]
    rows = [*enumerate(far), *((20 + i, prose(i, 9)) for i in range(20)), (10, "Quandt alone"), (11, "write to zelmira@example.org today"), (12, "write to zelmira@example.org today")]
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in enumerate(far):
        assert clean[i] == t.replace("Quandt", "[TERM]").replace("zelmira@example.org", "[EMAIL]")
    assert clean[10] == "Quandt alone" and clean[11] == "write to [EMAIL] today"


def test_pii_empty(empty):
    assert pii.find_spans(empty).count() == 0 and pii.sanitise(empty).count() == 0


# ---- 8 html


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (None, ""), ("", ""), ("plain text only", "plain text only"),
        ("<body><nav><a href=x>Menu</a></nav><article><h1>T &amp; x</h1><p>Long enough, a paragraph of text&nbsp;here.</p><p><b>Unclosed, bold and more text here.<br></article><footer>F</footer>", "T & x\n\nLong enough, a paragraph of text here.\n\nUnclosed, bold and more text here."),
        ("<div class='sidebar'><p>Sidebar words, many of them, all over the place.</p></div><div id=content><p>Main text, with commas, and words.</p><p>More text, again with words and commas.</p></div><div class='comments'><p>A comment, long enough, to score.</p></div>", "Main text, with commas, and words.\n\nMore text, again with words and commas."),
        ("<article><p>Kept text, which is long enough to count.</p><script>var x='</p><p>no</p>';</script><div class='ad banner'>Buy, now, at once, please.</div><form><p>Your name, please, and more.</p></form></article>", "Kept text, which is long enough to count."),
        ("<p>Cut off inside, a tag that never ends here <a href='", "Cut off inside, a tag that never ends here"),
    ],
)
def test_main_text(page, want):
    assert html.main_text(page) == want


@pytest.mark.parametrize("name", ["content-sidebar-wrap", "has-sidebar", "no-sidebar", "social search"])
def test_main_text_in_a_wrapper_with_a_skipped_name(name):
    text = "The article's text, with commas, and long enough to count."
    aside = "<div class=sidebar><p>Other words, many of them, beside it.</p></div>"
    assert html.main_text(f"<body><div class='{name}'><main><p>{text}</p></main>{aside}</div></body>") == text
    assert html.main_text(f"<body><div class='{name}'><div><p>{text}</p><p>{text}</p></div>{aside}</div></body>") == f"{text}\n\n{text}"


LONG = "One long paragraph, with commas, and words, to score well."


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<div class='content has-sidebar'><h1>T</h1><p>" + LONG + "</p></div>", "T\n\n" + LONG),
        ("<div id='page-header-wrapper'><div><p>" + LONG + "</p></div></div>", LONG),
        ("<article><p>Text <span class='advert'>BUY NOW</span> goes on <span style='display:none'>hid</span>here.</p></article>", "Text goes on here."),
        ("<article><p>A <math><mi>x</mi></math> and <label>label</label> in one <button>press</button> block.</p></article>", "A x and label in one block."),
        ("<div><p>" + LONG + "</p></div><div><p>Short one.</p></div>", LONG + "\n\nShort one."),
        ("<p>a</p><p>b</p><p>c</p>", "a\n\nb\n\nc"), ("<body><div><p>a</p><p>b</p></div></body>", "a\n\nb"),
        ("<body><div><a href=x>Home</a> <a>About us</a></div>one<br>two, in the body</body>", "one two, in the body"),
        ("<body><div><a href=x>Home</a></div><section><p>" + LONG + "</p><ul><li>item</li></ul></section><div class='comment-list'><p>" + LONG + "</p></div></body>", LONG + "\n\nitem"),
    ],
)
def test_score_decides(page, want):
    assert html.main_text(page) == want


def plain_best(page):
    """The best container's text by walking all ancestors of each block of a well-formed page."""
    from html.parser import HTMLParser

    found, path = [], [(0, "")]

    class Reader(HTMLParser):
        def handle_starttag(self, tag, attrs):
            path.append((self.getpos()[1] + 1, tag))

        def handle_endtag(self, tag):
            path.pop()

        def handle_data(self, data):
            found.append((tuple(path), " ".join(data.split())))

    Reader().feed(page)
    score, chars, links, order = Counter(), Counter(), Counter(), []
    for where, text in found:
        block = [x for x in where if x[1] != "a"]
        linked = len(text) if where[-1][1] == "a" else 0
        n = len(text)
        worth = min(1, n / 25) * (1 + text.count(",") + min(n / 100, 3)) * (1 - linked / n)
        for level, x in enumerate(reversed(block[:-1])):
            score[x] += worth / 2**level
        for x in block:
            order += [x] if x not in chars else []
            chars[x] += n
            links[x] += linked

    def total(x):
        strong = x[1] == "article"
        return (score[x] * (3 if strong else 1) + (10 if strong else 0)) * (1 - links[x] / chars[x])

    top = max(sorted(order), key=total)
    if total(top) <= 0:
        return []
    return [t for where, t in found if top in where]


def test_main_text_holds_the_best_container_of_brute_force():
    r = random.Random(8)

    def part(depth):
        if depth == 0 or r.random() < 0.3:
            text = " ".join(r.choice(["word", "more,", "text"]) + str(r.randrange(10**6)) for _ in range(r.randrange(1, 30)))
            return f"<p>{f'<a>{text}</a>' if r.random() < 0.2 else text}</p>"
        tag = r.choice(["div", "section", "div", "article"])
        return f"<{tag}>{''.join(part(depth - 1) for _ in range(r.randrange(1, 4)))}</{tag}>"

    for _ in range(300):
        page = f"<div>{part(4)}{part(4)}</div>"
        got = html.main_text(page).split("\n\n")
        assert [t for t in got if t in plain_best(page)] == plain_best(page)


def test_html_in_linear_time():
    import time

    began = time.process_time()
    html.main_text("<div>" * 4000 + "<p>short one</p>" * 4000)
    html.main_text("<b>" * 4000 + "<div>x</div>" * 4000)
    assert time.process_time() - began < 1
    assert html.main_text("<div>" * 3000 + "<b" * 50_000) == ""
    assert html.main_text("<!--" * 50_000 + "<p>x") == ""


def test_extract(spark):
    df = spark.createDataFrame([(1, "u", "<p>é and some text, long enough to count.</p>", 5), (None, None, None, 6)], "page_id long, url string, html string, text long")
    got = {r["page_id"]: r for r in html.extract(df).collect()}
    assert got[1]["n_chars"] == len(got[1]["text"]) and got[None]["text"] == ""
    assert html.extract(df.limit(0)).count() == 0


# ---- 9 mixing


def test_mixing(docs, spark):
    got = mixing.calibrated(docs).collect()
    assert len(got) == len(documents()) and all(0 <= r["probability"] <= 1 for r in got)
    chosen = mixing.sample(docs)
    assert chosen.columns == [*docs.columns, "probability"]
    assert sorted(str(r["doc_id"]) for r in chosen.collect()) == sorted(str(r["doc_id"]) for r in got if r["selected"])


def test_sample_by_a_given_topic(spark):
    subject = functions.col("subject")
    rows = [(i, f"w{i} two three", "s", "en", f"t{i % 2}") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, subject string")
    want = {r["doc_id"] for r in mixing.calibrated(df, topic=subject).where("selected").collect()}
    assert want and {r["doc_id"] for r in mixing.sample(df, topic=subject).collect()} == want


def test_raking_meets_the_targets(spark):
    cells = spark.createDataFrame([(s, g, t, 10 + 7 * i + 3 * j * k) for i, s in enumerate("abc") for j, g in enumerate("xy") for k, t in enumerate("12")], "source string, lang string, topic string, tokens long")
    targets = {
        "source": spark.createDataFrame([("a", 0.5), ("b", 0.3), ("c", 0.2)], "source string, share double"),
        "lang": spark.createDataFrame([("x", 0.6), ("y", 0.4)], "lang string, share double"),
        "topic": spark.createDataFrame([("1", 0.5), ("2", 0.5)], "topic string, share double"),
    }
    rows = mixing.rake(cells, targets, 12).collect()
    total = sum(r["tokens"] for r in rows)
    for d, want in targets.items():
        for r in want.collect():
            assert abs(sum(x["weight"] for x in rows if x[d] == r[0]) / total - r[1]) < 1e-6
    for r in mixing.residuals(spark.createDataFrame(rows), targets).collect():
        assert abs(r["share"] - r["reached"]) < 1e-6


def test_mixing_empty(empty):
    assert mixing.calibrated(empty).count() == 0 and mixing.sample(empty).count() == 0


# ---- 10 secrets


def plain_credentials(t):
    out = [(m.start(), 0, m.end(), m[2]) for m in re.finditer(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end(), m[0]) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    return sorted(out + [(m.start(), 2, m.end(), m[0]) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32])


def test_credential_patterns():
    r = random.Random(6)
    pieces = ["Password", "toKen", "api_key", "APIKEY", "ſecret", "secret", "=", ":", " ", '"', "abcdef1234", "x", "AKIA", "ABCDEFGHIJKL9", "0123456789abcdef", "é", "\n"]
    for _ in range(3000):
        t = "".join(r.choice(pieces) for _ in range(r.randrange(10)))
        assert spans.credentials(t) == plain_credentials(t), t


def test_secret_scan(spark, docs):
    live, copied = "Zk3v9QpLx82mNbT7wR4y", "Ab1Cd2Ef3Gh4Ij5Kl6Mn"
    rows = [(1, f"é {live} end", "s1"), (2, f"see {copied}", "s1"), (3, f"see {copied}", "s2"), (4, f"see {copied} token = {'a' * 9}", "s3"), (5, None, None), (6, "password=" + "x" * 8, None), (6, "AKIA" + "B" * 12, None), (7, "akia nothing", "s")]
    got = secrets.scan(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == 8 and by[1]["spans"] == "live:2:22" and by[2]["spans"] == "" and by[2]["n_example"] == 1
    assert by[4]["n_assign"] == 1 and by[4]["spans"].startswith("assign:") and by[5]["spans"] == ""
    for r in secrets.scan(docs).collect():
        assert r["base_sha256"] == hashlib.sha256(b"").hexdigest() or r["spans"]


def test_secret_scan_empty(empty):
    assert secrets.scan(empty).count() == 0


# ---- awkward column names, work tables


def test_clashing_names(spark):
    rows = [(i, prose(i, 30) + " mail me@example.org", f"s{i % 3}", "en", *range(9)) for i in range(60)]
    names = ["p", "_topic", "_source", "_kept", "mix_source", "mix_p", "pii_key", "pii_cuts", "n"]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, " + ", ".join(f"{n} int" for n in names))
    chosen = mixing.sample(df)
    want = {r["doc_id"] for r in mixing.calibrated(df).where("selected").collect()}
    assert chosen.columns == [*df.columns, "probability"] and {r["doc_id"] for r in chosen.collect()} == want
    again = mixing.sample(chosen)
    assert again.columns == chosen.columns
    masked = pii.sanitise(df)
    assert masked.columns == df.columns and all("[EMAIL]" in r["text"] and r["pii_key"] == 6 for r in masked.collect())
    assert len({r["component_id"] for r in minhash.near_duplicates(df).collect()}) == 60


def test_sample_with_many_cells(spark, monkeypatch):
    df = spark.createDataFrame([(i, f"w{i} x", f"s{i % 7}", "en") for i in range(300)], "doc_id long, text string, source string, lang string")
    want = sorted(map(tuple, mixing.sample(df).collect()))
    monkeypatch.setattr(mixing, "MOST_CELLS", 3)
    assert want and sorted(map(tuple, mixing.sample(df).collect())) == want


def test_bitmap(spark, monkeypatch):
    df = spark.createDataFrame([(i * 7919**4 % 2**63,) for i in range(5000)], "k long")
    keys = np.array([r[0] for r in df.collect()])
    for most in (1 << 20, 1 << 29):
        monkeypatch.setattr(common, "MOST_BITS", most)
        bits = common.bitmap(df, "k")
        assert common.in_bitmap(bits, keys).all() and common.in_bitmap(bits, keys ^ 12345).mean() < 0.1
    assert sorted(common.to_driver(df)[0].tolist()) == sorted(keys.tolist())


def test_long_lists_are_split_at_any_size(spark, monkeypatch):
    """Few frequent values are known to the executors; longer lists are split all the same."""
    monkeypatch.setattr(minhash, "BLOCK", 8)
    posted = spark.createDataFrame([(k, 0, n) for k, size in ((1, 5), (2, 300), (3, 9)) for n in range(size)], "key long, rank long, node long")
    got = minhash.lists(posted, spark.createDataFrame([(2, 300), (3, 9)], "key long, n long")).collect()
    met, size = set(), Counter()
    groups = {}
    for r in got:
        groups.setdefault(r["grp"], []).append(r)
    for g in groups.values():
        size[len(g)] += 1
        met |= {(a["node"], b["node"]) for a in g for b in g if a["node"] < b["node"] and (a["side"] == 0 or a["side"] != b["side"])}
    assert {(a, b) for a in range(300) for b in range(a + 1, 300)} <= met and max(size) < 50


def test_near_duplicates_when_few_values_are_known_as_frequent(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 8)
    monkeypatch.setattr(minhash, "RARE", 4)
    monkeypatch.setattr(minhash, "MAX_FREQUENT", 600)
    base, rows = prose(9, 150).split(), []
    for i in range(120):
        r, w = random.Random(i), list(base)
        for _ in range(i % 12):
            w[r.randrange(len(w))] = f"z{r.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=3, percent=85).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_components(rows, 3, 85)


@pytest.mark.parametrize("bits", [6, 64])
def test_remove_repeated_under_colliding_hashes(docs, monkeypatch, bits):
    """With a first hash of 6 bits nearly all windows collide; the second tells them apart."""
    monkeypatch.setattr(substrings, "HASH_BITS", bits)
    monkeypatch.setattr(substrings, "BUCKET_BYTES", 10_000)
    got = substrings.remove_repeated(docs, window=35, digest=True).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_removed([(r[0], r[1]) for r in documents()], 35)


def test_very_long_words():
    import pyarrow as pa

    long = "x" * 3_000_000
    texts = [f"a {long} b", long, "a" + long, long[:-1] + "y", "tail " + long + "é end"]
    seen = {}
    for _, _, buf, offs in tokens.chunks(pa.array(texts)):
        doc, s, e, h = tokens.words(buf, offs)
        for a, b, v in zip(s, e, h, strict=True):
            assert seen.setdefault(bytes(buf[a:b]), int(v)) == int(v)
        assert np.diff(doc).min(initial=0) >= 0
    assert set(seen) == {w.encode() for t in texts for w in t.split()} and len(set(seen.values())) == len(seen)


def test_language_model_does_not_depend_on_the_split(spark, monkeypatch):
    for k, v in (("SHARD_TOKENS", 4000), ("START_TOKENS", 2500), ("GATHER", 1500), ("TOGETHER", 2), ("ROWS", 64)):
        monkeypatch.setattr(language, k, v)
    df = spark.createDataFrame([(i, prose(i % 50, 60 + i % 40, 900)) for i in range(300)], "doc_id long, text string")
    one, other = ({r["doc_id"]: r for r in language.score(df.repartition(n)).collect()} for n in (2, 7))
    assert all(abs(one[i]["score"] - other[i]["score"]) < 1e-3 and abs(one[i]["base_score"] - other[i]["base_score"]) < 1e-6 for i in one)


def test_tokens_are_gathered_whole():
    import pyarrow as pa

    slots = language.Slots(np.append(np.arange(1, 30, dtype=np.uint64), language._END), np.zeros(30, int), np.arange(30) > 20)
    texts = [np.append(np.random.default_rng(i).integers(0, 29, i % 7), slots.end).astype(np.int32) for i in range(40)]
    batch = pa.RecordBatch.from_arrays([pa.array([0] * 40), pa.array(range(40)), pa.array([t.tobytes() for t in texts], pa.binary())], ["shard", "order", "slots"])
    n, want = slots.size, []
    for t in texts:
        x = [slots.end, slots.end, *t.tolist()]
        want += [(x[k] * n + x[k + 1]) * n + x[k + 2] for k in range(len(t))]
    for most in (None, 50):
        assert np.concatenate(list(language._gathered([batch.slice(0, 13), batch.slice(13)], slots, most))).tolist() == want[:most]


@pytest.mark.parametrize("loose", [0, 3, 40])
def test_near_duplicates_of_a_family_around_a_text(spark, monkeypatch, loose):
    """A family that spans many blocks and is linked through its pivots, a chain that hangs on
    it by one member only, and sets that share its rare values without being alike."""
    monkeypatch.setattr(minhash, "BLOCK", 8)
    monkeypatch.setattr(minhash, "RARE", 4)
    base, rows = prose(9, 150).split(), []
    for i in range(90):
        w = list(base)
        w[random.Random(i).randrange(len(w))] = f"z{i}"
        rows.append((i, " ".join(w)))
    w = list(base)
    for i in range(12):
        w = [*w[4:], f"q{i}", f"r{i}", f"s{i}", f"t{i}"]
        rows.append((200 + i, " ".join(w)))
    rows += [(300 + i, " ".join(base[i : i + 100] + prose(i, 60, 10**6).split())) for i in range(loose)]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=3, percent=85).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_components(rows, 3, 85)
