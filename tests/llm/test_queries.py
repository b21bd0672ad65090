"""The query of each operator over the smallest tables against brute force."""

import hashlib
import math
import zlib
from collections import Counter

import pytest

from spindrel.llm import html, minhash, queries, quality, secrets, spans

from .test_operators import brute_components, brute_counts, brute_removed, plain_credentials, plain_personal, words_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def told(found, kinds):
    return hashlib.sha256(",".join(f"{kinds[s[1]]}:{s[0]}:{s[2]}" for s in found).encode()).hexdigest()


def test_op1(spark, rows):
    got = queries.op1_near_duplicates(spark, SF).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_components(rows, 3, 85)


def test_op2(spark, rows):
    got = queries.op2_quality(spark, SF).collect()
    assert sorted(tuple(r[c] for c in ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) for r in got) == sorted((i, *brute_counts(t)) for i, t in rows)
    assert not any(r["kept"] and r["base_failed"] for r in got)


def test_op3(spark, rows):
    got = queries.op3_substring_dedup(spark, SF).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_removed(rows, 35)


def test_op6(spark, rows):
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows}
    count = Counter()
    for i, t in rows:
        if not held[i]:
            count.update([*words_of(t), None])
    total, distinct = sum(count.values()), len(count)
    got = {r["doc_id"]: r for r in queries.op6_language_model(spark, SF).collect()}
    for i, t in rows:
        w = [*words_of(t), None]
        base = sum(math.log10((count[x] + 0.5) / (total + 0.5 * (distinct + 1))) for x in w)
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[i], len(w), sum(count[x] > 0 for x in w), total) and abs(r["base_score"] - base) < 1e-6 * len(w)
    assert sum(r["score"] for r in got.values() if r["held_out"]) > sum(r["base_score"] for r in got.values() if r["held_out"])


def test_op7(spark, rows):
    got = {r["doc_id"]: r for r in queries.op7_sanitise(spark, SF).collect()}
    for i, t in rows:
        base = plain_personal(t or "")
        r = got[i]
        assert [r[f"n_{k}"] for k in spans.PII_KINDS[:4]] == [sum(b[1] == k for b in base) for k in range(4)] and r["base_sha256"] == told(base, spans.PII_KINDS)
        assert {f"{spans.PII_KINDS[b[1]]}:{b[0]}:{b[2]}" for b in base} <= set(r["spans"].split(","))


def test_op8(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = queries.op8_main_text(spark, SF).collect()
    assert len(got) == len(pages) and all(r["text"] == html.main_text(pages[r["page_id"]]["html"]) and r["n_chars"] == len(r["text"]) and r["url"] == pages[r["page_id"]]["url"] for r in got)


def test_op10(spark, rows):
    got = {r["doc_id"]: r for r in queries.op10_secret_scan(spark, SF).collect()}
    for i, t in rows:
        base = plain_credentials(t or "")
        r = got[i]
        assert [r[f"n_{k}"] for k in spans.SECRET_KINDS[:3]] == [sum(b[1] == k for b in base) for k in range(3)] and r["base_sha256"] == told(base, spans.SECRET_KINDS)


def test_recall_of_near_duplicates(spark):
    """Every id divisible by 50 against all rows of sf0.01, by exact sets: no link is lost."""
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), words=3, percent=85).collect()}
    sets = {i: frozenset(tuple(w[j : j + 3]) for j in range(max(1, len(w) - 2))) for i, t in docs for w in [words_of(t)] if w}
    links = [(a, b) for a in sets if a % 50 == 0 for b in sets if a != b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    assert len(links) > 3 and all(got[a] == got[b] for a, b in links)



# ---- the spans that the methods add


def near_words(text, found, s, e, reach, least):
    import re

    def words(part, at):
        return [m[0].lower() for m in re.finditer(r"[^\x20\x09-\x0D]+", part) if m.end() - m.start() >= least and not any(at + m.start() < y and x < at + m.end() for x, _, y in found)]

    return " ".join(words(text[:s], 0)[-reach:] + words(text[e:], e)[:reach]) or text


def brute_sanitised(rows, reach=8, least=4, support=2, disclosure=0.5):
    import re

    docs = []
    for text in rows:
        found = plain_personal(text)
        first = {}
        for s, k, e in found:
            first.setdefault(f"{k}:{text[s:e].lower()}", near_words(text, found, s, e, reach, least))
        words = [(m.start(), m.end(), m[0].lower()) for m in re.finditer(r"[^\x20\x09-\x0D]+", text) if m.end() - m.start() >= least and not any(m.start() < y and x < m.end() for x, _, y in found)]
        docs.append((text, found, first, words, {w.lower() for w in re.findall(r"[^\x20\x09-\x0D]+", text)}))
    mentions, contexts = Counter(), {}
    for _, _, first, _, _ in docs:
        for x, c in first.items():
            mentions[x] += 1
            contexts.setdefault(x, set()).add(c)
    risky = set()
    for x in mentions:
        if len(contexts[x]) < support:
            continue
        for term in {w[2] for d in docs if x in d[2] for w in d[3]}:
            having = [d for d in docs if x in d[2] and any(w[2] == term for w in d[3])]
            share = len(having) / max(len(having), sum(term in d[4] for d in docs))
            if len({d[2][x] for d in having}) >= support and share >= disclosure and math.log2(share * len(docs) / mentions[x]) > 0:
                risky.add((x, term))
    out = []
    for _, found, first, words, _ in docs:
        spans_ = sorted(set(found) | {(s, 4, e) for s, e, w in words if any((x, w) in risky for x in first)})
        out.append(",".join(f"{spans.PII_KINDS[k]}:{s}:{e}" for s, k, e in spans_))
    return out


def test_terms_against_brute_force(spark):
    import random

    from spindrel.llm import pii

    r = random.Random(12)
    people = [(f"Name{i} Sur{i}", f"user{i}@mail.example.org" if i % 2 else f"10.0.{i}.7") for i in range(6)]
    texts = []
    for i in range(120):
        w = [f"word{r.randrange(60)}" for _ in range(r.randrange(5, 40))]
        for _ in range(r.randrange(3)):
            name, value = r.choice(people)
            w.insert(r.randrange(len(w)), r.choice([f"{name} {value}", value, name, f"{name.upper()} {value} é {name}"]))
        texts.append(" ".join(w))
    texts += texts[:5]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x["doc_id"]: x["spans"] for x in pii.find_spans(df).collect()}
    want = brute_sanitised(texts)
    assert [got[i] for i in range(len(texts))] == want and sum("term" in x for x in want) > 10


def test_live_tokens_against_brute_force(spark):
    import random

    r = random.Random(13)
    token = lambda: "".join(r.choice("ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz23456789") for _ in range(r.choice([19, 20, 26, 40])))
    pool = [token() for _ in range(30)] + ["a" * 20 + "123", "0123456789abcdef" * 2, "only" * 8]
    rows = []
    for i in range(150):
        w = [f"word{r.randrange(50)}" for _ in range(6)]
        for _ in range(r.randrange(3)):
            v = pool[min(int(r.expovariate(0.12)), len(pool) - 1)]
            w.insert(r.randrange(len(w)), r.choice([v, f"token={v}", f"é {v},"]))
        rows.append((i, " ".join(w), f"s{r.randrange(5)}", r.choice("xy")))
    owners, repos, found = {}, {}, {}
    for i, t, s, g in rows:
        base = plain_credentials(t)
        more = [x for x in secrets.random_tokens(t, 3.3) if not any(x[0] < b[2] and b[0] < x[2] for b in base)]
        found[i] = base, more
        for *_, v in [*base, *more]:
            owners.setdefault(v, set()).add(s)
            repos.setdefault(v, set()).add((s, g))
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").withColumn("repo", __import__("pyspark.sql.functions", fromlist=["x"]).concat_ws("/", "source", "lang"))
    got = {x["doc_id"]: x for x in secrets.scan(df, owner="source", repo="repo").collect()}
    live = lambda v: len(owners[v]) <= 2 and len(repos[v]) <= 4
    for i, (base, more) in found.items():
        want = sorted([b[:3] for b in base] + [x[:3] for x in more if live(x[3])])
        assert got[i]["spans"] == ",".join(f"{spans.SECRET_KINDS[k]}:{s}:{e}" for s, k, e in want)
        assert got[i]["n_live"] == sum(live(x[3]) for x in [*base, *more])
    assert any(live(x[3]) for _, m in found.values() for x in m) and any(not live(x[3]) for _, m in found.values() for x in m)
