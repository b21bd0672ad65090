"""Every query with SQL against DuckDB on the smallest tables."""

import datetime
import difflib
import re

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("set timezone = 'UTC'")
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def plain(v):
    return v.replace(tzinfo=None).isoformat() if isinstance(v, datetime.datetime) else repr(v)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    run = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in run.description]
    assert sorted(names) == cols
    assert got == sorted(tuple(plain(r[names.index(c)]) for c in cols) for r in run.fetchall())


def test_flagship_is_not_vacuous(spark):
    rows = entry.queries()["link_coverage_by_host"](spark, "/root/testdata/sf0.01").collect()
    assert {r["coverage"] for r in rows} == {"all_live", "none_live", "partial", "unknown"}


def rows_of(duck, sql):
    return duck.execute(sql).fetchall()


def test_similarity_ratio(spark, duck):
    texts = dict(rows_of(duck, "select item_id, text from benchmark"))
    got = {r["id_a"]: r["score"] for r in entry.queries()["similarity_ratio"](spark, SF).collect()}
    assert got == {i: difflib.SequenceMatcher(None, t, texts[i + 1]).ratio() for i, t in texts.items() if i + 1 in texts}


def test_redline_tokens(spark, duck):
    said = {(c, t): x for c, t, x in rows_of(duck, "select conv_id, turn, text from conversations")}
    got = {(r["conv_id"], r["turn"]): [tuple(x) for x in r["runs"]] for r in entry.queries()["redline_tokens"](spark, SF).collect()}
    assert set(got) == {k for k in said if (k[0], k[1] + 2) in said}
    for (c, t), runs in got.items():
        old, new = said[c, t] or "", said[c, t + 2] or ""
        assert "".join(x for op, x in runs if op != "add") == "".join(re.findall(r"\S+\s*", old)) and "".join(x for op, x in runs if op != "del") == "".join(re.findall(r"\S+\s*", new))
        a, b = (re.findall(r"\S+\s*", x) for x in (old, new))
        want = []
        for op, i, j, k, m in difflib.SequenceMatcher(None, a, b).get_opcodes():
            want += [("keep", "".join(a[i:j]))] if op == "equal" else [(o, "".join(x)) for o, x in (("del", a[i:j]), ("add", b[k:m])) if x]
        assert runs == want


def test_near_name_clusters(spark):
    """All couples of names, block by block, with the rule written out."""
    from spindrel.operators.joins import DISTINGUISHERS
    from spindrel.plans import relational

    items = [(r["seq"], r["id"], r["key"], r["base_key"]) for r in relational._names(spark, SF).select("seq", "id", "key", "base_key").collect()]
    blocks = {}
    for x in items:
        blocks.setdefault(tuple(sorted({w for w in x[2].split() if re.search("[0-9]", w)})), []).append(x)
    want = set()
    for spec, own in blocks.items():
        if not 2 <= len(own) <= 200:
            continue
        for x in own:
            for y in own:
                if x[0] < y[0] and x[3] != y[3]:
                    a, b = (set(z[2].split()) - set(spec) for z in (x, y))
                    if not (a ^ b) & set(DISTINGUISHERS):
                        score = max(len(a & b) / len(a | b) if a | b else 1.0, difflib.SequenceMatcher(None, x[2], y[2]).ratio())
                        if score >= 0.72:
                            want.add((x[1], y[1], round(score, 9)))
    got = {(r["id_a"], r["id_b"], round(r["score"], 9)) for r in entry.queries()["near_name_clusters"](spark, SF).collect()}
    assert got == want and want


def test_entry(spark):
    assert entry.entry(spark).count() > 0
