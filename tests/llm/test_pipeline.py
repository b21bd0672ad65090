import corpus_pipeline
import pytest

from spindrel.llm import decontaminate, minhash, quality, spans

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    from spindrel.llm.common import stage, table

    docs, out = table(spark, SF, "documents"), []
    for _, f in corpus_pipeline.STAGES:
        out.append((docs, stage(f(spark, docs, SF))))
        docs = out[-1][1]
    return out


def ids(df):
    return sorted(r[0] for r in df.select("doc_id").collect())


def test_columns(steps):
    for before, after in steps[:-1]:
        assert after.dtypes == before.dtypes


def test_decisions_take_effect(spark, steps):
    labels, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("labels", "benchmark"))
    before, after = steps[0]
    assert ids(after) == ids(quality.judge(before, labels).where("kept"))
    before, after = steps[1]
    assert ids(after) == ids(minhash.near_duplicates(before, words=5, percent=80).where("kept"))
    before, after = steps[2]
    leaked = {r[0] for r in decontaminate.find_leaks(before, bench).select("doc_id").collect()}
    assert ids(after) == [i for i in ids(before) if i not in leaked]
    before, after = steps[3]
    assert ids(after) == ids(before)
    rows = after.collect()
    assert not any(spans.personal(r["text"]) for r in rows) and all(r["n_chars"] == len(r["text"]) for r in rows)
    before, after = steps[4]
    assert set(ids(after)) <= set(ids(before)) and after.count()


def test_run_is_the_stages(spark, steps):
    assert ids(corpus_pipeline.run(spark, SF)) == ids(steps[-1][1])


def test_stages_on_an_empty_table(spark, steps):
    docs = steps[0][0].limit(0)
    for _, f in corpus_pipeline.STAGES:
        assert f(spark, docs, SF).count() == 0
