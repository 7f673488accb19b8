import pytest

import corpus_pipeline
from silvagrid.llm import packing
from tests.conftest import SF_DIR
from tests.llm.conftest import texts_of


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{SF_DIR}/documents.parquet"), []
    for name, fn in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("steps") / name)
        fn(spark, docs, SF_DIR).write.parquet(path)
        out.append((docs, docs := spark.read.parquet(path)))
    return out


def test_stages_keep_the_columns(steps):
    for before, after in steps[:-1]:
        assert dict(after.dtypes) == dict(before.dtypes) and 0 < after.count() <= before.count()


def test_quality_keeps_good_documents(spark, steps):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    kept = set(texts_of(steps[0][1]))
    good, bad = ([k for k, q in labels.items() if q == v] for v in (1, 0))
    assert sum(k in kept for k in good) >= 0.95 * len(good) and sum(k in kept for k in bad) <= 0.3 * len(bad)


def test_lines_and_copies(steps):
    before, after = (texts_of(x) for x in steps[1])
    words = {k: len((t or "").split()) for k, t in before.items()}
    gone = set(before) - set(after)
    assert gone and all(words[k] for k in gone)
    # every document that went is made of lines that an earlier one has
    for k in gone:
        lines = {x for i, t in before.items() if i < k for x in (t or "").split("\n")}
        seen = sum(len(x.split()) for x in before[k].split("\n") if x in lines)
        assert seen >= 0.8 * words[k]
    assert all(5 * len((t or "").split()) > words[k] or not words[k] for k, t in after.items())
    left = [t for t in texts_of(steps[2][1]).values() if t]
    assert len(left) == len(set(left))


def test_near_copies_of_eighty_percent_go(spark):
    words = [f"w{i}" for i in range(120)]
    near = [w if i not in (20, 80) else "other" for i, w in enumerate(words)]  # 106 of 126 shingles: 0.84
    far = [w if i % 20 != 9 else "other" for i, w in enumerate(words)]
    rows = [(1, " ".join(words)), (2, " ".join(near)), (3, " ".join(far)), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert set(texts_of(corpus_pipeline.one_of_each_group(spark, docs, SF_DIR))) == {1, 3, 4}


def test_no_emptied_text_is_packed(steps):
    assert all(t for t in texts_of(steps[4][0]).values())


def test_all_is_packed(steps):
    docs, out = steps[4]
    assert {r["doc_id"] for r in out.collect()} == set(texts_of(docs))
    assert all(r["offset"] + r["length"] <= packing.CAPACITY for r in out.collect())


def test_run_is_the_stages_in_order(spark, steps):
    def rows(df):
        return sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in df.collect())

    assert rows(corpus_pipeline.run(spark, SF_DIR)) == rows(steps[4][1])
    assert corpus_pipeline.ORACLE_SQL is None


def test_odd_rows(spark, odd, none, tmp_path):
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    ids = [r["doc_id"] for r in odd.collect()]
    for name, fn in corpus_pipeline.STAGES[1:4]:
        out = fn(spark, odd, str(tmp_path))
        assert out.columns == odd.columns
        left = [r["doc_id"] for r in out.collect()]
        # the row without an id comes first and has the lines of 1 and 2, and 7 of 9 of 10; it is no near copy, as it has no id
        gone = {"line_dedup": {1, 2}, "near_dedup": {2, 10}, "decontamination": set()}[name]
        assert sorted(left, key=str) == sorted((k for k in ids if k not in gone), key=str), name
        assert len(texts_of(out)[6]) > 1_000_000
    packed = corpus_pipeline.packed(spark, odd, str(tmp_path)).groupBy("doc_id").count().collect()
    assert {r["doc_id"] for r in packed} == set(ids)
    for _, fn in corpus_pipeline.STAGES:
        assert fn(spark, none, str(tmp_path)).count() == 0
