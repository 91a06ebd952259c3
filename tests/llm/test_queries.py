"""The registered queries against their SQL, and the pipeline against a plain run of its stages."""

import pytest
from compare import differences, duck

import __spark_entry__ as entry
import corpus_pipeline
from tablepull.llm.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_sql(spark, name):
    assert differences(QUERIES[name](spark, SF_DIR), duck(SF_DIR), ORACLE[name]) == []


def test_pipeline(spark):
    """Each stage keeps the columns and drops only what it should; the last one packs what is left."""
    from llm.test_decontaminate import brute as contaminated
    from llm.test_lines import brute as deduped
    from llm.test_minhash import brute as near

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    frame = docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, frame, SF_DIR)
        if name == "packing":
            break
        assert out.columns == docs.columns
        out = spark.createDataFrame(out.collect(), out.schema)
        got, before = {r["doc_id"]: r["text"] for r in out.collect()}, dict(texts)
        if name == "quality_classifier":
            wrong = [i for i in before if labels.get(i) is not None and (i in got) != bool(labels[i])]
            assert len(wrong) <= 0.05 * len(labels) and all(got[i] == before[i] for i in got)
        elif name == "line_dedup":
            assert got == deduped(list(before.items()))
            assert all(r["n_chars"] == len(r["text"]) for r in out.collect())
        elif name == "minhash_dedup":
            assert set(got) == {i for i, (_, _, kept) in near(list(before.items())).items() if kept}
        else:
            assert set(got) == set(before) - {d for d, _ in contaminated(list(before.items()), items)}
        texts, frame = got, out
    rows = out.collect()
    packed = {}
    for r in rows:
        packed[r["doc_id"]] = packed.get(r["doc_id"], 0) + r["n_tokens"]
    assert packed == {i: len((t or "").encode().split()) for i, t in texts.items()}
    assert corpus_pipeline.ORACLE_SQL is None
