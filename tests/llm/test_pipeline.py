import hashlib

from tokenizers import Tokenizer

import corpus_pipeline
from riskpanel.llm import bpe, pii
from tests.llm.tables import empty_documents, odd_documents, odd_rows, prose
from tests.llm.test_decontaminate import ITEMS
from tests.llm.test_jaccard import plain as plain_groups
from tests.llm.test_quality import plain_figures

LEAK = prose(77, 30)


def pipeline_rows():
    rows = odd_rows()
    rows += [(40, prose(40) + ". " + LEAK, "en", "x", 0), (41, prose(41) + " a@b.example.com", "en", "x", 0),
             (42, prose(42), "fr", "y", 0), (43, prose(42), "fr", "y", 0)]
    return rows


def test_stages_are_as_listed():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "jaccard_join", "decontamination", "personal_data", "bpe"]


def test_run_equals_plain_stages(spark, folder):
    odd_documents(spark, pipeline_rows()).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, LEAK), (2, None)], ITEMS).write.parquet(f"{folder}/benchmark.parquet")
    rows = [r[:2] for r in pipeline_rows()]
    kept = [r for r in rows if not plain_figures(r[1])[-1]]
    one = {}
    groups = plain_groups(kept)
    for d, t in kept:
        if any(g[0] == d and g[2] == d for g in groups):
            one.setdefault((d, t), (d, t))
    clean = [(d, t) for d, t in one.values() if LEAK not in t]
    tokenizer = Tokenizer.from_file(bpe.default_path())
    want = []
    for d, t in clean:
        ids = tokenizer.encode(pii.masked(t, None), add_special_tokens=False).ids
        want.append((d, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()))
    got = corpus_pipeline.run(spark, folder).collect()
    assert sorted(((r["doc_id"], r["n_tokens"], r["ids_sha256"]) for r in got), key=repr) == sorted(
        want, key=repr)


def test_stages_keep_the_columns_and_stand_empty_tables(spark, folder):
    spark.createDataFrame([(1, LEAK)], ITEMS).write.parquet(f"{folder}/benchmark.parquet")
    docs = empty_documents(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns and out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() == 0
