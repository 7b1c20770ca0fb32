"""The pipeline against a brute-force version of its decisions."""

import random

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from pitlake.llm import secrets, toxicity
from test_llm_operators import brute_components, check_packing, loose_words, odd


@pytest.fixture(scope="module")
def folder(spark, sf, tmp_path_factory):
    return sf


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    items = [(r["item_id"], loose_words(r["text"])) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    toxic = {r["doc_id"] for r in toxicity.score(docs, labels).where("predicted = 1").collect()}
    left = {i: t for i, t in texts.items() if i not in toxic}
    left = {i: left[i] for i, (_, _, kept) in brute_components(list(left.items()), 5).items() if kept}

    def shingles(w, n):
        return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}

    wanted = [(min(5, len(w)), shingles(w, min(5, len(w)))) for _, w in items if w]
    left = {i: t for i, t in left.items() if not any(100 * len(s & shingles(loose_words(t), n)) >= 80 * len(s) for n, s in wanted)}
    forest = secrets.train(secrets.labelled_findings())
    for i, t in left.items():
        for a, b, rule, _ in reversed(secrets.scan_texts([t], forest)[0]):
            left[i] = f"{left[i][:a]}<{rule}>{left[i][b:]}"
    pieces = corpus_pipeline.run(spark, folder).collect()
    check_packing(pieces, list(left.items()))


@pytest.mark.parametrize("k", range(4))
def test_stage_keeps_columns_and_odd_rows(spark, folder, k):
    df = odd(spark)
    out = corpus_pipeline.STAGES[k][1](spark, df, folder)
    assert out.columns == df.columns and dict(out.dtypes) == dict(df.dtypes)
    assert out.where("doc_id is null").count() == 2
    assert corpus_pipeline.STAGES[k][1](spark, df.limit(0), folder).count() == 0


def test_clean_documents_stay(spark, folder):
    r = random.Random(1)
    rows = [(10**6 + i, " ".join("".join(r.choice("bcdfg") + r.choice("aeiou") for _ in range(r.randint(1, 4))) for _ in range(120))) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.char_length("text").cast("long")})
    docs = spark.read.parquet(f"{folder}/documents.parquet").unionByName(df)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
    out = {x["doc_id"]: x["text"] for x in docs.where("doc_id >= 1000000").collect()}
    assert len(out) >= 29 and all(out[i] == t for i, t in rows if i in out)
