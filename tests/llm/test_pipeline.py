"""The pipeline's stages, each against a plain version over its own input."""

import os
import re

import pytest

import corpus_pipeline
from capledger.llm import mixing, quality
from capledger.llm.common import shared_table

ROOT = "/root/testdata/sf0.001"


def shingles(text):
    words = text.encode().lower().split()
    return frozenset(zip(*[words[k:] for k in range(5)], strict=False)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


@pytest.mark.skipif(not os.path.isdir(ROOT), reason="benchmark tables not present")
def test_stages(spark):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    columns, seen = docs.columns, [docs]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        seen.append(shared_table(stage(spark, seen[-1], ROOT), f"test-{number}"))
    rows = [{r["doc_id"]: r for r in df.collect()} for df in seen]
    assert all(df.columns == columns for df in seen[:-1])

    model = quality.fit(docs, spark.read.parquet(f"{ROOT}/labels.parquet"))
    compressors = quality.Compressors(model.good, model.bad, model.settings)
    good = {i for i, r in rows[0].items() if model.slope * compressors.value((r["text"] or "").encode()) + model.offset >= 0}
    assert set(rows[1]) == good

    sets = {i: shingles(r["text"] or "") for i, r in rows[1].items()}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in sets.items():
        for j, b in sets.items():
            if j < i and a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    assert set(rows[2]) == {i for i in sets if root(i) == i}

    assert set(rows[3]) == set(rows[2])
    for i, r in rows[3].items():
        assert not re.search(r"[0-9a-f]{24}|AKIA[A-Z0-9]{16}", r["text"] or "")
        assert r["n_chars"] == len(r["text"])
        if "[" not in r["text"]:
            assert r["text"] == rows[2][i]["text"]

    words = {i: len(re.findall(r"\S+", r["text"] or "", re.A)) for i, r in rows[3].items()}
    assert set(rows[4]) <= set(rows[3]) and sum(words[i] for i in rows[4]) <= 0.9 * sum(words.values()) + 1
    marked = mixing._with_leaf(seen[3], corpus_pipeline.MIXTURE, "doc_id", "lang", "source")
    leaf = {r["doc_id"]: (r["domain"], r["lang"], r["source"]) for r in marked.collect()}
    totals = spark.createDataFrame([(*leaf[i], n) for i, n in words.items()], "domain string, lang string, source string, n long")
    budgets = mixing.budgets(totals.groupBy(*mixing.LEAF).agg({"n": "sum"}).withColumnRenamed("sum(n)", "available"), corpus_pipeline.MIXTURE)
    for b in budgets.collect():
        own = (b["domain"], b["lang"], b["source"])
        assert sum(words[i] for i in rows[4] if leaf[i] == own) <= b["budget"]

    assert set(rows[5]) == set(rows[4])
    assert all(r["n_tokens"] == len(r["ids"]) for r in rows[5].values())
