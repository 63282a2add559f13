"""The pipeline against its stages by brute force, and on odd tables."""

import hashlib
import re

import corpus_pipeline
from conftest import SF_SMALL
from nivalis.llm import decontaminate, toxicity
from nivalis.llm.common import read
from test_op1_op7 import brute as brute_hits
from test_op4_op8 import WHOLE
from test_op6 import brute as brute_near


def test_run_against_brute_force(spark, duck):
    docs = read(spark, SF_SMALL, "documents")
    toxic = {r.doc_id for r in toxicity.report(docs, read(spark, SF_SMALL, "labels")).collect() if r.predicted}
    rows = [r for r in duck.sql("select doc_id, text from documents order by doc_id").fetchall() if r[0] not in toxic]
    best = {}
    for doc_id, text in rows:
        key = re.sub(r"[\x20\x09-\x0D]", "", text)
        best[key] = min(best.get(key, (1, 0, "")), (-len(text), doc_id, text))
    rows = sorted((doc_id, text) for _, doc_id, text in best.values())
    rows = [r for r, (doc_id, _, component) in zip(rows, sorted(brute_near(rows), key=lambda x: x[0])) if doc_id == component]
    items = [(str(i), decontaminate.words_of(t)) for i, t in duck.sql("select item_id, text from benchmark").fetchall()]
    want = []
    for doc_id, text in rows:
        n, hit, _ = brute_hits(items, decontaminate.words_of(text), 13)
        if not (hit and 20 * len(hit) >= n):
            ids = WHOLE.encode_ordinary(text)
            want.append((doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                         hashlib.sha256(text.encode()).hexdigest()))
    got = corpus_pipeline.run(spark, SF_SMALL)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, got.collect())) == want
    assert 0 < len(want) < docs.count()


def test_stages_keep_the_columns_and_bear_odd_rows(spark):
    texts = [(None, None), (1, None), (2, ""), (2, ""), (3, "a b"), (3, "a b"), (4, "x " * 30_000), (5, "Clean text of some words.")]
    docs = spark.createDataFrame([(i, t, None, "s", None) for i, t in texts], read(spark, SF_SMALL, "documents").schema)
    for rows in (docs, docs.limit(0)):
        for name, step in corpus_pipeline.STAGES:
            out = step(spark, rows, SF_SMALL)
            if name != "byte_bpe":
                assert out.schema.names == docs.schema.names, name
                rows = out
            else:
                assert out.columns[0] == "doc_id"
    kept = docs
    for _, step in corpus_pipeline.STAGES[:-1]:
        kept = step(spark, kept, SF_SMALL)
    # Empty texts are equal to each other; among equal texts the smallest doc_id stays.
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "4", "5"]
