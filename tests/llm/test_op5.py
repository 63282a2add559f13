"""Log-bilinear scores: contract counts by brute force, a proper distribution, better than the base on held-out text."""

import math
import re
import zlib
from collections import Counter

import numpy as np

from conftest import SF_SMALL
from nivalis.llm import lm_score, queries

LOWER = {c: c + 32 for c in range(65, 91)}


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), ""]


def is_held_out(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


def check_base(rows, docs):
    counts = Counter(t for i, x in docs if not is_held_out(i) for t in tokens(x))
    n, v = sum(counts.values()), len(counts)
    want = sorted((str(i), is_held_out(i), len(tokens(x)), sum(counts[t] > 0 for t in tokens(x)), n,
                   round(sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens(x)), 5)) for i, x in docs)
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in rows) == want
    return counts


def test_query_against_brute_force_and_base(spark, duck, monkeypatch):
    monkeypatch.setattr(lm_score, "COMMON", 500)  # many words take the joined way
    docs = duck.sql("select doc_id, text from documents").fetchall()
    rows = queries.QUERIES["op5_lm_score"](spark, SF_SMALL).collect()
    check_base(rows, docs)
    out = [r for r in rows if r.held_out]
    assert len(out) > 10
    assert sum(r.score for r in out) > sum(r.base_score for r in out) + 0.1 * sum(r.n_tokens for r in out)
    assert all(r.score < 0 for r in rows)


def test_probabilities_of_all_words_sum_to_one(spark, duck):
    docs = spark.createDataFrame(duck.sql("select doc_id, text from documents limit 60").fetchall(), "doc_id long, text string")
    counts = lm_score.word_counts(docs)
    model = lm_score.vocabulary(counts)
    encoded = lm_score.encode(docs, model)
    table = lm_score.table_of(lm_score.train(*lm_score.trigram_counts(encoded, model.end)))
    assert np.allclose((10.0 ** table.astype(float)).sum(1), 1, atol=1e-4)
    # Within a class: known words by (c + 1) and one place for the unknown fill the room.
    own = set(model.words[: lm_score.OWN]) | {lm_score.END}
    filled = np.zeros(lm_score.CLASSES)
    for r in counts.collect():
        if r.word not in own:
            filled[model.class_of_byte[r.word.encode()[-1]]] += r.c + 1
    rest = np.arange(lm_score.CLASSES) >= model.first_rest
    assert np.allclose(np.log10(filled + 1)[rest], model.log_room[rest])


def test_edge_cases(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "STEPS", 20)
    texts = [(1, None), (1, None), (2, ""), (3, " \t\n"), (None, "A a B"), (4, "a b c É"), (5, "x " * 60_000), (5, "x " * 60_000), (9, "É\x00 ñ")]
    docs = spark.createDataFrame([(i, t, 1, "y", "z") for i, t in texts], "doc_id long, text string, row_id int, word string, others string")
    rows = lm_score.score(docs).collect()
    assert len(rows) == len(texts)
    check_base(rows, texts)
    assert lm_score.score(docs.limit(0)).count() == 0
    only_out = next(i for i in range(100) if is_held_out(i))
    none = spark.createDataFrame([(only_out, "a b")], "doc_id long, text string")
    r = lm_score.score(none).first()
    assert (r.train_tokens, r.n_known, r.base_score) == (0, 0, 0.0) and r.score < 0


def test_classes_of_the_model(spark, duck):
    docs = spark.createDataFrame(duck.sql("select doc_id, text from documents").fetchall(), "doc_id long, text string")
    model = lm_score.vocabulary(lm_score.word_counts(docs))
    assert lm_score.CLASSES >= 160 and model.first_rest >= 96


def test_end_token_less_frequent_than_the_common_words(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "STEPS", 20)
    monkeypatch.setattr(lm_score, "COMMON", 3)
    first, second = [i for i in range(100) if not is_held_out(i)][:2]
    texts = [(first, "a " * 50 + "b " * 40 + "c " * 30 + "d " * 20 + "e " * 10 + "f"), (second, "d e c f g")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    check_base(lm_score.score(docs).collect(), texts)
