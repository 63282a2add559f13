"""Decontamination against SQL and brute force; toxicity by held-out accuracy."""

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF_SMALL
from nivalis.llm import decontaminate, queries, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, hits string, score string"


def brute(items, doc, window):
    hit, held = set(), set()
    for name, words in items:
        size = min(window, len(words))
        for i in range(len(words) - size + 1 if words else 0):
            for j in range(len(doc) - size + 1):
                if doc[j : j + size] == words[i : i + size]:
                    hit.update(range(j, j + size))
                    held.add(name)
    return len(doc), hit, held


word = st.sampled_from(["a", "b", "c", "dé", "0"])


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(word, max_size=9), max_size=5), st.lists(st.lists(word, max_size=25), max_size=4), st.integers(2, 5))
def test_automaton_against_brute_force(items, docs, window):
    named = [(str(i // 2), [w.encode() for w in ws]) for i, ws in enumerate(items)]
    automaton = decontaminate.ItemAutomaton(named, window)
    got = automaton.hits(pa.array([" ".join(d) for d in docs], pa.large_string()))
    for (n, spans, held), doc in zip(got, docs, strict=True):
        want = brute(named, [w.encode() for w in doc], window)
        assert (n, {k for a, b in spans for k in range(a, b + 1)}, held) == want


def test_query_against_sql(spark, duck):
    got = queries.QUERIES["op1_decontaminate"](spark, SF_SMALL)
    want = duck.sql(queries.ORACLE["op1_decontaminate"])
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    assert (sorted(map(str, map(tuple, got.select(cols).collect())))
            == sorted(map(str, want.project(", ".join(cols)).fetchall())))


def bench_of(spark):
    long = " ".join(f"w{i}" for i in range(40))
    rows = [(1, long), (1, long), (2, "Short, item"), (3, None), (4, "... !"), (None, " ".join(f"w{i}" for i in range(20)))]
    return spark.createDataFrame(rows, "item_id long, text string"), long


def test_decontamination_edge_cases_in_one_and_many_blocks(spark):
    benchmark, long = bench_of(spark)
    texts = [(1, None), (2, ""), (3, "?!"), (4, "x SHORT item y"), (5, long), (5, long), (6, "pad " * 300_000 + long),
             (7, " ".join(long.split()[:12])), (8, " ".join(long.split()[7:20])), (None, "w1 w2")]
    docs = spark.createDataFrame([(i, t, None, "s", None, "x", "y") for i, t in texts], SCHEMA)
    results = []
    for most in (50_000, 15):
        marked = decontaminate.scan(docs, benchmark, "m", block_words=most)
        results.append(sorted(str((r.doc_id, r.text and len(r.text), r.hits, r.m)) for r in marked.collect()))
    assert results[0] == results[1]
    by_id = {r.doc_id: r for r in decontaminate.report(docs, benchmark).collect()}
    assert [by_id[i].n_hit for i in (1, 2, 3, 4, 5, 6, 7, 8, None)] == [0, 0, 0, 2, 40, 40, 0, 13, 0]
    assert [by_id[i].n_items for i in (4, 5, 6, 8)] == [1, 2, 2, 2]
    assert [i for i, r in by_id.items() if r.contaminated] == [4, 5, 8] or {i for i, r in by_id.items() if r.contaminated} == {4, 5, 8}
    kept = decontaminate.drop_contaminated(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "6", "7", "None"]
    cut = {r.doc_id: r.text for r in decontaminate.remove_spans(docs, benchmark).collect()}
    assert cut[6] == "pad " * 300_000 and cut[7] == " ".join(long.split()[:12]) and cut[1] is None
    empty = benchmark.limit(0)
    assert decontaminate.drop_contaminated(docs, empty).count() == len(texts)
    assert decontaminate.report(docs.limit(0), benchmark).count() == 0


def test_toxicity_held_out_accuracy(spark, duck):
    sf = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in queries.QUERIES["op7_toxicity"](spark, sf).collect()}
    assert len(got) == duck.sql(f"select count(*) from read_parquet('{sf}/documents.parquet')").fetchall()[0][0]
    labels = duck.sql(f"select doc_id, toxic from read_parquet('{sf}/labels.parquet')").fetchall()
    out = [(got[i], y) for i, y in labels if got[i].held_out]
    bad, good = [r for r, y in out if y], [r for r, y in out if not y]
    assert len(bad) > 50 and len(good) > 400
    assert sum(r.predicted for r in bad) / len(bad) >= 0.85
    assert sum(r.predicted for r in good) / len(good) <= 0.01


def test_toxicity_edge_cases(spark):
    labels = spark.createDataFrame([(1, 1, 1), (1, 1, 1), (2, None, None), (77, 1, 0), (None, 0, 1)], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame([(i, t, None, "s", 1, "x", "y") for i, t in [
        (1, None), (1, None), (2, ""), (None, "x y"), (3, "word " * 100_000)]], SCHEMA)
    got = toxicity.report(docs, labels).collect()
    assert len(got) == 5 and all(r.score == 0 and r.predicted == 0 for r in got)
    assert toxicity.drop_toxic(docs, labels.limit(0)).columns == docs.columns
    assert toxicity.report(docs.limit(0), labels).count() == 0
    many = spark.createDataFrame([(i, f"this is {'awful' if i % 4 == 0 else 'nice'} {i} and {i * 7 % 13} "
                                      f"{'awful' if i % 4 == 0 else 'fine'} {i % 17} end") for i in range(400)], "doc_id long, text string")
    lab = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.report(many, lab).collect()}
    assert all(got[i].predicted == int(i % 4 == 0) for i in range(400))
    kept = toxicity.drop_toxic(many.withColumn("score", many.text), lab)
    assert kept.count() == 300 and kept.columns == ["doc_id", "text", "score"]
