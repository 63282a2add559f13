"""Near duplicates against all pairs by brute force; components of small graphs; signatures never miss a similar pair."""

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF_SMALL
from nivalis.llm import jaccard_core, jaccard_join, queries
from nivalis.llm import components as components_module
from nivalis.llm.components import components, forest_of

LOWER = {c: c + 32 for c in range(65, 91)}
SCHEMA = "doc_id long, text string, lang string, node long, n long"


def shingles(text):
    words = [w for w in (text or "").translate(LOWER).translate({c: 32 for c in range(9, 14)}).split(" ") if w]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(texts):
    """(doc_id, set size, component_id) by comparing every two texts."""
    sets = [shingles(t) for _, t in texts]
    up = list(range(len(texts)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                up[root(i)] = root(j)
    ids = {}
    for i, (doc_id, _) in enumerate(texts):
        known = [d for d in (ids.get(root(i)), doc_id) if d is not None]
        ids[root(i)] = min(known, default=None)
    return sorted(((d, len(sets[i]), ids[root(i)]) for i, (d, _) in enumerate(texts)), key=str)


def got_of(df):
    return sorted(map(tuple, df.select("doc_id", "n_shingles", "component_id").collect()), key=str)


def edited(rng, words, share):
    return [rng.choice("abcdefgh") + str(rng.randrange(9999)) if rng.random() < share else w for w in words]


def family(rng, n, length, share):
    base = [f"w{rng.randrange(5000)}" for _ in range(length)]
    return [" ".join(edited(rng, base, rng.random() * share)) for _ in range(n)]


def test_query_on_whole_small_table(spark, duck):
    texts = duck.sql("select doc_id, text from documents").fetchall()
    assert got_of(queries.QUERIES["op6_jaccard_join"](spark, SF_SMALL)) == brute(texts)


@pytest.mark.parametrize("large, hot", [(48, 40), (3, 4), (1, 2)])
def test_families_around_the_threshold(spark, monkeypatch, large, hot):
    monkeypatch.setattr(jaccard_join, "LARGE", large)
    monkeypatch.setattr(jaccard_join, "HOT", hot)
    monkeypatch.setattr(jaccard_join, "BLOCK", 7)
    rng = random.Random(large)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [t for length in (4, 5, 9, 30, 80, 300) for t in family(rng, 25, length, 0.06)]
    texts += [f"{passage} {' '.join(f'x{i}y{k}' for k in range(20))}" for i in range(40)]
    texts += [" ".join(f"u{i}v{k}" for k in range(30)) for i in range(30)]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame([(i, t, "en", 1, 2) for i, t in rows], SCHEMA).repartition(3)
    assert got_of(jaccard_join.report(docs)) == brute(rows)


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 700), st.integers(0, 2**32), st.floats(0, 1), st.floats(0, 1))
def test_similar_sets_share_a_signature(size, seed, hot_share, spread):
    rng = np.random.default_rng(seed)
    union = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
    # Of the union, at most a quarter is in one of the two only.
    lone = rng.permutation(len(union))[: int(len(union) * 0.25)]
    left = lone[: int(len(lone) * spread)]
    a, b = np.delete(union, lone[len(left):]), np.delete(union, left)
    if not jaccard_core.similar(a, b):
        return
    hot = np.sort(rng.choice(union, int(len(union) * hot_share), replace=False))
    doc, sig = jaccard_core.signatures(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), hot)
    assert set(sig[doc == 0].tolist()) & set(sig[doc == 1].tolist())


def test_matrix_overlaps():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 9000, rng.integers(0, 6000), dtype=np.uint64)) for _ in range(9)]
    got = jaccard_join.overlap(sets[:4], sets[4:])
    assert got.tolist() == [[len(np.intersect1d(x, y)) for y in sets[4:]] for x in sets[:4]]


def test_edge_cases_and_filter(spark):
    texts = [(5, None), (6, ""), (7, " \t"), (8, "One two"), (3, "one TWO"), (9, "one two three four five"), (9, "one two three four five"),
             (9, "something else that is not alike at all"), (None, "one  two"), (None, "only null here now"), (1, "z " * 50_000), (2, "z " * 9)]
    docs = spark.createDataFrame([(i, t, "en", 1, 2) for i, t in texts], SCHEMA)
    assert got_of(jaccard_join.report(docs)) == brute(texts)
    assert jaccard_join.report(docs.limit(0)).count() == 0
    kept = jaccard_join.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id), r.text and r.text[:9]) for r in kept.collect()) == sorted([
        ("5", None), ("6", ""), ("7", " \t"), ("3", "one TWO"), ("9", "one two t"), ("9", "something"), ("None", "only null"), ("1", "z z z z z")])
    assert jaccard_join.drop_near_duplicates(docs.limit(0)).count() == 0


def test_components_of_paths_stars_and_rings(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 180)] + [(200 + i, 200 + (i + 1) % 9) for i in range(9)] + [(300, 300)]
    names = list(range(400))
    rng.shuffle(names)
    df = spark.createDataFrame([(names[a], names[b]) for a, b in edges], "a long, b long")
    got = dict(map(tuple, components(df).collect()))
    for group in (range(0, 41), range(100, 180), range(200, 209)):
        members = [names[i] for i in group]
        assert {got[m] for m in members} == {min(members)}
    assert len(got) == 41 + 80 + 9
    assert components(df.limit(0)).count() == 0


def test_sketches_never_tell_similar_sets_apart():
    rng = np.random.default_rng(11)
    for size in (3, 200, 1500, 1600, 6000, 6300, 30_000):
        for cut in (0.0, 0.1, 0.2, 0.25):
            union = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
            lone = rng.permutation(len(union))[: int(len(union) * cut)]
            for split in (0, len(lone) // 2):
                a, b = np.delete(union, lone[split:]), np.delete(union, lone[:split])
                if len(a) and len(b):
                    x, y = jaccard_join._sketches(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
                    assert jaccard_join._apart(x, y) <= len(lone)
                    assert not jaccard_core.similar(a, b) or 7 * jaccard_join._apart(x, y) <= len(a) + len(b)


@pytest.mark.parametrize("n", range(7))
def test_slices_of_few_words(n):
    sets, borders = jaccard_core.shingle_sets(pa.array([" ".join("abcdef"[:n])], pa.large_string()))
    assert borders.tolist() == [0, len(sets)] and len(sets) == (max(1, n - 4) if n else 0)


def test_tables_of_one_row_of_three_words(spark):
    for n in (3, 6):
        rows = [(7, " ".join("abcdef"[:n]))]
        docs = spark.createDataFrame([(*rows[0], "en", 1, 2)], SCHEMA)
        assert got_of(jaccard_join.report(docs)) == brute(rows)


def reached(edges):
    up = {v: v for e in edges for v in e}

    def root(v):
        while up[v] != v:
            v = up[v]
        return v

    for a, b in edges:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {v: root(v) for v in up}


@given(st.lists(st.tuples(st.integers(-40, 40), st.integers(-40, 40)).filter(lambda e: e[0] != e[1]), max_size=60))
@settings(max_examples=200, deadline=None)
def test_forest_reaches_the_smallest_node(edges):
    a, b = (np.array([e[i] for e in edges], np.int64) for i in (0, 1))
    node, least = forest_of(a, b)
    want = reached(edges)
    assert dict(zip(node.tolist(), least.tolist())) == {v: r for v, r in want.items() if v != r}


def test_components_over_many_small_forests(spark, monkeypatch):
    monkeypatch.setattr(components_module, "EDGES", 7)
    rng = random.Random(5)
    edges = [(rng.randrange(-200, 200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(1000, 1060)]
    edges += [(5000, 2000 + i) for i in range(40)] + [(3, 3)] * 3
    edges = [e for e in edges if e[0] != e[1] or e[0] == 3] * 2
    rng.shuffle(edges)
    got = [tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect()]
    want = reached([e for e in edges if e[0] != e[1]])
    assert len(got) == len(want) and dict(got) == want
