"""Sharding, chat formatting and exact dedup: brute force, SQL and the defined edge cases."""

import hashlib
import json
import math
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from nivalis.llm import chat_format, exact_dedup, queries, sharding
from nivalis.session import scratch_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, shard string"


def docs_of(spark, texts):
    rows = [(i, t, "en", None, None, "x", "y") for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


def jump_one(key, n):
    key, b, j = key % 2**64, -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = math.floor((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_sharding_against_a_plain_loop(spark, duck):
    got = [r.asDict() for r in queries.QUERIES["op2_sharding"](spark, SF_SMALL).collect()]
    texts = dict(duck.sql("select doc_id, text from documents").fetchall())
    assert len(got) == len(texts)
    slots = defaultdict(list)
    for r in got:
        raw = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 8, zlib.crc32(raw))
        assert r["shard"] == jump_one(r["doc_id"], 24) and r["grown_shard"] == jump_one(r["doc_id"], 25)
        assert r["grown_shard"] in (r["shard"], 24)
        slots[r["shard"]].append((r["slot"], r["doc_id"]))
    for s in slots.values():
        assert [x for x, _ in sorted(s)] == list(range(len(s)))
        assert [d for _, d in sorted(s)] == sorted(d for _, d in s)


def test_sharding_edge_cases(spark):
    docs = docs_of(spark, [(None, None), (7, "a"), (7, "a"), (-3, ""), (2**62, "é" * 50_000)])
    got = sharding.number(sharding.assign(docs, 3), 3).collect()
    assert len(got) == 5 and {r.size for r in got} == {8, 9, 100_008}
    for s in range(3):
        mine = sorted(r.slot for r in got if r.shard == s)
        assert mine == list(range(len(mine)))
    assert sharding.number(sharding.assign(docs.limit(0), 3), 3).count() == 0


@pytest.mark.parametrize("key", ["op9_chat_format", "op10_exact_dedup"])
def test_against_sql(spark, duck, key):
    got = queries.QUERIES[key](spark, SF_SMALL)
    want = duck.sql(queries.ORACLE[key])
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    assert (sorted(map(str, map(tuple, got.select(cols).collect())))
            == sorted(map(str, want.project(", ".join(cols)).fetchall())))


def test_chat_round_trip_of_hostile_texts(spark):
    texts = [None, "", "\\", "<|im_end|>\n", "<|im_start|>user\nx", "<", "|", "<\\|", "\\\\<|", "a\nb\x00 é𝄞", "x" * 70_000]
    rows = [(c, t, "assistant" if t % 2 else ("we|<|\nird\\" if c else None), texts[(c + t) % len(texts)])
            for c in range(3) for t in range(len(texts))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat_format.parse(chat_format.stage_rendered(
        chat_format.turns_of_records(chat_format.records_of_rows(df), "record").select("conv_id", "turns")))
    for r in got.collect():
        mine = [((x[2] or ""), (x[3] or "")) for x in sorted(rows, key=lambda x: x[1]) if x[0] == r.conv_id]
        assert [tuple(t) for t in r.read_turns] == mine
        assert r.loss_text == "".join(t for role, t in mine if role == "assistant")
        raw = r.formatted.encode()
        assert len(r.loss_spans) == sum(role == "assistant" for role, _ in mine)
        assert all(raw[s.start + s.len:].startswith(b"<|im_end|>") for s in r.loss_spans)
    empty = df.limit(0)
    assert chat_format.records_of_rows(empty).count() == 0


def test_chat_layouts_of_json_records(spark):
    records = [
        ({"messages": [{"role": "user", "content": "q"}, {"content": "a", "role": "assistant"}]}, [("user", "q"), ("assistant", "a")]),
        ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}, [("user", "q"), ("assistant", "a")]),
        ({"prompt": "q", "response": "a"}, [("user", "q"), ("assistant", "a")]),
        ({"completion": "a", "prompt": "q"}, [("user", "q"), ("assistant", "a")]),
        ({"instruction": "s", "input": "q", "output": "a"}, [("system", "s"), ("user", "q"), ("assistant", "a")]),
        ({"instruction": "s", "output": "a"}, [("user", "s"), ("assistant", "a")]),
        ({"title": "t"}, None)]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, (r, _) in enumerate(records)] + [(99, "not json"), (98, None)],
                               "id int, record string")
    got = {r.id: r.turns for r in chat_format.turns_of_json(df, "record").collect()}
    for i, (_, want) in enumerate(records):
        assert (got[i] and [tuple(t) for t in got[i]]) == want
    assert got[99] is None and got[98] is None
    typed = spark.createDataFrame([(("q", "a"),)], "rec struct<prompt: string, response: string>")
    assert [tuple(t) for t in chat_format.turns_of_records(typed, "rec").first().turns] == [("user", "q"), ("assistant", "a")]


def brute_groups(texts):
    groups = defaultdict(list)
    for i, t in texts:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i))
    return {k: (min(v)[2], len(v)) for k, v in groups.items()}


def test_exact_dedup_edge_cases_and_increments(spark):
    texts = [(1, "a b"), (2, "ab"), (3, "a  b"), (4, "a\t\nb"), (5, None), (6, ""), (7, " \x0b"), (8, "A b"),
             (9, "a b"), (3, "a  b"), (None, "ab"), (10, "z" * 300_000)]
    index = exact_dedup.DigestIndex(spark, scratch_path(spark, "t-index"), 4)
    got = exact_dedup.decide(docs_of(spark, texts), index).collect()
    want = brute_groups(texts)
    assert len(got) == len(texts)
    by_sha = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in want.items()}
    for r in got:
        assert (r.keep_id, r.group_size) == by_sha[r.text_sha256]
        assert r.kept == (r.doc_id == r.keep_id)
    before = index.table().count()
    later = docs_of(spark, [(20, "ab"), (21, "new"), (22, "n e w"), (22, "n e w")])
    kept = exact_dedup.drop_duplicates(later, index).collect()
    assert [(r.doc_id, r.text, r.digest) for r in kept] == [(22, "n e w", "x")]
    assert index.table().count() == before + 1
    empty = exact_dedup.DigestIndex(spark, scratch_path(spark, "t-index"), 4)
    assert exact_dedup.decide(docs_of(spark, texts).limit(0), empty).count() == 0


def test_heavy_group_takes_the_broadcast_path(spark):
    docs = spark.range(30_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same")
                                      .otherwise(F.concat(F.lit("t"), (F.col("id") % 20_000).cast("string"))).alias("text"))
    index = exact_dedup.DigestIndex(spark, scratch_path(spark, "t-index"), 4)
    got = exact_dedup.decide(docs, index)
    assert got.count() == 30_000
    heavy = got.filter("group_size = 10000")
    assert heavy.count() == 10_000 and heavy.filter("kept").count() == 1


def test_group_sizes_over_three_batches_and_compaction(spark):
    index = exact_dedup.DigestIndex(spark, scratch_path(spark, "t-index"), 4)
    batches = [[(1, "ab"), (2, "cd")], [(3, "a b"), (4, "a  b"), (5, "ef")], [(6, "ab"), (7, "ef"), (8, "gh")]]
    sizes = [{1: (1, 1), 2: (2, 1)}, {3: (1, 3), 4: (1, 3), 5: (5, 1)}, {6: (1, 4), 7: (5, 2), 8: (8, 1)}]
    for batch, want in zip(batches, sizes):
        got = exact_dedup.decide(docs_of(spark, batch), index).collect()
        assert {r.doc_id: (r.keep_id, r.group_size) for r in got} == want
        assert all(r.kept == (r.doc_id == r.keep_id) for r in got)
    rows = sorted(map(tuple, index.table().collect()), key=str)
    whole = index.compact(scratch_path(spark, "t-index"))
    assert sorted(map(tuple, whole.table().collect()), key=str) == rows
    assert spark.table(whole.name).count() == len(rows) == 4
    assert not spark.catalog.tableExists(index.name)
    got = exact_dedup.decide(docs_of(spark, [(9, "g h")]), whole).first()
    assert (got.keep_id, got.group_size, got.kept) == (8, 2, False)
    whole.close()


def test_shard_folders_with_clashing_columns(spark):
    docs = (spark.range(40).select(F.when(F.col("id") > 0, F.col("id")).alias("doc_id"), F.lit("t").alias("text"),
                                   F.col("id").alias("shard"), F.lit("k").alias("key"), F.lit("u").alias("Shard_")))
    path = scratch_path(spark, "t-shards")
    name = sharding.write_shards(docs, 5, path)
    back = spark.read.parquet(path)
    assert name == "shard__" and set(back.columns) == {*docs.columns, name}
    want = {r.doc_id: r.shard for r in sharding.assign(docs, 5).collect()}
    got = {r.doc_id: r[name] for r in back.collect()}
    assert got == want and back.select(*docs.columns).exceptAll(docs).count() == 0 and len(got) == 40


def test_render_keeps_columns_of_any_name(spark):
    df = spark.createDataFrame([("p", "t", [("user", "hi"), ("assistant", "yes")])],
                               "parts string, text string, turns array<struct<role: string, text: string>>")
    row = chat_format.render(df).first()
    assert (row.parts, row.text) == ("p", "t") and row.formatted.count("<|im_start|>") == 2
    assert [row.formatted.encode()[s.start : s.start + s.len] for s in row.loss_spans] == [b"yes"]
