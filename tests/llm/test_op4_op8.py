"""Token files and byte-level BPE against the libraries on whole texts."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from conftest import SF_SMALL
from nivalis.llm import byte_bpe, queries, token_files
from nivalis.session import scratch_path

RANKS, PATTERN = queries.byte_bpe_parameters()
WHOLE = tiktoken.Encoding("whole", pat_str=PATTERN, special_tokens={}, mergeable_ranks={
    base64.b64decode(a): int(b) for a, b in map(bytes.split, RANKS.splitlines())})
TINY = byte_bpe.BytePairMonoid(RANKS, PATTERN, leaf=5, window=2)
WORDS = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
WORDS.encode_special_tokens = True


def test_byte_bpe_query(spark, duck):
    got = {r.doc_id: r for r in queries.QUERIES["op8_byte_bpe"](spark, SF_SMALL).collect()}
    rows = duck.sql("select doc_id, text from documents").fetchall()
    assert len(got) == len(rows)
    for doc_id, text in rows:
        ids = WHOLE.encode_ordinary(text)
        r = got[doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("ab'slvetrdm  \n\t1²9.,!é中 Ā\u0301\u3000"), st.characters(codec="utf-8")), max_size=80))
def test_any_tree_of_joins_gives_the_encoding(text):
    assert TINY.encode(text) == WHOLE.encode_ordinary(text)
    assert TINY.decode(TINY.encode(text)) == text.encode()


def test_long_texts_without_cuts():
    rng = random.Random(1)
    monoid = byte_bpe.BytePairMonoid(RANKS, PATTERN, leaf=1000)
    for text in ["z" * 100_000, " " * 30_001, "中文" * 20_000, "ab " * 30_000, "".join(rng.choices("ab'ré 1!\n", k=50_000))]:
        assert monoid.encode(text) == WHOLE.encode_ordinary(text)


def test_byte_bpe_edge_cases(spark):
    df = spark.createDataFrame([(1, None, 5), (1, None, 5), (2, "", 6), (None, "x y", None)], "doc_id long, text string, ids int")
    got = byte_bpe.encode(df, RANKS, PATTERN).collect()
    assert sorted(len(r.ids) for r in got) == [0, 0, 0, 2]
    assert byte_bpe.digests(df, RANKS, PATTERN).count() == 4
    assert byte_bpe.digests(df.limit(0), RANKS, PATTERN).count() == 0


def test_token_files_query(spark, duck):
    got = sorted(queries.QUERIES["op4_token_files"](spark, SF_SMALL).collect(), key=lambda r: r.doc_id)
    rows = duck.sql("select doc_id, text from documents order by doc_id").fetchall()
    start = 0
    for r, (doc_id, text) in zip(got, rows, strict=True):
        ids = [*WORDS.encode(text, add_special_tokens=False).ids, 2]
        assert (r.doc_id, r.start, r.n_tokens) == (doc_id, start, len(ids))
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("ab'sl  \n\t1.é\u0301\u0300\u0323İΣ\u00a0\u3000\x85"), st.characters(codec="utf-8")), max_size=40))
def test_words_are_encoded_as_whole_texts_are(text):
    import pyarrow as pa
    ids, sizes = ENCODER.encode(pa.array([text, None, text], pa.large_string()).fill_null(""), 2)
    want = [*WORDS.encode(text, add_special_tokens=False).ids, 2]
    assert ids.tolist() == [*want, 2, *want] and sizes.tolist() == [len(want), 1, len(want)]


ENCODER = token_files.WordEncoder(queries.vocabulary("word_bpe_49k.json").decode())


def test_token_files_edge_cases(spark):
    df = spark.createDataFrame([(5, "b a", 1), (None, "x", 2), (5, "b a", 3), (-1, None, 4), (9, "word " * 40_000, 5)],
                               "doc_id long, text string, payload int")
    json = queries.vocabulary("word_bpe_49k.json").decode()
    path = scratch_path(spark, "t-files")
    manifest = token_files.write(df, path, json, 2, 49_408)
    got = sorted(token_files.read_back(spark, path, manifest, "ids array<int>", lambda ids: (ids.tolist(),)).collect(),
                 key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, -1, 5, 5, 9]
    assert [r.ids for r in got] == [[*WORDS.encode(t, add_special_tokens=False).ids, 2] for t in ("x", "", "b a", "b a", "word " * 40_000)]
    found = [token_files.document(path, m.file, 9) for m in manifest.collect()]
    assert [len(f) for f in found if f is not None] == [40_001]
    path = scratch_path(spark, "t-files")
    empty = token_files.write(df.limit(0), path, json, 2, 49_408)
    assert token_files.read_back(spark, path, empty, "ids_crc32 long", token_files.crc32_of).count() == 0


ADDED = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|end", "oftext|>"]
PLAIN = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*ADDED, "a", " ", "'", "s", "1", "<", "|", ">", "\n", "é", "\u0301", "don", "'t"]), max_size=12), max_size=4))
def test_added_tokens_in_texts_have_their_ids(texts):
    import pyarrow as pa
    texts = ["".join(t) for t in texts] + ["a <|endoftext|> b"]
    ids, sizes = ENCODER.encode(pa.array(texts, pa.large_string()), 2)
    want = [[*PLAIN.encode(t, add_special_tokens=False).ids, 2] for t in texts]
    assert want[-1] == [320, 49407, 321, 2]
    assert ids.tolist() == sum(want, []) and sizes.tolist() == [len(w) for w in want]


def test_token_files_of_texts_with_added_tokens(spark):
    texts = ["x<|startoftext|>A <|endoftext|><|endoftext|> b", "plain", "<|endoftext|>"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    path = scratch_path(spark, "t-files")
    manifest = token_files.write(df, path, queries.vocabulary("word_bpe_49k.json").decode(), 2, 49_408)
    got = sorted(token_files.read_back(spark, path, manifest, "ids array<int>", lambda ids: (ids.tolist(),)).collect())
    want = [[*PLAIN.encode(t, add_special_tokens=False).ids, 2] for t in texts]
    assert [r.ids for r in got] == want and [r.start for r in got] == [0, len(want[0]), len(want[0]) + len(want[1])]


def test_texts_pass_the_tree_with_the_parameters_of_the_query():
    class Seen:
        def __init__(self, encoding):
            self.encoding, self.sizes = encoding, []

        def encode_ordinary(self, text):
            self.sizes.append(len(text))
            return self.encoding.encode_ordinary(text)

    monoid = byte_bpe.BytePairMonoid(RANKS, PATTERN)
    whole, monoid.encoding = monoid.encoding, Seen(monoid.encoding)
    for text in ("It's the 3rd of May, isn't it?  We'll see 2024 \n\n\t lines. " * 40, "各位 读者，天气 很好。 " * 90, "a b" * 200,
                 "x" * 1000 + " 12 " + "y" * 1000):
        monoid.encoding.sizes.clear()
        assert monoid.encode(text) == whole.encode_ordinary(text)
        assert len(monoid.encoding.sizes) > 2 * len(text) / byte_bpe.LEAF - 2
        if "xx" not in text:
            assert max(monoid.encoding.sizes) <= byte_bpe.LEAF
