"""Token-id files: one shared zstandard dictionary, one frame per document, an offset index.

``write`` encodes every text, appends the end id and writes the documents in
ascending doc_id order to binary files on the shared file system; ``read_back``
and ``document`` read them.  Layout of a file:

    magic | dictionary SHA-256 (32 bytes) | id width (1 byte)
    one zstandard frame per document
    index: per document doc_id, has_id, n_tokens, tokens before it in the file, byte offset, byte length
    number of documents (8 bytes) | index offset (8 bytes) | magic

A manifest table has one row per file, in order; summing its token counts gives
each file's global start.  Tasks write to a name of their own and move the file
into place when it is whole, so a task that is run again replaces it.

The dictionary is fitted on a bounded sample (``DICT_DOCS`` documents, the
first ``DICT_IDS`` ids of each); it changes sizes only, every id of every document is
written.  Words are what the tokenizer never joins over (it drops ASCII white
space), so each distinct word of a task is encoded once by the library and the
ids of a text are gathered from its words.  Added tokens of the tokenizer that a
text holds as written have their own ids, as in the library.

Defined cases: null and empty texts have the end id only; rows of a null doc_id
come first; repeated rows are documents of their own; an empty table gives no
files and an empty result; other columns play no part.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import plain_text, ragged_take, raw_text, slices, stage

MAGIC = b"TOKIDZ01"
DICT_DOCS, DICT_IDS, DICT_BYTES = 2_000, 4_096, 64 << 10
LEVEL = 3
KNOWN_WORDS = 350_000
#: Pieces that are encoded in one call of the library, and calls in one batch.
TOGETHER, CALLS = 128, 64
ENTRY = np.dtype([("doc_id", "<i8"), ("has_id", "u1"), ("n_tokens", "<u8"), ("start", "<u8"), ("offset", "<u8"),
                  ("length", "<u8")])


#: Byte classes of ``pieces``: 1 letter, 2 digit, 3 punctuation but the apostrophe, 4 white space, 0 all else.
CLASS = np.zeros(256, np.uint8)
CLASS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
CLASS[0x30:0x3A] = 2
CLASS[[b for b in range(0x21, 0x7F) if not chr(b).isalnum() and b != 0x27]] = 3
CLASS[[0x20, *range(0x09, 0x0E)]] = 4


def pieces(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Parts of the texts that the tokenizer encodes apart, A-Z in lower case, and each text's offsets in them.

    Sure cuts are ASCII white space (dropped), both sides of a digit, and where
    a letter (ASCII or one of the Latin-1 letters) meets ASCII punctuation; at
    an apostrophe or another character nothing is cut.
    """
    borders, raw = raw_text(texts)
    kind = CLASS[raw]
    left, right = kind, kind  # of the character that ends, and that starts, at a byte
    lead = np.flatnonzero(raw[:-1] == 0xC3)
    if len(lead):
        lead = lead[(raw[lead + 1] & 0xDF) != 0x97]  # all but the signs of multiplication and division
        left, right = kind.copy(), kind.copy()
        left[lead + 1], right[lead] = 1, 1
    code = left[:-1] << 3 | right[1:]
    cut = np.zeros(len(raw) + 1, bool)
    cut[1:-1] = CUTS[code]
    cut[borders] = True
    space = kind == 4
    kept = np.concatenate(([0], np.cumsum(~space)))
    starts = np.flatnonzero(cut[:-1] & ~space)  # a cut follows every space, so each piece starts at one
    flat = pa.py_buffer(np.ascontiguousarray(raw[~space]))
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(np.append(kept[starts], kept[-1])), flat, null_count=0)
    return pc.ascii_lower(words), np.searchsorted(starts, borders)


CUTS = np.zeros(64, bool)
for _a in range(5):
    for _b in range(5):
        CUTS[_a << 3 | _b] = 4 in (_a, _b) or (0 not in (_a, _b) and (_a != _b or _a == 2))


class WordEncoder:
    """Ids of whole texts, each distinct piece of the task encoded once by the library."""

    def __init__(self, tokenizer_json: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives each task its core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        added = self.tokenizer.get_added_tokens_decoder()
        if any(t.normalized or t.lstrip or t.rstrip or t.single_word or not t.special for t in added.values()):
            raise ValueError("added tokens can only be special ones that are matched as they are written")
        self.added = {t.content: i for i, t in added.items()}
        self.cuts = "|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))
        # Texts are cut at the added tokens first; a piece that only looks like one (in lower case) is plain text.
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end a word
        self.last[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._forget()

    def _forget(self):
        self.place: dict[str, int] = {}
        self.ids, self.sizes = np.empty(0, np.uint32), np.empty(0, np.int64)

    def _learn(self, words: list[str]) -> np.ndarray:
        """Place of each word in the table of known words."""
        fresh = [w for w in words if w not in self.place]
        if len(self.place) + len(fresh) > KNOWN_WORDS:
            self._forget()
            fresh = words
        # Runs of letters, and ASCII without the apostrophe, are one word to the tokenizer: many go in one text.
        plain = [w for w in fresh if w.isalpha() or (w.isascii() and "'" not in w)]
        other = [w for w in fresh if not (w.isalpha() or (w.isascii() and "'" not in w))]
        ids, sizes, fresh = [self.ids], [self.sizes], []
        for at in range(0, len(plain), TOGETHER * CALLS):
            groups = [plain[i : i + TOGETHER] for i in range(at, min(len(plain), at + TOGETHER * CALLS), TOGETHER)]
            for group, got in zip(groups, self._encode([" ".join(g) for g in groups])):
                size = np.diff(np.flatnonzero(self.last[got]), prepend=-1)
                if len(size) != len(group):  # a piece that is not one word after all
                    other += group
                    continue
                fresh += group
                ids.append(got)
                sizes.append(size)
        for at in range(0, len(other), TOGETHER * CALLS):
            some = self._encode(other[at : at + TOGETHER * CALLS])
            ids += some
            sizes.append(np.array([len(x) for x in some], np.int64))
        fresh += other
        self.place.update(zip(fresh, range(len(self.place), len(self.place) + len(fresh))))
        self.ids, self.sizes = np.concatenate(ids), np.concatenate(sizes)
        return np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(got.ids, np.int64).astype(np.uint32)
                for got in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, each text's with the end id, and the number of ids of each text."""
        texts, ends, last = self._parts(texts, end_id)
        words, offsets = pieces(texts)
        words = words.dictionary_encode()
        known = self._learn(words.dictionary.to_pylist())
        places = known[words.indices.to_numpy(zero_copy_only=False)] if len(words) else np.empty(0, np.int64)
        # One id for each part, that of its added token or the end id, goes behind its words: a word of its own.
        own, which = np.unique(ends, return_inverse=True)
        starts = np.append(np.cumsum(self.sizes) - self.sizes, len(self.ids) + np.arange(len(own)))
        per_word, at = np.append(self.sizes, np.ones(len(own), np.int64)), len(self.sizes)
        places = np.insert(places, offsets[1:], at + which)
        sizes = per_word[places]
        after = np.cumsum(sizes)[offsets[1:] + np.arange(len(texts))][last]
        return ragged_take(np.append(self.ids, own), starts[places], sizes), np.diff(after, prepend=0)

    def _parts(self, texts: pa.Array, end_id: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Texts cut at their added tokens, the id behind each part, and the place of each text's last part."""
        found = pc.match_substring_regex(texts, self.cuts) if self.cuts else None
        if found is None or not pc.any(found).as_py():
            return texts, np.full(len(texts), end_id, np.uint32), np.arange(len(texts))
        parts, ends, last = [], [], []
        for text, has in zip(texts.to_pylist(), found.to_pylist()):
            split = re.split(f"({self.cuts})", text) if has else [text]
            parts += split[::2]
            ends += [*(self.added[token] for token in split[1::2]), end_id]
            last.append(len(parts) - 1)
        return pa.array(parts, pa.large_string()), np.array(ends, np.uint32), np.array(last)


def encode_rows(docs: DataFrame, tokenizer_json: str, end_id: int, pack) -> DataFrame:
    """(doc_id, n_tokens, payload) of every row; ``pack()`` gives a function from ids to payload bytes."""
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json)  # a vocabulary file: fixed size

    def run(batches):
        encoder, to_bytes = WordEncoder(shared.value), pack()
        for batch in batches:
            for part in slices(batch):
                ids, sizes = encoder.encode(plain_text(part), end_id)
                payload = [to_bytes(x) for x in np.split(ids, np.cumsum(sizes)[:-1])]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sizes), pa.array(payload, pa.binary())],
                                                 names=["doc_id", "n_tokens", "payload"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, payload binary")


def train_dictionary(docs: DataFrame, tokenizer_json: str, end_id: int, width: str) -> bytes:
    """Fit the shared dictionary on a bounded sample; empty where there is too little to fit on."""
    import zstandard

    n_rows = docs.count()
    every = max(1, n_rows // DICT_DOCS)
    some = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0).limit(2 * DICT_DOCS)
    rows = encode_rows(some, tokenizer_json, end_id, lambda: lambda ids: ids[:DICT_IDS].astype(width).tobytes()).collect()
    samples = [bytes(r.payload) for r in rows]
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def _dictionary(raw: bytes):
    import zstandard

    return zstandard.ZstdCompressionDict(raw) if raw else None


def _file_system(path: str):
    """File system and path of a folder given as URI or plain path."""
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    path = path.replace("s3a://", "s3://", 1)
    return fs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1))


def write(docs: DataFrame, path: str, tokenizer_json: str, end_id: int, vocabulary: int) -> DataFrame:
    """Write all documents below ``path``; returns the manifest, one row per file."""
    spark = docs.sparkSession
    width = "<u2" if vocabulary <= 1 << 16 else "<u4"
    dictionary = train_dictionary(docs, tokenizer_json, end_id, width)
    shared = spark.sparkContext.broadcast(dictionary)  # at most DICT_BYTES

    def compressor():
        import zstandard

        pack = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(shared.value)).compress
        return lambda ids: pack(ids.astype(width).tobytes())

    rows = stage(encode_rows(docs, tokenizer_json, end_id, compressor)
                 .withColumn("seq", F.monotonically_increasing_id()), "token_rows")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, "doc_id", "seq").sortWithinPartitions("doc_id", "seq")

    def put(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        fs, folder = _file_system(path)
        out, own, index, at, start = None, "", [], 0, 0
        for batch in batches:
            if out is None and batch.num_rows:
                fs.create_dir(folder, recursive=True)
                own = f"{folder}/.part-{part:06d}-{uuid.uuid4().hex}"
                out = fs.open_output_stream(own)
                at = out.write(MAGIC + hashlib.sha256(shared.value).digest() + bytes([int(width[-1])]))
            ids, tokens = batch.column("doc_id").to_pylist(), batch.column("n_tokens").to_pylist()
            entries = np.zeros(batch.num_rows, ENTRY)
            for i, payload in enumerate(batch.column("payload")):
                raw = payload.as_py()
                out.write(raw)
                entries[i] = (ids[i] or 0, ids[i] is not None, tokens[i], start, at, len(raw))
                at, start = at + len(raw), start + tokens[i]
            index.append(entries)
        if out is None:
            return
        table = np.concatenate(index)
        out.write(table.tobytes() + len(table).to_bytes(8, "little") + at.to_bytes(8, "little") + MAGIC)
        out.close()
        name = f"part-{part:06d}.ids"
        fs.move(own, f"{folder}/{name}")
        yield pa.RecordBatch.from_pylist([{"part": part, "file": name, "n_docs": len(table), "n_tokens": start}],
                                         schema=pa.schema([("part", pa.int32()), ("file", pa.string()),
                                                           ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))

    manifest = stage(ordered.mapInArrow(put, "part int, file string, n_docs long, n_tokens long"), "token_manifest")
    fs, folder = _file_system(path)
    fs.create_dir(folder, recursive=True)
    with fs.open_output_stream(f"{folder}/dictionary.zst") as out:
        out.write(dictionary)
    return manifest


class TokenFile:
    """One file: its index, and any document through its offset."""

    def __init__(self, fs, folder: str, name: str):
        import zstandard

        with fs.open_input_stream(f"{folder}/dictionary.zst") as f:
            raw = f.read()
        self.file = fs.open_input_file(f"{folder}/{name}")
        size = self.file.size()
        tail = self.file.read_at(24, size - 24)
        n, at = int.from_bytes(tail[:8], "little"), int.from_bytes(tail[8:16], "little")
        head = self.file.read_at(len(MAGIC) + 33, 0)
        if head[:8] != MAGIC or tail[16:] != MAGIC:
            raise ValueError(f"{name} is no whole token file")
        if head[8:40] != hashlib.sha256(raw).digest():
            raise ValueError(f"{name} was written with another dictionary")
        self.width = f"<u{head[40]}"
        self.index = np.frombuffer(self.file.read_at(n * ENTRY.itemsize, at), ENTRY)
        self.unpack = zstandard.ZstdDecompressor(dict_data=_dictionary(raw)).decompress

    def ids(self, i: int) -> np.ndarray:
        e = self.index[i]
        return np.frombuffer(self.unpack(self.file.read_at(int(e["length"]), int(e["offset"]))), self.width)

    def find(self, doc_id: int) -> int | None:
        """Place of a document: the index is in doc_id order, those without one first."""
        skip = int((self.index["has_id"] == 0).sum())
        at = skip + int(np.searchsorted(self.index["doc_id"][skip:], doc_id))
        return at if at < len(self.index) and self.index["doc_id"][at] == doc_id else None


def document(path: str, name: str, doc_id: int) -> np.ndarray | None:
    """Ids of one document of a file, read through the offset index without its neighbours."""
    file = TokenFile(*_file_system(path), name)
    at = file.find(doc_id)
    return None if at is None else file.ids(at)


def read_back(spark: SparkSession, path: str, manifest: DataFrame, schema: str, row) -> DataFrame:
    """One row per document from the files; ``row(ids)`` gives the values of ``schema`` after the fixed columns.

    Fixed columns: doc_id, start (ids of all documents before it), n_tokens.
    """
    base = F.coalesce(F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = manifest.select("part", "file", base.alias("base"))  # one row per file
    full = spark.createDataFrame([], f"doc_id long, start long, n_tokens long, {schema}").schema
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(full)

    def get(batches):
        fs, folder = _file_system(path)
        for batch in batches:
            for name, first in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist()):
                file = TokenFile(fs, folder, name)
                for at in range(0, len(file.index), 1024):
                    part = file.index[at : at + 1024]
                    values = [row(file.ids(i)) for i in range(at, at + len(part))]
                    cols = [pa.array(part["doc_id"], mask=part["has_id"] == 0),
                            pa.array(part["start"].astype(np.int64) + first), pa.array(part["n_tokens"].astype(np.int64))]
                    cols += [pa.array(list(v), arrow.field(3 + k).type) for k, v in enumerate(zip(*values))]
                    yield pa.RecordBatch.from_arrays(cols, schema=arrow)

    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return files.repartition(n, "part").mapInArrow(get, full)


def crc32_of(ids: np.ndarray) -> tuple[int]:
    return (zlib.crc32(ids.astype("<u4").tobytes()),)
