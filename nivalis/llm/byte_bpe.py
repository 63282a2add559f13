"""Byte-level BPE as a monoid: encode halves, join neighbours, decode by concatenation.

A text is halved until a leaf is at most ``LEAF`` characters, a line or two; leaves are
encoded by the tiktoken library.  Two neighbours are joined by re-encoding one window
around their border: it grows left and right from ``window`` characters to the nearest
*sure* cuts.  A sure cut is a place where the
pattern ends a match whatever comes before it: after a letter or a digit when a
character of another class follows, or before white space that follows
something else.  The pattern looks back nowhere and looks ahead one character,
and only inside white space, so matches left and right of sure cuts cannot
change and their tokens are provably stable; where there is no sure cut the
window is all of that part.  Joining is associative, so any tree gives
the encoding of the whole text.

Defined cases: null texts are empty and have no tokens; repeated rows are
encoded alike; texts of any length are exact (a run without a sure cut is
re-encoded as a whole); other columns are carried along.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import plain_text, slices

LEAF = 128
WINDOW = 1
#: A place where a match ends whatever comes before it.
SURE = r"(?:(?<=\p{L})(?=\P{L})|(?<=\p{N})(?=\P{N})|(?<=\S)(?=\s))"


class BytePairMonoid:
    """Elements are (text, tokens); ``join`` is the product, the empty text the unit."""

    def __init__(self, ranks_file: bytes, pattern: str, leaf: int = LEAF, window: int = WINDOW):
        import regex
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks_file.splitlines() if line)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.leaf, self.window = leaf, window
        self.first_sure = regex.compile(SURE).search
        self.last_sure = regex.compile("(?r)" + SURE).search

    def encode(self, text: str) -> list[int]:
        if len(text) <= self.leaf:
            return self.encoding.encode_ordinary(text)
        half = len(text) // 2
        left, right = text[:half], text[half:]
        return self.join(left, self.encode(left), right, self.encode(right))

    def join(self, left: str, a: list[int], right: str, b: list[int]) -> list[int]:
        p, q = self._cut_left(left), self._cut_right(right)
        middle = self.encoding.encode_ordinary(left[p:] + right[:q])
        return a[: len(a) - self._tokens(reversed(a), left[p:])] + middle + b[self._tokens(b, right[:q]):]

    def _cut_left(self, text: str) -> int:
        """The last sure cut at least a window before the end, or 0."""
        hit = self.last_sure(text, 0, len(text) - self.window + 1) if len(text) > self.window else None
        return hit.start() if hit else 0

    def _cut_right(self, text: str) -> int:
        """The first sure cut at least a window after the start, or the end."""
        hit = self.first_sure(text, self.window) if len(text) > self.window else None
        return hit.start() if hit else len(text)

    def _tokens(self, tokens, text: str) -> int:
        """How many tokens, in the order given, make up ``text`` (a sure cut is a token border)."""
        left, n = len(text.encode()), 0
        for token in tokens:
            if left <= 0:
                break
            left -= len(self.bytes_of[token])
            n += 1
        if left:
            raise ValueError("a sure cut is no token border: the pattern is not one this join knows")
        return n

    def decode(self, tokens) -> bytes:
        if len(tokens) <= self.leaf:
            return b"".join(map(self.bytes_of.__getitem__, tokens))
        half = len(tokens) // 2
        return self.decode(tokens[:half]) + self.decode(tokens[half:])


def _with_field(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([f for f in df.schema.fields if f.name != name] + [T.StructField(name, kind)])


def encode(df: DataFrame, ranks_file: bytes, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Replace or add ``ids`` (array<int>) with the tokens of ``text``."""
    shared = df.sparkSession.sparkContext.broadcast(ranks_file)  # a vocabulary file: fixed size
    schema = _with_field(df, ids, T.ArrayType(T.IntegerType(), False))
    keep = [f.name for f in schema.fields[:-1]]

    def run(batches):
        monoid = BytePairMonoid(shared.value, pattern)
        for batch in batches:
            for part in slices(batch, text):
                tokens = [np.array(monoid.encode(t), np.int32) for t in plain_text(part, text).to_pylist()]
                offsets = np.concatenate(([0], np.cumsum([len(t) for t in tokens]))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(tokens)))
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], lists], names=[*keep, ids])

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, ranks_file: bytes, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Replace or add ``out`` (binary) with the bytes that ``ids`` stand for."""
    shared = df.sparkSession.sparkContext.broadcast(ranks_file)
    schema = _with_field(df, out, T.BinaryType())
    keep = [f.name for f in schema.fields[:-1]]

    def run(batches):
        monoid = BytePairMonoid(shared.value, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                raw = [monoid.decode(row.values.to_numpy(zero_copy_only=False).tolist() if row.is_valid else [])
                       for row in part.column(ids)]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], pa.array(raw, pa.binary())],
                                                 names=[*keep, out])

    return df.mapInArrow(run, schema)


def digests(df: DataFrame, ranks_file: bytes, pattern: str) -> DataFrame:
    """Encode and decode every text: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    encoded = encode(df.select("doc_id", "text"), ranks_file, pattern).select("doc_id", "ids")
    decoded = decode(encoded, ranks_file, pattern)
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                          F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))
