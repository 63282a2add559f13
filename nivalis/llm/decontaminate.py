"""Benchmark decontamination with a generalised suffix automaton.

The normalised words of the benchmark items are built into one automaton over
word numbers.  A document's words stream through it; at every word the state
says how long a suffix of the document, ending there, occurs in the items.  A
length of ``window`` words (or a whole item, where the item is shorter) is a
hit: its words are marked, and the state tells which items hold it.

Only chains of words whose neighbours also are neighbours in some item can hold
a hit longer than one word, so a batch is first cut to those chains with array
operations and the automaton walks these alone.

The benchmark is taken in blocks of ``BLOCK_WORDS`` words (items of more words
are cut with an overlap of window - 1, which loses no window); each block's
automaton is broadcast, so its size is bounded, and documents pass all blocks.

Defined cases: null texts have no words and no hits; items without words and
null item texts have no window, a null item_id is the empty string; repeated
items count once; repeated documents are judged alike; an empty benchmark hits
nothing; other columns, whatever their names, are carried along untouched.
"""

from __future__ import annotations

import re
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ALNUM, plain_text, slices, split_alnum, stage

WINDOW = 13
BLOCK_WORDS = 50_000
#: A document is contaminated when one word in this many is hit.
COVERAGE = 20
HITS = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("first", T.LongType()),
                                                     T.StructField("last", T.LongType())]))),
    T.StructField("items", T.ArrayType(T.StringType()))])


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(ALNUM).split()


class ItemAutomaton:
    """Suffix automaton of a set of items, each a list of words."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.names: list[str] = []
        self.length, self.link, self.next = [0], [-1], [{}]
        self.ends: list[set[int]] = [set()]  # items with a prefix that ends in the state
        self.shorts: list[dict[int, set[int]]] = [{}]  # length of a whole short item -> items
        pairs, numbers, self.least = set(), {}, window
        for name, words in items:
            if not words:
                continue
            item = numbers.setdefault(name, len(numbers))
            codes = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
            pairs.update(zip(codes, codes[1:]))
            state = 0
            for code in codes:
                state = self._extend(state, code)
                self.ends[state].add(item)
            if len(codes) < window:
                self.least = min(self.least, len(codes))
                self.shorts[state].setdefault(len(codes), set()).add(item)
        self.names = list(numbers)
        self.pairs = np.array(sorted(a << 32 | b for a, b in pairs), np.int64)
        self.children: list[list[int]] = [[] for _ in self.length]
        for state, up in enumerate(self.link):
            if up >= 0:
                self.children[up].append(state)
        # The nearest state on the way to the root, itself included, that ends a short item.
        self.short_up = [-1] * len(self.length)
        for state in sorted(range(len(self.length)), key=self.length.__getitem__):
            up = self.link[state]
            self.short_up[state] = state if self.shorts[state] else (self.short_up[up] if up >= 0 else -1)
        self.holders: dict[int, frozenset[int]] = {}

    def _state(self, length: int, link: int, edges: dict) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(edges)
        self.ends.append(set())
        self.shorts.append({})
        return len(self.length) - 1

    def _clone(self, p: int, q: int, code: int) -> int:
        copy = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        # Short items that end in q and are no longer than the copy belong to the copy now.
        for n in [n for n in self.shorts[q] if n <= self.length[copy]]:
            self.shorts[copy][n] = self.shorts[q].pop(n)
        self.link[q] = copy
        while p >= 0 and self.next[p].get(code) == q:
            self.next[p][code] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, code: int) -> int:
        if code in self.next[last]:
            q = self.next[last][code]
            return q if self.length[last] + 1 == self.length[q] else self._clone(last, q, code)
        new = self._state(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and code not in self.next[p]:
            self.next[p][code] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][code]
            self.link[new] = q if self.length[p] + 1 == self.length[q] else self._clone(p, q, code)
        return new

    def items_at(self, state: int) -> frozenset[int]:
        """Items that hold the strings of a state: those that end in it or below it."""
        if state not in self.holders:
            found, todo = set(), [state]
            while todo:
                s = todo.pop()
                found |= self.ends[s]
                todo += self.children[s]
            self.holders[state] = frozenset(found)
        return self.holders[state]

    def walk(self, codes: list[int]) -> tuple[list[tuple[int, int]], set[int]]:
        """Word ranges [first, last] of all windows in a chain, and the items that hold them."""
        state = size = 0
        ranges, items = [], set()
        for i, code in enumerate(codes):
            while state and code not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            state = self.next[state].get(code, 0)
            size = size + 1 if state else 0
            if size >= self.window:
                at = state
                while self.length[self.link[at]] >= self.window:
                    at = self.link[at]
                items |= self.items_at(at)
                ranges.append((i - self.window + 1, i))
            at = self.short_up[state]
            while at >= 0:
                for n, whole in self.shorts[at].items():
                    if n <= size:
                        items |= whole
                        ranges.append((i - n + 1, i))
                at = self.short_up[self.link[at]] if self.link[at] >= 0 else -1
        return ranges, items

    def hits(self, texts: pa.Array) -> list[tuple[int, list[tuple[int, int]], set[str]]]:
        """(number of words, merged word ranges, item names) of every text."""
        words, offsets = split_alnum(texts)
        found = [(int(n), [], set()) for n in np.diff(offsets)]
        if not len(words) or not self.names:
            return found
        values = pa.array([w.decode() for w in self.vocabulary], words.type)
        codes = pc.fill_null(pc.index_in(words, value_set=values), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        linked = np.zeros(len(codes), bool)  # with the word before
        both = np.flatnonzero((codes[1:] >= 0) & (codes[:-1] >= 0))
        if len(both) and len(self.pairs):
            key = codes[both] << 32 | codes[both + 1]
            at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            linked[both[self.pairs[at] == key] + 1] = True
        starts_of_texts = offsets[:-1][offsets[:-1] < len(codes)]
        linked[starts_of_texts] = False
        starts = np.flatnonzero(~linked)
        sizes = np.diff(np.append(starts, len(codes)))
        chosen = (sizes >= self.least) & (codes[starts] >= 0)
        texts_of = np.searchsorted(offsets, starts[chosen], side="right") - 1
        for start, size, text in zip(starts[chosen].tolist(), sizes[chosen].tolist(), texts_of.tolist()):
            ranges, items = self.walk(codes[start : start + size].tolist())
            if ranges:
                first = start - int(offsets[text])
                found[text][1].extend((first + a, first + b) for a, b in ranges)
                found[text][2].update(self.names[i] for i in items)
        return [(n, merge(ranges), items) for n, ranges, items in found]


def merge(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def blocks_of(benchmark: DataFrame, window: int, most: int):
    """Blocks of at most ``most`` item words (and one cut item); the driver holds one at a time."""
    block, n = [], 0
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text")
    for row in rows.toLocalIterator():
        words = words_of(row.text)
        step = most if len(words) > most else max(1, len(words))
        for at in range(0, max(1, len(words) - window + 1) if len(words) > most else 1, step):
            part = words[at : at + step + window - 1] if len(words) > most else words
            block.append((row.item_id, part))
            n += len(part)
            if n >= most:
                yield block
                block, n = [], 0
    if block:
        yield block


def scan(docs: DataFrame, benchmark: DataFrame, mark: str, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Add the column ``mark`` (n_words, spans of hit words, sorted item ids) to the documents."""
    docs = docs.withColumn(mark, F.lit(None).cast(HITS))
    schema, keep = docs.schema, [c for c in docs.columns if c != mark]
    from pyspark.sql.pandas.types import to_arrow_type
    kind = to_arrow_type(HITS)

    def run_with(shared):
        def run(batches):
            automaton = ItemAutomaton(shared.value, window)
            for batch in batches:
                for part in slices(batch):
                    old = part.column(mark).to_pylist()
                    rows = []
                    for was, (n, spans, items) in zip(old, automaton.hits(plain_text(part)), strict=True):
                        if was:
                            spans = merge(spans + [(s["first"], s["last"]) for s in was["spans"]])
                            items = items | set(was["items"])
                        rows.append({"n_words": n, "spans": [{"first": a, "last": b} for a, b in spans], "items": sorted(items)})
                    yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], pa.array(rows, kind)],
                                                     names=[*keep, mark])
        return run

    passes = 0
    for block in blocks_of(benchmark, window, block_words):
        if passes:
            docs = stage(docs, "decontaminated")
        docs = docs.mapInArrow(run_with(docs.sparkSession.sparkContext.broadcast(block)), schema)
        passes += 1
    if not passes:
        docs = docs.mapInArrow(run_with(docs.sparkSession.sparkContext.broadcast([])), schema)
    return docs


def n_hit(mark: Column) -> Column:
    return F.aggregate(mark["spans"], F.lit(0).cast("long"), lambda acc, s: acc + s["last"] - s["first"] + 1)


def contaminated(mark: Column, coverage: int = COVERAGE) -> Column:
    return (n_hit(mark) > 0) & (n_hit(mark) * coverage >= mark["n_words"])


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, coverage: int = COVERAGE) -> DataFrame:
    """Documents whose hit words stay under the coverage limit, with all their columns, texts as they were."""
    mark = f"hits_{uuid.uuid4().hex[:8]}"
    return scan(docs, benchmark, mark).filter(~contaminated(F.col(mark), coverage)).drop(mark)


def remove_spans(docs: DataFrame, benchmark: DataFrame, longest: int = WINDOW, coverage: int = COVERAGE) -> DataFrame:
    """Cut hit spans of at least ``longest`` words, from their first word to the end of their last.

    Documents over the coverage limit go whole; all other text stays as it is.
    """
    mark = f"hits_{uuid.uuid4().hex[:8]}"
    kept = scan(docs, benchmark, mark).filter(~contaminated(F.col(mark), coverage))
    word = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

    def cut(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for i, hits in enumerate(batch.column(mark).to_pylist()):
                spans = [s for s in hits["spans"] if s["last"] - s["first"] + 1 >= longest]
                if spans:
                    raw = texts[i].encode()
                    at = [m.span() for m in word.finditer(raw)]
                    for s in reversed(spans):
                        raw = raw[: at[s["first"]][0]] + raw[at[s["last"]][1]:]
                    texts[i] = raw.decode()
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return kept.mapInArrow(cut, kept.schema).drop(mark)


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document."""
    hits = F.col("hits")
    return scan(docs.select("doc_id", "text"), benchmark, "hits").select(
        "doc_id", hits["n_words"].alias("n_words"), n_hit(hits).alias("n_hit"),
        F.size(hits["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(hits["items"], ","), 256).alias("items_sha256"),
        contaminated(hits).alias("contaminated"))
