"""Source divergence audit by in-mapper stripes.

Tasks fold whole documents into one hash of stripes: (language, term) to the
number of documents that have the term and, per source, its occurrences.  The
stripes leave the task when the hash holds ``ENTRIES`` source counts (a spill)
or the partition ends; so a frequent term travels once per spill, not once per
occurrence.  One shuffle brings the stripes of a key together; those of terms in
at least ``least`` documents of their language are merged and kept, and every
merged stripe directly gives its part of the divergences: |p - p'| for the
pairs of sources, p - q for the sources that use the term more than their
language.  A task of this last step gets a range of about ``KEPT`` counts, so
partial sums of pairs are few beside the counts they come from.

A share p is 1 + floor(10^9 (count + 5) / (N + 5 V)), as a long division in
whole numbers.  Sources of a language are compared in blocks of ``BLOCK``, so a
task holds a matrix of BLOCK x BLOCK sums and a slab of terms at a time.

The table of sources (a row per language and source) is sent to the tasks in
slices of languages of about ``SOURCES`` rows: one slice in the usual case, one
plan for each beyond.  A single language stays whole, as its pairs, which the
result lists, are the square of its sources.

Defined cases: null text, language or source is the empty text; a language
without kept terms has pairs of value 0 and no terms; a language of one source
has no pairs; equal values rank by the item's bytes; rows that repeat are
documents of their own; an empty table gives an empty result; other columns
play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import _words, give_back, plain_text, raw_text, slices, stage

#: Byte map of the terms: A-Z to lower case, every other ASCII byte but a-z to a space.
LETTERS = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))
#: Source counts in a task's hash before it spills (about 100 bytes each), and in one task over the merged stripes.
ENTRIES = 800_000
KEPT = 100_000
#: Rows of the source table in one slice, and sources in one block of the pair matrix.
SOURCES = 500_000
BLOCK = 256
#: Numbers in a slab of terms (terms x sources of a block).
SLAB = 1 << 20
UNIT = 1_000_000_000
PRIOR = 5

STRIPE = "lang string, term string, df long, sources array<string>, counts array<long>"
FOUND = "lang string, source string, part string, item string, value long"


def split_letters(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Terms ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` with A-Z in lower case, and each text's offsets in them."""
    borders, data = raw_text(texts)
    plain = pa.py_buffer(data.tobytes().translate(LETTERS))
    return _words(pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(borders), plain, null_count=0))


def stripe_batch(stripes: dict) -> pa.RecordBatch:
    keys = list(stripes)
    offsets = np.zeros(len(keys) + 1, np.int32)
    np.cumsum([len(stripes[k][1]) for k in keys], out=offsets[1:])
    lists = [(s, n) for k in keys for s, n in stripes[k][1].items()]
    at = pa.array(offsets)
    return pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
         pa.array([stripes[k][0] for k in keys], pa.int64()),
         pa.ListArray.from_arrays(at, pa.array([s for s, _ in lists], pa.string())),
         pa.ListArray.from_arrays(at, pa.array([n for _, n in lists], pa.int64()))],
        names=["lang", "term", "df", "sources", "counts"])


def numbered(column: pa.Array, known: dict[str, int]) -> np.ndarray:
    """Numbers of a text column's values (null as the empty text); new values are added to ``known``."""
    coded = pc.dictionary_encode(pc.fill_null(column.cast(pa.string()), ""))
    own = np.array([known.setdefault(v, len(known)) for v in coded.dictionary.to_pylist()], np.int64)
    return own[coded.indices.to_numpy(zero_copy_only=False)] if len(own) else np.zeros(len(column), np.int64)


def counted(part: pa.RecordBatch, langs: dict[str, int], sources: dict[str, int]) -> pa.Table | None:
    """Distinct (language, term, source) of a slice with their documents and occurrences."""
    words, offsets = split_letters(plain_text(part))
    if not len(words):
        return None
    coded = pc.dictionary_encode(words)
    term, n_terms = coded.indices.to_numpy().astype(np.int64), len(coded.dictionary)
    own = numbered(part.column("lang"), langs) * (1 << 31) + numbered(part.column("source"), sources)
    places, group = np.unique(own, return_inverse=True)
    doc = np.repeat(np.arange(part.num_rows), np.diff(offsets))
    # One row per (document, term) first, then one per (language and source, term).
    once, times = np.unique(doc * n_terms + term, return_counts=True)
    key = group[once // n_terms] * n_terms + once % n_terms
    by = np.argsort(key, kind="stable")
    starts = np.flatnonzero(np.diff(key[by], prepend=-1))
    where, what = np.divmod(key[by][starts], n_terms)
    return pa.table({"lang": (places >> 31)[where], "term": coded.dictionary.take(pa.array(what)),
                     "source": (places & ((1 << 31) - 1))[where], "df": np.diff(starts, append=len(by)),
                     "n": np.add.reduceat(times[by], starts)})


def combined(tables: list[pa.Table]) -> pa.Table:
    sums = (pa.concat_tables(tables).group_by(["lang", "term", "source"], use_threads=False)
            .aggregate([("df", "sum"), ("n", "sum")]))
    return sums.rename_columns(["lang", "term", "source", "df", "n"])


def fold_documents(batches):
    """In-mapper combining: stripes of all documents of a partition, spilled when the hash is full."""
    langs: dict[str, int] = {}
    sources: dict[str, int] = {}
    held: list[pa.Table] = []

    def spill(table):
        rows = table.group_by(["lang", "term"], use_threads=False).aggregate([("df", "sum"), ("source", "list"), ("n", "list")])
        rows = rows.rename_columns(["lang", "term", "df", "sources", "counts"]).combine_chunks()
        names = [pa.array(list(x), pa.string()) for x in (langs, sources)]
        for batch in rows.to_batches(max_chunksize=50_000):
            lists, counts = batch.column("sources"), batch.column("counts")
            at = pa.array(lists.offsets.to_numpy() - lists.offsets[0].as_py(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [names[0].take(batch.column("lang")), batch.column("term").cast(pa.string()), batch.column("df"),
                 pa.ListArray.from_arrays(at, names[1].take(lists.flatten())), pa.ListArray.from_arrays(at, counts.flatten())],
                names=["lang", "term", "df", "sources", "counts"])

    for batch in batches:
        for part in slices(batch):
            table = counted(part, langs, sources)
            if table is None:
                continue
            held.append(table)
            if sum(t.num_rows for t in held) >= ENTRIES:
                held = [combined(held)]
                if held[0].num_rows >= ENTRIES // 2:  # combining no longer frees much
                    yield from spill(held.pop())
                    give_back()
    if held:
        yield from spill(combined(held))


def merge_sorted(batches):
    """Merge neighbouring stripes of equal key (rows come sorted)."""
    key, df, counts, ready, held = None, 0, {}, {}, 0
    for batch in batches:
        for lang, term, d, sources, ns in zip(*[c.to_pylist() for c in batch.columns]):
            if key != (lang, term):
                if key is not None:
                    ready[key] = (df, counts)
                    held += len(counts)
                key, df, counts = (lang, term), 0, {}
                if held >= KEPT:
                    yield stripe_batch(ready)
                    ready, held = {}, 0
            df += d
            for source, n in zip(sources, ns):
                counts[source] = counts.get(source, 0) + n
    if key is not None:
        ready[key] = (df, counts)
        yield stripe_batch(ready)


def stripes(docs: DataFrame, least: int) -> DataFrame:
    """Merged stripes of the terms that at least ``least`` documents of their language have."""
    folded = stage(docs.select("text", "lang", "source").mapInArrow(fold_documents, STRIPE), "audit_stripes")
    # The window sorts each partition by key, so equal keys come to the merge as neighbours.
    whole = F.sum("df").over(Window.partitionBy("lang", "term"))
    merged = (folded.withColumn("all_df", whole).filter(F.col("all_df") >= least).drop("all_df")
              .sortWithinPartitions("lang", "term").mapInArrow(merge_sorted, STRIPE))
    return stage(merged, "audit_merged")


def share(count, total):
    """1 + floor(10^9 count / total), both whole and count <= total < 9 * 10^15, by long division in steps of 1000."""
    whole, rest = np.divmod(count, total)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, total)
        whole = whole * 1000 + digit
    return 1 + whole


def slab_shares(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    return share(counts + PRIOR, totals[None, :])


def diverge(groups: dict, top: int):
    """Divergences of one partition's stripes.

    ``groups``: language to (sources in byte order, N + 5 V of each, that of the language).
    """
    def pairs_of(lang, at, source, count, n_terms):
        """Sums of |p - p'| over the partition's terms of one language, block by block of sources."""
        sources, totals, _ = groups[lang]
        totals = np.asarray(totals, np.int64)
        step = max(1, SLAB // BLOCK)
        for i in range(0, len(sources), BLOCK):
            for j in range(i, len(sources), BLOCK):
                a, b = slice(i, min(i + BLOCK, len(sources))), slice(j, min(j + BLOCK, len(sources)))
                sums = np.zeros((a.stop - a.start, b.stop - b.start), np.int64)
                for t in range(0, n_terms, step):
                    lo, hi = np.searchsorted(at, [t, t + step])
                    p = [dense(at[lo:hi] - t, source[lo:hi], count[lo:hi], min(step, n_terms - t), s, totals) for s in (a, b)]
                    for k in range(sums.shape[0]):
                        sums[k] += np.abs(p[0][:, k : k + 1] - p[1]).sum(axis=0)
                yield from emitted(lang, sources, a, b, sums)

    def dense(at, source, count, n, block, totals):
        out = np.zeros((n, block.stop - block.start), np.int64)
        mine = (source >= block.start) & (source < block.stop)
        out[at[mine], source[mine] - block.start] = count[mine]
        return slab_shares(out, totals[block])

    def emitted(lang, sources, a, b, sums):
        for k in range(sums.shape[0]):
            for m in range(sums.shape[1]):
                g, h = a.start + k, b.start + m
                if g < h:
                    yield lang, sources[g], "pair", sources[h], int(sums[k, m])
                    yield lang, sources[h], "pair", sources[g], int(sums[k, m])

    def terms_of(lang, terms, at, source, count):
        """The ``top`` terms of every source by p - q, of this partition; ``terms`` is in byte order."""
        sources, totals, whole = groups[lang]
        p = share(count + PRIOR, np.asarray(totals, np.int64)[source])
        q = share(summed(at, count, len(terms)) + PRIOR, np.int64(whole))
        value = p - q[at]
        use = value > 0
        at, source, value = at[use], source[use], value[use]
        by = np.lexsort((at, -value, source))
        first = np.flatnonzero(np.diff(source[by], prepend=-1))
        place = np.arange(len(by)) - np.repeat(first, np.diff(first, append=len(by)))
        for x in by[place < top]:
            yield lang, sources[source[x]], "term", terms[at[x]], int(value[x])

    def summed(at, count, n):
        out = np.zeros(n, np.int64)
        np.add.at(out, at, count)
        return out

    def of_language(lang, terms, rows):
        by = sorted(range(len(terms)), key=terms.__getitem__)
        terms, rows = [terms[i] for i in by], [rows[i] for i in by]
        number = {s: i for i, s in enumerate(groups[lang][0])}
        at = np.repeat(np.arange(len(terms)), [len(s) for s, _ in rows])
        source = np.array([number[s] for ss, _ in rows for s in ss], np.int64)
        count = np.array([c for _, cs in rows for c in cs], np.int64)
        yield from pairs_of(lang, at, source, count, len(terms))
        yield from terms_of(lang, terms, at, source, count)

    def packed(rows):
        names = ["lang", "source", "part", "item", "value"]
        held = []
        for row in rows:
            held.append(row)
            if len(held) == 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*held)], names=names)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*held)], names=names)

    def run(batches):
        def languages():
            lang, terms, rows, size = None, [], [], 0
            for batch in batches:
                columns = [batch.column(c).to_pylist() for c in ("lang", "term", "sources", "counts")]
                for name, term, ss, cs in zip(*columns):
                    if name != lang or size >= KEPT:
                        if rows:
                            yield from of_language(lang, terms, rows)
                        lang, terms, rows, size = name, [], [], 0
                    terms.append(term)
                    rows.append((ss, cs))
                    size += len(ss)
            if rows:
                yield from of_language(lang, terms, rows)
        yield from packed(languages())
    return run


def source_table(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, source, total (N + 5 V of the source), lang_total, n_terms (V) of every occurring source."""
    occurring = (docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"))
                 .groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n_docs")))
    used = (kept.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("x"))
            .groupBy("lang", F.col("x.sources").alias("source")).agg(F.sum("x.counts").alias("n")))
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("n_terms"), F.sum(F.aggregate(
        "counts", F.lit(0).cast("long"), lambda a, c: a + c)).alias("n_lang"))
    v = F.coalesce("n_terms", F.lit(0))
    return stage(occurring.join(used, ["lang", "source"], "left").join(langs, "lang", "left").select(
        "lang", "source", (F.coalesce("n", F.lit(0)) + PRIOR * v).alias("total"),
        (F.coalesce("n_lang", F.lit(0)) + PRIOR * v).alias("lang_total"), v.alias("n_terms")), "audit_sources")


def dealt(kept: DataFrame) -> DataFrame:
    """Merged stripes in ranges of (language, term) of about ``KEPT`` counts."""
    n = kept.agg(F.coalesce(F.sum(F.size("counts")), F.lit(0))).first()[0]
    return kept.repartitionByRange(1 + n // KEPT, "lang", "term")


def audit(docs: DataFrame, least: int = 30, top: int = 50) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value and rank of every divergence."""
    kept = stripes(docs, least)
    sources = source_table(docs, kept)
    n_slices = 1 + sources.count() // SOURCES
    found = None
    for k in range(n_slices):
        def mine(df):
            return df.filter(F.pmod(F.xxhash64("lang"), F.lit(n_slices)) == k) if n_slices > 1 else df
        groups: dict = {}
        for r in mine(sources.filter("n_terms > 0")).toLocalIterator():
            groups.setdefault(r.lang, []).append((r.source, r.total, r.lang_total))
        groups = {g: ([s for s, _, _ in sorted(x)], [t for _, t, _ in sorted(x)], x[0][2]) for g, x in groups.items()}
        rows = dealt(mine(kept)).mapInArrow(diverge(groups, top), FOUND)
        found = rows if found is None else found.unionByName(rows)
    summed = (found.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value")))
    bare = sources.filter("n_terms = 0").select("lang", "source")
    empty = (bare.join(bare.withColumnRenamed("source", "item"), "lang").filter("source <> item")
             .select("lang", "source", F.lit("pair").alias("part"), "item", F.lit(0).cast("long").alias("value")))
    place = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    ranked = stage(summed, "audit_found").unionByName(empty).withColumn("rank", place.cast("int"))
    return ranked.filter((F.col("part") == "pair") | (F.col("rank") <= top))
