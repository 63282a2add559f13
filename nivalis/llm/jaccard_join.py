"""Near-duplicate documents: exact Jaccard join of word shingles by a partitioned universe.

Sets that are equal are one node (their 64-bit content digest); of equal sets a
task shows one.  Every node shows segment signatures (``jaccard_core``): two
sets of similarity 3/4 or more always share one.  The order of the universe
puts hot shingles last; they are found over all documents (a shingle that
repeats within a scan task is counted, the counts are summed).

Buckets of nodes with one signature are cut where sizes lie too far apart, and
decided in three steps, all exact:

1. every member against the first member of its bucket (no pairs of a group are
   enumerated: members of one bucket that reach the first one are connected);
2. buckets of at most ``LARGE`` members that still hold several components: the
   pairs across components;
3. larger ones: the members of all such buckets that overlap are one group, dealt at
   random into blocks; every two blocks meet in one task, which computes
   all overlaps by matrix products and returns one link per two components.

A pair first has to pass the documents' sketches (how many elements fall in
each cell of the universe, more cells for larger sets): the sum of the cells'
differences is never more than the sets' difference, so no similar pair fails.  Those that pass are verified on the
whole sets; components come from ``components``.

Defined cases: null, empty and all-white texts have no shingles and stay alone;
texts of fewer than five words are one shingle; equal texts are linked (their
similarity is 1); the component is the smallest doc_id reached (a null doc_id
is smaller than none, and null only where all are); repeated rows and repeated
doc_ids are rows of their own; an empty table gives an empty result; other
columns play no part, and ``drop_near_duplicates`` carries them along.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WHITE_SPACE, partitions_for, plain_text, slices, stage
from .components import components
from .jaccard_core import shingle_sets, signatures, similar

#: A shingle is hot from this many counted copies; at most so many are told apart (others keep their place in the order).
HOT, HOT_MOST = 40, 2_000_000
#: Members of a bucket that are paired by a join; larger ones go to blocks of about BLOCK members.
LARGE, BLOCK = 48, 512
#: Bits of the filter that spares the sets of documents in no bucket their way.
FILTER_BITS = 1 << 23
COLUMNS = 4_096
#: Cells of a sketch of sets under CELLS * PER_CELL elements; four times as many for each four times of that.
#: Counts above 255 are 255, which only brings sketches closer.
CELLS, PER_CELL = 256, 6
#: Shingles of a task that are counted together.
COUNTED = 3_000_000
#: Shingles of the corpus for one partition of the buckets (about four tenths of them are signatures), and members of
#: buckets for one partition of what follows.
SHINGLES, MEMBERS = 1_000_000, 20_000
#: Text of one step: shingles take many times the room of their text.
STEP = 2 << 20


def _digests(sets: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Content digest of each set as a node number; 0 for the empty set."""
    import xxhash

    raw = sets.view(np.uint8)
    ends = borders * 8
    return np.array([xxhash.xxh3_64_intdigest(raw[a:b]) if b > a else 0 for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())],
                    np.uint64).view(np.int64)


def _fresh(nodes: np.ndarray, sizes: np.ndarray, seen: set) -> np.ndarray:
    """Rows whose node the task has not met before."""
    out = []
    for i, (node, size) in enumerate(zip(nodes.tolist(), sizes.tolist())):
        if size and node not in seen:
            seen.add(node)
            out.append(i)
    return np.array(out, np.int64)


def _subset(sets: np.ndarray, borders: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.diff(borders)[rows]
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return sets[np.repeat(borders[rows] - (ends - sizes), sizes) + np.arange(total)], np.concatenate(([0], ends)).astype(np.int64)


def _sketches(sets: np.ndarray, borders: np.ndarray) -> list[bytes]:
    """Counts of each set's elements by cell."""
    sizes = np.diff(borders)
    out = [b""] * len(sizes)
    cells, least = CELLS, 0
    while (sizes >= least).any():
        rows = np.flatnonzero((sizes >= least) & (sizes < cells * PER_CELL))
        own, ends = _subset(sets, borders, rows)
        row = np.repeat(np.arange(len(rows)), np.diff(ends))
        cell = (own >> np.uint64(20)).astype(np.int64) % cells
        counts = np.minimum(np.bincount(row * cells + cell, minlength=len(rows) * cells), 255).astype(np.uint8).reshape(-1, cells)
        for i, count in zip(rows.tolist(), counts):
            out[i] = count.tobytes()
        least, cells = cells * PER_CELL, cells * 4
    return out


def _apart(a: bytes, b: bytes) -> int:
    """Sum of the differences of two sketches; the finer one is folded to the cells of the other."""
    x, y = np.frombuffer(a, np.uint8).astype(np.int32), np.frombuffer(b, np.uint8).astype(np.int32)
    n = min(len(x), len(y))
    if len(x) != len(y):
        # Cells are residues, so a residue's finer ones add up to it; a capped count only brings them closer if both are capped.
        x, y = (np.minimum(z.reshape(-1, n).sum(0), 255) for z in (x, y))
    return int(np.abs(x - y).sum())


def describe(docs: DataFrame) -> DataFrame:
    """kind 0: (doc_id, id_hash, text_hash, node, n, sketch) of every row; kind 1: (shingle as node, copies as n) of those that a task repeats."""
    def run(batches):
        seen: set[int] = set()
        names = ["kind", "doc_id", "id_hash", "text_hash", "node", "n", "sketch"]
        counted: list[np.ndarray] = []

        def repeated():
            values, n = np.unique(np.concatenate(counted) if counted else np.empty(0, np.uint64), return_counts=True)
            values, n = values[n > 1].view(np.int64), n[n > 1]
            counted.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(np.ones(len(n), np.int32)), *[pa.nulls(len(n), pa.int64())] * 3, pa.array(values), pa.array(n),
                 pa.nulls(len(n), pa.binary())], names=names)

        for batch in batches:
            for part in slices(batch, most=STEP):
                sets, borders = shingle_sets(plain_text(part))
                nodes, sizes = _digests(sets, borders), np.diff(borders)
                counted.append(_subset(sets, borders, _fresh(nodes, sizes, seen))[0])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.zeros(len(nodes), np.int32)), part.column("doc_id"), part.column("id_hash"), part.column("text_hash"),
                     pa.array(nodes), pa.array(sizes), pa.array(_sketches(sets, borders), pa.binary())], names=names)
                if sum(map(len, counted)) > COUNTED:
                    yield repeated()
        yield repeated()

    rows = docs.select("doc_id", "text", F.xxhash64("doc_id").alias("id_hash"), F.xxhash64("text").alias("text_hash"))
    return stage(rows.mapInArrow(run, "kind int, doc_id long, id_hash long, text_hash long, node long, n long, sketch binary"),
                 "near_nodes")


def hot_shingles(described: DataFrame) -> np.ndarray:
    rows = (described.filter("kind = 1").groupBy("node").agg(F.sum("n").alias("n")).filter(F.col("n") >= HOT)
            .orderBy(F.desc("n"), "node").limit(HOT_MOST).select("node").toArrow())
    return np.sort(rows.column("node").to_numpy().view(np.uint64))


def shown(docs: DataFrame, hot: np.ndarray) -> DataFrame:
    """(sig, node, n) of every distinct set of a task."""
    shared = docs.sparkSession.sparkContext.broadcast(hot)  # at most HOT_MOST numbers

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            for part in slices(batch, most=STEP):
                sets, borders = shingle_sets(plain_text(part))
                nodes = _digests(sets, borders)
                rows = _fresh(nodes, np.diff(borders), seen)
                doc, sig = signatures(*_subset(sets, borders, rows), shared.value)
                yield pa.RecordBatch.from_arrays([pa.array(sig), pa.array(nodes[rows][doc]), pa.array(np.diff(borders)[rows][doc])],
                                                 names=["sig", "node", "n"])

    return docs.select("text").mapInArrow(run, "sig long, node long, n long")


def buckets(rows: DataFrame, shingles: int) -> DataFrame:
    """(bucket, node, n, first, first_n, pair): runs of one signature and neighbouring sizes with two nodes or more.

    ``pair`` marks what is known to be a bucket of two, which its one comparison decides.
    """
    parts = min(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1 + shingles // SHINGLES)
    ordered = rows.repartition(parts, "sig").sortWithinPartitions("sig", "n", "node")

    def run(batches):
        last = None  # the run that may go on: signature, last node and size, first node and size, whether it was told
        for batch in batches:
            sig, node, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("sig", "node", "n"))
            if not len(sig):
                continue
            if last:  # the open run's last row and first row go before the batch
                sig, node, n = (np.concatenate(([v], c)) for v, c in zip(last[:3], (sig, node, n)))
            same = np.zeros(len(sig), bool)
            same[1:] = (sig[1:] == sig[:-1]) & (4 * n[:-1] >= 3 * n[1:])
            new_node = np.ones(len(sig), bool)
            new_node[1:] = ~((sig[1:] == sig[:-1]) & (node[1:] == node[:-1]))
            keep = new_node
            starts = np.flatnonzero(~same)
            of = np.cumsum(~same) - 1
            first, first_n = node[starts][of], n[starts][of]
            if last:
                first[of == 0], first_n[of == 0] = last[3], last[4]
            distinct = np.bincount(of, keep, minlength=len(starts))
            told = np.zeros(len(starts), bool)
            if last and last[5]:
                told[0] = True
            out = keep & ((distinct[of] > 1) | told[of])
            if last and last[5]:
                out[0] = False
            pair = distinct[of] == 2
            pair &= (of > 0) & (of < len(starts) - 1)  # the first and last run of a batch may have more members
            if out.any():
                # The bucket's name: its signature and where its sizes start.
                yield pa.RecordBatch.from_arrays([pa.array(sig[out]), pa.array(node[out]), pa.array(n[out]), pa.array(first[out]),
                                                  pa.array(first_n[out]), pa.array(pair[out])], names=["sig", "node", "n", "first", "first_n", "pair"])
            last = (sig[-1], node[-1], n[-1], first[-1], first_n[-1], bool(told[of[-1]] or distinct[of[-1]] > 1))

    return stage(ordered.mapInArrow(run, "sig long, node long, n long, first long, first_n long, pair boolean")
                 .select(F.xxhash64("sig", "first", "first_n").alias("bucket"), "node", "n", "first", "first_n", "pair"), "near_buckets")


def _bits(numbers: DataFrame, name: str) -> np.ndarray:
    """Filter of FILTER_BITS bits in which the bit of every number is set (of fixed size, built by an aggregation)."""
    rows = (numbers.select(F.expr(f"cast(pmod({name}, {FILTER_BITS}) div 32 as int)").alias("word"),
                           F.expr(f"shiftleft(1L, cast(pmod({name}, 32) as int))").alias("bit"))
            .groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow())
    words = np.zeros(FILTER_BITS // 32, np.uint32)
    words[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().astype(np.uint32)
    return words


def sets_of(docs: DataFrame, rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, set) of at least the given nodes.

    Their shingles are made again from one document of each, which is cheaper
    than keeping all sets; a filter on the ids spares the other documents (but
    for some that share a bit).  A node may come twice where a doc_id repeats.
    """
    ids = rows.join(nodes, "node", "left_semi").groupBy("node").agg(F.min("id_hash").alias("id_hash"))
    shared = docs.sparkSession.sparkContext.broadcast(_bits(ids, "id_hash"))

    def run(batches):
        seen: set[int] = set()
        words = shared.value
        for batch in batches:
            bit = batch.column("id_hash").to_numpy(zero_copy_only=False) % FILTER_BITS
            batch = batch.filter(pa.array(((words[bit // 32] >> (bit % 32).astype(np.uint32)) & 1).astype(bool)))
            for part in slices(batch, most=STEP):
                sets, borders = shingle_sets(plain_text(part))
                nodes = _digests(sets, borders)
                rows = _fresh(nodes, np.diff(borders), seen)
                raw = sets.view(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes[rows]), pa.array([raw[borders[i] * 8 : borders[i + 1] * 8].tobytes() for i in rows], pa.binary())],
                    names=["node", "set"])

    found = docs.select("text", F.xxhash64("doc_id").alias("id_hash")).mapInArrow(run, "node long, set binary")
    return stage(found, "near_sets")


def sketched(pairs: DataFrame, sketches: DataFrame, files: int) -> DataFrame:
    """The pairs (a, b) that their sketches allow to be similar."""
    both = pairs
    for side in ("a", "b"):
        both = both.join(sketches.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"),
                                         F.col("sketch").alias(f"sketch_{side}")), side)

    def run(batches):
        for batch in batches:
            n = sum(batch.column(f"n_{s}").to_numpy(zero_copy_only=False) for s in ("a", "b")).tolist()
            ok = [7 * _apart(x.as_py(), y.as_py()) <= m for x, y, m in zip(batch.column("sketch_a"), batch.column("sketch_b"), n)]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return stage(both.select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b").coalesce(files).mapInArrow(run, "a long, b long"), "near_pairs")


def ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()


def verify(pairs: DataFrame, sets: DataFrame, files: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar."""
    both = (pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("set_a")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("set").alias("set_b")), "b"))

    def run(batches):
        for batch in batches:
            ok = [similar(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64))
                  for x, y in zip(batch.column("set_a"), batch.column("set_b"))]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return stage(both.select("a", "b", "set_a", "set_b").coalesce(files).mapInArrow(run, "a long, b long"), "near_links")


def overlap(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections between two lists of sets, by products of bounded incidence matrices."""
    flat = np.concatenate([*a, *b])
    values, code, n = np.unique(flat, return_inverse=True, return_counts=True)
    shared = np.cumsum(n > 1) - 1  # columns only for elements that occur twice
    row = np.repeat(np.arange(len(a) + len(b)), [len(x) for x in [*a, *b]])
    use = n[code] > 1
    row, column = row[use], shared[code[use]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(a), len(b)), np.float32)
    for at in range(0, int((n > 1).sum()), COLUMNS):
        lo, hi = np.searchsorted(column, [at, at + COLUMNS])
        x = np.zeros((len(a) + len(b), COLUMNS), np.float32)
        x[row[lo:hi], column[lo:hi] - at] = 1
        out += x[: len(a)] @ x[len(a):].T
    return out.astype(np.int64)


def block_links(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Links across components among (group, node, component): one per two components and block pair."""
    counts = members.groupBy("group").agg(F.count(F.lit(1)).alias("members"))
    n_blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    placed = (members.join(counts, "group").withColumn("blocks", n_blocks)
              .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("group", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "node", "component"))

    def run(table: pa.Table) -> pa.Table:
        lo, hi = table.column("lo")[0].as_py(), table.column("hi")[0].as_py()
        block = table.column("block").to_numpy()
        node, comp = table.column("node").to_numpy(), table.column("component").to_numpy()
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("set")]
        first, second = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
        links = {}
        if len(first) and len(second):
            both = overlap([sets[i] for i in first], [sets[i] for i in second])
            size = np.array([len(s) for s in sets])
            union = size[first][:, None] + size[second][None, :] - both
            ok = (100 * both >= 75 * union) & (comp[first][:, None] != comp[second][None, :])
            for i, j in zip(*np.nonzero(ok)):
                x, y = first[i], second[j]
                links.setdefault((comp[x], comp[y]), (node[x], node[y]))
        return pa.table({"a": pa.array([a for a, _ in links.values()], pa.int64()),
                         "b": pa.array([b for _, b in links.values()], pa.int64())})

    return stage(placed.join(sets, "node").groupBy("group", "lo", "hi").applyInArrow(run, "a long, b long"), "near_block_links")


def links_of(docs: DataFrame, described: DataFrame) -> DataFrame:
    """Links between nodes, enough to give every connected component: verified ones, or from a node to the component they give it."""
    rows = described.filter("kind = 0")
    shingles = rows.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    bucket = buckets(shown(docs, hot_shingles(described)), shingles)
    with partitions_for(docs.sparkSession, bucket.count(), MEMBERS) as files:
        return bucket_links(docs, rows, bucket, files)


def bucket_links(docs: DataFrame, rows: DataFrame, bucket: DataFrame, files: int) -> DataFrame:
    """Links among the members of the buckets."""
    met = bucket.select("node").distinct()
    sketches = stage(rows.select("node", "n", "sketch").join(met, "node", "left_semi").dropDuplicates(["node"]), "near_sketches", files)
    star = sketched(bucket.filter((F.col("node") != F.col("first")) & (4 * F.col("first_n") >= 3 * F.col("n")))
                    .select(F.col("first").alias("a"), F.col("node").alias("b")).distinct(), sketches, files)
    links = verify(star, sets_of(docs, rows, ends(star)), files)
    label = components(links)
    named = bucket.filter(~F.col("pair")).select("bucket", "node", "n", "first").join(label, "node", "left").select(
        "bucket", "node", "n", "first", F.coalesce("component", "node").alias("component"))
    mixed = (named.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("k"))
             .filter("lo <> hi").select("bucket", "k"))
    left = stage(named.join(mixed, "bucket"), "near_mixed", files)
    small = left.filter(F.col("k") <= LARGE)
    x, y = (small.select("bucket", *[F.col(c).alias(f"{c}_{s}") for c in ("node", "n", "component")]) for s in ("x", "y"))
    across = (x.join(y, (x["bucket"] == y["bucket"]) & (F.col("node_x") < F.col("node_y")) & (F.col("component_x") != F.col("component_y"))
                     & (4 * F.least("n_x", "n_y") >= 3 * F.greatest("n_x", "n_y")))
              .select(F.col("node_x").alias("a"), F.col("node_y").alias("b")).distinct())
    across = sketched(across, sketches, files)  # the few star pairs among them that failed are verified again
    large = left.filter(F.col("k") > LARGE)
    known = label.select(F.col("node").alias("a"), F.col("component").alias("b"))  # what the verified links came to
    if large.isEmpty():
        return known.unionByName(verify(across, sets_of(docs, rows, ends(across)), files))
    group = components(large.select(F.col("first").alias("a"), F.col("node").alias("b")))
    members = stage(large.select("node", "component").distinct().join(
        group.select("node", F.col("component").alias("group")), "node").select("group", "node", "component"), "near_members", files)
    sets = sets_of(docs, rows, ends(across).unionByName(members.select("node")).distinct())
    return known.unionByName(verify(across, sets, files)).unionByName(block_links(members, sets))


def labels(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, text_hash, node, n) and the component of every node."""
    described = describe(docs)
    rows = described.filter("kind = 0").select("doc_id", "text_hash", "node", "n")
    label = components(links_of(docs, described))
    nodes = rows.filter("n > 0").select("node").distinct()
    return rows, stage(nodes.join(label, "node", "left").select("node", F.coalesce("component", "node").alias("component")), "near_named")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    rows, named = labels(docs)
    by_node = rows.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("least")).join(named, "node")
    least = by_node.groupBy("component").agg(F.min("least").alias("component_id"))
    ids = by_node.join(least, "component").select("node", "component_id")
    # A node that many rows share is one row on the right; its rows on the left can be split (adaptive skew join).
    linked = rows.filter("n > 0").join(ids, "node").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return linked.unionByName(rows.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """Of every component the row of the smallest doc_id, with all its columns; texts without words all stay."""
    rows, named = labels(docs)
    # One row per node first (in the scan tasks), then one per component.
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    least = rows.filter("n > 0").groupBy("node").agg(F.min(order).alias("row")).join(named, "node")
    kept = stage(least.groupBy("component").agg(F.min("row").alias("row")).select("row.doc_id", "row.text_hash"), "near_kept")
    keep_id, keep_hash, own = (f"{name}_{uuid.uuid4().hex[:8]}" for name in ("id", "hash", "own"))
    kept = kept.select(F.col("doc_id").alias(keep_id), F.col("text_hash").alias(keep_hash))
    wordless = F.length(F.btrim(F.coalesce("text", F.lit("")), F.lit(WHITE_SPACE))) == 0
    marked = docs.withColumn(own, F.xxhash64("text"))
    found = (marked.filter(~wordless).join(kept, (F.col(own) == F.col(keep_hash)) & F.col("doc_id").eqNullSafe(F.col(keep_id)))
             .dropDuplicates([own, keep_hash, keep_id]))
    return found.select(*docs.columns).unionByName(docs.filter(wordless))
