"""Merkle manifest of a dataset, with proofs by checkpoint and recompute.

Every row is a leaf, the leaves of a language in doc_id order are one binary
tree, and the roots of the languages, in order, are the leaves of a last tree
whose root names the whole dataset.  A node is the SHA-256, in hexadecimal, of
the hexadecimal digests of its one or two children.

Only every ``STEP``-th level of a tree is stored.  Trees are built and proofs
are made in aligned subtrees of ``SPAN`` levels: a task gets the leaves of one
such subtree, at most 2 ** SPAN short rows, and nothing larger is ever gathered.
For a proof, the subtree's missing levels are made again from the stored level
below them, the siblings of every leaf are written down and the levels are
dropped.  The steps above the subtree come from the proof of its top node,
which is a leaf of the next floor, so proofs are made from the top floor down.

A proof is text: per level one mark and, unless the node is alone, the
sibling's digest: ``L`` it stands left, ``R`` it stands right, ``-`` alone.

Defined cases: null language is a tree of its own, before all others; null is
``-`` in a leaf and differs from the empty text; rows of the same doc_id are in
the order of their leaves, so rows that repeat are equal leaves with proofs of
their own; a null doc_id comes first and is not tampered with, as it has no
decimal form; texts count as wholes at any length; an empty table gives an
empty result; other columns play no part.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage
from .ordering import place, running

#: Levels between two stored ones, and levels of the subtree that one task call holds.
STEP = 4
SPAN = 12
#: The largest number of rows in a tree whose subtrees fit SPAN levels without another floor.
WIDTH = 1 << SPAN

NODE = "tree string, level int, pos long, node string, top boolean"
PROOF = "tree string, {}pos long, node string, proof string"
#: Up to so many trees (languages) their roots are broadcast; beyond, they meet the rows by aligned subtree.
BROADCAST_TREES = 100_000


def join_hash(left: bytes, right: bytes = b"") -> bytes:
    return hashlib.sha256(left + right).hexdigest().encode()


def above(nodes: list[bytes]) -> list[bytes]:
    """The next level of a row of nodes that starts at an even place."""
    out = [join_hash(a, b) for a, b in zip(nodes[::2], nodes[1::2])]
    if len(nodes) % 2:
        out.append(join_hash(nodes[-1]))
    return out


def height(n: int) -> int:
    """Levels above the leaves of a tree of n leaves."""
    return (n - 1).bit_length()


def sized(name: str, col) -> F.Column:
    """``-`` for null, else the value's UTF-8 byte count, a colon and the value."""
    value = col.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")).alias(name)


def leaf(n_chars) -> F.Column:
    return F.sha2(F.concat(*[sized(c, F.col(c)) for c in ("doc_id", "source", "lang")], sized("n_chars", n_chars),
                           sized("text", F.col("text"))).cast("binary"), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """tree, pos, n (leaves of the tree), node, doc_id of every row; ``altered`` is the leaf after tampering, or null."""
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    changed = F.col("n_chars").cast("decimal(20,0)") + 1
    rows = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("-")).alias("tree"), "doc_id",
        leaf(F.col("n_chars")).alias("node"), F.when(hit, leaf(changed)).alias("altered"))
    order = ["doc_id", "node", "seq"]
    placed = place(stage(rows.withColumn("seq", F.monotonically_increasing_id()), "merkle_rows"),
                   ["tree"], order, "merkle_places")
    return with_size(running(placed, ["tree"], order, []).drop("part", "seq"), "merkle_leaves")


def with_size(rows: DataFrame, name: str) -> DataFrame:
    """Write the rows and add to each the number of rows of its tree (counted before it meets them)."""
    rows = stage(rows, name)
    ends = rows.groupBy("tree").agg((F.max("pos") + 1).alias("n"))
    # The largest place of a tree is its size; every row finds it by the first place of its aligned subtree.
    firsts = (ends.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.shiftright(F.col("n") - 1, SPAN)))))
    return rows.withColumn("chunk", F.shiftright("pos", SPAN)).join(firsts, ["tree", "chunk"])


def build(rows: DataFrame) -> list[dict]:
    """Floors of the trees, lowest first: ``rows`` (tree, chunk, pos, n, node), ``kept`` stored nodes, ``tops``.

    ``tops`` has the root of every tree that ends on the floor.
    """
    floors = []
    while True:
        nodes = stage(rows.select("tree", "chunk", "pos", "n", "node").groupBy("tree", "chunk")
                      .applyInArrow(fold_subtree, NODE), "merkle_nodes")
        ends = nodes.filter("top")
        floors.append({"rows": rows, "kept": nodes.filter("not top"),
                       "tops": ends.filter("level < 0").select("tree", "node")})
        more = ends.filter("level >= 0").select("tree", "pos", "node")
        if more.isEmpty():
            return floors
        rows = with_size(more, "merkle_floor")


def fold_subtree(table: pa.Table) -> pa.Table:
    """Stored levels of one aligned subtree and its top; a top that is the tree's root has level -1."""
    tree, chunk, n = table.column("tree")[0].as_py(), table.column("chunk")[0].as_py(), table.column("n")[0].as_py()
    nodes = in_order(table)
    whole = n <= WIDTH
    high = height(n) if whole else SPAN
    out = []
    for level in range(1, high + 1):
        nodes = above(nodes)
        if level % STEP == 0 and level < high:
            first = chunk << (SPAN - level)
            out += [(tree, level, first + i, node.decode(), False) for i, node in enumerate(nodes)]
    out.append((tree, -1 if whole else high, chunk, nodes[0].decode(), True))
    types = [pa.string(), pa.int32(), pa.int64(), pa.string(), pa.bool_()]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=["tree", "level", "pos", "node", "top"])


def in_order(table: pa.Table) -> list[bytes]:
    by = np.argsort(table.column("pos").to_numpy(), kind="stable")
    return [x.encode() for x in table.column("node").take(pa.array(by)).to_pylist()]


def steps_of(levels: list[list[bytes]], i: int) -> bytes:
    """Marks and siblings of leaf i through the levels of its subtree."""
    out = []
    for nodes in levels:
        if i & 1:
            out.append(b"L" + nodes[i - 1])
        elif i + 1 < len(nodes):
            out.append(b"R" + nodes[i + 1])
        else:
            out.append(b"-")
        i >>= 1
    return b"".join(out)


def subtree_proofs(rows: pa.Table, side: pa.Table) -> pa.Table:
    """Proof of every leaf of one aligned subtree; ``side`` has its stored nodes and, as level -1, the steps above it."""
    n = rows.column("n")[0].as_py()
    high = height(n) if n <= WIDTH else SPAN
    by = np.argsort(rows.column("pos").to_numpy(), kind="stable")
    rows = rows.take(pa.array(by))
    levels_col = side.column("level").to_numpy()
    rest = side.column("node")[int(np.flatnonzero(levels_col == -1)[0])].as_py().encode()
    levels, base = [], [x.encode() for x in rows.column("node").to_pylist()]
    for level in range(high):
        if level and level % STEP == 0:  # stored: read, not made again
            base = in_order(side.filter(pa.array(levels_col == level)))
        levels.append(base)
        base = above(base)
    proofs = [(steps_of(levels, i) + rest).decode() for i in range(rows.num_rows)]
    kept = [c for c in rows.column_names if c not in ("chunk", "n")]
    return rows.select(kept).append_column("proof", pa.array(proofs, pa.string()))


def floor_proofs(floor: dict, rest: DataFrame, schema: str) -> DataFrame:
    """Proofs of a floor's rows; ``rest`` (tree, chunk, node) has the steps above every subtree."""
    side = (floor["kept"].select("tree", (F.expr(f"shiftright(pos, {SPAN} - level)")).alias("chunk"), "pos", "level", "node")
            .unionByName(rest.select("tree", "chunk", F.lit(0).cast("long").alias("pos"), F.lit(-1).alias("level"), "node")))
    rows = floor["rows"]
    return (rows.groupBy("tree", "chunk").cogroup(side.groupBy("tree", "chunk"))
            .applyInArrow(subtree_proofs, schema))


def tree_proofs(floors: list[dict], tops: DataFrame, extra: str = "") -> DataFrame:
    """Proofs of all rows of the lowest floor; ``tops`` (tree, node) has the steps above the root of every tree."""
    known = None
    for i in reversed(range(len(floors))):
        ended = floors[i]["tops"].select("tree").join(tops, "tree").select("tree", F.lit(0).cast("long").alias("chunk"), "node")
        if known is not None:
            ended = ended.unionByName(known.select("tree", F.col("pos").alias("chunk"), F.col("proof").alias("node")))
        if i == 0:
            return floor_proofs(floors[0], ended, PROOF.format(extra))
        known = stage(floor_proofs(floors[i], ended, PROOF.format("")), "merkle_steps")


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, altered (leaf after tampering, or null), subroot, root and the whole proof of every row."""
    rows = leaves(docs).select("tree", "chunk", "doc_id", "altered", "pos", "n", "node")
    floors = build(rows)
    subroots = floors[0]["tops"]
    for f in floors[1:]:
        subroots = subroots.unionByName(f["tops"])
    order = ["lang_tree", "seq"]
    trees = stage(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("lang_tree"), "node",
                                  F.lit(0).alias("seq")), "merkle_subroots")
    n_trees = trees.count()
    places = running(place(trees, [], order, "merkle_tree_places", 1 + n_trees // WIDTH), [], order, [])
    top_rows = with_size(places.select("tree", "pos", "node"), "merkle_top")
    top_floors = build(top_rows)
    nothing = docs.sparkSession.createDataFrame([("", "")], "tree string, node string")
    top = stage(tree_proofs(top_floors, nothing).select("pos", F.col("proof").alias("steps")), "merkle_top_proofs")
    root = top_floors[-1]["tops"].select(F.col("node").alias("root")).first()
    above_trees = stage(places.select("pos", F.col("lang_tree").alias("tree"), F.col("node").alias("subroot")).join(top, "pos")
                        .drop("pos"), "merkle_above")
    proofs = tree_proofs(floors, above_trees.select("tree", F.col("steps").alias("node")),
                         "doc_id {id}, altered string, ".format(id=docs.schema["doc_id"].dataType.simpleString()))
    roots = above_trees.select("tree", "subroot")
    if n_trees <= BROADCAST_TREES:
        named = proofs.join(F.broadcast(roots), "tree")
    else:
        by_chunk = rows.select("tree", "chunk").distinct().join(roots, "tree")
        named = proofs.withColumn("chunk", F.shiftright("pos", SPAN)).join(by_chunk, ["tree", "chunk"])
    return named.select(
        "doc_id", F.col("node").alias("leaf"), "altered", "subroot", F.lit(root.root if root else None).cast("string").alias("root"),
        "proof")


def fold(leaf_hash: bytes, proof: bytes) -> bytes:
    """The root that a leaf and a proof lead to."""
    at, node = 0, leaf_hash
    while at < len(proof):
        mark = proof[at]
        if mark == 0x2D:  # alone
            node = join_hash(node)
            at += 1
            continue
        other = proof[at + 1 : at + 65]
        node = join_hash(other, node) if mark == 0x4C else join_hash(node, other)
        at += 65
    return node


def with_folded(rows: DataFrame) -> DataFrame:
    """Add ``folded_root``: what the altered leaf, else the leaf, and the proof lead to."""
    fields = [*rows.schema.fields]

    def run(batches):
        for batch in batches:
            first = batch.column("altered").fill_null("").to_pylist()
            own, proofs = batch.column("leaf").to_pylist(), batch.column("proof").to_pylist()
            roots = [fold((a or b).encode(), p.encode()).decode() for a, b, p in zip(first, own, proofs)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(roots, pa.string())],
                                             names=[*batch.schema.names, "folded_root"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields) + ", folded_root string"
    return rows.mapInArrow(run, schema)


def report(docs: DataFrame) -> DataFrame:
    """The digest columns of the manifest: see the contract of the query."""
    rows = with_folded(manifest(docs))
    siblings = F.translate("proof", "LR-", "")  # marks are no hexadecimal digits
    return rows.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings.cast("binary"), 256).alias("proof_sha256"),
                       "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
