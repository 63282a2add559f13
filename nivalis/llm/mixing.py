"""Mixing sources to target weights by Pareto order sampling.

Every source has a target in words: its weight's share of all words, at most
``most`` times its own words, what is above being shared again by weight among
the others.  target / words is the source's rate.  Its whole part is certain:
every document gets that many whole copies.  The rest is drawn as one sample of
fixed size, each document at most once more: documents are ranked by Pareto's
ranking variable, the odds u / (1 - u) of a uniform random number u divided by
the document's inclusion odds p / (1 - p), and taken from the front while they
fit into the words that are left.

Inclusion odds are unequal: a document's are the odds of the source's rate
times (mean words / its words) ** ``tilt``.  With the default of one half, a
text a hundred times the mean has a tenth of the odds, so that a few very long
texts do not decide what a source gives; 0 makes them equal.  A factor common
to a source's documents does not change the ranking, so the fixed size alone
sets the level of the probabilities.

A document that no longer fits ends a turn.  While more than a thousandth
(``CLOSE``) of the target is missing, another turn goes on behind it with the
documents that fit into what is missing.  If none fits and that much is still
missing, the shortest document left is taken if going over the target with it
comes nearer than staying below.  On large sources the first turn is
near enough; each turn is one pass over rows of a few numbers, never over texts.

u comes from a digest of seed and doc_id, so reruns agree.  No source is
gathered in one task: ranks and running sums come from a range partitioning.

Defined cases: a null text has no words and is never taken; null is a source of
its own, the last one; a source without words has target 0; rows that repeat
are documents of their own and equal in rank, either may be the one taken; a
null doc_id is drawn as the empty id; texts count as wholes at any length; an
empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WHITE_SPACE, stage
from .ordering import place, running

KEY = ["no_source", "source"]
#: A source within 1 / CLOSE of its target starts no further turn.
CLOSE = 1000
#: Up to so many sources (one short row each) are broadcast; beyond, rows meet them in a salted join.
BROADCAST_SOURCES = 100_000
SALTS = 32
#: Sources in one range of the tables that hold a row per source.
SOURCES_A_PART = 200_000


def words_of(docs: DataFrame, seed: int) -> DataFrame:
    """doc_id, source key, size in words and u of every row, with a running number for rows that repeat."""
    words = F.regexp_replace(F.coalesce("text", F.lit("")), r"[^\x20\x09-\x0D]+", "w")
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    return docs.select(
        "doc_id", F.col("source").isNull().alias("no_source"), F.coalesce("source", F.lit("")).alias("source"),
        F.char_length(F.translate(words, WHITE_SPACE, "")).cast("long").alias("size"),
        ((F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)).alias("u"),
        F.monotonically_increasing_id().alias("seq"))


def targets(rows: DataFrame, weights: tuple[int, ...], most: int) -> tuple[DataFrame, int]:
    """One row per source (words, documents with words, target, whole copies, words to draw) and their number.

    With the sources in order of ``most * words / weight``, those at their bound
    come first; a source is one of them if an equal share by weight of what the
    ones before it leave would reach its bound.  The first that is not gives the
    share of all that follow.  Comparisons are between whole numbers.
    """
    totals = stage(rows.groupBy(*KEY).agg(F.sum("size").alias("source_size"),
                                          F.count(F.when(F.col("size") > 0, 1)).alias("n_full")), "mix_sources")
    n, words = totals.agg(F.count(F.lit(1)), F.coalesce(F.sum("source_size"), F.lit(0))).first()
    rounds, rest = divmod(n, len(weights))
    weight = rounds * sum(weights) + sum(weights[:rest])
    parts = 1 + n // SOURCES_A_PART

    def whole(c):
        return c.cast("decimal(38,0)")

    numbered = running(place(totals, [], KEY, "mix_numbers", parts), [], KEY, [])
    turn = (F.col("pos") % len(weights) + 1).cast("int")
    scale = math.lcm(*weights)
    weighted = numbered.select(
        *totals.columns, F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), turn).alias("weight"),
        (F.col("source_size") * most).alias("cap"))
    by = weighted.withColumn("reach", whole(F.col("cap")) * (scale / F.col("weight")).cast("decimal(18,0)"))
    filled = running(place(by, [], ["reach", *KEY], "mix_fill", parts), [], ["reach", *KEY], ["cap", "weight"])
    left = filled.select(
        *totals.columns, "weight", "cap", "pos", (F.lit(words) - F.col("cap_run") + F.col("cap")).alias("left_words"),
        (F.lit(weight) - F.col("weight_run") + F.col("weight")).alias("left_weight"))
    left = stage(left.withColumn("bound", whole(F.col("left_words")) * F.col("weight")
                                 >= whole(F.col("cap")) * F.col("left_weight")), "mix_left")
    first = left.agg(F.min(F.when(~F.col("bound"), F.struct("pos", "left_words", "left_weight")))).first()[0]
    target = F.col("cap").cast("double")
    if first is not None:
        share = (F.col("weight") * F.lit(first.left_words)).cast("double") / F.lit(float(first.left_weight))
        target = F.when(F.col("bound"), target).otherwise(share)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    out = (left.withColumn("target", target).withColumn("rate", rate)
           .withColumn("copies", F.floor("rate"))
           .withColumn("draw", F.floor(F.col("target") - F.col("copies") * F.col("source_size"))))
    return stage(out.select(*totals.columns, "target", "rate", "copies", "draw"), "mix_targets"), n


def with_sources(rows: DataFrame, sources: DataFrame, n: int) -> DataFrame:
    """Join rows with the row of their source; a source may hold a third of all rows."""
    if n <= BROADCAST_SOURCES:
        return rows.join(F.broadcast(sources), KEY)
    salted = sources.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", F.pmod("seq", F.lit(SALTS)).cast("int")).join(salted, [*KEY, "salt"]).drop("salt")


def turn_ends(rows: DataFrame, start) -> DataFrame:
    """From rows with ``size_run`` and the words ``room`` of their source: where the turn ends and what it leaves."""
    fits = F.col("size_run") <= F.col("room")
    return (rows.groupBy(*KEY, "room", "target", start.alias("start"))
            .agg(F.max(F.when(fits, F.col("size_run"))).alias("used"), F.min(F.when(~fits, F.col("pos"))).alias("end"))
            .select(*KEY, "target", "start", "end", "room", (F.col("room") - F.coalesce("used", F.lit(0))).alias("missing"))
            .withColumn("open", F.col("end").isNotNull() & (F.col("missing") * CLOSE > F.col("target"))))


def spans_of(turns: DataFrame) -> DataFrame:
    return turns.groupBy(*KEY).agg(F.collect_list(F.struct("start", "end", "room")).alias("spans"))


def drawn_once() -> F.Column:
    """Whether one of its source's turns takes a document: it stands in the turn's span and fitted."""
    return F.exists("spans", lambda s: (F.col("pos") > s["start"]) & (F.col("pos") < F.coalesce(s["end"], F.col("pos") + 1))
                    & (F.col("size") <= s["room"]))


def closing(ranked: DataFrame, turns: DataFrame, far: DataFrame, n: int) -> DataFrame:
    """For sources still far from their target: the shortest document left, if going over with it comes nearer."""
    left = with_sources(ranked, far.join(spans_of(turns), KEY), n).filter(~drawn_once() & (F.col("size") < 2 * F.col("missing")))
    return (left.groupBy(*KEY, "target", "missing").agg(F.min(F.struct("size", "pos")).alias("x"))
            .select(*KEY, "target", (F.col("x.pos") - 1).alias("start"), (F.col("x.pos") + 1).alias("end"),
                    F.col("x.size").alias("room"), F.col("missing"), F.lit(False).alias("open")))


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3, tilt: float = 0.5,
        seed: int = 20) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken (copies * size) of every row.

    ``weights`` repeat over the sources in code point order.
    """
    rows = stage(words_of(docs, seed), "mix_rows")
    sources, n = targets(rows, weights, most)
    part = F.col("rate") - F.col("copies")
    odds = part / (1 - part) * F.pow(F.col("source_size") / F.col("n_full") / F.col("size"), F.lit(tilt))
    chance = F.col("u") / (1 - F.col("u"))
    drawn = with_sources(rows, sources, n).withColumn(
        "q", F.when((F.col("size") > 0) & (part > 0), chance / odds).otherwise(F.lit(0.0)))
    order = ["q", "doc_id", "size", "seq"]
    placed = place(drawn.select("doc_id", *KEY, "size", "q", "seq", "target", F.col("draw").alias("room")),
                   KEY, order, "mix_ranges")
    ranked = stage(running(placed, KEY, order, ["size"]), "mix_ranked")

    turns = [stage(turn_ends(ranked, F.lit(-1).cast("long")), "mix_turn")]
    while not turns[-1].filter("open").isEmpty():
        behind = turns[-1].filter("open").select(*KEY, F.col("end").alias("behind"), F.col("missing").alias("room"))
        fitting = (with_sources(ranked.select(*KEY, "part", "pos", "size", "seq", "target"), behind, n)
                   .filter((F.col("pos") > F.col("behind")) & F.col("size").between(F.lit(1), F.col("room")))
                   .withColumnRenamed("pos", "rank"))
        run = running(fitting, KEY, ["rank"], ["size"]).drop("pos").withColumnRenamed("rank", "pos")
        turns.append(stage(turn_ends(run, F.col("behind")), "mix_turn"))
    every = turns[0]
    for t in turns[1:]:
        every = every.unionByName(t)
    # Each turn leaves less than the one before, so the least is what is missing in the end.
    far = every.groupBy(*KEY, "target").agg(F.min("missing").alias("missing")).filter(F.col("missing") * CLOSE > F.col("target"))
    if not far.isEmpty():
        every = every.unionByName(stage(closing(ranked, every, far.select(*KEY, "missing"), n), "mix_closing"))
    spans = spans_of(every)
    known = sources.join(spans, KEY).drop("n_full", "rate", "draw")
    out = with_sources(ranked.drop("target", "room"), known, n)
    copies = F.when(F.col("size") > 0, F.col("copies") + drawn_once().cast("long")).otherwise(F.lit(0))
    return out.select("doc_id", F.when(~F.col("no_source"), F.col("source")).alias("source"), "size", "source_size", "target",
                      copies.cast("int").alias("copies"), (copies * F.col("size")).cast("long").alias("taken"))
