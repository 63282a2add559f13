"""Toxicity by compression distance.

Two zstandard dictionaries are fitted: one of ordinary words, one that holds the
same ordinary words and, in place of filler, the words of toxic text that
ordinary text does not explain.  A window is one word inside a fixed frame that
both dictionaries hold.  (Wider windows drown a toxic word in the chance matches
of its neighbours; a frame is needed because a lone short word is stored, not
compressed.)  Its *distance* is the bytes the ordinary dictionary needs beyond
the toxic one, its *excess* the bytes the toxic one needs beyond a window it
knows as a whole.  A document's evidence is how many of its windows reach the
calibrated distance within the calibrated excess; a logistic curve, fitted out
of fold, turns the evidence into a score.

The fit takes at most ``FIT_TOXIC`` toxic and ``FIT_ORDINARY`` ordinary labelled
documents (those with the smallest hash of their id), whole texts; every
document is scored on its whole text.  A word counts as toxic when its share of
toxic occurrences could not be chance among all words looked at; occurrences
with the same neighbours count once, so copies of one document are one witness.

Defined cases: null and empty texts have no windows and the score of no
evidence; labels of unknown documents and null labels are ignored, repeated
labels count once; without labels of both kinds every score is 0; repeated
rows score alike; an empty table gives an empty result; other columns play no
part and, in ``drop_toxic``, are carried along.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_crc32, plain_text, slices, split_alnum, stage

FIT_TOXIC, FIT_ORDINARY = 4_000, 12_000
#: Expected number of ordinary words taken for toxic by chance, and words of each kind in the dictionaries.
CHANCE_WORDS, TOXIC_WORDS, ORDINARY_WORDS = 1.0, 2_000, 3_000
#: Distances and excesses are told apart up to here.
FAR, OVER = 10, 4
CELLS = (FAR + 1) * (OVER + 1)
#: The frame of a window: fixed strings of characters that words don't have.
HEAD = b"|0-ABCDEFGHIJKLMNOPQRSTUVWXYZ-1|"
TAIL = b"|2-ZYXWVUTSRQPONMLKJIHGFEDCBA-3|"
KNOWN_WORDS = 150_000


def held_out(doc_id: Column) -> Column:
    return F.pmod(id_crc32(doc_id), F.lit(5)) == 0


def labelled_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """At most FIT_TOXIC + FIT_ORDINARY rows (doc_id, toxic, fold, text), none of them held out."""
    known = (labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).filter(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    known = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    by_hash = known.withColumn("h", F.xxhash64("doc_id"))
    some = [by_hash.filter(F.col("toxic") == kind).orderBy("h", "doc_id").limit(most)
            for kind, most in ((1, FIT_TOXIC), (0, FIT_ORDINARY))]
    ids = some[0].unionByName(some[1]).select("doc_id", "toxic", F.pmod("h", F.lit(2)).cast("int").alias("fold"))
    # Broadcast: at most FIT_TOXIC + FIT_ORDINARY ids.
    return stage(docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").dropDuplicates(["doc_id"]), "toxicity_fit")


def word_witnesses(sample: DataFrame) -> DataFrame:
    """word, fold, toxic and the number of distinct neighbourhoods the word has there."""
    def run(batches):
        for batch in batches:
            for part in slices(batch):
                words, offsets = split_alnum(plain_text(part))
                text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
                own = words.dictionary_encode()
                codes = own.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1
                hashes = np.array([0] + [hash_of(w) for w in own.dictionary.to_pylist()], np.uint64)[codes] if len(codes) else codes.astype(np.uint64)
                before, after = np.roll(hashes, 1), np.roll(hashes, -1)
                first = offsets[:-1][np.diff(offsets) > 0]
                last = offsets[1:][np.diff(offsets) > 0] - 1
                before[first], after[last] = 0, 0
                around = before * np.uint64(0x9E3779B97F4A7C15) ^ after
                toxic, fold = (np.array(part.column(c).to_pylist(), np.int32)[text] if len(text) else np.empty(0, np.int32)
                               for c in ("toxic", "fold"))
                yield pa.RecordBatch.from_arrays([words, pa.array(toxic), pa.array(fold), pa.array(around.view(np.int64))],
                                                 names=["word", "toxic", "fold", "around"])

    def hash_of(word: str) -> int:
        import xxhash

        return xxhash.xxh3_64_intdigest(word)

    pairs = sample.mapInArrow(run, "word string, toxic int, fold int, around long")
    return pairs.distinct().groupBy("word").agg(*[
        F.count(F.when((F.col("toxic") == t) & (F.col("fold") == f), 1)).alias(f"n{t}{f}") for t in (0, 1) for f in (0, 1)])


def toxic_words(counts: DataFrame, folds: tuple[int, ...]) -> tuple[list[str], list[str]]:
    """Toxic and ordinary words of the folds, the strongest last."""
    ordinary, toxic = (sum((F.col(f"n{t}{f}") for f in folds), F.lit(0)) for t in (0, 1))
    both = counts.select("word", ordinary.alias("o"), toxic.alias("t"))
    total = both.agg(F.sum("o"), F.sum("t"), F.sum((F.col("t") > 1).cast("long"))).first()
    if not total[0] or not total[1]:
        return [], []
    share = total[1] / (total[0] + total[1])
    # log of a bound of the binomial tail: C(o + t, o) * share^t
    n, o, t = F.col("o") + F.col("t"), F.col("o"), F.col("t")
    mix = F.when(o > 0, n * F.log(n) - o * F.log(o) - t * F.log(t)).otherwise(0.0)
    chance = mix + t * F.lit(math.log(share))
    strong = (both.filter((t > 1) & (t * F.lit(total[0] / total[1]) > 20 * o) & (chance < F.lit(math.log(CHANCE_WORDS / max(1, total[2])))))
              .orderBy(F.desc("t"), "word").limit(TOXIC_WORDS))
    plain = both.orderBy(F.desc("o"), "word").limit(ORDINARY_WORDS)
    bad = [r.word for r in strong.collect()]
    return bad[::-1], [r.word for r in plain.collect() if r.word not in set(bad)][::-1]


class Distance:
    """Cell (distance, excess) of words under a toxic and an ordinary dictionary."""

    def __init__(self, toxic: list[str], ordinary: list[str]):
        own = "".join(f" {w} " for w in toxic).encode()
        base = "".join(f" {w} " for w in ordinary).encode()
        filler = (base * (len(own) // max(1, len(base)) + 1))[: len(own)]
        self.ordinary = self._compressor(base + filler)
        self.toxic = self._compressor(base + own)
        self.least = min((len(self.toxic(self.window(w))) for w in [*toxic, *ordinary]), default=0)
        self.known: dict[str, int] = {}

    @staticmethod
    def window(word: str) -> bytes:
        return HEAD + f" {word} ".encode() + TAIL

    @staticmethod
    def _compressor(content: bytes):
        import zstandard as z

        data = z.ZstdCompressionDict(content + HEAD + TAIL, dict_type=z.DICT_TYPE_RAWCONTENT)
        # Every position of the dictionary is searched, also for matches of four bytes.
        how = z.ZstdCompressionParameters(
            format=z.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False, write_dict_id=False,
            window_log=17, hash_log=16, chain_log=16, search_log=6, min_match=4, strategy=z.STRATEGY_LAZY)
        return z.ZstdCompressor(dict_data=data, compression_params=how).compress

    def of(self, words: list[str]) -> np.ndarray:
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
        out = np.empty(len(words), np.int64)
        known, ordinary, toxic, window = self.known, self.ordinary, self.toxic, self.window
        for i, word in enumerate(words):
            cell = known.get(word)
            if cell is None:
                framed = window(word)
                n = len(toxic(framed))
                cell = known[word] = (min(FAR, max(0, len(ordinary(framed)) - n)) * (OVER + 1)
                                      + min(OVER, max(0, n - self.least)))
            out[i] = cell
        return out

    def histogram(self, texts: pa.Array) -> np.ndarray:
        """How many windows of each text are in each cell."""
        words, offsets = split_alnum(texts)
        out = np.zeros((len(offsets) - 1, CELLS), np.int64)
        if len(words):
            own = words.dictionary_encode()
            cell = self.of(own.dictionary.to_pylist())[own.indices.to_numpy(zero_copy_only=False)]
            text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
            out = np.bincount(text * CELLS + cell, minlength=out.size).reshape(out.shape)
        return out


def histograms(sample: DataFrame, words: dict[int, tuple[list[str], list[str]]]):
    """(toxic, histogram) of each sampled document under the dictionaries fitted without its fold."""
    shared = sample.sparkSession.sparkContext.broadcast(words)  # at most TOXIC_WORDS + ORDINARY_WORDS words a fold

    def run(batches):
        distance = {fold: Distance(*w) for fold, w in shared.value.items()}
        for batch in batches:
            for part in slices(batch):
                fold = np.array(part.column("fold").to_pylist())
                both = {f: d.histogram(plain_text(part)) for f, d in distance.items()}
                yield pa.RecordBatch.from_arrays(
                    [part.column("toxic"), pa.array([both[f][i].tolist() for i, f in enumerate(fold)], pa.list_(pa.int64()))],
                    names=["toxic", "histogram"])

    rows = sample.select("text", "toxic", "fold").mapInArrow(run, "toxic int, histogram array<long>").collect()
    return np.array([r.toxic for r in rows]), np.array([r.histogram for r in rows])


def reaching(histogram: np.ndarray, far: int, over: int) -> np.ndarray:
    """Windows of at least the distance ``far`` and at most the excess ``over``."""
    return histogram.reshape(-1, FAR + 1, OVER + 1)[:, far:, : over + 1].sum((1, 2))


def evidence(n: np.ndarray) -> np.ndarray:
    return np.log1p(np.minimum(n, 20))


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Intercept, slope and log-likelihood of a ridge logistic fit by Newton's method."""
    design, w = np.column_stack([np.ones(len(x)), x]), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        hessian = design.T @ (design * (p * (1 - p))[:, None]) + np.diag([1e-6, 1e-2])
        w += np.linalg.solve(hessian, design.T @ (y - p) - np.array([1e-6, 1e-2]) * w)
        w = np.clip(w, -60, 60)
    p = np.clip(1 / (1 + np.exp(-np.clip(design @ w, -30, 30))), 1e-9, 1 - 1e-9)
    return float(w[0]), float(w[1]), float((y * np.log(p) + (1 - y) * np.log(1 - p)).sum())


def fit(docs: DataFrame, labels: DataFrame) -> dict:
    """Dictionaries' words, calibrated distance and logistic curve; empty without labels of both kinds."""
    sample = labelled_sample(docs, labels)
    counts = stage(word_witnesses(sample), "toxicity_words")
    toxic, ordinary = toxic_words(counts, (0, 1))
    if not ordinary:
        return {}
    # Each fold is judged by the words of the other one.
    y, h = histograms(sample, {0: toxic_words(counts, (1,)), 1: toxic_words(counts, (0,))})
    fits = [(logistic(evidence(reaching(h, far, over)), y), far, over) for far in range(1, FAR + 1) for over in range(OVER + 1)]
    (intercept, slope, _), far, over = max(fits, key=lambda f: f[0][2])
    return {"toxic": toxic, "ordinary": ordinary, "far": far, "over": over, "intercept": intercept, "slope": max(0.0, slope)}


def scores(docs: DataFrame, model: dict, score: str, n: str) -> DataFrame:
    """Add ``score`` and ``n`` (windows that reach the calibrated thresholds)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    from pyspark.sql import types as T
    schema = T.StructType([*docs.schema.fields, T.StructField(score, T.DoubleType()), T.StructField(n, T.LongType())])
    keep = docs.columns

    def run(batches):
        m = shared.value
        distance = Distance(m["toxic"], m["ordinary"]) if m else None
        for batch in batches:
            for part in slices(batch):
                if distance:
                    n_windows = reaching(distance.histogram(plain_text(part)), m["far"], m["over"])
                    p = 1 / (1 + np.exp(-(m["intercept"] + m["slope"] * evidence(n_windows))))
                else:
                    p, n_windows = np.zeros(part.num_rows), np.zeros(part.num_rows, np.int64)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(p), pa.array(n_windows)], names=[*keep, score, n])

    return docs.mapInArrow(run, schema)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, n_toxic_windows of every document."""
    scored = scores(docs.select("doc_id", "text"), fit(docs, labels), "score", "n_toxic_windows")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_toxic_windows")


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents not predicted toxic, with all their columns."""
    score, n = (f"{name}_{uuid.uuid4().hex[:8]}" for name in ("score", "n"))
    return scores(docs, fit(docs, labels), score, n).filter(F.col(score) < 0.5).drop(score, n)
