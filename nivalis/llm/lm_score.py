"""Log-bilinear language model over word classes, trained by noise-contrastive estimation.

The probability of a token is P(class | two classes before) * P(word | class).
The ``OWN`` most frequent training tokens (words and the end of a document) are
classes of their own; every other word, known or not, belongs to the class of
its last byte.  P(word | class) is the add-one estimate over the class's
training tokens with one place for the unknown.

The class model is log-bilinear: the vectors of the two context classes, each
through its own matrix, predict a vector whose product with a class's vector,
plus its bias, is the class's score.  Training minimises the noise-contrastive
loss in numpy on the counts of all class trigrams of the training corpus (the
expectation over noise is taken exactly, the classes being few).  A scoring
task gets the vectors, makes the scores of all contexts in batched matrix
products, normalises them into a table of log-probabilities and looks the
classes of its documents up.

Everything is gathered from all training tokens by Spark: word counts (partly
summed in the scan tasks), trigram counts (at most CLASSES ** 3 cells) and, for
the words that are not among the ``COMMON`` broadcast ones, a join of the
documents' words with the counts.  Words in that join are by construction no
more frequent than the least frequent common word, so no key of it is hot.

Defined cases: a null text is empty and has the end token only; without
training documents every token has probability 1 by the base and the uniform class
model by the score; repeated rows are scored alike (and counted each, if they
are in training); an empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import give_back, id_crc32, plain_text, slices, split_words, stage

#: The end of a document as a token: no word is empty.
END = ""
OWN, CLASSES, COMMON = 96, 160, 60_000
#: Training: vector length, noise samples per token, steps, contexts per step, step size.
DIM, NOISE, STEPS, BATCH, RATE = 24, 16, 1_200, 1_024, 0.02


def held_out(doc_id: Column) -> Column:
    return F.pmod(id_crc32(doc_id), F.lit(7)) == 2


def word_counts(docs: DataFrame) -> DataFrame:
    """word, c: training tokens by word, the end of each document as the empty word."""
    def run(batches):
        for batch in batches:
            for part in slices(batch):
                words, _ = split_words(plain_text(part))
                own = words.dictionary_encode()
                n = np.bincount(own.indices.to_numpy(zero_copy_only=False), minlength=len(own.dictionary))
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays([own.dictionary.cast(pa.string()), pa.array([END])]), pa.array(np.append(n, part.num_rows))],
                    names=["word", "n"])

    train = docs.filter(~held_out(F.col("doc_id"))).select("text")
    return train.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("c"))


class Vocabulary:
    """Classes of words and the counts of the common ones (bounded: COMMON words, 256 last bytes)."""

    def __init__(self, common: list[tuple[str, int]], by_byte: list[tuple[int, int, int]], n: int, v: int):
        words = [w for w, _ in common]
        own = [w for w in words[:OWN] if w != END]
        self.parts = common, by_byte, n, v  # a broadcast carries these, as tasks rebuild the object
        self.words, self.n, self.v = words, n, v
        self.counts = np.array([c for _, c in common], np.float64)
        self.end = 0
        kinds = {END: 0} | {w: i + 1 for i, w in enumerate(own)}
        first = len(kinds)
        # Last bytes by their tokens; the least frequent share the last class.
        ranked = [b for b, _, _ in sorted(by_byte, key=lambda x: (-x[1], x[0]))]
        room = CLASSES - first
        self.class_of_byte = np.full(256, CLASSES - 1, np.uint8)
        for place, byte in enumerate(ranked[: room - 1]):
            self.class_of_byte[byte] = first + place
        self.first_rest = first
        self.class_of_word = np.array([kinds.get(w, 255) for w in words], np.uint8)
        tokens, kinds_known = np.zeros(CLASSES), np.zeros(CLASSES)
        for byte, c, distinct in by_byte:
            tokens[self.class_of_byte[byte]] += c
            kinds_known[self.class_of_byte[byte]] += distinct
        #: log10 of the denominator of P(word | class); 0 for classes of one word.
        self.log_room = np.where(np.arange(CLASSES) < first, 0.0, np.log10(tokens + kinds_known + 1))

    def encode(self, texts: pa.Array):
        """Per text: classes, sums of log10(c + 1) over common words (all; those without a class), known, other words."""
        words, offsets = split_words(texts)
        n_texts = len(offsets) - 1
        text = np.repeat(np.arange(n_texts), np.diff(offsets))
        if len(words) and self.words:
            place = pc.fill_null(pc.index_in(words, value_set=pa.array(self.words, words.type)), -1).to_numpy(zero_copy_only=False)
        else:
            place = np.full(len(words), -1)
        _, ends, data = words.buffers()
        if len(words):
            at = np.frombuffer(ends, np.int64)[words.offset + 1 : words.offset + len(words) + 1] - 1
            rest = self.class_of_byte[np.frombuffer(data, np.uint8)[at]]
        else:
            rest = np.empty(0, np.uint8)
        common = place >= 0
        if self.words:
            kind = np.where(common, self.class_of_word[place], 255)
            value = np.where(common, np.log10(self.counts[place] + 1), 0.0)
        else:
            kind, value = np.full(len(words), 255), np.zeros(len(words))
        loose = kind == 255
        kind = np.where(loose, rest, kind).astype(np.uint8)
        every = np.bincount(text, value, n_texts).astype(np.float64)  # of no words, bincount counts in integers
        without = np.bincount(text, value * loose, n_texts).astype(np.float64)
        known = np.bincount(text, common, n_texts).astype(np.int64)
        if END in self.words:
            every += np.log10(self.counts[self.words.index(END)] + 1)
            known += 1
        classes = np.insert(kind, offsets[1:], self.end)
        others = words.filter(pa.array(~common)) if len(words) else words
        borders = np.concatenate(([0], np.cumsum(np.bincount(text, ~common, n_texts)))).astype(np.int32)
        return classes, offsets + np.arange(n_texts + 1), every, without, known, others, borders


def vocabulary(counts: DataFrame) -> Vocabulary:
    common = [(r.word, r.c) for r in counts.orderBy(F.desc("c"), "word").limit(COMMON).collect()]
    least = common[-1][1] if common else 0  # of the ranked words, before the end takes a place
    if common and all(w != END for w, _ in common):
        common[-1] = (END, counts.filter(F.col("word") == END).first().c)
    total = counts.agg(F.sum("c"), F.count(F.lit(1))).first()
    own = [w for w, _ in common[:OWN] if w != END] + [END]
    last = F.conv(F.hex(F.substring(F.col("word").cast("binary"), -1, 1)), 16, 10).cast("int")
    by_byte = (counts.filter(~F.col("word").isin(own)).groupBy(last.alias("b"))
               .agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect())
    model = Vocabulary(common, [(r.b, r.c, r.v) for r in by_byte], total[0] or 0, total[1])
    model.least = least
    return model


ENCODED = ("row_id long, doc_id long, held_out boolean, n_tokens long, n_known long, classes binary, every double, "
           "without double, others array<string>")


def encode(docs: DataFrame, model: Vocabulary) -> DataFrame:
    """One row per document with its classes and the words that are not common, written once."""
    shared = docs.sparkSession.sparkContext.broadcast(model.parts)

    def run(batches):
        vocabulary = Vocabulary(*shared.value)
        for batch in batches:
            for part in slices(batch):
                classes, offsets, every, without, known, others, borders = vocabulary.encode(plain_text(part))
                raw = classes.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [part.column("row_id"), part.column("doc_id"), part.column("held_out"), pa.array(np.diff(offsets)),
                     pa.array(known), pa.array([raw[a:b] for a, b in zip(offsets, offsets[1:])], pa.binary()),
                     pa.array(every), pa.array(without),
                     pa.ListArray.from_arrays(pa.array(borders), others.cast(pa.string()))],
                    names=[f.split()[0] for f in ENCODED.split(", ")])

    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), "doc_id",
                       held_out(F.col("doc_id")).alias("held_out"), "text")
    return stage(rows.mapInArrow(run, ENCODED), "lm_encoded")


def contexts(raw: list[bytes], end: int) -> tuple[np.ndarray, np.ndarray]:
    """Trigram code of every token of the documents (a document starts after two ends), and its document."""
    sizes = np.array([len(r) for r in raw], np.int64)
    now = np.frombuffer(b"".join(raw), np.uint8).astype(np.int64)
    starts = np.cumsum(sizes) - sizes
    one, two = np.roll(now, 1), np.roll(now, 2)
    one[starts], two[starts] = end, end
    second = starts[sizes > 1] + 1
    two[second] = end
    return (two * CLASSES + one) * CLASSES + now, np.repeat(np.arange(len(raw)), sizes)


def trigram_counts(encoded: DataFrame, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes and counts of all class trigrams in training documents; at most CLASSES ** 3 cells."""
    def run(batches):
        counts = np.zeros(CLASSES**3, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                raw = batch.column("classes").slice(at, 512).to_pylist()
                if raw:
                    codes, n = np.unique(contexts(raw, end)[0], return_counts=True)
                    counts[codes] += n
            give_back()
        seen = np.flatnonzero(counts)
        for at in range(0, len(seen), 1 << 16):
            part = seen[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(counts[part])], names=["code", "n"])

    rows = (encoded.filter(~F.col("held_out")).select("classes").mapInArrow(run, "code long, n long")
            .groupBy("code").agg(F.sum("n").alias("n")).toArrow())
    return rows.column("code").to_numpy(), rows.column("n").to_numpy()


def train(codes: np.ndarray, n: np.ndarray) -> dict[str, np.ndarray]:
    """Vectors, matrices and biases of the class model from trigram counts; all 0 without any."""
    shapes = {"r": (CLASSES, DIM), "a": (DIM, DIM), "b": (DIM, DIM), "v": (CLASSES, DIM), "bias": (CLASSES,)}
    if not len(codes):
        return {k: np.zeros(s) for k, s in shapes.items()}
    rng = np.random.default_rng(7)
    context, target = codes // CLASSES, codes % CLASSES
    order = np.argsort(context, kind="stable")
    context, target, n = context[order], target[order], n[order].astype(np.float64)
    seen, starts = np.unique(context, return_index=True)
    ends = np.append(starts[1:], len(context))
    weight = np.add.reduceat(n, starts)
    draw = np.cumsum(weight) / weight.sum()
    noise = np.bincount(target, n, CLASSES) + 1.0
    noise /= noise.sum()
    log_noise = np.log(NOISE * noise)
    w = {k: rng.normal(0, 0.1, s) for k, s in shapes.items()}
    w["a"], w["b"], w["bias"] = np.eye(DIM), np.eye(DIM) * 0.5, np.log(noise)
    first, second = ({k: np.zeros(s) for k, s in shapes.items()} for _ in range(2))
    for step in range(1, STEPS + 1):
        pick = np.searchsorted(draw, rng.random(BATCH)).clip(0, len(seen) - 1)
        truth = np.zeros((BATCH, CLASSES))
        for row, p in enumerate(pick):
            cells = slice(starts[p], ends[p])
            truth[row, target[cells]] = n[cells] / weight[p]
        two, one = seen[pick] // CLASSES, seen[pick] % CLASSES
        x1, x2 = w["r"][one], w["r"][two]
        q = x1 @ w["a"] + x2 @ w["b"]
        score = q @ w["v"].T + w["bias"] - log_noise
        chance = 1 / (1 + np.exp(-np.clip(score, -30, 30)))  # that a class is data, not noise
        # Gradient of E_data[log s] + NOISE * E_noise[log (1 - s)]
        g = (chance * (truth + NOISE * noise) - truth) / BATCH
        gq = g @ w["v"]
        grads = {"v": g.T @ q, "bias": g.sum(0), "a": x1.T @ gq, "b": x2.T @ gq, "r": np.zeros_like(w["r"])}
        np.add.at(grads["r"], one, gq @ w["a"].T)
        np.add.at(grads["r"], two, gq @ w["b"].T)
        rate = RATE * (1 - step / (STEPS + 1))
        for k, grad in grads.items():
            first[k] = 0.9 * first[k] + 0.1 * grad
            second[k] = 0.999 * second[k] + 0.001 * grad**2
            w[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return w


def table_of(w: dict[str, np.ndarray]) -> np.ndarray:
    """log10 P(class | two classes before), contexts by rows: normalised products of all contexts."""
    table = np.empty((CLASSES**2, CLASSES), np.float32)
    for two in range(CLASSES):  # all contexts, a batch of products per class two back
        score = (w["r"] @ w["a"] + w["r"][two] @ w["b"]) @ w["v"].T + w["bias"]
        score -= score.max(1, keepdims=True)
        table[two * CLASSES : (two + 1) * CLASSES] = (score - np.log(np.exp(score).sum(1, keepdims=True))) / np.log(10)
    return table


def class_scores(encoded: DataFrame, model: Vocabulary, weights: dict[str, np.ndarray]) -> DataFrame:
    """row_id, doc_id, held_out, n_tokens, n_known, and the parts of both scores that need no other words."""
    shared = encoded.sparkSession.sparkContext.broadcast((weights, model.log_room, model.end))  # of fixed size

    def run(batches):
        weights, log_room, end = shared.value
        flat = table_of(weights).reshape(-1)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                codes, row = contexts(part.column("classes").to_pylist(), end)
                gained = np.bincount(row, flat[codes].astype(np.float64) - log_room[codes % CLASSES], part.num_rows)
                without = part.column("without").to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in ("row_id", "doc_id", "held_out", "n_tokens", "n_known", "every")],
                     pa.array(gained + without)],
                    names=["row_id", "doc_id", "held_out", "n_tokens", "n_known", "base_part", "score_part"])
            give_back()

    return encoded.select("row_id", "doc_id", "held_out", "n_tokens", "n_known", "every", "without", "classes").mapInArrow(
        run, "row_id long, doc_id long, held_out boolean, n_tokens long, n_known long, base_part double, score_part double")


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document."""
    counts = stage(word_counts(docs), "lm_counts")
    model = vocabulary(counts)
    encoded = encode(docs, model)
    weights = train(*trigram_counts(encoded, model.end))
    parts = class_scores(encoded, model, weights)
    # Words that are not common are no more frequent than the last ranked one.
    rare = counts.filter(F.col("c") <= model.least)
    others = encoded.select("row_id", F.explode("others").alias("word")).join(rare, "word")
    sums = others.groupBy("row_id").agg(F.sum(F.log10(F.col("c") + 1)).alias("more"), F.count(F.lit(1)).alias("found"))
    more = F.coalesce("more", F.lit(0.0))
    room = float(np.log10(model.n + model.v + 1))
    return parts.join(sums, "row_id", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("found", F.lit(0))).alias("n_known"),
        F.lit(model.n).cast("long").alias("train_tokens"),
        (F.col("base_part") + more - F.col("n_tokens") * F.lit(room)).alias("base_score"),
        (F.col("score_part") + more).alias("score"))
