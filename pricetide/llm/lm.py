"""Operator 9: text scores of a log-bilinear neural language model.

A word is a run of characters other than ASCII white space, with A-Z in lower case; each
document ends with one end token.  Counts are taken over all training documents.

The model (Mnih and Hinton 2007; noise-contrastive estimation: Mnih and Teh 2012): the
vectors of the CONTEXT words before a place, each times a vector of its own position, add
up to a predicted vector; its inner product with the vector of a target plus the target's
bias is the target's score.  Targets are the SHORT most frequent words, the end token and
CLASSES classes of all other words (by their last characters); a batched matrix product
gives the scores of all targets, whose log-sum-exp normalises them exactly.  Within a
class a word has its smoothed share (c + 0.5) / (n + 0.5 (v + 1)) of the class's tokens.

Training: the parameters start from a bounded sample of documents (WARM_DOCS, gone over
until WARM_STEPS) on the driver; then every task goes once over all its training documents, with noise drawn from
the targets' frequencies and shared by a batch, and the tasks' parameters are averaged
with their tokens as weights.

The FREQUENT most frequent words and their counts are broadcast (a fixed number); the
others, of which none can be a hot key, are joined with the table of counts.

Nulls: a null text counts as empty (the end token alone); null ids hash like empty text.
Repeated rows get equal scores.  Without training documents all counts are 0.  An empty
table gives no rows.  Extra columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricetide.llm.common import crc32_mod, text_or_empty, written

FREQUENT, SHORT, INPUT, CLASSES = 200_000, 256, 2048, 64
DIM, CONTEXT = 16, 4
WARM_DOCS, WARM_STEPS = 1500, 400      # a small sample is gone over until so many steps are taken
BATCH, NOISE, RATE = 2048, 64, 0.1
END = b""                                # no word is empty
FLUSH_WORDS = 400_000                    # different words that a counting task holds at once


def words(text: str | None) -> list[bytes]:
    """bytes.lower and bytes.split know ASCII letters and ASCII white space only."""
    return (text or "").encode("utf-8", "replace").lower().split()


def word_class(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % CLASSES


def count_words(docs: DataFrame) -> DataFrame:
    """word and c, its number in the texts (column text), ends counted as the word END."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(c: Counter) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(c.keys()), pa.binary()), pa.array(list(c.values()), pa.int64())], names=["word", "n"])
        total: Counter = Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                total.update(words(t))
            total[END] += batch.num_rows
            if len(total) >= FLUSH_WORDS:
                yield out(total)
                total = Counter()
        yield out(total)

    return docs.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))


class Vocabulary:
    """What tasks know of the counts.  Rows of the input vectors: words by rank, then
    classes, then the place before a text.  Targets: words by rank, the end, classes."""

    def __init__(self, frequent: list[tuple[bytes, int]], ends: int, total: int, distinct: int,
                 class_tokens: np.ndarray, class_words: np.ndarray):
        self.rank = {w: i for i, (w, _) in enumerate(frequent)}
        count = np.array([c for _, c in frequent], np.float64)
        cls = np.array([word_class(w) for w, _ in frequent], np.int64)
        n, i = len(frequent), np.arange(len(frequent))
        self.n_short, self.n_input = min(SHORT, n), min(INPUT, n)
        self.base = np.log10((count + 0.5) / (total + 0.5 * (distinct + 1)))
        self.end_base = np.log10((ends + 0.5) / (total + 0.5 * (distinct + 1)))
        self.log_all = np.log10(total + 0.5 * (distinct + 1))
        self.log_class = np.log10(class_tokens + 0.5 * (class_words + 1))
        self.total, self.ends = total, ends
        self.end, self.start = self.n_short, self.n_input + CLASSES
        self.source = np.where(i < self.n_input, i, self.n_input + cls)
        self.target = np.where(i < self.n_short, i, self.n_short + 1 + cls)
        self.tail = np.where(i < self.n_short, 0.0, np.log10(count + 0.5) - self.log_class[cls]) if n else np.zeros(0)
        share = np.concatenate([count[:self.n_short], [ends], class_tokens]) + 0.5
        self.noise = share / share.sum()

    def codes(self, w: list[bytes]) -> np.ndarray:
        """The rank of each frequent word, -1 - class of each other."""
        code = np.fromiter(map(self.rank.get, w, repeat(-1)), np.int32, len(w))
        rare = np.flatnonzero(code < 0)
        if len(rare):
            code[rare] = np.fromiter((-1 - word_class(w[i]) for i in rare.tolist()), np.int32, len(rare))
        return code

    def places(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Input row and target of each code."""
        cls = -1 - code.astype(np.int64)
        if not len(self.source):
            return self.n_input + cls, self.n_short + 1 + cls
        rank = np.maximum(code, 0)
        source, target = self.source[rank], self.target[rank]
        rare = np.flatnonzero(code < 0)
        source[rare], target[rare] = self.n_input + cls[rare], self.n_short + 1 + cls[rare]
        return source, target

    def tokens(self, codes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Contexts and targets of all words and ends of texts."""
        found = [self.places(c) for c in codes]
        return contexts([f[0] for f in found], self.start), np.concatenate([np.append(f[1], self.end) for f in found])


def contexts(source: list[np.ndarray], start: int) -> np.ndarray:
    """Input rows of the CONTEXT words before each word and the end of each text."""
    pad = np.full(CONTEXT, start, np.int64)
    flat = np.concatenate([np.concatenate([pad, s]) for s in source])
    size = np.array([len(s) + 1 for s in source])
    at = np.arange(size.sum()) + np.repeat(np.arange(len(size)) * (CONTEXT - 1), size)
    return flat[at[:, None] + np.arange(CONTEXT)]


class Model:
    """Input vectors, position vectors, target vectors and biases."""

    def __init__(self, r: np.ndarray, c: np.ndarray, q: np.ndarray, b: np.ndarray):
        self.parts = [r, c, q, b]

    @classmethod
    def fresh(cls, vocab: Vocabulary, seed: int = 9) -> Model:
        rng = np.random.RandomState(seed)
        draw = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
        return cls(draw(vocab.n_input + CLASSES + 1, DIM), np.ones((CONTEXT, DIM), np.float32) / CONTEXT,
                   draw(len(vocab.noise), DIM), np.log(vocab.noise).astype(np.float32))

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts])

    def like(self, flat: np.ndarray) -> Model:
        ends = np.cumsum([p.size for p in self.parts])
        return Model(*[x.reshape(p.shape).astype(np.float32) for x, p in zip(np.split(flat, ends[:-1]), self.parts)])

    def log10_probabilities(self, ctx: np.ndarray, target: np.ndarray, block: int = 2048) -> np.ndarray:
        """Of each target after its context, normalised over all targets."""
        r, c, q, b = self.parts
        placed = r[None] * c[:, None]                             # input vectors by position
        full = np.concatenate([q, b[:, None]], axis=1).T.copy()   # the bias as one more column
        ones = np.ones(len(q), np.float32)
        out = np.empty(len(target))
        for lo in range(0, len(target), block):
            t, at = target[lo:lo + block], ctx[lo:lo + block]
            hat = np.ones((len(t), DIM + 1), np.float32)
            hat[:, :DIM] = placed[0][at[:, 0]]
            for k in range(1, CONTEXT):
                hat[:, :DIM] += placed[k][at[:, k]]
            scores = hat @ full
            top = scores.max()
            if top - scores.min() > 60:                           # else float32 holds all exponentials
                top = scores.max(axis=1, keepdims=True)
            scores -= top
            own = scores[np.arange(len(t)), t].astype(np.float64)
            np.exp(scores, out=scores)
            out[lo:lo + block] = own - np.log((scores @ ones).astype(np.float64))
        return out / np.log(10)


def _add_rows(size: int, at: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """An array of ``size`` rows: the sums of ``rows`` by their place ``at``."""
    out = np.empty((size, rows.shape[1]), np.float32)
    for k in range(rows.shape[1]):
        out[:, k] = np.bincount(at, rows[:, k], size)
    return out


class Trainer:
    """Noise-contrastive steps with Adagrad, from given parameters."""

    def __init__(self, model: Model, noise: np.ndarray, seed: int):
        self.model, self.p = model, noise
        self.log_kp = np.log(NOISE * noise).astype(np.float32)
        self.rng = np.random.RandomState(seed)
        self.squares = [np.full(p.shape, 1e-3, np.float32) for p in model.parts]
        self.cum = np.cumsum(noise)

    def _move(self, i: int, gradient: np.ndarray) -> None:
        self.squares[i] += gradient * gradient
        self.model.parts[i] += np.float32(RATE) * gradient / np.sqrt(self.squares[i])

    def step(self, ctx: np.ndarray, target: np.ndarray) -> None:
        r, c, q, b = self.model.parts
        n = np.float32(len(target))
        at = ctx.T.ravel()
        rows = r.take(at, axis=0).reshape(CONTEXT, len(target), DIM)
        hat = rows[0] * c[0]
        for k in range(1, CONTEXT):
            hat += rows[k] * c[k]
        noise = np.minimum(np.searchsorted(self.cum, self.rng.random_sample(NOISE)), len(self.cum) - 1)
        mine, theirs = q[target], q[noise]
        own = np.einsum("td,td->t", hat, mine) + (b - self.log_kp)[target]
        other = hat @ theirs.T
        other += (b - self.log_kp)[noise]
        with np.errstate(over="ignore"):                               # 1 / (1 + inf) is 0
            up = (1 / (1 + np.exp(own)))[:, None]                      # 1 - P(from the data)
            np.negative(other, out=other)
            np.exp(other, out=other)
        other += 1
        down = np.divide(-1, other, out=other)
        dhat = up * mine
        dhat += down @ theirs
        both = np.concatenate([target, noise])                         # targets and noise move alike
        dq = _add_rows(len(q), both, np.concatenate([up * hat, down.T @ hat]))
        db = np.bincount(both, np.concatenate([up[:, 0], down.sum(axis=0)]), len(b))
        dc = np.stack([np.einsum("td,td->d", rows[k], dhat) for k in range(CONTEXT)])
        dr = _add_rows(len(r), at, (dhat[None] * c[:, None]).reshape(-1, DIM))
        for i, g in enumerate((dr, dc, dq, db)):
            self._move(i, (g / n).astype(np.float32))

    def texts(self, vocab: Vocabulary, codes: list[np.ndarray]) -> int:
        """Goes over the texts, given as codes of their words, once; returns their tokens."""
        if not codes:
            return 0
        ctx, target = vocab.tokens(codes)
        mixed = self.rng.permutation(len(target))
        for lo in range(0, len(mixed), BATCH):
            self.step(ctx[mixed[lo:lo + BATCH]], target[mixed[lo:lo + BATCH]])
        return len(target)


def text_groups(texts: list, size: int = 1 << 19) -> Iterator[slice]:
    """Slices of a list of texts, as codes, of about ``size`` words each."""
    lo, n = 0, 0
    for i, t in enumerate(texts):
        n += len(t)
        if n >= size or i == len(texts) - 1:
            yield slice(lo, i + 1)
            lo, n = i + 1, 0


def looked_up(rows: DataFrame, shared) -> DataFrame:
    """doc_id, held_out, codes of the words (32 bits each), words that are not frequent and
    how often each occurs; training and scoring both read these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = shared.value
        for batch in batches:
            codes, rare = [], []
            for text in batch.column("text"):
                w = words(text.as_py())
                code = vocab.codes(w)
                codes.append(code.astype("<i4").tobytes())
                rare.append(Counter(w[i] for i in np.flatnonzero(code < 0).tolist()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(codes, pa.binary()),
                 pa.array([list(c.keys()) for c in rare], pa.list_(pa.binary())), pa.array([list(c.values()) for c in rare], pa.list_(pa.int64()))],
                names=["doc_id", "held_out", "codes", "rare", "times"])

    return rows.mapInArrow(run, "doc_id long, held_out boolean, codes binary, rare array<binary>, times array<long>")


def _codes(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x, "<i4") for x in column.to_pylist()]


def train(docs: DataFrame, coded: DataFrame, vocab: Vocabulary) -> Model:
    """Parameters learned from all of ``coded`` (column codes), starting from a sample of
    ``docs`` (columns doc_id, text)."""
    spark = docs.sparkSession
    # the rows of the lowest hashes: found by hash alone, so that no task sends its own first texts
    mark = F.xxhash64("doc_id", "text")
    upto = docs.select(mark.alias("h")).orderBy("h").limit(WARM_DOCS).agg(F.max("h")).first()[0]
    warm = [r["text"] for r in docs.where(mark <= upto).select("text").limit(WARM_DOCS).collect()] if upto is not None else []
    warm = [vocab.codes(words(t)) for t in sorted(warm)]
    trainer = Trainer(Model.fresh(vocab), vocab.noise, 1)
    steps = 0
    while warm and steps < WARM_STEPS:
        for part in text_groups(warm):
            steps += -(-trainer.texts(vocab, warm[part]) // BATCH)
    begin = trainer.model.flat()
    shared = spark.sparkContext.broadcast((vocab, begin))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, begin = shared.value
        mine, n = Trainer(Model.fresh(vocab).like(begin), vocab.noise, 2), 0
        for batch in batches:
            codes = _codes(batch.column(0))
            for part in text_groups(codes):
                n += mine.texts(vocab, codes[part])
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([(mine.model.flat() * np.float64(n)).tobytes()], pa.binary())], names=["n", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(len(shared.value[1]))
        for batch in batches:
            for k, raw in zip(batch.column("n").to_pylist(), batch.column("sums").to_pylist()):
                n, total = n + k, total + np.frombuffer(raw)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["n", "sums"])

    fields = "n long, sums binary"
    parts = coded.select("codes").mapInArrow(learn, fields).repartition(16).mapInArrow(add, fields).collect()     # at most 16 rows
    n = sum(r["n"] for r in parts)
    return trainer.model.like(sum(np.frombuffer(r["sums"]) for r in parts) / n) if n else trainer.model


def frequent_words(counts: DataFrame, most: int) -> list[tuple[bytes, int]]:
    """The words with the highest counts, at most ``most``, by rank: all words from that
    count on which the number of words allows, so that only they go to the driver."""
    steps = counts.groupBy("c").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") <= most)    # few different counts
    upto = steps.select("c", F.sum("n").over(Window.orderBy(F.desc("c"))).alias("n"))
    least = upto.where(F.col("n") <= most).agg(F.min("c")).first()[0]
    crowded = counts.groupBy("c").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most).agg(F.max("c")).first()[0]
    if least is None:
        return []
    found = counts.where(F.col("c") >= max(least, (crowded or 0) + 1)).select("word", "c").toArrow()
    return sorted(zip(found["word"].to_pylist(), found["c"].to_pylist()), key=lambda x: (-x[1], x[0]))


def score_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: one row per document."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), (crc32_mod(doc_id, 5) == 1).alias("held_out"), text_or_empty(text).alias("text"))
    learn = rows.where(~F.col("held_out"))
    counts = written(count_words(learn), "counts")
    cls = F.pmod(F.crc32(F.expr("substring(word, greatest(length(word) - 2, 1), 3)")), F.lit(CLASSES))
    facts = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    total, distinct = int(facts[0]), int(facts[1])
    ends = counts.where(F.col("word") == F.lit(bytearray(END))).agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    only = counts.where(F.col("word") != F.lit(bytearray(END)))
    frequent = frequent_words(only, FREQUENT)
    tokens, kinds = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in only.groupBy(cls.alias("k")).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect():
        tokens[r["k"]], kinds[r["k"]] = r["c"], r["v"]
    for w, c in frequent[:SHORT]:                           # these are targets of their own
        tokens[word_class(w)] -= c
        kinds[word_class(w)] -= 1
    vocab = Vocabulary(frequent, int(ends), total, distinct, tokens, kinds)
    coded = written(looked_up(rows, spark.sparkContext.broadcast(vocab)).withColumn("row", F.monotonically_increasing_id()), "codes")
    shared = spark.sparkContext.broadcast((vocab, train(learn, coded.where(~F.col("held_out")), vocab).flat()))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, flat = shared.value
        model = Model.fresh(vocab).like(flat)
        known = vocab.ends > 0
        for batch in batches:
            all_codes = _codes(batch.column("codes"))
            out = []
            for part in text_groups(all_codes):
                codes = all_codes[part]
                log_p = model.log10_probabilities(*vocab.tokens(codes))
                at = 0
                for code in codes:
                    n, seen, other = len(code), code[code >= 0], code[code < 0]
                    base = vocab.base[seen].sum() + vocab.end_base - len(other) * vocab.log_all
                    own = log_p[at:at + n + 1].sum() + (vocab.tail[seen].sum() if len(seen) else 0.0) - vocab.log_class[-1 - other].sum()
                    out.append((n + 1, len(seen) + known, float(base), float(own)))
                    at += n + 1
            cols = list(zip(*out)) if out else [()] * 4
            types = (pa.int64(), pa.int64(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keys] + [pa.array(c, k) for c, k in zip(cols, types)], names=names)

    keys = ["row", "doc_id", "held_out"]
    names = keys + ["n_tokens", "known", "base", "own"]
    part = coded.select(*keys, "codes").mapInArrow(score, "row long, doc_id long, held_out boolean, n_tokens long, known long, base double, own double")
    each = coded.select("row", F.explode(F.arrays_zip("rare", "times")).alias("s")).select("row", F.col("s.rare").alias("word"), F.col("s.times").alias("times"))
    # words that are not in the counts at all stay without a partner
    found = (each.join(counts, "word", "left").groupBy("row")
             .agg(F.sum(F.col("times") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("logs"),
                  F.sum(F.when(F.col("c").isNotNull(), F.col("times")).otherwise(0)).alias("more")))
    none = lambda c: F.coalesce(c, F.lit(0))
    return (part.join(found, "row", "left")
            .select("doc_id", "held_out", "n_tokens", (F.col("known") + none("more")).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
                    (F.col("base") + none("logs")).alias("base_score"), (F.col("own") + none("logs")).alias("score")))
