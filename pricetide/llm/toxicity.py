"""Operator 2: toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary and one on toxic text, and every
text is cut into windows of a few words.  A window that is shorter when compressed with
the toxic dictionary speaks for toxicity: by how much is read off a table of log
likelihood ratios per saved byte (the calibrated thresholds).  The windows of the whole
text that are telling, their evidence and number against the number of all windows, go
through a logistic curve.

The toxic dictionary goes on where the ordinary one ends, so that both say the same of
ordinary prose.  Its own part is trained on words of toxic texts, those with byte runs
that toxic texts hold far more often than ordinary ones.

The labelled rows for training are a bounded sample (``MOST_TOXIC`` and
``MOST_ORDINARY`` rows, those of the lowest hash of their id); dictionaries, ratio table
and curve are each fitted on parts of their own.  Only the text is an input of a score.

A null or empty text has no windows and gets the score of the curve without evidence.  Without
labels of both kinds all scores are the share of toxic labels (0.5 without any).
Repeated rows get equal scores.  An empty table gives no rows.  Extra columns are not
looked at (``drop_toxic`` keeps them).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard as zs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricetide.llm.common import crc32_mod, text_or_empty

MOST_TOXIC, MOST_ORDINARY = 2000, 4000
WINDOW_WORDS = 2
WORD_CHARS = 32                    # longer words are cut, so that a text without spaces has windows too
ORDINARY_BYTES, TOXIC_BYTES = 1 << 19, 1 << 13
TELLING, STRONG = 1.0, 3.0         # least log likelihood ratios of windows that count
MOST_KNOWN = 150_000               # windows whose result a worker keeps
LOW, HIGH = -6, 16                 # saved bytes that the table tells apart
_PAD = b"\n" * 40                  # keeps windows from being stored as they are
_GRAM = 5


def windows(text: str | None, n: int = WINDOW_WORDS) -> list[bytes]:
    """Runs of ``n`` words of a text."""
    w = (text or "").lower().split()
    if any(len(x) > WORD_CHARS for x in w):
        w = [x[i:i + WORD_CHARS] for x in w for i in range(0, len(x), WORD_CHARS)]
    return [f" {' '.join(w[i:i + n])} ".encode("utf-8", "replace") for i in range(0, len(w), n)]


def _compressor(content: bytes) -> zs.ZstdCompressor:
    params = zs.ZstdCompressionParameters(
        strategy=zs.STRATEGY_LAZY2, min_match=4, window_log=20, hash_log=17, chain_log=17, search_log=6,
        target_length=32, write_content_size=False, write_checksum=False, write_dict_id=False)
    d = zs.ZstdCompressionDict(content, dict_type=zs.DICT_TYPE_RAWCONTENT)
    d.precompute_compress(compression_params=params)
    return zs.ZstdCompressor(compression_params=params, dict_data=d)


def _dictionary(size: int, samples: list[bytes], k: int, d: int) -> bytes:
    """A dictionary trained on the samples; the samples themselves where they are too few."""
    if sum(map(len, samples)) > 4 * size:
        try:
            return zs.train_dictionary(size, samples, k=k, d=d).as_bytes()
        except zs.ZstdError:                      # e.g. nothing repeats
            pass
    return b"".join(samples)[-size:] or b" " * 8


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes                   # the part that follows the ordinary dictionary
    ratio: np.ndarray              # log likelihood ratio for LOW .. HIGH saved bytes
    weights: np.ndarray            # of the logistic curve, the last one is its offset

    def saved(self) -> Callable[[list[bytes]], np.ndarray]:
        """Bytes by which the toxic dictionary shortens each window.  The results of the
        first ``MOST_KNOWN`` different windows are kept: frequent ones come early."""
        plain, toxic = _compressor(self.ordinary).compress, _compressor(self.ordinary + self.toxic).compress
        known = _known_windows(self.ordinary, self.toxic)

        def one(window: bytes) -> int:
            d = known.get(window)
            if d is None:
                padded = window + _PAD
                d = len(plain(padded)) - len(toxic(padded))
                if len(known) < MOST_KNOWN:
                    known[window] = d
            return d
        return lambda ws: np.fromiter(map(one, ws), np.int64, len(ws))

    def features(self, diff: np.ndarray) -> np.ndarray:
        """Evidence of the telling windows and their number, against all windows."""
        ratio = self.ratio[np.clip(diff, LOW, HIGH) - LOW]
        strong = int((ratio >= STRONG).sum())
        return np.array([np.log1p(ratio[ratio >= TELLING].sum()), np.log1p(len(diff)), strong / np.sqrt(len(diff) + 1), min(strong, 3), 1.0])

    def scorer(self) -> Callable[[str | None], float]:
        if not len(self.ratio):                   # labels of one kind only
            return lambda text: float(self.weights[0])
        diff = self.saved()
        return lambda text: float(1 / (1 + np.exp(-np.clip(self.features(diff(windows(text))) @ self.weights, -500, 500))))


@lru_cache(maxsize=1)
def _known_windows(ordinary: bytes, toxic: bytes) -> dict[bytes, int]:
    return {}


def _ratios(toxic: np.ndarray, ordinary: np.ndarray) -> np.ndarray:
    a, b = (np.bincount(np.clip(x, LOW, HIGH) - LOW, minlength=HIGH - LOW + 1) + 0.5 for x in (toxic, ordinary))
    return np.log(a / a.sum()) - np.log(b / b.sum())


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights of a logistic curve by Newton's method; the last column of ``x`` is 1."""
    scale = np.abs(x).max(axis=0) + 1e-9
    z, w = x / scale, np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        w += np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w)), z.T @ (y - p) - ridge * w)
    return w / scale


def _typical_runs(toxic: list[list[bytes]], ordinary: list[list[bytes]]) -> set[bytes]:
    """Byte runs in at least 1 of 50 toxic texts (and 3 of them) and 40 times as many as ordinary ones."""
    def found_in(texts: list[list[bytes]]) -> Counter:
        c: Counter = Counter()
        for ws in texts:
            c.update({w[i:i + _GRAM] for w in ws for i in range(len(w) - _GRAM + 1)})
        return c
    a, b = found_in(toxic), found_in(ordinary)
    least = max(3, len(toxic) // 50)
    return {g for g, n in a.items() if n >= least and n / len(toxic) >= 40 * (b[g] + 0.5) / len(ordinary)}


def fit(texts: list[str], toxic: list[int]) -> Model:
    """A model from labelled texts (the bounded sample)."""
    known = [[t for t, y in zip(texts, toxic) if y == kind] for kind in (0, 1)]
    if not known[0] or not known[1]:
        return Model(b"", b"", np.zeros(0), np.array([np.mean(toxic) if toxic else 0.5]))
    # parts 0 and 1 make the dictionaries, part 2 the table, part 3 the curve
    part = lambda kind, k, n: [windows(t, n) for t in known[kind][k::4] or known[kind]]
    learn = [part(0, 0, 1) + part(0, 1, 1), part(1, 0, 1) + part(1, 1, 1)]
    ordinary = _dictionary(ORDINARY_BYTES, [w for ws in learn[0] for w in ws], 16, 6)
    typical = _typical_runs(learn[1], learn[0])
    mine = [w for ws in learn[1] for w in ws]
    chosen = [w for w in mine if any(w[i:i + _GRAM] in typical for i in range(len(w) - _GRAM + 1))] or mine
    model = Model(ordinary, _dictionary(TOXIC_BYTES, chosen, 50, 8), np.zeros(0), np.zeros(0))
    diff = model.saved()
    flat = lambda kind: np.concatenate([diff(ws) for ws in part(kind, 2, WINDOW_WORDS)])
    model.ratio = _ratios(flat(1), flat(0))
    x = [np.array([model.features(diff(ws)) for ws in part(kind, 3, WINDOW_WORDS)]) for kind in (0, 1)]
    model.weights = _logistic(np.concatenate(x), np.repeat([0.0, 1.0], [len(x[0]), len(x[1])]))
    return model


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Model:
    """Fits on labelled documents that are not held out (crc32 of the id, mod 5, is not 0)."""
    marks = (labels.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic"))
             .where("id IS NOT NULL AND toxic IN (0, 1)").where(crc32_mod("id", 5) != 0)
             .groupBy("id").agg(F.max("toxic").alias("toxic")))
    known = marks.join(docs.select(F.col(doc_id).cast("long").alias("id")), "id", "left_semi")
    first = lambda kind, most: known.where(F.col("toxic") == kind).orderBy(F.xxhash64("id"), "id").limit(most)
    sample = first(1, MOST_TOXIC).unionByName(first(0, MOST_ORDINARY))
    rows = (docs.select(F.col(doc_id).cast("long").alias("id"), text_or_empty(text).alias("text"))
            .join(F.broadcast(sample), "id").groupBy("id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic"))
            .orderBy(F.xxhash64("id"), "id").collect())
    return fit([r["text"] for r in rows], [r["toxic"] for r in rows])


def score_documents(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted: one row per document, from its whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = model.scorer()
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"),
                 pa.array([score(t) for t in batch.column("text").to_pylist()], pa.float64())], names=["doc_id", "held_out", "score"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), (crc32_mod(doc_id, 5) == 0).alias("held_out"), text_or_empty(text).alias("text"))
    return (rows.mapInArrow(run, "doc_id long, held_out boolean, score double")
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def drop_toxic(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The documents with a score below 0.5, with all their columns."""
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = model.scorer()
        for batch in batches:
            yield batch.filter(pa.array([score(t) < 0.5 for t in batch.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
