"""Operator 10: a quality classifier, a factorisation machine.

Features of a text: its hashed words (counts scaled to length 1), statistics of its structure cut
into bins, and its length as metadata. The machine adds to a linear score all pairwise interactions
of features through vectors of low rank; with the identity
sum_{i<j} <v_i, v_j> x_i x_j = (|sum_i v_i x_i|^2 - sum_i |v_i|^2 x_i^2) / 2
a text is scored in time linear in its distinct words.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelyard.llm.common import held_out, pieces

WORD_BUCKETS = 1 << 15
BINS = 12
#: Marks that end or stand in ordinary prose.
PROSE_MARKS = set(".,;:!?'\"()-’“”«»¿¡…")
STATS = (
    "words", "distinct", "top_share", "upper", "odd_end", "no_letter", "digits", "mean_length", "long_words",
    "lines", "distinct_lines", "line_words", "marks", "double_marks", "symbols", "echoes",
)
FEATURES = WORD_BUCKETS + len(STATS) * BINS
_FLAGS = 9


def word_flags(w: str) -> tuple[float, ...]:
    letters = [c for c in w if c.isalpha()]
    odd = sum(1 for c in w if not c.isalnum() and c not in PROSE_MARKS)
    marks = sum(1 for c in w if c in PROSE_MARKS)
    return (
        float(len(letters) > 1 and all(c.isupper() for c in letters)),
        float(not w[-1].isalnum() and w[-1] not in PROSE_MARKS),
        float(not letters),
        float(any(c.isdigit() for c in w)),
        float(len(w)),
        float(len(w) > 20),
        float(marks),
        float(len(w) > 1 and w[-1] == w[-2] and not w[-1].isalnum()),
        float(odd),
    )


class Words:
    """Bucket and flags of words, remembered for at most `cache` of them."""

    def __init__(self, cache: int = 300_000) -> None:
        self.cache, self.of = cache, {}
        self.bucket = np.zeros(4096, np.int64)
        self.flags = np.zeros((4096, _FLAGS))

    def rows(self, words: list[str]) -> np.ndarray:
        out = [*map(self.of.get, words)]
        if None in out:
            if len(self.of) + len(words) > self.cache:
                self.of.clear()
            new = [w for w in words if w not in self.of]
            at, end = len(self.of), len(self.of) + len(new)
            if end > len(self.bucket):
                self.bucket = np.resize(self.bucket, 2 * end)
                grown = np.zeros((2 * end, _FLAGS))
                grown[:at] = self.flags[:at]
                self.flags = grown
            self.bucket[at:end] = [zlib.crc32(w.lower().encode()) % WORD_BUCKETS for w in new]
            self.flags[at:end] = [word_flags(w) for w in new]
            self.of.update(zip(new, range(at, end)))
            out = [*map(self.of.__getitem__, words)]
        return np.array(out, np.int64)


def features(text: str | None, known: Words) -> tuple[np.ndarray, np.ndarray]:
    """Indices (some may repeat) and values of a whole text's features."""
    text = text or ""
    words = text.split()
    counts = Counter(words)
    n = len(words)
    lines = [x for x in text.split("\n") if x.strip()]
    stats = np.zeros(len(STATS))
    index, value = np.zeros(0, np.int64), np.zeros(0)
    if n:
        rows = known.rows([*counts])
        c = np.fromiter(counts.values(), np.float64, len(counts))
        upper, odd_end, no_letter, digits, length, long_, marks, double, odd = (c @ known.flags[rows] / n).tolist()
        stats[:] = (
            np.log2(n + 1) / 16, len(counts) / n, c.max() / n, upper, odd_end, no_letter, digits, min(length / 20, 1), long_ * 4,
            np.log2(len(lines) + 1) / 12, len(set(lines)) / len(lines), np.log2(n / len(lines) + 1) / 12, marks, double, odd,
            sum(map(eq, words, words[1:])) / n,
        )
        index = known.bucket[rows]
        value = 0.5 * c / np.sqrt(np.square(c).sum())
    place = np.minimum((np.clip(stats, 0, 1) ** 0.5 * BINS).astype(np.int64), BINS - 1)
    at = WORD_BUCKETS + np.arange(len(STATS)) * BINS + place
    return np.concatenate((index, at)), np.concatenate((value, np.ones(len(STATS))))


@dataclass
class FactorisationMachine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray
    known: Words = field(default_factory=Words, repr=False)

    def __getstate__(self) -> dict:
        return {"bias": self.bias, "linear": self.linear, "factors": self.factors}

    def __setstate__(self, state: dict) -> None:
        self.__dict__ |= state
        self.known = Words()

    def raw(self, index: np.ndarray, value: np.ndarray) -> float:
        v = self.factors[index] * value[:, None]
        total = v.sum(0)
        return float(self.bias + self.linear[index] @ value + 0.5 * (total @ total - np.square(v).sum()))

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.raw(*features(text, self.known)), -30, 30))))


def train(
    rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, rank: int = 8, updates: int = 600, epochs: int = 6, batch: int = 32,
    rate: float = 0.1, decay: float = 3e-4, seed: int = 10,
) -> FactorisationMachine:
    """Logistic loss, AdaGrad, in an order drawn from the seed: `epochs` passes, or as many more (60 at
    most) as make about `updates` updates of few rows. No rows: a constant 0.5."""
    rng = np.random.default_rng(seed)
    linear, factors, bias = np.zeros(FEATURES), rng.normal(0, 0.02, (FEATURES, rank)), 0.0
    if not rows:
        return FactorisationMachine(0.0, linear, np.zeros_like(factors))
    share = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    bias = float(np.log(share / (1 - share)))
    g_linear, g_factors, g_bias = np.full(FEATURES, 1e-2), np.full((FEATURES, rank), 1e-2), 1e-2
    for _ in range(max(epochs, min(60, -(-updates * batch // len(rows))))):
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), batch):
            part = order[at : at + batch]
            index = np.concatenate([rows[i][0] for i in part])
            value = np.concatenate([rows[i][1] for i in part])
            n = np.array([len(rows[i][0]) for i in part])
            starts = np.concatenate(([0], np.cumsum(n)[:-1]))
            doc = np.repeat(np.arange(len(part)), n)
            v = factors[index] * value[:, None]
            total = np.add.reduceat(v, starts, axis=0)
            raw = bias + np.add.reduceat(linear[index] * value, starts) + 0.5 * (
                np.square(total).sum(1) - np.add.reduceat(np.square(v).sum(1), starts)
            )
            error = 1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[part]
            slope = (error / len(part))[doc] * value
            to_linear, to_factors = slope, slope[:, None] * (total[doc] - v)
            sort = np.argsort(index, kind="stable")
            unique, first = np.unique(index[sort], return_index=True)
            dl = np.add.reduceat(to_linear[sort], first) + decay * linear[unique]
            df = np.add.reduceat(to_factors[sort], first, axis=0) + decay * factors[unique]
            g_linear[unique] += dl**2
            g_factors[unique] += df**2
            linear[unique] -= rate * dl / np.sqrt(g_linear[unique])
            factors[unique] -= rate / 2 * df / np.sqrt(g_factors[unique])
            db = float(error.mean())
            g_bias += db * db
            bias -= rate * db / g_bias**0.5
    return FactorisationMachine(bias, linear, factors)


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    sample_rows: int = 12_000,
) -> FactorisationMachine:
    """Learns from about sample_rows labelled ids that aren't held out, chosen by a hash of the id.

    An id that is labelled more than once has its largest label; an id with several texts gives the
    first by code point, so the sample is bounded in rows however often a row repeats. The features are
    computed by Spark; the driver gets those of the sample alone.
    """
    from voxelyard.llm.langid import bounded

    marked = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("y")).where("y is not null and doc_id is not null")
    marked = marked.where(~held_out("doc_id")).groupBy("doc_id").agg(F.max("y").alias("y"))
    chosen = bounded(marked, "doc_id", sample_rows, marked.count())
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # chosen has at most about sample_rows rows of two numbers
    sample = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text")).select("doc_id", "y", "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words()
        for whole in batches:
            for b in pieces(whole, 2):
                got = [features(t, known) for t in b.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column(0), b.column(1),
                        pa.array([i.astype(np.int32) for i, _ in got], pa.list_(pa.int32())),
                        pa.array([v.astype(np.float32) for _, v in got], pa.list_(pa.float32())),
                    ],
                    ["doc_id", "y", "i", "v"],
                )

    key = texts.schema["doc_id"].dataType.simpleString()
    got = sample.mapInArrow(work, f"doc_id {key}, y int, i array<int>, v array<float>").toArrow()
    if not got.num_rows:
        return train([], np.zeros(0))
    i, v = got.column("i").combine_chunks(), got.column("v").combine_chunks()
    cuts = i.offsets.to_numpy()
    flat_i, flat_v = i.values.to_numpy(), v.values.to_numpy()
    ids, y = got.column("doc_id").to_pylist(), got.column("y").to_numpy().astype(float)
    # Spark may return rows in any order: training takes them by id
    order = sorted(range(len(ids)), key=lambda k: (ids[k], cuts[k + 1] - cuts[k], float(flat_v[cuts[k] : cuts[k + 1]].sum())))
    rows = [(flat_i[cuts[k] : cuts[k + 1]].astype(np.int64), flat_v[cuts[k] : cuts[k + 1]].astype(float)) for k in order]
    return train(rows, y[order])


def score(
    docs: DataFrame, model: FactorisationMachine, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7
) -> DataFrame:
    """Per row: doc_id, held_out, score (0 to 1, higher: label 1 likelier), predicted (0 or 1).

    Null and empty texts are scored by their statistics alone (all zero); very long texts are read
    whole; repeated rows stay; null ids aren't held out. Other columns are not read, whatever their
    names. Without a labelled row every score is 0.5. Narrow: no shuffle.
    """
    key = docs.select(F.col(id_col)).schema[0].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(model)  # FEATURES x (rank + 1) numbers

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for whole in batches:
            for b in pieces(whole):
                s = np.array([m.score(t) for t in b.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(2), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                    ["doc_id", "held_out", "score", "predicted"],
                )

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).select(
        "doc_id", "text", held_out("doc_id").alias("held_out")
    ).mapInArrow(work, f"doc_id {key}, held_out boolean, score double, predicted int")


def keep(docs: DataFrame, model: FactorisationMachine, least: float, text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns, whose text scores at least `least`. Null and empty texts are scored as in
    `score`; repeated rows are judged alike; other columns may have any names. Without a label known to the
    model nothing is judged and every row stays. Narrow: one pass."""
    if not model.linear.any() and not model.factors.any():
        return docs
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for whole in batches:
            at = whole.schema.get_field_index(text_col)
            for b in pieces(whole, at):
                yield b.filter(pa.array([m.score(t) >= least for t in b.column(at).to_pylist()]))

    return docs.mapInArrow(judge, docs.schema)
