"""Operator 8: language identification by scripts, word scores and Viterbi.

The script ranges of a word's letters narrow its candidates to the languages that were seen in that
script. A word's score for a language is the log-probability of its character trigrams, hashed into
a table of set size, plus that of the word itself where it was seen. A Viterbi search over the words,
with a penalty for each change of language, labels spans of mixed-language text; the language
whose spans hold the most words is the document's.

Most texts have one language. The search is skipped where it can't change anything: if no stretch of
words gains more than the penalty by leaving the best language, the best path stays in it.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelyard.llm.common import held_out, pieces

#: First and last code point of the letters of each script (fixed values, coarse Unicode blocks).
SCRIPTS = {
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xAA, 0x24F), (0x1E00, 0x1EFF)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F)],
    "devanagari": [(0x900, 0x97F)],
    "thai": [(0xE00, 0xE7F)],
    "hangul": [(0x1100, 0x11FF), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF)],
}
UNKNOWN = "und"
#: Words are runs of letters with the marks that belong to them; the first pattern serves texts of Latin-1.
LATIN_WORD = re.compile("[A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff]+")
WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
BUCKETS = 1 << 16


def words_of(text: str | None) -> list[str]:
    """The words of a whole text: letters as Unicode has them, no digits or other numerals."""
    if not text:
        return []
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return WORD.findall(text)
    return LATIN_WORD.findall(text)


def script(word: str) -> str:
    c = ord(word[0])
    if c < 0x250:
        return "latin"
    for name, ranges in SCRIPTS.items():
        if any(a <= c <= b for a, b in ranges):
            return name
    return "other"


def grams(word: str) -> list[int]:
    """Buckets of a word's character trigrams, with its edges, and of the word itself."""
    w = f"^{word.lower()}$"
    crc = zlib.crc32
    out = [crc(w[i : i + 3].encode()) % BUCKETS for i in range(len(w) - 2)]
    out.append(crc(b"\x00" + w.encode()) % BUCKETS)
    return out


@dataclass
class LanguageModel:
    """langs sorted; logp[bucket, lang] (relative to the best language); level[bucket], the best language's
    own log-probability over that of a text without any preference; seen[script] = languages."""

    langs: list[str]
    logp: np.ndarray
    seen: dict[str, np.ndarray]
    prior: np.ndarray
    level: np.ndarray
    penalty: float = 8.0
    cache: int = 300_000
    clip: float = 6.0
    words: dict[str, int] = field(default_factory=dict, repr=False)
    table: np.ndarray | None = field(default=None, repr=False)
    fits: np.ndarray | None = field(default=None, repr=False)
    used: int = 0

    def _rows(self, words: list[str]) -> np.ndarray:
        """Scores of the words for each language."""
        return self._judged(words)[0]

    def _judged(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Scores of the words for each language, and whether each fits some learned one."""
        scores, fits = [], []
        for at in range(0, len(words), 100_000):
            places = self._places(words[at : at + 100_000])
            scores.append(self.table[places])
            fits.append(self.fits[places])
        return (scores[0], fits[0]) if len(scores) == 1 else (np.concatenate(scores), np.concatenate(fits))

    def _places(self, words: list[str]) -> list[int]:
        """Places of the words in the tables of scores and fits; new words are scored first."""
        get = self.words.get
        rows = [*map(get, words)]
        if None in rows:
            new = [*{w for w, r in zip(words, rows) if r is None}]
            if self.table is None or self.used + len(new) > len(self.table):
                if self.used + len(new) > self.cache:
                    self.words.clear()
                    self.used, new = 0, [*set(words)]
                size = max(2 * (self.used + len(new)), 4096)
                table = np.zeros((size, len(self.langs)), np.float32)
                if self.used:
                    table[: self.used] = self.table[: self.used]
                fits = np.zeros(size, bool)
                if self.used:
                    fits[: self.used] = self.fits[: self.used]
                self.table, self.fits = table, fits
            found = [grams(w) for w in new]
            n = np.fromiter(map(len, found), np.int64, len(found))
            flat = np.fromiter((b for f in found for b in f), np.int64, int(n.sum()))
            starts = np.concatenate(([0], np.cumsum(n)[:-1]))
            score = np.add.reduceat(self.logp[flat], starts, axis=0)
            score -= score.max(1, keepdims=True)
            np.maximum(score, -self.clip, out=score)
            fit = np.add.reduceat(self.level[flat], starts) > 0
            for i, w in enumerate(new):
                mask = self.seen.get("latin" if w.isascii() else script(w))
                if mask is None or not mask.any():
                    score[i], fit[i] = 0.0, False  # a script that no language was seen in
                elif not mask.all():
                    score[i, ~mask] = -2 * self.clip
            self.fits[self.used : self.used + len(new)] = fit
            self.table[self.used : self.used + len(new)] = score
            self.words.update(zip(new, range(self.used, self.used + len(new))))
            self.used += len(new)
            rows = [*map(self.words.__getitem__, words)]
        return rows

    def spans(self, text: str | None) -> list[tuple[int, int, int]]:
        """(first word, end word, language) of the best path; empty where there is no letter."""
        words = words_of(text)
        return self._path(self._rows(words)) if words else []

    def _path(self, scores: np.ndarray) -> list[tuple[int, int, int]]:
        gains = scores.astype(np.float64)
        totals = gains.sum(0) + self.prior
        best = int(totals.argmax())
        lead = gains.max(1) - gains[:, best]
        run = np.concatenate(([0.0], np.cumsum(lead)))
        # any stretch that leaves `best` gains at most what lead sums to in it, and pays the penalty
        if run[-1] < self.penalty or self._most(gains, best) < self.penalty:
            return [(0, len(gains), best)]
        return self._viterbi(gains)

    def _most(self, gains: np.ndarray, best: int) -> float:
        """The largest gain of a stretch over `best`, taking the best other language at each word."""
        other = np.delete(gains, best, axis=1)
        if not other.shape[1]:
            return 0.0
        run = np.concatenate(([0.0], np.cumsum(other.max(1) - gains[:, best])))
        return float((run - np.minimum.accumulate(run)).max())

    def _viterbi(self, gains: np.ndarray) -> list[tuple[int, int, int]]:
        n, k = gains.shape
        back = np.empty((n, k), np.int16)
        rows = gains.tolist()
        score = [s + p for s, p in zip(rows[0], self.prior.tolist())]
        stay = list(range(k))
        for t in range(1, n):
            top = max(score)
            at = score.index(top)
            top -= self.penalty
            came = stay
            if min(score) < top:
                came = [at if s < top else i for i, s in enumerate(score)]
                score = [top if s < top else s for s in score]
            back[t] = came
            score = [s + g for s, g in zip(score, rows[t])]
        now = score.index(max(score))
        out, end = [], n
        for t in range(n - 1, 0, -1):
            before = int(back[t, now])
            if before != now:
                out.append((t, end, now))
                end, now = t, before
        out.append((0, end, now))
        return out[::-1]

    def predict(self, text: str | None) -> tuple[str, float, list[tuple[int, int, str]]]:
        """Language, score and the spans. The score is the share of the words that lie in the language's
        spans and fit some learned language: whose trigrams are likelier there than without any
        preference, in a script that was learned."""
        words = words_of(text)
        if not words:
            return UNKNOWN, 0.0, []
        scores, fits = self._judged(words)
        spans = self._path(scores)
        held = np.zeros(len(self.langs))
        for a, b, lang in spans:
            held[lang] += b - a
        best = int(held.argmax())
        fitting = sum(int(np.count_nonzero(fits[a:b])) for a, b, lang in spans if lang == best)
        return self.langs[best], fitting / len(words), [(a, b, self.langs[x]) for a, b, x in spans]


def bounded(rows: DataFrame, id_col: str, at_most: int, count: int) -> DataFrame:
    """About at_most rows by a hash of the id, or all where there are fewer; the same in each run."""
    if count <= at_most:
        return rows
    cut = int(at_most / count * (1 << 30))
    return rows.where(F.pmod(F.xxhash64(F.col(id_col), F.lit(8)), F.lit(1 << 30)) < cut)


def fit(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    sample_rows: int = 20_000, most_langs: int = 500, smoothing: float = 0.3,
) -> LanguageModel:
    """Learns from text and non-null lang of rows that aren't held out, about sample_rows of them.

    Every language has the same bound, sample_rows over the number of languages, and a language of fewer
    rows gives all of them: the learned languages are the same at any size. The trigram counts are
    summed by Spark; the driver gets at most BUCKETS rows for each language (at most_langs languages,
    33 million rows of four numbers, and a model of 131 MB), and the model is what is broadcast.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")
    ).where("lang is not null and text is not null")
    rows = rows.where(~held_out("doc_id"))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).limit(most_langs + 1).collect()}
    if len(sizes) > most_langs:
        raise ValueError(f"more than {most_langs} languages")
    each = max(1, sample_rows // max(len(sizes), 1))
    cuts = docs.sparkSession.createDataFrame([(x, min(1 << 30, each * (1 << 30) // n)) for x, n in sizes.items()], "lang_ string, cut long")
    draw = F.pmod(F.xxhash64("doc_id", F.lit(8)), F.lit(1 << 30))
    sample = rows.join(F.broadcast(cuts), F.col("lang") == F.col("lang_")).where(draw < F.col("cut")).select("lang", "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[str, str, int], int] = Counter()
        for whole in batches:
            for b in pieces(whole):
                words: dict[str, Counter] = {}
                for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    words.setdefault(lang, Counter()).update(words_of(text))
                for lang, of in words.items():
                    for w, n in of.items():
                        counts[lang, "s:" + script(w), 0] += n
                        for g in grams(w):
                            counts[lang, "g", g] += n
        keys = [*counts]
        for i in range(0, len(keys), 100_000):
            part = keys[i : i + 100_000]
            lang, kind, bucket = zip(*part)
            yield pa.RecordBatch.from_arrays(
                [pa.array(lang, pa.string()), pa.array(kind, pa.string()), pa.array(bucket, pa.int64()), pa.array([counts[k] for k in part], pa.int64())],
                ["lang", "kind", "bucket", "n"],
            )

    counted = sample.select("lang", "text").mapInArrow(work, "lang string, kind string, bucket long, n long")
    got = counted.groupBy("lang", "kind", "bucket").agg(F.sum("n").alias("n")).toArrow()
    return build(got.column("lang").to_pylist(), got.column("kind").to_pylist(), got.column("bucket").to_pylist(), got.column("n").to_pylist(), smoothing, most_langs)


def build(lang: list[str], kind: list[str], bucket: list[int], n: list[int], smoothing: float = 0.3, most_langs: int = 500) -> LanguageModel:
    langs = sorted(set(lang))
    if len(langs) > most_langs:
        raise ValueError(f"more than {most_langs} languages")
    place = {x: i for i, x in enumerate(langs)}
    counts = np.zeros((BUCKETS, len(langs)))
    scripts: dict[str, np.ndarray] = {}
    for x, k, b, c in zip(lang, kind, bucket, n):
        if k == "g":
            counts[b, place[x]] += c
        else:
            scripts.setdefault(k[2:], np.zeros(len(langs)))[place[x]] += c
    total = counts.sum(0)
    logp = np.log((counts + smoothing) / (total + smoothing * BUCKETS)) if langs else counts
    level = np.zeros(BUCKETS)
    if langs:
        level = logp.max(1) + np.log(BUCKETS)
        logp -= logp.max(1, keepdims=True)
    words = sum(scripts.values()) if scripts else np.zeros(len(langs))
    seen = {s: c >= 0.001 * np.maximum(words, 1) for s, c in scripts.items()}
    return LanguageModel(langs, logp.astype(np.float32), seen, np.zeros(len(langs)), level)


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text", with_spans: bool = True) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score (0 to 1), and with_spans the spans as
    array<struct<first_word, end_word, lang>>.

    lang_pred is `und` and score 0 where the text is null, empty or without a letter, or the model has
    no language. A text in a script that no language was seen in has a learned language and score 0. Ties go to the language first by name. Very long texts are read whole; repeated rows
    stay; null ids aren't held out. Other columns are not read, whatever their names. Narrow.
    """
    key = docs.select(F.col(id_col)).schema[0].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS x languages floats
    span = pa.list_(pa.struct([("first_word", pa.int64()), ("end_word", pa.int64()), ("lang", pa.string())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for whole in batches:
            for b in pieces(whole):
                texts = b.column(1).to_pylist()
                got = [m.predict(t) if m.langs else (UNKNOWN, 0.0, []) for t in texts]
                cols = [b.column(0), b.column(2), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())]
                names = ["doc_id", "held_out", "lang_pred", "score"]
                if with_spans:
                    cols.append(pa.array([[{"first_word": a, "end_word": e, "lang": x} for a, e, x in g[2]] for g in got], span))
                    names.append("spans")
                yield pa.RecordBatch.from_arrays(cols, names)

    out = f"doc_id {key}, held_out boolean, lang_pred string, score double" + (
        ", spans array<struct<first_word: long, end_word: long, lang: string>>" if with_spans else ""
    )
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).select(
        "doc_id", "text", held_out("doc_id").alias("held_out")
    ).mapInArrow(work, out)


def keep(docs: DataFrame, model: LanguageModel, least: float, text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns, whose language has a score of at least `least`.

    Null and empty texts, texts without a letter and texts that fit no learned language go; repeated
    rows are judged alike; other columns may have any names. Without a learned language nothing can be
    rejected. An empty table gives an empty table. Narrow: one pass."""
    if not model.langs:
        return docs
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for whole in batches:
            at = whole.schema.get_field_index(text_col)
            for b in pieces(whole, at):
                got = [m.predict(t)[:2] for t in b.column(at).to_pylist()]
                yield b.filter(pa.array([lang != UNKNOWN and s >= least for lang, s in got]))

    return docs.mapInArrow(judge, docs.schema)
