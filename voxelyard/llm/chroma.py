"""Operator 9: chroma audio fingerprints and the alignment of recordings.

A recording's spectrum is folded to twelve pitch classes a frame. Sixteen filters over the image of
pitch classes by frames, each a difference of rectangles read from the integral image, are cut into
four levels, Gray-coded; the 32 bits of a frame are one packed integer. Two recordings are aligned
by how many bits agree at each offset. A coarse correlation of their bits, at all offsets at once by the
Fourier transform, rules most offsets out; at the others the differing bits are counted, and the share of
them decides. Nothing needs an integer to be equal, so noisy copies and copies cut off the frame
grid are found like any other.

Recordings with equal fingerprints are one class, and only classes are compared, so that a recording
copied into a third of all rows is looked for once. Every class that holds a query is compared with
every class: the work is their product. The coarse step loses few links: of the 1344 pairs within 25 % of
differing bits among 768 and 1860 recordings (melodies of the test tables, noisy, cut and patched copies)
it keeps 1342, and of 403 of another such set 401 at least.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelyard.llm.common import stage

RATE = 4000
FRAME = 512
HOP = 128
#: Filters: kind, first pitch class, pitch classes, frames. Made by a rule: four kinds by four shapes.
FILTERS = [(kind, (5 * kind + 3 * shape) % 12, (3, 4, 6, 12)[shape], (4, 8, 12, 16)[(shape + kind) % 4]) for kind in range(4) for shape in range(4)]
WIDTH = max(w for *_, w in FILTERS)
#: Cuts between the four levels of a filter's value.
LEVELS = (-0.12, 0.0, 0.12)
GRAY = np.array([0, 1, 3, 2], np.uint32)
#: A key joins the packed integers of two places so many frames apart.
KEY_STEP = 12
#: The coarse correlation keeps one of so many frequencies and offsets (a power of two up to four).
STEP = 4


def decode_wav(data: bytes | None) -> np.ndarray | None:
    """Mono samples at RATE of a RIFF file of 16-bit PCM; None for anything else."""
    if not data or data[:4] != b"RIFF" or data[8:12] != b"WAVE":
        return None
    at, channels, rate, bits, body = 12, 0, 0, 0, None
    while at + 8 <= len(data):
        name, size = data[at : at + 4], struct.unpack_from("<I", data, at + 4)[0]
        if name == b"fmt " and size >= 16:
            kind, channels, rate, _, _, bits = struct.unpack_from("<HHIIHH", data, at + 8)
            if kind != 1:
                return None
        elif name == b"data":
            body = data[at + 8 : at + 8 + size]
        at += 8 + size + (size & 1)
    if body is None or bits != 16 or not channels or not rate:
        return None
    x = np.frombuffer(body[: len(body) // (2 * channels) * 2 * channels], "<i2").reshape(-1, channels).mean(1) / 32768
    if rate != RATE and len(x):
        x = np.interp(np.arange(0, len(x), rate / RATE), np.arange(len(x)), x)
    return x


def encode_wav(samples: np.ndarray, rate: int = RATE) -> bytes:
    body = (np.clip(samples, -1, 1) * 32767).astype("<i2").tobytes()
    return b"RIFF" + struct.pack("<I", 36 + len(body)) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, rate, 2 * rate, 2, 16) + b"data" + struct.pack("<I", len(body)) + body


_FREQ = np.fft.rfftfreq(FRAME, 1 / RATE)
_BAND = (_FREQ >= 60) & (_FREQ <= 1800)
_CLASS = np.rint(12 * np.log2(np.where(_BAND, _FREQ, 440) / 440)).astype(int) % 12
_FOLD = np.zeros((len(_FREQ), 12))
_FOLD[np.flatnonzero(_BAND), _CLASS[_BAND]] = 1
_HANN = np.hanning(FRAME)


def chroma(samples: np.ndarray) -> np.ndarray:
    """Frames by twelve pitch classes, each frame of length 1 (silence: zeros)."""
    if len(samples) < FRAME:
        return np.zeros((0, 12))
    frames = np.lib.stride_tricks.sliding_window_view(samples, FRAME)[::HOP]
    out = []
    for at in range(0, len(frames), 4096):
        power = np.square(np.abs(np.fft.rfft(frames[at : at + 4096] * _HANN, axis=1)))
        out.append(np.sqrt(power @ _FOLD))
    image = np.concatenate(out)
    norm = np.sqrt(np.square(image).sum(1, keepdims=True))
    return np.where(norm > 1e-3, image / np.maximum(norm, 1e-12), 0)


def packed(samples: np.ndarray | None) -> np.ndarray:
    """The packed integers of a recording, one for each frame that all filters fit after."""
    image = chroma(np.zeros(0) if samples is None else np.asarray(samples, float))
    n = len(image) - WIDTH + 1
    if n <= 0:
        return np.zeros(0, np.uint32)
    wrapped = np.concatenate((image, image), axis=1)  # pitch classes go around
    total = np.zeros((len(image) + 1, 25))
    total[1:, 1:] = wrapped.cumsum(0).cumsum(1)
    at = np.arange(n)

    def box(first: int, last: int, begin: int, end: int) -> np.ndarray:
        """Mean of pitch classes first..last-1 over frames begin..end-1 after each frame."""
        return (total[at + end, last] - total[at + begin, last] - total[at + end, first] + total[at + begin, first]) / ((last - first) * (end - begin))

    out = np.zeros(n, np.uint32)
    for kind, first, classes, frames in FILTERS:
        c, f = max(classes // 2, 1), frames // 2
        a, b, z = first, first + c, first + min(2 * c, 12)
        if kind == 0:  # one half of the time against the other
            v = box(a, z, 0, f) - box(a, z, f, frames)
        elif kind == 1:  # low pitch classes against high ones
            v = box(a, b, 0, frames) - box(b, z, 0, frames)
        elif kind == 2:  # a chequer
            v = (box(a, b, 0, f) + box(b, z, f, frames) - box(b, z, 0, f) - box(a, b, f, frames)) / 2
        else:  # the middle of the time against its sides
            q = frames // 4
            v = box(a, z, q, frames - q) - (box(a, z, 0, q) + box(a, z, frames - q, frames)) / 2
        out = (out << np.uint32(2)) | GRAY[np.searchsorted(LEVELS, v, side="right")]
    return out


def fingerprints(
    recordings: DataFrame, id_col: str, media_col: str, decode: Callable[[object], np.ndarray | None] = decode_wav
) -> DataFrame:
    """Per row: rec_id, prints (array<long>, packed unsigned integers), print_id (a hash of them).

    Null, undecodable and too short media have no prints (empty array) and a null print_id. Whole
    recordings. Repeated rows stay. Narrow.
    """
    key = recordings.select(F.col(id_col)).schema[0].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                got = [packed(decode(m)) for m in b.column(1).to_pylist()]
                ids = [np.uint64(xxhash.xxh64_intdigest(g.astype("<u4").tobytes())).astype(np.int64).item() if len(g) else None for g in got]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array([g.astype(np.int64) for g in got], pa.list_(pa.int64())), pa.array(ids, pa.int64())],
                    ["rec_id", "prints", "print_id"],
                )

    return recordings.select(F.col(id_col).alias("rec_id"), F.col(media_col).alias("media")).mapInArrow(
        work, f"rec_id {key}, prints array<long>, print_id long"
    )


def _spectra(prints: list[np.ndarray], size: int, kind: type) -> np.ndarray:
    """Transforms of the bits as 1 and -1: frequency, recording, bit."""
    signs = np.zeros((len(prints), size, 32), kind)
    for row, p in zip(signs, prints):
        row[: len(p)] = ((p[:, None] >> np.arange(32, dtype=np.uint32)) & 1).astype(kind) * 2 - 1
    return np.ascontiguousarray(np.fft.rfft(signs, axis=1).transpose(1, 0, 2))


def _size(least: int) -> int:
    """The smallest multiple of four from least on with no prime factor over 5."""
    least += -least % 4
    while True:
        rest = least
        for f in (2, 3, 5):
            while rest % f == 0:
                rest //= f
        if rest == 1:
            return least
        least += 4


class _Block:
    """Some recordings of about one length, with the transforms last asked for."""

    def __init__(self, ids: list[int], prints: list[np.ndarray]) -> None:
        self.ids, self.prints, self.lengths = ids, prints, np.array([*map(len, prints)])
        self.longest, self.last, self.got = int(self.lengths.max()), None, None
        self.padded = np.zeros((len(ids), self.longest), np.uint32)
        for row, p in zip(self.padded, prints):
            row[: len(p)] = p

    def spectra(self, size: int, kind: type) -> np.ndarray:
        if self.last != (size, kind):
            self.last, self.got = (size, kind), _spectra(self.prints, size, kind)
        return self.got


def _blocks(ids: list[int], prints: list[np.ndarray], most: int) -> Iterator[_Block]:
    """Blocks of at most `most` recordings of 128 frames, fewer if they are longer; lengths within a quarter."""
    order = sorted(range(len(ids)), key=lambda i: len(prints[i]))
    at = 0
    while at < len(order):
        end, first = at + 1, len(prints[order[at]])
        while end < len(order) and len(prints[order[end]]) <= 1.25 * first and (end - at) * len(prints[order[end]]) < most * 128:
            end += 1
        yield _Block([ids[i] for i in order[at:end]], [prints[i] for i in order[at:end]])
        at = end


def _net_bits(a: np.ndarray, b: np.ndarray, offset: int, a_len: np.ndarray, b_len: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Differing bits and overlapping frames of the rows of a and b (padded prints), b's place less a's being offset."""
    begin_a, begin_b = max(-offset, 0), max(offset, 0)
    n = np.minimum(a_len - begin_a, b_len - begin_b)
    most = max(int(n.max(initial=0)), 0)
    differ = np.bitwise_count(a[:, begin_a : begin_a + most] ^ b[:, begin_b : begin_b + most])
    width = min(a.shape[1] - begin_a, b.shape[1] - begin_b, most)
    return (differ * (np.arange(width) < n[:, None])).sum(1, dtype=np.int64), n


def _candidates(asked: _Block, every: _Block, most_error: float, least_overlap: int, size: int, slack: float) -> np.ndarray:
    """Pairs (place in every, place in asked) that have an offset within most_error.

    The correlation is first taken from the lowest 1/STEP of the frequencies alone, at every STEP-th offset,
    which takes 1/STEP of the product and of the transform. The prints of neighbouring frames overlap, so
    most of a correlation lies there: where it holds less than `slack` of what a link needs, the offset and
    its neighbours are ruled out. At the others the bits are counted.
    """
    half = size // STEP
    kind = np.float32 if asked.longest * every.longest < 1 << 22 else np.float64
    low = half // 2 + 1
    product = np.matmul(every.spectra(size, kind)[:low], asked.spectra(size, kind)[:low].conj().transpose(0, 2, 1))
    agree = np.fft.irfft(np.ascontiguousarray(product.transpose(1, 2, 0)), half, axis=2)
    offset = STEP * np.arange(half)
    offset[offset > every.longest - least_overlap + STEP - 1] -= size
    one = len({*asked.lengths.tolist()}) == 1 == len({*every.lengths.tolist()})
    q_len, c_len = (asked.lengths[:1], every.lengths[:1]) if one else (asked.lengths, every.lengths)
    overlap = np.minimum(q_len[None, :, None] - np.maximum(-offset, 0), c_len[:, None, None] - np.maximum(offset, 0))
    # the short transform sums STEP times what the whole one does
    need = np.where(overlap > least_overlap - STEP, STEP * slack * 32 * (overlap - STEP // 2) * (1 - 2 * most_error), np.inf).astype(kind)
    c, q, k = np.nonzero(agree >= need)
    if not len(c):
        return np.zeros((0, 2), np.int64)
    found = np.zeros((len(every.ids), len(asked.ids)), bool)
    order = np.argsort(offset[k], kind="stable")
    c, q, at = c[order], q[order], offset[k][order]
    cuts = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), len(at)]
    for x, y in zip(cuts, cuts[1:]):
        i, j = c[x:y], q[x:y]
        for o in range(int(at[x]) - STEP // 2, int(at[x]) + STEP // 2 + 1):
            todo = ~found[i, j]
            if todo.any():
                i, j = i[todo], j[todo]
                differ, n = _net_bits(asked.padded[j], every.padded[i], o, asked.lengths[j], every.lengths[i])
                good = (n >= least_overlap) & (differ <= 32 * n * most_error)
                found[i[good], j[good]] = True
    return np.argwhere(found)


def alignments(asked: _Block, every: _Block, most_error: float, least_overlap: int, slack: float = 0.7) -> list[tuple[int, int, int, int, float]]:
    """q, print_id, offset, votes, bit_error of each pair that has an offset within most_error."""
    size = _size(max(asked.longest + every.longest - least_overlap, 2))
    pairs = _candidates(asked, every, most_error, least_overlap, size, slack)
    out = []
    offsets = range(-(asked.longest - least_overlap), every.longest - least_overlap + 1)
    for at in range(0, len(pairs), 1024):  # links: every offset is counted, for the best of them
        i, j = pairs[at : at + 1024, 0], pairs[at : at + 1024, 1]
        best = np.full(len(i), np.iinfo(np.int64).min)
        place, error = np.zeros(len(i), np.int64), np.ones(len(i))
        for o in sorted(offsets, key=lambda o: (abs(o), o)):
            differ, n = _net_bits(asked.padded[j], every.padded[i], o, asked.lengths[j], every.lengths[i])
            net = 32 * n - 2 * differ
            better = (n >= least_overlap) & (differ <= 32 * n * most_error) & (net > best)
            best[better], place[better], error[better] = net[better], o, (differ[better] / (32 * n[better]))
        for x, y, o, e in zip(i.tolist(), j.tolist(), place.tolist(), error.tolist()):
            if every.ids[x] != asked.ids[y]:
                a, b = asked.prints[y][max(-o, 0) :], every.prints[x][max(o, 0) :]
                same = a[: len(b)] == b[: len(a)]
                out.append((asked.ids[y], every.ids[x], o, int((same[:-KEY_STEP] & same[KEY_STEP:]).sum()), e))
    return out


def _listed(batch: pa.RecordBatch | pa.Table, least: int) -> tuple[list[int], list[np.ndarray]]:
    """print_id and prints of the rows of at least so many frames."""
    ids, prints = batch.column(0).to_pylist(), batch.column(1)
    ends = np.cumsum(prints.value_lengths().to_numpy(zero_copy_only=False))[:-1] if len(ids) else []
    parts = np.split(prints.flatten().to_numpy(zero_copy_only=False).astype(np.uint32), ends) if len(ids) else []
    keep = [i for i, p in enumerate(parts) if len(p) >= least]
    return [ids[i] for i in keep], [parts[i] for i in keep]


def _search(classes: DataFrame, most_error: float, least_overlap: int, round_bytes: int) -> DataFrame:
    """q, print_id, offset, votes, bit_error for the classes asked against all classes.

    The asked ones are broadcast in rounds of round_bytes (their transforms take about sixty times
    that in a task); the others stay where they are.
    """
    spark = classes.sparkSession
    dealt = classes.select("print_id", "prints").repartition(4 * spark.sparkContext.defaultParallelism, "print_id")
    asked = classes.where("asked").select("print_id", "prints")
    rounds = max(1, -(-int(asked.agg(F.coalesce(F.sum(F.size("prints") * 4), F.lit(0)).alias("b")).first()["b"]) // round_bytes))
    found: DataFrame | None = None
    for r in range(rounds):
        part = (asked if rounds == 1 else asked.where(F.pmod(F.xxhash64("print_id"), F.lit(rounds)) == r)).toArrow().combine_chunks()
        sent = spark.sparkContext.broadcast([x for b in part.to_batches() for x in zip(*_listed(b, least_overlap))])

        def work(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            blocks = [*_blocks([i for i, _ in sent.value], [p for _, p in sent.value], 64)]
            for b in batches:
                for every in _blocks(*_listed(b, least_overlap), 256):
                    for block in blocks:
                        got = alignments(block, every, most_error, least_overlap)
                        if got:
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(x, t) for x, t in zip(zip(*got), (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.float64()))],
                                ["q", "print_id", "offset", "votes", "bit_error"],
                            )

        one = dealt.mapInArrow(work, "q long, print_id long, offset int, votes long, bit_error double")
        found = one if found is None else found.unionByName(one)
    return found


def align(
    recordings: DataFrame, queries: F.Column, id_col: str, media_col: str,
    decode: Callable[[object], np.ndarray | None] = decode_wav, most_error: float = 0.25, least_overlap: int = 24,
    round_bytes: int = 2 << 20,
) -> DataFrame:
    """Per row: rec_id, n_prints, class_id (smallest id with the same prints), n_links, links.

    queries: a predicate on rec_id. The classes that hold a query are searched against all classes;
    links (array<struct<class_id, offset, votes, bit_error>>, by class_id) are those with an offset
    at which at most most_error of the bits differ over at least least_overlap frames: all that the coarse
    step keeps (its recall against all offsets of all pairs is over 0.99, see above), each counted exactly.
    Of such offsets the one is given at which most bits agree, less those that differ; ties go to the
    offset nearest to zero, then to the smaller. offset is the link's place less the query's; votes
    are the keys (packed integers KEY_STEP frames apart) that are equal there, none of which is
    needed. Rows without prints have class_id and links null and n_links 0; so do
    recordings whose class holds no query (n_links null, links null). Other columns are not read, whatever their names.
    """
    prints = stage(fingerprints(recordings, id_col, media_col, decode), "chroma")
    classes = stage(
        prints.where("print_id is not null").groupBy("print_id").agg(
            F.min("rec_id").alias("class_id"), F.min("prints").alias("prints"), F.max(F.coalesce(queries, F.lit(False))).alias("asked")
        ),
        "classes",
    )
    measured = _search(classes, most_error, least_overlap, round_bytes).join(classes.select("print_id", "class_id"), "print_id")
    links = measured.groupBy("q").agg(
        F.array_sort(F.collect_list(F.struct("class_id", "offset", "votes", "bit_error"))).alias("links")
    )
    searched = classes.select("print_id", "class_id", "asked").join(links.withColumnRenamed("q", "print_id"), "print_id", "left").select(
        "print_id", "class_id",
        F.when(F.col("asked"), F.coalesce(F.size("links"), F.lit(0))).cast("long").alias("n_links"),
        F.when(F.col("asked"), F.coalesce("links", F.array().cast("array<struct<class_id:long,offset:int,votes:long,bit_error:double>>"))).alias("links"),
    )
    return prints.join(searched, "print_id", "left").select(
        "rec_id", F.size("prints").cast("long").alias("n_prints"), "class_id",
        F.when(F.col("print_id").isNull(), F.lit(0).cast("long")).otherwise(F.col("n_links")).alias("n_links"), "links",
    )


def melody(vector: list | None, notes: int = 64, note_samples: int = 256) -> np.ndarray | None:
    """A vector played as a melody: component i is note i, higher components higher pitches.

    This is how a table without recordings gets a media column. Null or unusable components rest.
    """
    if not vector:
        return None
    v = np.array([np.nan if x is None else x for x in vector], float)
    top = np.nanmax(np.abs(v)) if np.isfinite(v).any() else 0.0
    if not np.isfinite(top) or top == 0:
        return None
    pitch = np.rint(np.nan_to_num(v / top, nan=0.0) * 17)
    hertz = np.repeat(261.6 * 2 ** (pitch / 12), note_samples)
    phase = 2 * np.pi * np.cumsum(hertz) / RATE
    return np.where(np.repeat(np.isfinite(v), note_samples), 0.6 * np.sin(phase) + 0.2 * np.sin(2 * phase), 0.0)
