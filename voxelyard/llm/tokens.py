"""Operator 6: token ids in Parquet, for selective reads.

Format: a folder of Parquet files in ascending order of document id. Columns: shard (the file's
place), doc_id, offset (ids in the shard before this document), n_tokens and tokens (array<int>).
Ids are dictionary-encoded (a 50 k vocabulary packs into 16 bits or fewer a value), the integer columns
delta- or dictionary-encoded by the version 2 pages; row groups and pages have set sizes and Parquet's
page indexes carry the bounds of doc_id, so that a reader of some documents touches their pages
alone, and a reader of the metadata reads no token.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxelyard.llm.bpe import UNSAFE_SPACE, byte_letters
from voxelyard.llm.common import pieces

WRITER = {
    "compression": "snappy",
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.enable.dictionary": "true",
    "parquet.dictionary.page.size": str(1 << 20),
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(1 << 20),
    "parquet.page.row.count.limit": "2000",
}


#: Marks that end a word as a pre-token of their own.
MARKS = ".,;:!?&*$%#|)\"-"
#: Letters below this code point are letters to every Unicode version in use.
LATIN_END = "\u0250"
#: The letter that stands for the byte of a space.
SPACE = "\u0120"
#: White space but the space and the line feed.
RARE_SPACES = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: A word of Latin letters and the marks that end it, then, after a line feed, another.
LATIN, ENDS = (f"[{''.join(f'\\x{{{ord(c):x}}}' for c in chars)}]" for chars in (filter(str.isalpha, map(chr, range(ord(LATIN_END)))), MARKS))
PART = rf"^(?P<v>{LATIN}+)(?P<vt>{ENDS}*)(?:(?P<n>\n)(?P<w>{LATIN}+)(?P<wt>{ENDS}*))?$"
#: Bytes of text that are encoded together.
TOGETHER = 12 << 20


class CachedTokenizer:
    """The tokenizers library, asked once for each word of the texts given together.

    A text is cut before each single space that a non-space follows, where a byte-level pre-tokenizer
    always cuts as well, so the ids of the parts join to those of the text; a part is cut between its
    letters and the marks that end it, and at a line feed between words, for the same reason. Words of
    Latin letters are one pre-token: the distinct ones go to the library's model 8000 in a call, which
    gives ids alone, and are told apart by the lengths of their tokens. All other parts go through the
    whole library; `cache` of the short ones are remembered. Cuts, distinct parts and the joining of ids are
    array operations.
    """

    def __init__(self, path: str, cache: int = 100_000) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import CharDelimiterSplit

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model.tokenize
        self.many = Tokenizer(self.library.model)
        self.many.pre_tokenizer = CharDelimiterSplit(" ")
        vocab = self.library.get_vocab()
        self.sizes = np.zeros(max(vocab.values(), default=0) + 1, np.int32)
        self.sizes[[*vocab.values()]] = [*map(len, vocab)]
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        shown = {b: letter for letter, b in byte_letters().items()}
        self.letters = {c: "".join(shown[b] for b in chr(c).encode()) for c in range(0x250)}
        self.cache = cache
        self.known: dict[str, np.ndarray] = {}

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4")

    def _kept(self, part: str) -> np.ndarray:
        if len(part) > 40:
            return self._whole(part)
        if (ids := self.known.get(part)) is None:
            if len(self.known) >= self.cache:
                self.known.clear()
            self.known[part] = ids = self._whole(part)
        return ids

    def _shown(self, w: str) -> str:
        return w if w.isascii() else w.translate(self.letters)

    def _words(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pre-tokens of letters, joined, and the number of each."""
        flat, counts = [np.zeros(0, "<u4")], [np.zeros(0, np.int32)]
        for begin in range(0, len(keys), 8_000):
            some = keys[begin : begin + 8_000]
            ids = np.array(self.many.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            ends, want = np.cumsum(self.sizes[ids]), np.cumsum(np.fromiter(map(len, some), np.int64, len(some)))
            at = np.searchsorted(ends, want)
            if not len(ids) or ends[-1] != want[-1] or (ends[at] != want).any():  # a model that drops or replaces letters
                each = [[t.id for t in self.model(k)] for k in some]
                ids, at = np.array([i for e in each for i in e], "<u4"), np.cumsum([*map(len, each)]) - 1
            flat.append(ids)
            counts.append(np.diff(at, prepend=-1).astype(np.int32))
        return np.concatenate(flat), np.concatenate(counts)

    def _parts(self, parts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct parts after a space, joined, and the number of each."""
        found = pc.extract_regex(parts, PART)
        v, vt, n, w, wt = (pc.struct_field(found, k) for k in ("v", "vt", "n", "w", "wt"))
        begun, after = v.dictionary_encode(), pc.if_else(pc.equal(w, ""), None, w).dictionary_encode()
        marks = pa.concat_arrays([vt, n, wt])
        marks = pc.if_else(pc.equal(marks, ""), None, marks).dictionary_encode()
        rest = parts.filter(pc.is_null(v)).to_pylist()
        keys = [SPACE + self._shown(x) for x in begun.dictionary.to_pylist()] + [*map(self._shown, after.dictionary.to_pylist())]
        flat, counts = self._words(keys)
        more = [*map(self._kept, marks.dictionary.to_pylist()), *[self._kept(" " + x) for x in rest]]
        flat = np.concatenate([flat, *more])
        counts = np.concatenate([counts, np.fromiter(map(len, more), np.int32, len(more))])

        def places(coded: pa.DictionaryArray, first: int) -> np.ndarray:
            return np.where(coded.is_null().to_numpy(zero_copy_only=False), -1, coded.indices.fill_null(0).to_numpy(zero_copy_only=False) + first)

        m = len(begun.dictionary), len(keys), len(keys) + len(marks.dictionary)
        vt, n, wt = places(marks, m[1]).reshape(3, -1)
        table = np.stack([places(begun, 0), vt, n, places(after, m[0]), wt], 1)
        table[table[:, 0] < 0, 0] = m[2] + np.arange(len(rest))
        used = table >= 0
        flat, counts = _taken(flat, counts, table[used])
        ends = np.concatenate(([0], np.cumsum(counts)))[np.cumsum(used.sum(1))]
        return flat, np.diff(ends, prepend=0).astype(np.int32)

    def _cut(self, text: str) -> list[str]:
        """Parts of a text with white space or its end after a space."""
        parts = text.split(" ")
        out = [parts[0]]
        for p in parts[1:]:
            if p and not p[0].isspace():
                out.append(p)
            else:
                out[-1] += " " + p
        return out

    @staticmethod
    def _unsafe(text: str) -> bool:
        """Whether white space or the end follows a space, by searches that need no pattern."""
        if "  " in text or text[-1] == " ":
            return True
        if any(c in text for c in RARE_SPACES):
            return UNSAFE_SPACE.search(text) is not None
        return "\n" in text and any(line[-1:] == " " for line in text.split("\n"))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each whole text (null: none) as little-endian unsigned 32-bit integers."""
        out = [b""] * len(texts)
        plain, odd = {}, {}
        for i, t in enumerate(texts):
            if not t:
                continue
            if any(s in t for s in self.special):
                out[i] = self._whole(t).tobytes()
                continue
            if self._unsafe(t):
                first, *odd[i] = self._cut(t)
            else:
                first, space, left = t.partition(" ")
                if space:
                    plain[i] = left
            out[i] = self._kept(first).tobytes() if first else b""
        lists = pc.split_pattern(pa.array(plain.values(), pa.string()), " "), pa.array(odd.values(), pa.list_(pa.string()))
        places, sizes = [*plain, *odd], np.concatenate([x.value_lengths().to_numpy(zero_copy_only=False) for x in lists])
        plain.clear()
        odd.clear()
        parts = pa.concat_arrays([x.flatten() for x in lists]).dictionary_encode()
        del lists
        if len(parts):
            flat, counts = _taken(*self._parts(parts.dictionary), parts.indices.to_numpy())
            cuts = (4 * np.concatenate(([0], np.cumsum(counts)))[np.cumsum(sizes)]).tolist()
            raw = memoryview(flat).cast("B")
            for i, a, b in zip(places, [0, *cuts], cuts):
                out[i] += raw[a:b]
        return out


def _taken(flat: np.ndarray, counts: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of flat, of which counts has the lengths, in the order and as often as at says."""
    n = counts[at]
    ends, begins = np.cumsum(n, dtype=np.int32), np.cumsum(counts, dtype=np.int32) - counts
    places = np.repeat(begins[at] - (ends - n), n)
    places += np.arange(len(places), dtype=np.int32)
    return flat[places], n


_LOADED: dict[str, CachedTokenizer] = {}


def loaded(path: str) -> CachedTokenizer:
    if path not in _LOADED:
        _LOADED[path] = CachedTokenizer(path)
    return _LOADED[path]


def write(docs: DataFrame, to: str, tokenizer: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode each whole text, append end_id and write the files to `to` in ascending id order.

    Null and empty texts hold end_id alone; null ids come first; equal ids are ordered by their text,
    repeated rows stay. Other columns are not read, whatever their names. An empty table writes an
    empty folder. One shuffle, of the texts, by ranges of the id; rows of one id that a third of the
    table may share are cut further, by the beginning of their text and their place in the table.
    """
    key = docs.select(F.col(id_col)).schema[0].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, shard, offset = loaded(tokenizer), TaskContext.get().partitionId(), 0
        for whole in batches:
            for b in pieces(whole, at_most=TOGETHER):
                got = [g + end for g in coder.encode(b.column(1).to_pylist())]
                n = np.fromiter(map(len, got), np.int64, len(got)) // 4
                ends = np.cumsum(n)
                flat = np.frombuffer(b"".join(got), "<i4")
                del got
                tokens = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), pa.array(flat))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), shard), pa.int32()), b.column(0), pa.array(offset + ends - n), pa.array(n), tokens],
                    ["shard", "doc_id", "offset", "n_tokens", "tokens"],
                )
                offset += int(ends[-1])

    (
        docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
        .withColumn("tie", F.monotonically_increasing_id())
        .repartitionByRange("doc_id", F.substring("text", 1, 40), "tie").sortWithinPartitions("doc_id", "text")
        .select("doc_id", "text").mapInArrow(work, f"shard int, doc_id {key}, offset long, n_tokens long, tokens array<int>")
        .write.options(**WRITER).parquet(to)
    )


def schema(id_type: str = "long") -> T.StructType:
    return T._parse_datatype_string(f"shard int, doc_id {id_type}, offset long, n_tokens long, tokens array<int>")


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, shard: reads no token page.

    The totals of the shards are the only rows summed in order; there is one for each file.
    """
    rows = spark.read.parquet(path).select("shard", "doc_id", "offset", "n_tokens")
    totals = rows.groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    before = totals.select("shard", (F.sum("total").over(Window.orderBy("shard")) - F.col("total")).alias("before"))
    # a row of two numbers a file: no more than the writing job had tasks
    return rows.join(F.broadcast(before), "shard").select("doc_id", (F.col("before") + F.col("offset")).alias("start"), "n_tokens", "shard")


def read_checked(spark: SparkSession, path: str) -> DataFrame:
    """Reads the files whole: doc_id, start, n_tokens (as counted), ids_crc32.

    ids_crc32 is the CRC-32 of the document's ids as little-endian unsigned 32-bit integers.
    """
    files = spark.read.parquet(path)
    totals = files.groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    before = totals.select("shard", (F.sum("total").over(Window.orderBy("shard")) - F.col("total")).alias("before"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tokens = b.column(3)
            cuts = tokens.offsets.to_numpy()
            raw = memoryview(np.ascontiguousarray(tokens.values.to_numpy().astype("<u4"))).cast("B")
            crc = [zlib.crc32(raw[4 * x : 4 * y]) for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(np.diff(cuts).astype(np.int64)), pa.array(crc, pa.int64())],
                ["shard", "doc_id", "offset", "n_tokens", "ids_crc32"],
            )

    key = files.schema["doc_id"].dataType.simpleString()
    found = files.select("shard", "doc_id", "offset", "tokens").mapInArrow(
        work, f"shard int, doc_id {key}, offset long, n_tokens long, ids_crc32 long"
    )
    # a row of two numbers a file: no more than the writing job had tasks
    return found.join(F.broadcast(before), "shard").select(
        "doc_id", (F.col("before") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )
