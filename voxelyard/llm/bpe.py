"""Operator 5: byte-level BPE encoding and decoding, by speculation and verification.

A pre-token (word) is first cut greedily, at each place the longest entry of the vocabulary. That
cut is only a guess. It is the BPE result exactly if every two neighbouring tokens are compatible,
i.e. if merging the bytes of the two alone gives back the same two tokens: the components of a
merge have lower ranks than what it makes, so a merge across a cut depends on the two tokens beside
it alone. The check looks all neighbours of a whole batch of words up at once, in a table of pairs
already judged; only words with an incompatible pair are merged exactly.

Texts are cut before each single space that a non-space follows, which the pre-tokenizer's pattern
always cuts too; what the cuts leave (chunks) are looked up in a cache of bounded size first.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelyard.llm.common import pieces

#: The byte-level pre-tokenizer's pattern (a fixed value of the file format).
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A space that the cut before it would not be right for: white space or the end follows.
PAIR = struct.Struct("<2I").pack
UNSAFE_SPACE = regex.compile(r" (?:\s|$)")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies, letter to byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class PairTable:
    """Ranks of pairs of ids, looked up for whole arrays: open addressing, linear probing."""

    def __init__(self, ranks: dict[int, int], none: int) -> None:
        self.bits = max(10, (4 * len(ranks)).bit_length())
        self.none, size = none, 1 << self.bits
        self.keys, self.found = np.full(size, -1, np.int64), np.full(size, none, np.int64)
        keys, found = np.fromiter(ranks, np.int64, len(ranks)), np.fromiter(ranks.values(), np.int64, len(ranks))
        at = self._home(keys)
        while len(keys):
            # of the keys that want a free place, one takes it; the others go on to the next place
            free = self.keys[at] == -1
            _, first = np.unique(at[free], return_index=True)
            won = np.flatnonzero(free)[first]
            self.keys[at[won]], self.found[at[won]] = keys[won], found[won]
            left = np.ones(len(keys), bool)
            left[won] = False
            keys, found, at = keys[left], found[left], (at[left] + 1) & (size - 1)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        at = self._home(keys)
        seen = self.keys[at]
        out = np.where(seen == keys, self.found[at], self.none)
        todo = np.flatnonzero((seen != keys) & (seen != -1))
        while len(todo):
            at[todo] = (at[todo] + 1) & (len(self.keys) - 1)
            seen = self.keys[at[todo]]
            hit = seen == keys[todo]
            out[todo[hit]] = self.found[at[todo[hit]]]
            todo = todo[~hit & (seen != -1)]
        return out


class SpeculativeBPE:
    """Encodes and decodes as the tokenizers library does with the same file.

    cache: most chunks that are remembered; memory is bounded by it, results don't depend on it.
    """

    def __init__(self, path: str, cache: int = 400_000) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model = spec["pre_tokenizer"], spec["model"]
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or spec["normalizer"] is not None:
            raise ValueError("only byte-level BPE files without a normalizer are supported")
        if pre["add_prefix_space"] or model.get("dropout") or model.get("ignore_merges"):
            raise ValueError("add_prefix_space, dropout and ignore_merges are not supported")
        letters = byte_letters()
        self.vocab = {bytes(map(letters.__getitem__, t)): i for t, i in model["vocab"].items()}
        self.by_byte = [self.vocab[bytes([b])] for b in range(256)]
        names = model["vocab"]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            self.merges.setdefault((names[a], names[b]), (rank, names[a + b]))
        self.ranks = {a << 20 | b: rank for (a, b), (rank, _) in self.merges.items()}
        self.made = [names[(m if isinstance(m, str) else "".join(m)).replace(" ", "")] for m in model["merges"]]
        self.table = PairTable(self.ranks, len(self.made))
        self.made_ids, self.byte_ids = np.array([*self.made, 0], np.int64), np.array(self.by_byte, np.int64)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that strip or match whole words are not supported")
        n = max([*self.vocab.values(), *self.special.values()]) + 1
        self.token_bytes: list[bytes] = [b""] * n
        for t, i in self.vocab.items():
            self.token_bytes[i] = t
        for t, i in self.special.items():
            self.token_bytes[i] = t.encode()
        self.added = (
            regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
            if self.special
            else None
        )
        self.pre_token = regex.compile(PRE_TOKEN)
        #: Longest entry by its first two bytes: how far a greedy step needs to look.
        self.reach: dict[bytes, int] = {}
        for t in self.vocab:
            self.reach[t[:2]] = max(self.reach.get(t[:2], 1), len(t))
        self.compatible: dict[int, bool] = {}
        self.limit = cache
        self.words: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}
        self.exact_words = self.guessed_words = 0

    # ---- exact merging

    def merge(self, word: bytes) -> list[int]:
        """The ids of one pre-token by merging, lowest rank and leftmost first."""
        ids = [self.by_byte[b] for b in word]
        if len(ids) < 2:
            return ids
        if len(ids) <= 64:
            rank_of, made, none = self.ranks.get, self.made, len(self.made)
            ranks = [rank_of(a << 20 | b, none) for a, b in zip(ids, ids[1:])]
            while (rank := min(ranks)) < none:
                at = ranks.index(rank)
                ids[at] = new = made[rank]
                del ids[at + 1], ranks[at]
                if at:
                    ranks[at - 1] = rank_of(ids[at - 1] << 20 | new, none)
                if at < len(ranks):
                    ranks[at] = rank_of(new << 20 | ids[at + 1], none)
                elif not ranks:
                    break
            return ids
        after = [*range(1, len(ids)), -1]
        before = [-1, *range(len(ids) - 1)]
        heap = []
        for i in range(len(ids) - 1):
            if m := self.merges.get((ids[i], ids[i + 1])):
                heap.append((m[0], i, ids[i], ids[i + 1], m[1]))
        heapq.heapify(heap)
        while heap:
            _, i, a, b, made = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = made, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (m := self.merges.get((ids[x], ids[y]))):
                    heapq.heappush(heap, (m[0], x, ids[x], ids[y], m[1]))
        return [i for i in ids if i >= 0]

    def merge_all(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word by merging, as little-endian unsigned 32-bit integers.

        Words of about one length are the rows of a matrix, all merged at once: in each step each row
        merges its leftmost pair of the lowest rank. Words of over 64 bytes are merged one by one.
        """
        out = [b""] * len(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        for low, high in ((0, 6), (6, 10), (10, 16), (16, 28), (28, 64)):
            mine = np.flatnonzero((sizes > low) & (sizes <= high))
            for at in range(0, len(mine), 8192):
                part = mine[at : at + 8192].tolist()
                for k, ids in zip(part, self._merge_rows([words[k] for k in part], high)):
                    out[k] = ids
        for k in np.flatnonzero(sizes > 64).tolist():
            out[k] = np.array(self.merge(words[k]), "<u4").tobytes()
        return out

    def _merge_rows(self, words: list[bytes], width: int) -> list[bytes]:
        none, n = self.table.none, len(words)
        flat = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(n, width)
        size = np.fromiter(map(len, words), np.int64, n)
        ids = self.byte_ids[flat]
        ranks = self.table.get(((ids[:, :-1] << 20) | ids[:, 1:]).ravel()).reshape(n, width - 1)
        ranks[np.arange(width - 1) >= size[:, None] - 1] = none
        done = np.zeros((n, width), "<u4")
        rows, places, size_of = np.arange(n), np.arange(width), size.copy()
        while len(rows):
            at = ranks.argmin(1)
            best = ranks[np.arange(len(rows)), at]
            end = best == none
            if end.any():
                done[rows[end]] = ids[end]
                go = ~end
                rows, ids, ranks, size, at, best = rows[go], ids[go], ranks[go], size[go], at[go], best[go]
                if not len(rows):
                    break
            one = np.arange(len(rows))
            ids[one, at] = self.made_ids[best]
            # what lies behind the merged pair moves one place to the left
            ids = np.take_along_axis(ids, np.minimum(places + (places > at[:, None]), width - 1), 1)
            ranks = np.take_along_axis(ranks, np.minimum(places[:-1] + (places[:-1] >= at[:, None]), width - 2), 1)
            size -= 1
            ranks[one, size - 1] = none
            right = np.flatnonzero(at < size - 1)
            x = at[right]
            ranks[right, x] = self.table.get((ids[right, x] << 20) | ids[right, x + 1])
            left = np.flatnonzero(at > 0)
            x = at[left]
            ranks[left, x - 1] = self.table.get((ids[left, x - 1] << 20) | ids[left, x])
            size_of[rows] = size
        raw, ends = done.tobytes(), size_of.tolist()
        return [raw[4 * width * i : 4 * (width * i + e)] for i, e in enumerate(ends)]

    # ---- speculation

    def greedy(self, word: bytes) -> list[int]:
        vocab, reach, n = self.vocab, self.reach, len(word)
        out, at = [], 0
        while at < n:
            end = min(n, at + reach.get(word[at : at + 2], 1))
            while (got := vocab.get(word[at:end])) is None:
                end -= 1
            out.append(got)
            at = end
        return out

    def _judge(self, pairs: np.ndarray) -> np.ndarray:
        """Whether each pair (first id << 32 | second id) is compatible."""
        unique, where = np.unique(pairs, return_inverse=True)
        known = self.compatible
        keys = unique.tolist()
        new = [k for k in keys if k not in known]
        token = self.token_bytes
        alone = self.merge_all([token[k >> 32] + token[k & 0xFFFFFFFF] for k in new])
        known.update((k, ids == PAIR(k >> 32, k & 0xFFFFFFFF)) for k, ids in zip(new, alone))
        good = np.fromiter(map(known.__getitem__, keys), bool, len(keys))
        if len(known) > 4 * self.limit:
            known.clear()
        return good[where]

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """The ids of each pre-token, as little-endian unsigned 32-bit integers."""
        if not words:
            return []
        guesses = [*map(self.greedy, words)]
        lengths = np.fromiter(map(len, guesses), np.int64, len(guesses))
        flat = np.fromiter((i for g in guesses for i in g), np.int64, int(lengths.sum()))
        ends = np.cumsum(lengths)
        bad: set[int] = set()
        if len(flat) > 1:
            inside = np.ones(len(flat) - 1, bool)
            inside[ends[:-1][(ends[:-1] > 0) & (ends[:-1] < len(flat))] - 1] = False
            at = np.flatnonzero(inside)
            good = self._judge((flat[at] << 32) | flat[at + 1])
            bad = set(np.searchsorted(ends, at[~good], side="right").tolist())
        raw = flat.astype("<u4").tobytes()
        cuts = [0, *(ends * 4).tolist()]
        out = [raw[a:b] for a, b in zip(cuts, cuts[1:])]
        wrong = [*bad]
        for k, ids in zip(wrong, self.merge_all([words[k] for k in wrong])):
            out[k] = ids
        self.guessed_words += len(words)
        self.exact_words += len(bad)
        return out

    # ---- whole texts

    def _learn(self, chunks: Iterable[str]) -> None:
        """Put the chunks into the cache."""
        split = self.pre_token.findall
        plain, cut = [], []
        for c in chunks:
            if c.isascii() and (c[1:] if c[0] == " " else c).isalpha():
                plain.append(c)  # one pre-token
            else:
                cut.append((c, split(c)))
        words = self.words
        new = {w for _, ws in cut for w in ws}.union(plain).difference(words)
        if len(words) + len(new) > self.limit:
            words.clear()
            new = {w for _, ws in cut for w in ws}.union(plain)
        listed = [*new]
        words.update(zip(listed, self.encode_words([*map(str.encode, listed)])))
        chunks_of, get = self.chunks, words.__getitem__
        chunks_of.update(zip(plain, map(get, plain)))
        for c, ws in cut:
            chunks_of[c] = b"".join(map(get, ws))

    def _cut(self, text: str) -> list[str]:
        """Chunks that join to the text and whose pre-tokens are those of the text."""
        if " " not in text:
            return [text]
        parts = text.split(" ")
        if UNSAFE_SPACE.search(text) is None:
            return [parts[0], *map(" ".__add__, parts[1:])] if parts[0] else [*map(" ".__add__, parts[1:])]
        out = [parts[0]]
        for p in parts[1:]:
            if p and not p[0].isspace():
                out.append(" " + p)
            else:
                out[-1] += " " + p
        return [c for c in out if c]

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each whole text (null: empty) as little-endian unsigned 32-bit integers."""
        cut: list[list[str | int]] = []
        for t in texts:
            if not t:
                cut.append([])
            elif self.added is None or not any(s in t for s in self.special):
                cut.append(self._cut(t))
            else:
                parts: list[str | int] = []
                for p in self.added.split(t):
                    if p in self.special:
                        parts.append(self.special[p])
                    elif p:
                        parts.extend(self._cut(p))
                cut.append(parts)
        chunks = self.chunks
        missing = set().union(*cut).difference(chunks)
        if len(chunks) + len(missing) > self.limit:
            chunks.clear()
            missing = set().union(*cut)
        for i in [m for m in missing if isinstance(m, int)]:
            missing.discard(i)
            chunks[i] = np.array([i], "<u4").tobytes()  # type: ignore[index]
        self._learn(missing)
        return [b"".join(map(chunks.__getitem__, c)) for c in cut]

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.encode_batch([text])[0], "<u4").tolist()

    def decode(self, ids: bytes) -> str:
        """The text of ids (little-endian unsigned 32-bit); bytes that aren't UTF-8 are replaced."""
        if not ids:
            return ""
        return b"".join(map(self.token_bytes.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode(
            "utf-8", errors="replace"
        )


class _Decimal(dict):
    """Decimal strings of ids, made when first asked for; no more than the vocabulary has."""

    def __missing__(self, i: int) -> str:
        self[i] = text = str(i)
        return text


_DECIMAL = _Decimal()
_LOADED: dict[tuple[str, int], SpeculativeBPE] = {}


def loaded(path: str, cache: int = 400_000) -> SpeculativeBPE:
    """One encoder for each Python worker."""
    if (path, cache) not in _LOADED:
        _LOADED[path, cache] = SpeculativeBPE(path, cache)
    return _LOADED[path, cache]


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True) -> DataFrame:
    """Per row: id, ids (array<int>), decoded (text); with keep_ids=False only their digests.

    Nulls and empty texts give no ids and an empty text; repeated rows stay repeated; very long
    texts are encoded whole; a null id stays null. Other columns are not read, whatever their names.
    An empty table gives an empty table. Narrow: no shuffle.
    """
    with_ids = "ids array<int>, decoded string" if keep_ids else "n_tokens long, ids_sha256 string, decoded_sha256 string"
    key = docs.select(F.col(id_col)).schema[0].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = loaded(path)
        for whole in batches:
            for b in pieces(whole):
                got = coder.encode_batch(b.column(1).to_pylist())
                texts = map(coder.decode, got)
                if keep_ids:
                    ids = pa.array([np.frombuffer(g, "<u4").astype(np.int32) for g in got], pa.list_(pa.int32()))
                    yield pa.RecordBatch.from_arrays([b.column(0), ids, pa.array(texts, pa.string())], ["id", "ids", "decoded"])
                    continue
                n = [len(g) // 4 for g in got]
                digests = [sha256_of_ids(g) for g in got]
                plain = [hashlib.sha256(t.encode()).hexdigest() for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(n, pa.int64()), pa.array(digests, pa.string()), pa.array(plain, pa.string())],
                    ["id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(work, f"id {key}, {with_ids}").withColumnRenamed("id", "doc_id")


def sha256_of_ids(ids: bytes) -> str:
    """Hex SHA-256 of the decimal ids joined by commas."""
    return hashlib.sha256(",".join(map(_DECIMAL.__getitem__, np.frombuffer(ids, "<u4").tolist())).encode()).hexdigest()
