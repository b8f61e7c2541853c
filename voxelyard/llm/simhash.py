"""Operator 3: SimHash near-duplicate groups, linked with BK-trees.

A document's fingerprint has 64 bits: a bit is 1 if it is set in over half the XXH64 hashes of the
document's word shingles. Equal fingerprints are one node. Of two fingerprints that differ in at
most `radius` bits, split into `blocks` blocks, at least blocks - radius blocks are equal: the
fingerprints are dealt by each choice of so many blocks and the bits in them (a shard), so every
pair within the radius meets in a shard, and none is lost. In each shard a BK-tree holds the
fingerprints, children keyed by their Hamming distance to the parent; a search follows only the
edges whose distance is within the radius of the query's own.

A shard of more than `shard_rows` fingerprints is cut into chunks by a hash: the tree of a chunk is
sent to every chunk of the same shard (i, j >= i), so that no task ever holds more than two chunks.
The forest grows with the documents, hence a tree goes to the chunks of its shard and not to every
executor. The number of blocks follows the number of fingerprints, so that a shard stays small at any
size; what is linked doesn't depend on it. Out of a pair of chunks come only the links of a spanning
forest, at most one for each fingerprint, never all pairs.

Blocks serve small radii. For a similarity of 0.8 on five-word shingles `similar` searches the trees
for candidates, by prints of 512 bits and a radius that a similar pair exceeds with a probability under
1e-5, in shards of the smallest shingle hashes, of which those that too many texts share come last. Then
all shingles of the candidates meet, and only texts whose exact Jaccard similarity is high enough are
linked.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxelyard.llm.common import SPACE_WORD, drop, pieces, stage
from voxelyard.llm.components import components
from voxelyard.llm.streams import groups

#: The contract's seed for XXH64.
SEED = 42
_ALL = (1 << 64) - 1
_UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
_WORD = re.compile(SPACE_WORD)


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """XXH64 of each word shingle of a whole text, repeats included; empty where it has no words."""
    words = _WORD.findall((text or "").translate(_UPPER) if not (text or "").isascii() else (text or "").lower())
    if not words:
        return np.zeros(0, np.uint64)
    coded = [*map(str.encode, words)]
    joined = b" ".join(coded)
    if len(coded) <= shingle:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, coded), np.int64, len(coded)) + 1)
    starts = np.concatenate(([0], ends[:-shingle])).tolist()
    stops = (ends[shingle - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts, stops)], np.uint64)


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """The unsigned 64-bit fingerprint of a whole text; 0 where it has no words."""
    hashes = shingle_hashes(text, shingle)
    return vote(hashes) if len(hashes) else 0


def _bit_counts(rows: np.ndarray) -> np.ndarray:
    """How many rows of bytes have each bit set. Bits are counted in byte lanes, eight to a machine word."""
    counts = np.zeros(8 * rows.shape[1], np.int64)
    for at in range(0, len(rows), 255):
        bits = np.unpackbits(rows[at : at + 255], axis=1)
        counts += np.add.reduce(bits.view(np.uint64), axis=0).view(np.uint8)
    return counts


def vote(hashes: np.ndarray) -> int:
    """Bits that are set in over half the hashes."""
    counts = _bit_counts(hashes.astype(">u8").view(np.uint8).reshape(-1, 8))
    return int.from_bytes(np.packbits(counts * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """doc_id, fp (the fingerprint's 64 bits as a signed long) per row. Narrow; whole texts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in pieces(whole):
                got = np.array([fingerprint(t, shingle) for t in b.column(1).to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got.view(np.int64))], ["doc_id", "fp"])

    key = docs.select(F.col(id_col)).schema[0].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(work, f"doc_id {key}, fp long")


class BKTree:
    """Fingerprints, each child keyed by its Hamming distance to the parent."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        values, children, node = self.values, self.children, 0
        values.append(value)
        children.append({})
        new = len(values) - 1
        while new:
            d = (values[node] ^ value).bit_count()
            nxt = children[node].get(d)
            if nxt is None:
                children[node][d] = new
                return
            node = nxt

    def near(self, value: int, radius: int) -> Iterator[int]:
        """Positions of the values within the radius."""
        if not self.values:
            return
        values, children, todo = self.values, self.children, [0]
        while todo:
            node = todo.pop()
            d = (values[node] ^ value).bit_count()
            if d <= radius:
                yield node
            for e, child in children[node].items():
                if d - radius <= e <= d + radius:
                    todo.append(child)


class _Forest:
    """Links of a spanning forest, by union and find."""

    def __init__(self) -> None:
        self.root: dict[int, int] = {}
        self.links: list[tuple[int, int]] = []

    def find(self, x: int) -> int:
        root = self.root
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    def link(self, x: int, y: int) -> None:
        a, b = self.find(x), self.find(y)
        if a != b:
            self.root[a] = b
            self.links.append((x, y))


def _forest(tree_side: list[int], query_side: list[int] | None, radius: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of all links inside tree_side, or between the two sides."""
    tree, forest = BKTree(), _Forest()
    for v in tree_side:
        if query_side is None:
            for at in tree.near(v, radius):
                forest.link(v, tree.values[at])
        tree.add(v)
    for v in query_side or ():
        for at in tree.near(v, radius):
            forest.link(v, tree.values[at])
    return forest.links


def _wide_forest(names: np.ndarray, prints: np.ndarray, queries: np.ndarray | None, radius: int | np.ndarray) -> list[tuple[int, int]]:
    """As _forest, for prints of several 64-bit words, on whole arrays of queries at once.

    names: what links are made of. radius: one, or that of each print when it asks. queries: positions of the query side, or None for all. A BK-tree
    built from the top down: a node's children are its other prints by their distance to it. The
    queries move down together; one follows the edges within the radius of its own distance.
    """
    forest = _Forest()
    inside = queries is None
    radius = np.broadcast_to(radius, len(names))
    tree = np.arange(len(names)) if inside else np.setdiff1d(np.arange(len(names)), queries)
    todo = [(tree, tree if inside else queries)]
    while todo:
        nodes, asking = todo.pop()
        if not len(nodes) or not len(asking):
            continue
        node, below = nodes[0], nodes[1:]
        far = np.bitwise_count(prints[asking] ^ prints[node]).sum(1, dtype=np.int64)
        for q in asking[far <= radius[asking]].tolist():
            if q != node:
                forest.link(int(names[q]), int(names[node]))
        if not len(below):
            continue
        apart = np.bitwise_count(prints[below] ^ prints[node]).sum(1, dtype=np.int64)
        order = np.argsort(apart, kind="stable")
        edges, first = np.unique(apart[order], return_index=True)
        for edge, part in zip(edges.tolist(), np.split(below[order], first[1:])):
            todo.append((part, asking[np.abs(far - edge) <= radius[asking]]))
    return forest.links


def choose_blocks(nodes: int, radius: int, shard_rows: int = 64) -> int:
    """The fewest blocks at which a shard of evenly spread fingerprints has at most shard_rows."""
    for blocks in range(radius + 1, radius + 5):
        if nodes / 2 ** (64 // blocks * (blocks - radius)) <= shard_rows:
            break
    return blocks


def link(nodes: DataFrame, radius: int = 4, shard_rows: int = 2048) -> DataFrame:
    """nodes: fp (distinct longs). Links (a, b) that connect all fingerprints within the radius."""
    count = nodes.count()
    blocks = choose_blocks(count, radius)
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    masks = []
    for chosen in combinations(range(blocks), blocks - radius):
        mask = sum(((1 << cuts[i + 1]) - (1 << cuts[i])) for i in chosen)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    keys = F.array(*[F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(m)).alias("bits")) for i, m in enumerate(masks)])
    dealt = nodes.select("fp", F.explode(keys).alias("k")).select("fp", "k.part", "k.bits")

    def search(g: dict[str, np.ndarray]) -> list[tuple[int, int]]:
        fps = g["fp"].view(np.uint64)
        if len(fps) > 64:
            queries = None if g["i"][0] == g["j"][0] else np.flatnonzero(g["in_tree"] != 1)
            return _wide_forest(fps, fps[:, None], queries, radius)
        if g["i"][0] == g["j"][0]:
            return _forest(np.sort(fps).tolist(), None, radius)
        tree = g["in_tree"] == 1
        return _forest(np.sort(fps[tree]).tolist(), np.sort(fps[~tree]).tolist(), radius)

    return _in_shards(dealt, search, shard_rows)


def _in_shards(
    dealt: DataFrame, search: Callable[[dict[str, np.ndarray]], list[tuple[int, int]]], shard_rows: int
) -> DataFrame:
    """dealt: fp, part, bits (the shard) and more. search is called for each pair of chunks."""
    more = [c for c in dealt.columns if c not in ("part", "bits", "fp")]
    hot = (
        dealt.groupBy("part", "bits").agg(F.count("*").alias("n")).where(F.col("n") > shard_rows)
        .select("part", "bits", F.ceil(F.col("n") / shard_rows).cast("int").alias("chunks"))
    )
    sized = dealt.join(hot, ["part", "bits"], "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    mine = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    pairs = (
        sized.withColumn("mine", mine)
        .select("part", "bits", "mine", "fp", *more, F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
        .select(
            "part", "bits", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
            "fp", (F.col("mine") <= F.col("other")).cast("int").alias("in_tree"), *more,
        )
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[int, int]] = []
        for g in groups(batches, 4):
            if len(g["fp"]) < 2:
                continue
            found += search(g)
            if len(found) > 50_000:
                yield _links(found)
                found = []
        yield _links(found)

    names = ["part", "bits", "i", "j"]
    return (
        pairs.repartition(*[F.col(n) for n in names]).sortWithinPartitions(*names)
        .select(*names, "fp", "in_tree", *more).mapInArrow(work, "a long, b long")
    )


def _links(found: list[tuple[int, int]]) -> pa.RecordBatch:
    arr = np.array([(a & _ALL, b & _ALL) for a, b in found], np.uint64).reshape(-1, 2).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(arr[:, 0]), pa.array(arr[:, 1])], ["a", "b"])


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, radius: int = 4, shard_rows: int = 2048
) -> DataFrame:
    """Per row: doc_id, fp (long), fingerprint (16 hex digits), component_id.

    component_id is the smallest doc_id reachable over links of at most `radius` differing bits.
    Null and empty texts, and texts of white space alone, have fingerprint zero and are linked like
    any other; repeated rows and equal ids stay, in one component; a null id takes no part in the
    smallest id (a component of null ids alone has component_id null). Other columns are not read,
    whatever their names. An empty table gives an empty table.
    """
    prints = stage(fingerprints(docs, id_col, text_col, shingle), "prints")
    nodes = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    roots = components(link(nodes.select("fp"), radius, shard_rows))
    labelled = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    best = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    of_fp = labelled.join(best, "root").select("fp", "component_id")
    return prints.join(of_fp, "fp").select(
        "doc_id", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def parity_print(hashes: np.ndarray, words: int = 8) -> np.ndarray:
    """64 x words bits of distinct hashes: a bit is 1 if an odd number of them fall on it.

    A hash that only one of two sets holds changes one bit, so prints differ in no more bits than
    the sets differ in hashes.
    """
    odd = np.bincount((hashes & np.uint64(64 * words - 1)).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


#: Odd multipliers and shifts of a bijective mix of 64 bits.
_MIX = ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53))


def wide_print(hashes: np.ndarray, words: int = 8) -> np.ndarray:
    """The SimHash of distinct hashes in 64 x words bits: each word votes with hashes mixed anew."""
    if not len(hashes):
        return np.zeros(words, np.uint64)
    salts = np.array([0x9E3779B97F4A7C15 * (w + 1) & _ALL for w in range(words)], np.uint64)
    counts = np.zeros(64 * words, np.int64)
    for at in range(0, len(hashes), 4080):
        h = hashes[at : at + 4080, None] + salts
        for shift, factor in _MIX:
            h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
        counts += _bit_counts((h ^ (h >> np.uint64(33))).view(np.uint8))
    return np.packbits(counts * 2 > len(hashes)).view(np.uint64)


def _verified(
    names: np.ndarray, sets: list[np.ndarray], queries: np.ndarray | None, similarity: float
) -> list[tuple[int, int]]:
    """Links of a spanning forest of all pairs whose exact Jaccard similarity is high enough.

    sets: distinct hashes. queries: positions of the query side, or None for all. Prints and sizes
    only rule out what cannot be similar.
    """
    prints = np.stack([parity_print(x) for x in sets])
    sizes = np.array([*map(len, sets)])
    label = np.arange(len(names))
    tree = label.copy() if queries is None else np.setdiff1d(label, queries)
    links = []
    for q in (tree if queries is None else queries).tolist():
        near = tree[tree < q] if queries is None else tree
        near = near[label[near] != label[q]]
        near = near[np.minimum(sizes[near], sizes[q]) >= similarity * np.maximum(sizes[near], sizes[q]) - 1e-9]
        most = (1 - similarity) / (1 + similarity) * (sizes[near] + sizes[q]) + 1e-9
        near = near[np.bitwise_count(prints[near] ^ prints[q]).sum(1, dtype=np.int64) <= most]
        for c in near.tolist():
            if label[c] == label[q]:
                continue
            both = len(np.intersect1d(sets[q], sets[c], assume_unique=True))
            if both / (sizes[q] + sizes[c] - both) >= similarity:
                links.append((int(names[q]), int(names[c])))
                label[label == label[c]] = label[q]
    return links


#: Of two sets of at least this Jaccard similarity a bit of the SimHash differs with a probability of at most
#: 3/16 (sets of four and five; 0.152 in large ones); of 512 bits more than this many with one under 1e-5.
WIDE_SIMILARITY, WIDE_RADIUS = 0.8, 136


def similar(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8,
    deals: int = 8, least: int = 16, shard_rows: int = 1024,
) -> DataFrame:
    """Per row: doc_id, text_hash, node, root (longs), component_id: groups of texts linked where the Jaccard similarity of
    their distinct five-word shingles (by hash) is at least `similarity` (0.8 or more).

    Candidates: a text is dealt to the shards of `deals` of its `least` smallest shingle hashes, those that
    are not too common first. Texts of up to `least` shingles that are similar always meet;
    larger ones miss each other with a probability of about (1 - s)^deals, 3e-6. In a
    shard the trees find the prints within WIDE_RADIUS. All texts that hang together by candidates meet with their whole sets of
    shingles, and the exact similarity decides. A node is a set of shingles.
    Null and empty texts have none and are one group; other edge cases are as in near_duplicates.
    """
    if similarity < WIDE_SIMILARITY:
        raise ValueError(f"the radius serves similarities from {WIDE_SIMILARITY}")
    words = 8

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in pieces(whole):
                got = [np.unique(shingle_hashes(t, shingle)) for t in b.column(1).to_pylist()]
                names = np.array([xxhash.xxh64_intdigest(h.tobytes(), SEED) for h in got], np.uint64).view(np.int64)
                sigs = [wide_print(h, words).view(np.int64) for h in got]
                lows = [h[:least].view(np.int64) for h in got]
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column(0), b.column(2), pa.array(names), pa.array([*map(len, got)], pa.int64()),
                        pa.array(sigs, pa.list_(pa.int64())), pa.array(lows, pa.list_(pa.int64())),
                    ],
                    ["doc_id", "text_hash", "node", "size", "sig", "least"],
                )

    key = docs.select(F.col(id_col)).schema[0].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(F.col(text_col)).alias("text_hash"))
    prints = stage(
        texts.mapInArrow(work, f"doc_id {key}, text_hash long, node long, size long, sig array<long>, least array<long>"), "prints"
    )
    nodes = stage(
        prints.groupBy("node").agg(
            F.min("doc_id").alias("least_id"), F.min("text_hash").alias("text_hash"), F.min("size").alias("size"),
            F.min("sig").alias("sig"), F.min("least").alias("least"),
        ),
        "nodes",
    )
    deals_of = stage(_dealt(nodes, 2 * shard_rows, deals), "deals")
    dealt = deals_of.join(nodes.select(F.col("node").alias("fp"), "sig"), "fp").select(
        "fp", "part", "bits", *[F.col("sig")[i].alias(f"w{i}") for i in range(words)]
    )

    def search(g: dict[str, np.ndarray]) -> list[tuple[int, int]]:
        sigs = np.stack([g[f"w{i}"].view(np.uint64) for i in range(words)], axis=1)
        queries = None if g["i"][0] == g["j"][0] else np.flatnonzero(g["in_tree"] != 1)
        return _wide_forest(g["fp"], sigs, queries, WIDE_RADIUS)

    near = components(_in_shards(dealt, search, shard_rows)).withColumnRenamed("root", "bits")
    drop(docs.sparkSession, deals_of)
    asked = nodes.join(near, "node").select("node", "bits", F.col("text_hash").alias("asked_hash"))
    whole = asked.join(texts, F.col("asked_hash") == F.col("text_hash")).dropDuplicates(["node"]).select("node", "bits", "text")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in pieces(b, 2):
                got = [np.unique(shingle_hashes(t, shingle)).view(np.int64) for t in part.column(2).to_pylist()]
                zero = pa.array(np.zeros(part.num_rows, np.int32))
                yield pa.RecordBatch.from_arrays([part.column(0), zero, part.column(1), pa.array(got, pa.list_(pa.int64()))], ["fp", "part", "bits", "hashes"])

    def verify(g: dict[str, np.ndarray]) -> list[tuple[int, int]]:
        queries = None if g["i"][0] == g["j"][0] else np.flatnonzero(g["in_tree"] != 1)
        return _verified(g["fp"], [h.view(np.uint64) for h in g["hashes"]], queries, similarity)

    met = stage(whole.mapInArrow(sets, "fp long, part int, bits long, hashes array<long>"), "shingles")
    roots = components(_in_shards(met, verify, shard_rows))
    labelled = nodes.select("node", "least_id").join(roots.withColumnRenamed("node", "node_"), F.col("node") == F.col("node_"), "left").select(
        "node", "least_id", F.coalesce("root", "node").alias("root")
    )
    best = labelled.groupBy("root").agg(F.min("least_id").alias("component_id"))
    of_node = stage(labelled.join(best, "root").select("node", "root", "component_id"), "groups")
    for done in (met, nodes):
        drop(docs.sparkSession, done)
    return prints.join(of_node, "node").select("doc_id", "text_hash", "node", "root", "component_id")


def _dealt(nodes: DataFrame, most: int, deals: int) -> DataFrame:
    """fp, part, bits: the shards of each node, by `deals` of its smallest hashes.

    Of its smallest hashes a node takes those first that at most `most` nodes have among theirs: a passage
    that many texts share puts them in one shard only where they have hardly another hash, as the copies
    in a large group have. The order (common or not, then the hash) is the same for all nodes, so two
    similar ones miss each other no likelier than by their smallest hashes. A shard of copies may have
    any size; _in_shards cuts it into chunks.
    """
    rows = nodes.select(F.col("node").alias("fp"), F.explode("least").alias("bits"))
    common = rows.groupBy("bits").agg(F.count("*").alias("n")).where(F.col("n") > most).select("bits", F.lit(1).alias("common"))
    told = rows.join(common, "bits", "left").withColumn("common", F.coalesce("common", F.lit(0)))
    place = F.row_number().over(Window.partitionBy("fp").orderBy("common", "bits"))
    return told.withColumn("place", place).where(F.col("place") <= deals).select("fp", F.lit(0).alias("part"), "bits")


def keep_first(docs: DataFrame, groups: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns, that stay: of each group of similar(docs) one.

    That with the smallest id stays; of texts that share the id, that with the smallest hash; of rows
    that repeat both, one. Of a group whose ids are all null one row stays. Null and empty texts are one
    group. Columns may have any names: a row travels as one struct. An empty table gives an empty table.
    """
    first = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = first.groupBy("root").agg(F.first("component_id").alias("kept_id"), F.min("text_hash").alias("kept_hash")).select("kept_id", "kept_hash").distinct()
    rows = groups.groupBy("doc_id", "text_hash").agg(F.count("*").alias("n"))
    kept = kept.join(rows, kept["kept_id"].eqNullSafe(rows["doc_id"]) & (kept["kept_hash"] == rows["text_hash"])).select("kept_id", "kept_hash", "n")
    held = docs.select(F.col(f"`{id_col}`").alias("row_id"), F.xxhash64(F.col(f"`{text_col}`")).alias("row_hash"), F.struct("*").alias("row"))
    met = held.join(kept, F.col("row_id").eqNullSafe(F.col("kept_id")) & (F.col("row_hash") == F.col("kept_hash")))
    # of rows that repeat id and text one stays: an aggregate, so that a row that fills a third of the table moves once a task
    many = met.where("n > 1").groupBy("row_id", "row_hash").agg(F.first("row").alias("row"))
    return met.where("n = 1").select("row").unionByName(many.select("row")).select("row.*")
