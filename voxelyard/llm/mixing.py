"""Operator 7: mixing sources to target weights by cube-method balanced sampling.

Each source has a target of words. A document is taken floor(r) times, r being the source's target
over its size, and once more with probability r - floor(r). Which documents get the extra copy is
drawn by the cube method: the vector of inclusion probabilities moves at random through the null
space of the balancing constraints (the words and the number of documents of the source stay what
they are) until it meets a side of the unit cube, and on, until at most two documents are
undecided. These moves (the flight) run in blocks of at most `block_rows` documents; what the blocks
leave meets in the next level's blocks, until a source is one block. The landing then decides the last
two together. No task holds more than a block, so a hot source is no more than many blocks.
"""

from __future__ import annotations

import random
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxelyard.llm.common import SPACE_WORD, stage


def target_words(sizes: dict[str | None, int], weights: Sequence[float], share: float, most: float) -> dict[str | None, float]:
    """Words for each source: share of all words by weight, none over `most` times its size.

    Sources are taken by code point, null last, and weigh weights[0], weights[1], ... repeating.
    """
    names = sorted((s for s in sizes if s is not None), key=lambda s: [*map(ord, s)]) + [s for s in sizes if s is None]
    weight = {s: float(weights[i % len(weights)]) for i, s in enumerate(names)}
    total, free, out = share * sum(sizes.values()), list(names), {}
    while free:
        rest = total - sum(out.values())
        by = sum(weight[s] for s in free)
        over = [s for s in free if rest * weight[s] / by > most * sizes[s]]
        if not over:
            out |= {s: rest * weight[s] / by for s in free}
            break
        out |= {s: most * sizes[s] for s in over}
        free = [s for s in free if s not in out]
    return {s: out[s] for s in names}


def flight(sizes: list[float], probs: list[float], rng: random.Random) -> list[float]:
    """Moves probs along the null space of (words, documents); at most two stay fractional."""
    probs = list(probs)
    active: list[int] = []
    for unit in [*(i for i, p in enumerate(probs) if 0 < p < 1), -1]:
        if unit >= 0:
            active.append(unit)
        while len(active) == 3:
            i, j, k = active
            a, b, c = sizes[i], sizes[j], sizes[k]
            move = (b - c, c - a, a - b) if not a == b == c else (1.0, -1.0, 0.0)
            up = down = float("inf")
            for x, m in zip(active, move):
                if m > 0:
                    up, down = min(up, (1 - probs[x]) / m), min(down, probs[x] / m)
                elif m < 0:
                    up, down = min(up, -probs[x] / m), min(down, (probs[x] - 1) / m)
            step = up if rng.random() * (up + down) < down else -down
            for x, m in zip(active, move):
                p = probs[x] + step * m
                probs[x] = 0.0 if p < 1e-9 else 1.0 if p > 1 - 1e-9 else p
            active = [x for x in active if 0 < probs[x] < 1]
    return probs


def landing(probs: list[float], rng: random.Random) -> list[float]:
    """Decides what is left (two units at most after a flight), keeping each one's probability."""
    probs = list(probs)
    open_ = [i for i, p in enumerate(probs) if 0 < p < 1]
    while len(open_) >= 2:  # moves two units against each other: their sum stays
        i, j = open_[:2]
        up, down = min(1 - probs[i], probs[j]), min(probs[i], 1 - probs[j])
        step = up if rng.random() * (up + down) < down else -down
        for x, s in ((i, step), (j, -step)):
            p = probs[x] + s
            probs[x] = 0.0 if p < 1e-9 else 1.0 if p > 1 - 1e-9 else p
        open_ = [x for x in open_ if 0 < probs[x] < 1]
    for x in open_:
        probs[x] = float(rng.random() < probs[x])
    return probs


def mix(
    docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0, block_rows: int = 4096,
    seed: int = 7, most_sources: int = 100_000, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """Per row: doc_id, text_hash, source, size, source_size, target, copies, taken (copies x size).

    A null or empty text has size 0 and is taken 0 words; a null source is a source of its own, after
    the others. Repeated rows are documents of their own. Reruns agree: the draws depend on the ids,
    texts and sources alone, and not on partitions. Null ids are fine. Other columns are not read,
    whatever their names. An empty table gives an empty table. The sources are summed by Spark and
    their sums, at most most_sources rows, are turned to targets on the driver.
    """
    spark = docs.sparkSession
    size = F.when(F.col("text").isNull(), 0).otherwise(F.regexp_count("text", F.lit(SPACE_WORD))).cast("long")
    rows = stage(
        docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(source_col).cast("string").alias("source"))
        .select("doc_id", F.xxhash64("text").alias("text_hash"), "source", size.alias("size")),
        "sizes",
    )
    sums = rows.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).limit(most_sources + 1).collect()
    if len(sums) > most_sources:
        raise ValueError(f"more than {most_sources} sources")
    sizes = {r["source"]: r["size"] for r in sums}
    target = target_words(sizes, weights, share, most)
    table = [
        (i, s, sizes[s], target[s], target[s] / sizes[s] if sizes[s] else 0.0, -(-n // block_rows))
        for i, (s, n) in enumerate((r["source"], r["n"]) for r in sorted(sums, key=lambda r: (r["source"] is None, r["source"] or "")))
    ]
    known = spark.createDataFrame(
        table, "s int, source string, source_size long, target double, ratio double, blocks int"
    )
    whole = rows.join(F.broadcast(known).withColumnRenamed("source", "source_"), F.col("source").eqNullSafe(F.col("source_"))).select(
        "doc_id", "text_hash", "source", "size", "s", "source_size", "target", "blocks",
        F.when(F.col("size") > 0, F.floor("ratio")).otherwise(0).alias("base"),
        F.when(F.col("size") > 0, F.col("ratio") - F.floor("ratio")).otherwise(0.0).alias("p"),
    )
    keyed = whole.withColumn("h", F.xxhash64(F.lit(seed), "doc_id", "text_hash", "s"))
    return _draw(keyed, {i: n for i, *_, n in table}, block_rows, seed).select(
        "doc_id", "text_hash", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def _draw(keyed: DataFrame, blocks: dict[int, int], block_rows: int, seed: int) -> DataFrame:
    """The flight, level by level (each a table in the shared folder), and the landing."""
    carried = [f for f in keyed.schema.fields if f.name not in ("s", "h", "size", "p")]
    schema = T.StructType([*T._parse_datatype_string("s int, block long, h long, size long, p double").fields, *carried])
    now, level, done = keyed, 0, None
    while True:
        last = max(blocks.values(), default=1) <= 1
        block = F.pmod(F.xxhash64(F.lit(level), F.col("h")), F.greatest("blocks", F.lit(1)).cast("long"))
        flown = stage(
            now.withColumn("block", block).repartition("s", "block").sortWithinPartitions("s", "block", "h", "size")
            .select(*schema.names).mapInArrow(_fly(last, seed + 1000 * level), schema),
            f"flight{level}",
        )
        ready = flown.where("p <= 0 or p >= 1")
        done = ready if done is None else done.unionByName(ready)
        if last:
            return done.withColumn("copies", (F.col("base") + F.col("p")).cast("long"))
        # at most two of a block stay open
        blocks = {s: -(-2 * n // block_rows) if n > 1 else 1 for s, n in blocks.items()}
        many = keyed.sparkSession.createDataFrame([(s, n) for s, n in blocks.items() if n > 1], "s_ int, more int")
        now = flown.where("p > 0 and p < 1").drop("block", "blocks").join(F.broadcast(many), F.col("s") == F.col("s_"), "left").withColumn(
            "blocks", F.coalesce("more", F.lit(1))
        ).drop("s_", "more")  # a row for each source of more than a block, most_sources at most
        level += 1


def _fly(last: bool, seed: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches):
            s, block = rows.column("s")[0].as_py(), rows.column("block")[0].as_py()
            rng = random.Random(f"{seed} {s} {block}")
            probs = flight(rows.column("size").to_numpy().astype(float).tolist(), rows.column("p").to_numpy().tolist(), rng)
            if last:
                probs = landing(probs, rng)
            at = rows.schema.get_field_index("p")
            yield from rows.set_column(at, "p", pa.array(probs, pa.float64())).to_batches()

    return work


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each (s, block) of a sorted partition."""
    open_: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        s, k = b.column(0).to_numpy(), b.column(1).to_numpy()
        cuts = [0, *(np.flatnonzero((s[1:] != s[:-1]) | (k[1:] != k[:-1])) + 1).tolist(), b.num_rows]
        for x, y in zip(cuts, cuts[1:]):
            key = (int(s[x]), int(k[x]))
            if open_ and key != last:
                yield pa.Table.from_batches(open_).combine_chunks()
                open_ = []
            last = key
            open_.append(b.slice(x, y - x))
    if open_:
        yield pa.Table.from_batches(open_).combine_chunks()


def apply(docs: DataFrame, mixture: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns, each as often as mix(docs) takes it.

    Rows are known by id and text. Rows that repeat both share out their copies: a key's k rows take
    c copies together, the first c mod k of them one more than the others, in the order of the table's
    partitions: each partition counts its rows of a key, so no task holds a key that fills a third of the
    table. Null and empty texts are never taken. Columns may have any names: a row travels as one
    struct. An empty table gives an empty table.
    """
    taken = mixture.groupBy(F.col("doc_id").alias("taken_id"), F.col("text_hash").alias("taken_hash")).agg(
        F.sum("copies").alias("copies"), F.count("*").alias("rows")
    ).where("copies > 0")
    held = docs.select(
        F.col(f"`{id_col}`").alias("row_id"), F.xxhash64(F.col(f"`{text_col}`").cast("string")).alias("row_hash"),
        F.spark_partition_id().alias("part"), F.struct("*").alias("row"),
    )
    met = held.join(taken, F.col("row_id").eqNullSafe(F.col("taken_id")) & (F.col("row_hash") == F.col("taken_hash")))
    many = met.where("rows > 1")
    counts = many.groupBy(F.col("row_id").alias("count_id"), F.col("row_hash").alias("count_hash"), F.col("part").alias("count_part")).agg(F.count("*").alias("here"))
    upto = Window.partitionBy("count_id", "count_hash").orderBy("count_part")
    counts = counts.select("count_id", "count_hash", "count_part", (F.sum("here").over(upto) - F.col("here")).alias("before"))
    placed = many.join(
        counts, F.col("row_id").eqNullSafe(F.col("count_id")) & (F.col("row_hash") == F.col("count_hash")) & (F.col("part") == F.col("count_part"))
    ).withColumn("place", F.col("before") + F.row_number().over(Window.partitionBy("row_id", "row_hash", "part").orderBy("before")))
    shared = F.floor(F.col("copies") / F.col("rows")) + (F.col("place") <= F.col("copies") % F.col("rows")).cast("long")
    rows = met.where("rows = 1").select("row", F.col("copies").alias("n")).unionByName(placed.select("row", shared.alias("n")))
    return rows.where("n > 0").select("row", F.explode(F.expr("sequence(1L, n)")).alias("copy")).select("row.*")
