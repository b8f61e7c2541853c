"""The five stages of the corpus pipeline, each against brute force, on awkward rows and clashing names."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")
import corpus_pipeline as pipe  # noqa: E402
from voxelyard.llm import langid, mixing, quality, simhash  # noqa: E402

SF = "/root/testdata/sf0.001"
#: Names that the stages use inside.
CLASHES = "row row_id row_hash kept_id n copies rows taken_id part place here before copy count_id text_hash vy_hash vy_n vy_rows vy_id".split()


def shingles(text):
    t = (text or "").translate(str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)}))
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    return frozenset(" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_first(rows):
    """The (id, text) that stay: of each group linked by a Jaccard similarity of 0.8 the smallest id, then any one."""
    sets = [shingles(r.text) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if (not a and not b) or (a and b and len(a & b) / len(a | b) >= 0.8):
                root[find(i)] = find(j)
    best = {}
    for i, r in enumerate(rows):
        if r.doc_id is not None:
            best[find(i)] = min(best.get(find(i), r.doc_id), r.doc_id)
    return sorted(str(best.get(find(i))) for i in {find(i) for i in range(len(rows))})


@pytest.fixture(scope="module")
def docs(spark):
    plain = spark.read.parquet(f"{SF}/documents.parquet")
    rng = random.Random(6)
    some = plain.orderBy("doc_id").limit(30).collect()
    odd = [(None, None, None, None), (1_000_001, "", "en", "a"), (1_000_002, "①②", None, None), (1_000_003, "क्या है यह", None, "a"), (None, "x", "en", None)]
    odd += [(1_000_010, "same text " * 40, "en", "web")] * 5 + [(1_000_020, "w" * 30_000, "en", "b")]
    for i, r in enumerate(some):
        w = r.text.split(" ")
        if len(w) > 60:
            w[rng.randrange(len(w))] = "other"
        odd.append((2_000_000 + i, " ".join(w), r.lang, r.source))
    more = spark.createDataFrame(odd, "doc_id long, text string, lang string, source string")
    both = plain.select("doc_id", "text", "lang", "source").unionByName(more)
    return both.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHES)])


def key(rows):
    return sorted((str(r.doc_id), r.text or "") for r in rows)


def unharmed(df, docs):
    assert df.columns == docs.columns
    for r in df.collect():
        assert [r[c] for c in CLASHES] == list(range(len(CLASHES)))


def test_quality_stage(spark, docs):
    got = pipe.quality_stage(spark, docs, SF)
    model = quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    assert key(got.collect()) == key([r for r in docs.collect() if model.score(r.text) >= pipe.LEAST_QUALITY])
    unharmed(got, docs)
    assert pipe.quality_stage(spark, docs.where("false"), SF).count() == 0
    unlabelled = quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet").where("false"))
    assert quality.keep(docs, unlabelled, pipe.LEAST_QUALITY).count() == docs.count()


def test_language_stage(spark, docs):
    got = pipe.language_stage(spark, docs, SF)
    model = langid.fit(docs)
    want = [r for r in docs.collect() if (p := model.predict(r.text))[0] != "und" and p[1] >= pipe.LEAST_LANGUAGE]
    assert key(got.collect()) == key(want)
    ids = {r.doc_id for r in got.collect()}
    assert not ids & {1_000_001, 1_000_002, 1_000_003}
    clean = spark.read.parquet(f"{SF}/documents.parquet").join(spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1"), "doc_id")
    assert {r.doc_id for r in clean.collect()} <= ids
    unharmed(got, docs)
    assert pipe.language_stage(spark, docs.where("false"), SF).count() == 0


def test_near_duplicate_stage(spark, docs):
    got = pipe.dedup_stage(spark, docs, SF)
    assert sorted(str(r.doc_id) for r in got.collect()) == brute_first(docs.collect())
    unharmed(got, docs)
    assert pipe.dedup_stage(spark, docs.where("false"), SF).count() == 0


def test_mixing_stage(spark, docs):
    got = pipe.mixing_stage(spark, docs, SF)
    want = {}
    for r in mixing.mix(docs).collect():
        want[str(r.doc_id), r.text_hash] = want.get((str(r.doc_id), r.text_hash), 0) + r.copies
    mine = {}
    hashed = got.select("doc_id", F.xxhash64("text").alias("h"))
    for r in hashed.collect():
        mine[str(r.doc_id), r.h] = mine.get((str(r.doc_id), r.h), 0) + 1
    assert mine == {k: n for k, n in want.items() if n}
    unharmed(got, docs)
    assert pipe.mixing_stage(spark, docs.where("false"), SF).count() == 0


def test_repeated_rows_share_their_copies(spark):
    rows = spark.createDataFrame([(7, "one text here", "s", i) for i in range(40)], "doc_id long, text string, source string, nr int").repartition(6)
    h = rows.select(F.xxhash64("text").alias("h")).first().h
    for total in (0, 3, 40, 57, 120):
        mixture = spark.createDataFrame([(7, h, 1 if i < total % 40 else 0) for i in range(40)], "doc_id long, text_hash long, copies long").withColumn("copies", F.col("copies") + total // 40)
        counts = [r["count"] for r in mixing.apply(rows, mixture).groupBy("nr").count().collect()]
        assert sum(counts) == total and (not counts or max(counts) - min(counts) <= 1)


def test_tokens_stage(spark, docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    some = docs.where("doc_id is null or doc_id % 7 = 0 or doc_id > 1000000")
    got = pipe.tokens_stage(spark, some, SF).collect()
    want = []
    for r in some.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        plain = library.decode(ids, skip_special_tokens=False)
        want.append((str(r.doc_id), len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(plain.encode()).hexdigest()))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted(want)


def test_whole_run_follows_its_stages(spark):
    got = pipe.run(spark, SF)
    now = spark.read.parquet(f"{SF}/documents.parquet")
    for _, f in pipe.STAGES[:3]:
        now = f(spark, now, SF)
    sizes = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in now.collect()}
    ids = [r.doc_id for r in got.collect()]
    assert set(ids) <= set(sizes) and len(ids) > 0 and max(ids.count(i) for i in set(ids)) <= 2
    assert [n for n, _ in pipe.STAGES] == ["quality", "language", "near_duplicates", "mixing", "tokens"]


def test_a_common_passage_loses_no_link(spark):
    """Many texts share a passage, so that its hashes are dealt anew; links are those of brute force."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    passage = [word() for _ in range(60)]
    texts = []
    for i in range(150):
        own = passage + [word() for _ in range(rng.choice((10, 30, 60)))]
        texts.append(" ".join(own))
        if i % 3 == 0:
            own[-1] = word()
            texts.append(" ".join(own))
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    want = brute_first(rows.collect())
    for most in (8, 64):
        got = simhash.similar(rows, shard_rows=most)
        kept = simhash.keep_first(rows, got)
        assert sorted(str(r.doc_id) for r in kept.collect()) == want


def test_wide_prints_keep_similar_sets_within_the_radius():
    rng = np.random.default_rng(1)
    far = []
    for n in (4, 5, 8, 12, 20, 50, 200, 1000):
        for _ in range(60):
            both = rng.integers(0, 1 << 63, n, dtype=np.uint64)
            extra = n // 4  # similarity n / (n + extra) >= 0.8
            half = extra // 2
            new = rng.integers(0, 1 << 63, extra, dtype=np.uint64)
            a, b = np.concatenate((both, new[:half])), np.concatenate((both, new[half:]))
            far.append(int(np.bitwise_count(simhash.wide_print(a) ^ simhash.wide_print(b)).sum()))
    assert max(far) <= simhash.WIDE_RADIUS
    x, y = (rng.integers(0, 1 << 63, 300, dtype=np.uint64) for _ in range(2))
    assert int(np.bitwise_count(simhash.wide_print(x) ^ simhash.wide_print(y)).sum()) > simhash.WIDE_RADIUS
