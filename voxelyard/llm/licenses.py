"""Operator 2: license scans by diagonal voting.

Every rolling k-gram of a text's words (k = 2) is hashed and joined in Spark to the positions of the
same k-grams in the license templates; the templates are constants, a few hundred rows, so that side
is broadcast. A match at word p of a text and word t of a template votes for the diagonal p - t.
Votes are counted by text, template and diagonal. Neighbouring diagonals (a word more or less inside
a passage) are merged, and a merged span is verified by the share of the template's k-grams it holds,
each place of the template counted once however often its words repeat in the text.
A phrase is found where all its k-grams voted for one diagonal; the words are compared as words, so
equal hashes of different words never count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Separators: what is left of ASCII after digits and lower-case letters.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Fixed values of the contract: phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Notices in common use, by the label that their presence adds.
NOTICES = {
    "gpl-notice": "this work is licensed under the gnu general public license version 3",
    "lgpl-notice": "gnu lesser general public license as published by the free software foundation",
    "apache-2.0-notice": "licensed under the apache license version 2 0",
    "mit-notice": "released under the mit license",
    "mit-permission": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
    "bsd-conditions": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "cc-by-nc-4.0": "licensed under cc by nc 4 0",
    "cc-by-sa-4.0": "licensed under cc by sa 4 0",
    "mpl-2.0-notice": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "unlicense": "this is free and unencumbered software released into the public domain",
}
#: k-grams too common in plain prose to vote; no phrase of the contract holds one.
COMMON = {"of the", "and the", "to the", "is a", "in the", "to any", "that the", "is the", "this is", "is to"}
K = 2


def templates(spark: SparkSession) -> DataFrame:
    """gram, hash, template, label, kind, at (position), grams (how many of the template vote)."""
    rows = []
    for kind, found in (("phrase", {p: p for p in PHRASES}), ("notice", {label: text for label, text in NOTICES.items()})):
        for name, text in found.items():
            words = text.split(" ")
            grams = [(i, " ".join(words[i : i + K])) for i in range(len(words) - K + 1)]
            grams = [(i, g) for i, g in grams if kind == "phrase" or g not in COMMON]
            label = PHRASES[name] if kind == "phrase" else name
            rows += [(*g.split(" "), name, label, kind, i, len(grams)) for i, g in grams]
    frame = spark.createDataFrame(rows, "one string, two string, template string, label string, kind string, at int, grams int")
    return frame.withColumn("hash", F.xxhash64("one", "two"))


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", drift: int = 3, least_share: float = 0.6
) -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    n_base, first_word, last_word and base_labels are of the phrases alone, by the contract. labels
    adds those of notices whose merged span holds at least least_share of the template's k-grams;
    score is the largest such share (1 where a phrase is found, 0 where nothing is).
    Null texts are empty ones: no words, no labels (empty strings), nulls for first and last. Very
    long texts are scanned whole. Repeated rows and equal ids stay rows of their own (a row is known
    by its place in the scan). Null ids stay null. Other columns are not read, whatever their names.
    """
    spark = docs.sparkSession
    lowered = F.translate(F.coalesce(F.col("text"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.array_remove(F.split(lowered, SEPARATORS, -1), "")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    cut = rows.select("row", "doc_id", words.alias("w")).select(
        "row", "doc_id", F.size("w").alias("n_words"),
        F.posexplode_outer(F.arrays_zip(F.col("w").alias("one"), F.expr("slice(w, 2, size(w))").alias("two"))).alias("p", "gram"),
    )
    grams = cut.select("row", "doc_id", "n_words", "p", F.col("gram.one").alias("w1"), F.col("gram.two").alias("w2")).withColumn(
        "hash", F.xxhash64("w1", "w2")
    )
    t = templates(spark)
    # left: the first gram of each row keeps the row where nothing matches
    met = grams.join(F.broadcast(t), (grams["hash"] == t["hash"]) & (F.col("w1") == F.col("one")) & (F.col("w2") == F.col("two")), "left").where(
        "template is not null or p = 0 or p is null"
    )
    votes = met.groupBy("row", "doc_id", "n_words", "template", "label", "kind", "grams", (F.col("p") - F.col("at")).alias("diagonal")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at"))).alias("places"), F.min("p").alias("low"), F.max("p").alias("high")
    )
    near = Window.partitionBy("row", "template").orderBy("diagonal")
    apart = (F.col("diagonal") - F.lag("diagonal").over(near) > drift) | (F.col("low") > F.lag("high").over(near) + 2 * F.col("grams"))
    spans = votes.withColumn(
        "span", F.when(F.col("kind") == "notice", F.sum(F.coalesce(apart, F.lit(True)).cast("int")).over(near)).otherwise(F.col("diagonal"))
    )
    merged = spans.groupBy("row", "doc_id", "n_words", "template", "label", "kind", "grams", "span").agg(
        (F.bit_count(F.bit_or("places")) / F.col("grams")).alias("share"),
        F.min("diagonal").alias("begin"),
    )
    whole = (F.col("kind") == "phrase") & (F.col("share") >= 1)
    notice = (F.col("kind") == "notice") & (F.col("share") >= least_share)
    return merged.groupBy("row", "doc_id", "n_words").agg(
        F.count(F.when(whole, 1)).alias("n_base"),
        F.min(F.when(whole, F.col("begin"))).cast("long").alias("first_word"),
        F.max(F.when(whole, F.col("begin"))).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(whole, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set(F.when(whole | notice, F.col("label")))), ",").alias("labels"),
        F.coalesce(F.max(F.when(whole | notice, F.col("share"))), F.lit(0.0)).alias("score"),
    ).select("doc_id", F.col("n_words").cast("long").alias("n_words"), "n_base", "first_word", "last_word", "base_labels", "labels", "score")
