"""License scans by diagonal voting (operator 8).

Built-in functions only. Every k-gram of words of every document is joined by its hash to the positions of the
templates. The words of a hit, and of no other gram, are compared with the template's, so that only true ones vote for their diagonal
(document position less template position); neighbouring diagonals, shifted by inserted or left out words, are merged,
and a merged span counts if the places verified cover enough of its template.

Templates are a table of positions: Spark broadcasts it where it is small, and joins by a shuffle where it is not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window

from panelkit.functions.durable import settle
from panelkit.llm.text import ascii_lower

#: fixed values: the phrases that are searched for and their labels
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: fixed values: passages of public license texts and their labels
PASSAGES = (
    (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
        "mit",
    ),
    (
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
        "distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY "
        "KIND, either express or implied",
        "apache",
    ),
    (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version",
        "gpl",
    ),
    (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: Redistributions of source code must retain the above copyright notice, this "
        "list of conditions and the following disclaimer",
        "bsd",
    ),
    (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies",
        "isc",
    ),
)
#: words in a k-gram of a phrase, which must be met in full, and of a passage
PHRASE_GRAM, PASSAGE_GRAM = 2, 5
#: diagonals of a passage up to so many words apart are one span
DRIFT = 8
#: share of a passage's k-grams that a span must have
COVERAGE = 0.5
#: places of a text that are one row while its grams are taken
PIECE = 128

OTHER = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def scan_words(text: str = "text") -> Column:
    lowered = ascii_lower(F.coalesce(F.col(text), F.lit("")))
    return F.filter(F.split(lowered, OTHER), lambda x: x != "")


def _grams(hashes: Column, n: Column, k: int) -> Column:
    """Hashes of all runs of k words."""
    one = lambda i: F.xxhash64(F.lit(k), *[F.get(hashes, i + j) for j in range(k)])
    return F.when(n >= k, F.transform(F.sequence(F.lit(0), n - k), one)).otherwise(F.array().cast("array<bigint>"))


def _texts(words: Column, n: Column, k: int) -> Column:
    """All runs of k words."""
    one = lambda i: F.concat_ws(" ", *[F.get(words, i + j) for j in range(k)])
    return F.when(n >= k, F.transform(F.sequence(F.lit(0), n - k), one)).otherwise(F.array().cast("array<string>"))


def _templates(spark, phrases, passages) -> DataFrame:
    """hash, gram, k, template, position, needed, grams, label; one more row, with k 0, is met once by every document."""
    rows = [(i, k, share, drift, label, text)
            for i, (k, share, drift, (text, label)) in enumerate(
                [(PHRASE_GRAM, 1.0, 0, x) for x in phrases] + [(PASSAGE_GRAM, COVERAGE, DRIFT, x) for x in passages])]
    listed = spark.createDataFrame(rows, "template int, k int, needed double, drift int, label string, text string")
    hashed = listed.withColumn("w", scan_words()).withColumn("h", F.transform("w", lambda w: F.xxhash64(w))).withColumn("n", F.size("h"))
    short = F.col("k") == PHRASE_GRAM
    hashes, texts = (
        F.when(short, of(F.col(c), F.col("n"), PHRASE_GRAM)).otherwise(of(F.col(c), F.col("n"), PASSAGE_GRAM))
        for of, c in ((_grams, "h"), (_texts, "w"))
    )
    found = hashed.withColumns({"hash": hashes, "gram": texts}).select(
        "template", "k", "needed", "drift", "label", F.size("hash").alias("grams"), F.posexplode(F.arrays_zip("hash", "gram")).alias("position", "e")
    ).select("template", "k", "needed", "drift", "label", "grams", "position", "e.hash", "e.gram")
    mark = spark.sql("select -1 template, 0 k, 2D needed, 0 drift, '' label, 1 grams, 0 position, 0L hash, '' gram")
    return settle(found.unionByName(mark))


def scan(docs: DataFrame, phrases=PHRASES, passages=PASSAGES) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    n_base counts the places of phrases, first_word and last_word are the smallest and largest start among them.
    labels are those of phrases and of passages of which a span covers COVERAGE or more; score is the best coverage
    among what counts, 0 without any. Null and blank texts have no words. Rows that repeat both id and text are scanned
    once and given back as often as they come; a null id is kept. A text of any length is cut into pieces of PIECE places, its hits are rows of their own.
    """
    split = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("_text"), scan_words().alias("_w"))
    # a piece has the words of the grams that start at its places, so what goes along with a gram is short
    piece = lambda i: F.struct(i.alias("start"), F.slice("_w", i + 1, PIECE + PASSAGE_GRAM - 1).alias("words"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("_w") - 1, F.lit(0)), F.lit(PIECE))
    # outer, though no list is empty, here and below: else Spark infers a filter on the list's size, which takes the list
    # once more, and for every word the hashes of all
    pieces = (
        split.withColumns({"n_words": F.size("_w"), "_pieces": F.transform(starts, piece)})
        .select("doc_id", "_text", "n_words", F.explode_outer("_pieces").alias("_piece"))
        .select("doc_id", "_text", "n_words", F.col("_piece.start").alias("_start"), F.col("_piece.words").alias("_w"))
        .withColumns({"_h": F.transform("_w", lambda w: F.xxhash64(w)), "_n": F.size("_w")})
    )
    start, n = F.col("_start"), {PHRASE_GRAM: F.least(F.col("_n"), F.lit(PIECE + PHRASE_GRAM - 1)), PASSAGE_GRAM: F.col("_n")}
    # places in the list: the mark (of a text's first piece), the short grams, the long grams
    every = F.concat(F.array(F.when(start == 0, F.lit(0).cast("long"))), *[_grams(F.col("_h"), n[k], k) for k in n])
    exploded = pieces.withColumn("_every", every).select(
        "doc_id", "_text", "n_words", "_start", "_w", "_n", F.posexplode_outer("_every").alias("_at", "hash"))
    at, long_from = F.col("_at"), F.greatest(n[PHRASE_GRAM] - PHRASE_GRAM + 1, F.lit(0)) + 1
    place = F.when(at >= long_from, at - long_from).otherwise(F.greatest(at - 1, F.lit(0)))
    length = F.when(at == 0, 0).when(at >= long_from, PASSAGE_GRAM).otherwise(PHRASE_GRAM)
    listed = exploded.select("doc_id", "_text", "n_words", "hash", (start + place).alias("_place"),
                             F.concat_ws(" ", F.slice("_w", place + 1, length)).alias("_gram"))
    # the hash alone is the key, and the words are compared behind the join: in its condition they would be put together
    # for every gram, not for those that meet a template
    hits = listed.join(_templates(docs.sparkSession, phrases, passages), "hash").withColumns(
        {"diagonal": F.col("_place") - F.col("position"), "_same": F.col("_gram") == F.col("gram")})
    document, template = ("doc_id", "_text", "n_words"), ("template", "k", "needed", "drift", "label", "grams")
    votes = (
        hits.groupBy(*document, *template, "diagonal")
        .agg(F.collect_set(F.when(F.col("_same"), F.col("position"))).alias("met"), F.count_if("_same").alias("_rows"))
        .filter("_rows > 0")
    )
    along = Window.partitionBy("doc_id", "_text", "template").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > F.col("drift"), F.lit(True))
    spans = (
        votes.withColumn("_new", apart.cast("int"))
        .withColumn("_span", F.sum("_new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*document, *template, "_span")
        .agg(F.min("diagonal").alias("start"), F.max("_rows").alias("_rows"),
             (F.size(F.array_distinct(F.flatten(F.collect_list("met")))) / F.first("grams")).alias("covered"))
    )
    good = F.col("covered") >= F.col("needed")
    base = good & (F.col("k") == PHRASE_GRAM)
    names = lambda c: F.array_join(F.array_sort(F.collect_set(F.when(c, F.col("label")))), ",")
    return spans.groupBy(*document).agg(
        F.sum(base.cast("long")).alias("n_base"),
        F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
        names(base).alias("base_labels"), names(good).alias("labels"),
        F.coalesce(F.max(F.when(good, F.col("covered"))), F.lit(0.0)).alias("score"),
        # a row votes once for the mark
        F.max(F.when(F.col("k") == 0, F.col("_rows"))).cast("int").alias("_copies"),
    ).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), "n_base", "first_word", "last_word",
        "base_labels", "labels", "score")

