"""License texts and phrases in documents, by diagonal voting.

All rolling word k-gram hashes of the documents are joined in Spark to the places of the templates' k-grams. A hit of a
document's word p with a template's word j votes for the diagonal p - j; diagonals that lie near each other (words put
in or left out) are merged, and a merged span is verified by the share of the template's words that its hits cover.
A hit needs two independent 64-bit hashes to agree.
"""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .storage import small_batches
from .textbatch import batches, one_text

K = 3
#: Fixed phrases whose every place is reported.
PHRASES = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]
#: Fixed wording of public licenses and notices; a span covering most of one gives its label.
NOTICES = [
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", "apache-2"),
    ("licensed under the apache license version 2 0", "apache-2"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("licensed under the gnu general public license", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("licensed under a creative commons attribution noncommercial", "cc-by-nc"),
    ("licensed under a creative commons attribution", "cc-by"),
    ("creative commons attribution sharealike", "cc-by-sa"),
    ("all rights reserved", "reserved"),
]
#: Whole texts of public licenses, as published: a file for each, named by its label.
TEXTS = Path(__file__).parent / "licenses"
_HITS = "uid long, pos int, n_words long, hash long, check long"


def license_texts(folder: Path = TEXTS) -> list[tuple[str, str]]:
    """(text, label) of the license texts in a folder on the driver; labels are the files' names in lower case."""
    return [(f.read_text(encoding="utf-8"), f.stem.lower()) for f in sorted(folder.glob("*.txt"))]


def template_grams(spark: SparkSession, templates: list[tuple[str, str, bool]], k: int = K) -> DataFrame:
    """(template, label, is_phrase, n, j, hash, check): a row for each k-gram of each template."""
    rows = []
    for i, (words, label, phrase) in enumerate(templates):
        w = one_text(words)
        if len(w.hashes) < k:
            raise ValueError(f"a template needs {k} words: {words[:80]}")
        places, hashes = w.grams(k)
        check = w.grams(k, 1)[1]
        rows += [(i, label, phrase, len(w.hashes), int(j), int(h), int(c)) for j, h, c in zip(places, hashes.view(np.int64), check.view(np.int64), strict=True)]
    return spark.createDataFrame(rows, "template int, label string, is_phrase boolean, n int, j int, hash long, check long")


def doc_grams(docs: DataFrame, id_col: str, text: str, k: int = K) -> DataFrame:
    """A row with pos -1, the id and the number of words for each document, and one for each of its k-grams."""
    small_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("__id"), F.monotonically_increasing_id().alias("uid"), F.col(text).alias("__text"))
    schema = source.select("uid", F.lit(0).alias("pos"), F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("hash"), F.lit(0).cast("long").alias("check"), "__id").schema
    for field in schema.fields:
        field.nullable = True

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            ids, uid = batch.column(0), np.asarray(batch.column(1))
            for a, b, w in batches(batch.column(2)):
                n = b - a
                none = pa.nulls(n, pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(uid[a:b]), pa.array(np.full(n, -1, np.int32)), pa.array(w.counts.astype(np.int64)), none, none, ids.slice(a, n)], names=schema.names)
                places, hashes = w.grams(k)
                if len(places):
                    doc = np.searchsorted(w.at, places, "right") - 1
                    yield pa.RecordBatch.from_arrays([pa.array(uid[a:b][doc]), pa.array((places - w.at[doc]).astype(np.int32)), pa.nulls(len(places), pa.int64()), pa.array(hashes.view(np.int64)), pa.array(w.grams(k, 1)[1].view(np.int64)), pa.nulls(len(places), ids.type)], names=schema.names)

    return source.mapInArrow(run, schema)


def copies_of(places: list[int], words: list[int], n: int, cover: float, most: int) -> list[tuple[int, int, int]]:
    """(start, length, covered) of spans that do not overlap, of `most` words at most, whose hits (a document's word and a
    template's word, in order) cover at least `cover` of the template's n words; each is carried on while its hits go on.
    Every hit is added and taken away once, with a running number of covered words."""
    out: list[tuple[int, int, int]] = []
    counts, covered, left, r = [0] * n, 0, 0, 0
    while r < len(places):
        p, j = places[r], words[r]
        for k in range(j, j + K):
            covered += not counts[k]
            counts[k] += 1
        while places[left] + most < p + K:
            for k in range(words[left], words[left] + K):
                counts[k] -= 1
                covered -= not counts[k]
            left += 1
        r += 1
        if covered / n < cover:
            continue
        start, last = places[left], max(words[left:r])
        while r < len(places) and words[r] > last and places[r] + K <= start + most:
            p, last = places[r], words[r]
            for k in range(last, last + K):
                covered += not counts[k]
                counts[k] += 1
            r += 1
        out.append((start, p + K - start, covered))
        while r < len(places) and places[r] < p + K:
            r += 1
        counts, covered, left = [0] * n, 0, r
    return out


def cut_islands(cover: float, gap: int):
    """The copies in each island: hits (p, j) and the template's number of words in, spans out, by Arrow batches."""
    span = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("covered", pa.int32())]))

    @F.arrow_udf("array<struct<start:int,length:int,covered:int>>")
    def split(hits: pa.Array, n: pa.Array) -> pa.Array:
        pairs, out = hits.flatten(), []
        p, j = (np.asarray(pairs.field(i)) for i in (0, 1))
        order = np.lexsort((j, p))  # within each row
        row = np.repeat(np.arange(len(hits)), hits.value_lengths().fill_null(0).to_numpy())
        order = order[np.argsort(row[order], kind="stable")]
        p, j, ends = p[order].tolist(), j[order].tolist(), np.searchsorted(row, np.arange(len(hits) + 1)).tolist()
        for i, (there, size) in enumerate(zip(hits.is_valid().to_pylist(), n.to_pylist(), strict=True)):
            found = copies_of(p[ends[i] : ends[i + 1]], j[ends[i] : ends[i + 1]], size, cover, size + 2 * gap) if there else None
            out.append(found and [dict(zip(("start", "length", "covered"), x, strict=True)) for x in found])
        return pa.array(out, span)

    return split


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    phrases: list[tuple[str, str]] = PHRASES,
    notices: list[tuple[str, str]] = NOTICES,
    cover: float = 0.8,
    gap: int = 4,
    most_broadcast: int = 1_000_000,
    texts: list[tuple[str, str]] | None = None,
) -> DataFrame:
    """One row for each row of docs: id_col, n_words, n_base, first_word, last_word, base_labels, labels, score, and
    matches: array<struct<label,start,length,covered>> of the verified spans in words.

    phrases: all places where their words stand consecutively count as base. notices: a span of merged diagonals counts
    when it covers at least `cover` of the notice; of copies that follow each other, each is a match. texts: whole licenses
    (by default license_texts()), matched as notices are. A match that lies inside a longer one of another template is part
    of that one and is left out: a license that names another one in its text gets its own label only. Base places stay
    wherever they are. score is the largest covered share of any template (0 without hits).
    A null or empty text has 0 words and no labels (empty strings); rows that repeat, and rows of one id, each keep
    their own row; other columns of docs are not read. The templates are broadcast up to most_broadcast k-grams, beyond
    that Spark chooses the join.
    """
    spark = docs.sparkSession
    texts = license_texts() if texts is None else texts
    templates = [(p, label, True) for p, label in phrases] + [(p, label, False) for p, label in [*notices, *texts]]
    grams = template_grams(spark, templates)
    n_grams = sum(len(p.split()) for p, _, _ in templates)
    side = F.broadcast(grams) if n_grams <= most_broadcast else grams
    rows = doc_grams(docs, id_col, text)
    hits = rows.join(side, ["hash", "check"], "left").filter((F.col("pos") < 0) | F.col("template").isNotNull())
    # one row for each document and diagonal; a diagonal holds at most one hit for each of the template's words
    diagonals = (
        hits.groupBy("uid", "template", (F.col("pos") - F.col("j")).alias("diagonal"))
        .agg(F.max("__id").alias("__id"), F.max("n_words").alias("n_words"), F.max("label").alias("label"), F.max("is_phrase").alias("is_phrase"), F.max("n").alias("n"), F.collect_set("j").alias("js"))
    )
    split = cut_islands(cover, gap)
    by = W.partitionBy("uid", "template").orderBy("diagonal")
    opens = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(by) > F.when(F.col("is_phrase"), 0).otherwise(gap), F.lit(True))
    islands = (
        diagonals.withColumn("island", F.sum(opens.cast("int")).over(by))
        .groupBy("uid", "template", "island")
        .agg(*(F.max(c).alias(c) for c in ("__id", "n_words", "label", "is_phrase", "n")), F.min(F.col("diagonal") + F.array_min("js")).alias("start"), F.max(F.col("diagonal") + F.array_max("js") + K).alias("end"), F.flatten(F.collect_list(F.transform("js", lambda j: F.struct((F.col("diagonal") + j).alias("p"), j.alias("j"))))).alias("hits"))
        .withColumn("js", F.col("hits.j"))
        .withColumn("covered", F.size(F.array_distinct(F.flatten(F.transform("js", lambda j: F.sequence(j, j + (K - 1)))))))
        .withColumn("share", F.when(F.col("template").isNull(), 0.0).otherwise(F.col("covered") / F.col("n")))
        .withColumn("base", F.coalesce(F.col("is_phrase") & (F.col("covered") == F.col("n")), F.lit(False)))
        # copies that follow each other make one island: it is cut where it is too long or holds a place twice
        .withColumn("long", F.col("end") - F.col("start") > F.col("n") + 2 * gap)
        .withColumn("cut", ~F.col("is_phrase") & (F.col("share") >= cover) & (F.col("long") | (F.size("js") > F.size(F.array_distinct("js")))))
        .withColumn("copies", split(F.when(F.col("cut"), F.col("hits")), F.col("n")))
        .withColumn("one", F.when(F.col("is_phrase"), F.col("base")).otherwise((F.col("share") >= cover) & ~F.col("long")))
        .withColumn("spans", F.when(F.col("cut"), F.col("copies")).when(F.col("one"), F.array(F.struct("start", (F.col("end") - F.col("start")).alias("length"), "covered"))))
    )
    # spans by start; one is inside another if an earlier one ends no sooner, or a longer one begins with it
    each = islands.select("*", F.explode_outer("spans").alias("span")).drop("hits", "js", "copies", "spans")
    end, of_row = F.col("span.start") + F.col("span.length"), W.partitionBy("uid")
    before = F.max(end).over(of_row.orderBy("span.start").rangeBetween(W.unboundedPreceding, -1))
    longest = F.max("span.length").over(W.partitionBy("uid", "span.start"))
    inside = F.coalesce((before >= end) | (longest > F.col("span.length")), F.lit(False))
    each = each.withColumn("good", F.col("span").isNotNull() & (F.col("base") | ~inside))
    base, good = F.col("base"), F.col("good")
    labels = lambda cond: F.array_join(F.array_sort(F.collect_set(F.when(cond, F.col("label")))), ",")
    return (
        each.groupBy("uid")
        .agg(
            F.max("__id").alias(id_col), F.max("n_words").alias("n_words"), F.count_if(base).cast("long").alias("n_base"),
            F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"), F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
            labels(base).alias("base_labels"), labels(good).alias("labels"), F.max(F.least(F.lit(1.0), F.col("share"))).alias("score"),
            F.array_sort(F.collect_list(F.when(good, F.struct("label", F.col("span.start").alias("start"), F.col("span.length").alias("length"), F.col("span.covered").alias("covered"))))).alias("matches"),
        )
        .drop("uid")
    )
