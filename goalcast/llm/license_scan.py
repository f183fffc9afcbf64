"""License scan by diagonal voting.

The word k-gram hashes of every document are joined with the template positions of the same
gram; each hit votes for its diagonal (place in the document minus place in the template).
Neighbouring diagonals of one template merge into one candidate span, so a few inserted or
missing words do not split it, and a span counts if it covers enough of the template. Exact
phrases ("base") are found word by word beside it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from goalcast.llm import packed
from goalcast.llm.words import ALNUM_LOWER, gram_hashes, hashed_words
from goalcast.session import read_table

K = 3
#: Diagonals that merge, and the share of a template's words that a span must cover.
DRIFT, COVER = 2, 0.8
#: Words from which a partly quoted template counts, and how many of them it takes.
LONG_TEMPLATE, LONG_COVER = 24, 0.3

# Phrases and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Label and wording of license statements and notices.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Licensed under the MIT License."),
    ("mit", "This project is licensed under the terms of the MIT license."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
            "the Software, and to permit persons to whom the Software is furnished to do so"),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
               "compliance with the License. You may obtain a copy of the License at"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
            "option) any later version."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("proprietary", "All rights reserved."),
)


def _words(text: str) -> np.ndarray:
    parts = [h for _, _, h, _ in hashed_words(pa.array([text]), ALNUM_LOWER, lower=True)]
    return np.concatenate(parts)


def _base(phrases: tuple) -> Callable:
    schema = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), *[(c, pa.int64()) for c in ("n_words", "n_base", "first_word", "last_word")],
                        ("base", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sought = [(_words(p), label) for p, label in phrases]
        for b in batches:
            rows, ids, ths = [], b.column(0).to_pylist(), b.column(1).to_pylist()
            for i, j, words, counts in hashed_words(b.column(2), ALNUM_LOWER, lower=True):
                ends = np.cumsum(counts)
                found: dict[int, list] = {}
                for phrase, label in sought:
                    n = len(words) - len(phrase) + 1
                    hit = np.flatnonzero(reduce(np.logical_and, [words[x:x + n] == w for x, w in enumerate(phrase)])) if n > 0 else []
                    for at in hit:
                        d = int(np.searchsorted(ends, at, side="right"))
                        if at + len(phrase) <= ends[d]:        # not across two documents
                            found.setdefault(d, []).append((int(at - ends[d] + counts[d]), label))
                for d in range(j - i):
                    f = found.get(d, [])
                    rows.append((ids[i + d], ths[i + d], int(counts[d]), len(f), min(f)[0] if f else None,
                                 max(f)[0] if f else None, sorted({x for _, x in f})))
            yield packed.rows(schema, rows)
    return run


def _grams(k: int) -> Callable:
    schema = pa.schema([("_id", pa.int64()), ("_th", pa.int64()), ("grams", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, words, counts in hashed_words(b.column(2), ALNUM_LOWER, lower=True):
                # grams that begin in a document's last words run into the next and are cut off
                grams = np.append(gram_hashes(words, k), np.zeros(min(k - 1, len(words)), np.uint64)).view(np.int64)
                size = np.maximum(counts - k + 1, 0)
                begin = np.cumsum(counts) - counts
                keep = np.arange(len(grams)) - np.repeat(begin, counts) < np.repeat(size, counts)
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)), pa.int32()), pa.array(grams[keep]))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), b.column(1).slice(i, j - i), lists], schema=schema)
    return run


def _template_grams(spark, templates: tuple, k: int) -> DataFrame:
    rows = []
    for t, (label, text) in enumerate(templates):
        words = _words(text)
        rows += [(t, label, len(words), p, int(g)) for p, g in enumerate(gram_hashes(words, k).view(np.int64))]
    return spark.createDataFrame(rows, "template int, label string, length int, place int, gram long")


def _keyed(docs: DataFrame) -> DataFrame:
    packed.small_batches(docs.sparkSession)
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"))


def license_spans(docs: DataFrame, templates: tuple = TEMPLATES, k: int = K) -> DataFrame:
    """``(_id, _th, label, first_word, last_word, coverage)`` of the verified spans of templates;
    ``_th`` is ``xxhash64(text)``. Equal rows share their spans."""
    grams = _keyed(docs).mapInArrow(packed.lean(_grams(k)), "_id long, _th long, grams array<long>")
    known = F.broadcast(_template_grams(docs.sparkSession, templates, k))      # the templates' words
    hits = grams.select("_id", "_th", F.posexplode("grams").alias("pos", "gram")).join(known, "gram")
    votes = (hits.withColumn("diagonal", F.col("pos") - F.col("place"))
             .groupBy("_id", "_th", "template", "label", "length", "diagonal")
             .agg(F.min("pos").alias("lo"), F.max("pos").alias("hi"), F.collect_set("place").alias("places")))
    run = Window.partitionBy("_id", "_th", "template").orderBy("diagonal")
    merged = (votes.withColumn("new", F.when(F.col("diagonal") - F.lag("diagonal").over(run) <= DRIFT, 0).otherwise(1))
              .withColumn("span", F.sum("new").over(run))
              .groupBy("_id", "_th", "template", "label", "length", "span")
              .agg(F.min("lo").alias("first_word"), (F.max("hi") + (k - 1)).alias("last_word"), F.flatten(F.collect_list("places")).alias("places")))
    words = F.expr(f"size(array_distinct(flatten(transform(places, p -> sequence(p, p + {k - 1})))))")
    return (merged.withColumn("covered", words)
            .where(f"covered >= length * if(length >= {LONG_TEMPLATE}, {LONG_COVER}, {COVER})")
            # dense enough: the span is not much longer than the words it matched
            .where("last_word - first_word + 1 <= covered * 1.5 + 1")
            .select("_id", "_th", "label", "first_word", "last_word", F.least(F.lit(1.0), F.col("covered") / F.col("length")).alias("coverage")))


def scan_licenses(docs: DataFrame, templates: tuple = TEMPLATES, phrases: tuple = PHRASES) -> DataFrame:
    """``(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score)`` for every
    row of ``docs`` (doc_id, text; others are ignored): words are
    ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased; base columns tell of the exact
    phrases, ``labels`` adds the verified template spans. ``score`` is 1 where a phrase stands,
    else the best coverage of a template, else 0.

    Defined cases: a null or wordless text has 0 words, no places (nulls) and empty label
    strings; null doc_ids are scanned like others; repeated rows each get the full result; an
    empty table gives no rows.
    """
    base = _keyed(docs).mapInArrow(packed.lean(_base(phrases)), "doc_id long, th long, n_words long, n_base long, first_word long, last_word long, base array<string>")
    found = (license_spans(docs, templates).groupBy("_id", "_th")
             .agg(F.collect_set("label").alias("more"), F.max("coverage").alias("coverage")))
    none = F.array().cast("array<string>")
    joined = base.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")), "left")
    return joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce("more", none))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("coverage", F.lit(0.0))).alias("score"))


def op5_license_scan(spark, sf_dir: str) -> DataFrame:
    """Phrases and templates over every document."""
    return scan_licenses(read_table(spark, sf_dir, "documents"))


QUERIES = {"op5_license_scan": op5_license_scan}
