"""License scan: sparse TF-IDF cosine of text segments to templates, then inheritance from the nearest ancestor directory.

Segments are the lines of a text and the text as a whole. Weights come from the document frequencies of the templates' words over the whole
corpus. Files without a licence of their own inherit that of the nearest directory above that holds a licence file.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import pinned, released
from .text_arrays import WordHasher, distinct, text_slices, word_bounds

#: license -> notices that name it, in plain words
TEMPLATES: dict[str, list[str]] = {
    "MIT": ["Released under the MIT License.", "This software is licensed under the MIT license.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the "
            "software without restriction, including the rights to use, copy, modify, merge, publish, distribute, sublicense and sell copies"],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file "
                   "except in compliance with the License. You may obtain a copy of the License at"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", "This program is free software: you can redistribute it and/or modify it "
                "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2.", "This program is free software; you can redistribute it and/or modify it "
                "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License"],
    "LGPL-3.0": ["Licensed under the GNU Lesser General Public License, version 3."],
    "AGPL-3.0": ["Licensed under the GNU Affero General Public License, version 3."],
    "BSD-3-Clause": ["Released under the BSD 3-Clause License.", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related rights to this work, CC0 1.0 Universal."],
}
#: cosine that a segment must reach, and share of a text's words that licensed segments must have for it to be a licence file
COSINE, FILE_SHARE = 0.7, 0.5


def lower_table() -> np.ndarray:
    """Bytes as they are compared: A-Z in lower case, punctuation other than ``-`` and digits' dots as space."""
    table = np.arange(256, dtype=np.uint8)
    table[ord("A"):ord("Z") + 1] += 32
    for c in ",;:()[]\"'!?/*#":
        table[ord(c)] = 0x20
    return table


def words_of(text: str) -> list[bytes]:
    flat = bytes(lower_table()[np.frombuffer(text.encode(), np.uint8)])
    return [w.rstrip(b".") or w for w in re.findall(rb"[^\x20\x09-\x0D]+", flat)]


def _hashed(words: list[bytes], hasher: WordHasher) -> np.ndarray:
    data, ends = np.frombuffer(b"".join(words), np.uint8), np.cumsum([len(w) for w in words])
    return hasher(data, np.r_[0, ends[:-1]], ends)


def vocabulary() -> dict:
    """Sorted hashes of the templates' words and each template as (name, word numbers)."""
    hasher = WordHasher()
    notices = [(name, _hashed(words_of(t), hasher)) for name, texts in TEMPLATES.items() for t in texts]
    terms = np.unique(np.concatenate([h for _, h in notices]))
    return {"terms": terms, "notices": [(name, np.searchsorted(terms, h)) for name, h in notices]}


def _lookup(terms: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Number of each word in the vocabulary, or -1."""
    at = np.minimum(np.searchsorted(terms, hashes), len(terms) - 1)
    return np.where(terms[at] == hashes, at, -1)


def _words(data: np.ndarray, offsets: np.ndarray, hasher: WordHasher) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every word, without dots at its end."""
    flat = lower_table()[data]
    starts, ends = word_bounds(flat, offsets)
    for _ in range(3):
        ends = np.where((ends - starts > 1) & (flat[ends - 1] == ord(".")), ends - 1, ends)
    return starts, hasher(flat, starts, ends)


def _document_frequencies(terms: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, uses, texts = WordHasher(), np.zeros(len(terms), np.int64), 0
        for batch in batches:
            for _, _, data, offsets in text_slices(batch, "text"):
                starts, hashes = _words(data, offsets, hasher)
                term = _lookup(terms, hashes)
                known = term >= 0
                owner = np.searchsorted(offsets, starts[known], side="right") - 1
                found, _ = distinct(term[known].astype(np.uint64), owner, len(offsets) - 1)
                uses += np.bincount(found.astype(np.int64), minlength=len(terms))
                texts += len(offsets) - 1
        yield pa.RecordBatch.from_arrays([pa.array([*range(len(terms)), -1], pa.int32()), pa.array([*uses, texts], pa.int64())], ["term", "n"])
    return run


def inverse_frequencies(docs: DataFrame, words: dict) -> np.ndarray:
    """Smoothed inverse document frequency of the templates' words over all of ``docs``; the last one is that of unseen words."""
    rows = (docs.select("text").mapInArrow(released(_document_frequencies(words["terms"])), "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect())
    n = {r["term"]: r["n"] for r in rows}
    total = n.get(-1, 0)
    seen = np.array([*[n.get(i, 0) for i in range(len(words["terms"]))], 0], float)
    return np.log((1 + total) / (1 + seen)) + 1


def _scan(words: dict, idf: np.ndarray):
    terms, size = words["terms"], len(words["terms"])
    names = [name for name, _ in words["notices"]]
    vectors = np.zeros((len(names), size))
    for row, (_, numbers) in enumerate(words["notices"]):
        np.add.at(vectors[row], numbers, idf[numbers])
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)

    def cosines(segment: np.ndarray, term: np.ndarray, hashes: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
        """Best cosine and notice of each segment. A word that no template has weighs as one that no document has."""
        value, owner = np.unique(np.column_stack([segment, hashes.view(np.int64)]), axis=0, return_inverse=True) if len(segment) else (np.zeros((0, 2), np.int64), np.zeros(0, int))
        times = np.bincount(owner.ravel(), minlength=len(value))
        number = np.full(len(value), size)
        number[owner.ravel()] = np.where(term >= 0, term, size)
        weight = times * idf[number]
        norm = np.sqrt(np.bincount(value[:, 0], weight * weight, count))
        inside = number < size
        dots = np.zeros((count, len(names)))
        np.add.at(dots, value[inside, 0], weight[inside, None] * vectors[:, number[inside]].T)
        own = dots / np.maximum(norm, 1e-12)[:, None]
        best = own.argmax(1)
        return own[np.arange(count), best], best

    def possible(segment: np.ndarray, term: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Segments that can reach the threshold. A cosine is at most the root of the known words' share of the squared norm, and the
        other words' share is at least that of as many different unseen words."""
        key, times = np.unique(segment * size + term, return_counts=True)
        own = np.bincount(key // size, (times * idf[key % size])**2, len(count))
        other = (count - np.bincount(segment, minlength=len(count))) * idf[size]**2
        return np.flatnonzero((own > 0) & (own * (1 - COSINE**2) >= COSINE**2 * other - 1e-9))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            for first, last, data, offsets in text_slices(batch, "text"):
                texts = last - first
                starts, hashes = _words(data, offsets, hasher)
                term = _lookup(terms, hashes)
                breaks = np.unique(np.r_[offsets[:-1], np.flatnonzero(data == 10) + 1])
                line = np.searchsorted(breaks, starts, side="right") - 1
                owner = np.searchsorted(offsets, starts, side="right") - 1
                in_line, in_text = np.bincount(line, minlength=len(breaks) + 1), np.bincount(owner, minlength=texts)
                known = term >= 0
                lines, whole = (possible(of[known], term[known], count) for of, count in ((line, in_line), (owner, in_text)))
                place = np.full(len(breaks) + 1, -1)
                place[lines] = np.arange(len(lines))
                spot = np.full(texts + 1, -1)
                spot[whole] = np.arange(len(whole)) + len(lines)
                of = np.concatenate([place[line], spot[owner]])
                take = of >= 0
                value, best = cosines(of[take], np.r_[term, term][take], np.r_[hashes, hashes][take], len(lines) + len(whole))
                text_of = np.concatenate([np.searchsorted(offsets, breaks[lines], side="right") - 1, whole]).astype(np.int64)
                length = np.concatenate([in_line[lines], in_text[whole]])
                license_, cosine, share = [None] * texts, np.zeros(texts), np.zeros(texts)
                for i in np.lexsort((best, -value)):
                    t = text_of[i]
                    if value[i] >= COSINE:
                        share[t] += length[i] / max(in_text[t], 1)
                        if license_[t] is None:
                            license_[t], cosine[t] = names[best[i]], value[i]
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(first, texts), batch.column("path").slice(first, texts), pa.array(license_, pa.string()),
                    pa.array(cosine, pa.float64()), pa.array(share >= FILE_SHARE, pa.bool_())], ["doc_id", "path", "own", "cosine", "is_file"])
    return run


def scan(files: DataFrame) -> DataFrame:
    """(doc_id, path, license, cosine, origin, licence_path) of every row of ``files`` (doc_id, path, text).

    ``origin`` is own, inherited or none. A licence file is a text that is mostly licensed segments; of several in one directory the commonest
    licence counts, then the first by name. The nearest directory above wins. Null or empty texts and texts without a licence inherit; a
    null path inherits nothing. Repeated rows stay; other columns are not read. Of equal cosines the template named first wins.
    """
    words = vocabulary()
    idf = inverse_frequencies(files, words)
    kind = files.schema["doc_id"].dataType.simpleString()
    found = pinned(files.select("doc_id", "path", "text").mapInArrow(
        released(_scan(words, idf)), f"doc_id {kind}, path string, own string, cosine double, is_file boolean"))
    parent = F.expr("if(instr(path, '/') > 0, substring_index(path, '/', size(split(path, '/')) - 1), '')")
    directories = (found.where("is_file and path is not null").groupBy(parent.alias("licence_path"), "own").agg(F.count(F.lit(1)).alias("n"))
                   .groupBy("licence_path").agg(F.min(F.struct((-F.col("n")).alias("n"), F.col("own"))).alias("pick"))
                   .select("licence_path", F.col("pick.own").alias("inherited")))
    bare = found.where("own is null and path is not null").select(parent.alias("directory")).distinct()
    above = bare.select("directory", F.explode(F.expr(
        "transform(sequence(0, size(split(directory, '/'))), k -> substring_index(directory, '/', k))")).alias("licence_path")).distinct()
    nearest = (above.join(directories, "licence_path").groupBy("directory")
               .agg(F.max(F.struct(F.length("licence_path").alias("depth"), "licence_path", "inherited")).alias("near")))
    joined = found.withColumn("directory", F.when(F.col("own").isNull(), parent)).join(nearest, "directory", "left")
    return joined.select("doc_id", "path", F.coalesce("own", "near.inherited").alias("license"), "cosine",
                         F.when(F.col("own").isNotNull(), "own").when(F.col("near").isNotNull(), "inherited").otherwise("none").alias("origin"),
                         F.col("near.licence_path").alias("licence_path"))
