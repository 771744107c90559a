"""Licence scans: a positional index of rare licence words, and key phrases that must stand there."""

from __future__ import annotations

import math
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyflow.llm.common import ROW, ascii_lower, numbered, sent, written

# A word of lower-cased text: letters, digits and everything outside ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# The base phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Opening words of public licence notices, and the phrases without which a notice does not count.
TEMPLATES = {
    "apache": (
        "licensed under the apache license version 2 0 you may not use this file except in compliance with the license "
        "you may obtain a copy of the license at",
        ("apache license",),
    ),
    "gpl": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation",
        ("gnu general public license", "software foundation"),
    ),
    "mit": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files to deal in the software without restriction",
        ("hereby granted", "associated documentation"),
    ),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met",
        ("permitted provided", "following conditions"),
    ),
    "isc": (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies",
        ("hereby granted provided", "copyright notice"),
    ),
    "mpl": (
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was "
        "not distributed with this file you can obtain one",
        ("mozilla public license",),
    ),
    "cc-by": (
        "this work is licensed under a creative commons attribution 4 0 international license",
        ("creative commons attribution",),
    ),
    "unlicense": (
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish",
        ("unencumbered software released",),
    ),
}

# A template word takes part if it is in at most this share of the documents, or among the rarest of its template.
MOST_DOCUMENTS = 0.1

Templates = Mapping[str, tuple[str, Sequence[str]]]


def vocabulary(templates: Templates = TEMPLATES, phrases: Mapping[str, str] = PHRASES) -> list[str]:
    """The indexed words: those of all phrases and templates."""
    needed = {w for p in [*phrases, *(p for _, keys in templates.values() for p in keys)] for w in p.split()}
    return sorted(needed | {w for text, _ in templates.values() for w in text.split()})


def index(df: DataFrame, indexed: Sequence[str], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: number of words, and the indexed words with their positions. No text is kept or shuffled."""
    words = F.regexp_extract_all(ascii_lower(F.coalesce(F.col("_t"), F.lit(""))), F.lit(WORD), F.lit(0))
    rows = numbered(df.select(F.col(key).alias("_k"), F.col(text).alias("_t"))).withColumn("_w", words)
    placed = F.transform("_w", lambda w, i: F.when(w.isin(list(indexed)), F.struct(i.alias("at"), w.alias("word"))))
    hits = F.filter(placed, lambda x: x.isNotNull())
    return rows.select(ROW, "_k", F.size("_w").cast("long").alias("n_words"), hits.alias("hits"))


def places(phrase: str) -> Column:
    """Positions in ``hits`` at which the words of a phrase stand one after the other."""
    first, *rest = phrase.split()

    def stands(hit: Column, i: Column) -> Column:
        found = hit["word"] == first
        for k, word in enumerate(rest, 1):
            other = F.get("hits", i + k)
            found = found & F.coalesce((other["word"] == word) & (other["at"] == hit["at"] + k), F.lit(False))
        return found

    return F.transform(F.filter("hits", stands), lambda hit: hit["at"])


def aligned(found: DataFrame, templates: Templates, n_documents: int, rare: int, least: int) -> DataFrame:
    """Templates whose rare words stand in a document at their relative positions, with the share that does.

    Each template's ``rare`` words of highest inverse document frequency are looked up wherever they stand
    in a document, and the document's own ``rare`` ones among all words of the templates, for notices that
    were changed. Those that imply the same start of the same template support it.
    """
    counts = found.select(F.explode(F.array_distinct(F.transform("hits", lambda h: h["word"]))).alias("word"))
    idf = {  # at most one entry per indexed word
        r["word"]: math.log((1 + n_documents) / r["count"]) for r in counts.groupBy("word").count().collect()
    }
    known = [
        (label, at, word)
        for label, (text, _) in templates.items()
        for at, word in enumerate(text.split())
        if word in idf
    ]
    if not known:
        return found.select(ROW, F.lit("").alias("label"), F.lit(0.0).alias("share")).where("false")
    weights = F.create_map(*[F.lit(x) for pair in sorted(idf.items()) for x in pair])
    own = {label: {word for other, _, word in known if other == label} for label in templates}
    rarest = {label: sorted(words, key=lambda w: (-idf[w], w))[:rare] for label, words in own.items()}
    telling = {w for w in idf if idf[w] >= -math.log(MOST_DOCUMENTS)}.union(*rarest.values())
    known = [(label, at, word) for label, at, word in known if word in telling]
    by_word: dict[str, list[Column]] = {}
    for label, at, word in known:
        entry = F.struct(F.lit(label).alias("label"), F.lit(at).alias("at"), F.lit(word in rarest[label]).alias("rare"))
        by_word.setdefault(word, []).append(entry)
    postings = F.create_map(*[x for word, entries in sorted(by_word.items()) for x in (F.lit(word), F.array(*entries))])
    told = found.withColumn("hits", F.filter("hits", lambda h: h["word"].isin(sorted({word for _, _, word in known}))))
    distinct = F.array_distinct(F.transform("hits", lambda h: h["word"]))
    ranked = F.array_sort(F.transform(distinct, lambda w: F.struct((-F.element_at(weights, w)).alias("idf"), w.alias("word"))))
    best = F.transform(F.slice(ranked, 1, rare), lambda x: x["word"])
    rows = told.where(F.size("hits") > 0).select(ROW, "hits", best.alias("_best"))

    def implied(hit: Column) -> Column:
        same = F.filter(F.element_at(postings, hit["word"]), lambda p: p["rare"] | F.array_contains("_best", hit["word"]))
        return F.transform(same, lambda p: F.struct(p["label"].alias("label"), (hit["at"] - p["at"]).alias("start"), p["at"]))

    # Sorted, those that imply one start stand together; the last of them, less than ``least``, are left out.
    def supported(s: Column) -> Column:
        def further(v: Column, i: Column) -> Column:
            other = F.get(s, i + (least - 1))
            return F.coalesce((other["label"] == v["label"]) & (other["start"] == v["start"]), F.lit(False))

        return F.filter(s, further)

    implications = F.array(F.array_sort(F.flatten(F.transform("hits", implied))))  # so that they are worked out once
    starts = rows.select(ROW, F.explode(F.transform(implications, supported)[0]).alias("v"))
    sizes = {label: len({at for other, at, _ in known if other == label}) for label in templates}
    lengths = F.create_map(*[x for label, n in sizes.items() for x in (F.lit(label), F.lit(min(max(n, 1), rare)))])
    support = starts.groupBy(ROW, "v.label", "v.start").agg((F.count("*") + (least - 1)).alias("n"))
    share = F.least(F.col("n") / F.element_at(lengths, F.col("label")), F.lit(1.0))
    return support.groupBy(ROW, "label").agg(F.max(share).alias("share"))


def scan(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    phrases: Mapping[str, str] = PHRASES,
    templates: Templates = TEMPLATES,
    rare: int = 8,
    least: int = 3,
) -> DataFrame:
    """Per document: words, places of base phrases, their labels, all labels, and a score.

    A template's label is added if at least ``least`` of its ``rare`` rarest words, or of the document's,
    agree on where it starts, and all its key phrases stand in the document. However many notices and
    other licence words a document holds, each template is looked for in all of it. ``score`` is 1 where
    a base phrase stands, else the largest share of rare words of an added template that agree, else 0.

    A null text is an empty one. Repeated rows and null keys get a row each. An empty table gives no
    rows; other columns are not looked at. Phrases that overlap count each.
    """
    for phrase in [*phrases, *(p for body, keys in templates.values() for p in (body, *keys))]:
        if not re.fullmatch(r"[a-z0-9]+( [a-z0-9]+)*", phrase):
            raise ValueError(f"not lower-case words with single blanks: {phrase!r}")
    found = written(index(df, vocabulary(templates, phrases), key, text), "licenses")
    support = sent(aligned(found, templates, found.count(), rare, least), "support")
    present = {p: F.size(places(p)) > 0 for _, keys in templates.values() for p in keys}
    must = F.lit(False)
    for label, (_, keys) in templates.items():
        verified = F.lit(True)
        for phrase in keys:
            verified = verified & present[phrase]
        must = F.when(F.col("label") == label, verified).otherwise(must)
    added = (
        found.select(ROW, "hits")
        .join(support, ROW)
        .where(must)
        .groupBy(ROW)
        .agg(F.collect_set("label").alias("_added"), F.max("share").alias("_share"))
    )
    added = sent(added, "notices")
    starts = {phrase: places(phrase) for phrase in phrases}
    every = F.concat(*starts.values())
    base = F.array_compact(F.array(*[F.when(F.size(at) > 0, F.lit(phrases[p])) for p, at in starts.items()]))
    none = F.array().cast("array<string>")
    rows = found.select(ROW, "_k", "n_words", every.alias("_at"), base.alias("_base"))
    return rows.join(added, ROW, "left").select(
        F.col("_k").alias(key),
        "n_words",
        F.size("_at").cast("long").alias("n_base"),
        F.array_min("_at").cast("long").alias("first_word"),
        F.array_max("_at").cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("_base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("_base", F.coalesce("_added", none))), ",").alias("labels"),
        F.when(F.size("_base") > 0, 1.0).otherwise(F.coalesce("_share", F.lit(0.0))).alias("score"),
    )
