"""License scans by diagonal voting, in DataFrame functions only.

All rolling hashes of K words of every text are joined to the positions of the same
hashes in the license templates. A hit votes for its diagonal (place in the text less
place in the template); votes are added up by text, template and diagonal, diagonals at
most GAP apart are merged (a word was put in or left out), and a merged span is
verified: it must hold COVER of the template's distinct word groups, for templates of at
most FEW words with the first and the last, and every phrase that tells the license from others (TELLING: its version, or
"lesser"), on a stretch at most STRETCH times as long as the template. The base phrases
are templates too, of which all groups must meet on one diagonal, so every place of them
is found.

Texts are read once. Their hashes are sifted by the bits of the templates' where they are
made, so that few places leave a text and its words never do; the join decides. The
templates are constants of this module, so the broadcast side is bounded by their length;
a text's hits are aggregated by text, never by template or label.

Defined cases: a null or empty text has no words, no places, empty labels and score 0;
repeated rows (equal id and text) get equal results, rows without an id as others; the
work for a text is in proportion to its words; columns to carry along that are named like
the result's own are left out; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, kept

K, GAP, COVER, STRETCH = 3, 2, 0.75, 1.5
#: Templates of at most so many words must be met to both ends.
FEW = 12
#: Bits, as a power of two, of the table that sifts the hashes of texts before they are joined.
SIEVE = 14
#: What stands between words; after lower(), which maps no other character of a phrase's words to ASCII.
BETWEEN = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
# Phrases, license notices and their labels.
BASE = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]
NOTICES = [
    ("released under the mit license", "mit"),
    ("licensed under the mit license", "mit"),
    (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction "
        "including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so",
        "mit",
    ),
    ("licensed under the apache license version 2 0", "apache-2"),
    ("licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at", "apache-2"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under a creative commons attribution noncommercial 4 0 international license", "cc-by-nc"),
    ("licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("licensed under a creative commons attribution sharealike 4 0 international license", "cc-by-sa"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3"),
    (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
        "gpl-3",
    ),
    ("licensed under the gnu general public license version 2", "gpl-2"),
    (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
        "gpl-2",
    ),
    ("licensed under the gnu lesser general public license", "lgpl"),
    (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
        "lgpl",
    ),
    (
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
        "lgpl",
    ),
    (
        "this library is free software you can redistribute it and or modify it under the terms of the gnu library general public license as published by the free software foundation either version 2 of the license or at your option any later version",
        "lgpl",
    ),
    (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
        "bsd",
    ),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2"),
]

#: What tells a label's notices from others of nearly the same words; at most K words each.
TELLING = {
    "mit": ["mit license"],
    "apache-2": ["apache license", "version 2"],
    "cc-by-nc": ["nc 4", "noncommercial 4"],
    "cc-by": ["attribution 4"],
    "cc-by-sa": ["attribution sharealike"],
    "gpl-3": ["gnu general", "version 3"],
    "gpl-2": ["gnu general", "version 2"],
    "lgpl": ["lesser general", "library general"],
    "mpl-2": ["mozilla public", "v 2"],
}


def _telling(text: str, label: str) -> list[int]:
    """By place in a template: the telling phrases that its word group holds, as bits."""
    w = text.split()
    groups = [" " + " ".join(w[i : i + K]) + " " for i in range(len(w) - K + 1)]
    return [sum(1 << b for b, phrase in enumerate(TELLING.get(label, [])) if f" {phrase} " in g) for g in groups]


def words(text: str):
    """The words, with an empty string before or after them where the text begins or ends with something else."""
    return F.split(F.lower(F.col(text)), BETWEEN)


def _count(array: str):
    edge = lambda i: (F.element_at(array, i) == "").cast("int")
    return F.when(F.size(array) > 1, F.size(array) - edge(1) - edge(-1)).otherwise(1 - edge(1))


def templates(spark) -> DataFrame:
    """tpl, label, is_base, pos, gram, tells, all_tells, n_grams (distinct), n_tpl_words: a row a place of a template."""
    texts = [f"({i}, '{label}', {i < len(BASE)}, '{text}', array({', '.join(map(str, _telling(text, label)))}))" for i, (text, label) in enumerate([*BASE, *NOTICES])]
    rows = spark.sql(f"SELECT tpl, label, is_base, bits, split(text, ' ') AS w FROM VALUES {', '.join(texts)} AS t (tpl, label, is_base, text, bits)")
    rows = rows.withColumn("all_tells", F.aggregate("bits", F.lit(0), lambda a, x: a.bitwiseOR(x))).withColumn("grams", F.slice(_grams("w"), 1, F.size("w") - K + 1))
    grams = rows.select("tpl", "label", "is_base", "bits", "all_tells", F.size("w").alias("n_tpl_words"), F.size(F.array_distinct("grams")).cast("long").alias("n_grams"), F.posexplode_outer("grams").alias("pos", "gram"))
    return grams.withColumn("tells", F.get("bits", F.col("pos"))).drop("bits")


def _grams(array: str):
    """Rolling hashes of K words; those of the last places reach over the end and match nothing."""
    return F.transform(array, lambda x, i: F.xxhash64(x, *[F.get(F.col(array), i + j) for j in range(1, K)]))


def _sieve(grams: list[int]):
    """A test that holds for all of grams and for few other hashes: bits of a constant array."""
    words = [0] * (1 << (SIEVE - 6))
    for g in grams:
        words[(g >> 6) & (len(words) - 1)] |= 1 << (g & 63)
    signed = [x - (1 << 64) if x >> 63 else x for x in words]
    table = F.expr(f"array({', '.join(f'bigint({x})' for x in signed)})")
    word = lambda g: F.get(table, F.shiftright(g, 6).bitwiseAND(len(words) - 1).cast("int"))
    return lambda g: F.getbit(word(g), g.bitwiseAND(63).cast("int")) == 1


def scan(docs: DataFrame, keep: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Per row: doc_id, keep, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Also the verified spans: doc_id, text_hash, label, template, first_word, last_word, votes, coverage.
    """
    names = {c: f"_k{i}" for i, c in enumerate(kept(keep, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"))}
    docs = docs.select("doc_id", "text", *[F.col(f"`{c}`").alias(n) for c, n in names.items()])  # no clash with names in here
    keep = list(names.values())
    own = templates(docs.sparkSession)
    may_hit = _sieve([r[0] for r in own.select("gram").collect()])  # constants of this module
    rows = docs.select("doc_id", *keep, F.xxhash64("text").alias("text_hash"), words("text").alias("w"))
    rows = rows.select("doc_id", *keep, "text_hash", F.coalesce(_count("w"), F.lit(0)).cast("long").alias("n_words"), (F.get("w", F.lit(0)) == "").cast("int").alias("skip"), _grams("w").alias("grams"))
    placed = F.transform("grams", lambda g, i: F.struct(i.alias("at"), g.alias("gram")))
    rows = checkpointed(rows.select("doc_id", *keep, "text_hash", "n_words", "skip", F.filter(placed, lambda x: may_hit(x["gram"])).alias("places")))
    places = rows.where(F.size("places") > 0).select("doc_id", "text_hash", "skip", F.inline("places"))
    hits = places.join(F.broadcast(own), "gram").withColumn("at", F.col("at") - F.col("skip")).withColumn("diagonal", F.col("at") - F.col("pos"))
    votes = hits.groupBy("doc_id", "text_hash", "tpl", "label", "is_base", "all_tells", "n_grams", "n_tpl_words", "diagonal").agg(
        F.collect_set("gram").alias("grams"), F.bit_or("tells").alias("tells"), F.min("at").alias("first"), (F.max("at") + K - 1).alias("last"), F.min("pos").alias("head"), F.max("pos").alias("tail")
    )  # at most a template's length of hits on a diagonal
    votes = checkpointed(votes)
    full = votes.where(F.col("is_base") & (F.size("grams") == F.col("n_grams")) & (F.col("last") - F.col("first") + 1 == F.col("n_tpl_words")))
    base = full.groupBy("doc_id", "text_hash").agg(
        F.count("*").alias("n_base"), F.min("first").alias("first_word"), F.max("first").alias("last_word"), F.collect_set("label").alias("base_set")
    )
    by_text = Window.partitionBy("doc_id", "text_hash", "tpl").orderBy("diagonal")
    fresh = F.when(F.col("diagonal") - F.lag("diagonal").over(by_text) <= GAP, 0).otherwise(1)
    runs = votes.where(~F.col("is_base")).withColumn("fresh", fresh).withColumn("run", F.sum("fresh").over(by_text))
    spans = runs.groupBy("doc_id", "text_hash", "tpl", "label", "all_tells", "n_grams", "n_tpl_words", "run").agg(
        F.bit_or("tells").alias("tells"),
        F.size(F.array_distinct(F.flatten(F.collect_list("grams")))).alias("votes"), F.min("first").alias("first"), F.max("last").alias("last"), F.min("head").alias("head"), F.max("tail").alias("tail")
    )
    ends = (F.col("n_tpl_words") > FEW) | (F.col("head") == 0) & (F.col("tail") == F.col("n_tpl_words") - K)
    told = F.col("tells") == F.col("all_tells")
    spans = spans.withColumn("coverage", F.col("votes") / F.col("n_grams")).where(ends & told & (F.col("coverage") >= COVER) & (F.col("last") - F.col("first") + 1 <= STRETCH * F.col("n_tpl_words")))
    verified = spans.select("doc_id", "text_hash", "label", F.col("tpl").alias("template"), F.col("first").cast("long").alias("first_word"), F.col("last").cast("long").alias("last_word"), F.col("votes").cast("long").alias("votes"), "coverage")
    method = spans.groupBy(F.col("doc_id").alias("m_doc_id"), F.col("text_hash").alias("m_text_hash")).agg(F.collect_set("label").alias("own_set"), F.max("coverage").alias("best"))
    found = base.join(method, F.col("doc_id").eqNullSafe(F.col("m_doc_id")) & (F.col("text_hash") == F.col("m_text_hash")), "full_outer")
    found = found.withColumns({c: F.coalesce(c, f"m_{c}") for c in ("doc_id", "text_hash")}).drop("m_doc_id", "m_text_hash")
    found = found.select(*[F.col(c).alias(f"f_{c}") for c in found.columns])
    none = F.array().cast("array<string>")
    base_set, own_set = F.coalesce("f_base_set", none), F.coalesce("f_own_set", none)
    joined = rows.drop("places", "skip").join(found, rows["doc_id"].eqNullSafe(found["f_doc_id"]) & (rows["text_hash"] == found["f_text_hash"]), "left")
    result = joined.select(
        "doc_id", *[F.col(n).alias(c) for c, n in names.items()], "n_words",
        F.coalesce("f_n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("f_first_word").cast("long").alias("first_word"),
        F.col("f_last_word").cast("long").alias("last_word"),
        F.array_join(F.sort_array(base_set), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union(base_set, own_set)), ",").alias("labels"),
        F.when(F.size(base_set) > 0, F.lit(1.0)).otherwise(F.coalesce("f_best", F.lit(0.0))).alias("score"),
    )
    return result, verified
