"""The operators on documents against brute force: ordinary texts, nulls, empty and long texts, ties,
repeated rows, clashing columns, empty tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera.llm import decontam, langid, license_scan, mixing, neardup, quality, sharding, suffix_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(n=120, seed=1):
    r = random.Random(seed)
    vocab = ["".join(r.choices(["the", "an", "er", "on", "ñe", "ü", "çi"], k=r.randint(1, 3))) for _ in range(200)]
    prose = lambda k: " ".join(r.choices(vocab, k=k))
    shared = prose(60)
    out = []
    for i in range(n):
        t = "\n".join(prose(r.randint(3, 30)) + "." for _ in range(r.randint(1, 8)))
        if i % 9 == 0:
            t = f"{t}\n{shared}\n{prose(5)}"
        if i % 10 == 3 and out:
            w = out[-3][1].split(" ") if out[-3][1] else []
            t = " ".join(w[: len(w) // 2] + ["edited"] + w[len(w) // 2 + 1 :])
        if i % 11 == 5:
            t = out[-1][1]
        out.append((i, t, ["en", "fr", None][i % 3], f"s{i % 4}" if i % 7 else None, 0))
    out += [(n, None, None, None, None), (n + 1, "", "en", "s0", 0), (n + 2, "!!! ???", "en", "s1", 0), (n + 3, "one two", "en", "s2", 0), (n + 4, "ONE  Two\n", "en", "s2", 0)]
    out += [(n + 5, prose(6000), "en", "hot", 0), out[4], out[4], (None, prose(40), "en", "s1", 0), (n + 6, " \t\n ", "fr", "s3", 0)]
    out += [(n + 10 + i, shared, "en", "hot", 0) for i in range(30)]
    return out


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def table(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


# quality


def counts(t):
    t = t or ""
    w = WORD.findall(t)
    threes = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {i + j for i in range(len(w) - 2) if threes[tuple(w[i : i + 3])] > 1 for j in range(3)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered)


def test_quality_counts(docs, rows, spark):
    labels = spark.createDataFrame([(0, 1), (0, 0), (1, 1), (None, 1), (2, None)], "doc_id long, quality int")
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    got = quality.assess(docs, labels)
    assert table(got, *names) == sorted(((i, *counts(t)) for i, t, *_ in rows), key=str)
    for r in got.collect():
        base = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == base and not (base and r["kept"])
        assert base or r["kept"]  # too few labels to certify a cutoff


def test_exact_bounds():
    for n, k, p in ((10, 0, 0.3), (50, 7, 0.2), (200, 3, 0.02), (5, 5, 0.5)):
        assert math.isclose(quality.binomial_tail(k, n, p), sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)), rel_tol=1e-9)
    assert not quality.certified(0, 0, 0.1, 0.05) and quality.certified(300, 0, 0.02, 0.05) and not quality.certified(100, 0, 0.02, 0.05)


def test_cutoffs_keep_the_limit():
    """Over many draws of a holdout, the step that is used has the rules together reject more than alpha of
    the good ones at most as often as the level says."""
    import numpy as np

    r, level, over, used = np.random.default_rng(0), 0.05, 0, 0
    for truth in (np.full(quality.STEPS + 1, 0.004), np.r_[np.full(quality.STEPS, 0.02), 0.0], np.r_[0.049, np.full(quality.STEPS - 1, 0.002), 0.0]):
        truth[-1] = 1 - truth[:-1].sum()
        for _ in range(300):
            step = quality.last_certified(np.r_[0, r.multinomial(800, truth)], 0.05, level)
            used += step > 0
            over += truth[:step].sum() > 0.05
    assert used > 300 and over <= 900 * level * 1.3


def test_long_strings_of_a_simple_make_are_told_apart(spark):
    a = "a"
    while len(a) < 2048:
        a += a.translate(str.maketrans("ab", "ba"))
    b = a.translate(str.maketrans("ab", "ba"))
    texts = [f"{a}\n{b}", f"{a} x y {b} x y", f"{a}\n{b}\n{a}"]
    got = quality.assess(spark.createDataFrame([(i, t, None, None, 0) for i, t in enumerate(texts)], SCHEMA), spark.createDataFrame([(0, 1)], "doc_id long, quality int"))
    assert table(got, "doc_id", "n_dup_lines", "n_repeat_words") == [(0, 0, 0), (1, 0, 0), (2, 1, 0)]


def test_quality_rejects_what_labels_call_bad(spark):
    r = random.Random(3)
    prose = lambda k: " ".join("".join(r.choices("abcdefg", k=r.randint(2, 8))) for _ in range(k))
    data, labels = [], []
    for i in range(3000):
        bad = i % 3 == 0
        data.append((i, " ".join(w + ("%%%" if bad else "") for w in prose(60).split()), "en" if i % 2 else None, "s", 0))
        labels.append((i, 0 if bad else 1))
    own = spark.createDataFrame(data, SCHEMA).withColumn("n_words", F.lit("clash"))
    graded = spark.createDataFrame(labels, "doc_id long, quality int").withColumn("text", F.lit("clash"))
    got = quality.assess(own, graded).groupBy((F.col("doc_id") % 3 == 0).alias("bad"), "kept").count().collect()
    assert {(r["bad"], r["kept"]): r["count"] for r in got} == {(True, False): 1000, (False, True): 2000}
    kept = quality.keep(own, graded)
    assert kept.columns == own.columns and kept.count() == 2000


# near duplicates


def brute_classes(rows, similarity=0.8):
    word = re.compile(r"[a-z0-9\x80-\U0010ffff]+")
    texts = sorted({(i, t or "") for i, t, *_ in rows if i is not None})
    bags = []
    for _, t in texts:
        w = word.findall(t.lower())
        bags.append(Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else []))
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(texts)):
        for b in range(a + 1, len(texts)):
            same = texts[a][1] == texts[b][1] and texts[a][1]
            both = sum((bags[a] & bags[b]).values())
            if same or (both and both >= similarity * (sum(bags[a].values()) + sum(bags[b].values()) - both)):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return {texts[i][0]: texts[find(i)][0] for i in range(len(texts))}


@pytest.mark.parametrize("few", [0, neardup.FEW_LINKS])
def test_near_duplicates(docs, rows, few):
    got = neardup.members(docs.withColumn("class_id", F.lit("clash")).withColumn("node", F.lit(1)), few=few)
    want = brute_classes(rows)
    assert got.count() == len(rows)
    assert {r["doc_id"]: r["class_id"] for r in got.collect()} == want | {None: None}


def test_one_of_each_class_stays(docs, rows):
    got = neardup.keep_one(docs)
    assert got.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in got.collect()) == sorted(map(str, [*set(brute_classes(rows).values()), None]))


@pytest.mark.parametrize("few", [0, neardup.FEW_LINKS])
def test_group_of_many_edits(spark, few):
    """A large group around one text, members with few and with many edits; links in chains."""
    r = random.Random(5)
    base = [f"w{r.randint(0, 10**6)}" for _ in range(150)]
    data = [(0, " ".join(base))]
    for i in range(1, 160):
        w = list(base)
        for j in r.sample(range(150), r.randint(1, 8)):
            w[j] = f"x{i}y{j}"
        data.append((i, " ".join(w)))
    own = spark.createDataFrame([(i, t, None, None, 0) for i, t in data], SCHEMA)
    assert {x["doc_id"]: x["class_id"] for x in neardup.members(own, few=few).collect()} == brute_classes(data)


def test_a_large_group_is_not_compared_with_all_texts_outside(spark, monkeypatch):
    """One bucket: a group around its centre, texts that only others of the group link to it, one text with one link."""
    r, inside, outside = random.Random(6), 200, 40
    # the marks of 90 places of five tokens; place 20 is each text's own, and the centre has none
    texts = [{}] + [{20: i + 10, **dict.fromkeys(r.sample(range(20), 5 if i < inside else 10), 1)} for i in range(inside + outside)]
    texts.append(texts[1] | {20: 900} | dict.fromkeys(range(30, 39), 900))
    apart = lambda a, b: sum(texts[a].get(k, 0) != texts[b].get(k, 0) for k in range(90))
    linked = [(a, b) for a in range(len(texts)) for b in range(a) if apart(a, b) <= 10]
    assert [b for a, b in linked if a == len(texts) - 1] == [1]
    assert not any(b == 0 and a > inside for a, b in linked) and all(b == 0 or a > inside or apart(a, b) <= 11 for a, b in linked)
    bags = spark.createDataFrame([(i, [(k * 1000 + m.get(k, 0)) * 5 + j for k in range(90) if m or k != 20 for j in range(5)]) for i, m in enumerate(texts)], "node long, bag array<long>")
    stars = spark.createDataFrame([(7, 0, i) for i in range(1, len(texts))], "key long, a long, b long")
    compared, verify = [], neardup._verify
    monkeypatch.setattr(neardup, "_verify", lambda pairs, *more: compared.append(pairs.count()) or verify(pairs, *more))
    none = spark.createDataFrame([], "a long, b long, similarity double")
    found, label = neardup._settle(stars, bags, none, 0, neardup.SIMILARITY, neardup.FEW_LINKS)
    assert {x["label"] for x in label.collect()} == {0} and label.count() == len(texts)  # all are linked up
    assert {(max(x.a, x.b), min(x.a, x.b)) for x in found.collect()} <= set(linked)
    # the leader, 16 of the group for each text outside, and all of it for the last text: every text outside took all of it before
    assert sum(compared) < 5 * len(texts) + neardup.PIVOTS * (outside + 1) < outside * inside / 3


def test_signatures_estimate_weighted_jaccard():
    import numpy as np

    r = np.random.default_rng(2)
    ids = r.integers(1, 2**60, 40).astype(np.uint64)
    for _ in range(5):
        a, b = r.integers(0, 6, 40), r.integers(0, 6, 40)
        hashes = np.concatenate([ids[a > 0], ids[b > 0]])
        s = neardup.signatures(hashes, np.concatenate([a[a > 0], b[b > 0]]), np.repeat([0, 1], [(a > 0).sum(), (b > 0).sum()]), 2, 4000)
        assert abs((s[0] == s[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.04


def test_near_duplicates_of_nothing(spark):
    assert neardup.members(spark.createDataFrame([], SCHEMA)).count() == 0
    assert neardup.keep_one(spark.createDataFrame([], SCHEMA)).count() == 0


# suffixes


def brute_removed(rows):
    seen, out = {}, []
    texts = sorted(((i, (t or "").encode()) for i, t, *_ in rows), key=lambda x: (x[0] is None, x[0]))
    at = 0
    while at < len(texts):
        group = [x for x in texts[at:] if x[0] == texts[at][0]]
        new = []
        for i, b in group:
            mark, own = bytearray(len(b)), set()
            for p in range(len(b) - 99):
                s = b[p : p + 100]
                if s in seen or s in own:
                    mark[p : p + 100] = b"\1" * 100
                own.add(s)
            new.append(own)
            kept = bytes(x for x, m in zip(b, mark, strict=True) if not m)
            out.append((i, len(b), sum(mark), len(re.findall(b"\1+", bytes(mark))), hashlib.sha256(kept).hexdigest()))
        for own in new:
            seen.update(dict.fromkeys(own))
        at += len(group)
    return sorted(out, key=str)


@pytest.mark.parametrize("limits", [{}, {"chunk_bytes": 6000, "bucket_bytes": 3000}, {"chunk_bytes": 2000, "bucket_bytes": 10_000, "hot_chunks": 1}])
def test_removed_suffixes(docs, rows, limits):
    more = [(900 + i, ("ab" * 300)[: 150 + i], "en", "s", 0) for i in range(4)] + [(950, "é" * 400, "en", "s", 0)]
    own = docs.unionByName(docs.sparkSession.createDataFrame(more, SCHEMA)).withColumn("chunk", F.lit(1))
    got = suffix_dedup.deduplicate(own, **limits)
    assert table(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute_removed([*rows, *more])


def test_removed_suffixes_text_and_nothing(docs, spark):
    for r in suffix_dedup.deduplicate(docs, with_text=True).collect():
        assert hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] and len(r["kept"]) == r["n_bytes"] - r["n_removed"]
    assert suffix_dedup.deduplicate(spark.createDataFrame([], SCHEMA)).count() == 0


def test_cover_meets_every_shift():
    d = suffix_dedup.COVER.tolist()
    assert {(a - b) % suffix_dedup.PERIOD for a in d for b in d} == set(range(suffix_dedup.PERIOD))


# licenses

LICENSE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def license_rows():
    texts = [
        "Released under the MIT License.", "under the mit license under the mit license", "UNDER-THE/MIT LICENSE", "under the mit", "Licensed under the Apache License, Version 2.0.", "Licensed under CC BY-NC 4.0.\nx", "…cc by nc",
        "This work is licensed under the GNU General Public License, version 3.", "é under the mıt license", None, "", "...", "a", " cc by nc ", "the license", "Licensed under a Creative Commons Attribution 4.0 International License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so",
        "word " * 3000 + "under the MIT license " + "word " * 3000,
    ]
    return [(i, t, None, None, 0) for i, t in enumerate(texts)] + [(0, texts[0], None, None, 0), (None, "cc by nc", None, None, 0)]


def test_license_scan(spark):
    data = license_rows()
    got, spans = license_scan.scan(spark.createDataFrame(data, SCHEMA).withColumn("gram", F.lit(1)).withColumn("n_words", F.lit("clash")))
    want = []
    for i, t, *_ in data:
        w, at, labels = LICENSE_WORD.findall((t or "").translate(SMALL)), [], set()
        for phrase, label in license_scan.BASE:
            p = phrase.split()
            here = [k for k in range(len(w)) if w[k : k + len(p)] == p]
            at += here
            labels |= {label} if here else set()
        want.append((i, len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))))
    assert table(got, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels") == sorted(want, key=str)
    labels = {r["doc_id"]: r["labels"] for r in got.collect()}
    assert labels[7] == "gpl-3" and labels[4] == "apache-2" and labels[5] == "cc-by-nc" and labels[15] == "cc-by" and labels[16] == "mit" and labels[14] == "" and labels[3] == ""
    assert all(0 <= r["score"] <= 1 and set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(",")) for r in got.collect())
    assert {r["label"] for r in spans.where("doc_id = 16").collect()} == {"mit"}
    assert license_scan.scan(spark.createDataFrame([], SCHEMA))[0].count() == 0


def license_labels(spark, texts):
    got = license_scan.scan(spark.createDataFrame([(i, t, None, None, 0) for i, t in enumerate(texts)], SCHEMA))[0].collect()
    return [r["labels"] for r in sorted(got, key=lambda r: r["doc_id"])]


def test_licenses_of_nearly_the_same_words(spark):
    header = "x This {} is free software; you can redistribute it and/or modify it under the terms of the GNU {}General Public License as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version. y"
    cc = "Licensed under a Creative Commons Attribution{} 4.0 International License"
    texts = {
        header.format("program", "", "3"): "gpl-3", header.format("program", "", "2"): "gpl-2", header.format("program", "Lesser ", "3"): "lgpl", header.format("library", "Lesser ", "2.1"): "lgpl",
        header.format("library", "Library ", "2"): "lgpl", header.format("program", "Affero ", "3"): "", header.format("program", "", "1"): "", cc.format(""): "cc-by", cc.format("-ShareAlike"): "cc-by-sa", cc.format("-NonCommercial"): "cc-by-nc", cc.format("-NonCommercial-ShareAlike"): "",
    }
    assert license_labels(spark, texts) == list(texts.values())


def test_notices_with_changed_ends(spark):
    (grant,) = [t for _, t, *_ in license_rows() if t and "hereby" in t]
    texts = {grant.replace("hereby ", ""): "mit", grant.replace(" to do so", ""): "mit", "Permission is hereby granted, free of charge, to any person": "", "Released under the": "", "licensed under a creative commons attribution 4 0": ""}
    assert license_labels(spark, texts) == list(texts.values())


def test_license_of_a_null_id(spark):
    texts = ["Released under the MIT License.", "cc by nc", "Licensed under the GNU Lesser General Public License", None]
    got = license_scan.scan(spark.createDataFrame([(None, t, None, None, 0) for t in texts], SCHEMA))[0].collect()
    assert sorted((r["n_base"], r["base_labels"], r["labels"], r["score"]) for r in got) == [(0, "", "", 0.0), (0, "", "lgpl", 1.0), (1, "cc-by-nc", "cc-by-nc", 1.0), (1, "mit", "mit", 1.0)]


# shards


@pytest.mark.parametrize("shards", [1, 5, 24])
def test_shards(docs, rows, shards):
    got = sharding.shard(docs.withColumn("node", F.lit(1)), shards).collect()
    sizes = {i: len((t or "").encode()) + 8 for i, t, *_ in rows}
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in rows)
    assert all(r["size"] == sizes[r["doc_id"]] for r in got)
    assert sorted((str(r["doc_id"]), r["text_crc32"]) for r in got) == sorted((str(i), zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    by = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r)
    assert set(by) <= set(range(shards))
    for members in by.values():
        assert sorted(r["slot"] for r in members) == list(range(len(members)))


def test_shard_sizes_are_near_equal(spark):
    r = random.Random(7)
    data = [(i, f"{i} " + "x" * r.randint(1, 400), "en", f"s{r.randint(0, 2)}", 0) for i in range(4000)] + [(9000 + i, "y" * 300, "en", "hot", 0) for i in range(2000)]
    got = sharding.shard(spark.createDataFrame(data, SCHEMA)).groupBy("shard").agg(F.sum("size").alias("n")).collect()
    assert len(got) == 24 and max(r["n"] for r in got) < 1.03 * min(r["n"] for r in got)
    again = sharding.shard(spark.createDataFrame(data, SCHEMA).repartition(9)).select("doc_id", "shard")
    assert table(again, "doc_id", "shard") == table(sharding.shard(spark.createDataFrame(data, SCHEMA)), "doc_id", "shard")


def brute_tree(items, first, n):
    """node of each item (values of the dimensions, tie, weight, key): sorted along the widest dimension, cut nearest to the share."""
    if n == 1 or not items:
        return {x["key"]: first for x in items}
    widest = max(sharding.DIMENSIONS, key=lambda d: max(x[d] for x in items) - min(x[d] for x in items))
    line = sorted(items, key=lambda x: (x[widest], x["tie"]))
    wanted, upto, cut = sum(x["weight"] for x in items) * (n // 2) / n, 0, len(line)
    for i, x in enumerate(line):
        if upto + x["weight"] >= wanted:
            cut = i + (wanted - upto > x["weight"] / 2)
            break
        upto += x["weight"]
    return brute_tree(line[:cut], first, n // 2) | brute_tree(line[cut:], first + n // 2, n - n // 2)


def test_tree_splits_at_medians(spark):
    r = random.Random(8)
    data = [(i, r.randint(1, 5000), float(r.randint(0, 9)), float(r.randint(0, 3)), float(r.randint(0, 1)), float(i % 50), r.randint(0, (1 << sharding.TIE) - 1)) for i in range(300)]
    df = spark.createDataFrame(data, "key long, weight long, x_size double, x_source double, x_lang double, x_id double, tie long")
    scaled = [x.asDict() for x in sharding._scaled(df).collect()]
    assert {x["key"]: x["node"] for x in sharding.kd_tree(df, 7).collect()} == brute_tree(scaled, 0, 7)


def test_equal_texts_share_a_shard(spark):
    data = [(i, f"text {i % 500} " + "z" * (i % 500), "en", f"s{i % 3}", 0) for i in range(2000)]
    got = sharding.shard(spark.createDataFrame(data, SCHEMA)).groupBy("text_crc32").agg(F.count_distinct("shard").alias("n"))
    assert got.where("n > 1").count() == 0
    assert sharding.shard(spark.createDataFrame([], SCHEMA)).count() == 0


# mixing


def brute_targets(sizes):
    names = sorted(s for s in sizes if s is not None) + [s for s in sizes if s is None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    capped = {}
    while True:
        free = [s for s in names if s not in capped]
        level = (1.5 * sum(sizes.values()) - sum(capped.values())) / max(1, sum(weight[s] for s in free))
        over = [s for s in free if level * weight[s] > 2 * sizes[s]]
        if not over:
            return {s: capped.get(s, level * weight[s]) for s in names}
        capped |= {s: 2 * sizes[s] for s in over}


def test_mix(docs, rows):
    got = mixing.mix(docs.withColumn("target", F.lit("clash"))).collect()
    sizes = Counter()
    for _, t, _, s, _ in rows:
        sizes[s] += len(WORD.findall(t or ""))
    want, taken = brute_targets(sizes), Counter()
    for r in got:
        assert r["size"] * 2 >= r["taken"] >= 0 and r["source_size"] == sizes[r["source"]] and math.isclose(r["target"], want[r["source"]], abs_tol=1e-6)
        taken[r["source"]] += r["taken"]
    assert len(got) == len(rows) and all(abs(taken[s] - want[s]) <= 1 for s in want)
    again = mixing.mix(docs.repartition(3))
    assert table(again, "doc_id", "taken") == sorted(((r["doc_id"], r["taken"]) for r in got), key=str)


def test_repeated_rows_of_the_mix(docs, rows):
    got = mixing.repeated(docs)
    assert got.columns == docs.columns
    n = Counter(r["doc_id"] for r in got.collect())
    copies = Counter(r[0] for r in rows)
    sizes = {r[0]: len(WORD.findall(r[1] or "")) for r in rows}
    assert all(n[i] <= 2 * copies[i] and (n[i] == 0 or sizes[i] > 0) for i in n)
    whole = {r["doc_id"]: r for r in mixing.mix(docs, split_last=False).collect()}
    assert all(n[i] == whole[i]["taken"] // max(1, sizes[i]) for i in n if copies[i] == 1)
    assert mixing.mix(docs.where("false")).count() == 0 and mixing.repeated(docs.where("false")).count() == 0


def test_bins_of_keys_are_small_at_any_weight(spark):
    data = [(i, "%%% !!! " * 5, "en", "s0", 0) for i in range(20_000)]
    keyed = spark.createDataFrame(data, SCHEMA).select(*[c.alias(n) for n, c in mixing._keyed(1).items()])
    assert keyed.groupBy("_bin").count().agg(F.max("count")).first()[0] < 0.01 * len(data)


def test_targets_of_many_sources(spark):
    r = random.Random(2)
    sizes = {f"s{i:04}": r.randint(0, 40) for i in range(500)} | {None: 7}
    got = mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long").repartition(6)).collect()
    want = brute_targets(sizes)
    assert len(got) == len(sizes) and all(math.isclose(x["target"], want[x["source"]], abs_tol=1e-6) for x in got)


def test_documents_of_quality_are_preferred(spark):
    data = [(i, ("%%% " if i % 2 else "ab ") * 20, "en", "s0", 0) for i in range(2000)] + [(5000 + i, "ab " * 40, "en", f"s{i % 5 + 1}", 0) for i in range(2000)]
    got = mixing.mix(spark.createDataFrame(data, SCHEMA)).where("source = 's0'").groupBy((F.col("doc_id") % 2).alias("bad")).agg(F.sum("taken").alias("n")).collect()
    n = {r["bad"]: r["n"] for r in got}
    assert n[0] > n[1]


# contamination


def items():
    return [(0, "Alice Smith bought 12 apples and paid 30 dollars for them at the old market in town. What did Alice Smith pay?"), (1, "the quick brown fox jumps over the lazy dog while nobody in the village looks at it"), (2, None), (3, "too short"), (4, "a small closed question here")]


def test_contamination(spark):
    good = items()[1][1]
    data = [
        (0, f"before. {good} after"), (1, good.upper()), (2, "unrelated words of a text about the lazy dog and nothing else at all in here"), (3, None), (4, ""),
        (5, "x. Then Carol Jones bought 17 apples and paid 45 dollars for them at the old market in town. What did Carol Jones pay?"),
        (6, "the quick brown fox jumps over the lazy dog"), (7, " ".join(good.split()[:4] + ["changed"] + good.split()[5:])), (8, "w " * 5000 + good), (9, "a small closed question here"), (0, f"before. {good} after"),
    ]
    own = spark.createDataFrame([(i, t, None, None, 0) for i, t in data], SCHEMA).withColumn("item_id", F.lit("clash"))
    bench = spark.createDataFrame(items(), "item_id long, text string")
    got = decontam.contaminated(own, bench)
    found = {(r["doc_id"], r["item_id"]) for r in got.collect()}
    assert found == {(0, 1), (1, 1), (5, 0), (7, 1), (8, 1), (9, 4)}
    assert "17" in " ".join(got.where("doc_id = 5").first()["substitutions"])
    left = decontam.clean(own, bench)
    assert left.columns == own.columns and sorted(r["doc_id"] for r in left.collect()) == [2, 3, 4, 6]
    assert decontam.contaminated(own.where("false"), bench).count() == 0 and decontam.contaminated(own, bench.where("false")).count() == 0


def test_inconsistent_slots_do_not_count():
    from tessera.llm.text import blocks
    import pyarrow as pa

    text = "We saw that Bob gave 5 coins to Bob and later 5 coins to the poor of Bob and 5 coins more to Bob again"
    index = decontam.build_index(["q"], [text])
    match = lambda t: [m for b in blocks(pa.array([t])) for m in decontam.match_block(b, index)]
    assert match(text) and match(text.replace("Bob", "Eve").replace("5", "7"))
    mixed, names = text, iter(["Ann", "Joe", "Kim", "Lee", "Max"])
    while "Bob" in mixed:
        mixed = mixed.replace("Bob", next(names), 1)
    assert not match(mixed)


def matched(item, text):
    import pyarrow as pa
    from tessera.llm.text import blocks

    index = decontam.build_index(["q"], [item])
    return [m for b in blocks(pa.array([text])) for m in decontam.match_block(b, index)]


def test_names_at_the_start_of_sentences_and_capitals():
    tom = "Tom has 5 apples. Tom buys 3 more. Tom eats 2. How many apples does Tom have now?"
    ann = tom.replace("Tom", "Ann").replace("5", "7").replace("3", "4").replace("2", "1")
    (m,) = matched(tom, ann)
    assert {"tom=ann", "5=7"} <= set(m[5])
    once = "Tom walks to the shop and buys a loaf of bread."
    assert matched(once, once.replace("Tom", "Ann"))
    german = "Der Hund von Peter jagt die Katze durch den Garten und Peter sucht im Haus nach seiner Leine."
    for text in (german.lower(), german.upper(), german.replace(" Peter", "\nPeter").replace(" Haus", "\nHaus"), german.replace("Peter", "Otto")):
        assert matched(german, text)
    assert not matched(tom, "Eva owns 5 pears. Max sells 3 pens. How many rooms does the house have?")


@pytest.mark.parametrize("item", ["Compute 12 + 7 * 3", "Anna Berta Clara Dora Emil Fritz Gustav", "12 kg 15 kg 18 kg 21 kg 24 kg 27 kg", "Solve 42", "小明有五个苹果，又买了三个，一共有几个？", "3 + 4", "有几个", "ไม่มีใคร"])
def test_items_without_plain_words(item):
    assert matched(item, f"before. {item} after") and matched(item, f"天地玄黄。{item}宇宙洪荒") and matched(item, item)
    changed = item.replace("7", "8").replace("Dora", "Doris").replace("21", "22").replace("42", "43").replace("4", "5").replace("几", "九").replace("五个苹果", "很多书").replace("又买了", "他看见").replace("ม", "ก")
    assert changed != item and not matched(item, f"before. {changed} after")


def test_items_of_one_token_match_whole_lines_only():
    assert matched("42", "Answer:\n 42.\nNext") and not matched("42", "There are 42 of them") and not matched("...", "...")


def test_parts_of_items():
    r = random.Random(6)
    word = lambda: "".join(r.choices("abcdefghij", k=6))
    some = lambda n: " ".join(word() for _ in range(n))
    first, second = some(10), some(10)
    (m,) = matched(f"{first} {second}", f"{some(50)} {first} {some(6)} {second} {some(50)}")
    assert m[2:5] == (16, 12, 0.75)
    assert not matched(f"{first} {second}", f"{first} {some(500)} {second}")
    long = [word() for _ in range(400)]
    (m,) = matched(" ".join(long), f"{some(30)} {' '.join(long[100:290])} {some(30)}")
    assert m[2:4] == (396, 186)
    assert matched(" ".join(long), some(30) + " " + " ".join(long[7:20])) and not matched(" ".join(long), some(30) + " " + " ".join(long[7:19]))
    named = " ".join(long[:13]) + " Bob " + " ".join(long[13:26])
    assert matched(f"{named} {some(100)}", f"{some(30)} {named.replace('Bob', 'Eve')} {some(30)}")


def test_planted_items_are_found_and_others_are_not():
    """Items at random, in documents as they are, in other capitals, with other values in their slots, with a
    few words put in; and values that contradict each other, or too little of an item."""
    import pyarrow as pa
    from tessera.llm.text import blocks

    r = random.Random(12)
    word = lambda: "".join(r.choices("abcdefghijklm", k=r.randint(4, 9)))
    some = lambda n: [word() for _ in range(n)]
    bench, docs, want = [], [], set()
    for i in range(60):
        words = some(r.randint(14, 30))
        for j in range(3, len(words), 6):
            words[j] = r.choice(["Bob", str(r.randint(2, 99))])
        bench.append(" ".join(words))
        other = {"Bob": "Eve"} | {w: str(100 + int(w)) for w in words if w.isdigit()}
        kinds = [words, [w.upper() for w in words], [other.get(w, w) for w in words], words[: len(words) // 2] + some(2) + words[len(words) // 2 :], words[: len(words) // 4], [w if j % 2 else word() for j, w in enumerate(words)]]
        for k, own in enumerate(kinds):
            if k < 4:
                want.add((len(docs), i))
            docs.append(" ".join([*some(r.randint(0, 40)), *own, *some(r.randint(0, 40))]))
    index = decontam.build_index(list(range(60)), bench)
    got = {(b.rows.start + m[0], m[1]) for b in blocks(pa.array(docs), 20_000) for m in decontam.match_block(b, index)}
    assert got == want


# languages


def test_language_id(spark):
    r = random.Random(4)
    vocab = {"aa": ["the", "and", "ing", "th"], "bb": ["der", "ung", "sch", "über"], "cc": ["que", "ción", "ado", "ñ"]}
    data = [(i, " ".join("".join(r.choices(vocab[c], k=r.randint(1, 3))) for _ in range(r.randint(3, 60))), c, "s", 0) for i in range(600) for c in [["aa", "bb", "cc"][i % 3]]]
    data += [(1000, None, "aa", "s", 0), (1001, "", "aa", "s", 0), (1002, "123 !!", "aa", "s", 0), (1003, "über", None, "s", 0), (None, "the and", "aa", "s", 0), data[0]]
    df = spark.createDataFrame(data, SCHEMA).withColumn("score", F.lit("clash"))
    got = langid.identify(df).collect()
    assert len(got) == len(data)
    truth = {d[0]: d[2] for d in data}
    for x in got:
        assert 0 <= x["score"] <= 1 and x["held_out"] == (x["doc_id"] is not None and zlib.crc32(str(x["doc_id"]).encode()) % 3 == 1)
        assert (x["lang_pred"] == "und") == (x["doc_id"] in (1000, 1001, 1002))
    held = [x for x in got if x["held_out"] and x["doc_id"] < 600]
    assert sum(x["lang_pred"] == truth[x["doc_id"]] for x in held) >= 0.97 * len(held)
    only = langid.identify(df.withColumn("lang", F.lit(None).cast("string"))).select("lang_pred").distinct().collect()
    assert [x[0] for x in only] == ["und"] and langid.identify(df.where("false")).count() == 0


def test_kernel_is_exact_on_presence():
    import numpy as np
    import pyarrow as pa
    from tessera.llm.text import blocks

    texts = ["abc", "xabcx", "", "é", "ab ab ab"]
    (b,) = blocks(pa.array(texts))
    flags = langid.presence(b)
    for t, f in zip(texts, flags, strict=True):
        body = t.encode()
        grams = {body[i : i + n] for n in langid.ORDERS for i in range(len(body) - n + 1)}
        assert f.sum() == len(grams)
    assert np.array_equal(flags[0] & flags[1], flags[0])


def test_scores_are_those_of_the_kernel():
    """The folded matrix against kernel values by sets, Nystroem features and ridge regression step by step."""
    import numpy as np
    import pyarrow as pa
    from tessera.llm.text import blocks

    r = random.Random(9)
    vocab = {"aa": ["the", "and", "ing"], "bb": ["der", "ung", "sch"], "cc": ["que", "ado", "cia"]}
    texts = [" ".join("".join(r.choices(vocab[c], k=2)) for _ in range(r.randint(3, 12))) for _ in range(20) for c in vocab]
    languages = np.array([c for _ in range(20) for c in vocab])
    (b,) = blocks(pa.array(texts))
    flags = langid.presence(b)
    model = langid.fit(languages, np.packbits(flags, axis=1), landmarks=6, ridge=0.1)
    sets = [set(np.flatnonzero(f)) for f in flags]
    kernel = lambda a, c: len(a & c) / math.sqrt(len(a) * len(c))
    marks = [s for c in sorted(vocab) for s in [x for x, y in zip(sets, languages, strict=True) if y == c][:6]]
    inner = np.array([[kernel(a, c) for c in marks] for a in marks])
    values, vectors = np.linalg.eigh(inner)
    z = np.array([[kernel(a, c) for c in marks] for a in sets]) @ (vectors[:, values > 1e-6 * values.max()] / np.sqrt(values[values > 1e-6 * values.max()]))
    centred = z - z.mean(0)
    y = np.where(languages[:, None] == np.array(sorted(vocab))[None, :], 1.0, -1.0)
    solved = np.linalg.solve(centred.T @ centred + 0.1 * len(z) / z.shape[1] * np.eye(z.shape[1]), centred.T @ (y - y.mean(0)))
    assert np.allclose(model.scores(flags), centred @ solved + y.mean(0), atol=1e-3)


CLASHES = ["size", "slot", "shard", "target", "taken", "_own", "_key", "_bin", "_h", "_text", "node", "label", "n_words", "labels", "kept", "item_id", "share", "c0", "key", "places", "grams", "skip", "text_hash", "w"]


def test_columns_of_clashing_names(spark, docs, rows):
    """Filtering operators return them as they came; others carry those along whose names are free."""
    wide = docs.withColumns({c: F.lit(f"own {c}") for c in CLASHES})
    bench = spark.createDataFrame(items(), "item_id long, text string").withColumn("doc_id", F.lit("clash"))
    labels = spark.createDataFrame([(0, 1)], "doc_id long, quality int").withColumns({c: F.lit(c) for c in ("lang", "text", "n_words")})
    for got in (neardup.keep_one(wide), mixing.repeated(wide), quality.keep(wide, labels), decontam.clean(wide, bench)):
        assert got.columns == wide.columns
        first = got.first()
        assert all(first[c] == f"own {c}" for c in CLASHES)
    for got in (sharding.shard(wide, keep=wide.columns[1:]), mixing.mix(wide, keep=CLASHES[:4]), quality.assess(wide, labels, keep=CLASHES[10:15]), license_scan.scan(wide, keep=CLASHES)[0]):
        assert got.count() == len(rows) and len(got.columns) == len(set(got.columns))
    assert sharding.shard(wide, keep=wide.columns[1:]).first()["node"] == "own node"
    assert decontam.contaminated(wide, bench, keep=CLASHES).count() == 0
