"""Each operator against brute force on small tables, and on the awkward cases its docstring defines."""

import collections
import hashlib
import os
import random
import re
import subprocess
import sys
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallystar import storage
from tallystar.llm import (
    boosting,
    op01_balanced_labels,
    op02_license_scan,
    op03_fuzzy_lines,
    op04_suffix_index,
    op05_best_fit_packing,
    op06_weak_supervision,
    op07_noisy_channel,
    op08_quality_rules,
    op09_templates,
    op10_signature_tree,
    tokens,
)
from tallystar.llm.common import number_within
from tallystar.llm.graph import components

SF = "/root/testdata/sf0.001"
SYLLABLES = "an re th in er on at nd st es en of te ed or ti hi as to".split()


def sentence(rng, n):
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n))


def near(rng, text, edits):
    words = text.split(" ")
    for _ in range(edits):
        words[rng.randrange(len(words))] = "edit" + str(rng.randrange(10**6))
    return " ".join(words)


@pytest.fixture(scope="module")
def texts():
    """Distinct texts, copies, near copies, a shared passage, repeated lines."""
    rng = random.Random(5)
    passage = sentence(rng, 25)
    rows = [sentence(rng, rng.randint(1, 90)) for _ in range(60)]
    rows += [rows[i] for i in (1, 1, 2, 3)]
    rows += [near(rng, rows[i], e) for i in range(20) for e in (1, 3, 8)]
    rows += [sentence(rng, 30) + " " + passage + "\n" + sentence(rng, 20) for _ in range(12)]
    rows += [near(rng, sentence(rng, 60), 1)] * 3
    rows += ["\n".join([rows[4], sentence(rng, 15), rows[4]])]
    return rows


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(3 * i + 1, t, "en", "a", len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)


AWKWARD = [None, "", " ", "\n\n", "x", "one two three", "É ü 漢字 text", "ab " * 40_000, "q" * 30_000, "1 2 3 4 5 6 7 8 9", "same", "same", "\x00\x01 a"]


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls, empty and long texts, repeated rows, and extra columns whose names the operators use inside."""
    rows = [(i, t, 1.0, "z", 7, 8, [1]) for i, t in enumerate(AWKWARD)] + [(10, "same", 1.0, "z", 7, 8, [1])]
    names = "doc_id long, text string, score double, unit string, shard int, n long, keys array<int>"
    return spark.createDataFrame(rows, names)


@pytest.fixture(scope="module")
def nothing(awkward):
    return awkward.limit(0)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, None, 1), (3, 0, None), (4, 0, 1), (4, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


# Numbering and components


def test_numbers_within_keys_are_gapless(spark):
    rows = spark.range(500).select((F.col("id") % 3).alias("k"), (F.col("id") * 7 % 101).alias("x"), "id").repartition(7)
    found = number_within(rows, ["k"], ["x", "id"], "rank").collect()
    for key in range(3):
        own = sorted((r["x"], r["id"], r["rank"]) for r in found if r["k"] == key)
        assert [r[2] for r in own] == list(range(len(own)))


def test_components_equal_union_find(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000, 1000 + i) for i in range(1, 80)] + [(i, i + 1) for i in range(2000, 2060)]
    parent = {v: v for link in links for v in link}

    def head(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in links:
        x, y = sorted((head(a), head(b)))
        parent[y] = x
    found = {r["id"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    linked = {v for a, b in links if a != b for v in (a, b)}
    assert found == {v: head(v) for v in linked}


# 1. Sharding


def test_shards_are_even_and_groups_stay_together(docs, texts):
    rows = op01_balanced_labels.balanced_labels(docs, shards=5).collect()
    sizes = collections.Counter(r["shard"] for r in rows)
    assert len(rows) == len(texts) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard in sizes:
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(sizes[shard]))
    shards = collections.defaultdict(set)
    for r in rows:
        text = texts[(r["doc_id"] - 1) // 3]
        assert (r["size"], r["text_crc32"]) == (len(text.encode()) + 8, zlib.crc32(text.encode()))
        shards[text].add(r["shard"])
    assert max(map(len, shards.values())) == 1


def test_a_group_with_most_rows_is_spread_and_even(spark):
    rows = [(i, "hot" if i % 3 else f"t{i // 2}") for i in range(600)]
    placed = op01_balanced_labels.balanced_labels(spark.createDataFrame(rows, "doc_id long, text string"), shards=6).collect()
    assert set(collections.Counter(r["shard"] for r in placed).values()) == {100}


def test_all_documents_in_pairs_find_each_other(spark):
    rows = [(i, f"pair {i % 120}") for i in range(240)]
    placed = op01_balanced_labels.balanced_labels(spark.createDataFrame(rows, "doc_id long, text string"), shards=4).collect()
    shards = collections.defaultdict(set)
    for r in placed:
        shards[r["doc_id"] % 120].add(r["shard"])
    assert sum(len(s) == 1 for s in shards.values()) >= 110
    assert set(collections.Counter(r["shard"] for r in placed).values()) == {60}


def test_shards_of_awkward_rows(awkward, nothing):
    rows = op01_balanced_labels.balanced_labels(awkward, shards=3).collect()
    assert len(rows) == len(AWKWARD) + 1
    assert next(r for r in rows if r["doc_id"] == 0).asDict() | {"shard": 0, "slot": 0, "unit": 0} == {"doc_id": 0, "size": 8, "text_crc32": 0, "shard": 0, "slot": 0, "unit": 0}
    assert op01_balanced_labels.balanced_labels(nothing).count() == 0


# 2. Licence scan


def base_scan(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    starts, found = [], set()
    for phrase, label in op02_license_scan.BASE.items():
        p = phrase.split()
        hits = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        starts += hits
        found |= {label} if hits else set()
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(found))


def test_base_places_and_labels_of_templates(spark):
    cases = [
        "Licensed under CC BY-NC 4.0.",
        "x\nThis work is licensed under the GNU General Public License, version 3.\ny MIT License mit license",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        "the license of an apache helicopter", "cc  bý", "", None, "ÀPACHE LICENSE apache\x00license",
    ]
    found = by_id(op02_license_scan.license_scan(spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")))
    for i, text in enumerate(cases):
        r = found[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == base_scan(text)
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
    assert found[0]["labels"] == "cc-by,cc-by-nc-4.0"
    assert found[1]["labels"] == "gpl,gpl-3.0,mit"
    assert found[2]["labels"] == "mit" and found[3]["labels"] == ""


def test_scan_of_awkward_rows(awkward, nothing):
    rows = op02_license_scan.license_scan(awkward).collect()
    assert sorted(r["n_words"] for r in rows) == sorted(base_scan(t)[0] for t in [*AWKWARD, "same"])
    assert op02_license_scan.license_scan(nothing).count() == 0


# 3. Fuzzy lines


def shingles(line):
    n = op03_fuzzy_lines.SHINGLE
    return {line[i : i + n] for i in range(len(line) - n + 1)} or {line}


def test_lines_are_removed_exactly_and_with_high_recall(spark):
    rng = random.Random(2)
    lines = [sentence(rng, rng.randint(3, 40)) for _ in range(80)]
    lines += [near(rng, x, 1) for x in lines[:40]] + lines[10:20] + ["", "  ", "ok", "ok"]
    rng.shuffle(lines)
    rows = [(i, "\n".join(lines[i * 6 : i * 6 + 6])) for i in range((len(lines) + 5) // 6)]
    first, different = {}, []
    for d, t in rows:
        for i, line in enumerate(t.split("\n")):
            if line.strip() and line not in first:
                first[line] = (d, i)
                different.append(line)
    parent = {x: x for x in different}

    def head(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = {x: shingles(x) for x in different}
    for i, x in enumerate(different):
        for y in different[:i]:
            if len(sets[x] & sets[y]) >= 0.75 * len(sets[x] | sets[y]):
                a, b = sorted((head(x), head(y)), key=first.get)
                parent[b] = a
    expected = {(d, i) for d, t in rows for i, x in enumerate(t.split("\n")) if x.strip() and first[head(x)] != (d, i)}
    docs = spark.createDataFrame([(d, t, "k") for d, t in rows], "doc_id long, text string, pos string")
    found = {tuple(r) for r in op03_fuzzy_lines.removed_lines(docs).collect()}
    exact = {(d, i) for d, t in rows for i, x in enumerate(t.split("\n")) if x.strip() and first[x] != (d, i)}
    assert exact <= found <= expected and len(found) >= 0.9 * len(expected)
    kept = by_id(op03_fuzzy_lines.fuzzy_line_dedup(docs))
    for d, t in rows:
        assert kept[d]["text"] == "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in found) and kept[d]["pos"] == "k"


def test_lines_of_awkward_rows(awkward, nothing):
    kept = op03_fuzzy_lines.fuzzy_line_dedup(awkward).collect()
    assert len(kept) == len(AWKWARD) + 1 and kept[0].asDict().keys() == set(awkward.columns)
    found = {r["doc_id"]: r["text"] for r in kept}
    assert found[0] is None and found[1] == "" and found[3] == "\n\n" and found[11] == ""
    assert op03_fuzzy_lines.fuzzy_line_dedup(nothing).count() == 0


def line_docs(spark, lines):
    return spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")


def test_near_copies_are_found_however_many_lines_share_a_band(spark):
    rng = random.Random(11)
    words = [sentence(rng, 1) for _ in range(60)]
    lines = [" ".join(rng.choices(words, k=8)) for _ in range(900)]
    lines += [x[:-1] + ("x" if x[-1] != "x" else "y") for x in lines[:300]]
    distinct = op03_fuzzy_lines.distinct_lines(op03_fuzzy_lines.lines_of(line_docs(spark, lines))).persist()
    # As if all lines had one band in common: no pair may be left out then.
    hot = distinct.withColumn("bands", F.array(F.lit(1).cast("long"))).persist()
    shared = op03_fuzzy_lines.shared_bands(hot)
    stars = op03_fuzzy_lines.star_pairs(shared).persist()
    nothing = spark.createDataFrame([], "id long, component long")
    rest = op03_fuzzy_lines.remaining_pairs(op03_fuzzy_lines.open_rows(shared, nothing), stars)
    place = {r["num"]: r["first"]["doc_id"] for r in hot.collect()}
    found = {tuple(sorted((place[r["a"]], place[r["b"]]))) for r in stars.unionByName(rest).collect()}
    sets = [shingles(x) for x in lines]
    for i in range(300):
        a, b = sets[i], sets[900 + i]
        assert lines[i] == lines[900 + i] or len(a & b) < 0.75 * len(a | b) or (i, 900 + i) in found
    gone = {r["doc_id"] for r in op03_fuzzy_lines.removed_lines(line_docs(spark, lines)).collect()}
    close = [900 + i for i in range(300) if len(sets[i] & sets[900 + i]) >= 0.75 * len(sets[i] | sets[900 + i])]
    assert len(gone & set(close)) >= 0.97 * len(close)


def test_only_near_copies_become_rows_where_many_lines_share_a_band(spark):
    rng = random.Random(13)
    family = [sentence(rng, 12), sentence(rng, 130)]
    lines = [near(rng, x, rng.randint(0, 6)) + "." * rng.randint(1, 40) for x in family for _ in range(150)]
    lines = sorted(set(lines))
    distinct = op03_fuzzy_lines.distinct_lines(op03_fuzzy_lines.lines_of(line_docs(spark, lines))).persist()
    hot = distinct.withColumn("bands", F.array(F.lit(1).cast("long"), F.lit(2).cast("long"))).persist()
    shared = op03_fuzzy_lines.shared_bands(hot)
    place = {r["num"]: r["first"]["doc_id"] for r in hot.collect()}
    texts = spark.createDataFrame([(n, lines[d]) for n, d in place.items()], "num long, line string")
    known = texts.join(op03_fuzzy_lines.sketched(texts), "num").join(hot.select("num", "bands"), "num")
    links, pairs = (spark.createDataFrame([], f"{c} long, {d} long") for c, d in (("id", "component"), ("a", "b")))
    rest = op03_fuzzy_lines.remaining_pairs(op03_fuzzy_lines.open_rows(shared, links), pairs, known)
    found = [tuple(sorted((place[r["a"]], place[r["b"]]))) for r in rest.collect()]
    sets = [shingles(x) for x in lines]
    expected = {(i, j) for j, b in enumerate(sets) for i, a in enumerate(sets[:j]) if len(a & b) >= 0.75 * len(a | b)}
    assert sorted(found) == sorted(expected) and 0 < len(expected) < len(lines) * (len(lines) - 1) / 3


def test_equal_shingle_sets_of_other_lengths_are_linked(spark):
    lines = ["-" * 40, "-" * 80, "=" * 30 + "#" * 30, "ab" * 10, "ab" * 50]
    assert {r["doc_id"] for r in op03_fuzzy_lines.removed_lines(line_docs(spark, lines)).collect()} == {1, 4}


def test_near_copies_without_white_space_are_found(spark):
    rng = random.Random(12)
    lines = ["".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(120)) for _ in range(40)]
    lines += [chr(0x3042) + x[1:] for x in lines]
    assert len(op03_fuzzy_lines.removed_lines(line_docs(spark, lines)).collect()) == 40


# 4. Suffix index


def cut_by_brute_force(rows):
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        raw = (text or "").encode()
        windows = [raw[i : i + 50] for i in range(len(raw) - 49)]
        covered = bytearray(len(raw))
        for i, w in enumerate(windows):
            if w in seen:
                covered[i : i + 50] = b"\1" * 50
        seen.update(windows)
        rest = bytes(b for b, c in zip(raw, covered) if not c)
        spans = sum(1 for i, c in enumerate(covered) if c and (i == 0 or not covered[i - 1]))
        out[doc_id] = (len(raw), len(raw) - len(rest), spans, hashlib.sha256(rest).hexdigest())
    return out


@pytest.mark.parametrize("batches", [1, 2, 4, 7])
def test_passages_are_cut_like_brute_force(docs, texts, batches):
    found = op04_suffix_index.suffix_dedup(docs, batches).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in found} == cut_by_brute_force([(3 * i + 1, t) for i, t in enumerate(texts)])


@pytest.mark.parametrize(("heavy", "slice_"), [(3, 2), (1_000, 3)])
def test_passages_in_most_documents(spark, monkeypatch, heavy, slice_):
    """A passage of most documents, its ends unlike: a low limit makes its anchors heavy, small slices meet again."""
    monkeypatch.setattr(op04_suffix_index, "SLICE", slice_)
    rng = random.Random(heavy)
    passage = sentence(rng, 60)
    rows = [(i, sentence(rng, i % 9) + (passage if i % 3 else passage[i : i + 70 + i]) + sentence(rng, i % 7)) for i in range(90)]
    rows += [(90 + i, rows[i][1]) for i in range(20)] + [(None, passage), (None, passage)]
    found = op04_suffix_index.suffix_dedup(spark.createDataFrame(rows, "doc_id long, text string"), 3, heavy=heavy).collect()
    expected = cut_by_brute_force([r for r in rows if r[0] is not None])
    assert {r["doc_id"]: tuple(r)[1:] for r in found if r["doc_id"] is not None} == expected
    assert [r["n_removed"] for r in found if r["doc_id"] is None] == [0, 0]


def test_windows_are_equal_only_with_all_bytes():
    rng = np.random.default_rng(5)
    texts = [bytes(rng.integers(97, 99, 50, dtype=np.uint8)) for _ in range(6)]
    texts += [texts[0][:49] + b"z", b"z" + texts[1][1:]]
    picks = rng.integers(0, len(texts), 200)
    joined = np.frombuffer(b"".join(texts[i] for i in picks), np.uint8)
    starts = np.arange(200) * 50
    for hashed in (picks.astype(np.uint64) * np.uint64(7), (picks % 2).astype(np.uint64), np.zeros(200, np.uint64)):
        order, heads = op04_suffix_index.equal_windows(hashed, starts, joined)
        groups = np.split(order, heads[1:])
        assert sorted(sorted(g.tolist()) for g in groups) == sorted(np.flatnonzero(picks == i).tolist() for i in np.unique(picks))


def test_passages_at_limits_and_in_stretches(spark, monkeypatch):
    rng = random.Random(3)
    shared = sentence(rng, 40)
    rows = [(1, shared[:50]), (2, "#" + shared[:49]), (3, shared[:49]), (4, shared[10:60] + "é" + shared[:50]), (5, "ab" * 200), (6, "ba" * 100), (7, "x" * 49), (8, "x" * 60), (9, "y" + "x" * 55)]
    found = op04_suffix_index.suffix_dedup(spark.createDataFrame(rows, "doc_id long, text string"), 3).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in found} == cut_by_brute_force(rows)
    whole = op04_suffix_index.anchors((shared * 9).encode())
    monkeypatch.setattr(op04_suffix_index, "STRETCH", 256)
    monkeypatch.setattr(op04_suffix_index, "PLACE", np.uint64(255))
    pieces = op04_suffix_index.anchors((shared * 9).encode())
    assert pieces[2].sum() == whole[2].sum() == len(shared * 9) - 49


def test_passages_of_awkward_rows(awkward, nothing):
    rows = op04_suffix_index.suffix_dedup(awkward, with_text=True).collect()
    assert len(rows) == len(AWKWARD) + 1 and all(r["n_removed"] == 0 and r["n_bytes"] == len(r["kept"]) for r in rows)
    assert op04_suffix_index.suffix_dedup(nothing).count() == 0


# 5. Packing


def test_ids_are_those_of_the_tokenizer(texts):
    words = tokens.words()
    cases = [*texts[:30], "It's <|endoftext|> a<|startoftext|>b don't we'LL İ ΣΑΣ. naïve\x1cz\u0085q 12.5 a_b", "ÀÉ×÷ßÿ ª²½", "漢字 テスト", "é decomposed", "", "\x00 \x7f"]
    for text in cases:
        expected = words.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(words.ids(text.encode()), "<u4").tolist() == expected


def check_packing(rows, docs):
    by_sequence, by_doc = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
        by_doc[r["doc_id"]].append(r)
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    words = tokens.words()
    for doc_id, text in docs.items():
        every = words.ids((text or "").encode()) + np.array([1], "<u4").tobytes()
        pieces = sorted(by_doc[doc_id], key=lambda r: r["piece"])
        assert [(p["start"], p["length"]) for p in pieces] == [(a, min(4096, len(every) // 4 - a)) for a in range(0, len(every) // 4, 4096)]
        assert all(p["ids_crc32"] == zlib.crc32(every[p["start"] * 4 : (p["start"] + p["length"]) * 4]) for p in pieces)
    return len(by_sequence)


def test_pieces_are_packed_tightly(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op05_best_fit_packing.op5_best_fit_packing(spark, SF).collect()
    assert check_packing(rows, docs) <= np.ceil(sum(r["length"] for r in rows) / 4096) + 2


def test_packing_awkward_rows(awkward, nothing):
    rows = op05_best_fit_packing.best_fit_packing(awkward.filter("doc_id <> 10")).collect()
    check_packing(rows, {i: t for i, t in enumerate(AWKWARD) if i != 10})
    assert op05_best_fit_packing.best_fit_packing(nothing).count() == 0


def test_texts_are_cut_in_small_batches_without_pandas(spark, docs, monkeypatch):
    seen, durable = [], op05_best_fit_packing.durable

    def watched(df):
        seen.append(spark.conf.get(storage.BATCH_CONF))
        return durable(df)

    monkeypatch.setattr(op05_best_fit_packing, "durable", watched)
    before = spark.conf.get(storage.BATCH_CONF)
    op05_best_fit_packing.best_fit_packing(docs).count()
    assert int(seen[0]) <= 1024 and spark.conf.get(storage.BATCH_CONF) == before
    code = "import sys, tallystar.llm.op05_best_fit_packing; sys.exit('pandas' in sys.modules)"
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    assert subprocess.run([sys.executable, "-B", "-c", code], cwd=root).returncode == 0


def test_words_forgotten_and_met_again_have_the_same_ids(monkeypatch):
    text = " ".join(AWKWARD[6:7] + ["it's naïve 42 <unk>", sentence(random.Random(8), 200)] * 2).encode()
    whole = tokens.words().ids(text)
    monkeypatch.setattr(tokens, "CHUNKS", 3)
    monkeypatch.setattr(tokens, "WORDS", 2)
    assert tokens.Words(tokens.public_tokenizers.path(tokens.VOCABULARY)).ids(text) == whole


def test_sum_of_squares_fills_perfectly_packable_sizes():
    lengths = np.array(sorted([3, 7] * 50, reverse=True))
    bins, offsets = op05_best_fit_packing.sum_of_squares(lengths, 10)
    assert len(set(bins.tolist())) == 50 and offsets.max() == 7


# 6. Personal data


def base_by_regex(text):
    luhn = op06_weak_supervision.luhn
    spans = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    spans += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        spans += [("card", *m.span())] if 12 <= len(d) <= 19 and luhn(d) else []
    spans += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(spans, key=lambda s: (s[1], op06_weak_supervision.KINDS.index(s[0])))


def test_base_spans_equal_plain_patterns():
    rng = random.Random(4)
    alphabet = "ab.@@--+  0123456789...é%()"
    for _ in range(3000):
        text = "".join(rng.choices(alphabet, k=rng.randint(1, 60)))
        assert sorted(op06_weak_supervision.base_spans(text)) == sorted(base_by_regex(text)), text
    for text in ("mail a.b+c@x-y.example.com, ip 10.0.0.255 and 1.2.3.4.5.6.7.8", "4111 1111 1111 1111 or +1 (414) 555-3519.", "1" * 40, "é me@x.y@z.w"):
        assert sorted(op06_weak_supervision.base_spans(text)) == sorted(base_by_regex(text))


def test_base_spans_stay_and_spans_are_added(spark):
    rows = [(i, f"contact user{i}@mail.example.com or +1 (414) 555-35{i % 100:02d} from 10.1.2.{i} card 4111 1111 1111 1111") for i in range(60)]
    rows += [(100 + i, f'token = "{hashlib.sha1(str(i).encode()).hexdigest()}" end') for i in range(60)] + [(200, "plain words"), (201, None)]
    found = by_id(op06_weak_supervision.weak_supervision(spark.createDataFrame(rows, "doc_id long, text string")))
    for i, text in rows:
        r = found[i]
        base = [f"{k}:{a}:{b}" for k, a, b in base_by_regex(text or "")]
        assert r["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(r["spans"].split(",")) | {""} or not base
        assert [r[f"n_{k}"] for k in op06_weak_supervision.BASE_KINDS] == [sum(x.startswith(k) for x in base) for k in op06_weak_supervision.BASE_KINDS]
    assert found[100]["spans"] == "secret:9:49" and found[200]["spans"] == ""


def test_expectation_maximisation_finds_the_unreliable_labeler():
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.4
    right = [0.95, 0.9, 0.55, 0.9, 0.85]
    votes = np.zeros(len(truth), int)
    for p in right:
        votes = votes * 3 + np.where(rng.random(len(truth)) < p, truth, ~truth) + 1
    kinds, counts = np.unique(votes, return_counts=True)
    chance, p, prior = op06_weak_supervision.reliabilities(kinds, counts.astype(float))
    assert np.abs(chance[:, 1, 2] - right).max() < 0.06 and abs(prior - 0.4) < 0.05
    guessed = p[np.searchsorted(kinds, votes)] > 0.5
    assert (guessed == truth).mean() > 0.95


def test_personal_data_of_awkward_rows(awkward, nothing):
    assert op06_weak_supervision.weak_supervision(awkward).count() == len(AWKWARD) + 1
    assert op06_weak_supervision.weak_supervision(nothing).count() == 0


# 7. Toxicity


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(6)
    rows = [(i, sentence(rng, 30) + (" what a stupid idiot and worthless loser" if i % 4 == 0 else " a calm and pleasant day")) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.select("doc_id", F.lit(1).alias("quality"), (F.col("doc_id") % 4 == 0).cast("int").alias("toxic"))
    return docs, labels, op07_noisy_channel.language_model(op07_noisy_channel.count_characters(docs))


def test_obfuscated_words_are_restored(model):
    restore = op07_noisy_channel.Restorer(model[2])
    for raw, plain in ((b"you 1d10t", b"you idiot"), (b"s t u p i d", b"stupid"), (b"l.o.s.e.r now", b"loser now"), (b"stuuuupid", b"stupid"), (b"w0rthl3ss", b"worthless")):
        assert restore([raw]) == [plain]
    plain = [b"a calm and pleasant day", b"", b"4111 1111", b"x### 123$$$ y,&&& z"]
    assert restore(plain) == plain


def test_other_forms_of_obfuscation_are_restored(model):
    restore = op07_noisy_channel.Restorer(model[2])
    forms = (b"lo$er", b"lo$$er", b"iiddiioott", b"id-iot", b"i--d--i--o--t", b"i  d  i  o  t", b"stup!d")
    found = [restore([raw])[0] for raw in forms]
    assert found == [b"loser", b"loser", b"idiot", b"idiot", b"idiot", b"idiot", b"stupid"], found
    # Restored anew from now on, whatever the small model makes of them.
    for raw in (b"f**k", b"a$$hole", b"(rap", b"+he"):
        assert len(op07_noisy_channel.suspicious(np.frombuffer(b"\n" + raw + b"\n", np.uint8)))


def test_model_rows_are_probabilities(model):
    assert np.allclose(np.exp(model[2]).sum(axis=1), 1, atol=1e-4)


def test_scores_of_held_out_documents(spark, model):
    docs, labels, _ = model
    more = docs.unionByName(spark.createDataFrame([(900_001, "such a st00pid 1d10t and l o s e r, w0rthl3ss"), (900_002, "a calm day"), (900_003, None)], docs.schema))
    found = by_id(op07_noisy_channel.toxicity(more, labels))
    for i in range(400):
        assert found[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= found[i]["score"] <= 1
        assert found[i]["predicted"] == (i % 4 == 0)
    assert [found[900_000 + i]["predicted"] for i in (1, 2, 3)] == [1, 0, 0]


def test_viterbi_finds_the_cheapest_of_all_readings(model):
    """Every way to read a short token, one by one, under the same costs."""
    op, costs = op07_noisy_channel, model[2]

    def all_readings(raw):
        paths = [(0.0, 0, b"")]
        for i in range(len(raw)):
            paths = [
                (cost + channel, state, written)
                if symbol < 0 or (symbol == 0 and state % op.SYMBOLS == 0)
                else (cost + channel - costs[state, symbol], state % op.SYMBOLS ** (op.ORDER - 2) * op.SYMBOLS + symbol, written + text)
                for cost, state, written in paths
                for symbol, text, channel in op._readings(raw, i)
            ]
        return [(cost - costs[state, 0] * (state % op.SYMBOLS > 0), written) for cost, state, written in paths]

    for raw in (b"1d10t", b"l0ss", b"a$$", b"i-d-i", b"st*p1d", b"b00k", b"w o r d", b"heeel", b"*l|"):
        found = all_readings(raw)
        best = min(found)[0]
        assert op.decode(raw, costs) in {written for cost, written in found if abs(cost - best) < 1e-4}, raw


def test_ordinary_doubled_letters_stay(spark, model):
    """A frequent word is a word; letters doubled throughout, and rare tokens, still reach the decoder."""
    op = op07_noisy_channel
    assert op.ordinary(b"worthless") and op.ordinary(b"Letter") and not op.ordinary(b"iiddiioott") and not op.ordinary(b"looose") and not op.ordinary(b"w0rthless")
    docs = spark.createDataFrame([(i, "worthless letters wwoorrtthh 1d10t") for i in range(9)], "doc_id long, text string")
    context = spark.sparkContext
    frequent = op.frequent_readings(op.gather(docs), context.broadcast(model[2]))
    assert set(frequent) == {b"worthless", b"letters", b"wwoorrtthh", b"1d10t"}
    assert frequent[b"worthless"] == b"worthless" and frequent[b"1d10t"] == op.decode(b"1d10t", model[2])
    restored = op.Restorer(model[2], frequent)([b"worthless 1d10t"])[0]
    assert restored.split()[0] == b"worthless"


def test_each_row_is_judged_by_its_own_text(spark, model):
    """Toxic rows go and clean rows stay, also where ids are null or repeated."""
    docs, labels, _ = model
    scored = op07_noisy_channel.toxicity(docs, labels)
    bad, fine = (scored.filter(f"predicted = {p}").join(docs, "doc_id").filter("length(text) > 100").select("text").first()[0] for p in (1, 0))
    rows = [(None, bad), (None, fine), (900001, bad), (900001, fine), (900002, None)]
    more = docs.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    kept = op07_noisy_channel.with_scores(more, labels, "_toxicity").filter("doc_id IS NULL OR doc_id > 900000")
    judged = sorted((str(r["doc_id"]), r["text"] == bad, r["_toxicity"] >= op07_noisy_channel.TOXIC_FROM) for r in kept.collect())
    assert judged == [("900001", False, False), ("900001", True, True), ("900002", False, False), ("None", False, False), ("None", True, True)]


def test_toxicity_of_awkward_rows(awkward, nothing, labels):
    assert op07_noisy_channel.toxicity(awkward, labels).filter("predicted = 0").count() == len(AWKWARD) + 1
    assert op07_noisy_channel.toxicity(nothing, labels.limit(0)).count() == 0


# 8. Quality


def base_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = collections.Counter(zip(words, words[1:], words[2:]))
    inside = set()
    for i, w in enumerate(zip(words, words[1:], words[2:])):
        if seen[w] > 1:
            inside |= {i, i + 1, i + 2}
    n = len(words)
    failed = n < 50 or 100 * len(inside) > 50 * n
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(inside), failed


def test_quality_counts_equal_brute_force(spark, awkward, labels):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = op08_quality_rules.quality_rules(docs, spark.read.parquet(f"{SF}/labels.parquet")).join(docs, "doc_id").collect()
    for r in found:
        assert tuple(r[c] for c in [*op08_quality_rules.COUNTS, "base_failed"]) == base_counts(r["text"])
        assert not (r["kept"] and r["base_failed"])
    odd = op08_quality_rules.quality_rules(awkward, labels).collect()
    assert sorted(r["n_words"] for r in odd) == sorted(base_counts(t)[0] for t in [*AWKWARD, "same"])
    assert op08_quality_rules.quality_rules(awkward.limit(0), labels.limit(0)).count() == 0


def test_verdicts_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    verdicts = by_id(op08_quality_rules.op8_quality_rules(spark, folder))
    labelled = [r for r in spark.read.parquet(f"{folder}/labels.parquet").collect() if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    right = sum(verdicts[r["doc_id"]]["kept"] == (r["quality"] == 1) for r in labelled)
    assert right >= 0.85 * len(labelled)


def test_forest_respects_constraints_and_learns():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 3))
    y = ((x[:, 0] + 0.3 * np.sin(9 * x[:, 0]) + (x[:, 1] > 0.6) * (x[:, 2] > 0.5)) > 0.8).astype(float)
    forest = boosting.fit(x, y, [1, 0, 0], trees=80)
    assert ((forest.score(x) > 0.5) == y).mean() > 0.95
    grid = np.repeat(rng.random((50, 3)), 40, axis=0)
    grid[:, 0] = np.tile(np.linspace(0, 1, 40), 50)
    assert (np.diff(forest.score(grid).reshape(50, 40), axis=1) >= -1e-12).all()
    one = boosting.fit(x[:5], np.ones(5), [0, 0, 0])
    assert len(one.roots) == 0 and 0.5 < one.score(x[:2])[0] < 1


# 9. Decontamination


def test_reparameterised_items_are_caught_and_scaffolds_are_not(spark):
    item = "so Alice bought 12 apples for 30 dollars and gave 12 to Bob who lives near the river in Paris today."
    other = item.replace("Alice", "Carol").replace("12", "77").replace("30", "5").replace("dollars", "euros").replace("Bob", "Dave").replace("Paris", "Rome")
    rng = random.Random(8)
    rows = [
        (1, f"{sentence(rng, 20)}. {item} {sentence(rng, 9)}"), (2, other), (3, other.replace("gave 77", "gave 78")),
        (4, sentence(rng, 60)), (5, None), (6, ""), (7, " ".join(item.split()[:8])), (8, "short item here"), (8, "short item here"),
    ]
    items = [(1, item), (2, None), (3, ""), (4, "short item here"), (5, item), (None, item), (6, "1 2 3 4 5 6 7 8 9 10")]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, canon int")
    found = op09_templates.contaminated(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"], r["exact"]) for r in found.collect()} == {(1, 1, True), (1, 5, True), (2, 1, False), (2, 5, False), (8, 4, True)}
    assert op09_templates.contaminated(docs, spark.createDataFrame([], "item_id long, text string")).count() == 0
    assert op09_templates.contaminated(docs.limit(0), spark.createDataFrame(items, "item_id long, text string")).count() == 0


def test_items_standing_in_documents_are_found(spark):
    folder = "/root/testdata/sf0.01"
    items = [r["text"] for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    held = {d["doc_id"] for d in docs if any(t in d["text"] for t in items)}
    found = {r["doc_id"] for r in op09_templates.op9_templates(spark, folder).filter("contaminated").collect()}
    assert held and held <= found and len(found - held) <= 0.2 * len(held) + 1


# 10. Jaccard join


def jaccard_by_brute_force(rows):
    sets = {}
    for d, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[d] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())
    head = {d: d for d in sets}

    def top(d):
        while head[d] != d:
            d = head[d]
        return d

    order = sorted(sets)
    for i, a in enumerate(order):
        for b in order[:i]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                head[y] = x
    return {d: (len(sets[d]), top(d)) for d in sets}


def test_edited_items_and_passages_are_found(spark):
    """Each benchmark item alone as a document: words put in, left out or changed anywhere, and its halves."""
    rng = random.Random(9)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").collect()]

    def inserted(words, n):
        for _ in range(n):
            words.insert(rng.randrange(1, len(words)), "inserted" + rng.choice("abcdefgh"))
        return words

    def changed(words, n):
        for i in rng.sample(range(len(words)), n):
            words[i] = "other" + rng.choice("abcdefgh")
        return words

    def dropped(words, n):
        for _ in range(n):
            del words[rng.randrange(len(words))]
        return words

    kinds = {"whole": lambda w: w, "first half": lambda w: w[: -(-len(w) // 2) + 1], "second half": lambda w: w[len(w) // 2 - 1 :]}
    kinds |= {f"{f.__name__} {n}": lambda w, f=f, n=n: f(w, n) for f in (inserted, changed, dropped) for n in (1, 2, 3)}
    kinds["mixed"] = lambda w: rng.sample(w, len(w))
    names = list(kinds)
    rows = [(k * 1000 + i, "so it said here , " + " ".join(kinds[name](text.split())) + " and so on .") for k, name in enumerate(names) for i, (_, text) in enumerate(items)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    found = collections.Counter()
    for r in op09_templates.contaminated(docs, spark.createDataFrame(items, "item_id long, text string")).select("doc_id", "item_id").distinct().collect():
        if items[r["doc_id"] % 1000][0] == r["item_id"]:
            found[names[r["doc_id"] // 1000]] += 1
    least = {"whole": 40, "inserted 1": 38, "inserted 2": 38, "inserted 3": 38, "changed 1": 38, "changed 2": 38, "dropped 1": 38, "dropped 2": 38, "first half": 30, "second half": 30}
    assert len(items) == 40 and all(found[k] >= n for k, n in least.items()) and found["mixed"] == 0, dict(found)


def test_slots_may_have_other_lengths_and_must_stay_the_same_value(spark):
    item = "the farmer Ann sold 12 apples at the market and then the farmer Ann bought 30 pears from her friend there"
    texts = {
        1: item,
        2: item.replace("Ann", "Mary Lou").replace("12", "7 kg").replace("30", "41"),
        3: item.replace("Ann", "Mary", 1),
        4: item.replace("12", "30"),
        5: "farmers sell apples and pears at any market , and friends buy them there",
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r["doc_id"]: r["exact"] for r in op09_templates.contaminated(docs, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()}
    assert found == {1: True, 2: False, 4: False}


def test_components_equal_brute_force(docs, texts):
    rows = [(3 * i + 1, t) for i, t in enumerate(texts)]
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in op10_signature_tree.jaccard_components(docs).collect()}
    assert found == jaccard_by_brute_force(rows)


def test_hot_groups_and_chains(spark, monkeypatch):
    """Many near copies, many documents around one passage, and small nodes, so that trees and blocks are used."""
    monkeypatch.setattr(op10_signature_tree, "NODE", 16)
    monkeypatch.setattr(op10_signature_tree, "PIVOT_ROWS", 10)
    rng = random.Random(9)
    origin, passage, drifting = sentence(rng, 80), sentence(rng, 40), sentence(rng, 60)
    rows = [near(rng, origin, rng.randint(1, 5)) for _ in range(70)] + [passage + " " + sentence(rng, rng.randint(8, 60)) for _ in range(60)]
    for _ in range(40):
        drifting = near(rng, drifting, 1)
        rows.append(drifting)
    rows = list(enumerate(rows))
    found = op10_signature_tree.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found.collect()} == jaccard_by_brute_force(rows)


def test_dual_traversal_loses_no_pair():
    rng = np.random.default_rng(3)
    base = [rng.integers(0, 2**63, 120, dtype=np.uint64) for _ in range(6)]
    sets = [np.unique(np.concatenate([base[i % 6][: 120 - k], rng.integers(0, 2**63, k, dtype=np.uint64)])) for i, k in enumerate(rng.integers(0, 40, 150))]
    bits = np.stack([op10_signature_tree.bitmap(s) for s in sets]).view(np.uint64)
    n, group = np.array([len(s) for s in sets]), rng.integers(0, 5, len(sets))
    both, halves = np.arange(150), (np.arange(70), np.arange(70, 150))
    for left, right in ((both, both), halves):
        found = {tuple(sorted(p)) for p in op10_signature_tree.leaf_pairs(bits, n, group, left, right)}
        for i in left:
            for j in right:
                common = len(np.intersect1d(sets[i], sets[j]))
                if i != j and group[i] != group[j] and 100 * common >= 75 * (n[i] + n[j] - common):
                    assert (min(i, j), max(i, j)) in found


def test_wide_bitmaps_lose_no_pair():
    rng = np.random.default_rng(4)
    base = [rng.integers(0, 2**63, k, dtype=np.uint64) for k in (200, 900, 2600)]
    sets = [np.unique(np.concatenate([b[: len(b) - k], rng.integers(0, 2**63, k, dtype=np.uint64)])) for b in base for k in (0, 5, 20, 60, 150)]
    sets += [rng.integers(0, 2**63, k, dtype=np.uint64) for k in (250, 950, 2600, 2700)]
    n, wide = np.array([len(s) for s in sets]), [op10_signature_tree.wide_bitmap(s) for s in sets]
    pairs = np.array([(i, j) for i in range(len(sets)) for j in range(i)])
    kept = {tuple(p) for p in op10_signature_tree.still_possible(pairs, n, wide).tolist()}
    for i, j in pairs.tolist():
        common = len(np.intersect1d(sets[i], sets[j]))
        if 100 * common >= 75 * (n[i] + n[j] - common):
            assert (i, j) in kept
    assert not {(16, 5), (17, 10), (18, 17)} & kept
    assert not op10_signature_tree.still_possible(np.empty((0, 2), np.int64), n, wide).size


def test_components_of_awkward_rows(awkward, nothing):
    expected = jaccard_by_brute_force(list(enumerate(AWKWARD)))
    rows = op10_signature_tree.jaccard_components(awkward).collect()
    assert len(rows) == len(AWKWARD) + 1
    assert all((r["n_shingles"], r["component_id"]) == expected[r["doc_id"]] for r in rows)
    assert op10_signature_tree.jaccard_components(nothing).count() == 0
