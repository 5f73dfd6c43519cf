"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns, one operator after the other."""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quayside.llm import (
    decontaminate, language_id, licenses, ngram_join, packing, quality, queries, sharding, substring_dedup, toxicity, url_filter,
)

LONG = " ".join(f"w{i * 7919 % 5003}" for i in range(60_000))


def rows(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


# ------------------------------------------------------------------------------------------------ 1 packing

def test_packing_cases(documents, empty):
    vocabulary = queries.vocabulary_path()
    df = documents((1, None), (2, ""), (2, ""), (3, "a b"), (3, "a b"), (None, "x"), (4, LONG))
    got = packing.pack_texts(df, vocabulary)
    pieces = [r for r in got.collect()]
    assert sorted(r["length"] for r in pieces if r["doc_id"] in (1, 2)) == [1, 1, 1]
    assert sum(r["doc_id"] == 3 for r in pieces) == 2 and sum(r["doc_id"] is None for r in pieces) == 1
    long = sorted((r["piece"], r["start"], r["length"]) for r in pieces if r["doc_id"] == 4)
    assert [p for p, _, _ in long] == list(range(len(long))) and all(s == 2048 * p for p, s, _ in long)
    assert all(n == 2048 for _, _, n in long[:-1])
    by_sequence: dict[int, list] = {}
    for r in pieces:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in by_sequence.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack_texts(empty, vocabulary).count() == 0


def test_word_tokens_equal_the_tokenizer():
    tokens = packing.WordTokens(queries.vocabulary_path())
    rng = random.Random(5)
    alphabet = "abzAZÀÉßÿµªº×÷0129 \t\n\r\x0b\x0c\x1c\x1f\x85\xa0\u2003'´`.,;<|>-_#é́İΣς😀中ا"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(3000)]
    texts += ["it's we'll I'D don't '", "<|endoftext|> a<|startoftext|>b", "e\u0301 E\u0301", "ΑΣ ΑΣ. Σ", "ﬁ Ⅳ ² ½", "a\x1cb", "a\u2028b"]
    whole = tokens.tokenizer.encode_batch(texts, add_special_tokens=False)
    for text, ids, known in zip(texts, tokens.texts(texts), whole, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == known.ids, repr(text)


@pytest.mark.parametrize("seed", range(8))
def test_plans_use_every_piece_once(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 10, 64, 2048])
    counts = {n: rng.choice([1, 2, 5, 1000]) for n in rng.sample(range(1, capacity + 1), min(capacity, rng.choice([1, 3, 40])))}
    plan = packing.plan_packing(counts, capacity)
    used: dict[int, int] = {}
    for pattern, times in plan:
        assert sum(pattern) <= capacity and times > 0
        for n in pattern:
            used[n] = used.get(n, 0) + times
    assert used == counts


def test_exact_complements_are_found():
    assert sum(t for _, t in packing.plan_packing({6: 3, 4: 3}, 10)) == 3
    assert sum(t for _, t in packing.plan_packing({5: 2, 3: 2, 2: 2}, 10)) == 2
    assert sum(t for _, t in packing.plan_packing({7: 4, 1: 12}, 10)) == 4


# ------------------------------------------------------------------------------------------------ 2 URLs

URLS = [
    None, "", "no scheme", "http://", "http://Example.ORG/es/1", "http://m.example.org/en/12", "http://example.org/en/2", "http://example.org",
    "http://notexample.org/es/", "http://x.com/a.example.org/es/", "https://a.com/fr/1?x=/de/", "https://a.com#/fr/", "https://a.com/de/",
    "://org/", "x://y://com/de/", "http://free-bets.net/a", "http://a.net/login", "http://ÄB.org/é", "http://com/fr/", "http://a.org:80/", "http://x/\x00",
    "http://" + "a" * 5000 + ".org/" + "b" * 20_000,
]


def fits(rule, host, path):
    return (host == rule.host or host.endswith("." + rule.host)) and path.startswith(rule.path)


def test_urls_equal_a_loop(spark):
    df = spark.createDataFrame([(i, u, "own") for i, u in enumerate(URLS + URLS[:5])], "page_id long, url string, rule string")
    got = {r["page_id"]: r for r in url_filter.filter_urls(df, queries.URL_RULES, queries.URL_GLOBS).collect()}
    assert len(got) == len(URLS) + 5
    for i, url in enumerate(URLS + URLS[:5]):
        m = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.S)
        host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
        found = sorted((r for r in queries.URL_RULES if fits(r, host, path)), key=lambda r: -len(r.label))
        assert (got[i]["host"], got[i]["path"]) == (host, path)
        assert got[i]["rule"] == (found[0].label if found else None)
        if found:
            assert got[i]["verdict"] == found[0].verdict
    assert got[URLS.index("http://free-bets.net/a")]["verdict"] == "block"
    assert url_filter.filter_urls(df.limit(0), queries.URL_RULES).count() == 0


def test_many_globs_across_words(spark):
    rules = [url_filter.Rule(f"*h{i}*", f"*/p{i}*q", "block", glob=True) for i in range(80)]
    machine = url_filter.Automaton(rules)
    assert machine.words > 4
    df = spark.createDataFrame([(0, "http://xh7y/a/p7/b/qq"), (1, "http://xh7y/a/p8/q"), (2, "http://h79/p79q")], "page_id long, url string")
    assert rows(url_filter.filter_urls(df, [], rules), "page_id", "verdict") == [(0, "block"), (1, "allow"), (2, "block")]


# ------------------------------------------------------------------------------------------------ 3 n-gram join

def test_join_cases(spark, documents, empty):
    base = [f"t{i}" for i in range(60)]
    near, far = [*base[:-2], "x"], [*base[:30], *(f"u{i}" for i in range(30))]
    df = documents(
        (10, " ".join(base)), (4, " ".join(near)), (5, " ".join(far)), (6, None), (7, ""), (8, "one two"), (9, "ONE  two"),
        (10, " ".join(base)), (None, " ".join(base)), (11, "one"), (12, LONG), (13, LONG.upper()),
    )
    got = rows(ngram_join.near_groups(df), "doc_id", "n_shingles", "component_id")
    assert got == sorted([
        (10, 56, 4), (10, 56, 4), (4, 55, 4), (5, 56, 5), (6, 0, 6), (7, 0, 7), (8, 1, 8), (9, 1, 8), (None, 56, None), (11, 1, 11),
        (12, 5003, 12), (13, 5003, 12),
    ], key=repr)
    assert ngram_join.near_groups(empty).count() == 0
    kept = ngram_join.keep_representatives(df)
    assert kept.columns == df.columns and rows(kept, "doc_id") == sorted([(4,), (5,), (6,), (7,), (8,), (None,), (11,), (12,)], key=repr)


def brute_components(texts, width=5, percent=80):
    sets = {}
    for i, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda c: c[0].lower(), t or ""))
        sets[i] = {tuple(w[j:j + width]) for j in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} - {()}
    label = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * len(sets[a] | sets[b]):
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = {k: new if v == old else v for k, v in label.items()}
    return {i: (len(sets[i]), label[i]) for i in sets}


@pytest.mark.parametrize("shingles", [1_500_000, 900])
def test_join_equals_all_pairs(spark, documents, monkeypatch, shingles):
    """Chains of near copies around the threshold, shared passages; also with cells so small that they are dealt to a grid."""
    monkeypatch.setattr(ngram_join, "CELL_SHINGLES", shingles)
    rng = random.Random(3)
    texts = {}
    passage = [f"p{i}" for i in range(25)]
    for family in range(6):
        words = [f"f{family}w{i}" for i in range(rng.choice([8, 40, 90]))]
        for _ in range(14):
            own = list(words)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
            if rng.random() < 0.3:
                own += passage
            texts[len(texts)] = " ".join(own)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.near_groups(documents(*texts.items())).collect()}
    assert got == brute_components(texts)


def test_tree_links_equal_all_pairs():
    rng = np.random.default_rng(1)
    for _ in range(20):
        pool = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
        sets = [np.unique(rng.choice(pool[:rng.integers(3, 60)], rng.integers(1, 50))) for _ in range(rng.integers(1, 120))]
        label = list(range(len(sets)))
        for a in range(len(sets)):
            for b in range(a):
                both = len(np.intersect1d(sets[a], sets[b]))
                if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                    old, new = max(label[a], label[b]), min(label[a], label[b])
                    label = [new if v == old else v for v in label]
        assert ngram_join.linked(sets).tolist() == label


# ------------------------------------------------------------------------------------------------ 4 decontamination

def items(spark, *pairs):
    return spark.createDataFrame([(i, t, "own") for i, t in pairs], "item_id long, text string, spans string")


def test_leak_cases(spark, documents, empty):
    ten = " ".join(f"q{i}" for i in range(12))
    bench = items(spark, (1, ten), (1, ten), (20, "Short item"), (3, None), (4, "..."), (None, "lone"), (5, "é x"))
    df = documents(
        (1, f"a {ten.upper()}! b"), (2, None), (3, ""), (4, "short, ITEM short"), (4, "short, ITEM short"), (5, "É x é x"), (6, LONG),
        (7, " ".join(ten.split()[:9])), (8, "lone"),
    )
    for words in (200_000, 4):
        found = decontaminate.leak_digest(decontaminate.find_leaks(df, bench, keep=["doc_id"], automaton_words=words))
        got = rows(found, "doc_id", "n_words", "n_hit", "n_items")
        assert got == sorted([(1, 14, 12, 1), (2, 0, 0, 0), (3, 0, 0, 0), (4, 3, 2, 1), (4, 3, 2, 1), (5, 4, 2, 1), (6, 60_000, 0, 0), (7, 9, 0, 0), (8, 1, 1, 1)], key=repr)
    assert decontaminate.find_leaks(empty, bench).count() == 0
    assert rows(decontaminate.leak_digest(decontaminate.find_leaks(df, bench.limit(0), keep=["doc_id"])), "contaminated") == [(False,)] * 9
    clean = decontaminate.decontaminate(df, bench)
    assert clean.columns == df.columns
    assert dict(rows(clean, "doc_id", "text")) == {2: None, 3: "", 5: "É x ", 6: LONG, 7: " ".join(ten.split()[:9])}
    with pytest.raises(ValueError, match="spans"):
        decontaminate.find_leaks(df, bench)


def test_leaks_equal_windows(spark, documents):
    """Small alphabets, so that windows overlap, repeat and end in one another; several automata give the same."""
    rng = random.Random(9)
    bench = {i: " ".join(rng.choice("abc") for _ in range(rng.choice([1, 3, 4, 5, 9, 30]))) for i in range(12)}
    texts = {i: " ".join(rng.choice("abcd") for _ in range(rng.randrange(80))) for i in range(60)}
    windows = {}
    for i, t in bench.items():
        w = t.split()
        for s in range(max(1, len(w) - 4)):
            windows.setdefault(tuple(w[s:s + 5]), set()).add(str(i))
    expected = {}
    for i, t in texts.items():
        w, hit, found = t.split(), set(), set()
        for s in range(len(w)):
            for n in range(1, 6):
                if s + n <= len(w) and tuple(w[s:s + n]) in windows:
                    found |= windows[tuple(w[s:s + n])]
                    hit.update(range(s, s + n))
        expected[i] = (len(hit), sorted(found))
    for words in (200_000, 10):
        got = decontaminate.find_leaks(documents(*texts.items()), items(spark, *bench.items()), window=5, keep=["doc_id"], automaton_words=words)
        assert {r["doc_id"]: (sum(r["spans"][1::2]) - sum(r["spans"][::2]), r["items"]) for r in got.collect()} == expected


# ------------------------------------------------------------------------------------------------ 5 toxicity

def test_toxicity_cases(spark, empty):
    rng = random.Random(2)
    plain = ["river", "stone", "garden", "window", "market", "yellow", "summer", "letter", "moment", "paper"]
    texts, labels = [], []
    for i in range(400):
        words = [rng.choice(plain) for _ in range(30)]
        bad = i % 4 == 0
        if bad:
            words[rng.randrange(30)] = rng.choice(["grumplock", "snarkhole"])
            words[rng.randrange(30)] = "grumplock"
        texts.append((i, ". ".join(" ".join(words[a:a + 6]) for a in range(0, 30, 6)), "own"))
        labels.append((i, int(bad)))
    labels += [(None, 1), (3, None), (9999, 1)]
    df = spark.createDataFrame([*texts, (1000, None, ""), (1001, "", ""), (1002, "river " * 50_000, ""), (1002, "river", "")], "doc_id long, text string, score string")
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.learn(df, table, ~toxicity.held_out())
    got = toxicity.score_toxicity(df.drop("score"), model)
    truth = dict(labels)
    held = [r for r in got.collect() if r["doc_id"] < 400 and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert held and np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.95
    assert got.where("doc_id >= 1000").where("predicted = 1 OR score NOT BETWEEN 0 AND 1").count() == 0
    disguised = spark.createDataFrame(
        [(1, "river stone gru*mplock. market snark.hole garden"), (2, "river g r u m p l o c k snarkhole"), (3, "river stone market")], "doc_id long, text string")
    assert [r["score"] >= 0.5 for r in toxicity.score_toxicity(disguised, model).orderBy("doc_id").collect()] == [True, True, False]
    none = toxicity.learn(empty, table, ~toxicity.held_out())
    assert toxicity.score_toxicity(empty, none).count() == 0
    assert toxicity.score_toxicity(df.drop("score"), none).where("score BETWEEN 0 AND 1").count() == df.count()


@pytest.mark.parametrize("mark", ["|", "/", "\\", ";", ":", ",", "(", "]", "{", '"', "“", "*", ".", "-", "_", "||", "/.", "(("])
def test_inserted_characters_hide_nothing(mark):
    """A word with marks put in is held to the machine as one word, in whichever places they are."""
    def whole(text):
        return {re.sub(r"[\W_]+", "", w) for u in toxicity.units(text) for w in toxicity.words_of(u)}

    for text in (f"you st{mark}up{mark}id.", f"you {mark.join('stupid')}, no", f"a ({mark.join('stupid')})", f"oh {f' {mark} '.join('stupid')} oh", f"stup{mark}id"):
        assert "stupid" in whole(text), text
    codes = {int(c) for _, triple, _ in toxicity.subsequences(["stupid"]) for c in triple.ravel() if c}
    table = np.zeros(toxicity.ALPHABET**3, dtype=np.float32)
    table[sorted(codes)] = 1
    scorer = toxicity.Scorer(table, -1.0)
    top = scorer.summaries([f"you st{mark}up{mark}id.", "garden window"])[:, 0]
    assert top[0] > 0 > top[1]


def test_widely_spaced_letters_count():
    """Every subsequence is summed, over whatever stretch: of a word with three characters between letters nothing else is left."""
    inner = {(c // toxicity.ALPHABET**2, c // toxicity.ALPHABET % toxicity.ALPHABET, c % toxicity.ALPHABET)
             for _, triple, _ in toxicity.subsequences(["t***r***a***s"]) for c in triple.ravel().tolist() if c}
    assert {tuple(ord(x) - 96 for x in part) for part in ("tra", "ras", "trs", "tas")} <= inner


def test_spelled_words_in_linear_time():
    for text in ("a, b, c, d, " * 100_000, "a " + "1 " * 400_000 + "bb", "a. " * 300_000 + "end", "it's a-b"):
        assert len(toxicity.units(text)) >= 2
    assert toxicity.units("it's a b")[-1] == "b"


def test_the_score_is_the_landmarks_kernel():
    """The table of subsequence weights gives the same margins as the kernels to the landmarks would."""
    words = ["trash", "trashy", "garden", "hardly", "warden"]

    def kernel(a, b):
        out = [dict(), dict()]
        for side, w in zip(out, (a, b), strict=True):
            for _, triple, decay in toxicity.subsequences([w]):
                for c, d in zip(triple[0].tolist(), decay[0].tolist(), strict=True):
                    side[c] = side.get(c, 0) + d * (c > 0)
        return sum(v * out[1].get(c, 0) for c, v in out[0].items())

    assert kernel("trash", "tr*ash") > kernel("trash", "garden") and kernel("trash", "trash") > 0.9
    scorer = toxicity.Scorer(np.zeros(toxicity.ALPHABET**3), 0.5)
    assert scorer.margins(["xy", "trash"]).tolist() == [0.5, 0.5]
    codes = np.unique(np.concatenate([t.ravel() for _, t, _ in toxicity.subsequences(words)]))
    weights = toxicity._weights(words, codes)
    weights[:, codes == 0] = 0
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            assert weights[i] @ weights[j] == pytest.approx(kernel(a, b), rel=1e-4)


# ------------------------------------------------------------------------------------------------ 6 sharding

def test_placement(spark, documents, empty):
    names = [f"s{i}" for i in range(7)]
    table = sharding.fill_table(names, 101)
    assert len(table) == 101 and max(map(table.count, range(7))) - min(map(table.count, range(7))) <= 1
    fewer = sharding.fill_table(names[:-1], 101)
    assert sum(a != b for a, b in zip(table, fewer, strict=True)) < 101 // 2
    import hashlib

    def slot(key):
        return int(hashlib.md5(("" if key is None else str(key)).encode()).hexdigest()[:15], 16) % 101

    df = documents((1, "a"), (1, None), (None, ""), (2**62, LONG))
    got = rows(sharding.place(df, names, size=101), "doc_id", "slot", "shard")
    assert got == sorted([(k, slot(k), table[slot(k)]) for k in (1, 1, None, 2**62)], key=repr)
    assert sharding.place(empty, names, size=101).count() == 0
    for bad in (lambda: sharding.fill_table(names, 100), lambda: sharding.fill_table([], 101), lambda: sharding.fill_table(["a", "a"], 101)):
        with pytest.raises(ValueError):
            bad()


def test_written_shards_hold_every_row(spark, documents, tmp_path):
    df = documents(*((i, f"t{i}") for i in range(50)))
    sharding.write_shards(df, str(tmp_path / "s"), ["a", "b", "c"], size=11)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert rows(back, *df.columns) == rows(df, *df.columns)


# ------------------------------------------------------------------------------------------------ 7 licences

def test_license_cases(documents, empty):
    mit = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
           "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
           "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
           "subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or "
           "substantial portions of the Software.")
    df = documents(
        (1, None), (2, ""), (3, "Some text.\nLicensed under the Apache License, Version 2.0.\nMore"), (4, mit), (5, LONG),
        (6, "Released under the MIT License. All rights reserved."), (6, "Released under the MIT License. All rights reserved."),
        (7, "LICENSED under CC BY-NC 4.0!"), (8, "not licensed under the mit license"),
    )
    got = rows(licenses.scan_licenses(df), "doc_id", "n_sentences", "license")
    assert got == sorted([
        (1, 0, None), (2, 0, None), (3, 1, "Apache-2.0"), (4, 2, "MIT"), (5, 0, None), (6, 2, "MIT"), (6, 2, "MIT"), (7, 1, "CC-BY-NC-4.0"),
        (8, 0, None),
    ], key=repr)
    assert licenses.scan_licenses(empty).count() == 0


def test_rules_want_their_order(documents):
    rules, known = [("X", ["a", "b"]), ("Y", ["b"])], {"first one": "a", "second": "b", "other": "c"}
    df = documents((1, "First one. Other. Second."), (2, "Second. First one."), (3, "Second"), (4, "First one"))
    assert rows(licenses.scan_licenses(df, known, rules), "doc_id", "license") == [(1, "X"), (2, "Y"), (3, "Y"), (4, None)]


MIT_WRAPPED = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software."""
GPL_WRAPPED = """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""
BSD_WRAPPED = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice.
3. Neither the name of the copyright holder nor the names of its contributors
   may be used to endorse or promote products derived from this software
   without specific prior written permission."""
APACHE_WRAPPED = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0
"""
MPL_WRAPPED = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""


@pytest.mark.parametrize("mark", ["", " * ", "# ", "// ", "    "])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_wrapped_notices(documents, mark, end):
    gpl3 = GPL_WRAPPED.replace("software;", "software:").replace("Foundation;", "Foundation,").replace("version 2", "version 3")
    texts = [MIT_WRAPPED, GPL_WRAPPED, gpl3, BSD_WRAPPED, APACHE_WRAPPED, MPL_WRAPPED]
    texts += [GPL_WRAPPED.replace("\n", " "), "You may not sell\nit. Permission is hereby granted, free\nof charge. To any person.", "All\nrights.\nReserved"]
    df = documents(*((i, "".join(mark + line + end for line in f"Copyright 2020 A. Uthor\n\n{t}\n\nint x;".split("\n"))) for i, t in enumerate(texts)))
    assert rows(licenses.scan_licenses(df), "doc_id", "license", "sentence_ids") == [
        (0, "MIT", "mit-grant,mit-notice-kept"), (1, "GPL-2.0-or-later", "gpl2-later,gpl-no-warranty"),
        (2, "GPL-3.0-or-later", "gpl3-later,gpl-no-warranty"), (3, "BSD-3-Clause", "bsd-grant,bsd-no-endorsement"),
        (4, "Apache-2.0", "apache2-notice,apache2-compliance,apache2-copy"), (5, "MPL-2.0", "mpl2-notice"),
        (6, "GPL-2.0-or-later", "gpl2-later,gpl-no-warranty"), (7, None, ""), (8, None, ""),
    ]


def test_long_runs_of_marks(documents):
    df = documents((1, "all" + ".\n" * 300_000 + "rights reserved"), (2, "all " + "*\n" * 300_000 + "rights reserved"), (3, ";\n" * 300_000 + "All rights reserved;;;"))
    assert rows(licenses.scan_licenses(df), "doc_id", "n_sentences") == [(1, 0), (2, 1), (3, 1)]


# ------------------------------------------------------------------------------------------------ 8 substring dedup

def brute_repeats(texts, width):
    first, out = {}, {}
    for i in sorted(texts):
        w = (texts[i] or "").split()
        for s in range(len(w) - width + 1):
            first.setdefault(tuple(w[s:s + width]), i)
    for i in texts:
        w = (texts[i] or "").split()
        gone = set()
        for s in range(len(w) - width + 1):
            if first[tuple(w[s:s + width])] < i:
                gone.update(range(s, s + width))
        out[i] = [x for k, x in enumerate(w) if k not in gone]
    return out


def test_repeat_cases(documents, empty):
    import hashlib

    p = " ".join(f"p{i}" for i in range(50))
    df = documents((1, p), (2, f"a {p}\n b"), (2, f"a {p}\n b"), (3, p.rsplit(" ", 1)[0]), (4, None), (5, ""), (None, p), (6, LONG), (7, f"{LONG} z"), (8, p.upper()))

    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    got = rows(substring_dedup.digest_repeats(df), "doc_id", "n_words", "n_removed", "kept_sha256")
    again = LONG.split()
    expected = [
        (1, 50, 0, sha(p)), (2, 52, 50, sha("a b")), (2, 52, 50, sha("a b")), (3, 49, 0, sha(p.rsplit(" ", 1)[0])), (4, 0, 0, sha("")), (5, 0, 0, sha("")),
        (None, 50, 0, sha(p)), (6, len(again), 0, sha(LONG)), (7, len(again) + 1, len(again), sha("z")), (8, 50, 0, sha(p.upper())),
    ]
    assert got == sorted(expected, key=repr)
    assert substring_dedup.digest_repeats(empty).count() == 0
    kept = substring_dedup.remove_repeats(df)
    assert kept.columns == df.columns and kept.count() == df.count()
    assert dict(rows(kept.where("doc_id IN (2, 4, 7)"), "doc_id", "text")) == {2: "a b", 4: None, 7: "z"}
    assert substring_dedup.remove_repeats(documents((1, p), (2, p))).count() == 1


@pytest.mark.parametrize("shard, stream", [(20_000, 200_000), (40, 60)])
def test_repeats_equal_windows(documents, monkeypatch, shard, stream):
    """Passages cut, joined and overlapping at random; also with shards and streams so small that there are many."""
    monkeypatch.setattr(substring_dedup, "SHARD_WORDS", shard)
    monkeypatch.setattr(substring_dedup, "STREAM_WINDOWS", stream)
    rng = random.Random(11)
    passages = [[f"k{n}x{i}" for i in range(40)] for n in range(6)] + [["same"] * 60]
    texts = {}
    for i in range(70):
        words = []
        for _ in range(rng.randrange(5)):
            p = rng.choice(passages)
            a = rng.randrange(10)
            words += p[a:a + rng.randrange(5, 40)] + [f"own{rng.randrange(40)}" for _ in range(rng.randrange(3))]
        texts[i] = " ".join(words)
    got = substring_dedup.remove_repeats(documents(*texts.items()), width=15)
    expected = {i: " ".join(w) for i, w in brute_repeats(texts, 15).items() if w or not texts[i]}
    assert {r["doc_id"]: " ".join((r["text"] or "").split()) for r in got.collect()} == expected


# ------------------------------------------------------------------------------------------------ 9 language

def test_language_cases(spark, empty):
    words = {"en": "the house and garden with many things", "de": "das haus und der garten mit vielen dingen",
             "fr": "la maison et le jardin avec des choses", "es": "la casa y el jardín con muchas cosas"}
    rng = random.Random(4)
    data = [(i, " ".join(rng.choice(words[lang].split()) for _ in range(25)), lang) for i in range(200) for lang in [list(words)[i % 4]]]
    data += [(1000, None, "en"), (1001, "", "de"), (1002, "123 !? 456", None), (1003, "the house " * 40_000, None), (1003, "ß", None), (None, "das haus und der", None)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string")
    model = language_id.learn(df, language_id.id_remainder("doc_id", 4) != 2)
    got = {(r["doc_id"], r["text"] or ""): r for r in language_id.identify(df, model).collect()}
    assert len(got) == len(data)
    assert np.mean([got[i, t]["lang_pred"] == lang for i, t, lang in data[:200]]) > 0.98
    assert [got[k]["lang_pred"] for k in ((1000, ""), (1001, ""), (1002, "123 !? 456"))] == ["und"] * 3
    assert got[1003, "the house " * 40_000]["lang_pred"] == "en" and got[None, "das haus und der"]["lang_pred"] == "de"
    assert all(0 <= r["score"] <= 1 for r in got.values())
    nothing = language_id.learn(empty, F.lit(True))
    assert {r["lang_pred"] for r in language_id.identify(df, nothing).collect()} == {"und"}
    assert language_id.identify(empty, model).count() == 0


# ------------------------------------------------------------------------------------------------ 10 quality

def test_quality_cases(documents, empty):
    rng = random.Random(6)
    words = [f"{a}{b}{c}" for a in "bdfg" for b in "aeiou" for c in ["n", "r", "st"]]
    good = [(i, " ".join(rng.choice(words) for _ in range(80)) + ".") for i in range(40)]
    odd = " ".join(f"#{i}$$ %{i}%" for i in range(40))
    df = documents(*good, (100, None), (101, ""), (102, "a b c " * 40), (103, odd), (104, "x\nx\n\nx y\n \n"), (104, "x\nx\n\nx y\n \n"), (105, " ".join(rng.choice(words) for _ in range(8_000))))
    got = quality.judge_quality(df.drop("score"))
    by = {r["doc_id"]: r for r in got.collect()}
    assert all(by[i]["kept"] for i, _ in good) and by[105]["kept"]
    assert [by[i]["base_failed"] for i in (100, 101, 102, 103, 104)] == [True, True, True, False, True] and not by[103]["kept"]
    assert (by[102]["n_words"], by[102]["n_repeat_words"]) == (120, 120)
    assert (by[104]["n_words"], by[104]["word_chars"], by[104]["n_dup_lines"], by[104]["n_repeat_words"]) == (4, 4, 1, 0)
    assert by[103]["n_symbols"] == sum(c in "#*$%&|<>" for c in odd)
    assert quality.judge_quality(empty).count() == 0
    bare = quality.judge_quality(df.drop("score").withColumn("lang", F.lit(None).cast("string")))
    assert bare.where("kept").count() == 42


def test_long_texts_without_common_words(spark):
    """Whatever a long text's letters look like, words that no language has in common use are a large distance."""
    rng = random.Random(7)
    common = ["the", "of", "and", "to", "in", "that", "was", "his", "with", "for"]

    def rare():
        return "".join(rng.choice("etaoinshrdlu") for _ in range(7))

    def text(n, share):
        return " ".join(rng.choice(common) if rng.random() < share else rare() for _ in range(n)) + "."

    good = [(i, text(rng.randrange(50, 400), 0.4), "en") for i in range(60)]
    bad = [
        (100, " ".join(rare() for _ in range(100_000)), None), (101, " ".join(rare() for _ in range(60)), None),
        (102, " ".join([*(rare() for _ in range(2_000)), *common * 4]), None), (103, " ".join(f"{rare()}&{rare()}" for _ in range(400)), None),
    ]
    short = [(200, " ".join(rare() for _ in range(49)), None)]
    other = [(300, "".join(chr(0x4E00 + rng.randrange(3000)) + " " * (k % 9 == 8) for k in range(6000)), "zh")]
    df = spark.createDataFrame([*good, *bad, *short, *other], "doc_id long, text string, lang string")
    by = {r["doc_id"]: r for r in quality.judge_quality(df).collect()}
    assert all(by[i]["kept"] for i, _, _ in good) and by[300]["kept"]
    assert all(not by[i]["base_failed"] and by[i]["class_distance"] <= 0.25 and by[i]["word_distance"] > 0.75 and not by[i]["kept"] for i, _, _ in bad)
    assert by[100]["word_distance"] > 0.9 and by[200]["base_failed"]
    lenient = quality.judge_quality(df, limits=quality.Limits(least_words=100)).where("doc_id IN (100, 101)")
    assert rows(lenient, "doc_id", "kept") == [(100, False), (101, True)]


def test_distance():
    p, q = np.array([1.0, 0]), np.array([[1.0, 0], [0, 1.0], [0.5, 0.5]])
    assert quality.distance(p, q).tolist() == pytest.approx([0, 1, 0.5579230452841438])


# ------------------------------------------------------------------------------------------------ pipeline

def test_stages_keep_columns_and_stand_empty_tables(spark, sf_dir, empty):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "ngram_join", "substring_dedup", "decontamination", "packing"]
    odd = empty.withColumn("spans", F.lit(1)).withColumn("score", F.lit("x"))
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, odd, sf_dir)
        assert got.count() == 0
        if name != "packing":
            assert got.columns == odd.columns
