"""Words made to share weak fingerprints, results named like the table's columns, sums without a length limit."""

from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quayside.llm import language_id, ngram_join, packing, quality, queries, substring_dedup, toxicity
from quayside.llm.common import Words, run_prints


def thue_morse(size, swap=False):
    """A word of two letters and its complement have the same sum of letters times powers of any odd number modulo 2**64."""
    return "".join("ab"[(i.bit_count() + swap) % 2] for i in range(size))


PAIRS = [(thue_morse(n), thue_morse(n, True)) for n in (1024, 2048, 4096)]


def test_word_prints():
    rng = random.Random(1)
    letters = "ab\x00é"
    words = list({"".join(rng.choice(letters) for _ in range(rng.randrange(1, 200))) for _ in range(3000)} | {w for pair in PAIRS for w in pair})
    words = list(dict.fromkeys([*words, *(f"{a}{b}" for a, b in combinations("abcdefghijklmnop", 2))]))
    got = Words(pa.array([" ".join(words)]), lower=False)
    assert len(got.hash) == len(words) == len(set(got.hash.tolist()))
    assert [got.data[a:b].tobytes().decode() for a, b in zip(got.start, got.end, strict=True)] == words
    again = Words(pa.array(["x " + words[5], None, "", "ABab\tabAB"]), lower=True)
    assert again.counts.tolist() == [2, 0, 0, 2] and again.hash[2] == again.hash[3]


def test_run_prints():
    """Patterns of two words over many places; every width says the same wherever the run stands."""
    a, b = np.random.default_rng(3).integers(0, 1 << 63, 2, dtype=np.uint64)
    runs = {tuple("ab"[i.bit_count() % 2] for i in range(n)): 0 for n in (64, 1024)}
    for run in runs:
        straight = np.array([a if c == "a" else b for c in run])
        assert run_prints(straight, len(run))[0] != run_prints(straight[::-1], len(run) - 1)[0]
        swapped = np.array([b if c == "a" else a for c in run])
        assert run_prints(straight, len(run))[0] != run_prints(swapped, len(run))[0]
    values = np.random.default_rng(4).integers(0, 1 << 63, 300, dtype=np.uint64)
    for width in (1, 2, 3, 5, 10, 50, 63, 64):
        whole = run_prints(values, width)
        assert len(whole) == 301 - width
        assert all(whole[i] == run_prints(values[i:i + width], width)[0] for i in (0, 7, 300 - width))
        assert not set(whole.tolist()) & set(run_prints(values, width, 9).tolist())
    assert len(run_prints(values[:3], 5)) == 0


@pytest.mark.parametrize("pair", PAIRS)
def test_ids_of_colliding_words(documents, pair):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.vocabulary_path())
    texts = [pair[0], pair[1], f"see {pair[1]} and {pair[0]}"]
    known = packing.WordTokens(queries.vocabulary_path())
    for _ in range(2):
        for text in texts:
            assert np.frombuffer(known.texts([text])[0], dtype="<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_words_that_share_a_fingerprint(monkeypatch):
    """With fingerprints of two bits nearly all words collide, in a slice and with what is known; ids are right all the same."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.vocabulary_path())

    class Weak(Words):
        def __init__(self, column, lower):
            super().__init__(column, lower)
            self.hash = self.hash & np.uint64(3) | (self.end - self.start).astype(np.uint64) << np.uint64(8)

    monkeypatch.setattr(packing, "Words", Weak)
    known = packing.WordTokens(queries.vocabulary_path())
    rng = random.Random(5)
    for size in (1, 1, 1, 40, 1):
        text = " ".join("".join(rng.choice("abcdé&") for _ in range(rng.randrange(9, 30))) for _ in range(size))
        assert np.frombuffer(known.texts([text])[0], dtype="<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("pair", PAIRS)
def test_sets_of_colliding_words(documents, pair):
    df = documents((1, f"a b c d {pair[0]}"), (2, f"a b c d {pair[1]}"), (3, f"A B C D {pair[1]}"), (4, pair[0]), (5, pair[1]))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.near_groups(df).collect()}
    assert got == {1: (1, 1), 2: (1, 2), 3: (1, 2), 4: (1, 4), 5: (1, 5)}


@pytest.mark.parametrize("pair", PAIRS)
def test_windows_of_colliding_words(documents, pair):
    words = [f"w{i}" for i in range(49)]
    one, two = " ".join([*words, pair[0]]), " ".join([*words, pair[1]])
    got = {r["doc_id"]: r["n_removed"] for r in substring_dedup.digest_repeats(documents((1, one), (2, two), (3, two))).collect()}
    assert got == {1: 0, 2: 0, 3: 50}


# --- results named like columns --------------------------------------------------------------------------------------

def test_clashing_names(spark):
    rng = random.Random(6)
    data = [(i, " ".join(rng.choice(["the", "house", "and", "garden", "of", "das", "haus"]) for _ in range(60)), "en", "own") for i in range(20)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, score string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, toxic int")
    scored = toxicity.score_toxicity(df, toxicity.learn(df, labels, F.lit(True)))
    assert scored.columns == [*df.columns, "_score", "predicted"] and scored.where("score = 'own' AND _score BETWEEN 0 AND 1").count() == 20
    twice = toxicity.score_toxicity(scored, toxicity.learn(df, labels, F.lit(True)))
    assert twice.columns == [*scored.columns, "__score", "_predicted"]
    judged = quality.judge_quality(df.withColumn("kept", F.lit("own")).withColumn("N_WORDS", F.lit(1)))
    assert len({c.lower() for c in judged.columns}) == len(judged.columns) and judged.where("kept = 'own' AND _kept IS NOT NULL").count() == 20
    named = df.withColumn("lang_pred", F.lit("own"))
    told = language_id.identify(named, language_id.learn(df, F.lit(True)))
    assert told.columns == [*named.columns, "_lang_pred", "_score"] and told.count() == 20
    pieces = packing.cut_pieces(df.withColumn("length", F.lit("own")).withColumn("piece", F.lit(3)), queries.vocabulary_path())
    assert pieces.columns == [*df.columns, "length", "piece", "_piece", "start", "_length", "ids_crc32"]
    assert pieces.where("length = 'own' AND piece = 3 AND _piece = 0 AND _length > 60").count() == 20
    tokens = packing.tokenize(df.withColumn("ids", F.lit(b"")), queries.vocabulary_path())
    assert tokens.columns[-2:] == ["ids", "_ids"] and tokens.count() == 20


# --- sums over long words --------------------------------------------------------------------------------------------

def test_recursion_equals_listing():
    rng = np.random.default_rng(8)
    table = rng.normal(size=toxicity.ALPHABET**3).astype(np.float32)
    scorer = toxicity.Scorer(table, 0.25)
    words = ["stupid", "st*up.id", "sxxxxtxxxxuxxxxpxxxxixxxxd", "***", "a-b", "x" * 40, "é1o0" * 9, "s......t......u......p......i......d"]
    listed = scorer.margins(words)
    for word, margin in zip(words, listed, strict=True):
        total = toxicity.recursive_sum(toxicity.letter_codes([word])[0], scorer.by_last)
        assert total + 0.25 == pytest.approx(margin, rel=1e-4, abs=1e-4)


def test_long_words_have_all_subsequences():
    """Letters far apart in a word of any length weigh what their distance says."""
    def code(text):
        a, b, c = (ord(x) - 96 for x in text)
        return (a * toxicity.ALPHABET + b) * toxicity.ALPHABET + c

    table = np.zeros(toxicity.ALPHABET**3, dtype=np.float32)
    table[code("stu")] = 1
    scorer = toxicity.Scorer(table, 0.0)
    for gap in (5, 13, 30, 60):
        stars = "*" * gap
        spread, without = scorer.margins([f"s{stars}t{stars}u", f"s{stars}t{stars}v"])
        assert spread > 0 and without == 0
    long_word = "z" * 500 + "stu" + "z" * 500
    assert scorer.margins([long_word])[0] > 0
    assert any("stu" in w and len(w) == toxicity.PART for w in toxicity.words_of(long_word)) and long_word in toxicity.words_of(long_word)
    assert np.isfinite(scorer.margins(["q" + "*" * 5000 + "r" + "*" * 5000 + "s", "", "a" * 3000])).all()


def test_gapped_insults_of_forty_letters(spark):
    rng = random.Random(9)
    plain = ["river", "stone", "garden", "window", "market", "yellow", "summer", "letter"]
    texts = [(i, " ".join([*(rng.choice(plain) for _ in range(12)), *(["grumplock"] if i % 3 == 0 else [])])) for i in range(300)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)], "doc_id long, toxic int")
    model = toxicity.learn(df, labels, F.lit(True))
    odd = [(1, "river " + "****".join("grumplock")), (2, "river " + "-" * 12 + "grumplock" + "-" * 12), (3, "river " + "****".join("riverbank")), (4, "stone " + "x" * 60)]
    got = toxicity.score_toxicity(spark.createDataFrame(odd, "doc_id long, text string"), model).orderBy("doc_id").collect()
    assert [r["score"] >= 0.5 for r in got] == [True, True, False, False]


def test_scorer_keeps_to_its_bounds(monkeypatch):
    monkeypatch.setattr(toxicity, "KNOWN_WORDS", 50)
    scorer = toxicity.Scorer(np.random.default_rng(1).normal(size=toxicity.ALPHABET**3).astype(np.float32), 0.0)
    other = toxicity.Scorer(scorer.table, 0.0)
    for i in range(40):
        text = " ".join(f"word{chr(97 + i % 26)}{chr(97 + k)}{'x' * (i % 5)}" for k in range(20))
        assert scorer.summaries([text]).tolist() == other.summaries([text]).tolist()
        assert len(scorer) <= 50 + 20
        other.forget()


# --- quality by one language -----------------------------------------------------------------------------------------

def test_letters_and_words_must_fit_one_language(spark):
    """Letters like those of one language with words of another fit none."""
    rng = random.Random(10)
    upper = ["THE", "OF", "AND", "TO", "IN", "THAT", "WAS", "HIS"]
    lower = ["das", "und", "der", "ein", "mit", "von", "ist", "zu"]

    def text(words):
        return " ".join(rng.choice(words) for _ in range(150))

    data = [(i, text(upper), "up") for i in range(40)] + [(100 + i, text(lower), "low") for i in range(40)]
    odd = [(200, text([w.lower() for w in upper]), None), (201, text([w.upper() for w in lower]), None), (202, text(upper), None)]
    df = spark.createDataFrame([*data, *odd], "doc_id long, text string, lang string")
    judged = {r["doc_id"]: r["kept"] for r in quality.judge_quality(df, limits=quality.Limits(classes=0.25, words=0.75)).collect()}
    repeated = {r["doc_id"] for r in quality.judge_quality(df).where("base_failed").collect()}
    assert {i for i in judged if i < 200 and not judged[i]} <= repeated
    assert (judged[200], judged[201]) == (False, False) and judged[202] == (202 not in repeated)


def test_few_common_words_say_little():
    """The spread counts from the first common word on, and the more the more there are."""
    references = {"en": (np.array([80, 2, 0, 0, 16, 2, 0, 0]), {f"w{i}": 10 for i in range(100)}, 1100)}
    judge = quality.Judge(references)
    far = [judge.distances("w1 " * n + "x " * (n // 10), [b"w1"] * n)[1] for n in (1, 5, 20, 80, 1000)]
    assert far == sorted(far) and far[0] < 0.5 and far[-1] > 0.9


def test_rare_languages_have_no_reference(spark):
    text = " ".join(["the", "house", "garden"] * 400)
    df = spark.createDataFrame([(text, "en")] * 5 + [("x", f"dirty {i}") for i in range(50)], "text string, lang string")
    assert list(quality.language_references(df)) == ["en"]
