"""Toxicity by a gap-weighted subsequence kernel, Nystroem landmarks and a linear support vector machine.

The kernel of two words sums, over all three-letter subsequences they share, the decay to the power of both spans; letters in between
may be anything, so inserted characters cost a little and hide nothing. Landmarks are words of labelled sentences. As
the machine is linear in the landmark kernels, its decision is a weight per three-letter subsequence, and judging
a word is a sum over its own subsequences. A text's score combines the strongest words, whichever its length.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, combinations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import computed, kept, lookup, written
from quayside.llm.language_id import id_remainder
from quayside.llm.svm import train_sigmoid, train_svm

DECAY = 0.4
# The subsequences of words up to this length are listed; longer ones are summed by a recursion over the places, with the same result.
LISTED = 40
# A unit longer than this is judged whole and in overlapping parts of this length, as a word in it would be lost in the whole's norm.
PART = 16
# Values that listing works on at once.
_LISTED_VALUES = 1 << 18
# The machine is fitted on about this many labelled documents of each class, chosen by a hash of the id, and on this many words.
SAMPLE_PER_CLASS = 3_000
TRAIN_WORDS = 3_000
# Rounds in which the words of clean sentences nearest to insults join the training, and how many in each.
HARD_ROUNDS = 2
HARD_WORDS = 1_500
LANDMARKS = 512
# Units and words whose margins a worker keeps, and characters in them.
KNOWN_WORDS = 200_000
KNOWN_CHARS = 1 << 22
_STRONGEST = 3
# Margins count up to this size: learned insults reach about 5, other words of clean texts hardly 2.
STRONG = 6.0

_WORD = re.compile(r"[^\s\"“”„«»()\[\]{}|/\;:,]+")
# Single letters with any run of other characters between each two.
_SPELLED = re.compile(r"(?<![\w'’])[^\W\d_](?:[\W\d_]+[^\W\d_]){2,}(?![^\W\d_])")
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")
_EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
# Characters that stand for letters in disguised words.
_LOOKALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}


def _letter(code: int) -> int:
    char = _LOOKALIKES.get(chr(code), chr(code)).lower()
    base = unicodedata.normalize("NFD", char)[:1]
    if "a" <= base <= "z" and len(base) == 1:
        # Letters with marks are letters of their own, so that only disguise is folded.
        return ord(base) - 96 if base == char else 27 + (sum(map(ord, unicodedata.normalize("NFD", char)[1:])) + ord(base)) % 36
    return 27 + code % 36 if char.isalpha() else 0


ALPHABET = 64
_LETTERS = np.array([_letter(c) for c in range(0x250)], dtype=np.int32)


@lru_cache(maxsize=LISTED + 2)
def _triples(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of all three-letter subsequences of a word of ``size``, and their decays."""
    places = np.array(list(combinations(range(size), 3)), dtype=np.int64).reshape(-1, 3)
    return places, (DECAY ** (places[:, 2] - places[:, 0] + 1)).astype(np.float32)


def units(text: str) -> list[str]:
    """Stretches without white space, lower-cased; letters spelled one by one are put together as well."""
    found = text.lower().split()
    return found + [re.sub(r"[\W\d_]+", "", m.group().lower()) for m in _SPELLED.finditer(text)]


def words_of(unit: str) -> list[str]:
    """The words of a unit without marks at their edges, and all of them put together, as marks that part words may be put into one;
    a longer one than ``PART`` also in overlapping parts."""
    out = []
    found = _WORD.findall(unit)
    for word in [*found, "".join(found)] if len(found) > 1 else found:
        word = word.strip(_EDGES)
        out.append(word)
        if len(word) > PART:
            out += [word[at:at + PART] for at in range(0, len(word) - PART // 2, PART // 2)]
    return out


def letter_codes(words: list[str]) -> np.ndarray:
    """Codes of the characters of words of one length, a row each, between two ends; 0 where it is no letter."""
    size = len(words[0])
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4").reshape(-1, size)
    codes = np.where(points < len(_LETTERS), _LETTERS[np.minimum(points, len(_LETTERS) - 1)], 27 + points.astype(np.int32) % 36)
    return np.pad(codes.astype(np.int32), ((0, 0), (1, 1)), constant_values=ALPHABET - 1)


def subsequences(words: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By length of word: rows, and for each row and place the subsequence's code and decay, scaled to a norm of 1 per row.

    A word's two ends count as letters. Subsequences with a character that is no letter have code 0 and decay 0.
    """
    by_size: dict[int, list[int]] = {}
    for row, word in enumerate(words):
        if len(word) >= 3:
            by_size.setdefault(len(word), []).append(row)
    out = []
    for size, rows in by_size.items():
        places, decay = _triples(size + 2)
        codes = letter_codes([words[r] for r in rows])
        first, second, third = (codes[:, places[:, k]] for k in range(3))
        letters = (first > 0) & (second > 0) & (third > 0)
        triple = ((first * ALPHABET + second) * ALPHABET + third) * letters
        decays = decay * letters
        norm = np.sqrt((decays * decays).sum(axis=1, keepdims=True))
        out.append((np.array(rows), triple, decays / np.where(norm > 0, norm, 1)))
    return out


def recursive_sum(codes: np.ndarray, by_last: np.ndarray) -> float:
    """Sum of the weights of all subsequences of one word times their decays, the decays' norm divided out.

    ``by_last[c]`` holds the weights of subsequences that end in c. Place by place: what pairs and single letters before it weigh,
    by their letters, and the sums of the squared decays.
    """
    pairs, singles = np.zeros((ALPHABET, ALPHABET)), np.zeros(ALPHABET)
    total = square = pair_squares = single_squares = 0.0
    for code in codes.tolist():
        if code:
            total += DECAY * np.vdot(by_last[code], pairs)
            square += DECAY**2 * pair_squares
            pairs[:, code] += singles
            pair_squares += single_squares
            singles[code] += 1
            single_squares += 1
        pairs *= DECAY
        singles *= DECAY
        pair_squares *= DECAY**2
        single_squares *= DECAY**2
    return total / np.sqrt(square) if square > 0 else 0.0


class Scorer(dict):
    """Margin of every unit, that of its strongest word; what is known is kept up to a bound."""

    def __init__(self, table: np.ndarray, offset: float):
        super().__init__()
        self.table, self.offset = table, offset
        self.by_last = np.ascontiguousarray(table.reshape(ALPHABET, ALPHABET, ALPHABET).transpose(2, 0, 1), dtype=np.float64)
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.words: dict[str, float] = {}
        self.chars = 0

    def margins(self, words: list[str]) -> np.ndarray:
        out = np.full(len(words), self.offset)
        by_size: dict[int, list[int]] = {}
        for row, word in enumerate(words):
            by_size.setdefault(len(word), []).append(row)
        for size, places in by_size.items():
            if size > LISTED:
                for row in places:
                    out[row] += recursive_sum(letter_codes([words[row]])[0], self.by_last)
                continue
            step = max(1, _LISTED_VALUES // ((size + 2) * (size + 1) * size // 6)) if size else len(places)
            for start in range(0, len(places), step):
                part = np.array(places[start:start + step])
                for rows, triple, decay in subsequences([words[r] for r in part.tolist()]):
                    out[part[rows]] += (self.table[triple] * decay).sum(axis=1)
        return out

    def learn(self, units: set[str]) -> None:
        """What a slice of texts needs is known afterwards, whatever the bound."""
        new = units.difference(self)
        if not new:
            return
        if len(self) + len(self.words) + len(new) > KNOWN_WORDS or self.chars > KNOWN_CHARS:
            self.forget()
            new = units
        split = {unit: words_of(unit) for unit in new}
        unseen = list({w for ws in split.values() for w in ws if w not in self.words})
        self.words.update(zip(unseen, self.margins(unseen).tolist(), strict=True))
        self.update((unit, max(map(self.words.__getitem__, ws), default=self.offset)) for unit, ws in split.items())
        self.chars += sum(map(len, new)) + sum(map(len, unseen))

    def summaries(self, texts: list[str | None]) -> np.ndarray:
        rows = [units(t) if t else [] for t in texts]
        self.learn(set(chain.from_iterable(rows)))
        return np.array([self.summary(words) for words in rows]).reshape(-1, _STRONGEST + 2)

    def summary(self, words: list[str]) -> np.ndarray:
        """The strongest margins of the text, largest first, the log of the number of words on the toxic side, and that of all words."""
        out = np.full(_STRONGEST + 2, -STRONG)
        out[_STRONGEST:] = 0
        if words:
            margins = np.fromiter(map(self.__getitem__, words), dtype=np.float64, count=len(words))
            top = np.sort(np.partition(margins, max(0, len(margins) - _STRONGEST))[-_STRONGEST:])[::-1]
            out[:len(top)] = np.clip(top, -STRONG, STRONG)
            out[_STRONGEST] = np.log1p((margins > 0).sum())
            out[_STRONGEST + 1] = np.log1p(len(words)) / 5
        return out


def _scorer(model: Model) -> Scorer:
    """One for all tasks of a worker that judge by the same model."""
    return kept(model, lambda: Scorer(model.table, model.offset))


@dataclass(eq=False)
class Model:
    table: np.ndarray
    offset: float
    weights: np.ndarray
    bias: float

    def probability(self, summaries: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(summaries @ self.weights + self.bias, -30, 30)))


def _weights(words: list[str], codes: np.ndarray) -> np.ndarray:
    """Weights of the subsequences ``codes`` (sorted) in each word."""
    out = np.zeros((len(words), len(codes)))
    for rows, triple, decay in subsequences(words):
        at = np.minimum(np.searchsorted(codes, triple), len(codes) - 1)
        hit = codes[at] == triple
        np.add.at(out, (np.broadcast_to(rows[:, None], triple.shape)[hit], at[hit]), decay[hit])
    return out


def disguises(word: str) -> list[str]:
    """The word with a character put in, and with one between all letters: what a learned word may look like."""
    half = len(word) // 2
    return [f"{word[:half]}*{word[half:]}", ".".join(word)] if len(word) >= 4 else []


def _word_counts(sample: DataFrame) -> DataFrame:
    """(word, toxic, clean): in how many different labelled sentences of each class a word stands. Copies of a sentence count once."""
    def split(texts):
        pairs = [[(hash_text(s), w) for s in _SENTENCE.split(t or "") for w in {p for u in units(s) for p in words_of(u)}]
                 for t in texts.to_pylist()]
        return [[h for h, _ in row] for row in pairs], [[w for _, w in row] for row in pairs]

    rows = computed(sample, ["text"], "sentences array<long>, words array<string>", split, keep=["toxic"])
    each = rows.select("toxic", F.explode(F.arrays_zip("sentences", "words")).alias("x"))
    return (
        each.select("toxic", F.col("x.sentences").alias("sentence"), F.col("x.words").alias("word")).where(F.length("word").between(3, LISTED)).distinct()
        .groupBy("word").agg(F.count_if(F.col("toxic") == 1).alias("toxic"), F.count_if(F.col("toxic") == 0).alias("clean"))
    )


def hash_text(text: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def learn(
    df: DataFrame, labels: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    sample: int = SAMPLE_PER_CLASS,
) -> Model:
    """Fit on labelled rows where ``training`` holds: half of a sample of about ``sample`` documents per class gives the
    words, the other half calibrates the score. Rows without text or label, and labels of unknown ids, play no part."""
    ids = F.col(f"`{id_col}`")
    spread = F.pmod(F.xxhash64(ids.cast("string"), F.lit("toxicity")), F.lit(1 << 30)) / float(1 << 30)
    labelled = labels.select(ids.alias("_id"), F.col(f"`{label_col}`").cast("int").alias("toxic"), spread.alias("spread")).where(
        training & ids.isNotNull() & F.col(f"`{label_col}`").isin(0, 1)
    ).groupBy("_id").agg(F.max("toxic").alias("toxic"), F.first("spread").alias("spread"))
    sizes = {r["toxic"]: r["count"] for r in labelled.groupBy("toxic").count().collect()}
    share = {k: min(1.0, sample / n) for k, n in sizes.items()}
    chosen = written(labelled.where(
        ((F.col("toxic") == 1) & (F.col("spread") < share.get(1, 0.0))) | ((F.col("toxic") == 0) & (F.col("spread") < share.get(0, 0.0)))
    ), "chosen")
    few = lookup(chosen, chosen.count())
    texts = df.select(ids.alias("_id"), F.col(f"`{text_col}`").alias("text")).join(few, "_id").where(F.col("text").isNotNull())
    half = F.pmod(F.xxhash64(F.col("_id").cast("string"), F.lit("half")), F.lit(2))
    # Of a bounded sample of documents, but asked three times.
    counts = written(_word_counts(texts.where(half == 0).select("text", "toxic")), "word-counts")
    totals = counts.agg(F.sum("toxic"), F.sum("clean")).first()
    toxic, clean = (totals[0] or 0) + 1, (totals[1] or 0) + 1
    # Evidence that a word is commoner in toxic sentences: its log likelihood ratio.
    a, b = F.col("toxic").cast("double"), F.col("clean").cast("double")
    rate, base = (a + 0.5) / (a + b + 1), toxic / (toxic + clean)
    lift = a * F.log((a + 0.01) / ((a + b + 0.01) * base)) + b * F.log((b + 0.01) / ((a + b + 0.01) * (1 - base)))
    scored = counts.select("word", "toxic", "clean", rate.alias("rate"), lift.alias("lift"))
    bad = scored.where((F.col("toxic") >= 3) & (F.col("lift") >= 6) & (F.col("rate") > (1 + base) / 2)).orderBy(F.desc("lift"), "word").limit(TRAIN_WORDS // 3).collect()
    usual = scored.where(F.col("clean") >= 1).where(F.col("rate") <= base).orderBy(F.desc("clean"), "word").limit(TRAIN_WORDS).collect()
    bad, usual = [r["word"] for r in bad], [r["word"] for r in usual]
    model, hard = _fit_words(bad, usual, []), []
    # Most words of clean texts are rare: those that the machine takes for insults train the next one.
    others = scored.where((F.col("clean") >= 1) & (F.col("rate") <= base))
    for _ in range(HARD_ROUNDS if bad and usual else 0):
        hard = list(dict.fromkeys([*hard, *_strongest_words(others.select("word"), model)]))
        model = _fit_words(bad, usual, hard)
    summaries = _summaries(texts.where(half == 1).select("text", "toxic"), model).collect()
    x = np.array([r["_summary"] for r in summaries]).reshape(-1, _STRONGEST + 2)
    y = np.array([r["toxic"] for r in summaries], dtype=float)
    if len(set(y)) == 2:
        # The sample is balanced by class; weights would restore the corpus' shares, which keeps clean texts clean.
        weights, bias = train_sigmoid(x, y)
        odds = np.log(max(sizes.get(1, 0) * y.mean() ** -1, 1e-9) / max(sizes.get(0, 0) * (1 - y.mean()) ** -1, 1e-9))
        return Model(model.table, model.offset, weights, bias + float(np.clip(odds, -4, 4)))
    return model


def _strongest_words(words: DataFrame, model: Model) -> list[str]:
    """The words of a bounded sample that come nearest to insults by the machine so far."""
    shared = words.sparkSession.sparkContext.broadcast(model)
    judged = computed(words, ["word"], "margin double", lambda state, column: [state.margins(column.to_pylist())], lambda: _scorer(shared.value))
    found = [r["word"] for r in judged.orderBy(F.desc("margin"), "word").limit(HARD_WORDS).collect()]
    shared.destroy()
    return found


def _fit_words(toxic: list[str], usual: list[str], hard: list[str]) -> Model:
    weights = np.zeros(_STRONGEST + 2)
    weights[0] = 4.0
    size = ALPHABET**3
    if not toxic or not usual:
        return Model(np.zeros(size), -1.0, weights, -1.0)
    clean = list(dict.fromkeys([*usual, *hard]))
    n = LANDMARKS // 2
    landmarks = list(dict.fromkeys([*toxic[:n], *usual[:n - len(hard[:n // 2])], *hard[:n // 2]]))
    words = toxic + [d for w in toxic[:n // 4] for d in disguises(w)] + clean
    y = np.array([1.0] * (len(words) - len(clean)) + [-1.0] * len(clean))
    codes = np.unique(np.concatenate([triple.ravel() for _, triple, _ in subsequences(landmarks)]))
    codes = codes[codes > 0]
    marks = _weights(landmarks, codes)
    kernel = np.vstack([_weights(words[at:at + 512], codes) @ marks.T for at in range(0, len(words), 512)])
    # Nystroem features: kernels to the landmarks, whitened by the landmarks' own kernel matrix.
    values, vectors = np.linalg.eigh(marks @ marks.T)
    kept = values > 1e-6 * values.max()
    white = vectors[:, kept] / np.sqrt(values[kept])
    balance = np.where(y > 0, 1 / (y > 0).sum(), 1 / (y < 0).sum())
    beta, offset = train_svm(kernel @ white, y, balance, penalty=1e-6, steps=1500)
    table = np.zeros(size, dtype=np.float32)
    table[codes] = marks.T @ (white @ beta)
    return Model(table, offset, weights, -1.0)


def _summaries(df: DataFrame, model: Model) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(model)
    return computed(df, ["text"], "_summary array<double>", lambda state, texts: [state.summaries(texts.to_pylist()).tolist()],
                    lambda: _scorer(shared.value), keep=["toxic"])


def score_toxicity(df: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.7, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) and score (0 to 1), predicted (1 from ``threshold`` on) of every row.

    Null and empty texts get the score of a text without words. Whole texts are read, of any length; repeated rows are
    scored one by one; an empty table gives no rows. Where kept columns are called score or predicted, the new ones get ``_`` before it.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def judge(state: Scorer, texts):
        rows = state.summaries(texts.to_pylist())
        scores = shared.value.probability(rows)
        return scores.tolist(), (scores >= threshold).astype(int).tolist()

    return computed(df, [text_col], "score double, predicted int", judge, lambda: _scorer(shared.value), keep)


def held_out(id_col: str = "doc_id") -> Column:
    return id_remainder(id_col, 3) == 1
