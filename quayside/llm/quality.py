"""Quality rules by distribution divergence.

A document's histograms of character classes and of common words are compared to those of every language, by the Jensen-Shannon
distance (square root of the divergence in bits, 0 to 1). The references are counted over all documents. Words are held to a language
twice: how large the share of its common words is, and how they are spread. A document passes when it is close to some language;
documents too short to judge are left to the base rules.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import computed, written

_BLANKS = " \t\n\x0b\x0c\r"
_SYMBOLS = re.compile(r"[#*$%&|<>]")
# Classes of characters: lower and upper case letters, other letters, digits, white space, sentence marks, symbols, rest.
CLASSES = 8
# A word is common when it makes up this share of its language's words, so a language has at most 1 / share of them.
COMMON_SHARE = 0.002
# A language has a reference when it has this share of all words, so there are at most 1 / share of them, whatever the column holds.
LANGUAGE_SHARE = 0.001
# A document's spread of common words is smoothed by this many that follow the language, so a few words say little and none nothing.
PRIOR = 5.0


@dataclass(frozen=True)
class Limits:
    """Largest distances that pass, and the words from which on they are applied."""

    classes: float = 0.25
    words: float = 0.75
    least_words: int = 50


def _class_of(char: str) -> int:
    kind = unicodedata.category(char)
    if kind in ("Ll", "Lu"):
        return 0 if kind == "Ll" else 1
    if kind[0] == "L":
        return 2
    if kind[0] == "N":
        return 3
    if char.isspace():
        return 4
    if char in ".,;:!?'\"-()":
        return 5
    return 6 if kind[0] in "SP" else 7


_CLASS = np.array([_class_of(chr(c)) for c in range(0x3000)], dtype=np.uint8)


def class_counts(text: str) -> np.ndarray:
    """Characters of the text by class."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    near = points < len(_CLASS)
    counts = np.bincount(_CLASS[points[near]], minlength=CLASSES)
    if not near.all():
        counts = counts + np.bincount([_class_of(chr(c)) for c in points[~near]], minlength=CLASSES)
    return counts


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of histogram ``p`` to every row of ``q`` (all sum to 1)."""
    middle = (p + q) / 2

    def towards(x):
        return np.where(x > 0, x * np.log2(np.where(x > 0, x, 1) / np.where(middle > 0, middle, 1)), 0).sum(axis=-1)

    return np.sqrt(np.clip((towards(np.broadcast_to(p, q.shape)) + towards(q)) / 2, 0, 1))


def word_key(word: bytes) -> str:
    """A word as the histograms count it: lower case, without marks around it."""
    return word.decode().lower().strip(".,;:!?'\"-()")


def base_counts(text: str) -> tuple[list[bytes], int, int, int, int]:
    """Words, and word_chars, n_symbols, n_dup_lines and n_repeat_words."""
    raw = text.encode()
    words = raw.split()  # bytes split at exactly \x20 and \x09-\x0D
    lines = [line for line in raw.split(b"\n") if line.strip()]
    repeated = 0
    if len(words) > 3:
        number: dict[bytes, int] = {}
        ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=len(words))
        pair = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)[1]
        _, window, often = np.unique(pair[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)
        hit = np.flatnonzero(often[window] > 1)
        covered = np.zeros(len(words), dtype=bool)
        for shift in range(3):
            covered[hit + shift] = True
        repeated = int(covered.sum())
    blanks = sum(map(text.count, _BLANKS))
    return words, len(text) - blanks, len(_SYMBOLS.findall(text)), len(lines) - len(set(lines)), repeated


def language_references(df: DataFrame, text_col: str = "text", lang_col: str = "lang", share: float = COMMON_SHARE) -> dict[str, tuple]:
    """For each non-null language, counted over all documents: (class counts, {common word: count}, all words).

    Tasks pre-aggregate; what reaches the driver is one row per language and class, and per common word.
    """
    def count(batches):
        classes: dict[str, np.ndarray] = {}
        words: dict[str, Counter] = {}

        def rows():
            langs = [(lang, "", i, int(n)) for lang, c in classes.items() for i, n in enumerate(c)]
            for lang, counter in words.items():
                keyed: Counter = Counter()
                for word, n in counter.items():
                    keyed[word_key(word)] += n
                langs += [(lang, word, -1, n) for word, n in keyed.items()]
            classes.clear()
            words.clear()
            for i in range(0, len(langs), 50_000):
                part = list(zip(*langs[i:i + 50_000], strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part[0]), pa.array(part[1]), pa.array(part[2], pa.int32()), pa.array(part[3], pa.int64())],
                    names=["lang", "word", "class", "n"],
                )

        held = 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if lang not in classes:
                    classes[lang], words[lang] = np.zeros(CLASSES, dtype=np.int64), Counter()
                classes[lang] += class_counts(text)
                held -= len(words[lang])
                words[lang].update(text.encode().split())
                held += len(words[lang])
                if held > 1_000_000:  # what a task holds is bounded; the rest of its rows is counted anew
                    yield from rows()
                    held = 0
        yield from rows()

    lang, text = F.col(f"`{lang_col}`").cast("string"), F.col(f"`{text_col}`")
    known = df.select(lang.alias("lang"), text.alias("text")).where(lang.isNotNull() & text.isNotNull())
    counted = known.mapInArrow(count, "lang string, word string, class int, n long").groupBy("lang", "word", "class").agg(F.sum("n").alias("n"))
    # One row per language and distinct word, asked twice. The totals are a row per language and class.
    counted = written(counted, "counted")
    totals = counted.where("class < 0").groupBy("lang").agg(F.sum("n").alias("total"))
    every = totals.agg(F.sum("total")).first()[0] or 0
    frequent = totals.where(F.col("total") >= F.lit(LANGUAGE_SHARE * every))
    kept = counted.join(F.broadcast(frequent), "lang")  # at most 1 / LANGUAGE_SHARE rows
    out: dict[str, list] = {}
    for r in kept.where((F.col("class") >= 0) | ((F.col("word") != "") & (F.col("n") >= F.lit(share) * F.col("total")))).collect():
        entry = out.setdefault(r["lang"], [np.zeros(CLASSES, dtype=np.int64), {}, r["total"]])
        if r["class"] >= 0:
            entry[0][r["class"]] = r["n"]
        else:
            entry[1][r["word"]] = r["n"]
    return {lang: tuple(entry) for lang, entry in sorted(out.items())}


class Judge:
    """Distances of a document to the language references."""

    def __init__(self, references: dict[str, tuple]):
        words = sorted({w for _, common, _ in references.values() for w in common})
        self.place = {w: i for i, w in enumerate(words)}
        self.classes = np.array([c / max(c.sum(), 1) for c, _, _ in references.values()]).reshape(-1, CLASSES)
        self.words = np.zeros((len(references), len(words)))
        for row, (_, common, _) in enumerate(references.values()):
            for word, n in common.items():
                self.words[row, self.place[word]] = n
        known = self.words.sum(axis=1)
        self.words /= np.maximum(known, 1)[:, None]
        # Shares of common and of other words, and how far a text without any common word is from them.
        share = known / np.maximum([total for _, _, total in references.values()], 1)
        self.shares = np.stack([share, 1 - share], axis=1)
        self.without = distance(np.array([0.0, 1.0]), self.shares)

    def distances(self, text: str, words: list[bytes], limits: Limits = Limits()) -> tuple[float | None, float | None]:
        """Distances of the character classes and of the words (null without any) to the language that the text is nearest to.

        Both are to one language: the one whose larger distance, as a share of its limit, is smallest. Too small a share of common words
        is as far as it comes near a text without any, which has distance 1; a larger one than the language's is no distance. Their
        spread counts too: the larger distance is the words'. A language without common words is known by its character classes alone.
        """
        if not len(self.classes) or not text:
            return None, None
        counts = class_counts(text)
        classes = distance(counts / counts.sum(), self.classes)
        if not words:
            return float(classes.min()), None
        common, found = np.zeros(len(self.place)), 0
        for word, n in Counter(words).items():
            place = self.place.get(word_key(word))
            if place is not None:
                common[place] += n
                found += n
        share = found / len(words)
        far = distance(np.array([share, 1 - share]), self.shares) / np.where(self.without > 0, self.without, 1)
        far = np.where(share < self.shares[:, 0], far, 0)
        smooth = (common + PRIOR * self.words) / (found + PRIOR)
        spread = np.array([distance(p, q[None, :])[0] for p, q in zip(smooth, self.words, strict=True)])
        far = np.where(self.shares[:, 0] > 0, np.maximum(far, spread), classes)
        best = int(np.argmin(np.maximum(classes / limits.classes, far / limits.words)))
        return float(classes[best]), float(far[best])


def judge_quality(
    df: DataFrame, references: dict[str, tuple] | None = None, limits: Limits = Limits(), text_col: str = "text",
    lang_col: str = "lang", keep: list[str] | None = None,
) -> DataFrame:
    """The columns ``keep`` (all by default) and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    class_distance, word_distance, kept.

    Base rules: fewer than 50 words, or over half of the words in repeated 3-word windows, fail. The rest is kept if there is a language
    to which neither distance exceeds its limit; they are applied from ``least_words`` words on, however few of them are common. Without any
    reference nothing is rejected by distance. Null texts have no words and fail, as empty ones do. Repeated rows are judged one by
    one; an empty table gives no rows. The language column only serves the references; values with less than ``LANGUAGE_SHARE`` of all words
    have none. A new column with the name of a kept one gets ``_`` before it.
    """
    references = language_references(df, text_col, lang_col) if references is None else references
    shared = df.sparkSession.sparkContext.broadcast(references)

    def judge(state: Judge, texts):
        rows = []
        for text in texts.to_pylist():
            words, chars, symbols, lines, repeated = base_counts(text or "")
            failed = len(words) < 50 or 100 * repeated > 50 * len(words)
            near, common = state.distances(text or "", words, limits)
            good = near is None or common is None or (near <= limits.classes and common <= limits.words)
            good = good or len(words) < limits.least_words
            rows.append((len(words), chars, symbols, lines, repeated, failed, near, common, not failed and good))
        return list(zip(*rows, strict=True))

    return computed(
        df, [text_col], "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, class_distance double, word_distance double, kept boolean", judge, lambda: Judge(shared.value), keep,
    )
