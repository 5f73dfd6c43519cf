"""Hierarchical language identification: the family first, then one-versus-one linear machines within it.

Features are the relative frequencies of hashed runs of three and four bytes of the folded text, so one machine is a table of
weights, and judging a text of any length is a gather and a sum.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import computed, text_bytes
from quayside.llm.svm import train_svm

FEATURES = 1 << 12
# Families of languages. A language not listed is a family of its own.
FAMILIES = {
    "en": "germanic", "de": "germanic", "nl": "germanic", "sv": "germanic", "da": "germanic", "no": "germanic",
    "fr": "romance", "es": "romance", "it": "romance", "pt": "romance", "ro": "romance", "ca": "romance",
    "ru": "slavic", "pl": "slavic", "cs": "slavic", "uk": "slavic", "bg": "slavic", "sk": "slavic",
}
# The classifier is fitted on about this many documents of each language, chosen by a hash of the id.
SAMPLE_PER_LANGUAGE = 400
_SCALE = 40.0
_LETTER = re.compile(r"[^\W\d_]")
_FOLD = np.array([b if 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256)], dtype=np.uint32)


def runs(column) -> tuple[np.ndarray, np.ndarray]:
    """Feature of every byte run of all rows, and the rows' offsets into them; runs do not cross rows."""
    data, offsets = text_bytes(column)
    size = len(data)
    counts = np.maximum(np.diff(offsets) - 2, 0)
    bounds = np.concatenate(([0], np.cumsum(counts)))
    if size < 4:
        data = np.concatenate((data, np.full(4 - size, 32, dtype=np.uint8)))
    b = _FOLD[np.concatenate((data, [32]))]
    three = b[:-3] * np.uint32(0x9E3779B1) + b[1:-2] * np.uint32(0x85EBCA77) + b[2:-1] * np.uint32(0xC2B2AE3D)
    four = three * np.uint32(0x27D4EB2F) + b[3:] * np.uint32(0x165667B1)
    keys = np.stack([three, four], axis=1) >> np.uint32(32 - FEATURES.bit_length() + 1)
    own = np.zeros(len(keys) + 1, dtype=np.int64)
    long = counts > 0
    own[offsets[:-1][long]] += 1
    np.add.at(own, (offsets[:-1] + counts)[long], -1)
    return keys[np.cumsum(own)[:-1] > 0], bounds


def id_remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).cast("binary")) % modulus


@dataclass
class Model:
    """``groups``: languages by family. ``pairs``: for the families and for each family's languages, (a, b, machine)."""

    groups: dict[str, list[str]]
    pairs: list[tuple[str, str, str, int]]
    weights: np.ndarray
    offsets: np.ndarray


def _won(names: list[str], pairs: list[tuple[str, str, str, int]], level: str, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the winner by votes (then by summed margins, then by name), and its smallest margin."""
    votes, sums = np.zeros((len(margins), len(names))), np.zeros((len(margins), len(names)))
    least = np.full((len(margins), len(names)), np.inf)
    for where, a, b, machine in pairs:
        if where == level:
            for name, sign in ((a, 1), (b, -1)):
                at, margin = names.index(name), sign * margins[:, machine]
                votes[:, at] += margin > 0 if sign > 0 else margin >= 0
                sums[:, at] += margin
                least[:, at] = np.minimum(least[:, at], margin)
    best = np.argmax(votes + np.tanh(sums) / 4, axis=1)
    return best, least[np.arange(len(margins)), best]


def predict(model: Model, margins: np.ndarray) -> tuple[list[str], np.ndarray]:
    families = sorted(model.groups)
    family, sure = _won(families, model.pairs, "", margins)
    names = [""] * len(margins)
    for number, label in enumerate(families):
        rows = np.flatnonzero(family == number)
        languages = model.groups[label]
        best, margin = _won(languages, model.pairs, label, margins[rows])
        sure[rows] = np.minimum(sure[rows], margin)
        for row, at in zip(rows, best, strict=True):
            names[row] = languages[at]
    return names, 1 / (1 + np.exp(-2 * np.clip(sure, -15, 15)))


def learn(
    df: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    sample: int = SAMPLE_PER_LANGUAGE, families: dict[str, str] | None = None,
) -> Model:
    """Fit on rows where ``training`` holds, with text and language. About ``sample`` rows of each language reach the driver, as
    counts of at most ``FEATURES`` features; languages are counted over all rows."""
    families = FAMILIES if families is None else families
    lang, text = F.col(f"`{lang_col}`").cast("string"), F.col(f"`{text_col}`")
    spread = F.pmod(F.xxhash64(F.col(f"`{id_col}`").cast("string"), F.lit("language")), F.lit(1 << 30)) / float(1 << 30)
    rows = df.where(training & lang.isNotNull() & text.isNotNull()).select(lang.alias("lang"), spread.alias("spread"), text.alias("text"))
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    chosen = F.lit(False)
    for name, count in sizes.items():
        chosen = chosen | ((F.col("lang") == name) & (F.col("spread") < min(1.0, sample / count)))

    def features(langs, texts):
        keys, bounds = runs(texts)
        at, n = [], []
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            index, count = np.unique(keys[a:b], return_counts=True)
            at.append(index.astype("<i4").tobytes())
            n.append(count.astype("<i4").tobytes())
        return at, n

    found = computed(rows.where(chosen), ["lang", "text"], "at binary, n binary", features, keep=["lang"]).collect()
    x = np.zeros((len(found), FEATURES), dtype=np.float32)
    for row, r in zip(x, found, strict=True):
        n = np.frombuffer(r["n"], "<i4")
        if len(n):
            row[np.frombuffer(r["at"], "<i4")] = _SCALE * n / n.sum()
    labels = np.array([r["lang"] for r in found])
    family = np.array([families.get(v, v) for v in labels])
    groups: dict[str, list[str]] = {}
    for name in sorted(sizes):
        groups.setdefault(families.get(name, name), []).append(name)
    pairs, weights, offsets = [], [], []
    for level, members, values in [("", sorted(groups), family), *((g, names, labels) for g, names in groups.items())]:
        for a, b in combinations(members, 2):
            here = (values == a) | (values == b)
            if here.any():
                y = np.where(values[here] == a, 1.0, -1.0)
                w, offset = train_svm(x[here], y, np.where(y > 0, 1 / max((y > 0).sum(), 1), 1 / max((y < 0).sum(), 1)))
                pairs.append((level, a, b, len(weights)))
                weights.append(w * _SCALE)
                offsets.append(offset)
    return Model(groups, pairs, np.array(weights, dtype=np.float32).reshape(-1, FEATURES).T.copy(), np.array(offsets))


def identify(df: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) and lang_pred, score of every row.

    Null texts, texts without a letter, and all texts when no language was learned, are ``und`` with score 0. Ties go to
    the name that sorts first. Whole texts are read, of any length; repeated rows are judged one by one; an empty table gives no rows.
    Kept columns must not be called lang_pred or score.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def judge(state: Model, texts):
        strings = texts.to_pylist()
        known = [bool(t and _LETTER.search(t)) and bool(state.groups) for t in strings]
        if not any(known):
            return ["und"] * len(strings), [0.0] * len(strings)
        keys, bounds = runs(texts)
        margins = np.tile(state.offsets, (len(strings), 1))
        full = np.flatnonzero(np.diff(bounds) > 0)
        if len(full) and state.weights.shape[1]:
            sums = np.stack([
                np.add.reduceat(state.weights[keys, k].sum(axis=1, dtype=np.float32), bounds[full], dtype=np.float64)
                for k in range(state.weights.shape[1])
            ], axis=1)
            margins[full] += sums / (2 * np.diff(bounds)[full])[:, None]
        names, scores = predict(state, margins)
        return (
            [name if k else "und" for name, k in zip(names, known, strict=True)],
            [float(s) if k else 0.0 for s, k in zip(scores, known, strict=True)],
        )

    return computed(df, [text_col], "lang_pred string, score double", judge, lambda: shared.value, keep)
