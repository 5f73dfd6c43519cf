"""URL rules as one bit-parallel automaton.

Every rule is a glob over symbols of the canonical URL: the bytes of the lower-cased host behind a dot, a separator that is no
byte, the bytes of the path. Each state of each rule is one bit; all rules' bits are packed into 64-bit words, and
one Shift-And step per symbol moves all of them at once, for many URLs side by side.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from quayside.llm.common import computed

SEPARATOR = 256
_HOST = re.compile(r"://([^/?#]*)([^?#]*)", re.S)
_FOLD = {c: c + 32 for c in range(65, 91)}


@dataclass(frozen=True)
class Rule:
    """``host`` and its subdomains below ``path``; ``glob`` rules give both parts with ``*`` for any run of bytes."""

    host: str
    path: str
    verdict: str
    glob: bool = False

    @property
    def label(self) -> str:
        return self.host + self.path

    def symbols(self) -> list[int | None]:
        """The rule's symbols; None is a star, which never runs over the separator."""
        def part(text):
            return [None if self.glob and c == 42 else c for c in text.encode()]

        host = part(self.host) if self.glob else [None, 46, *part(self.host)]
        return [*host, SEPARATOR, *part(self.path), None]


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    found = _HOST.search(url) if url is not None else None
    return (found[1].translate(_FOLD), found[2]) if found else ("", "")


class Automaton:
    """All rules packed into words of 64 states; ``accepts`` simulates them together.

    State ``k`` of a rule means that its first ``k`` literals are matched; a star makes its state stay on any symbol
    but the separator. Words are kept as the last axis, and the shift carries from word to word.
    """

    def __init__(self, rules: list[Rule]):
        literals, stays, starts, finals = [], [], [], []
        for rule in rules:
            starts.append(len(literals))
            literals.append(None)
            stays.append(False)
            for symbol in rule.symbols():
                if symbol is None:
                    stays[-1] = True
                else:
                    literals.append(symbol)
                    stays.append(False)
            finals.append(len(literals) - 1)
        size = -(-len(literals) // 64) or 1
        self.words, self.count = size, len(rules)
        self.enter = np.zeros((SEPARATOR + 1, size), dtype=np.uint64)
        self.stay = np.zeros((SEPARATOR + 1, size), dtype=np.uint64)
        self.begin = np.zeros(size, dtype=np.uint64)
        self.final = [(f // 64, np.uint64(1) << np.uint64(f % 64)) for f in finals]
        for bit, symbol in enumerate(literals):
            mask = np.uint64(1) << np.uint64(bit % 64)
            if symbol is not None:
                self.enter[symbol, bit // 64] |= mask
            if stays[bit]:
                self.stay[:SEPARATOR, bit // 64] |= mask
        for bit in starts:
            self.begin[bit // 64] |= np.uint64(1) << np.uint64(bit % 64)

    def accepts(self, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Rules by URL, from symbols laid end to end."""
        order = np.argsort(-lengths, kind="stable")
        at = (np.cumsum(lengths) - lengths)[order]
        remaining = lengths[order]
        state = np.tile(self.begin, (len(lengths), 1))
        for step in range(int(remaining[0]) if len(remaining) else 0):
            live = int(np.searchsorted(-remaining, -step, side="left"))
            symbol = symbols[at[:live] + step]
            now = state[:live]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:live] = (moved & self.enter[symbol]) | (now & self.stay[symbol])
        out = np.zeros((len(lengths), self.count), dtype=bool)
        for i, (word, mask) in enumerate(self.final):
            out[order, i] = (state[:, word] & mask) != 0
        return out


def filter_urls(
    df: DataFrame, rules: list[Rule], globs: list[Rule] = (), default: str = "allow", id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """(id, host, path, rule, verdict) of every row: the longest fitting rule decides, else the first fitting glob, else ``default``.

    A rule fits its host and all subdomains when the path starts with the rule's; ties in length go to the earlier
    rule. Null URLs and those without ``://`` have empty host and path and get the default. Repeated rows are judged one by
    one; an empty table gives no rows; columns other than the two named are not read, so their names cannot clash.
    The id keeps its value, null too. URLs of any length are simulated whole.
    """
    ranked = sorted(rules, key=lambda r: -len(r.label)) + list(globs)
    plain = len(rules)

    def judge(machine: Automaton, urls):
        parts = [split_url(u) for u in urls.to_pylist()]
        coded = [b"." + h.encode() + b"\0" + p.encode() for h, p in parts]
        lengths = np.array([len(c) for c in coded], dtype=np.int64)
        symbols = np.frombuffer(b"".join(coded), dtype=np.uint8).astype(np.int64)
        starts = np.cumsum(lengths) - lengths
        symbols[starts + np.array([1 + len(h.encode()) for h, _ in parts], dtype=np.int64)] = SEPARATOR
        fits = machine.accepts(symbols, lengths)
        first = np.where(fits.any(axis=1), fits.argmax(axis=1), -1) if fits.shape[1] else np.full(len(parts), -1)
        # Where there is no host to judge, a glob must not fit either.
        first[np.array([not (h or p) for h, p in parts], dtype=bool)] = -1
        rule = [ranked[i].label if 0 <= i < plain else None for i in first]
        verdict = [ranked[i].verdict if i >= 0 else default for i in first]
        return [h for h, _ in parts], [p for _, p in parts], rule, verdict

    return computed(df, [url_col], "host string, path string, rule string, verdict string", judge, lambda: Automaton(ranked),
                    keep=[id_col])
