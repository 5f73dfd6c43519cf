"""Benchmark decontamination with a generalised suffix automaton of the normalised items.

Training words are streamed through the automaton, which keeps the length of the longest match that ends at each word. Where it
reaches the window length (or a whole shorter item ends), the matched span is marked; spans are then removed, or a document is
dropped when its marked share exceeds a limit.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import computed, written

WINDOW = 10
# Words of one automaton; more benchmark text is dealt to several, each streamed over all documents.
AUTOMATON_WORDS = 200_000
_TABLE = bytes(
    b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """A-Z lower-cased, words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` as UTF-8."""
    return text.encode().translate(_TABLE).split() if text else []


class SuffixAutomaton:
    """Of several word sequences; states know the items whose windows end in them.

    An item of fewer words than ``window`` is one window itself.
    """

    def __init__(self, items: list[list[int]], window: int = WINDOW):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends = []
        for number, sequence in enumerate(items):
            state = 0
            for read, symbol in enumerate(sequence, 1):
                state = self._extend(state, symbol)
                if read >= window or read == len(sequence):
                    ends.append((state, min(read, window), number))
        # By the state that holds the window itself: what ends there, as (words of the window, item).
        self.ends: dict[int, set[tuple[int, int]]] = {}
        for state, size, number in ends:
            self.ends.setdefault(self._holder(state, size), set()).add((size, number))
        # Every state with what ends there or at one of its suffixes.
        self.found: list[tuple[tuple[int, int], ...]] = [()] * len(self.link)
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            own = self.ends.get(state)
            above = self.found[self.link[state]]
            self.found[state] = (*above, *sorted(own)) if own else above

    def _holder(self, state: int, size: int) -> int:
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state

    def _new(self, moves: dict[int, int], link: int, length: int) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        return len(self.length) - 1

    def _extend(self, last: int, symbol: int) -> int:
        known = self.next[last].get(symbol)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, symbol, known)
        state = self._new({}, 0, self.length[last] + 1)
        while last >= 0 and symbol not in self.next[last]:
            self.next[last][symbol] = state
            last = self.link[last]
        if last >= 0:
            known = self.next[last][symbol]
            fits = self.length[known] == self.length[last] + 1
            self.link[state] = known if fits else self._split(last, symbol, known)
        return state

    def _split(self, last: int, symbol: int, known: int) -> int:
        """Give the strings of ``known`` that end a shorter way a state of their own."""
        part = self._new(dict(self.next[known]), self.link[known], self.length[last] + 1)
        self.link[known] = part
        while last >= 0 and self.next[last].get(symbol) == known:
            self.next[last][symbol] = part
            last = self.link[last]
        return part

    def matches(self, symbols: list[int]) -> Iterator[tuple[int, int, int]]:
        """(place, state, words matched) after each symbol: the longest match that ends there."""
        moves, link, length = self.next, self.link, self.length
        state = matched = 0
        for place, symbol in enumerate(symbols):
            to = moves[state].get(symbol)
            while to is None and state:
                state = link[state]
                matched = length[state]
                to = moves[state].get(symbol)
            state, matched = (0, 0) if to is None else (to, matched + 1)
            yield place, state, matched


class Matcher:
    """The automaton of one share of the items, with their words numbered."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        number = self.vocabulary.setdefault
        coded = [[number(w, len(self.vocabulary)) for w in words] for _, words in items]
        self.names = [name for name, _ in items]
        self.automaton = SuffixAutomaton(coded, window)
        # Shorter runs of known words cannot hold a window.
        self.least = min((min(len(c), window) for c in coded if c), default=0)

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Spans (start, end) of the words hit, merged and in order, and the items whose windows occur."""
        spans: list[tuple[int, int]] = []
        items: set[int] = set()
        if not self.least or len(words) < self.least:
            return spans, items
        ids = np.fromiter(map(self.vocabulary.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        edges = np.flatnonzero(np.diff(np.concatenate(([False], ids >= 0, [False])).astype(np.int8)))
        starts, stops = edges[::2], edges[1::2]
        for i in np.flatnonzero(stops - starts >= self.least):
            base = int(starts[i])
            found = self.automaton.found
            for place, state, matched in self.automaton.matches(ids[base:stops[i]].tolist()):
                for size, number in found[state]:
                    if size <= matched:
                        items.add(number)
                        spans.append((base + place + 1 - size, base + place + 1))
        return merged(spans), items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


@lru_cache(maxsize=1)
def _matcher(items: tuple[tuple[str, tuple[bytes, ...]], ...], window: int) -> Matcher:
    return Matcher([(name, list(words)) for name, words in items], window)


def _shares(benchmark: DataFrame, id_col: str, text_col: str, limit: int) -> Iterator[tuple]:
    """Items as (id as text, words), in shares of about ``limit`` words: the only benchmark text held at once."""
    item, text = F.col(f"`{id_col}`").cast("string"), F.col(f"`{text_col}`")
    kept = benchmark.select(F.coalesce(item, F.lit("")).alias("item"), text.alias("text")).where(text.isNotNull())
    # A word takes a byte and a separator at least, so half the bytes bound the words.
    size = kept.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    shares = -(-size // (2 * limit)) or 1
    for k in range(shares):
        rows = kept.where(F.pmod(F.xxhash64("item", "text"), F.lit(shares)) == k).collect()
        yield tuple(sorted({(r["item"], tuple(words_of(r["text"]))) for r in rows}))


def find_leaks(
    df: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", automaton_words: int = AUTOMATON_WORDS, keep: list[str] | None = None,
) -> DataFrame:
    """The columns ``keep`` of every row of ``df`` (all by default), and n_words, spans array<long>, items array<string>.

    ``spans`` are start and end word of each marked stretch, one after the other; ``items`` the ids (as text, sorted) of items
    with a window in the document. Null texts have no words. Items without words, and null item texts, match nothing;
    null item ids count as the empty text; repeated items count once. Repeated documents are scanned one by one; empty tables
    give no rows or no spans. A kept column that has the name of a new one is an error: leave it out or rename it.
    The benchmark is streamed in shares of a bounded number of words, one pass over the documents each.
    """
    keep = df.columns if keep is None else keep
    if clash := {c.lower() for c in keep} & {"n_words", "spans", "items"}:
        raise ValueError(f"rename {sorted(clash)} first")
    done: DataFrame | None = None
    for share in _shares(benchmark, item_col, item_text_col, automaton_words):
        shared = df.sparkSession.sparkContext.broadcast(share)

        def scan(matcher, *given):
            counts, spans, items = [], [], []
            for row, text in enumerate(given[-1].to_pylist()):
                words = words_of(text)
                hits, numbers = matcher.scan(words)
                names = {matcher.names[n] for n in numbers}
                if len(given) > 1:
                    before = given[0][row].as_py()
                    hits = merged(hits + list(zip(before[::2], before[1::2], strict=True)))
                    names.update(given[1][row].as_py())
                counts.append(len(words))
                spans.append([x for span in hits for x in span])
                items.append(sorted(names))
            return counts, spans, items

        def setup(shared=shared):
            return _matcher(shared.value, window)

        fields = "n_words long, spans array<long>, items array<string>"
        if done is None:
            done = computed(df, [text_col], fields, scan, setup, keep=list(dict.fromkeys([*keep, text_col])))
        else:
            before = written(done.withColumnsRenamed({"spans": "_spans", "items": "_items"}).drop("n_words"), "leaks")
            done = computed(before, ["_spans", "_items", text_col], fields, scan, setup).drop("_spans", "_items")
    return done.select(*(F.col(f"`{c}`") for c in [*keep, "n_words", "spans", "items"]))


def decontaminate(
    df: DataFrame, benchmark: DataFrame, max_share: float = 0.5, window: int = WINDOW, text_col: str = "text",
) -> DataFrame:
    """``df`` with marked words cut out of its texts; documents with more than ``max_share`` of their words marked go.

    The text around a cut keeps its spelling and white space. Clean documents, null and empty texts come back unchanged, with all
    columns of ``df`` in order; a column ``n_chars`` is left as it is.
    """
    names = {c: f"_in{i}" for i, c in enumerate(df.columns)}
    text = names[text_col]
    found = find_leaks(df.withColumnsRenamed(names), benchmark, window, text)
    marked = F.expr("aggregate(transform(spans, (x, i) -> if(i % 2 = 1, x, -x)), 0L, (s, x) -> s + x)")
    kept = found.where(marked <= F.lit(max_share) * F.col("n_words"))

    def cut(spans, texts):
        return [[t if not s else without(t, s) for s, t in zip(spans.to_pylist(), texts.to_pylist(), strict=True)]]

    clean = computed(kept, ["spans", text], "cut string", cut)
    return clean.select(*(F.col("cut" if c == text_col else n).alias(c) for c, n in names.items()))


def without(text: str, spans: list[int]) -> str:
    """``text`` without the words from spans[0] to spans[1], spans[2] to spans[3] and so on."""
    raw = text.encode()
    places = [(m.start(), m.end()) for m in re.finditer(rb"[^ ]+", raw.translate(_TABLE))]
    kept, at = [], 0
    for start, end in zip(spans[::2], spans[1::2], strict=True):
        kept.append(raw[at:places[start][0]])
        at = places[end - 1][1]
    return b"".join([*kept, raw[at:]]).decode()


def leak_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per document of ``find_leaks``: n_words, n_hit, n_items, items_sha256 and contaminated."""
    hit = F.expr("aggregate(transform(spans, (x, i) -> if(i % 2 = 1, x, -x)), 0L, (s, x) -> s + x)")
    return found.select(
        id_col, "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )
