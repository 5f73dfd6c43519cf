"""Removal of long passages that an earlier document has, with suffix automata of reference shards.

Copies of a passage of ``width`` words share its sampled anchor runs, so documents without a repeated anchor are never looked at again.
Of the others, the windows under repeated anchors are matched by fingerprint, which names for each repeated window
its first place in the corpus: the reference. References are dealt to shards of bounded size; every shard's text becomes one
suffix automaton, sent to each task that streams documents against it. The longest match that ends at each
word decides, word by word, so a fingerprint (of 128 bits) alone removes nothing. A shard with much to stream goes to several tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import Words, computed, fresh, lookup, written
from quayside.llm.decontaminate import merged

WIDTH = 50
ANCHOR = 10
SECOND = 0x2545F4914F6CDD1D
# Words of references in a shard, about, and windows streamed through one copy of it, about.
SHARD_WORDS = 20_000
STREAM_WINDOWS = 200_000
# Values (8 bytes) a lookup by document may hold to be broadcast.
LOOKUP_VALUES = 4_000_000


def anchors(words: Words, row: int, width: int, runs: np.ndarray) -> np.ndarray:
    """Place of the anchor of every window of a row: its ``ANCHOR``-word run of the smallest fingerprint, the first of equal ones."""
    first, count = words.first[row], words.counts[row]
    views = np.lib.stride_tricks.sliding_window_view(runs[first:first + count - ANCHOR + 1], width - ANCHOR + 1)
    return np.arange(len(views)) + views.argmin(axis=1)


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _by_document(df: DataFrame, text: str, rows: DataFrame, values: int) -> DataFrame:
    """``df`` joined to one row per document of ``rows`` (by _doc and _hash)."""
    return df.join(lookup(rows, values, LOOKUP_VALUES), ["_doc", "_hash"])


class Automaton:
    """Suffix automaton of a shard's passages; each state knows the first document that has its strings."""

    def __init__(self, passages: list[tuple[object, list[bytes]]]):
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length, self.first = [-1], [0], [None]
        for document, words in passages:
            state = 0
            for word in words:
                state = self._extend(state, word)
                known = self.first[state]
                self.first[state] = document if known is None or document < known else known
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            above, own = self.link[state], self.first[state]
            if above > 0 and own is not None and (self.first[above] is None or own < self.first[above]):
                self.first[above] = own

    def _add(self, moves: dict[bytes, int], link: int, length: int) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        self.first.append(None)
        return len(self.link) - 1

    def _extend(self, last: int, word: bytes) -> int:
        moves, link, length = self.next, self.link, self.length
        there = moves[last].get(word)
        if there is not None:
            return there if length[there] == length[last] + 1 else self._split(last, word, there)
        state = self._add({}, 0, length[last] + 1)
        while last >= 0 and word not in moves[last]:
            moves[last][word] = state
            last = link[last]
        if last >= 0:
            there = moves[last][word]
            link[state] = there if length[there] == length[last] + 1 else self._split(last, word, there)
        return state

    def _split(self, last: int, word: bytes, there: int) -> int:
        part = self._add(dict(self.next[there]), self.link[there], self.length[last] + 1)
        self.link[there] = part
        while last >= 0 and self.next[last].get(word) == there:
            self.next[last][word] = part
            last = self.link[last]
        return part

    def repeats(self, document, words: list[bytes], width: int) -> Iterator[tuple[int, int]]:
        """Spans of ``width`` words that a document before ``document`` has."""
        moves, link, length, first = self.next, self.link, self.length, self.first
        state = matched = 0
        for place, word in enumerate(words, 1):
            there = moves[state].get(word)
            while there is None and state:
                state = link[state]
                matched = length[state]
                there = moves[state].get(word)
            if there is None:
                matched = 0
                continue
            state, matched = there, matched + 1
            if matched >= width:
                holder = state
                while length[link[holder]] >= width:
                    holder = link[holder]
                if first[holder] < document:
                    yield place - width, place


def _grown(starts: list[int], width: int) -> list[tuple[int, int]]:
    return merged([(s, s + width) for s in starts])


def find_repeats(df: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_doc, _hash, spans): stretches of words to remove, as start and end in turn, of the documents that have any.

    ``_doc`` is the id and ``_hash`` the text's xxhash64, which tells rows of one id apart. Rows with a null id neither lose words
    nor make others lose any.
    """
    ids, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    docs = df.where(ids.isNotNull() & text.isNotNull()).select(ids.alias("_doc"), F.xxhash64(text).alias("_hash"), text.alias("_text"))

    def sample(texts):
        words = Words(texts, lower=False)
        runs = words.runs(ANCHOR)
        return [[
            _signed(np.unique(runs[words.first[r] + np.unique(anchors(words, r, width, runs))])) if words.counts[r] >= width else []
            for r in range(len(texts))
        ]]

    sampled = computed(docs, ["_text"], "keys array<long>", sample, keep=["_doc", "_hash"])
    keys = sampled.select("_doc", "_hash", F.explode("keys").alias("key"))
    shared = keys.groupBy("key").agg(F.min("_doc").alias("a"), F.max("_doc").alias("b")).where(F.col("a") < F.col("b")).select("key")
    # Stored, so that the join has two plain sides and the rows of a hot key can be split.
    shared = written(shared, "shared")
    wanted = written(keys.join(shared, "key").groupBy("_doc", "_hash").agg(F.collect_set("key").alias("keys")), "anchors")
    values = wanted.agg(F.sum(F.size("keys") + 2)).first()[0] or 0

    def prints(keys, texts):
        words = Words(texts, lower=False)
        # Two independent fingerprints: one of 64 bits would be shared by different windows of a corpus of many billions.
        runs, wide, more = words.runs(ANCHOR), words.runs(width), words.runs(width, SECOND)
        starts, hashes, others = [], [], []
        for r in range(len(texts)):
            at = words.first[r]
            under = np.isin(_signed(runs[at + anchors(words, r, width, runs)]), keys[r].values.to_numpy())
            found = np.flatnonzero(under)
            starts.append(found.astype(np.int32))
            hashes.append(_signed(wide[at + found]))
            others.append(_signed(more[at + found]))
        return starts, hashes, others

    marked = computed(_by_document(docs, "_text", wanted, values), ["keys", "_text"], "starts array<int>, prints array<long>, others array<long>", prints, keep=["_doc", "_hash"])
    windows = marked.select("_doc", "_hash", F.explode(F.arrays_zip("starts", "prints", "others")).alias("w")).select(
        "_doc", "_hash", F.col("w.starts").alias("start"), F.col("w.prints").alias("print"), F.col("w.others").alias("other"))
    place = F.struct("_doc", "start", "_hash")
    first = windows.groupBy("print", "other").agg(F.min(place).alias("ref"), F.max("_doc").alias("last")).where(F.col("ref._doc") < F.col("last")).select("print", "other", "ref")
    first = written(first, "first")
    # A block of a reference document is the least that a shard holds.
    block = F.floor(F.col("ref.start") / SHARD_WORDS)
    hits = windows.join(first, ["print", "other"]).where((F.col("_doc") > F.col("ref._doc")) | (F.struct("_doc", "start", "_hash") == F.col("ref")))
    hits = hits.select("_doc", "_hash", "start", F.xxhash64(F.col("ref._doc"), F.col("ref._hash"), block).alias("block"), (F.col("_doc") == F.col("ref._doc")).alias("is_ref"))
    parts = written(hits.groupBy("_doc", "_hash", "block", "is_ref").agg(F.collect_list("start").alias("starts")), "windows")
    sizes = parts.groupBy("is_ref").agg(F.sum(F.size("starts")).alias("n")).collect()
    total = {r["is_ref"]: r["n"] for r in sizes}
    shards = -(-total.get(True, 0) // SHARD_WORDS) or 1
    parts = parts.withColumn("shard", F.pmod("block", F.lit(shards)))
    streamed = parts.where(~F.col("is_ref")).groupBy("shard").agg(F.ceil(F.sum(F.size("starts")) / STREAM_WINDOWS).alias("copies"))
    todo = parts.groupBy("_doc", "_hash", "shard", "is_ref").agg(F.sort_array(F.flatten(F.collect_list("starts"))).alias("starts"))
    per_document = todo.groupBy("_doc", "_hash").agg(
        F.collect_list("shard").alias("shards"), F.collect_list("is_ref").alias("refs"), F.collect_list("starts").alias("starts"))

    def cut(shards_, refs, starts, texts):
        out = [[], [], [], []]
        for row, t in enumerate(texts.to_pylist()):
            words = t.encode().split()
            made = [(s, ref, a, b" ".join(words[a:b])) for s, ref, at in zip(shards_[row].as_py(), refs[row].as_py(), starts[row].as_py(), strict=True)
                    for a, b in _grown(at, width)]
            for column, k in zip(out, range(4), strict=True):
                column.append([m[k] for m in made])
        return out

    passages = computed(
        _by_document(docs, "_text", per_document, sum(total.values())), ["shards", "refs", "starts", "_text"],
        "in_shard array<long>, ref array<boolean>, at array<int>, words array<binary>", cut, keep=["_doc", "_hash"],
    ).select("_doc", "_hash", F.explode(F.arrays_zip("in_shard", "ref", "at", "words")).alias("p")).select("_doc", "_hash", "p.*")
    dealt = passages.join(streamed.withColumnRenamed("shard", "in_shard"), "in_shard").withColumn(
        "copy", F.explode(F.when(F.col("ref"), F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).otherwise(
            F.array(F.pmod(F.xxhash64("_doc", "_hash"), F.col("copies"))))))

    def stream(group: pd.DataFrame) -> pd.DataFrame:
        reference = group[group["ref"]]
        automaton = Automaton([(d, w.split()) for d, w in zip(reference["_doc"], reference["words"], strict=True)])
        rows = []
        others = group[~group["ref"]]
        for document, hash_, at, words in zip(others["_doc"], others["_hash"], others["at"], others["words"], strict=True):
            spans = merged([(at + a, at + b) for a, b in automaton.repeats(document, words.split(), width)])
            if spans:
                rows.append((document, hash_, [x for span in spans for x in span]))
        return pd.DataFrame(rows, columns=["_doc", "_hash", "spans"])

    id_kind = docs.schema["_doc"].dataType.simpleString()
    found = dealt.groupBy("in_shard", "copy").applyInPandas(stream, f"_doc {id_kind}, _hash bigint, spans array<int>")
    return found.groupBy("_doc", "_hash").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def kept_words(text: str | None, spans: list[int] | None) -> tuple[list[bytes], int]:
    """Words that stay, and how many go."""
    words = text.encode().split() if text else []
    if not spans:
        return words, 0
    gone = np.zeros(len(words), dtype=bool)
    for start, end in zip(spans[::2], spans[1::2], strict=True):
        gone[start:end] = True
    return [w for w, g in zip(words, gone, strict=True) if not g], int(gone.sum())


def _with_repeats(df: DataFrame, width: int, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    """``df`` with a column of spans to remove, and that column's name."""
    spans = fresh(df, "spans")
    found = written(find_repeats(df, width, id_col, text_col), "repeats")
    values = found.agg(F.sum(F.size("spans") + 2)).first()[0] or 0
    doc, hash_ = fresh(df, "_doc"), fresh(df, "_hash")
    right = lookup(found.toDF(doc, hash_, spans), values, LOOKUP_VALUES)
    on = (F.col(f"`{id_col}`") == F.col(doc)) & (F.xxhash64(F.col(f"`{text_col}`")) == F.col(hash_))
    return df.join(right, on, "left").drop(doc, hash_), spans


def digest_repeats(df: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_removed, kept_sha256) of every row of ``df``: the contract's digest of what stays.

    A word goes when a window of ``width`` words over it also starts in a document with a smaller id; windows are those of
    the input. Null and empty texts have no words. Rows of one id are judged one by one and do not repeat each other; rows with a
    null id keep all words. An empty table gives no rows. Other columns are not read. Texts of any length are read whole.
    """
    import hashlib

    picked = df.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{text_col}`").alias("_text" if id_col != "_text" else "text"))
    text = picked.columns[1]
    joined, spans = _with_repeats(picked, width, id_col, text)

    def digest(spans_, texts):
        rows = []
        for text_, gone in zip(texts.to_pylist(), spans_.to_pylist(), strict=True):
            kept, removed = kept_words(text_, gone)
            rows.append((len(kept) + removed, removed, hashlib.sha256(b" ".join(kept)).hexdigest()))
        return list(zip(*rows, strict=True))

    return computed(joined, [spans, text], "n_words long, n_removed long, kept_sha256 string", digest, keep=[id_col])


def remove_repeats(df: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with repeated passages cut out; texts that lose words have the others joined by one space, and rows that lose all
    their words go. Everything else is unchanged; all columns are kept, in order. Cases as in ``digest_repeats``."""
    names = {c: f"_in{i}" for i, c in enumerate(df.columns)}
    text = names[text_col]
    joined, spans = _with_repeats(df.withColumnsRenamed(names), width, names[id_col], text)

    def cut(spans_, texts):
        return [[t if not s else b" ".join(kept_words(t, s)[0]).decode() for t, s in zip(texts.to_pylist(), spans_.to_pylist(), strict=True)]]

    clean = computed(joined, [spans, text], "kept string", cut)
    return clean.where(F.col(spans).isNull() | (F.col("kept") != "")).select(
        *(F.col("kept" if c == text_col else n).alias(c) for c, n in names.items()))
