"""Removal of word sequences that stand earlier in the corpus.

A window is ``WINDOW`` consecutive words of one document. Its anchor is the phrase of
``PHRASE`` words in it with the smallest hash, so all occurrences of a window have the
same anchor in the same place.

1. Documents are dealt into shards of bounded size, once for all steps. Each shard tells
   which anchors it has; those that occur twice in all are recurring phrases.
2. A shard's recurring phrases are compiled into an Aho-Corasick automaton over its word numbers, which is run over
   every document of the shard. Where it locates the anchor of a window, the window may
   recur: its hash and first document in the shard are sent to be compared.
3. Of each window the first document of all keeps it; the other shards are told.
4. Words under a window that stands earlier, in the shard or elsewhere, are removed.

Hashes travel as byte strings of many numbers, grouped by the part of the hash space
that compares them. A shard sends a window once (an anchor twice at most), so no part
meets more of one window than there are shards, however often the window occurs.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarack.llm.words import WORD, gram_hashes, utf8, word_hashes

WINDOW = 20
PHRASE = 6
SHARD_BYTES = 8 << 20  # of text in a shard, about
DIGITS = 3
_LAST = np.iinfo(np.int64).max  # orders rows without doc_id after all others


class Shard:
    """Word hashes of texts laid end to end; ``starts`` are the places of the texts, and the end."""

    def __init__(self, texts: list[bytes | None], window: int, phrase: int):
        self.window, self.phrase = window, phrase
        hashes = [word_hashes(WORD.findall(t)) if t else np.zeros(0, np.uint64) for t in texts]
        self.starts = np.concatenate([[0], np.cumsum([len(h) for h in hashes], dtype=np.int64)]).astype(np.int64)
        self.words = np.concatenate([np.zeros(0, np.uint64), *hashes])
        ends = np.repeat(self.starts[1:], np.diff(self.starts))
        #: Places at which a window starts that lies within one text.
        self.places = np.flatnonzero(np.arange(len(self.words)) + window <= ends)

    def text_of(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, places, side="right") - 1

    def windows(self) -> np.ndarray:
        """Hash of the window at each of ``places``."""
        return gram_hashes(self.words, self.window)[self.places] if len(self.places) else np.zeros(0, np.uint64)

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all phrases, and for each window the place of its anchor (the first of equal ones)."""
        if not len(self.places):
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        grams = gram_hashes(self.words, self.phrase)
        view = sliding_window_view(grams, self.window - self.phrase + 1)
        at = np.empty(len(self.places), np.int64)
        for lo in range(0, len(at), 1 << 17):  # bounds the copy of the view
            places = self.places[lo : lo + (1 << 17)]
            at[lo : lo + (1 << 17)] = places + view[places[0] : places[-1] + 1].argmin(1)[places - places[0]]
        return grams, at

    def located(self, phrases: np.ndarray) -> np.ndarray:
        """Whether each window's anchor is one of the recurring ``phrases``, found by an automaton."""
        grams, at = self.anchors()
        found = np.zeros(len(self.words), bool)
        if not len(at) or not len(phrases):
            return found[at] if len(at) else np.zeros(0, bool)
        places = np.unique(at)
        places = places[np.isin(grams[places], phrases)]
        places = places[np.unique(grams[places], return_index=True)[1]]
        spans = places[:, None] + np.arange(self.phrase)
        symbols = _symbols(self.words, np.unique(self.words[spans]))
        automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH, ahocorasick.KEY_SEQUENCE)
        for row in symbols[spans].reshape(len(spans), -1).tolist():
            automaton.add_word(tuple(row))
        if not len(automaton):
            return found[at]
        automaton.make_automaton()
        for lo, hi in zip(self.starts[:-1].tolist(), self.starts[1:].tolist(), strict=True):
            if hi - lo >= self.window:
                ends = [end for end, _ in automaton.iter(tuple(symbols[lo:hi].ravel().tolist()))]
                found[lo + np.array(ends, np.int64) // DIGITS - (self.phrase - 1)] = True
        return found[at]


def _symbols(words: np.ndarray, known: np.ndarray) -> np.ndarray:
    """A row of ``DIGITS`` symbols per word: its number among the sorted ``known`` words, 0 for others.

    A node of the automaton searches its children one by one, so a word is written in
    few-valued digits. Each digit has symbols of its own, so a match starts at a word.
    """
    at = np.minimum(np.searchsorted(known, words), len(known) - 1)
    numbers = np.where(known[at] == words, at + 1, 0)
    base = int(np.ceil((len(known) + 1) ** (1 / DIGITS))) + 1
    return np.stack([numbers // base ** (DIGITS - 1 - i) % base + i * base for i in range(DIGITS)], 1)


def _longs(data: list[bytes], kind=np.uint64) -> np.ndarray:
    return np.frombuffer(b"".join(data), kind)


def _split(by: np.ndarray, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """Numbers below ``parts`` that occur in ``by``, and where."""
    order = np.argsort(by, kind="stable")
    cuts = np.searchsorted(by[order], np.arange(parts + 1))
    for p in np.flatnonzero(np.diff(cuts)).tolist():
        yield p, order[cuts[p] : cuts[p + 1]]


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else [()] * len(schema)
    return pa.table([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


_SENT = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("hashes", pa.binary()), ("docs", pa.binary())])
_BACK = pa.schema([("shard", pa.int32()), ("hashes", pa.binary())])


def _shard_of(shards: int) -> Column:
    """Rows of a doc_id share a shard; rows without one are dealt by their text."""
    known = F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id")).otherwise(F.xxhash64("text"))
    return F.pmod(known, F.lit(shards)).cast("int")


def _ordered(table: pa.Table) -> tuple[np.ndarray, list[bytes | None], np.ndarray]:
    """Doc ids and texts of a shard in corpus order, and the rows they come from."""
    keys = table["doc_id"].fill_null(_LAST).to_numpy()
    texts = utf8(table["text"].combine_chunks())
    order = sorted(range(len(keys)), key=lambda r: (keys[r], texts[r] is not None, texts[r] or b""))
    return keys[order], [texts[r] for r in order], np.array(order, np.int64)


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, phrase: int = PHRASE, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """doc_id, n_words, n_removed and kept (the words that stay, joined by one blank) of every row.

    ``docs`` has doc_id and text; words are runs of characters other than blank and the
    control characters 9 to 13, unchanged. A word is removed if a window over it has
    the same words as one that starts earlier: in a smaller doc_id, or earlier in the
    same document. Windows are judged on the input, not on what is left. Texts that
    are null, empty or shorter than a window keep all words. Rows that repeat a doc_id
    follow each other in the order of their texts. Rows without doc_id come after all
    others and are not compared with each other, only each with itself. Other columns are ignored. Windows are
    compared by 64-bit hashes.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 64)).first()[0] or 0
    shards = max(1, -(-size // shard_bytes))
    docs = docs.withColumn("shard", _shard_of(shards))

    def count_anchors(texts: pa.Table) -> pa.Table:
        shard = Shard(utf8(texts["text"].combine_chunks()), window, phrase)
        grams, at = shard.anchors()
        once, n = np.unique(grams[np.unique(at)], return_counts=True)
        found = np.concatenate([once, once[n > 1]])  # two tell as much as more
        home = texts["shard"][0].as_py()
        part = (found % np.uint64(shards)).astype(np.int64)
        return _table([(p, home, found[i].tobytes(), b"") for p, i in _split(part, shards)], _SENT)

    def recurring(table: pa.Table) -> pa.Table:
        grams = _longs(table["hashes"].to_pylist())
        home = np.repeat(table["shard"].to_numpy(), [len(h) // 8 for h in table["hashes"].to_pylist()])
        order = np.argsort(grams, kind="stable")
        grams, home = grams[order], home[order]
        again = np.zeros(len(grams), bool)
        again[1:] = grams[1:] == grams[:-1]
        again[:-1] |= again[1:]
        grams, home = grams[again], home[again]
        return _table([(p, np.unique(grams[i]).tobytes()) for p, i in _split(home, shards)], _BACK)

    sent = "part int, shard int, hashes binary, docs binary"
    back = "shard int, hashes binary"
    anchors = docs.groupBy("shard").applyInArrow(count_anchors, sent)
    phrases = anchors.groupBy("part").applyInArrow(recurring, back)

    def locate(texts: pa.Table, told: pa.Table) -> pa.Table:
        if not texts.num_rows or not told.num_rows:
            return _table([], _SENT)
        ids, bodies, _ = _ordered(texts)
        shard = Shard(bodies, window, phrase)
        maybe = np.flatnonzero(shard.located(_longs(told["hashes"].to_pylist())))
        hashes, first = np.unique(shard.windows()[maybe], return_index=True)
        owner = ids[shard.text_of(shard.places[maybe[first]])]
        order = np.argsort(owner, kind="stable")  # runs of one id take little room
        hashes, owner = hashes[order], owner[order]
        home = texts["shard"][0].as_py()
        part = (hashes % np.uint64(shards)).astype(np.int64)
        return _table([(p, home, hashes[i].tobytes(), owner[i].tobytes()) for p, i in _split(part, shards)], _SENT)

    def later(table: pa.Table) -> pa.Table:
        sizes = [len(h) // 8 for h in table["hashes"].to_pylist()]
        home = np.repeat(table["shard"].to_numpy(), sizes)
        hashes, owner = _longs(table["hashes"].to_pylist()), _longs(table["docs"].to_pylist(), np.int64)
        order = np.lexsort((owner, hashes))
        hashes, owner, home = hashes[order], owner[order], home[order]
        new = np.ones(len(hashes), bool)
        new[1:] = hashes[1:] != hashes[:-1]
        smallest = owner[np.flatnonzero(new)[np.cumsum(new) - 1]]
        beaten = owner > smallest
        return _table([(p, hashes[beaten][i].tobytes()) for p, i in _split(home[beaten], shards)], _BACK)

    def cut(texts: pa.Table, told: pa.Table) -> pa.Table:
        ids, bodies, order = _ordered(texts)
        shard = Shard(bodies, window, phrase)
        hashes = shard.windows()
        gone = np.isin(hashes, _longs(told["hashes"].to_pylist()))
        if len(hashes):
            _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
            first = first[which]
            text = shard.text_of(shard.places)
            without = ids[text] == _LAST
            earlier = first != np.arange(len(hashes))
            gone |= earlier & ~(without & without[first])
            # Rows without doc_id are not compared with each other, but each with itself.
            alone = np.flatnonzero(without)
            again = np.ones(len(alone), bool)
            again[np.unique(text[alone] * len(hashes) + which[alone], return_index=True)[1]] = False
            gone[alone[again]] = True
        marks = np.zeros(len(shard.words) + 1, np.int32)
        np.add.at(marks, shard.places[gone], 1)
        np.add.at(marks, shard.places[gone] + window, -1)
        keep = np.cumsum(marks[:-1]) == 0
        rows = []
        for r, body, lo, hi in zip(order.tolist(), bodies, shard.starts[:-1].tolist(), shard.starts[1:].tolist(), strict=True):
            words = WORD.findall(body) if body else []
            own = keep[lo:hi]
            if not own.all():
                words = [w for w, stays in zip(words, own.tolist(), strict=True) if stays]
            rows.append((texts["doc_id"][r].as_py(), hi - lo, hi - lo - len(words), b" ".join(words).decode()))
        kinds = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])
        return _table(rows, kinds)

    windows = docs.groupBy("shard").cogroup(phrases.groupBy("shard")).applyInArrow(locate, sent)
    repeats = windows.groupBy("part").applyInArrow(later, back)
    final = "doc_id long, n_words long, n_removed long, kept string"
    return docs.groupBy("shard").cogroup(repeats.groupBy("shard")).applyInArrow(cut, final)
