"""Tokens of two tokenizers aligned by interval coalescing.

Both tokenizers cut the same bytes into intervals. All intervals of both, sorted by start,
are coalesced: the running maximum of their ends is taken, and a group ends where a start
reaches it. So groups end where a token of A and a token of B end together. Within groups
the overlapping pairs are expanded; two cuts of the same bytes have fewer overlaps than tokens.

Pairs that end together are the links of a document. Of two tokens that end together one is a
suffix of the other, so the vocabularies alone bound the different links: no more than one for
each suffix of each token (about half a million here), however large the corpus. That is why
corpus counts are an array with a place for each of them, added up per task and sent to all.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.llm.words import utf8
from tamarack.session import materialize, spread

CHUNK = 1 << 18  # bytes of text that are aligned at once; a longer text is a chunk of its own
BYTE_PIECE = re.compile(r"<0x([0-9A-Fa-f]{2})>")
BLANK = "▁"


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 characters stand for themselves, the others for the letters from
    U+0100 on, in order.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


def expanded(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, number) for every whole number from lo to hi (exclusive) of every row."""
    n = np.maximum(hi - lo, 0)
    row = np.repeat(np.arange(len(n)), n)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + lo[row]


def coalesced(
    a_start: np.ndarray, a_end: np.ndarray, b_start: np.ndarray, b_end: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The group of every A and of every B interval, numbered from 0 in order of start.

    The intervals of a side are sorted and not empty.
    """
    if not len(a_start) + len(b_start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts, ends = np.concatenate([a_start, b_start]), np.concatenate([a_end, b_end])
    order = np.argsort(starts, kind="stable")  # merges the two sorted sides, A first
    reach = np.maximum.accumulate(ends[order])
    group = np.empty(len(order), np.int64)
    group[order] = np.concatenate([[0], np.cumsum(starts[order][1:] >= reach[:-1])])
    return group[: len(a_start)], group[len(a_start) :]


def reached(places: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """How many of the sorted ``places`` are at or before each limit, from a running count over all bytes."""
    size = int(max(places.max(initial=0), limits.max(initial=0))) + 1
    return np.cumsum(np.bincount(places, minlength=size))[limits]


class Vocabularies:
    """Two tokenizers, the bytes of their tokens, and every pair of tokens that can end together."""

    def __init__(self, a_json: bytes, b_model: bytes):
        self.a = tokenizers.Tokenizer.from_str(a_json.decode("utf-8"))
        self.a.encode_special_tokens = True  # their strings are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        letters = byte_letters()
        self.a_bytes = [b""] * self.a.get_vocab_size(with_added_tokens=True)
        for token, i in self.a.get_vocab(with_added_tokens=True).items():
            known = all(c in letters for c in token)
            self.a_bytes[i] = bytes(letters[c] for c in token) if known else token.encode()
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            byte = BYTE_PIECE.fullmatch(piece) if self.b.is_byte(i) else None
            self.b_bytes.append(bytes([int(byte[1], 16)]) if byte else piece.replace(BLANK, " ").encode())
        self.b_spelt = np.array(self.b_bytes, object)
        self.a_size = np.array([len(t) for t in self.a_bytes], np.int64)
        self.b_size = np.array([len(t) for t in self.b_bytes], np.int64)
        self.pairs = self._pairs()
        # What a token adds to the line of its document: within its group, and as the last of its side.
        self.a_written = np.array([f"{i}{c}" for i in range(len(self.a_bytes)) for c in ",|"], object)
        self.b_written = np.array([f"{i}{c}" for i in range(len(self.b_bytes)) for c in ",;"], object)

    def _pairs(self) -> np.ndarray:
        """Sorted codes of the pairs of which one token is a suffix of the other."""
        width, found = len(self.b_bytes), set()
        for tokens, others, code in (
            (self.a_bytes, self.b_bytes, lambda i, j: i * width + j),
            (self.b_bytes, self.a_bytes, lambda j, i: i * width + j),
        ):
            ids: dict[bytes, list[int]] = {}
            for j, other in enumerate(others):
                ids.setdefault(other, []).append(j)
            for i, token in enumerate(tokens):
                for k in range(len(token)):
                    found.update(code(i, j) for j in ids.get(token[k:], ()))
        return np.array(sorted(found), np.int64)

    def tokenized(self, texts: list[bytes | None]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """A and B ids of every text; None where there is no text or the tokens do not spell it."""
        shown = []
        for t in texts:
            try:
                shown.append(t.decode("utf-8") if t else "")
            except UnicodeDecodeError:
                shown.append("")
        wanted = [i for i, t in enumerate(shown) if t]
        made_a = self.a.encode_batch_fast([" " + shown[i] for i in wanted], add_special_tokens=False)
        made_b = self.b.encode([shown[i] for i in wanted], num_threads=1, return_type="numpy")
        out: list[tuple[np.ndarray, np.ndarray] | None] = [None] * len(texts)
        for i, a, b in zip(wanted, made_a, made_b, strict=True):
            first, second, whole = np.array(a.ids, np.int64), b.astype(np.int64), b" " + texts[i]
            # Byte-level tokens are bytes of the text, in order: they spell it if none is missing.
            if self.a_size[first].sum() == len(whole) and b"".join(self.b_spelt[second].tolist()) == whole:
                out[i] = first, second
        return out


class Aligned:
    """The tokens of many texts, one text after the other, with their groups and overlaps."""

    def __init__(self, words: Vocabularies, texts: list[bytes | None]):
        found = words.tokenized(texts)
        none = np.zeros(0, np.int64)
        self.words, self.n = words, len(texts)
        self.a_count = np.array([len(f[0]) if f else 0 for f in found], np.int64)
        self.b_count = np.array([len(f[1]) if f else 0 for f in found], np.int64)
        self.a = np.concatenate([none, *(f[0] for f in found if f)])
        self.b = np.concatenate([none, *(f[1] for f in found if f)])
        a_size, b_size = words.a_size[self.a], words.b_size[self.b]
        # Both sides spell the same bytes, so a text's tokens start and end with its bytes on either side.
        self.a_end, self.b_end = np.cumsum(a_size), np.cumsum(b_size)
        self.a_start, self.b_start = self.a_end - a_size, self.b_end - b_size
        self.a_group, self.b_group = coalesced(self.a_start, self.a_end, self.b_start, self.b_end)
        groups = int(self.a_group[-1]) + 1 if len(self.a) else 0
        self.a_in = np.bincount(self.a_group, minlength=groups)  # A tokens of every group
        self.b_in = np.bincount(self.b_group, minlength=groups)
        self.text_of_group = np.zeros(groups, np.int64)
        self.text_of_group[self.a_group] = np.repeat(np.arange(self.n), self.a_count)
        self.group_count = np.bincount(self.text_of_group, minlength=self.n)

    def overlaps(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of the A and B tokens that share bytes: for every A token a run of B tokens of its group."""
        first = np.cumsum(self.b_in) - self.b_in
        lo = np.maximum(reached(self.b_end, self.a_start), first[self.a_group])
        hi = np.minimum(reached(self.b_start, self.a_end - 1), (first + self.b_in)[self.a_group])
        return expanded(lo, hi)

    def lines(self) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` for every text: the ids of its groups."""
        groups = len(self.a_in)
        if not groups:
            return [""] * self.n
        a_last = np.append(self.a_group[1:] != self.a_group[:-1], True)
        b_last = np.append(self.b_group[1:] != self.b_group[:-1], True)
        line = np.empty(len(self.a) + len(self.b), object)
        # The A tokens of a group come before its B tokens.
        before_b = np.cumsum(self.a_in)
        before_a = np.cumsum(self.b_in) - self.b_in
        line[np.arange(len(self.a)) + before_a[self.a_group]] = self.words.a_written[2 * self.a + a_last]
        line[np.arange(len(self.b)) + before_b[self.b_group]] = self.words.b_written[2 * self.b + b_last]
        ends = np.cumsum(self.a_count + self.b_count).tolist()
        parts = line.tolist()
        return ["".join(parts[lo:hi])[:-1] for lo, hi in zip([0, *ends], ends, strict=False)]

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, number of the pair, times) of the overlapping tokens that end together."""
        i, j = self.overlaps()
        together = self.a_end[i] == self.b_end[j]
        i, j = i[together], j[together]
        span = len(self.words.a_bytes) * len(self.words.b_bytes)
        code = self.a[i] * len(self.words.b_bytes) + self.b[j]
        text = self.text_of_group[self.a_group[i]]
        both, times = np.unique(text * span + code, return_counts=True)
        text = both // span
        return text, np.searchsorted(self.words.pairs, both - text * span), times


@lru_cache(maxsize=1)
def _loaded(a_json: bytes, b_model: bytes) -> Vocabularies:
    """One pair of tokenizers per worker process, of one thread: tasks are what runs in parallel."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Vocabularies(a_json, b_model)


def _sent(spark, a_path: str, b_path: str):
    """The files of both tokenizers (of fixed size), read by the driver and sent once to every executor."""
    files = []
    for path in (a_path, b_path):
        with open(path, "rb") as f:
            files.append(f.read())
    return spark.sparkContext.broadcast(tuple(files))


def chunks(texts: list[bytes | None], size: int = CHUNK) -> Iterator[slice]:
    """Consecutive texts of about ``size`` bytes together."""
    lo = held = 0
    for i, t in enumerate(texts):
        held += len(t or b"")
        if held >= size:
            yield slice(lo, i + 1)
            lo, held = i + 1, 0
    if lo < len(texts):
        yield slice(lo, len(texts))


def _lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType = pa.int32()) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def _over_texts(docs: DataFrame, key: str, text: str, sent, schema: str, work) -> DataFrame:
    """``key`` and the columns that ``work(Aligned)`` makes of every row's text."""
    rows = docs.select(F.col(key).alias("__key"), F.col(text).cast("string").alias("__text"))
    kind = rows.schema["__key"].dataType.simpleString()
    names = ["__key", *[c.strip().split(" ")[0] for c in schema.split(", ")]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _loaded(*sent.value)
        for batch in batches:
            texts = utf8(batch.column(1))
            for part in chunks(texts):
                made = work(Aligned(words, texts[part]))
                keys = batch.column(0).slice(part.start, part.stop - part.start)
                yield pa.RecordBatch.from_arrays([keys, *made], names=names)

    return spread(rows, "__key").mapInArrow(run, f"__key {kind}, {schema}")


def align(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, a_ids, b_ids, a_sizes, b_sizes, a_over and b_over of every row.

    ``a_path`` is a byte-level vocabulary, ``b_path`` a SentencePiece model that adds a blank
    in front; both files are read by the driver. a_sizes and b_sizes are the numbers of tokens in
    every group, a_over and b_over the places (from 0) of the tokens that overlap, pair by pair.
    Texts that are null, empty, not UTF-8, or that the tokens of a side do not spell (with a blank
    in front) have no tokens. Strings of special tokens are plain text. Rows are not joined: null and
    repeated keys stay as they are, further columns are not looked at.
    """

    def work(found: Aligned) -> list[pa.Array]:
        i, j = found.overlaps()
        a_first = np.cumsum(found.a_count) - found.a_count
        b_first = np.cumsum(found.b_count) - found.b_count
        text_of = found.text_of_group[found.a_group[i]]
        n_over = np.bincount(text_of, minlength=found.n)
        return [
            _lists(found.a, found.a_count),
            _lists(found.b, found.b_count),
            _lists(found.a_in, found.group_count),
            _lists(found.b_in, found.group_count),
            _lists(i - a_first[text_of], n_over),
            _lists(j - b_first[text_of], n_over),
        ]

    columns = "a_ids array<int>, b_ids array<int>, a_sizes array<int>, b_sizes array<int>, a_over array<int>, b_over array<int>"
    sent = _sent(docs.sparkSession, a_path, b_path)
    return _over_texts(docs, key, text, sent, columns, work).withColumnRenamed("__key", key)


def linked(docs: DataFrame, sent, key: str, text: str) -> DataFrame:
    """__key, n_a, n_b, n_groups, n_links, groups_sha256, and links: pair numbers with times."""

    def work(found: Aligned) -> list[pa.Array]:
        of, pair, times = found.links()
        hashed = [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in found.lines()]
        n_pairs = np.bincount(of, minlength=found.n)
        n_links = np.bincount(of, weights=times, minlength=found.n).astype(np.int64)
        return [
            pa.array(found.a_count),
            pa.array(found.b_count),
            pa.array(found.group_count.astype(np.int64)),
            pa.array(n_links),
            pa.array(hashed, pa.string()),
            _lists(pair, n_pairs),
            _lists(times, n_pairs),
        ]

    columns = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pair array<int>, times array<int>"
    return _over_texts(docs, key, text, sent, columns, work)


def pair_counts(links: DataFrame, sent) -> DataFrame:
    """pair and n: how many links of the corpus hold it. A task sends one row per pair at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(_loaded(*sent.value).pairs), np.int64)
        for batch in batches:
            pair = batch.column(0).flatten().to_numpy()
            if len(pair):
                at, where = np.unique(pair, return_inverse=True)
                times = batch.column(1).flatten().to_numpy()
                counts[at] += np.bincount(where, weights=times).astype(np.int64)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(counts[held])], names=["pair", "n"])

    partial = links.select("pair", "times").mapInArrow(run, "pair int, n long")
    return partial.groupBy("pair").agg(F.sum("n").alias("n"))


def link_report(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row.

    n_best counts the links whose pair is linked as often in the corpus as any pair with the same
    B id; count_sum adds up the corpus counts over the links. Rows without tokens (see
    :func:`align`) have zeros and an empty string. Every row counts, repeated ones too.
    """
    spark = docs.sparkSession
    sent = _sent(spark, a_path, b_path)
    words = _loaded(*sent.value)
    links = materialize(linked(docs, sent, key, text), "links")
    counts = np.zeros(len(words.pairs), np.int64)
    # No more rows than there are pairs of tokens that end alike, whatever the corpus.
    counted = pair_counts(links, sent).toArrow()
    counts[counted["pair"].to_numpy()] = counted["n"].to_numpy()
    b_of = words.pairs % len(words.b_bytes)
    highest = np.zeros(len(words.b_bytes), np.int64)
    np.maximum.at(highest, b_of, counts)
    shared = spark.sparkContext.broadcast((counts, counts == highest[b_of]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count_of, best = shared.value
        for batch in batches:
            pair, times = batch.column("pair"), batch.column("times").flatten().to_numpy().astype(np.int64)
            row = np.repeat(np.arange(batch.num_rows), pair.value_lengths().to_numpy())
            pair = pair.flatten().to_numpy()
            n_best, total = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            np.add.at(n_best, row, times * best[pair])
            np.add.at(total, row, times * count_of[pair])
            kept = {name: batch.column(name) for name in ("__key", "n_a", "n_b", "n_groups", "n_links")}
            yield pa.RecordBatch.from_pydict(
                kept | {"n_best": n_best, "count_sum": total, "groups_sha256": batch.column("groups_sha256")}
            )

    kind = links.schema["__key"].dataType.simpleString()
    schema = f"__key {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return links.mapInArrow(run, schema).withColumnRenamed("__key", key)
