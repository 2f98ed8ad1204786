"""SentencePiece encoding and decoding by a streaming Viterbi search.

The search walks a text once. For every end position it keeps one survivor: the
last piece of the best segmentation up to there, and where that piece starts. Any
later piece starts within the longest piece's length of the front, so only the
paths that end in that window are alive. Where all of them pass through one
boundary, the ids up to it are final: they are committed and forgotten. Some such
boundaries show in the text itself, as no piece reaches over them; the window is
emptied there, and what a stretch between two of them gave is remembered.

Two objectives choose the survivor. ``unigram`` takes the largest sum of scores.
``bpe`` takes the only piece that byte-pair merging can leave there: a
segmentation is what merging gives exactly if each two neighbours stay apart when
merged on their own, and every prefix of a text has just one such segmentation.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLANK = "▁"  # stands for a blank inside pieces
CACHED = 150_000  # segments whose ids a worker remembers
PART = 1024  # texts that are held as Python objects at once


class _Remembered(dict):
    """Ids by segment, filled on demand: two generations, of which the older goes when the younger is full."""

    def __init__(self, search, limit: int):
        super().__init__()
        self.search, self.limit, self.older = search, limit, {}

    def __missing__(self, segment: str) -> tuple[int, ...]:
        ids = self.older.pop(segment, None)
        if ids is None:
            ids = tuple(self.search(segment))
        if len(segment) <= 32:
            if len(self) >= self.limit:
                self.older = dict(self)
                self.clear()
            self[segment] = ids
        return ids


def _segments(pieces: Iterable[str], classes: int = 3) -> re.Pattern | None:
    """Cuts a text where every path has a boundary, whatever stands on either side.

    No piece reaches over a place where a blank follows another character, nor over one
    between two characters that are in no way linked by standing side by side in pieces.
    None if pieces hold blanks after other characters.
    """
    above: dict[str, str] = {}

    def top(c: str) -> str:
        above.setdefault(c, c)
        while above[c] != c:
            above[c] = above[above[c]]
            c = above[c]
        return c

    for piece in pieces:
        body = piece.lstrip(BLANK)
        if BLANK in body:
            return None
        for a, b in zip(body, body[1:]):
            above[top(a)] = top(b)
    groups: dict[str, list[str]] = {}
    for c in above:
        groups.setdefault(top(c), []).append(c)
    largest = sorted((g for g in groups.values() if len(g) > 1), key=len)[::-1][:classes]
    own = ["".join(map(re.escape, sorted(g))) for g in largest]
    rest = f"[^{BLANK}{''.join(own)}]"
    return re.compile("|".join([*(f"{BLANK}*[{g}]+" for g in own), f"{BLANK}*{rest}+", f"{BLANK}+"]))


class PieceModel:
    """A piece vocabulary, and the search over it. ``objective``: 'bpe' or 'unigram'."""

    def __init__(self, model: bytes, objective: str = "bpe", cached: int = CACHED):
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = sp.get_piece_size()
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) for i in range(size)]
        pieces = [sp.id_to_piece(i) for i in range(size)]
        self.ids = {p: i for i, p in enumerate(pieces) if not special[i]}
        self.scores = [sp.get_score(i) for i in range(size)]
        self.bytes = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.unknown = sp.unk_id()
        self.falls_back = all(sp.is_byte(i) for i in self.bytes)
        self.longest = max(map(len, self.ids), default=1)
        # Every end of a piece, with the piece's id where it is one: how far back to look.
        self.ends = {p[k:]: -1 for p in self.ids for k in range(1, len(p))} | self.ids
        self.worst = min((self.scores[i] for i in self.ids.values()), default=0.0) - 10.0
        self.objective = objective
        self._segments = _segments(self.ids)
        self.shown = [b"" if special[i] else p.replace(BLANK, " ").encode() for i, p in enumerate(pieces)]
        self.shown[self.unknown] = "⁇".encode()
        if self.falls_back:
            for b, i in enumerate(self.bytes):
                self.shown[i] = bytes([b])
        self._apart: list[dict[int, bool]] = [{} for _ in range(size)]
        self._whole: dict[int, bool] = {}
        self._remembered = _Remembered(self.search, cached)
        self.pieces = pieces

    # -- objective 'bpe'

    def _merge(self, text: str) -> list[str]:
        """Byte-pair merging of a short text: the best pair first, the leftmost of equal ones."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                i = self.ids.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or self.scores[i] > best):
                    best, at = self.scores[i], k
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _stays(self, i: int) -> bool:
        """Whether merging a piece's characters gives the piece."""
        known = self._whole.get(i)
        if known is None:
            known = self._whole[i] = len(self._merge(self.pieces[i])) == 1
        return known

    def _stay_apart(self, a: int, b: int) -> bool:
        """Whether merging the text of two pieces gives these two."""
        known = self._apart[a].get(b)
        if known is None:
            known = self._merge(self.pieces[a] + self.pieces[b]) == [self.pieces[a], self.pieces[b]]
            self._apart[a][b] = known
        return known

    # -- the search

    def search(self, text: str, report: list[int] | None = None) -> list[int]:
        """Ids of a text in which blanks are already ``BLANK``.

        The window is walked back for a boundary that all its paths share whenever it has grown by four
        times the longest piece, and committed up to there; the rest at the end of the text, which is such
        a boundary. ``report`` gets the window's size at each of these.
        """
        out: list[int] = []
        # Index k of these is position start + k; a negative survivor is an unknown character.
        start, survivor, back, best = 0, [-1], [0], [0.0]
        front, every, length = 0, 4 * self.longest, len(text)
        advance = self._by_score if self.objective == "unigram" else self._by_merging
        while True:
            end = min(front + every, length)
            advance(text, front, end, start, survivor, back, best)
            front = end
            if report is not None:
                report.append(len(survivor))
            if front == length:
                return out + self._path(survivor, back, start, front)
            cut = self._meeting(back, start, front)
            if cut > start:
                out += self._path(survivor, back, start, cut)
                drop = cut - start
                del survivor[:drop], back[:drop], best[:drop]
                start = cut

    def _meeting(self, back: list[int], start: int, front: int) -> int:
        """The last boundary that all paths to the positions a later piece can start from go through."""
        live = set(range(max(start, front - self.longest + 1), front + 1))
        while len(live) > 1:
            last = max(live)
            live.add(back[last - start] if last > start else start)
            live.discard(last)
        return live.pop()

    def _by_merging(self, text: str, front: int, end: int, start: int, survivor: list[int], back: list[int], _) -> None:
        """Survivors of the positions after ``front`` up to ``end``: the only piece that merging can leave."""
        get, apart = self.ends.get, self._apart
        for i in range(front + 1, end + 1):
            piece, at = -1, i - 1
            for j in range(i - 1, start - 1, -1):
                t = get(text[j:i])
                if t is None:  # no piece ends so
                    break
                if t >= 0:
                    left = survivor[j - start]
                    ok = apart[left].get(t) if left >= 0 else self._stays(t)
                    if ok is None:
                        ok = self._stay_apart(left, t)
                    if ok:
                        piece, at = t, j
                        break
            survivor.append(piece if piece >= 0 else -1 - ord(text[i - 1]))
            back.append(at)

    def _by_score(
        self, text: str, front: int, end: int, start: int, survivor: list[int], back: list[int], best: list[float]
    ) -> None:
        """Survivors of the positions after ``front`` up to ``end``: the last piece of the largest sum."""
        get, scores = self.ends.get, self.scores
        for i in range(front + 1, end + 1):
            piece, at, value = -1, i - 1, None
            for j in range(i - 1, start - 1, -1):
                t = get(text[j:i])
                if t is None:
                    break
                if t >= 0:
                    v = best[j - start] + scores[t]
                    if value is None or v >= value:
                        piece, at, value = t, j, v
            survivor.append(piece if piece >= 0 else -1 - ord(text[i - 1]))
            back.append(at)
            best.append(best[at - start] + self.worst if value is None else value)

    def _path(self, survivor: list[int], back: list[int], start: int, end: int) -> list[int]:
        found = []
        while end > start:
            found.append(survivor[end - start])
            end = back[end - start]
        out: list[int] = []
        for t in reversed(found):
            if t >= 0:
                out.append(t)
            else:
                out += self._fallback(chr(-1 - t))
        return out

    def _fallback(self, char: str) -> list[int]:
        if not self.falls_back:
            return [self.unknown]
        return [self.bytes[b] for b in char.encode("utf-8", "replace")]

    # -- texts

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text, one blank put in front; none for an empty text."""
        if not text:
            return np.zeros(0, np.int32)
        if BLANK in text:  # a character of the text like any other, not a blank
            parts = text.split(BLANK)
            mark = np.array(self._fallback(BLANK), np.int32)
            found = [self._encode(BLANK + parts[0].replace(" ", BLANK))]
            for part in parts[1:]:
                found += [mark, self._encode(part.replace(" ", BLANK))]
            return np.concatenate(found)
        return self._encode(BLANK + text.replace(" ", BLANK))

    def _encode(self, escaped: str) -> np.ndarray:
        segments = self._segments.findall(escaped) if self._segments else [escaped]
        return np.fromiter(chain.from_iterable(map(self._remembered.__getitem__, segments)), np.int32)

    def decode(self, ids: list[int]) -> str:
        """The text of ids, without the blank that encoding puts in front."""
        if ids and (min(ids) < 0 or max(ids) >= len(self.shown)):
            ids = [i for i in ids if 0 <= i < len(self.shown)]
        body = b"".join(map(self.shown.__getitem__, ids))
        return (body[1:] if body[:1] == b" " else body).decode("utf-8", "replace")


def _model_of(spark, path: str):
    """The model's bytes (a vocabulary file of fixed size), sent once to every executor."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


@lru_cache(maxsize=2)  # the two objectives
def _loaded(model: bytes, objective: str = "bpe") -> PieceModel:
    """One model per worker process, which keeps what it has learned for the tasks that follow."""
    return PieceModel(model, objective)


def _ids_column(found: list[np.ndarray | None]) -> pa.Array:
    sizes = [0 if f is None else len(f) for f in found]
    flat = np.concatenate([np.zeros(0, np.int32), *(f for f in found if f is not None)])
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
    nulls = pa.array([f is None for f in found], pa.bool_())
    return pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int32()), mask=nulls)


def _add(docs: DataFrame, source: str, model, kinds: dict[str, str], work) -> DataFrame:
    """Add the columns ``kinds`` that ``work(pieces, values of source)`` makes, in small parts."""
    docs = docs.drop(*kinds)
    at = docs.columns.index(source)
    schema = docs.select("*", *[F.lit(None).cast(kind).alias(name) for name, kind in kinds.items()]).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, PART):
                part = batch.slice(lo, PART)
                made = work(model.value, part.column(at).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns, *made], names=[*batch.schema.names, *kinds])

    return docs.mapInArrow(run, schema)


def encode_pieces(
    docs: DataFrame, path: str, text: str = "text", ids: str = "ids", objective: str = "bpe"
) -> DataFrame:
    """Add the column ``ids`` (array of int) with the piece ids of ``text``.

    ``path`` is a SentencePiece model that the driver can read. White space is kept as
    it is. A null text has null ids, an empty one none. A column already named ``ids``
    is replaced; all others, repeated rows included, pass through. The character
    U+2581 is encoded by its bytes, so that every text can be decoded to itself.
    """

    def work(model, texts):
        pieces = _loaded(model, objective)
        return [_ids_column([None if t is None else pieces.encode(t) for t in texts])]

    return _add(docs, text, _model_of(docs.sparkSession, path), {ids: "array<int>"}, work)


def decode_pieces(docs: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add the column ``text`` with the text of the piece ids; null for null ids.

    Ids that the model does not have, and null ones, add nothing. A column already
    named ``text`` is replaced; all others pass through.
    """

    def work(model, rows):
        pieces = _loaded(model)
        return [pa.array([None if r is None else pieces.decode([i for i in r if i is not None]) for r in rows], pa.string())]

    return _add(docs, ids, _model_of(docs.sparkSession, path), {text: "string"}, work)


def round_trip(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """:func:`encode_pieces` and :func:`decode_pieces` in one pass over the texts."""

    def work(model, texts):
        pieces = _loaded(model)
        found = [None if t is None else pieces.encode(t) for t in texts]
        back = [None if f is None else pieces.decode(f.tolist()) for f in found]
        return [_ids_column(found), pa.array(back, pa.string())]

    return _add(docs, text, _model_of(docs.sparkSession, path), {ids: "array<int>", decoded: "string"}, work)
