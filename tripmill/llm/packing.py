"""Packing of tokenised documents into windows of fixed length, with bounded memory.

Each partition reads its documents once. It keeps a fixed number of open windows; a document goes
into the open window that it fills best. When none has room, the fullest window is emitted and a
new one is opened. A document longer than a window is cut into full windows and a rest. If the
fullest window still has a gap worth filling when it is emitted, the head of the document fills it.
What is open at the end of each partition is merged: the pieces of up to MERGE_PARTITIONS partitions
are placed anew by decreasing size into the tightest window that has room.

State per task is OPEN_WINDOWS windows and a bounded cache of words, whatever the input.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tripmill.llm.common import stored

WINDOW = 4096
OPEN_WINDOWS = 16
MIN_CUT = 32
MERGE_PARTITIONS = 16
CACHE_PIECES = 250_000
EOS = 2
PIECES_PER_BATCH = 500

PIECE = [
    T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()),
    T.StructField("doc_tokens", T.LongType()),
    T.StructField("ids", T.BinaryType()),
    T.StructField("sequence_id", T.LongType()),
    T.StructField("offset", T.LongType()),
]


# How the vocabulary splits plain text, after lower-casing, and the letters it is plain with.
PIECE_PATTERN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")
NOT_PLAIN = re.compile(r"[^\t-\r\x20-\x7eÀ-ÖØ-öø-ÿ]")
WHITE = re.compile(r"[\t-\r\x20]+")


def byte_letters() -> dict[int, str]:
    """How byte-level vocabularies write the UTF-8 bytes of the plain non-ASCII letters.

    Visible Latin-1 bytes stand for themselves; the others follow from 256 on, in their order.
    """
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    written = {b: chr(b) for b in visible}
    written |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in written)}
    return {c: "".join(written[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}


class WordEncoder:
    """Ids of a text as little-endian 32-bit bytes, with the ids of each piece of a word kept.

    The vocabulary merges within pieces: runs of letters, digits, runs of other signs. Plain texts are cut
    into pieces here and only unseen pieces go to the model. Words with any other character go through
    the whole tokenizer; words are split at ASCII white space, at which pieces end in any case. A text with
    the string of a special token goes through the tokenizer as a whole, which reads it as that token.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        self.known: dict[str, bytes] = {}

    def _learn(self, pieces: list[str]) -> None:
        if len(self.known) > CACHE_PIECES:
            self.known = {}
        for piece in pieces:
            if piece not in self.known:
                written = piece if piece.isascii() else piece.translate(self.letters)
                self.known[piece] = np.array([t.id for t in self.model.tokenize(written)], dtype="<u4").tobytes()

    def plain(self, text: str) -> bytes:
        pieces = PIECE_PATTERN.findall(text.lower())
        try:
            return b"".join(map(self.known.__getitem__, pieces))
        except KeyError:
            self._learn(pieces)
            return b"".join(map(self.known.__getitem__, pieces))

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        lower = text.lower()
        if any(s in lower for s in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        if not NOT_PLAIN.search(text):
            return self.plain(text)
        return b"".join(
            np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()
            if NOT_PLAIN.search(word)
            else self.plain(word)
            for word in WHITE.split(text)
        )


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The encoder of a vocabulary, kept for the next tasks of a worker."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


class Packer:
    """Best-fit packing with a fixed number of open windows.

    `add` returns the pieces whose windows are closed as (window, offset, piece); `rest` returns
    those of the open windows. A piece is (document, start, length).
    """

    def __init__(self, window: int = WINDOW, open_windows: int = OPEN_WINDOWS, min_cut: int = MIN_CUT) -> None:
        self.window, self.limit, self.min_cut = window, open_windows, min_cut
        self.gaps: list[tuple[int, int]] = []  # (gap, window), sorted
        self.pieces: dict[int, list[tuple[int, tuple]]] = {}
        self.next = 0

    def _open(self) -> int:
        self.next += 1
        self.pieces[self.next - 1] = []
        return self.next - 1

    def _put(self, number: int, gap: int, piece: tuple) -> int:
        self.pieces[number].append((self.window - gap, piece))
        return gap - piece[2]

    def _close(self, number: int) -> list[tuple[int, int, tuple]]:
        return [(number, offset, piece) for offset, piece in self.pieces.pop(number)]

    def add(self, document, length: int) -> list[tuple[int, int, tuple]]:
        done: list[tuple[int, int, tuple]] = []
        start = 0
        while length - start >= self.window:
            number = self._open()
            self._put(number, self.window, (document, start, self.window))
            done += self._close(number)
            start += self.window
        left = length - start
        if not left:
            return done
        at = bisect.bisect_left(self.gaps, (left, -1))
        if at == len(self.gaps):
            if len(self.gaps) == self.limit:
                gap, fullest = self.gaps.pop(0)
                if gap >= self.min_cut:
                    self._put(fullest, gap, (document, start, gap))
                    start, left = start + gap, left - gap
                done += self._close(fullest)
                at = bisect.bisect_left(self.gaps, (left, -1))
            if at == len(self.gaps):
                bisect.insort(self.gaps, (self.window, self._open()))
                at = bisect.bisect_left(self.gaps, (left, -1))
        gap, number = self.gaps.pop(at)
        gap = self._put(number, gap, (document, start, left))
        if gap:
            bisect.insort(self.gaps, (gap, number))
        else:
            done += self._close(number)
        return done

    def rest(self) -> list[tuple[int, int, tuple]]:
        return [x for number in sorted(self.pieces) for x in self._close(number)]


def place_pieces(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Window and offset of each piece: longest first, each into the tightest window with room."""
    gaps: list[tuple[int, int]] = []
    places = np.zeros((2, len(lengths)), dtype=np.int64)
    opened = 0
    for i in np.argsort(-lengths, kind="stable"):
        need = int(lengths[i])
        at = bisect.bisect_left(gaps, (need, -1))
        if at == len(gaps):
            gap, number = window, opened
            opened += 1
        else:
            gap, number = gaps.pop(at)
        places[:, i] = number, window - gap
        if gap > need:
            bisect.insort(gaps, (gap - need, number))
    return places[0], places[1]


def pack(
    docs: DataFrame,
    tokenizer_path: Callable[[], str],
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    window: int = WINDOW,
    open_windows: int = OPEN_WINDOWS,
    min_cut: int = MIN_CUT,
    eos: int = EOS,
) -> DataFrame:
    """One row per piece of a document: its ids and its place in a sequence.

    Every id of every document lies in exactly one piece. A null or empty text is the end mark
    alone. Rows are packed one by one, so repeated rows and null ids are kept apart. Sequence ids are
    unique but not consecutive. `tokenizer_path` is called where the tasks run.
    """
    id_type = docs.schema[id_column].dataType
    schema = T.StructType(
        [T.StructField(id_column, id_type), *PIECE, T.StructField("__part", T.IntegerType()), T.StructField("__open", T.BooleanType())]
    )
    arrow_id = to_arrow_type(id_type)
    names = [f.name for f in schema]
    types = [arrow_id, pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.bool_()]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows) if rows else [[] for _ in names]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encode, packer = encoder(tokenizer_path()), Packer(window, open_windows, min_cut)
        end = np.array([eos], dtype="<u4").tobytes()
        rows: list[tuple] = []

        def row(number: int, offset: int, piece: tuple, is_open: bool) -> tuple:
            (key, ids), start, length = piece
            return (key, start, length, len(ids) // 4, ids[4 * start : 4 * (start + length)], (part << 32) | number, offset, part, is_open)

        for arrived in batches:
            for key, text in zip(arrived.column(0).to_pylist(), arrived.column(1)):
                ids = encode(text.as_py()) + end
                rows += [row(*x, False) for x in packer.add((key, ids), len(ids) // 4)]
                if len(rows) >= PIECES_PER_BATCH:
                    yield batch(rows)
                    rows = []
        rows += [row(*x, True) for x in packer.rest()]
        if rows:
            yield batch(rows)

    pieces = stored(docs.select(F.col(f"`{id_column}`"), F.col(f"`{text_column}`")).mapInArrow(run, schema), "pieces")

    def merge(open_pieces: pd.DataFrame) -> pd.DataFrame:
        open_pieces = open_pieces.sort_values(["__part", "sequence_id", "offset"], kind="stable").reset_index(drop=True)
        number, offset = place_pieces(open_pieces["length"].to_numpy(), window)
        base = (1 << 62) | (int(open_pieces["__part"].iloc[0]) // MERGE_PARTITIONS) << 32
        return open_pieces.assign(sequence_id=base + number, offset=offset)

    # At most MERGE_PARTITIONS * open_windows windows meet in a group.
    merged = (
        pieces.filter("__open")
        .groupBy(F.expr(f"__part div {MERGE_PARTITIONS}"))
        .applyInPandas(merge, schema)
    )
    return pieces.filter("NOT __open").unionByName(merged).drop("__part", "__open")
