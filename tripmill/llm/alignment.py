"""Alignment of two tokenizers' tokens over the same bytes, as an Arrow pipeline.

Texts are cut before single spaces, which no token of either vocabulary crosses, and the tokens of the words
are looked up in a table of lists. List flatten and parent indices turn a batch into plain arrays of tokens
with their document; segmented cumulative sums of byte lengths give the end of every token. Acero hash joins on
(document, end) put the two sides' ends together: ends that both have cut the document into groups, and the
intervals between neighbouring ends are exactly the pairs of tokens whose bytes overlap, one interval a pair.

Each document is read and aligned once, and stored with its groups and its id pairs, each pair once with its
number of links. Documents are dealt into classes of bounded size where they lie. `Table.group_by` counts the
id pairs of each class, Spark adds the partial counts of all classes up and answers every class with the
corpus-wide counts of its own pairs, so nothing is broadcast that grows with the corpus. The stored pairs then
meet the answers of their class.
"""

from __future__ import annotations

import itertools
import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.llm.common import stored

#: Bytes of text in a class, and in one step of the Arrow pipeline.
CLASS_BYTES = 64 << 20
STEP_BYTES = 1 << 20
#: Words, and tokens of words, that a task keeps.
CACHE_WORDS = 300_000
CACHE_TOKENS = 4_000_000
#: Keys are a document's place in a step, times this, plus a byte offset.
SPAN = 1 << 40

# Single spaces between two characters that are no white space. Before them a token of either side ends.
CUT = re.compile(r" (?<=\S )(?=\S)")
# How byte-level vocabularies cut a text into words, and how pieces write a space.
BYTE_LEVEL_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPACE = "▁"

NUMBERS = ("n_a", "n_b", "n_groups", "n_links")


def letter_bytes() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: visible ones themselves, the others from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


def lists_of(rows: list[list[int]]) -> pa.ListArray:
    ends = np.cumsum(np.fromiter(map(len, rows), np.int64, len(rows)))
    flat = np.fromiter(itertools.chain.from_iterable(rows), np.int32)
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), pa.array(flat))


def joined_bytes(values: pa.BinaryArray) -> bytes:
    """The values one after another; a taken array holds nothing else."""
    data = values.buffers()[2]
    return data.to_pybytes()[: pc.sum(pc.binary_length(values)).as_py() or 0] if data is not None else b""


class Pair:
    """The two tokenizers, the bytes of their tokens, and the tokens of words seen before.

    Side A reads a text with a space before it, side B adds that space itself.
    """

    def __init__(self, byte_path: str, piece_path: str) -> None:
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_path)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=piece_path)
        letters = letter_bytes()
        special = set(self.a.get_added_tokens_decoder())
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for entry, i in self.a.get_vocab().items():
            self.bytes_a[i] = entry.encode() if i in special else bytes(letters[c] for c in entry)
        self.ranked = self._ranked(json.loads(Path(byte_path).read_text()), special)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.bytes_b = [
            bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)
        ]
        # A piece with a space after another character would cross the cuts.
        self.crosses = any(SPACE in p.lstrip(SPACE) for p in pieces)
        self.length = {"a": np.array([*map(len, self.bytes_a)]), "b": np.array([*map(len, self.bytes_b)])}
        written = [
            *(f"{i}," for i in range(len(self.bytes_a))), *(f"{i}|" for i in range(len(self.bytes_a))),
            *(f"{i}," for i in range(len(self.bytes_b))), *(f"{i};" for i in range(len(self.bytes_b))),
        ]
        self.written = pa.array([w.encode() for w in written], pa.binary())
        self.known_bytes = {"a": pa.array(self.bytes_a, pa.binary()), "b": pa.array(self.bytes_b, pa.binary())}
        #: A pair of ids is one number.
        self.kind = np.dtype("<u4" if len(self.bytes_a) * len(self.bytes_b) <= 1 << 32 else "<u8")
        self._clear()

    def _ranked(self, described: dict, special: set[int]):
        """The same byte-level vocabulary in a faster form, if its ids are in the order of its merges; else None."""
        from tiktoken import Encoding

        vocabulary, split = described["model"]["vocab"], described.get("pre_tokenizer") or {}
        merges = [m.split(" ") if isinstance(m, str) else m for m in described["model"]["merges"]]
        merged = [vocabulary["".join(m)] for m in merges]
        plain = split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
        if not plain or described.get("normalizer") or merged != sorted(merged) or len(set(vocabulary.values()) - special) - len(merged) != 256:
            return None
        ranks = {b: i for i, b in enumerate(self.bytes_a) if i not in special}
        return Encoding("byte-level", pat_str=BYTE_LEVEL_WORDS, mergeable_ranks=ranks, special_tokens={})

    def _clear(self) -> None:
        self.place: dict[str, int] = {}
        self.table = {side: pa.array([], pa.list_(pa.int32())) for side in "ab"}

    def _lists_a(self, words: list[str]) -> pa.ListArray:
        """Ids of words, each with a space before it. Words that begin and end with a visible character go in one text."""
        if not self.ranked:
            return lists_of([e.ids for e in self.a.encode_batch([f" {w}" for w in words], add_special_tokens=False)])
        joined = [w for w in words if not (w[0].isspace() or w[-1].isspace())]
        ids = np.array(self.ranked.encode_ordinary(f" {' '.join(joined)}") if joined else [], np.int32)
        stops = np.cumsum([len(w.encode()) + 1 for w in joined], dtype=np.int64)
        at = np.searchsorted(np.cumsum(self.length["a"][ids]), stops, side="right")
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], at)), pa.int32()), pa.array(ids))
        if len(joined) == len(words):
            return lists
        each = iter(lists.to_pylist())
        return lists_of([self.ranked.encode_ordinary(f" {w}") if w[0].isspace() or w[-1].isspace() else next(each) for w in words])

    def _learn(self, new: list[str]) -> None:
        """Add the tokens of words; a word whose bytes a side does not give back gets none."""
        found = {"a": self._lists_a(new), "b": lists_of(self.b.encode(new, num_threads=1))}
        sizes = np.fromiter((len(w.encode()) + 1 for w in new), np.int64, len(new))
        whole = f" {' '.join(new)}".encode()
        good = np.ones(len(new), dtype=bool)
        for side, lists in found.items():
            ids = lists.flatten()
            ends = np.concatenate(([0], np.cumsum(self.length[side][np.asarray(ids)])))[np.asarray(lists.offsets)]
            given = joined_bytes(self.known_bytes[side].take(ids))
            if given != whole or not np.array_equal(np.diff(ends), sizes):
                good &= np.array([given[x:y] == f" {w}".encode() for w, x, y in zip(new, ends, ends[1:])])
        for side, lists in found.items():
            if not good.all():
                lists = lists_of([ids if g else [] for ids, g in zip(lists.to_pylist(), good)])
            self.table[side] = pa.concat_arrays([self.table[side], lists])
        self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))

    def tokens(self, texts: list[str | None]) -> dict[str, pa.ListArray]:
        """Lists of ids of each text, by side; empty where there is no text or its bytes are not given back."""
        words = [([t] if self.crosses else CUT.split(t)) if t else [] for t in texts]
        if len(self.place) > CACHE_WORDS or max(len(t.values) for t in self.table.values()) > CACHE_TOKENS:
            self._clear()
        flat = list(itertools.chain.from_iterable(words))
        places = list(map(self.place.get, flat))
        if None in places:
            self._learn(list(dict.fromkeys(w for w, at in zip(flat, places) if at is None)))
            places = map(self.place.__getitem__, flat)
        place = np.fromiter(places, np.int64, len(flat))
        parent = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
        empty = np.asarray(pc.equal(pc.list_value_length(self.table["a"]), 0))
        spoilt = np.bincount(parent[empty[place]], minlength=len(words)) > 0 if len(place) else np.zeros(len(words), bool)
        place, parent = place[~spoilt[parent]], parent[~spoilt[parent]]
        out = {}
        for side, table in self.table.items():
            lists = table.take(pa.array(place))
            lengths = np.asarray(pc.list_value_length(lists))
            ends = np.cumsum(np.bincount(parent, weights=lengths, minlength=len(words))).astype(np.int32)
            out[side] = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), lists.flatten())
        return out


_pairs: dict[tuple[str, str], Pair] = {}


def pair_of(byte_path: str, piece_path: str) -> Pair:
    """The two tokenizers, kept for the next tasks of a worker."""
    if (byte_path, piece_path) not in _pairs:
        _pairs[byte_path, piece_path] = Pair(byte_path, piece_path)
    return _pairs[byte_path, piece_path]


@dataclass
class Aligned:
    """Tokens and links of the documents of a step; links are in the order of their bytes."""

    ids: dict[str, np.ndarray]
    parents: dict[str, np.ndarray]
    #: Group of each token, by side, and of each link its document and the places of its two tokens.
    groups: dict[str, np.ndarray]
    group_parents: np.ndarray
    link_parents: np.ndarray
    links: dict[str, np.ndarray]

    def id_pairs(self, size_b: int) -> np.ndarray:
        """Both ids of each link in one number."""
        return self.ids["a"][self.links["a"]].astype(np.int64) * size_b + self.ids["b"][self.links["b"]]


def segmented_ends(lists: pa.ListArray, lengths: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Parent and end of each token: cumulative sums of lengths, counted anew in every document."""
    parents, ids = pc.list_parent_indices(lists), lists.flatten()
    sums = pc.cumulative_sum(pa.array(lengths).take(ids))
    starts = pc.cast(lists.offsets, pa.int64()).slice(0, len(lists))
    before = pa.concat_arrays([pa.array([0], sums.type), sums]).take(starts)
    return parents, pc.subtract(sums, before.take(parents))


def align(lists: dict[str, pa.ListArray], pair: Pair) -> Aligned:
    """Groups and links of the tokens of both sides, which cover the same bytes."""
    tables, parents = {}, {}
    for side, tokens in lists.items():
        parent, end = segmented_ends(tokens, pair.length[side])
        key = pc.add(pc.multiply(pc.cast(parent, pa.int64()), SPAN), pc.cast(end, pa.int64()))
        parents[side] = np.asarray(parent)
        tables[side] = pa.table({"key": key, side: pa.array(np.ones(len(key), np.int8))})
    joined = tables["a"].join(tables["b"], "key", join_type="full outer", use_threads=False).sort_by("key")
    ends = {side: np.asarray(joined[side].is_valid()).astype(np.int64) for side in lists}
    both = ends["a"] & ends["b"]
    group = np.cumsum(both) - both
    owner = np.asarray(joined["key"]) // SPAN
    return Aligned(
        ids={side: np.asarray(tokens.flatten()) for side, tokens in lists.items()},
        parents=parents,
        groups={side: group[ends[side] > 0] for side in lists},
        group_parents=owner[both > 0],
        link_parents=owner,
        links={side: np.cumsum(ends[side]) - ends[side] for side in lists},
    )


def written_groups(found: Aligned, pair: Pair, n: int) -> list[str]:
    """`a1,a2|b1;a3|b2,b3` of each document: ids of both sides by group."""
    groups = len(found.group_parents)
    up_to = {side: np.cumsum(np.bincount(g, minlength=groups)) for side, g in found.groups.items()}
    a, b = found.groups["a"], found.groups["b"]
    size_a, size_b = len(pair.bytes_a), len(pair.bytes_b)
    order = np.zeros(len(a) + len(b), dtype=np.int64)
    last_a = np.arange(1, len(a) + 1) == up_to["a"][a]
    last_b = np.arange(1, len(b) + 1) == up_to["b"][b]
    before = np.concatenate(([0], up_to["b"]))
    order[np.arange(len(a)) + before[a]] = found.ids["a"] + size_a * last_a
    order[np.arange(len(b)) + up_to["a"][b]] = found.ids["b"] + 2 * size_a + size_b * last_b
    text = pair.written.take(pa.array(order))
    per_document = sum(np.bincount(p, minlength=n) for p in found.parents.values())
    ends = np.frombuffer(text.buffers()[1], dtype=np.int32)[np.concatenate(([0], np.cumsum(per_document)))].tolist()
    whole = joined_bytes(text)
    return [whole[x : max(x, y - 1)].decode() for x, y in zip(ends, ends[1:])]


def steps(batch: pa.RecordBatch, text_column: str) -> Iterator[pa.RecordBatch]:
    """The batch in runs of about STEP_BYTES of text."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(text_column)), 0))
    number = np.cumsum(sizes) // STEP_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), batch.num_rows]
    for x, y in zip(cuts, cuts[1:]):
        if y > x:
            yield batch.slice(x, y - x)


def distinct_pairs(found: Aligned, pair: Pair, n: int) -> tuple[list[bytes], list[bytes]]:
    """Of each document its different id pairs and how many links hold each, as packed numbers."""
    pairs = found.id_pairs(len(pair.bytes_b))
    order = np.lexsort((pairs, found.link_parents))
    pairs, owner = pairs[order], found.link_parents[order]
    new = np.concatenate(([True], (pairs[1:] != pairs[:-1]) | (owner[1:] != owner[:-1])))[: len(pairs)]
    starts = np.flatnonzero(new)
    times = np.diff(np.concatenate((starts, [len(pairs)]))).astype("<u4")
    cuts = np.searchsorted(owner[starts], np.arange(n + 1)).tolist()
    pairs = pairs[starts].astype(pair.kind)
    return [pairs[x:y].tobytes() for x, y in zip(cuts, cuts[1:])], [times[x:y].tobytes() for x, y in zip(cuts, cuts[1:])]


def aligned_documents(docs: DataFrame, tokenizers: Callable[[], tuple[str, str]], id_column: str, text_column: str) -> DataFrame:
    """(class, id, n_a, n_b, n_groups, n_links, groups, pairs, times); classes are runs of a task's documents."""
    schema = T.StructType(
        [
            T.StructField("class", T.LongType()),
            T.StructField("id", docs.schema[id_column].dataType),
            *(T.StructField(c, T.LongType()) for c in NUMBERS),
            T.StructField("groups", T.StringType()),
            T.StructField("pairs", T.BinaryType()),
            T.StructField("times", T.BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, first, size = pair_of(*tokenizers()), TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            for step in steps(batch, "text"):
                n = step.num_rows
                found = align(pair.tokens(step.column("text").to_pylist()), pair)
                size += pc.sum(pc.binary_length(step.column("text"))).as_py() or 0
                owners = (found.parents["a"], found.parents["b"], found.group_parents, found.link_parents)
                pairs, times = distinct_pairs(found, pair, n)
                columns = [pa.array(np.full(n, first + size // CLASS_BYTES), pa.int64()), step.column("id")]
                columns += [pa.array(np.bincount(o, minlength=n), pa.int64()) for o in owners]
                columns += [pa.array(written_groups(found, pair, n), pa.string()), pa.array(pairs, pa.binary()), pa.array(times, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    rows = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    return rows.mapInArrow(run, schema)


def unpacked(column: pa.Array, kind: str | np.dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).astype(np.int64)


def counted_pairs(rows: DataFrame, tokenizers: Callable[[], tuple[str, str]]) -> DataFrame:
    """(class, pair, b, n): how many links of a class hold a pair of ids; a class has a row per pair and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(*tokenizers())
        kept: list[pa.Table] = []
        now = None

        def add_up() -> None:
            added = pa.concat_tables(kept).group_by("pair", use_threads=False).aggregate([("n", "sum")])
            kept[:] = [pa.table({"pair": added["pair"], "n": added["n_sum"]})]

        def flush() -> Iterator[pa.RecordBatch]:
            if kept:
                add_up()
                table = kept.pop().combine_chunks()
                own = pa.array(np.full(len(table), now), pa.int64())
                b = pa.array(np.asarray(table["pair"]) % len(pair.bytes_b), pa.int64())
                whole = pa.table({"class": own, "pair": table["pair"], "b": b, "n": table["n"]})
                yield from whole.to_batches(max_chunksize=1 << 17)

        for batch in batches:
            for own in dict.fromkeys(batch.column("class").to_pylist()):
                if own != now:
                    yield from flush()
                    now = own
                part = batch.filter(pc.equal(batch.column("class"), own))
                kept.append(pa.table({"pair": unpacked(part.column("pairs"), pair.kind), "n": unpacked(part.column("times"), "<u4")}))
                if sum(map(len, kept[1:])) > len(kept[0]) + (1 << 20):
                    add_up()
        yield from flush()

    return rows.select("class", "pairs", "times").mapInArrow(run, "class long, pair long, b long, n long")


def corpus_counts(partial: DataFrame) -> DataFrame:
    """(pair, total, best): links of each id pair in the corpus, and whether no pair with its B id has more."""
    total = partial.groupBy("pair", "b").agg(F.sum("n").alias("total"))
    # One row per B id: bounded by the vocabulary.
    most = total.groupBy("b").agg(F.max("total").alias("most"))
    return total.join(F.broadcast(most), "b").select("pair", "total", (F.col("total") == F.col("most")).alias("best"))


def align_tokens(
    docs: DataFrame,
    tokenizers: Callable[[], tuple[str, str]],
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep: Callable[[Column], Column] = lambda groups: groups,
) -> DataFrame:
    """Per row of docs its id, n_a, n_b, n_groups, n_links, groups, n_best and count_sum.

    groups are the ids of both sides by group, or what `keep` makes of them before they are stored. `tokenizers`
    gives the paths of a byte-level vocabulary (side A) and of a piece model (side B) where the tasks run. A pair's
    count is its number of links in the whole table; n_best are links whose count no pair with the same B id
    exceeds. Null and empty texts, and texts that a side does not give back byte by byte, have no tokens: zeros
    and empty groups. Repeated rows count and stay; other columns are ignored. A document is aligned in one
    step, so memory grows with the longest one.
    """
    read = aligned_documents(docs, tokenizers, id_column, text_column)
    rows = stored(read.withColumn("groups", keep(F.col("groups"))), "aligned", compression="zstd")
    partial = stored(counted_pairs(rows, tokenizers), "pair-counts")
    answers = partial.select("class", "pair").distinct().join(corpus_counts(partial), "pair")
    # The answers of a class come before its documents, so a task holds those of one class and a batch.
    given = answers.select("class", F.lit(False).alias("is_text"), "pair", "total", "best")
    together = given.unionByName(rows.withColumn("is_text", F.lit(True)), allowMissingColumns=True)
    together = together.repartition("class").sortWithinPartitions("class", "is_text")
    kept = [f for f in rows.schema if f.name not in ("class", "pairs", "times")]
    schema = T.StructType(
        [*(T.StructField(id_column if f.name == "id" else f.name, f.dataType) for f in kept), T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(*tokenizers())
        known: list[pa.RecordBatch] | None = []
        now, codes, totals, best = None, *[np.zeros(0, np.int64)] * 3
        for batch in batches:
            for own in dict.fromkeys(batch.column("class").to_pylist()):
                part = batch.filter(pc.equal(batch.column("class"), own))
                if own != now:
                    now, known = own, []
                is_text = part.column("is_text")
                if (given := part.filter(pc.invert(is_text))).num_rows:
                    known.append(given.select(["pair", "total", "best"]))
                if not (texts := part.filter(is_text)).num_rows:
                    continue
                if known is not None:
                    found = pa.Table.from_batches(known).sort_by("pair") if known else None
                    codes, totals, best = (np.asarray(found[c]) if found else np.zeros(0, np.int64) for c in ("pair", "total", "best"))
                    known = None
                times = unpacked(texts.column("times"), "<u4")
                at = np.searchsorted(codes, unpacked(texts.column("pairs"), pair.kind))
                ends = np.cumsum(np.asarray(pc.binary_length(texts.column("times"))).astype(np.int64) // 4)
                sums = [added_up(times * best[at], ends), added_up(times * totals[at], ends)]
                columns = [*(texts.column(f.name) for f in kept), *(pa.array(c, pa.int64()) for c in sums)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return together.mapInArrow(run, schema)


def added_up(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Exact sums of whole numbers up to each end from the one before."""
    return np.diff(np.concatenate(([0], np.cumsum(values, dtype=np.int64)))[np.concatenate(([0], ends))])
