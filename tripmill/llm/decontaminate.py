"""Benchmark decontamination by latent semantic retrieval with an exact check after it.

Documents are cut into overlapping windows of words, as long as the benchmark items they may hold. Over the
words of the benchmark a TF-IDF matrix of passages is reduced by a randomised SVD: each task multiplies its
passages with a random matrix and back, and Spark adds up the sketches. This is done twice, from a random
start and from the result, and a Nystroem step on the driver turns the sum, of fixed size, into the leading
right singular vectors. Items and windows are compared by the cosine of their latent vectors, each divided
by the root of its singular value. A window near an item is then checked word by word: enough of the item's words must
occur in it, and their longest common subsequence must hold most of the item, or a good part of it and the
item's answer. Words of many passages have no weight in the latent space. An item of which fewer than half the
words have weight cannot be told there, so it is sought exactly instead: every copy has one of its rarest words.
Items shorter than MIN_ITEM_WORDS are copied only as they are, so their whole run of words is sought.

The benchmark's items are rows of that matrix too, with as much weight as all passages, so that the space
holds what tells them apart. Words outside the benchmark cannot count for an item, so they only keep their
places. Document frequencies and both sketches take all passages of all documents, and every window of every
document is searched with the basis fitted on them.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tripmill.llm.common import add_vectors, stored

RANK = 128
OVERSAMPLING = 32
#: Words on a larger share of passages say nothing about what a passage is from, and have no weight.
COMMON_SHARE = 0.1
SEED = 7
#: So many of the most frequent words are multiplied as a matrix.
FREQUENT = 256
#: Limits nothing: the basis is fitted on all documents. Only a test from before still sets this number.
FIT_DOCUMENTS = 40_000
BLOCK = 16
PASSAGE_BLOCKS = 4
MIN_COSINE = 0.2
#: Weight of the benchmark's own rows in the matrix, against all passages together.
BENCHMARK_WEIGHT = 1.0
#: Bytes of the table of words by window that a task holds at a time.
PRESENCE_BYTES = 32 << 20
FULL_COVERAGE = 0.8
PART_COVERAGE = 0.6
ANSWER_COVERAGE = 0.8
#: Shorter items count only as a whole run of words, followed or preceded in its window by the answer, if one is given.
MIN_ITEM_WORDS = 8
#: Items with a smaller share of words with weight are sought by their words.
MARK_SHARE = 0.5
#: A window with this part of the words that a copy must have is looked at with half a window more on both sides.
NEARLY = 0.75
#: Numbers in the sketch of a benchmark, words by columns, that a task and the driver hold.
MAX_SKETCH = 1 << 26
#: The benchmark is held by every task. A larger one has to be checked in parts.
MAX_BENCHMARK_BYTES = 32 << 20
WORDS_PER_STEP = 150_000
RUN_BASE = np.uint64(0x9E3779B97F4A7C15)
WORD = re.compile(r"[^\W_]+")
SENTENCE = re.compile(r"(?<=[.!?])\s+")


def words_of(text: str | None) -> list[str]:
    """Lower-case runs of letters and digits."""
    return WORD.findall((text or "").lower())


#: In texts of single-byte characters, what is no letter or digit becomes a space.
LATIN_WORDS = bytes(c if chr(c).isalnum() else 32 for c in range(256))


def is_latin(text: str) -> bool:
    return not text or max(text) < "\u0100"


def fast_words(text: str | None) -> list[str] | list[bytes]:
    """The words of `words_of`, as single-byte text where the text allows it."""
    lower = (text or "").lower()
    try:
        return lower.encode("latin-1").translate(LATIN_WORDS).split()
    except UnicodeEncodeError:
        return WORD.findall(lower)


def lcs_length(item: list[int], words: list[int]) -> int:
    """Length of the longest common subsequence, one bit per word of the item."""
    masks: dict[int, int] = {}
    for i, w in enumerate(item):
        masks[w] = masks.get(w, 0) | 1 << i
    full = (1 << len(item)) - 1
    state = full
    for w in words:
        mask = masks.get(w)
        if mask:
            both = state & mask
            state = ((state + both) | (state - both)) & full
    return len(item) - state.bit_count()


def run_codes(ids: np.ndarray, length: int) -> np.ndarray:
    """A hash of each run of `length` numbers."""
    n = max(0, len(ids) - length + 1)
    out = np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(length):
            out = out * RUN_BASE + ids[k : k + n].astype(np.uint64)
    return out


class Benchmark:
    """Items as numbers of their words, from 1; 0 stands for any other word."""

    def __init__(self, rows: list[tuple[int, str | None, str | None]]) -> None:
        kept = [(i, words_of(t), words_of(a) if a else self.last_sentence(t)) for i, t, a in sorted(rows, key=repr)]
        kept = [(i, w, a) for i, w, a in kept if w]
        self.vocabulary = {w: n + 1 for n, w in enumerate(sorted({w for _, ws, a in kept for w in [*ws, *a]}))}
        self.ids = [i for i, _, _ in kept]
        self.items = [[self.vocabulary[w] for w in ws] for _, ws, _ in kept]
        self.answers = [[self.vocabulary[w] for w in a] for _, _, a in kept]
        self.size = len(self.vocabulary) + 1
        self.scratch = np.zeros(self.size, dtype=bool)
        # Blocks of a window for each item: twice its length, so that half-overlapping windows hold all of it.
        need = [max(2, 2 ** (2 * len(ws) - 1).bit_length() // BLOCK) for ws in self.items]
        long = [len(ws) >= MIN_ITEM_WORDS for ws in self.items]
        self.by_blocks = {m: some for m in sorted(set(need)) if (some := [i for i, n in enumerate(need) if n == m and long[i]])}
        self.lengths = np.array([len(ws) for ws in self.items], dtype=np.int64)
        self.short: dict[int, dict[int, list[int]]] = {}
        for i, ws in enumerate(self.items):
            if not long[i]:
                code = int(run_codes(np.array(ws), len(ws))[0])
                self.short.setdefault(len(ws), {}).setdefault(code, []).append(i)

    def gram(self, idf: np.ndarray, test: np.ndarray) -> tuple[np.ndarray, float]:
        """B'B times a matrix, for B the TF-IDF rows of the items, and the squared size of B."""
        out, size = np.zeros(test.shape), 0.0
        for ws in self.items:
            words, counts = np.unique(ws, return_counts=True)
            row = counts * idf[words]
            out[words] += row[:, None] * (row @ test[words])
            size += float(row @ row)
        return out, size

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Each item's words, filled up with 0, and how many of them a copy must have."""
        words = np.zeros((len(self.items), max([1, *self.lengths])), dtype=np.int64)
        for i, ws in enumerate(self.items):
            words[i, : len(ws)] = ws
        return words, PART_COVERAGE * self.lengths - 1e-9

    def marks(self, weighty: np.ndarray, counts: np.ndarray) -> dict[int, list[int]]:
        """Items with too few words of weight, by words of which every copy has one: the item's rarest.

        A copy lacks a bounded number of the item's words, so one more than that are enough.
        """
        out: dict[int, list[int]] = {}
        for i, ws in enumerate(self.items):
            if len(ws) < MIN_ITEM_WORDS or weighty[ws].mean() >= MARK_SHARE:
                continue
            lacking = len(ws) - int(np.ceil(PART_COVERAGE * len(ws) - 1e-9))
            for w in sorted(set(sorted(ws, key=lambda w: (counts[w], w))[: lacking + 1])):
                out.setdefault(w, []).append(i)
        return out

    def whole_runs(self, ids: np.ndarray, owner: np.ndarray) -> Iterator[tuple[int, int]]:
        """(document, item) of short items whose words stand in a document one after another."""
        for length, items in self.short.items():
            codes = run_codes(ids, length)
            for at in np.flatnonzero(np.isin(codes, np.array(list(items), dtype=np.uint64))).tolist():
                if owner[at] == owner[at + length - 1]:
                    for i in items[int(codes[at])]:
                        if ids[at : at + length].tolist() == self.items[i] and self.answered(i, ids, owner, at):
                            yield int(owner[at]), i

    def answered(self, item: int, ids: np.ndarray, owner: np.ndarray, at: int) -> bool:
        """Whether the answer of a short item is near its run, in the same document."""
        answer, reach = self.answers[item], 2 * BLOCK
        near = slice(max(0, at - reach), at + len(self.items[item]) + reach)
        around = ids[near][owner[near] == owner[at]].tolist()
        return lcs_length(answer, around) >= ANSWER_COVERAGE * len(answer)

    def judge_near(self, item: int, words: np.ndarray, width: int) -> float:
        """The largest share that `judge` gives any run of `width` words."""
        most = self.judge(item, words)
        if not most or len(words) <= width:
            return most
        best, before = 0.0, -1
        for at in np.flatnonzero(self.is_in(item, words)).tolist():
            at = min(at, len(words) - width)
            if at > before:
                best, before = max(best, self.judge(item, words[at : at + width])), at
                if best >= most:
                    break
        return best

    def is_in(self, item: int, words: np.ndarray) -> np.ndarray:
        """Which of the words are words of the item."""
        self.scratch[self.items[item]] = True
        found = self.scratch[words]
        self.scratch[self.items[item]] = False
        return found

    @staticmethod
    def last_sentence(text: str | None) -> list[str]:
        parts = [w for w in map(words_of, SENTENCE.split(text or "")) if w]
        return parts[-1] if parts else []

    def judge(self, item: int, words: np.ndarray) -> float:
        """Share of the item found in the words, or 0 if that does not make them a copy."""
        shared = words[self.is_in(item, words)].tolist()
        coverage = lcs_length(self.items[item], shared) / len(self.items[item])
        if coverage >= FULL_COVERAGE:
            return coverage
        answer = self.answers[item]
        if coverage >= PART_COVERAGE and answer and lcs_length(answer, words.tolist()) >= ANSWER_COVERAGE * len(answer):
            return coverage
        return 0.0


def read_benchmark(benchmark: DataFrame) -> Benchmark:
    """Items with item_id, text and, if there is one, answer; without it the last sentence counts as answer."""
    answer = F.col("answer") if "answer" in benchmark.columns else F.lit(None).cast("string")
    items = benchmark.select("item_id", "text", answer.alias("answer"))
    size = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    if size > MAX_BENCHMARK_BYTES:
        raise ValueError(f"benchmark of {size} bytes: check it in parts of at most {MAX_BENCHMARK_BYTES}")
    known = Benchmark([tuple(r) for r in items.collect()])
    if known.size * (RANK + OVERSAMPLING) > MAX_SKETCH:
        raise ValueError(f"benchmark of {known.size} words: check it in parts of at most {MAX_SKETCH // (RANK + OVERSAMPLING)}")
    return known


def encoded(docs: DataFrame, known: Benchmark, id_column: str, text_column: str) -> DataFrame:
    """(id, text_hash, ids): the numbers of each document's words, stored, as texts are not needed again."""
    numbers = known.vocabulary | {w.encode("latin-1"): n for w, n in known.vocabulary.items() if is_latin(w)}
    shared = docs.sparkSession.sparkContext.broadcast(numbers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, zero = shared.value.get, itertools.repeat(0)
        for batch in batches:
            words = [fast_words(t) for t in batch.column(2).to_pylist()]
            ids = np.fromiter(map(number, itertools.chain.from_iterable(words), zero), dtype="<i4")
            ends = np.cumsum([0, *map(len, words)]) * 4
            packed = pa.BinaryArray.from_buffers(pa.binary(), len(words), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(ids)])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), packed], names=["id", "text_hash", "ids"])

    rows = docs.select(
        F.col(f"`{id_column}`").alias("id"), F.xxhash64(F.coalesce(F.col(f"`{text_column}`"), F.lit(""))).alias("text_hash"), F.col(f"`{text_column}`")
    )
    schema = T.StructType(
        [T.StructField("id", docs.schema[id_column].dataType), T.StructField("text_hash", T.LongType()), T.StructField("ids", T.BinaryType())]
    )
    return stored(rows.mapInArrow(run, schema), "encoded")


def padded(batch: pa.RecordBatch) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """Documents in runs of bounded length: their rows, all words in whole blocks, and each one's blocks."""

    def joined(rows: list[int], parts: list[np.ndarray]) -> tuple[list[int], np.ndarray, np.ndarray]:
        blocks = np.array([-(-len(p) // BLOCK) for p in parts])
        ids = np.zeros(int(blocks.sum()) * BLOCK, dtype=np.int64)
        for at, p in zip((np.cumsum(blocks) - blocks) * BLOCK, parts):
            ids[at : at + len(p)] = p
        return rows, ids, blocks

    rows, parts, size = [], [], 0
    for i, value in enumerate(batch.column("ids")):
        ids = np.frombuffer(value.as_py(), dtype="<i4")
        if not len(ids):
            continue
        rows.append(i)
        parts.append(ids)
        size += len(ids)
        if size >= WORDS_PER_STEP:
            yield joined(rows, parts)
            rows, parts, size = [], [], 0
    if rows:
        yield joined(rows, parts)


def add_rows(out: np.ndarray, group: np.ndarray, rows: np.ndarray, table: np.ndarray) -> None:
    """Add table[rows] to out[group]; groups are sorted.

    First the first row of every group, then the second, and so on: each step adds whole arrays.
    """
    if not len(group):
        return
    starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    rank = np.arange(len(group)) - np.repeat(starts, np.diff(np.concatenate((starts, [len(group)]))))
    order = np.argsort(rank, kind="stable")
    at = 0
    for n in np.bincount(rank).tolist():
        some = order[at : at + n]
        out[group[some]] += table[rows[some]]
        at += n


def passages(blocks: np.ndarray) -> np.ndarray:
    """The passage of each block; passages do not cross documents."""
    first = np.cumsum(blocks) - blocks
    inside = np.arange(int(blocks.sum())) - np.repeat(first, blocks)
    return np.cumsum(inside % PASSAGE_BLOCKS == 0) - 1


def document_frequencies(coded: DataFrame, size: int) -> tuple[np.ndarray, int]:
    """Number of passages with each word, and of all passages (at 0)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        total = np.zeros(size)
        for batch in batches:
            for _, ids, blocks in padded(batch):
                passage = np.repeat(passages(blocks), BLOCK)
                pairs = np.unique(passage * size + ids)
                total += np.bincount(pairs % size, minlength=size)
                total[0] += passage[-1] + 1 - np.count_nonzero(pairs % size == 0)
        yield total

    total = add_vectors(coded, run, size)
    return total, int(total[0])


def sketch(coded: DataFrame, idf: np.ndarray, test: np.ndarray) -> np.ndarray:
    """A'A times a random matrix, for A the TF-IDF passages of the given documents."""
    size, width = test.shape
    often = np.argsort(np.where(idf > 0, idf, np.inf), kind="stable")[:FREQUENT]
    place = np.full(size, -1)
    place[often] = np.arange(len(often))
    shared = coded.sparkSession.sparkContext.broadcast((idf, (test * idf[:, None]).astype(np.float32), often, place))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        weights, projected, often, place = shared.value
        dense = projected[often]
        total = np.zeros((size, width))
        for batch in batches:
            for _, ids, blocks in padded(batch):
                passage = np.repeat(passages(blocks), BLOCK)
                passage, ids = passage[weights[ids] > 0], ids[weights[ids] > 0]
                if not len(ids):
                    continue
                # The frequent words as a matrix of counts, the others row by row.
                n, at = int(passage[-1]) + 1, place[ids]
                code = (passage * len(often) + at)[at >= 0]
                counts = np.bincount(code, minlength=n * len(often)).astype(np.float32).reshape(n, len(often))
                sums = counts @ dense
                passage, ids = passage[at < 0], ids[at < 0]
                add_rows(sums, passage, ids, projected)
                total[often] += counts.T @ sums
                order = np.argsort(ids, kind="stable")
                add_rows(total, ids[order], passage[order], sums)
        yield (total * weights[:, None]).ravel()

    return add_vectors(coded, run, size * width).reshape(size, width)


def latent_basis(coded: DataFrame, known: Benchmark, frequencies: tuple[np.ndarray, int] | None = None) -> np.ndarray:
    """Latent vector of each word, IDF included: size x rank, bounded by the benchmark."""
    size = known.size
    counts, n = frequencies or document_frequencies(coded, size)
    idf = np.where(counts <= COMMON_SHARE * n, np.log((n + 1) / (counts + 1)), 0.0)
    idf[0] = 0
    width = min(RANK + OVERSAMPLING, size)
    test = np.linalg.qr(np.random.default_rng(SEED).standard_normal((size, width)))[0]
    y = sketch(coded, idf, test)
    items, items_size = known.gram(idf, test)
    # The random start sees its share of the matrix, which tells how large the whole is.
    passages_size = max(float((test * y).sum()) * size / width, 1e-9)
    weight = BENCHMARK_WEIGHT * passages_size / items_size if items_size else 0.0
    test = np.linalg.qr(y + weight * items)[0]
    y = sketch(coded, idf, test) + weight * known.gram(idf, test)[0]
    q, r = np.linalg.qr(y)
    values, vectors = np.linalg.eigh(r @ np.linalg.pinv(test.T @ y, hermitian=True) @ r.T)
    leading = np.argsort(-values)[: min(RANK, width)]
    leading = leading[values[leading] > 1e-6 * values.max()] if values.max() > 0 else leading[:1]
    scale = np.maximum(values[leading], 1e-12) ** 0.25
    return (q @ vectors[:, leading] / scale * idf[:, None]).astype(np.float32)


def unit(rows: np.ndarray) -> np.ndarray:
    norm = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return rows / np.where(norm > 0, norm, 1)


def marked(
    marks: dict[int, list[int]], members: list[int], window_of: np.ndarray, back: np.ndarray, ids: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Windows and items of which a mark is in the window. `back` tells if a block is in the window before its own too."""
    inside = set(members)
    lists = {w: some for w, items in marks.items() if (some := [i for i in items if i in inside])}
    if not lists:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    size = max(int(ids.max()), max(lists)) + 1
    many = np.zeros(size, dtype=np.int64)
    for w, some in lists.items():
        many[w] = len(some)
    first = np.cumsum(many) - many
    flat = np.array([i for w in sorted(lists) for i in lists[w]], dtype=np.int64)
    place = np.flatnonzero(many[ids])
    block, word = place // BLOCK, ids[place]
    window = np.concatenate((window_of[block], window_of[block][back[block]] - 1))
    window, word = np.divmod(np.unique(window * size + np.concatenate((word, word[back[block]]))), size)
    n = many[word]
    at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    return np.repeat(window, n), flat[np.repeat(first[word], n) + at]


def find_copies(
    known: Benchmark, items: np.ndarray, basis: np.ndarray, weighty: np.ndarray, marks: dict[int, list[int]], ids: np.ndarray, blocks: np.ndarray
) -> dict[int, dict[int, float]]:
    """Items found in each document of a run, with their share."""
    item_words, least = known.words()
    sums = np.zeros((int(blocks.sum()), basis.shape[1]), dtype=np.float32)
    place = np.flatnonzero(weighty[ids])
    add_rows(sums, place // BLOCK, ids[place], basis)
    owner = np.repeat(np.arange(len(blocks)), blocks)
    last = np.cumsum(blocks)
    inside = np.arange(len(owner)) - (last - blocks)[owner]
    out: dict[int, dict[int, float]] = {}
    halves, before = sums, np.arange(len(sums))
    for width, members in known.by_blocks.items():
        start = np.flatnonzero(inside % (width // 2) == 0)
        stop = np.minimum(start + width, last[owner[start]])
        window_of = np.cumsum(inside % (width // 2) == 0) - 1
        # Widths are powers of two in rising order, so each half is made of halves of the width before it.
        parts, halves = halves, np.zeros((len(start), basis.shape[1]), dtype=np.float32)
        add_rows(halves, window_of[before], np.arange(len(before)), parts)
        before = start
        # A window is the half from its start and the next one, if that is of the same document.
        whole = halves.copy()
        both = np.flatnonzero(start[1:] < stop[:-1])
        whole[both] += halves[both + 1]
        near = unit(whole) @ items[members].T >= MIN_COSINE
        longest = item_words[:, : known.lengths[members].max()]
        window, item = np.nonzero(near)
        more = marked(marks, members, window_of, inside >= width // 2, ids)
        pairs = np.unique(np.concatenate((window * len(known.items) + np.array(members)[item], more[0] * len(known.items) + more[1])))
        window, item = np.divmod(pairs, len(known.items))
        # A copy may cross the border of its window: look half a window further on both sides.
        low = np.maximum(start - width // 2, (last - blocks)[owner[start]])
        high = np.minimum(stop + width // 2, last[owner[start]])
        step = max(1, PRESENCE_BYTES // known.size)
        for at in range(0, len(start), step):
            some = slice(*np.searchsorted(window, [at, at + step]))
            w, i = window[some], item[some]
            if not len(w):
                continue
            # Which words each window has; an item can share no more of its words with it.
            used, w = np.unique(w, return_inverse=True)
            present = np.zeros((len(used), known.size), dtype=bool)
            place = start[used, None] * BLOCK + np.arange(width * BLOCK)[None, :]
            valid = place < stop[used, None] * BLOCK
            row = np.broadcast_to(np.arange(len(used))[:, None], place.shape)
            present[row[valid], ids[place[valid]]] = True
            present[:, 0] = False
            for part in range(0, len(w), 1 << 15):
                cut = slice(part, part + (1 << 15))
                held = np.add.reduce(present.view(np.uint8)[w[cut][:, None], longest[i[cut]]], axis=1, dtype=np.uint32)
                for k in part + np.flatnonzero(held >= NEARLY * least[i[cut]]):
                    a, b = low[used[w[k]]], high[used[w[k]]]
                    share = known.judge_near(int(i[k]), ids[a * BLOCK : b * BLOCK], width * BLOCK)
                    if share:
                        found = out.setdefault(int(owner[start[used[w[k]]]]), {})
                        found[int(i[k])] = max(share, found.get(int(i[k]), 0.0))
    for place, i in known.whole_runs(ids, np.repeat(owner, BLOCK)) if known.short else ():
        out.setdefault(place, {})[i] = 1.0
    return out


def scan(docs: DataFrame, benchmark: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row of docs: id, text_hash, contaminated, n_items, best_item (smallest of equals), coverage.

    Null and empty texts, and any text if the benchmark is empty, are clean, with no item and coverage 0.
    Repeated rows stay repeated; other columns are ignored. text_hash is xxhash64 of the text.
    """
    known = read_benchmark(benchmark)
    coded = encoded(docs, known, id_column, text_column)
    basis, marks = np.zeros((1, 1), np.float32), {}
    if known.items:
        frequencies = document_frequencies(coded, known.size)
        basis = latent_basis(coded, known, frequencies)
        marks = known.marks(basis.any(axis=1), frequencies[0])
    item_type = benchmark.schema["item_id"].dataType
    schema = T.StructType(
        [
            *coded.schema.fields[:2],
            T.StructField("contaminated", T.BooleanType()),
            T.StructField("n_items", T.LongType()),
            T.StructField("best_item", item_type),
            T.StructField("coverage", T.DoubleType()),
        ]
    )
    arrow_item = to_arrow_type(item_type)
    shared = docs.sparkSession.sparkContext.broadcast((known, basis, marks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, basis, marks = shared.value
        items = unit(np.array([basis[ws].sum(axis=0) for ws in known.items]).reshape(len(known.items), basis.shape[1]))
        weighty = basis.any(axis=1)
        for batch in batches:
            found: list[dict[int, float]] = [{} for _ in range(batch.num_rows)]
            if known.items:
                for rows, ids, blocks in padded(batch):
                    for place, hits in find_copies(known, items, basis, weighty, marks, ids, blocks).items():
                        found[rows[place]] = hits
            best = [min(f, key=lambda i: (-f[i], i)) if f else None for f in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([bool(f) for f in found]),
                    pa.array([len(f) for f in found], pa.int64()),
                    pa.array([None if b is None else known.ids[b] for b in best], arrow_item),
                    pa.array([0.0 if b is None else f[b] for f, b in zip(found, best)], pa.float64()),
                ],
                names=schema.names,
            )

    return coded.mapInArrow(run, schema)


def drop_copies(docs: DataFrame, benchmark: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents without those that hold a benchmark item, with all their columns."""
    found = stored(
        scan(docs, benchmark, id_column=id_column, text_column=text_column).filter("contaminated").select(
            F.col("id").alias("__leak_id"), F.col("text_hash").alias("__leak_hash")
        ),
        "leaks",
    )
    same = F.col("__leak_id").eqNullSafe(F.col(f"`{id_column}`")) & (F.col("__leak_hash") == F.xxhash64(F.coalesce(F.col(f"`{text_column}`"), F.lit(""))))
    return docs.join(found, same, "left_anti")
