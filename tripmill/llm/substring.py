"""Removal of passages that occur more than once, by hashes of all windows of words.

Every run of WINDOW consecutive words gets a Rabin-Karp hash, a polynomial in the hashes of its words
modulo 2**64. Hashes are counted over the whole corpus. A word goes if any window over it has a hash that
occurs twice or more, and adjoining windows merge into maximal removal intervals.

Documents are dealt into classes of bounded size by a hash of id and text, known before any shuffle.
Tasks read documents where they lie and send each hash, with its class, to the bucket of its leading bits,
packed into one binary row per task and bucket, a hash of one class at most twice. So a very frequent
window costs each task two numbers. A bucket sorts what it gets and answers each class with those of its
hashes that occur elsewhere. Documents then meet the answers of their class and look their windows up. A class
that repeated rows make large is dealt into parts of bounded size there, each with the class's answers.

With 64 bits, n windows have about n*n/2**65 false pairs: 0.0005 expected at 10**8, two at 10**10.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.llm.common import stored, without

WINDOW = 35
BASE = np.uint64(0x9E3779B97F4A7C15)
CLASS_BYTES = 16 << 20
BUCKET_BYTES = 8 << 20
FLUSH_WINDOWS = 3_000_000
CACHE_WORDS = 300_000

ADDED = [
    T.StructField("n_words", T.LongType()),
    T.StructField("n_removed", T.LongType()),
    T.StructField("kept_text", T.StringType()),
    T.StructField(
        "removed",
        T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())])),
    ),
]
SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


class WordHashes(dict):
    """64-bit hash of each word, kept for words seen before."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def words_of(text: str | None) -> list[bytes]:
    """Runs without ASCII white space (space, tab to carriage return), unchanged."""
    return (text or "").encode().split()


def window_hashes(words: list[bytes], known: WordHashes, window: int = WINDOW) -> np.ndarray:
    """Hash of each window: the sum of its word hashes times falling powers of BASE, then mixed.

    Sums of 1, 2, 4, ... words are doubled from one another and put together to the window's length.
    """
    n = len(words) - window + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    run = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
    size, power, done, total = 1, BASE, 0, np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        while True:
            if window & size:
                total = total * power + run[done : done + n]
                done += size
            if done == window:
                break
            run = run[:-size] * power + run[size:]
            size, power = size * 2, power * power
        total ^= total >> np.uint64(31)
        total *= np.uint64(0xBF58476D1CE4E5B9)
        return total ^ (total >> np.uint64(29))


def covered(repeated: np.ndarray, n_words: int, window: int = WINDOW) -> np.ndarray:
    """Words under at least one repeated window."""
    steps = np.zeros(n_words + 1, dtype=np.int64)
    starts = np.flatnonzero(repeated)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + window, -1)
    return np.cumsum(steps[:-1]) > 0


def at_most_twice(keys: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Of sorted rows, those that do not equal the row two places before."""
    keep = np.ones(len(keys), dtype=bool)
    keep[2:] = (keys[2:] != keys[:-2]) | (hashes[2:] != hashes[:-2])
    return keep


def packed(buckets: np.ndarray, classes: np.ndarray, hashes: np.ndarray, n_classes: int) -> pa.RecordBatch:
    """One row per bucket with its hashes and their classes, in the order of class and hash."""
    key = buckets * n_classes + classes
    order = np.lexsort((hashes, key))
    key, hashes = key[order], hashes[order]
    keep = at_most_twice(key, hashes)
    key, hashes = key[keep], hashes[keep]
    bucket, member = key // n_classes, (key % n_classes).astype("<u4")
    starts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
    stops = [*starts[1:].tolist(), len(bucket)]
    cuts = list(zip(starts.tolist(), stops))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(bucket[starts].astype(np.int32)),
            pa.array([hashes[a:b].astype("<u8").tobytes() for a, b in cuts], pa.binary()),
            pa.array([member[a:b].tobytes() for a, b in cuts], pa.binary()),
        ],
        names=["bucket", "hashes", "classes"],
    )


def repeated_hashes(rows: DataFrame, bucket_bits: int, n_classes: int, window: int) -> DataFrame:
    """(class, hashes): the hashes of a class's windows that occur more than once anywhere.

    `rows` has __class and __text.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, classes, hashes, size = WordHashes(), [], [], 0

        def flush() -> pa.RecordBatch:
            found = np.concatenate(hashes)
            member = np.concatenate(classes)
            bucket = (found >> np.uint64(64 - bucket_bits)).astype(np.int64) if bucket_bits else np.zeros(len(found), np.int64)
            return packed(bucket, member, found, n_classes)

        for batch in batches:
            for own, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = window_hashes(words_of(text.as_py()), known, window)
                if len(found):
                    hashes.append(found)
                    classes.append(np.full(len(found), own, dtype=np.int64))
                    size += len(found)
                if size >= FLUSH_WINDOWS:
                    yield flush()
                    classes, hashes, size = [], [], 0
        if size:
            yield flush()

    def count(rows: pa.Table) -> pa.Table:
        hashes = np.concatenate([np.frombuffer(x.as_py(), "<u8") for x in rows["hashes"]])
        member = np.concatenate([np.frombuffer(x.as_py(), "<u4") for x in rows["classes"]])
        order = np.argsort(hashes, kind="stable")
        hashes, member = hashes[order], member[order]
        same = hashes[1:] == hashes[:-1]
        often = np.zeros(len(hashes), dtype=bool)
        often[1:] |= same
        often[:-1] |= same
        hashes, member = hashes[often], member[often]
        order = np.argsort(member, kind="stable")
        hashes, member = hashes[order], member[order]
        starts = np.flatnonzero(np.concatenate(([True], member[1:] != member[:-1]))) if len(member) else []
        cuts = list(zip(starts, [*starts[1:], len(member)])) if len(member) else []
        return pa.table(
            {
                "class": pa.array([int(member[a]) for a, _ in cuts], pa.int32()),
                "hashes": pa.array([np.unique(hashes[a:b]).tobytes() for a, b in cuts], pa.binary()),
            }
        )

    sent = rows.select("__class", "__text").mapInArrow(send, "bucket int, hashes binary, classes binary")
    return sent.groupBy("bucket").applyInArrow(count, "class int, hashes binary")


def large_classes(dealt: DataFrame, text_column: str) -> DataFrame:
    """(__class, __parts) of classes that repeated rows, equal in id and text, make large."""
    sizes = dealt.groupBy("__class").agg(F.sum(F.octet_length(F.col(f"`{text_column}`"))).alias("n"))
    large = sizes.filter(F.col("n") > 2 * CLASS_BYTES)
    return stored(large.select("__class", F.ceil(F.col("n") / CLASS_BYTES).cast("int").alias("__parts")), "large-classes")


def in_parts(dealt: DataFrame, large: DataFrame) -> DataFrame:
    """Rows with __part: any part of a large class may take each of its rows."""
    part = F.pmod(F.monotonically_increasing_id(), F.coalesce("__parts", F.lit(1))).cast("int")
    return dealt.join(large, "__class", "left").withColumn("__part", part)


def remove_repeats(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW
) -> DataFrame:
    """The table with n_words, n_removed, kept_text and removed, the word intervals that go.

    Windows are judged on the texts as given. kept_text holds the words that stay, joined by one space,
    and is empty if none stays. A null text has no words. Repeated rows count as repeats of one another.
    Columns with the four names are replaced.
    """
    base = without(docs, [*(f.name for f in ADDED), "__class", "__text", "__part", "__parts"])
    total = base.agg(F.sum(F.octet_length(F.col(f"`{text_column}`"))).alias("n")).first()["n"] or 0
    n_classes = max(1, -(-total // CLASS_BYTES))
    bucket_bits = max(0, (total // BUCKET_BYTES).bit_length())
    own = F.pmod(F.xxhash64(F.col(f"`{id_column}`"), F.col(f"`{text_column}`")), F.lit(n_classes)).cast("int")
    dealt = base.withColumn("__class", own)
    answers = repeated_hashes(dealt.select("__class", F.col(f"`{text_column}`").alias("__text")), bucket_bits, n_classes, window)
    schema = T.StructType([*base.schema.fields, *ADDED])

    def cut(rows: pa.Table, found: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x.as_py(), "<u8") for x in found["hashes"]]
        known, often = WordHashes(), np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)
        counts, removed, kept, spans = [], [], [], []
        for text in rows[text_column]:
            words = words_of(text.as_py())
            hashes = window_hashes(words, known, window)
            goes = np.zeros(len(words), dtype=bool)
            if len(hashes) and len(often):
                at = np.searchsorted(often, hashes)
                at[at == len(often)] = 0
                repeated = often[at] == hashes
                if repeated.any():
                    goes = covered(repeated, len(words), window)
            counts.append(len(words))
            removed.append(int(goes.sum()))
            edges = np.flatnonzero(np.diff(np.concatenate(([0], goes.view(np.int8), [0])))).tolist()
            spans.append([{"start": a, "stop": b} for a, b in zip(edges[::2], edges[1::2])])
            kept.append(b" ".join([w for w, x in zip(words, goes.tolist()) if not x] if removed[-1] else words).decode())
        out = rows.drop_columns(["__class", "__part"])
        for field, values, kind in zip(ADDED, (counts, removed, kept, spans), (pa.int64(), pa.int64(), pa.string(), SPANS)):
            out = out.append_column(field.name, pa.array(values, kind))
        return out

    large = large_classes(dealt, text_column)
    rows, parts = in_parts(dealt, large), F.coalesce("__parts", F.lit(1))
    answers = answers.withColumnRenamed("class", "__class").join(large, "__class", "left")
    answers = answers.withColumn("__part", F.explode(F.sequence(F.lit(0), parts - 1)))
    keys = ("__class", "__part")
    rows, answers = rows.select(*keys, *[F.col(f"`{c}`") for c in base.columns]), answers.select(*keys, "hashes")
    return rows.groupBy(*keys).cogroup(answers.groupBy(*keys)).applyInArrow(cut, schema)
