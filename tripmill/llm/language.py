"""Language identification: multinomial naive Bayes over hashed character n-grams.

A text is lower-cased, each run of characters that are no letters becomes one space, and its 1- to
3-grams are hashed into BUCKETS buckets. Counts per language are summed in Spark, smoothed and turned
into a matrix of log probabilities, languages x buckets. Its size is fixed by the number of languages
and buckets, never by the corpus, and it is broadcast. Texts are scored in batches: their n-grams form
a sparse count matrix, kept as runs of bucket numbers per text, which is multiplied with the matrix by
gathering and summing its rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import add_vectors, without

BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
SMOOTHING = 0.5
#: Expected number of labelled rows a language is learned from; rows are chosen by a hash of their text.
TRAIN_ROWS = 20_000
#: More label values than this are no languages; the matrix would grow with them.
MAX_LANGUAGES = 512
CHARS_PER_BLOCK = 1 << 19
UNKNOWN = "und"

_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Whether each code point is a letter, as str.isalpha has it."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000))
    return _letters[0]


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of all texts, and the number of the text that each comes from."""
    lowered = [f" {t.lower()} " for t in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in lowered])
    letter = letters()[codes]
    first = np.ones(len(codes), dtype=bool)
    first[1:] = letter[:-1] | (owner[1:] != owner[:-1])
    keep = letter | first
    codes, owner, letter = codes[keep].astype(np.uint64), owner[keep], letter[keep]
    codes[~letter] = 32
    found, owners = [], []
    for n in ORDERS:
        size = len(codes) - n + 1
        if size <= 0:
            continue
        mixed = np.full(size, n, dtype=np.uint64)
        some = np.zeros(size, dtype=bool)
        for i in range(n):
            mixed = (mixed ^ codes[i : i + size]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
            some |= letter[i : i + size]
        whole = some & (owner[:size] == owner[n - 1 :])
        found.append((mixed[whole] & np.uint64(BUCKETS - 1)).astype(np.int64))
        owners.append(owner[:size][whole])
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found), np.concatenate(owners)


def blocks(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    """Texts in runs of bounded total length, with the number of the first; a long text is its own run."""
    start, run, size = 0, [], 0
    for i, text in enumerate(texts):
        text = text or ""
        if run and size + len(text) > CHARS_PER_BLOCK:
            yield start, run
            start, run, size = i, [], 0
        run.append(text)
        size += len(text)
    if run:
        yield start, run


def labelled_counts(labelled: DataFrame, langs: list[str]) -> np.ndarray:
    """Sum of n-gram counts, languages x buckets."""
    place = {name: i for i, name in enumerate(langs)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        total = np.zeros(len(langs) * BUCKETS)
        for batch in batches:
            names, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for start, run in blocks(texts):
                kind = np.array([place[n] for n in names[start : start + len(run)]])
                bucket, owner = grams(run)
                total += np.bincount(kind[owner] * BUCKETS + bucket, minlength=len(total))
        yield total

    return add_vectors(labelled.select("lang", "text"), count, len(langs) * BUCKETS).reshape(len(langs), BUCKETS)


def learn(
    docs: DataFrame, *, train: Column, text_column: str = "text", label_column: str = "lang", train_rows: int = TRAIN_ROWS
) -> tuple[list[str], np.ndarray]:
    """Languages in alphabetical order and their log probabilities, from the labelled rows under `train`.

    Each language is learned from about `train_rows` rows at most, chosen by a hash of their text.
    Rows without text or label teach nothing. Without any labelled row there is no language.
    """
    rows = docs.filter(train & F.col(label_column).isNotNull() & F.col(text_column).isNotNull()).select(
        F.col(label_column).alias("lang"), F.col(text_column).alias("text")
    )
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} label values")
    langs = sorted(sizes)
    if not langs:
        return [], np.zeros((0, BUCKETS), np.float32)
    keep = F.lit(True)
    for lang in langs:
        if sizes[lang] > train_rows:
            share = int(train_rows / sizes[lang] * (1 << 30))
            keep = F.when(F.col("lang") == lang, F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < share).otherwise(keep)
    counts = labelled_counts(rows.filter(keep), langs)
    smoothed = counts + SMOOTHING
    return langs, np.log(smoothed / smoothed.sum(axis=1, keepdims=True)).astype(np.float32)


def score(texts: list[str | None], langs: list[str], weights: np.ndarray) -> tuple[list[str], np.ndarray]:
    """The most probable language of each text and its probability; weights are buckets x languages."""
    best, chance = [UNKNOWN] * len(texts), np.zeros(len(texts))
    for start, run in blocks(texts):
        bucket, owner = grams(run)
        if not len(bucket) or not langs:
            continue
        sums = np.zeros((len(run), len(langs)))
        for at in range(0, len(bucket), CHARS_PER_BLOCK):
            own, part = owner[at : at + CHARS_PER_BLOCK], weights[bucket[at : at + CHARS_PER_BLOCK]]
            starts = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
            np.add.at(sums, own[starts], np.add.reduceat(part, starts, axis=0, dtype=np.float64))
        has = np.zeros(len(run), dtype=bool)
        has[owner] = True
        odds = np.exp(sums - sums.max(axis=1, keepdims=True))
        odds /= odds.sum(axis=1, keepdims=True)
        pick = odds.argmax(axis=1)  # the first of equals: languages are sorted
        for i in np.flatnonzero(has):
            best[start + i], chance[start + i] = langs[pick[i]], odds[i, pick[i]]
    return best, chance


def identify(docs: DataFrame, langs: list[str], log_probs: np.ndarray, *, text_column: str = "text") -> DataFrame:
    """The table with `lang_pred` and `score`; a null text or one without a letter is `und` with score 0.

    Every row keeps its columns, whatever they hold; columns with those two names are replaced.
    """
    base = without(docs, ["lang_pred", "score"])
    shared = docs.sparkSession.sparkContext.broadcast(np.ascontiguousarray(log_probs.T))

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            names, chances = score(texts.tolist(), langs, shared.value)
            yield pd.DataFrame({"lang_pred": names, "score": chances})

    found = base.withColumn("__found", predict(F.col(f"`{text_column}`")))
    return found.select(*[F.col(f"`{c}`") for c in base.columns], "__found.lang_pred", "__found.score")
