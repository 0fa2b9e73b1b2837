import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tripmill.llm import alignment
from tripmill.llm.queries import QUERIES, both_vocabularies

A = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def written():
    """The bytes of the byte-level alphabet, from the rule that visible bytes stand for themselves."""
    visible = set(range(33, 127)) | set(range(161, 173)) | set(range(174, 256))
    out, n = {}, 256
    for b in range(256):
        out[chr(b) if b in visible else chr(n)] = b
        n += b not in visible
    return out


LETTERS = written()


def tokens_of(text):
    """((id, start, end) of both sides) of a text, or nothing."""
    if not text:
        return [], []
    whole, sides = f" {text}".encode(), []
    ids = A.encode(f" {text}", add_special_tokens=False).ids
    sides.append([(i, bytes(LETTERS[c] for c in A.id_to_token(i))) for i in ids])
    pieces = B.encode(text)
    sides.append([(i, bytes([int(B.id_to_piece(i)[3:5], 16)]) if B.is_byte(i) else B.id_to_piece(i).replace("▁", " ").encode()) for i in pieces])
    if any(b"".join(x for _, x in side) != whole for side in sides):
        return [], []
    out = []
    for side in sides:
        at, placed = 0, []
        for i, x in side:
            placed.append((i, at, at + len(x)))
            at += len(x)
        out.append(placed)
    return tuple(out)


def brute(texts):
    tokens = [tokens_of(t) for t in texts]
    links = []
    for a, b in tokens:
        links.append([(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]] if len(a) * len(b) < 2e6 else swept(a, b))
    counts = Counter(p for found in links for p in found)
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    out = []
    for (a, b), found in zip(tokens, links):
        both = sorted({x[2] for x in a} & {y[2] for y in b})
        parts = []
        for low, high in zip([0, *both], both):
            parts.append("|".join(",".join(str(i) for i, s, e in side if low <= s < high) for side in (a, b)) if len(a) < 3000 else None)
        if parts and parts[0] is None:
            parts = grouped(a, b, both)
        out.append(
            (len(a), len(b), len(both), len(found), sum(counts[p] == most[p[1]] for p in found), sum(counts[p] for p in found), ";".join(parts))
        )
    return out


def swept(a, b):
    """Overlapping pairs by walking both lists."""
    i = j = 0
    found = []
    while i < len(a) and j < len(b):
        found.append((a[i][0], b[j][0]))
        end_a, end_b = a[i][2], b[j][2]
        i, j = i + (end_a <= end_b), j + (end_b <= end_a)
    return found


def grouped(a, b, both):
    import bisect

    parts = [([], []) for _ in both]
    for k, side in enumerate((a, b)):
        for i, _, end in side:
            parts[bisect.bisect_left(both, end)][k].append(str(i))
    return [",".join(x) + "|" + ",".join(y) for x, y in parts]


ORDER = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")


def check(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = {r["doc_id"]: tuple(r)[1:] for r in alignment.align_tokens(df, both_vocabularies).select("doc_id", *ORDER).collect()}
    expected = brute(texts)
    assert len(found) == len(texts)
    for i, t in enumerate(texts):
        assert found[i] == expected[i], repr(t)[:80]


EDGES = [
    "hello world", "hello world", "a", " ", "  ", "   x", "x   ", "a  b   c    d", "tab\t \tnext", "line\n \nline\n  two", "\n\n", "foo\n ", "foo \n bar",
    "naïve café Straße", "中文字符 和 more", "emoji 👍🏽 done", "<|endoftext|> hi", "<s> </s> <unk> <0x41>", "under▁score", "▁", "a b c \x1c d \x85 e",
    "don't you'll we've", "1234567 89 0.5", "\x00\x01", "it's  'tis", "x" * 500, "ab " * 400, "!?" * 50, None, "", "﻿bom", "é combining",
]


def test_edges_match_whole_text_tokenizers(spark):
    check(spark, EDGES)


def test_small_classes_steps_and_caches_agree(spark, monkeypatch):
    texts = [f"{t or ''} number {i % 7}" for i, t in enumerate(EDGES * 3)]
    monkeypatch.setattr(alignment, "CLASS_BYTES", 200)
    monkeypatch.setattr(alignment, "STEP_BYTES", 60)
    monkeypatch.setattr(alignment, "CACHE_WORDS", 5)
    alignment._pairs.clear()
    check(spark, texts)


def test_repeated_rows_empty_table_clashing_columns(spark, docs, clashing):
    assert alignment.align_tokens(docs().limit(0), both_vocabularies).count() == 0
    df = clashing(docs((1, "same text"), (1, "same text"), (None, "other"), (2, None))).withColumns({"n_a": F.lit("x"), "class": F.lit(1), "pair": F.lit(2)})
    found = alignment.align_tokens(df, both_vocabularies)
    assert sorted(found.columns) == sorted(["doc_id", *ORDER])
    rows = [tuple(r) for r in found.select("doc_id", *ORDER).collect()]
    expected = [(i, *b) for i, b in zip((1, 1, None, 2), brute(["same text", "same text", "other", None]))]
    assert sorted(map(repr, rows)) == sorted(map(repr, expected))


def test_a_third_of_the_rows_equal(spark):
    check(spark, ["the same row again"] * 200 + [f"row {i}" for i in range(400)])


def test_very_long_text(spark):
    check(spark, ["word soup, " * 30_000, "z" * 20_000, "short"])


@pytest.mark.parametrize("folder", ["sf0.001"])
def test_query_matches_whole_text_tokenizers(spark, folder):
    sf_dir = f"/root/testdata/{folder}"
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    expected = brute([r["text"] for r in rows])
    found = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op11_alignment"](spark, sf_dir).collect()}
    for r, (*numbers, groups) in zip(rows, expected):
        assert found[r["doc_id"]] == (*numbers, hashlib.sha256(groups.encode()).hexdigest() if numbers[0] else "")
