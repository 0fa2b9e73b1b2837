import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_brute import ids_of
from tripmill.llm import packing
from tripmill.llm.queries import QUERIES, word_vocabulary

def check(rows, texts, window=4096):
    """Every id of every document in one piece; sequences without gaps and within the window."""
    sequences, by = {}, {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append(r)
    assert set(by) == set(texts)
    for key, text in texts.items():
        ids, at = ids_of(text), 0
        for r in sorted(by[key], key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids)) and r["length"] > 0
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= window
    return sum(window - sum(p["length"] for p in s) for s in sequences.values()) / (window * len(sequences))


ODD = ["", None, "Hello, World's 42nd  it'LL", "ÀÉÎ ñandú Straße", "e\u0301 İ Σας ΣΑΣ", "a\u00a0b\u2003c", "<|endoftext|> <|startoftext|>x",
       "x\x1cy\x85z", "日本語 текст 😀👍🏽", "'s 're've don't", "٣٤ ½ ²", "A" * 3000, "\t\n\r", "ﬁ ǅ ß ẞ ÿ ×÷"]


def test_ids_are_the_tokenizers():
    encode = packing.WordEncoder(word_vocabulary())
    for text in ODD:
        assert encode(text) == ids_of(text)[:-1].tobytes(), text


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_ids_of_any_text(text):
    assert packing.encoder(word_vocabulary())(text) == ids_of(text)[:-1].tobytes()


@given(st.lists(st.integers(1, 70), max_size=60), st.integers(1, 5), st.integers(0, 8))
def test_packer_keeps_every_token(lengths, open_windows, min_cut):
    packer = packing.Packer(20, open_windows, min_cut)
    done = []
    for i, n in enumerate(lengths):
        done += packer.add(i, n)
        assert len(packer.pieces) <= open_windows
    done += packer.rest()
    seen = {}
    for window, offset, (doc, start, n) in done:
        seen.setdefault(doc, []).append((start, n))
    for i, n in enumerate(lengths):
        at = 0
        for start, size in sorted(seen[i]):
            assert start == at and size > 0
            at += size
        assert at == n


def test_best_fit_takes_the_tightest():
    packer = packing.Packer(10, 3, 100)
    for n in (4, 7, 8):
        packer.add(n, n)
    packer.add("x", 3)
    assert [p[0] for _, p in packer.pieces[1]] if 1 in packer.pieces else True
    assert 1 not in packer.pieces  # 7 + 3 fills its window, which closes


def test_merge_places_without_overlap():
    lengths = np.array([random.Random(1).randint(1, 50) for _ in range(500)])
    window, offset = packing.place_pieces(lengths, 60)
    for w in set(window.tolist()):
        at = 0
        for i in sorted(np.flatnonzero(window == w), key=lambda i: offset[i]):
            assert offset[i] == at
            at += lengths[i]
        assert at <= 60


def test_query(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert check(QUERIES["op8_packing"](spark, sf_dir).collect(), texts) < 0.03


def test_edge_rows(spark, docs, clashing, write_table):
    texts = dict(enumerate(ODD)) | {100: "word " * 9000}
    folder = write_table(documents=clashing(docs(*texts.items())).repartition(3))
    check(QUERIES["op8_packing"](spark, folder).collect(), texts)
    rows = QUERIES["op8_packing"](spark, write_table(documents=docs((None, "a"), (7, "b"), (7, "b")))).collect()
    assert sorted((r["doc_id"] or 0, r["doc_tokens"]) for r in rows) == [(0, 2), (7, 2), (7, 2)]
    assert QUERIES["op8_packing"](spark, write_table(documents=docs())).count() == 0
