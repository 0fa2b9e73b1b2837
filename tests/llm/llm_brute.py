"""Plain versions of operators that tests compare with."""

import re
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
TOKENIZER = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def ids_of(text):
    return np.array(TOKENIZER.encode(text or "", add_special_tokens=False).ids + [2], dtype="<u4")


def brute_substring(texts, window):
    """(n_words, n_removed, kept) of each text."""
    words = [WORDS.findall(t or "") for t in texts]
    counts = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        goes = set()
        for i in range(len(w) - window + 1):
            if counts[tuple(w[i : i + window])] > 1:
                goes.update(range(i, i + window))
        out.append((len(w), len(goes), " ".join(x for i, x in enumerate(w) if i not in goes)))
    return out


def brute_classes(prints, limit=4):
    """Least position reachable from each."""
    arr = np.array(prints, dtype=np.uint64)
    label = list(range(len(arr)))
    near = [np.flatnonzero(np.bitwise_count(arr ^ x) <= limit) for x in arr]
    changed = True
    while changed:
        changed = False
        for ns in near:
            least = min(label[j] for j in ns)
            for j in ns:
                if label[j] > least:
                    label[j] = least
                    changed = True
    return label
