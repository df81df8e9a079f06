from __future__ import annotations

import random

import numpy as np
import pytest
from torqline.llm.runs import collapsed_runs, periodic_runs, surviving_segments


def brute(words, exponent=4, shortest=6):
    """All lags, word by word; equal stretches of several lags count for the smallest."""
    found = {}
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i < len(words) - q:
            j = i
            while j < len(words) - q and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(shortest, exponent * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def looping(rng: random.Random) -> list[int]:
    words: list[int] = []
    for _ in range(rng.randint(0, 5)):
        root = [rng.randrange(rng.randint(1, 5)) for _ in range(rng.randint(1, 9))]
        words += (root * 9)[: rng.randint(1, len(root) * 7)]
    return words


@pytest.mark.parametrize(("exponent", "shortest"), [(4, 6), (3, 2), (5, 12)])
def test_scan_finds_what_all_lags_find(exponent, shortest):
    rng = random.Random(exponent)
    for _ in range(400):
        texts = [looping(rng) for _ in range(rng.randint(1, 4))]
        symbols = np.array([w for t in texts for w in t], np.int64)
        document = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        got = list(zip(*(x.tolist() for x in periodic_runs(symbols, document, exponent, shortest))))
        want, first = [], 0
        for t in texts:
            want += [(s + first, n, q) for s, n, q in brute(t, exponent, shortest)]
            first += len(t)
        assert got == want


def test_rare_words_split_until_nothing_splits():
    # 9 occurs four times, but never so in one part: 1 and 2 split off its ends first.
    symbols = np.array([9, 9, 1, 9, 2, 9] + [5, 6] * 4)
    assert surviving_segments(symbols, np.zeros(14, np.int64), 4, 6).tolist() == list(range(6, 14))
    with pytest.raises(ValueError, match="exponent"):
        periodic_runs(symbols, np.zeros(14, np.int64), exponent=2)


def test_documents_match_brute_force(docs, rows):
    got = {}
    for r in collapsed_runs(docs).collect():
        got.setdefault(r["doc_id"], []).append((r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]))
    want = {}
    for doc_id, text in rows:
        words = (text or "").encode().split()
        runs = brute(words)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone).decode()
        want.setdefault(doc_id, []).append((len(words), runs, kept))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    assert any(r for v in want.values() for _, r, _ in v)


def test_very_long_text_and_empty_table(spark, nothing):
    root = " ".join(f"w{i}" for i in range(3000))
    text = "start " + " ".join([root] * 300) + " end " + "a b " * 4
    assert len(text) > 4 << 20
    got = collapsed_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [tuple(r) for r in got["runs"]] == [(1, 900_000, 3000), (900_002, 8, 2)]
    assert got["collapsed"] == f"start {root} end a b"
    assert collapsed_runs(nothing).count() == 0
