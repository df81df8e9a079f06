from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from torqline.llm import repeats


def brute(rows, span):
    starts = defaultdict(list)
    raws = [(t or "").encode() for _, t in rows]
    for d, raw in enumerate(raws):
        for i in range(len(raw) - span + 1):
            starts[raw[i : i + span]].append((d, i))
    gone = [np.zeros(len(r), bool) for r in raws]
    for places in starts.values():
        if len(places) > 1:
            for d, i in places:
                gone[d][i : i + span] = True
    out = Counter()
    for (doc_id, _), raw, g in zip(rows, raws, gone):
        kept = np.frombuffer(raw, np.uint8)[~g].tobytes()
        out[(doc_id, len(raw), int(g.sum()), len(repeats._runs(g)), hashlib.sha256(kept).hexdigest())] += 1
    return out


@pytest.mark.parametrize(
    "span, gram, bucket_bytes", [(400, 32, 8 << 20), (60, 12, 8 << 20), (60, 12, 0), (400, 32, 0)]
)
def test_removed_bytes_match_brute_force(docs, rows, span, gram, bucket_bytes):
    """With bucket_bytes 0 every bucket of several pieces takes the way of the too large ones."""
    got = repeats.repeated_passages(docs, span=span, gram=gram, shard_bytes=3000, bucket_bytes=bucket_bytes).collect()
    expected = brute(rows, span)
    assert sum(n for key, n in expected.items() if 0 < key[2] < key[1]) >= 5
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]), r["kept_sha256"]) for r in got) == expected


@pytest.mark.parametrize("parts", [1, 3, 50])
def test_only_windows_that_can_repeat_are_sorted(monkeypatch, parts):
    """Texts around one common gram; some of them share more, exactly a window or one byte less."""
    monkeypatch.setattr(repeats, "PARTS", parts)
    rng, span, gram = random.Random(8), 60, 12
    word = lambda n: "".join(rng.choice("abcdefghij") for _ in range(n))
    common, left, right = word(gram), word(70), word(70)
    rows = [(i, word(90) + common + word(90)) for i in range(60)]
    rows += [(100 + i, word(30) + left[70 - a :] + common + right[: span - gram - a] + word(30)) for i, a in enumerate([0, 0, 20, 20, 48, 48])]
    rows += [(200 + i, "#" * (i + 1) + left + common + right[:n] + "#" * (i + 1)) for i, n in enumerate([0, 30, 70])]
    rows += [(300 + i, word(9) + right[: span - 1 + i] + word(9)) for i in range(3)]
    pieces = [p for p in repeats._cut_pieces(span, gram)(iter([_with_buckets(rows, span, gram)]))]
    cut = [tuple(r[c] for c in ("bucket", "text_a", "start", "anchor", "piece")) for p in pieces for r in p.to_pylist()]
    cut = sorted(r for r in cut if r[0] is not None)
    sizes = []

    class Counted(repeats.RunLengthIndex):
        def __init__(self, texts):
            sizes.append(sum(map(len, texts)))
            super().__init__(texts)

    monkeypatch.setattr(repeats, "RunLengthIndex", Counted)
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*cut)], names=list("bxyap"))
    found = defaultdict(set)
    for out in repeats._index_buckets(span, 1 << 20, gram)(iter([batch])):
        for r in out.to_pylist():
            for first, end in zip(r["runs"][::2], r["runs"][1::2]):
                found[r["piece_a"]] |= {i + r["piece_b"] for i in range(first, end)}
    windows = Counter(t[i : i + span] for _, t in rows for i in range(len(t) - span + 1))
    expected = {i: {k for k in range(len(t) - span + 1) if windows[t[k : k + span]] > 1} for i, t in rows}
    assert found == {i: places for i, places in expected.items() if places} and len(found) >= 8
    assert sum(sizes) < sum(len(r[4]) for r in cut) / (1 if parts == 1 else 4)


def _with_buckets(rows, span, gram):
    """The rows, each with all of its buckets."""
    texts = pa.array([t for _, t in rows])
    keys = defaultdict(list)
    ids = pa.array([i for i, _ in rows], pa.int64())
    for out in repeats._keys(span, gram)(iter([pa.RecordBatch.from_arrays([ids, ids, texts], names=list("abt"))])):
        for r in out.to_pylist():
            keys[r["text_a"]].append(r["bucket"])
    return pa.RecordBatch.from_arrays([ids, ids, texts, pa.array([keys[i] for i, _ in rows])], names=list("abtk"))


def test_empty_table(nothing):
    assert repeats.repeated_passages(nothing).count() == 0


def test_statistics_from_run_ends_are_exact():
    rng = random.Random(5)
    for _ in range(30):
        base = bytes(rng.choice(b"ab") for _ in range(60))
        texts = [base[rng.randrange(20) : rng.randrange(30, 60)] for _ in range(5)] + [b"a" * 25, b"", base[:7], base[:7]]
        index = repeats.RunLengthIndex(texts)
        got, at = index.matching_statistics(), 0
        suffixes = [t[i:] for t in texts for i in range(len(t) + 1)]
        for k, s in enumerate(suffixes):
            best = 0
            for j, o in enumerate(suffixes):
                if j != k:
                    n = 0
                    while n < min(len(s), len(o)) and s[n] == o[n]:
                        n += 1
                    best = max(best, n)
            assert max(got[k], 0) == best
        assert len(index.heads) <= index.size
    flat = repeats.RunLengthIndex([b"x" * 3000])
    assert len(flat.heads) < 10
