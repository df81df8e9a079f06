from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm.conftest import lowered
from torqline.llm import decontamination as dc

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


@pytest.fixture(scope="module")
def benchmark(spark, rows):
    texts = [
        (1, " ".join(rows[3][1].split()[4:30])),
        (3, " ".join(dict(rows)[300].split()[40:75])),
        (2, rows[7][1].upper()),
        (10, "one"),
        (11, "never in any of these texts at all"),
        (12, None),
        (13, " !! "),
        (None, rows[9][1]),
        (14, "é-À ñ; SS"),
        (15, "É à"),
        (16, "ab ab ab ab ab ab ab ab ab ab ab"),
        (16, "ab ab ab ab ab ab ab ab ab ab ab"),
    ]
    return spark.createDataFrame(texts, "item_id long, text string").withColumn("doc_id", F.lit("x"))


def brute(rows, bench):
    phrases: dict[tuple, set] = {}
    for item, text in bench:
        w = WORD.findall(lowered(text))
        k = min(10, len(w))
        if item is not None and w:
            for j in range(len(w) - k + 1):
                phrases.setdefault(tuple(w[j : j + k]), set()).add(str(item))
    out = []
    for doc_id, text in rows:
        w = WORD.findall(lowered(text))
        hit, items = set(), set()
        for k in {len(p) for p in phrases}:
            for j in range(len(w) - k + 1):
                if found := phrases.get(tuple(w[j : j + k])):
                    hit.update(range(j, j + k))
                    items |= found
        out.append((str(doc_id), len(w), len(hit), tuple(sorted(items))))
    return sorted(out)


def test_hits_and_items_match_brute_force(docs, rows, benchmark, monkeypatch):
    expected = brute(rows, [(r["item_id"], r["text"]) for r in benchmark.collect()])
    assert sum(e[2] > 0 for e in expected) > 5
    for block, shard in ((200_000, 1 << 20), (3, 10)):
        monkeypatch.setattr(dc, "BLOCK_WINDOWS", block)
        monkeypatch.setattr(dc, "SHARD_SYMBOLS", shard)
        got = dc.contamination(docs, benchmark).collect()
        assert sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], tuple(r["items"])) for r in got) == expected


def test_spans_are_cut_and_clean_texts_stay(docs, rows, benchmark):
    spans = {(r["doc_id"], r["n_words"]): r["spans"] for r in dc.contamination(docs, benchmark).collect()}
    got = dc.without_phrases(docs, benchmark)
    assert got.schema == docs.schema and got.count() == len(rows)
    texts = {(r["doc_id"], r["source"]): (r["text"], r["n_chars"]) for r in got.filter("doc_id > 0").collect()}
    for doc_id, text in rows:
        if not doc_id:
            continue
        raw, at, kept = (text or "").encode(), 0, b""
        for s in spans[(doc_id, len(WORD.findall(lowered(text))))]:
            kept, at = kept + raw[at : s["start"]], s["end"]
        kept = (kept + raw[at:]).decode()
        new, chars = texts[(doc_id, "s")]
        assert new == (kept if text is not None else None)
        assert chars == len(kept)
    again = dc.contamination(got, benchmark).filter("n_hit > 0").collect()
    assert {r["doc_id"] for r in again} <= {r["doc_id"] for r in again if r["n_words"] < 60}


def test_empty_tables(docs, nothing, benchmark, rows):
    assert dc.contamination(nothing, benchmark).count() == 0
    none = dc.contamination(docs, benchmark.limit(0))
    assert none.count() == len(rows) and none.filter("n_hit > 0 OR size(items) > 0").count() == 0


def test_index_finds_every_occurrence():
    rng = random.Random(4)
    for rate in (1, 3, 16):
        symbols = np.array([rng.choice([0, 1, 2, 3, 3, 4]) for _ in range(400)] + [0])
        index = dc.FMIndex(symbols, 5, rate)
        phrases = np.array([[rng.randint(1, 4) for _ in range(4)] for _ in range(80)])
        lengths = np.array([rng.randint(1, 4) for _ in range(80)])
        low, high = index.search(phrases, lengths)
        for p, n, a, b in zip(phrases, lengths, low, high):
            expected = [i for i in range(len(symbols) - n + 1) if (symbols[i : i + n] == p[:n]).all()]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == expected
