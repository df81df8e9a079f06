from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest
from llm.conftest import SCHEMA, lowered, row
from torqline.llm.lines import dropped_runs, pack_runs, without_shared_lines


def brute(rows, min_docs, min_chars=1, keep_first=False):
    """(doc_id, lines, dropped, kept text) of every row; rows in the order of ids, null first."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    found = defaultdict(list)
    for i in order:
        for line in (rows[i][1] or "").split("\n"):
            key = lowered(line.strip(" \t\n\v\f\r"))
            if len(key) >= min_chars:
                found[key].append(i)
    out, seen = [], set()
    for i in order:
        lines, kept = (rows[i][1] or "").split("\n"), []
        for line in lines:
            key = lowered(line.strip(" \t\n\v\f\r"))
            gone = len(key) >= min_chars and len(set(found[key])) >= min_docs
            if gone and keep_first and key not in seen:
                gone = False
                seen.add(key)
            if not gone:
                kept.append(line)
        out.append((rows[i][0], len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def lines_corpus():
    rng = random.Random(8)
    pool = [f"Shared line {k}" for k in range(12)] + ["ÄÖ", "é", "x", " ", "\t", ""]
    rows = []
    for i in range(120):
        lines = [rng.choice(pool) if rng.random() < 0.6 else f"own {i} {k}" for k in range(rng.randint(0, 14))]
        lines += ["  A VERY common line\t"] * rng.randint(0, 3) if i % 3 else []
        rows.append((i, "\n".join(x.upper() if rng.random() < 0.2 else x for x in lines)))
    rows += [(500, None), (501, ""), (502, "\n\n"), (503, "only"), (503, "only"), (None, "A very COMMON line\nx")]
    rows += [(None, None), (504, "line\r\nx\r\n\x00y"), (505, "\n".join(["a very common line"] * 3000))]
    return rows


@pytest.mark.parametrize(("min_docs", "min_chars", "keep_first"), [(10, 1, False), (2, 2, False), (3, 0, True), (1, 1, False)])
def test_lines_match_brute_force(spark, min_docs, min_chars, keep_first):
    rows = lines_corpus()
    docs = spark.createDataFrame([row(*r) for r in rows], SCHEMA).repartition(7)
    got = without_shared_lines(docs, min_docs, min_chars, keep_first).collect()
    plain = sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept"]) for r in got), key=repr)
    assert plain == sorted(brute(rows, min_docs, min_chars, keep_first), key=repr)
    for r in got:
        assert (r["keep"] is None) == (r["n_dropped"] == 0)
        assert sum(b - a for a, b in dropped_runs(r["keep"] or b"")) == r["n_dropped"]


@pytest.mark.parametrize("keep_first", [False, True])
def test_one_key_over_all_partitions(spark, keep_first):
    """Most lines have one key: it begins, fills and ends partitions of the range shuffle."""
    rows = [(i, "hot\n" * (1 + i % 3) + f"own {i}\nhot\nrare {i % 40}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = without_shared_lines(docs, 10, keep_first=keep_first).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    plain = sorted((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept"]) for r in got)
    assert plain == sorted(brute(rows, 10, keep_first=keep_first))


def test_bitmaps_round_trip():
    rng = np.random.default_rng(5)
    for size in (1, 7, 400, 100_000):
        flags = rng.random(size) < 0.4
        flags[rng.integers(size)] = True
        gone = np.flatnonzero(flags)
        again = [i for a, b in dropped_runs(pack_runs(gone)) for i in range(a, b)]
        assert again == gone.tolist()
    assert len(pack_runs(np.arange(1 << 20))) == 4


def test_empty_table_and_long_text(spark, nothing):
    assert without_shared_lines(nothing).count() == 0
    text = "\n".join(f"line {i % 5000} " + "x" * 20 for i in range(200_000))
    docs = spark.createDataFrame([(i, text if i < 2 else "line 7 " + "x" * 20) for i in range(4)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in without_shared_lines(docs, 3).collect()}
    assert [got[i]["n_dropped"] for i in range(4)] == [40, 40, 1, 1]
    assert got[0]["kept"] == "\n".join(x for x in text.split("\n") if not x.startswith("line 7 "))
