from __future__ import annotations

import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from llm.conftest import SCHEMA, lowered, row, words_of
from torqline.llm import jaccard
from torqline.llm.components import components

WORD = re.compile("[^\x20\x09-\x0d]+")


def shingles(text):
    w = WORD.findall(lowered(text))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if None in (i, j) or not a or not b:
                continue
            if 100 * len(a & b) >= 80 * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return Counter((i, len(s), None if i is None else find(i)) for i, s in sets)


def found(docs):
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.near_duplicate_groups(docs).collect())


def test_groups_match_brute_force(docs, rows):
    assert found(docs) == brute(rows)


@pytest.mark.parametrize("leaders", [0, 2])
def test_chains_and_wide_groups(spark, monkeypatch, leaders, tmp_path):
    """Chains link neighbours only; the last pass alone must find what leaders find with fewer comparisons."""
    monkeypatch.setattr(jaccard, "LEADER_ROUNDS", leaders)
    rng = random.Random(9)
    w, rows = words_of(rng, 120).split(), []
    for i in range(14):  # each step changes one more word, so distant members are not similar
        w[8 * i + 3] = f"step{i}"
        rows.append((i, " ".join(w)))
    base = words_of(rng, 150).split()
    for i in range(40):
        v = list(base)
        for _ in range(rng.randint(1, 4)):
            v[rng.randrange(150)] = f"e{i}{rng.random()}"
        rows.append((100 + i, " ".join(v)))
    path = str(tmp_path / "d.parquet")
    spark.createDataFrame([row(*r) for r in rows], SCHEMA).write.parquet(path)
    assert found(spark.read.parquet(path)) == brute(rows)


def test_pairs_grow_with_the_group_not_with_its_square(spark, monkeypatch, tmp_path):
    """Near copies of a text with two to four edits each: most pairs of them are just below the limit."""
    compared = []
    monkeypatch.setattr(
        jaccard._Join, "verify", lambda self, pairs, own=jaccard._Join.verify: (compared.append(pairs.count()), own(self, pairs))
    )
    totals = {}
    for size in (200, 800):
        rng = random.Random(size)
        base, rows = words_of(rng, 200).split(), []
        for i in range(size):
            v = list(base)
            for k in rng.sample(range(200), rng.randint(2, 4)):
                v[k] = f"e{i}x{k}"
            rows.append((i, " ".join(v)))
        path = str(tmp_path / f"{size}.parquet")
        spark.createDataFrame([row(*r) for r in rows], SCHEMA).repartition(4).write.parquet(path)
        compared.clear()
        assert found(spark.read.parquet(path)) == brute(rows)
        totals[size] = sum(compared)
    assert totals[800] < 6 * totals[200]


def test_copies_are_left_out_once(docs, monkeypatch):
    """Texts of given nodes are found by their id; the copies are not left out again for each use."""
    plans = []

    def stored(df, label, *rest, own=jaccard.stored):
        plans.append((label, df._jdf.queryExecution().analyzed().toString()))
        return own(df, label, *rest)

    monkeypatch.setattr(jaccard, "stored", stored)
    found(docs)
    assert sum(label == "sets" for label, _ in plans) > 1
    assert [label for label, plan in plans if re.search(r"Join LeftAnti, \(doc_id#\d+L = doc_id#\d+L\)", plan)] == ["prefixes"]


@pytest.mark.parametrize("together", [1, 1 << 18])
def test_counters_hold_every_shingle(rows, monkeypatch, together):
    monkeypatch.setattr(jaccard, "COUNT_TOGETHER", together)
    texts = pa.array([t for _, t in rows])
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int64()), texts], names=["doc_id", "text"])
    *_, counters = jaccard._signatures(iter([batch, batch]))
    expected = Counter(int(s) % jaccard.COUNTERS for _, own in jaccard.shingle_sets(texts) for s in own)
    assert {r["key"]: r["n"] for r in counters.to_pylist()} == {key: 2 * n for key, n in expected.items()}


def test_ids_with_different_texts_are_one_node(spark, tmp_path):
    rng = random.Random(12)
    a, b, c, d, e, f, g, h, i, j = (words_of(rng, 100) for _ in range(10))
    near = lambda text: f"{text} more"
    rows = [(5, a), (9, near(a)), (5, b), (3, b), (20, c), (20, d), (21, near(d)), (22, near(c)), (30, ""), (30, e), (2, near(e))]
    rows += [(40, f), (40, g), (39, near(g)), (50, h), (50, i), (51, h), (51, j), (None, j), (60, None), (60, "x y")]
    path = str(tmp_path / "d.parquet")
    spark.createDataFrame([row(*r) for r in rows], SCHEMA).repartition(3).write.parquet(path)
    docs = spark.read.parquet(path)
    assert found(docs) == brute(rows)
    stay = sorted(k for (k, _, c), n in brute(rows).items() for _ in range(n) if k is not None and k == c)
    assert sorted(r["doc_id"] for r in jaccard.without_near_duplicates(docs).collect() if r["doc_id"] is not None) == stay


def test_one_document_of_each_group_stays(docs, rows):
    expected = sorted(i for (i, _, c), n in brute(rows).items() for _ in range(n) if i is not None and i == c)
    got = jaccard.without_near_duplicates(docs)
    assert got.columns == docs.columns
    assert sorted(r["doc_id"] for r in got.collect() if r["doc_id"] is not None) == expected
    assert got.filter("doc_id IS NULL").count() == 3


def test_empty_table(nothing):
    assert jaccard.near_duplicate_groups(nothing).count() == 0
    assert jaccard.without_near_duplicates(nothing).count() == 0


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 130)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 31)} | {i: 100 for i in range(101, 130)}
