from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that the operators use for results or inside.
        T.StructField("shard", T.StringType()),
        T.StructField("Score", T.DoubleType()),
        T.StructField("run", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("node", T.StringType()),
        T.StructField("count", T.LongType()),
    ]
)


def row(doc_id, text, lang="en"):
    return (doc_id, text, lang, "s", len(text or ""), "x", 0.25, "r", "k", "n", 7)


def words_of(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))


def corpus() -> list[tuple[int | None, str | None]]:
    """Small, with every awkward case: nulls, empty, blank, long, copies, near copies, shared passages, repeats."""
    rng = random.Random(3)
    base = [words_of(rng, rng.randint(20, 160)) for _ in range(30)]
    passage = words_of(rng, 110)
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100 + i, base[i % 3].upper()) for i in range(12)]
    for i in range(25):
        w = base[5].split()
        w[rng.randrange(len(w))] = f"edit{i}"
        rows.append((200 + i, " ".join(w)))
    rows += [(300 + i, f"{words_of(rng, 30)} {passage} {words_of(rng, 25)}") for i in range(6)]
    rows += [(400, None), (401, ""), (402, " \n\t "), (403, "one"), (404, "One"), (405, "a b c d e"), (406, "É À ñ ß")]
    rows += [(407, words_of(rng, 6000)), (408, "ab " * 900), (409, "x" * 5000), (410, "12 34 !!")]
    rows += [(None, base[1]), (None, None), (None, "only here " + base[2]), (0, base[0]), (0, base[0]), (411, "日本 " + passage)]
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("llm") / "documents.parquet")
    spark.createDataFrame([row(*r) for r in rows], SCHEMA).repartition(5).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def nothing(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("llm") / "empty.parquet")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    return spark.read.parquet(path)


def lowered(text: str | None) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
