from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from torqline.llm import packing, records, tokens
from torqline.llm.tokens import encoder

BYTES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ODD = [
    "", " ", "\n\n a", "a  b", "it's IT'S ''s 's", "x <|endoftext|> y", "<|STARTOFTEXT|>", "é É ß ÀÉ ²³ ª", "İstanbul ſ",
    "日本語 テスト", "a b", "a\x1cb", "́a é", "123 45", "  \t\n ", "don't'll", "a_b_c", "½ x¼", "x" * 300, "…!?  ??",
]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_pieces_give_the_ids_of_whole_texts(path, rows):
    plain = Tokenizer.from_file(path)
    for text in [t for _, t in rows if t] + ODD:
        expected = np.array(plain.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert encoder(path).encode(text) == expected, text[:60]


class Counted:
    """A tokenizer that counts how often it is asked."""

    def __init__(self, library):
        self.library, self.calls, self.model = library, 0, self

    def __getattr__(self, name):
        found = getattr(self.library.model if name == "tokenize" else self.library, name)

        def counted(*args, **named):
            self.calls += 1
            return found(*args, **named)

        return counted


@pytest.mark.parametrize("path", [BYTES, WORDS])
@pytest.mark.parametrize("memo_pieces", [10, 1_000_000])
def test_texts_together_give_the_ids_of_each(path, memo_pieces, rows, monkeypatch):
    monkeypatch.setattr(tokens, "TOGETHER_CHARS", 5000)
    plain = Tokenizer.from_file(path)
    texts = [t for _, t in rows] + ODD + [f" {t}" for t in ODD]
    expected = [np.array(plain.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    own = tokens.Encoder(path, memo_pieces)
    for _ in range(2):
        assert list(own.encode_all(iter(texts))) == expected
    assert list(own.encode_all([])) == []


def test_new_words_go_to_the_library_together(rows):
    own = tokens.Encoder(BYTES)
    own.library = counted = Counted(own.library)
    text = " ".join(t for _, t in rows[:30])
    assert own.encode(text) == tokens.Encoder(BYTES).encode(text)
    assert len(set(text.split(" "))) > 1000 and counted.calls < 10


def ids(path, text, end):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids + [end]


def test_records_round_trip(docs, rows, tmp_path):
    plain = Tokenizer.from_file(BYTES)
    expected = [
        (i, np.array((plain.encode(t or "", add_special_tokens=False).ids) + [2], "<u4").tobytes()) for i, t in rows
    ]
    manifest = records.write_records(docs, BYTES, 2, folder=str(tmp_path / "out"))
    read = records.read_records(manifest).orderBy("start").collect()
    assert Counter((r["doc_id"], bytes(r["ids"])) for r in read) == Counter(expected)
    assert [r["doc_id"] if r["doc_id"] is not None else -1 for r in read] == sorted(i if i is not None else -1 for i, _ in rows)
    at = 0
    for r in read:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"]) // 4
        at += r["n_tokens"]
    one, two = (records.read_shuffled(manifest, seed).collect() for seed in (1, 2))
    assert Counter((r["doc_id"], bytes(r["ids"])) for r in one) == Counter(expected)
    assert [r["ids"] for r in one] != [r["ids"] for r in two]


def test_a_changed_byte_is_noticed():
    record = records.frame(5, np.array([1, 2, 70_000], "<u4").tobytes(), 4)
    assert records.unframe(record[:12], record[12:]) == (5, np.array([1, 2, 70_000], "<u4").tobytes())
    for at in (0, 9, 20, len(record) - 1):
        bad = bytearray(record)
        bad[at] ^= 1
        with pytest.raises(ValueError):
            records.unframe(bytes(bad[:12]), bytes(bad[12:]))


def test_packing_is_whole_and_near_the_bound(docs, rows):
    for capacity, per_partition in ((4096, 8192), (256, 20)):
        got = packing.pack_documents(docs, WORDS, 1, capacity, pieces_per_partition=per_partition).toPandas()
        expected = Counter()
        plain = Tokenizer.from_file(WORDS)
        for i, text in rows:
            own = plain.encode(text or "", add_special_tokens=False).ids + [1]
            for k in range(0, len(own), capacity):
                part = np.array(own[k : k + capacity], "<u4").tobytes()
                expected[(-1 if i is None else i, k // capacity, k, len(part) // 4, zlib.crc32(part))] += 1
        columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
        assert Counter(map(tuple, got[columns].fillna(-1).astype(int).to_numpy().tolist())) == expected
        for _, x in got.sort_values("offset").groupby("sequence_id"):
            offset, length = x["offset"].to_numpy(), x["length"].to_numpy()
            assert offset[0] == 0 and (offset[1:] == (offset + length)[:-1]).all() and length.sum() <= capacity
        bound = packing.lower_bound(np.bincount(got["length"], minlength=capacity + 1), capacity)
        # Partitions of 20 pieces with 4 or 5 to a sequence leave more room than real ones.
        assert bound <= got["sequence_id"].nunique() <= bound * 1.02 + 1


def _pieces(spark, tmp_path, lengths):
    rows = [(n, 0, 0, int(x), 0, n) for n, x in enumerate(lengths)]
    spark.createDataFrame(rows, packing._PIECES + ", seq long").write.parquet(f"{tmp_path}/pieces")
    return spark.read.parquet(f"{tmp_path}/pieces")


def test_certificates_decide_which_partitions_give_up_bins(spark, tmp_path, monkeypatch):
    """Where the gaps of partitions explain all bins beyond the bound, the certified partition is not packed again."""
    seen, real = [], packing._release_limit
    monkeypatch.setattr(packing, "_release_limit", lambda rooms, every: seen.append((rooms, every)) or real(rooms, every))
    # Nine bins are enough for the even pieces; best-fit decreasing takes eleven. The others fill eight bins.
    part = F.when(F.col("seq") < 30, 0).otherwise(1)
    monkeypatch.setattr(packing.F, "pmod", lambda *_: part.cast("long"))
    lengths = [51, 27, 26, 23, 23] * 6 + [100] * 8
    got = packing.pack_pieces(_pieces(spark, tmp_path, lengths), 100, 30).toPandas()
    assert seen[0][1] is False and seen[0][0][(False, 0)] == (8, 8)
    assert sorted(got["seq"]) == list(range(38))
    assert (got.loc[got["seq"] >= 30, "sequence_id"] < 1 << packing._ROUND_BITS).all()


@pytest.mark.parametrize("low, high", [(20, 45), (34, 66), (51, 90)])
def test_rounds_come_near_one_packing_of_all(spark, tmp_path, low, high):
    """Partitions of 40 pieces, nearly all of them in bins that are given up; nothing is lost or overfilled."""
    lengths = np.random.default_rng(low).integers(low, high + 1, 2000)
    got = packing.pack_pieces(_pieces(spark, tmp_path, lengths), 100, 40).toPandas()
    assert sorted(got["seq"]) == list(range(2000)) and (got.sort_values("seq")["length"].to_numpy() == lengths).all()
    for _, x in got.sort_values("offset").groupby("sequence_id"):
        offset, length = x["offset"].to_numpy(), x["length"].to_numpy()
        assert offset[0] == 0 and (offset[1:] == (offset + length)[:-1]).all() and length.sum() <= 100
    whole = len(packing.best_fit_decreasing(lengths, 100)[2])
    assert got["sequence_id"].nunique() <= whole * 1.06 + 1


def test_bounds_hold_and_see_more_than_the_total():
    rng = np.random.default_rng(1)
    for _ in range(40):
        lengths = rng.integers(1, 101, 60)
        bins, offsets, room = packing.best_fit_decreasing(lengths, 100)
        assert packing.lower_bound(np.bincount(lengths, minlength=101), 100) <= len(room)
        for b in range(len(room)):
            assert lengths[bins == b].sum() == 100 - room[b] <= 100
    assert packing.lower_bound(np.bincount([51] * 10, minlength=101), 100) == 10
    assert packing.lower_bound(np.bincount([34] * 9, minlength=101), 100) == 5
    assert packing.lower_bound(np.zeros(101, int), 100) == 0


def test_empty_table(nothing):
    assert packing.pack_documents(nothing, WORDS, 1).count() == 0
    assert records.read_records(records.write_records(nothing, BYTES, 2)).count() == 0
