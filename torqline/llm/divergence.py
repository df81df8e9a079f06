"""Source divergence audit: how the terms of each source differ from other sources, and from all, of its language.

The vocabulary of a language (terms in enough of its documents) is a set of minimal acyclic transducers, each built from
a bounded stretch of the sorted terms. They turn a term into its number in UTF-8 order. Texts are streamed through them
for the counts, which are then counts of numbers; ties are broken by numbers, and terms are spelled again only for the
few that are reported.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from torqline.llm.common import BROADCAST_BYTES, sent_if_small, stored
from torqline.llm.transducer import Transducer

MIN_DOCUMENTS = 3
SCALE = 1_000_000_000
TOP = 200
BLOCK_BYTES = 4 << 20  # bytes of a transducer's terms, beyond which it takes no more
_CELLS = 1 << 18  # shares that are compared at a time
_TERM = re.compile(rb"[A-Za-z\x80-\xff]+")


@dataclass(frozen=True)
class Sizes:
    """What is held at a time; results do not depend on it."""

    block_terms: int = 1 << 16  # terms of a transducer at most
    source_block: int = 256  # sources whose sums against all others a task holds
    held: int = 1 << 18  # counts a task gathers before it sends them on


def _terms(text: bytes | None) -> list[bytes]:
    return _TERM.findall((text or b"").lower())


def _document_counts(limit: int):
    """lang, term and in how many documents here."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> pa.RecordBatch:
            flat = [(lang, term, n) for lang, counts in held.items() for term, n in counts.items()]
            lang, term, n = zip(*flat) if flat else ((), (), ())
            term = pa.array(term, pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), term, pa.array(n, pa.int64())], names=["lang", "term", "docs"])

        held: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(2).cast(pa.large_binary()).to_pylist()):
                held.setdefault(lang, Counter()).update(set(_terms(text)))
            if sum(map(len, held.values())) >= limit:
                yield rows()
                held = {}
        yield rows()

    return count


_BLOCKS = "lang string, low string, n_terms long, arcs long, longest long, keys binary, targets binary, adds binary, final binary"


def _transducers(block_terms: int):
    """Transducers of sorted (lang, term)."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block() -> pa.RecordBatch:
            made = Transducer.build(held)
            row = [lang, held[0].decode(), len(held), len(made.keys), made.longest]
            row += [x.astype(t).tobytes() for x, t in ((made.keys, "i8"), (made.targets, "i4"), (made.adds, "i4"), (made.final, "?"))]
            types = [pa.string()] * 2 + [pa.int64()] * 3 + [pa.binary()] * 4
            return pa.RecordBatch.from_arrays(
                [pa.array([x], t) for x, t in zip(row, types)], names=[c.split()[0] for c in _BLOCKS.split(", ")]
            )

        lang, held, size = None, [], 0
        for batch in batches:
            for own, term in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                if held and (own != lang or len(held) == block_terms or size > BLOCK_BYTES):
                    yield block()
                    held, size = [], 0
                lang = own
                held.append(term)
                size += len(term)
        if held:
            yield block()

    return make


class _Vocabulary:
    """Some transducers, by language and in order of their terms."""

    def __init__(self, blocks: list[dict]):
        self.of: dict[str, tuple[list[bytes], list[tuple[int, int, Transducer]]]] = {}
        for b in blocks:
            lows, made = self.of.setdefault(b["lang"], ([], []))
            lows.append(b["low"].encode())
            arrays = [np.frombuffer(b[c], t) for c, t in (("keys", "i8"), ("targets", "i4"), ("adds", "i4"), ("final", "?"))]
            made.append((b["base"], b["n_terms"], Transducer(*(x.astype(np.int64) for x in arrays[:3]), arrays[3], b["longest"])))

    def ordinals(self, lang: str, terms: list[bytes]) -> np.ndarray:
        """The number of each term in its language, -1 for terms that are not here."""
        lows, made = self.of.get(lang, ([], []))
        out = np.full(len(terms), -1, np.int64)
        at = np.array([bisect_right(lows, t) - 1 for t in terms], np.int64)
        for k in np.unique(at[at >= 0]).tolist():
            rows = np.flatnonzero(at == k)
            base, _, own = made[k]
            found = own.ordinals([terms[i] for i in rows.tolist()])
            out[rows] = np.where(found >= 0, found + base, -1)
        return out

    def spelled(self, lang: str, ordinal: int) -> bytes | None:
        """The term with this number; none if it is not here."""
        for base, terms, own in self.of.get(lang, ([], []))[1]:
            if base <= ordinal < base + terms:
                return own.term(ordinal - base)
        return None


def _recounted(vocabulary, numbers, limit: int):
    """Number of a group, number of a term and how often it occurs there."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, dict[str, Counter]] = {}
        keys: list[np.ndarray] = []  # rows of group, term and count
        waiting = 0

        def look_up() -> None:
            nonlocal waiting
            for lang, sources in held.items():
                terms = list(set().union(*sources.values()))
                number_of = dict(zip(terms, vocabulary.value.ordinals(lang, terms).tolist()))
                for source, counts in sources.items():
                    rows = np.empty((3, len(counts)), np.int64)
                    rows[0] = numbers.value[lang, source]
                    rows[1] = np.fromiter(map(number_of.__getitem__, counts), np.int64, len(counts))
                    rows[2] = np.fromiter(counts.values(), np.int64, len(counts))
                    keys.append(rows[:, rows[1] >= 0])
                    waiting += keys[-1].shape[1]
            held.clear()

        def rows() -> pa.RecordBatch:
            nonlocal waiting
            group, term, n = np.concatenate([np.zeros((3, 0), np.int64), *keys], axis=1)
            order = np.lexsort([term, group])
            group, term, n = group[order], term[order], n[order]
            first = np.ones(len(n), bool)
            first[1:] = (group[1:] != group[:-1]) | (term[1:] != term[:-1])
            at = np.flatnonzero(first)
            keys.clear()
            waiting = 0
            columns = [group[at], term[at], np.add.reduceat(n, at) if len(at) else n]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["g", "term", "n"])

        for batch in batches:
            columns = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.large_binary()).to_pylist()
            for lang, source, text in zip(*columns):
                if lang in vocabulary.value.of:
                    held.setdefault(lang, {}).setdefault(source, Counter()).update(_terms(text))
            if sum(len(c) for sources in held.values() for c in sources.values()) >= limit:
                look_up()
                if waiting >= 8 * limit:
                    yield rows()
        look_up()
        yield rows()

    return count


def _pair_sums(at_zero, source_block: int):
    """Sums of f over the terms here, for a block of sources against all sources of their language."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[pa.RecordBatch]:
            b = np.arange(sums.shape[1])
            for i in range(len(sums)):
                columns = [np.full(len(b), lang), np.full(len(b), low + i), b, sums[i]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["l", "a", "b", "value"])

        lang = block = sums = low = None
        for batch in batches:
            langs, blocks = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            lists = batch.column(2)
            ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            flat = lists.flatten()
            source, share = flat.field("s").to_numpy(), flat.field("p").to_numpy()
            cuts = np.flatnonzero((np.diff(langs) != 0) | (np.diff(blocks) != 0)) + 1
            for first, last in zip([0, *cuts.tolist()], [*cuts.tolist(), len(langs)]):
                if first == last:
                    continue
                if (langs[first], blocks[first]) != (lang, block):
                    if sums is not None:
                        yield from rows()
                    lang, block = langs[first], blocks[first]
                    zero = at_zero.value[lang]
                    low, high = block * source_block, min((block + 1) * source_block, len(zero))
                    sums = np.zeros((high - low, len(zero)), np.int64)
                # Some terms at a time, as rows of shares of all sources.
                step = max(1, _CELLS // len(zero))
                for i in range(first, last, step):
                    j = min(last, i + step)
                    p = np.repeat(zero[None, :], j - i, axis=0)
                    own = slice(ends[i], ends[j])
                    p[np.repeat(np.arange(j - i), np.diff(ends[i : j + 1])), source[own]] = share[own]
                    for k in range(low, high):
                        gap = p[:, k : k + 1] - p
                        sums[k - low] += (gap * gap // p).sum(axis=0)
        if sums is not None:
            yield from rows()

    return add


def _share(n: Column, total: Column) -> Column:
    """1 + floor(SCALE * (n + 1) / total), in whole numbers of any size."""
    scaled = F.lit(SCALE).cast("decimal(10,0)") * (n + 1).cast("decimal(20,0)")
    return F.call_function("div", scaled, total.cast("decimal(20,0)")) + 1


def _gap(p: Column, q: Column) -> Column:
    wide = (p - q).cast("decimal(19,0)")
    return F.call_function("div", wide * wide, q.cast("decimal(19,0)"))


def source_divergence(docs: DataFrame, min_docs: int = MIN_DOCUMENTS, top: int = TOP, sizes: Sizes = Sizes()) -> DataFrame:
    """lang, source, part, item, value and rank.

    Terms are runs of ASCII letters and of all non-ASCII characters, A-Z as a-z. A language keeps the terms of at least
    ``min_docs`` of its documents; V is their number. Every group (lang and source, and lang on its own) gives each of
    them p = 1 + floor(10^9 (count + 1) / (N + V)), N the count of all. f = floor((p - q)^2 / q), p the group's.
    Part ``pair``: item is another source of the language, q its p, value f summed over all kept terms (0 without any).
    Part ``term``: item is a kept term with p > q that occurs in the group, q the language's, value f, to rank ``top``.
    Ranks count from 1 for each group and part, by value descending, then item in UTF-8 order.

    Null texts, langs and sources count as empty ones; every row is a document, repeated rows too; empty texts make
    their group known and count nothing; other columns are not read; an empty table gives an empty result.

    The vocabulary passes the driver in transducers of ``BROADCAST_BYTES`` together at most; a larger one takes a pass
    over the texts for each of them. The sources of a language are held by the driver as two numbers each: the result has
    their square.
    """
    spark = docs.sparkSession
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counted = rows.mapInArrow(_document_counts(sizes.held), "lang string, term string, docs long")
    kept = counted.groupBy("lang", "term").agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= min_docs)
    kept = kept.select("lang", "term").repartitionByRange("lang", "term").sortWithinPartitions("lang", "term")
    blocks = stored(kept.mapInArrow(_transducers(sizes.block_terms), _BLOCKS), "transducers")

    # Numbers go on from one transducer of a language to the next.
    found = blocks.select("lang", "low", "n_terms", (24 * F.col("arcs") + F.octet_length("final")).alias("bytes")).collect()
    total: dict[str, int] = {}
    groups_of: list[list[tuple[str, str, int]]] = []
    room = 0
    for b in sorted(found, key=lambda b: (b["lang"].encode(), b["low"].encode())):
        if room < b["bytes"]:
            groups_of.append([])
            room = BROADCAST_BYTES
        groups_of[-1].append((b["lang"], b["low"], total.get(b["lang"], 0)))
        room -= b["bytes"]
        total[b["lang"]] = total.get(b["lang"], 0) + b["n_terms"]

    def vocabulary(part: list[tuple[str, str, int]]):
        wanted = F.broadcast(spark.createDataFrame(part, "lang string, low string, base long"))
        found = [r.asDict() for r in blocks.join(wanted, ["lang", "low"]).collect()]
        return spark.sparkContext.broadcast(_Vocabulary(sorted(found, key=lambda b: (b["lang"].encode(), b["base"]))))

    # Numbers of languages, of groups and of the sources of a language.
    named = sorted((r["lang"], r["source"]) for r in rows.select("lang", "source").distinct().toLocalIterator())
    langs = sorted({lang for lang, _ in named})
    sources = Counter(lang for lang, _ in named)
    place = Counter()
    entries = []
    for g, (lang, source) in enumerate(named):
        entries.append((g, langs.index(lang), place[lang], lang, source, total.get(lang, 0)))
        place[lang] += 1
    listed = "g long, l long, s long, lang string, source string, v long"
    groups = stored(spark.createDataFrame(entries, listed), "groups")
    numbers = spark.sparkContext.broadcast({pair: g for g, pair in enumerate(named)})

    counts = spark.createDataFrame([], "g long, term long, n long")
    for part in groups_of:
        some = rows.mapInArrow(_recounted(vocabulary(part), numbers, sizes.held), "g long, term long, n long")
        counts = counts.unionByName(stored(some.groupBy("g", "term").agg(F.sum("n").alias("n")), "recounted"))

    # N + V of every group and of its language.
    sums = counts.groupBy("g").agg(F.sum("n").alias("own"))
    own = F.coalesce("own", F.lit(0).cast("long"))
    groups = groups.join(sums, "g", "left").select(
        *groups.columns,
        (own + F.col("v")).alias("mass"),
        (F.sum(own).over(Window.partitionBy("l")) + F.col("v")).alias("lang_mass"),
    )
    groups = stored(groups, "masses")
    known = groups.filter("v > 0").select("l", "s", _share(F.lit(0), F.col("mass")).alias("p")).orderBy("l", "s")
    zero: dict[int, list[int]] = {}
    for g in known.toLocalIterator():
        zero.setdefault(g["l"], []).append(g["p"])
    at_zero = spark.sparkContext.broadcast({l: np.array(p, np.int64) for l, p in zero.items()})

    few = sent_if_small(groups, len(named), 80)
    shares = counts.join(few.select("g", "l", "s", "mass", "lang_mass"), "g")
    shares = shares.withColumn("p", _share(F.col("n"), F.col("mass")))
    of_term = shares.groupBy("l", "term").agg(
        F.sum("n").alias("lang_n"),
        F.max("lang_mass").alias("lang_mass"),
        F.collect_list(F.struct("s", "p")).alias("counts"),  # as many as the language has sources
    )
    of_term = stored(of_term, "terms")

    blocks_of = [(langs.index(l), k) for l, n in sources.items() for k in range(-(-n // sizes.source_block))]
    blocks_of = spark.createDataFrame(blocks_of, "l long, block long")
    dealt = (
        of_term.join(sent_if_small(blocks_of, len(named), 16), "l")
        # The terms of a language and a block of its sources lie in as many tasks as there are.
        .repartition("l", "block", F.pmod(F.xxhash64("term"), F.lit(1024)))
        .sortWithinPartitions("l", "block")
        .select("l", "block", "counts")
    )
    against = dealt.mapInArrow(_pair_sums(at_zero, sizes.source_block), "l long, a long, b long, value long")
    against = against.groupBy("l", "a", "b").agg(F.sum("value").alias("value"))
    one = groups.select("l", "lang", "source", F.col("s").alias("a"))
    other = groups.select("l", F.col("source").alias("item"), F.col("s").alias("b"))
    pairs = one.join(other, "l").filter("a != b").join(against, ["l", "a", "b"], "left")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0).cast("long")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    pairs = pairs.withColumn("rank", F.row_number().over(order))

    ahead = of_term.withColumn("q", _share(F.col("lang_n"), F.col("lang_mass"))).select("l", "term", "q", F.inline("counts"))
    ahead = ahead.filter("p > q").select("l", "s", "term", _gap(F.col("p"), F.col("q")).alias("value"))
    # Partitions keep their first ranks before rows move.
    by_value = Window.partitionBy("l", "s").orderBy(F.desc("value"), "term")
    ahead = ahead.withColumn("rank", F.row_number().over(by_value)).filter(F.col("rank") <= top)
    ahead = stored(ahead.join(few.select("l", "s", "lang", "source"), ["l", "s"]).select("lang", "source", "term", "value", "rank"), "ahead")
    for part in groups_of:
        spelled = "lang string, source string, part string, item string, value long, rank int"
        pairs = pairs.unionByName(ahead.mapInArrow(_spelled(vocabulary(part)), spelled))
    return pairs


def _spelled(vocabulary):
    """Rows whose terms are here, with the terms."""

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, number = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            term = [vocabulary.value.spelled(a, b) for a, b in zip(lang, number)]
            here = pa.array([t is not None for t in term], pa.bool_())
            part = pa.array(["term"] * len(term), pa.string())
            columns = [batch.column(0), batch.column(1), part, pa.array(term, pa.binary()).cast(pa.string()), batch.column(3), batch.column(4)]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "part", "item", "value", "rank"]).filter(here)

    return spell
