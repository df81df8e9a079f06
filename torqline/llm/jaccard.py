"""N-gram Jaccard join: near duplicates by rare-first prefix filtering.

A document is its set of distinct shingles (five words; fewer words are one shingle). Shingles have one global order,
rarest first: by counts over all documents in a table of hashed counters, ties by hash; shingles that then turn out to lie
in many prefixes go to the end by their exact counts. Two sets similar enough share a
shingle in their prefixes, so only prefixes are joined. Candidates must pass the length filter, the positional filter
(what can still be shared behind the common shingle) and the suffix filter (parities and counts of hash ranges, which
bound the overlap); each pair that is left is verified once, on whole sets.

Only what decides the groups is compared. Documents with equal sets are one node. Where many documents share a
prefix shingle they are held against one leader first; later comparisons are made only between documents that are not
yet connected, so a group of thousands of near copies costs about as many comparisons, not their square. The last
pass compares every remaining pair that the filters leave, so no link between two groups is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from torqline.llm import words
from torqline.llm.common import TEXT_BATCH, sent_if_small, stored
from torqline.llm.components import components

SHINGLE = 5
PERCENT = 80  # similarity of a link
COUNTERS = 1 << 16  # hashed shingle counts; they set the order only, any counts give the same links
RANGES = 128  # hash ranges of the suffix filter
PARITY = 16  # 64-bit numbers of the parity filter
SLICE_BYTES = 1 << 19  # texts that a worker cuts together; what it holds for them is about 20 times that
COUNT_TOGETHER = 1 << 18  # shingles that are counted together
LEADER_ROUNDS = 3
# Members of its main group, and others, that those outside it are held against in later rounds, where a shingle has
# four times as many outside.
LEADERS = 16
# Prefix shingles of more documents than this are put last, by their exact counts; the most frequent ones if there
# should be more of them. As any order gives the same links, neither number decides anything but the speed.
FREQUENT = 8
FREQUENT_LIMIT = 1 << 20

_WORD = ~words.byte_class(0x20, range(0x09, 0x0E))
_FACTORS = np.random.default_rng(11).integers(1, 1 << 63, SHINGLE, dtype=np.uint64) | np.uint64(1)


def shingle_sets(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(document, sorted distinct 64-bit shingle hashes) for every document of the column."""
    data, offsets = words.text_bytes(column)
    for i, j in words.slices(offsets, SLICE_BYTES):
        own, cut = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        starts, ends, first = words.word_spans(own, cut, _WORD)
        hashes = words.span_hashes(own, starts, ends)
        full = max(0, len(hashes) - SHINGLE + 1)
        joined = np.zeros(full, np.uint64)
        for k in range(SHINGLE):
            joined += hashes[k : k + full] * _FACTORS[k]
        joined = words.mixed(joined)
        for d in range(j - i):
            a, b = int(first[d]), int(first[d + 1])
            if b - a >= SHINGLE:
                yield i + d, np.unique(joined[a : b - SHINGLE + 1])
            elif b > a:
                whole = (hashes[a:b] * _FACTORS[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
                yield i + d, words.mixed(np.array([whole]))
            else:
                yield i + d, np.zeros(0, np.uint64)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _signature(shingles: np.ndarray) -> tuple[np.uint64, np.uint64]:
    return (
        words.mixed(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64),
        words.mixed(shingles + np.uint64(0x14057B7EF767814F)).sum(dtype=np.uint64),
    )


def _with_signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Set size, signature and text of the documents that have shingles."""
    for batch in batches:
        rows = [(d, len(s), *_signature(s)) for d, s in shingle_sets(batch.column(1)) if len(s)]
        at, n, a, b = (np.array(x, t) for x, t in zip(zip(*rows) if rows else [()] * 4, ("i8", "i8", "u8", "u8")))
        yield pa.RecordBatch.from_arrays(
            [pa.array(n), pa.array(_signed(a)), pa.array(_signed(b)), batch.column(1).take(pa.array(at))],
            names=["n", "sig_a", "sig_b", "text"],
        )


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Kind 0: a document, its set size and a 128-bit signature of its set. Kind 1: a counter of this task."""
    names = ["kind", "key", "n", "sig_a", "sig_b"]
    counters = np.zeros(COUNTERS, np.int64)
    held, size = [], 0
    for batch in batches:
        n, sig = np.zeros(batch.num_rows, np.int64), np.zeros((2, batch.num_rows), np.uint64)
        for d, shingles in shingle_sets(batch.column(1)):
            n[d] = len(shingles)
            sig[:, d] = _signature(shingles)
            held.append((shingles & np.uint64(COUNTERS - 1)).astype(np.int64))
            size += len(shingles)
            if size >= COUNT_TOGETHER:
                counters += np.bincount(np.concatenate(held), minlength=COUNTERS)
                held, size = [], 0
        zero = pa.array(np.zeros(batch.num_rows, np.int32))
        yield pa.RecordBatch.from_arrays(
            [zero, batch.column(0), pa.array(n), pa.array(_signed(sig[0])), pa.array(_signed(sig[1]))], names=names
        )
    counters += np.bincount(np.concatenate([*held, np.zeros(0, np.int64)]), minlength=COUNTERS)
    used = np.flatnonzero(counters)
    nothing = pa.array(np.zeros(len(used), np.int64))
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.ones(len(used), np.int32)), pa.array(used), pa.array(counters[used]), nothing, nothing], names=names
    )


def _prefixes(counts, frequent=None):
    """Prefix in global order, and how many shingles lie in each hash range, of every document with shingles."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order_of = counts.value
        known, times = frequent.value if frequent else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        for batch in batches:
            ids = batch.column(0).to_numpy()
            rows: list[tuple] = []
            for d, shingles in shingle_sets(batch.column(1)):
                n = len(shingles)
                if not n:
                    continue
                keys = [shingles, order_of[(shingles & np.uint64(COUNTERS - 1)).astype(np.int64)]]
                if len(known):
                    at = np.minimum(np.searchsorted(known, shingles), len(known) - 1)
                    keys.append(np.where(known[at] == shingles, times[at], 0))
                order = np.lexsort(keys)
                prefix = shingles[order[: n - -(-PERCENT * n // 100) + 1]]
                ranges = np.bincount((shingles >> np.uint64(64 - RANGES.bit_length() + 1)).astype(np.int64), minlength=RANGES)
                odd = np.bincount((shingles % np.uint64(64 * PARITY)).astype(np.int64), minlength=64 * PARITY) & 1
                odd = np.packbits(odd.astype(np.uint8)).view(np.int64)
                rows.append((ids[d], n, _signed(prefix), ranges.astype(np.int32), odd))
                if len(rows) == 2048:
                    yield _prefix_batch(rows)
                    rows = []
            yield _prefix_batch(rows)

    return cut


def _prefix_batch(rows: list[tuple]) -> pa.RecordBatch:
    ids, n, prefix, ranges, odd = zip(*rows) if rows else ((), (), (), (), ())
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.int64()),
            pa.array(n, pa.int64()),
            pa.array(prefix, pa.list_(pa.int64())),
            pa.array(ranges, pa.list_(pa.int32())),
            pa.array(odd, pa.list_(pa.int64())),
        ],
        names=["node", "n", "prefix", "ranges", "odd"],
    )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [_signed(s) for _, s in shingle_sets(batch.column(1))]
        for i in range(0, len(found), 1024):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, 1024), pa.array(found[i : i + 1024], pa.list_(pa.int64()))], names=["node", "shingles"]
            )


def _similar(shared, n_a, n_b):
    """shared / (n_a + n_b - shared) >= PERCENT / 100, in whole numbers."""
    return (100 + PERCENT) * shared >= PERCENT * (n_a + n_b)


class _Join:
    """The tables of one join."""

    def __init__(self, docs: DataFrame, every: DataFrame | None = None):
        self.docs = docs  # node, text; one row per distinct set
        # The same and rows of other nodes, cheaper to read: texts of given nodes come from here.
        self.every = docs if every is None else every
        self.verified: list[DataFrame] = []  # (a, b) compared so far
        self.links: list[DataFrame] = []
        self.known: list[DataFrame] = []  # node, shingles of the documents compared so far

    def prepare(self, counts) -> None:
        schema = "node long, n long, prefix array<long>, ranges array<int>, odd array<long>"
        nodes = stored(self.docs.mapInArrow(_prefixes(counts), schema), "prefixes", TEXT_BATCH)
        prefix = nodes.select("node", F.explode("prefix").alias("shingle"))
        often = stored(prefix.groupBy("shingle").count().filter(F.col("count") > FREQUENT), "frequent")
        # How many have each count: the highest counts that are FREQUENT_LIMIT shingles at most.
        room, least = FREQUENT_LIMIT, FREQUENT
        for row in often.groupBy("count").agg(F.count("*").alias("shingles")).orderBy(F.desc("count")).toLocalIterator():
            room -= row["shingles"]
            if room < 0:
                least = row["count"]
                break
        often = often.filter(F.col("count") > least)
        found = often.toPandas()  # FREQUENT_LIMIT rows of two numbers at most
        if len(found):
            shingles = found["shingle"].to_numpy().view(np.uint64)
            sort = np.argsort(shingles)
            frequent = self.docs.sparkSession.sparkContext.broadcast((shingles[sort], found["count"].to_numpy()[sort]))
            # The prefixes of other documents stay as they are.
            moved = stored(prefix.join(F.broadcast(often.select("shingle")), "shingle").select("node").distinct(), "moved")
            moved = sent_if_small(moved, moved.count(), 24)
            again = self.every.join(moved, "node", "left_semi").mapInArrow(_prefixes(counts, frequent), schema)
            nodes = nodes.join(moved, "node", "left_anti").unionByName(stored(again, "prefixes", TEXT_BATCH))
        self.nodes = nodes
        prefix = nodes.select("node", "n", F.posexplode("prefix").alias("pos", "shingle"))
        common = prefix.groupBy("shingle").count().filter("count > 1").select("shingle")
        self.shared = stored(prefix.join(common, "shingle"), "shared")

    def verify(self, pairs: DataFrame) -> None:
        """Adds the links among ``pairs`` (a, b, n_a, n_b); each pair is compared once."""
        new = stored(pairs.dropDuplicates(["a", "b"]), "pairs")
        for done in self.verified:
            new = new.join(done.select("a", "b"), ["a", "b"], "left_anti")
        ranges = self.nodes.select("node", "ranges")
        bound = F.aggregate(
            F.zip_with("ranges_a", "ranges_b", lambda x, y: F.least(x, y)), F.lit(0), lambda total, x: total + x
        )
        new = (
            new.join(ranges.select(F.col("node").alias("a"), F.col("ranges").alias("ranges_a")), "a")
            .join(ranges.select(F.col("node").alias("b"), F.col("ranges").alias("ranges_b")), "b")
            .filter(_similar(bound, F.col("n_a"), F.col("n_b")))
            .select("a", "b", "n_a", "n_b")
        )
        new = stored(new, "candidates")
        self.verified.append(new)
        here = stored(
            new.select(F.col("a").alias("node")).unionByName(new.select(F.col("b").alias("node"))).distinct(), "compared"
        )
        here, rows = sent_if_small(here, size := here.count(), 24), here
        needed = rows
        for have in self.known:
            needed = needed.join(have.select("node"), "node", "left_anti")
        texts = self.every.join(sent_if_small(needed, size, 24), "node", "left_semi").select("node", "text")
        self.known.append(stored(texts.mapInArrow(_sets, "node long, shingles array<long>"), "sets", TEXT_BATCH))
        sets = self.known[0]
        for more in self.known[1:]:
            sets = sets.unionByName(more)
        sets = sets.join(here, "node", "left_semi")
        found = (
            new.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b")), "b")
            .filter(_similar(F.size(F.array_intersect("set_a", "set_b")), F.col("n_a"), F.col("n_b")))
        )
        self.links.append(stored(found.select("a", "b"), "links"))

    def groups(self, rounds: int | None = None) -> DataFrame:
        links = self.links[0]
        for more in self.links[1:]:
            links = links.unionByName(more)
        return components(links, rounds)

    def labelled(self) -> DataFrame:
        """The shared prefix rows whose shingle still joins different groups, with their group.

        ``out`` marks rows outside the largest group of their shingle, ``outsiders`` is how many these are.
        """
        if not self.links:
            rows = self.shared.withColumn("group", F.col("node"))
        else:
            groups = self.groups(rounds=4)
            rows = self.shared.join(groups, self.shared["node"] == groups["node"], "left").select(
                self.shared["*"], F.coalesce("component", self.shared["node"]).alias("group")
            )
            rows = stored(rows, "labelled")
        sizes = rows.groupBy("shingle", "group").count()
        main = sizes.groupBy("shingle").agg(
            F.max(F.struct("count", "group")).alias("m"), F.sum("count").alias("all"), F.count("*").alias("groups")
        )
        main = main.filter("groups > 1").select(
            "shingle", F.col("m.group").alias("main"), (F.col("all") - F.col("m.count")).alias("outsiders")
        )
        return rows.join(main, "shingle").withColumn("out", F.col("group") != F.col("main")).drop("main")

    @staticmethod
    def pairs(left: DataFrame, right: DataFrame, complete: bool = False) -> DataFrame:
        """Pairs of ``left`` and ``right`` with a common prefix shingle, of different groups, that pass the first filters.

        If every common prefix shingle of a pair is met here (``complete``, with ``out`` flags on both sides, so that each is
        met once), what they share is at most these shingles and what lies behind the last of them. The rows then carry
        the parities of their sets, too: sets that differ in d shingles differ in d parities at most, and in nearly as
        many while sets are small, so few pairs but those that are links leave the join.
        """
        columns = ["node", "n", "pos", "group", *(["out", "odd"] if complete else [])]
        one = left.select("shingle", *[F.col(c).alias(f"{c}_x") for c in columns])
        two = right.select("shingle", *[F.col(c).alias(f"{c}_y") for c in columns])
        behind = F.least(F.col("n_x") - F.col("pos_x"), F.col("n_y") - F.col("pos_y"))
        once = F.lit(True)
        if complete:
            once = ~F.col("out_y") | (F.col("node_x") < F.col("node_y"))
            apart = [F.bit_count(F.col("odd_x")[k].bitwiseXOR(F.col("odd_y")[k])) for k in range(PARITY)]
            differ = reduce(lambda x, y: x + y, apart)
            # shared = (n_x + n_y - differ) / 2 at most
            once &= (100 + PERCENT) * (F.col("n_x") + F.col("n_y") - differ) >= 2 * PERCENT * (F.col("n_x") + F.col("n_y"))
        kept = one.join(
            two,
            (one["shingle"] == two["shingle"])
            & (F.col("group_x") != F.col("group_y"))
            & (100 * F.least("n_x", "n_y") >= PERCENT * F.greatest("n_x", "n_y"))
            & _similar(behind, F.col("n_x"), F.col("n_y"))
            & once,
        )
        swap = F.col("node_x") > F.col("node_y")
        found = kept.groupBy(
            F.least("node_x", "node_y").alias("a"),
            F.greatest("node_x", "node_y").alias("b"),
            F.when(swap, F.col("n_y")).otherwise(F.col("n_x")).alias("n_a"),
            F.when(swap, F.col("n_x")).otherwise(F.col("n_y")).alias("n_b"),
        ).agg(F.count("*").alias("met"), F.min(behind).alias("behind"))
        if complete:
            found = found.filter(_similar(F.col("met") + F.col("behind") - 1, F.col("n_a"), F.col("n_b")))
        return found.select("a", "b", "n_a", "n_b")

    @staticmethod
    def leaders(rows: DataFrame, turn: int, number: int = 1) -> DataFrame:
        """``number`` rows of each shingle at most, the same documents wherever they can be."""
        drawn = F.struct(F.xxhash64(F.lit(turn), "node").alias("draw"), "node", "n", "pos", "group")
        slot = F.pmod(F.xxhash64(F.lit(turn + 100), "node"), F.lit(number)).alias("slot")
        return rows.groupBy("shingle", slot).agg(F.min(drawn).alias("l")).select("shingle", "l.node", "l.n", "l.pos", "l.group")

    def run(self) -> DataFrame:
        for turn in range(LEADER_ROUNDS):
            rows = stored(self.labelled(), "remaining")
            tries = self.pairs(rows, self.leaders(rows, turn))
            if turn:
                # Who is still outside tries several members of the main group, and of the others.
                crowded = rows.filter(F.col("outsiders") > 4 * LEADERS)
                for side in (crowded.filter("NOT out"), crowded.filter("out")):
                    tries = tries.unionByName(self.pairs(crowded.filter("out"), self.leaders(side, turn, LEADERS)))
            self.verify(tries)
        # Every pair of different groups has a side outside the largest group of its shingle.
        rows = stored(self.labelled(), "remaining").join(self.nodes.select("node", "odd"), "node")
        self.verify(self.pairs(rows.filter("out"), rows, complete=True))
        return self.groups()


def near_duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id reachable by links, itself included) of every document.

    Words are runs of characters other than white space, A-Z as a-z. Null texts and texts without words have no
    shingles, link with nothing and are components of their own. Rows without an id get their n_shingles and no
    component, and link nothing. Rows that share an id are one node: links of any of them connect it, and all of them
    get its component; inside, each of its sets is compared on its own. Repeated rows are linked like other equal texts. An empty table gives an empty result; other columns are not read.

    Only ``COUNTERS`` counts reach the driver and are broadcast, however large the table.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    first = stored(
        rows.mapInArrow(_signatures, "kind int, key long, n long, sig_a long, sig_b long"), "signatures", TEXT_BATCH
    )
    counts = np.zeros(COUNTERS, np.int64)
    for row in first.filter("kind = 1").groupBy("key").agg(F.sum("n").alias("n")).collect():
        counts[row["key"]] = row["n"]
    order = spark.sparkContext.broadcast(counts)
    each = first.filter("kind = 0").select(F.col("key").alias("doc_id"), "n", "sig_a", "sig_b")
    key = ["n", "sig_a", "sig_b"]
    # Ids of rows with different sets do not tell which set is meant, so none of them stands for a set.
    torn = stored(
        each.filter("doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min(F.struct(*key)).alias("low"), F.max(F.struct(*key)).alias("high"))
        .filter("low != high")
        .select("doc_id"),
        "torn",
    )
    many = torn.count()
    marked = each.filter("n > 0")
    if many:
        flags = sent_if_small(torn.select("doc_id", F.lit(True).alias("torn")), many, 24)
        marked = marked.join(flags, "doc_id", "left").withColumn("whole_id", F.expr("if(torn, null, doc_id)"))
    else:
        marked = marked.withColumn("whole_id", F.col("doc_id"))
    sets = stored(
        marked.groupBy(*key)
        .agg(F.min("whole_id").alias("own"), F.min("doc_id").alias("least_id"), F.count("*").alias("rows"))
        .select(
            *key,
            # Sets of such ids only are named by a hash.
            F.when(F.col("least_id").isNotNull(), F.coalesce("own", F.xxhash64(*key))).alias("node"),
            "own",
            "least_id",
            "rows",
        ),
        "nodes",
    )
    # Copies of a set are left out before their texts are cut again.
    copies = stored(
        each.filter("n > 0 AND doc_id IS NOT NULL")
        .join(sets.filter("rows > 1 AND own IS NOT NULL").select(*key, "own"), key)
        .filter("doc_id > own")
        .select("doc_id")
        .unionByName(torn),
        "copies",
    )
    known = rows.filter("doc_id IS NOT NULL")
    alone = known.join(sent_if_small(copies, copies.count(), 24), "doc_id", "left_anti")
    # A node names its own row, so the rows of given nodes are found without leaving out the copies again.
    texts, every = (part.select(F.col("doc_id").alias("node"), "text") for part in (alone, known))
    if many:
        parts = known.join(sent_if_small(torn, many, 24), "doc_id", "left_semi")
        parts = stored(
            parts.mapInArrow(_with_signatures, "n long, sig_a long, sig_b long, text string"), "torn-texts", TEXT_BATCH
        )
        unnamed = sets.filter("own IS NULL AND node IS NOT NULL").select(*key, "node")
        torn_sets = stored(parts.join(unnamed, key).groupBy("node").agg(F.min("text").alias("text")), "torn-sets")
        texts, every = (part.unionByName(torn_sets) for part in (texts, every))
    join = _Join(texts, every)
    if many:
        held = each.filter("n > 0").join(sent_if_small(torn, many, 24), "doc_id", "left_semi")
        held = stored(held.join(sets.select(*key, "node"), key).select("doc_id", "node").distinct(), "torn-nodes")
        hub = held.groupBy("doc_id").agg(F.min("node").alias("a"))
        join.links.append(
            stored(held.join(hub, "doc_id").filter("a < node").select("a", F.col("node").alias("b")), "links")
        )
    join.prepare(order)
    groups = join.run()
    component = sets.join(groups, "node", "left").select(
        *key, "node", "least_id", F.coalesce("component", "node").alias("component_id")
    )
    own = F.coalesce("component_id", "doc_id")
    if many:
        # A group is named by its smallest doc_id, which need not be the name of a set here.
        component = stored(component, "torn-components")
        names = component.groupBy("component_id").agg(F.min("least_id").alias("name")).filter("name != component_id")
        names = stored(names, "names")
        component = stored(
            component.join(sent_if_small(names, names.count(), 24), "component_id", "left").select(
                *key, "node", F.coalesce("name", "component_id").alias("component_id")
            ),
            "named",
        )
        # Rows of such an id that have no shingles get the component of the others.
        of_id = held.join(component.select("node", "component_id"), "node").groupBy("doc_id")
        of_id = stored(of_id.agg(F.min("component_id").alias("shared_component")), "torn-groups")
        each = each.join(sent_if_small(of_id, many, 24), "doc_id", "left")
        own = F.coalesce("shared_component", "component_id", "doc_id")
    found = each.join(component.select(*key, "component_id"), key, "left")
    return found.select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), own).alias("component_id")
    )


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` but those whose group has a smaller doc_id; rows without an id stay."""
    groups = near_duplicate_groups(docs, id_col, text_col)
    gone = stored(groups.filter("component_id < doc_id").select(F.col("doc_id").alias("_tq_gone")).distinct(), "dropped")
    return docs.join(sent_if_small(gone, gone.count(), 24), F.col(id_col).cast("long") == F.col("_tq_gone"), "left_anti")
