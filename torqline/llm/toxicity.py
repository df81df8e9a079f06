"""Toxicity by a weighted lexicon, found by Aho-Corasick in folded text.

Texts are folded first: lower case, look-alike letters of other scripts and full-width forms to Latin ones, digits
and signs inside words to the letters they stand for; runs of other characters become one space. The lexicon holds
whole words and word beginnings with weights learnt from labelled rows, and exception phrases: two-word contexts in
which a word of the lexicon occurs in harmless texts only. The hits of a text, less those inside exceptions, are
summed, put in relation to its length and turned into a probability.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from torqline.llm.samples import at_most, labels_of

SAMPLE_ROWS = 20_000  # labelled rows of each kind that the lexicon and the scale are fitted on
MIN_CONTEXTS = 5  # different neighbours a word needs in toxic texts, so that copies of one text count once
MIN_PRECISION = 0.85
MIN_DEVIATIONS = 4.0  # standard deviations by which an entry's toxic texts must exceed what chance gives
STEMS = (4, 5, 6)  # lengths of word beginnings
STEM_CONTEXTS = 25
EXCEPTION_TEXTS = 3

# Letters of other scripts drawn like Latin ones.
_LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ѐ": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l",
    "м": "m", "н": "h", "о": "o", "р": "p", "ԛ": "q", "г": "r", "ѕ": "s", "т": "t", "ѵ": "v", "ԝ": "w", "х": "x", "у": "y",
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ω": "w",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ո": "n", "ս": "u", "օ": "o", "ց": "g", "հ": "h",
}
# Digits and signs used for letters.
_DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "l"}
_FOLD = str.maketrans(_LOOKALIKES | {chr(0xFF01 + n): chr(0x21 + n).lower() for n in range(94)})
_FOREIGN = re.compile("[" + "".join(map(re.escape, _LOOKALIKES)) + "！-～​-‍﻿­]")
_INVISIBLE = re.compile("[​-‍﻿­]")
_INSIDE = re.compile(r"(?<=[^\W\d_])[0134578@$!|]+(?=[^\W\d_])|(?<![^\W_])[01345@$78]+(?=[^\W\d_])|(?<=[^\W\d_])[0134578]+(?![^\W_])")
_SIGN = re.compile("[0134578@$|!]")
_GAP = re.compile(r"[\W_]+")
_TO_LETTERS = str.maketrans(_DIGITS)


def folded(text: str | None) -> str:
    """Words of the folded text between single spaces, with one space before and after; one space for an empty text."""
    if not text:
        return " "
    text = text.lower()
    if not text.isascii() and _FOREIGN.search(text):
        text = _INVISIBLE.sub("", text).translate(_FOLD)
    if _SIGN.search(text):
        text = _INSIDE.sub(lambda m: m[0].translate(_TO_LETTERS), text)
    return f" {_GAP.sub(' ', text).strip()} " if not text.isspace() else " "


def _entries(text: str) -> Iterator[tuple[str, str]]:
    """(entry, context): every word and its beginnings, with the words before and after it."""
    tokens = ["", *text.split(), ""]
    for before, word, after in zip(tokens, tokens[1:], tokens[2:]):
        context = f"{before} {after}"
        yield f" {word} ", context
        for k in STEMS:
            if len(word) > k:
                yield f" {word[:k]}", context


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct (entry, context) of every document."""
    for batch in batches:
        for text in batch.column(0):
            rows = set(_entries(folded(text.as_py())))
            entries, contexts = zip(*rows) if rows else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(entries, pa.string()), pa.array(contexts, pa.string())], names=["entry", "context"]
            )


def _precise(t: int, h: int, stands_for: dict[int, float]) -> bool:
    """Whether the toxic share among all labelled texts with an entry, from the sampled ones, is high enough."""
    return t * stands_for[1] >= MIN_PRECISION * (t * stands_for[1] + h * stands_for[0])


def _lexicon(sample: DataFrame, toxic: int, harmless: int, stands_for: dict[int, float]) -> dict[str, float]:
    """Entries with enough different contexts in toxic texts that few harmless texts hold, with log-odds weights.

    Contexts, not texts, are counted on the toxic side: the words of a text with many copies are no lexicon. Both
    lists that pass the driver are bounded by the sample. A sampled row of class k is one of ``stands_for[k]``.
    """
    found = sample.filter("label = 1").select("text").mapInArrow(_contexts, "entry string, context string")
    pairs = found.groupBy("entry", F.xxhash64("context").alias("context")).agg(F.lit(1).alias("one"))
    enough = F.when(F.col("entry").endswith(" "), F.lit(MIN_CONTEXTS)).otherwise(F.lit(STEM_CONTEXTS))
    often = {
        row["entry"]: row["t"]
        for row in pairs.groupBy("entry").agg(F.count("*").alias("t")).filter(F.col("t") >= enough).collect()
    }

    def presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[str, int], int] = {}
        for batch in batches:
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for entry in {e for e, _ in _entries(folded(text.as_py()))}:
                    if entry in often:
                        counts[entry, label] = counts.get((entry, label), 0) + 1
        entries, labels = zip(*counts) if counts else ((), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(entries, pa.string()), pa.array(labels, pa.int32()), pa.array(list(counts.values()), pa.int64())],
            names=["entry", "label", "n"],
        )

    texts = sample.mapInArrow(presence, "entry string, label int, n long")
    held = {
        row["entry"]: (row["t"] or 0, row["h"] or 0)
        for row in texts.groupBy("entry")
        .agg(F.sum(F.col("n") * F.col("label")).alias("t"), F.sum(F.col("n") * (1 - F.col("label"))).alias("h"))
        .collect()
    }
    weights = {}
    for entry in sorted(often, key=lambda e: (-often[e], e)):
        t, h = held.get(entry, (0, 0))
        weight = math.log((t + 0.5) / toxic) - math.log((h + 0.5) / harmless)
        by_chance, share = (t + h) * toxic / (toxic + harmless), toxic / (toxic + harmless)
        # As much as the entry's rates in the two classes differ by: that holds in counts of the sample, however each
        # class was sampled; rows counted several times would pass for more evidence than there is.
        beyond = t - by_chance >= MIN_DEVIATIONS * math.sqrt(by_chance * (1 - share))
        if _precise(t, h, stands_for) and beyond and weight > 0.5:
            weights[entry] = weight
    return weights


def automaton(lexicon: dict[str, float], exceptions: set[str]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for entry, weight in lexicon.items():
        found.add_word(entry, (len(entry), weight))
    for phrase in exceptions:
        found.add_word(phrase, (len(phrase), None))
    if len(found):
        found.make_automaton()
    return found


def hits(matcher: ahocorasick.Automaton, text: str) -> tuple[float, int]:
    """(weight, words) of a folded text: each word counts once, by its strongest entry, unless an exception covers it."""
    if not len(matcher):
        return 0.0, text.count(" ") - 1
    best: dict[int, float] = {}
    excused: list[tuple[int, int]] = []
    for end, (length, weight) in matcher.iter(text):
        start = end - length + 1
        if weight is None:
            excused.append((start, end))
        elif weight > best.get(start, 0.0):
            best[start] = weight
    # Spans that overlap become one, so a word asks only the last span that begins at or before it.
    opens, closes = [], []
    for start, end in sorted(excused):
        if closes and start <= closes[-1]:
            closes[-1] = max(closes[-1], end)
        else:
            opens.append(start)
            closes.append(end)

    def covered(at: int) -> bool:
        span = bisect_right(opens, at) - 1
        return span >= 0 and at < closes[span]

    total = sum(w for at, w in best.items() if not covered(at))
    return total, max(0, text.count(" ") - 1)


def _inputs(total: float, n: int) -> tuple[float, float, float]:
    return total, math.log1p(total), math.log1p(100.0 * total / (n + 1))


def _fit_scale(x: np.ndarray, y: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps with a small ridge; row i counts ``counts[i]`` times."""
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (counts * p * (1 - p))[:, None]).T @ x + 0.5 * np.eye(x.shape[1])
        step = np.linalg.solve(hessian, x.T @ (counts * (p - y)) + 0.5 * w)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _excused(sample: DataFrame, lexicon: dict[str, float]) -> set[str]:
    """Two-word phrases around lexicon words that occur in at least ``EXCEPTION_TEXTS`` harmless texts and no toxic one."""
    matcher = automaton(lexicon, set())

    def phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = set()
            for n, (label, text) in enumerate(zip(batch.column(0), batch.column(1), strict=True)):
                text = folded(text.as_py())
                for end, (length, _) in matcher.iter(text) if len(matcher) else ():
                    start = end - length + 1
                    stop = text.index(" ", start + 1)
                    left, right = text.rfind(" ", 0, start), text.find(" ", stop + 1)
                    if left >= 0:
                        out.add((label.as_py(), text[left : stop + 1], n))
                    if right > 0:
                        out.add((label.as_py(), text[start : right + 1], n))
            labels, found, _ = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(labels, pa.int32()), pa.array(found, pa.string())], names=["label", "phrase"]
            )

    rows = (
        sample.mapInArrow(phrases, "label int, phrase string")
        .groupBy("phrase")
        .agg(F.sum("label").alias("t"), F.sum(1 - F.col("label")).alias("n"))
        .filter((F.col("t") == 0) & (F.col("n") >= EXCEPTION_TEXTS))
        .collect()
    )
    return {row["phrase"] for row in rows}


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, learn: Column, column: str = "toxic", sample_rows: int = SAMPLE_ROWS
) -> dict:
    """Lexicon, exceptions and scale from at most about ``sample_rows`` labelled rows of each kind, all where ``learn``.

    ``learn`` is a condition on doc_id; texts are whole. Each kind is sampled on its own; precision and scale count a
    row as often as rows of its kind it stands for, so they are those of all labelled rows. Without rows of both
    kinds the lexicon is empty and every score is 0.
    """
    known = labels_of(labels, column).filter(learn)
    drawn = [at_most(known.filter(F.col("label") == k), "doc_id", sample_rows, 71 + k) for k in (0, 1)]
    chosen = drawn[0].unionByName(drawn[1]).select(F.col("doc_id").alias("_tq_id"), "label")
    taken, of = ({r["label"]: r["count"] for r in rows.groupBy("label").count().collect()} for rows in (chosen, known))
    stands_for = {k: of[k] / n for k, n in taken.items()}
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    # Twice sample_rows ids at most, so the hint holds at every size.
    sample = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("_tq_id")).select("label", "text")
    have = {row["label"]: row["count"] for row in sample.groupBy("label").count().collect()}
    if not (have.get(0) and have.get(1)):
        return {"lexicon": {}, "exceptions": set(), "scale": None}
    lexicon = _lexicon(sample, have[1], have[0], stands_for)
    exceptions = _excused(sample, lexicon)
    matcher = automaton(lexicon, exceptions)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_inputs(*hits(matcher, folded(t.as_py()))) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.float64()))], names=["label", "x"])

    got = sample.mapInArrow(measure, "label int, x array<double>").toPandas()
    counts = got["label"].map(stands_for).to_numpy(dtype=float)
    scale = _fit_scale(np.array(got["x"].tolist()), got["label"].to_numpy(dtype=float), counts)
    return {"lexicon": lexicon, "exceptions": exceptions, "scale": scale}


def toxicity_scores(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, score (0 to 1), weight (sum of hits) and n_words of every document, from its whole text.

    Null and empty texts have no words and no hits. Rows are independent of one another; an empty table
    gives an empty result; other columns are not read.
    """
    lexicon, exceptions, scale = model["lexicon"], model["exceptions"], model["scale"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = automaton(lexicon, exceptions)
        for batch in batches:
            found = [hits(matcher, folded(t.as_py())) for t in batch.column(1)]
            if scale is None:
                scores = np.zeros(len(found))
            else:
                x = np.array([_inputs(*f) for f in found]).reshape(-1, 3)
                scores = 1 / (1 + np.exp(-np.clip(x @ scale[:-1] + scale[-1], -40, 40)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(scores),
                    pa.array([f[0] for f in found], pa.float64()),
                    pa.array([f[1] for f in found], pa.int64()),
                ],
                names=["doc_id", "score", "weight", "n_words"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(score, "doc_id long, score double, weight double, n_words long")
