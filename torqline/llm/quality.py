"""Quality classifier by positive-unlabelled learning.

Trusted positives and unlabelled web text are all the model sees. It minimises the non-negative unbiased risk

    prior * risk(positives as 1) + max(0, risk(unlabelled as 0) - prior * risk(positives as 0))

with logistic loss, so its sigmoid estimates the probability that a text is of quality. The class prior is
estimated from how often the trusted label occurs among the labelled rows that may be learnt from.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from torqline.llm import words
from torqline.llm.samples import at_most, labels_of

SAMPLE_ROWS = 20_000  # trusted positives, and as many unlabelled texts
SLICE_BYTES = 1 << 20  # documents scored and handed on together; a longer document goes alone
_STEPS, _RATE, _DECAY = 600, 0.05, 1e-4

_WORD = ~words.byte_class(0x20, range(0x09, 0x0E))
_CLASSES = [
    words.byte_class(range(ord("a"), ord("z") + 1)),
    words.byte_class(range(ord("A"), ord("Z") + 1)),
    words.byte_class(range(ord("0"), ord("9") + 1)),
    words.byte_class(0x20, 0x09, 0x0D),
    words.byte_class(0x0A),
    words.byte_class(ord("."), ord(","), ord(";"), ord(":"), ord("'"), ord("?")),
    words.byte_class(*[b for b in range(0x21, 0x7F) if not chr(b).isalnum() and chr(b) not in ".,;:'?"]),
    words.byte_class(range(0x80, 0x100)),
]
FEATURES = 2 * len(_CLASSES) + 16


def _shares(sorted_keys: np.ndarray, n: int) -> tuple[float, float]:
    """Share of distinct keys, and of the most frequent one."""
    edges = np.flatnonzero(np.diff(sorted_keys)) + 1
    counts = np.diff(np.concatenate([[0], edges, [len(sorted_keys)]]))
    return len(counts) / n, float(counts.max()) / n


def text_features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of ``FEATURES`` numbers per document: character classes, word shapes and repetition."""
    out = np.zeros((len(offsets) - 1, FEATURES))
    starts, ends, first = words.word_spans(data, offsets, _WORD)
    hashes = words.span_hashes(data, starts, ends)
    marks = _CLASSES[6][data]
    tail = marks[ends - 1] if len(ends) else np.zeros(0, bool)
    for i in range(len(out)):
        text = data[offsets[i] : offsets[i + 1]]
        w = hashes[first[i] : first[i + 1]]
        size, n = max(1, len(text)), max(1, len(w))
        counts = np.bincount(text, minlength=256)
        shares = [counts[c].sum() / size for c in _CLASSES]
        row = shares + [s**0.5 for s in shares]
        lengths = (ends - starts)[first[i] : first[i + 1]]
        distinct, top = _shares(np.sort(w), n) if len(w) else (0.0, 0.0)
        again = float((w[1:] == w[:-1]).mean()) if len(w) > 1 else 0.0
        pairs = words.mixed(w[:-1]) + w[1:]
        pair_distinct, pair_top = _shares(np.sort(pairs), max(1, len(pairs))) if len(pairs) else (1.0, 0.0)
        row += [
            distinct,
            top,
            again,
            again**0.5,
            pair_distinct,
            pair_top,
            float(lengths.mean()) if len(w) else 0.0,
            float(lengths.std()) if len(w) else 0.0,
            float(tail[first[i] : first[i + 1]].mean()) if len(w) else 0.0,
            float((lengths == 1).mean()) if len(w) else 0.0,
            np.log1p(len(w)),
            1.0 / n,
            distinct * np.log1p(len(w)),
            pair_distinct * np.log1p(len(w)),
            float(len(text) == 0),
            min(1.0, 20.0 / n),
        ]
        out[i] = row
    return out


def nn_pu_fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> dict:
    """Weights of a linear model on standardised features under the non-negative risk; Adam on the whole sample."""
    both = np.concatenate([positive, unlabelled])
    mean, scale = both.mean(axis=0), both.std(axis=0) + 1e-9
    p, u = (np.clip((x - mean) / scale, -8, 8) for x in (positive, unlabelled))
    p, u = (np.concatenate([x, np.ones((len(x), 1))], axis=1) for x in (p, u))
    w = np.zeros(p.shape[1])
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, _STEPS + 1):
        at_p, at_u = (1 / (1 + np.exp(-np.clip(x @ w, -40, 40))) for x in (p, u))
        grad_p1, grad_p0, grad_u0 = p.T @ (at_p - 1) / len(p), p.T @ at_p / len(p), u.T @ at_u / len(u)
        negative = np.mean(-np.log1p(-at_u + 1e-12)) - prior * np.mean(-np.log1p(-at_p + 1e-12))
        # Where the estimated risk of the negatives falls below zero it is driven back up.
        grad = prior * grad_p1 + grad_u0 - prior * grad_p0 if negative >= 0 else prior * grad_p0 - grad_u0
        grad = grad + _DECAY * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w = w - _RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return {"mean": mean, "scale": scale, "weights": w, "prior": prior}


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = words.text_bytes(batch.column(1))
        for i, j in words.slices(offsets, SLICE_BYTES):
            rows = text_features(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, j - i), pa.array(list(rows), pa.list_(pa.float64()))], names=["kind", "x"]
            )


def fit_quality(
    docs: DataFrame, labels: DataFrame, learn: Column, column: str = "quality", sample_rows: int = SAMPLE_ROWS
) -> dict | None:
    """A model from at most about ``sample_rows`` trusted positives and as many unlabelled texts, all where ``learn``.

    ``learn`` is a condition on doc_id. Texts are whole. None if there is no trusted positive.
    """
    known = labels_of(labels, column).filter(learn)
    counts = {row["label"]: row["count"] for row in known.groupBy("label").count().collect()}
    if not counts.get(1):
        return None
    prior = min(0.98, counts[1] / sum(counts.values()))
    trusted = at_most(known.filter("label = 1").select("doc_id"), "doc_id", sample_rows, 61)
    trusted = trusted.select(F.col("doc_id").alias("_tq_id"))
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).filter(learn)
    drawn = at_most(rows, "doc_id", sample_rows, 62).select(F.lit(0).alias("kind"), "text")
    # At most sample_rows ids, so the hint holds at every size.
    chosen = rows.join(F.broadcast(trusted), F.col("doc_id") == F.col("_tq_id"), "left_semi")
    sample = chosen.select(F.lit(1).alias("kind"), "text").unionByName(drawn)
    got = sample.mapInArrow(_featurise, "kind int, x array<double>").toPandas()
    x = np.array(got["x"].tolist()).reshape(-1, FEATURES)
    kind = got["kind"].to_numpy()
    if not (kind == 1).any() or not (kind == 0).any():
        return None
    return nn_pu_fit(x[kind == 1], x[kind == 0], prior)


def score_features(model: dict | None, x: np.ndarray) -> np.ndarray:
    if model is None:
        return np.full(len(x), 0.5)
    z = np.clip((x - model["mean"]) / model["scale"], -8, 8)
    return 1 / (1 + np.exp(-np.clip(z @ model["weights"][:-1] + model["weights"][-1], -40, 40)))


def quality_scores(docs: DataFrame, model: dict | None, *keep: str) -> DataFrame:
    """The columns ``keep`` of every document and its ``score`` (0 to 1) from its whole text.

    Null texts are scored like empty ones; without a model every score is 0.5. Rows are independent of one
    another, so repeated rows and ids get equal scores; an empty table gives an empty result. A column of ``docs``
    called score is replaced.
    """
    keep = [c for c in (keep or docs.columns) if c.lower() != "score"]
    given = "text" in keep and dict(docs.dtypes)["text"] == "string"
    text_at = keep.index("text") if given else len(keep)
    width = len(keep)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = words.text_bytes(batch.column(text_at))
            for i, j in words.slices(offsets, SLICE_BYTES):
                x = text_features(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                kept = [column.slice(i, j - i) for column in batch.columns[:width]]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(score_features(model, x))], names=[*keep, "score"])

    rows = docs.select(*[F.col(f"`{c}`") for c in keep])
    fields = StructType([*rows.schema.fields, StructField("score", DoubleType())])
    if not given:
        rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").cast("string").alias("_tq_text"))
    return rows.mapInArrow(score, fields)
