"""Language of documents by a linear-chain conditional random field over their words.

Words are maximal runs of letters. Each gets emission scores per language from hashed features: its first and last
one to three bytes, all two- and three-byte n-grams with the word's borders, and the word itself (a lexicon). Learned
transition weights tie neighbours together, so code-switched text is labelled word by word by forward-backward.
Training sequences are spliced from stretches of documents in different languages, so that switches occur in them.
The language of a document is the one with the largest sum of word marginals, and its score their mean.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from torqline.llm import words
from torqline.llm.samples import at_most

ROWS_PER_LANGUAGE = 300  # training documents of each language, drawn by a hash of their id
UNKNOWN = "und"
_TABLE = 1 << 16
_STRETCH, _STRETCHES = 16, 4  # words per stretch of one language, stretches per training sequence
_STAY = 0.6  # chance that the next stretch keeps the language
_EPOCHS, _BATCH, _RATE = 3, 256, 0.25
_GROUP = 256
_SLICE = 2 << 20  # bytes of text whose features are held together

_LETTER = words.byte_class(range(ord("a"), ord("z") + 1), range(ord("A"), ord("Z") + 1), range(0x80, 0x100))
_LOWER = np.arange(256, dtype=np.uint32)
_LOWER[ord("A") : ord("Z") + 1] += 32
_ANY_LETTER = re.compile(r"[^\W\d_]")
# Families of features, each with a table of its own: bigrams, trigrams, beginnings, endings, words.
_FAMILIES = 5


def _slot(key: np.ndarray) -> np.ndarray:
    return (words.mixed(key.astype(np.uint64)) >> np.uint64(48)).astype(np.int64)


def _features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word of each feature, its row in the tables laid end to end)."""
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    low = _LOWER[data]
    n = ends - starts
    owner = np.repeat(np.arange(len(starts)), n)
    at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts, n)
    here = low[at]
    last = at == ends[owner] - 1
    first = at == starts[owner]
    after = np.where(last, 1, low[np.minimum(at + 1, len(low) - 1)])
    before = np.where(first, 1, low[np.maximum(at - 1, 0)])
    out_owner = [owner, owner, owner[first]]
    rows = [
        here * 256 + after,
        _TABLE + _slot((before.astype(np.uint64) << np.uint64(16)) + (here << 8) + after),
        (ord(" ") << 8) + here[first],
    ]
    head, tail = np.zeros(len(starts), np.uint64), np.zeros(len(starts), np.uint64)
    for k in range(3):
        long = n > k
        index = np.flatnonzero(long)
        head[index] = (head[index] << np.uint64(8)) + low[starts[index] + k].astype(np.uint64)
        tail[index] = (tail[index] << np.uint64(8)) + low[ends[index] - 1 - k].astype(np.uint64)
        mark = np.uint64((k + 1) << 32)
        out_owner += [index, index]
        rows += [2 * _TABLE + _slot(head[index] + mark), 3 * _TABLE + _slot(tail[index] + mark)]
    out_owner.append(np.arange(len(starts)))
    rows.append(4 * _TABLE + _slot(words.span_hashes(data, starts, ends)))
    return np.concatenate(out_owner), np.concatenate([r.astype(np.int64) for r in rows])


def emissions(table: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    owner, rows = _features(data, starts, ends)
    out = np.empty((len(starts), table.shape[1]))
    for k in range(table.shape[1]):
        out[:, k] = np.bincount(owner, weights=table[rows, k], minlength=len(starts))
    return out


def forward_backward(scores: np.ndarray, lengths: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Marginals of a padded block: ``scores`` (sequences, steps, labels); steps beyond a length are of no effect."""
    n, steps, labels = scores.shape
    emit = np.exp(scores - scores.max(axis=2, keepdims=True))
    move = np.exp(transitions - transitions.max())
    live = np.arange(steps)[None, :] < lengths[:, None]
    emit[~live] = 1.0
    ahead = np.empty((steps, n, labels))
    state = np.full((n, labels), 1.0 / labels)
    for t in range(steps):
        state = (state @ move if t else state) * emit[:, t]
        state /= state.sum(axis=1, keepdims=True)
        ahead[t] = state
    back = np.ones((n, labels))
    for t in range(steps - 1, -1, -1):
        if t < steps - 1:
            later = (back * emit[:, t + 1]) @ move.T
            later /= later.sum(axis=1, keepdims=True)
            back = np.where(live[:, t + 1][:, None], later, 1.0)
        ahead[t] *= back
    ahead /= ahead.sum(axis=2, keepdims=True)
    return ahead.transpose(1, 0, 2)


def _pair_counts(scores: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals and the summed marginals of neighbouring pairs, for sequences of one length."""
    n, steps, labels = scores.shape
    emit = np.exp(scores - scores.max(axis=2, keepdims=True))
    move = np.exp(transitions - transitions.max())
    ahead, back = np.empty((steps, n, labels)), np.ones((steps, n, labels))
    for t in range(steps):
        state = (ahead[t - 1] @ move if t else 1.0) * emit[:, t]
        ahead[t] = state / state.sum(axis=1, keepdims=True)
    for t in range(steps - 2, -1, -1):
        state = (back[t + 1] * emit[:, t + 1]) @ move.T
        back[t] = state / state.sum(axis=1, keepdims=True)
    single = ahead * back
    single /= single.sum(axis=2, keepdims=True)
    pair = ahead[:-1, :, :, None] * move * (back[1:] * emit.transpose(1, 0, 2)[1:])[:, :, None, :]
    pair /= pair.sum(axis=(2, 3), keepdims=True)
    return single.transpose(1, 0, 2), pair.sum(axis=(0, 1))


def train_crf(texts: list[str], langs: list[str], seed: int = 5) -> dict:
    """Tables and transitions by adaptive gradient steps on the conditional likelihood of spliced sequences."""
    names = sorted(set(langs))
    label = np.array([names.index(x) for x in langs])
    data, offsets = words.text_bytes(pa.array(texts, pa.string()))
    starts, ends, first = words.word_spans(data, offsets, _LETTER)
    owner, rows = _features(data, starts, ends)
    order = np.argsort(owner, kind="stable")
    owner, rows = owner[order], rows[order]
    at = np.searchsorted(owner, np.arange(len(starts) + 1))
    rng = np.random.default_rng(seed)
    stretches: list[list[np.ndarray]] = [[] for _ in names]
    for i in range(len(texts)):
        for s in range(first[i], first[i + 1] - _STRETCH + 1, _STRETCH):
            stretches[label[i]].append(np.arange(s, s + _STRETCH))
    labels = len(names)
    table = np.zeros((_FAMILIES * _TABLE, labels))
    seen = np.full_like(table, 1e-3)
    moves, moves_seen = np.zeros((labels, labels)), np.full((labels, labels), 1e-3)
    usable = [k for k in range(labels) if stretches[k]]
    total = sum(map(len, stretches)) // _STRETCHES
    for _ in range(_EPOCHS if usable else 0):
        for _ in range(max(1, total // _BATCH)):
            gold = np.empty((_BATCH, _STRETCHES), np.int64)
            gold[:, 0] = rng.choice(usable, _BATCH)
            for s in range(1, _STRETCHES):
                gold[:, s] = np.where(rng.random(_BATCH) < _STAY, gold[:, s - 1], rng.choice(usable, _BATCH))
            word = np.concatenate([stretches[k][rng.integers(len(stretches[k]))] for k in gold.ravel()])
            gold = np.repeat(gold, _STRETCH, axis=1)
            count = at[word + 1] - at[word]
            own = np.repeat(np.arange(len(word)), count)
            use = rows[np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + np.repeat(at[word], count)]
            scores = np.stack([np.bincount(own, weights=table[use, k], minlength=len(word)) for k in range(labels)], axis=1)
            single, pairs = _pair_counts(scores.reshape(_BATCH, -1, labels), moves)
            error = single.reshape(-1, labels)
            error[np.arange(len(word)), gold.ravel()] -= 1.0
            error /= _BATCH
            touched, place = np.unique(use, return_inverse=True)
            for k in range(labels):
                grad = np.bincount(place, weights=error[own, k], minlength=len(touched)) + 1e-6 * table[touched, k]
                seen[touched, k] += grad**2
                table[touched, k] -= _RATE * 0.2 * grad / np.sqrt(seen[touched, k])
            real = np.zeros_like(moves)
            np.add.at(real, (gold[:, :-1], gold[:, 1:]), 1.0)
            grad = (pairs - real) / _BATCH
            moves_seen += grad**2
            moves -= _RATE * grad / np.sqrt(moves_seen)
    return {"langs": names, "table": table.astype(np.float32), "transitions": moves}


def fit_languages(docs: DataFrame, learn: Column, rows_per_language: int = ROWS_PER_LANGUAGE) -> dict:
    """A model from whole texts of at most about ``rows_per_language`` documents of each non-null lang where ``learn``."""
    known = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    known = known.filter(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    texts, langs = [], []
    for row in known.groupBy("lang").count().orderBy("lang").collect():
        drawn = at_most(known.filter(F.col("lang") == row["lang"]), "doc_id", rows_per_language, 83)
        for got in drawn.select("text").collect():
            texts.append(got["text"])
            langs.append(row["lang"])
    return train_crf(texts, langs) if texts else {"langs": [], "table": None, "transitions": None}


def word_marginals(model: dict, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    """(document, number of its first word in the slice, marginals of its words) of every document with words."""
    data, offsets = words.text_bytes(column)
    for i, j in words.slices(offsets, _SLICE):
        own, cut = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        starts, ends, first = words.word_spans(own, cut, _LETTER)
        scores = emissions(model["table"], own, starts, ends)
        length = np.diff(first)
        order = np.argsort(length, kind="stable")
        order = order[length[order] > 0]
        for g in range(0, len(order), _GROUP):
            group = order[g : g + _GROUP]
            steps = length[group]
            place = np.minimum(np.arange(steps.max())[None, :], steps[:, None] - 1) + first[group][:, None]
            found = forward_backward(scores[place], steps, model["transitions"])
            for d, doc in enumerate(group.tolist()):
                yield i + doc, int(first[doc]), found[d, : steps[d]]


def languages(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, lang_pred, score and switches (word pairs whose likeliest languages differ) of every document.

    A null text, or one without a letter, is ``und`` with score 0; so is every text under a model without
    languages. Repeated rows get equal results; an empty table gives an empty result; other columns are not read.
    """

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            best, score, switches = [UNKNOWN] * n, np.zeros(n), np.zeros(n, np.int64)
            if model["langs"]:
                for doc, _, marginals in word_marginals(model, batch.column(1)):
                    mean = marginals.mean(axis=0)
                    k = int(mean.argmax())
                    likeliest = marginals.argmax(axis=1)
                    best[doc], score[doc] = model["langs"][k], min(1.0, float(mean[k]))
                    switches[doc] = int((likeliest[1:] != likeliest[:-1]).sum())
                for i, text in enumerate(batch.column(1)):
                    if best[i] != UNKNOWN and not _ANY_LETTER.search(text.as_py()):
                        best[i], score[i], switches[i] = UNKNOWN, 0.0, 0
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(best, pa.string()), pa.array(score), pa.array(switches)],
                names=["doc_id", "lang_pred", "score", "switches"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(label, "doc_id long, lang_pred string, score double, switches long")
