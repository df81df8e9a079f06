from __future__ import annotations

import itertools
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from torqline.llm import language, quality, queries, toxicity
from torqline.llm.samples import fold


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    base = sf_dir.replace("sf0.001", "sf0.01")
    return base, spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")


def accuracy(found, truth, column):
    joined = found.join(truth, "doc_id").filter("held_out")
    return joined.agg(F.avg((F.col("predicted") == F.col(column)).cast("double"))).first()[0]


def test_quality_on_held_out_rows(spark, tables):
    base, _, labels = tables
    found = queries.op6_pu_quality(spark, base)
    assert accuracy(found, labels, "quality") >= 0.97
    assert found.filter("score < 0 OR score > 1 OR score IS NULL").count() == 0


def test_toxicity_on_held_out_rows(spark, tables):
    base, _, labels = tables
    found = queries.op7_lexicon_toxicity(spark, base)
    assert accuracy(found, labels, "toxic") >= 0.95
    assert found.filter("score < 0 OR score > 1 OR score IS NULL").count() == 0


def test_language_on_held_out_rows(spark, tables):
    base, documents, _ = tables
    found = queries.op2_crf_language(spark, base)
    joined = found.join(documents.select("doc_id", "lang"), "doc_id").filter("held_out")
    assert joined.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] >= 0.98


def test_held_out_labels_and_other_columns_teach_nothing(spark, tables):
    _, documents, labels = tables
    learn = fold(F.col("doc_id"), 4) != 2
    turned = labels.withColumn("quality", F.when(learn, F.col("quality")).otherwise(1 - F.col("quality")))
    moved = documents.withColumn("lang", F.lit("zz")).withColumn("source", F.lit("other"))
    one, two = quality.fit_quality(documents, labels, learn), quality.fit_quality(moved, turned, learn)
    assert np.allclose(one["weights"], two["weights"]) and one["prior"] == two["prior"]


def test_awkward_rows_and_empty_tables(docs, rows, nothing, tables):
    _, documents, labels = tables
    learn = fold(F.col("doc_id"), 4) != 2
    q = quality.fit_quality(documents, labels, learn)
    t = toxicity.fit_toxicity(documents, labels, learn)
    lang = language.fit_languages(documents, learn, 40)
    scored = quality.quality_scores(docs, q)
    assert [c.lower() for c in scored.columns].count("score") == 1
    assert scored.count() == len(rows) and scored.filter("score IS NULL OR isnan(score)").count() == 0
    assert toxicity.toxicity_scores(docs, t).filter("score BETWEEN 0 AND 1").count() == len(rows)
    found = language.languages(docs, lang)
    assert found.filter("score BETWEEN 0 AND 1").count() == len(rows)
    unknown = {r["doc_id"] for r in found.filter("lang_pred = 'und'").collect()}
    assert unknown == {400, 401, 402, 410, None}
    for table in (nothing,):
        assert quality.quality_scores(table, q).count() == 0
        assert toxicity.toxicity_scores(table, t).count() == 0
        assert language.languages(table, lang).count() == 0
    none = labels.limit(0)
    assert quality.fit_quality(documents, none, learn) is None
    assert quality.quality_scores(docs, None).filter("score = 0.5").count() == len(rows)
    no_lexicon = toxicity.fit_toxicity(documents, none, learn)
    assert toxicity.toxicity_scores(docs, no_lexicon).filter("score = 0").count() == len(rows)
    assert language.languages(docs, language.fit_languages(nothing, learn)).filter("lang_pred = 'und'").count() == len(rows)


def test_non_negative_risk_separates_without_negatives():
    rng = np.random.default_rng(2)
    positive = rng.normal(2, 1, (3000, 4))
    mixed = np.concatenate([rng.normal(2, 1, (2100, 4)), rng.normal(-2, 1, (900, 4))])
    model = quality.nn_pu_fit(positive, mixed, prior=0.7)
    z = (mixed - model["mean"]) / model["scale"] @ model["weights"][:-1] + model["weights"][-1]
    assert (z[:2100] > 0).mean() > 0.97 and (z[2100:] < 0).mean() > 0.97


def test_folding():
    assert toxicity.folded("An ІDІОТ, 1d10t & sTuP1d ｌｏｓｅｒ!") == " an idiot idiot stupid loser "
    assert toxicity.folded("call 555 0199 now") == " call 555 0199 now "
    assert toxicity.folded(None) == toxicity.folded("") == toxicity.folded(" \n") == " "


def test_lexicon_hits_and_exceptions():
    matcher = toxicity.automaton({" trash ": 2.0, " scum": 3.0, " scumbag ": 4.0}, {" trash can "})
    assert toxicity.hits(matcher, toxicity.folded("Trash, trash can and scumbags")) == (5.0, 5)
    assert toxicity.hits(matcher, toxicity.folded("scumbag")) == (4.0, 1)
    assert toxicity.hits(matcher, " ") == (0.0, 0)
    assert toxicity.hits(toxicity.automaton({}, set()), " a b ") == (0.0, 2)


def test_many_hits_and_exceptions_in_one_text_take_time_in_proportion():
    matcher = toxicity.automaton({" trash ": 2.0}, {" trash can ", " can trash ", " trash bin "})
    text = " " + "trash can trash now trash bin trash too " * 20_000
    start = time.process_time()
    assert toxicity.hits(matcher, text) == (40_000.0, 160_000)
    assert time.process_time() - start < 10


def test_exceptions_are_learnt_from_harmless_contexts(spark):
    rng = random.Random(6)
    fill = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(300):
        words = [rng.choice(fill) for _ in range(20)]
        bad = i % 2
        if bad:
            words[rng.randrange(2, 18)] = "nasty"
        elif i % 20 == 0:
            words[5:7] = ["nasty", "weather"]
        rows.append((i, " ".join(words), bad))
    both = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit_toxicity(both.drop("toxic"), both.select("doc_id", "toxic"), F.lit(True))
    assert " nasty " in model["lexicon"] and " nasty weather " in model["exceptions"]
    found = {r["doc_id"]: r["score"] for r in toxicity.toxicity_scores(both, model).collect()}
    assert all((found[i] >= 0.5) == bool(bad) for i, _, bad in rows)


def test_a_sample_of_each_kind_gives_the_scores_of_all_rows(spark):
    """A tenth of the rows is toxic; a sample with as many of each kind must neither lower the bar nor raise scores."""
    rng = random.Random(9)
    rows = []
    for i in range(3000):
        words, bad = [f"w{rng.randrange(400)}" for _ in range(20)], int(i % 10 == 0)
        for word, rates, at in (("vile", (0.003, 0.6), 5), ("edgy", (0.055, 0.6), 12)):
            if rng.random() < rates[bad]:
                words[at] = word
        rows.append((i, " ".join(words), bad))
    both = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    docs, labels = both.drop("toxic"), both.select("doc_id", "toxic")
    full, sampled = (toxicity.fit_toxicity(docs, labels, F.lit(True), sample_rows=n) for n in (3000, 300))
    assert " vile " in full["lexicon"] and " edgy " not in full["lexicon"]
    assert " vile " in sampled["lexicon"] and " edgy " not in sampled["lexicon"]
    one, two = (
        np.array([r["score"] for r in toxicity.toxicity_scores(docs, m).orderBy("doc_id").collect()]) for m in (full, sampled)
    )
    assert np.abs(one - two).mean() < 0.02
    assert abs(two.mean() - 0.1) < 0.03


def test_forward_backward_matches_enumeration():
    rng = np.random.default_rng(8)
    scores, moves, lengths = rng.normal(size=(3, 5, 3)), rng.normal(size=(3, 3)), np.array([5, 2, 1])
    got = language.forward_backward(scores, lengths, moves)
    for s, n in enumerate(lengths):
        weight = np.zeros((n, 3))
        for path in itertools.product(range(3), repeat=int(n)):
            total = sum(scores[s, t, k] for t, k in enumerate(path)) + sum(moves[a, b] for a, b in zip(path, path[1:]))
            for t, k in enumerate(path):
                weight[t, k] += np.exp(total)
        assert np.allclose(got[s, :n], weight / weight.sum(axis=1, keepdims=True))


def test_code_switched_text_is_labelled_word_by_word(spark, tables):
    _, documents, _ = tables
    sample = documents.filter("lang IN ('en', 'fr')").select("text", "lang").limit(400).collect()
    train, test = sample[:300], sample[300:]
    model = language.train_crf([r["text"] for r in train], [r["lang"] for r in train])
    import pyarrow as pa

    one = {k: " ".join(next(r["text"] for r in test if r["lang"] == k and len(r["text"]) > 300).split()[:25]) for k in ("en", "fr")}
    (_, _, marginals), = language.word_marginals(model, pa.array([f"{one['en']} {one['fr']}"]))
    likeliest, half = marginals.argmax(axis=1), len(marginals) // 2
    assert (likeliest[: half - 4] == model["langs"].index("en")).mean() > 0.9
    assert (likeliest[half + 4 :] == model["langs"].index("fr")).mean() > 0.9
