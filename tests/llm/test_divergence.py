from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from llm.conftest import SCHEMA, row
from torqline.llm import divergence
from torqline.llm.divergence import source_divergence
from torqline.llm.transducer import Transducer


def brute(rows, min_docs=3, top=200):
    """(lang, source, part, item, value, rank) from (lang, source, text), in whole numbers."""
    seen, counts = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        terms = [t.decode() for t in re.findall(rb"[A-Za-z\x80-\xff]+", (text or "").encode().lower())]
        counts[lang, source].update(terms)
        seen[lang].update(set(terms))
    kept = {lang: sorted(t for t, n in c.items() if n >= min_docs) for lang, c in seen.items()}
    out = []

    def shares(lang, own):
        mass = sum(own[t] for t in kept[lang]) + len(kept[lang])
        return {t: 1 + 10**9 * (own[t] + 1) // mass for t in kept[lang]}

    for (lang, source), own in counts.items():
        p = shares(lang, own)
        whole = Counter()
        for (other, _), c in counts.items():
            if other == lang:
                whole.update(c)
        pairs = []
        for (other, item), c in counts.items():
            if other == lang and item != source:
                q = shares(lang, c)
                pairs.append((-sum((p[t] - q[t]) ** 2 // q[t] for t in kept[lang]), item))
        q = shares(lang, whole)
        ahead = [(-((p[t] - q[t]) ** 2 // q[t]), t) for t in kept[lang] if own[t] > 0 and p[t] > q[t]]
        for part, found in (("pair", sorted(pairs)), ("term", sorted(ahead, key=lambda x: (x[0], x[1].encode()))[:top])):
            out += [(lang, source, part, item, -value, rank) for rank, (value, item) in enumerate(found, 1)]
    return sorted(out)


def corpus():
    rng = random.Random(12)
    rows = []
    for lang in ("en", "fr", None):
        words = ["".join(rng.choice("abcdeé日") for _ in range(rng.randint(1, 4))) for _ in range(60)] + ["Tie", "tieé"]
        for k in range(50):
            own = rng.sample(words, 20)
            rows.append((lang, rng.choice(["s1", "S2", "", "é", None]), " ".join(rng.choices(own, k=rng.randint(0, 60))) + " 12,x_y"))
    rows += [("de", "one", "a b c"), ("de", "two", "d"), ("xx", "only", None), ("en", "silent", ""), ("en", None, "Ends\x00Here")]
    rows += [rows[0]] * 3 + [("en", "s1", "same same " * 4000)] * 3
    return rows


@pytest.mark.parametrize(("block_terms", "source_block", "held"), [(1 << 16, 256, 1 << 18), (7, 2, 5)])
def test_audit_matches_brute_force(spark, monkeypatch, block_terms, source_block, held):
    monkeypatch.setattr(divergence, "BROADCAST_BYTES", 1 << 20 if block_terms > 100 else 400)
    rows = corpus()
    docs = spark.createDataFrame([(i, t, lang, s, 1, "x", 0.5, "r", "k", "n", 3) for i, (lang, s, t) in enumerate(rows)], SCHEMA)
    options = divergence.Sizes(block_terms=block_terms, source_block=source_block, held=held)
    got = source_divergence(docs.repartition(5), top=15, sizes=options).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, top=15)
    assert [f for f in got[0].asDict()] == ["lang", "source", "part", "item", "value", "rank"]


def test_empty_table_and_no_kept_terms(spark, nothing):
    assert source_divergence(nothing).count() == 0
    docs = spark.createDataFrame([row(1, "one"), row(2, None)], SCHEMA)
    assert source_divergence(docs).count() == 0  # one source, no other
    three = spark.createDataFrame([("en", s, "word") for s in "cab"][:2] + [("en", "a", "")], "lang string, source string, text string")
    got = [tuple(r) for r in source_divergence(three).collect()]
    assert sorted(got) == brute([("en", "c", "word"), ("en", "a", "word"), ("en", "a", "")])
    assert {r[4] for r in got} == {0}


def test_transducer_is_minimal_and_keeps_order():
    rng = random.Random(2)
    for _ in range(200):
        draw = lambda n: bytes(rng.choice(b"abc\xc3") for _ in range(rng.randint(1, n)))
        terms = sorted({draw(6) for _ in range(rng.randint(0, 60))})
        made = Transducer.build(terms)
        asked = terms + [draw(8) for _ in range(40)] + [b""]
        assert made.ordinals(asked).tolist() == [terms.index(t) if t in terms else -1 for t in asked]
        assert [made.term(i) for i in range(len(terms))] == terms
        prefixes = {t[:i] for t in terms for i in range(len(t) + 1)} | {b""}
        assert len(made.final) == len({frozenset(t[len(p) :] for t in terms if t.startswith(p)) for p in prefixes})
