"""The registered queries of the operators, one each, over their whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from torqline.llm import (
    decontamination,
    divergence,
    exact,
    jaccard,
    language,
    lines,
    packing,
    quality,
    records,
    repeats,
    runs,
    sharding,
    toxicity,
)
from torqline.llm.common import table
from torqline.llm.samples import fold


def op1_hypergeometric_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.hypergeometric_shards(table(spark, sf_dir, "documents"))
    text = F.coalesce("text", F.lit(""))
    return rows.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _held_out(parts: int, rest: int) -> Column:
    return F.coalesce(fold(F.col("doc_id"), parts) == rest, F.lit(False)).alias("held_out")


def op2_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit_languages(docs, learn=fold(F.col("doc_id"), 3) != 1)
    return language.languages(docs, model).select("doc_id", _held_out(3, 1), "lang_pred", "score")


def op3_prefix_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicate_groups(table(spark, sf_dir, "documents"))


def op4_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return records.record_digests(spark, docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


def op5_certified_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)


def op6_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit_quality(docs, labels, learn=fold(F.col("doc_id"), 4) != 2)
    return quality.quality_scores(docs, model, "doc_id").select(
        "doc_id", _held_out(4, 2), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def op7_lexicon_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit_toxicity(docs, labels, learn=fold(F.col("doc_id"), 5) != 0)
    return toxicity.toxicity_scores(docs, model).select(
        "doc_id", _held_out(5, 0), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op8_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_digest_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact.digest_groups(table(spark, sf_dir, "documents"))
    return groups.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256")
    )


def op10_run_length_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.repeated_passages(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256"
    )


def op11_transducer_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(table(spark, sf_dir, "documents"))


_SPACES = r"[\x20\x09-\x0D]+"


def _looped(doc_id: Column, text: Column) -> Column:
    """The text of a tenth of the documents with a loop in it, as the contract of op12 asks for; the others' as it is."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)
    words = F.filter(F.split(text, _SPACES), lambda w: w != "")
    n = F.size(words)
    a = F.pmod(g, n).cast("int")
    p = (F.floor((n - a) / (3 + F.pmod(g, F.lit(8)))) + 1).cast("int")
    loop = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    looped = F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(loop, F.lit(1), n - a)), " ")
    return F.when((F.pmod(h, F.lit(10)) == 0) & text.rlike(r"[^\x20\x09-\x0D]"), looped).otherwise(text)


def op12_frequency_split_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", _looped(F.col("doc_id"), F.col("text")).alias("text"))
    found = runs.collapsed_runs(docs)
    lines_of = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    keys = F.transform("runs", lambda r: F.struct(r["length"].alias("l"), (-r["start"]).alias("s"), (-r["period"]).alias("p")))
    found = found.withColumn("longest", F.array_max(keys))
    length, period = F.col("longest.l"), -F.col("longest.p")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.s")).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.call_function("div", 1000 * length, period).alias("exponent_milli"),
        F.sha2(F.array_join(lines_of, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_keep_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.without_shared_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {
    "op1_hypergeometric_shards": op1_hypergeometric_shards,
    "op2_crf_language": op2_crf_language,
    "op3_prefix_jaccard": op3_prefix_jaccard,
    "op4_token_records": op4_token_records,
    "op5_certified_packing": op5_certified_packing,
    "op6_pu_quality": op6_pu_quality,
    "op7_lexicon_toxicity": op7_lexicon_toxicity,
    "op8_fm_index": op8_fm_index,
    "op9_digest_runs": op9_digest_runs,
    "op10_run_length_index": op10_run_length_index,
    "op11_transducer_divergence": op11_transducer_divergence,
    "op12_frequency_split_runs": op12_frequency_split_runs,
    "op13_keep_bitmaps": op13_keep_bitmaps,
}

ORACLES = {
    "op9_digest_runs": """
        WITH norm AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
            FROM documents
        )
        SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
        FROM norm
    """,
    "op11_transducer_divergence": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
            FROM documents
        ),
        found AS (
            SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
        ),
        kept AS (SELECT lang, term FROM found GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
        counts AS (
            SELECT lang, source, term, count(*) AS n FROM found JOIN kept USING (lang, term) GROUP BY lang, source, term
        ),
        sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
        groups AS (SELECT DISTINCT lang, source FROM docs),
        masses AS (
            SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS mass
            FROM groups g LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source GROUP BY g.lang, g.source
        ),
        shares AS (
            SELECT m.lang, m.source, k.term, coalesce(c.n, 0) AS n,
                   1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (m.mass + s.v) AS p
            FROM masses m JOIN sizes s USING (lang) JOIN kept k USING (lang)
            LEFT JOIN counts c ON c.lang = m.lang AND c.source = m.source AND c.term = k.term
        ),
        whole AS (
            SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(n) + 1)) // (any_value(mass) + any_value(v)) AS q
            FROM counts JOIN sizes USING (lang)
            JOIN (SELECT lang, sum(n) AS mass FROM counts GROUP BY lang) USING (lang) GROUP BY lang, term
        ),
        sums AS (
            SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
            FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
            GROUP BY a.lang, a.source, b.source
        ),
        pairs AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
            FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
        ),
        terms AS (
            SELECT s.lang, s.source, 'term' AS part, s.term AS item, (((s.p - w.q) * (s.p - w.q)) // w.q)::BIGINT AS value
            FROM shares s JOIN whole w USING (lang, term) WHERE s.n > 0 AND s.p > w.q
        ),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
            FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
        )
        SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200
    """,
    "op13_keep_bitmaps": r"""
        WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
        lines AS (
            SELECT r, doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos
            FROM docs
        ),
        keyed AS (
            SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM lines
        ),
        gone AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10)
        SELECT any_value(k.doc_id) AS doc_id, count(*) AS n_lines, count(g.key) AS n_dropped,
               sha256(coalesce(string_agg(k.line, chr(10) ORDER BY k.pos) FILTER (g.key IS NULL), '')) AS kept_sha256
        FROM keyed k LEFT JOIN gone g ON g.key = k.key GROUP BY k.r
    """,
    "op12_frequency_split_runs": r"""
        WITH hashed AS (
            SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w,
                   xor(list_reduce(
                       list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                       lambda crc, b: list_reduce(
                           list_prepend(xor(crc, b), range(8)),
                           lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)
                   ), 4294967295) AS h
            FROM documents
        ),
        sized AS (SELECT doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS looped, h // 10 AS g FROM hashed),
        placed AS (
            SELECT *, CASE WHEN looped THEN g % n END AS a, CASE WHEN looped THEN 1 + (n - g % n) // (3 + g % 8) END AS p
            FROM sized
        ),
        texts AS (
            SELECT doc_id, n, CASE WHEN looped
                THEN list_transform(range(n), lambda i: w[1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END]) ELSE w END AS w
            FROM placed
        ),
        words AS (SELECT doc_id, n, unnest(w) AS word, unnest(range(n)) AS i FROM texts),
        equal AS (
            SELECT x.doc_id, y.i - x.i AS q, x.i
            FROM words x JOIN words y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
        ),
        islands AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM equal),
        stretches AS (
            SELECT doc_id, min(i) AS start, count(*) + q AS length, q FROM islands
            GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(6, 4 * q)
        ),
        runs AS (SELECT doc_id, start, length, min(q) AS period FROM stretches GROUP BY doc_id, start, length),
        longest AS (
            SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, period) AS k FROM runs
        ),
        lists AS (
            SELECT doc_id, count(*) AS n_runs,
                   string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS list
            FROM runs GROUP BY doc_id
        ),
        dropped AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
        kept AS (
            SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text
            FROM words ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id
        )
        SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, start::BIGINT AS start, length::BIGINT AS length,
               period::BIGINT AS period, (1000 * length // period)::BIGINT AS exponent_milli,
               sha256(coalesce(list, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
        FROM documents d LEFT JOIN lists ON lists.doc_id = d.doc_id LEFT JOIN kept ON kept.doc_id = d.doc_id
        LEFT JOIN longest ON longest.doc_id = d.doc_id AND longest.k = 1
    """,
}
