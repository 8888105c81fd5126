"""The operators' queries over the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm import crf, decontaminate, digestmerge, licenses, linededup, ngramjoin, packing, periodic, quality_rules, surrogates, toxicity, unitdedup, vectorcodes
from ledgerflow.llm.columns import let, words
from ledgerflow.llm.common import read_table
from ledgerflow.llm.labelled import remainder


#: Only a stand-in: a deployment passes its own secret to the operator.
SURROGATE_KEY = b"a key that is kept elsewhere"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(licenses.scan_licenses(read_table(spark, sf_dir, "documents")))


def op2_toxicity_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    scored = toxicity.score_toxicity(docs, toxicity.train(docs, labels))
    predicted = (F.col("score") >= 0.3).cast("int").alias("predicted")
    return scored.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "score", predicted, "n_windows", "worst")


def op3_unit_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    # copied passages begin and end inside lines and clauses
    passages = unitdedup.extended_passages(read_table(spark, sf_dir, "documents"), min_words=25)
    return passages.drop("text_hash")


def op4_benchmark_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contained_items(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.drop("text_hash")


def op5_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    scored = crf.score_quality(docs, crf.train(docs, labels))
    predicted = (F.col("score") >= 0.3).cast("int").alias("predicted")
    return scored.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score", predicted, "n_lines", "n_bad")


def op6_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.quality_rules(read_table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "d2")


def op7_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.replace_entities(docs, SURROGATE_KEY, only_changed=True).withColumn("n_entities", F.size("entities"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = linededup.apply_keep(docs, linededup.line_keep_bitmaps(docs))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.jaccard_components(read_table(spark, sf_dir, "documents")).drop("text_hash")


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), tokenizer_path())


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, codebooks = vectorcodes.compress_vectors(read_table(spark, sf_dir, "embeddings"))
    sha = F.lit(vectorcodes.codebooks_sha256(codebooks)).alias("codebooks_sha256")
    return coded.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", sha)


def _planted(doc_id: Column, text: Column) -> Column:
    """The text, in which by the id's crc32 every tenth document repeats the
    words behind a certain place with a certain period."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)

    def repeated(w: Column) -> Column:
        n = F.size(w)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        return F.array_join(F.transform(w, lambda x, i: F.when(i < a, x).otherwise(F.get(w, a + F.pmod(i - a, p)))), " ")

    return F.when(h % 10 == 0, let(words(text), repeated)).otherwise(text)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", _planted(F.col("doc_id"), F.col("text")).alias("text"))
    found = periodic.periodic_runs(docs)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    # the runs lie by start and period: a later one must be strictly greater
    greater = lambda a, b: b["length"] * a["period"] > a["length"] * b["period"]
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda a, b: F.when(greater(a, b), b).otherwise(a))
    found = found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
    exponent = F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli")
    return found.select("doc_id", "n_runs", "best.start", "best.length", "best.period", exponent, "runs_sha256", "collapsed_sha256")


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digestmerge.exact_duplicates(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_toxicity_gru": op2_toxicity_gru,
    "op3_unit_dedup": op3_unit_dedup,
    "op4_benchmark_containment": op4_benchmark_containment,
    "op5_quality_crf": op5_quality_crf,
    "op6_robust_outliers": op6_robust_outliers,
    "op7_pii_surrogates": op7_pii_surrogates,
    "op8_line_dedup": op8_line_dedup,
    "op9_ngram_jaccard_join": op9_ngram_jaccard_join,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_vector_codes": op11_vector_codes,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_exact_dedup": op13_exact_dedup,
}

def _vector_codes_sql(rounds: int = 4) -> str:
    """The rounds of k-means one after another, by full search."""
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""
        , d{k} AS MATERIALIZED (
            SELECT r, p.part, p.y, min(CAST(list_sum(list_transform(list_zip(y, e), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) * 256 + k) AS best
            FROM p JOIN b{k} USING (part) GROUP BY r, p.part, p.y
        )""")
        if k < rounds:
            steps.append(f"""
        , m{k} AS (
            SELECT part, best % 256 AS k, pos, sum(y[pos])::BIGINT AS s, count(*) AS n FROM d{k}, unnest(range(1, len(y) + 1)) AS u(pos) GROUP BY ALL
        ), b{k + 1} AS MATERIALIZED (
            SELECT part, k, coalesce(moved, e) AS e
            FROM b{k} LEFT JOIN (SELECT part, k, list((s - ((s % n) + n) % n) // n ORDER BY pos) AS moved FROM m{k} GROUP BY part, k) USING (part, k)
        )""")
    return f"""
        WITH v AS (
            SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label, list_transform(embedding, lambda c: CAST(floor(1024 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
            FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
        ), p AS MATERIALIZED (
            SELECT r, part, x[1 + part * len(x) // 4 : (part + 1) * len(x) // 4] AS y FROM v, unnest(range(4)) AS u(part)
        ), b0 AS MATERIALIZED (
            SELECT part, r - 1 AS k, y AS e FROM p WHERE r <= 256
        ){"".join(steps)}, told AS (
            SELECT r, string_agg(format('{{:02x}}', best % 256), '' ORDER BY part) AS code, CAST(sum(best // 256) AS BIGINT) AS error FROM d{rounds} GROUP BY r
        ), books AS (
            SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY part, k)) AS codebooks_sha256 FROM b{rounds}
        )
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM v JOIN told USING (r), books
    """


ORACLE_SQL: dict[str, str] = {
    "op4_benchmark_containment": r"""
        WITH d AS (
            SELECT doc_id, regexp_split_to_array(trim(lower(coalesce(text, '')), e' \t\n\x0b\x0c\r'), '[\x20\x09-\x0D]+') AS w FROM documents
        ), b AS (
            SELECT item_id, regexp_split_to_array(trim(lower(coalesce(text, '')), e' \t\n\x0b\x0c\r'), '[\x20\x09-\x0D]+') AS w FROM benchmark
        ), items AS (
            SELECT row_number() OVER () AS item, item_id, w, least(len(w), 5) AS k FROM (SELECT DISTINCT item_id, w FROM b WHERE w <> [''])
        ), ks AS (
            SELECT DISTINCT k FROM items
        ), ds AS (
            SELECT DISTINCT doc_id, k, array_to_string(w[i:i + k - 1], ' ') AS s FROM d, ks, unnest(range(1, len(w) - k + 2)) AS u(i) WHERE w <> ['']
        ), bs AS (
            SELECT DISTINCT item, item_id, k, array_to_string(w[i:i + k - 1], ' ') AS s FROM items, unnest(range(1, len(w) - k + 2)) AS u(i)
        ), n AS (
            SELECT item, CAST(count(*) AS INT) AS n_item FROM bs GROUP BY item
        ), hits AS (
            SELECT doc_id, item, item_id, count(*) AS n_shared FROM ds JOIN bs USING (k, s) GROUP BY ALL
        ), best AS (
            SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n_shared / n_item DESC, n_item DESC) AS place
            FROM hits JOIN n USING (item) WHERE 100 * n_shared >= 75 * n_item
        )
        SELECT doc_id, item_id, n_item, n_shared, n_shared / n_item AS containment FROM best WHERE place = 1
    """,
    "op9_ngram_jaccard_join": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, trim(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), e' \t\n\x0b\x0c\r') AS t FROM documents
        ), p AS (
            SELECT doc_id, regexp_split_to_array(t, '[\x20\x09-\x0D]+') AS w FROM w WHERE t <> ''
        ), sh AS (
            SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM p, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS u(i)
        ), n AS (
            SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id
        ), shared AS (
            SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM sh a JOIN sh b USING (s) GROUP BY 1, 2
        ), links AS (
            SELECT u, v FROM shared JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * c >= 75 * (a.n + b.n - c)
        ), reach AS (
            SELECT doc_id AS u, doc_id AS v FROM documents UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u
        )
        SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.v) AS component_id
        FROM documents d LEFT JOIN n USING (doc_id) JOIN reach r ON r.u = d.doc_id GROUP BY d.doc_id
    """,
    "op8_line_dedup": r"""
        WITH lines AS (
            SELECT doc_id, i AS pos, parts[i] AS line, translate(trim(parts[i], e' \t\n\x0b\x0c\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents) d, unnest(range(1, len(parts) + 1)) AS u(i)
        ), shared AS (
            SELECT key, min(doc_id) AS keeper FROM lines WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2
        ), marked AS (
            SELECT doc_id, pos, line, keeper IS NOT NULL AND doc_id <> keeper AS gone FROM lines LEFT JOIN shared USING (key)
        )
        SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(gone AS INT)) AS BIGINT) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
        FROM marked GROUP BY doc_id
    """,
    "op11_vector_codes": _vector_codes_sql(),
    "op12_periodic_runs": r"""
        WITH h AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                   xor(4294967295::BIGINT, list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT),
                       lambda crc, b: list_reduce(range(8), lambda c, k: xor(c >> 1, (c & 1) * 3988292384), xor(crc, b)), 4294967295::BIGINT)) AS h
            FROM documents
        ), a AS (
            SELECT doc_id, w, h, len(w) AS n, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM h
        ), d AS (
            SELECT doc_id, CASE WHEN h % 10 = 0 AND n > 0
                THEN list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) END]) ELSE w END AS w
            FROM a
        ), x AS (
            SELECT doc_id, len(w) AS n, i, w[1 + i] AS word FROM d, unnest(range(len(w))) AS u(i)
        ), pairs AS (
            SELECT l.doc_id, r.i - l.i AS q, l.i FROM x l JOIN x r ON l.doc_id = r.doc_id AND l.word = r.word AND r.i > l.i AND 3 * (r.i - l.i) <= l.n
        ), stretches AS (
            SELECT doc_id, q, min(i) AS s, max(i) + 1 + q AS e
            FROM (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs) GROUP BY doc_id, q, island
        ), runs AS (
            SELECT doc_id, s, e - s AS l, min(q) AS q FROM stretches WHERE e - s >= greatest(24, 3 * q) GROUP BY doc_id, s, e
        ), dropped AS (
            SELECT DISTINCT doc_id, j FROM runs, unnest(range(s + q, s + l)) AS u(j)
        ), kept AS (
            SELECT x.doc_id, string_agg(word, ' ' ORDER BY i) AS t FROM x LEFT JOIN dropped ON x.doc_id = dropped.doc_id AND x.i = dropped.j
            WHERE dropped.j IS NULL GROUP BY x.doc_id
        ), told AS (
            SELECT doc_id, count(*) AS n_runs, string_agg(concat(s, ',', l, ',', q, chr(10)), '' ORDER BY s, q) AS lines FROM runs GROUP BY doc_id
        ), best AS (
            SELECT r.doc_id, r.s, r.l, r.q FROM runs r WHERE NOT EXISTS (
                SELECT 1 FROM runs o WHERE o.doc_id = r.doc_id
                    AND (o.l * r.q > r.l * o.q OR o.l * r.q = r.l * o.q AND (o.s < r.s OR o.s = r.s AND o.q < r.q)))
        )
        SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, s AS start, l AS length, q AS period, 1000 * l // q AS exponent_milli,
               sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(t, '')) AS collapsed_sha256
        FROM documents d LEFT JOIN told USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)
    """,
    "op13_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, length(coalesce(text, '')) AS n, sha256(translate(coalesce(text, ''), e' \t\n\x0b\x0c\r', '')) AS text_sha256 FROM documents
        ), ranked AS (
            SELECT doc_id, text_sha256, first_value(doc_id) OVER by_rank AS keep_id, row_number() OVER by_rank AS k,
                   count(*) OVER (PARTITION BY text_sha256) AS group_size
            FROM d WINDOW by_rank AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST)
        )
        SELECT doc_id, keep_id, group_size, k = 1 AS kept, text_sha256 FROM ranked
    """,
}
