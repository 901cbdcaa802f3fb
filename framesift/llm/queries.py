"""Registered queries of this subpackage, with SQL where SQL can express them."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framesift.llm import chosen_path, collocations, compression_quality, decision_rules, jaccard_join, licenses, line_dedup, mixing, periodic_runs, pieces, pii, topk, url_filters
from framesift.llm.common import held_out, table
from framesift.session import materialise

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query(
    "op10_mix_sources",
    r"""WITH sized AS (
          SELECT doc_id, source, text, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents),
        sums AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
        weighed AS (SELECT *, CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END::DOUBLE AS w,
          source_size::DOUBLE AS s FROM sums),
        placed AS (SELECT *, 1.5::DOUBLE * sum(s) OVER () AS total, sum(w) OVER () AS weights,
          coalesce(2 * sum(s) OVER before, 0) AS given, coalesce(sum(w) OVER before, 0) AS gone
          FROM weighed WINDOW before AS (ORDER BY s / w, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        marked AS (SELECT *, 2 * s * (weights - gone) < (total - given) * w AS is_full FROM placed),
        levels AS (SELECT *, coalesce(sum(CASE WHEN is_full THEN 2 * s END) OVER (), 0) AS used, sum(CASE WHEN NOT is_full THEN w END) OVER () AS free FROM marked),
        targets AS (SELECT source, source_size, CASE WHEN is_full THEN 2 * s ELSE (total - used) * w / free END AS target FROM levels),
        rated AS (SELECT doc_id, text, size, t.source_size, target, CASE WHEN t.source_size > 0 THEN target / t.source_size ELSE 0 END AS rate
          FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
        SELECT doc_id, size, source_size, target,
          size * (floor(rate) + CASE WHEN CAST(CAST('0x' || substr(md5(concat_ws('|', '10', coalesce(CAST(doc_id AS VARCHAR), md5(text)))), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496
            < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS taken FROM rated""",
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.plan_mix(table(spark, sf_dir, "documents"))
    return planned.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@query(
    "op1_exact_top_k",
    """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS c FROM embeddings
          WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (SELECT q.vec_id AS query_id, v.vec_id, list_dot_product(q.c, v.c)::BIGINT AS score
          FROM v q JOIN v ON q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id),
        ranked AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM scored)
        SELECT * FROM ranked WHERE rank <= 5""",
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return topk.exact_top_k(rows, rows.filter(F.col("vec_id") % 50 == 0))


# The list and the fetch dates of the query come from the pages: hosts, domains and first folders are
# listed, allowed and taken off again on days given by their digests.
_LIST_SQL = """WITH captures AS (SELECT page_id, url, DATE '2024-01-01' + CAST(page_id * 7919 % 366 AS INT) AS fetched_on FROM pages),
    parsed AS (SELECT url, regexp_extract(lower(url), '^[a-z]+://([^/?#:]*)', 1) AS host, regexp_extract(url, '^[A-Za-z]+://[^/?#]*/([^/?#]+)', 1) AS folder FROM pages WHERE url IS NOT NULL),
    names AS (SELECT host AS key, 'host' AS kind FROM parsed
      UNION SELECT regexp_extract(host, '([^.]+[.][^.]+)$', 1), 'domain' FROM parsed
      UNION SELECT concat(host, '/', folder), 'folder' FROM parsed WHERE folder <> ''),
    dated AS (SELECT key, kind, DIGIT(1) AS a, DIGIT(3) AS b, DIGIT(5) AS c, DIGIT(7) AS d FROM names WHERE key <> ''),
    entries AS (SELECT key, 'block' AS action, DATE '2024-01-01' + a AS dated FROM dated WHERE kind = 'host' AND c < 160 OR kind = 'domain' AND c < 64 OR kind = 'folder' AND c < 40
      UNION ALL SELECT key, 'allow', DATE '2024-01-01' + (a + b % 64) FROM dated WHERE kind <> 'domain' AND d < 128
      UNION ALL SELECT key, 'end', DATE '2024-01-01' + (a + b) FROM dated WHERE d % 2 = 0)"""


def _list_sql(digit: str) -> str:
    return re.sub(r"DIGIT\((\d)\)", lambda m: digit.replace("{at}", m[1]), _LIST_SQL)


_SPARK_DIGIT = "CAST(conv(substr(md5(key), {at}, 2), 16, 10) AS INT)"
_DUCK_DIGIT = "CAST(CAST('0x' || substr(md5(key), {at}, 2) AS BIGINT) AS INT)"


@query(
    "op3_url_filters",
    _list_sql(_DUCK_DIGIT)
    + r""", strongest AS (SELECT key, dated, max(CASE action WHEN 'end' THEN 1 WHEN 'allow' THEN 2 ELSE 3 END) AS s FROM entries GROUP BY ALL),
    spans AS (SELECT key, CASE s WHEN 1 THEN 'end' WHEN 2 THEN 'allow' ELSE 'block' END AS action, dated AS valid_from, lead(dated) OVER (PARTITION BY key ORDER BY dated) AS valid_to FROM strongest),
    asked AS (SELECT DISTINCT url, fetched_on FROM captures),
    split AS (SELECT url, fetched_on, regexp_extract(lower(url), '^[a-z]+://([^/?#:]*)', 1) AS host,
      list_filter(string_split(regexp_extract(url, '^[A-Za-z]+://[^/?#]*(/[^?#]*)', 1), '/'), lambda x: x <> '') AS parts FROM asked),
    keyed AS (SELECT url, fetched_on, unnest(list_concat(
        list_transform(range(1, len(string_split(host, '.'))), lambda i: array_to_string(string_split(host, '.')[i:], '.')),
        list_transform(range(1, len(parts) + 1), lambda i: host || '/' || array_to_string(parts[1:i], '/')))) AS key FROM split),
    hits AS (SELECT url, fetched_on, k.key, action, valid_from, row_number() OVER (PARTITION BY url, fetched_on ORDER BY length(k.key) DESC) AS place
      FROM keyed k JOIN spans s ON k.key = s.key AND action <> 'end' AND valid_from <= fetched_on AND (valid_to IS NULL OR fetched_on < valid_to))
    SELECT page_id, c.url, c.fetched_on, coalesce(h.action, 'none') <> 'block' AS kept, h.key AS matched_key, h.action AS matched_action, h.valid_from AS matched_from
    FROM captures c LEFT JOIN hits h ON c.url = h.url AND c.fetched_on = h.fetched_on AND place = 1""",
)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    said = _list_sql(_SPARK_DIGIT).replace("FROM pages", "FROM {pages}")
    captures = spark.sql(said + " SELECT * FROM captures", pages=pages)
    entries = spark.sql(said + " SELECT key, action, dated FROM entries", pages=pages)
    return url_filters.judge(captures, entries)


@query(
    "op9_ngram_jaccard_join",
    r"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS t FROM documents),
        s AS (SELECT doc_id, list_distinct(CASE WHEN len(t) = 0 THEN [] WHEN len(t) < 3 THEN [array_to_string(t, ' ')]
          ELSE list_transform(range(1, len(t) - 1), lambda i: array_to_string(t[i:i + 2], ' ')) END) AS g FROM w),
        e AS (SELECT doc_id, len(g) AS n, unnest(g) AS token FROM s),
        shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i, any_value(a.n) AS na, any_value(b.n) AS nb
          FROM e a JOIN e b ON a.token = b.token AND a.doc_id <> b.doc_id AND 100 * a.n >= 90 * b.n AND 100 * b.n >= 90 * a.n GROUP BY 1, 2),
        links AS (SELECT a, b FROM shared WHERE 100 * i >= 90 * (na + nb - i)),
        reach(doc_id, to_id) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.to_id = l.a)
        SELECT s.doc_id, len(g)::BIGINT AS n_shingles, component_id FROM s JOIN (SELECT doc_id, min(to_id) AS component_id FROM reach GROUP BY 1) USING (doc_id)""",
)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_groups(table(spark, sf_dir, "documents"))


@query("op4_quality_classifier")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = compression_quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = compression_quality.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


PIECES = "/opt/tokenizers/piece_bpe_32k.model"


@query("op2_sentencepiece")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), PIECES).select("doc_id", "n_ids", "ids", "restored")


@query(
    "op7_line_dedup",
    r"""WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL),
        raw AS (SELECT doc_id, unnest(parts) AS raw, unnest(range(len(parts))) AS pos FROM split),
        lines AS (SELECT doc_id, pos, raw, trim(raw, E' \t\r\x0b\x0c') AS line FROM raw),
        classes AS (SELECT *, CASE WHEN length(line) < 20 THEN doc_id END AS home FROM lines WHERE line <> ''),
        firsts AS (SELECT line, home, min((doc_id, pos)) AS first FROM classes GROUP BY ALL),
        long AS (SELECT line, first FROM firsts WHERE length(line) >= 20),
        near AS (SELECT DISTINCT b.line FROM long a JOIN long b ON a.first < b.first AND abs(length(a.line) - length(b.line)) <= 2
          AND (left(a.line, 6) = left(b.line, 6) OR right(a.line, 6) = right(b.line, 6) OR position(substr(a.line, length(a.line) // 2 - 3, 6) IN b.line) > 0) AND levenshtein(a.line, b.line) <= 2),
        judged AS (SELECT c.doc_id, c.pos, (c.doc_id, c.pos) > f.first AS repeated, n.line IS NOT NULL AS close
          FROM classes c JOIN firsts f ON c.line = f.line AND c.home IS NOT DISTINCT FROM f.home LEFT JOIN near n ON n.line = c.line AND c.home IS NULL),
        texts AS (SELECT l.doc_id, coalesce(string_agg(l.raw, chr(10) ORDER BY l.pos) FILTER (NOT coalesce(repeated OR close, false)), '') AS text,
            count(j.pos)::INT AS n_lines, (count(*) FILTER (repeated))::INT AS n_repeated, (count(*) FILTER (close AND NOT repeated))::INT AS n_near
          FROM lines l LEFT JOIN judged j USING (doc_id, pos) GROUP BY 1)
        SELECT d.doc_id, t.text, coalesce(n_lines, 0) AS n_lines, coalesce(n_repeated, 0) AS n_repeated, coalesce(n_near, 0) AS n_near
        FROM documents d LEFT JOIN texts t USING (doc_id)""",
)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op8_quality_rules")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = materialise(decision_rules.statistics(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text"), "statistics")
    judged = decision_rules.judge(stats, decision_rules.learn(stats, table(spark, sf_dir, "labels")))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op5_pii")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four counts are of base matches, as is the digest; ``n_added`` counts what the field added."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.fit(docs)).drop("text")
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("pii", lambda s: s["base"])
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in pii.KINDS],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("pii")).alias("spans"),
        (F.size("pii") - F.size(base)).cast("bigint").alias("n_added"),
    )


@query("op6_license_scan")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    percent = lambda m: F.round(100 * m["coverage"]).cast("int")
    listed = F.transform("licenses", lambda m: F.concat_ws(":", m["license"], m["template"], m["start"], m["end"], percent(m)))
    return found.select("doc_id", F.size("licenses").cast("bigint").alias("n_matches"), F.array_join(listed, ",").alias("matches"))


@query("op13_periodic_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.detect_runs(table(spark, sf_dir, "documents").select("doc_id", "text"), fold=True)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = F.col("strongest")
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )


@query(
    "op11_collocations",
    r"""WITH pieces AS (SELECT coalesce(lang, 'und') AS lang,
          unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
        split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS t FROM pieces),
        sizes AS (SELECT lang, sum(len(t))::BIGINT AS n FROM split GROUP BY lang),
        said AS (SELECT lang, words, unnest(list_transform(range(1, len(t) - words + 2), lambda i: array_to_string(t[i:i + words - 1], ' '))) AS phrase
          FROM split, (SELECT unnest([1, 2, 3, 4]) AS words) WHERE len(t) >= words),
        f AS (SELECT lang, words, phrase, count(*) AS f FROM said GROUP BY ALL HAVING count(*) >= 30),
        cand AS (SELECT *, string_split(phrase, ' ') AS t FROM f WHERE words > 1),
        cuts AS (SELECT lang, phrase, t, f, unnest(range(1, words)) AS k FROM cand),
        judged AS (SELECT c.lang, c.phrase, c.f AS a, k, x.f AS l, y.f AS r, (2000000::HUGEINT * c.f // (x.f + y.f))::BIGINT AS score
          FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(t[1:k], ' ') JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(t[k + 1:], ' ')),
        weakest AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM judged),
        kept AS (SELECT * FROM weakest c WHERE place = 1 AND NOT EXISTS (SELECT 1 FROM cand b WHERE b.lang = c.lang AND b.words > len(string_split(c.phrase, ' '))
          AND contains(' ' || b.phrase || ' ', ' ' || c.phrase || ' ') AND 100 * b.f >= 80 * c.a)),
        ranked AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score FROM kept)
        SELECT lang, rank::BIGINT AS rank, phrase, a, l, r, n, score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000""",
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents").select("lang", "text"))


def _groups_sql(percent: int, columns: str) -> str:
    return r"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS t FROM documents),
        s AS (SELECT doc_id, list_distinct(CASE WHEN len(t) = 0 THEN [] WHEN len(t) < 3 THEN [array_to_string(t, ' ')]
          ELSE list_transform(range(1, len(t) - 1), lambda i: array_to_string(t[i:i + 2], ' ')) END) AS g FROM w),
        e AS (SELECT doc_id, len(g) AS n, unnest(g) AS token FROM s),
        shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i, any_value(a.n) AS na, any_value(b.n) AS nb
          FROM e a JOIN e b ON a.token = b.token AND a.doc_id <> b.doc_id AND 100 * a.n >= PERCENT * b.n AND 100 * b.n >= PERCENT * a.n GROUP BY 1, 2),
        links AS (SELECT a, b FROM shared WHERE 100 * i >= PERCENT * (na + nb - i)),
        reach(doc_id, to_id) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.to_id = l.a)
        SELECT s.doc_id, len(g)::BIGINT AS n_shingles, COLUMNS FROM s JOIN (SELECT doc_id, min(to_id) AS component_id FROM reach GROUP BY 1) c USING (doc_id)""".replace("PERCENT", str(percent)).replace("COLUMNS", columns)


@query("op12_minhash_near_dedup", _groups_sql(85, "component_id, s.doc_id = component_id AS kept"))
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.near_duplicates(table(spark, sf_dir, "documents"))
