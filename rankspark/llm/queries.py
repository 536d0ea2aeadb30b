"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from rankspark.llm import (
    alignment,
    bitpack,
    decontamination,
    licenses,
    linededup,
    lmscore,
    packing,
    quality,
    recompression,
    simhash,
    urls,
    warc,
    whitening,
)
from rankspark.llm.tables import table


def tokenizer() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def op1_lmscore(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents", "doc_id", "text")
    good = lmscore.good_documents(table(spark, d, "labels", "doc_id", "quality", "toxic"))
    losses = ("target_loss", "background_loss", "difference")
    scored = lmscore.score(docs, lmscore.fit(docs, good))
    return scored.withColumns({c: F.round(c, 6) for c in losses})


def op2_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_documents(table(spark, d, "documents", "doc_id", "text"), tokenizer())


def op3_quality(spark: SparkSession, d: str) -> DataFrame:
    return quality.verdicts(table(spark, d, "documents", "doc_id", "text", "lang", "source"))


def op4_recompression(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents", "doc_id", "text")
    cut = recompression.remove_repeats(docs, joined=True)
    return cut.select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    )


RULES = (
    urls.Rule("org/", True),
    urls.Rule("example.org/es/", False),
    urls.Rule("example.org/en/1", False),
    urls.Rule("com/fr/", True),
    urls.Rule("com/de/", False),
)


def op5_urls(spark: SparkSession, d: str) -> DataFrame:
    model = urls.fit(urls.labelled_urls(spark))
    return urls.judge(table(spark, d, "pages", "page_id", "url"), model, RULES)


def op6_decontamination(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents", "doc_id", "text")
    found = decontamination.contamination(docs, table(spark, d, "benchmark", "item_id", "text"))
    ids = F.array_sort(F.col("items").cast("array<string>"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op7_bitpack(spark: SparkSession, d: str) -> DataFrame:
    back = bitpack.round_trip(table(spark, d, "documents", "doc_id", "text"), tokenizer())
    return back.select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def op8_licenses(spark: SparkSession, d: str) -> DataFrame:
    found = licenses.scan(table(spark, d, "documents", "doc_id", "text"))
    return found.withColumn("dice", F.round("dice", 6))


def op9_warc(spark: SparkSession, d: str) -> DataFrame:
    return warc.archive(table(spark, d, "pages", "page_id", "url", "html")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op10_simhash(spark: SparkSession, d: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, d, "documents", "doc_id", "text"))
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op11_whitening(spark: SparkSession, d: str) -> DataFrame:
    return whitening.whiten(table(spark, d, "embeddings", "vec_id", "embedding"))


def op12_alignment(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents", "doc_id", "text")
    return alignment.align(docs, tokenizer(), public_tokenizers.path("piece_bpe_32k.model"))


def op13_linededup(spark: SparkSession, d: str) -> DataFrame:
    kept = linededup.drop_frequent_lines(table(spark, d, "documents", "doc_id", "text"))
    return kept.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    )


QUERIES = {
    "op1_lmscore": op1_lmscore,
    "op2_packing": op2_packing,
    "op3_quality": op3_quality,
    "op4_recompression": op4_recompression,
    "op5_urls": op5_urls,
    "op6_decontamination": op6_decontamination,
    "op7_bitpack": op7_bitpack,
    "op8_licenses": op8_licenses,
    "op9_warc": op9_warc,
    "op10_simhash": op10_simhash,
    "op11_whitening": op11_whitening,
    "op12_alignment": op12_alignment,
    "op13_linededup": op13_linededup,
}

_PLAIN = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_ALNUM = r"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".format(
    upper="ABCDEFGHIJKLMNOPQRSTUVWXYZ", lower="abcdefghijklmnopqrstuvwxyz"
)

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _templates_sql() -> str:
    rows = ((k, v.replace("'", "''")) for k, v in licenses.TEMPLATES.items())
    return ", ".join(f"('{name}', '{text}')" for name, text in rows)


ORACLES = {
    "op1_lmscore": f"""
        WITH good AS (
          SELECT doc_id FROM labels GROUP BY doc_id
          HAVING bool_and(coalesce(quality = 1 AND toxic = 0, false))),
        docs AS (
          SELECT doc_id, doc_id IN (SELECT doc_id FROM good) AS target,
                 regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
        tokens AS (
          SELECT doc_id, target, unnest(w) AS raw, generate_subscripts(w, 1) AS p FROM docs),
        vocabulary AS (SELECT raw FROM tokens GROUP BY raw HAVING count(*) > 1),
        named AS (
          SELECT doc_id, target, p, coalesce(v.raw, ' unknown') AS w
          FROM tokens t LEFT JOIN vocabulary v USING (raw)),
        grams AS (
          SELECT doc_id, target, w,
                 lag(w, 1, ' start') OVER (PARTITION BY doc_id ORDER BY p) AS v FROM named),
        words AS (
          SELECT w, count(*) FILTER (target) AS t, count(*) FILTER (NOT target) AS b
          FROM grams GROUP BY w),
        sizes AS (
          SELECT (SELECT count(*) FROM vocabulary) AS size, sum(t) AS t, sum(b) AS b FROM words),
        single AS (
          SELECT w, (words.t + 1.0::DOUBLE) / (sizes.t + size + 1) AS t,
                 (words.b + 1.0::DOUBLE) / (sizes.b + size + 1) AS b FROM words, sizes),
        firsts AS (
          SELECT v, count(*) FILTER (target) AS t, count(*) FILTER (NOT target) AS b
          FROM grams GROUP BY v),
        pairs AS (
          SELECT v, w, count(*) FILTER (target) AS t, count(*) FILTER (NOT target) AS b
          FROM grams GROUP BY v, w),
        shares AS (
          SELECT v, w, greatest(p.t - 0.75::DOUBLE, 0) / greatest(f.t, 1) AS t,
                 greatest(p.b - 0.75::DOUBLE, 0) / greatest(f.b, 1) AS b
          FROM pairs p JOIN firsts f USING (v)),
        rest AS (
          SELECT v, 1 - coalesce(sum(s.t), 0) AS t, 1 - coalesce(sum(s.b), 0) AS b
          FROM firsts f LEFT JOIN shares s USING (v) GROUP BY v),
        losses AS (
          SELECT doc_id, -avg(ln(coalesce(s.t, 0) + r.t * u.t)) AS t,
                 -avg(ln(coalesce(s.b, 0) + r.b * u.b)) AS b
          FROM grams g JOIN single u USING (w) JOIN rest r USING (v) LEFT JOIN shares s USING (v, w)
          GROUP BY doc_id)
        SELECT doc_id, CAST(len(docs.w) AS BIGINT) AS n_tokens, round(t, 6) AS target_loss,
               round(b, 6) AS background_loss, round(t - b, 6) AS difference
        FROM docs LEFT JOIN losses USING (doc_id)""",
    "op8_licenses": f"""
        WITH templates(license, text) AS (VALUES {_templates_sql()}),
        known AS (
          SELECT license, list_distinct([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) AS g
          FROM (SELECT license, {_ALNUM} AS w FROM templates)),
        lines AS (
          SELECT doc_id, text, 0 AS line FROM documents
          UNION ALL
          SELECT doc_id, unnest(l), generate_subscripts(l, 1)
          FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)),
        units AS (
          SELECT doc_id, line, list_distinct([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) AS g
          FROM (SELECT doc_id, line, {_ALNUM} AS w FROM lines)),
        near AS (
          SELECT doc_id, line, license,
                 2.0::DOUBLE * len(list_intersect(u.g, k.g)) / (len(u.g) + len(k.g)) AS dice
          FROM units u JOIN known k
            ON len(u.g) BETWEEN len(k.g) * 0.6 AND len(k.g) * 1.6),
        best AS (
          SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY dice DESC, line, license) AS r,
                 count(*) OVER (PARTITION BY doc_id) AS n_matches
          FROM near WHERE dice >= 0.8)
        SELECT doc_id, license, round(dice, 6) AS dice, CAST(line AS INTEGER) AS line,
               CAST(coalesce(n_matches, 0) AS BIGINT) AS n_matches
        FROM documents LEFT JOIN (SELECT * FROM best WHERE r = 1) USING (doc_id)""",
    "op6_decontamination": f"""
        WITH docs AS (SELECT doc_id, {_ALNUM} AS w FROM documents),
        items AS (SELECT item_id, {_ALNUM} AS w FROM benchmark),
        patterns AS (
          SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS seq
          FROM (SELECT item_id, w, least(10, len(w)) AS n,
                       unnest(generate_series(1, greatest(1, len(w) - 9))) AS p
                FROM items WHERE len(w) > 0)),
        sizes AS (SELECT DISTINCT n FROM patterns),
        windows AS (
          SELECT doc_id, p, n, array_to_string(w[p:p + n - 1], ' ') AS seq
          FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS p
                FROM docs, sizes)),
        hits AS (SELECT doc_id, p, n, item_id FROM windows JOIN patterns USING (n, seq)),
        words AS (
          SELECT doc_id, count(DISTINCT p + k) AS n_hit
          FROM (SELECT doc_id, p, unnest(range(n)) AS k FROM hits) GROUP BY doc_id),
        held AS (
          SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits)
          GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
               CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
               CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM docs LEFT JOIN words USING (doc_id) LEFT JOIN held USING (doc_id)""",
    "op4_recompression": f"""
        WITH docs AS (SELECT doc_id, {_PLAIN} AS w FROM documents),
        words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM docs),
        windows AS (
          SELECT doc_id, p, array_to_string(w[p:p + 12], ' ') AS seq
          FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 12)) AS p FROM docs)),
        first AS (SELECT seq, min(doc_id) AS least FROM windows GROUP BY seq),
        gone AS (
          SELECT DISTINCT doc_id, p + k AS p
          FROM windows JOIN first USING (seq), range(13) AS r(k) WHERE least < doc_id),
        kept AS (
          SELECT doc_id, count(g.p) AS n_removed,
                 string_agg(word, ' ' ORDER BY p) FILTER (g.p IS NULL) AS text
          FROM words LEFT JOIN gone g USING (doc_id, p) GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
               CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
               sha256(coalesce(kept.text, '')) AS kept_sha256
        FROM docs LEFT JOIN kept USING (doc_id)""",
    "op9_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS hex FROM p),
        m AS (SELECT hex, max(page_id) AS last FROM d GROUP BY hex)
        SELECT page_id, payload_bytes,
               array_to_string([
                 substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   1 + ((CAST('0x' || substr(hex, CAST(5 * (k // 4) + 1 AS INT), 5) AS BIGINT)
                         >> CAST(15 - 5 * (k % 4) AS INT)) & 31), 1)
                 for k in range(32)], '')
                 AS payload_digest,
               CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> last THEN last END AS refers_to
        FROM d JOIN m USING (hex)""",
    "op13_linededup": """
        WITH lines AS (
          SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS p
          FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
        keyed AS (
          SELECT doc_id, p, line,
                 trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                      ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key
          FROM lines),
        often AS (
          SELECT key FROM keyed WHERE length(key) >= 1
          GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
        SELECT doc_id, count(*) AS n_lines, count(o.key) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (o.key IS NULL), '')) AS kept_sha256
        FROM keyed k LEFT JOIN often o USING (key) GROUP BY doc_id""",
}
