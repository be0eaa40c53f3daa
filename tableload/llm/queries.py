"""Driver queries of the training-data operators, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableload.llm.bpe import encode_documents
from tableload.llm.chunk_dedup import repeated_spans
from tableload.llm.common import LOWER, UPPER, table
from tableload.llm.fingerprints import edited_neighbours
from tableload.llm.hard_negatives import coded, mine, usable
from tableload.llm.jaccard_join import near_duplicates
from tableload.llm.license_scan import license_findings
from tableload.llm.line_dedup import line_report
from tableload.llm.pfair_mix import ALPHA, BLOCK_DOCS, PARTS_A_SOURCE, TOTAL, mix_schedule
from tableload.llm.quality_mcd import quality_verdicts
from tableload.llm.spelling_variants import spelling_variants
from tableload.llm.suffix_dedup import repeat_report
from tableload.llm.toxicity import toxicity
from tableload.llm.warc_audit import audit, record_digests, warc_record

RANKS = "byte_bpe_multi_50k.tiktoken"


def op1_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text, with their estimated likeness."""
    return edited_neighbours(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines every document loses and the digest of what is left."""
    return line_report(table(spark, sf_dir, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes every document loses to 200-byte strings that start elsewhere too, and the digest of what is left."""
    return repeat_report(table(spark, sf_dir, "documents"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document's ids and decoded bytes."""
    return encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN, keep_ids=False)


#: Ids of the pages that share a WARC file, and of every so many the damage that the second copy has:
#: a changed first byte, two more bytes, a loss in mid-file, a loss of a file's last records.
FILE_PAGES, FLIP_EVERY, FLIP_AT, GROW_EVERY, GROW_AT, LOSE_EVERY, LOSE_AT, CUT_EVERY, CUT_FROM = 1000, 101, 37, 307, 111, 211, 53, 7000, 6990


def op5_merkle_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged and lost records of a second WARC copy of all pages, found through the trees.

    The copy holds every page again, some with their first byte changed or two
    bytes longer, some missing in mid-file, and some files without their last records.
    """
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    pages = pages.withColumn("file", F.floor(F.col("page_id") / FILE_PAGES))
    head = F.substring("html", 1, 1)
    flipped = (F.col("page_id") % FLIP_EVERY == FLIP_AT) & (F.octet_length(head) == 1) & (head != "~")
    copy = pages.where(f"not coalesce(page_id % {CUT_EVERY} >= {CUT_FROM} or page_id % {LOSE_EVERY} = {LOSE_AT}, false)")
    copy = copy.withColumn("html", F.when(flipped, F.concat(F.lit("~"), F.expr("substring(html, 2)"))).otherwise(F.col("html")))
    copy = copy.withColumn("html", F.when(F.col("page_id") % GROW_EVERY == GROW_AT, F.concat(F.coalesce("html", F.lit("")), F.lit("++"))).otherwise(F.col("html")))
    record = warc_record("response", F.col("url"), F.col("page_id"), F.col("html"))
    held = [record_digests(p.withColumn("record", record), "file", "page_id", "record") for p in (pages, copy)]
    return audit(*held).withColumnRenamed("key", "page_id")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rules and the robust-outlier verdict of every document."""
    return quality_verdicts(table(spark, sf_dir, "documents"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence paragraphs of every document that has any, by a classifier trained on a bounded sample."""
    return license_findings(table(spark, sf_dir, "documents"))


def op8_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated spans of content-defined chunks in every document that has any."""
    return repeated_spans(table(spark, sf_dir, "documents")).drop("gone")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of every document's shingle set and the group its links put it in."""
    return near_duplicates(table(spark, sf_dir, "documents"))


def op10_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slot and place of every document in the mix of its sources."""
    return mix_schedule(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, for each of its five best positives."""
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    # rint keeps null, NaN and infinite components as they are, floor would cast to long
    scaled = F.transform("embedding", lambda x: F.lit(256.0) * x.cast("double"))
    whole = F.transform(scaled, lambda x: F.rint(x) - F.when(F.rint(x) > x, 1.0).otherwise(0.0))
    rows, dim = coded(usable(vectors, F.col("vec_id"), label, whole))
    return mine(rows, dim, F.col("vec_id") % 100 == 0)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequent words of all documents, each with its number of near words, its form and its root."""
    return spelling_variants(table(spark, sf_dir, "documents"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score and verdict of every document."""
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_document_fingerprints": op1_document_fingerprints,
    "op2_line_dedup": op2_line_dedup,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_merkle_audit": op5_merkle_audit,
    "op6_quality_rules": op6_quality_rules,
    "op7_license_scan": op7_license_scan,
    "op8_chunk_dedup": op8_chunk_dedup,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_pfair_mix": op10_pfair_mix,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_toxicity": op13_toxicity,
}

_WS = " || ".join(f"chr({n})" for n in (32, 9, 10, 11, 12, 13))

ORACLE: dict[str, str] = {
    "op2_line_dedup": f"""
        WITH lines AS (
          SELECT doc_id, pos, line, translate(trim(line, {_WS}), '{UPPER}', '{LOWER}') AS key
          FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                       generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents)
        ), hot AS (
          SELECT key, max(doc_id) AS last FROM lines WHERE length(key) >= 20
          GROUP BY key HAVING count(DISTINCT doc_id) >= 3
        ), marked AS (
          SELECT l.doc_id, l.pos, l.line, h.key IS NOT NULL AND l.doc_id <> h.last AS dropped
          FROM lines l LEFT JOIN hot h ON l.key = h.key
        )
        SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN dropped THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
               sha256(coalesce(string_agg(CASE WHEN dropped THEN NULL ELSE line END, chr(10) ORDER BY pos), '')) AS kept_sha256
        FROM marked GROUP BY doc_id
    """,
    "op5_merkle_audit": f"""
        WITH copies AS (
          SELECT page_id, page_id // {FILE_PAGES} AS file, url, coalesce(html, '') AS html,
                 page_id % {CUT_EVERY} >= {CUT_FROM} OR page_id % {LOSE_EVERY} = {LOSE_AT} AS lost,
                 (CASE WHEN page_id % {FLIP_EVERY} = {FLIP_AT} AND strlen(html[1]) = 1 AND html[1] <> '~' THEN '~' || html[2:] ELSE coalesce(html, '') END)
                 || (CASE WHEN page_id % {GROW_EVERY} = {GROW_AT} THEN '++' ELSE '' END) AS copy
          FROM pages
        ), heads AS (
          SELECT *, 'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10)
                 || 'WARC-Record-ID: <urn:record:' || coalesce(CAST(page_id AS VARCHAR), '') || '>' || chr(13) || chr(10)
                 || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'Content-Length: ' AS head,
                 chr(13) || chr(10) || chr(13) || chr(10) AS gap
          FROM copies
        ), records AS (
          SELECT *, head || CAST(strlen(html) AS VARCHAR) || gap || html || gap AS record, head || CAST(strlen(copy) AS VARCHAR) || gap || copy || gap AS other FROM heads
        ), laid AS (
          SELECT *, CAST(coalesce(sum(strlen(record)) OVER (PARTITION BY file ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset"
          FROM records
        )
        SELECT file, "offset", CASE WHEN lost THEN 'lost' ELSE 'corrupt' END AS status, page_id, strlen(record) AS length,
               sha256(record) AS expected, CASE WHEN NOT lost THEN sha256(other) END AS found
        FROM laid WHERE lost OR record <> other
    """,
    "op10_pfair_mix": f"""
        WITH RECURSIVE docs AS (SELECT doc_id, coalesce(source, '') AS source FROM documents),
        sizes AS (SELECT source, pow(count(*), {ALPHA}) AS w FROM docs GROUP BY source),
ends AS (
          SELECT source, round(sum(w) OVER (ORDER BY source ROWS UNBOUNDED PRECEDING) / sum(w) OVER () * greatest({TOTAL}, {PARTS_A_SOURCE} * count(*) OVER ())) AS e FROM sizes
        ), parts AS (
          SELECT source, CAST(greatest(1, e - coalesce(lag(e) OVER (ORDER BY source), 0)) AS BIGINT) AS p FROM ends
        ), one AS (SELECT list(source ORDER BY source) AS s, list(p ORDER BY source) AS ps, CAST(sum(p) AS BIGINT) AS total FROM parts
        ), turn AS (
          SELECT CAST(-1 AS BIGINT) AS tick, list_transform(ps, lambda p: CAST(0 AS BIGINT)) AS had, CAST(0 AS BIGINT) AS chosen FROM one
          UNION ALL
          SELECT tick + 1, list_transform(had, lambda h, i: h + CASE WHEN i = pick THEN 1 ELSE 0 END), pick
          FROM (SELECT tick, had, list_min(list_transform(had, lambda h, i:
                  CASE WHEN h * total // ps[i] <= tick + 1 THEN ((h + 1) * total + ps[i] - 1) // ps[i] * 1000000 + i END)) % 1000000 AS pick
                FROM turn, one WHERE tick + 1 < total)
        ), period AS (
          SELECT s[chosen] AS source, tick, row_number() OVER (PARTITION BY chosen ORDER BY tick) - 1 AS nth FROM turn, one WHERE tick >= 0
        ), placed AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS n FROM docs)
        SELECT d.doc_id, d.source, d.n // {BLOCK_DOCS} AS block,
               d.n // {BLOCK_DOCS} // p.p * (SELECT total FROM one) + t.tick AS slot, CAST(d.n % {BLOCK_DOCS} AS INTEGER) AS place
        FROM placed d JOIN parts p ON p.source = d.source JOIN period t ON t.source = d.source AND t.nth = (d.n // {BLOCK_DOCS}) % p.p
    """,
    "op11_hard_negatives": """
        WITH taking AS (
          SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                 list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
          FROM embeddings
          WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
        ), scored AS (
          SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
                 CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
          FROM taking a JOIN taking b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
        ), positives AS (
          SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        )
        SELECT p.anchor_id, p.positive_id,
               CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
               n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
        FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
         AND 80 * p.positive_score <= 100 * n.score AND 100 * n.score <= 100 * p.positive_score
        QUALIFY rank <= 5
    """,
    "op9_jaccard_join": f"""
        WITH RECURSIVE words AS (
          SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
          FROM documents
        ), shingles AS (
          SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))
                                              WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
          FROM words
        ), sizes AS (
          SELECT w.doc_id, count(s.s) AS n FROM words w LEFT JOIN shingles s ON s.doc_id = w.doc_id GROUP BY w.doc_id
        ), both_have AS (
          SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
        ), links AS (
          SELECT a, b FROM both_have JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)
        ), reach AS (
          SELECT doc_id AS root, doc_id FROM words UNION SELECT r.root, l.b FROM reach r JOIN links l ON l.a = r.doc_id
        )
        SELECT z.doc_id, z.n AS n_shingles, min(r.doc_id) AS component_id
        FROM sizes z JOIN reach r ON r.root = z.doc_id GROUP BY z.doc_id, z.n
    """,
}
