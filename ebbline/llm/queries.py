"""The registered queries of this subpackage, with production parameters, and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.llm.decontaminate import contamination
from ebbline.llm.exact import exact_duplicates
from ebbline.llm import licences
from ebbline.llm.hard_negatives import hard_negatives
from ebbline.llm.lexical import ranked_documents
from ebbline.llm.minhash import minhash_groups
from ebbline.llm.pieces import round_trip
from ebbline.llm.quality import quality_scores
from ebbline.llm.repeats import remove_repeats
from ebbline.llm.simhash import simhash_groups
from ebbline.llm.sharding import stratified_shards
from ebbline.llm.tables import held_out_remainder, read_table
from ebbline.llm.toxicity import toxicity_scores
from ebbline.llm.warc import DATE, REVISIT_PROFILE, VERSION, read_archive, write_archive
from ebbline.workspace import new_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, oracle: str | None = None):
    def add(query):
        QUERIES[name] = query
        if oracle:
            ORACLES[name] = oracle
        return query

    return add


# crc32 of the text's bytes: the 256-entry table from its rule, then one step per byte.
_CRC32 = """
steps AS (
    SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c & 1 = 1
        THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END) ORDER BY i) AS t
    FROM (SELECT range::BIGINT AS i FROM range(256))),
checked AS (
    SELECT d.*, xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, list_transform(
        regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT)),
        lambda c, b: xor(c >> 8, steps.t[(xor(c, b) & 255) + 1]))) AS text_crc32
    FROM documents AS d, steps)"""


@_query("op1_decontamination", r"""
WITH low AS (
    SELECT 'd' AS kind, doc_id::VARCHAR AS id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
    FROM documents UNION ALL
    SELECT 'b', item_id::VARCHAR, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark),
w AS (
    SELECT kind, id, coalesce(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []::VARCHAR[]) AS w FROM low),
tests AS (
    SELECT DISTINCT id AS item_id, least(10, len(w)) AS width, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS win
    FROM w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS r(i) WHERE kind = 'b' AND len(w) > 0),
widths AS (SELECT DISTINCT width FROM tests),
places AS (
    SELECT id, i, width, array_to_string(w[i:i + width - 1], ' ') AS win
    FROM (SELECT id, w, width, unnest(range(1, len(w) - width + 2)) AS i FROM w, widths WHERE kind = 'd')),
found AS (SELECT p.id, p.i, t.width, t.item_id FROM places AS p JOIN tests AS t USING (width, win)),
hits AS (
    SELECT id, count(DISTINCT word) AS n_hit FROM (SELECT id, unnest(range(i, i + width)) AS word FROM found) GROUP BY id),
items AS (
    SELECT id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS names
    FROM found GROUP BY id),
starts AS (
    SELECT id AS item_id, i AS off, least(10, len(w)) AS width, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS win
    FROM w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS r(i) WHERE kind = 'b' AND len(w) > 0),
steps AS (
    SELECT p.id, s.item_id, s.width, s.off - p.i AS diagonal, p.i,
           p.i - row_number() OVER (PARTITION BY p.id, s.item_id, s.width, s.off - p.i ORDER BY p.i) AS run
    FROM places AS p JOIN starts AS s USING (width, win)),
longest AS (
    SELECT id, item_id AS longest_item, count(*) + width - 1 AS longest_words, min(i) - 1 AS longest_at
    FROM steps GROUP BY id, item_id, width, diagonal, run
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY count(*) + width DESC, item_id, min(i)) = 1)
SELECT d.doc_id, len(w.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
       longest_words::BIGINT AS longest_words, longest_item, longest_at::BIGINT AS longest_at
FROM documents AS d JOIN w ON w.kind = 'd' AND w.id = d.doc_id::VARCHAR LEFT JOIN hits ON hits.id = w.id
LEFT JOIN items ON items.id = w.id LEFT JOIN longest ON longest.id = w.id""")
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    lengths = F.expr("aggregate(spans, 0L, (n, x) -> x - n)")  # ((to - (from - n)): alternating sum of the bounds
    return found.select(
        "doc_id",
        "n_words",
        lengths.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
        F.col("longest.words").alias("longest_words"),
        F.col("longest.item").alias("longest_item"),
        F.col("longest.at").alias("longest_at"),
    )


def _judged(scores: DataFrame, threshold: float) -> DataFrame:
    return scores.select(
        "doc_id",
        (F.coalesce(held_out_remainder(), F.lit(0)) == 0).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


@_query("op2_quality")
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return _judged(quality_scores(docs, labels), 0.3)


@_query("op3_suffix_dedup")
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read_table(spark, sf_dir, "documents"), length=400)


PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"  # read by the driver, sent to the tasks


def piece_model(path: str = PIECE_MODEL) -> bytes:
    return Path(path).read_bytes()


@_query("op4_sentencepiece")
def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = round_trip(read_table(spark, sf_dir, "documents"), piece_model())
    return back.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_pieces"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"),
    )


@_query("op5_toxicity")
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return _judged(toxicity_scores(docs, labels), 0.5)


def _canonical_sql(text: str) -> str:
    """The SQL of licences.canonical, from the same lists."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    low = f"translate({text}, '{upper}', '{upper.lower()}')"
    low = f"regexp_replace({low}, '{licences.COPYRIGHT_LINE}', '', 'g')"
    words = f"regexp_replace({low}, '{licences.PUNCTUATION}', '  ', 'g')"
    words = f"'  ' || replace({words}, chr(10), '  ' || chr(10) || '  ') || '  '"
    for other, one in licences.EQUIVALENT:
        words = f"replace({words}, ' {other.replace(' ', '  ')} ', ' {one.replace(' ', '  ')} ')"
    return f"regexp_replace(regexp_replace({words}, ' +', ' ', 'g'), ' ?\\n ?', chr(10), 'g')"


def _known_sql() -> str:
    rows = [(i, "text", t) for i, t in licences.TEXTS] + [(i, "notice", t) for i, t in licences.NOTICES]
    return ", ".join("(" + ", ".join("'" + v.replace("'", "''") + "'" for v in row) + ")" for row in rows)


_ONE_LINE = "trim(regexp_replace({}, '[ \\n]+', ' ', 'g'))"


@_query("op6_license", f"""
WITH named AS (
    SELECT license_id, scope, {_ONE_LINE.format(_canonical_sql("text"))} AS words
    FROM (VALUES {_known_sql()}) AS known(license_id, scope, text)),
texts AS (SELECT doc_id, {_canonical_sql("coalesce(text, '')")} AS lines FROM documents),
whole AS (SELECT words, min(license_id) AS license_id FROM named WHERE words <> '' GROUP BY words),
notices AS (SELECT DISTINCT words, license_id AS notice FROM named WHERE words <> '' AND scope = 'notice'),
lines AS (
    SELECT doc_id, line, trim(l[line]) AS words
    FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS line FROM (SELECT doc_id, string_split(lines, chr(10)) AS l FROM texts))),
found AS (
    SELECT doc_id, string_agg(DISTINCT notice, ',' ORDER BY notice) AS notices, count(DISTINCT line) AS n
    FROM lines JOIN notices USING (words) GROUP BY doc_id)
SELECT doc_id, sha256({_ONE_LINE.format("lines")}) AS canonical_sha256, license_id, coalesce(notices, '') AS notices,
       coalesce(n, 0)::BIGINT AS n_notice_lines
FROM texts LEFT JOIN whole ON whole.words = {_ONE_LINE.format("lines")} LEFT JOIN found USING (doc_id)""")
def op6_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.license_scan(read_table(spark, sf_dir, "documents"), licences.known_licences(spark))


@_query("op7_simhash")
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(read_table(spark, sf_dir, "documents"), width=3, max_bits=3)


@_query("op8_sharding", f"""
WITH {_CRC32},
keyed AS (
    SELECT doc_id, source, strlen(coalesce(text, '')) + 1 AS size, text_crc32, coalesce('s' || source, '') AS stratum,
           md5('42:' || coalesce(doc_id::VARCHAR, 'null')) AS k
    FROM checked),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY k, doc_id, text_crc32, size) - 1 AS r,
           count(*) OVER (PARTITION BY stratum) AS n, count(*) OVER () AS total
    FROM keyed),
placed AS (
    SELECT *, row_number() OVER (ORDER BY (2 * r + 1)::DOUBLE / (2 * n)::DOUBLE, stratum) - 1 AS place FROM ranked),
cut AS (SELECT *, (place * 16) // total AS shard FROM placed)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'rows' AS law, shard::INTEGER AS shard,
       (place - (shard * total + 15) // 16)::BIGINT AS slot, NULL::INTEGER AS grown_shard, source
FROM cut""")
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stratified_shards(read_table(spark, sf_dir, "documents"), shards=16)


@_query("op9_exact_dedup", """
WITH t AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
    FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY low) AS keep_id, count(*) OVER (PARTITION BY low) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY low) AS kept, sha256(low) AS text_sha256
FROM t""")
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(read_table(spark, sf_dir, "documents"))


_BASE32 = " || ".join(f"to_base(('0x' || substr(d, {1 + 10 * i}, 10))::BIGINT, 32, 8)" for i in range(4))


@_query("op10_warc", f"""
WITH p AS (SELECT *, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS d FROM pages),
r AS (
    SELECT *, max(page_id) OVER (PARTITION BY payload) AS first_id,
           translate({_BASE32}, '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS digest
    FROM p),
w AS (
    SELECT *, page_id <> first_id AS again,
           concat_ws(chr(13) || chr(10), '{VERSION}', 'WARC-Type: ' || CASE WHEN page_id <> first_id THEN 'revisit' ELSE 'response' END,
               'WARC-Record-ID: <urn:page:' || page_id || '>', 'WARC-Date: {DATE}',
               'WARC-Target-URI: ' || replace(replace(url, chr(13), '%0D'), chr(10), '%0A'),
               'WARC-Payload-Digest: sha1:' || digest,
               CASE WHEN page_id <> first_id THEN 'WARC-Refers-To: <urn:page:' || first_id || '>' END,
               CASE WHEN page_id <> first_id THEN 'WARC-Profile: {REVISIT_PROFILE}' END,
               'Content-Type: text/html; charset=utf-8',
               'Content-Length: ' || CASE WHEN page_id <> first_id THEN 0 ELSE strlen(payload) END,
               '', CASE WHEN page_id <> first_id THEN '' ELSE payload END, '', '') AS record
    FROM r)
SELECT page_id, url, strlen(payload)::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN first_id END AS refers_to,
       strlen(record)::BIGINT AS record_bytes, sha256(record) AS record_sha256
FROM w""")
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "archive")
    write_archive(read_table(spark, sf_dir, "pages"), path)
    return read_archive(spark, path).drop("warc_date")


_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWER_TEXT = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@_query("op11_lexical_search", f"""
WITH t AS (
    SELECT doc_id, unnest(regexp_extract_all({_LOWER_TEXT.format("text")}, '{_WORD}')) AS term FROM documents),
lengths AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
totals AS (SELECT count(*) AS big_n, sum(n)::BIGINT AS big_l FROM lengths),
tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY doc_id, term),
weights AS (
    SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
    FROM tf, totals GROUP BY term, big_n),
asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER_TEXT.format("text")}, '{_WORD}')) AS term FROM benchmark),
scored AS (
    SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * big_n) // big_l))))::BIGINT AS score
    FROM asked JOIN weights USING (term) JOIN tf USING (term) JOIN lengths USING (doc_id), totals GROUP BY item_id, doc_id),
ranked AS (
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
    FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10""")
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), k=10)


@_query("op12_hard_negatives", """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
           list_inner_product(a.e, b.e)::BIGINT AS score
    FROM v AS a JOIN v AS b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)::INTEGER AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) <= 3""")
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = read_table(spark, sf_dir, "embeddings").select("vec_id", label.alias("label"), "embedding")
    return hard_negatives(rows, F.col("vec_id") % 50 == 0)


@_query("op13_minhash", f"""
WITH RECURSIVE w AS (
    SELECT doc_id, coalesce(regexp_extract_all({_LOWER_TEXT.format("text")}, '[^\x20\x09-\x0D]+'), []::VARCHAR[]) AS w
    FROM documents),
s AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS shingle
    FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM w WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM s AS a JOIN s AS b USING (shingle) GROUP BY a.doc_id, b.doc_id),
links AS (
    SELECT a, b FROM common AS c JOIN sizes AS x ON x.doc_id = a JOIN sizes AS y ON y.doc_id = b
    WHERE 100 * c.n >= 85 * (x.n + y.n - c.n)),
reached AS (SELECT doc_id, doc_id AS other FROM w UNION SELECT r.doc_id, b FROM reached AS r JOIN links ON a = other),
least AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM least LEFT JOIN sizes USING (doc_id)""")
def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_groups(read_table(spark, sf_dir, "documents"))
