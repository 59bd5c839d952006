"""The registered queries of this package: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streambed.llm import (
    bpe,
    common,
    decontaminate,
    fill_middle,
    html_text,
    line_dedup,
    neighbours,
    packing,
    secrets,
    simhash,
    toxicity,
    url_filter,
    vector_codes,
    warc,
)
from streambed.session import run_folder


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = packing.pack(common.table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(common.table(spark, sf_dir, "pages"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(common.table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hexadecimal("fingerprint").alias("fingerprint"), "component_id")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with a benchmark passage, a row per document and item."""
    return decontaminate.overlaps(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the text that is left and the number of lines deleted from it."""
    found = line_dedup.remove_repeated(common.table(spark, sf_dir, "documents"), removed_col="removed_lines")
    return found.select("doc_id", "text", "n_chars", "removed_lines")


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find(common.table(spark, sf_dir, "documents"))
    base = F.filter("findings", lambda x: x["kind"] != "model")
    count = lambda kind: F.size(F.filter("findings", lambda x: x["kind"] == kind)).cast("long")
    spelled = lambda listed: F.array_join(
        F.transform(listed, lambda x: F.concat_ws(":", x["kind"], x["start"], x["stop"])), ","
    )
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(spelled(base), 256).alias("base_sha256"),
        spelled(F.col("findings")).alias("spans"),
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    model = toxicity.fit(docs, common.table(spark, sf_dir, "labels"), remainder != 2)
    return docs.select(
        "doc_id",
        F.coalesce(remainder == 2, F.lit(False)).alias("held_out"),
        toxicity.score(model, docs, F.col("text")).alias("score"),
    ).withColumn("predicted", (F.col("score") >= toxicity.DEFAULT_THRESHOLD).cast("int"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written below the shared folder and read back; the driver's JVM removes the folder at its end."""
    folder = run_folder(spark, "warc")
    index = warc.write_archives(common.table(spark, sf_dir, "pages"), folder)
    common.remove_at_end(spark, folder)
    return warc.read_records(index).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


OP8_SQL = """
WITH digests AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex
  FROM pages
), spelled AS (
  SELECT *, list_aggregate(list_transform(range(0, 8), lambda g: list_aggregate(list_transform([15, 10, 5, 0],
    lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      ((('0x' || substr(hex, (5 * g + 1)::BIGINT, 5))::BIGINT >> s) & 31)::BIGINT + 1, 1)),
    'string_agg', '')), 'string_agg', '') AS payload_digest,
    max(page_id) OVER (PARTITION BY hex) AS response_id
  FROM digests
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = response_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = response_id THEN NULL ELSE response_id END AS refers_to
FROM spelled
"""

def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = common.table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.where("vec_id % 50 = 0"), k=5)


# The rules that op10 judges by: host, path, verdict.
OP10_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ", ".join(str(rule) for rule in OP10_RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {rows} AS rules(host, path, verdict)")
    return url_filter.judge(common.table(spark, sf_dir, "pages"), rules)


OP10_SQL = f"""
WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES {", ".join(str(rule) for rule in OP10_RULES)}),
rests AS (
  SELECT page_id, row_number() OVER () AS n,
    CASE WHEN url LIKE '%://%' THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), urls AS (
  SELECT page_id, n,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rests
), fits AS (
  SELECT n, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
    arg_max(rule_verdict, length(rule_host || rule_path)) AS rule_verdict
  FROM urls JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY n
)
SELECT page_id, host, path, rule, coalesce(rule_verdict, 'allow') AS verdict FROM urls LEFT JOIN fits USING (n)
"""



def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, and the text decoded from them again."""
    found = bpe.encode(common.table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(bpe.decode(F.col("ids")), 256).alias("decoded_sha256"),
    )


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, _ = vector_codes.compress(common.table(spark, sf_dir, "embeddings"))
    return vector_codes.label_errors(coded).select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def _op12_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """All distances in every round, one row per component; for vectors of one length."""

    def nearest(k: int) -> str:
        return f"""found{k} AS MATERIALIZED (
  SELECT n, part, arg_min(entry, [d, entry]) AS entry, min(d) AS d FROM (
    SELECT n, part, entry, sum((x - c) * (x - c))::BIGINT AS d FROM ints JOIN book{k} USING (part, place)
    GROUP BY n, part, entry
  ) GROUP BY n, part
)"""

    def moved(k: int) -> str:
        return f"""book{k + 1} AS MATERIALIZED (
  SELECT part, entry, place, coalesce(mean, c) AS c FROM book{k} LEFT JOIN (
    SELECT part, entry, place, (sum(x)::BIGINT - (((sum(x)::BIGINT % count(*)) + count(*)) % count(*))) // count(*) AS mean
    FROM found{k} JOIN ints USING (n, part) GROUP BY part, entry, place
  ) USING (part, entry, place)
)"""

    steps = [step for k in range(rounds) for step in (nearest(k), moved(k))]
    return f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) - 1 AS n, vec_id, label, embedding FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), places AS (
  SELECT n, unnest(range(0, len(embedding))) AS spot, unnest(embedding) AS v, len(embedding) // {parts} AS width FROM kept
), ints AS MATERIALIZED (
  SELECT n, spot // width AS part, spot % width AS place, floor(v::DOUBLE * 4096)::BIGINT AS x FROM places
), book0 AS MATERIALIZED (
  SELECT part, n AS entry, place, x AS c FROM ints WHERE n < {entries}
), {", ".join([*steps, nearest(rounds)])}, sums AS (
  SELECT n, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error
  FROM found{rounds} GROUP BY n
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY part, entry, place)) FROM book{rounds}) AS codebooks_sha256
FROM kept JOIN sums USING (n)
"""


OP12_SQL = _op12_sql()


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fill_middle.transform(common.table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_middle.restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


OP13_SQL = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || doc_id::VARCHAR) AS digest,
    regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS lines
  FROM documents
), draws AS (
  SELECT doc_id, text, lines, len(lines) AS n,
    ('0x' || substr(digest, 1, 8))::BIGINT % (len(lines) + 1) AS c1,
    ('0x' || substr(digest, 9, 8))::BIGINT % (len(lines) + 1) AS c2,
    ('0x' || substr(digest, 17, 8))::BIGINT % 100 AS c3,
    ('0x' || substr(digest, 25, 8))::BIGINT % 100 AS c4
  FROM units
), cuts AS (
  SELECT doc_id, text, n,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR c3 >= 100
      THEN 'plain' WHEN c4 < 50 THEN 'spm' ELSE 'psm' END AS form,
    coalesce(array_to_string(lines[1:least(c1, c2)], ''), '') AS prefix,
    coalesce(array_to_string(lines[least(c1, c2) + 1:greatest(c1, c2)], ''), '') AS middle,
    coalesce(array_to_string(lines[greatest(c1, c2) + 1:], ''), '') AS suffix
  FROM draws
)
SELECT doc_id, n::BIGINT AS n, form,
  CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text
    WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM cuts
"""

REGISTRY = {
    "op1_packing": op1_packing,
    "op2_html_text": op2_html_text,
    "op3_simhash": op3_simhash,
    "op4_decontaminate": op4_decontaminate,
    "op5_line_dedup": op5_line_dedup,
    "op6_secrets": op6_secrets,
    "op7_toxicity": op7_toxicity,
    "op8_warc": op8_warc,
    "op9_neighbours": op9_neighbours,
    "op10_url_filter": op10_url_filter,
    "op11_bpe": op11_bpe,
    "op12_vector_codes": op12_vector_codes,
    "op13_fill_middle": op13_fill_middle,
}

SQL = {
    "op8_warc": OP8_SQL,
    "op10_url_filter": OP10_SQL,
    "op12_vector_codes": OP12_SQL,
    "op13_fill_middle": OP13_SQL,
}
