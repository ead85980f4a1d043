"""The registered queries of the text operators, with production parameters, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.llm import conversation, exact_dedup, mixing, near_dedup, personal_data, quality, sharding, sp_codec, spelling, substring_dedup, token_cache, toxicity, warc
from cardlake.llm.common import scratch_path

HELD_OUT_FOLD, FOLDS = 2, 4
TOXIC_SCORE = 0.3
TOKEN_LIMIT = 2048


def _read(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def held_out(doc_id="doc_id"):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == HELD_OUT_FOLD


def op1_toxicity_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir)
    labels = _read(spark, sf_dir, "labels").where(~held_out())
    model = toxicity.fit(toxicity.train_sample(docs, labels))
    return toxicity.score_documents(docs, model).select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= TOXIC_SCORE).cast("int").alias("predicted"), "offending")


def op2_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_read(spark, sf_dir))


def op3_radix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_read(spark, sf_dir)).drop("row")


def op4_rabin_karp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(_read(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op5_prefix_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return sp_codec.round_trip(_read(spark, sf_dir), model).select(
        F.col("row.doc_id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"), "ids",
        F.sha2("bytes", 256).alias("decoded_sha256"))


def op6_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archive(_read(spark, sf_dir, "pages"), path)
    return checked_records(warc.read_archive(spark, path))


def checked_records(records: DataFrame) -> DataFrame:
    """The contract columns of archive records. Every row's record is rebuilt and its payload checked
    against the header's digest; a record that fails either fails the query."""
    tail = F.concat(F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b"")), F.lit(b"\r\n\r\n"))
    whole = F.coalesce(F.col("verified") & F.expr("startswith(record, cast('WARC/1.1' as binary))") & F.endswith("record", tail), F.lit(False))
    return records.select(
        "page_id", F.length("payload").cast("long").alias("payload_bytes"),
        F.when(whole, F.col("payload_digest")).otherwise(F.raise_error(F.lit("a record of the archive is not whole"))).alias("payload_digest"),
        "record_type", "refers_to")


def op7_prefix_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(_read(spark, sf_dir), 8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


def op8_token_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_cache.token_counts(_read(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"),
                                      scratch_path(spark, "token-cache"))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op9_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    graded = quality.apply_policy(quality.rule_ledger(_read(spark, sf_dir)))
    return graded.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", "failed")


def op10_cube_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_read(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op11_rank_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = _read(spark, sf_dir, "conversations")
    return conversation.repair_reports(conversation.damaged(conversations), conversations.select("conv_id")).withColumnRenamed("conv", "conv_id")


def op12_span_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.find_spans(_read(spark, sf_dir)).withColumn("base", F.filter("spans", lambda x: x["base"]))

    def count(kind: str):
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in personal_data.KINDS[:4]]
    return found.select("row.doc_id", *counts, F.sha2(personal_data.span_text(F.col("base")), 256).alias("base_sha256"),
                        personal_data.span_text(F.col("spans")).alias("spans"))


def op13_gram_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = spelling.runs(_read(spark, sf_dir))
    return spelling.variants(spelling.count_words(runs.select(spelling.misspelt(F.col("run"), F.col("doc_id")).alias("word"))))


QUERIES = {f.__name__: f for f in (
    op1_toxicity_mil, op2_chosen_path, op3_radix_dedup, op4_rabin_karp, op5_prefix_viterbi, op6_warc_archive,
    op7_prefix_shards, op8_token_cache, op9_rule_ledger, op10_cube_mix, op11_rank_viterbi, op12_span_rules, op13_gram_variants)}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"



def _span_sql() -> str:
    """The spans of personal data: each proposal's matches and the pieces between them give offsets and context."""
    digits = "regexp_replace(hit, '[^0-9]', '', 'g')"
    luhn = (f"list_sum(list_transform(range(length({digits})), lambda i: CASE WHEN i % 2 = 0 THEN CAST({digits}[length({digits}) - i] AS INT) "
            f"ELSE CAST('0246813579'[CAST({digits}[length({digits}) - i] AS INT) + 1] AS INT) END)) % 10 = 0")
    account = "replace(hit, ' ', '')"
    moved = f"string_split({account}[5:] || {account}[:4], '')"
    rest = f"list_reduce(list_prepend(0, list_transform({moved}, lambda c: ascii(c))), lambda a, c: CASE WHEN c < 58 THEN (a * 10 + c - 48) % 97 ELSE (a * 100 + c - 55) % 97 END)"
    valid = {"email": "true", "tel": "true", "ip": f"regexp_matches(hit, '{personal_data.IP_VALID}')",
             "card": f"length({digits}) BETWEEN 14 AND 19 AND {luhn}", "phone": f"length({digits}) BETWEEN 10 AND 15",
             "iban": f"length({account}) BETWEEN 15 AND 34 AND {rest} = 1", "ssn": f"NOT regexp_matches(hit, '{personal_data.NOT_SSN}')"}
    parts = []
    for n, p in enumerate(personal_data.PROPOSALS):
        pattern = {"card": p.plain.replace("+", "{13,}") if p.base else "[0-9]{14,}"}.get(p.kind, p.plain)
        edges = f"AND NOT regexp_matches(before, '[{p.edge}]$') AND NOT regexp_matches(after, '^[{p.edge}]')" if p.edge else ""
        parts.append(f"""
  SELECT r, {n} AS proposal, {personal_data.KINDS.index(p.kind)} AS rank, '{p.kind}' AS kind, {p.level} AS level, {str(p.base).lower()} AS base, start, stop,
         {valid[p.kind]} {edges} AS fine,
         {p.confidence} + CASE WHEN regexp_matches(near, '{personal_data.near_words(p.words)}') THEN {personal_data.CONTEXT_BONUS} ELSE 0 END
           - CASE WHEN regexp_matches(near, '{personal_data.near_words(personal_data.AGAINST)}') THEN {personal_data.AGAINST_MALUS} ELSE 0 END AS score
  FROM (SELECT *, translate(before || '#' || after, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS near
        FROM (SELECT r, hit, stop - length(hit) AS start, stop, right(piece, {personal_data.NEAR_BEFORE}) AS before, left(following, {personal_data.NEAR_AFTER}) AS after
              FROM (SELECT *, sum(length(piece) + length(hit)) OVER (PARTITION BY r ORDER BY i) AS stop
                    FROM (SELECT r, i, hits[i] AS hit, pieces[i] AS piece, pieces[i + 1] AS following
                          FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i
                                FROM (SELECT r, regexp_extract_all(t, '{pattern}') AS hits, string_split_regex(t, '{pattern}') AS pieces FROM d))))))""")
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
raw AS ({" UNION ALL ".join(parts)}),
f AS (SELECT * FROM raw WHERE fine AND (base OR score >= {personal_data.THRESHOLD})),
s AS (SELECT *, {", ".join(f"max(CASE WHEN level < {n} THEN stop END) OVER ahead AS reach{n}, min(CASE WHEN level < {n} THEN start END) OVER behind AS onset{n}" for n in (1, 2))} FROM f
      WINDOW ahead AS (PARTITION BY r ORDER BY start, rank, stop, level ROWS UNBOUNDED PRECEDING),
             behind AS (PARTITION BY r ORDER BY start, rank, stop, level ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
k AS (SELECT r, start, rank, stop, base, kind, kind || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT) AS span FROM s
      WHERE CASE level WHEN 0 THEN true WHEN 1 THEN coalesce(reach1, 0) <= start AND coalesce(onset1, stop) >= stop
                 ELSE coalesce(reach2, 0) <= start AND coalesce(onset2, stop) >= stop END),
g AS (SELECT r, {", ".join(f"count(*) FILTER (base AND kind = '{kind}') AS n_{kind}" for kind in personal_data.KINDS[:4])},
             string_agg(span, ',' ORDER BY start, rank, stop) FILTER (base) AS base_spans, string_agg(span, ',' ORDER BY start, rank, stop) AS spans FROM k GROUP BY r)
SELECT doc_id, {", ".join(f"coalesce(n_{kind}, 0) AS n_{kind}" for kind in personal_data.KINDS[:4])}, sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (r)"""


ORACLE = {
    # crc32 byte by byte (the letters take one or two bytes); near words meet in what is left of them without one letter
    "op13_gram_variants": rf"""
WITH t AS (SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS crc),
r AS (SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{{{00C0}}}}-\x{{{{00FF}}}}]{{{{7,}}}}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
c AS (SELECT doc_id, run, count(*) AS n FROM r GROUP BY ALL),
b AS (SELECT *, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
             lambda ch: CASE WHEN unicode(ch) < 128 THEN [CAST(unicode(ch) AS BIGINT)] ELSE [192 + unicode(ch) // 64, 128 + unicode(ch) % 64] END)) AS bytes FROM c),
h AS (SELECT run, n, xor(list_reduce(list_prepend(4294967295, bytes), lambda a, x: xor(a // 256, crc[xor(a % 256, x) + 1])), 4294967295) AS h FROM b, t),
w AS (SELECT CASE WHEN h % 31 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, CAST(sum(n) AS BIGINT) AS n FROM h GROUP BY 1 HAVING length(word) >= 7 AND sum(n) >= 2),
d AS (SELECT word, n, p, word[:p - 1] || word[p + 1:] AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS p FROM w)),
pairs AS (SELECT a.word AS a, b.word AS b, b.n FROM d a JOIN d b ON a.p = b.p AND a.rest = b.rest AND a.word <> b.word
          UNION SELECT d.word, w.word, w.n FROM d JOIN w ON d.rest = w.word UNION SELECT w.word, d.word, d.n FROM d JOIN w ON d.rest = w.word),
best AS (SELECT a AS word, count(*) AS n_near, max(n) AS top FROM pairs GROUP BY a),
forms AS (SELECT a AS word, min(b) AS form FROM pairs JOIN best ON a = best.word AND pairs.n = top GROUP BY a),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 10 * w.n THEN form END AS form, CASE WHEN top >= 10 * w.n THEN top END AS form_n
      FROM w LEFT JOIN best USING (word) LEFT JOIN forms USING (word)),
way AS (SELECT word, word AS root FROM f UNION ALL SELECT way.word, f.form FROM way JOIN f ON way.root = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, way.root, f.n, f.n_near, f.form_n FROM f JOIN way USING (word) JOIN f AS last ON last.word = way.root AND last.form IS NULL""".replace("WITH t", "WITH RECURSIVE t").replace("{{", "{").replace("}}", "}"),
    "op12_span_rules": _span_sql(),
    "op2_chosen_path": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS sh FROM w),
flat AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS s FROM sets),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM flat a JOIN flat b ON a.s = b.s AND a.doc_id < b.doc_id
  GROUP BY 1, 2, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
links AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
reach AS (SELECT doc_id AS a, doc_id AS b FROM sets UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT s.doc_id, len(s.sh) AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept
FROM sets s JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = s.doc_id""",
    "op3_radix_dedup": r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS n FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY n) AS keep_id, count(*) OVER (PARTITION BY n) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY n) AS kept, sha256(n) AS text_sha256 FROM t""",
    "op4_rabin_karp": rf"""
WITH w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 49], ' ') AS k
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w WHERE len(ws) >= 50)),
firsts AS (SELECT k, min(doc_id) AS first_id FROM win GROUP BY k),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS j FROM win JOIN firsts USING (k) WHERE doc_id > first_id),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS j FROM w),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY j) AS text FROM words ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id)
SELECT w.doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)""",
    "op6_warc_archive": """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, strlen(coalesce(html, '')) AS n FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS newest FROM p)
SELECT page_id, n AS payload_bytes, sha1(h) AS payload_digest,
       CASE WHEN n >= 1000 AND page_id < newest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id < newest THEN newest END AS refers_to FROM g""",
    "op9_rule_ledger": rf"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t, {_WORDS} AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 2], ' ') AS k
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS c FROM win) WHERE c > 1),
rep AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM twice) GROUP BY doc_id),
m AS (
  SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
         len(lines) AS n_lines, length(regexp_replace(t, '[^A-Za-z]', '', 'g')) AS n_letters,
         length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper FROM w LEFT JOIN rep USING (doc_id)),
f AS (
  SELECT *, """ + "\n    + ".join(f"CASE WHEN {rule} THEN {quality.BIT[name]} ELSE 0 END" for name, rule in quality.RULES.items()) + rf""" AS bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (bits & {quality.policy_mask(quality.BASE_RULES)}) <> 0 AS base_failed,
       (bits & {quality.policy_mask(quality.BASE_RULES) | quality.policy_mask(quality.CURRENT_POLICY)}) = 0 AS kept, CAST(bits AS BIGINT) AS failed FROM f""",
}
