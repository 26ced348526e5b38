"""Queries over responses: parsing, checks, uniqueness, batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.formats import FormatSpec, built_in
from recordloom.functions.json_text import item_hash
from recordloom.functions.sizing import backoff_seconds
from recordloom.functions.text import strip_fences
from recordloom.operators import batches, dedup
from recordloom.operators.definitions import check_format_definitions
from recordloom.operators.responses import classify_responses, parse_responses, resolve_attempts
from recordloom.operators.validate import rejects, warn_items
from recordloom.plans.records import Records, records_from_responses, validated_items
from workloads.fixtures import CUSTOM, EVENT, FILE_TASKS, document_responses, event_responses, order_calls, part_definitions, table

Query = Callable[[SparkSession, str], DataFrame]


def _spec(name: str) -> FormatSpec:
    return CUSTOM if name == "note" else built_in(name)


def _records(spark: SparkSession, sf_dir: str, name: str) -> Records:
    return records_from_responses(document_responses(table(spark, sf_dir, "documents"), name), _spec(name))


def _event_records(spark: SparkSession, sf_dir: str) -> Records:
    return records_from_responses(event_responses(table(spark, sf_dir, "events")), EVENT)


def _validated(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        unique = _records(spark, sf_dir, name).unique
        return unique.select("batch_id", F.col("pos").cast("bigint").alias("pos"), *_spec(name).field_names, "hash")

    return run


def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected items by format and reason."""
    documents = table(spark, sf_dir, "documents")
    counted = [
        rejects(validated_items(document_responses(documents, name), _spec(name)))
        .select(F.lit(name).alias("format"), F.explode("reasons").alias("reason"))
        .groupBy("format", "reason")
        .agg(F.count("*").alias("items"))
        for name in ("pair-class", "pair-score")
    ]
    return counted[0].unionByName(counted[1])


def item_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept items by warning."""
    validated = validated_items(document_responses(table(spark, sf_dir, "documents"), "qa"), built_in("qa"))
    return warn_items(validated).groupBy("warning").agg(F.count("*").alias("items"))


def response_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status of calls made up from orders."""
    calls = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "O", F.col("o_orderpriority"))
        .when(F.col("o_orderstatus") == "F", F.lit(" \n "))
        .alias("content"),
        F.when(F.col("o_custkey") % 3 == 0, F.lit("SAFETY")).otherwise(F.lit("STOP")).alias("finish_reason"),
        F.when(F.col("o_orderkey") % 7 == 0, F.lit("timeout")).alias("error"),
    )
    return classify_responses(calls).select("o_orderkey", "status")


def attempts_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deciding call of each batch of calls made up from orders."""
    decided = resolve_attempts(order_calls(table(spark, sf_dir, "orders")), max_retries=2)
    return decided.select(
        "batch_id",
        F.col("attempt").cast("bigint").alias("attempt"),
        F.col("call").cast("bigint").alias("call"),
        "status",
        "parse_status",
        "outcome",
    )


def backoff_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Waiting time for an event's value as the delay and one of five retries."""
    retry = F.col("event_id") % 5 + 1
    return table(spark, sf_dir, "events").select(
        "event_id", retry.alias("retry"), backoff_seconds(retry, F.col("value")).alias("seconds")
    )


def fence_stripped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts put in fences of several kinds and taken out again."""
    way, text = F.col("doc_id") % 5, F.col("text")
    wrapped = (
        F.when(way == 0, F.concat(F.lit("```json\n"), text, F.lit("\n```")))
        .when(way == 1, F.concat(F.lit(" ```"), text, F.lit("```\n")))
        .when(way == 2, F.concat(F.lit("  \n"), text, F.lit("\t ")))
        .when(way == 3, F.concat(F.lit("```json\n"), text))
        .otherwise(F.concat(text, F.lit("\n```")))
    )
    fenced = table(spark, sf_dir, "documents").select("doc_id", wrapped.alias("fenced"))
    stripped = fenced.select("doc_id", F.expr(strip_fences("fenced")).alias("inner"))
    return stripped.select("doc_id", F.length("inner").cast("bigint").alias("chars"), F.md5("inner").alias("inner_md5"))


def response_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What responses of several kinds parse to."""
    way, text = F.col("doc_id") % 7, F.col("text")
    record = F.to_json(F.struct("source", "text"))
    responses = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.when(way == 0, F.concat(F.lit("["), record, F.lit(","), record, F.lit("]")))
        .when(way == 1, record)
        .when(way == 2, F.concat(F.lit("["), record, F.lit("]]")))
        .when(way == 3, F.concat(F.lit("{"), text, F.lit("}")))
        .when(way == 4, F.lit("null"))
        .when(way == 5, F.col("n_chars").cast("string"))
        .otherwise(F.lit("```json\n[]\n```"))
        .alias("content"),
    )
    return parse_responses(responses).select("doc_id", "parse_status", F.size("items").cast("bigint").alias("n_items"))


def item_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Content hash of documents as records with a text, a number and a fraction."""
    columns = {
        "text": ("text", "string"),
        "lang": ("lang", "string"),
        "n_chars": ("n_chars", "integer"),
        "share": ("n_chars / 8.0D", "float"),
        "long": ("n_chars > 2000", "boolean"),
    }
    return table(spark, sf_dir, "documents").select("doc_id", F.expr(item_hash(columns)).alias("hash"))


def _hashed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.floor(F.col("doc_id") / 25).alias("batch_id"),
        (F.col("doc_id") % 25).alias("pos"),
        "doc_id",
        "source",
        F.expr(item_hash({"text": ("text", "string")})).alias("hash"),
    )


def dedup_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First document of each text."""
    return dedup.dedup_first(_hashed_documents(spark, sf_dir)).select("doc_id", "source", "hash")


def first_n_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 500 texts in arrival order."""
    firsts = dedup.dedup_first(_hashed_documents(spark, sf_dir))
    return dedup.cap_unique(firsts, 500).select("doc_id", "hash")


def first_half_per_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each source's unique texts, as many as half its documents, in arrival order."""
    documents = _hashed_documents(spark, sf_dir)
    firsts = dedup.dedup_first(documents, ["source", "hash"])
    wanted = documents.groupBy("source").agg(F.floor(F.count("*") / 2).alias("wanted"))
    return dedup.cap_unique(firsts, F.col("wanted"), ["source"], wanted).select("source", "doc_id")


SUMMARY = ("batch_id", "valid", "skipped", "new_unique", "duplicates")


def batch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(spark, sf_dir, "qa").summary().select(*SUMMARY, "stagnant")


def batch_summary_to_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event batches up to the one that brings the 300th unique record."""
    return _event_records(spark, sf_dir).summary(300).select(*SUMMARY)


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.run_summary(_records(spark, sf_dir, "pair-score").summary())


def stagnant_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event batches that brought nothing new."""
    return batches.stagnant_batches(_event_records(spark, sf_dir).summary()).select("batch_id", "valid", "duplicates")


def batch_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unique records before each event batch."""
    summary = _event_records(spark, sf_dir).summary().select("batch_id", "new_unique")
    return batches.batch_offsets(summary).select("batch_id", "new_unique", "item_offset")


def _event_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = F.when(F.col("event_type") == "error", F.lit(0)).otherwise(F.lit(1))
    return table(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("batch_id"), valid.alias("valid"))


def failure_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length of the run of error events each event ends, over all events as one run."""
    return batches.consecutive_failures(_event_outcomes(spark, sf_dir)).select("batch_id", "consecutive_failures")


def failure_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First event of each user that ends a run of three errors."""
    return batches.failure_cutoff(_event_outcomes(spark, sf_dir), 2, ["user_id"])


def _sparse_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as batches of few, large groups, whose numbers lie far apart and in no order."""
    number = F.expr("(o_orderkey * 2654435761) % 2305843009213693951")
    orders = table(spark, sf_dir, "orders")
    return orders.select(F.col("o_orderstatus").alias("run"), number.alias("batch_id"), (F.col("o_custkey") % 7).alias("new_unique"))


def batch_offsets_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unique records before each batch of its run; batch numbers are sparse, and a run may hold half of all."""
    return batches.batch_offsets(_sparse_batches(spark, sf_dir), ["run"])


def failure_runs_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches in a row without a record, in order of sparse numbers."""
    made = _sparse_batches(spark, sf_dir).select("run", "batch_id", F.when(F.col("new_unique") > 4, 1).otherwise(0).alias("valid"))
    return batches.consecutive_failures(made, ["run"]).select("run", "batch_id", "consecutive_failures")


def preview_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    preview = dedup.preview(_records(spark, sf_dir, "qa").unique, built_in("qa"))
    return preview.select("batch_id", F.col("pos").cast("bigint").alias("pos"), "preview")


def format_definition_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings about the definitions made up from parts."""
    # a small file, which one task would read, makes much work
    parts = table(spark, sf_dir, "part").repartition(spark.sparkContext.defaultParallelism * FILE_TASKS, "p_partkey")
    return check_format_definitions(part_definitions(parts))


QUERIES: dict[str, Query] = {
    "validated_qa": _validated("qa"),
    "validated_pair_class": _validated("pair-class"),
    "validated_pair_score": _validated("pair-score"),
    "validated_pair": _validated("pair"),
    "validated_triplet": _validated("triplet"),
    "validated_custom": _validated("note"),
    "reject_reasons": reject_reasons,
    "item_warnings": item_warnings,
    "response_status": response_status,
    "attempts_resolved": attempts_resolved,
    "backoff_schedule": backoff_schedule,
    "fence_stripped": fence_stripped,
    "response_kind": response_kind,
    "item_hashes": item_hashes,
    "dedup_documents": dedup_documents,
    "first_n_unique": first_n_unique,
    "first_half_per_source": first_half_per_source,
    "batch_summary": batch_summary,
    "batch_summary_to_target": batch_summary_to_target,
    "run_summary": run_summary,
    "stagnant_batches": stagnant_batches,
    "batch_offsets": batch_offsets,
    "failure_runs": failure_runs,
    "batch_offsets_sparse": batch_offsets_sparse,
    "failure_runs_sparse": failure_runs_sparse,
    "failure_cutoff": failure_cutoff,
    "preview_rows": preview_rows,
    "format_definition_errors": format_definition_errors,
}

# ---------------------------------------------------------------------------------------------------
# The same results in SQL.

SPARSE = """sparse AS (
  SELECT o_orderstatus AS run, (o_orderkey * 2654435761) % 2305843009213693951 AS batch_id, o_custkey % 7 AS new_unique FROM orders
)"""

ITEMS = """
items AS (
  SELECT doc_id, text, lang, source, doc_id % 20 AS defect, (doc_id * 2 + ahead) // 50 AS batch_id,
         row_number() OVER (PARTITION BY (doc_id * 2 + ahead) // 50 ORDER BY doc_id * 2 + ahead) - 1 AS pos
  FROM (SELECT *, unnest(CASE WHEN doc_id % 10 = 0 THEN [0, 11] ELSE [0] END) AS ahead FROM documents)
),
parsed AS (SELECT * FROM items WHERE batch_id % 8 NOT IN (6, 7))"""

SQL_FIELDS = {
    "qa": {
        "context": "CASE WHEN defect = 17 THEN '  ' ELSE text END",
        "question": "'About ' || lang || '?'",
        "answer": "source",
    },
    "pair-class": {
        "premise": "CASE WHEN defect = 17 THEN '  ' ELSE text END",
        "hypothesis": "lang",
        "label": "CASE WHEN defect = 15 THEN (doc_id // 20 % 2 = 0)::BIGINT ELSE doc_id % 3 END",
    },
    "pair-score": {
        "sentence1": "CASE WHEN defect = 17 THEN '  ' ELSE text END",
        "sentence2": "lang",
        "score": "CASE WHEN defect = 19 THEN 1.0::DOUBLE WHEN defect = 15 THEN (doc_id // 20 % 2 = 0)::BIGINT::DOUBLE ELSE (doc_id % 101)::DOUBLE / 100.0::DOUBLE END",
    },
    "pair": {"anchor": "CASE WHEN defect = 17 THEN '  ' ELSE text END", "positive": "lang"},
    "triplet": {
        "anchor": "CASE WHEN defect = 17 THEN '  ' ELSE text END",
        "positive": "lang",
        "negative": "source",
    },
    "note": {
        "id": "doc_id",
        "text": "CASE WHEN defect = 17 THEN '  ' ELSE text END",
        "score": "CASE WHEN defect = 19 THEN 1.0::DOUBLE WHEN defect = 15 THEN (doc_id // 20 % 2 = 0)::BIGINT::DOUBLE ELSE (doc_id % 101)::DOUBLE / 100.0::DOUBLE END",
        "verified": "CASE WHEN defect = 3 THEN NULL ELSE doc_id % 2 = 0 END",
    },
}

SQL_DEFECTS = {"pair-class": "3, 7, 11", "pair-score": "3, 7, 11", "note": "7, 11"}


def _valid_cte(name: str) -> str:
    fields = ", ".join(f"{expression} AS {field}" for field, expression in SQL_FIELDS[name].items())
    return f"""WITH {ITEMS},
valid AS (SELECT batch_id AS b, pos AS p, {fields} FROM parsed WHERE defect NOT IN ({SQL_DEFECTS.get(name, '3, 7')})),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY {', '.join(SQL_FIELDS[name])} ORDER BY b, p) AS rank FROM valid
)"""


def _validated_sql(name: str) -> str:
    names = list(SQL_FIELDS[name])
    pairs = ", ".join(f"'{n}': {n}" for n in sorted(names))
    return f"""{_valid_cte(name)}
SELECT b AS batch_id, p AS pos, {', '.join(names)}, md5(to_json({{{pairs}}})::VARCHAR) AS hash
FROM ranked WHERE rank = 1"""


EVENT_SUMMARY = """
items AS (
  SELECT event_id // 10 AS batch_id, event_id AS id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
         event_type IN ('click', 'view', 'purchase', 'signup') AS ok
  FROM events
),
ranked AS (
  SELECT *, ok AND row_number() OVER (PARTITION BY event_type, k ORDER BY id) = 1 AS is_new FROM items
),
summary AS (
  SELECT batch_id, count(*) FILTER (ok) AS valid, count(*) FILTER (NOT ok) AS skipped,
         count(*) FILTER (is_new) AS new_unique
  FROM ranked GROUP BY batch_id
)"""

ORACLES: dict[str, str] = {
    "validated_qa": _validated_sql("qa"),
    "validated_pair_class": _validated_sql("pair-class"),
    "validated_pair_score": _validated_sql("pair-score"),
    "validated_pair": _validated_sql("pair"),
    "validated_triplet": _validated_sql("triplet"),
    "validated_custom": _validated_sql("note"),
    "reject_reasons": f"""WITH {ITEMS}
SELECT format, reason, count(*) AS items
FROM parsed JOIN (VALUES
  ('pair-class', 3, 'missing:label'), ('pair-class', 7, 'wrong_type:label'), ('pair-class', 11, 'constraint:label'),
  ('pair-score', 3, 'missing:score'), ('pair-score', 7, 'wrong_type:score'), ('pair-score', 11, 'constraint:score')
) AS r(format, defect, reason) USING (defect)
GROUP BY format, reason""",
    "item_warnings": f"""WITH {ITEMS}
SELECT warning, count(*) AS items
FROM parsed JOIN (VALUES (13, 'extra:note'), (17, 'blank:context')) AS w(defect, warning) USING (defect)
GROUP BY warning""",
    "response_status": """SELECT o_orderkey,
  CASE WHEN o_orderkey % 7 = 0 THEN 'ERROR' WHEN o_orderstatus = 'O' THEN 'OK'
       WHEN o_custkey % 3 = 0 THEN 'SAFETY' ELSE 'EMPTY' END AS status
FROM orders""",
    "attempts_resolved": """WITH calls AS (
  SELECT o_orderkey // 6 AS batch_id, o_orderkey % 6 AS place, o_orderstatus AS s, o_custkey AS c FROM orders
), judged AS (
  SELECT batch_id, place,
    CASE WHEN place < 2 THEN 1 WHEN place = 2 THEN 2 ELSE 3 END AS attempt,
    CASE WHEN place IN (0, 2, 3) THEN 1 WHEN place IN (1, 4) THEN 2 ELSE 3 END AS call,
    CASE WHEN place IN (0, 3, 4) AND c % 3 = 0 THEN 'ERROR'
         WHEN place IN (0, 3, 4) THEN 'EMPTY'
         WHEN s IN ('O', 'P') OR place = 2 THEN 'OK'
         WHEN place = 1 THEN 'SAFETY' ELSE 'EMPTY' END AS status, s
  FROM calls
), decided AS (
  SELECT *, CASE WHEN status = 'OK' THEN CASE WHEN s = 'O' THEN 'PARSED' ELSE 'PARSE_ERROR' END END AS parse_status,
    CASE WHEN status = 'OK' AND s = 'O' THEN 'SUCCEEDED'
         WHEN status = 'SAFETY' OR place = 5 THEN 'FAILED' END AS outcome
  FROM judged
)
SELECT batch_id, attempt::BIGINT AS attempt, call::BIGINT AS call, status, parse_status, outcome
FROM decided WHERE outcome IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY batch_id ORDER BY place) = 1""",
    "backoff_schedule": """SELECT event_id, event_id % 5 + 1 AS retry, value * power(2.0::DOUBLE, event_id % 5) AS seconds
FROM events""",
    "fence_stripped": """SELECT doc_id, length(body)::BIGINT AS chars, md5(body) AS inner_md5 FROM (
  SELECT doc_id, CASE WHEN doc_id % 5 IN (0, 1, 2) THEN text WHEN doc_id % 5 = 3 THEN '```json' || chr(10) || text
                      ELSE text || chr(10) || '```' END AS body
  FROM documents)""",
    "response_kind": """SELECT doc_id,
  CASE doc_id % 7 WHEN 0 THEN 'PARSED' WHEN 1 THEN 'PARSED' WHEN 2 THEN 'PARSE_ERROR' WHEN 3 THEN 'PARSE_ERROR'
                  WHEN 4 THEN 'NOT_A_LIST' WHEN 5 THEN 'NOT_A_LIST' ELSE 'PARSED' END AS parse_status,
  (CASE doc_id % 7 WHEN 0 THEN 2 WHEN 1 THEN 1 WHEN 6 THEN 0 END)::BIGINT AS n_items
FROM documents""",
    "item_hashes": """SELECT doc_id, md5(to_json({'lang': lang, 'long': n_chars > 2000, 'n_chars': n_chars,
  'share': n_chars::DOUBLE / 8.0::DOUBLE, 'text': text})::VARCHAR) AS hash
FROM documents""",
    "dedup_documents": """SELECT doc_id, source, md5(to_json({'text': text})::VARCHAR) AS hash
FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1""",
    "first_n_unique": """SELECT doc_id, md5(to_json({'text': text})::VARCHAR) AS hash FROM (
  SELECT doc_id, text FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1)
ORDER BY doc_id LIMIT 500""",
    "first_half_per_source": """WITH firsts AS (
  SELECT doc_id, source FROM documents QUALIFY row_number() OVER (PARTITION BY source, text ORDER BY doc_id) = 1
), wanted AS (SELECT source, count(*) // 2 AS wanted FROM documents GROUP BY source)
SELECT source, doc_id FROM firsts JOIN wanted USING (source)
QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= wanted""",
    "batch_summary": f"""{_valid_cte('qa')}
SELECT batch_id, valid, skipped, new_unique, valid - new_unique AS duplicates, valid > 0 AND new_unique = 0 AS stagnant
FROM (
  SELECT i.batch_id, count(*) FILTER (i.batch_id % 8 NOT IN (6, 7) AND i.defect NOT IN (3, 7)) AS valid,
         count(*) FILTER (i.batch_id % 8 NOT IN (6, 7) AND i.defect IN (3, 7)) AS skipped,
         count(*) FILTER (r.rank = 1) AS new_unique
  FROM items i LEFT JOIN ranked r ON r.b = i.batch_id AND r.p = i.pos
  GROUP BY i.batch_id)""",
    "batch_summary_to_target": f"""WITH {EVENT_SUMMARY},
reached AS (SELECT id FROM ranked WHERE is_new ORDER BY id LIMIT 1 OFFSET 299)
SELECT batch_id, count(*) FILTER (ok) AS valid, count(*) FILTER (NOT ok) AS skipped,
       count(*) FILTER (is_new AND id <= cut) AS new_unique, count(*) FILTER (ok AND NOT is_new AND id <= cut) AS duplicates
FROM ranked, (SELECT coalesce(max(id), 9223372036854775807) AS cut FROM reached)
WHERE batch_id <= cut // 10
GROUP BY batch_id""",
    "run_summary": f"""{_valid_cte('pair-score')}
SELECT (SELECT count(*) FROM ranked WHERE rank = 1) AS unique_records, count(*) FILTER (valid > 0) AS successful_batches,
       count(*) FILTER (valid = 0) AS failed_batches
FROM (SELECT i.batch_id, count(r.b) AS valid FROM items i LEFT JOIN ranked r ON r.b = i.batch_id AND r.p = i.pos
      GROUP BY i.batch_id)""",
    "stagnant_batches": f"""WITH {EVENT_SUMMARY}
SELECT batch_id, valid, valid AS duplicates FROM summary WHERE valid > 0 AND new_unique = 0""",
    "batch_offsets": f"""WITH {EVENT_SUMMARY}
SELECT batch_id, new_unique, CAST(coalesce(sum(new_unique) OVER (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING
       AND 1 PRECEDING), 0) AS BIGINT) AS item_offset
FROM summary""",
    "batch_offsets_sparse": f"""WITH {SPARSE}
SELECT run, batch_id, new_unique, coalesce(sum(new_unique) OVER (PARTITION BY run ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS item_offset
FROM sparse""",
    "failure_runs_sparse": f"""WITH {SPARSE}, numbered AS (
  SELECT run, batch_id, new_unique > 4 AS good, row_number() OVER (PARTITION BY run ORDER BY batch_id) AS place FROM sparse
)
SELECT run, batch_id, (place - coalesce(max(CASE WHEN good THEN place END) OVER (PARTITION BY run ORDER BY batch_id), 0))::BIGINT AS consecutive_failures
FROM numbered""",
    "failure_runs": """SELECT event_id AS batch_id, n - coalesce(max(CASE WHEN event_type <> 'error' THEN n END)
       OVER (ORDER BY event_id), 0) AS consecutive_failures
FROM (SELECT *, row_number() OVER (ORDER BY event_id) AS n FROM events)""",
    "failure_cutoff": """SELECT user_id, min(event_id) AS stop_batch FROM (
  SELECT user_id, event_id, n - coalesce(max(CASE WHEN event_type <> 'error' THEN n END)
         OVER (PARTITION BY user_id ORDER BY event_id), 0) AS run
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events))
WHERE run >= 3 GROUP BY user_id""",
    "preview_rows": f"""{_valid_cte('qa')}
SELECT b AS batch_id, p AS pos,
  '{{' || chr(10) || '  "context": ' || to_json(context)::VARCHAR || ',' || chr(10) || '  "question": '
  || to_json(question)::VARCHAR || ',' || chr(10) || '  "answer": ' || to_json(answer)::VARCHAR || chr(10) || '}}' AS preview
FROM ranked WHERE rank = 1 ORDER BY b, p LIMIT 3""",
    "format_definition_errors": """SELECT 'part-' || p_partkey || '.json' AS file, field, severity, reason
FROM part JOIN (VALUES
  (0, NULL, 'error', 'invalid_json'), (1, NULL, 'error', 'root_not_an_object'),
  (2, NULL, 'error', 'fields_not_an_object'), (3, NULL, 'error', 'fields_empty'),
  (4, NULL, 'error', 'fields_not_an_object'), (5, 'size', 'error', 'field_not_an_object'),
  (6, 'size', 'error', 'invalid_type'), (7, 'size', 'error', 'invalid_description'),
  (8, 'size', 'error', 'invalid_required'), (9, 'size', 'warning', 'example_type'),
  (10, 'size', 'error', 'invalid_type'), (10, 'size', 'error', 'invalid_description'),
  (10, 'size', 'error', 'invalid_required')
) AS f(way, field, severity, reason) ON p_partkey % 12 = way""",
}
