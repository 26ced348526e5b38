"""Queries over documents, pages and prompts."""

from __future__ import annotations

import sys
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.formats import built_in
from recordloom.functions.sizing import request_size
from recordloom.functions.text import clean_whitespace, is_web_url, output_name
from recordloom.operators import documents as docs
from recordloom.operators import prompts
from recordloom.sources.files import pages_to_docs, parquet_to_docs
from workloads.fixtures import CUSTOM, table

# The splitter goes to the executors as it is.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Query = Callable[[SparkSession, str], DataFrame]

CONTEXT_CHARS = 20_000
SHARD_DOCS = 100
CHUNK, OVERLAP = 1000, 200
NESTED_CHUNK, SEPARATORS = 400, ("\n\n", "\n", ". ", " ")
MARKUP = (
    "<p>caf&eacute; &Eacute; &euro;5 &frac12; &NotEqual; &thetasym; &#8212; &#x1F600; &#150; &#0; &amp;lt; &unknown; "
    "<style>p{}</style>&nbsp;<b>"
)


def request_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request size for each order: items still needed and batch size from its keys."""
    remaining, batch = F.col("o_custkey") + 1, F.col("o_orderkey") % 40 + 1
    return table(spark, sf_dir, "orders").select("o_orderkey", request_size(remaining, batch).alias("n_requested"))


def planned_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Next two requests per conversation: ten records per turn wanted, twelve had per answer."""
    turns = table(spark, sf_dir, "conversations")
    targets = turns.groupBy(F.col("conv_id").alias("target_id")).agg((F.count("*") * 10).alias("num_samples"))
    progress = (
        turns.where("role = 'assistant'")
        .groupBy(F.col("conv_id").alias("target_id"))
        .agg((F.count("*") * 12).alias("accepted"), F.count("*").alias("batches"))
    )
    return prompts.plan_requests(targets, progress, batch_size=8, batches_per_wave=2)


def query_prompt_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts for the turns of all conversations."""
    queries = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.col("text").alias("query"), (F.col("turn") + 5).alias("n_requested")
    )
    return prompts.query_prompts(queries, built_in("pair")).select("conv_id", "turn", "human")


def system_prompt_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """System prompt sent along with each turn."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn")
    return prompts.with_system_prompt(turns, CUSTOM)


def example_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Example structure shown with each benchmark query."""
    return table(spark, sf_dir, "benchmark").select("item_id", prompts.example_structure(CUSTOM).alias("example"))


def packed_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.pack_contexts(documents, CONTEXT_CHARS, "doc_id", SHARD_DOCS).select("doc_id", "shard", "context")


def filled_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in contexts that hold to their budget, two characters between documents; and what the contexts hold."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    placed = docs.fill_contexts(documents, CONTEXT_CHARS, "doc_id", SHARD_DOCS, between=2)
    return placed.select("doc_id", "piece", "shard", "context", F.md5("text").alias("text_md5"))


def nested_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks that end with paragraphs, else lines, sentences or words, as long as they may be."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.chunk_documents(documents, NESTED_CHUNK, separators=SEPARATORS)


def document_prompt_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts over packed documents, each with the whole texts."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = prompts.document_prompts(documents, built_in("pair"), 7, CONTEXT_CHARS, "doc_id", SHARD_DOCS)
    return rows.select("shard", "context", "n_documents", F.md5("human").alias("human_md5"))


def refined_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns, refined by the turn that follows."""
    turns = table(spark, sf_dir, "conversations")
    key = F.concat_ws("-", "conv_id", "turn").alias("key")
    before = F.concat_ws("-", "conv_id", F.col("turn") - 1).alias("key")
    queries = turns.select(key, F.col("text").alias("query"))
    refinements = turns.where("turn > 0").select(
        before,
        F.when(F.col("conv_id") % 5 == 0, F.lit(" \n")).otherwise(F.concat(F.lit("\n"), "text", F.lit(" "))).alias("refined"),
        F.when(F.col("conv_id") % 7 == 0, F.lit("timeout")).alias("error"),
    )
    return prompts.choose_refined_queries(queries, refinements, "key")


def output_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Output names for formats named after parts."""
    name = F.concat("p_name", F.lit("/é#"), "p_brand")
    return table(spark, sf_dir, "part").select(
        "p_partkey", output_name(F.lit("out/data"), name, F.col("p_size") % 2 == 0).alias("base_name")
    )


def page_urls_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether page URLs, and changed versions of them, are web URLs."""
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        is_web_url(url).alias("as_is"),
        is_web_url(F.concat(F.lit(" "), F.upper(url))).alias("upper_case"),
        is_web_url(F.regexp_replace(url, "^http", "ftp")).alias("other_scheme"),
        is_web_url(F.regexp_replace(url, "://[^/]*", "://")).alias("no_host"),
        is_web_url(F.when(F.col("page_id") % 2 == 0, url)).alias("half_null"),
    )


def page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visible text and title of every page."""
    return pages_to_docs(table(spark, sf_dir, "pages")).select(
        F.col("source").alias("url"), "text", F.col("metadata")["title"].alias("title")
    )


def markup_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages made of documents, with references of all kinds and elements that are never closed."""
    way = F.col("doc_id") % 4
    end = (
        F.when(way == 0, F.lit("<script>var a = '</p>';"))
        .when(way == 1, F.lit("<STYLE type=x>p { }"))
        .when(way == 2, F.lit("<!-- never closed <p>no</p>"))
        .otherwise(F.lit("<script>x</script ><p>end"))
    )
    html = F.concat(F.lit(MARKUP), F.replace(F.col("text"), F.lit("<"), F.lit("&lt;")), F.lit("</p>"), end)
    pages = table(spark, sf_dir, "documents").select(F.concat(F.lit("http://a.b/"), "doc_id").alias("url"), html.alias("html"))
    return pages_to_docs(pages).select(F.col("source").alias("url"), "text")


def document_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    chunks = docs.chunk_documents(documents, CHUNK, OVERLAP)
    return chunks.select("doc_id", F.col("chunk").cast("bigint").alias("chunk"), "text")


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents split at line ends; blank lines dropped."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.chunk_documents(documents, separator="\n").groupBy("doc_id").agg(
        F.count("*").alias("lines"), F.sum(F.length("text")).alias("chars")
    )


def _sentences(text: str) -> list[str]:
    return text.split(". ")


def document_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents split by a Python function."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.chunk_documents(documents, splitter=_sentences).groupBy("doc_id").agg(
        F.count("*").alias("sentences"), F.max(F.length("text")).cast("bigint").alias("longest")
    )


def extracted_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stripped texts of documents, some of which were made blank or NULL."""
    way = F.col("doc_id") % 9
    text = (
        F.when(way == 0, F.lit(" \t\n"))
        .when(way == 1, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("\t \u00a0"), "text", F.lit("\n ")))
    )
    padded = table(spark, sf_dir, "documents").select("doc_id", text.alias("text"))
    return docs.extract_texts(padded)


def corpus_token_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs.corpus_stats(docs.extract_texts(table(spark, sf_dir, "documents").select("text")))


def whitespace_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", clean_whitespace(F.col("text")).alias("text"))


def parquet_docs_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as documents: the priority as text, date and price as metadata."""
    rows = parquet_to_docs(spark, f"{sf_dir}/orders.parquet", "o_orderpriority", ["o_orderdate", "o_custkey"])
    metadata = F.col("metadata")
    return rows.select(
        "row",
        "text",
        metadata["o_orderdate"].alias("o_orderdate"),
        metadata["o_custkey"].cast("bigint").alias("o_custkey"),
        metadata["row"].cast("bigint").alias("metadata_row"),
        F.substring_index("source", "/", -1).alias("file"),
    )


def parquet_docs_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as documents: the whole row as JSON."""
    return parquet_to_docs(spark, f"{sf_dir}/events.parquet").select(
        "row", "text", F.col("metadata")["ts"].alias("ts"), F.map_keys("metadata").cast("string").alias("keys")
    )


QUERIES: dict[str, Query] = {
    "request_sizes": request_sizes,
    "planned_requests": planned_requests,
    "query_prompt_rows": query_prompt_rows,
    "system_prompt_rows": system_prompt_rows,
    "example_json": example_json,
    "packed_contexts": packed_contexts,
    "filled_contexts": filled_contexts,
    "nested_chunks": nested_chunks,
    "document_prompt_rows": document_prompt_rows,
    "refined_queries": refined_queries,
    "output_names": output_names,
    "page_urls_valid": page_urls_valid,
    "page_texts": page_texts,
    "markup_texts": markup_texts,
    "document_chunks": document_chunks,
    "document_lines": document_lines,
    "document_sentences": document_sentences,
    "extracted_texts": extracted_texts,
    "corpus_token_estimate": corpus_token_estimate,
    "whitespace_cleaned": whitespace_cleaned,
    "parquet_docs_content": parquet_docs_content,
    "parquet_docs_json": parquet_docs_json,
}

# ---------------------------------------------------------------------------------------------------
# The same results in SQL.


def sql_text(value: str) -> str:
    """SQL expression of a text with line breaks."""
    return "'" + value.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


def sql_clean(text: str) -> str:
    return f"trim(regexp_replace({text}, '[ \\n\u00a0]+', ' ', 'g'))"


# What the references in the test pages and in MARKUP stand for.
REFERENCES = {
    "lt": "<", "gt": ">", "quot": '"', "nbsp": "\u00a0", "copy": "©", "middot": "·", "eacute": "é", "Eacute": "É",
    "euro": "€", "frac12": "½", "NotEqual": "≠", "thetasym": "ϑ", "#8212": "—", "#x1F600": "😀", "#150": "–", "#0": "\ufffd",
}


def sql_decoded(text: str) -> str:
    for name, char in REFERENCES.items():
        text = f"replace({text}, '&{name};', '{char}')"
    return f"replace({text}, '&amp;', '&')"


SQL_MARKUP = (
    r"(?is)<script\b.*?</script\s*>|<script\b.*$|<style\b.*?</style\s*>|<style\b.*$|<!--.*?-->|<!--.*$|</?[a-zA-Z!?][^>]*>"
)


def sql_page_text(html: str) -> str:
    return sql_clean(sql_decoded(f"regexp_replace({html}, '{SQL_MARKUP}', ' ', 'g')"))


def sql_page_title(html: str) -> str:
    return f"nullif({sql_clean(sql_decoded(f'''regexp_extract({html}, '(?is)<title[^>]*>(.*?)</title', 1)'''))}, '')"


def sql_request_size(remaining: str, batch: str) -> str:
    return (
        f"greatest(1, least(floor({batch} * 1.5::DOUBLE), {remaining} + "
        f"greatest(1, floor({remaining} * 0.1::DOUBLE))))::BIGINT"
    )


def sql_packed(between: int) -> str:
    return f"""packed AS (
  SELECT doc_id, text, doc_id // {SHARD_DOCS} AS shard,
    CAST(coalesce(sum(length(text) + {between}) OVER (PARTITION BY doc_id // {SHARD_DOCS} ORDER BY doc_id
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) // {CONTEXT_CHARS} AS context
  FROM documents
)"""

NOTE_PROMPT = """You write training records in the format 'note'.
Format: A numbered note.
Structure: [{"id":1,"text":"sample text","score":1.23,"verified":false}]

Rules:
- Answer with one JSON list of objects and nothing else.
- Give every required field its declared type.
- Make every record different from the others.
- Be concrete, consistent and true to the request.

Fields (name | type | required | meaning | example):
id | integer | yes | Number of the note | 1
text | string | yes | The note |
score | float | no | How good it is |
verified | boolean | no | Whether it was checked | false
"""

PAIR_EXAMPLE = '[{"anchor":"sample text","positive":"sample text"}]'

def sql_pieces(text: str, separators: tuple[str, ...], depth: int = 0) -> str:
    """Pieces of at most NESTED_CHUNK characters behind the separators, in SQL."""
    if not separators:
        return f"regexp_extract_all({text}, '(?s).{{1,{NESTED_CHUNK}}}')"
    first, piece = sql_text(separators[0]), f"q{depth}"
    cut = f"string_split({text}, {first})"
    whole = f"list_filter(list_transform({cut}, lambda p{depth}, i{depth}: CASE WHEN i{depth} < len({cut}) THEN p{depth} || {first} ELSE p{depth} END), lambda r{depth}: r{depth} != '')"
    finer = sql_pieces(piece, separators[1:], depth + 1)
    return f"""CASE WHEN length({text}) <= {NESTED_CHUNK} THEN [{text}]
  ELSE flatten(list_transform({whole}, lambda {piece}: CASE WHEN length({piece}) <= {NESTED_CHUNK} THEN [{piece}] ELSE {finer} END)) END"""


ORACLES: dict[str, str] = {
    "request_sizes": f"""SELECT o_orderkey, {sql_request_size('(o_custkey + 1)', '(o_orderkey % 40 + 1)')} AS n_requested
FROM orders""",
    "planned_requests": f"""WITH targets AS (
  SELECT conv_id AS target_id, 10 * count(*) AS num_samples, 12 * count(*) FILTER (role = 'assistant') AS accepted,
         count(*) FILTER (role = 'assistant') AS batches
  FROM conversations GROUP BY conv_id
), ahead AS (
  SELECT *, num_samples - accepted - i * 12 AS missing FROM targets, (VALUES (0), (1)) AS w(i)
)
SELECT target_id, num_samples, batches + i AS batch_id, {sql_request_size('missing', '8')} AS n_requested
FROM ahead WHERE missing > 0""",
    "query_prompt_rows": f"""SELECT conv_id, turn,
  'Write ' || (turn + 5) || ' different records for this request.' || chr(10) || chr(10) || 'Request: "' || text || '"'
  || chr(10) || chr(10) || 'Format: pair' || chr(10) || 'Structure: {PAIR_EXAMPLE}' || chr(10) AS human
FROM conversations""",
    "system_prompt_rows": f"""SELECT conv_id, turn, {sql_text(NOTE_PROMPT)} AS system
FROM conversations""",
    "example_json": """SELECT item_id, '[{"id":1,"text":"sample text","score":1.23,"verified":false}]' AS example
FROM benchmark""",
    "filled_contexts": f"""WITH RECURSIVE pieces AS (
  SELECT doc_id, doc_id // {SHARD_DOCS} AS shard, piece, text[piece * {CONTEXT_CHARS} + 1 : (piece + 1) * {CONTEXT_CHARS}] AS text
  FROM (SELECT doc_id, text, unnest(range(greatest(1, (length(text) + {CONTEXT_CHARS} - 1) // {CONTEXT_CHARS}))) AS piece FROM documents)
), items AS (
  SELECT *, length(text) AS size, row_number() OVER (PARTITION BY shard ORDER BY doc_id, piece) AS place FROM pieces
), placed AS (
  SELECT shard, place, 0 AS context, size AS used FROM items WHERE place = 1
  UNION ALL
  SELECT i.shard, i.place, CASE WHEN used + 2 + size <= {CONTEXT_CHARS} THEN context ELSE context + 1 END,
    CASE WHEN used + 2 + size <= {CONTEXT_CHARS} THEN used + 2 + size ELSE size END
  FROM placed p JOIN items i ON i.shard = p.shard AND i.place = p.place + 1
)
SELECT doc_id, CAST(piece AS INTEGER) AS piece, shard, CAST(context AS BIGINT) AS context, md5(text) AS text_md5 FROM items JOIN placed USING (shard, place)""",
    "nested_chunks": f"""WITH RECURSIVE cut AS (SELECT doc_id, text, {sql_pieces('text', SEPARATORS)} AS pieces FROM documents),
sizes AS (SELECT doc_id, text, list_transform(pieces, lambda p: length(p)) AS sizes FROM cut),
ends AS (SELECT doc_id, text, list_transform(range(1, len(sizes) + 1), lambda i: CAST(list_sum(sizes[1:i]) AS BIGINT)) AS ends FROM sizes),
walk AS (
  SELECT doc_id, text, ends, 0::BIGINT AS start, list_max(list_filter(ends, lambda e: e <= {NESTED_CHUNK})) AS stop FROM ends WHERE text != ''
  UNION ALL
  SELECT doc_id, text, ends, stop, list_max(list_filter(ends, lambda e: e <= stop + {NESTED_CHUNK})) FROM walk WHERE stop < length(text)
)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY start) - 1 AS INTEGER) AS chunk, text[start + 1 : stop] AS text
FROM walk WHERE regexp_matches(text[start + 1 : stop], '[^\\s]')""",
    "packed_contexts": f"WITH {sql_packed(0)} SELECT doc_id, shard, context FROM packed",
    "document_prompt_rows": f"""WITH {sql_packed(7)}
SELECT shard, context, count(*) AS n_documents, md5(
  'Write 7 different records that use only what these documents say.' || chr(10) || chr(10) || '--- DOCUMENTS ---'
  || chr(10) || string_agg(text, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY doc_id) || chr(10)
  || '--- END OF DOCUMENTS ---' || chr(10) || chr(10) || 'Format: pair' || chr(10) || 'Structure: {PAIR_EXAMPLE}'
  || chr(10)) AS human_md5
FROM packed GROUP BY shard, context""",
    "refined_queries": """SELECT q.conv_id || '-' || q.turn AS key,
  CASE WHEN r.text IS NULL OR q.conv_id % 5 = 0 OR q.conv_id % 7 = 0 OR lower(trim(r.text)) = lower(trim(q.text))
       THEN q.text ELSE trim(r.text) END AS query
FROM conversations q LEFT JOIN conversations r ON r.conv_id = q.conv_id AND r.turn = q.turn + 1""",
    "output_names": """SELECT p_partkey, 'out/data_' || regexp_replace(p_name || '/é#' || p_brand, '[^\\p{L}\\p{N}_-]', '_', 'g')
  || CASE WHEN p_size % 2 = 0 THEN '_from_docs' ELSE '_from_query' END AS base_name
FROM part""",
    "page_urls_valid": """SELECT page_id, regexp_matches(url, '^https?://[^/?#]+') AS as_is,
  regexp_matches(url, '^https?://[^/?#]+') AS upper_case, false AS other_scheme, false AS no_host,
  page_id % 2 = 0 AND regexp_matches(url, '^https?://[^/?#]+') AS half_null
FROM pages""",
    "page_texts": f"""SELECT url, {sql_page_text('html')} AS text, {sql_page_title('html')} AS title
FROM pages WHERE regexp_matches(url, '^https?://[^/?#]+')""",
    "markup_texts": f"""SELECT 'http://a.b/' || doc_id AS url, {sql_page_text('html')} AS text FROM (
  SELECT doc_id, {sql_text(MARKUP)} || replace(text, '<', '&lt;') || '</p>' || CASE doc_id % 4 WHEN 0 THEN '<script>var a = ''</p>'';'
    WHEN 1 THEN '<STYLE type=x>p {{ }}' WHEN 2 THEN '<!-- never closed <p>no</p>' ELSE '<script>x</script ><p>end' END AS html
  FROM documents)""",
    "document_chunks": f"""SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY start) - 1 AS chunk, text FROM (
  SELECT doc_id, start, substring(text, start + 1, {CHUNK}) AS text
  FROM (SELECT doc_id, text, unnest(generate_series(0, greatest(0, length(text) - {OVERLAP} - 1), {CHUNK - OVERLAP})) AS start
        FROM documents))
WHERE trim(text, ' ' || chr(9) || chr(10) || chr(13)) <> ''""",
    "document_lines": """SELECT doc_id, count(*) AS lines, CAST(sum(length(line)) AS BIGINT) AS chars
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
WHERE trim(line, ' ' || chr(9) || chr(13)) <> '' GROUP BY doc_id""",
    "document_sentences": """SELECT doc_id, count(*) AS sentences, max(length(piece))::BIGINT AS longest
FROM (SELECT doc_id, unnest(string_split(text, '. ')) AS piece FROM documents)
WHERE trim(piece, ' ' || chr(9) || chr(10) || chr(13)) <> '' GROUP BY doc_id""",
    "extracted_texts": "SELECT doc_id, text FROM documents WHERE doc_id % 9 > 1",
    "corpus_token_estimate": """SELECT count(*) AS documents, CAST(sum(length(text)) AS BIGINT) AS chars,
  sum(length(text)) / 4.0::DOUBLE AS estimated_tokens, sum(length(text)) / 4.0 > 500000 AS is_large
FROM documents""",
    "whitespace_cleaned": f"SELECT doc_id, {sql_clean('text')} AS text FROM documents",
    "parquet_docs_content": """SELECT o_orderkey AS row, o_orderpriority AS text,
  strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS o_orderdate, o_custkey, o_orderkey AS metadata_row,
  'orders.parquet' AS file
FROM orders""",
    "parquet_docs_json": """SELECT event_id AS row, to_json({'event_id': event_id, 'ts': strftime(ts, '%Y-%m-%dT%H:%M:%S.%g'),
  'user_id': user_id, 'event_type': event_type, 'value': value, 'props': props})::VARCHAR AS text,
  CASE WHEN strftime(ts, '%f') = '000000' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
       ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS ts,
  '[source, row, event_id, ts, user_id, event_type, value, props]' AS keys
FROM events""",
}
