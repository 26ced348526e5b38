"""Registered queries of the operators: each applies one operator to its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.llm import alignment, decontaminate, importance, line_dedup, minhash, neighbours, pieces, shards, simhash, tag_paths, token_files, url_trust, vector_codes
from recordloom.session import new_work_dir, written

PIECES = "piece_bpe_32k.model"
BYTES, END = "byte_bpe_50k.json", 2
SHARDS = 8
PARTS, ENTRIES, ROUNDS = 16, 64, 2
RULES = [
    url_trust.Rule("allow", "com"),
    url_trust.Rule("block", "example.com", "/en/"),
    url_trust.Rule("allow", "www.example.com", "/en/"),
    url_trust.Rule("block", "net", "/es/"),
    url_trust.Rule("block", "net", "/fr/"),
]


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every document lies in eight shuffled shards."""
    text = F.coalesce("text", F.lit(""))
    digest = ["doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32")]
    placed = shards.sharded(_read(spark, sf_dir, "documents"), SHARDS, digest)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its repeated passages, and what was removed where."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.remove_repeats(docs, spans_column="removed")


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its class of near-duplicates."""
    return minhash.classes(_read(spark, sf_dir, "documents"))


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest rows of every 50th vector."""
    return neighbours.nearest(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as read back from the token files."""
    digest = {"ids_crc32": F.crc32("ids")}
    docs = _read(spark, sf_dir, "documents")
    return token_files.tokenised(docs, public_tokenizers.path(BYTES), end_id=END, result=digest)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the benchmark items found in it."""
    docs, items = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark")
    found = decontaminate.find_contamination(docs, items, keep=["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, and whether they decode to its text."""
    model = pieces.Pieces.load(public_tokenizers.path(PIECES))
    docs = _read(spark, sf_dir, "documents").withColumn("seen", F.xxhash64("text"))
    # written in between: encoders and decoders side by side would share an executor's memory
    ids = written(pieces.encode(docs, model, keep=["doc_id", "seen"]), new_work_dir(spark, "ids"))
    return pieces.decode(ids, model).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        (F.xxhash64("decoded") == F.col("seen")).alias("round_trip"),
    )


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's host, path, rule and verdict."""
    judged = url_trust.judge(_read(spark, sf_dir, "pages"), RULES, keep=["page_id"])
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return tag_paths.extract(_read(spark, sf_dir, "pages"), keep=["page_id", "url"])


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that importance resampling keeps, with their log importance weight."""
    docs, labels = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")
    return importance.resample(docs, labels, score_column="log_weight").select("doc_id", "log_weight")


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and its component of fingerprints within four bits."""
    return simhash.near_duplicates(_read(spark, sf_dir, "documents"), width=4, radius=4)


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's code, its error, and the error of its label."""
    return vector_codes.compress(_read(spark, sf_dir, "embeddings"), parts=PARTS, entries=ENTRIES, rounds=ROUNDS)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's groups of the tokens of two tokenizers, and how usual its links are."""
    digest = {"groups_sha256": F.when(F.col("groups") != "", F.sha2("groups", 256)).otherwise("")}
    files = (public_tokenizers.path(name) for name in (BYTES, PIECES))
    return alignment.align(_read(spark, sf_dir, "documents"), *files, result=digest)


QUERIES = {
    f.__name__: f
    for f in (
        op1_sharding,
        op2_substring_dedup,
        op3_minhash,
        op4_nearest_neighbours,
        op5_token_files,
        op6_decontamination,
        op7_sentencepiece,
        op8_url_filter,
        op9_html_text,
        op10_quality,
        op11_simhash,
        op12_vector_codes,
        op13_alignment,
    )
}

_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)


def _assign(books: str) -> str:
    """For each part of a vector the nearest entry: vec_id, label, part, x, entry, d."""
    return f"""
        SELECT vec_id, label, part, x, arg_min(entry, [d, entry]) AS entry, min(d) AS d FROM (
            SELECT p.vec_id, p.label, p.part, p.x, b.entry,
                list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i]))) AS d
            FROM cut p JOIN {books} b USING (part)
        ) GROUP BY ALL
    """


def _move(books: str, assigned: str) -> str:
    """The entries after a round: part, entry, c."""
    return f"""
        SELECT b.part, b.entry, coalesce(m.c, b.c) AS c FROM {books} b LEFT JOIN (
            SELECT part, entry, list((total - ((total % n) + n) % n) // n ORDER BY i) AS c FROM (
                SELECT part, entry, i, CAST(sum(x[i]) AS BIGINT) AS total, count(*) AS n
                FROM (SELECT part, entry, x, unnest(range(1, len(x) + 1)) AS i FROM {assigned}) GROUP BY ALL
            ) GROUP BY ALL
        ) m USING (part, entry)
    """


ORACLES = {
    "op12_vector_codes": f"""
        WITH kept AS (
            SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
            FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        cut AS (
            SELECT vec_id, label, part, e[part * (len(e) // {PARTS}) + 1 : (part + 1) * (len(e) // {PARTS})] AS x
            FROM (SELECT *, unnest(range({PARTS})) AS part FROM kept)
        ),
        chosen AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM (SELECT vec_id FROM kept ORDER BY vec_id LIMIT {ENTRIES})),
        books0 AS (SELECT part, entry, x AS c FROM cut JOIN chosen USING (vec_id)),
        assigned0 AS MATERIALIZED ({_assign("books0")}),
        books1 AS MATERIALIZED ({_move("books0", "assigned0")}),
        assigned1 AS MATERIALIZED ({_assign("books1")}),
        books2 AS MATERIALIZED ({_move("books1", "assigned1")}),
        coded AS (
            SELECT vec_id, label, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
            FROM ({_assign("books2")}) GROUP BY vec_id, label
        )
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
            (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) FROM books2) AS codebooks_sha256
        FROM coded
    """,
    "op6_decontamination": f"""
        WITH d AS (SELECT doc_id, {_WORDS} AS words FROM documents),
        b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS words FROM benchmark),
        bw AS (
            SELECT DISTINCT item, least(len(words), 13) AS n, array_to_string(words[i : i + least(len(words), 13) - 1], ' ') AS win
            FROM (SELECT item, words, unnest(generate_series(1, greatest(len(words) - 12, 1))) AS i FROM b WHERE len(words) > 0)
        ),
        lengths AS (SELECT DISTINCT n FROM bw),
        dw AS (
            SELECT doc_id, n, i, array_to_string(words[i : i + n - 1], ' ') AS win
            FROM (SELECT doc_id, words, n, unnest(generate_series(1, len(words) - n + 1)) AS i FROM d, lengths WHERE len(words) >= n)
        ),
        hits AS (SELECT doc_id, i, dw.n AS n, item FROM dw JOIN bw ON dw.win = bw.win AND dw.n = bw.n),
        hit_words AS (SELECT doc_id, count(DISTINCT w) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS w FROM hits) GROUP BY 1),
        hit_items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
            FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY 1
        )
        SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
            sha256(coalesce(items, '')) AS items_sha256,
            coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
        FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
    """,
    "op4_nearest_neighbours": """
        WITH v AS (
            SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x != 0)) > 0
        ),
        s AS (SELECT q.vec_id AS query_id, r.vec_id AS vec_id, list_cosine_similarity(q.e, r.e) AS score FROM v q JOIN v r ON q.vec_id % 50 = 0 AND q.vec_id != r.vec_id),
        ranked AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
        SELECT * FROM ranked WHERE rank <= 5
    """,
}