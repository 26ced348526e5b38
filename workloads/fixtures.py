"""Inputs derived from the driver's tables, each over the whole table.

What is wrong with an item or a response is a function of its id, so the expected outcome can be stated
in SQL without parsing any JSON.
"""

from __future__ import annotations

import posixpath
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.formats import Field, FormatSpec
from recordloom.session import new_work_dir

BATCH = 50
EVENT_BATCH = 10
#: Tasks per core that write the files of a table.
FILE_TASKS = 4

CUSTOM = FormatSpec(
    "note",
    "A numbered note.",
    (
        Field("id", "integer", True, "Number of the note", 1),
        Field("text", "string", True, "The note"),
        Field("score", "float", False, "How good it is"),
        Field("verified", "boolean", False, "Whether it was checked", False),
    ),
)

EVENT = FormatSpec(
    "event",
    "What a user did.",
    (Field("event_type", "string"), Field("k", "integer")),
    {"event_type": lambda c: c.isin("click", "view", "purchase", "signup")},
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered_documents(documents: DataFrame) -> DataFrame:
    """All documents with an even item number ``id``; every tenth comes again a little later, with an odd one."""
    ahead = F.when(F.col("doc_id") % 10 == 0, F.array(F.lit(0), F.lit(11))).otherwise(F.array(F.lit(0)))
    return (
        documents.select("doc_id", "text", "lang", "source", F.explode(ahead).alias("ahead"))
        .withColumn("id", F.col("doc_id") * 2 + F.col("ahead"))
        .drop("ahead")
    )


def _item_fields(format_name: str) -> dict[str, Column]:
    doc_id, text, lang, source = (F.col(c) for c in ("doc_id", "text", "lang", "source"))
    score = (doc_id % 101) / F.lit(100.0)
    return {
        "qa": {
            "context": text,
            "question": F.concat(F.lit("About "), lang, F.lit("?")),
            "answer": source,
        },
        "pair-class": {"premise": text, "hypothesis": lang, "label": doc_id % 3},
        "pair-score": {"sentence1": text, "sentence2": lang, "score": score},
        "pair": {"anchor": text, "positive": lang},
        "triplet": {"anchor": text, "positive": lang, "negative": source},
        "note": {"id": doc_id, "text": text, "score": score, "verified": doc_id % 2 == 0},
    }[format_name]


def _item_json(format_name: str) -> Column:
    """JSON text of an item with the defect its document calls for."""
    fields = _item_fields(format_name)
    names = list(fields)
    first_text = "text" if format_name == "note" else names[0]
    last = names[-1]
    defect = F.col("doc_id") % 20

    def packed(values: dict[str, Column], keep_nulls: bool = False) -> Column:
        options = {"ignoreNullFields": "false"} if keep_nulls else {}
        return F.to_json(F.struct(*[v.alias(n) for n, v in values.items()]), options)

    number = F.col("doc_id")
    wrong_type = {"note": {"id": F.lit("one")}, "pair-class": {last: F.lit("one")}, "pair-score": {last: F.lit("one")}}
    out_of_range = {"pair-class": {last: F.lit(7)}, "pair-score": {last: F.lit(1.5)}}
    text = (
        F.when(defect == 3, packed({n: v for n, v in fields.items() if n != last}))
        .when(defect == 7, packed(fields | wrong_type.get(format_name, {last: number})))
        .when(defect == 13, packed(fields | {"note": F.lit("extra")}))
        .when(defect == 17, packed(fields | {first_text: F.lit("  ")}))
    )
    if format_name in out_of_range:
        text = text.when(defect == 11, packed(fields | out_of_range[format_name]))
    if format_name == "note":
        text = text.when(defect == 11, packed(fields | {"text": F.lit(None).cast("string")}, keep_nulls=True))
    number_field = {"pair-class": "label", "pair-score": "score", "note": "score"}.get(format_name)
    if number_field:
        text = text.when(defect == 15, packed(fields | {number_field: F.floor(F.col("doc_id") / 20) % 2 == 0}))
    if "score" in fields:
        text = text.when(defect == 19, packed(fields | {"score": F.lit(1)}))
    return text.otherwise(packed(fields))


def _wrapped(listed: Column, batch: Column) -> Column:
    """A list as a model might send it."""
    way = batch % 8
    return (
        F.when(way == 3, F.concat(F.lit("```json\n"), listed, F.lit("\n```")))
        .when(way == 4, F.concat(F.lit("```"), listed, F.lit("```")))
        .when(way == 5, F.concat(F.lit(" \n\t"), listed, F.lit(" \n ")))
        .when(way == 6, F.concat(listed, F.lit(" That is all.")))
        .when(way == 7, F.substring(listed, F.lit(1), F.length(listed) - 1))
        .otherwise(listed)
    )


def document_responses(documents: DataFrame, format_name: str) -> DataFrame:
    """Responses ``(batch_id, content)`` with fifty item numbers, that is the items of 25 documents, each."""
    items = numbered_documents(documents).select(
        F.floor(F.col("id") / BATCH).alias("batch_id"),
        F.struct((F.col("id") % BATCH).alias("pos"), _item_json(format_name).alias("json")).alias("item"),
    )
    listed = F.concat(F.lit("["), F.array_join(F.col("items.json"), ","), F.lit("]"))
    return (
        items.groupBy("batch_id")
        .agg(F.array_sort(F.collect_list("item")).alias("items"))
        .select("batch_id", _wrapped(listed, F.col("batch_id")).alias("content"))
    )


def event_responses(events: DataFrame) -> DataFrame:
    """Responses with the items of ten events each; many events repeat, errors are not valid."""
    item = F.to_json(
        F.struct("event_type", F.get_json_object("props", "$.k").cast("bigint").alias("k"))
    )
    return (
        events.select(
            F.floor(F.col("event_id") / EVENT_BATCH).alias("batch_id"),
            F.struct(F.col("event_id").alias("pos"), item.alias("json")).alias("item"),
        )
        .groupBy("batch_id")
        .agg(F.array_sort(F.collect_list("item")).alias("items"))
        .select("batch_id", F.concat(F.lit("["), F.array_join(F.col("items.json"), ","), F.lit("]")).alias("content"))
    )


def order_calls(orders: DataFrame) -> DataFrame:
    """Call records ``(batch_id, attempt, call, …)``: six orders make up to three attempts of a batch."""
    place = F.col("o_orderkey") % 6
    attempt = F.when(place < 2, 1).when(place == 2, 2).otherwise(3)
    call = F.when(place.isin(0, 2, 3), 1).when(place.isin(1, 4), 2).otherwise(3)
    silent = place.isin(0, 3, 4)
    status = F.col("o_orderstatus")
    listed = F.to_json(F.array(F.struct(F.col("o_orderpriority").alias("priority"))))
    content = (
        F.when(silent, F.lit("  "))
        .when(status == "O", listed)
        .when(status == "P", F.col("o_orderpriority"))
        .when(place == 2, F.lit("{"))
    )
    return orders.select(
        F.floor(F.col("o_orderkey") / 6).alias("batch_id"),
        attempt.alias("attempt"),
        call.alias("call"),
        F.when(silent & (F.col("o_custkey") % 2 == 0), F.lit(None)).otherwise(content).alias("content"),
        F.when((status == "F") & (place == 1), F.lit("SAFETY")).otherwise(F.lit("STOP")).alias("finish_reason"),
        F.when(silent & (F.col("o_custkey") % 3 == 0), F.lit("timeout")).alias("error"),
    )


def part_definitions(part: DataFrame) -> DataFrame:
    """A format definition per part, most of them with something wrong: ``(file, text)``."""
    way = F.col("p_partkey") % 12

    def body(**parts: Column) -> Column:
        return F.struct(*[v.alias(n) for n, v in parts.items()])

    name, kind = F.col("p_name"), F.lit("integer")

    def definition(size: Column) -> Column:
        title = body(type=F.lit("string"), description=name)
        return F.to_json(F.struct(F.struct(size.alias("size"), title.alias("title")).alias("fields")))

    good = body(type=kind, description=name, required=F.lit(True), example=F.col("p_size"))
    text = (
        F.when(way == 0, F.concat(definition(good), F.lit("}")))
        .when(way == 1, F.to_json(F.array(name)))
        .when(way == 2, F.to_json(F.struct(name.alias("name"))))
        .when(way == 3, F.lit('{"fields": {}}'))
        .when(way == 4, F.lit('{"fields": [1]}'))
        .when(way == 5, definition(name))
        .when(way == 6, definition(body(type=F.col("p_type"), description=name)))
        .when(way == 7, definition(body(type=kind, description=F.lit(" "))))
        .when(way == 8, definition(body(type=kind, description=name, required=F.lit("yes"))))
        .when(way == 9, definition(body(type=kind, description=name, example=F.col("p_retailprice"))))
        .when(way == 10, definition(body(description=F.col("p_size"), required=F.lit(1))))
        .otherwise(definition(good))
    )
    return part.select(F.concat(F.lit("part-"), F.col("p_partkey"), F.lit(".json")).alias("file"), text.alias("text"))


def _qualified(spark: SparkSession, path: str) -> str:
    """URI of a path on the file system Spark takes it to be on."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    uri = fs.makeQualified(hadoop_path).toUri().toString()
    return "file://" + uri[5:] if uri.startswith("file:/") and not uri.startswith("file://") else uri


def write_files(files: DataFrame, label: str) -> str:
    """Write rows of ``(name, content)`` as files of a new shared folder, in parallel; returns the folder.

    Names say where a file goes, so a repeated task writes the same files again.
    """
    spark = files.sparkSession
    folder = _qualified(spark, new_work_dir(spark, label))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        made = set()
        for batch in batches:
            for name, content in zip(batch["name"], batch["content"]):
                parent = posixpath.dirname(name)
                if parent and parent not in made:
                    system.create_dir(posixpath.join(root, parent), recursive=True)
                    made.add(parent)
                with system.open_output_stream(posixpath.join(root, name)) as out:
                    out.write(content.encode("utf-8"))
            yield pd.DataFrame({"written": [len(batch)]})

    # a table may be a single file, which one task would read and write all the others from
    dealt = files.select("name", "content").repartition(spark.sparkContext.defaultParallelism * FILE_TASKS, "name")
    dealt.mapInPandas(write, "written bigint").agg(F.sum("written")).head()
    return folder
