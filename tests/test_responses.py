import json
import random

import pytest
from pyspark.sql import functions as F

from plain import check, content_hash, parse
from recordloom.formats import BUILT_IN_FORMATS, Field, FormatSpec, built_in
from recordloom.operators.responses import classify_responses, explode_items, parse_responses, resolve_attempts
from recordloom.operators.validate import item_outcomes, rejects, valid_records, validate_items, warn_items
from recordloom.plans.records import records_from_responses, validated_items

CUSTOM = FormatSpec(
    "note",
    "A note.",
    (
        Field("id", "integer"),
        Field("text", "string"),
        Field("score", "float", False),
        Field("verified", "boolean", False),
    ),
)

PLAIN_CONSTRAINTS = {"label": lambda v: v in (0, 1, 2), "score": lambda v: 0.0 <= v <= 1.0}


def responses(spark, contents):
    return spark.createDataFrame(list(enumerate(contents)), "batch_id bigint, content string")


def validated(spark, items, spec, **options):
    return validated_items(responses(spark, [json.dumps(items)]), spec, **options)


def outcome(spark, item, spec, **options):
    """(record as a dict or None, reasons, warnings) of one item."""
    row = validated(spark, [item], spec, **options).head()
    return (row.record.asDict() if row.reasons == [] else None), row.reasons, row.warnings


GOOD = {
    "qa": {"context": "The mill ran dry in May.", "question": "When did it run dry?", "answer": "May"},
    "triplet": {"anchor": "rain fell", "positive": "it rained", "negative": "it was dry"},
    "pair": {"anchor": "rain fell", "positive": "it rained"},
    "pair-score": {"sentence1": "rain fell", "sentence2": "wind rose", "score": 0.25},
    "pair-class": {"premise": "rain fell", "hypothesis": "it was wet", "label": 0},
}


@pytest.mark.parametrize("name", GOOD)
def test_built_in_formats(spark, name):
    spec, item = built_in(name), GOOD[name]
    assert list(item) == spec.field_names
    assert outcome(spark, item, spec) == (item, [], [])
    first, last = spec.field_names[0], spec.field_names[-1]
    assert outcome(spark, {k: v for k, v in item.items() if k != last}, spec)[1] == [f"missing:{last}"]
    assert outcome(spark, item | {first: 5}, spec)[1] == [f"wrong_type:{first}"]
    assert outcome(spark, item | {first: None}, spec)[1] == [f"wrong_type:{first}"]
    assert outcome(spark, item | {"more": [1]}, spec) == (item, [], ["extra:more"])
    blank = item | {first: " \n"}
    assert outcome(spark, blank, spec) == (blank, [], [f"blank:{first}"])


@pytest.mark.parametrize("score", [-0.1, 1.1, 7])
def test_score_range(spark, score):
    assert outcome(spark, GOOD["pair-score"] | {"score": score}, built_in("pair-score"))[1] == ["constraint:score"]


def test_number_rules(spark):
    score, label = built_in("pair-score"), built_in("pair-class")
    assert outcome(spark, GOOD["pair-score"] | {"score": 1}, score)[0]["score"] == 1.0
    assert outcome(spark, GOOD["pair-score"] | {"score": "0.5"}, score)[1] == ["wrong_type:score"]
    assert outcome(spark, GOOD["pair-class"] | {"label": 1.0}, label)[1] == ["wrong_type:label"]
    assert outcome(spark, GOOD["pair-class"] | {"label": "1"}, label)[1] == ["wrong_type:label"]
    assert outcome(spark, GOOD["pair-class"] | {"label": 3}, label)[1] == ["constraint:label"]
    assert outcome(spark, GOOD["pair-class"] | {"label": True}, label)[0]["label"] == 1
    assert outcome(spark, GOOD["pair-score"] | {"score": True}, score)[0]["score"] == 1.0
    assert outcome(spark, GOOD["pair-class"] | {"label": True}, label, bool_as_int=False)[1] == ["wrong_type:label"]


def test_custom_format(spark):
    full = {"id": 1, "text": "t", "score": 0.5, "verified": True}
    assert outcome(spark, full, CUSTOM) == (full, [], [])
    assert outcome(spark, {"id": 1, "text": "t"}, CUSTOM)[0] == {"id": 1, "text": "t", "score": None, "verified": None}
    assert outcome(spark, full | {"score": None}, CUSTOM)[0]["score"] is None
    assert outcome(spark, full | {"text": None}, CUSTOM)[1] == ["wrong_type:text"]
    assert outcome(spark, {"text": "t"}, CUSTOM)[1] == ["missing:id"]
    assert outcome(spark, full | {"verified": 1}, CUSTOM)[1] == ["wrong_type:verified"]
    assert outcome(spark, full | {"score": 3}, CUSTOM)[0]["score"] == 3.0


def test_constraints_of_custom_formats(spark):
    spec = FormatSpec("short", "", (Field("a b", "string"),), {"a b": lambda c: F.length(c) < 3})
    assert outcome(spark, {"a b": "xy"}, spec)[1] == []
    assert outcome(spark, {"a b": "xyz"}, spec)[1] == ["constraint:a b"]


def test_bad_items_do_not_fail_the_batch(spark):
    frame = validated(spark, [GOOD["pair"], "x", {"anchor": "a"}, None], built_in("pair"))
    assert [r.pos for r in valid_records(frame, built_in("pair")).collect()] == [0]
    got = {r.pos: (r.raw, r.reasons) for r in rejects(frame).collect()}
    assert got == {
        1: ('"x"', ["not_an_object"]),
        2: ('{"anchor":"a"}', ["missing:positive"]),
        3: ("null", ["not_an_object"]),
    }


def test_warned_rows(spark):
    frame = validated(spark, [GOOD["pair"] | {"z": 1, "b": 2, "positive": ""}], built_in("pair"))
    assert sorted(r.warning for r in warn_items(frame).collect()) == ["blank:positive", "extra:b", "extra:z"]


def test_parse_status(spark):
    contents = ['[{"a":1}]', '{"a":1}', "```json\n[]\n```", "```\n[1]\n```", '"x"', "null", "1", "[1] x", "[1", "", None]
    parsed = parse_responses(responses(spark, contents)).select("batch_id", "parse_status", F.size("items").alias("n"))
    got = [(r.parse_status, r.n) for r in parsed.orderBy("batch_id").collect()]
    assert got == [
        ("PARSED", 1), ("PARSED", 1), ("PARSED", 0), ("PARSED", 1), ("NOT_A_LIST", None), ("NOT_A_LIST", None),
        ("NOT_A_LIST", None), ("PARSE_ERROR", None), ("PARSE_ERROR", None), ("PARSE_ERROR", None), ("PARSE_ERROR", None),
    ]


def test_empty_and_failed_batches_keep_a_row(spark):
    items = explode_items(parse_responses(responses(spark, ["[]", "nonsense", "[1]"])))
    assert sorted((r.batch_id, r.pos) for r in items.select("batch_id", F.coalesce("pos", F.lit(-1)).alias("pos")).collect()) == [
        (0, -1), (1, -1), (2, 0),
    ]
    outcomes = item_outcomes(validate_items(items, built_in("pair")), built_in("pair"))
    assert {r.batch_id: r.valid for r in outcomes.collect()} == {0: None, 1: None, 2: False}


def test_status_of_calls(spark):
    rows = [
        (0, "x", "STOP", None, "OK"),
        (1, " \n", "STOP", None, "EMPTY"),
        (2, None, None, None, "EMPTY"),
        (3, "", "SAFETY", None, "SAFETY"),
        (4, "x", "SAFETY", None, "OK"),
        (5, None, None, "boom", "ERROR"),
    ]
    frame = spark.createDataFrame(rows, "id int, content string, finish_reason string, error string, expected string")
    assert all(r.status == r.expected for r in classify_responses(frame).collect())


def test_resolve_attempts(spark):
    good, bad = "[]", "nonsense"
    rows = [
        # batch, attempt, call, content, finish, error
        (0, 1, 1, None, None, "boom"), (0, 1, 2, bad, "STOP", None), (0, 2, 1, good, "STOP", None),
        (1, 1, 1, "", "SAFETY", None),
        (2, 1, 1, "", "STOP", None), (2, 1, 2, None, None, "boom"),
        (3, 1, 1, bad, "STOP", None), (3, 2, 1, '"x"', "STOP", None),
        (4, 1, 1, "", "STOP", None),
        (5, 1, 1, bad, "STOP", None), (5, 3, 1, good, "STOP", None),
    ]
    calls = spark.createDataFrame(
        rows, "batch_id bigint, attempt int, call int, content string, finish_reason string, error string"
    )
    got = {r.batch_id: (r.attempt, r.call, r.outcome, r.parse_status) for r in resolve_attempts(calls, 1).collect()}
    assert got == {
        0: (2, 1, "SUCCEEDED", "PARSED"),
        1: (1, 1, "FAILED", None),
        2: (1, 2, "FAILED", None),
        3: (2, 1, "FAILED", "NOT_A_LIST"),
    }


def random_item(rng, spec):
    values = ["x", "", " ", 0, 1, 2, 7, -1, 0.5, 1.0, 1.5, True, False, None, [1], {"a": 1}, 10**12, "é\n"]
    if rng.random() < 0.05:
        return rng.choice(values)
    right = {"string": ["a", "b c", "é", " "], "integer": [0, 1, 2], "float": [0.25, 1, 0], "boolean": [True, False]}
    item = {
        f.name: rng.choice(right[f.type] if rng.random() < 0.8 else values) for f in spec.fields if rng.random() < 0.9
    }
    if rng.random() < 0.2:
        item["extra"] = rng.choice(values)
    return item


@pytest.mark.parametrize("name", [*BUILT_IN_FORMATS, "note"])
def test_random_responses_agree_with_plain_python(spark, name):
    spec = CUSTOM if name == "note" else built_in(name)
    fields = [(f.name, f.type, f.required) for f in spec.fields]
    constraints = {k: PLAIN_CONSTRAINTS[k] for k in spec.constraints}
    rng = random.Random(name)
    contents = []
    for _ in range(60):
        body = json.dumps([random_item(rng, spec) for _ in range(rng.randint(0, 8))], ensure_ascii=rng.random() < 0.5)
        wrap = rng.choice(["{}", "```json\n{}\n```", "```{}```", " {}\n", "{} x", "{", "```json\n{}"])
        contents.append(wrap.replace("{}", body) if "{}" in wrap else body[:-1])

    expected, seen = [], set()
    for batch, content in enumerate(contents):
        status, items = parse(content)
        for pos, item in enumerate(items or []):
            record = check(item, fields, constraints)
            if record is not None and content_hash(record) not in seen:
                seen.add(content_hash(record))
                expected.append((batch, pos, record, content_hash(record)))

    records = records_from_responses(responses(spark, contents), spec)
    got = [
        (r.batch_id, r.pos, {n: r[n] for n in spec.field_names}, r.hash)
        for r in records.unique.orderBy("batch_id", "pos").collect()
    ]
    assert got == expected
    if expected:
        n = max(1, len(expected) // 2)
        first = records.first(n).orderBy("batch_id", "pos").collect()
        assert [(r.batch_id, r.pos) for r in first] == [e[:2] for e in expected[:n]]
