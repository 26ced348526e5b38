import hashlib
import html
import json
import random
import urllib.parse

import pytest
from pyspark.sql import functions as F

from recordloom.errors import ConfigurationError
from recordloom.functions import json_text, sizing, text
from recordloom.params import RunParams, failure_limit
from recordloom.session import prepare


def column(spark, values, build, type_name="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_name}")
    return [r.o for r in rows.select("i", build(F.col("v")).alias("o")).orderBy("i").collect()]


def sql_column(spark, values, build, type_name="string"):
    return column(spark, values, lambda _: F.expr(build("v")), type_name)


def test_strip_is_unicode_aware(spark):
    values = ["  a ", "\x1c\x85 　x y \t", "", " \n", "é﻿ "]
    assert column(spark, values, text.strip) == [v.strip() for v in values]


def test_clean_whitespace(spark):
    values = [" a  b\n\nc  d ", "a\tb", "one two", "\n"]
    assert column(spark, values, text.clean_whitespace) == ["a b c d", "a\tb", "one two", ""]


def test_strip_fences(spark):
    cases = {
        "```json\n[1]\n```": "[1]",
        "```[1]```": "[1]",
        " \n```json[1]```\t": "[1]",
        "```JSON\n[1]\n```": "JSON\n[1]",
        "```json\n[1]": "```json\n[1]",
        "[1]\n```": "[1]\n```",
        "```": "",
        "```json```": "",
        "plain": "plain",
        "````": "",
    }
    assert sql_column(spark, list(cases), text.strip_fences) == list(cases.values())


def test_visible_markup(spark):
    page = "<STYLE>x</STYLE><script>if (a<b) '</p>'</script><!-- no\n --><p class='x'>5 &lt; 6</p><br/>a < b<?xml?>"
    assert [t.split() for t in column(spark, [page], text.visible_markup)] == [["5", "&lt;", "6", "a", "<", "b"]]


def test_entities_agree_with_the_standard_library(spark):
    names = [f"&{name};" for name in text.NAMED_ENTITIES]
    values = [*names, "&#38;lt;", "&amp;amp;", "&lt;&amp;lt;", "&#x41;&#0065;&#x1F600;", "a&b;c", "&unknown;"]
    assert sql_column(spark, values, text.decode_entities) == [html.unescape(v) for v in values]


def test_is_web_url_agrees_with_the_standard_library(spark):
    def expected(url):
        try:
            parts = urllib.parse.urlparse(url)
            return parts.scheme in ("http", "https") and bool(parts.netloc)
        except ValueError:
            return False

    values = [
        "http://a.b", "https://a", "HTTPS://A.b/c?d#e", "ftp://a", "http:/a", "http://", "http:///a", "//a", "",
        "a", "http://?x", "http://#x", " http://a", "ht\ntp://a", "http://[::1]/x", "http://[::1", "http://a]", "mailto:a@b",
    ]
    assert column(spark, values, text.is_web_url) == [expected(v) for v in values]
    assert column(spark, [None], text.is_web_url) == [False]


def test_output_name(spark):
    def plain(prefix, name, documents):
        safe = "".join(c if c.isalnum() or c in "-_" else "_" for c in name)
        return f"{prefix}_{safe}{'_from_docs' if documents else '_from_query'}"

    names = ["qa", "my format!", "é日本-x_1", "a/b.c", "²½"]
    for documents in (True, False):
        got = column(spark, names, lambda c: text.output_name(F.lit("out"), c, F.lit(documents)))
        assert got == [plain("out", n, documents) for n in names]


JSON_VALUES = [
    "1", "-0", "1.5", "1e2", '"a"', '"\\u00e9\\n"', "null", "true", "[]", "{}", "[1,2]", '{"a": [1, {"b": null}]}',
    ' [1 , 2 ]\n', '{"a":1,"a":2}', "12345678901234567890",
]
JSON_TAILS = ["", " ", "]", "}", ",", "1", " 1", ",1", "],[", "x", "\n\n", "[", "{}", '"', "]]", "}}", "],7", ":1", "//", "\x00"]


def test_parse_json_strict_accepts_what_json_loads_accepts(spark):
    prepare(spark)
    texts = [v + t for v in JSON_VALUES for t in JSON_TAILS]
    texts += ["", " ", "[", "]", "{", "[1", '{"a"}', "{'a':1}", "01", "+1", ".5", "tru", "[1,]", '{"a":1,}', '"a\nb"', "[1]]"]

    def accepts(value):
        try:
            json.loads(value)
            return True
        except ValueError:
            return False

    got = sql_column(spark, texts, lambda v: f"{json_text.parse_json_strict(text.stripped(v))} IS NOT NULL")
    wrong = [t for t, g in zip(texts, got) if g != accepts(t.strip())]
    assert wrong == []


def test_last_of_repeated_keys_wins(spark):
    prepare(spark)
    got = sql_column(spark, ['{"a":1,"a":2}'], lambda v: json_text.variant_field(json_text.parse_json_strict(v), "a", "int"))
    assert got == [2]


def test_json_kind(spark):
    prepare(spark)
    cases = {
        '"x"': "string", "1": "integer", "1.0": "float", "1e2": "float", "0.5": "float", "true": "boolean",
        "null": "null", "{}": "object", "[]": "array", '{"a":1}': "object", "[1,\"a\"]": "array",
        "9223372036854775807": "integer", "9223372036854775808": "float",
    }
    assert sql_column(spark, list(cases), lambda v: json_text.json_kind(json_text.parse_json_strict(v))) == list(cases.values())


def test_item_hash_equals_md5_of_sorted_compact_json(spark):
    rng = random.Random(7)
    alphabet = 'ab"\\/\n\r\t\b\f\x00\x0b\x1b\x1f\x7fé日😀  u001F'
    floats = [0.0, -0.0, 1.0, 0.07, 5e-4, 9.99e-5, 1e-5, 1.5e-7, 1e7, 12345678.0, 1e15, 1e16, 1.5e22, -2e-4, 1e300]
    rows = [
        (i, "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 12))), rng.choice([None, rng.randint(-5, 10**12)]),
         floats[i % len(floats)], rng.choice([True, False, None]))
        for i in range(120)
    ]
    frame = spark.createDataFrame(rows, "i int, z string, `a b` bigint, m double, `B\"` boolean")
    columns = {"z": ("z", "string"), "a b": ("`a b`", "integer"), "m": ("m", "float"), 'B"': ('`B"`', "boolean")}
    got = {r.i: r.h for r in frame.select("i", F.expr(json_text.item_hash(columns)).alias("h")).collect()}
    for i, z, a, m, b in rows:
        plain = json.dumps({"z": z, "a b": a, "m": m, 'B"': b}, sort_keys=True, ensure_ascii=False, separators=(",", ":"))
        assert got[i] == hashlib.md5(plain.encode()).hexdigest(), plain
    # Without a float the text is written in one go.
    columns.pop("m")
    got = {r.i: r.h for r in frame.select("i", F.expr(json_text.item_hash(columns)).alias("h")).collect()}
    for i, z, a, _, b in rows:
        plain = json.dumps({"z": z, "a b": a, 'B"': b}, sort_keys=True, ensure_ascii=False, separators=(",", ":"))
        assert got[i] == hashlib.md5(plain.encode()).hexdigest(), plain


def test_indented_json(spark):
    frame = spark.createDataFrame([("é\n", None, 0.5)], "s string, n bigint, f double")
    columns = {"s": ("s", "string"), "n": ("n", "integer"), "f": ("f", "float")}
    got = frame.select(F.expr(json_text.indented_json(columns)).alias("t")).head().t
    assert got == json.dumps({"s": "é\n", "n": None, "f": 0.5}, indent=2, ensure_ascii=False)


def test_request_size(spark):
    def plain(remaining, batch):
        return max(1, min(int(batch * 1.5), remaining + max(1, int(remaining * 0.1))))

    pairs = [(r, b) for r in (1, 2, 3, 8, 9, 10, 13, 50, 99, 100, 1000) for b in (1, 2, 5, 25, 33)]
    frame = spark.createDataFrame(pairs, "r bigint, b bigint")
    got = frame.select("r", "b", sizing.request_size(F.col("r"), F.col("b")).alias("n")).collect()
    assert {(x.r, x.b): x.n for x in got} == {p: plain(*p) for p in pairs}


@pytest.mark.parametrize("total, batch, sizes", [(3, 2, [3, 3, 2]), (8, 5, [7, 4]), (50, 25, [37, 14])])
def test_request_sizes_of_a_run(spark, total, batch, sizes):
    # New records per request: one in the first case, five in the second, all asked for in the third.
    got, have = [], 0
    while have < total and len(got) < len(sizes):
        size = spark.range(1).select(sizing.request_size(F.lit(total - have).cast("bigint"), batch).alias("n")).head().n
        got.append(size)
        have += 1 if (total, batch) == (3, 2) else (5 if (total, batch) == (8, 5) else size)
    assert got == sizes


def test_backoff(spark):
    frame = spark.range(1, 6).select(sizing.backoff_seconds(F.col("id"), 5.0).alias("s"))
    assert [r.s for r in frame.collect()] == [5.0, 10.0, 20.0, 40.0, 80.0]
    jittered = spark.range(1, 6).select("id", sizing.backoff_seconds(F.col("id"), 5.0, jitter=True).alias("s")).collect()
    assert all(5.0 * 2 ** (r.id - 1) <= r.s <= 5.0 * 2 ** (r.id - 1) + 0.5 for r in jittered)


def test_params():
    assert (RunParams().samples, RunParams().batch_size, RunParams().max_retries) == (50, 25, 5)
    assert [failure_limit(r) for r in (0, 2, 5)] == [3, 3, 6]
    bad = [
        {"samples": 0}, {"batch_size": 0}, {"max_retries": -1}, {"temperature": 2.1}, {"top_p": 0.0}, {"top_p": 1.1}, {"top_k": 0},
    ]
    for wrong in bad:
        with pytest.raises(ConfigurationError):
            RunParams(**wrong)
    with pytest.warns(UserWarning):
        RunParams(samples=2001)
