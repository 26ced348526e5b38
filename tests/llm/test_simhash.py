"""Fingerprints and their components against brute force, and the cases the docstring defines."""

import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from recordloom.llm import simhash, tables
from recordloom.llm.queries import op11_simhash

SMALL = "/root/testdata/sf0.001"


def plain_print(text, width=4):
    lower = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    words = re.findall(rb"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    k = min(width, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + k]), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius):
    """Smallest print each print is connected with."""
    prints = sorted(set(prints))
    numbers = np.array(prints, np.uint64)
    label = {p: p for p in prints}

    def root(p):
        while label[p] != p:
            p = label[p]
        return p

    for i, p in enumerate(prints):
        for j in np.flatnonzero(np.bitwise_count(numbers[i + 1 :] ^ numbers[i]) <= radius):
            a, b = sorted((root(p), root(prints[i + 1 + j])))
            label[b] = a
    return {p: root(p) for p in prints}


def expected(rows, radius=4):
    prints = [plain_print(t) for _, t in rows]
    of = plain_components(prints, radius)
    least = {}
    for (i, _), p in zip(rows, prints, strict=True):
        known = least.get(of[p])
        least[of[p]] = i if known is None else known if i is None else min(i, known)
    return sorted(((i, f"{p:016x}", least[of[p]]) for (i, _), p in zip(rows, prints, strict=True)), key=repr)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="aAbB \t\n\x0b\x1c éÉ", max_size=60), max_size=8), st.sampled_from([3, 1 << 14]))
def test_fingerprints_equal_plain_python(texts, at_once):
    simhash.SHINGLES, before = at_once, simhash.SHINGLES
    try:
        assert simhash.fingerprints_of([*texts, None]).tolist() == [plain_print(t) for t in [*texts, None]]
    finally:
        simhash.SHINGLES = before


def test_long_text():
    rng = random.Random(3)
    text = " ".join(rng.choice("abcdefgh") * rng.randint(1, 5) for _ in range(70_000))
    assert simhash.fingerprints_of([text, "same word " * 40_000]).tolist() == [plain_print(text), plain_print("same word " * 40_000)]


def test_variants_are_reached_once():
    flips = simhash.Flips(2)
    assert len(flips.masks) == len(set(flips.masks.tolist())) == 1 + 64 + 64 * 63 // 2
    own = np.array([0, 2**64 - 1, 0x123456789ABCDEF0], np.uint64)
    variants = [own[r] ^ flips.masks[f] for s in range(64) for r, f in [flips.towards(own, s)]]
    assert sum(map(len, variants)) == 3 * 2081
    assert {int(x) for v in variants for x in v} == {int(p ^ m) for p in own for m in flips.masks}


@pytest.mark.parametrize("radius", [1, 3, 4])
def test_links_connect_what_all_pairs_would(spark, radius, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET", 200)
    rng = random.Random(radius)
    prints = {0, 2**64 - 1}
    for start in (rng.getrandbits(64), 0, rng.getrandbits(64)):  # chains and balls
        for _ in range(60):
            start_or = rng.choice([start, *prints])
            for b in rng.sample(range(64), rng.randint(1, radius + 2)):
                start_or ^= 1 << b
            prints.add(start_or)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    found = tables.components(simhash.links(spark.createDataFrame(signed, "print long").repartition(3), radius)).collect()
    label = {p: p for p in prints} | {r.node % 2**64: r.label % 2**64 for r in found}
    groups = {}
    for p, x in label.items():
        groups.setdefault(x, set()).add(p)
    wanted = {}
    for p, x in plain_components(prints, radius).items():
        wanted.setdefault(x, set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_documents_equal_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = op11_simhash(spark, SMALL).collect()
    assert sorted(map(tuple, got), key=repr) == expected(rows)


def test_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(300))
    rows = [(None, text), (7, text), (7, text), (3, text.upper()), (None, ""), (None, None), (9, " \n"), (11, "one Two"), (12, "one two"), (13, text + " end")]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, FINGERPRINT string, id int")
    got = simhash.near_duplicates(docs)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, got.collect()), key=repr) == expected(rows)
    alone = simhash.near_duplicates(docs.where("doc_id IS NULL AND text = ''")).collect()
    assert [tuple(r) for r in alone] == [(None, "0" * 16, None)]
    assert simhash.near_duplicates(docs.where("false")).collect() == []


def test_hot_keys_are_joined_apart(spark):
    rows = spark.range(6000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), "id")
    table = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("most"))
    got = tables.joined_by_key(rows, table, "k", "n")
    assert got.count() == 6000 and got.where("k = -1 AND most != 5997 OR k >= 0 AND most != id").count() == 0
