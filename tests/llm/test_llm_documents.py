"""Operators on documents against plain Python over small tables, and the cases their docstrings define."""

import collections
import hashlib
import itertools
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from recordloom.llm import importance, minhash, shards
from recordloom.llm.arrays import Words, utf8
from recordloom.llm.decontaminate import decontaminate, find_contamination
from recordloom.llm.line_dedup import remove_repeats

DOCS = "doc_id long, text string, n_hit string, Verdict string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def prose(seed, n):
    """n words no other seed has."""
    rng = np.random.default_rng(seed)
    return [f"w{seed}x{i}" for i in rng.integers(0, 10**9, n)]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, columns whose names results also have."""
    long = " ".join(prose(99, 60_000))
    rows = [(1, None), (2, ""), (3, "..."), (None, "a b c"), (None, None), (4, "one two"), (4, "one two"), (5, long), (6, "é Ü 漢字 x"), (4, "three")]
    return spark.createDataFrame([(i, t, "h", "v") for i, t in rows], DOCS)


def empty(odd):
    return odd.where("false")


# ------------------------------------------------------------------ decontamination


def expected_contamination(docs, items):
    windows = collections.defaultdict(set)
    for item, text in items:
        w = lowered(text)
        for i in range(max(1, len(w) - 12) if w else 0):
            windows[tuple(w[i : i + 13])].add("null" if item is None else str(item))
    out = []
    for doc, text in docs:
        w, hit, found = lowered(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        names = ",".join(sorted(found))
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("slice_bytes", [16 << 20, 300])
def test_contamination(spark, slice_bytes):
    test = prose(1, 30)
    items = [(10, " ".join(test)), (9, "Short, item!"), (9, " ".join(test[5:25])), (None, "É only"), (3, None), (4, "!!")]
    body = prose(2, 400)
    docs = [
        (1, " ".join(body)),
        (2, " ".join(body[:100] + test[:14] + body[100:200])),
        (3, " ".join(body[:300] + test[:13] + body[300:])),
        (4, "x SHORT\nitem. y " + " ".join(body[:100])),
        (5, "-".join(test).upper()),
        (6, None),
        (7, ""),
        (8, "short item short item é only"),
        (9, " ".join(test[:12])),
    ]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = find_contamination(frame, benchmark, keep=["doc_id"], slice_bytes=slice_bytes)
    rows = [(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got.collect()]
    assert sorted(rows, key=repr) == expected_contamination(docs, items)
    kept = {r.doc_id for r in decontaminate(frame, benchmark, slice_bytes=slice_bytes).collect()}
    assert kept == {r[0] for r in rows if not r[5]}
    cleaned = {r.doc_id: r.text for r in decontaminate(frame, benchmark, action="spans", slice_bytes=slice_bytes).collect()}
    assert cleaned[1] == docs[0][1] and cleaned[6] is None and cleaned[5] == "" and cleaned[7] == ""
    assert cleaned[2] == " ".join(body[:100]) + "  " + " ".join(body[100:200])
    assert cleaned[4].startswith("x . y ")


def test_contamination_of_odd_rows(spark, odd):
    benchmark = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    found = find_contamination(odd, benchmark)
    assert found.count() == odd.count() and found.columns[:3] == ["doc_id", "text", "Verdict"]
    assert found.where("contaminated").count() == 2
    assert decontaminate(odd, benchmark).columns == odd.columns and decontaminate(odd, benchmark).count() == 8
    assert decontaminate(odd, benchmark.where("false")).count() == odd.count()
    assert find_contamination(empty(odd), benchmark).count() == 0


# ------------------------------------------------------------------ substring dedup


def units_of(text):
    cuts = [0] + [m.end() for m in re.finditer(r"(?:\n|(?<=[.!?])\s)\s*(?=\S)", text)]
    cuts = sorted(set(cuts))
    return [(a, b) for a, b in zip(cuts, [*cuts[1:], len(text)], strict=True) if lowered(text[a:b])]


def expected_repeats(docs, min_words):
    seen, out = set(), {}
    for doc, text in docs:
        units, flags, spans = units_of(text), [], []
        for a, b in units:
            words = tuple(lowered(text[a:b]))
            flags.append(words in seen)
            seen.add(words)
        i = 0
        while i < len(units):
            j = i
            while j < len(units) and flags[j]:
                j += 1
            if j > i and sum(len(lowered(text[a:b])) for a, b in units[i:j]) >= min_words:
                spans.append((units[i][0], units[j - 1][1]))
            i = max(j, i + 1)
        kept, end = "", 0
        for a, b in spans:
            kept, end = kept + text[end:a], b
        out[doc] = (kept + text[end:], spans)
    return out


def test_repeated_passages(spark):
    def sentences(seed, n):
        w = prose(seed, n * 9)
        return [" ".join(w[i * 9 : i * 9 + 9]).capitalize() + "." for i in range(n)]

    passage = " ".join(sentences(500, 7))
    docs = []
    for i in range(40):
        own = sentences(i, 12)
        extra = passage if i % 3 else passage.upper().replace(" ", "  ")
        docs.append((i, " ".join(own[:4]) + "\n" + " ".join(own[4:8]) + " " + extra + ("\n" if i % 2 else " ") + " ".join(own[8:]) + " Of it. Of it.\n\n"))
    docs.append((100, "É à. " * 30))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.text, [(s.start, s.stop) for s in r.removed]) for r in remove_repeats(frame).collect()}
    assert got == expected_repeats(docs, 25)
    assert sum(bool(s) for _, s in got.values()) == 40  # all but the first of the passage, and the self-repeating one


def expected_passages(docs, width):
    """The words that stay if those go that are in a repeated sentence or run of words, in stretches of ``width`` or more."""
    seen, out = set(), {}
    for doc, text in docs:
        words = lowered(text)
        gone, at = [False] * len(words), 0
        for a, b in units_of(text):
            unit = tuple(lowered(text[a:b]))
            if unit in seen:
                gone[at : at + len(unit)] = [True] * len(unit)
            seen.add(unit)
            at += len(unit)
        for i in range(len(words) - width + 1):
            run = ("run", *words[i : i + width])
            if run in seen:
                gone[i : i + width] = [True] * width
            seen.add(run)
        for go, some in itertools.groupby(range(len(words)), gone.__getitem__):
            some = list(some)
            if go and len(some) < width:
                gone[some[0] : some[-1] + 1] = [False] * len(some)
        out[doc] = [w for w, g in zip(words, gone, strict=True) if not g]
    return out


def test_passages_that_are_no_units(spark):
    p = prose(700, 55)
    mid = " ".join(p[:20]) + ". " + " ".join(p[20:38]) + ". " + " ".join(p[38:])  # 20 + 18 + 17 words
    flat = " ".join(prose(701, 80))
    changed = prose(702, 61)
    docs = []
    for i in range(12):
        own = prose(710 + i, 60)
        edited = [*changed[:30], f"edit{i}", *changed[31:]]
        part = [mid, flat, " ".join(edited), " ".join(p[i : i + 25]), " ".join(p[i : i + 24])][i % 5]
        docs.append((i, " ".join(own[:30]) + " " + part + " (" + " ".join(own[30:]) + ") x."))
    docs.append((50, " ".join(prose(703, 30) * 3)))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.text for r in remove_repeats(frame).collect()}
    assert {d: lowered(t) for d, t in got.items()} == expected_passages(docs, 25)
    own = prose(715, 60)  # the second with the passage of 55 words
    assert got[5] == " ".join(own[:30]) + " (" + " ".join(own[30:]) + ") x."


@pytest.mark.parametrize("width", [1, 2, 3, 8])
def test_runs_of_all_widths(spark, width):
    rng = np.random.default_rng(width)
    docs = [(i, " ".join(f"v{x}" for x in rng.integers(0, 12, rng.integers(0, 40))) + ".") for i in range(60)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {r.doc_id: lowered(r.text) for r in remove_repeats(frame, min_words=width, passage_words=width).collect()}
    assert got == expected_passages(docs, width)


def test_repeats_in_odd_rows(odd):
    out = remove_repeats(odd, min_words=1)
    assert out.count() == odd.count() and out.columns == [*odd.columns, "removed"]
    assert sorted(str(r.text)[:9] for r in out.collect()) == sorted(str(r.text)[:9] for r in odd.collect())
    assert remove_repeats(empty(odd)).count() == 0
    assert remove_repeats(odd.withColumn("Removed", F.lit(1))).columns == [*odd.columns, "removed"]
    assert remove_repeats(odd, spans_column=None).columns == odd.columns


@pytest.mark.parametrize("unit, first, second", [("line", "a b. c\nq", "q"), ("paragraph", "a b. c\nd\n\nq", "a b. c\nq")])
def test_other_units(spark, unit, first, second):
    frame = spark.createDataFrame([(1, first), (2, "a b. c\nd" if unit == "line" else "A B C D\n\n" + second)], "doc_id long, text string")
    got = {r.doc_id: r.text for r in remove_repeats(frame, unit=unit, min_words=3).collect()}
    assert got == {1: first, 2: "d" if unit == "line" else second}
    with pytest.raises(ValueError):
        remove_repeats(frame, unit="page").collect()


# ------------------------------------------------------------------ near-duplicates


def similar_classes(spark, docs, similarity=0.8):
    idf = minhash.document_frequencies(spark.createDataFrame([(t,) for _, t in docs], "text string"))
    first, number, weight = minhash.bags(Words(*utf8(pa.array([t for _, t in docs], pa.string()))), idf)
    bags = [dict(zip(number[a:b].tolist(), weight[a:b].tolist(), strict=True)) for a, b in zip(first[:-1], first[1:], strict=True)]
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, x in enumerate(bags):
        for j in range(i):
            y = bags[j]
            both = sum(min(v, y[k]) for k, v in x.items() if k in y)
            if x and y and both >= similarity * (sum(x.values()) + sum(y.values()) - both):
                parent[root(i)] = root(j)
    classes = collections.defaultdict(list)
    for i, (doc, _) in enumerate(docs):
        classes[root(i)].append(doc)
    return {doc: min(c) for c in classes.values() for doc in c}


def near_copies():
    docs = []
    for g in range(12):
        base = prose(g, 120)
        for c in range(1 + g):
            words = list(base)
            for k in range(c % 4):
                words[(17 * c + 31 * k) % 120] = f"edit{g}c{c}k{k}"
            docs.append((len(docs) * 3 % 101 + 101 * len(docs), " ".join(words)))
    chain = prose(77, 200)
    for c in range(6):  # neighbours are similar, the ends are not
        docs.append((10_000 + c, " ".join(chain[c * 8 :] + prose(800 + c, c * 8))))
    shared = prose(55, 60)
    docs += [(20_000 + i, " ".join(shared + prose(2000 + i, 90))) for i in range(80)]  # a common passage only
    docs += [(30_000, "one two"), (30_001, "One, two!"), (30_002, "one three")]
    return docs


def test_near_duplicate_classes(spark):
    docs = near_copies()
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.class_id for r in minhash.classes(frame).collect()}
    assert got == similar_classes(spark, docs)
    kept = {r.doc_id for r in minhash.keep_first(frame).collect()}
    assert kept == set(got.values())


def test_bands_of_many_nodes(spark, monkeypatch):
    monkeypatch.setattr(minhash, "PART", 8)
    docs = near_copies()
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert {r.doc_id: r.class_id for r in minhash.classes(frame).collect()} == similar_classes(spark, docs)



def between(spark, texts, of_class):
    """Links between given classes, one band per group of texts (group, place in it)."""
    frame = spark.createDataFrame([(i, bytearray([*divmod(i, 256)]), t) for i, t in enumerate(texts)], "__id long, __row_key binary, text string")
    idf = spark.sparkContext.broadcast(minhash.document_frequencies(frame.select("text")))
    sketches = minhash._sketches(frame, idf).toPandas()
    nodes, labels, with_text, number = [], [], [], {}
    for r in sketches.itertuples():
        band, label = of_class(r[1])
        node = bytes(r.node)
        number[node] = r[1]
        nodes.append((node, [band], bytes(r.samples)))
        labels.append((node, label.encode()))
        with_text.append((node, texts[r[1]]))
    label = spark.createDataFrame(labels, "node binary, label binary")
    frame = spark.createDataFrame(nodes, "node binary, bands array<long>, samples binary")
    pairs, later = minhash.links_between(frame, label, spark.createDataFrame(with_text, "node binary, text string"), idf, 0.8)
    if later is not None:
        pairs = pairs.union(minhash.links_of_guests(*later, label, 0.8))
    return {tuple(sorted((number[bytes(a)], number[bytes(b)]))) for a, b in pairs.collect()}


@pytest.mark.parametrize("part", [1000, 1])
def test_links_of_nodes_others_stand_for(spark, monkeypatch, part):
    monkeypatch.setattr(minhash, "PART", part)
    texts, want = [], set()
    for g in range(60):  # the second is like the first, of its class, and like the third; the first and third are no link
        words = prose(3000 + g, 200)
        for edits in ((), (10, 60, 110), (10, 60, 110, 30, 80, 130)):
            texts.append(" ".join(f"edit{g}x{i}" if i in edits else w for i, w in enumerate(words)))
        want.add((3 * g + 1, 3 * g + 2))
    assert between(spark, texts, lambda i: (i // 3, f"{i // 3}-{i % 3 // 2}")) >= want


def test_links_of_texts_with_a_heavy_shingle(spark, monkeypatch):
    monkeypatch.setattr(minhash, "KEPT", 64)
    texts = []
    for g in range(40):  # most of the weight is that of what is repeated, the rest has little in common
        heavy = prose(5000 + g, 5) * 400
        texts += [" ".join(heavy + prose(6000 + 2 * g + i, 180)) for i in (0, 1)]
    assert between(spark, texts, lambda i: (i // 2, str(i))) == {(2 * g, 2 * g + 1) for g in range(40)}

@pytest.mark.parametrize("kept", [256, 64])
def test_copies_unlike_each_other(spark, monkeypatch, kept):
    monkeypatch.setattr(minhash, "PART", 20)
    monkeypatch.setattr(minhash, "KEPT", kept)
    base, docs = prose(5, 150), []
    for c in range(90):  # from 0 to 5 words changed: most pairs of copies are below 0.8
        words = list(base)
        for k in range(c % 6):
            words[(37 * c + 29 * k) % 150] = f"edit{c}k{k}"
        docs.append((c, " ".join(words)))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert {r.doc_id: r.class_id for r in minhash.classes(frame).collect()} == similar_classes(spark, docs)


def test_samples_agree_as_often_as_bags(spark):
    rng = np.random.default_rng(3)
    sampler = minhash.Sampler()
    for _ in range(5):
        number = rng.integers(0, 2**63, 400).astype(np.uint64)
        v, w = rng.choice([0.0, 1.0, 1.5, 3.0], 400), rng.choice([0.0, 1.0, 1.5, 3.0], 400)
        w[:300] = v[:300]
        jaccard = np.minimum(v, w).sum() / np.maximum(v, w).sum()
        same = sampler.samples(number[v > 0], v[v > 0]) == sampler.samples(number[w > 0], w[w > 0])
        assert abs(same.mean() - jaccard) < 4 * (jaccard * (1 - jaccard) / minhash.SAMPLES) ** 0.5


def test_components(spark):
    pairs = [(i, i + 1) for i in range(1, 40)] + [(100, 50), (100, 60), (60, 70)]
    links = spark.createDataFrame([(bytes([a]), bytes([b])) for a, b in pairs], "a binary, b binary")
    got = {bytes(r.node)[0]: bytes(r.label)[0] for r in minhash.components(links).collect()}
    assert got == {i: 1 for i in range(1, 41)} | {i: 50 for i in (50, 60, 70, 100)}


def test_near_duplicates_of_odd_rows(odd):
    found = minhash.classes(odd)
    assert found.count() == odd.count()
    assert minhash.keep_first(odd).columns == odd.columns
    assert minhash.keep_first(odd).count() == 9  # one of the two equal rows goes
    assert minhash.classes(empty(odd)).count() == 0 and minhash.keep_first(empty(odd)).count() == 0


# ------------------------------------------------------------------ quality


def labelled(spark, n=600):
    rng = np.random.default_rng(5)
    good, bad = [f"g{i}" for i in range(300)], [f"b{i}" for i in range(300)]
    docs, labels = [], []
    for i in range(n):
        junk = i % 5 == 0
        words = rng.choice(bad if junk else good, 60)
        docs.append((i, " ".join(words)))
        if i % 3:
            labels.append((i, 0 if junk and i % 2 else 1, 1 if junk and not i % 2 else 0))
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(4), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark):
    docs, labels = labelled(spark)
    kept = {r.doc_id for r in importance.resample(docs, labels).collect()}
    unlabelled = [i for i in range(600) if i % 3 == 0]
    right = sum((i in kept) == (i % 5 != 0) for i in unlabelled)
    assert right >= 0.98 * len(unlabelled)
    weights = {r.doc_id: r.w for r in importance.resample(docs, labels, score_column="w").collect()}
    assert set(weights) == kept


def test_resampling_without_labels_keeps_all(spark, odd):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert importance.resample(odd, labels).count() == odd.count()
    one_kind = spark.createDataFrame([(4, 1, 0), (None, 0, 1)], "doc_id long, quality int, toxic int")
    out = importance.resample(odd, one_kind, score_column="VERDICT")
    assert out.count() == odd.count() and out.columns == ["doc_id", "text", "n_hit", "VERDICT"]
    assert importance.resample(empty(odd), one_kind).count() == 0


def test_kth_largest(spark):
    values = [5, -3, 5, 2**40, -(2**50), 0, 7, 7]
    frame = spark.createDataFrame([(v,) for v in values], "key long")
    assert [importance._kth_largest(frame, k) for k in range(1, 9)] == sorted(values, reverse=True)


# ------------------------------------------------------------------ sharding


def test_shards(spark, tmp_path):
    rows = [(i, f"text {i % 7} é" if i % 11 else None, i * 1.5) for i in range(1003)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, Slot double").repartition(6)
    path = str(tmp_path / "shards")
    shards.write_shards(docs, path, shards=8, bucket_bytes=500)
    got = shards.read_shards(spark, path)
    assert got.columns == ["doc_id", "text", "shard", "slot"]
    rows_back = got.collect()
    assert sorted((r.doc_id, r.text or "") for r in rows_back) == sorted((i, t or "") for i, t, _ in rows)
    by_shard = collections.defaultdict(list)
    for r in rows_back:
        by_shard[r.shard].append((r.slot, r.doc_id))
    sizes = sorted(len(s) for s in by_shard.values())
    assert sorted(by_shard) == list(range(8)) and sizes[-1] - sizes[0] <= 1
    assert all(sorted(s)[i][0] == i for s in by_shard.values() for i in range(len(s)))
    order = [d for s in sorted(by_shard) for _, d in sorted(by_shard[s])]
    assert abs(np.corrcoef(order, range(len(order)))[0, 1]) < 0.15  # no trace of the order
    assert spark.read.parquet(f"{path}/records").select("__bucket").distinct().count() > 10
    again = {(r.doc_id, r.shard, r.slot) for r in shards.sharded(docs.repartition(2), 8, bucket_bytes=500).collect()}
    assert again == {(r.doc_id, r.shard, r.slot) for r in rows_back}  # the same order, however the rows arrive


@pytest.mark.parametrize("n", [0, 1, 5])
def test_few_rows(spark, n):
    docs = spark.createDataFrame([(i, "x") for i in range(n)], "doc_id long, text string")
    assert sorted((r.shard, r.slot) for r in shards.sharded(docs, 8).collect()) == [(i, 0) for i in range(n)]


def test_shards_of_odd_rows(odd):
    columns = ["doc_id", F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("c")]
    got = shards.sharded(odd, 3, columns, bucket_bytes=100).collect()
    assert sorted(r.c for r in got) == sorted(zlib.crc32((r.text or "").encode()) for r in odd.collect())
    assert collections.Counter(r.shard for r in got) == {0: 4, 1: 3, 2: 3}
