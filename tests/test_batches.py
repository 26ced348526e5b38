import random

import pytest
from pyspark.sql import functions as F

from recordloom.formats import built_in
from recordloom.operators import batches, dedup, running
from recordloom.operators.running import with_run_length, with_totals_before


def records(spark, rows):
    return spark.createDataFrame(rows, "g string, batch_id bigint, pos int, hash string")


def random_records(rng, hot=0.4, gaps=1):
    """Rows in arrival order, of which one hash and one group hold a large share."""
    rows = []
    for group, count in (("a", 60), ("b", 9), ("c", 1)):
        for batch in range(count):
            for pos in range(rng.randint(0, 6)):
                key = "hot" if rng.random() < hot else f"h{rng.randint(0, 80)}"
                rows.append((group, batch * gaps, pos, key))
    rng.shuffle(rows)
    return rows


def first_rows(rows, grouped):
    seen, kept = set(), []
    for row in sorted(rows, key=lambda r: r[1:3] if not grouped else r[:3]):
        key = (row[0], row[3]) if grouped else row[3]
        if key not in seen:
            seen.add(key)
            kept.append(row)
    return kept


def as_rows(frame):
    return sorted((r.g, r.batch_id, r.pos, r.hash) for r in frame.collect())


@pytest.mark.parametrize("gaps", [1, 1000])
def test_dedup_and_cap_per_group(spark, gaps):
    rows = random_records(random.Random(gaps), gaps=gaps)
    firsts = dedup.dedup_first(records(spark, rows), ["g", "hash"])
    kept = first_rows(rows, grouped=True)
    assert as_rows(firsts) == sorted(kept)
    wanted = {"a": 37, "b": 4, "c": 50}
    expected = [r for g, n in wanted.items() for r in [k for k in kept if k[0] == g][:n]]
    targets = spark.createDataFrame(list(wanted.items()), "g string, wanted int")
    assert as_rows(dedup.cap_unique(firsts, F.col("wanted"), ["g"], targets)) == sorted(expected)
    five = [r for g in wanted for r in [k for k in kept if k[0] == g][:5]]
    assert as_rows(dedup.cap_unique(firsts, 5, ["g"])) == sorted(five)


@pytest.mark.parametrize("n", [0, 1, 17, 40, 10_000])
def test_cap_of_any_size(spark, n):
    rows = [("a", *r[1:]) for r in random_records(random.Random(3)) if r[0] == "a"]
    firsts = dedup.dedup_first(records(spark, rows))
    expected = sorted(first_rows(rows, grouped=False)[:n])
    assert as_rows(dedup.cap_unique(firsts, n)) == expected


def test_hot_hash_is_reduced_before_the_shuffle(spark):
    firsts = dedup.dedup_first(records(spark, [("a", 0, 0, "x")]))
    plan = firsts._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


@pytest.mark.parametrize("ranges", [1, 3, 60, None])
def test_totals_and_runs_over_ranges(spark, ranges):
    rng = random.Random(ranges)
    rows = [(g, b, rng.random() < 0.3, rng.randint(0, 5)) for g in "ab" for b in range(50 if g == "a" else 5)]
    frame = spark.createDataFrame(rows, "g string, b bigint, ok boolean, n bigint")
    totals = with_totals_before(frame, "b", {"before": F.col("n"), "place": F.lit(1)}, ["g"], ranges)
    runs = with_run_length(totals, "b", F.col("ok"), "run", ["g"], ranges)
    expected = []
    for g in "ab":
        before = place = run = 0
        for _, b, ok, n in sorted(r for r in rows if r[0] == g):
            run = 0 if ok else run + 1
            expected.append((g, b, before, place, run))
            before, place = before + n, place + 1
    assert sorted((r.g, r.b, r.before, r.place, r.run) for r in runs.collect()) == expected


def outcomes(spark, rows):
    return spark.createDataFrame(rows, "batch_id bigint, pos int, valid boolean, hash string")


def plain_run(rows, n):
    """Counts per batch as a loop over batches makes them."""
    seen, summary = set(), []
    by_batch = {}
    for batch, pos, valid, key in sorted(rows, key=lambda r: (r[0], -1 if r[1] is None else r[1])):
        by_batch.setdefault(batch, []).append((valid, key))
    for batch, items in sorted(by_batch.items()):
        valid = [k for v, k in items if v]
        skipped = sum(v is False for v, _ in items)
        new = duplicates = 0
        for key in valid:
            if key not in seen:
                seen.add(key)
                new += 1
            else:
                duplicates += 1
            if n is not None and len(seen) >= n:
                break
        summary.append((batch, len(valid), skipped, new, duplicates, bool(valid) and new == 0))
        if n is not None and len(seen) >= n:
            break
    return summary


@pytest.mark.parametrize("n", [None, 1, 12, 30, 1000])
def test_batch_summary(spark, n):
    rng = random.Random(5)
    rows = []
    for batch in range(40):
        count = rng.randint(0, 6)
        rows += [(batch, None, None, None)] if count == 0 else []
        for pos in range(count):
            valid = rng.random() < 0.8
            rows.append((batch, pos, valid, f"h{rng.randint(0, 50)}" if valid else None))
    summary = batches.batch_summary(outcomes(spark, rows), n)
    names = ("batch_id", "valid", "skipped", "new_unique", "duplicates", "stagnant")
    assert sorted(tuple(r[c] for c in names) for r in summary.collect()) == plain_run(rows, n)


def test_run_summary_and_offsets(spark):
    rows = [(0, 0, True, "x"), (0, 1, True, "y"), (1, None, None, None), (2, 0, True, "x"), (3, 0, False, None), (4, 0, True, "z")]
    summary = batches.batch_summary(outcomes(spark, rows))
    assert batches.run_summary(summary).head().asDict() == {
        "unique_records": 3, "successful_batches": 3, "failed_batches": 2,
    }
    assert [r.batch_id for r in batches.stagnant_batches(summary).collect()] == [2]
    offsets = {r.batch_id: r.item_offset for r in batches.batch_offsets(summary).collect()}
    assert offsets == {0: 0, 1: 2, 2: 2, 3: 2, 4: 2}


def test_run_summary_of_nothing(spark):
    empty = batches.batch_summary(outcomes(spark, []))
    assert tuple(batches.run_summary(empty).head()) == (0, 0, 0)


@pytest.mark.parametrize("ranges", [None, 9])
def test_failure_cutoff(spark, ranges):
    runs = {"a": [1, 0, 0, 1, 0, 0, 0, 0, 1], "b": [0, 0, 1, 0, 0], "c": [0] * 6}
    rows = [(g, i, v) for g, values in runs.items() for i, v in enumerate(values)]
    frame = spark.createDataFrame(rows, "g string, batch_id bigint, valid bigint")
    stops = batches.failure_cutoff(frame, 2, ["g"], ranges=ranges)
    assert {r.g: r.stop_batch for r in stops.collect()} == {"a": 6, "c": 2}
    later = batches.failure_cutoff(frame, 5, ["g"], ranges=ranges)
    assert {r.g: r.stop_batch for r in later.collect()} == {"c": 5}
    only_b = frame.where("g = 'b'")
    assert batches.failure_cutoff(only_b, 2).collect() == []


def test_preview(spark):
    frame = spark.createDataFrame([(1, 0, "é", "b"), (0, 1, "c", "d")], "batch_id bigint, pos int, anchor string, positive string")
    got = [r.preview for r in dedup.preview(frame, built_in("pair"), rows=2).orderBy("batch_id").collect()]
    assert got == ['{\n  "anchor": "c",\n  "positive": "d"\n}', '{\n  "anchor": "é",\n  "positive": "b"\n}']


def test_totals_of_sparse_keys(spark):
    """Keys far apart fall into ranges of about equal size, as many as are asked for."""
    rows = [((i * i * 2654435761) % (1 << 61), i % 3) for i in range(1, 2001)]
    frame = spark.createDataFrame(rows, "b bigint, n bigint")
    dealt = running._in_ranges(frame, "b", (), 300).groupBy("__range").count().collect()
    assert len(dealt) > 256 and max(r["count"] for r in dealt) < 30
    got = with_totals_before(frame, "b", {"before": F.col("n")}, ranges=300)
    before, expected = 0, []
    for b, n in sorted(rows):
        expected.append((b, before))
        before += n
    assert sorted((r.b, r.before) for r in got.collect()) == expected


def test_totals_of_sparse_keys_in_groups(spark):
    rng = random.Random(4)
    rows = [("a" if i % 3 else "b", rng.randrange(-(2**62), 2**62), i % 5) for i in range(400)] + [("c", None, 1)]
    frame = spark.createDataFrame(rows, "g string, b bigint, n int")
    totals = with_totals_before(frame, "b", {"before": F.col("n")}, ["g"], 40)
    dealt = running._in_ranges(frame, "b", ("g",), 40).groupBy("__range").count().collect()
    assert len(dealt) > 30 and max(r["count"] for r in dealt) < 40
    expected, seen = [], {"a": 0, "b": 0}
    for g, b, n in sorted((r for r in rows if r[1] is not None), key=lambda r: r[1]):
        expected.append((g, b, seen[g]))
        seen[g] += n
    assert sorted((r.g, r.b, r.before) for r in totals.collect()) == sorted(expected)


def test_rows_without_a_key_are_left_out(spark):
    frame = spark.createDataFrame([("a", 1, 5), ("a", None, 7), ("a", 2, 1)], "g string, b bigint, n bigint")
    got = with_totals_before(frame, "b", {"before": F.col("n")}, ["g"]).collect()
    assert sorted((r.b, r.before) for r in got) == [(1, 0), (2, 5)]
    assert with_totals_before(frame.where("false"), "b", {"before": F.col("n")}).collect() == []
