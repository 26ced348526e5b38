"""Product codes against plain Python integers, and the cases the docstring defines."""

import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from recordloom.llm import vector_codes


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 9), st.integers(1, 12), st.sampled_from([1, 3, 1 << 20, 1 << 60]), st.integers(0, 2**31))
def test_nearest_is_exact(size, entries, most, seed):
    rng = np.random.default_rng(seed)
    parts, books = rng.integers(-most, most + 1, (20, size)), rng.integers(-most, most + 1, (entries, size))
    index, distance = vector_codes.nearest(parts, books)
    whole = ((parts[:, None].astype(object) - books[None].astype(object)) ** 2).sum(axis=2)
    assert index.tolist() == whole.argmin(axis=1).tolist() and distance.tolist() == whole.min(axis=1).tolist()


def test_coefficients_stand_in_sequency_order():
    rows = vector_codes.walsh_hadamard(np.eye(16, dtype=np.int64)).T
    assert [int((np.diff(np.sign(r)) != 0).sum()) for r in rows] == list(range(16))
    assert (rows @ rows.T == 16 * np.eye(16)).all()


def plain(rows, parts, entries, rounds, scale):
    """The same in plain Python: id, code, error, label_error, digest per row."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    width = -(-max(len(v) for _, v, _ in kept) // parts) * parts
    cut = []
    for _, v, _ in kept:
        n = [math.floor(scale * x) for x in v] + [0] * (width - len(v))
        cut.append([n[i : i + width // parts] for i in range(0, width, width // parts)])
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, kept[i][1]))
    books = [[cut[i][p] for i in order[:entries]] for p in range(parts)]

    def assign():
        far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
        return [[min((far(c[p], e), k) for k, e in enumerate(books[p])) for p in range(parts)] for c in cut]

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                own = [cut[i][p] for i in range(len(cut)) if found[i][p][1] == k]
                if own:
                    books[p][k] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    found = assign()
    errors = [sum(d for d, _ in f) for f in found]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    of = {}
    for (_, _, label), e in zip(kept, errors, strict=True):
        of[label] = of.get(label, 0) + e
    return sorted(((r[0], "".join(f"{k:02x}" for _, k in f), e, of[r[2]], digest) for r, f, e in zip(kept, found, errors, strict=True)), key=repr)


@pytest.mark.parametrize("parts, entries, width", [(4, 8, 12), (3, 5, 7), (2, 64, 2)])
def test_codes_equal_plain_python(spark, parts, entries, width):
    rng = random.Random(width)
    rows = [(i * 7 % 101, [rng.uniform(-1, 1) for _ in range(width)], rng.choice([None, 1, 2, 2, 2])) for i in range(90)]
    rows += [(200 + i, rows[0][1], 3) for i in range(20)]  # copies
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(5)
    got = vector_codes.compress(frame, parts=parts, entries=entries, rounds=2)
    assert sorted(map(tuple, got.collect()), key=repr) == plain(rows, parts, entries, 2, 256)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, -0.004], 1),
        (1, [0.5, 0.25], 1),
        (1, [0.5, 0.25], 1),
        (None, [3.0], None),
        (2, None, 1),
        (3, [nan, 1.0], 1),
        (4, [inf, 1.0], 1),
        (5, [None, 1.0], None),
        (6, [], 4),
        (7, [70000.0, -1e9], 4),
    ]
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], "vec_id long, embedding array<double>, label int, CODE string, error_ string")
    got = vector_codes.compress(frame, parts=2, entries=4, rounds=2)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain(rows, 2, 4, 2, 256)
    huge = spark.createDataFrame([(1, [1e300], 1), (2, [2.0**51], 1), (3, [-(2.0**51)], 1)], "vec_id long, embedding array<double>, label int")
    assert {r.vec_id: r.error for r in vector_codes.compress(huge, parts=1, entries=1).collect()} == {2: None, 3: None}


def test_no_vectors(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert vector_codes.compress(frame).collect() == []
    assert vector_codes.compress(frame, label_column=None).columns == ["vec_id", "code", "error", "codebooks_sha256"]
    one = spark.createDataFrame([(None, [0.5], 1)], "vec_id long, embedding array<float>, label int")
    assert [(r.code, r.error, r.label_error) for r in vector_codes.compress(one).collect()] == [("00" * 16, 0, 0)]
