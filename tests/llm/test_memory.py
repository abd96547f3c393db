"""What a task holds at once is bounded, whatever the size of its partition."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from haulage.llm import minhash, storing, suffixes, toxicity, words


def held_mb(run) -> float:
    run()  # tables of powers and the like stay
    tracemalloc.start()
    run()
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return most / 1e6


def texts(mb: float, seed: int = 1) -> pa.Array:
    draw = np.random.default_rng(seed)
    return pa.array([" ".join(f"w{i}" for i in draw.integers(0, 10**6, 250)) for _ in range(int(mb * 1e6) // 2000)])


def test_rows_reach_python_in_batches_of_bounded_bytes(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "bytes"])

    rows = spark.range(1600).coalesce(1).select(F.repeat(F.lit("x"), 10_000).alias("text"))
    found = storing.stored(rows.mapInArrow(sizes, "n long, bytes long"), "sizes").agg(F.sum("n"), F.max("bytes")).first()
    assert found[0] == 1600 and found[1] < 1.5 * storing.BATCH_BYTES


@pytest.mark.parametrize("name", ["sketches", "toxicity", "runs"])
def test_working_arrays_do_not_grow_with_the_batch(name):
    column = texts(3)
    run = {
        "sketches": lambda: sum(n for n, *_ in minhash.shingle_sets(column)),
        "toxicity": lambda: sum(len(bounds) for _, bounds in toxicity.features(column)),
        "runs": lambda: sum(1 for _ in suffixes._runs_by_row(column, suffixes.WINDOW, suffixes.GRAM)),
    }[name]
    assert held_mb(run) < 25


def test_a_load_of_buckets_is_small():
    draw = np.random.default_rng(3)
    forms = [(g, f, 40, f, 0, draw.integers(97, 101, 139).astype(np.uint8).tobytes()) for g in range(600) for f in range(30)]
    batches = [suffixes._batch(suffixes.FORMS, list(zip(*forms[i : i + 5000], strict=True))) for i in range(0, len(forms), 5000)]
    run = lambda: list(suffixes._sorted_late(suffixes.WINDOW, suffixes.LOAD_BYTES, suffixes.PART)(iter(batches)))
    assert held_mb(run) < 60


@pytest.mark.parametrize("letters", [1, 2, 4])
def test_a_run_is_named_by_the_first_least_gram_of_its_windows(letters):
    window, gram = 50, 11
    draw = np.random.default_rng(letters)
    data = draw.integers(97, 97 + letters, 1500).astype(np.uint8)
    ends = np.array([0, 30, 400, 400, 1100, 1500])
    place, n, grams, _ = suffixes.runs_of(data, ends, window, gram)
    hashes = words.byte_grams(data, gram)
    bits = np.uint64(suffixes.PLACE_BITS)
    covered = []
    for p, m, g in zip(place.tolist(), n.tolist(), grams.tolist(), strict=True):
        for w in range(p, p + m):
            inner = hashes[w : w + window - gram + 1]
            assert inner[np.argmin(inner >> bits)].view(np.int64) == g
            covered.append(w)
    inside = [w for a, b in zip(ends[:-1], ends[1:]) for w in range(a, b - window + 1)]
    assert covered == inside
    with pytest.raises(ValueError, match="at most"):
        suffixes.runs_of(np.zeros((1 << suffixes.PLACE_BITS) + 1, np.uint8), ends, window, gram)
