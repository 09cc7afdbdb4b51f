"""Frozen runs in chunks against a greedy scan."""

import random

import numpy as np
import pytest

from gustline.operators import frozen as Z
from conftest import stamp


def greedy(values, length=5):
    blocks = samples = i = 0
    while i < len(values) - length:
        if values[i] is None:
            i += 1
            continue
        j = i + 1
        while j < len(values) and values[j] is not None and abs(values[j] - values[i]) < 1.0:
            j += 1
        if j - i >= length:
            blocks, samples = blocks + 1, samples + j - i
        i = j
    return blocks, samples


def wandering(rng, n):
    level, out = 10.0, []
    for _ in range(n):
        level += rng.choice([0, 0, 0.25, -0.25, 0.75, -0.75, 0.05, -0.05, 3])
        out.append(None if rng.random() < 0.03 else level)
    return out


@pytest.mark.parametrize("chunk,fan", [(3, 2), (16, 2), (512, 64)])
def test_chunks_give_the_greedy_runs(spark, chunk, fan):
    rng, rows, want = random.Random(chunk), [], {}
    for t in range(25):
        series = wandering(rng, rng.randrange(1, 170))
        if t == 3:
            series = [None] * 40
        if t == 4:
            series = [7.0] * 150
        want[f"T{t:02d}"] = greedy(series)
        begin = rng.randrange(40)
        rows += [(f"T{t:02d}", stamp(begin + i), v) for i, v in enumerate(series)]
    df = spark.createDataFrame(rows, "turbine_id string, ts timestamp_ntz, power double").repartition(3)
    assert {r.turbine_id: (r.frozen_blocks, r.frozen_samples) for r in Z.frozen_runs(df, chunk=chunk, fan=fan).collect()} == want


def test_slots_without_a_row_are_missing_readings(spark):
    rows = [("A", stamp(i), 5.0) for i in range(60) if not 20 <= i < 43]
    df = spark.createDataFrame(rows, "turbine_id string, ts timestamp_ntz, power double")
    r = Z.frozen_runs(df, chunk=8, fan=2).first()
    assert (r.frozen_blocks, r.frozen_samples, r.n_rows) == (2, 37, 37)
    assert Z.frozen_runs(df.limit(0)).collect() == []


def test_one_piece_of_a_million_wandering_readings():
    """Steps below the band that never repeat: one piece, read chunk by chunk in little memory."""
    rng = np.random.default_rng(5)
    values = np.cumsum(rng.normal(0, 0.2, 1_000_000))
    last = len(values) - 1
    level = [Z.table_of(values[low : low + Z.CHUNK], low, last) for low in range(0, len(values), Z.CHUNK)]
    largest = 0
    while len(level) > 1:
        largest = max(largest, *(len(t.highs) + len(t.lows) for t in level))
        level = [Z.joined(level[k : k + Z.FAN]) for k in range(0, len(level), Z.FAN)]
    blocks, samples, start, _ = level[0].fresh
    one, length = level[0].closed(start, len(values))
    want_blocks = want_samples = i = 0
    band = values.tolist()
    while i < len(band):
        j = i + 1
        while j < len(band) and abs(band[j] - band[i]) < 1.0:
            j += 1
        if j - i >= 5 and i <= last - 5:
            want_blocks, want_samples = want_blocks + 1, want_samples + j - i
        i = j
    assert (blocks + one, samples + length) == (want_blocks, want_samples)
    assert largest < 3000  # what a task holds of one stretch, however long the piece is
