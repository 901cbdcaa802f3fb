import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from framesift.functions import frames

LENGTHS = [1, 2, 3, 5, 7, 11, 12, 16, 17, 29, 49, 50, 51, 64, 97, 100, 255, 300, 499, 1000]


@pytest.fixture(scope="module")
def lengths(spark):
    return spark.createDataFrame([(n,) for n in LENGTHS], "n int")


def run(lengths, expression):
    return {r["n"]: r["f"] for r in lengths.select("n", expression.alias("f")).collect()}


def test_points(lengths):
    got = run(lengths, frames.frames_at_points(F.col("n"), (0.1, 0.29, 0.5, 0.9, 1.0)))
    assert got == {n: [min(int(p * n), n - 1) for p in (0.1, 0.29, 0.5, 0.9, 1.0)] for n in LENGTHS}


@pytest.mark.parametrize("k", [1, 3, 4, 16])
def test_segment_mid(lengths, k):
    def want(n):
        size = (n - 1) / k
        return [int(size / 2) + int(np.round(size * i)) for i in range(k)]

    assert run(lengths, frames.frames_segment_mid(F.col("n"), k)) == {n: want(n) for n in LENGTHS}


def intervals(n, k):
    edges = np.linspace(start=0, stop=n, num=min(n, k) + 1).astype(int)
    return [(int(a), int(b) - 1) for a, b in zip(edges, edges[1:])]


@pytest.mark.parametrize("k", [1, 7, 12, 49])
def test_uniform(lengths, k):
    def want(pick):
        out = {}
        for n in LENGTHS:
            chosen = [pick(a, b) for a, b in intervals(n, k)]
            out[n] = chosen + [chosen[-1]] * (k - len(chosen))
        return out

    assert run(lengths, frames.frames_uniform(F.col("n"), k)) == want(lambda a, b: (a + b) // 2)
    assert run(lengths, frames.frames_uniform(F.col("n"), k, fix_start=0)) == want(lambda a, b: a)
    draws = F.array(*[F.lit(0.999)] * k)
    assert run(lengths, frames.frames_uniform(F.col("n"), k, draws=draws)) == want(lambda a, b: b if b >= a else a)


@pytest.mark.parametrize("rate,fps", [(0.5, 24.0), (1.0, 30.0), (3.0, 29.97), (2.0, 60.0)])
def test_rate(lengths, rate, fps):
    def want(n):
        duration, delta = n / fps, 1 / rate
        at = np.arange(0 + delta / 2, duration + delta / 2, delta)
        return [int(f) for f in np.around(at * fps).astype(int) if f < n]

    assert run(lengths, frames.frames_at_rate(F.col("n"), rate, F.lit(fps))) == {n: want(n) for n in LENGTHS}
    assert all(len(f) <= 2 for f in run(lengths, frames.frames_at_rate(F.col("n"), rate, F.lit(fps), 2)).values())


@pytest.mark.parametrize("target,source", [(3, 60), (24, 60), (7, 30)])
def test_resample(lengths, target, source):
    def want(n):
        at = np.round(np.arange(0, (n - 1) / source, 1 / target) * source).astype(int)
        return [int(i) for i in at if i < n]

    assert run(lengths, frames.resample_frames(F.col("n"), target, source)) == {n: want(n) for n in LENGTHS}


@pytest.mark.parametrize("draw", [0.0, 0.37, 0.9999])
def test_crop(lengths, draw):
    def want(n, k=17, interval=3):
        begin = int(draw * (max(0, n - k * interval - 1) + 1))
        end = min(begin + k * interval, n)
        return [int(i) for i in np.linspace(begin, end - 1, k, dtype=int)] if end - begin >= k else None

    got = run(lengths, frames.temporal_crop(F.col("n"), 17, 3, F.lit(draw), on_short="null"))
    assert got == {n: want(n) for n in LENGTHS}
    with pytest.raises(PySparkException):
        run(lengths, frames.temporal_crop(F.col("n"), 17, 3, F.lit(draw)))


def test_paired(lengths):
    def want(n, k=16, rate=3):
        span = k * rate
        end, count = (span, k) if n >= span else (n, int(n / span * k))
        return [int(i) for i in np.linspace(0, end - 1, count, dtype=int)]

    assert run(lengths, frames.paired_frames(F.col("n"), 16, 3)) == {n: want(n) for n in LENGTHS}


def test_fixed_pairs(lengths):
    got = run(lengths, frames.consecutive_pairs(frames.frames_fixed(F.col("n"))))
    assert [tuple(p) for p in got[17]] == [(0, 10), (10, 16), (16, 16)]


@pytest.mark.parametrize("kind", ["image", "video"])
def test_crop_box(spark, kind):
    cases = [(h, w, th, tw) for h in (97, 240, 1080) for w in (131, 426, 1921) for th, tw in ((64, 64), (144, 256), (333, 77))]
    df = spark.createDataFrame(cases, "h int, w int, th int, tw int")
    got = df.select("*", frames.crop_box(F.col("h"), F.col("w"), F.col("th"), F.col("tw"), kind).alias("b")).collect()
    for r in got:
        rh, rw = r["th"] / r["h"], r["tw"] / r["w"]
        if rh > rw:
            sh, sw = r["th"], round(r["w"] * rh)
            gap = (sw - r["tw"]) / 2
            want = (sh, sw, 0, round(gap) if kind == "image" else int(gap))
        else:
            sh, sw = round(r["h"] * rw), r["tw"]
            gap = (sh - r["th"]) / 2
            want = (sh, sw, round(gap) if kind == "image" else int(gap), 0)
        assert tuple(r["b"]) == want
