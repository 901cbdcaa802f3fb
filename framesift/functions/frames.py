"""Which frames of a clip to look at: index arrays as expressions of clip length."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sampling points by number of frames, per job.
CAPTION_POINTS = {1: (0.5,), 2: (0.25, 0.75), 3: (0.1, 0.5, 0.9)}
AESTHETIC_POINTS = {1: (0.5,), 2: (0.25, 0.5), 3: (0.1, 0.5, 0.9)}
FLOW_FRAMES = (0, 10, 20, 30)


def clamp(index: Column, length: Column) -> Column:
    return F.least(index.cast("int"), (length - 1).cast("int"))


def frames_at_points(length: Column, points: Sequence[float]) -> Column:
    """Frame ``int(p * length)`` per point, at most the last one."""
    return F.array(*[clamp(F.floor(F.lit(float(p)) * length), length) for p in points])


def frames_fixed(length: Column, frames: Sequence[int] = FLOW_FRAMES) -> Column:
    return F.array(*[clamp(F.lit(f), length) for f in frames])


def consecutive_pairs(frames: Column) -> Column:
    """(first, second) structs of neighbouring entries."""
    return F.transform(
        F.slice(frames, F.lit(1), F.greatest(F.size(frames) - 1, F.lit(0))),
        lambda a, i: F.struct(a.alias("first"), F.get(frames, i + 1).alias("second")),
    )


def _upto(n: Column) -> Column:
    """0 .. n-1, empty when n < 1."""
    return F.when(n > 0, F.sequence(F.lit(0), (n - 1).cast("int"))).otherwise(F.array().cast("array<int>"))


def frames_segment_mid(length: Column, segments: int) -> Column:
    """Start in the middle of the first of ``segments`` equal parts, then one part further each."""
    size = (length.cast("double") - 1) / segments
    start = (size / 2).cast("int")
    return F.transform(_upto(F.lit(segments)), lambda i: start + F.bround(size * i).cast("int"))


def _interval_edges(length: Column, parts: Column) -> Column:
    """parts + 1 truncated edges of equal intervals of [0, length]."""
    step = length.cast("double") / parts
    return F.transform(
        _upto(parts + 1), lambda i: F.when(i == parts, length.cast("int")).otherwise(F.floor(i * step).cast("int"))
    )


def frames_uniform(
    length: Column, count: int, draws: Column | None = None, fix_start: int | None = None
) -> Column:
    """One frame from each of ``count`` equal intervals; short clips repeat their last choice.

    The middle by default, ``fix_start`` frames after each start, or by ``draws`` (an array of
    uniforms, one per interval) anywhere inside.
    """
    parts = F.least(F.lit(count), length)
    edges = _interval_edges(length, parts)

    def pick(i: Column) -> Column:
        first = F.get(edges, i)
        last = F.get(edges, i + 1) - 1
        if draws is not None:
            return (first + F.floor(F.get(draws, i) * (last - first + 1))).cast("int")
        if fix_start is not None:
            return first + fix_start
        return F.floor((first + last) / 2).cast("int")

    chosen = F.transform(_upto(parts), pick)
    tail = F.array_repeat(F.get(chosen, parts - 1), F.lit(count) - parts)
    return F.when(length > 0, F.concat(chosen, tail))


def _arange_size(stop: Column, start: Column, step: Column) -> Column:
    return F.greatest(F.ceil((stop - start) / step), F.lit(0)).cast("int")


def frames_at_rate(length: Column, rate: float, input_fps: Column, most: int = -1) -> Column:
    """Frames at ``rate`` per second, each in the middle of the time it stands for."""
    duration = length.cast("double") / input_fps
    delta = F.lit(1.0 / rate)
    half = F.lit(1.0 / rate / 2)
    count = _arange_size(duration + half, half, delta)
    stride = (half + delta) - half
    frames = F.transform(_upto(count), lambda i: F.bround((half + i * stride) * input_fps).cast("int"))
    frames = F.filter(frames, lambda f: f < length)
    return F.slice(frames, F.lit(1), F.lit(most)) if most > 0 else frames


def resample_frames(length: Column, target_fps: float = 3, source_fps: float = 60) -> Column:
    """Frames of a ``source_fps`` clip that survive conversion to ``target_fps``."""
    duration = (length.cast("double") - 1) / float(source_fps)
    step = F.lit(1.0 / target_fps)
    count = _arange_size(duration, F.lit(0.0), step)
    frames = F.transform(_upto(count), lambda i: F.bround(i * step * F.lit(float(source_fps))).cast("int"))
    return F.filter(frames, lambda f: f < length)


def truncated_linspace(start: Column, last: Column, count: Column) -> Column:
    """``count`` evenly spaced whole numbers from start to last, rounded down."""
    step = (last - start).cast("double") / F.greatest(count - 1, F.lit(1))
    return F.transform(
        _upto(count),
        lambda i: F.when((i == count - 1) & (count > 1), last).otherwise(F.floor(i * step + start)).cast("int"),
    )


def temporal_crop(length: Column, count: int, interval: int, draw: Column, on_short: str = "error") -> Column:
    """``count`` frames spread over a randomly placed window of ``count * interval`` frames.

    A clip with fewer than ``count`` frames raises, or gives NULL with ``on_short='null'``.
    """
    size = count * interval
    room = F.greatest(F.lit(0), length - size - 1)
    begin = F.floor(draw * (room + 1)).cast("int")
    end = F.least(begin + size, length)
    frames = truncated_linspace(begin, (end - 1).cast("int"), F.lit(count))
    short = F.raise_error(F.lit(f"fewer than {count} frames")) if on_short == "error" else F.lit(None)
    return F.when(end - begin >= count, frames).otherwise(short)


def paired_frames(length: Column, count: int, rate: int) -> Column:
    """``count`` frames over the first ``count * rate``; a shorter clip gives proportionally fewer."""
    span = count * rate
    long_enough = length >= span
    end = F.when(long_enough, F.lit(span)).otherwise(length).cast("int")
    taken = F.when(long_enough, F.lit(count)).otherwise((length / span * count).cast("int"))
    return truncated_linspace(F.lit(0), end - 1, taken)


def crop_box(height: Column, width: Column, target_h: Column, target_w: Column, kind: str = "image") -> Column:
    """Scale that fills the target and the offsets of the centred crop.

    Images round the offset half to even, videos cut it off.
    """
    rh, rw = target_h / height, target_w / width
    tall = rh > rw
    sh = F.when(tall, target_h).otherwise(F.bround(height * rw)).cast("int")
    sw = F.when(tall, F.bround(width * rh)).otherwise(target_w).cast("int")

    def centre(scaled: Column, target: Column) -> Column:
        gap = (scaled - target) / 2
        return (F.bround(gap) if kind == "image" else gap).cast("int")

    return F.struct(
        sh.alias("scaled_h"),
        sw.alias("scaled_w"),
        F.when(tall, 0).otherwise(centre(sh, target_h)).alias("top"),
        F.when(tall, centre(sw, target_w)).otherwise(0).alias("left"),
    )
