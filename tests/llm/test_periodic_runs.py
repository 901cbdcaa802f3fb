"""Lyndon groups and periodic runs against their definitions."""

import random
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest

from framesift.llm import periodic_runs
from framesift.llm.queries import QUERIES


def brute_runs(items, least=6, periods=4):
    """Maximal stretches by trying every period at every place."""
    n, out = len(items), set()
    for q in range(1, n // periods + 1):
        at = 0
        while at + q < n:
            end = at
            while end + q < n and items[end] == items[end + q]:
                end += 1
            length = end + q - at
            stretch = items[at : at + length]
            if length >= max(least, periods * q) and not any(stretch[r:] == stretch[:-r] for r in range(1, q)):
                out.add((at, length, q))
            at = end + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def sequences(seed, count):
    rng = random.Random(seed)
    for _ in range(count):
        alphabet = rng.randint(0, 3)
        items = [rng.randint(0, alphabet) for _ in range(rng.randint(0, 30))]
        if rng.random() < 0.7:
            root = [rng.randint(0, alphabet) for _ in range(rng.randint(1, 6))]
            items = items[:5] + (root * 12)[: rng.randint(1, 50)] + items[5:]
        yield items


def test_lyndon_groups_match_their_definition():
    for items in sequences(1, 300):
        lengths, names = periodic_runs.lyndon_groups(items)
        for at in range(len(items)):
            words = [items[at:end] for end in range(at + 1, len(items) + 1)]
            assert lengths[at] == max(len(w) for w in words if all(w < w[k:] for k in range(1, len(w))))
        found = {(tuple(items[at : at + length]), name) for at, (length, name) in enumerate(zip(lengths, names))}
        assert len(found) == len({w for w, _ in found}) == len({name for _, name in found})


def test_runs_match_brute_force():
    for items in sequences(2, 2000):
        assert periodic_runs.find_runs(np.array(items, np.int64)) == brute_runs(items)
        assert periodic_runs.find_runs(np.array(items, np.int64), 0, 3) == brute_runs(items, 0, 3)


def test_long_sequences_take_linear_work():
    a, b = [0], [0, 1]
    while len(b) < 50_000:
        a, b = b, b + a
    runs = periodic_runs.find_runs(np.array(b, np.int64), 0, 3)
    assert len(runs) > 10_000 and all(n >= 3 * q for _, n, q in runs)
    assert periodic_runs.find_runs(np.zeros(100_000, np.int64)) == [(0, 100_000, 1)]
    with pytest.raises(ValueError):
        periodic_runs.find_runs(np.zeros(9, np.int64), 0, 2)


def brute_row(doc_id, text):
    words = (text or "").encode().split()
    if doc_id is not None and words and crc32(str(doc_id).encode()) % 10 == 0:
        g, n = crc32(str(doc_id).encode()) // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    kept = [w for k, w in enumerate(words) if not any(s + q <= k < s + n for s, n, q in runs)]
    shown = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    digest = sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
    return (doc_id, len(runs), *shown, digest, sha256(b" ".join(kept)).hexdigest())


def test_query_matches_brute_force(spark, documents, tmp_path, rows):
    rng = random.Random(3)
    texts = []
    for _ in range(150):
        words = [f"w{rng.randint(0, 6)}" for _ in range(rng.randint(0, 60))]
        root = [f"v{rng.randint(0, 2)}" for _ in range(rng.randint(1, 5))]
        texts.append(" ".join(words[:20] + root * rng.randint(0, 8) + words[20:]))
    documents(texts).write.parquet(f"{tmp_path}/documents.parquet")
    got = rows(QUERIES["op13_periodic_runs"](spark, str(tmp_path)))
    assert got == sorted(brute_row(i, t) for i, t in enumerate(texts))
    assert any(r[1] > 1 for r in got) and sum(crc32(str(i).encode()) % 10 == 0 for i in range(150)) > 5


def test_odd_rows(odd):
    found = {r["doc_id"]: r for r in periodic_runs.detect_runs(odd, fold=True).collect()}
    assert periodic_runs.detect_runs(odd).count() == 12
    for i in (0, 1, 2, 9):
        assert found[i]["runs"] == [] and found[i]["strongest"] is None and found[i]["collapsed"] == ""
    assert found[8]["collapsed"] == "word" and found[8]["strongest"]["length"] == 20_000
    assert found[None]["collapsed"] == "é😀 ß zwei"
    assert periodic_runs.detect_runs(odd.limit(0)).collect() == []
    assert periodic_runs.detect_runs(odd).columns == ["doc_id", "runs", "strongest", "collapsed"]
