"""Collocations and the bit vector against direct computations."""

import random
import re
import tracemalloc
from collections import Counter
from urllib.parse import urlparse

import numpy as np
import pyarrow.parquet as pq
import pytest

from framesift.llm import bits, collocations


def brute_collocations(rows, least, longest=4, top=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, longest + 1):
                f.update((lang, tuple(words[k : k + size])) for k in range(len(words) - size + 1))
    candidates = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    out = []
    for (lang, words), a in candidates.items():
        cuts = []
        for k in range(1, len(words)):
            l, r = f[lang, words[:k]], f[lang, words[k:]]
            cuts.append((2_000_000 * a // (l + r), k, l, r))
        score, _, l, r = min(cuts)
        inside = any(
            other == lang and len(longer) > len(words) and 100 * b >= 80 * a and any(longer[k : k + len(words)] == words for k in range(len(longer)))
            for (other, longer), b in candidates.items()
        )
        if not inside:
            out.append((lang, -score, -a, " ".join(words).encode(), l, r))
    ranked, place = [], Counter()
    for lang, score, a, phrase, l, r in sorted(out):
        place[lang] += 1
        if place[lang] <= top:
            ranked.append((lang, place[lang], phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(ranked)


def prose(seed, count):
    rng = random.Random(seed)
    fixed = ["Quick brown fox", "of the", "in\tspite of", "é ß ü", "a a a a a"]
    rows = []
    for _ in range(count):
        words = [f"w{min(rng.randint(0, 30), rng.randint(0, 30))}" for _ in range(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 5)):
            words.insert(rng.randint(0, len(words)), rng.choice(fixed) + rng.choice(["", ".", ", ", "\n", "\x0b"]))
        rows.append((rng.choice(["en", "de", None, "und"]), " ".join(words)))
    return rows


@pytest.mark.parametrize("block_words", [10, 1000])
def test_collocations_match_brute_force(spark, block_words, rows):
    said = prose(1, 250)
    docs = spark.createDataFrame(said, "lang string, text string").repartition(3)
    phrases, sizes = collocations.frequent_phrases(docs, least=5, block_words=block_words)
    found = {(r["lang"], r["phrase"]): (r["words"], r["f"]) for r in phrases.collect()}
    assert all(len(phrase.split(" ")) == words and f >= 5 for (_, phrase), (words, f) in found.items())
    assert dict(map(tuple, sizes.collect())) == {r[0]: r[6] for r in brute_collocations(said, 5)}
    if block_words > 10:
        got = rows(collocations.collocations(docs, least=5))
        assert got == brute_collocations(said, 5) and len({r[0] for r in got}) == 3 and len(got) > 60
        assert rows(collocations.collocations(docs, least=5, top=7)) == brute_collocations(said, 5, top=7)


def test_blocks_of_any_size_give_the_same_counts(spark, rows):
    docs = spark.createDataFrame(prose(2, 60), "lang string, text string")
    few, many = (collocations.frequent_phrases(docs, least=3, block_words=n)[0] for n in (5, 100_000))
    assert rows(few) == rows(many)


def test_odd_rows(spark, odd, rows):
    got = rows(collocations.collocations(odd, least=2))
    # 'same words here' occurs three times; its parts lie inside it. 20,000 words in a row overlap.
    assert [r[:3] for r in got] == [("und", 1, "same words here"), ("und", 2, "word word word word")]
    assert got[0][3:6] == (3, 3, 3) and got[1][3] == 19_997
    assert collocations.collocations(odd.limit(0), least=2).collect() == []
    assert collocations.collocations(odd, least=10**6).collect() == []


def test_large_products_stay_exact(spark):
    """Counts whose products with the scale pass 64 bits."""
    a = 9_000_000_000_000
    schema = "lang string, phrase string, words int, f bigint"
    phrases = spark.createDataFrame([("en", "x", 1, a + 1), ("en", "y", 1, a + 2), ("en", "x y", 2, a)], schema)
    row = collocations.scored(phrases).first()
    assert row["score"] == 2_000_000 * a // (2 * a + 3)


def test_bit_vector_holds_every_key(spark):
    rng = np.random.default_rng(1)
    keys = rng.integers(-(2**63), 2**63 - 1, 20_000)
    vector = bits.bit_vector(spark.createDataFrame([(int(k),) for k in keys], "k bigint"), "k")
    assert bits.may_hold(vector, keys.view(np.uint64)).all()
    others = rng.integers(-(2**63), 2**63 - 1, 20_000).view(np.uint64)
    assert bits.may_hold(vector, others).mean() < 0.05
    assert not bits.may_hold(bits.bit_vector(spark.range(0), "id"), others).any()


def test_bit_vector_sums_one_row_a_key(spark, monkeypatch):
    def refused(*columns):
        raise AssertionError("keys were multiplied")

    monkeypatch.setattr(bits.F, "explode", refused)
    ids = np.array([*range(0, 5000, 7), 2**40, 2**63 - 1], np.int64)
    vector = bits.bit_vector(spark.createDataFrame([(int(k),) for k in ids], "k bigint"), "k")
    assert bits.may_hold(vector, ids.view(np.uint64)).all()
    assert bits.may_hold(vector, np.arange(1, 5000, 7, dtype=np.uint64)).mean() < 0.05


def test_counting_keys_remembers_no_phrases():
    class Every:
        value = np.full(1 << 10, 2**64 - 1, np.uint64)

    def blocks():
        for k in range(40):
            words = [f"word{k}x{j}" for j in range(20_000)]
            yield collocations._batch("en", words, np.ones(20_000, np.int32), np.arange(20_000, dtype=np.int32)).select(["lang", "phrases", "gaps", "ids"])

    tracemalloc.start()
    try:
        found = sum(batch.column(1).to_numpy().sum() for batch in collocations._count_keys(Every)(blocks()))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert found == 40 * 19_999 and most < 72_000_000


def test_relations_have_small_row_groups(spark):
    """A task holds a row group as a whole when it writes or reads one; rows are large."""
    words = "transform(sequence(1, 20000), x -> concat('w', pmod(hash(x, id), 20000)))"
    docs = spark.range(0, 120, 1, 1).selectExpr("'en' AS lang", f"array_join({words}, ' ') AS text")
    _, sizes = collocations.frequent_phrases(docs, longest=1, block_words=20_000)
    groups = []
    for file in sizes.inputFiles():
        meta = pq.ParquetFile(urlparse(file).path).metadata
        groups += [meta.row_group(k) for k in range(meta.num_row_groups)]
    assert sum(g.num_rows for g in groups) == 120
    assert max(g.total_byte_size for g in groups) < 12 << 20


def test_keys_of_pairs_are_short():
    class Every:
        value = np.full(1 << 10, 2**64 - 1, np.uint64)

    block = collocations._batch("en", [f"w{k}" for k in range(1000)], np.ones(1000, np.int32), np.arange(1000, dtype=np.int32)).select(["lang", "phrases", "gaps", "ids"])
    (batch,) = collocations._count_keys(Every)([block])
    keys = batch.column(0).to_numpy()
    assert len(keys) == 999 and keys.min() >= 0 and keys.max() < 1 << 44
