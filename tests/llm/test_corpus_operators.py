"""Joins, dedup, mixing, search and URL lists against direct computations."""

import os
import random
from contextlib import contextmanager
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from framesift import session
from framesift.llm import common, components, jaccard_join, line_dedup, mixing, topk, url_filters


# --- Jaccard join


def brute_groups(rows, percent=90):
    sets = {}
    for i, text in rows:
        words = (text or "").encode().lower().split()
        n = min(3, len(words)) or 1
        sets[i] = {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if words else set()
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in sets}


def near_copies(rng, n, size):
    words = [f"w{rng.randint(0, 400)}" for _ in range(size)]
    out = []
    for _ in range(n):
        copy = list(words)
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(size)] = f"v{rng.randint(0, 9)}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_near_groups_match_brute_force(documents, seed):
    rng = random.Random(seed)
    passage = " ".join(f"p{k}" for k in range(40))
    texts = [t for _ in range(12) for t in near_copies(rng, rng.randint(1, 12), rng.randint(5, 120))]
    texts += [passage + " " + " ".join(f"u{rng.random()}" for _ in range(rng.randint(0, 30))) for _ in range(20)]
    texts += ["A b", "a  B", "a", "", None, passage, passage.upper()]
    rng.shuffle(texts)
    got = {r[0]: (r[1], r[2]) for r in jaccard_join.near_groups(documents(texts)).collect()}
    assert got == brute_groups(list(enumerate(texts)))


def test_near_groups_odd_rows(odd):
    rows = sorted(map(tuple, jaccard_join.near_groups(odd).collect()), key=str)
    assert len(rows) == 12
    found = {r[0]: r[2] for r in rows}
    assert found[5] == found[6] == 5 and found[None] is None
    assert all(found[i] == i for i in (0, 1, 2, 3, 4, 7, 8, 9))
    assert jaccard_join.near_groups(odd.limit(0)).count() == 0


def test_parity_bits_never_rule_out_similar_sets():
    rng = np.random.default_rng(1)
    for _ in range(300):
        n = int(rng.integers(1, 400))
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[: len(a) - int(rng.integers(0, len(a) // 8 + 1))], rng.integers(0, 2**63, int(rng.integers(0, n // 8 + 1))).astype(np.uint64)]))
        shared = len(np.intersect1d(a, b))
        if 100 * shared >= 90 * (len(a) + len(b) - shared):
            x, y = jaccard_join.sketch(a), jaccard_join.sketch(b)
            assert 190 * int(np.bitwise_count((x ^ y).view(np.uint64)).sum()) <= 10 * (len(a) + len(b))
            assert jaccard_join.bits_allow(jaccard_join.parity_bits(a), jaccard_join.parity_bits(b), len(a), len(b), 90)


def test_long_sets_are_compared_in_classes_that_no_size_saturates(documents, monkeypatch):
    written = {}

    @contextmanager
    def spied(spark, job):
        with session.scratch(spark, job) as write:

            def noted(df, table):
                out = write(df, table)
                written[table] = out.count()
                return out

            yield noted

    monkeypatch.setattr(jaccard_join, "scratch", spied)
    rng = random.Random(4)
    passage = [f"p{k}" for k in range(300)]
    texts = [" ".join(passage + [f"{k}x{j}" for j in range(6000 + 10 * k)]) for k in range(12)]
    chain = [f"c{k}" for k in range(2060)]
    for size in (2060, 1950, 1855):
        texts.append(" ".join(f"n{size}x{k}" if k % 90 == size % 90 else w for k, w in enumerate(chain[:size])))
    rng.shuffle(texts)
    got = {r[0]: (r[1], r[2]) for r in jaccard_join.near_groups(documents(texts)).collect()}
    assert got == brute_groups(list(enumerate(texts)))
    assert written["pairs"] == 0


def test_a_group_of_copies_with_changes_of_their_own_takes_linear_work(documents, monkeypatch):
    written = {}

    @contextmanager
    def spied(spark, job):
        with session.scratch(spark, job) as write:

            def noted(df, table):
                out = write(df, table)
                written[table] = written.get(table, 0) + out.count()
                return out

            yield noted

    monkeypatch.setattr(jaccard_join, "scratch", spied)
    rng = random.Random(9)
    texts = []
    for group in range(2):
        base = [f"g{group}w{k}" for k in range(150)]
        for k in range(120):
            copy = list(base)
            copy[rng.randrange(150)] = f"own{group}x{k}"
            texts.append(" ".join(copy))
    rng.shuffle(texts)
    got = {r[0]: (r[1], r[2]) for r in jaccard_join.near_groups(documents(texts)).collect()}
    assert got == brute_groups(list(enumerate(texts)))
    # All pairs of the two groups are 14,280.
    assert written["candidates"] < 14 * 240 and written["pairs"] < 240


def test_pairs_come_out_of_the_join_once_a_stretch_of_common_tokens(spark, documents, monkeypatch):
    met, seen = jaccard_join.JaccardJoin._met, []
    monkeypatch.setattr(jaccard_join.JaccardJoin, "_met", lambda self, *tables: seen.append(met(self, *tables)) or seen[-1])
    base, texts = [f"w{k}" for k in range(200)], []
    for k in range(25):
        own = list(base)
        own[5 + 7 * k] = "changed"
        texts.append(" ".join(own))
    join = jaccard_join.JaccardJoin(documents(texts), "doc_id", "text", 3, 90, 2)
    pairs = join.remaining_candidates(spark.createDataFrame([], "node bigint, component bigint"), session.materialise)
    assert {tuple(r) for r in pairs.collect()} == {(a, b) for b in range(25) for a in range(b)}
    # Any pair shares a dozen tokens of its prefixes and more.
    assert seen[0].count() < 2 * 300


def test_word_hashes_tell_words_apart():
    text = "A b a\x00 a \x00a ab\x85 AB\x85 \xe9 abcdefgh abcdefghi\tabcdefghj " + "x" * 64 + "\x0b" + "x" * 65 + "\n" + "X" * 65 + " " + "x" * 66
    for said in (text, "", " \r\n", text * 3):
        words = common.plain_words(said)
        hashes = common.word_hashes(said).tolist()
        assert len(hashes) == len(words) and len(set(hashes)) == len(set(words)) == len(set(zip(words, hashes)))


def test_similar_sets_have_a_similar_class_of_one_level():
    rng = np.random.default_rng(2)
    for n in (1, 40, 1840, 1860, 2048, 2049, 4000, 4100, 9000):
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[: -(-len(a) * 96 // 100)], rng.integers(0, 2**63, n // 25).astype(np.uint64)]))
        for x, y in ((a, b), (a, a[: -(-len(a) * 9 // 10)])):
            shared = len(np.intersect1d(x, y))
            assert 100 * shared >= 90 * (len(x) + len(y) - shared)
            classes = [(u, v) for k, u in jaccard_join.pieces(x, 90) for m, v in jaccard_join.pieces(y, 90) if k == m]
            common = [(len(np.intersect1d(u, v)), len(u), len(v)) for u, v in classes]
            assert any(c and 100 * c >= 90 * (p + q - c) for c, p, q in common)
        assert all(len(u) < 2 * jaccard_join.PIECE for _, u in jaccard_join.pieces(a, 90))


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(50)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{k: 0 for k in range(51)}, **{k: 100 for k in range(100, 130)}, 200: 200, 201: 200}


# --- line dedup


def brute_lines(rows, threshold=2, shortest=20):
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, above = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
        return row[-1]

    blank = " \t\r\x0b\f"
    lines = [(i, k, x, x.strip(blank)) for i, t in sorted(rows) if t is not None for k, x in enumerate(t.split("\n"))]
    seen, first, out = {}, {}, {i: [] for i, t in rows if t is not None}
    for i, k, raw, line in lines:
        if line:
            first.setdefault(line if len(line) >= shortest else (i, line), (i, k))
    longs = [(x, at) for x, at in first.items() if isinstance(x, str)]
    near = {x for x, at in longs for y, other in longs if other < at and abs(len(x) - len(y)) <= threshold and distance(x, y) <= threshold}
    for i, k, raw, line in lines:
        name = line if len(line) >= shortest else (i, line)
        if not line or (first[name] == (i, k) and name not in near):
            out[i].append(raw)
    return {i: "\n".join(x) for i, x in out.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_line_dedup_matches_brute_force(documents, seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcde éf") for _ in range(rng.randint(1, 60))) for _ in range(25)]

    def line():
        x = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 3])):
            k = rng.randint(0, len(x))
            x[k : k + rng.randint(0, 1)] = rng.choice(["", "z", "q"])
        return rng.choice(["", " "]) + "".join(x)

    texts = ["\n".join(line() for _ in range(rng.randint(0, 6))) for _ in range(60)] + [None, "", "\n \n"]
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(documents(texts)).collect()}
    want = brute_lines(list(enumerate(texts)))
    assert {k: v for k, v in got.items() if v is not None} == want
    assert got[len(texts) - 3] is None


@pytest.mark.parametrize("threshold", [1, 2, 3])
def test_edit_distance_and_keys(spark, threshold):
    rng = random.Random(threshold)
    rows = []
    for _ in range(800):
        a = "".join(rng.choice("abcé😀") for _ in range(rng.randint(0, 14)))
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            k = rng.randint(0, len(b))
            b[k : k + rng.randint(0, 1)] = rng.choice(["", "a", "é"])
        rows.append((a, "".join(b)))
    pairs = spark.createDataFrame(rows, "a string, b string")
    a, b = F.col("a"), F.col("b")
    wrong = pairs.filter(line_dedup.edit_distance(a, b, threshold) != F.least(F.levenshtein(a, b), F.lit(threshold + 1)))
    assert wrong.count() == 0
    near = pairs.filter((F.char_length(a) > threshold) & (F.char_length(b) >= F.char_length(a)) & (F.levenshtein(a, b) <= threshold))
    shared = F.arrays_overlap(line_dedup.index_keys(a, F.char_length(a), threshold), line_dedup.probe_keys(b, F.char_length(b), threshold))
    assert near.filter(~F.coalesce(shared, F.lit(False))).count() == 0
    parities = F.bit_count(line_dedup.letter_parities(a).bitwiseXOR(line_dedup.letter_parities(b)))
    assert pairs.filter((F.levenshtein(a, b) <= threshold) & (parities > 2 * threshold)).count() == 0


def test_lines_with_the_same_letters_in_another_order_are_not_compared(documents, monkeypatch):
    compared = []

    def noted(df, table, write=line_dedup.materialise):
        out = write(df, table)
        if table == "line-pairs":
            compared.append(out.count())
        return out

    near = line_dedup.near_lines
    monkeypatch.setattr(line_dedup, "near_lines", lambda lines, keyed, first, threshold, *_: near(lines, keyed, first, threshold, noted))
    rng = random.Random(8)
    rest = " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(6))
    texts = ["".join(rng.sample("abcdefghijklmnopqrst", 20)) + " " + rest for _ in range(30)]
    texts += [texts[0][:30] + "0" + texts[0][31:], texts[5] + "zz"]
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(documents(texts)).collect()}
    assert got == brute_lines(list(enumerate(texts)))
    assert sum(compared) < 30


def test_keys_that_lines_share_are_found_without_an_index_of_their_own(documents, monkeypatch):
    near, held = line_dedup.near_lines, {}
    monkeypatch.setattr(line_dedup, "near_lines", lambda lines, keyed, *more: held.update(keyed=keyed.columns) or near(lines, keyed, *more))
    base = "the same line of forty characters or so"
    texts = [base, base + "!", "x" + base[1:], "a line of its own that nobody else has", "a line of its own that nobody else has", "short"]
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(documents(texts)).collect()}
    assert got == brute_lines(list(enumerate(texts)))
    # The keys of a line's own segments are among its probes and are neither worked out nor written twice.
    assert "_probe" in held["keyed"] and "_index" not in held["keyed"]


def test_pair_parities_never_rule_out_near_lines(spark):
    rng = random.Random(9)
    rows = []
    for _ in range(400):
        a = "".join(rng.choice("abé😀 ") for _ in range(rng.randint(1, 40)))
        b = list(a)
        for _ in range(2):
            k = rng.randrange(len(b) + 1)
            b[k : k + rng.randint(0, 1)] = rng.choice(["", "a", "é", "z"])
        rows.append((a, "".join(b) or "x"))
    pairs = spark.createDataFrame(rows, "a string, b string").filter(F.levenshtein("a", "b") <= 2)
    differing = F.bit_count(line_dedup.pair_parities(F.col("a")).bitwiseXOR(line_dedup.pair_parities(F.col("b"))))
    assert pairs.count() > 300 and pairs.filter(differing > 8).count() == 0
    assert pairs.select(line_dedup.pair_parities(F.col("a")).alias("p")).distinct().count() > 300


def test_intermediate_tables_go_with_the_job(documents, monkeypatch, tmp_path):
    monkeypatch.setattr(session, "shared_folder", lambda spark: str(tmp_path))
    docs = documents(["a line that is long enough to be compared " * 2 + c for c in "abcc"])
    lines, groups = line_dedup.dedup_lines(docs), jaccard_join.near_groups(docs)
    left = sorted(p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir())
    assert [x for x in left if x != "links"] == ["groups", "removed-lines"]
    assert lines.count() == groups.count() == 4


def test_line_dedup_odd_rows(odd):
    rows = line_dedup.dedup_lines(odd)
    assert rows.columns == [*odd.columns, "n_lines", "n_repeated", "n_near"]
    got = rows.collect()
    assert len(got) == 12 and sum(r["n_repeated"] + r["n_near"] for r in got) == 0
    assert line_dedup.dedup_lines(odd.limit(0)).count() == 0


def test_line_dedup_keeps_the_first_and_stays_in_the_engine(documents):
    line = "a line that is long enough to count"
    docs = documents([f"x\n{line}", f"{line}\ny", f"{line}!\nz"], [7, 3, None])
    got = {r["doc_id"]: (r["text"], r["n_repeated"], r["n_near"]) for r in line_dedup.dedup_lines(docs).collect()}
    assert got == {7: ("x", 1, 0), 3: (f"{line}\ny", 0, 0), None: ("z", 0, 1)}
    plan = line_dedup.dedup_lines(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- mixing


def brute_targets(sizes, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[k % 3] for k, s in enumerate(names)}
    left, open_, target = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(w[s] for s in open_)
        over = {s for s in open_ if level * w[s] > 2 * sizes[s] + 1e-9}
        if not over:
            return {**target, **{s: level * w[s] for s in open_}}
        for s in over:
            target[s], left = 2.0 * sizes[s], left - 2.0 * sizes[s]
        open_ -= over
    return target


def test_targets_match_repeated_sharing(spark):
    rng = random.Random(1)
    for n in (1, 2, 5, 17):
        sizes = {(None if k == 3 else f"s{k}é"[: 3 + k % 2] + str(k)): rng.choice([0, 1, 10, 500, 10_000]) for k in range(n)}
        table = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
        got = {r["source"]: r["target"] for r in mixing.source_targets(table).collect()}
        want = brute_targets(sizes)
        assert all(abs(got[s] - want[s]) < 1e-6 * max(1, want[s]) for s in sizes), (got, want)


def test_mix_repeats_documents_by_rate(documents):
    rng = random.Random(2)
    docs = documents(["w " * rng.randint(1, 9) for _ in range(3000)], sources=[rng.choice("abc") for _ in range(3000)])
    planned = mixing.plan_mix(docs)
    rows = planned.collect()
    assert all(r["copies"] * r["size"] <= 2 * r["size"] for r in rows)
    for source in "abc":
        own = [r for r in rows if r["source"] == source]
        assert abs(sum(r["copies"] * r["size"] for r in own) - own[0]["target"]) < 0.1 * own[0]["target"]
    again = {r["doc_id"]: r["copies"] for r in mixing.plan_mix(docs.repartition(7)).collect()}
    assert again == {r["doc_id"]: r["copies"] for r in rows}
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r["copies"] for r in rows)
    assert "Python" not in mixed._jdf.queryExecution().executedPlan().toString()


def test_mix_odd_rows(odd):
    rows = mixing.plan_mix(odd).collect()
    assert len(rows) == 12 and {r["source"] for r in rows} == {"b", None}
    assert mixing.mix(odd).columns == odd.columns
    assert mixing.mix(odd.limit(0)).count() == 0


def test_mix_draws_documents_without_ids_by_their_text(documents):
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randint(0, 99)}" for _ in range(8)) for _ in range(1000)]
    docs = documents(texts * 2, ids=[None] * 1000 + list(range(1000)), sources=["a"] * 1000 + ["b"] * 1000)
    rows = mixing.plan_mix(docs, weights=(1, 1), share=0.75).collect()
    for source in "ab":
        own = [r for r in rows if r["source"] == source]
        assert own[0]["target"] == 6000 and abs(sum(r["copies"] * r["size"] for r in own) - 6000) < 400


def test_mix_keeps_the_callers_columns(documents):
    own = ["size", "source_size", "target", "copies", "_source", "_size", "_target", "_copies", "d", "t"]
    docs = documents(["a b c"] * 4, sources=["x", "x", "y", None]).select("doc_id", "text", "source", *[F.lit("own").alias(c) for c in own])
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() > 0
    assert all(r[c] == "own" for r in mixed.collect() for c in own)
    assert all(r[c] == "own" for r in mixing.plan_mix(docs).collect() for c in own[4:])


# --- top k


def brute_top(rows, asked, k):
    usable = {i: np.floor(256 * np.array(v, float)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    out = []
    for q in asked:
        if q in usable:
            scored = sorted((-int(usable[q] @ v), i) for i, v in usable.items() if i != q and len(v) == len(usable[q]))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return sorted(out)


def test_top_k_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 64)
    rng = np.random.default_rng(3)
    vectors = [[float(x) for x in v] for v in rng.normal(size=(600, 40)) * (0.9 ** np.arange(40))]
    rows = [(k, v) for k, v in enumerate(vectors)] + [(600 + k, vectors[5]) for k in range(30)]
    rows += [(700, None), (701, [1.0, None] + [0.0] * 38), (702, [float("nan")] * 40), (None, vectors[0]), (703, [1.0]), (750, [2.0]), (704, [float("inf")] * 40)]
    table = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id bigint, embedding array<double>, score int")
    got = topk.exact_top_k(table, table.filter("vec_id % 50 = 0"), 5)
    assert sorted(map(tuple, got.collect())) == brute_top(rows, [i for i, _ in rows if i is not None and i % 50 == 0], 5)
    assert topk.exact_top_k(table.limit(0), table.limit(0), 5).count() == 0
    assert topk.exact_top_k(table.filter("vec_id = 50"), table.filter("vec_id = 50"), 5).count() == 0


def test_top_k_of_large_numbers_is_whole():
    ids = np.arange(5)
    columns = np.array([[2.0**30, 2.0**29, -(2.0**30), 3.0, 2.0**30 - 1]])
    q, found, scores = topk.search_block(ids, columns, np.array([0]), np.array([[2.0**30]]), 2)
    assert list(found) == [4, 1] and scores[0] == (2**30 - 1) * 2**30


# --- URL lists


def test_lists_hold_from_entry_to_entry(spark):
    entries = [
        ("bad.org", "block", date(2024, 1, 10)),
        ("bad.org", "end", date(2024, 2, 1)),
        ("www.bad.org/good", "allow", date(2024, 1, 12)),
        ("tie.net", "block", date(2024, 1, 1)),
        ("tie.net", "allow", date(2024, 1, 1)),
        (None, "block", date(2024, 1, 1)),
        ("x.org", "block", None),
    ]
    listed = spark.createDataFrame(entries, "key string, action string, dated date")
    asked = [
        (1, "https://www.BAD.org/x?y#z", date(2024, 1, 9), True),
        (2, "https://www.bad.org/x", date(2024, 1, 10), False),
        (3, "http://u:p@www.bad.org:80/good/page", date(2024, 1, 11), False),
        (4, "http://www.bad.org/good/page", date(2024, 1, 12), True),
        (5, "http://bad.org", date(2024, 2, 1), True),
        (6, "//a.b.tie.net./", date(2024, 5, 1), False),
        (7, None, date(2024, 1, 20), True),
        (8, "not a url", date(2024, 1, 20), True),
        (9, "http://bad.org/", None, True),
        (2, "https://www.bad.org/x", date(2024, 1, 10), False),
    ]
    captures = spark.createDataFrame([(i, u, d, "own") for i, u, d, _ in asked], "page_id int, url string, fetched_on date, kept string")
    got = url_filters.judge(captures, listed)
    assert got.columns == ["page_id", "url", "fetched_on", "kept", "matched_key", "matched_action", "matched_from"]
    assert sorted((r["page_id"], r["kept"]) for r in got.collect()) == sorted((i, k) for i, _, _, k in asked)
    assert url_filters.judge(captures.limit(0), listed).count() == 0
    assert all(r["kept"] for r in url_filters.judge(captures, listed.limit(0)).collect())
    with pytest.raises(Exception, match="unknown list action"):
        url_filters.judge(captures, listed.withColumn("action", F.lit("ban"))).collect()
