"""Quality by compression, rules, personal data, licences and pieces against direct computations."""

import os
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from framesift.llm import compression_quality, decision_rules, licenses, pieces, pii

PIECES = "/opt/tokenizers/piece_bpe_32k.model"
needs_model = pytest.mark.skipif(not os.path.exists(PIECES), reason="vocabulary files not here")


def sentences(rng, n, noise=0.0):
    words = "the of and river stone garden window light under over slowly morning paper garden house bread water".split()
    out = [rng.choice(words) + ("***" if rng.random() < noise else "") for _ in range(n)]
    return " ".join(out)


def labelled(documents, spark, n=400):
    rng = random.Random(4)
    quality = [int(k % 4 != 0) for k in range(n)]
    texts = [sentences(rng, rng.randint(60, 120), 0.0 if q else 0.9) for q in quality]
    labels = spark.createDataFrame([(k, q, 0) for k, q in enumerate(quality)], "doc_id bigint, quality int, toxic int")
    return documents(texts), labels, quality


# --- compression


def test_compression_separates_held_out(spark, documents):
    docs, labels, quality = labelled(documents, spark)
    model = compression_quality.fit(docs, labels)
    rows = compression_quality.score(docs, model).withColumn("out", F.crc32(F.col("doc_id").cast("string")) % 4 == 2).collect()
    right = [r["predicted"] == quality[r["doc_id"]] for r in rows if r["out"]]
    assert len(right) > 50 and sum(right) / len(right) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_compression_ignores_held_out_labels(spark, documents):
    docs, labels, _ = labelled(documents, spark, 120)
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = compression_quality.fit(docs, labels), compression_quality.fit(docs, turned)
    assert a.good == b.good and a.bad == b.bad and list(a.weights) == list(b.weights)


def test_compression_sizes_and_calibration_by_hand(documents, spark):
    """Sizes by plain compressors, and weights at which the penalised likelihood has no slope."""
    import zstandard

    docs, labels, quality = labelled(documents, spark)
    texts = [r["text"] for r in docs.orderBy("doc_id").collect()]
    good, bad = ([t for t, q in zip(texts, quality) if q == k] for k in (1, 0))
    model = compression_quality.fit_model(good, bad)
    rest = good[len(good) // 2 :] + bad[len(bad) // 2 :]
    rows = []
    for text in rest:
        data, sizes = text.encode(), []
        for dictionary in (model.good, model.bad):
            options = {"level": 3, "write_content_size": False, "write_dict_id": False}
            sizes.append(len(zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary), **options).compress(data)))
        difference, n = (sizes[1] - sizes[0]) / max(sizes), np.log(len(data) + 1.0)
        rows.append([difference, difference * n, (sizes[1] - sizes[0]) / (len(data) + 1.0), n, n * n])
    x = np.array(rows)
    x = np.column_stack([np.ones(len(x)), (x - x.mean(axis=0)) / x.std(axis=0)])
    y = np.array([1.0] * (len(good) - len(good) // 2) + [0.0] * (len(bad) - len(bad) // 2))
    p = 1 / (1 + np.exp(-(x @ model.weights)))
    slope = x.T @ (y - p) - np.array([1e-6, *[0.1] * 5]) * model.weights
    assert np.abs(slope).max() < 1e-3
    assert np.allclose(model.scores(rest), p, atol=1e-6)


def test_compression_on_held_out_rows_of_the_tables(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = compression_quality.fit(docs, labels)
    scored = compression_quality.score(docs, model).join(labels, "doc_id").filter("crc32(CAST(doc_id AS STRING)) % 4 = 2").collect()
    good, bad = ([r["predicted"] for r in scored if r["quality"] == k] for k in (1, 0))
    assert len(good) > 50 and len(bad) > 10
    assert sum(good) / len(good) > 0.9 and sum(bad) / len(bad) < 0.3


def test_compression_odd_rows(spark, documents, odd):
    labels = spark.createDataFrame([(5, 1, 0), (5, 0, 0), (3, None, None), (None, 1, 0), (4, 7, 0)], "doc_id bigint, quality int, toxic int")
    model = compression_quality.fit(odd, labels)
    rows = compression_quality.score(odd, model).collect()
    assert len(rows) == 12 and {r["score"] for r in rows} == {0.5}
    docs, labels, _ = labelled(documents, spark, 80)
    model = compression_quality.fit(docs, labels)
    scored = compression_quality.score(odd, model)
    assert scored.columns == [c for c in odd.columns if c != "score"] + ["score", "predicted"]
    by_text = {r["text"]: r["score"] for r in scored.collect()}
    assert by_text[None] == by_text[""]
    assert compression_quality.score(odd.limit(0), model).count() == 0
    assert compression_quality.fit(odd.limit(0), labels.limit(0)).prior == 0.5


# --- decision lists


def brute_statistics(text):
    text = text or ""
    words = text.encode().split()
    windows = list(zip(words, words[1:], words[2:]))
    seen, marked = Counter(windows), set()
    for k, w in enumerate(windows):
        if seen[w] > 1:
            marked |= {k, k + 1, k + 2}
    lines = [x for x in text.split("\n") if x.encode().split()]
    return len(words), sum(len(w.decode()) for w in words), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(marked)


def test_statistics_match_brute_force(documents, odd):
    rng = random.Random(1)
    texts = ["".join(rng.choice(["a", "b", " ", "  ", "\n", "#", "|", "a b c", "\t", "é"]) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    for table in (documents(texts), odd):
        for r in decision_rules.statistics(table).collect():
            assert tuple(r[c] for c in names) == brute_statistics(r["text"]), r["text"]
    assert decision_rules.statistics(odd.limit(0)).count() == 0


def test_rules_learn_what_separates(spark, documents):
    docs, labels, quality = labelled(documents, spark)
    stats = decision_rules.statistics(docs)
    rules = decision_rules.learn(stats, labels)
    assert rules.rules and "symbol_rate >=" in str(rules)
    kept = {r["doc_id"]: r["kept"] for r in decision_rules.judge(stats, rules).collect()}
    assert all(kept[k] == bool(q) for k, q in enumerate(quality))


def test_rules_without_labels_keep_all_but_base_failures(odd, spark):
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    stats = decision_rules.statistics(odd)
    judged = decision_rules.judge(stats, decision_rules.learn(stats, labels))
    assert judged.columns.count("kept") == 1
    assert all(r["base_failed"] != r["kept"] for r in judged.collect())


def test_rules_stay_in_the_engine(spark, documents):
    docs, labels, _ = labelled(documents, spark, 80)
    stats = decision_rules.statistics(docs)
    plan = decision_rules.judge(stats, decision_rules.learn(stats, labels))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- personal data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            fits = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
                "card": lambda: 12 <= len(digits) <= 19 and pii.luhn(digits),
                "phone": lambda: 9 <= len(digits) <= 15,
            }[kind]
            if fits():
                out.append((kind, m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def test_base_spans_match_the_patterns():
    rng = random.Random(2)
    bits = ["1", "2", "4", "0", "9", "12", "255", ".", "-", " ", "+", "(", ")", "@", "a", "b.c", "é", "@x.y", "4041894974608795", "\n"]
    for _ in range(20_000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 14)))
        assert pii.base_spans(text) == brute_spans(text), text


def pii_texts():
    rng = random.Random(7)
    made = ["joe.doe@mail.example.com", "10.20.30.40", "+1 (269) 555-3123", "4041894974608795", "300.1.1.1", "12345", "b7db7aa4a5"]
    return [" ".join(rng.choice(made) if rng.random() < 0.2 else rng.choice("and the of garden river".split()) for _ in range(40)) for _ in range(200)]


def test_field_keeps_base_and_adds_spellings(documents, odd):
    docs = documents(pii_texts())
    model = pii.fit(docs)
    for r in pii.find(docs, model).collect():
        assert [(s["kind"], s["start"], s["end"]) for s in r["pii"] if s["base"]] == brute_spans(r["text"])
    new = ["write to joe.doe[at]mail.example.com today", "host 10[.]20[.]30[.]40 is down", "nothing 2024 here 12.5"]
    found = [[(s["kind"], r["text"][s["start"] : s["end"]]) for s in r["pii"]] for r in pii.find(documents(new), model).orderBy("doc_id").collect()]
    assert found == [[("email", "joe.doe[at]mail.example.com")], [("ip", "10[.]20[.]30[.]40")], []]
    rows = pii.find(odd, model).collect()
    assert len(rows) == 12 and all(r["pii"] == [] for r in rows)
    assert pii.find(odd.limit(0), model).count() == 0


def test_field_chooses_the_best_segmentation():
    model = pii.train(pii_texts())
    text = "see 10[.]20[.]30[.]40 or joe(at)mail.example.com now"
    low, high = pii.zones(text)[0]
    lat = pii.lattice(text, low, high)
    scored = [(i, j, pii.KINDS[k], s) for i, j, k, s, _ in model._scores(lat)]

    def best(at):
        options = [(0.0, [])] if at >= len(lat.starts) - 1 else [best(at + 1)]
        for i, j, kind, s in scored:
            if i == at and s > 0:
                rest = best(j)
                options.append((s + rest[0], [(kind, lat.starts[i], lat.starts[j]), *rest[1]]))
        return max(options, key=lambda o: o[0])

    assert model.decode(text, low, high) == best(0)[1]


def test_field_without_examples_adds_nothing(odd):
    assert not any(pii.fit(odd).weights.values())


# --- licences


def test_licenses_match_alignment_of_every_template(documents):
    rng = random.Random(3)
    index, texts = licenses.TemplateIndex(), []
    for _ in range(60):
        parts = []
        for _ in range(rng.randint(0, 3)):
            parts.append(sentences(rng, rng.randint(0, 30)))
            words = rng.choice(licenses.TEMPLATES)[2].split()
            for k in range(len(words)):
                if rng.random() < 0.03:
                    words[k] = "changed"
            parts.append(" ".join(words))
        texts.append("\n".join(parts))
    for text in texts:
        ids = index.hashes.array(licenses.tokens_of(text))
        found = {m.template for m in index.scan(text)}
        for license, name, wording, _ in index.templates:
            matched, first, last = licenses.align(ids, wording, -len(wording), len(ids)) if len(ids) else (0, -1, -1)
            if matched >= 0.85 * len(wording):
                # Found, or covered by another match of more tokens.
                assert name in found or any(m.first <= last and m.last >= first and m.matched >= matched for m in index.scan(text)), (name, text)


def test_licenses_report_spans_and_odd_rows(documents, odd):
    text = "héllo\nReleased under the MIT\n License! ok. All rights reserved."
    row = licenses.scan(documents([text])).first()
    assert [(m["license"], m["coverage"], text[m["start"] : m["end"]]) for m in row["licenses"]] == [
        ("MIT", 1.0, "Released under the MIT\n License"),
        ("reserved", 1.0, "All rights reserved"),
    ]
    assert len(licenses.TemplateIndex().scan("All rights reserved. " * 500)) == 500
    assert all(r["licenses"] == [] for r in licenses.scan(odd).collect())
    assert licenses.scan(odd.limit(0)).count() == 0
    with pytest.raises(ValueError):
        licenses.TemplateIndex([("x", "x", "too short")])


# --- pieces


@needs_model
def test_pieces_equal_the_library():
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    with open(PIECES, "rb") as file:
        mine = pieces.PieceTransducer(file.read())
    rng = random.Random(5)
    bits = ["a", "e", "t", "th", "  ", " ", "\n", "é", "日", "本", "😀", "in", "g", "THE", "1", "00", "…", "the ", "\t", "Ω"]
    for _ in range(3000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 20)))
        ids = mine.encode(text)
        assert list(ids) == library.encode(text), text
        assert mine.decode(ids) == text and mine.restored(text, ids)


def test_unigram_path_is_the_best(spark):
    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    import itertools
    import struct

    def message(number, data):
        return varint(number << 3 | 2) + varint(len(data)) + data

    def piece(name, score, kind):
        return message(1, message(1, name.encode()) + b"\x15" + struct.pack("<f", score) + b"\x18" + bytes([kind]))

    scores = {"▁": -2.0, "a": -3.0, "b": -3.5, "ab": -4.0, "▁a": -2.5, "ba": -3.0, "▁ab": -6.5, "bb": -5.0}
    model = piece("<unk>", 0, 2) + b"".join(piece(n, s, 1) for n, s in scores.items()) + message(2, b"\x18\x01")
    made = pieces.PieceTransducer(model)
    for n in range(1, 6):
        for letters in itertools.product("ab ", repeat=n):
            part = made.normalise("".join(letters))

            def best(rest):
                if not rest:
                    return 0.0
                return max((s + best(rest[len(p) :]) for p, s in scores.items() if rest.startswith(p)), default=-1e9)

            assert abs(sum(made.scores[i] for i in made.encode("".join(letters))) - best(part)) < 1e-5


@needs_model
def test_pieces_of_whole_documents_equal_the_library(spark):
    """Whole texts of the test tables, long ones among them, and what decoding gives back."""
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [r["text"] or "" for r in docs.select("text").collect()] + ["x" * 3000, "\u2581 \u2581\u2581a", " b  c ", "\x00\x1f"]
    with open(PIECES, "rb") as file:
        mine = pieces.PieceTransducer(file.read())
    for text in texts:
        ids, whole = mine.encode_checked(text)
        assert list(np.frombuffer(ids, np.int32)) == library.encode(text)
        assert whole == mine.restored(text, list(np.frombuffer(ids, np.int32)))


def test_pieces_odd_rows(spark, odd):
    rows = pieces.encode(odd, PIECES)
    assert rows.columns == [c for c in odd.columns if c != "ids"] + ["ids", "n_ids", "restored"]
    got = rows.withColumn("again", pieces.decode_column(spark, PIECES, F.col("ids"))).collect()
    assert len(got) == 12 and all(r["restored"] and r["again"] == (r["text"] or "") and len(r["ids"]) == r["n_ids"] for r in got)
    assert pieces.encode(odd.limit(0), PIECES).count() == 0
