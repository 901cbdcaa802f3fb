"""The near-duplicate stage of the pipeline against brute force on five words and 0.8."""

import random

import corpus_pipeline
from framesift.llm import jaccard_join


def brute_kept(rows, gram=5, percent=80):
    """Smallest ids of the groups of texts that link."""
    sets = {}
    for i, text in rows:
        words = (text or "").encode().lower().split()
        n = min(gram, len(words)) or 1
        sets[i] = {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if words else set()
    kept, left = set(), set(sets)
    while left:
        group = [min(left)]
        kept.add(group[0])
        left.remove(group[0])
        while group:
            a = group.pop()
            near = {b for b in left if (shared := len(sets[a] & sets[b])) and 100 * shared >= percent * len(sets[a] | sets[b])}
            left -= near
            group += near
    return kept


def edited(rng, words, share):
    out = list(words)
    for k in rng.sample(range(len(out)), round(share * len(out))):
        out[k] = f"new{rng.random()}"
    return " ".join(out)


def test_near_stage_drops_copies_with_two_words_in_a_hundred_changed(spark, documents):
    rng = random.Random(6)
    bases = [[f"w{rng.randint(0, 900)}" for _ in range(rng.randint(4, 300))] for _ in range(20)]
    texts = [edited(rng, base, share) for base in bases for share in (0.0, 0.01, 0.02, 0.03, 0.06)]
    texts += ["a b c", "A b  c", "a b d", "", None]
    docs = documents(texts)
    kept = {r["doc_id"] for r in corpus_pipeline.ngram_jaccard_join(spark, docs, "").collect()}
    assert kept == brute_kept(list(enumerate(texts)))
    assert kept != brute_kept(list(enumerate(texts)), 3, 90)


def test_near_stage_loses_no_text_that_shares_an_id(spark, documents):
    texts = [" ".join(f"{c}{k}" for k in range(30)) for c in "abca"] + [None, None]
    docs = documents(texts, [3, 3, 4, 3, None, None]).withColumnRenamed("kept", "_again")
    rows = corpus_pipeline.ngram_jaccard_join(spark, docs, "").collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in rows) == sorted([(3, texts[0]), (3, texts[1]), (4, texts[2]), (0, ""), (0, "")])
    assert all(r["_again"] == "own" for r in rows)
    assert corpus_pipeline.ngram_jaccard_join(spark, docs.limit(0), "").count() == 0


def test_near_stage_finds_the_same_with_prefixes_of_32_bits_and_lets_each_step_go(spark, documents, monkeypatch):
    steps, write = [], jaccard_join.materialise

    def noted(df, name):
        steps.append(name)
        return write(df, name)

    monkeypatch.setattr(jaccard_join, "release_shuffles", lambda _: steps.append("release"))
    rng = random.Random(8)
    base = [f"w{k}" for k in range(150)]
    texts = [edited(rng, base, 0.01) for _ in range(12)]
    join = jaccard_join.JaccardJoin(documents(texts), "doc_id", "text", 5, 80, 2)
    assert join.signed.schema["p1"].dataType.elementType.simpleString() == "int"
    pairs = join.remaining_candidates(spark.createDataFrame([], "node bigint, component bigint"), noted)
    near = {(a, b) for b in range(12) for a in range(b) if len(brute_kept([(0, texts[a]), (1, texts[b])])) == 1}
    assert near and near <= {tuple(r) for r in pairs.collect()}
    large = [k for k, step in enumerate(steps) if step in ("pieces", "mixed", "shared", "pairs", "prefixes")]
    assert len(large) == 5 and all(steps[k + 1] == "release" for k in large)
