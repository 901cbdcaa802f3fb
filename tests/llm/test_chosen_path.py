"""The chosen-path join against brute force, and its parts against their definitions."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from framesift.llm import chosen_path
from framesift.llm.common import WordHashes


def shingles(text, gram=3):
    words = (text or "").encode().lower().split()
    size = min(gram, len(words)) or 1
    return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)} if words else set()


def brute_groups(texts, percent, gram=3):
    sets = [shingles(t, gram) for t in texts]
    root = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a + 1, len(texts)):
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root[a], root[b]))
                root = [x if r == y else r for r in root]
    return [(k, len(sets[k]), root[k], root[k] == k) for k in range(len(texts))]


def copies(rng, base, count, edits):
    out = []
    for _ in range(count):
        words = list(base)
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(len(words))] = f"v{rng.randint(0, 999)}"
        out.append(" ".join(words))
    return out


def corpus(seed):
    rng = random.Random(seed)
    passage = " ".join(f"p{k}" for k in range(60))
    texts = []
    for _ in range(25):
        base = [f"w{rng.randint(0, 500)}" for _ in range(rng.randint(3, 150))]
        texts += copies(rng, base, rng.randint(1, 12), max(1, len(base) // 40))
    # A chain whose ends are far apart, one text with many copies far from each other, a shared passage.
    chain = [f"c{k}" for k in range(80)]
    for k in range(15):
        chain[5 * k] = f"d{k}"
        texts.append(" ".join(chain))
    texts += copies(rng, [f"h{k}" for k in range(120)], 60, 6)
    texts += [passage + " " + " ".join(f"u{rng.random()}" for _ in range(rng.randint(4, 30))) for _ in range(50)]
    texts += ["A b", "a  B", "a", "", None, passage, passage.upper()]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize(("seed", "percent", "gram", "small"), [(1, 85, 3, 32), (2, 85, 3, 4), (3, 80, 5, 32)])
def test_near_duplicates_match_brute_force(documents, rows, seed, percent, gram, small):
    texts = corpus(seed)
    got = rows(chosen_path.near_duplicates(documents(texts), percent=percent, gram=gram, small=small))
    assert got == brute_groups(texts, percent, gram)
    assert 20 < sum(r[3] for r in got) < len(texts) - 100


def test_deep_trees_without_heads_find_all_pairs(documents, monkeypatch):
    """All links come out of nodes alone, through branching and the comparison with a largest component."""
    monkeypatch.setattr(chosen_path.ChosenPathJoin, "_join_heads", lambda self, rows: None)
    texts = corpus(4)
    found = chosen_path.near_duplicates(documents(texts), small=8, depth=3).collect()
    assert sorted((r[0], r[2]) for r in found) == [(k, c) for k, _, c, _ in brute_groups(texts, 85)]


def test_odd_rows(odd):
    found = chosen_path.near_duplicates(odd).collect()
    assert len(found) == 12
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[5]["component_id"] == by_id[6]["component_id"] == 5 and not by_id[6]["kept"]
    assert by_id[None]["component_id"] is None and by_id[None]["kept"]
    assert all(by_id[i]["component_id"] == i for i in (0, 1, 2, 3, 4, 7, 8, 9))
    assert chosen_path.near_duplicates(odd.limit(0)).count() == 0
    with pytest.raises(ValueError):
        chosen_path.near_duplicates(odd, percent=50)


def test_rows_of_one_id_are_one_document(documents):
    texts = ["a b c d e f g h", "k l m n o p q r", "a b c d e f g h", "k l m n o p q r"]
    found = chosen_path.near_duplicates(documents(texts, [7, 7, 8, 9])).collect()
    assert {r["component_id"] for r in found} == {7}


def test_minwise_tokens_agree_as_sets_do():
    rng = np.random.default_rng(1)
    agreed = []
    for _ in range(60):
        tokens = rng.integers(0, 2**63, 1150).astype(np.uint64)
        agreed.append((chosen_path.minwise(tokens[:1000]) == chosen_path.minwise(tokens[150:])).mean())
    assert abs(np.mean(agreed) - 850 / 1150) < 0.03


def test_branching_keeps_alike_documents_together():
    rng = np.random.default_rng(2)
    paths = rng.integers(0, 2**63, 20_000).astype(np.uint64)
    tokens = rng.integers(0, 2**32, (20_000, chosen_path.COORDINATES)).astype(np.uint32)
    rows, found = chosen_path.children(paths, tokens, 100 / 85)
    assert abs(len(rows) / 20_000 - 100 / 85) < 0.02
    assert (chosen_path.children(paths, tokens, 100 / 85)[1] == found).all()
    other = np.where(rng.random(tokens.shape) < 0.85, tokens, tokens + np.uint32(1))
    assert abs((chosen_path.children(paths, other, 100 / 85)[1] == found).sum() / 20_000 - 1) < 0.03


def test_first_comparison_counts_differing_tokens(spark, documents):
    memo = WordHashes()
    texts = corpus(5)[:60]
    join = chosen_path.ChosenPathJoin(documents(texts), "doc_id", "text", 3, 85, 12, 5, 32)
    shown = join._shown()
    side = lambda end: shown.select(*[F.col(c).alias(end + c) for c in shown.columns])
    pairs = side("a_").join(side("b_"), F.col("a_node") < F.col("b_node")).select("a_node", "b_node", join._differing("a_", "b_").alias("d"))
    low = {k: chosen_path.minwise(np.unique(chosen_path.grams(memo.array(chosen_path.plain_words(t or "")), 3)))[: chosen_path.COMPARED] & np.uint32(255) for k, t in enumerate(texts)}
    assert all(r["d"] == (low[r["a_node"]] != low[r["b_node"]]).sum() for r in pairs.collect())
