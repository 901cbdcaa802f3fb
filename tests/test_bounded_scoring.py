"""Scoring and cleaning of long texts."""

import re

import numpy as np

from framesift.functions import cleaning
from framesift.operators.language import score_text


def test_texts_scored_in_pieces_have_the_same_scores():
    code = lambda gram: sum(ord(c) << (42 - 21 * k) for k, c in enumerate(gram))
    codes = np.array(sorted(code(g) for g in ("_ab", "abc", "bc_", "éab")), np.uint64)
    weights = np.arange(8, dtype=np.int64).reshape(4, 2) + 1
    for words in (None, "", "_a", "_abc_", "_abc_ _éabc_ _abcab_ " * 7 + "_abc_"):
        whole = score_text(words, codes, weights)
        assert all((score_text(words, codes, weights, piece=n) == whole).all() for n in (1, 2, 3, 5, 64))
    assert score_text("_abc_", codes, weights).sum() > 0


def test_characters_replaced_one_by_one_are_those_of_the_patterns():
    every = [chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000]
    assert {c for c in every if re.fullmatch(cleaning.DASHES, c)} == {*cleaning.ODD_DASHES, "-"}
    assert all(0x58A <= ord(c) <= 0xFF0D for c in cleaning.ODD_DASHES)
    spaces = {c for c in every if c.isspace() and c not in "\x1c\x1d\x1e\x1f"}
    assert spaces == {*cleaning._ASCII_SPACES, *cleaning._OTHER_SPACES, " "}
