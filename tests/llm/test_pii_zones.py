"""Spelled addresses longer than a zone once was, with spaces, and with spelled dots."""

import random

import pytest

from framesift.llm import pii


def texts():
    rng = random.Random(7)
    made = ["joe.doe@mail.example.com", "10.20.30.40", "+1 (269) 555-3123", "4041894974608795", "300.1.1.1", "12345", "b7db7aa4a5"]
    return [" ".join(rng.choice(made) if rng.random() < 0.2 else rng.choice("and the of garden river".split()) for _ in range(40)) for _ in range(200)]


@pytest.fixture(scope="module")
def model():
    return pii.train(texts())


@pytest.mark.parametrize(
    "address",
    [
        "joe.doe[at]universidad-nacional.example.edu",
        "maria-magdalena.von-hohenzollern[at]example.com",
        "anna.maria.del.carmen.garcia.lopez.de.la.vega(at)mail.example.org",
        "joe [at] example.com",
        "joe.doe (at) mail.example.com",
        "joe[at]example[dot]com",
        "joe [at] mail [dot] example [dot] com",
        "joe(AT)example(DOT)com",
    ],
)
def test_spelled_addresses_are_whole(model, address):
    for text in (f"write to {address} today", f"{address}\n{'q' * 300}", f"{'word ' * 40}: {address}"):
        found = [(k, text[a:b]) for k, a, b, own in pii.spans_of(text, model)]
        assert found == [("email", address)], text


def test_no_segment_begins_or_ends_inside_a_word():
    rng = random.Random(9)
    bits = ["abc", "x" * 60, "7", "12", ".", "-", " ", "[at]", " (at) ", "[dot]", "@", "+", "é", ","]
    for _ in range(300):
        text = "".join(rng.choice(bits) for _ in range(60))
        for low, high in pii.zones(text):
            lat = pii.lattice(text, low, high)
            for i, j, _ in lat.segments:
                a, b = lat.starts[i], lat.starts[j]
                assert b - a <= pii.MOST_CHARS
                assert not (a and text[a].isalnum() and text[a - 1].isalnum())
                assert not (b < len(text) and text[b].isalnum())


def test_zones_hold_every_segment_of_the_whole_text():
    rng = random.Random(10)
    bits = ["abc", "long" * 5, "7", "12", ".", "-", " ", "[at]", " (at) ", "[dot]", "@", "+", ",", "words and "]
    for _ in range(200):
        text = "".join(rng.choice(bits) for _ in range(60))

        def spans(low, high):
            lat = pii.lattice(text, low, high)
            return {(lat.starts[i], lat.starts[j]) for i, j, _ in lat.segments}

        assert set().union(*[spans(*z) for z in pii.zones(text)], set()) == spans(0, len(text))
