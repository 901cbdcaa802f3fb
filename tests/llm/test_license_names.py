"""Licences told apart by name and version, and matches down to the coverage that is asked for."""

import random

import pytest

from framesift.llm import licenses
from framesift.llm.license_templates import NAMED, TEMPLATES

INDEX = licenses.TemplateIndex()
WORDING = {name: wording for _, name, wording in TEMPLATES}


@pytest.mark.parametrize(
    "text, want",
    [
        ("Released under the BSD License.", ["BSD"]),
        ("Released under the Zlib License.", []),
        ("Licensed under the MIT License.", ["MIT"]),
        ("Licensed under CC BY 4.0.", ["CC-BY-4.0"]),
        ("Licensed under CC BY-NC 4.0.", ["CC-BY-NC-4.0"]),
        ("Licensed under CC BY-NC-SA 4.0.", ["CC-BY-NC-SA-4.0"]),
        ("Licensed under the Apache License, Version 1.1.", []),
        ("Licensed under the Apache License 2.0.", ["Apache-2.0"]),
        ("This work is licensed under the GNU General Public License, version 2.", ["GPL-2.0"]),
        ("This work is licensed under the GNU General Public License v3.0.", ["GPL-3.0"]),
        ("This work is licensed under the GNU General Public License.", ["GPL"]),
        ("This work is licensed under the GNU Lesser General Public License, version 3.", ["LGPL-3.0"]),
        ("This work is licensed under the GNU Affero General Public License, version 3.", ["AGPL-3.0"]),
        ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", []),
        (WORDING["gpl-header"], ["GPL-3.0"]),
        (WORDING["gpl-header"].replace("version 3", "version 2"), ["GPL-2.0"]),
        (WORDING["gpl-header"].replace("General", "Lesser General"), ["LGPL-3.0"]),
        (WORDING["gpl-header"].replace("General", "Affero General"), ["AGPL-3.0"]),
    ],
)
def test_neighbours_are_told_apart(text, want):
    assert [m.license for m in INDEX.scan("so it is " + text + " and so on")] == want


def test_matches_are_found_down_to_the_coverage():
    rng = random.Random(8)
    for license, name, wording in TEMPLATES:
        words = licenses.tokens_of(wording)
        lost = int(0.3 * len(words) + 1e-9)
        kept = {w for part in NAMED.get(name, ("", "", "")) for w in part.encode().split()} | {b"version", b"license"}
        free = [k for k, w in enumerate(words) if w not in kept]
        evenly = [k for k in range(1, len(words), 3) if k in free][:lost]
        for trial in range(8):
            changed = set(evenly) if not trial else set(rng.sample(free, min(lost, len(free))))
            made = [b"zz%d" % k if k in changed else w for k, w in enumerate(words)]
            if trial % 2 and len(words) > 20:
                cut = min(free[len(free) // 3], len(words) - lost)
                made = words[:cut] + words[cut + lost :]
            text = b" ".join(made).decode()
            ids = INDEX.hashes.array(made)
            matched, first, last = licenses.align(ids, INDEX.hashes.array(words), -len(words), len(ids))
            if matched < 0.7 * len(words) or not licenses.is_named(made, first, last, *NAMED.get(name, ("", "", ""))):
                continue
            found = INDEX.scan(text)
            assert any(m.license == license or m.matched >= matched for m in found), (name, text)
