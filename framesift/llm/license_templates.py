"""Wordings of licences and notices. They have to read as the licences do."""

_GNU_HEADER = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the {0} as published by the Free Software "
    "Foundation, either version {1} of the License, or (at your option) any later version. This program is distributed in the hope that it "
    "will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See "
    "the {0} for more details."
)

TEMPLATES: tuple[tuple[str, str, str], ...] = (
    ("MIT", "mit-note", "Released under the MIT License."),
    (
        "MIT",
        "mit-grant",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.",
    ),
    (
        "MIT",
        "mit-disclaimer",
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE "
        "FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
        "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    ("Apache-2.0", "apache-note", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "apache-header",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You '
        "may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
        "either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    ("GPL-3.0", "gpl-note", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "gpl-header",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed "
        "in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        "PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ),
    (
        "BSD",
        "bsd-conditions",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
        "are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution.",
    ),
    (
        "ISC",
        "isc-grant",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
        "the above copyright notice and this permission notice appear in all copies.",
    ),
    ("BSD", "bsd-note", "Released under the BSD License."),
    ("GPL", "gpl-any-note", "This work is licensed under the GNU General Public License."),
    ("GPL-2.0", "gpl-2-note", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "gpl-2-header", _GNU_HEADER.format("GNU General Public License", "2")),
    ("LGPL-3.0", "lgpl-3-note", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-3.0", "lgpl-3-header", _GNU_HEADER.format("GNU Lesser General Public License", "3")),
    ("LGPL-2.1", "lgpl-2-note", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-2.1", "lgpl-2-header", _GNU_HEADER.format("GNU Lesser General Public License", "2.1")),
    ("AGPL-3.0", "agpl-3-note", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", "agpl-3-header", _GNU_HEADER.format("GNU Affero General Public License", "3")),
    ("CC-BY-4.0", "cc-by-note", "Licensed under CC BY 4.0."),
    ("CC-BY-ND-4.0", "cc-by-nd-note", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "cc-by-nc-sa-note", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-ND-4.0", "cc-by-nc-nd-note", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-NC-4.0", "cc-by-nc-note", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "cc-by-sa-note", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "cc-by-long", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("reserved", "reserved-note", "All rights reserved."),
)

_OTHER_GNU = "lesser library affero"
_OTHER_CC = "noncommercial sharealike noderivatives noderivs"

# What tells a template from other licences: words that have to stand in the matched stretch, words that
# must not, and the version that has to stand there or just behind.
NAMED: dict[str, tuple[str, str, str]] = {
    "mit-note": ("mit", "", ""),
    "bsd-note": ("bsd", "", ""),
    "apache-note": ("apache", "", "2"),
    "apache-header": ("apache", "", "2"),
    "gpl-any-note": ("gnu", _OTHER_GNU, ""),
    "gpl-note": ("gnu", _OTHER_GNU, "3"),
    "gpl-header": ("gnu", _OTHER_GNU, "3"),
    "gpl-2-note": ("gnu", _OTHER_GNU, "2"),
    "gpl-2-header": ("gnu", _OTHER_GNU, "2"),
    "lgpl-3-note": ("lesser", "affero", "3"),
    "lgpl-3-header": ("lesser", "affero", "3"),
    "lgpl-2-note": ("lesser", "affero", "2 1"),
    "lgpl-2-header": ("lesser", "affero", "2 1"),
    "agpl-3-note": ("affero", "lesser", "3"),
    "agpl-3-header": ("affero", "lesser", "3"),
    "cc-by-note": ("by", "nc sa nd", "4"),
    "cc-by-nc-note": ("by nc", "sa nd", "4"),
    "cc-by-sa-note": ("by sa", "nc nd", "4"),
    "cc-by-nd-note": ("by nd", "nc sa", "4"),
    "cc-by-nc-sa-note": ("by nc sa", "nd", "4"),
    "cc-by-nc-nd-note": ("by nc nd", "sa", "4"),
    "cc-by-long": ("attribution", _OTHER_CC, "4"),
}
