"""Templates of the licence scan: notices, titles and tags built by rule from licence names, headers and texts.

A template is ``(licence, kind, text, required)``.  ``required`` are words that a passage must hold to be compared with
it at all, the first being one that few texts hold.  Kinds: ``title`` is compared with a file's first block only,
``notice`` (notices, headers, tags and texts) with every passage.
"""

from __future__ import annotations

from typing import NamedTuple


class Template(NamedTuple):
    license: str
    kind: str
    text: str
    required: str


# Names by licence identifier, each with the words that tell it from others.
NAMES = [
    ("MIT", "MIT License", "license mit"),
    ("ISC", "ISC License", "isc license"),
    ("BSD-2-Clause", "BSD 2-Clause License", "bsd 2 clause"),
    ("BSD-3-Clause", "BSD 3-Clause License", "bsd 3 clause"),
    ("Apache-2.0", "Apache License, Version 2.0", "apache license 2"),
    ("MPL-2.0", "Mozilla Public License, version 2.0", "mozilla public license 2"),
    ("MPL-2.0", "MPL 2.0", "mpl 2"),
    ("LGPL-2.0", "GNU Library General Public License, version 2", "gnu library general public 2"),
    ("GPL-2.0", "GPLv2", "gplv2"),
    ("GPL-3.0", "GPLv3", "gplv3"),
    ("LGPL-3.0", "LGPLv3", "lgplv3"),
    ("AGPL-3.0", "AGPLv3", "agplv3"),
]
# The GNU licences, (prefix of the identifier, word of the name, version).
GNU = [("GPL", "", "2"), ("GPL", "", "3"), ("LGPL", "Lesser", "2.1"), ("LGPL", "Lesser", "3"), ("AGPL", "Affero", "3")]
# The Creative Commons licences, (identifier, name of its conditions), and their versions.
COMMONS = [("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"),
           ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
           ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives")]
VERSIONS = ("3.0", "4.0")
FORMS = ("Licensed under the {}.", "Released under the {}.", "This work is licensed under the {}.",
         "This project is licensed under the terms of the {}.",
         "This software is released under the {}, see the LICENSE file for details.")

# The wording of the licences' own headers and texts.
MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
    "permit persons to whom the Software is furnished to do so, subject to the following conditions:")
MIT_REST = (
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
    "the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT "
    "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
    "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
    "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
    "IN THE SOFTWARE.")
ISC_GRANT = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies.")
ISC_REST = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING "
    "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
    "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
    "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE "
    "OR PERFORMANCE OF THIS SOFTWARE.")
BSD_GRANT = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided "
             "that the following conditions are met:")
BSD_TWO = (
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions "
    "and the following disclaimer in the documentation and/or other materials provided with the distribution.")
BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission.")
BSD_REST = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE "
    "USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
APACHE_HEADER = (
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
    "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
    "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
    "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
    "specific language governing permissions and limitations under the License.")
APACHE_TITLE = "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"
MPL_HEADER = (
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
    "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.")
MPL_NOTICE = "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0."
GNU_HEADER = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the {name} as published "
    "by the Free Software Foundation, either version {version} of the License, or (at your option) any later version. "
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
    "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details.")
BSD_NOTICE = "Redistribution and use in source and binary forms, with or without modification, are permitted."
RESERVED = "All rights reserved."
PROPRIETARY = "proprietary"


def build() -> list[Template]:
    names = list(NAMES)
    texts = [
        ("MIT", MIT_GRANT, "hereby sublicense"), ("MIT", f"MIT License {MIT_GRANT} {MIT_REST}", "hereby sublicense"),
        ("ISC", ISC_GRANT, "hereby fee"), ("ISC", f"ISC License {ISC_GRANT} {ISC_REST}", "hereby fee"),
        ("BSD-2-Clause", f"{BSD_GRANT} {BSD_TWO}", "redistribution redistributions reproduce"),
        ("BSD-2-Clause", f"{BSD_GRANT} {BSD_TWO} {BSD_REST}", "redistribution redistributions reproduce"),
        ("BSD-3-Clause", f"{BSD_GRANT} {BSD_TWO} {BSD_THIRD}", "redistribution redistributions endorse"),
        ("BSD-3-Clause", f"{BSD_GRANT} {BSD_TWO} {BSD_THIRD} {BSD_REST}", "redistribution redistributions endorse"),
        ("BSD-3-Clause", BSD_NOTICE, "redistribution source binary permitted"),
        ("Apache-2.0", APACHE_HEADER, "apache license 2"),
        ("MPL-2.0", MPL_HEADER, "mozilla public license 2"), ("MPL-2.0", MPL_NOTICE, "mozilla public license 2"),
        (PROPRIETARY, RESERVED, "reserved all rights"),
    ]
    titles = [("Apache-2.0", APACHE_TITLE, "apache license 2")]
    for prefix, word, version in GNU:
        name = " ".join(f"GNU {word} General Public License".split())
        license_id = f"{prefix}-{version if '.' in version else version + '.0'}"
        marks = f"{word} {version.replace('.', ' ')}".lower().strip()
        names.append((license_id, f"{name}, version {version}", f"gnu general public {marks}"))
        names.append((license_id, license_id, f"{prefix.lower()} {version.replace('.', ' ')}"))
        texts.append((license_id, GNU_HEADER.format(name=name, version=version), f"gnu general public {marks}"))
    for code, conditions in COMMONS:
        for version in VERSIONS:
            license_id, number = f"CC-{code}-{version}", version[0]
            names.append((license_id, f"CC {code} {version}", f"cc {code.replace('-', ' ').lower()} {number}"))
            names.append((license_id, f"Creative Commons {conditions} {version} International License",
                          f"creative commons {conditions.replace('-', ' ').lower()} {number}"))
    out = [Template(i, "notice", text, required) for i, text, required in texts]
    out += [Template(i, "title", text, required) for i, text, required in titles]
    for license_id, name, required in names:
        out.append(Template(license_id, "title", name, required))
        out += [Template(license_id, "notice", form.format(name), required) for form in FORMS]
    for license_id in sorted({n[0] for n in names}):
        out.append(Template(license_id, "notice", f"SPDX-License-Identifier: {license_id}",
                            "spdx identifier " + " ".join(license_id.lower().replace("-", " ").replace(".", " ").split())))
    return out


TEMPLATES = build()
