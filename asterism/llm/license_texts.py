"""Texts that stand for a licence: whole licences, and the notices that give one.

Whole texts beyond the short ones below are in ``license_files``, one file a licence.
"""

from __future__ import annotations

from importlib import resources

_MIT = """MIT License

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""

_ISC = """ISC License

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR
ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF
OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.
"""

_ZLIB = """zlib License

This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not
   claim that you wrote the original software. If you use this software
   in a product, an acknowledgment in the product documentation would be
   appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be
   misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.
"""

# Licence texts and usual notices as their stewards publish them.
_GNU = {"GPL": "GNU General Public License", "LGPL": "GNU Lesser General Public License", "AGPL": "GNU Affero General Public License"}
# an identifier in SPDX lines, and the name that it has here
_SPDX = {
    **{f"{kind}-{version}{end}": f"{kind}-{version}" for kind, versions in (
        ("GPL", ("1.0", "2.0", "3.0")), ("LGPL", ("2.0", "2.1", "3.0")), ("AGPL", ("3.0",)), ("GFDL", ("1.2", "1.3"))
    ) for version in versions for end in ("", "+", "-only", "-or-later")},
    **{name: name for name in (
        "MIT", "MIT-0", "ISC", "Zlib", "0BSD", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "Artistic-1.0-Perl",
        "Artistic-2.0", "BSL-1.0", "CC0-1.0", "CC-BY-3.0", "CC-BY-4.0", "CC-BY-SA-3.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0",
        "CC-BY-ND-4.0", "CC-BY-NC-SA-4.0", "CC-BY-NC-ND-4.0", "EPL-1.0", "EPL-2.0", "EUPL-1.2", "MPL-1.1", "MPL-2.0",
        "Unlicense", "WTFPL",
    )},
}
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at
"""
_APACHE_REST = """Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
_MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""


def _gnu_notices(name: str, version: str) -> list[str]:
    """The paragraph of the usual notice of a GNU licence that names it, in its forms."""
    found = []
    for program in ("This program", "This library"):
        for semicolon in (":", ";"):
            start = f"{program} is free software{semicolon} you can redistribute it and/or modify it under the terms of the"
            for by in (
                f"{name} as published by the Free Software Foundation, either version {version} of the License",
                f"{name} as published by the Free Software Foundation; either version {version} of the License",
            ):
                found += [f"{start} {by}, or (at your option) any later version."]
            found += [
                f"{start} {name} as published by the Free Software Foundation, version {version}.",
                f"{start} {name} version {version} as published by the Free Software Foundation.",
            ]
    return found


def _cc_notices(kind: str, words: str, version: str) -> list[str]:
    full = f"Creative Commons {words} {version} International License"
    return [
        f"Licensed under CC {kind} {version}.",
        f"This work is licensed under CC {kind} {version}.",
        f"Licensed under a {full}.",
        f"This work is licensed under a {full}.",
        f"This work is licensed under the {full}.",
    ]


def _whole_texts() -> dict[str, list[str]]:
    """The texts of ``license_files``, with and without their appendix."""
    found = {}
    for file in sorted(resources.files("asterism.llm").joinpath("license_files").iterdir(), key=lambda f: f.name):
        text = file.read_text("utf-8")
        body, end, appendix = text.partition("END OF TERMS AND CONDITIONS")
        forms = [text] + ([body, body + end] if appendix.strip() else [])
        title, _, rest = text.partition("\n")
        forms += [rest] if title.startswith("BSD ") else []
        found[file.name.removesuffix(".txt")] = forms
    return found


def _known_texts() -> dict[str, list[str]]:
    found: dict[str, list[str]] = {
        "MIT": [
            _MIT,
            _MIT.removeprefix("MIT License"),
            "Released under the MIT License.",
            "Licensed under the MIT License.",
        ],
        "ISC": [_ISC, _ISC.removeprefix("ISC License")],
        "Zlib": [_ZLIB, _ZLIB.removeprefix("zlib License")],
        "Apache-2.0": ["Licensed under the Apache License, Version 2.0."],
        "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3."],
        "MPL-2.0": [_MPL],
    }
    for url in ("http://www.apache.org/licenses/LICENSE-2.0", "https://apache.org/licenses/LICENSE-2.0"):
        found["Apache-2.0"] += [_APACHE, _APACHE + url, _APACHE + url + "\n" + _APACHE_REST]
    for kind, versions in (("GPL", ("2", "3")), ("LGPL", ("2.1", "3")), ("AGPL", ("3",))):
        for version in versions:
            name = f"{kind}-{version if '.' in version else version + '.0'}"
            found.setdefault(name, []).extend(_gnu_notices(_GNU[kind], version))
    for kind, words in (
        ("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"),
        ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
        ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
    ):
        found.setdefault(f"CC-{kind}-4.0", []).extend(_cc_notices(kind, words, "4.0"))
    for name, texts in _whole_texts().items():
        found.setdefault(name, []).extend(texts)
    for spdx, name in _SPDX.items():
        found.setdefault(name, []).append(f"SPDX-License-Identifier: {spdx}")
    return found


TEXTS = _known_texts()
