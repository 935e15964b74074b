"""Notices and texts of public licences, by family and version. Fixed values."""

from __future__ import annotations

from regiostat.llm.license_texts import TEXTS

NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License.",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, '
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be "
        "included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", "
        "WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS "
        "OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
        "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR "
        "OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all "
        "copies.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version.",
    ),
    (
        "GPL-2.0-or-later",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation; either version 2 of the License, "
        "or (at your option) any later version.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
        "binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    (
        "CC-BY-NC-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
]

#: SPDX name of the GNU licences, the words of the title, versions.
GNU = [
    ("GPL", "General Public License", ["1.0", "2.0", "3.0"]),
    ("LGPL", "Library General Public License", ["2.0"]),
    ("LGPL", "Lesser General Public License", ["2.1", "3.0"]),
    ("AGPL", "Affero General Public License", ["3.0"]),
]
#: Name and words of the Creative Commons licences.
COMMONS = [
    ("BY", "Attribution"),
    ("BY-SA", "Attribution-ShareAlike"),
    ("BY-ND", "Attribution-NoDerivatives"),
    ("BY-NC", "Attribution-NonCommercial"),
    ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
    ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
]
PORTS = {"4.0": "International", "3.0": "Unported", "2.5": "Generic", "2.0": "Generic", "1.0": "Generic"}
#: Licences that are named in one line.
NAMED = [
    ("Apache-2.0", "Apache License, Version 2.0"),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("ISC", "ISC License"),
    ("MPL-1.1", "Mozilla Public License, Version 1.1"),
    ("MPL-2.0", "Mozilla Public License, Version 2.0"),
    ("EPL-1.0", "Eclipse Public License, Version 1.0"),
    ("EPL-2.0", "Eclipse Public License, Version 2.0"),
    ("BSL-1.0", "Boost Software License, Version 1.0"),
    ("Zlib", "zlib License"),
]

_AS_IS = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
    "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
    "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
    "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
    "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD = next(text for name, text in NOTICES if name == "BSD-2-Clause")
_NO_NAMES = (
    " Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission. "
)
_ISC = next(text for name, text in NOTICES if name == "ISC")
WHOLE = [
    ("BSD-2-Clause", f"{_BSD} {_AS_IS}"),
    ("BSD-3-Clause", f"{_BSD}{_NO_NAMES}"),
    ("BSD-3-Clause", f"{_BSD}{_NO_NAMES}{_AS_IS}"),
    (
        "ISC",
        f'{_ISC} THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE '
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
        "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, "
        "DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
]


def _gnu(name: str, title: str, version: str) -> list[tuple[str, str]]:
    short = version.removesuffix(".0")
    spdx, full = f"{name}-{version}", f"GNU {title}"
    kind = "library" if name == "LGPL" else "program"
    terms = f"This {kind} is free software: you can redistribute it and/or modify it under the terms of the {full}"
    found = []
    for verb in ("This work is licensed under the", "Licensed under the", "Released under the"):
        found += [
            (spdx, f"{verb} {full}, version {short}."),
            (spdx, f"{verb} {full} v{version}."),
            (f"{spdx}-or-later", f"{verb} {full}, version {short} or later."),
            (f"{spdx}-or-later", f"{verb} {full}, version {short}, or (at your option) any later version."),
        ]
    return [
        *found,
        (spdx, f"{terms} version {short} as published by the Free Software Foundation."),
        (spdx, f"{terms} as published by the Free Software Foundation, version {short} of the License."),
        (
            f"{spdx}-or-later",
            f"{terms} as published by the Free Software Foundation, either version {short} of the License, or (at "
            "your option) any later version.",
        ),
    ]


def _commons(name: str, words: str, version: str) -> list[tuple[str, str]]:
    spdx, port = f"CC-{name}-{version}", PORTS[version]
    if version < "4":
        words = words.replace("NoDerivatives", "NoDerivs")
    notice = f"This work is licensed under a Creative Commons {words} {version} {port} License."
    link = f"http://creativecommons.org/licenses/{name.lower()}/{version}/"
    return [
        (spdx, f"Licensed under CC {name} {version}."),
        (spdx, f"This work is licensed under CC {name} {version}."),
        (spdx, notice),
        (spdx, f"Licensed under the Creative Commons {words} {version} {port} License."),
        (spdx, f"{notice} To view a copy of this license, visit {link}."),
        (spdx, f"This work is licensed under {words} {version} {port}. To view a copy of this license, visit {link}."),
    ]


def _affero(text: str) -> str:
    """The Affero licence from the text of the GPL-3.0, of which it changes the names, preamble and section 13."""
    text = text.replace("GNU GENERAL PUBLIC LICENSE", "GNU AFFERO GENERAL PUBLIC LICENSE", 1)
    text = text.replace("refers to version 3 of the GNU General", "refers to version 3 of the GNU Affero General")
    start, end = text.index("The GNU General Public License is a free"), text.index("TERMS AND CONDITIONS")
    text = text[:start] + _AFFERO_PREAMBLE + text[end:]
    start, end = text.index("13. Use with the GNU Affero"), text.index("14. Revised Versions")
    head, tail = text[:start] + _AFFERO_SECTION, text[end:]
    tail = tail.replace("GNU General Public License", "GNU Affero General Public License")
    last = tail.find("If the program does terminal interaction")
    return head + (tail[:last] if last >= 0 else tail)


_AFFERO_PREAMBLE = """The GNU Affero General Public License is a free, copyleft license for software and other kinds of
works, specifically designed to ensure cooperation with the community in the case of network server software.
The licenses for most software and other practical works are designed to take away your freedom to share and change
the works. By contrast, our General Public Licenses are intended to guarantee your freedom to share and change all
versions of a program--to make sure it remains free software for all its users.
When we speak of free software, we are referring to freedom, not price. Our General Public Licenses are designed to
make sure that you have the freedom to distribute copies of free software (and charge for them if you wish), that you
receive source code or can get it if you want it, that you can change the software or use pieces of it in new free
programs, and that you know you can do these things.
Developers that use our General Public Licenses protect your rights with two steps: (1) assert copyright on the
software, and (2) offer you this License which gives you legal permission to copy, distribute and/or modify the
software.
A secondary benefit of defending all users' freedom is that improvements made in alternate versions of the program, if
they receive widespread use, become available for other developers to incorporate. Many developers of free software are
heartened and encouraged by the resulting cooperation. However, in the case of software used on network servers, this
result may fail to come about. The GNU General Public License permits making a modified version and letting the public
access it on a server without ever releasing its source code to the public.
The GNU Affero General Public License is designed specifically to ensure that, in such cases, the modified source code
becomes available to the community. It requires the operator of a network server to provide the source code of the
modified version running there to the users of that server. Therefore, public use of a modified version, on a publicly
accessible server, gives the public access to the source code of the modified version.
An older license, called the Affero General Public License and published by Affero, was designed to accomplish similar
goals. This is a different license, not a version of the Affero GPL, but Affero has released a new version of the
Affero GPL which permits relicensing under this license.
The precise terms and conditions for copying, distribution and modification follow.
"""
_AFFERO_SECTION = """13. Remote Network Interaction; Use with the GNU General Public License.
Notwithstanding any other provision of this License, if you modify the Program, your modified version must prominently
offer all users interacting with it remotely through a computer network (if your version supports such interaction) an
opportunity to receive the Corresponding Source of your version by providing access to the Corresponding Source from a
network server at no charge, through some standard or customary means of facilitating copying of software. This
Corresponding Source shall include the Corresponding Source for any work covered by version 3 of the GNU General Public
License that is incorporated pursuant to the following paragraph.
Notwithstanding any other provision of this License, you have permission to link or combine any covered work with a
work licensed under version 3 of the GNU General Public License into a single combined work, and to convey the
resulting work. The terms of this License will continue to apply to the part which is the covered work, but the work
with which it is combined will remain governed by version 3 of the GNU General Public License.
"""

#: Notices and texts as published.
TEMPLATES = [*NOTICES, *WHOLE, *TEXTS, ("AGPL-3.0", _affero(dict(TEXTS)["GPL-3.0"]))]
_lines = [
    *(row for name, title, versions in GNU for version in versions for row in _gnu(name, title, version)),
    *(row for version in PORTS for name, words in COMMONS for row in _commons(name, words, version)),
    *((name, f"{verb} under the {words}.") for name, words in NAMED for verb in ("Licensed", "Released")),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("CC0-1.0", "This work is licensed under a Creative Commons Zero 1.0 Universal License."),
    (
        "CC0-1.0",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
        "this work.",
    ),
]
#: Notices of every family, sibling and version; each once, in a fixed order.
LINES = [row for row in dict.fromkeys(_lines) if row not in TEMPLATES]
