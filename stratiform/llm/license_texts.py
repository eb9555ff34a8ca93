"""Known licences: whole texts, and the one-line notices that name a licence."""

from __future__ import annotations

from pathlib import Path

# Public licence texts, without their copyright lines.
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
{third}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

TEXTS = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.""",
    "BSD-2-Clause": _BSD.format(third=""),
    "BSD-3-Clause": _BSD.format(
        third="""
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission.
"""
    ),
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it
and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If
you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not
required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution.""",
}

# Names of licences as notices give them, and the words before them.
NAMES = {
    "MIT": ["MIT License", "MIT"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0"],
    "GPL-2.0": ["GNU General Public License, version 2", "GNU GPL version 2"],
    "GPL-3.0": ["GNU General Public License, version 3", "GNU GPL version 3"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3"],
    "AGPL-3.0": ["GNU Affero General Public License, version 3"],
    "MPL-2.0": ["Mozilla Public License, version 2.0"],
    "BSD-3-Clause": ["BSD 3-Clause License"],
    "CC-BY-4.0": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0"],
    "CC0-1.0": ["CC0 1.0"],
}
#: More names, which the SQL of the scan hasn't.
MORE_NAMES = {
    "BSD-2-Clause": ["BSD 2-Clause License"],
    "ISC": ["ISC License"],
    "Zlib": ["zlib License"],
}
LEADS = ["Licensed under", "Released under", "Distributed under", "This work is licensed under", "This project is licensed under"]


#: Whole texts in files, by licence and _edition, and where the parts begin that copies often leave out.
FILES = Path(__file__).with_name("licenses")
_LAST = ("END OF TERMS AND CONDITIONS", "ADDENDUM: How to use")


def _notices(names: dict[str, list[str]]) -> list[tuple[str, str]]:
    return [
        (licence, f"{lead} {article}{name}.")
        for licence, said in names.items()
        for name in said
        for lead in LEADS
        for article in ("", "the ")
    ]


def known() -> list[tuple[str, str]]:
    """(licence, text) of the texts above and of their notices, made by lead, article and name."""
    return [*TEXTS.items(), *_notices(NAMES)]


def long_texts() -> list[tuple[str, str]]:
    """(licence, text) of the texts in files: whole, and with and without the line that ends the terms."""
    out = []
    for file in sorted(FILES.glob("*.txt")):
        whole, licence = file.read_text("utf-8"), file.stem.partition("_")[0]
        out.append((licence, whole))
        for mark in _LAST:
            terms, found, _ = whole.partition(mark)
            if found:
                out += [(licence, terms), *([(licence, terms + mark)] if mark in _LAST[:1] else [])]
    return out


def every() -> list[tuple[str, str]]:
    """(licence, text) of all that is known."""
    return [*known(), *long_texts(), *_notices(MORE_NAMES)]
