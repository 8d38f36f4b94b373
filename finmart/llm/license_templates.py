"""Texts of well-known licences and licence notices, without names and years."""

from pathlib import Path

# Public licence texts.
TEMPLATES = {
    "MIT": """
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction,
including without limitation the rights to use, copy, modify, merge, publish, distribute,
sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or
substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT
NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
""",
    "ISC": """
Permission to use, copy, modify, and/or distribute this software for any purpose with or without
fee is hereby granted, provided that the above copyright notice and this permission notice appear
in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS
SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE
AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE
OF THIS SOFTWARE.
""",
    "BSD-2-Clause": """
Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions
and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of
conditions and the following disclaimer in the documentation and/or other materials provided with
the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR
IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR
CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE,
DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER
IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT
OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
""",
    "Zlib": """
This software is provided 'as-is', without any express or implied warranty. In no event will the
authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial
applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the
original software. If you use this software in a product, an acknowledgment in the product
documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being
the original software.

3. This notice may not be removed or altered from any source distribution.
""",
    "Apache-2.0": """
Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License
is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or
implied. See the License for the specific language governing permissions and limitations under the
License.
""",
    "GPL-3.0-or-later": """
This program is free software: you can redistribute it and/or modify it under the terms of the GNU
General Public License as published by the Free Software Foundation, either version 3 of the
License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without
even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU
General Public License for more details.

You should have received a copy of the GNU General Public License along with this program. If not,
see <https://www.gnu.org/licenses/>.
""",
}

_GNU = TEMPLATES["GPL-3.0-or-later"]
_LESSER = _GNU.replace("General Public", "Lesser General Public")
_OLD = _GNU.replace("is free software: you", "is free software; you").replace("either version 3", "either version 2").replace(
    "If not,\nsee <https://www.gnu.org/licenses/>.",
    "if\nnot, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA\n02110-1301 USA.")
TEMPLATES |= {
    "BSD-3-Clause": TEMPLATES["BSD-2-Clause"].replace("""the distribution.
""", """the distribution.

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse
or promote products derived from this software without specific prior written permission.
"""),
    "GPL-2.0-or-later": _OLD,
    "LGPL-3.0-or-later": _LESSER,
    "LGPL-2.1-or-later": _OLD.replace("This program", "This library").replace("this program", "this library").replace(
        "General Public", "Lesser General Public").replace("either version 2", "either version 2.1"),
    "AGPL-3.0-or-later": _GNU.replace("General Public", "Affero General Public"),
    "MPL-2.0": """
This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the
MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.
""",
}
# One-line notices.
NOTICES = {
    "MIT": ("Released under the MIT License.", "This project is licensed under the MIT License.",
            "Licensed under the MIT License."),
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0.", "Released under the Apache License, Version 2.0.",
                   "This work is licensed under the Apache License, Version 2.0."),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.",
                "Released under the GNU General Public License, version 3."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under CC BY-NC 4.0.",
                     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under CC BY 4.0.",
                  "This work is licensed under a Creative Commons Attribution 4.0 International License."),
}


def _lines(name: str, *also: str) -> tuple[str, ...]:
    return tuple(f"{start} {what}." for what in (name, *also)
                 for start in ("Licensed under", "Released under", "This work is licensed under", "This project is licensed under"))


_CREATIVE = {"BY": "Attribution", "NC": "NonCommercial", "SA": "ShareAlike", "ND": "NoDerivatives"}
NOTICES = {name: (*NOTICES.get(name, ()), *several) for name, several in (NOTICES | {
    "MIT": _lines("the MIT License"), "ISC": _lines("the ISC License"),
    "BSD-2-Clause": _lines("the BSD 2-Clause License"), "BSD-3-Clause": _lines("the BSD 3-Clause License"),
    "Apache-2.0": _lines("the Apache License, Version 2.0"), "MPL-2.0": _lines("the Mozilla Public License, version 2.0"),
    **{f"{short}GPL-{v}": _lines(f"the GNU {full}General Public License, version {v.removesuffix('.0')}")
       for short, full, v in (("", "", "2.0"), ("", "", "3.0"), ("L", "Lesser ", "2.1"), ("L", "Lesser ", "3.0"), ("A", "Affero ", "3.0"))},
    **{f"CC-{terms}-4.0": _lines(f"CC {terms} 4.0", "a Creative Commons " + "-".join(_CREATIVE[t] for t in terms.split("-")) + " 4.0 International License")
       for terms in ("BY", "BY-SA", "BY-ND", "BY-NC", "BY-NC-SA", "BY-NC-ND")},
    "CC0-1.0": _lines("CC0 1.0 Universal", "a Creative Commons Zero 1.0 Universal License"),
}).items()}

# Whole public texts, one file each.
BODIES = {path.stem: path.read_text("utf-8") for path in sorted((Path(__file__).parent / "licences").glob("*.txt"))}
