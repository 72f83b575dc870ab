"""Public licence texts, licence notices and equivalent spellings.

Full texts of long licences lie in ``licence_files``, a file per licence. Not known: AGPL, the Unlicense, CC-BY texts,
EPL, EUPL, BSL and any text not named here.
"""

from pathlib import Path

_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
    "permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\n"
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
    "the Software.\n\n"
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
    "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
    "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_ISC_DISCLAIMER = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
    "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
    "THIS SOFTWARE.")
_BSD_START = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
              "the following conditions are met:\n\n")
_BSD_1_2 = (
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
    "the following disclaimer in the documentation and/or other materials provided with the distribution.\n\n")
_BSD_3 = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
          "products derived from this software without specific prior written permission.\n\n")
_BSD_END = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
    "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF "
    "USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
    "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED "
    "OF THE POSSIBILITY OF SUCH DAMAGE.")

LICENCES = {
    "MIT": _MIT_GRANT,
    "MIT (titled)": "MIT License\n\n" + _MIT_GRANT,
    "ISC": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies.\n\n" + _ISC_DISCLAIMER),
    "0BSD": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
             "granted.\n\n" + _ISC_DISCLAIMER),
    "BSD-2-Clause": _BSD_START + _BSD_1_2 + _BSD_END,
    "BSD-3-Clause": _BSD_START + _BSD_1_2 + _BSD_3 + _BSD_END,
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable "
        "for any damages arising from the use of this software.\n\nPermission is granted to anyone to use this software for any "
        "purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following "
        "restrictions:\n\n1. The origin of this software must not be misrepresented; you must not claim that you wrote the original "
        "software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but "
        "is not required.\n2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the "
        "original software.\n3. This notice may not be removed or altered from any source distribution."),
    "Apache-2.0 (notice)": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
        "License. You may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."),
    "MPL-2.0 (notice)": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
        "with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
}

# title lines that stand in front of a text; the copyright line below them is dropped by the canonical form
TITLES = {
    "MIT": ("The MIT License (MIT)", "The MIT License"),
    "ISC": ("ISC License", "The ISC License"),
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The 2-Clause BSD License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The 3-Clause BSD License", "New BSD License"),
    "Zlib": ("zlib License", "The zlib License"),
}


def _bullets(text: str, mark: str) -> str:
    for k in "123":
        text = text.replace(f"{k}. ", mark)
    return text


for _name in ("BSD-2-Clause", "BSD-3-Clause"):
    LICENCES[f"{_name} (bullets)"] = _bullets(LICENCES[_name], "* ")
for _name in [n for n in LICENCES if n.removesuffix(" (bullets)") in TITLES]:
    for _title in TITLES[_name.removesuffix(" (bullets)")]:
        LICENCES[f"{_name} ({_title})"] = f"{_title}\n\n{LICENCES[_name]}"
LICENCES |= {f.stem: f.read_text(encoding="utf-8") for f in sorted((Path(__file__).parent / "licence_files").glob("*.txt"))}

NOTICES = {
    "MIT": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
}

# (variant, usual spelling), in lower case
SPELLINGS = (
    ("licence", "license"), ("sub-license", "sublicense"), ("sub license", "sublicense"),
    ("non-infringement", "noninfringement"), ("non infringement", "noninfringement"),
    ("acknowledgement", "acknowledgment"), ("organisation", "organization"), ("authoris", "authoriz"),
    ("favour", "favor"), ("behaviour", "behavior"), ("merchantibility", "merchantability"),
    ("and/or", "and or"), ("https://", "http://"), ("per cent", "percent"), ("copyright owner", "copyright holder"),
)
