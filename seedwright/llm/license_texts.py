"""Known licence texts and notices (public), by SPDX identifier."""

from __future__ import annotations

_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
    "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
    "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
    "conditions:")
_MIT_CONDITION = (
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
    "of the Software.")
_MIT_WARRANTY = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED "
    "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL "
    "THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
    "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
    "DEALINGS IN THE SOFTWARE.")
_ISC_GRANT = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted")
_ISC_CONDITION = (
    ", provided that the above copyright notice and this permission notice appear in all copies.")
_ISC_WARRANTY = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING "
    "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
    "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR "
    "PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION "
    "WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.")
_BSD_GRANT = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
    "the following conditions are met:")
_BSD_ONE = (
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer.")
_BSD_TWO = (
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
    "following disclaimer in the documentation and/or other materials provided with the distribution.")
_BSD_THREE = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission.")
_BSD_WARRANTY = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
    "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
    "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
    "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
    "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_APACHE_HEADER = (
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
    "with the License. You may obtain a copy of the License at\n\nhttp://www.apache.org/licenses/LICENSE-2.0\n\n"
    "Unless required by applicable law or agreed to in writing, software distributed under the License is "
    "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See "
    "the License for the specific language governing permissions and limitations under the License.")
_GPL3_HEADER = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
    "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
    "option) any later version.")

# Fixed values: (SPDX identifier, kind, text).
KNOWN = (
    ("MIT", "text", f"MIT License\n\n{_MIT_GRANT}\n\n{_MIT_CONDITION}\n\n{_MIT_WARRANTY}"),
    ("MIT", "text", f"{_MIT_GRANT}\n\n{_MIT_CONDITION}\n\n{_MIT_WARRANTY}"),
    ("MIT", "grant", _MIT_GRANT),
    ("ISC", "text", f"ISC License\n\n{_ISC_GRANT}{_ISC_CONDITION}\n\n{_ISC_WARRANTY}"),
    ("ISC", "text", f"{_ISC_GRANT}{_ISC_CONDITION}\n\n{_ISC_WARRANTY}"),
    ("0BSD", "text", f"{_ISC_GRANT}.\n\n{_ISC_WARRANTY}"),
    ("BSD-2-Clause", "text", f"{_BSD_GRANT}\n\n{_BSD_ONE}\n\n{_BSD_TWO}\n\n{_BSD_WARRANTY}"),
    ("BSD-3-Clause", "text", f"{_BSD_GRANT}\n\n{_BSD_ONE}\n\n{_BSD_TWO}\n\n{_BSD_THREE}\n\n{_BSD_WARRANTY}"),
    ("Apache-2.0", "header", _APACHE_HEADER),
    ("GPL-3.0-or-later", "header", _GPL3_HEADER),
    ("Apache-2.0", "notice", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "notice", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "notice", "Released under the MIT License."),
    ("MIT", "notice", "Licensed under the MIT License."),
    ("MIT", "notice", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0-only", "notice", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "notice", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-3.0-or-later", "notice", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("BSD-3-Clause", "notice", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD-2-Clause", "notice", "SPDX-License-Identifier: BSD-2-Clause"),
    ("CC-BY-4.0", "notice", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "notice", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "notice", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "notice", "Licensed under CC0 1.0."),
    ("MPL-2.0", "notice", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)

# Whole texts known by the SHA-256 of their canonical form
# (``license_digest.canonical``, blank-joined), so that long ones need no copy here.
KNOWN_DIGESTS = (
    ("Apache-2.0", "3f3112fe3656909b8bf79c7ec7988f83a43b47aeadf2b7d62205aaf449d9f1be"),
    ("Artistic-1.0-Perl", "66e644aafc5ff1de25be918be7e71d1d851bab015f750bc67c5b245e5f33ff39"),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("GFDL-1.2", "f06741c6c5feec30d99f80228f0d9ea6b884eae0e790ab18a0f4257184befa86"),
    ("GFDL-1.3", "80229e90e6f40a551a447f33ef48bd361a8e3166d53f29a2d1537245e2064feb"),
    ("GPL-1.0", "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224"),
    ("GPL-2.0", "b866f5427b78991db8012466b32f51c907f5e974fde5129a47372d0d0552e3a1"),
    ("GPL-3.0", "f3ab5ee40da170411ea6671f9845ada2aaba303ee57ba6086b373d1e66c9dc3f"),
    ("LGPL-2.0", "9b0b3105b96203f9d9e4b72d4b77951152156c88139302b5aedf6295e3ceaaa3"),
    ("LGPL-2.1", "cb225061bb71741fe8b31a2092e22fe05b1130438158ae5d16c48fd50186e345"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "1cfb6cca26abe2169c9c61164807107b2d4a0b64955a2cf2de46fad3483acda1"),
    ("MPL-2.0", "495fa95ad25ec5a3b5101126af2c1a2a1c71e57f448bbb2e4f05ef70be3384b6"),
)

# Spellings that count as the same, after lower case.
EQUIVALENT = (
    ("licence", "license"), ("sub-license", "sublicense"), ("sub license", "sublicense"),
    ("non-infringement", "noninfringement"), ("merchantibility", "merchantability"),
    ("copyright owner", "copyright holder"), ("favour", "favor"), ("http://", "https://"),
    ("organisation", "organization"), ("authorisation", "authorization"), ("v. 2.0", "version 2.0"),
)
