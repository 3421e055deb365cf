"""Public license texts and notices that ``license_scan`` looks for by default. The wording is the licenses' own."""

MIT_BODY = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
    "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
    "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
    "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
    "substantial portions of the Software."
)
ISC_BODY = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
    "the above copyright notice and this permission notice appear in all copies."
)
BSD_BODY = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
    "are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution."
)
APACHE_HEADER = (
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
    "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
    "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
    "either express or implied."
)
GPL_HEADER = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
    "by the Free Software Foundation, either version {n} of the License, or (at your option) any later version."
)
MPL_HEADER = (
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
    "file, You can obtain one at http://mozilla.org/MPL/2.0/."
)
AS_IS = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR "
    "ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH "
    "THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
BSD_THIRD_CLAUSE = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
    "software without specific prior written permission."
)
BSD_DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT "
    "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
    "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
    "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) "
    "ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
ISC_DISCLAIMER = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES "
    "OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR "
    "ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS "
    "ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
BOOST_BODY = (
    "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying "
    "documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and "
    "to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the "
    "following: The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the "
    "following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, "
    "unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor."
)
BOOST_HEADER = (
    "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at "
    "http://www.boost.org/LICENSE_1_0.txt)"
)
UNLICENSE_BODY = (
    "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or "
    "distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any "
    "means."
)
ZLIB_BODY = (
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages "
    "arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial "
    "applications, and to alter it and redistribute it freely, subject to the following restrictions: The origin of this software must not be "
    "misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the "
    "product documentation would be appreciated but is not required. Altered source versions must be plainly marked as such, and must not be "
    "misrepresented as being the original software. This notice may not be removed or altered from any source distribution."
)
GNU_HEADER = (
    "This {what} is free software{stop} you can redistribute it and/or modify it under the terms of the GNU {kind} General Public License as "
    "published by the Free Software Foundation{pause} either version {n} of the License, or (at your option) any later version."
)


def _gnu(kind: str, n: str, what: str = "program") -> str:
    return GNU_HEADER.format(kind=kind, n=n, what=what, stop=":", pause=",")


EPL_HEADER = (
    "This program and the accompanying materials are made available under the terms of the Eclipse Public License {n} which accompanies this "
    "distribution, and is available at"
)
CREATIVE_COMMONS = ["BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"]
CREATIVE_COMMONS_VERSIONS = ["2.0", "2.5", "3.0", "4.0"]

TEMPLATES: list[tuple[str, str]] = [
    ("MIT", MIT_BODY), ("MIT", "Released under the MIT License."), ("MIT", "Licensed under the MIT License."), ("MIT", f"{MIT_BODY} {AS_IS}"),
    ("ISC", ISC_BODY), ("ISC", f"{ISC_BODY} {ISC_DISCLAIMER}"), ("BSD", BSD_BODY), ("BSD", "Licensed under the BSD License."),
    ("BSD-2-Clause", f"{BSD_BODY} {BSD_DISCLAIMER}"), ("BSD-3-Clause", f"{BSD_BODY} {BSD_THIRD_CLAUSE} {BSD_DISCLAIMER}"),
    ("Apache-2.0", APACHE_HEADER), ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-2.0", GPL_HEADER.format(n=2)), ("GPL-3.0", GPL_HEADER.format(n=3)),
    *((f"LGPL-{n}", _gnu("Lesser", "3" if n == "3.0" else n, what)) for n in ("2.1", "3.0") for what in ("program", "library")),
    ("LGPL-2.0", _gnu("Library", "2", "library")), ("AGPL-3.0", _gnu("Affero", "3")),
    *((f"GPL-{n}.0", f"This work is licensed under the GNU General Public License, version {n}.") for n in (2, 3)),
    *((f"LGPL-{n}", f"This work is licensed under the GNU Lesser General Public License, version {n}.") for n in ("2.1", "3.0")),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", MPL_HEADER), ("BSL-1.0", BOOST_BODY), ("BSL-1.0", BOOST_HEADER), ("Unlicense", UNLICENSE_BODY), ("Zlib", ZLIB_BODY),
    *((f"EPL-{n}", EPL_HEADER.format(n=f"v{n}" if n == "1.0" else n)) for n in ("1.0", "2.0")),
    *((f"CC-{kind}-{n}", f"Licensed under CC {kind} {n}.") for n in CREATIVE_COMMONS_VERSIONS for kind in CREATIVE_COMMONS),
    ("CC0-1.0", "Released under CC0 1.0 Universal public domain dedication."),
]
