"""Passages by which licences are known: short headers, file notices and whole licence bodies.

Words between asterisks have to occur for a passage to match: without its name
or version, a short header could be that of any licence.
"""

from __future__ import annotations

# Public licence texts and the usual ways to name them.
SHORT: dict[str, tuple[str, ...]] = {
    "AGPL-3.0": ("Licensed under the GNU *Affero* General Public License, version *3*.", "GNU *Affero* General Public License Version *3*"),
    "Apache-2.0": ("Licensed under the *Apache* License, Version *2.0*.", "*Apache* License Version *2.0*", "Released under the *Apache* *2.0* License."),
    "BSD-2-Clause": ("Released under the *BSD* *2*-Clause License.", "*BSD* *2*-Clause License", "Simplified *BSD* License"),
    "BSD-3-Clause": ("Released under the *BSD* *3*-Clause License.", "*BSD* *3*-Clause License", "New *BSD* License"),
    "CC-BY-4.0": ("Licensed under *CC* *BY* *4.0*.", "Creative Commons *Attribution* *4.0* International License"),
    "CC-BY-NC-4.0": ("Licensed under *CC* *BY*-*NC* *4.0*.", "Creative Commons *Attribution*-*NonCommercial* *4.0* International License"),
    "CC-BY-SA-4.0": ("Licensed under *CC* *BY*-*SA* *4.0*.", "Creative Commons *Attribution*-*ShareAlike* *4.0* International License"),
    "CC0-1.0": ("Licensed under *CC0* 1.0.", "*CC0* 1.0 Universal Public Domain Dedication"),
    "GPL-2.0": (
        "This work is licensed under the GNU *General* *Public* License, version *2*.",
        "GNU *General* *Public* License Version *2*",
        "Licensed under the *GPL* version *2*.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU *General* *Public* License, version *3*.",
        "GNU *General* *Public* License Version *3*",
        "Licensed under the *GPL* version *3*.",
    ),
    "ISC": ("Released under the *ISC* License.", "The *ISC* License"),
    "LGPL-2.1": ("Licensed under the GNU *Lesser* General Public License, version *2.1*.", "GNU *Lesser* General Public License Version *2.1*"),
    "LGPL-3.0": ("Licensed under the GNU *Lesser* General Public License, version *3*.", "GNU *Lesser* General Public License Version *3*"),
    "MIT": ("Released under the *MIT* License.", "Licensed under the *MIT* License.", "The *MIT* License"),
    "MPL-2.0": ("This file is subject to the *Mozilla* Public License, version *2.0*.", "*Mozilla* Public License Version *2.0*"),
    "Unlicense": ("Released under the *Unlicense*.", "This is free and *unencumbered* software released into the public domain."),
}

_GNU = (
    "{work} is free software{mark} you can redistribute it and/or modify it under the terms of the GNU {kind} Public License as published by "
    "the Free Software Foundation, either version *{version}* of the License, or (at your option) any later version. "
)
_GNU_REST = (
    "{work} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
    "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind} Public License for more details."
)
_CLAUSES = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution. "
)
_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
    "software without specific prior written permission. "
)
_DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT "
    "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT "
    "HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT "
    "LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY "
    "THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF "
    "THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
    "\"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
    "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
    "following conditions: ",
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. ",
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY "
    "CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
    "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
)
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
    "above copyright notice and this permission notice appear in all copies. ",
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF "
    "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY "
    "DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
    "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
)
_APACHE = (
    "Licensed under the *Apache* License, Version *2.0* (the \"License\"); you may not use this file except in compliance with the License. You may "
    "obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 ",
    "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
    "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
    "limitations under the License.",
)
_UNLICENSE = (
    "This is free and *unencumbered* software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or "
    "distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."
)
_MPL = (
    "This Source Code Form is subject to the terms of the *Mozilla* Public License, v. 2.0. If a copy of the MPL was not distributed with this "
    "file, You can obtain one at http://mozilla.org/MPL/2.0/."
)
_GNU_KINDS = {
    "AGPL-3.0": ("This program", ":", "*Affero* General", "3"),
    "GPL-2.0": ("This program", ";", "General", "2"),
    "GPL-3.0": ("This program", ":", "General", "3"),
    "LGPL-2.1": ("This library", ";", "*Lesser* General", "2.1"),
    "LGPL-3.0": ("This library", ":", "*Lesser* General", "3"),
}

LONG: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (_APACHE[0], "".join(_APACHE)),
    "BSD-2-Clause": (_CLAUSES + _DISCLAIMER,),
    "BSD-3-Clause": (_CLAUSES + _THIRD + _DISCLAIMER,),
    "ISC": (_ISC[0], "".join(_ISC)),
    "MIT": (_MIT[0], "".join(_MIT)),
    "MPL-2.0": (_MPL,),
    "Unlicense": (_UNLICENSE,),
    **{
        name: (_GNU.format(work=work, mark=mark, kind=kind, version=version), (_GNU + _GNU_REST).format(work=work, mark=mark, kind=kind, version=version))
        for name, (work, mark, kind, version) in _GNU_KINDS.items()
    },
}


def identifier(name: str) -> str:
    """The machine-readable line of a licence, all words of whose name are needed."""
    return "SPDX-License-Identifier: " + "-".join(f"*{part}*" for part in name.split("-"))


TEMPLATES: dict[str, tuple[str, ...]] = {
    name: (*SHORT.get(name, ()), *LONG.get(name, ()), identifier(name)) for name in sorted({*SHORT, *LONG})
}
