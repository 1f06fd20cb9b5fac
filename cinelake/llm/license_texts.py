"""Licence notices and short licences."""

# Notices, titles and full texts of short licences as their publishers word them. Long licences (Apache, GNU,
# Mozilla, Eclipse, Creative Commons) are known by their titles and by the notices that they ask for.
_WARRANTY_MIT = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_GRANT_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
    "persons to whom the Software is furnished to do so, subject to the following conditions:"
)
_NOTICE_MIT = "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
_OPENING_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:"
)
_CLAUSES_BSD = (
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
    "following disclaimer in the documentation and/or other materials provided with the distribution."
)
_NAME_BSD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission."
)
_WARRANTY_BSD = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
    "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
    "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_GRANT_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
    "provided that the above copyright notice and this permission notice appear in all copies."
)
_WARRANTY_ISC = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
    "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
    "THIS SOFTWARE."
)
_GNU = (
    "This {what} is free software{sep} you can redistribute it and/or modify it under the terms of the {name} as published by the "
    "Free Software Foundation{sep2} either version {version} of the License, or (at your option) any later version."
)
_GNU_ONLY = (
    "This {what} is free software; you can redistribute it and/or modify it under the terms of the {name} as published by the "
    "Free Software Foundation; version {version}."
)
_GPL, _LGPL, _AGPL = "GNU General Public License", "GNU Lesser General Public License", "GNU Affero General Public License"
_GNU_VERSIONS = (
    ("GPL-2.0", _GPL, "program", "2"), ("GPL-3.0", _GPL, "program", "3"), ("AGPL-3.0", _AGPL, "program", "3"),
    ("LGPL-2.1", _LGPL, "library", "2.1"), ("LGPL-3.0", _LGPL, "library", "3"),
)
_CC = (
    ("CC-BY-4.0", "Attribution", "BY"), ("CC-BY-SA-4.0", "Attribution-ShareAlike", "BY-SA"), ("CC-BY-NC-4.0", "Attribution-NonCommercial", "BY-NC"),
    ("CC-BY-ND-4.0", "Attribution-NoDerivatives", "BY-ND"), ("CC-BY-NC-SA-4.0", "Attribution-NonCommercial-ShareAlike", "BY-NC-SA"),
    ("CC-BY-NC-ND-4.0", "Attribution-NonCommercial-NoDerivatives", "BY-NC-ND"),
)
_TITLES = (
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("EPL-2.0", "Eclipse Public License - v 2.0"),
    ("EPL-1.0", "Eclipse Public License - v 1.0"),
    ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003"),
)
_NAMED = (
    ("Apache-2.0", "Apache License, Version 2.0"), ("MIT", "MIT License"), ("ISC", "ISC License"), ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-3-Clause", "BSD 3-Clause License"), ("MPL-2.0", "Mozilla Public License, version 2.0"),
    ("GPL-2.0", "GNU General Public License, version 2"), ("GPL-3.0", "GNU General Public License, version 3"),
    ("AGPL-3.0", "GNU Affero General Public License, version 3"), ("LGPL-2.1", "GNU Lesser General Public License, version 2.1"),
    ("LGPL-3.0", "GNU Lesser General Public License, version 3"), ("EPL-2.0", "Eclipse Public License, version 2.0"),
)
_SPDX = (
    "Apache-2.0", "MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "0BSD", "GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only",
    "GPL-3.0-or-later", "AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later", "LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0",
    "LGPL-3.0-only", "LGPL-3.0-or-later", "MPL-2.0", "EPL-1.0", "EPL-2.0", "BSL-1.0", "Zlib", "Unlicense", "CC0-1.0", "CC-BY-4.0",
    "CC-BY-SA-4.0", "CC-BY-NC-4.0", "CC-BY-ND-4.0", "CC-BY-NC-SA-4.0", "CC-BY-NC-ND-4.0",
)
_OTHERS = (
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License.",
    ),
    ("MIT", f"{_GRANT_MIT} {_NOTICE_MIT}"),
    ("MIT", f"{_GRANT_MIT} {_NOTICE_MIT} {_WARRANTY_MIT}"),
    ("BSD-2-Clause", f"{_OPENING_BSD} {_CLAUSES_BSD} {_WARRANTY_BSD}"),
    ("BSD-3-Clause", f"{_OPENING_BSD} {_CLAUSES_BSD} {_NAME_BSD} {_WARRANTY_BSD}"),
    ("BSD", _OPENING_BSD),
    ("ISC", _GRANT_ISC),
    ("ISC", f"{_GRANT_ISC} {_WARRANTY_ISC}"),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. " + _WARRANTY_ISC),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    (
        "EPL-2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which "
        "is available at https://www.eclipse.org/legal/epl-2.0/",
    ),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("CC0-1.0", "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this software to the public domain worldwide."),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means.",
    ),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable "
        "for any damages arising from the use of this software. Permission is granted to anyone to use this software for any "
        "purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following "
        "restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original "
        "software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but "
        "is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the "
        "original software. 3. This notice may not be removed or altered from any source distribution.",
    ),
    (
        "BSL-1.0",
        "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at "
        "https://www.boost.org/LICENSE_1_0.txt)",
    ),
)
#: Words that tell licences apart. Of these and of numbers, a match must have those of its template, and no other such name.
NAMES = (
    "affero", "lesser", "library", "noncommercial", "sharealike", "noderivatives", "nc", "sa", "nd", "mit", "isc", "bsd", "0bsd", "apache",
    "mozilla", "mpl", "eclipse", "epl", "boost", "bsl", "gpl", "lgpl", "agpl", "gnu", "cc", "cc0", "zlib", "unlicense", "2007", "1991", "1999",
    "neither", "clause",
)


def _spdx_name(identifier: str) -> str:
    return identifier.removesuffix("-only").removesuffix("-or-later")


TEMPLATES: tuple[tuple[str, str], ...] = (
    *_OTHERS,
    *((name, _GNU.format(what=what, name=n, version=v, sep=";", sep2=";")) for name, n, what, v in _GNU_VERSIONS),
    *((name, _GNU.format(what="program", name=n, version=v, sep=";", sep2=";")) for name, n, what, v in _GNU_VERSIONS if what != "program"),
    *((name, _GNU_ONLY.format(what=what, name=n, version=v)) for name, n, what, v in _GNU_VERSIONS),
    *_TITLES,
    *((name, f"{how} under the {title}.") for name, title in _NAMED for how in ("Licensed", "Released", "Distributed", "This work is licensed")),
    *((name, f"This work is licensed under a Creative Commons {title} 4.0 International License.") for name, title, _ in _CC),
    *((name, f"Licensed under CC {short} 4.0.") for name, _, short in _CC),
    *((_spdx_name(x), f"SPDX-License-Identifier: {x}") for x in _SPDX),
)
