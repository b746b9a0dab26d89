"""Templates of license texts, notices and names, in the markup of ``license_scan``.

Fixed values: mandatory wording is that of the published licenses. Names of holders and of software are replaceable,
wording that circulating versions leave out is optional. Punctuation doesn't count, so it stands as published.
"""

from __future__ import annotations

_HOLDERS = "<<any:[^ ]+:1-20>>"
_OR_LATER = "<<optional>> or <<optional>> at your option <<end>> any later version <<end>>"

_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so"""
_MIT_NOTICE = """, subject to the following conditions: The above copyright notice and this permission notice
<<optional>> (including the next paragraph) <<end>> shall be included in all copies or substantial portions of the Software."""
_MIT_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL"""
_MIT_LIABILITY = """BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING
FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_MIT_END = f"{_MIT_WARRANTY} {_HOLDERS} {_MIT_LIABILITY}"

_BSD_HEAD = """Redistribution and use <<optional>> of this software <<end>> in source and binary forms, with or without modification, are
permitted provided that the following conditions are met: """
_BSD_SOURCE = """<<optional>> 1 <<end>> Redistributions of source code must retain the above copyright notice, this list of conditions
and the following disclaimer. """
_BSD_BINARY = """<<optional>> 2 <<end>> Redistributions in binary form must reproduce the above copyright notice, this list of
conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. """
_BSD_ADVERTISING = f"""<<optional>> 3 <<end>> All advertising materials mentioning features or use of this software must display the
following acknowledgement: This product includes software developed by {_HOLDERS} """
_BSD_NAMES = f"""<<optional>> <<any:[34]:1-1>> <<end>> Neither the name of {_HOLDERS} nor the names of its contributors may be used
to endorse or promote products derived from this software without specific prior written permission. """
_BSD_END = f"""THIS SOFTWARE IS PROVIDED BY {_HOLDERS} "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO,
THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL {_HOLDERS} BE
LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO,
PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY
THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT
OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

_ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"""
_ISC_GRANT_OLD = """Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted"""
_ISC_END = f"""THE SOFTWARE IS PROVIDED "AS IS" AND {_HOLDERS} DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL {_HOLDERS} BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_ISC_NOTICE = "provided that the above copyright notice and this permission notice appear in all copies. "


def _gnu(name: str, numbers: str) -> str:
    """The notice that the GNU licenses ask to put at the start of files."""
    return f"""<<any:[^ ]+:1-6>> is free software<<optional>>: you can<<end>> <<optional>>; you can<<end>> redistribute it and/or modify it under
    the terms of the GNU {name} <<optional>> as published by the Free Software Foundation<<end>>
    <<optional>> ; either <<end>> version {numbers} <<optional>> of the License <<end>> {_OR_LATER}"""


#: Label to the words that name a license after "SPDX-License-Identifier:".
SPDX = {
    "0bsd": "0BSD", "agpl-3.0": "AGPL-3.0", "apache-2.0": "Apache-2.0", "bsd-2-clause": "BSD-2-Clause", "bsd-3-clause": "BSD-3-Clause",
    "bsl-1.0": "BSL-1.0", "cc0-1.0": "CC0-1.0", "gpl-2.0": "GPL-2.0", "gpl-3.0": "GPL-3.0", "isc": "ISC", "lgpl-2.1": "LGPL-2.1",
    "lgpl-3.0": "LGPL-3.0", "mit": "MIT", "mpl-2.0": "MPL-2.0", "unlicense": "Unlicense", "wtfpl": "WTFPL", "zlib": "Zlib",
}

#: Label to templates; a label is found where one of its templates is accepted.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "0bsd": (f"{_ISC_GRANT}. {_ISC_END}",),
    "agpl-3.0": (_gnu("Affero General Public License", "3"),),
    "apache-2.0": (
        "<<optional>> this work is <<end>> licensed under the apache license <<optional>> version <<end>> 2 <<optional>> 0 <<end>>",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this <<any:file|work|software|project:1-1>> except in
        compliance with the License. You may obtain a copy of the License at <<optional>> http <<end>> <<optional>> https <<end>>
        www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under
        the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See
        the License for the specific language governing permissions and limitations under the License.""",
    ),
    "beerware": ("""<<any:[^ ]+:1-12>> wrote this file. As long as you retain this notice you can do whatever you want with this stuff. If we meet some
        day, and you think this stuff is worth it, you can buy me a beer in return""",),
    "bsd": ("redistribution and use <<optional>> of this software <<end>> in source and binary forms with or without modification are permitted provided that the following conditions are met",),
    "bsd-2-clause": (_BSD_HEAD + _BSD_SOURCE + _BSD_BINARY + _BSD_END,),
    "bsd-3-clause": (_BSD_HEAD + _BSD_SOURCE + _BSD_BINARY + _BSD_NAMES + _BSD_END,),
    "bsd-4-clause": (_BSD_HEAD + _BSD_SOURCE + _BSD_BINARY + _BSD_ADVERTISING + _BSD_NAMES + _BSD_END,),
    "bsl-1.0": ("""Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying
        documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software,
        and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject
        to the following: The copyright notices in the Software and this entire statement, including the above license grant, this
        restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative
        works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by
        a source language processor. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
        LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE
        COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR
        OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",),
    "cc-by-nc": ("<<any:licensed|released|shared:1-1>> under <<optional>> a <<end>> <<optional>> creative commons <<end>> cc by nc <<optional>> sa <<end>> <<optional>> nd <<end>> <<any:[0-9]+:1-2>>",),
    "cc0-1.0": ("""To the extent possible under law, <<any:[^ ]+:1-12>> has waived all copyright and related or neighboring rights to this work""",
        """The person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights to
        the work worldwide under copyright law, including all related and neighboring rights, to the extent allowed by law."""),
    "copyright": ("copyright <<optional>> c <<end>> <<any:(?:19|20)[0-9][0-9]:1-3>> <<any:[^ ]+:1-12>> all rights reserved",),
    "curl": ("""Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the
        above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND,
        EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
        NONINFRINGEMENT OF THIRD PARTY RIGHTS. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
        LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR
        OTHER DEALINGS IN THE SOFTWARE.""",),
    "fsfap": ("""Copying and distribution of this file, with or without modification, are permitted in any medium without royalty provided the
        copyright notice and this notice are preserved. <<optional>> This file is offered as-is, without any warranty. <<end>>""",),
    "gpl-2.0": (f"<<optional>> this work is <<end>> licensed under the gnu general public license <<optional>> version <<end>> 2 <<optional>> 0 <<end>> {_OR_LATER}", _gnu("General Public License", "2")),
    "gpl-3.0": (f"<<optional>> this work is <<end>> licensed under the gnu general public license <<optional>> version <<end>> 3 <<optional>> 0 <<end>> {_OR_LATER}", _gnu("General Public License", "3")),
    "hpnd": (f"""Permission to use, copy, modify <<optional>> and <<end>> distribute <<optional>> and sell <<end>> this software and its documentation for any
        purpose <<optional>> and without fee <<end>> is hereby granted <<optional>> without fee <<end>>, provided that the above copyright notice
        <<any:appear|appears:1-1>> in all copies <<optional>> , <<end>> and that both that copyright notice and this permission notice appear in
        supporting documentation, and that the name of {_HOLDERS} not be used in advertising or publicity pertaining to distribution of the
        software without specific, written prior permission.""",),
    "isc": (f"{_ISC_GRANT}, {_ISC_NOTICE} {_ISC_END}", f"{_ISC_GRANT_OLD}, {_ISC_NOTICE} {_ISC_END}"),
    "json": ("The Software shall be used for Good, not Evil.",),
    "lgpl-2.1": (_gnu("Lesser General Public License", "2.1"),),
    "lgpl-3.0": (_gnu("Lesser General Public License", "3"),),
    "mit": (
        "<<any:licensed|released|distributed|available:1-1>> under the <<optional>> terms of the <<end>> mit license",
        _MIT_GRANT + _MIT_NOTICE + _MIT_END,
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction",
    ),
    "mit-0": (f"{_MIT_GRANT}. {_MIT_END}",),
    "mpl-2.0": ("""This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this
        file, You can obtain one at <<optional>> http <<end>> <<optional>> https <<end>> mozilla.org/MPL/2.0/.""",),
    "ncsa": (f"""{_MIT_GRANT}, subject to the following conditions: Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimers. Redistributions in binary form must reproduce the above copyright notice, this list of conditions
        and the following disclaimers in the documentation and/or other materials provided with the distribution. Neither the names of {_HOLDERS}
        nor the names of its contributors may be used to endorse or promote products derived from this Software without specific prior written
        permission.""",),
    "postgresql": (f"""Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written
        agreement is hereby granted, provided that the above copyright notice and this paragraph and the following two paragraphs appear in all
        copies. IN NO EVENT SHALL {_HOLDERS} BE LIABLE TO ANY PARTY FOR DIRECT, INDIRECT, SPECIAL, INCIDENTAL, OR CONSEQUENTIAL DAMAGES, INCLUDING
        LOST PROFITS, ARISING OUT OF THE USE OF THIS SOFTWARE AND ITS DOCUMENTATION, EVEN IF {_HOLDERS} HAS BEEN ADVISED OF THE POSSIBILITY OF SUCH
        DAMAGE.""",),
    "unlicense": ("""This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or
        distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any
        means. <<optional>> In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright
        interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our
        heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this
        software under copyright law. <<end>>""",),
    "wtfpl": ("""Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the
        name is changed. DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE TERMS AND CONDITIONS FOR COPYING, DISTRIBUTION AND MODIFICATION 0. You just DO
        WHAT THE FUCK YOU WANT TO.""",),
    "x11": (f"""{_MIT_GRANT}{_MIT_NOTICE} {_MIT_END} Except as contained in this notice, the name of {_HOLDERS} shall not be used in advertising or
        otherwise to promote the sale, use or other dealings in this Software without prior written authorization""",),
    "zlib": ("""This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages
        arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications,
        and to alter it and redistribute it freely, subject to the following restrictions: <<optional>> 1 <<end>> The origin of this software must not be
        misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product
        documentation would be appreciated but is not required. <<optional>> 2 <<end>> Altered source versions must be plainly marked as such, and must
        not be misrepresented as being the original software. <<optional>> 3 <<end>> This notice may not be removed or altered from any source
        distribution.""",),
}
for _label, _name in SPDX.items():
    TEMPLATES[_label] = (*TEMPLATES[_label], f"SPDX-License-Identifier: {_name}")
