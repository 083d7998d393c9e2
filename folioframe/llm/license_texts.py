"""Wordings of public licences and of the notices that refer to them, by identifier."""

_WARRANTY = (
    "{0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
    "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {1} for more details."
)


def _gnu(what: str, license: str, version: str) -> tuple[str, ...]:
    """Source notices of a GNU licence: this version or a later one, and this version alone."""
    terms = f"you can redistribute it and/or modify it under the terms of the GNU {license}"
    free, hope, by = f"This {what} is free software", _WARRANTY.format(f"This {what}", license), "as published by the Free Software Foundation"
    return (
        f"{free}: {terms} {by}, either version {version} of the License, or (at your option) any later version.\n{hope}",
        f"{free}; {terms} {by}; either version {version} of the License, or (at your option) any later version.",
        f"{free}: {terms} {by}, version {version} of the License.",
        f"{free}: {terms} {by}, version {version}.",
        f"{free}; {terms} version {version} {by}.",
    )


def _creative_commons(code: str, kind: str) -> tuple[str, ...]:
    return (
        f"Licensed under CC {code} 4.0.",
        f"This work is licensed under the Creative Commons {kind} 4.0 International License.",
        f"This work is licensed under a Creative Commons {kind} 4.0 International License.",
    )


TEMPLATES = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License. See LICENSE in the project root for license information.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions:\n"
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
        "the Software.\n"
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
        "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
        "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
        "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE "
        "SOFTWARE.",
    ),
    "ISC": (
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.\n"
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
        "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN "
        "AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE.",
    ),
    "BSD-2-Clause": (
        "Licensed under the BSD 2-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:\n"
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer.\n"
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution.",
    ),
    "BSD-3-Clause": (
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:\n"
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer.\n"
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution.\n"
        "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at\n"
        "http://www.apache.org/licenses/LICENSE-2.0\n"
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on "
        "an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        *_gnu("program", "General Public License", "3"),
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        *_gnu("program", "General Public License", "2"),
    ),
    "LGPL-3.0": (
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        *_gnu("library", "Lesser General Public License", "3"), *_gnu("program", "Lesser General Public License", "3"),
    ),
    "LGPL-2.1": (
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        *_gnu("library", "Lesser General Public License", "2.1"), *_gnu("program", "Lesser General Public License", "2.1"),
    ),
    "AGPL-3.0": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        *_gnu("program", "Affero General Public License", "3"),
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    "CC-BY-4.0": _creative_commons("BY", "Attribution"),
    "CC-BY-SA-4.0": _creative_commons("BY-SA", "Attribution-ShareAlike"),
    "CC-BY-NC-4.0": _creative_commons("BY-NC", "Attribution-NonCommercial"),
    "CC-BY-ND-4.0": _creative_commons("BY-ND", "Attribution-NoDerivatives"),
    "CC-BY-NC-SA-4.0": _creative_commons("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
    "CC-BY-NC-ND-4.0": _creative_commons("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
    "CC0-1.0": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    ),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
}
