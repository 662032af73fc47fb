"""Templates of the licence scan: notices, the lines that documents name a licence in, and whole texts.

``DISTINCT`` has for a template the words that tell its licence from others much like it. They
must stand side by side in a text, at one place at least, whatever else is covered.
"""

from __future__ import annotations

from importlib import resources

_AS_IS = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution. "
)
_GPL = (
    "{0} is free software: you can redistribute it and/or modify it under the terms of the GNU {1} Public License as "
    "published by the Free Software Foundation, either version {2} of the License, or (at your option) any later version."
)

NOTICES = {
    "GPL-2.0": _GPL.format("This program", "General", "2"),
    "LGPL-2.1": _GPL.format("This library", "Lesser General", "2.1"),
    "LGPL-3.0": _GPL.format("This program", "Lesser General", "3"),
    "AGPL-3.0": _GPL.format("This program", "Affero General", "3"),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "BSD-2-Clause": _BSD + _AS_IS,
    "BSD-3-Clause": _BSD
    + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission. " + _AS_IS,
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors "
        "of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication "
        "for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to "
        "be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law."
    ),
}
_CC = {
    "CC-BY": "Attribution", "CC-BY-ND": "Attribution-NoDerivatives", "CC-BY-NC": "Attribution-NonCommercial",
    "CC-BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "CC-BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
LINES = {
    "BSD line": "Released under the BSD License.",
    "BSD-2-Clause line": "Released under the BSD 2-Clause License.",
    "BSD-3-Clause line": "Released under the BSD 3-Clause License.",
    "ISC line": "Released under the ISC License.",
    "MPL-2.0 line": "Licensed under the Mozilla Public License, Version 2.0.",
    "GPL-2.0 line": "Licensed under the GNU General Public License, version 2.",
    "LGPL-2.1 line": "Licensed under the GNU Lesser General Public License, version 2.1.",
    "LGPL-3.0 line": "Licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0 line": "Licensed under the GNU Affero General Public License, version 3.",
    "CC-BY line": "Licensed under CC BY 4.0.",
    "CC-BY-SA short line": "Licensed under CC BY-SA 4.0.",
    "CC-BY-ND line": "Licensed under CC BY-ND 4.0.",
    "CC-BY-NC-SA line": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-NC-ND line": "Licensed under CC BY-NC-ND 4.0.",
    "CC0 line": "Licensed under CC0 1.0.",
    "Unlicense line": "Released into the public domain under the Unlicense.",
} | {f"{k} long line": f"This work is licensed under a Creative Commons {v} 4.0 International License." for k, v in _CC.items()}

#: Whole texts, as files beside this module.
BODIES = {
    f"{name} text": resources.files(__package__).joinpath("licenses", f"{name}.txt").read_text("utf-8")
    for name in (
        "Apache-2.0", "Artistic-1.0", "CC0-1.0", "GFDL-1.3", "GPL-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0",
        "MPL-1.1", "MPL-2.0",
    )
}

DISTINCT = {
    "MIT line": ["mit license"],
    "Apache-2.0": ["apache license", "2 0"],
    "Apache-2.0 line": ["apache license", "2 0"],
    "GPL": ["gnu general public license", "version 3"],
    "GPL line": ["gnu general public license version 3"],
    "CC-BY-NC line": ["cc by nc 4 0"],
    "CC-BY-SA line": ["creative commons attribution sharealike 4 0"],
    "GPL-2.0": ["gnu general public license", "version 2 of"],
    "LGPL-2.1": ["gnu lesser general public license", "version 2 1 of"],
    "LGPL-3.0": ["gnu lesser general public license", "version 3 of"],
    "AGPL-3.0": ["gnu affero general public license", "version 3 of"],
    "MPL-2.0": ["mozilla public license v 2 0"],
    "BSD-2-Clause": ["provided with the distribution this software is provided by"],
    "BSD-3-Clause": ["used to endorse or promote products derived"],
    "Unlicense": ["free and unencumbered software"],
    "BSD line": ["bsd license"],
    "BSD-2-Clause line": ["bsd 2 clause license"],
    "BSD-3-Clause line": ["bsd 3 clause license"],
    "ISC line": ["isc license"],
    "MPL-2.0 line": ["under the mozilla public license version 2 0"],
    "GPL-2.0 line": ["under the gnu general public license version 2"],
    "LGPL-2.1 line": ["under the gnu lesser general public license version 2 1"],
    "LGPL-3.0 line": ["under the gnu lesser general public license version 3"],
    "AGPL-3.0 line": ["under the gnu affero general public license version 3"],
    "CC-BY line": ["cc by 4 0"],
    "CC-BY-SA short line": ["cc by sa 4 0"],
    "CC-BY-ND line": ["cc by nd 4 0"],
    "CC-BY-NC-SA line": ["cc by nc sa 4 0"],
    "CC-BY-NC-ND line": ["cc by nc nd 4 0"],
    "CC0 line": ["cc0 1 0"],
    "Unlicense line": ["the unlicense"],
    "Apache-2.0 text": ["apache license version 2 0"],
    "Artistic-1.0 text": ["the artistic license"],
    "CC0-1.0 text": ["cc0 1 0 universal"],
    "GFDL-1.3 text": ["gnu free documentation license version 1 3"],
    "GPL-1.0 text": ["gnu general public license version 1 february 1989"],
    "GPL-2.0 text": ["gnu general public license version 2 june 1991"],
    "GPL-3.0 text": ["gnu general public license version 3 29 june 2007"],
    "LGPL-2.0 text": ["gnu library general public license version 2 june 1991"],
    "LGPL-2.1 text": ["gnu lesser general public license version 2 1 february 1999"],
    "LGPL-3.0 text": ["gnu lesser general public license version 3 29 june 2007"],
    "MPL-1.1 text": ["mozilla public license version 1 1"],
    "MPL-2.0 text": ["mozilla public license version 2 0"],
} | {f"{k} long line": [f"creative commons {v.lower().replace('-', ' ')} 4 0"] for k, v in _CC.items()}
