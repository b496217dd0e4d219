"""Public notices of licence families: fixed values (names, identifiers, paragraphs of the licences' own texts) and the short notices made from them."""

from __future__ import annotations

#: Names as notices write them; a name of one word stands in NEAR instead, with a word beside it.
NAMES = {
    "mit": ("MIT License", "MIT Licence", "Expat License"),
    "apache": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0", "Apache License"),
    "gpl": ("GNU General Public License, version 3", "GNU General Public License version 2", "GNU General Public License", "GNU GPL", "GPL version 2", "GNU GPL v3"),
    "lgpl": ("GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License version 3", "GNU Lesser General Public License", "GNU LGPL", "LGPL version 2.1"),
    "agpl": ("GNU Affero General Public License, version 3", "GNU Affero General Public License", "GNU AGPL", "AGPL version 3"),
    "bsd": ("BSD 3-Clause License", "BSD 2-Clause License", "BSD License", "Simplified BSD License", "New BSD License", "Modified BSD License"),
    "isc": ("ISC License", "ISC Licence"),
    "mpl": ("Mozilla Public License, v. 2.0", "Mozilla Public License 2.0", "Mozilla Public License", "MPL 2.0"),
    "epl": ("Eclipse Public License v 2.0", "Eclipse Public License", "EPL 2.0"),
    "zlib": ("zlib License", "zlib/libpng License"),
    "boost": ("Boost Software License, Version 1.0", "Boost Software License"),
    "unlicense": ("Unlicense license", "terms of The Unlicense"),
    "cc-by": ("CC BY 4.0", "CC BY 3.0", "CC BY license", "Creative Commons Attribution 4.0 International License", "Creative Commons Attribution License", "Creative Commons Attribution 4.0 License (CC BY 4.0)"),
    "cc-by-sa": ("CC BY-SA 4.0", "CC BY-SA 3.0", "Creative Commons Attribution-ShareAlike 4.0 International License", "Creative Commons Attribution-ShareAlike License"),
    "cc-by-nc": ("CC BY-NC 4.0", "CC BY-NC 3.0", "Creative Commons Attribution-NonCommercial 4.0 International License", "Creative Commons Attribution-NonCommercial License"),
    "cc-by-nd": ("CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License", "Creative Commons Attribution-NoDerivatives License"),
    "cc-by-nc-sa": ("CC BY-NC-SA 4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
    "cc-by-nc-nd": ("CC BY-NC-ND 4.0", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"),
    "cc0": ("CC0 1.0 Universal license", "CC0 1.0", "CC0 license", "CC0 1.0 Universal Public Domain Dedication"),
}
#: Names of one word.
SHORT = {
    "mit": ("MIT",), "gpl": ("GPL", "GPLv2", "GPLv3"), "lgpl": ("LGPL", "LGPLv2.1", "LGPLv3"), "agpl": ("AGPL", "AGPLv3"), "bsd": ("BSD",), "isc": ("ISC",), "mpl": ("MPLv2",), "epl": ("EPL",),
    "unlicense": ("Unlicense",), "cc0": ("CC0",),
}
#: Identifiers of the SPDX list.
SPDX = {
    "mit": ("MIT",), "apache": ("Apache-2.0",), "gpl": ("GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later"), "lgpl": ("LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-or-later"),
    "agpl": ("AGPL-3.0-only", "AGPL-3.0-or-later"), "bsd": ("BSD-2-Clause", "BSD-3-Clause"), "isc": ("ISC",), "mpl": ("MPL-2.0",), "epl": ("EPL-2.0",), "zlib": ("Zlib",), "boost": ("BSL-1.0",),
    "unlicense": ("Unlicense",), "cc-by": ("CC-BY-4.0",), "cc-by-sa": ("CC-BY-SA-4.0",), "cc-by-nc": ("CC-BY-NC-4.0",), "cc-by-nd": ("CC-BY-ND-4.0",), "cc-by-nc-sa": ("CC-BY-NC-SA-4.0",),
    "cc-by-nc-nd": ("CC-BY-NC-ND-4.0",), "cc0": ("CC0-1.0",),
}
#: Sentences around a name; the fit of one half sees every other one.
FRAMES = (
    "Licensed under the {name}.", "This package is released under the {name}.", "This project is licensed under the {name}, see the LICENSE file for details.", "Distributed under the terms of the {name}.",
    "Released under the {name}.", "License: {name}", "This work is licensed under the {name}.", "Licensed under {name}.", "This software is available under the {name}, see the accompanying file.",
    "The code is published under {name}.", "Use of this source code is governed by the {name}.", "This library is licensed under the {name} or later.", "Published under the {name}.",
    "You may use it under the terms of the {name} as published by its authors.",
)
#: What stands beside a name of one word.
NEAR = ("under {name}", "under the {name}", "{name} license", "license {name}")
#: Paragraphs of the licences and of the headers that they ask for.
PARAGRAPHS = {
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions:",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
        "The software is provided as is, without warranty of any kind, express or implied",
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH "
        "THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "apache": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "See the License for the specific language governing permissions and limitations under the License.",
    ),
    "gpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. "
        "See the GNU General Public License for more details.",
        "You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
    ),
    "lgpl": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the "
        "License, or (at your option) any later version.",
        "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. "
        "See the GNU Lesser General Public License for more details.",
        "You should have received a copy of the GNU Lesser General Public License along with this library; if not, write to the Free Software Foundation.",
    ),
    "agpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the "
        "License, or (at your option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. "
        "See the GNU Affero General Public License for more details.",
        "You should have received a copy of the GNU Affero General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED.",
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    "epl": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    ),
    "zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
        "The origin of this software must not be misrepresented; you must not claim that you wrote the original software.",
        "Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.",
    ),
    "boost": (
        "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at https://www.boost.org/LICENSE_1_0.txt)",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license",
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    "cc0": ("This work is dedicated to the public domain under the CC0 1.0 Universal license.", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    "proprietary": (
        "All rights reserved.",
        "Copyright. All rights reserved. No part of this publication may be reproduced without written permission.",
        "No part of this publication may be reproduced, distributed, or transmitted in any form or by any means without the prior written permission of the publisher.",
        "This document is confidential and proprietary. Unauthorized copying of this file, via any medium, is strictly prohibited.",
        "This software is the proprietary information of its owner. Use is subject to license terms.",
    ),
}
#: Names that are no licence's, or of licences that the families lack: with FRAMES around them they are unknown.
OTHER_NAMES = (
    "direction of the board", "water act of 1972", "old regime", "name of the author", "terms of the treaty", "title of the novel", "law of the land", "Foobar Public License", "Acme Software License",
    "Sample Code License 1.0", "Community License", "fishing license", "same license as before", "general agreement", "department of public works",
)


def notices() -> dict[str, tuple[tuple[str, int], ...]]:
    """Per family its texts, each with the half it lies in: notices by their sentence, identifiers and paragraphs in turn."""
    out: dict[str, list[tuple[str, int]]] = {family: [] for family in [*NAMES, "proprietary"]}
    for family, texts in out.items():
        texts += [(text, i % 2) for i, text in enumerate(PARAGRAPHS.get(family, ()))]
        texts += [(f"SPDX-License-Identifier: {name}", i % 2) for i, name in enumerate(SPDX.get(family, ()))]
        texts += [(name, i % 2) for i, name in enumerate(NAMES.get(family, ()))]
        texts += [(frame.format(name=name), i % 2) for i, frame in enumerate(FRAMES) for name in (*NAMES.get(family, ()), *SHORT.get(family, ()))]
        texts += [(near.format(name=name), i % 2) for i, near in enumerate(NEAR) for name in SHORT.get(family, ())]
    return {family: tuple(dict(reversed(texts)).items())[::-1] for family, texts in out.items()}


def other_notices() -> tuple[tuple[str, int], ...]:
    """Sentences of FRAMES about OTHER_NAMES."""
    return tuple((frame.format(name=name), i % 2) for i, frame in enumerate(FRAMES) for name in OTHER_NAMES)
