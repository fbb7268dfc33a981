"""The license templates: notices, identifying parts of license texts, and whole texts (folder ``licenses``).

A template is a name, a text and the phrases that identify the license, by name, version or clause.
"""

from __future__ import annotations

from pathlib import Path

Template = tuple[str, str, tuple[str, ...]]

#: Names as they stand in notices; a variant per way of writing the version.
NAMES: dict[str, tuple[tuple[str, ...], ...]] = {
    "0BSD": (("Zero-Clause BSD License",), ("0BSD License",), ("BSD Zero Clause License",)),
    "AFL-3.0": (("Academic Free License", "version 3.0"), ("Academic Free License 3.0",)),
    "AGPL-3.0": (("GNU Affero General Public License", "version 3"), ("GNU Affero General Public License", "version 3.0"), ("GNU Affero General Public License", "v3"), ("GNU Affero General Public License", "v3.0"), ("GNU AGPL v3",), ("AGPLv3 license",), ("AGPL 3.0",)),
    "Apache-1.0": (("Apache License", "Version 1.0"), ("Apache License 1.0",)),
    "Apache-1.1": (("Apache License", "Version 1.1"), ("Apache Software License", "Version 1.1"), ("Apache License 1.1",)),
    "Apache-2.0": (("Apache License 2.0",), ("Apache 2.0 License",), ("Apache License v2.0",), ("Apache License v2",), ("Apache License", "Version 2"), ("Apache Software License", "Version 2.0"), ("Apache Software License 2.0",), ("Apache-2.0 License",)),
    "Artistic-1.0": (("Artistic License", "version 1.0"), ("Artistic License 1.0",)),
    "Artistic-2.0": (("Artistic License", "version 2.0"), ("Artistic License 2.0",)),
    "BSD": (("BSD License",), ("BSD-style license",)),
    "BSD-2-Clause": (("BSD 2-Clause License",), ("2-Clause BSD License",), ("BSD-2-Clause License",), ("Simplified BSD License",), ("FreeBSD License",)),
    "BSD-3-Clause": (("BSD 3-Clause License",), ("3-Clause BSD License",), ("BSD-3-Clause License",), ("New BSD License",), ("Modified BSD License",), ("Revised BSD License",)),
    "BSD-4-Clause": (("BSD 4-Clause License",), ("4-Clause BSD License",), ("BSD-4-Clause License",), ("Original BSD License",)),
    "BSL-1.0": (("Boost Software License", "Version 1.0"), ("Boost Software License 1.0",)),
    "BUSL-1.1": (("Business Source License", "version 1.1"), ("Business Source License 1.1",)),
    "CC0-1.0": (("CC0 1.0",), ("CC0 license",), ("Creative Commons Zero", "1.0"), ("CC0 1.0 Universal",)),
    "CDDL-1.0": (("Common Development and Distribution License", "version 1.0"), ("Common Development and Distribution License 1.0",), ("CDDL 1.0",)),
    "CDDL-1.1": (("Common Development and Distribution License", "version 1.1"), ("Common Development and Distribution License 1.1",), ("CDDL 1.1",)),
    "CPL-1.0": (("Common Public License", "version 1.0"), ("Common Public License 1.0",)),
    "ECL-2.0": (("Educational Community License", "version 2.0"), ("Educational Community License 2.0",)),
    "EPL-1.0": (("Eclipse Public License", "version 1.0"), ("Eclipse Public License 1.0",), ("Eclipse Public License v1.0",), ("Eclipse Public License", "v 1.0"), ("EPL 1.0",)),
    "EPL-2.0": (("Eclipse Public License", "version 2.0"), ("Eclipse Public License 2.0",), ("Eclipse Public License v2.0",), ("Eclipse Public License", "v 2.0"), ("EPL 2.0",)),
    "EUPL-1.1": (("European Union Public Licence", "version 1.1"), ("EUPL", "version 1.1"), ("EUPL v1.1",), ("EUPL 1.1",)),
    "EUPL-1.2": (("European Union Public Licence", "version 1.2"), ("EUPL", "version 1.2"), ("EUPL v1.2",), ("EUPL 1.2",)),
    "GFDL-1.2": (("GNU Free Documentation License", "version 1.2"),),
    "GFDL-1.3": (("GNU Free Documentation License", "version 1.3"),),
    "GPL": (("GNU General Public License",), ("GNU GPL license",), ("GPL license",)),
    "GPL-1.0": (("GNU General Public License", "version 1"), ("GNU General Public License", "version 1.0"), ("GNU GPL v1",)),
    "GPL-2.0": (("GNU General Public License", "version 2"), ("GNU General Public License", "version 2.0"), ("GNU General Public License", "v2"), ("GNU General Public License", "v2.0"), ("GNU GPL v2",), ("GPLv2 license",), ("GPL v2 license",), ("GPL 2.0",), ("GPL", "version 2")),
    "GPL-3.0": (("GNU General Public License", "version 3"), ("GNU General Public License", "version 3.0"), ("GNU General Public License", "v3"), ("GNU General Public License", "v3.0"), ("GNU GPL v3",), ("GPLv3 license",), ("GPL v3 license",), ("GPL 3.0",), ("GPL", "version 3")),
    "ISC": (("ISC License",),),
    "LGPL": (("GNU Lesser General Public License",), ("GNU Library General Public License",), ("LGPL license",)),
    "LGPL-2.0": (("GNU Library General Public License", "version 2"), ("GNU Library General Public License", "version 2.0"), ("GNU Lesser General Public License", "version 2"), ("GNU Lesser General Public License", "version 2.0")),
    "LGPL-2.1": (("GNU Lesser General Public License", "version 2.1"), ("GNU Lesser General Public License", "v2.1"), ("LGPLv2.1 license",), ("LGPL v2.1 license",), ("LGPL 2.1",), ("LGPL", "version 2.1")),
    "LGPL-3.0": (("GNU Lesser General Public License", "version 3"), ("GNU Lesser General Public License", "version 3.0"), ("GNU Lesser General Public License", "v3"), ("GNU Lesser General Public License", "v3.0"), ("LGPLv3 license",), ("LGPL v3 license",), ("LGPL 3.0",), ("LGPL", "version 3")),
    "MIT": (("MIT License",), ("MIT/X11 License",), ("Expat License",)),
    "MIT-0": (("MIT-0 License",), ("MIT No Attribution License",)),
    "MPL-1.0": (("Mozilla Public License", "version 1.0"), ("MPL 1.0",)),
    "MPL-1.1": (("Mozilla Public License", "version 1.1"), ("Mozilla Public License 1.1",), ("MPL 1.1",)),
    "MPL-2.0": (("Mozilla Public License", "version 2.0"), ("Mozilla Public License 2.0",), ("Mozilla Public License v2.0",), ("Mozilla Public License", "v 2.0"), ("MPL 2.0",), ("MPL", "version 2.0")),
    "MS-PL": (("Microsoft Public License",),),
    "MS-RL": (("Microsoft Reciprocal License",),),
    "NCSA": (("University of Illinois/NCSA Open Source License",), ("NCSA Open Source License",)),
    "ODbL-1.0": (("Open Database License", "version 1.0"), ("Open Database License 1.0",), ("Open Data Commons Open Database License",)),
    "OFL-1.1": (("SIL Open Font License", "Version 1.1"), ("SIL Open Font License 1.1",)),
    "OSL-3.0": (("Open Software License", "version 3.0"), ("Open Software License 3.0",)),
    "PostgreSQL": (("PostgreSQL License",),),
    "PSF-2.0": (("Python Software Foundation License", "Version 2"), ("PSF License",), ("Python Software Foundation License",)),
    "SSPL-1.0": (("Server Side Public License", "version 1"),),
    "Unlicense": (("The Unlicense",), ("Unlicense license",)),
    "UPL-1.0": (("Universal Permissive License", "version 1.0"), ("Universal Permissive License v 1.0",)),
    "WTFPL": (("WTFPL license",), ("Do What The Fuck You Want To Public License",)),
    "X11": (("X11 License",),),
    "Zlib": (("zlib License",), ("zlib/libpng License",)),
    "ZPL-2.1": (("Zope Public License", "version 2.1"), ("Zope Public License 2.1",)),
}
PARTS = {"BY": "Attribution", "NC": "NonCommercial", "ND": "NoDerivatives", "SA": "ShareAlike"}
CC_KINDS = ("BY", "BY-SA", "BY-ND", "BY-NC", "BY-NC-SA", "BY-NC-ND")
CC_VERSIONS = {"1.0": "Generic", "2.0": "Generic", "2.5": "Generic", "3.0": "Unported", "4.0": "International"}

MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
    documentation files (the "Software"), to deal in the Software without restriction, including without limitation
    the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and
    to permit persons to whom the Software is furnished to do so"""
MIT_CONDITION = """, subject to the following conditions: The above copyright notice and this permission notice shall be
    included in all copies or substantial portions of the Software."""
PERMISSION_NOTICE = "above copyright notice and this permission notice"
BSD_START = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
    the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of
    conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice,
    this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
    distribution. """
BSD_ADVERTISING = """All advertising materials mentioning features or use of this software must display the following
    acknowledgement: This product includes software developed by the copyright holder. """
BSD_NAMES = """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
    products derived from this software without specific prior written permission. """
BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
    WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR
    PURPOSE ARE DISCLAIMED."""
GNU_HEADER = """This program is free software: you can redistribute it and/or modify it under the terms of the {name} as
    published by the Free Software Foundation, {version} of the License, or (at your option) any later version. This
    program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty
    of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details."""

FIXED: list[Template] = [
    ("Apache-2.0-notice", "Licensed under the Apache License, Version 2.0.", ("Apache License", "Version 2.0")),
    ("CC-BY-NC-4.0-notice", "Licensed under CC BY-NC 4.0.", ("CC BY-NC 4.0",)),
    ("GPL-3.0-notice", "This work is licensed under the GNU General Public License, version 3.", ("GNU General Public License", "version 3")),
    ("MIT-notice", "Released under the MIT License.", ("MIT License",)),
    (
        "Apache-2.0",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed
        on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License
        for the specific language governing permissions and limitations under the License.""",
        ("Apache License Version 2.0",),
    ),
    ("MIT", MIT_GRANT + MIT_CONDITION, ("hereby granted free of charge", PERMISSION_NOTICE)),
    (
        "ISC",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies.""",
        ("with or without fee is hereby granted provided that", PERMISSION_NOTICE),
    ),
    (
        "0BSD",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES""",
        ("fee is hereby granted the software is provided",),
    ),
    ("MIT-0", MIT_GRANT + """. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND""", ("hereby granted free of charge", "to do so the software is provided")),
    (
        "X11",
        MIT_GRANT + MIT_CONDITION + """ THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,
        INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.
        Except as contained in this notice, the name of the X Consortium shall not be used in advertising or otherwise to
        promote the sale, use or other dealings in this Software without prior written authorization""",
        ("except as contained in this notice", PERMISSION_NOTICE),
    ),
    ("BSD-2-Clause", BSD_START + BSD_END, ("source and binary forms", "provided with the distribution this software is provided")),
    ("BSD-3-Clause", BSD_START + BSD_NAMES + BSD_END, ("source and binary forms", "neither the name of")),
    ("BSD-4-Clause", BSD_START + BSD_ADVERTISING + BSD_NAMES + BSD_END, ("all advertising materials mentioning features", "neither the name of")),
    (
        "Zlib",
        """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
        liable for any damages arising from the use of this software. Permission is granted to anyone to use this software
        for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the
        following restrictions: The origin of this software must not be misrepresented; you must not claim that you wrote
        the original software. Altered source versions must be plainly marked as such""",
        ("origin of this software must not be misrepresented", "alter it and redistribute it freely"),
    ),
    (
        "BSL-1.0",
        """Boost Software License - Version 1.0 - August 17th, 2003 Permission is hereby granted, free of charge, to any
        person or organization obtaining a copy of the software and accompanying documentation covered by this license (the
        "Software") to use, reproduce, display, distribute, execute, and transmit the Software""",
        ("boost software license version 1.0", "person or organization obtaining a copy"),
    ),
    (
        "Unlicense",
        """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,
        use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
        purpose, commercial or non-commercial, and by any means.""",
        ("free and unencumbered software", "public domain"),
    ),
    (
        "PostgreSQL",
        """Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee,
        and without a written agreement is hereby granted, provided that the above copyright notice and this paragraph and
        the following two paragraphs appear in all copies.""",
        ("without a written agreement", "the following two paragraphs"),
    ),
    ("WTFPL", "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE Version 2, December 2004 Everyone is permitted to copy and distribute verbatim or modified copies", ("do what the fuck you want to public license", "version 2")),
    ("MPL-2.0-notice", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", ("Mozilla Public License v 2.0",)),
    ("MPL-1.1-notice", 'The contents of this file are subject to the Mozilla Public License Version 1.1 (the "License"); you may not use this file except in compliance with the License.', ("Mozilla Public License Version 1.1",)),
    ("OFL-1.1-notice", "This Font Software is licensed under the SIL Open Font License, Version 1.1.", ("SIL Open Font License Version 1.1",)),
]
#: Headers of the GNU licenses: name of the template, of the license, and the version.
GNU: tuple[tuple[str, str, str], ...] = (
    ("GPL-1.0", "GNU General Public License", "1"),
    ("GPL-2.0", "GNU General Public License", "2"),
    ("GPL-3.0", "GNU General Public License", "3"),
    ("LGPL-2.0", "GNU Library General Public License", "2"),
    ("LGPL-2.1", "GNU Lesser General Public License", "2.1"),
    ("LGPL-3.0", "GNU Lesser General Public License", "3"),
    ("AGPL-3.0", "GNU Affero General Public License", "3"),
)
TITLES: dict[str, str] = {
    "AGPL-3.0": "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
    "GPL-1.0": "GNU GENERAL PUBLIC LICENSE Version 1, February 1989",
    "GPL-2.0": "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    "GPL-3.0": "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "LGPL-2.0": "GNU LIBRARY GENERAL PUBLIC LICENSE Version 2, June 1991",
    "LGPL-2.1": "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
    "LGPL-3.0": "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "GFDL-1.2": "GNU Free Documentation License Version 1.2, November 2002",
    "GFDL-1.3": "GNU Free Documentation License Version 1.3, 3 November 2008",
    "Apache-2.0": "Apache License Version 2.0, January 2004",
    "MPL-1.1": "MOZILLA PUBLIC LICENSE Version 1.1",
    "MPL-2.0": "Mozilla Public License Version 2.0",
    "EPL-1.0": "Eclipse Public License - v 1.0",
    "EPL-2.0": "Eclipse Public License - v 2.0",
    "CDDL-1.0": "COMMON DEVELOPMENT AND DISTRIBUTION LICENSE (CDDL) Version 1.0",
    "OFL-1.1": "SIL OPEN FONT LICENSE Version 1.1 - 26 February 2007",
    "CC0-1.0": "CC0 1.0 Universal",
}
#: What identifies the whole texts besides their titles.
TEXT_KEYS: dict[str, tuple[str, ...]] = {
    "Apache-2.0": ("Apache License Version 2.0 January 2004",),
    "Artistic-1.0": ('The "Artistic License"',),
    "CC0-1.0": ("CC0 1.0 Universal",),
    "GFDL-1.2": ("Version 1.2 November 2002",),
    "GFDL-1.3": ("Version 1.3 3 November 2008",),
    "GPL-1": ("Version 1 February 1989",),
    "GPL-2": ("GNU General Public License Version 2 June 1991",),
    "GPL-3": ("GNU General Public License Version 3 29 June 2007",),
    "LGPL-2": ("GNU Library General Public License Version 2 June 1991",),
    "LGPL-2.1": ("GNU Lesser General Public License Version 2.1 February 1999",),
    "LGPL-3": ("GNU Lesser General Public License Version 3 29 June 2007",),
    "MPL-1.1": ("Mozilla Public License Version 1.1",),
    "MPL-2.0": ("Mozilla Public License Version 2.0",),
}


def notices() -> list[Template]:
    out: list[Template] = []
    for name, variants in NAMES.items():
        out += [(f"{name}-notice", f"Licensed under the {' '.join(keys)}.", keys) for keys in variants]
        out.append((f"{name}-spdx", f"SPDX-License-Identifier: {name}", (f"SPDX-License-Identifier {name}",)))
        if name.split("-")[0] in ("AGPL", "GPL", "LGPL", "GFDL") and "-" in name:
            out += [(f"{name}-spdx", f"SPDX-License-Identifier: {name}{end}", (f"SPDX-License-Identifier {name}{end}",)) for end in ("-only", "-or-later", "+")]
    for kind in CC_KINDS:
        words = "-".join(PARTS[p] for p in kind.split("-"))
        for version, scope in CC_VERSIONS.items():
            name = f"CC-{kind}-{version}"
            if (kind, version) != ("BY-NC", "4.0"):
                out.append((f"{name}-notice", f"Licensed under CC {kind} {version}.", (f"CC {kind} {version}",)))
            out.append((f"{name}-notice", f"Licensed under {name}.", (name,)))
            out.append((f"{name}-notice", f"This work is licensed under a Creative Commons {words} {version} {scope} License.", (f"Creative Commons {words} {version}",)))
            out.append((f"{name}-spdx", f"SPDX-License-Identifier: {name}", (f"SPDX-License-Identifier {name}",)))
            if version == "4.0":
                text = f"""By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms and
                    conditions of this Creative Commons {words} 4.0 International Public License"""
                out.append((name, text, (f"Creative Commons {words} 4.0 International Public License",)))
    return out


def gnu_headers() -> list[Template]:
    """With either of the two ways in which the version stands in the header; the version is the one of the license."""
    out: list[Template] = []
    for name, title, version in GNU:
        for before in ("either version", "version"):
            key = f"{before} {version} of the License"
            out.append((f"{name}-header", GNU_HEADER.format(name=title, version=f"{before} {version}"), (f"terms of the {title} as published", key)))
        only = f"under the terms of the {title} version {version} as published by the Free Software Foundation."
        out.append((f"{name}-header", only, (f"{title} version {version}",)))
    return out


def all_templates() -> list[Template]:
    folder = Path(__file__).parent / "licenses"
    texts = [(f"{name}-text", (folder / f"{name}.txt").read_text(encoding="utf-8"), keys) for name, keys in TEXT_KEYS.items()]
    titles = [(f"{name}-title", title, (title,)) for name, title in TITLES.items()]
    return [*FIXED, *notices(), *gnu_headers(), *titles, *texts]
