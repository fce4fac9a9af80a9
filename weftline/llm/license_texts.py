"""Licence families: their identifiers, the names that people use, and paragraphs of their texts and notices."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Family:
    """`ids` are SPDX identifiers, `names` how statements call the licence, `texts` paragraphs of the licence or of the notice that it asks for."""

    ids: tuple[str, ...]
    names: tuple[str, ...]
    texts: tuple[str, ...]


# Published licences. Paragraphs that several families share word for word are left to the first of them.
FAMILIES = {
    "mit": Family(
        ("MIT", "MIT-0", "X11"),
        ("MIT License", "MIT licence", "Expat license", "X11 license"),
        (
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
            "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
            "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
        ),
    ),
    "isc": Family(
        ("ISC", "0BSD"),
        ("ISC License", "ISC licence", "Internet Systems Consortium license"),
        (
            "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
            "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
            "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION.",
        ),
    ),
    "bsd": Family(
        ("BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause"),
        ("BSD License", "BSD licence", "BSD 2-Clause License", "BSD 3-Clause License", "New BSD License", "Simplified BSD License", "BSD-style license"),
        (
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
            "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
            "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
            "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
            "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
            "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY.",
        ),
    ),
    "apache-2.0": Family(
        ("Apache-2.0", "Apache-1.1"),
        ("Apache License", "Apache licence", "Apache 2.0 license", "Apache License Version 2.0", "Apache Software License", "ASL 2.0"),
        (
            "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
            "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
            "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
            "See the License for the specific language governing permissions and limitations under the License.",
            "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form.",
            "You must cause any modified files to carry prominent notices stating that You changed the files.",
        ),
    ),
    "gpl": Family(
        ("GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "GPL-2.0", "GPL-3.0"),
        ("GNU General Public License", "GNU GPL", "GPL", "GPLv2", "GPLv3", "GPL v2", "GPL v3", "GPL version 2", "GPL version 3"),
        (
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
            "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
            "You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/.",
            "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed.",
            "You may convey verbatim copies of the Program's source code as you receive it, in any medium, provided that you conspicuously and appropriately publish on each copy an appropriate copyright notice.",
            "You may copy and distribute the Program (or a work based on it) in object code or executable form provided that you accompany it with the complete corresponding machine-readable source code.",
        ),
    ),
    "lgpl": Family(
        ("LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "LGPL-2.1", "LGPL-3.0"),
        ("GNU Lesser General Public License", "GNU Library General Public License", "GNU LGPL", "LGPL", "LGPLv2", "LGPLv3", "LGPL v2.1", "LGPL v3"),
        (
            "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
            "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY. See the GNU Lesser General Public License for more details.",
            "You should have received a copy of the GNU Lesser General Public License along with this library; if not, write to the Free Software Foundation.",
            "You may convey a Combined Work under terms of your choice that, taken together, effectively do not restrict modification of the portions of the Library contained in the Combined Work.",
        ),
    ),
    "agpl": Family(
        ("AGPL-3.0-only", "AGPL-3.0-or-later", "AGPL-3.0"),
        ("GNU Affero General Public License", "Affero General Public License", "GNU AGPL", "AGPL", "AGPLv3", "AGPL v3"),
        (
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
            "You should have received a copy of the GNU Affero General Public License along with this program.",
            "If you modify the Program, your modified version must prominently offer all users interacting with it remotely through a computer network an opportunity to receive the Corresponding Source of your version.",
        ),
    ),
    "mpl-2.0": Family(
        ("MPL-2.0", "MPL-1.1"),
        ("Mozilla Public License", "MPL", "MPL 2.0", "MPLv2"),
        (
            "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
            "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
            "All distribution of Covered Software in Source Code Form, including any Modifications that You create or to which You contribute, must be under the terms of this License.",
        ),
    ),
    "epl": Family(
        ("EPL-1.0", "EPL-2.0"),
        ("Eclipse Public License", "EPL", "EPL 2.0"),
        (
            "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/.",
            "THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE (\"AGREEMENT\"). ANY USE, REPRODUCTION OR DISTRIBUTION OF THE PROGRAM CONSTITUTES RECIPIENT'S ACCEPTANCE OF THIS AGREEMENT.",
        ),
    ),
    "boost": Family(
        ("BSL-1.0",),
        ("Boost Software License", "Boost license"),
        (
            "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)",
            "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license to use, reproduce, display, distribute, execute, and transmit the Software.",
        ),
    ),
    "zlib": Family(
        ("Zlib", "libpng-2.0"),
        ("zlib License", "zlib/libpng license", "libpng license"),
        (
            "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
            "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
            "The origin of this software must not be misrepresented; you must not claim that you wrote the original software.",
            "Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.",
        ),
    ),
    "public-domain": Family(
        ("CC0-1.0", "Unlicense", "WTFPL"),
        ("CC0", "CC0 1.0", "Creative Commons Zero", "The Unlicense", "public domain dedication"),
        (
            "This is free and unencumbered software released into the public domain.",
            "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
            "The person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law, including all related and neighboring rights, to the extent allowed by law.",
            "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        ),
    ),
    "cc-by": Family(
        ("CC-BY-4.0", "CC-BY-3.0", "CC-BY-2.5"),
        ("Creative Commons Attribution", "CC BY", "Creative Commons Attribution 4.0 International License"),
        (
            "You are free to share, copy and redistribute the material in any medium or format, and adapt, remix, transform, and build upon the material for any purpose, even commercially.",
            "You must give appropriate credit, provide a link to the license, and indicate if changes were made. You may do so in any reasonable manner, but not in any way that suggests the licensor endorses you or your use.",
            "To view a copy of this license, visit https://creativecommons.org/licenses/by/4.0/",
        ),
    ),
    "cc-by-sa": Family(
        ("CC-BY-SA-4.0", "CC-BY-SA-3.0"),
        ("Creative Commons Attribution-ShareAlike", "CC BY-SA", "CC BY-SA license", "Creative Commons ShareAlike"),
        (
            "If you remix, transform, or build upon the material, you must distribute your contributions under the same license as the original.",
            "To view a copy of this license, visit https://creativecommons.org/licenses/by-sa/4.0/",
        ),
    ),
    "cc-by-nc": Family(
        ("CC-BY-NC-4.0", "CC-BY-NC-SA-4.0", "CC-BY-NC-ND-4.0"),
        ("Creative Commons Attribution-NonCommercial", "CC BY-NC", "CC BY-NC-SA", "CC BY-NC-ND", "Creative Commons NonCommercial"),
        (
            "You may not use the material for commercial purposes.",
            "To view a copy of this license, visit https://creativecommons.org/licenses/by-nc/4.0/",
        ),
    ),
    "proprietary": Family(
        ("LicenseRef-Proprietary",),
        ("proprietary license", "commercial license", "all rights reserved", "end user license agreement"),
        (
            "No part of this publication may be reproduced, distributed, or transmitted in any form or by any means without the prior written permission of the publisher.",
            "This software contains proprietary and confidential information. Unauthorized copying of this file, via any medium, is strictly prohibited.",
            "Copyright 2020 by the author, all rights are reserved by the copyright holder and reproduction is forbidden.",
        ),
    ),
}

# How statements name a licence; {} is a name, and <> an identifier.
FRAMES = (
    "This software is licensed under the {}.",
    "The code is distributed under the terms of the {}.",
    "All files here are made available under {}.",
    "You may use this work under the {}, see the file for details.",
    "Published under {}.",
    "Copyright (c) 2019 Jane Doe. Subject to the {}.",
    "{}",
    "License: {}",
    "SPDX-License-Identifier: <>",
    "license <>",
)

# Sentences that share words with licences and state none.
OTHERS = (
    "The driver lost his license after the second accident and had to pay a fine.",
    "A fishing license is sold at the town hall for a small fee.",
    "Her licence to practise medicine was granted by the state.",
    "The public library opens at nine in the morning and closes at six.",
    "General elections are held every four years in all parts of the country.",
    "The new version of the program will be released next week.",
    "You may use this door to leave the building in an emergency.",
    "The commons were open to all people of the village.",
    "Permission to land was granted by the tower without delay.",
    "Seats in the first rows are reserved for members and their guests.",
    "The source of the river lies in the mountains to the north.",
    "The work of the author is known for its attribution to nature.",
    "Free of charge, the museum shows a copy of the letter.",
    "The software is easy to use, and the documentation lists all files.",
    "The foundation was founded by a free society of merchants.",
    "The warranty of the car covers any damage for two years.",
    "The terms of the contract were accepted by both parties.",
    "He reserved all his rights in the dispute about the copyright of the song.",
    "The domain of the function is public knowledge, and its form is binary.",
    "The apache tribe lived in the south, and the eclipse was seen by all.",
    "A creative mind and common sense are all that you need to share the work.",
    "The judge may permit the parties to distribute the remaining copies of the book.",
    "Er kam mit dem Zug und fuhr mit dem Bus weiter, weil das Auto nicht ansprang.",
    "Das Haus mit dem Garten liegt am See, und mit etwas Glück sieht man die Berge.",
)
