"""License detection with ordered signature rules."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Phrases that every scan must report, with their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# Names by which texts call a license, as patterns over lower-case words, and words of which every match has one.
NAMES = {
    "mit": ("mit", "mit"),
    "mit-0": ("mit (?:no attribution|0)", "mit"),
    "isc": ("isc", "isc"),
    "zlib": ("zlib(?: libpng)?", "zlib"),
    "unlicense": ("unlicense", "unlicense"),
    "wtfpl": ("(?:wtfpl|do what the fuck you want to)", "wtfpl fuck"),
    "bsl-1": ("(?:boost software|bsl 1 0)", "boost bsl"),
    "ms-pl": ("microsoft public", "microsoft"),
    "ms-rl": ("microsoft reciprocal", "microsoft"),
    "artistic": ("artistic", "artistic"),
    "postgresql": ("postgresql", "postgresql"),
    "openssl": ("openssl", "openssl"),
    "python": ("(?:python software foundation|psf)", "python psf"),
    "ofl": ("(?:sil )?open font", "font"),
    "cecill": ("cecill", "cecill"),
    "upl": ("universal permissive", "permissive"),
    "ncsa": ("(?:university of illinois )?ncsa", "ncsa"),
    "x11": ("x11", "x11"),
    "0bsd": ("(?:zero clause bsd|0bsd|bsd zero clause)", "bsd 0bsd"),
    "bsd-2": ("(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd|two clause bsd)", "bsd freebsd"),
    "bsd-3": ("(?:bsd 3 clause|3 clause bsd|new bsd|revised bsd|modified bsd|three clause bsd)", "bsd"),
    "bsd-4": ("(?:bsd 4 clause|4 clause bsd|original bsd)", "bsd"),
    "json": ("json", "json"),
    "vim": ("vim", "vim"),
    "ruby": ("ruby", "ruby"),
    "php": ("php", "php"),
}

# Names that are also words for other things; they need the word license behind them.
ORDINARY = {"artistic", "json", "openssl", "php", "postgresql", "python", "ruby", "vim", "x11"}

# Licenses that are told apart by version.
VERSIONED = {
    "apache": ("apache(?: software)?(?: foundation)?", "apache", ("1.0", "1.1", "2.0")),
    "gpl": ("(?:gnu )?(?:general public|gpl)", "general gpl", ("1.0", "2.0", "3.0")),
    "lgpl": ("(?:gnu )?(?:lesser general public|library general public|lgpl)", "general lgpl", ("2.0", "2.1", "3.0")),
    "agpl": ("(?:gnu )?(?:affero general public|agpl)", "affero agpl", ("1.0", "3.0")),
    "mpl": ("(?:mozilla public|mpl)", "mozilla mpl", ("1.0", "1.1", "2.0")),
    "epl": ("(?:eclipse public|epl)", "eclipse epl", ("1.0", "2.0")),
    "cddl": ("(?:common development and distribution|cddl)", "distribution cddl", ("1.0", "1.1")),
    "eupl": ("(?:european union public|eupl)", "european eupl", ("1.1", "1.2")),
    "osl": ("(?:open software|osl)", "open osl", ("2.1", "3.0")),
    "afl": ("(?:academic free|afl)", "academic afl", ("2.1", "3.0")),
    "cc-by": ("(?:creative commons attribution|cc by)", "creative cc", ("1.0", "2.0", "2.5", "3.0", "4.0")),
    "cc-by-sa": ("(?:creative commons attribution share ?alike|cc by sa)", "creative cc", ("1.0", "2.0", "2.5", "3.0", "4.0")),
    "cc-by-nd": ("(?:creative commons attribution no ?deriv(?:ative)?s?(?: works)?|cc by nd)", "creative cc", ("2.0", "2.5", "3.0", "4.0")),
    "cc-by-nc": ("(?:creative commons attribution non ?commercial|cc by nc)", "creative cc", ("2.0", "2.5", "3.0", "4.0")),
    "cc-by-nc-sa": ("(?:creative commons attribution non ?commercial share ?alike|cc by nc sa)", "creative cc", ("2.0", "2.5", "3.0", "4.0")),
    "cc-by-nc-nd": ("(?:creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?|cc by nc nd)", "creative cc", ("2.0", "2.5", "3.0", "4.0")),
    "cc0": ("(?:creative commons zero|cc0)", "creative cc0", ("1.0",)),
}

# How a text puts a name, the confidence of each way and its priority; {} is the name.
GRANT = "(?:licensed|released|distributed|available|published|provided|offered|covered|redistributed) (?:only )?under (?:the )?(?:terms of )?(?:the )?{}"
WAYS = (
    (GRANT + "(?: licen[sc]e)?", 0.95, 4),
    ("under (?:the )?(?:terms of )?(?:the )?{} licen[sc]e", 0.9, 3),
    ("{} licen[sc]e", 0.7, 2),
    ("licen[sc]e {}", 0.5, 1),
)
ORDINARY_WAYS = ((GRANT + " licen[sc]e", 0.95, 4), ("{} licen[sc]e", 0.7, 2))

# The same for names with a version, which may have the word license before it.
VERSIONED_WAYS = (
    (GRANT + "(?: licen[sc]e)?", 0.97, 6),
    ("under (?:the )?(?:terms of )?(?:the )?{}(?: licen[sc]e)?", 0.95, 5),
    ("{} licen[sc]e", 0.9, 4),
    ("licen[sc]e {}", 0.8, 3),
)

# Sentences and marks that belong to one license text.
SENTENCES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", 0.98),
    ("mit", "to deal in the software without restriction including without limitation the rights to use copy modify merge publish", 0.97),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", 0.95),
    ("mit", "in no event shall the authors or copyright holders be liable for any claim damages or other liability", 0.85),
    ("mit", "distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so", 0.96),
    ("x11", "shall not be used in advertising or otherwise to promote the sale use or other dealings in this software", 0.9),
    ("x11", "except as contained in this notice the name", 0.8),
    ("isc", "permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted", 0.97),
    ("isc", "disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness", 0.85),
    ("0bsd", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided", 0.97),
    ("hpnd", "permission to use copy modify and distribute this software and its documentation for any purpose and without fee is hereby granted", 0.95),
    ("hpnd", "not be used in advertising or publicity pertaining to distribution of the software without specific written prior permission", 0.93),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that", 0.95),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer", 0.9),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice this list of conditions", 0.9),
    ("bsd", "use of this source code is governed by a bsd style license", 0.97),
    ("bsd-3", "neither the name of .{1,120}? nor the names of its contributors may be used to endorse or promote products", 0.96),
    ("bsd-3", "the name of the author may not be used to endorse or promote products derived from this software", 0.93),
    ("bsd-4", "all advertising materials mentioning features or use of this software must display the following acknowledg", 0.97),
    ("bsd-2", "the views and conclusions contained in the software and documentation are those of the authors", 0.85),
    ("bsd-3-clear", "no express or implied licenses to any party s patent rights are granted by this license", 0.95),
    ("bsd-2-patent", "each copyright holder and contributor hereby grants to those receiving rights under this license a perpetual", 0.95),
    ("apache-1.1", "the end user documentation included with the redistribution if any must include the following acknowledg", 0.95),
    ("apache-1.1", "products derived from this software may not be called apache nor may apache appear in their name", 0.98),
    ("apache-2.0", "you may not use this file except in compliance with the license", 0.95),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis", 0.95),
    ("apache-2.0", "terms and conditions for use reproduction and distribution", 0.85),
    ("apache-2.0", "licensed to the apache software foundation asf under one or more contributor license agreements", 0.97),
    ("apache-2.0", "each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license", 0.97),
    ("apache-2.0", "if the work includes a notice text file as part of its distribution", 0.93),
    ("apache", "this product includes software developed (?:by|at) the apache software foundation", 0.7),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", 0.96),
    ("gpl", "this program is distributed in the hope that it will be useful but without any warranty", 0.88),
    ("gpl", "you should have received a copy of the gnu general public license along with", 0.95),
    ("gpl", "the licenses for most software are designed to take away your freedom to share and change it", 0.95),
    ("gpl-1.0", "either version 1 (?:of the licen[sc]e )?or (?:at your option )?any later version", 0.9),
    ("gpl-2.0", "either version 2 (?:of the licen[sc]e )?or (?:at your option )?any later version", 0.92),
    ("gpl-3.0", "either version 3 (?:of the licen[sc]e )?or (?:at your option )?any later version", 0.92),
    ("gpl-2.0", "gnu general public license version 2 as published by the free software foundation", 0.97),
    ("gpl-3.0", "gnu general public license version 3 as published by the free software foundation", 0.97),
    ("gpl-2.0", "gnu general public license version 2 june 1991", 0.98),
    ("gpl-3.0", "gnu general public license version 3 29 june 2007", 0.98),
    ("gpl-2.0", "you must cause the modified files to carry prominent notices stating that you changed the files", 0.9),
    ("gpl-3.0", "the gnu general public license is a free copyleft license for software and other kinds of works", 0.97),
    ("gpl-3.0", "nothing in this license shall be construed as excluding or limiting any implied license", 0.85),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu", 0.96),
    ("lgpl", "you should have received a copy of the gnu lesser general public license along with", 0.96),
    ("lgpl-2.0", "gnu library general public license version 2 june 1991", 0.98),
    ("lgpl-2.1", "gnu lesser general public license version 2 1 february 1999", 0.98),
    ("lgpl-2.1", "either version 2 1 of the license or at your option any later version", 0.93),
    ("lgpl-3.0", "this version of the gnu lesser general public license incorporates the terms and conditions of version 3", 0.98),
    ("lgpl", "a program that contains no derivative of any portion of the library but is designed to work with the library", 0.93),
    ("agpl", "you should have received a copy of the gnu affero general public license along with", 0.97),
    ("agpl-3.0", "gnu affero general public license version 3 19 november 2007", 0.98),
    ("agpl-3.0", "your modified version must prominently offer all users interacting with it remotely through a computer network", 0.97),
    ("gfdl", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license", 0.98),
    ("gfdl", "with no invariant sections no front cover texts and no back cover texts", 0.95),
    ("gpl-classpath", "linking this library statically or dynamically with other modules is making a combined work based on this library", 0.95),
    ("gpl-exception", "as a special exception the copyright holders of this library give you permission to link this library", 0.9),
    ("mpl-1.1", "the contents of this file are subject to the mozilla public license version 1 1", 0.98),
    ("mpl-1.0", "the contents of this file are subject to the mozilla public license version 1 0", 0.98),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", 0.98),
    ("mpl-2.0", "if a copy of the mpl was not distributed with this file you can obtain one at", 0.96),
    ("mpl-2.0", "this source code form is incompatible with secondary licenses as defined by the mozilla public license", 0.98),
    ("npl", "the contents of this file are subject to the netscape public license", 0.97),
    ("cddl", "the contents of this file are subject to the terms of the common development and distribution license", 0.97),
    ("cddl", "you can obtain a copy of the license at usr src opensolaris license", 0.95),
    ("epl-1.0", "the accompanying program is provided under the terms of this eclipse public license", 0.9),
    ("epl-1.0", "this program and the accompanying materials are made available under the terms of the eclipse public license v1 0", 0.97),
    ("epl-2.0", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0", 0.97),
    ("cpl-1.0", "the accompanying program is provided under the terms of this common public license", 0.96),
    ("ipl-1.0", "the accompanying program is provided under the terms of this ibm public license", 0.96),
    ("eupl", "licensed under the eupl version", 0.9),
    ("eupl", "this european union public licence the eupl applies to the work", 0.97),
    ("cecill", "this software is governed by the cecill", 0.96),
    ("cecill", "ce logiciel est r.{1,4}gi par la licence cecill", 0.96),
    ("osl-3.0", "licensed under the open software license version 3 0", 0.97),
    ("afl-3.0", "licensed under the academic free license version 3 0", 0.97),
    ("artistic-1.0", "the intent of this document is to state the conditions under which a package may be copied", 0.97),
    ("artistic-2.0", "everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed preamble this license establishes", 0.97),
    ("perl", "this (?:library|program|module) is free software you can redistribute it and or modify it under the same terms as perl itself", 0.98),
    ("unlicense", "this is free and unencumbered software released into the public domain", 0.98),
    ("unlicense", "anyone is free to copy modify publish use compile sell or distribute this software", 0.96),
    ("wtfpl", "you just do what the fuck you want to", 0.95),
    ("beerware", "as long as you retain this notice you can do whatever you want with this stuff", 0.97),
    ("beerware", "you can buy me a beer in return", 0.9),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable", 0.95),
    ("zlib", "the origin of this software must not be misrepresented you must not claim that you wrote the original software", 0.97),
    ("zlib", "altered source versions must be plainly marked as such and must not be misrepresented", 0.97),
    ("libpng", "the contributing authors and group 42 inc", 0.95),
    ("bsl-1", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software", 0.96),
    ("bsl-1", "unless such copies or derivative works are solely in the form of machine executable object code", 0.97),
    ("busl-1.1", "use limitation business source license", 0.8),
    ("busl-1.1", "licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use", 0.97),
    ("elastic-2.0", "you may not provide the software to third parties as a hosted or managed service", 0.97),
    ("sspl-1.0", "making the functionality of the program or modified version available to third parties as a service", 0.95),
    ("commons-clause", "the grant of rights under the license will not include and the license does not grant to you the right to sell the software", 0.97),
    ("polyform", "the licensor grants you a copyright license for the software to do everything you might do with the software", 0.93),
    ("ncsa", "to deal with the software without restriction including without limitation the rights to use copy modify merge publish", 0.96),
    ("upl", "a free of charge to any person obtaining a copy of this software associated documentation and or data", 0.9),
    ("upl", "larger works or as incorporated in the larger works", 0.85),
    ("ms-pl", "this license governs use of the accompanying software if you use the software you accept this license", 0.96),
    ("ms-rl", "for any file you distribute that contains code from the software in source code or binary format", 0.95),
    ("python", "psf is making python available to licensee on an as is basis", 0.98),
    ("python", "psf hereby grants licensee a nonexclusive royalty free world wide license", 0.97),
    ("postgresql", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement", 0.97),
    ("openssl", "this product includes software developed by the openssl project for use in the openssl toolkit", 0.97),
    ("ssleay", "this product includes cryptographic software written by eric young", 0.97),
    ("json", "the software shall be used for good not evil", 0.98),
    ("php", "products derived from this software may not be called php nor may php appear in their name", 0.97),
    ("ruby", "you may make and give away verbatim copies of the source form of the software without restriction", 0.9),
    ("vim", "there are no restrictions on distributing unmodified copies of vim except that they must include this license text", 0.97),
    ("curl", "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright", 0.93),
    ("icu", "provided that the above copyright notice s and this permission notice appear in all copies of the software", 0.9),
    ("unicode", "permission is hereby granted free of charge to any person obtaining a copy of the unicode data files", 0.97),
    ("w3c", "by obtaining and or copying this work you the licensee agree that you have read understood and will comply", 0.95),
    ("ofl-1.1", "this font software is licensed under the sil open font license version 1 1", 0.98),
    ("ofl", "the font software may be sold as part of a larger software package but no copy", 0.9),
    ("ofl", "no modified version of the font software may use the reserved font name", 0.95),
    ("ubuntu-font", "this licence allows the licensed fonts to be used studied modified and redistributed freely", 0.95),
    ("cc0", "to the extent possible under law .{1,160}? waived all copyright and related or neighboring rights", 0.97),
    ("cc0", "affirmer hereby overtly fully permanently irrevocably and unconditionally waives", 0.97),
    ("cc-by", "you must give appropriate credit provide a link to the license and indicate if changes were made", 0.85),
    ("cc-by-sa", "if you remix transform or build upon the material you must distribute your contributions under the same license", 0.93),
    ("cc-by-nc", "you may not use the material for commercial purposes", 0.85),
    ("cc-by-nd", "if you remix transform or build upon the material you may not distribute the modified material", 0.93),
    ("cc", "by exercising the licensed rights .{1,40}? you accept and agree to be bound by the terms and conditions of this creative commons", 0.95),
    ("cc", "some rights reserved", 0.5),
    ("odbl", "made available under the open database license", 0.97),
    ("odc-by", "made available under the open data commons attribution license", 0.97),
    ("pddl", "made available under the public domain dedication and license", 0.97),
    ("ogl-uk", "contains public sector information licensed under the open government licence", 0.98),
    ("openrail", "use based restrictions as referenced in paragraph 5", 0.93),
    ("openrail", "creativeml open rail m", 0.95),
    ("llama", "llama 2 is licensed under the llama 2 community license", 0.97),
    ("us-government", "this work was prepared by an employee of the united states government as part of", 0.8),
    ("public-domain", "(?:dedicated to|released into|placed in|in) the public domain", 0.7),
    ("public-domain", "the author hereby disclaims copyright to this source code", 0.95),
    ("public-domain", "no copyright is claimed", 0.7),
    ("proprietary", "this software is the confidential and proprietary information of", 0.95),
    ("proprietary", "unauthorized copying of this file via any medium is strictly prohibited", 0.95),
    ("proprietary", "may not be reproduced distributed or transmitted in any form or by any means without the prior written permission", 0.9),
    ("proprietary", "reverse engineer decompile or disassemble", 0.8),
    ("proprietary", "by installing copying or otherwise using the (?:software|product) you agree to be bound by the terms of this", 0.9),
    ("non-commercial", "for (?:personal|private|educational|academic|research)(?: and)? non commercial use only", 0.8),
    ("non-commercial", "commercial use (?:of this .{1,30}? )?is (?:strictly )?prohibited", 0.8),
    ("all-rights-reserved", "all rights reserved", 0.6),
    ("copyright", "copyright (?:c )?(?:19|20)[0-9][0-9]", 0.4),
)

# Addresses under which license texts are found, and fields of package files, as words.
PLACES = (
    ("apache-2.0", "apache org licenses license 2 0"),
    ("apache-1.1", "apache org licenses license 1 1"),
    ("apache-2.0", "opensource org licen[sc]es? apache 2 0"),
    ("mit", "opensource org licen[sc]es? mit(?: license)?"),
    ("bsd-2", "opensource org licen[sc]es? bsd 2 clause"),
    ("bsd-3", "opensource org licen[sc]es? bsd 3 clause"),
    ("bsd", "opensource org licen[sc]es? bsd license"),
    ("isc", "opensource org licen[sc]es? isc"),
    ("zlib", "opensource org licen[sc]es? zlib"),
    ("artistic-2.0", "opensource org licen[sc]es? artistic (?:license )?2 0"),
    ("osl-3.0", "opensource org licen[sc]es? osl 3 0"),
    ("afl-3.0", "opensource org licen[sc]es? afl 3 0"),
    ("cddl-1.0", "opensource org licen[sc]es? cddl(?: 1 0|1)?"),
    ("gpl-2.0", "gnu org licenses (?:old licenses )?gpl 2 0"),
    ("gpl-3.0", "gnu org licenses gpl 3 0"),
    ("gpl", "gnu org (?:licenses|copyleft) gpl(?: html| txt)?"),
    ("lgpl-2.1", "gnu org licenses (?:old licenses )?lgpl 2 1"),
    ("lgpl-3.0", "gnu org licenses lgpl 3 0"),
    ("lgpl", "gnu org (?:licenses|copyleft) (?:lgpl|lesser)(?: html| txt)?"),
    ("agpl-3.0", "gnu org licenses agpl(?: 3 0)?"),
    ("gfdl", "gnu org (?:licenses|copyleft) fdl"),
    ("gnu", "gnu org licenses"),
    ("mpl-1.1", "mozilla org mpl 1 1"),
    ("mpl-2.0", "mozilla org mpl 2 0"),
    ("mpl", "mozilla org mpl"),
    ("epl-1.0", "eclipse org legal epl v10"),
    ("epl-2.0", "eclipse org legal epl (?:2 0|v20)"),
    ("edl-1.0", "eclipse org org documents edl v10"),
    ("bsl-1", "boost org license 1 0 txt"),
    ("unlicense", "unlicense org"),
    ("wtfpl", "wtfpl net"),
    ("ofl", "scripts sil org ofl"),
    ("cecill", "cecill info licen[cs]es?"),
    ("eupl", "joinup ec europa eu .{0,60}?eupl"),
    ("polyform", "polyformproject org licenses"),
    ("odbl", "opendatacommons org licenses odbl"),
    ("pddl", "opendatacommons org licenses pddl"),
    ("odc-by", "opendatacommons org licenses by"),
    ("ogl-uk", "nationalarchives gov uk doc open government licen[cs]e"),
    ("cc0", "creativecommons org publicdomain zero(?: 1 0)?"),
    ("public-domain", "creativecommons org publicdomain mark"),
    ("public-domain", "creativecommons org licenses publicdomain"),
    ("cc", "creativecommons org licenses"),
    ("mit", "license osi approved mit license"),
    ("apache", "license osi approved apache software license"),
    ("bsd", "license osi approved bsd license"),
    ("isc", "license osi approved isc license"),
    ("gpl-2.0", "license osi approved gnu general public license v2(?: or later)?"),
    ("gpl-3.0", "license osi approved gnu general public license v3(?: or later)?"),
    ("lgpl", "license osi approved gnu lesser general public license"),
    ("lgpl-3.0", "license osi approved gnu lesser general public license v3(?: or later)?"),
    ("agpl-3.0", "license osi approved gnu affero general public license v3(?: or later)?"),
    ("mpl-2.0", "license osi approved mozilla public license 2 0"),
    ("python", "license osi approved python software foundation license"),
    ("zlib", "license osi approved zlib libpng license"),
    ("unlicense", "license osi approved the unlicense"),
    ("eupl-1.2", "license osi approved european union public licence 1 2"),
    ("cc0", "license cc0 1 0 universal"),
    ("public-domain", "license public domain"),
    ("proprietary", "license other proprietary license"),
    ("proprietary", "license unlicensed private true"),
    ("proprietary", "private true license unlicensed"),
    ("gpl", "module license gpl(?: v2)?"),
    ("dual-bsd-gpl", "module license dual bsd gpl"),
    ("dual-mit-gpl", "module license dual mit gpl"),
    ("proprietary", "module license proprietary"),
    ("license-file", "see license in (?:the )?(?:license|copying|licence)"),
    ("license-file", "see the (?:accompanying )?(?:license|licence|copying) file for (?:details|terms|more information)"),
    ("license-file", "that can be found in the license file"),
    ("license-file", "distributed with this (?:software|source|work|package) in the file license"),
)

# Identifiers and exceptions of license expressions.
IDENTIFIERS = """
0BSD AFL-2.1 AFL-3.0 AGPL-1.0 AGPL-3.0 AGPL-3.0-only AGPL-3.0-or-later Apache-1.0 Apache-1.1 Apache-2.0 Artistic-1.0 Artistic-2.0 BSD-1-Clause
BSD-2-Clause BSD-2-Clause-Patent BSD-3-Clause BSD-3-Clause-Clear BSD-4-Clause BSL-1.0 BUSL-1.1 CC-BY-3.0 CC-BY-4.0 CC-BY-NC-4.0 CC-BY-NC-ND-4.0
CC-BY-NC-SA-4.0 CC-BY-ND-4.0 CC-BY-SA-3.0 CC-BY-SA-4.0 CC0-1.0 CDDL-1.0 CDDL-1.1 CECILL-2.1 CPL-1.0 ECL-2.0 EPL-1.0 EPL-2.0 EUPL-1.1 EUPL-1.2
Elastic-2.0 GFDL-1.3 GPL-1.0 GPL-2.0 GPL-2.0-only GPL-2.0-or-later GPL-3.0 GPL-3.0-only GPL-3.0-or-later HPND ICU IPL-1.0 ISC JSON LGPL-2.0
LGPL-2.0-only LGPL-2.0-or-later LGPL-2.1 LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0 LGPL-3.0-only LGPL-3.0-or-later MIT MIT-0 MPL-1.0 MPL-1.1 MPL-2.0
MS-PL MS-RL MulanPSL-2.0 NCSA ODbL-1.0 OFL-1.1 OSL-2.1 OSL-3.0 OpenSSL PDDL-1.0 PHP-3.01 PSF-2.0 PostgreSQL Python-2.0 Ruby SSPL-1.0 UPL-1.0
Unicode-DFS-2016 Unlicense Vim W3C WTFPL X11 Zlib Autoconf-exception-3.0 Bison-exception-2.2 Classpath-exception-2.0 GCC-exception-3.1
LLVM-exception Linux-syscall-note
"""


@dataclass(frozen=True)
class Rule:
    """What a text must match, from the blank before its first word on."""

    label: str
    pattern: re.Pattern
    keywords: tuple[bytes, ...]
    confidence: float
    priority: int


def _rule(label: str, pattern: str, keywords: str, confidence: float, priority: int) -> Rule:
    return Rule(label, re.compile(b" " + pattern.encode() + b"(?= )"), tuple(keywords.encode().split()), confidence, priority)


def _keyword(pattern: str) -> str:
    """The longest word that stands in every match: one that touches no group, class or quantifier."""
    bare = pattern
    while "(" in bare:
        bare = re.sub(r"\([^()]*\)\??", "#", bare)
    return max((w for w in bare.split() if w.isalnum()), key=len)


@cache
def rules() -> tuple[Rule, ...]:
    """All rules in order: names, with and without version, in each way, then sentences, places and licenses by address.

    A rule has keywords of which every match holds one, so a text with none of them needs no search.
    """
    out = []
    for label, (name, words) in [*NAMES.items(), *((label, v[:2]) for label, v in VERSIONED.items())]:
        for way, confidence, priority in ORDINARY_WAYS if label in ORDINARY else WAYS:
            out.append(_rule(label, way.format(name), words, confidence, priority))
    for label, (name, words, versions) in VERSIONED.items():
        for version in versions:
            major, minor = version.split(".")
            number = f"(?: version| v)? ?v?{major}" + (f"(?: {minor})?" if minor == "0" else f" {minor}")
            for way, confidence, priority in VERSIONED_WAYS:
                out.append(_rule(f"{label}-{version}", way.format(f"{name}(?: public)?(?: licen[sc]e)?{number}"), words, confidence, priority))
            out.append(_rule(f"{label}-{version}", f"{name}(?: public)? licen[sc]e{number}", words, 0.9, 4))
            if label.startswith("cc-"):
                out.append(_rule(f"{label}-{version}", f"creativecommons org licenses {label[3:].replace('-', ' ')} {major} {minor}", "creativecommons", 0.97, 8))
    for label, pattern, confidence in SENTENCES:
        out.append(_rule(label, pattern, _keyword(pattern), confidence, 7))
    for label, pattern in PLACES:
        out.append(_rule(label, pattern, _keyword(pattern), 0.9, 7))
    return tuple(out)


def _identifiers() -> dict[bytes, str]:
    """Words of each identifier, longest first, and its label."""
    words = {re.sub(r"[^a-z0-9]", " ", i.lower()): re.sub(r"-(clause|only|or-later)$", "", i.lower()) for i in IDENTIFIERS.split()}
    return {w.encode(): words[w] for w in sorted(words, key=lambda w: (-len(w), w))}


IDS = _identifiers()
#: What an expression starts with; after the bare word license it must be an identifier that is no ordinary word.
OPENING = re.compile(rb" (?:(spdx (?:package )?licen[sc]e(?: identifier| concluded| declared)?|licen[sc]e expression)|licen[sc]es?)(?= )")
ONE_ID = re.compile(b" (" + b"|".join(IDS) + b")(?= )")
JOINER = re.compile(rb" (?:or|and|with)(?= )")


def expressions(line: bytes) -> list[tuple[int, int, int, float, str]]:
    """Identifiers joined by ``or``, ``and`` and ``with`` after a mark: places in the line, priority, confidence and label."""
    out = []
    for opening in OPENING.finditer(line):
        marked, at = opening.group(1) is not None, opening.end()
        while one := ONE_ID.match(line, at):
            label = IDS[one.group(1)]
            if not marked and label in ORDINARY:
                break
            out.append((one.start(1), one.end(), 9 if marked else 3, 0.99 if marked else 0.75, label))
            joined = JOINER.match(line, one.end())
            if joined is None:
                break
            at = joined.end()
    return out


SEPARATORS = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    """Lower-cased (A to Z) runs of ASCII letters, digits and all other characters beyond ASCII."""
    return text.encode("utf-8", "surrogatepass").lower().translate(SEPARATORS).split()


def suppress(found: list[tuple[int, int, int, float, str]]) -> list[tuple[int, int, int, float, str]]:
    """Detections (first, end, priority, confidence, label) that no stronger one contains.

    The stronger of two has the higher priority, then the longer interval, then the higher confidence, then the smaller label.
    A detection is dropped if a stronger one of an interval that contains its own is there: if that one is dropped itself, what
    drops it contains and drops this one too. So one sweep per priority over sorted intervals does, with the farthest end so far.
    """
    best: dict[tuple[int, int, int], tuple[float, str]] = {}
    for first, end, priority, confidence, label in found:
        key = (priority, first, end)
        if key not in best or (-confidence, label) < best[key]:
            best[key] = (-confidence, label)
    levels: dict[int, list[tuple[int, int]]] = {}
    for priority, first, end in best:
        levels.setdefault(priority, []).append((first, end))
    kept, above = [], np.empty((0, 2), np.int64)
    for priority in sorted(levels, reverse=True):
        own = np.array(sorted(levels[priority], key=lambda i: (i[0], -i[1])), np.int64)
        reach = np.maximum.accumulate(np.append(-1, own[:-1, 1]))
        inside = reach >= own[:, 1]
        if len(above):
            far = np.maximum.accumulate(above[:, 1])
            at = np.searchsorted(above[:, 0], own[:, 0], "right") - 1
            inside |= (at >= 0) & (far[at] >= own[:, 1])
        for first, end in own[~inside].tolist():
            confidence, label = best[priority, first, end]
            kept.append((first, end, priority, -confidence, label))
        above = np.concatenate((above, own))
        above = above[np.argsort(above[:, 0], kind="stable")]
    return kept


@cache
def _by_keyword() -> dict[bytes, tuple[int, ...]]:
    out: dict[bytes, list[int]] = {}
    for k, rule in enumerate(rules()):
        for word in rule.keywords:
            out.setdefault(word, []).append(k)
    return {k: tuple(v) for k, v in out.items()}


MARKS = {b"license", b"licence", b"licenses", b"licences"}

#: The last word of each base phrase that is rarer than its others.
BASE_WORDS = tuple((f" {phrase} ".encode(), phrase.encode().split()[k], label) for (phrase, label), k in zip(BASE.items(), (2, 0, 2), strict=True))


def scan_text(text: str | None) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score, spans of one text.

    ``spans`` are the surviving detections of the rules as ``label:first-end`` by words.
    """
    words = words_of(text or "")
    present = set(words)
    groups = _by_keyword()
    numbers = sorted({k for word in groups.keys() & present for k in groups[word]})
    bases = [b for b in BASE_WORDS if b[1] in present]
    if not numbers and not bases and not present & MARKS:
        return len(words), 0, None, None, "", "", 0.0, []
    line = b" " + b" ".join(words) + b" "
    starts = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.append(1, starts[:-1] + 1)
    at, base_labels = [], set()
    for phrase, _, label in bases:
        k = line.find(phrase)
        while k >= 0:
            at.append(k + 1)
            base_labels.add(label)
            k = line.find(phrase, k + 1)
    places = np.searchsorted(starts, at).tolist()
    hits = expressions(line) if present & MARKS else []
    for rule in map(rules().__getitem__, numbers):
        hits += [(m.start() + 1, m.end(), rule.priority, rule.confidence, rule.label) for m in rule.pattern.finditer(line)]
    firsts = np.searchsorted(starts, [h[0] for h in hits]).tolist()
    ends = np.searchsorted(starts, [h[1] for h in hits]).tolist()
    found = [(first, end, *h[2:]) for first, end, h in zip(firsts, ends, hits, strict=True)]
    kept = suppress(found)
    miss = 0.05 if base_labels else 1.0
    sure: dict[str, float] = {}
    for h in kept:
        sure[h[4]] = max(h[3], sure.get(h[4], 0.0))
    for label in sorted(sure):
        miss *= 1 - sure[label]
    labels = base_labels | {h[4] for h in kept}
    spans = [f"{h[4]}:{h[0]}-{h[1]}" for h in sorted(kept)]
    ends = (min(places), max(places)) if places else (None, None)
    return len(words), len(places), *ends, ",".join(sorted(base_labels)), ",".join(sorted(labels)), 1 - miss, spans


SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, spans array<string>"
)


def scan(docs: DataFrame, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Licenses named in each text: one row per row, no shuffle.

    Null and empty texts have no words and no labels (empty strings), places are null, score 0. Null ids are kept, repeated
    rows are repeated, other columns are ignored, an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 5 + [pa.string(), pa.string(), pa.float64(), pa.list_(pa.string())]
        names = [part.split()[0] for part in SCHEMA.split(", ")]
        for batch in batches:
            for part in (batch.slice(i, 1000) for i in range(0, batch.num_rows, 1000)):
                columns = list(zip(*(scan_text(v.as_py()) for v in part.column(1)), strict=True))
                arrays = [part.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds[1:], strict=True))]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return docs.select(F.col(row_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, SCHEMA)
