"""License scans by ordered signature rules, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import column, stage

#: The base phrases and their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: Public licenses, as (label, keywords of which one must occur, pattern of the name over lower-case words).
NAMES = [
    ("mit", "mit", r"(?:the )?mit(?: expat)?"),
    ("apache-1", "apache", r"(?:the )?apache(?: software)?(?: license)?(?: version| v)? ?1(?: [01])?"),
    ("apache-2", "apache", r"(?:the )?apache(?: software)?(?: license)?(?: version| v)? ?2(?: 0)?"),
    ("bsd-2-clause", "bsd", r"(?:the )?(?:simplified|freebsd|2 clause|two clause) bsd|(?:the )?bsd (?:2|two) clause"),
    ("bsd-3-clause", "bsd", r"(?:the )?(?:new|modified|revised|3 clause|three clause) bsd|(?:the )?bsd (?:3|three) clause"),
    ("bsd-4-clause", "bsd", r"(?:the )?(?:original|4 clause|four clause) bsd|(?:the )?bsd (?:4|four) clause"),
    ("0bsd", "0bsd", r"0bsd"),
    ("isc", "isc", r"(?:the )?isc"),
    ("zlib", "zlib", r"(?:the )?zlib(?: libpng)?"),
    ("gpl-1", "gpl|general public", r"(?:the )?(?:gnu )?(?:gpl|general public license)(?: version| v)? ?1(?: 0)?"),
    ("gpl-2", "gpl|general public", r"(?:the )?(?:gnu )?(?:gpl|general public license)(?: version| v)? ?2(?: 0)?"),
    ("gpl-3", "gpl|general public", r"(?:the )?(?:gnu )?(?:gpl|general public license)(?: version| v)? ?3(?: 0)?"),
    ("lgpl-2", "lgpl|general public", r"(?:the )?(?:gnu )?(?:lgpl|(?:library|lesser) general public license)(?: version| v)? ?2(?: 0)?"),
    ("lgpl-2.1", "lgpl|general public", r"(?:the )?(?:gnu )?(?:lgpl|(?:library|lesser) general public license)(?: version| v)? ?2 1"),
    ("lgpl-3", "lgpl|general public", r"(?:the )?(?:gnu )?(?:lgpl|lesser general public license)(?: version| v)? ?3(?: 0)?"),
    ("agpl-3", "agpl|affero", r"(?:the )?(?:gnu )?(?:agpl|affero general public license)(?: version| v)? ?3(?: 0)?"),
    ("mpl-1.1", "mozilla|mpl", r"(?:the )?(?:mozilla public license|mpl)(?: version| v)? ?1 1"),
    ("mpl-2", "mozilla|mpl", r"(?:the )?(?:mozilla public license|mpl)(?: version| v)? ?2(?: 0)?"),
    ("epl-1", "eclipse|epl", r"(?:the )?(?:eclipse public license|epl)(?: version| v)? ?1(?: 0)?"),
    ("epl-2", "eclipse|epl", r"(?:the )?(?:eclipse public license|epl)(?: version| v)? ?2(?: 0)?"),
    ("cddl-1", "common development|cddl", r"(?:the )?(?:common development and distribution license|cddl)(?: version| v)? ?1(?: [01])?"),
    ("cpl-1", "common public", r"(?:the )?common public license(?: version| v)? ?1(?: 0)?"),
    ("ms-pl", "microsoft|ms pl", r"(?:the )?microsoft public license|ms pl"),
    ("ms-rl", "microsoft|ms rl", r"(?:the )?microsoft reciprocal license|ms rl"),
    ("eupl-1.2", "european union|eupl", r"(?:the )?(?:european union public license|eupl)(?: version| v)? ?1 2"),
    ("artistic-1", "artistic", r"(?:the )?artistic license(?: version| v)? ?1(?: 0)?"),
    ("artistic-2", "artistic", r"(?:the )?artistic license(?: version| v)? ?2(?: 0)?"),
    ("bsl-1", "boost", r"(?:the )?boost software license(?: version| v)?(?: ?1(?: 0)?)?"),
    ("busl-1.1", "business", r"(?:the )?business source license(?: version| v)?(?: ?1(?: 1)?)?"),
    ("sspl-1", "server side|sspl", r"(?:the )?(?:server side public license|sspl)(?: version| v)?(?: ?1(?: 0)?)?"),
    ("elastic-2", "elastic", r"(?:the )?elastic license(?: version| v)?(?: ?2(?: 0)?)?"),
    ("unlicense", "unlicense", r"(?:the )?unlicense"),
    ("wtfpl", "wtfpl|what the fuck", r"wtfpl|do what the fuck you want to public license"),
    ("cc0-1", "cc0|zero|commons 0", r"cc0(?: 1 0)?|creative commons (?:zero|0)|cc zero"),
    ("cc-by", "cc by|creative commons", r"cc by(?: \d(?: \d)?)?|creative commons attribution(?: \d(?: \d)?)?(?: international| unported)?"),
    ("cc-by-sa", "cc by|creative commons", r"cc by sa(?: \d(?: \d)?)?|creative commons attribution share ?alike(?: \d(?: \d)?)?(?: international| unported)?"),
    ("cc-by-nd", "cc by|creative commons", r"cc by nd(?: \d(?: \d)?)?|creative commons attribution no ?deriv(?:s|atives)(?: \d(?: \d)?)?(?: international| unported)?"),
    ("cc-by-nc", "cc by|creative commons", r"cc by nc(?: \d(?: \d)?)?|creative commons attribution non ?commercial(?: \d(?: \d)?)?(?: international| unported)?"),
    ("cc-by-nc-sa", "cc by|creative commons", r"cc by nc sa(?: \d(?: \d)?)?|creative commons attribution non ?commercial share ?alike(?: \d(?: \d)?)?(?: international| unported)?"),
    ("cc-by-nc-nd", "cc by|creative commons", r"cc by nc nd(?: \d(?: \d)?)?|creative commons attribution non ?commercial no ?deriv(?:s|atives)(?: \d(?: \d)?)?(?: international| unported)?"),
    ("ofl-1.1", "open font|ofl", r"(?:the )?sil open font license(?: version| v)?(?: ?1(?: 1)?)?|ofl 1 1"),
    ("psf-2", "python", r"(?:the )?(?:psf|python software foundation)(?: license)?(?: version| v)?(?: ?2(?: 0)?)?"),
    ("postgresql", "postgresql", r"(?:the )?postgresql"),
    ("openssl", "openssl", r"(?:the )?openssl"),
    ("php-3", "php", r"(?:the )?php license(?: version| v)? ?3(?: 01?)?"),
    ("ruby", "ruby", r"(?:the )?ruby"),
    ("vim", "vim", r"(?:the )?vim"),
    ("x11", "x11", r"(?:the )?x11"),
    ("ncsa", "ncsa", r"(?:the )?(?:university of illinois )?ncsa(?: open source)?"),
    ("afl-3", "academic free|afl", r"(?:the )?academic free license(?: version| v)? ?3(?: 0)?|afl 3 0"),
    ("osl-3", "open software|osl", r"(?:the )?open software license(?: version| v)? ?3(?: 0)?|osl 3 0"),
    ("odbl-1", "open database|odbl", r"(?:the )?(?:open database license|odbl)(?: version| v)?(?: ?1(?: 0)?)?"),
    ("gfdl", "free documentation|gfdl", r"(?:the )?(?:gnu free documentation license|gfdl)(?: version| v)?(?: ?1(?: [0-3])?)?"),
    ("qpl-1", " q public", r"(?:the )?q public license(?: version| v)?(?: ?1(?: 0)?)?"),
    ("upl-1", "universal permissive", r"(?:the )?universal permissive license(?: version| v)?(?: ?1(?: 0)?)?"),
    ("blueoak-1", "blue", r"(?:the )?blue oak model license(?: version| v)?(?: ?1(?: 0(?: 0)?)?)?"),
    ("mulan-2", "mulan", r"(?:the )?mulan (?:psl|permissive software license)(?: version| v)?(?: ?2(?: 0)?)?"),
    ("zpl-2.1", "zope", r"(?:the )?zope public license(?: version| v)?(?: ?2(?: [01])?)?"),
]

#: How a name is cited, as (priority, confidence, keyword, prefix, suffix); a smaller priority wins.
CITATIONS = [
    (1, 1.0, "spdx", r"spdx license identifier (?:", r")(?: only| or later)?"),
    (2, 0.95, "ed under", r"(?:re)?(?:licensed|released|distributed|published) under (?:the terms of |the conditions of )?(?:", r")(?: licen[sc]e)?(?: only| or later)?"),
    (2, 0.95, "the terms", r"(?:under|subject to|governed by|according to) (?:the terms of |the terms and conditions of )(?:", r")(?: licen[sc]e)?"),
    (2, 0.9, " is ", r"(?:this|the) (?:work|text|file|software|program|library|document|content) is (?:under|covered by) (?:", r")(?: licen[sc]e)?"),
    (3, 0.8, "under", r"under (?:", r") licen[sc]e"),
    (3, 0.7, "licen", r"licen[sc]e (?:is )?(?:", r")"),
]

#: Signatures that need no name, as (label, priority, confidence, keyword, pattern).
SIGNATURES = [
    ("mit", 1, 0.95, "permission is hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("isc", 1, 0.95, "permission to use", r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee"),
    ("bsd", 1, 0.9, "redistribution and use", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("gpl", 1, 0.9, "this program is free software", r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("apache-2", 1, 0.95, "licensed under the apache", r"licensed under the apache license version 2 0 the license you may not use this file except in compliance"),
    ("unlicense", 1, 0.95, "free and unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("public-domain", 2, 0.7, "public domain", r"(?:in|into|to) the public domain"),
    ("all-rights-reserved", 3, 0.6, "all rights reserved", r"all rights reserved"),
    ("apache-2", 3, 0.8, "apache license", r"apache license version 2(?: 0)?"),
    ("cc-by-nc-sa", 2, 0.9, "cc by nc sa", r"cc by nc sa(?: \d \d)?"),
    ("cc-by-nc-nd", 2, 0.9, "cc by nc nd", r"cc by nc nd(?: \d \d)?"),
    ("cc-by-nc", 3, 0.9, "cc by nc", r"cc by nc(?: \d \d)?"),
    ("cc-by-sa", 3, 0.9, "cc by sa", r"cc by sa(?: \d \d)?"),
    ("cc-by-nd", 3, 0.9, "cc by nd", r"cc by nd(?: \d \d)?"),
    ("cc0-1", 3, 0.9, "cc0", r"cc0(?: 1 0)?"),
    ("mit", 1, 0.9, "the software is provided as is without warranty", r"the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("mit", 1, 0.9, "above copyright notice and this permission", r"the above copyright notice and this permission notice(?: including the next paragraph)? shall be included in all copies or substantial portions of the software"),
    ("mit-0", 1, 0.9, "mit no attribution", r"mit no attribution"),
    ("x11", 1, 0.9, "name of the x consortium", r"except as contained in this notice the name of the x consortium shall not be used in advertising"),
    ("isc", 1, 0.9, "the software is provided as is and the author", r"the software is provided as is and the author disclaims all warranties with regard to this software"),
    ("bsd", 1, 0.85, "redistributions of source code must retain", r"redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", 1, 0.85, "redistributions in binary form must reproduce", r"redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation"),
    ("bsd-3-clause", 1, 0.95, "endorse or promote products derived", r"neither the name of (?:the |its )?[^ ]+(?: [^ ]+){0,6} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd-4-clause", 1, 0.95, "all advertising materials mentioning", r"all advertising materials mentioning features or use of this software must display the following acknowledgement"),
    ("bsd-1-clause", 2, 0.8, "bsd 1 clause", r"bsd 1 clause"),
    ("bsd-3-clause-clear", 1, 0.9, "no express or implied licenses to any party", r"no express or implied licenses to any party s patent rights are granted by this license"),
    ("apache-1.1", 1, 0.9, "this product includes software developed by the apache", r"this product includes software developed by the apache (?:software foundation|group)"),
    ("apache-2", 1, 0.95, "you may not use this file except", r"you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0"),
    ("apache-2", 1, 0.9, "terms and conditions for use reproduction and distribution", r"apache license version 2 0 january 2004(?: http www apache org licenses)? terms and conditions for use reproduction and distribution"),
    ("gpl-2", 1, 0.95, "either version 2", r"gnu general public license as published by the free software foundation either version 2(?: 0)? of the license or at your option any later version"),
    ("gpl-3", 1, 0.95, "either version 3", r"gnu general public license as published by the free software foundation either version 3(?: 0)? of the license or at your option any later version"),
    ("gpl-2-only", 1, 0.95, "version 2 of the license", r"gnu general public license(?: version 2)? as published by the free software foundation version 2 of the license"),
    ("gpl", 2, 0.8, "you should have received a copy of the gnu general", r"you should have received a copy of the gnu general public license along with this program"),
    ("gpl-2", 1, 0.9, "gnu general public license version 2 june 1991", r"gnu general public license version 2 june 1991"),
    ("gpl-3", 1, 0.9, "gnu general public license version 3 29 june 2007", r"gnu general public license version 3 29 june 2007"),
    ("lgpl", 1, 0.9, "gnu lesser general public license", r"(?:it under the terms of|received a copy of) the gnu lesser general public license"),
    ("lgpl-2", 1, 0.9, "gnu library general public license", r"(?:it under the terms of|received a copy of) the gnu library general public license"),
    ("lgpl-2.1", 1, 0.9, "version 2 1 february 1999", r"gnu lesser general public license version 2 1 february 1999"),
    ("agpl-3", 1, 0.9, "gnu affero general public license", r"(?:it under the terms of|received a copy of) the gnu affero general public license"),
    ("gfdl", 1, 0.9, "no invariant sections", r"with no invariant sections no front cover texts and no back cover texts"),
    ("gfdl", 1, 0.9, "permission is granted to copy distribute and or modify this document", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("gpl-linking-exception", 1, 0.9, "as a special exception", r"as a special exception (?:you|the copyright holders?)(?: [^ ]+){0,8} permission to link"),
    ("classpath-exception", 1, 0.9, "independent modules to produce an executable", r"give you permission to link this library with independent modules to produce an executable"),
    ("mpl-1.1", 1, 0.95, "the contents of this file are subject to the mozilla", r"the contents of this file are subject to the mozilla public license version 1 1"),
    ("mpl-1.0", 1, 0.95, "mozilla public license version 1 0", r"subject to the mozilla public license version 1 0"),
    ("mpl-2", 1, 0.95, "this source code form is subject to", r"this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("npl-1.1", 1, 0.9, "netscape public license", r"subject to the netscape public license version 1 1"),
    ("epl-1", 1, 0.9, "eclipse public license v1 0", r"this program and the accompanying materials are made available under the terms of the eclipse public license v1 0"),
    ("epl-2", 1, 0.9, "eclipse public license 2 0", r"this program and the accompanying materials are made available under the terms of the eclipse public license(?: v)? 2 0"),
    ("cpl-1", 1, 0.9, "common public license v1 0", r"made available under the terms of the common public license v1 0"),
    ("ipl-1", 1, 0.9, "ibm public license", r"under the terms of the ibm public license"),
    ("cddl-1", 1, 0.95, "common development and distribution license the license", r"the contents of this file are subject to the terms of the common development and distribution license the license"),
    ("edl-1", 1, 0.9, "eclipse distribution license", r"under the terms of the eclipse distribution license v 1 0"),
    ("artistic-1", 1, 0.9, "the artistic license preamble", r"the artistic license preamble"),
    ("artistic-2", 1, 0.9, "everyone is permitted to copy and distribute verbatim", r"artistic license 2 0 copyright c 2000 2006 the perl foundation everyone is permitted to copy and distribute verbatim copies"),
    ("perl-5", 1, 0.9, "same terms as perl", r"(?:redistribute it and or modify it|distributed|licensed) under the same terms as perl(?: itself)?"),
    ("ruby", 1, 0.85, "same terms as ruby", r"(?:distributed|licensed|modify it) under the same terms as ruby"),
    ("python-2", 1, 0.9, "psf license agreement for python", r"psf license agreement for python"),
    ("zlib", 1, 0.95, "in no event will the authors be held liable", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software"),
    ("zlib", 2, 0.8, "the origin of this software must not be misrepresented", r"the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ("bsl-1", 1, 0.95, "boost software license version 1 0", r"distributed under the boost software license version 1 0"),
    ("bsl-1", 1, 0.9, "permission is hereby granted free of charge to any person or organization", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("openssl", 1, 0.95, "this product includes software developed by the openssl project", r"this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("ssleay", 1, 0.9, "cryptographic software written by eric young", r"this product includes cryptographic software written by eric young"),
    ("php-3", 1, 0.95, "this product includes php software", r"this product includes php software freely available from"),
    ("postgresql", 1, 0.95, "permission to use copy modify and distribute this software and its documentation", r"permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("ntp", 1, 0.85, "with or without fee is hereby granted", r"permission to use copy modify and distribute this software and its documentation for any purpose with or without fee is hereby granted"),
    ("hpnd", 1, 0.8, "and its documentation for any purpose and without fee", r"permission to use copy modify and distribute this software and its documentation for any purpose and without fee is hereby granted"),
    ("ncsa", 1, 0.9, "deal with the software without restriction", r"to deal with the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("curl", 1, 0.85, "permission to use copy modify and distribute this software for any purpose", r"permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("vim", 1, 0.85, "vim is charityware", r"vim is charityware"),
    ("wtfpl", 1, 0.95, "you just do what the", r"you just do what the fuck you want to"),
    ("beerware", 1, 0.95, "you can buy me a beer", r"if we meet some day and you think this stuff is worth it you can buy me a beer in return"),
    ("unlicense", 1, 0.9, "anyone is free to copy modify publish", r"anyone is free to copy modify publish use compile sell or distribute this software"),
    ("cc0-1", 1, 0.95, "to the extent possible under law", r"to the extent possible under law(?: [^ ]+){0,12} (?:has|have) (?:waived|dedicated) all copyright"),
    ("cc0-1", 1, 0.9, "cc0 1 0 universal", r"cc0 1 0 universal"),
    ("pddl-1", 1, 0.9, "public domain dedication and licen", r"(?:open data commons )?public domain dedication and licen[sc]e"),
    ("odc-by-1", 1, 0.9, "open data commons attribution", r"open data commons attribution licen[sc]e"),
    ("odbl-1", 1, 0.9, "open data commons open database", r"open data commons open database licen[sc]e"),
    ("cc-by", 1, 0.9, "creative commons attribution", r"this work is licensed under a creative commons attribution \d(?: \d)?(?: international| unported)? license"),
    ("cc-by-sa", 1, 0.9, "creative commons attribution share", r"this work is licensed under a creative commons attribution share ?alike \d(?: \d)?(?: international| unported)? license"),
    ("cc-by-nd", 1, 0.9, "creative commons attribution no", r"this work is licensed under a creative commons attribution no ?deriv(?:s|atives) \d(?: \d)?(?: international| unported)? license"),
    ("cc-by-nc", 1, 0.9, "creative commons attribution non", r"this work is licensed under a creative commons attribution non ?commercial \d(?: \d)?(?: international| unported)? license"),
    ("cc-by", 2, 0.9, "creativecommons org licenses by", r"creativecommons org licenses by \d \d"),
    ("cc-by-sa", 2, 0.9, "creativecommons org licenses by sa", r"creativecommons org licenses by sa \d \d"),
    ("cc-by-nc", 2, 0.9, "creativecommons org licenses by nc", r"creativecommons org licenses by nc \d \d"),
    ("cc-by-nd", 2, 0.9, "creativecommons org licenses by nd", r"creativecommons org licenses by nd \d \d"),
    ("cc-by-nc-sa", 2, 0.9, "creativecommons org licenses by nc sa", r"creativecommons org licenses by nc sa \d \d"),
    ("cc-by-nc-nd", 2, 0.9, "creativecommons org licenses by nc nd", r"creativecommons org licenses by nc nd \d \d"),
    ("cc0-1", 2, 0.9, "creativecommons org publicdomain zero", r"creativecommons org publicdomain zero \d \d"),
    ("cc-pdm", 2, 0.9, "creativecommons org publicdomain mark", r"creativecommons org publicdomain mark \d \d"),
    ("gpl-3", 2, 0.85, "www gnu org licenses gpl 3", r"www gnu org licenses gpl 3 0"),
    ("gpl-2", 2, 0.85, "www gnu org licenses", r"www gnu org licenses (?:old licenses )?gpl 2 0"),
    ("lgpl-3", 2, 0.85, "www gnu org licenses lgpl 3", r"www gnu org licenses lgpl 3 0"),
    ("lgpl-2.1", 2, 0.85, "www gnu org licenses", r"www gnu org licenses (?:old licenses )?lgpl 2 1"),
    ("agpl-3", 2, 0.85, "www gnu org licenses agpl 3", r"www gnu org licenses agpl 3 0"),
    ("mit", 2, 0.85, "opensource org licenses mit", r"opensource org licenses mit"),
    ("bsd-3-clause", 2, 0.85, "opensource org licenses bsd 3", r"opensource org licenses bsd 3 clause"),
    ("bsd-2-clause", 2, 0.85, "opensource org licenses bsd 2", r"opensource org licenses bsd 2 clause"),
    ("isc", 2, 0.85, "opensource org licenses isc", r"opensource org licenses isc"),
    ("ofl-1.1", 1, 0.95, "with reserved font name", r"with reserved font names?"),
    ("ofl-1.1", 1, 0.9, "scripts sil org ofl", r"scripts sil org ofl"),
    ("bitstream-vera", 1, 0.9, "bitstream vera is a trademark", r"bitstream vera is a trademark of bitstream inc"),
    ("sspl-1", 1, 0.9, "server side public license version 1", r"server side public license version 1(?: as published by mongodb inc)?"),
    ("elastic-2", 1, 0.9, "you may not provide the software to third parties as a hosted", r"you may not provide the software to third parties as a hosted or managed service"),
    ("busl-1.1", 1, 0.9, "change license", r"additional use grant(?: [^ ]+){0,60} change date(?: [^ ]+){0,20} change license"),
    ("commons-clause", 1, 0.9, "commons clause", r"commons clause license condition v1 0"),
    ("polyform-nc-1", 1, 0.9, "polyform noncommercial license", r"polyform noncommercial license 1 0 0"),
    ("json", 1, 0.9, "shall be used for good not evil", r"the software shall be used for good not evil"),
    ("ms-pl", 1, 0.9, "if you use the software you accept this license", r"if you use the software you accept this license if you do not accept the license do not use the software"),
    ("eupl-1.2", 1, 0.9, "european union public licence", r"european union public licence(?: version| v)? ?1 2"),
    ("cecill-2.1", 1, 0.9, "cecill", r"cecill(?: free software license agreement)?(?: version| v)? ?2 1"),
    ("cecill-b", 1, 0.9, "cecill b", r"cecill b"),
    ("cecill-c", 1, 0.9, "cecill c", r"cecill c"),
    ("mulan-2", 1, 0.9, "mulan psl v2", r"licensed under mulan psl v2"),
    ("upl-1", 1, 0.9, "the universal permissive license", r"the universal permissive license upl version 1 0"),
    ("afl-3", 1, 0.9, "licensed under the academic free", r"licensed under the academic free license version 3 0"),
    ("osl-3", 1, 0.9, "licensed under the open software", r"licensed under the open software license version 3 0"),
    ("llama-3", 1, 0.9, "llama 3", r"meta llama 3(?: [1-3])? community license(?: agreement)?"),
    ("openrail", 1, 0.9, "rail", r"(?:creativeml |bigscience )?open ?rail(?: [ms])?(?: license)?"),
    ("proprietary", 2, 0.7, "proprietary and confidential", r"proprietary and confidential"),
    ("proprietary", 2, 0.7, "strictly prohibited", r"unauthorized (?:copying|use|reproduction|distribution)(?: [^ ]+){0,12} is strictly prohibited"),
    ("all-rights-reserved", 2, 0.7, "may be reproduced", r"no part of this (?:publication|book|work|document) may be reproduced"),
    ("no-redistribution", 2, 0.7, "may not be redistributed", r"may not be redistributed(?: without (?:prior )?(?:written )?permission)?"),
    ("non-commercial", 3, 0.6, "non commercial", r"for (?:personal and )?non commercial use only"),
    ("free-use", 3, 0.6, "free for personal", r"free for personal(?: and commercial)? use"),
]

#: A document without any of these words' beginnings can match no rule.
GATE = (
    "licen", "under", "subject to", "governed", "according", "covered", "spdx", "permission", "redistribut", "this program is free", "unencumbered", "public domain", "all rights reserved", "cc by", "cc0",
    "1 clause", "no attribution", "warrant", "advertising", "publicdomain", "charityware", "do what the", "buy me a beer", "free to copy", "reserved font name", "scripts sil org", "vera is a trademark", "third parties as a hosted",
    "used for good", "cecill", "openrail", "open rail", "confidential", "prohibited", "may not be re", "may be reproduced", "non commercial", "free for personal", "invariant", "software developed by", "written by eric", "php software",
    "misrepresented",
)


def rules() -> list[tuple[str, int, float, tuple[str, str], str, bool]]:
    """Every rule as (label, priority, confidence, keywords, pattern over lower-case words, whether it is a base phrase);
    each of the keywords, or one of its parts between bars, must occur."""
    found = [(label, 0, 1.0, (phrase, phrase), phrase, True) for phrase, label in BASE.items()]
    found += [(label, p, c, (k, k), r, False) for label, p, c, k, r in SIGNATURES]
    for label, keywords, name in NAMES:
        found += [(label, priority, confidence, (anchor, keywords), before + name + after, False) for priority, confidence, anchor, before, after in CITATIONS]
    return found


def words_of(text: Column) -> Column:
    """The lower-cased words between single blanks, with a blank at either end.

    lower() also lowers other letters, which stay outside ASCII, except for the Kelvin sign; that is replaced first.
    """
    lowered = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("É")))
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(lowered, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")), F.lit(" "))


def blanks(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _groups() -> list[tuple[str, str, list]]:
    """Rules that share an anchor, with one pattern that matches where any of them does."""
    by: dict[tuple, list] = {}
    for rule in rules():
        by.setdefault((rule[3][0], rule[1], rule[5]), []).append(rule)
    return [(anchor, f"(?<= )(?:{'|'.join(f'(?:{r[4]})' for r in of)})(?= )", of) for (anchor, _, _), of in by.items()]


def _hits(words: Column, anchor: str, whole: str, of: list) -> Column:
    """The rules of a group that match. The group's pattern, compiled once, keeps texts away from the single ones, which
    are compiled row by row."""
    listed = F.array(*[
        F.struct(F.lit(l).alias("label"), F.lit(p).alias("priority"), F.lit(float(c)).alias("confidence"), F.lit(b).alias("base"), F.array(*map(F.lit, k[1].split("|"))).alias("keywords"), F.lit(f"(?<= )(?:{r})(?= )").alias("pattern"))
        for l, p, c, k, r, b in of
    ])
    matched = F.filter(listed, lambda r: F.exists(r["keywords"], lambda k: F.contains(words, k)) & F.rlike(words, r["pattern"]))
    return F.when(F.contains(words, F.lit(anchor)) & F.rlike(words, F.lit(whole)), matched).otherwise(F.slice(listed, 1, 0))


def detect(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Scans every whole text by the rules.

    Returns two tables that share the column `row`: the documents (row, key, n_words) and the detections (row, label,
    priority, confidence, base, first, last, kept). A rule is tried only on texts with its keyword. Words count from
    0, first and last are a detection's. A detection inside another one goes unless it has the better priority; of
    equal intervals the better priority stays, then the smaller label. Base phrases never go.

    Null text has no words. Repeated rows stay separate; an empty table gives two empty tables.
    """
    words, gate = F.col("words"), F.lit(False)
    for word in GATE:
        gate = gate | F.contains(words, F.lit(word))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), column(key).alias("key"), words_of(column(text)).alias("words"))
    n_words = F.greatest(blanks(words) - 1 - (words == "  ").cast("int"), F.lit(0)).cast("long")
    # written, as Spark would else make the words again for every use; only the words of texts that pass the gate
    read = stage(rows.select("row", "key", n_words.alias("n_words"), F.when(gate, words).alias("words")), "licenses")
    found = F.flatten(F.array(*[_hits(words, anchor, whole, of) for anchor, whole, of in _groups()]))
    scanned = stage(read.filter("words IS NOT NULL").select("row", "words", found.alias("found")), "licenses-found")
    hits = scanned.select("row", "words", F.explode("found").alias("r")).select(
        "row", "r.label", "r.priority", "r.confidence", "r.base", "r.pattern",
        F.transform(F.expr("split(words, r.pattern, -1)"), lambda g: (blanks(g) - 1).cast("long")).alias("gaps"),
        F.transform(F.expr("regexp_extract_all(words, r.pattern, 0)"), lambda m: (blanks(m) + 1).cast("long")).alias("lengths"),
    )
    placed = hits.select("row", "label", "priority", "confidence", "base", "pattern", F.posexplode(F.arrays_zip("gaps", "lengths")).alias("no", "x")).filter("x.lengths IS NOT NULL")
    so_far = Window.partitionBy("row", "pattern", "label").orderBy("no").rowsBetween(Window.unboundedPreceding, 0)
    last = F.sum(F.col("x.gaps") + F.col("x.lengths")).over(so_far) - 1
    placed = placed.withColumn("last", last).withColumn("first", F.col("last") - F.col("x.lengths") + 1)
    outer = Window.partitionBy("row").orderBy("first", F.desc("last"), "priority", "label", "pattern").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.lit(False)
    for p in (0, 1, 2, 3):
        inside = inside | ((F.col("priority") >= p) & (F.max(F.when(F.col("priority") == p, F.col("last"))).over(outer) >= F.col("last")))
    kept = placed.withColumn("kept", F.col("base") | ~F.coalesce(inside, F.lit(False)))
    return read.select("row", "key", "n_words"), kept.select("row", "label", "priority", "confidence", "base", "first", "last", "kept")


def scan(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, n_words, n_base, first_word, last_word, base_labels, labels, score.

    score is the best confidence of a detection that is kept, 0 without one. See detect() for the defined cases.
    """
    documents, found = detect(docs, key=key, text=text)
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    summed = found.groupBy("row").agg(
        F.sum(F.col("base").cast("long")).alias("n_base"), F.min(F.when(F.col("base"), F.col("first"))).alias("first_word"), F.max(F.when(F.col("base"), F.col("first"))).alias("last_word"),
        joined(F.when(F.col("base"), F.col("label"))).alias("base_labels"), joined(F.when(F.col("kept"), F.col("label"))).alias("labels"), F.max(F.when(F.col("kept"), F.col("confidence"))).alias("score"),
    )
    return documents.join(summed, "row", "left").select(
        F.col("key").alias(key), "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def op6_licenses(spark, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
