"""License signatures written by hand: what standard notices and license texts say.

``label: (keyword, expression, kind)`` over lower-case words between single spaces. Every
match of an expression holds its keyword. Kinds: a notice that grants a license, a clause
of a license's own text, a heading, and an identifier or address that stands alone.
"""

from __future__ import annotations

#: kind: (priority, score).
KINDS = {"notice": (2, 0.95), "clause": (3, 0.9), "heading": (4, 0.75), "id": (4, 0.7)}

BSD_BODY = (
    "redistributions of source code must retain the above copyright notice this list of conditions and the "
    "following disclaimer (?:(?:2|b) )?redistributions in binary form must reproduce the above copyright notice "
    "this list of conditions and the following disclaimer in the documentation and or other materials provided "
    "with the distribution "
)
FSF = "as published by the free software foundation "
LATER = "(?: of the licen[cs]e)?(?: or at your option any later version| only)?"
GIVEN = (
    "(?:(?:licen[cs]ed|released|distributed|available|published|provided|dedicated) (?:to you )?)?under "
    "(?:(?:the|a|an|this) )?(?:terms of )?(?:(?:the|a|an|this) )?creative commons attribution"
)
PORT = "(?: [1234] [05])?(?: international| unported| generic)?(?: public)?(?: licen[cs]e)?"

SIGNATURES = {
    "mit": (
        ("any person obtaining a copy", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files(?: the software)? to deal in the software without restriction", "clause"),
        ("this permission notice", "the above copyright notice and this permission notice(?: including the next paragraph)? shall be included in all copies or substantial portions of the software", "clause"),
        ("authors or copyright holders be liable", "in no event shall the authors or copyright holders be liable for any claim damages or other liability", "clause"),
        ("expat licen", "expat licen[cs]e", "heading"),
        ("licenses mit", "(?:opensource org licenses mit|opensource org licenses mit license php)", "id"),
        ("mit licensed", "mit licensed", "heading"),
    ),
    "mit-0": (
        ("mit no attribution", "mit no attribution", "heading"),
        ("licenses mit 0", "opensource org licenses mit 0", "id"),
    ),
    "x11": (
        ("x consortium", "except as contained in this notice the name of the x consortium shall not be used in advertising", "clause"),
        ("x11 license", "x11 license", "heading"),
    ),
    "apache-1.1": (
        ("apache software license version 1 1", "(?:the )?apache software license version 1 1", "heading"),
        ("developed by the apache software foundation", "this product includes software developed by the apache software foundation", "clause"),
        ("apache 1 1", "apache 1 1", "id"),
    ),
    "apache-2": (
        ("except in compliance with the license", "licensed under the apache license version 2 0 the license you may not use this (?:file|work|software|project) except in compliance with the license", "notice"),
        ("contributor license agreements", "licensed to the apache software foundation asf under one or more contributor license agreements", "notice"),
        ("distributed under the license is distributed", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis", "clause"),
        ("terms and conditions for use reproduction and distribution", "terms and conditions for use reproduction and distribution", "clause"),
        ("each contributor hereby grants to you", "subject to the terms and conditions of this license each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable", "clause"),
        ("apache license", "apache license(?: version)? 2 0(?: january 2004)?", "heading"),
        ("apache org licenses", "apache org licenses license 2 0", "id"),
        ("apache 2 0", "apache 2 0", "id"),
    ),
    "bsd": (
        ("source and binary forms", "redistribution and use in source and binary forms with or without modification are permitted", "clause"),
        ("bsd style licen", "bsd style licen[cs]e", "heading"),
        ("bsd licen", "(?:under )?(?:a |the )?bsd licen[cs]e", "heading"),
    ),
    "bsd-2": (
        ("redistributions in binary form", BSD_BODY + "this software is provided by", "clause"),
        ("bsd 2 clause", "bsd 2 clause", "id"),
        ("freebsd project", "policies either expressed or implied of the freebsd project", "clause"),
    ),
    "bsd-3": (
        ("neither the name", BSD_BODY + "(?:(?:3|c) )?neither the name", "clause"),
        ("used to endorse or promote products", "neither the names? of (?:[^ ]+ ){1,20}?(?:may|will|shall|can) be used to endorse or promote products derived from this software without specific prior written permission", "clause"),
        ("bsd 3 clause", "bsd 3 clause", "id"),
        ("governed by a bsd style", "use of this source code is governed by a bsd style license that can be found in the license file", "notice"),
    ),
    "bsd-4": (
        ("all advertising materials", "all advertising materials mentioning features or use of this software must display the following acknowledge?ment", "clause"),
        ("bsd 4 clause", "bsd 4 clause", "id"),
    ),
    "isc": (
        ("with or without fee is hereby granted", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", "clause"),
        ("isc licen", "(?:the )?isc licen[cs]e", "heading"),
    ),
    "0bsd": (
        ("with or without fee is hereby granted", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided as is", "clause"),
        ("zero clause bsd", "(?:bsd )?zero clause bsd(?: licen[cs]e)?", "heading"),
        ("0bsd", "0bsd", "id"),
    ),
    "gpl-1": (
        ("general public license", "gnu general public license " + FSF + "(?:either )?version 1" + LATER, "notice"),
        ("general public license", "gnu general public license version 1(?: february 1989)?", "heading"),
    ),
    "gpl-2": (
        ("general public license", "(?:under (?:the )?(?:terms (?:and conditions )?of )?(?:the )?)?gnu general public license(?: gpl)?(?: v ?2| version 2)? " + FSF + "(?:either )?(?:in )?version 2(?: 0)?" + LATER, "notice"),
        ("general public license", "(?:under )?(?:the )?(?:terms of )?version 2(?: 0)? of the gnu general public license", "notice"),
        ("your freedom to share and change it", "the licenses for most software are designed to take away your freedom to share and change it", "clause"),
        ("general public license", "gnu general public license(?: gpl)?(?: version| v)? ?v?2(?: 0)?(?: june 1991)?", "heading"),
        ("gpl 2 0", "gpl 2 0(?: only| or later)?", "id"),
        ("gplv2", "gplv2", "id"),
        ("gpl v2", "gpl v2", "id"),
        ("licenses gpl 2 0", "gnu org licenses(?: old licenses)? gpl 2 0(?: html| txt)?", "id"),
    ),
    "gpl-3": (
        ("general public license", "(?:under (?:the )?(?:terms (?:and conditions )?of )?(?:the )?)?gnu general public license(?: gpl)?(?: v ?3| version 3)? " + FSF + "(?:either )?(?:in )?version 3(?: 0)?" + LATER, "notice"),
        ("general public license", "(?:under )?(?:the )?(?:terms of )?version 3(?: 0)? of the gnu general public license", "notice"),
        ("software and other practical works", "the licenses for most software and other practical works are designed to take away your freedom to share and change the works", "clause"),
        ("general public license", "gnu general public license(?: gpl)?(?: version| v)? ?v?3(?: 0)?(?: 29 june 2007)?", "heading"),
        ("gpl 3 0", "gpl 3 0(?: only| or later)?", "id"),
        ("gplv3", "gplv3", "id"),
        ("gpl v3", "gpl v3", "id"),
    ),
    "lgpl-2": (
        ("library general public license", "gnu library general public license(?: lgpl)? " + FSF + "(?:either )?version 2(?: 0)?" + LATER, "notice"),
        ("library general public license", "gnu library general public license(?: version)? v?2(?: 0)?(?: june 1991)?", "heading"),
    ),
    "lgpl-2.1": (
        ("lesser general public license", "(?:under (?:the )?(?:terms of )?(?:the )?)?gnu lesser general public license(?: lgpl)?(?: version 2 1)? " + FSF + "(?:either )?version 2 1" + LATER, "notice"),
        ("lesser general public license", "(?:under )?(?:the )?(?:terms of )?version 2 1 of the gnu lesser general public license", "notice"),
        ("some specially designated software packages", "this license the lesser general public license applies to some specially designated software packages", "clause"),
        ("lesser general public license", "gnu lesser general public license(?: lgpl)?(?: version)? v?2 1(?: february 1999)?", "heading"),
        ("lgpl 2 1", "lgpl 2 1(?: only| or later)?", "id"),
        ("lgplv2", "lgplv2(?: 1)?", "id"),
    ),
    "lgpl-3": (
        ("lesser general public license", "(?:under (?:the )?(?:terms of )?(?:the )?)?gnu lesser general public license(?: lgpl)?(?: version 3)? " + FSF + "(?:either )?version 3(?: 0)?" + LATER, "notice"),
        ("lesser general public license", "(?:under )?(?:the )?(?:terms of )?version 3(?: 0)? of the gnu lesser general public license", "notice"),
        ("lesser general public license incorporates", "this version of the gnu lesser general public license incorporates the terms and conditions of version 3 of the gnu general public license", "clause"),
        ("lesser general public license", "gnu lesser general public license(?: lgpl)?(?: version)? v?3(?: 0)?(?: 29 june 2007)?", "heading"),
        ("lgpl 3 0", "lgpl 3 0(?: only| or later)?", "id"),
        ("lgplv3", "lgplv3", "id"),
    ),
    "agpl-3": (
        ("affero general public license", "(?:under (?:the )?(?:terms of )?(?:the )?)?gnu affero general public license(?: agpl)?(?: version 3)? " + FSF + "(?:either )?version 3(?: 0)?" + LATER, "notice"),
        ("network server software", "specifically designed to ensure cooperation with the community in the case of network server software", "clause"),
        ("affero general public license", "gnu affero general public license(?: agpl)?(?: version)? v?3(?: 0)?(?: 19 november 2007)?", "heading"),
        ("agpl 3 0", "agpl 3 0(?: only| or later)?", "id"),
        ("agplv3", "agplv3", "id"),
    ),
    "gfdl": (
        ("free documentation license", "copy distribute and or modify this document under the terms of the gnu free documentation license version 1 [123]", "notice"),
        ("functional and useful document", "the purpose of this license is to make a manual textbook or other functional and useful document free in the sense of freedom", "clause"),
        ("free documentation license", "gnu free documentation license(?: version)?(?: 1 [123])?", "heading"),
        ("gfdl 1", "gfdl 1 [123](?: only| or later)?", "id"),
    ),
    "mpl-1.1": (
        ("mozilla public license version 1 1", "subject to the mozilla public license version 1 1 the license you may not use this file except in compliance with the license", "notice"),
        ("mozilla public license", "mozilla public license(?: version)? v?1 [01]", "heading"),
        ("mpl 1 1", "mpl 1 1", "id"),
    ),
    "mpl-2": (
        ("mozilla public license", "this source code form is subject to the terms of the mozilla public license v(?:ersion)? 2 0", "notice"),
        ("a copy of the mpl was not distributed", "if a copy of the mpl was not distributed with this file you can obtain one at", "notice"),
        ("incompatible with secondary licenses", "this source code form is incompatible with secondary licenses as defined by the mozilla public license v 2 0", "clause"),
        ("mozilla public license", "mozilla public license(?: version| v)? ?v?2(?: 0)?", "heading"),
        ("mozilla org mpl 2 0", "mozilla org mpl 2 0", "id"),
        ("mpl 2 0", "mpl 2 0", "id"),
    ),
    "epl-1": (
        ("eclipse public license", "made available under the terms of the eclipse public license v(?:ersion)? ?1 0", "notice"),
        ("eclipse public license", "eclipse public license(?: version| v)? ?v?1(?: 0)?", "heading"),
        ("epl v10", "eclipse org legal epl v10", "id"),
        ("epl 1 0", "epl 1 0", "id"),
    ),
    "epl-2": (
        ("eclipse public license", "made available under the terms of the eclipse public license v(?:ersion)? ?2 0", "notice"),
        ("eclipse public license", "eclipse public license(?: version| v)? ?v?2(?: 0)?", "heading"),
        ("epl 2 0", "(?:eclipse org legal )?epl 2 0", "id"),
    ),
    "cddl": (
        ("common development and distribution license", "subject to the terms of the common development and distribution license", "notice"),
        ("common development and distribution license", "common development and distribution license(?: cddl)?(?: version)?(?: 1 [01])?", "heading"),
        ("cddl 1", "cddl 1 [01]", "id"),
    ),
    "cpl": (
        ("common public license", "the accompanying program is provided under the terms of this common public license", "clause"),
        ("common public license", "common public license(?: version| v)? ?v?1 0", "heading"),
        ("cpl 1 0", "cpl 1 0", "id"),
    ),
    "eupl": (
        ("european union public licen", "european union public licen[cs]e(?: eupl)?(?: version| v)?(?: ?v? ?1 [012])?", "heading"),
        ("eupl 1", "eupl 1 [012]", "id"),
        ("the eupl version 1", "licensed under the eupl version 1 [012]", "notice"),
    ),
    "osl-3": (
        ("open software license", "licensed under the open software license version 3 0", "notice"),
        ("open software license", "open software license(?: osl)?(?: version| v)? ?v? ?3 0", "heading"),
        ("osl 3 0", "osl 3 0", "id"),
    ),
    "afl-3": (
        ("academic free license", "licensed under the academic free license version 3 0", "notice"),
        ("academic free license", "academic free license(?: afl)?(?: version| v)? ?v? ?3 0", "heading"),
        ("afl 3 0", "afl 3 0", "id"),
    ),
    "artistic": (
        ("the copyright holder maintains some semblance", "the copyright holder maintains some semblance of artistic control over the development of the package", "clause"),
        ("artistic license", "(?:the )?artistic license(?: version)?(?: [12] 0)?", "heading"),
        ("artistic 2 0", "artistic 2 0", "id"),
    ),
    "perl": (
        ("same terms as perl itself", "under the same terms as perl itself", "notice"),
        ("same terms as the perl 5", "under the same terms as the perl 5 programming language system itself", "notice"),
    ),
    "cc0": (
        ("cc0 1 0 universal", "cc0 1 0 universal(?: cc0 1 0)?(?: public domain dedication)?", "heading"),
        ("waived all copyright and related", "waived all copyright and related or neighboring rights", "notice"),
        ("publicdomain zero 1 0", "creativecommons org publicdomain zero 1 0", "id"),
        ("cc0 1 0", "cc0 1 0", "id"),
        ("creative commons zero", "creative commons zero(?: v?1 0)?(?: universal)?", "heading"),
    ),
    "cc-by": (
        ("creative commons attribution", GIVEN + PORT, "notice"),
        ("creative commons attribution", "creative commons attribution(?: [1234] [05])?(?: international| unported| generic)", "heading"),
        ("licenses by", "creativecommons org licenses by [1234] [05]", "id"),
        ("cc by", "cc by [1234] [05]", "id"),
    ),
    "cc-by-sa": (
        ("creative commons attribution share", GIVEN + " share ?alike" + PORT, "notice"),
        ("creative commons attribution share", "creative commons attribution share ?alike(?: [1234] [05])?(?: international| unported| generic)?", "heading"),
        ("licenses by sa", "creativecommons org licenses by sa [1234] [05]", "id"),
        ("cc by sa", "cc by sa [1234] [05]", "id"),
    ),
    "cc-by-nd": (
        ("creative commons attribution no", GIVEN + " no ?deriv(?:ative)?s?(?: works)?" + PORT, "notice"),
        ("creative commons attribution no", "creative commons attribution no ?deriv(?:ative)?s?(?: works)?(?: [1234] [05])?(?: international| unported| generic)?", "heading"),
        ("licenses by nd", "creativecommons org licenses by nd [1234] [05]", "id"),
        ("cc by nd", "cc by nd [1234] [05]", "id"),
    ),
    "cc-by-nc": (
        ("creative commons attribution non", GIVEN + " non ?commercial" + PORT, "notice"),
        ("creative commons attribution non", "creative commons attribution non ?commercial(?: [1234] [05])?(?: international| unported| generic)?", "heading"),
        ("licenses by nc", "creativecommons org licenses by nc [1234] [05]", "id"),
        ("cc by nc", "cc by nc [1234] [05]", "id"),
    ),
    "cc-by-nc-sa": (
        ("creative commons attribution non", GIVEN + " non ?commercial share ?alike" + PORT, "notice"),
        ("creative commons attribution non", "creative commons attribution non ?commercial share ?alike(?: [1234] [05])?(?: international| unported| generic)?", "heading"),
        ("licenses by nc sa", "creativecommons org licenses by nc sa [1234] [05]", "id"),
        ("cc by nc sa", "cc by nc sa [1234] [05]", "id"),
    ),
    "cc-by-nc-nd": (
        ("creative commons attribution non", GIVEN + " non ?commercial no ?deriv(?:ative)?s?(?: works)?" + PORT, "notice"),
        ("creative commons attribution non", "creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?(?: [1234] [05])?(?: international| unported| generic)?", "heading"),
        ("licenses by nc nd", "creativecommons org licenses by nc nd [1234] [05]", "id"),
        ("cc by nc nd", "cc by nc nd [1234] [05]", "id"),
    ),
    "unlicense": (
        ("free and unencumbered software", "this is free and unencumbered software released into the public domain", "notice"),
        ("publish use compile sell", "anyone is free to copy modify publish use compile sell or distribute this software", "clause"),
        ("unlicense org", "unlicense org", "id"),
    ),
    "wtfpl": (
        ("what the fuck you want to public license", "do what the fuck you want to public license(?: version 2(?: december 2004)?)?", "heading"),
        ("wtfpl", "wtfpl", "id"),
    ),
    "zlib": (
        ("altered source versions must be plainly", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software", "clause"),
        ("origin of this software must not be misrepresented", "the origin of this software must not be misrepresented you must not claim that you wrote the original software", "clause"),
        ("zlib licen", "(?:the )?zlib licen[cs]e", "heading"),
    ),
    "boost": (
        ("any person or organization obtaining a copy", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license", "clause"),
        ("boost software license", "(?:distributed under the )?boost software license(?: version)? 1 0", "heading"),
        ("bsl 1 0", "bsl 1 0", "id"),
    ),
    "python": (
        ("python software foundation license", "python software foundation license(?: version)?(?: 2)?", "heading"),
        ("psf license agreement", "psf license agreement for python", "heading"),
        ("license agreement is between the python software foundation", "this license agreement is between the python software foundation psf and the individual or organization", "clause"),
    ),
    "php": (
        ("version 3 01 of the php license", "subject to version 3 01 of the php license", "notice"),
        ("php license", "the php license version 3 01", "heading"),
    ),
    "ofl": (
        ("open font license", "licensed under the sil open font license(?: version)? 1 [01]", "notice"),
        ("open font license", "sil open font license(?: version)?(?: 1 [01])?(?: 26 february 2007)?", "heading"),
        ("worldwide development of collaborative font projects", "the goals of the open font license ofl are to stimulate worldwide development of collaborative font projects", "clause"),
        ("ofl 1", "ofl 1 [01]", "id"),
    ),
    "odbl": (
        ("open database license", "(?:made )?available under the open database license", "notice"),
        ("open database license", "open database license(?: odbl)?(?: version| v)?(?: ?v? ?1 0)?", "heading"),
        ("opendatacommons org licenses odbl", "opendatacommons org licenses odbl(?: 1 0)?", "id"),
    ),
    "ms-pl": (
        ("microsoft public license", "microsoft public license(?: ms pl)?", "heading"),
        ("ms pl", "ms pl", "id"),
    ),
    "ms-rl": (
        ("microsoft reciprocal license", "microsoft reciprocal license(?: ms rl)?", "heading"),
        ("ms rl", "ms rl", "id"),
    ),
    "ncsa": (
        ("deal with the software without restriction", "to deal with the software without restriction", "clause"),
        ("ncsa open source license", "university of illinois ncsa open source license", "heading"),
    ),
    "postgresql": (
        ("without a written agreement is hereby granted", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted", "clause"),
        ("postgresql license", "postgresql license", "heading"),
    ),
    "w3c": (
        ("w3c software", "w3c software(?: and document)? notice and license", "heading"),
        ("this work is being provided by the copyright holders", "this work is being provided by the copyright holders under the following license", "clause"),
    ),
    "openssl": (
        ("developed by the openssl project", "this product includes software developed by the openssl project for use in the openssl toolkit", "clause"),
        ("openssl license", "openssl license", "heading"),
    ),
    "ecl-2": (
        ("educational community license", "licensed under the educational community license version 2 0", "notice"),
        ("ecl 2 0", "ecl 2 0", "id"),
    ),
    "upl": (
        ("universal permissive license", "universal permissive license(?: upl)?(?: version| v)? ?v? ?1 0", "heading"),
        ("upl 1 0", "upl 1 0", "id"),
    ),
    "busl": (
        ("business source license", "use of this software is governed by the business source license", "notice"),
        ("business source license", "business source license(?: version)? 1 1", "heading"),
        ("busl 1 1", "busl 1 1", "id"),
    ),
    "sspl": (
        ("server side public license", "under the terms of the server side public license version 1", "notice"),
        ("server side public license", "server side public license(?: version| v)? ?v?1?", "heading"),
        ("sspl 1 0", "sspl 1 0", "id"),
    ),
    "cecill": (
        ("cecill free software license", "cecill free software license agreement", "heading"),
        ("governed by the cecill", "governed by the cecill(?: b| c)? license under french law", "notice"),
    ),
    "public-domain": (
        ("in the public domain", "(?:is|are) (?:hereby )?(?:placed )?in the public domain", "notice"),
        ("into the public domain", "(?:hereby )?(?:released|placed|dedicated) into the public domain", "notice"),
        ("dedicated to the public domain", "dedicated to the public domain", "notice"),
    ),
}
