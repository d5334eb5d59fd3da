"""Signature rules of the license scan, in order of priority.

A rule reads the normalised words of a text, joined by single spaces. Its keyword
stands in all that its pattern matches, and so does one of GATES: a name's
pattern whose alternatives share no keyword is several rules. So neither loses a
match; they only spare texts the patterns.

Names, single texts and notices are written by hand, about 260 in all; names also
stand in the wordings of FORMS.
"""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    rule_id: int
    label: str
    priority: int
    keyword: str
    pattern: str
    confidence: float


#: Phrases whose consecutive words are the base detections, and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: (label, SPDX name as words, keyword, pattern of the license's name)
FAMILIES = (
    ("mit", "mit", " mit ", "mit"),
    ("mit-0", "mit 0", " mit ", "mit (?:no attribution|0)"),
    ("apache-2", "apache 2 0", "apache", "apache(?: software)?(?: licen[sc]e)?(?: version)? (?:v2|2)(?: 0)?"),
    ("apache-1.1", "apache 1 1", "apache", "apache(?: software)?(?: licen[sc]e)?(?: version)? 1 1"),
    ("bsd-2-clause", "bsd 2 clause", "bsd", "(?:simplified bsd|bsd 2 clause|2 clause bsd|freebsd)"),
    ("bsd-3-clause", "bsd 3 clause", "bsd", "(?:(?:new|revised|modified) bsd|bsd 3 clause|3 clause bsd)"),
    ("bsd-4-clause", "bsd 4 clause", "bsd", "(?:original bsd|bsd 4 clause|4 clause bsd)"),
    ("0bsd", "0bsd", "bsd", "(?:0bsd|zero clause bsd)"),
    ("gpl-2", "gpl 2 0", "gpl", "(?:gnu )?gpl(?: version)? (?:v2|2)(?: 0)?"),
    ("gpl-3", "gpl 3 0", "gpl", "(?:gnu )?gpl(?: version)? (?:v3|3)(?: 0)?"),
    ("gpl-2", "gpl 2 0 only", "general public", "gnu general public licen[sc]e(?: as published by the free software foundation)?(?: either)? version 2"),
    ("gpl-3", "gpl 3 0 only", "general public", "gnu general public licen[sc]e(?: as published by the free software foundation)?(?: either)? version 3"),
    ("lgpl-2.1", "lgpl 2 1", "lgpl", "(?:gnu )?lgpl(?: version)? (?:v2 1|2 1)"),
    ("lgpl-3", "lgpl 3 0", "lgpl", "(?:gnu )?lgpl(?: version)? (?:v3|3)(?: 0)?"),
    ("lgpl-2.1", "lgpl 2 1 only", "lesser", "gnu lesser general public licen[sc]e(?: version)? 2 1"),
    ("lgpl-3", "lgpl 3 0 only", "lesser", "gnu lesser general public licen[sc]e(?: version)? 3"),
    ("agpl-3", "agpl 3 0", "agpl", "(?:gnu )?agpl(?: version)? (?:v3|3)(?: 0)?"),
    ("agpl-3", "agpl 3 0 only", "affero", "gnu affero general public licen[sc]e(?: version 3)?"),
    ("mpl-1.1", "mpl 1 1", "mozilla", "mozilla public licen[sc]e(?: version)?(?: v)? 1 1"),
    ("mpl-2", "mpl 2 0", "mozilla", "mozilla public licen[sc]e(?: version)?(?: v)? (?:v2|2)(?: 0)?"),
    ("epl-1", "epl 1 0", "eclipse", "eclipse public licen[sc]e(?: version)?(?: v)? 1(?: 0)?"),
    ("epl-2", "epl 2 0", "eclipse", "eclipse public licen[sc]e(?: version)?(?: v)? 2(?: 0)?"),
    ("cddl-1", "cddl 1 0", "common development", "common development and distribution licen[sc]e"),
    ("isc", "isc", " isc ", "isc"),
    ("zlib", "zlib", "zlib", "zlib(?: libpng)?"),
    ("unlicense", "unlicense", "unlicense", "(?:the )?unlicense"),
    ("wtfpl", "wtfpl", "wtfpl", "wtfpl"),
    ("bsl-1", "bsl 1 0", "boost", "boost software licen[sc]e(?: version)?(?: 1(?: 0)?)?"),
    ("python-2", "python 2 0", "python", "python(?: software foundation)?"),
    ("artistic-1", "artistic 1 0", "artistic", "artistic licen[sc]e(?: version)? 1(?: 0)?"),
    ("artistic-2", "artistic 2 0", "artistic", "artistic licen[sc]e(?: version)? 2(?: 0)?"),
    ("eupl-1.2", "eupl 1 2", "european union", "european union public licen[sc]e"),
    ("ofl-1.1", "ofl 1 1", "open font", "sil open font licen[sc]e"),
    ("ms-pl", "ms pl", "microsoft", "microsoft public licen[sc]e"),
    ("ncsa", "ncsa", "ncsa", "(?:university of illinois )?ncsa"),
    ("postgresql", "postgresql", "postgresql", "postgresql"),
    ("odbl-1", "odbl 1 0", "open database", "open database licen[sc]e"),
    ("odc-by-1", "odc by 1 0", "open data commons", "open data commons attribution licen[sc]e"),
    ("cc0-1", "cc0 1 0", "cc0", "cc0(?: 1 0)?(?: universal)?"),
    ("cc-by", "cc by", " cc ", "cc (?:by|attribution)(?! (?:nc|sa|nd|noncommercial|sharealike|noderivatives|non|share|no) )"),
    ("cc-by", "cc by 4 0", "creative commons", "creative commons (?:by|attribution)(?! (?:nc|sa|nd|noncommercial|sharealike|noderivatives|non|share|no) )"),
    ("cc-by-sa", "cc by sa", " cc ", "cc by sa"),
    ("cc-by-nd", "cc by nd", " cc ", "cc by nd"),
    ("cc-by-nc", "cc by nc", " cc ", "cc by nc(?! (?:sa|nd) )"),
    ("cc-by-nc-sa", "cc by nc sa", " cc ", "cc by nc sa"),
    ("cc-by-nc-nd", "cc by nc nd", " cc ", "cc by nc nd"),
    ("cc-by-sa", "cc by sa 4 0", "creative", "creative commons attribution share ?alike"),
    ("cc-by-nc", "cc by nc 4 0", "creative", "creative commons attribution non ?commercial(?! (?:share|no) )"),
    ("gfdl", "gfdl 1 3", "free documentation", "gnu free documentation licen[sc]e"),
)

#: (priority, confidence, pattern) around a name; they differ in how sure the wording is.
#: FORM_GATES has the words of which each form holds one.
FORMS = (
    (1, 1.0, "spdx licen[sc]e identifier {spdx}"),
    (2, 0.95, "(?:is |are )?(?:dual )?licen[sc]ed (?:to you )?(?:under|by|with) (?:the )?(?:terms of )?(?:the )?{name}(?: licen[sc]e)?"),
    (2, 0.95, "(?:released|distributed|available|published|provided|covered|redistributed) (?:under|by) (?:the )?(?:terms of )?(?:the )?{name}(?: licen[sc]e)?"),
    (3, 0.9, "(?:under|subject to|governed by|see) (?:the )?(?:terms (?:and conditions )?of )?(?:the )?{name} licen[sc]e"),
    (5, 0.7, "(?:the )?{name} licen[sc]e"),
)

FORM_GATES = ("spdx", "licen", *(f"{verb} {by} " for verb in ("released", "distributed", "available", "published", "provided", "covered") for by in ("under", "by")))

#: (label, priority, keyword, pattern, confidence)
SINGLE = (
    ("mit", 1, "hereby granted", "permission is hereby granted free of charge to any person obtaining a copy of this software", 1.0),
    ("isc", 1, "permission to use", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", 1.0),
    ("bsd", 1, "redistribution and use", "redistribution and use in source and binary forms with or without modification are permitted", 0.9),
    ("bsd-3-clause", 2, "neither the name", "neither the name of (?:the )?[^ ]+(?: [^ ]+){0,6} nor the names of its contributors", 0.9),
    ("zlib", 1, "provided as is", "this software is provided as is without any express or implied warranty in no event will the authors be held liable", 0.9),
    ("unlicense", 1, "unencumbered", "this is free and unencumbered software released into the public domain", 1.0),
    ("public-domain", 4, "public domain", "(?:released|dedicated|placed) (?:in|into|to) the public domain", 0.8),
    ("public-domain", 6, "public domain", "(?:is|are) in the public domain", 0.6),
    ("gpl", 4, "general public", "gnu general public licen[sc]e(?: or any later version)?", 0.8),
    ("lgpl", 4, "general public", "gnu (?:lesser|library) general public licen[sc]e", 0.8),
    ("gpl", 2, "free software", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public licen[sc]e", 0.95),
    ("lgpl", 2, "free software", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public licen[sc]e", 0.95),
    ("apache-2", 1, "apache", "you may not use this file except in compliance with the licen[sc]e you may obtain a copy of the licen[sc]e at https? www apache org licen[sc]es licen[sc]e 2 0", 1.0),
    ("apache-2", 2, "apache", "apache org licen[sc]es licen[sc]e 2 0", 0.95),
    ("mit", 2, "opensource", "opensource org licen[sc]es mit(?: license php)?", 0.95),
    ("bsd-3-clause", 2, "opensource", "opensource org licen[sc]es bsd 3 clause", 0.95),
    ("cc-by", 2, "creativecommons", "creativecommons org licen[sc]es by [0-9]", 0.95),
    ("cc-by-sa", 2, "creativecommons", "creativecommons org licen[sc]es by sa [0-9]", 0.95),
    ("cc-by-nc", 2, "creativecommons", "creativecommons org licen[sc]es by nc [0-9]", 0.95),
    ("cc-by-nd", 2, "creativecommons", "creativecommons org licen[sc]es by nd [0-9]", 0.95),
    ("cc-by-nc-sa", 2, "creativecommons", "creativecommons org licen[sc]es by nc sa [0-9]", 0.95),
    ("cc-by-nc-nd", 2, "creativecommons", "creativecommons org licen[sc]es by nc nd [0-9]", 0.95),
    ("cc0-1", 2, "creativecommons", "creativecommons org publicdomain zero 1 0", 0.95),
    ("proprietary", 5, "all rights reserved", "copyright(?: c)?(?: [0-9]{4}){0,3}(?: [^ ]+){0,6} all rights reserved", 0.6),
    ("proprietary", 4, "proprietary", "(?:this|the) [^ ]+ is proprietary (?:and confidential|software)", 0.7),
)

#: Sentences, titles and clauses of single licenses; each holds a gate word of the forms or of SINGLE.
NOTICES = (
    # permissive
    ("mit", 1, "without restriction", "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicen[sc]e and or sell copies", 1.0),
    ("mit", 2, "mit", "(?:the )?mit expat licen[sc]e", 0.9),
    ("mit", 2, "mit", "mit x11 licen[sc]e", 0.9),
    ("mit", 3, "mit", "dual mit (?:and )?(?:apache|gpl) licen[sc]e", 0.8),
    ("mit", 3, "mit", "mit style licen[sc]e", 0.7),
    ("mit", 3, "mit", "licen[sc]e mit", 0.8),
    ("mit-0", 1, "no attribution", "mit no attribution licen[sc]e", 0.95),
    ("x11", 2, "x consortium", "licen[sc]e of the x consortium", 0.8),
    ("x11", 2, "x11", "x11 licen[sc]e", 0.85),
    ("expat", 2, "expat", "expat licen[sc]e", 0.85),
    ("isc", 2, "internet systems", "internet systems consortium licen[sc]e", 0.95),
    ("isc", 2, "isc", "isc style licen[sc]e", 0.7),
    ("curl", 2, "curl", "curl licen[sc]e", 0.9),
    ("zlib", 2, "zlib", "zlib style licen[sc]e", 0.8),
    ("zlib", 3, "misrepresented", "origin of this software must not be misrepresented you must not claim that you wrote the original software .{0,80}licen[sc]e", 0.9),
    ("libpng", 2, "libpng", "libpng licen[sc]e(?: version)?(?: 2(?: 0)?)?", 0.9),
    ("libtiff", 2, "libtiff", "libtiff licen[sc]e", 0.9),
    ("ijg", 2, "jpeg", "independent jpeg group licen[sc]e", 0.9),
    ("bzip2", 2, "bzip2", "bzip2 licen[sc]e", 0.9),
    ("info-zip", 2, "info zip", "info zip licen[sc]e", 0.9),
    ("openssl", 2, "openssl", "(?:the )?openssl licen[sc]e", 0.9),
    ("ssleay", 2, "ssleay", "(?:the )?(?:original )?ssleay licen[sc]e", 0.9),
    ("beerware", 2, "beer", "(?:the )?beer ?ware licen[sc]e(?: revision)?(?: 42)?", 0.95),
    ("jquery", 3, "jquery", "jquery (?:mit )?licen[sc]e", 0.7),
    ("w3c", 2, "w3c", "w3c software (?:notice )?(?:and )?(?:document )?licen[sc]e", 0.95),
    ("afl-3", 2, "academic free", "academic free licen[sc]e(?: version)?(?: v)? 3(?: 0)?", 0.95),
    ("afl-2.1", 2, "academic free", "academic free licen[sc]e(?: version)?(?: v)? 2 1", 0.95),
    ("ecl-2", 2, "educational community", "educational community licen[sc]e(?: version)? 2(?: 0)?", 0.95),
    ("efl-2", 2, "eiffel forum", "eiffel forum licen[sc]e(?: version)? 2", 0.95),
    ("fair", 3, "fair", "(?:the )?fair licen[sc]e", 0.7),
    ("ftl", 2, "freetype", "(?:the )?freetype (?:project )?licen[sc]e", 0.95),
    ("hpnd", 2, "historical permission", "historical permission notice and disclaimer licen[sc]e", 0.95),
    ("hpnd", 3, "permission to use", "permission to use copy modify and distribute this software and its documentation for any purpose and without fee is hereby granted", 0.9),
    ("icu", 2, "icu", "icu licen[sc]e", 0.85),
    ("unicode-3", 2, "unicode", "unicode licen[sc]e(?: agreement)?(?: v3)?", 0.9),
    ("json", 2, "json", "(?:the )?json licen[sc]e", 0.9),
    ("json", 2, "good not evil", "shall be used for good not evil .{0,40}licen[sc]e", 0.9),
    ("mulan-psl-2", 2, "mulan", "mulan (?:psl|permissive software)(?: v)?(?: ?2)? licen[sc]e", 0.9),
    ("ms-rl", 2, "reciprocal", "microsoft reciprocal licen[sc]e", 0.95),
    ("ms-limited", 2, "microsoft", "microsoft limited (?:public|reciprocal) licen[sc]e", 0.95),
    ("ncsa", 2, "illinois", "university of illinois ncsa open source licen[sc]e", 0.95),
    ("ntp", 2, "ntp", "ntp licen[sc]e", 0.85),
    ("php-3", 2, "php", "php licen[sc]e(?: version)?(?: v)?(?: 3(?: 0[01])?)?", 0.9),
    ("pil", 2, "imaging library", "python imaging library (?:software )?licen[sc]e", 0.9),
    ("python-2", 2, "psf", "psf licen[sc]e(?: agreement)?(?: for python)?", 0.9),
    ("python-2", 2, "beopen", "beopen com licen[sc]e agreement for python", 0.9),
    ("python-2", 2, "cnri", "cnri (?:open source )?licen[sc]e agreement(?: for python)?", 0.9),
    ("ruby", 2, "ruby", "(?:the )?ruby licen[sc]e", 0.9),
    ("ruby", 3, "ruby", "same licen[sc]e as ruby", 0.8),
    ("perl", 2, "perl", "same (?:licen[sc]e|terms and licen[sc]e) as perl(?: itself)?", 0.9),
    ("tcl", 2, "tcl", "tcl tk licen[sc]e", 0.9),
    ("vim", 2, "vim", "vim licen[sc]e", 0.9),
    ("zpl-2.1", 2, "zope", "zope public licen[sc]e(?: version)? 2 1", 0.95),
    ("zpl-2", 3, "zope", "zope public licen[sc]e", 0.8),
    ("upl-1", 2, "universal permissive", "universal permissive licen[sc]e(?: version)?(?: v)?(?: 1(?: 0)?)?", 0.95),
    ("bluoak-1", 2, "blue oak", "blue oak model licen[sc]e(?: 1 0 0)?", 0.95),
    ("artistic-1", 3, "clarified", "clarified artistic licen[sc]e", 0.9),
    ("artistic-2", 3, "artistic", "the artistic licen[sc]e 2 0", 0.9),
    ("naumen", 2, "naumen", "naumen public licen[sc]e", 0.95),
    ("intel", 2, "intel", "intel open source licen[sc]e", 0.9),
    ("xfree86-1.1", 2, "xfree86", "xfree86 licen[sc]e(?: 1 1)?", 0.9),
    # bsd and apache
    ("bsd-2-clause", 1, "binary form must reproduce", "redistributions in binary form must reproduce the above copyright notice this list of conditions .{0,120}licen[sc]e", 0.85),
    ("bsd-2-clause", 2, "bsd", "(?:simplified|two clause) bsd licen[sc]e", 0.95),
    ("bsd-2-clause", 2, "freebsd", "freebsd (?:documentation )?licen[sc]e", 0.9),
    ("bsd-3-clause", 2, "bsd", "three clause bsd licen[sc]e", 0.95),
    ("bsd-3-clause", 2, "endorse", "names of its contributors may be used to endorse or promote products .{0,120}licen[sc]e", 0.85),
    ("bsd-3-clause-clear", 1, "clear bsd", "(?:the )?clear bsd licen[sc]e", 0.95),
    ("bsd-4-clause", 2, "bsd", "four clause bsd licen[sc]e", 0.95),
    ("bsd-4-clause", 2, "advertising", "all advertising materials mentioning features .{0,160}licen[sc]e", 0.8),
    ("bsd-patent", 1, "patent", "bsd (?:2 clause )?plus patent licen[sc]e", 0.95),
    ("bsd", 4, "bsd", "bsd style licen[sc]e", 0.7),
    ("bsd", 4, "bsd", "bsd type licen[sc]e", 0.6),
    ("bsd", 4, "berkeley", "berkeley (?:software distribution )?licen[sc]e", 0.7),
    ("0bsd", 1, "bsd", "bsd zero clause licen[sc]e", 0.95),
    ("apache-1", 2, "apache", "apache (?:software )?licen[sc]e(?: version)? 1(?: 0)?(?! [0-9] )", 0.9),
    ("apache-1.1", 2, "apache", "apache software foundation licen[sc]e 1 1", 0.95),
    ("apache-2", 2, "apache", "apache licen[sc]e v2(?: 0)?", 0.95),
    ("apache-2", 2, "apache", "asl 2(?: 0)? apache", 0.85),
    ("apache-2", 2, "apache", "apache 2 0 licen[sc]e", 0.95),
    ("apache-2", 2, "apache", "licen[sc]ed to the apache software foundation asf under one or more contributor licen[sc]e agreements", 1.0),
    ("apache-2", 2, "without warranties", "without warranties or conditions of any kind either express or implied see the licen[sc]e for the specific language governing permissions", 0.9),
    ("apache-2", 4, "apache", "apache style licen[sc]e", 0.6),
    ("apache-2-llvm", 1, "llvm", "apache licen[sc]e v2 0 with llvm exceptions", 1.0),
    # copyleft
    ("gpl-1", 2, "general public", "gnu general public licen[sc]e(?: version)? (?:v1|1)(?: 0)?", 0.95),
    ("gpl-2", 1, "general public", "gnu general public licen[sc]e v2(?: 0)?(?: only| or later)?", 0.95),
    ("gpl-3", 1, "general public", "gnu general public licen[sc]e v3(?: 0)?(?: only| or later)?", 0.95),
    ("gpl-2", 2, "gpl", "gplv2(?: or later)? licen[sc]e", 0.95),
    ("gpl-3", 2, "gpl", "gplv3(?: or later)? licen[sc]e", 0.95),
    ("gpl-2", 2, "version 2", "either version 2 of the licen[sc]e or at your option any later version", 0.9),
    ("gpl-3", 2, "version 3", "either version 3 of the licen[sc]e or at your option any later version", 0.9),
    ("gpl", 3, "copyleft", "copyleft licen[sc]e", 0.5),
    ("gpl", 2, "received a copy", "you should have received a copy of the gnu general public licen[sc]e along with this (?:program|library|software|file)", 0.95),
    ("lgpl", 2, "received a copy", "you should have received a copy of the gnu (?:lesser|library) general public licen[sc]e along with this (?:program|library|software|file)", 0.95),
    ("agpl-3", 2, "received a copy", "you should have received a copy of the gnu affero general public licen[sc]e along with this (?:program|library|software|file)", 0.95),
    ("gpl", 2, "particular purpose", "fitness for a particular purpose see the gnu general public licen[sc]e for more details", 0.9),
    ("lgpl", 2, "particular purpose", "fitness for a particular purpose see the gnu lesser general public licen[sc]e for more details", 0.9),
    ("agpl-3", 2, "particular purpose", "fitness for a particular purpose see the gnu affero general public licen[sc]e for more details", 0.9),
    ("lgpl-2", 2, "library general", "gnu library general public licen[sc]e(?: version)? 2(?: 0)?(?! 1 )", 0.95),
    ("lgpl-2.1", 2, "lgpl", "lgplv2 1(?: or later)? licen[sc]e", 0.95),
    ("lgpl-3", 2, "lgpl", "lgplv3(?: or later)? licen[sc]e", 0.95),
    ("agpl-1", 2, "affero", "affero general public licen[sc]e(?: version)? 1(?: 0)?", 0.95),
    ("agpl-3", 2, "affero", "affero general public licen[sc]e(?: version)? 3(?: 0)?", 0.95),
    ("agpl-3", 2, "agpl", "agplv3(?: or later)? licen[sc]e", 0.95),
    ("gpl-2-classpath", 1, "classpath", "gpl(?:v2)? with (?:the )?classpath exception licen[sc]e", 0.95),
    ("gpl-linking", 2, "linking exception", "linking exception to the licen[sc]e", 0.7),
    ("gpl-runtime", 2, "runtime library exception", "gcc runtime library exception .{0,60}licen[sc]e", 0.85),
    ("gfdl", 2, "free documentation", "gnu free documentation licen[sc]e(?: version)? 1 [123]", 0.95),
    ("gfdl", 3, "gfdl", "gfdl licen[sc]e", 0.9),
    ("mpl-1", 2, "mozilla", "mozilla public licen[sc]e(?: version)? 1 0", 0.95),
    ("mpl-1.1", 2, "mozilla", "subject to the mozilla public licen[sc]e version 1 1", 0.95),
    ("mpl-2", 1, "mozilla", "this source code form is subject to the terms of the mozilla public licen[sc]e v 2 0", 1.0),
    ("mpl-2", 2, "mozilla", "mplv2 mozilla (?:public )?licen[sc]e", 0.9),
    ("mpl", 4, "mozilla", "mozilla public licen[sc]e", 0.7),
    ("npl-1.1", 2, "netscape", "netscape public licen[sc]e(?: version)?(?: 1 [01])?", 0.95),
    ("spl-1", 2, "sun", "sun public licen[sc]e(?: version)?(?: 1 0)?", 0.95),
    ("cddl-1", 2, "cddl", "cddl (?:version )?1 0 licen[sc]e", 0.95),
    ("cddl-1.1", 1, "common development", "common development and distribution licen[sc]e(?: version)? 1 1", 0.95),
    ("epl-2", 1, "eclipse", "this program and the accompanying materials are made available under the terms of the eclipse public licen[sc]e 2 0", 1.0),
    ("epl-1", 1, "eclipse", "this program and the accompanying materials are made available under the terms of the eclipse public licen[sc]e v1 0", 1.0),
    ("edl-1", 2, "eclipse", "eclipse distribution licen[sc]e(?: v)?(?: 1 0)?", 0.95),
    ("cpl-1", 2, "common public", "common public licen[sc]e(?: version)?(?: v)?(?: 1 0)?", 0.95),
    ("ipl-1", 2, "ibm", "ibm public licen[sc]e(?: version)?(?: 1 0)?", 0.95),
    ("apsl-2", 2, "apple public", "apple public source licen[sc]e(?: version)?(?: 2 0)?", 0.95),
    ("osl-3", 2, "open software licen", "open software licen[sc]e(?: version)?(?: v)? 3(?: 0)?", 0.95),
    ("osl-2.1", 2, "open software licen", "open software licen[sc]e(?: version)?(?: v)? 2 1", 0.95),
    ("eupl-1.1", 2, "european union", "european union public licen[sc]e(?: version)?(?: v)? ?1 1", 0.95),
    ("eupl-1.2", 2, "eupl", "eupl (?:v ?)?1 2 licen[sc]e", 0.95),
    ("cecill-2.1", 2, "cecill", "cecill (?:free software )?licen[sc]e(?: agreement)?(?: version)?(?: 2 1)?", 0.9),
    ("cecill-b", 2, "cecill", "cecill b (?:free software )?licen[sc]e", 0.95),
    ("cecill-c", 2, "cecill", "cecill c (?:free software )?licen[sc]e", 0.95),
    ("sleepycat", 2, "sleepycat", "sleepycat (?:public )?licen[sc]e", 0.95),
    ("qpl-1", 2, "q public", "q public licen[sc]e(?: version)?(?: 1 0)?", 0.95),
    ("lppl-1.3c", 2, "latex", "latex project public licen[sc]e(?: version)? 1 3c?", 0.95),
    ("lppl", 3, "latex", "latex project public licen[sc]e", 0.85),
    ("ofl-1.1", 1, "open font", "this font software is licen[sc]ed under the sil open font licen[sc]e version 1 1", 1.0),
    ("ofl-1.1", 2, "ofl", "ofl 1 1 licen[sc]e", 0.9),
    ("ms-pl", 2, "ms pl", "ms pl licen[sc]e", 0.9),
    ("cpal-1", 2, "common public attribution", "common public attribution licen[sc]e(?: version)?(?: 1 0)?", 0.95),
    ("rpl-1.5", 2, "reciprocal public", "reciprocal public licen[sc]e(?: version)?(?: 1 5)?", 0.95),
    ("nasa-1.3", 2, "nasa", "nasa open source (?:licen[sc]e )?agreement(?: version)? 1 3 licen[sc]e", 0.9),
    ("nosl-3", 2, "netizen", "netizen open source licen[sc]e", 0.95),
    ("erlpl-1.1", 2, "erlang", "erlang public licen[sc]e(?: version)?(?: 1 1)?", 0.95),
    ("watcom-1", 2, "watcom", "sybase open watcom public licen[sc]e", 0.95),
    ("parity-7", 2, "parity", "parity public licen[sc]e(?: 7(?: 0 0)?)?", 0.95),
    # source available and non-commercial
    ("sspl-1", 1, "server side public", "server side public licen[sc]e(?: version)?(?: v)?(?: ?1)?", 1.0),
    ("elastic-2", 1, "elastic", "elastic licen[sc]e(?: version)?(?: v)?(?: ?2(?: 0)?)?", 0.95),
    ("busl-1.1", 1, "business source", "business source licen[sc]e(?: version)?(?: 1 1)?", 1.0),
    ("commons-clause", 1, "commons clause", "commons clause licen[sc]e condition(?: v1 0)?", 1.0),
    ("polyform-nc-1", 1, "polyform", "polyform noncommercial licen[sc]e(?: 1 0 0)?", 1.0),
    ("polyform-sb-1", 1, "polyform", "polyform small business licen[sc]e(?: 1 0 0)?", 1.0),
    ("polyform-strict-1", 1, "polyform", "polyform strict licen[sc]e(?: 1 0 0)?", 1.0),
    ("prosperity-3", 1, "prosperity", "prosperity public licen[sc]e(?: 3 0 0)?", 1.0),
    ("confluent-1", 1, "confluent", "confluent community licen[sc]e(?: version)?(?: 1 0)?", 1.0),
    ("redis-sal", 1, "redis", "redis source available licen[sc]e(?: agreement)?", 1.0),
    ("timescale", 1, "timescale", "timescale licen[sc]e(?: agreement)?", 0.95),
    ("openrail", 1, "rail", "(?:creativeml |bigscience )?open ?rail(?: m)? licen[sc]e", 0.95),
    ("aladdin", 2, "aladdin", "aladdin free public licen[sc]e", 0.95),
    ("research-only", 4, "research", "(?:for )?(?:academic )?research (?:use )?only licen[sc]e", 0.7),
    ("non-commercial", 4, "commercial", "non ?commercial (?:use )?licen[sc]e", 0.6),
    ("evaluation", 4, "evaluation", "evaluation (?:use )?licen[sc]e(?: agreement)?", 0.6),
    ("commercial", 4, "commercial", "(?:a )?commercial licen[sc]e(?: agreement)?", 0.5),
    ("eula", 4, "end user", "end user licen[sc]e agreement", 0.7),
    ("proprietary", 4, "proprietary", "proprietary licen[sc]e", 0.7),
    ("unlicensed", 4, "unlicensed", "(?:is|are) unlicensed", 0.5),
    # works and data
    ("cc-by", 2, "creative commons", "creative commons attribution (?:1|2|3|4) (?:0|5) (?:international|unported|generic|intergovernmental) licen[sc]e", 0.95),
    ("cc-by-sa", 1, "creative commons", "creative commons attribution share ?alike (?:1|2|3|4) (?:0|5)(?: international| unported| generic)? licen[sc]e", 1.0),
    ("cc-by-nd", 1, "creative commons", "creative commons attribution no ?deriv(?:atives|s) (?:1|2|3|4) (?:0|5)(?: international| unported| generic)? licen[sc]e", 1.0),
    ("cc-by-nc-sa", 1, "creative commons", "creative commons attribution non ?commercial share ?alike (?:1|2|3|4) (?:0|5)(?: international| unported| generic)? licen[sc]e", 1.0),
    ("cc-by-nc-nd", 1, "creative commons", "creative commons attribution non ?commercial no ?deriv(?:atives|s) (?:1|2|3|4) (?:0|5)(?: international| unported| generic)? licen[sc]e", 1.0),
    ("cc0-1", 1, "cc0", "to the extent possible under law .{0,80}cc0 licen[sc]e", 0.9),
    ("cc0-1", 2, "cc0", "cc0 public domain dedication", 0.95),
    ("cc-pdm", 2, "public domain mark", "public domain mark(?: 1 0)?", 0.9),
    ("odbl-1", 1, "open database", "odc open database licen[sc]e(?: v1 0)?", 1.0),
    ("pddl-1", 1, "public domain dedication", "(?:odc )?public domain dedication and licen[sc]e(?: v1 0)?", 1.0),
    ("odc-by-1", 2, "odc by", "odc by licen[sc]e", 0.95),
    ("cdla-permissive", 1, "community data", "community data licen[sc]e agreement permissive(?: version)?(?: [12] 0)?", 1.0),
    ("cdla-sharing", 1, "community data", "community data licen[sc]e agreement sharing(?: version)?(?: 1 0)?", 1.0),
    ("ogl-uk-3", 1, "open government", "open government licen[sc]e(?: version)?(?: v)?(?: ?3(?: 0)?)?", 0.95),
    ("dl-de-by-2", 1, "datenlizenz", "datenlizenz deutschland (?:licen[sc]e )?namensnennung .{0,40}licen[sc]e", 0.9),
    ("etalab-2", 1, "etalab", "(?:etalab )?(?:licence ouverte|open licen[sc]e) etalab(?: 2 0)?", 0.95),
    ("free-art-1.3", 2, "free art", "free art licen[sc]e(?: 1 3)?", 0.95),
    ("opl-1", 2, "open publication", "open publication licen[sc]e(?: v)?(?: ?1 0)?", 0.95),
    ("wordnet", 2, "wordnet", "wordnet (?:3 0 )?licen[sc]e", 0.9),
    ("ubuntu-font-1", 2, "ubuntu font", "ubuntu font licen[sc]e(?: 1 0)?", 0.95),
    ("bitstream-vera", 2, "bitstream vera", "bitstream vera (?:fonts )?licen[sc]e", 0.95),
    ("public-domain", 3, "public domain", "waives all (?:copyright )?rights .{0,60}public domain", 0.7),
    ("public-domain", 3, "public domain", "no copyright .{0,20}public domain", 0.6),
)

#: Words of which each rule's matches hold one: those of the forms and of SINGLE; all NOTICES hold one of them.
GATES = tuple(dict.fromkeys((*FORM_GATES, *(keyword for _, _, keyword, _, _ in SINGLE))))


def rules() -> list[Rule]:
    """All rules; the identifier is the place in this order and breaks ties of equal priority."""
    out: list[tuple] = []
    for label, spdx, keyword, name in FAMILIES:
        out += [(label, p, "spdx" if "{spdx}" in form else keyword, form.format(spdx=spdx, name=name), c) for p, c, form in FORMS]
    out += SINGLE
    out += NOTICES
    return [Rule(i, *x) for i, x in enumerate(out)]
