"""Signature rules for licences.

A rule is a regular expression over a text's words, in lower case with one space between
them, and has a label, a priority, a weight and the words that have to be there for it to be tried.
Notices and names in one word are written out one by one; references are made from the families below, one
rule for each way of naming a licence.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cache


@dataclass(frozen=True)
class Rule:
    name: str
    label: str
    pattern: re.Pattern
    keywords: tuple[str, ...]
    priority: int
    weight: float
    base: bool = False


#: The phrases that are always looked for, with their labels.
BASE_PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

#: A label, the words that name the family, and its versions.
FAMILIES = (
    ("gpl", "gnu general public", ("1", "2", "3")),
    ("gpl", "gpl", ("1", "2", "3")),
    ("lgpl", "gnu lesser general public", ("2 1", "3")),
    ("lgpl", "lgpl", ("2 1", "3")),
    ("agpl", "gnu affero general public", ("3",)),
    ("agpl", "agpl", ("3",)),
    ("gfdl", "gnu free documentation", ("1 1", "1 2", "1 3")),
    ("apache", "apache", ("1 0", "1 1", "2 0")),
    ("mit", "mit", ()),
    ("mit", "expat", ()),
    ("bsd", "bsd", ("2 clause", "3 clause", "4 clause")),
    ("isc", "isc", ()),
    ("mpl", "mozilla public", ("1 0", "1 1", "2 0")),
    ("mpl", "mpl", ("1 0", "1 1", "2 0")),
    ("epl", "eclipse public", ("1 0", "2 0")),
    ("cddl", "common development and distribution", ("1 0", "1 1")),
    ("eupl", "european union public", ("1 1", "1 2")),
    ("artistic", "artistic", ("1 0", "2 0")),
    ("boost", "boost software", ("1 0",)),
    ("zlib", "zlib", ()),
    ("unlicense", "unlicense", ()),
    ("wtfpl", "wtfpl", ("2",)),
    ("ofl", "sil open font", ("1 0", "1 1")),
    ("odbl", "open database", ("1 0",)),
    ("cc0", "cc0", ("1 0",)),
    ("cc-by", "cc by", ("2 0", "3 0", "4 0")),
    ("cc-by-sa", "cc by sa", ("2 0", "3 0", "4 0")),
    ("cc-by-nc", "cc by nc", ("2 0", "3 0", "4 0")),
    ("cc-by-nd", "cc by nd", ("2 0", "3 0", "4 0")),
    ("cc-by-nc-sa", "cc by nc sa", ("2 0", "3 0", "4 0")),
    ("cc-by-nc-nd", "cc by nc nd", ("2 0", "3 0", "4 0")),
    ("cc-by", "creative commons attribution", ("2 0", "3 0", "4 0")),
    ("cc-by-sa", "creative commons attribution sharealike", ("2 0", "3 0", "4 0")),
)

#: Label, expression, words that have to be there.
NOTICES = (
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy", ("permission", "granted")),
    ("isc", r"permission to use copy modify and( or)? distribute this software for any purpose", ("permission", "distribute")),
    ("bsd", r"redistribution and use in source and binary forms with or without modification", ("redistribution",)),
    # The holder's name is taken to have 400 characters at most.
    ("bsd", r"neither the name of .{1,400}? nor the names of its contributors", ("neither", "contributors")),
    ("gpl", r"this program is free software you can redistribute it and or modify it", ("redistribute",)),
    ("lgpl", r"this library is free software you can redistribute it and or modify it", ("redistribute",)),
    ("gpl", r"you should have received a copy of the gnu general public license", ("received", "gnu")),
    ("lgpl", r"you should have received a copy of the gnu lesser general public license", ("received", "lesser")),
    ("apache", r"you may not use this file except in compliance with the license", ("compliance",)),
    ("apache", r"www apache org licenses( license 2 0)?", ("apache", "licenses")),
    ("mit", r"opensource org licenses? mit( license)?", ("opensource", "mit")),
    ("bsd", r"opensource org licenses? bsd( license)?", ("opensource", "bsd")),
    ("gpl", r"www gnu org licenses( old licenses)?( gpl)?", ("gnu", "licenses")),
    ("mpl", r"this source code form is subject to the terms of the mozilla public", ("mozilla",)),
    ("unlicense", r"this is free and unencumbered software released into the public domain", ("unencumbered",)),
    ("zlib", r"this software is provided as is without any express or implied warranty", ("warranty", "implied")),
    ("public-domain", r"(released|dedicated|placed) (in|in ?to|to) the public domain", ("public", "domain")),
    ("cc-by", r"creativecommons org licenses by( \d \d)?", ("creativecommons",)),
    ("cc-by-sa", r"creativecommons org licenses by sa( \d \d)?", ("creativecommons", "sa")),
    ("cc-by-nc", r"creativecommons org licenses by nc( \d \d)?", ("creativecommons", "nc")),
    ("cc0", r"creativecommons org publicdomain zero( 1 0)?", ("creativecommons", "zero")),
    ("all-rights-reserved", r"all rights reserved", ("rights", "reserved")),
    ("copyright", r"copyright( c)? (19|20)\d\d", ("copyright",)),
)

#: Licences named in one word, with what may follow it.
COMPACT = (
    ("gpl-1", "gplv1", ""),
    ("gpl-2", "gplv2", "( 0)?"),
    ("gpl-3", "gplv3", "( 0)?"),
    ("gpl-2", "gpl2", "( 0)?"),
    ("gpl-3", "gpl3", "( 0)?"),
    ("lgpl-2", "lgplv2", "( [01])?"),
    ("lgpl-3", "lgplv3", "( 0)?"),
    ("lgpl-2", "lgpl2", "( [01])?"),
    ("lgpl-3", "lgpl3", "( 0)?"),
    ("agpl-3", "agplv3", "( 0)?"),
    ("agpl-3", "agpl3", "( 0)?"),
    ("apache", "apache2", "( 0)?"),
    ("apache", "apachev2", "( 0)?"),
    ("apache", "asl2", "( 0)?"),
    ("mpl", "mplv2", "( 0)?"),
    ("mpl", "mpl2", "( 0)?"),
    ("epl", "eplv1", "( 0)?"),
    ("epl", "eplv2", "( 0)?"),
    ("epl", "epl2", "( 0)?"),
    ("bsd", "bsd2", "( clause)?"),
    ("bsd", "bsd3", "( clause)?"),
    ("eupl", "euplv1", "( [12])?"),
    ("cc-by", "ccby", r"( \d \d)?"),
    ("cc-by-sa", "ccbysa", r"( \d \d)?"),
)
COMPACT_PRIORITY, COMPACT_WEIGHT = 35, 0.9

#: How a licence is named, with priority, weight and further words it needs.
FORMS = (
    ("identifier", r"spdx license identifier {any}", 50, 0.99, ("spdx",)),
    ("under", r"(licensed|released|distributed|available|published) under (the )?(terms of (the )?)?{any}", 40, 0.95, ("under",)),
    ("licence", r"{name} (public )?licen[cs]e", 20, 0.8, ()),
    ("header", r"licen[cs]e {any}", 30, 0.85, ()),
    ("terms", r"(terms|conditions) of (the )?{any}", 25, 0.85, ("of",)),
    ("choice", r"(either|any) (later )?version of (the )?{any}", 25, 0.85, ("version",)),
)
VERSIONED = (
    ("version", r"{name}( licen[cs]e)? (v|version |v )?{version}", 35, 0.9, ()),
    ("or-later", r"{name}( licen[cs]e)? (v|version |v )?{version} (or|or any) later", 45, 0.95, ("later",)),
    ("only", r"{name}( licen[cs]e)? (v|version |v )?{version} only", 45, 0.95, ("only",)),
)
NOTICE_PRIORITY, NOTICE_WEIGHT = 60, 0.97
BASE_PRIORITY, BASE_WEIGHT = 10, 0.7
WEAK = {"copyright": 0.2, "all-rights-reserved": 0.4}


def _pattern(text: str) -> re.Pattern:
    return re.compile(rf"(?<![^ ])(?:{text})(?![^ ])")


@cache
def rules() -> tuple[Rule, ...]:
    """All rules, in the order in which they are tried."""
    found = [
        Rule(f"base-{label}", label, _pattern(phrase), tuple(phrase.split()), BASE_PRIORITY, BASE_WEIGHT, True)
        for phrase, label in BASE_PHRASES
    ]
    for n, (label, text, needs) in enumerate(NOTICES):
        weak = label in WEAK
        found.append(
            Rule(f"notice-{n}-{label}", label, _pattern(text), needs, 5 if weak else NOTICE_PRIORITY, WEAK.get(label, NOTICE_WEIGHT))
        )
    for label, word, rest in COMPACT:
        found.append(Rule(f"compact-{word}", label, _pattern(word + rest), (word,), COMPACT_PRIORITY, COMPACT_WEIGHT))
    for label, name, versions in FAMILIES:
        words = tuple(name.split())
        optional = f"( licen[cs]e)?( (v|version |v )?({'|'.join(versions)}))?" if versions else "( licen[cs]e)?"
        for form, text, priority, weight, needs in FORMS:
            pattern = _pattern(text.format(name=name, any=name + optional))
            found.append(Rule(f"{form}-{name}", label, pattern, (*words, *needs), priority, weight))
        for version in versions:
            for form, text, priority, weight, needs in VERSIONED:
                pattern = _pattern(text.format(name=name, version=version))
                needed = (*words, *needs)
                found.append(Rule(f"{form}-{name}-{version}", f"{label}-{version.split()[0]}" if label in ("gpl", "lgpl", "agpl") else label, pattern, needed, priority, weight))
    return tuple(found)
