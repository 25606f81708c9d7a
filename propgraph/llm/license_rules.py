"""Signature rules of licences: name patterns written by hand, times the forms in which texts cite them.

Patterns apply to normalised text: lower-case words with one space between. Fixed values: licence names.
"""

from __future__ import annotations

from typing import NamedTuple

#: label; gate (a word of which the text must hold part); pattern of the name; versions ('' for none).
FAMILIES = (
    ("gpl", "gpl", r"gnu gpl|gpl", ("1 0", "2 0", "3 0", "1", "2", "3")),
    ("gpl", "general public", r"(?:gnu )?general public license", ("1 0", "2 0", "3 0", "1", "2", "3")),
    ("lgpl", "lgpl", r"gnu lgpl|lgpl", ("2 0", "2 1", "3 0", "2", "3")),
    ("lgpl", "lesser general public", r"(?:gnu )?lesser general public license", ("2 0", "2 1", "3 0", "2", "3")),
    ("lgpl", "library general public", r"(?:gnu )?library general public license", ("2 0", "2")),
    ("agpl", "agpl", r"gnu agpl|agpl", ("1 0", "3 0", "3")),
    ("agpl", "affero", r"(?:gnu )?affero general public license", ("1 0", "3 0", "1", "3")),
    ("gfdl", "free documentation", r"(?:gnu )?free documentation license", ("1 1", "1 2", "1 3")),
    ("apache", "apache", r"apache(?: software)?", ("1 0", "1 1", "2 0", "2")),
    ("mit", "licen", r"mit(?: x11| expat)?", ()),
    ("x11", "x11", r"x11 license", ()),
    ("bsd-2-clause", "bsd", r"bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd|freebsd", ()),
    ("bsd-3-clause", "bsd", r"bsd 3 clause|3 clause bsd|three clause bsd|new bsd|revised bsd|modified bsd", ()),
    ("bsd-4-clause", "bsd", r"bsd 4 clause|4 clause bsd|original bsd", ()),
    ("bsd", "bsd", r"bsd license|bsd style license|berkeley software distribution license", ()),
    ("0bsd", "0bsd", r"0bsd|zero clause bsd", ()),
    ("isc", "isc", r"isc license", ()),
    ("mpl", "mpl", r"mpl", ("1 0", "1 1", "2 0", "2")),
    ("mpl", "mozilla", r"mozilla public license", ("1 0", "1 1", "2 0", "2")),
    ("epl", "eclipse", r"eclipse public license", ("1 0", "2 0", "2")),
    ("epl", "epl", r"epl", ("1 0", "2 0")),
    ("cddl", "common development", r"common development and distribution license", ("1 0", "1 1")),
    ("cddl", "cddl", r"cddl", ("1 0", "1 1")),
    ("eupl", "european union public", r"european union public license", ("1 1", "1 2")),
    ("eupl", "eupl", r"eupl", ("1 1", "1 2")),
    ("artistic", "artistic", r"(?:perl )?artistic license", ("1 0", "2 0")),
    ("boost", "boost", r"boost software license", ("1 0",)),
    ("zlib", "zlib", r"zlib license|zlib libpng license", ()),
    ("unlicense", "unlicense", r"the unlicense|unlicense", ()),
    ("wtfpl", "wtfpl", r"wtfpl", ("2",)),
    ("python", "python", r"python software foundation license|python license|psf license", ("2", "2 0")),
    ("php", "php", r"php license", ("3 0", "3 01")),
    ("ruby", "ruby", r"ruby license", ()),
    ("openssl", "openssl", r"openssl license", ()),
    ("postgresql", "postgresql", r"postgresql license", ()),
    ("ms-pl", "microsoft public", r"microsoft public license", ()),
    ("ms-rl", "microsoft reciprocal", r"microsoft reciprocal license", ()),
    ("osl", "open software license", r"open software license", ("1 0", "2 0", "2 1", "3 0")),
    ("afl", "academic free", r"academic free license", ("2 1", "3 0")),
    ("ofl", "open font", r"(?:sil )?open font license", ("1 0", "1 1")),
    ("odbl", "open database", r"open database license", ("1 0",)),
    ("odc-by", "open data commons", r"open data commons attribution license", ("1 0",)),
    ("pddl", "public domain dedication", r"open data commons public domain dedication and license", ("1 0",)),
    ("bsl", "business source", r"business source license", ("1 0", "1 1")),
    ("sspl", "server side public", r"server side public license", ("1",)),
    ("elastic", "elastic", r"elastic license", ("1 0", "2 0")),
    ("openrail", "openrail", r"openrail(?: m)?|responsible ai license", ()),
    ("ecl", "educational community", r"educational community license", ("1 0", "2 0")),
    ("upl", "universal permissive", r"universal permissive license", ("1 0",)),
    ("ncsa", "ncsa", r"university of illinois ncsa open source license|ncsa license", ()),
    ("cpl", "common public license", r"common public license", ("1 0",)),
    ("ipl", "ibm public", r"ibm public license", ("1 0",)),
    ("qpl", "q public", r"q public license", ("1 0",)),
    ("vim", "vim license", r"vim license", ()),
    ("beerware", "beer", r"beerware license|beer ware license", ()),
    ("cc-by-nc-nd", "nc nd", r"(?:cc|creative commons) by nc nd", ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc-sa", "nc sa", r"(?:cc|creative commons) by nc sa", ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc", "by nc", r"(?:cc|creative commons) by nc", ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nd", "by nd", r"(?:cc|creative commons) by nd", ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-sa", "by sa", r"(?:cc|creative commons) by sa", ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by", "c by", r"cc by", ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by", "commons", r"creative commons by|creative commons attribution", ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-sa", "sharealike", r"creative commons attribution sharealike", ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc", "noncommercial", r"creative commons attribution noncommercial", ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc0", "cc0", r"cc0|creative commons zero", ("1 0",)),
)
#: Labels whose names say by themselves that a licence is meant; others need the word.
CLEAR = {"gpl", "lgpl", "agpl", "mpl", "cddl", "eupl", "wtfpl", "unlicense", "0bsd", "bsd-2-clause", "bsd-3-clause", "bsd-4-clause"}
#: Statements that are no licence by name: label, gate, pattern.
STATEMENTS = (
    ("all-rights-reserved", "rights reserved", r"all rights reserved"),
    ("public-domain", "public domain", r"(?:in|into|to) the public domain"),
    ("proprietary", "proprietary", r"(?:proprietary and confidential|confidential and proprietary)"),
    ("permission-notice", "permission is hereby granted", r"permission is hereby granted free of charge"),
    ("redistribution-notice", "redistribution and use", r"redistribution and use in source and binary forms"),
    ("warranty-disclaimer", "without warranty", r"(?:as is )?without warranty of any kind"),
    ("copyright", "copyright", r"copyright (?:c )?\d{4}"),
)
#: Confidence of each priority; the first counts most, and a match inside one of no lower priority is left out.
CONFIDENCE = (1.0, 0.95, 0.9, 0.85, 0.7)

_GRANT = r"(?:licensed|released|distributed|available|published|provided) under (?:the )?(?:terms of (?:the )?)?"


class Rule(NamedTuple):
    gate: str
    pattern: str
    priority: int
    label: str


def rules() -> list[Rule]:
    """Forms by priority: SPDX tag; grant with version; name with version; grant; name alone."""
    out = []
    for label, gate, name, versions in FAMILIES:
        tag = label.replace("-", " ")
        for version in versions:
            own = f"{label}-{version.replace(' ', '.')}"
            number = rf"(?: license)?(?: version| v)? {version}(?: or later| only)?(?! \d)"
            out.append(Rule("spdx", rf"spdx license identifier {tag} {version}(?! \d)(?: only| or later)?", 0, own))
            out.append(Rule(gate, rf"{_GRANT}(?:{name}){number}", 1, own))
            out.append(Rule(gate, rf"(?:{name}){number}", 2, own))
        out.append(Rule("spdx", rf"spdx license identifier {tag}", 0, label))
        out.append(Rule(gate, rf"{_GRANT}(?:{name})(?: license)?", 3, label))
        clear = "license" in name or label in CLEAR or label.startswith("cc")
        out.append(Rule(gate, rf"(?:{name})(?: license)?" if clear else rf"(?:{name}) license", 4, label))
    out += [Rule(gate, pattern, 3, label) for label, gate, pattern in STATEMENTS]
    # a pattern stands between words
    return list(dict.fromkeys(r._replace(pattern=f"(?<![^ ])(?:{r.pattern})(?![^ ])") for r in out))
