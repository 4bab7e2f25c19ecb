"""Templates of common licences: titles, headers and grant paragraphs.

Fixed values. Every paragraph is a template of its own, so a paragraph that is
left out or reworded does not move the others out of place. Names of programs
and holders are not part of a template.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    keys: tuple[str, ...] = ()   # phrases that must stand in place
    share: float = 1.0           # least IDF-weighted share of words in place
    base: bool = False


def _t(label: str, words: str, *keys: str, share: float = 0.75, base: bool = False) -> Template:
    return Template(label, tuple(words.split()), keys, share if keys else 1.0, base)


_NOTICES = (
    _t("mit", "mit license", base=True),
    _t("apache", "apache license", base=True),
    _t("gpl", "general public license", base=True),
    _t("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy", "hereby granted"),
    _t("mit-notice", "released under the mit license", "mit license"),
    _t("apache-notice", "licensed under the apache license version 2 0", "apache license"),
    _t("gpl-notice", "work is licensed under the gnu general public license version 3", "general public license"),
    _t("bsd", "redistribution and use in source and binary forms with or without modification", "binary forms"),
    _t("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc 4 0"),
    _t("all-rights-reserved", "all rights reserved", "rights reserved"),
)

_PERMISSIVE = (
    _t("mit-rights", "to deal in the software without restriction including without limitation the rights to use copy modify merge "
       "publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished "
       "to do so subject to the following conditions", "deal in the software without restriction"),
    _t("mit-condition", "the above copyright notice and this permission notice shall be included in all copies or substantial "
       "portions of the software", "copies or substantial portions"),
    _t("mit-warranty", "the software is provided as is without warranty of any kind express or implied including but not limited to "
       "the warranties of merchantability fitness for a particular purpose and noninfringement", "without warranty of any kind express"),
    _t("bsd-source-clause", "redistributions of source code must retain the above copyright notice this list of conditions and the "
       "following disclaimer", "redistributions of source code"),
    _t("bsd-binary-clause", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
       "following disclaimer in the documentation and or other materials provided with the distribution", "redistributions in binary form"),
    _t("bsd-3-clause", "used to endorse or promote products derived from this software without specific prior written permission",
       "endorse or promote products"),
    _t("bsd-4-clause", "all advertising materials mentioning features or use of this software must display the following "
       "acknowledgement", "advertising materials mentioning features"),
    _t("bsd-warranty", "as is and any express or implied warranties including but not limited to the implied warranties of "
       "merchantability and fitness for a particular purpose are disclaimed", "any express or implied warranties"),
    _t("isc", "distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice "
       "and this permission notice appear in all copies", "any purpose with or without fee", "permission notice appear"),
    _t("0bsd", "distribute this software for any purpose with or without fee is hereby granted the software is provided as is",
       "fee is hereby granted the software is provided"),
    _t("isc-warranty", "the software is provided as is and the author disclaims all warranties with regard to this software including "
       "all implied warranties of merchantability and fitness", "disclaims all warranties with regard"),
    _t("apache-2-title", "apache license version 2 0 january 2004", "license version 2 0 january 2004"),
    _t("apache-2-header", "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
       "with the license you may obtain a copy of the license at", "apache license version 2 0"),
    _t("apache-2-basis", "unless required by applicable law or agreed to in writing software distributed under the license is "
       "distributed on an as is basis without warranties or conditions of any kind either express or implied",
       "required by applicable law or agreed"),
    _t("apache-2-grant", "each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable "
       "copyright license to reproduce prepare derivative works of publicly display publicly perform sublicense and distribute the work "
       "and such derivative works in source or object form", "no charge royalty free irrevocable copyright license"),
    _t("apache-contributor", "licensed to the apache software foundation asf under one or more contributor license agreements",
       "contributor license agreements"),
    _t("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered software"),
    _t("unlicense", "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or "
       "as a compiled binary for any purpose commercial or non commercial and by any means", "publish use compile sell"),
)


def _gnu(label: str, name: str, headers: tuple[tuple[str, str], ...], titles: tuple[tuple[str, str], ...]) -> tuple[Template, ...]:
    """Header of each version, header of any version, the two lines that
    follow it, and the titles of the texts."""
    full = f"gnu {name}"
    return (
        *(_t(f"{label}-{no}-header", f"you can redistribute it and or modify it under the terms of the {full} as published by the free "
             f"software foundation either version {v} of the license or at your option any later version",
             f"{full} as published", f"version {v} of the license") for no, v in headers),
        *(_t(f"{label}-{no}-header", f"under the terms of the {full} version {v} as published by the free software foundation",
             f"{full} version {v} as published") for no, v in headers),
        _t(f"{label}-header", f"under the terms of the {full} as published by the free software foundation", f"{full} as published"),
        _t(f"{label}-details", f"merchantability or fitness for a particular purpose see the {full} for more details",
           f"{full} for more details"),
        _t(f"{label}-copy", f"you should have received a copy of the {full}", f"received a copy of the {full}"),
        *(_t(f"{label}-{no}-title", f"{full} version {t}") for no, t in titles),
    )


_COPYLEFT = (
    *_gnu("gpl", "general public license", (("2", "2"), ("3", "3")), (("2", "2 june 1991"), ("3", "3 29 june 2007"))),
    *_gnu("lgpl", "lesser general public license", (("2.1", "2 1"), ("3", "3")), (("2.1", "2 1 february 1999"), ("3", "3 29 june 2007"))),
    *_gnu("lgpl", "library general public license", (("2", "2"),), (("2", "2 june 1991"),)),
    *_gnu("agpl", "affero general public license", (("3", "3"),), (("3", "3 19 november 2007"),)),
    _t("mpl-2-header", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not "
       "distributed with this file you can obtain one at", "mozilla public license v 2 0"),
    _t("mpl-2-title", "mozilla public license version 2 0"),
    _t("mpl-2-grant", "each contributor hereby grants you a world wide royalty free non exclusive license under intellectual property "
       "rights other than patent or trademark licensable by such contributor", "grants you a world wide royalty free"),
    _t("mpl-1.1-header", "the contents of this file are subject to the mozilla public license version 1 1 the license you may not use "
       "this file except in compliance with the license", "mozilla public license version 1 1"),
    _t("epl-1-header", "made available under the terms of the eclipse public license v1 0 which accompanies this distribution and is "
       "available at", "eclipse public license v1 0"),
    _t("epl-2-header", "made available under the terms of the eclipse public license 2 0 which is available at",
       "eclipse public license 2 0"),
    _t("epl-2-header", "made available under the terms of the eclipse public license v2 0", "eclipse public license v2 0"),
    _t("epl-title", "the accompanying program is provided under the terms of this eclipse public license agreement",
       "eclipse public license agreement"),
)


def _creative_commons() -> tuple[Template, ...]:
    """Names, short names and addresses. A name that begins another one's
    counts only with its version behind it."""
    out = []
    for parts, name, short in (("by", "", "by"), ("by-nc", "noncommercial", "by nc")):
        for v in ("4 0", "3 0", "2 5", "2 0"):
            out += [_t(f"cc-{parts}", f"creative commons attribution {name} {v}"), _t(f"cc-{parts}", f"cc {short} {v}"),
                    _t(f"cc-{parts}", f"creativecommons org licenses {short} {v}")]
    for parts, names in (("by-sa", ("sharealike",)), ("by-nd", ("noderivatives", "noderivs")),
                         ("by-nc-sa", ("noncommercial sharealike",)),
                         ("by-nc-nd", ("noncommercial noderivatives", "noncommercial noderivs"))):
        short = parts.replace("-", " ")
        out += [_t(f"cc-{parts}", f"creative commons attribution {name}") for name in names]
        out += [_t(f"cc-{parts}", f"cc {short}"), _t(f"cc-{parts}", f"creativecommons org licenses {short}")]
    return (*out, _t("cc0", "cc0 1 0"), _t("cc0", "creativecommons org publicdomain zero 1 0"))


_SPDX = tuple(_t("spdx-" + name, "spdx license identifier " + words) for name, words in (
    ("mit", "mit"), ("isc", "isc"), ("0bsd", "0bsd"), ("bsd-2-clause", "bsd 2 clause"), ("bsd-3-clause", "bsd 3 clause"),
    ("apache-2.0", "apache 2 0"), ("gpl-2.0", "gpl 2 0"), ("gpl-3.0", "gpl 3 0"), ("lgpl-2.1", "lgpl 2 1"), ("lgpl-3.0", "lgpl 3 0"),
    ("agpl-3.0", "agpl 3 0"), ("mpl-2.0", "mpl 2 0"), ("epl-2.0", "epl 2 0"), ("unlicense", "unlicense")))

TEMPLATES = (*_NOTICES, *_PERMISSIVE, *_COPYLEFT, *_creative_commons(), *_SPDX)
