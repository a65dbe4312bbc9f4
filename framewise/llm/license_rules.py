"""Ordered licence signature rules.

Each family has a label, a keyword that every match holds, and hand-written patterns over lower-cased text. A family gives
up to four rules: its SPDX tag, its grant ("licensed under ..."), its titles and its addresses, in this priority. Rules of
one kind keep the order of the families, which puts narrower names first.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

# Label | SPDX identifiers | titles | addresses (each a pattern; empty: no rule).
FAMILIES = r"""
agpl-3.0 | agpl-3\.0(?:-only|-or-later|\+)? | gnu\s+affero\s+general\s+public\s+licen[sc]e(?:\s*,?\s*(?:version|v)\s*3(?:\.0)?)? | gnu\.org/licenses/agpl
lgpl-2.1 | lgpl-2\.1(?:-only|-or-later|\+)? | gnu\s+lesser\s+general\s+public\s+licen[sc]e\s*,?\s*(?:version|v)\s*2\.1 | gnu\.org/licenses/old-licenses/lgpl-2\.1
lgpl-2.0 | lgpl-2\.0(?:-only|-or-later|\+)? | gnu\s+library\s+general\s+public\s+licen[sc]e | gnu\.org/licenses/old-licenses/lgpl-2\.0
lgpl-3.0 | lgpl-3\.0(?:-only|-or-later|\+)? | gnu\s+lesser\s+general\s+public\s+licen[sc]e\s*,?\s*(?:version|v)\s*3 | gnu\.org/licenses/lgpl-3\.0
lgpl | lgpl | gnu\s+lesser\s+general\s+public\s+licen[sc]e | gnu\.org/licenses/lgpl
gpl-2.0 | gpl-2\.0(?:-only|-or-later|\+)? | gnu\s+general\s+public\s+licen[sc]e\s*,?\s*(?:as\s+published\s+by\s+the\s+free\s+software\s+foundation\s*[,;]\s*(?:either\s+)?)?(?:version|v)\s*2 | gnu\.org/licenses/old-licenses/gpl-2\.0
gpl-3.0 | gpl-3\.0(?:-only|-or-later|\+)? | gnu\s+general\s+public\s+licen[sc]e\s*,?\s*(?:as\s+published\s+by\s+the\s+free\s+software\s+foundation\s*[,;]\s*(?:either\s+)?)?(?:version|v)\s*3 | gnu\.org/licenses/gpl-3\.0
gpl-1.0 | gpl-1\.0(?:-only|-or-later|\+)? | gnu\s+general\s+public\s+licen[sc]e\s*,?\s*(?:version|v)\s*1 | gnu\.org/licenses/old-licenses/gpl-1\.0
gpl | gpl | gnu\s+general\s+public\s+licen[sc]e | gnu\.org/licenses/gpl
gfdl-1.3 | gfdl-1\.3(?:-only|-or-later)? | gnu\s+free\s+documentation\s+licen[sc]e\s*,?\s*(?:version|v)\s*1\.3 | gnu\.org/licenses/fdl-1\.3
gfdl | gfdl-1\.[12](?:-only|-or-later)? | gnu\s+free\s+documentation\s+licen[sc]e | gnu\.org/licenses/(?:old-licenses/)?fdl
apache-2.0 | apache-2\.0 | apache\s+(?:software\s+)?licen[sc]e\s*,?\s*(?:version|v)?\s*\.?\s*2(?:\.0)? | apache\.org/licenses/license-2\.0
apache-1.1 | apache-1\.1 | apache\s+(?:software\s+)?licen[sc]e\s*,?\s*(?:version|v)?\s*1\.1 | apache\.org/licenses/license-1\.1
apache-1.0 | apache-1\.0 | apache\s+(?:software\s+)?licen[sc]e\s*,?\s*(?:version|v)?\s*1\.0 | apache\.org/licenses/license-1\.0
apache | apache | apache\s+(?:software\s+)?licen[sc]e | apache\.org/licenses
mit-0 | mit-0 | mit\s+no\s+attribution | opensource\.org/licenses?/mit-0
mit | mit | (?:the\s+)?mit\s+licen[sc]e | opensource\.org/licenses?/mit(?!-)
mit-x11 | x11 | x11\s+licen[sc]e | x\.org/(?:docs|licenses)/x11
bsd-4-clause | bsd-4-clause(?:-uc)? | bsd\s+4[\s-]clause\s+licen[sc]e | spdx\.org/licenses/bsd-4-clause
bsd-3-clause-clear | bsd-3-clause-clear | (?:the\s+)?clear\s+bsd\s+licen[sc]e | spdx\.org/licenses/bsd-3-clause-clear
bsd-3-clause | bsd-3-clause | (?:new|modified|revised|3[\s-]clause)\s+bsd\s+licen[sc]e | opensource\.org/licenses?/bsd-3-clause
bsd-2-clause | bsd-2-clause | (?:simplified|freebsd|2[\s-]clause)\s+(?:bsd\s+)?licen[sc]e | opensource\.org/licenses?/bsd-2-clause
bsd-0 | 0bsd | zero[\s-]clause\s+bsd | opensource\.org/licenses?/0bsd
bsd | bsd | bsd[\s-](?:style\s+)?licen[sc]e | opensource\.org/licenses?/bsd-license
isc | isc | isc\s+licen[sc]e | opensource\.org/licenses?/isc
mpl-2.0 | mpl-2\.0(?:-no-copyleft-exception)? | mozilla\s+public\s+licen[sc]e\s*,?\s*(?:version|v)?\s*\.?\s*2(?:\.0)? | mozilla\.org/(?:en-us/)?mpl/2\.0
mpl-1.1 | mpl-1\.1 | mozilla\s+public\s+licen[sc]e\s*,?\s*(?:version|v)?\s*1\.1 | mozilla\.org/(?:en-us/)?mpl/1\.1
mpl | mpl-1\.0 | mozilla\s+public\s+licen[sc]e | mozilla\.org/(?:en-us/)?mpl
epl-2.0 | epl-2\.0 | eclipse\s+public\s+licen[sc]e\s*,?\s*[-–]?\s*(?:version|v)?\s*2(?:\.0)? | eclipse\.org/legal/epl-(?:v)?2
epl-1.0 | epl-1\.0 | eclipse\s+public\s+licen[sc]e | eclipse\.org/legal/epl-v10
edl-1.0 | edl-1\.0 | eclipse\s+distribution\s+licen[sc]e | eclipse\.org/org/documents/edl
cddl-1.1 | cddl-1\.1 | common\s+development\s+and\s+distribution\s+licen[sc]e\s*,?\s*\(?(?:cddl\)?\s*)?(?:version|v)?\s*1\.1 | glassfish\.dev\.java\.net/public/cddl
cddl-1.0 | cddl-1\.0 | common\s+development\s+and\s+distribution\s+licen[sc]e | opensource\.org/licenses?/cddl1
cpl-1.0 | cpl-1\.0 | common\s+public\s+licen[sc]e | opensource\.org/licenses?/cpl1\.0
ipl-1.0 | ipl-1\.0 | ibm\s+public\s+licen[sc]e | opensource\.org/licenses?/ipl-1\.0
artistic-2.0 | artistic-2\.0 | artistic\s+licen[sc]e\s*,?\s*(?:version|v)?\s*2(?:\.0)? | perlfoundation\.org/artistic
artistic-1.0 | artistic-1\.0(?:-perl|-cl8)? | artistic\s+licen[sc]e | opensource\.org/licenses?/artistic
bsl-1.0 | bsl-1\.0 | boost\s+software\s+licen[sc]e | boost\.org/license_1_0
busl-1.1 | busl-1\.1 | business\s+source\s+licen[sc]e | mariadb\.com/bsl11
sspl-1.0 | sspl-1\.0 | server\s+side\s+public\s+licen[sc]e | mongodb\.com/licensing/server-side-public-license
elastic-2.0 | elastic-2\.0 | elastic\s+licen[sc]e | elastic\.co/licensing/elastic-license
zlib | zlib | zlib(?:/libpng)?\s+licen[sc]e | zlib\.net/zlib_license
libpng | libpng(?:-2\.0)? | libpng\s+licen[sc]e | libpng\.org/pub/png/src/libpng-license
unlicense | unlicense | (?:the\s+)?unlicense(?:\s+licen[sc]e)? | unlicense\.org
wtfpl | wtfpl | do\s+what\s+the\s+f\S{1,9}\s+you\s+want\s+to\s+public\s+licen[sc]e | wtfpl\.net
psf-2.0 | (?:psf|python)-2\.0 | python\s+software\s+foundation\s+licen[sc]e | python\.org/psf/license
php-3.01 | php-3\.01? | php\s+licen[sc]e | php\.net/license
ruby | ruby | ruby\s+licen[sc]e | ruby-lang\.org/en/about/license
ofl-1.1 | ofl-1\.1(?:-rfn|-no-rfn)? | sil\s+open\s+font\s+licen[sc]e | scripts\.sil\.org/ofl
odbl-1.0 | odbl-1\.0 | open\s+(?:data\s*commons\s+open\s+)?database\s+licen[sc]e | opendatacommons\.org/licenses/odbl
odc-by | odc-by-1\.0 | open\s+data\s+commons\s+attribution\s+licen[sc]e | opendatacommons\.org/licenses/by
pddl-1.0 | pddl-1\.0 | public\s+domain\s+dedication\s+and\s+licen[sc]e | opendatacommons\.org/licenses/pddl
cc-by-nc-nd | cc-by-nc-nd-\d\.\d | (?:cc[\s-]+by[\s-]+nc[\s-]+nd|creative\s+commons\s+attribution[\s-]+non-?commercial[\s-]+no-?deriv(?:ative|s)\w*)(?:\s+\d\.\d)? | creativecommons\.org/licenses/by-nc-nd
cc-by-nc-sa | cc-by-nc-sa-\d\.\d | (?:cc[\s-]+by[\s-]+nc[\s-]+sa|creative\s+commons\s+attribution[\s-]+non-?commercial[\s-]+share-?alike)(?:\s+\d\.\d)? | creativecommons\.org/licenses/by-nc-sa
cc-by-nc | cc-by-nc-\d\.\d | (?:cc[\s-]+by[\s-]+nc|creative\s+commons\s+attribution[\s-]+non-?commercial)(?:\s+\d\.\d)? | creativecommons\.org/licenses/by-nc
cc-by-nd | cc-by-nd-\d\.\d | (?:cc[\s-]+by[\s-]+nd|creative\s+commons\s+attribution[\s-]+no-?deriv(?:ative|s)\w*)(?:\s+\d\.\d)? | creativecommons\.org/licenses/by-nd
cc-by-sa | cc-by-sa-\d\.\d | (?:cc[\s-]+by[\s-]+sa|creative\s+commons\s+attribution[\s-]+share-?alike)(?:\s+\d\.\d)? | creativecommons\.org/licenses/by-sa
cc-by | cc-by-\d\.\d | (?:cc[\s-]+by|creative\s+commons\s+attribution)(?:\s+(?:licen[sc]e\s+)?\d\.\d)? | creativecommons\.org/licenses/by/
cc0-1.0 | cc0-1\.0 | cc0(?:\s+1\.0)?(?:\s+universal)? | creativecommons\.org/publicdomain/zero
public-domain-mark | pdm-1\.0 | public\s+domain\s+mark | creativecommons\.org/publicdomain/mark
eupl-1.2 | eupl-1\.2 | european\s+union\s+public\s+licen[sc]e\s*,?\s*(?:version|v)?\.?\s*1\.2 | joinup\.ec\.europa\.eu/\S{0,200}eupl-1\.2
eupl | eupl-1\.[01] | european\s+union\s+public\s+licen[sc]e | joinup\.ec\.europa\.eu/\S{0,200}eupl
cecill-2.1 | cecill-2\.1 | cecill\s+free\s+software\s+licen[sc]e\s+agreement\s*,?\s*(?:version|v)?\s*2\.1 | cecill\.info/licences/licence_cecill_v2\.1
cecill | cecill(?:-[12]\.\d|-b|-c)? | (?:licence\s+cecill|cecill(?:-[bc])?\s+licen[sc]e) | cecill\.info
ms-pl | ms-pl | microsoft\s+public\s+licen[sc]e | opensource\.org/licenses?/ms-pl
ms-rl | ms-rl | microsoft\s+reciprocal\s+licen[sc]e | opensource\.org/licenses?/ms-rl
osl-3.0 | osl-3\.0 | open\s+software\s+licen[sc]e | opensource\.org/licenses?/osl-3\.0
afl-3.0 | afl-3\.0 | academic\s+free\s+licen[sc]e | opensource\.org/licenses?/afl-3\.0
ecl-2.0 | ecl-2\.0 | educational\s+community\s+licen[sc]e | opensource\.org/licenses?/ecl-2\.0
ncsa | ncsa | (?:university\s+of\s+illinois/)?ncsa\s+(?:open\s+source\s+)?licen[sc]e | opensource\.org/licenses?/ncsa
postgresql | postgresql | postgresql\s+licen[sc]e | opensource\.org/licenses?/postgresql
w3c | w3c | w3c\s+software\s+(?:notice\s+and\s+)?licen[sc]e | w3\.org/consortium/legal/\S{0,200}copyright-software
openssl | openssl | openssl\s+licen[sc]e | openssl\.org/source/license
vim | vim | vim\s+licen[sc]e | vimhelp\.org/uganda
blueoak-1.0 | blueoak-1\.0\.0 | blue\s+oak\s+model\s+licen[sc]e | blueoakcouncil\.org/license
mulanpsl-2 | mulanpsl-2\.0 | mulan\s+(?:permissive\s+software\s+licen[sc]e|psl) | license\.coscl\.org\.cn/mulanpsl2
qpl-1.0 | qpl-1\.0 | q\s+public\s+licen[sc]e | opensource\.org/licenses?/qpl-1\.0
sleepycat | sleepycat | sleepycat\s+licen[sc]e | opensource\.org/licenses?/sleepycat
upl-1.0 | upl-1\.0 | universal\s+permissive\s+licen[sc]e | oss\.oracle\.com/licenses/upl
zpl-2.1 | zpl-2\.1 | zope\s+public\s+licen[sc]e | opensource\.org/licenses?/zpl
tcl | tcl | tcl/tk\s+licen[sc]e | tcl\.tk/software/tcltk/license
curl | curl | curl\s+licen[sc]e | curl\.se/docs/copyright
json | json | json\s+licen[sc]e | json\.org/license
ftl | ftl | freetype\s+(?:project\s+)?licen[sc]e | freetype\.org/license
ijg | ijg | independent\s+jpeg\s+group(?:'s)?\s+(?:software\s+)?licen[sc]e | ijg\.org
openrail | openrail | (?:creativeml\s+)?open\s*rail(?:\+\+)?(?:-m)?\s+licen[sc]e | huggingface\.co/spaces/\S{0,200}openrail
"""

#: What comes before a title in a grant, and before an identifier in a tag.
GRANT = r"(?:licen[sc]ed|released|distributed|available|published)\s+(?:\w+\s+){0,3}?under\s+(?:the\s+)?(?:terms\s+(?:and\s+conditions\s+)?of\s+(?:the\s+)?)?"
TAG = r"(?:spdx-license-identifier\s*:\s*(?:\(?\s*[\w.+-]+\s+(?:or|and|with)\s+)*|\"license\"\s*:\s*\"|license\s*=\s*\")"

#: Rules without a family: a grant or reservation that names no licence. A keyword is one unbroken word that every match
#: holds: between words a match may have any white space.
GENERIC = (
    ("all-rights-reserved", "reserved", r"all\s+rights\s+reserved", 0.4),
    ("public-domain", "domain", r"(?:placed|released|dedicated)\s+(?:in)?to\s+the\s+public\s+domain", 0.7),
    ("mit", "hereby", r"permission\s+is\s+hereby\s+granted,\s+free\s+of\s+charge,\s+to\s+any\s+person\s+obtaining\s+a\s+copy", 0.9),
    ("isc", "modify,", r"permission\s+to\s+use,\s+copy,\s+modify,\s+and(?:/or)?\s+distribute\s+this\s+software", 0.8),
    ("bsd", "redistribution", r"redistribution\s+and\s+use\s+in\s+source\s+and\s+binary\s+forms", 0.8),
    ("zlib", "'as-is',", r"this\s+software\s+is\s+provided\s+'as-is',\s+without\s+any\s+express", 0.8),
    ("gpl", "redistribute", r"redistribute\s+it\s+and/or\s+modify\s+it\s+under\s+the\s+terms\s+of\s+the\s+gnu\s+general\s+public", 0.9),
    ("unlicense", "unencumbered", r"free\s+and\s+unencumbered\s+software\s+released\s+into\s+the\s+public\s+domain", 0.9),
    ("wtfpl", "just", r"you\s+just\s+do\s+what\s+the\s+f\S{1,9}\s+you\s+want\s+to", 0.9),
    ("copyright", "copyright", r"copyright\s+(?:\(c\)|©)?\s*\d{4}", 0.3),
)


@dataclass(frozen=True)
class Rule:
    """words: literals that every match holds; the rule runs only on texts that hold them all."""

    label: str
    kind: str
    words: tuple[str, ...]
    pattern: str
    weight: float

    def compiled(self) -> re.Pattern:
        """White space is taken whole and never given back: nothing behind it in a rule begins with white space, so the
        matches are the same, and a long run of it is read once and not split in all ways."""
        return re.compile(self.pattern.replace(r"\s+", r"\s++").replace(r"\s*", r"\s*+"))


def literal_of(pattern: str) -> str:
    """The longest run of literal letters that a pattern can't match without; none if there are alternatives at its top."""
    bare = re.sub(r"\\[.]", ".", pattern)
    bare = re.sub(r"\(\?[<!=:][^()]*\)[?*]|\(\?<?![^()]*\)", "\n", bare)
    depth, run, runs = 0, "", []
    for k, c in enumerate(bare):
        depth += (c == "(") - (c == ")")
        if depth == 0 and re.match(r"[a-z0-9.]", c) and bare[k + 1 : k + 2] not in ("?", "*", "{") and bare[k - 1 : k] != "\\":
            run += c
        else:
            runs.append(run)
            run = ""
    runs.append(run)
    if "|" in re.sub(r"\([^()]*\)", "", re.sub(r"\([^()]*\)", "", bare)):
        return ""
    return max((r.strip(".") for r in runs), key=len)


def rules() -> list[Rule]:
    """All rules, of falling priority: tags, grants, generic phrases, titles, addresses."""
    families = [[x.strip() for x in line.split(" | ")] for line in FAMILIES.strip().splitlines()]
    edge = r"(?<![\w.-])(?:%s)(?![\w-])"
    words = lambda *some: tuple(w for w in some if len(w) >= 3)
    out = [Rule(f[0], "tag", words("license", literal_of(f[1])), f"{TAG}(?P<at>{edge % f[1]})", 0.95) for f in families]
    out += [Rule(f[0], "grant", words("under", literal_of(f[2])), GRANT + edge % f[2], 0.9) for f in families]
    out += [Rule(label, "phrase", (word,), pattern, weight) for label, word, pattern, weight in GENERIC]
    out += [Rule(f[0], "title", words(literal_of(f[2])), edge % f[2], 0.7) for f in families]
    out += [Rule(f[0], "address", words(literal_of(f[3])), edge % f[3], 0.8) for f in families]
    return out
