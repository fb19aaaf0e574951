"""License scan: Aho-Corasick over notice phrases and identifier tags, expressions evaluated by a shunting-yard parser.

One automaton holds the notice phrases as words between single spaces; a text is normalised once and passed over once.
A second one, over the text itself in lower case, holds the identifier tag, the SPDX identifiers and exceptions; it
is asked where the first has met the tag's words.  The operands of the expression behind a tag are identifiers that
it found at that very place; the expression is turned into reverse Polish notation by precedence
(``with`` over ``and`` over ``or``) and evaluated.
"""

from __future__ import annotations

import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import read_table
from .common import WORD_BYTES, worker_cache_of

#: fixed values of the contract: phrase -> label; their places are counted
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: further notice phrases of this scan -> label
NOTICES = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "permission is hereby granted free of charge": "mit",
    "permission to use copy modify and or distribute this software": "isc",
    "licensed under the apache license": "apache",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
}
#: fixed values: SPDX identifiers by label, and how freely the label lets a text be used, 0 to 1
FAMILIES = {
    "public-domain": (1.0, "Unlicense NIST-PD"),
    "cc0": (1.0, "CC0-1.0"),
    "0bsd": (1.0, "0BSD MIT-0"),
    "wtfpl": (1.0, "WTFPL"),
    "mit": (0.95, "MIT X11"),
    "isc": (0.95, "ISC"),
    "bsd": (0.95, "BSD-1-Clause BSD-2-Clause BSD-2-Clause-Patent BSD-3-Clause BSD-3-Clause-Clear BSD-4-Clause BSD-Source-Code"),
    "zlib": (0.95, "Zlib libpng-2.0"),
    "boost": (0.95, "BSL-1.0"),
    "psf": (0.95, "PSF-2.0 Python-2.0"),
    "apache": (0.9, "Apache-1.0 Apache-1.1 Apache-2.0"),
    "artistic": (0.8, "Artistic-1.0 Artistic-2.0"),
    "cc-by": (0.8, "CC-BY-1.0 CC-BY-2.0 CC-BY-2.5 CC-BY-3.0 CC-BY-4.0"),
    "ms-pl": (0.8, "MS-PL"),
    "mpl": (0.6, "MPL-1.0 MPL-1.1 MPL-2.0 MPL-2.0-no-copyleft-exception"),
    "epl": (0.6, "EPL-1.0 EPL-2.0"),
    "cddl": (0.6, "CDDL-1.0 CDDL-1.1"),
    "eupl": (0.5, "EUPL-1.1 EUPL-1.2"),
    "lgpl": (0.5, "LGPL-2.0 LGPL-2.0-only LGPL-2.0-or-later LGPL-2.1 LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0 LGPL-3.0-only LGPL-3.0-or-later"),
    "cc-by-sa": (0.5, "CC-BY-SA-1.0 CC-BY-SA-2.0 CC-BY-SA-2.5 CC-BY-SA-3.0 CC-BY-SA-4.0"),
    "gfdl": (0.3, "GFDL-1.1-only GFDL-1.2-only GFDL-1.3-only GFDL-1.3-or-later"),
    "gpl": (0.3, "GPL-1.0 GPL-1.0-only GPL-1.0-or-later GPL-2.0 GPL-2.0-only GPL-2.0-or-later GPL-3.0 GPL-3.0-only GPL-3.0-or-later"),
    "agpl": (0.2, "AGPL-1.0-only AGPL-1.0-or-later AGPL-3.0 AGPL-3.0-only AGPL-3.0-or-later"),
    "sspl": (0.1, "SSPL-1.0"),
    "cc-by-nd": (0.2, "CC-BY-ND-1.0 CC-BY-ND-2.0 CC-BY-ND-2.5 CC-BY-ND-3.0 CC-BY-ND-4.0"),
    "cc-by-nc": (0.2, "CC-BY-NC-1.0 CC-BY-NC-2.0 CC-BY-NC-2.5 CC-BY-NC-3.0 CC-BY-NC-4.0"),
    "cc-by-nc-sa": (0.15, "CC-BY-NC-SA-1.0 CC-BY-NC-SA-2.0 CC-BY-NC-SA-2.5 CC-BY-NC-SA-3.0 CC-BY-NC-SA-4.0"),
    "cc-by-nc-nd": (0.1, "CC-BY-NC-ND-1.0 CC-BY-NC-ND-2.0 CC-BY-NC-ND-2.5 CC-BY-NC-ND-3.0 CC-BY-NC-ND-4.0"),
    "all-rights-reserved": (0.05, ""),
    "licenseref": (0.4, ""),  # a licence that the text itself defines
}
#: fixed values: SPDX exceptions
EXCEPTIONS = (
    "Classpath-exception-2.0 GCC-exception-2.0 GCC-exception-3.1 LLVM-exception Autoconf-exception-3.0 Bison-exception-2.2 "
    "Font-exception-2.0 Linux-syscall-note OpenSSL-exception Swift-exception Universal-FOSS-exception-1.0"
).split()
FREEDOM = {label: freedom for label, (freedom, _) in FAMILIES.items()}
LABEL_OF = {name.lower(): label for label, (_, names) in FAMILIES.items() for name in names.split()}
EXCEPTION = 0.2  # what an exception adds to the freedom
TAG_WORDS, TAG = "spdx license identifier", "spdx-license-identifier:"
TOKEN = re.compile(r"\(|\)|[A-Za-z0-9][A-Za-z0-9.+:-]*")
OWN = re.compile(r"(documentref-[a-z0-9.-]+:)?licenseref-[a-z0-9.-]+")
STRENGTH = {"OR": 1, "AND": 2, "WITH": 3}
NEGATIONS = {"not", "no", "non", "never", "without"}  # before a notice, two words at most: it says nothing about the text
SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, "
    "base_labels string, labels string, score double"
)


def postfix(tokens: list[str]) -> list[str] | None:
    """Shunting-yard: the tokens in reverse Polish notation, operators in upper case; None if malformed.

    What follows a whole expression without an operator between is no part of it.
    """
    out: list[str] = []
    stack: list[str] = []
    operand = False  # whether the last token ended an operand
    for token in tokens:
        up = token.upper()
        if token == "(":
            if operand:
                break
            stack.append(token)
        elif token == ")":
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not operand or not stack:
                return None
            stack.pop()
        elif up in STRENGTH:
            if not operand:
                return None
            while stack and stack[-1] != "(" and STRENGTH[stack[-1]] >= STRENGTH[up]:
                out.append(stack.pop())
            stack.append(up)
            operand = False
        elif operand:
            break
        else:
            out.append(token)
            operand = True
    out += reversed(stack)
    return out if operand and "(" not in stack else None


def evaluate(rpn: list[str]) -> tuple[set[str], float] | None:
    """(labels, freedom): ``or`` lets the freest be chosen, ``and`` binds to the strictest, ``with`` eases.

    None if an operand is no licence, or what stands behind ``with`` no exception.
    """
    stack: list[tuple[set[str], float] | None] = []
    for token in rpn:
        low = token.lower()
        if token not in STRENGTH:
            label = "licenseref" if OWN.fullmatch(low) else LABEL_OF.get(low) or LABEL_OF.get(low.removesuffix("+"))
            stack.append(({label}, FREEDOM[label]) if label else (set(), 0.0) if low in _EXCEPTIONS else None)
            continue
        right, left = stack.pop(), stack.pop()
        if left is None or right is None or not left[0] or (token == "WITH") == bool(right[0]):
            return None
        if token == "WITH":
            stack.append((left[0], min(1.0, left[1] + EXCEPTION)))
        else:
            stack.append((left[0] | right[0], max(left[1], right[1]) if token == "OR" else min(left[1], right[1])))
    return stack[0] if stack[0] and stack[0][0] else None


_EXCEPTIONS = {e.lower() for e in EXCEPTIONS}


def automata() -> tuple[ahocorasick.Automaton, ahocorasick.Automaton]:
    """(phrases between spaces, tag and identifiers in lower case)."""
    phrases, names = ahocorasick.Automaton(), ahocorasick.Automaton()
    for phrase, label in (NOTICES | BASE | {TAG_WORDS: ""}).items():
        phrases.add_word(f" {phrase} ", (len(phrase) + 2, label, phrase in BASE))
    for name in [TAG, *LABEL_OF, *_EXCEPTIONS]:
        names.add_word(name, (len(name), name == TAG))
    phrases.make_automaton()
    names.make_automaton()
    return phrases, names


def expressions(raw: bytes, names: ahocorasick.Automaton) -> list[list[str]]:
    """The tokens of each expression behind a tag, to the first that is neither identifier, operator nor parenthesis."""
    low = raw.lower().decode("latin-1")  # one character per byte
    tags, known = [], set()
    for end, (size, tag) in names.iter(low):
        if tag:
            tags.append(end + 1)
        else:
            known.add((end + 1 - size, end + 1))
    out = []
    for a in tags:
        tokens = []
        for m in TOKEN.finditer(low, a, min(x for x in (low.find("\n", a), low.find("\r", a), len(low)) if x >= 0)):
            s, span = m[0], m.span()
            if not (s in "()" or s.upper() in STRENGTH or span in known or (s[-1] == "+" and (span[0], span[1] - 1) in known) or OWN.fullmatch(s)):
                break
            tokens.append(s)
        out.append(tokens)
    return out


def scan(raw: bytes, automata_: tuple[ahocorasick.Automaton, ahocorasick.Automaton]) -> tuple:
    """(n_words, n_base, first_word, last_word, base_labels, labels, score) of one text in UTF-8."""
    phrases, names = automata_
    words = raw.translate(WORD_BYTES).split()
    line = b" " + b" ".join(words) + b" "
    line = line.decode("latin-1")  # one character per byte
    n, first, last, base, labels, tagged, freedom = 0, len(line), -1, set(), set(), False, []
    for end, (size, label, counted) in phrases.iter(line):
        if not label:
            tagged = True
            continue
        start = end + 1 - size
        denied = not NEGATIONS.isdisjoint(line[max(0, start - 40) : start].split(" ")[-2:])
        if not denied:
            labels.add(label)
            freedom.append(FREEDOM[label])
        if counted:
            base.add(label)
            n, first, last = n + 1, min(first, start), max(last, start)
    if tagged:
        for tokens in expressions(raw, names):
            if (rpn := postfix(tokens)) and (found := evaluate(rpn)):
                labels |= found[0]
                freedom.append(found[1])
    at = (line.count(" ", 0, first), line.count(" ", 0, last)) if n else (None, None)
    return len(words), n, *at, ",".join(sorted(base)), ",".join(sorted(labels | base)), min(freedom, default=0.0)


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row per document: word and phrase counts, labels, and a score.

    ``score`` is 0 without any licence, else the freedom of the strictest one found: of notices, and of whole expressions.
    A notice behind a negation adds no label (a base phrase's label stays) and no freedom.  A null or empty text has no
    words and no labels; repeated rows are scanned each; a malformed expression, or one with an unknown identifier, adds
    nothing; an empty table gives no rows; columns but doc_id and text are not read.  Rows are independent: no shuffle.
    """

    def run(batches):
        cache = worker_cache_of("licenses")
        found = cache.get("licenses") or cache.setdefault("licenses", automata())
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            rows = [(key.as_py(), *scan(t.as_py() or b"", found)) for key, t in zip(batch.column(0), texts, strict=True)]
            columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    names = [c.split()[0] for c in SCHEMA.split(", ")]
    kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64()]
    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read_table(spark, sf_dir, "documents"))


QUERIES = {"op2_license_scan": op2_license_scan}
