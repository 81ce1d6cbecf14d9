"""License scans: Aho-Corasick over words, and a shunting-yard parser for licence expressions.

A text is lower-cased (A-Z) and cut into words of letters, digits and non-ASCII characters; the words, joined and surrounded by single
spaces, pass one Aho-Corasick automaton of all phrases, each between spaces, so a hit is a run of whole
consecutive words. Phrases are base phrases, further notice phrases, and tags that name a licence. After a tag the line of the original text is read as
a licence expression, as far as one goes, so the work stays linear in texts of many tags and no line ends: the shunting-yard parser turns it into postfix order (WITH binds tightest, then AND, then OR) and
evaluates it to the licences named and to how freely the work may be used: OR (or a slash) takes the freest choice, AND (or a comma) the most restrictive part,
WITH an exception moves a licence a step towards free.

An operand is a licence only if it is a known identifier (IDENTIFIER) or a LicenseRef-; a name beside an upper-case operator is an unknown licence, without a label and of freedom 0.5. An expression ends before any other word, so prose after a tag names nothing. Weak tags
("license", as in `License: MIT`, `license = "MIT"` and rel="license") count only if between the tag's word and the licence stand
no letters and at least one of : = > " ' and an URL after them is read for the licence that its path names. The right side of WITH is an exception and never a label.

score: how freely the text's notices let it be used, 0 (reserved) to 1 (permissive), the least over all findings; 0.5 without a finding.

Defined results: null and empty texts have no words, no labels, null word positions and score 0.5. A broken expression (a dangling
operator or bracket) gives the licences read so far, each with a verdict of its own; a tag without a licence after it gives nothing. Overlapping and repeated base phrases all count; of the method's own phrases, one inside a longer one does not. Extra columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from dataclasses import dataclass
from functools import lru_cache
from itertools import accumulate

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybeam.llm.common import map_batches, texts

#: Base phrases and labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Notice phrases and labels of the method's own.
NOTICES = {
    "apache license version 2 0": "apache-2.0", "apache license 2 0": "apache-2.0", "apache 2 0 license": "apache-2.0", "mit license": "mit", "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd", "bsd license": "bsd", "isc license": "isc",
    "general public license version 2": "gpl-2.0", "general public license version 3": "gpl-3.0", "lesser general public license": "lgpl",
    "affero general public license": "agpl", "mozilla public license": "mpl", "eclipse public license": "epl",
    "cc by sa": "cc-by-sa", "cc by nc": "cc-by-nc", "cc by nd": "cc-by-nd", "cc by nc sa": "cc-by-nc-sa", "cc by nc nd": "cc-by-nc-nd", "cc0": "cc0",
    "creative commons zero": "cc0", "public domain": "public-domain", "unlicense": "unlicense",
    "no part of this publication may be reproduced": "reserved", "proprietary and confidential": "reserved",
}
#: How the conditions of the spelt-out Creative Commons licences are written.
NON_COMMERCIAL = ("", "noncommercial", "non commercial")
CONDITIONS = {"": "", "sharealike": "-sa", "share alike": "-sa", "noderivatives": "-nd", "noderivs": "-nd", "no derivatives": "-nd", "no derivs": "-nd"}


def spelt_out() -> dict[str, str]:
    """Phrases of the six licences in words; the bare name of the freest one counts only with its maker's or its version's."""
    out = {}
    for nc in NON_COMMERCIAL:
        for condition, ending in CONDITIONS.items():
            phrase, label = " ".join(filter(None, ("attribution", nc, condition))), "cc-by" + ("-nc" if nc else "") + ending
            out[f"creative commons {phrase}"] = label
            bare = [phrase] if phrase != "attribution" else [f"attribution {v} 0 {scope}" for v, scope in ((4, "international"), (3, "unported"))]
            out |= dict.fromkeys(bare, label)
    return out


#: Phrases that a licence expression follows, and whether they are weak: common words that need a sign after them.
TAGS = {"spdx license identifier": False, "licensed under": False, "licensed under the": False, "license": True, "licence": True, "licenses": True, "license type": True, "licenses type": True, "license expression": True}
#: Identifiers of licences, lower-case, by family; versions and variants follow the family's name. Only names of a LicenseRef- may have more than 200 characters.
IDENTIFIER = re.compile(
    r"""(?:mit(?:-0|-cmu|-modern-variant)?|x11|isc|0bsd|zlib|unlicense|wtfpl|ncsa|curl|libpng|openssl|postgresql|python-2\.0(?:\.1)?|psf-2\.0|ruby|vim|w3c|icu|bsl-1\.0|blueoak-1\.0\.0|hpnd|json|beerware
    |bsd(?:-[1-4]-clause(?:-[a-z-]+)?)?|apache(?:-(?:1\.0|1\.1|2(?:\.0)?))?|artistic-[12]\.0|afl-[123]\.[0-2]|ms-(?:pl|rl)|ecl-[12]\.0|unicode-(?:3\.0|dfs-201[56]|tou)|ftl|ijg|upl-1\.0|zpl-[12]\.[01]
    |[al]?gpl-?(?:[123](?:\.[01])?)?(?:-only|-or-later|\+)?|gfdl-1\.[123](?:-(?:only|or-later))?|mpl(?:-(?:1\.[01]|2\.0))?(?:-no-copyleft-exception)?|epl-[12]\.0|cddl-1\.[01]|cpl-1\.0|eupl-1\.[012]|osl-[123]\.[01]|ofl-1\.[01]|sspl-1\.0|busl-1\.1|cecill-(?:[12]\.[01]|b|c)
    |cc0(?:-1\.0)?|cc-by(?:-nc)?(?:-(?:sa|nd))?(?:-(?:1\.0|2\.[05]|3\.0|4\.0))?(?:-[a-z]{2,4})?|pddl-1\.0|odbl-1\.0|odc-by-1\.0|(?:documentref-[a-z0-9.-]+:)?licenseref-[a-z0-9.-]+|proprietary|unlicensed|none)""",
    re.VERBOSE,
)
#: Paths of licence URLs: a licence's identifier is made of the groups that match.
LICENSE_URL = re.compile(r"https?://(?:www\.)?(?:creativecommons\.org/(?:licenses/(?P<cc>[a-z-]+)(?:/(?P<version>[0-9.]+))?|publicdomain/(?P<zero>zero))|opensource\.org/licenses?/(?P<osi>[a-z0-9.-]+)|spdx\.org/licenses/(?P<spdx>[a-z0-9.+-]+?)(?:\.html)?(?=[^a-z0-9.+-]|$))", re.IGNORECASE)
#: How freely a work under the label may be used.
FREE, SHARE_ALIKE, LIMITED, RESERVED, UNKNOWN = 1.0, 0.6, 0.3, 0.0, 0.5
FREEDOM = [
    (re.compile(r"^(mit|x11|bsd|0bsd|isc|apache|cc0|public-domain|unlicense$|zlib|ncsa|curl|libpng|openssl|postgresql|python|psf|ruby|vim|w3c|icu|bsl|blueoak|hpnd|wtfpl|beerware|artistic|afl|ms-pl|ecl|unicode|ftl|ijg|upl|zpl|pddl|odc-by|cc-by(-[0-9.]+(-[a-z]{2,4})?)?$)"), FREE),
    (re.compile(r"^cc-by-n[cd]"), LIMITED),
    (re.compile(r"^[al]?gpl|^(gfdl|mpl|epl|cddl|cpl|eupl|osl|ofl|ms-rl|cecill|odbl)|^cc-by-sa"), SHARE_ALIKE),
    (re.compile(r"^(sspl|busl|json)"), LIMITED),
    (re.compile(r"^(reserved|proprietary|unlicensed|none)$"), RESERVED),
]
#: ASCII bytes that are no word characters become spaces; A-Z become a-z.
WORD_TABLE = bytes(c + 32 if 65 <= c <= 90 else 32 if c < 0x30 or 0x3A <= c <= 0x60 or 0x7B <= c <= 0x7F else c for c in range(256))
RAW_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
EXPRESSION_TOKEN = re.compile(r"[^\S\n]*(?:(\(|\)|/|,)|((?i:(?:documentref-[a-z0-9.-]++:)?licenseref-[a-z0-9.-]++)|[A-Za-z0-9][A-Za-z0-9.+:-]{0,199}(?![A-Za-z0-9.+:-])))")
#: A version that stands after a family's name as a word of its own, and identifiers that are common words: they need the expression to end or go on after them.
VERSION, NEXT_WORD = re.compile(r"[^\S\n]+(?:version[^\S\n]+|v\.?[^\S\n]*)?([0-9](?:\.[0-9])?)(?![A-Za-z0-9.+-]*[A-Za-z0-9+-])", re.IGNORECASE), re.compile(r"[^\S\n]+(?!(?:or|and|with)\b)[A-Za-z]", re.IGNORECASE)
COMMON = {"none", "json", "ruby", "vim", "curl", "icu", "x11", "proprietary", "unlicensed", "openssl", "postgresql"}
#: An operand that is no known identifier but stands beside an upper-case operator and is written like a name.
UNKNOWN_OPERAND, NAME_LIKE, NEXT_OPERATOR = "?", re.compile(r"[A-Z0-9]|.*[0-9-]"), re.compile(r"[^\S\n]+(?:OR|AND|WITH)(?![A-Za-z0-9.+:-])")
#: What may stand between a tag and its expression, and what a weak tag needs of it.
BETWEEN, SIGN = re.compile(r"[\s:=>\"'`*_\[({-]*(?:href\s*=\s*[\"']?)?"), re.compile(r"[:=>\"'`]")
PRECEDENCE = {"or": 1, "/": 1, "and": 2, ",": 2, "with": 3}


def freedom(label: str) -> float:
    for pattern, value in FREEDOM:
        if pattern.match(label):
            return value
    return UNKNOWN


def postfix(text: str, start: int = 0, stop: int | None = None) -> tuple[list[str], bool, int]:
    """The expression at text[start:stop] in postfix order by the shunting-yard algorithm, whether it is well formed, and where it ends.

    Operands are known identifiers (a version may follow as a word of its own), any word after WITH, and names beside an upper-case operator, which are unknown. Reading stops where two operands meet or another word or sign stands,
    as there the expression ends and prose begins; an operator or bracket that prose follows belongs to the prose, unless it is upper-case or a bracket inside.
    """
    out: list[str] = []
    stack: list[str] = []
    operand_next, whole, depth, end, after_with = True, True, 0, start, False
    pending, before = None, start  # an operator that is taken once an operand follows, and where it stands
    stop = len(text) if stop is None else stop
    at = start

    def push(operator: str | None) -> None:
        if operator:
            while stack and stack[-1] != "(" and PRECEDENCE[stack[-1]] >= PRECEDENCE[operator]:
                out.append(stack.pop())
            stack.append(operator)

    while token := EXPRESSION_TOKEN.match(text, at, stop):
        sign, word = token[1], (token[2] or "").lower()
        at = token.end()
        if sign == "(":
            if not operand_next or after_with:
                break
            push(pending)
            pending = None
            stack.append(sign)
            depth += 1
        elif sign == ")":
            if operand_next or not depth:
                break
            depth -= 1
            while (top := stack.pop()) != "(":
                out.append(top)
            end = at
        elif (operator := sign or word) in PRECEDENCE:
            if operand_next:
                break
            pending, operand_next, after_with, before = operator, True, operator == "with", token.start()
            if sign is None and token[2].isupper():  # AND, OR, WITH are meant even if nothing follows
                whole, end = False, at
        else:
            word = word.rstrip(".:")
            if not operand_next:
                break
            last = token.start(2) + len(word)
            if not after_with:
                if not IDENTIFIER.fullmatch(word):
                    beside = (pending and text[before:token.start(2)].strip().isupper()) or NEXT_OPERATOR.match(text, last, stop)
                    if not beside or not NAME_LIKE.match(token[2]):
                        break
                    word = UNKNOWN_OPERAND
                elif word in COMMON and NEXT_WORD.match(text, last, stop):
                    break
                elif version := VERSION.match(text, last, stop):
                    longer = next((x for x in (f"{word}-{version[1]}.0", f"{word}-{version[1]}") if IDENTIFIER.fullmatch(x)), None)
                    if longer:
                        word, last, at = longer, version.end(), version.end()
            push(pending)
            out.append(word)
            operand_next, after_with, pending, whole, end = False, False, None, True, last
    whole &= bool(out) and not depth
    return out + [t for t in reversed(stack) if t != "("], whole, end


def evaluate(tokens: list[str]) -> tuple[set[str], float]:
    """Licences of a postfix expression and its freedom."""
    stack: list[tuple[set[str], float]] = []
    for t in tokens:
        if t not in PRECEDENCE:
            stack.append((set(), UNKNOWN) if t == UNKNOWN_OPERAND else ({t}, freedom(t)))
            continue
        if len(stack) < 2:  # a broken expression
            continue
        (right, b), (left, a) = stack.pop(), stack.pop()
        if t == "with":  # the right side names an exception, not a licence
            stack.append((left, min(1.0, a + 0.2)))
        else:
            stack.append((left | right, max(a, b) if PRECEDENCE[t] == 1 else min(a, b)))
    return (set().union(*(found for found, _ in stack)), stack[0][1]) if stack else (set(), UNKNOWN)


def read_expression(text: str, start: int = 0, stop: int | None = None) -> tuple[set[str], float | None, str]:
    """Licences named, freedom (None if the expression is broken or empty), and the expression itself."""
    tokens, whole, end = postfix(text, start, stop)
    found, value = evaluate(tokens)
    return found, value if whole else None, text[start:end].strip(" :\t\r")


def read_tagged(text: str, start: int, stop: int, weak: bool) -> tuple[set[str], float | None, str]:
    """The expression that a tag which ends at `start` announces, or the licence that an URL after it names."""
    gap = BETWEEN.match(text, start, stop)
    if weak and not SIGN.search(gap[0]):
        return set(), None, ""
    # An opening bracket belongs to the expression.
    begin = start + len(gap[0].rstrip("(")) if gap[0].endswith("(") else gap.end()
    if url := LICENSE_URL.match(text, gap.end(), stop):
        name = (url["osi"] or url["spdx"] or (f"cc-{url['cc']}-{url['version']}" if url["version"] else f"cc-{url['cc']}" if url["cc"] else "cc0-1.0")).lower().rstrip(".")
        return ({name}, freedom(name), url[0]) if IDENTIFIER.fullmatch(name) else (set(), None, "")
    return read_expression(text, begin, stop)


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    """One automaton of all phrases; a phrase's value has its base label, its own label and, for tags, whether it is weak (each or None)."""
    values: dict[str, list] = {}
    for phrase, label in BASE.items():
        values.setdefault(phrase, [None, None, None])[0] = label
    for phrase, label in (NOTICES | spelt_out()).items():
        values.setdefault(phrase, [None, None, None])[1] = label
    for phrase, weak in TAGS.items():
        values.setdefault(phrase, [None, None, None])[2] = weak
    out = ahocorasick.Automaton()
    for phrase, (base, own, weak) in values.items():
        out.add_word(f" {phrase} ", (len(phrase) + 1, base, own, weak))
    out.make_automaton()
    return out


@dataclass
class Scan:
    n_words: int
    n_base: int
    first_word: int | None
    last_word: int | None
    base_labels: set[str]
    labels: set[str]
    expressions: list[str]
    score: float


def scan(raw: bytes) -> Scan:
    """Everything about one text."""
    words = raw.translate(WORD_TABLE).split()
    joined = b" ".join([b"", *words, b""]).decode()
    starts, base, labels, expressions, scores = [], set(), set(), [], []
    notices: list[tuple[int, int, str]] = []  # start, minus end, label of the method's own phrases
    spaces: list[int] = []  # where the space before each word stands
    text, ends, line_end = "", [], -1

    def position(at: int) -> int:
        if not spaces:
            spaces.extend(accumulate((len(w) + 1 for w in joined[1:-1].split(" ")), initial=0))
        return bisect_left(spaces, at)

    for end, (length, base_label, own, weak) in automaton().iter(joined):
        if base_label:
            starts.append(end - length)  # the space before the phrase
            base.add(base_label)
        if base_label:
            labels.add(base_label)
            scores.append(freedom(base_label))
        if own:
            notices.append((end - length, -end, own))
        if weak is not None:
            if not ends:
                text = raw.decode()
                ends = [m.end() for m in RAW_WORD.finditer(text)]
            start = ends[position(end) - 1]
            if start > line_end:
                found_end = text.find("\n", start)
                line_end = len(text) if found_end < 0 else found_end
            found, value, expression = read_tagged(text, start, line_end, weak)
            if not found:
                continue
            expressions.append(expression)
            labels |= found
            scores += [value] if value is not None else [freedom(x) for x in found]
    reach = 0
    for _, minus_end, own in sorted(notices):  # a notice inside a longer one is the longer one
        if -minus_end > reach:
            reach = -minus_end
            labels.add(own)
            scores.append(freedom(own))
    first, last = (position(f(starts)) if starts else None for f in (min, max))
    return Scan(len(words), len(starts), first, last, base, labels, expressions, min(scores, default=UNKNOWN))


def scan_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, expressions array<string>."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [scan(x) for x in texts(batch.column(1))]
        joined = lambda xs: pa.array([",".join(sorted(x)) for x in xs], pa.string())
        numbers = [pa.array([getattr(s, c) for s in found], pa.int64()) for c in ("n_words", "n_base", "first_word", "last_word")]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), *numbers, joined(s.base_labels for s in found), joined(s.labels for s in found), pa.array([s.score for s in found], pa.float64()), pa.array([s.expressions for s in found], pa.list_(pa.string()))],
            ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "expressions"],
        )

    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, expressions array<string>"
    return map_batches(docs.select(F.col("doc_id").cast("long"), "text"), work, schema, "text")
