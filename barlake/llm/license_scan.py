"""License scans: ordered signature rules behind a keyword prefilter (operator 2).

A text without any of the words that every match holds one of is left alone; most texts go this
way. In the others, one pattern per form finds the places where any license name completes the form, and
only there each rule's own regular expression runs, so that the detections are those of every rule run
over the whole text. Of overlapping detections the one of higher
priority wins: a detection inside the interval of a kept one is suppressed (so "apache license" says
nothing more inside "licensed under the apache license, version 2.0").

Rules are license names times forms of statement, in the order of their priorities.
Apart from the rules, the base phrases are found as consecutive words.

A null text is empty: no words, no detections, score 0. Rows are judged one by one.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from barlake.llm.text import ALNUM_TABLE, column, utf8

# Phrases whose words stand one after the other, and their labels.
BASE_PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# Every match of a rule holds one of these: a text without any of them has no detection.
GATES = [
    *("licen", "released", "distributed", "published", "available", "provided", "covered", "governed"),
    *("apache.org", "gnu.org", "creativecommons", "permission", "redistribution", "domain"),
    *("copyleft", "rights", "proprietary", "commercial"),
]

# No match that ends in the word license is longer.
REACH = 300

# Label, and how the license is called (in lower case; _ is white space).
NAMES = [
    ("mit", r"mit|expat|mit/x11"),
    ("mit-0", r"mit[ -]0|mit no attribution"),
    ("apache-2.0", r"apache(?:_software)?(?:_license)?,?[ -]?(?:_?version)?_?(?:v\.?)?2(?:\.0)?"),
    ("apache-1.1", r"apache(?:_software)?(?:_license)?,?[ -]?(?:_?version)?_?(?:v\.?)?1\.1"),
    ("apache", r"apache(?:_software)?"),
    ("gpl-3.0", r"(?:gnu_)?general_public_license(?:_\(gpl\))?,?_?(?:as_published_by_the_free_software_foundation)?[,;]?_?(?:either_)?(?:version|v\.?)_?3(?:\.0)?"),
    ("gpl-2.0", r"(?:gnu_)?general_public_license(?:_\(gpl\))?,?_?(?:as_published_by_the_free_software_foundation)?[,;]?_?(?:either_)?(?:version|v\.?)_?2(?:\.0)?"),
    ("gpl-1.0", r"(?:gnu_)?general_public_license,?_?(?:version|v\.?)_?1(?:\.0)?"),
    ("gpl-3.0", r"(?:gnu_)?gpl[ -]?(?:version_)?v?\.?3(?:\.0)?(?:-only|-or-later|\+)?"),
    ("gpl-2.0", r"(?:gnu_)?gpl[ -]?(?:version_)?v?\.?2(?:\.0)?(?:-only|-or-later|\+)?"),
    ("gpl", r"(?:gnu_)?gpl"),
    ("gpl", r"(?:gnu_)?general_public"),
    ("lgpl-3.0", r"(?:gnu_)?lesser_general_public_license,?_?(?:version|v\.?)_?3(?:\.0)?"),
    ("lgpl-2.1", r"(?:gnu_)?lesser_general_public_license,?_?(?:version|v\.?)_?2\.1"),
    ("lgpl-3.0", r"(?:gnu_)?lgpl[ -]?v?3(?:\.0)?(?:-only|-or-later|\+)?"),
    ("lgpl-2.1", r"(?:gnu_)?lgpl[ -]?v?2\.1(?:-only|-or-later|\+)?"),
    ("lgpl", r"(?:gnu_)?lgpl"),
    ("lgpl", r"(?:gnu_)?lesser_general_public"),
    ("agpl-3.0", r"(?:gnu_)?affero_general_public_license,?_?(?:version|v\.?)?_?3(?:\.0)?"),
    ("agpl-3.0", r"(?:gnu_)?agpl[ -]?v?3(?:\.0)?(?:-only|-or-later|\+)?"),
    ("agpl", r"(?:gnu_)?affero_general_public"),
    ("gfdl-1.3", r"(?:gnu_)?free_documentation_license,?_?version_1\.3"),
    ("gfdl", r"(?:gnu_)?free_documentation"),
    ("bsd-2-clause", r"(?:simplified_bsd|freebsd|bsd[ -]2[ -]clause|2[ -]clause_bsd|two[ -]clause_bsd)"),
    ("bsd-3-clause", r"(?:new_bsd|modified_bsd|revised_bsd|bsd[ -]3[ -]clause|3[ -]clause_bsd|three[ -]clause_bsd)"),
    ("bsd-4-clause", r"(?:original_bsd|bsd[ -]4[ -]clause|4[ -]clause_bsd|four[ -]clause_bsd)"),
    ("0bsd", r"(?:0bsd|bsd[ -]zero[ -]clause|zero[ -]clause_bsd)"),
    ("bsd", r"bsd"),
    ("isc", r"isc"),
    ("mpl-2.0", r"mozilla_public_license,?_?(?:version|v\.?)?_?2(?:\.0)?"),
    ("mpl-1.1", r"mozilla_public_license,?_?(?:version|v\.?)?_?1\.1"),
    ("mpl-2.0", r"mpl[ -]?v?2(?:\.0)?"),
    ("mpl", r"mozilla_public"),
    ("epl-2.0", r"eclipse_public_license,?[ -]?_?(?:version|v\.?)?_?2(?:\.0)?"),
    ("epl-1.0", r"eclipse_public_license,?[ -]?_?(?:version|v\.?)?_?1(?:\.0)?"),
    ("epl", r"eclipse_public"),
    ("cddl-1.0", r"common_development_and_distribution"),
    ("cddl-1.0", r"cddl(?:[ -]?v?1\.0)?"),
    ("eupl-1.2", r"european_union_public_licen[cs]e,?_?(?:version|v\.?)?_?1\.2"),
    ("eupl", r"eupl(?:[ -]?v?1\.[012])?"),
    ("unlicense", r"(?:the_)?unlicense"),
    ("wtfpl", r"wtfpl"),
    ("zlib", r"zlib(?:/libpng)?"),
    ("bsl-1.0", r"boost_software"),
    ("busl-1.1", r"business_source_license(?:_1\.1)?"),
    ("sspl-1.0", r"server_side_public"),
    ("elastic-2.0", r"elastic_license(?:_2\.0|_v2)?"),
    ("artistic-2.0", r"artistic_license,?_?(?:version_)?2\.0"),
    ("artistic", r"artistic"),
    ("python-2.0", r"python_software_foundation"),
    ("ofl-1.1", r"(?:sil_)?open_font_license(?:,?_?version_1\.1)?"),
    ("ms-pl", r"microsoft_public"),
    ("ms-rl", r"microsoft_reciprocal"),
    ("odbl-1.0", r"open_database"),
    ("openrail", r"(?:creativeml_|bigscience_)?open_?rail(?:-m|\+\+-m)?"),
    ("llama", r"llama(?:_\d(?:\.\d)?)?_community"),
    ("cc0-1.0", r"cc0(?:[ -]?1\.0)?(?:_universal)?"),
]

# Creative Commons: variant, its name in full, and the versions, each a rule of its own.
CC_VARIANTS = [
    ("by", r"attribution"),
    ("by-sa", r"attribution[ -]?_?share[ -]?alike"),
    ("by-nd", r"attribution[ -]?_?no[ -]?deriv(?:ative)?s?"),
    ("by-nc", r"attribution[ -]?_?non[ -]?commercial"),
    ("by-nc-sa", r"attribution[ -]?_?non[ -]?commercial[ -]?_?share[ -]?alike"),
    ("by-nc-nd", r"attribution[ -]?_?non[ -]?commercial[ -]?_?no[ -]?deriv(?:ative)?s?"),
]
CC_VERSIONS = ["1.0", "2.0", "2.5", "3.0", "4.0"]

# Forms of a statement, and their priorities.
FORMS = [
    (100, r"spdx[- ]license[- ]identifier:?_?(?:{name})\b"),
    (90, r"(?:licensed|released|distributed|published|available|provided|covered|governed)_(?:to_\w{{1,20}}_)?(?:under|by|through)_(?:the_)?(?:terms_(?:of|and_conditions_of)_)?(?:the_)?(?:{name})\b(?:_licen[cs]e)?"),
    (80, r"(?:licen[cs]e|licen[cs]ing)_?(?:is|:|=|type|name)_?[\"']?(?:the_)?(?:{name})\b(?:_licen[cs]e)?"),
    (70, r"(?:under|subject_to|terms_of)_(?:the_)?(?:{name})_licen[cs]e\b"),
    (60, r"\b(?:{name})_licen[cs]e\b"),
]
# Forms whose matches end in the word license, and this word.
ENDS_IN_LICENSE = {70, 60}
LICENSE = re.compile(r"licen[cs]e\b")

# Statements that name no license, and addresses: priority, label, a word of every match, and the match.
SINGLE = [
    (95, "mit", "opensource.org", r"opensource\.org/licen[cs]es?/mit\b"),
    (95, "apache-2.0", "apache.org", r"apache\.org/licenses/license-2\.0"),
    (95, "gpl-3.0", "gnu.org", r"gnu\.org/licenses/gpl-3\.0"),
    (95, "gpl-2.0", "gnu.org", r"gnu\.org/licenses/(?:old-licenses/)?gpl-2\.0"),
    (95, "gpl", "gnu.org", r"gnu\.org/licenses/gpl\b"),
    (95, "cc0-1.0", "publicdomain", r"creativecommons\.org/publicdomain/zero/1\.0"),
    (85, "mit", "permission", r"permission_is_hereby_granted,_free_of_charge,_to_any_person_obtaining_a_copy"),
    (85, "bsd", "redistribution", r"redistribution_and_use_in_source_and_binary_forms"),
    (75, "public-domain", "domain", r"(?:(?:placed|released|dedicated)_(?:in)?(?:to_)?|in_)(?:the_)?public_domain"),
    (65, "copyleft", "copyleft", r"\bcopyleft\b"),
    (55, "all-rights-reserved", "rights", r"\ball_rights_reserved\b"),
    (50, "proprietary", "proprietary", r"\bproprietary_licen[cs]e\b|\bproprietary_and_confidential\b"),
    (45, "non-commercial", "commercial", r"\bnon-?_?commercial_use_only\b|\bfor_non-?_?commercial_use\b"),
    (40, "no-license", "license", r"\b(?:no|without_(?:a|any))_license\b"),
]


@dataclass(frozen=True)
class Rule:
    number: int
    label: str
    keyword: str | None
    priority: int
    pattern: re.Pattern


def _pattern(source: str) -> re.Pattern:
    return re.compile(source.replace("_", r"\s{1,4}").replace(r"\s{1,4}?", r"\s{0,4}"))


@lru_cache(maxsize=1)
def _names() -> list[tuple[str, str]]:
    names = [*NAMES]
    for variant, full in CC_VARIANTS:
        for version in CC_VERSIONS:
            short = rf"cc[ -]{variant.replace('-', '[ -]')}[ -]{re.escape(version)}"
            long = rf"creative_commons_{full}_{re.escape(version)}(?:_international|_unported)?"
            names.append((f"cc-{variant}-{version}", short))
            names.append((f"cc-{variant}-{version}", long))
    return names


@lru_cache(maxsize=1)
def rules() -> list[Rule]:
    """All rules, highest priority first, names in their order within one; those of the forms have no keyword."""
    made = [(priority, label, None, form.format(name=name)) for priority, form in FORMS for label, name in _names()]
    made += SINGLE
    for variant, _ in CC_VARIANTS:
        for version in CC_VERSIONS:
            address = rf"creativecommons\.org/licenses/{variant}/{re.escape(version)}"
            made.append((95, f"cc-{variant}-{version}", "creativecommons", address))
    made.sort(key=lambda r: -r[0])
    return [Rule(n, label, keyword, priority, _pattern(source)) for n, (priority, label, keyword, source) in enumerate(made)]


@lru_cache(maxsize=1)
def _forms() -> list[tuple[re.Pattern, list[Rule], bool]]:
    """Per form a pattern of the places where one of its rules matches, its rules, and whether matches end in license."""
    every = "|".join(name for _, name in _names())
    return [
        (
            _pattern(f"(?={form.format(name=every)})"),
            [r for r in rules() if r.priority == priority and r.keyword is None],
            priority in ENDS_IN_LICENSE,
        )
        for priority, form in FORMS
    ]


def _before_license(text: str) -> list[tuple[int, int]]:
    """Where matches that end in the word license lie, overlapping ranges joined."""
    out: list[list[int]] = []
    for match in LICENSE.finditer(text):
        lo, hi = max(0, match.start() - REACH), match.end()
        if out and lo <= out[-1][1]:
            out[-1][1] = hi
        else:
            out.append([lo, hi])
    return [(lo, hi) for lo, hi in out]


def _matches(text: str) -> Iterator[tuple[Rule, int, int]]:
    """What ``finditer`` of every rule finds in the whole text."""
    for rule in rules():
        if rule.keyword is not None and rule.keyword in text:
            yield from ((rule, m.start(), m.end()) for m in rule.pattern.finditer(text))
    before = _before_license(text)
    for places, named, ends in _forms():
        ranges = before if ends else [(0, len(text))]
        starts = [m.start() for lo, hi in ranges for m in places.finditer(text, lo, hi)]
        if not starts:
            continue
        for rule in named:
            done = 0
            for start in starts:
                if start >= done and (match := rule.pattern.match(text, start)):
                    done = match.end()
                    yield rule, start, done


def detect(text: str) -> list[tuple[str, int, int, int, int]]:
    """Kept detections of a text in lower case: label, rule, start, end, priority, by place."""
    return kept_detections(_matches(text))


def kept_detections(matches: Iterable[tuple[Rule, int, int]]) -> list[tuple[str, int, int, int, int]]:
    found = [(-rule.priority, start - end, start, rule.number, end, rule) for rule, start, end in matches]
    kept: list[tuple[str, int, int, int, int]] = []
    # Kept intervals that lie in no other kept one, by start; their ends ascend as well, so the last
    # that starts at or before a place reaches farthest.
    starts: list[int] = []
    ends: list[int] = []
    for _, _, start, _, end, rule in sorted(found, key=lambda f: f[:5]):
        at = bisect_right(starts, start)
        if at and ends[at - 1] >= end:
            continue
        kept.append((rule.label, rule.number, start, end, rule.priority))
        first = bisect_left(starts, start)
        last = max(first, bisect_right(ends, end))
        starts[first:last], ends[first:last] = [start], [end]
    return sorted(kept, key=lambda d: (d[2], d[3], d[1]))


def base_places(words: list[bytes]) -> list[tuple[int, str]]:
    """Start and label of each base phrase, by place."""
    phrases = [(p.encode().split(), label) for p, label in BASE_PHRASES.items()]
    ends: dict[bytes, list] = {}
    for phrase, label in phrases:
        ends.setdefault(phrase[-1], []).append((phrase, label))
    out = []
    for place, word in enumerate(words):
        for phrase, label in ends.get(word, ()):
            start = place + 1 - len(phrase)
            if start >= 0 and words[start : place + 1] == phrase:
                out.append((start, label))
    return sorted(out)


SCHEMA = (
    "key {key}, n_words long, base array<struct<start:long,label:string>>, "
    "detections array<struct<label:string,rule:int,start:long,end:long,priority:int>>"
)


def scan(docs: DataFrame, key_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document row: ``key``, ``n_words``, the base phrases' word places, and the detections,
    whose starts and ends count characters."""
    rows = docs.select(column(key_col).alias("key"), column(text_col).alias("text"))
    schema = SCHEMA.format(key=rows.schema["key"].dataType.simpleString())
    base_kind = pa.list_(pa.struct([("start", pa.int64()), ("label", pa.string())]))
    found_kind = pa.list_(
        pa.struct(
            [("label", pa.string()), ("rule", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("priority", pa.int32())]
        )
    )
    last_words = [p.rsplit(" ", 1)[-1].encode() for p in BASE_PHRASES]
    gates = [g.encode() for g in GATES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, bases, found = [], [], []
            for text in utf8(batch["text"]):
                plain = text.translate(ALNUM_TABLE)
                words = plain.split()
                counts.append(len(words))
                near = any(w in plain for w in last_words)
                bases.append([{"start": s, "label": x} for s, x in base_places(words)] if near else [])
                lower = text.lower()
                hits = detect(lower.decode("utf-8", "replace")) if any(g in lower for g in gates) else []
                found.append(
                    [{"label": a, "rule": b, "start": s, "end": e, "priority": p} for a, b, s, e, p in hits]
                )
            yield pa.RecordBatch.from_arrays(
                [batch["key"], pa.array(counts, pa.int64()), pa.array(bases, base_kind), pa.array(found, found_kind)],
                ["key", "n_words", "base", "detections"],
            )

    return rows.mapInArrow(run, schema)
