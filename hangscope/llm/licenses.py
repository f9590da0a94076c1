"""License scans: ordered signature rules over the words of whole texts.

A text becomes its words (A-Z lower-cased) joined by single spaces.  A rule is
a regex over that form with a label, a priority, a relevance and a keyword; it
runs only where its keyword occurs.  Overlapping detections are resolved in
order of priority (highest first), then length, then rule order: a detection
that lies inside the interval of one kept from the same or a higher priority
is suppressed.  Partial overlaps all stay.

Base phrases are counted at every place where their words stand one after
another, and their labels always stay.

One pass over the texts, no shuffle; memory is one Arrow batch.  Suppression is
O(n log n) in the detections of a text.

Edge cases: null or empty text has no words and no detections; a text of any
length is scanned whole; other columns pass through, except those with the
names of the result's; repeated rows stay repeated.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_arrow, word_list

BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


@dataclass(frozen=True)
class Rule:
    name: str
    label: str
    pattern: str
    keyword: str
    priority: int
    relevance: float


# label, keyword, pattern of the name in words
NAMES = [
    ("agpl-3.0", "affero", r"(?:gnu )?affero general public licen[sc]e (?:version |v)?3(?: 0)?"),
    ("agpl-3.0", "agpl", r"agpl ?v?3(?: 0)?"),
    ("agpl-1.0", "affero", r"affero general public licen[sc]e (?:version |v)?1(?: 0)?"),
    ("agpl", "affero", r"(?:gnu )?affero general public licen[sc]e|affero gpl"),
    ("gpl-3.0", "general public", r"(?:gnu )?general public licen[sc]e(?: gpl)? (?:version |v)?3(?: 0)?"),
    ("gpl-2.0", "general public", r"(?:gnu )?general public licen[sc]e(?: gpl)? (?:version |v)?2(?: 0)?"),
    ("gpl-1.0", "general public", r"(?:gnu )?general public licen[sc]e(?: gpl)? (?:version |v)?1(?: 0)?"),
    ("gpl-3.0", "gpl", r"(?:gnu )?gpl ?(?:version |v)?3(?: 0)?"),
    ("gpl-2.0", "gpl", r"(?:gnu )?gpl ?(?:version |v)?2(?: 0)?"),
    ("gpl", "general public", r"(?:gnu )?general public licen[sc]e"),
    ("gpl", "gnu gpl", r"gnu gpl"),
    ("lgpl-3.0", "lesser", r"(?:gnu )?lesser general public licen[sc]e (?:version |v)?3(?: 0)?"),
    ("lgpl-2.1", "lesser", r"(?:gnu )?lesser general public licen[sc]e (?:version |v)?2 1"),
    ("lgpl-2.0", "library general", r"(?:gnu )?library general public licen[sc]e(?: (?:version |v)?2(?: 0)?)?"),
    ("lgpl-3.0", "lgpl", r"(?:gnu )?lgpl ?(?:version |v)?3(?: 0)?"),
    ("lgpl-2.1", "lgpl", r"(?:gnu )?lgpl ?(?:version |v)?2 1"),
    ("lgpl", "lesser", r"(?:gnu )?lesser general public licen[sc]e"),
    ("lgpl", "gnu lgpl", r"gnu lgpl"),
    ("gfdl-1.3", "free documentation", r"(?:gnu )?free documentation licen[sc]e (?:version |v)?1 3"),
    ("gfdl-1.2", "free documentation", r"(?:gnu )?free documentation licen[sc]e (?:version |v)?1 2"),
    ("gfdl", "free documentation", r"(?:gnu )?free documentation licen[sc]e"),
    ("apache-2.0", "apache", r"apache(?: software)? licen[sc]e (?:version |v)?2(?: 0)?|apache 2 0"),
    ("apache-1.1", "apache", r"apache(?: software)? licen[sc]e (?:version |v)?1 1"),
    ("apache-1.0", "apache", r"apache(?: software)? licen[sc]e (?:version |v)?1 0"),
    ("apache", "apache", r"apache(?: software)? licen[sc]e"),
    ("mit", "mit", r"mit(?: x11| style)? licen[sc]e|x11 mit"),
    ("mit", "expat", r"expat(?: mit)? licen[sc]e"),
    ("mit-0", "mit", r"mit no attribution(?: licen[sc]e)?|mit 0"),
    ("x11", "x11", r"x11 licen[sc]e"),
    ("bsd-2-clause", "bsd", r"(?:2|two) clause bsd(?: licen[sc]e)?|bsd (?:2|two) clause(?: licen[sc]e)?|(?:simplified|freebsd) bsd licen[sc]e"),
    ("bsd-3-clause", "bsd", r"(?:3|three) clause bsd(?: licen[sc]e)?|bsd (?:3|three) clause(?: licen[sc]e)?|(?:new|modified|revised) bsd licen[sc]e"),
    ("bsd-4-clause", "bsd", r"(?:4|four) clause bsd(?: licen[sc]e)?|bsd (?:4|four) clause(?: licen[sc]e)?|original bsd licen[sc]e"),
    ("0bsd", "bsd", r"zero clause bsd(?: licen[sc]e)?|bsd zero clause(?: licen[sc]e)?|0bsd"),
    ("bsd", "bsd", r"bsd(?: style)? licen[sc]e"),
    ("isc", "isc", r"isc licen[sc]e"),
    ("mpl-2.0", "mozilla", r"mozilla public licen[sc]e (?:version |v)?2(?: 0)?"),
    ("mpl-1.1", "mozilla", r"mozilla public licen[sc]e (?:version |v)?1 1"),
    ("mpl-1.0", "mozilla", r"mozilla public licen[sc]e (?:version |v)?1 0"),
    ("mpl", "mozilla", r"mozilla public licen[sc]e"),
    ("mpl-2.0", "mpl", r"mpl ?(?:version |v)?2(?: 0)?"),
    ("epl-2.0", "eclipse", r"eclipse public licen[sc]e (?:version |v)?2(?: 0)?"),
    ("epl-1.0", "eclipse", r"eclipse public licen[sc]e (?:version |v)?1(?: 0)?"),
    ("epl", "eclipse", r"eclipse public licen[sc]e"),
    ("edl-1.0", "eclipse", r"eclipse distribution licen[sc]e(?: (?:version |v)?1(?: 0)?)?"),
    ("cddl-1.1", "development and distribution", r"common development and distribution licen[sc]e (?:version |v)?1 1"),
    ("cddl-1.0", "development and distribution", r"common development and distribution licen[sc]e (?:version |v)?1 0"),
    ("cddl", "development and distribution", r"common development and distribution licen[sc]e"),
    ("cpl-1.0", "common public", r"common public licen[sc]e(?: (?:version |v)?1(?: 0)?)?"),
    ("eupl-1.2", "european union", r"european union public licen[sc]e (?:version |v)?1 2"),
    ("eupl", "european union", r"european union public licen[sc]e"),
    ("artistic-2.0", "artistic", r"artistic licen[sc]e (?:version |v)?2(?: 0)?"),
    ("artistic-1.0", "artistic", r"artistic licen[sc]e(?: (?:version |v)?1(?: 0)?)?"),
    ("boost-1.0", "boost", r"boost software licen[sc]e(?: (?:version |v)?1(?: 0)?)?"),
    ("zlib", "zlib", r"zlib(?: libpng)? licen[sc]e"),
    ("libpng", "libpng", r"libpng licen[sc]e"),
    ("unlicense", "unlicense", r"the unlicense"),
    ("wtfpl", "public licen", r"do what the fuck you want to public licen[sc]e"),
    ("wtfpl", "wtfpl", r"wtfpl"),
    ("postgresql", "postgresql", r"postgresql licen[sc]e"),
    ("openssl", "openssl", r"openssl licen[sc]e"),
    ("php-3.01", "php", r"php licen[sc]e(?: (?:version |v)?3 01)?"),
    ("python-2.0", "python", r"python(?: software foundation)? licen[sc]e(?: (?:version |v)?2)?"),
    ("ruby", "ruby", r"ruby licen[sc]e"),
    ("ms-pl", "microsoft", r"microsoft public licen[sc]e"),
    ("ms-rl", "microsoft", r"microsoft reciprocal licen[sc]e"),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa(?: open source)? licen[sc]e"),
    ("osl-3.0", "open software", r"open software licen[sc]e(?: (?:version |v)?3 0)?"),
    ("afl-3.0", "academic free", r"academic free licen[sc]e(?: (?:version |v)?3 0)?"),
    ("ecl-2.0", "educational community", r"educational community licen[sc]e(?: (?:version |v)?2 0)?"),
    ("ofl-1.1", "open font", r"(?:sil )?open font licen[sc]e(?: (?:version |v)?1 1)?"),
    ("odbl-1.0", "open database", r"open database licen[sc]e(?: (?:version |v)?1 0)?"),
    ("odc-by-1.0", "open data commons", r"open data commons attribution licen[sc]e(?: (?:version |v)?1 0)?"),
    ("bsl-1.1", "business source", r"business source licen[sc]e(?: (?:version |v)?1 1)?"),
    ("sspl-1.0", "server side", r"server side public licen[sc]e(?: (?:version |v)?1)?"),
    ("elastic-2.0", "elastic", r"elastic licen[sc]e(?: (?:version |v)?2 0)?"),
    ("cc0-1.0", "cc0", r"cc0(?: 1 0)?(?: universal)?"),
    ("cc0-1.0", "creative commons zero", r"creative commons zero(?: (?:v ?)?1 0)?"),
    ("public-domain", "public domain", r"(?:in|into) the public domain|public domain dedication"),
    ("proprietary", "all rights", r"all rights reserved"),
    ("commercial", "commercial licen", r"commercial licen[sc]e"),
]
# parts, as words, of the Creative Commons licences; each in the versions below
CC_PARTS = ["by nc nd", "by nc sa", "by nc", "by nd", "by sa", "by"]
CC_LONG = {"by": "attribution", "nc": "non ?commercial", "nd": "no ?deriv(?:ative)?s?(?: works)?", "sa": "share ?alike"}
CC_VERSIONS = ["1 0", "2 0", "2 5", "3 0", "4 0"]
# label, keyword, pattern of running licence text
TEXTS = [
    ("mit", "hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", "permission notice", r"the above copyright notice and this permission notice shall be included in all copies"),
    ("isc", "permission to use", r"permission to use copy modify and or distribute this software for any purpose"),
    ("bsd", "redistribution and use", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", "endorse or promote", r"neither the name of(?: [^ ]+){1,12} may be used to endorse or promote products"),
    ("bsd-4-clause", "advertising materials", r"all advertising materials mentioning features or use of this software"),
    ("gpl", "free software", r"this (?:program|library|file) is free software you can redistribute it and or modify it"),
    ("gpl-or-later", "later version", r"either version [1-3](?: 0| 1)? of the licen[sc]e or at your option any later version"),
    ("apache-2.0", "compliance with", r"you may not use this file except in compliance with the licen[sc]e"),
    ("apache-2.0", "as is", r"distributed on an as is basis without warranties or conditions of any kind"),
    ("mpl-2.0", "source code form", r"this source code form is subject to the terms of the mozilla public licen[sc]e v ?2 0"),
    ("zlib", "altered source", r"altered source versions must be plainly marked as such"),
    ("boost-1.0", "organization obtaining", r"permission is hereby granted free of charge to any person or organization obtaining a copy"),
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("wtfpl", "everyone is permitted", r"everyone is permitted to copy and distribute verbatim or modified copies"),
    ("warranty-disclaimer", "as is", r"(?:software|program|work) is provided (?:by [^ ]+(?: [^ ]+){0,6} )?as is"),
    ("warranty-disclaimer", "merchantability", r"implied warranty of merchantability or fitness for a particular purpose"),
    ("proprietary", "confidential", r"confidential and proprietary"),
    ("free-use", "permission", r"(?:used|reproduced|copied) with(?:out)? permission"),
    ("cc-url", "creativecommons", r"creativecommons org licenses (?:by|nc|nd|sa)(?: (?:by|nc|nd|sa))* [1-4] [05]"),
    ("gpl-url", "gnu org", r"gnu org (?:licenses|copyleft)(?: gpl| lgpl| agpl| fdl)?(?: [23] [01])? html"),
    ("apache-url", "apache org", r"apache org licenses license 2 0"),
    ("mit-url", "opensource org", r"opensource org licenses mit(?: license)?"),
]
VERB = r"(?:licen[sc]ed|released|distributed|available|published|provided|made available|shared|covered)"
NOTICE = VERB + r"(?: [^ ]+){{0,3}}? (?:under|by|with)(?: the)?(?: terms(?: and conditions)?(?: of)?)?(?: the| an?)? (?:{name})(?: licen[sc]e)?(?: international| unported)?(?: or(?: at your option)?(?: any)? later(?: version)?)?"


def _rules() -> list[Rule]:
    names = list(NAMES)
    for parts in CC_PARTS:
        long = " ".join(CC_LONG[p] for p in parts.split())
        label = "cc-" + parts.replace(" ", "-")
        for v in CC_VERSIONS:
            names.append((f"{label}-{v.replace(' ', '.')}", "cc by", rf"cc {parts} {v}"))
            names.append((f"{label}-{v.replace(' ', '.')}", "creative commons", rf"creative commons {long}(?: licen[sc]e)? {v}"))
        names.append((label, "cc by", rf"cc {parts}"))
        names.append((label, "creative commons", rf"creative commons {long}"))
    rules = [Rule(f"text-{i}", label, p, kw, 4, 0.95) for i, (label, kw, p) in enumerate(TEXTS)]
    rules += [Rule(f"spdx-{label}", label, rf"spdx license identifier {re.escape(label).replace('\\-', ' ').replace('\\.', ' ')}(?: only| or later)?",
                   "spdx", 5, 1.0) for label in dict.fromkeys(n[0] for n in names)]
    rules += [Rule(f"notice-{i}", label, NOTICE.format(name=p), kw, 3, 0.9) for i, (label, kw, p) in enumerate(names)]
    rules += [Rule(f"name-{i}", label, p, kw, 2, 0.6) for i, (label, kw, p) in enumerate(names)]
    return rules


RULES = _rules()


class Scanner:
    """Rules by keyword, compiled on first use."""

    def __init__(self, rules: list[Rule], base: dict[str, str]):
        self.rules, self.base, self.compiled = rules, [(f" {p} ".encode(), label) for p, label in base.items()], {}
        self.by_keyword: dict[bytes, list[int]] = {}
        for i, r in enumerate(rules):
            self.by_keyword.setdefault(r.keyword.encode(), []).append(i)

    def _find(self, i: int, joined: bytes):
        if i not in self.compiled:
            self.compiled[i] = re.compile(rb"(?<= )(?:" + self.rules[i].pattern.encode() + rb")(?= )")
        return self.compiled[i].finditer(joined)

    def scan(self, text: str | None) -> tuple[int, list[dict]]:
        """Number of words, and the detections with their word intervals, in text order."""
        words = word_list(text)
        joined = b" " + b" ".join(words) + b" "
        found = []  # first byte, end byte, rule (or None), label, priority, relevance
        for phrase, label in self.base:
            at = joined.find(phrase)
            while at >= 0:
                found.append((at + 1, at + len(phrase) - 1, None, label, 1, 0.5))
                at = joined.find(phrase, at + 1)
        for kw, ids in self.by_keyword.items():
            if kw in joined:
                for i in ids:
                    r = self.rules[i]
                    found += [(m.start(), m.end(), r.name, r.label, r.priority, r.relevance) for m in self._find(i, joined)]
        if not found:
            return len(words), []
        gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
        first = np.searchsorted(gaps, [x[0] for x in found]) - 1
        last = np.searchsorted(gaps, [x[1] for x in found]) - 1
        kept = suppress(first, last, np.array([x[4] for x in found]))
        out = [{"rule": x[2], "label": x[3], "first": int(f), "last": int(e), "relevance": x[5], "base": x[2] is None, "kept": bool(k)}
               for x, f, e, k in zip(found, first, last, kept)]
        return len(words), sorted(out, key=lambda d: (d["first"], d["last"], d["label"], d["rule"] or ""))


def suppress(first: np.ndarray, last: np.ndarray, priority: np.ndarray) -> np.ndarray:
    """True where no interval kept from the same or a higher priority contains the interval (of equal ones the earliest stays)."""
    kept = np.zeros(len(first), bool)
    for p in sorted(set(priority.tolist()), reverse=True):
        held = np.flatnonzero(kept)
        held = held[np.argsort(first[held], kind="stable")]
        starts, reach = first[held], np.maximum.accumulate(last[held]) if len(held) else last[held]
        own = np.flatnonzero(priority == p)
        before = np.searchsorted(starts, first[own], side="right")
        inside = np.zeros(len(own), bool)
        some = before > 0
        inside[some] = reach[before[some] - 1] >= last[own[some]]
        own = own[~inside]
        most = -1
        for i in own[np.lexsort((own, -last[own], first[own]))]:
            if last[i] > most:
                kept[i], most = True, last[i]
    return kept


DETECTION = T.StructType([T.StructField("rule", T.StringType()), T.StructField("label", T.StringType()), T.StructField("first", T.LongType()),
                          T.StructField("last", T.LongType()), T.StructField("relevance", T.DoubleType()), T.StructField("base", T.BooleanType()),
                          T.StructField("kept", T.BooleanType())])


def scan_licenses(docs: DataFrame, text: str = "text", rules: list[Rule] = RULES, base: dict[str, str] = BASE) -> DataFrame:
    """``docs`` without ``text``, with ``n_words`` and the ``detections`` of each whole text (suppressed ones flagged)."""
    others = [f for f in docs.schema.fields if f.name not in (text, "n_words", "detections")]
    schema = T.StructType([*others, T.StructField("n_words", T.LongType()), T.StructField("detections", T.ArrayType(DETECTION))])
    kind = pa.list_(pa.struct([("rule", pa.string()), ("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()),
                               ("relevance", pa.float64()), ("base", pa.bool_()), ("kept", pa.bool_())]))

    def run(batches):
        scanner = Scanner(rules, base)
        for b in batches:
            got = [scanner.scan(t.as_py()) for t in b.column(0)]
            yield [*b.columns[1:], pa.array([n for n, _ in got], pa.int64()), pa.array([d for _, d in got], kind)]

    return map_arrow(docs.select(F.col(f"`{text}`"), *[F.col(f"`{f.name}`") for f in others]), run, schema)


def license_columns(scanned: DataFrame) -> DataFrame:
    """Counts, bounds, labels and score from ``detections``."""
    d = F.col("detections")
    base = F.filter(d, lambda x: x["base"])
    kept = F.filter(d, lambda x: x["kept"])
    names = lambda xs: F.array_join(F.array_sort(F.array_distinct(F.transform(xs, lambda x: x["label"]))), ",")
    return (scanned.withColumn("n_base", F.size(base).cast("long"))
            .withColumn("first_word", F.array_min(F.transform(base, lambda x: x["first"])))
            .withColumn("last_word", F.array_max(F.transform(base, lambda x: x["first"])))
            .withColumn("base_labels", names(base)).withColumn("labels", names(F.filter(d, lambda x: x["base"] | x["kept"])))
            .withColumn("score", F.coalesce(F.array_max(F.transform(kept, lambda x: x["relevance"])), F.lit(0.0)))
            .withColumn("n_kept", F.size(kept).cast("long")).drop("detections"))
