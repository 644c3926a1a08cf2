"""License scans: ordered signature rules with keyword gates and containment suppression.

A text's words are read once; rules run on the words joined by single spaces, so white space, case and
punctuation never matter. Each rule is a regex with keywords: it runs only on texts that hold one of its
keywords as a word. A rule with a lower rank is more specific. Of two detections where one interval lies in
the other, the one of lower rank stays (ties: the longer, then the earlier rule). Base phrases are counted
on their own and their labels are never suppressed.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import bounded_batches, lean

#: Bytes that stand between words become blanks, A-Z become a-z.
_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else 32 if b <= 0x2F or 0x3A <= b <= 0x60 or 0x7B <= b <= 0x7F else b
    for b in range(256)
)
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


@dataclass(frozen=True)
class Rule:
    label: str
    rank: int
    weight: float
    keywords: tuple[bytes, ...]
    regex: re.Pattern


def _rule(label: str, rank: int, weight: float, keywords: str, pattern: str) -> Rule:
    return Rule(
        label, rank, weight, tuple(k.encode() for k in keywords.split()), re.compile(rf" (?:{pattern})(?= )".encode())
    )


def rules() -> list[Rule]:
    """The signatures, most specific first. Versions are words: ``4.0`` reads ``4 0``."""
    out: list[Rule] = []
    add = lambda *a: out.append(_rule(*a))
    licensed = r"(?:licensed|released|available|distributed|published|provided) under (?:the )?(?:terms of (?:the )?)?"

    for parts in ("nc sa", "nc nd", "nc", "sa", "nd", ""):
        name = "cc-by" + "".join("-" + p for p in parts.split())
        short = " ".join(["cc by", *parts.split()])
        words = {"nc": "non ?commercial", "sa": "share ?alike", "nd": "no ?deriv(?:ative)?s?(?: works)?"}
        long = "creative commons attribution" + "".join(f" {words[p]}" for p in parts.split())
        for version in ("1 0", "2 0", "2 5", "3 0", "4 0"):
            label = f"{name}-{version.replace(' ', '.')}"
            add(label, 10, 0.99, "cc", f"{licensed}{short} {version}")
            add(label, 12, 0.95, "cc", f"{short} {version}")
            add(label, 12, 0.97, "creative", f"{long}(?: \\w+)? {version}(?: international| unported| generic)?")
            add(label, 11, 0.99, "creativecommons", f"creativecommons org licenses by{''.join(' ' + p for p in parts.split())} {version}")
        add(name, 30, 0.8, "cc", short)
        add(name, 31, 0.85, "creative", long)
    add("cc0-1.0", 12, 0.97, "cc0", "cc0(?: 1 0)?(?: universal)?")
    add("cc0-1.0", 12, 0.97, "creativecommons", "creativecommons org publicdomain zero 1 0")
    add("cc-pdm-1.0", 12, 0.95, "creativecommons", "creativecommons org publicdomain mark 1 0")

    for name, words in (("agpl", "affero general public license"), ("lgpl", "lesser general public license"), ("gpl", "general public license")):
        for version in ("1", "2", "2 1", "3"):
            keys = f"{name} {name}v{version[0]} {name}{version[0]}"
            tag = f"{name}-{version.replace(' ', '.') if ' ' in version else version + '.0'}"
            spoken = version if " " in version else f"{version}(?: 0)?"
            add(f"{tag}-or-later", 13, 0.98, keys, f"(?:gnu )?{name} ?v? ?{spoken} or (?:any )?later(?: version)?")
            add(f"{tag}-or-later", 13, 0.99, "general", f"(?:gnu )?{words} (?:as published by the free software foundation )?(?:either )?v(?:ersion )?{spoken} (?:of the license )?or (?:at your option )?any later version")
            add(f"{tag}-only", 14, 0.97, keys, f"(?:gnu )?{name} ?v? ?{spoken} only")
            add(tag, 16, 0.92, keys, f"(?:gnu )?{name} v? ?{spoken}")
            add(tag, 16, 0.9, f"{name}v{version.split()[0]}", f"{name}v{spoken}")
            add(tag, 15, 0.97, "general", f"(?:gnu )?{words} v(?:ersion )?{spoken}")
        add(name, 33, 0.85, "general", f"(?:gnu )?{words}")
        add(name, 34, 0.6, name, f"(?:gnu )?{name}")

    for label, keys, pattern in (
        ("apache-2.0", "apache", "apache(?: software)? licen[sc]e (?:v(?:ersion )?)?2(?: 0)?"),
        ("apache-2.0", "apache", "apache 2(?: 0)?"),
        ("apache-1.1", "apache", "apache(?: software)? licen[sc]e (?:v(?:ersion )?)?1 1"),
        ("apache-1.0", "apache", "apache(?: software)? licen[sc]e (?:v(?:ersion )?)?1 0"),
        ("mpl-2.0", "mozilla", "mozilla public licen[sc]e (?:v(?:ersion )?)?2 0"),
        ("mpl-1.1", "mozilla", "mozilla public licen[sc]e (?:v(?:ersion )?)?1 1"),
        ("mpl-1.0", "mozilla", "mozilla public licen[sc]e (?:v(?:ersion )?)?1 0"),
        ("mpl-2.0", "mpl", "mpl 2 0"),
        ("mpl-1.1", "mpl", "mpl 1 1"),
        ("epl-2.0", "eclipse", "eclipse public licen[sc]e (?:v(?:ersion )?)?2 0"),
        ("epl-1.0", "eclipse", "eclipse public licen[sc]e (?:v(?:ersion )?)?1 0"),
        ("eupl-1.2", "european", "european union public licen[sc]e (?:v(?:ersion )?)?1 2"),
        ("eupl-1.1", "european", "european union public licen[sc]e (?:v(?:ersion )?)?1 1"),
        ("cddl-1.0", "cddl", "cddl(?: v(?:ersion)?)? 1 0"),
        ("cddl-1.0", "common", "common development and distribution licen[sc]e(?: 1 0)?"),
        ("cpl-1.0", "common", "common public licen[sc]e(?: v(?:ersion )?1 0)?"),
        ("artistic-2.0", "artistic", "artistic licen[sc]e 2 0"),
        ("artistic-1.0", "artistic", "artistic licen[sc]e(?: 1 0)?"),
        ("bsl-1.0", "boost", "boost software licen[sc]e(?: v(?:ersion )?1 0)?"),
        ("busl-1.1", "business", "business source licen[sc]e(?: 1 1)?"),
        ("sspl-1.0", "server", "server side public licen[sc]e"),
        ("ms-pl", "microsoft", "microsoft public licen[sc]e"),
        ("ms-rl", "microsoft", "microsoft reciprocal licen[sc]e"),
        ("zlib", "zlib", "zlib(?: libpng)? licen[sc]e"),
        ("isc", "isc", "isc licen[sc]e"),
        ("wtfpl", "wtfpl", "wtfpl"),
        ("unlicense", "unlicense", "(?:the )?unlicense"),
        ("psf-2.0", "python", "python software foundation licen[sc]e(?: v(?:ersion )?2)?"),
        ("ruby", "ruby", "ruby licen[sc]e"),
        ("php-3.01", "php", "php licen[sc]e(?: v(?:ersion )?3 01)?"),
        ("openssl", "openssl", "openssl licen[sc]e"),
        ("postgresql", "postgresql", "postgresql licen[sc]e"),
        ("ofl-1.1", "font", "(?:sil )?open font licen[sc]e(?: v(?:ersion )?1 1)?"),
        ("odbl-1.0", "odbl", "odbl(?: 1 0)?"),
        ("odbl-1.0", "database", "open database licen[sc]e(?: v?1 0)?"),
        ("odc-by-1.0", "data", "open data commons attribution licen[sc]e(?: v?1 0)?"),
        ("pddl-1.0", "domain", "public domain dedication and licen[sc]e(?: v?1 0)?"),
        ("ogl-uk-3.0", "government", "open government licen[sc]e(?: v?3 0)?"),
        ("gfdl-1.3", "documentation", "(?:gnu )?free documentation licen[sc]e (?:v(?:ersion )?)?1 3"),
        ("gfdl-1.2", "documentation", "(?:gnu )?free documentation licen[sc]e (?:v(?:ersion )?)?1 2"),
        ("mit", "mit", "mit licen[sc]e"),
        ("mit", "mit", f"{licensed}mit"),
        ("mit", "granted", "permission is hereby granted free of charge to any person obtaining a copy"),
        ("isc", "permission", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
        ("bsd-3-clause", "bsd", "(?:new|modified|3 clause|three clause) bsd(?: licen[sc]e)?"),
        ("bsd-3-clause", "bsd", "bsd 3 clause(?: licen[sc]e)?"),
        ("bsd-2-clause", "bsd", "(?:simplified|freebsd|2 clause|two clause) bsd(?: licen[sc]e)?"),
        ("bsd-2-clause", "bsd", "bsd 2 clause(?: licen[sc]e)?"),
        ("bsd-4-clause", "bsd", "(?:original|old|4 clause) bsd(?: licen[sc]e)?"),
        ("0bsd", "bsd", "(?:zero clause|0) bsd"),
        ("bsd-3-clause", "contributors", "neither the name of (?:\\S+ ){1,12}nor the names of its contributors may be used"),
        ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted"),
    ):
        add(label, 15, 0.93, keys, pattern)
    for spdx in (
        "mit", "isc", "zlib", "wtfpl", "unlicense", "0bsd", "apache 2 0", "apache 1 1", "mpl 2 0", "mpl 1 1", "epl 1 0",
        "epl 2 0", "bsd 2 clause", "bsd 3 clause", "bsd 4 clause", "bsl 1 0", "cc0 1 0", "artistic 2 0", "ms pl",
        "gpl 2 0", "gpl 2 0 only", "gpl 2 0 or later", "gpl 3 0", "gpl 3 0 only", "gpl 3 0 or later", "lgpl 2 1",
        "lgpl 2 1 only", "lgpl 2 1 or later", "lgpl 3 0", "lgpl 3 0 only", "lgpl 3 0 or later", "agpl 3 0",
        "agpl 3 0 only", "agpl 3 0 or later", "cc by 4 0", "cc by sa 4 0", "cc by nc 4 0", "odbl 1 0", "ofl 1 1",
    ):
        label = re.sub(r"(\d) (\d)", r"\1.\2", spdx).replace(" ", "-")
        add(label, 5 - min(3, spdx.count(" ")), 0.99, "spdx", f"spdx licen[sc]e identifier {spdx}")
    for label, rank, weight, keys, pattern in (
        ("apache", 35, 0.7, "apache", "apache(?: software)? licen[sc]e"),
        ("mpl", 35, 0.7, "mozilla", "mozilla public licen[sc]e"),
        ("bsd", 35, 0.7, "bsd", "bsd(?: style)? licen[sc]e"),
        ("public-domain", 20, 0.8, "domain", "(?:placed |released |dedicated )?(?:in|into|to) the public domain"),
        ("public-domain", 36, 0.4, "domain", "public domain"),
        ("proprietary", 20, 0.8, "proprietary", "(?:confidential and proprietary|proprietary and confidential)"),
        ("proprietary", 20, 0.7, "reproduced", "(?:may not|must not|cannot) be reproduced"),
        ("proprietary", 20, 0.7, "permission", "without (?:the )?(?:prior )?(?:written|express)? ?permission"),
        ("reserved", 25, 0.8, "reserved", "(?:copyright (?:\\S+ ){0,8})?all rights reserved"),
        ("reserved", 26, 0.6, "reserved", "(?:some|no) rights reserved"),
        ("copyright", 40, 0.5, "copyright", "copyright (?:c )?(?:19|20)\\d\\d(?: (?:19|20)\\d\\d)?(?: by)?"),
        ("copyright", 41, 0.3, "copyright", "copyright"),
        ("free-use", 30, 0.5, "free", "free for (?:personal|educational|non commercial|commercial) use"),
        ("licensed", 45, 0.4, "licensed", "licensed under"),
    ):
        add(label, rank, weight, keys, pattern)
    return out


class Scanner:
    def __init__(self, found: list[Rule] | None = None):
        self.rules = rules() if found is None else found
        self.by_key: dict[bytes, list[int]] = {}
        for k, rule in enumerate(self.rules):
            for key in rule.keywords:
                self.by_key.setdefault(key, []).append(k)
        self.keys = frozenset(self.by_key) | {p.split()[0].encode() for p in BASE}
        self.base = [(f" {p} ".encode(), len(p.split()), label) for p, label in BASE.items()]

    def scan(self, text: str | None) -> tuple:
        words = (text or "").encode("utf-8").translate(_TABLE).split()
        keys = self.keys.intersection(words)
        if not keys:
            return len(words), 0, None, None, "", "", 0.0, []
        line = b" " + b" ".join(words) + b" "
        places, base = [], set()
        for phrase, _, label in self.base:
            at = line.find(phrase)
            while at >= 0:
                places.append(at)
                base.add(label)
                at = line.find(phrase, at + 1)
        hits = []
        for k in sorted({k for key in keys for k in self.by_key.get(key, ())}):
            rule = self.rules[k]
            hits += [(m.start() + 1, m.end(), rule.rank, k) for m in rule.regex.finditer(line)]
        kept = contained(hits)
        labels = base | {self.rules[k].label for _, _, _, k in kept}
        score = 1.0
        for k in {k for _, _, _, k in kept}:
            score *= 1 - self.rules[k].weight
        blanks = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)  # word k begins after blank k
        word = lambda at: np.searchsorted(blanks, np.array(at, np.int64)).tolist()
        starts, ends = word([h[0] - 1 for h in kept]), word([h[1] for h in kept])
        spans = [(self.rules[h[3]].label, a, b) for h, a, b in zip(kept, starts, ends)]
        n = len(places)
        first, last = word([min(places), max(places)]) if n else (None, None)
        return len(words), n, first, last, ",".join(sorted(base)), ",".join(sorted(labels)), 1 - score, spans


def contained(hits: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Of (start, end, rank, rule) keep those that no better one contains or is contained in, sorted by start.

    Only hits that overlap can contain each other, so chains of overlapping hits are judged one by one.
    """
    out: list[tuple[int, int, int, int]] = []
    chain: list[tuple[int, int, int, int]] = []
    reach = -1
    for hit in sorted(hits):
        if hit[0] >= reach and chain:
            out += judged(chain) if len(chain) > 1 else chain
            chain = []
        chain.append(hit)
        reach = max(reach, hit[1])
    return out + (judged(chain) if len(chain) > 1 else chain)


def judged(chain: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """``contained`` within one chain. Of kept intervals none contains another, so they are sorted by start and end
    alike, and a new one need only be held against its neighbours."""
    kept: list[tuple[int, int, int, int]] = []
    starts: list[int] = []
    ends: list[int] = []
    for hit in sorted(chain, key=lambda h: (h[2], h[0] - h[1], h[3], h[0])):
        a, b = hit[:2]
        k = bisect_right(starts, a)
        if k and ends[k - 1] >= b:  # lies in a kept one
            continue
        k = bisect_left(starts, a)
        if k < len(starts) and ends[k] <= b:  # a kept one lies in it
            continue
        kept.insert(k, hit)
        starts.insert(k, a)
        ends.insert(k, b)
    return kept


SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, spans array<struct<label:string,first:int,end:int>>"
)


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row a document: counts, labels, score and ``spans`` (label, first word, word after the last).

    A null or empty text has no words and no labels. Repeated rows give repeated results; an empty table
    gives none; other columns are ignored.
    """

    def step(batches):
        scanner = Scanner()
        for batch in batches:
            rows = [scanner.scan(t.as_py()) for t in batch.column(1)]
            cols = list(zip(*rows)) if rows else [[]] * 8
            kinds = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.float64()]
            spans = pa.array(
                [[{"label": s, "first": a, "end": b} for s, a, b in c] for c in cols[7]],
                pa.list_(pa.struct([("label", pa.string()), ("first", pa.int32()), ("end", pa.int32())])),
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(cols, kinds)], spans],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"],
            )

    bounded_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(lean(step), SCHEMA)


def op9_license_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scanned."""
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("spans")
