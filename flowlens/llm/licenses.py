"""License scans by ordered signature rules.

A rule is a regular expression over the words of a text (lower-cased A-Z; words of 0-9, a-z and all characters from 0x80
on), with a label, a priority, a score and a keyword. A text is only searched for rules whose keyword it holds. Matches
are resolved by priority, then length, then place: a match that lies within one already taken is suppressed.

Base phrases are reported apart, at all their places, and their labels always stay. Null and empty texts have no words
and no labels, with score 0. Repeated rows are scanned alike. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from flowlens.llm.common import slices, small_batches, text_column
from flowlens.llm.words import find_words

# The base phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Label, then the names by which a license is known, as words; a "#" stands for a version number.
NAMES = {
    "afl": ("academic free license #",),
    "agpl": ("gnu affero general public license", "affero general public license", "agpl #"),
    "apache": ("apache license", "apache software license", "apache license version #", "apache #"),
    "artistic": ("artistic license", "perl artistic license", "artistic license #"),
    "boost": ("boost software license", "bsl #"),
    "bsd": ("bsd license", "new bsd license", "modified bsd license", "simplified bsd license", "bsd # clause"),
    "cc-by": ("cc by #", "creative commons attribution license", "creative commons attribution #"),
    "cc-by-nc": ("cc by nc #", "creative commons attribution noncommercial", "creative commons attribution non commercial"),
    "cc-by-nc-nd": ("cc by nc nd #", "creative commons attribution noncommercial noderivatives"),
    "cc-by-nc-sa": ("cc by nc sa #", "creative commons attribution noncommercial sharealike"),
    "cc-by-nd": ("cc by nd #", "creative commons attribution noderivatives", "creative commons attribution no derivatives"),
    "cc-by-sa": ("cc by sa #", "creative commons attribution sharealike", "creative commons attribution share alike"),
    "cc0": ("cc0 #", "cc0", "creative commons zero"),
    "cddl": ("common development and distribution license", "cddl #"),
    "cecill": ("cecill license", "cecill #"),
    "cpl": ("common public license", "cpl #"),
    "ecl": ("educational community license", "ecl #"),
    "epl": ("eclipse public license", "epl #"),
    "eupl": ("european union public license", "european union public licence", "eupl #"),
    "gfdl": ("gnu free documentation license", "gfdl #"),
    "gpl": ("gnu general public license", "general public license", "general public license version #", "gnu gpl", "gpl #"),
    "isc": ("isc license",),
    "lgpl": ("gnu lesser general public license", "lesser general public license", "library general public license", "lgpl #"),
    "mit": ("mit license", "expat license", "x11 license"),
    "mpl": ("mozilla public license", "mpl #"),
    "ms-pl": ("microsoft public license",),
    "odbl": ("open database license", "odbl #"),
    "ofl": ("sil open font license", "open font license"),
    "postgresql": ("postgresql license",),
    "public-domain": ("public domain dedication", "dedicated to the public domain", "released into the public domain"),
    "python": ("python software foundation license", "psf license"),
    "unlicense": ("the unlicense",),
    "wtfpl": ("do what the fuck you want to public license", "wtfpl"),
    "zlib": ("zlib license", "zlib libpng license"),
}
# What a name stands in, as words around "@", with priority and score.
TEMPLATES = (
    ("spdx license identifier @", 90, 1.0),
    ("licensed under the terms of the @", 80, 1.0),
    ("licensed under the @", 70, 0.95),
    ("licensed under @", 70, 0.95),
    ("released under the @", 70, 0.95),
    ("released under @", 70, 0.95),
    ("distributed under the @", 70, 0.95),
    ("available under the @", 60, 0.9),
    ("subject to the @", 60, 0.9),
    ("under the terms of the @", 60, 0.9),
    ("@", 20, 0.6),
)
# Phrases of license texts, with label, priority and score.
PHRASES = (
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit", 50, 0.9),
    ("redistribution and use in source and binary forms with or without modification", "bsd", 50, 0.9),
    ("permission to use copy modify and or distribute this software for any purpose", "isc", 50, 0.9),
    ("this is free and unencumbered software released into the public domain", "unlicense", 50, 0.9),
    ("you can redistribute it and or modify it under the terms of the gnu general public license", "gpl", 50, 0.9),
    ("you can redistribute it and or modify it under the terms of the gnu lesser general public license", "lgpl", 55, 0.9),
    ("this source code form is subject to the terms of the mozilla public license", "mpl", 50, 0.9),
    ("all rights reserved", "all-rights-reserved", 10, 0.4),
)

_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_W = rb"0-9a-z\x80-\xff"
_GAP = rb"[^" + _W + rb"]+"


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    score: float
    keyword: bytes
    pattern: re.Pattern


def phrase(words: str) -> re.Pattern:
    """The words one after another, whatever stands between; "#" is a version number such as 2 or v2.0."""
    parts = [rb"v?[0-9]+(?:[.][0-9]+)*" if w == "#" else re.escape(w.encode()) for w in words.split()]
    return re.compile(rb"(?<![" + _W + rb"])" + _GAP.join(parts) + rb"(?![" + _W + rb"])")


def keyword_of(words: str) -> bytes:
    """The longest word: where it is missing, the rule can't match."""
    return max(words.replace("#", " ").split(), key=len).encode()


@cache
def rules() -> tuple[Rule, ...]:
    """All names in all templates, and the phrases, highest priority first."""
    made = [
        Rule(label, priority, score, keyword_of(name), phrase(frame.replace("@", name)))
        for label, names in NAMES.items()
        for name in names
        for frame, priority, score in TEMPLATES
    ]
    made += [Rule(label, priority, score, keyword_of(words), phrase(words)) for words, label, priority, score in PHRASES]
    return tuple(sorted(made, key=lambda r: -r.priority))


@cache
def by_keyword() -> dict[bytes, list[Rule]]:
    found: dict[bytes, list[Rule]] = {}
    for rule in rules():
        found.setdefault(rule.keyword, []).append(rule)
    return found


@cache
def base_patterns() -> tuple[tuple[str, re.Pattern], ...]:
    return tuple((label, phrase(words)) for words, label in BASE.items())


def detect(text: bytes) -> list[tuple[int, int, Rule]]:
    """Matches left after suppression; `text` is lower-cased."""
    found = []
    for keyword, own in by_keyword().items():
        if keyword in text:
            found += [(m.start(), m.end(), rule) for rule in own for m in rule.pattern.finditer(text)]
    found.sort(key=lambda x: (-x[2].priority, x[0] - x[1], x[0], x[2].label))
    taken: list[tuple[int, int, Rule]] = []
    for start, end, rule in found:
        if not any(a <= start and end <= b for a, b, _ in taken):
            taken.append((start, end, rule))
    return taken


def scan(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: id, word count, base places and labels, all labels, score, detections; no shuffle."""
    small_batches(df.sparkSession)
    rows = df.select(doc_id, text)
    schema = (
        f"{doc_id} {dict(rows.dtypes)[doc_id]}, n_words long, n_base long, first_word long, last_word long, base_labels string,"
        " labels string, score double, n_detections long"
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            words = find_words(text_column(batch, text), lower=True, is_word=_IS_WORD)
            whole, counts = words.data.tobytes(), words.counts
            out: list[tuple] = []
            for i in range(batch.num_rows):
                a, b = int(words.offsets[i]), int(words.offsets[i + 1])
                own = whole[a:b]
                places: list[int] = []
                base: set[str] = set()
                if b"license" in own:
                    for label, pattern in base_patterns():
                        hits = [m.start() for m in pattern.finditer(own)]
                        places += hits
                        base |= {label} if hits else set()
                taken = detect(own)
                at = np.searchsorted(words.starts, np.array(places, dtype=np.int64) + a) - words.first[i]
                labels = base | {rule.label for _, _, rule in taken}
                score = max([1.0 if base else 0.0, *(rule.score for _, _, rule in taken)])
                out.append((
                    len(places), int(at.min()) if len(at) else None, int(at.max()) if len(at) else None,
                    ",".join(sorted(base)), ",".join(sorted(labels)), score, len(taken),
                ))
            columns = list(zip(*out, strict=True))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.int64())
            arrays = [batch.column(0), pa.array(counts, pa.int64())]
            arrays += [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            names = [doc_id, "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "n_detections"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return rows.mapInArrow(work, schema)
