"""License scans: paragraphs classified by family, an unknown class, and template comparison.

A paragraph is a line that is a notice by itself, or else a run of further lines between
blank ones and such notices, whose lines are joined, as notices are often wrapped; its number
is that of its first line. It becomes the set of its hashed word n-grams (one to three words, letters
and digits in lower case). Sparse multinomial logistic regression over these, fitted here on
paragraphs generated from the templates and from prose, gives each family's probability and
the unknown class's, calibrated by a temperature on further paragraphs. A family that passes
its threshold is confirmed where the word pairs of one of its templates are contained in the
paragraph to at least CONTAINED. The model has a fixed number of weights.

Defined results: null and empty texts have no paragraphs; paragraphs without any n-gram of
the model are unknown and give no row; a paragraph of several licenses gives the likeliest;
equal lines of a text give a row each; an empty table gives an empty one; columns other than
the key are not read.
"""

from __future__ import annotations

import random
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

BUCKETS = 1 << 15
CONTAINED, THRESHOLD = 0.6, 0.5
_WORD = re.compile(r"[a-z0-9]+")
#: What a paragraph must hold for any template to be contained in it: a word of each template is here.
_HINT = re.compile(r"licen[sc]e|copyright|public domain|permission|redistribution|warranty|spdx|creative commons|\bcc\b|\bgpl|\bmit\b|apache|bsd|mozilla|unlicense|rights reserved", re.I)
#: Pieces of which each match of the hint holds one; they are found much faster.
_PIECES = ("licens", "licenc", "copyright", "public domain", "permission", "redistribution", "warranty", "spdx", "creative commons", "cc", "gpl", "mit", "apache", "bsd", "mozilla", "rights reserved")


def hinted(text: str) -> bool:
    low = text.lower()
    return any(p in low for p in _PIECES) and bool(_HINT.search(text))


#: License notices by family (fixed texts).
TEMPLATES = {
    "MIT": (
        "Released under the MIT License.",
        "This project is licensed under the MIT License.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    ),
    "LGPL": (
        "This library is licensed under the GNU Lesser General Public License.",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ),
    "AGPL": (
        "Licensed under the GNU Affero General Public License.",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ),
    "BSD": (
        "Licensed under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ),
    "MPL": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC0": (
        "To the extent possible under law, the author has waived all copyright and related rights to this work. CC0 1.0 Universal",
        "SPDX-License-Identifier: CC0-1.0",
    ),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
    "ISC": (
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    ),
    "Proprietary": (
        "Copyright. All rights reserved.",
        "This document is confidential and proprietary. All rights reserved.",
    ),
}
UNKNOWN = "unknown"
FAMILIES = (*TEMPLATES, UNKNOWN)
#: Lines of prose and of law that name no license (fixed texts).
_OTHER = (
    "The committee granted permission to use the hall for any purpose.",
    "She copied the version of the public record and sent it to the office.",
    "All conditions of the agreement are set out in the terms of the contract.",
    "A driving license is required to rent a car in this country.",
    "The copyright law of the state was changed in that year.",
    "No warranty is given by the seller for parts and service.",
    "Use of the source of the river is free to the general public.",
    "Work on the library was released for review by the software team.",
)


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def grams(found: list[str]) -> np.ndarray:
    """Distinct buckets of the runs of one to three words."""
    runs = [" ".join(found[i : i + n]) for n in (1, 2, 3) for i in range(len(found) - n + 1)]
    return np.unique(np.fromiter((zlib.crc32(r.encode()) % BUCKETS for r in runs), np.int64, len(runs)))


def _pairs(found: list[str]) -> set:
    return set(zip(found, found[1:])) or {(w,) for w in found}


_TEMPLATE_PAIRS = {family: [_pairs(words(t)) for t in texts] for family, texts in TEMPLATES.items()}

_ALL_PAIRS = [t for own in _TEMPLATE_PAIRS.values() for t in own]
_ANY_PAIR = frozenset().union(*_ALL_PAIRS)
#: Lines that a notice can be wrapped into, at most: one for each word.
LINES = max(len(words(t)) for texts in TEMPLATES.values() for t in texts)


def may_hold(text: str) -> bool:
    """Whether a template's word pairs are contained to CONTAINED at least; else no paragraph in text is a notice."""
    own = _pairs(words(text)) & _ANY_PAIR
    return bool(own) and any(len(t & own) >= CONTAINED * len(t) for t in _ALL_PAIRS)


def confirmed(family: str, found: list[str]) -> float:
    """The greatest share of a template's word pairs that the paragraph has."""
    own = _pairs(found)
    return max(len(t & own) / len(t) for t in _TEMPLATE_PAIRS[family])


def _paragraphs(n: int, seed: int) -> list[tuple[int, np.ndarray]]:
    r = random.Random(seed)
    prose = lambda k: [r.choice(" ".join(_OTHER).split()) if r.random() < 0.5 else "".join(r.choice("aeioubdnrst") for _ in range(r.randint(2, 9))) for _ in range(k)]
    out = []
    for _ in range(n):
        k = r.randrange(len(FAMILIES) + 8)
        if k >= len(FAMILIES) - 1:
            k = len(FAMILIES) - 1
            text = r.choice(_OTHER).split() if r.random() < 0.4 else prose(r.randint(1, 30))
        else:
            text = r.choice(TEMPLATES[FAMILIES[k]]).split()
            text = [w for w in text if r.random() > 0.05]
            text = prose(r.choice((0, 0, 3, 8))) + text + prose(r.choice((0, 0, 3, 8)))
        out.append((k, grams(words(" ".join(text)))))
    return out


#: Generated paragraphs for the fit, and half as many for calibration.
EXAMPLES, EPOCHS, RATE, SHRINK = 2500, 6, 0.5, 1e-5


@lru_cache(maxsize=1)
def model() -> tuple[np.ndarray, np.ndarray, float]:
    """(weights by bucket and family, offsets, temperature); the same in every process."""
    rows = _paragraphs(EXAMPLES, 1)
    w, b = np.zeros((BUCKETS, len(FAMILIES))), np.zeros(len(FAMILIES))
    seen = np.full(BUCKETS, 1e-2)
    order = np.random.default_rng(3)
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            k, found = rows[i]
            p = _softmax(_margin(w, b, found))
            p[k] -= 1
            scale = 1 / np.sqrt(max(len(found), 1))
            seen[found] += 1
            w[found] -= RATE * (p * scale + SHRINK * w[found]) / np.sqrt(seen[found])[:, None]
            b -= 0.02 * p
    held = _paragraphs(EXAMPLES // 2, 2)
    best = min((0.25, 0.5, 1.0, 1.5, 2.0, 3.0), key=lambda t: -sum(np.log(max(_softmax(t * _margin(w, b, f))[k], 1e-9)) for k, f in held))
    return w.astype(np.float32), b, best


def _margin(w, b, found):
    return 4 * w[found].sum(0) / np.sqrt(max(len(found), 1)) + b


def _softmax(x):
    e = np.exp(x - x.max())
    return e / e.sum()


def classify(line: str, fitted) -> tuple[str, float, float] | None:
    """(family, probability, share of a template) of a paragraph, or None where it is unknown."""
    found = words(line)
    w, b, scale = fitted
    p = _softmax(scale * _margin(w, b, grams(found)))
    k = int(p.argmax())
    if FAMILIES[k] == UNKNOWN or p[k] < THRESHOLD:
        return None
    share = confirmed(FAMILIES[k], found)
    return (FAMILIES[k], float(p[k]), share) if share >= CONTAINED else None


_MARGIN = re.compile(r"^[\s/*#;%!>-]+|[\s*/]+$")


def paragraphs(text: str, fitted):
    """(number of the first line, what classify says) of the notices of a text."""
    run, first = [], 0
    for n, line in enumerate([*text.split("\n"), ""]):
        got = classify(line, fitted) if may_hold(line) else None
        bare = _MARGIN.sub("", line)
        if not got and bare:
            first = first if run else n
            run.append(bare)
            continue
        if len(run) > 1 and may_hold(" ".join(run)):
            for size in range(2, min(len(run), LINES) + 1):
                windows = [" ".join(run[i : i + size]) for i in range(len(run) - size + 1)]
                found = [f for w in windows if may_hold(w) and (f := classify(w, fitted))]
                if found:
                    yield first, *max(found, key=lambda f: f[1])
                    break
        run = []
        if got:
            yield n, *got


def scanned(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, paragraph (from 0, lines without words counted), family, probability, template_share.

    The key goes through as it is, whatever its type and nulls.
    """
    fitted = model()
    kind = docs.schema[key].dataType.simpleString()

    def scan(batches):
        for batch in batches:
            at, rows = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                if text and may_hold(text):
                    found = list(paragraphs(text, fitted))
                    at += [i] * len(found)
                    rows += found
            line, family, probability, share = zip(*rows) if rows else ((), (), (), ())
            columns = [batch.column(0).take(pa.array(at, pa.int64())), pa.array(line, pa.int64()), pa.array(family, pa.string()), pa.array(probability, pa.float64()), pa.array(share, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [key, "paragraph", "family", "probability", "template_share"])

    schema = f"`{key}` {kind}, paragraph long, family string, probability double, template_share double"
    return docs.select(key, "text").mapInArrow(scan, schema)
