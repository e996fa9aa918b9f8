"""Licence scans by sentence rules.

A sentence begins and ends at line ends, after sentence marks, or at the ends of the text; it is
normalised (lower case, only letters and digits, single spaces) and looked up among known licence
sentences. It may also go on over single line ends, whatever marks of a comment the next line starts
with, but never over a blank line (one without letters and digits); the longest known sentence counts.
A rule is an ordered sequence of sentence identifiers that stands for a licence. The identifiers of
a text, in order, are matched against the rules from left to right, at each place the longest rule
first; sentences that are not known may stand between. Identifiers without a rule are counted but
name no licence.

Defined results: missing and empty texts name nothing; repeated rows and ids are scanned row by
row; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Known licence sentences, as they are usually written.
SENTENCES = {
    "mit-notice": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the MIT License.",
    ),
    "mit-title": ("MIT License", "The MIT License (MIT)"),
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
        "to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    "mit-condition": (
        "The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.",
    ),
    "apache-notice": (
        "Licensed under the Apache License, Version 2.0.",
        "Released under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\");",
        "This work is licensed under the Apache License, Version 2.0.",
    ),
    "apache-compliance": (
        "you may not use this file except in compliance with the License.",
    ),
    "apache-copy": ("You may obtain a copy of the License at",),
    "gpl3-notice": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 3.",
        "Released under the GNU General Public License, version 3.",
    ),
    "gpl-free": ("This program is free software:", "This program is free software"),
    "gpl3-terms": (
        "you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    "bsd-grant": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met:",
    ),
    "bsd-endorse": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written "
        "permission.",
    ),
    "cc-by-nc4-notice": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under CC BY-NC 4.0.",
        "Released under CC BY-NC 4.0.",
    ),
    "cc-by4-notice": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under CC BY 4.0.",
        "Released under CC BY 4.0.",
    ),
    "spdx-mit": ("SPDX-License-Identifier: MIT",),
    "spdx-apache": ("SPDX-License-Identifier: Apache-2.0",),
    "spdx-gpl3": ("SPDX-License-Identifier: GPL-3.0-only",),
}
# Ordered rules.
RULES = (
    (("mit-notice",), "MIT"),
    (("mit-grant", "mit-condition"), "MIT"),
    (("mit-title", "mit-grant", "mit-condition"), "MIT"),
    (("spdx-mit",), "MIT"),
    (("apache-notice",), "Apache-2.0"),
    (("apache-notice", "apache-compliance"), "Apache-2.0"),
    (("apache-notice", "apache-compliance", "apache-copy"), "Apache-2.0"),
    (("spdx-apache",), "Apache-2.0"),
    (("gpl3-notice",), "GPL-3.0"),
    (("gpl-free", "gpl3-terms"), "GPL-3.0"),
    (("spdx-gpl3",), "GPL-3.0"),
    (("bsd-grant", "bsd-endorse"), "BSD-3-Clause"),
    (("bsd-grant",), "BSD-2-Clause"),
    (("cc-by-nc4-notice",), "CC-BY-NC-4.0"),
    (("cc-by4-notice",), "CC-BY-4.0"),
)
# Further licences by notice, by SPDX identifier, and by the sentences of their texts.
_NOTICES = {
    "GPL-2.0": "the GNU General Public License, version 2",
    "LGPL-2.1": "the GNU Lesser General Public License, version 2.1",
    "LGPL-3.0": "the GNU Lesser General Public License, version 3",
    "AGPL-3.0": "the GNU Affero General Public License, version 3",
    "MPL-2.0": "the Mozilla Public License, version 2.0",
    "BSD-2-Clause": "the BSD 2-Clause License",
    "BSD-3-Clause": "the BSD 3-Clause License",
    "ISC": "the ISC License",
    "Unlicense": "the Unlicense",
    "CC-BY-SA-4.0": "CC BY-SA 4.0",
    "CC-BY-ND-4.0": "CC BY-ND 4.0",
    "CC-BY-NC-SA-4.0": "CC BY-NC-SA 4.0",
    "CC-BY-NC-ND-4.0": "CC BY-NC-ND 4.0",
}
_GNU = ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0")
_SPDX = {
    **{f"{name}{end}": name for name in _GNU for end in ("", "-only", "-or-later")},
    **{name: name for name in (*_NOTICES, "CC-BY-4.0", "CC-BY-NC-4.0") if name not in _GNU},
}
_TERMS = (
    "you can redistribute it and/or modify it under the terms of the GNU {} as published by the "
    "Free Software Foundation; either version {} of the License, or (at your option) any later version."
)
_TEXTS = {
    "GPL-2.0": (_TERMS.format("General Public License", "2"),),
    "GPL-3.0": (_TERMS.format("General Public License", "3"),),
    "LGPL-2.1": (_TERMS.format("Lesser General Public License", "2.1"),),
    "LGPL-3.0": (_TERMS.format("Lesser General Public License", "3"),),
    "AGPL-3.0": (_TERMS.format("Affero General Public License", "3"),),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    "ISC": tuple(
        f"Permission to use, copy, modify, {word} distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies."
        for word in ("and/or", "and")
    ),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
}


def _further():
    for name, work in _NOTICES.items():
        begins = ("Licensed under", "Released under", "This work is licensed under")
        yield f"{name.lower()}-notice", tuple(f"{b} {work}." for b in begins), name
    for spdx, name in _SPDX.items():
        if spdx != "GPL-3.0-only":  # stands above
            yield f"spdx-{spdx.lower()}", (f"SPDX-License-Identifier: {spdx}",), name
    for name, some in _TEXTS.items():
        if name != "GPL-3.0":
            yield f"{name.lower()}-text", some, name


SENTENCES["gpl3-terms"] += _TEXTS["GPL-3.0"]
SENTENCES["gpl-free"] += ("This library is free software:",)
for _name, _some, _licence in _further():
    SENTENCES[_name] = _some
    RULES += (((_name,), _licence),)

_CUT = re.compile(r"[\r\n]+|(?<=[.!?;:])\s+")
_OTHER = re.compile(r"[^\w]+|_+")
_BEGIN = re.compile(r"([\r\n.!?;:][\W_]*+)([^\W_]*)")
_EDGE = re.compile(r"[\r\n]|[.!?;:]\s")
_WORD = re.compile(r"([\W_]*+)([^\W_]*)")
_MARK = re.compile(r"[.!?;:]\s")
_LINE = re.compile(r"\r*\n|\r")


def normal_sentence(sentence: str) -> str:
    return _OTHER.sub(" ", sentence.lower()).strip()


def sentence_index(sentences: dict = SENTENCES) -> dict[str, str]:
    return {normal_sentence(s): name for name, some in sentences.items() for s in some}


class Scan:
    def __init__(self, sentences: dict = SENTENCES, rules: tuple = RULES):
        # Known sentences word by word; under "" stands the name of the sentence that ends there,
        # under ":" what follows a sentence mark inside of one.
        self.known: dict = {}
        for name, some in sentences.items():
            for sentence in some:
                parts = [n for n in map(normal_sentence, _CUT.split(sentence)) if n]
                for normal in (" ".join(parts), " : ".join(parts)):
                    node = self.known
                    for word in normal.split(" "):
                        node = node.setdefault(word, {})
                    node[""] = name
        self.by_first: dict[str, list] = {}
        for names, licence in sorted(rules, key=lambda r: -len(r[0])):
            self.by_first.setdefault(names[0], []).append((names, licence))

    def _longest(self, text: str, at: int) -> tuple[str | None, int]:
        """Name and end of the longest known sentence whose first word starts at ``at``."""
        node, name, end = self.known, None, at
        while True:
            found = _WORD.match(text, at)
            node = node.get(found[2]) if found[2] else None
            if node is None:
                return name, end
            at = found.end()
            gap = _WORD.match(text, at)
            lines = _LINE.split(gap[1], maxsplit=2)
            # Marks at the start of the next line are those of a comment.
            mark = _MARK.search(lines[0] + "\n" if len(lines) > 1 else lines[0])
            if mark or len(lines) > 1 or not gap[2]:
                if "" in node:
                    name, end = node[""], at
                if len(lines) > 2:
                    return name, end
                if mark and (node := node.get(":")) is None:
                    return name, end

    def identifiers(self, text: str) -> list[str]:
        text, at, found = "\n" + text.lower(), 0, []
        while begin := _BEGIN.search(text, at):
            at = begin.end()
            if begin[2] in self.known and _EDGE.search(begin[1]):
                name, end = self._longest(text, begin.start(2))
                if name is not None:
                    found.append(name)
                    at = end
        return found

    def licences(self, names: list[str]) -> list[str]:
        found, at = [], 0
        while at < len(names):
            for rule, licence in self.by_first.get(names[at], ()):
                if tuple(names[at : at + len(rule)]) == rule:
                    found.append(licence)
                    at += len(rule)
                    break
            else:
                at += 1
        return found


def _scan(batches: Iterator[pa.RecordBatch], sentences: dict, rules: tuple):
    scan = Scan(sentences, rules)
    for batch in batches:
        names = [scan.identifiers(t or "") for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(names, pa.list_(pa.string())),
                pa.array([scan.licences(n) for n in names], pa.list_(pa.string())),
            ],
            ["doc_id", "identifiers", "licences"],
        )


def license_scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sentences: dict = SENTENCES,
    rules: tuple = RULES,
) -> DataFrame:
    """Per document: doc_id, identifiers and licences in the order of the text."""
    pairs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = pairs.schema["doc_id"].dataType.simpleString()
    return pairs.mapInArrow(
        partial(_scan, sentences=sentences, rules=rules),
        f"doc_id {kind}, identifiers array<string>, licences array<string>",
    )
