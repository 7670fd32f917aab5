"""License scans by conditional compression: a block that a template explains shrinks when the template is known."""

from __future__ import annotations

import difflib
import re
from dataclasses import dataclass

import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm.common import per_text, quoted

# Wordings in which licenses are named or granted.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "BSD-redistribution": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:"
    ),
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction'
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "AGPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "Affero General Public License as published by the Free Software Foundation, either version 3 of the "
        "License, or (at your option) any later version."
    ),
    "GPL-2.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 2 of the "
        "License, or (at your option) any later version."
    ),
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the "
        "License, or (at your option) any later version."
    ),
    "LGPL-2.1-header": (
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "Lesser General Public License as published by the Free Software Foundation, either version 2.1 of the "
        "License, or (at your option) any later version."
    ),
    "LGPL-3.0-header": (
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "Lesser General Public License as published by the Free Software Foundation, either version 3 of the "
        "License, or (at your option) any later version."
    ),
    "CC-BY-4.0-header": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0-header": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC-BY-NC-ND-4.0-header": "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    "CC-BY-NC-SA-4.0-header": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    "CC-BY-ND-4.0-header": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "CC-BY-SA-4.0-header": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "CC0-1.0-header": (
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring "
        "rights to this software to the public domain worldwide. This software is distributed without any warranty."
    ),
    "EPL-2.0-header": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
        "2.0 which is available at https://www.eclipse.org/legal/epl-2.0"
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software"
    ),
}
TRIGGER = re.compile(r"licen[sc]e|copyright|hereby granted|redistribution|creative commons|\bcc by|public domain", re.I)
WORD = re.compile(r"\w+(?:[.-]\w+)*")
FOUND = (
    "array<struct<license: string, start: int, stop: int, reduction: double, different_words: int, "
    "differences: array<string>, exact: boolean>>"
)


@dataclass(frozen=True)
class Scan:
    """A block reaches from ``lines_before`` lines before the line with a trigger word over ``lines`` lines, or those
    that the longest template fills at 30 characters each, at most
    ``reach`` characters to either side; what lies before and after a find in it is scanned again. A winner holds ``least_saved`` of its template's compressed size, and differs from it
    in at most ``most_different`` of the words, never in a number."""

    lines: int = 5
    lines_before: int = 4
    reach: int = 1500
    level: int = 3
    least_saved: float = 0.25
    most_different: float = 0.25


def differences(template: list[str], text: list[str]) -> tuple[int, int, list[str], int]:
    """Words of ``text`` (first, last + 1) that stand for the template, what differs in wording, and in how many words.

    The longest common run of words says where the template lies.
    """
    run = difflib.SequenceMatcher(None, template, text, autojunk=False).find_longest_match()
    first = max(0, run.b - run.a)
    last = min(len(text), first + len(template)) if run.size else first
    said, count = [], 0
    for tag, a1, a2, b1, b2 in difflib.SequenceMatcher(None, template, text[first:last], autojunk=False).get_opcodes():
        if tag != "equal":
            count += max(a2 - a1, b2 - b1)
            said.append(f"{' '.join(template[a1:a2])} > {' '.join(text[first:last][b1:b2])}")
    return first, last, said, count


def _scanner(templates: dict[str, str], scan: Scan):
    options = {"level": scan.level, "write_content_size": False, "write_checksum": False}
    plain = zstandard.ZstdCompressor(**options)
    kinds = []
    for name, wording in templates.items():
        data = wording.lower().encode()
        known = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        press = zstandard.ZstdCompressor(dict_data=known, write_dict_id=False, **options)
        kinds.append((name, press, len(plain.compress(data)), [w.lower() for w in WORD.findall(wording)]))

    lines = max([scan.lines, *(len(wording) // 30 for wording in templates.values())])

    def winner(block: str) -> dict | None:
        """Templates by what they save, and the first one that the words confirm; longer wordings go first if equal."""
        data = block.lower().encode()
        alone = len(plain.compress(data))
        ranked = [((alone - len(press.compress(data))) / size, name, words) for name, press, size, words in kinds]
        ranked = sorted(((s, n, w) for s, n, w in ranked if s >= scan.least_saved), key=lambda x: (-x[0], x[1]))
        spans = [m.span() for m in WORD.finditer(block)]
        text = [block[a:b].lower() for a, b in spans]
        best = None
        for saved, name, template in ranked:
            first, last, said, count = differences(template, text)
            number = any(c.isdigit() for c in "".join(said))
            if last > first and not number and count <= scan.most_different * len(template):
                found = {
                    "license": name,
                    "start": spans[first][0],
                    "stop": spans[last - 1][1],
                    "reduction": saved,
                    "different_words": count,
                    "differences": said,
                    "exact": count == 0,
                }
                if count == 0:
                    return found
                if best is None or count < best["different_words"]:
                    best = found
        return best

    def best_of(text: str, starts: list[int], stop: int) -> dict | None:
        """The winner with the fewest different words over blocks from each of ``starts``: lines before a notice can hide it."""
        best = None
        for start in starts:
            found = winner(text[start:stop])
            if found and (best is None or found["different_words"] < best["different_words"]):
                best = found | {"start": found["start"] + start, "stop": found["stop"] + start}
        return best

    def scan_block(text: str, start: int, stop: int) -> list[dict]:
        """Every find from ``start`` to ``stop``, in order: the winner, and those of what lies before and after it."""
        out, spans = [], [(start, stop)]
        while spans:
            a, b = spans.pop()
            hit = TRIGGER.search(text, a, b)
            line = max(a, text.rfind("\n", a, hit.start()) + 1) if hit else a
            if hit and (found := best_of(text, sorted({a, line}), b)):
                out.append(found)
                spans += [(a, found["start"]), (found["stop"], b)]
        return sorted(out, key=lambda x: x["start"])

    def find(data: bytes | None) -> list[dict]:
        text = (data or b"").decode("utf-8", "replace")
        out, covered = [], 0
        for hit in TRIGGER.finditer(text):
            if hit.start() < covered:
                continue
            start = text.rfind("\n", 0, hit.start())
            for _ in range(scan.lines_before):
                start = text.rfind("\n", 0, max(0, start))
            start = max(covered, start + 1, hit.start() - scan.reach)
            stop = hit.end()
            for _ in range(lines):
                line = text.find("\n", stop, hit.end() + scan.reach)
                stop = line + 1 if line >= 0 else min(len(text), hit.end() + scan.reach)
            if found := scan_block(text, start, stop):
                covered = found[-1]["stop"]
                out += found
        return out

    return find


def scan_licenses(
    df: DataFrame,
    text: str = "text",
    into: str = "licenses",
    templates: dict[str, str] | None = None,
    scan: Scan | None = None,
) -> DataFrame:
    """``df`` with an array ``into`` of the license wordings of each text, with spans in code points.

    Each candidate block is compressed alone and with every template as raw dictionary; templates are tried in the
    order of how much they save, and the first whose words differ little enough is taken, with the differences. The
    rest of the block before and after it is tried again, until no template is confirmed.
    One map, no shuffle; templates are a short list. Null and empty texts give an empty array; rows are scanned
    one by one; an existing column ``into`` is replaced.
    """
    chosen = dict(templates or TEMPLATES)
    return df.withColumn(into, per_text(lambda: _scanner(chosen, scan or Scan()), FOUND)(quoted(text)))


def license_rows(scanned: DataFrame, doc_id: str = "doc_id", licenses: str = "licenses") -> DataFrame:
    """One row per wording found."""
    return scanned.select(quoted(doc_id).alias("doc_id"), F.inline(quoted(licenses)))
