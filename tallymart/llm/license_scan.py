"""License scans by conditional compression.

A block is a run of lines with words, one after the other, that mentions a licence; a notice may be wrapped over its lines. Its words are looked at in
overlapping windows. Every window that mentions a licence is compressed alone and with each template as zstandard raw dictionary; templates are ranked by the bytes
they save, as a part of what they save of their own words, and those that save enough are confirmed by wording: a notice agrees with its template word for word, apart from filler
words, and is not negated. Headings, such as a bare licence name, must fill their lines. SPDX expressions give all their licences.
"""

from __future__ import annotations

import re
from difflib import SequenceMatcher

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from tallymart.llm.common import utf8

# Usual wordings of licence notices.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("MIT", "Released under the MIT License"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3"),
    ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0"),
    ("BSD-2-Clause", "Licensed under the 2-Clause BSD License"),
    ("BSD-3-Clause", "Licensed under the 3-Clause BSD License"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0"),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0"),
    ("ISC", "Released under the ISC License"),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1"),
    *((f"{short}GPL-{version}" + ".0" * ("." not in version),
       f"under the terms of the GNU {long}General Public License as published by the Free Software Foundation, {either}version {version} of the License")
      for short, long, versions in (("", "", "23"), ("L", "Lesser ", ("3", "2.1")), ("A", "Affero ", "3")) for version in versions for either in ("either ", "")),
    *((f"{short}GPL-{version}" + ".0" * ("." not in version), f"GNU {long}General Public License, version {version}")
      for short, long, versions in (("", "", "23"), ("L", "Lesser ", ("3", "2.1")), ("A", "Affero ", "3")) for version in versions),
    *((f"{short}GPL-{version}" + ".0" * ("." not in version), f"GNU {short}GPL{between}{version}")
      for short, versions in (("", "23"), ("L", ("3", "2.1")), ("A", "3")) for version in versions for between in (" version ", "v")),
    *((f"CC-BY{code}-4.0", f"Creative Commons Attribution{name} 4.0 International")
      for code, name in (("", ""), ("-SA", "-ShareAlike"), ("-NC", "-NonCommercial"), ("-ND", "-NoDerivatives"))),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
            "(the Software), to deal in the Software without restriction"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
            "copyright notice and this permission notice appear in all copies"),
    ("ISC", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above "
            "copyright notice and this permission notice appear in all copies"),
)
# Names that are a notice where they fill a line.
HEADINGS = (("MIT", "The MIT License"), ("ISC", "ISC License"), ("Apache-2.0", "Apache License, Version 2.0"), ("MPL-2.0", "Mozilla Public License Version 2.0"),
            ("BSD-2-Clause", "BSD 2-Clause License"), ("BSD-3-Clause", "BSD 3-Clause License"))
# Full BSD texts begin alike; words further down tell them apart.
BSD = (("BSD-4-Clause", "advertising materials mentioning"), ("BSD-3-Clause", "endorse or promote products"), ("BSD-2-Clause", ""))
MENTIONS = r"(?i)licen[sc]|copyright|public\s+domain|\bCC0\b|permission|redistribution|GPL|creative\s+commons|\bCC[ -]BY"
# Words that may differ without changing the licence meant.
FILLER = frozenset("a an the this that is are was work works text document file content page code software project program and of it its in by to "
                   "licensed license licence released distributed available published provided dedicated under terms version v all".split())
# A notice after one of these, or after one and words that go with it, is denied.
DENIES = frozenset("not never longer isn aren wasn weren cannot without".split())
GOES_WITH = frozenset("be been being yet t".split())
MENTION, MENTIONED = re.compile(MENTIONS.encode()), re.compile(MENTIONS)
# Words of a window, which is twice the step to the next one; a notice of at most that step lies whole in one.
WINDOW = 128
# A template goes on to be confirmed if it saves this part of what it saves of its own words.
SAVES = 0.05
# Templates that save at most so many bytes of themselves are always confirmed.
SHORT = 20
# Compression level for ranking.
RANK_LEVEL = 9
# Bytes of blocks whose notices a task remembers.
KNOWN_BYTES = 4_000_000
WORD = re.compile(r"[a-z0-9]+(?:[.\-][a-z0-9]+)*")
VERSION = re.compile(r"^v?(\d+(?:\.[1-9]\d*)?)(?:\.0)?$")
SAYS = re.compile(rb"[0-9A-Za-z\x80-\xff]")
SPDX = re.compile(r"(?i)SPDX-License-Identifier:[ \t]*([^\r\n]*)")
# A part of an SPDX expression: a name, or the name of an exception.
SPDX_NAME = re.compile(r"(?i)(\bWITH[ \t]+)?\b([a-z0-9][a-z0-9.\-]*)")


def words(text: str) -> list[str]:
    """Lower-case words; a version is its number, without v in front or .0 behind."""
    return [VERSION.sub(r"\1", word) for word in WORD.findall(text.lower())]


def differences(template: list[str], line: list[str]) -> tuple[list[str], list[str]]:
    """(template words the line lacks, line words amid the template's), in order."""
    lacks, amid, matched = [], [], SequenceMatcher(None, template, line, autojunk=False).get_opcodes()
    inner = [k for k, op in enumerate(matched) if op[0] == "equal"]
    for k, (kind, a0, a1, b0, b1) in enumerate(matched):
        if kind != "equal":
            lacks += template[a0:a1]
            if inner and inner[0] < k < inner[-1]:
                amid += line[b0:b1]
    return lacks, amid


class Scanner:
    """Templates ready to compress with and to compare."""

    def __init__(self, templates=TEMPLATES, headings=HEADINGS, level: int = 19):
        self.names = [name for name, _ in (*templates, *headings)]
        self.words = [words(text) for _, text in (*templates, *headings)]
        self.heading = [False] * len(templates) + [True] * len(headings)
        self.cores = [" " + "".join(word + " " for word in own if word not in FILLER) for own in self.words]
        self.spelled = {name.lower(): name for name in self.names}
        self.level = level
        self.alone = zstandard.ZstdCompressor(level=level)
        self.given = [self.with_template(text, level) for _, text in (*templates, *headings)]
        # Windows are compressed as their words, so templates are too; a window alone with a dictionary that no text holds, as zstandard searches otherwise then.
        said = [" ".join(own) for own in self.words]
        self.bare, self.given_words = self.with_template("\0" * 8, RANK_LEVEL), [self.with_template(text, RANK_LEVEL) for text in said]
        self.most = [len(self.bare.compress(text.encode())) - len(given.compress(text.encode())) for text, given in zip(said, self.given_words)]

    def with_template(self, text: str, level: int) -> zstandard.ZstdCompressor:
        return zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT))

    def saved(self, text: bytes, i: int) -> int:
        """Bytes that template i saves."""
        return len(self.alone.compress(text)) - len(self.given[i].compress(text))

    def ranked(self, window: str) -> list[tuple[float, int]]:
        """(bytes saved, as a part of those it saves of its own words; template) of the templates that save enough of a window, most first."""
        raw = window.encode()
        base = len(self.bare.compress(raw))
        # Short templates save little even of themselves, and nothing beside similar words, so they are all looked at.
        shares = (((base - len(given.compress(raw))) / max(1, most), i) for i, (given, most) in enumerate(zip(self.given_words, self.most)))
        return sorted(((share, i) for share, i in shares if share >= SAVES or self.most[i] <= SHORT), reverse=True)

    def proposed(self, own: list[str]) -> dict[tuple[int, int], list[int]]:
        """The templates ranked by compression, for every window (from word, to word) of a block's words that mentions a licence."""
        found = {}
        for lo in range(0, max(1, len(own) - WINDOW // 2), WINDOW // 2):
            window = " ".join(own[lo:lo + WINDOW])
            if MENTIONED.search(window):
                found[lo, min(lo + WINDOW, len(own))] = [i for _, i in self.ranked(window)]
        return found

    def confirmed(self, i: int, block: tuple[bytes, ...], own: list[tuple[str, int]], bare: list[int], said: str, within: tuple[int, int]):
        """(first word, word after the last, words lacking, words amid) of the places among the words ``within`` that agree with template i."""
        core, at = self.cores[i], -1
        while (at := said.find(core, at + 1)) >= 0:
            k = said.count(" ", 0, at)
            first, last = k - 1, k + core.count(" ") - 1
            if not within[0] <= bare[k] <= bare[last - 1] < within[1]:
                continue
            # The words of the template without fillers, and the fillers around them.
            begin, end = bare[first] + 1 if first >= 0 else 0, bare[last] if last < len(bare) else len(own)
            while first > 0 and own[bare[first]][0] in GOES_WITH:
                first -= 1
            if first >= 0 and own[bare[first]][0] in DENIES:
                continue
            here = [word for word, _ in own[begin:end]]
            lacks, amid = differences(self.words[i], here)
            if not FILLER.issuperset(lacks) or not FILLER.issuperset(amid) or len(lacks) * 2 >= len(self.words[i]):
                continue
            same = SequenceMatcher(None, self.words[i], here, autojunk=False).get_matching_blocks()[:-1]
            lo, hi = begin + same[0].b, begin + same[-1].b + same[-1].size
            if self.heading[i]:
                lines = own[lo][1], own[hi - 1][1]
                if any(lines[0] <= number <= lines[1] and word not in FILLER for word, number in (*own[max(0, begin - 20):lo], *own[hi:hi + 20])):
                    continue
            yield lo, hi, lacks, amid

    def found(self, block: tuple[bytes, ...]) -> list[tuple[int, str, int, list[str], list[str], str, bool]]:
        """(line, licence, bytes saved, words lacking, words amid, text of its lines, whether it is a heading) of every notice in a block of lines."""
        lines = [line.decode("utf-8", "replace") for line in block]
        own = [(word, number) for number, line in enumerate(lines) for word in words(line)]
        bare = [k for k, (word, _) in enumerate(own) if word not in FILLER]
        said = " " + "".join(own[k][0] + " " for k in bare)
        notices = {}
        for within, ranks in self.proposed([word for word, _ in own]).items():
            for i in ranks:
                for lo, hi, lacks, amid in self.confirmed(i, block, own, bare, said, within):
                    text = b"\n".join(block[own[lo][1]:own[hi - 1][1] + 1])
                    notices[i, lo, hi] = (self.saved(text, i), lo, hi, (own[lo][1], self.names[i]), lacks, amid, text, self.heading[i])
        out, taken = [], []
        for saved, lo, hi, (line, name), lacks, amid, text, heading in sorted(notices.values(), key=lambda x: (-x[0], x[1], x[2], x[3], len(x[4]) + len(x[5]))):
            if not any(name == other and lo < h and l < hi for other, l, h in taken):
                taken.append((name, lo, hi))
                out.append((line, name, saved, lacks, amid, text.decode("utf-8", "replace"), heading))
        return sorted([*out, *self.expressions(lines)], key=lambda x: x[:2])

    def expressions(self, lines: list[str]):
        """The licences of SPDX expressions, by the names of the templates where there is one."""
        for number, line in enumerate(lines):
            for expression in SPDX.findall(line):
                names = [name.rstrip(".-") for exception, name in SPDX_NAME.findall(expression) if not exception]
                for name in dict.fromkeys(n for n in names if n.upper() not in ("AND", "OR", "WITH", "NONE", "NOASSERTION")):
                    short = re.sub(r"(?i)-(only|or-later)$", "", name)
                    given = zstandard.ZstdCompressor(level=self.level, dict_data=zstandard.ZstdCompressionDict(
                        f"SPDX-License-Identifier: {name}".encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT))
                    raw = line.encode()
                    saved = len(self.alone.compress(raw)) - len(given.compress(raw))
                    yield number, self.spelled.get(short.lower(), name), saved, [], [], line, False


def blocks(text: bytes):
    """(number of the first line, lines) of the runs of lines with words, one after the other, that mention a licence."""
    held, begin = [], 0
    for number, line in enumerate([*text.split(b"\n"), b""]):
        if SAYS.search(line):
            if not held:
                begin = number
            held.append(line)
        else:
            if held and MENTION.search(b"\n".join(held)):
                yield begin, tuple(held)
            held = []


def bsd(text: bytes, line: int) -> str:
    """Which of the BSD texts begins in this line: by what comes before the next one begins."""
    rest = " ".join(words(b"\n".join(text.split(b"\n")[line:]).decode("utf-8", "replace")))
    begins = "redistribution and use in source"
    rest = rest[:rest.find(begins, rest.find(begins) + 1)] if rest.count(begins) > 1 else rest
    return next(name for name, said in BSD if said in rest)


def scanned(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """One row per licence notice: doc_id, line (from 0, its first), license, saved (bytes), lacks and amid (differing words), text of its lines.

    Every block of every whole text is looked at. A heading followed by a notice of its own licence has no row of its own. Null and empty texts have no notice; a document with several notices has a row for each; repeated
    rows are scanned each, a null doc_id is passed on, other columns are ignored. No rows give no rows.
    """
    def run(batches):
        scanner, known, size = Scanner(templates), {}, 0
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = []
                for begin, block in blocks(text):
                    if block not in known:
                        size += sum(map(len, block)) + 500
                        if size > KNOWN_BYTES:
                            known, size = {}, 0
                        known[block] = scanner.found(block)
                    own += [(begin + line, bsd(text, begin + line) if name == "BSD" else name, *more) for line, name, *more in known[block]]
                # A heading over the same licence's notice is part of it.
                out += [(doc_id, *notice[:-1]) for notice, after in zip(own, [*own[1:], None]) if not (notice[-1] and after and notice[1] == after[1])]
            if out:
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string()), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                                 ["doc_id", "line", "license", "saved", "lacks", "amid", "text"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text")).where(F.col("text").rlike(MENTIONS))
    return rows.select("doc_id", utf8().alias("text")).mapInArrow(
        run, "doc_id long, line long, license string, saved long, lacks array<string>, amid array<string>, text string")
