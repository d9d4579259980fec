"""License scan: patience alignment of license notices with texts."""

import re
from bisect import bisect_left

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

# The wording of published license notices.
TEMPLATES = (
    ("MIT-notice", "Released under the MIT License."),
    ("Apache-2.0-notice", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0-notice", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0-notice", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0-notice", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0-notice", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("all-rights-reserved", "All rights reserved."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
     "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
     "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and "
     "this permission notice shall be included in all copies or substantial portions of the Software."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
     "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
     "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
     "conditions and the following disclaimer."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
     "compliance with the License. You may obtain a copy of the License at"),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
     "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
     "option) any later version."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
     "not distributed with this file, You can obtain one at"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("GPL-2.0-or-later", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
     "General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) "
     "any later version."),
    ("LGPL-2.1-or-later", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
     "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your "
     "option) any later version."),
    ("LGPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
     "Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
     "option) any later version."),
    ("AGPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
     "Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
     "option) any later version."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 "
     "which is available at"),
    ("CC0-1.0-notice", "To the extent possible under law, the person who associated CC0 with this work has waived all copyright and "
     "related or neighboring rights to this work."),
    ("BSD-notice", "Released under the BSD License."),
    ("GPL-2.0-notice", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-4.0-line", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0-line", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-ND-4.0-line", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0-line", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-ND-4.0-line", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-ND-4.0-notice", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("CC-BY-NC-4.0-long", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-SA-4.0-notice",
     "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("CC-BY-NC-ND-4.0-notice",
     "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
)
# Words that tell one license from its relatives.
DECISIVE = "affero agpl apache bsd cc cc0 eclipse epl gpl isc lesser lgpl mit mozilla mpl nc nd noderivatives noderivs noncommercial sa sharealike unlicense"
COVERAGE = 0.8

_WORD = re.compile(rb"[a-z0-9\x80-\xff]+")


def license_words(text):
    """ASCII letters in lower case, digits and characters beyond ASCII, in runs."""
    return _WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())


_DECISIVE = frozenset(license_words(DECISIVE))


def says_the_same(template, words, pairs):
    """Whether an aligned stretch of words names the license of the template and no other one.

    All decisive words and version numbers of the template must be aligned (a 0 ends a version without changing
    it), and every decisive word from the first to the last aligned word of the stretch.
    """
    of_template, of_words = {i for i, _ in pairs}, {j for _, j in pairs}
    if any(i not in of_template and (w in _DECISIVE or w.isdigit() and w != b"0") for i, w in enumerate(template)):
        return False
    return not any(words[j] in _DECISIVE and j not in of_words for j in range(pairs[0][1], pairs[-1][1] + 1))


def increasing(pairs):
    """A longest run of pairs, given by ascending first place, whose second places ascend as well."""
    tails, at, back = [], [], []
    for n, (_, b) in enumerate(pairs):
        k = bisect_left(tails, b)
        back.append(at[k - 1] if k else -1)
        if k == len(tails):
            tails.append(b)
            at.append(n)
        else:
            tails[k], at[k] = b, n
    run, n = [], at[-1] if at else -1
    while n >= 0:
        run.append(pairs[n])
        n = back[n]
    return run[::-1]


def patience(a, b):
    """Aligned places (i, j) of equal words of a and b, both ascending.

    Equal ends are aligned first.  Words that occur once in a and once in b are anchors; a longest
    ascending run of them stands, and the gaps between are aligned in the same way.  A gap without
    such words stays unaligned.
    """
    aligned, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            aligned.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            aligned.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        once = _once(a, a0, a1)
        other = _once(b, b0, b1)
        anchors = increasing([(i, other[w]) for w, i in once.items() if w in other])
        if not anchors:
            continue
        aligned += anchors
        edges = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
        todo += [(i + 1, i2, j + 1, j2) for (i, j), (i2, j2) in zip(edges, edges[1:])]
    return sorted(aligned)


def _once(words, start, end):
    places = {}
    for i in range(start, end):
        places[words[i]] = -1 if words[i] in places else i
    return {w: i for w, i in places.items() if i >= 0}


class Scanner:
    def __init__(self, templates, coverage):
        self.coverage = coverage
        self.templates = [(name, license_words(text)) for name, text in templates]
        self.known = {w: n for n, w in enumerate(dict.fromkeys(w for _, ws in self.templates for w in ws))}
        self.member = np.zeros((len(self.templates), len(self.known)), dtype=bool)
        for t, (_, ws) in enumerate(self.templates):
            self.member[t, [self.known[w] for w in ws]] = True

    def scan(self, text):
        """(license, coverage, first word, end word, aligned share of its words) of every notice in a text, in order.

        A notice is a stretch of words that begins and ends with aligned words, is no longer than
        the template divided by the coverage, in which at least that share of the template's
        words is aligned, and which names the same license (``says_the_same``).  Such a stretch holds as many words of the template's vocabulary, so
        only places from which enough of them follow are aligned at all; none is missed by that.
        """
        words = license_words(text)
        get = self.known.get
        codes = np.array([get(w, -1) for w in words], dtype=np.int32)
        places = np.nonzero(codes >= 0)[0]
        if not len(places):
            return []
        codes = codes[places]
        found = []
        for t, (name, template) in enumerate(self.templates):
            need = int(np.ceil(self.coverage * len(template) - 1e-9))
            if len(places) < need:
                continue
            mine = places[self.member[t, codes]]
            if len(mine) < need:
                continue
            reach = int(len(template) / self.coverage)
            enough = mine[np.searchsorted(mine, mine + reach) - np.arange(len(mine)) >= need]
            past = 0
            for start in enough.tolist():
                if start < past:
                    continue
                window = words[start:start + reach]
                pairs = patience(template, window)
                if len(pairs) >= need and says_the_same(template, window, pairs):
                    start, pairs = self._whole(template, words, start, pairs, enough, reach)
                    first, past = start + pairs[0][1], start + pairs[-1][1] + 1
                    found.append((name, len(pairs) / len(template), first, past, len(pairs) / (past - first)))
        return sorted(found, key=lambda x: (x[2], x[0]))

    def _whole(self, template, words, start, pairs, starts, reach):
        """The start and alignment of a found notice with most words aligned, on ties in the shortest stretch.

        A window that begins before the notice may end before it does, so every start up to the
        end of the stretch found is tried.  One that aligns most words beyond that end is another notice.
        """
        end = start + pairs[-1][1] + 1
        best = (len(pairs), pairs[0][1] - pairs[-1][1], start, pairs)
        for other in starts[np.searchsorted(starts, start, "right"):np.searchsorted(starts, end)].tolist():
            if best[0] == len(template) == 1 - best[1]:
                break
            window = words[other:other + reach]
            tried = patience(template, window)
            if 2 * sum(other + j < end for _, j in tried) >= len(tried) > 0 and says_the_same(template, window, tried):
                best = max(best, (len(tried), tried[0][1] - tried[-1][1], other, tried), key=lambda x: x[:2])
        return best[2:]


def scan(docs, templates=TEMPLATES, coverage=COVERAGE):
    """(doc_id, licenses, best_license, best_coverage, notices) of every row.

    ``notices`` lists (license, coverage, begin, end, share) with places in words; coverage is the aligned
    share of the template, share that of the words from begin to end.  ``licenses`` are the distinct names by
    name.  The best one covers most, on ties with the larger share, then the earlier place, then the name.
    Null and empty texts have none.  Repeated rows have a row each, an empty table none.
    """
    def run(batches):
        scanner = Scanner(templates, coverage)
        for pdf in batches:
            out = []
            for text in pdf["text"]:
                found = scanner.scan(text)
                best = min(found, key=lambda x: (-x[1], -x[4], x[2], x[0]), default=(None, None))
                out.append((sorted({f[0] for f in found}), best[0], best[1], [dict(zip(("license", "coverage", "begin", "end", "share"), f)) for f in found]))
            yield pd.DataFrame(out, columns=["licenses", "best_license", "best_coverage", "notices"]).assign(
                no_id=pdf["no_id"].to_numpy(), doc_id=pdf["doc_id"].to_numpy()
            )

    rows = docs.select(F.col("doc_id").isNull().alias("no_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc_id"), "text")
    schema = ("doc_id long, no_id boolean, licenses array<string>, best_license string, best_coverage double, "
              "notices array<struct<license:string,coverage:double,begin:int,end:int,share:double>>")
    return rows.mapInPandas(run, schema).select(
        F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id"), "licenses", "best_license", "best_coverage", "notices"
    )
