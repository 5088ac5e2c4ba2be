"""Find license notices: MinHash bands over overlapping windows, then exact shingle containment.

For each length of notice the text is covered by windows that overlap so far that one of them
holds any whole notice of that length, with at most a quarter more words. A window that holds
three quarters of a notice's shingles has a similarity of 0.5 or more to it; 20 bands of one
value each then meet with a probability of 1 - 0.5 ** 20, over 0.999999. Windows without any shingle of a notice
have similarity 0 and are left out before. What the bands retrieve is verified by the part of
the notice's shingles that the window holds.

With `edits`, a changed, added or missing word is forgiven anywhere but in a notice's key, the
words that tell its license from others: shingles are shorter for short notices, and as many may
be missing as one word spoils. Of notices found in the same place the one that holds most counts.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.tables import whole_text, written
from quayside.session import small_frame

BANDS = 20
CONTAINED = 75  # per cent of a notice's shingles
GRAM = 5
# The names of licenses and sentences that announce them.
NOTICES = (
    ("all-rights-reserved", "All rights reserved."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)

_GNU = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0} "
    "as published by the Free Software Foundation, either version {1} of the License, or (at your option) any later "
    "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
    "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0} for more details."
)
_BSD_2 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
    "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
    "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
    "with the distribution."
)
# Name, words and key. Whole bodies and headers need no key: their wording tells them apart.
TEMPLATES = (
    ("all-rights-reserved", "All rights reserved.", "all rights reserved"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0.", "apache license"),
    (
        "apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
        "",
    ),
    ("bsd", NOTICES[2][1], ""),
    ("bsd-2-clause", _BSD_2, ""),
    (
        "bsd-3-clause",
        _BSD_2 + " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
        "or promote products derived from this software without specific prior written permission.",
        "",
    ),
    *(
        (f"cc-{kind.lower()}-4.0", text.format(words, kind), key)
        for kind, words in (
            ("BY", "Attribution"),
            ("BY-SA", "Attribution-ShareAlike"),
            ("BY-NC", "Attribution-NonCommercial"),
            ("BY-ND", "Attribution-NoDerivatives"),
            ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
            ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
        )
        for text, key in (
            ("This work is licensed under a Creative Commons {0} 4.0 International License.", f"{words} 4 0"),
            ("Licensed under CC {1} 4.0.", f"cc {kind} 4 0"),
        )
    ),
    ("gpl-3.0", NOTICES[5][1], "gnu general public license version 3"),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2.", "gnu general public license version 2"),
    ("gpl", NOTICES[6][1], "gnu general public license"),
    ("lgpl", "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License", "gnu lesser general public license"),
    ("agpl", "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License", "gnu affero general public license"),
    ("gpl-2.0", _GNU.format("General Public License", 2), "gnu general public license"),
    ("gpl-3.0", _GNU.format("General Public License", 3), "gnu general public license"),
    ("lgpl-2.1", _GNU.format("Lesser General Public License", 2.1), "gnu lesser general public license"),
    ("lgpl-3.0", _GNU.format("Lesser General Public License", 3), "gnu lesser general public license"),
    ("agpl-3.0", _GNU.format("Affero General Public License", 3), "gnu affero general public license"),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "",
    ),
    ("mit", "Released under the MIT License.", "mit license"),
    ("mit", NOTICES[8][1], ""),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        'Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
        "",
    ),
    ("mpl-2.0", NOTICES[9][1], "mozilla public license"),
    (
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means.",
        "",
    ),
)


def _gram(length: int, edits: bool) -> int:
    return min(length, (2 if length < 8 else 3 if length < 20 else GRAM) if edits else GRAM)


def _plain(words: str) -> str:
    return " ".join(re.findall(r"[^\W_]+", words.lower()))


def _tokens(text):
    """Runs of letters and digits, in lower case."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+", -1), lambda word: word != "")


def _shingles(tokens: str, gram: int):
    last = F.size(tokens) - gram
    return F.transform(
        F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>")),
        lambda i: F.xxhash64(*(F.get(F.col(tokens), i + k) for k in range(gram))),
    )


def _bands(shingles, bands: int):
    def least(band: int):
        return F.array_min(F.transform(shingles, lambda s: F.xxhash64(s, F.lit(band))))

    return F.array(*(least(band) for band in range(bands)))


def scan(docs: DataFrame, notices=NOTICES, id_col: str = "doc_id", text_col: str = "text", edits: bool = False) -> DataFrame:
    """doc_id, licenses (names in order, joined by commas) and n_windows of every row.

    Notices are names and words and, with `edits`, keys. Notices shorter than a shingle are one
    shingle of all their words. Null, empty and wordless texts have none. Rows stay as often as
    they occur; a name counts once a row.
    """
    spark = docs.sparkSession
    bands = 2 * BANDS if edits else BANDS  # with a word spoilt, a short notice's similarity may be 0.3
    listed = [(i, x[0], x[1], _plain(x[2]) if edits else "") for i, x in enumerate(notices)]
    table = small_frame(spark, listed, "notice int, name string, text string, key string")
    table = written(table.withColumn("tokens", _tokens(F.col("text"))).withColumn("length", F.size("tokens")), "notices")
    # Notices are a parameter; their lengths, keys and shingles are as few as its words.
    keys: dict[int, set] = {}
    for r in table.select("length", "key").collect():
        keys.setdefault(r["length"], set()).add(r["key"])
    lengths = sorted(keys)
    grams = sorted({_gram(n, edits) for n in lengths})
    of_gram = {g: [n for n in lengths if _gram(n, edits) == g] for g in grams}
    per_gram = {g: table.where(F.col("length").isin(of_gram[g])).withColumn("shingles", _shingles("tokens", g)) for g in grams}
    wanted = {g: sorted({s for r in t.select("shingles").collect() for s in r[0]}) for g, t in per_gram.items()}

    def has_key(text, *of_lengths):
        """Whether it has any key of notices of these lengths."""
        some = sorted(set().union(*(keys[n] for n in of_lengths)))
        return F.lit(True) if "" in some else reduce(or_, (text.contains(f" {key} ") for key in some))

    text = docs.select(F.col(id_col).cast("long").alias("doc_id"), _tokens(whole_text(text_col)).alias("tokens"))
    spaced = F.concat(F.lit(" "), F.array_join("tokens", " "), F.lit(" "))
    hashed = text.withColumns({f"s{g}": F.when(has_key(spaced, *of_gram[g]), _shingles("tokens", g)) for g in grams})
    rows = hashed.withColumns(
        {
            f"s{g}": F.when(F.arrays_overlap(f"s{g}", F.array(*(F.lit(s).cast("long") for s in wanted[g]))), F.col(f"s{g}"))
            for g in grams
        }
    )
    rows = rows.withColumn("tokens", F.when(F.coalesce(*(f"s{g}" for g in grams)).isNotNull(), F.col("tokens")) if edits else F.lit(None).cast("array<string>"))
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "license-rows")
    found = None
    for length in lengths:
        gram = _gram(length, edits)
        stride = max(1, length // 4)
        size = length + stride - 1 - gram + 1 + edits  # shingles of a window
        hits = rows.where(F.col(f"s{gram}").isNotNull()).select("row", F.col(f"s{gram}").alias("s"), "tokens")
        if edits:
            hits = hits.where(has_key(spaced, length))
        at = F.filter(
            F.sequence(F.lit(0), F.size("s") - 1), lambda i: F.get(F.col("s"), i).isin(wanted[gram])
        )
        near = F.transform(
            at,
            lambda i: F.sequence(
                F.greatest(F.lit(0), F.ceil((i - size + 1) / stride)).cast("int"), F.floor(i / stride).cast("int")
            ),
        )
        # Windows are cut out within the row, so that its whole list is copied for none of them.
        cut = F.transform(
            F.array_distinct(F.flatten(near)),
            lambda w: F.struct(
                w.alias("window"),
                F.transform(
                    F.sequence(w * stride, F.least(w * stride + size, F.size("s")) - 1), lambda i: F.get(F.col("s"), i)
                ).alias("part"),
                (
                    F.concat(F.lit(" "), F.array_join(F.slice("tokens", w * stride + 1, size + gram - 1), " "), F.lit(" "))
                    if edits
                    else F.lit("")
                ).alias("said"),
            ),
        )
        windows = hits.select("row", F.explode(cut).alias("x")).select("row", "x.window", "x.part", "x.said")
        if edits:
            windows = windows.where(has_key(F.col("said"), length))
        windows = windows.select("row", "window", "part", "said", F.posexplode(_bands(F.col("part"), bands)).alias("band", "value"))
        own = per_gram[gram].where(F.col("length") == length)
        keyed = own.select(
            "notice", "name", "key", F.array_distinct("shingles").alias("shingles"), F.posexplode(_bands(F.col("shingles"), bands)).alias("band", "value")
        )
        meet = windows.join(F.broadcast(keyed), ["band", "value"])  # a row a band and notice
        held = F.size(F.array_intersect("part", "shingles"))
        enough = 100 * held >= CONTAINED * F.size("shingles")
        if edits:
            enough = enough | (held >= F.greatest(F.lit(1), F.size("shingles") - gram))
            enough = enough & ((F.col("key") == "") | F.col("said").contains(F.concat(F.lit(" "), "key", F.lit(" "))))
        places = F.filter(F.sequence(F.lit(0), F.size("part") - 1), lambda i: F.array_contains("shingles", F.get(F.col("part"), i)))
        some = meet.where(enough).select(
            "row", "name", "notice", "window", F.lit(length).alias("length"),
            (held + gram - 1).alias("held"), (held / F.size("shingles")).alias("share"),
            (F.col("window") * stride + F.array_min(places)).alias("start"),
            (F.col("window") * stride + F.array_max(places) + gram).alias("stop"),
        )
        found = some if found is None else found.unionByName(some)
    names = F.collect_set("name")
    if edits:
        # The best window of a notice in each stretch of its length stands for the place.
        found = written(found, "license-hits")
        best = F.max(F.struct("held", "share", "name", "start", "stop"))
        spots = found.groupBy("row", "notice", F.floor(F.col("start") / F.col("length"))).agg(best.alias("spot"))
        together = spots.groupBy("row").agg(F.collect_list("spot").alias("spots"))
        overlap = lambda x, y: F.least(x["stop"], y["stop"]) - F.greatest(x["start"], y["start"])
        least = lambda x, y: F.least(x["stop"] - x["start"], y["stop"] - y["start"])
        left = F.filter(
            "spots",
            lambda x: ~F.exists(
                "spots",
                lambda y: (x["name"] != y["name"])
                & (2 * overlap(x, y) > least(x, y))
                & (F.struct(y["held"], y["share"]) > F.struct(x["held"], x["share"])),
            ),
        )
        stay = together.select("row", F.array_join(F.array_sort(F.array_distinct(F.transform(left, lambda x: x["name"]))), ",").alias("licenses"))
        per_row = stay.join(found.groupBy("row").agg(F.count_distinct("length", "window").alias("n_windows")), "row")
    else:
        per_row = found.groupBy("row").agg(
            F.array_join(F.array_sort(names), ",").alias("licenses"),
            F.count_distinct("length", "window").alias("n_windows"),
        )
    return rows.select("row", "doc_id").join(per_row, "row", "left").select(
        "doc_id", F.coalesce("licenses", F.lit("")).alias("licenses"), F.coalesce("n_windows", F.lit(0)).alias("n_windows")
    )
