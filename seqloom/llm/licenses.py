"""License scans with DataFrame functions only: no Python on the executors.

A text is lower-cased and cut into words of letters and digits, and each five words in a row are a 64-bit shingle. Two
lengths of overlapping windows are laid over the shingles of texts and templates: single shingles, for templates under
``LONG`` shingles (the MinHash of such a window is the shingle, so a template with one of its shingles in the text is
retrieved with certainty), and windows of two blocks of ``BLOCK`` shingles, which overlap by a block in texts and start
at every place in templates. A window's key in a band is the smallest of its shingles' hashes under the band's seed, on
both sides. A text window in a copy faces a template window at the same place; if a share s of its shingles is unchanged,
the two have a Jaccard similarity of s / (2 - s), 2/3 for s = 0.8, and a band hits with that chance: over 0.9998 for one
window and ``BANDS`` = 8. Further windows add to that, and one wholly unchanged hits for certain. Retrieved templates are
then verified exactly: the share of the template's distinct shingles that the text has must be 0.8 or more.

Up to ``CONSTANT_KEYS`` keys of templates become constants of the plan, and there is no shuffle; more stay a table,
which the texts' distinct keys are joined with, so the number of templates has no limit.

Null, empty and short texts have no shingles and no licenses; templates under five words match nothing. Very long texts
are scanned whole, in one row's arrays. Repeated rows give repeated results, an empty table gives none. Other columns of
the table may have any name.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

WORDS = 5
BLOCK = 16
LONG = 48
BANDS = 8
CONTAINED = 0.8
CONSTANT_KEYS = 20_000

# License notices and the operative paragraphs of public licenses.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0-notice": "This work is licensed under the GNU General Public License, version 2.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-3.0-notice": "Licensed under CC BY-NC 3.0.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "GPL-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
}


def shingles(text: Column) -> Column:
    """Hashes of each five words in a row, in order; an empty array for texts with fewer words."""
    words = F.filter(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    def windows(ws):
        return F.transform(F.slice(ws, 1, F.greatest(F.size(ws) - (WORDS - 1), F.lit(0))), lambda w, i: F.xxhash64(w, *[F.get(ws, i + k) for k in range(1, WORDS)]))
    # A one-element array binds the words to a name, so that they are made once.
    return F.flatten(F.transform(F.array(words), windows))


def bands(sh: Column, step: int = BLOCK) -> Column:
    """The MinHash of each window of two blocks, for each band; windows start at every ``step``-th place. None where there are under two blocks of shingles."""
    def least(hs):
        def of_blocks(seed):
            hashed = F.transform(hs, lambda h: F.xxhash64(F.lit(seed), h))
            starts = F.when(F.size(hs) >= BLOCK, F.sequence(F.lit(0), F.size(hs) - BLOCK, F.lit(step))).otherwise(F.array().cast("array<int>"))
            return F.flatten(F.transform(F.array(hashed), lambda xs: F.transform(starts, lambda at: F.array_min(F.slice(xs, at + 1, BLOCK)))))

        apart = BLOCK // step  # places between the blocks of a window
        def of_windows(ms):
            return F.transform(F.slice(ms, 1, F.greatest(F.size(ms) - apart, F.lit(0))), lambda m, i: F.least(m, F.get(ms, i + apart)))

        return F.concat(*[F.flatten(F.transform(F.array(of_blocks(seed)), of_windows)) for seed in range(BANDS)])

    return F.flatten(F.transform(F.array(sh), least))


def template_keys(templates: DataFrame) -> DataFrame:
    """(template, sh, keys): the distinct shingles of each template (template, body) and the keys by which texts retrieve it."""
    known = templates.select("template", shingles(F.col("body")).alias("all"))
    known = known.select("template", F.array_distinct("all").alias("sh"), "all").where(F.size("sh") > 0)
    return known.select("template", "sh", F.when(F.size("all") < LONG, F.col("sh")).otherwise(F.array_distinct(bands(F.col("all"), 1))).alias("keys"))


def scan_licenses(docs: DataFrame, templates: dict[str, str] | DataFrame | None = None, *, id_cols: tuple[str, ...] = ("doc_id",), text_col: str = "text", constant_keys: int = CONSTANT_KEYS) -> DataFrame:
    """Rows (id columns, template, n_matched, n_template, containment) for each text and template contained in it. templates: a dict, or a table (template, body) with distinct names."""
    if not isinstance(templates, DataFrame):
        templates = docs.sparkSession.createDataFrame(sorted((TEMPLATES if templates is None else templates).items()), "template string, body string")
    known = template_keys(templates)
    size = known.agg(F.sum(F.size("keys") + F.size("sh"))).first()[0] or 0
    docs = docs.select(*[F.col(c).alias(f"id{i}") for i, c in enumerate(id_cols)], F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    found = _by_constants(docs, known.collect()) if size <= constant_keys else _by_join(docs, known)
    ids = [F.col(f"id{i}").alias(c) for i, c in enumerate(id_cols)]
    return found.where(F.col("n_matched") >= CONTAINED * F.col("n_template")).select(*ids, "template", "n_matched", "n_template", F.round(F.col("n_matched") / F.col("n_template"), 6).alias("containment"))


def _by_constants(docs: DataFrame, rows: list) -> DataFrame:
    """The templates' keys and shingles are constants. No shuffle."""
    def long(r):
        return len(r.sh) >= LONG or set(r.sh) != set(r.keys)

    def hit(keys: Column, among: list[int]) -> Column:
        return F.exists(keys, lambda k: k.isin(among)) if among else F.lit(False)

    if not rows:
        return docs.where("false").select("*", F.lit("").alias("template"), F.lit(0).alias("n_matched"), F.lit(0).alias("n_template"))
    of_short = sorted({k for r in rows if not long(r) for k in r["keys"]})
    of_long = sorted({k for r in rows if long(r) for k in r["keys"]})
    # The filter makes the shingles once, under a name; only the few rows that pass make them again.
    maybe = docs.where(F.exists(F.array(shingles(F.col("text"))), lambda x: hit(x, of_short) | hit(bands(x), of_long)))
    maybe = maybe.withColumn("sh", shingles(F.col("text"))).drop("text")
    tries = [F.when(hit(bands(F.col("sh")) if long(r) else F.col("sh"), list(r["keys"])), F.lit(r.template)) for r in rows]
    found = maybe.withColumn("found", F.array_compact(F.array(*tries))).where(F.size("found") > 0).select("*", F.explode("found").alias("template"))
    matched = reduce(lambda e, r: F.when(F.col("template") == r.template, F.size(F.array_intersect("sh", F.array(*[F.lit(h) for h in r.sh])))).otherwise(e), rows, F.lit(None).cast("int"))
    total = reduce(lambda e, r: F.when(F.col("template") == r.template, F.lit(len(r.sh))).otherwise(e), rows, F.lit(None).cast("int"))
    return found.withColumn("n_matched", matched).withColumn("n_template", total)


def _by_join(docs: DataFrame, known: DataFrame) -> DataFrame:
    """Texts' distinct keys meet the templates' in a join; texts are known by their addresses, which go instead of them."""
    known = cut(known, "templates")
    texts = docs.select(F.unhex(F.sha2("text", 256)).alias("h"), "text")
    keyed = texts.select("h", shingles(F.col("text")).alias("sh")).select("h", F.explode(F.array_distinct(F.concat("sh", bands(F.col("sh"))))).alias("key"))
    pairs = keyed.join(known.select("template", F.explode("keys").alias("key")), "key").select("h", "template").distinct()
    rows = docs.withColumn("h", F.unhex(F.sha2("text", 256))).join(pairs, "h").join(known.select("template", "sh"), "template")
    return rows.withColumn("n_matched", F.size(F.array_intersect(shingles(F.col("text")), "sh"))).withColumn("n_template", F.size("sh"))
