"""Licence scans with a positional index of rare words, in DataFrame operations only.

One pass over the texts keeps, of each file, the places of the templates' words. These words are
weighed by their rarity over the whole corpus. The index has, for each word, its postings: the
templates that it is mandatory in and its position there. A file's licence words are looked up in
it, the rarest ones of each template first: a file place less a template position is the offset at
which the template would stand, so a template can only stand where the postings of its two rarest
words agree. What is left is intersected with the postings of the other words of its key phrases,
until these are verified word for word. No row leaves its partition; only the words' document counts
are gathered.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import materialise
from .url_filter import LOWER, UPPER

WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
#: label, notice, key phrases (their first word's position, their words)
TEMPLATES: list[tuple[str, str, list[tuple[int, str]]]] = [
    ("mit", "released under the mit license", [(3, "mit license")]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", [(0, "permission is hereby granted free of charge")]),
    ("apache-2", "licensed under the apache license version 2 0", [(3, "apache license version 2")]),
    ("gpl-3", "this work is licensed under the gnu general public license version 3", [(6, "gnu general public license version 3")]),
    ("lgpl", "licensed under the gnu lesser general public license", [(3, "gnu lesser general public license")]),
    ("cc-by-nc", "licensed under cc by nc 4 0", [(2, "cc by nc")]),
    ("cc-by-sa", "licensed under cc by sa 4 0", [(2, "cc by sa")]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", [(0, "redistribution and use in source and binary forms")]),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0", [(6, "mozilla public license")]),
    ("gpl-2", "you can redistribute it and or modify it under the terms of the gnu general public license version 2", [(13, "gnu general public license version 2")]),
    ("agpl-3", "licensed under the gnu affero general public license version 3", [(3, "gnu affero general public license")]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", [(0, "permission to use copy modify and or distribute this software")]),
    ("boost", "distributed under the boost software license version 1 0", [(3, "boost software license")]),
    ("epl-2", "made available under the terms of the eclipse public license 2 0", [(7, "eclipse public license")]),
    ("unlicense", "this is free and unencumbered software released into the public domain", [(2, "free and unencumbered software")]),
    ("cc0", "dedicated to the public domain under cc0 1 0 universal", [(6, "cc0 1 0 universal")]),
    ("all-rights-reserved", "all rights reserved", [(0, "all rights reserved")]),
]


def _texts(items) -> str:
    return "array(" + ", ".join(f"'{x}'" for x in items) + ")"


def _structs(items, kind: str) -> str:
    return "cast(array(" + ", ".join("(" + ", ".join(map(str, x)) + ")" for x in items) + f") as array<struct<{kind}>>)"


def license_scan(docs: DataFrame, phrases: dict[str, str], templates=None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_words, n_base, first_word, last_word, base_labels, labels, score, places)`` for each row.

    Words are runs of digits, letters and anything beyond ASCII; only A-Z are lower-cased.
    ``phrases`` maps each base phrase (words in lower case) to its label; ``n_base`` counts all its
    places. ``labels`` adds the templates whose key phrases stand in the file, each at its position;
    both are distinct, sorted and comma-joined. ``places`` has each found template's label and the
    offset of its notice; ``score`` is the best share, weighed by rarity, of a found template's
    words that stand at their places (rounded to nine digits).

    However frequent its words are, no place of a key phrase is missed: rarity decides only the order
    in which postings are intersected. Null and empty texts have no words or labels and score 0;
    repeated rows are returned as often as they come; other columns are ignored.
    """
    templates = TEMPLATES if templates is None else templates or [("", "-", [(0, "-")])]  # no word is a hyphen
    notices = [n.split() for _, n, _ in templates] + [p.split() for p in phrases]
    keys = [[(p + j, w) for p, k in own for j, w in enumerate(k.split())] for _, _, own in templates] + [list(enumerate(p.split())) for p in phrases]
    labels = [t[0] for t in templates] + list(phrases.values())
    vocabulary = sorted({w for n in notices for w in n} | {w for k in keys for _, w in k})
    number = {w: i for i, w in enumerate(vocabulary)}

    low = F.translate(F.coalesce(F.col(text_col).cast("string"), F.lit("")), UPPER, LOWER)
    split = docs.select(F.col(id_col).alias("id"), F.regexp_extract_all(low, F.lit(WORD), F.lit(0)).alias("words"))
    own = F.array_compact(F.transform("words", lambda w, i: F.when(w.isin(vocabulary), i)))
    split = split.select("id", "words", own.alias("own"))
    hits = F.expr(f"transform(own, i -> struct(cast(array_position({_texts(vocabulary)}, words[i]) - 1 as int) as w, i as p))")
    found = materialise(split.select("id", F.size("words").cast("long").alias("n_words"), hits.alias("hits")), "licence-words")
    seen = found.select(F.explode(F.expr("array_append(array_distinct(transform(hits, x -> x.w)), -1)")).alias("w")).groupBy("w").count()
    counts = {r["w"]: r["count"] for r in seen.collect()}
    idf = [max(math.log((counts.get(-1, 0) + 1) / (counts.get(i, 0) + 1)), 1e-9) for i in range(len(vocabulary))]

    # Each template's mandatory words from rare to common; the k-th is looked up in the k-th step.
    ordered = [sorted(((number[w], p) for p, w in k), key=lambda x: (-idf[x[0]], x)) for k in keys]
    ordered = [k if len(k) > 1 else k * 2 for k in ordered]
    deepest = max(map(len, ordered))
    index = [[(t, p, k) for t, own in enumerate(ordered) for k, (w, p) in enumerate(own) if w == x] for x in range(len(vocabulary))]
    postings = "array(" + ", ".join(_structs(own, "t: int, p: int, k: int") for own in index) + ")"
    at = found.where("size(hits) > 0").withColumn("look", F.expr(f"flatten(transform(hits, x -> transform(({postings})[x.w], q -> struct(q.t as t, x.p - q.p as o, q.k as k))))"))
    step = lambda k: f"transform(filter(look, x -> x.k = {k}), x -> struct(x.t as t, x.o as o))"
    at = at.select("id", "n_words", "hits", "look", F.expr(f"array_intersect({step(0)}, {step(1)})").alias("here"))
    for k in range(2, deepest):
        done = [t for t, own in enumerate(ordered) if len(own) <= k]
        at = at.withColumn("here", F.expr(f"if(size(here) > 0, array_intersect(here, concat({step(k)}, filter(here, c -> c.t in ({', '.join(map(str, done)) or '-1'})))), here)"))
    n = len(templates)
    at = at.select("id", "n_words", "hits", F.expr(f"filter(here, c -> c.t >= {n})").alias("base"), F.expr(f"filter(here, c -> c.t < {n})").alias("places"))

    # The notices' words at their places; a template's shares are summed along the sorted array.
    words_at = "array(" + ", ".join(_structs([(j, number[w]) for j, w in enumerate(own)], "j: int, w: int") for own in notices[:n]) + ")"
    shares = "array(" + ", ".join("array(" + ", ".join(f"{idf[number[w]] / sum(idf[number[x]] for x in own)!r}D" for w in own) + ")" for own in notices[:n]) + ")"
    notice_index = [[(t, j) for t, own in enumerate(notices[:n]) for j, w in enumerate(own) if w == x] for x in vocabulary]
    noticed = "array(" + ", ".join(_structs(own, "t: int, j: int") for own in notice_index) + ")"
    at = at.withColumn("stand", F.expr(f"if(size(places) > 0, array_sort(array_intersect(flatten(transform(places, c -> transform(({words_at})[c.t], x -> struct(c.t as t, c.o as o, x.j as j)))), flatten(transform(hits, x -> transform(({noticed})[x.w], q -> struct(q.t as t, x.p - q.j as o, q.j as j)))))), null)"))
    share = f"({shares})[x.t][x.j]"
    score = f"aggregate(stand, struct(-1 as t, 0 as o, 0D as s, 0D as best), (a, x) -> struct(x.t as t, x.o as o, if(a.t = x.t and a.o = x.o, a.s, 0D) + {share} as s, greatest(a.best, if(a.t = x.t and a.o = x.o, a.s, 0D) + {share}) as best), a -> round(a.best, 9))"
    name = _texts(labels)
    joined = lambda e: F.expr(f"array_join(array_sort(array_distinct({e})), ',')")
    scored = at.select(
        F.col("id").alias(id_col), "n_words", F.size("base").cast("long").alias("n_base"),
        F.expr("cast(array_min(transform(base, c -> c.o)) as long)").alias("first_word"), F.expr("cast(array_max(transform(base, c -> c.o)) as long)").alias("last_word"),
        joined(f"transform(base, c -> ({name})[c.t])").alias("base_labels"), joined(f"transform(concat(base, places), c -> ({name})[c.t])").alias("labels"),
        F.expr(f"coalesce({score}, 0D)").alias("score"), F.expr(f"transform(places, c -> struct(({name})[c.t] as label, cast(c.o as long) as first_word))").alias("places"),
    )
    none = F.lit(None).cast("long")
    bare = found.where("size(hits) = 0").select(F.col("id").alias(id_col), "n_words", F.lit(0).cast("long").alias("n_base"), none.alias("first_word"), none.alias("last_word"), F.lit("").alias("base_labels"), F.lit("").alias("labels"), F.lit(0.0).alias("score"), F.expr("cast(array() as array<struct<label:string,first_word:bigint>>)").alias("places"))
    return scored.unionByName(bare)
