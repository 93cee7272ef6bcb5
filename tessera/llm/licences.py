"""Licence scans by a positional index of rare licence words.

Templates are licence notices, each with mandatory key phrases. One pass counts in
how many documents each licence word stands (its IDF comes from all documents).
The index holds, for each key phrase, its word with the highest IDF. A file's
words of the index, highest IDF first, say which templates are looked up: those
with all of their index words in the file. Each occurrence of an index word at
which its whole key phrase stands gives a start of the template (place in the
text minus place in the template). The starts of a template's key phrases are
intersected: a start of the first phrase counts when every other phrase has one
within ``TOLERANCE`` words. As all key phrases must stand, no start is missed,
however many licence words a document has; a name of a licence in passing is no
key phrase and gives no label.

Base phrases are found at all their places through the same postings. DataFrame
functions only; no shuffle but the small word count. Words are runs of ASCII letters, digits and characters above ASCII;
A-Z are lower-cased, nothing else.

Defined results: a null or empty text has no words, null places, empty labels
and score 0; repeated rows and null ids keep their rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

TOLERANCE = 4      # words by which a key phrase may stand off its place in the template

# Notices by which files state their licence: (label, notice, key phrases that must stand in it).
NOTICES = [
    ("agpl", "licensed under the gnu affero general public license",
     ("under the gnu affero general public license",)),
    ("agpl", "it under the terms of the gnu affero general public license as published by the free software foundation",
     ("under the terms of the gnu affero general public license",)),
    ("apache-2.0", "licensed under the apache license version 2 0",
     ("under the apache license", "version 2 0")),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the license is "
     "distributed on an as is basis without warranties or conditions of any kind either express or implied",
     ("unless required by applicable law or agreed to in writing", "without warranties or conditions of any kind")),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
     "that the following conditions are met",
     ("redistribution and use in source and binary forms", "with or without modification")),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("licensed under cc by nc",)),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("licensed under cc by sa",)),
    ("creative-commons", "licensed under a creative commons attribution license",
     ("under a creative commons attribution",)),
    ("gpl-2", "it under the terms of the gnu general public license as published by the free software foundation "
     "either version 2 of the license or at your option any later version",
     ("under the terms of the gnu general public license as published by the free software foundation", "version 2")),
    ("gpl-3", "licensed under the gnu general public license version 3",
     ("under the gnu general public license", "version 3")),
    ("gpl-3", "it under the terms of the gnu general public license as published by the free software foundation "
     "either version 3 of the license or at your option any later version",
     ("under the terms of the gnu general public license as published by the free software foundation", "version 3")),
    ("isc", "released under the isc license", ("under the isc license",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
     "granted", ("permission to use copy modify and or distribute this software", "with or without fee")),
    ("lgpl", "licensed under the gnu lesser general public license", ("under the gnu lesser general public license",)),
    ("lgpl", "it under the terms of the gnu lesser general public license as published by the free software foundation",
     ("under the terms of the gnu lesser general public license",)),
    ("mit", "released under the mit license", ("under the mit license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction",
     ("permission is hereby granted free of charge", "to deal in the software without restriction")),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0",
     ("subject to the terms of the mozilla public license",)),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     ("free and unencumbered software", "released into the public domain")),
]

# Names of licences in SPDX lines.
SPDX = {"agpl": ("agpl 3 0",), "apache-2.0": ("apache 2 0",), "bsd": ("bsd 2 clause", "bsd 3 clause"), "cc-by-nc": ("cc by nc 4 0",),
        "cc-by-sa": ("cc by sa 4 0",), "gpl-2": ("gpl 2 0",), "gpl-3": ("gpl 3 0",), "isc": ("isc",),
        "lgpl": ("lgpl 2 1", "lgpl 3 0"), "mit": ("mit",), "mpl-2.0": ("mpl 2 0",), "unlicense": ("unlicense",)}

TEMPLATES = NOTICES + [(label, f"spdx license identifier {name}", (f"spdx license identifier {name}",))
                       for label, names in SPDX.items() for name in names]

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words of a text. Two characters above ASCII have an ASCII letter as
    lower case; they are replaced by others above ASCII first."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    t = F.replace(F.replace(t, F.lit("\u212a"), F.lit("\u03ba")), F.lit("\u0130"), F.lit("\u0131"))
    return F.array_remove(F.split(F.lower(t), NOT_WORD), "")


def vocabulary(templates: list, base: dict) -> list[str]:
    """The licence words: those of base and key phrases."""
    return sorted({w for s in [*base, *(k for _, _, keys in templates for k in keys)] for w in s.split(" ")})


def word_frequencies(df: DataFrame, vocab: list[str], text_col: str) -> dict[str, int]:
    """In how many rows each word of the vocabulary stands; one row per word."""
    known = F.array(*[F.lit(w) for w in vocab])
    found = df.select(F.explode(F.array_intersect(words_of(F.col(text_col)), known)).alias("w"))
    return {r.w: int(r.n) for r in found.groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()}


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: list | None = None,
         base: dict | None = None) -> DataFrame:
    """Per row doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score (best share of a template's words that stand at their places;
    1 for a base phrase) and places (label, first word) of the method's labels."""
    templates, base = TEMPLATES if templates is None else templates, BASE if base is None else base
    phrases = sorted({*base, *(k for _, _, keys in templates for k in keys)})
    vocab = vocabulary(templates, base)
    seen = word_frequencies(df, vocab, text_col)
    rank = {w: i for i, w in enumerate(sorted(vocab, key=lambda w: (seen.get(w, 0), w)))}     # highest IDF first
    index = {p: min(p.split(" "), key=lambda w: rank[w]) for p in phrases}
    entries = F.array(*[F.lit(w) for w in sorted(set(index.values()), key=lambda w: rank[w])])

    out = df.select(F.col(id_col).alias("doc_id"), words_of(F.col(text_col)).alias("words"))
    # the file's words of the index, highest IDF first, and the places of those
    out = out.withColumns({"n_words": F.size("words").cast("long"), "rare": F.array_intersect(entries, "words")})
    hits = F.filter(F.transform("words", lambda w, i: F.struct(w.alias("w"), i.alias("i"))),
                    lambda h: F.array_contains("rare", h["w"]))
    out = out.withColumn("hits", F.when(F.size("rare") > 0, hits))
    out = out.withColumn("found", F.when(F.size("rare") > 0, _phrase_places(phrases, index)))
    out = out.withColumn("own", F.when(F.size("rare") > 0, _template_places(templates, phrases, index)))
    number = {p: k for k, p in enumerate(phrases)}
    at = {p: F.coalesce(F.get("found", F.lit(number[p])), F.array().cast("array<int>")) for p in base}
    base_labels = F.array_compact(F.array(*[F.when(F.size(at[p]) > 0, F.lit(label)) for p, label in sorted(base.items())]))
    own = F.coalesce("own", F.array().cast("array<struct<at:int,label:string,share:double>>"))
    out = out.withColumns({"every": F.concat(*[at[p] for p in sorted(base)]), "b": base_labels, "own": own})
    best = F.coalesce(F.array_max(F.transform("own", lambda x: x["share"])), F.lit(0.0))
    places = F.transform("own", lambda x: F.struct(x["label"].alias("label"),
                                                   F.greatest(x["at"], F.lit(0)).cast("long").alias("word")))
    named = F.concat("b", F.transform("own", lambda x: x["label"]))
    return out.select(
        "doc_id", "n_words", F.size("every").cast("long").alias("n_base"),
        F.array_min("every").cast("long").alias("first_word"), F.array_max("every").cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("b")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(named)), ",").alias("labels"),
        F.when(F.size("every") > 0, F.lit(1.0)).otherwise(best).alias("score"),
        F.array_sort(places).alias("places"))


def _list(text: str) -> Column:
    return F.split(F.lit(text), " ")


def _phrase_places(phrases: list[str], index: dict) -> Column:
    """Per phrase, its starts: places of its index word at which all its words stand."""
    table = F.array(*[F.struct(_list(p).alias("p"), F.lit(index[p]).alias("w"),
                               F.lit(p.split(" ").index(index[p])).alias("a")) for p in phrases])

    def starts(x):
        at = F.transform(F.filter("hits", lambda h: h["w"] == x["w"]), lambda h: h["i"] - x["a"])
        stood = F.filter(at, lambda s: F.when(s >= 0, F.slice("words", s + F.lit(1), F.size(x["p"])) == x["p"]))
        return F.when(F.array_contains("rare", x["w"]), stood).otherwise(F.array().cast("array<int>"))

    return F.transform(table, starts)


def _template_places(templates: list, phrases: list[str], index: dict) -> Column:
    """(at, label, share) for each start of a template's first key phrase near which
    every other one has a start. Looked up are the templates whose index words are
    all in the file."""
    number = {p: k for k, p in enumerate(phrases)}

    def key(statement, phrase):
        return F.struct(F.lit(number[phrase]).alias("k"),
                        F.lit(_position(statement.split(" "), phrase.split(" "))).alias("at"))

    table = F.array(*[F.struct(F.lit(label).alias("label"), _list(statement).alias("words"),
                               key(statement, keys[0]).alias("first"),
                               F.array(*[key(statement, k) for k in keys[1:]])
                               .cast("array<struct<k:int,at:int>>").alias("others"),
                               F.array(*[F.lit(w) for w in sorted({index[k] for k in keys})]).alias("entries"))
                      for label, statement, keys in templates])

    def starts(k):
        return F.transform(F.get("found", k["k"]), lambda i: i - k["at"])

    def near(k):
        return F.flatten(F.transform(starts(k), lambda s: F.sequence(s - F.lit(TOLERANCE), s + F.lit(TOLERANCE))))

    def place(t, s):
        same = F.filter(F.transform(t["words"], lambda w, k: F.coalesce(F.get("words", s + k) == w, F.lit(False))), lambda x: x)
        return F.struct(s.alias("at"), t["label"].alias("label"), (F.size(same) / F.size(t["words"])).alias("share"))

    def places(t):
        common = F.aggregate(t["others"], starts(t["first"]), lambda acc, k: F.array_intersect(acc, near(k)))
        return F.transform(common, lambda s: place(t, s))

    asked = F.filter(table, lambda t: F.size(F.array_except(t["entries"], "rare")) == 0)
    return F.flatten(F.transform(asked, places))


def _position(t: list[str], key: list[str]) -> int:
    for k in range(len(t) - len(key) + 1):
        if t[k:k + len(key)] == key:
            return k
    raise ValueError(f"key phrase {' '.join(key)} is not in its template")
