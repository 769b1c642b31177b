"""Op 11: licence notices by a positional index of rare words, in SQL functions only.

A template is a licence's notice as words, of which some phrases are mandatory. Its index is a posting per word:
where in the template the word stands.

1. Document frequencies of all template words are counted over all documents (one row per word reaches the driver,
   as many as the templates have words).
2. Of each template, the ANCHORS mandatory words of highest inverse document frequency are its keys. A text that
   lacks one of them lacks a mandatory phrase, so these are also the rarest words of that template which a text can
   be found by.
3. In each text, the places of all keys are listed in one pass. A key at word i of the text and word t of a template
   proposes that the template starts at word i - t; the starts that all keys of a template propose are intersected.
4. A start stands if every mandatory phrase stands there word by word. Its share is that of all template words found
   at their places.

A template of one mandatory phrase is thus found wherever its words stand consecutively, at every such place, whatever
the frequencies are. A text is handled alone: nothing but counts is shuffled, and time is linear in its words.

Rows: a null text is empty and has no words; a null doc_id is kept; repeated rows give equal results; words of equal
frequency are ordered by the alphabet, then by place; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from envgrade.llm.common import table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# What stands between words. Splitting there is many times cheaper than extracting the words one by one.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]++"
ANCHORS = 2


class Template(NamedTuple):
    label: str
    text: str
    #: Phrases of the text that must stand at their places.
    mandatory: tuple[str, ...]

    @property
    def words(self) -> list[str]:
        return self.text.split()

    def phrases(self) -> list[tuple[int, list[str]]]:
        """Where in the template each mandatory phrase stands, and its words."""
        out = []
        for phrase in self.mandatory:
            want = phrase.split()
            starts = [i for i in range(len(self.words)) if self.words[i : i + len(want)] == want]
            if not starts:
                raise ValueError(f"{phrase!r} is not in the template of {self.label}")
            out.append((starts[0], want))
        return out


def whole(label: str, text: str) -> Template:
    return Template(label, text, (text,))


# Phrases that make a label by themselves.
BASE = (
    whole("mit", "under the mit license"),
    whole("apache-2", "apache license version 2"),
    whole("cc-by-nc", "cc by nc"),
)
# The notices of well-known licences.
NOTICES = (
    whole("gpl-2", "gnu general public license version 2"),
    whole("gpl-3", "gnu general public license version 3"),
    whole("lgpl", "gnu lesser general public license"),
    whole("agpl-3", "gnu affero general public license version 3"),
    whole("cc-by-sa", "cc by sa"),
    whole("cc-by-sa", "creative commons attribution sharealike"),
    whole("cc0", "cc0 1 0 universal"),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software"
        " and associated documentation files",
        ("permission is hereby granted free of charge", "associated documentation files"),
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted"
        " provided that the following conditions are met",
        ("redistribution and use in source and binary forms", "provided that the following conditions are met"),
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee"
        " is hereby granted",
        ("permission to use copy modify", "with or without fee"),
    ),
    Template(
        "mpl-2",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        ("source code form", "mozilla public license v 2"),
    ),
    Template(
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        ("free and unencumbered software",),
    ),
)


def words_of(text_col: str) -> Column:
    """The words of a text: runs of digits, letters a to z once A to Z are lower-cased, and all beyond ASCII."""
    text = F.translate(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(text, BETWEEN), "")


def vocabulary(templates: tuple[Template, ...]) -> list[str]:
    return sorted({w for t in templates for w in t.words})


def document_frequencies(docs: DataFrame, templates: tuple[Template, ...], text_col: str = "text") -> DataFrame:
    """Documents that hold each template word, over all documents: (word, n)."""
    known = F.array(*[F.lit(w) for w in vocabulary(templates)])
    held = docs.select(F.array_intersect(words_of(text_col), known).alias("held"))
    return held.select(F.explode("held").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def keys_of(template: Template, frequency: dict[str, int]) -> list[tuple[int, str]]:
    """The template's rarest mandatory words and where in the template they stand."""
    places = {at + i: w for at, phrase in template.phrases() for i, w in enumerate(phrase)}
    return sorted(places.items(), key=lambda p: (frequency.get(p[1], 0), p[1], p[0]))[:ANCHORS]


def _array(words: list[str]) -> str:
    return f"array({', '.join(repr(w) for w in words)})"


def _starts(template: Template, frequency: dict[str, int]) -> str:
    """SQL for the starts of a template in ``words``; ``hits`` lists the places of all keys."""
    proposed = [
        f"transform(filter(hits, i -> words[i] = '{word}'), i -> i - {at})"
        for at, word in keys_of(template, frequency)
    ]
    met = proposed[0]
    for other in proposed[1:]:
        met = f"array_intersect({met}, {other})"
    verified = " and ".join(
        f"slice(words, o + {at + 1}, {len(phrase)}) = {_array(phrase)}" for at, phrase in template.phrases()
    )
    return f"filter({met}, o -> if(o >= 0, {verified}, false))"


def _found(template: Template, kind: str, frequency: dict[str, int]) -> str:
    size, words = len(template.words), _array(template.words)
    share = f"size(filter(sequence(0, {size - 1}), t -> get(words, o + t) = {words}[t])) / {size}D"
    place = f"named_struct('label', '{template.label}', 'kind', '{kind}', 'start', o, 'share', {share})"
    return f"transform({_starts(template, frequency)}, o -> {place})"


def scan(
    docs: DataFrame,
    base: tuple[Template, ...] = BASE,
    notices: tuple[Template, ...] = NOTICES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per document: doc_id, n_words and places, an array of (label, kind base or notice, start, share)."""
    templates = (*base, *notices)
    frequency = {r["word"]: r["n"] for r in document_frequencies(docs, templates, text_col).collect()}
    keys = sorted({w for t in templates for _, w in keys_of(t, frequency)})
    listed = ", ".join(repr(w) for w in keys)
    texts = docs.select(F.col(f"`{id_col}`").alias("doc_id"), words_of(text_col).alias("words"))
    hits = f"filter(transform(words, (w, i) -> if(w in ({listed}), i, -1)), i -> i >= 0)"
    found = [_found(t, kind, frequency) for kind, group in (("base", base), ("notice", notices)) for t in group]
    some = f"if(size(hits) > 0, concat({', '.join(found)}), null)"
    kind_of = "array<struct<label: string, kind: string, start: int, share: double>>"
    return texts.withColumn("hits", F.expr(hits)).select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.expr(f"coalesce({some}, cast(array() as {kind_of}))").alias("places"),
    )


def op11_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    base = "filter(places, p -> p.kind = 'base')"
    joined = "array_join(array_sort(array_distinct(transform({p}, p -> p.label))), ',')"
    starts = f"transform({base}, p -> cast(p.start as long))"
    return found.select(
        "doc_id",
        "n_words",
        F.expr(f"cast(size({base}) as long)").alias("n_base"),
        F.expr(f"array_min({starts})").alias("first_word"),
        F.expr(f"array_max({starts})").alias("last_word"),
        F.expr(joined.format(p=base)).alias("base_labels"),
        F.expr(joined.format(p="places")).alias("labels"),
        F.expr("coalesce(array_max(transform(places, p -> p.share)), 0D)").alias("score"),
    )
