"""License texts in documents: an exact set-similarity join of text blocks with templates.

A block is a window of consecutive words of the whole text, whatever lines they stand on, twice as long as
the template it is compared with. Words outside all templates can never count, so a text is first the set of
its template words. They are ordered by how many texts hold them, rare first; a text and a template that
share enough words share one of the first few of each (prefix), the text has enough of them (length), and
enough words come after the shared one (position). Only the texts left are read again: the places of their
template words are laid out, and the distinct words of every window are counted exactly. The first reading
moves no text, the second only those left. DataFrame functions only. Templates are a parameter; their words
are literals of the plan.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pointmill.llm.common import saved

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = 1 << 24
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases that are evidence by themselves, and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Sentences of well-known licenses and notices, and their labels.
TEMPLATES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit",
    "licensed under the apache license version 2 0 you may not use this file except in compliance with the license": "apache-2.0",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license": "gpl",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd",
    "this source code form is subject to the terms of the mozilla public license": "mpl-2.0",
    "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted": "isc",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "all rights reserved no part of this publication may be reproduced without permission": "reserved",
    "licensed under the apache license version 2 0": "apache-2.0",
    "released under the mit license": "mit",
}


@dataclass(frozen=True)
class Settings:
    """percent: share of a template's distinct words that a block must hold. least_words: as many of them at least, or all. spread: words of a block for one of its template."""

    percent: int = 80
    least_words: int = 5
    spread: int = 2

    def need(self, words: int) -> int:
        return max(-(-words * self.percent // 100), min(words, self.least_words))


def _phrase(joined: Column, n_words: Column, phrase: str) -> tuple[Column, Column, Column]:
    """Places of a phrase, the first and the last; joined has a blank before, between and after the words."""
    parts = F.when(joined.contains(f" {phrase} "), F.split(joined, f" {phrase}(?= )", -1))
    blanks = lambda s: F.length(s) - F.length(F.replace(s, F.lit(" ")))
    last = n_words - (blanks(F.element_at(parts, -1)) - 1) - len(phrase.split())
    return F.coalesce(F.size(parts) - 1, F.lit(0)), blanks(parts[0]), last


def _split(text: Column) -> Column:
    """The words of a text, with a blank before, between and after them."""
    lowered = F.translate(text, _UPPER, _LOWER)
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(lowered, _SEPARATORS, " ")), F.lit(" "))


def _listed(joined: Column) -> Column:
    return F.filter(F.split(joined, " "), lambda word: word != "")


def _read(docs: DataFrame, id_column: str, text_column: str, vocabulary: list[str], least: int, phrases: dict[str, str]) -> DataFrame:
    """(id, key, n_words, n_base, first_word, last_word, base, words) from one reading; words: the distinct template words, if least at least."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    read = docs.select(F.col(id_column).alias("id"), F.md5(text).alias("key"), _split(text).alias("joined"))
    read = read.withColumn("list", _listed(F.col("joined"))).withColumn("n_words", F.size("list").cast("long"))
    places = {p: _phrase(F.col("joined"), F.col("n_words"), p) for p in phrases}
    held = F.array_intersect("list", F.lit(vocabulary))
    return read.select(
        "id",
        "key",
        "n_words",
        sum((n for n, _, _ in places.values()), F.lit(0)).cast("long").alias("n_base"),
        F.array_min(F.array(*[first.cast("long") for _, first, _ in places.values()])).alias("first_word"),
        F.array_max(F.array(*[last.cast("long") for _, _, last in places.values()])).alias("last_word"),
        F.array_compact(F.array(*[F.when(n > 0, F.lit(phrases[p])) for p, (n, _, _) in places.items()])).alias("base"),
        held.alias("words"),
    ).withColumn("words", F.when(F.size("words") >= least, F.col("words")))


def matching_texts(texts: DataFrame, templates: dict[str, str], settings: Settings) -> DataFrame:
    """(key, template) of each text of (key, words), words distinct, that holds enough words of a template at all."""
    sets = {t: sorted(set(t.split())) for t in templates}
    vocabulary = sorted({w for words in sets.values() for w in words})
    # A number for each word of the templates.
    counted = {r.word: r.n for r in texts.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n")).collect()}
    rare_first = sorted(vocabulary, key=lambda w: (counted.get(w, 0), w))
    rank = {w: k for k, w in enumerate(rare_first)}
    needs = {t: settings.need(len(words)) for t, words in sets.items()}
    index = []
    for t, words in sets.items():
        ordered = sorted(words, key=rank.__getitem__)
        index += [(w, t, ordered, len(words), needs[t], at) for at, w in enumerate(ordered[: len(words) - needs[t] + 1])]
    prefixes = texts.sparkSession.createDataFrame(index, "word string, template string, template_words array<string>, size int, need int, their_place int")
    ordered = texts.select("key", F.array_intersect(F.lit(rare_first), F.col("words")).alias("words"))
    mine = F.slice("words", F.lit(1), F.size("words") - min(needs.values()) + 1)
    each = ordered.select("key", "words", F.posexplode(mine).alias("place", "word"))
    pairs = each.join(prefixes, "word").where("size(words) >= need")
    pairs = pairs.where("least(size(words) - place, size - their_place) >= need")
    return pairs.where(F.size(F.array_intersect("words", "template_words")) >= F.col("need")).select("key", "template").distinct()


def matching_blocks(texts: DataFrame, pairs: DataFrame, templates: dict[str, str], settings: Settings) -> DataFrame:
    """(key, template, score) of each pair of (key, template) of which some block of the text (key, text) holds enough words."""
    about = []
    for t in templates:
        words = t.split()
        about += [(t, w, len(set(words)), settings.need(len(set(words))), max(1, settings.spread * len(words) - 1)) for w in sorted(set(words))]
    about = texts.sparkSession.createDataFrame(about, "template string, word string, size int, need int, reach int")
    places = texts.select("key", F.posexplode(_listed(_split(F.col("text")))).alias("place", "word"))
    # A place for each template it may belong to: words of templates only, of texts that a pair names.
    places = places.join(pairs.join(about, "template"), ["key", "word"])
    # In units of the block's length, so that one frame serves all templates; no block is as long as a unit has parts.
    block = Window.partitionBy("key", "template").orderBy(F.expr(f"place * {_PARTS}L div reach")).rangeBetween(-_PARTS, 0)
    held = places.withColumn("shared", F.size(F.collect_set("word").over(block)))
    found = held.where("shared >= need").groupBy("key", "template").agg(F.max(F.col("shared") / F.col("size")).alias("score"))
    return found


def license_scan(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    templates: dict[str, str] | None = None,
    phrases: dict[str, str] | None = None,
    settings: Settings | None = None,
) -> DataFrame:
    """One row per row of docs: id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_blocks.

    Words are runs of ASCII letters and digits and of other characters beyond ASCII, A-Z lowered. n_base counts the places of all
    phrases. labels are those of phrases and of templates of which some block holds enough words; n_blocks counts these templates;
    score is the largest share of such a template that a block holds, 1 for a phrase, 0 for nothing. NULL texts are empty: no
    words, no labels. Repeated rows are reported each. An empty table gives an empty result; other columns are ignored.
    """
    templates, phrases, settings = templates or TEMPLATES, phrases or PHRASES, settings or Settings()
    vocabulary = sorted({w for t in templates for w in t.split()})
    least = min(settings.need(len(set(t.split()))) for t in templates)
    read = saved(_read(docs, id_column, text_column, vocabulary, least, phrases), "license_texts")
    # Written, so that their number is known before the texts are joined with them.
    pairs = saved(matching_texts(read.where("words IS NOT NULL").select("key", "words"), templates, settings), "license_pairs")
    text = F.coalesce(F.col(text_column), F.lit(""))
    left = docs.select(F.md5(text).alias("key"), text.alias("text")).join(pairs.select("key").distinct(), "key", "left_semi")
    blocks = matching_blocks(left.dropDuplicates(["key"]), pairs, templates, settings)
    label = F.create_map(*[F.lit(x) for t in templates for x in (t, templates[t])])[F.col("template")]
    found = blocks.groupBy("key").agg(F.collect_set(label).alias("found"), F.max("score").alias("best"), F.count("*").alias("n_blocks"))
    none = F.array().cast("array<string>")
    joined = read.drop("words").join(found, "key", "left")
    based = F.when(F.size("base") > 0, 1.0)
    return joined.select(
        F.col("id").alias(id_column),
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join(F.array_sort(F.array_distinct("base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce("found", none))), ",").alias("labels"),
        F.coalesce(based, F.col("best"), F.lit(0.0)).alias("score"),
        F.coalesce("n_blocks", F.lit(0)).cast("long").alias("n_blocks"),
    )
