"""License scan by an exact set-similarity join (operator 6), in DataFrame
operations only.

Templates and places of a text are token sets.  A place is a window of
``SPAN`` times as many tokens as the template has, across line ends.  The
templates' tokens are ordered globally, rare before frequent, by the number of
documents that hold them.  A document has a place that contains a template to
the threshold only if it holds one of the template's first tokens in that
order (prefix filter), enough of the templates' vocabulary (length filter),
and enough of it after the shared token (positional filter).  Pairs that pass
are verified for the document, and then in the windows around each of those
first tokens.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The base phrases and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: Notices by which a block of text states a license.
TEMPLATES = [
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("gpl-3.0", "licensed under the gnu general public license version 3"),
    ("gpl-2.0", "licensed under the gnu general public license version 2"),
    ("lgpl-3.0", "licensed under the gnu lesser general public license version 3"),
    ("agpl-3.0", "licensed under the gnu affero general public license version 3"),
    ("mit-notice", "released under the mit license"),
    ("mit-notice", "licensed under the mit license"),
    ("mit-notice", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("cc-by-4.0", "licensed under cc by 4 0"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]

#: Fixed value: tokens of a window per token of its template.
SPAN = 2

_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _spaced(col):
    """Words with one space before and after each (A-Z not yet lowered)."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(col, _GAP, " ")), F.lit(" "))


def _words(col):
    """Lower-case words of a spaced text."""
    return F.split(F.trim(F.translate(col, _UPPER, _LOWER)), " ")


def _tokens(col):
    """Distinct lower-case words of a spaced text."""
    return F.array_distinct(_words(col))


def _place(zone, at, template, width, lead):
    """The best window of ``width`` words of ``zone`` that holds its word
    number ``at``: the most template tokens, then one that starts with the
    template's first word ``lead``, then the shortest, then the first.  Words
    count from 1; a window starts and ends with template tokens."""
    starts = F.filter(F.sequence(F.greatest(F.lit(1), at - width + 1), at), lambda s: F.array_contains(template, F.get(zone, s - 1)))
    held = F.transform(starts, lambda s: F.struct(s.alias("s"), F.slice(zone, s, width).alias("w")))
    held = F.transform(held, lambda x: F.struct(x["s"].alias("s"), x["w"].alias("w"), F.array_intersect(template, x["w"]).alias("own")))
    held = F.transform(held, lambda x: F.struct(
        F.size(x["own"]).alias("overlap"), (F.get(x["w"], F.lit(0)) == lead).alias("leads"),
        (-F.greatest(at - x["s"] + 1, F.array_max(F.transform(x["own"], lambda t: F.array_position(x["w"], t).cast("int"))))).alias("short"), (-x["s"]).alias("early")))
    return F.array_max(held)


def base_places(docs: DataFrame, text: str = "spaced") -> list:
    """Columns of the phrase places: counts, first and last word, labels."""
    any_of = "(?i) (?:" + "|".join(PHRASES) + ")(?= )"
    c = F.col(text)
    words_before = lambda s: (F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit("")))).cast("long")
    has = F.col("n_base") > 0
    first = F.regexp_extract(c, f"(?is)^(.*?){any_of[4:]}", 1)
    last = F.regexp_extract(c, f"(?is)^(.*){any_of[4:]}", 1)
    return [F.when(has, words_before(first)).alias("first_word"), F.when(has, words_before(last)).alias("last_word"),
            F.when(has, F.array_sort(F.array_compact(F.array(*[F.when(c.rlike(f"(?i) {p} "), F.lit(v)) for p, v in PHRASES.items()]))))
            .otherwise(F.array().cast("array<string>")).alias("base_list")]


def scan(docs: DataFrame, threshold: float = 0.9) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: ``doc_id, n_words, n_base,
    first_word, last_word, base_labels, labels, score``.

    ``labels`` joins the base labels with those of all templates of which
    some place of the text holds at least ``threshold`` of the distinct
    tokens.  Where places of two templates overlap and the tokens of one
    contain those of the other, only the one met better counts there, on
    equal shares the larger.  ``score`` is the best share met, 0 without one.
    Null and empty texts have no words and empty labels.  Rows with one doc_id
    are judged each by its own text; an empty table gives no rows; extra
    columns are ignored."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    sets = [(label, sorted(set(t.split()))) for label, t in TEMPLATES]
    vocab = F.array(*[F.lit(t) for t in sorted({t for _, s in sets for t in s})])
    # documents per template token: at most as many rows as the templates have tokens
    held = d.select(F.explode(F.array_intersect(_tokens(_spaced(F.col("text"))), vocab)).alias("t")).groupBy("t").count()
    freq = {r["t"]: r["count"] for r in held.collect()}
    order = sorted({t for _, s in sets for t in s}, key=lambda t: (freq.get(t, 0), t))
    place = {t: i for i, t in enumerate(order)}
    prefix, rows = set(), []
    for i, (label, s) in enumerate(sets):
        ranked, need = sorted(s, key=place.get), math.ceil(threshold * len(s) - 1e-9)
        first, words = ranked[:len(s) - need + 1], TEMPLATES[i][1].split()
        rivals = [j for j, (_, o) in enumerate(sets) if j != i and (set(s) <= set(o) or set(o) <= set(s))]
        prefix.update(first)
        rows += [(t, i, label, ranked, first, rivals, words[0], SPAN * len(words), pos, len(s), need) for pos, t in enumerate(first)]
    index = F.broadcast(docs.sparkSession.createDataFrame(
        rows, "token string, tid int, label string, template array<string>, first array<string>, rivals array<int>, lead string, width int, pos int, size int, need int"))
    ordered = F.array(*[F.lit(t) for t in order])
    # a document without any prefix token has no place that can pass
    ink = r"[0-9A-Za-z[^\x00-\x7F]]"
    may = F.col("text").rlike(f"(?i)(?<!{ink})(?:" + "|".join(sorted(prefix)) + f")(?!{ink})")
    held = (d.where(may).withColumn("key", F.xxhash64("text")).dropDuplicates(["doc_id", "key"])
            .select("doc_id", "key", _words(_spaced(F.col("text"))).alias("words")).withColumn("own", F.array_intersect(ordered, "words")))
    token = F.explode(F.array_intersect("own", F.array(*[F.lit(t) for t in sorted(prefix)])))
    pairs = (held.withColumn("token", token).join(index, "token")
             .where(F.size("own") >= F.col("need"))
             .where(F.least(F.col("size") - F.col("pos"), F.size("own") - F.expr("array_position(own, token)").cast("int") + 1) >= F.col("need"))
             .where(F.size(F.array_intersect("template", "own")) >= F.col("need")))
    # several shared tokens give a pair several times; the first of them always passes the filters
    pairs = pairs.where(F.col("token") == F.get(F.array_intersect("first", "own"), F.lit(0)))
    hits = F.filter(F.transform("words", lambda w, i: F.when(F.array_contains("first", w), i + 1)), lambda i: i.isNotNull())
    zones = (pairs.withColumn("hit", F.explode(hits)).withColumn("from", F.greatest(F.lit(1), F.col("hit") - F.col("width") + 1))
             .withColumn("zone", F.slice("words", F.col("from"), F.col("hit") - F.col("from") + F.col("width"))).drop("words", "own")
             .where(F.size(F.array_intersect("template", "zone")) >= F.col("need"))
             .withColumn("p", _place(F.col("zone"), F.col("hit") - F.col("from") + 1, F.col("template"), F.col("width"), F.col("lead"))))
    lo = F.col("from") - F.col("p.early") - 1
    places = (zones.where("p.overlap >= need").groupBy("doc_id", "key")
              .agg(F.collect_set(F.struct("tid", "label", "rivals", (F.col("p.overlap") / F.col("size")).alias("share"), "size",
                                          lo.alias("lo"), (lo - F.col("p.short") - 1).alias("hi"),
                                          F.struct("p.overlap", "p.leads", "p.short").alias("fit"))).alias("all")))
    meet = lambda b, a: (b["lo"] <= a["hi"]) & (a["lo"] <= b["hi"])
    # of overlapping places of one template the best stay: the others reach into a second notice
    places = places.withColumn("all", F.filter("all", lambda a: ~F.exists("all", lambda b: (b["tid"] == a["tid"]) & meet(b, a) & (b["fit"] > a["fit"]))))
    beats = lambda b, a: (F.array_contains(a["rivals"], b["tid"]) & meet(b, a)
                          & ((b["share"] > a["share"]) | ((b["share"] == a["share"]) & (b["size"] > a["size"]))))
    best = places.select("doc_id", "key", F.array_max(F.transform("all", lambda a: a["share"])).alias("share"), F.array_distinct(F.transform(
        F.filter("all", lambda a: ~F.exists("all", lambda b: beats(b, a))), lambda a: a["label"])).alias("more"))
    best = best.withColumnsRenamed({"doc_id": "d", "key": "k"})
    any_of = "(?i) (?:" + "|".join(PHRASES) + ")(?= )"
    s = (d.withColumn("key", F.xxhash64("text")).withColumn("spaced", _spaced(F.col("text"))).drop("text")
         .withColumn("n_words", F.when(F.length("spaced") <= 2, F.lit(0)).otherwise(F.length("spaced") - F.length(F.replace("spaced", F.lit(" "), F.lit(""))) - 1).cast("long"))
         .withColumn("n_base", F.regexp_count("spaced", F.lit(any_of)).cast("long")))
    s = s.select("doc_id", "key", "n_words", "n_base", *base_places(s))
    out = s.join(best, s.doc_id.eqNullSafe(best.d) & (s.key == best.k), "left")
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_list", ",").alias("base_labels"),
                      F.array_join(F.array_sort(F.array_union("base_list", F.coalesce("more", F.array().cast("array<string>")))), ",").alias("labels"),
                      F.coalesce("share", F.lit(0.0)).alias("score"))
