"""Licence scans by bands over overlapping windows, in built-in functions only.

A template (a licence notice or a whole licence text) and a text are word shingles.  Each template
belongs to a class by its length: the stride of a class is ``STRIDE`` doubled until it holds the
template, and a text is covered by windows of two strides that overlap by half, so a passage of up
to a stride, the whole template among them, lies whole in one window.

The bands of a template are its ``m - floor(least * m) + 1`` shingles of the smallest hashes, of
``m`` distinct ones (a bottom-k MinHash sketch).  A window that holds the share ``least`` of the
template lacks fewer shingles than it has bands, so at least one band meets, whatever else stands in
the window: no passage is missed.

Windows retrieve templates by equal bands; a retrieved template is verified once by exact
containment: the share of its distinct shingles that the window holds.  The result is the best
window of each text and template; ``window`` is the place the window starts at, in steps of
``STRIDE`` shingles for every class.

Templates are a small table and are broadcast after their size is checked.  A text's shingles never
leave its row: no shuffle but the small one that picks the best window.

Defined results: words are runs of letters and digits, compared in lower case; a template of fewer
words than a shingle is one shingle and is found only in texts of as few words; a null or empty text
or template matches nothing; ties go to the earliest window; repeated rows of an id count as one
text with the best window; further columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHINGLE = 3
STRIDE = 64
LEAST = 0.8
MOST_TEMPLATE_SHINGLES = 200_000  # broadcast bound; more templates are to be scanned in several passes
TEXTS = Path(__file__).parent / "licenses"  # whole licence texts, a file each
# Notices as they are commonly written.
NOTICES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "mit": "Released under the MIT License",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "bsd-redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
}


def computed(rows: DataFrame, name: str, value: Column, *keep: str) -> DataFrame:
    """The kept columns and a value that is computed once: a generator is a step that filters are not pushed through."""
    return rows.select(*keep, F.explode(F.array(value)).alias(name))


def with_shingles(rows: DataFrame, name: str, *keep: str) -> DataFrame:
    """The kept columns and the hashes of the word shingles of ``text``, in order."""
    words = F.regexp_extract_all(F.lower(F.coalesce(F.col("text"), F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), 0)
    hashed = computed(rows, "word_hashes", F.transform(words, lambda word: F.xxhash64(word)), *keep)
    every = F.transform("word_hashes", lambda word, at: F.xxhash64(word, *[F.get("word_hashes", at + k) for k in range(1, SHINGLE)]))
    last = F.greatest(F.size("word_hashes") - SHINGLE + 1, F.least(F.size("word_hashes"), F.lit(1)))
    return computed(hashed, name, F.slice(every, F.lit(1), last), *keep)


def whole_texts() -> dict[str, str]:
    """The whole licence texts by the names of their files."""
    return {path.stem: path.read_text("utf-8") for path in sorted(TEXTS.glob("*.txt"))}


def literal(values: list[int]) -> Column:
    """Numbers as one array that is folded to a constant."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>") if values else F.array().cast("array<bigint>")


def windows_of(stride: int, known: list[int], fewest: int) -> Column:
    """(stride, window, held) of each window of ``all``: the shingles of the class's templates it holds; none of a text too short to match."""
    last = F.greatest(F.ceil(F.size("all") / stride).cast("int") - 2, F.lit(0))
    numbers = F.when(F.size("all") >= fewest, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))

    def held(number: Column) -> Column:
        part = F.slice("all", number * stride + 1, F.lit(2 * stride))
        return F.struct(F.lit(stride).alias("stride"), number.alias("window"), F.array_intersect(part, literal(known)).alias("held"))

    return F.filter(F.transform(numbers, held), lambda each: F.size(each["held"]) > 0)


def scan(docs: DataFrame, templates: DataFrame, key: str = "doc_id", text: str = "text", name: str = "license", least: float = LEAST) -> DataFrame:
    """(key, license, containment, window): each text's best window for each template found in it; templates are (license, text)."""
    own = with_shingles(templates.select(F.col(name).alias("license"), "text"), "every", "license").where(F.size("every") > 0)
    doublings = F.greatest(F.ceil(F.log2(F.size("every") / STRIDE)), F.lit(0))
    own = own.select("license", (STRIDE * F.pow(F.lit(2), doublings)).cast("int").alias("stride"), F.array_distinct("every").alias("wanted"))
    found = own.select("stride", F.explode("wanted").alias("s")).distinct().limit(MOST_TEMPLATE_SHINGLES + 1).collect()
    if len(found) > MOST_TEMPLATE_SHINGLES:
        raise ValueError(f"the templates have more than {MOST_TEMPLATE_SHINGLES} shingles: scan them in several passes")
    enough = F.floor(F.size("wanted") * F.lit(float(least)))  # at most what a match must hold
    fewest = {row.stride: row.n for row in own.groupBy("stride").agg(F.min(enough).alias("n")).collect()}
    known = {stride: [row.s for row in found if row.stride == stride] for stride in sorted(fewest)}
    # Texts without any shingle of a template have no window to compare.
    every = literal(sorted({row.s for row in found}))
    rows = with_shingles(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), "all", "key").where(F.arrays_overlap("all", every))
    none = F.array().cast("array<struct<stride:int,window:int,held:array<bigint>>>")
    windows = F.concat(none, *[windows_of(stride, shingles, fewest[stride]) for stride, shingles in known.items()])
    held = rows.select("key", F.explode(windows).alias("w")).select("key", "w.stride", "w.window", "w.held")
    banded = held.select("key", "stride", "window", "held", F.explode("held").alias("band"))
    most = F.greatest(F.size("wanted") - enough + 1, F.lit(1)).cast("int")
    sketched = own.withColumn("template", F.xxhash64("license", "wanted")).dropDuplicates(["template"])
    sketched = sketched.select("template", "stride", "license", "wanted", F.slice(F.array_sort("wanted"), F.lit(1), most).alias("bands"))
    template_bands = sketched.select("template", "stride", F.explode("bands").alias("band"))
    met = banded.join(F.broadcast(template_bands), ["stride", "band"]).join(F.broadcast(sketched.drop("stride")), "template")
    # Of the bands of a template that meet, the first one stands for all.
    once = met.where(F.col("band") == F.get(F.array_intersect("bands", "held"), F.lit(0)))
    share = F.size(F.array_intersect("held", "wanted")) / F.size("wanted")
    place = (F.col("window") * (F.col("stride") / STRIDE)).cast("bigint").alias("window")
    verified = once.select("key", "license", place, share.alias("containment")).where(F.col("containment") >= least)
    best = verified.groupBy("key", "license").agg(
        F.max("containment").alias("containment"), F.min_by("window", F.struct(-F.col("containment"), "window")).alias("window")
    )
    return best.select(F.col("key").alias(key), "license", "containment", "window")
