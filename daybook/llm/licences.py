"""Licence scan: notices by TF-IDF cosine to templates, directories by inheritance.

Every line of a file that speaks of a licence, every paragraph or comment block of several lines that
does, and the file as a whole, is a sparse TF-IDF vector; its cosine to each template (notices,
headers and full licence texts) is a sum over the terms that both have, joined with the small table
of template terms. A file that consists of a notice for the most part is the licence file of its
directory. A file without a notice of its own takes the licence of its nearest directory upwards
that has one, found by joins of the paths' prefixes.

DataFrame operations only.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import cache
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Licence and text of notices; a licence may have several. Fixed values.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met"),
    ("CC-BY-4.0", "This work is licensed under the Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the Software without restriction"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]
_GNU = ("This {} is free software: you can redistribute it and/or modify it under the terms of the GNU {} as published by the "
        "Free Software Foundation, either version {} of the License, or (at your option) any later version.")
#: Headers that are too close to one of the above to go without a template of their own.
HEADERS = [
    ("AGPL-3.0", _GNU.format("program", "Affero General Public License", 3)),
    ("GPL-2.0", _GNU.format("program", "General Public License", 2)),
    ("LGPL-2.1", _GNU.format("library", "Lesser General Public License", "2.1")),
    ("LGPL-3.0", _GNU.format("library", "Lesser General Public License", 3)),
]
#: Lines and files without any of this hold no notice.
NOTICE = "(?i)licen[cs]e|copyright|permission|redistribution|spdx"
#: Cosine from which on a line is a notice, and share of a file's words in notices that makes it a licence file.
SIMILAR, WHOLE = 0.8, 0.5
#: Starts of comment lines; a paragraph ends where comments begin or end.
_MARK = r"[ \t]*(?://|#|--|;|%)"
#: Where a paragraph ends without an empty line: pattern and what is put in its place.
_BREAKS = [
    (r"(?md)^[^\p{L}\p{N}\n]+$", ""),  # nothing but marks
    (r"(?md)^(?=[ \t]*(?:/\*|<!--|\"{3}|'{3}))", "\n"),
    (r"(?md)(\*/|-->|\"{3}|'{3})[ \t\r]*$", "$1\n"),
    (rf"(?md)^({_MARK}.*)\n(?!{_MARK})", "$1\n\n"),
    (rf"(?md)^((?!{_MARK}).*)\n(?={_MARK})", "$1\n\n"),
    (r"(?md)^(?=[^\p{L}\p{N}\n]*(?:[0-9]{1,2}|[a-z])[.)][ \t])", "\n"),  # items of a list
    (r"(?mdi)^([^\p{L}\p{N}\n]*(?:copyright|c\))(?!.*(?:licen|permi|redis)).*)$", "$1\n"),
]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@cache
def full_texts() -> list[tuple[str, str]]:
    """Headers, full licence texts, and the paragraph of short ones that states the permission."""
    texts = [(f.stem, f.read_text()) for f in sorted((Path(__file__).parent / "licence_texts").glob("*.txt"))]
    grants = [(name, p) for name, text in texts if name == "MIT"
              for p in re.split(r"\n\s*\n", text) if p.startswith("Permission")]
    return HEADERS + grants + texts


def _vectors(templates, full) -> tuple[list[tuple], float, list[float]]:
    """Rows (term, idf, weight in each template), the idf of other terms, and the templates' norms.

    The idf is that among ``templates``; terms that only ``full`` has are other terms.
    """
    counts = [Counter(re.findall("[a-z0-9]+", text.lower())) for _, text in [*templates, *full]]
    df = Counter(t for c in counts[:len(templates)] for t in c)
    other = math.log(1 + len(templates)) + 1
    idf = {t: math.log((1 + len(templates)) / (1 + df[t])) + 1 if t in df else other for c in counts for t in c}
    rows = [(t, idf[t], *[float(c[t] * idf[t]) for c in counts]) for t in sorted(idf)]
    norms = [math.sqrt(sum((n * idf[t]) ** 2 for t, n in c.items())) for c in counts]
    return rows, other, norms


def _blocks(text):
    """The paragraphs and comment blocks of a text: runs of lines with words."""
    for pattern, new in _BREAKS:
        text = F.regexp_replace(text, F.lit(pattern), F.lit(new))
    return F.split(text, "\n{2,}")


def notices(files: DataFrame, templates=TEMPLATES, full=None) -> DataFrame:
    """(path, h, licence, score, whole) of files with a notice.

    ``files`` has path, text and h, a hash that tells texts of one path apart. The best of a file's
    lines, blocks of lines and the file as a whole counts; equal scores go to the licence first by
    name. ``whole`` are files that are close to a template as a whole or have most of their words in
    close lines and blocks. ``full`` are longer templates, by default ``full_texts()``.
    """
    full = full_texts() if full is None else full
    rows, other, norms = _vectors(templates, full)
    names = [name for name, _ in [*templates, *full]]
    spark = files.sparkSession
    schema = "term string, idf double, " + ", ".join(f"w{k} double" for k in range(len(names)))
    terms = F.broadcast(spark.createDataFrame(rows, schema))  # the words of the templates, a few thousand rows
    hits = files.where(F.col("text").rlike(NOTICE))
    speaks = lambda x: x.rlike(NOTICE)
    blocks = hits.select("path", "h", F.posexplode(F.filter(_blocks(F.col("text")), speaks)).alias("block", "body"))
    # unit -1 is a block, or with block -1 the file, as a whole
    lines = F.transform(F.filter(F.split("body", "\n"), speaks), lambda x, k: F.struct(k.alias("unit"), x.alias("line")))
    whole = F.array(F.struct(F.lit(-1).alias("unit"), F.col("body").alias("line")))
    units = (blocks.select("path", "h", "block", F.inline(
                F.when(F.col("body").contains("\n"), F.concat(lines, whole)).otherwise(lines)))
             .unionByName(hits.select("path", "h", F.lit(-1).alias("block"), F.lit(-1).alias("unit"), F.col("text").alias("line"))))
    words = F.split(F.translate("line", _UPPER, _LOWER), "[^a-z0-9]+")
    key = ["path", "h", "block", "unit"]
    tf = (units.select(*key, F.explode(words).alias("term")).where("term <> ''")
          .groupBy(*key, "term").agg(F.count("*").alias("n")).join(terms, "term", "left"))
    weight = F.col("n") * F.coalesce("idf", F.lit(other))
    sums = tf.groupBy(*key).agg(
        F.sum("n").alias("words"), F.sqrt(F.sum(weight * weight)).alias("norm"),
        *[F.coalesce(F.sum(weight * F.col(f"w{k}")), F.lit(0.0)).alias(f"d{k}") for k in range(len(names))])
    scored = [F.struct((-F.round(F.col(f"d{k}") / (F.col("norm") * norms[k]), 6)).alias("low"), F.lit(name).alias("licence"))
              for k, name in enumerate(names)]
    best = sums.select(*key, "words", F.array_min(F.array(*scored)).alias("best"))
    close = F.col("best.low") <= -SIMILAR
    count = F.when(close, F.col("words")).otherwise(0)
    # of a block that is close all words count, of others those of the lines that are
    of_blocks = best.groupBy("path", "h", "block").agg(
        F.min(F.when(close, F.col("best"))).alias("best"),
        F.greatest(F.sum(F.when(F.col("unit") >= 0, count).otherwise(0)),
                   F.max(F.when(F.col("unit") < 0, count).otherwise(0))).alias("noticed"),
        F.max(F.when(F.col("unit") < 0, F.col("words"))).alias("words"))
    return (of_blocks.groupBy("path", "h").agg(
        F.min("best").alias("best"), F.sum("noticed").alias("noticed"),
        F.max(F.when(F.col("block") < 0, F.col("words"))).alias("words"))
        .where("best is not null")
        .select("path", "h", F.col("best.licence").alias("licence"), (-F.col("best.low")).alias("score"),
                (F.col("noticed") >= WHOLE * F.col("words")).alias("whole")))


def _directory(path):
    """All of a path before its last slash."""
    return F.regexp_extract(path, "^(.*)/", 1)


def inherited(directories: DataFrame, licensed: DataFrame) -> DataFrame:
    """(directory, licence, licence_dir): the licence of the nearest directory upwards that has one.

    ``licensed`` has directory and licence, one row per licence file; the most frequent licence of a
    directory counts, then the first by name.
    """
    own = (licensed.groupBy("directory", "licence").agg(F.count("*").alias("n"))
           .groupBy("directory").agg(F.min(F.struct(-F.col("n"), "licence")).alias("best"))
           .select(F.col("directory").alias("licence_dir"), F.col("best.licence").alias("licence")))
    parts = F.split("directory", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "/"))
    return (directories.distinct().select("directory", F.explode(above).alias("licence_dir"))
            .join(own, "licence_dir")
            .groupBy("directory").agg(F.max(F.struct(F.length("licence_dir"), "licence_dir", "licence")).alias("near"))
            .select("directory", "near.licence", "near.licence_dir"))


def scan(files: DataFrame, templates=TEMPLATES, full=None) -> DataFrame:
    """One row per row of ``files`` (path, text, and columns that are kept): with licence, origin, score and licence_dir.

    origin is ``notice`` (score tells how close), ``directory`` (licence_dir tells which) or null.
    Null texts are empty and have no notice; a null path is the file ``''`` at the top. Empty texts
    can inherit. Repeated rows are judged alike; names of other columns do not matter.
    """
    kept = [c for c in files.columns if c not in ("path", "text")]
    base = files.select(F.struct(*kept).alias("kept") if kept else F.lit(None).alias("kept"),
                        F.coalesce("path", F.lit("")).alias("path"), F.coalesce("text", F.lit("")).alias("text"))
    base = base.withColumn("h", F.xxhash64("text"))
    found = notices(base.select("path", "h", "text"), templates, full)
    licensed = found.where("whole").select(_directory(F.col("path")).alias("directory"), "licence")
    slim = base.select("kept", "path", "h").withColumn("directory", _directory(F.col("path")))
    near = inherited(slim.select("directory"), licensed).withColumnRenamed("licence", "near")
    out = slim.join(found.drop("whole"), ["path", "h"], "left").join(near, "directory", "left")
    mine = F.col("licence").isNotNull()
    return out.select(
        *[F.col("kept")[c].alias(c) for c in kept], "path", F.coalesce("licence", "near").alias("licence"),
        F.when(mine, "notice").when(F.col("near").isNotNull(), "directory").alias("origin"),
        "score", F.when(~mine, F.col("licence_dir")).alias("licence_dir"))


def oracle(templates=TEMPLATES) -> str:
    """DuckDB SQL for ``scan`` over documents as files (see the registered query)."""
    values = ", ".join("({}, '{}', '{}')".format(k, n, t.replace("'", "''")) for k, (n, t) in enumerate(templates))
    return rf"""
        with files as (select doc_id, coalesce('/' || source
                           || regexp_replace(left(doc_id::varchar, greatest(length(doc_id::varchar) - 2, 0)::int), '(.)', '/\1', 'g')
                           || '/' || doc_id::varchar, '') as path, coalesce(text, '') as text from documents),
        t(tid, licence, text) as (values {values}),
        tw as (select tid, term, count(*) as n from (select tid, unnest(regexp_split_to_array(lower(text), '[^a-z0-9]+')) as term from t)
               where term <> '' group by tid, term),
        idf as (select term, ln((1.0 + (select count(*) from t)) / (1 + count(*))) + 1 as idf from tw group by term),
        tn as (select tid, sqrt(sum((n * idf) * (n * idf))) as norm from tw join idf using (term) group by tid),
        hits as (select distinct path, text from files where regexp_matches(text, '{NOTICE}')),
        lines as (select path, text, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as unit from hits),
        units as (select path, text, unit, line from lines where regexp_matches(line, '{NOTICE}')
                  union all select path, text, -1, text from hits),
        tf as (select path, text, unit, term, count(*) as n
               from (select path, text, unit, unnest(regexp_split_to_array(translate(line, '{_UPPER}', '{_LOWER}'), '[^a-z0-9]+')) as term from units)
               where term <> '' group by all),
        w as (select path, text, unit, term, n, n * coalesce(idf, ln(1.0 + (select count(*) from t)) + 1) as w
              from tf left join idf using (term)),
        norms as (select path, text, unit, sum(n) as words, sqrt(sum(w * w)) as norm from w group by all),
        dots as (select path, text, unit, tid, sum(w * tw.n * idf) as dot
                 from w join tw using (term) join idf using (term) group by all),
        scored as (select path, text, unit, licence, round(dot / (norms.norm * tn.norm), 6) as score
                   from dots join norms using (path, text, unit) join tn using (tid) join t using (tid)),
        best as (select path, text, unit, score, licence from scored where score >= {SIMILAR}
                 qualify row_number() over (partition by path, text, unit order by score desc, licence) = 1),
        found as (select path, text, arg_min(licence, (-score, licence)) as licence, max(score) as score,
                         sum(words) filter (unit > 0) as noticed
                  from best join norms using (path, text, unit) group by path, text),
        own as (select f.*, coalesce(noticed, 0) >= {WHOLE} * words as whole from found f
                join norms n on n.path = f.path and n.text = f.text and n.unit = -1),
        dirs as (select regexp_extract(path, '^(.*)/', 1) as dir, licence, count(*) as n from own where whole group by 1, 2
                 qualify row_number() over (partition by dir order by n desc, licence) = 1)
        select doc_id, path, coalesce(own.licence, near.licence) as licence,
               case when own.licence is not null then 'notice' when near.licence is not null then 'directory' end as origin,
               score, case when own.licence is null then near.dir end as licence_dir
        from files left join own using (path, text)
        left join (select f.path as p, arg_max(d.dir, length(d.dir)) as dir, arg_max(d.licence, length(d.dir)) as licence
                   from (select distinct path from files) f join dirs d on starts_with(f.path, d.dir || '/') group by f.path) near
        on near.p = files.path"""
