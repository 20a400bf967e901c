"""License scans by sentence rules.

A text is normalised and cut at sentence ends and line ends.  Known licence
sentences (also ones that were wrapped over several lines) become identifiers;
the sequence of identifiers of a text is matched against ordered licence rules,
the longest rule first.

DataFrame functions only.  The scan is one pass without a shuffle: only pieces
that begin like a known sentence leave it.  Everything after it runs per
distinct text that has such a piece, so copies are matched once.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigie.llm.common import let, private_columns, read, written

# Identifiers of licence sentences and their text.
SENTENCES = {
    "work-gpl-3": "This work is licensed under the GNU General Public License, version 3",
    "licensed-cc-by-nc-4": "Licensed under CC BY-NC 4.0",
    "licensed-cc-by-4": "Licensed under CC BY 4.0",
    "released-mit": "Released under the MIT License",
    "licensed-mit": "Licensed under the MIT License",
    "licensed-apache-2": "Licensed under the Apache License, Version 2.0",
    "licensed-apache-2-defined": 'Licensed under the Apache License, Version 2.0 (the "License")',
    "apache-2-compliance": "you may not use this file except in compliance with the License",
    "apache-2-as-is": "Unless required by applicable law or agreed to in writing, software distributed under the License is "
                      "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    "mit-as-is": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
                 "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
                  "of the Software",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                 "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
                 "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
                 "permit persons to whom the Software is furnished to do so, subject to the following conditions",
    "bsd-forms": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
                 "following conditions are met",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
                  "disclaimer",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
                  "disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd-name": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
                "derived from this software without specific prior written permission",
    "gpl-3-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
                   "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
                   "later version",
    "gpl-2-later": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
                   "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any "
                   "later version",
    "spdx-mit": "SPDX-License-Identifier: MIT",
    "spdx-apache-2": "SPDX-License-Identifier: Apache-2.0",
    "spdx-bsd-3": "SPDX-License-Identifier: BSD-3-Clause",
    "spdx-gpl-3": "SPDX-License-Identifier: GPL-3.0-only",
}

# Licence rules, identifiers in order.
RULES = (
    ("GPL-3.0", ("work-gpl-3",)),
    ("GPL-3.0", ("spdx-gpl-3",)),
    ("GPL-3.0-or-later", ("gpl-3-later",)),
    ("GPL-2.0-or-later", ("gpl-2-later",)),
    ("CC-BY-NC-4.0", ("licensed-cc-by-nc-4",)),
    ("CC-BY-4.0", ("licensed-cc-by-4",)),
    ("MIT", ("released-mit",)),
    ("MIT", ("licensed-mit",)),
    ("MIT", ("spdx-mit",)),
    ("MIT", ("mit-grant", "mit-notice", "mit-as-is")),
    ("Apache-2.0", ("licensed-apache-2",)),
    ("Apache-2.0", ("spdx-apache-2",)),
    ("Apache-2.0", ("licensed-apache-2-defined", "apache-2-compliance", "apache-2-as-is")),
    ("Apache-2.0", ("licensed-apache-2-defined", "apache-2-compliance")),
    ("BSD-3-Clause", ("spdx-bsd-3",)),
    ("BSD-3-Clause", ("bsd-forms", "bsd-source", "bsd-binary", "bsd-name")),
    ("BSD-2-Clause", ("bsd-forms", "bsd-source", "bsd-binary")),
)

_MARK = "\x01"
_END = r"[.!?;:,]*[.!?;:]+(?=\s|$)|\n"
_OTHER = r"[^a-z0-9\x01\x{80}-\x{10FFFF}]+"
_AROUND = r" *\x01[ \x01]*"


def normalised(sentence: str) -> str:
    """What the scan makes of a known sentence, its inner cuts as spaces."""
    t = re.sub(_END, _MARK, sentence.lower())
    return re.sub(r"[^a-z0-9\u0080-\U0010ffff]+", " ", t).strip()


def pieces(text: Column) -> Column:
    """Normalised pieces between sentence ends and line ends; null has none."""
    t = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), _END, _MARK)
    t = F.regexp_replace(F.regexp_replace(t, _OTHER, " "), _AROUND, _MARK)
    return F.array_remove(F.split(F.trim(t), _MARK), "")


def known(spark: SparkSession, sentences: dict[str, str] = SENTENCES) -> DataFrame:
    return spark.createDataFrame([(k, normalised(v)) for k, v in sentences.items()], "sentence_id string, sentence string")


def _outermost(d: DataFrame, start: str, end: str) -> DataFrame:
    """Of the matches of a text, those that do not lie inside another one (the longest at each start)."""
    w = Window.partitionBy("d0", "d1").orderBy(F.col(start).asc(), F.col(end).desc(), "name")
    before = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return d.withColumn("__before", before).where(F.col("__before").isNull() | (F.col(end) > F.col("__before"))).drop("__before")


@private_columns("text")
def scan(df: DataFrame, text: str = "text", sentences: dict[str, str] = SENTENCES,
         rules: tuple[tuple[str, tuple[str, ...]], ...] = RULES, drop: tuple[str, ...] = ()) -> DataFrame:
    """The rows of ``df`` with licences, sentence_ids (both in text order), n_matches and n_sentences.

    ``licences``: names of the matched rules, each once, in order of first
    match.  ``sentence_ids``: the identifiers found, also those no rule uses.
    Result for odd input: null and empty texts have none; repeated rows get the
    same; a sentence given twice counts twice; no rows give no rows; input
    columns named like a result are replaced.
    """
    spark = df.sparkSession
    names = ("licences", "sentence_ids", "n_matches", "n_sentences")
    d = df.drop(*[c for c in names if c in df.columns and c != text])
    keys = [F.xxhash64(F.coalesce(text, F.lit(""))).alias("__d0"), F.xxhash64(F.lit("second"), F.coalesce(text, F.lit(""))).alias("__d1")]
    texts = {k: normalised(v) for k, v in sentences.items()}
    full = sorted(set(texts.values()) - {""}) or [""]
    begun = sorted({" ".join(t.split()[:n]) for t in full for n in range(1, len(t.split()) + 1)}) or [""]
    longest = max(len(t.split()) for t in full) or 1
    found = d.select(*keys, pieces(F.col(text)).alias("p"))
    # pieces that begin a known sentence; each is followed while the words still begin one.
    # No filter here: one would be pushed down and cut the text again for every piece.
    starts = F.filter(F.sequence(F.lit(0), F.size("p") - 1), lambda i: F.get("p", i).isin(begun))
    found = found.withColumn("s", starts)

    def follow(a: Column, x: Column) -> Column:
        t = F.when(a["n"] == 0, x).otherwise(F.concat(a["t"], F.lit(" "), x))
        stop = F.struct(F.lit(None).cast("string").alias("t"), a["n"].alias("n"))
        return F.when(t.isin(begun), F.struct(t.alias("t"), (a["n"] + 1).alias("n"))).otherwise(stop)

    def matches(i: Column) -> Column:
        zero = F.struct(F.lit("").alias("t"), F.lit(0).alias("n"))
        length = F.aggregate(F.slice("p", i + 1, longest), zero, follow, lambda a: a["n"])
        found = lambda n: F.filter(F.transform(F.sequence(F.lit(1), n), lambda m: F.struct(
            i.alias("i"), (i + m - 1).alias("z"), F.array_join(F.slice("p", i + 1, m), " ").alias("sentence"))),
            lambda x: x["sentence"].isin(full))
        return let(F.greatest(length, F.lit(1)), found)

    cand = found.select(F.col("__d0").alias("d0"), F.col("__d1").alias("d1"), F.explode_outer(F.flatten(F.transform("s", matches))).alias("c"))
    cand = written(cand.where("c is not null").select("d0", "d1", "c.*").distinct(), "licence-sentences")
    hits = cand.join(F.broadcast(known(spark, sentences)), "sentence") \
        .select("d0", "d1", "i", "z", F.col("sentence_id").alias("name"))
    hits = _outermost(hits, "i", "z")
    seq = hits.groupBy("d0", "d1").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "name"))), lambda x: x["name"]).alias("ids"))
    seq = written(seq, "licence-ids")
    table = spark.createDataFrame([(n, list(r), r[0], len(r)) for n, r in rules if r], "name string, rule array<string>, head string, n int")
    at = seq.select("d0", "d1", "ids", F.posexplode("ids").alias("i", "head")).join(F.broadcast(table), "head")
    at = at.where(F.slice("ids", F.col("i") + 1, F.col("n")) == F.col("rule"))
    at = _outermost(at.select("d0", "d1", "i", (F.col("i") + F.col("n") - 1).alias("z"), "name").distinct(), "i", "z")
    lic = at.groupBy("d0", "d1").agg(F.count(F.lit(1)).alias("n_matches"), F.array_distinct(F.transform(
        F.sort_array(F.collect_list(F.struct("i", "name"))), lambda x: x["name"])).alias("licences"))
    both = seq.join(lic, ["d0", "d1"], "left")
    d = d.select("*", *keys).drop(*drop)
    both = written(both.withColumnsRenamed({"d0": "__d0", "d1": "__d1"}), "licences")
    d = d.join(both.withColumnRenamed("licences", "__lic"), ["__d0", "__d1"], "left")
    none = F.array().cast("array<string>")
    return d.drop("__d0", "__d1").withColumns({
        "licences": F.coalesce("__lic", none), "sentence_ids": F.coalesce("ids", none),
        "n_matches": F.coalesce("n_matches", F.lit(0)).cast("long"),
        "n_sentences": F.coalesce(F.size("ids"), F.lit(0)).cast("long")}).drop("ids", "__lic")


def op4_sentence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; licences and sentence identifiers as comma-joined text."""
    d = scan(read(spark, sf_dir, "documents").select("doc_id", "text"), drop=("text",))
    return d.select("doc_id", F.array_join("licences", ",").alias("licences"),
                    F.array_join("sentence_ids", ",").alias("sentence_ids"), "n_matches", "n_sentences")


def _sql() -> str:
    """The same scan as one DuckDB query."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    known_rows = ", ".join(f"({quote(k)}, {quote(normalised(v))})" for k, v in SENTENCES.items())
    rule_rows = ", ".join(f"({quote(n)}, [{', '.join(map(quote, r))}])" for n, r in RULES)
    return f"""
with k(name, sentence) as (values {known_rows}),
r(name, rule) as (values {rule_rows}),
t as (select doc_id, list_filter(string_split(trim(regexp_replace(regexp_replace(regexp_replace(lower(coalesce(text, '')),
        '[.!?;:,]*[.!?;:]+(\\s|$)|\\n', chr(1), 'g'), '[^a-z0-9\\x01\\x{{80}}-\\x{{10FFFF}}]+', ' ', 'g'),
        ' *\\x01[ \\x01]*', chr(1), 'g')), chr(1)), lambda x: x <> '') as p from documents),
s as (select doc_id, p, unnest(range(1, len(p) + 1)) as i from t),
c as (select doc_id, i, z, array_to_string(p[i:z], ' ') as sentence
      from (select doc_id, p, i, unnest(range(i, least(len(p), i + 80) + 1)) as z from s
            where string_split(p[i], ' ')[1] in (select string_split(sentence, ' ')[1] from k))),
h as (select doc_id, i, z, name from c join k using (sentence)),
o as (select * from h where not exists (select 1 from h g where g.doc_id = h.doc_id and g.i <= h.i and g.z >= h.z and (g.i < h.i or g.z > h.z))),
q as (select doc_id, list(name order by i) as ids from o group by doc_id),
m as (select doc_id, i, i + len(rule) - 1 as z, r.name
      from (select doc_id, ids, unnest(range(1, len(ids) + 1)) as i from q) join r on ids[i:i + len(rule) - 1] = rule),
b as (select distinct * from m where not exists (select 1 from m g where g.doc_id = m.doc_id and g.i <= m.i and g.z >= m.z and (g.i < m.i or g.z > m.z))),
f as (select doc_id, name, min(i) as i, count(*) as n from b group by doc_id, name),
l as (select doc_id, string_agg(name, ',' order by i) as licences, cast(sum(n) as bigint) as n_matches from f group by doc_id)
select doc_id, coalesce(licences, '') as licences, coalesce(array_to_string(ids, ','), '') as sentence_ids,
       coalesce(n_matches, 0) as n_matches, cast(coalesce(len(ids), 0) as bigint) as n_sentences
from documents left join q using (doc_id) left join l using (doc_id)
"""


SQL = _sql()
