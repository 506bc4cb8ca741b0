"""Licence scans: sentences are mapped to identifiers, and sequences of them to ordered licence rules."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortscope.llm.text import chunks
from cohortscope.plans.ship import ship

# Sentences of published licence texts and notices, as they are once normalised.
SENTENCES = {
    "mit-notice": ("released under the mit license", "licensed under the mit license", "this project is licensed under the mit license"),
    "mit-grant": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
        " documentation files the software to deal in the software without restriction including without limitation"
        " the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to"
        " permit persons to whom the software is furnished to do so subject to the following conditions",
    ),
    "mit-keep": (
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    ),
    "as-is": (
        "the software is provided as is without warranty of any kind express or implied including but not limited to"
        " the warranties of merchantability fitness for a particular purpose and noninfringement",
    ),
    "apache-2-notice": (
        "licensed under the apache license version 2 0",
        "licensed under the apache license version 2 0 the license",
        "this project is licensed under the apache license version 2 0",
    ),
    "apache-2-comply": ("you may not use this file except in compliance with the license",),
    "apache-2-copy": ("you may obtain a copy of the license at http www apache org licenses license 2 0",),
    "gpl-3-notice": (
        "this work is licensed under the gnu general public license version 3",
        "licensed under the gnu general public license version 3",
        "released under the gnu general public license version 3",
    ),
    "gpl-2-notice": ("licensed under the gnu general public license version 2", "this work is licensed under the gnu general public license version 2"),
    "gpl-free": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general"
        " public license as published by the free software foundation either version 3 of the license or at your"
        " option any later version",
    ),
    "gpl-hope": (
        "this program is distributed in the hope that it will be useful but without any warranty without even the"
        " implied warranty of merchantability or fitness for a particular purpose",
    ),
    "cc-by-notice": ("licensed under cc by 4 0", "this work is licensed under cc by 4 0"),
    "cc-by-sa-notice": ("licensed under cc by sa 4 0", "this work is licensed under cc by sa 4 0"),
    "cc-by-nc-notice": ("licensed under cc by nc 4 0", "this work is licensed under cc by nc 4 0"),
    "bsd-grant": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that"
        " the following conditions are met",
    ),
    "bsd-source": (
        "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    ),
    "bsd-binary": (
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the"
        " following disclaimer in the documentation and or other materials provided with the distribution",
    ),
    "bsd-names": (
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote"
        " products derived from this software without specific prior written permission",
    ),
}

# A licence's rule is the order in which its sentences stand.
RULES = {
    "mit-notice": ("MIT", ("mit-notice",)),
    "mit-text": ("MIT", ("mit-grant", "mit-keep", "as-is")),
    "apache-2-notice": ("Apache-2.0", ("apache-2-notice",)),
    "apache-2-header": ("Apache-2.0", ("apache-2-notice", "apache-2-comply", "apache-2-copy")),
    "gpl-3-notice": ("GPL-3.0", ("gpl-3-notice",)),
    "gpl-3-header": ("GPL-3.0-or-later", ("gpl-free", "gpl-hope")),
    "gpl-2-notice": ("GPL-2.0", ("gpl-2-notice",)),
    "cc-by-notice": ("CC-BY-4.0", ("cc-by-notice",)),
    "cc-by-sa-notice": ("CC-BY-SA-4.0", ("cc-by-sa-notice",)),
    "cc-by-nc-notice": ("CC-BY-NC-4.0", ("cc-by-nc-notice",)),
    "bsd-2": ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    "bsd-3": ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
}

# Other sentences that may stand among those of a match (copyright lines, an address).
SLACK = 6


_CUT = re.compile(r"([.!?;:])[\x20\x09]+")
_OTHER = re.compile(r"[^a-z0-9]+")
# A full stop or the like at the end of a part, also before closing quotes and brackets.
_STOP = re.compile(r"[.!?][\"')\]]*\s*\Z")


def parts_of(text: str) -> list[str]:
    """Parts of a text: cut at line ends, and at white space after a full stop or the like."""
    return _CUT.sub("\\1\n", text).split("\n")


def normalised(text: str) -> str:
    """Lower-case letters and digits of ASCII, one space for each run of anything else."""
    return _OTHER.sub(" ", text.lower()).strip()


def found_in(text: str, wanted: list[tuple[str, str]]) -> list[tuple[int, int, int, str]]:
    """Known sentences of a text: (first part, last part, how many sentences end before it, identifier).

    A sentence may run over any number of parts, so wrapped lines, blank lines and its own punctuation do
    not hide it; it begins where a part begins and ends where one ends. Sentences end at full stops, at
    blank lines and with each known sentence, single line ends do not end them.
    """
    parts = parts_of(text)
    plain = [normalised(p) for p in parts]
    starts, ends, at = {}, {}, 1
    for i, p in enumerate(plain):
        if p:
            starts[at] = i
            ends[at + len(p)] = i
            at += len(p) + 1
    joined = f" {' '.join(p for p in plain if p)} "
    found: dict[tuple[int, str], int] = {}
    for sentence, name in wanted:
        at = joined.find(sentence)
        while at >= 0:
            first, last = starts.get(at + 1), ends.get(at + len(sentence) - 1)
            if first is not None and last is not None:
                found[first, name] = min(last, found.get((first, name), last))
            at = joined.find(sentence, at + 1)
    closing = set(found.values())
    before, count = [], 0
    for i, p in enumerate(plain):
        before.append(count)
        if p and (i in closing or _STOP.search(parts[i]) or not any(plain[i + 1 : i + 2])):
            count += 1
    return [(first, last, before[first], name) for (first, name), last in found.items()]


def _found_batches(wanted: list[tuple[str, str]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            rows = []
            for i, text in enumerate(batch.column(2).to_pylist()):
                whole = f" {normalised(text or '')} "
                # Most texts hold no known sentence at all.
                if held := [w for w in wanted if w[0] in whole]:
                    rows += [(i, *f) for f in found_in(text, held)]
            if not rows:
                continue
            owner, first, last, before, name = zip(*rows)
            keys = [batch.column(k).take(pa.array(owner)) for k in (0, 1)]
            places = [pa.array(c, pa.int32()) for c in (first, last, before)]
            yield pa.RecordBatch.from_arrays([*keys, *places, pa.array(name, pa.string())], ["doc_id", "row", "at", "upto", "before", "id"])

    return run


def licences(
    docs: DataFrame,
    sentences: dict[str, tuple[str, ...]] = SENTENCES,
    rules: dict[str, tuple[str, tuple[str, ...]]] = RULES,
    slack: int = SLACK,
) -> DataFrame:
    """A row per rule and place matched: doc_id, licence, rule, first_sentence, last_sentence, sentences.

    A rule matches when its sentences stand in order, with at most ``slack`` others between the first and
    the last. Wrapped lines belong to one sentence (see ``found_in``). The numbers are those of the
    document's parts (lines, cut after ``.!?;:`` and white space), from 0: the part where the first sentence
    begins and the one where the last ends. A match inside a longer match of the same document is left out. Null and empty texts match nothing; rows that share a doc_id are each
    scanned (told apart by their text), rows that repeat both are reported once. The tables of sentences
    and rules are arguments of a few kilobytes, so the rules are broadcast and the sentences go with the tasks.
    """
    spark = docs.sparkSession
    ship(spark)
    wanted = sorted({(f" {s} ", k) for k, texts in sentences.items() for s in texts})
    ordered = spark.createDataFrame([(r, n, list(ids)) for r, (n, ids) in rules.items()], "rule string, licence string, ids array<string>")
    rows = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("row"), F.col("text").cast("string").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(_found_batches(wanted), f"doc_id {kind}, row long, at int, upto int, before int, id string")
    per_doc = found.groupBy("doc_id", "row").agg(F.array_sort(F.collect_set(F.struct("at", "upto", "before", "id"))).alias("found"))
    # From each place of the rule's first sentence, every further one is taken as early as it comes.
    nexts = "get(filter(found, f -> f.id = id and f.at > so_far.upto), 0)"
    last = f"aggregate(slice(ids, 2, size(ids)), start, (so_far, id) -> {nexts})"
    starts = per_doc.join(F.broadcast(ordered), F.expr("exists(found, f -> f.id = ids[0])")).withColumn(
        "start", F.explode(F.expr("filter(found, f -> f.id = ids[0])"))
    )
    matches = starts.withColumn("last", F.expr(last)).where(f"last is not null and last.before - start.before < size(ids) + {slack}")
    matches = matches.select("doc_id", "row", "rule", "licence", F.col("start.at").alias("first"), F.col("last.upto").alias("last"), F.size("ids").alias("n"))
    match = F.struct("rule", "licence", "first", "last", "n")
    together = matches.groupBy("doc_id", "row").agg(F.collect_list(match).alias("all"))
    inside = "o.first <= m.first and o.last >= m.last and o.n > m.n"
    kept = together.select("doc_id", F.inline(F.expr(f"filter(all, m -> not exists(all, o -> {inside}))")))
    return kept.select(
        "doc_id",
        "licence",
        "rule",
        F.col("first").cast("long").alias("first_sentence"),
        F.col("last").cast("long").alias("last_sentence"),
        F.col("n").cast("long").alias("sentences"),
    )


def oracle() -> str:
    """The same in SQL for a rule of any length, by following its sentences one after the other."""
    known = ", ".join(f"('{s}', '{k}')" for k, texts in SENTENCES.items() for s in texts)
    steps = ", ".join(f"('{r}', '{n}', {i}, '{s}', {len(ids)})" for r, (n, ids) in RULES.items() for i, s in enumerate(ids))
    return f"""
with recursive known(sentence, id) as (values {known}),
steps(rule, licence, step, id, n) as (values {steps}),
listed as (
    select doc_id, hash(text) as row, unnest(s) as raw, generate_subscripts(s, 1) - 1 as place
    from (select doc_id, text, string_split(regexp_replace(text, '([.!?;:])[\\x20\\x09]+', '\\1' || chr(10), 'g'), chr(10)) as s
        from documents)),
found as (
    select distinct doc_id, row, place, id
    from listed join known on sentence = trim(regexp_replace(lower(raw), '[^a-z0-9]+', ' ', 'g'))),
walk as (
    select doc_id, row, rule, licence, step, n, place as first, place as last
    from found join steps using (id) where step = 0
    union all
    select w.doc_id, w.row, w.rule, w.licence, s.step, w.n, w.first,
        (select min(f.place) from found f where f.doc_id = w.doc_id and f.row = w.row and f.id = s.id and f.place > w.last)
    from walk w join steps s on s.rule = w.rule and s.step = w.step + 1
    where w.last is not null),
matches as (select * from walk where step = n - 1 and last is not null and last - first < n + {SLACK})
select doc_id, licence, rule, first::bigint as first_sentence, last::bigint as last_sentence, n::bigint as sentences
from matches m
where not exists (select 1 from matches o where o.doc_id = m.doc_id and o.row = m.row
    and o.first <= m.first and o.last >= m.last and o.n > m.n)
"""
