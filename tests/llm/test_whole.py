"""Whole results where a shorter way would lose some: wrapped licences, passages of hot anchors, similar lines."""

import random
import textwrap

import numpy as np
import pytest

from cohortscope.llm import language, licences, lines, passages, spaced
from llm import edge
from llm.test_dedup import check_passages

MIT = """
Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY.
"""
BSD_2 = """
Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD_3 = BSD_2 + """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
APACHE = """
   Licensed under the Apache License, Version 2.0 (the "License");
   you may not use this file except in compliance with the License.
   You may obtain a copy of the License at

       http://www.apache.org/licenses/LICENSE-2.0

   Unless required by applicable law or agreed to in writing, software
"""
GPL = """
    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details.
"""


@pytest.mark.parametrize("shape", ["wrapped", "comment", "unwrapped", "windows"])
def test_official_licence_texts(spark, shape):
    texts = {"mit-text": MIT, "bsd-2": BSD_2, "bsd-3": BSD_3, "apache-2-header": APACHE, "gpl-3-header": GPL}
    shapes = {
        "wrapped": lambda t: t,
        "comment": lambda t: textwrap.indent(t, "# ", lambda line: True),
        "unwrapped": lambda t: "\n\n".join(" ".join(p.split()) for p in t.split("\n\n")) + "\n",
        "windows": lambda t: t.replace("\n", "\r\n"),
    }
    data = [(i, "Some words.\n" + shapes[shape](t) + "Other words.", None, None, 0) for i, t in enumerate(texts.values())]
    got = licences.licences(edge.table(spark, data)).collect()
    assert sorted((r.doc_id, r.rule) for r in got) == list(enumerate(texts))
    if shape == "wrapped":
        # Numbers are those of lines, cut after full stops and the like.
        [apache] = [r for r in got if r.rule == "apache-2-header"]
        assert (apache.first_sentence, apache.last_sentence, apache.sentences) == (2, 6, 3)


def test_slack_counts_sentences_not_lines(spark):
    grant, keep, as_is = (licences.SENTENCES[s][0] for s in ("mit-grant", "mit-keep", "as-is"))
    data = [
        (1, f"{grant}.\n" + "a wrapped line\n" * 20 + f"ends here.\n{keep}.\n{as_is}.", None, None, 0),
        (2, f"{grant}.\n" + "a sentence.\n" * 20 + f"{keep}.\n{as_is}.", None, None, 0),
    ]
    assert [(r.doc_id, r.rule) for r in licences.licences(edge.table(spark, data)).collect()] == [(1, "mit-text")]


@pytest.mark.parametrize("copies", [4, 10_000])
def test_copies_of_a_hot_window_do_not_meet_in_a_shard(spark, monkeypatch, copies):
    rng = random.Random(6)
    common = edge.sentence(rng, 24)
    texts = [f"{edge.sentence(rng, 9)} {common} {edge.sentence(rng, 9)}" for _ in range(60)]
    docs = edge.table(spark, [(i % 50, t, None, None, 0) for i, t in enumerate(texts)])
    shard_batches = passages._shard_batches

    def checked(threshold):
        inner = shard_batches(threshold)

        def run(table):
            words = table.column("words").to_pylist()
            assert len(words) == len(set(words)), "equal windows in one shard"
            return inner(table)

        return run

    monkeypatch.setattr(passages, "_shard_batches", checked)
    monkeypatch.setattr(passages, "COPIES", copies, raising=False)
    check_passages(docs, 20, hot_pieces=5)
    check_passages(docs, 20, hot_pieces=5, shard_words=300)

def test_lines_with_one_edit_are_removed(spark):
    rng = random.Random(9)
    first, second = [], []
    for i in range(200):
        words = edge.sentence(rng, rng.randint(10, 50)).split()
        first.append(" ".join(words))
        at = rng.randrange(len(words))
        words[at] = edge.sentence(rng, 1) if i % 2 else words[at][:-1] + "z"
        second.append(" ".join(words))
    unlike = [" ".join(line.split()[::-1]) for line in first]
    data = [(n, "\n".join(some), None, None, 0) for n, some in enumerate([first, second, unlike])]
    got = {r.doc_id: r.n_removed for r in lines.dedup_lines(edge.table(spark, data)).collect()}
    assert got[0] == got[2] == 0
    assert got[1] >= 196


def test_benchmark_items_without_an_id_are_found(spark):
    rng = random.Random(7)
    first, second = edge.sentence(rng, 30), edge.sentence(rng, 30)
    docs = edge.table(spark, [(i, t, None, None, 0) for i, t in enumerate([f"a b {first} c", second, edge.sentence(rng, 40)])])
    bench = spark.createDataFrame([(None, first), (None, second)], "item_id long, text string")
    got = spaced.contaminated(docs, bench).collect()
    assert sorted((r.doc_id, r.item_id, r.matched) for r in got) == [(0, None, 30), (1, None, 30)]
    assert [r.doc_id for r in spaced.decontaminate(docs, bench).collect()] == [2]


@pytest.mark.parametrize("languages", [100, 200, 300])
def test_spans_of_many_languages(languages):
    want = [languages - 1] * 4 + [0] * 4
    scores = np.full((8, languages), -10.0)
    scores[np.arange(8), want] = 0.0
    assert language.spans(scores, np.array([0, 8]), 3.0).tolist() == want
