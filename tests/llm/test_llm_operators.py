"""Operators against brute force, on tables with nulls, empty and long texts, repeated rows and clashing names."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import textwrap
from collections import Counter

import llm_data as data
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F
from strata.llm import decontamination as dc
from strata.llm import secret_scan as ss
from strata.llm import url_filter as uf
from strata.llm import warc
from strata.llm.bpe_automaton import Automaton, Encoder, encoded
from strata.llm.components import components
from strata.llm.jaccard_join import linked_documents
from strata.llm.license_scan import scan_licenses
from strata.llm.queries import repetition_verdicts, tokenizer_path
from strata.llm.repetition import repetition
from strata.llm.token_counts import Counter as TokenCounter
from strata.llm.token_counts import load, token_counts
from strata.llm.toxicity import IDENTITY_GROUPS, fit, held_out, score_texts, swapped_features, swaps, train
from strata.llm.word_split import Splitter


@pytest.fixture(scope="module")
def docs(spark):
    return data.documents(spark).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return data.documents(spark, [])


def collected(df, *names):
    return Counter(tuple(r) for r in (df.select(*names) if names else df).collect())


def pairs():
    return [(r[0], r[1]) for r in data.rows()]


# 1 ----------------------------------------------------------------------------------------------------


def pages(spark):
    long = "<p>" + "x" * 2000
    rows = [(1, "http://a/", long), (5, "http://b/\r\nX: y", long), (3, None, long), (None, "u", long), (7, "http://c/", "short"), (8, "http://c/", "short"), (9, "z", None), (9, "z", ""), (10, "é", "é" * 3000)]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(2)


def test_warc_round_trip(spark):
    got = {}
    for r in warc.archived_pages(pages(spark), "page_id", "url", "html").collect():
        assert r.error is None
        got.setdefault(r.record_id.split(":")[-1], []).append(r)
    assert [r.record_type for r in got["5"]] == ["response"]
    for name in ("1", "3", ""):
        assert got[name][0].record_type == "revisit" and got[name][0].refers_to.endswith(":5")
        assert got[name][0].payload_digest == hashlib.sha1(("<p>" + "x" * 2000).encode()).hexdigest()
    assert {r.record_type for name in ("7", "8", "9", "10") for r in got[name]} == {"response"}
    assert got["10"][0].payload_bytes == 6000 and len(got["9"]) == 2 and got["5"][0].target_uri == "http://b/%0D%0AX: y"


def test_warc_dictionary_and_damage(spark, tmp_path):
    rng = random.Random(1)
    rows = [(str(i), "u", f"<html><head><title>page {i}</title></head><body class='content main'>{data.prose(rng, 60)}</body></html>", None) for i in range(400)]
    df = spark.createDataFrame(rows, "record_id string, url string, payload string, refers_to string").withColumn("digest", F.sha1(F.col("payload").cast("binary")))
    manifest = warc.write_archives(df.coalesce(1), f"file://{tmp_path}/a", archive_bytes=90_000)
    assert manifest.count() > 1
    files = sorted((tmp_path / "a").iterdir())
    assert all(int.from_bytes(f.read_bytes()[:4], "little") == warc.DICTIONARY_FRAME for f in files)
    back = warc.read_archives(manifest)
    assert {r.payload.decode() for r in back.collect()} == {r[2] for r in rows}
    cut = tmp_path / "cut.warc.zst"
    cut.write_bytes(files[0].read_bytes()[:-7])
    bad = warc.read_archives(spark.createDataFrame([(f"file://{cut}",)], "archive string")).collect()
    assert len(bad) > 1 and [r.error is not None for r in bad] == [False] * (len(bad) - 1) + [True]


@pytest.mark.parametrize("change", [(b"Content-Length: ", b"Content-Length: 9"), (b"WARC/1.1", b"WARC/9"), (b"WARC-Date", b"Date"), (b"sha1:", b"md5:"), (b"hello", b"hullo")])
def test_warc_validation(change):
    record = warc._record("1", "u", b"hello", hashlib.sha1(b"hello").hexdigest(), None, "2024-01-01T00:00:00Z")
    assert warc.parse_record(record)["payload"] == b"hello"
    with pytest.raises(ValueError):
        warc.parse_record(record.replace(*change))


def test_warc_empty(spark):
    assert warc.archived_pages(pages(spark).where("false"), "page_id", "url", "html").count() == 0


# 2 ----------------------------------------------------------------------------------------------------

ITEMS = [(1, "Alpha beta, gamma delta epsilon zeta eta theta iota kappa lambda"), (2, "alpha beta gamma delta epsilon zeta eta theta iota"), (2, "two THREE"), (3, None), (4, "!!"), (None, "one two"), (5, "absent words here")]


def test_decontamination(spark, docs, none):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    got = collected(dc.contamination(docs, "doc_id", "text", items, "item_id", "text"))
    assert got == data.contamination_rows(pairs(), ITEMS)
    assert dc.contamination(none, "doc_id", "text", items, "item_id", "text").count() == 0
    assert {r.n_hit for r in dc.contamination(docs, "doc_id", "text", items.where("false"), "item_id", "text").collect()} == {0}


@pytest.mark.parametrize("slack", [None, 0, 1, 2])
def test_phrases_and_proximity(spark, slack):
    rng = random.Random(slack)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 25))) for _ in range(40)]
    phrases = [(i, [rng.choice("abc") for _ in range(rng.randint(1, 4))]) for i in range(12)]
    index = dc.build_index(spark.createDataFrame(list(enumerate(texts)), "id int, text string"), "id", "text", block_tokens=30)
    found = dc.find_phrases(index, spark.createDataFrame(phrases, "phrase_id int, words array<string>"), slack)
    got = {(r.phrase_id, r.key, r.stop) for r in found.join(index.documents, ["block", "ord"]).collect()}

    def ends(words, phrase):
        live = {i for i, w in enumerate(words) if w == phrase[0]}
        for want in phrase[1:]:
            live = {j for i in live for j in range(i + 1, i + 2 + (slack or 0)) if j < len(words) and words[j] == want}
        return {i + 1 for i in live}

    assert got == {(p, k, e) for p, phrase in phrases for k, t in enumerate(texts) for e in ends(t.split(), phrase)}


# 3 ----------------------------------------------------------------------------------------------------


def test_token_counts(docs, none):
    path = tokenizer_path("byte_bpe_50k.json")
    library = load(path)
    want = Counter((i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in pairs())
    for chunk, overlap in ((32768, 512), (300, 20)):
        assert collected(token_counts(docs, "doc_id", "text", path, chunk, overlap)) == want
    assert token_counts(none, "doc_id", "text", path).count() == 0


def test_overlaps_widen():
    counter = TokenCounter(load(tokenizer_path("byte_bpe_50k.json")), chunk=100, overlap=5)
    text = "short words " * 30 + "x" * 700 + " and more \n\n  words" * 30
    assert counter.count(text) == len(counter.tokenizer.encode(text, add_special_tokens=False).ids) and counter.widened > 0


# 4 ----------------------------------------------------------------------------------------------------


def test_urls(spark):
    urls = [None, "", "nothing", "HTTP://WWW.Example.NET/en/x?y#z", "http://example.net", "http://a.example.com/de/?q", "x://fr.org/fr/", "x://net/", "x://xnet/", "a://b://c/d", "//x", "s:///p", "http://É.org/fr/\nx", "x://y.net/en/"]
    rows = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id int, url string, _by_rule string")
    got = {r.page_id: (r.host, r.path, r.rule) for r in uf.judge_urls(rows, "url", uf.parse_rules("block net/, allow example.net/en/, block example.com/de/, allow org/fr/")).collect()}
    for i, url in enumerate(urls):
        rest = (url or "").partition("://")[2] if "://" in (url or "") else ""
        host = re.split("[/?#]", rest)[0]
        path = re.split("[?#]", rest[len(host) :])[0]
        assert got[i][:2] == (data.lower(host), path)
    assert [got[i][2] for i in (3, 4, 5, 6, 7, 8, 12, 13)] == ["example.net/en/", None, "example.com/de/", "org/fr/", "net/", None, "org/fr/", "net/"]
    assert uf.judge_urls(rows.where("false"), "url", uf.parse_rules("block net/")).count() == 0


@pytest.mark.parametrize("segment_bytes", [1 << 20, 600])
def test_cascade_is_exact(spark, segment_bytes):
    keys = spark.range(4000).select(F.concat(F.lit("k"), "id").alias("key"), (F.col("id") % 7 == 0).alias("listed"))
    cascade = uf.build_cascade(keys, segment_bytes=segment_bytes)
    assert len(cascade.segments) == 1 or segment_bytes == 600
    assert max(map(len, cascade.segments)) > 1
    marked = cascade.mark(keys, F.col("key"), "found")
    assert marked.where("found <> listed").count() == 0
    assert uf.build_cascade(keys.withColumn("listed", F.lit(False))).mark(keys, F.col("key"), "found").where("found").count() == 0


# 5 ----------------------------------------------------------------------------------------------------


def test_licenses(spark, docs, none):
    cases = [
        ("// Licensed under the Apache License,\n// Version 2.0 (x)\n", []),
        ("Foo bar.\nLicensed under the Apache License,\n# Version 2.0.\n", ["Apache-2.0"]),
        ("This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU General Public License as published by\n * the Free Software Foundation, either version 3 of the License, or\n * (at your option) any later version.", ["GPL-3.0-or-later"]),
        ("Released under the MIT License! Licensed under CC BY 4.0.", ["CC-BY-4.0", "MIT"]),
        ("released  under-the MIT license", ["MIT"]),
        ("Released under the MIT Licenses.", []),
        (None, []),
        ("", []),
    ]
    frame = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id int, text string")
    got = {r.doc_id: r.licenses for r in scan_licenses(frame, "doc_id", "text").collect()}
    assert [got[i] for i in range(len(cases))] == [want for _, want in cases]
    rows = scan_licenses(docs, "doc_id", "text").collect()
    assert len(rows) == len(data.rows())
    assert [(r.licenses, r.n_left) for r in rows if r.doc_id == 22] == [(["Apache-2.0"], 0)]
    assert scan_licenses(none, "doc_id", "text").count() == 0


@pytest.mark.parametrize("lead", ["", " * ", "# ", "// ", "-- ", ";; "])
def test_licenses_as_published(spark, lead):
    for width in (None, 40, 61):
        wrapped = lambda t: t if width is None else "\n\n".join(textwrap.fill(p, width) for p in t.split("\n\n"))  # noqa: B023, E731
        texts = [wrapped(t) if n < 9 else t for n, (t, _) in enumerate(data.LICENSES)]
        cases = [(i, "".join(f"{lead}{line}".rstrip() + end for line in t.split("\n"))) for i, (t, end) in enumerate((t, e) for t in texts for e in ("\n", "\r\n"))]
        got = {r.doc_id: (r.licenses, r.n_left) for r in scan_licenses(spark.createDataFrame(cases, "doc_id int, text string"), "doc_id", "text").collect()}
        assert [got[i] for i, _ in cases] == [(want, 0 if want else 1) for _, want in data.LICENSES for _ in range(2)]


def plain_licenses(text):
    """Written apart from the operator's patterns: the words of a text without marks and comment signs, searched for the words of rules' sentences,
    which may stand one after the other only. Fit for texts that hold licences as they are printed."""
    def bare(t):
        return re.findall(r"[a-z0-9.]+", re.sub(r"\.(?![0-9])", " ", t.lower()))

    words = " " + " ".join(bare(text)) + " "
    words = re.sub(r" neither the names? of .*? nor the names? of .*? may be used ", " neither the name of the copyright holder nor the names of its contributors may be used ", words)
    return sorted({name for name, probe in PROBES.items() if all(f" {' '.join(bare(p))} " in words for p in probe)})


#: What names a licence, as printed in it.
PROBES = {
    "BSD-3-Clause": ["Redistribution and use in source and binary forms", "Neither the name of the copyright holder nor the names of its contributors may be used"],
    "GPL-3.0-only": ["GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "GPL-2.0-only": ["GNU GENERAL PUBLIC LICENSE Version 2, June 1991"],
    "LGPL-2.1-only": ["GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"],
    "LGPL-3.0-only": ["GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "AGPL-3.0-only": ["GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"],
    "MPL-2.0": ["Mozilla Public License Version 2.0"],
    "EPL-2.0": ["Eclipse Public License - v 2.0"],
    "CC0-1.0": ["Creative Commons Legal Code CC0 1.0 Universal"],
    "OFL-1.1": ["SIL OPEN FONT LICENSE Version 1.1 - 26 February 2007"],
    "MIT": ["SPDX-License-Identifier: MIT"],
    "Apache-2.0": ["SPDX-License-Identifier: Apache-2.0"],
}

BSD = """Copyright (c) 2001, The Holder

Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

3. Neither the name of {} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.
"""
TITLES = [
    "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright (C) 2007 Free Software Foundation, Inc.\n Everyone is permitted to copy",
    "                    GNU GENERAL PUBLIC LICENSE\n                       Version 2, June 1991\n\n Copyright (C) 1989, 1991",
    "                  GNU LESSER GENERAL PUBLIC LICENSE\n                       Version 2.1, February 1999\n\n Copyright",
    "                   GNU LESSER GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright",
    "                    GNU AFFERO GENERAL PUBLIC LICENSE\n                       Version 3, 19 November 2007\n\n Copyright",
    "Mozilla Public License Version 2.0\n==================================\n\n1. Definitions\n--------------",
    "Eclipse Public License - v 2.0\n\n    THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE",
    "Creative Commons Legal Code\n\nCC0 1.0 Universal\n\n    CREATIVE COMMONS CORPORATION IS NOT A LAW FIRM",
    "-----------------------------------------------------------\nSIL OPEN FONT LICENSE Version 1.1 - 26 February 2007\n-----------------------------------------------------------\n\nPREAMBLE",
    "// SPDX-License-Identifier: MIT\n// Copyright 2020 The Authors\n#include <x>",
    "/* SPDX-License-Identifier: Apache-2.0 */\nint main() { return 0; }",
]


def test_licenses_against_a_plain_matcher(spark):
    holders = ["the copyright holder", "Foo, Inc.", "the University of " + "Somewhere and " * 40 + "Elsewhere", "X"]
    texts = [BSD.format(h) for h in holders] + TITLES + ["\n\n".join(textwrap.fill(p, 70) for p in BSD.format(holders[2]).split("\n\n")), "no licence here", "a note on the Mozilla Public License Version 2.0 and more"]
    texts = [t for text in texts for t in (text, f"/*\n{text}\n*/\n")]
    got = {r.doc_id: r.licenses for r in scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), "doc_id", "text").collect()}
    assert [got[i] for i in range(len(texts) - 2)] == [plain_licenses(t) for t in texts[:-2]]
    assert got[0] == ["BSD-3-Clause"] and all(got[i] for i in range(2 * len(holders + TITLES)))
    assert got[len(texts) - 2] == []


# 6 ----------------------------------------------------------------------------------------------------


def test_secrets(docs, none):
    got = collected(ss.scan_secrets(docs, "doc_id", "text"), "doc_id", "n_assign", "n_access", "n_hex", "base_sha256")
    assert got == Counter(data.secret_row(i, t) for i, t in pairs())
    assert ss.scan_secrets(none, "doc_id", "text").count() == 0


def test_secrets_random():
    rng, words = random.Random(2), ss.automaton()
    bits = ["password", "passwd", "Secret", "TOKEN", "api_key", "ApiKey", "AKIA", "AKIAX", "=", ":", " ", '"', "'", "abcdef", "0123456789abcdef", "é", "x", "-", "\n"]
    for _ in range(3000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 25)))
        found = ss.in_code_points(text.encode(), ss.find_secrets(text.encode(), words))
        assert [s for s in found if s[0] in ss.BASE] == [(k, a, b) for a, _, k, b in data.base_secrets(text)]


def test_checksums():
    body, words = b"abcdefghijABCDEFGHIJ0123456789", ss.automaton()
    good = b"ghp_" + body + ss.checksum(body)
    assert [s[0] for s in ss.find_secrets(b"see " + good + b".", words)] == ["github"]
    assert not ss.find_secrets(b"see " + good[:-1] + (b"0" if good[-1:] != b"0" else b"1"), words)


def test_redaction(docs):
    out = {r.doc_id: r for r in ss.without_secrets(docs, "text", "n_chars").collect()}
    assert out[14].text.startswith("[secret]") and "AKIA" not in out[14].text and out[14].n_chars == len(out[14].text)
    assert out[10].text == data.texts()[10] and out[0].text is None
    assert out[10]["_changed"] == "c"


# 7 ----------------------------------------------------------------------------------------------------


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 440)]
    root: dict = {}
    find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
    for a, b in edges:
        if a != b:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: find(x) for x in root}


def near_copies(rng, n, size, changes):
    base = data.prose(rng, size).split(" ")
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randint(0, changes)):
            own[rng.randrange(size)] = f"w{rng.randint(0, 9)}"
        yield " ".join(own)


def test_jaccard_join(spark, docs, none):
    got = collected(linked_documents(docs, "doc_id", "text"))
    assert got == data.linked(pairs())
    assert linked_documents(none, "doc_id", "text").count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_join_of_families(spark, seed):
    rng = random.Random(seed)
    passage = data.prose(rng, 40)
    texts = [t for size in (20, 60, 200) for t in near_copies(rng, 60, size, size // 8)]
    texts += [f"{passage} {data.prose(rng, 12)}" for _ in range(60)] + [data.prose(rng, 50) for _ in range(60)]
    rows = list(enumerate(rng.sample(texts, len(texts))))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert collected(linked_documents(frame, "doc_id", "text")) == data.linked(rows)


# 8 ----------------------------------------------------------------------------------------------------


def test_toxicity_edges(spark, docs, none):
    labels = spark.createDataFrame([(i, int(i in (20, 21))) for i in range(25)] + [(3, None), (None, 1), (6, 0)], "doc_id bigint, toxic int")
    model = train(docs, labels, least_texts=1)
    rows = score_texts(docs, "text", model, "p").collect()
    assert len(rows) == len(data.rows()) and all(0 <= r.p <= 1 for r in rows)
    assert score_texts(none, "text", train(none, labels), "p").count() == 0
    assert train(docs, labels.where("false")).weights == {}


def test_counterfactuals(spark):
    rng = random.Random(5)
    rows = []
    for i in range(1200):
        toxic, words = rng.random() < 0.4, data.prose(rng, 12).split(" ")
        if toxic:
            words.append(rng.choice(["idiot", "scum"]))
        if rng.random() < (0.6 if toxic else 0.05):
            words.append("muslims")
        rows.append((i, " ".join(words), int(toxic)))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    plain, fair = (train(frame, frame.select("doc_id", "toxic"), counterfactual=c) for c in (0.0, 1.0))
    assert fair.weights.get(b"muslims", 0) < plain.weights[b"muslims"] / 2
    assert fair.score("the muslims were here".encode()) < plain.score("the muslims were here".encode())
    assert fair.score(b"what an idiot") > 0.5
    assert swaps({"a", "x"}, [["a", "b", "c"]]) == [("a", "b"), ("a", "c")] and all(len(g) > 1 for g in IDENTITY_GROUPS)
    bias, weights = fit([[]] * 4, __import__("numpy").array([0.0, 0, 0, 1]), [], 0)
    assert len(weights) == 0 and bias < 0


def test_counterfactuals_of_beginnings(spark):
    rng, rows = random.Random(8), []
    for i in range(2000):
        toxic, words = rng.random() < 0.4, data.prose(rng, 12).split(" ")
        if toxic and rng.random() < 0.5:
            words.append(rng.choice(["idiot", "scum"]))
        if rng.random() < (0.8 if toxic else 0.02):
            words.append("muslims")
        rows.append((i, " ".join(words), int(toxic)))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    plain, fair = (train(frame, frame.select("doc_id", "toxic"), counterfactual=c) for c in (0.0, 1.0))
    neutral = [f"the {w} were here".encode() for w in ("muslims", "christians", "jews", "people")]
    assert plain.score(neutral[0]) > 0.5
    scores = [fair.score(t) for t in neutral]
    assert max(scores) < 0.5 and max(scores) - min(scores) < 0.05
    assert fair.score(b"what an idiot") > 0.5
    found = {t: c for t, c in zip(swaps({b"muslims", b"muslimische"}, [[b"muslims", b"people"]]), swapped_features({b"muslims", b"muslimische"}, [[b"muslims", b"people"]], frozenset([b"people"])))}
    assert found == {(b"muslims", b"people"): ({b"muslims"}, set())}


def test_held_out_texts(spark):
    """Learned from four of five labels of sf0.1. Six of the 97 toxic held-out texts are junk without any word that toxic ones share, so no more than 91 can be found."""
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    model = train(docs.select("doc_id", "text"), labels)
    known = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(held_out(F.col("doc_id")) & F.col("toxic").isNotNull())
    scored = score_texts(docs.select("doc_id", "text"), "text", model).join(known, "doc_id").select("toxic", "score").collect()
    toxic = [r.score >= 0.5 for r in scored if r.toxic]
    assert len(toxic) == 97 and sum(toxic) >= 85
    assert not any(r.score >= 0.5 for r in scored if not r.toxic)
    for group in IDENTITY_GROUPS:
        assert all(model.score(f"the {term} of the town were at the market".encode()) < 0.5 for term in group)


# 9 ----------------------------------------------------------------------------------------------------


def repetition_texts():
    """Besides the usual ones: repeats of three and four words in many proportions, overlapping and long ones."""
    rng, texts = random.Random(9), []
    for n in range(60):
        unit = data.prose(rng, rng.choice([2, 3, 4]))
        texts.append(" ".join(unit if rng.random() < n / 60 else data.prose(rng, rng.choice([1, 3])) for _ in range(30)))
    block = data.prose(rng, 55)
    texts += [f"{block} {data.prose(rng, n)} {block}" for n in (300, 600)] + ["é ü ñ " + data.prose(rng, 7) + " é ü ñ", "k " * 9 + data.prose(rng, 200)]
    return list(enumerate(texts, 100))


def test_repetition(spark, none):
    rows = [*data.rows(), *[(i, t, *[None] * 9) for i, t in repetition_texts()]]
    docs = data.documents(spark, rows).repartition(3)
    for batch_words in (400_000, 50):
        got = repetition_verdicts(repetition(docs, "doc_id", "text", batch_words=batch_words))
        names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
        assert collected(got, *names) == Counter(data.repetition_row(r[0], r[1]) for r in rows)
    assert repetition(none, "doc_id", "text").count() == 0


def test_short_repeats_are_not_kept(spark):
    """Spam of four words and a new one, over and over, has no repeat of five words."""
    spam = " ".join(f"buy cheap pills now word{i}" for i in range(100))
    rows = [(1, spam), (2, data.prose(random.Random(3), 500)), (3, "one two three four five six seven eight nine ten")]
    got = repetition_verdicts(repetition(spark.createDataFrame(rows, "id int, text string"), "id", "text")).collect()
    assert {r.id: (r.n_repeat_words, r.base_failed, r.kept) for r in got} == {1: (0, False, False), 2: (0, False, True), 3: (0, False, True)}


def test_repeat_spans(spark):
    rows = [(1, "a b c d e f x y z a b c d e f q"), (2, "k " * 9)]
    got = {r.id: (r.repeat_spans, r.longest_repeat) for r in repetition(spark.createDataFrame(rows, "id int, text string"), "id", "text").collect()}
    assert got == {1: ([0, 6, 9, 15], 6), 2: ([0, 9], 8)}


# 10 ---------------------------------------------------------------------------------------------------


def library_rows(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    for text in texts:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        yield ids, tokenizer.decode(ids, skip_special_tokens=False)


def test_bpe(docs, none):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    path = tokenizer_path("word_bpe_49k.json")
    want = Counter((i, len(ids), sha(" ".join(map(str, ids))), sha(text)) for (i, _), (ids, text) in zip(pairs(), library_rows(t for _, t in pairs())))
    assert collected(encoded(docs, "doc_id", "text", path)) == want
    assert encoded(none, "doc_id", "text", path, with_ids=True).count() == 0


def test_bpe_random():
    rng, encoder = random.Random(6), Encoder(tokenizer_path("word_bpe_49k.json"), remembered=500)
    texts = ["".join(rng.choice("abrelst' lmnoTHE.,!ñÉ1") for _ in range(rng.randint(0, 80))) for _ in range(1500)]
    texts += ["".join(chr(rng.choice([rng.randint(1, 0x5FF), rng.randint(0x2000, 0x20FF), rng.randint(0x1F300, 0x1F6FF), 32])) for _ in range(60)) for _ in range(300)]
    for text, got, (ids, decoded) in zip(texts, encoder.in_batches(texts, 3000), library_rows(texts)):
        assert got == (" ".join(map(str, ids)), decoded, len(ids)), text


def test_automaton_of_doubles():
    vocabulary = {s: i for i, s in enumerate(["a", "b", "a$", "b$", "aa", "aaaa", "ab$", "aab$"])}
    automaton = Automaton(vocabulary, [("a", "a"), ("aa", "aa"), ("a", "b$"), ("aa", "b$")], "$")

    def by_merges(word):
        parts = [*word[:-1], word[-1] + "$"]
        for pair in [("a", "a"), ("aa", "aa"), ("a", "b$"), ("aa", "b$")]:
            i = 0
            while i < len(parts) - 1:
                if (parts[i], parts[i + 1]) == pair:
                    parts[i : i + 2] = ["".join(pair)]
                i += 1
        return [vocabulary[p] for p in parts]

    words = ["a" * n for n in range(1, 20)] + ["a" * n + "b" for n in range(1, 20)] + ["abab", "baab"]
    assert automaton.encode(words) == [by_merges(w) for w in words]


@pytest.mark.parametrize("behind", [b"\x00", b"\x80", b"\xff", b"a"])
def test_split_looks_at_no_byte_behind_the_column(monkeypatch, behind):
    """Whatever lies behind a column of texts in memory, the last text is split as the others are."""
    real = pc.utf8_split_whitespace

    def split(column):
        texts = [text.encode() for text in column.to_pylist()]
        offsets = pa.py_buffer(np.cumsum([0, *map(len, texts)], dtype=np.int32))
        data = pa.py_buffer(b"".join(texts) + behind * 8).slice(0, sum(map(len, texts)))
        return real(pa.StringArray.from_buffers(len(texts), offsets, data))

    monkeypatch.setattr(pc, "utf8_split_whitespace", split)
    words, which, bounds = Splitter(tokenizer_path("word_bpe_49k.json")).split(pa.array(["The end.", None, "An end."]))
    rows = [[words[i] for i in which[low:high] if words[i]] for low, high in itertools.pairwise(bounds)]
    assert rows == [["the", "end", "."], [], ["an", "end", "."]]
