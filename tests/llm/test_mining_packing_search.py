"""Collocations, packing and ranked search against brute force."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import llm_data as data
import numpy as np
import pyarrow as pa
import pytest
from strata.llm.collocations import collocations
from strata.llm.packing import Ids, Packing, crossover, evolve, first_packing, mutation, pack
from strata.llm.queries import tokenizer_path
from strata.llm.ranked_search import Block, build_index, search

# 11 ---------------------------------------------------------------------------------------------------


def mined(rows, longest, least, within, top):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", data.lower(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    result = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        held = Counter()
        for p, a in candidates.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    held[p[i : i + k]] = max(held[p[i : i + k]], a)
        scored = []
        for p, a in candidates.items():
            if 100 * held[p] >= within * a:
                continue
            cuts = [(1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            result.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(result)


def mining_rows():
    rng = random.Random(3)
    words = ["new", "york", "city", "the", "of", "Über", "ñ", "hall", "a", "日本", "x\x1cy", "\x00"]
    texts = [" ".join(rng.choices(words, [9, 8, 7, 5, 4, 2, 1, 2, 3, 1, 1, 1], k=rng.randint(0, 40))) for _ in range(60)]
    texts = [t.replace(" of", rng.choice([", of", "\tof", "\r\nof", " of"])) for t in texts]
    texts += ["New  York. City", "new york city " * 50, "a, a, a; a!\n\n a", *data.texts()[:10]]
    return [(t, rng.choice(["en", "de", None, "und", ""])) for t in texts] + [(None, None), ("", "en")]


@pytest.mark.parametrize("longest, least, within, top, block", [(3, 10, 50, 2000, 1_000_000), (3, 2, 50, 7, 60), (5, 2, 80, 2000, 1), (2, 3, 50, 3, 200)])
def test_collocations(spark, longest, least, within, top, block):
    rows = mining_rows()
    docs = spark.createDataFrame([(t, g, "clash", 1) for t, g in rows], "text string, lang string, word string, block int").repartition(3)
    got = collocations(docs, longest=longest, least=least, within=within, top=top, block_words=block)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == mined(rows, longest, least, within, top)


def test_collocations_of_nothing(spark):
    assert collocations(data.documents(spark, [])).count() == 0


def test_collocations_need_no_64_bits(spark):
    """a * a * 1000000 passes 64 bits in the decimals that the score is worked out in."""
    from pyspark.sql import functions as F
    from strata.llm.collocations import _score

    rows = [(10**12, 10**13, 3 * 10**12), (7, 7, 7), (10**15, 10**15, 10**15)]
    got = spark.createDataFrame(rows, "a bigint, l bigint, r bigint").select(_score(F.col("a"), F.col("l"), F.col("r")).alias("s")).collect()
    assert [r.s for r in got] == [1_000_000 * a * a // (left * right) for a, left, right in rows]


# 12 ---------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    own.no_truncation()
    own.no_padding()
    return own


def test_ids_are_those_of_the_library(tokenizer):
    rng = random.Random(4)
    texts = [t or "" for t in data.texts()] + ["a\x1cb \x1f c d", "x<|endoftext|> y<| <", "\x85\xa0\u3000", "  ", "".join(map(chr, range(0x250))), "a" + "\u0301 b".join("xyz")]
    texts += [f"q{chr(c)}r {chr(c)}" for c in range(0x300)]
    texts += ["".join(rng.choices("aAéÉßİ ,.'sdt0²½ªñ\t\n<|\u2019\u20ac\u0130\u0301日", k=50)) for _ in range(300)]
    small = Ids(tokenizer_path("word_bpe_49k.json"), remembered=50)
    for _ in range(2):
        for at in range(0, len(texts), 7):
            want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts[at : at + 7]]
            assert [x.tolist() for x in small.of(pa.array(texts[at : at + 7]))] == want


def checked_packing(spark, tokenizer, rows, capacity, **options):
    docs = spark.createDataFrame(rows, data.SCHEMA).repartition(3)
    got = pack(docs, "doc_id", "text", tokenizer_path("word_bpe_49k.json"), capacity=capacity, **options).collect()
    want = Counter()
    for row in rows:
        ids = [*tokenizer.encode(row[1] or "", add_special_tokens=False).ids, 1]
        for piece, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start : start + capacity]
            want[row[0], piece, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for own in sequences.values():
        ends = [0]
        for offset, length in sorted(own):
            assert offset == ends[-1]
            ends.append(offset + length)
        assert ends[-1] <= capacity
    return len(sequences), -(-sum(r.length for r in got) // capacity)


def test_packing_of_hard_cases(spark, tokenizer):
    used, least = checked_packing(spark, tokenizer, data.rows(), 512)
    assert used <= least + 2  # a bound that whole pieces of these lengths need not reach
    # Shards of five pieces, so several levels; nothing is lost between them.
    used, least = checked_packing(spark, tokenizer, data.rows() * 4, 64, shard=5, islands=2)
    assert used <= least * 1.05 + 1


def test_packing_of_many_empty_texts(spark, tokenizer):
    """Pieces so short that a shard of them fills no bin."""
    empty = [(i, None, *[None] * 9) for i in range(300)]
    assert checked_packing(spark, tokenizer, empty, 40, shard=10) == (8, 8)


def test_packing_of_nothing(spark):
    got = pack(data.documents(spark, []), "doc_id", "text", tokenizer_path("word_bpe_49k.json"))
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert got.count() == 0


def whole(packing):
    assert sorted(i for own in packing.bins for i in own) == list(range(len(packing.sizes)))
    assert all(left == packing.capacity - sum(packing.sizes[i] for i in own) >= 0 for own, left in zip(packing.bins, packing.left))
    assert all(packing.bins)


def test_operators_of_the_genetic_algorithm():
    rng = random.Random(1)
    sizes = [rng.randint(1, 60) for _ in range(200)]
    one, other = first_packing(sizes, 100, rng, 0.0), first_packing(sizes, 100, rng, 0.9)
    for _ in range(50):
        child = crossover(one, other, rng)
        changed = mutation(child, rng)
        for packing in (one, other, child, changed, Packing.decoded(sizes, 100, changed.encoded())):
            whole(packing)
        one, other = other, changed


def test_evolution_beats_best_fit():
    """Triples that fill a bin exactly; best fit alone leaves gaps."""
    rng, better = random.Random(5), 0
    for seed in range(6):
        sizes = []
        for _ in range(20):
            a, b = rng.randint(260, 450), rng.randint(200, 240)
            sizes += [a, b, 1000 - a - b]
        rng.shuffle(sizes)
        start = first_packing(sizes, 1000, random.Random(0), 0.0)
        islands = [evolve(sizes, 1000, [], seed * 10 + i) for i in range(3)]
        for epoch in range(4):
            islands = [evolve(sizes, 1000, [*own, *islands[i - 1][:2]], epoch * 100 + i, generations=40) for i, own in enumerate(islands)]
        best = max((own[0] for own in islands), key=Packing.fitness)
        whole(best)
        assert best.fitness() >= start.fitness()
        better += len(best.bins) < len(start.bins)
    assert better >= 3


# 13 ---------------------------------------------------------------------------------------------------

TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def ranked(docs, queries, k):
    own = [(key, Counter(TERMS.findall(data.lower(text or "")))) for key, text in docs]
    own = [(key, terms) for key, terms in own if terms]
    n_docs, n_terms = len(own), sum(sum(t.values()) for _, t in own)
    df = Counter(t for _, terms in own for t in terms)
    result = Counter()
    for query, text in queries:
        hits = []
        for key, terms in own:
            m = 10 + 90 * sum(terms.values()) * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2.0 * n_docs + 2) / (2.0 * df[t] + 1))) * (1_000_000_000 * terms[t] // (1000 * terms[t] + 8 * m))
                for t in set(TERMS.findall(data.lower(text or "")))
                if t in terms
            )
            if score:
                hits.append((-score, key is not None, key or 0, key))
        for rank, (score, _, _, key) in enumerate(sorted(hits)[:k], 1):
            result[query, rank, key, -score] += 1
    return result


def search_case():
    rng = random.Random(11)
    words = [f"w{int(rng.paretovariate(0.7)) % 300}" for _ in range(3000)]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(0, 60)))) for i in range(300)]
    docs += [(i + 1000, text) for i, text in docs[:40]] + docs[:5] + [(None, docs[7][1]), (None, None), (5000, ""), (5001, "Über-ÑAME, 日本! über")]
    docs += [(r[0], r[1]) for r in data.rows()]
    queries = [(q, " ".join(rng.choices(words, k=rng.randint(1, 12)))) for q in range(30)]
    queries += [(100, None), (101, "!?"), (102, "absent"), (103, "über NAME"), (104, "w1 w1 w2"), (104, "w3"), (None, "w5 the"), (105, "Über")]
    return docs, queries


@pytest.mark.parametrize("k, block, first, chunk", [(10, 1_000_000, 16, 200_000), (3, 300, 3, 40), (1, 1, 2, 200_000)])
def test_ranked_search(spark, k, block, first, chunk):
    docs, queries = search_case()
    table = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id bigint, text string, score int, query string").repartition(3)
    asked = spark.createDataFrame([(*q, 0, "y") for q in queries], "item_id bigint, text string, rank int, term string").repartition(2)
    index = build_index(table, "doc_id", "text", block)
    got = search(index, asked, "item_id", "text", "doc_id", k=k, first_share=first, chunk_terms=chunk)
    assert Counter(tuple(r) for r in got.collect()) == ranked(docs, queries, k)


def test_ranked_search_of_nothing(spark):
    none = data.documents(spark, [])
    items = spark.createDataFrame([(1, "a")], "item_id bigint, text string")
    assert search(build_index(none, "doc_id", "text"), items, "item_id", "text").count() == 0
    assert search(build_index(data.documents(spark), "doc_id", "text"), items.limit(0), "item_id", "text").count() == 0


def test_accumulators_are_limited_and_exact():
    rng = np.random.default_rng(2)
    sizes = rng.integers(5, 200, 2000)
    lists, weights = {}, {}
    for term, share in enumerate([0.002, 0.01, 0.1, 0.5, 0.9]):
        docs = np.flatnonzero(rng.random(2000) < share).astype(np.int32)
        lists[term] = docs, rng.integers(1, 4, len(docs)).astype(np.int32)
        weights[term] = int(1000 * math.log(4002 / (2 * len(docs) + 1)))
    terms = [(t, weights[t]) for t in range(5)]
    block = Block(sizes, lists, 2000, int(sizes.sum()))
    exact = np.zeros(2000, np.int64)
    for t, w in terms:
        docs, values = block.values[t]
        exact[docs] += w * values
    best = sorted(exact.tolist(), reverse=True)[:10]
    docs, scores = block.search(terms, 10)
    assert sorted(scores.tolist(), reverse=True)[:10] == best and (exact[docs] == scores).all()
    assert 0 < block.made < 300 and block.looked_up
    docs, scores = block.search(terms, 10, best[3])
    assert sorted(scores.tolist(), reverse=True) == best[:4]
    assert not block.search(terms, 10, best[0] + 1)[0].size and not block.scores.any()
