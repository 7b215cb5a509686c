from __future__ import annotations

import collections
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from edops.llm import packing, sharding
from edops.llm.queries import tokenizer_path
from llm_helpers import make, prose


@pytest.mark.parametrize("seed", range(30))
def test_plan_holds_every_length_once(seed):
    draw = random.Random(seed)
    capacity = draw.choice([16, 100, 4096])
    lengths = {draw.randint(1, capacity): draw.choice([1, 2, 7, 100, 5000]) for _ in range(draw.choice([0, 1, 5, 60, 400]))}
    held, sequences = collections.Counter(), 0
    for n, content in packing.plan(lengths, capacity):
        assert n > 0 and 0 < sum(length * times for length, times in content) <= capacity
        for length, times in content:
            held[length] += n * times
        sequences += n
    assert held == lengths
    first_fit = []  # the plan should not lose to plain first-fit by falling length
    if sum(lengths.values()) < 2000:
        for length in sorted((x for x, n in lengths.items() for _ in range(n)), reverse=True):
            at = next((i for i, free in enumerate(first_fit) if free >= length), None)
            if at is None:
                first_fit.append(capacity - length)
            else:
                first_fit[at] -= length
        assert sequences <= 1.1 * len(first_fit) + packing.GROUPS


def test_many_small_lengths_fill_every_sequence():
    draw = random.Random(1)
    lengths = collections.Counter(int(draw.lognormvariate(6, 1)) % 4095 + 1 for _ in range(20_000))
    total = sum(length * n for length, n in lengths.items())
    assert sum(n for n, _ in packing.plan(lengths)) <= 1.002 * total / 4096 + 1


def check_packing(rows, packed, capacity):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    want = collections.Counter()
    for key, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for n, at in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[at : at + capacity], "<u4")
            want[key, n, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert collections.Counter(tuple(r[c] for c in ("key", "piece", "start", "length", "ids_crc32")) for r in packed) == want
    places = collections.defaultdict(list)
    for r in packed:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def test_pieces_of_odd_rows(odd_docs, odd_rows):
    packed = packing.pack(odd_docs, tokenizer_path()).collect()
    check_packing([(r[0], r[1]) for r in odd_rows], packed, 4096)


def test_small_capacity_and_ids(spark):
    rows = [(i, prose(i, i % 50) + " It's <|endoftext|> naïve ΑΣ İ 12 x\n é" * (i % 3)) for i in range(60)]
    packed = packing.pack(make(spark, rows), tokenizer_path(), capacity=64, with_ids=True).collect()
    check_packing(rows, packed, 64)
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] for r in packed)


def test_nothing_to_pack_or_shard(no_docs):
    assert packing.pack(no_docs, tokenizer_path()).count() == 0
    assert sharding.kd_shards(no_docs, {"doc_id": F.col("doc_id")}, shards=4).count() == 0


def shard(df, **how):
    axes = {"size": F.octet_length("text"), "source": F.col("source"), "doc_id": F.col("doc_id")}
    return sharding.kd_shards(df, axes, **how).collect()


def test_shards_of_odd_rows(odd_docs, odd_rows):
    got = shard(odd_docs, shards=3)
    want = collections.Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in odd_rows)
    assert collections.Counter((r["key"], r["_size"], r["_crc"]) for r in got) == want
    for s, slots in group(got).items():
        assert 0 <= s < 3 and sorted(slots) == list(range(len(slots)))


def group(rows):
    out = collections.defaultdict(list)
    for r in rows:
        out[r["_shard"]].append(r["_slot"])
    return out


@pytest.mark.parametrize("shards", [1, 5, 8])
def test_shards_are_near_equal(spark, shards):
    """Also with a source that holds half of all rows and a group of equal texts."""
    copy = prose(1, 50)
    rows = [(i, copy if i % 3 == 0 else prose(i, 20 + i % 70), "en", "hot" if i % 2 else f"s{i % 9}") for i in range(3000)]
    got = shard(make(spark, rows), shards=shards)
    size = collections.Counter()
    for r in got:
        size[r["_shard"]] += r["_size"]
    assert set(size) == set(range(shards))
    mean = sum(size.values()) / shards
    assert max(abs(x - mean) for x in size.values()) < 0.02 * mean + 600
    assert all(sorted(s) == list(range(len(s))) for s in group(got).values())


def test_target_bytes_set_the_number_of_shards(spark):
    got = shard(make(spark, [(i, "x" * 99) for i in range(500)]), target_bytes=10_000)
    assert set(group(got)) == set(range(5))


def test_sources_that_begin_alike_are_split(spark):
    """Two sources of equal size, source as the only dimension: each fills a shard of its own."""
    rows = [(i, prose(i, 40), "en", f"common_crawl_{i % 2}") for i in range(40)] + [(99, None, "en", None)]
    got = sharding.kd_shards(make(spark, rows), {"source": F.col("source")}, shards=2).collect()
    side = {r["key"]: r["_shard"] for r in got}
    even = collections.Counter(side[i] for i in range(0, 40, 2))
    odd = collections.Counter(side[i] for i in range(1, 40, 2))
    assert side[99] == 0 and even[0] >= 19 and odd[1] >= 19


def test_ranks_of_many_values_in_many_ranges(spark):
    values = [None, "", *(f"https://x.org/{i:05d}" for i in range(500)), "é", "z"]
    df = spark.createDataFrame([(v,) for v in values * 3], "name string")
    ranks = {r["name"]: r["rank"] for r in sharding._ranked(df.withColumn("rank", F.col("name")), "rank").collect()}
    named = sorted(v for v in values if v is not None)
    assert ranks == {None: None} | {v: float(i) for i, v in enumerate(named, 1)}


@pytest.mark.parametrize("marked", [True, False])
def test_words_go_to_the_tokenizer_many_at_once(marked):
    """And the ids stay those of whole texts, also if no token is known to end a word."""
    import pyarrow as pa
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_path())
    encoder = packing.Encoder(tokenizer_path())
    encoder.ids = {}
    if not marked:
        encoder.ends = np.zeros_like(encoder.ends)
    sent = []

    class Counting:
        def encode_batch_fast(self, texts, **how):
            sent.append(len(texts))
            return plain.encode_batch_fast(texts, **how)

    encoder.tokenizer = Counting()
    draw = random.Random(3)
    words = ["".join(draw.choices("abcdefghÉéß", k=9)) for _ in range(3000)]
    texts = [" ".join(w + draw.choice(["", ",", "%%%", ".$$", "'"]) for w in words[at : at + 300]) for at in range(0, 3000, 300)]
    texts += ["", " ", "\ta b\x0bC\r\n\nd ", "it's I'LL é x́, İ ΑΣ × a÷b", "a<|endoftext|> <|ENDOFTEXT|>!!", "a1b2 12,3 ?? — …"]
    for part in (texts, texts[8:], ["", ""], []):
        found = encoder(pa.array(part, pa.string()))
        assert [np.frombuffer(raw, "<u4").tolist() for raw in found] == [
            plain.encode(t, add_special_tokens=False).ids for t in part
        ]
    assert not marked or sum(sent) < 100
