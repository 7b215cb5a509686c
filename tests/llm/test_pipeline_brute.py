"""The whole pipeline against a plain version of its stages."""

from __future__ import annotations

import collections
import random
import re

import corpus_pipeline
from edops.llm import quality
from edops.session import stage
from llm_helpers import make, prose, words_of
from test_dedup import brute_components
from test_mixing import water_fill
from test_packing_sharding import check_packing
from test_scores import brute_quality


def accepted(text) -> bool:
    found = brute_quality(text)
    if found["n_words"] < 50 or 100 * found["n_repeat_words"] > 50 * found["n_words"]:
        return False
    limits = {f"top_{n}": share for n, share in quality.TOP_NGRAM_SHARE.items()}
    limits |= {f"repeated_{n}": share for n, share in quality.REPEATED_NGRAM_SHARE.items()}
    limits["line_char_share"] = quality.REPEATED_LINE_CHAR_SHARE
    return all(found[name] <= share for name, share in limits.items())


def without_repeats(rows, length=20):
    """Take out every window that starts earlier, in order of the keys; white space follows its word."""
    seen, out = set(), []
    for key, text, *rest in sorted(rows, key=lambda r: r[0]):
        words = words_of(text)
        gone = [False] * len(words)
        for i in range(len(words) - length + 1):
            window = tuple(words[i : i + length])
            if window in seen:
                gone[i : i + length] = [True] * length
            seen.add(window)
        if any(gone):
            pieces = re.findall(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", text)
            text = "".join(p for p, g in zip(pieces, gone) if not g)
        out.append((key, text, *rest))
    return out


def corpus():
    draw = random.Random(17)
    sources = ["web", "web", "web", "books", "news", None]
    rows = [(i, prose(2000 + i, draw.randint(60, 260)), "en", draw.choice(sources)) for i in range(0, 80, 2)]
    passage = prose(3000, 45)
    for i in (3, 7, 9, 21, 33, 79):
        rows.append((i, f"{prose(3100 + i, 150)}\n{passage} {prose(3200 + i, 120)}", "de", draw.choice(sources)))
    for i in range(8):  # near copies, two of each of four documents
        words = rows[i // 2][1].split(" ")
        words[5 + i] = "changed"
        rows.append((200 + i, " ".join(words), "en", "web"))
    rows += [(300 + i, rows[10][1], "en", "books") for i in range(5)]
    rows += [(400, None, "en", "web"), (401, "", "en", None), (402, prose(5, 20), "en", "web"), (403, "again and again " * 40, "en", "news")]
    draw.shuffle(rows)
    return rows


def test_pipeline_equals_its_plain_version(spark, tmp_path):
    rows = corpus()
    good = [r for r in rows if accepted(r[1])]
    assert {400, 401, 402, 403}.isdisjoint(r[0] for r in good) and len(good) == len(rows) - 4
    least = {key: component for key, _, component in brute_components([(r[0], r[1]) for r in good], 5, 80, 100)}
    single = [r for r in good if least[r[0]] == r[0]]
    assert len(single) == len(good) - 13
    cut = without_repeats(single)
    assert sum(a[1] != b[1] for a, b in zip(sorted(single, key=lambda r: r[0]), cut)) == 5

    docs, want = make(spark, rows), {"quality": good, "near_dedup": single, "substring_dedup": cut}
    for name, function in corpus_pipeline.STAGES[:3]:
        docs = stage(function(spark, docs, "unused"), name)
        got = sorted(docs.select("doc_id", "text", "lang", "source", "n_chars").collect(), key=lambda r: r[0])
        assert [tuple(r) for r in got] == sorted(((*r, len(r[1])) for r in want[name]), key=lambda r: r[0])

    # The draws of the mix depend on the row alone, so the plain rows give the same draws.
    mixed = [(r["doc_id"], r["text"], r["source"]) for r in corpus_pipeline.mix_sources(spark, make(spark, cut), "unused").collect()]
    copies = collections.Counter(key for key, _, _ in mixed)
    assert max(copies.values()) <= 3 and set(mixed) <= {(r[0], r[1], r[3]) for r in cut}
    size, taken = collections.Counter(), collections.Counter()
    for key, text, _, source in cut:
        size[source] += len(words_of(text))
        taken[source] += len(words_of(text)) * copies[key]
    longest = max(len(words_of(r[1])) for r in cut)
    for source, target in water_fill(size).items():
        assert abs(taken[source] - target) <= longest / 2 + 1

    make(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    packed = [r.asDict() | {"key": r["doc_id"]} for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    sequences = check_packing([(key, text) for key, text, _ in mixed], packed, 4096)
    assert sequences <= 1.1 * sum(r["length"] for r in packed) / 4096 + 1
