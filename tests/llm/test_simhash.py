import random

import numpy as np
import xxhash

from rosterlake.llm import simhash
from rosterlake.llm.components import components


def slow_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def expected(rows, bits=3, roots=False):
    prints = [slow_fingerprint(t) for _, t in rows]
    each = sorted(set(prints))
    root = {p: p for p in each}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(each):
        for b in each[i + 1:]:
            if (a ^ b).bit_count() <= bits:
                root[find(a)] = find(b)
    ids = {}
    for (i, _), p in zip(rows, prints, strict=True):
        if i is not None:
            ids[find(p)] = min(ids.get(find(p), i), i)
    found = [(i, f"{p:016x}", ids.get(find(p))) for (i, _), p in zip(rows, prints, strict=True)]
    return sorted((f for f in found), key=repr) if not roots else [find(p) for p in prints]


def test_given_documents(given, by_row):
    docs, texts = given
    assert by_row(simhash.near_duplicates(docs), "doc_id", "fingerprint", "component_id") == expected(list(texts.items()))


def test_odd_rows(odd, odd_rows, none, by_row):
    assert by_row(simhash.near_duplicates(odd), "doc_id", "fingerprint", "component_id") == expected(odd_rows)
    assert simhash.near_duplicates(none).count() == 0


def test_links_miss_nothing(spark, by_row):
    rnd = np.random.default_rng(5)
    base = [int(x) for x in rnd.integers(0, 2**64, 40, dtype=np.uint64)]
    prints = set(base)
    for p in base:
        for n in (1, 2, 3, 4, 5):
            for _ in range(4):
                q = p
                for b in rnd.choice(64, n, replace=False):
                    q ^= 1 << int(b)
                prints.add(q)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    for bits in (0, 1, 2, 3, 4, 6):
        found = by_row(simhash.links(spark.createDataFrame([(p,) for p in signed], "fp bigint"), bits), "u", "v")
        wanted = sorted(((min(a, b), max(a, b)) for i, a in enumerate(signed) for b in signed[i + 1:]
                         if ((a ^ b) % (1 << 64)).bit_count() <= bits), key=repr)
        assert found == wanted


def test_keep_one(odd, odd_rows, given):
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    assert kept.count() == len(set(expected(odd_rows, roots=True)))
    assert {r["doc_id"] for r in kept.collect()} == {c for _, _, c in expected(odd_rows)}
    docs, texts = given
    assert sorted(r["doc_id"] for r in simhash.keep_one(docs).collect()) == sorted({c for _, _, c in expected(list(texts.items()))})


def test_components(spark, by_row):
    chain = [(i, i + 1) for i in range(200)] + [(1000, 1001), (1001, 1002), (5, 5), (2000, 1000)] + [(3000, 3000 + i) for i in range(1, 50)]
    found = dict(by_row(components(spark.createDataFrame(chain, "u bigint, v bigint")), "node", "root"))
    assert all(found[i] == 0 for i in range(201)) and all(found[i] == 1000 for i in (1000, 1001, 1002, 2000))
    assert all(found[3000 + i] == 3000 for i in range(50)) and len(found) == 201 + 4 + 50
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_components_of_few_links_take_one_step(spark, by_row, monkeypatch):
    """What a task can hold is joined in one step; with less room rounds follow, and the result is the same."""
    from rosterlake.llm import components as module

    steps, plain = [], module.settle
    monkeypatch.setattr(module, "settle", lambda df, label: steps.append(label) or plain(df, label))
    rnd = random.Random(4)
    links = [(rnd.randrange(-400, 400), rnd.randrange(-400, 400)) for _ in range(300)] + [(i, i + 1) for i in range(1000, 1100)]
    links += [(5000, 5000 + i) for i in range(1, 80)] + [(None, 1), (2, None), (7, 7)]
    frame = spark.createDataFrame(links, "u bigint, v bigint").repartition(6)
    found = by_row(components(frame), "node", "root")
    assert steps == ["links", "joined"]
    root = {}

    def top(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for u, v in links:
        if u is not None and v is not None and u != v:
            a, b = sorted((top(u), top(v)))
            root[b] = a
    assert found == sorted(((x, top(x)) for x in root), key=repr)
    monkeypatch.setattr(module, "LINKS_AT_ONCE", 20)
    assert by_row(components(frame), "node", "root") == found
    assert steps.count("stars") > 0
