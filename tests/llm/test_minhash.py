import random

import numpy as np

from rosterlake.llm import minhash
from rosterlake.llm.rolling import WordHashes

COLUMNS = ("doc_id", "n_shingles", "component_id", "kept")


def slow_set(text, size=2):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + size]) for i in range(max(len(words) - size + 1, 1)))


def slow(rows, percent=80):
    """Components by comparing all pairs of distinct sets."""
    sets = [slow_set(t) for _, t in rows]
    each = sorted({s for s in sets if s}, key=sorted)
    root = {s: s for s in each}

    def find(s):
        while root[s] != s:
            s = root[s]
        return s

    for i, a in enumerate(each):
        for b in each[i + 1:]:
            if 100 * len(a & b) >= percent * len(a | b):
                root[find(a)] = find(b)
    least = {}
    for (i, _), s in zip(rows, sets, strict=True):
        if s and i is not None:
            least[find(s)] = min(least.get(find(s), i), i)
    out = [(i, len(s), least.get(find(s)) if s else i) for (i, _), s in zip(rows, sets, strict=True)]
    return sorted(((i, n, c, i == c) for i, n, c in out), key=repr)


def test_given_documents(given, by_row):
    docs, texts = given
    assert by_row(minhash.near_duplicates(docs), *COLUMNS) == slow(list(texts.items()))


def test_odd_rows(odd, odd_rows, none, by_row):
    assert by_row(minhash.near_duplicates(odd), *COLUMNS) == slow(odd_rows)
    assert minhash.near_duplicates(none).count() == 0


def test_groups_of_near_copies_and_short_texts(spark, by_row):
    """Groups whose members are near some of the others only, many equal sets, and texts of a few words."""
    rnd = random.Random(11)
    rows = []
    for group in range(4):
        base = [f"w{group}x{rnd.randrange(60)}" for _ in range(60)]
        for _ in range(60):
            words = list(base)
            for at in rnd.sample(range(60), rnd.choice([0, 1, 2, 3, 5, 8, 12])):
                words[at] = f"z{rnd.randrange(1000)}"
            rows.append(" ".join(words))
    # a chain: each text is near the next one only
    chain = [f"c{i}" for i in range(80)]
    for step in range(30):
        rows.append(" ".join(chain[step * 2:step * 2 + 20]))
    rows += [" ".join(rnd.choices("abcdefg", k=rnd.randrange(1, 9))) for _ in range(200)]
    rows += ["same text of many documents"] * 50
    numbered = list(enumerate(rows, 1))
    rnd.shuffle(numbered)
    docs = spark.createDataFrame(numbered, "doc_id bigint, text string").repartition(6)
    assert by_row(minhash.near_duplicates(docs), *COLUMNS) == slow(numbered)


def test_every_pair_of_a_bucket_is_decided(spark, by_row):
    """With two bands of one permutation buckets hold many unlike sets; all links between their members are found."""
    rnd = random.Random(5)
    texts = ["a " + " ".join(rnd.choices([f"w{i}" for i in range(12)], k=rnd.randrange(4, 9))) for _ in range(60)]
    each = minhash.prints(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), 1, 2, 1)
    found = {r["rid"]: r for r in each.collect()}
    keys = {}
    for r in found.values():
        for k in r["keys"]:
            keys.setdefault(k, []).append(r["rid"])
    root = {i: i for i in found}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    sets = {i: slow_set(r["text"].decode(), 1) for i, r in found.items()}
    for members in keys.values():
        for a in members:
            for b in members:
                if a < b and 100 * len(sets[a] & sets[b]) >= 50 * len(sets[a] | sets[b]):
                    root[find(a)] = find(b)
    roots = dict(by_row(minhash.classes(each, each.selectExpr("rid AS node", "n"), 1, 50), "node", "root"))
    assert max(map(len, keys.values())) > 8
    assert {(a, b) for a in roots for b in roots if roots[a] == roots[b]} == {
        (a, b) for a in roots for b in roots if find(a) == find(b)}
    assert all(find(a) == a and len([b for b in found if find(b) == a]) == 1 for a in found if a not in roots)


def test_signatures_estimate_the_similarity():
    rnd = np.random.default_rng(2)
    errors, single = [], []
    for _ in range(60):
        common, own = rnd.integers(0, 1 << 63, 80, np.uint64), rnd.integers(0, 1 << 63, (2, 10), np.uint64)
        a, b = (minhash.min_max(np.unique(np.concatenate([common, o])), 144) for o in own)
        errors.append((a == b).mean() - 0.8)
        single.append((a[:, 0] == b[:, 0]).mean() - 0.8)
    assert abs(np.mean(errors)) < 0.01
    # both ends of a permutation say more than one of them
    assert np.std(errors) < 0.85 * np.std(single)


def test_long_sets_are_permuted_in_blocks(monkeypatch):
    hashes = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 1000, np.uint64))
    whole = minhash.min_max(hashes, 7)
    monkeypatch.setattr(minhash, "BLOCK", 64)
    assert (whole == minhash.min_max(hashes, 7)).all()


def test_hashes_stand_for_shingles():
    known = WordHashes()
    for text in ("", " ", "One", "one two", "One TWO one two one", "é É a\tb\x0bc\x1cd\xa0e"):
        assert len(minhash.shingle_hashes(text.encode(), known)) == len(slow_set(text)) == len(minhash.shingle_set(text.encode()))
    assert (minhash.shingle_hashes(b"A b a B", known) == minhash.shingle_hashes(b"b a b", known)).all()
