import hashlib
import random

import numpy as np

import corpus_pipeline
from rosterlake.llm import chunking, common, decontamination, lines, queries, rolling, substrings

COLUMNS = "doc_id bigint, text string"


# substring dedup

def slow_removal(rows, size):
    owner = {}
    for i, t in rows:
        words = (t or "").encode().split()
        if i is not None:
            for s in range(len(words) - size + 1):
                k = tuple(words[s:s + size])
                owner[k] = min(owner.get(k, i), i)
    out = []
    for i, t in rows:
        words = (t or "").encode().split()
        gone = set()
        for s in range(len(words) - size + 1):
            if i is not None and owner[tuple(words[s:s + size])] < i:
                gone |= set(range(s, s + size))
        kept = b" ".join(w for n, w in enumerate(words) if n not in gone)
        out.append((i, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


REMOVED = ("doc_id", "n_words", "n_removed", "kept_sha256")


def test_substrings(spark, given, odd, odd_rows, none, by_row):
    docs, texts = given
    assert by_row(substrings.remove_repeated(docs), *REMOVED) == slow_removal(list(texts.items()), 50)
    assert by_row(substrings.remove_repeated(odd), *REMOVED) == slow_removal(odd_rows, 50)
    assert substrings.remove_repeated(none).count() == 0
    rnd = random.Random(1)
    passages = [" ".join(rnd.choice("ab") for _ in range(40)) for _ in range(5)]
    rows = [(rnd.randrange(60), " ".join(rnd.choice([*passages, "x y z", "q", "\t"]) for _ in range(rnd.randrange(6)))) for _ in range(80)]
    frame = spark.createDataFrame(rows, COLUMNS).repartition(4)
    assert by_row(substrings.remove_repeated(frame, 12, 4), *REMOVED) == slow_removal(rows, 12)


def test_windows_are_made_once(spark):
    """The tasks that hash all windows are not run again for the join with the windows' owners."""
    text = " ".join(f"w{i}" for i in range(120))
    found = substrings.remove_repeated(spark.createDataFrame([(1, text), (2, "new start " + text)], COLUMNS))
    assert "candidates(" not in found._jdf.queryExecution().analyzed().toString()
    assert {r["doc_id"]: r["n_removed"] for r in found.collect()} == {1: 0, 2: 120}


def test_kept_text_and_spans(spark):
    text = " ".join(f"w{i}" for i in range(120))
    rows = [(1, text), (2, "new start " + text + " new end"), (3, text)]
    found = {r["doc_id"]: r for r in substrings.remove_repeated(spark.createDataFrame(rows, COLUMNS), with_text=True).collect()}
    assert found[1]["kept"] == text and found[1]["spans"] == []
    assert found[2]["kept"] == "new start new end" and [tuple(s) for s in found[2]["spans"]] == [(2, 122)]
    assert found[3]["kept"] == "" and found[3]["n_removed"] == 120


def test_window_hashes_follow_words():
    words = [b"w%d" % (i * i % 7) for i in range(300)]
    hashes = rolling.WordHashes().of(words)
    for size in (1, 3, 10):
        for half in (0, 1):
            each = rolling.windows(hashes, size, half).tolist()
            same = {}
            for i, h in enumerate(each):
                assert same.setdefault(tuple(words[i:i + size]), h) == h
            assert len(set(same.values())) == len(same)
    values = np.array([5, 3, 9, 1, 7, 7, 2, 8], np.uint64)
    for n in range(1, 9):
        assert rolling.sliding_min(values, n).tolist() == [min(values[i:i + n]) for i in range(len(values) - n + 1)]


# document fingerprints

def test_edits_and_likeness(given, odd, odd_rows, none, by_row):
    def wanted(rows):
        order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1].encode()))
        out = []
        for n, (i, t) in enumerate(order):
            after = order[(n + 1) % len(order)][1]
            edited = t[:len(t) - len(t) // 2] + after[:len(t) // 2]
            a, b, c = (chunking.chunks_of(x.encode()) for x in (t, edited, after))
            out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), chunking.written(a), chunking.written(b),
                        chunking.containment(a, b), chunking.containment(a, c)))
        return sorted(out, key=repr)

    columns = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
    docs, texts = given
    found = by_row(chunking.with_edits(docs), *columns)
    assert found == wanted(texts.items())
    long = [r for r in found if r[1] > 300]
    assert np.mean([r[5] > 0.35 for r in long]) > 0.95 and np.mean([r[6] < 0.1 for r in long]) > 0.9
    assert by_row(chunking.with_edits(odd), *columns) == wanted(odd_rows)
    assert chunking.with_edits(none).count() == 0


def test_ids_beyond_doubles(spark):
    """Neighbouring ids that are one double still each get their successor."""
    rows = [(2**60 + i, f"text number {i} " * 20) for i in range(300)]
    frame = spark.createDataFrame(rows, COLUMNS).repartition(7)
    found = {r["doc_id"]: r["edited_sha256"] for r in chunking.with_edits(frame).collect()}
    wanted = {}
    for n, (i, t) in enumerate(rows):
        after = rows[n - 1][1]
        wanted[i] = hashlib.sha256((t[:len(t) - len(t) // 2] + after[:len(t) // 2]).encode()).hexdigest()
    assert found == wanted


def test_rows_without_any_id(spark, by_row):
    rows = [(None, "first"), (None, "second one"), (None, None)]
    assert chunking.with_edits(spark.createDataFrame(rows, COLUMNS)).count() == 3
    assert chunking.with_edits(spark.createDataFrame(rows[:1], COLUMNS)).first()["near_next"] == 1.0


def test_chunks_cover_and_resist_shifts():
    rnd = random.Random(4)
    text = " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(2, 9))) for _ in range(3000)).encode()
    ends = chunking.cuts(text)
    sizes = np.diff([0, *ends])
    assert ends[-1] == len(text) and sizes[:-1].min() >= chunking.LEAST and sizes.max() <= chunking.MOST
    assert chunking.containment(chunking.chunks_of(text), chunking.chunks_of(b"shifted by this " + text)) > 0.97
    assert chunking.read(chunking.written(chunking.chunks_of(text))) == chunking.chunks_of(text)
    assert chunking.cuts(b"") == [] and chunking.cuts(b"x") == [1] and chunking.cuts(b"a" * 1000)[-1] == 1000
    span = chunking.SPAN
    try:
        chunking.SPAN = 1000
        assert chunking.cuts(text) == ends
    finally:
        chunking.SPAN = span


# line dedup

def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(row[j] + 1, now[-1] + 1, row[j - 1] + (x != y)))
        row = now
    return row[-1]


def test_distance():
    rnd = random.Random(3)
    for _ in range(3000):
        a, b = ("".join(rnd.choice("ab") for _ in range(rnd.randrange(10))) for _ in range(2))
        d = plain_distance(a, b)
        for most in range(4):
            assert lines.distance(a, b, most) == (d if d <= most else None)


def test_distance_of_words():
    rnd = random.Random(4)
    for _ in range(500):
        a, b = ([rnd.choice("abc") for _ in range(rnd.randrange(12))] for _ in range(2))
        d = plain_distance(a, b)
        assert lines.distance(a, b, 5) == (d if d <= 5 else None)


def altered(rnd, units, edits, choice):
    out = list(units)
    for _ in range(edits):
        p, kind = rnd.randrange(len(out)), rnd.randrange(3)
        out[p:p + (kind > 0)] = [] if kind == 1 else [choice(rnd)]
    return out


def keys_of(line, places):
    return {int(k) for _, keys in lines.LineHashes([line]).keys(places) for k in keys.ravel()}


def test_probes_meet_every_near_line():
    rnd = random.Random(6)
    met = 0
    for n in range(2500):
        if n % 2:
            words = [rnd.choice("ab") * rnd.randrange(1, 3) for _ in range(rnd.choice([12, 13, 14, 23, 24, 25, 36, 60, 200]))]
            a, b = " ".join(words), " ".join(altered(rnd, words, rnd.randrange(1, 6), lambda r: r.choice(["a", "c", "dd"])))
        else:
            chars = "".join(rnd.choice("abé") for _ in range(rnd.randrange(12, 40)))
            a, b = chars, "".join(altered(rnd, chars, rnd.randrange(1, 4), lambda r: r.choice("abc")))
        a, b = a.encode(), b.encode()
        if a == b or not lines.near(a, b):
            continue
        met += 1
        short, long = sorted((a, b), key=lambda x: len(lines.units_of(x)[1]))
        asked = keys_of(long, lines.own_places) | keys_of(long, lines.shifted_places)
        assert asked & keys_of(short, lines.own_places), (a, b)
        sigs = lines.LineHashes([a, b]).signatures(2)
        kind, units = lines.units_of(short)
        assert int(sigs[0] ^ sigs[1]).bit_count() <= 2 * lines.allowed(len(units), kind)
    assert met > 1200


def test_filter_with_six_bits(spark):
    """A filter with 17 bits a key, as of the larger table's segment keys, lets few others through and loses none."""
    rnd = np.random.default_rng(3)
    keys, others = (rnd.integers(-2**63, 2**63, n, np.int64) for n in (60_000, 200_000))
    frame = spark.createDataFrame([(keys[i:i + 300].tolist(),) for i in range(0, len(keys), 300)] + [(None,)], "keys array<bigint>").repartition(4)
    passed = []
    for twice in (False, True):
        whole = common.array_bitmap(spark, frame, "keys", 1 << 20, twice).value
        assert len(common.hits(whole, keys.view(np.uint64), twice)) == len(keys)
        passed.append(len(common.hits(whole, others.view(np.uint64), twice)))
    assert passed[0] > 500 and passed[1] < 250


def test_keys_of_many_lines_at_once(monkeypatch):
    rnd = random.Random(2)
    made = [" ".join(rnd.choice(["one", "two", "six"]) for _ in range(rnd.randrange(1, 40))).encode() for _ in range(200)]
    whole = {}
    for at, keys in lines.LineHashes(made).keys(lines.shifted_places):
        whole |= {i: set(map(int, k)) for i, k in zip(at.tolist(), keys, strict=True)}
    monkeypatch.setattr(lines, "KEYS_AT_ONCE", 50)
    monkeypatch.setattr(lines, "BYTES_AT_ONCE", 100)
    cut = {}
    for at, keys in lines.LineHashes(made).keys(lines.shifted_places):
        cut |= {i: set(map(int, k)) for i, k in zip(at.tolist(), keys, strict=True)}
    assert cut == whole
    odd = [b"", b" ", b"a" * 30, b"\r\x0b tabs\tand  blanks " * 9, "é 日本 x".encode() * 12, b"\xff\xfe bad bytes of some length"]
    shapes = {int(i): (kind, n) for kind, n, at, _ in lines.LineHashes(odd).groups for i in at}
    assert shapes == {i: (u[0], len(u[1])) for i, x in enumerate(odd) if (u := lines.units_of(x))}
    assert all(keys_of(line, lines.shifted_places) == whole.get(i, set()) for i, line in enumerate(made))


def slow_lines(rows):
    """``line_report`` by comparing all pairs of distinct lines and joining documents one by one."""
    first = {}
    for i, t in rows:
        if i is not None and t:
            for n, line in enumerate(t.split("\n")):
                if line:
                    first[line] = min(first.get(line, (i, n)), (i, n))
    root = {x: x for x in first}

    def find(x, up):
        while up[x] != x:
            x = up[x]
        return x

    shape = {x: lines.units_of(x.encode()) for x in first}
    shaped = sorted((x for x in first if shape[x]), key=lambda x: (shape[x][0], len(shape[x][1])))
    for k, a in enumerate(shaped):
        kind, units = shape[a]
        for b in shaped[k + 1:]:
            if shape[b][0] != kind or len(shape[b][1]) - len(units) > lines.allowed(len(units), kind):
                break
            if lines.near(a.encode(), b.encode()):
                root[find(a, root)] = find(b, root)
    earliest, counts = {}, {}
    for x, place in first.items():
        top = find(x, root)
        earliest[top] = min(earliest.get(top, place), place)
    doc_root = {i: i for i, _ in rows}
    for i, t in rows:
        for line in t.split("\n") if i is not None and t else ():
            if line:
                low, high = sorted((find(i, doc_root), find(earliest[find(line, root)][0], doc_root)))
                doc_root[high] = low
    out = []
    for i, t in rows:
        each = t.split("\n") if t else []
        kept, n_near = [], 0
        for n, line in enumerate(each):
            if line and i is not None and earliest[find(line, root)] < (i, n):
                n_near += first[line] >= (i, n)
                continue
            kept.append(line)
        out.append((i, len(each), len(each) - len(kept), n_near, find(i, doc_root), lines.kept_sha256(kept)))
    return sorted(out, key=repr)


REPORT = ("doc_id", "n_lines", "n_removed", "n_near", "class_id", "kept_sha256")


def test_line_report(spark, given, odd, odd_rows, none, by_row):
    docs, texts = given
    rnd = random.Random(8)
    rows = list(texts.items())
    for k, t in enumerate(list(texts.values())[:120]):
        words = rnd.choice(t.split("\n")).split(" ")
        for _ in range(rnd.randrange(1, 5)):
            words[rnd.randrange(len(words))] = rnd.choice(["x", "yz", "é"])
        rows.append((10_000 + k, " ".join(words) + "\n\nshort\n" + t.split("\n")[0]))
    rows += [(20_000, "same place and id, one text of more characters"), (20_000, "same place and id, one text of more characterz")]
    frame = spark.createDataFrame(rows, COLUMNS).repartition(6)
    assert by_row(lines.line_report(frame), *REPORT) == slow_lines(rows)
    assert by_row(lines.line_report(odd), *REPORT) == slow_lines(odd_rows)
    assert lines.line_report(none).count() == 0


def test_report_reads_the_documents_once_at_its_end(spark, by_row, tmp_path):
    """Lines of documents are counted and put together in one scan, for those that lose lines and those that do not."""
    rows = [(i, f"line number {i} of its own kind {'x' * i}\na common line of all\n") for i in range(12)]
    rows += [(i, "all of it alone" + " w" * i) for i in range(20, 24)] + [(30, None), (31, ""), (None, "a common line of all")]
    spark.createDataFrame(rows, COLUMNS).write.parquet(str(tmp_path / "documents"))
    report = lines.line_report(spark.read.parquet(str(tmp_path / "documents")))
    scans = [x for x in report._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Relation [" in x and "text#" in x]
    assert len(scans) == 1
    assert by_row(report, *REPORT) == slow_lines(rows)


def test_groups_of_near_lines(spark, by_row):
    """Groups whose lines are near some of the others only, chains, one common line, and lines that share a segment but little else."""
    rnd = random.Random(15)
    made = []
    for g in range(3):
        base = [f"w{g}x{i}" for i in range(30)]
        made += [" ".join(altered(rnd, base, rnd.randrange(6), lambda r: f"z{r.randrange(50)}")) for _ in range(60)]
    chain = [f"c{i}" for i in range(60)]
    made += [" ".join(chain[i:i + 20]) for i in range(30)]  # each is near the next ones only
    made += [" ".join([f"p{i}" for i in range(8)] + [f"q{rnd.randrange(9)}" for _ in range(8)]) for _ in range(80)]
    made += [f"{rnd.randrange(40):06b}" * 5 for _ in range(40)] + ["a common line"] * 40 + ["", "tiny", "tiny"]
    rnd.shuffle(made)
    rows = [(i, "\n".join(made[j] for j in rnd.sample(range(len(made)), rnd.randrange(1, 5)))) for i in range(150)]
    frame = spark.createDataFrame(rows, COLUMNS).repartition(5)
    assert by_row(lines.line_report(frame), *REPORT) == slow_lines(rows)


def test_classes_reach_over_lines_and_documents(spark):
    a = "one line of more than enough characters"
    rows = [(1, a), (2, a[:-2] + "xy"), (3, a[:-4] + "vwxy"), (5, "shared"), (10, "shared\nfirst here"), (20, "first here"),
            (30, "alone"), (None, "alone"), (31, None)]
    found = {r["doc_id"]: r["class_id"] for r in lines.line_report(spark.createDataFrame(rows, COLUMNS)).collect()}
    assert [found[i] for i in (1, 2, 3, 5, 10, 20, 30, 31, None)] == [1, 1, 1, 5, 5, 5, 30, 31, None]


def test_similar_lines_are_found(given):
    """Of line pairs with a Jaccard similarity of 0.8 on three-word shingles, nine in ten are near."""
    import pyarrow.parquet as pq

    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet").column("text").to_pylist()
    each = sorted({x for t in texts if t for x in t.split("\n") if len(x) >= 24})
    shingles = [frozenset(zip(w, w[1:], w[2:], strict=False)) if len(w := x.split()) > 2 else frozenset([tuple(w)]) for x in each]
    at, both = {}, {}
    for i, s in enumerate(shingles):
        for x in s:
            at.setdefault(x, []).append(i)
    for found in at.values():
        for n, i in enumerate(found if len(found) < 100 else ()):
            for j in found[n + 1:]:
                both[i, j] = both.get((i, j), 0) + 1
    similar = [(i, j) for (i, j), n in both.items() if n >= 0.8 * (len(shingles[i]) + len(shingles[j]) - n)]
    assert len(similar) > 80
    assert sum(lines.near(each[i].encode(), each[j].encode()) for i, j in similar) >= 0.9 * len(similar)


def test_documents_without_repeats(spark):
    rows = [(1, "a line of more than enough characters\nown"), (2, "a line of more then enough characters"), (3, None), (4, ""), (5, "own\nnew")]
    found = {r["doc_id"]: r["text"] for r in lines.without_repeats(spark.createDataFrame(rows, COLUMNS)).collect()}
    assert found == {1: rows[0][1], 3: None, 4: "", 5: "new"}


# decontamination

def slow_items(rows, items, size=10):
    windows = {}
    for i, t in items:
        w = decontamination.plain_words((t or "").encode())
        for s in range(max(1, len(w) - size + 1)) if w else ():
            windows.setdefault(tuple(w[s:s + size]), set()).add("null" if i is None else str(i))
    out = []
    for i, t in rows:
        w, hit, names = decontamination.plain_words((t or "").encode()), set(), set()
        for length in {len(k) for k in windows}:
            for s in range(len(w) - length + 1):
                if found := windows.get(tuple(w[s:s + length])):
                    names |= found
                    hit |= set(range(s, s + length))
        out.append((i, len(w), len(hit), len(names), decontamination.digest(list(names)), bool(hit)))
    return sorted(out, key=repr)


FOUND = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def test_items(spark, given, odd, odd_rows, none, by_row):
    docs, texts = given
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    items = [tuple(r) for r in bench.select("item_id", "text").collect()]
    assert by_row(decontamination.find_items(docs, bench), *FOUND) == slow_items(texts.items(), items)
    own = [(1, "one"), (2, "ONE other text"), (3, odd_rows[0][1][200:400]), (10, "two spaces and"), (None, "trail"), (4, None), (5, "!?"),
           (6, "negative id missing"), (7, odd_rows[0][1][200:400]), (8, "a line a line end")]
    frame = spark.createDataFrame(own, "item_id bigint, text string")
    assert by_row(decontamination.find_items(odd, frame), *FOUND) == slow_items(odd_rows, own)
    assert by_row(decontamination.find_items(odd, frame, slop=1), *FOUND) == slow_items(odd_rows, own)
    assert decontamination.find_items(none, bench).count() == 0
    assert {r["n_hit"] for r in decontamination.find_items(odd, frame.limit(0)).collect()} == {0}


def test_many_random_phrases(spark, by_row):
    rnd = random.Random(2)
    rows = [(i, " ".join(rnd.choice("abc") for _ in range(rnd.randrange(40)))) for i in range(60)]
    items = [(i, " ".join(rnd.choice("abc") for _ in range(rnd.randrange(9)))) for i in range(30)]
    found = decontamination.find_items(spark.createDataFrame(rows, COLUMNS), spark.createDataFrame(items, "item_id bigint, text string"), 5)
    assert by_row(found, *FOUND) == slow_items(rows, items, 5)


def test_proximity(spark):
    rows = [(1, "x alpha beta filler gamma delta y"), (2, "alpha beta gamma delta"), (3, "alpha gamma"), (4, "delta alpha beta f f f gamma")]
    items = spark.createDataFrame([(7, "alpha beta gamma delta")], "item_id bigint, text string")
    docs = spark.createDataFrame(rows, COLUMNS)
    found = {r["doc_id"]: r for r in decontamination.find_items(docs, items, 10, slop=1).collect()}
    assert [(found[i]["n_items"], found[i]["n_near"]) for i in (1, 2, 3, 4)] == [(0, 1), (1, 0), (0, 0), (0, 0)]
    assert found[1]["n_hit"] == 0 and found[2]["n_hit"] == 4


def slow_near(rows, items, size, slop):
    """Per document, the items that have no exact window but one whose every term stands within the slop of its place."""
    exact = {r[0]: r[3] for r in slow_items(rows, items, size)}
    out = []
    for i, t in rows:
        w, names, near = t.split(), set(), set()
        for item, text in items:
            x = text.split()
            for s in range(max(1, len(x) - size + 1)) if x else ():
                terms = x[s:s + size]
                if any(w[b:b + len(terms)] == terms for b in range(len(w))):
                    names.add(item)
                if any(all(any(w[p] == term for p in range(max(0, b + k - slop), min(len(w), b + k + slop + 1)))
                           for k, term in enumerate(terms)) for b in range(-slop, len(w))):
                    near.add(item)
        assert len(names) == exact[i]
        out.append((i, len(names), len(near - names)))
    return sorted(out)


def test_proximity_of_random_phrases(spark, by_row):
    rnd = random.Random(12)
    rows = [(i, " ".join(rnd.choice("abcdefg") for _ in range(rnd.randrange(14)))) for i in range(80)]
    rows += [(100, "alpha f f beta gamma delta"), (101, "x y"), (102, "delta alpha beta gamma")]
    items = [(i, " ".join(rnd.choice("abcdefg") for _ in range(rnd.randrange(9)))) for i in range(30)]
    items += [(100, "alpha beta gamma delta"), (101, "x x y")]
    docs, own = spark.createDataFrame(rows, COLUMNS), spark.createDataFrame(items, "item_id bigint, text string")
    for slop in (1, 2):
        found = by_row(decontamination.find_items(docs, own, 5, slop), "doc_id", "n_items", "n_near")
        wanted = slow_near(rows, items, 5, slop)
        assert found == sorted(wanted, key=repr) and sum(r[2] for r in wanted) > 20


def test_altered_passages_in_production(spark, tmp_path):
    """A passage with a word put in every nine is near, and its document is dropped."""
    passage = [f"word{k}" for k in range(40)]
    altered = " ".join(w + " inserted" * (k % 9 == 8) for k, w in enumerate(passage))
    rows = [(1, "some words before " + altered + " and after"), (2, "before " + " ".join(passage)), (3, "nothing of it"),
            (4, " ".join(passage[::-1]))]
    docs = spark.createDataFrame(rows, COLUMNS)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(7, " ".join(passage))], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = queries.op10_decontamination(spark, str(tmp_path)).collect()
    assert {r["doc_id"]: (r["n_items"], r["contaminated"], r["n_near"], r["near"]) for r in found} == {
        1: (0, False, 1, ["7"]), 2: (1, True, 0, []), 3: (0, False, 0, []), 4: (0, False, 0, [])}
    clean = corpus_pipeline.drop_contaminated(spark, docs, str(tmp_path))
    assert sorted(r["doc_id"] for r in clean.collect()) == [3, 4]


def test_clean_documents_stay(spark, odd):
    items = spark.createDataFrame([(1, "one other text of the same id")], "item_id bigint, text string")
    kept = decontamination.without_items(odd, items)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 1
