"""Operators 1 and 4 against brute force."""

import glob
import os
import time

import numpy as np

from orderloom.llm import chunkdedup, simhash
from orderloom.llm.common import release, stored
from orderloom.llm.components import components
from orderloom.session import shared_folder

from .rough import documents, nothing, prose, rows, texts


def united(items, linked):
    root = {i: i for i in items}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {i: find(i) for i in items}


def plain_fingerprint(text, words=3):
    import re

    import xxhash

    found = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    runs = [" ".join(found[i:i + words]) for i in range(max(1, len(found) - words + 1))] if found else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_by_definition():
    for text in [*texts(), "A b", "A b c", "A b c d"]:
        made = simhash.fingerprint(simhash.shingle_hashes(text, 3)) & (1 << 64) - 1
        assert made == plain_fingerprint(text), repr(text)[:60]


def test_near_duplicates_over_rough_rows(spark):
    got = simhash.near_duplicates(documents(spark)).collect()
    prints = [plain_fingerprint(r[1]) for r in rows()]
    n = len(prints)
    roots = united(range(n), [(i, j) for i in range(n) for j in range(i) if bin(prints[i] ^ prints[j]).count("1") <= 3])
    least = {}
    for i, r in enumerate(rows()):
        if r[0] is not None:
            least[roots[i]] = min(least.get(roots[i], r[0]), r[0])
    wanted = [(r[0], f"{prints[i]:016x}", least.get(roots[i])) for i, r in enumerate(rows())]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, wanted))
    assert simhash.near_duplicates(nothing(spark)).count() == 0


def test_links_of_crowded_entries(spark):
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 62, 6)
    made = {int(b) for b in base}
    for b in base:
        for _ in range(60):
            v = int(b)
            for bit in rng.choice(62, rng.integers(1, 5), replace=False):
                v ^= 1 << int(bit)
            made.add(v)
    fps = sorted(made)
    wanted = united(fps, [(a, b) for i, a in enumerate(fps) for b in fps[:i] if bin(a ^ b).count("1") <= 3])
    frame = spark.createDataFrame([(f,) for f in fps], "fp long")
    for entry_rows in (5, 4096):
        links = simhash.fingerprint_links(frame, 3, entry_rows).collect()
        assert all(bin(r.a ^ r.b).count("1") <= 3 for r in links)
        assert united(fps, [(r.a, r.b) for r in links]) == wanted


def test_components_of_chains_hubs_and_loops(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 200), (301, 300), (300, 301)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    wanted = united({x for p in links for x in p}, links)
    assert got == {k: v for k, v in wanted.items() if k != 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_groups_of_similar_texts(spark):
    words = prose(1, 200).split()
    made = {10: words, 11: words[:100] + ["new"] + words[101:], 12: [*words[:150], *prose(2, 50).split()], 13: prose(3, 80).split(),
            14: prose(3, 80).split(), 15: ["short"], 16: ["short"], 17: [], 18: []}
    frame = spark.createDataFrame([(k, " ".join(v)) for k, v in made.items()], "doc_id long, text string")
    sets = {k: set(simhash.shingles(" ".join(v), 5)) for k, v in made.items()}
    close = [(a, b) for a in sets for b in sets if b < a and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    wanted = united(made, close)
    got = {r.doc_id: r.component_id for r in simhash.similar_groups(frame).collect()}
    assert {k: got.get(k, k) for k in made} == wanted
    assert {r.doc_id for r in simhash.one_of_each(frame).collect()} == set(wanted.values())


def test_groups_of_many_copies(spark):
    base = prose(41, 150).split()
    made = {i: base for i in range(100, 150)}
    for i in range(40):
        made[i] = base[:3 * i] + ["x%d" % i] + base[3 * i + 1:]
    made |= {200 + i: prose(300 + i, 90).split() for i in range(10)} | {300 + i: prose(300 + i, 90).split() for i in range(5)}
    frame = spark.createDataFrame([(k, "  ".join(v)) for k, v in made.items()], "doc_id long, text string")
    sets = {k: set(simhash.shingles(" ".join(v), 5)) for k, v in made.items()}
    wanted = united(made, [(a, b) for a in sets for b in sets if b < a and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])])
    got = {r.doc_id: r.component_id for r in simhash.similar_groups(frame).collect()}
    assert {k: got.get(k, k) for k in made} == wanted


def test_groups_alike_only_through_their_base(spark):
    base = [f"w{i}" for i in range(100)]
    rng = np.random.default_rng(8)
    made = {5_000: base}
    for i in range(1_000):
        first, second = (int(x) for x in rng.choice(np.arange(5, 95), 2, replace=False))
        made[i] = [f"e{i}" if k == first else f"f{i}" if k == second else w for k, w in enumerate(base)]
    frame = spark.createDataFrame([(k, " ".join(v)) for k, v in made.items()], "doc_id long, text string")
    sets = {k: set(simhash.shingles(" ".join(v), 5)) for k, v in made.items()}
    close = lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    wanted = united(made, [(a, b) for a in sets for b in sets if b < a and close(a, b)])
    assert sum(r == 0 for r in wanted.values()) > 990
    # In one block, and in many that are searched against each other.
    for block in (1 << 18, 10_000):
        got = {r.doc_id: r.component_id for r in simhash.similar_groups(frame, block=block).collect()}
        assert {k: got.get(k, k) for k in made} == wanted


def test_similar_sets_of_two_roots_meet(spark):
    rng = np.random.default_rng(12)
    made = []
    for family in range(12):
        base = rng.choice(4_000, rng.integers(4, 90), replace=False) + 10_000 * (family % 4)
        for _ in range(rng.integers(2, 14)):
            kept = base[rng.random(len(base)) > rng.choice([0.0, 0.06, 0.15])]
            made.append(sorted({*kept.tolist(), *rng.integers(0, 1 << 40, rng.integers(0, 8)).tolist(), family}))
    common = list(range(100_000, 100_070))
    made += [[*common, *range(10**9 + 100 * i, 10**9 + 100 * i + 30)] for i in range(30)]
    roots = [int(r) for r in rng.integers(0, len(made) // 2, len(made))]
    frame = spark.createDataFrame([(i, r, m) for i, (r, m) in enumerate(zip(roots, made))], "doc_id long, root long, shingles array<long>")
    entries = {}
    for r in simhash.meeting_places(frame, 0.8).collect():
        assert r.root == roots[r.doc_id] and r.size == len(made[r.doc_id])
        entries.setdefault(r.shingle, {})[r.doc_id] = r.place
    # A passage that thirty have, beside as many shingles of their own as keep them unlike, brings none of them together.
    assert not any(i >= len(made) - 30 for e in entries.values() for i in e)
    sets, close = [set(m) for m in made], 0
    for b in range(len(made)):
        for a in range(b):
            if roots[a] != roots[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                close += 1
                least = 0.8 / 1.8 * (len(made[a]) + len(made[b])) - simhash.ROUNDING
                assert any(min(len(made[i]) - e[i] + 1 for i in (a, b)) >= least for e in entries.values() if a in e and b in e)
    assert close > 50


def test_one_of_each_over_rough_rows(spark):
    docs = documents(spark)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert ids.count(3) == 1 and ids.count(None) == 2 and 0 in ids and not {40, 41, 42} & set(ids)
    assert simhash.one_of_each(nothing(spark)).count() == 0


def test_chunks_cover_texts_and_survive_insertions():
    text = prose(5, 3000).encode()
    ends, _ = chunkdedup.cuts(text)
    assert ends[-1] == len(text) and ends == sorted(set(ends))
    chunk = lambda d: {d[a:b] for a, b in zip([0, *chunkdedup.cuts(d)[0]], chunkdedup.cuts(d)[0])}
    before, after = chunk(text), chunk(text[:5000] + b"inserted " + text[5000:])
    assert len(before - after) <= 4
    for odd in ("x" * 5000, "ü" * 3000, "a", " ", "\U0001f642" * 999, "word " * 400):
        data = odd.encode()
        ends, _ = chunkdedup.cuts(data)
        assert ends[-1] == len(data) and "".join(data[a:b].decode() for a, b in zip([0, *ends], ends)) == odd


def test_repeated_passages_are_found_and_cut(spark):
    passage = prose(77, 60)
    docs = {i: prose(1000 + i, 120) for i in range(30)}
    for i in (4, 9, 21):
        head, tail = docs[i][:300], docs[i][300:]
        docs[i] = head + " " + passage + " " + tail
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    spans = chunkdedup.repeated_spans(frame).collect()
    assert {(r.doc_id, r.first_doc_id) for r in spans} == {(9, 4), (21, 4)}
    for r in spans:
        found = docs[r.doc_id].encode()[r.start:r.end].decode().strip()
        assert found in docs[4] and len(found.split()) >= 16
    cut = {r.doc_id: r.text for r in chunkdedup.without_repeats(frame).collect()}
    assert all(cut[i] == docs[i] for i in docs if i not in (9, 21))
    assert len(cut[9].split()) < 150 and passage not in cut[9]


def test_passages_just_over_fifty_words(spark):
    import random

    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(1, 5)))
    docs, at = {}, {}
    for i in range(300):
        passage = " ".join(word() for _ in range(51))
        for doc_id in (i, 1_000 + i):
            head = " ".join([*(word() for _ in range(rng.randint(20, 60))), "q"]) + " "
            docs[doc_id] = f"{head}{passage} z{doc_id} " + " ".join(word() for _ in range(rng.randint(20, 60)))
            at[doc_id] = len(head), len(head) + len(passage)
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    spans = chunkdedup.repeated_spans(frame).collect()
    for r in spans:
        assert docs[r.doc_id][r.start:r.end] in docs[r.first_doc_id]
    for i in range(300):
        begin, end = at[1_000 + i]
        assert any(r.doc_id == 1_000 + i and r.start <= begin and end <= r.end for r in spans), i
    cut = {r.doc_id: r.text for r in chunkdedup.without_repeats(frame).collect()}
    assert all(cut[i] == docs[i] for i in range(300))
    for i in range(1_000, 1_300):
        assert docs[i][slice(*at[i])] not in cut[i]


def test_spans_are_passages_of_one_document(spark):
    docs = {i: prose(500 + i, 120) for i in range(8)}
    pieces = [docs[i].split()[40:50] for i in range(8)]
    docs[9] = " ".join(w for p in pieces for w in p)
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    assert chunkdedup.repeated_spans(frame).count() == 0
    assert chunkdedup.without_repeats(frame).filter("doc_id = 9").first().text == docs[9]


def test_cutting_over_rough_rows(spark):
    docs = documents(spark)
    out = chunkdedup.without_repeats(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    by_id = {r.doc_id: r for r in out.collect() if r.doc_id is not None}
    assert by_id[40].text == "" and by_id[0].text == texts()[0] and by_id[43].text is None and by_id[40].n_chars == 0
    assert by_id[3].text == texts()[3]
    assert chunkdedup.without_repeats(nothing(spark)).count() == 0
    assert chunkdedup.repeated_spans(nothing(spark)).count() == 0


def test_groups_fetch_texts_once_and_without_sketches_on_disk(spark, monkeypatch):
    local = [str(d) for d in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    shuffled = lambda: {p for d in local for p in glob.glob(f"{d}/*/shuffle_*.data")}
    held = lambda: {os.path.basename(p) for p in glob.glob(f"{shared_folder(spark)}/*")}
    docs = stored(documents(spark), "docs")
    release(spark)
    files, tables, fetched = shuffled(), held(), []
    # Shuffles that have files; the last is that of the ids to fetch.
    left = lambda: {os.path.basename(p).split("_")[1] for p in shuffled() - files}

    def watched(df, name, *rest):
        if any(f in df.inputFiles() for f in docs.inputFiles()) and name != "sketches":
            until = time.time() + 20
            while len(left()) > 1 and time.time() < until:
                time.sleep(0.2)
            fetched.append((name, len(left()) > 1, {t.split("-")[0] for t in held() - tables} & {"sketches", "leaders"}))
        return stored(df, name, *rest)

    monkeypatch.setattr(simhash, "stored", watched)
    simhash.similar_groups(docs)
    assert fetched == [("texts", False, set())]


def test_cutting_keeps_only_its_spans_on_disk(spark):
    local = [str(d) for d in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    shuffled = lambda: {p for d in local for p in glob.glob(f"{d}/*/shuffle_*.data")}
    held = lambda: {os.path.basename(p) for p in glob.glob(f"{shared_folder(spark)}/*")}
    release(spark)
    files, tables = shuffled(), held()
    out = chunkdedup.without_repeats(documents(spark))
    until = time.time() + 20
    while shuffled() - files and time.time() < until:
        time.sleep(0.2)
    assert not shuffled() - files
    assert [name.split("-")[0] for name in held() - tables] == ["spans"]
    assert out.count() == documents(spark).count()


def test_different_texts_of_one_id_all_stay(spark):
    a, b, c = prose(1, 80), prose(2, 80), prose(3, 80)
    rows = [(1, a, "x"), (1, b, "x"), (1, a, "x"), (2, c, "y"), (3, a + " more", "z"), (4, b + " more", "z"), (None, a, "n"), (5, None, "e"), (5, "", "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = simhash.one_of_each(docs)
    assert got.columns == docs.columns
    kept = sorted(((r.doc_id, r.text) for r in got.collect()), key=str)
    # Of the id 1 one text goes by the id and the other counts as large, so one of the documents 3 and 4 is the smaller copy.
    assert (None, a) in kept and (2, c) in kept and {t for i, t in kept if i == 1} <= {a, b}
    assert sum(t in (a, a + " more") for i, t in kept if i) == 1 and sum(t in (b, b + " more") for i, t in kept if i) == 1
    assert sum(not t for _, t in kept) == 1 and len(kept) == 5
