"""Operators 11, 12 and 13."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderloom.llm import bagrank, exactdup, walshkmeans

from .rough import documents, nothing, prose, rows

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda x: x[0].lower(), text or ""))


def ranked(docs, items, k):
    """Plain scores of all documents for all items."""
    bags = [(i, Counter(terms(t))) for i, t in docs]
    lengths = [sum(b.values()) for _, b in bags]
    n_docs, n_terms = sum(n > 0 for n in lengths), sum(lengths)
    df = Counter(t for _, b in bags for t in b)
    wanted = defaultdict(Counter)
    for item, text in {x for x in items if x[0] is not None}:
        wanted[item].update(terms(text))
    out = []
    for item, query in wanted.items():
        found = []
        for (doc, bag), n in zip(bags, lengths):
            m = 25 + 75 * n * n_docs // n_terms if n_terms else 0
            score = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 8 * m))
                        for t, q in query.items() if t in bag)
            if score:
                found.append((-score, doc is None, doc or 0, doc))
        out += [(item, place + 1, doc, -score) for place, (score, _, _, doc) in enumerate(sorted(found, key=lambda x: x[:3])[:k])]
    return sorted(out)


ITEMS = [(1, prose(3, 12)), (2, prose(0, 30) + " " + prose(0, 30)), (2, prose(4, 9)), (2, prose(4, 9)), (3, None), (4, "  ,.; "), (5, "é ÉÉ Éa 日本語 A1b"),
         (None, prose(1, 9)), (6, "lone lone changed"), (7, "nosuchterm")]


def items(spark):
    return spark.createDataFrame([(*r, "x", 1) for r in ITEMS], "item_id long, text string, doc_id string, score int")


@pytest.mark.parametrize("block_terms,k", [(bagrank.BLOCK_TERMS, 10), (8, 3)])
def test_search_equals_plain_scores(spark, block_terms, k):
    got = bagrank.search(documents(spark), items(spark), k, block_terms)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(tuple(r) for r in got.collect()) == ranked([r[:2] for r in rows()], ITEMS, k)


def test_search_over_many_copies_and_ties(spark, monkeypatch):
    rng = random.Random(5)
    words = [prose(i, 1) for i in range(30)]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 6)))) for i in range(700)]
    docs += [(1000 + i, "same text for all " + words[3]) for i in range(400)]
    rng.shuffle(docs)
    wanted = [(i, " ".join(rng.sample(words, 4)) + " same") for i in range(25)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    asked = spark.createDataFrame(wanted, "item_id long, text string")
    answer = ranked(docs, wanted, 10)
    assert sorted(tuple(r) for r in bagrank.search(frame, asked).collect()) == answer
    monkeypatch.setattr(bagrank, "CELLS", 60)
    assert sorted(tuple(r) for r in bagrank.search(frame, asked).collect()) == answer


def test_scores_beyond_floats():
    index = bagrank.Index([(1, b"a", 1), (1, b"b", 10**6), (2, b"b", 3)])
    got = bagrank.score(index, np.array([1, 10**5]), [np.array([0, 1], np.uint32)], [np.array([1, 1], np.uint32)], np.array([0]))
    assert got.tolist() == [[10**6 + 10**5 * 10**6 * 10**6, 3 * 10**5 * 10**6]]


def test_search_without_rows(spark):
    assert bagrank.search(nothing(spark), items(spark)).count() == 0
    assert bagrank.search(documents(spark), items(spark).limit(0)).count() == 0
    blank = documents(spark).withColumn("text", F.lit(" ,"))
    assert bagrank.search(blank, items(spark)).count() == 0


# --- 12 --------------------------------------------------------------------

def plain_clusters(vectors, k, rounds):
    """Integers throughout, every distance in full."""
    kept = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in vectors
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest()))
    points = [v for _, v in order[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, p)), c) for c, p in enumerate(points)) for _, v in kept]

    for _ in range(rounds):
        members = defaultdict(list)
        for (_, v), (_, c) in zip(kept, assign()):
            members[c].append(v)
        for c, vs in members.items():
            points[c] = [sum(x) // len(vs) for x in zip(*vs)]
    last, inertia = assign(), Counter()
    for d, c in last:
        inertia[c] += d
    return sorted(((i, c, d, inertia[c], sum(inertia.values()), hashlib.sha256(",".join(map(str, points[c])).encode()).hexdigest())
                   for (i, _), (d, c) in zip(kept, last)), key=str)


def vectors(spark, made):
    return spark.createDataFrame([(i, v, 7, "x") for i, v in made], "vec_id long, embedding array<double>, cluster int, inertia string")


def odd_vectors():
    rng = random.Random(9)
    made = [(i, [rng.gauss(i % 5, 0.3) for _ in range(64)]) for i in range(300)]
    made += [(i, made[i % 3][1]) for i in range(300, 340)] + [made[5], made[5]]
    # Small integers make many ties of distance.
    made += [(i, [rng.choice([-1.0, 0.0, 1.0]) / 256 for _ in range(64)]) for i in range(400, 480)]
    nan, inf = float("nan"), float("inf")
    made += [(500, None), (501, []), (502, [1.0] * 63), (503, [1.0] * 65), (504, [1.0] * 63 + [None]), (505, [nan] + [1.0] * 63),
             (506, [-inf] + [1.0] * 63), (507, [0.0] * 64), (None, [0.5] * 64), (508, [65535.9] * 64), (509, [-65000.25] * 64)]
    return made


@pytest.mark.parametrize("k,rounds", [(40, 5), (7, 2), (1, 1), (1000, 1)])
def test_clusters_equal_the_plain_search(spark, k, rounds):
    got = walshkmeans.clusters(vectors(spark, odd_vectors()).repartition(5), k, rounds)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_clusters(odd_vectors(), k, rounds)


def test_transform_is_exact_and_turned_back():
    rng = np.random.default_rng(1)
    x = rng.integers(-walshkmeans.LIMIT + 1, walshkmeans.LIMIT, (50, 64))
    made = walshkmeans.transform(x)
    assert [walshkmeans.turned_back(r) for r in made.tolist()] == x.tolist()
    far = ((made[:25] - made[25:]) ** 2).sum(axis=1)
    assert (far == 64 * ((x[:25] - x[25:]) ** 2).sum(axis=1)).all() and np.abs(made).max() < 2**31
    flips = (np.diff(np.sign(walshkmeans.transform(np.eye(64, dtype=np.int64)).T), axis=1) != 0).sum(axis=1)
    assert flips.tolist() == list(range(64))


def test_ties_go_to_the_smaller_number():
    points = np.zeros((3, 64), np.int64)
    points[0, 0], points[1, 63], points[2, 0] = 2, 2, -2
    number, distance = walshkmeans.nearest(walshkmeans.transform(np.zeros((2, 64), np.int64)), walshkmeans.transform(points))
    assert number.tolist() == [0, 0] and distance.tolist() == [4, 4]


def test_clusters_without_rows_and_too_far(spark):
    assert walshkmeans.clusters(vectors(spark, [(1, None), (2, [1.0])])).count() == 0
    assert walshkmeans.clusters(vectors(spark, odd_vectors()).limit(0)).count() == 0
    with pytest.raises(Exception, match="need not fit"):
        walshkmeans.clusters(vectors(spark, [(1, [65536.0] * 64)]))


# --- 13 --------------------------------------------------------------------

def plain_duplicates(docs):
    groups = defaultdict(list)
    for place, (i, t) in enumerate(docs):
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i or 0, place, i))
    out = []
    for content, members in groups.items():
        first = min(members)
        digest = hashlib.sha256(content.encode()).hexdigest()
        out += [(m[4], first[4], len(members), m == first, digest) for m in members]
    return Counter(out)


BLANKS = [(900, "a b\tc"), (901, "abc"), (902, " a\nb\x0bc\x0c\r "), (903, "a bc"), (904, "a\x1cbc"), (905, "ab c "), (None, "abc"),
          (905, "ab c "), (905, "a bc "), (906, " \t"), (907, "é é"), (908, "éé ")]


def weak_hash(content):
    """Two bits, so that most groups hold several texts."""
    return F.pmod(F.xxhash64(content), F.lit(4)), F.lit(0).cast("long")


@pytest.mark.parametrize("hashed", [exactdup.content_hash, weak_hash])
@pytest.mark.parametrize("most_sent", [exactdup.MOST_SENT, 0])
def test_duplicates_equal_plain_groups(spark, hashed, most_sent):
    made = [r[:2] for r in rows()] + BLANKS
    docs = documents(spark).select("doc_id", "text", "a", "votes").unionByName(
        spark.createDataFrame([(*b, 1, 2) for b in BLANKS], "doc_id long, text string, a long, votes int"))
    docs = docs.withColumns({"place": F.lit("x"), "h1": F.lit(1), "content": F.lit("c")}).repartition(6)
    got = exactdup.duplicates(docs, hashed, most_sent)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert Counter(tuple(r) for r in got.collect()) == plain_duplicates(made)


def test_duplicates_of_nothing_and_kept_rows(spark):
    assert exactdup.duplicates(nothing(spark)).count() == 0
    kept = exactdup.without_duplicates(documents(spark))
    assert kept.count() == kept.select("text_sha256").distinct().count() == len({re.sub(r"[\x20\x09-\x0D]", "", r[1] or "") for r in rows()})


def test_duplicates_run_without_python(spark):
    plan = exactdup.duplicates(documents(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|MapPartitions", plan)
