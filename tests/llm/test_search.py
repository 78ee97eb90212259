"""Operators 5 and 10."""

import hashlib
import random

import numpy as np
import pytest

from orderloom.llm import rabitq, warc
from orderloom.session import working_path


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, place int, refers_to string")


def made_pages():
    long = "<p>" + "copy " * 300 + "</p>"
    rows = [(i, f"http://www.Host{i % 3}.example.org:80/p{i % 4}?q={i}", f"<html>{i} café\r\n\r\nWARC/1.1\r\n{'z' * (i * 40)}</html>")
            for i in range(40)]
    rows += [(100 + i, "http://h.example/same", long) for i in range(25)]
    rows += [(200, None, long), (201, "", None), (202, "not a url\r\n", ""), (203, "http://[bad", "short"), (204, "http://a/x", "short"),
             (None, "http://a/x", long), (None, None, None), (124, "http://h.example/same", long), (5, "http://x/", "y" * 3000)]
    return [r + (1, "s") for r in rows]


@pytest.mark.parametrize("file_bytes,range_rows", [(16 << 20, 50_000), (8_000, 7)])
def test_archives_round_trip(spark, file_bytes, range_rows):
    out = working_path(spark, "warc")
    warc.write_archives(pages(spark, made_pages()), out, file_bytes)
    got = warc.captures(spark, out, range_rows=range_rows).collect()
    largest = {}
    for page_id, _, html, *_ in made_pages():
        if page_id is not None and len((html or "").encode()) >= 1000:
            largest[html] = max(largest.get(html, -1), page_id)
    wanted = []
    for page_id, _, html, *_ in made_pages():
        data = (html or "").encode()
        to = largest.get(html)
        revisit = page_id is not None and to is not None and page_id < to
        wanted.append((page_id, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", to if revisit else None))
    assert sorted(str((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in got) == sorted(map(str, wanted))
    ordered = sorted(got, key=lambda r: r.place)
    keys = [(r.url_key, r.at, r.page_id is not None, r.page_id or 0) for r in ordered]
    assert keys == sorted(keys) and len({r.place for r in got}) == len(got)
    history = warc.capture_history(warc.captures(spark, out, range_rows=range_rows))
    same = sorted((r.page_id, r.capture) for r in history.filter("url_key = 'example,h)/same'").collect())
    assert [c for _, c in same] == [*range(1, len(same) + 1)]


def test_records_are_found_by_place(spark):
    out = working_path(spark, "warc")
    warc.write_archives(pages(spark, made_pages()), out, 8_000, compression="none")
    files = {r.path.rsplit("/", 1)[-1]: bytes(r.content) for r in spark.read.format("binaryFile").load(out + "/*.txt").collect()}
    for r in warc.merged_index(spark, out).collect():
        record = files[r.file][r.offset:r.offset + r.length]
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
        assert b"sha1:" + r.payload_digest.encode() in record


def test_archives_of_nothing(spark):
    out = working_path(spark, "warc")
    warc.write_archives(pages(spark, []), out)
    assert warc.captures(spark, out).count() == 0


def test_damage_is_noticed():
    with pytest.raises(ValueError):
        list(warc.parse(b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabcXXXX"))


@pytest.mark.parametrize("k", [0, 1, 2, 3, 8, 13])
def test_loser_tree_merges(k):
    rng = random.Random(k)
    runs = [sorted(rng.choices(range(30), k=rng.randint(0, 12))) for _ in range(k)]
    assert list(warc.LoserTree(runs, lambda x: x)) == sorted(sum(runs, []))


def exact(rows, every, k):
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v) and len(v) == 8:
            good[i] = np.array(v, np.float64)
    out = []
    for q in good:
        if q % every == 0:
            near = sorted((float(np.sqrt(((good[i] - good[q]) ** 2).sum())), i) for i in good if i != q)[:k]
            out += [(q, n + 1, i, d) for n, (d, i) in enumerate(near)]
    return out


def vectors(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, list int, v string")


def test_neighbours_over_rough_rows(spark):
    rng = np.random.default_rng(3)
    near = lambda v: [float(np.float32(x)) for x in v]
    rows = [(i, near(rng.normal(size=8))) for i in range(300)]
    rows += [(i, near(np.ones(8))) for i in range(300, 360)]
    rows += [(400, None), (401, []), (402, [0.0] * 8), (403, [1.0] * 7 + [None]), (404, [float("nan")] * 8), (405, [float("inf")] * 8),
             (410, [1.0] * 5), (None, near(rng.normal(size=8))), (20, rows[20][1])]
    got = rabitq.nearest(vectors(spark, rows), every=20, k=10).collect()
    wanted = {(q, i): d for q, _, i, d in exact(rows, 20, 10)}
    found = {(r.query_id, r.vec_id): r.score for r in got}
    assert len(got) == len(wanted) and len(set(wanted) & set(found)) >= 0.9 * len(wanted)
    assert all(abs(found[x] - wanted[x]) < 1e-12 for x in set(wanted) & set(found))
    copies = [r.vec_id for r in sorted(got, key=lambda r: r.rank) if r.query_id == 320]
    assert copies == [*range(300, 310)]


def test_few_vectors_and_none(spark):
    rows = [(0, [1.0, 2.0]), (1, [2.0, 2.0]), (2, [1.0, 2.0])]
    got = sorted(map(tuple, rabitq.nearest(vectors(spark, rows), every=2, k=10).collect()))
    assert [r[:3] for r in got] == [(0, 1, 2), (0, 2, 1), (2, 1, 0), (2, 2, 1)]
    assert rabitq.nearest(vectors(spark, [])).count() == 0
    assert rabitq.nearest(vectors(spark, [(0, [1.0, 2.0])])).count() == 0


def test_recall_on_given_vectors(spark):
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = frame.select("vec_id", "embedding").collect()
    ids, all_ = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    got = {}
    for r in rabitq.nearest(frame).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = []
    for n in np.flatnonzero(ids % 100 == 0):
        d = np.sqrt(((all_ - all_[n]) ** 2).sum(1))
        d[n] = np.inf
        hits.append(len(set(ids[np.lexsort((ids, d))[:10]].tolist()) & got[ids[n]]) / 10)
    assert np.mean(hits) >= 0.9


def test_bounds_hold():
    rng = np.random.default_rng(8)
    v, q, c = rng.normal(size=(2000, 64)), rng.normal(size=64), rng.normal(size=64) * 0.1
    rotation, _ = np.linalg.qr(rng.normal(size=(64, 64)))
    low, high = rabitq.bounds(*rabitq.encode(v, c, rotation), q, c, rotation)
    true = ((v - q) ** 2).sum(1)
    assert ((low <= true) & (true <= high)).mean() > 0.99


def test_outliers_find_as_many_neighbours_as_there_are(spark):
    rng = np.random.default_rng(4)
    dense = rng.normal(size=(1500, 8)) * 0.01
    far = rng.normal(size=(40, 8)) * 100
    rows = [(i + 1, v.tolist()) for i, v in enumerate(dense)] + [(100 * (i + 1) + 100_000, v.tolist()) for i, v in enumerate(far)]
    rows += [(100_100, (far[0] + 1).tolist()), (100_100, (far[0] + 2).tolist())]
    got = rabitq.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    found = {}
    for r in got:
        found.setdefault(r.query_id, []).append(r.vec_id)
    assert all(len(v) == 10 and q not in v for q, v in found.items() if q != 100_100) and len(found) == 55 and 100_100 not in found[100_100]


@pytest.mark.parametrize("bits", [64, 100, 512])
def test_shared_bits_give_the_inner_product_with_the_signs(bits):
    rng = np.random.default_rng(bits)
    rotation = np.linalg.qr(rng.normal(size=(bits, bits)))[0][:20]
    v, q, c = rng.normal(size=(300, 20)), rng.normal(size=20), rng.normal(size=20) * 0.1
    codes, length, correction = rabitq.encode(v, c, rotation)
    y = (q - c) @ rotation
    signs = np.unpackbits(codes, axis=1, count=bits) * 2.0 - 1
    wanted = length**2 + y @ y - 2 * length * (signs @ y) / np.sqrt(bits) / correction
    low, high = rabitq.bounds(codes, length, correction, q, c, rotation)
    step = (y.max() - y.min()) / ((1 << rabitq.PLANES) - 1)
    assert np.abs((low + high) / 2 - wanted).max() <= 2 * length.max() * step / 2 * np.sqrt(bits) / correction.min()
    assert (low <= wanted).all() and (wanted <= high).all()


def test_codes_choose_what_is_measured(spark):
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    search = rabitq.indexed(frame, 10)
    queries, _ = search.queries(100, 10)
    visited = sum(int(search.sizes[r["lists"]].sum()) for r in queries.collect())
    assert 0 < search.survivors(queries).count() < 0.2 * visited
    code = search.codes.first()
    assert search.codes.columns == ["list", "number", "code", "length", "correction"] and len(code.code) == rabitq.BITS // 8


def test_many_queries_of_one_vector(spark, monkeypatch):
    monkeypatch.setattr(rabitq, "BLOCK", 40)
    monkeypatch.setattr(rabitq, "SLICE", 7)
    rng = np.random.default_rng(6)
    rows = [(i, [1.0] * 8) for i in range(0, 400, 2)] + [(i, rng.normal(size=8).tolist()) for i in range(1, 400, 2)]
    got = {}
    for r in rabitq.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=20).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert len(got) == 20
    for q, found in got.items():
        assert [i for _, i, _ in sorted(found)] == [i for i in range(0, 24, 2) if i != q][:10] and all(s == 0 for *_, s in found)
