"""Operators 2 and 7."""

import re
import zlib

import numpy as np
import pandas as pd
import pytest

from orderloom.llm import langid, weakrules
from orderloom.llm.common import stored

from .rough import documents, nothing, rows, texts


def test_languages_are_learned(spark):
    docs = documents(spark)
    got = langid.identify(docs).collect()
    assert len(got) == len(rows())
    langs = {r[0]: r[2] for r in rows()}
    right = [r.lang_pred == langs[r.doc_id] for r in got if r.doc_id is not None and r.doc_id < 40]
    assert np.mean(right) >= 0.95
    by_id = {r.doc_id: r for r in got}
    for i in (43, 45, 46, 48):
        assert tuple(by_id[i])[2:] == ("und", 0.0, True)
    assert all(0 <= r.score <= 1 and r.lang_pred in ("en", "de", "und") for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)


def test_languages_of_nothing(spark):
    assert langid.identify(nothing(spark)).count() == 0
    unlabelled = documents(spark).selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")
    assert {r.lang_pred for r in langid.identify(unlabelled).collect()} == {"und"}


def test_held_out_texts_by_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.97
    assert np.mean([r.rejected for r in got]) < 0.02


def letters(rng, alphabet):
    return [" ".join("".join(rng.choice(list(alphabet), rng.integers(2, 9))) for _ in range(rng.integers(5, 80))) for _ in range(100)]


@pytest.mark.parametrize("draw", [1, 2, 3])
@pytest.mark.parametrize("unlabelled", ["en", "de", "es", "fr"])
def test_texts_of_no_learned_language_are_rejected(unlabelled, draw):
    docs = pd.read_parquet("/root/testdata/sf0.1/documents.parquet")
    docs = docs[docs.text.notna() & docs.lang.notna()].sample(frac=1, random_state=draw)
    learned, rest = docs[docs.lang != unlabelled], docs[docs.lang == unlabelled]
    model = langid.train(learned.text[:2_000].tolist(), learned.lang[:2_000].tolist())
    assert 0.05 < model.temperature < 20
    rng = np.random.default_rng(draw)
    rejected = lambda texts: np.mean([model.predict(t)[2] for t in texts])
    assert rejected(rest.text[:200]) >= 0.9
    assert rejected(letters(rng, "абвгдежзиклмнопрстуфхцчшщыьэюя")) >= 0.9
    assert rejected(letters(rng, "abcdefghijklmnopqrstuvwxyz")) >= 0.9
    assert rejected(learned.text[2_000:4_000]) <= 0.01


def test_novelty_is_the_share_of_subwords_not_learned():
    model = langid.train(["the cat sat on the mat"] * 30 + ["der hund lag auf dem dach"] * 30, ["en"] * 30 + ["de"] * 30)
    en, de = model.languages.index("en"), model.languages.index("de")
    assert model.novelty(langid.subwords("the cat sat"), en) == 0.0
    found = langid.subwords("the cat sat")
    known = set(np.concatenate(langid.subwords("der hund lag auf dem dach")).tolist())
    assert model.novelty(found, de) == pytest.approx(np.mean([h not in known for h in np.concatenate(found).tolist()]))
    assert langid.train(["only one language here"] * 30, ["en"] * 30).predict("only one language")[0] == "en"


def test_identified_rows_keep_their_columns(spark):
    docs = documents(spark)
    kept = langid.keep_identified(docs)
    assert kept.columns == docs.columns and kept.schema["lang_pred"].dataType == docs.schema["lang_pred"].dataType
    ids = {r.doc_id for r in kept.collect()}
    assert {*range(40)} <= ids and not {43, 45, 46, 48} & ids


def plain_facts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def test_facts_by_definition():
    for text in [t for t in texts() if t is None or len(t) < 5000] + ["a b c d e a b c d e f", "w " * 7, "x\n\nx\n \n \nx"]:
        f = weakrules.facts(text)
        assert (f.n_words, f.word_chars, f.n_symbols, f.n_dup_lines, f.n_repeat_words) == plain_facts(text), repr(text)[:60]


def test_quality_over_rough_rows(spark):
    got = weakrules.quality(documents(spark), stored).collect()
    assert len(got) == len(rows())
    by_id = {r.doc_id: r for r in got}
    for i, text in enumerate(texts()):
        n = by_id[i]
        assert n.base_failed == (n.n_words < 10 or 100 * n.n_repeat_words > 20 * n.n_words)
        assert not (n.base_failed and n.kept)
    assert all(by_id[i].kept for i in range(40)) and not by_id[43].kept
    assert weakrules.quality(nothing(spark), stored).count() == 0
    assert weakrules.keep_good(nothing(spark)).count() == 0
    kept = weakrules.keep_good(documents(spark))
    assert kept.columns == documents(spark).columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in got if r.kept)


def test_accuracies_are_recovered():
    rng = np.random.default_rng(1)
    good = rng.random(20_000) < 0.85
    bad_vote = np.where(good[:, None], rng.random((20_000, 5)) < 0.005, rng.random((20_000, 5)) < [0.5, 0.4, 0.6, 0.5, 0.3])
    patterns, counts = np.unique(np.where(bad_vote, -1, 1), axis=0, return_counts=True)
    model = weakrules.expectation_maximisation(patterns, counts.astype(float))
    assert abs(model.prior - 0.85) < 0.03
    verdicts = np.array([model.posterior(list(p)) >= 0.5 for p in np.where(bad_vote, -1, 1)])
    assert (verdicts == good).mean() > 0.97


def plain_verdicts(votes, rounds=3000):
    """The same estimate over single texts, a loop a text and a rule; votes are 1, -1 and 0."""
    p = [0.1 ** sum(v < 0 for v in row) for row in votes]
    for _ in range(rounds):
        share = (sum(p) + 9) / (len(p) + 10)
        chances = []
        for j in range(len(votes[0])):
            voted = [(q, row[j] < 0) for q, row in zip(p, votes) if row[j]]
            g = (sum(q for q, b in voted if b) + 2) / (sum(q for q, _ in voted) + 200)
            chances.append((g, max(g, (sum(1 - q for q, b in voted if b) + 0.04) / (sum(1 - q for q, _ in voted) + 0.1))))
        before, p = p, []
        for row in votes:
            good, bad = share, 1 - share
            for v, (g, b) in zip(row, chances):
                if v:
                    good, bad = good * (g if v < 0 else 1 - g), bad * (b if v < 0 else 1 - b)
            p.append(good / (good + bad))
        if max(abs(a - b) for a, b in zip(before, p)) < 1e-9:
            break
    return p


def drawn_votes(seed, n, on_good):
    rng = np.random.default_rng(seed)
    good = rng.random(n) < 0.85
    bad_vote = np.where(good[:, None], rng.random((n, 5)) < on_good, rng.random((n, 5)) < [0.5, 0.4, 0.6, 0.5, 0.3])
    return good, np.where(rng.random((n, 5)) < 0.1, 0, np.where(bad_vote, -1, 1))


def test_posteriors_equal_those_of_single_texts():
    _, votes = drawn_votes(3, 400, [0.05, 0.1, 0.005, 0.005, 0.005])
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = weakrules.expectation_maximisation(patterns, counts.astype(float))
    wanted = plain_verdicts(votes.tolist())
    assert max(abs(model.posterior(v) - w) for v, w in zip(votes.tolist(), wanted)) < 1e-4


@pytest.mark.parametrize("n", [2_000, 20_000, 500_000])
def test_rules_of_many_false_alarms_cost_few_good_texts(n):
    good, votes = drawn_votes(n, n, [0.05, 0.1, 0.005, 0.005, 0.005])
    patterns, at, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    model = weakrules.expectation_maximisation(patterns, counts.astype(float))
    kept = np.array([model.posterior(v) >= 0.5 for v in patterns.tolist()])[at.ravel()]
    assert 1 - kept[good].mean() < 0.03 and kept[~good].mean() < 0.25 and abs(model.prior - 0.85) < 0.03


@pytest.mark.parametrize("copies", [1, 30, 10_000])
def test_a_rule_that_votes_alone_decides_at_every_size(copies):
    patterns = np.array([[1, 1, 1, 1], [-1, 1, 1, 1], [1, 1, 0, 1], [-1, 1, 0, 1], [1, -1, 1, 1]])
    model = weakrules.expectation_maximisation(patterns, np.array([700.0, 70, 150, 15, 3]) * copies)
    assert [model.posterior(v) >= 0.5 for v in patterns.tolist()] == [True, False, True, False, True]


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01"])
def test_labels_agree(spark, folder):
    got = weakrules.quality(spark.read.parquet(f"{folder}/documents.parquet"), stored)
    rows = got.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    assert np.mean([r.kept for r in rows if r.quality == 1 and not r.base_failed]) > 0.99
    assert np.mean([r.kept for r in rows if r.quality == 0]) < 0.1


def test_sample_is_bounded_for_any_ids(spark, monkeypatch):
    rows = [(None, f"text {i} of no id", "en") for i in range(3_000)] + [(7, f"text {i} of one id", "en") for i in range(3_000)]
    rows += [(9, "the same row", "de")] * 3_000
    taken = []
    monkeypatch.setattr(langid, "train", lambda texts, langs: taken.append(list(texts)))
    langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), 400)
    assert 120 < len(taken[0]) < 300 and taken[0].count("the same row") == 1
