"""The pipeline's stages against plain versions, each on what its predecessor kept."""

import re

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from orderloom.llm import langid, weakrules
from orderloom.llm.common import stored

FOLDER = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def kept(spark):
    """Rows after each stage, by id; the last one's as they are."""
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    for name, stage in [("documents", lambda spark, docs, folder: docs), *corpus_pipeline.STAGES]:
        docs = stored(stage(spark, docs, FOLDER), "stage")
        out.append(docs)
    return [{r.doc_id: r for r in d.collect()} for d in out[:-1]] + [out[-1].collect()]


def test_language_and_quality_drop_what_their_operators_reject(spark, kept):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert set(kept[1]) == {r.doc_id for r in langid.identify(docs).collect() if not r.rejected}
    verdicts = weakrules.quality(docs.filter(docs.doc_id.isin(list(kept[1]))), stored).collect()
    assert set(kept[2]) == {r.doc_id for r in verdicts if r.kept}


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda x: x[0].lower(), text or ""))
    return frozenset(" ".join(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def test_near_copies_are_those_of_all_pairs(kept):
    ids = sorted(kept[2])
    sets = [shingles(kept[2][i].text) for i in ids]
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for b in range(len(ids)):
        for a in range(b):
            small, large = sorted((len(sets[a]), len(sets[b])))
            if small >= 0.8 * large:
                common = len(sets[a] & sets[b])
                if sets[a] == sets[b] or common >= 0.8 * (small + large - common):
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    assert set(kept[3]) == {ids[x] for x in range(len(ids)) if find(x) == x}
    assert all(kept[3][i] == kept[2][i] for i in kept[3])


def windows(text, n):
    at = [m.span() for m in WORD.finditer(text)]
    return {text[at[i][0]:at[i + n - 1][1]] for i in range(len(at) - n + 1)}


def test_passages_that_an_earlier_document_has_are_cut(kept):
    before, after = kept[3], kept[4]
    assert set(before) == set(after)
    seen, left, lost, shared = set(), 0, 0, 0
    for i in sorted(before):
        mine = windows(before[i].text, 50)
        shared += len(mine & seen)
        left += len(windows(after[i].text, 50) & seen)
        seen |= mine
        assert after[i].n_chars == len(after[i].text) and after[i][2:4] == before[i][2:4]
    assert shared > 100 and left == 0
    # What went is in earlier documents, 16 words at a time.
    earlier = set()
    for i in sorted(before):
        runs, rest = windows(before[i].text, 16), windows(after[i].text, 16)
        if before[i].text != after[i].text:
            lost += not (runs - rest) & earlier
        earlier |= runs
    assert lost == 0


def test_pieces_hold_every_token_once(kept):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.no_truncation()
    library.no_padding()
    lengths, places = {}, {}
    for r in kept[5]:
        lengths[r.doc_id] = lengths.get(r.doc_id, 0) + r.length
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    wanted = {i: len(library.encode(r.text, add_special_tokens=False).ids) + 1 for i, r in kept[4].items()}
    assert lengths == wanted
    for pieces in places.values():
        ends = np.cumsum([n for _, n in sorted(pieces)])
        assert [at for at, _ in sorted(pieces)] == [0, *ends[:-1]] and ends[-1] <= 2048
