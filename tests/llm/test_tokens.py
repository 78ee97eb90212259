"""Operators 3, 6, 8, 9 against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from orderloom.llm import bpeauto, idpack, libids, packing, presplit, tokencount
from orderloom.session import working_path

from .rough import documents, nothing, rows, texts

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [(r[0], r[1]) for r in rows()]


@pytest.fixture(scope="module")
def library():
    return {p: Tokenizer.from_file(p) for p in (BYTE, WORD)}


def ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def packed(numbers):
    return np.array(numbers, "<u4").tobytes()


def odd_texts(n=3000):
    rng = random.Random(5)
    letters = " \n\t'abstredlmvAB\xc91!<|>́\xa0\x85\x1f한Ᲊ\U00010d50"
    return ["".join(rng.choice(letters) for _ in range(rng.randint(1, 40))) for _ in range(n)]


def test_counts_equal_the_library(library):
    counter = tokencount.PairMerger(BYTE)
    for text in odd_texts() + texts():
        assert counter.count(text) == len(ids(library[BYTE], text)), repr(text)[:100]


def test_automaton_and_word_cache_equal_the_library(library):
    codec, words = bpeauto.AutomatonCodec(WORD), libids.LibraryIds(WORD)
    for text in odd_texts() + texts():
        wanted = ids(library[WORD], text)
        assert codec.encode(text) == words.encode(text) == packed(wanted), repr(text)[:100]
        assert codec.decode(packed(wanted)) == library[WORD].decode(wanted, skip_special_tokens=False)


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_letters_alone_are_one_pre_token_without_a_search(path):
    split = presplit.PreSplit(path)
    wanted = {w: split.words(w + " ")[0] for w in ("abc", "ABC", "Straße", "ÀÉÿ", "don", "s")}
    library = {w: [x for x, _ in split.library.pre_tokenizer.pre_tokenize_str(
        split.library.normalizer.normalize_str(w) if split.library.normalizer else w)] for w in wanted}
    split._words = None
    assert {w: split.words(w) for w in wanted} == library == {w: [x] for w, x in wanted.items()}


def test_automaton_accepts_only_what_merging_gives():
    vocab = {t: i for i, t in enumerate(["a", "b", "c", "aa", "ab", "bc", "aab", "abc"])}
    merges = [("a", "a"), ("a", "b"), ("b", "c"), ("aa", "b"), ("ab", "c")]
    automaton = bpeauto.Automaton(vocab, merges)
    assert not automaton.follows(vocab["a"], vocab["aa"]) and automaton.follows(vocab["aa"], vocab["a"])
    assert not automaton.follows(vocab["a"], vocab["b"]) and not automaton.follows(vocab["aa"], vocab["b"])
    assert automaton.follows(vocab["c"], vocab["a"])


def test_token_counts_over_rough_rows(spark, library):
    got = tokencount.token_counts(documents(spark), BYTE, 50).collect()
    wanted = []
    for doc_id, text in TEXTS:
        n = len(ids(library[BYTE], text))
        wanted.append((doc_id, len((text or "").encode()), n, n > 50))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, wanted))
    assert tokencount.token_counts(nothing(spark), BYTE).count() == 0


def test_automaton_digests_over_rough_rows(spark, library):
    got = bpeauto.digests(documents(spark), WORD).collect()
    wanted = []
    for doc_id, text in TEXTS:
        n = ids(library[WORD], text)
        decoded = library[WORD].decode(n, skip_special_tokens=False)
        wanted.append((doc_id, len(n), hashlib.sha256(packed(n)).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, wanted))
    assert bpeauto.encode_decode(nothing(spark), WORD).count() == 0
    row = bpeauto.encode_decode(documents(spark).filter("doc_id = 1"), WORD).first()
    assert bytes(row.ids) == packed(ids(library[WORD], texts()[1]))


@pytest.mark.parametrize("width", [1, 5, 8, 13, 16, 17, 24, 32])
def test_bit_packing_round_trip_and_random_access(width):
    values = np.random.default_rng(width).integers(0, 1 << width, 777, dtype=np.uint64).astype(np.uint32)
    stream = idpack.pack(values, width)
    assert len(stream) == -(-777 * width // 8)
    for start, count in ((0, 777), (5, 100), (776, 1), (100, 0)):
        assert (idpack.unpack(stream, width, start, count) == values[start:start + count]).all()


def test_id_files_over_rough_rows(spark, library):
    out = working_path(spark, "ids")
    idpack.write_ids(documents(spark), out, WORD, 1, shards=3, block_ids=500)
    got = sorted(idpack.read_digests(spark, out).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((i for i, _ in TEXTS), key=lambda i: (i is not None, i))
    at, wanted = 0, sorted((str(i), zlib.crc32(packed(ids(library[WORD], t) + [1]))) for i, t in TEXTS)
    for r in got:
        assert r.start == at
        at += r.n_tokens
    assert sorted((str(r.doc_id), r.ids_crc32) for r in got) == wanted
    one = {r.doc_id: r.ids for r in idpack.read_ids(spark, out).collect()}
    assert one[1] == ids(library[WORD], texts()[1]) + [1]
    empty = working_path(spark, "ids")
    idpack.write_ids(nothing(spark), empty, WORD, 1)
    assert idpack.read_digests(spark, empty).count() == 0


def test_lower_bound_never_exceeds_the_best_packing():
    def fewest(lengths, capacity, best=99, bins=()):
        if not lengths:
            return min(best, len(bins))
        if len(bins) >= best:
            return best
        for i, room in enumerate(bins):
            if room >= lengths[0]:
                best = fewest(lengths[1:], capacity, best, (*bins[:i], room - lengths[0], *bins[i + 1:]))
        return fewest(lengths[1:], capacity, best, (*bins, capacity - lengths[0]))

    rng = random.Random(2)
    for _ in range(150):
        lengths = sorted((rng.randint(1, 20) for _ in range(rng.randint(1, 8))), reverse=True)
        bound = packing.lower_bound(np.array(lengths), 20)
        bins, offsets, rooms = packing.best_fit_decreasing(np.array(lengths), 20)
        assert -(-sum(lengths) // 20) <= bound <= fewest(lengths, 20) <= len(rooms)
    assert packing.lower_bound(np.array([11] * 5), 20) == 5
    assert packing.lower_bound(np.array([], int), 20) == 0


def check_packing(got, capacity):
    at = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at.get(r.sequence_id, 0)
        at[r.sequence_id] = r.offset + r.length
    assert max(at.values()) <= capacity
    return at


@pytest.mark.parametrize("per_partition", [7, 50_000])
def test_packing_over_rough_rows(spark, library, per_partition):
    got = packing.pack_documents(documents(spark), WORD, 256, 0, per_partition=per_partition).collect()
    used = check_packing(got, 256)
    wanted = []
    for doc_id, text in TEXTS:
        n = ids(library[WORD], text) + [0]
        wanted += [str((doc_id, p, s, len(n[s:s + 256]), zlib.crc32(packed(n[s:s + 256]))))
                   for p, s in enumerate(range(0, len(n), 256))]
    assert sorted(str(tuple(r)[:5]) for r in got) == sorted(wanted)
    least = packing.lower_bound(np.array([r.length for r in got]), 256)
    assert len(used) <= (least + 1 if per_partition > 7 else least * 1.05 + 2)
    assert packing.pack_documents(nothing(spark), WORD).count() == 0
