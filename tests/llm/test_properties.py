"""Round trips and invariants over arbitrary inputs."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as s

from staygrid.llm import chat, huffman, media, packing, simhash, substrings
from staygrid.llm.components import merge_labels


@given(s.text())
def test_escape_is_reversible(text):
    assert chat.unescape(chat.escape(text)) == text
    assert "</turn>" not in chat.escape(text)


@given(s.binary(max_size=300))
def test_waves_are_valid_and_lossless(payload):
    blob = media.wave(payload)
    assert media.sniff(blob, media.automaton())[0] == (0, len(blob), "audio/wav") and media.samples(blob) == payload


@given(s.lists(s.integers(0, 300), min_size=1, max_size=400))
def test_huffman_blocks(ids):
    ids = np.array(ids)
    code = huffman.Code(huffman.code_lengths(np.bincount(ids)))
    head = huffman.pack_head([7], [len(ids)])
    assert (huffman.unpack_block(code, huffman.pack_block(code, 1, head, ids))[2] == ids).all()


@settings(deadline=None, max_examples=30)
@given(s.dictionaries(s.integers(1, 64), s.integers(1, 9), max_size=20))
def test_packing_uses_every_piece_once(histogram):
    used: dict[int, int] = {}
    for pattern, times in packing.solve(histogram, 64):
        assert sum(pattern) <= 64
        for x in pattern:
            used[x] = used.get(x, 0) + times
    assert used == histogram


@given(s.lists(s.sampled_from("ab"), max_size=140), s.integers(0, 60))
def test_super_kmers_cover_each_window_once(words, extra):
    words = [*words, *(f"w{i}" for i in range(extra))]
    found = substrings.SuperKmers(" ".join(words))
    windows = [w for k in range(len(found.first)) for w in substrings.windows(found.packed(k))]
    assert windows == [" ".join(words[i : i + 50]).encode() for i in range(len(words) - 49)]


@settings(deadline=None, max_examples=40)
@given(s.sets(s.integers(0, 2**64 - 1) | s.integers(0, 300), max_size=40), s.integers(0, 3))
def test_trie_walk_finds_every_pair(values, budget):
    a = np.array(sorted(values), np.uint64)
    pairs = {(int(x), int(y)) for i, j in simhash.walk(a, a, True, 0, budget) for x, y in zip(i, j, strict=True)}
    assert pairs == {(i, j) for j in range(len(a)) for i in range(j) if int(a[i] ^ a[j]).bit_count() <= budget}


@given(s.lists(s.tuples(s.integers(0, 20), s.integers(0, 20)), max_size=40))
def test_labels_are_smallest_members(links):
    u, v = (np.array([x[k] for x in links], np.int64) for k in (0, 1))
    labels = merge_labels(np.arange(21), u, v)
    groups = {i: {i} for i in range(21)}
    for a, b in links:
        if groups[a] is not groups[b]:
            groups[a] |= groups[b]
            for x in groups[b]:
                groups[x] = groups[a]
    assert labels.tolist() == [min(groups[i]) for i in range(21)]
