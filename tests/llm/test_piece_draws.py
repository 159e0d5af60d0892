"""Draws of number 2: edges are found from their node, not by a search of the whole cache."""

import numpy as np

import public_tokenizers
from trolley.llm import pieces


def test_draws_start_at_the_first_edge_of_a_node():
    coder = pieces.Model(public_tokenizers.path("piece_bpe_32k.model"), 1.0)
    texts = ["some words, and others: words", "中文 \U0001F600 x\ud800", "", "a"]
    for _ in range(2):  # the second time from the cache
        found = coder.sample(texts, pieces.row_keys([1, 2, None, 4], 13))
        assert [coder.decode(p) for p in found] == texts
    first = np.append(coder.first, len(coder.reach))
    assert len(coder.first) == coder.nodes and first[0] == 0 and (np.diff(first) > 0).all()
    assert (coder.reach[first[1:] - 1] == 1).all() and coder.reach.max() == 1


def test_spelled_characters_keep_the_bounds_of_texts():
    coder = pieces.Model(public_tokenizers.path("piece_bpe_32k.model"), 1.0)
    coder.spelled = [[7, 8], [9]]
    done, bounds = coder._spell(np.array([1, -1, 2, -2, -1]), np.array([0, 2, 2, 5]))
    assert done.tolist() == [1, 7, 8, 2, 9, 7, 8] and bounds.tolist() == [0, 3, 3, 7]
