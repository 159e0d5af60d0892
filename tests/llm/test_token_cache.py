"""Words of number 7: a batch without new words never walks the words met before."""

import numpy as np

import public_tokenizers
from trolley.llm import token_files


class Unwalked(dict):
    def __iter__(self):
        raise AssertionError("all words met before were walked")


def test_a_batch_does_not_walk_the_older_words():
    coder = token_files.Encoder(public_tokenizers.path("byte_bpe_50k.json"), "<u2")
    texts = ["one two, three\nfour ", "", "five  six", "two two three) <|endoftext|>", " seven", "\n"]
    whole = [np.array(coder.tokenizer.encode(t, add_special_tokens=False).ids, "<u2").tobytes() for t in texts]
    assert coder.encode(texts) == whole
    coder.recent, coder.older = {}, Unwalked(coder.recent)
    assert coder.encode(texts[::-1]) == whole[::-1]
    assert "two," in coder.recent and "two," in coder.older
    assert coder.encode(["new, words", *texts]) == [
        np.array(coder.tokenizer.encode("new, words", add_special_tokens=False).ids, "<u2").tobytes(), *whole
    ]
