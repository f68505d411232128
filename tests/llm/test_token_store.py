"""The encoder's store of parts: equal to the library over many batches, and known parts are not encoded again."""

import random

import numpy as np
import pytest

from nimbria.llm import tokenfile
from tests.llm.test_operators import tokenizer

PIECES = [*"ab1.,;:!?'-\n\t\r\x1c\x85é_<|> 日", " ", " ", " the", " word.", " it's", " x\ny", "Straße", "é.", " ²", "a..", " .", "<|endoftext|>"]


@pytest.mark.parametrize("most", [5, 50, 600_000])
def test_batches_equal_library(most):
    draw, e = random.Random(most), tokenfile.Encoder(tokenizer("byte_bpe_50k.json"), most=most)
    for turn in range(20):
        texts = ["".join(draw.choice(PIECES) for _ in range(draw.randrange(60))) for _ in range(30)]
        if turn % 2:  # no part begins with white space: the way without gluing
            texts = [" ".join(t.split()) for t in texts]
        for text, ids in zip(texts, e.encode_batch(texts), strict=True):
            assert np.frombuffer(ids, np.uint32).tolist() == e.tokenizer.encode(text, add_special_tokens=False).ids, repr(text)
        assert len(e.words) == len(e.start) == len(e.length) and e.length.sum() <= len(e.ids)


def test_known_words_are_not_encoded_again():
    e = tokenfile.Encoder(tokenizer("byte_bpe_50k.json"))
    seen, ids = [], e._ids
    e._ids = lambda text: seen.append(text) or ids(text)
    first, second = e.encode_batch(["so many words, and such\nagain 12 times.", "so many, many"]), e.encode_batch(["so many words and many words,"])
    assert sum(text.count("many") for text in seen) == sum(text.count("words") for text in seen) == 1  # whatever mark ends them
    assert [np.frombuffer(b, np.uint32).tolist() for b in [*first, *second]] == [e.tokenizer.encode(t, add_special_tokens=False).ids for t in ["so many words, and such\nagain 12 times.", "so many, many", "so many words and many words,"]]
