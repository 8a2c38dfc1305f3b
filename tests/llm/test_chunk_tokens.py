"""op5: ids of texts from ids of their chunks."""

import random

import pytest

from gondola.llm.packing import ChunkTokens
from gondola.llm.queries import tokenizer_path

ODD = ["", " ", "\n\t\r", "Ünï ünï, ÜNÏ! Foo foo FOO, foo.", "a b c", "İI ıi ́e é", "x1 1x #x## (paren) don't", "日本 語, ñ Ñ;"]


@pytest.mark.parametrize("most", [0, 40, 250_000])
def test_ids_are_those_of_the_whole_text(most):
    rng = random.Random(3)
    words = [w for t in ODD for w in t.split()] + ["".join(rng.choices("abcéñXY", k=rng.randrange(1, 9))) + rng.choice(["", ",", "...", "%"]) for _ in range(150)]
    texts = [*ODD, *(" ".join(rng.choices(words, k=30)) for _ in range(60))]
    tokens = ChunkTokens(tokenizer_path(), most)
    for first in range(0, len(texts), 7):
        some = texts[first : first + 7]
        for text, ids in zip(some, tokens(some), strict=True):
            assert ids.tolist() == tokens.tokenizer.encode(text, add_special_tokens=False).ids


def test_a_chunk_is_looked_for_once():
    """Known chunks cost one look, and a word that is written in several ways is cut once."""
    found, cut = [], []

    class Spy(ChunkTokens):
        def find(self, chunk):
            found.append(chunk)
            return super().find(chunk)

        def word(self, text):
            cut.append(text)
            return super().word(text)

    tokens = Spy(tokenizer_path(), 4)
    for _ in range(3):
        list(tokens(["zebra Zebra ZEBRA, zebra", "Zebra ZEBRA, Okapi okapi."]))
    assert found[:5] == ["zebra", "Zebra", "ZEBRA,", "Okapi", "okapi."] and cut == ["zebra", "okapi"]
    assert len(found) == 15  # more than ``most`` are known: older ones are looked for again, and not cut again
