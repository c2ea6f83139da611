"""Ids of whole texts against the tokenizers library."""

from __future__ import annotations

import random
import struct

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from crivo.llm import planes, words

DESCRIBED = planes.read_tokenizer(public_tokenizers.path("word_bpe_49k.json"))
LATIN = [chr(c) for c in range(0x180)]
#: White space of several kinds, separators that are none, letters whose case or marks are special, other scripts.
ODD = list("\x1c\x1f\x85\xa0\n\r\t\x0b \x00\x7f'''sStTrReEdDİıŸſßªºµ²½×÷hHjJ̱́̇’ 　日本ΑΣςȺKÅفﬁ🙂")


def odd_texts() -> list[str]:
    rng = random.Random(1)
    texts = [a + b + c for a in "aH'" for b in LATIN for c in ("̱", "b", " ", "'s!")]
    for _ in range(3000):
        pool = rng.choice([LATIN, ODD, LATIN[32:127] + ODD, LATIN[32:127]])
        texts.append("".join(rng.choice(pool) for _ in range(rng.randint(0, 30))))
    texts += ["", "a <|endoftext|> b", "<|ENDOFTEXT|>É", "<|endoftext|", "Ab É’ " * 400, "Ab É " * 400, "x" * 3000]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("remembered, at_once", [(300_000, 100_000), (50, 20), (2000, 300)])
def test_ids_of_odd_texts(monkeypatch, remembered, at_once):
    monkeypatch.setattr(words, "REMEMBERED", remembered)
    monkeypatch.setattr(words, "AT_ONCE", at_once)
    monkeypatch.setattr(words, "_ENCODERS", {})
    texts = odd_texts()
    plain = Tokenizer.from_str(DESCRIBED).encode_batch_fast(texts, add_special_tokens=False)
    found = list(words.encoded(iter(texts), DESCRIBED))
    assert len(found) == len(texts)
    for text, ids, wanted in zip(texts, found, plain):
        assert ids == struct.pack(f"<{len(wanted.ids)}I", *wanted.ids), text


class Counting:
    """Counts the pieces that the model is asked for."""

    def __init__(self, model):
        self.model, self.asked = model, []

    def tokenize(self, piece):
        self.asked.append(piece)
        return self.model.tokenize(piece)


def test_distinct_pieces_are_encoded_once(monkeypatch):
    """Words with accents, too, in whatever case and beside whatever mark, cost one call of the model."""
    monkeypatch.setattr(words, "_ENCODERS", {})
    encoder = words.encoder(DESCRIBED)
    encoder.whole, encoder.model = None, Counting(encoder.model)
    list(words.encoded(iter(["Été été, ÉTÉ. été", "word Word, (WORD)", "été(word)", None]), DESCRIBED))
    assert len(encoder.model.asked) == len(set(encoder.model.asked)) == 6  # été , . word ( )
