"""What a Python worker keeps: workers outlive tasks, and one serves every stage of the pipeline in turn."""

import gc
import random
import tracemalloc

import public_tokenizers

from crivo.llm import bpe, near


def traced(module) -> float:
    """MB that this module has allocated and still holds."""
    gc.collect()
    shot = tracemalloc.take_snapshot().filter_traces([tracemalloc.Filter(True, module.__file__)])
    return sum(s.size for s in shot.statistics("filename")) / 1e6


def test_stages_do_not_add_up_in_a_worker():
    model = bpe.model_bytes(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    rng = random.Random(31)
    text = " ".join(f"{rng.getrandbits(40):x}" for _ in range(400_000))
    tracemalloc.start()
    try:
        first = near.shingles(text)
        assert traced(near) < 32  # the words' cache and the result of 3 MB
        ids = bpe.codec(model, public_tokenizers.PATTERN).encode("two words")
        del first
        assert traced(near) < 1
        again = near.shingles(text[:100])
        assert traced(bpe) < 1
    finally:
        tracemalloc.stop()
    assert ids == bpe.codec(model, public_tokenizers.PATTERN).encode("two words")
    assert again.tolist() == near.shingles(text[:100]).tolist()
