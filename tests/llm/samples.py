"""Small document tables with every odd case, and plain-Python helpers."""

from __future__ import annotations

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, _id string, _sha int, size double, node string, key string"
SYLLABLES = ("ta", "ren", "mo", "lis", "ka", "ver", "don", "shi", "el", "pu")


def sentence(rng: random.Random, words: int) -> str:
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(words))


def rows(seed: int = 5, count: int = 40) -> list[tuple]:
    """Random texts, and among them nulls, empty, blank, tiny and very long texts, copies, case variants, near copies,
    repeated rows, a null id and null sources."""
    rng = random.Random(seed)
    texts: list[str | None] = [sentence(rng, rng.randint(5, 90)) for _ in range(count)]
    base = sentence(rng, 120).split()
    for i in range(6):
        changed = list(base)
        changed[10 * i] = "changed"
        texts.append(" ".join(changed))
    texts += [None, "", " \n\t ", "one", "One", "two words", "Ünïcode ÉTÉ 日本語 🙂", "ünïcode ÉTÉ 日本語 🙂"]
    texts += [texts[0], texts[0].upper(), texts[0], sentence(rng, 30_000), "x" * 50_000]
    out = [(i, t, "en", (None, "a", "b", "c")[i % 4], len(t or ""), "e", 1, 2.0, "n", "k") for i, t in enumerate(texts)]
    out += [out[3], out[3]]
    out.append((None, "without an id", "en", "a", 13, None, None, None, None, None))
    return out


def frame(spark, data: list[tuple] | None = None, parts: int = 3):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA).repartition(parts)


def lowered(text: str | None) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def same_rows(a, b) -> bool:
    return sorted(map(repr, a)) == sorted(map(repr, b))
