"""Repeated strings, spelling variants and the Merkle manifest against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from crivo.llm import merkle, repeats, spelling
from crivo.llm.base import normalised
from tests.llm import samples


@pytest.fixture(scope="module")
def docs(spark):
    return samples.frame(spark)


@pytest.fixture(scope="module")
def nothing(spark):
    return samples.frame(spark, [])


def in_order(data):
    """Rows by id, null first."""
    return sorted(data, key=lambda r: (r[0] is not None, r[0] or 0))


# === repeated strings ===================================================================================


def plain_repeats(data, length=100):
    """(n_bytes, removed, kept) by id, for unique ids."""
    seen, out = set(), {}
    for r in in_order(data):
        text = (r[1] or "").encode()
        gone = np.zeros(len(text), bool)
        for i in range(len(text) - length + 1):
            string = text[i : i + length]
            if string in seen:
                gone[i : i + length] = True
            seen.add(string)
        out[r[0]] = (len(text), bytes(b for b, g in zip(text, gone) if not g))
    return out


def passages(copies: int, seed: int = 3) -> list[tuple]:
    """Texts around one passage that all share, with different neighbours, and the other odd texts."""
    rng = random.Random(seed)
    shared = samples.sentence(rng, 60)
    texts = [f"{samples.sentence(rng, 8)} {shared} {samples.sentence(rng, 8)}" for _ in range(copies)]
    texts += [t for _, t, *_ in samples.rows(seed, 12)[:-3] if len(t or "") < 3000]
    texts += ["ab" * 400, "ba" * 300, "x" * 99, "x" * 100, "x" * 101, "é" * 120, shared, shared[1:], f"{shared} {shared}"]
    rng.shuffle(texts)
    return [(i, t, "", "", 0, "", 0, 0.0, "", "") for i, t in enumerate(texts)]


@pytest.mark.parametrize("copies, wide", [(12, 2048), (12, 3), (160, 2048), (160, 5)])
def test_repeats(spark, monkeypatch, copies, wide):
    monkeypatch.setattr(repeats, "WIDE", wide)
    data = passages(copies)
    found = repeats.without_repeats(samples.frame(spark, data, 2)).collect()
    wanted = plain_repeats(data)
    assert {r.doc_id: (r.n_bytes, bytes(r.kept)) for r in found} == wanted
    for r in found:
        assert sum(s.end - s.begin for s in r.spans) == r.n_bytes - len(r.kept)
        assert all(a.end < b.begin for a, b in zip(r.spans, r.spans[1:]))


def test_repeats_of_odd_rows(spark, docs, nothing):
    found = repeats.without_repeats(docs).collect()
    assert len(found) == docs.count()
    by_id = {}
    for r in found:
        by_id.setdefault(r.doc_id, []).append((r.n_bytes, bytes(r.kept)))
    assert all(len(set(v)) == 1 for v in by_id.values())  # repeated rows are one document
    wanted = plain_repeats({r[0]: r for r in samples.rows()}.values())
    assert {k: v[0] for k, v in by_id.items()} == wanted
    assert repeats.without_repeats(nothing).count() == 0
    # Of texts that share an id the one with the smaller hash comes first.
    two = [(1, samples.sentence(random.Random(1), 80), *[None] * 8), (2, "", *[None] * 8)]
    two += [(1, two[0][1] + " and more", *[None] * 8)]
    found = repeats.without_repeats(samples.frame(spark, two)).where("doc_id = 1").collect()
    assert sorted(len(r.spans) for r in found) == [0, 1]


def test_index():
    rng = random.Random(1)
    for _ in range(8):
        base = [bytes(rng.choice(b"abc ") for _ in range(rng.randint(100, 180))) for _ in range(4)]
        spans = []
        for _ in range(30):
            text = bytearray(rng.choice(base))
            if rng.random() < 0.7:
                text[rng.randrange(len(text))] = ord("Z")
            at = rng.randint(0, len(text) - 100)
            spans.append(bytes(text[at : at + 163]))
        counts = np.array([len(s) - 99 for s in spans])
        marks, seen = repeats.repeated_strings(spans, counts, 100), set()
        for mark, span, count in zip(marks, spans, counts):
            for i in range(count):
                assert bool(int(mark) >> i & 1) == (span[i : i + 100] in seen)
                seen.add(span[i : i + 100])
        index = repeats.RunIndex(np.frombuffer(b"\1".join(spans), np.uint8).astype(np.int64))
        assert index.lengths.sum() == index.size and len(index.at) == len(index.symbols) < index.size


# === spelling ===========================================================================================


def plain_words(data):
    counts = Counter()
    for r in data:
        for run in re.findall("[A-Za-zÀ-ÿ]+", r[1] or ""):
            run = samples.lowered(run)
            h = zlib.crc32(f"{r[0]}:{run}".encode())
            if r[0] is not None and h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(data):
    words = plain_words(data)
    near = {w: [v for v in words if abs(len(v) - len(w)) < 2 and one_apart(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {w: (n, len(near[w]), form[w], words.get(form[w]), root(w)) for w, n in words.items()}


def variants_of(df):
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in spelling.variants(df).collect()}


def test_variants(spark, docs, nothing):
    rng = random.Random(9)
    stems = ["separate", "éclaircie", "Straße", "banana", "aaaaaaa", "zzzzz", "x" * 3000]
    data = []
    for i in range(60):
        out = []
        for stem in stems:
            for _ in range(rng.randint(1, 6)):
                word = list(stem)
                if rng.random() < 0.5:
                    at = rng.randrange(len(word))
                    word[at : at + rng.randint(0, 1)] = rng.choice(["", "q", "é", "a"])
                out.append("".join(word).upper() if rng.random() < 0.2 and word[0] < "z" else "".join(word))
        data.append((i, " ".join(out), "", "", 0, "", 0, 0.0, "", ""))
    data += [data[4], data[4], (None, data[5][1], *[None] * 8), (99, None, *[None] * 8), (98, "", *[None] * 8)]
    wanted = plain_variants(data)
    assert sum(v[2] is not None for v in wanted.values()) > 20
    frame = samples.frame(spark, data)
    assert variants_of(frame) == wanted
    assert variants_of(docs) == plain_variants(samples.rows())
    assert spelling.variants(nothing).count() == 0


def test_pieces_of_a_block(spark, monkeypatch):
    monkeypatch.setattr(spelling, "BLOCK", 8)  # blocks above it are cut into pieces
    words = ["".join(p) for p in product("abc", repeat=5)]
    vocab = spark.createDataFrame([(w, 3) for w in words], "word string, n bigint")
    found = sorted((r.word, r.near) for r in spelling.near_words(vocab).collect())
    assert found == sorted((a, b) for a in words for b in words if one_apart(a, b))


def test_chains_of_forms(spark):
    forms = [(f"w{i}", f"w{i + 1}") for i in range(11)] + [("v", "w3")]
    found = {r.word: r.root for r in spelling.roots_of(spark.createDataFrame(forms, "word string, form string")).collect()}
    assert found == {a: "w11" for a, _ in forms}


# === manifest ===========================================================================================


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_tree(leaves):
    """(root, proofs) of a list of digests."""
    nodes, proofs, place = list(leaves), [[] for _ in leaves], list(range(len(leaves)))
    while len(nodes) > 1:
        for i, p in enumerate(place):
            run = nodes[p // 8 * 8 : p // 8 * 8 + 8]
            proofs[i].append((run[: p % 8], run[p % 8 + 1 :]))
            place[i] = p // 8
        nodes = [digest(*nodes[i : i + 8]) for i in range(0, len(nodes), 8)]
    return (nodes or [None])[0], proofs


def plain_manifest(data):
    def field(x):
        return "-" if x is None else f"{len(str(x).encode())}:{x}"

    leaves = [(r[2], r[0], digest(*[field(x) for x in (r[0], r[3], r[2], r[4], r[1])]), r) for r in data]
    key = lambda x: ((x[0] is not None, (x[0] or "").encode()), (x[1] is not None, x[1] or 0), x[2])
    trees = {}
    for leaf in sorted(leaves, key=key):
        trees.setdefault(leaf[0], []).append(leaf)
    built = {t: plain_tree([x[2] for x in rows]) for t, rows in trees.items()}
    root, upper = plain_tree([built[t][0] for t in trees])
    out = []
    for t, rest in zip(trees, upper):
        for (_, id, leaf, row), path in zip(trees[t], built[t][1]):
            seen, text = leaf, row[1]
            if id is not None and zlib.crc32(str(id).encode()) % 3 == 0:
                seen = digest(*[field(x) for x in (row[0], row[3], row[2], row[4], None if text is None else samples.lowered(text))])
            whole = path + rest
            proof = digest(*[s for left, right in whole for s in left + right])
            for left, right in whole:
                seen = digest(*left, seen, *right)
            out.append((id, leaf, built[t][0], root, proof, seen, seen == root))
    return out


def manifest_of(df):
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    now = {"text": F.when(tampered, normalised(F.col("text"))).otherwise(F.col("text"))}
    return [tuple(r) for r in merkle.manifest(df, now).collect()]


def test_manifest(spark, docs, nothing):
    data = samples.rows()
    data = [(*r[:2], (None, "de", "en", "é")[len(r[1] or "") % 4 if i > 9 else 1], *r[3:]) for i, r in enumerate(data)]
    assert samples.same_rows(manifest_of(samples.frame(spark, data)), plain_manifest(data))
    assert samples.same_rows(manifest_of(samples.frame(spark, data[:1])), plain_manifest(data[:1]))
    assert samples.same_rows(manifest_of(docs), plain_manifest(samples.rows()))
    assert manifest_of(nothing) == []


def test_rounds_of_a_large_tree(spark):
    # Trees that need two rounds, one round, one level and none.
    data = [(i, f"t{i}", ("a" if i < 4200 else "b" if i < 4270 else "c" if i < 4278 else "d"), None, i, *[None] * 5) for i in range(4279)]
    frame = samples.frame(spark, data)
    assert samples.same_rows(manifest_of(frame), plain_manifest(data))
    root = manifest_of(frame)[0][3]
    for r in merkle.proofs(frame).orderBy("doc_id").limit(20).collect():
        assert merkle.fold(r.leaf, merkle.read_path(r.path)) == root
