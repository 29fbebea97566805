"""Hard negatives, token counts and cross-tokenizer alignment against brute force."""

import collections
import hashlib
import math
import random

import numpy as np
import pytest
import sentencepiece
from llm_rows import SCHEMA, docs, empty, rows, texts  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cohortspark.llm import align, hard_negatives, queries, token_counts
from cohortspark.llm.textnp import text_chunks

VECTORS = "vec_id long, embedding array<float>, label int, row int, q string, slot int, anchor string"


# --- hard negatives --------------------------------------------------------------------------

def vector_rows():
    rng = random.Random(11)
    out = []
    for i in range(420):
        v = [rng.gauss(0.1 * (i % 3), 0.2) for _ in range(20)]
        out.append((i, v, rng.choice([1, 1, 1, 2, 3])))
    hot = [rng.gauss(0, 0.3) for _ in range(20)]
    out += [(500 + i, hot, i % 4) for i in range(150)]  # ties
    out += [(700, None, 1), (750, [0.1, None], 1), (800, [float("nan")] * 3, 2), (850, [float("inf")], 2), (900, [0.5] * 20, None),
            (950, [], 1), (1000, [0.3] * 7, 1), (1050, [0.25] * 33, 2), (None, hot, 2), (None, [0.2] * 20, 1)]
    return out + [out[50], out[50], out[100]]


def brute_negatives(vectors):
    kept = []
    for vec_id, v, label in vectors:
        if v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((vec_id, [math.floor(256 * float(np.float32(x))) for x in v], label))
    order = lambda s: (-s[0], s[1] is None, s[1] or 0, s[2])
    out = collections.Counter()
    for a, (anchor, va, la) in enumerate(kept):
        if anchor is None or anchor % 50:
            continue
        scored = [(sum(x * y for x, y in zip(va, vb)), vec_id, b) for b, (vec_id, vb, _) in enumerate(kept) if b != a]
        near = sorted((s for s in scored if kept[s[2]][2] == la), key=order)[:5]
        for p, pid, _ in near:
            far = sorted((s for s in scored if kept[s[2]][2] != la and 50 * p <= 100 * s[0] <= 95 * p), key=order)[:3]
            out.update((anchor, pid, k + 1, nid, p, n) for k, (n, nid, _) in enumerate(far))
    return out


def mined(spark, vectors, **kw):
    frame = spark.createDataFrame([(*r, 0, "q", 1, "x") for r in vectors], VECTORS).repartition(3)
    got = hard_negatives.mine(frame, **kw).collect()
    return collections.Counter((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in got)


def test_hard_negatives(spark):
    want = brute_negatives(vector_rows())
    assert len(want) > 50
    assert mined(spark, vector_rows()) == want


def test_hard_negatives_in_small_cells_and_tiles(spark, monkeypatch):
    for name, value in {"ANCHOR_BLOCK": 4, "ROW_BLOCK": 90, "LEAST_ROWS": 30}.items():
        monkeypatch.setattr(hard_negatives, name, value)
    assert mined(spark, vector_rows()) == brute_negatives(vector_rows())


def test_hard_negatives_of_large_components(spark):
    vectors = [(i, [1e5 * (i % 7 + 1), 3e4 * (i % 5), float(i)], i % 2) for i in range(0, 300, 3)]
    assert mined(spark, vectors) == brute_negatives(vectors)
    got = mined(spark, [(0, [1e30], 1), (1, [1e30], 1), (2, [9e29], 2)])
    assert all(abs(p) <= hard_negatives.MOST for _, _, _, _, p, _ in got)


def test_hard_negatives_of_nothing(spark):
    assert not mined(spark, []) and not mined(spark, [(50, [0.1], 1)]) and not mined(spark, [(1, [0.1], 1), (2, [0.1], 1)])


def test_segment_bounds_hold_and_get_tighter():
    rng = np.random.default_rng(3)
    q = rng.integers(-300, 300, (60, 128))
    q[::2] += 200
    mean, dev = hard_negatives.summaries(q)
    v = hard_negatives.Vectors(np.arange(60), np.arange(60), np.zeros(60), q, mean, dev)
    exact, last = hard_negatives.exact_scores(v, v), np.inf
    for width in hard_negatives.LEVELS:
        m, d = v.levels[width]
        off = np.abs(exact - width * (m @ m.T))
        reach = d @ d.T
        assert (off <= reach * (1 + 1e-9) + 1e-6).all()
        assert (reach <= last + 1e-6).all()
        last = reach
    # rows far below the floor are ruled out before exact scoring, those that reach it are not
    q = np.repeat(rng.integers(-300, 300, (60, 32)), 4, axis=1) + rng.integers(-9, 9, (60, 128))
    v = hard_negatives.Vectors(np.arange(60), np.arange(60), np.zeros(60), q, *hard_negatives.summaries(q))
    exact = hard_negatives.exact_scores(v, v)[:4]
    low = np.partition(exact, -3, axis=1)[:, -3]
    _, left = hard_negatives.alive_pairs(v.part(slice(0, 4)), v, np.ones((4, 60), bool), low, np.full(4, hard_negatives.MOST))
    assert set(np.flatnonzero((exact >= low[:, None]).any(axis=0))) <= set(left) and len(left) < 30


# --- token counts ----------------------------------------------------------------------------

def odd_texts():
    rng = random.Random(12)
    parts = ["a", "the", "Hello", " ", "  ", "\n", "\n\n", "\t", "\r\n", "\r", "\x0b", "\x0c", "\x1c", "\x85", " ", " ", "　", "'s", "'LL", "'", "12", "3",
             "½", "漢字", "é", "é", "😀", "͸", "ꟊ", "𞤀", "<|endoftext|>", "<|end", "|>", "</s>", "<0x41>", "<unk>", "▁", "_", "--", "\x00", "﻿", "‍", "ß", "İ"]
    return ["".join(rng.choices(parts, k=rng.randint(1, 40))) for _ in range(400)]


@pytest.fixture(scope="module")
def many(spark):
    extra = [(1000 + i, t, "en", "a", 1, True, 0, "h", "s") for i, t in enumerate(odd_texts())]
    return spark.createDataFrame(rows() + extra, SCHEMA).repartition(3)


def test_token_counts(spark, many, empty, monkeypatch):  # noqa: F811
    path = queries.tokenizer_path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    want = collections.Counter()
    for r in many.collect():
        n = len(library.encode(r.text or "", add_special_tokens=False).ids)
        want[(r.doc_id, len((r.text or "").encode()), n, n > 1024)] += 1
    got = collections.Counter(tuple(r) for r in token_counts.count_tokens(many, path).collect())
    assert got == want
    assert token_counts.count_tokens(empty, path).count() == 0


def test_whole_tokens_are_proven_and_used(monkeypatch):
    path = queries.tokenizer_path("byte_bpe_50k.json")
    whole = token_counts.prove(path)
    library = Tokenizer.from_file(path)
    assert len(whole) > 45_000 and all(len(library.encode(t).ids) == 1 for t in sorted(whole)[::500])
    counter = token_counts.TokenCounter(path, whole, limit=50)
    merged = []
    real = counter._merge
    monkeypatch.setattr(counter, "_merge", lambda texts: (merged.extend(texts), real(texts))[1])
    import pyarrow as pa
    sample = [t for t in texts() if t] + odd_texts()
    for part in (sample[:100], sample[100:], sample[:50]):  # the table starts afresh in between
        for lo, hi, data, offs in text_chunks(pa.array(part)):
            assert counter(data, offs).tolist() == [len(library.encode(t, add_special_tokens=False).ids) for t in part[lo:hi]]
    assert merged and not whole.intersection(merged)


# --- alignment -------------------------------------------------------------------------------

def brute_alignment(frame_rows):
    a_lib = Tokenizer.from_file(queries.tokenizer_path("byte_bpe_50k.json"))
    a_lib.encode_special_tokens = True
    b_lib = sentencepiece.SentencePieceProcessor(model_file=queries.tokenizer_path("piece_bpe_32k.model"))
    byte_of = token_counts.byte_strings(a_lib.get_vocab())
    docs_, held = [], collections.Counter()
    for r in frame_rows:
        text, a, b = r.text or "", [], []
        if text:
            a = [(i, byte_of[i]) for i in a_lib.encode(" " + text, add_special_tokens=False).ids]
            for i in b_lib.encode(text):
                p = b_lib.id_to_piece(i)
                b.append((i, bytes([int(p[3:5], 16)]) if b_lib.is_byte(i) else p.replace("▁", " ").encode()))
            raw = (" " + text).encode()
            if b"".join(x for _, x in a) != raw or b"".join(x for _, x in b) != raw:
                a, b = [], []
        spans = []
        for side in (a, b):
            at, out = 0, []
            for i, x in side:
                out.append((i, at, at + len(x)))
                at += len(x)
            spans.append(out)
        a, b = spans
        links, j = [], 0
        for i, lo, hi in a:
            while j < len(b) and b[j][2] <= lo:
                j += 1
            k = j
            while k < len(b) and b[k][1] < hi:
                links.append((i, b[k][0]))
                k += 1
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups, lo = [], 0
        for c in cuts:
            groups.append(",".join(str(i) for i, s, e in a if lo < e <= c) + "|" + ",".join(str(i) for i, s, e in b if lo < e <= c))
            lo = c
        docs_.append((r.doc_id, len(a), len(b), len(groups), links, ";".join(groups)))
        held.update(set(links))
    best = collections.Counter()
    for (i, _), n in held.items():
        best[i] = max(best[i], n)
    return collections.Counter((d, na, nb, g, len(links), sum(held[x] == best[x[0]] for x in links), sum(held[x] for x in links), text)
                               for d, na, nb, g, links, text in docs_)


def test_alignment(spark, many, empty, monkeypatch):  # noqa: F811
    a, b = queries.tokenizer_path("byte_bpe_50k.json"), queries.tokenizer_path("piece_bpe_32k.model")
    small = many.where("length(text) < 30000 or text is null")
    want = brute_alignment(small.collect())
    aligned = align.align(small, a, b)
    counts = align.pair_counts(aligned, align.vocabulary_size(b))
    got = align.score_links(aligned, counts).collect()
    columns = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
    assert collections.Counter(tuple(r[c] for c in columns) for r in got) == want
    assert sum(1 for w in want if w[1] == 0) > 5 and sum(1 for w in want if w[3] < w[1]) > 50
    digest = {(r.doc_id, r.groups) for r in align.score_links(aligned, counts, F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))).collect()}
    assert digest == {(w[0], hashlib.sha256(w[7].encode()).hexdigest() if w[7] else "") for w in want}
    none = align.align(empty, a, b)
    assert align.score_links(none, align.pair_counts(none, align.vocabulary_size(b))).count() == 0


def test_lockstep_with_many_lanes(monkeypatch):
    monkeypatch.setattr(align, "LANE", 7)
    rng = np.random.default_rng(5)
    size = 5000
    a, b = (np.append(np.sort(rng.choice(size - 1, 2000, replace=False)) + 1, size) for _ in range(2))
    link_a, link_b, cut = align.lockstep(a, b)
    want, i, j = [], 0, 0
    while i < len(a):
        want.append((i, j, a[i] == b[j]))
        i, j = i + (a[i] <= b[j]), j + (b[j] <= a[i])
    assert list(zip(link_a, link_b, cut)) == want
