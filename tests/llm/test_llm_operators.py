"""Corpus operators against brute force on rows with nulls, empty and long texts, ties, repeated
rows and clashing column names; every operator also runs on an empty table."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from llm_rows import docs, empty, rows, words  # noqa: F401

from cohortspark.llm import (brown_lm, chat, exact_dedup, license_scan, mixing, ngram_join, packing, pii, quality_rules,
                             queries, rule_ensemble)


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode()) if doc_id is not None else 0


def by_text(df):
    return collections.Counter(tuple(r) for r in df.collect())


def test_base_rules(docs, empty):
    def brute(text):
        w = words(text)
        seen = collections.Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
        hit = set()
        for i in range(len(w) - 7):
            if seen[tuple(w[i:i + 8])] > 1:
                hit.update(range(i, i + 8))
        lines = [x for x in (text or "").split("\n") if words(x)]
        failed = len(w) < 20 or 100 * len(hit) > 30 * len(w)
        return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit), failed)
    out = quality_rules.quality(docs)
    got = by_text(out.select("doc_id", *quality_rules.COUNTS, "base_failed"))
    assert got == collections.Counter((r[0], *brute(r[1])) for r in rows())
    assert out.where("base_failed and kept").count() == 0 and out.where("kept").count() > 10
    assert quality_rules.keep_good(docs).columns == docs.columns
    assert quality_rules.keep_good(docs).count() == out.where("kept").count()
    assert quality_rules.quality(empty).count() == 0 and quality_rules.keep_good(empty).count() == 0


def test_copies_do_not_move_the_band(spark):
    import random
    rng = random.Random(11)
    voc = [["".join(rng.choices(letters, k=rng.randint(2, 9))) for _ in range(400)] for letters in ("aeinrstdhu", "aeiouclmpq")]
    prose = [(i, " ".join(rng.choices(voc[i % 2], k=rng.randint(30, 120))), ("de", "en")[i % 2]) for i in range(200)]
    copies = [(1000 + i, prose[0][1], "de") for i in range(100)]
    spaced = [(2000 + i, prose[0][1] + " \n"[:i % 3], "de") for i in range(300)]
    near = [(3000 + i, f"{prose[0][1]} {voc[0][i]}", "de") for i in range(200)]
    frame = lambda r: spark.createDataFrame(r, "doc_id long, text string, lang string").repartition(3)
    own = {r.doc_id: r for r in quality_rules.quality(frame(prose)).collect()}
    assert all(r.kept for r in own.values())
    out = {r.doc_id: r for r in quality_rules.quality(frame(prose + copies)).collect()}  # a third of all rows
    for i, r in own.items():
        assert out[i].kept and (out[i].lower, out[i].upper) == (r.lower, r.upper)
        assert abs(out[i].log_ppl - r.log_ppl) < 1e-6
    assert quality_rules.keep_good(frame(prose + copies)).count() == len(prose + copies)
    for extra in (spaced, near):
        assert all(r.kept for r in quality_rules.quality(frame(prose + extra)).collect())


def test_kneser_ney_is_a_distribution():
    rng = np.random.default_rng(1)
    keys, counts = np.unique(rng.integers(0, 5, (3000, 3)) @ [4096, 64, 1], return_counts=True)
    model = quality_rules.Model(keys, counts)
    for context in (0, 65, 4 * 64 + 4, 7 * 64 + 3):
        assert abs((10 ** model.log10(context * 64 + np.arange(64))).sum() - 1) < 1e-6


def test_mix(docs, empty, spark):
    out = mixing.mix(docs).collect()
    assert sorted((r.doc_id is None, r.doc_id, r["size"]) for r in out) == \
        sorted((r[0] is None, r[0], len(words(r[1]))) for r in rows())
    sizes = collections.Counter()
    for r in rows():
        sizes[r[3]] += len(words(r[1]))
    names = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, open_ = {}, list(names)
    while True:  # reshare by weight until none is above three times its size
        left = sum(sizes.values()) - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = [s for s in open_ if share[s] > 3 * sizes[s]]
        if not full:
            break
        for s in full:
            target[s] = 3.0 * sizes[s]
            open_.remove(s)
    target.update(share)
    taken = collections.Counter()
    for r in out:
        assert r.source_size == sizes[r.source] and abs(r.target - target[r.source]) < 1e-6
        assert 0 <= r.taken <= 3 * r["size"]
        taken[r.source] += r.taken
    for s in names:
        assert abs(taken[s] - target[s]) <= max(2 * len(words(r[1])) for r in rows() if r[3] == s)
    again = mixing.mix(docs.repartition(5)).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))
    mixed = mixing.mixed_rows(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.times for r in out)
    assert mixing.mix(empty).count() == 0 and mixing.mixed_rows(empty).count() == 0


def test_brown_lm(docs, empty):
    tokens = [(r[0], words(r[1], lower=True) + [None]) for r in rows()]
    c = collections.Counter(t for i, ts in tokens if crc(i) % 10 for t in ts)
    n, v = sum(c.values()), len(c)
    brute = sorted((str(i), crc(i) % 10 == 0, len(ts), sum(c[t] > 0 for t in ts), n,
                    round(sum(math.log10((c[t] + .1) / (n + .1 * (v + 1))) for t in ts), 6)) for i, ts in tokens)
    out = brown_lm.score(docs).collect()
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out) == brute
    assert all(r.score < 0 for r in out)
    assert brown_lm.score(empty).count() == 0


def test_brown_lm_moves_codes_by_block(docs, capsys):
    """Blocks of any size give the same scores, and no text is shuffled (before, every pass did)."""
    got = [brown_lm.score(docs), brown_lm.score(docs.repartition(5), 40)]
    rounded = [collections.Counter((*r[:5], round(r[5], 6), round(r[6], 6)) for r in x.collect()) for x in got]
    assert rounded[0] == rounded[1]
    got[0].explain()
    plan = capsys.readouterr().out
    assert "Exchange" in plan and "text#" not in plan
    x = np.random.default_rng(1).integers(0, 1 << 30, 1000)
    assert (brown_lm.unpacked(brown_lm.packed(x), np.int64) == x).all() and len(brown_lm.unpacked(b"", np.uint8)) == 0


def test_exchange_recovers_alternating_classes():
    counts = np.zeros((9, 9))
    for a in range(4):  # items 0-3 are followed by 4-7 and the other way round
        for b in range(4, 8):
            counts[a, b] = counts[b, a] = 20 + a + b
    label = brown_lm.exchange(counts, classes=3)
    assert label[-1] == 2 and len(set(label[:4])) == 1 and len(set(label[4:8])) == 1 and label[0] != label[4]


def test_every_word_is_clustered_by_its_contexts(spark):
    """3,000 words of two kinds that alternate; nothing in their letters tells the kinds apart."""
    import random
    rng = random.Random(4)
    letters = lambda i: "".join("abcdefghij"[int(x)] for x in f"{i:04d}")
    numbers = rng.sample(range(10_000), 3000)
    kinds = [letters(i) for i in numbers[:1500]], [letters(i) for i in numbers[1500:]]
    rows = [(i, " ".join(rng.choice(kinds[k % 2]) for k in range(60))) for i in range(1000)]
    mixed = []
    for i in (x for x in range(10_000) if crc(x) % 10 == 0 and x >= 1000):
        text = [rng.choice(kinds[k % 2]) for k in range(60)]
        mixed += [(i, " ".join(text)), (i, " ".join(sorted(text)))]
        if len(mixed) == 60:
            break
    out = collections.defaultdict(list)
    for r in brown_lm.score(spark.createDataFrame(rows + mixed, "doc_id long, text string").repartition(3)).collect():
        if r.doc_id >= 1000:
            assert r.held_out and r.n_tokens == 61
            out[r.doc_id].append(r.score)
    gaps = [max(x) - min(x) for x in out.values()]
    assert len(gaps) == 30 and np.mean(gaps) > 15  # alternation is worth log10(2) a word, 18 in all


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base_spans(text):
    def luhn(d):
        return sum(int(x) if i % 2 == 0 else int(x) * 2 - 9 * (int(x) > 4) for i, x in enumerate(reversed(d))) % 10 == 0

    def ok(kind, m):
        d = re.sub("[^0-9]", "", m)
        return {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in m.split(".")),
                "card": lambda: 16 <= len(d) <= 19 and luhn(d), "phone": lambda: 8 <= len(d) <= 15}[kind]()
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if ok(k, m[0])]


def test_pii(spark, empty):
    import random
    rng = random.Random(3)
    parts = ["+4", "12", "345", "6789", "@", "a", "b.", "c", "-", " ", "(", ")", ".", "_", "😀", "00255", "256", "1.2.3.4",
             "4111111111111111", "4111 1111-1111 1111 ", "+49 (170) 123-4567", "x@y.z", "\n"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(300)]
    texts += ["7" * 20000, "1-" * 9000, "a@" + "b." * 9000 + "c", "a." * 9000, None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for r in pii.redact(df).collect():
        base = base_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(b.startswith(k) for b in base) for k in PATTERNS]
        assert set(base) <= set(r.spans.split(",")) | {""}
    assert pii.redact(empty).count() == 0


def test_many_matches_in_one_text(spark):
    """Positions and overlaps of 30,000 matches in one text."""
    one = "x7@ab.com, 😀 "
    df = spark.createDataFrame([(1, one * 30_000), (2, "call 555-123-4567 or " * 3000)], "doc_id long, text string")
    got = {r.doc_id: r for r in pii.redact(df).collect()}
    base = ",".join(f"email:{k * 13}:{k * 13 + 9}" for k in range(30_000))
    assert len(one) == 13 and got[1].n_email == 30_000
    assert got[1].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
    assert got[2].n_phone == 0


def test_spelled_out_items_are_found(spark):
    """Planted items that no base pattern finds, among decoys: recall and precision of the added spans."""
    rng = random.Random(17)
    word = lambda: "".join(rng.choices("abdeghilmnorstu", k=rng.randint(3, 8)))
    digits = lambda n: "".join(rng.choices("0123456789", k=n))
    part = lambda: str(rng.randint(1, 254))

    def card():
        body = "4" + digits(14)
        check = next(c for c in "0123456789" if sum(
            d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(map(int, reversed(body + c)))) % 10 == 0)
        return body + check

    base = [lambda: f"{word()}.{digits(2)}@{word()}.com", lambda: ".".join(part() for _ in range(4)), card,
            lambda: f"+{digits(2)} ({digits(3)}) {digits(3)}-{digits(4)}"]
    decoy = [lambda: f"{word()}@{word()}", lambda: f"{word()} [at] {word()}", lambda: "3." + ".".join(part() for _ in range(5)),
             lambda: ".".join(["300", part(), part(), "999"]), lambda: "1" + digits(15), lambda: f"20{digits(2)}-0{rng.randint(1, 9)}-1{rng.randint(0, 9)} 10",
             lambda: f"{digits(3)} {digits(3)}"]
    hidden = [("email", lambda: f"{word()}.{digits(2)} (at) {word()} (dot) com"), ("phone", lambda: f"({digits(3)}) {digits(3)}-{digits(4)}"),
              ("card", lambda: "/".join(c[i:i + 4] for c in [card()] for i in (0, 4, 8, 12)))]
    rows, planted = [], {}
    for i in range(900):
        text = " ".join(word() for _ in range(rng.randint(3, 12))) + " "
        if i % 3 == 0:
            text += rng.choice(base)()
        elif i % 3 == 1:
            text += rng.choice(decoy)()
        elif i % 2:
            kind, make = hidden[i // 6 % 3]
            item = make()
            planted[i] = f"{kind}:{len(text)}:{len(text) + len(item)}"
            text += item
        rows.append((i, text + " " + word()))
    found = pii.find(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    added = {r.doc_id: [f"{k}:{s.start}:{s.end}" for k in pii.KINDS for s in r[f"more_{k}"]] for r in found}
    hits = sum(planted[i] in added[i] for i in planted)
    assert hits >= 0.9 * len(planted), (hits, [(rows[i][1], planted[i], added[i]) for i in planted if planted[i] not in added[i]][:6])
    assert hits >= 0.9 * sum(map(len, added.values())), (hits, [(rows[i][1], a) for i, a in added.items() if a and i not in planted][:8])
    for r in found:  # added spans overlap neither base spans nor each other
        spans = sorted((s.start, s.end) for k in pii.KINDS for s in r[f"more_{k}"])
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
        assert not any(s.start < b.end and b.start < s.end for k in pii.KINDS for s in r[f"more_{k}"] for j in pii.KINDS for b in r[f"base_{j}"])


@pytest.mark.parametrize("size,percent", [(3, 90), (5, 80)])
def test_ngram_join(docs, empty, size, percent):
    sets = []
    for r in rows():
        w = words(r[1], lower=True)
        sets.append(frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1)) if len(w) >= size
                    else frozenset([tuple(w)]) if w else frozenset())
    group = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common) and group[a] != group[b]:
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    ids = [r[0] for r in rows()]
    name = {g: min((ids[k] for k in range(len(ids)) if group[k] == g and ids[k] is not None), default=None) for g in set(group)}
    brute = collections.Counter((ids[k], len(sets[k]), name[group[k]]) for k in range(len(ids)))
    out = ngram_join.jaccard_components(docs, size, percent)
    assert by_text(out.select("doc_id", "n_shingles", "component_id")) == brute
    left = ngram_join.drop_near_duplicates(docs, size, percent)
    assert left.columns == docs.columns and left.count() == len(set(group))
    assert ngram_join.jaccard_components(empty).count() == 0 and ngram_join.drop_near_duplicates(empty).count() == 0


def test_chat(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "### user: </turn>\n\\"), (1, 1, "assistant", ""), (2, None, None, None),
             (None, 0, "a:b", "x"), (None, 1, "assistant", "é😀 \\#"), *[(3, k, "assistant", f"t{k}" * 50) for k in range(3000)]]
    df = spark.createDataFrame([(*t, "extra") for t in turns], "conv_id long, turn long, role string, text string, formatted string")
    out = {r.conv_id: r for r in chat.digest(chat.format_conversations(df.repartition(4))).collect()}
    order = lambda t: (t[1] is not None, t[1] or 0, t[2] or "", t[3] or "")
    for conv in (1, 2, 3, None):
        own = sorted((t for t in turns if t[0] == conv), key=order)
        said = "".join(t[3] for t in own if t[2] == "assistant")
        r = out[conv]
        assert r.n_turns == len(own) and r.loss_chars == len(said)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{t[2] or ''}\n{t[3] or ''}\n" for t in own).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert chat.format_conversations(df.limit(0)).count() == 0


def test_license_scan(docs, empty):
    out = {r.doc_id: r for r in license_scan.best_license(docs).collect()}
    found = {i: (r.license, r.word) for i, r in out.items() if r.n_matches}
    ids = {r[1]: r[0] for r in rows()}
    assert found == {ids["This work is licensed under the GNU General Public License, version 3."]: ("GPL-3.0", 0),
                     ids["intro\nReleased under the MIT License!\nend"]: ("MIT", 1)}
    assert license_scan.best_license(empty).count() == 0


def dice(a, b):
    return 2 * len(a & b) / (len(a) + len(b)) if a or b else 0.0


def test_license_notices_wrapped_and_embedded(spark):
    """Every template is found whole, wrapped as a comment, and inside a paragraph with some words
    changed; the coefficient is that of the window, by sets."""
    import textwrap
    rng = random.Random(9)
    filler = "the of and to in ore thand erinth with without software under a copy this is license".split()
    planted = []
    for name, text in license_scan.TEMPLATES:
        wrapped = "\n".join(" * " + line for line in textwrap.wrap(text, 40))
        around = [" ".join(rng.choices(filler, k=60)) for _ in range(2)]
        words = text.split()
        if len(words) > 40:
            words[len(words) // 2] = "zzz"
        planted += [(name, text.upper()), (name, "/*\n" + wrapped + "\n */ int x;"), (name, f"{around[0]} {' '.join(words)} {around[1]}")]
    plain = [" ".join(rng.choices(filler, k=200)) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate([t for _, t in planted] + plain)), "doc_id long, text string").repartition(3)
    templates = {name: set(license_scan.template_bigrams(text)) for name, text in license_scan.TEMPLATES}
    lengths = {name: len(license_scan.template_places(text)) for name, text in license_scan.TEMPLATES}
    for r in license_scan.scan(df).collect():
        if r.doc_id >= len(planted):
            assert not r.matches
            continue
        name, text = planted[r.doc_id]
        assert name in {m.name for m in r.matches}, (r.doc_id, name)
        pairs = license_scan.template_places(text)
        for m in r.matches:
            window = set(pairs[m.word:m.word + lengths[m.name]])
            assert -m.neg == pytest.approx(dice(window, templates[m.name])) and -m.neg >= license_scan.LEAST_DICE
            assert -m.neg <= max(dice(set(pairs[i:i + lengths[m.name]]), templates[m.name]) for i in range(len(pairs))) + 1e-12


def test_no_window_of_enough_words_lacks_all_anchors():
    """All but the anchors of a template can't reach the coefficient."""
    for _, text in license_scan.TEMPLATES:
        own = set(license_scan.template_bigrams(text))
        rest = own - {b for b, _ in license_scan.anchors(text)}
        assert dice(own, rest) < license_scan.LEAST_DICE
        assert dice(own, own - {license_scan.anchors(text)[0][0]}) >= license_scan.LEAST_DICE or len(own) < 4


def test_packing(docs, empty):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    ids = {r[0]: tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [2] for r in rows()}
    pieces = collections.defaultdict(list)
    out = packing.pack(docs, queries.tokenizer_path()).collect()
    for r in out:
        assert r.length & (r.length - 1) == 0 and r.length <= 4096 and r.offset == 0 and r.bucket == r.length.bit_length() - 1
        assert r.ids == ids[r.doc_id][r.start:r.start + r.length] and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        pieces[r.doc_id].append((r.start, r.length))
    assert len({r.sequence_id for r in out}) == len(out)
    copies = collections.Counter(r[0] for r in rows())
    for i, n in copies.items():
        assert sorted(pieces[i]) == sorted(packing.decompose(len(ids[i])) * n)
    assert packing.pack(empty, queries.tokenizer_path()).count() == 0


def test_spans_are_shared_and_keep_the_ids():
    """Case and marks beside a word make no new entry of the cache; ids are those of the tokenizer."""
    import random

    import pyarrow as pa
    from cohortspark.llm.textnp import text_chunks
    rng = random.Random(7)
    parts = ["a", "B", "É", "é", "ß", "Ÿ", "'s", "'", "'LL", "don't", "<|endoftext|>", "<", "12", "٣", "×", "÷", "µ", "ª", "\u0301", "İ", " ",
             "\n", "\x1c", "\x85", "\xa0", "漢", "😀", "-", "...", "’s", "Straße", "A1b2", "\x7f", "À", "e\u0301"]
    odd = ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(1500)] + [None, ""]
    encoder = packing.ChunkEncoder(queries.tokenizer_path())
    tokenizer = packing.load_tokenizer(queries.tokenizer_path())
    for column in (odd[:700], odd[700:], ["Word word, WORD. (Word) word; Übel übel! ÜBEL 1word2"] * 2):
        for lo, hi, data, offs in text_chunks(pa.array(column)):
            ids, counts = encoder.encode(data, offs)
            want = [tokenizer.encode(x or "", add_special_tokens=False).ids for x in column[lo:hi]]
            assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
    encoder.clear()
    column = [f"{a}{w}{b}" for w in ("Quarterly", "quarterly", "QUARTERLY") for a in ("", "(", "-") for b in ("", ",", ".", ";")]
    for _, _, data, offs in text_chunks(pa.array(column)):
        encoder.encode(data, offs)
    assert encoder.lists.n == 1 + 5  # the word and five marks


def test_packed_ids_reach_the_results(spark, docs, empty, tmpdir_path):
    import os

    import corpus_pipeline
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    brute = collections.Counter()
    for r in rows():
        ids = tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [2]
        brute.update((r[0], start, n, tuple(ids[start:start + n])) for start, n in packing.decompose(len(ids)))
    out = corpus_pipeline.pack_stage(spark, docs, tmpdir_path)
    got = out.collect()
    assert collections.Counter((r.doc_id, r.start, r.length, tuple(r.ids)) for r in got) == brute
    assert len({r.sequence_id for r in got}) == len(got) and out.columns == packing.pack(docs, queries.tokenizer_path()).columns
    assert {os.path.basename(os.path.dirname(f)) for f in out.inputFiles()} == {f"bucket={r.bucket}" for r in got}
    assert corpus_pipeline.pack_stage(spark, empty, tmpdir_path).count() == 0
    docs.write.parquet(f"{tmpdir_path}/documents.parquet")
    sums = collections.Counter()
    for (i, start, n, ids), times in brute.items():
        sums[i, start, n, zlib.crc32(np.array(ids, "<u4").tobytes())] += times
    query = queries.op8_pack_pieces(spark, tmpdir_path)
    assert by_text(query.select("doc_id", "start", "length", "ids_crc32")) == sums


def test_rule_ensemble(spark, docs, empty):
    good = [(i, "the word of this and that in text " * (3 + i % 4)) for i in range(200)]
    bad = [(i, "### $$$ word%%% thing&&& " * (3 + i % 5)) for i in range(200, 400)]
    df = spark.createDataFrame(good + bad, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 200), None) for i in range(400)], "doc_id long, quality int, toxic int")
    out = rule_ensemble.classify(df, labels).collect()
    assert all(r.held_out == (crc(r.doc_id) % 5 == 0) and r.predicted == int(r.score >= 0.3) for r in out)
    held = [r for r in out if r.held_out]
    assert np.mean([r.predicted == int(r.doc_id < 200) for r in held]) == 1.0
    odd = rule_ensemble.classify(docs, labels.limit(0)).collect()
    assert len(odd) == len(rows()) and all(0 <= r.score <= 1 for r in odd)
    assert rule_ensemble.classify(empty, labels).count() == 0


def test_exact_dedup(docs, empty):
    groups = collections.defaultdict(list)
    for r in rows():
        norm = re.sub(r"[\x20\x09-\x0D]", "", r[1] or "")
        groups[hashlib.sha256(norm.encode()).hexdigest()].append((-len(r[1] or ""), r[0] is None, r[0]))
    brute = collections.Counter()
    for key, members in groups.items():
        for m in members:
            brute[m[2], min(members)[2], len(members), key] += 1
    out = [(r.doc_id, r.keep_id, r.group_size, bytes(r.digest).hex(), r.kept) for r in exact_dedup.exact_duplicates(docs).collect()]
    assert collections.Counter(r[:4] for r in out) == brute
    assert collections.Counter(r[3] for r in out if r[4]) == collections.Counter(groups.keys())
    assert all(r[0] == r[1] for r in out if r[4])
    left = exact_dedup.drop_duplicates(docs)
    assert left.columns == docs.columns and left.count() == len(groups)
    assert exact_dedup.exact_duplicates(empty).count() == 0 and exact_dedup.drop_duplicates(empty).count() == 0


@pytest.mark.parametrize("full", [2, 15])
def test_histogram_screen_loses_no_link(monkeypatch, full):
    monkeypatch.setattr(ngram_join, "FULL", full)
    rng = np.random.default_rng(full)
    linked = 0
    for _ in range(400):
        a = int(rng.integers(1, 900))
        b = max(1, int(a * rng.uniform(0.8, 1.25)))
        shared = int(min(a, b) * rng.uniform(0.7, 1))
        pool = rng.integers(0, 2**63, a + b, dtype=np.uint64)
        one, two = np.unique(pool[:a]), np.unique(np.concatenate([pool[:shared], pool[a:a + b - shared]]))
        sizes = len(one), len(two)
        hists = ngram_join.histograms(np.concatenate([one, two]), np.cumsum([0, *sizes])).to_pylist()
        common = len(np.intersect1d(one, two))
        for percent in (80, 90):
            asks, members = (ngram_join.Shelf(np.array([n]), np.array([k]), [h]) for k, (n, h) in enumerate(zip(sizes, hists)))
            found, hit = ngram_join.screen(asks, members, percent)
            if 100 * common >= percent * (sum(sizes) - common):
                linked += 1
                assert found[0] and hit[0]
    assert linked > 50
