"""The pipeline against its stages' rules recomputed from what each stage kept."""

import collections
import re

import pyarrow as pa
from llm_rows import docs, empty, rows, words  # noqa: F401
from pyspark.sql import functions as F

import corpus_pipeline
from cohortspark.llm import common, mixing, ngram_join, packing, quality_rules, queries
from tokenizers import Tokenizer


def shingles(text, size=5):
    w = words(text, lower=True)
    return frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)])


def test_pipeline(spark, docs, tmpdir_path):  # noqa: F811
    docs.write.parquet(f"{tmpdir_path}/documents.parquet")
    table = spark.read.parquet(f"{tmpdir_path}/documents.parquet")
    kept, steps = table, []
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, kept, tmpdir_path)
        path = f"{tmpdir_path}/{name}"
        kept.write.parquet(path)
        kept = spark.read.parquet(path)
        steps.append(kept)
        if name != "packing":
            assert kept.columns == table.columns
    quality, exact, near, mixed, pieces = steps
    good = quality_rules.quality(table).where("kept").collect()
    assert collections.Counter(r.doc_id for r in good) == collections.Counter(r.doc_id for r in quality.collect())
    assert all(len(words(r.text)) >= 20 for r in quality.collect())
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    groups = collections.defaultdict(list)
    for r in quality.collect():
        groups[norm(r.text)].append((-len(r.text), r.doc_id))
    assert sorted(r.doc_id for r in exact.collect()) == sorted(min(g)[1] for g in groups.values())
    left = exact.collect()
    sets, group = [shingles(r.text) for r in left], list(range(len(left)))
    for a in range(len(left)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common) and group[a] != group[b]:
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    first = {g: min(left[k].doc_id for k in range(len(left)) if group[k] == g) for g in set(group)}
    assert sorted(r.doc_id for r in near.collect()) == sorted(first.values())
    assert len(first) < len(left)
    times = {r.doc_id: r.times for r in mixing.mix(near).collect()}
    assert collections.Counter(r.doc_id for r in mixed.collect()) == +collections.Counter(times)
    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    brute = collections.Counter()
    for r in mixed.collect():
        n = len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1
        brute.update((r.doc_id, start, length) for start, length in packing.decompose(n))
    assert collections.Counter((r.doc_id, r.start, r.length) for r in pieces.collect()) == brute
    whole = corpus_pipeline.run(spark, tmpdir_path)
    assert collections.Counter((r.doc_id, r.start, r.length) for r in whole.collect()) == brute


def test_texts_go_to_workers_in_small_batches(spark):
    """30 MB of long texts in one partition; before, they were one batch."""
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes]), pa.array([batch.num_rows])], names=["size", "n"])
    texts = spark.range(3000, numPartitions=1).select(F.col("id").alias("doc_id"), F.expr("repeat('0123456789', 1000)").alias("text"))
    some = texts.limit(3).withColumn("lang", F.lit("en"))
    for prepare in (lambda: packing.pack(some, queries.tokenizer_path()), lambda: quality_rules.fit(some),
                    lambda: ngram_join.described(some, 5, 80)):
        spark.conf.unset(common.BATCH_BYTES)
        prepare()
        got = texts.mapInArrow(sizes, "size long, n long").collect()
        assert sum(r.n for r in got) == 3000 and max(r.size for r in got) < 9_000_000
    spark.conf.set(common.BATCH_BYTES, "1m")  # a session's own setting stays
    packing.pack(texts, queries.tokenizer_path())
    assert spark.conf.get(common.BATCH_BYTES) in ("1m", "1048576b")
    spark.conf.unset(common.BATCH_BYTES)
