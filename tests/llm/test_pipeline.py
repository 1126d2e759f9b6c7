"""The pipeline against plain versions of its stages."""

import collections

import corpus_pipeline
from tests.llm import brute


def test_pipeline(spark, sf_dir):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    frame, seen = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, frame, sf_dir)
        path = f"{corpus_pipeline.scratch(spark, 'test-stage')}"
        out.write.parquet(path)
        frame = spark.read.schema(out.schema).parquet(path)
        seen[name] = frame.collect()
    ids = lambda name: {r.doc_id for r in seen[name]}
    assert len(ids("language")) >= 0.98 * len(docs)
    roots = brute.near_classes([(d, docs[d].text) for d in sorted(ids("language"))])
    assert ids("near-duplicates") == set(roots.values())
    dirty = brute.contaminated([(d, docs[d].text) for d in ids("near-duplicates")], items)
    assert ids("decontamination") == {d for d, (_, hit, _) in dirty.items() if not hit}
    sizes = collections.Counter()
    for d in ids("decontamination"):
        sizes[docs[d].source] += brute.size_words(docs[d].text)
    want, taken, largest = brute.targets(dict(sizes)), collections.Counter(), collections.Counter()
    for r in seen["mixture"]:
        n = brute.size_words(r.text)
        taken[r.source] += n
        largest[r.source] = max(largest[r.source], n)
    assert all(abs(taken[s] - want[s]) <= max(brute.size_words(docs[d].text) for d in ids("decontamination") if docs[d].source == s) for s in want)
    assert max(collections.Counter(r.doc_id for r in seen["mixture"]).values()) <= 3
    shards = collections.defaultdict(list)
    for r in seen["shards"]:
        shards[r.shard].append(r.slot)
    assert sum(map(len, shards.values())) == len(seen["mixture"]) and all(sorted(s) == list(range(len(s))) for s in shards.values())


def test_pipeline_of_nothing(spark, tmp_path, sf_dir):
    import os

    for t in ("benchmark", "labels"):
        os.symlink(f"{sf_dir}/{t}.parquet", tmp_path / f"{t}.parquet")
    spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
