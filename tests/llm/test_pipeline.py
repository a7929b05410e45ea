import hashlib
from collections import Counter

import numpy as np
import tiktoken

import corpus_pipeline
from tradewinds import scratch
from tradewinds.llm import bpe, exact_dedup, jaccard_join, mixing, quality

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "quality classifier" and len(corpus_pipeline.STAGES) == 5
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = {r[0] for r in quality.score_documents(docs, labels).where("predicted = 1").select("doc_id").collect()}
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before, docs = docs, stage(spark, docs, SF).cache()
        ids = [r[0] for r in docs.select("doc_id").collect()]
        if k == 0:
            assert set(ids) == kept
        if k == 1:
            assert set(ids) == {r[0] for r in exact_dedup.exact_dedup(before).where("kept").select("doc_id").collect()}
        if k == 2:
            assert set(ids) == {r[0] for r in jaccard_join.jaccard_join(before).select("component_id").collect()}
        if k == 3:
            times = {r["doc_id"]: len(r["slots"]) for r in mixing.mix(before).collect()}
            assert Counter(ids) == Counter({i: n for i, n in times.items() if n})
        if k == 4:
            own = bpe.loaded(corpus_pipeline.RANKS)
            library = tiktoken.Encoding("own", pat_str=bpe.tokenizer_pattern(), mergeable_ranks=own.ranks, special_tokens={})
            want = Counter()
            for r in before.collect():
                tokens = library.encode_ordinary(r["text"] or "")
                want[(r["doc_id"], len(tokens), hashlib.sha256(np.array(tokens, "<u4").tobytes()).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest())] += 1
            assert Counter(map(tuple, docs.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect())) == want
        if k < 4:
            assert docs.columns == columns and ids
    standing = len(scratch.tables())
    assert corpus_pipeline.run(spark, SF).count() == docs.count()
    assert len(scratch.tables()) == standing + 1
