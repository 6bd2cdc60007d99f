import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from quality_lake.llm.mixing import targets
from quality_lake.sources import stage

from .conftest import SF
from .test_ngram_join import brute, shingles


def test_stages_against_brute_force(spark):
    docs = first = spark.read.parquet(f"{SF}/documents.parquet")
    held = {}
    for name, f in corpus_pipeline.STAGES:
        docs = stage(f(spark, docs, SF), name)
        held[name] = docs
        if name != "packing":
            assert docs.columns == first.columns
    texts = {name: [(r["doc_id"], r["text"]) for r in d.collect()] for name, d in held.items() if name != "packing"}
    toxic_free = set(texts["toxicity"])
    assert toxic_free <= {(r["doc_id"], r["text"]) for r in first.collect()}
    largest = {}
    for i, t in texts["toxicity"]:
        largest[t] = max(i, largest.get(t, -1))
    assert sorted(texts["exact_dedup"]) == sorted((i, t) for t, i in largest.items())
    want = {c for _, n, c in brute(texts["exact_dedup"]) if n} | {i for i, t in texts["exact_dedup"] if not shingles(t)}
    assert {i for i, _ in texts["ngram_join"]} == want
    sizes = Counter()
    source = {r["doc_id"]: r["source"] for r in first.collect()}
    for i, t in texts["ngram_join"]:
        sizes[source[i]] += len(t.split())
    order = sorted(sizes)
    mixed = Counter()
    for i, t in texts["mixing"]:
        mixed[source[i]] += len(t.split())
    for s, wanted in zip(order, targets([sizes[s] for s in order])):
        assert abs(mixed[s] - wanted) <= max(64, 0.05 * wanted)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = Counter()
    for r in held["packing"].collect():
        assert zlib.crc32(r["ids"]) == r["ids_crc32"]
        ids.update(np.frombuffer(r["ids"], "<u4").tolist())
    assert ids == Counter(x for _, t in texts["mixing"] for x in [*tokenizer.encode(t, add_special_tokens=False).ids, 0])


def test_odd_rows_pass_through_all_stages(spark, odd, none):
    for docs in (odd, none):
        for name, f in corpus_pipeline.STAGES:
            docs = stage(f(spark, docs, SF), name)
        assert docs.count() >= 0
