"""The pipeline's stages against plain readings, each on its own input."""

from collections import Counter

import numpy as np
import public_tokenizers
from conftest_words import lower
from test_pairs import groups
from tokenizers import Tokenizer

import corpus_pipeline
from refrain.llm import toxicity

WIDTH = 200


def cut_bytes(texts):
    times = Counter(t[s : s + WIDTH] for t in texts for s in range(len(t) - WIDTH + 1))
    for t in texts:
        gone = np.zeros(len(t), bool)
        for s in range(len(t) - WIDTH + 1):
            if times[t[s : s + WIDTH]] > 1:
                gone[s : s + WIDTH] = True
        yield bytes(np.frombuffer(t, np.uint8)[~gone]).decode("utf-8", "ignore")


def item_sets(text):
    words = "".join(c if c.isalnum() and c.isascii() or ord(c) > 127 else " " for c in lower(text or "")).split(" ")
    words = [w for w in words if w]
    return {tuple(words[j : j + 5]) for j in range(len(words) - 4)}


def test_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, made = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        made[name] = docs.collect()
        if name != "packing":
            assert docs.columns == columns
    given = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~toxicity.held_out_split())
    scores = toxicity.score_documents(given, toxicity.fit(given, labels)).collect()
    assert {r["doc_id"] for r in made["toxicity"]} == {r["doc_id"] for r in scores if not r["predicted"]}

    rows = [(r["doc_id"], r["text"]) for r in made["toxicity"]]
    firsts = {c for _, n, c in groups(rows, 80) if n}
    assert sorted(r["doc_id"] for r in made["ngram_join"]) == sorted(firsts)

    texts = [r["text"].encode() for r in made["ngram_join"]]
    expected = dict(zip((r["doc_id"] for r in made["ngram_join"]), cut_bytes(texts)))
    assert {r["doc_id"]: r["text"] for r in made["suffix_dedup"]} == expected
    assert all(r["n_chars"] == len(r["text"]) for r in made["suffix_dedup"])

    items = [item_sets(r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    clean = {
        r["doc_id"] for r in made["suffix_dedup"]
        if not any(i and len(i & item_sets(r["text"])) >= 0.8 * len(i) for i in items)
    }
    assert {r["doc_id"] for r in made["decontamination"]} == clean

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    lengths = {
        r["doc_id"]: len(tokenizer.encode(r["text"], add_special_tokens=False).ids) + 1
        for r in made["decontamination"]
    }
    packed = Counter()
    for r in made["packing"]:
        packed[r["doc_id"]] += r["length"]
    assert packed == lengths
    assert len({r["sequence_id"] for r in made["packing"]}) <= -(-sum(lengths.values()) // 2048) + 1


def test_run(spark, sf_dir):
    made = corpus_pipeline.run(spark, sf_dir)
    assert {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(made.columns)
    assert made.count() > 0
