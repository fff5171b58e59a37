"""The pipeline against a plain version of each stage, and on difficult rows."""

from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from panelspark.llm import quality, toxicity
from panelspark.suite.registry import table

from cases import edge_docs, empty_docs
from test_models import plain_counts
from test_native import plain_dedup
from test_search import plain_components
from test_tokens import check_sequences

SF = "/root/testdata/sf0.001"


def plain_toxic(model, text):
    at = {model.place[h] for w in toxicity.words_of((text or "").encode()) for h in toxicity.terms_of_word(w)
          if h in model.place}
    return model.score(np.array(sorted(at), np.int64)) >= toxicity.THRESHOLD


def plain_kept(model, text):
    if plain_counts(text)[5]:
        return False
    features, sizes, _ = quality.line_table((text or "").encode())
    content = model.viterbi(np.array(features, float)) == 0 if model else np.ones(len(sizes), bool)
    return np.array(sizes)[content].sum() >= quality.MIN_SHARE * sum(sizes)


def test_stages_equal_plain_versions(spark):
    labels = table(spark, SF, "labels")
    docs = table(spark, SF, "documents").cache()
    found = {r.doc_id: r.text for r in docs.collect()}
    frames = []
    for _, stage in corpus_pipeline.STAGES:
        frames.append(docs)
        docs = stage(spark, docs, SF).cache()
        if len(frames) < len(corpus_pipeline.STAGES):
            assert docs.columns == frames[0].columns
    frames.append(docs)

    def texts(at):
        return {r.doc_id: r.text for r in frames[at].collect()}

    model = toxicity.train(frames[0], labels)
    plain = {i: t for i, t in found.items() if not plain_toxic(model, t)}
    assert texts(1) == plain
    model = quality.train(frames[1], labels)
    plain = {i: t for i, t in plain.items() if plain_kept(model, t)}
    assert texts(2) == plain
    plain = {i: t for i, _, _, t in plain_dedup(list(plain.items()), 20, 3)}
    assert texts(3) == plain
    stay = {c for _, n, c in plain_components(list(plain.items())) if n}
    plain = {i: t for i, t in plain.items() if i in stay or not t.split()}
    assert texts(4) == plain
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    total = {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in plain.items()}
    rows = frames[5].collect()
    assert {i: sum(r.length for r in rows if r.doc_id == i) for i in plain} == total
    bins = check_sequences([(r.sequence_id, r.offset, r.length) for r in rows], corpus_pipeline.MAX_TOKENS)
    assert bins == -(-sum(total.values()) // corpus_pipeline.MAX_TOKENS)


def test_stages_stand_difficult_rows(spark):
    for docs in (edge_docs(spark), empty_docs(spark)):
        before = Counter(r.doc_id for r in docs.collect())
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            after = Counter(r.doc_id for r in out.collect())
            assert set(after) <= set(before), name
            if name != "packing":
                assert out.schema.simpleString() == docs.schema.simpleString(), name


def test_run_gives_the_rows_of_the_last_stage(spark):
    assert [len(corpus_pipeline.STAGES), corpus_pipeline.STAGES[-1][0]] == [5, "packing"]
    out = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "piece", "length", "sequence_id", "offset"} <= set(out.columns) and out.count() > 0
