"""Toxicity and quality rules: held-out accuracy, exact counts, edge rows."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelspark.llm import quality, toxicity
from panelspark.llm.crf import LineCrf, fit
from panelspark.llm.queries import QUERIES
from panelspark.suite.registry import table

from cases import edge_docs, edge_rows, empty_docs, pairs

SF = "/root/testdata/sf0.1"


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


@pytest.fixture(scope="module")
def labels(spark):
    return {r.doc_id: (r.quality, r.toxic) for r in table(spark, SF, "labels").collect()}


def test_toxicity_on_held_out_rows(spark, labels):
    rows = QUERIES["op4_toxicity"](spark, SF).collect()
    assert len(rows) == len({r.doc_id for r in rows}) == table(spark, SF, "documents").count()
    assert all(r.held_out == held_out(r.doc_id) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    test = [(labels[r.doc_id][1], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    found = Counter(test)
    assert found[1, 1] / (found[1, 0] + found[1, 1]) > 0.7, found  # some labels of these tables are noise
    assert found[0, 1] / (found[0, 0] + found[0, 1]) < 0.02, found


def test_pairs_of_terms_are_learnt():
    """Neither term alone is toxic, both together are: no sum of weights can say that."""
    rng = np.random.default_rng(0)
    rows, labels = [], []
    for _ in range(1500):
        has = rng.random(2) < 0.5
        rows.append(np.array([i for i in (0, 1) if has[i]] + [2 + int(rng.integers(4))]))
        labels.append(float(has[0] == has[1]))
    model = toxicity.fit(rows, np.array(labels), np.ones(1500), np.arange(6), step=0.2)
    right = [(model.score(r) > 0.5) == (y == 1) for r, y in zip(rows, labels)]
    assert np.mean(right) > 0.95


def labelled(spark, rows):
    """Documents and labels tables of (text, toxic) rows."""
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id bigint, text string")
    return docs, spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)], "doc_id bigint, toxic int")


def test_pairs_of_terms_are_learnt_from_documents(spark):
    """Each of two words is as common in toxic as in clean texts: training must not pass over them."""
    rng, rows = random.Random(5), []
    for _ in range(3000):
        has = rng.random() < 0.5, rng.random() < 0.5
        words = rng.sample([f"w{i:03d}" for i in range(300)], 20) + ["lantern"] * has[0] + ["marble"] * has[1]
        rows.append((" ".join(words), int(has[0] == has[1])))
    docs, toxic = labelled(spark, rows)
    found = toxicity.score(docs, toxicity.train(docs, toxic), threshold=0.5).collect()
    test = [r for r in found if held_out(r.doc_id)]
    assert len(test) > 500 and np.mean([r.predicted == rows[r.doc_id][1] for r in test]) > 0.95


def test_copies_of_a_long_text_do_not_push_terms_out(spark):
    """A copied text has more terms than were kept before, all of them further apart between the labels than the insult."""
    rng = random.Random(6)
    copied = " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9)) for _ in range(800))
    rows = []
    for i in range(1200):
        words = " ".join(rng.sample([f"w{n:03d}" for n in range(300)], 20))
        rows.append((copied, 0) if i % 4 == 0 else (words + " grubbit" * (i % 8 == 1), int(i % 2 == 1)))
    docs, toxic = labelled(spark, rows)
    model = toxicity.train(docs, toxic)
    assert {toxicity.hashed("=grubbit"), *(h for w in copied.split() for h in toxicity.terms_of_word(w))} <= set(model.place)
    plain = " ".join(f"w{n:03d}" for n in range(20))
    pair = spark.createDataFrame([(1, plain), (2, plain + " grubbit")], "doc_id bigint, text string")
    found = {r.doc_id: r.score for r in toxicity.score(pair, model).collect()}
    assert found[2] > found[1]


def test_score_is_the_sum_over_pairs():
    rng = np.random.default_rng(1)
    model = toxicity.Machine(np.arange(5), 0.1, rng.normal(size=5), rng.normal(size=(5, 3)))
    at = np.array([0, 2, 3])
    pairs_sum = sum(model.vectors[a] @ model.vectors[b] for a in at for b in at if a < b)
    total = 0.1 + model.weights[at].sum() + 32 / (32 + 3) * pairs_sum  # pairs weigh 32 / (32 + n) at every length
    assert model.score(at) == pytest.approx(1 / (1 + np.exp(-total)))


def test_toxicity_edge_rows(spark):
    docs = edge_docs(spark)
    toxic = spark.createDataFrame([(i, i % 2) for i in range(20)] + [(None, 1), (3, None), (99, 1)], "doc_id bigint, toxic int")
    model = toxicity.train(docs, toxic)
    rows = toxicity.score(docs, model).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in pairs(edge_rows()))
    assert all(0 <= r.score <= 1 for r in rows)
    assert toxicity.train(docs, toxic.where("toxic = 1")) is None
    assert toxicity.train(empty_docs(spark), toxic) is None
    assert {r.score for r in toxicity.score(docs, None).collect()} == {0.0}
    assert toxicity.score(empty_docs(spark), model).count() == 0


def test_kept_texts_go_to_a_task_once(spark):
    """Kept columns come back as they were, and the plan hands a kept text to Python in one column."""
    docs = edge_docs(spark).select("text", F.struct("doc_id", "lang", "`a.b`").alias("row"))
    model = toxicity.Machine(np.array([toxicity.hashed("=one")]), -1.0, np.array([3.0]), np.zeros((1, 2)))
    alone = {r["doc_id"]: r["score"] for r in toxicity.score(edge_docs(spark), model).collect()}
    for found in (toxicity.score(docs, model, ["row", "text"]), quality.assess(docs, None, ["row", "text"])):
        plan = found._jdf.queryExecution().analyzed().toString()
        assert len(re.search(r"MapInArrow batches\(([^)]*)\)", plan)[1].split(", ")) == 2, plan
        wanted = Counter((r["doc_id"], r["lang"], r["a.b"], r["text"]) for r in edge_docs(spark).collect())
        assert Counter((*r["row"], r["text"]) for r in found.collect()) == wanted
    once = [r for r in edge_rows() if r[0] is not None and [x[0] for x in edge_rows()].count(r[0]) == 1]
    scores = {r["row"]["doc_id"]: r["score"] for r in toxicity.score(docs, model, ["row", "text"]).collect()}
    assert once and all(scores[r[0]] == alone[r[0]] for r in once) and len(set(scores.values())) == 2


def test_lone_bytes_in_kept_texts(spark):
    docs = spark.sql("SELECT 1 AS id, cast(X'61FF' AS string) AS text")
    out = toxicity.score(docs, None, ["id", "text"]).selectExpr("id", "hex(text) AS h").collect()
    assert [tuple(r) for r in out] == [(1, "61FF")]


def test_tasks_of_a_worker_share_one_machine(spark):
    """The model is not unpickled anew by every task of a worker."""
    loads = spark.sparkContext.accumulator(0)

    class Counted:
        def __reduce__(self):
            return loads.add, (1,)

    model = toxicity.Machine(np.arange(3), 0.0, np.zeros(3), np.zeros((3, 2)))
    model.counted = Counted()
    docs = spark.range(0, 4000, 1, 40).selectExpr("id AS doc_id", "concat('word', id) AS text")
    assert toxicity.score(docs, model).count() == 4000
    assert toxicity.score(docs, model).where("score >= 0").count() == 4000
    assert loads.value < 40


def test_quality_on_held_out_rows(spark, labels):
    rows = QUERIES["op10_quality_rules"](spark, SF).collect()
    passed = [(labels[r.doc_id][0], r.kept) for r in rows if r.doc_id in labels and held_out(r.doc_id) and not r.base_failed]
    found = Counter(passed)
    assert found[1, False] / (found[1, False] + found[1, True]) < 0.02, found
    assert found[0, True] / (found[0, False] + found[0, True]) < 0.1, found
    assert all(not (r.base_failed and r.kept) for r in rows)


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, doubles = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            doubles += line in seen
            seen.add(line)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), doubles, len(inside), failed)


def test_quality_counts_equal_plain_python(spark):
    rows = edge_rows() + [(100, "a b c d e a b c d e f g h i j k l m n o p q r s t u v w x y z", "", "", 0) + ("clash",) * 10,
                          (101, "same line\nsame line\n\n\n x \nsame line", "", "", 0) + ("clash",) * 10]
    docs = spark.createDataFrame(rows, edge_docs(spark).schema)
    got = quality.assess(docs, None).collect()
    wanted = Counter((i, *plain_counts(t)) for i, t in pairs(rows))
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                   for r in got) == wanted
    assert all(r.kept == (not r.base_failed) for r in got)
    assert quality.assess(empty_docs(spark), None).count() == 0
    marks = spark.createDataFrame([(i, i % 2) for i in range(20)] + [(None, 0), (3, None)], "doc_id bigint, quality int")
    model = quality.train(docs, marks)
    assert quality.assess(docs, model).count() == len(rows)
    assert quality.train(docs, marks.where("quality = 1")) is None


def test_viterbi_equals_trying_every_labelling():
    rng = np.random.default_rng(2)
    for _ in range(20):
        model = LineCrf(rng.normal(size=(2, 3)), rng.normal(size=(2, 2)))
        x = rng.normal(size=(7, 3))
        scores = x @ model.weights.T

        def total(states):
            return (sum(scores[i, s] for i, s in enumerate(states))
                    + sum(model.moves[a, b] for a, b in zip(states, states[1:])))

        best = max((tuple(n >> i & 1 for i in range(7)) for n in range(128)), key=total)
        assert tuple(model.viterbi(x).tolist()) == best


def test_fitted_moves_carry_a_state_over_lines_without_evidence():
    rng = np.random.default_rng(3)
    n, length = 200, 8
    states = np.repeat(rng.integers(0, 2, (n, 1)), length, axis=1)
    features = np.zeros((n, length, 2))
    features[..., 0] = 1
    features[:, :3, 1] = np.where(states[:, :3] == 1, 1, -1)
    model = fit(features, states, np.ones((n, length), bool))
    assert all((model.viterbi(f) == s).all() for f, s in zip(features, states))


def test_what_workers_remember_is_bounded_in_bytes():
    from panelspark.llm import arrow
    asked = []
    known = arrow.Remembered(lambda key: asked.append(key) or key * 2, 20_000)
    for i in range(5000):
        assert known[b"%d" % (i % 700)] == b"%d" % (i % 700) * 2
    held = {**known.older, **known}
    assert sum(len(k) + arrow.cost(v) + arrow.ENTRY for k, v in held.items()) <= 2 * 20_000
    assert known[b"x" * 65] == b"x" * 130 and b"x" * 65 not in known  # long words are not kept
    first = arrow.kept(("a",), dict)
    assert arrow.kept(("a",), dict) is first
    arrow.kept(("b",), dict)
    assert arrow.kept(("a",), dict) is not first  # another stage's memory has gone


def test_lines_far_down_and_repeated_ids_in_training(spark):
    """Boilerplate that begins after line 256 is learnt, and a drawn id that is repeated counts once."""
    good = "\n".join(f"this is an ordinary line number {i} that ends well." for i in range(600))
    bad = "\n".join([f"this is an ordinary line number {i} that ends well." for i in range(260)]
                    + ["$$ ## BUY | NOW | ## $$"] * 900)
    docs = [(i, good.replace("6", str(i)) if i % 2 else bad) for i in range(40)] + [(1, good)] * 300
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id bigint, quality int")
    model = quality.train(frame, labels)
    sold = "\n".join(f"$$ ## BUY | NOW | ## $$ x{i}" for i in range(40))
    new = spark.createDataFrame([(1, good + "\nand one line more, all of it text."), (2, sold)], "doc_id bigint, text string")
    share = {r["doc_id"]: r["content_share"] for r in quality.assess(new, model).collect()}
    assert share[1] > 0.5 > share[2]
