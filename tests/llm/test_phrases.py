"""Collocations, lexical search and fingerprints against brute force."""

import math
import random
import re
from collections import Counter
from hashlib import sha256

import duckdb
import numpy as np
import pytest

from panelspark.llm import collocations, lexical_search, queries, simhash, sql

from cases import edge_docs, edge_rows, empty_docs, words

SF = "/root/testdata/sf0.001"


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# --- collocations

def plain_collocations(rows, min_count, top):
    """rows: (text, lang)"""
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", lowered(text)):
            found = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(found)
            for k in range(1, 6):
                for s in range(len(found) - k + 1):
                    counts[lang, tuple(found[s:s + k])] += 1
    frequent = {p: f for p, f in counts.items() if f >= min_count}
    out = {}
    for (lang, phrase), a in frequent.items():
        if len(phrase) < 2:
            continue
        n = totals[lang]
        score, cut = min((1000 * a * n // (counts[lang, phrase[:c]] * counts[lang, phrase[c:]]), c)
                         for c in range(1, len(phrase)))
        if any(l2 == lang and len(longer) > len(phrase) and 100 * f >= 100 * a
               and any(longer[i:i + len(phrase)] == phrase for i in range(len(longer)))
               for (l2, longer), f in frequent.items()):
            continue
        out.setdefault(lang, []).append((" ".join(phrase), a, counts[lang, phrase[:cut]], counts[lang, phrase[cut:]], n, score))
    return sorted((lang, i + 1, *row) for lang, found in out.items() for i, row in enumerate(
        sorted(found, key=lambda r: (-r[5], -r[1], r[0].encode()))[:top]))


def phrase_rows():
    rng = random.Random(11)
    vocabulary = words(rng, 25)
    made = []
    for i in range(120):
        text = " ".join(rng.choice(vocabulary) + rng.choice(["", "", "", "", ",", ". ", "\n", "\t"]) for _ in range(rng.randint(0, 60)))
        made.append((text.title() if i % 7 == 0 else text, ["en", "de", None][i % 3]))
    made += [("a a a a a a a a a a a a", "en"), ("to be or not to be or not to be", "und"), (None, "en"), ("", None)]
    return made + made[:40] + [("the very same line that all share", "en")] * 50


@pytest.mark.parametrize("top", [2000, 5])
def test_collocations_equal_brute_force(spark, top):
    rows = phrase_rows()
    docs = spark.createDataFrame([(t, lang, "clash") for t, lang in rows], "text string, lang string, phrase string")
    got = collocations.collocations(docs.repartition(3), min_count=4, top=top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == plain_collocations(rows, 4, top)


def test_collocations_edge_rows_and_empty_table(spark):
    rows = [(r[1], r[2]) for r in edge_rows()]
    got = collocations.collocations(edge_docs(spark), min_count=2)
    assert sorted(map(tuple, got.collect())) == plain_collocations(rows, 2, 2000)
    assert collocations.collocations(empty_docs(spark)).count() == 0


def test_every_phrase_start_is_in_one_chunk():
    rng = random.Random(5)
    for size in (0, 1, 4, 5, 6, 300, 5000):
        text = "".join(rng.choice("abcdefgh") + rng.choice(["", " ", "\t ", ", "]) for _ in range(size)).encode()
        want, got, edges = Counter(), Counter(), Counter()
        for piece in text.split(b","):
            found = piece.split()
            for k in range(1, 6):
                want.update(tuple(found[s:s + k]) for s in range(len(found) - k + 1))
        parsed = collocations.Words(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
        starts, ends, cores = collocations.cut_chunks(parsed)
        chunks = [(t.as_py(), cores[a + i]) for a, _, texts in collocations.joined(parsed, starts, ends)
                  for i, t in enumerate(texts)]
        for chunk, core in chunks:
            own = chunk.encode().split(b" ")
            edges[chunk] += 1
            for k in range(1, 6):
                got.update(tuple(own[s:s + k]) for s in range(min(core, len(own) - k + 1)))
        assert got == want
        if size >= 5000:  # repeated chunks are what the parse saves
            assert len(edges) < 0.9 * sum(edges.values())


def test_hashes_do_not_depend_on_blocks(monkeypatch):
    text = b"one two \xc3\xa9 " + b"x" * 3000 + b" y"
    edges = np.array([0, 5, 5, len(text)])
    whole = collocations.Words(np.frombuffer(text, np.uint8), edges)
    assert [text[s:e] for s, e in zip(whole.starts, whole.ends)][:3] == [b"one", b"t", b"wo"]
    monkeypatch.setattr(collocations, "BLOCK", 4)
    assert (collocations.Words(np.frombuffer(text, np.uint8), edges).hashes == whole.hashes).all()
    assert len(set(whole.hashes.tolist())) == len(whole.hashes)


def test_words_before_the_last_follow_from_the_hashes():
    rng = np.random.default_rng(3)
    first, last = rng.integers(0, 2 ** 64, (2, 1000), dtype=np.uint64)
    grams = collocations.longer(first, np.roll(last, 1), 2)
    assert (collocations.without_last(grams, last) == first).all()


def test_equal_hashes_of_other_last_words_stay_apart():
    keys, last = np.array([5, 7, 5, 5], np.uint64), np.array([1, 1, 2, 1], np.uint64)
    sums = collocations.Sums()
    assert not list(sums.add(keys, last, np.array([1, 10, 100, 1000])))
    totals = Counter()
    for key, word, value in zip(*(a.tolist() for a in sums.folded())):
        totals[key, word] += value
    assert totals == {(5, 1): 1001, (5, 2): 100, (7, 1): 10}


def test_texts_of_phrases_are_not_gathered_in_every_task(spark, monkeypatch):
    """Every task met every frequent phrase and handed its text on: rows grew as tasks times phrases."""
    made = []
    rows = [(" ".join(f"w{i % 7}{j}" for j in range(9)), "en") for i in range(70)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    stored = collocations.materialize

    def counted(df, label):
        made.append([line for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "MapInArrow" in line])
        return stored(df, label)

    monkeypatch.setattr(collocations, "materialize", counted)
    counts, _ = collocations.phrase_counts(docs, min_count=10)
    got = {(r.k, r.phrase): r.f for r in counts.collect()}
    want = Counter((k, " ".join(t.split()[s:s + k])) for t, _ in rows for k in range(1, 6) for s in range(10 - k))
    assert got == want
    texts = [line for lines in made for line in lines if "phrase" in line]
    assert len(texts) == 1 and re.search(r"\[h#\d+L, lang#\d+, phrase#", texts[0]), texts  # words, no phrases of k words


def test_products_beyond_64_bits(spark, monkeypatch):
    """Counts of a corpus far larger than any test's, through the same scoring."""
    big = 3 * 10 ** 14
    counts = spark.createDataFrame([("en", 1, "x", big), ("en", 1, "y", big - 7), ("en", 2, "x y", big - 11)],
                                   "lang string, k int, phrase string, f bigint")
    totals = spark.createDataFrame([("en", 9 * 10 ** 15)], "lang string, n bigint")
    monkeypatch.setattr(collocations, "phrase_counts", lambda *a: (counts, totals))
    row = collocations.collocations(empty_docs(spark)).collect()
    assert [tuple(r) for r in row] == [("en", 1, "x y", big - 11, big, big - 7, 9 * 10 ** 15,
                                        1000 * (big - 11) * 9 * 10 ** 15 // (big * (big - 7)))]


def test_registered_collocations(spark):
    got = queries.op11_collocations(spark, SF)
    assert dict(got.dtypes) == {"lang": "string", "phrase": "string"} | dict.fromkeys("rank a l r n score".split(), "bigint")
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = connection.execute(queries.ORACLES["op11_collocations"]).fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want) and want


# --- lexical search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_search(docs, items, size=10):
    """docs: (id, text), items: (id, text)"""
    counted = [(i, Counter(TERM.findall(lowered(t)))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    total, length = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        found = []
        for ident, c in counted:
            n, score = sum(c.values()), 0
            m = 100 - 90 + (90 * n * total) // length
            for t in set(TERM.findall(lowered(text))):
                if c[t]:
                    score += math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (
                        (10 ** 9 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                found.append((score, ident))
        found.sort(key=lambda r: (-r[0], r[1] is None, r[1]))
        out += [(item, i + 1, ident, score) for i, (score, ident) in enumerate(found[:size])]
    return sorted(out, key=repr)


def search_docs():
    rng = random.Random(2)
    vocabulary = words(rng, 300)
    topics = [rng.sample(vocabulary, 40) for _ in range(6)]
    docs = [(i, " ".join(rng.choice(topics[i % 6]) for _ in range(rng.randint(1, 120)))) for i in range(900)]
    docs += [(900 + i, docs[i % 5][1]) for i in range(60)] + [(3, docs[3][1]), (None, docs[6][1]), (None, docs[6][1])]
    items = [(i, " ".join(rng.sample(topics[i % 6], 5) + rng.sample(vocabulary, 3))) for i in range(25)]
    return docs, items + [(7, "unknown ZZZ"), (8, None), (9, docs[0][1].upper()), (9, docs[1][1]), (None, docs[2][1])]


@pytest.mark.parametrize("block_terms", [200_000, 40])
def test_search_equals_brute_force(spark, block_terms):
    docs, items = search_docs()
    frame = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id bigint, text string, score int").repartition(3)
    asked = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id bigint, text string, no int")
    got = lexical_search.rank_documents(frame, asked, block_terms=block_terms)
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, got.collect()), key=repr) == plain_search(docs, items)


def test_search_edge_rows_and_empty_tables(spark):
    docs = [(r[0], r[1]) for r in edge_rows()]
    items = spark.createDataFrame([(1, "the one x"), (2, None), (3, docs[8][1])], "item_id bigint, text string")
    got = lexical_search.rank_documents(edge_docs(spark), items)
    assert sorted(map(tuple, got.collect()), key=repr) == plain_search(docs, [(1, "the one x"), (2, None), (3, docs[8][1])])
    assert lexical_search.rank_documents(empty_docs(spark), items).count() == 0
    assert lexical_search.rank_documents(edge_docs(spark), items.limit(0)).count() == 0


def test_blocks_are_skipped_by_their_bounds_only():
    """Whole lists in one portion: the walk scores few documents, and finds what a full scan finds."""
    rng = np.random.default_rng(4)
    width, n = 60, 4000
    sizes = rng.integers(1, 12, n)
    terms = np.concatenate([rng.choice(np.arange(10) + 10 * (d % 6), s, False) if s <= 10 else rng.choice(width, s, False)
                            for d, s in enumerate(sizes)])
    items = lexical_search.Items({}, {}, rng.integers(1, 9000, width), n, int(sizes.sum() * 3))
    directions = rng.choice([-1.0, 1.0], (width, lexical_search.SKETCH)).astype(np.float32)
    portion = lexical_search.Portion(items, directions, (sizes * 3).tolist(), sizes.tolist(), terms.tolist(),
                                     rng.integers(1, 5, len(terms)).tolist())
    asked_terms = np.array([1, 2, 3, 14, 55])
    asked = np.zeros(width, bool)
    asked[asked_terms] = True
    full = portion.scores(np.arange(n), asked)
    best, scored = lexical_search.Best(10), []

    def keep(docs, scores):
        scored.extend(docs.tolist())
        return best.add(docs.tolist(), scores)

    portion.search(asked_terms, best.lowest, keep)
    order = sorted(range(n), key=lambda d: (-full[d], d))[:10]
    assert best.rows == [(int(full[d]), d) for d in order]
    assert len(scored) == len(set(scored)) and len(scored) < 0.5 * np.count_nonzero(full)
    for term in range(width):
        docs, edges, block, coordinate, most = portion.blocks_of(term)
        for b in range(len(edges) - 1):
            inside = block == b
            bound = np.bincount(coordinate[inside], most[inside], width) @ asked
            assert (full[docs[edges[b]:edges[b + 1]]] <= bound).all()


def test_registered_search(spark):
    got = queries.op12_lexical_search(spark, SF)
    connection = duckdb.connect()
    for name in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    want = connection.execute(queries.ORACLES["op12_lexical_search"]).fetchall()
    assert sorted(map(tuple, got.select("item_id", "rank", "doc_id", "score").collect())) == sorted(want) and want


# --- fingerprints

def plain_edits(rows):
    """Per (id, text) of the descending order: edited text and the next text."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for at, (ident, text) in enumerate(order):
        text, after = text or "", order[(at + 1) % len(order)][1] or ""
        part = len(text) // 3
        out.append((ident, text, text[:len(text) - part] + after[:part], after))
    return out


def test_edited_texts_and_likeness(spark):
    rng = random.Random(8)
    vocabulary = words(rng, 800)
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(20, 200)))) for i in range(-40, 200)]
    rows += [(300 + i, t) for i, t in enumerate([None, "", "é", "x", "東京 is", rows[5][1], rows[5][1], "a" * 4000])]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id bigint, text string, hi int, part int").repartition(5)
    weights = simhash.rarity(docs)
    measure = lambda text: weights.fingerprint(simhash.Words(), text.encode())
    want = []
    for ident, text, changed, after in plain_edits(rows):
        own, other, following = measure(text), measure(changed), measure(after)
        want.append((ident, len(text), sha256(changed.encode()).hexdigest(), own.hex(), other.hex(),
                     1 - bin(int(own.hex(), 16) ^ int(other.hex(), 16)).count("1") / 128,
                     1 - bin(int(own.hex(), 16) ^ int(following.hex(), 16)).count("1") / 128))
    got = [tuple(r)[:7] for r in simhash.compare_with_next(docs).collect()]
    assert sorted(got) == sorted(want)
    ordinary = [r for r in got if 0 <= r[0] < 200]
    assert sum(r[5] > r[6] for r in ordinary) >= 0.98 * len(ordinary)


def test_weights_count_every_document(spark):
    docs = spark.createDataFrame([(1, "the rare"), (2, "the"), (3, "the the"), (4, None)], "doc_id int, text string")
    weights = simhash.rarity(docs.repartition(3))
    found = simhash.Words()
    the, rare = (weights.weights[simhash.slots_of(found(w)[0])][0] for w in (b"the", b"rare"))
    assert (the, rare) == (round(16 * math.log2(1 + 4 / 3)), round(16 * math.log2(1 + 4)))


def test_fingerprints_of_edge_rows(spark):
    got = simhash.compare_with_next(edge_docs(spark)).collect()
    rows = edge_rows()
    assert Counter((r["doc_id"], r["n_chars"]) for r in got) == Counter((r[0], len(r[1] or "")) for r in rows)
    prints = {}
    for r in got:  # equal texts, equal fingerprints: ids 5, 6 and 2 ** 40
        prints.setdefault((r["doc_id"], r["n_chars"]), r["fingerprint"])
    long = len(rows[5][1])
    assert prints[5, long] == prints[6, long] and prints[0, 0] == "0" * 32
    assert simhash.compare_with_next(empty_docs(spark)).count() == 0
    single = simhash.compare_with_next(edge_docs(spark).where("doc_id = 8")).collect()
    assert len(single) == 1 and single[0]["near_next"] == 1.0


@pytest.mark.parametrize("bucket,radius,blocks", [(4096, 4, 6), (3, 4, 6), (4, 2, 4), (2, 0, 2)])
def test_all_fingerprints_within_the_radius(spark, bucket, radius, blocks):
    rng = random.Random(radius)
    base = [rng.getrandbits(128) for _ in range(20)]
    prints = base + [p ^ sum(1 << b for b in rng.sample(range(128), rng.randint(0, 8))) for p in base for _ in range(12)]
    prints += base[:3] * 4
    rows = [simhash.halves(p.to_bytes(16)) for p in prints] + [(None, 1), (None, None)]
    got = simhash.within_radius(spark.createDataFrame(rows, "hi bigint, lo bigint").repartition(4), radius, blocks, bucket)
    near = {p: sum((p ^ q).bit_count() <= radius for q in prints) for p in set(prints)}
    assert ({(r["hi"], r["lo"]): (r["n"], r["n_near"]) for r in got.collect()}
            == {simhash.halves(p.to_bytes(16)): (prints.count(p), n) for p, n in near.items()})


def test_registered_fingerprints(spark):
    got = queries.op13_fingerprints(spark, SF)
    assert got.dtypes[:7] == [("doc_id", "bigint"), ("n_chars", "bigint"), ("edited_sha256", "string"), ("fingerprint", "string"),
                              ("edited_fingerprint", "string"), ("near_edited", "double"), ("near_next", "double")]
    rows = {r["doc_id"]: r for r in got.collect()}
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for ident, text, changed, _ in plain_edits(list(texts.items())):
        assert rows[ident]["edited_sha256"] == sha256(changed.encode()).hexdigest()
    assert sum(r["near_edited"] > r["near_next"] for r in rows.values()) >= 0.97 * len(rows)
