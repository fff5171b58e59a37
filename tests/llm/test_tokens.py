"""Token counts, packing and BPE against the tokenizers library itself."""

import hashlib
import itertools
import random
import sys
import time
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from panelspark import session
from panelspark.llm import arrow, bpe, packing, token_counts
from panelspark.llm.token_counts import load

from cases import edge_docs, edge_rows, empty_docs, pairs

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")


def library(path, text):
    return load(path).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("head", [0, 3, 100_000])
def test_counts_equal_the_library(spark, head):
    got = token_counts.token_counts(edge_docs(spark), WORD, head_rows=head).collect()
    wanted = Counter((i, len((t or "").encode()), len(library(WORD, t))) for i, t in pairs(edge_rows()))
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == wanted
    assert token_counts.token_counts(empty_docs(spark), WORD).count() == 0


def test_every_ascii_space_splits_like_the_library():
    for space in " \t\n\x0b\f\r":
        text = f"Ab{space}c'd{space}{space}<|endoftext|>{space}9"
        assert token_counts.WordEncoder(WORD).encode(text.encode()) == token_counts.packed(library(WORD, text))


def batches_of(texts, rows):
    return iter(pa.RecordBatch.from_arrays([pa.array(texts[at:at + rows], pa.binary())], ["t"])
                for at in range(0, len(texts), rows))


@pytest.mark.parametrize("flush, at_once", [(0, 1), (7, 3), (10 ** 6, 1024)])
def test_words_are_counted_like_bytes_are_split(monkeypatch, flush, at_once):
    monkeypatch.setattr(token_counts, "FLUSH", flush)
    monkeypatch.setattr(token_counts, "TEXTS_AT_ONCE", at_once)
    monkeypatch.setattr(token_counts, "BATCH_WORDS", 5)
    rng = random.Random(3)
    units = [b"a", b"bc", b"\xc3\xa9", b"\xff", b"\x00", b"\x1c", b"\x85", b"\xc2\xa0", *[bytes([c]) for c in b" \t\n\r\x0b\x0c"]]
    texts = [b"".join(rng.choices(units, k=rng.randint(0, 30))) for _ in range(50)] + [b"", b"  ", b" a "]
    got, known = Counter(), [b"a", b"bc", b"\xc3\xa9"]
    for batch in token_counts.word_frequencies(batches_of(texts, 20)):
        assert batch.num_rows <= 5
        for row in batch.to_pylist():
            got[row["word"]] += row["n"]
    assert got == Counter(w for t in texts for w in t.split())
    head, offsets, words, times = token_counts.count_known(pa.array(texts, pa.binary()), pa.array(known), np.array([1, 20, 300]))
    pieces = dict(zip(known, (1, 20, 300)))
    assert head.tolist() == [sum(pieces.get(w, 0) for w in t.split()) for t in texts]
    assert [dict(zip(words[a:b].to_pylist(), times[a:b])) for a, b in zip(offsets, offsets[1:])] == [
        Counter(w for w in t.split() if w not in pieces) for t in texts]
    none, offsets, _, times = token_counts.count_known(pa.array([b"", b"a a"]), pa.array([], pa.binary()), np.zeros(0, np.int64))
    assert (none.tolist(), offsets.tolist(), times.tolist()) == ([0, 0], [0, 0, 1], [2])


def test_counting_words_holds_no_python_object_for_each():
    texts = [b" ".join(b"%x" % (word * 7919) for word in range(at, at + 400)) for at in range(0, 200_000, 400)]
    tracemalloc.start()
    try:
        words = sum(batch.num_rows for batch in token_counts.word_frequencies(batches_of(texts, 500)))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert words == 200_000
    assert peak < 40 * words  # an entry of a dict with its key takes over 100 bytes


def test_small_batches_bound_what_python_gets_and_put_settings_back(spark, tmp_path):
    spark.range(3000, numPartitions=1).selectExpr("id", "repeat('ab ', 2000) AS t").write.parquet(f"{tmp_path}/t")
    names = list(session.SMALL_BATCHES)
    before = [spark.conf.get(name) for name in names]

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes], pa.int64())], ["n"])

    def largest():
        return max(r.n for r in spark.read.parquet(f"{tmp_path}/t").mapInArrow(sizes, "n bigint").collect())

    assert largest() > 16 << 20
    with pytest.raises(KeyError), session.small_batches(spark):
        assert largest() < 3 << 20
        raise KeyError
    assert [spark.conf.get(name) for name in names] == before


def test_plain_words_equal_the_library():
    rng = random.Random(6)
    letters = [chr(c) for c in (*range(65, 91), *range(97, 123), *range(192, 215), *range(216, 247), *range(248, 256))]
    marks = [chr(c) for c in range(33, 127) if not chr(c).isalnum()]
    encoder = token_counts.WordEncoder(WORD)
    for _ in range(3000):
        word = "".join(rng.choices(letters, k=rng.randint(0, 12))) + "".join(rng.choices(marks, k=rng.randint(0, 4)))
        word = rng.choice([word, word + rng.choice(letters), rng.choice(marks) + word, word + "7", word + "\u0301"])
        if word:
            assert encoder.word(word.encode()) == token_counts.packed(library(WORD, word)), word


def test_texts_together_equal_the_library_in_one_call_of_the_model(monkeypatch):
    rng = random.Random(8)
    alphabet = "aAzZéÉßÿ×÷'.!<|>09 \t\n\r\x0b\x0c\x1c\x85\u2028\u00a0東İſ́\x00\ufffd"
    encoder, asked = token_counts.WordEncoder(WORD), []
    make = encoder._parts
    monkeypatch.setattr(encoder, "_parts", lambda texts: asked.append(texts) or make(texts))
    monkeypatch.setattr(encoder, "_part", None)  # no plain part goes to the model by itself
    for _ in range(300):
        texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 40))) for _ in range(rng.randint(1, 9))]
        texts += ["<|endoftext|>a", "don't we'll", "x" * 70 + "é" * 70 + "!" * 80, "", "x" * 70]
        assert list(encoder.encode_all([t.encode() for t in texts])) == [
            token_counts.packed(library(WORD, t)) for t in texts]
    assert len(asked) == 300
    assert max(Counter(p for parts in asked for p in parts if len(p) <= arrow.LONGEST).values()) == 1
    assert list(encoder.encode_all([])) == []


def test_bytes_are_cut_like_words():
    """Words with lone bytes, which no text of Python holds, are cut as their replacement by the library's decoder."""
    rng = random.Random(12)
    units = [b"a", b"Z", b"\xc3\x89", b"\xc3\x97", b"\xc3\x9f", b"\xc3\x9e", b"!", b"'", b"~", b"7", b"\xc3", b"\xa9", b"\xe6\x9d\xb1", b"\xff"]
    words = [b"".join(rng.choices(units, k=rng.randint(0, 5))) for _ in range(4000)] + [b"a\xc3", b"\xa9b", b""]
    encoder = token_counts.WordEncoder(WORD)
    wanted = [token_counts.packed(library(WORD, w.decode("utf-8", "replace"))) for w in words]
    assert encoder.encode_words(pa.array(words, pa.binary())).to_pylist() == wanted
    letters, marks, plain = token_counts.cut(np.frombuffer(b"".join(words), np.uint8), np.cumsum([0, *map(len, words)]))
    matches = [token_counts.PLAIN.match(w.decode("utf-8", "replace")) for w in words]
    assert [(a.decode(), b.decode(), c) for a, b, c in zip(letters.to_pylist(), marks.to_pylist(), plain)] == [
        (m[1].lower(), m[2], True) if m else ("", "", False) for m in matches]


def test_words_are_cut_in_bounded_lots(monkeypatch):
    monkeypatch.setattr(token_counts, "WORDS_AT_ONCE", 3)
    monkeypatch.setattr(token_counts, "PARTS_AT_ONCE", 2)
    texts = ["a b! c d", "", "e a 7 f東 don't", " g "]
    assert list(token_counts.WordEncoder(WORD).encode_all([t.encode() for t in texts])) == [
        token_counts.packed(library(WORD, t)) for t in texts]


def test_plain_words_cost_no_python_call_each():
    words = [b"w%s%s" % (bytes([97 + i % 26, 97 + i // 26 % 26, 97 + i // 676]), b"!" * (i % 3)) for i in range(8000)]
    encoder, calls = token_counts.WordEncoder(WORD), []
    sys.setprofile(lambda frame, event, arg: calls.append(event))
    try:
        found = list(encoder.encode_all([b" ".join(words)]))
    finally:
        sys.setprofile(None)
    assert len(calls) < len(words) / 2
    assert found == [token_counts.packed(library(WORD, b" ".join(words).decode()))]


def test_columns_keep_what_was_asked_for_last():
    made = []

    def make(keys):
        made.extend(keys.to_pylist())
        return pa.array([k * 2 for k in keys.to_pylist()], pa.large_binary())

    known = arrow.RememberedColumn(4 * (1 + 2 + 12))  # bytes of four entries
    for asked in ([b"1", b"2"], [b"3", b"4", b"1"], [b"5"], [b"1", b"2"], [b"x" * 65], [], [b"5", b"x" * 65]):
        assert known.all_of(pa.array(asked, pa.binary()), make).to_pylist() == [k * 2 for k in asked]
        assert len(known.keys) == len(known.values) <= 4
    assert made == [b"1", b"2", b"3", b"4", b"5", b"2", b"x" * 65, b"x" * 65]


def test_portions_hold_every_row(monkeypatch):
    monkeypatch.setattr(packing, "PORTION", 5)
    rows = [{"__bp_text": b"x" * n} for n in (0, 2, 3, 9, 0, 1)]
    assert [[len(r["__bp_text"]) for r in portion] for portion in packing.portions(iter(rows))] == [[0, 2, 3], [9], [0, 1]]


def test_remembered_values_are_bounded_and_kept_while_used():
    made = []
    known = arrow.Remembered(lambda k: made.append(k) or k * 2, 6 * (arrow.ENTRY + 3))  # bytes of three entries and three older
    for key in (b"1", b"2", b"3", b"1", b"4", b"1", b"5", b"1", b"6", b"1", b"2"):
        assert known[key] == key * 2
        assert len(known) <= 3 and len(known.older) <= 3
    assert made == [b"1", b"2", b"3", b"4", b"5", b"6", b"2"]


@pytest.mark.parametrize("group_rows", [4, 10_000])
def test_packing_keeps_every_id(spark, group_rows):
    limit = 64
    got = packing.pack_documents(edge_docs(spark), WORD, limit=limit, group_rows=group_rows, with_ids=True).collect()
    wanted = Counter()
    for i, t in pairs(edge_rows()):
        ids = library(WORD, t) + [0]
        for at in range(0, len(ids), limit):
            wanted[i, at // limit, at, tuple(ids[at:at + limit])] += 1
    assert Counter((r.doc_id, r.piece, r.start, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in got) == wanted
    assert all(r.ids_crc32 == zlib.crc32(r.ids) and r.length == len(r.ids) // 4 for r in got)
    check_sequences([(r.sequence_id, r.offset, r.length) for r in got], limit)
    assert packing.pack_documents(empty_docs(spark), WORD).count() == 0


def check_sequences(rows, limit):
    bins = defaultdict(list)
    for sequence, offset, length in rows:
        bins[sequence].append((offset, length))
    for items in bins.values():
        place = 0
        for offset, length in sorted(items):
            assert offset == place
            place += length
        assert place <= limit
    return len(bins)


def test_local_search_reaches_the_least_number_of_bins():
    rng = random.Random(1)
    for _ in range(30):
        full = []
        for _ in range(20):  # bins that can be filled exactly
            a, b = sorted(rng.sample(range(1, 100), 2))
            full += [n for n in (a, b - a, 100 - b) if n]
        number, offset = packing.pack(full, 100)
        bins = check_sequences(list(zip(number.tolist(), offset.tolist(), full)), 100)
        assert bins <= 21


def offered(giver, takers):
    offers = packing.Offers(100)
    for b, (free, items) in enumerate(takers):
        offers.put(b, free, Counter(items))
    return offers.best(Counter(giver))


def test_best_offers_are_moves_and_exchanges():
    assert offered([30], [(30, [20])]) == (0, (30,), ())
    assert offered([30], [(10, [20])]) == (0, (30,), (20,))
    assert offered([6, 8], [(4, [10])]) == (0, (6, 8), (10,))
    assert offered([25], [(5, [10, 10])]) == (0, (25,), (10, 10))
    assert offered([4], [(3, [])]) is None
    assert offered([30], [(10, [20]), (11, [19]), (40, [5])]) == (2, (30,), ())
    assert offered([7, 7], [(13, [90])]) == (0, (7,), ())  # no pair fits, one of them does


def some_exchange_helps(bins, lengths):
    """Whether some move or exchange between two underfull bins raises the fill of the one at least as full."""
    ways = {b: [(sum(lengths[i] for i in part), len(part)) for size in (0, 1, 2)
                for part in itertools.combinations(items, size)] for b, items in enumerate(bins.items)}
    return any(0 < out - back <= bins.free[t] and (m, n) != (2, 2)
               for g, t in itertools.permutations(ways, 2)
               if bins.items[g] and bins.items[t] and 0 < bins.free[t] <= bins.free[g]
               for out, m in ways[g] for back, n in ways[t])


def test_search_ends_where_no_exchange_helps():
    rng = random.Random(4)
    for _ in range(20):
        lengths = [rng.randint(25, 70) for _ in range(40)]
        bins = packing.Bins(100)
        for item, length in enumerate(lengths):
            bins.open(item, length)
        packing.local_search(bins, lengths, 0)
        assert not some_exchange_helps(bins, lengths)


def least_bins(lengths, limit):
    """Fewest bins by trying every place of every piece."""
    best = len(lengths)

    def place(at, free):
        nonlocal best
        if len(free) >= best:
            return
        if at == len(lengths):
            best = len(free)
            return
        for b in range(len(free)):
            if free[b] >= lengths[at]:
                place(at + 1, free[:b] + [free[b] - lengths[at]] + free[b + 1:])
        place(at + 1, free + [limit - lengths[at]])

    place(0, [])
    return best


def test_small_groups_come_near_the_fewest_bins():
    rng = random.Random(5)
    extra = 0
    for _ in range(60):
        lengths = [rng.randint(10, 70) for _ in range(rng.randint(1, 9))]
        extra += len(set(packing.pack(lengths, 100)[0].tolist())) - least_bins(lengths, 100)
    assert 0 <= extra <= 1


def test_many_pieces_that_best_fit_packs_badly():
    rng = random.Random(0)
    lengths = [rng.randint(600, 1100) for _ in range(3000)]
    start = time.process_time()
    number, offset = packing.pack(lengths, 2048)
    assert time.process_time() - start < 20
    assert check_sequences(list(zip(number.tolist(), offset.tolist(), lengths)), 2048) <= 1348


def squares(bins, limit):
    return sum((limit - f) ** 2 for f, items in zip(bins.free, bins.items) if items)


def test_search_raises_squared_fill_and_keeps_items():
    rng = random.Random(2)
    limit, lengths = 100, [rng.randint(5, 60) for _ in range(120)]
    bins = packing.Bins(limit)
    for item, length in enumerate(lengths):  # a poor start: next fit
        if bins.items and bins.free[-1] >= length:
            bins.change(len(bins.items) - 1, [], [item], lengths)
        else:
            bins.open(item, length)
    before, opened = squares(bins, limit), len(bins.items)
    packing.local_search(bins, lengths, -(-sum(lengths) // limit))
    assert squares(bins, limit) > before
    assert sorted(i for items in bins.items for i in items) == list(range(120))
    assert all(limit - sum(lengths[i] for i in items) == f >= 0 for items, f in zip(bins.items, bins.free))
    assert sum(1 for items in bins.items if items) < opened


def test_bpe_round_trip_equals_the_library(spark):
    got = bpe.encode_documents(edge_docs(spark), BYTE, with_ids=True).collect()
    wanted = Counter()
    for i, t in pairs(edge_rows()):
        ids = library(BYTE, t)
        decoded = load(BYTE).decode(ids, skip_special_tokens=False)
        wanted[i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
               hashlib.sha256(decoded.encode()).hexdigest(), tuple(ids)] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256, tuple(np.frombuffer(r.ids, "<u4").tolist()))
                   for r in got) == wanted
    assert bpe.encode_documents(empty_docs(spark), BYTE).count() == 0


def test_joins_are_repaired_wherever_a_text_is_cut():
    rng = random.Random(4)
    bits = [" ", "  ", "\n", "\n\n ", "a", "the", "'s", "'", "don't", "é", " ", "　", "東京", "🙂", "12", "<|endoftext|>",
            "<|end", "oftext|>", "!!", "\t", "x" * 40, ". "]
    for _ in range(300):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(1, 40)))
        places = sorted(rng.sample(range(len(text) + 1), min(len(text), rng.randint(0, 6))))
        parts = [text[a:b].encode() for a, b in zip([0, *places], [*places, len(text)]) if a < b]
        ids = bpe.repair(BYTE, bpe.encode_chunks(BYTE, parts)).tolist()
        assert ids == library(BYTE, text), (text, places)


def test_equal_passages_give_equal_chunks():
    rng = random.Random(5)
    passage = bytes(rng.choice(b"abcdefgh ,.") for _ in range(6000))
    first = bpe.cut(b"some start " + passage)
    second = bpe.cut(b"quite another and longer start " * 9 + passage + b" end")
    assert b"".join(first) == b"some start " + passage
    assert len(set(first) & set(second)) >= len(first) - 3
    assert bpe.cut(b"") == [] and bpe.cut(b"abc") == [b"abc"]
    assert "".join(c.decode() for c in bpe.cut(("東京é" * 2000).encode())) == "東京é" * 2000


def test_plain_text_is_encoded_like_the_library():
    rng = random.Random(7)
    bits = [" ", "  ", "\n", "\r\n", "\t", " \n ", "a", "The", "été", "Straße", "'s", "'", "'ll", "'LL", "12", "3.5", "<", "<b>",
            "!!", "%%%", "_", "~", "|", "|>", "endoftext", "é", "ÿ", "×", "«", "<|endoftext|>"]
    encoder = bpe.ChunkEncoder(BYTE)
    for _ in range(3000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(1, 25)))
        assert np.frombuffer(encoder.encode(text.encode()), encoder.kind).tolist() == library(BYTE, text), text
