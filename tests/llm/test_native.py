"""Line dedup and sharding against SQL and plain Python; neither runs Python code on executors."""

import hashlib
from collections import Counter, defaultdict

import pytest

from pyspark.sql import functions as F

from panelspark.llm import line_dedup, sharding
from panelspark.llm.queries import ORACLES, QUERIES

from cases import edge_docs, edge_rows, empty_docs, pairs
from oracle import compare, connect

SF = "/root/testdata/sf0.001"
WHITE = " \t\n\x0b\f\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize("name", list(ORACLES))
def test_matches_sql(spark, name):
    df = QUERIES[name](spark, SF)
    state, detail = compare(df, connect(SF), ORACLES[name])
    assert state == "ok", detail
    plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def plain_dedup(rows, min_chars, min_docs):
    holders = defaultdict(set)
    low = -(2 ** 63)
    for i, t in rows:
        for line in (t or "").split("\n"):
            key = line.strip(WHITE).translate(LOWER)
            if len(key) >= min_chars:
                holders[key].add(low if i is None else i)
    out = []
    for i, t in rows:
        kept, lines = [], (t or "").split("\n")
        for line in lines:
            found = holders.get(line.strip(WHITE).translate(LOWER), ())
            if len(found) < min_docs or max(found) == (low if i is None else i):
                kept.append(line)
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return Counter(out)


@pytest.mark.parametrize("min_chars, min_docs", [(20, 3), (1, 2), (3, 1)])
def test_line_dedup_equals_plain_python(spark, min_chars, min_docs):
    docs = edge_docs(spark)
    got = line_dedup.dedup_lines(docs, min_chars=min_chars, min_docs=min_docs)
    assert set(got.columns) == {*docs.columns, "n_dropped"}
    rows = got.select("doc_id", "n_lines", "n_dropped", "text", "key").collect()
    assert Counter(tuple(r)[:4] for r in rows) == plain_dedup(pairs(edge_rows()), min_chars, min_docs)
    assert all(r.key == "clash" for r in rows)
    assert line_dedup.dedup_lines(empty_docs(spark)).count() == 0


def test_hilbert_curve_visits_every_cell_by_single_steps(spark):
    bits = 3
    cells = spark.range(2 ** (3 * bits)).select(*[
        F.shiftright("id", bits * i).bitwiseAND(2 ** bits - 1).cast("int").alias(f"a{i}") for i in range(3)])
    copies = cells.select("*", *[F.col(f"a{i}").alias(f"c{i}") for i in range(3)])
    rows = sharding.hilbert_index(copies, ["a0", "a1", "a2"], bits, "curve").orderBy("curve").collect()
    assert [r.curve for r in rows] == list(range(2 ** (3 * bits)))
    assert all(sum(abs(a[f"c{i}"] - b[f"c{i}"]) for i in range(3)) == 1 for a, b in zip(rows, rows[1:]))


@pytest.mark.parametrize("shards", [1, 4, 100])
def test_shards_are_even_and_slots_gapless(spark, shards):
    docs = edge_docs(spark).withColumn("size", F.octet_length("text"))
    got = sharding.hilbert_shards(docs, ["source", "lang", "size"], shards, ["doc_id"])
    assert set(got.columns) == {*docs.columns, "curve", "slot"}
    rows = got.collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter(pairs(edge_rows()))
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    sizes = [len(slots[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    order = sorted(rows, key=lambda r: (r.shard, r.slot))
    assert [r.curve for r in order] == sorted(r.curve for r in rows)
    empty = empty_docs(spark).withColumn("size", F.octet_length("text"))
    assert sharding.hilbert_shards(empty, ["source", "size"], shards).count() == 0


def test_written_shards_hold_a_narrow_range_of_every_dimension(spark, tmp_path):
    docs = spark.range(4096).select((F.col("id") % 64).alias("x"), F.floor(F.col("id") / 64).alias("y"), "id")
    sharded = sharding.hilbert_shards(docs, ["x", "y"], 16, ["id"])
    sharding.write_shards(sharded, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    spans = back.groupBy("shard").agg((F.max("x") - F.min("x")).alias("x"), (F.max("y") - F.min("y")).alias("y")).collect()
    assert len(spans) == 16 and all(s.x < 16 and s.y < 16 for s in spans)


def test_digest_of_an_emptied_text(spark):
    rows = [(i, "a line that many documents hold") for i in (1, 2, 3)]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string"))
    found = {r[0]: r[1] for r in got.select("doc_id", F.sha2("text", 256)).collect()}
    assert found[1] == found[2] == hashlib.sha256(b"").hexdigest() != found[3]
