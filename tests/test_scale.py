"""Steps whose work per row is long, or whose passes are many."""

import json
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import rows
from spendlens.catalog.queries import QUERIES
from spendlens.functions import geo
from spendlens.llm import jaccard, tokenfile
from spendlens.operators import cluster


def test_distances_of_one_row_group_are_dealt(spark, tmp_path):
    made = spark.range(200).select(
        F.when(F.col("id") < 150, F.col("id")).alias("c_custkey"), (F.col("id") % 25).cast("int").alias("c_nationkey"),
        (F.col("id") * 7.5).alias("c_acctbal"))
    made.coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    found = QUERIES["distance_km"](spark, str(tmp_path))
    assert found.rdd.getNumPartitions() > 1
    assert found.where("km > 0").count() == 200 and found.where("c_custkey is null").count() == 50


@pytest.mark.parametrize("series, height", [
    (geo.ROOT, lambda u: np.sqrt(1 + u)),
    (geo.SLOWER, lambda u: (2 - geo.FLATTENING) / (1 + (1 - geo.FLATTENING) * np.sqrt(1 + u))),
])
def test_integrals_along_arcs(spark, series, height):
    """Against sums at many points."""
    random = np.random.default_rng(3)
    arcs = [(i, float(a), float(w), float(k)) for i, (a, w, k) in enumerate(zip(
        random.uniform(-4, 4, 40), [0.0, 1e-9, 3.14, *random.uniform(0, 3.14, 37)],
        [geo.SECOND_ECCENTRICITY, 0.0, geo.SECOND_ECCENTRICITY, *random.uniform(0, geo.SECOND_ECCENTRICITY, 37)]))]
    df = spark.createDataFrame(arcs, "i int, start double, width double, k2 double")
    arc = F.struct("start", "width", "k2")
    nodes, weights = np.polynomial.legendre.leggauss(40)
    for (_, start, width, k2), (_, got) in zip(arcs, rows(df.select("i", geo.along(arc, series)), "i")):
        want = width / 2 * (weights * height(k2 * np.sin(start + width / 2 * (1 + nodes)) ** 2)).sum()
        assert got == pytest.approx(want, abs=5e-15)


def star(spark, folder):
    """A few rows of each table behind the model."""
    n = spark.range(60)
    tables = {
        "region": spark.createDataFrame([(0, "EAST")], "r_regionkey int, r_name string"),
        "nation": spark.createDataFrame([(0, "A", 0), (1, "B", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": n.selectExpr("id as c_custkey", "concat('c', id) as c_name", "'X' as c_mktsegment", "cast(id % 2 as int) as c_nationkey"),
        "orders": n.selectExpr("id as o_orderkey", "id % 50 as o_custkey", "date'1996-01-02' as o_orderdate"),
        "lineitem": n.selectExpr(
            "id as l_orderkey", "id as l_partkey", "id as l_suppkey", "1 as l_linenumber", "'N' as l_returnflag",
            "double((id * id) % 97) as l_extendedprice", "date'1996-02-03' as l_shipdate"),
        "events": n.selectExpr("id as event_id", "id % 7 as user_id", "timestamp'1996-01-02 03:04:05' as ts"),
    }
    for name, table in tables.items():
        table.coalesce(1).write.parquet(f"{folder}/{name}.parquet")


def test_kmeans_fits_on_blocks_of_a_stored_model(spark, tmp_path, monkeypatch):
    """The fits iterate over blocks, and the joins behind the model run once."""
    star(spark, tmp_path)
    taken, fitted = [], []
    sweep, fit = cluster.kmeans_sweep, cluster.KMeans.fit
    monkeypatch.setattr(cluster, "kmeans_sweep", lambda df, **_: taken.append(df) or sweep(df, restarts=1))
    monkeypatch.setattr(cluster.KMeans, "fit", lambda self, df: fitted.append(self.getSolver()) or fit(self, df))
    summary = QUERIES["cluster_summary"](spark, str(tmp_path))
    plan = taken[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan
    assert fitted == ["block"] * len(cluster.SWEEP)
    assert summary.agg(F.sum("entities")).first()[0] == taken[0].count() == 60


def test_plain_words_go_to_the_model_alone():
    """Most words take the short way, and any chunk has the ids that the whole way gives it."""
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        memo = tokenfile.Memo(file.read())
    sent = []
    whole, encode = memo.tokenizer, memo._encode
    memo._encode = lambda new: sent.extend(new) or encode(new)
    plain = ["word", "Été", "straße", "andere", "ÿx"]
    odd = ["don't", "a1b22", "...", "İx", "ΣΣ", "ét", "中文", "µm", "×÷", "a.b,c", "ǅ"]
    chunks = {(w + m).encode().lower() for w in plain + odd for m in ("", ",", "!?")}
    memo.learn(chunks)
    memo.learn(chunks | {b"word;", b"again"})
    assert not set(sent) & {*plain, "word;", "again"} and "Été" not in sent
    for chunk in chunks | {b"word;", b"again"}:
        want = whole.encode(chunk.decode(), add_special_tokens=False).ids
        assert np.frombuffer(memo[chunk], "<u4").tolist() == want, chunk


def test_each_chunk_of_a_batch_is_looked_up_once(monkeypatch):
    """A batch's repeated chunks cost one look, and each text has the ids of its own chunks, wherever blanks stand."""
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        data = file.read()
    looked = []

    class Looked(tokenfile.Memo):
        def get(self, chunk, *rest):
            looked.append(chunk)
            return super().get(chunk, *rest)

    blanks = "".join(map(chr, [9, 10, 11, 12, 13, 32]))
    odd = f"a{blanks}B\x1cc\x85d\xa0e\u2003f\x00g"
    texts = ["the cat the CAT," * 50, "", f"{blanks}the\tcat{blanks}", odd, blanks, "x the"] * 3
    monkeypatch.setattr(tokenfile.Memo, "learn", lambda self, chunks, learn=tokenfile.Memo.learn: (looked.append(None), learn(self, chunks)))
    memo = Looked(data)
    for part in (pa.array(texts), pa.array(["skipped", *texts])[1:], pa.array(texts, pa.large_string())):
        looked.clear()
        got = memo.ids_of(part)
        first = looked[: looked.index(None)]
        assert len(first) == len(set(first)) == len({c for t in texts for c in t.encode().lower().split()})
        assert [np.frombuffer(x, "<u4").tolist() for x in got] == [memo.whole.encode(t, add_special_tokens=False).ids for t in texts]
    assert memo.ids_of(pa.array([], pa.string())) == [] and memo.ids_of(pa.array(["", blanks])) == [b"", b""]


def test_letters_that_a_tokenizer_parts_take_the_whole_way():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        data = json.load(file)
    data["pre_tokenizer"]["pretokenizers"].insert(0, {"type": "Split", "pattern": {"String": "q"}, "behavior": "Isolated", "invert": False})
    memo = tokenfile.Memo(json.dumps(data))
    memo.learn({b"aqua"})
    assert not memo.forms
    assert np.frombuffer(memo[b"aqua"], "<u4").tolist() == memo.tokenizer.encode("aqua", add_special_tokens=False).ids


def near_brute(rows):
    """(doc_id, n, component) by all pairs of rows."""
    sets, parent = [], list(range(len(rows)))
    for _, text in rows:
        words = text.split()
        sets.append({tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)})

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    lowest = {}
    for k, (doc, _) in enumerate(rows):
        lowest[find(k)] = min(doc, lowest.get(find(k), doc))
    return sorted(((doc, len(sets[k]), lowest[find(k)]) for k, (doc, _) in enumerate(rows)), key=repr)


def test_regions_part_where_sizes_allow_no_link(spark):
    """A shingle's documents of sizes too far apart share no region, and pairs need no further rounds."""
    rows = [(k, n, light, heavy) for k, (n, light, heavy) in enumerate([
        (10, [1], []), (12, [1], []), (100, [1], []), (101, [1], []), (125, [1], []), (300, [1], []),  # two parts and one alone
        (50, [2], [9]), (90, [2, 3], [9]), (91, [3], [9]), (30, [3], []), (40, [], [8]), (41, [], [8])], 1)]
    sets = spark.createDataFrame(rows, "key long, n int, light array<long>, heavy array<long>")
    got = {(r.pivot, r.key): r.busy for r in jaccard.regions(sets).collect()}
    assert got == {(1, 2): False, (3, 4): True, (3, 5): True, (8, 9): False, (7, 8): True, (7, 9): True, (11, 12): False}


def test_classes_of_texts_that_share_lines(spark):
    """Links are those of a plain comparison where many texts of many sizes share passages."""
    draw = random.Random(5)
    lines = [" ".join(f"l{k}-{i}" for i in range(12)) for k in range(25)]
    rows = []
    for k in range(80):
        words = " ".join(draw.sample(lines, draw.choice([1, 1, 2, 4, 8, 16]))).split()
        for _ in range(draw.choice([0, 0, 1, 3])):
            words[draw.randrange(len(words))] = f"e{draw.randrange(9)}"
        rows.append((k % 70, " ".join(words)))
    for k in range(20):  # near copies of sizes that grow step by step
        rows.append((200 + k, " ".join(f"c{i}" for i in range(40 + 4 * k))))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert sorted(map(tuple, jaccard.near_classes(df).collect()), key=repr) == near_brute(rows)


def test_no_round_without_regions_to_part(spark, tmp_path, monkeypatch):
    """Tables whose regions are pairs, or are linked as one, start no round: each costs plans, threads and files."""
    stored = []
    monkeypatch.setattr(jaccard, "materialize", lambda df, label, store=jaccard.materialize: stored.append(label) or store(df, label))
    lone = lambda k: " ".join(f"p{k}-{i}" for i in range(30))
    rows = [(k, lone(k // 2)) if k % 4 else (k, f"{lone(k // 2)} more") for k in range(12)]
    rows += [(20 + k, f"{lone('x')} {'e' * k}") for k in range(1, 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, jaccard.near_classes(df).collect()), key=repr) == near_brute(rows)
    assert stored.count("chosen") == 1 and "pairs" not in stored
