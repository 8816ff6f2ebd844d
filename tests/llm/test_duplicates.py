"""SimHash near-duplicates and repeat removal against plain versions."""

import random

import __spark_entry__ as contract
import pytest
from llm_brute import components, covered, edge_table, edge_texts, fingerprint, prose, repeat_row
from pressflow.llm import repeats, simhash
from tests_paths import SMALL


def docs(spark, sf_dir=SMALL):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]


def test_simhash_of_documents(spark):
    rows = docs(spark)
    got = {r["doc_id"]: r for r in contract.queries()["op5_simhash"](spark, SMALL).collect()}
    fps = {i: fingerprint(t) for i, t in rows}
    assert {i: r["fingerprint"] for i, r in got.items()} == {i: f"{f:016x}" for i, f in fps.items()}
    ids = sorted(fps)
    linked = [(a, b) for k, a in enumerate(ids) for b in ids[:k] if (fps[a] ^ fps[b]).bit_count() <= 2]
    assert {i: r["component_id"] for i, r in got.items()} == components(ids, linked)


@pytest.mark.parametrize("segments", [4, 10, 12])
def test_links_lose_no_pair(spark, segments):
    rng = random.Random(5)
    values = {rng.getrandbits(64) for _ in range(40)}
    for v in list(values):
        values |= {v ^ 1 << rng.randrange(64) for _ in range(2)}
        values |= {v ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64) for _ in range(3)}
    signed = [v - (1 << 64) if v >> 63 else v for v in values | {0, 1, 3, 7, (1 << 64) - 1}]
    got = simhash.links(spark.createDataFrame([(v,) for v in set(signed)], "fp long"), segments=segments)
    pairs = {frozenset((r["a"], r["b"])) for r in got.collect()}
    mask = (1 << 64) - 1
    expected = {frozenset((a, b)) for a in signed for b in signed if a != b and ((a ^ b) & mask).bit_count() <= 2}
    assert pairs == expected


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(7, i) for i in range(200, 260)]
    got = simhash.components(spark.createDataFrame(chain + star + [(7, 3), (7, 3), (9, 9)], "a long, b long"))
    roots = {r["node"]: r["root"] for r in got.collect()}
    assert {roots[i] for i in range(100, 141)} == {100}
    assert {roots[i] for i in [7, 3, *range(200, 260)]} == {3}
    assert 9 not in roots and got.count() == len(roots)


def test_links_broadcast_no_probes(spark, tmp_path):
    spark.range(2000).selectExpr("xxhash64(id) AS fp").write.parquet(f"{tmp_path}/points")
    found = simhash.links(spark.read.parquet(f"{tmp_path}/points"))
    found.collect()
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_simhash_of_edge_cases(spark):
    df = edge_table(spark)
    got = [(r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(df).collect()]
    assert sorted(f for _, f, _ in got) == sorted(f"{fingerprint(t):016x}" for _, t in edge_texts())
    of = {i: c for i, _, c in got if i is not None}
    assert of[1] == of[2] == of[3] == 1 and of[5] == of[6] == 5 and of[14] == 11
    assert simhash.near_duplicates(df.limit(0)).count() == 0
    kept = simhash.one_of_each(df)
    assert kept.columns == df.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(5) == 1 and 6 not in ids and 1 in ids and 2 not in ids and ids.count(None) == 1
    assert len(ids) == len({c if c is not None else f for _, f, c in got})
    assert simhash.one_of_each(df.limit(0)).count() == 0


def check_repeats(rows, got):
    data, marks = covered([t for _, t in rows])
    expected = sorted(repeat_row(d, m) for d, m in zip(data, marks, strict=True))
    from hashlib import sha256
    found = sorted((r["n_bytes"], r["n_bytes"] - len(r["kept"]), len(r["spans"]), sha256(r["kept"]).hexdigest())
                   for r in got)
    assert found == expected


def test_repeats_of_documents(spark):
    rows = docs(spark)
    got = contract.queries()["op6_suffix_dedup"](spark, SMALL).collect()
    data, marks = covered([t for _, t in rows])
    expected = {i: repeat_row(d, m) for (i, _), d, m in zip(rows, data, marks, strict=True)}
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got} == expected


def test_repeats_of_edge_cases(spark):
    df = edge_table(spark)
    got = repeats.without_repeats(df)
    assert {r["row"] for r in got.collect()} == {"own"}
    check_repeats(edge_texts(), got.collect())
    assert repeats.without_repeats(df.limit(0)).count() == 0
    text = repeats.without_repeats(df, as_text=True)
    assert text.where("kept IS NULL").count() == 0


def test_repeats_at_every_border(spark):
    rng = random.Random(3)
    base = prose(1, 400)
    rows = []
    for k in range(60):  # stretches of one text, some just under and over the length, in other text
        a, n = rng.randrange(1200), rng.choice([198, 199, 200, 201, 260, 400])
        rows.append((k, prose(100 + k, 20)[:rng.randrange(140)] + base[a:a + n] + prose(200 + k, 9)[:rng.randrange(60)]))
    rows += [(100, "abc" * 300), (101, "abc" * 90 + "x"), (102, "é" * 150), (103, "é" * 150 + "z"), (104, base)]
    got = repeats.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    check_repeats(rows, got)


def test_anchors_stand_for_all_starts():
    for data in (prose(9, 200).encode(), b"ab" * 300, b"x" * 200):
        found = repeats.anchors(data)
        starts = sorted(p - d for p, low, high in found.tolist() for d in range(low, high + 1))
        assert starts == list(range(len(data) - 199))
    assert len(repeats.anchors(b"short")) == 0
