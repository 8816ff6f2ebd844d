"""Language-model scores, search and chat formatting."""

import zlib

import __spark_entry__ as contract
import numpy as np
import pytest
from llm_brute import base_scores, bm25, edge_table, edge_texts, prose
from pressflow.llm import chat, pitman_yor, search
from pressflow.llm.catalogue import remainder
from pyspark.sql import functions as F
from tests_paths import SMALL

MEDIUM = "/root/testdata/sf0.01"


def fold(i, modulus):
    return zlib.crc32(str(i).encode()) % modulus == 1


def test_scores_of_documents(spark):
    got = contract.queries()["op3_lm_scores"](spark, MEDIUM).toPandas()
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").collect()]
    expected = base_scores(rows, lambda i: fold(i, 5))
    assert len(got) == len(expected)
    for r in got.itertuples():
        held_out, n, known, total, base = expected[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held_out, n, known, total)
        assert r.base_score == pytest.approx(base)
    held_out = got[got["held_out"]]
    assert held_out["score"].sum() > held_out["base_score"].sum()


def test_scores_of_edge_cases(spark, tmp_path):
    edge_table(spark).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    got = pitman_yor.score_texts(df, F.col("doc_id") == 5)
    assert got.count() == len(edge_texts()) and got.where("score IS NULL OR score > 0").count() == 0
    empty = got.where("doc_id IN (1, 2, 3)").collect()
    assert {(r["n_tokens"], r["score"]) for r in empty} == {(1, empty[0]["score"])}
    nothing = pitman_yor.score_texts(df, F.lit(True))
    assert {(r["n_known"], r["train_tokens"]) for r in nothing.collect()} == {(0, 0)}
    assert pitman_yor.score_texts(df.limit(0), F.lit(False)).count() == 0


def test_scores_depend_on_the_order_of_words(spark, tmp_path):
    fluent = " ".join(f"w{k}" for k in range(40))
    shuffled = " ".join(f"w{k * 7 % 40}" for k in range(40))
    rows = [(k, fluent) for k in range(20)] + [(100, fluent), (101, shuffled)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    got = {r["doc_id"]: r for r in pitman_yor.score_texts(df, F.col("doc_id") >= 100).collect()}
    assert got[100]["base_score"] == pytest.approx(got[101]["base_score"])
    assert got[100]["score"] > got[101]["score"] + 20


ODD = [b"", b" ", b"Word", b"a\x0bb\x0c C\r\nD\t", b"\x00 \x00\x00 \x1f", "É é\u00a0x \u2003".encode(), b"exactly8 exactly8b",
       b"x" * 1000 + b" " + b"x" * 1001 + b" " + b"x" * 999 + b"Y", b"12345678" * 2 + b" 12345678", b" a  b "]


def test_words_of_texts():
    raw, starts, sizes, keys, counts = pitman_yor._words(ODD)
    expected = [[*text.lower().split(), b""] for text in ODD]
    found = [raw[a:a + n].tobytes() for a, n in zip(starts, sizes, strict=True)]
    assert found == sum(expected, []) and counts.tolist() == list(map(len, expected))
    assert len(set(zip(found, keys.tolist()))) == len(set(found)) == len(set(keys.tolist()))


@pytest.mark.parametrize("part_bytes", [1, 1 << 20])
def test_blocks_are_one_row_each(spark, monkeypatch, part_bytes):
    from types import SimpleNamespace

    import pyarrow as pa

    monkeypatch.setattr(pitman_yor, "PART_BYTES", part_bytes)
    monkeypatch.setattr(pitman_yor, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 3)))
    texts = ODD * 3
    batch = pa.RecordBatch.from_pydict(
        {"doc": list(range(len(texts))), "held_out": [k % 4 == 1 for k in range(len(texts))], "data": texts})
    rows = list(pitman_yor._rows(pitman_yor._coded(iter([batch]))))
    assert [r["block"] for r in rows] == [3 << 20] and rows[0]["docs"] == list(range(len(texts)))
    raw, starts, sizes, _ = pitman_yor._named(rows[0])
    words = [raw[a:a + n].tobytes() for a, n in zip(starts, sizes, strict=True)]
    ids = pitman_yor._unpack(rows[0]["ids"], np.int32)
    assert [words[i] for i in ids] == [w for t in texts for w in [*t.lower().split(), b""]]
    counts = {w.as_py(): n.as_py() for b in pitman_yor._block_words(pa.Table.from_pylist(rows).to_batches())
              for w, n in zip(b.column("word"), b.column("n"), strict=True)}
    learned = [w for k, t in enumerate(texts) if k % 4 != 1 for w in [*t.lower().split(), b""]]
    assert counts == {w: learned.count(w) for w in words}


def test_texts_are_read_once(spark, monkeypatch):
    monkeypatch.setattr(pitman_yor, "BLOCK_BYTES", 300)

    def shuffled(batches):  # other rows in other order at each reading
        import pyarrow as pa
        rows = [row for batch in batches for row in batch.to_pylist()]
        order = np.random.default_rng().permutation(len(rows))
        yield pa.RecordBatch.from_pylist([rows[k] for k in order], pa.schema([("doc_id", pa.int64()), ("text", pa.string())]))

    rows = [(k, " ".join(f"w{k * j % 37}" for j in range(k % 23))) for k in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).mapInArrow(shuffled, "doc_id long, text string")
    got = pitman_yor.score_texts(df, F.col("doc_id") % 5 == 1).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in got} == {k: len(text.split()) + 1 for k, text in rows}
    expected = base_scores(rows, lambda k: k % 5 == 1)
    assert all(r["base_score"] == pytest.approx(expected[r["doc_id"]][4]) for r in got)


def test_next_words_sum_to_one(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(pitman_yor, "BLOCK_BYTES", 400)
    rng = np.random.default_rng(5)
    kinds = [*(f"v{k}" for k in range(12)), "never"]
    learned = [(k, " ".join(rng.choice(kinds[:-1], 15))) for k in range(60)]
    asked = ["", *kinds, *(f"{a} {b}" for a in kinds for b in kinds)]
    rows = learned + [(100 + k, text) for k, text in enumerate(asked)]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(2).write.parquet(str(tmp_path / "t"))
    got = pitman_yor.score_texts(spark.read.parquet(str(tmp_path / "t")), F.col("doc_id") >= 100).collect()
    p = {asked[r["doc_id"] - 100]: 10 ** r["score"] for r in got if r["doc_id"] >= 100}
    # chances of the next word, each times the chance that the text ends after it: a similar matrix
    n = len(kinds)
    chances = np.ones((n + 1, n + 1))
    chances[n, n] = p[""]
    for i, a in enumerate(kinds):
        chances[n, i] = p[a]
        chances[i, :n] = [p[f"{a} {b}"] / p[a] for b in kinds]
    assert max(abs(np.linalg.eigvals(chances))) == pytest.approx(1, abs=1e-5)


def test_orders_and_groups():
    rng = np.random.default_rng(2)
    for values in (rng.integers(0, 50, 3000), rng.integers(0, 2 ** 62, 3000), np.empty(0, np.int64), np.array([7])):
        assert pitman_yor._order(values).tolist() == np.argsort(values, kind="stable").tolist()
        for found in (pitman_yor._grouped(values), pitman_yor._ranked(values)):
            expected = np.unique(values, return_inverse=True)
            assert all(x.tolist() == y.tolist() for x, y in zip(found, expected, strict=True))
    first, second = rng.integers(0, 9, (2, 100))
    assert np.array_equal(pitman_yor._parted(pitman_yor._joined(first, second, 9), 9), (first, second))


def test_words_are_seated_in_long_runs(monkeypatch):
    import pyarrow as pa

    rows = [{"word": b"w%d" % k, "c": k % 80, "t": min(k % 80, 1), **dict.fromkeys(("key", "n", "own", "own_sum"), k), "p": 0.0}
            for k in range(1000)]
    batches = pa.Table.from_pylist(rows).to_batches(max_chunksize=50)
    calls, seat = [], pitman_yor.seat
    monkeypatch.setattr(pitman_yor, "seat", lambda *a: calls.append(len(a[1])) or seat(*a))
    flat = np.full(257, 1 / 257)
    spelling = pitman_yor.Spelling(np.empty(0, np.int64), np.empty(0), np.ones(32 ** 3), np.tile(flat, (1024, 1)), flat)
    step = pitman_yor._seat_words(lambda: spelling, 900, 0.5, 1)
    out = pa.Table.from_batches(step(iter(batches))).to_pylist()
    assert calls == [1000] and [r["word"] for r in out] == [r["word"] for r in rows]
    assert all(min(r["c"], 1) <= r["t"] <= r["c"] for r in out)
    monkeypatch.setattr(pitman_yor, "RUN_BYTES", 1)
    assert [b.num_rows for b, _ in pitman_yor._runs(iter(batches))] == [50] * 20
    assert pa.Table.from_batches(step(iter(batches))).to_pylist() == out  # each batch has draws of its own


def test_spelling_sums_to_one():
    rng = np.random.default_rng(1)
    counts = np.zeros((1024, 257), np.int64)
    counts[rng.integers(0, 1024, 400), rng.integers(0, 257, 400)] = rng.integers(1, 50, 400)
    tables, own, left, parents = pitman_yor.seat_contexts(rng, counts, np.full(257, 1 / 257))
    p = own + left[:, None] * np.tile(parents, (32, 1))
    assert np.allclose(p.sum(axis=1), 1) and (p > 0).all() and tables.sum() > 0


def test_cells_follow_the_words():
    cells, starts = pitman_yor.spelled([b"ab", b"", b"a"])
    context, symbol = np.divmod(cells, 257)
    assert symbol.tolist() == [97, 98, 256, 256, 97, 256]
    assert context.tolist() == [0, 1, 2 + 32, 0, 0, 1] and starts.tolist() == [0, 3, 4]


def test_seating_agrees_with_seating_one_by_one():
    def slow(rng, customers, base):
        tables = 1
        for seated in range(1, customers):
            new = (1 + 0.5 * (10 + tables)) * base
            tables += rng.random() * (seated - 0.5 * tables + new) < new
        return tables

    rng = np.random.default_rng(3)
    for customers, base in ((20, 0.2), (400, 0.05), (400, 0.6)):
        n = 400
        fast = pitman_yor.seat(rng, np.full(n, customers), np.full(n, base), np.full(n, 10), 1.0, 0.5)
        plain = [slow(rng, customers, base) for _ in range(n)]
        assert fast.min() >= 1 and fast.max() <= customers
        assert abs(fast.mean() - np.mean(plain)) < 4 * np.std(plain) / n ** 0.5 + 0.05 * np.mean(plain)
    assert pitman_yor.seat(rng, np.array([0, 1]), np.ones(2), np.zeros(2), 1.0, 0.5).tolist() == [0, 1]


def test_search_of_documents(spark):
    got = contract.queries()["op8_search"](spark, MEDIUM).collect()
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").collect()]
    texts = dict(rows)
    asked = [i for i in texts if i % 100 == 0]
    assert {r["query_id"] for r in got} == set(asked)
    for q in asked[:5]:
        found = sorted((r["rank"], r["doc_id"], r["score"]) for r in got if r["query_id"] == q)
        expected = bm25(rows, texts[q])
        assert [i for _, i, _ in found] == [i for i, _ in expected]
        assert [s for _, _, s in found] == pytest.approx([s for _, s in expected], abs=2e-6)


@pytest.mark.parametrize("shard_docs", [3, 60_000])
def test_search_in_small_shards(spark, monkeypatch, shard_docs):
    monkeypatch.setattr(search, "SHARD_DOCS", shard_docs)
    rows = [(k, prose(k, 5 + k % 40, 60)) for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    queries = df.where("doc_id % 50 = 0").select(F.col("doc_id").alias("query_id"), F.col("text").alias("query_text"))
    got = search.search(df, queries, k=7).collect()
    for q in range(0, 300, 50):
        found = sorted((r["rank"], r["doc_id"]) for r in got if r["query_id"] == q)
        assert [i for _, i in found] == [i for i, _ in bm25(rows, rows[q][1], 7)]


def test_shards_and_blocks_of_queries_stay_small(spark):
    rows = [(k, prose(k, 20_000, 400)) for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df = df.withColumn("doc_id", F.explode(F.expr("transform(sequence(0, 5), k -> k * 40 + doc_id)"))).coalesce(1)
    assert 6 * sum(len(text) for _, text in rows) > 20_000_000  # in one partition
    shards = search.build_index(df).select("ids", "n_docs").collect()
    assert len(shards) > 1 and sorted(i for r in shards for i in r["ids"]) == list(range(240))
    queries = [{"query": k, "text": f"word{k % 50} word{k % 70} other{k}"} for k in range(1000)] + [{"query": 9, "text": ""}]
    keys, flat, ends, numbers = search._block_terms(queries)
    assert flat.nbytes + ends.nbytes + keys.nbytes < 50_000 and len(keys) == len(ends) == 1001
    names = {i: t for t, i in numbers.items()}
    for row, terms in zip(queries, np.split(flat, ends[:-1]), strict=True):
        assert [names[i] for i in terms] == list(dict.fromkeys(search.terms(row["text"])))


def test_answers_on_the_way_grow_less_than_the_shards(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(search, "SHARD_DOCS", 3)
    monkeypatch.setattr(search, "working_dir", lambda spark, name: str(tmp_path / name))
    rows = [(k, prose(k % 250, 5 + k % 40, 60)) for k in range(300)]  # with ties
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    queries = df.where("doc_id % 50 = 0").select(F.col("doc_id").alias("query_id"), F.col("text").alias("query_text"))
    got = search.search(df, queries, k=3).collect()
    for q in range(0, 300, 50):
        found = sorted((r["rank"], r["doc_id"]) for r in got if r["query_id"] == q)
        assert [i for _, i in found] == [i for i, _ in bm25(rows, rows[q][1], 3)]
    on_the_way = spark.read.option("recursiveFileLookup", "true").parquet(str(tmp_path / "answers")).count()
    assert on_the_way < 6 * 3 * 3 * 10  # the queries, k, and three times the root of 100 shards


def test_repeated_queries_are_one(spark, monkeypatch):
    monkeypatch.setattr(search, "QUERY_CHARS", 40)
    rows = [(k, prose(k, 20, 30)) for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    asked = [(4, rows[4][1]), (4, rows[4][1]), (5, rows[5][1]), (5, rows[9][1]), (6, None)]
    got = search.search(df, spark.createDataFrame(asked, "query_id long, query_text string"), k=4).collect()
    assert sorted((r["rank"], r["doc_id"]) for r in got if r["query_id"] == 4) == [
        (k, i) for k, (i, _) in enumerate(bm25(rows, rows[4][1], 4), 1)]
    assert sorted((r["rank"], r["doc_id"]) for r in got if r["query_id"] == 5) == sorted(
        (k, i) for text in (rows[5][1], rows[9][1]) for k, (i, _) in enumerate(bm25(rows, text, 4), 1))


def test_frequencies_are_counted_once_for_all_blocks(spark, monkeypatch):
    monkeypatch.setattr(search, "QUERY_CHARS", 300)
    calls, counted = [], search._frequencies
    monkeypatch.setattr(search, "_frequencies", lambda *given: calls.append(1) or counted(*given))
    rows = [(k, prose(k, 20, 60)) for k in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    queries = df.where("doc_id % 10 = 0").select(F.col("doc_id").alias("query_id"), F.col("text").alias("query_text"))
    got = search.search(df, queries, k=5).collect()
    assert len(calls) == 1
    for q in range(0, 120, 10):
        found = sorted((r["rank"], r["doc_id"]) for r in got if r["query_id"] == q)
        assert [i for _, i in found] == [i for i, _ in bm25(rows, rows[q][1], 5)]


def test_rounded_sums_lose_no_answer():
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{t}" for t in rng.integers(0, 40, 30)) for _ in range(500)] + ["w1 w2"] * 20
    postings = search._Postings()
    for text in texts:
        postings.add(text)
    blob = postings.packed()[1]
    numbers = {f"w{t}": t for t in range(40)}
    idf = np.full(40, 1000.0) + np.arange(40)  # sums too large for single precision
    queries = [np.array([1, 2], np.int32), np.arange(40, dtype=np.int32), np.array([], np.int32)]
    shard = search.ShardSearch(blob, numbers, idf, 30.0)
    full = search.ShardSearch(blob, numbers, idf, 30.0).search(queries, len(texts), np.zeros(3))
    for floors in (np.zeros(3), np.array([sorted((s for s, _ in a), reverse=True)[9] if a else 0.0 for a in full])):
        for few, answers in zip(shard.search(queries, 10, floors), full, strict=True):
            best = sorted((-s, d) for s, d in answers)
            expected = [(s, d) for s, d in best if len(best) < 10 or s <= best[9][0] + 1e-9]
            assert [d for _, d in sorted((-round(s, 6), d) for s, d in few)] == [
                d for _, d in sorted((round(s, 6), d) for s, d in expected)]


def test_search_on_edge_cases(spark):
    df = edge_table(spark)
    queries = df.select(F.col("doc_id").alias("query_id"), F.col("text").alias("query_text"), "row")
    got = search.search(df, queries)
    assert not {1, 2, 3} & {r["query_id"] for r in got.collect()}
    first = got.where("query_id = 6 AND rank <= 3").orderBy("rank").collect()
    assert [r["doc_id"] for r in first] == [5, 5, 6] and len({r["score"] for r in first}) == 1
    assert search.search(df.limit(0), queries).count() == 0
    assert search.search(df, queries.limit(0)).count() == 0


def test_roles_of_held_out_conversations(spark):
    got = contract.queries()["op1_chat_turns"](spark, MEDIUM)
    known = spark.read.parquet(f"{MEDIUM}/conversations.parquet").where(remainder("conv_id", 3) == 1)
    rows = known.select("conv_id", F.col("turn").alias("first_piece"), F.col("role").alias("known")).join(
        got, ["conv_id", "first_piece"], "left").collect()
    assert sum(r["known"] == r["role"] for r in rows) / len(rows) > 0.85
    assert got.where("rendered <> concat('<|', role, '|>\n', content, '\n<|end|>\n')").count() == 0


@pytest.fixture(scope="module")
def role_model(spark):
    return chat.train(chat.transcripts(spark.read.parquet(f"{SMALL}/conversations.parquet")))


def test_path_is_the_best_of_all(role_model):
    rng = np.random.default_rng(2)
    features = [tuple(int(rng.integers(0, n)) for n in chat.FEATURES.values()) for _ in range(5)]
    from itertools import product

    emitted = role_model.emissions(features)

    def score(path):
        return role_model.first[path[0]] + sum(emitted[k][s] for k, s in enumerate(path)) + sum(
            role_model.after[a, b] for a, b in zip(path, path[1:], strict=False))

    best = max(product(range(6), repeat=5), key=score)
    assert score(role_model.path(features, None, -1)) == pytest.approx(score(best))
    start = role_model.first + emitted[0]
    crossed = (start[:, None] + role_model.crossing(features[1:])).max(axis=0)
    assert crossed.max() == pytest.approx(score(best))


def test_blocks_do_not_change_the_turns(spark, role_model, monkeypatch):
    raw = chat.transcripts(spark.read.parquet(f"{SMALL}/conversations.parquet")).select("conv_id", "turn", "text")
    whole = sorted(map(tuple, chat.format_transcripts(raw, role_model).collect()))
    monkeypatch.setattr(chat, "BLOCK", 2)
    assert sorted(map(tuple, chat.format_transcripts(raw, role_model).collect())) == whole


@pytest.mark.parametrize("block", [1, 64])
def test_lines_within_a_turn_stay_whole(spark, monkeypatch, block):
    monkeypatch.setattr(chat, "BLOCK", block)
    said = "look here\nNote: the key is case sensitive\nAnswer: 42\n## Question\nA: first option"
    rows = [(k, turn, text, role) for k in range(20) for turn, text, role in (
        (0, "User: what?", "user"), (1, f"Assistant: {said}", "assistant"))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, text string, role string")
    got = chat.format_transcripts(df.drop("role"), chat.train(df)).collect()
    assert {(r["first_piece"], r["role"], r["content"]) for r in got} == {(0, "user", "what?"), (1, "assistant", said)}


@pytest.mark.parametrize("block", [1, 64])
def test_blank_lines_within_a_turn_stay(spark, monkeypatch, block):
    monkeypatch.setattr(chat, "BLOCK", block)
    said = "def f():\n\n    return 1\n \n\nAnswer: 42"
    rows = [(k, turn, text, role) for k in range(20) for turn, text, role in (
        (0, "User: what?\n\n", "user"), (1, f"\nAssistant: {said}\n\n", "assistant"), (2, "User: thanks", "user"))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, text string, role string")
    got = chat.format_transcripts(df.drop("role"), chat.train(df)).collect()
    assert {(r["first_piece"], r["marker"], r["content"]) for r in got} == {
        (0, "User: ", "what?"), (1, "Assistant: ", said), (2, "User: ", "thanks")}


def test_rows_are_told_apart_by_all_columns(spark, role_model):
    rows = [(1, None, "User: a", "x"), (1, None, "ok", "x"), (1, None, "ok", "y"), (1, None, "ok", "y")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, text string, more string")
    said = "\n".join(r["content"] for r in chat.format_transcripts(df, role_model).orderBy("first_line").collect())
    assert said.split("\n").count("ok") == 2


def test_chat_on_edge_cases(spark, role_model):
    rows = [(1, 0, "User: hi"), (1, 1, "Assistant: hello\nthere"), (1, 1, "Assistant: hello\nthere"),
            (2, 0, None), (2, None, "Human: x"), (3, 0, ""), (3, 1, " \n "), (None, 0, "User: lost"),
            (4, 0, "User:"), (4, 1, "AI: " + prose(1, 5000))]
    df = spark.createDataFrame([(*r, "own", "own") for r in rows], "conv_id long, turn long, text string, block string, place string")
    got = chat.format_transcripts(df, role_model)
    turns = {(r["conv_id"], r["first_piece"], r["role"], r["content"]) for r in got.collect()}
    assert (1, 0, "user", "hi") in turns and (1, 1, "assistant", "hello\nthere") in turns
    assert got.where("conv_id = 1").count() == 2 and got.where("conv_id IS NULL OR conv_id = 3").count() == 0
    assert (2, -1, "user", "x") in turns
    assert prose(1, 5000) in "".join(c for i, _, _, c in turns if i == 4)
    assert chat.format_transcripts(df.limit(0), role_model).count() == 0
    nothing = chat.train(df.limit(0).withColumn("role", F.lit("user")))
    assert np.isfinite(nothing.first).any()
