"""Token counts, BPE encoding and packing against the tokenizers library."""

from hashlib import sha256

import pytest

import __spark_entry__ as contract
from llm_brute import edge_table, edge_texts, packed_problem, tokenizer
from pressflow.llm import bpe_automaton, packing, token_counts
from pressflow.llm.catalogue import tokenizer_json
from tests_paths import SMALL


@pytest.fixture(scope="module")
def docs(spark):
    return [(r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]


def ids_of(name, text):
    return tokenizer(name).encode(text, add_special_tokens=False).ids


def test_token_counts_of_documents(spark, docs):
    got = contract.queries()["op2_token_counts"](spark, SMALL).collect()
    plain = tokenizer("byte_bpe_50k.json")
    expected = {i: len(plain.encode(t, add_special_tokens=False)) for i, t in docs}
    assert {r["doc_id"]: r["n_tokens"] for r in got} == expected
    assert {r["doc_id"]: r["n_bytes"] for r in got} == {i: len(t.encode()) for i, t in docs}
    assert all(r["over_limit"] == (r["n_tokens"] > 512) for r in got)


BLANKS = ["a  b", " a", "a ", "\n a", "a \nb", "a\n\n b", "a\n\nb c", " ", " \n", "x\n", "\n", "  a b", "é <|endoftext|>\n",
          "a\x1c b", "a  b", "a  b", "don't 's 12 345", "\t\ta\t b"]


def test_token_counts_beside_white_space():
    counter = token_counts.PieceLengths(tokenizer_json("byte_bpe_50k.json"), ["b", "the"])
    assert counter.count(BLANKS) == [len(ids_of("byte_bpe_50k.json", t)) for t in BLANKS]


def test_token_counts_of_edge_cases(spark):
    df = edge_table(spark)
    got = token_counts.token_counts(df, tokenizer_json("byte_bpe_50k.json"))
    assert sorted(got.columns) == sorted(df.columns)
    expected = sorted(len(ids_of("byte_bpe_50k.json", t or "")) for _, t in edge_texts())
    assert sorted(r["n_tokens"] for r in got.collect()) == expected
    assert {r["row"] for r in got.collect()} == {"own"}
    assert token_counts.token_counts(df.limit(0), tokenizer_json("byte_bpe_50k.json")).count() == 0


def test_encoding_of_documents(spark, docs):
    got = {r["doc_id"]: r for r in contract.queries()["op9_bpe_round_trip"](spark, SMALL).collect()}
    plain = tokenizer("word_bpe_49k.json")
    for i, text in docs:
        ids = plain.encode(text, add_special_tokens=False).ids
        decoded = plain.decode(ids, skip_special_tokens=False)
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == sha256(decoded.encode()).hexdigest()


def test_encoding_of_edge_cases(spark):
    content, df = tokenizer_json("word_bpe_49k.json"), edge_table(spark)
    got = bpe_automaton.encode_texts(df, content)
    plain = tokenizer("word_bpe_49k.json")
    for r in got.collect():
        ids = plain.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["ids"] == ids
        assert r["decoded"] == plain.decode(ids, skip_special_tokens=False)
        assert r["row"] == "own"
    again = bpe_automaton.decode_ids(got.select("ids", "decoded"), content, out="again")
    assert again.where("again <> decoded").count() == 0
    assert bpe_automaton.encode_texts(df.limit(0), content).count() == 0


def test_automaton_follows_merges_in_order():
    model = bpe_automaton.Automaton({"a": 0, "b": 1, "c": 2, "bc": 3, "ab": 4, "aa": 5}, "", {})
    for number, pair in enumerate([("b", "c"), ("a", "b"), ("a", "a")]):
        model.merge(number, *pair)
    start, after = 0, model.target
    assert not model.has(after[1], 2)   # b c is always merged
    assert model.has(after[4], 2) is False  # and before a b, so ab is never followed by c
    assert not model.has(after[0], 0) and model.has(after[5], 0)  # aaa is aa a
    assert not model.has(after[0], 5)
    assert model.has(start, 3)


def test_automaton_refuses_what_depends_on_blanks():
    with pytest.raises(ValueError, match="end-of-word"):
        bpe_automaton.check_tokenizer(tokenizer_json("byte_bpe_50k.json"))


def encoded(rows):
    plain = tokenizer("word_bpe_49k.json")
    return {i: plain.encode(t or "", add_special_tokens=False).ids + [1] for i, t in rows}


def test_packing_of_documents(spark, docs):
    got = contract.queries()["op10_packing"](spark, SMALL).toPandas()
    expected = encoded(docs)
    assert set(got["doc_id"]) == set(expected)
    assert packed_problem(got, expected) is None
    total = got["length"].sum()
    assert got["sequence_id"].nunique() * 2048 < 1.03 * total + 2048


def test_packing_of_edge_cases(spark):
    rows = [(i, t) for i, (_, t) in enumerate(edge_texts())]
    content = tokenizer_json("word_bpe_49k.json")
    got = packing.pack_documents(edge_table(spark, rows), content).toPandas()
    assert packed_problem(got, encoded(rows)) is None
    with_nulls = packing.pack_documents(edge_table(spark), content)
    assert with_nulls.where("doc_id IS NULL").count() == 2
    assert packing.pack_documents(edge_table(spark).limit(0), content).count() == 0


def test_chunks_encoded_together():
    plain = tokenizer("word_bpe_49k.json")
    for text in ["one two\n three", "a <|endoftext|> b", "İ x", "Σας ΑΣ y", "x\x00 \x7f", "Don't, x., y-, A., B.\nc, 1, é, ΑΣ. <|endoftext|>. K.", "<|ENDOFTEXT|> x, y", "İİ <|endoftext|>x z", "\u0301 é ΑΣ, don't 12 a\u0301"]:
        (ids,) = packing.ChunkIds(tokenizer_json("word_bpe_49k.json")).encode([text])
        expected = plain.encode(text, add_special_tokens=False).ids
        assert ids == b"".join(i.to_bytes(4, "little") for i in expected)


def test_sequences_hold_the_ids(spark, docs):
    content, df = tokenizer_json("word_bpe_49k.json"), spark.createDataFrame(docs[:40], "doc_id long, text string")
    pieces = packing.stored(packing.token_pieces(df, content, with_ids=True, window=256), "pieces")
    packed = packing.pack(pieces.drop("ids"), window=256)
    rows = packing.sequences(pieces, packed, window=256).collect()
    assert sum(r["n_tokens"] for r in rows) == sum(len(v) for v in encoded(docs[:40]).values())
    assert all(len(r["ids"]) == 4 * r["n_tokens"] <= 1024 for r in rows)


def test_best_fit_takes_the_tightest_window():
    placed = packing.best_fit_decreasing([6, 5, 4, 3, 2], 10)
    assert placed == [(0, 0), (1, 0), (0, 6), (1, 5), (1, 8)]
    rooms = packing.Rooms(10)
    assert rooms.take(1) is None
    rooms.add(7, 0)
    rooms.add(3, 1)
    assert rooms.take(4) == (0, 7) and rooms.take(4) is None and rooms.take(3) == (1, 3)
