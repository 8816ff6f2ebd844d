"""Aligned tokens and their pair counts against a plain version that reads whole texts."""

from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor

import __spark_entry__ as contract
from llm_brute import edge_table, edge_texts, tokenizer
from pressflow.llm import token_alignment as alignment
from pressflow.llm.catalogue import tokenizer_json
from tests_paths import SMALL

A = tokenizer("byte_bpe_50k.json")
A.encode_special_tokens = True
B = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
ALPHABET = alignment._byte_alphabet()
A_BYTES = {i: bytes(ALPHABET.get(c, 0) for c in t) for t, i in A.get_vocab().items()}
JSON, MODEL = tokenizer_json("byte_bpe_50k.json"), open(public_tokenizers.path("piece_bpe_32k.model"), "rb").read()


def b_bytes(i):
    return bytes([int(B.id_to_piece(i)[3:5], 16)]) if B.is_byte(i) else B.id_to_piece(i).replace("▁", " ").encode()


def groups_of(text):
    """Groups as lists of ids of A and B; None if the tokens do not give the text back."""
    if not text:
        return None
    a, b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    data = (" " + text).encode()
    if b"".join(A_BYTES[i] for i in a) != data or b"".join(map(b_bytes, b)) != data:
        return None
    ends_a, ends_b = ({int(e): k for k, e in enumerate(np.cumsum([len(x) for x in side]), 1)} for side in
                      ([A_BYTES[i] for i in a], list(map(b_bytes, b))))
    out, i, j = [], 0, 0
    for end in sorted(ends_a.keys() & ends_b.keys()):
        m, n = ends_a[end], ends_b[end]
        out.append((a[i:m], b[j:n]))
        i, j = m, n
    return out


def plain(texts):
    """The columns for each text, in order."""
    found = [groups_of(t) for t in texts]
    count = Counter((a[-1], b[-1]) for groups in found for a, b in groups or [])
    most = defaultdict(int)
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    rows = []
    for groups in found:
        pairs = [(a[-1], b[-1]) for a, b in groups or []]
        written = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups or [])
        rows.append((sum(len(a) for a, _ in groups or []), sum(len(b) for _, b in groups or []), len(pairs),
                     len(pairs), sum(count[p] == most[p[1]] for p in pairs), sum(count[p] for p in pairs),
                     sha256(written.encode()).hexdigest() if groups else ""))
    return rows


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_alignment_of_documents(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS)
           for r in contract.queries()["op11_token_alignment"](spark, SMALL).collect()}
    assert got == dict(zip([i for i, _ in docs], plain([t for _, t in docs]), strict=True))


ODD = ["a  b", " a", "a ", "\n a", "a \nb", "a\n\n b", "\n", " ", "\nfoo", "a\n", " \nfoo bar\nbaz", "don't 's 12 345",
       "a▁b c", "x ▁", "<0x0A> <s></s> <unk>", "a\tb\t c", "a\x1c b", "ﬁ 日本語 🎉", "\0 a", "a\u3000 b", "a\xa0b c",
       "one two\none two", "b" * 300]


def test_alignment_of_edge_cases(spark):
    texts = [t for _, t in edge_texts()] + ODD
    rows = list(enumerate(texts))
    got = alignment.align_texts(edge_table(spark, rows), JSON, MODEL).orderBy("doc_id").collect()
    assert [tuple(r[c] for c in COLUMNS) for r in got] == plain(texts)
    with_nulls = alignment.align_texts(edge_table(spark), JSON, MODEL)
    assert with_nulls.where("doc_id IS NULL").count() == 2 and with_nulls.count() == len(edge_texts())
    assert alignment.align_texts(edge_table(spark).limit(0), JSON, MODEL).count() == 0


def test_small_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_DOCS", 3)
    monkeypatch.setattr(alignment, "TEXTS", 2)
    monkeypatch.setattr(alignment, "CACHE_UNITS", 20)
    texts = [t for _, t in edge_texts()] + ODD
    got = alignment.align_texts(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), JSON, MODEL)
    assert [tuple(r[c] for c in COLUMNS) for r in got.orderBy("doc_id").collect()] == plain(texts)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab é\n\t ,.'s1▁\x1c\xa0<"), max_size=30))
def test_units_are_independent(text):
    aligner = test_units_are_independent.aligner
    numbers = aligner.units([text])[0] if text else []
    sizes = np.frombuffer(aligner.sizes, np.int64).reshape(-1, 4)
    groups = groups_of(text)
    if groups is None:
        assert not text or not sizes[numbers, 3].all()
    else:
        assert ";".join(aligner.groups[u] for u in numbers) == ";".join(
            ",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)


test_units_are_independent.aligner = alignment.Aligner(JSON, MODEL)
test_units_are_independent.aligner._open()


def test_bitmaps_hold_their_numbers():
    rng = np.random.default_rng(5)
    runs = [np.sort(rng.choice(32_768, n, replace=False)) for n in (1, 2, 7, 2_000, 32_768)] + [np.arange(50)]
    starts = np.cumsum([0, *map(len, runs[:-1])])
    values = alignment.encode_bitmaps(starts, np.concatenate(runs)).to_pylist()
    assert all((alignment.decode_bitmap(v) == r).all() for v, r in zip(values, runs, strict=True))
    assert len(values[3]) == 4000 and len(values[4]) == 4097 and len(values[5]) == 9


def test_pair_counts_of_documents_and_links(spark):
    rows = [(1, "the the the cat"), (2, "the cat"), (3, "the"), (4, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = alignment.stored(alignment.aligned(df, JSON, MODEL), "aligned")
    got = {(r["a"], r["b"]): (r["n_docs"], r["n_links"]) for r in alignment.pair_counts(found).collect()}
    the, cat = ((groups_of(w)[0][0][-1], groups_of(w)[0][1][-1]) for w in ("the", "cat"))
    assert got == {the: (3, 5), cat: (2, 2)}


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        alignment.Aligner(tokenizer_json("word_bpe_49k.json"), MODEL).units(["a b"])
