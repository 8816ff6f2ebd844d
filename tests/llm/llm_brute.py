"""Plain versions of the operators, and the rows the edge cases are tested on."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter
from hashlib import sha256

import public_tokenizers
from tokenizers import Tokenizer
from xxhash import xxh64_intdigest

CLASHES = ["row", "key", "n", "piece", "ids", "spans", "n_bytes", "kept", "fp", "block", "stats", "score",
           "group_id", "s", "d2", "span", "core", "data", "decoded", "n_tokens", "_key", "_row", "_n"]
BLANK = "[\x20\x09-\x0d]+"


def words(text):
    return [w for w in re.split(BLANK, text or "") if w]


def tokenizer(name):
    return Tokenizer.from_file(public_tokenizers.path(name))


def prose(seed, n, vocabulary=3000):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def edge_texts():
    """Id and text: nulls, empty and blank texts, long ones, repeats, copies, odd characters."""
    passage = prose(1, 60)
    return [
        (1, None), (2, ""), (3, " \t\n "), (None, prose(2, 40)), (None, None), (5, prose(3, 50)),
        (5, prose(3, 50)), (6, prose(3, 50)), (7, "é ﬁ 日本語 \x1c 🎉 <|endoftext|> ΑΣ İ\n\n x  y"),
        (8, prose(4, 30) + " " + passage + " " + prose(5, 30)), (9, prose(6, 20) + " " + passage),
        (10, "ab" * 400), (11, "one two"), (12, prose(7, 30000)), (13, "x" * 5000), (14, "One TWO"),
        (15, "<|endoftext|>"), (16, "a <|endoftext|> b "), (17, "line\nline\nother\nline"),
    ]


def edge_table(spark, rows=None):
    """The edge rows with language and source, null in some, and columns whose names clash."""
    rows = edge_texts() if rows is None else rows
    values = [(i, t, None if k % 5 == 0 else "en", None if k % 7 == 0 else "src0", len(t or ""))
              for k, (i, t) in enumerate(rows)]
    df = spark.createDataFrame(values, "doc_id long, text string, lang string, source string, n_chars long")
    for name in CLASHES:
        df = df.selectExpr("*", f"'own' AS `{name}`")
    return df


def fingerprint(text):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[j:j + 3]) for j in range(max(1, len(w) - 2))] if w else []
    ones = [0] * 64
    for s in shingles:
        h = xxh64_intdigest(s, 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles)) if shingles else 0


def components(ids, linked):
    """Smallest member of each one's component."""
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def covered(texts, length=200):
    """For each text, which bytes lie in a string of the length that starts at two places."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[j:j + length] for d in data for j in range(len(d) - length + 1))
    out = []
    for d in data:
        marks = bytearray(len(d))
        for j in range(len(d) - length + 1):
            if seen[d[j:j + length]] > 1:
                marks[j:j + length] = b"\1" * length
        out.append(marks)
    return data, out


def repeat_row(data, marks):
    kept = bytes(x for x, m in zip(data, marks, strict=True) if not m)
    spans = sum(1 for j, m in enumerate(marks) if m and (j == 0 or not marks[j - 1]))
    return len(data), sum(marks), spans, sha256(kept).hexdigest()


def quality_counts(text):
    w = words(text)
    lines = [line for line in (text or "").split("\n") if words(line)]
    windows = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    again = {p for i in range(len(w) - 7) if windows[tuple(w[i:i + 8])] > 1 for p in range(i, i + 8)}
    failed = len(w) < 20 or 100 * len(again) > 30 * len(w)
    return (len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(again), failed)


def base_scores(rows, held_out):
    """Id to held out, tokens, known tokens, learned tokens and base score; ids are unique."""
    tokens = {i: (t or "").encode().lower().split() + [b""] for i, t in rows}
    count = Counter(w for i in tokens if not held_out(i) for w in tokens[i])
    total = sum(count.values())
    return {i: (held_out(i), len(ts), sum(count[w] > 0 for w in ts), total,
                sum(math.log10((count[w] + 0.5) / (total + 0.5 * (len(count) + 1))) for w in ts))
            for i, ts in tokens.items()}


def bm25(rows, query, k=10):
    """The k best (id, score) of all rows for the text of a query."""
    bags = [(i, Counter(re.findall(r"\w+", (t or "").lower()))) for i, t in rows]
    lengths = [sum(b.values()) for _, b in bags]
    mean, n = sum(lengths) / len(bags), len(bags)
    df = Counter(t for _, b in bags for t in b)
    found = []
    for (i, bag), length in zip(bags, lengths, strict=True):
        score = sum(math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * bag[t] * 2.2
                    / (bag[t] + 1.2 * (0.25 + 0.75 * length / mean))
                    for t in set(re.findall(r"\w+", (query or "").lower())) if t in bag)
        if score > 0:
            found.append((-round(score, 6), i))
    return [(i, -s) for s, i in sorted(found)[:k]]


def packed_problem(pieces, expected, window=2048):
    """What is wrong with packed pieces, or None. ``expected``: ids with end of each document."""
    for doc, rows in pieces.groupby("doc_id"):
        ids, rows = expected[doc], rows.sort_values("start")
        at = 0
        for r in rows.itertuples():
            part = ids[at:at + r.length]
            crc = zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part))
            if (r.start, r.ids_crc32, r.doc_tokens) != (at, crc, len(ids)):
                return f"piece {tuple(r)}"
            at += r.length
        if at != len(ids):
            return f"document {doc} ends at {at} of {len(ids)}"
    for number, rows in pieces.groupby("sequence_id"):
        rows, at = rows.sort_values("offset"), 0
        for r in rows.itertuples():
            if r.offset != at:
                return f"sequence {number} has a gap"
            at += r.length
        if at > window:
            return f"sequence {number} has {at}"
    return None
