"""Operators 11 to 13 against brute force and the library, and their defined cases."""

import random
import re
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from aerolith.llm import audit, counts, negatives, queries, topk

SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LIBRARY = Tokenizer.from_file(queries.BYTES)


# ---- 11: filter audit ----


def masks_of(rows):
    """The failed filters of ``(doc_id, text, part)`` rows, by the rules themselves."""
    out = []
    for i, t, _ in rows:
        t = t or ""
        w = WORDS.findall(t)
        fails = "A" * (len(w) < 200) + "B" * (100 * len(set(w)) < 50 * len(w))
        fails += "C" * (100 * len(re.findall("[A-Z]", t)) > 3 * len(t)) + "D" * bool(re.search(r"[#$%&*|]", t))
        smaller = [j for j, u, _ in rows if (u or "") == t and j is not None and i is not None and j < i]
        out.append(fails + "E" * bool(smaller))
    return out


def audit_by_hand(rows, labels):
    failed, out = masks_of(rows), {}
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    for part in {p or "" for _, _, p in rows}:
        own = [(i, f) for (i, _, p), f in zip(rows, failed, strict=True) if (p or "") == part]
        share = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            for step, k in enumerate(order, 1):
                gone = [x for x in own if set(x[1]) & set(order[: step - 1])]
                rest = [x for x in own if x not in gone] if len(gone) < len(own) else []
                here = [x for x in rest if k in x[1]]
                share[k] += len(here)
                out[part, order, step] = [
                    len(rest) - len(here), len(here), sum(k in f for _, f in own) - len(here), sum(f == k for _, f in own),
                    sum(i in good for i, _ in here), sum(i in toxic for i, _ in here),
                ]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(share[order[step - 1]])
    return out


def audited(spark, rows, labels):
    docs = spark.createDataFrame([(*r, 1, True) for r in rows], "doc_id long, text string, lang string, mask int, good boolean")
    marks = spark.createDataFrame([(*r, "x") for r in labels], "doc_id long, quality int, toxic int, part string")
    return {(r["part"], r["filter_order"], r["step"]): [r[c] for c in audit.COUNTS] for r in audit.audit(docs, marks).collect()}


def test_audit_matches_brute_force(spark):
    rng = random.Random(4)
    long = [" ".join(f"w{rng.randrange(k)}" for _ in range(230)) for k in (20, 400)]
    texts = [*long, long[1].upper(), long[1] + " #", long[0] + "|", "a b c", "A\x1cB\x85", "", " \t\n", None, "x" * 50_000]
    rows = [(i, rng.choice(texts), rng.choice(["en", "de", "", None])) for i in range(60)]
    rows += [(3, rows[3][1], "en"), (3, rows[3][1], "fr"), (3, long[0], "de"), (None, long[1], "en"), (None, long[1], None), (-5, long[1], "de")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 80, 2)] + [(3, 1, 0), (3, 0, 1), (None, 1, 1)]
    got = audited(spark, rows, labels)
    assert got == audit_by_hand(rows, labels) and len(got) == 600 * 4


def test_audit_of_nothing_and_of_copies(spark):
    assert audited(spark, [], [(1, 1, 1)]) == {}
    rows = [(i, "same text", "en") for i in range(500)]
    got = audited(spark, rows, [])
    assert got == audit_by_hand(rows, []) and got["en", "ABCDE", 1][1] == 500 and got["en", "EABCD", 1][1] == 499


# ---- 12: token counts ----

PIECES = ["'s", "'re", "'ll", "'", "  ", " ", "\n", "\t\n", "\r\n", "the", "hello", "World", "123", "½", "é", "日本", "!!", "#$", "<|endoftext|>",
          "<|endo", "|>", " ", "　", "a" * 30, "\U0001f600", "ve", "\x1c", "\x85", "​", "Ⅷ", "ْ", "\x00"]


def library(text):
    return len(LIBRARY.encode(text, add_special_tokens=False).ids)


def test_counts_of_every_prefix_agree_with_the_library():
    counter, rng = counts.counter_for(queries.BYTES), random.Random(7)
    for _ in range(150):
        text = "".join(rng.choice(PIECES) for _ in range(rng.randrange(14)))
        want = [library(text[:k]) for k in range(len(text) + 1)]
        assert counter.counts(text).tolist() == want and counter.count(text) == want[-1], text


def test_counts_of_long_texts(monkeypatch):
    counter, rng = counts.counter_for(queries.BYTES), random.Random(8)
    noise = "".join(rng.choice("abcdef") for _ in range(40_000))
    for text in (noise, "a" * 100_000, " " * 50_000 + "x", "!?" * 20_000, "日本語" * 9_000, "ab cd's " * 20_000):
        assert counter.count(text) == library(text)
    monkeypatch.setattr(counts, "CHARACTERS", 50)  # stretches, and a memo that is emptied
    monkeypatch.setattr(counts.Counter, "MEMO", 40)
    text = " ".join("".join(rng.choice(PIECES[:19]) for _ in range(3)) + " word" for _ in range(300))
    assert counter.count(text) == library(text) and counter.counts(text)[-1] == library(text)


def test_prefix_counts_answer_questions(spark):
    rows = [(1, "hello world, it's me", "c"), (2, None, "c"), (2, "", "c"), (None, "  x<|endoftext|>y", "c"), (1, "hello world, it's me", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, counts string")
    n = F.col("counts")
    got = counts.prefix_counts(docs, queries.BYTES).select("doc_id", "counts", counts.total(n).alias("n"), counts.longest_fit(n, 3).alias("fit"), counts.spent(n, 5).alias("five"))
    want = []
    for i, text, _ in rows:
        text = text or ""
        each = [library(text[:k]) for k in range(len(text) + 1)]
        want.append((i, each, each[-1], max(k for k, c in enumerate(each) if c <= 3), library(text[:5])))
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want))
    assert counts.prefix_counts(docs.limit(0), queries.BYTES).count() == 0


def test_token_count_query(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op12_token_counts(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        n = library(docs[r["doc_id"]])
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(docs[r["doc_id"]].encode()), n, n > 1024)


# ---- 13: hard negatives ----


def negatives_by_hand(rows, anchors, k=5, m=10):
    """``rows (id, vector of whole numbers, label)``; every pair is scored."""
    out = []
    for a, va, la in rows:
        if a not in anchors:
            continue
        score = lambda v: sum(x * y for x, y in zip(va, v))
        pos = sorted((-score(v), i) for i, v, x in rows if x == la and i != a)[:k]
        for p, i in pos:
            found = sorted((-score(v), j) for j, v, x in rows if x != la and j != a and -30 * p <= 100 * score(v) <= -90 * p)[:m]
            out += [(a, i, rank, j, -p, -s) for rank, (s, j) in enumerate(found, 1)]
    return sorted(out)


def mined(spark, rows, **options):
    frame = spark.createDataFrame([(i, v, x, 7) for i, v, x in rows], "vec_id long, embedding array<double>, label int, score int")
    got = negatives.hard_negatives(frame, F.col("id") % 4 == 0, **options)
    return sorted((r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"], r["positive_score"], r["negative_score"]) for r in got.collect())


@pytest.mark.parametrize("spread", [0.0, 2.0])
def test_hard_negatives_match_brute_force(spark, monkeypatch, spread):
    """With norms that vary, and small buckets and shards, much is pruned."""
    monkeypatch.setattr(negatives, "BUCKET", 8)
    monkeypatch.setattr(negatives, "SHARD", 50)
    monkeypatch.setattr(negatives, "ANCHORS", 16)
    rng = np.random.default_rng(5)
    v = rng.normal(size=(240, 6)) * np.exp(rng.normal(size=(240, 1)) * spread)
    v[60:90] = v[60]  # ties
    rows = [(i, v[i].tolist(), int(rng.integers(4))) for i in range(240)]
    whole = [(i, [int(np.floor(256 * x)) for x in r], label) for i, r, label in rows]
    assert mined(spark, rows) == negatives_by_hand(whole, set(range(0, 240, 4)))


def test_hard_negatives_defined_cases(spark):
    rows = [(0, [1.0, 0.5], 1), (1, [1.0], 1), (2, [0.5, 0.5], 2), (3, [0.5, None], 2), (4, None, 2), (5, [1.0, float("nan")], 1), (6, [0.5, 0.0], None),
            (None, [1.0, 1.0], 1), (8, [-1.0, 0.0], 2), (12, [1.0, 0.25], 2), (2, [0.5, 0.5], 2), (16, [float("inf"), 1.0], 2)]
    kept = [(i, [int(256 * x) for x in v] + [0] * (2 - len(v)), x) for i, v, x in rows if i in (0, 1, 2, 8, 12)]
    assert mined(spark, rows) == negatives_by_hand(kept, {0, 8, 12})
    assert mined(spark, []) == [] and mined(spark, rows[:1]) == []
    for large in (1e30, 2.0**50):
        with pytest.raises(Exception, match="64-bit"):
            mined(spark, [(0, [large], 1), (1, [large], 1)])
    frame = spark.createDataFrame([(0, [1e30]), (50, [1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="64-bit"):
        topk.top_k(frame, F.col("id") % 50 == 0).collect()
