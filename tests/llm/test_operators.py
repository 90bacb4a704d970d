"""The operators against brute force, libraries and the cases their docstrings define."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerolith.llm import chat, exact, html_text, lines, linking, minhash, packing, pieces, queries, spans, topk, toxicity

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, kept string, id string, n int"
WS = re.compile(r"[\x20\x09-\x0D]+")


def docs_of(spark, rows):
    """Documents with columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, "k", "x", 1) for i, t in rows], DOCS)


def awkward(seed=3):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(400)]
    base = [" ".join(rng.choices(vocab, k=60)) + ". " + " ".join(rng.choices(vocab, k=30)) + "." for _ in range(12)]
    rows = [(i, t) for i, t in enumerate(base)]
    for i in range(12, 60):  # near copies, exact copies, others
        words = rng.choice(base).split(" ")
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = rng.choice(vocab)
        rows.append((i, " ".join(words)))
    rows += [(60, None), (61, ""), (62, " \n\t"), (63, "one"), (64, "one"), (65, "one two"), (None, base[0]), (None, None)]
    rows += [(5, base[5]), (5, base[6]), (66, "x" * 5000), (67, "long " * 4000)]
    return rows


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_connected_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + k, 1001 + k) for k in range(60)]
    links += [(5, 5), (None, 3)]
    got = {r["id"]: r["component"] for r in linking.connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    real = [(a, b) for a, b in links if a is not None and a != b]
    assert got == components({x for p in real for x in p}, real)
    assert linking.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_exact_matches_brute_force(spark):
    rows = awkward()
    groups = defaultdict(list)
    for i, t in rows:
        groups[WS.sub("", t or "")].append((-len(t or ""), 2**63 if i is None else i, i))
    want = sorted(
        (str(i), str(min(g)[2]), len(g), hashlib.sha256(n.encode()).hexdigest())
        for n, g in groups.items()
        for _, _, i in g
    )
    for digest in (exact.sha256, lambda c: F.lit("same").cast("binary"), lambda c: F.substring(F.md5(c), 1, 1).cast("binary")):
        got = exact.exact_groups(docs_of(spark, rows), digest=digest).collect()
        assert sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["text_sha256"]) for r in got) == want
        assert all(r["kept"] == (r["doc_id"] == r["keep_id"]) for r in got)
    assert exact.exact_groups(docs_of(spark, [])).count() == 0


def test_exact_salts_hot_digest(spark):
    rows = [(i, "the same text" + " " * (i % 3)) for i in range(3000)] + [(9000 + i, f"text {i}") for i in range(50)]
    got = exact.exact_groups(docs_of(spark, rows)).where("doc_id < 9000").select("keep_id", "group_size").distinct().collect()
    assert [tuple(r) for r in got] == [(2, 3000)]
    left = exact.drop_exact_copies(docs_of(spark, rows))
    assert left.columns == ["doc_id", "text", "kept", "id", "n"] and left.count() == 51


def shingles(text):
    words = [w for w in WS.split(re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")) if w]
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def brute_near(rows):
    sets = defaultdict(list)
    for i, t in rows:
        if i is not None:
            sets[i].append(shingles(t))
    flat = [(i, s) for i, ss in sets.items() for s in ss if s]
    links = [
        (i, j)
        for x, (i, a) in enumerate(flat)
        for j, b in flat[:x]
        if 100 * len(a & b) >= 75 * len(a | b)
    ]
    return components(sets, links)


def test_near_duplicates_match_brute_force(spark):
    rows = awkward()
    want = brute_near(rows)
    got = minhash.near_duplicates(docs_of(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        elif r["n_shingles"]:
            assert r["component_id"] == want[r["doc_id"]] and r["kept"] == (r["doc_id"] == r["component_id"])
        else:
            assert r["component_id"] == r["doc_id"]
    sizes = {r["n_shingles"] for r in got if r["doc_id"] == 66}
    assert sizes == {1} and {r["n_shingles"] for r in got if r["doc_id"] in (60, 61, 62)} == {0}
    assert minhash.near_duplicates(docs_of(spark, [])).count() == 0


def test_near_duplicates_on_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = brute_near([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    got = {r["doc_id"]: r["component_id"] for r in queries.op10_minhash_near_dedup(spark, SF).collect()}
    assert got == want


def test_large_bucket_needs_no_quadratic_pairs(spark):
    keys = spark.createDataFrame([(1, i) for i in range(400)] + [(2, i) for i in range(300, 500)], "bucket long, id long")
    asked = []

    def verify(pairs):
        asked.append(pairs.count())
        return pairs

    _, got = linking.bucket_components(keys, verify)
    assert {r["component"] for r in got.collect()} == {0} and sum(asked) < 2500


def brute_spans(rows, span=2, least=20):
    places, texts = defaultdict(list), []
    for i, t in rows:
        w = [s.lower().split() for s in spans.sentences(t)]
        w = [x for x in w if x]
        texts.append((i, t, w))
        for k in range(len(w)):
            n = next((n for n in range(span, len(w) - k + 1) if sum(map(len, w[k : k + n])) >= least), None)
            if n:
                places[tuple(map(tuple, w[k : k + n]))].append((2**63 if i is None else i, t, k, n))
    gone = defaultdict(set)
    for where in places.values():
        where = sorted({(i, k, n, t) for i, t, k, n in where})
        for i, k, n, t in where[1:]:
            gone[i, t].update(range(k, k + n))
    return gone


def test_spans_match_brute_force(spark):
    rng = random.Random(5)
    sentence = lambda: " ".join(rng.choices("abcdefghijklmnop", k=rng.randrange(3, 12))).capitalize() + rng.choice([".", "!", "?\n", "."]) + " "
    passage = "".join(sentence() for _ in range(8))
    rows = [(i, "".join(sentence() for _ in range(12)) + (passage if i % 3 == 0 else "") + "".join(sentence() for _ in range(3))) for i in range(40)]
    rows += [(50, passage + "Between. " + passage), (51, None), (52, ""), (53, "no end"), (None, passage), (54, "w " * 9000)]
    want = brute_spans(rows)
    got = {(r["doc_id"], r["text"]) for r in spans.remove_repeated_spans(docs_of(spark, rows)).collect()}
    for i, t in rows:
        left, at = "", 0
        for s in spans.sentences(t):
            left += "" if s.split() and at in want[(2**63 if i is None else i), t] else s
            at += bool(s.split())
        assert (i, t if t is None else left) in got
    assert sum(map(len, want.values())) > 50
    assert "".join(spans.sentences(rows[0][1])) == rows[0][1]
    assert spans.remove_repeated_spans(docs_of(spark, [])).count() == 0


def test_span_query_leaves_no_repeated_window(spark, tmp_path):
    """Passages with one whole sentence or none, inside longer sentences too, and a short stretch at the end of one."""
    rng = random.Random(9)
    words = lambda n: " ".join("".join(rng.choices("abcdefghijklmnop", k=5)) for _ in range(n))
    passages = [words(73), words(20) + ". " + words(12) + ". " + words(25), words(30) + ". " + words(29) + ". " + words(6) + ". "]
    rows = [(k, f"  {words(9)}. {words(7)} {passages[k % 3]} {words(9)}. {words(14)}!\n\n") for k in range(12)]
    docs_of(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in queries.op4_substring_dedup(spark, str(tmp_path)).collect()}
    seen = set()
    for k, t in rows:
        windows = {tuple(w[i : i + 50]) for w in [got[k]["text"].lower().split()] for i in range(len(w) - 49)}
        assert not windows & seen
        seen |= windows
        assert got[k]["text"] == t if k < 3 else got[k]["removed_words"] > 25
        assert len(got[k]["text"].split()) + got[k]["removed_words"] == len(t.split())
    for t in [t for _, t in rows] + ["", " \x1c a\u2003b " + "c " * 90, "Σ" * 3 + " x" * 40 + " ß.\n y"]:
        assert "".join(spans.units(t, 16)) == t
        assert [u.lower().split() for u in spans.units(t, 16) if u.split()] == spans.unit_words_of(t, 16)


def test_lines(spark):
    rng = random.Random(6)
    base = [" ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(40)) for _ in range(6)]
    rows = [(1, "\n".join([base[0], base[1], "ok", ""])), (2, "\n".join([base[2], base[0].upper()])), (3, base[3]),
            (4, None), (None, base[3]), (5, base[4]), (5, base[4]), (6, "w " * 40000)]
    got = {(r["doc_id"], r["line_no"]): r["kept"] for r in lines.fuzzy_lines(docs_of(spark, rows)).collect()}
    assert got[1, 0] and got[1, 1] and got[1, 2] and got[2, 0] and got[3, 0] and got[4, 0] and got[5, 0] and got[6, 0]
    assert not got[2, 1] and not got[None, 0]
    text = {r["doc_id"]: r["text"] for r in lines.drop_fuzzy_lines(docs_of(spark, rows)).collect()}
    assert text[1] == rows[0][1] and base[0].upper() not in text[2] and text[4] is None
    assert lines.fuzzy_lines(docs_of(spark, [])).count() == 0


def test_lines_find_what_the_method_defines(spark):
    """SimHash within the distance and edit similarity reached: same groups as over all pairs."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 120")
    got = lines.fuzzy_lines(docs, min_words=3).where("group_id is not null").collect()
    norm = lines.normalise(F.col("line"))
    table = docs.select(F.explode(F.split("text", "\n")).alias("line")).select(norm.alias("norm")).where("size(split(norm, ' ')) >= 3").distinct()
    nodes = table.withColumn("id", F.xxhash64("norm"))
    hashes = {r["id"]: r["simhash"] for r in lines.features(nodes).collect()}
    texts = [(r["id"], r["norm"]) for r in nodes.collect()]

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row = row, [i]
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        return row[-1]

    links = [
        (i, j)
        for k, (i, a) in enumerate(texts)
        for j, b in texts[:k]
        if ((hashes[i] ^ hashes[j]) & (2**64 - 1)).bit_count() <= 3 and edits(a, b) <= int(max(len(a), len(b)) * 0.15 + 1e-9)
    ]
    want = components({i for i, _ in texts}, links)
    assert {r["group_id"] for r in got} == set(want.values())


def test_line_query_links_alike_lines(spark, tmp_path):
    """One word changed, mostly more than 3 SimHash bits."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrst", k=6))
    rows, pairs = [], []
    for k in range(60):
        words = [word() for _ in range(rng.choice([8, 12, 25, 50]))]
        other = list(words)
        other[rng.randrange(len(words))] = word()
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
        if k % 4:  # apart from single lines, a line among others
            rows[-1] = (2 * k + 1, word() + "\n" + rows[-1][1])
        pairs.append((2 * k, 2 * k + 1))
    docs_of(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r["doc_id"], r["line_no"]): r for r in queries.op3_line_dedup(spark, str(tmp_path)).collect()}
    last = {i: t.count("\n") for i, t in rows}
    found = [got[a, 0]["group_id"] == got[b, last[b]]["group_id"] for a, b in pairs]
    assert sum(found) >= 0.95 * len(found)


def test_line_query_joins_short_repeats(spark, tmp_path):
    """One word, two words, and text without spaces."""
    rng = random.Random(12)
    han = "".join(chr(0x4E00 + rng.randrange(5000)) for _ in range(80))
    rows = [(0, "and ornd"), (1, "And  ornd"), (2, "Page"), (3, "page\n\n"), (4, han), (5, han[:40] + "一" + han[41:])]
    docs_of(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r["doc_id"], r["line_no"]): r for r in queries.op3_line_dedup(spark, str(tmp_path)).collect()}
    assert {k for k, r in got.items() if not r["kept"]} == {(1, 0), (3, 0), (5, 0)}
    assert got[3, 1]["group_id"] is None and got[3, 2]["group_id"] is None


def test_line_query_long_lines(spark, tmp_path):
    """Long lines of few common words, whose SimHashes are near anyway, and writing without spaces."""
    rng = random.Random(13)
    vocab = ["the", "of", "and"] * 20 + ["".join(rng.choices("abcdefghijklm", k=7)) for _ in range(40)]
    rows, pairs = [], []
    for k in range(40):
        words = rng.choices(vocab, k=rng.choice([40, 120, 400]))
        other = list(words)
        for at in rng.sample(range(len(words)), len(words) // 12):
            other[at] = rng.choice(vocab)
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
        pairs.append((2 * k, 2 * k + 1))
    han = "".join(chr(0x4E00 + rng.randrange(5000)) for _ in range(300))
    rows += [(80, han), (81, han[:150] + "一" + han[151:])]
    docs_of(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["group_id"] for r in queries.op3_line_dedup(spark, str(tmp_path)).collect()}
    assert sum(got[a] == got[b] for a, b in pairs) >= 0.95 * len(pairs) and got[80] == got[81]
    assert len(set(got.values())) >= 41  # no two of different pairs


def test_pieces_verify_decoding():
    codec = pieces.codec_for(queries.PIECES)
    texts = ["", "one  two", "naïve 漢字 \x00\U0001F600"]
    ids = [codec.encode(t) for t in texts]
    codec.verify(texts, ids, [codec.decode(x) for x in ids])
    with pytest.raises(AssertionError):
        codec.verify(texts, ids, ["", "one two", codec.decode(ids[2])])


def test_packing(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(["w"] * rng.randrange(0, 130)) + f" t{i % 40}") for i in range(300)] + [(300, None), (301, " "), (None, "a b"), (302, "q " * 1000)]
    docs = docs_of(spark, rows).withColumn("source", F.when(F.col("doc_id") % 3 > 0, F.lit("hot")).otherwise(F.col("doc_id").cast("string")))
    out = packing.pack(docs, capacity=100, source_col="source").collect()
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    sizes = {i: len((t or "").split()) for i, t in rows}
    for i, n in sizes.items():
        assert sum(r["n_tokens"] for r in out if r["doc_id"] == i) == n
    bins = defaultdict(list)
    for r in out:
        if r["bin_id"] is not None:
            bins[r["bin_id"]].append(r)
    for held in bins.values():
        assert sum(r["n_tokens"] for r in held) <= 100
        at = 0
        for r in sorted(held, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["n_tokens"]
        sources = [source[r["doc_id"]] for r in held if source[r["doc_id"]] is not None]
        assert len(set(sources)) == len(sources)
    assert packing.pack(docs_of(spark, []), capacity=100).count() == 0


def test_best_fit_takes_the_tightest_compatible_bin():
    bins = packing.Bins(10)
    assert [bins.place(7, 1, 0), bins.place(6, 0, 2), bins.place(3, 1, 0), bins.place(3, 0, 0), bins.place(1, 0, 2)] == [
        (0, 0), (1, 0), (1, 6), (0, 7), (2, 0)]


def test_pieces_agree_with_the_library():
    codec = pieces.Codec(queries.PIECES)
    rng = random.Random(1)
    alphabet = " ▁ab<s>\n\t\x00éß日本🦄　​�the.…1"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(4000)]
    texts += ["", " ", "x" * 3000, " " * 3000, "ab" * 3000, "日" * 500]
    ids = [codec.encode(t) for t in texts]
    assert ids == codec.library.encode(texts, add_bos=True, add_eos=True)
    assert [codec.decode(x) for x in ids] == codec.library.decode(ids)
    odd = [[rng.randrange(32000) for _ in range(6)] + [rng.randrange(3, 259) for _ in range(4)] for _ in range(500)]
    assert [codec.decode(x) for x in odd] == codec.library.decode(odd)


def test_piece_query(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)
    got = {r["doc_id"]: r for r in queries.op8_sentencepiece(spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = sp.encode(r["text"] or "", add_bos=True, add_eos=True)
        own = got[r["doc_id"]]
        assert own["n_tokens"] == len(ids)
        assert own["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert own["decoded_sha256"] == hashlib.sha256(sp.decode(ids).encode()).hexdigest()
    nulls = pieces.piece_digests(docs_of(spark, [(1, None), (None, "a")]), queries.PIECES).collect()
    assert [r["n_tokens"] for r in nulls] == [2, 3]
    assert pieces.piece_digests(docs_of(spark, []), queries.PIECES).count() == 0


def test_toxicity_ranks_held_out_rows():
    import duckdb

    sf = "/root/testdata/sf0.1"
    rows = duckdb.sql(f"select doc_id, coalesce(text, '') t, toxic from '{sf}/documents.parquet' join '{sf}/labels.parquet' using (doc_id) order by 1").fetchall()
    import zlib

    known = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2][:1500]
    unseen = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    model = toxicity.fit([r[1] for r in known], np.array([r[2] for r in known]))
    logits = model.bucket_logits()

    def score(text):
        words = toxicity.words_of(text)
        return toxicity.best_window(np.array([toxicity.word_logit(w, logits) for w in words]), toxicity.WINDOW)[1] if words else 0

    s, y = np.array([score(r[1]) for r in unseen]), np.array([r[2] for r in unseen])
    order = s.argsort().argsort()
    auc = (order[y == 1].sum() - y.sum() * (y.sum() - 1) / 2) / (y.sum() * (len(y) - y.sum()))
    assert auc > 0.85
    assert min(toxicity.word_logit(w, logits) for w in ("idiot", "idiiot", "morron", "patheticc")) > 3  # unseen spellings too


def test_toxicity_reads_runs_without_spaces():
    """Every n-gram of a long run lies in one of its parts; a toxic word late in it counts."""
    run = "".join(chr(0x4E00 + (k * 37) % 3000) for k in range(500))
    parts = toxicity.words_of(run)
    for k in range(len(run) - 2):
        assert any(run[k : k + 3] in p for p in parts)
    assert toxicity.words_of("Short word") == ["short", "word"] and toxicity.words_of(None) == []


def test_drop_toxic_goes_by_text(spark):
    """Rows that repeat an id are judged one by one; clashing names and empty tables pass."""
    rng = random.Random(4)
    words = [f"w{k}" for k in range(50)]
    rows = [(i, " ".join(rng.choices(words, k=12)) + (" idiot moron scum" if i % 6 == 0 else "")) for i in range(600)]
    labels = spark.createDataFrame([(i, int(i % 6 == 0)) for i, _ in rows] + [(1, None), (None, 1)], "doc_id long, toxic int")
    docs = docs_of(spark, [*rows, (1, "idiot moron scum idiot moron"), (1, None), (None, "w1 w2")])
    got = toxicity.drop_toxic(docs, labels)
    texts = {(r["doc_id"], r["text"]) for r in got.collect()}
    assert got.schema == docs.schema and (1, None) in texts and (None, "w1 w2") in texts and (1, rows[1][1]) in texts
    assert (1, "idiot moron scum idiot moron") not in texts and not any("idiot" in (t or "") for _, t in texts)
    assert toxicity.drop_toxic(docs.limit(0), labels, docs).count() == 0


def test_toxicity_query(spark):
    got = queries.op6_toxicity(spark, SF).collect()
    assert len(got) == 200 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    empty = toxicity.score(docs_of(spark, [(1, None), (2, ""), (None, "!")]), toxicity.train(docs_of(spark, []), spark.createDataFrame([], "doc_id long, toxic int")))
    assert [r["score"] for r in empty.collect()] == [0.5] * 3


def test_html():
    text = html_text.render(html_text.build_tree(
        "<title>no</title><style>x</style><h1>Head</h1><p>One <b>two</b>\n three<p>Next<br>line<div hidden>no</div>"
        "<ul><li>a<li>b<ol start=3><li>c</ol></ul><table><tr><th>Name<th>n<tr><td>long name<td>1</table>"
        "<p style='visibility:hidden'>no <i style='visibility:visible'>yes</i></p><script>if (a</b) no</script>&lt;end&gt;<pre>x\n  y</pre>"))
    assert text == ("Head\n\nOne two three\n\nNext\nline\n\n- a\n- b\n  3. c\n\nName       n\nlong name  1\n\nyes\n\n<end>\n\nx\n  y")
    assert html_text.render(html_text.build_tree("<div>" * 20000 + "deep")) == "deep"
    assert html_text.render(html_text.build_tree("<table><td rowspan=2>a<td>b<tr><td>c</table>")) == "a  b\n   c"
    for odd in ("<", "</", "<p", "<a b='", "<!--", "a<b>c</d>", "</p>x", "<td>x</td>", "<li>x", "<script>"):
        html_text.render(html_text.build_tree(odd))


def test_html_is_linear_and_aligns_wide_cells():
    import time

    start = time.perf_counter()
    for page in ("<a " * 300_000, '<a x="' * 150_000, "<span>" * 8_000 + "</p>" * 8_000, "<p><table><td>" + "<div>" * 8_000):
        html_text.build_tree(page)
    assert time.perf_counter() - start < 10
    wide = "w" * 200
    got = html_text.render(html_text.build_tree(f"<table><tr><td>{wide}<td>b</tr><tr><td>a<td>c</tr></table>"))
    first, second = [x for x in got.split("\n") if x]
    assert first.index("b") == second.index("c") > 200
    assert html_text.render(html_text.build_tree('<p title="a>b">x</p><p class="c"">y</p>')).split() == ["x", "y"]


def test_html_query(spark):
    pages = spark.createDataFrame([(1, None, "u"), (2, "", "u"), (None, "<p>a</p>", "u"), (3, "x" * 100000, "u")], "page_id long, html string, text string")
    got = {r["page_id"]: r["n_chars"] for r in html_text.extract_text(pages).collect()}
    assert got == {1: 0, 2: 0, None: 1, 3: 100000}
    assert html_text.extract_text(pages.limit(0)).count() == 0
    assert queries.op7_html_extraction(spark, SF).where("text rlike '<script|track\\\\('").count() == 0


def test_topk(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD", 90)
    monkeypatch.setattr(topk, "BLOCK", 16)
    monkeypatch.setattr(topk, "QUERIES", 3)
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8).round(2).tolist()) for i in range(400)] + [(400 + i, [0.5] * 8) for i in range(200)]
    bad = [(1000, None), (1001, [None] + [1.0] * 7), (1050, [float("nan")] * 8), (1100, [float("inf")] * 8), (None, [1.0] * 8), (600, [1.0])]
    vectors = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>")
    full = [*rows, (600, [1.0] + [0.0] * 7)]  # components that a vector lacks are 0
    ids = np.array([i for i, _ in full])
    ints = np.floor(256 * np.array([v for _, v in full], np.float32).astype(float)).astype(np.int64)
    want = []
    for q in ids[ids % 50 == 0]:
        s = ints @ ints[q]
        best = sorted((-s[c], c) for c in ids if c != q)[:5]
        want += [(q, k + 1, c, -x) for k, (x, c) in enumerate(best)]
    got = topk.top_k(vectors, F.col("id") % 50 == 0).collect()
    assert sorted(map(tuple, got)) == sorted(want)
    assert topk.top_k(vectors.limit(0), F.col("id") % 50 == 0).count() == 0


def brute_viterbi(hmm, rows):
    steps = []
    for role, text in rows:
        parsed_lines, marks, features = chat.parse(text)
        fresh = np.zeros(len(marks), bool)
        fresh[0] = True
        steps += list(hmm.steps(np.array(marks), np.array(features), fresh))
    score = np.full(chat.STATES, -np.inf)
    score[chat.START] = 0
    back = []
    for s in steps:
        total = score[:, None] + s
        back.append(total.argmax(axis=0))
        score = total.max(axis=0)
    state, path = int(score.argmax()), []
    for b in reversed(back):
        path.append(state)
        state = int(b[state])
    return path[::-1]


def test_chat_recovers_roles(spark):
    """Of conversations that the model has not learnt from, without their role column."""
    known = spark.read.parquet("/root/testdata/sf0.1/conversations.parquet")
    hmm = chat.train(known.where(chat.learns()))
    truth = known.where(~chat.learns()).select("conv_id", "turn", F.col("role").alias("truth"))
    got = chat.format_chats(known.drop("role"), hmm).groupBy("conv_id", "turn").agg(F.min(F.struct("part", "role")).alias("got"))
    right = truth.join(got, ["conv_id", "turn"]).agg(F.avg((F.col("truth") == F.col("got.role")).cast("int")), F.count("*")).first()
    print("roles recovered", right)
    assert right[1] == truth.count() and right[0] > 0.9


def test_chat_ignores_the_roles_of_others(spark):
    """Roles outside the training conversations change nothing; names may clash."""
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"{'Is it?' if t % 2 == 0 else 'It is.'} {c}") for c in range(40) for t in range(4)]
    table = spark.createDataFrame([(*r, 1, 2) for r in rows], "conv_id long, turn long, role string, text string, place int, at int")
    other = table.withColumn("role", F.when(chat.learns(), F.col("role")).otherwise("system"))
    a, b = (sorted(map(tuple, chat.format_chats(x).collect())) for x in (table, other))
    assert a == b and len(a) == 160 and {r[3] for r in a} == {"user", "assistant"}


def test_chat_is_viterbi_over_whole_conversations(spark):
    rng = random.Random(8)
    parts = ["User: hello?", "Assistant: hi\n- a\n- b", "what now?", "plain", "### System: be kind\nalways", "<|user|> q", "Human: a\nBot: b\nHuman: c?"]
    rows = [(1, t, rng.choice(["user", "assistant", None, "?"]), f"{rng.choice(parts)} {t}") for t in range(900)]
    rows += [(2, 0, "user", None), (2, 1, None, ""), (None, 0, "gpt", "x"), (3, None, None, "User: x"), (3, None, None, "User: x"), (4, 0, "human", "y " * 20000)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    hmm = chat.train(table)
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    got = chat.format_chats(table, hmm).orderBy("conv_id", "turn", "part").collect()
    want = brute_viterbi(hmm, [(r, t) for c, _, r, t in rows if c == 1])
    merged, at = [], 0
    for c, turn, r, t in rows:
        if c != 1:
            continue
        n = len(t.split("\n"))
        states = want[at : at + n]
        at += n
        merged += [(turn, chat.ROLES[s]) for k, s in enumerate(states) if k == 0 or states[k - 1] != s]
    assert [(r["turn"], r["role"]) for r in got if r["conv_id"] == 1] == merged
    assert [r["text"] for r in got if r["conv_id"] is None] == ["x"]
    assert len([r for r in got if r["conv_id"] == 3]) == 2
    assert chat.format_chats(table.limit(0), hmm).count() == 0


def test_pipeline(spark):
    import corpus_pipeline as p

    assert [n for n, _ in p.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "substring_dedup", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = p.exact_dedup_stage(spark, docs, SF)
    assert kept.columns == docs.columns
    first = {r["keep_id"] for r in exact.exact_groups(docs).collect()}
    assert {r["doc_id"] for r in kept.collect()} == first
    near = p.near_dedup_stage(spark, docs, SF)
    want = brute_near([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert {r["doc_id"] for r in near.collect()} == {i for i, c in want.items() if i == c}
    cut = p.substring_dedup_stage(spark, docs, SF)
    assert cut.columns == docs.columns and cut.count() == docs.count()
    clean = p.toxicity_stage(spark, docs, SF)
    assert clean.columns == docs.columns and 0.7 * docs.count() < clean.count() < docs.count()
    assert p.run(spark, SF).where("bin_id is not null").count() > 0


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_oracles(spark, name):
    import duckdb

    sf = "/root/testdata/sf0.001"
    db = duckdb.connect()
    for t in ("documents", "embeddings"):
        db.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    want = db.execute(queries.oracle_sql()[name]).df()
    got = queries.queries()[name](spark, sf).toPandas()
    columns = sorted(want.columns)
    assert (got[columns].sort_values(columns).to_numpy() == want[columns].sort_values(columns).to_numpy()).all()
