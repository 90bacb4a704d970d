"""MinHash near-duplicate detection with tensored banding (operator 10)."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .linking import bucket_components, only_ids
from .storage import materialise
from .workers import release


class WordHashes(dict):
    """Memo of word -> 64-bit hash; emptied when it reaches its bound."""

    BOUND = 200_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.BOUND:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: a bijection that spreads every input bit."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def shingle_hashes(text: str | None, words: int, memo: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``words``-word shingles of ``text``.

    ``bytes.lower`` and ``bytes.split`` touch only A-Z and 0x20, 0x09-0x0D."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(memo.__getitem__, tokens), np.uint64, len(tokens))
    width = min(words, len(h))
    out = np.full(len(h) - width + 1, np.uint64(width))
    for k in range(width):
        out = mix(out + h[k : len(h) - width + 1 + k])
    return np.unique(out)


def coefficients(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240131)
    a = rng.integers(1, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, rng.integers(0, 2**63, n, dtype=np.uint64)


def minhashes(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    low = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), 2048):  # bounds the work matrix for long texts
        block = shingles[start : start + 2048, None] * a[None, :] + b[None, :]
        np.minimum(low, block.min(axis=0), out=low)
    return low


#: Longs of a set's bitmap, which bounds what two sets share.
LONGS = 32


def bitmap(shingles: np.ndarray) -> np.ndarray:
    """LONGS longs in which every shingle sets the bit that its hash names."""
    bits = np.zeros(64 * LONGS, np.uint8)
    bits[(shingles >> np.uint64(17)) % np.uint64(64 * LONGS)] = 1
    return np.packbits(bits).view(np.int64)


def signatures(docs: DataFrame, words: int, groups: int, width: int) -> DataFrame:
    """Per row: id, n, two set digests, ``2 * groups`` sub-keys, each a hash of
    ``width`` minhashes (the two smaller collections that tables are built from)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        memo = WordHashes()
        a, b = coefficients(2 * groups * width)
        for batch in batches:
            ids, n, d1, d2, subs = [], [], [], [], []
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                s = shingle_hashes(text.as_py(), words, memo)
                ids.append(doc_id.as_py())
                n.append(len(s))
                digest = xxhash.xxh3_128_intdigest(s.tobytes())
                d1.append((digest >> 64) - 2**63)
                d2.append((digest & (2**64 - 1)) - 2**63)
                m = minhashes(s, a, b).reshape(2 * groups, width)
                key = np.arange(1, 2 * groups + 1, dtype=np.uint64)
                for k in range(width):
                    key = mix(key + m[:, k])
                subs.append(key.view(np.int64))
            flat = pa.array(np.concatenate(subs) if subs else np.empty(0, np.int64))
            ends = pa.array(np.arange(0, len(flat) + 1, 2 * groups, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(n, pa.int64()),
                    pa.array(d1, pa.int64()),
                    pa.array(d2, pa.int64()),
                    pa.ListArray.from_arrays(ends, flat),
                ],
                ["id", "n", "d1", "d2", "subs"],
            )

    return docs.mapInArrow(run, "id long, n long, d1 long, d2 long, subs array<long>")


def shingle_sets(docs: DataFrame, words: int) -> DataFrame:
    """``(id, s, bits)`` with the whole shingle set of each row and its bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        memo = WordHashes()
        for batch in batches:
            rows = [shingle_hashes(t.as_py(), words, memo) for t in batch.column(1)]
            ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
            flat = np.concatenate(rows).view(np.int64) if rows else np.empty(0, np.int64)
            bits = np.concatenate([bitmap(r) for r in rows]) if rows else np.empty(0, np.int64)
            at = np.arange(0, len(bits) + 1, LONGS, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                    pa.ListArray.from_arrays(pa.array(at), pa.array(bits)),
                ],
                ["id", "s", "bits"],
            )

    return docs.mapInArrow(run, "id long, s array<long>, bits array<long>")


def shared_shingles(sets: DataFrame, similarity_pct: int) -> DataFrame:
    """``(id, sid, n, c, share)`` of those ``sets(id, sid, s)`` that can have a link: c of
    the n shingles occur under another id too, and that is the similarity's share."""
    each = sets.select("id", "sid", F.explode("s").alias("h"))
    shared = each.groupBy("h").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("h")
    counts = each.join(shared, "h").groupBy("id", "sid").agg(F.count("*").alias("c"))
    sizes = sets.select("id", "sid", F.size("s").cast("long").alias("n"))
    return (
        sizes.join(counts, ["id", "sid"])
        .where(F.col("c") * 100 >= F.col("n") * similarity_pct)
        .withColumn("share", F.col("c") / F.col("n"))
    )


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 5,
    similarity_pct: int = 75,
    groups: int = 16,
    width: int = 4,
) -> DataFrame:
    """Near-duplicate groups of ``docs``.

    A row's set is its distinct ``words``-word shingles (A-Z lower-cased, words
    split on 0x20 and 0x09-0x0D); fewer words give the whole sequence as the one
    member.  Rows are linked when ``100 * |A & B| >= similarity_pct * |A | B|``.

    Method.  Two collections of ``groups`` sub-keys (``width`` minhashes each) are
    computed; the ``groups ** 2`` table keys are all pairs of one sub-key from
    either, so 2 * groups * width minhashes serve tables that plain banding would
    need groups ** 2 * 2 * width for.  A table key can be shared only if both its
    sub-keys are, so sub-keys that occur once are dropped before tables are formed.
    Rows with equal sets are one node throughout.  Pairs that share a table are
    verified on full sets; see ``bucket_components`` for large tables.

    Before that exact bounds leave nodes out: of a node of n shingles at least
    ``similarity * n`` must occur in some other node that shares a table with any, or it
    can have no link; and as the smaller set of a link of Jaccard similarity s shares
    ``2 s / (1 + s)`` of its shingles, no pair is formed in which both share less.  The
    node most of whose shingles are shared is the first hub of its tables.  In the last
    pass over large tables a bitmap of each set bounds what two sets share before their
    pair is formed.  What is lost is what the tables miss, 1 link in 200 at exactly 0.75.

    Returns ``doc_id, n_shingles, component_id, kept`` plus ``class_id`` (smallest
    id with the same set).  Defined cases: null or blank text has an empty set and
    is linked with nothing; a row with null id is linked with nothing, its
    component_id is null and it is kept; a repeated id is one node, linked by any
    of its texts; an empty table gives an empty result; further columns of ``docs``
    are not read.
    """
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    table = materialise(signatures(source, words, groups, width))
    live = table.where("n > 0 and id is not null")
    classes = live.groupBy("d1", "d2").agg(
        F.min("id").alias("class_id"), F.first("n").alias("n"), F.first("subs").alias("subs")
    )
    nodes = materialise(classes)

    # sub-keys that two nodes share
    sub = nodes.select(
        F.col("class_id").alias("id"), F.posexplode("subs").alias("pos", "sub")
    )
    shared = sub.groupBy("pos", "sub").agg(F.count("*").alias("c")).where("c > 1").drop("c")
    alive = sub.join(shared, ["pos", "sub"]).groupBy("id").agg(F.collect_list(F.struct("pos", "sub")).alias("p"))
    tables = alive.select(
        "id",
        F.explode(F.filter("p", lambda x: x.pos < groups)).alias("x"),
        F.filter("p", lambda x: x.pos >= groups).alias("ys"),
    ).select("id", "x", F.explode("ys").alias("y"))
    keys = tables.select("id", F.xxhash64("x.pos", "x.sub", "y.pos", "y.sub").alias("bucket"))
    met = keys.groupBy("bucket").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi")
    keys = materialise(keys.join(met.select("bucket"), "bucket"))
    ids = keys.select(F.col("id").alias("a"), F.col("id").alias("b"))
    sets = materialise(
        shingle_sets(only_ids(source, ids).select("id", "text"), words)
        .where(F.size("s") > 0)
        .withColumn("sid", F.xxhash64("s"))
        .distinct()
    )
    shares = materialise(shared_shingles(sets, similarity_pct))
    keys = keys.join(shares.groupBy("id").agg(F.max("share").alias("weight")), "id")
    # the last pass joins the sub-keys of the first collection, of which there are fewer
    coarse = sub.where(F.col("pos") < groups).select("id", F.xxhash64("pos", "sub").alias("bucket"))
    coarse = coarse.join(shares.select("id", "sid", "n", "c"), "id")
    detail = (
        sets.select("id", "sid", *[F.col("bits")[k].alias(f"k{k}") for k in range(LONGS)])
        .join(shares.select("id", "sid"), ["id", "sid"])
        .join(nodes.select(F.col("class_id").alias("id"), *[F.col("subs")[k].alias(f"s{k}") for k in range(2 * groups)]), "id")
    )

    def verify(pairs: DataFrame) -> DataFrame:
        both = pairs.join(sets.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a").join(
            sets.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b"
        )
        common = F.size(F.array_intersect("sa", "sb"))
        return (
            both.withColumn("i", common)
            .where(F.expr(f"100 * i >= {similarity_pct} * (size(sa) + size(sb) - i)"))
            .select("a", "b")
            .distinct()
        )

    def narrow(rows: DataFrame) -> DataFrame:
        """Rows whose shared shingles admit a link to a set as small as the least of
        their bucket; twice, as what goes leaves other buckets with one component."""
        for _ in range(2):
            by = rows.groupBy("bucket").agg(
                F.min("component").alias("c0"), F.max("component").alias("c1"), F.min("n").alias("least")
            )
            by = by.where("c0 < c1").select("bucket", "least")
            enough = f"c * {100 + similarity_pct} >= {similarity_pct} * (n + greatest(least, ceil(n * {similarity_pct} / 100)))"
            rows = materialise(rows.join(by, "bucket").where(enough).drop("least"))
        return rows

    def may_link(left: str, right: str):
        """The sets' sizes, shared shingles and bitmaps admit the similarity, the two
        share a table, and this is the first sub-key they share, so that a pair is
        formed once.  A bit that one set has and the other has not stands for a shingle
        that is not in both, so no link is lost."""
        (n0, n1), (c0, c1) = [[F.col(f"{side}.{x}") for side in (left, right)] for x in "nc"]
        alone = [
            sum(F.bit_count(F.col(f"{x}.k{k}").bitwiseAND(F.bitwise_not(F.col(f"{y}.k{k}")))) for k in range(LONGS))
            for x, y in ((left, right), (right, left))
        ]
        common = F.least(c0, c1, n0 - alone[0], n1 - alone[1])
        same = [F.col(f"{left}.s{k}") == F.col(f"{right}.s{k}") for k in range(2 * groups)]
        first = F.coalesce(*[F.when(same[k], F.xxhash64(F.lit(k), F.col(f"{left}.s{k}"))) for k in range(groups)])
        table = same[groups]
        for k in range(groups + 1, 2 * groups):
            table = table | same[k]
        fits = F.least(n0, n1) * 100 >= F.greatest(n0, n1) * similarity_pct
        return fits & table & (common * (100 + similarity_pct) >= (n0 + n1) * similarity_pct) & (F.col(f"{left}.bucket") == first)

    # an id that is repeated with different texts ties their classes together
    several = live.groupBy("id").agg(F.min("d1").alias("lo"), F.max("d1").alias("hi")).where("lo < hi")
    ties = (
        live.join(several, "id", "left_semi")
        .join(nodes.select("d1", "d2", "class_id"), ["d1", "d2"])
        .select(F.least("id", "class_id").alias("a"), F.greatest("id", "class_id").alias("b"))
        .where("a < b")
        .distinct()
    )
    _, found = bucket_components(keys, verify, may_link, detail, ties, coarse, narrow)
    by_class = nodes.select("d1", "d2", "class_id").join(
        found.withColumnRenamed("id", "class_id"), "class_id", "left"
    )
    by_class = by_class.withColumn("component", F.coalesce("component", "class_id"))
    return (
        table.select("id", "n", "d1", "d2")
        .join(by_class, ["d1", "d2"], "left")
        .select(
            F.col("id").alias("doc_id"),
            F.col("n").alias("n_shingles"),
            F.when(F.col("n") > 0, F.coalesce("component", "id")).otherwise(F.col("id")).alias("component_id"),
            F.when(F.col("n") > 0, F.coalesce("class_id", "id")).otherwise(F.col("id")).alias("class_id"),
        )
        .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
        .withColumn("class_id", F.when(F.col("doc_id").isNotNull(), F.col("class_id")))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
        .select("doc_id", "n_shingles", "component_id", "kept", "class_id")
    )


def keep_one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the near-duplicates of an earlier document; all columns stay.

    The id is the unit: rows that repeat an id stay or go together, with the cases
    of ``near_duplicates`` (null ids and blank texts stay); column names never clash."""
    dropped = near_duplicates(docs, id_col, text_col).where("not kept").select("doc_id").distinct()
    gone = f"gone_{uuid.uuid4().hex}"
    return docs.join(dropped.withColumnRenamed("doc_id", gone), F.col(id_col).cast("long") == F.col(gone), "left_anti")
