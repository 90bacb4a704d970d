"""Substring deduplication by sliding sentence spans (operator 4)."""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import materialise
from .workers import release

#: Documents and sentences up to which the removals are broadcast (about 8 MB);
#: beyond it the same join is shuffled.
BROADCAST_DOCS, BROADCAST_SENTENCES = 100_000, 1_000_000
#: Likewise the hashes of repeated spans (8 bytes each, some 50 in a hash table).
BROADCAST_HASHES = 50_000
#: Likewise the first places of repeated spans (some 100 bytes each).
BROADCAST_FIRSTS = 300_000

#: A sentence ends after a run of terminators (and closing quotes) or a line end;
#: white space after it belongs to it.  Joined, the sentences give the text back.
SENTENCE = re.compile(r"[^.!?。！？\n]*(?:[.!?。！？]+[\"'”’)\]]*|\n|\Z)\s*")


def sentences(text: str | None) -> list[str]:
    return [s for s in SENTENCE.findall(text or "") if s]


#: Texts whose spans are hashed together.
TEXTS = 256
#: What the queries take: sentences of over ``unit_words`` words are cut.
FINE = {"min_words": 16, "unit_words": 16, "both_ends": True}
#: One in so many neighbouring word pairs ends a unit in an overlong sentence.
CUT_RATE = 6
WORD = re.compile(r"\s*\S+\s*")


def cuts(words: list[str], unit_words: int) -> list[int]:
    """Where a sentence of over ``unit_words`` words is cut (0: never).  A cut depends
    on the two words before it only, so a repeated passage is cut alike anywhere."""
    if not unit_words or len(words) <= unit_words:
        return []
    pairs = (f"{a} {b}".encode("utf-8", "surrogatepass") for a, b in zip(words, words[1:], strict=False))
    return [i for i, p in enumerate(pairs, 2) if i < len(words) and zlib.crc32(p) % CUT_RATE == 0]


def unit_words_of(text: str | None, unit_words: int) -> list[list[str]]:
    """Of each unit the lower-cased words; units without words are left out."""
    out = []
    for s in sentences(text):
        words = s.lower().split()
        edges = [0, *cuts(words, unit_words), len(words)]
        out += [words[i:j] for i, j in zip(edges, edges[1:], strict=False) if i < j]
    return out


def units(text: str | None, unit_words: int) -> list[str]:
    """The sentences, overlong ones cut; joined, they give the text back."""
    out = []
    for s in sentences(text):
        edges = cuts(s.lower().split(), unit_words)
        if edges:
            tokens = WORD.findall(s)
            out += ["".join(tokens[i:j]) for i, j in zip([0, *edges], [*edges, len(tokens)], strict=True)]
        else:
            out.append(s)
    return out


def span_table(words: list[int], span: int, min_words: int, both_ends: bool = False) -> list[tuple[int, int]]:
    """``(start, length)`` of the shortest run from each start that has ``span``
    sentences and ``min_words`` words at least; with ``both_ends`` also of the
    shortest such run up to each end."""
    if both_ends:
        n = len(words)
        back = span_table(words[::-1], span, min_words)
        return sorted({*span_table(words, span, min_words), *((n - at - k, k) for at, k in back)})
    out, end, total = [], 0, 0
    for start in range(len(words)):
        while end < len(words) and (end - start < span or total < min_words):
            total += words[end]
            end += 1
        if end - start < span or total < min_words:
            break
        out.append((start, end - start))
        total -= words[start]
    return out


def span_hashes(docs: DataFrame, span: int, min_words: int, unit_words: int, both_ends: bool) -> DataFrame:
    """``(id, tag, pos, len, h1, h2)``: every span with its 128-bit hash.

    ``tag`` tells different texts of one repeated id apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        # a text gives some hundred spans: few texts at a time bound what a task holds
        for part in (batch.slice(start, TEXTS) for batch in batches for start in range(0, batch.num_rows, TEXTS)):
            counts, pos, length, digests = [], [], [], []
            for text in part.column(2).to_pylist():
                words = unit_words_of(text, unit_words)
                found = span_table(list(map(len, words)), span, min_words, both_ends)
                each = [xxhash.xxh3_128_digest(" ".join(w).encode("utf-8", "surrogatepass")) for w in words]
                counts.append(len(found))
                for start, n in found:
                    pos.append(start)
                    length.append(n)
                    digests.append(xxhash.xxh3_128_digest(b"".join(each[start : start + n])))
            pairs = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            reps = pa.array(np.repeat(np.arange(len(counts)), counts))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(reps),
                    part.column(1).take(reps),
                    pa.array(pos, pa.int32()),
                    pa.array(length, pa.int32()),
                    pa.array(pairs[:, 0]),
                    pa.array(pairs[:, 1]),
                ],
                ["id", "tag", "pos", "len", "h1", "h2"],
            )

    return docs.mapInArrow(run, "id long, tag long, pos int, len int, h1 long, h2 long")


def repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = 2, min_words: int = 20,
    unit_words: int = 0, both_ends: bool = False,
) -> DataFrame:
    """``(id, tag, drop)``: per text, the sentences to remove.

    The occurrence with the smallest (id, position) is the first of its span; the
    sentences of every other occurrence are covered, whether it lies in another
    text or further on in the same one."""
    source = docs.select(
        F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("tag"), F.col(text_col).alias("text")
    )
    # hashed once: the table is read for its hashes alone, then for the rows that share one
    spans = materialise(span_hashes(source, span, min_words, unit_words, both_ends), compression="zstd")
    # most spans occur once: half the hash tells, and only the others are kept in full
    repeated = materialise(spans.groupBy("h1").agg(F.count("*").alias("n")).where("n > 1").select("h1"))
    if repeated.count() <= BROADCAST_HASHES:
        repeated = F.broadcast(repeated)
    spans = materialise(spans.join(repeated, "h1", "left_semi").select("id", "tag", "pos", "len", "h1", "h2"), compression="zstd")
    place = F.struct(F.coalesce("id", F.lit(2**63 - 1)).alias("id"), "tag", "pos")
    seen = (
        spans.withColumn("place", place)
        .groupBy("h1", "h2")
        .agg(F.count("*").alias("n"), F.min("place").alias("first"))
        .where("n > 1")
    )
    # a passage that very many texts share is one row here, and its places stay where they are
    seen = materialise(seen)
    if seen.count() <= BROADCAST_FIRSTS:
        seen = F.broadcast(seen)
    later = spans.join(seen, ["h1", "h2"]).where(place != F.col("first"))
    # whole runs are gathered and spread within their row: a sentence lies in several runs
    runs = later.groupBy("id", "tag").agg(F.collect_list(F.struct("pos", "len")).alias("runs"))
    at = F.flatten(F.transform("runs", lambda r: F.sequence(r.pos, r.pos + r.len - 1)))
    return runs.select("id", "tag", F.array_sort(F.array_distinct(at)).alias("drop"))


def remove_repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = 2, min_words: int = 20,
    unit_words: int = 0, both_ends: bool = False,
) -> DataFrame:
    """``docs`` without the sentences that a repeated span covers, plus
    ``removed_sentences`` and ``removed_words``; the other columns stay.

    A span is the shortest run of sentences from its start that has ``span``
    sentences and ``min_words`` words; with ``both_ends`` the shortest such run up to
    each end is one too.  With ``unit_words`` a longer sentence is cut at places that
    its words define, and its parts count as sentences.  Spans are equal when their lower-cased words
    are (compared by 128-bit hash).  All spans of all texts are compared.

    Defined cases: null text stays null with nothing removed; texts with fewer
    sentences or words than a span needs stay as they are; a text may become empty;
    a null id sorts after all others; rows that repeat both id and text are one
    occurrence and change alike; an empty table gives an empty result; columns of
    ``docs`` called as the two added ones are replaced.
    """
    drops = materialise(repeated_spans(docs, id_col, text_col, span, min_words, unit_words, both_ends))
    size = drops.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.size("drop")), F.lit(0)).alias("s")).first()
    if size["n"] <= BROADCAST_DOCS and size["s"] <= BROADCAST_SENTENCES:
        drops = F.broadcast(drops)
    name, tag, drop, cut_col = (f"{x}_{uuid.uuid4().hex}" for x in ("id", "tag", "drop", "cut"))
    drops = drops.select(
        F.coalesce("id", F.lit(2**63 - 1)).alias(name), F.col("tag").alias(tag), F.col("drop").alias(drop)
    )
    tagged = docs.withColumn(name, F.coalesce(F.col(id_col).cast("long"), F.lit(2**63 - 1))).withColumn(
        tag, F.xxhash64(text_col)
    )
    joined = tagged.join(drops, [name, tag], "left")

    def cut_batch(text: pd.Series, drop: pd.Series) -> pd.DataFrame:
        release()
        return cut_sentences(text, drop, unit_words)

    cut = F.pandas_udf(cut_batch, "text string, removed_sentences int, removed_words int")(text_col, drop)
    return joined.withColumn(cut_col, cut).select(
        *[
            (F.when(F.col(text_col).isNotNull(), F.col(f"{cut_col}.text")).alias(c) if c == text_col else F.col(c))
            for c in docs.columns
            if c not in ("removed_sentences", "removed_words")
        ],
        F.col(f"{cut_col}.removed_sentences").alias("removed_sentences"),
        F.col(f"{cut_col}.removed_words").alias("removed_words"),
    )


def cut_sentences(text: pd.Series, drop: pd.Series, unit_words: int = 0) -> pd.DataFrame:
    """The texts without the sentences whose numbers ``drop`` holds; blank stretches
    have no number and stay."""
    out = []
    for t, gone in zip(text, drop, strict=True):
        if gone is None:
            out.append((t, 0, 0))
            continue
        gone, kept, words, at = set(gone.tolist()), [], 0, 0
        for s in units(t, unit_words):
            n = len(s.split())
            if n and at in gone:
                words += n
            else:
                kept.append(s)
            at += n > 0
        out.append(("".join(kept), len(gone), words))
    return pd.DataFrame(out, columns=["text", "removed_sentences", "removed_words"])
