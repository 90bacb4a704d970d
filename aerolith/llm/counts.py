"""Token counts of every prefix, by dynamic programming (operator 12)."""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Endings that the vocabulary's pattern takes with their apostrophe.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
#: Characters of a text that are worked on together, up to the next place where a space
#: parts two letters.
CHARACTERS = 1 << 20
CUT = re.compile("[a-z] (?=[a-z])")


@functools.lru_cache(maxsize=2)
def counter_for(vocabulary: str) -> Counter:
    """One counter for each Python worker, whatever the number of its tasks."""
    return Counter(vocabulary)


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: printable ones stand
    for themselves, the others follow from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Counter:
    """Counts the tokens of every prefix of a text with a byte-level merge vocabulary.

    Of the tokens that end a string of bytes, exactly one can be the last of its
    encoding: the one that stays apart from the last token of what is before it.  So the
    last token, and the count, of each prefix follow from those of shorter ones, without
    encoding any prefix.  Runs of white space, letters, digits and others are counted
    apart, as the vocabulary merges nothing across their borders."""

    #: Pieces that the memo holds, and characters of theirs.
    MEMO, POOL = 600_000, 1 << 23

    def __init__(self, vocabulary: str):
        import ahocorasick
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(vocabulary)
        with open(vocabulary, encoding="utf-8") as f:
            file = json.load(f)
        step, model = file["pre_tokenizer"], file["model"]
        plain = file["normalizer"] is None and step["type"] == "ByteLevel" and step["use_regex"] and not step["add_prefix_space"]
        if not plain or model["type"] != "BPE" or model["dropout"] or model["unk_token"] or model.get("ignore_merges"):
            raise ValueError("needs a byte-level merge vocabulary without normaliser or prefix space")
        letters = byte_letters()
        raw = lambda piece: bytes(letters[c] for c in piece)
        self.bytes = {i: raw(piece) for piece, i in model["vocab"].items()}
        self.ids = {b: i for i, b in self.bytes.items()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        #: (left id, right id) -> (rank, id of the union)
        self.merges = {(self.ids[raw(a)], self.ids[raw(b)]): (rank, self.ids[raw(a + b)]) for rank, (a, b) in enumerate(pairs)}
        self.endings = ahocorasick.Automaton()  # finds all tokens that end at a byte
        for b, i in self.ids.items():
            self.endings.add_word(b.decode("latin-1"), (len(b), i))
        self.endings.make_automaton()
        self.intact: dict[int, bool] = {}
        self.apart: dict[int, bool] = {}
        added = file["added_tokens"]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError("needs added tokens without conditions")
        self.added = [t["content"] for t in added]
        self.special = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if added else None
        self.classes = {c: set() for c in "LNS"}
        self.classed: set[str] = set()
        self.forget()
        self.learn({chr(c) for c in range(128)})

    def forget(self) -> None:
        """Empties the memo: ``slots`` of pieces, whose counts lie one after the other in a
        pool; of each slot where they begin, how many there are, the last, and its white space."""
        self.slots: dict[str, int] = {}
        self.pool, self.used = np.zeros(1 << 16, np.int32), 0
        self.begin, self.length, self.whole = (np.zeros(1 << 12, t) for t in (np.int64, np.int64, np.int32))
        self.blank, self.led = np.zeros(1 << 12, bool), np.zeros(1 << 12, bool)

    def learn(self, characters: set[str]) -> None:
        """Asks the library for the class of new characters: beside a letter, a digit or a
        space those of its class are not parted from it."""
        new = sorted(characters - self.classed)
        if not new:
            return
        split = self.library.pre_tokenizer.pre_tokenize_str
        for c in new:
            for name, beside in (("L", "a"), ("N", "1")):
                if len(split(beside + c)) == 1:
                    self.classes[name].add(c)
                    break
            else:
                # a run of white space before a mark keeps all but its last character
                parts = split(f"!{c}{c}!")
                if len(parts) == 4 or c == " ":
                    self.classes["S"].add(c)
        self.classed.update(new)
        of = {k: "".join(map(re.escape, sorted(v))) for k, v in self.classes.items()}
        every = "".join(of.values())
        self.pattern = re.compile(f"'(?:{'|'.join(ENDINGS)})| ?[{of['L']}]+| ?[{of['N']}]+| ?[^{every}]+|[{of['S']}]+(?![^{of['S']}])|[{of['S']}]+")
        self.space = self.classes["S"]

    def merged(self, data: bytes) -> list[int]:
        """Ids by merging the pair of lowest rank, the leftmost of equals; for what is as
        short as two tokens."""
        ids = [self.ids[bytes([b])] for b in data]
        while len(ids) > 1:
            rank, at = min((self.merges.get(p, (1 << 40, 0))[0], k) for k, p in enumerate(zip(ids, ids[1:])))
            if rank == 1 << 40:
                break
            ids[at : at + 2] = [self.merges[ids[at], ids[at + 1]][1]]
        return ids

    def stays_whole(self, token: int) -> bool:
        known = self.intact.get(token)
        if known is None:
            known = self.intact[token] = self.merged(self.bytes[token]) == [token]
        return known

    def stay_apart(self, left: int, right: int) -> bool:
        """Whether the bytes of two tokens, one after the other, are encoded as the two."""
        key = left << 32 | right
        known = self.apart.get(key)
        if known is None:
            if len(self.apart) >= 4 * self.MEMO:
                self.apart.clear()
            known = self.apart[key] = self.merged(self.bytes[left] + self.bytes[right]) == [left, right]
        return known

    def prefixes(self, data: bytes) -> np.ndarray:
        """Tokens of ``data[:k]`` for k from 0, of bytes that are one piece."""
        counts, last = [0] * (len(data) + 1), [-1] * (len(data) + 1)
        for end, (n, token) in self.endings.iter(data.decode("latin-1")):
            end += 1
            if last[end] >= 0:
                continue
            before = last[end - n]
            if self.stays_whole(token) if end == n else self.stay_apart(before, token):
                last[end], counts[end] = token, counts[end - n] + 1
        return np.array(counts, np.int32)

    def piece_counts(self, piece: str) -> np.ndarray:
        """Tokens of ``piece[:k]`` for k from 1, each prefix taken by itself."""
        data = piece.encode("utf-8")
        counts = self.prefixes(data)
        if len(data) != len(piece):  # only the ends of characters count
            raw = np.frombuffer(data, np.uint8)
            counts = counts[np.append(np.flatnonzero((raw & 0xC0) != 0x80)[1:], len(data))]
        else:
            counts = counts[1:]
        if len(piece) == 3 and piece[0] == "'" and piece[1:] in ENDINGS:
            # cut after one letter it is a mark and a letter
            counts = counts.copy()
            counts[1] = sum(self.prefixes(c.encode())[-1] for c in piece[:2])
        return counts

    def slot(self, piece: str) -> int:
        found = self.slots.get(piece)
        if found is not None:
            return found
        counts = self.piece_counts(piece)
        end, found = self.used + len(counts), len(self.slots)
        if end > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(max(len(self.pool), len(counts)), np.int32)])
        if found == len(self.begin):
            for name in ("begin", "length", "whole", "blank", "led"):
                setattr(self, name, np.concatenate([getattr(self, name), np.zeros_like(getattr(self, name))]))
        self.pool[self.used : end] = counts
        self.begin[found], self.length[found] = self.used, len(counts)
        self.whole[found] = counts[-1]
        self.led[found], self.blank[found] = piece[0] in self.space, piece[0] in self.space and piece[-1] in self.space
        self.slots[piece], self.used = found, end
        return found

    def parts(self, text: str) -> Iterator[tuple[np.ndarray, np.ndarray, list[str]]]:
        """Of a text without special tokens, stretch by stretch: the slots of its pieces,
        their tokens added up, and the pieces.  With the pool that is the count of every
        prefix; ``spread`` writes them out."""
        at = 0
        while at < len(text):
            cut = CUT.search(text, at + CHARACTERS) if at + CHARACTERS < len(text) else None
            end = cut.start() + 1 if cut else len(text)  # a border of pieces, whatever follows
            if len(self.slots) >= self.MEMO or self.used > self.POOL:
                self.forget()
            pieces = self.pattern.findall(text if end - at == len(text) else text[at:end])
            slots = list(map(self.slots.get, pieces))
            if None in slots:
                slots = [self.slot(p) if s is None else s for p, s in zip(pieces, slots, strict=True)]
            s = np.array(slots, np.int64)
            yield s, np.cumsum(self.whole[s], dtype=np.int32), pieces
            at = end

    def plain_count(self, text: str) -> int:
        return sum(int(totals[-1]) for _, totals, _ in self.parts(text))

    def plain_counts(self, text: str) -> np.ndarray:
        """``counts`` from k = 1, of a text without special tokens."""
        out, base = [np.zeros(0, np.int32)], 0
        for part in self.parts(text):
            out.append(self.spread(*part) + np.int32(base))
            base = int(out[-1][-1])
        return np.concatenate(out)

    def spread(self, s: np.ndarray, totals: np.ndarray, pieces: list[str]) -> np.ndarray:
        begin, length = self.begin[s], self.length[s]
        ends = np.cumsum(length)
        counts = self.pool[np.arange(ends[-1]) + np.repeat(begin - (ends - length), length)] + np.repeat(totals - self.whole[s], length)
        # white space is parted before other text, but one piece where a prefix ends in it
        for k in np.flatnonzero(self.blank[s[:-1]] & self.led[s[1:]]):
            run = pieces[k] + pieces[k + 1][0]
            counts[ends[k]] = (totals[k - 1] if k else 0) + self.run_count(run)
        return counts

    @functools.lru_cache(maxsize=1000)  # noqa: B019
    def run_count(self, run: str) -> int:
        return int(self.piece_counts(run)[-1])

    def counts(self, text: str) -> np.ndarray:
        """Tokens of ``text[:k]``, for k from 0, each as the library counts it by default."""
        out, base = [np.zeros(1, np.int32)], 0
        for own, mark in self.sections(text):
            # until its last character a special token is text like any other
            got = self.plain_counts(own + mark[:-1]) + np.int32(base)
            out.append(got)
            if mark:
                base = (int(got[len(own) - 1]) if own else base) + 1
                out.append(np.array([base], np.int32))
        return np.concatenate(out)

    def count(self, text: str) -> int:
        """The last of ``counts``."""
        return sum(self.plain_count(own) + (mark != "") for own, mark in self.sections(text))

    def sections(self, text: str) -> list[tuple[str, str]]:
        """Stretches without special tokens, each with the one that ends it ("": the end)."""
        if not text.isascii():
            self.learn(set(text))
        out, at = [], 0
        for m in self.special.finditer(text) if self.special else ():
            out.append((text[at : m.start()], m.group()))
            at = m.end()
        return [*out, (text[at:] if at else text, "")]


def prefix_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, counts array<int>`` for every row: ``counts[k]`` is the number of tokens of
    the text's first k characters, from 0 to all of them, as the library gives it for that
    prefix alone.  ``total``, ``longest_fit`` and ``spent`` answer questions from it.

    Defined cases: a null text is empty (its counts are a single 0); a special token in a
    text is one token once it is whole; very long texts, with or without white space, take
    time linear in their length; null ids and repeated rows are carried along; an empty
    table gives an empty result; further columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_for(vocabulary)
        for batch in batches:
            for start in range(0, batch.num_rows, 64):  # bounds what is held of long texts
                part = batch.slice(start, 64)
                each = [counter.counts(t or "") for t in part.column(1).to_pylist()]
                offsets = pa.array(np.cumsum([0, *map(len, each)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(each)))], ["doc_id", "counts"])

    return named(docs, id_col, text_col).mapInArrow(run, "doc_id long, counts array<int>")


def named(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def total(counts: Column) -> Column:
    return F.element_at(counts, -1)


def longest_fit(counts: Column, budget: Column | int) -> Column:
    """Characters of the longest prefix with at most ``budget`` tokens (a longer prefix can
    have fewer tokens, so this is not the first that has more)."""
    fits = F.transform(F.reverse(counts), lambda n: n <= F.lit(budget))
    return F.size(counts) - F.array_position(fits, True).cast("int")


def spent(counts: Column, characters: Column | int) -> Column:
    """Tokens of the first ``characters`` characters; all tokens, if there are fewer."""
    return F.element_at(counts, F.least(F.lit(characters), F.size(counts) - 1) + 1)


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row: the count of the longest of
    its prefixes, and whether it is over ``limit``.  The counts of the others stay in the
    task; the cases are those of ``prefix_counts``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_for(vocabulary)
        for batch in batches:
            texts = (value.as_py() or "" for value in batch.column(1))
            rows = [(len(t) if t.isascii() else len(t.encode("utf-8")), counter.count(t)) for t in texts]
            size, tokens = (np.array([r[k] for r in rows], np.int64) for k in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size), pa.array(tokens), pa.array(tokens > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"]
            )

    return named(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
