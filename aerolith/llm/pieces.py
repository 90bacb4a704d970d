"""SentencePiece encoding and decoding for merge-type vocabularies (operator 8)."""

from __future__ import annotations

import codecs
import functools
import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
MARK = SPACE.encode("utf-8")
#: Space marks with the letters and digits (but ²), or the other characters, that follow.  No
#: piece goes on over such a border (checked on loading), so no merge crosses a unit.
UNIT = re.compile(f"{SPACE}*(?:[^\\W_²]+|(?:[_²]|[^\\w{SPACE}])+)|{SPACE}+")
#: Units for Arrow's regular expressions, whose borders no piece goes over either; they may
#: differ from ``UNIT`` in characters that only one of the two takes for letters.
WORD = r"\p{L}\p{Nd}\p{Nl}"
ARROW_UNIT = f"{SPACE}*(?:[{WORD}]+|[^{WORD}{SPACE}]+)|{SPACE}+"
#: Characters of a unit that is merged together with others, and units in one such step.
SHORT, TOGETHER = 32, 4096
#: Bytes of texts that are encoded together (one text at least).
SLICE = 2_000_000

GONE = -2


def one_mark_per_byte(error: UnicodeError) -> tuple[str, int]:
    """The library's way with malformed bytes: each becomes U+FFFD."""
    return "\ufffd", error.start + 1


codecs.register_error("one_mark_per_byte", one_mark_per_byte)


def parted(marked: pa.Array) -> pa.Array:
    """The units of each of ``marked``, texts whose spaces are marks, and an empty one at its end."""
    return pc.split_pattern(pc.replace_substring_regex(marked, ARROW_UNIT, "\\0 "), " ")


def strings(texts: pa.Array) -> list[str]:
    """A fresh large_string array as strings, of all its bytes at once: many are short."""
    upto = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1)
    whole = texts.buffers()[2].to_pybytes()[: int(upto[-1])].decode("utf-8")
    ends = np.cumsum(pc.utf8_length(texts).to_numpy()).tolist()
    return [whole[i:j] for i, j in zip([0, *ends], ends, strict=False)]


def gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` that begin at ``starts``, one after the other."""
    ends = np.cumsum(sizes)
    return flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)]


@functools.lru_cache(maxsize=2)
def codec_for(model_file: str) -> Codec:
    """One codec for each Python worker, whatever the number of its tasks."""
    return Codec(model_file)


class Codec:
    """Encodes by merging, decodes by joining pieces; holds a bounded memo of units."""

    MEMO = 250_000

    def __init__(self, model_file: str):
        import sentencepiece

        sp = self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_byte(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.ids = {self.pieces[i]: i for i in plain}
        # rank of a score: 0 for the highest; equal scores share a rank
        order = {score: r for r, score in enumerate(sorted({sp.get_score(i) for i in plain}, reverse=True))}
        self.ranks = {i: order[sp.get_score(i)] for i in plain}
        self.never = self.ranks[-1] = len(order)  # of a pair without a union
        # (left id, right id) -> id of their union, for every split of every piece
        self.pairs = {
            self.ids[p[:k]] << 32 | self.ids[p[k:]]: i
            for p, i in self.ids.items()
            for k in range(1, len(p))
            if p[:k] in self.ids and p[k:] in self.ids
        }
        self.byte_ids = {int(self.pieces[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        self.bytes = {i: b for b, i in self.byte_ids.items()}
        self.control = {i for i in range(n) if sp.is_control(i)}
        self.parts = [
            b"" if i in self.control else bytes([self.bytes[i]]) if i in self.bytes else self.pieces[i].encode("utf-8")
            for i in range(n)
        ]
        self.bos, self.eos, self.unknown = sp.bos_id(), sp.eos_id(), sp.unk_id()
        held = pa.array([p for p in self.ids if p], pa.large_string())
        over = any(len(UNIT.findall(p)) != 1 for p in self.ids if p) or pc.any(pc.greater(pc.list_value_length(parted(held)), 2)).as_py()
        if over or len(self.byte_ids) != 256:
            raise ValueError("needs a vocabulary with byte pieces, and with no piece over the border of two units")
        self.memo: dict[str, tuple[int, ...]] = {}
        # the same as arrays: id of a character, pairs in order with their unions, rank of an id (the last: no union)
        self.char_ids = np.full(0x110000, -1, np.int64)
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self.char_ids[ord(piece)] = i
        self.pair_keys = np.array(sorted(self.pairs), np.int64)
        self.pair_ids = np.array([self.pairs[k] for k in self.pair_keys.tolist()], np.int64)
        self.rank_of = np.full(n + 1, self.never, np.int64)
        self.rank_of[plain] = [self.ranks[i] for i in plain]
        # bytes of each id, and then of each as the first of a text, whose mark goes
        first = [p if i in self.bytes else p.removeprefix(MARK) for i, p in enumerate(self.parts)]
        self.part_array = pa.array(self.parts + first, pa.large_binary())
        self.forget()

    def forget(self) -> None:
        """Empties the memo of ``encode_array``: ids of all its units in one array, and where each has
        its own.  Row 0 is the begin id, and 1, of the empty unit at the end of a text, the end id."""
        self.rows = {"": 1}
        self.flat = np.array([self.bos, self.eos], np.int32)
        self.starts, self.sizes = np.array([0, 1]), np.array([1, 1])

    def merge_short(self, unit: str) -> list[int]:
        """``merge`` with the agenda as one rank for each adjacent pair: below some
        thirty symbols finding the lowest is cheaper than keeping a heap."""
        pair, rank, never = self.pairs.get, self.ranks, self.never
        symbols = [self.ids.get(c, -1) for c in unit]
        unions = [pair(a << 32 | b, -1) for a, b in zip(symbols, symbols[1:])]
        agenda = [rank[u] for u in unions]
        while agenda and (best := min(agenda)) != never:
            i = agenda.index(best)  # the leftmost of equals
            joined = symbols[i] = unions[i]
            del symbols[i + 1], unions[i], agenda[i]
            if i < len(unions):
                u = unions[i] = pair(joined << 32 | symbols[i + 1], -1)
                agenda[i] = rank[u]
            if i:
                u = unions[i - 1] = pair(symbols[i - 1] << 32 | joined, -1)
                agenda[i - 1] = rank[u]
        if -1 not in symbols:
            return symbols
        at, out = 0, []
        for s in symbols:  # only single characters can be out of the vocabulary
            if s >= 0:
                out.append(s)
                at += len(self.pieces[s])
            else:
                out += [self.byte_ids[b] for b in unit[at].encode("utf-8")]
                at += 1
        return out

    def merge(self, unit: str) -> list[int]:
        """Repeatedly joins the adjacent pair whose union has the highest score,
        the leftmost among equals, taken from an agenda of all such pairs.

        Agenda entries are ``rank * 2^32 + position of the left symbol``."""
        pairs, ranks = self.pairs, self.ranks
        symbols = [self.ids.get(c, -1) for c in unit]
        n = len(symbols)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        agenda = [
            ranks[joined] << 32 | i
            for i in range(n - 1)
            if (joined := pairs.get(symbols[i] << 32 | symbols[i + 1])) is not None
        ]
        heapq.heapify(agenda)
        while agenda:
            entry = heapq.heappop(agenda)
            left = entry & 0xFFFFFFFF
            right = after[left]
            if right < 0 or symbols[left] == GONE:
                continue
            joined = pairs.get(symbols[left] << 32 | symbols[right])
            if joined is None or ranks[joined] != entry >> 32:  # one of the two has changed since
                continue
            symbols[left], symbols[right] = joined, GONE
            after[left] = nxt = after[right]
            if nxt >= 0:
                before[nxt] = left
                if (new := pairs.get(joined << 32 | symbols[nxt])) is not None:
                    heapq.heappush(agenda, ranks[new] << 32 | left)
            prev = before[left]
            if prev >= 0 and (new := pairs.get(symbols[prev] << 32 | joined)) is not None:
                heapq.heappush(agenda, ranks[new] << 32 | prev)
        out: list[int] = []
        for i, s in enumerate(symbols):
            if s >= 0:
                out.append(s)
            elif s == -1:
                out += [self.byte_ids[b] for b in unit[i].encode("utf-8")]
        return out

    def unions_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ids of the unions of symbols, -1 where a pair has none."""
        wanted = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, wanted), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[at] == wanted) & (left >= 0) & (right >= 0), self.pair_ids[at], -1)

    def merged(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``merge`` of many short units at a time, all ids in one array, and how many each has.

        Each step joins the best pair of every unit that has one left.  Symbols stay in
        their columns, joined ones are ``GONE``."""
        lens = np.array([len(u) for u in units])
        wide = int(lens.max()) + 2
        chars = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32)
        symbols = np.full((len(units), wide), GONE, np.int64)
        symbols[np.arange(wide) < lens[:, None]] = self.char_ids[chars]
        unknown = (symbols == -1).any(axis=1)
        unions = np.full(symbols.shape, -1, np.int64)
        unions[:, :-1] = self.unions_of(symbols[:, :-1].ravel(), symbols[:, 1:].ravel()).reshape(len(units), wide - 1)
        ranks = self.rank_of[unions]
        after = np.minimum(np.arange(1, wide + 1), wide - 1) + np.zeros((len(units), 1), np.int64)
        before = np.arange(-1, wide - 1) + np.zeros((len(units), 1), np.int64)  # -1: the last column, always GONE
        rows = np.arange(len(units))
        while len(rows):
            at = ranks[rows].argmin(axis=1)  # the leftmost of equals
            going = ranks[rows, at] != self.never
            rows, at = rows[going], at[going]
            right = after[rows, at]
            joined = symbols[rows, at] = unions[rows, at]
            symbols[rows, right] = GONE
            ranks[rows, right] = self.never
            follows, leads = after[rows, right], before[rows, at]
            after[rows, at], before[rows, follows] = follows, at
            for where, a, b in ((at, joined, symbols[rows, follows]), (leads, symbols[rows, leads], joined)):
                u = unions[rows, where] = self.unions_of(a, b)
                ranks[rows, where] = self.rank_of[u]
        there = symbols >= 0
        flat, sizes = symbols[there].astype(np.int32), there.sum(axis=1)
        if unknown.any():  # their bytes take the plain way
            out = np.split(flat, np.cumsum(sizes)[:-1])
            for k in np.flatnonzero(unknown).tolist():
                out[k] = np.array(self.merge_short(units[k]), np.int32)
            flat, sizes = np.concatenate(out), np.array([len(x) for x in out])
        return flat, sizes

    def merge_many(self, units: list[str]) -> list[tuple[int, ...]]:
        """``merged`` as one tuple for each unit."""
        flat, sizes = self.merged(units)
        ends = np.cumsum(sizes).tolist()
        flat = flat.tolist()
        return [tuple(flat[i:j]) for i, j in zip([0, *ends], ends)]

    def learn(self, units: list[str], check: bool) -> None:
        """Puts ``units``, ordered by length, into the memo."""
        short = next((k for k, u in enumerate(units) if len(u) > SHORT), len(units))
        found = [self.merged(units[k : min(k + TOGETHER, short)]) for k in range(0, short, TOGETHER)]
        for unit in units[short:]:
            ids = np.array(self.merge(unit), np.int32)
            found.append((ids, np.array([len(ids)])))
        if not found:
            return
        flat, sizes = (np.concatenate(x) for x in zip(*found, strict=True))
        if check:
            self.verify_units(units, flat.tolist(), [0, *np.cumsum(sizes).tolist()])
        self.rows.update(zip(units, range(len(self.sizes), len(self.sizes) + len(units))))
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(sizes) - sizes])
        self.flat, self.sizes = np.concatenate([self.flat, flat]), np.concatenate([self.sizes, sizes])

    def encode_array(self, texts: pa.Array, check: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """``encode`` of each text: all ids in one array, and where each text begins, and the last ends.

        Units are told apart by Arrow; those that are not known are merged together and, with
        ``check``, compared with the library.  No piece goes over the border of two units, so
        the ids of a text are those of its units."""
        mark, nothing = pa.scalar(SPACE, pa.large_string()), pa.scalar("", pa.large_string())
        texts = pc.coalesce(texts.cast(pa.large_string()), nothing)
        marked = pc.binary_join_element_wise(mark, pc.replace_substring(texts, " ", SPACE), nothing)
        units = parted(pc.if_else(pc.equal(pc.binary_length(texts), 0), nothing, marked))
        coded = units.values.dictionary_encode()
        distinct = strings(coded.dictionary)
        fresh = [u for u in distinct if u not in self.rows]
        if len(self.rows) + len(fresh) > self.MEMO or len(self.flat) > 16 * self.MEMO:
            self.forget()
            fresh = [u for u in distinct if u]
        fresh.sort(key=len)  # alike lengths together, so that rows are not wide
        self.learn([u for u in fresh if u[0] == SPACE], check)
        self.learn([u for u in fresh if u[0] != SPACE], check)
        row = np.fromiter(map(self.rows.__getitem__, distinct), np.int64, len(distinct))
        ends = np.asarray(units.offsets).astype(np.int64)
        at = np.insert(row[np.asarray(coded.indices)], ends[:-1], 0)
        sizes = self.sizes[at]
        upto = np.concatenate([[0], np.cumsum(sizes)])
        return gathered(self.flat, self.starts[at], sizes), upto[ends + np.arange(len(ends))]

    def decode_array(self, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        """``decode`` of what ``encode_array`` gives."""
        ids = ids.copy()
        ids[ends[:-1] + 1] += len(self.parts)  # the first after the begin id
        parts = self.part_array.take(pa.array(ids))
        at = np.frombuffer(parts.buffers()[1], np.int64, len(ids) + 1)[ends]
        whole = pa.LargeStringArray.from_buffers(len(ends) - 1, pa.py_buffer(at.tobytes()), parts.buffers()[2])
        return pc.replace_substring(whole, SPACE, " ")

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        """``encode`` of each text; units that are not known are merged together."""
        ids, ends = self.encode_array(pa.array(texts, pa.large_string()))
        ids, ends = ids.tolist(), ends.tolist()
        return [ids[i:j] for i, j in zip(ends, ends[1:])]

    def unit_ids(self, unit: str) -> tuple[int, ...]:
        if len(unit) > 32:
            return tuple(self.merge(unit))
        if len(self.memo) >= self.MEMO:
            self.memo.clear()
        ids = self.memo[unit] = tuple(self.merge_short(unit))
        return ids

    def encode(self, text: str) -> list[int]:
        """Ids with begin and end; the text is marked and not normalised otherwise."""
        out, known = [self.bos], self.memo.get
        if text:
            for unit in UNIT.findall(SPACE + text.replace(" ", SPACE)):
                out += known(unit) or self.unit_ids(unit)
        out.append(self.eos)
        return out

    def decode(self, ids: list[int]) -> str:
        """Joins pieces and bytes; marks become spaces, that of a first piece goes."""
        data = b"".join(map(self.parts.__getitem__, ids))
        first = next((i for i in ids if i not in self.control), None)
        if first is not None and first not in self.bytes and data.startswith(MARK):
            data = data[len(MARK) :]
        return data.decode("utf-8", "one_mark_per_byte").replace(SPACE, " ")

    def verify_units(self, units: list[str], ids: list[int], ends: list[int]) -> None:
        """Raises where the library gives other ids for one of ``units`` than ``ids`` between its ``ends``.

        Units that begin with a mark are put into texts of many, as each begins anew there.
        Others come after a character that no piece joins them with, and so have a text each."""
        texts, wanted = [], []
        alone = [k for k, u in enumerate(units) if u[0] != SPACE or not u.strip(SPACE)]
        for i, j in zip([-1, *alone], [*alone, len(units)]):
            for k in range(i + 1, j, 64):
                last = min(k + 64, j)
                texts.append("".join(units[k:last])[1:])  # the library puts the first mark
                wanted.append(ids[ends[k] : ends[last]])
        if alone:
            words = pc.match_substring_regex(pa.array([units[k] for k in alone], pa.large_string()), f"^[{WORD}]").to_pylist()
            before = {c: self.merge_short(SPACE + c) for c in "a\n"}
            for k, word in zip(alone, words):
                if units[k][0] == SPACE:
                    texts.append(units[k][1:])
                    wanted.append(ids[ends[k] : ends[k + 1]])
                else:
                    c = "\n" if word else "a"
                    texts.append(c + units[k])
                    wanted.append(before[c] + ids[ends[k] : ends[k + 1]])
        for text, own, theirs in zip(texts, wanted, self.library.encode(texts, num_threads=1), strict=True):
            if own != theirs:
                raise AssertionError(f"ids differ from the library's for units of {len(text)} characters: {text[:80]!r}")

    def verify_decoded(self, ids: list[list[int]], decoded: list[str]) -> None:
        """Raises where the library decodes another text for one of ``ids``."""
        for own, theirs in zip(decoded, self.library.decode(ids, num_threads=1), strict=True):
            if own != theirs:
                raise AssertionError(f"the library decodes another text of {len(theirs)} characters: {theirs[:80]!r}")

    def verify(self, texts: list[str], ids: list[list[int]], decoded: list[str] | None = None) -> None:
        """Raises where the library gives other ids for one of ``texts``, or another
        text for one of ``ids`` than ``decoded`` has."""
        for text, own, theirs in zip(texts, ids, self.library.encode(texts, add_bos=True, add_eos=True, num_threads=1), strict=True):
            if own != theirs:
                raise AssertionError(f"ids differ from the library's for a text of {len(text)} characters: {text[:80]!r}")
        if decoded is not None:
            self.verify_decoded(ids, decoded)


def encode_texts(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text", check: bool = True) -> DataFrame:
    """``doc_id, ids array<int>, decoded`` for every row of ``docs``.

    With ``check`` every unit that occurs is compared with the sentencepiece library when it
    is merged, the ids of the first text of every slice are compared whole, and the ids of every text
    are decoded by the library; a difference fails the task.  Defined cases: null is
    encoded as the empty text (begin and end ids only); very long texts without
    spaces are one unit, merged in n log n; null ids and repeated rows are carried
    along; an empty table gives an empty result; further columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_for(model_file)
        for batch in batches:
            upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            start = 0
            while start < batch.num_rows:  # bounds what is held of long texts
                before = upto[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(upto, before + SLICE, "right")))
                part = batch.slice(start, stop - start)
                start = stop
                ids, ends = codec.encode_array(part.column(1), check)
                decoded = codec.decode_array(ids, ends)
                if check:
                    lists = [ids[i:j].tolist() for i, j in zip(ends, ends[1:], strict=False)]
                    codec.verify([part.column(1)[0].as_py() or ""], lists[:1])
                    codec.verify_decoded(lists, decoded.to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids)),
                        decoded.cast(pa.string()),
                    ],
                    ["doc_id", "ids", "decoded"],
                )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, ids array<int>, decoded string"
    )


def piece_digests(docs: DataFrame, model_file: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: what ``encode_texts`` gives, as digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = np.asarray(batch.column(1).values).astype("<u4")
            ends = np.asarray(batch.column(1).offsets)
            ids = [flat[i:j] for i, j in zip(ends, ends[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in ids]),
                    batch.column(2),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded"],
            )

    digests = encode_texts(docs, model_file).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded string")
    return digests.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
