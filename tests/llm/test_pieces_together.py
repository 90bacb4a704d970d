"""Units that are not known are merged together, to the library's ids."""

import random

import pyarrow as pa
import pytest

from aerolith.llm import pieces, queries


def test_units_merged_together_are_the_librarys():
    codec = pieces.Codec(queries.PIECES)
    rng = random.Random(1)
    texts = ["".join(rng.choices("ab é▁ \n\t漢字😀Ωßa²_1the", k=rng.randrange(60))) for _ in range(3000)] + ["", "a", "͸" * 40, "😀", "w" * 33]
    ids = codec.encode_all(texts)
    codec.verify(texts, ids)
    assert ids == [codec.encode(t) for t in texts]
    codec.MEMO = 100
    assert codec.encode_all(texts[:300]) == ids[:300]
    assert [list(x) for x in codec.merge_many(["aa", "the", "bab" * 10])] == [codec.merge(u) for u in ("aa", "the", "bab" * 10)]


def test_each_distinct_unit_costs_the_library_once(monkeypatch):
    """Texts of the same words are encoded, and compared with the library, by their distinct units."""
    codec = pieces.Codec(queries.PIECES)
    asked, whole = [], codec.library

    class Library:
        def encode(self, texts, **options):
            asked.extend(texts)
            return whole.encode(texts, **options)

    monkeypatch.setattr(codec, "library", Library())
    texts = ["some words, and some\nmore words"] * 500 + ["", None, "  ", "\n", "▁a▁▁", "a²b½ x\x00y", "é" * 50, "²²", "漢字😀 😀"]
    ids, ends = codec.encode_array(pa.array(texts), True)
    assert sum(map(len, asked)) < 400
    lists = [ids[i:j].tolist() for i, j in zip(ends, ends[1:])]
    assert lists == [codec.encode(t or "") for t in texts]
    codec.library = whole
    codec.verify([t or "" for t in texts], lists, codec.decode_array(ids, ends).to_pylist())
    assert codec.decode_array(*codec.encode_array(pa.array([], pa.string()))).to_pylist() == []


def test_a_wrong_unit_is_found():
    for wrong in ("▁some", "\n", "Ha", "▁▁"):
        codec = pieces.Codec(queries.PIECES)
        merged = codec.merged

        def bad(units, merged=merged, wrong=wrong):
            flat, sizes = merged(units)
            if wrong in units:
                flat[sizes[: units.index(wrong)].sum()] += 1
            return flat, sizes

        codec.merged = bad
        with pytest.raises(AssertionError, match="differ from the library's"):
            codec.encode_array(pa.array(["I have some\nHa  "]), True)
