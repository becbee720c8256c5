"""BPE codec, token records and packing against the tokenizers library and brute force."""
import bisect
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hirewire.llm import bpe, packing, token_records
from hirewire.llm.common import joined, shared_path
from hirewire.llm.tokens import LibraryEncoder, public_path

WORD, BYTE = public_path("word_bpe_49k.json"), public_path("byte_bpe_50k.json")
HARD = ["", " ", "a  b", "\n\nfoo \n bar", "a<|endoftext|>b", "x'll DON'T 'S", "ſK ΣΑΣ İstanbul é ́x", "aaaaaaaaaaaaaaaaaaa", "日本語 12345 ½ \x1c z\x1fq",
        "ab cd e", "\ttab\t\tx", "a ", " a", "\na", "a\n", "the​x", "x" * 5000, "!!!'s???", "a \n b", "a\r\nb", "wor.ds, mid,dle. end."]


def hard_texts(n=1500):
    draw = random.Random(3)
    return HARD + ["".join(draw.choice("ab c'.,!\n\tdé1 ２Σ śA") for _ in range(draw.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_encoders_agree_with_the_library(path):
    codec, library, whole = bpe.BpeCodec(path), LibraryEncoder(path), Tokenizer.from_file(path)
    for text in hard_texts():
        ids = whole.encode(text, add_special_tokens=False).ids
        assert codec.encode(text) == ids, text
        assert np.frombuffer(library.encode(text), "<u4").tolist() == ids, text
        assert codec.decode(ids) == whole.decode(ids, skip_special_tokens=False), text


def test_cache_that_overflows_changes_nothing(monkeypatch):
    from hirewire.llm import tokens
    monkeypatch.setattr(tokens, "CACHE_SIZE", 7)
    library, whole = LibraryEncoder(WORD), Tokenizer.from_file(WORD)
    for text in hard_texts(300):
        assert np.frombuffer(library.encode(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("path", [WORD, BYTE])
@pytest.mark.parametrize("cache, slice_bytes", [(250_000, 8 << 20), (7, 100)])
def test_a_column_of_texts_encodes_as_the_library_does(path, cache, slice_bytes, monkeypatch):
    from hirewire.llm import tokens
    monkeypatch.setattr(tokens, "CACHE_SIZE", cache)
    monkeypatch.setattr(tokens, "SLICE_BYTES", slice_bytes)
    texts = [None, *hard_texts(300), *(f"Ab{chr(c)}cD, {chr(c)} x{chr(c)}. it's.. e{chr(c)}***" for c in range(0x300)), "mar-ked?! don't!?", "long" * 900, None]
    whole = Tokenizer.from_file(path)
    got = LibraryEncoder(path).encode_all(pa.array([*texts, "not this one"]).slice(0, len(texts)))
    for text, ids in zip(texts, got, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text or "", add_special_tokens=False).ids, text
    assert LibraryEncoder(path).encode_all(pa.array([], pa.string())) == []


def test_a_column_looks_each_distinct_chunk_up_once(monkeypatch):
    """op8's time was one look-up, and often one call of the library, for each word of the texts."""
    library, asked, encoded = LibraryEncoder(WORD), [], []
    look_up, word = library.by_chunk.found, library._word
    monkeypatch.setattr(library.by_chunk, "found", lambda keys: asked.extend(keys) or look_up(keys))
    library.by_word.compute = lambda w: encoded.append(w) or word(w)
    one = "Some words, of a text. and marks***"
    got = library.encode_all(pa.array([one] * 1000))
    assert sorted(asked) == sorted(["some", "words", ",", "of", "a", "text", ".", "and", "marks***"]) and sorted(encoded) == ["***", ",", "."]
    assert got == [LibraryEncoder(WORD).encode(one)] * 1000


def test_a_column_of_spaced_texts_asks_for_each_new_chunk_once(monkeypatch):
    """op10's time was one look-up, and often a pattern and a call of the library, for each word of the texts."""
    library, asked = LibraryEncoder(BYTE), []
    new_chunks = library._spaced_ids
    monkeypatch.setattr(library, "_spaced_ids", lambda chunks: asked.extend(chunks) or new_chunks(chunks))
    one = "Some words, of a text.\nand it's words, \xe9t\xe9* " + "x" * 300 + " end"
    got = library.encode_all(pa.array([one] * 1000))
    assert sorted(asked) == sorted(["\nSome", "words,", "of", "a", "text.", "\nand", "it's", "\xe9t\xe9*", "x" * 300, "end"])
    assert got == [LibraryEncoder(BYTE).encode(one)] * 1000
    del asked[:]
    assert library.encode_all(pa.array([f"{one} new"])) == [LibraryEncoder(BYTE).encode(f"{one} new")] and asked == ["x" * 300, "new"]


def test_known_chunks_are_bounded(monkeypatch):
    from hirewire.llm import tokens
    monkeypatch.setattr(tokens, "CACHE_SIZE", 50)
    library, whole = LibraryEncoder(BYTE), Tokenizer.from_file(BYTE)
    for i in range(12):
        texts = [f"always here w{i}x{k}" for k in range(20)] + ["", None, " led", "a  b", "<|endoftext|> x", "trails ", "two \nlines"]
        got = library.encode_all(pa.array(texts))
        assert [np.frombuffer(x, "<u4").tolist() for x in got] == [whole.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert len(library.known.chunks) == len(library.known.sizes) == len(library.known.last) <= 100
        assert len(library.known.ids) == library.known.sizes.sum() and "here" in library.known.chunks.to_pylist()


def test_small_batches_are_joined_without_loss():
    batches = [pa.RecordBatch.from_pydict({"x": [i, i], "t": pa.array(["a" * 50, None])}) for i in range(9)]
    together = list(joined(iter(batches), 300))
    assert pa.Table.from_batches(together).to_pydict() == pa.Table.from_batches(batches).to_pydict()
    assert [b.num_rows for b in together] == [8, 8, 2] and list(joined(iter([]), 300)) == []


def test_round_trip_of_odd_rows(spark, documents, odd_rows):
    df = documents(odd_rows).withColumn("ids_sha256", F.lit("clash"))
    rows = bpe.round_trip_digests(df, WORD).collect()
    whole = Tokenizer.from_file(WORD)

    def expect(text):
        ids = whole.encode(text or "", add_special_tokens=False).ids
        return (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                hashlib.sha256(whole.decode(ids, skip_special_tokens=False).encode()).hexdigest())

    assert sorted((str(r[0]), *tuple(r)[1:]) for r in rows) == sorted((str(i), *expect(t)) for i, t in odd_rows)
    assert bpe.round_trip_digests(documents([]), WORD).count() == 0
    encoded = bpe.encode_documents(df, WORD)
    assert bpe.decode_documents(encoded, WORD).where("doc_id = 8").first()["decoded"] == whole.decode(
        whole.encode(odd_rows[8][1], add_special_tokens=False).ids, skip_special_tokens=False)


def test_crc32c_and_damage():
    assert token_records.crc32c(b"123456789") == 0xE3069283
    assert token_records.crc32c(bytes(32)) == 0x8A9136AA
    long = bytes(range(256)) * 33
    whole = token_records.crc32c(long)
    assert whole != token_records.crc32c(long[:-1]) and whole == token_records.crc32c(bytes(bytearray(long)))
    import io
    good = token_records.frame(b"payload")
    assert list(token_records.unframe(io.BytesIO(good * 2))) == [b"payload"] * 2
    for bad in (good[:-1], good[:3] + b"!" + good[4:], good[:14] + b"!" + good[15:]):
        with pytest.raises(ValueError):
            list(token_records.unframe(io.BytesIO(bad)))


def test_records_round_trip(spark, documents, odd_rows):
    folder = shared_path(spark, "records-test")
    manifest = token_records.write_records(documents(odd_rows), folder, WORD, 2)
    rows = token_records.read_records(manifest, folder).collect()
    whole = Tokenizer.from_file(WORD)
    order = sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start, expect = 0, []
    for i, t in order:
        ids = whole.encode(t or "", add_special_tokens=False).ids + [2]
        expect.append((i, start, len(ids), np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert sorted(map(tuple, rows), key=lambda r: r[1]) == [(i, s, n, b) for i, s, n, b in expect]
    one = manifest.orderBy("part").first()
    doc, ids = token_records.read_record(folder, one["file"], 0, one["id_bytes"])
    assert doc is None and ids.astype("<u4").tobytes() == expect[0][3]
    empty = shared_path(spark, "records-test")
    assert token_records.read_records(token_records.write_records(documents([]), empty, WORD, 2), empty).count() == 0


def best_fit_decreasing(lengths, size):
    gaps = []
    for n in sorted(lengths, reverse=True):
        i = bisect.bisect_left(gaps, n)
        bisect.insort(gaps, gaps.pop(i) - n if i < len(gaps) else size - n)
    return len(gaps)


def test_plan_is_best_fit_decreasing():
    draw = random.Random(0)
    for _ in range(150):
        size = draw.choice([16, 64, 1024])
        lengths = [max(1, int(size * draw.random() ** draw.choice([1, 3]))) for _ in range(draw.randint(0, 300))]
        plan = packing.best_fit_plan(Counter(lengths), size)
        sequences, ranks = defaultdict(list), defaultdict(list)
        for length, rank, n, first, offset in plan:
            ranks[length].append((rank, n))
            for k in range(n):
                sequences[first + k].append((offset, length))
        for parts in sequences.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= size
        for length, n in Counter(lengths).items():
            at = 0
            for rank, many in sorted(ranks[length]):
                assert rank == at
                at += many
            assert at == n
        assert len(sequences) == best_fit_decreasing(lengths, size)


def test_packing_of_odd_rows(spark, documents, odd_rows):
    size = 64
    df = documents(odd_rows).withColumn("offset", F.lit("clash"))
    packed = packing.pack_documents(df, BYTE, 2, size, keep_ids=True)
    rows = packed.collect()
    whole = Tokenizer.from_file(BYTE)
    texts = Counter((i, len(whole.encode(t or "", add_special_tokens=False).ids) + 1) for i, t in odd_rows)
    assert sum(r["length"] for r in rows) == sum(n * k for (_, n), k in texts.items())
    for r in rows:
        assert 1 <= r["length"] <= size and r["ids_crc32"] == zlib.crc32(r["ids"]) and len(r["ids"]) == 4 * r["length"]
    long = sorted((r["piece"], r["start"], r["length"]) for r in rows if r["doc_id"] == 7)
    assert [n for _, _, n in long[1:]] == [size] * (len(long) - 1) and [p for p, _, _ in long] == list(range(len(long)))
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"], r["ids"]))
    for parts in by.values():
        at = 0
        for offset, length, _ in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    joined = {r["sequence_id"]: bytes(r["ids"]) for r in packing.assemble(packed).collect()}
    assert joined == {k: b"".join(bytes(x) for _, _, x in sorted(v)) for k, v in by.items()}
    assert packing.pack_documents(documents([]), BYTE, 2, size).count() == 0


def test_cut_lengths():
    assert packing.cut_lengths(5, 4) == [(0, 1), (1, 4)] and packing.cut_lengths(8, 4) == [(0, 4), (4, 4)]
    assert packing.cut_lengths(4, 4) == [(0, 4)] and packing.cut_lengths(0, 4) == []
