"""Token ids of whole texts by the tokenizers library, with each distinct chunk of text encoded once.

A chunk is a piece of text that no token can leave: for vocabularies whose words are split at white space,
the runs between white space; for byte-level vocabularies whose words carry the space before them, a space
and what follows it up to the next one. Texts in which that isn't sure (runs of white space, special tokens)
go through the library whole. The cache of chunks is bounded.
"""

from __future__ import annotations

import json
import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from hirewire.llm.common import held

#: Chunks and words in one generation of a Python worker's caches.
CACHE_SIZE = 250_000
#: Bytes of text that ``encode_all`` splits at a time, about.
SLICE_BYTES = 8 << 20
#: Characters of new chunks that are split into words at a time, about.
TOGETHER = 1 << 19
#: Longer chunks aren't kept.
LONG = 64
#: Below this code point the character classes and case rules of all Unicode versions agree.
STABLE = "ɐ"
UNSTABLE = re.compile("[^\x00-\u024f]|İ")
MARK = re.compile(r"(?<=[a-z])([.,])(?=\s)")
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"  # all that ASCII has besides letters, digits, white space and controls
CONTROL_SPACES = "\x1c\x1d\x1e\x1f"  # white space to str.split, but not to the tokenizers' patterns


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return [chr(b if b in set(plain) else 0x100 + sorted(set(range(256)) - set(plain)).index(b)) for b in range(256)]


class Cache(dict):
    """A bounded dict that computes what it lacks. When it is full it becomes the older generation, from which
    what is asked for again comes back, and the generation before is dropped."""

    def __init__(self, compute):
        super().__init__()
        self.compute, self.older = compute, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
            if len(key) > LONG:
                return value
        if len(self) >= CACHE_SIZE:
            self._turn()
        self[key] = value
        return value

    def _turn(self) -> None:
        self.older = dict(self)
        self.clear()

    def keep(self, values: dict) -> None:
        """All at once, so that a generation may pass its size by as many."""
        if values and len(self) >= CACHE_SIZE:
            self._turn()
        self.update(values)

    def found(self, keys: list) -> list:
        """What is known of each key, and None for the others; what the older generation has comes back."""
        values = list(map(self.get, keys))
        back = {}
        for i, value in enumerate(values):
            if value is None and (value := self.older.get(keys[i])) is not None:
                values[i] = back[keys[i]] = value
        self.keep(back)
        return values


class Splitting:
    """How a tokenizer file splits text, read from the file itself."""

    def __init__(self, path: str):
        import regex

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.spec = json.load(open(path, encoding="utf-8"))
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t["content"] for t in self.spec.get("added_tokens", [])]
        self.alphabet = byte_alphabet()
        pre, norm = self.spec.get("pre_tokenizer") or {}, self.spec.get("normalizer")
        self.kind, self.pattern = "whole", None
        if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and norm is None:
            # Fixed value: the pattern of byte-level vocabularies.
            self.kind, self.pattern = "spaces", regex.compile(
                r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
        elif (pre.get("type") == "Sequence" and [p["type"] for p in pre["pretokenizers"]] == ["Split", "ByteLevel"]
              and pre["pretokenizers"][0].get("behavior") == "Removed" and pre["pretokenizers"][0].get("invert")
              and not pre["pretokenizers"][1].get("use_regex") and norm is not None
              and [n["type"] for n in norm.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]):
            self.kind, self.pattern = "words", regex.compile(pre["pretokenizers"][0]["pattern"]["Regex"])

    def words(self, chunk: str) -> list[str]:
        """The units that merges stay within, in the byte alphabet."""
        if max(chunk, default="") >= STABLE:
            if self.kind == "words":
                chunk = self.tokenizer.normalizer.normalize_str(chunk)
            return [w for w, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(chunk)]
        found = self.pattern.findall(chunk.lower() if self.kind == "words" else chunk)
        return [w if w.isascii() and w.isprintable() and " " not in w
                else "".join(map(self.alphabet.__getitem__, w.encode())) for w in found]

    def chunks(self, text: str) -> list[str] | None:
        """Chunks that encode on their own; None if the text must be taken whole."""
        if self.kind == "whole" or any(s in text for s in self.special) or any(c in text for c in CONTROL_SPACES):
            return None
        if self.kind == "words":
            if text.isascii() or not UNSTABLE.search(text):
                text = MARK.sub(r" \1", text.lower())  # a mark behind a letter is a word of its own: fewer distinct chunks
            return text.split()
        if " \n" in text:
            return None
        first, *rest = text.replace("\n", " \n").split(" ")
        if not first or first[0].isspace() or first[-1].isspace():
            return None
        return [first, *rest]


class LibraryEncoder:
    """``encode(text)``: the ids that the tokenizers library gives (no special tokens added), as little-endian
    unsigned 32-bit integers. Null and empty texts have none."""

    def __init__(self, path: str):
        self.split = Splitting(path)
        self.model = self.split.tokenizer.model
        self.words = self.split.kind == "words"
        self.ends, self.units = None, None
        if self.words and (suffix := self.split.spec["model"].get("end_of_word_suffix")):
            from tokenizers import Tokenizer

            vocab = self.split.spec["model"]["vocab"]
            self.ends = np.zeros(max(vocab.values()) + 1, bool)  # the ids that end a word
            self.ends[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
            self.units = Tokenizer(self.model)  # takes words in the byte alphabet as they are
        del self.split.spec  # the parsed file is large, and the tokenizer has read it for itself
        self.by_word = Cache(self._word)
        self.by_chunk = Cache(self._words_chunk if self.words else self._spaces_chunk)
        self.known = Known()

    def _word(self, word: str) -> bytes:
        return array("I", [t.id for t in self.model.tokenize(word)]).tobytes()

    def _own(self, chunk: str) -> bytes:
        return b"".join(map(self.by_word.__getitem__, self.split.words(chunk)))

    def _words_chunk(self, chunk: str) -> bytes:
        """Most chunks are a word, or one with marks behind it; their parts are chunks as well."""
        if chunk.isascii():
            if chunk.isalpha() and chunk.islower():
                return self._word(chunk)
            word = chunk.rstrip(MARKS)
            if word != chunk and word.isalpha():
                return self.by_chunk[word] + self.by_word[chunk[len(word):]]
        return self._own(chunk)

    def _spaces_chunk(self, chunk: str) -> bytes:
        if chunk.isascii():
            if chunk.isalpha():
                return self._word(self.space + chunk)
            if len(chunk) > 1 and chunk[-1] in ".,!?;:" and chunk[:-1].isalpha():
                return self.by_chunk[chunk[:-1]] + self.by_word[chunk[-1]]
        if chunk[:1] == "\n":
            body = chunk[1:]
            if body and not body[0].isspace() and not body[-1].isspace():
                return self.by_word[self.newline] + self._own(body)
        elif chunk and not chunk[0].isspace() and not chunk[-1].isspace():
            return self._own(f" {chunk}")
        raise NotAlone

    @property
    def space(self) -> str:
        return self.split.alphabet[0x20]

    @property
    def newline(self) -> str:
        return self.split.alphabet[0x0A]

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        chunks = self.split.chunks(text)
        if chunks is not None:
            try:
                if self.words:
                    return b"".join(map(self.by_chunk.__getitem__, chunks))
                return self._own(chunks[0]) + b"".join(map(self.by_chunk.__getitem__, chunks[1:]))
            except NotAlone:
                pass
        return array("I", self.split.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """``encode`` of each text of a column. Some MB of texts are split at a time, each of their distinct chunks is looked up
        once and the ids are dealt out again; in memory are a slice, its longest text and their ids."""
        if self.split.kind == "whole":
            return [self.encode(t) for t in texts.to_pylist()]
        texts = pc.fill_null(texts, "")
        until = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64)
        slices = max(1, round(int(until[-1]) / SLICE_BYTES)) if len(until) else 1
        cuts = [0, *(np.flatnonzero(np.diff(until * slices // (until[-1:] + 1))) + 1).tolist(), len(texts)]
        one = self._encode_slice if self.words else self._encode_spaced
        return [ids for a, b in zip(cuts, cuts[1:]) for ids in one(texts.slice(a, b - a))]

    def _chunk_ids(self, chunks: list[str]) -> list[bytes]:
        """The ids of distinct chunks. Those that are one word of stable lower-case letters and not in the cache are encoded by
        one call: a word's ids reach up to one that ends a word. If that doesn't give one run for each word, all go one by one."""
        known = self.by_chunk.found(chunks)
        lacking = [i for i, ids in enumerate(known) if ids is None]
        words = [c for i in lacking if len(c := chunks[i]) <= LONG and c.isalpha() and c.islower() and max(c) < STABLE]
        if words and self.ends is not None:
            self._learn(words)
        for i in lacking:
            known[i] = self.by_chunk[chunks[i]]
        return known

    def _learn(self, words: list[str]) -> None:
        units = "\n".join(words).encode().decode("latin-1").translate("".join(self.split.alphabet)).split(self.newline)
        ids = np.array(self.units.encode_batch_fast([units], is_pretokenized=True, add_special_tokens=False)[0].ids, np.uint32)
        ends = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
        if len(ends) == len(words):
            data = ids.tobytes()
            self.by_chunk.keep({w: data[a:b] for w, a, b in zip(words, [0, *ends], ends)})

    def _encode_slice(self, texts: pa.Array) -> list[bytes]:
        """The chunks are those of ``Splitting.chunks``, and empty ones at white space at a text's ends, which have no ids."""
        whole = self._taken_whole(texts)
        unstable = pc.match_substring_regex(texts, r"[^\x{0}-\x{24f}]|\x{130}")
        marked = pc.replace_substring_regex(pc.utf8_lower(texts), r"([a-z])([.,])(\s)", r"\1 \2\3")
        chunks = pc.utf8_split_whitespace(pc.if_else(whole, "", pc.if_else(unstable, texts, marked)))
        coded = chunks.flatten().dictionary_encode()
        ids_of = self._chunk_ids(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        sizes = np.fromiter(map(len, ids_of), np.int64, len(ids_of)) // 4
        out = dealt(np.frombuffer(b"".join(ids_of), "<u4"), sizes, coded.indices.to_numpy(), chunks.offsets.to_numpy())
        for i in np.flatnonzero(whole.to_numpy(zero_copy_only=False)).tolist():
            out[i] = self.encode(texts[i].as_py())
        return out

    def _taken_whole(self, texts: pa.Array) -> pa.Array:
        whole = pc.match_substring_regex(texts, r"[\x1c-\x1f]")
        for s in self.split.special:
            whole = pc.or_(whole, pc.match_substring(texts, s))
        return whole

    def _encode_spaced(self, texts: pa.Array) -> list[bytes]:
        """The chunks are those of ``Splitting.chunks``, the first one with a line break before it, whose id goes again. They are
        numbered together with the known ones, so the new ones are those with higher numbers."""
        whole = pc.or_(self._taken_whole(texts), pc.match_substring(texts, " \n"))
        broken = pc.replace_substring(pc.if_else(whole, "", texts), "\n", " \n")
        chunks = pc.split_pattern(pc.binary_join_element_wise("\n", broken, ""), " ")
        words, known = chunks.flatten(), self.known
        coded = pa.concat_arrays([known.chunks.cast(words.type), words]).dictionary_encode()
        chunk, offsets = coded.indices.to_numpy()[len(known.chunks):], chunks.offsets.to_numpy()
        new = coded.dictionary.slice(len(known.chunks))
        known.add(new, self._spaced_ids(new.to_numpy(zero_copy_only=False).tolist()))
        alone = np.append(0, np.cumsum(known.sizes[chunk] == 0))[offsets]
        out = [ids[4:] for ids in dealt(known.ids, known.sizes, chunk, offsets)]
        for i in np.flatnonzero(np.diff(alone)).tolist():  # empty texts and those taken whole are an empty chunk
            out[i] = self.encode(texts[i].as_py())
        known.used(chunk)
        return out

    def _spaced_ids(self, chunks: list[str]) -> list[bytes]:
        """The ids of distinct chunks, none for one that doesn't encode on its own. Short stable ones are split into words
        together."""
        ids, short, size = [b""] * len(chunks), [], 0
        for i, c in enumerate(chunks):
            body = c[1:] if c[:1] == "\n" else c
            if not body or body[0].isspace() or body[-1].isspace():
                continue
            if len(c) > LONG or not c.isascii() and max(c) >= STABLE:
                ids[i] = self._spaces_chunk(c)
                continue
            short.append(i)
            size += len(c)
            if size >= TOGETHER:
                self._split_together(chunks, ids, short)
                short, size = [], 0
        if short:
            self._split_together(chunks, ids, short)
        return ids

    def _split_together(self, chunks: list[str], ids: list[bytes], short: list[int]) -> None:
        """A word that begins with a space or is a line break begins a chunk: chunks have no others, and no white space at their
        ends. ``CONTROL_SPACES`` aren't in any, so one can stand between the words while all go into the byte alphabet."""
        words = self.split.pattern.findall("".join([c if c[0] == "\n" else f" {c}" for c in map(chunks.__getitem__, short)]))
        between = CONTROL_SPACES[0]
        units = between.join(words).encode().decode("latin-1").translate("".join(self.split.alphabet)).split(self.split.alphabet[ord(between)])
        of_words = list(map(self.by_word.__getitem__, units))
        data, ends = b"".join(of_words), np.cumsum(np.fromiter(map(len, of_words), np.int64, len(units)))
        starts = np.append(0, ends)[[*(k for k, w in enumerate(words) if w[0] in " \n"), len(words)]].tolist()
        for i, a, b in zip(short, starts[:-1], starts[1:], strict=True):
            ids[i] = data[a:b]


class Known:
    """Distinct chunks and their ids in flat arrays, each with the number of the last slice that had it. Long ones go after their
    slice; of more than two generations of a cache one stays, the last used."""

    def __init__(self):
        self.chunks, self.sizes, self.ids = pa.array([], pa.string()), np.zeros(0, np.int64), np.zeros(0, np.uint32)
        self.last, self.slice = np.zeros(0, np.int32), 0

    def add(self, chunks: pa.Array, ids: list[bytes]) -> None:
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        self.chunks, self.sizes = pa.concat_arrays([self.chunks.cast(chunks.type), chunks]), np.append(self.sizes, sizes)
        self.ids = np.append(self.ids, np.frombuffer(b"".join(ids), "<u4"))
        self.last = np.append(self.last, np.zeros(len(ids), np.int32))

    def used(self, chunk: np.ndarray) -> None:
        self.slice += 1
        self.last[chunk] = self.slice
        stay = pc.binary_length(self.chunks).to_numpy() <= 4 * LONG
        if stay.all() and len(stay) <= 2 * CACHE_SIZE:
            return
        if len(stay) > 2 * CACHE_SIZE:
            stay[np.argsort(-self.last, kind="stable")[CACHE_SIZE:]] = False
        self.ids = self.ids[np.repeat(stay, self.sizes)]
        self.chunks, self.sizes, self.last = self.chunks.filter(pa.array(stay)), self.sizes[stay], self.last[stay]


def dealt(ids: np.ndarray, sizes: np.ndarray, chunk: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """The ids of each text, whose chunks are ``chunk`` from its offset to the next: numbers of runs of ``ids`` with ``sizes``."""
    n = sizes[chunk]
    ends = np.cumsum(n)
    places = np.repeat(np.cumsum(sizes)[chunk] - ends, n)  # from a chunk's place among the texts' ids to that in ids
    places += np.arange(len(places))
    data = ids.take(places).tobytes()
    bounds = (4 * np.append(0, ends)[offsets]).tolist()
    return [data[a:b] for a, b in zip(bounds, bounds[1:])]


class NotAlone(Exception):
    """A chunk with white space at an end: its tokens depend on what stands beside it."""


def library_encoder(path: str) -> LibraryEncoder:
    """The encoder of a file, which a Python worker holds while its tasks ask for it."""
    return held(f"encoder {path}", lambda: LibraryEncoder(path))


def public_path(name: str) -> str:
    """Where a public tokenizer's file is on this machine; every worker asks for its own."""
    import public_tokenizers

    return public_tokenizers.path(name)
