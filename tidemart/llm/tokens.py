"""Token ids of whole texts by a public tokenizer, with the ids of words kept.

The tokenizer drops white space and treats every stretch between ASCII white space by
itself, so a text's ids are its words' ids in a row. Arrow numbers the different words of a
batch and takes them apart: Latin letters in lower case are a core, ASCII marks behind
them a run of their own, anything else goes to the library whole. Cores and runs seen
before come from a flat table, bounded in bytes and emptied when its task ends.

New cores are merged by a second library that ranks tokens by their bytes, several times
faster on single words. It gives the same ids because each token of the vocabulary is made by
exactly one rule, which is checked when an encoder is built; a test holds both side by side.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

from tokenizers import Tokenizer  # noqa: E402

#: Bytes the table of known words may take, and about how many an entry takes beside its text.
TABLE_BYTES = 96 << 20
ENTRY_BYTES = 150
WORDS_A_CALL = 1000
#: ASCII letters and those of U+00C0 to U+00FF, then ASCII marks but the apostrophe, which begins contractions.
_PLAIN = r"^(?P<core>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<end>[!-&(-/:-@\[-`{-~]*)$"


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    """Where a vocabulary file of the public tokenizers lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def slices(values: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The slices of an array that begin at ``first``, in a row."""
    end = np.cumsum(length)
    total = int(end[-1]) if len(end) else 0
    return values[np.repeat(first - (end - length), length) + np.arange(total)]


def byte_characters() -> dict[str, int]:
    """Byte-level vocabularies write printable Latin-1 as itself and the other bytes from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


class LetterRuns:
    """Ids of lower-case words. A space behind a word stands for the end of a word in the tokens' bytes."""

    def __init__(self, path: str):
        model = json.loads(Path(path).read_text())["model"]
        vocabulary, characters = model["vocab"], byte_characters()
        singles = [*characters, *(c + "</w>" for c in characters)]  # a letter takes its word's end before any rule
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        ranks: dict[bytes, int] = {}
        for token in [*singles, *(a + b for a, b in pairs)]:
            body = token.removesuffix("</w>")
            raw = bytes(characters[c] for c in body) + (b"" if body == token else b" ")
            if raw in ranks:
                raise ValueError("two rules make one token")
            ranks[raw] = len(ranks)
        self.numbers = np.array([vocabulary.get(t, 0) for t in [*singles, *(a + b for a, b in pairs)]], np.uint32)
        self.coding = tiktoken.Encoding("letters", pat_str="[^ ]+ ", mergeable_ranks=ranks, special_tokens={})

    def encode(self, words: list[bytes]) -> np.ndarray:
        """The ids of all words in a row."""
        texts = [b" ".join([*words[at:at + WORDS_A_CALL], b""]).decode() for at in range(0, len(words), WORDS_A_CALL)]
        return self.numbers[np.concatenate([self.coding.encode_to_numpy(t, disallowed_special=()) for t in texts])]


class Encoder:
    """Encodes texts with one tokenizer; the library's objects live as long as the Python worker."""

    def __init__(self, path: str, table_bytes: int = TABLE_BYTES):
        self.library = Tokenizer.from_file(path)
        self.size = self.library.get_vocab_size()
        self.letters = LetterRuns(path)
        self.ends_word = np.zeros(self.size, bool)
        for token, number in self.library.get_vocab().items():
            self.ends_word[number] = token.endswith("</w>")
        self.table_bytes = table_bytes
        self.forget()

    def forget(self) -> None:
        """Empty the table of known words."""
        self.known: dict[bytes, int] = {}
        self.ids, self.used = np.empty(1 << 12, np.uint32), 0
        self.first, self.length = np.empty(1 << 12, np.int64), np.empty(1 << 12, np.int64)
        self.held = 0

    def _put(self, words: list[bytes], ids: np.ndarray, length: np.ndarray) -> None:
        """Add words to the table with their ids, which lie in a row."""
        n, size = len(self.known), len(words)
        if n + size > len(self.first):
            room = max(n + size, 2 * len(self.first))
            self.first, self.length = np.resize(self.first, room), np.resize(self.length, room)
        if self.used + len(ids) > len(self.ids):
            self.ids = np.resize(self.ids, max(self.used + len(ids), 2 * len(self.ids)))
        self.ids[self.used:self.used + len(ids)] = ids
        self.first[n:n + size] = self.used + np.cumsum(length) - length
        self.length[n:n + size] = length
        self.known.update(zip(words, range(n, n + size), strict=True))
        self.used += len(ids)
        self.held += sum(map(len, words)) + ENTRY_BYTES * size + 4 * len(ids)

    def _learn_letters(self, words: list[bytes]) -> None:
        """Ask for words of lower-case Latin letters, many to a text: the last token of each, and no other, ends a word."""
        ids = self.letters.encode(words)
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        self._put(words, ids, np.diff(ends, prepend=0))

    def _learn_other(self, words: list[bytes]) -> None:
        texts = [w.decode("utf-8", "replace") for w in words]
        found = [c.ids for c in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        length = np.fromiter(map(len, found), np.int64, len(found))
        self._put(words, np.fromiter((i for ids in found for i in ids), np.uint32, int(length.sum())), length)

    def _places(self, words: pa.Array, letters: bool) -> np.ndarray:
        """Where in the table each word is; unknown ones are asked of the library."""
        numbered = words.dictionary_encode()
        different = numbered.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        place = np.fromiter(map(self.known.get, different, repeat(-1)), np.int64, len(different))
        new = np.flatnonzero(place < 0)
        if len(new):
            begun = len(self.known)
            (self._learn_letters if letters else self._learn_other)([different[k] for k in new.tolist()])
            place[new] = np.arange(begun, begun + len(new))
        return place[numbered.indices.to_numpy()]

    def encode_flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, border before each text and behind the last); a null counts as empty."""
        if self.held > self.table_bytes:
            self.forget()
        parts = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        numbered = parts.flatten().dictionary_encode()
        surfaces = numbered.dictionary
        split = pc.extract_regex(surfaces, _PLAIN)
        plain = split.is_valid().to_numpy(zero_copy_only=False)
        where, rest = np.flatnonzero(plain), np.flatnonzero(~plain)
        split = split.take(pa.array(where))
        # Per word the table's place of its core, or of the whole, and of the marks behind it.
        unit = np.empty((len(surfaces), 2), np.int64)
        unit[where, 0] = self._places(pc.utf8_lower(pc.struct_field(split, "core")), True)
        unit[rest, 0] = self._places(surfaces.take(pa.array(rest)), False)
        unit[where, 1] = self._places(pc.struct_field(split, "end"), False)
        unit[rest, 1] = self._places(pa.array([""]), False)[0]
        lengths = self.length[unit]
        ids = slices(self.ids, self.first[unit].ravel(), lengths.ravel())
        n = lengths.sum(axis=1)
        word = numbered.indices.to_numpy()
        length = n[word]
        flat = slices(ids, (np.cumsum(n) - n)[word], length)
        borders = np.concatenate([[0], np.cumsum(length)])[parts.offsets.to_numpy() - parts.offsets[0].as_py()]
        return flat, borders

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Per text its ids; a null counts as empty."""
        flat, borders = self.encode_flat(texts)
        return [flat[a:b] for a, b in zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True)]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file."""
    return Encoder(path)


def encoded(batches: Iterator[pa.RecordBatch], path: str, column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Each batch with the ids of its texts; known words are forgotten at the end of the task."""
    encode = encoder(path)
    try:
        for batch in batches:
            yield batch, encode.encode(batch.column(batch.schema.names.index(column)))
    finally:
        encode.forget()
