"""Token counts by a compiled finite-state transducer.

The tokenizer is compiled into a deterministic transducer over characters: its states
know how far a stretch (letters, marks, a contraction) has come and what of it can still
matter to the merges, and each transition carries the tokens it settles. The merge
rules enter through one fact: a sequence of tokens is the encoding of its bytes exactly if
each neighbouring pair is the encoding of its own. So for each ending of the stretch
that a longer token could begin with, a state holds the token before it and the count up to
there; equal holdings are one state. States and transitions are built when first met.

Texts are cut into chunks, and each chunk's state map is evaluated where it is needed. After
white space the transducer is in its start state, whatever came before, so a map is constant behind
the first white space: all those parts run side by side, and so do chunks without white space,
from the start state as a first entry. Then every head runs from the state its predecessor
ended in, until it meets the path that the chunk took before: from there on both entries have the same image.
A chunk whose last state changes hands its successor a new entry, in a round of its own. Paths
meet within a few tokens as a rule, so a few rounds compose all maps; only a text on which they never
met would need a round for each chunk.

Transitions of the first ``DENSE`` characters are rows of a table, those of rarer ones entries of a
bounded map. When states pass ``MAX_STATES``, also within a text, all but those in use are dropped.

Character classes, lower case and special strings are asked of the library once for
each character, so the counts are the library's.

Defined cases: a null or empty text has no bytes and no tokens; repeated documents each
get their row; an empty table gives no rows; columns named as the added ones are replaced.
"""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.llm.common import append_columns, field, raw_texts
from tidemart.llm.tokens import vocabulary_path

LIMIT = 2048
CHUNK = 512
#: Characters worked on at a time; a longer text is cut at white space.
SEGMENT = 1 << 21
#: States after which those not in use are dropped; counts do not depend on it.
MAX_STATES = 250_000
#: Characters whose transitions lie in the table, and the most transitions kept of others.
DENSE = 256
MAX_RARE = 1_000_000

SPACE, LETTER, NUMBER, MARK, APOSTROPHE, SPECIAL = range(6)
START = 0
_SPECIAL_CHAR = "\ud800"  # no text holds a surrogate
_CONTRACTIONS = {"s": "", "t": "", "m": "", "d": "", "r": "e", "v": "e", "l": "l"}


def _byte_characters() -> dict[str, int]:
    """Byte-level vocabularies write printable Latin-1 as itself and the other bytes from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


class Merges:
    """The merge rules: which pairs of tokens stay apart, and the tokens by their bytes."""

    def __init__(self, path: str):
        model = json.load(open(path, encoding="utf-8"))["model"]
        suffix, to_byte = model["end_of_word_suffix"], _byte_characters()
        self.plain: dict[bytes, int] = {}
        self.final: dict[bytes, int] = {}
        self.spelled: dict[int, tuple[bytes, bool]] = {}
        for token, number in model["vocab"].items():
            ends = token.endswith(suffix)
            body = token[: -len(suffix)] if ends else token
            if all(c in to_byte for c in body) and body:
                raw = bytes(to_byte[c] for c in body)
                (self.final if ends else self.plain)[raw] = number
                self.spelled[number] = raw, ends
        vocab = model["vocab"]
        self.rank = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.rank[vocab[left], vocab[right]] = rank, vocab[left + right]
        self.beginnings = {raw[:k] for raw in [*self.plain, *self.final] for k in range(1, len(raw))}
        self._apart: dict[tuple[int | None, int], bool] = {}

    def encode(self, raw: bytes, ends: bool) -> list[int]:
        out = [self.plain[raw[i:i + 1]] for i in range(len(raw) - 1)]
        out.append((self.final if ends else self.plain)[raw[-1:]])
        while len(out) > 1:
            best = min(((*self.rank[p], i) for i, p in enumerate(zip(out, out[1:])) if p in self.rank),
                       key=lambda x: (x[0], x[2]), default=None)
            if best is None:
                break
            out[best[2]:best[2] + 2] = [best[1]]
        return out

    def apart(self, left: int | None, right: int) -> bool:
        """Whether ``right`` follows ``left`` (or begins a stretch) in an encoding."""
        known = self._apart.get((left, right))
        if known is None:
            raw, ends = self.spelled[right]
            if left is None:
                known = self.encode(raw, ends) == [right]
            else:
                known = self.encode(self.spelled[left][0] + raw, ends) == [left, right]
            self._apart[left, right] = known
        return known


#: A stretch so far, but for its last byte: the ending that can still matter, and per length
#: of an ending (token before it, tokens up to there).
Open = tuple[bytes, tuple[tuple[int, int | None, int], ...]]
EMPTY: Open = b"", ((0, None, 0),)


class Transducer:
    """Transitions on characters, with the tokens they settle; built on demand."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.specials = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.merges = Merges(path)
        self.symbol_of = np.full(0x110000, -1, np.int32)
        self.symbols: list[tuple[int, str]] = []
        self.longer: dict[str, str] = {}
        self._reset()

    def _reset(self) -> None:
        self.states: list[tuple] = [("start",)]
        self.numbers = {("start",): START}
        self.limit = MAX_STATES
        # A following state is held plus one, zero is not built yet; rows take memory once they are used.
        self.next = np.zeros((MAX_STATES + MAX_STATES // 4 + 1, self._width()), np.int32)
        self.out = np.zeros(self.next.shape, np.int16)
        # State and symbol to the following state and its tokens, both in one number.
        self.rare: dict[int, int] = {}

    def _width(self) -> int:
        return min(DENSE, max(64, -(-len(self.symbols) // 16) * 16))

    def _shrink(self, used: list[np.ndarray], paths: np.ndarray | None) -> None:
        """Drop all states but those in use and renumber the arrays; a path forgets the dropped ones."""
        old = self.states
        live = np.unique(np.concatenate([[START], *[a[a >= 0] for a in used]]))
        self._reset()
        self.states = [old[k] for k in live]
        self.numbers = {state: k for k, state in enumerate(self.states)}
        self.limit = max(MAX_STATES, 2 * len(live))
        self._fit(self.limit)
        number = np.full(len(old) + 1, -1, np.int64)  # the last one stands for -1
        number[live] = np.arange(len(live))
        for a in [*used, *([] if paths is None else [paths])]:
            a[:] = number[a]

    def _fit(self, rows: int) -> None:
        """Room for some states, and for all characters that have a column."""
        shape = max(len(self.next), rows + rows // 4 + 1 if rows >= len(self.next) else 0), self._width()
        if shape == self.next.shape:
            return
        held, wide = min(len(self.states), len(self.next)), self.next.shape[1]
        for name in ("next", "out"):
            narrow = getattr(self, name)
            table = np.zeros(shape, narrow.dtype)
            table[:held, :wide] = narrow[:held]
            setattr(self, name, table)

    # Characters

    def _learn(self, text: str) -> str:
        """Give new characters their symbols; the text with characters replaced whose lower case is longer."""
        for c in sorted(set(text)):
            if self.symbol_of[ord(c)] >= 0 or c in self.longer:
                continue
            plain = c if c == _SPECIAL_CHAR else self.library.normalizer.normalize_str(c)
            if len(plain) > 1:
                self.longer[c] = plain
                self._learn(plain)
            elif plain == c:
                self._add(c)
            else:
                self._learn(plain)
                self.symbol_of[ord(c)] = self.symbol_of[ord(plain)] if plain else self.symbol_of[ord(" ")]
        for c, plain in self.longer.items():
            if c in text:
                text = text.replace(c, plain)
        return text

    def _add(self, c: str) -> None:
        self.symbol_of[ord(c)] = len(self.symbols)
        self.symbols.append((self._kind(c), c))
        self._fit(0)

    def _kind(self, c: str) -> int:
        if c == _SPECIAL_CHAR:
            return SPECIAL
        if c == "'":
            return APOSTROPHE
        split = self.library.pre_tokenizer.pre_tokenize_str
        beside = split("a" + c)
        if len(beside) == 1:
            return LETTER if beside[0][1][1] == 2 else SPACE
        return NUMBER if len(split(c + c)) == 2 else MARK

    # Stretches

    def _step(self, held: Open, byte: bytes) -> Open:
        tail, endings = held
        last = None
        following = []
        for k, token, n in reversed(endings):
            ending = tail[len(tail) - k:] + byte
            if last is None:
                found = self.merges.plain.get(ending)
                if found is not None and self.merges.apart(token, found):
                    last = (0, found, n + 1)
            if ending in self.merges.beginnings:
                following.append((k + 1, token, n))
        longest = following[0][0] if following else 0
        return (tail + byte)[len(tail) + 1 - longest:], tuple(sorted([*following, last]))

    def _count(self, held: Open, byte: bytes) -> int:
        """Tokens of the stretch if this byte is its last."""
        tail, endings = held
        for k, token, n in reversed(endings):
            found = self.merges.final.get(tail[len(tail) - k:] + byte)
            if found is not None and self.merges.apart(token, found):
                return n + 1
        raise ValueError("a stretch that the vocabulary cannot spell")

    def _grown(self, held: Open, last: bytes, c: str) -> tuple[Open, bytes, int]:
        """The stretch with one more character; tokens that are settled move from the state to the transition."""
        raw = last + c.encode()
        for k in range(len(raw) - 1):
            held = self._step(held, raw[k:k + 1])
        settled = held[1][-1][2]
        return (held[0], tuple((k, t, n - settled) for k, t, n in held[1])), raw[-1:], settled

    def _whole(self, stretch: str) -> int:
        held, last, settled = EMPTY, b"", 0
        for c in stretch:
            held, last, n = self._grown(held, last, c)
            settled += n
        return settled + self._count(held, last)

    # Transitions

    def _begin(self, kind: int, c: str) -> tuple[tuple, int]:
        if kind == SPACE:
            return ("start",), 0
        if kind == SPECIAL:
            return ("start",), 1
        if kind == NUMBER:
            return ("start",), self._whole(c)
        if kind == APOSTROPHE:
            return ("apostrophe", ""), 0
        held, last, settled = self._grown(EMPTY, b"", c)
        return ("letters" if kind == LETTER else "marks", held, last), settled

    def _then(self, state: tuple, settled: int, kind: int, c: str) -> tuple[tuple, int]:
        following, n = self._move(state, kind, c)
        return following, settled + n

    def _move(self, state: tuple, kind: int, c: str) -> tuple[tuple, int]:
        if state[0] == "start":
            return self._begin(kind, c)
        if state[0] == "apostrophe":
            begun = state[1]
            if not begun and kind in (MARK, APOSTROPHE):
                held, last, first = self._grown(EMPTY, b"", "'")
                held, last, second = self._grown(held, last, c)
                return ("marks", held, last), first + second
            if not begun and c in _CONTRACTIONS:
                return (("start",), self._whole("'" + c)) if not _CONTRACTIONS[c] else (("apostrophe", c), 0)
            if begun and c == _CONTRACTIONS[begun]:
                return ("start",), self._whole("'" + begun + c)
            if not begun:
                return self._then(("start",), self._whole("'"), kind, c)
            letters, n = self._begin(LETTER, begun)
            return self._then(letters, n + self._whole("'"), kind, c)
        name, held, last = state
        if kind == LETTER and name == "letters" or kind in (MARK, APOSTROPHE) and name == "marks":
            held, last, settled = self._grown(held, last, c)
            return (name, held, last), settled
        return self._then(("start",), self._count(held, last), kind, c)

    def _compile(self, state: int, symbol: int) -> None:
        following, n = self._move(self.states[state], *self.symbols[symbol])
        number = self.numbers.get(following)
        if number is None:
            number = self.numbers[following] = len(self.states)
            self.states.append(following)
            self._fit(number)
        if symbol < self.next.shape[1]:
            self.next[state, symbol], self.out[state, symbol] = number + 1, n
            return
        if len(self.rare) >= MAX_RARE:
            self.rare.clear()
        self.rare[state << 21 | symbol] = (number + 1) << 16 | n

    def _follow(self, now: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The following states and settled tokens; transitions that are missing are built."""
        wide = self.next.shape[1]
        if int(symbol.max()) < wide:
            following = self.next[now, symbol]
            missing = np.flatnonzero(following == 0)
            if len(missing):
                for k in missing:
                    if not self.next[now[k], symbol[k]]:
                        self._compile(int(now[k]), int(symbol[k]))
                following = self.next[now, symbol]
            return following - 1, self.out[now, symbol]
        following, settled = np.empty(len(now), np.int32), np.empty(len(now), np.int16)
        common = symbol < wide
        if common.any():
            following[common], settled[common] = self._follow(now[common], symbol[common])
        packed = []
        for state, c in zip(now[~common].tolist(), symbol[~common].tolist(), strict=True):
            found = self.rare.get(state << 21 | c)
            if found is None:
                self._compile(state, c)
                found = self.rare[state << 21 | c]
            packed.append(found)
        rare = np.array(packed, np.int64)
        following[~common], settled[~common] = (rare >> 16) - 1, rare & 0xFFFF
        return following, settled

    # Running

    def _run(
        self, text: np.ndarray, out: np.ndarray, first: np.ndarray, end: np.ndarray, state: np.ndarray,
        leaves: np.ndarray, path: np.ndarray | None = None, before: np.ndarray | None = None,
    ) -> np.ndarray:
        """Run many parts side by side; ``out`` gets the tokens settled at each character. Final states.

        ``path`` holds the states of earlier runs. A part that meets it ends there and has the
        final state of ``before``, where one is named; the states of the others are put into it.
        ``leaves`` are states to keep beside the running ones.
        """
        order = np.argsort(first - end, kind="stable")  # the longest first
        at, now, final = first[order], state[order], state.copy()
        length = (end - first)[order]
        j = 0
        while True:
            alive = int(np.searchsorted(-length, -j, side="left"))
            if alive < len(now):
                final[order[alive:]] = now[alive:]
                order, at, now, length = order[:alive], at[:alive], now[:alive], length[:alive]
            if not alive:
                return final
            if len(self.states) > self.limit:
                self._shrink([now, final, leaves, *([] if before is None else [before])], path)
            here = at + j
            now, out[here] = self._follow(now, text[here])
            j += 1
            if path is None:
                continue
            if before is not None:
                met = (path[here] == now) & (before[order] >= 0)
                if met.any():
                    final[order[met]] = before[order[met]]
                    order, at, now, length, here = order[~met], at[~met], now[~met], length[~met], here[~met]
            path[here] = now

    def emitted(self, text: np.ndarray) -> np.ndarray:
        """Tokens settled at each symbol; the text starts in the start state and should end with white space."""
        out = np.zeros(len(text), np.int16)
        if not len(text):
            return out
        first = np.arange(0, len(text), CHUNK)
        end = np.minimum(first + CHUNK, len(text))
        spaces = np.flatnonzero(text == self.symbol_of[32])
        at = np.searchsorted(spaces, first)
        sync = np.append(spaces, len(text))[at] + 1  # behind the first white space from the chunk's start on
        constant = sync <= end
        sync = np.minimum(sync, end)
        constant[0], sync[0] = True, 0
        path = None if constant.all() else np.full(len(text), -1, np.int64)
        leaves = np.full(len(first), -1, np.int64)
        begun = np.where(constant, sync, first)
        leaves[:] = self._run(text, out, begun, end, np.full(len(first), START), leaves, path)
        # Heads from the states before them; a chunk that ends in another state than before is an entry to follow.
        todo = np.flatnonzero(sync > first)
        while len(todo):
            whole = ~constant[todo]
            before = np.where(whole, leaves[todo], -1)
            ended = self._run(text, out, first[todo], sync[todo], leaves[todo - 1], leaves, path, before)
            behind = todo[whole & (ended != leaves[todo])] + 1
            leaves[todo[whole]] = ended[whole]
            behind = behind[behind < len(first)]
            todo = behind[sync[behind] > first[behind]]
        return out

    def counts(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text."""
        self._learn(" ")
        total = np.zeros(len(texts), np.int64)
        parts: list[str] = []
        owners: list[int] = []
        held = 0
        for k, text in enumerate(texts):
            for special in self.specials:
                if "<" in text:
                    text = text.replace(special, _SPECIAL_CHAR)
            if not text.isascii() and not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
            for part in _segments(text):
                parts.append(part)
                owners.append(k)
                held += len(part)
                if held >= SEGMENT:
                    self._count_parts(parts, owners, total)
                    parts, owners, held = [], [], 0
        self._count_parts(parts, owners, total)
        return total

    def _count_parts(self, parts: list[str], owners: list[int], total: np.ndarray) -> None:
        if not parts:
            return
        joined = self._learn_all(parts)
        codes = np.frombuffer("".join(joined).encode("utf-32-le", "surrogatepass"), "<u4")
        out = self.emitted(self.symbol_of[codes])
        starts = np.concatenate([[0], np.cumsum([len(p) for p in joined])[:-1]])
        np.add.at(total, owners, np.add.reduceat(out, starts, dtype=np.int64))

    def _learn_all(self, parts: list[str]) -> list[str]:
        """The parts, each closed by a space, in characters that have symbols."""
        whole = " ".join(parts)
        if self._learn(whole) is whole:
            return [p + " " for p in parts]
        return [self._learn(p) + " " for p in parts]


def _segments(text: str) -> list[str]:
    """A text cut at spaces into parts of about ``SEGMENT`` characters; tokens never cross white space."""
    if len(text) <= SEGMENT:
        return [text]
    out, at = [], 0
    while at < len(text):
        cut = text.find(" ", at + SEGMENT)
        cut = len(text) if cut < 0 else cut
        out.append(text[at:cut])
        at = cut + 1
    return out


@lru_cache(maxsize=2)
def transducer(path: str) -> Transducer:
    """The worker's transducer; what one task compiles the next ones find."""
    return Transducer(path)


def count_tokens(docs: DataFrame, vocabulary: str | None = None, limit: int = LIMIT, text_col: str = "text") -> DataFrame:
    """Add n_bytes, n_tokens and over_limit."""
    path = vocabulary or vocabulary_path()

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        texts = [t or b"" for t in raw_texts(batch, text_col)]
        tokens = transducer(path).counts([t.decode("utf-8", "replace") for t in texts])
        return [pa.array([len(t) for t in texts], pa.int64()), pa.array(tokens, pa.int64())]

    counted = append_columns(docs.drop("over_limit"), [field("n_bytes", T.LongType()), field("n_tokens", T.LongType())], lambda: compute)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
