"""Byte-pair encoding by a deterministic automaton over tokens.

``Automaton`` compiles a tokenizer's merge list by successive merge gadgets.  The automaton
starts with one state that loops on every base symbol.  The gadget of merge number ``k``,
``(a, b) -> ab``:

* splits the state reached by ``a``: the copy has no ``b`` arc, and every ``a`` arc now leads to it;
* adds an ``ab`` arc wherever an ``a`` arc leaves, leading to the state reached by ``b``.

A copied state differs from its parent by the one arc that it lacks, so it is stored as that
difference: ``gate[(a, b)] = k``.  State ``class(ab)`` starts as the then state of ``b``, so the
differences in force after a token are those of its right spine (the token, its right half, and so
on), each as far as it was made before the spine's next larger token.  An arc made by a later merge
exists where its left half's arc does, so a token is looked up along its left spine.  ``arc`` is
that table lookup; its answers are kept.  49,000 merges give 49,000 states in a few megabytes, where
an explicit table would need states x tokens entries.

The language is the set of token sequences that BPE produces, every string has exactly one path,
and so has every prefix of it.  ``path`` therefore needs one token per position: the only one whose
arc leaves the state reached where it starts.
"""

from __future__ import annotations

import functools
import gc
import json
import re
import struct
import unicodedata
import weakref
from array import array

import regex

#: Body of the character class of texts that this module splits itself: Latin letters, common marks and punctuation.
PLAIN = "\x00-\x1b\x20-\u012f\u0131-\u017f\u2010-\u2027\u2030-\u203f"
CLASS_BELOW = 0x2100
#: Words and chunks of words that one worker remembers (each twice, see Memo), and arcs; what is forgotten is computed again.
MEMO_WORDS = 200_000
MEMO_CHUNKS = 400_000
MEMO_ARCS = 1_000_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, spare = [""] * 256, 256
    for b in range(256):
        if b in shown:
            out[b] = chr(b)
        else:
            out[b], spare = chr(spare), spare + 1
    return out


class Automaton:
    """The automaton of one merge list; tokens are vocabulary ids.

    A vocabulary with an end-of-word suffix has a second set of base symbols for a word's last
    byte; they are spelled here as one character each (``END`` above the plain symbol)."""

    END = 0x1000

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str = ""):
        self.suffix = suffix
        base = byte_symbols()
        self.ids = {self.spelled(s): vocab[s] for c in base for s in (c, c + suffix) if s in vocab}
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.made: dict[int, int] = {}  # token -> number of the merge that makes it
        self.gate: dict[int, int] = {}  # (a, b) -> number of the gadget that removes arc b after a
        for k, (x, y) in enumerate(merges):
            a, b, ab = vocab[x], vocab[y], vocab[x + y]
            if ab in self.made:
                raise ValueError(f"two merges make {x + y!r}")
            self.ids[self.spelled(x + y)] = ab
            self.left[ab], self.right[ab], self.made[ab] = a, b, k
            self.gate[a << 20 | b] = k
        self.known: dict[int, bool] = {}
        self.lefts: dict[int, tuple] = {}
        self.rights: dict[int, tuple] = {}
        self.shorter = {t: self._shorter(s) for s, t in self.ids.items()}
        self.trie: list = [-1, {}]  # a node: its token or -1, its children by symbol
        self.length = {t: len(s) for s, t in self.ids.items()}
        self.longest = max(self.length.values(), default=0)
        for s, t in self.ids.items():
            node = self.trie
            for c in s:
                node = node[1].setdefault(c, [-1, {}])
            node[0] = t

    def spelled(self, symbols: str) -> str:
        """A vocabulary string with its suffix turned into the END form of its last symbol."""
        n = len(self.suffix)
        if n and len(symbols) > n and symbols.endswith(self.suffix):
            return symbols[: -n - 1] + chr(ord(symbols[-n - 1]) + self.END)
        return symbols

    def _shorter(self, symbols: str) -> int:
        """The longest token that is a proper prefix, or -1."""
        return next((t for i in range(len(symbols) - 1, 0, -1) if (t := self.ids.get(symbols[:i])) is not None), -1)

    def spine(self, token: int, half: dict[int, int], kept: dict[int, tuple]) -> tuple:
        """(token, number of the merge that hides it) from a token down one side."""
        got = kept.get(token)
        if got is None:
            out, t, hidden = [], token, 1 << 60
            while True:
                out.append((t, hidden))
                if t not in half:
                    break
                hidden, t = self.made[t], half[t]
            got = kept[token] = tuple(out)
        return got

    def arc(self, state: int, token: int) -> bool:
        """Whether the state reached by token ``state`` has an arc for ``token``."""
        key = state << 20 | token
        got = self.known.get(key)
        if got is None:
            got, gate, first = True, self.gate.get, self.spine(token, self.left, self.lefts)
            for x, until in self.spine(state, self.right, self.rights):
                x <<= 20
                for y, upto in first:
                    if (k := gate(x | y)) is not None and k < until and k <= upto:
                        got = False
                        break
                if not got:
                    break
            if len(self.known) >= MEMO_ARCS:
                self.known.clear()
            self.known[key] = got
        return got

    def path(self, symbols: str) -> list[int]:
        """The ids of a word: the one path that spells it.

        Takes the longest arc at each position; where none leads on, the position is closed and the
        arc before it is exchanged for the next shorter one.  Each position closes once at most."""
        if (whole := self.ids.get(symbols)) is not None:  # the longest arc there is
            return [whole]
        n, at, out, closed, state = len(symbols), 0, [], None, -1
        known, shorter, length, starts, longest = self.known, self.shorter, self.length, self.trie[1], self.longest
        while at < n:
            token, below = -1, starts
            for c in symbols[at : at + longest]:  # to the longest token that starts here
                if c not in below:
                    break
                found, below = below[c]
                if found >= 0:
                    token = found
            while True:
                while token >= 0:
                    end = at + length[token]
                    if closed is None or end not in closed:
                        if state < 0:
                            break
                        got = known.get(state << 20 | token)
                        if got or got is None and self.arc(state, token):
                            break
                    token = shorter[token]
                if token >= 0:
                    break
                if not out:
                    raise ValueError(f"no path spells {symbols[:20]!r}")
                closed = closed or set()
                closed.add(at)
                token = out.pop()
                at -= length[token]
                state = out[-1] if out else -1
                token = shorter[token]
            out.append(token)
            state, at = token, end
        return out

    def prefix_counts(self, symbols: str) -> list[int]:
        """Token count of every prefix of a word, the empty one first (vocabularies without a suffix).

        Dynamic programming over positions: the last token of a prefix is the only one whose arc
        leaves the state reached where it starts; the count is one more than there.  Each position
        offers its arcs to the positions they lead to, longer prefixes waiting for theirs."""
        n, known, starts = len(symbols), self.known, self.trie[1]
        last, count = [-1] * (n + 1), [0] * (n + 1)
        for j in range(n):
            state, next_count, below, i = last[j], count[j] + 1, starts, j
            while i < n and below and (node := below.get(symbols[i])) is not None:
                i += 1
                t, below = node
                if t >= 0 and last[i] < 0:
                    if j:
                        got = known.get(state << 20 | t)
                        if got is None:
                            got = self.arc(state, t)
                        if not got:
                            continue
                    last[i], count[i] = t, next_count
        return count


class Memo(dict):
    """word -> value, computed once.  When full, it starts again with what it held kept aside, so words in
    use since then come back without being computed; twice ``most`` entries are held at most.

    A worker process serves the tasks of one operator after another: ``turn_to`` empties the memories
    of all others and lets go of what they compiled (``on_leaving``), so that they don't add up."""

    alive: weakref.WeakSet = weakref.WeakSet()
    leaving: dict[str, list] = {}
    owner_now = ""
    __hash__ = object.__hash__

    def __init__(self, make, most: int = MEMO_WORDS, owner: str = "bpe"):
        super().__init__()
        self.make, self.most, self.before, self.owner = make, most, {}, owner
        Memo.alive.add(self)

    @staticmethod
    def on_leaving(owner: str, drop) -> None:
        """``drop`` is called when the worker turns from ``owner`` to another operator."""
        Memo.leaving.setdefault(owner, []).append(drop)

    @staticmethod
    def turn_to(owner: str) -> None:
        if Memo.owner_now == owner:
            return
        Memo.owner_now = owner
        for other, drops in Memo.leaving.items():
            if other != owner:
                for drop in drops:
                    drop()
        for memo in list(Memo.alive):
            if memo.owner != owner:
                memo.clear()
                memo.before = {}
        gc.collect()

    def __missing__(self, word):
        value = self.before.get(word)
        if value is None:
            value = self.make(word)
        if len(self) >= self.most:
            self.before = dict(self)
            self.clear()
        self[word] = value
        return value


def _class(wanted) -> str:
    """A character class body of the characters below CLASS_BELOW that fulfil a condition."""
    return "".join(re.escape(c) for c in map(chr, range(CLASS_BELOW)) if wanted(c))


class Codec:
    """One tokenizer file: splitting into words, and each word's ids by the automaton.

    Texts of common characters (PLAIN) are split by this module, at white space first; texts with
    any other character are split by the library's own normaliser and pre-tokenizer."""

    def __init__(self, spec: str):
        data = json.loads(spec)
        model = data["model"]
        if model["type"] != "BPE" or model.get("byte_fallback") or model.get("ignore_merges") or model.get("continuing_subword_prefix"):
            raise ValueError("only plain byte-level BPE models are compiled")
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.automaton = Automaton(model["vocab"], merges, self.suffix)
        self.specials = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.special_split = re.compile("(" + "|".join(map(re.escape, sorted(self.specials, key=len, reverse=True))) + ")")
        self.hints = tuple({s[:2] for s in self.specials})
        self.spec = spec
        letter = _class(lambda c: unicodedata.category(c)[0] == "L")
        number = _class(lambda c: unicodedata.category(c)[0] == "N")
        space = _class(lambda c: regex.match(r"\p{White_Space}", c))
        tails = "'s|'t|'re|'ve|'m|'ll|'d"
        if self.suffix:  # lower case, white space dropped
            self.words = re.compile(f"{tails}|[{letter}]+|[{number}]|[^{space}{letter}{number}]+").findall
        else:  # byte level, a leading space belongs to its word
            self.words = re.compile(f"{tails}| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+").findall
        self.odd = re.compile(f"[^{PLAIN}]").search
        self.other_space = re.compile("[\t\v\f\r\x85\xa0]|  | \n|\n[ \n]|^[ \n]|[ \n]\\Z").search
        self.symbols = str.maketrans({chr(b): s for b, s in enumerate(byte_symbols())})
        self.packed = Memo(self._pack, MEMO_CHUNKS)
        self.word = Memo(self._word)

    @functools.cached_property
    def library(self):
        """The library's tokenizer, made when the first uncommon text comes."""
        from tokenizers import Tokenizer

        return Tokenizer.from_str(self.spec)

    def spell(self, word: str) -> str:
        """A word's bytes as byte symbols, the last one in its END form where the vocabulary has a suffix."""
        plain = word.isascii() and word.isalnum()  # these stand for themselves
        out = word if plain else word.encode("utf-8").decode("latin-1").translate(self.symbols)
        return out[:-1] + chr(ord(out[-1]) + Automaton.END) if self.suffix and out else out

    def _word(self, word: str) -> bytes:
        """The ids of one word."""
        return array("I", self.automaton.path(self.spell(word))).tobytes()

    def _pack(self, chunk: str) -> bytes:
        """The ids of one word, or of a chunk of words that stand between white space.

        Words have a memory of their own, so that chunks, of which there are more, don't crowd them out."""
        if not chunk.isalpha():
            words = [chunk] if self.odd(chunk) else self.words(chunk)
            if len(words) > 1:
                return b"".join(map(self.word.__getitem__, words))
        return self.word[chunk]

    def split(self, text: str) -> list[str]:
        """A text without special strings, as the words that are encoded on their own."""
        if not self.odd(text):
            return self.words(text.lower() if self.suffix else text)
        if self.library.normalizer is not None:
            text = self.library.normalizer.normalize_str(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def chunks(self, text: str) -> list[str]:
        """Like ``split``, but words that no white space separates stay together where that is cheaper.

        Byte level: a chunk is a space and what follows it, a line's first chunk has no space and
        line ends stand alone; texts with any other white space go word by word."""
        if self.odd(text):
            return self.split(text)
        if self.suffix:
            return text.lower().split()
        if self.other_space(text):
            return self.words(text)
        if "\n" not in text:
            return text.replace(" ", "\n ").split("\n")
        return text.replace("\n", "\v\n\v").replace(" ", "\v ").split("\v")

    def parts(self, text: str) -> list[str | int]:
        """A text cut at special strings: texts and special ids."""
        if any(h in text for h in self.hints):
            return [self.specials.get(x, x) for x in self.special_split.split(text) if x]
        return [text] if text else []

    def packed_ids(self, text: str) -> bytes:
        """All ids of a text, little-endian unsigned 32-bit."""
        out = []
        for part in self.parts(text):
            if isinstance(part, int):
                out.append(struct.pack("<I", part))
            else:
                out.extend(map(self.packed.__getitem__, self.chunks(part)))
        return b"".join(out)


class Labels:
    """What ids decode to; needs no automaton."""

    def __init__(self, spec: str):
        data = json.loads(spec)
        self.names = {i: s for s, i in data["model"]["vocab"].items()} | {t["id"]: t["content"] for t in data["added_tokens"]}
        self.decoder = None
        if data["decoder"] is not None:
            from tokenizers import Tokenizer

            self.decoder = Tokenizer.from_str(spec).decoder

    def decode(self, ids: list[int] | None) -> str:
        """The text that the library's ``decode(ids, skip_special_tokens=False)`` gives.

        The arc labels, one after another: joined by a space if the file names no decoder, else
        turned back from byte symbols (ids of no token are passed over, as there)."""
        labels = [x for x in map(self.names.get, ids or ()) if x is not None]
        return " ".join(labels) if self.decoder is None else self.decoder.decode(labels)


@functools.lru_cache(maxsize=4)
def labels(spec: str) -> Labels:
    """The labels of a worker; read once per process."""
    return Labels(spec)


@functools.lru_cache(maxsize=4)
def codec(spec: str) -> Codec:
    """The compiled tokenizer of a worker; compiled once per process."""
    return Codec(spec)


Memo.on_leaving("bpe", codec.cache_clear)
Memo.on_leaving("bpe", labels.cache_clear)


def working_codec(spec: str) -> Codec:
    """``codec`` for a task that encodes now."""
    Memo.turn_to("bpe")
    return codec(spec)


def read_spec(path: str) -> str:
    """A tokenizer file's content, read on the driver; a vocabulary's size bounds what is broadcast."""
    with open(path, encoding="utf-8") as f:
        return f.read()
