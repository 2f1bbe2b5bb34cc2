"""The automaton against the tokenizers library, and prefix counts against encoding every prefix."""

import random

import numpy as np
import public_tokenizers
import pytest
import tokenizers

from stratum.llm.bpe import Codec, labels, read_spec
from stratum.llm.token_counts import PrefixCounter, counts_of

FILES = ("word_bpe_49k.json", "byte_bpe_50k.json")
PIECES = ["the inof ", "aabbcc", "  \n\t x.'s", "é漢字😀 ab", "aaaa", "<|endoftext|>", "0123 ,.!!", "ÀÉß ǅŒ’“", "'ll've're don", "\x1c\x85\xa0​", "İı", "áë", "<|startoftext|> x"]


@pytest.fixture(scope="module", params=FILES)
def pair(request):
    path = public_tokenizers.path(request.param)
    spec = read_spec(path)
    return Codec(spec), tokenizers.Tokenizer.from_file(path), labels(spec)


def ids_of(codec, text):
    return np.frombuffer(codec.packed_ids(text), "<u4").tolist()


def random_texts(n, seed):
    r = random.Random(seed)
    for _ in range(n):
        chars = r.choice(PIECES)
        yield "".join(r.choice(chars) for _ in range(r.randrange(25))) + (r.choice(PIECES) if r.random() < 0.3 else "")


def test_ids_equal_the_library(pair):
    codec, library, names = pair
    for t in ["", " ", "\n", *random_texts(3000, 5)]:
        want = library.encode(t, add_special_tokens=False).ids
        assert ids_of(codec, t) == want, t
        assert names.decode(want) == library.decode(want, skip_special_tokens=False)


def test_every_plain_character(pair):
    codec, library, _ = pair
    for c in map(chr, [*range(0x250), *range(0x2000, 0x2070)]):
        for t in (c, f"a{c}b", f" {c}{c} x", f"1{c}."):
            assert ids_of(codec, t) == library.encode(t, add_special_tokens=False).ids, repr(t)


def test_a_very_long_word_and_a_full_memo(pair):
    codec, library, _ = pair
    r = random.Random(3)
    long = "".join(r.choice("abcdeé") for _ in range(60_000))
    assert ids_of(codec, long) == library.encode(long, add_special_tokens=False).ids
    codec.packed.most = 10
    text = " ".join(f"w{i} the" for i in range(200))
    assert ids_of(codec, text) == library.encode(text, add_special_tokens=False).ids


def test_accepts_exactly_the_encodings_of_two_tokens(pair):
    """An arc leads from one token to another exactly if the library keeps the two apart."""
    codec, library, _ = pair
    a = codec.automaton
    r = random.Random(7)
    spelled = {t: s for s, t in a.ids.items() if s.isascii() and s.isalpha()}
    some = r.sample(sorted(spelled), 400)
    for x, y in zip(some, reversed(some)):
        word = spelled[x] + spelled[y]
        if x != y:
            assert (a.path(word) == [x, y]) == (a.arc(x, y) and a.path(spelled[x]) == [x] and a.path(spelled[y]) == [y])


def test_prefix_counts_equal_encoding_each_prefix():
    path = public_tokenizers.path(FILES[1])
    counter, library = PrefixCounter(Codec(read_spec(path))), tokenizers.Tokenizer.from_file(path)
    texts = ["", "   ", "a   b", "a \n\n b", "it'll  've", "'re<|endoftext|>x<|endoftext|><|endoftext|>", "<|endoftext|>", "x <|endoftext|> y", "漢字  \t é", *random_texts(250, 11)]
    for t in texts:
        deltas, width, n = counter.text(t)
        want = [len(library.encode(t[:i], add_special_tokens=False).ids) for i in range(len(t) + 1)]
        assert counts_of(deltas, width).tolist() == want, repr(t)
        assert n == want[-1]


def test_prefix_counts_need_more_than_a_byte():
    path = public_tokenizers.path(FILES[1])
    counter, library = PrefixCounter(Codec(read_spec(path))), tokenizers.Tokenizer.from_file(path)
    t = " " * 300 + "x " * 3
    deltas, width, n = counter.text(t)
    assert n == len(library.encode(t).ids)
    assert counts_of(deltas, width)[150] == len(library.encode(t[:150]).ids)


def test_chunks_do_not_crowd_words_out(pair, monkeypatch):
    """Words of many different chunks are spelled once, also when the memory of chunks is far too small."""
    codec = Codec(pair[0].spec)
    path, spelled = codec.automaton.path, []
    monkeypatch.setattr(codec.automaton, "path", lambda symbols: spelled.append(symbols) or path(symbols))
    codec.packed.most = 4
    text = " ".join(f"{w}{p}" for p in ".,;:!?" for w in ("lorem", "ípsum", "dolor", "sit", "amet", "elit", "sed", "magna"))
    first = ids_of(codec, text)
    assert ids_of(codec, text) == first == pair[1].encode(text, add_special_tokens=False).ids
    assert len(spelled) == len(set(spelled))
