import hashlib
import random

import public_tokenizers
import pytest
from cases import clashing, collected, documents, rows
from tokenizers import Tokenizer

from daytally.llm import bpe

COLUMNS = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@pytest.fixture(scope="module")
def small():
    """A vocabulary that takes short text for long."""
    import json

    with open(PATH, encoding="utf-8") as file:
        return bpe.Bpe(json.load(file), part=40, leaf=8)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(library, pairs):
    out = []
    for i, text in pairs:
        ids = library.encode(text or "", add_special_tokens=False).ids
        out.append((i, len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids, skip_special_tokens=False))))
    return sorted(out, key=repr)


def test_equals_the_library(spark, library):
    pairs = [r[:2] for r in rows()] + [(99, "a<|endoftext|> b <|endoftext|>"), (98, "it's we'll  'S"), (97, "1 22 333\r\n\t x")]
    assert collected(bpe.encode(documents(spark, pairs), with_ids=False), *COLUMNS) == expected(library, pairs)
    assert collected(bpe.encode(clashing(spark)), *COLUMNS) == expected(library, [r[:2] for r in rows()])
    assert bpe.encode(documents(spark, [])).count() == 0


def test_round_trip(spark):
    docs = documents(spark).filter("doc_id is not null")
    back = bpe.decode(bpe.encode(docs).dropDuplicates(["doc_id"]))
    known = {r[0]: r[1] or "" for r in rows()}
    assert {r.doc_id: r.text for r in back.collect()} == {k: v for k, v in known.items() if k is not None}


def test_joined_trees_equal_the_whole(small, library):
    draw = random.Random(5)
    for letters in ("ab", "abcdefghijklmnopqrstuvwxyz", "eta", "thaneri"):
        for n in (9, 17, 100, 1000, 5000):
            text = "".join(draw.choice(letters) for _ in range(n))
            assert list(small.tree(text.encode())) == library.encode(text, add_special_tokens=False).ids


def test_long_texts_are_cut_where_it_is_safe(small, library):
    draw = random.Random(6)
    pieces = ["word", " ", "  ", "\n", "\t", "'s", "'", "thisisalongrunofletters", "é", "ß", "123", "!!", "漢", "\x1c", "\x85", "!\x1d", "\u3000", "A" * 30, "  ", "🙂", "'lleee" + "x" * 12, "<|endoftext|>", "7" * 25, "é" * 20, "字" * 9, " " * 15, "\n" * 11]
    for _ in range(400):
        text = "".join(draw.choice(pieces) for _ in range(draw.randint(1, 60)))
        assert small.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, text


KINDS = {
    "ascii letters": "abcdefgh", "one letter": "a", "accents": "aéñü", "other script": "漢字日本語", "digits": "0123456789",
    "white space": " \n\t", "marks": "!?-_=", "emoji": "🙂🚀", "combining": "e\u0301",
}


@pytest.mark.parametrize("kind", KINDS)
def test_long_pieces_of_every_kind_are_joined_from_halves(library, kind):
    draw = random.Random(8)
    long = "".join(draw.choice(KINDS[kind]) for _ in range(20_000))
    if kind == "combining":
        long = "e" * 10_000 + "\u0301" * 10_000
    whole = bpe.load(PATH)
    lengths, tree = [], whole.tree
    try:
        whole.tree = lambda piece: lengths.append(len(piece)) or tree(piece)
        for text in (long, f"before {long} after", f"it's{long}<|endoftext|>{long} x  ", f"é{long}\n\n{long}"):
            lengths.clear()
            assert whole.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids
            assert max(lengths) > bpe.LEAF
    finally:
        del whole.tree


def test_pieces_are_those_of_the_library(small, library):
    """Every character of the first two planes next to letters, digits, marks and space, with a vocabulary that takes all text for long."""
    for low in range(0, 0x20000, 1 << 14):
        text = "".join(f"x{chr(c)}\x01{chr(c)}1{chr(c)}  {chr(c)}" for c in range(low, low + (1 << 14)) if not 0xD800 <= c < 0xE000)
        assert small.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, hex(low)


def test_a_window_grows_until_both_sides_agree(small):
    text = b"ab" * 3000
    whole = small.encoding._core_bpe.encode_single_piece(text)
    for cut in (1, 7, 2999, 3000, 5999):
        left, right = (small.encoding._core_bpe.encode_single_piece(x) for x in (text[:cut], text[cut:]))
        assert small.join(left, right) == whole
