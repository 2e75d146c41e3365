"""Token ids, token files and packing against the tokenizers library and brute force."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import regex

from feedwell.llm.chunks import BYTE_PATTERN, SEGMENT, ByteTokens, WordTokens, load_tokenizer
from feedwell.llm.packing import candidates, pack_sequences, plan_cuts, utilisation
from feedwell.llm.shared import Scratch
from feedwell.llm.token_file import pack, unpack, write_tokens

WORD, BYTE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
ODD = [
    "", " ", "a  b", "  a", "a ", "a  ", "foo\n bar", "foo\n  bar\n\n x", "\xa0 b", "it's  'll don't 'SSS",
    "a <|endoftext|> b<|startoftext|>", "éx J̌ x ́", "a\x1cb \x1c c", "\x01 a\x02b \x00", "ΑΣ Σ Σα İI ß ẞ",
    "tab\t x\t\ty", "x " * 10, "“a.” b", "\n\n", " \n ", "Юникод 漢字かな 한글 🙂🙂", "1234567 9/8", "࢏ ꟏", "!!!...***###",
]


@pytest.fixture(scope="module")
def readers():
    words, parts = WordTokens(WORD), ByteTokens(BYTE)
    return [(words.tokenizer, lambda t: words.many([t])[0]), (load_tokenizer(BYTE), parts.ids)]


def test_ids_equal_the_library_on_odd_texts(readers):
    for tokenizer, ids in readers:
        for text in ODD:
            assert ids(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_ids_equal_the_library_on_every_kind_of_character(readers):
    rng = random.Random(3)
    points = [*range(1, 0x600), *range(0x600, 0xD800, 41), *range(0xE000, 0x11000, 97), *rng.sample(range(0x11000, 0x110000), 500)]
    for tokenizer, ids in readers:
        for point in points:
            c = chr(point)
            text = f"a{c}b {c} {c}c1{c} e{c}\n{c}'s  ok{c}"
            assert ids(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, hex(point)


def test_byte_pattern_gives_nothing_back_and_splits_as_the_plain_one():
    plain = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    assert r"\p{L}++" in BYTE_PATTERN
    # In the engine "$" is the very end.
    ours, rng = BYTE_PATTERN.replace("$", r"\Z"), random.Random(5)
    for text in [*ODD, *("".join(rng.choice(" \n\t\r\xa0 ab'sStvélr漢1²_.!🙂\u0301") for _ in range(rng.randint(0, 14))) for _ in range(3000))]:
        assert regex.findall(ours, text) == regex.findall(plain, text), repr(text)


def test_byte_engine_looks_for_a_special_token_that_texts_hold_as_text():
    parts, library = ByteTokens(BYTE), load_tokenizer(BYTE)
    assert parts.encoding.special_tokens_set == {ByteTokens.UNUSED}
    for text in [ByteTokens.UNUSED, f"a{ByteTokens.UNUSED * 3} b{ByteTokens.UNUSED}", f" {ByteTokens.UNUSED}\n"]:
        ids = parts.ids(text).tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids and parts.encoding.n_vocab - 1 not in ids


def test_very_long_text_is_read_whole(readers):
    words = WordTokens(WORD)
    text = "some words\n" * (SEGMENT // 2)
    assert len(words.many([text])[0]) == len(text.split())


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 1000])
@pytest.mark.parametrize("bits", [1, 8, 9, 16, 17, 24, 25, 32])
def test_values_survive_packing(n, bits):
    values = np.random.default_rng(n + bits).integers(0, 1 << bits, n, dtype=np.uint64).astype(np.uint32)
    control, data = pack(values)
    assert len(control) == -(-n // 4) and (unpack(control, data, n) == values).all()


def expected_tokens(rows):
    tokenizer, start, out = load_tokenizer(WORD), 0, []
    ids = [np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for _, t in rows]
    crc = [zlib.crc32(i.tobytes()) for i in ids]
    order = sorted(range(len(rows)), key=lambda n: (rows[n][0] is not None, rows[n][0] or 0, len(ids[n]), crc[n]))
    for n in order:
        out.append((rows[n][0], start, len(ids[n]), crc[n]))
        start += len(ids[n])
    return out


def test_token_files_hold_every_document_in_order(spark, make_docs):
    rows = [(7, "one two"), (3, None), (3, "a b c"), (None, "no id"), (3, "a b c"), (9, ""), (1, "long " * 5000), *enumerate(ODD, 20)]
    with Scratch(spark) as scratch:
        files = write_tokens(make_docs(rows), WORD, 2, scratch)
    found = [tuple(r) for r in files.read().collect()]
    assert sorted(found, key=lambda r: r[1]) == expected_tokens(rows)
    ranks = [r.n for r in files.ranks.orderBy("rank").collect()]
    assert ranks == sorted(ranks, reverse=True)


def test_token_files_of_an_empty_table(spark, make_docs):
    with Scratch(spark) as scratch:
        files = write_tokens(make_docs([]), WORD, 2, scratch)
    assert files.read().count() == 0


def test_cuts_are_the_cheapest():
    rng = np.random.default_rng(0)
    for _ in range(100):
        window, unpadded = 64, (16, 32, 64)
        ends = np.unique(np.cumsum(rng.integers(1, 30, 40)))
        penalties = rng.integers(0, 9, len(ends))
        cost = {0: 0}
        for j, penalty in zip(ends.tolist(), penalties.tolist()):
            cost[j] = penalty + min(
                c + (0 if j - i in unpadded else window - (j - i)) for i, c in cost.items() if j - i <= window)
        cuts = plan_cuts(ends, penalties, window, unpadded)
        total, before = 0, 0
        for cut in cuts:
            assert cut - before <= window
            total += (0 if cut - before in unpadded else window - (cut - before)) + penalties[ends.tolist().index(cut)]
            before = cut
        assert total == cost[ends[-1]] and before == ends[-1]


def test_candidates_leave_no_gap_beyond_a_window():
    places, penalties = candidates([5000, 5001], [np.array([7]), np.empty(0, np.int64)], 1024)
    assert np.diff(places, prepend=0).max() <= 1024 and penalties[-2:].tolist() == [0, 0]


def check_pieces(pieces, rows, window):
    tokenizer = load_tokenizer(BYTE)
    expected = sorted(
        ((i, np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")) for i, t in rows),
        key=lambda r: (r[0] is not None, r[0] or 0))
    pieces = sorted(pieces, key=lambda p: (p.sequence_id, p.offset))
    stream = b"".join(p.ids for p in pieces)
    assert stream == b"".join(i.tobytes() for _, i in expected) or len({i for i, _ in rows}) < len(rows)
    at, sequence = 0, None
    for p in pieces:
        at = 0 if p.sequence_id != sequence else at
        sequence = p.sequence_id
        assert p.offset == at and p.length > 0 and p.ids_crc32 == zlib.crc32(p.ids) and len(p.ids) == 4 * p.length
        at += p.length
        assert at <= window
    for key in {p.doc_id for p in pieces}:
        own = [p for p in pieces if p.doc_id == key]
        copies = sum(1 for i, _ in rows if i == key)
        if copies == 1:
            assert sum(p.length for p in own) == own[0].doc_tokens
            assert [p.start for p in own] == [sum(q.length for q in own[:n]) for n in range(len(own))]
    assert sum(p.length for p in pieces) == sum(len(i) for _, i in expected)


def test_pieces_hold_every_token_once(make_docs):
    rows = [(4, "A sentence. Another one! " * 300), (2, None), (None, "no id"), (8, ""), (8, ""), (5, "x" * 9000), (6, "word " * 4000),
            *enumerate(ODD, 100)]
    pieces = pack_sequences(make_docs(rows), BYTE, 0).collect()
    check_pieces(pieces, rows, 1024)


def test_padding_is_small(spark, make_docs):
    rng = random.Random(1)
    rows = [" ".join("".join(rng.choices("abcdefgh", k=5)) + rng.choice(["", "", "", "."]) for _ in range(rng.randint(1, 900))) for _ in range(400)]
    pieces = pack_sequences(make_docs(rows).coalesce(1), BYTE, 0)
    used = utilisation(pieces).first()
    # Each of the 8 ranges may end in one padded window.
    assert used.padding < 0.01 * used.tokens + 8 * 1024


def test_no_documents_no_pieces(make_docs):
    assert pack_sequences(make_docs([]), BYTE, 0).count() == 0
