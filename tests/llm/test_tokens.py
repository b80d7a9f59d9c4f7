"""Piece encoding and the alignment of two tokenizers against their libraries and a token-by-token brute force, over odd, long, repeated and
empty texts, null ids and columns with clashing names."""
import collections
import hashlib
import random
import struct

import numpy as np
import public_tokenizers as P
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from hourwise.llm import alignment, bytelevel, pieces

PIECES, BYTES = P.path("piece_bpe_32k.model"), P.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, rid string, seg int, links string, n long, word string"
RNG = random.Random(11)


def odd(n):
    return "".join(RNG.choice("abtheinrson  ▁\n\t.,é中😀\0<0x41>") for _ in range(n))


def prose(n):
    return " ".join("".join(RNG.choice("abcdeéñ") for _ in range(RNG.randint(1, 7))) + RNG.choice(["", "", ",", ".\n", "!  "]) for _ in range(n))


@pytest.fixture(scope="module")
def table():
    texts = [None, "", " ", "  two  words ", "the▁cat", "<s></s><|endoftext|>", "a\0b", "😀é\r\n\tx", "a" * 3000, " " * 70, "中文" * 50,
             prose(400), prose(900), prose(40) + " " + "x" * 200 + " " + prose(40), *(odd(RNG.randint(1, 60)) for _ in range(60))]
    rows = list(enumerate(texts)) + [(11, texts[11]), (None, "no id"), (None, None)]
    return [(i, t, "r", 1, "l", 2, "w") for i, t in rows]


@pytest.fixture(scope="module")
def docs(spark, table):
    return spark.createDataFrame(table, SCHEMA).repartition(3)


def rows_of(df, columns):
    return collections.Counter(tuple(r[c] for c in columns) for r in df.collect())


def packed(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


def sha(x):
    return hashlib.sha256(x).hexdigest()


def test_pieces_as_the_library(spark, docs, table):
    library = SentencePieceProcessor(model_file=PIECES)
    want = collections.Counter()
    for i, t, *_ in table:
        ids = library.encode(t or "", add_bos=True, add_eos=True)
        want[i, len(ids), sha(packed(ids)), sha(library.decode(ids).encode())] += 1
    assert rows_of(pieces.round_trip(docs, PIECES), ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]) == want
    whole = pieces.encode_documents(docs, PIECES, ends=False)
    assert {(r.doc_id, bytes(r.ids)) for r in whole.collect()} == {(i, packed(library.encode(t or ""))) for i, t, *_ in table}
    assert pieces.round_trip(spark.createDataFrame([], SCHEMA), PIECES).collect() == []


def test_piece_agendas_agree():
    """The matrix of agendas, the heap and the library; decoding of any ids."""
    model, library = pieces.PieceModel(PIECES), SentencePieceProcessor(model_file=PIECES)
    words = {"▁" + "".join(RNG.choice("abtheinrsoné\n▁😀") for _ in range(RNG.randint(1, 30))).rstrip("▁") for _ in range(2000)}
    words = [w for w in words if "▁" not in w[1:] and len(w) > 1] + ["▁" + "the" * 40, "▁" + "ab" * 5000]
    for word, ids in model.encode_words(words).items():
        assert ids == packed(model.agenda(word)) == packed(library.encode(word[1:]))
    for _ in range(5000):
        ids = [RNG.choice([1, 2, RNG.randint(3, 258), RNG.randint(259, 31999), 259]) for _ in range(RNG.randint(0, 6))]
        assert model.decode(ids).decode() == library.decode(ids)


def test_check_finds_a_difference():
    encoder = pieces.PieceEncoder(PIECES)
    with pytest.raises(ValueError):
        encoder.check(["cat"], {"▁cat": b"\0\0\0\0"})


def test_byte_level_as_the_library():
    encoder, library = bytelevel.ByteEncoder(BYTES, P.PATTERN), Tokenizer.from_file(BYTES)
    library.encode_special_tokens = True
    texts = [odd(RNG.randint(0, 60)) for _ in range(500)] + [prose(300), "  a  b ", "<|endoftext|> x"]
    assert encoder.encode(texts) == [packed(x.ids) for x in library.encode_batch(texts, add_special_tokens=False)]


def brute(table):
    """Per row: n_a, n_b, groups as lists, links; byte by byte."""
    a_lib, b_lib = Tokenizer.from_file(BYTES), SentencePieceProcessor(model_file=PIECES)
    a_lib.encode_special_tokens = True
    symbols = bytelevel.byte_symbols()
    out = []
    for i, t, *_ in table:
        whole = (" " + (t or "")).encode()
        a = a_lib.encode(" " + (t or ""), add_special_tokens=False).ids
        b = b_lib.encode(t or "")
        a_bytes = [bytes(symbols[c] for c in a_lib.id_to_token(x)) for x in a]
        b_bytes = [bytes([int(p[3:5], 16)]) if b_lib.is_byte(x) else p.replace("▁", " ").encode() for x in b for p in [b_lib.id_to_piece(x)]]
        if not t or b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            out.append((i, [], [], [], []))
            continue
        owner_a = [k for k, x in enumerate(a_bytes) for _ in x]
        owner_b = [k for k, x in enumerate(b_bytes) for _ in x]
        links = sorted(set(zip(owner_a, owner_b)))
        groups, last = [], 0
        ends_a, ends_b = np.cumsum([len(x) for x in a_bytes]).tolist(), np.cumsum([len(x) for x in b_bytes]).tolist()
        for end in sorted(set(ends_a) & set(ends_b)):
            groups.append(([a[k] for k, e in enumerate(ends_a) if last < e <= end], [b[k] for k, e in enumerate(ends_b) if last < e <= end]))
            last = end
        out.append((i, a, b, groups, [(a[x], b[y]) for x, y in links]))
    return out


@pytest.mark.parametrize("options", [{}, {"held": 20}, {"held": 0, "segment": 60, "size": 7, "fan": 2}, {"segment": 300, "size": 64, "fan": 3}])
def test_alignment(spark, docs, table, options):
    found = brute(table)
    n = collections.Counter(x for *_, links in found for x in links)
    most = collections.Counter()
    for (a, b), k in n.items():
        most[b] = max(most[b], k)
    want = collections.Counter()
    for i, a, b, groups, links in found:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        want[i, len(a), len(b), len(groups), len(links), sum(n[x] == most[x[1]] for x in links), sum(n[x] for x in links),
             sha(text.encode()) if a else ""] += 1
    got = alignment.align(docs, BYTES, P.PATTERN, PIECES, **options)
    assert rows_of(got, ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]) == want


def test_fragments_compose_in_any_grouping():
    tools = alignment.Tokenizers(BYTES, P.PATTERN, PIECES)
    monoid = alignment.Alignment(tools.a_length, tools.b_length)
    a, b = tools.encode([prose(60)])[0]
    whole = monoid.close(a, b)[0]
    for size in (3, 11, 64, 10_000):
        parts = monoid.fragments(a, b, size)
        left = monoid.empty
        for p in parts:
            left = monoid.compose(left, p)
        right = monoid.empty
        for p in reversed(parts):
            right = monoid.compose(p, right)
        for x in (left, right, monoid.tree(parts)):
            got = monoid.whole(x)
            assert got.groups == whole.groups and got.codes.tolist() == whole.codes.tolist() and got.links.tolist() == whole.links.tolist()


def test_alignment_of_an_empty_table(spark):
    assert alignment.align(spark.createDataFrame([], SCHEMA), BYTES, P.PATTERN, PIECES).collect() == []
