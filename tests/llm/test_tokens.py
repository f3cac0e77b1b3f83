import io
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from groundswell.llm import tokens

PATH = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def some_text(seed, n=300):
    r = random.Random(seed)
    return "".join(r.choice(("Aber", "Straße, ", "ÀÉ.. ", "x;y ", "don't. ", " ", "\n", "\t", "é", "é", "ΣΑΣ", "日本", "'s", "12", "!?", " ", "🙂", "\x1c", " ́",
                             "<|endoftext|>")) for _ in range(n))


@pytest.mark.parametrize("seed", range(6))
def test_chunks_give_the_ids_of_the_whole(library, seed):
    texts = [some_text(seed * 10 + k) for k in range(10)] + ["", " ", "\n\n"]
    got = tokens.Vocabulary(PATH, memo=50).encode(texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [
        library.encode(t, add_special_tokens=False).ids for t in texts]


class Counted:
    """The library, with a list of all words that went through it."""

    def __init__(self, library):
        self.library, self.words = library, []

    def encode_batch_fast(self, texts, **options):
        self.words += [w for t in texts for w in t.split(" ")]
        return self.library.encode_batch_fast(texts, **options)


def test_a_full_memo_keeps_what_is_in_use(library):
    v = tokens.Vocabulary(PATH, memo=400)
    v.library = Counted(v.library)
    rare = ["".join(random.Random(k).choices("abcdefghij", k=9)) for k in range(3000)]
    for k in range(0, 3000, 50):
        texts = [" ".join(rare[k:k + 50]), "Never again, never. NEVER; again!" if k % 100 else "other"]
        got = v.encode(texts)
        assert [np.frombuffer(g, "<u4").tolist() for g in got] == [
            library.encode(t, add_special_tokens=False).ids for t in texts]
    assert v.library.words.count("never") == 1 and v.library.words.count(".") <= 1
    assert len(v.library.words) < 3010 and len(v.known) + len(v.older) <= 600


def test_special_tokens_and_their_literals(library):
    texts = ["a<|endoftext|>b", "<|startoftext|> x <|endoftext|><|endoftext|>", "<|endoftext|", "A.<|ENDOFTEXT|>", "é<|endoftext|>é x"]
    plain = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert plain[0] != plain[3] and 49407 in plain[0]
    assert [np.frombuffer(g, "<u4").tolist() for g in tokens.Vocabulary(PATH).encode(texts)] == plain
    ordinary = Tokenizer.from_file(PATH)
    ordinary.encode_special_tokens = True
    assert [np.frombuffer(g, "<u4").tolist() for g in tokens.Vocabulary(PATH, literal=True).encode(texts)] == [
        ordinary.encode(t, add_special_tokens=False).ids for t in texts]


def test_file_reads_single_documents():
    docs = [(k * 2, np.arange(k, k + n, dtype="<u4").tobytes()) for k, n in enumerate((3, 0, 70_000, 1, 5))]
    raw = b"".join(tokens.pack(iter(docs), frame_bytes=64))
    f = tokens.TokenFile(io.BytesIO(raw))
    assert len(f.table) > 1 and f.n_ids == sum(len(r) // 4 for _, r in docs)
    assert [(k, i.tobytes()) for k, _, i in f.documents()] == docs
    starts = np.cumsum([0] + [len(r) // 4 for _, r in docs])
    for k, (key, body) in enumerate(docs):
        got = f.document(k)
        assert (got[0], got[1], got[2].tobytes()) == (key, starts[k], body)
    broken = bytearray(raw)
    broken[int(f.table[0]["offset"]) + 6] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        list(tokens.TokenFile(io.BytesIO(bytes(broken))).frame(0))
    assert list(tokens.TokenFile(io.BytesIO(b"".join(tokens.pack(iter([]))))).documents()) == []
    with pytest.raises(ValueError, match="not a token file"):
        tokens.TokenFile(io.BytesIO(bytes(100)))


def test_round_trip_in_order(table, library):
    rows = [(k * 7 - 50, some_text(k)) for k in range(60)] + [(None, "first"), (1000, None), (1001, ""), (6, "again"), (2000, "a b " * 40_000)]
    files = tokens.write_tokens(table(rows, extra="start"), PATH, partitions=5)
    assert files.count() > 1
    got = tokens.read_tokens(files, with_ids=True).orderBy("start").collect()
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    ids = [np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for _, t in want]
    assert [r["product_id"] for r in got] == [i for i, _ in want]
    assert [r["start"] for r in got] == np.cumsum([0, *map(len, ids)])[:-1].tolist()
    assert [(r["n_tokens"], r["ids_crc32"], bytes(r["ids"])) for r in got] == [
        (len(i), zlib.crc32(i.tobytes()), i.tobytes()) for i in ids]


def test_empty_table(table):
    files = tokens.write_tokens(table([]), PATH)
    assert tokens.read_tokens(files).collect() == []
