import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from groundswell.llm import bpe

RANKS = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def whole():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("whole", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def some_text(seed, n=4000):
    r = random.Random(seed)
    return "".join(r.choice(("a", "Wort", " ", "  ", "\n", "\t\n ", "é", "日本", "'s", "12", "!?", " ", "🙂", "\x00", "<|endoftext|>"))
                   for _ in range(n))


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("size", [1, 7, 500])
def test_cuts_leave_the_ids_alone(whole, seed, size):
    text = some_text(seed)
    assert "".join(bpe.pieces(text, size)) == text
    enc = bpe.encoding(RANKS, P.PATTERN)
    ids = bpe.encode(enc, text, size)
    assert ids.tolist() == whole.encode_ordinary(text)
    assert bpe.decode(enc, ids, 3) == text.encode()


def test_table(table, whole):
    rows = [(1, "two words"), (2, None), (3, ""), (None, "x"), (1, "two words"), (4, some_text(9, 60_000)), (5, "a" * 30_000)]
    got = bpe.tokenized(table(rows, extra="n_tokens"), RANKS, P.PATTERN, with_ids=True).collect()

    def want(i, t):
        raw = np.array(whole.encode_ordinary(t or ""), "<u4").tobytes()
        return (str(i), len(raw) // 4, hashlib.sha256(raw).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest(), raw)

    assert sorted((str(r[0]), *r[1:4], bytes(r[4])) for r in got) == sorted(want(*x) for x in rows)
    assert bpe.tokenized(table([]), RANKS, P.PATTERN).collect() == []
    with pytest.raises(ValueError):
        bpe.tokenized(table([], extra="n_tokens"), RANKS, P.PATTERN, keep=("n_tokens",))
    kept = bpe.tokenized(table([(1, "a")]), RANKS, P.PATTERN, keep=("report", "unused")).first()
    assert (kept["report"], kept["unused"], kept["n_tokens"]) == ("a", "x", 1)
