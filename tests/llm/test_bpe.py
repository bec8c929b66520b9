import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from tests.llm.helpers import LONG, ODD, frame
from tidemark.llm import bpe
from tidemark.llm.queries import VOCABULARY

PATH = public_tokenizers.path(VOCABULARY)


@pytest.fixture(scope="module")
def expected():
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks(PATH), special_tokens={})
    return library.encode_ordinary


def test_rows_agree_with_the_library_and_round_trip(spark, expected):
    r = random.Random(1)
    rows = ODD + [(100 + i, "".join(r.choice("aaab é日本́\x00 \n\t　'sx1<|endoftext|>") for _ in range(r.randint(0, 60)))) for i in range(80)]
    out = bpe.encoded(frame(spark, rows), PATH, public_tokenizers.PATTERN, keep=["doc_id"], block_bytes=100_000, with_ids=True).collect()
    assert len(out) == len(rows)
    texts = {}
    for doc_id, text in rows:
        texts.setdefault(doc_id, []).append(text or "")
    for row in out:
        text = next(t for t in texts[row["doc_id"]] if t.encode() == bytes(row["decoded"]))
        ids = expected(text)
        assert row["ids"] == ids and row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_long_pre_tokens(expected):
    for text in ("a" * 3000, "ab" * 900, "ha" * 700 + "hé" * 300, "日本" * 400, "x"):
        assert bpe.merge(text.encode(), bpe.ranks(PATH)) == expected(text)


def test_clashing_columns_and_empty_table(spark):
    df = frame(spark, [(1, "a"), (1, "a"), (2, None)])
    out = bpe.encoded(df, PATH, public_tokenizers.PATTERN)
    assert out.columns == [*df.columns, "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(r["n_tokens"] for r in out.collect()) == [0, 1, 1]
    assert bpe.encoded(frame(spark, []), PATH, public_tokenizers.PATTERN, keep=["doc_id"]).collect() == []


def test_packing():
    for items in ([], [b""], [b"a", b"", b"bc" * 1000]):
        assert bpe.unpack(bpe.pack(items)) == items
    assert len(LONG) > 300_000
