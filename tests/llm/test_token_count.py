import random

import pytest

from terravane.llm import token_count as T
from terravane.llm.queries import tokenizer_path

NAMES = ["word_bpe_49k.json", "piece_bpe_32k.model", "byte_bpe_50k.json"]


def plain(path, texts):
    if path.endswith(".model"):
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=path)
        return [len(m.encode(t)) for t in texts]
    from tokenizers import Tokenizer

    m = Tokenizer.from_file(path)
    return [len(m.encode(t, add_special_tokens=False).ids) for t in texts]


def long_texts():
    rng = random.Random(3)
    alphabet = "abcdefghij  \n\tÉéß'1!?你́"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(3000, 9000))) for _ in range(40)]
    return [*texts, "a" * 5000, "don't <|endoftext|> stop " * 400, " " * 4000, "你好" * 2500, ("word " * 700) + "x" * 3000 + (" word" * 700)]


def test_splice_equals_whole():
    path = tokenizer_path()
    spans, _, spliced = T.load(path)
    assert spliced
    texts = long_texts()
    assert [T.splice(t, spans, 700, 60) for t in texts] == plain(path, texts)
    assert [T.splice(t, spans, 200, 10) for t in texts] == plain(path, texts)


def test_words_add_up_to_the_text():
    path = tokenizer_path()
    rng = random.Random(8)
    odd = "aB1'sé́Σς\u00a0\u2003\u0085\x1c\x0b\x0c\u200b 　\n\t\r.,!🙂ﬁİß"
    texts = ["".join(rng.choice(odd) for _ in range(rng.randrange(200))) for _ in range(400)] + long_texts() + ["", " ", "x" * 500]
    _, counts, _ = T.load(path)
    few = T.WordCounts(counts, most=50)
    assert [n for i in range(0, len(texts), 7) for n in few(texts[i : i + 7])] == plain(path, texts)


@pytest.mark.parametrize("name", NAMES)
def test_counts_equal_the_library(spark, name):
    path = tokenizer_path(name)
    texts = [*long_texts()[:12], "", "Hello, World's 2nd", None, None]
    rows = [(i, t, 3) for i, t in enumerate(texts)] + [(0, texts[0], 3), (None, "x y", 3)]
    got = T.count_tokens(spark.createDataFrame(rows, "doc_id long, text string, n_tokens int"), path, chunk=1000, overlap=64).collect()
    want = plain(path, [r[1] or "" for r in rows])
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == sorted((i is None, i or 0, len((t or "").encode()), n, n > 2048) for (i, t, _), n in zip(rows, want))
    assert T.count_tokens(spark.createDataFrame([], "doc_id long, text string"), path).count() == 0


def test_bytes_need_no_tokenizer(spark):
    """token_bytes encoded every text to tell its length."""
    from terravane.llm import queries

    df = queries.token_bytes(spark, "/root/testdata/sf0.001")
    assert "MapInArrow" not in df._jdf.queryExecution().executedPlan().toString() and df.schema["n_bytes"].dataType.simpleString() == "bigint"
